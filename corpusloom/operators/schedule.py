"""Capacity, slots and the choice of work: small relations of a control plane."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERFLOW = 1.2
#: Plan lines that one task sums up.
RUN = 1 << 14


def blocked(reservations: Column, now: Column, walltime_s: Column) -> Column:
    """Whether a waiting reservation starts before a job would end."""
    return F.exists(reservations, lambda r: (r["state"] == "waiting") & (F.coalesce(r["scheduled_at"], F.lit(0)) != 0) & (r["scheduled_at"] < now + walltime_s))


def usable(name: Column, host: Column, hard: Column, taken: Column) -> Column:
    return host.startswith(F.concat(name, F.lit("-"))) & F.coalesce(hard.isin("alive", "standby"), F.lit(True)) & ~taken


def node_gpus(free: Column, freeable: Column, busy: Column, per_node: Column, preempt: bool) -> Column:
    """Whole GPUs free on a node, from its slots; slots held by preemptible jobs count as free only if they may be taken."""
    slots = free + freeable if preempt else free
    every = slots + busy + (F.lit(0) if preempt else freeable)
    return F.when(every > 0, F.floor(slots * per_node / every)).otherwise(F.lit(0)).cast("bigint")


def free_gpus(nodes: DataFrame, preempt: bool) -> DataFrame:
    """cluster, free: floors by node, then the sum. nodes: cluster, free_slots, freeable_slots, busy_slots, gpus_per_node, of usable hosts."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    gpus = node_gpus(zero("free_slots"), zero("freeable_slots"), zero("busy_slots"), F.col("gpus_per_node"), preempt)
    return nodes.groupBy("cluster").agg(F.sum(gpus).alias("free"))


def is_production(queues: Column) -> Column:
    return F.arrays_overlap(queues, F.array(F.lit("production"), F.lit("abaca")))


def is_submittable(queues: Column) -> Column:
    return is_production(queues) | F.array_contains(queues, "default")


def ineligibility(memory_mib: Column, major: Column, minor: Column, least_mib: int = 16 * 1024) -> Column:
    """Why a GPU can't be used, or null: compute capability below 8.0, then too little memory."""
    able = F.struct(major.cast("int").alias("a"), minor.cast("int").alias("b")) >= F.struct(F.lit(8).alias("a"), F.lit(0).alias("b"))
    low = F.concat(F.lit("compute capability "), major.cast("string"), F.lit("."), minor.cast("string"), F.lit(" < 8.0"))
    small = F.concat(memory_mib.cast("string"), F.lit(f" MiB < {least_mib} MiB"))
    return F.when(~able, low).when(memory_mib < least_mib, small)


def eligible(vendor: Column, arch: Column, queues: Column, reason: Column) -> Column:
    return (vendor == "Nvidia") & (arch == "x86_64") & is_submittable(queues) & reason.isNull()


def admission(clusters: DataFrame, gates: DataFrame) -> DataFrame:
    """clusters with the state of their GPU's gate, pending without one."""
    return clusters.join(gates.select("gpu_key", "admission"), "gpu_key", "left").withColumn("admission", F.coalesce("admission", F.lit("pending")))


def useful_sentences(rate: Column, gpus: Column, walltime_s: Column, wait_s: Column, setup_s: float) -> Column:
    """What a job can finish, less the longer it waits."""
    return rate * gpus * F.greatest(F.lit(0.0), walltime_s - F.lit(float(setup_s))) / (F.lit(1.0) + wait_s / 3600.0)


def slots(clusters: DataFrame, queued_wait_s: float) -> DataFrame:
    """A slot for each cluster that offers one: free GPUs at once, or a place in the queue where that is possible.

    clusters: site, cluster, gpu, free, walltime_s, job_type, rate, besteffort, queue_room.
    """
    queued = F.col("free") <= 0
    rows = clusters.filter(F.col("walltime_s").isNotNull() & (~queued | (F.col("queue_room") & ~F.col("besteffort"))))
    return rows.withColumn("queued", queued).withColumn("free_nodes", F.when(queued, 1).otherwise(F.col("free"))).withColumn("wait_s", F.when(queued, F.lit(float(queued_wait_s))).otherwise(F.lit(0.0)))


def ranked_slots(rows: DataFrame, setup_s: float) -> DataFrame:
    """Slots that can do anything, with their rank: most sentences first, then site and cluster. One row for each cluster is sorted."""
    value = useful_sentences(F.col("rate"), F.lit(1), F.col("walltime_s"), F.col("wait_s"), setup_s)
    good = rows.withColumn("useful", value).filter("useful > 0")
    return good.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("useful"), "site", "cluster")) - 1)


def enough_slots(ranked: DataFrame, most_total: int, most_per_site: int) -> DataFrame:
    """The slots that a LaunchPlan can come to: each has a node at least, so a site's further slots and all after most_total are never reached."""
    place = F.row_number().over(Window.partitionBy("site").orderBy("rank"))
    return ranked.withColumn("place", place).filter(F.col("place") <= most_per_site).drop("place").orderBy("rank").limit(most_total)


def greedy_prefix(pending: DataFrame, taken: DataFrame, budget: Column, by: str | None = None) -> DataFrame:
    """The chunks a job gets: in plan order, without taken ones, until the next would go over budget; the first always.

    pending: chunk_id, size, seq, one row for each chunk of a plan (by dataset, if `by` is given).
    """
    rows = pending.join(taken.select("chunk_id").distinct(), "chunk_id", "left_anti").withColumn("_run", F.coalesce(F.floor(F.col("seq") / RUN), F.lit(-1)))
    keys = [by] if by else []
    # A plan may be long, so runs of its lines are summed up apart; only one row for each run takes part in the sum over runs.
    sums = rows.groupBy(*keys, "_run").agg(F.sum("size").alias("_size"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_run").alias("_of"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_size", "_n")])
    inside = Window.partitionBy(*keys, "_run").orderBy("seq")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("used", F.sum("size").over(upto)).withColumn("place", F.row_number().over(inside).cast("bigint"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_run") == F.col("_of")]
    rows = rows.join(base, same).withColumns({"used": F.col("used") + F.col("_size_before"), "place": F.col("place") + F.col("_n_before")})
    return rows.filter((F.col("place") == 1) | (F.col("used") <= budget)).select(*pending.columns, "used", "place")


def walltime_ladder(window_s: Column, night: Column, day_s: Column, preferred_s: Column, fallback_s: Column, day_short_s: Column) -> Column:
    """The walltimes to try: the first, then a shorter one, both within the window; distinct and positive."""
    first = F.when(night, preferred_s).otherwise(day_s)
    second = F.when(night, fallback_s).otherwise(F.coalesce(day_short_s, day_s))
    return F.filter(F.array_distinct(F.array(F.least(first, window_s), F.least(second, first, window_s))), lambda w: w > 0)


def without_long(ladder: Column) -> Column:
    return F.slice(ladder, -1, 1)


def job_capacity(rate: Column, walltime_s: Column, setup_s: float) -> Column:
    return rate * (walltime_s - F.lit(float(setup_s)))


def removable(paths: DataFrame, commits: DataFrame, lock: str, synced: DataFrame, root: str, log_days: int = 7) -> DataFrame:
    """Paths below the root that may be deleted, by class: unused code, other environments, old logs, synced parts."""
    rest = F.substring("path", len(root) + 1, 10_000)
    rows = paths.filter(F.col("path").startswith(root)).withColumn("kind", F.split_part(rest, F.lit("/"), F.lit(1))).withColumn("rest", F.expr(f"substring(substring(path, {len(root) + 1}), length(kind) + 2)"))
    code = rows.filter("kind = 'code'").join(commits.select(F.col("commit").alias("rest")), "rest", "left_anti")
    cache = rows.filter((F.col("kind") == "cache") & F.col("rest").startswith("venv-") & ~F.col("rest").startswith(f"venv-{lock}"))
    logs = rows.filter((F.col("kind") == "logs") & (F.col("age_days") > log_days))
    work = rows.filter((F.col("kind") == "work") & F.col("rest").startswith("parts/")).join(synced.select(F.concat(F.lit("parts/"), "part").alias("rest")), "rest", "left_semi")
    names = ["path", "kind"]
    return code.select(names).unionByName(cache.select(names)).unionByName(logs.select(names)).unionByName(work.select(names))


@dataclass(frozen=True)
class Launch:
    index: int
    cluster: str
    site: str
    chunks: tuple[str, ...]


@dataclass
class LaunchPlan:
    """Which ranked slot gets which chunks. Each choice depends on the ones before; there are tens of jobs at most, so the
    driver decides, over plan lines that it reads one after another and only as far as needed."""

    most_total: int
    most_per_site: int
    overflow: float = OVERFLOW
    launches: list[Launch] = field(default_factory=list)

    def fill(self, ranked: Iterable[tuple[str, str, int, float]], lines: Iterable[tuple[str, int]], taken: Iterable[str], running: int = 0, per_site: dict[str, int] | None = None) -> list[Launch]:
        """ranked: (site, cluster, nodes, capacity)."""
        queue = _Lines(lines, set(taken))
        counts = dict(per_site or {})
        for site, cluster, nodes, capacity in ranked:
            for _ in range(nodes):
                if running + len(self.launches) >= self.most_total or counts.get(site, 0) >= self.most_per_site:
                    break
                chunks = queue.take(capacity * self.overflow)
                if not chunks:
                    return self.launches
                counts[site] = counts.get(site, 0) + 1
                self.launches.append(Launch(len(self.launches), cluster, site, chunks))
        return self.launches


class _Lines:
    def __init__(self, lines: Iterable[tuple[str, int]], taken: set[str]) -> None:
        self.free = ((c, n) for c, n in lines if c not in taken)
        self.next: tuple[str, int] | None = next(self.free, None)

    def take(self, budget: float) -> tuple[str, ...]:
        out: list[str] = []
        used = 0
        while self.next and (not out or used + self.next[1] <= budget):
            out.append(self.next[0])
            used += self.next[1]
            self.next = next(self.free, None)
        return tuple(out)


def by_site(launches: Sequence[Launch]) -> dict[str, list[Launch]]:
    out: dict[str, list[Launch]] = {}
    for x in launches:
        out.setdefault(x.site, []).append(x)
    return out
