"""Mixing sources to target weights along a time-varying curriculum, in Column expressions only.

Every source has a weight schedule over training time 0 to 1. Its integral up to t says which part of the
source's words has been asked for by then. A document that starts at word x of its source's order is trained
on when the integral reaches x: the inverse of the cumulative demand assigns positions, and a range sort by
position gives the order of training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm._shared import WORD, cuts, prefix_sums, staged, table

#: (time, relative weight) knots; the weight is linear between them. Only the shape counts: each schedule is
#: scaled so that the source reaches its target at time 1.
Schedule = Sequence[tuple[float, float]]
#: Heavy sources come early, the middle ones evenly, the light ones late.
CURRICULUM: tuple[Schedule, ...] = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.4), (0.6, 1.0), (1.0, 1.9)))


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _segments(schedule: Schedule) -> Column:
    """The knots' segments with the part of the whole integral before and in each."""
    knots = sorted((float(t), float(w)) for t, w in schedule)
    if knots[0][0] != 0 or knots[-1][0] != 1 or min(w for _, w in knots) < 0:
        raise ValueError("a schedule runs from time 0 to 1 and has no negative weight")
    parts = [(t0, t1, w0, w1, (w0 + w1) / 2 * (t1 - t0)) for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False) if t1 > t0]
    whole, before, out = sum(p[4] for p in parts), 0.0, []
    if whole <= 0:
        raise ValueError("a schedule needs some weight")
    for t0, t1, w0, w1, area in parts:
        out.append(F.struct(*[F.lit(x).cast("double").alias(n) for n, x in (("t0", t0), ("dt", t1 - t0), ("w0", w0 / whole), ("dw", (w1 - w0) / whole), ("from", before / whole), ("to", (before + area) / whole))]))
        before += area
    return F.array(*out)


def position_of(part: Column, segments: Column) -> Column:
    """The time at which the integral of the schedule reaches `part` of the whole."""
    hit = F.filter(segments, lambda s: (part < s["to"]) & (s["to"] > s["from"]))
    s = F.coalesce(F.get(hit, F.lit(0)), F.element_at(segments, -1))
    need = F.greatest(part - s["from"], F.lit(0.0))
    # w0 x + dw x^2 / (2 dt) = need, for x in [0, dt]; this form of the root also holds for dw = 0
    root = F.sqrt(F.greatest(s["w0"] * s["w0"] + F.lit(2.0) * s["dw"] / s["dt"] * need, F.lit(0.0)))
    x = F.coalesce(F.try_divide(F.lit(2.0) * need, s["w0"] + root), F.lit(0.0))
    return F.least(s["t0"] + F.least(x, s["dt"]), F.lit(1.0))


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row for each source: source, rank, source_size, target.

    Weights repeat over the sources in code point order, null last. The targets share `share` times all words;
    none is above `most` times its source's words, and the excess goes to the others by weight: with the sources
    ordered by their limit over weight, those that reach it come first, and the level for the rest is what is
    left over the weight left.
    """
    by = Window.orderBy(F.col("source").asc_nulls_last())  # over one row for each source
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("rank", F.row_number().over(by) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("taken_up", F.coalesce(F.sum("limit").over(so_far), F.lit(0.0))).withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)) - F.col("taken_up")) / F.col("weight_left"))
    s = s.withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    s = s.withColumn("open_level", F.min_by("level", F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), F.col("rank")))).over(Window.partitionBy()))
    return s.select("source", "rank", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(F.col("open_level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, curriculum: Sequence[Schedule] = CURRICULUM) -> DataFrame:
    """Gives every document its part in the mix and its place in training.

    Returns doc_id, size, source_size, target, taken, rounds, position, last_position, in the order of position. A source's
    documents stand in the order of md5(doc_id); its demand goes round that order again and again, at most
    `most` times, and stops at the target's whole words; the document in which it stops gives only the words
    still asked for. `taken` counts words with repeats, `rounds` the visits, `position` and `last_position` the
    times of the first and last visit, null for documents that aren't visited. A source's schedule is that of its
    rank, repeating.

    Nulls: a null text has size 0 and is never visited, as any text without words; null is a source of its own; a null
    doc_id is ordered as the empty text. Repeated rows count each. No rows, no result; if no words, targets are 0. Other
    columns are ignored. Sources are taken to be few enough for one sort of one row each.
    """
    sized = staged(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", n_words(F.col("text")).alias("size"), _digest(), _crc()), "mix-sizes")
    x = _placed(sized, sized, weights, share, most, curriculum)
    visits = F.when(F.col("size") > 0, F.col("full") + (F.col("part") > 0).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    x = x.withColumn("rounds", visits).withColumn("taken", F.col("full") * F.col("size") + F.col("part"))
    at = lambda turn: F.when(F.col("rounds") > 0, _position(turn))
    x = x.select("doc_id", "size", "source_size", "target", "taken", "rounds", at(F.lit(0)).alias("position"), at(F.col("rounds") - 1).alias("last_position"))
    return x.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def _digest() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("digest")


def _crc() -> Column:
    return F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("crc")


def _position(turn: Column) -> Column:
    return position_of((F.col("before") + turn * F.col("source_size")) / F.col("target"), F.col("plan"))


def _placed(rows: DataFrame, sized: DataFrame, weights: Sequence[float], share: float, most: float, curriculum: Sequence[Schedule]) -> DataFrame:
    """rows with their source's numbers, `before`, whole rounds (`full`) and words of the last one (`part`)."""
    targets = source_targets(sized, weights, share, most)
    plans = F.element_at(F.array(*[_segments(c) for c in curriculum]), (F.col("rank") % len(curriculum) + 1).cast("int"))
    targets = staged(targets.withColumn("plan", plans).withColumnRenamed("source", "of"), "mix-targets")  # a few rows, of known size to the planner
    placed = prefix_sums(rows, ["source"], "size", ["doc_id", "crc", "size"], "digest", cuts(sized))
    x = placed.join(targets, placed["source"].eqNullSafe(targets["of"]))
    full = F.coalesce(F.expr("try_divide(floor(target), source_size)"), F.lit(0.0)).cast("bigint")
    rest = F.floor("target").cast("bigint") - full * F.col("source_size")
    return x.withColumn("full", full).withColumn("part", F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size")))


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, curriculum: Sequence[Schedule] = CURRICULUM) -> DataFrame:
    """The documents themselves, one row for each visit of mix(), in training order, with their own columns.

    Documents stay whole here: the visit in which the target is reached counts if it takes half of the document at least.
    """
    size = n_words(F.col("text")).alias("size")
    sized = staged(docs.select("source", size), "mix-sizes")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", size, _digest(), _crc(), F.struct("*").alias("doc"))
    x = _placed(rows, sized, weights, share, most, curriculum)
    visits = F.when(F.col("size") > 0, F.col("full") + (F.col("part") * 2 >= F.col("size")).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    x = x.withColumn("turn", F.explode(F.slice(F.sequence(F.lit(0).cast("bigint"), visits), 2, F.greatest(visits, F.lit(0)).cast("int"))))
    return x.select("doc", _position(F.col("turn") - 1).alias("position"), "doc_id").orderBy("position", "doc_id").select("doc.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _plan_sql(schedule: Schedule, what: str) -> str:
    """position_of over one schedule: `what` is the part of the whole."""
    knots = sorted(schedule)
    parts = [(t0, t1, w0, w1, (w0 + w1) / 2 * (t1 - t0)) for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    whole, before, cases = sum(p[4] for p in parts), 0.0, []
    for t0, t1, w0, w1, area in parts:
        d = lambda x: f"CAST('{x!r}' AS DOUBLE)"
        need = f"greatest({what} - {d(before / whole)}, 0.0::DOUBLE)"
        root = f"sqrt(greatest({d(w0 / whole)} * {d(w0 / whole)} + 2.0::DOUBLE * {d((w1 - w0) / whole)} / {d(t1 - t0)} * {need}, 0.0::DOUBLE))"
        place = f"least({d(t0)} + least(coalesce(2.0::DOUBLE * {need} / nullif({d(w0 / whole)} + {root}, 0), 0), {d(t1 - t0)}), 1.0::DOUBLE)"
        cases.append((f"{what} < {d((before + area) / whole)}", place))
        before += area
    return "CASE " + " ".join(f"WHEN {c} THEN {p}" for c, p in cases) + f" ELSE {cases[-1][1]} END"


def _mix_sql() -> str:
    at = lambda turn: "CASE WHEN rounds > 0 THEN CASE rank % 3 " + " ".join(f"WHEN {i} THEN {_plan_sql(c, f'(CAST(before + ({turn}) * source_size AS DOUBLE) / target)')}" for i, c in enumerate(CURRICULUM)) + " END END"
    return f"""
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
weighted AS (SELECT *, CAST([5, 2, 1][rank % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap FROM sources),
levels AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
marked AS (SELECT *, cap <= level * weight AS is_full FROM levels),
targets AS (SELECT source, rank, source_size, CASE WHEN is_full THEN cap ELSE (SELECT min_by(level, struct_pack(a := cap / weight, b := rank)) FROM marked WHERE NOT is_full) * weight END AS target FROM marked),
placed AS (SELECT s.doc_id, s.size, t.*, CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
parts AS (SELECT *, coalesce(CAST(floor(target) AS BIGINT) // nullif(source_size, 0), 0) AS n_full FROM placed),
taken AS (SELECT *, least(greatest(CAST(floor(target) AS BIGINT) - n_full * source_size - before, 0), size) AS part FROM parts),
visits AS (SELECT *, CASE WHEN size > 0 THEN n_full + CAST(part > 0 AS BIGINT) ELSE 0 END AS rounds FROM taken)
SELECT doc_id, size, source_size, target, CAST(n_full * size + part AS BIGINT) AS taken, CAST(rounds AS BIGINT) AS rounds, {at("0")} AS position, {at("rounds - 1")} AS last_position FROM visits"""


ORACLE = {"op5_mixing": _mix_sql()}
