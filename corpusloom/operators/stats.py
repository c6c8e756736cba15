"""Statistics of published tables, jobs and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import timeline as t

#: The order of decisions in reports.
DECISIONS = ("yes", "no", "failed", "skipped_unsplit", "pending")
#: Sentences a second of a GPU without a profile.
DEFAULT_RATE = 1.4
#: Requests at once of a GPU without a profile: as a profile's default, and when a job is launched; and its part of memory.
DEFAULT_WINDOW, LAUNCH_WINDOW, DEFAULT_MEMORY = 64, 16, 0.75
SETUP_SECONDS = 480


def decision_counts(labels: DataFrame, *by: str) -> DataFrame:
    return labels.groupBy(*by, "decision").agg(F.count(F.lit(1)).alias("rows"))


def failure_counts(labels: DataFrame, *by: str) -> DataFrame:
    """Reasons of failed rows only; unsplit rows have a reason but didn't fail."""
    failed = labels.filter((F.col("decision") == "failed") & (F.coalesce("failure_reason", F.lit("")) != ""))
    return failed.groupBy(*by, "failure_reason").agg(F.count(F.lit(1)).alias("rows"))


def rows_per(table: DataFrame, key: Column, name: str) -> DataFrame:
    return table.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("rows"))


def file_stats(labels: DataFrame, path: str = "source_file") -> DataFrame:
    """One row for each file: rows by decision, labelled, located."""
    counts = [F.count_if(F.col("decision") == d).alias(d) for d in DECISIONS]
    answered = F.col("decision").isin("yes", "no")
    return labels.groupBy(path).agg(*counts, F.count_if(answered).alias("labelled"), F.count_if(answered & F.col("cell").isNotNull()).alias("located"))


def totals(files: DataFrame) -> DataFrame:
    """Sums over the files: counters of files add up to those of the rows."""
    return files.agg(F.count(F.lit(1)).alias("files"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*DECISIONS, "labelled", "located")])


def files_to_count(published: DataFrame, counted: DataFrame, with_cells: bool) -> DataFrame:
    """Published files that have no count yet, were refreshed, or lack cells where there should be some. counted: path, refreshed, cells."""
    known = counted.select("path", "refreshed", F.col("cells").isNull().alias("_bare"))
    rows = published.join(known, "path", "left")
    bare = F.lit(with_cells) & F.col("path").startswith("labels/") & F.coalesce("_bare", F.lit(True))
    return rows.filter(F.col("refreshed").isNull() | F.col("refreshed") | bare).select("path")


def throughput(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("gpu").agg(F.avg("sentences_per_second").alias("sentences_per_second"))


def useful_fraction(jobs: DataFrame) -> DataFrame:
    """gpu (null: all), jobs, useful_fraction, stopped_early, ran_to_checkpoint over the measured jobs."""
    measured = jobs.filter(t.is_measured(F.col("walltime_s"), F.col("engine_ready_at"), F.col("last_result_at")))
    left = t.seconds_left(F.col("walltime_s"), F.col("started_at"), F.col("ended_at"), F.col("env_ready_seconds"))
    rows = measured.select(
        t.gpu_name(F.col("gpu_key"), F.col("gpu")).alias("gpu"),
        F.col("walltime_s").cast("double").alias("walltime_s"),
        t.generation_seconds(F.col("engine_ready_at"), F.col("last_result_at")).alias("s"),
        t.stopped_early(F.col("stopped"), left, F.col("walltime_s")).alias("early"),
    )
    share = F.coalesce(F.try_divide(F.count_if("early"), F.count(F.lit(1))), F.lit(None).cast("double"))
    measures = [F.count(F.lit(1)).alias("jobs"), F.try_divide(F.sum("s"), F.sum("walltime_s")).alias("useful_fraction"), share.alias("stopped_early"), (F.lit(1.0) - share).alias("ran_to_checkpoint")]
    return rows.groupBy("gpu").agg(*measures).unionByName(rows.agg(F.lit(None).cast("string").alias("gpu"), *measures))  # all of none has a row, too


def live(assignments: DataFrame, fingerprint: Column) -> DataFrame:
    return assignments.filter(F.col("state").isin("submitting", "submitted") & (F.col("fp") == fingerprint))


def with_profiles(rows: DataFrame, profiles: DataFrame, window: int = DEFAULT_WINDOW) -> DataFrame:
    """Adds max_running_requests, mem_fraction_static, cuda_graph_max_bs, sentences_per_second and calibrated of each row's gpu_key: the profile's, and where there is none, or
    it leaves a value out, the default. A launch uses LAUNCH_WINDOW instead of the default window. Of several profiles of one key the last by gpu counts; a key may be null."""
    defaults = {"max_running_requests": F.lit(window), "mem_fraction_static": F.lit(DEFAULT_MEMORY), "cuda_graph_max_bs": F.lit(None).cast("int"), "sentences_per_second": F.lit(DEFAULT_RATE), "calibrated": F.lit(False)}
    one = profiles.groupBy(F.col("gpu_key").alias("_key")).agg(F.max_by(F.struct(*[F.col(c).alias(c) for c in defaults]), "gpu").alias("_profile"))
    joined = rows.join(one, rows["gpu_key"] == one["_key"], "left")
    return joined.select(*[rows[c] for c in rows.columns], *[F.coalesce(F.col(f"_profile.{c}"), d).alias(c) for c, d in defaults.items()])


def dataset_status(lines: DataFrame, complete: DataFrame, jobs: DataFrame, profiles: DataFrame) -> DataFrame:
    """dataset, chunks, chunks_complete, texts, texts_complete, live_jobs, rate, eta_hours.

    A live job counts for each dataset whose plan has one of its chunks; a GPU without a profile runs at the default rate.
    """
    done = complete.select("chunk_id").distinct().withColumn("_done", F.lit(True))
    per = lines.join(done, "chunk_id", "left").groupBy("dataset").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if("_done").alias("chunks_complete"), F.sum("size").alias("texts"), F.coalesce(F.sum(F.when(F.col("_done"), F.col("size"))), F.lit(0)).alias("texts_complete")
    )
    mine = jobs.select("id", "gpu_key", F.explode("chunks").alias("chunk_id")).join(lines.select("dataset", "chunk_id"), "chunk_id").select("dataset", "id", "gpu_key").distinct()
    rated = mine.join(profiles.select("gpu_key", "sentences_per_second"), "gpu_key", "left").groupBy("dataset").agg(F.count(F.lit(1)).alias("live_jobs"), F.sum(F.coalesce("sentences_per_second", F.lit(DEFAULT_RATE))).alias("rate"))
    out = per.join(rated, "dataset", "left").withColumn("live_jobs", F.coalesce("live_jobs", F.lit(0).cast("bigint"))).withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    return out.withColumn("eta_hours", t.eta_hours(F.col("texts") - F.col("texts_complete"), F.col("rate")))


def reconciled(assignments: DataFrame, jobs: DataFrame) -> DataFrame:
    """assignments with what to do: adopt a job that has no id yet, end one that is gone, or keep."""
    known = jobs.select("name", F.col("job_id").alias("_job"))
    rows = assignments.join(known, "name", "left")
    action = F.when(F.col("_job").isNotNull() & F.col("job_id").isNull(), "adopt").when(F.col("_job").isNull(), "end").otherwise("keep")
    return rows.withColumn("action", action).withColumn("job_id", F.coalesce("job_id", "_job")).drop("_job")


def run_counters(results: DataFrame) -> DataFrame:
    """completed, rule_decided, tokens, failed of a run; the rule's rows don't count for speed."""
    rule = F.col("finish_reason") == "rule:no_letters"
    return results.agg(F.count(F.lit(1)).alias("completed"), F.count_if(rule).alias("rule_decided"), F.coalesce(F.sum("generated_tokens"), F.lit(0)).alias("tokens"), F.count_if(F.col("decision") == "failed").alias("failed"))


def publish_done(status: DataFrame, revision: Column) -> DataFrame:
    """Whether a publication is finished: mirrored, scanned, every file of some complete, not cut short, of this revision."""
    files = (F.col("files_total") > 0) & (F.col("files_complete") == F.col("files_total"))
    done = F.col("mirrored") & (F.col("unscanned") == 0) & files & F.col("stopped").isNull() & (F.col("revision") == revision)
    return status.withColumn("done", F.coalesce(done, F.lit(False)))


def calibration_pick(levels: DataFrame, within: float = 0.03) -> DataFrame:
    """The smallest window whose rate is within a part of the best."""
    top = levels.agg(F.max("rate").alias("top"))  # one row
    return levels.crossJoin(top).filter(F.col("rate") >= F.col("top") * (F.lit(1.0) - F.lit(within))).agg(F.min("window").alias("window"), F.min_by("rate", "window").alias("rate"))
