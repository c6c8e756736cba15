"""Job records from the events that a job reports, on a clock that can't go back.

An event has the wall clock's time and the seconds of the job's own, monotonic clock. Only the first event's wall time counts: it is the anchor, and every stamp is the anchor and the
seconds since. A step of the wall clock during the job thus moves no stamp, and no duration is negative. All sums are mergeable, so a job may have any number of
events, in any order, and the same function folds a table or, in update mode, a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds of events that a record knows; others only move its end.
READY, RESULT = "engine_ready", "result"


def timeline_records(events: DataFrame) -> DataFrame:
    """A row a job: job, started_at, env_ready_seconds, engine_ready_at, first_result_at, last_result_at, ended_at, walltime_s, assigned_texts.

    events: job, wall (timestamp), mono (seconds), kind, and, on any of a job's events, env_ready (text; kept if it is a whole number), walltime_s and assigned_texts (the largest
    counts). Stamps are ISO texts in UTC to the second, null for what didn't happen. Events without mono don't count; of events of one mono the earliest wall time is the anchor."""
    mono = F.col("mono").cast("double")
    at = lambda kind, of: of(F.when(F.col("kind") == kind, mono))
    sums = events.filter(mono.isNotNull()).groupBy("job").agg(
        F.min(F.struct(mono.alias("mono"), F.col("wall").cast("timestamp").alias("wall"))).alias("anchor"),
        F.max(F.when(F.col("env_ready").rlike("^[0-9]+$"), F.col("env_ready").try_cast("int"))).alias("env_ready_seconds"),
        at(READY, F.min).alias("ready"), at(RESULT, F.min).alias("first"), at(RESULT, F.max).alias("last"), F.max(mono).alias("end"),
        F.max("walltime_s").alias("walltime_s"), F.max("assigned_texts").alias("assigned_texts"),
    )

    def stamp(of: Column) -> Column:
        micros = F.unix_micros("anchor.wall") + F.round((of - F.col("anchor.mono")) * 1e6).cast("bigint")
        return F.concat(F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))

    stamps = {"started_at": F.col("anchor.mono"), "engine_ready_at": F.col("ready"), "first_result_at": F.col("first"), "last_result_at": F.col("last"), "ended_at": F.col("end")}
    rows = sums.select("job", *[stamp(c).alias(n) for n, c in stamps.items()], "env_ready_seconds", "walltime_s", "assigned_texts")
    return rows.select("job", "started_at", "env_ready_seconds", "engine_ready_at", "first_result_at", "last_result_at", "ended_at", "walltime_s", "assigned_texts")
