"""Arithmetic on job records, deadlines and walltimes. Times of records are ISO texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLY, STOP_MARGIN = 0.10, 360.0


def gap_seconds(start: Column, end: Column) -> Column:
    """Seconds from one ISO text to another; null if either is missing or empty."""
    at = lambda c: F.to_timestamp(F.nullif(c, F.lit("")))
    return (F.unix_micros(at(end)) - F.unix_micros(at(start))) / F.lit(1e6)


def generation_seconds(ready: Column, last: Column) -> Column:
    return F.greatest(gap_seconds(ready, last), F.lit(0.0)) + F.lit(0.0) * gap_seconds(ready, last)


def is_measured(walltime_s: Column, ready: Column, last: Column) -> Column:
    return (F.coalesce(walltime_s, F.lit(0)) > 0) & generation_seconds(ready, last).isNotNull()


def seconds_left(walltime_s: Column, started: Column, ended: Column, env_ready_s: Column) -> Column:
    return walltime_s - gap_seconds(started, ended) - F.coalesce(env_ready_s, F.lit(0.0))


def stopped_early(stopped: Column, left: Column, walltime_s: Column) -> Column:
    """Not signalled, and over a tenth of the walltime left."""
    return F.coalesce(F.nullif(stopped.cast("string"), F.lit("")).isNull() | (stopped.cast("string") == "false"), F.lit(True)) & F.coalesce(left > F.lit(EARLY) * walltime_s, F.lit(False))


def gpu_name(key: Column, name: Column) -> Column:
    """The key, else the name, else unknown; empty texts count as missing."""
    return F.coalesce(F.nullif(key, F.lit("")), F.nullif(name, F.lit("")), F.lit("unknown"))


def walltime_text(seconds: Column) -> Column:
    """H:MM."""
    minutes = F.floor(seconds / 60)
    return F.concat(F.floor(minutes / 60).cast("string"), F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0"))


def should_stop(now: Column, deadline: Column, margin: float = STOP_MARGIN) -> Column:
    return F.coalesce(now >= deadline - margin, F.lit(False))


def stop_reason(now: Column, deadline: Column, signalled: Column, margin: float = STOP_MARGIN) -> Column:
    """A signal wins over the deadline; null to go on."""
    return F.when(F.coalesce(signalled, F.lit("")) != "", F.concat(F.lit("signal "), signalled)).when(should_stop(now, deadline, margin), F.lit("deadline"))


def deadline_from_status(status: Column, now: Column) -> Column:
    """Epoch seconds at which a scheduler's JSON says that the job ends, or null. The job may be wrapped in an object."""
    inner = F.when(F.get_json_object(status, "$.walltime").isNotNull(), status).otherwise(F.get(F.map_values(F.from_json(status, "map<string,string>")), F.lit(0)))
    walltime = F.get_json_object(inner, "$.walltime").try_cast("double")
    start = F.coalesce(F.get_json_object(inner, "$.startTime").try_cast("double"), F.lit(0.0))
    return F.when(walltime > 0, (F.when(start > 0, start).otherwise(now.cast("double")) + walltime).cast("bigint"))


def eta_hours(remaining: Column, rate: Column) -> Column:
    return F.when(remaining == 0, F.lit(0.0)).when(rate > 0, remaining / rate / 3600)


def failed_rate_alert(completed: Column, failed: Column, most: float = 0.05) -> Column:
    return F.coalesce((completed > 0) & (F.try_divide(failed, completed) > F.lit(most)), F.lit(False))


def retry_after(header: Column) -> Column:
    """Seconds of a Retry-After header, or null."""
    return F.regexp_extract(F.trim(header), "^(\\d+(?:\\.\\d+)?)$", 1).try_cast("double")


def next_delay(attempt: Column, after: Column, jitter: Column, most: float = 300.0) -> Column:
    """The server's wait plus a margin, or exponential backoff, both with jitter."""
    asked = F.greatest(after, F.lit(0.0)) + 1.0 + jitter
    backoff = F.lit(2.0) * F.pow(F.lit(2.0), attempt - 1) * (F.lit(0.5) + jitter / 2)
    return F.least(F.when(after.isNotNull(), asked).otherwise(backoff), F.lit(most))


def give_up(attempt: Column, waited: Column, delay: Column, attempts: int = 10, most: float = 1200.0) -> Column:
    return (attempt >= attempts) | (waited + delay > F.lit(most))
