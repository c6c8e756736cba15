"""Usage-policy calendar: working days, daytime, and what a job may cross. Times are local timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds of the day.
DAY_START, DAY_END, EVENING, CUTOFF = 9 * 3600, 19 * 3600, 17 * 3600, 16 * 3600 + 50 * 60
#: Seconds: how late a daytime job may start; how long a record may wait; the longest daytime job.
START_TOLERANCE, ZOMBIE_AGE, DAY_MOST = 600, 7200, 3600
#: Public holidays of fixed date (month, day), and days after Easter Sunday.
FIXED = ((1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25))
MOVING = (1, 39, 50)


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday, in integers only."""
    y = year.cast("int")
    div = lambda a, b: F.floor(a / F.lit(b)).cast("int")
    a, b, c = y % 19, div(y, 100), y % 100
    d, e = div(b, 4), b % 4
    g = div(b * 8 + 13, 25)
    h = (a * 19 + b - d - g + 15) % 30
    i, k = div(c, 4), c % 4
    el = (F.lit(32) + e * 2 + i * 2 - h - k) % 7
    m = div(a + h * 11 + el * 22, 451)
    n = h + el - m * 7 + 114
    return F.make_date(y, div(n, 31), n % 31 + 1)


def is_working_day(day: Column) -> Column:
    fixed = F.array(*[F.lit(m * 100 + d) for m, d in FIXED])
    moving = [day == F.date_add(easter(F.year(day)), n) for n in MOVING]
    holiday = F.array_contains(fixed, F.month(day) * 100 + F.dayofmonth(day)) | moving[0] | moving[1] | moving[2]
    return (F.weekday(day) < 5) & ~holiday


def second_of_day(moment: Column) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def is_daytime(moment: Column) -> Column:
    s = second_of_day(moment)
    return is_working_day(F.to_date(moment)) & (s >= DAY_START) & (s < DAY_END)


def _at(day: Column, second: int) -> Column:
    return F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400 + second)


def next_day_start(moment: Column) -> Column:
    """The first 09:00 of a working day after the window that the moment is in."""
    first = F.when(second_of_day(moment) < DAY_START, F.to_date(moment)).otherwise(F.date_add(F.to_date(moment), 1))
    days = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda n: F.date_add(first, n))
    return _at(F.get(F.filter(days, is_working_day), F.lit(0)), DAY_START)


def allowed_window(now: Column, starts_now: Column) -> Column:
    """struct<walltime_s, job_type>: the longest job allowed now, or null."""
    day = F.struct(F.lit(DAY_MOST).cast("bigint").alias("walltime_s"), F.lit(None).cast("string").alias("job_type"))
    night = F.struct((F.unix_timestamp(next_day_start(now)) - F.unix_timestamp(now)).alias("walltime_s"), F.lit("night").alias("job_type"))
    return F.when(is_daytime(now), F.when(starts_now, day)).otherwise(night)


def immediate_window(window: Column) -> Column:
    """The window of a job of an hour at most that starts at once inside a night window, or null."""
    short = F.struct(F.least(window["walltime_s"], F.lit(DAY_MOST).cast("bigint")).alias("walltime_s"), F.lit(None).cast("string").alias("job_type"))
    return F.when(window.isNotNull() & window["job_type"].isNotNull(), short)


def crosses_forbidden(submitted: Column, start: Column, end: Column) -> Column:
    """True if a working day's 09:00 or 19:00 lies strictly between; 19:00 doesn't count on the day of a submission from 17:00 on."""
    days = F.filter(F.sequence(F.to_date(start), F.to_date(end)), is_working_day)
    evening = second_of_day(submitted) >= EVENING
    inside = lambda t: (start < t) & (t < end)
    return F.exists(days, lambda d: inside(_at(d, DAY_START)) | (inside(_at(d, DAY_END)) & ~(evening & (d == F.to_date(submitted)))))


def verdict(submitted: Column, expected_start: Column, by_day: Column, crosses: Column) -> Column:
    """struct<allowed, reason> of a queued job: by_day says whether it was submitted in daytime, crosses whether it would cross a boundary."""
    say = lambda ok, why: F.struct(F.lit(ok).alias("allowed"), F.lit(why).alias("reason"))
    late = F.unix_timestamp(expected_start) - F.unix_timestamp(submitted) > START_TOLERANCE
    return (
        F.when(expected_start.isNull() & by_day, say(False, "would start late: no predicted start in daytime"))
        .when(expected_start.isNull(), say(True, "night job, start left to the night type"))
        .when(by_day & late, say(False, "would start late"))
        .when(crosses, say(False, "would cross a day/night boundary"))
        .otherwise(say(True, "ok"))
    )


def cpu_job_verdict(submitted: Column, walltime_s: Column, expected_start: Column) -> Column:
    """struct<allowed, reason>: whether a queued job may stay. Lists a job's days; operators.boundaries.verdicts looks many jobs up."""
    end = F.timestamp_seconds(F.unix_timestamp(expected_start) + walltime_s)
    return verdict(submitted, expected_start, is_daytime(submitted), crosses_forbidden(submitted, expected_start, end))


def stale_day_job(submitted: Column, now: Column) -> Column:
    """Whether a waiting job that was submitted by day is to be deleted."""
    waited = F.unix_timestamp(now) - F.unix_timestamp(submitted) > START_TOLERANCE
    cutoff = (F.to_date(now) == F.to_date(submitted)) & (second_of_day(now) >= CUTOFF)
    return is_daytime(submitted) & (second_of_day(submitted) < EVENING) & (waited | cutoff)


def is_zombie(state: Column, submitted: Column, now: Column) -> Column:
    return F.coalesce((state == "Waiting") & (F.unix_timestamp(now) - F.unix_timestamp(submitted) > ZOMBIE_AGE), F.lit(False))


def is_stale_besteffort(queue: Column, state: Column, submitted: Column, now: Column, most_s: int = 1200) -> Column:
    return F.coalesce((queue == "besteffort") & (state == "Waiting") & (F.unix_timestamp(now) - F.unix_timestamp(submitted) >= most_s), F.lit(False))


def check_due(mode: Column, phase: Column, checked_before: Column) -> Column:
    """Whether a usage check must run: at each job, or once before and once after a batch."""
    return (mode == "per-job") | ((phase == "before") != checked_before)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """day, working: a row for each day."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return days.withColumn("working", is_working_day(F.col("day")))
