"""Which jobs cross a boundary of the usage policy, by an index over the days: how many boundaries lie before a moment is looked up, not listed.

The boundaries are 09:00 and 19:00 of working days. The index has a row for each day with the number of working days before it, made once for the span of
all jobs, whatever their number and length. The boundaries strictly between two moments are those before the end less those up to the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import calendar
from corpusloom.functions.calendar import DAY_END, DAY_START, EVENING


def working_days(spark: SparkSession, first: object, last: object) -> DataFrame:
    """day, working, before (working days from the first day on, this one not counted): a row for each day, 366 a year at most."""
    days = calendar.calendar(spark, str(first), str(last))
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # over days, not over jobs
    return days.withColumn("before", F.coalesce(F.sum(F.col("working").cast("int")).over(earlier), F.lit(0)))


def span(jobs: DataFrame) -> tuple[object, object] | None:
    """The first and the last day that the jobs touch; None without jobs."""
    r = jobs.agg(F.to_date(F.least(F.min("submitted"), F.min("start"))).alias("a"), F.to_date(F.greatest(F.max("submitted"), F.max("start"), F.max("end"))).alias("b")).first()
    return (r.a, r.b) if r.a is not None else None


def with_crossings(jobs: DataFrame, index: DataFrame) -> DataFrame:
    """Adds crosses: whether a boundary lies strictly between start and end, and day_submission: whether the submission was in a working day's daytime.

    19:00 doesn't count on the day of a submission from 17:00 on. jobs have submitted, start and end (local timestamps); a job without start or end crosses nothing,
    nor does one that ends before it starts. The index must cover all their days."""
    days = {"start": "_s", "end": "_e", "submitted": "_u"}
    rows = jobs
    for moment, at in days.items():
        day = index.select(F.col("day").alias(f"{at}day"), F.col("working").alias(f"{at}w"), F.col("before").alias(f"{at}n"))
        rows = rows.join(day, F.to_date(moment) == F.col(f"{at}day"), "left")
    edge = lambda at, second: F.timestamp_seconds(F.unix_date(f"{at}day").cast("bigint") * 86400 + second)
    one = lambda c: F.coalesce(c, F.lit(False)).cast("int")

    def between(second: int) -> Column:
        before_end = F.col("_en") + one(F.col("_ew") & (edge("_e", second) < F.col("end")))
        up_to_start = F.col("_sn") + one(F.col("_sw") & (edge("_s", second) <= F.col("start")))
        return before_end - up_to_start

    evening = calendar.second_of_day(F.col("submitted")) >= EVENING
    exempt = one(F.col("_uw") & evening & (F.col("start") < edge("_u", DAY_END)) & (edge("_u", DAY_END) < F.col("end")))
    crosses = F.coalesce((F.col("start") < F.col("end")) & ((between(DAY_START) > 0) | (between(DAY_END) - exempt > 0)), F.lit(False))
    second = calendar.second_of_day(F.col("submitted"))
    by_day = F.coalesce(F.col("_uw") & (second >= DAY_START) & (second < DAY_END), F.lit(False))
    return rows.select(*[F.col(c) for c in jobs.columns], crosses.alias("crosses"), by_day.alias("day_submission"))


def crossings(jobs: DataFrame) -> DataFrame:
    """with_crossings over the jobs' own span: one look at the jobs for it, then lookups."""
    days = span(jobs)
    if days is None:
        return jobs.withColumns({"crosses": F.lit(False), "day_submission": F.lit(False)})
    return with_crossings(jobs, working_days(jobs.sparkSession, *days))


def with_day_starts(rows: DataFrame, moment: str) -> DataFrame:
    """Adds daytime and next_day_start (as calendar's functions of those names say) of a timestamp column, looked up by its day; rows without a moment get nulls."""
    r = rows.agg(F.to_date(F.min(moment)).alias("a"), F.to_date(F.max(moment)).alias("b")).first()
    found = rows.withColumn("_day", F.to_date(moment))
    if r.a is None:
        return found.drop("_day").withColumns({"daytime": F.lit(None).cast("boolean"), "next_day_start": F.lit(None).cast("timestamp")})
    # A row a day of the span: whether it is a working day, and the first 09:00 for moments before 09:00 and for those after it.
    days = calendar.calendar(rows.sparkSession, str(r.a), str(r.b))
    early, late = (calendar.next_day_start(F.timestamp_seconds(F.unix_date("day").cast("bigint") * 86400 + s)) for s in (0, DAY_START))
    index = days.select(F.col("day").alias("_day"), F.col("working").alias("_working"), early.alias("_early"), late.alias("_late"))
    second = calendar.second_of_day(F.col(moment))
    by_day = F.col("_working") & (second >= DAY_START) & (second < DAY_END)
    out = found.join(F.broadcast(index), "_day", "left")  # 366 rows a year
    return out.select(*[F.col(c) for c in rows.columns], by_day.alias("daytime"), F.when(second < DAY_START, F.col("_early")).otherwise(F.col("_late")).alias("next_day_start"))


def verdicts(jobs: DataFrame) -> DataFrame:
    """Adds allowed and reason: whether a queued job may stay. jobs have submitted, start (the expected one, null if unknown) and walltime_s."""
    ends = jobs.withColumn("end", F.timestamp_seconds(F.unix_timestamp("start") + F.col("walltime_s")))
    v = calendar.verdict(F.col("submitted"), F.col("start"), F.col("day_submission"), F.col("crosses"))
    return crossings(ends).withColumn("_v", v).select(*[F.col(c) for c in jobs.columns if c != "end"], "_v.allowed", "_v.reason")
