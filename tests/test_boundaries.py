"""Boundaries by lookup: equal to listing every day of every job."""

import datetime as dt
import random

from pyspark.sql import functions as F

from corpusloom.functions import calendar
from corpusloom.operators import boundaries

SCHEMA = "job int, submitted timestamp, start timestamp, end timestamp, walltime_s long, working string"


def jobs(seed, n=300, longest=4 * 24 * 60):
    rng, out = random.Random(seed), []
    for i in range(n):
        day = dt.datetime(2024, 4, 25) + dt.timedelta(days=rng.randrange(20))  # two holidays, and Ascension Day
        submitted = day + dt.timedelta(hours=rng.choice([8, 9, 12, 16, 17, 18, 19, 23]), minutes=rng.choice([0, 0, 1, 59]))
        start = submitted + dt.timedelta(minutes=rng.choice([0, 5, 10, 11, 60, 600, 2000]), microseconds=rng.choice([0, 0, 1]))
        end = start + dt.timedelta(minutes=rng.choice([1, 59, 60, 61, 600, rng.randrange(longest)]))
        if rng.random() < 0.2:
            end = end.replace(hour=rng.choice([9, 19]), minute=0, second=0, microsecond=rng.choice([0, 1]))
        out.append((i, submitted, start, end, int((end - start).total_seconds()), "clash"))
    return out


def test_lookup_equals_listing(spark):
    df = spark.createDataFrame(jobs(1), SCHEMA)
    both = boundaries.crossings(df.filter("start <= end")).withColumn("listed", calendar.crosses_forbidden(F.col("submitted"), F.col("start"), F.col("end")))
    both = both.withColumn("day", calendar.is_daytime(F.col("submitted"))).collect()
    assert all(r.crosses == r.listed and r.day_submission == r.day for r in both), [r for r in both if r.crosses != r.listed][:3]
    assert {r.crosses for r in both} == {True, False} and both[0].working == "clash"
    verdicts = boundaries.verdicts(df).withColumn("listed", calendar.cpu_job_verdict(F.col("submitted"), F.col("walltime_s"), F.col("start"))["reason"]).collect()
    assert all(r.reason == r.listed for r in verdicts) and len({r.reason for r in verdicts}) == 3


def test_jobs_of_any_length(spark):
    """Ten years between working days' edges; a second between two; a job in which only the exempt 19:00 lies."""
    t = dt.datetime
    data = [
        (1, t(2015, 1, 1), t(2015, 1, 1), t(2025, 1, 1), 0, ""),
        (2, t(2024, 6, 5, 17), t(2024, 6, 5, 17), t(2024, 6, 6, 9), 0, ""),  # 19:00 is exempt, the end isn't inside
        (3, t(2024, 6, 5, 17), t(2024, 6, 5, 17), t(2024, 6, 6, 9, 0, 1), 0, ""),
        (4, t(2024, 6, 5, 16, 59), t(2024, 6, 5, 17), t(2024, 6, 5, 19, 0, 1), 0, ""),
        (5, t(2024, 6, 8, 1), t(2024, 6, 8, 1), t(2024, 6, 9, 23), 0, ""),  # a weekend
        (6, t(2024, 6, 5), None, None, 0, ""),
        (7, t(2024, 6, 6), t(2024, 6, 6), t(2024, 6, 5), 0, ""),
    ]
    got = {r.job: r.crosses for r in boundaries.crossings(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False, 6: False, 7: False}
    assert boundaries.crossings(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_days_are_listed_by_job(spark):
    plan = boundaries.crossings(spark.createDataFrame(jobs(2, 20), SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sequence(") <= 3 and "exists(" not in plan  # the index alone


def test_day_starts_by_lookup_equal_the_functions(spark):
    from corpusloom.functions import calendar
    from corpusloom.operators.boundaries import with_day_starts

    rows = spark.range(0, 9000).selectExpr("id", "CASE WHEN id % 50 > 0 THEN timestamp_seconds(1703000000 + id * 4321) END AS at")
    want = rows.select("id", calendar.is_daytime(F.col("at")).alias("daytime"), calendar.next_day_start(F.col("at")).alias("next_day_start"))
    got = with_day_starts(rows, "at").select("id", "daytime", "next_day_start")
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
    assert with_day_starts(rows.filter("at IS NULL"), "at").filter("daytime IS NULL AND next_day_start IS NULL").count() == 180
