"""Cells of equal area: every one is found from its middle, holds its children, and is as large as any other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.cells import FACES, cell_centre, parent, sphere_cell
from corpusloom.operators import geo


def every(spark, order):
    digits = F.lpad(F.conv(F.col("id") % 4**order, 10, 4), order, "0") if order else F.lit("")
    return spark.range(12 * 4**order).select(F.concat(F.substring(F.lit(FACES), (F.floor(F.col("id") / 4**order) + 1).cast("int"), F.lit(1)), digits).alias("cell"))


@pytest.mark.parametrize("order", [0, 1, 2, 4, 6])
def test_each_cell_is_found_from_its_middle(spark, order):
    df = every(spark, order).withColumn("c", cell_centre(F.col("cell"))).withColumn("back", sphere_cell(order)(F.col("c.lon"), F.col("c.lat")))
    assert df.filter("cell <> back or back is null").count() == 0 and df.select("c").distinct().count() == 12 * 4**order


def test_faces_stand_where_they_should(spark):
    """The middles of the twelve faces: three rings, of which the middle one is turned by half a face."""
    got = {r.cell: (round(r.c.lon, 9), round(r.c.lat, 6)) for r in every(spark, 0).withColumn("c", cell_centre(F.col("cell"))).collect()}
    third = round(math.degrees(math.asin(2 / 3)), 6)
    assert got == {f: (lon, lat) for fs, lat, lons in (("abcd", third, (45, 135, -135, -45)), ("efgh", 0, (0, 90, 180, -90)), ("ijkl", -third, (45, 135, -135, -45))) for f, lon in zip(fs, lons, strict=True)}


def test_areas_are_equal(spark):
    """120,000 points spread evenly over the sphere: each of 192 cells has 625 of them, but for those near its border: 4 % at most."""
    n = 120_000
    i = np.arange(n) + 0.5
    points = spark.createDataFrame(list(zip(((i * 137.50776405003785) % 360 - 180).tolist(), np.degrees(np.arcsin(1 - 2 * i / n)).tolist(), strict=True)), "lon double, lat double")
    cells = points.select(sphere_cell(5)(F.col("lon"), F.col("lat")).alias("deep"), sphere_cell(2)(F.col("lon"), F.col("lat")).alias("cell"))
    assert cells.filter(parent(F.col("deep"), 2) != F.col("cell")).count() == 0  # a beginning of the name holds it
    counts = [r["count"] for r in cells.groupBy("cell").count().collect()]
    assert len(counts) == 192 and max(abs(c - n / 192) for c in counts) <= 0.04 * n / 192


def test_edges_of_the_world(spark):
    data = [(None, 1.0), (1.0, None), (0.0, 90.1), (float("nan"), 0.0), (float("inf"), 0.0), (0.0, 90.0), (0.0, -90.0), (180.0, 10.0), (-180.0, 10.0), (540.0, 10.0), (-1e-14, 0.0), (359.999999, 89.9999)]
    got = [r[0] for r in spark.createDataFrame(data, "lon double, lat double").coalesce(1).select(sphere_cell(6)(F.col("lon"), F.col("lat"))).collect()]
    assert got[:5] == [None] * 5 and all(len(c) == 7 for c in got[5:]) and got[7] == got[8] == got[9]
    assert got[5][0] == "a" and got[6][0] == "i" and got[11][0] == "d"
    with pytest.raises(ValueError):
        sphere_cell(25)


def test_parents_are_their_childrens_sums(spark):
    df = spark.createDataFrame([("a00", 1, 2), ("a01", 3, 0), ("a13", 5, 5), ("b00", 0, 7), ("c", 9, 9)], "cell string, yes long, no long")
    got = {(r.order, r.cell): (r.yes, r.no) for r in geo.rolled_up(df, [0, 1, 2]).collect()}
    assert got == {(0, "a"): (9, 7), (0, "b"): (0, 7), (0, "c"): (9, 9), (1, "a0"): (4, 2), (1, "a1"): (5, 5), (1, "b0"): (0, 7), (2, "a00"): (1, 2), (2, "a01"): (3, 0), (2, "a13"): (5, 5), (2, "b00"): (0, 7)}
