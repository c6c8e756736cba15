"""Map cells of equal area in a hierarchy, as Column expressions (HEALPix in its nested order, after Górski et al., 2005).

The sphere is cut into twelve faces of equal area, and each face `order` times into four, so that there are 12 * 4 ** order cells, all of one area. A cell's name is
its face (a to l) and a digit 0 to 3 for each cut, so that the cells that hold it are the beginnings of its name: rolling up is cutting names short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: For each face, its ring and its place in it, in units of half a face.
RINGS, PLACES = (2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4), (1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7)
FACES = "abcdefghijkl"
#: 49,152 cells of some 10,400 square kilometres: about as large as the hexagons of usual density maps of the world.
ORDER, DEEPEST = 6, 24


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def sphere_cell(order: int = ORDER) -> Callable[[Column, Column], Column]:
    """(lon, lat) in degrees to the cell's name; null for a null, an infinite number, or a latitude beyond the poles. Longitudes go round."""
    if not 0 <= order <= DEEPEST:
        raise ValueError(f"an order from 0 to {DEEPEST}")
    n = 1 << order
    whole = lambda c: F.floor(c).cast("bigint")

    def belt(p: Column) -> Column:
        """Where lines that rise and lines that fall cross: face, x, y of a point near the equator."""
        rising, falling = whole(n * (p["t"] + 0.5) - n * 0.75 * p["z"]), whole(n * (p["t"] + 0.5) + n * 0.75 * p["z"])
        crossing = F.struct(rising.alias("a"), falling.alias("b"), F.floor(rising / n).cast("int").alias("fa"), F.floor(falling / n).cast("int").alias("fb"))
        face = lambda c: F.when(c["fa"] == c["fb"], c["fa"] % 4 + 4).when(c["fa"] < c["fb"], c["fa"]).otherwise(c["fb"] + 8)
        return _let(crossing, lambda c: F.struct(face(c).alias("face"), (c["b"] % n).alias("x"), (n - 1 - c["a"] % n).alias("y")))

    def cap(p: Column) -> Column:
        """face, x, y of a point near a pole."""
        quarter = F.least(F.lit(3), F.floor(p["t"]).cast("int"))
        out = n * F.sqrt(3 * (1 - F.abs(p["z"])))
        at = F.struct(quarter.alias("q"), F.least(F.lit(n - 1), whole((p["t"] - quarter) * out)).alias("a"), F.least(F.lit(n - 1), whole((1 - (p["t"] - quarter)) * out)).alias("b"))
        north, south = lambda c: F.struct(c["q"].alias("face"), (n - 1 - c["b"]).alias("x"), (n - 1 - c["a"]).alias("y")), lambda c: F.struct((c["q"] + 8).alias("face"), c["a"].alias("x"), c["b"].alias("y"))
        return _let(at, lambda c: F.when(p["z"] >= 0, north(c)).otherwise(south(c)))

    def name(c: Column) -> Column:
        digits = [(F.shiftright(c["y"], k) % 2 * 2 + F.shiftright(c["x"], k) % 2).cast("string") for k in reversed(range(order))]
        return F.concat(F.substring(F.lit(FACES), c["face"] + 1, F.lit(1)), *digits)

    def cell(lon: Column, lat: Column) -> Column:
        lon, lat = lon.cast("double"), lat.cast("double")
        turns = F.pmod(lon, F.lit(360.0)) / 90.0
        point = F.struct(F.sin(F.radians(lat)).alias("z"), F.when(turns >= 4.0, 0.0).otherwise(turns).alias("t"))
        found = _let(point, lambda p: _let(F.when(F.abs(p["z"]) <= F.lit(2.0) / 3.0, belt(p)).otherwise(cap(p)), name))
        return F.when((F.abs(lat) <= 90.0) & (F.abs(lon) < float("inf")), found)

    return cell


def parent(cell: Column, order: int) -> Column:
    """The cell of a smaller order that holds it."""
    return F.substring(cell, 1, order + 1)


def cell_centre(cell: Column) -> Column:
    """struct<lon, lat>: the middle of a cell of any order; longitudes from -180 to 180."""
    digits = F.transform(F.sequence(F.lit(2), F.char_length(cell)), lambda i: F.substring(cell, i, F.lit(1)).cast("bigint"))
    digits = F.when(F.char_length(cell) > 1, digits).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"))
    step = lambda s, d: F.struct((s["x"] * 2 + d % 2).alias("x"), (s["y"] * 2 + F.shiftright(d, 1)).alias("y"))
    face = F.position(F.substring(cell, 1, 1), F.lit(FACES))
    n = F.pow(F.lit(2.0), F.char_length(cell) - 1).cast("bigint")
    known = F.struct(F.aggregate(digits, start, step).alias("at"), F.element_at(F.array(*map(F.lit, RINGS)), face).alias("ring"), F.element_at(F.array(*map(F.lit, PLACES)), face).alias("place"), n.alias("n"))

    def ring(k: Column) -> Column:
        r = k["ring"] * k["n"] - k["at"]["x"] - k["at"]["y"] - 1
        return F.struct(r.alias("r"), k["n"].alias("n"), F.least(r, 4 * k["n"] - r, k["n"]).alias("m"), (k["at"]["x"] - k["at"]["y"]).alias("d"), k["place"].alias("place"))

    def centre(c: Column) -> Column:
        r, n, m = c["r"], c["n"], c["m"]
        shift = F.when((r >= n) & (r <= 3 * n), (r - n) % 2).otherwise(0)
        third = (m * m) / (3.0 * n * n)
        z = F.when(r < n, 1 - third).when(r > 3 * n, third - 1).otherwise((2 * n - r) * 2.0 / (3.0 * n))
        place = F.floor((c["place"] * m + c["d"] + 1 + shift) / 2)
        lon = (F.pmod(place - 1, 4 * m) + 1 - (shift + 1) * 0.5) * 90.0 / m
        return F.struct(F.when(lon > 180.0, lon - 360.0).otherwise(lon).alias("lon"), F.degrees(F.asin(z)).alias("lat"))

    return _let(_let(known, ring), centre)
