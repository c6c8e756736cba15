"""Map cells: placing sentences on polygons, binning answers, shares."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (lon, lat) to a cell's name.
CellOf = Callable[[Column, Column], Column]
LEAST_SENTENCES = 10


def grid_cell(lon: Column, lat: Column) -> Column:
    """Cells of one degree, which are smaller towards the poles. cells.sphere_cell has cells of one area in a hierarchy; hex_cell is for maps that must match hexagons."""
    return F.concat(F.round(lon).cast("bigint").cast("string"), F.lit("/"), F.round(lat).cast("bigint").cast("string"))


def hex_cell(resolution: int = 3) -> CellOf:
    import h3
    import pandas as pd

    @F.pandas_udf("string")
    def cell(lon: pd.Series, lat: pd.Series) -> pd.Series:
        return pd.Series([h3.latlng_to_cell(y, x, resolution) if y == y and x == x else None for x, y in zip(lon, lat, strict=True)])

    return cell


def bbox_centre(p: str = "bbox") -> tuple[Column, Column]:
    """lon, lat of the middle; null if any side is."""
    at = lambda a: (F.col(f"{p}_min_{a}") + F.col(f"{p}_max_{a}")) / 2
    whole = F.col(f"{p}_min_x").isNotNull() & F.col(f"{p}_min_y").isNotNull() & F.col(f"{p}_max_x").isNotNull() & F.col(f"{p}_max_y").isNotNull()
    return F.when(whole, at("x")), F.when(whole, at("y"))


def last_by(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The value of the last row of each key, so that a join meets one row at most."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def description_cells(labels: DataFrame, languages: DataFrame, polygons: DataFrame, cell_of: CellOf) -> DataFrame:
    """labels with cell, over their identity's polygon (osm_type, osm_id). Unlocated rows have a null cell."""
    lon, lat = bbox_centre()
    cells = last_by(polygons.withColumn("cell", F.when(lon.isNotNull() & lat.isNotNull(), cell_of(lon, lat))).filter("cell is not null"), ["osm_type", "osm_id"], "cell", "row_index")
    of = languages.groupBy("description_identity").agg(F.max_by(F.struct("osm_type", "osm_id"), "row_index").alias("p")).select("description_identity", "p.*")
    return labels.join(of, "description_identity", "left").join(cells, ["osm_type", "osm_id"], "left").drop("osm_type", "osm_id")


def polygon_cells(polygons: DataFrame, cell_of: CellOf) -> DataFrame:
    """polygon_id, cell of the polygons with coordinates."""
    placed = polygons.filter("lat is not null and lon is not null").withColumn("cell", cell_of(F.col("lon"), F.col("lat")))
    return placed.filter("cell is not null and cell <> ''")


def website_cells(labels: DataFrame, polygons: DataFrame, cell_of: CellOf) -> DataFrame:
    return labels.join(last_by(polygon_cells(polygons, cell_of), ["polygon_id"], "cell", "row_index"), "polygon_id", "left")


def website_text_cells(sentences: DataFrame, polygons: DataFrame, cell_of: CellOf) -> DataFrame:
    """Planning: the sent sentences on a polygon with a cell."""
    return sentences.filter("not unsplit").join(last_by(polygon_cells(polygons, cell_of), ["polygon_id"], "cell", "row_index"), "polygon_id")


def document_cells(links: DataFrame, polygons: DataFrame, cell_of: CellOf) -> DataFrame:
    """document_id, cell: that of the smallest linked polygon_id that has coordinates."""
    linked = links.join(last_by(polygon_cells(polygons, cell_of), ["polygon_id"], "cell", "row_index"), "polygon_id")
    return linked.groupBy("document_id").agg(F.min_by("cell", "polygon_id").alias("cell"))


def wiki_cells(labels: DataFrame, sentences: DataFrame, links: DataFrame, polygons: DataFrame, cell_of: CellOf, how: str = "left") -> DataFrame:
    """labels with the cell of their sentence's document; how='inner' for planning."""
    document = last_by(sentences, ["sentence_id"], "document_id", "row_index")
    cells = document_cells(links, polygons, cell_of)
    return labels.join(document, "sentence_id", "left").join(cells, "document_id", how).drop("document_id")


def binned(rows: DataFrame) -> DataFrame:
    """cell, yes, no of the rows with a cell; other decisions don't count."""
    count = lambda d: F.count_if(F.col("decision") == d).alias(d)
    return rows.filter(F.col("decision").isin("yes", "no") & F.col("cell").isNotNull()).groupBy("cell").agg(count("yes"), count("no"))


def located(rows: DataFrame) -> DataFrame:
    """One row: labelled (yes or no), located (with a cell)."""
    answered = F.col("decision").isin("yes", "no")
    return rows.agg(F.count_if(answered).alias("labelled"), F.count_if(answered & F.col("cell").isNotNull()).alias("located"))


def merged_cells(cells: DataFrame) -> DataFrame:
    """Cells of several files as one map."""
    return cells.groupBy("cell").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))


def rolled_up(cells: DataFrame, orders: Sequence[int]) -> DataFrame:
    """order, cell, yes, no: the counts of cells of functions.cells, and of the cells of smaller orders that hold them. Each row is counted once by order, before it is shuffled."""
    at = F.explode(F.array(*[F.lit(o) for o in sorted(set(orders))])).alias("order")
    rows = cells.select(at, "cell", "yes", "no").filter(F.char_length("cell") > F.col("order"))
    return rows.groupBy("order", F.expr("substring(cell, 1, `order` + 1)").alias("cell")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))


def cell_shares(cells: DataFrame, least: int = LEAST_SENTENCES) -> DataFrame:
    """cell, yes, no, share: null for cells of too few sentences."""
    n = F.col("yes") + F.col("no")
    return cells.withColumn("share", F.when(n >= least, F.col("yes") / n))


def global_share(cells: DataFrame) -> DataFrame:
    yes, both = F.coalesce(F.sum("yes"), F.lit(0)), F.coalesce(F.sum(F.col("yes") + F.col("no")), F.lit(0))
    return cells.agg(both.alias("sentences"), F.coalesce(F.try_divide(yes, both), F.lit(0.0)).alias("share"))
