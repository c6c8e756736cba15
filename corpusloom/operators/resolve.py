"""From result parts to one verdict for each text, whatever the order, overlap or repetition of the parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.answers import parse_generation
from corpusloom.functions.text import has_no_letters


def first_by(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that comes first; the order must tell rows apart."""
    names = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("r")).select(key, "r.*")


def canonical_generations(parts: DataFrame) -> DataFrame:
    """Each text's generation from its smallest (chunk_id, part, row_index)."""
    return first_by(parts, "text_sha256", ["chunk_id", "part", "row_index"])


def verdicts(parts: DataFrame) -> DataFrame:
    """text_sha256, decision, parse_mode, failure_reason, part_key, from the smallest part key, then the first row in it."""
    parsed = parts.withColumn("v", parse_generation(F.col("raw_output"), F.col("truncated")))
    rows = parsed.select("text_sha256", "v.*", "part_key", "row_index")
    return first_by(rows, "text_sha256", ["part_key", "row_index"]).drop("row_index")


def done_per_chunk(manifests: DataFrame) -> DataFrame:
    """Distinct texts with a result, by chunk."""
    return manifests.groupBy("chunk_id").agg(F.countDistinct("text_sha256").alias("done"))


def chunk_progress(expected: DataFrame, found: DataFrame) -> DataFrame:
    """For each chunk: state, missing (in the chunk's order), owners (text to its smallest part), foreign (texts that aren't its own).

    expected: chunk_id, text_sha256, position; found: chunk_id, text_sha256, part_id.
    """
    owners = found.groupBy("chunk_id", "text_sha256").agg(F.min("part_id").alias("owner"))
    both = expected.join(owners, ["chunk_id", "text_sha256"], "full_outer")
    mine = F.col("position").isNotNull()
    listed = both.groupBy("chunk_id").agg(
        F.count_if(mine).alias("expected"),
        F.count_if(mine & F.col("owner").isNotNull()).alias("done"),
        F.array_sort(F.collect_list(F.when(mine & F.col("owner").isNull(), F.struct("position", "text_sha256")))).alias("m"),
        F.array_sort(F.collect_list(F.when(mine & F.col("owner").isNotNull(), F.struct("text_sha256", "owner")))).alias("o"),
        F.array_sort(F.collect_list(F.when(~mine, F.col("text_sha256")))).alias("foreign"),
    )
    state = F.when(F.col("done") == 0, "pending").when(F.col("done") < F.col("expected"), "partial").otherwise("complete")
    return listed.select("chunk_id", state.alias("state"), F.col("m.text_sha256").alias("missing"), F.map_from_entries("o").alias("owners"), "foreign")


def split_by_rule(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that the rule decides, and those for the model: two branches, so that the model never sees the first."""
    rule = has_no_letters(F.col("text"))
    return texts.filter(rule), texts.filter(~rule)


def missing_texts(chunk: DataFrame, results: DataFrame) -> DataFrame:
    return chunk.join(results.select("text_sha256").distinct(), "text_sha256", "left_anti")


def unseen(wanted: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """The difference of two sets of keys: files not mirrored, parts not indexed, manifests not fetched."""
    return wanted.join(seen.select(key).distinct(), key, "left_anti")


def generated_texts(manifests: DataFrame) -> DataFrame:
    return manifests.select(F.explode("text_sha256s").alias("text_sha256")).distinct()


def union_of_parts(*stores: DataFrame) -> DataFrame:
    """Parts of several stores; one that is in more than one counts once."""
    out = stores[0]
    for s in stores[1:]:
        out = out.unionByName(s)
    return out.dropDuplicates(["part_key", "row_index"])


def deduped_generations(published: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Published rows without repeated generation_ids (the first file name wins, then the row), and for each file whether it changed or is empty now."""
    from pyspark.sql import Window

    order = Window.partitionBy("generation_id").orderBy("file_name", "row_index")
    marked = published.withColumn("_keep", F.row_number().over(order) == 1)
    files = marked.groupBy("file_name").agg((F.count_if("_keep") < F.count(F.lit(1))).alias("changed"), (F.count_if("_keep") == 0).alias("emptied"))
    return marked.filter("_keep").drop("_keep"), files
