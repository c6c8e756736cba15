"""From sentence positions to chunks of work: unique texts, total orders, chunk ids, plan lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.identity import cell_key, chunk_id, hash_round


def unique_texts(sentences: DataFrame) -> DataFrame:
    """text_sha256, text, file_idx: each distinct text that goes to the model, owned by the first file that has it."""
    split = sentences.filter(~F.col("unsplit"))
    return split.groupBy("text_sha256").agg(F.min("file_idx").alias("file_idx"), F.any_value("text").alias("text"))


def scan_counts(sentences: DataFrame, texts: DataFrame) -> DataFrame:
    """file_idx, sentences, unsplit, new_unique, for each file."""
    per_file = sentences.groupBy("file_idx").agg(F.count(F.lit(1)).alias("sentences"), F.count_if("unsplit").alias("unsplit"))
    new = texts.groupBy("file_idx").agg(F.count(F.lit(1)).alias("new_unique"))
    return per_file.join(new, "file_idx", "left").withColumn("new_unique", F.coalesce("new_unique", F.lit(0).cast("bigint")))


def plan_report(counts: DataFrame, texts: DataFrame) -> DataFrame:
    """One row: files, scanned, sentences, unsplit, unique texts, chunks."""
    a = counts.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("sentences"), F.lit(0)).alias("sentences"), F.coalesce(F.sum("unsplit"), F.lit(0)).alias("unsplit"))
    b = texts.agg(F.count(F.lit(1)).alias("unique_texts"), F.countDistinct("chunk_id").alias("chunks"))
    return a.crossJoin(b)  # one row each


def pending(texts: DataFrame) -> DataFrame:
    return texts.filter(F.col("chunk_id").isNull() & ~F.col("done"))


def pending_counts(texts: DataFrame) -> DataFrame:
    return pending(texts).agg(F.count(F.lit(1)).alias("pending"), F.count("cell").alias("with_cell"))


def scanned_prefix(texts: DataFrame, files: DataFrame) -> DataFrame:
    """Texts of the files before the first that isn't scanned yet; all if there is none."""
    first = files.filter(~F.col("scanned")).agg(F.min("file_idx").alias("first_open"))  # one row
    return texts.crossJoin(F.broadcast(first)).filter(F.col("first_open").isNull() | (F.col("file_idx") < F.col("first_open"))).drop("first_open")


def file_ordinal(texts: DataFrame) -> DataFrame:
    """Texts numbered by (file_idx, text_sha256): a file's offset, then a row number in the file.

    Few files are large, and a file is cut up by the first two digits of its hashes.
    """
    cut = texts.withColumn("_cut", F.substring("text_sha256", 1, 2))
    sizes = cut.groupBy("file_idx", "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("file_idx", "_cut").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows a file at most
    offsets = sizes.select("file_idx", "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("file_idx", "_cut").orderBy("text_sha256")) - 1
    return cut.withColumn("_inside", inside).join(offsets, ["file_idx", "_cut"]).withColumn("ordinal", F.col("_inside") + F.col("_offset")).drop("_cut", "_inside", "_offset")


def rounds(texts: DataFrame) -> DataFrame:
    """Adds round and key: a located text's place among its cell's by hash; others are spread over the rounds by hash.

    Any prefix by (round, key, text_sha256) is even over the cells that aren't exhausted.
    """
    # A cell may be a metropolis, so it is cut up by the first two digits of its hashes: a cut's offset, then a row number in the cut.
    cut = texts.filter("cell is not null").withColumn("_cut", F.substring("text_sha256", 1, 2))
    sizes = cut.groupBy("cell", "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("cell").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows a cell at most
    offsets = sizes.select("cell", "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("cell", "_cut").orderBy("text_sha256")) - 1
    located = cut.withColumn("_inside", inside).join(offsets, ["cell", "_cut"]).withColumn("round", F.col("_inside") + F.col("_offset")).select(*texts.columns, "round")
    most = sizes.groupBy("cell").agg(F.sum("_n").alias("_n")).agg(F.max("_n").alias("_n"))
    top = most.select(F.coalesce(F.col("_n") - 1, F.lit(0).cast("bigint")).alias("top"))  # one row, from counts alone
    rest = texts.filter("cell is null").crossJoin(F.broadcast(top)).withColumn("round", F.pmod(hash_round(F.col("text_sha256")), F.col("top") + 1)).drop("top")
    key = F.when(F.col("cell").isNotNull(), cell_key(F.col("cell"))).otherwise(F.lit(""))
    return located.unionByName(rest).withColumn("key", key)


def uniform_ordinal(texts: DataFrame) -> DataFrame:
    """Texts numbered by (round, key, text_sha256): offsets of the (round, first digit of key) groups, then a row number."""
    cut = rounds(texts).withColumn("_cut", F.substring("key", 1, 1))
    sizes = cut.groupBy("round", "_cut").agg(F.count(F.lit(1)).alias("_n"))
    # rounds are as many as the largest cell has texts; blocks of 1,024 rounds first, then rounds in a block
    sizes = sizes.withColumn("_block", F.floor(F.col("round") / 1024))
    blocks = sizes.groupBy("_block").agg(F.sum("_n").alias("_n"))
    whole = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_n").over(whole), F.lit(0)).alias("_base"))
    before = Window.partitionBy("_block").orderBy("round", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(blocks, "_block").select("round", "_cut", (F.col("_before") + F.col("_base")).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("round", "_cut").orderBy("key", "text_sha256")) - 1
    return cut.withColumn("_inside", inside).join(offsets, ["round", "_cut"]).withColumn("ordinal", F.col("_inside") + F.col("_offset")).drop("_cut", "_inside", "_offset")


def chunked(ordered: DataFrame, size: int, fingerprint: Column, final: bool = True) -> DataFrame:
    """Adds chunk_id and group = ordinal // size; without `final` the last, partial group is held back."""
    if size < 1:
        raise ValueError("a chunk has at least one text")
    rows = ordered.withColumn("group", F.floor(F.col("ordinal") / size))
    ids = rows.groupBy("group").agg(F.collect_list("text_sha256").alias("shas"))  # size hashes a row
    if not final:
        ids = ids.filter(F.size("shas") == size)
    ids = ids.select("group", chunk_id(fingerprint, F.col("shas")).alias("chunk_id"))
    return rows.join(ids, "group")


def plan_lines(chunks: DataFrame) -> DataFrame:
    """A line for each chunk: size, tokens, the order of its shortest prompt, seq = its place."""
    first = F.min_by(F.struct("ord_rank", "ord_file"), F.struct("prompt_tokens", "text_sha256"))
    lines = chunks.groupBy("chunk_id", F.col("group").alias("seq")).agg(F.count(F.lit(1)).alias("size"), F.sum("prompt_tokens").cast("bigint").alias("prompt_tokens"), first.alias("o"))
    return lines.select("chunk_id", F.col("o.ord_rank").alias("ord_rank"), F.col("o.ord_file").alias("ord_file"), "size", "prompt_tokens", "seq")


def new_lines(lines: DataFrame, known: DataFrame) -> DataFrame:
    """Lines whose chunk isn't planned yet."""
    return lines.join(known.select("chunk_id").distinct(), "chunk_id", "left_anti")


def recovered_lines(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Lines of chunks that texts have but the plan lost: their size and earliest file."""
    lines = texts.filter("chunk_id is not null").groupBy("chunk_id").agg(F.count(F.lit(1)).alias("size"), F.min("file_idx").alias("ord_file"))
    return new_lines(lines, known).withColumn("prompt_tokens", F.lit(0).cast("bigint"))


def open_chunks(texts: DataFrame) -> DataFrame:
    """Chunks with a text that isn't done."""
    return texts.filter("chunk_id is not null").groupBy("chunk_id").agg(F.bool_and("done").alias("all_done")).filter(~F.col("all_done")).select("chunk_id")


def mark_done(texts: DataFrame, generated: DataFrame) -> DataFrame:
    """Sets done for texts already generated."""
    hit = generated.select("text_sha256").distinct().withColumn("_hit", F.lit(True))
    return texts.join(hit, "text_sha256", "left").withColumn("done", F.col("done") | F.coalesce("_hit", F.lit(False))).drop("_hit")


def released(texts: DataFrame, lines: DataFrame, already: bool = False) -> tuple[DataFrame, DataFrame]:
    """Frees all texts of open chunks and drops those lines; with `already` (a marker of an earlier run) nothing changes."""
    if already:
        return texts, lines
    free = open_chunks(texts).withColumn("_open", F.lit(True))
    freed = texts.join(free, "chunk_id", "left").withColumn("chunk_id", F.when(F.col("_open").isNull(), F.col("chunk_id"))).drop("_open")
    return freed, lines.join(free.drop("_open"), "chunk_id", "left_anti")


def mismatched_chunks(chunks: DataFrame, fingerprint: Column) -> DataFrame:
    """Chunks whose id doesn't follow from their texts."""
    ids = chunks.groupBy("chunk_id").agg(F.collect_list("text_sha256").alias("shas"))
    return ids.filter(chunk_id(fingerprint, F.col("shas")) != F.col("chunk_id")).select("chunk_id")


def first_cells(placed: DataFrame) -> DataFrame:
    """The cell of each text: that of its first place by (file_idx, row_index, field_position, sentence_index)."""
    return placed.groupBy("text_sha256").agg(F.min_by("cell", F.struct("file_idx", "row_index", "field_position", "sentence_index")).alias("cell"))


def merged_plans(plans: DataFrame) -> DataFrame:
    """One line for each chunk over several datasets' plans: the first by dataset position, then seq."""
    names = [c for c in plans.columns if c != "chunk_id"]
    return plans.groupBy("chunk_id").agg(F.min_by(F.struct(*names), F.struct("dataset_position", "seq")).alias("r")).select("chunk_id", "r.*")
