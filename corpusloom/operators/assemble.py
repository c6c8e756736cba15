"""From verdicts to the published tables: labels, viewer, generations, and their coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.identity import generation_id
from corpusloom.functions.text import file_stem, readable
from corpusloom.schema import JOIN_KEYS


def label_rows(sentences: DataFrame, verdicts: DataFrame, fingerprint: Column, allow_pending: bool) -> DataFrame:
    """sentences with decision, parse_mode, failure_reason, generation_id: one row for each sentence position.

    Unsplit texts were never sent; texts without a verdict are pending, or an error in a complete table.
    """
    v = verdicts.select("text_sha256", F.col("decision").alias("_d"), F.col("parse_mode").alias("_m"), F.col("failure_reason").alias("_f"))
    rows = sentences.join(v, "text_sha256", "left")
    open_ = F.lit("pending") if allow_pending else F.raise_error(F.concat(F.lit("no verdict for text "), F.col("text_sha256"))).cast("string")
    known = ~F.col("unsplit") & F.col("_d").isNotNull()
    return rows.select(
        *sentences.columns,
        F.when(F.col("unsplit"), "skipped_unsplit").when(F.col("_d").isNull(), open_).otherwise(F.col("_d")).alias("decision"),
        F.when(known, F.col("_m")).alias("parse_mode"),
        F.when(F.col("unsplit"), "unsplit_upstream").when(known, F.col("_f")).alias("failure_reason"),
        F.when(known, generation_id(F.col("text_sha256"), fingerprint)).alias("generation_id"),
    )


def labels_table(rows: DataFrame, dataset: str, fingerprint: Column, revision: Column) -> DataFrame:
    """The columns of the labels table, in order, with the file that each row belongs to."""
    keys = [k for k, _ in JOIN_KEYS[dataset]]
    return rows.select("label_id", *keys, "text_sha256", "decision", "parse_mode", "failure_reason", "generation_id", "language", fingerprint.alias("config_fingerprint"), revision.alias("input_revision"), "source_file")


def viewer_table(rows: DataFrame) -> DataFrame:
    """sentence, label, language, region of the sentences with an answer and two letters at least."""
    shown = rows.filter((F.col("decision") != "pending") & readable(F.col("text")))
    return shown.select(F.col("text").alias("sentence"), F.col("decision").alias("label"), "language", file_stem(F.col("source_file")).alias("region"))


def coverage(rows: DataFrame) -> DataFrame:
    """source_file, known, sendable, complete: complete if no sent text lacks a verdict, as when none was sent."""
    sent = ~F.col("unsplit")
    done = sent & (F.col("decision") != "pending")
    return rows.groupBy("source_file").agg(F.count_if(done).alias("known"), F.count_if(sent).alias("sendable"), F.coalesce(F.bool_and(F.when(sent, done)), F.lit(True)).alias("complete"))


def worth_publishing(known: Column, sendable: Column, last: Column) -> Column:
    """A first result, or a hundredth of the file more than last time."""
    step = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.lit(0.01).cast("double") * sendable))
    return ((last == 0) & (known >= 1)) | (known - last >= step)


def owned_generations(labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Label rows whose text ships with this file: the first file that has it. labels: file_idx; texts: text_sha256, file_idx."""
    return labels.filter("generation_id is not null").join(texts.select("text_sha256", "file_idx"), ["text_sha256", "file_idx"], "left_semi").select("text_sha256", "generation_id", "file_idx").distinct()


def generations_table(canonical: DataFrame, wanted: DataFrame, fingerprint: Column) -> DataFrame:
    """The wanted texts' generations, with their published id first."""
    rows = canonical.join(wanted.select("text_sha256").distinct(), "text_sha256", "left_semi")
    return rows.select(generation_id(F.col("text_sha256"), fingerprint).alias("generation_id"), *canonical.columns)


def missing_viewers(ledger: DataFrame) -> DataFrame:
    """Files whose labels are published but whose viewer table isn't."""
    labels = ledger.filter(F.col("path").startswith("labels/")).select(F.substring("path", 8, 10_000).alias("file"))
    viewers = ledger.filter(F.col("path").startswith("viewer/")).select(F.substring("path", 8, 10_000).alias("file"))
    return labels.join(viewers, "file", "left_anti")


def write_by_file(table: DataFrame, path: str, files: DataFrame | None = None) -> None:
    """One folder for each source file, replaced as a whole; large ones are written by several tasks.

    `files` has the source_file of all files that were worked on: those of them that got no row lose what an earlier run
    wrote, since an empty table must not exist. Other files are left alone.
    """
    spark = table.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    any_there = lambda: fs.exists(at) and any(x.isDirectory() and x.getPath().getName().startswith("source_file=") for x in fs.listStatus(at))
    names = lambda: set(spark.read.schema("source_file string").parquet(path).inputFiles()) if any_there() else set()
    before = names() if files is not None else set()
    table.hint("rebalance", "source_file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("source_file").parquet(path)
    if files is None or not any_there():
        return
    # What was written has new files, so that the table needn't be asked again.
    written = spark.createDataFrame(sorted({(f.rsplit("/", 2)[-2],) for f in names() - before}), "name string")
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1)
    there = spark.read.schema("source_file string").parquet(path).select("source_file", folder.alias("folder"), F.substring_index(folder, "/", -1).alias("name")).distinct()
    stale = there.join(files.select("source_file").distinct(), "source_file", "left_semi").join(written, "name", "left_anti")
    for r in stale.toLocalIterator():
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(r.folder)), True)


def write_generations(table: DataFrame, path: str, rows: int = 50_000) -> None:
    """Files of a bounded number of rows, in canonical order."""
    table.repartitionByRange("text_sha256").sortWithinPartitions("text_sha256").write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)


#: The published recipe: input, labels by the dataset's keys, raw outputs of the rows that have one.
RECIPE = "SELECT i.*, l.decision, g.raw_output FROM {input} i JOIN {labels} l USING ({keys}) LEFT JOIN {generations} g USING (generation_id)"
