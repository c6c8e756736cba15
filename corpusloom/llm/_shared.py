"""What the training-data operators share: tables in the shared folder, Arrow batches, ordered prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of bytes other than ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder all machines share: the cluster's spark.checkpoint.dir, else one in the warehouse; an error if a cluster has only a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local") and spark.conf.get("spark.sql.warehouse.dir").startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/corpusloom"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Deletes every staged table; call it once no result that was read from them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def wide(df: DataFrame, least: int = 1) -> int:
    """Partitions for work whose size follows the cluster's own setting."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def lowered(text: Column) -> Column:
    """A to Z lower-cased, nothing else touched; null counts as empty. `lower` is fast for ASCII, where it does the same."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def octets(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about `most` bytes of text each, one row at least."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def prefix_sums(df: DataFrame, keys: list[str], amount: str, order: list[str], digest: str, digits: int) -> DataFrame:
    """Adds `before`: the sum of `amount` over the rows of the same keys that come earlier.

    The order is (digest, *order), where `digest` is a column of hex digits. A group is cut by the first
    `digits` of them, so that no task holds a whole group, however hot; only one row for each group and
    cut takes part in the running sum over cuts. The result doesn't depend on `digits`.
    """
    from pyspark.sql import Window

    # Keys that can't be null, under one name on both sides: the window's shuffle then serves the join, too.
    names = [f"_key{i}" for i in range(2 * len(keys))]
    plain = [c for k in keys for c in (F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit("")))]
    cut = df.withColumns(dict(zip(names, plain, strict=True)) | {"_cut": F.substring(digest, 1, digits)})
    group = [*names, "_cut"]
    sums = cut.groupBy(*group).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*names).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*group).orderBy(digest, *order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return cut.join(sums, group).select(*df.columns, (F.col("_inside") + F.col("_base")).alias("before"))


def cuts(df: DataFrame, per_cut: int = 1 << 20, least: int = 2) -> int:
    """Hex digits for prefix_sums, so that a cut of all rows holds about per_cut of them."""
    digits, rows = least, df.count()
    while rows >> (4 * digits) > per_cut:
        digits += 1
    return digits
