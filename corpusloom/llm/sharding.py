"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in Column expressions only.

A row's shard depends on its key and the number of shards alone; there is no ring table. Going from n to
n + 1 shards moves one row in n + 1, each of them into the new shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import cuts, prefix_sums, table

#: Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF


def _next(key: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2**64, in 16-bit parts of the multiplier so that no long overflows."""
    a = [(MULTIPLIER >> (16 * i)) & 0xFFFF for i in range(4)]
    low, high = key.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(key, 32)
    half = lambda x: F.shiftleft(x.bitwiseAND(F.lit(0xFFFF)), 16)
    l1, l3, h1 = low * F.lit(a[1]), low * F.lit(a[3]), high * F.lit(a[1])
    below = low * F.lit(a[0]) + half(l1) + F.lit(1)
    above = F.shiftrightunsigned(below, 32) + F.shiftrightunsigned(l1, 16) + low * F.lit(a[2]) + half(l3) + high * F.lit(a[0]) + half(h1)
    return F.shiftleft(above.bitwiseAND(F.lit(LOW)), 32).bitwiseOR(below.bitwiseAND(F.lit(LOW)))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, from 0 to shards - 1, of a long key. Each round jumps ahead by one shard at least."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def round_(state: Column, _: Column) -> Column:
        k = _next(state["k"])
        ahead = (state["j"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(k, 33) + F.lit(1)).cast("double"))
        go = state["j"] < F.lit(shards)
        return F.struct(
            F.when(go, k).otherwise(state["k"]).alias("k"),
            F.when(go, state["j"]).otherwise(state["b"]).alias("b"),
            F.when(go, F.floor(ahead).cast("bigint")).otherwise(state["j"]).alias("j"),
        )

    start = F.struct(key.cast("bigint").alias("k"), F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))
    rounds = min(shards, 48)  # nearly every key is done after a few
    done = F.aggregate(F.array_repeat(F.lit(0), rounds), start, round_)
    if shards > rounds:
        done = F.when(done["j"] >= shards, done).otherwise(F.aggregate(F.array_repeat(F.lit(0), shards), done, round_))
    return done["b"].cast("int")


#: Hex digits of a place that tell the file.
FILE_DIGITS = 8


def file_order(docs: DataFrame) -> Column:
    """Where a row stands in the files that docs was read from, as hex digits that sort alike.

    Spark numbers the files of a sorted write in order, so this is the order in which the rows were sorted. Rows that aren't read from files, or have a column
    of their own named _metadata, are refused; files with other names than Spark's are an error when they are read, as their order isn't known.
    """
    name = F.col("_metadata.file_name")
    part, cut = (F.regexp_extract(name, "^part-([0-9]+)(?:.*-c([0-9]+)\\.)?", k) for k in (1, 2))
    hexed = lambda text, digits: F.lpad(F.hex(F.when(text == "", "0").otherwise(text).cast("bigint")), digits, "0")
    known = F.when(part == "", F.raise_error(F.concat(F.lit("no order is known for "), name)).cast("string")).otherwise(hexed(part, FILE_DIGITS))
    place = F.concat(known, hexed(cut, 6), F.lpad(F.hex(F.col("_metadata.row_index")), 12, "0"))
    if "_metadata" in docs.columns:
        raise ValueError("a column of its own named _metadata hides the files' order")
    try:
        docs.select(place)
    except AnalysisException as e:
        raise ValueError("rows that aren't read from files have no order of files") from e
    return place


def shard_documents(docs: DataFrame, shards: int, in_file_order: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Deals documents out to shards by doc_id.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law ('key'), shard, slot (gapless from 0 within
    the shard, in the order of md5(doc_id), so a shard reads in shuffled order), grown_shard (the shard
    with one shard more) and the columns of `keep`. With in_file_order, slots follow the order of the rows in the files that docs
    was read from, which must be files that Spark wrote (see file_order): each shard then holds its part of that order. One output row for each input row. A null doc_id is keyed as 0; a
    null text counts as empty for size and is a text of its own only in that its crc is that of the empty text; repeated rows take
    neighbouring slots; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))
    place = file_order(docs) if in_file_order else None
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"),
        (F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) if place is None else place).alias("_digest"),
        F.lit(1).cast("bigint").alias("_one"),
        F.struct(*keep).alias("_kept") if keep else F.lit(None).alias("_kept"),
    )
    placed = prefix_sums(slim, ["shard"], "_one", ["doc_id", "text_crc32", "size"], "_digest", cuts(docs) if place is None else FILE_DIGITS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("before").alias("slot"), "grown_shard", *[F.col(f"_kept.{c}").alias(c) for c in keep])


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 8)


def _jump_sql(n: int) -> str:
    """Unrolled rounds over HUGEINT."""
    sql, j = f"SELECT id, CAST(CASE WHEN key < 0 THEN key + 18446744073709551616 ELSE key END AS HUGEINT) AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM keyed", "j"
    for _ in range(n):
        step = f"((k * {MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT)"
        sql = f"SELECT id, CASE WHEN j < {n} THEN nk ELSE k END AS k, CASE WHEN j < {n} THEN j ELSE b END AS b, CASE WHEN j < {n} THEN CAST(floor(CAST({j} + 1 AS DOUBLE) * (2147483648.0::DOUBLE / CAST(nk // 8589934592 + 1 AS DOUBLE))) AS BIGINT) ELSE j END AS j FROM (SELECT *, {step} AS nk FROM ({sql}))"
    return f"SELECT id, CAST(b AS INTEGER) AS shard FROM ({sql})"


def crc_sql(text: str) -> str:
    """The unsigned checksum of a text that isn't null, by the column `t` of crc_table_sql()."""
    steps = f"list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1]))"
    return f"xor({steps}, 4294967295::BIGINT)"


#: The table of the checksum comes from its polynomial.
_STEP = "(CASE WHEN {0} % 2 = 1 THEN xor({0} // 2, 3988292384::BIGINT) ELSE {0} // 2 END)"


def crc_table_sql() -> str:
    inner = "SELECT i, i AS c FROM range(256) r(i)"
    for _ in range(8):
        inner = f"SELECT i, {_STEP.format('c')} AS c FROM ({inner})"
    return f"SELECT list(c ORDER BY i) AS t FROM ({inner})"


ORACLE = {
    "op6_sharding": f"""
WITH crc_table AS MATERIALIZED ({crc_table_sql()}),
keyed AS (SELECT DISTINCT coalesce(doc_id, 0) AS id, coalesce(doc_id, 0)::HUGEINT AS key FROM documents),
now8 AS ({_jump_sql(8)}), now9 AS ({_jump_sql(9)}),
base AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, {crc_sql("coalesce(text, '')")} AS text_crc32 FROM documents, crc_table)
SELECT b.doc_id, b.size, b.text_crc32, 'key' AS law, a.shard,
  row_number() OVER (PARTITION BY a.shard ORDER BY md5(coalesce(CAST(b.doc_id AS VARCHAR), '')), b.doc_id, b.text_crc32, b.size) - 1 AS slot, g.shard AS grown_shard
FROM base b JOIN now8 a ON a.id = coalesce(b.doc_id, 0) JOIN now9 g ON g.id = coalesce(b.doc_id, 0)"""
}
