import zlib
from collections import Counter

import pytest

from corpusloom.llm.sharding import jump_shard, shard_documents
from tests.llm.helpers import F, documents, rows


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards_are_those_of_the_published_loop(spark):
    keys = [0, 1, 2, -1, 7**20, -(1 << 63), (1 << 63) - 1, *range(1000, 1300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 200):
        got = {r.k: r.s for r in df.select("k", jump_shard(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(4000)])
    got = shard_documents(docs, 8).collect()
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert abs(sum(r.grown_shard == 8 for r in got) - 4000 / 9) < 100
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.3 * min(sizes.values())
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert all(r.text_crc32 == zlib.crc32(f"text {r.doc_id}".encode()) and r.size == len(f"text {r.doc_id}") + 1 for r in got)


def test_edge_rows(spark):
    assert rows(shard_documents(documents(spark, []), 8)) == []
    got = rows(shard_documents(documents(spark, [(None, None), (5, "é"), (5, "é")]), 8))
    assert sorted(r[:4] for r in got if r[0] == 5) == [(5, 3, zlib.crc32("é".encode()), "key")] * 2
    assert sorted(r[5] for r in got if r[0] == 5) in ([0, 1], [1, 2])
    assert (None, 1, 0, "key") in [r[:4] for r in got]


def test_file_order_or_an_error(spark, tmp_path):
    """Files of one task that the writer cut up keep their order; where no order is known, there is an error, not another order."""
    docs = documents(spark, [(i, f"text {i}") for i in range(60)])
    docs.repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.option("maxRecordsPerFile", 7).parquet(f"{tmp_path}/cut")
    got = shard_documents(spark.read.parquet(f"{tmp_path}/cut"), 4, in_file_order=True).collect()
    for s in range(4):
        own = [r.doc_id for r in sorted((r for r in got if r.shard == s), key=lambda r: r.slot)]
        assert own == sorted(own) and [r.slot for r in sorted((r for r in got if r.shard == s), key=lambda r: r.slot)] == list(range(len(own)))
    for i, f in enumerate(sorted((tmp_path / "cut").glob("part-*"))):
        f.rename(tmp_path / "cut" / f"chunk{i}.parquet")
        f.with_name(f".{f.name}.crc").unlink()
    with pytest.raises(Exception, match="no order is known for chunk"):
        shard_documents(spark.read.parquet(f"{tmp_path}/cut"), 4, in_file_order=True).collect()
    with pytest.raises(ValueError, match="aren't read from files"):
        shard_documents(docs, 4, in_file_order=True)
    with pytest.raises(ValueError, match="_metadata"):
        shard_documents(spark.read.parquet(f"{tmp_path}/cut").withColumn("_metadata", F.lit(1)), 4, in_file_order=True)
