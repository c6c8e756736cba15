import random
from collections import Counter

import corpus_pipeline
from corpusloom.llm.decontaminate import Items, leaks
from tests.llm.helpers import F, documents
from tests.llm.test_near_copies import brute

PROSE = "the river runs over stones and trees while people walk slowly under the grey morning sky of town near ice".split()
ITEM = "zeta eta theta iota kappa lambda mu nu xi omicron pi rho"


def tables(spark, tmp_path):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(PROSE) + rng.choice(["", "s", "ly"]) for _ in range(n)) + "."
    texts = []
    for i in range(300):
        text = say(60)
        if i % 5 == 1:
            text = " ".join(w + rng.choice(["***", "%%%"]) for w in text.split())
        if i % 20 == 2:
            text = f"{text} {ITEM} {say(5)}"
        texts.append((i, text))
    texts += [(300 + i, texts[i * 10][1]) for i in range(20)]  # copies
    for i in range(20):  # and near ones
        words = texts[i * 10 + 5][1].split()
        words[rng.randrange(60)] = "other"
        texts.append((320 + i, " ".join(words)))
    source = {i: f"src{i % 4}" for i, _ in texts}
    documents(spark, texts, source).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 1), 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return dict(texts)


def assert_curriculum(shards, order):
    """Each shard holds its own part of the training order, so that repeats stay apart."""
    of = {r.doc_id: r.shard for r in shards}
    for shard in range(8):
        got = sorted((r.slot, r.doc_id) for r in shards if r.shard == shard)
        assert [s for s, _ in got] == list(range(len(got)))
        assert [d for _, d in got] == [d for d in order if of[d] == shard]
    assert all(r.text for r in shards)


def test_each_stage_decides_on_what_the_one_before_kept(spark, tmp_path):
    texts = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, ids, names = docs.columns, set(texts), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixture", "sharding"]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/out-{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        seen = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name != "sharding":
            assert docs.columns == columns
        if name == "quality":
            junk = {i for i in ids if "***" in texts[i]}
            assert set(seen) == ids - junk
        elif name == "near_duplicates":
            order = sorted(ids)
            roots, _ = brute([texts[i] for i in order])
            assert set(seen) == {order[r] for r in set(roots)} and len(seen) <= len(ids) - 32
        elif name == "decontamination":
            items = Items.of([(1, ITEM)])
            order = sorted(ids)
            bad = {order[x[0]] for x in leaks([texts[i].encode() for i in order], items).tolist()}
            assert bad and set(seen) == ids - bad
        elif name == "mixture":
            assert set(seen) <= ids and max(seen.values()) == 2
            rows = seen
            order = [r.doc_id for r in stage(spark, spark.read.parquet(f"{tmp_path}/out-decontamination"), str(tmp_path)).collect()]
        else:
            assert_curriculum(docs.collect(), order)
            assert seen == rows and set(docs.columns) >= {"shard", "slot", "grown_shard"}
        ids = set(seen)


def test_run_over_empty_tables(spark, tmp_path):
    tables(spark, tmp_path)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").filter("false").write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 200


def test_run_over_rows_with_nulls_repeats_long_texts_and_clashing_columns(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumns({"_gone": F.lit(1), "_kept": F.lit(1), "shard": F.lit("s"), "slot": F.lit("t"), "position": F.lit("p")})
    long = "the river runs over stones under the grey sky. " * 4000
    odd = documents(spark, [(None, None), (None, "the people walk slowly under trees"), (900, None), (901, ""), (902, long), (902, long), (5, "the river runs over stones")])
    docs.unionByName(odd, allowMissingColumns=True).write.parquet(f"{tmp_path}/odd/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/odd/{name}.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert len(got) > 200 and {"text", "source", "shard", "slot"} <= set(got[0].asDict())
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
