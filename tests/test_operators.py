import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.identity import chunk_id
from corpusloom.operators import assemble, geo, planning, quality, resolve, schedule, stats
from corpusloom.plans import queries
from corpusloom.sources import ledgers, parts, readers


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=str)


def test_readers(spark):
    d = spark.createDataFrame([("f", "a", "k", "one. two.", "en", "split", ["one.", "two."]), ("f", "b", "k", "eins zwei", None, "not_detected", None)], "source_file string, description_identity string, tag_key string, original_text string, language_code string, split_status string, sentences array<string>")
    got = readers.with_identity(readers.read_description(d), "description")
    assert rows(got, "description_identity", "sentence_index", "text", "unsplit") == [("a", 0, "one.", False), ("a", 1, "two.", False), ("b", 0, "eins zwei", True)]
    assert got.select("label_id").distinct().count() == 3
    for bad in ("odd", None):
        with pytest.raises(Exception, match="unknown status"):
            readers.read_description(d.withColumn("split_status", F.lit(bad).cast("string"))).count() or readers.read_description(d.withColumn("split_status", F.lit(bad).cast("string"))).collect()
    with pytest.raises(Exception, match="no sentences"):
        readers.read_description(d.withColumn("split_status", F.lit("split"))).collect()
    w = spark.createDataFrame([("f", "p", "a b", "en", ["a", "b"], "success", "c", "fr", None, "unsupported_language"), ("f", "q", "", None, None, "empty_text", None, None, None, "absent")], "source_file string, polygon_id string, website_text string, website_language string, website_sentences array<string>, website_sentence_status string, contact_website_text string, contact_website_language string, contact_website_sentences array<string>, contact_website_sentence_status string")
    assert rows(readers.read_website(w), "polygon_id", "field", "sentence_index", "text", "unsplit") == [("p", "contact_website", 0, "c", True), ("p", "website", 0, "a", False), ("p", "website", 1, "b", False)]


def test_files_and_patterns(spark, tmp_path):
    for name in ("v1/data/b/x.parquet", "v1/data/a.parquet", "v1/other/c.parquet"):
        spark.range(1).coalesce(1).write.parquet(str(tmp_path / name))
    files = readers.list_files(spark, str(tmp_path), ("*/data/*.parquet",))
    assert files.count() == 2 and [r[0] for r in files.select("index").orderBy("index").collect()] == [0, 1]


def test_scan_counts_of_scripted_files(spark):
    data = [(0, "u1", True), (0, "x", False), (0, "y", False), (0, "x", False), (0, "u2", True), (1, "y", False), (1, "z", False)]
    s = spark.createDataFrame(data, "file_idx int, text string, unsplit boolean").withColumn("text_sha256", F.sha2("text", 256))
    texts = planning.unique_texts(s)
    counts = planning.scan_counts(s, texts)
    assert rows(counts, "file_idx", "sentences", "unsplit", "new_unique") == [(0, 5, 2, 2), (1, 2, 0, 1)]
    assert rows(planning.plan_report(counts, texts.withColumn("chunk_id", F.lit(None).cast("string")))) == [(2, 7, 2, 3, 0)]


def test_chunks_are_a_partition_whatever_the_order(spark):
    texts = spark.range(1003).select(F.sha2(F.col("id").cast("string"), 256).alias("text_sha256"), (F.col("id") % 3).alias("file_idx"), (F.col("id") % 17).alias("prompt_tokens"))
    a = planning.chunked(planning.file_ordinal(texts), 100, F.lit("f"))
    b = planning.chunked(planning.file_ordinal(texts.repartition(9)), 100, F.lit("f"))
    assert rows(a, "text_sha256", "chunk_id") == rows(b, "text_sha256", "chunk_id")
    assert sorted(r[0] for r in a.groupBy("chunk_id").count().select("count").collect()) == [3] + [100] * 10
    assert planning.chunked(planning.file_ordinal(texts), 100, F.lit("f"), final=False).count() == 1000
    assert planning.mismatched_chunks(a, F.lit("f")).count() == 0 and planning.mismatched_chunks(a, F.lit("g")).count() == 11
    with pytest.raises(ValueError):
        planning.chunked(texts, 0, F.lit("f"))


def test_uniform_order_is_even_over_cells(spark):
    cells = ["A"] * 6 + ["B"] * 3 + ["C"] * 3
    t = spark.createDataFrame([(c, i) for i, c in enumerate(cells)], "cell string, i int").withColumn("text_sha256", F.sha2(F.col("i").cast("string"), 256))
    order = [r.cell for r in planning.uniform_ordinal(t).orderBy("ordinal").collect()]
    assert [sorted(order[k : k + 3]) for k in (0, 3, 6)] == [["A", "B", "C"]] * 3 and order[9:] == ["A"] * 3


def test_progress(spark):
    expected = spark.createDataFrame([("c", "a", 0), ("c", "b", 1)], "chunk_id string, text_sha256 string, position int")
    found = spark.createDataFrame([("c", "a", "p2"), ("c", "a", "p1"), ("c", "z", "p1")], "chunk_id string, text_sha256 string, part_id string")
    r = resolve.chunk_progress(expected, found).first()
    assert (r.state, r.missing, r.owners, r.foreign) == ("partial", ["b"], {"a": "p1"}, ["z"])


def test_verdicts_don_t_depend_on_order_or_copies(spark):
    data = [(f"s{i % 7}", f"x</think>{'yes' if i % 3 else 'no'}", False, f"c/p{i % 5}", i) for i in range(60)]
    df = spark.createDataFrame(data, "text_sha256 string, raw_output string, truncated boolean, part_key string, row_index long")
    want = rows(resolve.verdicts(df))
    assert rows(resolve.verdicts(df.orderBy(F.rand(1)).unionByName(df.limit(20)))) == want and len(want) == 7


def test_labels(spark):
    s = spark.createDataFrame([("1", "a", False), ("2", "b", False), ("3", "c", True)], "label_id string, text_sha256 string, unsplit boolean")
    v = spark.createDataFrame([("a", "yes", "exact", None), ("c", "no", "exact", None)], "text_sha256 string, decision string, parse_mode string, failure_reason string")
    got = assemble.label_rows(s, v, F.lit("f"), True)
    assert [r[1:3] + (r[3] is None,) for r in rows(got, "label_id", "decision", "failure_reason", "generation_id")] == [("yes", None, False), ("pending", None, True), ("skipped_unsplit", "unsplit_upstream", True)]
    with pytest.raises(Exception, match="no verdict"):
        assemble.label_rows(s, v, F.lit("f"), False).collect()
    empty = assemble.coverage(got.filter("unsplit").withColumn("source_file", F.lit("x"))).first()
    assert (empty.known, empty.sendable, empty.complete) == (0, 0, True)


def test_cells(spark):
    polygons = spark.createDataFrame([("p1", None, 2.0, 1), ("p2", 48.0, 2.0, 2), ("p3", 50.0, 4.0, 3)], "polygon_id string, lat double, lon double, row_index int")
    links = spark.createDataFrame([("d1", "p2"), ("d1", "p1"), ("d2", "p3"), ("d2", "p2"), ("d3", "p1")], "document_id string, polygon_id string")
    assert rows(geo.document_cells(links, polygons, geo.grid_cell)) == [("d1", "2/48"), ("d2", "2/48")]
    data = [("yes", "c")] * 6 + [("no", "c")] * 4 + [("yes", "d"), ("failed", "d"), ("no", None)]
    df = spark.createDataFrame(data, "decision string, cell string")
    assert rows(geo.located(df)) == [(12, 11)]
    assert rows(geo.cell_shares(geo.binned(df))) == [("c", 6, 4, 0.6), ("d", 1, 0, None)]
    assert rows(geo.global_share(geo.binned(df.limit(0)))) == [(0, 0.0)]


def test_scores(spark):
    df = lambda xs: spark.createDataFrame([("en", *x) for x in xs], "language string, expected string, predicted string")
    r = quality.scores(quality.confusion(df([("yes", "yes"), ("no", "no"), ("yes", None), ("no", "yes")]))).first()
    assert (r.tp, r.fn, r.tn, r.fp, r.failed, r.accuracy, r.recall, r.failed_rate) == (1, 0, 1, 1, 1, 0.5, 1.0, 0.25)
    r = quality.scores(quality.confusion(df([("yes", "yes")] * 3 + [("yes", "no")] + [("no", "no")] * 4 + [("no", "yes")] * 2))).first()
    assert (r.precision, r.recall) == (0.6, 0.75) and math.isclose(r.mcc, 10 / math.sqrt(600))
    with pytest.raises(Exception, match="no items"):
        quality.scores(quality.confusion(df([("yes", "yes")]).limit(0))).collect()


def plain_gate(items, resamples, seed):
    """The bootstrap over item arrays, language by language, from one stream."""
    rng = np.random.default_rng(seed)

    def metrics(e, p):
        tp, fn, tn, fp = ((e & (p == 1)).sum(-1), (e & (p == 0)).sum(-1), (~e & (p == 0)).sum(-1), (~e & (p == 1)).sum(-1))
        with np.errstate(all="ignore"):
            pr, re = np.nan_to_num(tp / (tp + fp)), np.nan_to_num(tp / (tp + fn))
            f1 = np.nan_to_num(2 * pr * re / (pr + re))
            mcc = np.nan_to_num((tp * tn - fp * fn) / np.sqrt(1.0 * (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
        return np.stack([f1, mcc, (p == 2).mean(-1), (tp + tn) / e.shape[-1]])

    total, languages = np.zeros((4, resamples)), sorted({x[0] for x in items})
    for lang in languages:
        code = {"yes": 1, "no": 0, None: 2}
        e, a, b = (np.array(c) for c in zip(*[(x[2] == "yes", code[x[3]], code[x[4]]) for x in items if x[0] == lang]))
        at = rng.integers(len(e), size=(resamples, len(e)))
        total += metrics(e[at], b[at]) - metrics(e[at], a[at])
    total /= len(languages)
    return np.quantile(total, 0.05, axis=1), np.quantile(total, 0.95, axis=1)


def gate_items(n=120):
    rng = np.random.default_rng(9)
    say = lambda p: rng.choice(["yes", "no", None], p=p)
    return [(lang, f"{lang}{i:04d}", "yes" if i % 2 else "no", say([0.5, 0.4, 0.1]), say([0.45, 0.45, 0.1])) for lang in ("de", "en", "fr") for i in range(n)]


def test_gate_equals_a_plain_bootstrap(spark):
    items = gate_items()
    df = spark.createDataFrame(items, "language string, item_id string, expected string, reference string, candidate string")
    low, high = plain_gate(items, 500, 3)
    r = quality.exact_gate(df.orderBy(F.rand(5)), 500, 3).first()
    assert np.allclose([r.f1_lower, r.mcc_lower, r.accuracy_lower, r.failed_rate_upper], [low[0], low[1], low[3], high[2]])
    assert not r.passed and r.reasons and r.worst_language in ("de", "en", "fr")
    same = quality.exact_gate(df.withColumn("candidate", F.col("reference")), 50).first()
    assert same.passed and same.agreement == 1.0 and same.f1_lower == 0.0
    with pytest.raises(Exception, match="have no candidate"):
        quality.complete_pairs(df.withColumnRenamed("reference", "predicted").drop("candidate"), df.filter("item_id <> 'de0000'").withColumnRenamed("candidate", "predicted")).collect()


def test_useful_fraction(spark):
    schema = "gpu string, gpu_key string, walltime_s int, engine_ready_at string, last_result_at string, started_at string, ended_at string, env_ready_seconds double, stopped string"
    job = lambda gpu, s: (gpu, "", 1000, "2026-01-01T00:00:00Z", f"2026-01-01T00:{s // 60:02d}:{s % 60:02d}Z", "2026-01-01T00:00:00Z", "2026-01-01T00:15:00Z", None, None)
    df = spark.createDataFrame([job("a", 480), job("b", 600), ("c", "", 0, None, None, None, None, None, None)], schema)
    assert rows(stats.useful_fraction(df), "gpu", "jobs", "useful_fraction", "stopped_early") == [("a", 1, 0.48, 0.0), ("b", 1, 0.6, 0.0), (None, 2, 0.54, 0.0)]
    assert rows(stats.useful_fraction(df.limit(0)), "jobs", "useful_fraction") == [(0, None)]


def test_capacity_and_launches(spark):
    nodes = spark.createDataFrame([("x", 24, 0, 24, 2), ("x", 0, 10, 0, 1)], "cluster string, free_slots int, freeable_slots int, busy_slots int, gpus_per_node int")
    assert rows(schedule.free_gpus(nodes, False)) == [("x", 1)] and rows(schedule.free_gpus(nodes, True)) == [("x", 2)]
    lines = [(f"c{i}", 100) for i in range(10)]
    plan = schedule.LaunchPlan(4, 2).fill([("s", "a", 3, 150.0), ("t", "b", 2, 50.0)], lines, ["c0"])
    assert [(x.site, x.chunks) for x in plan] == [("s", ("c1",)), ("s", ("c2",)), ("t", ("c3",)), ("t", ("c4",))]
    assert {k: len(v) for k, v in schedule.by_site(plan).items()} == {"s": 2, "t": 2}
    p = spark.createDataFrame([(c, n, i) for i, (c, n) in enumerate(lines)], "chunk_id string, size int, seq int")
    taken = spark.createDataFrame([("c1",)], "chunk_id string")
    assert [r[0] for r in schedule.greedy_prefix(p, taken, F.lit(250)).orderBy("seq").select("chunk_id").collect()] == ["c0", "c2"]
    assert rows(schedule.greedy_prefix(p, taken, F.lit(1)), "chunk_id") == [("c0",)]


def test_launch_plan_reaches_all_sites_and_orders(spark, tmp_path):
    spark.range(1, 10_001).selectExpr("id AS s_suppkey", "id % 25 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(5000).selectExpr("id AS o_orderkey", "500L AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    slots = schedule.ranked_slots(queries._slots(spark, str(tmp_path)), 480.0).orderBy("rank").collect()
    want = schedule.LaunchPlan(12, 4).fill([(str(r.site), str(r.cluster), r.free_nodes, r.useful) for r in slots], [(str(i), 500) for i in range(5000)], [])
    got = rows(queries.launch_plan(spark, str(tmp_path)))
    assert got == sorted([(x.index, x.site, x.cluster, len(x.chunks)) for x in want], key=str)
    assert len(got) == 12 and sum(r[3] for r in got) > 2000


def test_launch_plan_reads_orders_only_as_far_as_needed(spark, tmp_path, monkeypatch):
    spark.range(1, 101).selectExpr("id AS s_suppkey", "id % 25 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(50_000).selectExpr("id AS o_orderkey", "5000L AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    left, fill = [], schedule.LaunchPlan.fill

    def watched(self, ranked, lines, taken):
        lines = iter(lines)
        out = fill(self, ranked, lines, taken)
        left.append(next(lines, None))
        return out

    monkeypatch.setattr(schedule.LaunchPlan, "fill", watched)
    handed = []
    monkeypatch.setattr(schedule, "_Lines", type("Lines", (schedule._Lines,), {"__init__": lambda self, lines, taken, f=schedule._Lines.__init__: (handed.append(lines), f(self, lines, taken))[1]}))
    assert queries.launch_plan(spark, str(tmp_path)).count() == 12
    assert left[0] is not None and type(handed[0]).__name__ == "generator"


def test_ledgers(spark, tmp_path):
    path = str(tmp_path / "l.jsonl")
    ledgers.append_ledger(path, [{"k": "a", "v": 1}, {"k": "b", "v": 2}])
    with open(path, "a") as f:
        f.write('{"k": "a", "v"')
    torn = ledgers.read_ledger(spark, path, "k string, v int")
    assert rows(torn, "seq", "k", "v") == [(0, "a", 1), (1, "b", 2)]
    ledgers.append_ledger(path, [{"k": "a", "v": 3}])
    last = ledgers.last_wins(ledgers.read_ledger(spark, path, "k string, v int"), "k").orderBy("first_seq")
    assert [(r.k, r.v) for r in last.collect()] == [("a", 3), ("b", 2)]
    with open(path, "a") as f:
        f.write("bad\n")
    with pytest.raises(Exception, match="corrupt ledger line 4"):
        ledgers.read_ledger(spark, path, "k string, v int").collect()
    assert ledgers.needs_compaction(103, 1) and not ledgers.needs_compaction(102, 1)


def test_parts(spark, tmp_path):
    import hashlib
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq

    for chunk, value in (("c1", "x"), ("c2", "y")):
        buffer = io.BytesIO()
        pq.write_table(pa.table({"text_sha256": [value]}), buffer)
        data = buffer.getvalue()
        name = hashlib.sha256(data).hexdigest()
        folder = tmp_path / "parts" / "fp" / chunk
        folder.mkdir(parents=True)
        (folder / f"{name}.parquet").write_bytes(data if chunk == "c1" else data + b"!")
        (folder / f"{name}.json").write_text(json.dumps({"part_id": name, "text_sha256s": [value]}) if chunk == "c1" else "{")
    assert sorted(r.valid for r in parts.verified_paths(spark, str(tmp_path / "parts")).collect()) == [False, True]
    got = parts.read_valid_parts(spark, str(tmp_path / "parts"), "text_sha256 string").collect()
    assert [(r.text_sha256, r.row_index) for r in got] == [("x", 0)] and got[0].part_key.startswith("fp/c1/")
    assert rows(parts.read_manifests(spark, str(tmp_path / "parts/*/*/*.json")), "chunk_id", "text_sha256") == [("c1", "x")]
    with pytest.raises(KeyError):
        parts.stamped(spark.range(1), {"gpu": "x"})


def test_chunk_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("c", "b", 2), ("c", "a", 2), ("d", "z", 1)], "chunk_id string, text_sha256 string, prompt_tokens int")
    parts.write_chunks(df, str(tmp_path / "chunks"))
    assert [r.text_sha256 for r in parts.read_chunk(spark, str(tmp_path / "chunks"), "c").collect()] == ["a", "b"]
    assert spark.range(1).select(chunk_id(F.lit("f"), F.array(F.lit("b"), F.lit("a")))).first()[0] == spark.range(1).select(chunk_id(F.lit("f"), F.array(F.lit("a"), F.lit("b")))).first()[0]


def test_appended_parts_are_named_by_their_bytes_and_read_back(spark, tmp_path):
    root = f"{tmp_path}/results"
    data = [(f"h{i:03}", f"fp{i % 2}", f"c{i % 3}", f"</think>{i}") for i in range(300)]
    results = spark.createDataFrame(data, "text_sha256 string, config_fingerprint string, chunk_id string, raw_output string")
    parts.append_results(results, root, rows=20)
    parts.append_results(results.limit(0), root)
    found = parts.verified_paths(spark, root).collect()
    assert len(found) >= 18 and all(r.valid for r in found) and {r.key.split("/")[1] for r in found} == {"c0", "c1", "c2"}
    back = parts.read_valid_parts(spark, root, results.schema.simpleString()[7:-1].replace(":", " "))
    assert sorted(tuple(r)[:4] for r in back.collect()) == sorted(data)
    named = parts.read_manifests(spark, f"{root}/*/*/*.json").collect()
    assert sorted(r.text_sha256 for r in named) == sorted(d[0] for d in data) and {r.part_id for r in named} == {r.key.split("/")[2].removesuffix(".parquet") for r in found}
    again = len(found)
    parts.append_results(results.coalesce(1).sortWithinPartitions("text_sha256"), root)
    parts.append_results(results.coalesce(1).sortWithinPartitions("text_sha256"), root)
    assert parts.verified_paths(spark, root).count() == again + 6  # the second time adds nothing
    victim = sorted(tmp_path.glob("results/*/*/*.parquet"))[0]
    victim.write_bytes(victim.read_bytes()[:-1] + b"x")
    victim.with_name(f".{victim.name}.crc").unlink(missing_ok=True)  # only the local file system has one
    assert parts.quarantine(spark, root, f"{tmp_path}/bad") == [str(victim.relative_to(tmp_path / "results"))]
    assert all(r.valid for r in parts.verified_paths(spark, root).collect()) and parts.verified_paths(spark, root).count() == again + 5


def test_files_without_rows_lose_their_tables(spark, tmp_path):
    from corpusloom.operators import assemble

    path, schema = f"{tmp_path}/viewer", "sentence string, source_file string"
    rows = lambda *x: spark.createDataFrame(list(x), schema)
    files = spark.createDataFrame([("v/f1.parquet",), ("v/f2.parquet",), ("new",)], "source_file string")
    assemble.write_by_file(rows(("a", "v/f1.parquet"), ("b", "v/f2.parquet"), ("c", "other")), path)
    assemble.write_by_file(rows(("d", "v/f1.parquet")), path, files)
    assert {(r.sentence, r.source_file) for r in spark.read.parquet(path).collect()} == {("d", "v/f1.parquet"), ("c", "other")}
    assemble.write_by_file(rows(), path, files)
    assert {(r.sentence, r.source_file) for r in spark.read.parquet(path).collect()} == {("c", "other")}
    asked = spark.sparkContext.accumulator(0)
    once = F.udf(lambda x: asked.add(1) or x, "string").asNondeterministic()
    assemble.write_by_file(rows(("e", "v/f2.parquet"), ("f", "new")).withColumn("sentence", once("sentence")), path, files)
    assert {r.source_file for r in spark.read.parquet(path).collect()} == {"other", "v/f2.parquet", "new"} and asked.value == 2


def test_greedy_prefix_sums_over_runs(spark, monkeypatch):
    monkeypatch.setattr(schedule, "RUN", 4)
    plan = [(f"c{n:02d}", n * 7 % 11 + 1, n, "ab"[n % 2] if n % 9 else None) for n in range(40)]
    pending = spark.createDataFrame(plan, "chunk_id string, size long, seq long, dataset string")
    taken = spark.createDataFrame([("c00",), ("c05",), ("c05",)], "chunk_id string")
    for by, groups in ((None, [plan]), ("dataset", [[p for p in plan if p[3] == g] for g in ("a", "b", None)])):
        want = []
        for lines in groups:
            used = 0
            for place, (chunk, size, _, _) in enumerate(p for p in lines if p[0] not in ("c00", "c05")):
                used += size
                if place == 0 or used <= 60:
                    want.append((chunk, used))
        got = schedule.greedy_prefix(pending, taken, F.lit(60), by=by).select("chunk_id", "used").collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert schedule.greedy_prefix(pending.limit(0), taken, F.lit(60)).count() == 0


def test_rounds_of_a_large_cell(spark):
    rows = [(f"{n * 37 % 256:02x}{n:04d}", "city") for n in range(300)] + [("00aa", "village")] + [(f"ff{n}", None) for n in range(5)]
    texts = spark.createDataFrame(rows, "text_sha256 string, cell string")
    got = {r.text_sha256: r["round"] for r in planning.rounds(texts).collect()}
    city = sorted(sha for sha, cell in rows if cell == "city")
    assert [got[sha] for sha in city] == list(range(300)) and got["00aa"] == 0
    assert len(got) == len(rows) and all(0 <= got[f"ff{n}"] < 300 for n in range(5))
    nowhere = planning.rounds(texts.filter("cell is null")).collect()
    assert [r["round"] for r in nowhere] == [0] * 5


def test_gate_over_strata_agrees_with_the_exact_gate(spark):
    """Ten thousand resamples each: bounds within 0.003, which is some three standard errors of a quantile here; all else is equal."""
    df = spark.createDataFrame(gate_items(), "language string, item_id string, expected string, reference string, candidate string")
    exact, r = quality.exact_gate(df).first(), quality.gate_over_strata(df.repartition(7)).first()
    assert list(exact.asDict()) == list(r.asDict()) and exact.worst_language == r.worst_language and exact.passed == r.passed
    assert [x.split(" lower")[0].split(" upper")[0].split(" F1")[0] for x in exact.reasons] == [x.split(" lower")[0].split(" upper")[0].split(" F1")[0] for x in r.reasons]
    close = lambda names, by: all(abs(exact[n] - r[n]) <= by for n in names)
    assert close(["delta_f1", "delta_mcc", "delta_failed_rate", "delta_accuracy", "agreement", "worst_language_delta_f1"], 1e-12)
    assert close(["f1_lower", "mcc_lower", "accuracy_lower", "failed_rate_upper"], 0.003)
    again = quality.gate_over_strata(df.coalesce(1)).first()  # the draws don't depend on how rows are dealt out
    assert all(abs(again[n] - r[n]) < 1e-12 for n in ("f1_lower", "mcc_lower", "accuracy_lower", "failed_rate_upper"))


def test_gate_over_strata_of_any_size(spark):
    """A language of a billion items is as dear as one of ten: its bounds are its points. By cap, each gate is its own."""
    held = np.array([0, 3, 1, 2, 5, 1, 1, 1, 1, 7, 1, 1, 2, 4, 1, 1, 2, 3]) * 40_000_000
    drawn = quality._stratum_rng(0, "x", 0).multinomial(held.sum(), held / held.sum(), size=200)
    spread = (quality._metrics(drawn, 1) - quality._metrics(drawn, 0)).std(axis=1)
    assert (spread < 1e-4).all() and (drawn.sum(axis=1) == held.sum()).all()
    rows_ = [(lang, i, e, p, 100 * (i % 10)) for lang, i, e, p, _ in ((x[0], j, *x[2:]) for j, x in enumerate(gate_items(40)))]
    df = spark.createDataFrame(rows_, "language string, item_id int, expected string, predicted string, generated_tokens int")
    got = {r.cap: r for r in quality.simulate_budgets(df, [50, 450, 5000], resamples=2000).collect()}
    assert got.keys() == {50, 450, 5000} and got[5000].passed and got[5000].f1_lower == 0 and got[5000].agreement == 1.0
    assert not got[50].passed and got[50].rate == 0.9 and got[50].f1_lower < got[450].f1_lower < 0
    assert [x.split()[0] for x in got[50].reasons] == ["macro-F1", "macro-MCC", "macro-accuracy", "failed-rate", "language"]
    empty = df.limit(0).withColumnsRenamed({"predicted": "reference"}).withColumn("candidate", F.col("reference"))
    assert quality.gate_over_strata(empty).count() == 0


def test_profiles_fill_in_defaults(spark):
    rows_ = spark.createDataFrame([("j1", "l40s"), ("j2", "a40"), ("j3", "new"), ("j4", None)], "job string, gpu_key string")
    schema = "gpu string, gpu_key string, max_running_requests int, mem_fraction_static double, cuda_graph_max_bs int, sentences_per_second double, calibrated boolean"
    profiles = spark.createDataFrame([("L40S", "l40s", 96, 0.9, 8, 5.5, True), ("A40", "a40", None, None, None, 3.6, None), ("A40 old", "a40", 32, None, None, None, None)], schema)
    got = {r.job: tuple(r)[2:] for r in stats.with_profiles(rows_, profiles, stats.LAUNCH_WINDOW).collect()}
    assert got == {"j1": (96, 0.9, 8, 5.5, True), "j2": (32, 0.75, None, 1.4, False), "j3": (16, 0.75, None, 1.4, False), "j4": (16, 0.75, None, 1.4, False)}
    assert stats.with_profiles(rows_, profiles.limit(0)).select("max_running_requests").distinct().collect()[0][0] == 64
