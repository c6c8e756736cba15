import json

from pyspark.sql import functions as F

from corpusloom.operators import planning, resolve
from corpusloom.plans import bindings, flows, queries, report
from corpusloom.sources.readers import SOURCES

TEMPLATE = "Is this useful? {} Say yes or no."


def encode(prompts):
    return [[ord(c) % 97 for c in p] for p in prompts]


def generate(ids):
    return [json.dumps({"text": f"x</think>{'yes' if sum(i) % 2 else 'no'}", "meta_info": {"finish_reason": {"type": "stop"}, "completion_tokens": 3}}) for i in ids]


def inputs(spark):
    data = [("v1/a.parquet", 0, "i1", "t", "one two", "en", "split", ["one", "two", "7"]), ("v1/b.parquet", 1, "i2", "t", "two!", "en", "split", ["two", "three"]), ("v1/b.parquet", 1, "i3", "t", "raw", "xx", "unsupported_language", None)]
    return spark.createDataFrame(data, "source_file string, file_idx int, description_identity string, tag_key string, original_text string, language_code string, split_status string, sentences array<string>")


def test_from_plan_to_published_tables(spark, tmp_path):
    fp, source = F.lit("f"), SOURCES["description"]
    none = spark.createDataFrame([], "chunk_id string")
    chunks, lines, counts = flows.plan(spark, inputs(spark), source, none, TEMPLATE, encode, fp, 3, True)
    chunks.write.parquet(f"{tmp_path}/chunks")
    chunks = spark.read.parquet(f"{tmp_path}/chunks")
    assert sorted(r["size"] for r in lines.collect()) == [1, 3] and chunks.count() == 4
    assert {(r.file_idx, r.sentences, r.unsplit, r.new_unique) for r in counts.collect()} == {(0, 3, 0, 3), (1, 3, 1, 1)}
    first = chunks.filter("group = 0")
    one = flows.process(first, chunks.limit(0), generate)
    assert {r.raw_output for r in one.filter("finish_reason = 'rule:no_letters'").collect()} <= {"</think>no"}
    one.withColumn("part_key", F.lit("c/p")).withColumn("row_index", F.lit(0)).write.parquet(f"{tmp_path}/parts")
    done = spark.read.parquet(f"{tmp_path}/parts")
    again = flows.process(first, done, generate)
    assert again.count() == 0  # resumed: nothing is left of this chunk
    verdicts = resolve.verdicts(done)
    from corpusloom.sources.readers import with_identity

    rows = inputs(spark)
    sentences = with_identity(source.read(rows.drop("file_idx")), "description").join(rows.select("source_file", "file_idx").distinct(), "source_file")
    last = spark.createDataFrame([], "source_file string, known long")
    out = flows.publish(sentences, verdicts, planning.unique_texts(sentences), done.drop("part_key", "row_index"), last, "description", fp, F.lit("r"))
    labels = out["labels"].collect()
    assert len({r.label_id for r in labels}) == len(labels)
    assert all((r.generation_id is None) == (r.decision in ("pending", "skipped_unsplit")) for r in labels)
    assert {r.source_file: r.complete for r in out["coverage"].collect()}.keys() <= {"v1/a.parquet", "v1/b.parquet"}
    joined = flows.recipe(spark, sentences.select("description_identity", "tag_key", "sentence_index"), out["labels"], out["generations"], ["description_identity", "tag_key", "sentence_index"])
    assert joined.count() == len(labels)


def test_report():
    facts = report.Facts("x", 7, 3, 1, {"yes": 1200, "no": 700, "failed": 90, "pending": 0}, {"truncated": 60, "no_label": 30}, 1500, ["a", "b"], "f", "CC0", gates={"card": {"delta_f1": -0.25}})
    text = report.render(facts)
    assert "state: growing" in text and "| yes | 1,200 | 603.0200 |" in text and "pending" not in text and "On the map" not in text
    assert text.index("| truncated | 60 |") < text.index("| no_label | 30 |") and "| card | -0.2500 |" in text and "by a, b," in text
    assert report.grid(("n",), []) == "| n |\n| :-- |"
    assert report.digest({"a": b"1"}) == report.digest({"a": b"1"}) != report.digest({"b": b"1"})


def test_totals_are_the_sums_of_files_and_the_entry_runs(spark):
    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    total, files = queries.totals(spark, d).first(), entry.entry(spark).collect()
    assert total.files == len(files) and all(total[c] == sum(r[c] for r in files) for c in ("yes", "no", "failed", "pending", "labelled"))
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert bindings.sentences(spark, d).select("label_id").distinct().count() == bindings.sentences(spark, d).count()
