import json

from corpusloom.operators.resolve import verdicts
from corpusloom.streaming import ingest

SCHEMA = "text_sha256 string, raw_output string, truncated boolean"


def part(spark, root, chunk, name, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/{chunk}/{name}")


def test_verdicts_of_a_growing_set_of_parts(spark, tmp_path):
    root, out, check = (str(tmp_path / n) for n in ("parts", "out", "check"))

    def pull():
        ingest.run_available(ingest.verdict_stream(ingest.part_stream(spark, root, SCHEMA)), ingest.checkpoint_for(check, "v"), ingest.versions_to(out)).awaitTermination(120)
        return {(r.text_sha256, r.decision) for r in ingest.latest(spark, out, "text_sha256").collect()}

    part(spark, root, "c1", "p9", [("a", "x</think>yes", False), ("b", "x</think>no", False)])
    assert pull() == {("a", "yes"), ("b", "no")}
    part(spark, root, "c1", "p1", [("a", "x</think>no", False), ("a", "x</think>yes", False)])  # comes late, but its key is smaller
    part(spark, root, "c2", "p0", [("b", "x</think>yes", False)])
    assert pull() == {("a", "no"), ("b", "no")}
    whole = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(root)
    batch = verdicts(whole.selectExpr("*", "substring_index(_metadata.file_path, '/', -3) as part_key", "_metadata.row_index as row_index"))
    assert {(r.text_sha256, r.decision) for r in batch.collect()} == pull()  # nothing new: nothing changes


def test_progress_counts_each_text_once(spark, tmp_path):
    folder = tmp_path / "m" / "fp" / "c1"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"part_id": "a", "text_sha256s": ["x", "y"]}))
    (folder / "b.json").write_text("{")
    seen = []
    lines = spark.createDataFrame([("c1", 3)], "chunk_id string, size long")

    def pull():
        sink = ingest.completing(lines, str(tmp_path / "done"), lambda df: seen.extend(r.chunk_id for r in df.collect()))
        ingest.run_available(ingest.progress_stream(ingest.manifest_stream(spark, str(tmp_path / "m"))), str(tmp_path / "check"), sink).awaitTermination(120)

    pull()
    assert seen == []
    (folder / "c.json").write_text(json.dumps({"part_id": "c", "text_sha256s": ["y", "z"]}))
    pull()
    assert seen == ["c1"]
