"""Two-phase commits of parts, and the scan that verifies them in one read."""

import hashlib
import json
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.sources import commit, parts

SCHEMA = "text_sha256 string, config_fingerprint string, chunk_id string, raw_output string"


def results(spark, n=300, chunks=3):
    return spark.createDataFrame([(f"h{i:04}", f"fp{i % 2}", f"c{i % chunks}", f"</think>{i}") for i in range(n)], SCHEMA)


def seen(tmp_path):
    """What a reader sees: parts and manifests by name."""
    found = [p.relative_to(tmp_path / "r") for p in (tmp_path / "r").glob("*/*/*") if not p.parts[-3].startswith("_")]
    return {str(p) for p in found if p.suffix == ".parquet"}, {str(p) for p in found if p.suffix == ".json"}


def test_nothing_is_seen_before_the_second_phase(spark, tmp_path):
    root = str(tmp_path / "r")
    name = commit.stage(results(spark), root, rows=40)
    assert seen(tmp_path) == (set(), set()) and parts.read_valid_parts(spark, root, SCHEMA).count() == 0
    n = commit.publish(spark, root, name)
    files, notes = seen(tmp_path)
    assert n == len(files) and {f.removesuffix(".parquet") for f in files} == {f.removesuffix(".json") for f in notes}
    assert sorted(tuple(r)[:4] for r in parts.read_valid_parts(spark, root, SCHEMA).collect()) == sorted(tuple(r) for r in results(spark).collect())
    for f in files:  # names are the bytes' hashes, manifests say what is inside, parts aren't larger than asked for
        data = (tmp_path / "r" / f).read_bytes()
        assert hashlib.sha256(data).hexdigest() == f.split("/")[2].removesuffix(".parquet")
        held = pq.read_table(tmp_path / "r" / f).column("text_sha256").to_pylist()
        assert json.loads((tmp_path / "r" / f.replace(".parquet", ".json")).read_text())["text_sha256s"] == sorted(held) and len(held) <= 40
    assert not os.path.exists(f"{root}/_commits/{name}")


def test_a_commit_that_was_broken_off_is_ended(spark, tmp_path):
    root = str(tmp_path / "r")
    whole = commit.stage(results(spark, 200), root, rows=30)
    halfway = commit.stage(results(spark, 400).filter("text_sha256 >= 'h0200'"), root, rows=30)
    early = commit.stage(results(spark, 9, 1).withColumn("chunk_id", F.lit("never")), root)
    shutil.copytree(f"{root}/_commits/{halfway}", tmp_path / "copy")
    commit.publish(spark, root, halfway)
    # The second phase ended after some moves: put the commit back, and what it staged for one part, and take that part and some manifests away.
    shutil.copytree(tmp_path / "copy", f"{root}/_commits/{halfway}")
    files, notes = (sorted(x) for x in seen(tmp_path))
    for f in [files[0], *notes[:3]]:
        os.remove(f"{root}/{f}")
    for f in os.listdir(f"{root}/_commits/{halfway}/staged"):
        if not f.startswith(files[0].split("/")[2].removesuffix(".parquet")):
            os.remove(f"{root}/_commits/{halfway}/staged/{f}")
    os.remove(f"{root}/_commits/{early}/parts/_SUCCESS")  # the first phase of this one didn't end
    done = commit.recover(spark, root)
    assert done.keys() == {whole, halfway, early} and done[early] == 0 and done[whole] > 0
    assert sorted(tuple(r)[:4] for r in parts.read_valid_parts(spark, root, SCHEMA).collect()) == sorted(tuple(r) for r in results(spark, 400).collect())
    files, notes = seen(tmp_path)
    assert {f.removesuffix(".parquet") for f in files} == {f.removesuffix(".json") for f in notes}
    assert commit.recover(spark, root) == {} and os.listdir(f"{root}/_commits") == []


def test_lost_bytes_end_a_publication_with_an_error(spark, tmp_path):
    root = str(tmp_path / "r")
    name = commit.stage(results(spark, 10), root)
    shutil.rmtree(f"{root}/_commits/{name}/staged")
    with pytest.raises(Exception, match="FileNotFoundError"):
        commit.publish(spark, root, name)


def test_damaged_parts_are_rows_of_their_own_and_are_mended(spark, tmp_path):
    root = str(tmp_path / "r")
    commit.append_results(results(spark, 120), root, rows=15)
    files = sorted(seen(tmp_path)[0])
    (tmp_path / "r" / files[0]).write_bytes(b"")
    (tmp_path / "r" / files[1]).write_bytes((tmp_path / "r" / files[1]).read_bytes()[:-1] + b"!")
    scan = parts.scan_parts(spark, root, "raw_output string, missing int, text_sha256 string", folders=1)
    bad = scan.filter("corrupt").collect()
    assert sorted(r.part_key for r in bad) == files[:2] and all(r.row_index is None and r.text_sha256 is None for r in bad)
    good = scan.filter("not corrupt").collect()
    assert {r.part_key for r in good} == set(files[2:]) and all(r.missing is None and r.raw_output for r in good)
    by_part = {f: sorted(r.row_index for r in good if r.part_key == f) for f in files[2:]}
    assert all(v == list(range(len(v))) for v in by_part.values())
    assert sorted(r.part_key for r in parts.corrupt_parts(spark, root).collect()) == files[:2]
    commit.append_results(results(spark, 120), root, rows=15)  # the same rows again
    assert parts.corrupt_parts(spark, root).count() == 0 and sorted(seen(tmp_path)[0]) == files


def test_the_scan_needs_no_list_of_parts(spark, tmp_path):
    """One task for each group of folders, none for a root that is empty or not there; nothing is collected in planning."""
    root = str(tmp_path / "r")
    assert parts.scan_parts(spark, root, SCHEMA).count() == 0
    commit.append_results(results(spark, 60, 7), root)
    assert parts.scan_parts(spark, root, SCHEMA, folders=2).rdd.getNumPartitions() == 7  # 2 fingerprints x 7 chunks
    assert commit.append_results(results(spark, 0), root) == 0


def test_null_and_odd_keys_stay_in_their_folder(spark, tmp_path):
    root = str(tmp_path / "r")
    odd = [("a", None, None, "x"), ("b", "../up", "c/d", "y"), (None, "fp", "c", "z")]
    commit.append_results(spark.createDataFrame(odd, SCHEMA), root)
    got = {tuple(r)[:4]: r.part_key for r in parts.read_valid_parts(spark, root, SCHEMA).collect()}
    assert got.keys() == set(odd) and got[odd[0]].startswith("none/none/") and not (tmp_path / "up").exists()
