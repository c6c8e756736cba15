"""Runs over a limited number of files, which go on where the last one ended."""

import pytest
from pyspark.sql import functions as F

from corpusloom.sources.marks import FileMarks, without_generation_counts


def test_runs_take_the_next_files_in_order(spark, tmp_path):
    files = spark.createDataFrame([(f"f{i}", (i * 7) % 10, "x") for i in range(10)], "path string, file_idx int, job string")
    scan, locate, seen = FileMarks(spark, str(tmp_path), "scan"), FileMarks(spark, str(tmp_path), "locate"), []
    work = lambda some: seen.append(sorted(r.file_idx for r in some.collect()))
    assert [scan.run(files, work, 4) for _ in range(4)] == [4, 4, 2, 0] and seen == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert locate.run(files, work, 0) == 10 and seen[-1] == list(range(10)) and locate.run(files, work) == 0  # each job has its own
    more = files.unionByName(spark.createDataFrame([("new", -1, "x")], files.schema))
    assert [r.path for r in scan.due(more, 3).collect()] == ["new"]


def test_a_lost_run_is_done_again(spark, tmp_path):
    files, marks = spark.createDataFrame([("a", 0), ("b", 1)], "path string, file_idx int"), FileMarks(spark, str(tmp_path), "scan")

    def lost(some):
        raise OSError("lost")

    with pytest.raises(OSError):
        marks.run(files, lost, 1)
    seen = []
    assert marks.run(files, lambda some: seen.extend(r.path for r in some.collect()), 1) == 1 and seen == ["a"]
    assert marks.run(files.limit(0), lost) == 0


def test_reset_keeps_labels(spark):
    ledger = spark.createDataFrame([("labels/a", 1), ("generations/a", 2), (None, 3), ("x/generations/a", 4)], "path string, rows int")
    assert sorted(r.rows for r in without_generation_counts(ledger).collect()) == [1, 3, 4]
    assert without_generation_counts(ledger.filter(F.lit(False))).count() == 0
