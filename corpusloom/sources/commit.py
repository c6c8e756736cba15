"""Adding result parts in two phases, both of them in tasks: a part is written and hashed before anyone can see it, and moved into place once all are.

A commit is a folder of its own, `_commits/<id>`, beside the parts. In the first phase tasks cut rows into parts, write each under the hash of
its bytes, and Spark writes a table of what they wrote: only tasks that count are in it. In the second phase tasks move the parts to where their
names belong, and after each its manifest. Both steps can be done again at any time, so a commit that was broken off is finished, or
forgotten if its first phase was, by recover(). A manifest never names a part that isn't there.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
#: Rows and bytes of a part, at most.
ROWS, BYTES = 50_000, 256 << 20
STAGED = "fp string, chunk string, part_id string, staged string, n_rows long, texts array<string>"
STAGED_ARROW = pa.schema([("fp", pa.string()), ("chunk", pa.string()), ("part_id", pa.string()), ("staged", pa.string()), ("n_rows", pa.int64()), ("texts", pa.list_(pa.string()))])


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it; for tasks."""
    return pafs.FileSystem.from_uri(path)


def folder_of(fp: str, chunk: str) -> str:
    """Where the parts of a chunk stand: names can't leave their folder, be empty, or begin like a hidden one."""
    safe = (quote(x, safe="") or "%" for x in (fp, chunk))
    return "/".join(f"%{ord(x[0]):02X}{x[1:]}" if x[0] in "._" else x for x in safe)


def _cut(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[str, str, pa.Table]]:
    """Runs of rows of one (fp, chunk), which come together, of `rows` rows and BYTES bytes at most."""
    key, held, n, size = None, [], 0, 0
    for batch in batches:
        at, keys = 0, zip(batch.column("_fp").to_pylist(), batch.column("_chunk").to_pylist(), strict=True)
        data = batch.drop_columns(["_fp", "_chunk"])
        each = max(1, data.nbytes // max(1, data.num_rows))
        for k, run in groupby(keys):
            end = at + sum(1 for _ in run)
            while at < end:
                if held and (k != key or n >= rows or size >= BYTES):
                    yield (*key, pa.Table.from_batches(held).combine_chunks())
                    held, n, size = [], 0, 0
                take = min(end - at, rows - n, max(1, (BYTES - size) // each))
                held.append(data.slice(at, take))
                key, at, n, size = k, at + take, n + take, size + take * each
    if held:
        yield (*key, pa.Table.from_batches(held).combine_chunks())


def stage(results: DataFrame, root: str, rows: int = ROWS) -> str:
    """First phase: parts that nobody sees yet. Returns the commit's name. Null keys are written as "none"."""
    commit = uuid.uuid4().hex
    here = f"{root.rstrip('/')}/{COMMITS}/{commit}"
    named = results.withColumns({"_fp": F.coalesce(F.col("config_fingerprint"), F.lit("none")), "_chunk": F.coalesce(F.col("chunk_id"), F.lit("none"))})
    # A chunk of any size: large ones are split, small ones share a task.
    dealt = named.hint("rebalance", "_fp", "_chunk").sortWithinPartitions("_fp", "_chunk", "text_sha256")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(here)
        for fp, chunk, table in _cut(batches, rows):
            sink = pa.BufferOutputStream()
            pq.write_table(table, sink, compression="zstd")
            data = sink.getvalue()
            part = hashlib.sha256(data).hexdigest()
            staged = f"staged/{part}-{uuid.uuid4().hex}"  # of this attempt
            fs.create_dir(f"{base}/staged", recursive=True)
            with fs.open_output_stream(f"{base}/{staged}") as out:
                out.write(data)
            texts = sorted(set(table.column("text_sha256").to_pylist()) - {None})
            yield pa.RecordBatch.from_pylist([{"fp": fp, "chunk": chunk, "part_id": part, "staged": staged, "n_rows": table.num_rows, "texts": texts}], schema=STAGED_ARROW)

    dealt.mapInArrow(write, STAGED).write.option("compression", "zstd").parquet(f"{here}/parts")
    return commit


def publish(spark: SparkSession, root: str, commit: str) -> int:
    """Second phase, which may be done again: moves what was staged into place, each part before its manifest. Returns how many parts the commit has."""
    base_uri = root.rstrip("/")
    parts = spark.read.schema(STAGED).parquet(f"{base_uri}/{COMMITS}/{commit}/parts")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(base_uri)
        for batch in batches:
            for r in batch.to_pylist():
                folder = f"{base}/{folder_of(r['fp'], r['chunk'])}"
                fs.create_dir(folder, recursive=True)
                _place(fs, f"{base}/{COMMITS}/{commit}/{r['staged']}", f"{folder}/{r['part_id']}.parquet")
                note = f"{base}/{COMMITS}/{commit}/staged/{uuid.uuid4().hex}"
                with fs.open_output_stream(note) as out:
                    out.write(json.dumps({"part_id": r["part_id"], "text_sha256s": r["texts"]}).encode())
                _place(fs, note, f"{folder}/{r['part_id']}.json")
            yield pa.RecordBatch.from_pydict({"part_id": batch.column("part_id")})

    n = parts.repartition(spark.sparkContext.defaultParallelism).mapInArrow(move, "part_id string").count()
    _delete(spark, f"{base_uri}/{COMMITS}/{commit}")
    return n


def _place(fs: pafs.FileSystem, source: str, target: str) -> None:
    """Moves a file over what is there, whose bytes may be damaged. A source that is gone was moved before."""
    there = fs.get_file_info([source, target])
    if there[0].type == pafs.FileType.NotFound:
        if there[1].type == pafs.FileType.NotFound:
            raise FileNotFoundError(source)
        return
    if there[1].type != pafs.FileType.NotFound and not isinstance(fs, pafs.LocalFileSystem):
        fs.delete_file(target)  # others don't rename over a file
    fs.move(source, target)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def append_results(results: DataFrame, root: str, rows: int = ROWS) -> int:
    """Adds results as root/config_fingerprint/chunk_id/<sha256 of the bytes>.parquet, each with a manifest of that name in JSON; returns the number of parts.

    Doing it again adds nothing, as long as the rows come dealt out alike, and mends damaged copies."""
    return publish(results.sparkSession, root, stage(results, root, rows))


def recover(spark: SparkSession, root: str) -> dict[str, int]:
    """Ends commits that were broken off: those whose first phase was done are published, others are forgotten. Returns the parts by commit. Not while a writer works."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{COMMITS}")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    done = {}
    for status in fs.listStatus(at) if fs.exists(at) else []:  # open commits only
        path, name = status.getPath(), status.getPath().getName()
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "parts/_SUCCESS")):
            done[name] = publish(spark, root, name)
        else:
            fs.delete(path, True)
            done[name] = 0
    return done
