"""Result parts as a data source: a task reads a part's bytes once, holds their hash against the part's name, and decodes those very bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from corpusloom.sources.commit import opened

#: Columns that the scan adds: the part's last three path components, the row's number in it, whether the part is damaged.
ADDED = "part_key string, row_index bigint, corrupt boolean"


class PartScan(DataSource):
    """Format `corpusloom_parts`. Options: path; folders, how many chunk folders make one task (16).

    The schema is what to read, and only that is decoded, with the columns of ADDED. A damaged part is one row of nulls but for part_key and corrupt.
    """

    @classmethod
    def name(cls) -> str:
        return "corpusloom_parts"

    def schema(self) -> str:
        raise ValueError("give the schema to read")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PartReader(self.options["path"], schema, int(self.options.get("folders", "16")))


class PartReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, folders: int):
        self.path, self.arrow, self.folders = path.rstrip("/"), to_arrow_schema(schema), folders

    def partitions(self) -> Sequence[InputPartition]:
        """Groups of chunk folders. Their parts are listed by the tasks."""
        fs, base = opened(self.path)
        is_folder = lambda x: x.type == pafs.FileType.Directory and x.base_name[:1] not in "_."
        listed = lambda at: sorted(x.path for x in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)) if is_folder(x))
        chunks = [chunk for fp in listed(base) for chunk in listed(fp)]
        return [InputPartition(chunks[i : i + self.folders]) for i in range(0, len(chunks), self.folders)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.path)
        for folder in partition.value:
            files = sorted(x.path for x in fs.get_file_info(pafs.FileSelector(folder)) if x.is_file and x.extension == "parquet")
            for path in files:
                yield from self._part(fs, path)

    def _part(self, fs: pafs.FileSystem, path: str) -> Iterator[pa.RecordBatch]:
        key, name = "/".join(path.split("/")[-3:]), path.rsplit("/", 1)[-1].removesuffix(".parquet")
        with fs.open_input_stream(path) as stream:
            data = stream.read()
        if hashlib.sha256(data).hexdigest() != name:
            yield self._batch({}, 1, {"part_key": [key], "corrupt": [True]})
            return
        part = pq.ParquetFile(pa.BufferReader(data))
        wanted = [f.name for f in self.arrow if f.name in set(part.schema_arrow.names)]
        at = 0
        for batch in part.iter_batches(columns=wanted):
            n = batch.num_rows
            yield self._batch({c: batch.column(c) for c in wanted}, n, {"part_key": [key] * n, "row_index": range(at, at + n), "corrupt": [False] * n})
            at += n

    def _batch(self, found: dict[str, pa.Array], rows: int, added: dict) -> pa.RecordBatch:
        columns = []
        for f in self.arrow:
            if f.name in added:
                columns.append(pa.array(added[f.name], f.type))
            else:
                columns.append(found[f.name].cast(f.type) if f.name in found else pa.nulls(rows, f.type))
        return pa.RecordBatch.from_arrays(columns, schema=self.arrow)


def scan_parts(spark: SparkSession, root: str, schema: str, folders: int = 16) -> DataFrame:
    """The rows of the parts under root/<fingerprint>/<chunk>/, with ADDED; see PartScan."""
    spark.dataSource.register(PartScan)
    return spark.read.format("corpusloom_parts").schema(f"{schema}, {ADDED}").option("folders", folders).load(root)
