"""Session defaults: ANSI SQL, UTC, adaptive execution, zstd parquet."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(app: str = "corpusloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=DEFAULTS | extra).getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all machines see: in the cluster's spark.checkpoint.dir, else in the warehouse; an error if a cluster has only a local one."""
    shared, local = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir")
    if not shared and not spark.sparkContext.master.startswith("local") and local.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{(shared or local).rstrip('/')}/corpusloom/{name}-{uuid.uuid4().hex}"


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session with some settings, which are put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
