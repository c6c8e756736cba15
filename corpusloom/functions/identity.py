"""Identities: SHA-256 over exact UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts of a compound identity are joined by the unit separator.
SEPARATOR = "\u001f"


def text_sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def parts_sha256(*parts: Column) -> Column:
    """A null part is the text None, so that parts never shift."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)


def label_id(dataset: Column, keys: Sequence[str]) -> Column:
    """Identity of a sentence position: its dataset and its key columns, in order, as name=value."""
    return parts_sha256(dataset, *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("None"))) for k in keys])


def generation_id(sha: Column, fingerprint: Column) -> Column:
    return F.substring(parts_sha256(sha, fingerprint), 1, 32)


def chunk_id(fingerprint: Column, shas: Column) -> Column:
    """Identity of a set of texts: their sorted hashes under a configuration."""
    return F.substring(F.sha2(F.concat(fingerprint, F.lit(SEPARATOR), F.array_join(F.array_sort(shas), SEPARATOR)), 256), 1, 24)


def cell_key(cell: Column) -> Column:
    return F.substring(F.sha2(F.coalesce(cell, F.lit("")), 256), 1, 16)


def hash_round(sha: Column) -> Column:
    """The first 12 hex digits as a number."""
    return F.conv(F.substring(sha, 1, 12), 16, 10).cast("bigint")


def last_components(path: Column, n: int = 3) -> Column:
    """The last n components of a path: the name of a part or manifest wherever it is mounted."""
    return F.substring_index(path, "/", -n)
