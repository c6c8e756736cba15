"""Bounded pulls of manifests as a streaming source, for a store in which listing is what costs.

A pull lists, in this order: the folders of chunks whose work ended since they were last listed (owed), those that are being worked on, when they
are due (live), and when that is due, all folders, in order, over as many pulls as it takes (full). It ends when it has listed so many
folders or found so many files; what is left stays owed, due or ahead. Listings take files that are newer than the last listing that
would have found them, with some slack for clocks, so few are read twice; reading one twice must do no harm.

Spark's offset is the number of the pull. What a pull takes, and where the next one goes on, is written before Spark hears of it, so a restart, even one
between the two, takes the same files again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from corpusloom.sources.commit import opened

#: Seconds between full listings, and between two listings of a live chunk; seconds by which clocks and listings may be late.
RECONCILE, LIVE, SLACK = 3600.0, 900.0, 300.0
SCHEMA = "chunk_id string, part_id string, text_sha256 string"
#: Files that one task reads.
GROUP = 64


@dataclass(frozen=True)
class Limits:
    """Of one pull."""

    folders: int = 500
    files: int = 1000
    reconcile: float = RECONCILE
    live: float = LIVE
    slack: float = SLACK


@dataclass
class Pull:
    """What one pull takes, and where the next one goes on."""

    number: int = 0
    #: By chunk: names of the files taken.
    take: dict[str, list[str]] = field(default_factory=dict)
    #: By chunk: (files from this time on, after this name).
    owed: dict[str, tuple[float, str]] = field(default_factory=dict)
    #: By chunk: when it was last listed.
    live: dict[str, float] = field(default_factory=dict)
    #: When the last full listing that ended began, and the one that goes on, with the last (chunk, name) that it took.
    full_at: float | None = None
    going: float | None = None
    after: tuple[str, str] | None = None
    #: Whether it ended for its limits, or for an error of the store.
    limited: bool = False

    def settled(self) -> bool:
        return not self.owed and self.going is None and not self.limited


def next_pull(last: Pull, now: float, live: set[str] | None, limits: Limits, chunks: Callable[[], list[str]], files: Callable[[str], list[tuple[str, float]]]) -> Pull:
    """The pull after `last`. live: the chunks that are being worked on, None if that isn't known; chunks(): all there are; files(chunk): name and time of its manifests."""
    pull = Pull(last.number + 1, {}, {c: tuple(v) for c, v in last.owed.items()}, dict(last.live), last.full_at, last.going, tuple(last.after) if last.after else None)
    if live is not None:
        for chunk in sorted(set(pull.live) - live):
            pull.owed.setdefault(chunk, (pull.live.pop(chunk), ""))
        pull.live |= {chunk: pull.live.get(chunk, 0.0) for chunk in live}
    if pull.going is None and (live is None or pull.full_at is None or now - pull.full_at >= limits.reconcile):
        pull.going = now
    listed = taken = 0

    def rest() -> int:
        return limits.files - taken if listed < limits.folders else 0

    def visit(chunk: str, since: float, after: str) -> str | None:
        """Takes what the pull has room for; the last name taken if there is more."""
        nonlocal listed, taken
        listed += 1
        had = set(pull.take.get(chunk, ()))
        found = sorted(name for name, at in files(chunk) if at >= since - limits.slack and name > after and name not in had)
        some = found[: limits.files - taken]
        if some:
            pull.take.setdefault(chunk, []).extend(some)
            taken += len(some)
        return (some[-1] if some else after) if len(some) < len(found) else None

    full_from = pull.full_at or 0.0
    try:
        for chunk, (since, after) in sorted(pull.owed.items()):
            if rest() <= 0:
                pull.limited = True
                break
            cut = visit(chunk, max(since, full_from), after)
            if cut is None:
                del pull.owed[chunk]
            else:
                pull.owed[chunk] = since, cut
        # The first full listing covers live chunks.
        for chunk, at in sorted(pull.live.items()) if pull.full_at is not None else ():
            if now - at < limits.live:
                continue
            if rest() <= 0:
                pull.limited = True
                break
            cut = visit(chunk, max(at, full_from), "")
            pull.live[chunk] = now
            if cut is not None:
                pull.owed[chunk] = at, cut
        if pull.going is not None:
            here, name = pull.after or ("", "")
            for chunk in sorted(c for c in chunks() if c >= here):
                if rest() <= 0:
                    pull.limited = True
                    break
                cut = visit(chunk, max(full_from, pull.live.get(chunk, 0.0)), name if chunk == here else "")
                pull.after = chunk, "\U0010ffff" if cut is None else cut
                if cut is not None:
                    pull.limited = True
                    break
            else:
                pull.live = {c: max(at, pull.going) for c, at in pull.live.items()}
                pull.full_at, pull.going, pull.after = pull.going, None, None
    except OSError:  # the store refuses for now: what isn't listed stays owed, due or ahead
        pull.limited = True
    return pull


class ManifestPulls(DataSource):
    """Format `corpusloom_manifests`. Options: path (of one fingerprint: its folders are chunks), log (a folder for the pulls), live (a text file with the live
    chunks, one a line; without it every pull wants a full listing), and folders, files, reconcile_s, live_s, slack_s as in Limits. Manifests that can't be read are left out:
    when they are written again, they are newer."""

    @classmethod
    def name(cls) -> str:
        return "corpusloom_manifests"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        o = self.options
        limits = Limits(int(o.get("folders", "500")), int(o.get("files", "1000")), float(o.get("reconcile_s", RECONCILE)), float(o.get("live_s", LIVE)), float(o.get("slack_s", SLACK)))
        return PullReader(o["path"].rstrip("/"), o["log"].rstrip("/"), o.get("live", ""), limits)


class PullReader(DataSourceStreamReader):
    def __init__(self, path: str, log: str, live: str, limits: Limits):
        self.path, self.log, self.live, self.limits = path, log, live, limits

    def initialOffset(self) -> dict:
        return {"pull": 0}

    def latestOffset(self) -> dict:
        """Makes a pull. One that finds nothing and changes nothing isn't a new offset."""
        last = last_pull(self.log)
        pull = next_pull(last, time.time(), self._live(), self.limits, self._chunks, self._files)
        if not pull.take and (pull.owed, pull.going, pull.after, set(pull.live), pull.full_at is None) == ({c: tuple(v) for c, v in last.owed.items()}, last.going, last.after, set(last.live), last.full_at is None):
            pull.number = last.number  # only times have changed
        _write(self.log, pull)
        return {"pull": pull.number}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        found = [(c, n) for i in range(start["pull"] + 1, end["pull"] + 1) for c, names in sorted(read_pull(self.log, i).take.items()) for n in names]
        return [InputPartition(found[i : i + GROUP]) for i in range(0, len(found), GROUP)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, base = opened(self.path)
        for chunk, name in partition.value:
            try:
                with fs.open_input_stream(f"{base}/{chunk}/{name}") as stream:
                    note = json.loads(stream.read())
                part, texts = str(note["part_id"]), [str(t) for t in note["text_sha256s"]]
            except (OSError, ValueError, KeyError, TypeError):
                continue
            yield pa.RecordBatch.from_pydict({"chunk_id": pa.array([chunk] * len(texts), pa.string()), "part_id": pa.array([part] * len(texts), pa.string()), "text_sha256": pa.array(texts, pa.string())})

    def commit(self, end: dict) -> None:
        """Pulls that are done with are forgotten; the last one says where to go on."""
        fs, base = opened(self.log)
        for x in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
            if x.is_file and x.base_name.startswith("pull-") and int(x.base_name.split("-")[1].split(".")[0]) < end["pull"]:
                fs.delete_file(x.path)

    def stop(self) -> None:
        pass

    def _live(self) -> set[str] | None:
        if not self.live:
            return None
        fs, at = opened(self.live)
        if fs.get_file_info(at).type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(at) as stream:
            return set(stream.read().decode().split())

    def _chunks(self) -> list[str]:
        fs, base = opened(self.path)
        return [x.base_name for x in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if x.type == pafs.FileType.Directory and x.base_name[:1] not in "_."]

    def _files(self, chunk: str) -> list[tuple[str, float]]:
        fs, base = opened(self.path)
        found = fs.get_file_info(pafs.FileSelector(f"{base}/{chunk}", allow_not_found=True))
        return [(x.base_name, (x.mtime_ns or 0) / 1e9) for x in found if x.is_file and x.extension == "json"]


def _write(log: str, pull: Pull) -> None:
    fs, base = opened(log)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/new") as out:
        out.write(json.dumps(asdict(pull)).encode())
    target = f"{base}/pull-{pull.number:09d}.json"
    if not isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(target).type != pafs.FileType.NotFound:
        fs.delete_file(target)
    fs.move(f"{base}/new", target)


def read_pull(log: str, number: int) -> Pull:
    fs, base = opened(log)
    with fs.open_input_stream(f"{base}/pull-{number:09d}.json") as stream:
        found = json.loads(stream.read())
    found["owed"] = {c: tuple(v) for c, v in found["owed"].items()}
    found["after"] = tuple(found["after"]) if found["after"] else None
    return Pull(**found)


def last_pull(log: str) -> Pull:
    """The last one that was written; number 0 if there is none."""
    fs, base = opened(log)
    names = [x.base_name for x in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if x.is_file and x.base_name.startswith("pull-")]
    return read_pull(log, int(max(names).split("-")[1].split(".")[0])) if names else Pull()


def manifest_pulls(spark: SparkSession, path: str, log: str, live: str = "", limits: Limits = Limits()) -> DataFrame:
    """The stream of (chunk_id, part_id, text_sha256); each trigger is one pull."""
    spark.dataSource.register(ManifestPulls)
    options = {"log": log, "live": live, "folders": limits.folders, "files": limits.files, "reconcile_s": limits.reconcile, "live_s": limits.live, "slack_s": limits.slack}
    return spark.readStream.format("corpusloom_manifests").options(**options).load(path)
