"""Suffix-array dedup: bytes covered by a long string that starts earlier in the corpus go.

Sorting every suffix of the corpus would move each byte many times. So suffixes are first dealt out such that equal strings
of WIDTH bytes meet: each window of WIDTH bytes picks the smallest hash among its grams (winnowing, Schleimer and
others, 2003), equal windows pick the same one, and windows in a row with one pick make a segment. Picks that occur once in the corpus
can't be in a repeated string. The segments of all others meet by pick, in blocks, and each block sorts
the suffixes that start its segments' windows in two stages; suffixes next to each other with a common prefix of WIDTH bytes are
copies, and all but the earliest are covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import octets, staged, table, wide
from corpusloom.llm.suffix_sort import two_stage_order

WIDTH, GRAM = 100, 32
#: Bytes of text that are hashed at once, and kept together before picks are sent; bytes of text for each block of picks.
PIECE, TOGETHER, BLOCK = 1 << 21, 1 << 25, 1 << 23
#: Bytes of segments in a block that is sorted.
SORTED = 3 << 20
#: A pick that a task meets so often is known to be repeated; its segments are split into windows.
OFTEN = 64
FIRST_ID = -(1 << 63)

#: Kinds of payloads: segments; runs of covered windows; frequent picks; segments of those.
KNOWN, COVER, HOT, HOT_SEGMENT = 0, 1, 2, 3


def _hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on."""
    h = text.astype(np.uint64) + np.uint64(1)
    k = 1
    while k < GRAM:
        h = h[:-k] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + h[k:] * np.uint64(0xC2B2AE3D27D4EB4F + 4 * k)
        h ^= h >> np.uint64(29)
        k *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _slide(values: np.ndarray, wide: int) -> np.ndarray:
    """The minimum of each `wide` values in a row."""
    k = 1
    while 2 * k <= wide:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    return np.minimum(values[: len(values) - (wide - k)], values[wide - k :]) if wide > k else values


def picks(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For texts of WIDTH bytes at least: number of the text, first window, windows in a row, and their pick's hash."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size) - size
    h = _hashes(np.frombuffer(b"".join(texts), np.uint8))
    at = _slide((h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), WIDTH - GRAM + 1) & np.uint64(0xFFFFFFFF)
    start = np.repeat(begin, size - WIDTH + 1)
    number = np.repeat(np.arange(len(texts)), size - WIDTH + 1)
    first = np.cumsum(size - WIDTH + 1) - (size - WIDTH + 1)
    place = start + np.arange(len(start)) - np.repeat(first, size - WIDTH + 1)
    at = at[place].astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (number[1:] != number[:-1])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(at)))
    return number[head], (place - start)[head], length, h[at[head]]


def _planes(values: np.ndarray) -> bytes:
    """Bytes of like weight together, so that the shuffle's own compression finds them alike."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join(_planes(c) for c in columns)


def _unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    row = sum(np.dtype(k).itemsize for k in kinds)
    n, at, out = len(data) // row, 0, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        part = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(part.T).view(kind).reshape(n))
        at += n * width
    return out


PICK = (np.int64, np.int32, np.int64, np.uint8, np.uint64)  # id, sub, first window, windows, hash
PLACE = (np.int64, np.uint8, np.uint64)  # first window, windows, hash
RUN = (np.int64, np.int64)  # first and last window


def _groups(*keys: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of each distinct key."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    yield from np.split(order, np.flatnonzero(new))


def _rows(kind: list, schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*kind, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], [n for n, _ in schema])


_TO_BLOCK = [("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())]
_OF_DOC = [("id", pa.int64()), ("sub", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())]


def _find_picks(blocks: int):
    """Sends each pick of the partition's texts to the block of its hash; equal segments in one piece send the earliest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        piece: list[tuple[int, int, int, bytes]] = []
        size = total = 0

        def hashed() -> None:
            nonlocal piece, size
            ids, subs, base, texts = (list(x) for x in zip(*piece, strict=True))
            number, first, length, h = picks(texts)
            held.append(_one_of_equal(texts, number, first, length, h, np.array(ids, np.int64), np.array(subs, np.int32), np.array(base, np.int64)))
            piece, size = [], 0

        def sent() -> pa.RecordBatch:
            nonlocal held, total
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            held, total = [], 0
            ident, sub, first, length, h, covered = cols
            out: list[tuple] = []
            block = (h % np.uint64(blocks)).astype(np.int64)
            _, where, count = np.unique(h, return_inverse=True, return_counts=True)
            often = (count[where] >= OFTEN) & ~covered
            for rows in _groups(block[~covered & ~often]):
                rows = np.flatnonzero(~covered & ~often)[rows]
                out.append((int(block[rows[0]]), KNOWN, _pack(*(c[rows] for c in (ident, sub, first, length.astype(np.uint8), h)))))
            marks = np.unique(h[often])
            mark_block = (marks % np.uint64(blocks)).astype(np.int64)
            for rows in _groups(mark_block):
                out.append((int(mark_block[rows[0]]), HOT, _pack(marks[rows])))
            spread = ident.astype(np.uint64) % np.uint64(blocks)
            for mask, kind in ((covered, COVER), (often, HOT_SEGMENT)):
                at = np.flatnonzero(mask)
                for rows in _groups(spread[at]):
                    rows = at[rows]
                    out.append((int(spread[rows[0]]), kind, _pack(*(c[rows] for c in (ident, sub, first, length.astype(np.uint8), h)))))
            return _rows(out, _TO_BLOCK)

        for batch in batches:
            for ident, sub, text in zip(batch.column("id").to_pylist(), batch.column("sub").to_pylist(), octets(batch.column("text")), strict=True):
                for at in range(0, max(0, len(text) - WIDTH + 1), PIECE):
                    part = text[at : at + PIECE + WIDTH - 1]
                    piece.append((ident, sub, at, part))
                    size += len(part)
                    total += len(part)
                    if size >= PIECE:
                        hashed()
                    if total >= TOGETHER and held:
                        yield sent()
        if piece:
            hashed()
        if held:
            yield sent()

    return run


def _one_of_equal(texts, number, first, length, h, ids, subs, base):
    """The segments as id, sub, first, length, hash, covered: covered by an equal one of this piece that comes earlier."""
    ident, sub, start = ids[number], subs[number], first + base[number]
    covered = np.zeros(len(h), bool)
    order = np.lexsort((start, sub, ident, length, h))
    same = np.zeros(len(order), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (length[order][1:] == length[order][:-1])
    lead: dict[bytes, int] = {}
    for i in np.flatnonzero(same | np.append(same[1:], False)).tolist():  # of like hash and length: compare the bytes
        k = int(order[i])
        if not same[i]:
            lead = {}
        a = int(first[k])
        lead_of = lead.setdefault(texts[number[k]][a : a + int(length[k]) + WIDTH - 1], k)
        covered[k] = lead_of != k and (ident[k], sub[k], start[k]) != (ident[lead_of], sub[lead_of], start[lead_of])
    return ident, sub, start, length, h, covered


def _by_document(ident: np.ndarray, sub: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple]:
    return [(int(ident[r[0]]), int(sub[r[0]]), kind, _pack(*(c[r] for c in columns))) for r in _groups(ident, sub)]


def _repeated_picks(group: pa.Table) -> pa.Table:
    """For each document: its segments whose pick is repeated (KNOWN, or HOT if a task met it often), and those covered already."""
    kinds, payloads = group.column("kind").to_pylist(), group.column("payload").to_pylist()
    of = lambda kind: [np.concatenate(c) for c in zip(*(_unpack(p, *PICK) for k, p in zip(kinds, payloads, strict=True) if k == kind), strict=True)]
    out: list[tuple] = []
    marks = [_unpack(p, np.uint64)[0] for k, p in zip(kinds, payloads, strict=True) if k == HOT]
    hot = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.uint64)
    if known := of(KNOWN):
        ident, sub, first, length, h = known
        _, where, count = np.unique(h, return_inverse=True, return_counts=True)
        again, marked = count[where] > 1, np.isin(h, hot) | (count[where] >= 1 << 14)
        for mask, kind in ((again & ~marked, KNOWN), (marked, HOT)):
            out += _by_document(*(c[mask] for c in (ident, sub)), kind, *(c[mask] for c in (first, length, h)))
    if often := of(HOT_SEGMENT):
        ident, sub, first, length, h = often
        out += _by_document(ident, sub, HOT, first, length, h)
    if done := of(COVER):
        ident, sub, first, length, _ = done
        out += _by_document(ident, sub, COVER, first, first + length - 1)
    return pa.Table.from_batches([_rows(out, _OF_DOC)])


def _cut_segments(blocks: int):
    """Sends the bytes of repeated segments to the block of their pick; those of frequent picks window by window, by content."""
    schema = [("block", pa.int64()), ("ids", pa.binary()), ("bytes", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int, int, bytes]] = []
        windows: dict[bytes, tuple[int, int, int]] = {}
        size = 0

        def sent() -> pa.RecordBatch:
            nonlocal held, windows, size
            held += [(int.from_bytes(hashlib.blake2b(w, digest_size=7).digest()), *at, 1, w) for w, at in windows.items()]
            block = np.fromiter((x[0] % blocks for x in held), np.int64, len(held))
            out = []
            for rows in _groups(block):
                part = [held[i] for i in rows.tolist()]
                columns = [np.array([x[k] for x in part], t) for k, t in ((1, np.int64), (2, np.int32), (3, np.int64), (4, np.uint8))]
                out.append((int(block[rows[0]]), _pack(*columns), b"".join(x[5] for x in part)))
            held, windows, size = [], {}, 0
            return _rows(out, schema)

        for batch in batches:
            for ident, sub, text, kinds, payloads in zip(*(batch.column(c).to_pylist() for c in ("id", "sub")), octets(batch.column("text")), *(batch.column(c).to_pylist() for c in ("kinds", "payloads")), strict=True):
                for kind, payload in zip(kinds, payloads, strict=True):
                    for first, length, h in zip(*(c.tolist() for c in _unpack(payload, *PLACE)), strict=True):
                        if kind == KNOWN:
                            held.append((h, ident, sub, first, length, text[first : first + length + WIDTH - 1]))
                            size += length + WIDTH
                            continue
                        for at in range(first, first + length):
                            w, here = text[at : at + WIDTH], (ident, sub, at)
                            before = windows.get(w)
                            if before is None:
                                windows[w] = here
                                size += WIDTH
                            elif before != here:  # the earlier stays for all; the later one is a copy like any other
                                windows[w] = min(before, here)
                                late = max(before, here)
                                held.append((int.from_bytes(hashlib.blake2b(w, digest_size=7).digest()), *late, 0, b""))
                if size >= TOGETHER or len(held) > 200_000:
                    yield sent()
        if held or windows:
            yield sent()

    return run


def _sorted_block(group: pa.Table) -> pa.Table:
    """Windows of the block that an equal window comes before, as runs for each document."""
    ids = [_unpack(p, np.int64, np.int32, np.int64, np.uint8) for p in group.column("ids").to_pylist()]
    ident, sub, first, length = (np.concatenate(c) for c in zip(*ids, strict=True))
    place: dict[bytes, list[int]] = {}
    row, covered = 0, []
    for (_, _, _, lengths), data in zip(ids, group.column("bytes").to_pylist(), strict=True):
        at = 0
        for n in lengths.tolist():
            if n == 0:  # known to be a copy of a window
                covered.append((row, 0, 0))
            else:
                place.setdefault(data[at : at + n + WIDTH - 1], []).append(row)
                at += n + WIDTH - 1
            row += 1
    strings = list(place)
    earliest = np.zeros(len(strings), np.int64)
    for i, rows in enumerate(place.values()):  # equal segments: the earliest stands for all, the others are covered
        key = lambda r: (ident[r], sub[r], first[r])
        earliest[i] = best = min(rows, key=key) if len(rows) > 1 else rows[0]
        if len(rows) > 1:
            top = key(best)
            covered += [(r, 0, int(length[r]) - 1) for r in rows if r != best and key(r) != top]
    starts, ends = [np.array([c[k] for c in covered], np.int64) for k in (1, 2)]
    at_rows = np.array([c[0] for c in covered], np.int64)
    if len(strings):
        owner, offset, common = two_stage_order(strings, length[earliest].astype(np.int64), WIDTH)
        number = np.cumsum(common < WIDTH)  # suffixes of one number are equal to WIDTH bytes
        rows = earliest[owner]
        order = np.lexsort((first[rows] + offset, sub[rows], ident[rows], number))
        late = np.zeros(len(order), bool)
        late[1:] = number[order][1:] == number[order][:-1]
        late = order[late]
        at_rows, starts, ends = np.concatenate([at_rows, rows[late]]), np.concatenate([starts, offset[late]]), np.concatenate([ends, offset[late]])
    a, b = _joined(ident[at_rows], sub[at_rows], first[at_rows] + starts, first[at_rows] + ends)
    return pa.Table.from_batches([_rows(_by_document(*a, COVER, *b), _OF_DOC)])


def _joined(ident, sub, start, end):
    """Runs of windows that meet become one."""
    order = np.lexsort((start, sub, ident))
    ident, sub, start, end = ident[order], sub[order], start[order], end[order]
    if not len(order):
        return (ident, sub), (start, end)
    new = np.ones(len(order), bool)
    new[1:] = (ident[1:] != ident[:-1]) | (sub[1:] != sub[:-1]) | (start[1:] > end[:-1] + 1)
    head = np.flatnonzero(new)
    return (ident[head], sub[head]), (start[head], np.maximum.reduceat(end, head))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The removed runs of each document, and what is left."""
    for batch in batches:
        out = []
        for ident, sub, text, payloads in zip(*(batch.column(c).to_pylist() for c in ("id", "sub")), octets(batch.column("text")), batch.column("payloads").to_pylist(), strict=True):
            start, end = (np.concatenate(c) for c in zip(*(_unpack(p, *RUN) for p in payloads), strict=True))
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order] + WIDTH)
            head = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
            begin, stop = start[head], end[np.append(head[1:] - 1, len(end) - 1)]
            rest, at = hashlib.sha256(), 0
            for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
                rest.update(text[at:a])
                at = b
            rest.update(text[at:])
            out.append((ident, sub, int((stop - begin).sum()), len(begin), rest.hexdigest(), np.stack([begin, stop], 1).tolist()))
        kinds = [("id", pa.int64()), ("sub", pa.int32()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))]
        yield _rows(out, kinds)


def _identified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with a document's order (id, sub), and one row for each of the documents.

    sub is 0 unless rows share an id: then texts of the same id count by their hash.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    if rows.groupBy("id").count().filter("count > 1").isEmpty():
        rows = rows.withColumn("sub", F.lit(0))
        return rows, rows.select("id", "sub", "text")
    keyed = rows.withColumn("digest", F.sha2("text", 256))
    shared = keyed.groupBy("id").agg(F.array_sort(F.collect_set("digest")).alias("texts"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", F.posexplode("texts").alias("number", "digest"))
    rows = keyed.join(shared, ["id", "digest"], "left").select("doc_id", "id", "text", F.coalesce("number", F.lit(0)).alias("sub"))
    return rows, rows.select("id", "sub", "text").dropDuplicates(["id", "sub"])


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows of docs (doc_id, id, sub, text), and id, sub, n_removed, n_spans, kept_sha256, spans of documents that lose bytes."""
    rows, work = _identified(docs)
    size = work.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(wide(docs), size // BLOCK)
    to_block, of_doc = "block long, kind int, payload binary", "id long, sub int, kind int, payload binary"
    found = work.mapInArrow(_find_picks(blocks), to_block).groupBy("block").applyInArrow(_repeated_picks, of_doc)
    found = staged(found, "suffix-picks")
    asked = found.filter(F.col("kind") != COVER).groupBy("id", "sub").agg(F.collect_list("kind").alias("kinds"), F.collect_list("payload").alias("payloads"), F.sum(F.octet_length("payload")).alias("n"))
    asked = staged(asked, "suffix-asked")
    # a segment is named in 17 bytes and has 134, mostly
    blocks = max(wide(docs), (asked.agg(F.sum("n")).first()[0] or 0) * 8 // SORTED)
    cut = work.join(asked.drop("n").hint("shuffle_hash"), ["id", "sub"]).mapInArrow(_cut_segments(blocks), "block long, ids binary, bytes binary")
    late = staged(cut.groupBy("block").applyInArrow(_sorted_block, of_doc), "suffix-late")
    covers = found.filter(F.col("kind") == COVER).unionByName(late).groupBy("id", "sub").agg(F.collect_list("payload").alias("payloads"))
    covers = staged(covers, "suffix-covers")
    spans = work.join(covers.hint("shuffle_hash"), ["id", "sub"]).mapInArrow(_remove, "id long, sub int, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    return rows, staged(spans, "suffix-spans")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row for each document.

    Each byte goes that a string of WIDTH bytes covers which also starts earlier: in a smaller doc_id, or in the same
    document before. A null text counts as empty; a null doc_id comes before all others; rows that share a doc_id are
    documents in the order of their texts' digests, and one document if their texts are equal, so that each gets the same answer; texts
    shorter than WIDTH lose nothing; an empty table gives an empty result; other columns are ignored.
    """
    rows, spans = repeated_spans(docs)
    slim = rows.select("doc_id", "id", "sub", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    out = slim.join(spans.drop("spans"), ["id", "sub"], "left")
    zero = F.lit(0).cast("bigint")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))
