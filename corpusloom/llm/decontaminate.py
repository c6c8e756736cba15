"""Benchmark decontamination by edit distance.

A document leaks an item of n words if some window of n words of it (or what the document has left) is within
floor(0.2 n) word edits of the item. The CGK random walk (Chakraborty, Goldenberg and Koucky, 2016) embeds windows and
items so that edit distance becomes Hamming distance; bit-sampling LSH over the embeddings, repeated until the target
recall is reached, proposes pairs, and the exact edit distance decides. Windows that by the q-gram lemma can't be
within the distance of any item of their size are not embedded; that loses nothing. Items too short for grams allow one edit
at most: their windows are looked up whole, or with each word left out, which finds all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import octets, pieces, table

#: The q-gram lemma leaves a gram, and AGREEMENT holds, from this similarity up.
SIMILARITY = 0.8
#: Items of fewer words are looked up exactly.
SHORT = 6
GRAM = 3
#: Coordinates of the embedding that a hash samples, and hashes; see recall_repeats.
COORDINATES, RECALL = 2, 0.99
#: The part of the first n coordinates in which pairs at the limit of the distance agree (measured for n from 6 to 60).
AGREEMENT = 0.39
#: Bytes of text that are searched at once.
PIECE = 16 << 20
ITEMS_AT_ONCE = 20_000
SEED = 5
_PARTS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A to Z) runs of letters, digits and bytes of other scripts."""
    return text.lower().translate(_PARTS).split()


def recall_repeats(recall: float = RECALL, agreement: float = AGREEMENT, coordinates: int = COORDINATES) -> int:
    """Hashes needed for the recall, when each finds a pair with probability agreement ** coordinates."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - agreement**coordinates)))


@dataclass(frozen=True)
class Items:
    """The items of one size class after another, as word numbers."""

    ids: list[list[int | None]]  # of each distinct item: its item_ids
    words: dict[bytes, int]
    sizes: dict[int, tuple[np.ndarray, np.ndarray]]  # n: numbers of the items, their words as rows
    grams: np.ndarray  # sorted codes
    gram_from: np.ndarray
    gram_sizes: np.ndarray  # of grams[i]: sizes of the items that have it, at gram_from[i] to gram_from[i + 1]
    kept: dict = field(default_factory=dict)

    def hashed(self, n: int, repeats: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """hashed_items of the items of n words, kept for the next piece of text."""
        if (n, repeats) not in self.kept:
            self.kept[n, repeats] = hashed_items(self.sizes[n][1], repeats)
        return self.kept[n, repeats]

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]]) -> Items:
        texts: dict[tuple[bytes, ...], list[int | None]] = {}
        for item, text in rows:
            key = tuple(tokens((text or "").encode()))
            if key:
                texts.setdefault(key, []).append(item)
        words: dict[bytes, int] = {}
        coded = [[words.setdefault(w, len(words)) for w in key] for key in texts]
        sizes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({len(c) for c in coded}):
            of_n = [i for i, c in enumerate(coded) if len(c) == n]
            sizes[n] = (np.array(of_n), np.array([coded[i] for i in of_n], np.int64))
        pairs = sorted({(int(g), n) for n, (_, rows_) in sizes.items() if n >= SHORT for row in rows_ for g in gram_codes(row, len(words))})
        code, of = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
        grams, first = np.unique(code, return_index=True)
        return Items(list(texts.values()), words, sizes, grams, np.append(first, len(code)), of)


def gram_codes(ids: np.ndarray, base: int) -> np.ndarray:
    """A number for each GRAM words in a row; negative if one of them is in no item."""
    if len(ids) < GRAM:
        return np.zeros(0, np.int64)
    parts = [ids[i : len(ids) - GRAM + 1 + i] for i in range(GRAM)]
    code = reduce(lambda a, b: a * base + b, parts)
    return np.where(np.minimum.reduce(parts) < 0, -1, code)


def edit_distances(windows: np.ndarray, length: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Word edits between the first length[i] of windows[i] and all of items[i]."""
    n = items.shape[1]
    steps = np.arange(n + 1, dtype=np.int16)
    row = np.broadcast_to(steps, (len(items), n + 1)).copy()
    out = np.where(length == 0, n, 0).astype(np.int16)
    for i in range(windows.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (windows[:, i : i + 1] != items), out=new[:, 1:])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        ends = length == i + 1
        out[ends] = row[ends, n]
    return out


def walks(strings: np.ndarray, coordinates: np.ndarray, seed: int) -> np.ndarray:
    """A hash of the sampled coordinates of each row's CGK embedding.

    In step j the walk writes the word it stands on and goes on to the next one if a random bit of (j, word) is set.
    """
    n = strings.shape[1]
    padded = np.hstack([strings, np.full((len(strings), 1), -3, np.int64)]).view(np.uint64)
    row, at = np.arange(len(strings)), np.zeros(len(strings), np.int64)
    out = np.zeros(len(strings), np.uint64)
    wanted = set(coordinates.tolist())
    for j in range(int(coordinates.max()) + 1):
        word = padded[row, at]
        if j in wanted:
            out = (out ^ (word + np.uint64(j + 1))) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        mixed = (word + np.uint64((seed * 1_000_003 + j) * 0x2545F491)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        at = np.minimum(at + (mixed >> np.uint64(63)).astype(np.int64), n)
    return out


def hashed_items(items: np.ndarray, repeats: int, coordinates: int = COORDINATES) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each repeat: the sampled coordinates, the items' sorted hashes, and which items these are.

    Of a walk's 3n coordinates the first n are sampled: they agree most, and still reach past the middle of the string.
    """
    n, out = items.shape[1], []
    for r in range(repeats):
        sampled = np.random.default_rng((SEED, r, n)).integers(0, n, coordinates)
        k = walks(items, sampled, r)
        order = np.argsort(k, kind="stable")
        out.append((sampled, k[order], order))
    return out


def proposals(windows: np.ndarray, hashed: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n_items: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (window, item) whose sampled coordinates agree in at least one of the repeats."""
    found = []
    for r, (sampled, k, order) in enumerate(hashed):
        w = walks(windows, sampled, r)
        low, high = np.searchsorted(k, w, "left"), np.searchsorted(k, w, "right")
        who = np.repeat(np.arange(len(w)), high - low)
        within = np.arange(len(who)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        found.append(who * n_items + order[np.repeat(low, high - low) + within])
    pairs = np.unique(np.concatenate(found))
    return pairs // n_items, pairs % n_items


def looked_up(windows: np.ndarray, length: np.ndarray, items: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (window, item) that are equal or, if `most` is 1, differ in one word at most; few others (hashes meet)."""

    def same(who: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = []
        for x in (a, b):
            key = np.zeros(len(x), np.uint64)
            for j in range(x.shape[1]):
                key = (key ^ x[:, j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            keys.append(key)
        order = np.argsort(keys[1], kind="stable")
        low, high = (np.searchsorted(keys[1][order], keys[0], side) for side in ("left", "right"))
        row = np.repeat(np.arange(len(a)), high - low)
        return who[row], order[np.repeat(low, high - low) + np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]

    n, whole = items.shape[1], np.flatnonzero(length == items.shape[1])
    found = [same(whole, windows[whole], items)]
    if most:
        cut = np.flatnonzero(length == n - 1)
        for k in range(n):
            left = np.delete(items, k, axis=1)
            found += [same(whole, np.delete(windows[whole], k, axis=1), left), same(cut, windows[cut, : n - 1], left)]
    pairs = np.unique(np.concatenate([w * len(items) + i for w, i in found]))
    return pairs // len(items), pairs % len(items)


def _starts(hits: np.ndarray, n: int, need: int, gram: int = GRAM) -> np.ndarray:
    """Starts of windows of n words that hold at least `need` of the (sorted) gram positions."""
    if len(hits) < need:
        return np.zeros(0, np.int64)
    first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
    low = last - (n - gram)
    ok = low <= first
    low, high = low[ok], first[ok] + 1
    if not len(low):
        return low
    low = np.maximum(low, np.concatenate([[low[0]], np.maximum.accumulate(high)[:-1]]))
    size = np.maximum(high - low, 0)
    return np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def leaks(texts: list[bytes], items: Items, similarity: float = SIMILARITY, repeats: int | None = None) -> np.ndarray:
    """Rows (text, distinct item, distance, start): the best window of each text and item that leak."""
    if similarity < SIMILARITY:
        raise ValueError(f"similarity must be {SIMILARITY} at least")
    none = np.zeros((0, 4), np.int64)
    repeats = repeats or recall_repeats()
    if not items.sizes:
        return none
    get = items.words.get
    coded = [np.fromiter(map(get, t, repeat(-1)), np.int64, len(t)) for t in map(tokens, texts)]
    ends = np.cumsum([len(c) + GRAM for c in coded])  # a gap of words in no item after each text
    gap = np.full(GRAM, -1, np.int64)
    line = np.concatenate([x for c in coded for x in (c, gap)]) if coded else gap
    codes = gram_codes(line, len(items.words))
    known = np.flatnonzero(codes >= 0)
    at = np.searchsorted(items.grams, codes[known])
    hit = items.grams[np.minimum(at, len(items.grams) - 1)] == codes[known] if len(items.grams) else np.zeros(len(known), bool)
    known, at = known[hit], at[hit]
    count = items.gram_from[at + 1] - items.gram_from[at]
    where = np.repeat(known, count)
    sizes = items.gram_sizes[np.repeat(items.gram_from[at], count) + np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count)]
    order = np.lexsort((where, sizes))
    where, sizes = where[order], sizes[order]
    found = []
    for n, (numbers, words) in items.sizes.items():
        hashed = None
        most = int(np.floor(n * (1 - similarity) + 1e-9))
        lo, hi = np.searchsorted(sizes, [n, n + 1])
        if n < SHORT:
            of_n = np.zeros(len(items.words) + 1, bool)  # the last one is for words in no item
            of_n[words] = True
            starts = _starts(np.flatnonzero(of_n[np.maximum(line, -1)]), n, n - most, 1)
        else:
            starts = _starts(where[lo:hi], n, max(1, n - GRAM + 1 - GRAM * most))
        text = np.searchsorted(ends, np.maximum(starts, 0), "right")
        begin = np.where(text > 0, ends[np.maximum(text, 1) - 1], 0)
        starts_in = np.maximum(starts, begin)
        length = np.minimum(ends[np.minimum(text, len(ends) - 1)] - GRAM - starts_in, n)
        keep = (starts >= 0) & (text < len(ends)) & (length >= n - most)
        starts, text, length, begin = starts[keep], text[keep], length[keep], begin[keep]
        for cut in range(0, len(starts), 1 << 15):
            s, t, m, b = (x[cut : cut + (1 << 15)] for x in (starts, text, length, begin))
            grid = s[:, None] + np.arange(n)
            windows = np.where(np.arange(n) < m[:, None], line[np.minimum(grid, len(line) - 1)], -2)
            if n < SHORT:
                w, k = looked_up(windows, m, words, most)
            else:
                hashed = hashed or items.hashed(n, repeats)
                w, k = proposals(windows, hashed, len(words))
            for part in range(0, len(w), 1 << 14):
                x, y = w[part : part + (1 << 14)], k[part : part + (1 << 14)]
                distance = edit_distances(windows[x], m[x], words[y])
                ok = distance <= most
                found.append(np.stack([t[x[ok]], numbers[y[ok]], distance[ok].astype(np.int64), (s - b)[x[ok]]], axis=1))
    if not found:
        return none
    out = np.concatenate(found)
    out = out[np.lexsort((out[:, 3], out[:, 2], out[:, 1], out[:, 0]))]
    return out[np.unique(out[:, :2], axis=0, return_index=True)[1]]


def item_blocks(benchmark: DataFrame, most: int = ITEMS_AT_ONCE) -> Iterator[Items]:
    """The benchmark in blocks of bounded size, each of which goes to all documents."""
    rows = iter(benchmark.select(F.col("item_id").cast("bigint"), "text").toLocalIterator())
    while block := [(r[0], r[1]) for r in islice(rows, most)]:
        items = Items.of(block)
        for n in items.sizes:  # once here, not in every task
            if n >= SHORT:
                items.hashed(n, recall_repeats())
        yield items


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Returns doc_id, item_id, distance, start (in words), n_words: each leaked item of each leaking document, at its best window.

    Words are lower-cased runs of letters and digits. Null and empty texts leak nothing and aren't leaked; items of any
    number of words are looked for, those of up to four only as they are; null ids come back as null; items with the same words are all reported, as are
    repeated documents; empty tables give an empty result; other columns are ignored.
    """
    schema = "doc_id long, item_id long, distance int, start long, n_words int"

    def search(items: Items):
        length = {int(i): n for n, (numbers, _) in items.sizes.items() for i in numbers}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text", PIECE):
                    hits = leaks(octets(part.column("text")), items, similarity).tolist()
                    doc = part.column("doc_id").to_pylist()
                    flat = [(doc[t], item, d, s, length[k]) for t, k, d, s in hits for item in items.ids[k]]
                    columns = list(zip(*flat, strict=True)) or [[]] * 5
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "distance", "start", "n_words"])

        return run

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = [slim.mapInArrow(search(items), schema) for items in item_blocks(benchmark)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that leak no item, with all their columns; nothing is shuffled.

    Null and empty texts leak nothing and stay; repeated rows stay or go together; an empty table on either side drops nothing.
    """

    def clean_of(items: Items):
        @F.arrow_udf("boolean")
        def clean(text: pa.Array) -> pa.Array:
            out = np.ones(len(text), bool)
            batch, at = pa.RecordBatch.from_arrays([text], ["text"]), 0
            for part in pieces(batch, "text", PIECE):
                out[at + leaks(octets(part.column("text")), items, similarity)[:, 0]] = False
                at += part.num_rows
            return pa.array(out)

        return clean

    for items in item_blocks(benchmark):
        docs = docs.filter(clean_of(items)(F.col("text")))
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
