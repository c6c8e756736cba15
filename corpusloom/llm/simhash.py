"""SimHash near-dedup: fingerprints of word shingles, joined with themselves over a binary trie."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import octets, staged, table
from corpusloom.llm.components import components

SEED = 42
#: Below this many leaf pairs a node pair is compared directly.
SMALL = 64
#: Node or leaf pairs that a task holds at once.
AT_ONCE = 1 << 20


def shingles(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; A to Z count as lower case, fewer words are one shingle, no words none."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(tokens), len(tokens) - words + 1
    if n < 2:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)], np.uint64)


def fingerprint(text: bytes, words: int = 3) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64; zero for a text without words."""
    hashes = shingles(text, words)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in octets(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _moved(values: np.ndarray, order: list[int]) -> np.ndarray:
    """Bit order[0] becomes the highest, and so on."""
    out = np.zeros_like(values)
    for place, bit in enumerate(order):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(63 - place)
    return out


def _moved_back(values: np.ndarray, order: list[int]) -> np.ndarray:
    out = np.zeros_like(values)
    for place, bit in enumerate(order):
        out |= ((values >> np.uint64(63 - place)) & np.uint64(1)) << np.uint64(bit)
    return out


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of counts[i] items: i, and the item's number within i."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def trie_pairs(a: np.ndarray, b: np.ndarray, skip: int, budget: int, at_once: int = AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with at most `budget` bits between a[i] and b[j], both sorted; i < j where a is b.

    A trie node is a range of the sorted values that share their leading bits. Node pairs go down together;
    each step adds a differing bit or none, and a pair over budget is dropped with all below it. The first `skip` bits
    are the same within each side.
    """
    same = a is b
    if not len(a) or not len(b):
        return
    start = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - skip))) if skip else 0
    if start > budget:
        return
    one = lambda x: np.array([x], np.int64)
    stack = [(63 - skip, one(0), one(len(a)), one(0), one(len(b)), one(start))]
    while stack:
        bit, al, ah, bl, bh, spent = stack.pop()
        if len(al) > at_once:
            half = len(al) // 2
            stack += [(bit, *(x[:half] for x in (al, ah, bl, bh, spent))), (bit, *(x[half:] for x in (al, ah, bl, bh, spent)))]
            continue
        small = ((ah - al) * (bh - bl) <= SMALL) | (bit < 0)
        pick = np.flatnonzero(small)
        while len(pick):
            cut = max(1, int(np.searchsorted(np.cumsum((ah[pick] - al[pick]) * (bh[pick] - bl[pick])), 4 * at_once)))
            now, pick = pick[:cut], pick[cut:]
            wide = bh[now] - bl[now]
            owner, k = _expand((ah[now] - al[now]) * wide)
            i, j = al[now][owner] + k // wide[owner], bl[now][owner] + k % wide[owner]
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            yield i[near], j[near]
        rest = np.flatnonzero(~small)
        if not len(rest):
            continue
        al, ah, bl, bh, spent = (x[rest] for x in (al, ah, bl, bh, spent))
        mask, high = np.uint64(1 << bit), np.uint64(((1 << 64) - 1) ^ ((1 << (bit + 1)) - 1))
        am, bm = np.searchsorted(a, (a[al] & high) | mask), np.searchsorted(b, (b[bl] & high) | mask)
        self_pair = (al == bl) & (ah == bh) & same
        down = []
        for x0, x1, y0, y1, cost, keep in ((al, am, bl, bm, 0, True), (am, ah, bm, bh, 0, True), (al, am, bm, bh, 1, True), (am, ah, bl, bm, 1, ~self_pair)):
            ok = (x1 > x0) & (y1 > y0) & (spent + cost <= budget) & keep
            down.append((x0[ok], x1[ok], y0[ok], y1[ok], spent[ok] + cost))
        stack.append((bit - 1, *(np.concatenate(x) for x in zip(*down, strict=True))))


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest reachable index of each of n nodes, from a stream of links that is never held whole."""
    label = np.arange(n)
    for i, j in pairs:
        while len(i):
            x, y = label[i], label[j]
            if not (differ := x != y).any():
                break
            i, j, x, y = i[differ], j[differ], x[differ], y[differ]
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(label, high, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _join_group(order: list[int], depth: int, budget: int):
    def run(group: pa.Table) -> pa.Table:
        values = np.unique(group.column("p").to_numpy().view(np.uint64))
        if depth:
            side = values >> np.uint64(64 - depth)
            cut = int(np.searchsorted(side, side[-1])) if side[0] != side[-1] else 0
        else:
            cut = 0
        a, b = (values[:cut], values[cut:]) if cut else (values, values)
        key = int(group.column("pair")[0].as_py())
        if not cut and (key >> 32) != (key & 0xFFFFFFFF):
            label = np.arange(len(values))  # the other side is empty
        else:
            pairs = trie_pairs(a, b, depth, budget)
            label = spanning(len(values), ((i, j + cut) for i, j in pairs))
        linked = np.flatnonzero(label != np.arange(len(values)))
        back = lambda x: pa.array(_moved_back(x, order).view(np.int64))
        return pa.table({"u": back(values[linked]), "v": back(values[label[linked]])})

    return run


def near_links(prints: DataFrame, budget: int, per_block: int = 1 << 16) -> DataFrame:
    """u, v: links that connect whatever distinct fingerprints within `budget` bits connect.

    The trie's first levels are shared out: a task gets two nodes of one depth whose prefixes are within budget.
    Balanced bits come first, so that the nodes are of even size; the depth follows the number of fingerprints.
    """
    counts = prints.agg(F.count(F.lit(1)), *[F.sum(F.getbit("fp", F.lit(b))) for b in range(64)]).first()
    n, ones = counts[0], [int(x or 0) for x in counts[1:]]
    order = sorted(range(64), key=lambda b: (abs(2 * ones[b] - n), b))
    depth = 0
    while n >> depth > per_block and depth < 24:
        depth += 1
    masks = np.array([sum(1 << b for b in c) for k in range(min(budget, depth) + 1) for c in combinations(range(depth), k)], np.uint64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _moved(batch.column("fp").to_numpy().view(np.uint64), order)
            top = p >> np.uint64(64 - depth) if depth else np.zeros_like(p)
            for mask in masks:
                other = top ^ mask
                pair = (np.minimum(top, other) << np.uint64(32)) | np.maximum(top, other)
                yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(p.view(np.int64))], ["pair", "p"])

    return prints.select("fp").mapInArrow(spread, "pair long, p long").groupBy("pair").applyInArrow(_join_group(order, depth, budget), "u long, v long")


def simhash_groups(docs: DataFrame, words: int = 3, budget: int = 3) -> DataFrame:
    """Returns doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links of at most `budget` differing bits.

    A text without words, null included, has fingerprint zero and links like any other; a text of fewer words than a
    shingle is one shingle. Equal fingerprints are one node, so copies make no pairs. Null doc_ids don't count for
    the smallest; a component of nulls only has a null id; repeated rows get the same answer; an empty table gives an
    empty result; other columns are ignored.
    """
    slim = staged(fingerprints(docs, words), "simhash-prints")
    distinct = staged(slim.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(near_links(distinct, budget), "simhash")
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = staged(of.join(least, "root").select("fp", "component_id"), "simhash-ids")
    return slim.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
