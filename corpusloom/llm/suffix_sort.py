"""Two-stage suffix sorting (Itoh and Tanaka, 1999) of many short strings at once, with numpy.

A suffix that is smaller than its successor (the suffix one byte on) is sorted directly. The order of the rest follows:
scanning buckets (suffixes by first byte) from the smallest, whatever precedes a suffix just met, and is larger than it,
comes next in its own bucket. Orders are only needed to the depth of the strings that count as repeated.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each place of text (ends of strings are zeros, bytes are 1 to 256), whether its suffix is smaller than the next one.

    An end counts as smaller. Equal neighbours go by the first place after them that differs.
    """
    n = len(text)
    after = np.append(text[1:], 0).astype(np.int32)
    differs = np.flatnonzero((text != after) | (text == 0))
    nearest = differs[np.minimum(np.searchsorted(differs, np.arange(n)), len(differs) - 1)]
    return (text[nearest] < after[nearest]) | (text[nearest] == 0)


def two_stage_order(strings: list[bytes], windows: list[int] | np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts the first windows[i] suffixes of each string by their first `depth` bytes.

    Returns the string and the offset of each suffix in order, and the length of the prefix, `depth` at most, that each
    has in common with the one before it.
    """
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    begin = np.cumsum(size + 1) - (size + 1)
    raw = np.frombuffer(b"\0".join(strings) + b"\0" * 9, np.uint8)
    n = int(size.sum()) + len(strings)
    text = raw[:n].astype(np.uint16) + 1
    text[begin + size] = 0
    owner = np.repeat(np.arange(len(strings)), size + 1)
    small = smaller_than_next(text)
    # Wanted suffixes, and those after them up to the first that is sorted directly, from which the order follows.
    places = np.arange(n)
    inside = places - begin[owner]
    stops = np.flatnonzero(small)
    last = begin + np.asarray(windows, np.int64) - 1
    last = stops[np.searchsorted(stops, last)]
    used = places <= last[owner]
    direct = np.flatnonzero(used & small)
    blob = raw.tobytes()
    ends = (begin + size)[owner[direct]]
    keys = [blob[a:b] for a, b in zip(direct.tolist(), np.minimum(direct + depth, ends).tolist(), strict=True)]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    induced = used & ~small
    pending: list[list[np.ndarray]] = [[] for _ in range(257)]
    by_byte = np.split(direct, np.searchsorted(text[direct], np.arange(1, 257)))
    order = []
    for byte in range(257):
        wave = np.concatenate(pending[byte]) if pending[byte] else np.zeros(0, np.int64)
        found = []
        while len(wave):
            found.append(wave)
            before = wave[wave > 0] - 1
            wave = before[induced[before] & (text[before] == byte)]
        found.append(by_byte[byte])
        bucket = np.concatenate(found)
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (text[before] > byte)]
        if len(before):
            before = before[np.argsort(text[before], kind="stable")]
            bytes_, at = np.unique(text[before], return_index=True)
            for b, part in zip(bytes_.tolist(), np.split(before, at[1:]), strict=True):
                pending[b].append(part)
    sa = np.concatenate(order)
    sa = sa[inside[sa] < np.asarray(windows, np.int64)[owner[sa]]]
    return owner[sa], inside[sa], common_prefixes(raw, sa, np.minimum((begin + size)[owner[sa]] - sa, depth))


def common_prefixes(raw: np.ndarray, sa: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The length of the common prefix of each suffix with the one before it, up to both limits; the first has none."""
    out = np.zeros(len(sa), np.int64)
    if len(sa) < 2:
        return out
    most = np.minimum(limit[1:], limit[:-1])
    step, alive = 0, np.arange(1, len(sa))
    words = np.lib.stride_tricks.sliding_window_view(raw, 8)
    while len(alive):
        at = np.minimum(np.stack([sa[alive], sa[alive - 1]]) + step, len(words) - 1)
        same = (words[at[0]] == words[at[1]]).cumprod(axis=1).sum(axis=1)
        out[alive] += same
        step += 8
        alive = alive[(same == 8) & (out[alive] < most[alive - 1])]
    out[1:] = np.minimum(out[1:], most)
    return out
