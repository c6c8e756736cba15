"""A unigram language model over an existing subword vocabulary: likelihoods summed over all segmentations.

A word, led by a blank, is a lattice: its bytes are the nodes, and each piece of the vocabulary that occurs in it is
an edge. The forward recursion, in log space, adds up every path, so no single segmentation is chosen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np

NONE = -np.inf
#: Longer pieces are few, so they are looked up only where their first so many bytes stand; words above this size go one by one.
COMMON_PIECE, ONE_BY_ONE = 16, 48
_BASE, _MIX = np.uint64(0x100000001B3), (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SLOTS = 18


def read_vocabulary(path: str) -> dict[bytes, float]:
    """Pieces as bytes, with their scores as relative weights, from a sentencepiece file. Its word mark is a blank.

    This kind of file scores a piece by its rank, best first, which is taken for a Zipf law. Every single byte is a
    piece, with a small weight if it has no score of its own, so that each text can be segmented.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    weights: dict[bytes, float] = {}
    for rank, i in enumerate(sorted(plain, key=lambda i: (-model.get_score(i), i))):
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:] and piece == piece.lower():
            weights[piece] = weights.get(piece, 0.0) + 1 / (rank + 2.7)
    for b in range(256):
        weights[bytes([b])] = weights.get(bytes([b]), 0.0) + 1e-6
    return weights


def _code(piece: bytes) -> int:
    code = 1
    for b in piece:
        code = (code * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return code


@dataclass(frozen=True)
class Lattice:
    """Pieces, their natural log probabilities (a column for each class), and hash tables from piece codes to numbers."""

    pieces: list[bytes]
    where: dict[bytes, int]
    logp: np.ndarray
    codes: np.ndarray
    slots: tuple[np.ndarray, np.ndarray]
    longest: int
    heads: frozenset[bytes]  # of the long pieces
    head_codes: np.ndarray

    @staticmethod
    def of(pieces: list[bytes], logp: np.ndarray) -> Lattice:
        codes = np.fromiter(map(_code, pieces), np.uint64, len(pieces))
        heads = frozenset(p[:COMMON_PIECE] for p in pieces if len(p) > COMMON_PIECE)
        head_codes = np.fromiter(map(_code, sorted(heads)), np.uint64, len(heads))
        first, second = np.full(1 << _SLOTS, -1, np.int32), np.full(1 << _SLOTS, -1, np.int32)
        for i, at in enumerate(((codes * _MIX[0]) >> np.uint64(64 - _SLOTS)).tolist()):
            first[at] = i if first[at] < 0 else first[at]
        lost = np.flatnonzero(first[((codes * _MIX[0]) >> np.uint64(64 - _SLOTS)).astype(np.int64)] != np.arange(len(codes)))
        second_at = (codes * _MIX[1]) >> np.uint64(64 - _SLOTS)
        for i in lost.tolist():
            at = int(second_at[i])
            while second[at] >= 0:  # rare: linear probing
                at = (at + 1) % (1 << _SLOTS)
            second[at] = i
        return Lattice(pieces, {p: i for i, p in enumerate(pieces)}, logp.reshape(len(pieces), -1), codes, (first, second), max(map(len, pieces), default=0), heads, head_codes)

    def with_logp(self, logp: np.ndarray) -> Lattice:
        return replace(self, logp=logp)

    def numbers(self, code: np.ndarray) -> np.ndarray:
        """The piece of each code, or -1."""
        n = self.slots[0][((code * _MIX[0]) >> np.uint64(64 - _SLOTS)).astype(np.int64)]
        out = np.where((n >= 0) & (self.codes[n] == code), n, -1)
        at = ((code * _MIX[1]) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        left = np.flatnonzero((out < 0) & (self.slots[1][at] >= 0))
        while len(left):
            n = self.slots[1][at[left]]
            ok = self.codes[n] == code[left]
            out[left[ok]] = n[ok]
            left = left[~ok]
            at[left] = (at[left] + 1) % (1 << _SLOTS)
            left = left[self.slots[1][at[left]] >= 0]
        return out

    def _edges(self, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """start, end, rows and pieces of the edges in words of one length (as rows of bytes), by start."""
        n = words.shape[1]
        for i in range(n):
            code = np.ones(len(words), np.uint64)
            for j in range(i + 1, min(n, i + COMMON_PIECE) + 1):
                code = code * _BASE + words[:, j - 1].astype(np.uint64) + np.uint64(1)
                number = self.numbers(code)
                rows = np.flatnonzero(number >= 0)
                if len(rows):
                    yield i, j, rows, number[rows]
            if n <= i + COMMON_PIECE or not len(self.head_codes):
                continue
            left = np.flatnonzero(np.isin(code, self.head_codes))
            code = code[left]
            for j in range(i + COMMON_PIECE + 1, min(n, i + self.longest) + 1) if len(left) else ():
                code = code * _BASE + words[left, j - 1].astype(np.uint64) + np.uint64(1)
                number = self.numbers(code)
                rows = np.flatnonzero(number >= 0)
                if len(rows):
                    yield i, j, left[rows], number[rows]

    def likelihoods(self, words: list[bytes], counts: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """The log probability of each word, over all segmentations, in each class: a row for each word.

        With counts (a row for each word), expected[k, p] grows by the expected uses of piece p in class k.
        """
        classes = self.logp.shape[1]
        out = np.full((len(words), classes), NONE)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        for n in np.unique(size).tolist():
            of_n = np.flatnonzero(size == n)
            if n > ONE_BY_ONE:
                for i in of_n.tolist():
                    out[i] = self._one(b" " + words[i], None if counts is None else counts[i], expected)
                continue
            for cut in range(0, len(of_n), 1 << 13):
                now = of_n[cut : cut + (1 << 13)]
                grid = np.frombuffer(b"".join(b" " + words[i] for i in now.tolist()), np.uint8).reshape(-1, n)
                edges = list(self._edges(grid))
                forward = np.full((n + 1, len(now), classes), NONE)
                forward[0] = 0
                for i, j, rows, piece in edges:  # by start, so what reaches i is complete
                    forward[j, rows] = np.logaddexp(forward[j, rows], forward[i, rows] + self.logp[piece])
                out[now] = forward[n]
                if counts is None or expected is None:
                    continue
                backward = np.full((n + 1, len(now), classes), NONE)
                backward[n] = 0
                weight = counts[now]
                for i, j, rows, piece in reversed(edges):
                    through = self.logp[piece] + backward[j, rows]
                    backward[i, rows] = np.logaddexp(backward[i, rows], through)
                    share = np.exp(forward[i, rows] + through - forward[n, rows])
                    for k in range(len(expected)):  # the counts may have more classes than the pieces
                        used = share[:, min(k, classes - 1)] * weight[rows, k]
                        expected[k] += np.bincount(piece, used, len(expected[k]))
        return out

    def _reached(self, text: bytes, i: int) -> Iterator[tuple[int, int]]:
        """End and number of the pieces that start at i."""
        for j in range(i + 1, min(len(text), i + self.longest) + 1):
            if j == i + COMMON_PIECE + 1 and text[i : j - 1] not in self.heads:
                return
            if (piece := self.where.get(text[i:j])) is not None:
                yield j, piece

    def _one(self, text: bytes, counts: np.ndarray | None, expected: np.ndarray | None) -> np.ndarray:
        """The same for one long word. Without expectations, only as many columns are kept as a piece can span."""
        n, learn = len(text), counts is not None and expected is not None
        turn = n + 1 if learn else self.longest + 1
        forward = np.full((turn, self.logp.shape[1]), NONE)
        forward[0] = 0
        for i in range(n):
            here = forward[i % turn].copy()
            if not learn:
                forward[i % turn] = NONE  # from here on the column of i + turn
            for j, piece in self._reached(text, i):
                forward[j % turn] = np.logaddexp(forward[j % turn], here + self.logp[piece])
        if learn:
            backward = np.full_like(forward, NONE)
            backward[n] = 0
            for i in reversed(range(n)):
                for j, piece in self._reached(text, i):
                    through = self.logp[piece] + backward[j]
                    backward[i] = np.logaddexp(backward[i], through)
                    share = np.exp(forward[i] + through - forward[n])
                    for k in range(len(expected)):
                        expected[k, piece] += share[min(k, len(share) - 1)] * counts[k]
        return forward[n % turn]
