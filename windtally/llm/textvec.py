"""Hashed word features of whole texts, vectorised over batches of bytes."""

from __future__ import annotations

import numpy as np

#: Hash buckets of word features.
BUCKETS = 2048
#: Bytes handled at a time; a longer text is taken in pieces that end between words.
PIECE = 1 << 20
STATS = ("words", "bytes", "letters", "digits", "marks", "lines", "again", "upper")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.full(256, 3, np.uint8)  # 0 blank, 1 letter, 2 digit, 3 mark
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58] = 2
_KIND[97:123] = 1
_KIND[128:] = 1
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Profile:
    """Adds up, per text of a batch: STATS, which word buckets occur and, if
    ``run`` is given, the distinct words of every ``run`` consecutive ones."""

    def __init__(self, n: int, buckets: int = BUCKETS, run: int = 0):
        self.run, self.distinct = run, np.zeros(n)
        self.stats = np.zeros((n, len(STATS)))
        self.seen = np.zeros((n, buckets), bool)
        self.shift = np.uint64(64 - (buckets - 1).bit_length())
        self.up, self.down = _powers(_PRIME, 2 * PIECE + 2), _powers(_INVERSE, 2 * PIECE + 2)

    def _reach(self, n: int) -> None:
        """Powers for ``n`` bytes: a word longer than a piece is not cut."""
        if n > len(self.up):
            self.up, self.down = _powers(_PRIME, n), _powers(_INVERSE, n)

    def add(self, pieces: list[bytes], owner: list[int]) -> None:
        raw = np.frombuffer(b"\n".join(pieces) + b"\n", np.uint8)
        self._reach(len(raw) + 1)
        low = _LOWER[raw]
        kind = _KIND[low]
        ends = np.cumsum([len(p) + 1 for p in pieces])
        begins = np.concatenate([[0], ends[:-1]])
        own = np.asarray(owner)
        count = lambda mask: np.add.reduceat(mask, begins, dtype=np.int64)
        in_word = (kind == 1) | (kind == 2)
        edge = np.diff(np.concatenate([[False], in_word]).astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # hash of a word: difference of prefix polynomials, brought back to exponent zero
        prefix = np.concatenate([[np.uint64(0)], np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.up[: len(low)], dtype=np.uint64)])
        h = (prefix[stop] - prefix[start]) * self.down[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        piece = np.searchsorted(begins, start, "right") - 1
        self.seen[own[piece], (h >> self.shift).astype(np.int64)] = True
        again = np.concatenate([[False], (h[1:] == h[:-1]) & (piece[1:] == piece[:-1])]) if len(h) else np.zeros(0, bool)
        n = len(pieces)
        columns = [np.bincount(piece, minlength=n), ends - begins - 1, count(kind == 1), count(kind == 2), count(kind == 3),
                   count(raw == 10) - 1, np.bincount(piece, again, minlength=n), count((raw >= 65) & (raw <= 90))]
        np.add.at(self.stats, own, np.stack(columns, axis=1).astype(float))
        if self.run and len(h):
            opens = (np.arange(len(h)) - np.searchsorted(start, begins)[piece]) % self.run == 0
            # runs by number (fewer than 2**22 in a call) above 42 bits of hash: sorted, equal words of a run stand together
            key = np.sort(np.cumsum(opens).astype(np.uint64) << np.uint64(42) | h >> np.uint64(22))
            new = np.concatenate([[True], key[1:] != key[:-1]])
            home = piece[opens][(key[new] >> np.uint64(42)).astype(np.int64) - 1]
            np.add.at(self.distinct, own, np.bincount(home, minlength=n).astype(float))


def cuts(data: bytes) -> list[int]:
    """Ends of the pieces of a text: each after the last byte that is in no word
    within PIECE bytes, or else after the next such byte, so that no word is cut."""
    out, lo = [], 0
    while len(data) - lo > PIECE:
        gap = np.flatnonzero(_KIND[_LOWER[np.frombuffer(data, np.uint8, PIECE, lo)]] % 3 == 0)
        if len(gap):
            lo += int(gap[-1]) + 1
        else:
            for at in range(lo + PIECE, len(data), PIECE):
                gap = np.flatnonzero(_KIND[_LOWER[np.frombuffer(data, np.uint8, min(PIECE, len(data) - at), at)]] % 3 == 0)
                if len(gap):
                    lo = at + int(gap[0]) + 1
                    break
            else:
                break
        out.append(lo)
    return out if out and out[-1] == len(data) else [*out, len(data)]


def profile(texts: list[str | None], buckets: int = BUCKETS, run: int = 0) -> Profile:
    """Stats and buckets of whole texts; null counts as empty.  A text longer
    than PIECE is taken in pieces that cut no word; runs begin anew in each."""
    out = Profile(len(texts), buckets, run)
    pieces, owner, size = [], [], 0
    for i, t in enumerate(texts):
        data = (t or "").encode("utf-8", "replace")
        ends = cuts(data)
        for lo, hi in zip([0, *ends], ends):
            if size > PIECE // 2:
                out.add(pieces, owner)
                pieces, owner, size = [], [], 0
            pieces.append(data[lo:hi])
            owner.append(i)
            size += len(pieces[-1]) + 1
    if pieces:
        out.add(pieces, owner)
    return out


def shares(stats: np.ndarray) -> np.ndarray:
    """Dense features from STATS, each about 0 to 1."""
    words, size = np.maximum(stats[:, 0], 1), np.maximum(stats[:, 1], 1)
    return np.stack([np.ones(len(stats)), np.log1p(stats[:, 0]) / 10, np.minimum(size / words / 20, 2), *(stats[:, k] / size for k in (2, 3, 4, 5, 7)),
                     stats[:, 6] / words], axis=1)


def design(p_stats: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Feature matrix (float32): buckets that occur, scaled to unit length, then the shares."""
    x = seen.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    return np.concatenate([x, shares(p_stats).astype(np.float32)], axis=1)


def scores(p: Profile, weights: np.ndarray, rows: int = 512) -> np.ndarray:
    return np.concatenate([np.zeros((0, weights.shape[1]), np.float32),
                           *(design(p.stats[i:i + rows], p.seen[i:i + rows]) @ weights for i in range(0, len(p.stats), rows))])


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 4.0, ridge: float = 1e-4) -> np.ndarray:
    """Weights (features, classes) of a softmax regression on soft labels ``y``,
    by gradient descent with Nesterov momentum."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    last = w.copy()
    for k in range(steps if len(x) else 0):
        ahead = w + (k / (k + 3)) * (w - last)
        g = x.T @ (softmax(x @ ahead) - y).astype(np.float32) / len(x) + ridge * ahead
        last, w = w, (ahead - rate * g).astype(np.float32)
    return w
