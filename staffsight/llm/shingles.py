"""Word-shingle sets of whole texts as 64-bit fingerprints, computed on Arrow buffers.

Words are runs of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a set holds the distinct
shingles of ``k`` words, or the whole word sequence as one where there are fewer. Two
shingles are told apart by 64-bit fingerprints (polynomial word hashes, mixed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import ship

ship(__name__)

#: Texts are hashed in pieces of about this many bytes (a longer text on its own).
CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd multipliers."""
    return mix64(np.arange(1, n + 1, dtype=_U) * _U(_BASE) + _U(seed)) | _U(1)


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            steps = np.full(size, _BASE, _U)
            back = np.full(size, pow(_BASE, -1, 1 << 64), _U)
            steps[0] = back[0] = 1
            self.up, self.down = np.multiply.accumulate(steps), np.multiply.accumulate(back)
        return self.up, self.down


_POWERS = _Powers()


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of the texts laid end to end in ``data``."""
    n = len(data)
    solid = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[starts[starts < n]] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:n]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _POWERS.get(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum((_LOWER[data].astype(_U) + _U(1)) * up[:n], out=total[1:])
    hashes = mix64((total[b] - total[a]) * down[a] + (b - a).astype(_U) * _U(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, a, side="right") - 1


def _piece_sets(data: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle fingerprints (repeats included) and where each text's begin (length + 1)."""
    words, owner = _word_hashes(data, starts)
    texts = len(starts)
    count = np.bincount(owner, minlength=texts)
    begin = np.concatenate(([0], np.cumsum(count)))
    mult, size_mark = constants(k, 1), constants(k, 2)
    n_sh = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out_begin = np.concatenate(([0], np.cumsum(n_sh)))
    # the word index at which each shingle starts
    which = np.repeat(np.arange(texts), n_sh)
    at = np.arange(out_begin[-1]) - out_begin[which] + begin[which]
    length = np.minimum(count[which], k)
    acc = size_mark[length - 1].copy() if len(which) else np.zeros(0, _U)
    padded = np.concatenate((words, np.zeros(k, _U)))
    for j in range(k):
        part = padded[at + j] * mult[j]
        acc += part if j == 0 else np.where(length > j, part, _U(0))
    return mix64(acc), out_begin


def shingle_lists(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For consecutive pieces of ``texts``: first text's number, fingerprints, begins.

    Null texts count as empty.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        fp, begin = _piece_sets(data[offsets[i]:offsets[j]], offsets[i:j] - offsets[i], k)
        yield i, fp, begin
        i = j


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct fingerprints of each text."""
    out = []
    for _, fp, begin in shingle_lists(texts, k):
        out += [np.unique(fp[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    return out
