"""Word shingles of Arrow text columns, hashed with numpy over the column's own buffer.

Words are maximal runs of anything but ASCII white space, A-Z lower-cased. Memory is bounded by
``CHUNK`` bytes of text at a time plus eight bytes per word of one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done, factor = 1, base
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(factor)
        done += more
        factor = factor * factor % (1 << 64)
    return out


class WordHasher:
    """Hashes of the words of UTF-8 text: a polynomial modulo 2**64 over a table of random
    values, taken from prefix sums, then mixed."""

    def __init__(self):
        letters = np.arange(256)
        self.space = (letters == 0x20) | ((letters >= 0x09) & (letters <= 0x0D))
        lower = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
        self.value = mix((lower.astype(np.uint64) + np.uint64(1)) * _ODD)
        self.up = self.down = np.empty(0, np.uint64)

    def words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words in ``data`` and the place of each word's first byte. Words also
        end at the (ascending) places in ``starts``."""
        n = len(data)
        if len(self.up) <= n:
            self.up, self.down = _powers(_BASE, n + 1), _powers(_BASE_INVERSE, n + 1)
        inside = ~self.space[data]
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[starts[starts < n]] = False
        first = np.flatnonzero(inside & ~before)
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        cuts = starts[(starts > 0) & (starts <= n)] - 1
        after[cuts] = False
        last = np.flatnonzero(inside & ~after) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[data] * self.up[:n], out=sums[1:])
        h = (sums[last] - sums[first]) * self.down[first]
        return mix(h ^ ((last - first).astype(np.uint64) * _ODD)), first


def documents(column: pa.Array, hasher: WordHasher) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, word hashes in order)`` for every row of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1
        end = min(max(end, row + 1), n)
        lo, hi = int(offsets[row]), int(offsets[end])
        if hi - lo > CHUNK:                                   # one long text
            yield row, _long(data[lo:hi], hasher)
        else:
            starts = offsets[row:end] - lo
            h, first = hasher.words(data[lo:hi], starts)
            edges = np.searchsorted(first, np.append(starts, hi - lo))
            for k in range(end - row):
                yield row + k, h[edges[k]:edges[k + 1]]
        row = end


def _long(data: np.ndarray, hasher: WordHasher) -> np.ndarray:
    """One text in chunks that end at white space (or at the end of a word longer than that)."""
    out, at, none = [], 0, np.zeros(1, np.int64)
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):
            spaces = np.flatnonzero(hasher.space[data[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                later = np.flatnonzero(hasher.space[data[end:]])
                end = end + int(later[0]) if len(later) else len(data)
        out.append(hasher.words(data[at:end], none)[0])
        at = end
    return np.concatenate(out)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; fewer words are one shingle."""
    return weighted_shingles(words, k, None)[0]


def weighted_shingles(words: np.ndarray, k: int, weight: np.ndarray | None):
    """:func:`shingle_set` and, with a weight per word, the least weight in every shingle."""
    n = len(words)
    if n == 0:
        return words, weight
    size = min(n, k)
    h = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        h = mix(h + words[i:n - size + 1 + i] * _ODD)
    least = None
    if weight is None:
        h.sort()
    else:
        least = weight[:n - size + 1]
        for i in range(1, size):
            least = np.minimum(least, weight[i:n - size + 1 + i])
        order = np.argsort(h)
        h, least = h[order], least[order]
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    return h[keep], None if least is None else least[keep]
