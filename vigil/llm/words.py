"""Words and shingles of many texts at once, as 64-bit hashes in NumPy arrays.

An Arrow column of texts is one byte buffer with offsets.  A word's hash is a polynomial of its
bytes modulo 2**64, read off one running sum over the buffer, then mixed.  The buffer is walked
in windows of 128 KB, so scratch memory does not grow with a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 17
SLICE_BYTES = 4 << 20
BASE = 0x9E6C63D0676A9A99
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
SPACES = b" \t\n\v\f\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers() -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        steps = np.full(WINDOW + 1, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)
    return run(BASE), run(pow(BASE, -1, 1 << 64))


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``most`` bytes of text."""
    col = col.fill_null(b"") if col.null_count else col
    wide = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    offsets = np.frombuffer(col.buffers()[1], wide)[col.offset:col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def _window(b: np.ndarray, doc_start: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Polynomial, start and end of each word in at most WINDOW lower-cased bytes."""
    power, inverse = powers
    space = IS_SPACE[b]
    edge = np.ones(len(b) + 1, bool)
    edge[1:-1] = space[:-1] | space[1:] | doc_start[1:]
    edge = np.flatnonzero(edge)
    starts, ends = edge[:-1], edge[1:]
    word = ~space[starts]
    starts, ends = starts[word], ends[word]
    total = np.zeros(len(b) + 1, np.uint64)
    v = b.astype(np.uint64)
    v += np.uint64(1)
    v *= power[:len(b)]
    np.cumsum(v, out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts], starts, ends


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of the texts in turn, and where each text's words begin
    (one more entry than texts).  The hash is that of the lower-cased word unless ``lower`` is false."""
    n, powers = len(data), _powers()
    fold = LOWER if lower else np.arange(256, dtype=np.uint8)
    is_start = np.zeros(n + 1, bool)
    is_start[offsets] = True
    polys, starts, ends = [], [], []
    lo = 0
    while lo < n:
        hi = min(lo + WINDOW, n)
        if hi < n:
            cut = np.flatnonzero(IS_SPACE[data[lo:hi]] | is_start[lo + 1:hi + 1])
            if not len(cut):  # one word fills the window: its polynomial is summed window by window
                poly, at, done = 0, lo, False
                while not done:
                    part = fold[data[at:at + WINDOW]]
                    stop = np.flatnonzero(IS_SPACE[part] | (is_start[at:at + len(part)] & (np.arange(len(part)) + at > lo)))
                    done = len(stop) > 0 or at + len(part) >= n
                    part = part[:stop[0]] if len(stop) else part
                    if len(part):
                        p = _window(part, np.zeros(len(part), bool), powers)[0]
                        poly = (poly + int(p[0]) * pow(BASE, at - lo, 1 << 64)) % (1 << 64)
                    at += len(part)
                polys.append(np.array([poly], np.uint64))
                starts.append(np.array([lo]))
                ends.append(np.array([at]))
                lo = at
                continue
            hi = lo + int(cut[-1]) + 1
        p, s, e = _window(fold[data[lo:hi]], is_start[lo:hi], powers)
        polys.append(p)
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    if not polys:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    starts = np.concatenate(starts)
    return mix(np.concatenate(polys)), starts, np.concatenate(ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each text, in order, and where each text's begin.
    A text of 1 to k-1 words has its whole sequence as its one shingle."""
    factor = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    size = np.diff(bounds)
    count = np.where(size >= k, size - k + 1, (size > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(out_bounds[-1]), np.uint64)
    if (size >= k).any():
        run = np.zeros(len(hashes) - k + 1, np.uint64)
        for j in range(k):
            run += hashes[j:len(hashes) - k + 1 + j] * factor[j]
        long = size >= k
        first = np.repeat(bounds[:-1][long] - out_bounds[:-1][long], count[long])
        at = np.flatnonzero(np.repeat(long, count))
        out[at] = run[at + first]
    for n in range(1, k):
        which = np.flatnonzero(size == n)
        if len(which):
            v = np.full(len(which), n, np.uint64) * np.uint64(BASE)
            for j in range(n):
                v += hashes[bounds[which] + j] * factor[j]
            out[out_bounds[which]] = v
    return mix(out), out_bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values, sorted, and where each text's begin."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[bounds[:-1][bounds[:-1] < len(values)]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """The values between bounds as a list column of longs."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))
