"""Words of whole texts as NumPy arrays, read straight from Arrow buffers.

Every separator used here is ASCII, so words can be cut on UTF-8 bytes. A word
is hashed by a polynomial over random byte weights modulo 2**64, computed with
one running sum per block of bytes. Blocks are cut at separators, so the work
memory does not grow with the length of a text; only the word arrays (24 bytes
a word) of the texts at hand are held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 16
SLICE_BYTES = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _weights() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


WEIGHTS = _weights()
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)  # everything but 0-9, a-z and bytes of other scripts; A-Z are lowered before
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for blocks of up to n bytes."""
    if not _CACHE or next(iter(_CACHE)) < n:
        _CACHE.clear()
        _CACHE[n] = (_powers(n, _BASE), _powers(n, _INVERSE))
    return next(iter(_CACHE.values()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most that many bytes of text (or one row, if it is longer)."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word; positions are bytes in ``data``. A word never crosses a text's end."""
    hashes, starts, ends = [], [], []
    at, n = 0, len(data)
    edges = offsets[1:-1]
    while at < n:
        stop = min(n, at + BLOCK)
        part = LOWER[data[at:stop]] if lower else data[at:stop]
        gap = separator[part]
        if stop < n:
            inner = np.flatnonzero(gap)
            edge = int(np.searchsorted(edges, stop, "right")) - 1
            last = edges[edge] if edge >= 0 and edges[edge] > at else at
            cut = max(int(inner[-1]) + 1 + at if len(inner) else at, int(last))
            while cut <= at:  # one word longer than a block
                stop = min(n, stop + BLOCK)
                part = LOWER[data[at:stop]] if lower else data[at:stop]
                gap = separator[part]
                inner = np.flatnonzero(gap)
                edge = int(np.searchsorted(edges, stop, "right")) - 1
                last = edges[edge] if edge >= 0 and edges[edge] > at else at
                cut = n if stop == n and not len(inner) and last <= at else max(int(inner[-1]) + 1 + at if len(inner) else at, int(last))
            part, gap, stop = part[: cut - at], gap[: cut - at], cut
        inside = ~gap
        first = inside.copy()
        first[1:] &= gap[:-1]
        low, high = np.searchsorted(edges, [at, stop])
        here = edges[low:high] - at
        here = here[here < len(part)]
        first[here] |= inside[here]
        begin = np.flatnonzero(first)
        if len(begin):
            # A word ends before the next separator, the next first letter or the end.
            breaks = np.flatnonzero(gap | first)
            end = np.append(breaks, len(part))[np.flatnonzero(first[breaks]) + 1]
            powers, inverse = _tables(max(BLOCK, len(part)))
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(WEIGHTS[part] * powers[: len(part)], out=total[1:])
            hashes.append(mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _ODD))
            starts.append(begin + at)
            ends.append(end + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def word_bounds(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each text's words begin in the word arrays; one entry more than texts."""
    return np.searchsorted(starts, offsets)


_STEPS = [np.uint64(pow(0xD1342543DE82EF95, i + 1, 1 << 64)) for i in range(64)]


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that begin at each word; the last ``size - 1`` reach past the end and mean nothing."""
    out = np.zeros(len(hashes), np.uint64)
    for i in range(size):
        step = _STEPS[i] if i < 64 else np.uint64(pow(0xD1342543DE82EF95, i + 1, 1 << 64))
        out[: len(hashes) - i] += hashes[i:] * step
    return mix(out)


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct shingle hashes; a shorter text has its whole word sequence as one shingle."""
    rolled = shingles(hashes, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            short = b - a
            for h in hashes[a:b].tolist():
                short = (short * int(_STEPS[0]) + h) % (1 << 64)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
