"""Word-shingle sets of whole texts, hashed in numpy a block of rows at a time.

Words are maximal runs outside space and \\t..\\r, with A-Z lower-cased. A word
hash is a polynomial over a random byte table modulo 2^64, read off one running
sum over the block's bytes; a shingle hash mixes the hashes of its words. Two
different shingles share a hash with probability about 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
BLOCK_BYTES = 1 << 19

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(40_961))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _block_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    n_rows, n = len(offsets) - 1, len(data)
    none = np.empty(0, dtype=np.int64)
    if n == 0:
        return [none] * n_rows
    inside = ~_BLANK[data]
    first = np.zeros(n + 1, dtype=bool)  # a row starts here
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    if len(s) == 0:
        return [none] * n_rows
    up, down = _power(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up, out=total[1:])
    words = _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    bounds = np.searchsorted(s, offsets)
    m = len(words) - width + 1
    grams = np.zeros(max(m, 0), dtype=np.uint64)
    for k in range(width):
        if m > 0:
            grams = grams * _BASE + words[k:k + m]
    grams = _mix(grams + _U(width)).view(np.int64)
    out = []
    for i in range(n_rows):
        a, b = int(bounds[i]), int(bounds[i + 1])
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:  # fewer words: the whole sequence is one shingle
            h = _U(0)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _BASE + w
                out.append(_mix(np.array([h + _U(b - a)], dtype=np.uint64)).view(np.int64))
        else:
            out.append(none)
    return out


def shingle_sets(column: pa.Array, width: int = WIDTH):
    """Yield the sorted distinct hashes (int64) of each text's shingles of
    ``width`` words; a null is an empty text."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type) or not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        # rows up to the block size, one long row at least
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1)
        end = min(end, len(column))
        yield from _block_sets(raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at], width)
        at = end


def signature(s: np.ndarray) -> np.ndarray:
    """Words of 64 bits: whether a bucket holds an odd number of the hashes ``s``. There
    are as many buckets, a power of two and at least 64, as hashes. Two sets differ
    in at least as many shingles as their signatures differ in buckets."""
    buckets = max(64, 1 << (len(s) - 1).bit_length())
    odd = np.bincount(s & (buckets - 1), minlength=buckets) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def int_lists(arrays: list[np.ndarray]) -> pa.Array:
    """list<int64> of numpy arrays without a Python object per value."""
    lengths = np.array([0] + [len(a) for a in arrays], dtype=np.int64)
    values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths).astype(np.int32), pa.int32()),
                                    pa.array(values, pa.int64()))
