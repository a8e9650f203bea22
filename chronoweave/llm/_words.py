"""Words of many texts at once, as NumPy arrays over their UTF-8 bytes.

A word is a run of bytes other than ASCII white space; A-Z count as a-z. Its hash is a polynomial in its bytes modulo
2**64, taken from one running sum over the whole buffer, then mixed.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
#: Bytes as they are.
PLAIN = np.arange(1, 257, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers[0][:n], _powers[1][:n]


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray = _LOWER) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each run; ``value`` is what each byte counts as, A-Z as a-z unless given."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, start, end) of each word, in order."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # a word ends with its text even where no white space stands between two texts
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def shingles(doc: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every run of ``width`` words; a text with fewer words gives one shingle of them all."""
    n = len(hashes)
    q = np.uint64(0xD6E8FEB86659FD93)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    s = np.zeros(n, np.uint64)
    length = np.zeros(n, np.int64)
    for k in range(width):
        m = max(0, n - k)
        same = doc[k:] == doc[:m]
        s[:m] = np.where(same, s[:m] * q + hashes[k:], s[:m])
        length[:m] += same
    new = np.ones(n, bool)
    new[1:] = doc[1:] != doc[:-1]
    keep = (length == width) | new
    # a short text's shingle must not equal a prefix of a longer one
    return doc[keep], mix(s[keep] + length[keep].astype(np.uint64))


#: Bits of a value that a multiset keeps: the upper 53, which leave room for 2,048 texts beside them in one sorted word.
VALUE_BITS = 53


def counted(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multiset of each of at most 2,048 texts: (text index, upper bits of the value, how often), sorted."""
    if not len(values):
        return doc, values, np.zeros(0, np.int64)
    if doc[-1] >> (64 - VALUE_BITS):
        raise ValueError("too many texts at once")
    key = np.sort((doc.astype(np.uint64) << np.uint64(VALUE_BITS)) | (values >> np.uint64(64 - VALUE_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at]
    return (key >> np.uint64(VALUE_BITS)).astype(np.int64), key & np.uint64((1 << VALUE_BITS) - 1), np.diff(np.append(at, len(values)))
