"""Words, shingles and their hashes over blocks of texts, as NumPy arrays.

A word is a run of bytes other than space and 09-0D (hex); A-Z count as a-z.
Words and shingles are known by 64-bit hashes: of n different ones, about
n * n / 2 ** 65 pairs share a hash.
"""

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BLOCK_BYTES = 1_000_000

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_KEYS = _rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15 | 2)
STEP_BACK = np.uint64(pow(int(STEP), -1, 2 ** 64))
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power(kind, base, n):
    """First n powers of an odd number modulo 2 ** 64, kept between blocks."""
    have = _powers[kind]
    if len(have) < n:
        grown = np.full(max(n, BLOCK_BYTES + BLOCK_BYTES // 4), base, dtype=np.uint64)
        grown[0] = 1
        have = _powers[kind] = np.multiply.accumulate(grown)
    return have[:n]


def mix(x):
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(texts, limit=BLOCK_BYTES):
    """Index ranges of a list of byte strings, each of about ``limit`` bytes."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def texts_of(column):
    """Byte strings of an Arrow string column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


def word_hashes(texts):
    """Hashes of all words of a block of texts, and where each text's begin.

    Returns (hashes, offsets) with ``len(texts) + 1`` offsets.
    """
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    gap = SPACES[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(data) and not gap[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_KEYS[data] * _power("up", STEP, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", STEP_BACK, len(data))[starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate(([0], np.cumsum(sizes)))
    return hashes, np.searchsorted(starts, begins)


def shingle_sets(texts, width):
    """Sorted distinct shingle hashes of each text.

    A text of fewer than ``width`` words has its whole sequence as its only
    shingle, one without words has none.
    """
    hashes, offsets = word_hashes(texts)
    times = np.uint64(0xA24BAED4963EE407)
    whole = hashes.copy()
    for k in range(1, width):
        whole = whole[:-1] * times + hashes[k:] if len(hashes) > k else whole[:0]
    whole = mix(whole)
    out = []
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        n = int(hi - lo)
        if n >= width:
            out.append(np.unique(whole[lo:hi - width + 1]))
        elif n:
            value = hashes[lo:lo + 1].copy()
            for k in range(1, n):
                value = value * times + hashes[lo + k]
            out.append(mix(value + np.uint64(n)))
        else:
            out.append(hashes[:0])
    return out


def common(a, b):
    """Number of values that two sorted arrays of distinct values share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


class CircularMinHash:
    """Signatures from two permutations of 32-bit positions.

    The first permutation places a shingle; coordinate k is the least value of
    the second one, shifted circularly by k, over the places of a set.
    """

    def __init__(self, coordinates, seed=1):
        self.coordinates = coordinates
        self.key = mix(np.array([seed], dtype=np.uint64))[0]

    def place(self, shingles):
        return (mix(shingles ^ self.key) >> np.uint64(32)).astype(np.uint32)

    def signatures(self, places, starts):
        """One row for each group of places; a group begins at each of ``starts``."""
        out = np.empty((len(starts), self.coordinates), dtype=np.uint32)
        if not len(starts):
            return out
        moved, other = np.empty_like(places), np.empty_like(places)
        for k in range(self.coordinates):
            np.subtract(places, np.uint32(k), out=moved)
            np.multiply(moved, np.uint32(0x7FEB352D), out=moved)
            np.right_shift(moved, np.uint32(15), out=other)
            np.bitwise_xor(moved, other, out=moved)
            np.multiply(moved, np.uint32(0x846CA68B), out=moved)
            out[:, k] = np.minimum.reduceat(moved, starts)
        return out
