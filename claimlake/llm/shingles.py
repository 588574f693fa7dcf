"""Words, five-word shingles and universal hash minima of whole texts, as numpy columns.

Letters A-Z are lower-cased; a word is a run of non-blank bytes. The set of a text is its
distinct shingles of five words; a shorter text has one shingle, all its words; a text without
words has none. Shingles are 64-bit hashes of their words.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np

from claimlake.llm.common import slices

SIZE = 5
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
CHUNK = 1 << 22


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    return np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(size).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(flat: np.ndarray) -> np.ndarray:
    """Running sums c, so that (c[e] - c[s]) times the inverse power of s hashes bytes s to e."""
    up, _ = powers(len(flat))
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_codes()[flat] * up[:len(flat)], out=sums[1:])
    return sums


#: Words up to this many bytes are hashed eight bytes at a time, all at once; longer ones one by one.
LANES = 4
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_hash(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes from each start to its end.

    Eight bytes at a time are mixed into the hash by a function without linear structure, so that
    no pattern of bytes makes different words collide; words beyond ``LANES`` steps take blake2b.
    """
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(flat) + 1,), np.dtype("<u8"), padded, strides=(1,))
    at = np.flatnonzero(sizes <= 8 * LANES)
    for lane in range(LANES):
        if lane:
            at = at[sizes[at] > 8 * lane]
        part = eight[starts[at] + 8 * lane] & _MASKS[np.minimum(sizes[at] - 8 * lane, 8)]
        out[at] = mix((out[at] ^ part) * _codes()[lane])
    for i in np.flatnonzero(sizes > 8 * LANES).tolist():
        digest = blake2b(np.ascontiguousarray(flat[starts[i]:ends[i]]), digest_size=8).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return out


def word_bounds(flat: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word; ``breaks`` are positions at which a new row begins."""
    solid = ~_BLANK[flat]
    before = np.zeros(len(flat) + 1, bool)
    before[1:] = solid
    before[breaks] = False
    starts = np.flatnonzero(solid & ~before[:-1])
    after = np.append(solid, False)
    after[breaks] = False
    ends = np.flatnonzero(solid & ~after[1:]) + 1
    return word_hash(_LOWER[flat], starts, ends), starts, ends


def pieces(flat: np.ndarray):
    """Cut one long text at blanks into pieces of bounded size; a longer word stays whole."""
    low = 0
    while low < len(flat):
        high = min(len(flat), low + CHUNK)
        while high < len(flat) and not _BLANK[flat[high - 1]]:
            blanks = np.flatnonzero(_BLANK[flat[high:high + CHUNK]])
            high = high + int(blanks[0]) + 1 if len(blanks) else min(len(flat), high + CHUNK)
        yield flat[low:high]
        low = high


def words(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, and where each row's words begin."""
    if len(flat) > CHUNK and len(offsets) == 2:
        parts = [word_bounds(p, np.zeros(0, np.int64))[0] for p in pieces(flat)]
        found = np.concatenate(parts)
        return found, np.array([0, len(found)])
    found, starts, _ = word_bounds(flat, offsets)
    return found, np.searchsorted(starts, offsets)


def shingles(found: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows in text order, repeats included, and where each row's begin."""
    odd = np.random.default_rng(7).integers(1, 1 << 63, SIZE, dtype=np.uint64) | np.uint64(1)
    counts = np.diff(begins)
    sizes = np.where(counts >= SIZE, counts - SIZE + 1, np.minimum(counts, 1))
    out_begins = np.concatenate([[0], np.cumsum(sizes)])
    row = np.repeat(np.arange(len(counts)), sizes)
    first = begins[row] + np.arange(out_begins[-1]) - out_begins[row]
    padded = np.append(found, np.zeros(SIZE, np.uint64))
    total = np.full(len(row), 0, np.uint64)
    short = counts[row] < SIZE
    for i in range(SIZE):
        part = padded[first + i] * odd[i]
        if short.any():
            part = np.where(counts[row] > i, part, np.uint64(i + 1))
        total += part
    return mix(total), out_begins


def row_shingles(flat: np.ndarray, offsets: np.ndarray):
    """Yield (low, high, hashes, begins) for ranges of rows of bounded bytes."""
    for low, high in slices(offsets):
        part = flat[offsets[low]:offsets[high]]
        yield low, high, *shingles(*words(part, offsets[low:high + 1] - offsets[low]))


def hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of ``count`` universal hashes x -> a x + b modulo 2^64."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def minima(hashes: np.ndarray, begins: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows by hashes: the least value of each hash over each (non-empty) range of shingles."""
    out = np.empty((len(begins) - 1, len(a)), np.uint64)
    work = np.empty(len(hashes), np.uint64)
    for j in range(len(a)):
        np.multiply(hashes, a[j], out=work)
        work += b[j]
        out[:, j] = np.minimum.reduceat(work, begins[:-1])
    return out
