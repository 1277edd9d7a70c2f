"""Word shingles of whole texts as sets of 64-bit hashes, and HyperMinHash sketches of such sets."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from tessera.llm import common
from tessera.llm.hashes import mixed, of_runs

U = np.uint64
_LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_PLACE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 16, dtype=U)
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of a block of texts, and the n + 1 offsets of the texts in them."""
    body, at = common.raw(texts)
    inside = _WORD[body]
    if not len(body) or not inside.any():
        return np.zeros(0, U), np.zeros(len(texts) + 1, np.int64)
    edge = np.ones(len(body) + 1, bool)
    edge[1:-1] = False
    edge[at] = True  # no word goes on from one text to the next
    first = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    last = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]])))
    return of_runs(body.tobytes().translate(_LOW), first, last + 1 - first)[0], np.searchsorted(first, at)


def _together(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each width words in a row; every word passes through all mixing after it."""
    n = len(words) - width + 1
    out = np.full(n, _PLACE[width], U)
    for k in range(width):
        out = mixed((out ^ words[k : k + n]) * (_PLACE[k] | U(1)) + _PLACE[k])
    return out


def sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; of fewer words than width, the whole sequence; of none, nothing."""
    words, at = word_hashes(texts)
    long = _together(words, width) if len(words) >= width else words[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(long[a : b - width + 1]))
        elif b > a:
            out.append(_together(words[a:b], b - a))
        else:
            out.append(np.zeros(0, U))
    return out


# HyperMinHash registers: 6 bits of leading-zero count, then the mantissa bits after the leading one.
MANTISSA = 10


@lru_cache(4)
def _family(buckets: int) -> tuple[np.ndarray, np.ndarray]:
    g = np.random.Generator(np.random.PCG64(buckets))
    return g.integers(1, 2**63, buckets, dtype=U) << U(1) | U(1), g.integers(0, 2**63, buckets, dtype=U)


def registers(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """One 16-bit register for each bucket: the leading zeros of the bucket's least hash value and its mantissa.

    Each bucket has a hash function of its own and sees all shingles, so none is empty for a text of few words.
    """
    mul, add = _family(buckets)
    least = np.full(buckets, ~U(0), U)
    for a in range(0, len(shingles), 512):
        part = shingles[a : a + 512]
        np.minimum(least, (part[:, None] * mul + add).min(0), out=least)
    _, exponent = np.frexp(least.astype(np.float64))  # may round up to the next power of two: both texts alike
    zeros = np.clip(64 - exponent, 0, 53)
    rest = (least << zeros.astype(U)) >> U(63 - MANTISSA) & U((1 << MANTISSA) - 1)
    return (zeros.astype(np.uint16) << MANTISSA | rest.astype(np.uint16)).astype("<u2")


@lru_cache(65536)
def chance(n: int, m: int) -> float:
    """Probability that a bucket's registers of two disjoint sets of n and m shingles are equal.

    A register says in which cell the least of n uniform values lies; cells of leading-zero count i have the width
    2 ** -(i + 1 + MANTISSA).
    """
    i = np.arange(54)[:, None]
    j = np.arange(1 << MANTISSA)[None, :]
    low = np.ldexp(1.0 + j / (1 << MANTISSA), -(i + 1))
    high = np.ldexp(1.0 + (j + 1) / (1 << MANTISSA), -(i + 1))

    def mass(k: int) -> np.ndarray:
        return np.exp(k * np.log1p(-low)) - np.exp(k * np.log1p(-np.minimum(high, 1 - 1e-16)))

    return float((mass(n) * mass(m)).sum())


def corrected(equal: np.ndarray, buckets: int, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates from numbers of equal registers, less what chance makes equal (on a grid of sizes)."""
    grid = lambda x: np.maximum(1, np.power(2.0, np.round(np.log2(np.maximum(x, 1)) * 2) / 2)).astype(np.int64)
    by_chance = np.array([chance(a, b) for a, b in zip(grid(n).tolist(), grid(m).tolist(), strict=True)])
    share = equal / buckets
    return (share - by_chance) / (1 - by_chance)
