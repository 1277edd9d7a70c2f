"""BLAKE3 digests of whole Arrow batches: the tree hash of chunks of 1,024 bytes, by array operations over all rows.

Every step works on all chunks (or pairs of nodes) of a batch's rows at once: the blocks of all chunks in turn, then the levels of
all trees. Neighbours are joined level by level and an odd one out goes up as it is, which makes the tree that the
published algorithm asks for.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

U = np.uint32
CHUNK, BLOCK = 1024, 64
#: Bytes of rows that are looked at together; a longer row is looked at by itself.
AT_ONCE = 1 << 22
# Fixed values of the published algorithm: initial words, the order of message words from round to round, and flags.
_FIRST = np.array([0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19], U)
_ORDER = (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)
_START, _END, _PARENT, _ROOT = 1, 2, 4, 8
#: Columns and diagonals of the four by four words of a state.
_MIXED = [(k, 4 + k, 8 + k, 12 + k) for k in range(4)] + [(k, 4 + (k + 1) % 4, 8 + (k + 2) % 4, 12 + (k + 3) % 4) for k in range(4)]


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x >> U(by) | x << U(32 - by)


def _compressed(value: np.ndarray, words: np.ndarray, counter: np.ndarray, length: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """The next chaining values of n nodes: value (8, n), words (16, n)."""
    counter = counter.astype(np.uint64)
    v = [*value, *(np.full(value.shape[1], x, U) for x in _FIRST[:4]), counter.astype(U), (counter >> np.uint64(32)).astype(U), length.astype(U), flags.astype(U)]
    order = list(range(16))
    for _ in range(7):
        for k, (a, b, c, d) in enumerate(_MIXED):
            for word, turns in ((order[2 * k], (16, 12)), (order[2 * k + 1], (8, 7))):
                v[a] = v[a] + v[b] + words[word]
                v[d] = _turned(v[d] ^ v[a], turns[0])
                v[c] = v[c] + v[d]
                v[b] = _turned(v[b] ^ v[c], turns[1])
        order = [order[k] for k in _ORDER]
    return np.stack([v[k] ^ v[8 + k] for k in range(8)])


def _leaves(body: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chaining values (8, chunks) of all rows' chunks, and how many each row has. A row of one chunk has its digest."""
    chunks = np.maximum(1, -(-sizes // CHUNK))
    row = np.repeat(np.arange(len(sizes)), chunks)
    number = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    length = np.minimum(CHUNK, sizes[row] - CHUNK * number)
    # all chunks side by side, filled with zeros
    table = np.zeros((len(row), CHUNK), np.uint8)
    start = (np.cumsum(sizes) - sizes)[row] + CHUNK * number
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    table[np.repeat(np.arange(len(row)), length), within] = body[np.repeat(start, length) + within]
    words = table.view("<u4").reshape(len(row), CHUNK // BLOCK, 16)
    blocks = np.maximum(1, -(-length // BLOCK))
    value = np.repeat(_FIRST[:, None], len(row), axis=1)
    for b in range(int(blocks.max(initial=0))):
        on = np.flatnonzero(blocks > b)
        last = blocks[on] == b + 1
        flags = _START * (b == 0) + last * (_END + _ROOT * (chunks[row[on]] == 1))
        value[:, on] = _compressed(value[:, on], words[on, b].T, number[on], np.where(last, length[on] - BLOCK * b, BLOCK), flags)
    return value, chunks


def digests(rows: list[bytes]) -> list[bytes]:
    """The 32-byte digest of each row."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    value, n = _leaves(np.frombuffer(b"".join(rows), np.uint8), sizes)
    while (n > 1).any():
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        left = np.flatnonzero((place % 2 == 0) & (place + 1 < n[row]))
        joined = _compressed(np.repeat(_FIRST[:, None], len(left), axis=1), np.concatenate([value[:, left], value[:, left + 1]]), np.zeros(len(left)), np.full(len(left), BLOCK), _PARENT + _ROOT * (n[row[left]] == 2))
        value[:, left] = joined
        value = value[:, place % 2 == 0]
        n = -(-n // 2)
    return [x.tobytes() for x in np.ascontiguousarray(value.T.astype("<u4"))]


@F.pandas_udf(T.StringType())
def blake3(contents: pd.Series) -> pd.Series:
    """The BLAKE3 digest of binary contents, in hexadecimal digits; null for null."""
    out: list = [None] * len(contents)
    some = [k for k, c in enumerate(contents) if c is not None]
    while some:
        n, size = 1, len(contents.iloc[some[0]])
        while n < len(some) and size + len(contents.iloc[some[n]]) <= AT_ONCE:
            size += len(contents.iloc[some[n]])
            n += 1
        for k, digest in zip(some[:n], digests([bytes(contents.iloc[k]) for k in some[:n]]), strict=True):
            out[k] = digest.hex()
        some = some[n:]
    return pd.Series(out, dtype=object)
