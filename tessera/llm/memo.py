"""Ids of pieces of text, each piece encoded once for as long as it stays in a bounded memo.

A block of texts is cut into pieces, and the pieces hashed, by array operations over its bytes; only pieces that are
new to the memo become strings. Two independent 64-bit hashes together are a piece's key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tessera.llm import common
from tessera.llm.hashes import of_runs

U = np.uint64
_FIRST = U(0xD6E8FEB86659FD93)


class PieceMemo:
    """Starts anew beyond max_pieces or max_bytes.

    cuts(body) marks where pieces begin, besides the starts of texts. encode_many(pieces, first) gives the flat ids of
    distinct pieces, and how many each has; with apart, a text's first piece is another piece than the same bytes later.
    """

    def __init__(self, cuts: Callable[[np.ndarray], np.ndarray], encode_many: Callable[[list[bytes], list[bool]], tuple[np.ndarray, np.ndarray]], apart: bool = False, max_pieces: int = 520_000, max_bytes: int = 24_000_000):
        self.cuts, self.encode_many, self.apart, self.max_pieces, self.max_bytes = cuts, encode_many, apart, max_pieces, max_bytes
        self._clear()

    def _clear(self) -> None:
        self.pieces, self.bytes, self.used = 0, 0, 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.at, self.n, self.check = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), np.zeros(1 << 14, U)
        self._table(16)

    def _table(self, bits: int) -> None:
        """An open hash table of keys, whose free slots hold 0, and of the pieces' numbers."""
        self.bits, self.keys, self.numbers = bits, np.zeros(1 << bits, U), np.zeros(1 << bits, np.int32)

    def _find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each piece's number or -1, and the slot where it is or could be."""
        slot = (key >> U(64 - self.bits)).astype(np.int64)
        open_ = np.arange(len(key))
        number = np.full(len(key), -1, np.int64)
        while len(open_):
            there, other = self.keys[slot[open_]], self.numbers[slot[open_]]
            hit = (there == key[open_]) & (self.check[other] == check[open_])
            number[open_[hit]] = other[hit]
            open_ = open_[~hit & (there != 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return number, slot

    def _insert(self, key: np.ndarray, check: np.ndarray, number: np.ndarray) -> None:
        """New pieces, each once; of those that want one slot, one gets it and the others look on."""
        while len(key):
            _, slot = self._find(key, check)
            self.numbers[slot] = number
            won = self.numbers[slot] == number
            self.keys[slot[won]] = key[won]
            key, check, number = key[~won], check[~won], number[~won]

    def _learn(self, pieces: list[bytes], first: list[bool], key: np.ndarray, check: np.ndarray) -> None:
        flat, n = self.encode_many(pieces, first)
        a, b = self.pieces, self.pieces + len(key)
        while len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.at) < b:
            self.at, self.n, self.check = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.n, self.check))
        self.flat[self.used : self.used + len(flat)] = flat
        self.n[a:b], self.check[a:b] = n, check
        self.at[a:b] = self.used + np.cumsum(n) - n
        self.used += len(flat)
        self.bytes += sum(map(len, pieces))
        self.pieces = b
        if 2 * b > len(self.keys):
            old, numbers, used = self.keys, self.numbers, self.keys != 0
            self._table(self.bits + 1)
            self._insert(old[used], self.check[numbers[used]], numbers[used])
        self._insert(key, check, np.arange(a, b))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        body, at = common.raw(texts)
        if not len(body):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        if self.pieces > self.max_pieces or self.bytes > self.max_bytes:
            self._clear()
        mask = self.cuts(body)
        opens = at[:-1][np.diff(at) > 0]
        mask[opens] = True
        start = np.flatnonzero(mask)
        end = np.append(start[1:], len(body))
        raw = body.tobytes()
        key, check = of_runs(raw, start, end - start, lanes=2)
        first = np.zeros(len(start), bool)
        if self.apart:
            first[np.searchsorted(start, opens)] = True
            key = np.where(first, key ^ _FIRST, key)
        key = np.maximum(key, U(1))
        k, _ = self._find(key, check)
        while len(new := np.flatnonzero(k < 0)):
            _, w = np.unique(key[new], return_index=True)
            w = new[w]
            self._learn([raw[a:b] for a, b in zip(start[w].tolist(), end[w].tolist(), strict=True)], first[w].tolist(), key[w], check[w])
            k[new], _ = self._find(key[new], check[new])
        n = self.n[k]
        to = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        flat = self.flat[np.repeat(self.at[k] - to[:-1], n) + np.arange(to[-1])]
        return flat, np.diff(to[np.searchsorted(start, at)])
