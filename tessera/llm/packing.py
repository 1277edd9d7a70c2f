"""Packing of documents into sequences of a fixed size: bounded-space online packing, one pass over each partition.

A partition keeps a fixed number of open windows. A document's whole windows are cut off; the rest goes to the open window
that it fits best. Where none fits and no more may be opened, the fullest is emitted, filled with the beginning of the rest
unless its free places are too few to be worth a cut. In the end the windows that partitions left open are merged, some
partitions at a time: best fit again, what stays half empty is joined and cut to full sequences, and the last ids of it
to sequences of a power of two, which need no padding.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common, token_binary
from tessera.llm.memo import PieceMemo


@dataclass(frozen=True)
class Packing:
    #: Ids of a sequence.
    size: int = 2048
    #: Open windows of a partition.
    windows: int = 32
    #: A window or sequence with fewer free places than this is padded rather than filled by a cut.
    least: int = 16
    #: Partitions whose open windows one task merges: at most shards * windows * size ids.
    shards: int = 16
    #: Ids of an Arrow batch that a packing task gives out.
    batch_ids: int = 1 << 19


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def _cuts(body: np.ndarray) -> np.ndarray:
    """Before a space or line end, unless one comes before, and between an ASCII letter and an ASCII sign: normalising and
    splitting never reach over them."""
    white = (body == 32) | (body == 10)
    out = white.copy()
    out[1:] &= ~white[:-1]
    out[1:] |= token_binary.between_letter_and_sign(body)
    return out


class WordEncoder:
    """Ids of whole texts by the tokenizers library, add_special_tokens=False, for vocabularies of words that drop white space.

    What lies between two cuts is encoded by itself, whatever stands around it, so equal stretches are given to the
    library once. A text that holds an added token's string goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if len(self.tokenizer.encode(" \n ", add_special_tokens=False).ids):
            raise ValueError("the vocabulary keeps white space")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        #: Ids that end a word.
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.memo = PieceMemo(_cuts, self._many, max_pieces=1_500_000)

    def _many(self, pieces: list[bytes], _: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of letters alone are one word each, so many go to the library as one text; its word ends tell them apart."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        upto = np.concatenate([[0], np.cumsum(size)])
        body = np.frombuffer(b"".join(pieces), np.uint8)
        letter = np.concatenate([[0], np.cumsum(token_binary.letters(body))])[upto]
        white = np.concatenate([[0], np.cumsum((body == 32) | (body == 10))])[upto]
        word = (np.diff(letter) > 0) & (np.diff(letter) + np.diff(white) == size)
        words, others = np.flatnonzero(word).tolist(), np.flatnonzero(~word).tolist()
        texts = [b" ".join([pieces[k] for k in words[a : a + 1000]]).decode() for a in range(0, len(words), 1000)] + [pieces[k].decode() for k in others]
        ids = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        many, single = np.concatenate([np.zeros(0, np.int32), *ids[: len(ids) - len(others)]]), ids[len(ids) - len(others) :]
        end = np.flatnonzero(self.ends[many]) + 1
        if len(end) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        n = np.zeros(len(pieces), np.int64)
        n[words], n[others] = np.diff(end, prepend=0), [len(x) for x in single]
        out = np.empty(int(n.sum()), np.int32)
        begin = np.cumsum(n) - n
        out[np.repeat(begin[words] - (end - n[words]), n[words]) + np.arange(len(many))] = many
        for k, x in zip(others, single, strict=True):
            out[begin[k] : begin[k] + len(x)] = x
        return out, n

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        flat, n = self.memo.encode(texts)
        out = np.split(flat, np.cumsum(n)[:-1])
        body = common.raw(texts)[0].tobytes()
        if any(a.encode() in body for a in self.added):
            for k, text in enumerate(texts.to_pylist()):
                if any(a in text for a in self.added):
                    out[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        return out


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    """One for each Python worker, so that its memo outlives a task."""
    return WordEncoder(path)


@dataclass
class Piece:
    doc_id: int | None
    start: int
    doc_tokens: int
    ids: np.ndarray

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.start, self.doc_tokens, self.ids[:at]), Piece(self.doc_id, self.start + at, self.doc_tokens, self.ids[at:])


@dataclass
class Windows:
    """The open windows of a partition. Each full or emitted one goes to emit, as its pieces."""

    p: Packing
    emit: Callable[[list[Piece]], None]
    free: list[tuple[int, int]] = field(default_factory=list)  # free places and number of each open window, in order
    held: dict[int, list[Piece]] = field(default_factory=dict)
    made: int = 0

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.p.size:
            whole, piece = piece.cut(self.p.size)
            self.emit([whole])
        while n := len(piece.ids):
            k = bisect_left(self.free, (n, -1))
            if k < len(self.free):
                left, w = self.free.pop(k)
                self._put(w, left, piece)
                return
            if len(self.free) < self.p.windows:
                self.made += 1
                self.held[self.made] = []
                self._put(self.made, self.p.size, piece)
                return
            left, w = self.free.pop(0)
            if left >= self.p.least:
                head, piece = piece.cut(left)
                self.held[w].append(head)
            self.emit(self.held.pop(w))

    def _put(self, w: int, left: int, piece: Piece) -> None:
        self.held[w].append(piece)
        if left > len(piece.ids):
            insort(self.free, (left - len(piece.ids), w))
        else:
            self.emit(self.held.pop(w))


def merged(windows: list[list[Piece]], p: Packing) -> list[list[Piece]]:
    """Sequences of the pieces of windows that were left open: best fit, fullest first, and cuts of what stays half empty."""
    size = [sum(len(x.ids) for x in w) for w in windows]
    free: list[tuple[int, int]] = []
    bins: list[list[Piece]] = []
    for k in sorted(range(len(windows)), key=lambda k: (-size[k], k)):
        at = bisect_left(free, (size[k], -1))
        if at < len(free):
            left, b = free.pop(at)
        else:
            left, b = p.size, len(bins)
            bins.append([])
        bins[b] += windows[k]
        insort(free, (left - size[k], b))
    out = [bins[b] for left, b in free if left < p.least]
    rest = [x for left, b in free if left >= p.least for x in bins[b]]
    total = sum(len(x.ids) for x in rest)
    while total:
        take = p.size if total >= p.size else total if p.size - total < p.least else 1 << (total.bit_length() - 1)
        total -= take
        sequence: list[Piece] = []
        while take:
            head, tail = rest[0].cut(take)
            sequence.append(head)
            take -= len(head.ids)
            rest[:1] = [tail] if len(tail.ids) else []
        out.append(sequence)
    return out


def _batch(sequences: list[tuple[int, list[Piece]]], extra: list | None = None) -> pa.RecordBatch:
    """The pieces of numbered sequences as rows; extra: whether each sequence is still open."""
    rows = [(number, at, x, is_open) for (number, pieces), is_open in zip(sequences, extra or [False] * len(sequences), strict=True) for at, x in zip(np.cumsum([0, *(len(x.ids) for x in pieces)]).tolist(), pieces, strict=False)]
    ends = np.cumsum([0, *(len(x.ids) for _, _, x, _ in rows)]).astype(np.int32)
    flat = np.concatenate([x.ids for _, _, x, _ in rows]) if rows else np.zeros(0, np.int32)
    columns = {
        "doc_id": pa.array([x.doc_id for _, _, x, _ in rows], pa.int64()),
        "start": pa.array([x.start for _, _, x, _ in rows], pa.int64()),
        "length": pa.array(np.diff(ends).astype(np.int64)),
        "ids_crc32": pa.array([zlib.crc32(np.ascontiguousarray(x.ids, "<u4")) for _, _, x, _ in rows], pa.int64()),
        "doc_tokens": pa.array([x.doc_tokens for _, _, x, _ in rows], pa.int64()),
        "sequence_id": pa.array([number for number, _, _, _ in rows], pa.int64()),
        "offset": pa.array([at for _, at, _, _ in rows], pa.int64()),
        "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))),
    }
    if extra is not None:
        columns["open"] = pa.array([x for _, _, _, x in rows], pa.bool_())
    return pa.RecordBatch.from_pydict(columns)


#: Sequences are numbered by partition: its number comes before these bits. Merged ones are numbered from _MERGED on.
_LOCAL, _MERGED = 32, 1 << 60


def _pack(path: str, end: int, p: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = encoder(path).encode, TaskContext.get().partitionId() << _LOCAL
        full: list[list[Piece]] = []
        windows = Windows(p, full.append)
        made = held = 0

        def numbered() -> list[tuple[int, list[Piece]]]:
            nonlocal made
            out = list(enumerate(full, first + made))
            made += len(full)
            full.clear()
            return out

        for batch in batches:
            texts = common.whole(batch.column(1))
            for a, b in common.blocks(texts):
                for doc_id, ids in zip(batch.column(0).slice(a, b - a).to_pylist(), encode(texts.slice(a, b - a)), strict=True):
                    ids = np.append(ids, np.int32(end))
                    windows.add(Piece(doc_id, 0, len(ids), ids))
                    held += len(ids)
                    if held >= p.batch_ids:
                        out, held = numbered(), 0
                        yield _batch(out, [False] * len(out))
        closed = numbered()
        opened = list(enumerate(windows.held.values(), first + made))
        yield _batch(closed + opened, [False] * len(closed) + [True] * len(opened))

    return run


def _merge(p: Packing):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        ids, windows, last = rows.column("ids").combine_chunks(), [], None
        at, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
        for k, (doc_id, start, n, window) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "sequence_id")), strict=True)):
            if window != last:
                windows.append([])
                last = window
            windows[-1].append(Piece(doc_id, start, n, flat[at[k] : at[k + 1]]))
        return pa.Table.from_batches([_batch(list(enumerate(merged(windows, p), _MERGED + (key[0].as_py() << _LOCAL))))])

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, p: Packing = Packing()) -> DataFrame:
    """The pieces of all docs(doc_id, text), each with its ids, its place in its document and in its sequence, and a checksum.

    A document is its text's ids, then the end id; a null or empty text is the end id alone. Each id is in one piece, and the
    pieces of a sequence follow one another from offset 0. A sequence is p.size ids at most; at least p.size - p.least + 1,
    unless it is of a power of two. Rows that repeat a doc_id, or have none, are documents of their own. An empty table
    gives an empty one. Other columns of docs are not read. No document is shuffled but for the windows left open.
    """
    rows = common.materialise(common.slim(docs, "doc_id", "text").mapInArrow(_pack(tokenizer_path, end_id, p), PIECES + ", open boolean"), "pieces")
    left = rows.where("open").withColumn("of", F.shiftright("sequence_id", _LOCAL).cast("long")).withColumn("of", F.floor(F.col("of") / p.shards))
    return rows.where("not open").drop("open").unionByName(left.drop("open").groupBy("of").applyInArrow(_merge(p), PIECES))
