"""SentencePiece encoding by vectorised merge rounds over flat numpy symbol arrays, and decoding.

All words of a batch lie in one symbol array. A round finds the least pair rank of each word (a segmented minimum),
merges all its leftmost non-overlapping occurrences at once, and closes the gaps; words without a pair that can
merge leave the array. A merge that could make a pair of a better or equal rank (so that the order within the word
matters) is done at the leftmost place alone. Rounds over an unbroken stretch cost its length times their number, so
stretches of over LONG symbols are merged from a queue of their pairs instead, in time n log n, as are those that come
down to pairs of the last rank, which several pieces share.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm import common
from tessera.llm.memo import PieceMemo

SPACE = "▁"
NONE = np.int32(2**31 - 1)
LONG = 512


class PieceModel:
    """The merge table of a SentencePiece BPE model with byte fallback and an identity normaliser."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix or not model.trainer_spec.byte_fallback or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("only BPE models with byte fallback, an identity normaliser and plain pieces are supported")
        self.dummy = norm.add_dummy_prefix
        self.bos, self.eos = self.library.bos_id(), self.library.eos_id()
        self.size = len(model.pieces)
        self.bytes = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        plain = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in plain):
            raise ValueError("a piece goes on after a space")
        order = sorted({-model.pieces[i].score for i in plain.values()})
        place = {s: r for r, s in enumerate(order)}
        self.rank = np.full(self.size, NONE, np.int32)
        for i in plain.values():
            self.rank[i] = place[-model.pieces[i].score]
        counts = np.bincount(self.rank[list(plain.values())], minlength=len(order))
        #: Ranks that several pieces share: all of them must come after every other rank.
        self.tied = int(np.flatnonzero(counts > 1)[0]) if (counts > 1).any() else int(NONE)
        if self.tied != NONE and self.tied != len(order) - 1:
            raise ValueError("pieces of equal score before the last rank are not supported")
        # single characters that are no pieces get numbers of their own, below the size of the table of characters
        self.by_char = np.full(0x110000, -1, np.int32)
        self.by_char[[ord(p) for p in plain if len(p) == 1]] = [i for p, i in plain.items() if len(p) == 1]
        keys, to, beside = [], [], set()
        for p, c in plain.items():
            for k in range(1, len(p)):
                beside.add((p[k - 1], p[k]))
                a, b = plain.get(p[:k]), plain.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    to.append(c)
        by = np.argsort(keys)
        self.keys, self.to = np.array(keys, np.int64)[by], np.array(to, np.int32)[by]
        a, b = self.keys // self.size, self.keys % self.size
        #: Pieces whose making can lead to a pair that ranks no worse: such merges are done one at a time.
        self.alone = np.zeros(self.size, bool)
        for half in (a, b):
            self.alone[half[self.rank[self.to] <= self.rank[half]]] = True
        self.beside = np.sort(np.array([ord(x) << 21 | ord(y) for x, y in beside], np.int64))

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two symbols merge to, or -1."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.to[at], np.int32(-1))

    @staticmethod
    def cuts(body: np.ndarray) -> np.ndarray:
        """Where no merge can cross: before a space that follows anything but a space or what spaces become, in UTF-8."""
        out = body == 32
        out[1:] &= body[:-1] != 32
        if (marks := np.flatnonzero(body == 0xE2)).size:  # the first of three bytes
            marks = marks[marks + 3 < len(body)]
            marks = marks[(body[marks + 1] == 0x96) & (body[marks + 2] == 0x81)]
            out[marks + 3] = False
        out[0] = True
        return out

    def escaped(self, pieces: list[bytes], first: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of pieces of text, and how many each has; a text's first piece has the dummy space before it."""
        dummy = SPACE if self.dummy else ""
        return self.encode_many([(dummy if f else "") + p.decode("utf-8", "surrogatepass").replace(" ", SPACE) for p, f in zip(pieces, first, strict=True)])

    def encode_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of escaped words, and how many each has."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        chars = common.code_points("".join(words))
        word = np.repeat(np.arange(len(words), dtype=np.int64), n)
        sym = self.by_char[chars]
        sym = np.where(sym >= 0, sym, -2 - chars.astype(np.int32))  # a character that is no piece
        seg = self._segments(chars, word, n)
        done_at, done_sym = self._merge(sym, seg)
        return self._ids(done_sym, word[done_at], len(words))

    def _segments(self, chars: np.ndarray, word: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Merge units: words, but a long word is cut wherever no piece has its two characters beside each other."""
        new = np.ones(len(word), bool)
        new[1:] = word[1:] != word[:-1]
        if len(n) and n.max() > 64:
            at = np.flatnonzero(~new & (n[word] > 64))
            key = chars[at - 1].astype(np.int64) << 21 | chars[at].astype(np.int64)
            k = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
            new[at[self.beside[k] != key]] = True
        return np.cumsum(new) - 1

    def _merge(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first character, and symbol, of all that is left after the last round."""
        at = np.arange(len(sym))
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]])) if len(sym) else at
        n = np.diff(np.append(first, len(seg)))
        if (long := np.flatnonzero(n > LONG)).size:
            for a, b in zip(first[long].tolist(), (first + n)[long].tolist(), strict=True):
                ends.append(self._queued(at[a:b], sym[a:b]))
            on = np.repeat(n <= LONG, n)
            at, sym, seg = at[on], sym[on], seg[on]
        to = np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            same = np.flatnonzero(seg[1:] == seg[:-1])
            to[same] = self.pair(sym[same], sym[same + 1])
        while len(sym):
            rank = np.where(to >= 0, self.rank[to], NONE)
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            n = np.diff(np.append(first, len(seg)))
            least = np.minimum.reduceat(rank, first)
            live = (least != NONE) & (least < self.tied)
            for k in np.flatnonzero(least == self.tied) if self.tied != NONE else ():
                ends.append(self._queued(at[first[k] : first[k] + n[k]], sym[first[k] : first[k] + n[k]]))
            keep = np.repeat(least == NONE, n)
            ends.append((at[keep], sym[keep]))
            on = np.repeat(live, n)
            at, sym, seg, to, rank = at[on], sym[on], seg[on], to[on], rank[on]
            if not len(sym):
                break
            hit = np.flatnonzero(rank == np.repeat(least[live], n[live]))
            begins = np.concatenate([[True], np.diff(hit) > 1])  # of runs of hits, each of which overlaps the next
            run = np.cumsum(begins) - 1
            take = (hit - hit[np.flatnonzero(begins)][run]) % 2 == 0
            alone = self.alone[to[hit]]
            if alone.any():
                take &= ~alone | np.concatenate([[True], seg[hit[1:]] != seg[hit[:-1]]])
            hit = hit[take]
            sym[hit] = to[hit]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            moved = hit - np.arange(len(hit))  # each earlier merge closes one gap
            at, sym, seg, to = at[stay], sym[stay], seg[stay], to[stay]
            for left in (moved, moved - 1):
                left = left[(left >= 0) & (left < len(sym))]
                to[left] = -1
                left = left[left + 1 < len(sym)]
                left = left[seg[left] == seg[left + 1]]
                to[left] = self.pair(sym[left], sym[left + 1])
        where, what = (np.concatenate(x) for x in zip(*ends, strict=True)) if ends else (at, sym)
        by = np.argsort(where, kind="stable")
        return where[by], what[by]

    @cached_property
    def _merges(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.to.tolist(), strict=True))

    def _queued(self, at: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merges of one stretch, always the least rank next and of equal ones the leftmost, from a queue."""
        merges, size, rank = self._merges, self.size, self.rank
        s, end = sym.tolist(), len(sym)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        k = self.pair(sym[:-1], sym[1:])
        some = np.flatnonzero(k >= 0)
        # a pair's rank and place as one number, and its piece
        queue = list(zip((rank[k[some]].astype(np.int64) * end + some).tolist(), k[some].tolist(), strict=True))
        heapq.heapify(queue)
        rank = rank.tolist()
        while queue:
            key, piece = heapq.heappop(queue)
            i = key % end
            j = after[i]
            # a number below 0 is a character that is no piece, or a symbol that is merged already
            if s[i] < 0 or j == end or s[j] < 0 or merges.get(s[i] * size + s[j]) != piece:
                continue
            s[i], s[j] = piece, -1
            j = after[i] = after[j]
            if j < end:
                before[j] = i
                if s[j] >= 0 and (c := merges.get(piece * size + s[j])) is not None:
                    heapq.heappush(queue, (rank[c] * end + i, c))
            h = before[i]
            if h >= 0 and s[h] >= 0 and (c := merges.get(s[h] * size + piece)) is not None:
                heapq.heappush(queue, (rank[c] * end + h, c))
        left = [0]
        while (j := after[left[-1]]) < end:
            left.append(j)
        return at[left], np.array([s[i] for i in left], np.int32)

    def _ids(self, sym: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        odd = np.flatnonzero(sym < 0)
        n = np.ones(len(sym), np.int64)
        if not len(odd):
            return sym.astype(np.int32), np.bincount(word, minlength=words)
        spelled = [self.bytes[list(chr(-2 - s).encode("utf-8", "surrogatepass"))] for s in sym[odd].tolist()]
        n[odd] = [len(x) for x in spelled]
        start = np.cumsum(n) - n
        ids = np.repeat(sym, n).astype(np.int32)
        for s, x in zip(start[odd].tolist(), spelled, strict=True):
            ids[s : s + len(x)] = x
        return ids, np.bincount(word, weights=n, minlength=words).astype(np.int64)


class PieceEncoder:
    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.memo = PieceMemo(self.model.cuts, self.model.escaped, apart=True)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of whole texts (large_string) with begin and end ids."""
        flat, n = self.memo.encode(texts)
        first = np.array([self.model.bos], np.int32), np.array([self.model.eos], np.int32)
        to = np.cumsum(n)
        return [np.concatenate([first[0], flat[b - k : b], first[1]]).astype("<u4") for k, b in zip(n.tolist(), to.tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.library.decode(ids.tolist())


@lru_cache(2)
def encoder(path: str) -> PieceEncoder:
    """One for each Python worker, so that its memo outlives a task."""
    return PieceEncoder(path)


def _run(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            texts = common.whole(batch.column(1))
            for a, b in common.blocks(texts):
                n, ids_sha, text_sha, kept = [], [], [], []
                for ids in codec.encode(texts.slice(a, b - a)):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(codec.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
                    if with_ids:
                        kept.append(ids.astype(np.int32))
                out = [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(np.concatenate(kept))))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(out)])

    return run


def encode_documents(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """Per row of docs(doc_id, text): n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids.

    Null or empty text: the begin and end ids alone. Repeated rows and null doc_ids stay as they are; an empty table
    gives an empty one. Other columns of docs are not read. Nothing is shuffled.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return common.slim(docs, "doc_id", "text").mapInArrow(common.trimmed(_run(model_path, with_ids)), schema)
