"""Alignment of two tokenizers' tokens of the same texts, by relational operations over their tokens' byte ranges.

``links`` takes units that have two sequences of token lengths over the same bytes: tokens are exploded with their positions,
a window sums up their lengths, and the two sides meet in an equi-join on unit and end. An end that both sides have is a cut;
running counts of cuts number the groups between them. Each end of either side closes a range that one token of either
covers, and two tokens overlap in one such range: so the tokens that cover it, carried over by the same window, are the
links, as many as a range join would give, without meeting the other pairs of a large group.

``align_documents`` applies that to whole texts. A text is a chain of stretches that both tokenizers cut apart whatever stands
around them, and how a stretch's tokens align depends on their lengths alone: each distinct pattern of lengths is a unit that
is aligned once for the corpus. Blocks of documents keep their distinct stretches as token ids and patterns; joined with
their patterns' links they give each document's sums and digest, and the id pairs that each document holds. Those
are counted over the corpus, and joined back to the blocks. No table has a row for each token of all texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common, piece_bpe, token_binary
from tessera.llm.hashes import of_runs
from tessera.llm.memo import PieceMemo

#: Documents of a block at most, and about its text bytes; a longer text is a block of its own.
BLOCK_DOCS, BLOCK_BYTES = 512, 4 << 20
#: Numbers of a block that only _compose reads, packed: chain lengths of its documents, chains, and of each distinct stretch the
#: ids of both sides, how many they are, and the place of its pattern.
_HELD = ["chain_sizes", "chain", "a_ids", "n_a", "b_ids", "n_b", "pattern"]
_BLOCKS = f"block long, doc_ids array<long>, {', '.join(f'{c} binary' for c in _HELD)}, patterns array<struct<k1: bigint, k2: bigint, a_sizes: array<int>, b_sizes: array<int>>>"


def ends(units: DataFrame, key: list[str], side: str) -> DataFrame:
    """(*key, end, side_at): a side's tokens, with the bytes of the unit up to their end. Those of no bytes are left out."""
    tokens = units.select(*key, F.posexplode(f"{side}_sizes").alias(f"{side}_at", "size")).where("size > 0")
    upto = Window.partitionBy(*key).orderBy(f"{side}_at")
    return tokens.select(*key, F.sum("size").over(upto).alias("end"), f"{side}_at")


def links(units: DataFrame, key: list[str]) -> DataFrame:
    """(*key, end, a_at, b_at, a_ends, b_ends, group): one row for each pair of tokens whose byte ranges overlap.

    units(*key, a_sizes, b_sizes), whose key is unique and not null, have two token sequences of the same bytes, as their lengths. end is
    where the overlap ends, and a_ends, b_ends whether the token does. group is the number of cuts from here on, so it falls
    from group to group. Where one side has more bytes, what it has beyond the other's is linked with nothing.
    """
    both = ends(units, key, "a").join(ends(units, key, "b"), [*key, "end"], "full_outer")
    back = Window.partitionBy(*key).orderBy(F.desc("end"))
    own = {side: F.col(f"{side}_at").isNotNull() for side in "ab"}
    carried = [F.last(f"{side}_at", ignorenulls=True).over(back).alias(f"{side}_at") for side in "ab"]
    cuts = F.count(F.when(own["a"] & own["b"], 1)).over(back)
    found = both.select(*key, "end", *carried, own["a"].alias("a_ends"), own["b"].alias("b_ends"), cuts.alias("group"))
    return found.where("a_at is not null and b_at is not null")


def groups(found: DataFrame, key: list[str]) -> DataFrame:
    """(*key, links, groups) of links: each unit's pairs of token places (a, b), and the numbers of tokens (a, b) of its groups, in order."""
    size = lambda side: F.count(F.when(F.col(f"{side}_ends"), 1)).cast("int").alias(side)
    pair = F.collect_list(F.struct("end", F.col("a_at").alias("a"), F.col("b_at").alias("b")))
    each = found.groupBy(*key, "group").agg(size("a"), size("b"), pair.alias("pairs"))
    inner = lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))
    whole = each.groupBy(*key).agg(F.array_sort(F.flatten(F.collect_list("pairs"))).alias("links"), F.array_sort(F.collect_list(F.struct((-F.col("group")).alias("at"), "a", "b"))).alias("groups"))
    return whole.select(*key, *[F.transform(c, inner).alias(c) for c in ("links", "groups")])


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, their lowest bytes first and then the others, compressed: a third of what they take in a list."""
    raw = np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(table: pa.Table, name: str) -> np.ndarray:
    """The numbers that the only row of a table has, as 64 bits."""
    stored = table.column(name)[0].as_py()
    raw = pa.decompress(stored[8:], int.from_bytes(stored[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").reshape(-1).astype(np.int64)


class _Spelling:
    """The bytes that each id of a vocabulary stands for."""

    def __init__(self, tokens: dict[int, bytes]):
        n = max(tokens) + 1
        self.size = np.zeros(n, np.int32)
        self.size[list(tokens)] = [len(t) for t in tokens.values()]
        self.at = np.cumsum(self.size, dtype=np.int64) - self.size
        self.flat = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(n)), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        return self.flat[np.repeat(self.at[ids] - (np.cumsum(n, dtype=np.int64) - n), n) + np.arange(n.sum())]


def _byte_level(tokens: dict[str, int]) -> dict[int, bytes]:
    """Byte-level tokens have one character for each byte: itself if it can be seen in Latin-1, else one from 256 on."""
    seen = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    hidden = [b for b in range(256) if b not in set(seen)]
    byte = {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}
    return {i: bytes(byte[c] for c in t) for t, i in tokens.items()}


def _pieces(library) -> dict[int, bytes]:
    out = {}
    for i in range(library.get_piece_size()):
        p = library.id_to_piece(i)
        out[i] = bytes([int(p[3:5], 16)]) if library.is_byte(i) else b"" if library.is_control(i) else p.replace(piece_bpe.SPACE, " ").encode()
    return out


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places start[i], start[i] + 1 and so on, n[i] of them, for all i."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _distinct(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of hashes: where each distinct one is first, and the number of each."""
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    if (check[first][number] != check).any():
        _, first, number = np.unique(np.stack([key, check], 1), axis=0, return_index=True, return_inverse=True)
    return first, number


class StretchEncoder:
    """Distinct stretches of blocks of texts, with their tokens by both vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        byte_level = token_binary.TextEncoder(path_a)
        byte_level.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        pieces = piece_bpe.PieceModel(path_b)
        # a stretch brings its own space, so no piece is the first of a text
        self.memos = byte_level.memo, PieceMemo(pieces.cuts, lambda x, first: pieces.escaped(x, [False] * len(x)))
        # pairs of bytes that both tokenizers cut apart, later byte first: ASCII characters that no piece has beside each other
        self.apart = np.zeros((256, 256), bool)
        self.apart[: 0x7F, : 0x7F] = True
        self.apart[32, 0x80:] = True
        for x, y in zip((pieces.beside >> 21).tolist(), (pieces.beside & 0x1FFFFF).tolist(), strict=True):
            x, y = (32 if c == ord(piece_bpe.SPACE) else c for c in (x, y))
            if max(x, y) < 0x80:
                self.apart[y, x] = False
        self.apart[32, 32] = False
        self.spelling = _Spelling(_byte_level(byte_level.tokenizer.get_vocab())), _Spelling(_pieces(pieces.library))

    def _tokens(self, side: int, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, how many each stretch has, and which stretches their bytes spell out."""
        flat, n = self.memos[side].encode(stretches)
        spelling = self.spelling[side]
        body, at = common.raw(stretches)
        own = spelling.of(flat)
        to = np.concatenate([[0], np.cumsum(n)])
        upto = np.concatenate([[0], np.cumsum(spelling.size[flat], dtype=np.int64)])[to]
        if len(own) == len(body) and (upto == at).all() and (own == body).all():
            return flat, n, np.ones(len(n), bool)
        return flat, n, np.array([own[a:b].tobytes() == body[c:d].tobytes() for a, b, c, d in zip(upto[:-1], upto[1:], at[:-1], at[1:], strict=True)], bool)

    def block(self, number: int, doc_ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        """One row: each document's chain of stretches (empty: no tokens), the distinct stretches' tokens, and the patterns of these."""
        docs = len(texts)
        some = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        body, at = common.raw(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.take(pa.array(some)), pa.scalar(" ", pa.large_string())))
        opens = np.zeros(len(body), bool)
        if len(body):
            opens = token_binary._cuts(body) & self.apart[body, np.append(body[-1:], body[:-1])]
            opens[at[:-1]] = True
        start = np.flatnonzero(opens)
        size = np.diff(np.append(start, len(body)))
        raw = body.tobytes()
        first, seq = _distinct(*of_runs(raw, start, size, lanes=2))
        doc = np.repeat(some, np.diff(np.searchsorted(start, at)))
        to = np.concatenate([[0], np.cumsum(size[first])])
        own = body[_runs(start[first], size[first])]
        stretches = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(own.tobytes())])
        (a_ids, n_a, good_a), (b_ids, n_b, good_b) = (self._tokens(side, stretches) for side in (0, 1))
        # documents that a tokenizer doesn't spell out have no tokens
        good = np.ones(docs, bool)
        good[doc[~(good_a & good_b)[seq]]] = False
        doc, seq = doc[good[doc]], seq[good[doc]]
        # the most frequent stretches get the least numbers, and those that are used no more get none
        times = np.bincount(seq, minlength=len(first))
        order = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
        renamed = np.zeros(len(first), np.int64)
        renamed[order] = np.arange(len(order))
        seq = renamed[seq]
        a_ids, b_ids = a_ids[_runs((np.cumsum(n_a) - n_a)[order], n_a[order])], b_ids[_runs((np.cumsum(n_b) - n_b)[order], n_b[order])]
        n_a, n_b = n_a[order], n_b[order]
        sizes = self.spelling[0].size[a_ids], self.spelling[1].size[b_ids]
        # a pattern: the lengths of both sides with a 0 between
        n = n_a + 1 + n_b
        begin = np.cumsum(n) - n
        lengths = np.zeros(int(n.sum()), np.uint16)
        lengths[_runs(begin, n_a)], lengths[_runs(begin + n_a + 1, n_b)] = sizes
        k1, k2 = of_runs(lengths.tobytes(), 2 * begin, 2 * n, lanes=2)
        one, pattern = _distinct(k1, k2)
        lists = lambda n, values: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.astype(np.int32)))
        of_patterns = [pa.array(k1[one].view(np.int64)), pa.array(k2[one].view(np.int64)), *(lists(m[one], s[_runs((np.cumsum(m) - m)[one], m[one])]) for m, s in zip((n_a, n_b), sizes, strict=True))]
        whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        held = [pa.array([_packed(x)], pa.binary()) for x in (np.bincount(doc, minlength=docs), seq, a_ids, n_a, b_ids, n_b, pattern)]
        patterns = pa.StructArray.from_arrays(of_patterns, ["k1", "k2", "a_sizes", "b_sizes"])
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), whole(doc_ids), *held, whole(patterns)], names=["block", "doc_ids", *_HELD, "patterns"])


@lru_cache(2)
def encoder(path_a: str, path_b: str) -> StretchEncoder:
    """One for each Python worker, so that its memos outlive a task."""
    return StretchEncoder(path_a, path_b)


def _blocks(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, number = encoder(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                texts = common.whole(part.column(1))
                for a, b in common.blocks(texts, BLOCK_BYTES):
                    yield codec.block(number, part.column(0).slice(a, b - a).cast(pa.int64()), texts.slice(a, b - a))
                    number += 1

    return run


SUMS = ["n_a", "n_b", "n_groups", "n_links"]
_FOUND = (
    "block long, doc_ids array<long>, " + ", ".join(f"{c} array<long>" for c in SUMS) + ", groups_sha256 array<string>, "
    "pairs array<struct<a_id: int, b_id: int, docs: int>>, held_sizes binary, held binary, times binary"
)


def _spelled(a_ids: np.ndarray, b_ids: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, words: np.ndarray) -> list[bytes]:
    """The groups of each stretch as text, ``a1,a2|b1;a3|b2,b3``: tokens in the order of their groups, each with the sign after it.
    words: how many groups each stretch has."""
    n = group_a + group_b
    begin = np.cumsum(n) - n
    top = int(max(a_ids.max(initial=0), b_ids.max(initial=0))) + 1
    digits = _decimals(top)
    token, sign = np.zeros(int(n.sum()), np.int64), np.full(int(n.sum()), ord(","), np.uint8)
    token[_runs(begin, group_a)], token[_runs(begin + group_a, group_b)] = a_ids, b_ids
    sign[begin + group_a - 1], sign[begin + n - 1] = ord("|"), ord(";")
    size = digits.size[token].astype(np.int64) + 1
    end = np.cumsum(size)
    text = np.empty(int(size.sum()), np.uint8)
    text[_runs(end - size, size - 1)] = digits.of(token)
    text[end - 1] = sign
    text = text.tobytes()
    to = np.concatenate([[0], end[(begin + n)[np.cumsum(words) - 1] - 1]]).tolist()
    return [text[a : b - 1] for a, b in zip(to[:-1], to[1:], strict=True)]


@lru_cache(4)
def _decimals(top: int) -> _Spelling:
    return _Spelling({i: str(i).encode() for i in range(top)})


def _compose(key: tuple, blocks: pa.Table, patterns: pa.Table) -> pa.Table:
    """The documents of a block: their sums and digests, and the id pairs that they hold, with how often."""
    doc_ids = blocks.column("doc_ids").combine_chunks().flatten()
    sizes, chain, a_ids, n_a, b_ids, n_b, pattern = (_unpacked(blocks, c) for c in _HELD)
    shapes = patterns.sort_by("at").column("shape").combine_chunks()
    docs, to = len(doc_ids), np.concatenate([[0], np.cumsum(sizes)])
    at, flat = shapes.offsets.to_numpy().astype(np.int64), shapes.values.to_numpy(zero_copy_only=False).astype(np.int64)
    n_links = flat[at[:-1]][pattern]
    n_groups = np.diff(at)[pattern] // 2 - n_links
    begin = at[:-1][pattern] + 1
    link_a, link_b = (flat[_runs(begin + k * n_links, n_links)] for k in (0, 1))
    group_a, group_b = (flat[_runs(begin + 2 * n_links + k * n_groups, n_groups)] for k in (0, 1))
    sums = [np.diff(np.concatenate([[0], np.cumsum(n[chain])])[to]) for n in (n_a, n_b, n_groups, n_links)]
    texts = _spelled(a_ids, b_ids, group_a, group_b, n_groups) if len(pattern) else []
    order = chain.tolist()
    digests = [hashlib.sha256(b";".join([texts[k] for k in order[i:j]])).hexdigest() if j > i else "" for i, j in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]
    # the id pair of each link of each distinct stretch
    code = a_ids[np.repeat(np.cumsum(n_a) - n_a, n_links) + link_a] << 32 | b_ids[np.repeat(np.cumsum(n_b) - n_b, n_links) + link_b]
    pairs, pair = np.unique(code, return_inverse=True)
    has, times = np.unique(np.repeat(np.arange(docs), sizes) * max(1, len(pattern)) + chain, return_counts=True)
    doc, stretch = np.divmod(has, max(1, len(pattern)))
    n = n_links[stretch]
    held, at = np.unique(np.repeat(doc, n) * max(1, len(pairs)) + pair[_runs((np.cumsum(n_links) - n_links)[stretch], n)], return_inverse=True)
    times = np.bincount(at, weights=np.repeat(times, n), minlength=len(held))
    doc, held = np.divmod(held, max(1, len(pairs)))
    in_docs = np.bincount(held, minlength=len(pairs))
    # what only documents without tokens have is in none
    named = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (pairs >> 32, pairs & 0xFFFFFFFF, in_docs)], ["a_id", "b_id", "docs"])
    whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    columns = [*map(whole, (doc_ids, *map(pa.array, sums), pa.array(digests, pa.string()), named)), *(pa.array([_packed(x)], pa.binary()) for x in (np.bincount(doc, minlength=docs), held, times))]
    return pa.table([pa.array([key[0].as_py()], pa.int64()), *columns], names=["block", "doc_ids", *SUMS, "groups_sha256", "pairs", "held_sizes", "held", "times"])


def _score(key: tuple, blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block, once its pairs' counts over the corpus are known."""
    counts = counts.sort_by("at")
    sizes, held, times = (_unpacked(blocks, c) for c in ("held_sizes", "held", "times"))
    docs, best = counts.column("docs").to_numpy(), counts.column("best").to_numpy().astype(np.int64)
    to = np.concatenate([[0], np.cumsum(sizes)])
    sums = [np.diff(np.concatenate([[0], np.cumsum(times * x[held])])[to]) for x in (best, docs)]
    of_docs = lambda c: blocks.column(c).combine_chunks().flatten()
    return pa.table([of_docs("doc_ids"), *map(of_docs, SUMS), *sums, of_docs("groups_sha256")], names=["doc_id", *SUMS, "n_best", "count_sum", "groups_sha256"])


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Aligns the byte-level tokens of a space and each text of docs(doc_id, text) with the pieces of the text.

    For each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256. Null and empty texts, and those
    whose tokens spell out other bytes than a space and the text, have no tokens: their sums are 0 and their digest is empty.
    Rows that repeat a doc_id, or have none, are documents of their own. An empty table gives an empty one. Other columns of
    docs are not read.
    """
    key = ["k1", "k2"]
    path = common.scratch(docs.sparkSession, "blocks")
    common.slim(docs, "doc_id", "text").mapInArrow(_blocks(path_a, path_b), _BLOCKS).write.option("compression", "zstd").parquet(path)
    blocks = docs.sparkSession.read.schema(_BLOCKS).parquet(path)
    each = blocks.select("block", F.posexplode("patterns").alias("at", "x")).select("block", "at", "x.*")
    units = common.materialise(each.groupBy(*key).agg(F.first("a_sizes").alias("a_sizes"), F.first("b_sizes").alias("b_sizes")), "patterns")
    # one list of numbers for each pattern is a third of what lists of structs would be in the shuffle
    shape = F.concat(F.array(F.size("links")), "links.a", "links.b", "groups.a", "groups.b")
    aligned = common.materialise(groups(links(units, key), key).select(*key, shape.alias("shape")), "aligned")
    asked = each.select("block", "at", *key).join(aligned, key)
    rows = blocks.drop("patterns")
    # renamed, each side of a cogroup has attributes of its own
    found = common.materialise(rows.toDF(*rows.columns).groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_compose, _FOUND), "composed")
    common.drop(docs.sparkSession, path)  # nothing reads the blocks any more
    pairs = found.select("block", F.posexplode("pairs").alias("at", "x")).select("block", "at", "x.*")
    counted = common.materialise(pairs.groupBy("a_id", "b_id").agg(F.sum("docs").cast("long").alias("docs")), "counted")
    most = counted.groupBy("a_id").agg(F.max("docs").alias("most"))
    counts = common.materialise(counted.join(most, "a_id").select("a_id", "b_id", "docs", (F.col("docs") == F.col("most")).alias("best")), "counts")
    scored = pairs.select("block", "at", "a_id", "b_id").join(counts, ["a_id", "b_id"]).select("block", "at", "docs", "best")
    rows = found.drop("pairs")
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in (*SUMS, "n_best", "count_sum")) + ", groups_sha256 string"
    return rows.toDF(*rows.columns).groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(_score, schema)
