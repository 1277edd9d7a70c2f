"""Token-ID output: Parquet files whose list column of ids is dictionary coded, in ascending document order.

Layout of a file set: one row for each document, ``doc_id`` (delta coded), ``shard`` (rank of its file),
``local_start`` (ids before it in its file), ``n_tokens`` and ``ids``. Row groups and pages have set sizes and
carry page indexes, so a reader of a doc_id range or of the metadata alone skips the other pages.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm.memo import PieceMemo

SCHEMA = "doc_id long, shard int, local_start long, n_tokens long, ids array<int>"
#: Bytes of a row group and of a page: a task's write buffer, and the least that a selective read decodes.
ROW_GROUP, PAGE = 16 << 20, 256 << 10
# Bytes that a text may be cut after, before a space: ASCII signs, letters and digits. A character of Latin-1's letters
# ends in one of the bytes below after the byte C3.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_SIGN = _PLAIN & ~_LETTER
_SIGN[ord("0") : ord("9") + 1] = False
_OPENS = _PLAIN.copy()  # first bytes of characters that are no white space
_OPENS[0xC3] = True
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False  # the signs for times and divided by


def between_letter_and_sign(body: np.ndarray) -> np.ndarray:
    """For each byte but the first: it is an ASCII sign after an ASCII letter."""
    return _SIGN[body[1:]] & _LETTER[body[:-1]]


def letters(body: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of Latin-1's letters in UTF-8."""
    out = _LETTER[body]
    pair = _LATIN[body[1:]] & (body[:-1] == 0xC3)
    out[1:] |= pair
    out[:-1] |= pair
    return out


def _safe(body: np.ndarray) -> np.ndarray:
    """Bytes that end a character after which a space may be cut off."""
    safe = _PLAIN[body]
    safe[1:] |= _LATIN[body[1:]] & (body[:-1] == 0xC3)
    return safe


def _cuts(body: np.ndarray) -> np.ndarray:
    """Where the library's own splitting always cuts: after a safe character before a space, or before a line end that
    no other white space follows; and between an ASCII letter and an ASCII sign."""
    out = body == 32
    if len(body) > 2:
        out[1:-1] |= (body[1:-1] == 10) & _OPENS[body[2:]]
    out[1:] &= _safe(body)[:-1]
    out[1:] |= between_letter_and_sign(body)
    out[0] = True
    return out


class TextEncoder:
    """Ids of whole texts by the tokenizers library, add_special_tokens=False.

    The library cuts a text before a space that follows a letter, digit or ASCII sign, whatever stands around
    them, and encodes what lies between such cuts by itself; so equal stretches are given to it once. A text that
    holds an added token's string goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = PieceMemo(_cuts, self._many)
        vocab = self.tokenizer.get_vocab()
        #: UTF-8 bytes that each id stands for: a byte-level token has one character for each byte.
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.lengths[i] = len(token)

    def _many(self, pieces: list[bytes], _: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces between two cuts go to the library as one text; the bytes of its tokens show where each ends.

        A piece that begins with a sign gets a letter before it, after which it would have been cut off.
        """
        raw = b"".join(pieces)
        body = np.frombuffer(raw, np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        end = np.cumsum(size)
        start = end - size
        opens = body[start]
        second = body[np.minimum(start + 1, len(body) - 1)]
        sign = _SIGN[opens]
        apart = _safe(body)[end - 1] & (sign | (size > 1) & ((opens == 32) | (opens == 10) & _OPENS[second]))
        order = np.concatenate([np.flatnonzero(apart), np.flatnonzero(~apart)])
        m = int(apart.sum())
        lead = sign[order] & (np.arange(len(order)) < m)
        bits = [(b" a" + raw[a:b]) if x else raw[a:b] for a, b, x in zip(start[order].tolist(), end[order].tolist(), lead.tolist(), strict=True)]
        texts = [b"".join(bits[a : min(a + 1000, m)]).decode() for a in range(0, m, 1000)] + [x.decode() for x in bits[m:]]
        flat = np.concatenate([np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.cumsum(size[order] + 2 * lead)
        at = np.cumsum(self.lengths[flat])
        upto, since = np.searchsorted(at, ends, "right"), np.searchsorted(at, ends - size[order], "right")
        n = np.zeros(len(start), np.int64)
        n[order] = upto - since
        back = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int32)
        step = np.arange(len(out)) - np.repeat(np.cumsum(n[order]) - n[order], n[order])
        out[np.repeat(back[order], n[order]) + step] = flat[np.repeat(since, n[order]) + step]
        return out, n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and how many each has."""
        flat, n = self.memo.encode(texts)
        body = common.raw(texts)[0].tobytes()
        if any(a.encode() in body for a in self.added):
            parts = np.split(flat, np.cumsum(n)[:-1])
            for k, text in enumerate(texts.to_pylist()):
                if any(a in text for a in self.added):
                    parts[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            flat, n = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return flat, n


@lru_cache(2)
def encoder(path: str) -> TextEncoder:
    """One for each Python worker, so that its memo outlives a task."""
    return TextEncoder(path)


def _encode(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, start = encoder(path).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, doc_ids = common.whole(batch.column(1)), batch.column(0)
            for a, b in common.blocks(texts):
                flat, n = encode(texts.slice(a, b - a))
                flat, n = np.insert(flat, np.cumsum(n), np.int32(end)), n + 1
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), pa.array(np.full(b - a, shard, np.int32)), pa.array(start + ends - n), pa.array(n), lists], names=["doc_id", "shard", "local_start", "n_tokens", "ids"])
                start += int(ends[-1])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encodes docs(doc_id, text) and writes the file set to path.

    Null or empty text: the end id alone. Repeated doc_ids stay, in the order of a hash of their texts; a null doc_id comes
    first. Rows of one doc_id, or without any, are dealt over shards by that hash, and equal rows by their place. An empty
    table gives an empty file set. Other columns of docs are not read.
    """
    dealt = common.slim(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"))
    (
        dealt.repartitionByRange("doc_id", "hash", "place")
        .sortWithinPartitions("doc_id", "hash", "place")
        .select("doc_id", "text")
        .mapInArrow(_encode(tokenizer_path, end_id), SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#local_start", "false")
        .option("parquet.block.size", str(ROW_GROUP))
        .option("parquet.page.size", str(PAGE))
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The chosen columns of a file set; filters on doc_id reach the row groups and pages."""
    df = spark.read.schema(SCHEMA).parquet(path)
    return df.select(*columns) if columns else df


def starts(files: DataFrame) -> DataFrame:
    """(shard, shard_start): ids in all shards before. One row for each file written, and no token is read."""
    totals = files.groupBy("shard").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("shard_start"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        at, flat = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))
        crc = [zlib.crc32(flat[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "shard", "local_start", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    rows = read_token_files(spark, path, ["doc_id", "shard", "local_start", "ids"]).mapInArrow(_digest, "doc_id long, shard int, local_start long, n_tokens long, ids_crc32 long")
    # one row for each file, so its size is bound by the number of tasks that wrote
    by_shard = F.broadcast(starts(read_token_files(spark, path, ["shard", "local_start", "n_tokens"])))
    return rows.join(by_shard, "shard").select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
