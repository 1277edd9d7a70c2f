"""Helpers shared by the training-data operators: tables of documents and vectorised text arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import drop, materialise, scratch, shared_dir

__all__ = ["blocks", "code_points", "drop", "fold", "gram_slots", "letter_runs", "letters", "materialise", "packed", "packed_slots", "raw", "scratch", "shared_dir", "slim", "slim_batches", "table", "trimmed", "unpacked", "unused", "whole"]

#: A word, in every operator: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Largest number of text bytes that the vectorised kernels handle at once.
BLOCK_BYTES = 1 << 19
#: Rows of whole texts that one Arrow batch may have, in place of Spark's 10,000.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slim(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that no other column of docs can clash with what an operator adds."""
    return slim_batches(docs.select(*[F.col(n) for n in names]))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it for as long as df has a column of that name, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def slim_batches(df: DataFrame) -> DataFrame:
    """df, once its session sends Python workers no more than BATCH_ROWS rows at a time: a worker's memory is bound by them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


def trimmed(run):
    """run over the batches of a task; what it has freed goes back to the system when the task ends, for its worker stays and may
    have another stage's work next."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)

    return whole


def fold(doc_id: str, by: int) -> Column:
    """crc32 of doc_id as text, modulo by."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(by))


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most limit text bytes each; a longer text is a range of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at, n = 0, len(texts)
    while at < n:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield at, to
        at = to


def whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one large_string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a large_string array and the n + 1 offsets of its rows in them."""
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """By code point: that of the lower-case letter, and a space for anything but a letter."""
    global _letters
    if _letters is None:
        out = np.full(0x110000, 32, np.uint32)
        for cp in range(0x110000):
            if (c := chr(cp)).isalpha():
                low = c.lower()
                out[cp] = ord(low) if len(low) == 1 else cp
        _letters = out
    return _letters


def letter_runs(text: str) -> np.ndarray:
    """Lower-case letters of a text with single spaces between, before and after its runs of letters."""
    c = np.concatenate([[np.uint32(32)], letters()[code_points(text)], [np.uint32(32)]])
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    return c[keep]


def packed(slots: np.ndarray, bits: int) -> bytes:
    """Distinct slots of 2**bits, as a bitmap or as a list of numbers, whichever is shorter."""
    if 32 * len(slots) < 1 << bits:
        return slots.astype("<i4").tobytes()
    row = np.zeros(1 << bits, bool)
    row[slots] = True
    return b"*" + np.packbits(row).tobytes()  # one byte more than a multiple of four


def unpacked(raw: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, offset=1))).astype(np.int32) if len(raw) % 4 else np.frombuffer(raw, "<i4")


def packed_slots(rows: DataFrame, name: str, orders: range, bits: int) -> DataFrame:
    """rows with their distinct letter n-gram slots, packed, in the place of the text, and their number: at most 2**bits / 8 + 1
    bytes a row."""
    kept = [c for c in rows.columns if c != name]
    at = rows.columns.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, sizes = [], []
            for text in batch.column(at).to_pylist():
                own = np.unique(gram_slots(letter_runs(text), orders, bits))
                made.append(packed(own, bits))
                sizes.append(len(own))
            yield pa.RecordBatch.from_arrays([*[c for k, c in enumerate(batch.columns) if k != at], pa.array(made, pa.binary()), pa.array(sizes, pa.int64())], names=[*kept, "slots", "n_slots"])

    return slim_batches(rows).mapInArrow(trimmed(run), rows.select(*kept).schema.add("slots", "binary").add("n_slots", "long"))


def gram_slots(c: np.ndarray, orders: range, bits: int) -> np.ndarray:
    """Slots, of 2**bits, of all n-grams of a code point array; a gram's order is part of its key."""
    c = c.astype(np.uint64)
    key, out = c.copy(), []
    for n in range(1, orders.stop):
        if n > 1:
            key = (key[:-1] * np.uint64(0x100000001B3) + c[n - 1 :] + np.uint64(n)) if len(key) > 1 else key[:0]
        if n in orders:
            k = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((k ^ (k >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - bits))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)
