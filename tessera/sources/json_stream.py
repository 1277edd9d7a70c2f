"""JSON documents of any size as rows: one for each element of a top-level array, one for each other top-level value."""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of one element or value; a document has no limit.
MAX_VALUE_CHARS = 1 << 28
BATCH_ROWS, BATCH_CHARS = 5_000, 8 << 20
_SPACE = re.compile(r"[ \t\r\n]*")


def _refuse(text: str) -> None:
    raise ValueError(f"not a number of JSON: {text}")


_next_value = json.JSONDecoder(parse_constant=_refuse).raw_decode


class _Text:
    """Text that comes in pieces. What has been read is dropped."""

    def __init__(self, pieces: Iterator[str]):
        self.pieces, self.text, self.at = pieces, "", 0

    def more(self) -> bool:
        """Reads as much again as is held, so that a long value is looked at a few times only."""
        held = len(self.text) - self.at
        if held > MAX_VALUE_CHARS:
            raise ValueError("a value is too long, or has no end")
        wanted, new = max(1 << 20, held), []
        for piece in self.pieces:
            new.append(piece)
            wanted -= len(piece)
            if wanted <= 0:
                break
        self.text, self.at = self.text[self.at :] + "".join(new), 0
        return bool(new)

    def peek(self) -> str:
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text):
                return self.text[self.at]
            if not self.more():
                return ""

    def take(self, allowed: str) -> str:
        found = self.peek()
        if not found or found not in allowed:
            raise ValueError(f"not JSON: wanted one of {allowed}, found {found or 'the end'}")
        self.at += 1
        return found

    def value(self) -> str:
        self.peek()
        while True:
            try:
                end = _next_value(self.text, self.at)[1]
            except json.JSONDecodeError:
                end = None
            if end is not None and end < len(self.text):
                break
            if not self.more():
                raise ValueError("not JSON, or a document without its end")
        found, self.at = self.text[self.at : end], end
        return found


def walk(pieces: Iterator[str]) -> Iterator[tuple[str, int | None, str]]:
    """(field, ord, JSON text) of a document, an object, that comes in pieces; ord is null for values that aren't arrays."""
    text, seen = _Text(pieces), set()
    text.take("{")
    done = text.peek() == "}"
    if done:
        text.take("}")
    while not done:
        field = json.loads(text.value())
        if not isinstance(field, str) or field in seen:
            raise ValueError("not JSON, or a repeated key")
        seen.add(field)
        text.take(":")
        if text.peek() != "[":
            yield field, None, text.value()
        else:
            text.take("[")
            if text.peek() == "]":
                text.take("]")
            else:
                for k in itertools.count():
                    yield field, k, text.value()
                    if text.take(",]") == "]":
                        break
        done = text.take(",}") == "}"
    if text.peek():
        raise ValueError("not JSON: text after the document")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    """(document, its size, text) of batches that are sorted; a batch's pieces of one document are one text."""
    for batch in batches:
        names, sizes, values = (batch.column(c).to_pylist() for c in ("document", "size", "value"))
        if names and names[0] == names[-1]:
            yield names[0], sizes[0], "}".join(values)
        else:
            yield from zip(names, sizes, values, strict=True)


def _pieces(rows: Iterator[tuple[str, int, str]]) -> Iterator[str]:
    """The document again: } ended each piece. Whether it ended the last one, the size tells (not of a compressed file)."""
    bytes_so_far, size = 0, 0
    for k, (_, size, value) in enumerate(rows):
        piece = "}" + value if k else value
        bytes_so_far += len(piece.encode())
        yield piece
    if bytes_so_far != size:
        yield "}"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.string(), pa.string(), pa.int32(), pa.string()), strict=True)], names=["document", "field", "ord", "value"])

    made, chars = [], 0
    for name, rows in itertools.groupby(_documents(batches), key=lambda r: r[0]):
        for field, k, value in walk(_pieces(rows)):
            made.append((name, field, k, value))
            chars += len(value)
            if len(made) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield out()
                made, chars = [], 0
    if made:
        yield out()


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(document, field, ord, value): the top-level values of JSON documents, as texts, and of arrays the elements.

    Files are read in pieces that end with }, by many tasks; the pieces of a document meet in one task, sorted, which holds
    a few of them at a time. A faulty document, a repeated top-level key or a number that isn't finite raises.
    """
    read = spark.read.option("lineSep", "}").text(path)
    pieces = read.select(F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("k"), "value")
    return pieces.repartition("document").sortWithinPartitions("document", "start", "k").mapInArrow(_rows, "document string, field string, ord int, value string")
