"""Tables of SQLite files, read-only."""

from __future__ import annotations

import contextlib
import sqlite3
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH_ROWS = 10_000


def read(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """The columns of schema from a table of each SQLite file of a path, with the file they are from as file.

    Each file is opened in memory by one task, so it may have 2 GB at most, and nothing is written. What is in a separate
    write-ahead log is not seen. A file without the table, or a value that doesn't fit its column, raises.
    """
    wanted = StructType.fromDDL(f"file string, {schema}")
    arrow = to_arrow_schema(wanted)
    columns = ", ".join('"' + f.name.replace('"', '""') + '"' for f in wanted.fields[1:])
    asked = f"""SELECT {columns} FROM "{table.replace('"', '""')}" ORDER BY rowid"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with contextlib.closing(sqlite3.connect(":memory:")) as db:
                    # Bytes 18 and 19 say 2 in write-ahead mode, which memory has not.
                    db.deserialize(content[:18] + b"\x01\x01" + content[20:] if content[18:20] == b"\x02\x02" else content)
                    rows = db.execute(asked)
                    while found := rows.fetchmany(BATCH_ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([[name] * len(found), *zip(*found, strict=True)], arrow, strict=True)], schema=arrow)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, wanted)
