import contextlib
import sqlite3

import pytest

from tessera.sources import sqlite_files


def test_tables_of_files(spark, tmp_path):
    for name, mode in (("a", "delete"), ("b", "wal")):
        with contextlib.closing(sqlite3.connect(tmp_path / f"{name}.db")) as db:
            db.execute(f"pragma journal_mode={mode}")
            db.execute('create table "odd ""name" (pk integer primary key, curie text, vec blob, x real)')
            db.executemany('insert into "odd ""name" values (?, ?, ?, ?)', [(k, None if k == 2 else f"{name}:é{k}", bytes([k % 256]), k / 2) for k in range(12_000)])
            db.commit()
    found = sqlite_files.read(spark, f"file://{tmp_path}/*.db", 'odd "name', "pk long, curie string, vec binary, x double")
    assert found.columns == ["file", "pk", "curie", "vec", "x"] and found.count() == 24_000
    rows = {(r["file"].rsplit("/", 1)[-1], r["pk"]): (r["curie"], bytes(r["vec"]), r["x"]) for r in found.where("pk < 4").collect()}
    assert rows == {(f"{n}.db", k): (None if k == 2 else f"{n}:é{k}", bytes([k]), k / 2) for n in "ab" for k in range(4)}
    with pytest.raises(Exception, match="no such table"):
        sqlite_files.read(spark, f"file://{tmp_path}/a.db", "gone", "pk long").collect()


def test_an_empty_table(spark, tmp_path):
    with contextlib.closing(sqlite3.connect(tmp_path / "e.db")) as db:
        db.execute("create table t (k integer)")
        db.commit()
    assert sqlite_files.read(spark, f"file://{tmp_path}/e.db", "t", "k long").collect() == []
