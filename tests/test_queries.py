import pytest
from pyspark.sql import functions as F

from tessera.plans.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_is_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    wanted = duck.sql(f"select {', '.join(names)} from ({ORACLE[name].strip()})")
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, wanted.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_training_data_operators():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "tessera"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "tessera.llm" in p.read_text()]


def test_first_parts_are_missing_however_many_parts_there_are(spark, tmp_path):
    lines, parts = [(1, 5, 1), (1, 7, 2), (2, 7, 1), (2, 1000005, 2)], [(5,), (7,), (1000005,), (1000007,)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long").withColumn("p_name", F.lit("x")).write.parquet(f"{tmp_path}/part.parquet")
    for table, key, *more in (("region", "r_regionkey", "r_name"), ("nation", "n_nationkey", "n_name"), ("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("orders", "o_orderkey", "o_orderpriority")):
        spark.createDataFrame([(1, "x")], f"{key} long, {more[0]} string").write.parquet(f"{tmp_path}/{table}.parquet")
    found = QUERIES["graph_hyperedge_check"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [(1, "part:1000005"), (2, "part:1000007")]


def test_symbols_in_one_place_have_one_anchor(spark):
    from tessera.operators import symbols

    rows = [(1, "a", "part:2", "def"), (1, "a", "part:1", "def"), (1, "a", "part:3", "def"), (2, "b", "part:9", "def")]
    for order in (rows, rows[::-1]):
        found = symbols.anchors(spark.createDataFrame(order, "ord long, path string, symbol string, role string").coalesce(1))
        assert {tuple(r) for r in found.collect()} == {("a", "part:1"), ("b", "part:9")}


def test_parts_of_a_small_file_are_extracted_by_all_cores(spark, sf_dir, monkeypatch):
    from tessera.operators import extract

    found, fragments = [], extract.fragments
    monkeypatch.setattr(extract, "fragments", lambda files: (found.append(files.rdd.getNumPartitions()), fragments(files))[1])
    QUERIES["extract_parts"](spark, sf_dir)
    assert found[0] >= spark.sparkContext.defaultParallelism
