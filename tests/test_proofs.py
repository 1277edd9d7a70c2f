import pytest
from pyspark.sql import functions as F

from tessera.operators import proofs

FILES = [("s", f"p/{k}", f"{k:064d}") for k in range(60)] + [("t", "q", None), ("t", "q", None), ("t", "r", "1" * 64)]


def _files(spark, rows=FILES):
    return spark.createDataFrame(rows, "slice string, path string, sha256 string")


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_branches_prove_files_and_forged_fields_are_refused(spark, depth):
    nodes = proofs.tree(_files(spark), depth)
    trusted = proofs.roots(nodes)
    assert {r["slice"] for r in trusted.collect()} == {"s", "t"}
    asked = spark.createDataFrame([("s", "p/7"), ("s", "p/31"), ("t", "q"), ("s", "none")], "slice string, path string")
    found = proofs.prove(_files(spark), nodes, depth, asked).cache()
    assert {(r["slice"], r["path"]) for r in found.collect()} == {("s", "p/7"), ("s", "p/31"), ("t", "q")}
    verdicts = lambda df, to=trusted: {r["accepted"] for r in proofs.accepted(df, to).collect()}
    assert verdicts(found) == {True}
    forged = {
        "path": F.concat("path", F.lit("x")), "sha256": F.lit("2" * 64), "slice": F.when(F.col("slice") == "s", "t").otherwise("s"),
        "share": F.concat("share", F.array(F.lit("f" * 64))),
        "branch": F.transform("branch", lambda level: F.transform(level, lambda c: F.struct(c["digit"].alias("digit"), F.reverse(c["digest"]).alias("digest")))),
    }
    for field, value in forged.items():
        if field != "branch" or depth:
            assert verdicts(found.withColumn(field, value)) == {False}, field
    assert verdicts(found, trusted.withColumn("digest", F.lit("0" * 64))) == {False} == verdicts(found, trusted.where("false"))
    if depth:
        assert verdicts(found.withColumn("branch", F.slice("branch", 1, depth - 1))) == {False}


def test_equal_heads_and_what_changed(spark):
    one = proofs.tree(_files(spark), 2)
    assert proofs.equal_heads(proofs.roots(one), proofs.roots(proofs.tree(_files(spark).repartition(5), 2)))
    other = proofs.tree(_files(spark, [*FILES[:-1], ("t", "r", "9" * 64)]), 2)
    assert not proofs.equal_heads(proofs.roots(one), proofs.roots(other))
    assert not proofs.equal_heads(proofs.roots(one), proofs.roots(one).where("slice = 's'"))
    differ = proofs.changed(one, other, 2).collect()
    assert {r["slice"] for r in differ} == {"t"} and len(differ) == 2 and proofs.changed(one, one, 2).collect() == []
    assert [proofs.depth_for(n, 4) for n in (0, 4, 5, 64, 65, 1025)] == [0, 0, 1, 1, 2, 3]
    assert proofs.tree(_files(spark).where("false"), 2).collect() == []
