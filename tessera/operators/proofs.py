"""Proofs that slices of files are the same: a hash tree in one table.

A file's leaf is the digest of its path and content digest. Leaves are shared out by the first hexadecimal digits of their own
digest, as many as keep a share small; a share's digest is that of its sorted leaves, and that of a shorter prefix is made
of its children's. So no group is gathered as a whole, a changed file changes one branch, and a file is
proved to be in a slice by its share and that branch alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import materialise

#: Leaves of a share that a tree is made deep enough for.
SHARE = 4096


def depth_for(files: int, share: int = SHARE) -> int:
    """The digits of a share's prefix."""
    depth = 0
    while share << 4 * depth < files:
        depth += 1
    return depth


def leaf(path: Column, sha256: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", path, sha256), 256)


def _of_leaves(leaves: Column) -> Column:
    return F.sha2(F.array_join(leaves, ""), 256)


def _of_children(children: Column) -> Column:
    """The digest of a node of children (digit, digest) in the order of their digits."""
    return F.sha2(F.array_join(F.transform(children, lambda c: F.concat(c["digit"], F.lit(":"), c["digest"])), ""), 256)


def _children(below: DataFrame, level: int) -> DataFrame:
    """(slice, prefix, children) of the nodes a level above."""
    child = F.struct(F.substring("prefix", level + 1, 1).alias("digit"), "digest")
    return below.groupBy("slice", F.substring("prefix", 1, level).alias("prefix")).agg(F.array_sort(F.collect_list(child)).alias("children"))


def tree(files: DataFrame, depth: int) -> DataFrame:
    """(slice, level, prefix, digest) of files(slice, path, sha256): all nodes, the roots at level 0. Files that are listed twice
    count once; a null content digest is one of its own. A slice without files has no root."""
    leaves = files.select("slice", leaf(F.col("path"), F.coalesce("sha256", F.lit("-"))).alias("leaf")).distinct()
    nodes = materialise(leaves.groupBy("slice", F.substring("leaf", 1, depth).alias("prefix")).agg(_of_leaves(F.array_sort(F.collect_list("leaf"))).alias("digest")), "nodes")
    every = nodes.withColumn("level", F.lit(depth))
    for level in range(depth - 1, -1, -1):
        nodes = materialise(_children(nodes, level).select("slice", "prefix", _of_children(F.col("children")).alias("digest")), "nodes")
        every = every.unionByName(nodes.withColumn("level", F.lit(level)))
    return every.select("slice", "level", "prefix", "digest")


def roots(nodes: DataFrame) -> DataFrame:
    return nodes.where("level = 0").select("slice", "digest")


def changed(old: DataFrame, new: DataFrame, depth: int) -> DataFrame:
    """(slice, prefix) of the shares that differ between two trees of one depth: only below nodes that differ is anything compared."""
    differ = None
    for level in range(depth + 1):
        o, n = (t.where(F.col("level") == level).select("slice", "prefix", F.col("digest").alias(name)) for t, name in ((old, "was"), (new, "is")))
        if differ is not None:
            above = differ.select("slice", F.col("prefix").alias("above"))
            o, n = (t.withColumn("above", F.substring("prefix", 1, level - 1)).join(above, ["slice", "above"], "left_semi").drop("above") for t in (o, n))
        differ = materialise(o.join(n, ["slice", "prefix"], "full_outer").where(~F.col("was").eqNullSafe(F.col("is"))).select("slice", "prefix"), "differ")
    return differ


def prove(files: DataFrame, nodes: DataFrame, depth: int, asked: DataFrame) -> DataFrame:
    """(slice, path, sha256, share, branch) of asked(slice, path) that are among the files: the leaves of its share in order,
    and the children of each node above, from the lowest to the root."""
    own = files.join(asked.select("slice", "path").distinct(), ["slice", "path"], "left_semi").select("slice", "path", F.coalesce("sha256", F.lit("-")).alias("sha256")).distinct()
    own = materialise(own.withColumn("leaf", leaf(F.col("path"), F.col("sha256"))), "asked")
    wanted = own.select("slice", F.substring("leaf", 1, depth).alias("prefix")).distinct()
    leaves = files.select("slice", leaf(F.col("path"), F.coalesce("sha256", F.lit("-"))).alias("leaf")).distinct().withColumn("prefix", F.substring("leaf", 1, depth))
    shares = leaves.join(wanted, ["slice", "prefix"], "left_semi").groupBy("slice", "prefix").agg(F.array_sort(F.collect_list("leaf")).alias("share"))
    found = own.withColumn("prefix", F.substring("leaf", 1, depth)).join(shares, ["slice", "prefix"]).drop("prefix").withColumn("branch", F.array().cast("array<array<struct<digit: string, digest: string>>>"))
    for level in range(depth - 1, -1, -1):
        above = _children(nodes.where(F.col("level") == level + 1), level)
        found = found.withColumn("prefix", F.substring("leaf", 1, level)).join(above, ["slice", "prefix"]).withColumn("branch", F.concat("branch", F.array("children"))).drop("prefix", "children")
    return found.drop("leaf")


def accepted(proofs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(slice, path, accepted): whether a proof leads from its path and content to the trusted root (slice, digest) of its slice."""
    own = leaf(F.col("path"), F.col("sha256"))
    depth = F.size("branch")
    start = F.struct(_of_leaves(F.col("share")).alias("digest"), (F.array_contains("share", own) & (F.col("share") == F.array_sort("share"))).alias("fine"), depth.alias("at"))

    def step(acc: Column, children: Column) -> Column:
        # the node below is the child of the path's own digit
        mine = F.exists(children, lambda c: (c["digit"] == F.substring(own, acc["at"], F.lit(1))) & (c["digest"] == acc["digest"]))
        return F.struct(_of_children(children).alias("digest"), (acc["fine"] & mine).alias("fine"), (acc["at"] - 1).alias("at"))

    rows = proofs.withColumn("end", F.aggregate("branch", start, step)).join(trusted.select("slice", F.col("digest").alias("root")), "slice", "left")
    return rows.select("slice", "path", F.coalesce(F.col("end.fine") & (F.col("end.digest") == F.col("root")), F.lit(False)).alias("accepted"))


def equal_heads(old: DataFrame, new: DataFrame) -> bool:
    """Whether two sets of slices (slice, digest) are the same: a build at one head then stands for the other."""
    differ = old.select("slice", F.col("digest").alias("was")).join(new.select("slice", F.col("digest").alias("is")), "slice", "full_outer")
    return not differ.where(~F.col("was").eqNullSafe(F.col("is"))).take(1)
