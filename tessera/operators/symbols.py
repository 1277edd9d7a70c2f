"""A symbol index as a graph: definitions, foreign references and relationships.

occurrences(ord, path, symbol, role) with role def or ref; relationships(owner, target, kind); kinds(ord, symbol, kind).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODULE_SUFFIX = "/__init__:"


def _named(rows: DataFrame, column: str = "symbol") -> DataFrame:
    return rows.where(F.col(column).isNotNull() & (F.col(column) != "") & ~F.col(column).startswith("local "))


def definitions(occurrences: DataFrame) -> DataFrame:
    """(symbol, home): the first document that defines a symbol; of several in one place the least, so reruns agree."""
    return _named(occurrences).where("role = 'def'").groupBy("symbol").agg(F.min_by("path", F.struct("ord", "path")).alias("home"))


def anchors(occurrences: DataFrame, module_suffix: str = MODULE_SUFFIX) -> DataFrame:
    """(path, anchor): a document's module symbol, or else its first definition; of several in one place the least symbol."""
    place = F.struct((~F.col("symbol").endswith(module_suffix)).alias("late"), "ord", "symbol")
    return _named(occurrences).where("role = 'def'").groupBy("path").agg(F.min_by("symbol", place).alias("anchor"))


def reference_links(occurrences: DataFrame, module_suffix: str = MODULE_SUFFIX) -> DataFrame:
    """(source, target, kind) of references to symbols whose home is another document, or none; no self-links."""
    refs = _named(occurrences).where("role = 'ref'").select("path", "symbol").distinct()
    joined = refs.join(definitions(occurrences), "symbol", "left").where(~F.col("path").eqNullSafe(F.col("home")))
    rows = joined.join(anchors(occurrences, module_suffix), "path").where("anchor <> symbol")
    return rows.select(F.col("anchor").alias("source"), F.col("symbol").alias("target"), F.lit("ref").alias("kind")).distinct()


def external_symbols(occurrences: DataFrame) -> DataFrame:
    """Referenced symbols without a home."""
    refs = _named(occurrences).where("role = 'ref'").select("symbol").distinct()
    return refs.join(definitions(occurrences), "symbol", "left_anti")


def symbol_nodes(occurrences: DataFrame, kinds: DataFrame, relationships: DataFrame) -> DataFrame:
    """(id, kind, source_file): symbols that occur, have a kind or own a relationship. Targets alone make no node."""
    seen = _named(occurrences).select("symbol").unionByName(_named(kinds).select("symbol")).unionByName(_named(relationships, "owner").select(F.col("owner").alias("symbol"))).distinct()
    first = _named(kinds).where("kind is not null").groupBy("symbol").agg(F.min_by("kind", "ord").alias("kind"))
    return seen.join(first, "symbol", "left").join(definitions(occurrences), "symbol", "left").select(F.col("symbol").alias("id"), F.coalesce("kind", F.lit("symbol")).alias("kind"), F.col("home").alias("source_file"))


def symbol_links(occurrences: DataFrame, relationships: DataFrame, module_suffix: str = MODULE_SUFFIX) -> DataFrame:
    """Reference links and relationship links, each (source, target, kind) once."""
    own = _named(relationships, "owner").where("target is not null and target <> '' and owner <> target").select(F.col("owner").alias("source"), "target", "kind")
    return own.unionByName(reference_links(occurrences, module_suffix)).distinct()


def kind_histogram(links: DataFrame) -> DataFrame:
    return links.groupBy("kind").agg(F.count("*").alias("n"))


def dropped_locals(occurrences: DataFrame) -> DataFrame:
    return occurrences.agg(F.count_if(F.col("symbol").startswith("local ")).alias("locals_dropped"))
