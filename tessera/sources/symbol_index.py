"""Symbol indexes in JSON as tables of occurrences, kinds and relationships."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import plain_relative_path
from tessera.sources import json_stream
from tessera.sources.scratch import materialise

# Relationship roles, by number and by name.
RELATIONSHIPS = {"1": "implements", "Implementation": "implements", "2": "ref", "References": "ref", "3": "type-def", "TypeDefinition": "type-def"}


def _many(column: str, path: str):
    return F.coalesce(F.try_variant_get(column, path, "array<variant>"), F.array().cast("array<variant>"))


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """occurrences(ord, path, symbol, role), relationships(owner, target, kind), kinds(ord, symbol, kind).

    An index may be of any size, each of its documents up to 128 MB. Symbol roles may be a bit mask or a list of names; unspecified kinds and documents without a path are left out.
    """
    stored = materialise(json_stream.elements(spark, path), "symbol_index").where("ord is not null").select("field", F.col("ord").alias("d"), F.parse_json("value").alias("v"))
    docs = stored.where("field = 'documents'").select("d", "v", plain_relative_path(F.try_variant_get("v", "$.relative_path", "string")).alias("path")).where("path <> ''")
    occ = docs.select("d", "path", F.posexplode(_many("v", "$.occurrences")).alias("k", "o"))
    mask = F.try_variant_get("o", "$.symbol_roles", "bigint")
    names = F.try_variant_get("o", "$.symbol_roles", "array<string>")
    defines = F.coalesce(mask.bitwiseAND(1) == 1, F.arrays_overlap(names, F.array(F.lit("Definition"), F.lit("1"))), F.lit(False))
    order = F.col("d").cast("long") * (1 << 31) + F.col("k")
    occurrences = occ.select(order.alias("ord"), "path", F.try_variant_get("o", "$.symbol", "string").alias("symbol"), F.when(defines, "def").otherwise("ref").alias("role"))
    own = docs.select("d", F.posexplode(_many("v", "$.symbols")).alias("k", "s"))
    outer = stored.where("field = 'external_symbols'").select(F.lit(2**30).alias("d"), F.col("d").alias("k"), F.col("v").alias("s"))
    infos = own.unionByName(outer).select(order.alias("ord"), F.try_variant_get("s", "$.symbol", "string").alias("symbol"), "s")
    kind = F.lower(F.try_variant_get("s", "$.kind", "string"))
    kinds = infos.select("ord", "symbol", F.when(~kind.isin("", "unspecifiedkind"), kind).alias("kind")).where("kind is not null")
    rel = infos.select("symbol", F.explode(_many("s", "$.relationships")).alias("r"))
    named = F.create_map(*[F.lit(x) for pair in RELATIONSHIPS.items() for x in pair])
    rel = rel.select(F.col("symbol").alias("owner"), F.try_variant_get("r", "$.symbol", "string").alias("target"), F.explode(F.coalesce(F.try_variant_get("r", "$.roles", "array<string>"), F.array().cast("array<string>"))).alias("role"))
    return occurrences, rel.select("owner", "target", F.try_element_at(named, F.col("role")).alias("kind")).where("kind is not null and target <> ''"), kinds
