"""Build steps around extraction: previews, coverage, validation of links, governed blocks and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.admission import target_class


def tracked_only(files: DataFrame, tracked: DataFrame | None) -> DataFrame:
    """files(path, ...) that are in tracked(path); all of them where no list could be had."""
    return files if tracked is None else files.join(tracked.select("path"), "path", "left_semi")


def tree_entries(listing: DataFrame) -> DataFrame:
    """(mode, kind, blob_oid, bytes, path) of tree listings (value): entries end in NUL, sizes of - are null."""
    one = listing.select(F.explode(F.split("value", "\x00")).alias("e")).where("e <> ''")
    part = lambda k: F.regexp_extract("e", r"(?s)^(\d+) (\w+) ([0-9a-f]+) +(\d+|-)\t(.+)$", k)
    return one.select(part(1).alias("mode"), part(2).alias("kind"), part(3).alias("blob_oid"), F.try_to_number(part(4), F.lit("999999999999999")).cast("long").alias("bytes"), part(5).alias("path"))


def slice_preview(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(slice, state) of (slice, path, blob_oid) now and before: new, paths_and_blobs_unchanged, changed or removed."""
    c = current.select("slice", "path", "blob_oid").withColumn("_now", F.lit(1))
    p = previous.select("slice", "path", "blob_oid").withColumn("_then", F.lit(1))
    both = c.join(p, ["slice", "path", "blob_oid"], "full_outer").groupBy("slice").agg(F.count("_now").alias("now"), F.count("_then").alias("then"), F.count_if(F.col("_now").isNotNull() & F.col("_then").isNotNull()).alias("same"))
    state = F.when(F.col("then") == 0, "new").when(F.col("now") == 0, "removed").when((F.col("now") == F.col("same")) & (F.col("then") == F.col("same")), "paths_and_blobs_unchanged").otherwise("changed")
    return both.select("slice", state.alias("state"))


def overlapping_slices(files: DataFrame) -> DataFrame:
    """(path, slices) of paths that more than one slice has: such a union is refused."""
    return files.groupBy("path").agg(F.countDistinct("slice").alias("slices")).where("slices > 1")


def coverage(files: DataFrame) -> DataFrame:
    """(coverage, n): files that are structural, enriched or unknown, all three always."""
    names = files.sparkSession.createDataFrame([("structural",), ("enriched",), ("unknown",)], "_c string")
    n = files.groupBy("coverage").agg(F.count("*").alias("n"))
    return names.join(n, F.col("_c") == F.col("coverage"), "left").select(F.col("_c").alias("coverage"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def without_provenance(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """(fault, n): records without a source file, and with one that isn't in the inventory(path)."""
    known = inventory.select(F.col("path").alias("_p"))
    fault = F.when(F.col("source_file").isNull(), "no_source_file").when(F.col("_p").isNull(), "not_in_inventory")
    return records.join(known, F.col("source_file") == F.col("_p"), "left").where(fault.isNotNull()).groupBy(fault.alias("fault")).agg(F.count("*").alias("n"))


def link_faults(nodes: DataFrame, links: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(ord, level, class) of links whose ends are missing: a missing source is fatal, a missing target is a classed
    warning, unless it is the path of one of files(path)."""
    known = nodes.select(F.col("id").alias("_id"))
    bad = links.join(known, F.col("source") == F.col("_id"), "left_anti").select("ord", F.lit("fatal").alias("level"), F.lit("missing_source").alias("class"))
    lost = links.join(known, F.col("target") == F.col("_id"), "left_anti").where("target <> ''")
    if files is not None:
        lost = lost.join(files.select(F.col("path").alias("_path")), F.col("target") == F.col("_path"), "left_anti")
    return bad.unionByName(lost.select("ord", F.lit("warning").alias("level"), target_class(F.col("target")).alias("class")))


def forbidden_sources(nodes: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Nodes whose source file has one of the tokens in it, in any case."""
    hit = F.lit(False)
    for t in tokens:
        hit = hit | F.lower("source_file").contains(t.lower())
    return nodes.where(F.coalesce(hit, F.lit(False)))


def cross_reference_list(cross: DataFrame, most: int = 100) -> DataFrame:
    """One row for each slice: how many references lead out of it, the first of them, and whether some are left out."""
    place = F.row_number().over(Window.partitionBy("slice").orderBy("source_file", "type", "target", "line", "target_path"))
    first = cross.withColumn("_k", place).where(F.col("_k") <= most).groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("_k", "source_file", "target_path"))).alias("listed"))
    n = cross.groupBy("slice").agg(F.count("*").alias("n"))
    return n.join(first, "slice").select("slice", "n", F.size("listed").cast("long").alias("listed"), (F.col("n") > most).alias("truncated"), F.lit(False).alias("followed"))


def wave_summary(runs: DataFrame) -> DataFrame:
    """One row of runs(corpus, outcome): passed, failed and skipped, and which failed."""
    failed = F.array_join(F.array_sort(F.collect_list(F.when(F.col("outcome") == "failed", F.col("corpus")))), ",")
    return runs.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("passed", "failed", "skipped")], failed.alias("failed_corpora"))


def governed_blocks(lines: DataFrame, marker: str = r"^<!-- negative-boundary: (\S+) status=(\S+) claims=(\S+) -->$") -> DataFrame:
    """(path, section, boundary, status, claims, line, statement) of lines(path, ord, value): after each marker line, the
    lines up to an empty one, a heading, a table or the next marker. One file's lines are handled together."""
    by = Window.partitionBy("path").orderBy("ord")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    is_marker, heading = F.col("value").contains("negative-boundary:"), F.regexp_extract("value", "^## (.+)$", 1)
    rows = lines.withColumn("section", F.last(F.nullif(F.trim(heading), F.lit("")), ignorenulls=True).over(upto)).withColumn("block", F.sum(is_marker.cast("int")).over(upto)).withColumn("mark", is_marker)
    stop = ~F.col("mark") & ((F.trim("value") == "") | F.col("value").startswith("|") | (heading != ""))
    rows = rows.where("block > 0").withColumn("ended", F.max(stop.cast("int")).over(Window.partitionBy("path", "block").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)))
    part = lambda k: F.max(F.when(F.col("mark"), F.nullif(F.regexp_extract("value", marker, k), F.lit(""))))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("mark"), F.struct("ord", F.trim("value").alias("t"))))), lambda x: x["t"]), " ")
    return rows.where("ended = 0").groupBy("path", "block").agg(F.max(F.when(F.col("mark"), F.col("section"))).alias("section"), part(1).alias("boundary"), part(2).alias("status"), part(3).alias("claims"), F.min("ord").alias("line"), text.alias("statement")).drop("block")


def run_counts(current: DataFrame, previous: DataFrame, reused: DataFrame) -> DataFrame:
    """One row of counts for a repository's run: current and previous(slice, path, blob_oid), and slices reused(slice).

    A rename counts as one path added and one deleted.
    """
    c = current.select(F.col("path").alias("_c"), F.col("blob_oid").alias("_cb"))
    p = previous.select(F.col("path").alias("_p"), F.col("blob_oid").alias("_pb"))
    has, had = F.col("_c").isNotNull(), F.col("_p").isNotNull()
    files = c.join(p, F.col("_c") == F.col("_p"), "full_outer").agg(
        F.count_if(has).alias("admitted"), F.count_if(has & ~had).alias("added"), F.count_if(has & had & (F.col("_cb") != F.col("_pb"))).alias("modified"), F.count_if(had & ~has).alias("deleted"), F.count_if(has & had & (F.col("_cb") == F.col("_pb"))).alias("unchanged")
    )
    now, then = (x.select("slice").distinct() for x in (current, previous))
    slices = now.join(reused.select("slice", F.lit(True).alias("_r")), "slice", "left").agg(F.count("*").alias("slices"), F.count("_r").alias("slices_reused"))
    gone = then.join(now, "slice", "left_anti").agg(F.count("*").alias("slices_removed"))
    return files.crossJoin(F.broadcast(slices)).crossJoin(F.broadcast(gone)).withColumn("slices_built", F.col("slices") - F.col("slices_reused"))  # one row each


def observed(rows: DataFrame) -> DataFrame:
    """rows(snapshot_head, head_before, head_after, status_before, status_after, target_head) with the outcome of an observation.

    status is the listing of what isn't committed. An unstable source comes before a dirty one, that before another
    head, and a clean match before the target is held against it.
    """
    stable = F.col("head_before").eqNullSafe(F.col("head_after")) & F.col("status_before").eqNullSafe(F.col("status_after")) & F.col("head_after").isNotNull()
    other = F.col("target_head").isNotNull() & (F.col("target_head") != F.col("snapshot_head"))
    outcome = F.when(~stable, "unstable_source").when(F.col("status_before") != "", "dirty_source").when(F.col("snapshot_head") != F.col("head_before"), "head_mismatch").when(other, "target_mismatch").otherwise("clean_head_match")
    return rows.withColumn("outcome", outcome).withColumn("qualified", F.col("outcome") == "clean_head_match")


def slicing_faults(rules: DataFrame, most_slices: int = 128, most_buckets: int = 64) -> DataFrame:
    """(ord, fault) of slice rules(ord, prefix, name, buckets): bad or repeated prefixes and names, too many slices."""
    from tessera.functions.text import safe_path

    seen = lambda c: F.count("*").over(Window.partitionBy(c)) > 1
    faults = F.array_compact(
        F.array(
            F.when(~F.col("prefix").endswith("/") | ~safe_path(F.regexp_replace("prefix", "/$", "")), "prefix"),
            F.when(F.col("same_prefix"), "repeated_prefix"),
            F.when(~F.col("name").rlike("^[a-z0-9][a-z0-9_-]{0,31}$") | (F.col("name") == "rest"), "name"),
            F.when(F.col("same_name"), "repeated_name"),
            F.when(~F.col("buckets").between(1, most_buckets), "buckets"),
        )
    )
    each = rules.withColumn("same_prefix", seen("prefix")).withColumn("same_name", seen("name")).select("ord", F.explode(faults).alias("fault"))
    total = rules.agg((F.sum(F.coalesce("buckets", F.lit(1))) + 1).alias("n")).where(F.col("n") > most_slices)
    return each.unionByName(total.select(F.lit(-1).cast("int").alias("ord"), F.lit("slices").alias("fault")))


def set_faults(files: DataFrame, states: DataFrame) -> DataFrame:
    """(slice, fault) of states(slice, n_files, n_bytes): records that don't agree with files(slice, bytes), or lack one side."""
    sums = files.groupBy(F.col("slice").alias("_s")).agg(F.count("*").alias("_n"), F.sum("bytes").alias("_b"))
    fault = F.when(F.col("_s").isNull(), "no_files").when(F.col("slice").isNull(), "no_state").when((F.col("n_files") != F.col("_n")) | (F.col("n_bytes") != F.col("_b")), "other_counts")
    return states.join(sums, F.col("slice") == F.col("_s"), "full_outer").select(F.coalesce("slice", "_s").alias("slice"), fault.alias("fault")).where("fault is not null")
