"""Which files are taken: ordered rules, markers, size and mode limits, slices and holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import glob_match, hash_bucket, safe_path, suffix

# Texts whose presence marks a canary file.
MARKERS = ("BEGIN PRIVATE KEY", "BEGIN RSA PRIVATE KEY", "AWS_ACCESS_KEY_ID=", "api_key =")
# Globs that are always denied.
GLOBAL_DENY = (
    ".git/*", "*/.git/*", "node_modules/*", "*/node_modules/*",
    ".venv/*", "*/.venv/*", "venv/*", "*/venv/*", "__pycache__/*", "*/__pycache__/*",
    ".ruff_cache/*", ".next/*", "dist/*", "build/*", "target/*",
    ".codex/*", ".omp/*", ".opencode/*", ".agents/*", ".goal-state/*", ".beads/*",
    "data/pg17/*", "*/data/pg17/*",
    "*.png", "*.jpg", "*.jpeg", "*.gif", "*.webp", "*.ico", "*.woff", "*.woff2", "*.ttf",
    "*.mp4", "*.mov", "*.mp3", "*.wav", "*.zip", "*.tar", "*.gz", "*.7z",
    "*.pdf", "*.sqlite", "*.sqlite-*", "*.db", "*.duckdb", "*.parquet", "*.tsv",
    ".env*", "*.pem", "*.key", "*.p12", "*.pfx", "id_rsa*", "*credential*", "*secret*",
    "package-lock.json", "*.lock", "uv.lock", "*.jsonl", "*.seq",
)


def last_match(path: Column, rules: Sequence[tuple[str, str]], deny: Sequence[str] = GLOBAL_DENY) -> Column:
    """(verdict, rule): a deny glob wins, then the last rule (verb, glob) that matches, then include."""
    rule = F.lit("default-include")
    verdict = F.lit("include")
    for verb, glob in rules:
        hit = glob_match(path, glob)
        verdict, rule = F.when(hit, F.lit(verb)).otherwise(verdict), F.when(hit, F.lit(f"{verb}:{glob}")).otherwise(rule)
    for glob in reversed(deny):
        hit = glob_match(path, glob)
        verdict, rule = F.when(hit, F.lit("exclude")).otherwise(verdict), F.when(hit, F.lit(f"global-deny:{glob}")).otherwise(rule)
    return F.struct(verdict.alias("verdict"), rule.alias("rule"))


def parse_rules(lines: DataFrame) -> DataFrame:
    """(ord, verb, glob) of the lines (ord, value) of a rule file; other lines, and those that begin with #, are left out."""
    rows = lines.select("ord", F.trim("value").alias("rule")).where(F.col("rule").rlike("^(include|exclude) "))
    return rows.select("ord", F.substring_index("rule", " ", 1).alias("verb"), F.regexp_replace("rule", "^[a-z]+ ", "").alias("glob"))


def folders(path: Column) -> Column:
    """The folders above a path, from the top."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def pruned(path: Column, rules: Sequence[tuple[str, str]], deny: Sequence[str] = GLOBAL_DENY) -> Column:
    """Whether a folder above the path matches an exclude rule, or with a slash a deny glob; later includes don't help."""

    def out(folder: Column) -> Column:
        hit = F.lit(False)
        for verb, glob in rules:
            if verb == "exclude":
                hit = hit | glob_match(folder, glob)
        for glob in deny:
            hit = hit | glob_match(F.concat(folder, F.lit("/")), glob)
        return hit

    return path.contains("/") & F.exists(folders(path), out)


def first_marker(text: Column, size: Column, markers: Sequence[str] = MARKERS, most_bytes: int = 1 << 20, chars: int = 262_144) -> Column:
    """The first marker, in the order of the list, in the first characters of a small file; else null."""
    head = F.substring(text, 1, chars)
    found = F.lit(None).cast("string")
    for m in reversed(markers):
        found = F.when(head.contains(m), F.lit(m)).otherwise(found)
    return F.when(size <= most_bytes, found)


def git_admission(path: Column, mode: Column, size: Column, includes: Sequence[str], deny: Sequence[str], most_bytes: int, kind: Column | None = None) -> Column:
    """admitted, not_selected, denied or the reason why a selected entry isn't supported; only entries of the kind blob are."""
    any_of = lambda globs: F.coalesce(*[F.when(glob_match(path, g), F.lit(True)) for g in globs], F.lit(False)) if globs else F.lit(False)
    return (
        F.when(any_of(deny), "denied")
        .when(~any_of(includes), "not_selected")
        .when(mode == "120000", "symlink")
        .when(mode == "160000", "gitlink")
        .when(~mode.isin("100644", "100755") | (F.lit(False) if kind is None else kind != "blob"), "unsupported_mode")
        .when(~safe_path(path), "unsafe_path")
        .when(size > most_bytes, "file_byte_limit")
        .otherwise("admitted")
    )


def conversion(attributes: Column) -> Column:
    """The attribute by which a checkout would change a file, in fixed order: filter, eol, encoding, ident; null for none."""
    named = lambda k: F.when(~attributes[k].isin("unspecified", "unset"), F.lit(f"attribute:{k}"))
    return F.coalesce(named("filter"), F.when(attributes["eol"] == "crlf", "attribute:eol=crlf"), named("working-tree-encoding"), named("ident"))


def link_verdicts(entries: DataFrame, root: str, rules: Sequence[tuple[str, str]], deny: Sequence[str] = GLOBAL_DENY) -> DataFrame:
    """(path, rule, outside) of the symbolic links among entries(path, kind, resolved), of the kinds link and folder_link.

    No link is followed. One that an exclude rule matches is left out by that rule (of several, the last), a folder link
    by a deny glob before that. Of the others, links that lead out of the root are outside: a check with one has failed.
    """
    folder = F.col("kind") == "folder_link"
    denied, excluded = F.lit(None).cast("string"), F.lit(None).cast("string")
    for glob in reversed(deny):
        denied = F.when(glob_match(F.concat("path", F.lit("/")), glob), F.lit(f"global-deny:{glob}")).otherwise(denied)
    for verb, glob in rules:
        if verb == "exclude":
            excluded = F.when(glob_match(F.col("path"), glob), F.lit(f"policy-exclude:{glob}")).otherwise(excluded)
    by_rule = F.coalesce(F.when(folder, denied), excluded)
    out = by_rule.isNull() & ~F.col("resolved").startswith(root.rstrip("/") + "/")
    rule = F.coalesce(by_rule, F.when(folder & out, "outside-root-symlink-dir").otherwise("symlink-not-followed"))
    return entries.where(F.col("kind").isin("link", "folder_link")).select("path", rule.alias("rule"), out.alias("outside"))


def slice_of(path: Column, rules: Sequence[tuple[str, str, int | None]]) -> Column:
    """The slice of a path by the first rule (prefix, name, buckets) whose prefix it has; else rest.

    A rule with buckets has slices name.00, name.01 and so on, by the hash of the path.
    """
    out = F.lit("rest")
    for prefix, name, buckets in reversed(list(rules)):
        own = F.format_string(f"{name}.%02d", hash_bucket(path, buckets)) if buckets else F.lit(name)
        out = F.when(path.startswith(prefix), own).otherwise(out)
    return out


def slice_holds(files: DataFrame, most_files: int, most_bytes: int) -> DataFrame:
    """(slice, n_files, n_bytes, bounds): bounds names the limits that a slice is over; such a slice is held."""
    sums = files.groupBy("slice").agg(F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes"))
    bounds = F.array_join(F.array_compact(F.array(F.when(F.col("n_files") > most_files, "files"), F.when(F.col("n_bytes") > most_bytes, "bytes"))), ",")
    return sums.select("slice", "n_files", "n_bytes", bounds.alias("bounds"))


def by_suffix(files: DataFrame) -> DataFrame:
    return files.groupBy(suffix(F.col("path")).alias("suffix")).agg(F.count("*").alias("n"))


def path_lengths(files: DataFrame) -> DataFrame:
    """(n, longest, p99): the longest path in bytes, and the nearest-rank 99th percentile."""
    size = F.octet_length("path")
    return files.agg(F.count("*").alias("n"), F.max(size).alias("longest"), F.expr("percentile_disc(0.99) within group (order by octet_length(path))").cast("int").alias("p99"))


def overlapping(paths: DataFrame) -> DataFrame:
    """Paths of a set that are repeated, or that are a folder of another one."""
    above = paths.select(F.explode(F.slice(folders(F.col("path")), 1, F.size(F.split("path", "/")) - 1)).alias("folder")).distinct()
    inside = paths.join(above, paths["path"] == above["folder"], "left_semi").select("path")
    return paths.groupBy("path").count().where("count > 1").select("path").unionByName(inside).distinct()


def target_class(target: Column) -> Column:
    """How a validator classes a link target that is neither a node nor a file. A bare name is taken as a path below the
    root, so only the folder above the root itself counts as an outside name."""
    return F.when(target == "..", "external_bare_import").otherwise("conservative_internal_looking")
