"""Catalogues of archives, archive members, rule files and manifests, as tables."""

from __future__ import annotations

import hashlib
import io
import itertools
import json
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import json_stream
from tessera.sources.scratch import materialise

#: Bytes of an archive that is read as a row.
WHOLE_BYTES = 1 << 30
MAX_MEMBERS, MAX_MEMBER_BYTES, MAX_ARCHIVE_BYTES, MAX_CATALOG_BYTES = 100_000, 1 << 30, 8 << 30, 16 << 20
REPOSITORY, HEAD, ARCHIVE = r"^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+$", r"^([0-9a-f]{40}|[0-9a-f]{64})$", r"^[A-Za-z0-9][A-Za-z0-9_.-]*\.tar\.gz$"


def strict_json(raw: bytes, most_items: int = 1_000_000, most_depth: int = 48) -> object:
    """JSON without repeated keys and without numbers that are not finite, of bounded size and depth."""
    items = 0

    def pairs(found: list[tuple[str, object]]) -> dict:
        if len({k for k, _ in found}) != len(found):
            raise ValueError("repeated key")
        return dict(found)

    def refuse(text: str) -> None:
        raise ValueError(f"not a number of JSON: {text}")

    data = json.loads(raw, object_pairs_hook=pairs, parse_constant=refuse)
    level = [(data, 1)]
    while level:
        value, depth = level.pop()
        items += 1
        if items > most_items or depth > most_depth:
            raise ValueError("too many items" if items > most_items else "too deep")
        level += [(v, depth + 1) for v in (value.values() if isinstance(value, dict) else value if isinstance(value, list) else ())]
    return data


def load_catalog(spark: SparkSession, path: str, sha256: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, empty) of a catalogue file, checked: entries(repository, head, slice, archive, sha256, bytes)."""
    row = spark.read.format("binaryFile").load(path).first()
    if row["length"] > MAX_CATALOG_BYTES or sha256 and hashlib.sha256(row["content"]).hexdigest() != sha256:
        raise ValueError("catalogue is too large, or isn't the expected one")
    data = strict_json(bytes(row["content"]))
    version = {"catalog/v1": 1, "catalog/v2": 2}.get(str(data.get("schema", "")).rsplit("-", 1)[-1])
    if data.get("status") != "complete" or version is None:
        raise ValueError("catalogue is not complete, or of an unknown version")
    entries = [(e["source"]["repository"], e["source"]["head"], e["source"].get("slice"), e["archive"], e["sha256"], e["bytes"]) for e in data["archives"]]
    empty = [(e["repository"], e.get("status", "empty")) for e in data.get("empty_repositories", [])]
    faults = []
    for repository, head, part, archive, digest, size in entries:
        if not (re.match(REPOSITORY, repository) and re.match(HEAD, head) and re.match(ARCHIVE, archive) and re.match(r"^[0-9a-f]{64}$", digest) and type(size) is int and 0 < size <= MAX_ARCHIVE_BYTES):
            faults.append(f"bad entry {archive}")
        if part is not None and version < 2:
            faults.append("a slice needs version 2")
    sliced, whole = {e[0] for e in entries if e[2] is not None}, [e[0] for e in entries if e[2] is None]
    faults += ["repository is both sliced and whole"] * bool(sliced & set(whole))
    faults += ["entry is repeated"] * (len({(e[0], e[2]) for e in entries}) != len(entries) or len({e[3] for e in entries}) != len(entries))
    faults += ["empty repository has an archive"] * bool({e[0] for e in entries} & {e[0] for e in empty})
    if faults:
        raise ValueError("; ".join(faults[:5]))
    return spark.createDataFrame(entries, "repository string, head string, slice string, archive string, sha256 string, bytes bigint"), spark.createDataFrame(empty, "repository string, status string")


def select_one(entries: DataFrame, repository: str, part: str | None = None) -> DataFrame:
    found = entries.where((F.col("repository") == repository) & F.col("slice").eqNullSafe(F.lit(part)))
    if len(found.take(2)) != 1:
        raise ValueError("repository has no selected graph")
    return found


class _Stream:
    """A file that comes in lines."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.held = lines, b""

    def read(self, n: int) -> bytes:
        parts, size = [self.held], len(self.held)
        while size < n and (line := next(self.lines, None)) is not None:
            parts.append(line)
            size += len(line)
        whole = b"".join(parts)
        self.held = whole[n:]
        return whole[:n]


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((p, v) for b in batches for p, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    for path, own in itertools.groupby(rows, key=lambda r: r[0]):
        total, seen = 0, set()
        lines = (b"\n" + v if k else v for k, (_, v) in enumerate(own))
        with tarfile.open(fileobj=_Stream(lines), mode="r|") as tar:
            for m in tar:
                total += m.size
                if not m.isreg() or m.name in seen or m.name.startswith("/") or ".." in m.name.split("/") or len(seen) >= MAX_MEMBERS or m.size > MAX_MEMBER_BYTES or total > MAX_ARCHIVE_BYTES:
                    raise ValueError(f"unsafe member {m.name} in {path}")
                seen.add(m.name)
                raw = tar.extractfile(m).read()
                yield pa.RecordBatch.from_arrays([pa.array([path.rsplit("/", 1)[-1]]), pa.array([m.name]), pa.array([m.size], pa.int64()), pa.array([hashlib.sha256(raw).hexdigest()]), pa.array([raw], pa.binary())], names=["archive", "name", "bytes", "sha256", "content"])


def members(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(archive, name, bytes, sha256, content) of the members of tar.gz archives.

    An archive is unpacked as a stream of its lines, by one task, which holds one member at a time.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.tar.gz").text(paths)
    return lines.select("_metadata.file_path", F.col("value").cast("binary")).mapInArrow(_unpacked, "archive string, name string, bytes bigint, sha256 string, content binary")


def member_faults(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """(name, fault): members that a manifest(name, sha256) lacks, or has otherwise, and listed ones that aren't there."""
    m = manifest.select(F.col("name").alias("_n"), F.col("sha256").alias("_s"))
    fault = F.when(F.col("_n").isNull(), "unlisted").when(F.col("name").isNull(), "missing").when(F.col("sha256") != F.col("_s"), "other_content")
    return found.select("name", "sha256").join(m, F.col("name") == F.col("_n"), "full_outer").select(F.coalesce("name", "_n").alias("name"), fault.alias("fault")).where("fault is not null")


def pack(docs: dict[str, bytes]) -> tuple[str, bytes]:
    """A tar.gz that equal documents always give the same bytes of, and its digest. For a graph's small documents."""
    import gzip

    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0) as z, tarfile.open(fileobj=z, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for name in sorted(docs):
            info = tarfile.TarInfo(name)
            info.size, info.mode, info.mtime = len(docs[name]), 0o600, 0
            tar.addfile(info, io.BytesIO(docs[name]))
    return hashlib.sha256(out.getvalue()).hexdigest(), out.getvalue()


#: The documents that an archive of a graph has.
MEMBERS = ("enriched/graph.json", "enriched/validation.json", "inventory.json", "policy.json", "source.json", "request.json")


def pack_graph(spark: SparkSession, folder: str, repository: str, head: str, docs: dict[str, bytes], slice: str | None = None) -> dict:
    """Writes the archive of a graph's six documents, under its digest, to a folder, reads it back, and gives its catalogue entry.

    The graph must be built at the head, and the inventory name files that have a coverage.
    """
    import json

    from tessera.sources import outputs

    if sorted(docs) != sorted(MEMBERS):
        raise ValueError(f"wanted: {', '.join(MEMBERS)}")
    graph, inventory, source = (json.loads(docs[n]) for n in ("enriched/graph.json", "inventory.json", "source.json"))
    if graph.get("built_at_commit") != head or source.get("head") != head or source.get("repository") != repository:
        raise ValueError("the documents are of another source")
    ids = {n["id"] for n in graph["nodes"]}
    if graph.get("directed") is not True or len(ids) != len(graph["nodes"]) or not all(ids.issuperset((e["source"], e["target"])) for e in graph["links"]):
        raise ValueError("not a sound directed graph")
    if not all(f.get("coverage") in ("structural", "enriched", "unknown") and len(f.get("sha256", "")) == 64 for f in inventory):
        raise ValueError("not an inventory")
    listed = {"members": {n: hashlib.sha256(docs[n]).hexdigest() for n in sorted(docs)}}
    digest, raw = pack(docs | {"package.json": json.dumps(listed, sort_keys=True).encode()})
    name = f"{digest}.tar.gz"
    if outputs.read(spark, f"{folder}/{name}") is None:
        outputs.create_only(spark, f"{folder}/{name}", [raw])
    back = outputs.read(spark, f"{folder}/{name}")
    with tarfile.open(fileobj=io.BytesIO(back), mode="r:gz") as tar:
        found = {m.name: hashlib.sha256(tar.extractfile(m).read()).hexdigest() for m in tar.getmembers() if m.name != "package.json"}
    if hashlib.sha256(back).hexdigest() != digest or found != listed["members"]:
        raise ValueError("the archive is not what was written")
    return {"repository": repository, "head": head, "slice": slice, "archive": name, "sha256": digest, "bytes": len(back)}


def merge_catalogs(packages: DataFrame, most: int = 128) -> tuple[str, DataFrame]:
    """Version and entries, in order, of packages(repository, head, slice, archive, sha256, bytes); each place once."""
    if packages.groupBy("repository", "slice").count().where("count > 1").take(1) or packages.groupBy("archive").count().where("count > 1").take(1) or packages.count() > most:
        raise ValueError("packages are repeated or too many")
    version = "v2" if packages.where("slice is not null").take(1) else "v1"
    return version, packages.orderBy("repository", F.col("slice").asc_nulls_first())


def graph_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes, links and hyperedges of node-link JSON documents of any size, with ord and the document (graph) they are of.

    Other attributes are in attrs, as a variant. Documents are read once, here, and stored by element.
    """
    stored = materialise(json_stream.elements(spark, path), "graph_elements")
    text = lambda k: F.try_variant_get("v", f"$.{k}", "string").alias(k)
    of = lambda field: stored.where((F.col("field") == field) & F.col("ord").isNotNull()).select("document", "ord", F.parse_json("value").alias("v"))
    graph = F.col("document").alias("graph")
    nodes = of("nodes").select("ord", *[text(k) for k in ("id", "type", "label", "name", "kind", "source_file")], F.col("v").alias("attrs"), graph)
    links = of("links").select("ord", *[text(k) for k in ("source", "target", "type", "kind", "relation", "source_file")], F.col("v").alias("attrs"), graph)
    own = of("hyperedges")
    inner = stored.where("field = 'graph' and ord is null").select("document", F.posexplode(F.try_variant_get(F.parse_json("value"), "$.hyperedges", "array<variant>")).alias("ord", "v"))
    inner = inner.join(own.select("document").distinct(), "document", "left_anti")
    hyper = own.unionByName(inner).select("ord", F.try_variant_get("v", "$.nodes", "array<string>").alias("nodes"), graph)
    return nodes, links, hyper


def graph_faults(spark: SparkSession, path: str, head: str | None = None) -> DataFrame:
    """(graph, fault) of node-link documents that are not directed, or built at another head than the one that is asked for."""
    values = json_stream.elements(spark, path)
    said = lambda field: F.max(F.when(F.col("field") == field, F.col("value")))
    each = values.groupBy(F.col("document").alias("graph")).agg(said("directed").alias("directed"), said("built_at_commit").alias("head"))
    faults = [F.when(~F.col("directed").eqNullSafe("true"), "not_directed")]
    if head is not None:
        faults.append(F.when(~F.col("head").eqNullSafe(json.dumps(head)), "other_head"))
    return each.select("graph", F.explode(F.array_compact(F.array(*faults))).alias("fault"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, value) of the lines of a small text file."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r?\n")).alias("ord", "value"))


def manifest_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of a tab-separated file; lines that begin with # are comments."""
    return spark.read.csv(path, sep="\t", comment="#", schema=", ".join(f"{c} string" for c in columns))


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256, content) of the files below a folder."""
    root = path.rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(F.regexp_replace("path", r"^[a-z0-9]+:/*" + re.escape(root.lstrip("/")) + "/", "").alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), "content")


def blob_faults(blobs: DataFrame) -> DataFrame:
    """blobs(blob_oid, bytes, content) whose content has another size or id than the object store says; ids of 64 digits are SHA-256."""
    from tessera.functions.numbers import git_blob_id

    content = F.col("content")
    own = F.when(F.length("blob_oid") == 64, git_blob_id(content, 64)).otherwise(git_blob_id(content))
    return blobs.where((F.octet_length("content") != F.col("bytes")) | (own != F.col("blob_oid"))).select("blob_oid")


def staged(wanted: DataFrame, contents: DataFrame) -> DataFrame:
    """wanted(path, sha256) with the content that has that digest, and is what it says."""
    sound = contents.where(F.sha2("content", 256) == F.col("sha256"))
    return wanted.join(sound.select("path", "sha256", "content"), ["path", "sha256"], "left")


def verified_archives(spark: SparkSession, entries: DataFrame, folder: str) -> DataFrame:
    """(archive, fault) of catalogue entries whose archive below a folder is missing, or has another size or digest.

    An archive of over WHOLE_BYTES is digested as a stream, in the driver's JVM, for it can't be a row; a catalogue has
    few entries.
    """
    every = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").load(folder)
    name = F.element_at(F.split("path", "/"), -1).alias("_a")
    f = every.where(F.col("length") <= WHOLE_BYTES).select(name, F.col("length").alias("_n"), F.sha2("content", 256).alias("_s"))
    large = every.where(F.col("length") > WHOLE_BYTES).select("path", "length").collect()
    if large:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        rows = []
        for r in large:
            at = jvm.org.apache.hadoop.fs.Path(r["path"])
            stream = at.getFileSystem(conf).open(at)
            try:
                rows.append((r["path"].rpartition("/")[2], r["length"], jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)))
            finally:
                stream.close()
        f = f.unionByName(spark.createDataFrame(rows, "_a string, _n long, _s string"))
    fault = F.when(F.col("_a").isNull(), "missing").when(F.col("_n") != F.col("bytes"), "other_size").when(F.col("_s") != F.col("sha256"), "other_content")
    return entries.join(f, F.col("archive") == F.col("_a"), "left").select("archive", fault.alias("fault")).where("fault is not null")
