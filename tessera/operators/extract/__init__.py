"""Extraction: files to nodes, edges and references, one file at a time, and their assembly to one graph.

Extractors are pure functions of a path and a text, so any executor can do any file; only assembly shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numbers import ascii_json
from tessera.operators.admission import MARKERS
from tessera.operators.extract import code, manifests, markdown, shell
from tessera.operators.extract.records import Limit, Limits, Records
from tessera.operators.resolve import resolve

#: By file name, by ending, and by folder and ending, in the order in which they are looked at.
BY_NAME: dict[str, Callable[[str, Records], None]] = {"package.json": manifests.package_json, "pyproject.toml": manifests.pyproject, "go.mod": manifests.go_mod}
BY_ENDING: dict[str, Callable[[str, Records], None]] = {
    ".py": code.python, ".md": markdown.markdown, ".markdown": markdown.markdown, ".sh": shell.shell, ".bash": shell.shell, ".zsh": shell.shell, ".go": code.go, ".swift": code.swift,
    **dict.fromkeys(code.JS_EXTENSIONS, code.javascript),
}
#: The first family of extractors reads Python, and links of Markdown, alone.
FIRST_FAMILY: dict[str, Callable[[str, Records], None]] = {".py": code.python, ".md": markdown.markdown_links, ".markdown": markdown.markdown_links}
VERSION = "2"

_NODE = pa.struct([("id", pa.string()), ("type", pa.string()), ("label", pa.string())])
_EDGE = pa.struct([("source", pa.string()), ("target", pa.string()), ("type", pa.string())])
_REF = pa.struct([("kind", pa.string()), ("target", pa.string()), ("line", pa.int32()), ("candidates", pa.list_(pa.string())), ("resolution", pa.string())])
_SCHEMA = "path string, outcome string, reason string, nodes array<struct<id: string, type: string, label: string>>, edges array<struct<source: string, target: string, type: string>>, refs array<struct<kind: string, target: string, line: int, candidates: array<string>, resolution: string>>"


def register(ending: str, extractor: Callable[[str, Records], None]) -> None:
    """Adds an extractor for files with an ending."""
    BY_ENDING[ending] = extractor


def extractor_of(path: str, family: str = VERSION) -> Callable[[str, Records], None] | None:
    name = path.rsplit("/", 1)[-1]
    ending = "." + name.rsplit(".", 1)[1].lower() if "." in name else ""
    if family == "1":
        return FIRST_FAMILY.get(ending)
    if name in BY_NAME:
        return BY_NAME[name]
    if name in ("action.yml", "action.yaml") or name.endswith((".yml", ".yaml")) and path.split("/")[-3:-1] == [".github", "workflows"]:
        return manifests.workflow
    return BY_ENDING.get(ending)


def fragment(path: str, content: bytes, limits: Limits = Limits(), family: str = VERSION) -> dict:
    """The records of one file. A file that can't be read for any reason has no records but its own node."""
    unknown = lambda reason: {"outcome": "unknown", "reason": reason, "nodes": [], "edges": [], "refs": []}
    extract = extractor_of(path, family)
    if extract is None:
        return unknown("unsupported")
    try:
        text = content.decode("utf-8").removeprefix("\ufeff")
        if any(m in text for m in MARKERS):
            return unknown("forbidden_marker")
        out = Records(path, limits)
        extract(text, out)
        return out.fragment()
    except Limit:
        return unknown("limit")
    except Exception as e:  # whatever a parser raises, the file alone is unknown
        return unknown(type(e).__name__)


def fragments(files: DataFrame, limits: Limits = Limits(), family: str = VERSION) -> DataFrame:
    """(path, outcome, reason, nodes, edges, refs) of files(path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                found = [fragment(p, bytes(c or b""), limits, family) for p, c in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                kinds = (pa.string(), pa.string(), pa.list_(_NODE), pa.list_(_EDGE), pa.list_(_REF))
                names = ("outcome", "reason", "nodes", "edges", "refs")
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([f[n] for f in found], k) for n, k in zip(names, kinds, strict=True))], names=["path", *names])

    return files.select("path", "content").mapInArrow(run, _SCHEMA)


def records(found: DataFrame) -> DataFrame:
    """Fragments as flat rows: (path, record, kind, label, target)."""
    kinds = (
        ("node", F.explode("nodes"), F.col("x.type"), F.col("x.label"), F.lit(None).cast("string")),
        ("edge", F.explode("edges"), F.col("x.type"), F.col("x.source"), F.col("x.target")),
        ("reference", F.explode("refs"), F.col("x.kind"), F.col("x.target"), F.array_join("x.candidates", " ")),
    )
    out = found.where("outcome <> 'structural'").select("path", F.lit("unknown").alias("record"), F.col("reason").alias("kind"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("target"))
    for name, many, kind, label, target in kinds:
        out = out.unionByName(found.select("path", many.alias("x")).select("path", F.lit(name).alias("record"), kind.alias("kind"), label.alias("label"), target.alias("target")))
    return out


def references(found: DataFrame) -> DataFrame:
    return found.select(F.col("path").alias("source_file"), F.explode("refs").alias("x")).select("source_file", "x.kind", "x.target", "x.line", "x.candidates", "x.resolution")


def assemble(found: DataFrame, index: DataFrame) -> DataFrame:
    """(source_file, kind, target, line, target_path, target_slice, outcome) of all references over index(path, slice)."""
    return resolve(references(found), index).select("source_file", "kind", "target", "line", "target_path", "target_slice", "outcome")


def file_name(path: str) -> Column:
    """records.file_id of a column of paths: the digest of ["path","file","path"] as ASCII JSON and a line end."""
    quoted = ascii_json(F.col(path))
    return F.concat(F.lit("structural:"), F.sha2(F.concat(F.lit("["), quoted, F.lit(',"file",'), quoted, F.lit("]\n")).cast("binary"), 256))


def graph(found: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes(id, type, label, source_file) and links(source, target, type, source_file): own edges, and resolved references."""
    nodes = found.select(F.col("path").alias("source_file"), F.explode("nodes").alias("x")).select("x.id", "x.type", "x.label", "source_file")
    own = found.select(F.col("path").alias("source_file"), F.explode("edges").alias("x")).select("x.source", "x.target", "x.type", "source_file")
    resolved = assemble(found, index).where("outcome = 'link'").select(file_name("source_file").alias("source"), file_name("target_path").alias("target"), F.col("kind").alias("type"), "source_file")
    return nodes, own.unionByName(resolved).dropDuplicates(["source_file", "source", "target", "type"])
