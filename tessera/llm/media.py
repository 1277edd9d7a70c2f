"""Interleaved document sequences with media columns.

Pages are parsed to ordered items: stretches of text, and references to media with their captions. Media lie in a
table of their own, as grey images of 8-bit samples, under the SHA-256 of their samples; references find them by
joining on that digest. Positions and captions stay with their items all the way.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

WIDTH = 192
ITEM = "struct<position: int, kind: string, text: string, digest: string, caption: string, n_bytes: bigint>"
_HIDDEN = frozenset({"script", "style", "template", "noscript", "title"})
_NESTED = frozenset({"noscript", "template"})  # these hold tags of their own kind, the other hidden ones text alone
_BREAKS = frozenset({"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "tr", "td", "table", "figure", "br", "nav", "body", "head", "html", "blockquote", "pre"})


_MEDIA = ("img", "audio", "video", "source")
_HIDING = re.compile(rf"<(/?)({'|'.join(sorted(_HIDDEN))})(?=[\s/>])[^>]*>", re.I)
_SHOWING = re.compile(rf"</?(?:{'|'.join(sorted({*_BREAKS, *_MEDIA, 'figcaption'}, key=lambda t: (-len(t), t)))})(?=[\s/>])", re.I)


def _closed(html: str) -> str:
    """html with an end for each hidden tag that has none: before the next tag that breaks the text or brings media. Where no
    such tag follows, the hidden tag itself goes, and what comes after it is text."""
    open_: dict[str, list[re.Match]] = {t: [] for t in _HIDDEN}
    for m in _HIDING.finditer(html):
        own = open_[m[2].lower()]
        if not m[1]:
            own.append(m)
        elif m[2].lower() in _NESTED:
            del own[-1:]
        else:
            own.clear()
    edits = []
    for m in (m for own in open_.values() for m in own):
        shown = _SHOWING.search(html, m.end())
        # of several ends at one place, the tag that was opened last ends first
        edits.append((shown.start(), -m.start(), shown.start(), f"</{m[2]}>") if shown else (m.start(), 0, m.end(), ""))
    out, upto = [], 0
    for at, _, to, end in sorted(edits):
        out += [html[upto:at], end]
        upto = to
    return "".join([*out, html[upto:]])


class _Items(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.hidden: list[str] = []
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            self.items.append({"position": len(self.items), "kind": "text", "text": text, "digest": None, "caption": None, "n_bytes": None})

    def handle_starttag(self, tag, attrs):
        known = dict(attrs)
        if tag in _HIDDEN:
            self.hidden.append(tag)
        elif tag in _MEDIA and known.get("src"):
            self.flush()
            src, size = known["src"], known.get("data-bytes") or ""
            self.items.append({"position": len(self.items), "kind": "media", "text": None, "digest": src.removeprefix("sha256:"), "caption": known.get("alt"), "n_bytes": int(size) if size.isdecimal() else None})
        elif tag == "figcaption":
            self.flush()
            self.caption = []
        elif tag in _BREAKS:
            self.flush()

    def handle_endtag(self, tag):
        if tag in _HIDDEN:
            if tag in _NESTED:
                self.hidden = self.hidden[:-1] if self.hidden[-1:] == [tag] else self.hidden
            else:
                self.hidden = [t for t in self.hidden if t != tag]
        elif tag == "figcaption" and self.caption is not None:
            text, self.caption = " ".join("".join(self.caption).split()), None
            if self.items and self.items[-1]["kind"] == "media":
                self.items[-1]["caption"] = text or self.items[-1]["caption"]
            elif text:
                self.words.append(text)
                self.flush()
        elif tag in _BREAKS:
            self.flush()

    def handle_data(self, data):
        if not self.hidden:
            (self.words if self.caption is None else self.caption).append(data)


def parse(html: str | None) -> list[dict]:
    """The ordered items of a page. A figcaption belongs to the media item before it, else it is text. What titles, scripts,
    styles, templates and noscript tags hold is left out; one that is not closed ends before the next tag that breaks the
    text or brings media, or, if there is none, hides nothing."""
    reader = _Items()
    reader.feed(_closed(html or ""))
    reader.close()
    if reader.caption:
        reader.words += reader.caption
    reader.flush()
    return reader.items


def sequences(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """(id, items) of pages(id, html). Null or empty html, or one without text or media: no items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string()), ("n_bytes", pa.int64())]))
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([parse(h) for h in part.column(1).to_pylist()], kind)], names=[id_column, "items"])

    rows = common.slim(pages, id_column, "html")
    return rows.mapInArrow(run, f"{id_column} {rows.schema[id_column].dataType.simpleString()}, items array<{ITEM}>")


def payload(text: Column) -> Column:
    """UTF-8 of a text (null: empty) with spaces up to a positive multiple of the width."""
    body = F.coalesce(text, F.lit("")).cast("binary")
    n = F.octet_length(body)
    rows = F.greatest(F.lit(1), F.ceil(n / WIDTH).cast("int"))
    return F.concat(body, F.repeat(F.lit(" "), rows * WIDTH - n).cast("binary"))


def image(samples: Column) -> Column:
    """A binary grey map (PGM): a header of width and height, then the samples as they are."""
    return F.concat(F.concat(F.lit(f"P5\n{WIDTH} "), (F.octet_length(samples) / WIDTH).cast("long").cast("string"), F.lit("\n255\n")).cast("binary"), samples)


def store(media: DataFrame, path: str) -> None:
    """Writes media(digest, media) to the table at path. Nothing is shuffled; a digest may be stored more than once."""
    media.select("digest", "media").write.option("compression", "zstd").parquet(path)


def samples_of(stored: bytes | memoryview) -> np.ndarray:
    """The samples of a stored grey map, rows by width."""
    stored = bytes(stored)
    kind, size, depth, _ = stored[:64].split(b"\n", 3)
    width, height = map(int, size.split())
    if kind != b"P5" or depth != b"255":
        raise ValueError("not an 8-bit grey map")
    return np.frombuffer(stored, np.uint8, width * height, len(kind) + len(size) + len(depth) + 3).reshape(height, width)


def feature(samples: np.ndarray) -> str:
    """Size, mean, deviation, distinct values and mean step between neighbours of an image, as text."""
    counts = np.bincount(samples.reshape(-1), minlength=256)
    n, v = samples.size, np.arange(256)
    mean = (counts * v).sum() / n
    spread = np.sqrt(max(0.0, (counts * v * v).sum() / n - mean * mean))
    step = np.abs(np.diff(samples.astype(np.int16), axis=1)).sum(dtype=np.int64) / max(1, samples.shape[0] * (samples.shape[1] - 1))
    return f"{samples.shape[1]}x{samples.shape[0]} mean={mean:.3f} std={spread:.3f} values={np.count_nonzero(counts)} step={step:.3f}"


DESCRIBED = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for digest, stored in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            view = stored.as_buffer()
            s = samples_of(view)
            flat = s.reshape(-1)
            rows.append((digest, s.size, hashlib.sha256(flat).hexdigest(), zlib.crc32(flat[-16:]), view.size, hashlib.sha256(view).hexdigest(), feature(s)))
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def described(spark: SparkSession, path: str) -> DataFrame:
    """One row for each digest in a media table, worked out from the stored bytes."""
    rows = spark.read.schema("digest string, media binary").parquet(path).mapInArrow(_describe, DESCRIBED)
    rest = [c for c in rows.columns if c != "digest"]
    return rows.groupBy("digest").agg(*[F.min(c).alias(c) for c in rest])


def resolve(items: DataFrame, media: DataFrame, id_column: str = "page_id") -> DataFrame:
    """items(id, items) with one row for each item, and the columns of its media (null for text, and if not stored)."""
    flat = items.select(id_column, F.posexplode_outer("items").alias("_at", "item")).select(id_column, "item.*")
    return flat.join(media.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"), "left").drop("_digest")


def document_pages(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each row of docs(doc_id, text) as a page that refers to the text's bytes as media, and that media.

    Null text counts as empty: one row of 192 spaces. Equal payloads have one digest. Repeated rows and null ids
    stay. Other columns of docs are not read.
    """
    rows = common.slim(docs, "doc_id", "text").withColumn("payload", payload(F.col("text"))).withColumn("digest", F.sha2("payload", 256))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    html = F.concat(F.lit("<article><h1>Document "), name, F.lit('</h1><figure><img src="sha256:'), F.col("digest"), F.lit('" data-bytes="'), F.octet_length(F.coalesce("text", F.lit(""))).cast("string"), F.lit('"><figcaption>The bytes of the text, '), F.octet_length(F.coalesce("text", F.lit(""))).cast("string"), F.lit(" of them</figcaption></figure></article>"))
    return rows.select("doc_id", html.alias("html")), rows.select("digest", image(F.col("payload")).alias("media"))


def media_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and what the stored media of each row's text is like; see document_pages for odd rows."""
    spark = docs.sparkSession
    pages, media = document_pages(docs)
    path = common.scratch(spark, "media")
    store(media, path)
    # a table of its own, so that the join's shuffle can be split where many documents have one digest
    media_rows = common.materialise(described(spark, path), "described")
    found = resolve(sequences(pages, "doc_id"), media_rows, "doc_id").where("kind = 'media'")
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
