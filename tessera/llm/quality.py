"""Quality rules: lines that many documents of a host share. DataFrame operations only.

Lines are normalised (lower case, single spaces) and hashed. The distinct documents of each host that have a line are
counted, lines above the host's limit are removed, and a document that too few words are left of is rejected, as is
one that fails the base rules on its own words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class QualityRules:
    #: A line may be in this many documents of its host, however large the host is.
    line_docs: int = 10
    #: A document is depleted if less than this share of its words is left.
    words_left: float = 0.3
    #: Frequent lines that may be broadcast (16 bytes each); more are joined by a shuffle.
    broadcast_lines: int = 1_000_000


def _once(value: Column, use) -> Column:
    """use(value), with value worked out one time only."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), lambda w: w != "")


def _covered(s: Column) -> Column:
    """Words in windows that occur twice or more: s has (window hash, place), sorted."""
    again = F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]))
    places = F.sort_array(F.filter(again, lambda i: i.isNotNull()))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(places, start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])


def repeat_words(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more, the first time included."""

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        several = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _once(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), _covered)).otherwise(F.lit(0).cast("long"))
        return F.when(F.size(w) >= 4, _once(hashes, several)).otherwise(F.lit(0).cast("long"))

    return _once(words, of)


def measured(docs: DataFrame) -> DataFrame:
    """row, doc_id, source, the base columns, and hash and number of words of each line that has a word."""
    text = F.coalesce("text", F.lit(""))
    length = lambda x: F.length(x).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    plain = F.transform(F.split(F.lower(F.translate(text, "\t\x0b\x0c\r", "    ")), "\n"), lambda x: F.trim(F.regexp_replace(x, " +", " ")))
    kept = F.filter(plain, lambda x: x != "")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(common.WORD)).cast("long").alias("n_words"),
        length(F.translate(text, BLANKS, "")).alias("word_chars"),
        (length(text) - length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        _once(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        repeat_words(words_of(text)).alias("n_repeat_words"),
        F.transform(kept, lambda x: F.struct(F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("n"))).alias("lines"),
    )


def frequent_lines(rows: DataFrame, p: QualityRules = QualityRules()) -> DataFrame:
    """(source, h) of the lines that more documents of their host have than its limit."""
    lines = rows.select("source", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    return lines.groupBy("source", "h").agg(F.count("*").alias("in_docs")).where(F.col("in_docs") > p.line_docs).select("source", "h")


def quality(docs: DataFrame, p: QualityRules = QualityRules()) -> DataFrame:
    """The base columns, base_failed, removed_words and kept of each row of docs(doc_id, source, text); source is the host.

    Null or empty text: no words, so the base rules fail. Each row counts as a document, repeated rows too, and null
    ids or hosts are kept (null is a host). An empty table gives an empty one. Other columns of docs are not read.
    """
    rows = common.materialise(measured(common.slim(docs, "doc_id", "source", "text")), "lines")
    lines = common.materialise(frequent_lines(rows, p), "frequent").select(F.col("source").alias("s"), F.col("h").alias("fh"))
    held = F.broadcast(lines) if lines.count() <= p.broadcast_lines else lines
    hits = rows.select("row", "source", F.explode("lines").alias("x")).join(held, (F.col("x.h") == F.col("fh")) & F.col("source").eqNullSafe(F.col("s")))
    removed = hits.groupBy("row").agg(F.sum("x.n").cast("long").alias("removed"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    return (
        rows.drop("lines", "source")
        .join(removed.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
        .withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (left >= p.words_left * F.col("n_words"))).alias("kept"), "removed_words")
    )


QUALITY_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), base AS (
  SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM base)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + d) AS n FROM again, (VALUES (0), (1), (2)) AS v(d) GROUP BY r
), lines AS (
  SELECT r, source, line, trim(regexp_replace(lower(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    ')), ' +', ' ', 'g')) AS norm
  FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), frequent AS (
  SELECT source, norm FROM lines GROUP BY source, norm HAVING count(DISTINCT r) > 10
), removed AS (
  SELECT r, sum(len(l.norm) - len(replace(l.norm, ' ', '')) + 1) AS n
  FROM lines l JOIN frequent f ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source GROUP BY r
), rows AS (
  SELECT b.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(m.n, 0) AS BIGINT) AS removed_words
  FROM base b LEFT JOIN dups d USING (r) LEFT JOIN covered c USING (r) LEFT JOIN removed m USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= 0.3::DOUBLE * n_words AS kept,
       removed_words
FROM rows
"""
