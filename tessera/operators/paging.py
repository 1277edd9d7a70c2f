"""Pages of hits under budgets, keyset cursors, gists, and byte-bounded answers.

Hits are ordered by score, rounded to six places, from the top, and by node_id. A page costs the length of its hits'
JSON. To find where it ends, hits are first cut at the operator's own bound on the number of hits, so the running sums
are over at most that many rows.
"""

from __future__ import annotations

import base64
import binascii
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import ascii_json, canonical, encode_cursor, json_number, page_tokens, score_6

MAX_NODES, MAX_CHARS, MAX_TOKENS = 200, 8192, 25_000


def _key() -> list[Column]:
    return [F.desc(score_6(F.col("score"))), F.asc("node_id")]


def hit_json(hits: DataFrame, spaced: bool = False) -> Column:
    """The JSON of a hit with all its columns, in their order."""
    gap = " " if spaced else ""

    def value(f) -> Column:
        c, kind = F.col(f.name), f.dataType.simpleString()
        shown = json_number(c) if kind in ("double", "float") else ascii_json(c) if kind == "string" else F.lower(c.cast("string"))
        return F.coalesce(shown, F.lit("null"))

    parts = [F.concat(F.lit(f"{canonical(f.name)}:{gap}"), value(f)) for f in hits.schema]
    return F.concat(F.lit("{"), F.concat_ws(f",{gap}", *parts), F.lit("}"))


def after(hits: DataFrame, score: float, node_id: str) -> DataFrame:
    """Hits strictly after a cursor's place."""
    s = score_6(F.col("score"))
    return hits.where((s < score) | ((s == score) & (F.col("node_id") > node_id)))


def page(hits: DataFrame, max_nodes: int = MAX_NODES, max_chars: int = MAX_CHARS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(position, node_id, score, kind, chars) of the first page. A single hit over the budgets is a page still."""
    cost = hit_json(hits.select("score", "node_id", F.coalesce("kind", F.lit("unknown")).alias("kind")))
    top = hits.select("score", "node_id", F.coalesce("kind", F.lit("unknown")).alias("kind")).orderBy(*_key()).limit(max_nodes).withColumn("chars", F.length(cost).cast("long"))
    place = Window.orderBy(*_key())
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    sums = top.withColumn("position", F.row_number().over(place)).withColumn("_c", F.sum("chars").over(upto)).withColumn("_t", F.sum(page_tokens(F.col("chars"))).over(upto))
    return sums.where((F.col("position") == 1) | ((F.col("_c") <= max_chars) & (F.col("_t") <= max_tokens))).select("position", "node_id", score_6(F.col("score")).alias("score"), "kind", "chars")


def decode_cursor(cursor: str) -> tuple[float, str]:
    """The score and id of a cursor; a malformed one is an error."""
    try:
        score, node_id = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
        return float(score), str(node_id)
    except (binascii.Error, TypeError, UnicodeDecodeError) as e:
        raise ValueError("not a cursor") from e


def page_answer(hits: DataFrame, cursor: str | None = None, max_nodes: int = MAX_NODES, max_chars: int = MAX_CHARS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row about the page after a cursor (or the first): n_items, truncated, total_estimate, next_cursor and hint.

    The estimate is of all hits, whatever the cursor: the tokens of their JSON list. No hit: one empty page.
    """
    rest = hits
    if cursor is not None:
        rest = after(hits, *decode_cursor(cursor))
    shown = page(rest, max_nodes, max_chars, max_tokens)
    # a list of n texts has two signs around it, and two between each pair
    everything = hits.agg((F.coalesce(F.sum(F.length(hit_json(hits, spaced=True)) + 2), F.lit(2))).alias("chars"))
    last = shown.agg(F.count("*").alias("n_items"), F.max_by(F.struct("score", "node_id"), "position").alias("last"))
    left = rest.agg(F.count("*").alias("of"))
    one = everything.crossJoin(F.broadcast(last)).crossJoin(F.broadcast(left)).withColumn("truncated", F.col("of") > F.col("n_items"))  # one row each
    hint = F.concat((F.col("of") - F.col("n_items")).cast("string"), F.lit(" further hits beyond this page; re-call with cursor=next_cursor to continue"))
    return one.select(
        "n_items",
        "truncated",
        page_tokens(F.col("chars")).alias("total_estimate"),
        F.when(F.col("truncated"), encode_cursor(F.col("last.score"), F.col("last.node_id"))).alias("next_cursor"),
        F.when(F.col("truncated"), hint).otherwise("").alias("hint"),
    )


def kind_mix(hits: DataFrame) -> DataFrame:
    """One row: mix of hit kinds, the most frequent first."""
    kinds = hits.groupBy(F.coalesce("kind", F.lit("unknown")).alias("kind")).agg(F.count("*").alias("n"))
    parts = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("kind").alias("kind"), F.col("n").alias("n"))))
    return kinds.agg(F.array_join(F.transform(parts, lambda x: F.concat(x["kind"], F.lit("x"), x["n"].cast("string"))), ", ").alias("mix"))


def gist(hits: DataFrame) -> DataFrame:
    """n, top and middle score (the element at n // 2 from the top), and the mix of kinds; one row.

    All hits are ranked by score, in partitions, and the one of the middle rank is taken.
    """
    from tessera.operators.entity import global_rank

    ranked = global_rank(hits.select(score_6(F.col("score")).alias("s"), "node_id").withColumn("neg", -F.col("s")), "neg", "node_id")
    sums = hits.agg(F.count("*").alias("n"), F.max(score_6(F.col("score"))).alias("top"))
    middle = ranked.join(F.broadcast(sums), F.col("rank") == F.floor(F.col("n") / 2)).select(F.col("s").alias("middle"))
    return sums.crossJoin(F.broadcast(middle)).crossJoin(F.broadcast(kind_mix(hits)))  # one row each


def byte_budget(rows: DataFrame, text: str, order: list[str], budget: int, most: int = 1000) -> DataFrame:
    """The first rows whose JSON texts, a comma each, fit a budget of bytes; most bounds a list as the reader does."""
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    first = rows.orderBy(*order).limit(most)
    return first.withColumn("upto", F.sum(F.octet_length(text) + 1).over(upto)).where(F.col("upto") <= budget)


def split_spill(payloads: DataFrame, text: str, most_chars: int = MAX_CHARS) -> DataFrame:
    """payloads with spilled, and for those the digest that names their file."""
    over = F.octet_length(text) > most_chars
    return payloads.withColumn("bytes", F.octet_length(text)).withColumn("spilled", over).withColumn("ref", F.when(over, F.sha2(text, 256)))


def write_spill(payloads: DataFrame, text: str, path: str) -> None:
    """Payloads over the limit as one row each, under their digest; what is there already stays."""
    payloads.where("spilled").select("ref", F.col(text).alias("payload")).dropDuplicates(["ref"]).write.mode("append").parquet(path)


def bounded_answer(answer: dict, budget: int) -> bytes:
    """An answer as compact ASCII JSON and a line end, in a budget of bytes: results go from the end; if that is not
    enough, coverage and hints are replaced; then the fields that name the source are emptied."""
    text = lambda: json.dumps(answer, ensure_ascii=True, separators=(",", ":")).encode() + b"\n"
    answer = dict(answer)
    if len(text()) > budget and answer["results"]:
        # sizes of the results, with commas, tell how many stay; a reason takes the place of null
        sizes = [len(json.dumps(r, ensure_ascii=True, separators=(",", ":"))) for r in answer["results"]]
        results, answer["results"], answer["truncation_reason"] = answer["results"], [], "byte_budget"
        room, keep = budget - len(text()), 0
        while keep < len(sizes) - 1 and sizes[keep] + (keep > 0) <= room:
            room -= sizes[keep] + (keep > 0)
            keep += 1
        answer["results"] = results[:keep]
    if len(text()) > budget:
        answer |= {"validation_coverage": {"status": "omitted_for_byte_budget"}, "hints": ["Metadata omitted to fit byte budget."], "truncation_reason": "byte_budget"}
    if len(text()) > budget:
        answer |= {k: None for k in ("repository", "source_head", "freshness", "error", "slice", "built_head", "equivalent_head") if k in answer}
    return text()
