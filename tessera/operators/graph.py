"""Bounded read-only queries on a directed multigraph of nodes(ord, id, ...) and links(ord, source, target, ...).

Links are looked at in input order, node by node in the order of discovery, as a breadth-first walk does. Each level is
one job: the links of the frontier's nodes, in order, and no more of them than the walk may still look at, plus one.
Both the frontier and what a level gives are bound by max_explored (100,000 at most), and so are held by the driver;
what has no bound, the links, stays distributed. Walks over links that are stored by node (store) read only the row
groups of a small frontier's nodes; over links that are looked for (Sought) they make those of their nodes alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import casefold
from tessera.sources.scratch import materialise

MOST_EXPLORED = 100_000
#: Frontiers up to this size are named in the filter that reaches the scan.
NAMED = 10


def adjacency(links: DataFrame, direction: str = "both") -> DataFrame:
    """(node, next, ord, dir, source, target, kind): out links have dir 0, in links dir 1; both has a self-loop twice."""
    if direction not in ("in", "out", "both"):
        raise ValueError(f"direction: {direction}")
    ways = []
    if direction != "in":
        ways.append(links.select(F.col("source").alias("node"), F.col("target").alias("next"), "ord", F.lit(0).alias("dir"), "source", "target", "kind"))
    if direction != "out":
        ways.append(links.select(F.col("target").alias("node"), F.col("source").alias("next"), "ord", F.lit(1).alias("dir"), "source", "target", "kind"))
    return ways[0] if len(ways) == 1 else ways[0].unionByName(ways[1])


def store(links: DataFrame, path: str) -> None:
    """Writes the adjacency of links, both ways, each file sorted by node, so that page indexes find a node's rows. Rebalancing
    deals a node of very many links over several files."""
    adjacency(links).hint("rebalance", "node").sortWithinPartitions("node", "ord", "dir").write.option("parquet.block.size", str(16 << 20)).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@dataclass
class Sought:
    """Links that nothing stores: find(ids, side) makes those of which an end, side (source or target), is among ids."""

    spark: SparkSession
    find: Callable[[list[str], str], DataFrame]


def _ways(links: DataFrame | Sought, direction: str) -> Callable[[list[str]], DataFrame]:
    """The adjacency of given nodes (and others, where links are at hand): of links, of stored ones, or of links looked for."""
    if direction not in ("in", "out", "both"):
        raise ValueError(f"direction: {direction}")
    if isinstance(links, Sought):
        sides = {"out": ("source",), "in": ("target",), "both": ("source", "target")}[direction]

        def ways(ids: list[str]) -> DataFrame:
            each = [adjacency(links.find(ids, side), "out" if side == "source" else "in") for side in sides]
            return each[0] if len(each) == 1 else each[0].unionByName(each[1])

        return ways
    if "dir" not in links.columns:
        every = adjacency(links, direction)
    else:
        every = links if direction == "both" else links.where(F.col("dir") == int(direction == "in"))
    return lambda ids: every


def links_of(links: DataFrame | Sought, node_id: str, direction: str = "both") -> DataFrame:
    """The adjacency of one node."""
    return _ways(links, direction)([node_id]).where(F.col("node") == node_id)


@cache
def _folded_to_ascii() -> dict[str, str]:
    """Characters that are not ASCII and whose case folding has ASCII in it."""
    return {c: f for c in map(chr, range(128, 0x110000)) if not 0xD800 <= ord(c) < 0xE000 and (f := c.casefold()) != c and any(x.isascii() for x in f)}


def _folds_to(text: Column, wanted: str) -> Column:
    """Whether the case-folded text has wanted, which is folded, in it."""
    if not wanted.isascii():
        return casefold(text).contains(wanted)
    # where ASCII is looked for, lower case does but for the few characters that fold to ASCII
    special = _folded_to_ascii()
    full = text
    for c, folded in special.items():
        full = F.replace(full, F.lit(c), F.lit(folded))
    return F.lower(text).contains(wanted) | text.rlike(f"[{''.join(special)}]") & F.lower(full).contains(wanted)


def search(nodes: DataFrame, text: str, limit: int = 50) -> DataFrame:
    """The first nodes, in input order, one of whose attributes has the case-folded text in it.

    A null attribute counts as the text None.
    """
    hit = F.lit(False)
    for c in [c for c in ("id", "label", "name", "source_file", "type") if c in nodes.columns]:
        hit = hit | _folds_to(F.coalesce(F.col(c).cast("string"), F.lit("None")), text.casefold())
    return nodes.where(hit).orderBy("ord").limit(limit)


def search_answer(nodes: DataFrame, text: str, limit: int = 50) -> tuple[DataFrame, str | None]:
    """search, and the reason why it ends: record_limit if there are more nodes than it gives."""
    found = materialise(search(nodes, text, limit + 1), "found")
    return found.orderBy("ord").limit(limit), "record_limit" if found.count() > limit else None


def node(nodes: DataFrame, node_id: str) -> DataFrame:
    return nodes.where(F.col("id") == node_id)


def fetch(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """(id, status, node) of asked(id), each once: the node's columns, and ok or node_absent."""
    whole = nodes.select(F.col("id").alias("_id"), F.struct(*nodes.columns).alias("node"))
    found = asked.select("id").distinct().join(whole, F.col("id") == F.col("_id"), "left")
    return found.select("id", F.when(F.col("_id").isNull(), "node_absent").otherwise("ok").alias("status"), "node")


def listing(entries: DataFrame, empty: DataFrame) -> DataFrame:
    """Archive entries, and repositories without a graph, in one list."""
    return entries.withColumn("status", F.lit("selected")).unionByName(empty, allowMissingColumns=True)


def _need(nodes: DataFrame, **ends: str) -> None:
    found = {r["id"] for r in nodes.where(F.col("id").isin(*ends.values())).select("id").distinct().collect()}
    for what, node_id in ends.items():
        if node_id not in found:
            raise ValueError(f"{what} node absent: {node_id}")


def _level(ways: Callable[[list[str]], DataFrame], frontier: list[str], most: int, *more: str) -> list:
    """The first links of the frontier's nodes, in their order: k, the place of the node, and next, ord, dir, ..."""
    ways = ways(frontier)
    if len(frontier) <= NAMED:
        ways = ways.where(F.col("node").isin(*frontier))
    ranked = ways.sparkSession.createDataFrame([(n, k) for k, n in enumerate(frontier)], "node string, k long")
    return ways.join(F.broadcast(ranked), "node").select("k", "node", "next", "ord", "dir", *more).orderBy("k", "ord", "dir").limit(most).collect()


def _bounded(max_explored: int, bound: int = MOST_EXPLORED) -> None:
    if not 1 <= max_explored <= bound:
        raise ValueError(f"max_explored is 1 to {bound}")


@dataclass
class Neighbors:
    """rows as neighbors() gives them, the number of links looked at, and why rows are missing (record_limit,
    exploration_limit), if any are."""

    rows: DataFrame
    explored: int
    truncation: str | None


def explore(nodes: DataFrame, links: DataFrame | Sought, start: str, direction: str = "both", depth: int = 1, limit: int = 50, max_explored: int = 10_000, bound: int = MOST_EXPLORED) -> Neighbors:
    """The neighbours of a node. The walk ends after the node that brings it over the limit, or when max_explored links
    were looked at; the first limit rows are given. links may be stored ones, or looked for. bound: the greatest max_explored."""
    if depth not in (1, 2):
        raise ValueError("depth is 1 or 2")
    _bounded(max_explored, bound)
    _need(nodes, start=start)
    ways = _ways(links, direction)
    rows: list[tuple] = []
    truncation, frontier = None, [start]
    for level in range(1, depth + 1):
        got = _level(ways, frontier, max_explored - len(rows) + 1, "source", "target", "kind") if frontier else []
        for at, r in enumerate(got):
            # the limit is looked at between nodes
            if at and r["k"] != got[at - 1]["k"] and len(rows) > limit:
                break
            if len(rows) == max_explored:
                truncation = "exploration_limit"
                break
            rows.append((len(rows) + 1, level, r["next"], r["source"], r["target"], r["kind"], r["ord"]))
        if truncation or len(rows) > limit:
            break
        known = {start, *frontier}
        frontier = [n for n in dict.fromkeys(r["next"] for r in got) if n not in known]
    if len(rows) > limit:
        truncation = truncation or "record_limit"
    shown = nodes.sparkSession.createDataFrame(rows[:limit], "position int, depth int, node_id string, link_source string, link_target string, link_kind string, link_ord long")
    about = nodes.select(F.col("id").alias("node_id"), F.col("type").alias("node_type"), F.col("label").alias("node_label"))
    found = about.join(F.broadcast(shown), "node_id")  # limit rows at most
    return Neighbors(found.select("position", "depth", "node_id", "node_type", "node_label", "link_source", "link_target", "link_kind", "link_ord"), len(rows), truncation)


def neighbors(nodes: DataFrame, links: DataFrame | Sought, start: str, direction: str = "both", depth: int = 1, limit: int = 50, max_explored: int = 10_000) -> DataFrame:
    """One row for each link looked at, links back to known nodes too: position, depth, the other node and the link; see explore()."""
    return explore(nodes, links, start, direction, depth, limit, max_explored).rows


@dataclass
class Path:
    """ok, no_path, no_path_within_hop_limit or exploration_exhausted; the nodes of the path, if there is one; the number
    of links looked at; and exploration_limit, if that ended the walk."""

    status: str
    nodes: list[str]
    explored: int
    truncation: str | None = field(default=None)


def find_path(nodes: DataFrame, links: DataFrame | Sought, start: str, target: str, max_hops: int = 6, max_explored: int = 10_000) -> Path:
    """The path along out links that a breadth-first walk finds first. links may be stored ones, or looked for."""
    if not 0 <= max_hops <= 12:
        raise ValueError("max_hops is 0 to 12")
    _bounded(max_explored)
    _need(nodes, start=start, target=target)
    if start == target:
        return Path("ok", [start], 0)
    ways = _ways(links, "out")
    before: dict[str, str | None] = {start: None}
    frontier, explored = [start], 0
    for _ in range(max_hops):
        new = []
        for r in _level(ways, frontier, max_explored - explored + 1):
            if explored == max_explored:
                return Path("exploration_exhausted", [], explored, "exploration_limit")
            explored += 1
            if r["next"] not in before:
                before[r["next"]] = r["node"]
                new.append(r["next"])
            if r["next"] == target:
                way = [target]
                while (last := before[way[-1]]) is not None:
                    way.append(last)
                return Path("ok", way[::-1], explored)
        frontier = new
        if not frontier:
            return Path("no_path", [], explored)
    spark = nodes.sparkSession
    known = spark.createDataFrame([(n,) for n in before], "next string")
    edge = spark.createDataFrame([(n,) for n in frontier], "node string")
    onward = ways(frontier).select("node", "next").join(F.broadcast(edge), "node", "left_semi").join(F.broadcast(known), "next", "left_anti")  # max_explored rows at most
    return Path("no_path_within_hop_limit" if onward.take(1) else "no_path", [], explored)


def path_hops(links: DataFrame | Sought, path: Path) -> DataFrame:
    """One row for each link of each hop of a path: parallel links are all shown."""
    spark = links.spark if isinstance(links, Sought) else links.sparkSession
    steps = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(zip(path.nodes, path.nodes[1:], strict=False), 1)], "hop int, source string, target string")
    if isinstance(links, Sought):
        links = links.find(path.nodes[:-1], "source")
    elif "dir" in links.columns:  # stored by node
        links = links.where((F.col("dir") == 0) & F.col("node").isin(*path.nodes[:-1]))
    return links.join(F.broadcast(steps), ["source", "target"]).select("hop", "source", "target", "kind", "ord")


def path_nodes(nodes: DataFrame, path: Path) -> DataFrame:
    steps = nodes.sparkSession.createDataFrame(list(enumerate(path.nodes)), "step int, id string")
    return nodes.join(F.broadcast(steps), "id").select("step", "id", "type", "label")


def orphans(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(ord, side, id) of link ends that are no nodes."""
    ends = links.select("ord", F.explode(F.array(F.struct(F.lit("source").alias("side"), F.col("source").alias("id")), F.struct(F.lit("target").alias("side"), F.col("target").alias("id")))).alias("e")).select("ord", "e.side", "e.id")
    return ends.join(nodes.select("id"), "id", "left_anti").select("ord", "side", "id")


def hyperedge_orphans(nodes: DataFrame, hyperedges: DataFrame) -> DataFrame:
    """(ord, id) of hyperedge members that are no nodes."""
    members = hyperedges.select("ord", F.explode("nodes").alias("id"))
    return members.join(nodes.select("id"), "id", "left_anti").select("ord", "id")


def duplicate_ids(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("id").count().where("count > 1")


def check(nodes: DataFrame, links: DataFrame, hyperedges: DataFrame | None = None) -> None:
    """Raises on repeated ids, empty ids, and link or hyperedge members that are no nodes."""
    faults = [name for name, rows in (("empty id", nodes.where("id is null or id = ''")), ("repeated id", duplicate_ids(nodes)), ("dangling link", orphans(nodes, links)), *([("dangling hyperedge", hyperedge_orphans(nodes, hyperedges))] if hyperedges is not None else [])) if rows.take(1)]
    if faults:
        raise ValueError(", ".join(faults))


def vocabulary(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(part, kind, n): nodes by type and links by kind."""
    of = lambda df, part, c: df.groupBy(F.lit(part).alias("part"), F.col(c).alias("kind")).agg(F.count("*").alias("n"))
    return of(nodes, "node", "type").unionByName(of(links, "link", "kind"))


def freshness(head: str, caller_head: str | None, dirty: str = "unknown", equivalent_head: str | None = None) -> str:
    """What a caller's observation of a source says about a graph built at head."""
    if not caller_head:
        return "unknown"
    matches = {"false": "head_matches_clean_reported", "true": "head_matches_dirty_reported"}.get(dirty, "head_matches_cleanliness_unknown")
    if caller_head == head:
        return matches
    return f"equivalent_{matches}" if equivalent_head == caller_head else "head_mismatch"


def rank_nodes(links: DataFrame, seeds: list[str], rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """An extension: personalised PageRank over out links from up to eight seeds; (id, score)."""
    if not 1 <= len(seeds) <= 8:
        raise ValueError("one to eight seeds")
    spark = links.sparkSession
    base = spark.createDataFrame([(s, 1.0 / len(seeds)) for s in dict.fromkeys(seeds)], "id string, share double")
    degree = links.groupBy("source").agg(F.count("*").alias("degree"))
    step = materialise(links.join(degree, "source").groupBy("source", "target").agg((F.count("*") / F.first("degree")).alias("p")), "steps")
    score = base.withColumnRenamed("share", "score")
    for _ in range(rounds):
        moved = step.join(score, step["source"] == score["id"]).groupBy("target").agg((damping * F.sum(F.col("score") * F.col("p"))).alias("score")).withColumnRenamed("target", "id")
        back = base.select("id", (F.col("share") * (1 - damping)).alias("score"))
        score = materialise(moved.unionByName(back).groupBy("id").agg(F.sum("score").alias("score")), "rank")
    return score


def fuse(rankings: DataFrame, k: int = 60) -> DataFrame:
    """An extension: reciprocal rank fusion of rankings(ranking, id, rank, weight); (id, score)."""
    return rankings.groupBy("id").agg(F.sum(F.col("weight") / (k + F.col("rank"))).alias("score"))
