"""Near-duplicate groups by HyperMinHash sketches, banding, corrected estimates and confirmation on full sets.

1. One pass makes each text's shingle set, its digest, its registers and its band keys.
2. Rows of equal sets become one representative (the least doc_id), whatever their number.
3. Representatives that share a band key form a bucket. Buckets that have a member in common form a unit; where a unit
   would be very large, its buckets stay units of their own. So two texts that share a band key are in one unit.
4. A unit of few members is compared in one task. In a larger one each member is first compared with its buckets'
   leaders, which joins most near copies of one text; then the members outside the unit's largest component are
   dealt out in chunks, and each pair of chunks (theirs with one another, and with those of the component) is one
   task's work. Pairs within a component are not looked at.
5. A task compares registers, confirms on full sets the pairs of different components whose corrected estimate is near
   the limit or above, and gives out links that join components: fewer than it has members, whatever the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common, shingles
from tessera.operators.entity import global_rank


@dataclass(frozen=True)
class NearDedup:
    """percent: links have 100 * intersection >= percent * union. The chance to miss a pair at 85 is (1 - .85**rows)**bands = 1e-7."""

    percent: int = 85
    width: int = 5
    bands: int = 28
    rows: int = 5
    #: An estimate lower than the limit by this much (over five standard deviations) is not confirmed.
    slack: float = 0.17
    #: Members of a chunk, and shingles of a chunk: what a task holds is two chunks.
    chunk_docs: int = 512
    chunk_shingles: int = 500_000
    #: Leaders that a member of a crowded unit is first compared with: those it shares most bands with.
    leaders: int = 2
    #: Units up to this many members are taken as a whole; larger ones by bucket.
    unit: int = 4096
    #: Members of one leader that a task compares before the leader's text is read again.
    chunk: int = 64
    #: Ids that may be broadcast: 16 MB.
    broadcast_ids: int = 2_000_000

    @property
    def buckets(self) -> int:
        return self.bands * self.rows


def _sketch(p: NearDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.whole(batch.column(1))
            for a, b in common.blocks(texts):
                own = shingles.sets(texts.slice(a, b - a), p.width)
                regs = [shingles.registers(s, p.buckets) if len(s) else None for s in own]
                keys = np.concatenate([_band_keys(r, p) for r in regs if r is not None] or [np.zeros(0, np.int64)])
                at = np.concatenate([[0], np.cumsum([p.bands * (r is not None) for r in regs])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in own], pa.int64()),
                        pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in own], pa.binary()),
                        pa.array([r.tobytes() if r is not None else None for r in regs], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(keys)),
                    ],
                    names=["doc_id", "n_shingles", "digest", "registers", "keys"],
                )

    return run


def _band_keys(regs: np.ndarray, p: NearDedup) -> np.ndarray:
    r = regs.reshape(p.bands, p.rows).astype(np.uint64)
    key = np.arange(p.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(p.rows):
        key = shingles.mixed(key ^ r[:, k] + np.uint64(k << 16))
    return key.view(np.int64)


def _likely(p: NearDedup):
    """Keeps pairs whose corrected estimate is near enough to the limit or above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, p.buckets) for k in ("ra", "rb"))
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            estimate = shingles.corrected((ra == rb).sum(1), p.buckets, na, nb)
            ok = (estimate >= p.percent / 100 - p.slack) & (100 * np.minimum(na, nb) >= p.percent * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], names=["a", "b"])

    return run


def _confirm(p: NearDedup):
    """Rows (a, salt, member, id, text) in order: a leader's row, then its members; leaves the confirmed pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leader = None, np.zeros(0, np.uint64)
        for batch in batches:
            lead, salt, member, ids = (batch.column(k).to_pylist() for k in ("a", "salt", "member", "id"))
            texts = common.whole(batch.column("text"))
            out_a, out_b = [], []
            for a, b in common.blocks(texts):
                for k, own in enumerate(shingles.sets(texts.slice(a, b - a), p.width), a):
                    if not member[k]:
                        group, leader = (lead[k], salt[k]), own
                    elif group == (lead[k], salt[k]):
                        both = len(np.intersect1d(leader, own, assume_unique=True))
                        if 100 * both >= p.percent * (len(leader) + len(own) - both):
                            out_a.append(lead[k])
                            out_b.append(ids[k])
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return run


def _grid(n: np.ndarray) -> np.ndarray:
    return np.round(np.log2(np.maximum(n, 1)) * 2).astype(int)


def _near_pairs(regs: np.ndarray, n: np.ndarray, comp: np.ndarray, p: NearDedup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j, estimate), i < j, of different components whose sizes and estimates allow a link."""
    steps, at = np.unique(_grid(n), return_inverse=True)
    sizes = np.maximum(1, np.power(2.0, steps / 2)).astype(int)
    by_chance = np.array([[shingles.chance(min(a, b), max(a, b)) for b in sizes.tolist()] for a in sizes.tolist()])
    out = []
    for i in range(len(n) - 1):
        j = i + 1 + np.flatnonzero((comp[i + 1 :] != comp[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= p.percent * np.maximum(n[i + 1 :], n[i])))
        if len(j):
            c = by_chance[at[i], at[j]]
            estimate = ((regs[j] == regs[i]).sum(1) / p.buckets - c) / (1 - c)
            ok = estimate >= p.percent / 100 - p.slack
            out.append((np.full(ok.sum(), i), j[ok], estimate[ok]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _shared(own: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: a product of the presence matrix, of shingles that several sets have, by blocks."""
    flat = np.concatenate(own)
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    _, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    keep = n[at] > 1
    row, at = row[keep], column[at[keep]]
    out = np.zeros((len(own), len(own)), np.float32)
    by = np.argsort(at, kind="stable")
    row, at = row[by], at[by]
    for a in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
        i, j = np.searchsorted(at, (a, a + 4096))
        x = np.zeros((len(own), 4096), np.float32)
        x[row[i:j], at[i:j] - a] = 1
        out += x @ x.T
    return np.rint(out).astype(np.int64)


def _join_group(ids: list[int], comps: list[int], own: list[np.ndarray], p: NearDedup) -> list[tuple[int, int]]:
    """Confirmed links of a group that join different components, fewer than it has members."""
    n = np.array([len(x) for x in own])
    i, j, estimate = _near_pairs(np.array([shingles.registers(x, p.buckets) for x in own]), n, np.array(comps), p)
    by = np.argsort(-estimate, kind="stable")
    i, j = i[by], j[by]
    # one by one a pair takes about 30 microseconds; a product takes about two operations a cell and shingle
    at_once = len(i) * 3e-5 > n.sum() * len(n) * 1e-9 + 0.01
    if at_once:
        both = _shared(own)[i, j]
        ok = 100 * both >= p.percent * (n[i] + n[j] - both)
        i, j = i[ok], j[ok]
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = x = above.get(y, y)
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = top(comps[a]), top(comps[b])
        if x != y:
            if not at_once:
                both = len(np.intersect1d(own[a], own[b], assume_unique=True))
                if 100 * both < p.percent * (len(own[a]) + len(own[b]) - both):
                    continue
            above[max(x, y)] = min(x, y)
            out.append((ids[a], ids[b]))
    return out


def _compare(p: NearDedup):
    """Rows (group, id, comp, text) in the order of the groups; gives the links that join components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, comps, own = None, [], [], []

        def flush() -> pa.RecordBatch:
            found = _join_group(ids, comps, own, p) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            names, doc, comp = (batch.column(k).to_pylist() for k in ("group", "id", "comp"))
            texts = common.whole(batch.column("text"))
            for a, b in common.blocks(texts):
                for k, x in enumerate(shingles.sets(texts.slice(a, b - a), p.width), a):
                    if names[k] != group:
                        yield flush()
                        group, ids, comps, own = names[k], [], [], []
                    ids.append(doc[k])
                    comps.append(comp[k])
                    own.append(x)
        yield flush()

    return run


class _Run:
    def __init__(self, docs: DataFrame, p: NearDedup):
        self.p, self.docs = p, common.slim(docs, "doc_id", "text")
        self.sketches = common.materialise(self.docs.mapInArrow(common.trimmed(_sketch(p)), "doc_id long, n_shingles long, digest binary, registers binary, keys array<long>"), "sketches")
        own = self.sketches.where("digest is not null")
        self.classes = common.materialise(own.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
        sketch = self.sketches.where("digest is not null").join(self.classes.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("rep")), "left_semi")
        # rows that repeat a doc_id with one text are one; with several texts each set keeps its row
        self.reps = common.materialise(sketch.dropDuplicates(["doc_id", "digest"]), "reps")
        self.n = self.reps.count()

    def buckets(self) -> DataFrame:
        """(key, id, leader) of band keys that several representatives have."""
        rows = self.reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"))
        shared = rows.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader <> last").select("key", "leader")
        return common.materialise(rows.join(shared, "key"), "buckets")

    def units(self, buckets: DataFrame, star: DataFrame) -> DataFrame:
        """(unit, id): the connected buckets, or a bucket alone where those have too many members."""
        whole = self.components(star)
        sizes = whole.groupBy("comp").agg(F.count("*").alias("n")).withColumn("large", F.col("n") > self.p.unit)
        placed = common.materialise(whole.join(sizes, "comp").select("id", "comp", "large"), "placed", most_rows=self.n)
        large = placed.where("large").select("id")
        alone = buckets.join(large, "id").select(F.concat(F.lit("b"), F.col("key").cast("string")).alias("unit"), "id")
        return placed.where("not large").select(F.concat(F.lit("c"), F.col("comp").cast("string")).alias("unit"), "id").unionByName(alone)

    def groups(self, units: DataFrame, comps: DataFrame) -> DataFrame:
        """(group, id, comp): what each task compares."""
        p = self.p
        size = self.reps.groupBy(F.col("doc_id").alias("id")).agg(F.max("n_shingles").alias("n"))
        member = units.join(size, "id").join(comps, "id", "left").select("unit", "id", "n", F.coalesce("comp", "id").alias("comp"))
        about = member.groupBy("unit").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.mode("comp").alias("most"), F.count("*").alias("docs"), F.sum("n").alias("shingles")).where("lo <> hi")
        chunks = lambda docs, n: F.greatest(F.ceil(docs / p.chunk_docs), F.ceil(n / p.chunk_shingles)).cast("int")
        # a table of its own, so that the join's shuffle can be split where a unit has many members
        about = common.materialise(about.select("unit", (chunks(F.col("docs"), F.col("shingles")) == 1).alias("one"), "most"), "about", most_rows=self.n)
        rows = common.materialise(member.join(about, "unit").withColumn("inner", ~F.col("one") & (F.col("comp") == F.col("most"))), "members")
        counts = rows.where("not one").groupBy("unit").agg(
            *[f(F.when(F.col("inner") == inner, v)).alias(name) for name, inner, f, v in (("s_docs", False, F.count, F.lit(1)), ("s_n", False, F.sum, F.col("n")), ("g_docs", True, F.count, F.lit(1)), ("g_n", True, F.sum, F.col("n")))]
        )
        counts = counts.select(F.col("unit").alias("u"), chunks(F.col("s_docs"), F.col("s_n")).alias("s"), chunks(F.col("g_docs"), F.col("g_n")).alias("g"))
        # a component's chunks are numbered after the others'; a pair of them is nobody's work
        own = F.when(F.col("inner"), F.col("s") + F.pmod(F.xxhash64("id"), F.col("g")).cast("int")).otherwise(F.pmod(F.xxhash64("id"), F.col("s")).cast("int"))
        many = rows.where("not one").join(counts, F.col("unit") == F.col("u")).withColumn("own", own)
        # with one outer chunk and no inner one the chunk is compared with itself; pairs of chunks hold their own pairs too
        others = F.when(F.col("inner"), F.sequence(F.lit(0), F.col("s") - 1)).otherwise(F.filter(F.sequence(F.lit(0), F.col("s") + F.col("g") - 1), lambda k: (k != F.col("own")) | (F.col("s") + F.col("g") == 1)))
        dealt = many.select("unit", "id", "comp", "own", F.explode(others).alias("other"))
        name = F.concat_ws("|", "unit", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
        return rows.where("one").select(F.col("unit").alias("group"), "id", "comp").unionByName(dealt.select(name.alias("group"), "id", "comp"))

    def joins(self, groups: DataFrame) -> DataFrame:
        """Confirmed links within groups, as many as join their components."""
        asked = common.materialise(groups, "groups")
        rows = asked.join(self._texts(asked), "id").select("group", "id", "comp", "text")
        rows = rows.repartition("group").sortWithinPartitions("group", "id")
        return common.materialise(rows.mapInArrow(common.trimmed(_compare(self.p)), "a long, b long"), "links")

    def _texts(self, asked: DataFrame) -> DataFrame:
        """(id, text) of the documents asked for; a bounded set of ids is sent to the scan, a larger one is joined."""
        texts, ids = self.docs.withColumnRenamed("doc_id", "_d"), asked.select("id").distinct()
        if asked.count() <= self.p.broadcast_ids:
            texts = texts.join(F.broadcast(ids), F.col("_d") == F.col("id"), "left_semi")
        return texts.withColumnRenamed("_d", "id")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The confirmed ones of distinct pairs (a, b), materialised."""
        p = self.p
        side = self.reps.select(F.col("doc_id").alias("id"), F.col("registers").alias("r"), F.col("n_shingles").alias("n"))
        near = pairs.join(side.select(F.col("id").alias("b"), F.col("r").alias("rb"), F.col("n").alias("nb")), "b").join(side.select(F.col("id").alias("a"), F.col("r").alias("ra"), F.col("n").alias("na")), "a")
        near = common.materialise(near.select("a", "b", "ra", "rb", "na", "nb").mapInArrow(_likely(p), "a long, b long"), "near")
        sizes = near.groupBy("a").agg((F.count("*") / p.chunk).cast("long").alias("chunks"))
        members = near.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("chunks") + 1).alias("salt"), F.lit(True).alias("member"), F.col("b").alias("id"))
        leaders = members.groupBy("a", "salt").agg(F.lit(False).alias("member"), F.col("a").alias("id")).select("a", "salt", "member", "id")
        asked = common.materialise(members.unionByName(leaders), "asked")
        rows = asked.join(self._texts(asked), "id").select("a", "salt", "member", "id", "text")
        rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "member", "id")
        return common.materialise(rows.mapInArrow(common.trimmed(_confirm(p)), "a long, b long").where("a <> b"), "links")

    def components(self, edges: DataFrame) -> DataFrame:
        """(id, comp) of all that have a link: comp is the least id that links lead to."""
        most = 2 * edges.count()
        both = common.materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", most_rows=most)
        labels = common.materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")), "labels", most_rows=most)
        while True:
            heard = both.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
            new = labels.join(heard, labels["id"] == heard["a"]).select("id", F.least("comp", "c").alias("comp"), F.col("comp").alias("was"))
            far = labels.select(F.col("id").alias("comp"), F.col("comp").alias("on"))  # and on to where the label's own label leads
            new = common.materialise(new.join(far, "comp").select("id", F.least("comp", "on").alias("comp"), "was"), "labels", most_rows=most)
            if not new.where("comp <> was").take(1):
                return new.select("id", "comp")
            labels = new.select("id", "comp")

    def members(self, buckets: DataFrame) -> DataFrame:
        """(id, leaders): the leaders of a member's buckets, those of most buckets first; as many as there are bands at most."""
        pairs = buckets.where("id <> leader").groupBy("id", "leader").agg(F.count("*").alias("n"))
        each = pairs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "leader"))).alias("x"))
        return common.materialise(each.select("id", F.transform("x", lambda x: x["leader"]).alias("leaders")), "members")

    @staticmethod
    def spanning(members: DataFrame) -> DataFrame:
        """(a, b) that connect what the leaders connect: each member with its least leader, and that one with the member's
        other leaders. Members of one bucket mostly have the same leaders, so these are few."""
        least = F.array_min("leaders")
        own = members.select(least.alias("a"), F.col("id").alias("b"))
        others = members.select(least.alias("a"), F.array_remove("leaders", least).alias("rest")).distinct()
        return own.unionByName(others.select("a", F.explode("rest").alias("b")).distinct())

    def closed(self) -> DataFrame:
        """(id, comp) of all representatives that have a link."""
        p, buckets = self.p, self.buckets()
        members = self.members(buckets)
        units = common.materialise(self.units(buckets, self.spanning(members)), "units")
        sizes = units.groupBy("unit").agg(F.count("*").alias("n")).where(F.col("n") > p.chunk_docs).select("unit")
        crowded = units.join(sizes, "unit", "left_semi").select("id").distinct()
        first = members.join(crowded, "id", "left_semi").select(F.explode(F.slice("leaders", 1, p.leaders)).alias("a"), F.col("id").alias("b"))
        links = self.links(first)
        links = links.unionByName(self.joins(self.groups(units, self.components(links))))
        return self.components(links)


def _groups(docs: DataFrame, p: NearDedup) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of docs(doc_id, text), each with a doc_id."""
    run = _Run(docs, p)
    comps = run.closed()
    classes = run.classes.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(F.col("digest").alias("d"), F.coalesce("comp", "rep").alias("comp"))
    comp = F.coalesce("comp", "doc_id")
    return run.sketches.select("doc_id", "n_shingles", "digest").join(classes, F.col("digest") == F.col("d"), "left").select("doc_id", "n_shingles", comp.alias("component_id"), (F.col("doc_id") == comp).alias("kept"))


def _named(rows: DataFrame, own: Column) -> tuple[DataFrame, DataFrame | None, int]:
    """(_row, _id) of rows(_row, doc_id), what numbers stand for, and the greatest number of a doc_id.

    A row's number is its own doc_id, and a greater one than all of these where own is false. If 64 bits have no room
    above the greatest doc_id, doc_ids are numbered in their order instead, as (_number, _doc_id) says.
    """
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    top, last = rows.agg(F.coalesce(F.max("doc_id"), F.lit(0)), F.coalesce(F.max("_row"), F.lit(0))).first()
    if top + 1 + last < 1 << 63:
        return rows.select("_row", F.when(own, F.col("doc_id")).otherwise(F.lit(top + 1) + F.col("_row")).alias("_id")), None, top
    numbers = global_rank(rows.where(own).select(F.col("doc_id").alias("_doc_id")).distinct(), "_doc_id")
    numbers = common.materialise(numbers.select(F.col("rank").cast("long").alias("_number"), "_doc_id"), "numbers")
    top = numbers.count()
    named = rows.join(numbers, own & (F.col("doc_id") == F.col("_doc_id")), "left")
    return named.select("_row", F.coalesce("_number", F.lit(top + 1) + F.col("_row")).alias("_id")), numbers, top


def near_duplicates(docs: DataFrame, p: NearDedup = NearDedup()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs(doc_id, text).

    Null, empty or wordless text: no shingle, linked with nothing. Rows of equal sets are linked. component_id is the
    least doc_id that links lead to; kept marks that one (every row of it, if it repeats). Rows that repeat a doc_id are
    one document if their sets are equal. A row without a doc_id is a document of its own that comes after all others:
    its component_id is null unless links lead to a doc_id, and of linked rows without any doc_id one is kept. An empty
    table gives an empty one. Other columns of docs are not read.
    """
    docs = common.slim(docs, "doc_id", "text")
    if not docs.where("doc_id is null").take(1):
        return _groups(docs, p)
    rows = common.materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    names, numbers, top = _named(rows.select("_row", "doc_id"), F.col("doc_id").isNotNull())
    texts = common.materialise(rows.join(names.withColumnRenamed("_row", "_at"), F.col("_row") == F.col("_at")).select(F.col("_id").alias("doc_id"), "text"), "texts")
    found = _groups(texts, p)
    if numbers is not None:
        for c in ("doc_id", "component_id"):
            found = found.join(numbers, F.col(c) == F.col("_number"), "left").drop(c, "_number").withColumnRenamed("_doc_id", c)
        return found.select("doc_id", "n_shingles", "component_id", "kept")
    real = lambda c: F.when(F.col(c) <= top, F.col(c)).alias(c)
    return found.select(real("doc_id"), "n_shingles", real("component_id"), "kept")


def keep_rows(docs: DataFrame, p: NearDedup = NearDedup()) -> DataFrame:
    """One row of each group of near duplicates, with all columns of docs. A row without a doc_id, or with that of an
    earlier row, is a document of its own; it comes after all that have one, and stays if it is like no other row."""
    own, at = common.unused(docs, "row", "at")  # docs keeps its columns, whatever they are called
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("_rows"))
    if not ids.where("doc_id is null or _rows > 1").take(1):
        kept = _groups(common.slim(docs, "doc_id", "text"), p).where("kept").select(F.col("doc_id").alias(at))
        return docs.join(kept, F.col("doc_id") == F.col(at), "left_semi")
    rows = common.materialise(docs.withColumn(own, F.monotonically_increasing_id()), "rows")
    named = rows.select(F.col(own).alias("_row"), "doc_id")
    first = named.where("doc_id is not null").groupBy("doc_id").agg(F.min("_row").alias("_first"))
    numbered = named.join(first.select("_first"), F.col("_row") == F.col("_first"), "left")
    names = common.materialise(_named(numbered, F.col("_first").isNotNull())[0], "names")
    texts = rows.select(F.col(own).alias("_at"), "text").join(names, F.col("_row") == F.col("_at"))
    texts = common.materialise(texts.select(F.col("_id").alias("doc_id"), "text"), "texts")
    kept = _groups(texts, p).where("kept").select(F.col("doc_id").alias("_kept_id"))
    stay = names.join(kept, F.col("_id") == F.col("_kept_id"), "left_semi").select(F.col("_row").alias(at))
    return rows.join(stay, F.col(own) == F.col(at), "left_semi").drop(own)
