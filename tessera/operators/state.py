"""Incremental state: differences, fragment reuse, digests, ledgers, identities and cost plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import cost, planned_tokens
from tessera.sources.scratch import materialise, scratch


#: An approval may be valid for a week.
VALID_HOURS = 168


def diff(current: DataFrame, previous: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, change) with change in added, modified, deleted, unchanged; a rename is one deleted and one added."""
    c, p = current.select(F.col(key).alias("_c"), F.col(digest).alias("_cd")), previous.select(F.col(key).alias("_p"), F.col(digest).alias("_pd"))
    change = F.when(F.col("_p").isNull(), "added").when(F.col("_c").isNull(), "deleted").when(F.col("_cd").eqNullSafe(F.col("_pd")), "unchanged").otherwise("modified")
    return c.join(p, F.col("_c") == F.col("_p"), "full_outer").select(F.coalesce("_c", "_p").alias(key), change.alias("change"))


def top_paths(changes: DataFrame, key: str, most: int = 50) -> DataFrame:
    """The first paths of each change, most of them at the most, and how many each change leaves out."""
    place = F.row_number().over(Window.partitionBy("change").orderBy(key))
    sizes = changes.groupBy("change").agg(F.greatest(F.lit(0).cast("long"), F.count("*") - most).alias("omitted"))
    return changes.withColumn("place", place).where(F.col("place") <= most).join(F.broadcast(sizes), "change").select("change", "place", key, "omitted")


def fragment_key(path: Column, content_sha256: Column, *identity: str) -> Column:
    """The key of an extraction result: digest of what made it (schema, family, extractor, policy), path and content. No commit."""
    return F.sha2(F.concat_ws("\x1f", *[F.lit(x) for x in identity], path, content_sha256), 256)


def reuse(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """wanted(key_sha256, ...) with outcome hit, miss, or corrupt if the cached payload isn't what its digest says."""
    c = cache.select(F.col("key_sha256").alias("_k"), (F.sha2("payload", 256) == F.col("payload_sha256")).alias("_sound"))
    return wanted.join(c, wanted["key_sha256"] == c["_k"], "left").withColumn("outcome", F.when(F.col("_k").isNull(), "miss").when(F.col("_sound"), "hit").otherwise("corrupt")).drop("_k", "_sound")


def put(cache: DataFrame, new: DataFrame, quota_bytes: int, used: int | None = None) -> DataFrame:
    """new(key_sha256, payload, payload_sha256) with outcome stored, exists_verified, exists_conflict or full.

    Nothing is replaced; new rows fit in the order of their keys until the quota of bytes is used up. used: the bytes of the
    cache's payloads, where they are known.
    """
    c = cache.select(F.col("key_sha256").alias("_k"), F.col("payload_sha256").alias("_sha"))
    rows = new.join(c, new["key_sha256"] == c["_k"], "left")
    if used is None:
        rows = rows.crossJoin(F.broadcast(cache.agg(F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("_used"))))  # one row
    else:
        rows = rows.withColumn("_used", F.lit(used))
    # sums of earlier sizes: by share of the key first, so that no task sees all rows
    share = F.substring("key_sha256", 1, 3)
    size = F.when(F.col("_k").isNull(), F.octet_length("payload")).otherwise(0)
    rows = rows.withColumn("_share", share).withColumn("_size", size)
    inside = F.sum("_size").over(Window.partitionBy("_share").orderBy("key_sha256").rowsBetween(Window.unboundedPreceding, 0))
    sums = rows.groupBy("_share").agg(F.sum("_size").alias("_all"))
    before = F.sum("_all").over(Window.orderBy("_share").rowsBetween(Window.unboundedPreceding, -1))
    starts = F.broadcast(sums.select("_share", F.coalesce(before, F.lit(0)).alias("_before")))  # 4,096 rows
    rows = rows.withColumn("_inside", inside).join(starts, "_share")
    fits = F.col("_used") + F.col("_before") + F.col("_inside") <= quota_bytes
    outcome = F.when(F.col("_k").isNotNull() & (F.col("_sha") == F.col("payload_sha256")), "exists_verified").when(F.col("_k").isNotNull(), "exists_conflict").when(fits, "stored").otherwise("full")
    return rows.select(*[new[x] for x in new.columns], outcome.alias("outcome"))


def cache_stats(outcomes: DataFrame, cache: DataFrame, quota_bytes: int) -> DataFrame:
    """One row: how often each outcome came, bytes_used by cache(payload), and the status: corrupt, full or ok."""
    names = ("hit", "miss", "corrupt", "stored", "exists_verified", "exists_conflict", "full")
    counts = outcomes.agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in names])
    used = cache.agg(F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).cast("long").alias("bytes_used"))
    status = F.when(F.col("corrupt") + F.col("exists_conflict") > 0, "corrupt").when((F.col("full") > 0) | (F.col("bytes_used") >= quota_bytes), "full").otherwise("ok")
    return counts.crossJoin(F.broadcast(used)).withColumn("status", status)  # one row each


def input_digest(files: DataFrame, group: str) -> DataFrame:
    """(group, digest): SHA-256 over the sorted digests of path and content of each group's files.

    Each file is hashed first and files are summed up by share of their hash, so a group is never gathered as texts.
    """
    rows = files.select(group, F.sha2(F.concat_ws("\x1f", "path", "sha256"), 256).alias("d"))
    shares = rows.groupBy(group, F.substring("d", 1, 2).alias("share")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("d"))
    return shares.groupBy(group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("share", F.lit(":"), "d"))), ""), 256).alias("digest"))


def resolution_digest(candidates: DataFrame, index: DataFrame, group: str) -> DataFrame:
    """(group, digest) of who owns each candidate path now: it changes when a path appears, moves or goes."""
    owned = candidates.select(group, "path").distinct().join(index.select("path", "slice"), "path", "left")
    rows = owned.select(group, "path", F.coalesce("slice", F.lit("-")).alias("sha256"))
    return input_digest(rows, group)


def reusable(old: DataFrame, new: DataFrame, runtime: str | None) -> DataFrame:
    """(slice, reuse): both digests (slice, input_digest, resolution_digest) equal those of the last build, and the runtime that
    would build now is identified and is the one that input digests were made with. runtime: its digest, or None."""
    o = old.select("slice", F.col("input_digest").alias("_i"), F.col("resolution_digest").alias("_r"))
    same = (F.col("input_digest") == F.col("_i")) & (F.col("resolution_digest") == F.col("_r"))
    return new.join(o, "slice", "left").select("slice", F.coalesce(same & F.lit(runtime is not None), F.lit(False)).alias("reuse"))


def trusted_digest(files: DataFrame, known: DataFrame) -> DataFrame:
    """files(blob_oid, content) with sha256, taken from known(ord, blob_oid, sha256), the first of each blob, if there."""
    first = known.groupBy("blob_oid").agg(F.min_by("sha256", "ord").alias("_known"))
    return files.join(first, "blob_oid", "left").withColumn("sha256", F.coalesce("_known", F.sha2("content", 256))).drop("_known")


def classify(ledger: DataFrame, key: str, at: str, row_id: str, fingerprint: str, current: DataFrame) -> DataFrame:
    """(key, status) of current(key, fingerprint): valid, stale or unknown by the newest ledger row of the key."""
    newest = ledger.groupBy(key).agg(F.max_by(fingerprint, F.struct(at, row_id)).alias("_newest"))
    status = F.when(F.col("_newest").isNull(), "unknown").when(F.col("_newest") == F.col(fingerprint), "valid").otherwise("stale")
    return current.join(newest, key, "left").select(key, status.alias("status"))


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of each key."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.max_by(whole, F.struct(*order)).alias("_r")).select("_r.*")


def intern(known: DataFrame, curies: DataFrame) -> DataFrame:
    """known(id, curie) and new curies with ids that go on from the highest, in the order of the new curies."""
    from tessera.operators.entity import global_rank

    new = curies.select("curie").distinct().join(known.select("curie"), "curie", "left_anti")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    return known.unionByName(global_rank(new, "curie").crossJoin(F.broadcast(top)).select((F.col("_top") + F.col("rank") + 1).cast("long").alias("id"), "curie"))


def walk_ends(step: DataFrame) -> DataFrame:
    """(start, end, around) of rows step(start, end), one for each start: where walks along all steps end; around is true if
    they never do. Each round doubles the steps taken. If no walk ends in a round, none ends later: one that is longer
    passes through a start that is as far from its end as this round reaches."""
    walk, left = step.select("start", "end", F.lit(True).alias("around")), None
    while True:
        ahead = walk.select(F.col("start").alias("_s"), F.col("end").alias("_e"))
        walk = materialise(walk.join(ahead, F.col("end") == F.col("_s"), "left").select("start", F.coalesce("_e", "end").alias("end"), F.col("_s").isNotNull().alias("around")), "walks")
        on = walk.where("around").count()
        if on in (0, left):
            return walk
        left = on


def resolve_aliases(curies: DataFrame, known: DataFrame, aliases: DataFrame) -> DataFrame:
    """(curie, id) of curies: along aliases(alias_id, old_curie, new_curie), newest first, to a known(id, curie); null if it
    leads nowhere or around. Chains are followed to their end, in rounds that double the steps."""
    newest = aliases.groupBy("old_curie").agg(F.max_by("new_curie", "alias_id").alias("end")).where("end is not null")
    ids = known.where("id is not null").select(F.col("curie").alias("_at"), "id")
    ends = walk_ends(newest.select(F.col("old_curie").alias("start"), "end").join(ids, F.col("start") == F.col("_at"), "left_anti"))
    at = F.when(F.col("around"), F.lit(None)).otherwise(F.coalesce("end", "curie"))
    return curies.select("curie").join(ends, F.col("curie") == F.col("start"), "left").withColumn("_to", at).join(ids, F.col("_to") == F.col("_at"), "left").select("curie", "id")


def plan_costs(changes: DataFrame, overhead_percent: int, output_each: int, input_rate: str, output_rate: str) -> DataFrame:
    """Files, tokens and cost by repository and in total of changes(repository, change, bytes); only added and modified count."""
    work = changes.where(F.col("change").isin("added", "modified"))
    rows = work.select("repository", planned_tokens(F.col("bytes"), overhead_percent).alias("i"), F.lit(output_each).cast("long").alias("o"))
    sums = rows.groupBy("repository").agg(F.count("*").alias("files"), F.sum("i").alias("input_tokens"), F.sum("o").alias("output_tokens"))
    total = sums.agg(F.lit("*").alias("repository"), F.sum("files").alias("files"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
    both = sums.unionByName(total)
    return both.withColumn("total_tokens", F.col("input_tokens") + F.col("output_tokens")).withColumn("cost", cost(F.col("input_tokens"), F.col("output_tokens"), input_rate, output_rate))


def catch_up(changes: DataFrame, heads: DataFrame, overhead_percent: int, output_each: int, requested: int | None = None) -> DataFrame:
    """A batch plan: for each repository of heads(repository, commit, since), in order, and in total (repository *), its kind of
    catching up (initial without an earlier commit, none at the same one, else included), how many files are new, changed,
    unchanged and deleted by changes(repository, change, bytes), tokens, and for the total why it is refused, if it is:
    its tokens exceed the requested ceiling. Repositories without files count zero; changes of others are left out."""
    work = F.col("change").isin("added", "modified")
    tokens = F.when(work, planned_tokens(F.col("bytes"), overhead_percent))
    names = (("new", "added"), ("changed", "modified"), ("unchanged", "unchanged"), ("deleted", "deleted"))
    sums = changes.groupBy(F.col("repository").alias("_r")).agg(*[F.count_if(F.col("change") == c).alias(n) for n, c in names], F.sum(F.when(work, F.col("bytes"))).alias("input_bytes"), F.sum(tokens).alias("input_tokens"), (F.count_if(work) * output_each).alias("output_tokens"))
    counts = [n for n, _ in names] + ["input_bytes", "input_tokens", "output_tokens"]
    kind = F.when(F.col("since").isNull(), "initial").when(F.col("since") == F.col("commit"), "none").otherwise("included")
    each = heads.join(sums, F.col("repository") == F.col("_r"), "left").select("repository", kind.alias("catch_up"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
    total = each.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts]).select(F.lit("*").alias("repository"), F.lit(None).cast("string").alias("catch_up"), *counts)
    both = each.unionByName(total).withColumn("total_tokens", F.col("input_tokens") + F.col("output_tokens"))
    over = (F.col("repository") == "*") & (F.col("total_tokens") > F.lit(requested).cast("long"))
    return both.withColumn("refusal", F.when(over, "over_requested_ceiling"))


def approval_refusals(plan: DataFrame, approval: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """(plan_sha256, refusals): why approvals do not cover plans(plan_sha256, estimate, requested_ceiling, now).

    current(plan_sha256, input_sha256, estimate): what the plans' inputs, with plan.input_sha256 then, come to now. A plan whose
    inputs are gone or others is stale, and one that they would exceed is refused too.
    """
    if current is not None:
        c = current.select(F.col("plan_sha256").alias("_c"), F.col("input_sha256").alias("_now"), F.col("estimate").alias("_estimate"))
        plan = plan.join(c, plan["plan_sha256"] == c["_c"], "left").drop("_c")
    a = approval.select(F.col("plan_sha256").alias("_p"), "token_ceiling", "approved_at", "expires_at", "approved_by")
    rows = plan.join(a, plan["plan_sha256"] == a["_p"], "left")
    no = lambda condition, reason: F.when(F.coalesce(condition, F.lit(False)), reason)
    reasons = F.array_compact(
        F.array(
            no(F.col("_p").isNull(), "not_approved"),
            *([no(~F.col("input_sha256").eqNullSafe(F.col("_now")), "stale_plan"), no(F.col("_estimate") > F.col("requested_ceiling"), "inputs_over_requested")] if current is not None else []),
            no(F.coalesce("approved_by", F.lit("")) == "", "no_approver"),
            no(F.col("estimate") > F.col("token_ceiling"), "estimate_over_approved"),
            no(F.col("token_ceiling") > F.col("requested_ceiling"), "approved_over_requested"),
            no(F.col("expires_at") <= F.col("approved_at"), "expires_before_approval"),
            no(F.col("expires_at") <= F.col("now"), "expired"),
            no(F.col("expires_at") > F.col("approved_at") + F.expr(f"interval {VALID_HOURS} hours"), "valid_too_long"),
            no(F.col("approved_at") > F.col("now"), "approved_in_future"),
        )
    )
    return rows.select("plan_sha256", reasons.alias("refusals"))


def worst_status(runs: DataFrame, group: str) -> DataFrame:
    """(group, status): the first of unknown, failed, deferred, completed, unchanged that a group has."""
    order = F.array(*[F.lit(s) for s in ("unknown", "failed", "deferred", "completed", "unchanged")])
    return runs.groupBy(group).agg(F.min_by("status", F.array_position(order, F.col("status"))).alias("status"))


#: Links that the driver walks by itself; more of them are contracted first.
HELD_LINKS = 500_000


def _contracted(links: DataFrame, keep: list[str], k: int) -> DataFrame | None:
    """Distinct links(id, parent) without some of their commits, and links past these in their place, so that of the kept commits
    the same lead to one another; None if no commit can go.

    A commit may go if that makes no more links than it takes. Those that nothing follows, or that follow nothing, go at once; of the
    others those that come first among their neighbours by a hash, so no two of them are neighbours.
    """
    ends = links.select(F.col("id").alias("v"), F.lit(1).alias("outs"), F.lit(0).alias("ins")).unionByName(links.select(F.col("parent").alias("v"), F.lit(0).alias("outs"), F.lit(1).alias("ins")))
    outs, ins = F.sum("outs"), F.sum("ins")
    free = ends.groupBy("v").agg((outs * ins == 0).alias("dead"), (outs * ins <= outs + ins).alias("may_go")).where(F.col("may_go") & ~F.col("v").isin(keep))
    free = materialise(free.select("v", "dead", F.xxhash64("v", F.lit(k)).alias("place")), "free")
    if not free.take(1):
        return None
    of = lambda end: free.select(F.col("v").alias(end), F.col("dead").alias(f"{end}_dead"), F.col("place").alias(f"{end}_place"))
    marked = links.join(of("id"), "id", "left").join(of("parent"), "parent", "left").where("not coalesce(id_dead, false) and not coalesce(parent_dead, false)")
    marked = materialise(marked.select("id", "parent", "id_place", "parent_place"), "marked")
    later = F.when(F.struct("id_place", "id") < F.struct("parent_place", "parent"), F.col("parent")).otherwise(F.col("id"))
    later = marked.where("id_place is not null and parent_place is not null").select(later.alias("v"))
    gone = materialise(free.where("not dead").join(later, "v", "left_anti").select("v"), "gone")
    by = lambda end: gone.select(F.col("v").alias(end), F.lit(True).alias(f"{end}_goes"))
    parted = materialise(marked.select("id", "parent").join(by("id"), "id", "left").join(by("parent"), "parent", "left"), "parted")
    into = parted.where("parent_goes").select("id", F.col("parent").alias("via"))
    past = into.join(parted.where("id_goes").select(F.col("id").alias("via"), "parent"), "via").where("id <> parent").select("id", "parent")
    return materialise(parted.where("id_goes is null and parent_goes is null").select("id", "parent").unionByName(past).distinct(), "commits")


def target_relations(commits: DataFrame, cases: list[tuple[str, str]], held_links: int = HELD_LINKS) -> list[str]:
    """For each (built, target) current, behind or unknown: whether the built commit is the target, or an ancestor of it by
    commits(id, parent).

    Beyond held_links the history is contracted to the named commits in rounds, of which each takes a share of the commits, a third
    of a line's; what held_links are left of it is walked at once. A history of so many merges that no commit can go is walked in
    rounds, each of which adds what it finds to a table and reads it no more than once.
    """
    keep = sorted({c for case in cases for c in case})
    links, k = materialise(commits.where("parent is not null and id is not null and id <> parent").select("id", "parent").distinct(), "commits"), 0
    while not (few := links.count() <= held_links) and (fewer := _contracted(links, keep, k)) is not None:
        links, k = fewer, k + 1
    if not few:
        return [_behind_by_rounds(links, *case) for case in cases]
    parents: dict[str, list[str]] = {}
    for r in links.toLocalIterator():
        parents.setdefault(r["id"], []).append(r["parent"])
    above: dict[str, set[str]] = {}
    for target in {t for _, t in cases}:
        seen, todo = {target}, [target]
        while todo:
            new = set(parents.get(todo.pop(), ())) - seen
            seen |= new
            todo += new
        above[target] = seen & set(keep)
    return ["current" if built == target else "behind" if built in above[target] else "unknown" for built, target in cases]


def target_relation(commits: DataFrame, built: str, target: str, held_links: int = HELD_LINKS) -> str:
    """target_relations of one case."""
    return target_relations(commits, [(built, target)], held_links)[0] if built != target else "current"


def _behind_by_rounds(links: DataFrame, built: str, target: str) -> str:
    if built == target:
        return "current"
    spark, path, k = links.sparkSession, scratch(links.sparkSession, "ancestors"), 0
    spark.createDataFrame([(target,)], "id string").write.parquet(f"{path}/round=0")
    while True:
        known = spark.read.schema("id string, round int").parquet(path)
        frontier = known.where(F.col("round") == k).select("id")
        if not frontier.take(1):
            return "unknown"
        if frontier.where(F.col("id") == built).take(1):
            return "behind"
        k += 1
        links.join(frontier, "id").select(F.col("parent").alias("id")).distinct().join(known.select("id"), "id", "left_anti").write.parquet(f"{path}/round={k}")
