import collections
import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import sentencepiece

import corpus_pipeline
from tessera.llm import common, language, mixing, near_dedup, queries, toxicity
from tests.llm import cases
from tests.llm.test_near_dedup import _prefix_join


def test_stages_follow_one_another(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.materialise(stage(spark, docs, sf_dir), name)
        assert docs.columns == before.columns
        assert docs.join(before, docs.columns, "left_anti").count() == 0
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] > 0.7 * sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()


def test_dedup_and_mix_within_the_pipeline(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    kept = corpus_pipeline.minhash_dedup(spark, docs, sf_dir)
    groups = near_dedup.near_duplicates(docs)
    assert {r["doc_id"] for r in kept.collect()} == {r["component_id"] for r in groups.collect()}
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["size"] and r["taken"]}
    out = corpus_pipeline.mix_sources(spark, docs, sf_dir).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in out} == taken


def test_odd_documents_pass_through(spark, sf_dir):
    docs = cases.docs(spark).drop("held_out")
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, sf_dir)
        assert out.count() >= 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, cases.empty(spark), sf_dir).collect() == []


def test_run_is_the_stages_one_row_at_a_time(spark, sf_dir):
    """Texts are classified one by one, groups found by an exact join, the mix is that of its SQL, ids are the library's."""
    folder = sf_dir.replace("0.001", "0.01")
    docs = common.table(spark, folder, "documents")
    rows = [r.asDict() for r in docs.collect()]
    model = language.learn(docs, held_out_fold=None)
    named = [(r, model.predict([r["text"]])) for r in rows if any(c.isalpha() for c in r["text"] or "")]
    rows = [r for r, ((name,), (share,)) in named if name != language.UNKNOWN and share >= corpus_pipeline.LEAST_SHARE]
    kept = common.materialise(corpus_pipeline.language_id(spark, docs, folder), "kept")
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows}
    bad = toxicity.learn(kept, common.table(spark, folder, "labels"), held_out_fold=None)
    rows = [r for r in rows if bad.score([r["text"]])[0] < toxicity.TOXIC]
    groups = _prefix_join([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if groups[r["doc_id"]][1] == r["doc_id"]]
    documents = pa.table({k: [r[k] for r in rows] for k in ("doc_id", "source", "text")})  # noqa: F841 (the SQL reads it)
    times = {i: taken // size for i, size, taken in duckdb.sql(f"select doc_id, size, taken from ({mixing.MIX_SQL})").fetchall() if size}
    library = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    wanted = collections.Counter()
    for r in rows:
        ids = library.encode(r["text"], add_bos=True, add_eos=True)
        digests = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
        wanted[r["doc_id"], len(ids), *digests] = times.get(r["doc_id"], 0)
    found = collections.Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert found == +wanted and 0 < len(found) < docs.count()
