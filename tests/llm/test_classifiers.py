import random

import numpy as np

from tessera.llm import language, toxicity
from tests.llm import cases

WORDS = {"xx": ["bala", "komi", "tura", "neso"], "yy": ["strzk", "pflug", "schwo", "grimt"], "zz": ["éàu", "œuvi", "ñorê", "çaî"]}


def _made(seed=1, count=80):
    draw = random.Random(seed)
    return [(k, " ".join(draw.choice(WORDS[lang]) + draw.choice(["", "a", "i"]) for _ in range(draw.randint(2, 60))), lang) for k in range(count) for lang in WORDS]


def test_languages_are_told_apart():
    rows = _made()
    model = language.LanguageModel.fit([r[1] for r in rows], [r[2] for r in rows], landmarks=30)
    other = _made(seed=2)
    names, scores = model.predict([r[1] for r in other])
    assert np.mean([a == r[2] for a, r in zip(names, other, strict=True)]) > 0.98
    assert ((scores >= 0) & (scores <= 1)).all()


def test_folded_weights_are_the_kernel_s():
    rows = _made(count=15)
    texts, langs = [r[1] for r in rows], [r[2] for r in rows]
    model = language.LanguageModel.fit(texts, langs, landmarks=len(texts), ridge=1e-9)
    from tessera.llm import common

    grams = [set(common.gram_slots(common.letter_runs(t), language.ORDERS, language.BITS).tolist()) for t in texts]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    rows_ = language._scaled(language._rows([common.letter_runs(t) for t in texts]))
    assert np.allclose(rows_ @ rows_.T, kernel, atol=1e-5)
    scores = rows_ @ model.weights
    assert (scores.argmax(1) == [sorted(set(langs)).index(x) for x in langs]).all()


def test_odd_texts_have_a_language_or_none(spark):
    docs = cases.docs(spark)
    model = language.learn(docs, held_out_fold=None)
    found = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    by = {f[0]: f for f in found}
    assert all(by[k][1:] == ("und", 0.0) for k in (3, 4, 5, 10))
    assert all(by[k][1] in ("en", "de", "fr") for k in (1, 6, 9, None))
    assert language.identify(docs, model).count() == len(cases.ROWS)
    assert language.identify(docs, model).columns.count("score") == 1


def test_languages_of_nothing(spark):
    model = language.learn(cases.empty(spark))
    assert model.langs == [] and language.identify(cases.empty(spark), model).collect() == []
    assert {r["lang_pred"] for r in language.identify(cases.docs(spark), model).collect()} == {"und"}


def test_language_accuracy_on_the_held_out_fold(spark, sf_dir):
    from tessera.llm import common, queries

    found = queries.op3_language_id(spark, sf_dir).join(common.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert found and np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.9


def test_toxic_texts_are_told_apart(spark):
    draw = random.Random(5)
    plain = lambda n: " ".join(draw.choice(["river", "house", "green", "walks", "paper", "sound"]) for _ in range(n))
    rows = [(k, plain(20) + (" you wretched fool " + plain(3) if k % 3 == 0 else ""), int(k % 3 == 0)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), held_out_fold=1)
    found = {r["doc_id"]: r for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    assert np.mean([found[k]["predicted"] == t for k, _, t in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_toxicity_of_odd_texts(spark):
    docs = cases.docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 0), (7, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, held_out_fold=None)
    found = toxicity.score(docs, model)
    assert found.count() == len(cases.ROWS) and found.where("score is null or score < 0 or score > 1").count() == 0
    none = toxicity.learn(docs, labels.where("doc_id < 0"))
    assert {r["predicted"] for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(cases.empty(spark), model).collect() == []


def test_toxicity_on_the_held_out_fold(spark, sf_dir):
    from tessera.llm import common, queries

    found = queries.op8_toxicity(spark, sf_dir.replace("0.001", "0.01")).join(common.table(spark, sf_dir.replace("0.001", "0.01"), "labels"), "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in found if r["toxic"]]
    assert np.mean(toxic) > 0.7 and not any(r["predicted"] for r in found if not r["toxic"])


def test_every_language_is_learned(spark):
    """More languages than landmarks or any bound on rows, and one with long texts alone."""
    draw = random.Random(3)
    stem = lambda k: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) + chr(0x3B1 + k % 24)
    words = {f"l{k:03}": [stem(k) for _ in range(4)] for k in range(230)}
    text = lambda lang, n: " ".join(draw.choice(words[lang]) for _ in range(n))
    rows = [(k, text(lang, 12), lang) for k, lang in enumerate(list(words) * 6)] + [(9000 + k, text("l000", 2) + " qqqq" * 50_000, "long") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs, held_out_fold=None)
    assert model.langs == sorted([*words, "long"])
    new = [(lang, text(lang, 12)) for lang in words]
    names, _ = model.predict([t for _, t in new])
    assert np.mean([a == lang for a, (lang, _) in zip(names, new, strict=True)]) > 0.9
    assert model.predict(["qqqq qqqq"])[0] == ["long"]


def test_scripts_beyond_16_bits_have_slots_of_their_own():
    from tessera.llm import common

    a, b = (set(common.gram_slots(common.letter_runs(chr(c) * 3), language.ORDERS, language.BITS).tolist()) for c in (0x10330, 0x0330 + 0x20000))
    assert len(a & b) == 1  # the space


def test_ridge_is_that_of_plain_linear_algebra():
    """Kernel values by sets, landmarks, the normal equations and scores from kernel rows, without folding."""
    from tessera.llm import common

    rows, other = _made(count=20), _made(seed=5, count=10)
    model = language.LanguageModel.fit([r[1] for r in rows], [r[2] for r in rows], landmarks=12, ridge=1e-2)
    grams = lambda t: set(common.gram_slots(common.letter_runs(t), language.ORDERS, language.BITS).tolist())
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    own, names = [grams(r[1]) for r in rows], sorted(WORDS)
    marks = [own[3 * k + j] for k in range(4) for j in range(3)]  # the rows come in turns of the languages
    k = np.array([[kernel(a, m) for m in marks] for a in own])
    among = np.array([[kernel(a, m) for m in marks] for a in marks])
    y = np.array([[float(r[2] == n) for n in names] for r in rows])
    a = np.linalg.solve(k.T @ k + 1e-2 * len(rows) * among + 1e-6 * np.eye(12), k.T @ y)
    for r in other:
        g = grams(r[1])
        scores = np.array([kernel(g, m) for m in marks]) @ a
        (name,), (share,) = model.predict([r[1]])
        assert name == names[scores.argmax()]
        assert abs(share - scores.max() / np.maximum(scores, 0).sum()) < 1e-3


def test_ratios_and_fit_are_those_of_a_plain_version():
    import math

    from tessera.llm import common

    draw = random.Random(7)
    plain = lambda n: " ".join(draw.choice(["river", "house", "green", "walks", "paper", "sound"]) for _ in range(n))
    texts = [plain(8) + (draw.choice([" you fool", " wretched oaf", ""]) if k % 3 == 0 else "") for k in range(60)]
    toxic = [int(k % 3 == 0) for k in range(60)]
    model = toxicity.ToxicityModel.fit(texts, toxic)
    own = [set(common.gram_slots(common.letter_runs(t), toxicity.ORDERS, toxicity.BITS).tolist()) for t in texts]
    bad, good = sum(toxic), len(toxic) - sum(toxic)
    ratio = {}
    for g in set().union(*own):
        p, q = (1 + sum(g in s for s, t in zip(own, toxic, strict=True) if t == c) for c in (1, 0))
        r = math.log(p / (bad + 2)) - math.log(q / (good + 2))
        if p + q - 2 >= toxicity.LEAST_DOCS and abs(r) >= toxicity.LEAST_Z * math.sqrt(1 / p + 1 / q):
            ratio[g] = r
    w, b = dict.fromkeys(ratio, 0.0), 0.0
    state = {g: (0.0, 0.0) for g in [*ratio, "bias"]}
    for t in range(1, toxicity.ROUNDS + 1):
        pull = []
        for s, y in zip(own, toxic, strict=True):
            z = b + sum(ratio[g] * w[g] for g in s if g in ratio)
            pull.append((0.5 / bad if y else 0.5 / good) * (1 / (1 + math.exp(-z)) - y))
        grad = {g: toxicity.RIDGE * w[g] / len(toxic) + sum(ratio[g] * x for s, x in zip(own, pull, strict=True) if g in s) for g in ratio} | {"bias": sum(pull)}
        for g, d in grad.items():
            m, v = state[g]
            m, v = state[g] = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
            step = 0.03 * (m / (1 - 0.9**t)) / (math.sqrt(v / (1 - 0.99**t)) + 1e-8)
            if g == "bias":
                b -= step
            else:
                w[g] -= step
    wanted = [1 / (1 + math.exp(-b - sum(ratio[g] * w[g] for g in s if g in ratio))) for s in own]
    assert ratio and np.allclose(model.score(texts), wanted, atol=1e-4)


def test_queries_of_null_ids(spark, tmp_path):
    from tessera.llm import queries

    cases.docs(spark).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for query in (queries.op3_language_id, queries.op8_toxicity):
        found = query(spark, str(tmp_path)).collect()
        assert len(found) == len(cases.ROWS) and not any(r["held_out"] is None for r in found)


def test_samples_of_repeated_and_long_rows_stay_bounded(spark, monkeypatch):
    rows = [(k % 3, f"text number {k} " * (2000 if k % 7 == 0 else 2), k % 2) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    assert toxicity.drawn(docs, labels, held_out_fold=None).count() == 3
    assert toxicity.learn(docs, labels, held_out_fold=None).weights.shape == (1 << toxicity.BITS,)
    for most in (60, 1):
        monkeypatch.setattr(toxicity, "SAMPLE_SLOTS", most)
        assert toxicity.drawn(docs, labels, held_out_fold=None).count() < 3
        assert 0 <= toxicity.learn(docs, labels, held_out_fold=None).score(["text"])[0] <= 1


def test_fit_keeps_no_more_than_the_slots_that_tell():
    """Eight million slots: arrays of all of them would take hundreds of megabytes."""
    import tracemalloc

    from tessera.llm import common

    draw = np.random.default_rng(3)
    rows = [common.packed(np.unique(draw.integers(0, 1 << toxicity.BITS, 20_000)), toxicity.BITS) for _ in range(400)]
    tracemalloc.start()
    model = toxicity.ToxicityModel.fit_slots(rows, [k % 2 for k in range(400)])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 80 << 20 and np.count_nonzero(model.weights)


def test_parts_of_a_fit_do_not_change_it(monkeypatch):
    draw = random.Random(11)
    texts = [" ".join(draw.choice(["river", "house", "fool", "paper"]) for _ in range(9)) for _ in range(60)]
    toxic = ["fool" in t.split()[:3] for t in texts]
    one = toxicity.ToxicityModel.fit(texts, toxic)
    monkeypatch.setattr(toxicity, "PART_SLOTS", 40)
    many = toxicity.ToxicityModel.fit(texts, toxic)
    assert np.allclose(one.weights, many.weights, atol=1e-6) and abs(one.bias - many.bias) < 1e-6
