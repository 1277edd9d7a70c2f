import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import common, hashes, piece_bpe, token_binary, token_counts
from tessera.llm.queries import vocabulary
from tests.llm import cases


def _texts(count=1500, seed=3):
    draw = random.Random(seed)
    signs = "  \t\n abcdethein▁_é×日😀-.,'123<0x0A></s>\x01\x00ʼ\xa0\x1c"
    made = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 200))) for _ in range(count)]
    seams = "  \n\n\t ab'st.,!@1é\xa0\u3000(){}ÀC×"
    made += ["".join(draw.choice(seams) for _ in range(draw.randint(1, 50))) for _ in range(4 * count)]
    return [*made, "line1\nline2", "a.\n\nb", "it's a'll", "x\n", "x\n y", "foo(bar)[0].baz", "a\n\xa0b", "", *(" " * n for n in range(40)), *("a" * n for n in range(60)), *(" " * n + "the" for n in range(20)), "the" * 2000, "don't we'll 12 3", "trail ", "x<|endoftext|>y <|endoftext|>"]


def _blocks(texts, size):
    return [common.whole(pa.array(texts[a : a + size], pa.string())) for a in range(0, len(texts), size)]


def test_pieces_are_the_library_s():
    codec = piece_bpe.PieceEncoder(vocabulary("piece_bpe_32k.model"))
    texts = _texts()
    found = [ids for block in _blocks(texts, 97) for ids in codec.encode(block)]
    assert [f.tolist() for f in found] == codec.model.library.encode(texts, add_bos=True, add_eos=True)


def test_pieces_after_the_memo_starts_anew():
    codec = piece_bpe.PieceEncoder(vocabulary("piece_bpe_32k.model"))
    codec.memo.max_pieces = 50
    texts = _texts(200)
    found = [ids for block in _blocks(texts, 10) for ids in codec.encode(block)]
    assert [f.tolist() for f in found] == codec.model.library.encode(texts, add_bos=True, add_eos=True)


def test_byte_ids_are_the_library_s():
    encoder = token_binary.TextEncoder(vocabulary("byte_bpe_50k.json"))
    texts = _texts()
    found = [ids for block in _blocks(texts, 101) for flat, n in [encoder.encode(block)] for ids in np.split(flat, np.cumsum(n)[:-1])]
    assert [f.tolist() for f in found] == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def _patterns():
    return [t for n in (1024, 4096) for a, b in [cases.thue_morse(n)] for t in (a, b, f"x {a} y", f"x {b} y", f"{a} {b} {b} {a}")]


def test_patterns_of_letters_are_told_apart():
    texts = _patterns()
    block = common.whole(pa.array(texts))
    pieces = piece_bpe.PieceEncoder(vocabulary("piece_bpe_32k.model"))
    assert [f.tolist() for f in pieces.encode(block)] == pieces.model.library.encode(texts, add_bos=True, add_eos=True)
    tokens = token_binary.TextEncoder(vocabulary("byte_bpe_50k.json"))
    flat, n = tokens.encode(block)
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [e.ids for e in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_hashes_tell_runs_apart():
    draw = random.Random(2)
    runs = {bytes(draw.choice(b"\0\1ab") for _ in range(draw.randint(0, 80))) for _ in range(20000)}
    runs |= {b"\0" * n for n in range(100)} | {t.encode() for t in _patterns()}
    runs = sorted(runs)
    size = np.array([len(r) for r in runs])
    one, two = hashes.of_runs(b"".join(runs), np.cumsum(size) - size, size, lanes=2)
    assert len(set(one.tolist())) == len(runs) == len(set(zip(one.tolist(), two.tolist(), strict=True)))
    again = hashes.of_runs(b"".join(b"x" + r for r in runs), np.cumsum(size + 1) - size, size, lanes=2)
    assert (again[0] == one).all() and (again[1] == two).all()


def test_pieces_of_one_key_are_told_apart(monkeypatch):
    from tessera.llm import memo

    exact = memo.of_runs
    monkeypatch.setattr(memo, "of_runs", lambda *a, **k: [exact(*a, **k)[0] & np.uint64(7 << 60), exact(*a, **k)[1]])
    codec = piece_bpe.PieceEncoder(vocabulary("piece_bpe_32k.model"))
    texts = ["the river and the house", "a river or a horse and the", "the the a"]
    for _ in range(2):
        assert [f.tolist() for f in codec.encode(common.whole(pa.array(texts)))] == codec.model.library.encode(texts, add_bos=True, add_eos=True)


@pytest.mark.parametrize("made", [lambda n: "the" * (n // 3), lambda n: "".join(random.Random(n).choices("abcdefghijklmnopqrstuvwxyz", k=n)), lambda n: " " * n, lambda n: "".join(random.Random(n).choices("theand ", k=n))])
def test_long_stretches_take_time_in_proportion(made):
    import time

    took = []
    for n in (60_000, 300_000):
        codec, text = piece_bpe.PieceEncoder(vocabulary("piece_bpe_32k.model")), made(n)
        codec.encode(common.whole(pa.array(["the" * 1000])))
        began = time.process_time()
        found = codec.encode(common.whole(pa.array([text])))[0].tolist()
        took.append(time.process_time() - began)
        assert found == codec.model.library.encode(text, add_bos=True, add_eos=True)
    assert took[1] < 12 * took[0] + 0.5  # a square would be 25 times


def test_stretches_about_the_longest_that_is_merged_in_rounds():
    codec = piece_bpe.PieceEncoder(vocabulary("piece_bpe_32k.model"))
    draw = random.Random(8)
    texts = ["".join(draw.choices(draw.choice(["the", "theandio ", " ", "abcdefghijklmnopqrstuvwxyz", "▁ et"]), k=draw.randint(505, 520))) for _ in range(300)]
    assert [f.tolist() for f in codec.encode(common.whole(pa.array(texts)))] == codec.model.library.encode(texts, add_bos=True, add_eos=True)


def test_documents_as_pieces(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    rows = piece_bpe.encode_documents(cases.docs(spark), vocabulary("piece_bpe_32k.model"), with_ids=True).collect()
    wanted = []
    for doc_id, text, *_ in cases.ROWS:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        wanted.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, wanted))
    assert piece_bpe.encode_documents(cases.empty(spark), vocabulary("piece_bpe_32k.model")).collect() == []


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    path = common.scratch(spark, "tokens")
    token_binary.write_token_files(cases.docs(spark), path, vocabulary("byte_bpe_50k.json"))
    found = token_binary.token_digests(spark, path).collect()
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    start, wanted = 0, []
    for doc_id, text, *_ in sorted(cases.ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        wanted.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


def test_token_files_can_be_read_in_part(spark):
    import pyarrow.parquet as pq

    path = common.scratch(spark, "tokens")
    token_binary.write_token_files(cases.docs(spark), path, vocabulary("byte_bpe_50k.json"))
    plan = token_binary.read_token_files(spark, path, ["doc_id", "n_tokens"]).where("doc_id = 5")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "EqualTo(doc_id,5)" in plan
    import glob

    files = [pq.ParquetFile(f) for f in glob.glob(path.removeprefix("file:") + "/*.parquet")]
    columns = {f.metadata.row_group(g).column(c).path_in_schema: f.metadata.row_group(g).column(c) for f in files for g in range(f.num_row_groups) for c in range(f.metadata.num_columns)}
    assert any("DELTA_BINARY_PACKED" in str(c.encodings) for n, c in columns.items() if n == "doc_id")
    assert any("DICTIONARY" in str(c.encodings) for n, c in columns.items() if n.startswith("ids"))
    assert all(c.has_offset_index for c in columns.values())


def test_empty_token_files(spark):
    path = common.scratch(spark, "tokens")
    token_binary.write_token_files(cases.empty(spark), path, vocabulary("byte_bpe_50k.json"))
    assert token_binary.token_digests(spark, path).collect() == []


def _totals(rollup):
    return {tuple(r) for r in rollup.totals().collect()}


def test_rollup_of_deltas(spark):
    rollup = token_counts.Rollup(spark, common.scratch(spark, "rollup"))
    assert _totals(rollup) == set()
    words = token_counts.count_words(cases.docs(spark))
    assert rollup.commit("one", token_counts.inserts(words)) and not rollup.commit("one", token_counts.inserts(words))
    by: dict = {}
    for _, text, lang, source in cases.ROWS:
        n, t = by.get((source, lang), (0, 0))
        # the operator's words are split at ASCII white space only
        by[source, lang] = (n + 1, t + len([w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").split(" ") if w]))
    assert _totals(rollup) == {(s, g, "words@1", n, t) for (s, g), (n, t) in by.items()}
    longer = words.withColumn("n_tokens", words["n_tokens"] + 1)
    assert rollup.commit("two", token_counts.revised(words, longer))
    assert _totals(rollup) == {(s, g, "words@1", n, t + n) for (s, g), (n, t) in by.items()}
    assert rollup.commit("three", token_counts.deletes(longer)) and rollup.commit("four", token_counts.inserts(words.where("false")))
    assert _totals(rollup) == set()
    with pytest.raises(ValueError, match="id"):
        rollup.commit("", token_counts.inserts(words))


def test_writers_of_a_rollup(spark):
    """Two writers that send the same batches, and a checkpoint within: each batch counts once, and the batches before it are one."""
    path = common.scratch(spark, "rollup")
    words = token_counts.count_words(cases.docs(spark))
    writers = [token_counts.Rollup(spark, path, checkpoint_every=3) for _ in range(2)]
    sent = [w.commit(f"a/b {k}", token_counts.inserts(words)) for k in range(3) for w in writers]
    assert sent == [True, False] * 3
    seen = writers[0].log.snapshot()
    assert writers[1].commit("late", token_counts.inserts(words))
    # one that has not seen the other's commit of the same batch
    assert writers[0].log.commit(seen, rows={"deltas": [("s", "l", "t", 1, 1)]}, txn="late") is None
    once, = token_counts.inserts(words).agg({"n_tokens": "sum"}).first()
    assert sum(r["n_tokens"] for r in writers[0].totals().collect()) == 4 * once
    assert all(writers[1].committed(x) for x in ("a/b 0", "a/b 2", "late")) and not writers[1].committed("a/b")


def test_counts_are_the_library_s(spark):
    import base64

    import public_tokenizers
    import tiktoken

    path = vocabulary("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = token_counts.count_tokens(cases.docs(spark), "t", path, public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in found) == sorted((r[0] or 0, len(library.encode_ordinary(r[1] or ""))) for r in cases.ROWS)
    assert token_counts.count_tokens(cases.empty(spark), "t", path, public_tokenizers.PATTERN).collect() == []


def test_query_of_totals_is_brute_force(spark, sf_dir):
    import base64

    import public_tokenizers
    import tiktoken

    from tessera.llm import queries

    with open(vocabulary("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted: dict = {}
    for r in common.table(spark, sf_dir, "documents").collect():
        text = r["text"] or ""
        for tokenizer, n in (("words@1", len(re.findall(common.WORD, text))), ("byte_bpe_50k@1", len(library.encode_ordinary(text)))):
            docs, total = wanted.get((r["source"], r["lang"], tokenizer), (0, 0))
            wanted[r["source"], r["lang"], tokenizer] = docs + 1, total + n
    found = queries.op1_token_counts(spark, sf_dir).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in found} == wanted and len(found) == len(wanted)
