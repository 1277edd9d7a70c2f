import pytest

from tessera.operators import extract
from tessera.plans.samples import FILES


def _labels(path):
    return {(n["type"], n["label"]) for n in extract.fragment(path, FILES[path].encode())["nodes"][1:]}


def _refs(path):
    return {r["target"] for r in extract.fragment(path, FILES[path].encode())["refs"]}


def test_typescript():
    assert _labels("src/server.ts") == {
        ("export", "stop"), ("export", "limit"), ("export", "default"), ("export", "Server"), ("variable", "text"), ("variable", "rule"), ("variable", "more"), ("variable", "old"), ("variable", "shown"), ("variable", "limit"),
        ("function", "start"), ("class", "Server"), ("method", "Server.create"), ("method", "Server.run"), ("interface", "Shape"), ("type", "Name"), ("enum", "Level"), ("namespace", "Tools"), ("function", "Tools.mend"),
    }
    assert _refs("src/server.ts") == {"./files", "./kinds.js", "./setup", "react", "./parts", "./lazy", "../lib/old"}


def test_swift_and_go():
    assert _labels("ios/Shop.swift") == {("class", "Shop"), ("function", "Shop.open"), ("function", "Shop.sell"), ("enum", "Shop.State"), ("extension", "Shop.State"), ("function", "Shop.State.show"), ("protocol", "Buyer"), ("function", "Buyer.pay"), ("actor", "Till"), ("function", "Till.count")}
    assert _refs("ios/Shop.swift") == {"UIKit", "Core.Item"}
    assert _labels("cmd/main.go") == {("package", "main"), ("type", "Config"), ("type", "Code"), ("type", "List"), ("method", "List.Add"), ("function", "main")}
    assert _refs("cmd/main.go") == {"fmt", "example.org/shop/util"}


def test_shell_and_markdown():
    assert _labels("bin/run.sh") == {("function", "setup"), ("function", "clean")}
    assert _refs("bin/run.sh") == {"$(dirname $0)/lib.sh", "./shared.sh", "$HOME/.rc"}
    assert _labels("docs/guide.md") == {("heading", x) for x in ("Guide", "Second part", "Use of code", "Deep link", "Last")}
    found = extract.fragment("docs/guide.md", FILES["docs/guide.md"].encode())
    name = {n["id"]: n["label"] for n in found["nodes"]}
    assert {(name[e["source"]], name[e["target"]]) for e in found["edges"]} == {("docs/guide.md", "Guide"), ("Guide", "Second part"), ("Guide", "Use of code"), ("Use of code", "Deep link"), ("docs/guide.md", "Last")}
    assert _refs("docs/guide.md") == {"../src/server.ts", "./more.md", "more.md"}


def test_manifests_and_python():
    assert _labels("package.json") == {("dependency", "left"), ("dependency", "@in/right")}
    assert _labels("pyproject.toml") == {("dependency", x) for x in ("alpha", "beta", "gamma", "delta", "epsilon")}
    assert _labels("go.mod") == {("go_module", "example.org/shop"), ("dependency", "github.com/one/two"), ("dependency", "github.com/three/four")}
    assert _labels(".github/workflows/ci.yml") == {("action", "org/tool"), ("action", "docker://image:3")}
    assert _labels("pkg/a.py") == {("class", "One"), ("function", "One.two"), ("function", "One.two.three")}


def test_files_without_records():
    assert extract.fragment("x.py", b"def (:")["reason"] == "SyntaxError"
    assert extract.fragment("x.bin", b"")["reason"] == "unsupported"
    assert extract.fragment("x.py", b"\xff")["reason"] == "UnicodeDecodeError"
    assert extract.fragment("x.py", b"# BEGIN RSA PRIVATE KEY")["reason"] == "forbidden_marker"
    assert extract.fragment("x.ts", b"const a = `b")["reason"] == "SyntaxError"
    many = "\n".join(f"def f{k}(): pass" for k in range(10_001))
    assert extract.fragment("x.py", many.encode())["reason"] == "limit"


def _assembled(spark, files, slices):
    rows = spark.createDataFrame(list(files.items()), "path string, content string").selectExpr("path", "encode(content, 'UTF-8') content")
    index = spark.createDataFrame(list(slices.items()), "path string, slice string")
    return {(r["source_file"], r["target"], r["target_path"], r["outcome"]) for r in extract.assemble(extract.fragments(rows), index).collect()}


def test_assembly_resolves(spark):
    found = {(s, t): (p, o) for s, t, p, o in _assembled(spark, FILES, dict.fromkeys(FILES, "all"))}
    assert found["src/server.ts", "./parts"] == ("src/parts/index.ts", "link")
    assert found["src/server.ts", "./kinds.js"] == ("src/kinds.ts", "link")
    assert found["both.py", "twice"] == (None, "unresolved")  # two files could be meant
    assert found["bin/run.sh", "./shared.sh"] == ("bin/shared.sh", "link")
    assert found[".github/workflows/ci.yml", "./.github/actions/prepare"] == (".github/actions/prepare/action.yml", "link")
    assert found["src/server.ts", "react"] == (None, "unresolved")


@pytest.mark.parametrize("depth", [1, 2])
def test_slices_together_are_the_whole(spark, depth):
    slices = {p: "/".join(p.split("/")[:depth]) if "/" in p else "root" for p in FILES}
    whole = _assembled(spark, FILES, dict.fromkeys(FILES, "all"))
    parts = set()
    for part in set(slices.values()):
        parts |= _assembled(spark, {p: c for p, c in FILES.items() if slices[p] == part}, slices)
    plain = lambda rows: {(s, t, p, "link" if o == "cross" else o) for s, t, p, o in rows}
    assert plain(parts) == whole
    assert all((slices[s] == slices[p]) == (o == "link") for s, _, p, o in parts if p)


def test_order_of_candidates(spark):
    base = {"m/a.ts": "import x from './x';\nimport y from './y.js';\n"}
    for more, wanted in (({"m/x.ts": "", "m/x/index.ts": ""}, "m/x.ts"), ({"m/x/index.ts": ""}, "m/x/index.ts"), ({"m/x.ts": "", "m/x.tsx": ""}, "m/x.ts")):
        files = base | more
        assert ("m/a.ts", "./x", wanted, "link") in _assembled(spark, files, dict.fromkeys(files, "s"))
    files = base | {"m/y.js": "", "m/y.ts": ""}
    assert ("m/a.ts", "./y.js", "m/y.js", "link") in _assembled(spark, files, dict.fromkeys(files, "s"))


def test_reuse_is_the_same_as_extracting_again(spark):
    from pyspark.sql import functions as F

    from tessera.operators import state

    rows = lambda files: spark.createDataFrame(list(files.items()), "path string, content string").select("path", F.encode("content", "UTF-8").alias("content")).withColumn("key_sha256", state.fragment_key(F.col("path"), F.sha2("content", 256), "v1"))
    old = rows(FILES)
    cache = extract.fragments(old).join(old.select("path", "key_sha256"), "path")
    changed = {p: c for p, c in FILES.items() if p != "twice.py"} | {"src/files.ts": "export function open() {}\n", "new.md": "# New\n[x](both.py)\n"}
    now = rows(changed)
    miss = now.join(cache.select("key_sha256"), "key_sha256", "left_anti")
    both = cache.join(now.select("key_sha256"), "key_sha256", "left_semi").drop("key_sha256").unionByName(extract.fragments(miss))
    assert miss.count() == 2
    index = now.select("path", F.lit("all").alias("slice"))
    a, b = (set(extract.assemble(f, index).collect()) for f in (both, extract.fragments(now)))
    assert a == b


def test_graph_of_fragments(spark):
    from pyspark.sql import functions as F

    from tessera.operators import graph

    rows = spark.createDataFrame(list(FILES.items()), "path string, content string").select("path", F.encode("content", "UTF-8").alias("content"))
    nodes, links = extract.graph(extract.fragments(rows), rows.select("path", F.lit("all").alias("slice")))
    graph.check(nodes, links.withColumn("ord", F.monotonically_increasing_id()))


def _markdown(text, path="docs/a.md", **more):
    found = extract.fragment(path, text.encode(), **more)
    assert found["outcome"] == "structural"
    name = {n["id"]: n["label"] for n in found["nodes"]}
    return [n["label"] for n in found["nodes"][1:]], {(name[e["source"]], name[e["target"]]) for e in found["edges"]}, {(r["target"], r["line"], *r["candidates"]) for r in found["refs"]}


def test_markdown_lines():
    heads = lambda t: _markdown(t)[0]
    assert heads("para one\npara two\n---\n") == []  # more than one line above
    assert heads("- item\n---\n") == heads("1. item\n===\n") == heads("> q\n---\n") == heads("| a |\n---\n") == []
    assert heads("one\n---\ntwo\n===\n") == ["one", "two"] and heads("\n---\n") == []
    assert heads("# **Bold** _it_ `code` [text](x.md) ![pic](p.png) ##") == ["**Bold** _it_ code text pic"]
    assert heads("#no\n####### seven\n    # code\n   ### three #\n#\n## ##\n") == ["three"]
    assert heads("```\n# no\n~~~\n````\n# yes\n<!-- # no\n# no\n--> x\n# after <!-- c --> it\n") == ["yes", "after it"]
    assert heads("---\n# no\n...\n# yes") == ["yes"] and heads("---\n# open") == ["open"]
    _, edges, _ = _markdown("# a\n### b\n## c\n### d\n# e\n## f\n")
    assert edges == {("docs/a.md", "a"), ("a", "b"), ("a", "c"), ("c", "d"), ("docs/a.md", "e"), ("e", "f")}


def test_markdown_links():
    links = lambda t, **m: _markdown(t, **m)[2]
    assert links("see [text][name] and [name]\n\n[name]: ./b.md\n[unused]: c.md 'T'\n[^1]: note.md\n") == {("./b.md", 3, "docs/b.md"), ("c.md", 4, "docs/c.md")}
    assert links('[a](<b.md> "t") [c]( ../d.md#x ) [e](f.md?q "u" x) ![i](j.png) [k](http://l) [m](/n) [o](#p) [q](../../r.md) `[s](t.md)`') == {("b.md", 1, "docs/b.md"), ("../d.md#x", 1, "d.md"), ("../../r.md", 1)}
    assert links("[![i](j.png)](k.md)") == {("j.png", 1, "docs/j.png")}
    first = {"family": "1"}
    assert links('[a](b.md) [c](d.md "t")\n[n]: e.md\n# [h](i.md)\n```\n[x](y.md)\n```\n', **first) == {("b.md", 1, "docs/b.md"), ("i.md", 3, "docs/i.md")} and _markdown("# a", **first)[0] == []
    assert extract.fragment("a.go", b"package a", family="1")["reason"] == "unsupported"


def test_shell_lines():
    def refs(text):
        found = extract.fragment("bin/a.sh", text.encode())
        return {(r["target"], r["line"], *r["candidates"]) for r in found["refs"]}, [n["label"] for n in found["nodes"][1:]]

    assert refs('if x; then . ./a.sh; fi\nx && source b.sh # . no.sh\necho . no.sh\necho "\n. no.sh\n"\n. "${BASH_SOURCE%/*}/c.sh"\n(. d.sh)\n. /abs.sh\n')[0] == {
        ("./a.sh", 1, "bin/a.sh", "a.sh"), ("b.sh", 2, "bin/b.sh", "b.sh"), ("${BASH_SOURCE%/*}/c.sh", 7, "bin/c.sh"), ("d.sh", 8, "bin/d.sh", "d.sh"), ("/abs.sh", 9),
    }
    assert refs("cat <<-'E' <<F\n. no.sh\n\tE\n. no.sh\nF\n. y.sh\ncat <<< x\n. z.sh\n")[0] == {("y.sh", 6, "bin/y.sh", "y.sh"), ("z.sh", 8, "bin/z.sh", "z.sh")}
    assert refs('. "$(dirname "${BASH_SOURCE[0]}")/e f.sh"\n. $(cd x)/g.sh\n. *.sh\n')[0] == {("$(dirname ${BASH_SOURCE[0]})/e f.sh", 1, "bin/e f.sh"), ("$(cd x)/g.sh", 2), ("*.sh", 3)}
    assert refs("f() {\n:\n}\nfunction g-h {\n:\n}\nfunction i() (\n:\n)\nj ()\n{\n:\n}\nk() echo\necho l() {\n'\nm() {\n'\n")[1] == ["f", "g-h", "i", "j"]


def test_manifest_names():
    labels = lambda path, text: [n["label"] for n in extract.fragment(path, text.encode())["nodes"][1:]]
    assert labels("package.json", '{"dependencies": {"ok": "1", "@a/b": "1", "a/b": "1", "-x": "1", "": "1", "~t": 1}, "devDependencies": []}') == ["ok", "@a/b", "~t"]
    assert extract.fragment("package.json", b"{")["reason"] == "SyntaxError"
    assert labels("pyproject.toml", '[project]\ndependencies = [" Req.uests>=1", "-bad", "x_"]\n[dependency-groups]\ndev = ["y", {include-group = "z"}]\n[tool.poetry.group.t.dependencies]\npython = "1"\nw = "2"\n') == ["Req.uests", "x", "y", "w"]
    assert labels("go.mod", 'module "a.b/c"\nmodule d\nrequire(\n"e.f/g" v1\n)\nreplace (\nh => i\n)\nrequire j v2 // x\nrequire !k v1\n') == ["a.b/c", "e.f/g", "j"]
    assert labels(".github/workflows/w.yml", "a:\n - uses: o/a@v1 # c\n - uses: 'o/b/c@v1'\n - uses: single\n - uses: o/d extra\n - name: >-\n     uses: o/no\n - key: |2\n    uses: o/no\n   uses: o/no\n - uses:  docker://x:1\n") == ["o/a", "o/b/c", "docker://x:1"]


def test_limits_of_a_file():
    from tessera.operators.extract.records import Limits, Records

    out = Records("a/b.py")
    out.reference("imports", "x", 1, [f"c{k}" for k in range(32)])
    with pytest.raises(Exception, match="candidates"):
        out.reference("imports", "y", 1, [f"c{k}" for k in range(33)])
    for bad in ("", "a\nb", "x" * 4097):
        with pytest.raises(Exception, match="name"):
            out.node("function", bad)
    text = b"def f(): pass\ndef g(): pass\n"
    assert extract.fragment("x.py", text, Limits(records=4))["outcome"] == "structural"
    for small in (Limits(records=3), Limits(bytes=100), Limits(syntax_nodes=2)):
        assert extract.fragment("x.py", text, small) == {"outcome": "unknown", "reason": "limit", "nodes": [], "edges": [], "refs": []}


def test_names_of_files_are_the_records_own(spark):
    from tessera.operators.extract.records import file_id

    paths = ["a/b.py", 'q"u.md', "é/😀.go", "back\\slash"]
    found = spark.createDataFrame([(p,) for p in paths], "p string").select("p", extract.file_name("p").alias("id")).collect()
    assert all(r["id"] == file_id(r["p"]) for r in found)


def test_long_lines_without_code_are_not_gone_through_by_character(monkeypatch):
    import sys

    import tessera.operators.extract  # noqa: F401

    markdown, records = (sys.modules[f"tessera.operators.extract.{n}"] for n in ("markdown", "records"))
    line = "word " * 400_000
    calls = []
    trace = lambda frame, event, arg: (calls.append(frame.f_lineno), trace)[1] if frame.f_code is markdown._without_code.__code__ else None
    before = sys.gettrace()
    sys.settrace(trace)
    try:
        assert markdown._without_code("a `b` c " + line) == "a  c " + line
        assert markdown._without_code(line) == line
    finally:
        sys.settrace(before)
    assert len(calls) < 100
    assert markdown._kind(1, "  \tx").kind == "code" and markdown._kind(1, " #\tx").kind == "heading"


def test_bytes_of_records_are_counted_where_they_matter(monkeypatch):
    import sys

    import tessera.operators.extract  # noqa: F401

    records = sys.modules["tessera.operators.extract.records"]
    for room in (range(0, 700, 7)):
        out, left, fits = records.Records("a.md", records.Limits(bytes=room)), room, True
        try:
            for k in range(3):
                out.reference("k", "é" * k + "t", k, [f"c{k}"])
        except records.Limit:
            fits = False
        for k in range(3):
            left -= len(records.canonical({"kind": "k", "target": "é" * k + "t", "line": k, "candidates": [f"c{k}"], "resolution": "unique"}))
        assert fits == (left >= 0)
    monkeypatch.setattr(records, "canonical", lambda r: (_ for _ in ()).throw(AssertionError("a small record was written out")) if isinstance(r, dict) else "x")
    records.Records("a.md").reference("k", "t", 1, ["c"])
