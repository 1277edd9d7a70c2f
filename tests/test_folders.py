import os

import pytest

from tessera.sources import folders


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "root"
    for k in range(12):
        (root / f"d{k}" / "sub").mkdir(parents=True)
        for j in range(5):
            (root / f"d{k}" / "sub" / f"f{j}.txt").write_text("x" * j)
    (root / "top é.md").write_text("top")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "far.txt").write_text("far")
    links = {"loop": "loop", "round": ".", "d0/up": "..", "d1/out": "../../out", "d1/far": str(tmp_path / "out" / "far.txt"), "d2/near": "sub/f1.txt", "d2/gone": "nowhere", "d3/sub/a": "b", "d3/sub/b": "a"}
    for at, to in links.items():
        os.symlink(to, root / at)
    os.mkfifo(root / "d4" / "pipe")
    return root


def _read(spark, root, **options):
    return folders.tree(spark, str(root), **options)


def _walked(root):
    """By os.walk, which follows no links either."""
    out = {}
    for folder, below, files in os.walk(root):
        for name in below + files:
            full = os.path.join(folder, name)
            path = os.path.relpath(full, root)
            if os.path.islink(full):
                target = os.path.realpath(full)
                inside = target == str(root) or target.startswith(f"{root}/")
                out[path] = ("folder_link" if os.path.isdir(target) else "link", None, target, inside, os.path.exists(target))
            elif os.path.isdir(full):
                out[path] = ("folder", None, None, None, None)
            else:
                out[path] = ("file", os.path.getsize(full), None, None, None) if os.path.isfile(full) else ("other", None, None, None, None)
    return out


@pytest.mark.parametrize("subtrees", [1, 5, 1000])
def test_all_entries_and_where_links_lead(spark, tree, subtrees):
    df = _read(spark, tree, subtrees=subtrees)
    found = {r["path"]: tuple(r)[1:] for r in df.collect()}
    assert found == _walked(tree) and df.count() == len(found)
    assert found["round"] == ("folder_link", None, str(tree), True, True) and found["loop"] == ("link", None, f"{tree}/loop", True, False) and found["d1/out"][3] is False


def test_filters_prune_subtrees(spark, tree):
    own = _read(spark, tree).where("path like 'd1/%' and kind = 'file'")
    assert {r["path"] for r in own.collect()} == {f"d1/sub/f{j}.txt" for j in range(5)} and own.rdd.getNumPartitions() < 4
    assert [tuple(r)[:3] for r in _read(spark, tree).where("path = 'd7/sub/f3.txt'").collect()] == [("d7/sub/f3.txt", "file", 3)]
    reader = folders._Reader(str(tree), 64)
    assert list(reader.pushFilters([folders.StringStartsWith(("path",), "d1/")]))
    rows = [r[0] for p in reader.partitions() for r in reader.read(p)]
    assert "d1/sub/f0.txt" in rows and not [r for r in rows if not r.startswith("d1/")] and len(reader.partitions()) < 4


def test_unreadable_and_missing_folders(spark, tree, monkeypatch):
    real = os.scandir

    def scandir(path):
        if path.endswith("d5/sub"):
            raise PermissionError(path)
        return real(path)

    monkeypatch.setattr(os, "scandir", scandir)
    reader = folders._Reader(str(tree), 1)
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert ("d5/sub", "unreadable", *[None] * 4) in rows and ("d5/sub", "folder", *[None] * 4) in rows
    with pytest.raises(ValueError, match="not a folder"):
        folders._Reader(str(tree / "nothing"), 1).partitions()


def test_links_are_judged(spark, tree):
    from tessera.operators import admission

    found = {r["path"]: (r["rule"], r["outside"]) for r in admission.link_verdicts(_read(spark, tree), str(tree), [("exclude", "d2/*")]).collect()}
    assert set(found) == {p for p, x in _walked(tree).items() if "link" in x[0]}
    assert found["d1/out"] == ("outside-root-symlink-dir", True) and found["d1/far"] == ("symlink-not-followed", True)
    assert found["d2/near"] == ("policy-exclude:d2/*", False) and found["loop"] == ("symlink-not-followed", False)


def test_many_files(spark, tmp_path):
    for k in range(50):
        (tmp_path / f"d{k}").mkdir()
        for j in range(400):
            (tmp_path / f"d{k}" / f"{j}").touch()
    df = _read(spark, tmp_path)
    assert df.where("kind = 'file'").count() == 20_000 and df.rdd.getNumPartitions() > 40
