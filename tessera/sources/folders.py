"""A folder tree as a table: a data source whose partitions are subtrees.

    folders.tree(spark, "/srv/checkout").where("path like 'src/%'")

Links are rows and are never followed, so loops end nothing but themselves; each has the place that it leads to. The folder must
be at the same place for the driver and all executors (a shared mount). A filter on the beginning of paths, or on a
path, prunes subtrees before they are looked at.
"""

from __future__ import annotations

import os
import stat
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringStartsWith

SCHEMA = "path string, kind string, bytes long, resolved string, inside boolean, present boolean"
_NOTHING = (None, None, None, None)
#: Subtrees that the driver cuts a tree into at least, if it has as many, and entries after which it lists no more folders for them.
SUBTREES, LISTED = 64, 1000


@dataclass
class Subtree(InputPartition):
    """Rows of known entries, and folders that are walked whole."""

    rows: list[tuple]
    folders: list[str]

    def __init__(self, rows: list[tuple], folders: list[str]):
        super().__init__(None)
        self.rows, self.folders = rows, folders


def _entry(root: str, path: str, entry: os.DirEntry) -> tuple:
    """The row of an entry. Kinds: file, folder, link, folder_link and other."""
    if not entry.is_symlink():
        info = entry.stat(follow_symlinks=False)
        kind = "folder" if stat.S_ISDIR(info.st_mode) else "file" if stat.S_ISREG(info.st_mode) else "other"
        return path, kind, info.st_size if kind == "file" else None, None, None, None
    # a loop's place is itself, which is neither file nor folder
    target = os.path.realpath(entry.path)
    inside = target == root or target.startswith(root.rstrip(os.sep) + os.sep)
    return path, "folder_link" if os.path.isdir(target) else "link", None, target, inside, os.path.exists(target)


def _children(root: str, folder: str) -> list[tuple] | None:
    """The entries of a folder in the order of their names; None if it can't be read."""
    try:
        with os.scandir(os.path.join(root, folder)) as found:
            entries = sorted(found, key=lambda e: e.name)
    except OSError:
        return None
    rows = []
    for e in entries:
        path = f"{folder}/{e.name}" if folder else e.name
        try:
            rows.append(_entry(root, path, e))
        except OSError:  # gone, or not to be looked at
            rows.append((path, "unreadable", *_NOTHING))
    return rows


class _Reader(DataSourceReader):
    def __init__(self, root: str, subtrees: int):
        self.root, self.subtrees = root, subtrees
        self.prefix, self.kinds = "", None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Paths' beginnings choose subtrees, and a kind chooses rows; Spark still applies what is given back."""
        for f in filters:
            if isinstance(f, (StringStartsWith, EqualTo)) and f.attribute == ("path",):
                self.prefix = max(self.prefix, f.value, key=len)
            elif isinstance(f, EqualTo) and f.attribute == ("kind",):
                self.kinds = {f.value}
            yield f

    def _may(self, folder: str) -> bool:
        """Whether a folder can hold wanted paths."""
        return not folder or f"{folder}/".startswith(self.prefix) or self.prefix.startswith(f"{folder}/")

    def _wanted(self, row: tuple) -> bool:
        return row[0].startswith(self.prefix) and (self.kinds is None or row[1] in self.kinds)

    def partitions(self) -> list[Subtree]:
        """The driver lists folders, upper levels first, until there are enough to deal out; what it lists are rows of the first partition."""
        if not os.path.isdir(self.root):
            raise ValueError(f"not a folder: {self.root}")
        rows, open_ = [], deque([""])
        while open_ and len(open_) < self.subtrees and len(rows) < LISTED:
            folder = open_.popleft()
            own = _children(self.root, folder)
            if own is None:
                rows.append((folder, "unreadable", *_NOTHING))
                continue
            rows += [r for r in own if self._wanted(r)]
            open_ += [r[0] for r in own if r[1] == "folder" and self._may(r[0])]
        return [Subtree(rows, []), *[Subtree([], [f]) for f in open_]]

    def read(self, partition: Subtree) -> Iterator[tuple]:
        yield from partition.rows
        todo = list(partition.folders)
        while todo:
            folder = todo.pop()
            own = _children(self.root, folder)
            if own is None:
                yield folder, "unreadable", *_NOTHING
                continue
            yield from (r for r in own if self._wanted(r))
            todo += [r[0] for r in own if r[1] == "folder" and self._may(r[0])]


class FolderTree(DataSource):
    """Columns: path below the folder, kind, bytes of files, and of links what they lead to (resolved), whether that is inside the
    folder, and whether anything is there. admission.link_verdicts takes these rows. A folder that can't be read has a row of its own kind, unreadable, beside that of the folder.

    Options: path, and subtrees, the least number of partitions that the driver tries for.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(os.path.realpath(self.options["path"]), int(self.options.get("subtrees", SUBTREES)))


def tree(spark: SparkSession, path: str, subtrees: int = SUBTREES) -> DataFrame:
    """The entries below a folder. The session then pushes filters down to Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FolderTree)
    return spark.read.format("folder_tree").option("subtrees", subtrees).load(path)
