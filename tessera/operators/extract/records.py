"""What extractors give out: the nodes, edges and references of one file, within its limits."""

from __future__ import annotations

import hashlib
import posixpath
from dataclasses import dataclass
from itertools import islice

from tessera.functions.numbers import canonical


@dataclass(frozen=True)
class Limits:
    """What one file may have; a file beyond them has no records but the outcome "unknown", with the reason "limit"."""

    records: int = 20_000
    bytes: int = 64 << 20
    candidates: int = 32
    syntax_nodes: int = 100_000


class Limit(Exception):
    """A file has more than one file may have, or a name that no record may have."""


def record_id(*parts: object) -> str:
    return "structural:" + hashlib.sha256((canonical(parts) + "\n").encode()).hexdigest()


def file_id(path: str) -> str:
    return record_id(path, "file", path)


def inside(base: str, path: str) -> str | None:
    """path from the folder base, normalised; None if it is empty, absolute, escapes the root or has \\ or %."""
    if not path or path.startswith("/") or "\\" in path or "%" in path:
        return None
    out = posixpath.normpath(posixpath.join(base, path))
    return None if out in (".", "..") or out.startswith("../") else out


def _checked(name: str) -> str:
    if not 0 < len(name) <= 4096 or min(name) < " ":
        raise Limit("name")
    return name


class Records:
    """One table a kind of record, from a record's key to the record: what has a known key changes nothing."""

    def __init__(self, path: str, limits: Limits = Limits()):
        self.path, self.folder, self.limits = path, posixpath.dirname(path), limits
        self.file = file_id(path)
        self.tables: dict[str, dict[object, dict]] = {"nodes": {self.file: {"id": self.file, "type": "file", "label": path}}, "edges": {}, "refs": {}}
        # the file's own node counts for nothing
        self.room, self.bytes, self.most, self.counted = limits.records, 0, 0, {"nodes": 1, "edges": 0, "refs": 0}

    def _put(self, table: str, key: object, record: dict) -> None:
        if key in self.tables[table]:
            return
        self.room -= 1
        self.tables[table][key] = record
        # bytes are counted once they could matter: a character is 12 at most
        self.most += 80 + sum(12 * len(v) + 3 if isinstance(v, str) else sum(12 * len(x) + 3 for x in v) if isinstance(v, list) else 20 for v in record.values())
        if self.room < 0 or self.most > self.limits.bytes and self._bytes() > self.limits.bytes:
            raise Limit(table)

    def _bytes(self) -> int:
        """The bytes of all records put in so far, those put in since the last call are counted by it."""
        for name, table in self.tables.items():
            new = list(islice(table.values(), self.counted[name], None))
            self.bytes += sum(len(canonical(r)) for r in new)
            self.counted[name] += len(new)
        return self.bytes

    def node(self, kind: str, label: str, *place: int, parent: str | None = None, by: str = "contains") -> str:
        """Adds a node below a parent (the file, if none is named) and gives its id."""
        identity = record_id(self.path, kind, _checked(label), *place)
        self._put("nodes", identity, {"id": identity, "type": kind, "label": label})
        self.edge(parent or self.file, identity, by)
        return identity

    def edge(self, source: str, target: str, kind: str) -> None:
        self._put("edges", (source, target, kind), {"source": source, "target": target, "type": kind})

    def reference(self, kind: str, target: str, line: int, candidates: list[str | None], resolution: str = "unique") -> None:
        known = list(filter(None, dict.fromkeys(candidates)))
        if len(known) > self.limits.candidates:
            raise Limit("candidates")
        self._put("refs", (kind, _checked(target), line), {"kind": kind, "target": target, "line": line, "candidates": known, "resolution": resolution})

    def fragment(self) -> dict:
        return {"outcome": "structural", "reason": None} | {name: list(table.values()) for name, table in self.tables.items()}
