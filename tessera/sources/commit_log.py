"""Tables that many writers append to: a numbered log of create-only version files over immutable data.

A commit is one file of the log, named by the next free number. It names the data folders and holds the few rows that it adds to
the log's tables, so all of it is seen or nothing. A writer that finds its number taken reads what came meanwhile: if that
is no conflict with what it has read, it takes the next number, else it gets a Conflict and works on from a new snapshot.
Data is written before the log; folders that no version names are seen by nobody.

A checkpoint holds what all versions up to its own come to, with rows of the log and small folders rewritten to one folder of each
table, so a reader opens one checkpoint and the versions after it, however long the log is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import outputs
from tessera.sources.scratch import drop

#: Rows' places: the version that brought them, and their order within it.
PLACE = "_version long, _at long"
_APPLIED = "_applied"


class Conflict(Exception):  # noqa: N818
    """Another writer's commit changed what this one was made from."""


@dataclass
class Change:
    """What one version adds: folders as {table, folder, rows}, rows of the log by table, and sums to add to totals."""

    version: int
    folders: list[dict] = field(default_factory=list)
    rows: dict[str, list[list]] = field(default_factory=dict)
    sums: dict[str, int] = field(default_factory=dict)
    txn: str | None = None

    def adds_to(self, table: str) -> bool:
        return bool(self.rows.get(table)) or any(f["table"] == table for f in self.folders)


@dataclass
class Snapshot:
    """The tables as of a version; -1 before the first commit."""

    log: CommitLog
    version: int
    folders: list[dict]
    rows: dict[str, list[list]]
    sums: dict[str, int]
    txns: set[str]

    def table(self, name: str) -> DataFrame:
        """A table's rows, with their places."""
        spark, schema = self.log.spark, f"{self.log.schemas[name]}, {PLACE}"
        own = [f for f in self.folders if f["table"] == name]
        found = spark.createDataFrame(self.rows.get(name, []), schema)
        if own:
            stored = spark.read.schema(schema).parquet(*[f"{self.log.path}/data/{f['folder']}" for f in own])
            # one row for each folder, of which checkpoints leave few
            versions = spark.createDataFrame([(f["folder"], f["version"]) for f in own], "_folder string, _since long")
            placed = stored.withColumn("_folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)).join(F.broadcast(versions), "_folder")
            found = found.unionByName(placed.withColumn("_version", F.coalesce("_version", "_since")).select(*found.columns))
        return found

    def applied(self, txn: str) -> bool:
        """Whether a transaction was committed. Only those that a checkpoint has passed need a look at their table."""
        if txn in self.txns:
            return True
        passed = Snapshot(self.log, self.version, [f for f in self.folders if f["table"] == _APPLIED], {}, {}, set())
        return bool(passed.folders) and bool(passed.table(_APPLIED).where(F.col("txn") == txn).take(1))


class CommitLog:
    """Append-only tables below path, in a store that driver and executors share and whose renames are atomic.

    schemas: the columns of each table. Every checkpoint_every versions a commit writes a checkpoint too; folders of fewer than
    small rows are rewritten by it, as merges[table](rows) if there is one, which must not change what readers work out.
    """

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, str], checkpoint_every: int = 50, small: int = 1_000_000, merges: dict[str, Callable[[DataFrame], DataFrame]] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.schemas = {**schemas, _APPLIED: "txn string"}
        self.every, self.small, self.merges = checkpoint_every, small, merges or {}

    def _at(self, version: int) -> str:
        return f"{self.path}/log/{version:020d}.json"

    def change(self, version: int) -> Change | None:
        found = outputs.read(self.spark, self._at(version))
        return Change(version=version, **json.loads(found)) if found is not None else None

    def _checkpointed(self) -> Snapshot:
        fs, at = outputs.file_system(self.spark, self.path)
        folder = at(f"{self.path}/checkpoints")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
        if not names:
            return Snapshot(self, -1, [], {}, {}, set())
        known = json.loads(outputs.read(self.spark, f"{self.path}/checkpoints/{max(names)}"))
        return Snapshot(self, known["version"], known["folders"], {}, known["sums"], set())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The tables as of the newest version, or of an older one that no checkpoint has passed."""
        s = self._checkpointed()
        if version is not None and version < s.version:
            raise ValueError(f"a checkpoint has passed version {version}")
        while s.version != version and (c := self.change(s.version + 1)) is not None:
            s.version = c.version
            s.folders += [f | {"version": c.version} for f in c.folders]
            for table, rows in c.rows.items():
                s.rows.setdefault(table, []).extend([*r, c.version, k] for k, r in enumerate(rows))
            if c.txn is not None:
                s.txns.add(c.txn)
                s.rows.setdefault(_APPLIED, []).append([c.txn, c.version, 0])
            for name, n in c.sums.items():
                s.sums[name] = s.sums.get(name, 0) + n
        return s

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        """A new data folder, and its number of rows."""
        folder = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data/{folder}")
        return folder, self.spark.read.parquet(f"{self.path}/data/{folder}").count()

    def commit(
        self, seen: Snapshot, frames: dict[str, DataFrame] | None = None, rows: dict[str, Sequence[tuple]] | None = None, sums: dict[str, int] | Callable[[dict[str, int]], dict[str, int]] | None = None,
        txn: str | None = None, conflicts: Callable[[Change], bool] = lambda change: False,
    ) -> int | None:
        """Adds frames, which become data folders, and a few rows to tables; the version, or None if txn was committed before.

        A later change than seen that conflicts raises Conflict, and what was written is dropped. sums may be made from the
        numbers of rows written by table.
        """
        if txn is not None and seen.applied(txn):
            return None
        folders = []
        for table, df in (frames or {}).items():
            names = [c.name for c in self.spark.createDataFrame([], self.schemas[table]).schema]
            folder, n = self._write(df.select(*names, F.lit(None).cast("long").alias("_version"), F.monotonically_increasing_id().alias("_at")))
            folders.append({"table": table, "folder": folder, "rows": n})
        own = sums({f["table"]: f["rows"] for f in folders}) if callable(sums) else sums or {}
        doc = json.dumps({"folders": folders, "rows": {t: [list(r) for r in x] for t, x in (rows or {}).items() if x}, "sums": own, "txn": txn}).encode()
        version = seen.version + 1
        while not outputs.put_if_absent(self.spark, self._at(version), doc):
            other = self.change(version)
            same = txn is not None and other.txn == txn
            if same or conflicts(other):
                for f in folders:
                    drop(self.spark, f"{self.path}/data/{f['folder']}")
                if same:
                    return None
                raise Conflict(f"version {version}")
            version += 1
        if (version + 1) % self.every == 0:
            self.checkpoint(version)
        return version

    def retried(self, attempt: Callable[[Snapshot], object], tries: int = 100):
        """attempt(snapshot) from new snapshots until it meets no conflict."""
        for _ in range(tries):
            try:
                return attempt(self.snapshot())
            except Conflict:
                continue
        raise Conflict(f"{tries} tries")

    def checkpoint(self, version: int | None = None) -> int:
        """Writes what all versions up to this one come to. Readers find the same tables as before."""
        s = self.snapshot(version)
        folders = []
        for table in self.schemas:
            own = [f for f in s.folders if f["table"] == table]
            few = [f for f in own if f["rows"] < self.small]
            folders += [f for f in own if f["rows"] >= self.small]
            if s.rows.get(table) or len(few) > 1:
                part = Snapshot(self, s.version, few, s.rows, {}, set()).table(table)
                folder, n = self._write(self.merges[table](part) if table in self.merges else part)
                folders.append({"table": table, "folder": folder, "rows": n, "version": s.version})
            else:
                folders += few
        doc = json.dumps({"version": s.version, "folders": folders, "sums": s.sums}).encode()
        if s.version >= 0 and not outputs.put_if_absent(self.spark, f"{self.path}/checkpoints/{s.version:020d}.json", doc):
            known = {f["folder"] for f in s.folders}
            for f in folders:  # another writer's is as good
                if f["folder"] not in known:
                    drop(self.spark, f"{self.path}/data/{f['folder']}")
        return s.version

    def vacuum(self, older_than_ms: int) -> list[str]:
        """Deletes data folders that the newest snapshot does not name and that were last written to before a time, versions that
        the newest checkpoint has passed, and checkpoints before it. Snapshots taken before are of no use then."""
        fs, at = outputs.file_system(self.spark, self.path)
        s = self.snapshot()
        named, gone = {f["folder"] for f in s.folders}, []
        passed = self._checkpointed().version
        late = lambda name: int(name.split(".")[0]) <= passed
        for sub, stays in (("data", lambda n: n in named), ("log", lambda n: not late(n)), ("checkpoints", lambda n: int(n.split(".")[0]) >= passed)):
            for f in fs.listStatus(at(f"{self.path}/{sub}")) if fs.exists(at(f"{self.path}/{sub}")) else []:
                name = f.getPath().getName()
                if not name.startswith(".") and f.getModificationTime() < older_than_ms and not stays(name):
                    fs.delete(f.getPath(), True)
                    gone.append(f"{sub}/{name}")
        return gone


