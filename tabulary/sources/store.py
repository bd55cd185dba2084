"""Stored tables that change all at once (survey A5, A6, A9).

A store is a folder.  Tables lie in versioned folders that are written once
and never changed; a manifest lists the folders of every table, each with its
batch, row count and greatest key.  A change writes new folders, then a new
manifest, then one pointer file with the next number, created only if it isn't
there.  Readers follow the last whole pointer.  So they see all tables of one
refresh or all of another, whatever a writer does or where it dies, and of two
writers that start from the same version one fails.

The manifest is also the ledger of appended batches: a batch that is in it
adds nothing when it is tried again.  Keys of an appended batch go on after
the table's greatest one.

The driver handles file names and counts only.  The store's file system must
create files exclusively (local disks and HDFS do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import with_dense_key


class Conflict(RuntimeError):
    """Another writer changed the store since this one read it."""


@dataclass
class Manifest:
    """Version 0 is the empty store.  ``tables``: per name the entries (path,
    batch, rows, key, max_key) of its folders, in order of writing."""

    version: int = 0
    tables: dict[str, list[dict]] = field(default_factory=dict)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jvm, self._path = jvm, jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self._root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ manifests

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self._root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self._root}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(f"{self._root}/{name}"), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> Manifest:
        """The last manifest, or that of an earlier version."""
        for name in reversed(self._names("_versions")):
            if version is None or int(name) == version:
                target = self._text(f"_versions/{name}")
                if target.endswith("\n"):            # else its writer died: the version was never there
                    return Manifest(int(name), json.loads(self._text(f"_manifests/{target.strip()}")))
        if version:
            raise KeyError(f"{self._root} has no version {version}")
        return Manifest()

    def _publish(self, before: Manifest, tables: dict[str, list[dict]]) -> None:
        name = f"{uuid.uuid4().hex}.json"
        self._create(f"_manifests/{name}", json.dumps(tables))
        taken = [int(n) for n in self._names("_versions")]
        # Broken pointers behind the version that was read are skipped; whole ones are another writer's.
        number = max([before.version, *taken]) + 1
        if self.manifest().version != before.version:
            raise Conflict(f"{self._root} was changed by another writer")
        try:
            self._create(f"_versions/{number:012d}", name + "\n")
        except Exception as e:
            if self._fs.exists(self._path(f"{self._root}/_versions/{number:012d}")):
                raise Conflict(f"{self._root} was changed by another writer") from e
            raise

    # -------------------------------------------------------------- reading

    def names(self) -> list[str]:
        return sorted(self.manifest().tables)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of the last version, or an earlier one."""
        return self._frame(self.manifest(version).tables[name])

    def snapshot(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of one version."""
        return {n: self._frame(entries) for n, entries in self.manifest(version).tables.items()}

    def _frame(self, entries: list[dict]) -> DataFrame:
        return self._spark.read.parquet(*(f"{self._root}/{e['path']}" for e in entries))

    # -------------------------------------------------------------- writing

    def _write(self, name: str, df: DataFrame, key: str | None, batch: str | None = None) -> dict:
        path = f"{name}/{uuid.uuid4().hex}"
        seen = Observation(f"write-{name}")
        counts = [F.count(F.lit(1)).alias("rows"), *([F.max(key).alias("max_key")] if key else [])]
        df.observe(seen, *counts).write.parquet(f"{self._root}/{path}")
        got = seen.get
        return {"path": path, "batch": batch, "rows": int(got["rows"]), "key": key,
                "max_key": int(got["max_key"] or 0) if key else None}

    def refresh(self, tables: Mapping[str, DataFrame], keys: Mapping[str, str] | None = None, keep: int = 2) -> dict[str, int]:
        """Replace ``tables`` all at once; the store's other tables stay.
        Returns row counts, observed during the writes, which run concurrently.

        ``keys`` names the tables' surrogate keys.  Folders that only versions
        before the last ``keep`` list are deleted.
        """
        before = self.manifest()
        with ThreadPoolExecutor(max_workers=4, thread_name_prefix="tabulary-write") as pool:
            futures = {n: pool.submit(self._write, n, df, (keys or {}).get(n)) for n, df in tables.items()}
            written = {n: f.result() for n, f in futures.items()}
        self._publish(before, {**before.tables, **{n: [e] for n, e in written.items()}})
        self._forget(keep)
        return {n: e["rows"] for n, e in written.items()}

    def append(self, name: str, rows: DataFrame, key: str, order: list[str | Column], batch: str) -> int:
        """Add ``rows`` to a table (a new one if it isn't there), with keys that
        follow ``order`` and go on after its greatest one.  Returns the number
        of rows added: 0 if ``batch`` has been appended already.

        Columns are matched by name and must be those of the table.
        """
        before = self.manifest()
        entries = before.tables.get(name, [])
        if any(e["batch"] == batch for e in entries):
            return 0
        if entries:
            stored = [c for c in self._frame(entries).columns if c != key]
            if sorted(stored) != sorted(rows.columns):
                raise ValueError(f"{name} has columns {sorted(stored)}, the batch {sorted(rows.columns)}")
            rows = rows.select(*stored)
        top = max((self._max_key(e, key) for e in entries), default=0)
        entry = self._write(name, with_dense_key(rows, key, order, start=top), key, batch)
        self._publish(before, {**before.tables, name: [*entries, entry]})
        return entry["rows"]

    def _max_key(self, entry: dict, key: str) -> int:
        if entry["key"] == key:
            return entry["max_key"]
        return int(self._frame([entry]).agg(F.max(key)).first()[0] or 0)

    def _delete(self, paths: set[str]) -> None:
        for path in paths:
            self._fs.delete(self._path(f"{self._root}/{path}"), True)

    def _forget(self, keep: int) -> None:
        """Delete the versions before the last ``keep`` and the folders that only they list."""
        names = self._names("_versions")
        whole = [(n, t.strip()) for n in names if (t := self._text(f"_versions/{n}")).endswith("\n")]

        def paths(manifests: list[tuple[str, str]]) -> set[str]:
            return {e["path"] for _, m in manifests for t in json.loads(self._text(f"_manifests/{m}")).values() for e in t}

        old = whole[:-keep]
        gone = paths(old) - paths(whole[-keep:])
        self._delete({f"_versions/{n}" for n, _ in old} | {f"_manifests/{m}" for _, m in old})
        self._delete(gone)

    def vacuum(self) -> int:
        """Delete what writers that died have left, folders and manifests that
        no version lists, and return their number.  No writer may be at work."""
        listed = {f"_manifests/{t.strip()}" for n in self._names("_versions") if (t := self._text(f"_versions/{n}")).endswith("\n")}
        kept = {e["path"] for m in listed for t in json.loads(self._text(m)).values() for e in t}
        found = {f"_manifests/{m}" for m in self._names("_manifests")} | {
            f"{table}/{v}" for table in self._names("") if not table.startswith("_") for v in self._names(table)}
        left = found - listed - kept
        self._delete(left)
        return len(left)
