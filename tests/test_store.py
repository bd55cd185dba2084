"""Stored tables: all or nothing, appended batches, conflicts, leftovers."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabulary.sources.store import Conflict, TableStore


@pytest.fixture
def store(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="tabulary-store-"))


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_refresh_replaces_and_keeps_the_version_before(spark, store):
    assert store.names() == [] and store.refresh({"a": numbers(spark, 1, 2), "b": numbers(spark)}) == {"a": 2, "b": 0}
    held = store.snapshot()
    assert store.refresh({"a": numbers(spark, 3)}) == {"a": 1}
    assert rows(store.read("a")) == [(3,)] and store.read("b").count() == 0
    assert rows(held["a"]) == [(1,), (2,)] == rows(store.read("a", version=1))       # a reader of the old version goes on
    store.refresh({"a": numbers(spark, 4)})
    store.refresh({"a": numbers(spark, 5)})
    assert rows(store.read("a", version=3)) == [(4,)] and store.names() == ["a", "b"]
    with pytest.raises(KeyError):
        store.read("a", version=1)


def test_a_writer_that_dies_between_two_tables_changes_nothing(spark, store, monkeypatch):
    store.refresh({"a": numbers(spark, 1), "b": numbers(spark, 1)})
    write = TableStore._write

    def dying(self, name, df, key, batch=None):
        if name == "b":
            raise OSError("lost")
        return write(self, name, df, key, batch)

    monkeypatch.setattr(TableStore, "_write", dying)
    with pytest.raises(OSError):
        store.refresh({"a": numbers(spark, 2), "b": numbers(spark, 2)})
    monkeypatch.undo()
    assert {n: rows(df) for n, df in store.snapshot().items()} == {"a": [(1,)], "b": [(1,)]}
    assert store.vacuum() == 1                                  # the folder of a
    store.refresh({"a": numbers(spark, 3), "b": numbers(spark, 3)})
    assert {n: rows(df) for n, df in store.snapshot().items()} == {"a": [(3,)], "b": [(3,)]}


def test_a_writer_that_dies_at_the_pointer_changes_nothing(spark, store, monkeypatch):
    store.refresh({"a": numbers(spark, 1)})
    create = TableStore._create

    def torn(self, name, text):
        create(self, name, text[:5] if name.startswith("_versions/") else text)
        if name.startswith("_versions/"):
            raise OSError("lost")

    monkeypatch.setattr(TableStore, "_create", torn)
    with pytest.raises((OSError, Conflict)):
        store.refresh({"a": numbers(spark, 2)})
    monkeypatch.undo()
    assert rows(store.read("a")) == [(1,)]
    store.refresh({"a": numbers(spark, 3)})
    assert rows(store.read("a")) == [(3,)]


def test_of_two_writers_one_fails(spark, store, monkeypatch):
    store.refresh({"a": numbers(spark, 1)})
    other, write = TableStore(spark, store._root), TableStore._write

    def late(self, *args):
        entry = write(self, *args)
        if self is store:
            other.refresh({"a": numbers(spark, 9)})             # publishes first
        return entry

    monkeypatch.setattr(TableStore, "_write", late)
    with pytest.raises(Conflict):
        store.refresh({"a": numbers(spark, 2)})
    assert rows(other.read("a")) == [(9,)]


def test_batches_are_appended_once_and_keys_go_on(spark, store):
    first = spark.createDataFrame([("b", 1), ("a", 2)], "name string, n int")
    second = spark.createDataFrame([(1, "d"), (None, None), (5, "c")], "n int, name string")
    assert store.append("t", first, "id", ["name"], "monday") == 2
    assert store.append("t", second, "id", ["name"], "tuesday") == 3
    assert store.append("t", second, "id", ["name"], "tuesday") == 0          # tried again
    assert store.append("t", first.limit(0), "id", ["name"], "empty") == 0
    assert store.append("t", first, "id", ["name"], "wednesday") == 2
    got = [(r.id, r.name, r.n) for r in store.read("t").orderBy("id").collect()]
    assert got == [(1, "a", 2), (2, "b", 1), (3, None, None), (4, "c", 5), (5, "d", 1), (6, "a", 2), (7, "b", 1)]
    with pytest.raises(ValueError, match="columns"):
        store.append("t", first.drop("n"), "id", ["name"], "thursday")


def test_an_append_that_dies_can_be_tried_again(spark, store, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",)], "name string")
    store.append("t", df, "id", ["name"], "one")
    monkeypatch.setattr(TableStore, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.append("t", df, "id", ["name"], "two")
    monkeypatch.undo()
    assert store.read("t").count() == 2
    assert store.append("t", df, "id", ["name"], "two") == 2
    assert [r.id for r in store.read("t").orderBy("id").collect()] == [1, 2, 3, 4]


def test_append_goes_on_after_a_refreshed_table(spark, store):
    table = spark.createDataFrame([(3, "x"), (41, "y")], "id long, name string")
    store.refresh({"known": table, "unknown": table}, keys={"known": "id"})
    for name in ("known", "unknown"):
        assert store.append(name, spark.createDataFrame([("z",)], "name string"), "id", ["name"], "b") == 1
        assert rows(store.read(name)) == [(3, "x"), (41, "y"), (42, "z")]
    assert store.vacuum() == 0 and set(os.listdir(store._root)) == {"_versions", "_manifests", "known", "unknown"}
    assert store.read("known").agg(F.max("id")).first()[0] == 42
