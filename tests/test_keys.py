import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulary.operators.keys import KeyOrder, derived, key_order, known_max_key, with_dense_key, with_inherited_key
from tabulary.operators.reports import joined_preview


def test_dense_key_follows_order_across_partitions(spark):
    vals = list(range(5000))
    random.Random(7).shuffle(vals)
    df = spark.createDataFrame([(v, f"n{v:05d}") for v in vals], "v int, name string").repartition(13)
    out = with_dense_key(df, "id", ["name"], num_partitions=7)
    got = sorted((r.id, r.v) for r in out.collect())
    assert got == [(i + 1, i) for i in range(5000)]
    assert known_max_key(out) == 5000


def test_dense_key_start_and_rerun_stable(spark):
    df = spark.createDataFrame([(f"k{i % 97}", i) for i in range(1000)], "k string, i int")
    a = {(r.k, r.i): r.id for r in with_dense_key(df, "id", ["k", "i"], start=100).collect()}
    b = {(r.k, r.i): r.id for r in with_dense_key(df, "id", ["k", "i"], start=100).collect()}
    assert a == b and sorted(a.values()) == list(range(101, 1101))


def test_dense_key_empty_input(spark):
    df = spark.createDataFrame([], "k string")
    assert with_dense_key(df, "id", ["k"]).count() == 0


def test_keyed_table_prunes_its_staging_files(spark):
    df = spark.createDataFrame([(i, f"s{i}", "wide") for i in range(20)], "i int, s string, w string")
    plan = with_dense_key(df, "id", ["i"]).select("id", "s")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<s:string,__pid:int,__pos:bigint>" in plan


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(-50, 50)),
                min_size=0, max_size=60, unique=True))
def test_dense_key_matches_sorted_rank(spark, data):
    df = spark.createDataFrame(data, "s string, n int")
    out = with_dense_key(df, "id", ["s", "n"], num_partitions=4)
    got = sorted((r.id, r.s, r.n) for r in out.collect())
    want = sorted(data, key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    assert got == [(i + 1, s, n) for i, (s, n) in enumerate(want)]


def test_staging_can_be_cleared(spark):
    import os

    from tabulary.sources.staging import clear_staged, staged
    df = staged(spark.range(5), "probe")
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    clear_staged(spark)
    assert not os.path.exists(path)


@pytest.mark.parametrize("partition_bytes", ["128m", "30k"])
def test_inherited_keys_are_those_of_a_sort_without_a_shuffle(spark, partition_bytes):
    rng = random.Random(3)
    rows = [(f"n{i:06d}", "x" * rng.randrange(40), rng.choice([0, 0, 1, 2, 5])) for i in range(20000)] + [("m", "hot", 9000)]
    df = spark.createDataFrame(rows, "name string, w string, n int").repartition(5)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "40000")                # several row groups a file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", partition_bytes)
    try:
        parents = with_dense_key(df, "id", ["name"], num_partitions=4)
        parents = derived(parents, lambda f: f.withColumn("up", F.upper("name")))

        def children(frame, keep):
            return (frame.where("n > 0").select("id", *keep, "up", F.posexplode(F.sequence(F.lit(1), F.col("n"))).alias("pos", "v"))
                    .where("v % 7 <> 3"))

        plans = []
        out = with_inherited_key(parents, "child_id", lambda f, k: plans.append(c := children(f, k)) or c, ["id", "pos"])
        plan = plans[0]._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "BroadcastExchange" in plan
        got = {(r.id, r.pos): (r.child_id, r.up) for r in out.collect()}
        plain = parents.select("id", "up", "n", "name")          # knows nothing of the order
        want = {(r.id, r.pos): (r.child_id, r.up) for r in with_inherited_key(plain, "child_id", children, ["id", "pos"]).collect()}
        assert got == want and sorted(k for k, _ in got.values()) == list(range(1, len(got) + 1))
        assert known_max_key(out) == len(got)
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_inherited_keys_of_no_children(spark):
    parents = with_dense_key(spark.createDataFrame([("a",), ("b",)], "name string"), "id", ["name"])
    out = with_inherited_key(parents, "k", lambda f, keep: f.select("id", *keep, F.lit(0).alias("pos")).where("id > 9"), ["id", "pos"])
    assert out.count() == 0 and out.columns == ["k", "id", "pos"]


def _ordered_tables(spark, parents=12000, first_with_children=0):
    names = spark.range(parents).select(F.format_string("n%06d", "id").alias("name"), F.col("id").alias("i")).repartition(6)
    parent = with_dense_key(names, "id", ["name"], num_partitions=6)
    child = with_inherited_key(
        parent, "child_id", lambda f, keep: f.where(f"i >= {first_with_children}").select("id", *keep, F.posexplode(
            F.transform(F.sequence(F.lit(0), F.lit(2)), lambda x: (x * 7 + F.col("i")) % 3)).alias("pos", "v")), ["id", "pos"])
    return parent, derived(child, lambda f: f.drop("pos"))


def test_the_first_parts_of_a_table_in_key_order(spark):
    parent, child = _ordered_tables(spark)
    part, whole = key_order(child).first(10)
    keys = sorted(r.child_id for r in part.select("child_id").collect())
    assert not whole and 10 <= len(keys) < 36000 and keys == list(range(1, len(keys) + 1))
    assert "LessThan" in part._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1].split("ReadSchema")[0]
    assert key_order(child).first(36000)[1] and key_order(child).first(10 ** 9)[0].count() == 36000
    head = sorted(r.id for r in key_order(parent).upto(10).select("id").collect())
    assert head == list(range(1, len(head) + 1)) and 10 <= len(head) < 12000


@pytest.mark.parametrize("first_with_children, hidden", [(0, 0), (11990, 0), (0, 9000), (0, 12000), (12000, 0)])
def test_previews_read_the_first_parts_and_equal_the_full_join(spark, first_with_children, hidden, monkeypatch):
    """Children from late parents on, and parents that are there from a late key on."""
    parent, child = _ordered_tables(spark, first_with_children=first_with_children)
    if hidden:
        there = parent.where(F.col("id") > hidden)          # no order is known of it
    else:
        there = parent
    order = ["id", "v", "child_id"]
    read, first = [], KeyOrder.first
    monkeypatch.setattr(KeyOrder, "first", lambda self, n: (lambda x: read.append(x) or x)(first(self, n)))
    got = joined_preview(there, child, "id", ["id", "name", "v", "child_id"], order, 7)
    want = there.select("id", "name").join(child, "id").select("id", "name", "v", "child_id").orderBy(*order).limit(7)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert read and (hidden or first_with_children or not any(whole for _, whole in read))
