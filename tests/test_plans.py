"""Plan-shape tests: the properties the scale design relies on."""

from pyspark.sql import functions as F

from tabulary.operators.dims import dedupe_by_key, load_dimension
from tabulary.operators.joins import resolve_fk
from tabulary.operators.keys import with_dense_key
from tabulary.operators.quality import fk_checks
from tabulary.sources.tables import table

from .conftest import SMOKE_DIR


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_dedupe_combines_map_side(spark):
    # one name holds a third of all rows
    rows = [("hot" if i % 3 == 0 else f"n{i}", f"s{i:06d}") for i in range(30000)]
    df = spark.createDataFrame(rows, "name string, slug string").repartition(8)
    out = dedupe_by_key(df, ["name"], ["slug"])
    plan = _plan(out)
    assert "partial_min" in plan                 # reduced inside each task before the shuffle
    assert "Window" not in plan
    got = {r.name: r.slug for r in out.collect()}
    assert got["hot"] == "s000000" and len(got) == 20001


def test_dense_key_partitions_stay_balanced_under_a_hot_prefix(spark):
    rows = [("hot" if i % 3 == 0 else f"n{i % 5000}", i) for i in range(30000)]
    df = spark.createDataFrame(rows, "name string, i int")
    out = with_dense_key(df, "id", ["name", "i"], num_partitions=8)
    sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 2 * (30000 / 8)         # the hot name is split across partitions
    assert sorted(r.id for r in out.select("id").collect()) == list(range(1, 30001))


def test_small_lookup_is_broadcast_and_checks_count_per_key(spark):
    dim = load_dimension(spark.createDataFrame([("a", "x"), ("b", "y")], "n string, s string"),
                         "n", "s", "id", "name")
    facts = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("c").alias("k"),
                                     (F.col("id") % 3).alias("fk"))
    assert "BroadcastHashJoin" in _plan(resolve_fk(facts, dim, "k", "name", "id", "left"))
    checks = fk_checks(facts, [("fk1", "fk", dim, "id"), ("fk2", "fk", dim, "id")])
    assert "partial_count" in _plan(checks)      # children are counted per key before the join


def test_scans_are_pruned_and_filters_pushed(spark):
    li = table(spark, SMOKE_DIR, "lineitem")
    q = li.filter(F.col("l_quantity") > 45).groupBy("l_partkey").count()
    plan = _plan(q)
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan
