"""Distinct counts by bitmaps against plain ones."""

import random

from pyspark.sql import functions as F

from tabulary.operators.bitmaps import key_bitmaps, key_count, merged, summary

COLUMNS = {"n": ("count", "*"), "n_v": ("count", "v"), "low": ("min", "v"), "high": ("max", "v"), "total": ("sum", "v")}


def _plain(df):
    return df.agg(F.count("*"), F.count("v"), F.min("v"), F.max("v"), F.sum("v"), F.count_distinct("k")).first()


def test_summary_equals_count_distinct(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 32768, 32769, rng.randrange(1, 200000)]), rng.choice([None, rng.randrange(99)])) for _ in range(5000)]
    df = spark.createDataFrame([*rows, *[(7, 3)] * 3000], "k long, v int").repartition(5)
    for frame in (df, df.limit(0), df.where("k IS NULL")):
        got = summary(frame, "k", "keys", COLUMNS)
        assert tuple(got.first()) == tuple(_plain(frame))
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_of_loads_merge(spark):
    first, second = spark.range(1, 70001).toDF("k"), spark.range(50000, 100001).toDF("k")
    both = merged(key_bitmaps(first, "k"), key_bitmaps(second, "k"))
    assert key_count(both, "n").first().n == 100000 and both.count() == 4
    assert key_count(key_bitmaps(first.limit(0), "k"), "n").first().n == 0
