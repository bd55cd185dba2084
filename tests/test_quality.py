import pytest
from pyspark.sql import functions as F

from tabulary.operators.quality import (CheckFailed, assert_checks, count_checks, duplicate_count,
                                        fk_check, with_expectations)
from tabulary.operators.reports import (group_counts, group_size_histogram, in_neither,
                                        oversized_groups, top_k, value_range)


def test_duplicates_counts_and_fk(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pk long, name string")
    child = spark.createDataFrame([(10, 1), (11, 1), (12, 9), (13, None), (14, 2)], "ck long, fk long")
    report = (duplicate_count(child, ["fk"], "dup fk")
              .unionByName(fk_check(child, "fk", parent, "pk", "broken fk"))
              .unionByName(count_checks(child, {"null fk": F.col("fk").isNull()})))
    got = dict((r.check_name, r.issue_count) for r in report.collect())
    assert got == {"dup fk": 1, "broken fk": 1, "null fk": 1}
    checked = with_expectations(report, {"dup fk": 1})
    with pytest.raises(CheckFailed, match="broken fk"):
        assert_checks(checked)


def test_reports(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pk long, name string")
    child = spark.createDataFrame([(1,), (1,), (1,), (1,), (2,)], "fk long")
    counts = group_counts(parent, "pk", "name", child, "fk", "n")
    assert [tuple(r) for r in top_k(counts, 2, "n", ["name"]).collect()] == [("a", 4), ("b", 1)]
    assert sorted(tuple(r) for r in group_size_histogram(child, "fk", "size").collect()) == [(1, 1), (4, 1)]
    assert oversized_groups(child, "fk", 3).first()[0] == 1
    other = spark.createDataFrame([(3,)], "fk long")
    assert [r.pk for r in in_neither(parent, "pk", child, other, "fk").collect()] == []
    assert [r.pk for r in in_neither(parent, "pk", child, child, "fk").collect()] == [3]
    r = value_range(spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double"), "x", "x").first()
    assert (r.min_x, r.max_x, r.avg_x) == (1.0, 2.0, 1.5)


def test_fk_checks_count_broken_children(spark):
    from tabulary.operators.quality import fk_checks
    p1 = spark.createDataFrame([(1,), (2,)], "pk long")
    p2 = spark.createDataFrame([(10,), (20,), (20,)], "pk long")
    child = spark.createDataFrame([(1, 10), (3, 20), (None, 30), (3, None), (2, 30)], "a long, b long")
    specs = [("a broken", "a", p1, "pk"), ("b broken", "b", p2, "pk")]
    want = {"a broken": 2, "b broken": 2}
    assert {r.check_name: r.issue_count for r in fk_checks(child, specs).collect()} == want


def test_duplicates_of_many_key_sets_in_one_aggregate(spark):
    from tabulary.operators.quality import duplicate_counts
    rows = [("a", None, 1), (None, "a", 1), ("a", None, 2), ("b", "b", 3), ("b", "b", 3), (None, None, 4), (None, None, 5),
            *(("hot", "x", 9) for _ in range(500))]
    t = spark.createDataFrame(rows, "p string, q string, n long")
    names = spark.createDataFrame([("Acme",), ("acme ",), ("Other",), (None,)], "name string") \
        .select(F.collate("name", "UTF8_LCASE_RTRIM").alias("name"))
    checks = [("p q", "t", ["p", "q"]), ("all", "t", ["p", "q", "n"]), ("n", "t", ["n"]), ("names", "names", ["name"]),
              ("none", "e", ["p"]), ("longs", "l", ["d", "n"])]
    tables = {"t": t, "names": names, "e": t.limit(0),
              "l": spark.createDataFrame([(1, None), (None, 1), (1, None), (None, None), (None, None), (2, 2)], "i int, n long")
              .select(F.date_from_unix_date("i").alias("d"), "n")}
    got = {r.check_name: r.issue_count for r in duplicate_counts(tables, checks).collect()}
    want = {name: duplicate_count(tables[tbl], keys, name).first().issue_count for name, tbl, keys in checks}
    assert got == want == {"p q": 4, "all": 2, "n": 3, "names": 1, "none": 0, "longs": 2}


def test_equal_hashes_of_different_keys_are_no_duplicates(spark, monkeypatch):
    from tabulary.operators import quality
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    t = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "n string")
    assert quality.duplicate_counts({"t": t}, [("n", "t", ["n"])]).first().issue_count == 1


def test_foreign_keys_of_many_relations_in_one_aggregate(spark):
    from tabulary.operators.quality import fk_counts
    tables = {
        "p": spark.createDataFrame([(1,), (2,), (2,), (None,)], "pk long"),
        "q": spark.createDataFrame([("x",), ("y",)], "pk string"),
        "c": spark.createDataFrame([(1, "x"), (7, "z"), (None, None), (2, None), *((7, "x") for _ in range(300))], "a int, b string"),
        "e": spark.createDataFrame([], "a int"),
    }
    relations = [("a", "c", "a", "p", "pk"), ("b", "c", "b", "q", "pk"), ("e", "e", "a", "p", "pk"), ("e in none", "c", "a", "e", "a")]
    got = {r.check_name: r.issue_count for r in fk_counts(tables, relations).collect()}
    want = {n: fk_check(tables[c], fk, tables[p], pk, n).first().issue_count for n, c, fk, p, pk in relations}
    assert got == want == {"a": 301, "b": 1, "e": 0, "e in none": 303}
    only = fk_counts(tables, relations[:1])
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan
    assert only.first().issue_count == 301
