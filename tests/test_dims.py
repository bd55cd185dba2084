"""Dimension, lookup and junction cases (FIXTURES.md section 5)."""


from tabulary.functions.text import NBSP
from tabulary.operators.dims import backfill_dimension, dedupe_by_key, load_dimension
from tabulary.operators.joins import build_junction, resolve_fk


def _dim(spark, rows, key="id"):
    df = spark.createDataFrame(rows, "Name string, Slug string")
    return load_dimension(df, "Name", "Slug", key, "name")


def test_load_dimension_cleans_dedupes_and_keys(spark):
    dim = _dim(spark, [("Beta", "b-2"), (f"Beta{NBSP}", "b-1"), ("  Alpha ", "a"), (None, "x"),
                       ("", "y"), ("   ", "z"), (f"{NBSP}Gamma", None), ("Gamma", "g")])
    got = sorted(tuple(r) for r in dim.select("id", "name", "slug").collect())
    # NULL slug sorts first, as in the modelled window order
    assert got == [(1, "Alpha", "a"), (2, "Beta", "b-1"), (3, "Gamma", None)]


def test_dedupe_by_key_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([("k", "s", 2), ("k", "s", 1), ("j", None, 5), ("j", "a", 0)],
                               "k string, s string, v int")
    got = sorted(tuple(r) for r in dedupe_by_key(df, ["k"], ["s"]).collect())
    assert got == [("j", None, 5), ("k", "s", 1)]


def test_backfill_adds_members_with_null_slug(spark):
    dim = _dim(spark, [("Beta", "b"), ("Alpha", "a")])
    values = spark.createDataFrame([("Zeta",), ("Beta",), ("Delta",), ("",), (None,), ("Zeta",)],
                                   "name string")
    got = sorted(tuple(r) for r in backfill_dimension(dim, values, "id", "name").collect())
    assert got == [(1, "Alpha", "a"), (2, "Beta", "b"), (3, "Delta", None), (4, "Zeta", None)]


def test_resolve_fk_inner_drops_and_left_keeps_misses(spark):
    dim = _dim(spark, [("Acme", "acme"), ("Globex", "globex")])
    facts = spark.createDataFrame([(1, "Acme"), (2, "Initech"), (3, None), (4, "Globex")],
                                  "fid int, maker string")
    left = sorted(tuple(r) for r in resolve_fk(facts, dim, "maker", "name", "id", "left").collect())
    inner = sorted(tuple(r) for r in resolve_fk(facts, dim, "maker", "name", "id", "inner").collect())
    assert left == [(1, 1), (2, None), (3, None), (4, 2)]
    assert inner == [(1, 1), (4, 2)]


def test_junction_distinct_pairs_and_unknown_sides(spark):
    g = _dim(spark, [("aspirin", "a"), ("ibuprofen", "i")], "generic_id")
    ind = _dim(spark, [("fever", "f"), ("pain", "p")], "indication_id")
    pairs = spark.createDataFrame(
        [("aspirin", "pain"), ("aspirin", "pain"), ("aspirin", "fever"), ("ibuprofen", "pain"),
         ("unknown", "pain"), ("aspirin", "cough")], "g string, i string")
    out = build_junction(pairs, g, "g", "name", "generic_id", ind, "i", "name", "indication_id", "pid")
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, 1, 1), (2, 1, 2), (3, 2, 2)]


def _no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    return lambda: spark.conf.set(key, old)


def test_shuffled_left_lookup_spreads_null_keys(spark):
    back = _no_broadcast(spark)
    dim = _dim(spark, [("Acme", "acme"), ("Globex", "globex")])
    facts = spark.createDataFrame([(i, None if i % 3 else ("Acme" if i % 2 else "Globex"))
                                   for i in range(60)], "fid int, maker string")
    got = dict((r.fid, r.id) for r in resolve_fk(facts, dim, "maker", "name", "id", "left").collect())
    back()
    assert len(got) == 60
    assert all(got[i] == (None if i % 3 else (1 if i % 2 else 2)) for i in range(60))


def test_case_insensitive_collation_option(spark):
    rows = [("Acme", "b"), ("ACME ", "a"), ("Globex", "g")]
    for shuffled in (False, True):
        if shuffled:
            back = _no_broadcast(spark)
        dim = load_dimension(spark.createDataFrame(rows, "Name string, Slug string"), "Name", "Slug",
                             "id", "name", collation="UTF8_LCASE_RTRIM")
        got = sorted((r.id, r.name, r.slug) for r in dim.collect())
        assert got == [(1, "ACME", "a"), (2, "Globex", "g")]   # trimmed, smallest slug wins
        facts = spark.createDataFrame([(1, "acme"), (2, "GLOBEX  "), (3, "Initech"), (4, None)],
                                      "fid int, maker string")
        out = resolve_fk(facts, dim, "maker", "name", "id", "left", collation="UTF8_LCASE_RTRIM")
        assert sorted((r.fid, r.id) for r in out.collect()) == [(1, 1), (2, 2), (3, None), (4, None)]
    back()
    values = spark.createDataFrame([("acme",), ("Zeta",), ("ZETA",)], "name string")
    grown = backfill_dimension(dim, values, "id", "name", collation="UTF8_LCASE_RTRIM")
    assert sorted((r.id, r.name) for r in grown.collect()) == [(1, "ACME"), (2, "Globex"), (3, "ZETA")]
