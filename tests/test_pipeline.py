"""Whole pipeline on the smallest driver tables: every registered query
against its DuckDB oracle, a rerun gives identical output, and the
validation report passes."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tabulary.plans.analogues import analogue_sources
from tabulary.plans.catalog import TABLE_NAMES, build_catalog, validate
from tabulary.plans.registry import ORACLE, QUERIES
from tabulary.sources.tables import TABLES

from .conftest import SMOKE_DIR


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, decimal.Decimal):
            return str(v.quantize(decimal.Decimal("0.01")))
        return v
    return sorted((tuple(n(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["manufacturer_name", "medicine_count"]
    assert 0 < df.count() <= 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    rel = duck.execute(ORACLE[name])
    cols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(cols)
    spark_rows = [tuple(r[c] for c in cols) for r in df.collect()]
    assert _norm(spark_rows) == _norm(rel.fetchall())


def test_rerun_is_identical_and_valid(spark):
    a = build_catalog(analogue_sources(spark, SMOKE_DIR))
    b = build_catalog(analogue_sources(spark, SMOKE_DIR))
    for t in TABLE_NAMES:
        assert sorted(map(tuple, a[t].collect()), key=repr) == sorted(map(tuple, b[t].collect()), key=repr), t
    failed = {r.check_name for r in validate(a).collect() if not r.passed}
    # the rendered texts hold sizes and prices that are no numbers, and doubled containers
    assert {"null pack_size", "null pack_price", "packed text not fully parsed"} <= failed
    assert not any(f.startswith(("fk ", "semicolon")) or f.endswith("_id") or f.endswith("_name") for f in failed), failed


def test_reports_are_ordered(spark):
    def rows(name):
        return [tuple(r) for r in entry.queries()[name](spark, SMOKE_DIR).collect()]
    for name in ("pack_size_frequency", "medicines_per_type", "container_type_frequency",
                 "profile_patterns_clean", "profile_patterns_input"):
        counts = [r[1] for r in rows(name)]
        assert counts == sorted(counts, reverse=True), name
    for name in ("row_counts", "packs_per_medicine", "containers_per_medicine"):
        keys = [r[0] for r in rows(name)]
        assert keys == sorted(keys), name
    listing = [(r[0], r[3] is not None, r[3] or 0) for r in rows("sample_packs_joined")]
    assert listing == sorted(listing)


def test_broken_fk_is_reported(spark):
    t = dict(build_catalog(analogue_sources(spark, SMOKE_DIR)))
    t["medicine"] = t["medicine"].filter("brand_id > 1")
    report = {r.check_name: r for r in validate(t).collect()}
    assert report["fk package_size.brand_id"].issue_count > 0 or report["fk package_container.brand_id"].issue_count > 0
    assert not (report["fk package_size.brand_id"].passed and report["fk package_container.brand_id"].passed)


def test_expectations_turn_informational_checks_into_gates(spark):
    from tabulary.plans.catalog import PUBLISHED_RESULTS
    t = build_catalog(analogue_sources(spark, SMOKE_DIR))
    report = {r.check_name: r for r in validate(t, PUBLISHED_RESULTS).collect()}
    # the driver tables are not the author's files: the published counts do not hold
    assert not report["container without price"].passed
    assert report["container without price"].expected == 39
    assert report["fk medicine.generic_id"].passed


def test_lazy_catalog_builds_only_what_is_asked(spark):
    from tabulary.plans.catalog import LazyCatalog
    lazy = LazyCatalog(analogue_sources(spark, SMOKE_DIR))
    lazy["dosage_form"]
    assert set(lazy._built) == {"dosage_form"}
    lazy["medicine_package_size"]
    assert {"medicine_raw", "generic", "drug_class", "manufacturer"} <= set(lazy._built)
    assert "generic_indication" not in lazy._built and "indication" not in lazy._built
    assert lazy["medicine_package_size"] is lazy["medicine_package_size"]


def test_lazy_catalog_concurrent_access_builds_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    from tabulary.plans.catalog import LazyCatalog
    lazy = LazyCatalog(analogue_sources(spark, SMOKE_DIR))
    names = ["medicine_package_size", "medicine_package_container", "generic_indication",
             "medicine", "drug_class", "generic"]
    with ThreadPoolExecutor(6) as pool:
        first = list(pool.map(lazy.__getitem__, names))
    assert all(a is lazy[n] for a, n in zip(first, names))
    assert lazy["generic_indication"].count() > 0 and lazy["medicine"].count() == 200


def test_write_catalog_writes_every_table_with_its_count(spark):
    import tempfile

    from tabulary.plans.catalog import write_catalog
    t = build_catalog(analogue_sources(spark, SMOKE_DIR))
    out = tempfile.mkdtemp(prefix="tabulary-write-")
    counts = write_catalog(t, out)
    assert set(counts) == set(TABLE_NAMES)
    for name, n in counts.items():
        assert spark.read.parquet(f"{out}/{name}").count() == n == t[name].count()
