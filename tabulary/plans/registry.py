"""Named queries: one per operator family of the survey's inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL
over the driver's tables) return the same columns.  Catalog queries share
one build per (session, scale dir); raw-table queries read the driver's
tables directly.  No query caps, samples or subsets its input; the only
``limit`` is in top-k and preview reports, where it is the feature.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import typo_left
from ..functions.containers import (PACK_OPEN, PRICE_FRAGMENT, pattern_after_clean,
                                    pattern_before_insert)
from ..functions.text import TAKA, has_non_ascii, is_null_or_blank
from ..operators.children import parse_rejects, preview_first_block, preview_pack_blocks
from ..operators.bitmaps import summary
from ..operators.dims import dedupe_by_key
from ..operators.joins import linked, unlinked
from ..operators.keys import with_dense_key
from ..operators.quality import count_checks, duplicate_counts, fk_counts, row_counts
from ..operators.reports import (group_counts, group_size_histogram, in_neither, joined_preview,
                                 oversized_groups, top_k, value_frequency, value_range)
from ..sources.staging import new_folder
from ..sources.store import TableStore
from ..sources.tables import table
from .analogues import analogue_sources
from .catalog import KEYS, TABLE_NAMES, LazyCatalog, quality_checks, refresh_catalog
from .oracle import money, with_catalog

_lock = threading.Lock()
_catalogs: dict[tuple, LazyCatalog] = {}


def catalog(spark: SparkSession, sf_dir: str) -> LazyCatalog:
    """The catalog over the analogue sources of ``sf_dir``: tables are built
    on first use (with their dependencies) and kept per application, since
    dense keys stage their input, as long as the input files are the same."""
    key = (_app_id(spark), sf_dir.rstrip("/"), _files(spark, sf_dir))
    with _lock:
        if key not in _catalogs:
            _catalogs[key] = LazyCatalog(analogue_sources(spark, sf_dir))
        return _catalogs[key]


def prime(spark: SparkSession, sf_dir: str, tables: dict[str, DataFrame]) -> None:
    """Register tables already built by ``build_catalog`` for ``sf_dir``."""
    key = (_app_id(spark), sf_dir.rstrip("/"), _files(spark, sf_dir))
    with _lock:
        _catalogs[key] = LazyCatalog(analogue_sources(spark, sf_dir), built=tables)


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of the folder's entries, as the store lists them."""
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
        listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    except Exception:  # noqa: BLE001 - Connect session
        return ()
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed))


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Connect session
        return spark.conf.get("spark.app.id", "") or str(id(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None, catalog_sql: bool = True):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_catalog(sql) if catalog_sql else sql.strip()
        return fn
    return register


def _t(spark, sf, name):
    return catalog(spark, sf)[name]


# ---------------------------------------------------------------- dimensions

@query("dim_clean_dedupe", "SELECT dosage_form_name, slug FROM dosage_form")
def dim_clean_dedupe(spark, sf):
    return _t(spark, sf, "dosage_form").select("dosage_form_name", "slug")


@query("dim_dense_key", "SELECT * FROM dosage_form")
def dim_dense_key(spark, sf):
    return _t(spark, sf, "dosage_form")


@query("dim_manufacturer", "SELECT * FROM manufacturer")
def dim_manufacturer(spark, sf):
    return _t(spark, sf, "manufacturer")


@query("dim_backfill", "SELECT * FROM drug_class")
def dim_backfill(spark, sf):
    return _t(spark, sf, "drug_class")


@query("fk_inner", "SELECT * FROM generic")
def fk_inner(spark, sf):
    return _t(spark, sf, "generic")


@query("fk_left_keep_misses", "SELECT * FROM medicine")
def fk_left_keep_misses(spark, sf):
    return _t(spark, sf, "medicine")


@query("junction_pairs", "SELECT * FROM generic_indication")
def junction_pairs(spark, sf):
    return _t(spark, sf, "generic_indication")


# ------------------------------------------------------- packed text parsing

@query("container_unit_price", "SELECT brand_id, container_format, unit_price FROM medicine_raw")
def container_unit_price(spark, sf):
    return _t(spark, sf, "medicine_raw").select("brand_id", "container_format", "unit_price")


@query("container_clean", "SELECT brand_id, package_container FROM medicine_raw")
def container_clean(spark, sf):
    return _t(spark, sf, "medicine_raw").select("brand_id", "package_container")


@query("pack_sizes", "SELECT * FROM medicine_package_size")
def pack_sizes(spark, sf):
    return _t(spark, sf, "medicine_package_size")


def _block(i: str) -> str:
    return (f"'(' || CASE WHEN {i} = 1 AND p_size % 11 = 0 THEN '1,000' ELSE CAST(10 * {i} AS VARCHAR) END"
            f" || '''s pack:' || CASE WHEN p_size % 19 = 0 THEN '' ELSE ' ' END || '৳ '"
            f" || CASE WHEN {i} = 1 AND p_size % 17 = 0 THEN 'TBA' ELSE {money(f'CAST(u * 3 * {i} AS DECIMAL(10,2))')} END"
            f" || CASE WHEN {i} = nb AND p_size % 13 = 0 THEN '' ELSE ')' END"
            f" || CASE WHEN {i} = nb AND p_size % 2 = 0 THEN ',' ELSE '' END")


@query("pack_blocks_preview", f"""
SELECT brand_id, {_block('1')} || CASE WHEN nb >= 2 THEN ',' || {_block('2')} ELSE '' END
         || CASE WHEN nb >= 3 THEN ',' || {_block('3')} ELSE '' END
         || CASE WHEN nb >= 4 THEN ',' || {_block('4')} ELSE '' END AS package_size,
       {_block('1')} AS block_1, CASE WHEN nb >= 2 THEN {_block('2')} END AS block_2,
       CASE WHEN nb = 4 THEN {_block('3')} || ',' || {_block('4')}
            WHEN nb = 3 THEN {_block('3')} END AS block_3
FROM medicine_raw WHERE nb > 0""")
def pack_blocks_preview(spark, sf):
    return preview_pack_blocks(_t(spark, sf, "medicine_raw"))


@query("pack_first_block_preview", """
SELECT brand_id, CASE WHEN p_size % 11 = 0 THEN NULL ELSE 10 END AS pack_size_preview,
       CASE WHEN p_size % 17 = 0 THEN NULL ELSE CAST(u * 3 AS DECIMAL(10,2)) END AS pack_price_preview
FROM medicine_raw WHERE nb = 1 ORDER BY brand_id LIMIT 20""")
def pack_first_block_preview(spark, sf):
    return preview_first_block(_t(spark, sf, "medicine_raw"))


@query("profile_medicine_encoding", """
SELECT count(*) AS total_medicine_rows,
       CAST(count(*) FILTER (WHERE package_container IS NULL) AS BIGINT) AS null_container,
       CAST(count(*) FILTER (WHERE regexp_matches(package_container, '[^ -~]')) AS BIGINT)
         AS encoding_in_container
FROM medicine_raw""")
def profile_medicine_encoding(spark, sf):
    c = F.col("package_container")
    return _t(spark, sf, "medicine_raw").agg(
        F.count(F.lit(1)).alias("total_medicine_rows"),
        F.count_if(c.isNull()).alias("null_container"),
        F.count_if(has_non_ascii(c)).alias("encoding_in_container"))


@query("containers", "SELECT * FROM medicine_package_container")
def containers(spark, sf):
    return _t(spark, sf, "medicine_package_container")


@query("containers_priced", """
SELECT * FROM medicine_package_container
WHERE container_size IS NOT NULL AND unit_price IS NOT NULL""")
def containers_priced(spark, sf):
    c = _t(spark, sf, "medicine_package_container")
    return c.filter(F.col("container_size").isNotNull() & F.col("unit_price").isNotNull())


@query("containers_unpriced", """
SELECT * FROM medicine_package_container
WHERE container_size IS NOT NULL AND unit_price IS NULL""")
def containers_unpriced(spark, sf):
    c = _t(spark, sf, "medicine_package_container")
    return c.filter(F.col("container_size").isNotNull() & F.col("unit_price").isNull())


@query("containers_unit_only", "SELECT * FROM medicine_package_container WHERE container_size IS NULL")
def containers_unit_only(spark, sf):
    return _t(spark, sf, "medicine_package_container").filter(F.col("container_size").isNull())


@query("container_typos", """
SELECT CAST(count(*) FILTER (WHERE container_size ILIKE '%litter%' OR container_size ILIKE '%botttle%'
  OR container_size ILIKE '%prefilled%' OR container_size ILIKE '%per-filled%'
  OR container_size ILIKE '%µg%') AS BIGINT) AS remaining_typos
FROM medicine_package_container""")
def container_typos(spark, sf):
    c = _t(spark, sf, "medicine_package_container")
    return c.agg(F.count_if(typo_left(F.col("container_size"))).alias("remaining_typos"))


@query("container_type_frequency", """
SELECT container_type, count(*) AS type_count FROM medicine_package_container GROUP BY 1""")
def container_type_frequency(spark, sf):
    return value_frequency(_t(spark, sf, "medicine_package_container"), "container_type",
                           "container_type", "type_count").orderBy(F.col("type_count").desc(), "container_type")


# ------------------------------------------------------------------ profiles



@query("profile_price", f"""
SELECT CAST(count(*) FILTER (WHERE raw_b AND unit_price IS NULL) AS BIGINT) AS format_b_null_price,
       CAST(count(*) FILTER (WHERE container_format = 'A single' AND unit_price IS NULL) AS BIGINT)
         AS format_a_single_null_price,
       CAST(count(*) FILTER (WHERE unit_price IS NOT NULL) AS BIGINT) AS populated_unit_price,
       CAST(count(*) FILTER (WHERE unit_price IS NULL) AS BIGINT) AS total_null_unit_price
FROM (SELECT *, container_format LIKE 'B%' AS raw_b FROM medicine_raw)""")
def profile_price(spark, sf):
    m = _t(spark, sf, "medicine_raw")
    b = F.col("container_format").startswith("B")
    return m.agg(
        F.count_if(b & F.col("unit_price").isNull()).alias("format_b_null_price"),
        F.count_if((F.col("container_format") == "A single") & F.col("unit_price").isNull())
        .alias("format_a_single_null_price"),
        F.count_if(F.col("unit_price").isNotNull()).alias("populated_unit_price"),
        F.count_if(F.col("unit_price").isNull()).alias("total_null_unit_price"))


@query("profile_clean", """
SELECT CAST(count(*) FILTER (WHERE package_container LIKE '%৳%') AS BIGINT) AS currency_remaining,
       CAST(count(*) FILTER (WHERE package_container LIKE '%,(%') AS BIGINT) AS pack_fragments_remaining,
       CAST(count(*) FILTER (WHERE regexp_matches(package_container, ',[0-9].*\\.[0-9][0-9]'))
         AS BIGINT) AS price_fragments_remaining,
       CAST(count(*) FILTER (WHERE package_container IS NULL) AS BIGINT) AS null_container,
       count(*) AS total_rows
FROM medicine_raw""")
def profile_clean(spark, sf):
    c = F.col("package_container")
    return _t(spark, sf, "medicine_raw").agg(
        F.count_if(c.contains(TAKA)).alias("currency_remaining"),
        F.count_if(c.contains(PACK_OPEN)).alias("pack_fragments_remaining"),
        F.count_if(c.rlike(PRICE_FRAGMENT)).alias("price_fragments_remaining"),
        F.count_if(c.isNull()).alias("null_container"),
        F.count(F.lit(1)).alias("total_rows"))


@query("profile_patterns_clean", """
SELECT CASE WHEN package_container IS NULL THEN 'NULL (Format B)'
            WHEN package_container LIKE '%,%' THEN 'Multi-container'
            ELSE 'Single container' END AS pattern, count(*) AS row_count
FROM medicine_raw GROUP BY 1""")
def profile_patterns_clean(spark, sf):
    return value_frequency(_t(spark, sf, "medicine_raw"),
                           pattern_after_clean(F.col("package_container")), "pattern", "row_count") \
        .orderBy(F.col("row_count").desc(), "pattern")


@query("profile_patterns_input", """
SELECT CASE WHEN package_container IS NULL THEN 'NULL (Format B - no container)'
            WHEN package_container NOT LIKE '%৳%' AND package_container NOT LIKE '%,%'
              THEN 'Single - no price'
            WHEN package_container NOT LIKE '%৳%' THEN 'Multiple - no price'
            WHEN length(package_container) - length(replace(package_container, '৳', '')) = 1
              THEN 'Single - with price'
            ELSE 'Multiple - with price' END AS pattern, count(*) AS row_count
FROM medicine_raw GROUP BY 1""")
def profile_patterns_input(spark, sf):
    return value_frequency(_t(spark, sf, "medicine_raw"),
                           pattern_before_insert(F.col("package_container")), "pattern", "row_count") \
        .orderBy(F.col("row_count").desc(), "pattern")


@query("profile_final", """
SELECT CAST(count(*) FILTER (WHERE nb > 0 OR p_size % 3 = 0) AS BIGINT) AS rows_with_package_size,
       CAST(count(*) FILTER (WHERE package_container IS NOT NULL
                             AND package_container NOT LIKE '%৳%') AS BIGINT) AS clean_container_rows,
       CAST(count(*) FILTER (WHERE package_container LIKE '%৳%') AS BIGINT) AS dirty_container_rows
FROM medicine_raw""")
def profile_final(spark, sf):
    c = F.col("package_container")
    return _t(spark, sf, "medicine_raw").agg(
        F.count_if(F.col("package_size").isNotNull()).alias("rows_with_package_size"),
        F.count_if(c.isNotNull() & ~c.contains(TAKA)).alias("clean_container_rows"),
        F.count_if(c.contains(TAKA)).alias("dirty_container_rows"))


@query("profile_child_pack", """
SELECT count(*) AS total_rows,
       CAST(count(*) FILTER (WHERE pack_size IS NULL) AS BIGINT) AS null_pack_size,
       CAST(count(*) FILTER (WHERE pack_price IS NULL) AS BIGINT) AS null_pack_price,
       count(DISTINCT brand_id) AS distinct_medicines
FROM medicine_package_size""")
def profile_child_pack(spark, sf):
    return _child_profile(_t(spark, sf, "medicine_package_size"), ["pack_size", "pack_price"])


def _child_profile(child: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, NULLs by column and distinct medicines."""
    s = summary(child, "brand_id", "distinct_medicines",
                {"total_rows": ("count", "*"), **{c: ("count", c) for c in columns}})
    return s.select("total_rows", *((F.col("total_rows") - F.col(c)).alias(f"null_{c}") for c in columns), "distinct_medicines")


@query("profile_child_container", """
SELECT count(*) AS total_rows,
       CAST(count(*) FILTER (WHERE container_size IS NULL) AS BIGINT) AS null_container_size,
       CAST(count(*) FILTER (WHERE unit_price IS NULL) AS BIGINT) AS null_unit_price,
       CAST(count(*) FILTER (WHERE container_type IS NULL) AS BIGINT) AS null_container_type,
       count(DISTINCT brand_id) AS distinct_medicines
FROM medicine_package_container""")
def profile_child_container(spark, sf):
    return _child_profile(_t(spark, sf, "medicine_package_container"), ["container_size", "unit_price", "container_type"])


# ---------------------------------------------------------- quality checks

@query("row_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TABLE_NAMES))
def row_counts_q(spark, sf):
    t = catalog(spark, sf)
    return row_counts({n: t[n] for n in TABLE_NAMES}).orderBy("table_name")


def _dup_sql(name: str, table_: str, keys: str) -> str:
    return (f"SELECT '{name}' AS check_name, count(*) AS issue_count FROM "
            f"(SELECT {keys} FROM {table_} GROUP BY ALL HAVING count(*) > 1)")


_DUPS = [("duplicate drug_class_name", "drug_class", "drug_class_name"),
         ("duplicate dosage_form_name", "dosage_form", "dosage_form_name"),
         ("duplicate manufacturer_name", "manufacturer", "manufacturer_name"),
         ("duplicate indication_name", "indication", "indication_name"),
         ("duplicate generic_name", "generic", "generic_name"),
         ("duplicate medicine", "medicine", "brand_name, strength, dosage_form_id, manufacturer_id"),
         ("duplicate pack", "medicine_package_size", "brand_id, pack_size, pack_price"),
         ("duplicate container", "medicine_package_container",
          "brand_id, container_size, unit_price"),
         ("duplicate generic_indication pair", "generic_indication", "generic_id, indication_id")] + [
    (f"duplicate {key}", tbl, key) for tbl, key in (
        ("drug_class", "drug_class_id"), ("dosage_form", "dosage_form_id"),
        ("manufacturer", "manufacturer_id"), ("indication", "indication_id"),
        ("generic", "generic_id"), ("medicine", "brand_id"),
        ("medicine_package_size", "package_size_id"),
        ("medicine_package_container", "package_container_id"),
        ("generic_indication", "generic_indication_id"))]


@query("duplicate_groups", " UNION ALL ".join(_dup_sql(*d) for d in _DUPS))
def duplicate_groups_q(spark, sf):
    return quality_checks(catalog(spark, sf), ("duplicates",))


def _checks_of(spark, sf, group: str) -> DataFrame:
    return quality_checks(catalog(spark, sf), (group,))


def _cnt(name: str, table_: str, cond: str) -> str:
    return (f"SELECT '{name}' AS check_name, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) "
            f"AS issue_count FROM {table_}")


_BLANK = "{c} IS NULL OR trim({c}) = ''"
_NULLS = [
    ("null drug_class_name", "drug_class", _BLANK.format(c="drug_class_name")),
    ("null dosage_form_name", "dosage_form", _BLANK.format(c="dosage_form_name")),
    ("null manufacturer_name", "manufacturer", _BLANK.format(c="manufacturer_name")),
    ("null indication_name", "indication", _BLANK.format(c="indication_name")),
    ("null generic_name", "generic", _BLANK.format(c="generic_name")),
    ("generic without class", "generic", "drug_class_id IS NULL"),
    ("medicine without dosage form", "medicine", "dosage_form_id IS NULL"),
    ("medicine without generic", "medicine", "generic_id IS NULL"),
    ("medicine without manufacturer", "medicine", "manufacturer_id IS NULL"),
    ("null brand_name", "medicine", _BLANK.format(c="brand_name")),
    ("null pack_size", "medicine_package_size", "pack_size IS NULL"),
    ("null pack_price", "medicine_package_size", "pack_price IS NULL"),
    ("container without size and price", "medicine_package_container",
     "container_size IS NULL AND unit_price IS NULL"),
    ("container without price", "medicine_package_container", "unit_price IS NULL"),
    ("container without type", "medicine_package_container", "container_type IS NULL"),
]


@query("null_or_blank", " UNION ALL ".join(_cnt(*c) for c in _NULLS))
def null_or_blank(spark, sf):
    return _checks_of(spark, sf, "nulls")


_CHARS = [
    ("semicolon in brand_name", "medicine", "brand_name LIKE '%;%'"),
    ("semicolon in strength", "medicine", "strength LIKE '%;%'"),
    ("semicolon in container_size", "medicine_package_container", "container_size LIKE '%;%'"),
    ("currency sign in container_size", "medicine_package_container",
     "container_size LIKE '%৳%'"),
    ("non-ascii container_size", "medicine_package_container",
     "regexp_matches(container_size, '[^ -~]')"),
    ("typos left in container_size", "medicine_package_container",
     "container_size LIKE '%litter%' OR container_size LIKE '%botttle%' OR container_size "
     "LIKE '%prefilled%' OR container_size LIKE '%per-filled%' OR container_size LIKE '%µg%'"),
]


@query("leftover_chars", " UNION ALL ".join(_cnt(*c) for c in _CHARS))
def leftover_chars(spark, sf):
    return _checks_of(spark, sf, "chars")


def _fk_sql(name, child, fk, parent, pk):
    return (f"SELECT '{name}' AS check_name, count(*) AS issue_count FROM {child} c "
            f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


_FKS = [("fk generic.drug_class_id", "generic", "drug_class_id", "drug_class", "drug_class_id"),
        ("fk medicine.dosage_form_id", "medicine", "dosage_form_id", "dosage_form",
         "dosage_form_id"),
        ("fk medicine.generic_id", "medicine", "generic_id", "generic", "generic_id"),
        ("fk medicine.manufacturer_id", "medicine", "manufacturer_id", "manufacturer",
         "manufacturer_id"),
        ("fk package_size.brand_id", "medicine_package_size", "brand_id", "medicine", "brand_id"),
        ("fk package_container.brand_id", "medicine_package_container", "brand_id", "medicine",
         "brand_id"),
        ("fk generic_indication.generic_id", "generic_indication", "generic_id", "generic",
         "generic_id"),
        ("fk generic_indication.indication_id", "generic_indication", "indication_id",
         "indication", "indication_id")]


@query("broken_fk", " UNION ALL ".join(_fk_sql(*f) for f in _FKS))
def broken_fk_q(spark, sf):
    return quality_checks(catalog(spark, sf), ("fk",))


# ------------------------------------------------------------------ reports

@query("unlinked_members", """
SELECT drug_class_id, drug_class_name FROM drug_class d
WHERE NOT EXISTS (SELECT 1 FROM generic g WHERE g.drug_class_id = d.drug_class_id)""")
def unlinked_members(spark, sf):
    t = catalog(spark, sf)
    return unlinked(t["drug_class"], "drug_class_id", t["generic"], "drug_class_id").select(
        "drug_class_id", "drug_class_name")


@query("linked_split", """
SELECT 'With generics' AS status, count(DISTINCT d.drug_class_id) AS class_count
FROM drug_class d JOIN generic g ON g.drug_class_id = d.drug_class_id
UNION ALL
SELECT 'Without generics', count(*) FROM drug_class d
WHERE NOT EXISTS (SELECT 1 FROM generic g WHERE g.drug_class_id = d.drug_class_id)""")
def linked_split(spark, sf):
    t = catalog(spark, sf)
    dc, g = t["drug_class"], t["generic"]
    with_ = linked(dc, "drug_class_id", g, "drug_class_id").agg(
        F.count(F.lit(1)).alias("class_count")).select(F.lit("With generics").alias("status"),
                                                       "class_count")
    without = unlinked(dc, "drug_class_id", g, "drug_class_id").agg(
        F.count(F.lit(1)).alias("class_count")).select(F.lit("Without generics").alias("status"),
                                                       "class_count")
    return with_.unionByName(without)


def _top_sql(label: str, parent: str, pk: str, child: str, fk: str, out: str, k: int | None) -> str:
    lim = f" LIMIT {k}" if k else ""
    return (f"SELECT p.{label}, count(c.{fk}) AS {out} FROM {parent} p "
            f"LEFT JOIN {child} c ON c.{fk} = p.{pk} GROUP BY p.{pk}, p.{label} "
            f"ORDER BY {out} DESC, p.{label} ASC{lim}")


def _top(label, parent, pk, child, fk, out, k):
    def run(spark, sf):
        t = catalog(spark, sf)
        return top_k(group_counts(t[parent], pk, label, t[child], fk, out), k, out, [label])
    return run


for _name, _args in {
    "top_classes_by_generics": ("drug_class_name", "drug_class", "drug_class_id", "generic",
                                "drug_class_id", "generic_count", 20),
    "top_manufacturers": ("manufacturer_name", "manufacturer", "manufacturer_id", "medicine",
                          "manufacturer_id", "medicine_count", 10),
    "medicines_per_form": ("dosage_form_name", "dosage_form", "dosage_form_id", "medicine",
                           "dosage_form_id", "medicine_count", None),
    "top_generics_by_brands": ("generic_name", "generic", "generic_id", "medicine", "generic_id",
                               "brand_count", 10),
}.items():
    query(_name, _top_sql(*_args))(_top(*_args))


@query("pack_size_frequency", "SELECT pack_size, count(*) AS frequency FROM medicine_package_size GROUP BY 1")
def pack_size_frequency(spark, sf):
    return value_frequency(_t(spark, sf, "medicine_package_size"), "pack_size", "pack_size").orderBy(
        F.col("frequency").desc(), "pack_size")


@query("medicines_per_type", "SELECT type, count(*) AS medicine_count FROM medicine GROUP BY 1")
def medicines_per_type(spark, sf):
    return value_frequency(_t(spark, sf, "medicine"), "type", "type", "medicine_count").orderBy(
        F.col("medicine_count").desc(), "type")


def _range_sql(col: str, prefix: str, table_: str) -> str:
    return (f"SELECT min({col}) AS min_{prefix}, max({col}) AS max_{prefix}, "
            # whole hundredths, divided with the half rounded up at six digits
            f"CAST(CAST((2 * CAST(sum({col}) * 100 AS HUGEINT) * 10000 + count({col})) // (2 * count({col})) AS DECIMAL(20,0))"
            f" * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(14,6)) AS avg_{prefix} FROM {table_} WHERE {col} IS NOT NULL")


@query("pack_price_range", _range_sql("pack_price", "pack_price", "medicine_package_size"))
def pack_price_range(spark, sf):
    return value_range(_t(spark, sf, "medicine_package_size"), "pack_price", "pack_price")


@query("container_price_range", _range_sql("unit_price", "unit_price", "medicine_package_container"))
def container_price_range(spark, sf):
    return value_range(_t(spark, sf, "medicine_package_container"), "unit_price", "unit_price")


@query("oversized_pack_groups", """
SELECT count(*) AS parent_count FROM
  (SELECT brand_id FROM medicine_package_size GROUP BY brand_id HAVING count(*) > 3)""")
def oversized_pack_groups(spark, sf):
    return oversized_groups(_t(spark, sf, "medicine_package_size"), "brand_id", 3)


@query("packs_per_medicine", """
SELECT pack_count, count(*) AS medicine_count FROM
  (SELECT brand_id, count(*) AS pack_count FROM medicine_package_size GROUP BY brand_id)
GROUP BY pack_count""")
def packs_per_medicine(spark, sf):
    return group_size_histogram(_t(spark, sf, "medicine_package_size"), "brand_id", "pack_count",
                                "medicine_count").orderBy("pack_count")


@query("containers_per_medicine", """
SELECT container_count, count(*) AS medicine_count FROM
  (SELECT brand_id, count(*) AS container_count FROM medicine_package_container GROUP BY brand_id)
GROUP BY container_count""")
def containers_per_medicine(spark, sf):
    return group_size_histogram(_t(spark, sf, "medicine_package_container"), "brand_id",
                                "container_count", "medicine_count").orderBy("container_count")


@query("in_neither_child", """
SELECT brand_id, brand_name FROM medicine m
WHERE NOT EXISTS (SELECT 1 FROM medicine_package_size s WHERE s.brand_id = m.brand_id)
  AND NOT EXISTS (SELECT 1 FROM medicine_package_container c WHERE c.brand_id = m.brand_id)""")
def in_neither_child(spark, sf):
    t = catalog(spark, sf)
    return in_neither(t["medicine"], "brand_id", t["medicine_package_size"],
                      t["medicine_package_container"], "brand_id").select("brand_id", "brand_name")


_TABLE_KEYS = {"drug_class": "drug_class_id", "dosage_form": "dosage_form_id",
               "manufacturer": "manufacturer_id", "indication": "indication_id",
               "generic": "generic_id", "medicine": "brand_id",
               "medicine_package_size": "package_size_id",
               "medicine_package_container": "package_container_id",
               "generic_indication": "generic_indication_id"}


def _sample(name, key):
    def run(spark, sf):
        return _t(spark, sf, name).orderBy(key).limit(5)
    return run


for _name, _key in _TABLE_KEYS.items():      # first five rows of each table (Q43)
    query(f"sample_{_name}", f"SELECT * FROM {_name} ORDER BY {_key} LIMIT 5")(_sample(_name, _key))


@query("sample_packs_joined", """
SELECT m.brand_id, m.brand_name, m.strength, s.pack_size, s.pack_price
FROM medicine m JOIN medicine_package_size s ON s.brand_id = m.brand_id
ORDER BY m.brand_id, s.pack_size NULLS FIRST, s.package_size_id LIMIT 20""")
def sample_packs_joined(spark, sf):
    t = catalog(spark, sf)
    return joined_preview(t["medicine"], t["medicine_package_size"], "brand_id",
                          ["brand_id", "brand_name", "strength", "pack_size", "pack_price", "package_size_id"],
                          ["brand_id", "pack_size", "package_size_id"], 20).drop("package_size_id")


@query("sample_containers_joined", """
SELECT m.brand_id, m.brand_name, m.strength, c.container_size, c.unit_price, c.container_type
FROM medicine m JOIN medicine_package_container c ON c.brand_id = m.brand_id
ORDER BY m.brand_id, c.package_container_id LIMIT 20""")
def sample_containers_joined(spark, sf):
    t = catalog(spark, sf)
    return joined_preview(t["medicine"], t["medicine_package_container"], "brand_id",
                          ["brand_id", "brand_name", "strength", "container_size", "unit_price",
                           "container_type", "package_container_id"],
                          ["brand_id", "package_container_id"], 20).drop("package_container_id")


@query("junction_count", "SELECT count(*) AS pair_count FROM generic_indication")
def junction_count(spark, sf):
    return _t(spark, sf, "generic_indication").agg(F.count(F.lit(1)).alias("pair_count"))


def _inner_top_sql(label, dim, pk, out, other) -> str:
    return (f"SELECT d.{label}, count(j.{other}) AS {out} FROM {dim} d "
            f"JOIN generic_indication j ON j.{pk} = d.{pk} GROUP BY d.{pk}, d.{label} "
            f"ORDER BY {out} DESC, d.{label} LIMIT 10")


def _inner_top(label, dim, pk, out, other):
    def run(spark, sf):
        t = catalog(spark, sf)
        per = (t["generic_indication"].groupBy(pk).agg(F.count(other).alias(out))
               .join(t[dim].select(pk, label), pk, "inner").select(label, out))
        return top_k(per, 10, out, [label])
    return run


for _name, _args in {
    "top_generics_by_indications": ("generic_name", "generic", "generic_id", "indication_count",
                                    "indication_id"),
    "top_indications_by_generics": ("indication_name", "indication", "indication_id",
                                    "generic_count", "generic_id"),
}.items():
    query(_name, _inner_top_sql(*_args))(_inner_top(*_args))


@query("pack_summary", """
SELECT count(*) AS total_rows, count(DISTINCT brand_id) AS distinct_medicines,
       min(pack_size) AS min_pack_size, max(pack_size) AS max_pack_size,
       min(pack_price) AS min_pack_price, max(pack_price) AS max_pack_price
FROM medicine_package_size""")
def pack_summary(spark, sf):
    return summary(_t(spark, sf, "medicine_package_size"), "brand_id", "distinct_medicines", {
        "total_rows": ("count", "*"), "min_pack_size": ("min", "pack_size"), "max_pack_size": ("max", "pack_size"),
        "min_pack_price": ("min", "pack_price"), "max_pack_price": ("max", "pack_price")})


@query("container_summary", """
SELECT count(*) AS total_rows, count(DISTINCT brand_id) AS distinct_medicines,
       min(unit_price) AS min_unit_price, max(unit_price) AS max_unit_price
FROM medicine_package_container""")
def container_summary(spark, sf):
    return summary(_t(spark, sf, "medicine_package_container"), "brand_id", "distinct_medicines", {
        "total_rows": ("count", "*"), "min_unit_price": ("min", "unit_price"), "max_unit_price": ("max", "unit_price")})


# ------------------------------------- the same operators on the raw tables

@query("raw_duplicate_groups", """
SELECT 'lineitem (l_orderkey, l_linenumber)' AS check_name, count(*) AS issue_count FROM
  (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL
SELECT 'lineitem (l_partkey, l_suppkey)', count(*) FROM
  (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL
SELECT 'orders (o_custkey, o_orderdate)', count(*) FROM
  (SELECT o_custkey, o_orderdate FROM orders GROUP BY ALL HAVING count(*) > 1)""", catalog_sql=False)
def raw_duplicate_groups(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return duplicate_counts({"lineitem": li, "orders": o}, [
        ("lineitem (l_orderkey, l_linenumber)", "lineitem", ["l_orderkey", "l_linenumber"]),
        ("lineitem (l_partkey, l_suppkey)", "lineitem", ["l_partkey", "l_suppkey"]),
        ("orders (o_custkey, o_orderdate)", "orders", ["o_custkey", "o_orderdate"])])


_RAW_FKS = [("fk orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
            ("fk lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("fk lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
            ("fk lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("fk labels.doc_id", "labels", "doc_id", "documents", "doc_id")]


@query("raw_broken_fk", " UNION ALL ".join(_fk_sql(*f) for f in _RAW_FKS), catalog_sql=False)
def raw_broken_fk(spark, sf):
    names = {n for _, c, _, p, _ in _RAW_FKS for n in (c, p)}
    return fk_counts({n: table(spark, sf, n) for n in names}, _RAW_FKS)


@query("raw_top_suppliers", _top_sql("s_name", "supplier", "s_suppkey", "lineitem", "l_suppkey",
                                     "line_count", 10), catalog_sql=False)
def raw_top_suppliers(spark, sf):
    return top_k(group_counts(table(spark, sf, "supplier"), "s_suppkey", "s_name",
                              table(spark, sf, "lineitem"), "l_suppkey", "line_count"),
                 10, "line_count", ["s_name"])


@query("raw_orders_per_customer", """
SELECT order_count, count(*) AS customer_count FROM
  (SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey)
GROUP BY order_count""", catalog_sql=False)
def raw_orders_per_customer(spark, sf):
    return group_size_histogram(table(spark, sf, "orders"), "o_custkey", "order_count",
                                "customer_count")


@query("raw_oversized_orders", """
SELECT count(*) AS parent_count FROM
  (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 5)""", catalog_sql=False)
def raw_oversized_orders(spark, sf):
    return oversized_groups(table(spark, sf, "lineitem"), "l_orderkey", 5)


@query("raw_documents_in_neither", """
SELECT doc_id, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
  AND NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = d.doc_id)""", catalog_sql=False)
def raw_documents_in_neither(spark, sf):
    embedded = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return in_neither(table(spark, sf, "documents").select("doc_id", "source"), "doc_id",
                      table(spark, sf, "labels").select("doc_id"), embedded, "doc_id")


@query("raw_documents_linked_split", """
SELECT 'With label' AS status, count(*) AS document_count FROM documents d
WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL
SELECT 'Without label', count(*) FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""", catalog_sql=False)
def raw_documents_linked_split(spark, sf):
    d, lb = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    w = linked(d, "doc_id", lb, "doc_id").agg(F.count(F.lit(1)).alias("document_count"))
    wo = unlinked(d, "doc_id", lb, "doc_id").agg(F.count(F.lit(1)).alias("document_count"))
    return (w.select(F.lit("With label").alias("status"), "document_count")
            .unionByName(wo.select(F.lit("Without label").alias("status"), "document_count")))


@query("raw_text_checks", """
SELECT 'documents null or blank text' AS check_name,
       CAST(count(*) FILTER (WHERE text IS NULL OR trim(text, ' ') = '') AS BIGINT) AS issue_count
FROM documents
UNION ALL
SELECT 'documents non-ascii text', CAST(count(*) FILTER (WHERE regexp_matches(text, '[^ -~]')) AS BIGINT)
FROM documents
UNION ALL
SELECT 'documents semicolon in text', CAST(count(*) FILTER (WHERE text LIKE '%;%') AS BIGINT)
FROM documents
UNION ALL
SELECT 'documents null or blank source',
       CAST(count(*) FILTER (WHERE source IS NULL OR trim(source, ' ') = '') AS BIGINT)
FROM documents""", catalog_sql=False)
def raw_text_checks(spark, sf):
    d = table(spark, sf, "documents")
    return count_checks(d, {"documents null or blank text": is_null_or_blank("text"),
                            "documents non-ascii text": has_non_ascii("text"),
                            "documents semicolon in text": F.col("text").contains(";"),
                            "documents null or blank source": is_null_or_blank("source")})


@query("raw_value_frequency", """
SELECT l_returnflag || '/' || l_linestatus AS status, count(*) AS frequency FROM lineitem GROUP BY 1""",
       catalog_sql=False)
def raw_value_frequency(spark, sf):
    return value_frequency(table(spark, sf, "lineitem"),
                           F.concat_ws("/", "l_returnflag", "l_linestatus"), "status")


@query("raw_value_range", """
SELECT min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
       round(CAST(avg(l_extendedprice) AS DOUBLE), 2) AS avg_price FROM lineitem
WHERE l_extendedprice IS NOT NULL""", catalog_sql=False)
def raw_value_range(spark, sf):
    return value_range(table(spark, sf, "lineitem"), "l_extendedprice", "price", digits=2)


@query("parse_rejects", """
SELECT r.brand_id, CAST(r.container_signs AS BIGINT) AS container_signs, coalesce(c.n, 0) AS priced_containers,
       CAST(r.nb AS BIGINT) AS pack_signs, coalesce(s.n, 0) AS priced_packs
FROM medicine_raw r
LEFT JOIN (SELECT brand_id, count(*) AS n FROM medicine_package_container
           WHERE container_size IS NOT NULL AND unit_price IS NOT NULL GROUP BY 1) c
  ON c.brand_id = r.brand_id
LEFT JOIN (SELECT brand_id, count(*) AS n FROM medicine_package_size WHERE pack_price IS NOT NULL GROUP BY 1) s
  ON s.brand_id = r.brand_id
WHERE r.container_signs <> coalesce(c.n, 0) OR r.nb <> coalesce(s.n, 0)""")
def parse_rejects_q(spark, sf):
    t = catalog(spark, sf)
    return parse_rejects(t["medicine_raw"], t["medicine_package_container"],
                         t["medicine_package_size"])


@query("raw_first_line_per_order", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) = 1""",
       catalog_sql=False)
def raw_first_line_per_order(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return dedupe_by_key(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_quantity"])


@query("raw_dense_key_orders", """
SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_seq,
       o_orderkey FROM orders""", catalog_sql=False)
def raw_dense_key_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return with_dense_key(o, "order_seq", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


# ----------------------------------------------------------- stored tables

@query("append_orders", """
SELECT CAST(row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey) AS BIGINT)
         AS order_seq, o_orderkey, o_orderstatus FROM orders""", catalog_sql=False)
def append_orders(spark, sf):
    """Filled orders and then all others, appended as two batches; the second one is tried twice."""
    store = TableStore(spark, new_folder(spark, "append-orders"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    filled = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    store.append("orders", orders.where(filled), "order_seq", ["o_orderkey"], "filled")
    for _ in range(2):
        store.append("orders", orders.where(~filled), "order_seq", ["o_orderkey"], "others")
    return store.read("orders")


@query("refresh_catalog", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, CAST(max({KEYS[n]}) AS BIGINT) AS max_key FROM {n}" for n in TABLE_NAMES))
def refresh_catalog_q(spark, sf):
    """Rows and greatest keys of the stored catalog, after it was replaced as a whole."""
    store = TableStore(spark, new_folder(spark, "catalog-store"))
    refresh_catalog(catalog(spark, sf), store)
    stored = store.snapshot()
    parts = [stored[n].agg(F.count(F.lit(1)).alias("row_count"), F.max(KEYS[n]).cast("long").alias("max_key"))
             .select(F.lit(n).alias("table_name"), "row_count", "max_key") for n in TABLE_NAMES]
    return reduce(DataFrame.unionAll, parts)
