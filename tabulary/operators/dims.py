"""Dimension tables (survey I4-I6, E1, B4, B17, G3).

``dedupe_by_key`` keeps the first row per key under an order.  It is written
as a grouped ``min`` of a struct (order columns first) instead of a
``row_number`` window: the aggregate combines map-side, so a key that holds
a third of all rows is reduced inside every task before the shuffle, and no
task ever holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, is_present
from .keys import known_max_key, with_dense_key

_FIRST = "__first"


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per ``keys`` by ascending ``order`` (NULLs first), ties
    broken by the remaining columns so the result is deterministic.  Key
    values are taken from the winning row too: under a case-insensitive
    collation a group holds several spellings, and the group key alone would
    be whichever one a task saw first."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest + keys
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    first = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.min(packed).alias(_FIRST))
    pick = {c: F.col(f"{_FIRST}.f{i}").alias(c) for i, c in enumerate(fields)}
    return first.select(*[pick[c] for c in keys + order + rest])


def collated(c, collation: str | None):
    """``c`` under ``collation`` (e.g. ``UTF8_LCASE_RTRIM`` for names that
    compare case-insensitively and ignore trailing blanks), or unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.collate(c, collation) if collation else c


def load_dimension(staging: DataFrame, name: str, slug: str, key: str,
                   out_name: str, out_slug: str = "slug", cleaner=clean_text,
                   collation: str | None = None) -> DataFrame:
    """Clean names, drop NULL/blank, keep the smallest slug per name, then
    number rows 1..n by name (I5 = I1 + B4 + I4 + A11).  With ``collation``
    names are grouped, ordered and later joined under it (H16)."""
    cleaned = (staging.select(collated(cleaner(F.col(name)), collation).alias(out_name),
                              cleaner(F.col(slug)).alias(out_slug))
               .filter(is_present(out_name)))
    first = dedupe_by_key(cleaned, [out_name], [out_slug])
    return with_dense_key(first, key, [out_name])


def backfill_dimension(dim: DataFrame, values: DataFrame, key: str, name: str,
                       slug: str = "slug", collation: str | None = None) -> DataFrame:
    """Add members seen only in facts.

    ``values`` has one column ``name`` (already cleaned).  New members get a
    NULL slug and keys continuing after the current maximum, ordered by name.
    """
    values = values.select(collated(name, collation).alias(name))
    if collation:       # one spelling per collated name
        values = dedupe_by_key(values.withColumn("__v", F.col(name).cast("string")), [name], ["__v"]).drop("__v")
    new = (values.filter(is_present(name)).distinct()
           .join(dim.select(collated(name, collation).alias(name)), name, "left_anti")
           .withColumn(slug, F.lit(None).cast("string")))
    top = known_max_key(dim)      # known when dim came from with_dense_key
    if top is None:
        top = dim.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]
    added = with_dense_key(new, key, [name], start=int(top))
    out = dim.unionByName(added)
    if known_max_key(added) is not None:
        out.__dict__["_known_max_key"] = known_max_key(added)
    return out
