"""Foreign keys, junctions and integrity checks (survey I7, I8, C1-C6, C10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import with_dense_key


def resolve_fk(facts: DataFrame, dim: DataFrame, fact_col: str, dim_name: str,
               dim_key: str, how: str = "left", out: str | None = None,
               collation: str | None = None) -> DataFrame:
    """Replace the natural key ``fact_col`` by the surrogate ``dim_key``.

    ``how='left'`` keeps misses with a NULL key (C2); ``how='inner'`` drops
    them (C1).  Catalyst and AQE choose between broadcast and shuffle by the
    dimension's size.  NULL names never match.
    """
    def coll(c):
        return F.collate(c, collation) if collation else c

    lookup = dim.select(coll(F.col(dim_name)).alias("__name"), F.col(dim_key).alias(out or dim_key))
    if how != "left":       # drops NULL keys before any shuffle
        return (facts.join(lookup, coll(facts[fact_col]) == F.col("__name"), how)
                .drop("__name", fact_col))
    # Rows whose name is NULL can never match, yet would all hash to one
    # reducer of a shuffled join.  Give them a deterministic, never-matching key
    # spread by a hash of the row, and prefix real names so the two cannot
    # collide.
    spread = F.concat(F.lit("\u0001"), F.xxhash64(*[F.col(c) for c in facts.columns]).cast("string"))
    keyed = facts.withColumn("__jk", F.when(F.col(fact_col).isNull(), spread)
                             .otherwise(coll(F.concat(F.lit("\u0002"), F.col(fact_col)))))
    lookup = lookup.withColumn("__jk", coll(F.concat(F.lit("\u0002"), F.col("__name"))))
    return keyed.join(lookup, "__jk", "left").drop("__jk", "__name", fact_col)


def build_junction(pairs: DataFrame, left_dim: DataFrame, left_col: str, left_name: str,
                   left_key: str, right_dim: DataFrame, right_col: str, right_name: str,
                   right_key: str, key: str, collation: str | None = None) -> DataFrame:
    """Distinct (left_key, right_key) pairs; rows whose name misses either
    dimension are dropped (I8 = C3 + B17), numbered by the pair."""
    names = pairs.select(left_col, right_col).distinct()
    ids = resolve_fk(names, left_dim, left_col, left_name, left_key, "inner", collation=collation)
    ids = resolve_fk(ids, right_dim, right_col, right_name, right_key, "inner", collation=collation)
    unique = ids.select(left_key, right_key).distinct()
    return with_dense_key(unique, key, [left_key, right_key])


def broken_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no parent (C4, fixes C6)."""
    return (child.filter(F.col(fk).isNotNull())
            .join(parent.select(F.col(pk).alias(fk)), fk, "left_anti"))


def child_keys(child: DataFrame, fk: str, as_name: str) -> DataFrame:
    """Distinct non-NULL child keys.  The distinct combines map-side, so a key
    held by a third of the children is one row per task before the shuffle."""
    return child.select(F.col(fk).alias(as_name)).filter(F.col(as_name).isNotNull()).distinct()


def unlinked(parent: DataFrame, pk: str, child: DataFrame, fk: str) -> DataFrame:
    """Parent rows no child points to (C4, Q38)."""
    return parent.join(child_keys(child, fk, pk), pk, "left_anti")


def linked(parent: DataFrame, pk: str, child: DataFrame, fk: str) -> DataFrame:
    """Parent rows at least one child points to (left semi, C10)."""
    return parent.join(child_keys(child, fk, pk), pk, "left_semi")
