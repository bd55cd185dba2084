"""Reports (survey Q38-Q54, C7-C10, D5-D7, D9, D12, F1-F3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import child_keys
from .keys import key_order


def group_counts(parent: DataFrame, pk: str, label: str, child: DataFrame, fk: str,
                 out: str) -> DataFrame:
    """Children per parent with zero-count parents kept.

    Children are counted per key first (map-side partial aggregation), so the
    join sees one row per parent on each side instead of every child row.
    """
    per_key = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias(out))
    return (parent.select(pk, label)
            .join(per_key.withColumnRenamed(fk, pk), pk, "left")
            .select(label, F.coalesce(F.col(out), F.lit(0)).cast("long").alias(out)))


def top_k(df: DataFrame, k: int | None, by: str, tie: list[str]) -> DataFrame:
    """Order by ``by`` descending with a tie-breaker; ``k`` rows if given."""
    ordered = df.orderBy(F.col(by).desc(), *[F.col(t).asc_nulls_first() for t in tie])
    return ordered.limit(k) if k else ordered


def value_frequency(df: DataFrame, col: str | Column, name: str, out: str = "frequency") -> DataFrame:
    """(value, frequency)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias(out))


def value_range(df: DataFrame, col: str, prefix: str, digits: int | None = None) -> DataFrame:
    """min, max and average over non-NULL values (D5, D6).  The average of a
    decimal is the exact decimal; ``digits`` rounds that of a double."""
    c = F.col(col)
    mean = F.avg(c) if digits is None else F.round(F.avg(c), digits)
    return df.filter(c.isNotNull()).agg(
        F.min(c).alias(f"min_{prefix}"), F.max(c).alias(f"max_{prefix}"), mean.alias(f"avg_{prefix}"))


def group_size_histogram(child: DataFrame, fk: str, size_name: str,
                         out: str = "parent_count") -> DataFrame:
    """How many parents have n children (D12): two aggregates, both with
    partial aggregation."""
    sizes = child.groupBy(fk).agg(F.count(F.lit(1)).alias(size_name))
    return sizes.groupBy(size_name).agg(F.count(F.lit(1)).alias(out))


def oversized_groups(child: DataFrame, fk: str, limit: int) -> DataFrame:
    """Number of parents with more than ``limit`` children."""
    sizes = child.groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    return sizes.filter(F.col("n") > limit).agg(F.count(F.lit(1)).alias("parent_count"))


def in_neither(parent: DataFrame, pk: str, first: DataFrame, second: DataFrame,
               fk: str) -> DataFrame:
    """Parents referenced by neither child table (C5: two anti joins)."""
    return (parent.join(child_keys(first, fk, pk), pk, "left_anti")
            .join(child_keys(second, fk, pk), pk, "left_anti"))


def joined_preview(parent: DataFrame, child: DataFrame, key: str, cols: list[str],
                   order: list[str], k: int) -> DataFrame:
    """First ``k`` parent-child rows in key order (C7 + F3).

    When the order is on child columns, the top ``k`` is taken from the child
    rows that have a parent (a semi join: only keys are shuffled), and only
    those ``k`` rows are joined to the parent, broadcast.  Otherwise the full
    join is ordered.

    If the order begins with ``key`` and the staged children lie in it
    (``with_inherited_key``), their first parts are read alone, and more of
    them until ``k`` rows with a parent are there; of parents that lie in the
    order of ``key`` only the parts up to the last of these are read.
    """
    ordering = [F.col(c).asc_nulls_first() for c in order]
    if not all(c in child.columns for c in order):
        return parent.join(child, key, "inner").select(*cols).orderBy(*ordering).limit(k)
    kept, of = key_order(child), parent
    if kept is not None and order[0] == key:
        want, rows, whole = k, [], False
        while len(rows) < k and not whole:
            part, whole = kept.first(want)
            of = parent
            if (parents := key_order(parent)) is not None:
                of = parents.upto(part.agg(F.max(key)).first()[0] or 0)
            # At most k rows, which the report consists of.
            top = part.join(of.select(key), key, "left_semi").orderBy(*ordering).limit(k)
            rows, want = top.collect(), 8 * want
        top = child.sparkSession.createDataFrame(rows, top.schema)
    else:
        top = child.join(parent.select(key), key, "left_semi").orderBy(*ordering).limit(k)
    return F.broadcast(top).join(of, key, "inner").select(*cols).orderBy(*ordering)
