"""Quality checks (survey Q1-Q37, D1-D4, D10, D11, G1).

Each check is one row ``(check_name, issue_count)``.  Per-row checks of one
table are computed in one aggregate; duplicate checks and foreign keys of many
tables in one aggregate each, with map-side partial counts.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import staged
from .joins import broken_fk


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table (Q1, G1)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups occurring more than once: (keys..., cnt)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def duplicate_count(df: DataFrame, keys: list[str], check_name: str) -> DataFrame:
    """Number of duplicate groups as one check row."""
    return (duplicate_groups(df, keys).agg(F.count(F.lit(1)).alias("issue_count"))
            .select(F.lit(check_name).alias("check_name"), "issue_count"))


def count_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Many conditional counts over one scan, unpivoted to rows."""
    wide = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(checks.values())])
    pairs = ", ".join(f"'{name}', c{i}" for i, name in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {pairs}) as (check_name, issue_count)")


def fk_check(child: DataFrame, fk: str, parent: DataFrame, pk: str, check_name: str) -> DataFrame:
    """Number of child rows with a broken foreign key, as one check row
    (Q25-Q32).  Children are counted per key first (map-side), so only one
    row per distinct key reaches the anti join's shuffle."""
    per_key = (child.filter(F.col(fk).isNotNull()).groupBy(fk)
               .agg(F.count(F.lit(1)).alias("__n")))
    broken = broken_fk(per_key, fk, parent, pk)
    return (broken.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("issue_count"))
            .select(F.lit(check_name).alias("check_name"), "issue_count"))


def fk_checks(child: DataFrame, specs: list[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Several foreign keys of one child table, ``specs`` = [(check_name, fk,
    parent, pk)].  Children are counted per key before the join, so a hot key
    is one row per task."""
    return reduce(DataFrame.unionByName, [fk_check(child, fk, parent, pk, name) for name, fk, parent, pk in specs])


def _as_longs(df: DataFrame, keys: list[str]) -> list[Column] | None:
    """One or two columns of numbers or dates as longs, which stand for the
    key; None for other keys."""
    out = []
    for k in keys:
        kind = df.schema[k].dataType
        if isinstance(kind, T.IntegralType):
            out.append(F.col(k).cast("long"))
        elif isinstance(kind, T.DateType):
            out.append(F.unix_date(k).cast("long"))
    return [*out, F.lit(None).cast("long")][:2] if len(out) == len(keys) <= 2 else None


def _hashes(keys: list[str]) -> list[Column]:
    """128 bits of hash.  A hash passes over nulls, so it is told where they are."""
    seen = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    return [F.xxhash64(*seen), F.xxhash64(F.lit(1), *seen)]


def duplicate_counts(tables: Mapping[str, DataFrame], checks: list[tuple[str, str, list[str]]]) -> DataFrame:
    """Number of duplicate groups for many key sets, ``checks`` = [(check_name,
    table, keys)], one row each (Q2-Q9, D8, D11).

    Each key set reads its own columns, as two longs: the key itself, or 128
    bits of its hash.  One aggregate over all sets counts them by (check, key),
    and what stands more than once is staged.  Rows whose hash is among that
    are read again and counted by their values, so equal hashes of different
    keys don't count (and text compares under its collation only then, so a
    set with collated text is counted by its values alone).
    """
    def collated(name: str, keys: list[str]) -> bool:
        kinds = [tables[name].schema[k].dataType for k in keys]
        return any(isinstance(k, T.StringType) and k.simpleString() != "string" for k in kinds)

    exact, hashed, valued = {}, {}, {}
    for number, (_, name, keys) in enumerate(checks):
        longs = _as_longs(tables[name], keys)
        if collated(name, keys):
            valued[number] = tables[name]
        elif longs:
            exact[number] = longs
        else:
            hashed[number] = _hashes(keys)
    found = []
    if exact or hashed:
        keyed = [tables[checks[n][1]].select(F.lit(n).alias("check"), a.alias("a"), b.alias("b")) for n, (a, b) in {**exact, **hashed}.items()]
        repeated = staged(
            reduce(DataFrame.unionAll, keyed).groupBy("check", "a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
            "repeated-keys")
        found.append(repeated.where(F.col("check").isin(list(exact))).select("check", F.lit(1).alias("n")))
        for row in repeated.where(F.col("check").isin(list(hashed))).select("check").distinct().collect():
            df, n = tables[checks[row.check][1]], row.check
            a, b = hashed[n]
            again = repeated.where(F.col("check") == n).select(F.col("a").alias("__a"), F.col("b").alias("__b"))
            valued[n] = df.select(*checks[n][2]).join(again, (a == F.col("__a")) & (b == F.col("__b")), "left_semi")
    found += [duplicate_groups(df, checks[n][2]).select(F.lit(n).alias("check"), F.lit(1).alias("n")) for n, df in valued.items()]
    return _per_check(found, [name for name, _, _ in checks], next(iter(tables.values())).sparkSession)


def _per_check(found: list[DataFrame], names: list[str], spark: SparkSession) -> DataFrame:
    """The sum of ``n`` by ``check`` (a number), for all names: 0 where none was found."""
    none = spark.range(len(names)).select(F.col("id").cast("int").alias("check"), F.lit(0).alias("n"))
    label = F.get(F.array(*map(F.lit, names)), F.col("check"))
    return (reduce(DataFrame.unionAll, [none, *found]).groupBy("check").agg(F.sum("n").cast("long").alias("issue_count"))
            .select(label.alias("check_name"), "issue_count"))


def fk_counts(tables: Mapping[str, DataFrame], relations: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """Number of child rows with a broken foreign key for many ``relations``
    = [(check_name, child, fk, parent, pk)], one row each (Q25-Q32, C4).

    Child keys and parent keys of all relations, each read from its own
    column, are one tagged union, and one aggregate by (relation, key) keeps
    what has children and no parent.  Keys are combined map-side, so a hot key
    is one row a task; NULL keys aren't broken.
    """
    kinds = [tables[p].schema[pk].dataType for _, _, _, p, pk in relations]
    common = "long" if all(isinstance(k, T.IntegralType) for k in kinds) else "string"

    def side(number: int, table_: str, column: str, parent: bool) -> DataFrame:
        return tables[table_].where(F.col(column).isNotNull()).select(
            F.lit(number).alias("check"), F.col(column).cast(kinds[number]).cast(common).alias("key"),
            F.lit(0 if parent else 1).cast("long").alias("n"), F.lit(parent).alias("parent"))

    tagged = [side(n, *of) for n, (_, c, fk, p, pk) in enumerate(relations) for of in ((c, fk, False), (p, pk, True))]
    broken = (reduce(DataFrame.unionAll, tagged).groupBy("check", "key").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
              .where("NOT parent").select("check", "n"))
    return _per_check([broken], [name for name, *_ in relations], next(iter(tables.values())).sparkSession)


def with_expectations(checks: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """Add ``expected`` (default 0) and ``passed`` columns."""
    expected = expected or {}
    exp = F.lit(0).cast("long")
    for name, value in expected.items():
        exp = F.when(F.col("check_name") == name, F.lit(value).cast("long")).otherwise(exp)
    return (checks.withColumn("issue_count", F.col("issue_count").cast("long"))
            .withColumn("expected", exp)
            .withColumn("passed", F.col("issue_count") == F.col("expected")))


class CheckFailed(AssertionError):
    pass


def assert_checks(report: DataFrame) -> None:
    """Raise when any check failed, naming all that did (a report has one row
    per declared check)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.check_name}: {r.issue_count} (expected {r.expected})"
                                    for r in failed))
