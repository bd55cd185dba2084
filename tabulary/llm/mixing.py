"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens to the power of an exponent in
[0, 1], normalised: 1 keeps the shares, 0 makes all sources equal.  The
exponent is bisected to the target, an entropy of the weights or a limit on
how often the tokens of a source are repeated.  The weights become a plan per
source: a number of whole blocks, each a permutation of all its documents, and
the beginning of one more block that fills what is left of its budget.

A permutation is the order of md5(seed, block, doc_id).  The beginning of the
last block is found by narrowing: token sums per prefix of the hash and a
running sum over at most 4,096 prefixes a source show the prefix at which the
budget ends, twice, and then the document in it.  So the selection is one hash
per source, documents are taken by comparing with it where they lie, and no
text is shuffled and no source is ordered as a whole.

Everything is a DataFrame expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulary.llm.common import free_names, staged

#: A token here is a run of characters other than blank, tab, line break, VT, FF and CR.
TOKEN = r"[^ \t\n\x0B\f\r]+"
_STEPS = 60


def _tokens(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _place(seed: int, block: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), block.cast("string"), doc_id.cast("string")))


def _budget(budget: float | str) -> Column:
    return F.col("total") if budget == "corpus" else F.lit(float(budget))


def _exponent(sources: DataFrame, entropy: float | None, repeats: float | None,
              budget: float | str | None) -> DataFrame:
    """``alpha``, the least exponent that isn't flatter than the target, by
    bisection inside one expression over the sources' shares."""
    shares = F.transform("t", lambda t: t / F.col("total"))

    def total(f):
        return F.aggregate(shares, F.lit(0.0), lambda a, p: a + f(p))

    def too_flat(alpha: Column) -> Column:
        power = total(lambda p: F.pow(p, alpha))
        if entropy is not None:
            flat = F.log(power) - alpha * total(lambda p: F.pow(p, alpha) * F.log(p)) / power
            return flat > F.lit(entropy) * F.log(F.size("t").cast("double"))
        least, most = F.array_min(shares), F.array_max(shares)
        if budget is None:
            return F.pow(most / least, 1 - alpha) > repeats
        return F.pow(least, alpha - 1) / power * (_budget(budget) / F.col("total")) > repeats

    def halve(x: Column, _: Column) -> Column:
        mid = (x["lo"] + x["hi"]) / 2
        flat = too_flat(mid)
        return F.struct(F.when(flat, mid).otherwise(x["lo"]).alias("lo"),
                        F.when(flat, x["hi"]).otherwise(mid).alias("hi"))

    lists = sources.where("tokens > 0").agg(F.array_sort(F.collect_list(F.col("tokens").cast("double"))).alias("t"),
                                            F.sum("tokens").cast("double").alias("total"))
    bounds = F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)),
                         F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), halve)
    alpha = F.when(too_flat(F.lit(0.0)), bounds["hi"]).otherwise(0.0)
    return lists.select(alpha.alias("alpha"), F.col("total"),
                        total(lambda p: F.pow(p, alpha)).alias("power"),
                        F.array_max(F.transform(shares, lambda p: F.pow(p, 1 - alpha))).alias("widest"))


def plan(docs: DataFrame, entropy: float | None = None, repeats: float | None = None,
         budget: float | str | None = None, seed: int = 7, max_sources: int = 100_000) -> DataFrame:
    """Per source: source, docs, tokens, weight, repeats (budgeted tokens per
    token), blocks (whole ones) and ``until`` (documents of the last block go
    in if their place is less; null: none does).

    ``entropy``: target as a part of that of equal weights, else ``repeats``:
    the most often the tokens of a source may be repeated.  ``budget``: tokens of
    the mixture, "corpus" for as many as the corpus has; None: as few as give
    each document at least once.  One of
    the two targets must be given.  A source without tokens costs nothing and
    is taken once; a null source is a source.  More than ``max_sources``
    sources are refused, since the plan is broadcast.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give either an entropy or a limit of repeats")
    if repeats is not None and repeats < 1:
        raise ValueError("repeats must be 1 or more")
    sized = staged(docs.select("doc_id", "source", _tokens("text").alias("n")), "sized")
    sources = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"))
    share = F.col("tokens") / F.col("total")
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.col("alpha")) / F.col("power")).otherwise(0.0)
    spent = F.col("total") * F.col("power") * F.col("widest") if budget is None else _budget(budget)
    planned = staged(
        sources.crossJoin(F.broadcast(_exponent(sources, entropy, repeats, budget)))     # one row
        .withColumn("weight", weight)
        .withColumn("repeats", F.when(F.col("tokens") > 0, F.col("weight") * spent / F.col("tokens")).otherwise(1.0))
        .withColumn("blocks", F.floor(F.col("repeats") + 1e-9))
        .withColumn("left", F.greatest(F.lit(0), F.floor((F.col("repeats") - F.col("blocks")) * F.col("tokens") + 1e-6)))
        .select("source", "docs", "tokens", "weight", "repeats", "blocks", "left"), "plan")
    if planned.count() > max_sources:
        raise ValueError(f"more than {max_sources} sources")

    goal = planned.select(F.col("source").alias("s"), "blocks", "left", F.lit("").alias("prefix"))
    for size in (3, 6, 32):
        same = (F.col("source").eqNullSafe(F.col("s")))
        units = (
            sized.join(F.broadcast(goal), same)
            .withColumn("place", _place(seed, F.col("blocks"), F.col("doc_id")))
            .where(F.col("place").startswith(F.col("prefix")))
            .groupBy("s", "blocks", "left", F.substring("place", 1, size).alias("prefix")).agg(F.sum("n").alias("n")))
        upto = F.sum("n").over(Window.partitionBy("s").orderBy("prefix").rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
        goal = staged(
            units.withColumn("upto", upto).groupBy("s", "blocks", "left").agg(
                F.min(F.when(F.col("upto") > F.col("left"), F.col("prefix"))).alias("prefix"),
                F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))).alias("used"))
            .where("prefix IS NOT NULL")
            .select("s", "blocks", (F.col("left") - F.coalesce("used", F.lit(0))).alias("left"), "prefix"), "goal")
    return planned.join(F.broadcast(goal.select("s", F.col("prefix").alias("until"))),
                        F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def mix(docs: DataFrame, entropy: float | None = None, repeats: float | None = None,
        budget: float | str | None = None, seed: int = 7, places: bool = False) -> DataFrame:
    """The rows of the mixture: those of ``docs`` with all their columns, once for each block
    they are in, and ``mix_block``, ``mix_tokens``.  See :func:`plan`.  ``places``
    adds ``mix_place``: a source's block is its rows in the order of their places.

    Documents whose places are equal (the same doc_id) go in together.  A last
    block never goes over its budget.  A null text has no tokens.  Columns of
    ``docs`` that have the name of a result are replaced.
    """
    docs = docs.drop("mix_block", "mix_tokens", "mix_place")
    of, blocks, left, until = free_names(docs.columns, "of_source", "blocks", "left", "until")
    planned = plan(docs, entropy, repeats, budget, seed).select(
        F.col("source").alias(of), F.col("blocks").alias(blocks), F.col("left").alias(left), F.col("until").alias(until))
    place = _place(seed, F.col(blocks), F.col("doc_id"))
    part = (F.col(left) > 0) & (F.col(until).isNull() | (place < F.col(until)))
    most = F.col(blocks) + F.when(part, 1).otherwise(0) - 1
    mixed = (
        docs.join(F.broadcast(planned), F.col("source").eqNullSafe(F.col(of)))
        .where(most >= 0)
        .select(*(F.col(c) for c in docs.columns), _tokens("text").alias("mix_tokens"),
                F.explode(F.sequence(F.lit(0).cast("long"), most)).alias("mix_block")))
    return mixed.withColumn("mix_place", _place(seed, F.col("mix_block"), F.col("doc_id"))) if places else mixed


def oracle(entropy: float, budget: str, seed: int = 7, table: str = "documents") -> str:
    """DuckDB SQL of the mixture's rows for an entropy target."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\v\\f\\r]+')) AS n FROM {table}),
s AS (SELECT source, sum(n)::DOUBLE AS t FROM d GROUP BY source),
p AS (SELECT source, t, t / (SELECT sum(t) FROM s) AS p FROM s WHERE t > 0),
h(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN flat THEN mid ELSE lo END, CASE WHEN flat THEN hi ELSE mid END
  FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid,
               ln(sum(pow(p, (lo + hi) / 2))) - (lo + hi) / 2 * sum(pow(p, (lo + hi) / 2) * ln(p)) / sum(pow(p, (lo + hi) / 2))
                 > {entropy} * ln(count(*)) AS flat
        FROM h CROSS JOIN p WHERE step < {_STEPS} GROUP BY step, lo, hi)),
a AS (SELECT CASE WHEN ln((SELECT count(*) FROM p)) > {entropy} * ln((SELECT count(*) FROM p)) + 0
             THEN (SELECT hi FROM h WHERE step = {_STEPS}) ELSE 0.0 END AS alpha),
w AS (SELECT source, t, pow(p, alpha) / sum(pow(p, alpha)) OVER () AS w FROM p, a),
r AS (SELECT source, t, w * ({budget})::DOUBLE / t AS r FROM w),
k AS (SELECT source, floor(r + 1e-9)::BIGINT AS blocks,
             greatest(0, floor((r - floor(r + 1e-9)) * t + 1e-6)) AS room FROM r
      UNION ALL SELECT source, 1, 0 FROM s WHERE t = 0),
o AS (SELECT doc_id, d.source, n, blocks, room,
             sum(n) OVER (PARTITION BY d.source ORDER BY md5('{seed}|' || blocks || '|' || doc_id)) AS upto
      FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, source, n AS n_tokens,
       unnest(range(0, blocks + CASE WHEN room > 0 AND upto <= room THEN 1 ELSE 0 END)) AS block FROM o"""
