"""Dense surrogate keys (survey A11).

``with_dense_key`` numbers rows 1..n (plus ``start``) in the order of a total
key without a single-partition window:

1. range-partition and sort by the order key (one shuffle, sampled bounds;
   AQE sizes the partitions unless a count is given);
2. write the rows as Parquet into the shared folder, each with its
   partition's number and its position in it, so the numbering is fixed and
   survives executor loss, and later reads take the columns they need;
3. count rows per partition, from those two columns alone;
4. key = start + rows in earlier partitions + position + 1.  The offsets are
   one row per partition, so their broadcast is bounded by the layout.

Rows made from keyed rows one by one (children) inherit that order, so
``with_inherited_key`` numbers them without a shuffle: a block of a staged
file is read by one task in file order, children are counted per block, and
key = children of earlier blocks + position in the block.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged

#: A staged row's file (the number of its range) and the block of it that a task reads.
_FILE, _BLOCK = "__pid", "__block"


@dataclass(frozen=True)
class KeyOrder:
    """How a staged table lies in the order of its keys: the row counts of its
    parts, and a function from a condition on the parts to the rows of those
    for which it holds (the condition is pushed into the scan)."""

    parts: tuple[tuple[Column, int], ...]        # (whether a row is in this part or an earlier one, rows of the part)
    rows: Callable[[Column], DataFrame]

    def first(self, n: int) -> tuple[DataFrame, bool]:
        """The least whole parts with ``n`` rows, and whether they are all."""
        seen = 0
        for k, (upto, own) in enumerate(self.parts):
            seen += own
            if seen >= n:
                return self.rows(upto), k + 1 == len(self.parts)
        return self.rows(F.lit(True)), True

    def upto(self, key: int, start: int = 0) -> DataFrame:
        """The least whole parts with the keys to ``key``, of keys that go on from ``start``."""
        return self.first(key - start)[0]


def key_order(df: DataFrame) -> KeyOrder | None:
    """The order of a table from this module, if it is known."""
    return df.__dict__.get("_key_order")


def _order_cols(order: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def with_dense_key(df: DataFrame, key: str, order: list[str | Column],
                   start: int | Column = 0, num_partitions: int | None = None) -> DataFrame:
    """Add ``key`` = start + 1..n following ``order`` (which must be total for
    the numbering to be deterministic).  Returns ``key`` first, then the
    other columns."""
    cols = _order_cols(order)
    # Without an explicit count the range exchange is sized by AQE, which only
    # merges adjacent ranges, so partition order still follows the key.
    exchange = (df.repartitionByRange(num_partitions, *cols) if num_partitions
                else df.repartitionByRange(*cols))
    pid = F.spark_partition_id()
    placed = staged(
        exchange.sortWithinPartitions(*cols).select(
            "*", pid.alias("__pid"),
            (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("__pos")), key)
    counts = {r["__pid"]: r["n"] for r in placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    pids = sorted(counts)
    offsets = [0, *accumulate(counts[p] for p in pids)][:-1] if pids else []
    table_ = df.sparkSession.createDataFrame(list(zip(pids, offsets)), "__pid int, __base long")
    start_col = (start if isinstance(start, Column) else F.lit(start)).cast("long")

    def keyed(rows: DataFrame, *more: str) -> DataFrame:
        return rows.join(F.broadcast(table_), _FILE).select(
            (start_col + F.col("__base") + F.col("__pos") + F.lit(1)).alias(key), *df.columns, *more)

    out = keyed(placed)
    out.__dict__["_key_order"] = KeyOrder(
        tuple((F.col(_FILE) <= p, counts[p]) for p in pids), lambda part: keyed(placed.where(part)))
    out.__dict__["_in_order"] = keyed(placed.select("*", F.col("_metadata.file_block_start").alias(_BLOCK)), _FILE, _BLOCK)
    if isinstance(start, int):
        out.__dict__["_known_max_key"] = start + sum(counts.values())
    return out


def derived(df: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``make(df)``, where ``make`` only adds, replaces or drops columns: what is
    known of the order of the rows' keys is known of the result (for
    :func:`with_inherited_key` if ``make`` hands other columns on)."""
    out = make(df)
    if (ordered := df.__dict__.get("_in_order")) is not None and _FILE in (made := make(ordered)).columns:
        out.__dict__["_in_order"] = made
    if (order := key_order(df)) is not None:
        out.__dict__["_key_order"] = KeyOrder(order.parts, lambda part: make(order.rows(part)))
    return out


def with_inherited_key(parents: DataFrame, key: str, children: Callable[[DataFrame, list[str]], DataFrame],
                       order: list[str]) -> DataFrame:
    """Add ``key`` = 1..n to the children of ``parents``, in the order of
    ``order`` (the parents' key, then the position among a parent's children).

    ``children(frame, keep)`` makes the rows of each parent, in their order,
    by narrow steps, and hands the columns ``keep`` on.  If ``parents`` come
    from :func:`with_dense_key` (by way of :func:`derived`), nothing is
    shuffled; others are sorted.
    """
    ordered = parents.__dict__.get("_in_order")
    if ordered is None:
        return with_dense_key(children(parents, []), key, order)
    rows = children(ordered, [_FILE, _BLOCK])
    columns = [c for c in rows.columns if c not in (_FILE, _BLOCK)]
    placed = staged(rows.withColumn("__pos", F.monotonically_increasing_id()), key)
    blocks = sorted(map(tuple, placed.groupBy(_FILE, _BLOCK).agg(
        F.count(F.lit(1)), F.min("__pos"), F.max("__pos")).collect()))
    if any(last - first + 1 != n for _, _, n, first, last in blocks):
        raise RuntimeError("a block's rows weren't read one after another")
    offsets = [0, *accumulate(n for _, _, n, _, _ in blocks)][:-1]
    table_ = parents.sparkSession.createDataFrame(
        [(f, b, base - first) for (f, b, _, first, _), base in zip(blocks, offsets, strict=False)],
        f"{_FILE} int, {_BLOCK} long, __base long")

    def keyed(part: DataFrame) -> DataFrame:
        return part.join(F.broadcast(table_), [_FILE, _BLOCK]).select(
            (F.col("__base") + F.col("__pos") + F.lit(1)).alias(key), *columns)

    out = keyed(placed)
    out.__dict__["_key_order"] = KeyOrder(tuple(
        ((F.col(_FILE) < f) | ((F.col(_FILE) == f) & (F.col(_BLOCK) <= b)), n) for f, b, n, _, _ in blocks),
        lambda part: keyed(placed.where(part)))
    out.__dict__["_known_max_key"] = sum(n for _, _, n, _, _ in blocks)
    return out


def known_max_key(df: DataFrame) -> int | None:
    """The largest key, if ``df`` came from :func:`with_dense_key`."""
    return df.__dict__.get("_known_max_key")
