"""Exact k nearest binary codes by incremental multi-index hashing.

A code of up to 64 bits is cut into m segments, and every segment is an index
key.  A query looks up the keys that differ from its segments in s bits, one
segment after another, for s = 0, 1, 2, ..., and compares what it finds by the
whole code.  After t + 1 of these look-ups, what it hasn't found differs in
more than t bits, since it differs in more bits of each segment than were
looked up there; so the query is done when its k-th distance is at most t.

A task holds up to ``QUERIES`` queries and reads up to ``CODES`` codes, which
come to it packed.  It indexes ``INDEXED`` of them at a time; the distances
that a query has reached so far hold for the codes to come.  The queries that
share a segment's value are compared with the codes of a key together, pair by
pair in numpy, so no row is made of a key or of a pair that isn't among a
query's nearest.  The number of segments is that of the least work for so many
codes and queries; look-ups that would read more than half of the codes are
given up for a comparison with all of them.

Equal codes are one entry with their least ids, as many as an answer can use,
and queries with equal codes search once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulary.llm.common import staged
from tabulary.operators.keys import with_dense_key

MOST_BITS = 64
#: Codes and queries of a task, codes indexed at once, codes and queries packed in a row.
CODES, QUERIES, INDEXED, PACKED, ASKED = 1 << 24, 1 << 17, 1 << 21, 1 << 16, 1 << 12
#: Pairs and queries compared at once, pairs kept until they are merged, and the distance of a place that is still free.
TILE, GROUP, KEPT, FREE = 1 << 17, 32, 1 << 19, 255
#: Bits of a segment at most: a chunk has a list of codes for each value.
WIDEST = 16
#: What a group of queries and a key take, in pairs compared.
GROUP_COST, KEY_COST, READ_COST = 30_000, 250, 1.2


def sign_code(vector: Column) -> Column:
    """One bit per coordinate, set if it is above 0; null for a null or empty
    vector.  A null coordinate's bit isn't set."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i))
                       .otherwise(F.lit(0).cast("long")))
    return F.when(F.size(vector) > 0, F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)))


def _widths(bits: int, m: int) -> list[int]:
    """``bits`` in m segments that are as long as one another, or longer by one bit."""
    return [bits // m + (j < bits % m) for j in range(m)]


@cache
def _masks(width: int, s: int) -> np.ndarray:
    """The values of ``width`` bits with s bits set."""
    return np.array([sum(1 << b for b in chosen) for chosen in combinations(range(width), s)], dtype=np.int64)


def _look_ups(bits: int, m: int) -> Iterator[tuple[int, int, int]]:
    """Segment, bits that differ and part of the codes, in the order of the
    search, until all values are looked up or half of the codes were read."""
    read, widths = 0.0, _widths(bits, m)
    for s in range(widths[0] + 1):
        for j, width in enumerate(widths):
            part = math.comb(width, s) / (1 << width)
            read += part
            if read > 0.5:
                return
            yield j, s, part


@cache
def segments(n: int, q: int, most: int, bits: int) -> int:
    """The number of segments of the least work for n codes, q queries and
    ``most`` neighbours if codes were drawn at random; 0 to compare all."""
    near = list(accumulate(math.comb(bits, d) / 2**bits for d in range(bits + 1)))
    radius = next((d for d, share in enumerate(near) if n * share >= most), bits)
    costs = {0: float(n) * q}
    for m in range(-(-bits // WIDEST), bits + 1):
        widths, cost, t = _widths(bits, m), 0.0, -1
        for t, (j, s, part) in enumerate(_look_ups(bits, m)):
            if t > radius:
                break
            keys, groups = math.comb(widths[j], s), min(q, 1 << widths[j])
            cost += groups * (GROUP_COST + keys * KEY_COST + n * part * READ_COST) + q * n * part
        costs[m] = cost if t >= radius else cost + costs[0]
    return min(costs, key=costs.get)


class Search:
    """The nearest ``most`` codes of each query, of the codes handed to :meth:`add`.

    ``distance``, ``first`` and ``code`` have a row for each query, in order;
    a place without a code has the distance ``FREE``.
    """

    def __init__(self, queries: np.ndarray, most: int, bits: int):
        self.queries, self.most, self.bits = queries, most, bits
        shape = (len(queries), most)
        self.distance = np.full(shape, FREE, dtype=np.uint8)
        self.first = np.full(shape, np.iinfo(np.int64).max)
        self.code = np.zeros(shape, dtype=np.uint64)
        self._bound = np.full(len(queries), FREE, dtype=np.uint8)       # nothing farther can be among the nearest
        self._pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._n_pairs = 0
        self._tiles = np.empty(TILE, dtype=np.uint64), np.empty(TILE, dtype=np.uint8), np.empty(TILE, dtype=bool)

    def add(self, codes: np.ndarray, firsts: np.ndarray, m: int | None = None) -> None:
        """Search codes, each of them new, with the ids that decide between equal distances."""
        if not len(codes) or not len(self.queries):
            return
        order = np.argsort(codes)
        self._codes, self._firsts = codes[order], firsts[order]
        del codes, firsts, order
        active = np.arange(len(self.queries))
        m = segments(len(self._codes), len(active), self.most, self.bits) if m is None else m
        if m:
            widths = _widths(self.bits, m)
            begins = [0, *accumulate(widths)]
            for t, (j, s, _) in enumerate(_look_ups(self.bits, m)):
                self._look_up(active, np.uint64(begins[j]), widths[j], s)
                self._merge()
                active = active[self.distance[active, -1] > t]
                if not len(active):
                    return
        self._compare(active, self._codes)
        self._merge()

    def _look_up(self, active: np.ndarray, begin: np.uint64, width: int, s: int) -> None:
        """Compare queries with the codes that differ from them in s bits of a segment."""
        values = [((x >> begin) & np.uint64((1 << width) - 1)).astype(np.uint16) for x in (self._codes, self.queries[active])]
        in_order = self._codes[np.argsort(values[0], kind="stable")]
        ends = np.cumsum(np.bincount(values[0], minlength=1 << width)).tolist()
        of = [in_order[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        by_value = np.argsort(values[1], kind="stable")
        asked, starts = np.unique(values[1][by_value], return_index=True)
        masks = _masks(width, s)
        for value, group in zip(asked.tolist(), np.split(active[by_value], starts[1:]), strict=True):
            found = [of[v] for v in (masks ^ value).tolist()]
            self._compare(group, np.concatenate(found) if len(found) > 1 else found[0])

    def _compare(self, queries: np.ndarray, codes: np.ndarray) -> None:
        """Keep the pairs that may be among the nearest."""
        for b in range(0, len(queries), GROUP):
            group = queries[b:b + GROUP]
            bits, step = self.queries[group][:, None], TILE // len(group)
            for a in range(0, len(codes), step):
                part = codes[a:a + step]
                apart, distance, near = (x[:len(group) * len(part)].reshape(len(group), len(part)) for x in self._tiles)
                np.bitwise_xor(bits, part, out=apart)
                np.bitwise_count(apart, out=distance)
                bound = self._bound[group]
                if len(part) >= self.most and bound.max() == FREE:
                    bound = np.minimum(bound, np.partition(distance, self.most - 1, axis=1)[:, self.most - 1])
                    self._bound[group] = bound
                np.less_equal(distance, bound[:, None], out=near)
                at = np.flatnonzero(near)
                if len(at):
                    row, column = np.divmod(at, len(part))
                    self._pairs.append((group[row], distance.ravel()[at], part[column]))
                    self._n_pairs += len(at)
                    if self._n_pairs >= KEPT:
                        self._merge()

    def _merge(self) -> None:
        """Put the kept pairs among the nearest."""
        if not self._n_pairs:
            return
        query, distance, code = map(np.concatenate, zip(*self._pairs, strict=True))
        self._pairs, self._n_pairs = [], 0
        first = self._firsts[np.searchsorted(self._codes, code)]
        last = self.distance[query, -1]
        new = (distance < last) | (distance == last) & (first < self.first[query, -1])
        if not new.any():
            return
        query, distance, code, first = query[new], distance[new], code[new], first[new]
        rows = np.unique(query)
        held, place = np.nonzero(self.distance[rows] != FREE)
        held = rows[held]
        query, distance, code, first = map(np.concatenate, (
            (held, query), (self.distance[rows][self.distance[rows] != FREE], distance),
            (self.code[held, place], code), (self.first[held, place], first)))
        order = np.lexsort((code, first, query << 8 | distance))
        query, distance, code, first = query[order], distance[order], code[order], first[order]
        own = np.ones(len(query), dtype=bool)               # a code may be found by several segments
        own[1:] = (query[1:] != query[:-1]) | (code[1:] != code[:-1])
        query, distance, code, first = query[own], distance[own], code[own], first[own]
        begins = np.searchsorted(query, rows)
        place = np.arange(len(query)) - np.repeat(begins, np.diff([*begins, len(query)]))
        best = place < self.most
        at = query[best], place[best]
        self.distance[at], self.first[at], self.code[at] = distance[best], first[best], code[best]
        self._bound[rows] = np.minimum(self._bound[rows], self.distance[rows, -1])


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _pack(size: int, parts: int):
    """Rows of up to ``size`` codes and what belongs to them, dealt to so many parts in turn."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept, n = TaskContext.get().partitionId(), [], 0

        def packed(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at % parts], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in rows)],
                ["part", "codes", "firsts"])

        for batch in batches:
            kept.append(np.stack([_longs(batch.column("code")), _longs(batch.column("first"))]))
            n += batch.num_rows
            if n >= size:
                rows = np.concatenate(kept, axis=1)
                for a in range(0, n - n % size, size):
                    yield packed(rows[:, a:a + size])
                    at += 1
                kept, n = [rows[:, n - n % size:]], n % size
        if n:
            yield packed(np.concatenate(kept, axis=1))

    return run


def _answers(most: int, bits: int, indexed: int):
    """The nearest of each pair of a part of the codes and one of the queries,
    from packed rows with the pairs together and their queries first."""
    def longs(rows: list[bytes]) -> np.ndarray:
        joined = b"".join(rows)
        rows.clear()
        return np.frombuffer(joined, dtype=np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, search, asked, codes, firsts, n = None, None, [], [], [], 0

        def add() -> None:
            nonlocal search, n
            if search is None:
                search = Search(longs(asked).view(np.uint64), most, bits)
            n = 0
            search.add(longs(codes).view(np.uint64), longs(firsts))

        def found() -> Iterator[pa.RecordBatch]:
            add()
            for a in range(0, len(search.queries), 1 << 14):
                part = slice(a, a + (1 << 14))
                row, place = np.nonzero(search.distance[part] != FREE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(search.queries[part][row].view(np.int64)), pa.array(search.code[part][row, place].view(np.int64)),
                     pa.array(search.first[part][row, place]), pa.array(search.distance[part][row, place].astype(np.int32))],
                    ["query", "code", "first", "distance"])

        for batch in batches:
            for i in range(batch.num_rows):
                now, is_code = batch.column("pair")[i].as_py(), batch.column("is_code")[i].as_py()
                if now != pair:
                    if pair is not None:
                        yield from found()
                    pair, search = now, None
                if is_code:
                    codes.append(batch.column("codes")[i].as_py())
                    firsts.append(batch.column("firsts")[i].as_py())
                    n += len(codes[-1]) // 8
                    if n >= indexed:
                        add()
                else:
                    asked.append(batch.column("codes")[i].as_py())
        if pair is not None:
            yield from found()

    return run


def _search(entries: DataFrame, active: DataFrame, most: int, bits: int) -> DataFrame:
    """query, code, first, distance: of each query, the ``most`` codes of least (distance, first) in each part of the entries.

    ``entries`` have columns code and first, ``active`` the column code; all codes differ.
    """
    n, q = entries.count(), active.count()
    parts = max(1, math.ceil(n / CODES))
    in_task = max(ASKED, min(QUERIES, (1 << 21) // most))
    tasks = 2 * entries.sparkSession.sparkContext.defaultParallelism        # at least, if there are so many queries
    askers = max(1, math.ceil(q / in_task), min(math.ceil(q / (2 * ASKED)), math.ceil(tasks / parts)))
    row = "part int, codes binary, firsts binary"
    codes = entries.select("code", "first").mapInArrow(_pack(PACKED, parts), row)
    asked = active.select("code", F.lit(0).cast("long").alias("first")).mapInArrow(_pack(ASKED, askers), row)
    pairs = codes.select(F.explode(F.sequence(F.lit(0), F.lit(askers - 1))).alias("asker"), "part", "codes", "firsts", F.lit(True).alias("is_code")) \
        .unionAll(asked.select(F.col("part").alias("asker"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "codes", "firsts", F.lit(False)))
    return pairs.select((F.col("part") * askers + F.col("asker")).alias("pair"), "is_code", "codes", "firsts") \
        .repartitionById(parts * askers, F.col("pair")).sortWithinPartitions("pair", "is_code") \
        .mapInArrow(_answers(most, bits, INDEXED), "query long, code long, first long, distance int")


def nearest(codes: DataFrame, queries: DataFrame, k: int = 10, bits: int = MOST_BITS) -> DataFrame:
    """Per query and rank: id, rank, neighbour, distance.

    ``codes`` and ``queries`` have columns id and code (a long whose lowest
    ``bits`` bits count).  Neighbours are the k other ids of least (distance,
    id); fewer if there aren't as many.  Rows with a null id or code are left
    out; repeated rows count once.
    """
    if not 0 < bits <= MOST_BITS:
        raise ValueError(f"codes have 1 to {MOST_BITS} bits")
    known = codes.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    asked = queries.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    by_code = Window.partitionBy("code").orderBy("id")
    entries = staged(
        known.withColumn("n", F.row_number().over(by_code)).where(F.col("n") <= k + 1)      # an answer uses no more
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    active = staged(asked.select("code").distinct(), "queries")
    firsts = entries.select("code", F.col("ids")[0].alias("first"))
    if dict(codes.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint"):
        firsts = firsts.withColumn("first", F.col("first").cast("long"))
    else:           # other ids are numbered in their order
        firsts = with_dense_key(firsts.withColumnRenamed("first", "id"), "first", ["id", "code"]).select("code", "first")
    found = _search(firsts, active, k + 1, bits)
    done = staged(
        found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("distance", "first")))
        .where(F.col("n") <= k + 1).select("query", "code", "distance"), "found")
    lists = (
        done.join(entries, "code").select("query", "distance", F.explode("ids").alias("neighbour"))
        .withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbour")))
        .where(F.col("n") <= k + 1)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbour"))).alias("near")))
    return (
        asked.join(lists, F.col("code") == F.col("query"))
        .select("id", F.posexplode(F.slice(F.filter("near", lambda x: x["neighbour"] != F.col("id")), 1, k)).alias("n", "x"))
        .select("id", (F.col("n") + 1).alias("rank"), F.col("x.neighbour").alias("neighbour"),
                F.col("x.distance").alias("distance")))


def oracle(k: int = 10, every: int = 20, bits: int = MOST_BITS, table: str = "embeddings") -> str:
    """DuckDB SQL that compares the signs of each query and each row."""
    return f"""
WITH e AS (SELECT DISTINCT vec_id, list_transform(range(1, {bits + 1}), lambda i: coalesce(embedding[i] > 0, false)) AS b
           FROM {table} WHERE vec_id IS NOT NULL AND len(embedding) > 0),
d AS (SELECT q.vec_id AS id, e.vec_id AS neighbour,
             list_sum(list_transform(range(1, {bits + 1}), lambda i: CASE WHEN q.b[i] <> e.b[i] THEN 1 ELSE 0 END)) AS distance
      FROM e AS q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM d)
SELECT id AS vec_id, rank, neighbour AS neighbour_id, distance AS hamming FROM r WHERE rank <= {k}"""
