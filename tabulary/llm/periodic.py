"""Periodic runs of words, by suffix trees and Lyndon roots.

A run is a stretch of words with smallest period q that no neighbour extends.
Every run of two periods or more holds a Lyndon root: at some place i of it
the longest Lyndon word that begins at i, under the order of the symbols or
under its reverse, is q long.  So each place gives two candidates (i, q), and
each is extended in both directions by one question to a suffix tree of the
text and one to a tree of its reversal: how far do the words from i and from
i + q on agree.

The trees are built by Ukkonen's method.  The common beginning of two suffixes
ends at the lowest common ancestor of their leaves.  An Euler tour of the tree
is kept at its turns: between one leaf and the next it is lowest at their
ancestor, and a sparse table of these depths gives the least depth between any
two leaves with two look-ups.

A run of at least four periods and six words has three equal copies,
q words apart, of each of its word triples.  So only stretches of triples
found three times in the text get trees; no run crosses the border of one.
A tree is built within the task that has the text and takes some 500 bytes a
word of its stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulary.llm.common import in_slices

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUN = "array<struct<start: long, length: long, period: long>>"
_FIELDS = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]


class SuffixTree:
    """Ukkonen's suffix tree of a list of symbols (numbers from 0).

    A symbol of its own, less than all others, ends the text.
    """

    def __init__(self, symbols: list[int]):
        self.text = text = [*symbols, -1]
        size = len(text)
        start, end, link, kids = [0], [0], [0], [{}]
        node = edge = length = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                child = kids[node].get(text[edge])
                if child is None:
                    kids[node][text[edge]] = len(start)
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    kids.append(None)
                    if unlinked:
                        link[unlinked] = node
                    unlinked = 0
                else:
                    held = end[child] - start[child]
                    if length >= held:
                        edge += held
                        length -= held
                        node = child
                        continue
                    at = start[child] + length
                    if text[at] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    fork = len(start)
                    start += [start[child], i]
                    end += [at, size]
                    link += [0, 0]
                    kids += [{text[at]: child, symbol: fork + 1}, None]
                    kids[node][text[edge]] = fork
                    start[child] = at
                    if unlinked:
                        link[unlinked] = fork
                    unlinked = fork
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self._start, self._end, self._kids = start, end, kids

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each suffix among the leaves, and the tour's least depth
        before each leaf.  ``reverse``: greater symbols first, but for the end."""
        start, end, kids, size = self._start, self._end, self._kids, len(self.text)
        order, lows, low = [], [], 0
        stack = [(0, 0, False)]
        while stack:
            node, above, turned = stack.pop()
            if turned:
                low = above
            depth = above + end[node] - start[node]
            below = kids[node]
            if below is None:
                order.append(size - depth)
                lows.append(low)
                continue
            symbols = sorted(below, reverse=not reverse)        # the last one is popped first
            if reverse and symbols[0] == -1:
                symbols = [*symbols[1:], -1]
            stack += [(below[c], depth, True) for c in symbols[:-1]]
            stack.append((below[symbols[-1]], depth, False))
        rank = np.empty(size, np.int64)
        rank[order] = np.arange(size)
        return rank, np.array(lows, np.int64)


class CommonBeginnings:
    """How many symbols two suffixes have in common, in constant time each."""

    def __init__(self, rank: np.ndarray, lows: np.ndarray):
        self._rank, self._least = rank, [lows]
        while len(self._least[-1]) > 1 << (len(self._least) - 1):
            last, half = self._least[-1], 1 << (len(self._least) - 1)
            self._least.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For different places a and b; the place behind the last symbol is one."""
        first, second = self._rank[a], self._rank[b]
        low, high = np.minimum(first, second) + 1, np.maximum(first, second) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            on = level == k
            out[on] = np.minimum(self._least[k][low[on]], self._least[k][high[on] - (1 << k)])
        return out


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """For each place the end of the longest Lyndon word that begins there: the
    next place whose suffix is smaller."""
    ranks = rank.tolist()
    ends, stack = [0] * len(ranks), []
    for i in range(len(ranks) - 1, -1, -1):
        while stack and ranks[stack[-1]] > ranks[i]:
            stack.pop()
        ends[i] = stack[-1] if stack else len(ranks)
        stack.append(i)
    return np.array(ends, np.int64)


def _runs_of(symbols: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs of a stretch."""
    size = len(symbols)
    tree = SuffixTree(symbols.tolist())
    rank, lows = tree.tour()
    ahead = CommonBeginnings(rank, lows)
    found = []
    for ranks in (rank, tree.tour(reverse=True)[0]):
        ends = lyndon_ends(ranks[:size])
        at = np.arange(size)
        period = ends - at
        fits = period * LEAST_PERIODS <= size
        found.append(np.stack([at[fits], period[fits]]))
    del tree
    at, period = np.unique(np.concatenate(found, axis=1), axis=1)
    forward = ahead(at, at + period)
    del ahead
    behind = CommonBeginnings(*SuffixTree(symbols[::-1].tolist()).tour())
    backward = behind(size - at, size - at - period)
    length = backward + period + forward
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return np.unique(np.stack([(at - backward)[long], length[long], period[long]], axis=1), axis=0)


def _stretches(symbols: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of the stretches whose word triples are each found three times or more."""
    size, kinds = len(symbols), int(symbols.max(initial=0)) + 1
    if size < LEAST_WORDS:
        return
    _, pairs, times = np.unique(symbols[:-1] * kinds + symbols[1:], return_inverse=True, return_counts=True)
    if times.max() < LEAST_PERIODS - 1:
        return
    _, triples, times = np.unique(pairs[:-1] * kinds + symbols[2:], return_inverse=True, return_counts=True)
    often = np.concatenate([[0], times[triples] >= LEAST_PERIODS - 1, [0]]).astype(np.int8)
    turns = np.flatnonzero(np.diff(often))
    for begin, end in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
        if end + 2 - begin >= LEAST_WORDS:
            yield begin, end + 2


def periodic_runs(words: list) -> np.ndarray:
    """Rows (start, length, period) of all runs of a list of words, by start, then period."""
    number: dict = {}
    symbols = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = [np.zeros((0, 3), np.int64)]
    for begin, end in _stretches(symbols):
        part = np.unique(symbols[begin:end], return_inverse=True)[1]
        found.append(_runs_of(part) + [begin, 0, 0])
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words that no run holds behind its first period."""
    if not len(runs):
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs and the collapsed text.

    Words are what white space of ASCII parts.  Runs are structs (start,
    length, period) by start, then period; the collapsed text is the kept
    words joined by one blank.  A null or blank text has no words, no runs and
    an empty collapsed text.  Repeated rows and ids each give their row; other
    columns of ``docs`` aren't read.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, part in in_slices(batch):
                counts, runs, rests = [], [], []
                for text in texts:
                    words = text.encode().split()
                    own = periodic_runs(words)
                    counts.append(len(words))
                    runs.append(own)
                    rests.append(b" ".join(collapsed(words, own)))
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                flat = np.concatenate(runs)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=[n for n, _ in _FIELDS])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), structs),
                    pa.array(rests, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n_words long, runs {RUN}, collapsed string")


def plant_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where texts of every tenth crc32 of the decimal doc_id
    end in a periodic stretch.

    With h the crc32 and g = h div 10, the words from a = g mod n on repeat the
    first p = 1 + (n - a) div (3 + g mod 8) of them.  Rows with a null doc_id
    or without a word stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    planted = F.transform(F.col("_words"), lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.get(F.col("_words"), (F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p"))).cast("int"))))
    n = F.size("_words")
    return (
        docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"), g.alias("_g"))
        .withColumn("_a", F.when(n > 0, F.pmod(F.col("_g"), n)))
        .withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + F.pmod(F.col("_g"), F.lit(8)))))
        .select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """The result of :func:`find_runs` as counts, the run of greatest exponent and digests."""
    runs: Column = F.col("runs")
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.reduce(runs, F.get(runs, F.lit(0)), lambda a, r: F.when(
        r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    return found.withColumn("_best", best).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
