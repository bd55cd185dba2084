"""Near-duplicate classes by BagMinHash signatures of word-shingle multisets.

A text is the multiset of its shingles of five words (a shorter text: one
shingle of all its words).  The weight axis of a shingle is split into the
intervals [0, 1), [1, 2), [2, 4), [4, 8), ...  Each holds a Poisson process
that depends on shingle and interval alone; a point has a time, a register
and a place on the weight axis, whose random bits choose a half again and
again down to a unit.  A point counts if its unit lies below the shingle's
multiplicity.  Each register keeps its earliest point, so two texts agree in a
register with the probability of their weighted Jaccard similarity.  Only
points before a horizon at which all registers are likely to be filled are
made; where one is still empty the horizon is doubled.

Signatures are cut into bands.  Equal texts are one node.  Nodes that share a
band are linked to one node of that band, links are verified on the multisets,
and linked nodes become components.  A band is done with the nodes that it was
linked to; if the others still are of several components, they get another
round.  Of the nodes that are left then, those pairs across components are
verified that share one of the rarest shingles of both, as every pair of that
similarity does.  So every pair that shares a band is verified, inside one
component or known to be less alike, without all pairs of a large group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulary.llm.common import drop_staged, held, in_slices, staged

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _words() -> _WordHash:
    return held(("words",), _WordHash)


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: text number, shingle hash and multiplicity, sorted."""
    get, hashes, lengths = _words().__getitem__, [], []
    for text in texts:
        words = text.split()
        if words:
            words += [""] * (size - len(words))
        lengths.append(len(words))
        hashes.append(np.fromiter(map(get, words), np.uint64, len(words)))
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    counts = np.maximum(np.array(lengths, np.int64) - size + 1, 0)
    doc = np.repeat(np.arange(len(texts)), counts)
    if not len(doc):
        return doc, np.zeros(0, np.uint64), doc
    first = np.repeat(np.cumsum(lengths) - lengths, counts)
    at = first + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    value = np.zeros(len(doc), np.uint64)
    for k in range(size):
        value = value * _STEP + flat[at + k]
    value = mix(value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(new)
    return doc[starts], value[starts], np.diff(np.append(starts, len(doc)))


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """The earliest point's time for each text and register (infinite for a
    text without shingles)."""
    out = np.full((n, registers), np.inf)
    if not len(doc):
        return out
    levels = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    total = np.bincount(doc, weight, n)
    streams = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(streams)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    wide = np.maximum(low, 1)
    of, bag = doc[streams], weight[streams]
    seed = mix(value[streams] + _GOLDEN * (level.astype(np.uint64) + np.uint64(1)))
    rate = registers * wide.astype(float)
    horizon = np.where(total > 0, (math.log(registers) + 4) / np.maximum(total, 1), 0)
    todo = total > 0
    with np.errstate(over="ignore"):
        while todo.any():
            live = np.flatnonzero(todo[of])
            state, time = seed[live], np.zeros(len(live))
            fresh = np.full((n, registers), np.inf)
            while len(live):
                state = state + _GOLDEN
                u = (mix(state) >> np.uint64(11)).astype(float)
                time = time - np.log((u + 1) * 2.0 ** -53) / rate[live]
                on = time < horizon[of[live]]
                live, state, time = live[on], state[on], time[on]
                v = mix(state ^ _STEP)
                register = ((v >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
                place = low[live] + ((v & np.uint64(0xFFFFFFFF)).astype(float) * 2.0 ** -32 * wide[live])
                ok = place < bag[live]
                np.minimum.at(fresh, (of[live[ok]], register[ok].astype(np.int64)), time[ok])
            full = todo & np.isfinite(fresh).all(axis=1)
            out[full] = fresh[full]
            todo &= ~full
            horizon = np.where(todo, 2 * horizon, horizon)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each text and band."""
    bits = signature.view(np.uint64)
    n, bands = len(bits), bits.shape[1] // rows
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, (n, bands)).copy()
        for k in range(rows):
            key = mix(key * _STEP + bits[:, k:bands * rows:rows])
    return key.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)


def sign(docs: DataFrame, size: int, registers: int, rows: int) -> DataFrame:
    """Per row: doc_id, the 128-bit key of its words (null: no word), the
    number of shingles and the band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, part in in_slices(batch):
                doc, value, weight = shingles(texts, size)
                keys = band_keys(signatures(doc, value, weight, len(texts), registers), rows)
                total = np.bincount(doc, weight, len(texts)).astype(np.int64)
                words = [xxhash.xxh128_digest("\n".join(t.split())) if n else None
                         for t, n in zip(texts, total.tolist(), strict=True)]
                bands = keys.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words, pa.binary()), pa.array(total),
                     pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.ravel())],
                    ["doc_id", "words", "total", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, words binary, total long, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those pairs (a, b) whose multisets have at least that similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in batches:
            for members, part in in_slices(batch, "text_b"):
                of, value, weight = shingles(members, size)
                bounds = np.searchsorted(of, np.arange(len(members) + 1))
                ids, leaders, keep = part.column("a").to_pylist(), part.column("text_a"), []
                for k, a in enumerate(ids):
                    if a != last:
                        _, *bag = shingles([leaders[k].as_py()], size)
                        last = a
                    own = slice(bounds[k], bounds[k + 1])
                    keep.append(overlap(bag, (value[own], weight[own])) >= similarity)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))


def rare_pairs(nodes: DataFrame, texts: DataFrame, size: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, node) of ``nodes`` (node and class; repeated rows are one) of
    different classes that can have at least that similarity, and the staged
    table that they are read from; none that has it is missed.

    A repeated shingle is an element for each time that it stands.  Two texts
    of that similarity have ``share`` of all their elements in common or more.
    In any one order of the elements, the first common one is followed by the
    others, so its place in a text (from 0) is at most the text's size less
    the number of common ones.
    Elements of one class alone, which are none of such a pair's, come first,
    and rare ones before frequent ones; so texts of one template that differ in
    too many words of their own don't meet in the template.
    """
    share, slack = similarity / (1 + similarity), 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, part in in_slices(batch):
                of, value, weight = shingles(members, size)
                time = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
                element = mix(np.repeat(value, weight) + _GOLDEN * time.astype(np.uint64))
                ends = np.searchsorted(np.repeat(of, weight), np.arange(len(members) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("class"), pa.array(np.diff(ends).astype(np.int64)),
                     pa.ListArray.from_arrays(ends, element.view(np.int64))],
                    ["node", "class", "total", "elements"])

    open_nodes = staged(nodes.select(F.col("node").alias("doc_id"), "class").distinct(), "open-nodes")
    bags = staged(
        texts.join(open_nodes, "doc_id").mapInArrow(run, "node long, class long, total long, elements array<long>")
        .withColumn("id", F.monotonically_increasing_id()), "bags")
    several = bags.select("class", F.explode("elements").alias("element")).groupBy("element").agg(
        F.count("*").alias("n"), F.min("class").alias("x"), F.max("class").alias("y")) \
        .where("x <> y").select("element", "n")
    first = F.floor(F.col("total") * (1 - similarity) + slack).cast("int") + 1 - F.col("own")
    rare = staged(
        bags.select("id", F.explode("elements").alias("element")).join(several, "element")
        .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "element"))).alias("common"))
        .join(bags.drop("elements"), "id")
        .withColumn("own", F.col("total").cast("int") - F.size("common")).where(first > 0)
        .select("node", "class", "total", "own", F.posexplode(F.slice("common", F.lit(1), first)))
        .select("node", "class", "total", (F.col("own") + F.col("pos")).alias("at"), "col.element"), "rare")
    # The smaller text's place is at most that beside one of its own size.
    smaller = rare.where(F.col("at") <= F.col("total") * (1 - 2 * share) + slack).select(
        "element", *(F.col(c).alias(f"{c}_a") for c in ("node", "class", "total", "at")))
    drop_staged(open_nodes, bags)
    least = share * (F.col("total") + F.col("total_a")) - slack
    return rare.join(smaller, "element").where("class <> class_a").where(
        F.struct("total_a", "node_a") < F.struct("total", "node")).where(
        (F.col("at") <= F.col("total") - least) & (F.col("at_a") <= F.col("total_a") - least)) \
        .select(F.col("node_a").alias("a"), "node"), rare


def components(links: DataFrame) -> DataFrame:
    """Of every linked node: node and class (its component's least node)."""
    return _components(links)[1]


def _components(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The components, and first the staged table that they are read from.

    Alternates the two star operations until nothing changes: each node's
    larger neighbours are linked to its least neighbour, then its smaller ones.
    Minima are aggregated before they are joined, so a node with very many
    links is no single task's work.
    """
    edges, before = links.select("a", "b").distinct(), None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
            F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e")) \
            .select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct()
        last, edges = edges, staged(small, "links")
        if before is not None:
            drop_staged(last)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct()
    return edges, edges.select(F.col("a").alias("node"), F.col("b").alias("class")).unionAll(roots)


def near_duplicates(docs: DataFrame, similarity: float = 0.8, size: int = 5,
                    registers: int = 128, rows: int = 5, rounds: int = 2, pivots: int = 4) -> DataFrame:
    """Per row: doc_id and class_id, the least doc_id of its near-duplicate class.

    Documents are linked if the multisets of their shingles have at least
    ``similarity``; a class is a component of links.  A pair at 0.8 shares no
    band with probability 5e-5.  Texts that differ in white space only are
    equal.  A null text and one without a word are classes of their own.
    Repeated rows are one document, and so are rows that share a doc_id; rows
    with a null doc_id are left out.  Other columns play no part.
    """
    docs = docs.where("doc_id IS NOT NULL")
    signed = staged(sign(docs, size, registers, rows), "signatures")
    nodes = staged(signed.where("words IS NOT NULL").groupBy("words").agg(
        F.min("doc_id").alias("node"), F.first("total").alias("total"), F.first("bands").alias("bands")), "nodes")
    in_bands = nodes.select("node", "total", F.explode("bands").alias("band"))
    shared = staged(in_bands.join(
        in_bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "band"), "bands")
    wanted = shared.select(F.col("node").alias("doc_id")).distinct()
    texts = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                   .where("text IS NOT NULL").join(wanted, "doc_id", "left_semi"), "texts")

    tested = links = edges = found = None
    tables = [texts]
    for turn in range(rounds + 1):
        members = shared.withColumn("class", F.col("node")) if found is None else \
            shared.join(found, "node", "left").withColumn("class", F.coalesce("class", "node"))
        # The least node of a band first, then some that a hash chooses.
        by = [F.xxhash64(F.lit(turn * pivots + i), "node") for i in range(pivots)] if turn else [F.col("node")]
        open_bands = members.groupBy("band").agg(
            F.min("class").alias("x"), F.max("class").alias("y"), *(
                F.min(F.struct(b.alias("by"), "node", "class", "total")).alias(f"to{i}") for i, b in enumerate(by))) \
            .where("x <> y").select("band", F.array(*(f"to{i}" for i in range(len(by)))).alias("to"))
        # A band whose members are one class stays so, and needn't be looked at again.
        members = staged(members.join(open_bands, "band").select("band", "node", "class", "total", "to"), "members")
        drop_staged(shared)
        # The nodes that a band is linked to are compared with all of it in this round.
        shared = members.where(~F.exists("to", lambda t: (t["node"] == F.col("node")) & (
            t["total"] == F.col("total")))).select("band", "node", "total")
        shared.__dict__["_staged_path"] = members.__dict__["_staged_path"]
        near = "least(total, total_a) >= {0} * greatest(total, total_a) AND class <> class_a".format(similarity)
        if turn:
            sizes = members.groupBy("band", "class").agg(F.count("*").alias("n")) \
                .groupBy("band").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"))
            across = sizes.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2).alias("p"),
                               F.sum("s").alias("s")).first()
            if not across.s:
                break
            few = across.p <= 4 * across.s
            last = few or turn == rounds
        else:
            few = last = False
        if few:
            other = members.select("band", F.col("node").alias("a"), F.col("class").alias("class_a"),
                                   F.col("total").alias("total_a"))
            pairs = members.join(other, "band").where("a < node").where(near)
        elif last:
            pairs, rare = rare_pairs(members, texts, size, similarity)
            tables.append(rare)
        else:
            pairs = members.select("node", F.explode(F.filter("to", lambda t: (t["class"] != F.col("class")) & (
                F.least(t["total"], "total") >= similarity * F.greatest(t["total"], "total")))).alias("to")) \
                .select("node", F.col("to.node").alias("a"))
        pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tables.append(pairs)
        tested = pairs if tested is None else tested.unionAll(pairs)
        good = verify(pairs, texts, size, similarity)
        used = [x for x in (links, edges) if x is not None]
        links = staged(good if links is None else links.unionAll(good), "verified")
        edges, found = _components(links)
        drop_staged(*used)
        if last:
            break
    drop_staged(shared, *tables, *([] if links is None else [links]))

    return (
        signed.select("doc_id", "words")
        .join(nodes.select("words", "node"), "words", "left")
        .withColumn("node", F.coalesce("node", "doc_id"))
        .join(found, "node", "left")
        .select("doc_id", F.coalesce("class", "node").alias("class_id")))
