"""Line dedup and near duplicates against brute force, and odd rows."""

import random
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import SF, odd_rows

from tabulary.llm import bagminhash, line_dedup, queries


def lines_found(df):
    return Counter(map(tuple, line_dedup.dedup_lines(df).select(
        "doc_id", "text", "lines_before", "lines_exact", "lines_near").collect()))


def hashes(df):
    return {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).distinct().collect()}


def test_lines_of_odd_rows(odd, none):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert lines_found(odd) == Counter(brute.dedup_lines(rows, hashes(odd)))
    assert lines_found(none) == Counter()
    assert line_dedup.dedup_lines(odd).columns[:len(odd.columns)] == odd.columns


def test_lines_first_seen_in_rows_without_an_id(spark):
    """A row without a doc_id is the earliest place of its lines, for equal and for near ones."""
    line = "one two three four five six seven eight nine"
    rows = [(None, line), (7, line), (12, line.replace("five", "FIVE")), (None, "other\n" + line), (13, line + " ten")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert lines_found(df) == Counter(brute.dedup_lines(rows, hashes(df)))
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect() if r.doc_id} == {7: "", 12: "", 13: ""}


def test_columns_named_like_helpers_and_results(spark):
    names = ["_lines", "_drop", "lines", "drop", "n_near", "of_doc", "of_text", "_OF_TEXT", "in_doc", "at", "first", "h1", "text_key"]
    rows = [(1, "a b\nc", *names, "x"), (2, "a b\nd", *names, "x")]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names) + ", lines_near string"
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", *names, "lines_before", "lines_exact", "lines_near"]
    assert sorted((r.text, r["lines"], r._lines, r.lines_exact) for r in got.collect()) == [
        ("a b\nc", "lines", "_lines", 0), ("d", "lines", "_lines", 1)]


def test_edited_lines(spark):
    """Insertions, deletions and replacements at every place, repeated words,
    a template with many fillings, and short lines that stay."""
    rng = random.Random(4)
    base = "a b a a c d e f g h".split()
    lines = [" ".join(base)]
    for i in range(len(base)):
        lines += [" ".join([*base[:i], "X", *base[i + 1:]]), " ".join(base[:i] + base[i + 1:]),
                  " ".join([*base[:i], "Y", *base[i:]]), " ".join([*base[:i], "P", "Q", *base[i + 2:]])]
    lines += [f"this template has a filling that is number {i} here" for i in range(40)]
    lines += [f"short {i}" for i in range(5)]
    lines += [" ".join(rng.choice("uvw") for _ in range(8)) for _ in range(150)]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[k:k + 3])) for i, k in enumerate(range(0, len(lines), 3))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert lines_found(df) == Counter(brute.dedup_lines(rows, hashes(df)))


def test_within_one_edit(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        b = list(a)
        for _ in range(rng.randint(0, 2)):
            i = rng.randint(0, len(b))
            b[i:i + rng.randint(0, 1)] = [rng.choice("abcd")][:rng.randint(0, 1)]
        if a and b:
            pairs.append((a, b, brute.one_edit(a, b)))
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>, want boolean")
    assert df.where(line_dedup.within_one_edit(F.col("a"), F.col("b")) != F.col("want")).count() == 0


@pytest.mark.parametrize("name", ["op1_code_search", "op3_line_dedup", "op4_source_mixing"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert Counter(map(tuple, df.collect())) == Counter(want)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 60, 300)]
    edited = [f"z{i}" if i % 45 == 7 else w for i, w in enumerate(words)]
    texts = [" ".join(words), " ".join(edited), "nd " * 60 + " ".join(words[:50]), "nd " * 100 + " ".join(words[:50])]
    signed = bagminhash.signatures(*bagminhash.shingles(texts), len(texts), 4096)
    for a, b in ((0, 1), (2, 3)):
        true = brute.similarity(brute.bag(texts[a]), brute.bag(texts[b]))
        assert abs((signed[a] == signed[b]).mean() - true) < 4 * (true * (1 - true) / 4096) ** 0.5


def test_overlap_is_that_of_multisets():
    a, b = "x y z x y z x y z x y z", "x y z x y z x y z q"
    got = [bagminhash.shingles([t]) for t in (a, b)]
    assert bagminhash.overlap(*((v, w) for _, v, w in got)) == brute.similarity(brute.bag(a), brute.bag(b))


def test_near_duplicates_of_odd_rows(odd, none):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] is not None]
    want = brute.classes(rows)
    assert sorted(map(tuple, bagminhash.near_duplicates(odd).collect())) == sorted((d, want[d]) for d, _ in rows)
    assert bagminhash.near_duplicates(none).count() == 0


def test_chains_and_large_groups(spark):
    """A chain whose ends aren't similar, a group of copies, a group of near copies."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for step in range(8):
        rows.append((100 + step, " ".join(f"s{i}" if i < 8 * step else words[i] for i in range(200))))
    rows += [(200 + i, "copy of one and the same text here") for i in range(40)]
    base = [rng.choice(words) for _ in range(300)]
    for i in range(60):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(300)] = f"e{n}"
            n += 1
        rows.append((300 + i, " ".join(own)))
    rows += [(400 + i, " ".join(rng.choice(words) for _ in range(100))) for i in range(40)]
    rng.shuffle(rows)
    want = brute.classes(rows)
    got = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rounds=2).collect()
    assert {r.doc_id: r.class_id for r in got} == want


def fillings():
    """A template with many fillings that are too long, and beside some of them one more text with one edit."""
    rng = random.Random(9)
    base = [rng.choice("abcdefgh") + str(i) for i in range(300)]
    rows = []
    for i in range(160):
        at, long = rng.randrange(230), rng.randint(40, 46)
        rows.append((i, " ".join([*base[:at], *(f"o{i}_{k}" for k in range(long)), *base[at + long:]])))
    for i in range(0, 160, 8):
        words = rows[i][1].split()
        words[rng.randrange(300)] = "edit"
        rows.append((1000 + i, " ".join(words)))
    return rows


@pytest.fixture
def verified(monkeypatch):
    """The numbers of pairs that are read and verified, round by round."""
    seen, verify = [], bagminhash.verify
    monkeypatch.setattr(bagminhash, "verify", lambda pairs, *a: (seen.append(pairs.count()), verify(pairs, *a))[1])
    return seen


def test_texts_alike_by_less_than_the_similarity(spark, verified):
    rows = fillings()
    got = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == brute.classes(rows)
    assert verified[-1] < len(rows)


def test_pipeline_of_texts_alike_by_less_than_the_similarity(spark, verified):
    rows = fillings()
    df = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, df, SF).collect()
    want = brute.classes(rows)
    assert sorted(map(tuple, got)) == sorted(r for r in rows if want[r[0]] == r[0])
    assert verified[-1] < len(rows)


def test_rare_pairs_miss_none(spark):
    """Repeated shingles, repeated rows, two texts of one id, and texts without a word."""
    rng = random.Random(10)
    rows, n = [], 0
    for template in range(6):
        base = [rng.choice("abc") for _ in range(rng.randint(8, 40))] + ["nd"] * rng.randint(0, 20)
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(own))
                own[at:at + rng.randint(0, 1)] = [rng.choice("abcd")][:rng.randint(0, 1)]
            rows.append((n, " ".join(own)))
            n += 1
    rows += [(n, ""), (n + 1, " \t"), rows[3], rows[3], (5, rows[40][1])]
    classes = {i: i % 7 for i in range(n + 2)}
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = spark.createDataFrame(list(classes.items()), "node long, class long")
    pairs, _ = bagminhash.rare_pairs(nodes, texts, 5, 0.8)
    got = {tuple(sorted(r)) for r in pairs.collect()}
    bags = [(d, brute.bag(t)) for d, t in rows]
    want = {(min(a, b), max(a, b)) for a, x in bags for b, y in bags
            if classes[a] != classes[b] and x and y and brute.similarity(x, y) >= 0.8}
    assert want and want <= got
    assert all(classes[a] != classes[b] for a, b in got)


def test_near_duplicates_of_the_table(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: r.class_id for r in bagminhash.near_duplicates(docs).collect()} == brute.classes(rows)


def test_components(spark):
    rng = random.Random(8)
    links = [(a, a + rng.choice([1, 1, 1, 7])) for a in range(0, 120) if rng.random() < .7] + [(500, 400 + i) for i in range(50)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    df = spark.createDataFrame([(min(e), max(e)) for e in links], "a long, b long")
    assert {r["node"]: r["class"] for r in bagminhash.components(df).collect()} == {x: root(x) for x in parent}
