"""Search, mixing, language, licences, quality and the pipeline against plain versions."""

import random
import re
from collections import Counter

import corpus_pipeline
import hashlib
import numpy as np
import pytest
import zlib
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import SF, odd_rows

from tabulary.llm import hamming, langid, licences, mixing, quality, queries


def test_nearest_codes(spark):
    rng = random.Random(1)
    codes = [(i, rng.getrandbits(64) - (1 << 63)) for i in range(300)]
    codes += [(300 + i, codes[0][1]) for i in range(60)]                       # a hot code
    codes += [(400 + i, codes[5][1] ^ (1 << (i % 63))) for i in range(40)]    # ties
    codes += [codes[3], (None, 5), (500, None)]
    df = spark.createDataFrame(codes, "id long, code long")
    got = {}
    for r in hamming.nearest(df, df.where("id % 20 = 0"), k=7).collect():
        got.setdefault(r.id, []).append((r["rank"], r.distance, r.neighbour))
    known = {(i, c) for i, c in codes if i is not None and c is not None}
    for i, c in known:
        if i % 20 == 0:
            near = sorted((bin((c ^ d) & (1 << 64) - 1).count("1"), j) for j, d in known if j != i)[:7]
            assert sorted(got[i]) == [(n + 1, d, j) for n, (d, j) in enumerate(near)], i


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(0, 5), (1, 5), (2, 7)], "id long, code long")
    got = sorted(map(tuple, hamming.nearest(df, df, k=10, bits=3).collect()))
    assert got == [(0, 1, 1, 0), (0, 2, 2, 1), (1, 1, 0, 0), (1, 2, 2, 1), (2, 1, 0, 1), (2, 2, 1, 1)]
    assert hamming.nearest(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("n, width, s", [(25, 5, 1), (50, 6, 1), (200, 8, 2)])
def test_neighbours_at_the_radius_that_segments_cover(spark, n, width, s):
    """The nearest code differs in s + 1 bits of each segment; a farther one has an equal segment."""
    rng = random.Random(n)
    segments = [range(a, min(64, a + width)) for a in range(0, 64, width)]
    query = rng.getrandbits(64)
    near = sum(1 << b for seg in segments for b in list(seg)[-s - 1:])
    far = bin(near).count("1") + 1
    decoy = sum(1 << b for b in rng.sample(range(width, 64), far))
    codes = [query, query ^ near, query ^ decoy]
    while len(codes) < n:
        c = rng.getrandbits(64)
        if bin(c ^ query).count("1") > far + 2:
            codes.append(c)
    assert len(set(codes)) == n
    rows = [(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows, "id long, code long")
    got = {(r.id, r["rank"]): (r.distance, r.neighbour) for r in hamming.nearest(df, df, k=2).collect()}
    for i, c in enumerate(codes):
        want = sorted((bin(c ^ d).count("1"), j) for j, d in enumerate(codes) if j != i)[:2]
        assert [got[i, 1], got[i, 2]] == want, i
    (one,) = hamming.nearest(df, df.where("id = 0"), k=1).collect()
    assert (one.neighbour, one.distance) == (1, far - 1)


def nearest_by_force(codes, queries, k):
    """Per query id: (distance, id) of the nearest k others."""
    return {i: sorted((bin((c ^ d) & (1 << 64) - 1).count("1"), j) for j, d in codes if j != i)[:k] for i, c in queries}


def test_search_makes_no_row_of_a_key(spark, monkeypatch):
    """What is written and joined on the way doesn't grow with the keys that are looked up."""
    rng = random.Random(8)
    codes = [(i, rng.getrandbits(64) - (1 << 63)) for i in range(1500)]
    df = spark.createDataFrame(codes, "id long, code long")
    rows, plans, staged = [], [], hamming.staged

    def watched(frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        out = staged(frame, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(hamming, "staged", watched)
    got = hamming.nearest(df, df.where("id % 20 = 0"), k=3).collect()
    assert max(rows) <= len(codes)
    assert not any("Join" in plan for plan in plans)
    want = nearest_by_force(codes, [x for x in codes if x[0] % 20 == 0], 3)
    assert sorted((r.id, r["rank"], r.distance, r.neighbour) for r in got) == sorted(
        (i, n + 1, d, j) for i, near in want.items() for n, (d, j) in enumerate(near))


def test_nearest_in_parts(spark, monkeypatch):
    """Several parts of the codes and of the queries, several chunks of a part, equal distances and ids that aren't numbers."""
    for name, size in (("CODES", 700), ("INDEXED", 150), ("PACKED", 40), ("QUERIES", 30), ("ASKED", 9)):
        monkeypatch.setattr(hamming, name, size)
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(12)]
    codes = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(170)}
    codes = [(f"n{i}", c - (1 << 64) if c >> 63 else c) for i, c in enumerate(rng.sample(sorted(codes), len(codes)))]
    queries = [x for x in codes if x[0].endswith("3")]
    got = hamming.nearest(*(spark.createDataFrame(x, "id string, code long").repartition(3) for x in (codes, queries)), k=5).collect()
    want = nearest_by_force(codes, queries, 5)
    assert sorted((r.id, r["rank"], r.distance, r.neighbour) for r in got) == sorted(
        (i, n + 1, d, j) for i, near in want.items() for n, (d, j) in enumerate(near))


@pytest.mark.parametrize("bits", [1, 3, 17, 40, 64])
def test_search_of_any_number_of_segments(bits):
    """Every number of segments finds the same, in one chunk or two, also where a segment's value is all codes'."""
    rng = np.random.default_rng(bits)
    for low in (False, True):
        codes = rng.integers(0, 1 << 63, 1500, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 1500, dtype=np.uint64)
        codes = np.unique(codes & np.uint64((1 << bits) - 1) & ~np.uint64(0xFFF0F if low else 0))
        rng.shuffle(codes)
        firsts, queries = rng.permutation(len(codes)) * 3, np.unique([*codes[::9], *(codes[:3] ^ np.uint64(1))])
        for m in (None, 0, *(m for m in (1, 2, 3, 4, 5, 9, 20) if -(-bits // hamming.WIDEST) <= m <= bits)):
            search = hamming.Search(queries, 6, bits)
            for part in np.split(np.arange(len(codes)), [len(codes) // 3]):
                search.add(codes[part], firsts[part], m)
            for i, q in enumerate(queries):
                apart = np.bitwise_count(codes ^ q)
                want = np.lexsort((firsts, apart))[:6]
                there = search.distance[i] != hamming.FREE
                assert search.distance[i][there].tolist() == apart[want].tolist(), (m, i)
                assert search.code[i][there].tolist() == codes[want].tolist(), (m, i)


def test_search_compares_a_part_of_the_pairs(monkeypatch):
    rng = np.random.default_rng(11)
    codes = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, 1 << 18).view(np.uint64))
    rng.shuffle(codes)
    search, pairs, compare = hamming.Search(codes[:1 << 13].copy(), 11, 64), [], hamming.Search._compare
    monkeypatch.setattr(hamming.Search, "_compare", lambda self, q, c: (pairs.append(len(q) * len(c)), compare(self, q, c)))
    search.add(codes, np.arange(len(codes)))
    assert sum(pairs) < len(codes) * len(search.queries) / 2
    for i in range(0, len(search.queries), 500):
        assert search.distance[i].tolist() == sorted(np.bitwise_count(codes ^ search.queries[i]))[:11]


def test_sign_codes(spark):
    rows = [([0.5, -1.0, None, 2.0],), ([],), (None,), ([0.0] * 63 + [1.0],)]
    df = spark.createDataFrame(rows, "v array<float>")
    assert [r.c for r in df.select(hamming.sign_code(F.col("v")).alias("c")).collect()] == [9, None, None, -(1 << 63)]


def test_mixture_of_odd_rows(odd, none):
    rows = [(r[0], r[3], r[1]) for r in odd_rows()]
    for repeats in (1.0, 1.5, 4.0):
        want = Counter((rows[k][0], rows[k][2], b) for k, b in brute.mixture(rows, repeats))
        df = mixing.mix(odd, repeats=repeats)
        assert Counter((r.doc_id, r.text, r.mix_block) for r in df.collect()) == want
        assert df.columns == [*odd.columns, "mix_tokens", "mix_block"]
    assert mixing.mix(none, repeats=2.0).count() == 0


def test_mixture_of_columns_named_like_helpers_and_results(spark):
    names = ["_mix_source", "_mix_until", "of_source", "blocks", "_blocks", "left", "until", "docs", "tokens"]
    schema = "doc_id long, source string, text string, " + ", ".join(f"`{n}` string" for n in names) + ", mix_block string, mix_place string"
    rows = [(i, f"s{i % 2}", "a b c", *names, "x", "y") for i in range(6)]
    got = mixing.mix(spark.createDataFrame(rows, schema), repeats=2.0)
    assert got.columns == ["doc_id", "source", "text", *names, "mix_tokens", "mix_block"]
    assert {(r.blocks, r.left, r.mix_tokens, r.mix_block) for r in got.collect()} == {("blocks", "left", 3, 0)}


def test_blocks_are_permutations(spark, docs):
    """Places are md5(seed, block, doc_id), another order in each block; the query gives that order."""
    def place(block, doc_id):
        return hashlib.md5(f"7|{block}|{doc_id}".encode()).hexdigest()
    rows = mixing.mix(docs.where("doc_id % 9 = 0 OR source = 's1'"), repeats=3.0, places=True).collect()
    assert all(r.mix_place == place(r.mix_block, r.doc_id) for r in rows) and {r.mix_block for r in rows} >= {0, 1}
    out = [(r.source, r.block, place(r.block, r.doc_id)) for r in queries.op4_source_mixing(spark, SF).collect()]
    assert out == sorted(out)


def test_mixture_meets_its_target(docs):
    skewed = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "big").otherwise(F.col("source")))
    import math
    for entropy in (0.9, 0.97):
        planned = mixing.plan(skewed, entropy=entropy, budget="corpus").collect()
        weights = [r.weight for r in planned]
        assert abs(sum(weights) - 1) < 1e-9
        assert abs(-sum(w * math.log(w) for w in weights) - entropy * math.log(len(weights))) < 1e-9
    plan = mixing.plan(skewed, repeats=2.0).collect()
    assert abs(max(r.repeats for r in plan) - 2) < 1e-6 and min(r.repeats for r in plan) >= 1 - 1e-9
    with pytest.raises(ValueError, match="either"):
        mixing.plan(docs)


def test_cross_parsing_counts_longest_matches():
    samples = {"x": "abracadabra abraham", "y": "hocus pocus focus"}
    parser = langid.CrossParser(samples, block=1000)

    def phrases(text, sample):
        n = i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i:j + 1] in sample:
                j += 1
            n, i = n + 1, j
        return n
    rng = random.Random(2)
    texts = ["".join(rng.choice("abrcdhom pus") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    texts = [t for t in texts if t]
    counts, lengths = parser.phrases(texts)
    known = {c for s in samples.values() for c in s}
    for t, c, n in zip(texts, counts.tolist(), lengths.tolist(), strict=True):
        if set(t) <= known:
            assert n == len(t)
            # a text that ends inside its last phrase, or right behind it, has closed it
            assert c == [phrases(t, samples[k]) for k in ("x", "y")], t


def longest_runs(text, sample):
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i:j + 1] in sample:
            j += 1
        n, i = n + 1, j
    return n


def test_cross_parsing_of_many_scripts():
    """More characters than the table has columns: all of them are in the runs."""
    rng = random.Random(9)
    alphabets = {"bg": [chr(c) for c in range(0x430, 0x450)], "de": list("abcdefghijklmnopqrstuvwxyzäöüß"),
                 "en": list("abcdefghijklmnopqrstuvwxyz"), "ja": [chr(c) for c in range(0x3041, 0x3097)],
                 "zh": [chr(c) for c in range(0x4E00, 0x4E00 + 1500)]}
    alphabets["zt"] = alphabets["zh"]                     # the same characters in other words
    lexicon = {k: ["".join(rng.choice(a) for _ in range(rng.randint(2, 6))) for _ in range(300)]
               for k, a in alphabets.items()}

    def written(k, words):
        return ("" if k in ("ja", "zh", "zt") else " ").join(rng.choice(lexicon[k]) for _ in range(words))
    samples = {k: written(k, 400) for k in alphabets}
    texts = [(k, written(k, 30)) for k in alphabets for _ in range(12)]
    odd = [("", t[:9] + "☃☃" + t[9:20] + "語" + other[:9]) for (_, t), (_, other) in zip(texts, texts[13:])]
    for letters in (2, 64, 4000):
        parser = langid.CrossParser(samples, letters=letters, block=1000)
        counts, lengths = parser.phrases([t for _, t in texts + odd])
        for (_, t), c, n in zip(texts + odd, counts.tolist(), lengths.tolist(), strict=True):
            assert n == len(t)
            assert c == [longest_runs(t, samples[k]) for k in parser.languages], t
    assert langid.CrossParser(samples).predict([t for _, t in texts])[0] == [k for k, _ in texts]


def test_languages_of_held_out_rows(docs):
    found = langid.identify(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id") \
        .where(langid.held_out(F.col("doc_id"))).collect()
    assert len(found) > 20
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_languages_of_odd_rows(odd, none, docs):
    samples = langid.learn(docs)
    got = langid.identify(odd, samples).collect()
    texts = Counter((r[0], not any(map(str.isalpha, r[1] or ""))) for r in odd_rows())
    assert Counter((r.doc_id, r.lang_pred == "und") for r in got) == texts
    assert all(0 <= r.score <= 1 for r in got)
    kept = langid.keep_known(odd, samples)
    assert kept.columns == odd.columns
    assert kept.count() == sum(n for (_, und), n in texts.items() if not und)
    assert langid.identify(none, samples).count() == 0
    assert langid.learn(none) == {} and langid.identify(odd, {}).where("lang_pred = 'und'").count() == odd.count()


def base_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licences(spark, odd, none, docs):
    for df, rows in ((odd, [(r[0], r[1]) for r in odd_rows()]), (docs, [(r.doc_id, r.text) for r in docs.collect()])):
        got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                      for r in licences.scan(df).collect())
        assert got == Counter((d, *base_of(t)) for d, t in rows)
    assert licences.scan(none).count() == 0
    texts = ["We redistribute. Redistribution and use in source and binary forms, with or without changes, are "
             "permitted provided that the following conditions are met", "Released under the MIT license.",
             "released by someone, the MIT is far from a license", "licensed under the apache license version 2.0",
             "Licensed under CC BY-NC 4.0; all rights reserved", "nothing of the kind"]
    found = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in found] == ["bsd", "mit", "", "apache-2.0", "cc-by,cc-by-nc,reserved", ""]
    assert [r.places[0].first_word if r.places else None for r in found] == [2, 0, None, 0, 0, None]


def test_shortened_notices_are_found(spark):
    """The words that few files have aren't in most copies of the notice."""
    short, whole = "Permission is hereby granted, free of charge, to any person", licences.TEMPLATES[11][1]
    assert whole.startswith(short)
    rows = [(i, f"file {i}\n{short} and so on") for i in range(30)]
    rows += [(30, whole), (31, "Permission is hereby granted to nobody"), (32, "free of charge to any person")]
    found = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in found] == ["mit"] * 31 + ["", ""]
    assert [r.places[0].first_word for r in found[:31]] == [2] * 30 + [0]
    assert found[30].score == 1


def test_licence_index_equals_a_plain_scan():
    """Every place where the key phrases stand and half of the words do is found, whatever the IDF."""
    rng = random.Random(11)
    known = licences.templates(licences.TEMPLATES)
    vocabulary = sorted({w for t in known for w in t.words})
    for _ in range(300):
        text = []
        for _ in range(rng.randint(1, 4)):
            own = list(rng.choice(known).words)
            own = own[rng.randint(0, 2):len(own) - rng.choice([0, 0, len(own) // 3, len(own) // 2])]
            for k in range(len(own)):
                if rng.random() < 0.15:
                    own[k] = rng.choice(vocabulary)
            text += [rng.choice(vocabulary) for _ in range(rng.randint(0, 3))] + own
        want = []
        for t in known:
            for shift in range(-len(t.words), len(text)):
                same = sum(0 <= shift + k < len(text) and text[shift + k] == w for k, w in enumerate(t.words))
                if 2 * same >= len(t.words) and all(shift + at >= 0 and tuple(text[shift + at:shift + at + len(p)]) == p
                                                    for at, p in t.keys):
                    want.append((t.label, shift, same / len(t.words)))
        idf = {w: rng.choice([0.0, 1.0, 2.0]) for w in vocabulary}
        assert sorted(licences.Index(known, idf).matches(text)) == sorted(want)


def test_base_phrases_are_found_by_the_index(spark, docs, monkeypatch):
    """Postings give the places of the base phrases: no scan for a phrase of several words is left."""
    scans = []
    plain = licences._places
    monkeypatch.setattr(licences, "_places", lambda found, phrase: scans.append(phrase) or plain(found, phrase))
    known = licences.base_templates(licences.PHRASES)
    index = licences.Index(known, {w: 1.0 for t in known for w in t.words})
    texts = [r.text for r in docs.collect()] + [
        "all rights all rights reserved reserved", "CC BY cc by cc-by", "General public license", "public license", ""]
    for text in texts:
        found = index.alignments(licences.words(text))
        starts = [at for _, at, share in found if share == 1]
        assert len(starts) == len(found)
        assert (len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({known[t].label for t, _, _ in found}))) == base_of(text)[1:]
    assert scans and all(len(p) == 1 for p in scans)


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    mark = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(mark)


def test_quality_counts_and_verdicts(spark, odd, none, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    for df, rows in ((odd, [(r[0], r[1]) for r in odd_rows()]), (docs, [(r.doc_id, r.text) for r in docs.collect()])):
        got = quality.judge(df, model).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) \
            == Counter((d, *counts_of(t or "")) for d, t in rows)
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and r.probability >= 0.5)
    assert quality.judge(none, model).count() == 0
    assert quality.judge(odd, quality.train(docs, labels.limit(0))).count() == odd.count()


def test_quality_of_rows_not_trained_on(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    own = F.xxhash64("doc_id") % 2 == 0
    model = quality.train(docs, labels.where(own))
    got = quality.judge(docs, model).join(labels.where(~own), "doc_id").where("NOT base_failed").collect()
    assert sum((r.probability >= 0.5) == (r.quality == 1) for r in got) >= 0.9 * len(got)


def plain_pipeline(rows, hashes, encode):
    """rows: (doc_id, text, source).  Brute-force version of the five stages."""
    rows = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    cut = brute.dedup_lines([(d, t) for d, t, _ in rows], hashes)
    rows = [(d, t, s) for (d, t, _, e, n), (_, _, s) in zip(cut, rows, strict=True)
            if not (e + n and not t.replace("\n", "").strip(" "))]
    classes = brute.classes([(d, t) for d, t, _ in rows if d is not None])
    rows = list({d: (d, t, s) for d, t, s in rows if d is not None and classes[d] == d}.values())
    out = Counter()
    for k, _ in brute.mixture([(d, s, t) for d, t, s in rows], corpus_pipeline.REPEATS):
        ids = encode(rows[k][1])
        out[rows[k][0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(rows[k][1].encode()).hexdigest()] += 1
    return out


def test_pipeline_equals_brute_force(spark, docs):
    import base64

    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = plain_pipeline(rows, hashes, library.encode_ordinary)
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want


def test_near_dedup_loses_no_document(spark):
    """Rows without a doc_id and different texts of one doc_id stay unless they are near another document."""
    text = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    near_a = text["a"].replace("a39", "z")
    rows = [(1, text["a"], "s0"), (2, text["b"], "s1"), (2, text["c"], "s1"), (2, near_a, "s1"),
            (None, text["d"], "s2"), (None, text["d"], "s2"), (None, near_a, "s2"), (None, text["e"], "s2"),
            (3, text["f"], "s3"), (3, text["f"], "s0"), (None, None, "s4"), (4, None, "s4")]
    want = Counter([rows[0], rows[1], rows[2], rows[4], rows[7], rows[9], rows[10], rows[11]])
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, source string")
        out = corpus_pipeline.near_duplicates(spark, df.repartition(3), SF)
        assert out.columns == df.columns
        assert Counter(map(tuple, out.collect())) == want


def test_near_dedup_of_maps_and_columns_named_like_helpers(spark):
    text = "one two three four five six seven"
    names = ["_own", "_id", "_key", "own", "id", "of", "row"]
    schema = "doc_id long, text string, m map<string,array<map<string,int>>>, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(1, text, {"a": [{"b": 1}]}, *names), (1, text, {"a": [{"b": 0}]}, *names), (1, text, None, *names),
            (3, "another text", {}, *names), (2, text, {}, *names), (None, "alone", {}, *names), (None, "alone", {}, *names)]
    df = spark.createDataFrame(rows, schema)
    got = corpus_pipeline.near_duplicates(spark, df, SF)
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text, r.m, r._own, r.own) for r in got.collect()), key=str)
    assert kept == sorted([(1, text, None, "_own", "own"), (3, "another text", {}, "_own", "own"), (None, "alone", {}, "_own", "own")], key=str)


def test_stages_keep_the_columns_of_odd_rows(spark, odd, none):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "MinHash near-dedup", "source mixing", "byte-level BPE"]
    for df in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns
            out.count()
