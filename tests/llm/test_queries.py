"""Registered queries over whole tables against libraries and plain versions."""

import hashlib
import re
import zlib

import public_tokenizers
import pytest
import tiktoken
from tests.llm import brute
from tests.llm.conftest import SF
from tokenizers import Tokenizer

from tabulary.llm import queries

LARGER = "/root/testdata/sf0.01"


def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def rows_of(df):
    got = df.collect()
    found = {r.doc_id: r for r in got}
    assert len(found) == len(got)
    return found


@pytest.mark.parametrize("folder", [SF, LARGER])
def test_token_files(spark, folder):
    lib, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    docs, got = texts(spark, folder), rows_of(queries.op2_token_files(spark, folder))
    assert got.keys() == docs.keys()
    for doc_id in sorted(docs):
        ids = [*lib.encode(docs[doc_id], add_special_tokens=False).ids, 0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


@pytest.mark.parametrize("folder", [SF, LARGER])
def test_byte_bpe(spark, folder):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = dict(line.split() for line in f.read().splitlines() if line)
    import base64
    lib = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks={base64.b64decode(k): int(v) for k, v in ranks.items()})
    docs, got = texts(spark, folder), rows_of(queries.op5_byte_bpe(spark, folder))
    assert got.keys() == docs.keys()
    for doc_id, text in docs.items():
        ids = lib.encode_ordinary(text)
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256, got[doc_id].decoded_sha256) == want


@pytest.mark.parametrize("folder", [SF, LARGER])
def test_token_counts(spark, folder):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    lib.no_padding()
    docs, got = texts(spark, folder), rows_of(queries.op8_token_counts(spark, folder))
    assert got.keys() == docs.keys()
    for doc_id, text in docs.items():
        n = len(lib.encode(text, add_special_tokens=False).ids)
        r = got[doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


def test_languages(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").collect()
    got = rows_of(queries.op6_language(spark, LARGER))
    known = {d.lang for d in docs if d.lang is not None}
    right = total = 0
    for d in docs:
        r = got[d.doc_id]
        held = zlib.crc32(str(d.doc_id).encode()) % 4 == 2
        assert r.held_out == held and 0 <= r.score <= 1 and (r.lang_pred in known or r.lang_pred == "und")
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in d.text or ""))
        if held and d.lang is not None and r.lang_pred != "und":
            total, right = total + 1, right + (r.lang_pred == d.lang)
    assert total > 100 and right >= 0.95 * total


def test_base_licences(spark):
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    for folder in (SF, LARGER):
        got = rows_of(queries.op7_licences(spark, folder))
        for doc_id, text in texts(spark, folder).items():
            words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().translate(lower))
            words = [w.decode() for w in words]
            at = [(i, label) for p, label in phrases.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
            r = got[doc_id]
            want = (len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
                    ",".join(sorted({x for _, x in at})))
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_base_quality(spark):
    got = rows_of(queries.op9_quality_rules(spark, LARGER))
    for doc_id, text in texts(spark, LARGER).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, duplicates = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                duplicates += line in seen
                seen.add(line)
        windows = {}
        for i in range(len(words) - 2):
            windows.setdefault(tuple(words[i:i + 3]), []).append(i)
        repeated = len({i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)})
        failed = len(words) < 50 or 100 * repeated > 50 * len(words)
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, repeated, failed)
        assert not (r.kept and failed)
    assert 0 < sum(r.kept for r in got.values()) < len(got)


def test_near_duplicate_classes(spark):
    docs = texts(spark, SF)
    got = {r.doc_id: r.class_id for r in queries.op10_near_duplicates(spark, SF).collect()}
    assert got == brute.classes(list(docs.items()))
