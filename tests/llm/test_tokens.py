"""Encoders against the public libraries, round trips, and odd rows."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tests.llm.conftest import odd_rows
from tokenizers import Tokenizer

from tabulary.llm import bpe, dac, transducer
from tabulary.llm.common import shared_path

BITS = ["a", "B", " ", "\n", "'s", "é", "1", "!", "  ", "\t", " ", "th", "er", "ing", "'", "ll", "\x1e", "́",
        "<|endoftext|>", "#$", "Σ", "日本"]


def made_up(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["=" * 300, " " * 300 + "a"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_encoding_equals_the_library(library, own):
    texts = made_up(1500)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text), text
        assert own.ranks.decode(ids.tolist()) == text.encode()


def test_prefix_tables_hold_every_prefix(own):
    piece = " thanedbleéuniversally".encode()
    last = own.ranks.extend(piece, [])
    for end in range(1, len(piece) + 1):
        assert own.ranks.walk(last[:end]) == own.ranks.merge(piece[:end])
    assert own.ranks.extend(piece, last[:7]) == last                     # an append keeps what is there
    many = [p.encode() for p in (" thaned", "x", " universally", "ß")]
    got = own._tables.encode(many)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [own.ranks.merge(p) for p in many]


def test_pairs_fit_as_plain_merging_says(own):
    rng, ranks = random.Random(1), own.ranks
    for _ in range(3000):
        a, b = rng.randrange(50256), rng.randrange(50256)
        assert ranks.fits(a, b) == (ranks.merge(ranks.token[a] + ranks.token[b]) == [a, b])


def test_appends_and_edits_reencode_near_the_change(library, own):
    rng = random.Random(2)
    for _ in range(60):
        held, text = bpe.EncodedText(own.ranks, P.PATTERN), ""
        for step in range(6):
            new = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 6)))
            begin = rng.randint(0, len(text))
            end = rng.randint(begin, len(text))
            if step % 2:
                held.append(new)
                text += new
            else:
                held.replace(begin, end, new)
                text = text[:begin] + new + text[end:]
            assert held.ids() == library.encode_ordinary(text)
    long = bpe.EncodedText(own.ranks, P.PATTERN, "some words and more of them " * 500)
    before = long.recoded
    long.replace(7000, 7003, "new")
    assert long.recoded - before < 60


def test_encode_decode_odd_rows(odd, none, library):
    path = P.path("byte_bpe_50k.tiktoken")
    got = Counter(map(tuple, bpe.encode_decode(odd, path, P.PATTERN).collect()))
    want = Counter()
    for doc_id, text, *_ in odd_rows():
        ids = library.encode_ordinary(text or "")
        want[doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want
    assert bpe.encode_decode(none, path, P.PATTERN).count() == 0


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    for top in (200, 300, 70_000, 1 << 32):
        ids = rng.integers(0, top, 20_000).astype(np.uint32)
        ids[::999] = top - 1
        codes = dac.Codes.pack(ids)
        assert (codes.slice(0, len(ids)) == ids).all()
        assert (codes.slice(777, 5001) == ids[777:5001]).all()
        assert all(codes[i] == ids[i] for i in range(0, len(ids), 37))
    assert len(dac.Codes.pack(np.array([], np.uint32))) == 0


def test_token_files_of_odd_rows(spark, odd, none):
    name = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(name)
    rows = sorted(((r[0], r[1] or "") for r in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    path = shared_path(spark, "test-tokens")
    dac.write_token_files(odd, path, lambda: dac.library_encoder(name), segment_tokens=500)
    want, flat = [], []
    for doc_id, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        want.append((doc_id, len(flat), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        flat += ids
    got = [tuple(r) for r in dac.read_documents(spark, path).orderBy("start").collect()]
    assert got == want
    wanted = spark.createDataFrame([(p,) for p in (0, 5, 5, 499, 500, 501, len(flat) - 1, len(flat), -1)], "position long")
    tokens = sorted(map(tuple, dac.read_tokens(spark, path, wanted).collect()))
    assert tokens == sorted((p, flat[p]) for p in (0, 5, 5, 499, 500, 501, len(flat) - 1))
    empty = shared_path(spark, "test-empty")
    dac.write_token_files(none, empty, lambda: dac.library_encoder(name))
    assert dac.read_documents(spark, empty).count() == 0


def test_chunk_cache_equals_the_library():
    name = P.path("byte_bpe_50k.json")
    library, cache = Tokenizer.from_file(name), dac.library_encoder(name)
    texts = made_up(1500, 5)
    for text, ids in zip(texts, cache(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_transducer_counts_equal_the_library():
    name = P.path("word_bpe_49k.json")
    library, machine = Tokenizer.from_file(name), transducer.counter(name)
    texts = made_up(1500, 7) + ["ΑΣ ΑΣΑ ÉÀ", "İstanbul ǅ", "<|startoftext|>a<|endoftext|>"]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [machine.compose([m]) for m in machine.maps(texts)] == want
    for size in (1, 3, 7):                       # maps of pieces compose to the whole
        got = [machine.compose(machine.maps([t[i:i + size] for i in range(0, max(1, len(t)), size)])) for t in texts]
        assert got == want


def test_transducer_forgets_and_goes_on():
    name = P.path("word_bpe_49k.json")
    whole = transducer.counter(name).machine
    small = transducer.Transducer.__new__(transducer.Transducer)
    small.__dict__.update({**whole.__dict__, "_most": 5})
    small._clear()
    for word in ("thanedble", "universally", "x", "thstbleronth"):
        assert small.count(word.encode()) == whole.count(word.encode())


def test_count_tokens_odd_rows(odd, none):
    name = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(name)
    want = Counter()
    for doc_id, text, *_ in odd_rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[doc_id, len((text or "").encode()), n, n > 2048] += 1
    for chunk in (1 << 16, 10):
        assert Counter(map(tuple, transducer.count_tokens(odd, name, chunk_chars=chunk).collect())) == want
    assert transducer.count_tokens(none, name).count() == 0


def test_counts_of_the_table(docs):
    name = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(name)
    got = {r.doc_id: r.n_tokens for r in transducer.count_tokens(docs, name).collect()}
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids)
                   for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()}
