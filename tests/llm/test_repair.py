"""Conversation repair, archives and periodic runs against plain versions."""

import gzip
import random

import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import SF, odd_rows

from tabulary.llm import periodic, queries, turns, warc
from tabulary.llm.common import shared_path

CONVERSATION = "conv_id long, turn long, role string, text string, key string, present string, fault int, copy int, `as` int"
PAGE = "page_id long, url string, html string, copies int, first string, payload_digest string"
FAULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RUNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def by_id(df, name, columns):
    return {r[name]: tuple(r[c] for c in columns) for r in df.collect()}


def conversations():
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "cut off", "", None, " \t", "What?  \n", "word." * 3000, "\u3000", "a\nb."]
    rows = [(c, rng.choice([t, t, t, None, t + 9]), rng.choice(roles), rng.choice(texts))
            for c in [*range(60), None] for t in range(rng.randrange(1, 12))]
    return [*rows, *rows[:7], (99, None, None, None), (98, 5, "user", "x."), (98, 5, "user", "x.")]


def test_repair_of_odd_conversations(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "k", "p", 1, 2, 3) for r in rows], CONVERSATION)
    assert by_id(turns.repair(turns.damage(df), present="present"), "conv_id", FAULTS) == brute.repaired(brute.damaged(rows))
    plain = {}
    for c, t, r, x in rows:
        plain.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    assert by_id(turns.repair(df), "conv_id", FAULTS) == brute.repaired(plain)


def test_repair_of_no_conversations(spark):
    df = spark.createDataFrame([], CONVERSATION)
    got = turns.repair(turns.damage(df), present="present")
    assert got.count() == 0 and got.columns == ["conv_id", *FAULTS]


def test_cheapest_edits():
    rng = random.Random(5)
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), f"t{i}", rng.random() < 0.15, rng.random() < 0.2)
                for i in range(rng.randrange(9))]
        parser = turns.Parser()
        for r in rows:
            parser.row(*r)
        cost, audit, lines = brute.cheapest_repair(rows)
        assert parser.finish() == (cost, audit, brute.sha256("\n".join(lines))), rows


def test_a_long_conversation_keeps_bytes_a_row():
    parser = turns.Parser()
    for i in range(20_000):
        parser.row("user" if i % 2 == 0 or i % 500 == 1 else "assistant", "x" * 50, False, False)
    assert len(parser._choices) <= 8 * 20_000
    cost, audit, _ = parser.finish()
    assert cost == 2 * 40 and audit.count("R") == 40 and len(audit) == 20_000


def test_conversation_query(spark):
    for folder in (SF, "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        got = by_id(queries.op11_conversation_repair(spark, folder), "conv_id", FAULTS)
        assert got == brute.repaired(brute.damaged(rows))


def pages():
    rows = [(1, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (2, "u", "x"), (3, "v", "x"), (3, "v", "x"), (3, "w", "x"),
            (None, "n", "x"), (4, None, None), (5, "w", ""), (6, "é\r\nx: y", "é" * 30_000), (7, "p", None), (7, "p", None),
            (None, None, "zz"), (8, "q", "\x1f\x8b\x00")]
    return rows + [(100 + i, "hot", "the same page") for i in range(300)]


@pytest.mark.parametrize("least", [0, 2, 1000])
def test_archives_of_odd_pages(spark, least):
    df = spark.createDataFrame([(*r, 1, "f", "d") for r in pages()], PAGE)
    path = shared_path(spark, "archives")
    warc.write_archives(df, path, least, records_per_file=50)
    got = sorted((tuple(r) for r in warc.read_pages(spark, path).collect()), key=str)
    assert got == brute.archived([(p, h) for p, _, h in pages()], least)


def test_payloads_stand_once_in_archives(spark):
    path = shared_path(spark, "archives")
    warc.write_archives(spark.createDataFrame(pages(), "page_id long, url string, html string"), path)
    records = warc.read_archives(spark, path).collect()
    bodies = [bytes(r.payload).decode() for r in records if r.record_type == "response"]
    assert sorted(bodies) == sorted({h or "" for _, _, h in pages()})
    assert len({r.record_id for r in records}) == len(records) == len(pages())
    assert {r.url for r in records if r.page_id == 6} == {"é%0D%0Ax: y"}


def test_archives_of_no_pages(spark):
    path = shared_path(spark, "archives")
    warc.write_archives(spark.createDataFrame([], PAGE), path)
    assert warc.read_pages(spark, path).count() == 0


def test_archives_of_others(spark, tmp_path):
    """A gzip member a record, a warcinfo record and other headers; and a broken one."""
    record = ("WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha1:{}\r\n"
              "X-Other: y\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n")
    info = record.format("warcinfo", "", 2, "ok")
    whole = record.format("response", "CH3K3DWFFIUYJK5K7V6DWULFAN4FYIDS", 1, "x")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(info.encode()) + gzip.compress(whole.encode()))
    (tmp_path / "b.warc").write_bytes(whole.encode())
    got = warc.read_archives(spark, str(tmp_path)).select("record_id", "payload_bytes", F.col("payload").cast("string")).collect()
    assert [tuple(r) for r in got] == [("<a>", 1, "x")] * 2
    for k, bad in enumerate((whole[:-3], whole.replace("\r\nx", "\r\ny"), "junk" + whole)):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "c.warc").write_bytes(bad.encode())
        with pytest.raises(Exception, match="whole|begins"):
            warc.read_archives(spark, str(tmp_path / str(k))).collect()


def test_archive_query(spark):
    for folder in (SF, "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()]
        got = queries.op12_warc(spark, folder)
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute.archived(rows)


def test_runs_of_random_words():
    rng = random.Random(6)
    for _ in range(3000):
        kinds = rng.choice([1, 2, 3, 5])
        words = [rng.randrange(kinds) for _ in range(rng.randrange(40))]
        root = [rng.randrange(kinds) for _ in range(rng.randrange(1, 6))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (root * 8)[:rng.randrange(30)]
        assert [tuple(r) for r in periodic.periodic_runs(words).tolist()] == brute.runs_of(words), words


def test_common_beginnings():
    rng = random.Random(7)
    text = [rng.randrange(2) for _ in range(300)]
    common = periodic.CommonBeginnings(*periodic.SuffixTree(text).tour())
    for _ in range(500):
        a, b = rng.sample(range(301), 2)
        want = next((k for k in range(301) if text[a + k:a + k + 1] != text[b + k:b + k + 1] or max(a, b) + k >= 300), 300)
        assert common(*(periodic.np.array([x]) for x in (a, b)))[0] == want


def test_runs_of_odd_documents(spark, odd, none):
    extra = [(60, "la " * 5000, "en", "s", 1), (61, "a\x1cb a\x1cb " * 9, "en", "s", 1), (62, "x y " * 3 + "\n\t" + "x y z " * 4, "en", "s", 1),
             (63, "\u3000 \u3000 " * 6, "en", "s", 1), (64, "a b " * 2000 + "c " + "a b c d e " * 400, "en", "s", 1)]
    rows = odd_rows() + [(*r, "k", 1, "w", 2, "c", "s", "b") for r in extra]
    df = spark.createDataFrame(rows, odd.schema)
    got = periodic.digest(periodic.find_runs(periodic.plant_tails(df)))
    assert got.columns == ["doc_id", *RUNS]
    want = [(r[0], *brute.run_digest(brute.planted(r[0], r[1]))) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert periodic.digest(periodic.find_runs(periodic.plant_tails(none))).count() == 0


def test_run_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: brute.run_digest(words) for d, words in ((d, brute.planted(d, t)) for d, t in rows) if len(words) < 3000}
    got = by_id(queries.op13_periodic_runs(spark, SF), "doc_id", RUNS)
    assert len(got) == len(rows) and len(want) > 150
    assert sum(w[0] for w in want.values()) > 0 and {d: got[d] for d in want} == want
