"""Quoted files in parallel blocks, and bad rows kept apart."""

import os
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulary.sources import quoted
from tabulary.sources.csv import read_with_rejects

ABC = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
TYPED = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                      T.StructField("n", T.LongType())])


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few bytes, so that records lie across many of them."""
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _folder(texts):
    folder = tempfile.mkdtemp(prefix="tabulary-quoted-")
    for k, text in enumerate(texts):
        with open(os.path.join(folder, f"{k:03}.csv"), "wb") as f:
            f.write(text.encode() if isinstance(text, str) else text)
    return folder


def _multi_line(spark, folder, schema=ABC):
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"')
            .option("escape", '"').option("columnPruning", False).csv(folder))


def _same(a, b):
    return Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def _odd_file(rng, end):
    def field():
        kind = rng.randrange(6)
        if kind < 2:
            return "".join(rng.choice("ab ") for _ in range(rng.randrange(5)))
        if kind == 2:
            return rng.choice(['x"y', 'p" q"', '"ab"c', 'é"'])
        return '"' + "".join(rng.choice(["a", "b", ",", end, end, '""', " ", "é"]) for _ in range(rng.randrange(12))) + '"'

    lines = [f'h1,h2,"h{end}3"'] + [",".join(field() for _ in range(rng.choice([3, 3, 3, 2, 4]))) for _ in range(rng.randrange(9))]
    if end == "\n" and rng.random() < 0.3:
        return end.join(lines) + rng.choice(["", '\n"open,\nx'])
    return end.join(lines) + end


@pytest.mark.parametrize("seed, end, size", [(1, "\n", "24b"), (2, "\n", "9b"), (3, "\r\n", "40b")])
def test_records_are_those_of_one_task(spark, small_blocks, seed, end, size):
    rng = random.Random(seed)
    folder = _folder([_odd_file(rng, end) for _ in range(6)] + [""])
    want = _multi_line(spark, folder).collect()
    small_blocks(size)
    got = quoted.read_quoted(spark, folder, ABC, bad_rows="PERMISSIVE")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want))


def test_one_file_is_read_by_many_tasks(spark, small_blocks):
    rows = [f'{i},"line one of {i}\nand ""two"", with a comma\n",{i * 7}' for i in range(4000)]
    folder = _folder(["id,name,n\n" + "\n".join(rows) + "\n"])
    want = _multi_line(spark, folder, TYPED).collect()
    small_blocks("16k")
    df = quoted.read_quoted(spark, folder, TYPED)
    assert df.rdd.getNumPartitions() >= 8
    assert df.select(F.spark_partition_id()).distinct().count() >= 8
    assert Counter(map(tuple, df.collect())) == Counter(map(tuple, want)) and len(want) == 4000


def test_a_field_longer_than_many_blocks(spark, small_blocks):
    long = "x,\n" * 3000
    folder = _folder([f'a,b,c\n1,"{long}",2\n3,4,5\n', 'a,b,c\n6,7,"8"'])
    small_blocks("100b")
    got = sorted(map(tuple, quoted.read_quoted(spark, folder, ABC).collect()))
    assert got == [("1", long, "2"), ("3", "4", "5"), ("6", "7", "8")]


def test_marks_bytes_and_empty_files(spark):
    folder = _folder(['\ufeff"a\nb",b,c\n1,2,3\n', b'a,b,c\n\xff,"\xc3\xa9",z\n\n\n', "", "a,b,c"])
    got = sorted(map(tuple, quoted.read_quoted(spark, folder, ABC).collect()))
    assert got == [("1", "2", "3"), ("\ufffd", "é", "z")]
    no_header = _folder(['\ufeff"a",b,c\n'])
    assert [tuple(r) for r in quoted.read_quoted(spark, no_header, ABC, header=False).collect()] == [("a", "b", "c")]


def test_states_are_composed_in_file_order(spark):
    """Against a fold of the maps, block by block."""
    rng = random.Random(5)
    maps, want = [], {}
    for file in range(20):
        state = False
        for block in range(rng.randrange(1, 12)):
            outside, inside = rng.random() < 0.5, rng.random() < 0.5
            maps.append((file, block * 100, outside, inside))
            want[file, block * 100] = state
            state = inside if state else outside
    rng.shuffle(maps)
    df = spark.createDataFrame(maps, "file long, block long, from_outside boolean, from_inside boolean")
    assert {(r.file, r.block): r.inside for r in quoted.first_states(df).collect()} == want


@pytest.mark.parametrize("is_quoted", [True, False])
def test_bad_rows_are_kept_apart(spark, is_quoted):
    rows = ["1,ok,5", "2,surplus,5,6", "3,missing", "four,number,4", "5,,", "6,big,99999999999999999999999", "7,fine,7"]
    texts = ["id,name,n\n" + "\n".join(rows) + "\n\n", "id,name,n\n8,x,\n"]
    if is_quoted:
        texts.append('id,name,n\n9,"two\nlines",1\nten,"two\nlines",1\n11,"never closed,2\n12,x,3\n')
    folder = _folder(texts)
    good, bad = read_with_rejects(spark, folder, TYPED, quoted=is_quoted)
    want = {(1, "ok", 5), (5, None, None), (7, "fine", 7), (8, "x", None)}
    reasons = {("2,surplus,5,6", "fields"), ("3,missing", "fields"), ("four,number,4", "value of id"),
               ("6,big,99999999999999999999999", "value of n")}
    if is_quoted:
        want.add((9, "two\nlines", 1))
        reasons |= {('ten,"two\nlines",1', "value of id"), ('11,"never closed,2\n12,x,3', "quote not closed")}
    assert good.columns == ["id", "name", "n"] and bad.columns == ["file", "record", "reason"]
    assert set(map(tuple, good.collect())) == want
    assert {(r.record, r.reason) for r in bad.collect()} == reasons
    assert {os.path.basename(r.file) for r in bad.collect()} <= {"000.csv", "002.csv"}
