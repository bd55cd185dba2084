"""Quoted delimited files, read in parallel blocks (survey A2).

A quoted field may hold line breaks, so a task that begins in the middle of a
file can't tell whether its first line begins a record.  Spark's ``multiLine``
therefore reads a file in one task.  Here Spark's text reader splits the file
and three narrow steps find the records:

1. Each block gives a map: in which state (outside or inside of quotes) it
   ends, for either state in which it may begin.  Only lines with a quote
   take part.
2. Composing the maps in file order gives the state in which each block
   begins.  A map is the identity, a swap or a constant, so the composition
   is the last constant before a block and the swaps since: two running
   windows over one short row a block.
3. Each block, its first state known, is cut into records.  What begins or
   ends outside of it are fragments, at most two a block, which are put
   together by the block in which their record begins.

Spark's own CSV parser (``from_csv``) then reads the records, so fields are
those of a ``multiLine`` read.  Records end with ``\\n`` or ``\\r\\n``, and so
do lines within their fields; a ``\\r`` elsewhere is data.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import staged


_MARK = b"\xef\xbb\xbf"


class Quotes:
    """Whether a line ends inside of quotes, for one delimiter.

    A field is quoted if a quote begins it; a doubled quote is one of its
    characters, and what follows its end up to the delimiter is data, as are
    quotes within other fields.  A byte-order mark isn't part of a field.
    """

    def __init__(self, sep: str = ","):
        d = re.escape(sep.encode())
        body = rb'[^"]*+(?:""[^"]*+)*+'
        fields = rb'(?:(?:"' + body + rb'"[^' + d + rb']*+|[^"' + d + rb'][^' + d + rb']*+)?+' + d + rb")*+"
        self._outside = re.compile(fields + rb'"' + body + rb"\Z")
        self._inside = re.compile(body + rb'(?:"[^' + d + rb"]*+" + d + fields + rb'"' + body + rb")?+\Z")

    def inside_after(self, line: bytes, inside: bool) -> bool:
        if b'"' not in line:
            return inside
        return (self._inside if inside else self._outside).match(line.removeprefix(_MARK)) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block and line of the text at ``path``: in order within a block, blocks in any order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The parts of a batch with one file and block each."""
    file, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "block"))
    turns = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    bounds = [0, *turns.tolist(), batch.num_rows]
    for begin, end in pairwise(bounds):
        if end > begin:
            yield int(file[begin]), int(block[begin]), batch.slice(begin, end - begin)


def block_maps(lines: DataFrame, sep: str = ",") -> DataFrame:
    """(file, block, from_outside, from_inside): whether the block ends inside
    of quotes, by the state in which it begins."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, at, ends = Quotes(sep), None, (False, True)
        for batch in batches:
            for file, block, part in _runs(batch):
                if at != (file, block):
                    if at is not None:
                        yield _row(at, ends)
                    at, ends = (file, block), (False, True)
                for line in pc.drop_null(part.column("line")).to_pylist():
                    out = quotes.inside_after(line, ends[0])
                    ends = (out, out if ends[0] == ends[1] else quotes.inside_after(line, ends[1]))
        if at is not None:
            yield _row(at, ends)

    def _row(at: tuple[int, int], ends: tuple[bool, bool]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"file": pa.array([at[0]], pa.int64()), "block": pa.array([at[1]], pa.int64()),
             "from_outside": [ends[0]], "from_inside": [ends[1]]})

    with_quote = F.when(F.contains("line", F.lit('"').cast("binary")), F.col("line"))
    return lines.select("file", "block", with_quote.alias("line")).mapInArrow(
        scan, "file long, block long, from_outside boolean, from_inside boolean")


def first_states(maps: DataFrame) -> DataFrame:
    """(file, block, inside): whether the block begins inside of quotes."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    constant = F.col("from_outside") == F.col("from_inside")
    swaps = F.sum(F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)).over(upto)
    last = F.last(F.when(constant, F.struct(F.col("from_outside").cast("int").alias("state"), "swaps")), ignorenulls=True)
    return (
        maps.withColumn("swaps", swaps)
        .select("file", "block", last.over(before).alias("last"), F.coalesce(F.lag("swaps").over(
            Window.partitionBy("file").orderBy("block")), F.lit(0)).alias("done"))
        .select("file", "block", ((F.coalesce("last.state", F.lit(0)) + F.col("done") - F.coalesce("last.swaps", F.lit(0))) % 2 == 1)
                .alias("inside")))


def _cut(lines: DataFrame, states: DataFrame, sep: str, fragments: bool) -> DataFrame:
    """The records that lie within one block, or the fragments of the others.

    ``first`` marks the first record of a file; a fragment is the beginning of
    its record (``begins``) or goes on with one, and is ``open`` if it ends
    inside of quotes.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, at, state = Quotes(sep), None, False
        held: list[bytes] = []              # lines of the record that goes on
        begins, number, out, size = True, 0, [], 0

        def give() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                               names=["file", "block", "first", "begins", "open", "record"])
            out.clear()
            return batch

        def end(whole: bool) -> None:
            if held and (whole and begins) != fragments:
                out.append((*at, begins and number == 0 and at[1] == 0, begins, state, b"\n".join(held)))

        for batch in batches:
            for file, block, part in _runs(batch):
                if at != (file, block):
                    end(False)
                    at, state, number = (file, block), part.column("inside")[0].as_py(), 0
                    held, begins = [], not state
                for line in part.column("line").to_pylist():
                    if block == 0 and number == 0 and not held:
                        line = line.removeprefix(_MARK)
                    state = quotes.inside_after(line, state)
                    held.append(line)
                    size += len(line)
                    if not state:
                        end(True)
                        held, begins, number = [], True, number + 1
                    if size > 1 << 22 and out:
                        yield give()
                        size = 0
        end(False)
        yield give()

    # One short row a block of the file system; the table is a thousandth of a percent of the files.
    known = lines.join(F.broadcast(states), ["file", "block"]).select("file", "block", "inside", "line")
    return known.mapInArrow(scan, "file long, block long, first boolean, begins boolean, open boolean, record binary")


def quoted_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A row for each record of the files at ``path``: first (whether it is
    the first of its file), file (a hash of its path), open (whether a quote
    isn't closed) and record (its text without the line end).

    Empty lines between records are rows with an empty record.  A quote that
    is never closed takes what is left of the file.  Bytes that aren't UTF-8
    become replacement characters.  Order isn't kept.
    """
    lines = _lines(spark, path)
    states = staged(first_states(block_maps(lines, sep)), "quoted-blocks")
    fragments = staged(_cut(lines, states, sep, True), "quoted-fragments")
    # A fragment that goes on belongs to the last one before it that begins a
    # record; in a block it stands before the one that begins.
    order = Window.partitionBy("file").orderBy("block", "begins").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = (
        fragments.withColumn("number", F.sum(F.col("begins").cast("long")).over(order))
        .groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("block", "begins", "open", "record"))).alias("parts"), F.bool_or("first").alias("first"))
        .select("first", "file", F.element_at("parts", -1)["open"].alias("open"),
                F.array_join(F.transform("parts", lambda p: p["record"].cast("string")), "\n").alias("record")))
    whole = _cut(lines, states, sep, False).select("first", "file", "open", F.col("record").cast("string").alias("record"))
    # Where \r\n ends a record, it is also read as \n within its fields.
    text = F.when(F.endswith("record", F.lit("\r")), F.replace(
        F.regexp_replace("record", "\r\\z", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    return whole.unionAll(joined).select("first", "file", "open", F.make_valid_utf8(text).alias("record"))


def read_quoted(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, bad_rows: str = "FAILFAST",
                sep: str = ",") -> DataFrame:
    """The rows of quoted files, as ``spark.read.csv(multiLine=True)`` gives
    them, each file read by as many tasks as it has blocks.

    With ``header`` the first record of each file is left out.  Empty records
    are no rows.  ``bad_rows``: FAILFAST or PERMISSIVE.
    """
    records = quoted_records(spark, path, sep)
    if header:
        records = records.where(~F.col("first"))
    return records.where("record <> ''").select(parsed("record", schema, bad_rows, sep).alias("row")).select("row.*")


def parsed(record: str, schema: T.StructType, bad_rows: str, sep: str = ",", **options: str) -> Column:
    """A record's fields, read by Spark's CSV parser."""
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(record, ddl, {"mode": bad_rows, "sep": sep, "quote": '"', "escape": '"', "multiLine": "true", **options})


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """(file, path) of the files at ``path``; none is opened."""
    return spark.read.format("binaryFile").load(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_path").alias("path"))
