"""Token files of directly addressable codes.

An id is cut into 8-bit chunks.  Level 0 holds the low chunk of every id, and
each further level the next chunk of those ids that go on; a bitmap per level
marks them.  The chunk of id ``i`` on the next level stands at the number of
marks before ``i``, which a directory of ranks (one per 512 bits) and a count
over at most 64 bytes give, so any id is read without decoding others.

A file set is a Parquet folder.  Its rows are segments: whole documents of one
range of doc_id, in ascending order, with their ids and counts and the arrays
of each level.  Spark's committer writes it, so lost tasks leave nothing
behind, and any store that Spark reaches will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabulary.llm.common import ChunkCache, held, in_slices

_BLOCK = 64          # bytes of bitmap for each rank kept
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint32)

SEGMENTS = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int32()),
    ("start", pa.int64()),                       # ids of the shard before it
    ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("chunks", pa.list_(pa.binary())), ("marks", pa.list_(pa.binary())),
    ("ranks", pa.list_(pa.binary()))])
_DDL = ("shard int, segment int, start long, n_tokens long, doc_ids array<long>, "
        "counts array<long>, chunks array<binary>, marks array<binary>, ranks array<binary>")


class Codes:
    """One packed array of unsigned 32-bit ids."""

    def __init__(self, chunks: list[bytes], marks: list[bytes], ranks: list[bytes]):
        self.chunks = [np.frombuffer(x, np.uint8) for x in chunks]
        self.marks = [np.frombuffer(x, np.uint8) for x in marks]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    @classmethod
    def pack(cls, ids: np.ndarray) -> Codes:
        chunks, marks, ranks = [], [], []
        rest = np.asarray(ids, np.uint32)
        while rest.size or not chunks:
            on = rest > 255
            bits = np.packbits(on, bitorder="little")
            padded = np.zeros(-(-len(bits) // _BLOCK) * _BLOCK, np.uint32)
            padded[:len(bits)] = _ONES[bits]
            per_block = padded.reshape(-1, _BLOCK).sum(axis=1)
            chunks.append((rest & 255).astype(np.uint8).tobytes())
            marks.append(bits.tobytes())
            ranks.append((np.cumsum(per_block) - per_block).astype("<u4").tobytes())
            rest = rest[on] >> 8
        return cls(chunks, marks, ranks)

    def __len__(self) -> int:
        return len(self.chunks[0])

    def rank(self, level: int, i: int) -> int:
        """Marks before position ``i`` of a level."""
        if not len(self.marks[level]):
            return 0
        byte, bit = divmod(i, 8)
        block = min(byte // _BLOCK, len(self.ranks[level]) - 1)
        ones = int(self.ranks[level][block]) + int(_ONES[self.marks[level][block * _BLOCK:byte]].sum())
        return ones + (int(_ONES[self.marks[level][byte] & ((1 << bit) - 1)]) if bit else 0)

    def __getitem__(self, i: int) -> int:
        value = 0
        for level, chunk in enumerate(self.chunks):
            value |= int(chunk[i]) << (8 * level)
            if not self.marks[level][i >> 3] >> (i & 7) & 1:
                break
            i = self.rank(level, i)
        return value

    def slice(self, begin: int, end: int, level: int = 0) -> np.ndarray:
        """Ids ``begin`` to ``end``, without reading others."""
        out = self.chunks[level][begin:end].astype(np.uint32)
        if end > begin:
            bits = np.unpackbits(self.marks[level][begin >> 3:-(-end // 8)], bitorder="little")
            on = bits[begin & 7:][:end - begin].astype(bool)
            if n := int(on.sum()):
                at = self.rank(level, begin)
                out[on] |= self.slice(at, at + n, level + 1) << 8
        return out


def library_encoder(path: str) -> ChunkCache:
    return held(("library", path), lambda: _library_encoder(path))


def _library_encoder(path: str) -> ChunkCache:
    """Ids of the tokenizers library as little-endian unsigned 32-bit bytes,
    without added special tokens; for tokenizers in which a blank leads a word."""
    lib = Tokenizer.from_file(path)

    names = lib.get_vocab(with_added_tokens=True)
    added = {t.content: len(t.content.encode()) for t in lib.get_added_tokens_decoder().values()}
    width = np.zeros(max(names.values()) + 1, np.int64)     # bytes of each token
    for name, i in names.items():
        width[i] = added.get(name, len(name))               # one character stands for one byte

    def alone(chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch_fast(chunks, add_special_tokens=False)]

    def many(chunks: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(chunks), 256):       # one call for many chunks, cut by their bytes
            part = chunks[k:k + 256]
            ids = np.array(lib.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(c.encode()) for c in part])
            cuts = np.searchsorted(np.cumsum(width[ids]), ends)
            raw, at = ids.tobytes(), 0
            for cut in (4 * (cuts + 1)).tolist():
                out.append(raw[at:cut])
                at = cut
        return out

    return ChunkCache(alone, many, 1_500_000)


def write_token_files(docs: DataFrame, path: str, encoder: Callable[[], Callable[[list[str]], list[bytes]]],
                      end_id: int = 0, segment_tokens: int = 1 << 19) -> None:
    """Encode ``text`` of every row, append ``end_id`` to each document and
    write the ids to ``path`` in ascending doc_id order.

    A null text is an empty one (just ``end_id``); a null doc_id stands first;
    rows with the same doc_id follow one another by text.  A segment ends with
    the document that takes it to ``segment_tokens`` ids, so a longer document
    makes one of its own.  ``encoder`` is called in the task and returns the
    function from texts to their little-endian unsigned 32-bit ids.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(), TaskContext.get().partitionId()
        names: list[int | None] = []
        parts: list[bytes] = []
        held, start, segment = 0, 0, 0

        def flush() -> pa.RecordBatch:
            codes = Codes.pack(np.frombuffer(b"".join(parts), "<u4"))
            row = [shard, segment, start, len(codes), names, [len(p) // 4 for p in parts],
                   [x.tobytes() for x in codes.chunks], [x.tobytes() for x in codes.marks],
                   [x.tobytes() for x in codes.ranks]]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, SEGMENTS, strict=True)], schema=SEGMENTS)

        for batch in batches:
            for texts, part in in_slices(batch):
                for name, ids in zip(part.column("doc_id").to_pylist(), encode(texts), strict=True):
                    names.append(name)
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= segment_tokens:
                        yield flush()
                        start, segment, held = start + held, segment + 1, 0
                        names, parts = [], []
        if names:
            yield flush()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
         .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
         .mapInArrow(run, _DDL)
         .write.option("compression", "zstd").parquet(path))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start`` counted over all shards.  What is summed and
    joined has one row for each file's shard, so its size is bounded by the files."""
    segments = spark.read.schema(_DDL).parquet(path)
    sizes = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return segments.join(F.broadcast(before), "shard").withColumn("start", F.col("start") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                codes = Codes(row["chunks"], row["marks"], row["ranks"])
                bounds = np.concatenate([[0], np.cumsum(row["counts"])]).astype(int)
                raw = memoryview(codes.slice(0, len(codes)).astype("<u4").tobytes())     # whole segments, in one go
                crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(bounds[:-1] + row["start"], pa.int64()),
                     pa.array(row["counts"], pa.int64()), pa.array(crcs, pa.int64())], schema=schema)

    return read_segments(spark, path).select("start", "doc_ids", "counts", "chunks", "marks", "ranks") \
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """The ids at the given ``position`` values (counted over the whole file
    set), each read on its own from the segment that holds it.  Positions
    outside the files have no row; a repeated one has a row each time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["chunks"], row["marks"], row["ranks"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["at"], pa.int64()),
                     pa.array([codes[p - row["start"]] for p in row["at"]], pa.int64())],
                    ["position", "token_id"])

    segments = read_segments(spark, path)
    spans = segments.select("shard", "segment", "start", "n_tokens")
    grid = 1 << 16           # positions and segments meet on equal grid cells
    cells = spans.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("start") / grid), F.floor((F.col("start") + F.col("n_tokens") - 1) / grid))))
    wanted = positions.select(F.col("position").cast("long").alias("position")) \
        .withColumn("cell", F.floor(F.col("position") / grid)) \
        .join(cells, "cell") \
        .where("position >= start AND position < start + n_tokens") \
        .groupBy("shard", "segment").agg(F.collect_list("position").alias("at"))
    return segments.join(wanted, ["shard", "segment"]).select("start", "chunks", "marks", "ranks", "at") \
        .mapInArrow(run, "position long, token_id long")
