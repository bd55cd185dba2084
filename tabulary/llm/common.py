"""Helpers that several operators share."""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tabulary.session import ensure_checkpoint_dir

_STAGED: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(columns: list[str], *names: str) -> list[str]:
    """Names for helper columns: ``names``, led by as many underscores as it takes to clash with none of ``columns``."""
    taken = {c.lower() for c in columns}
    lead = ""
    while any(f"{lead}{n}".lower() in taken for n in names):
        lead += "_"
    return [lead + n for n in names]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs the reading of a file, not the
    stages before it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()      # lets Spark drop the shuffle files of the step that ended
    out = spark.read.schema(schema).parquet(path)
    out.__dict__["_staged_path"] = path
    return out


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def drop_staged(*frames: DataFrame) -> None:
    """Delete the folders of staged frames that nothing reads any more."""
    for df in frames:
        path = df.__dict__["_staged_path"]
        _STAGED.remove(path)
        _delete(df.sparkSession, [path])


def clear_staged(spark: SparkSession) -> None:
    """Delete what :func:`staged` and :func:`shared_path` made; frames that
    still read those folders must have been consumed."""
    _delete(spark, _STAGED)
    _STAGED.clear()


_HELD: dict = {}


def held(key: tuple, make: Callable):
    """What ``make`` returns, kept by this worker process for the next task.

    Only the last key's object is kept: a worker that goes on with another
    operator gives the former one's tables and caches back.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def in_slices(batch: pa.RecordBatch, text: str = "text",
              most: int = 1 << 21) -> Iterator[tuple[list[str], pa.RecordBatch]]:
    """Parts of a batch with about ``most`` bytes of text each, and the texts
    (null: empty).  A longer text makes a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    begin, held = 0, 0
    for k, size in enumerate([*sizes, most]):
        if k > begin and (held + size > most or k == len(sizes)):
            part = batch.slice(begin, k - begin)
            yield [t or "" for t in part.column(text).to_pylist()], part
            begin, held = k, 0
        held += size


#: A blank that stands alone between two other characters.
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")


class ChunkCache:
    """Encodings of the blank-separated chunks of texts, as bytes.

    A byte-level tokenizer whose pattern lets one blank lead a word starts a
    piece at each lone blank, so a text's encoding is the concatenation of its
    chunks' encodings.  A chunk that begins or ends in white space could join
    a run of white space over its border; a text with such a chunk is split
    at blanks between two visible characters only, which is always safe.

    ``alone`` encodes chunks one by one, ``many`` chunks that all begin with
    their blank, perhaps joined; at most ``most`` encodings are kept.
    """

    def __init__(self, alone: Callable[[list[str]], list[bytes]],
                 many: Callable[[list[str]], list[bytes]], most: int = 1_000_000):
        self._alone, self._many, self._most = alone, many, most
        self._known: dict[str, bytes | None] = {}        # by the chunk behind its blank
        self._leads: dict[str, bytes | None] = {}        # first chunks of texts

    def _learn(self, known: dict, seen: set[str], most: int, blank: str, encode: Callable) -> None:
        """Add the encodings of new chunks; None where a chunk can't stand alone."""
        new = seen.difference(known)
        if len(known) + len(new) > most:
            known.clear()
            new = seen
        plain = [w for w in new if w and not w[0].isspace() and not w[-1].isspace()]
        known.update(dict.fromkeys(new))
        known.update(zip(plain, encode([blank + w for w in plain]), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        rests = [t.split(" ") for t in texts]
        firsts = [r.pop(0) for r in rests]
        self._learn(self._leads, set(firsts), self._most // 4, "", self._alone)
        self._leads[""] = b""
        self._learn(self._known, set().union(*rests), self._most, " ", self._many)
        lead, known, out = self._leads.__getitem__, self._known.__getitem__, []
        for text, first, rest in zip(texts, firsts, rests, strict=True):
            try:
                out.append(lead(first) + b"".join(map(known, rest)))
            except TypeError:
                out.append(self._apart(text))
        return out

    def _apart(self, text: str) -> bytes:
        first, *rest = _LONE_BLANK.split(text)
        return self._alone([first])[0] + b"".join(self._many([" " + w for w in rest]))
