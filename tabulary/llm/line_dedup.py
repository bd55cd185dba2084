"""Line deduplication by a join of deletion neighbourhoods.

A line is a sequence of words, and the edit distance counts words inserted,
deleted or replaced.  Within one edit of each other are two lines of which one
without a word is the other, or which become equal when both lose the word at
the same place.  So each line emits its variants, itself and itself without
each of its words, as hashed keys, and equal keys meet.  Per key, and per key
and place of the deleted word, only the earliest line is kept as a partner, by
an aggregation; each line is joined with that one, so a template that fills a
large part of the corpus makes one link a line and not all pairs.  The links
are verified on the words.

Before that a filter that loses nothing keeps the number of variants down: of
two lines within one edit, the halves of one side of the edit are equal, so a
line that shares no half with another has no partner and emits nothing.

Everything is a DataFrame expression.  Hashes of word sequences are the xor of
the hashes of (word, place): removing a word needs only running xors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulary.llm.common import drop_staged, free_names, staged


def _words(line: Column) -> Column:
    return F.filter(F.split(line, " "), lambda w: w != "")


def _halves(words: Column, n: Column) -> Column:
    """Keys of the first and the last half, as a line of n and of n - 1 words."""
    def of(size: Column, tag: int) -> list[Column]:
        half = F.floor(size / 2).cast("int")
        return [F.xxhash64(F.lit(tag), size, F.slice(words, 1, half)),
                F.xxhash64(F.lit(tag + 1), size, F.slice(words, n - half + 1, half))]
    return F.array(*of(n, 0), *of(n - 1, 0))


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """The lines with a word: doc_id, text_key and pos (together the place),
    a 128-bit key of the words, and the keys of the halves of long lines.

    What stands beside a generator is evaluated for each row it makes, so the
    text's key is made before it and the words inside it.
    """
    words, n = F.col("words"), F.size("words")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
        .select("doc_id", "text_key", F.posexplode(F.transform(F.split("text", "\n"), _words)).alias("pos", "words"))
        .where(n > 0)
        .select("doc_id", "text_key", "pos", F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(1), words).alias("h2"),
                F.when(n >= min_words, _halves(words, n)).alias("halves")))


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one edit apart: what lies between
    their common beginning and their common end is at most one word each."""
    shorter = F.least(F.size(a), F.size(b))
    places = F.sequence(F.lit(1), shorter)
    head = F.coalesce(F.array_min(F.filter(places, lambda i: F.get(a, i - 1) != F.get(b, i - 1))) - 1, shorter)
    tail = F.coalesce(F.array_min(F.filter(
        places, lambda i: F.get(a, F.size(a) - i) != F.get(b, F.size(b) - i))) - 1, shorter)
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (F.greatest(F.size(a), F.size(b)) - head - tail <= 1)


def _partners(words: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Links (h1, h2) -> (t1, t2) from a line to an earlier one within one edit,
    and the staged tables that they are read from.

    ``words``: first (the line's first place), h1, h2 and words of each line.
    """
    place, hashes = F.col("p"), [(k, s) for k in "ab" for s in (1, 2)]
    by_line = Window.partitionBy("h1", "h2").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def hashed(word: Column, at: Column, kind: str, s: int) -> Column:      # b: moved up by one place
        return F.xxhash64(word, at - 1 if kind == "b" else at, F.lit(s))

    def all_of(kind: str, s: int) -> Column:
        return F.aggregate(F.transform("words", lambda w, i: hashed(w, i, kind, s)),
                           F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    runs = (
        words.repartition("h1", "h2")
        .select("h1", "h2", F.size("words").alias("n"),
                *(all_of(k, s).alias(f"all_{k}{s}") for k, s in hashes), "words")
        .select("h1", "h2", "n", *(f"all_{k}{s}" for k, s in hashes), F.posexplode("words").alias("p", "w"))
        .select("h1", "h2", "n", "p", *(f"all_{k}{s}" for k, s in hashes),
                *(hashed(F.col("w"), place, k, s).alias(f"{k}{s}") for k, s in hashes))
        .select("*", *(F.bit_xor(f"{k}{s}").over(by_line).alias(f"upto_{k}{s}") for k, s in hashes)))

    def without(s: int) -> Column:     # the words before, and those behind moved up
        out = F.col(f"upto_a{s}")
        for c in (f"a{s}", f"all_b{s}", f"upto_b{s}"):
            out = out.bitwiseXOR(F.col(c))
        return out

    itself = F.struct(F.col("all_a1").alias("v1"), F.col("all_a2").alias("v2"), F.lit(-1).alias("place"),
                      F.col("n").alias("length"))
    shorter = F.struct(without(1).alias("v1"), without(2).alias("v2"), place.alias("place"),
                       (F.col("n") - 1).alias("length"))
    variants = staged(runs.select("h1", "h2", F.explode(
        F.when(place == 0, F.array(itself, shorter)).otherwise(F.array(shorter))).alias("v"))
        .select("h1", "h2", "v.*"), "variants")

    # most variants are met by no other line: a plain count leaves them out before anything is sorted
    common = variants.groupBy("v1").agg(F.count("*").alias("m")).where("m > 1").select("v1")
    met = staged(variants.join(common, "v1", "left_semi")
                 .join(words.select("h1", "h2", "first"), ["h1", "h2"]), "met")
    key = ["v1", "v2", "length"]
    heads = (
        met.groupBy(*key, "place").agg(F.min(F.struct("first", "h1", "h2")).alias("head"))
        .groupBy(*key).agg(
            F.min(F.when(F.col("place") < 0, F.col("head"))).alias("whole"),
            F.min(F.when(F.col("place") >= 0, F.col("head"))).alias("cut"),
            F.map_from_entries(F.collect_list(F.struct("place", "head"))).alias("same")))
    to = F.array(F.when(F.col("place") < 0, F.col("cut")).otherwise(F.col("whole")), F.col("same")[F.col("place")])
    links = (
        met.join(heads, key).select("first", "h1", "h2", F.explode(F.array_compact(to)).alias("to"))
        .where("to.first < first")
        .select("h1", "h2", F.col("to.h1").alias("t1"), F.col("to.h2").alias("t2")).distinct())
    return links, [variants, met]


def dropped_lines(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """Per document that loses lines: doc_id, text_key (xxhash64 of the text),
    ``drop`` (the positions lost) and ``n_near`` (how many of them for an
    earlier line within one edit, not for an equal one)."""
    lines = staged(lines_of(docs, min_words), "lines")
    distinct = lines.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "text_key", "pos")).alias("first"), F.count("*").alias("times"))

    halves = lines.where("halves IS NOT NULL").select("h1", F.explode("halves").alias("half"))
    common = halves.groupBy("half").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x <> y").select("half")
    able = halves.join(common, "half", "left_semi").select("h1").distinct()
    wanted = distinct.join(able, "h1", "left_semi") \
        .groupBy(F.col("first.doc_id").alias("in_doc"), F.col("first.text_key").alias("in_text")) \
        .agg(F.collect_list(F.struct("first", "h1", "h2")).alias("at"))
    words = staged(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.xxhash64("text") == F.col("in_text")))
        .select(F.split("text", "\n").alias("lines"), "at")
        .select("lines", F.explode("at").alias("at"))
        .select("at.*", _words(F.get("lines", F.col("at.first.pos"))).alias("words"))
        .dropDuplicates(["h1", "h2"]), "words")

    other = words.select(F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.col("words").alias("other"))
    links, used = _partners(words)
    near = staged(
        links.join(words.select("h1", "h2", "words"), ["h1", "h2"]).join(other, ["t1", "t2"])
        .where(within_one_edit(F.col("words"), F.col("other"))).select("h1", "h2").distinct(), "near")

    drop_staged(words, *used)

    verdict = distinct.select("h1", "h2", "first", "times").join(
        near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("times > 1 OR near")
    here = F.struct("doc_id", "text_key", "pos")
    return (
        lines.select("h1", "h2", "doc_id", "text_key", "pos").join(verdict, ["h1", "h2"])
        .where(F.coalesce("near", F.lit(False)) | (here != F.col("first")))
        .withColumn("by_near", (F.coalesce("near", F.lit(False)) & (here == F.col("first"))).cast("long"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("drop"), F.sum("by_near").alias("n_near")))


def dedup_lines(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """The rows of ``docs`` without lines that stand earlier, with ``lines_before``,
    ``lines_exact`` and ``lines_near``: how many lines the text had, how many went for an equal earlier line
    and how many for an earlier one within one edit.

    Lines are parted by line breaks, words by blanks; lines with the same words
    are equal, and lines of at least ``min_words`` words are near if they are
    at most one word apart (in shorter ones one word is too large a part).  The
    earliest is that of the least (doc_id, hash of the text, position).  A line
    goes if an earlier one is equal or near, whether or not that one stays.
    Lines without a word stay.  A null text stays null; repeated rows are one
    document, so they don't take each other's lines; rows without a doc_id come
    first and lose nothing.  Other columns are kept, ``text`` is replaced, and so
    are columns that have the name of a result.
    """
    results = ("lines_before", "lines_exact", "lines_near")
    docs = docs.drop(*results)
    of_doc, of_text, drop, n_near, all_lines = free_names(docs.columns, "of_doc", "of_text", "drop", "n_near", "lines")
    drops = dropped_lines(docs, min_words).toDF(of_doc, of_text, drop, n_near)
    joined = docs.join(drops, (F.col("doc_id").cast("long") == F.col(of_doc)) & (F.xxhash64("text") == F.col(of_text)), "left")
    # a generator of one row keeps the split from being evaluated again for each line below
    joined = joined.select("*", F.explode(F.array(F.coalesce(F.split("text", "\n"), F.array()))).alias(all_lines))
    lines = F.col(all_lines)
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop)))
    text = F.when(F.col(drop).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    near = F.coalesce(n_near, F.lit(0)).cast("long")
    gone = F.when(F.col(drop).isNull(), F.lit(0)).otherwise(F.size(drop)).cast("long")
    return joined.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("lines_before"),
        (gone - near).alias("lines_exact"), near.alias("lines_near"))


def oracle(table: str = "documents", min_words: int = 8) -> str:
    """DuckDB SQL of the query: variants are word lists written out as text."""
    return f"""
WITH l AS (
  SELECT doc_id, text, i - 1 AS pos,
         list_filter(string_split(string_split(text, chr(10))[i], ' '), lambda w: w <> '') AS words
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM {table})),
o AS (SELECT doc_id, pos, array_to_string(words, ' ') AS line, len(words) AS n FROM l WHERE len(words) > 0),
d AS (SELECT line, n, min(doc_id * 1000000 + pos) AS first FROM o GROUP BY ALL),
v AS (SELECT first, n - 1 AS size, i AS place,
             md5(array_to_string(list_concat(string_split(line, ' ')[:i - 1], string_split(line, ' ')[i + 1:]), ' ')) AS variant
      FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d WHERE n >= {min_words})
      UNION ALL SELECT first, n, 0, md5(line) FROM d WHERE n >= {min_words}),
near AS (SELECT DISTINCT a.first FROM v a JOIN v b
         ON a.variant = b.variant AND a.size = b.size AND b.first < a.first
         AND (a.place = b.place OR a.place = 0 OR b.place = 0)),
verdict AS (
  SELECT o.doc_id, o.pos, o.doc_id * 1000000 + o.pos <> d.first AS exact, near.first IS NOT NULL AS near
  FROM o JOIN d USING (line) LEFT JOIN near ON d.first = near.first),
dropped AS (SELECT doc_id, pos, NOT exact AS near FROM verdict WHERE exact OR near),
kept AS (
  SELECT l.doc_id, count(*) AS lines_before, count(x.pos) FILTER (NOT x.near) AS lines_exact,
         count(x.pos) FILTER (x.near) AS lines_near,
         coalesce(string_agg(string_split(l.text, chr(10))[l.pos + 1], chr(10) ORDER BY l.pos) FILTER (x.pos IS NULL), '') AS t
  FROM l LEFT JOIN dropped x USING (doc_id, pos) GROUP BY l.doc_id)
SELECT doc_id, lines_before, lines_exact, lines_near, length(t) AS n_chars, sha256(t) AS text_sha256 FROM kept"""
