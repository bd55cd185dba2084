"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text stands for a language.  A text is parsed
against it into phrases, each the longest run that occurs in the labelled
text; c phrases in n characters against N characters of labelled text estimate
a cross entropy of c * log2(N) / n bits a character.  The language of least
cross entropy wins.

Every character of the labelled text has a code of its own; the last code is
for those that stand in no labelled text.  The automaton of the most frequent
characters is stored as one table from state and character to next state, with
the step that ends a phrase and begins the next built in, so such a character
costs one look-up.  The steps by all other characters are a sorted list, whose
length the labelled text bounds whatever the script.  Texts are cut into blocks
and all blocks and languages are parsed side by side in numpy; a phrase ends with
its block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulary.llm.common import held, in_slices

UNDETERMINED = "und"
_UNICODE = 0x110000


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions, by state, code -> state of the automaton of all substrings;
    0 is the start and never a target."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


class CrossParser:
    """Automata of several languages over one alphabet.

    ``samples``: labelled text by language.  The alphabet is all its characters
    (lower case) and one code for all others, which occurs in no automaton.
    The ``letters`` - 1 most frequent ones have a column of the table, whose
    last column is a step by a character that isn't in the automaton.
    """

    def __init__(self, samples: dict[str, str], letters: int = 64, block: int = 2048):
        self.languages = sorted(samples)
        self._block, self._size = block, letters
        texts = {k: samples[k].lower() for k in self.languages}
        known = [c for c, _ in sorted(Counter("".join(texts.values())).items(), key=lambda x: (-x[1], x[0]))]
        self._none = max(len(known), letters - 1)
        self._code = np.full(_UNICODE, self._none, np.min_scalar_type(self._none))
        self._code[[ord(c) for c in known]] = range(len(known))
        tables, starts, steps, at = [], [], [], 0
        for k in self.languages:
            automaton = suffix_automaton(self._code[np.frombuffer(texts[k].encode("utf-32-le"), np.uint32)].tolist())
            table = np.zeros((len(automaton), letters), np.int32)
            for s, row in enumerate(automaton):
                for c, t in row.items():
                    if c < letters - 1:
                        table[s, c] = t
                    else:
                        steps.append(((at + s) * (self._none + 1) + c, (at + t) * letters))
            odd = len(table)                      # behind a character that is in no run
            begin = np.where(table[0] == 0, odd, table[0])
            ends = np.vstack([table == 0, np.ones(letters, bool)])
            ends[0] = False                       # nothing has been read yet that could end
            table = np.where(ends[:odd] | (table == 0), begin, table)
            table = np.vstack([table, begin]) + at
            tables.append((table * letters) << 1 | ends)
            starts.append(at * letters)
            at += len(table)
        self._table = np.concatenate(tables).ravel().astype(np.int64 if at * letters * 2 >= 1 << 31 else np.int32)
        self._starts = np.array(starts, self._table.dtype)
        steps.sort()
        self._rare = np.array([x for x, _ in steps], np.int64)
        self._to = np.array([t for _, t in steps], self._table.dtype)
        self._bits = np.array([math.log2(max(2, len(texts[k]))) for k in self.languages])

    def _step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether there is a step from each state by a code without a column, and its target."""
        key = state.astype(np.int64) // self._size * (self._none + 1) + code
        at = np.minimum(np.searchsorted(self._rare, key), len(self._rare) - 1)
        return self._rare[at] == key, self._to[at]

    def _moves(self, state: np.ndarray, code: np.ndarray, move: np.ndarray) -> np.ndarray:
        """The table's ``move`` by a character of no automaton, put right for codes that have steps."""
        code = code.astype(np.int64)[:, None]
        goes, to = self._step(state, code)
        begins, anew = self._step(self._starts[None], code)
        return np.where(goes, to << 1, np.where(begins, anew << 1 | move & 1, move))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language, and the texts' lengths."""
        codes = [self._code[np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32)] for t in texts]
        lengths = np.array(list(map(len, codes)))
        of = np.repeat(np.arange(len(texts)), -(-lengths // self._block))
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        if not len(of):
            return counts, lengths
        flat = np.concatenate(codes)
        column = np.minimum(flat, self._size - 1)
        rare = (flat >= self._size - 1) & (flat < self._none)
        any_rare = rare.any()
        first = np.cumsum(lengths) - lengths
        number = np.arange(len(of)) - np.searchsorted(of, of)
        begin = first[of] + number * self._block
        width = np.minimum(self._block, first[of] + lengths[of] - begin)
        order = np.argsort(-width, kind="stable")
        of, begin, width = of[order], begin[order], width[order]
        live = np.searchsorted(-width, -np.arange(int(width[0])), "left")
        state = np.repeat(self._starts[None], len(of), axis=0)
        ended = np.zeros(state.shape, np.int32)
        for k in range(int(width[0])):
            n = live[k]
            place = begin[:n] + k
            move = self._table[state[:n] + column[place].astype(state.dtype)[:, None]]
            if any_rare and len(at := np.flatnonzero(rare[place])):
                move[at] = self._moves(state[at], flat[place[at]], move[at])
            ended[:n] += move & 1
            state[:n] = move >> 1
        np.add.at(counts, of, ended + 1)                  # the phrase that the block's end closes
        return counts, lengths

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language of each text and a score, one less the ratio of the
        least cross entropy to the second (0: a tie, or undetermined)."""
        counts, lengths = self.phrases(texts)
        bits = counts * self._bits / np.maximum(lengths, 1)[:, None]
        order = np.argsort(bits, axis=1, kind="stable")          # ties: the first name
        rows = np.arange(len(texts))
        best = bits[rows, order[:, 0]]
        second = bits[rows, order[:, 1]] if len(self.languages) > 1 else np.full(len(texts), np.inf)
        score = 1 - best / np.where(second > 0, second, 1)
        names, scores = [], []
        for k, text in enumerate(texts):
            known = any(map(str.isalpha, text))
            names.append(self.languages[order[k, 0]] if known else UNDETERMINED)
            scores.append(float(min(1.0, max(0.0, score[k]))) if known else 0.0)
        return names, scores


def _parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    return held(("parser", samples), lambda: CrossParser(dict(samples)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, pieces: int = 160, piece_chars: int = 250) -> dict[str, str]:
    """A bounded sample of labelled text by language.

    Of every lang, the ``pieces`` texts (not held out, with a letter) of least
    hash, equal ones once, each with ``piece_chars`` characters around a
    hashed place: at most pieces * piece_chars characters a language.
    """
    text, key = F.col("text"), F.xxhash64("text")
    least = (
        docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & text.rlike(r"\p{L}"))
        .select("lang", key.alias("key"), F.substring(
            text, (F.pmod(F.xxhash64(key), F.greatest(F.length(text) - piece_chars, F.lit(1))) + 1).cast("int"),
            F.lit(piece_chars)).alias("piece"))
        .groupBy("lang", "key").agg(F.first("piece").alias("piece")))
    # First within 64 parts of a language, so that no task ranks all texts of a common one.
    ranked = least.selectExpr("*", "row_number() OVER (PARTITION BY lang, pmod(key, 64) ORDER BY key) AS place") \
        .where(F.col("place") <= pieces) \
        .selectExpr("lang", "key", "piece", "row_number() OVER (PARTITION BY lang ORDER BY key) AS place") \
        .where(F.col("place") <= pieces)
    found: dict[str, list[str]] = {}
    for r in ranked.orderBy("lang", "place").collect():           # bounded: languages * pieces
        found.setdefault(r.lang, []).append(r.piece)
    return {k: "\n".join(v) for k, v in found.items()}


def identify(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """Per row: doc_id, lang_pred, score.  ``und`` with score 0 if the text is
    null or has no letter, or if there are no samples; repeated rows give
    repeated results; only doc_id and text are read."""
    key = tuple(sorted(samples.items()))
    empty = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not key:
        return empty.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(key)
        for batch in batches:
            for texts, part in in_slices(batch):
                names, scores = parser.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"])

    return empty.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """The rows of ``docs`` whose language can be told."""
    key, names = tuple(sorted(samples.items())), docs.columns
    if not key:
        return docs.limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(key)
        for batch in batches:
            for texts, part in in_slices(batch):
                predicted, _ = parser.predict(texts)
                yield part.filter(pa.array([p != UNDETERMINED for p in predicted], pa.bool_()))

    return docs.select(*names).mapInArrow(run, docs.schema)
