"""Licence scans by a positional index of licence words.

Licence templates are short word lists, and the index maps each of their words
to its postings (template, position).  Of a file the licence words in it with
the highest IDF, counted over all documents, are looked up, and the rarest key
word of each template whose key phrases can be in it.  A word's place less its
position in the template is a shift; a shift on which enough words of a template
agree, or its key word stands, is a candidate.  A candidate counts if the
template's key phrases stand where the shift puts them, and its score is the
share of the template's words that do.  A phrase that makes a base label is a
template that is all key phrase, so its places come from the same index.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulary.llm.common import in_slices

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The phrases that make a base label.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Wording of public licences and of their usual notices, with
# the phrases that must stand in it.
TEMPLATES = [
    ("agpl", "GNU Affero General Public License", ["affero general public license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License",
     ["creative commons attribution noncommercial"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License",
     ["creative commons attribution sharealike"]),
    ("cc0", "dedicated all copyright and related and neighboring rights to this work to the public domain",
     ["public domain"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted", ["with or without fee"]),
    ("lgpl", "GNU Lesser General Public License", ["lesser general public license"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", ["permission is hereby granted"]),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]


def words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())          # bytes: only A-Z are lower-cased


def _places(found: list[bytes], phrase: tuple[bytes, ...]) -> list[int]:
    """Where the words of a phrase stand one behind the other."""
    out, at, n = [], -1, len(phrase)
    try:
        while True:
            at = found.index(phrase[0], at + 1)
            if tuple(found[at:at + n]) == phrase:
                out.append(at)
    except ValueError:
        return out


@dataclass
class Template:
    label: str
    words: list[bytes]
    keys: list[tuple[int, tuple[bytes, ...]]]            # position and words of each key phrase
    base: bool = False                                   # a phrase that makes a base label


def templates(spec: Iterable[tuple[str, str, list[str]]]) -> list[Template]:
    out = []
    for label, text, phrases in spec:
        own = words(text)
        keys = [(at, p) for p in (tuple(words(p)) for p in phrases) for at in _places(own, p)[:1]]
        if len(keys) != len(phrases):
            raise ValueError(f"a key phrase of {label} isn't in its template")
        out.append(Template(label, own, keys))
    return out


def base_templates(phrases: dict[str, str]) -> list[Template]:
    """Templates whose whole text is their key phrase."""
    return [Template(label, list(p), [(0, p)], True) for phrase, label in phrases.items() if (p := tuple(words(phrase)))]


class Index:
    """Postings of every template word, looked up by the words of a file.

    ``idf``: of each template word.  Of a file its ``lookups`` licence words of
    highest IDF are looked up, and of each template whose key words it has the
    rarest one.  A shift is a candidate if ``agree`` of these words stand on it
    or the key word does; so none that has the key phrases is missed.
    """

    def __init__(self, known: list[Template], idf: dict[bytes, float], lookups: int = 4, agree: int = 2,
                 share: float = 0.5):
        self.templates, self._idf, self._lookups, self._agree, self._share = known, idf, lookups, agree, share
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self._needs: list[frozenset[bytes]] = []
        self._key: list[tuple[int, bytes]] = []
        for t, template in enumerate(known):
            for at, word in enumerate(template.words):
                self.postings[word].append((t, at))
            of_keys = [(at + k, w) for at, p in template.keys for k, w in enumerate(p)]
            self._needs.append(frozenset(w for _, w in of_keys))
            self._key.append(min(of_keys, key=lambda x: (-idf.get(x[1], math.inf), x)))

    def matches(self, found: list[bytes]) -> list[tuple[str, int, float]]:
        """Verified alignments: label, first word and share of the template's words."""
        return [(self.templates[t].label, shift, share) for t, shift, share in self.alignments(found)]

    def alignments(self, found: list[bytes]) -> list[tuple[int, int, float]]:
        """Verified alignments: template's number, first word and share of its words."""
        present = set(found).intersection(self.postings)
        able = {t for t, needs in enumerate(self._needs) if needs <= present}
        if not able:
            return []
        rare = sorted(present, key=lambda w: (-self._idf.get(w, math.inf), w))[:self._lookups]
        votes: Counter[tuple[int, int]] = Counter()
        for word in {*rare, *(self._key[t][1] for t in able)}:
            postings = [(t, position, self._agree if (position, word) == self._key[t] else 1)
                        for t, position in self.postings[word] if t in able]
            for at in _places(found, (word,)) if postings else ():
                for t, position, weight in postings:
                    votes[t, at - position] += weight
        out = []
        for (t, shift), n in sorted(votes.items()):
            template = self.templates[t]
            if n < self._agree:
                continue
            if any(shift + at < 0 or tuple(found[shift + at:shift + at + len(p)]) != p for at, p in template.keys):
                continue
            same = sum(0 <= shift + k < len(found) and found[shift + k] == w for k, w in enumerate(template.words))
            if same >= self._share * len(template.words):
                out.append((t, shift, same / len(template.words)))
        return out


def word_idf(docs: DataFrame, vocabulary: list[bytes]) -> dict[bytes, float]:
    """IDF of the given words over all documents (bounded: one row a word)."""
    known = frozenset(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            for texts, _ in in_slices(batch):
                n += len(texts)
                for text in texts:
                    counts.update(known.intersection(words(text)))
        rows = [(b"", n), *counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()),
                                          pa.array([c for _, c in rows], pa.int64())], ["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {bytes(r.word): r.n for r in rows}
    total = df.get(b"", 0)
    return {w: math.log((total + 1) / (df.get(w, 0) + 1)) for w in known}


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, places array<struct<label: string, first_word: long, share: double>>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("places", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("share", pa.float64())])))])


def scan(docs: DataFrame, spec: list[tuple[str, str, list[str]]] = TEMPLATES,
         phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per row: doc_id, n_words, the base phrases' places (n_base, first_word,
    last_word), base_labels, labels (with the index's), score, and ``places``, the index's
    verified alignments.

    The score is 1 if a base phrase stands in the text, else the largest share
    of a template's words at a verified alignment, else 0.  A null text is an
    empty one, without words or labels; repeated rows give repeated results;
    only doc_id and text are read.
    """
    known = templates(spec) + base_templates(phrases)
    idf = word_idf(docs, sorted({w for t in known for w in t.words}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(known, idf)
        for batch in batches:
            for texts, part in in_slices(batch):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    found = words(text)
                    matched, by_label, starts = [], set(), []
                    for t, at, share in index.alignments(found):
                        if known[t].base:
                            by_label.add(known[t].label)
                            starts.append(at)
                        else:
                            matched.append((known[t].label, at, share))
                    shares = [s for _, _, s in matched]
                    rows.append({
                        "doc_id": doc_id, "n_words": len(found), "n_base": len(starts),
                        "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                        "base_labels": ",".join(sorted(by_label)),
                        "labels": ",".join(sorted({*by_label, *(x for x, _, _ in matched)})),
                        "score": 1.0 if starts else max(shares, default=0.0),
                        "places": [{"label": x, "first_word": max(0, at), "share": s} for x, at, s in matched]})
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
