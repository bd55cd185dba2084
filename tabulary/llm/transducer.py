"""Token counts by a compiled finite-state transducer.

A BPE vocabulary with word ends is compiled into a deterministic transducer
over the bytes of a word.  A state holds the longest suffix read so far that
begins some token, the last token of each prefix inside that suffix, and how
many tokens each of those prefixes has compared with the longest; that is all
the next byte can depend on, and it is bounded by the longest token.  A
transition carries the change in the number of tokens.  States and
transitions are made when a text first takes them.

A chunk of text is a map from the state before it to the state behind it and a
count.  White space puts the machine back to its start, so the map of a chunk
with white space is constant but for its head, the part before the first white
space, and leaves a tail, the part behind the last.  Maps compose
associatively; a document's count is the composition of its chunks' maps, which
tasks make independently.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulary.llm.common import held, in_slices

#: The vocabulary writes each byte as one character: itself where visible, else from U+0100 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
_CHAR = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + k) for k, b in enumerate(_HIDDEN)}

_NONE = -1


class Transducer:
    """The machine of one vocabulary; ``most`` bounds the states kept."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str,
                 most: int = 400_000):
        byte = {c: b for b, c in _CHAR.items()}
        self._suffix, self._most = suffix, most
        self._order = {tuple(m): k for k, m in enumerate(merges)}
        self._inner: dict[bytes, str] = {}       # tokens inside a word, and at its end
        self._final: dict[bytes, str] = {}
        self._begins: set[bytes] = set()
        for name in vocab:
            core, kind = (name[:-len(suffix)], self._final) if name.endswith(suffix) else (name, self._inner)
            if core and all(c in byte for c in core):
                data = bytes(byte[c] for c in core)
                kind[data] = name
                self._begins.update(data[:k] for k in range(1, len(data)))
        self._fits: dict[tuple[str, str], bool] = {}
        self._spine: dict[str, tuple[list, list] | None] = {}
        self._clear()

    def _clear(self) -> None:
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._step: list[dict[int, tuple[int, int]]] = []
        self._stop: list[dict[int, int]] = []
        self.start = self._state((b"", (_NONE,), (0,)))

    def _state(self, key: tuple) -> int:
        at = self._ids.get(key)
        if at is None:
            at = self._ids[key] = len(self._states)
            self._states.append(key)
            self._step.append({})
            self._stop.append({})
        return at

    def _symbols(self, token: str) -> list[str]:
        core, end = (token[:-len(self._suffix)], self._suffix) if token.endswith(self._suffix) else (token, "")
        return [*core[:-1], core[-1] + end]

    def merge(self, symbols: list[str]) -> tuple[list[str], list[int]]:
        """Plain merging, lowest rank first; the ranks of the merges made."""
        parts, made = list(symbols), []
        while len(parts) > 1:
            best, at = min((self._order.get((parts[i], parts[i + 1]), 1 << 40), i)
                           for i in range(len(parts) - 1))
            if best == 1 << 40:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            made.append(best)
        return parts, made

    def _spines(self, token: str) -> tuple[list, list] | None:
        """The tokens that stand first and last while ``token`` is merged,
        with the rank at which each comes up; None if that isn't in order."""
        if token not in self._spine:
            symbols, found = self._symbols(token), None
            if len(symbols) == 1:
                found = [(-1, token)], [(-1, token)]
            else:
                parts, made = self.merge(symbols)
                if parts == [token] and made == sorted(made):
                    left = next(k for k in range(1, len(token)) if self._order.get((token[:k], token[k:])) == made[-1])
                    of = [self._spines(t) for t in (token[:left], token[left:])]
                    if all(of):
                        found = [*of[0][0], (made[-1], token)], [*of[1][1], (made[-1], token)]
            self._spine[token] = found
        return self._spine[token]

    def _stays(self, left: str, right: str) -> bool | None:
        a, b = self._spines(left), self._spines(right)
        if a is None or b is None:
            return None
        a, b, i, j = a[1], b[0], 0, 0
        while True:
            until_a = a[i + 1][0] if i + 1 < len(a) else 1 << 40
            until_b = b[j + 1][0] if j + 1 < len(b) else 1 << 40
            across = self._order.get((a[i][1], b[j][1]))
            if across is not None:
                if across < max(a[i][0], b[j][0]):
                    return None
                if across < until_a and across <= until_b:
                    return False
            if until_a == until_b == 1 << 40:
                return True
            i, j = i + (until_a <= until_b), j + (until_b <= until_a)

    def fits(self, left: str | int, right: str) -> bool:
        """Whether merging the two tokens' symbols gives the two again."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= self._most:
                self._fits.clear()
            known = None if left == _NONE else self._stays(left, right)
            if known is None:
                both = [right] if left == _NONE else [left, right]
                known = self.merge([s for t in both for s in self._symbols(t)])[0] == both
            self._fits[left, right] = known
        return known

    def _last(self, state: tuple, byte: int, tokens: dict[bytes, str]) -> tuple[bytes, str, int]:
        """What has been read, the token that ends there, and the tokens up to
        it compared with those before the byte."""
        suffix, last, more = state
        read = suffix + bytes([byte])
        for at in range(len(suffix), -1, -1):
            token = tokens.get(read[at:])
            if token is not None and self.fits(last[at], token):
                return read, token, more[at] + 1
        raise ValueError(f"no token ends in {read!r}")

    def step(self, at: int, byte: int) -> tuple[int, int]:
        """The state after a byte inside a word, and the change of the count."""
        found = self._step[at].get(byte)
        if found is None:
            state = self._states[at]
            read, token, delta = self._last(state, byte, self._inner)
            last = (*state[1], token)
            more = (*(n - delta for n in state[2]), 0)
            skip = 0
            while skip < len(read) and read[skip:] not in self._begins:
                skip += 1
            found = self._step[at][byte] = self._state((read[skip:], last[skip:], more[skip:])), delta
        return found

    def stop(self, at: int, byte: int) -> int:
        """The change of the count by the last byte of a word."""
        found = self._stop[at].get(byte)
        if found is None:
            found = self._stop[at][byte] = self._last(self._states[at], byte, self._final)[2]
        return found

    def count(self, word: bytes) -> int:
        if len(self._states) > self._most:
            self._clear()
        at, n = self.start, 0
        for byte in word[:-1]:
            at, delta = self.step(at, byte)
            n += delta
        return n + self.stop(at, word[-1]) if word else 0


class Counter:
    """Token counts of a tokenizer file: added tokens are cut out first, then
    NFC, lower case and the file's pattern, then the transducer."""

    def __init__(self, path: str, most: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.machine = Transducer(model["vocab"], map(tuple, model["merges"]), model["end_of_word_suffix"])
        splits = spec["pre_tokenizer"]["pretokenizers"]
        self._find = regex.compile(splits[0]["pattern"]["Regex"]).findall
        added = [t["content"] for t in spec["added_tokens"]]
        self._added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
        self._most = most
        self._chunks: dict[str, int] = {}
        self._words: dict[str, int] = {}

    def _word(self, word: str) -> int:
        n = self._words.get(word)
        if n is None:
            n = self.machine.count(word.encode())
            if len(word) <= 64:
                if len(self._words) >= self._most:
                    self._words.clear()
                self._words[word] = n
        return n

    def chunk(self, chunk: str) -> int:
        """Tokens of a text between white space."""
        n = 0
        for k, part in enumerate(self._added.split(chunk)):
            n += k > 0
            # the library lowers each character by itself, so a final sigma too
            low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            n += sum(map(self._word, self._find(low)))
        return n

    def chunks(self, texts: list[list[str]]) -> list[int]:
        """Tokens of each list of parts between white space."""
        known, seen = self._chunks, set()
        for words in texts:
            seen.update(words)
        new = seen.difference(known)
        if len(known) + len(new) > self._most:
            known.clear()
            new = seen
        known.update((w, self.chunk(w)) for w in new)
        return [sum(map(known.__getitem__, words)) for words in texts]

    def maps(self, texts: list[str]) -> list[tuple[str, int | None, str]]:
        """The map of each chunk of text: its head, the tokens of what stands
        between head and tail (None: the chunk has no white space and is all
        head), its tail."""
        parts = list(map(split, texts))
        inside = self.chunks([p[1:-1] for p in parts])
        return [(p[0], n, p[-1]) if len(p) > 1 else (p[0], None, "")
                for p, n in zip(parts, inside, strict=True)]

    def compose(self, maps: Iterable[tuple[str, int | None, str]]) -> int:
        """Tokens of a text from its chunks' maps, in order."""
        n, open_parts = 0, []
        for head, inside, tail in maps:
            open_parts.append(head)
            if inside is not None:
                word = "".join(open_parts)
                n += self._alone(word) + inside
                open_parts = [tail]
        word = "".join(open_parts)
        return n + self._alone(word)

    def _alone(self, word: str) -> int:
        if not word:
            return 0
        n = self._chunks.get(word)
        return self.chunk(word) if n is None else n


#: Python takes these for white space, the tokenizer's pattern doesn't.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SPACE = regex.compile(r"\s+")


def split(text: str) -> list[str]:
    """A text's parts between white space; the first and last may be empty."""
    if any(c in text for c in _SEPARATORS):
        return _SPACE.split(text)
    words = text.split()
    if not words:
        return ["", ""] if text else [""]
    if text[0].isspace():
        words.insert(0, "")
    if text[-1].isspace():
        words.append("")
    return words


def counter(path: str) -> Counter:
    return held(("counter", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, chunk_chars: int = 1 << 16) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text is an empty one, with no tokens.  Texts are cut into chunks of
    ``chunk_chars`` characters, the tasks make the chunks' maps, and the maps of
    a document are composed in order; only maps are shuffled.  Repeated rows
    give repeated results, also rows that share a doc_id but not the text.
    """
    text = F.coalesce("text", F.lit(""))
    chunks = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                F.xxhash64("text").alias("key"),
                F.posexplode(F.transform(
                    F.sequence(F.lit(0), F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / chunk_chars)),
                    lambda k: F.when(F.length("text") <= chunk_chars, F.col("text"))
                    .otherwise(F.substring("text", (k * chunk_chars + 1).cast("int"), F.lit(chunk_chars))))
                ).alias("k", "text")))

    def to_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(path)
        for batch in batches:
            for texts, part in in_slices(batch):
                head, inside, tail = zip(*machine.maps(texts), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "n_bytes", "key", "k")]
                    + [pa.array(head, pa.string()), pa.array(inside, pa.int64()), pa.array(tail, pa.string())],
                    ["doc_id", "n_bytes", "key", "k", "head", "inside", "tail"])

    maps = chunks.select("doc_id", "n_bytes", "key", "k", "text").mapInArrow(
        to_map, "doc_id long, n_bytes long, key long, k int, head string, inside long, tail string")
    per_doc = (
        maps.groupBy("doc_id", "key", "n_bytes")
        .agg(F.sort_array(F.collect_set(F.struct("k", "head", "inside", "tail"))).alias("maps"),
             F.count(F.when(F.col("k") == 0, 1)).alias("copies")))

    def to_count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(path)
        for batch in batches:
            counts = [machine.compose((m["head"], m["inside"], m["tail"]) for m in maps)
                      for maps in batch.column("maps").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64()),
                 batch.column("copies")], ["doc_id", "n_bytes", "n_tokens", "copies"])

    return (
        per_doc.select("doc_id", "n_bytes", "maps", "copies")
        .mapInArrow(to_count, "doc_id long, n_bytes long, n_tokens long, copies long")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
                F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .drop("copy"))
