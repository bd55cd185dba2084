"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Every prefix of a byte string has exactly one encoding, so exactly one token
can come last in it.  That token is stored for each prefix: it is the only one
that ends there and *fits* behind the last token of the prefix before it,
where two tokens fit if merging their joined bytes gives the two again.  The
table grows by appending bytes without a change to what it holds, and an edit
at byte ``i`` leaves the entries before ``i`` as they are.

A text is split by the tokenizer's pattern and each match is encoded on its
own; a match that is a token as a whole is that token, as in the library.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tabulary.llm.common import ChunkCache, held, in_slices

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Ranks:
    """A rank file: token bytes and their merge ranks."""

    def __init__(self, lines: Iterable[bytes], most_pairs: int = 100_000):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = dict(map(reversed, self.rank.items()))
        self._most = most_pairs
        self._fits: dict[tuple[int, int], bool] = {}
        self._spines: dict[int, tuple[list, list] | None] = {}
        self.longest = [1] * 256                 # of the tokens that end in a byte
        for t in self.rank:
            self.longest[t[-1]] = max(self.longest[t[-1]], len(t))

    def merge(self, data: bytes, below: int = 1 << 40) -> list[int]:
        """Plain merging of the pairs that rank under ``below``, lowest rank
        first; for the few bytes of one or two tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.rank.get(parts[i] + parts[i + 1], below), i)
                           for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def spines(self, token: int) -> tuple[list, list] | None:
        """The tokens that stand first, and those that stand last, while the
        bytes of ``token`` are merged, each with the rank at which it comes
        up.  None if merging takes another way or isn't in order of rank."""
        if token not in self._spines:
            data, found = self.token[token], None
            if len(data) == 1:
                found = [(-1, data)], [(-1, data)]
            elif len(parts := self.merge(data, token)) == 2 and self.merge(data) == [token]:
                of = [self.spines(t) for t in parts]
                if all(of) and all(len(self.token[t]) == 1 or t < token for t in parts):
                    found = [*of[0][0], (token, data)], [*of[1][1], (token, data)]
            self._spines[token] = found
        return self._spines[token]

    def _stays(self, left: int, right: int) -> bool | None:
        """Whether no pair across the border is merged before its parts are
        used up inside; None: in doubt."""
        a, b = self.spines(left), self.spines(right)
        if a is None or b is None:
            return None
        a, b, i, j = a[1], b[0], 0, 0
        while True:
            until_a = a[i + 1][0] if i + 1 < len(a) else 1 << 40
            until_b = b[j + 1][0] if j + 1 < len(b) else 1 << 40
            across = self.rank.get(a[i][1] + b[j][1])
            if across is not None:
                if across < max(a[i][0], b[j][0]):
                    return None
                if across < until_a and across <= until_b:
                    return False
            if until_a == until_b == 1 << 40:
                return True
            i, j = (i + (until_a <= until_b), j + (until_b <= until_a))

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` (-1: can come first)."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= self._most:
                self._fits.clear()
            known = None if left < 0 else self._stays(left, right)
            if known is None:
                both = [right] if left < 0 else [left, right]
                known = self.merge(b"".join(self.token[t] for t in both)) == both
            self._fits[left, right] = known
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fill ``last`` up to ``data``: ``last[i]`` is the last token of
        ``data[:i + 1]``; entries that are there already are kept."""
        rank, fits, longest = self.rank.get, self._fits.get, self.longest
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(end - 1, max(0, end - longest[data[end - 1]]) - 1, -1):
                token = rank(data[start:end])
                if token is None:
                    continue
                left = last[start - 1] if start else -1
                ok = fits((left, token))
                if ok or ok is None and self.fits(left, token):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end} of {data[:end]!r}")
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The encoding of the bytes whose prefix table is ``last``."""
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.token[ids[-1]])
        return ids[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        return [whole] if whole is not None else self.walk(self.extend(piece, []))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PieceTables:
    """Prefix tables of many pieces at once, in numpy.

    All pieces take one byte further together.  Substrings that end there are
    looked up by a polynomial hash of their bytes, shortest first, until one
    fits behind the last token of the prefix before it.  Answers of
    :meth:`Ranks.fits` are kept in a table of 2**20 slots.
    """

    _SLOTS = 20

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        rng = np.random.default_rng(1)
        longest = max(map(len, ranks.rank))
        base = int(rng.integers(1 << 62)) * 2 + 1
        self._power = np.array([pow(base, k, 1 << 64) for k in range(longest)], np.uint64)
        self._width = np.zeros(max(ranks.token) + 1, np.int64)
        hashes, ids = [], []
        with np.errstate(over="ignore"):
            for data, i in ranks.rank.items():
                self._width[i] = len(data)
                raw = np.frombuffer(data, np.uint8)[::-1].astype(np.uint64) + np.uint64(1)
                hashes.append((raw * self._power[:len(data)]).sum(dtype=np.uint64))
                ids.append(i)
        order = np.argsort(hashes)
        self._hash, self._id = np.array(hashes, np.uint64)[order], np.array(ids, np.int64)[order]
        self._longest = np.array(ranks.longest, np.int64)
        self._keys = np.full(1 << self._SLOTS, -1, np.int64)
        self._fit = np.zeros(1 << self._SLOTS, bool)

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left + 1) << 32 | right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._SLOTS)).astype(np.int64)
        out = self._fit[slot]
        unknown = np.flatnonzero(self._keys[slot] != key)
        if len(unknown):
            new, where = np.unique(key[unknown], return_inverse=True)
            known = np.array([self.ranks.fits((k >> 32) - 1, k & 0xFFFFFFFF) for k in new.tolist()], bool)
            out[unknown] = known[where]
            self._keys[slot[unknown]], self._fit[slot[unknown]] = key[unknown], out[unknown]
        return out

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit bytes."""
        if not pieces:
            return []
        sizes = np.array(list(map(len, pieces)), np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        data = np.frombuffer(b"".join(pieces[k] for k in order), np.uint8)
        first = np.cumsum(sizes) - sizes
        last = np.full(len(data), -1, np.int64)          # of the prefix that ends at each byte
        value = data.astype(np.uint64) + np.uint64(1)
        limit = self._longest[data]
        with np.errstate(over="ignore"):
            for end in range(int(sizes[0])):
                at = first[:np.searchsorted(-sizes, -end, "left")] + end
                rolled, size = np.zeros(len(at), np.uint64), 0
                while len(at):
                    rolled = rolled + value[at - size] * self._power[size]
                    size += 1
                    spot = np.minimum(np.searchsorted(self._hash, rolled), len(self._hash) - 1)
                    found = np.flatnonzero(self._hash[spot] == rolled)
                    if len(found):
                        token = self._id[spot[found]]
                        left = last[at[found] - size] if end >= size else np.full(len(found), -1)
                        good = (self._width[token] == size) & self._fits(left, token)
                        last[at[found[good]]] = token[good]
                        stay = np.ones(len(at), bool)
                        stay[found[good]] = False
                        at, rolled = at[stay], rolled[stay]
                    if len(at) and (size > end or (limit[at] <= size).any()):
                        raise ValueError("a byte at which no token ends")
        walked, which = [], []                           # from the end, a token of each piece at a time
        piece, at = np.arange(len(sizes)), first + sizes - 1
        while len(piece):
            token = last[at]
            walked.append(token)
            which.append(piece)
            at = at - self._width[token]
            on = at >= first[piece]
            piece, at = piece[on], at[on]
        ids, which = np.concatenate(walked[::-1]), np.concatenate(which[::-1])
        by_piece = np.argsort(which, kind="stable")
        raw = ids[by_piece].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(which, minlength=len(sizes)))
        out: list[bytes] = [b""] * len(pieces)
        begin = 0
        for k, stop in zip(order.tolist(), ends.tolist(), strict=True):
            out[k] = raw[begin:stop]
            begin = stop
        return out


class EncodedText:
    """A text, its pieces and their prefix tables, kept up to date under
    appends and edits.

    Pieces follow one another without context, so matching can be taken up at
    any piece's start.  An edit keeps all pieces that end before the last one
    that could see it, and all from the first old piece start behind it that
    matching reaches again.
    """

    def __init__(self, ranks: Ranks, pattern: str, text: str = ""):
        self.ranks, self._match = ranks, regex.compile(pattern)
        self.text, self.starts, self._last = "", [], []
        self.recoded = 0                         # bytes whose table entry was computed
        self.append(text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, begin: int, end: int, new: str) -> None:
        """Put ``new`` in the place of ``text[begin:end]``."""
        old = [*self.starts, len(self.text)]
        text = self.text[:begin] + new + self.text[end:]
        keep = max(0, int(np.searchsorted(old, begin, "left")) - 2)
        shift = len(new) - (end - begin)
        behind = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        starts, last = self.starts[:keep], self._last[:keep]
        at = old[keep] if keep < len(old) else 0
        while at < len(text):
            if at in behind and at >= begin + len(new):
                k = behind[at]
                starts += [s + shift for s in self.starts[k:]]
                last += self._last[k:]
                break
            m = self._match.match(text, at)
            data = m.group().encode()
            k = len(starts)
            held = []
            if k < len(self.starts) and self.starts[k] == at:   # grows or shrinks in place
                was = self.text[old[k]:old[k + 1]].encode()
                same = next((i for i, (a, b) in enumerate(zip(was, data)) if a != b),  # noqa: B905
                            min(len(was), len(data)))
                held = self._last[k][:same]
            self.recoded += len(data) - len(held)
            starts.append(at)
            last.append(self.ranks.extend(data, held))
            at = m.end()
        self.text, self.starts, self._last = text, starts, last

    def ids(self) -> list[int]:
        out: list[int] = []
        ends = [*self.starts, len(self.text)][1:]
        for s, e, last in zip(self.starts, ends, self._last, strict=True):
            whole = self.ranks.rank.get(self.text[s:e].encode())
            out += [whole] if whole is not None else self.ranks.walk(last)
        return out


class Encoder:
    """Whole texts to ids, with the encodings of common pieces kept."""

    _SHORT = 64          # bytes of a piece that is encoded with others and kept

    def __init__(self, ranks: Ranks, pattern: str, most: int = 150_000):
        self.ranks, self._find, self._most = ranks, regex.compile(pattern).findall, most
        self._tables = PieceTables(ranks)
        self._pieces: dict[str, bytes] = {}
        self._text = ChunkCache(self._chunks, self._chunks, most * 3 // 2)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        split = list(map(self._find, chunks))
        new = set().union(*split).difference(self._pieces)
        if len(self._pieces) + len(new) > self._most:
            self._pieces.clear()
            new = set().union(*split)
        rank = self.ranks.rank
        todo = []
        for piece in new:
            data = piece.encode()
            whole = rank.get(data)
            if whole is not None:
                self._pieces[piece] = whole.to_bytes(4, "little")
            elif len(data) <= self._SHORT:
                todo.append((piece, data))
            else:
                self._pieces[piece] = np.array(self.ranks.encode_piece(data), "<u4").tobytes()
        self._pieces.update(zip((p for p, _ in todo), self._tables.encode([d for _, d in todo]), strict=True))
        out = [b"".join(map(self._pieces.__getitem__, parts)) for parts in split]
        for piece in [p for p in new if len(p) > self._SHORT]:
            del self._pieces[piece]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in self._text(texts)]


def encoder(path: str, pattern: str) -> Encoder:
    def make() -> Encoder:
        with open(path, "rb") as lines:
            return Encoder(Ranks(lines), pattern)
    return held(("bpe", path, pattern), make)


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode ``text`` of every row and decode the ids again.

    Returns a row per input row: doc_id, n_tokens, the SHA-256 of the decimal
    ids joined by blanks and the SHA-256 of the decoded bytes.  A null text is
    an empty one, with no tokens; repeated rows give repeated results; columns
    other than doc_id and text play no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        token = enc.ranks.token.__getitem__
        decimal = {i: str(i) for i in enc.ranks.token}.__getitem__
        for batch in batches:
            for texts, part in in_slices(batch):
                counts, of_ids, of_bytes = [], [], []
                for ids in map(np.ndarray.tolist, enc.encode(texts)):
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(b"".join(map(token, ids))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                     pa.array(of_ids), pa.array(of_bytes)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
