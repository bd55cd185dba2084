"""Repair of conversation structure by a generalised LR parser.

The grammar of roles is ``C -> e | P | s P``, ``P -> u a | P u a``: perhaps a
system message, then pairs of user and assistant.  A conversation is repaired
by the cheapest edits of its rows (keep, delete, rerole, insert) that the
grammar accepts, of equally cheap ones by those whose initials (their audit)
come first.

The parser is generalised: all edits of all rows are tried on a graph of
stacks, whose nodes are stack tops, and equal tops are merged by least (cost,
audit).  What a top accepts doesn't depend on what lies below it, since the
grammar is regular, so the one that is kept is as good as any merged into it.
So a row's work doesn't grow with the rows before it.

Audits are compared without being built.  Nodes stand behind a row's own edit,
so no audit of a layer begins another one, and two audits compare as the ranks
of the nodes they come from or, from the same node, as the edits added.  Only
the choices are kept, a few bytes a row; the digest of the repaired text is
carried along each node.  Conversations are sorted by Spark and read as a
stream, so that a task holds no conversation's texts whatever their number
(one conversation's digest can't be split, as SHA-256 goes over its whole
text).  Repeats are found before, by an aggregate of (conversation, role, text)
that is combined on the map side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What edits cost; a truncated row that isn't deleted costs 1 more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}          # rows can be reroled to these, and inserted with them

_GRAMMAR = [("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua")]

RESULT = ("conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _stacks() -> tuple[list[int], dict[tuple[int, str], int], set[int]]:
    """The stacks that the grammar's LR(0) automaton can hold between two rows:
    the number of each one's top, the shifts between them (with the reductions
    that follow), and the stacks at which a conversation may end."""
    def closure(items: set) -> frozenset:
        todo = list(items)
        for rule, dot in todo:
            ahead = _GRAMMAR[rule][1][dot:dot + 1]
            todo += [x for n, (name, _) in enumerate(_GRAMMAR) if name == ahead and (x := (n, 0)) not in todo]
        return frozenset(todo)

    def go(state: frozenset, symbol: str) -> frozenset:
        return closure({(r, d + 1) for r, d in state if _GRAMMAR[r][1][d:d + 1] == symbol})

    def reduced(stack: tuple) -> tuple:
        for rule, dot in stack[-1]:
            name, body = _GRAMMAR[rule]
            if name == "P" and dot == len(body):
                below = stack[:-dot]
                return reduced((*below, go(below[-1], name)))
        return stack

    stacks, shifts = [(closure({(r, 0) for r, (name, _) in enumerate(_GRAMMAR) if name == "C"}),)], {}
    for stack in stacks:
        for symbol in "sua":
            if state := go(stack[-1], symbol):
                after = reduced((*stack, state))
                if after not in stacks:
                    stacks.append(after)
                shifts[stacks.index(stack), symbol] = stacks.index(after)
    states = list(dict.fromkeys(s[-1] for s in stacks))
    ends = {k for k, s in enumerate(stacks) if any((r, len(body)) in s[-1] for r, (name, body) in enumerate(_GRAMMAR) if name == "C")}
    return [states.index(s[-1]) for s in stacks], shifts, ends


_TOP, _SHIFTS, _ENDS = _stacks()
_MOST_INSERTS = 3        # as many pass every top that inserts can reach; more are never cheapest


def _ways(stack: int) -> list[tuple[str, int]]:
    """The initials of messages that can be inserted at a stack, and the stack they lead to."""
    ways, paths = [], [("", stack)]
    for _ in range(_MOST_INSERTS + 1):
        ways += paths
        paths = [(p + c, _SHIFTS[at, c]) for p, at in paths for c in ROLES if (at, c) in _SHIFTS]
    return ways


_EDITS = ["I" * n + edit for n in range(_MOST_INSERTS + 1) for edit in ("D", "K", "R")]
#: By stack and a row's initial (all others: ""): cost, edits (a number of _EDITS), inserted roles, the row's new role or None, stack after.
_MOVES = {(stack, initial): [
    (INSERT * len(way) + cost, _EDITS.index("I" * len(way) + edit), way, role if edit == "R" else None, _SHIFTS[at, role])
    for way, at in _ways(stack)
    for edit, role, cost in [*([("K", initial, KEEP)] if initial else []), *(("R", c, REROLE) for c in ROLES)]
    if (at, role) in _SHIFTS] for stack in range(len(_TOP)) for initial in ("s", "u", "a", "")}
_LAST = {stack: [(INSERT * len(way), way) for way, at in _ways(stack) if at in _ENDS] for stack in range(len(_TOP))}


class Parser:
    """The cheapest repair of one conversation, row by row.

    A node is (cost, rank of its audit in the layer, stack, digest of the
    repaired text so far).
    """

    def __init__(self):
        self._nodes = [(0, 0, 0, None)]
        self._choices = bytearray()          # a layer's nodes: edits and number of the node before, a byte each
        self._width = len(set(_TOP))

    @staticmethod
    def _add(digest, pieces: list[str]):
        """A digest with further lines; the old one stays as it is."""
        for piece in pieces:
            digest, lead = (hashlib.sha256(), "") if digest is None else (digest.copy(), "\n")
            digest.update((lead + piece).encode())
        return digest

    def row(self, role: str, text: str, lost: bool, truncated: bool) -> None:
        """``lost`` rows can only be deleted."""
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        extra = TRUNCATED if truncated else 0
        best: dict[int, tuple] = {}
        for k, (cost, rank, stack, _) in enumerate(self._nodes):
            tried = [(cost + DELETE, rank, _EDITS[0], 0, k, "", None, stack)]
            if not lost:
                tried += [(cost + c + extra, rank, _EDITS[e], e, k, way, new, after)
                          for c, e, way, new, after in _MOVES[stack, initial]]
            for x in tried:
                top = _TOP[x[-1]]
                if top not in best or x[:3] < best[top][:3]:
                    best[top] = x
        layer = []
        for rank, (cost, _, _, e, k, way, new, stack) in enumerate(sorted(best.values(), key=lambda x: x[1:3])):
            digest = self._nodes[k][3]
            if e:
                digest = self._add(digest, [*(f"{ROLES[c]}:" for c in way), f"{ROLES[new] if new else role}:{text}"])
            layer.append((cost, rank, stack, digest))
            self._choices.append(e * self._width + k)
        self._choices.extend(bytes(self._width - len(layer)))
        self._nodes = layer

    def finish(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the repaired conversation."""
        cost, _, way, k = min((cost + c, (rank, "I" * len(way)), way, k) for k, (cost, rank, stack, _) in enumerate(self._nodes)
                              for c, way in _LAST[stack])
        digest = self._add(self._nodes[k][3], [f"{ROLES[c]}:" for c in way]) or hashlib.sha256()
        edits = ["I" * len(way)]
        for at in range(len(self._choices) - self._width, -1, -self._width):
            e, k = divmod(self._choices[at + k], self._width)
            edits.append(_EDITS[e])
        return cost, "".join(reversed(edits)), digest.hexdigest()


class _Conversation:
    """The counts of one conversation's rows, in order, and their repair."""

    def __init__(self):
        self._parser = Parser()
        self._turns, self._least, self._last = 0, None, None
        self._before: tuple | None = None
        self._blank = self._duplicate = self._truncated = self._illegal = 0

    def row(self, turn: int | None, role: str, text: str, key: str, repeated: bool) -> None:
        if turn is not None and turn != self._last:
            self._turns, self._last = self._turns + 1, turn
            self._least = turn if self._least is None else self._least
        said = text.rstrip(" \t\n\v\f\r")
        blank = not said
        duplicate = not blank and (repeated or self._before == (turn, role, key))
        truncated = not blank and not duplicate and said[-1] not in ".!?"
        self._blank += blank
        self._duplicate += duplicate
        self._truncated += truncated
        if self._before is not None:
            self._illegal += (self._before[1][:1] + role[:1]) not in ("su", "ua", "au")
        self._before = (turn, role, key)
        self._parser.row(role, text, blank or duplicate, truncated)

    def result(self) -> tuple:
        gaps = self._last - self._least + 1 - self._turns if self._turns else 0
        return (gaps, self._blank, self._duplicate, self._truncated, self._illegal, *self._parser.finish())


def repair(rows: DataFrame, present: str | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, faults, and the cheapest repair.

    ``rows`` have conv_id, turn, role and text, and perhaps a column that
    ``present`` names: a row where it is false is no row of its conversation,
    which is named all the same.  A null role or text is one blank; rows with
    a null conv_id are one conversation.  The order is that of turns, nulls
    first; rows of one turn go by role, then text.  Repeated rows are
    duplicates; other columns aren't read.  A row's first fault counts: blank,
    duplicate (role and text stand in an earlier row), truncated (its last
    visible character isn't one of ``.!?``).  Blank rows and duplicates are
    deleted.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    said = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"),
                       (F.col(present) if present else F.lit(True)).alias("present")) \
        .withColumn("key", F.sha2("text", 256))
    first = said.where("present").groupBy(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("key").alias("as")) \
        .agg(F.min(F.struct("turn")).alias("first"))
    marked = said.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("key") == F.col("as")), "left") \
        .select("conv_id", "present", "turn", "role", "text", "key",
                (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("repeated"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Conversation | None = None
        name, done = None, []

        def out() -> pa.RecordBatch:
            ids, results = zip(*done, strict=True) if done else ((), ())
            columns = list(zip(*results, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[x.split()[0] for x in RESULT.split(", ")])

        id_type = pa.null()
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "present", "turn", "role", "text", "key", "repeated"))
            for conv_id, there, *row in zip(*columns, strict=True):
                if current is None or conv_id != name:
                    if current is not None:
                        done.append((name, current.result()))
                    current, name = _Conversation(), conv_id
                if there:
                    current.row(*row)
            yield out()
        if current is not None:
            done.append((name, current.result()))
            yield out()

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return marked.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(parse, RESULT.format(kind=kind))


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and present of the rows, with planted faults.

    By the crc32 of ``conv_id:turn`` (a null: one blank) modulo 20: 0 drops the
    row (present is false), 1 empties its text, 2 removes ``.!?`` from it, 3
    repeats the row, 4 makes its role user.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", "role", "text", fault.alias("fault")).select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("fault") == 3, 1).otherwise(0))).alias("copy")).drop("copy")
