"""Repair of conversation structure by weighted CYK interval parsing.

A repaired conversation is empty, or has an optional system turn and then pairs of a user and an
assistant turn. Turns may be kept (K), get the role user or assistant (R), be deleted (D), or be inserted
with an empty text (I). The repair grammar is in Chomsky normal form: a nonterminal ``[p q]`` stands for
a span of turns whose edits lead from place p to place q of that pattern, ``[p r] -> [p q] [q r]`` joins
neighbouring spans, and ``[p q] -> turn`` is one edit. A cell holds, for each nonterminal, the least
(cost, audit), the audit being the initials of the edits. Every cell is closed under insertion before
and after its turns.

Cells are combined bottom-up by span length. Any cut of a span gives the same cell, because a derivation
passes through one place of the pattern at each boundary and equally cheap audits of a span are never
beginnings of each other; so only spans of length 1, 2, 4, ... and the rests that join them are filled,
not all n * n. For the same reason a conversation may be parsed in pieces: turns are ordered by a range
sort, each task parses the pieces that fell to it, and the pieces' cells are joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.session import materialise

#: Places of the pattern: 0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after a pair.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
START, ENDS = 0, (0, 3)
ROLES = {"s": "system", "u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3

_PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or q > 1 or (p, q) == (0, 1)]
_NUMBER = {pair: i for i, pair in enumerate(_PAIRS)}
_RULES = [(_NUMBER[p, r], _NUMBER[p, q], _NUMBER[q, r]) for p, q in _PAIRS for x, r in _PAIRS if x == q]
Cell = tuple  # for each pair of _PAIRS: (cost, audit) or None


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    best: list = [None] * len(_PAIRS)
    for whole, first, second in _RULES:
        a, b = left[first], right[second]
        if a is None or b is None:
            continue
        cost, old = a[0] + b[0], best[whole]
        if old is None or cost < old[0]:
            best[whole] = (cost, a[1] + b[1])
        elif cost == old[0]:
            best[whole] = (cost, min(old[1], a[1] + b[1]))
    return tuple(best)


def _cell(edits: dict) -> Cell:
    return tuple(edits.get(pair) for pair in _PAIRS)


def _closure() -> Cell:
    """Cell of the empty span: insertions alone, closed under repetition."""
    once = _cell({(p, p): (0, "") for p in range(4)} | {(p, q): (INSERT, "I") for (p, role), q in STEPS.items() if role != "s"})
    while (more := joined(once, once)) != once:
        once = more
    return once


INSERTIONS = _closure()


@lru_cache(maxsize=4096)
def turn_cell(initial: str, fault: int) -> Cell:
    """Cell of a single turn."""
    edits = {(p, p): (DELETE, "D") for p in range(4)}
    if fault not in (BLANK, DUPLICATE):
        more = UNFINISHED if fault == TRUNCATED else 0
        for (p, role), q in STEPS.items():
            if role == initial:
                edits[p, q] = (more, "K")
            elif role != "s":
                edits[p, q] = (more + REROLE, "R")
    return joined(joined(INSERTIONS, _cell(edits)), INSERTIONS)


class Chart:
    """Cells of adjacent spans whose lengths fall by powers of two; equal neighbours are joined at once."""

    def __init__(self):
        self._spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        size = 1
        while self._spans and self._spans[-1][0] == size:
            cell = joined(self._spans.pop()[1], cell)
            size *= 2
        self._spans.append((size, cell))

    def whole(self) -> Cell:
        if not self._spans:
            return INSERTIONS
        cell = self._spans[-1][1]
        for _, left in reversed(self._spans[:-1]):
            cell = joined(left, cell)
        return cell


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the best repair of a conversation."""
    return min(cell[_NUMBER[START, end]] for end in ENDS if cell[_NUMBER[START, end]] is not None)


def new_roles(audit: str) -> Iterator[tuple[str, str]]:
    """(edit, role that the pattern has there or '' for a deletion) in order."""
    length, at = len(audit) - audit.count("D"), 0
    for edit in audit:
        if edit == "D":
            yield edit, ""
            continue
        yield edit, "s" if length % 2 and not at else "ua"[(at - length % 2) % 2]
        at += 1


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" "))


def _marks(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the hashes that settle ties and equality."""
    plain = turns.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))
    return plain.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(7), "role", F.length("text"), "text")})


_ORDER = ["conv_id", "turn", "role", "h", "g"]  # ascending, so nulls come first


def faulty_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (ascending in the order of turns), piece, turn, initial and fault of every turn; stored.

    Turns of a conversation are ordered by turn (nulls first), role, then hashes of the text. A turn is a
    duplicate if another with its role and text comes earlier. Texts stay where they are: flags and 128 bits
    of hashes of role and text are moved.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    slim = _marks(turns).select("conv_id", "turn", F.xxhash64("role").alias("r"), F.col("role").substr(1, 1).alias("initial"), "role", "h", "g", blank.alias("blank"), ended.alias("ended"))
    tie = F.monotonically_increasing_id()
    dealt = slim.withColumn("tie", tie).repartitionByRange(*_ORDER, "tie").sortWithinPartitions(*_ORDER, "tie")
    placed = materialise(dealt.withColumn("pos", F.monotonically_increasing_id()).drop("tie", "role"))
    firsts = placed.groupBy("conv_id", "r", "h", "g").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(NO_FAULT)
    piece = F.shiftright("pos", 33)  # the range that holds the turn
    return placed.join(firsts, "pos", "left").select("conv_id", "pos", piece.alias("piece"), "turn", "initial", fault.alias("fault"))


def streamed(df: DataFrame, groups: list[str], order: list, start: Callable, schema: pa.Schema, ddl: str, rows: int = 2000) -> DataFrame:
    """Run a fold over the rows of each group, in order, without holding a group.

    ``start(key)`` gives an object with ``add(row)`` and ``end()``, both of which return the rows to put out.
    Keys are compared as values, so rows of a null key are a group.
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fold, out = None, None, []

        def ready() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return batch

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for values in zip(*columns, strict=True):
                row = dict(zip(names, values, strict=True))
                mine = tuple(row[g] for g in groups)
                if fold is None or mine != key:
                    if fold is not None:
                        out.extend(fold.end())
                    key, fold = mine, start(mine)
                out.extend(fold.add(row))
                if len(out) >= rows:
                    yield ready()
        if fold is not None:
            out.extend(fold.end())
        if out:
            yield ready()

    return df.repartition(*groups).sortWithinPartitions(*groups, *order).mapInArrow(run, ddl)


class _Piece:
    """Parse of the turns of one conversation that lie in one range."""

    def __init__(self, key: tuple):
        self._key, self._chart, self._initials = key, Chart(), ("", "")
        self._faults, self._illegal, self._turns, self._distinct = [0, 0, 0, 0], 0, (None, None), 0

    def add(self, row: dict) -> list:
        initial, fault, turn = row["initial"], row["fault"], row["turn"]
        self._chart.add(turn_cell(initial, fault))
        self._faults[fault] += 1
        first, last = self._initials
        if sum(self._faults) > 1:
            self._illegal += last + initial not in LEGAL
        self._initials = (first if sum(self._faults) > 1 else initial, initial)
        if turn is not None:
            low, high = self._turns
            self._distinct += turn != high
            self._turns = (turn if low is None else low, turn)
        return []

    def end(self) -> list:
        cell = self._chart.whole()
        return [{
            "conv_id": self._key[0], "piece": self._key[1], "blank": self._faults[BLANK], "duplicate": self._faults[DUPLICATE], "truncated": self._faults[TRUNCATED],
            "illegal": self._illegal, "first": self._initials[0], "last": self._initials[1], "low": self._turns[0], "high": self._turns[1], "distinct": self._distinct,
            "costs": [c and c[0] for c in cell], "audits": [c and c[1] for c in cell],
        }]


_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("piece", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("distinct", pa.int64()),
    ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
])
_PIECE_DDL = (
    "conv_id bigint, piece bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
    "low bigint, high bigint, distinct bigint, costs array<bigint>, audits array<string>"
)


class _Pieces:
    """Join of the pieces of one conversation."""

    def __init__(self, key: tuple):
        self._key, self._chart, self._sums, self._last, self._low, self._high, self._distinct = key, Chart(), [0, 0, 0, 0], None, None, None, 0

    def add(self, row: dict) -> list:
        self._chart.add(tuple(None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)))
        own = [row[k] for k in ("blank", "duplicate", "truncated", "illegal")]
        if self._last is not None:
            own[3] += self._last + row["first"] not in LEGAL
        self._sums = [a + b for a, b in zip(self._sums, own, strict=True)]
        self._last = row["last"]
        if row["low"] is not None:
            self._distinct += row["distinct"] - (row["low"] == self._high)
            self._low, self._high = row["low"] if self._low is None else self._low, row["high"]
        return []

    def end(self) -> list:
        cost, audit = cheapest(self._chart.whole())
        gaps = 0 if self._low is None else self._high - self._low + 1 - self._distinct
        blank, duplicate, truncated, illegal = self._sums
        return [{"conv_id": self._key[0], "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "cost": cost, "audit": audit}]


_PLAN = pa.schema([(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])


def repair_plan(turns: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``turns`` has conv_id, turn, role and text; other columns are not read. A null role or text counts as one
    space, turns with a null conv_id are a conversation, null turns come first and leave gaps alone; repeated
    turns are duplicates; turns of one number are ordered by role, then by a hash of the text; a conversation
    of faulty turns alone is deleted; an empty table gives no rows.
    """
    parsed = streamed(faulty_turns(turns), ["conv_id", "piece"], ["pos"], _Piece, _PIECE, _PIECE_DDL)
    ddl = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    return streamed(parsed, ["conv_id"], ["piece"], _Pieces, _PLAN, ddl)


class _Edits:
    """The edits of one conversation, applied to its turns as they come."""

    def __init__(self, key: tuple):
        self._key, self._edits, self._next, self._at = key, iter(()), None, 0

    def _out(self, edit: str, role: str, text: str) -> dict:
        self._at += 1
        return {"conv_id": self._key[0], "at": self._at - 1, "role": role, "text": text, "edit": edit}

    def add(self, row: dict) -> list:
        if row["audit"] is not None:
            self._edits = new_roles(row["audit"])
            return []
        out = []
        for edit, role in self._edits:
            if edit == "I":
                out.append(self._out(edit, ROLES[role], ""))
                continue
            if edit != "D":
                out.append(self._out(edit, row["role"] if edit == "K" else ROLES[role], row["text"]))
            break
        return out

    def end(self) -> list:
        return [self._out(edit, ROLES[role], "") for edit, role in self._edits]


_TURN = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def repaired_turns(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """The turns after the edits of ``plan``: conv_id, at (from 0), role, text, edit.

    Each conversation passes through one task turn by turn; its turns follow each other in the result.
    """
    edits = plan.select("conv_id", "audit", *[F.lit(None).cast(t).alias(n) for n, t in (("turn", "bigint"), ("role", "string"), ("text", "string"), ("h", "bigint"), ("g", "bigint"))])
    both = edits.unionByName(_marks(turns).withColumn("audit", F.lit(None).cast("string")))
    order = [F.col("audit").isNull(), *_ORDER[1:]]
    return streamed(both, ["conv_id"], order, _Edits, _TURN, "conv_id bigint, at bigint, role string, text string, edit string")


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of the lines ``role:text`` of its turns, from a result of ``repaired_turns`` as it stands."""
    schema = pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for conv, at, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "at", "role", "text")], strict=True):
                if at == 0:
                    if state is not None:
                        done.append({"conv_id": key, "sha256": state.hexdigest()})
                    key, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": key, "sha256": state.hexdigest()}], schema=schema)

    return repaired.mapInArrow(run, "conv_id bigint, sha256 string")
