"""Operator 11, repair of the structure of conversations.

The cheapest edits (keep, delete, rerole, insert) that make the roles of a
conversation read ``(s?(ua)+)?`` are a shortest path through a directed
acyclic graph of (row, state).  A path's weight is one whole number: its high
digits are the cost, its low digits spell the edits' letters, each row having
a slot of two digits (an insert before the row or none, the row's edit) that
is padded with zeros at its end.  No slot's letters are the beginning of
another's, so the smallest number is the cheapest path and, among those, the
one whose letters come first: plain integer minima decide everything.

Rows are sorted by conversation inside shuffle partitions and stream through
a task.  Per conversation it holds four numbers (one per state; digits that
all four share are moved out of them), the letters so far and four running
SHA-256 states, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import keep, small_batches

#: white space of the blank test
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3

# digits of the letters in ASCII order; zero is "no letter"
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = {d: c for c, d in _DIGIT.items()}
_BITS = 3
_SLOT = 2 * _BITS
#: rows after which digits that all states share leave the numbers
_SETTLE = 32

# states: nothing yet, after the system turn, after a user turn, after an assistant turn
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
_STEP = {
    (_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER,
}
#: the one turn that can be inserted in (or reroled to from) a state
_NEXT = {_START: "u", _SYSTEM: "u", _USER: "a", _ASSISTANT: "u"}
_NAME = {"u": "user", "a": "assistant"}
_FINAL = (_START, _ASSISTANT)


def _edges(initial: str, must_go: bool, cut_short: bool) -> list[tuple[int, int, int, int, str, str | None]]:
    """Edges of one row: (from, to, cost, slot digits, inserted role or "",
    the row's role: "" kept, None deleted).

    More than one insert before a row is never cheapest: two would lead back
    to where one can read on for less."""
    out = []
    for state in _STATES:
        for inserted in ("", _NEXT[state]):
            here = _STEP[state, inserted] if inserted else state
            price = INSERT if inserted else 0

            def edge(to, cost, letter, role, state=state, inserted=inserted, price=price):
                digits = _DIGIT["I"] << _BITS | _DIGIT[letter] if inserted else _DIGIT[letter] << _BITS
                out.append((state, to, price + cost, digits, _NAME.get(inserted, ""), role))

            edge(here, DELETE, "D", None)
            if must_go:
                continue
            more = CUT_SHORT if cut_short else 0
            if (here, initial) in _STEP:
                edge(_STEP[here, initial], KEEP + more, "K", "")
            edge(_STEP[here, _NEXT[here]], REROLE + more, "R", _NAME[_NEXT[here]])
    return out


_EDGES: dict[tuple[str, bool, bool], list] = {}


def edges(initial: str, must_go: bool, cut_short: bool) -> list:
    key = (initial if initial in "sua" else "", must_go, cut_short)
    if key not in _EDGES:
        _EDGES[key] = _edges(*key)
    return _EDGES[key]


class _Path:
    """Hash of the repaired rows so far, on the best path to a state."""

    __slots__ = ("hash", "any")

    def __init__(self, hash_=None, any_=False):
        self.hash, self.any = hash_ or hashlib.sha256(), any_

    def then(self, *rows: bytes) -> _Path:
        if not rows:
            return self
        out = _Path(self.hash.copy(), self.any)
        for row in rows:
            out.hash.update(b"\n" + row if out.any else row)
            out.any = True
        return out


class Conversation:
    """The running state of one conversation's repair."""

    def __init__(self):
        self.weight: list[int | None] = [0, None, None, None]
        self.paths: list[_Path | None] = [_Path(), None, None, None]
        self.width = 0  # low digits of the numbers, in bits
        self.settled = bytearray()  # letters that all states share, zeros left out
        self.base = 0  # cost that all states share
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.least = self.last_turn = None
        self.role = None
        self.before: tuple | None = None

    # ---------------------------------------------------------------- rows

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        """The next row; ``seen``: an earlier turn has this role and text."""
        solid = text.rstrip(BLANKS)
        same = self.before == (turn, role, text)  # the rows are sorted: equal rows of one turn lie together
        self.before = (turn, role, text)
        blank = not solid
        duplicate = not blank and (seen or same)
        cut_short = not blank and not duplicate and solid[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut_short
        initial = role[:1]
        if self.rows and (self.role + initial) not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = initial
        self.rows += 1
        if turn is not None and turn != self.last_turn:
            self.least = turn if self.least is None else self.least
            self.last_turn = turn
            self.turns += 1
        self._step(edges(initial, blank or duplicate, cut_short), role, text)
        if self.rows % _SETTLE == 0:
            self._settle()

    def _step(self, row_edges: list, role: str, text: str) -> None:
        best: list[int | None] = [None] * 4
        chosen: list = [None] * 4
        width = self.width + _SLOT
        for edge in row_edges:
            w = self.weight[edge[0]]
            if w is None:
                continue
            w = (w << _SLOT) + (edge[2] << width) + edge[3]
            if best[edge[1]] is None or w < best[edge[1]]:
                best[edge[1]], chosen[edge[1]] = w, edge
        # what is left to do after the system turn or before anything can be done after an
        # assistant turn too, but for keeping a system turn (which can be deleted instead):
        # such states go once they can't win any more, and the others soon share their digits
        full = best[_ASSISTANT]
        if full is not None:
            if best[_SYSTEM] is not None and full < best[_SYSTEM]:
                best[_SYSTEM] = chosen[_SYSTEM] = None
            if best[_START] is not None and (best[_START] >> width) > (full >> width) + DELETE:
                best[_START] = chosen[_START] = None
        data = text.encode("utf-8", "surrogatepass") if any(e is not None and e[5] is not None for e in chosen) else b""
        paths: list[_Path | None] = [None] * 4
        for state, edge in enumerate(chosen):
            if edge is None:
                continue
            rows = [f"{edge[4]}:".encode()] if edge[4] else []
            if edge[5] is not None:
                rows.append((edge[5] or role).encode("utf-8", "surrogatepass") + b":" + data)
            paths[state] = self.paths[edge[0]].then(*rows)
        self.weight, self.paths, self.width = best, paths, width

    def _settle(self) -> None:
        """Moves leading digits and the cost that all states share out of the numbers."""
        low = (1 << self.width) - 1
        costs = [None if w is None else w >> self.width for w in self.weight]
        digits = [w & low for w in self.weight if w is not None]
        differ = 0
        for d in digits[1:]:
            differ |= d ^ digits[0]
        left = -(-differ.bit_length() // _SLOT) * _SLOT  # whole slots that still differ
        if left < self.width:
            self.settled += _letters(digits[0] >> left, (self.width - left) // _BITS)
        least = min(c for c in costs if c is not None)
        self.base += least
        low = (1 << left) - 1
        self.weight = [None if w is None else (c - least) << left | (w & low) for w, c in zip(self.weight, costs, strict=True)]
        self.width = left

    # ---------------------------------------------------------------- result

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, hash."""
        # the end: stop in a final state, or insert the assistant turn that is missing
        width = self.width + _SLOT
        ends = []
        for state in _STATES:
            w = self.weight[state]
            if w is None:
                continue
            if state in _FINAL:
                ends.append((w << _SLOT, state, None))
            elif state == _USER:
                ends.append(((w << _SLOT) + (INSERT << width) + (_DIGIT["I"] << _BITS), state, b"assistant:"))
        best, state, last = min(ends, key=lambda e: e[0])
        audit = bytes(self.settled) + _letters(best & ((1 << width) - 1), width // _BITS)
        path = self.paths[state] if last is None else self.paths[state].then(last)
        gaps = 0 if self.least is None else self.last_turn - self.least + 1 - self.turns
        return (
            gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.base + (best >> width),
            audit.decode(), path.hash.hexdigest(),
        )


def _letters(digits: int, n: int) -> bytes:
    """The letters of ``n`` digits, zeros left out."""
    return "".join(_LETTER[int(c)] for c in f"{digits:0{n}o}" if c != "0").encode()  # a digit is an octal digit


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TYPES = [pa.int64()] * 7 + [pa.string()] * 2
_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, one row per conversation out."""
    at, now, out = None, None, []
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv, has_id, turn, role, text, seen, dropped in zip(*cols, strict=True):
            key = (has_id, conv)
            if key != at:
                if now is not None:
                    out.append((at[1] if at[0] else None, *now.result()))
                at, now = key, Conversation()
            if not dropped:
                now.add(turn, role, text, seen)
        if len(out) >= 1000:
            yield _batch(out)
            out = []
    if now is not None:
        out.append((at[1] if at[0] else None, *now.result()))
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES
    )


# ------------------------------------------------------------------ tables


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, dropped): the rows with nulls of role
    and text as one space, changed by the remainder of crc32(``conv_id:turn``)
    by 20: 0 drops the row (it stays here, marked), 1 empties its text, 2
    takes out ``.!?``, 3 repeats it, 4 makes it a user turn."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    rows = rows.withColumn("fate", F.crc32(name.cast("binary")) % 20)
    fate = F.col("fate")
    return rows.select(
        "conv_id", "turn",
        F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (fate == 0).alias("dropped"),
    )


def as_rows(conversations: DataFrame) -> DataFrame:
    """Like :func:`damaged`, without damage."""
    space = F.lit(" ")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.lit(0).alias("copy"), F.lit(False).alias("dropped"),
    )


def _first_turn(turn: Column) -> Column:
    """Order of turns with nulls first, as a column without nulls."""
    return F.struct(turn.isNotNull().alias("k"), F.coalesce(turn, F.lit(0)).alias("t"))


def repair(rows: DataFrame) -> DataFrame:
    """Per conv_id of ``rows`` (conv_id, turn, role, text, dropped, as
    :func:`damaged` and :func:`as_rows` give): gaps, counts of blank,
    duplicate, truncated rows (a row's first fault counts) and of illegal
    neighbours, the least cost of edits, their letters and the SHA-256 of the
    repaired ``role:text`` lines.

    Rows are taken by turn, nulls first; rows of one turn by role, then text.
    Rows marked as dropped count for nothing but their conv_id; a
    conversation of none others has zeros, no letters and the hash of the
    empty string.  A null conv_id is a conversation of its own.  A role whose
    initial is none of s, u and a (also an empty one) can't be kept, whatever
    it is; repeated rows of one turn are duplicates of the first.  An empty
    table gives no rows; further columns are not looked at.

    A conversation of any length is one stream through one task, as its hash
    asks for; what the task holds is its letters and four numbers.
    """
    small_batches(rows.sparkSession)
    rows = rows.select("conv_id", "turn", "role", "text", "dropped")
    # where a role and text come back in another turn: the first turn that has them.
    # Partial aggregates collapse a text that most rows share before the shuffle.
    print_ = F.md5(F.col("text").cast("binary"))
    shown = rows.where(~F.col("dropped") & (F.length(F.translate("text", BLANKS, "")) > 0))
    at = _first_turn(F.col("turn"))
    again = shown.groupBy(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), print_.alias("_print")
    ).agg(F.min(at).alias("_first"), F.max(at).alias("_last")).where("_first < _last").drop("_last")
    again = keep(again, "repeats")  # its size is known then: a small one is sent to the rows, not joined by a shuffle
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (print_ == F.col("_print"))
    flagged = rows.join(again, same, "left").select(
        F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNotNull().alias("has_id"), "turn", "role", "text",
        F.coalesce(F.col("_first") < at, F.lit(False)).alias("seen"), "dropped",
    )
    ordered = flagged.repartition("has_id", "conv_id").sortWithinPartitions(
        "has_id", "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return ordered.mapInArrow(_repair, _RESULT)
