"""Repair of conversation structure by iterative-deepening A*.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turn. Edits bring it there,
row by row: Keep (free), Rerole to user or assistant, Delete, which blank and
repeated rows need, and Insert of an empty user or assistant turn; a truncated
row that stays costs extra. What the next turn must be follows from the turns
before it (four states), so a string of edits, by their initials, has one
outcome.

The search is depth first, in ASCII order of the edits, under a bound on the
cost; while nothing is accepted the bound grows to the least cost that went
beyond it. Costs to go are estimated from below by what the faulty rows cost
at least as far as the next settled row, and the least cost from there. A state (row, what comes next) that failed keeps the least
cost that its failure proves, in a transposition table that outlives the bounds
and prunes it from then on. The first path that is accepted is the answer: the
cheapest and, of equals, the ASCII-least. The table is filled from the last
rows to the first, ``STRIDE`` rows at a time, so that every search meets settled
states after a few rows and a conversation takes time in proportion to its rows.

Spark sorts rows by conversation and turn. The search reads a letter and a
digest a row, never texts; repaired rows come from a second sorted stream, in
which each conversation's edits stand before its rows. Texts are passed on one
at a time, so that the longest conversation needs about 100 bytes a row in its
task (the digests of its distinct rows), whatever the length of its texts.

Edge cases: a null role or text is one space; null turns come first; rows of one
turn are ordered by role, then the text's SHA-256; repeated rows are duplicates
of the first; rows with a null conversation id form one conversation; roles
other than system, user and assistant count by their initial, the empty role
has none and fits nowhere; an empty table gives no rows; further columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from farelens.llm.common import stored

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
#: States: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: By state: the turn that an Insert or Rerole makes, and where each initial leads.
_MADE = {_START: "user", _SYSTEM: "user", _USER: "assistant", _ASSISTANT: "user"}
_NEXT = {_START: {"s": _SYSTEM, "u": _USER}, _SYSTEM: {"u": _USER}, _USER: {"a": _ASSISTANT}, _ASSISTANT: {"u": _USER}}
_ACCEPTED = (_START, _ASSISTANT)
STRIDE = 8
_FAR = 1 << 60

#: What is wrong with a row, the first that holds.
FINE, BLANK, DUPLICATE, CUT = "fbdt"


class Search:
    """``rows``: (initial, fault) in order."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.rows = rows
        self.low = [0] * (4 * (len(rows) + 1))  # proven least cost to go, by row and state

    def edits(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        made = _NEXT[state][_MADE[state][0]]
        if i == len(self.rows):
            yield INSERT, COST[INSERT], i, made
            return
        initial, fault = self.rows[i]
        yield DELETE, COST[DELETE], i + 1, state
        yield INSERT, COST[INSERT], i, made
        if fault in (FINE, CUT):
            extra = TRUNCATED if fault == CUT else 0
            if initial in _NEXT[state]:
                yield KEEP, COST[KEEP] + extra, i + 1, _NEXT[state][initial]
            yield REROLE, COST[REROLE] + extra, i + 1, made

    def within(self, i: int, state: int, bound: int, settled: int) -> tuple[str, int, int] | None:
        """The first path of at most ``bound`` to an accepting end, as far as
        row ``settled``, whose costs to go are known: its edits, its cost and
        the state it comes to."""
        at = 4 * i + state
        if self.low[at] > bound:
            return None
        if i == settled and (i < len(self.rows) or state in _ACCEPTED):
            return "", 0, state
        beyond = _FAR
        for edit, cost, j, then in self.edits(i, state):
            if cost <= bound and (found := self.within(j, then, bound - cost, settled)):
                return edit + found[0], cost + found[1], found[2]
            beyond = min(beyond, cost + self.low[4 * j + then])
        self.low[at] = max(self.low[at], beyond)
        return None

    def deepen(self, i: int, state: int, settled: int) -> tuple[str, int, int]:
        while not (found := self.within(i, state, self.low[4 * i + state], settled)):
            pass
        return found

    def estimate(self, i: int, settled: int) -> None:
        """Least costs to go for rows ``i`` and up: what faulty rows cost as far
        as ``settled``, and the least from there."""
        least = min(self.low[4 * settled:4 * settled + 4])
        for k in range(settled - 1, i - 1, -1):
            fault = self.rows[k][1]
            least += COST[DELETE] if fault in (BLANK, DUPLICATE) else min(TRUNCATED, COST[DELETE]) if fault == CUT else 0
            self.low[4 * k:4 * k + 4] = [least] * 4

    def solve(self) -> tuple[int, str]:
        """Least cost, and its ASCII-least edits."""
        n = len(self.rows)
        stops = [*range(0, n, STRIDE), n]
        for state in range(4):
            self.deepen(n, state, n)
        for i, settled in reversed(list(zip(stops, stops[1:], strict=False))):
            self.estimate(i, settled)
            for state in range(4 if i else 1):
                self.deepen(i, state, settled)
        cost, state, path = 0, _START, []
        for i, settled in zip(stops, stops[1:], strict=False):
            edits, more, state = self.deepen(i, state, settled)
            path.append(edits)
            cost += more
        edits, more, _ = self.deepen(n, state, n)
        return cost + more, "".join([*path, edits])


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def checked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``rows`` without nulls in the latter two,
    ``digest`` of the text, and ``fault``, but for duplicates."""
    held = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(FINE)
    return held.withColumns({"digest": F.unhex(F.sha2("text", 256)), "fault": fault})


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[bool, tuple]]:
    """Rows, and whether each begins a conversation."""
    before = object()
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
            yield row[0] != before, row
            before = row[0]


def _kind(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()


AUDIT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): ``gaps`` in its
    turns, rows by their first fault (``blank``, ``duplicate``, ``truncated``),
    ``illegal`` neighbours, the ``cost`` of its repair and ``audit``, the initials
    of the edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        conversation: list[tuple[str, str]] = []
        seen: set[bytes] = set()
        first = last = before = of = None
        distinct = 0

        def end() -> tuple:
            count = lambda fault: sum(f == fault for _, f in conversation)
            cost, edits = Search(conversation).solve()
            gaps = last - first + 1 - distinct if distinct else 0
            return of, gaps, count(BLANK), count(DUPLICATE), count(CUT), illegal([x for x, _ in conversation]), cost, edits

        for new, (conv, turn, role, digest, fault) in _by_conversation(batches, ["conv_id", "turn", "role", "digest", "fault"]):
            if new:
                if conversation:
                    made.append(end())
                of, first, last, before, distinct = conv, None, None, None, 0
                conversation, seen = [], set()
            if turn is not None:
                first, last, distinct, before = turn if first is None else first, turn, distinct + (turn != before), turn
            key = digest + role.encode()
            fault = BLANK if fault == BLANK else DUPLICATE if key in seen else fault
            seen.add(key)
            conversation.append((role[:1], fault))
            if len(made) >= 1000:
                yield batch(made)
                made = []
        if conversation:
            made.append(end())
        if made:
            yield batch(made)

    def batch(made: list[tuple]) -> pa.RecordBatch:
        conv, *numbers, edits = zip(*made, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(conv, kind), *(pa.array(x, pa.int64()) for x in numbers), pa.array(edits, pa.string())],
                                          names=["conv_id", *AUDIT, "audit"])

    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    sorted_ = (checked(rows).select("conv_id", "turn", "role", "digest", "fault").repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "digest"))
    return sorted_.mapInArrow(run, f"conv_id {_kind(rows, 'conv_id')}, " + ", ".join(f"{c} long" for c in AUDIT) + ", audit string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object, str | None, str | None]]:
    """(begins a conversation, conv_id, role, text) of repaired turns. A
    conversation's edits come before its rows; where no turn is left, its one
    entry has no role."""
    edits, at, state, conv = "", 0, _START, None

    def inserted() -> Iterator[tuple[str, str]]:
        nonlocal at, state
        while at < len(edits) and edits[at] == INSERT:
            role = _MADE[state]
            state, at = _NEXT[state][role[0]], at + 1
            yield role, ""

    for new, (conv_id, listed, role, text) in _by_conversation(batches, ["conv_id", "audit", "role", "text"]):
        if new:
            conv, edits, at, state = conv_id, listed or "", 0, _START
            yield True, conv, None, None
            yield from ((False, conv, *turn) for turn in inserted())
            continue
        edit, at = edits[at], at + 1
        if edit != DELETE:
            role = _MADE[state] if edit == REROLE else role
            state = _NEXT[state][role[0]]
            yield False, conv, role, text
        yield from ((False, conv, *turn) for turn in inserted())


def _with_edits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    texts = checked(rows).select("conv_id", F.lit(1).alias("part"), "turn", "role", "digest", "text", F.lit(None).cast("string").alias("audit"))
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    edits = audits.select("conv_id", F.lit(0).alias("part"), none("turn", rows.schema["turn"].dataType), none("role", "string"),
                          none("digest", "binary"), none("text", "string"), "audit")
    return edits.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "digest")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, place (from 0), role, text. ``audits``
    is what ``audit`` gave for the same rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, place, size = [], 0, 0
        for new, conv, role, text in _edited(batches):
            if new:
                place = 0
                continue
            made.append((conv, place, role, text))
            place, size = place + 1, size + len(text)
            if len(made) >= 1000 or size > 1_000_000:
                yield batch(made)
                made, size = [], 0
        if made:
            yield batch(made)

    def batch(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), (kind, pa.int64(), pa.string(), pa.string()), strict=True)],
                                          names=["conv_id", "place", "role", "text"])

    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    return _with_edits(rows, audits).mapInArrow(run, f"conv_id {_kind(rows, 'conv_id')}, place long, role string, text string")


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id and ``repaired_sha256``: the SHA-256 of its repaired turns as
    ``role:text``, joined by newlines, hashed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, state, any_, of, begun = [], hashlib.sha256(), False, None, False
        for new, conv, role, text in _edited(batches):
            if new:
                if begun:
                    made.append((of, state.hexdigest()))
                of, state, any_, begun = conv, hashlib.sha256(), False, True
                if len(made) >= 1000:
                    yield batch(made)
                    made = []
                continue
            state.update(f"{chr(10) if any_ else ''}{role}:{text}".encode())
            any_ = True
        if begun:
            yield batch([*made, (of, state.hexdigest())])

    def batch(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], kind), pa.array([m[1] for m in made])], names=["conv_id", "repaired_sha256"])

    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    return _with_edits(rows, audits).mapInArrow(run, f"conv_id {_kind(rows, 'conv_id')}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; nulls as one space) with faults by
    crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2
    takes its ``[.!?]`` out, 3 repeats it, 4 makes it the user's."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    copies: Column = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), F.explode(copies).alias("fl_copy")).drop("fl_copy")


EMPTY = hashlib.sha256(b"").hexdigest()


def repair_report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every conv_id of ``conversations`` with its audit and digest in ``rows``;
    one that has no rows there has zeros, no edits and the empty digest."""
    audits = stored(audit(rows), "audits")
    both = audits.withColumnRenamed("conv_id", "fl_conv").join(
        digests(rows, audits).withColumnRenamed("conv_id", "fl_of"), F.col("fl_conv").eqNullSafe(F.col("fl_of")))
    every = conversations.select("conv_id").distinct()
    out = every.join(both, F.col("conv_id").eqNullSafe(F.col("fl_conv")), "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in AUDIT], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"))
