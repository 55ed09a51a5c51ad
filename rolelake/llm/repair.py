"""Conversation structure repair: the cheapest edits that make the turns alternate, by divide and conquer.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.  Every row is kept,
gets another role, or is deleted, and empty turns can be put in anywhere, each at a cost; rows that are blank or
duplicates have to go.  The state of a prefix is one of four, so a stretch of rows is known by its costs from state to
state.  Following Hirschberg, costs run forward over the first half and backward over the second; they
meet in the middle, the cheapest crossing with the ASCII-least audit is taken, and both halves go on alone.

In Spark, stretches of up to 1,024 rows are summed up to such a table of costs, the tables of 256 stretches to
one, and so on up; on the way down each group chooses the crossings between its members, and the stretches choose
theirs between rows.  No conversation is gathered; only the digest of what was repaired passes through one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rolelake.llm.places import numbered
from rolelake.operators.durable import stored
from rolelake.shipping import ship

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: Nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, ASKED, ANSWERED = range(4)
#: The user's turn comes in all states but ASKED.
AFTER_NEW = (ASKED, ASKED, ANSWERED, ASKED)
ROLE_OF_NEW = ("user", "user", "assistant", "user")
#: By initial (another one, s, u, a): states to states when a row is kept.
_KEPT = ({}, {START: SYSTEM}, {START: ASKED, SYSTEM: ASKED, ANSWERED: ASKED}, {ASKED: ANSWERED})
INITIALS = "?sua"
SOUND, TRUNCATED, GONE = range(3)
_NEVER = 1 << 60
#: Rows in a stretch, and members of a group, as powers of two.
STRETCH_BITS, GROUP_BITS = 10, 8

#: From state to state: cost and what is written for it; the lesser is taken among equals.
Edges = Sequence[Sequence[tuple[int, object] | None]]


@lru_cache(maxsize=None)
def row_edges(kind: int) -> Edges:
    """Edits of one row of a kind (fault * 4 + initial), with the turns put in before it."""
    fault, initial = divmod(kind, 4)
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    best: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for start in range(4):
        state = start
        for added in range(3):  # a third turn would come back to a state seen before
            steps = [(DELETE, state, 0)]
            if fault != GONE:
                steps.append((REROLE, AFTER_NEW[state], extra))
                if state in _KEPT[initial]:
                    steps.append((KEEP, _KEPT[initial][state], extra))
            for edit, end, more in steps:
                found = (added * COST[INSERT] + COST[edit] + more, INSERT * added + edit)
                if best[start][end] is None or found < best[start][end]:
                    best[start][end] = found
            state = AFTER_NEW[state]
    return best


#: Turns to put in after the last row so that it ends well, by state.
CLOSING = (0, 2, 1, 0)

#: Four costs, and the order of the audits that reach the states at these costs.
Front = tuple[tuple[int, ...], tuple[int, ...]]


def _unit(state: int) -> Front:
    return tuple(0 if s == state else _NEVER for s in range(4)), (0, 0, 0, 0)


def _forward(front: Front, edges: Edges) -> Front:
    """Costs and order of audits one element on.  No audit up to a boundary begins another, so earlier ones decide."""
    costs, ranks = front
    reached = []
    for end in range(4):
        ways = [(costs[s] + e[0], ranks[s], e[1]) for s in range(4) if costs[s] < _NEVER and (e := edges[s][end])]
        reached.append(min(ways, default=None))
    order = sorted({way[1:] for way in reached if way})
    return (
        tuple(way[0] if way else _NEVER for way in reached),
        tuple(order.index(way[1:]) if way else 0 for way in reached),
    )


def _backward(costs: tuple[int, ...], edges: Edges) -> tuple[int, ...]:
    """Costs to the end, one element earlier."""
    return tuple(min((e[0] + costs[end] for end in range(4) if (e := edges[s][end])), default=_NEVER) for s in range(4))


# Costs differ by little from state to state, so once the least is taken off only a few hundred fronts are ever met.
@lru_cache(maxsize=1 << 14)
def _row_forward(front: Front, kind: int) -> tuple[Front, int]:
    costs, ranks = _forward(front, row_edges(kind))
    least = min(costs)
    return (tuple(c - least if c < _NEVER else c for c in costs), ranks), least


@lru_cache(maxsize=1 << 14)
def _row_backward(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    earlier = _backward(costs, row_edges(kind))
    least = min(earlier)
    return tuple(c - least if c < _NEVER else c for c in earlier)


def _crossing(front: Front, rest: tuple[int, ...]) -> int:
    """The state in which the cheapest way with the least audit crosses a boundary."""
    costs, ranks = front
    return min((costs[s] + rest[s], ranks[s], s) for s in range(4) if costs[s] < _NEVER and rest[s] < _NEVER)[2]


def row_audit(kinds: Sequence[int], enter: int, leave: int) -> str:
    """The least of the cheapest audits of these rows between two states, in space linear in the rows."""
    parts, todo = [], [(0, len(kinds), enter, leave)]
    while todo:
        lo, hi, enter, leave = todo.pop()
        if hi - lo == 1:
            parts.append(row_edges(kinds[lo])[enter][leave][1])
        elif hi > lo:
            middle = (lo + hi) // 2
            front, rest = _unit(enter), _unit(leave)[0]
            for k in range(lo, middle):
                front, _ = _row_forward(front, kinds[k])
            for k in range(hi - 1, middle - 1, -1):
                rest = _row_backward(rest, kinds[k])
            state = _crossing(front, rest)
            todo += [(middle, hi, state, leave), (lo, middle, enter, state)]
    return "".join(parts)


def crossings(members: Sequence[Edges], enter: int, leave: int) -> list[int]:
    """The states at the boundaries between members of a group, the same way."""
    states, todo = [], [(0, len(members), enter, leave)]
    while todo:
        lo, hi, enter, leave = todo.pop()
        if hi - lo < 2:
            states.append(enter)
            continue
        middle = (lo + hi) // 2
        front, rest = _unit(enter), _unit(leave)[0]
        for k in range(lo, middle):
            front = _forward(front, members[k])
        for k in range(hi - 1, middle - 1, -1):
            rest = _backward(rest, members[k])
        state = _crossing(front, rest)
        todo += [(middle, hi, state, leave), (lo, middle, enter, state)]
    return states


def _flat(fronts: list[Front]) -> tuple[list[int], list[int]]:
    return [c for costs, _ in fronts for c in costs], [r for _, ranks in fronts for r in ranks]


def _edges(costs: Sequence[int], ranks: Sequence[int]) -> Edges:
    cells = [(c, r) if c < _NEVER else None for c, r in zip(costs, ranks, strict=True)]
    return [cells[k : k + 4] for k in range(0, 16, 4)]


def rows_summary(kinds: Sequence[int]) -> tuple[list[int], list[int]]:
    """Costs and order of audits of a stretch, from each state to each."""
    fronts = []
    for start in range(4):
        front, total = _unit(start), 0
        for kind in kinds:
            front, added = _row_forward(front, kind)
            total += added
        fronts.append((tuple(c + total if c < _NEVER else c for c in front[0]), front[1]))
    return _flat(fronts)


def group_summary(members: Sequence[Edges]) -> tuple[list[int], list[int]]:
    """The same of a group of stretches."""
    fronts = []
    for start in range(4):
        front = _unit(start)
        for member in members:
            front = _forward(front, member)
        fronts.append(front)
    return _flat(fronts)


def ending(costs: Sequence[int], ranks: Sequence[int]) -> tuple[int, int]:
    """Cost of a whole conversation, and the state in which its last row leaves it."""
    whole = [(c + CLOSING[s] * COST[INSERT], r, s) for s, (c, r) in enumerate(zip(costs[:4], ranks[:4], strict=True)) if c < _NEVER]
    cost, _, state = min(whole)
    return cost, state


def repaired_row(state: int, edit: str, role: str, text: str) -> tuple[list[tuple[str, str]], int]:
    """The turns that one row's edits leave, and the state after it."""
    left = []
    for step in edit:
        if step == INSERT:
            left.append((ROLE_OF_NEW[state], ""))
        elif step == REROLE:
            left.append((ROLE_OF_NEW[state], text))
        elif step == KEEP:
            left.append((role, text))
            state = _KEPT[INITIALS.find(role[0])][state]
            continue
        else:
            continue
        state = AFTER_NEW[state]
    return left, state


def _mapped(function, schema: pa.Schema):
    """Arrow batches through a function of one row's values."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [function(*values) for values in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return mapped


_TABLE = "costs array<long>, ranks array<int>"
_ARROW_TABLE = [("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32()))]


def _summed(conv, block, kinds):
    return (conv, block, *rows_summary(kinds))


def _regrouped(conv, block, members):
    return (conv, block, *group_summary([_edges(m["costs"], m["ranks"]) for m in members]))


def _entered(conv, enter, leave, members):
    states = crossings([_edges(m["costs"], m["ranks"]) for m in members], enter, leave)
    return conv, [{"block": m["block"], "enter": s, "leave": e} for m, s, e in zip(members, states, [*states[1:], leave], strict=True)]


def _audited(conv, first, kinds, enter, leave):
    return conv, first, enter, row_audit(kinds, enter, leave)


def _top(conv, block, costs, ranks):
    return (conv, block, *ending(costs, ranks))


_DIGESTS = pa.schema([("conv", pa.int64()), ("audit", pa.string()), ("sha256", pa.string())])
_TURNS = pa.schema([("conv", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, turns or None, audit or None): what each row's edits leave, one after another; the audit comes last.

    The edits of a stretch come before its rows.
    """
    conv, state, audit, edits, first = None, None, [], [], 0

    def closed() -> tuple:
        added, at = [], state
        for _ in range(CLOSING[state]):
            added.append((ROLE_OF_NEW[at], ""))
            at = AFTER_NEW[at]
        return conv, added, "".join(audit) + INSERT * CLOSING[state]

    for batch in batches:
        for c, number, enter, found, role, text in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if state is None or c != conv:
                if state is not None:
                    yield closed()
                conv, audit = c, []
            if found is not None:
                state, first, edits = enter, number, re.findall(f"{INSERT}*[{DELETE}{KEEP}{REROLE}]", found)
                audit.append(found)
                continue
            left, state = repaired_row(state, edits[number - first], role, text)
            yield conv, left, None
    if state is not None:
        yield closed()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema.names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation; its texts pass and aren't held."""

    def rows() -> Iterator[tuple]:
        digest, begun = hashlib.sha256(), False
        for conv, turns, audit in _conversations(batches):
            for role, text in turns:
                digest.update(f"\n{role}:{text}".encode() if begun else f"{role}:{text}".encode())
                begun = True
            if audit is not None:
                yield conv, audit, digest.hexdigest()
                digest, begun = hashlib.sha256(), False

    return _batches(rows(), _DIGESTS)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns of each conversation, numbered from 0."""

    def rows() -> Iterator[tuple]:
        place = 0
        for conv, turns, audit in _conversations(batches):
            for role, text in turns:
                yield conv, place, role, text
                place += 1
            if audit is not None:
                place = 0

    return _batches(rows(), _TURNS)


def damaged(messages: DataFrame) -> DataFrame:
    """Columns conv, turn, role, text: messages (conv_id, turn, role, text) damaged by crc32 of ``conv_id:turn``.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it, 4
    makes its role user.  A null is one space in that key, and as role or text.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("_kind")
    )
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return rows.filter("_kind <> 0").select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


#: The last character that isn't white space ends a sentence.
_ENDS_WELL = r"[.!?][\x20\x09-\x0D]*\z"
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _faults(rows: DataFrame) -> DataFrame:
    """Numbered rows with their fault.  The first of equals is the one with the least number, taken by an aggregate."""
    facts = rows.select(
        "conv", "number", "turn", F.substring("role", 1, 1).alias("initial"), F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256).alias("_said"),
        (~F.col("text").rlike(_HAS_WORD)).alias("blank"), (~F.col("text").rlike(_ENDS_WELL)).alias("_open"),
    )
    firsts = facts.filter("not blank").groupBy("conv", "_said").agg(F.min("number").alias("_first"))
    both = facts.join(firsts.select("_first"), F.col("number") == F.col("_first"), "left")
    duplicate = ~F.col("blank") & F.col("_first").isNull()
    return both.select("conv", "number", "turn", "initial", "blank", duplicate.alias("duplicate"), (~F.col("blank") & ~duplicate & F.col("_open")).alias("truncated"))


def _kind_of() -> Column:
    fault = F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), TRUNCATED).otherwise(SOUND)
    return fault * 4 + F.greatest(F.lit(1), F.instr(F.lit(INITIALS), F.col("initial"))) - 1


def _measures(faults: DataFrame) -> DataFrame:
    """Counts of each conversation."""
    one = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    span = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    return faults.groupBy("conv").agg(F.coalesce(span, F.lit(0)).alias("gaps"), one("blank"), one("duplicate"), one("truncated"))


def _illegal(faults: DataFrame) -> DataFrame:
    """Adjacent rows whose initials may not follow each other: each row meets the next number of its conversation."""
    rows = faults.select("conv", "number", "initial")
    after = rows.select(F.col("conv").alias("_conv"), (F.col("number") - 1).alias("_number"), F.col("initial").alias("_next"))
    pairs = rows.join(after, (F.col("number") == F.col("_number")) & F.col("conv").eqNullSafe(F.col("_conv")))
    wrong = ~F.concat("initial", "_next").isin("su", "ua", "au")
    return pairs.groupBy("conv").agg(F.sum(wrong.cast("long")).alias("illegal"))


def _decided(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Numbered rows, their faults, the cost of each conversation, and edits with the rows that they are for."""
    ship(rows.sparkSession)
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    said = numbered(rows.select("conv", "turn", "role", "text"), *order)
    faults = stored(_faults(said))
    block = F.shiftright("number", STRETCH_BITS).alias("block")
    stretches = stored(
        faults.withColumn("kind", _kind_of()).groupBy("conv", block).agg(F.sort_array(F.collect_list(F.struct("number", "kind"))).alias("_rows"))
        .select("conv", "block", F.col("_rows")[0]["number"].alias("first"), F.transform("_rows", lambda r: r["kind"]).alias("kinds"))
    )
    table = pa.schema([("conv", pa.int64()), ("block", pa.int64()), *_ARROW_TABLE])
    levels = [stored(stretches.select("conv", "block", "kinds").mapInArrow(_mapped(_summed, table), f"conv long, block long, {_TABLE}"))]
    while levels[-1].groupBy("conv").count().filter("count > 1").limit(1).count():
        groups = _grouped(levels[-1]).select("conv", "group", "members")
        levels.append(stored(groups.mapInArrow(_mapped(_regrouped, table), f"conv long, block long, {_TABLE}")))
    top_schema = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("cost", pa.int64()), ("leave", pa.int32())])
    top = stored(levels[-1].mapInArrow(_mapped(_top, top_schema), "conv long, block long, cost long, leave int"))
    ways = top.select("conv", "block", F.lit(START).alias("enter"), "leave")
    for level in reversed(levels[:-1]):
        members = _grouped(level).withColumnsRenamed({"conv": "_conv"})
        known = ways.join(members, (F.col("block") == F.col("group")) & F.col("conv").eqNullSafe(F.col("_conv")))
        parts = "conv long, parts array<struct<block:long,enter:int,leave:int>>"
        arrow = pa.schema([("conv", pa.int64()), ("parts", pa.list_(pa.struct([("block", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32())])))])
        chosen = known.select("conv", "enter", "leave", "members").mapInArrow(_mapped(_entered, arrow), parts)
        ways = stored(chosen.select("conv", F.inline("parts")))
    asked = stretches.withColumnsRenamed({"conv": "_conv", "block": "_block"})
    both = ways.join(asked, (F.col("block") == F.col("_block")) & F.col("conv").eqNullSafe(F.col("_conv")))
    edits_schema = pa.schema([("conv", pa.int64()), ("first", pa.int64()), ("enter", pa.int32()), ("edits", pa.string())])
    audited = both.select("conv", "first", "kinds", "enter", "leave").mapInArrow(_mapped(_audited, edits_schema), "conv long, first long, enter int, edits string")
    edits = audited.select("conv", F.col("first").alias("number"), "enter", "edits", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = said.select("conv", "number", F.lit(None).cast("int").alias("enter"), F.lit(None).cast("string").alias("edits"), "role", "text")
    stream = edits.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "number", F.col("edits").asc_nulls_last())
    return said, faults, top, stream


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv, place (from 0), role, text.  See ``repaired`` for the rows that it takes."""
    return _decided(rows)[3].mapInArrow(_turns, "conv long, place long, role string, text string")


def repaired(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (conv long, turn long, role, text; no null in the last two).

    Columns conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256 (of the repaired ``role:text``, joined by line
    breaks).  Rows are ordered by turn (null first), then role and text; rows equal in all are repeats.  A null conv is a
    conversation, too.  Roles are told by their first character as it is; a row with an empty role can't be kept.
    An empty table has no conversation.
    """
    _, faults, top, stream = _decided(rows)
    parts = [_illegal(faults), top.select("conv", "cost"), stream.mapInArrow(_digests, "conv long, audit string, sha256 string")]
    found = _measures(faults)
    for part in parts:
        found = found.unionByName(part, allowMissingColumns=True)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.groupBy("conv").agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names], F.max("audit").alias("audit"), F.max("sha256").alias("sha256"))


def _grouped(level: DataFrame) -> DataFrame:
    """Groups of up to 256 members that follow each other, in order."""
    member = F.struct("block", "costs", "ranks")
    group = F.shiftright("block", GROUP_BITS).alias("group")
    return level.groupBy("conv", group).agg(F.sort_array(F.collect_list(member)).alias("members"))
