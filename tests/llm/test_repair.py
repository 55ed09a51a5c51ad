import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rolelake.llm import repair
from rolelake.llm.places import numbered, running


def plain_audit(rows):
    """Cost, audit and repaired turns by the whole table of (row, state), audits kept as they are.

    rows: (fault, role, text) with fault '', 'truncated' or 'gone'.
    """
    new = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def closed_under_inserts(ways):
        ways = dict(ways)
        for _ in range(3):
            for state, (cost, audit, turns) in list(ways.items()):
                role = new[state]
                found = (cost + 5, audit + "I", [*turns, (role, "")])
                if role[0] not in ways or found[:2] < ways[role[0]][:2]:
                    ways[role[0]] = found
        return ways

    ways = {"": (0, "", [])}
    for fault, role, text in rows:
        following = {}
        for state, (cost, audit, turns) in closed_under_inserts(ways).items():
            steps = [(state, 2, "D", [])]
            extra = 5 if fault == "truncated" else 0
            if fault != "gone":
                steps.append((new[state][0], 1 + extra, "R", [(new[state], text)]))
                if role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and role:
                    steps.append((role[0], extra, "K", [(role, text)]))
            for end, more, edit, turn in steps:
                found = (cost + more, audit + edit, turns + turn)
                if end not in following or found[:2] < following[end][:2]:
                    following[end] = found
        ways = following
    return min((w for s, w in closed_under_inserts(ways).items() if s in ("", "a")), key=lambda w: w[:2])


def plain(messages):
    """What the operator returns, by conversation, from (conv, turn, role, text) as they are after damage."""
    found = {}
    for conv in {m[0] for m in messages}:
        rows = sorted((m for m in messages if m[0] == conv), key=lambda m: (m[1] is not None, m[1] or 0, m[2], m[3]))
        seen, faults = set(), []
        for _, _, role, text in rows:
            words = text.strip(" \t\n\v\f\r")
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = [m[1] for m in rows if m[1] is not None]
        cost, audit, left = plain_audit([("gone" if f in ("blank", "duplicate") else f, m[2], m[3]) for f, m in zip(faults, rows, strict=True)])
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        said = "\n".join(f"{r}:{t}" for r, t in left)
        found[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest(), left)
    return found


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", " "]
TEXTS = ["Yes.", "no", "", " \n", "a b?", "Fine! \t", "é…", "x\0y.", "last. "]


def messages_of(seed, conversations, most):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rng.randrange(most)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]), rng.choice(ROLES), rng.choice(TEXTS) + rng.choice(["", f"{turn}."])))
    return rows


def test_divide_and_conquer_equals_the_whole_table():
    rng = random.Random(4)
    roles = ["other", "system", "user", "assistant"]
    for _ in range(1500):
        kinds = [rng.randrange(12) for _ in range(rng.randrange(14))]
        rows = [(["", "truncated", "gone"][k // 4], roles[k % 4], "t") for k in kinds]
        cost, audit, turns = plain_audit(rows)
        got, state = repair.ending(*repair.rows_summary(kinds))
        edits = repair.row_audit(kinds, repair.START, state)
        assert (got, edits + "I" * repair.CLOSING[state]) == (cost, audit)
        # Groups of stretches choose the same crossings.
        cuts = sorted(rng.randrange(len(kinds) + 1) for _ in range(3))
        parts = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)], strict=True)]
        tables = [repair._edges(*repair.rows_summary(p)) for p in parts]
        assert repair.ending(*repair.group_summary(tables)) == (got, state)
        ways = [*repair.crossings(tables, repair.START, state), state]
        assert "".join(repair.row_audit(p, a, b) for p, a, b in zip(parts, ways, ways[1:], strict=False)) == edits


@pytest.mark.parametrize("stretch, group", [(10, 8), (1, 1)])
def test_equals_plain_version(spark, monkeypatch, stretch, group):
    monkeypatch.setattr(repair, "STRETCH_BITS", stretch)
    monkeypatch.setattr(repair, "GROUP_BITS", group)
    rows = messages_of(stretch, 40, 14)
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "conv long, turn long, role string, text string, number string, block int").repartition(3)
    want = plain(rows)
    got = {r["conv"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256")) for r in repair.repaired(df).collect()}
    assert got == {c: w[:8] for c, w in want.items()}
    turns = {}
    for r in sorted(repair.repaired_turns(df).collect(), key=lambda r: r["place"]):
        turns.setdefault(r["conv"], []).append((r["role"], r["text"]))
    assert turns == {c: w[8] for c, w in want.items() if w[8]}


def test_long_conversation_and_long_text(spark):
    rows = [(5, t, ["user", "assistant"][t % 2], f"turn {t}." if t % 7 else "same.") for t in range(2500)] + [(6, 0, "user", "word " * 100_000 + ".")]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    want = plain(rows)
    got = {r["conv"]: (r["cost"], r["audit"], r["sha256"]) for r in repair.repaired(df).collect()}
    assert got == {c: w[5:8] for c, w in want.items()}


def test_damage(spark):
    rows = [(c, t, None if t == 3 else "assistant", None if t == 2 else f"What? {t}!") for c in (1, 2, None) for t in [*range(40), None]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = {1: "", 2: text.replace("?", "").replace("!", "")}.get(kind, text)
        want += [(c, t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(str, map(tuple, repair.damaged(df).collect()))) == sorted(map(str, want))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv long, turn long, role string, text string")
    assert repair.repaired(empty).collect() == [] and repair.repaired_turns(empty).collect() == []


def test_numbers_and_running_totals(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(3), rng.randrange(50)) for _ in range(700)]
    df = numbered(spark.createDataFrame(rows, "k long, v long").repartition(5), "k", "v")
    got = sorted(df.collect(), key=lambda r: r["number"])
    assert [r["number"] for r in got] == list(range(700)) and [(r["k"], r["v"]) for r in got] == sorted(rows)
    summed = running(df.withColumn("x", F.col("v")), [], "number", {"v": "sum", "x": "bit_xor"}, 700, block=4).collect()
    total = code = 0
    for r in sorted(summed, key=lambda r: r["number"]):
        v = sorted(rows)[r["number"]][1]
        total, code = total + v, code ^ v
        assert (r["v"], r["x"]) == (total, code)
