import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rolelake.llm import listrank, trie


def plain(messages):
    """Every node from (conv_id, turn, role, text), by prefixes kept whole."""
    said = {}
    for c, turn, role, text in messages:
        if c is not None:
            said.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, t) for _, _, r, t in sorted(rows)] for c, rows in said.items()}
    rebuilt = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = said.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + own[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = {}
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(len(x) > len(m) and x[: len(m)] == m for x in members)]
        saved = sum((len(members[m]) - 1) * (len(m[-1][1].encode()) if m else 0) for m in below)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        found[min(convs), len(node)] = (parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return found


SCHEMA = "conv_id long, turn long, role string, text string, place long, number long, a string, depth string"


def trie_of(spark, rows):
    messages = spark.createDataFrame([(*r, 1, 2, "a", "d") for r in rows], SCHEMA).repartition(3)
    got = trie.prefix_trie(*trie.rebuilt(trie.turns(messages))).collect()
    return {(r["conv"], r["depth"]): (r["parent"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"], r["ends_sha256"]) for r in got}, len(got)


@pytest.mark.parametrize("few", [3, 1 << 15])
def test_equals_plain_version(spark, monkeypatch, few):
    monkeypatch.setattr(listrank, "FEW", few)
    rng = random.Random(few)
    rows = []
    for c in [*range(-7, 40), None]:
        for turn in range(rng.choice([1, 2, 3, 12])):
            rows.append((c, rng.choice([turn, turn, None, 1]), rng.choice(["user", "assistant", None, ""]), rng.choice([None, "", "é", "yes", "x" * turn])))
    want = plain(rows)
    got, n = trie_of(spark, rows)
    assert got == want and n == len(want)


def test_many_copies_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "_ENDS_BITS", 2)
    rows = [(c, t, "user", f"same {t}") for c in range(60) for t in range(3)]
    rows += [(1000, t, "user", f"turn {t % 4}") for t in range(4500)] + [(2000, 0, "user", "word " * 200_000)]
    got, n = trie_of(spark, rows)
    by_conv = {}
    for (c, d), row in got.items():
        by_conv.setdefault(c, []).append((d, row))
    assert n == len(got) and got[0, 0][1] == 62
    assert max(d for d, _ in by_conv[1000]) == len({(1000, t) for t in range(4500)})
    chain = {d: row for (c, d), row in got.items() if c == 1000}
    assert all(row[:4] == (1000 if d > 1 else 0, 1, int(d < 4500), 1) for d, row in chain.items() if d > 1)


def test_list_ranking(spark, monkeypatch):
    monkeypatch.setattr(listrank, "FEW", 5)
    order = list(range(300))
    random.Random(2).shuffle(order)
    links = [*zip(order[:200], [*order[1:200], None], strict=True), *zip(order[200:], [*order[201:], None], strict=True)]
    got = {r["id"]: r["rank"] for r in listrank.ranked(spark.createDataFrame(links, "id long, next long")).collect()}
    assert got == {**{x: 200 - k for k, x in enumerate(order[:200])}, **{x: 100 - k for k, x in enumerate(order[200:])}}
    assert listrank.ranked(spark.createDataFrame([], "id long, next long")).count() == 0


def test_empty_and_nameless(spark):
    assert trie_of(spark, []) == ({}, 0)
    assert trie_of(spark, [(None, 1, "user", "x")]) == ({}, 0)


def test_shared_turns(spark):
    got = spark.range(-3, 30).select("id", trie.shared_turns(F.col("id")).alias("h")).collect()
    assert all(r["h"] == zlib.crc32(str(r["id"]).encode()) % 9 for r in got)
