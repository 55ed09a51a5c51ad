import random

import numpy as np
import pytest

from rolelake.llm import jaccard


def shingles(text):
    words = [w.lower() for w in (text or "").encode().split()]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(5))))


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(i)] = find(j)
    keys = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            keys.setdefault(find(i), []).append(r[0])
    return sorted((str(r[0]), len(sets[i]), min(keys.get(find(i), [None]), default=None)) for i, r in enumerate(rows))


def found(df):
    return sorted((str(r["key"]), r["n_grams"], r["component"]) for r in jaccard.near_duplicates(df).collect())


@pytest.fixture(scope="module")
def rows(prose):
    rng, rows = random.Random(8), []
    for group in range(12):
        base = prose(group, 40 + 25 * group).split()
        for _ in range(1 + group * 2):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 35)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    passage = prose(77, 60)
    rows += [f"{prose(500 + k, 30)} {passage} {prose(700 + k, 30)}" for k in range(30)]
    rows += [passage.upper(), passage, passage + " end", "one two", "ONE  two\n", "one", "", " \n", None, "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return [(i, text, "en", "s") for i, text in enumerate(rows)]


def test_components_match_brute_force(documents, rows):
    assert found(documents(rows)) == brute(rows)


def test_result_does_not_rest_on_the_first_step_or_on_tiles(documents, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    monkeypatch.setattr(jaccard, "BUNDLE", 8)
    links = jaccard._links
    first = []

    def none_at_first(pairs, *rest):
        first.append(None)
        return links(pairs.limit(0) if len(first) == 1 else pairs, *rest)

    monkeypatch.setattr(jaccard, "_links", none_at_first)
    assert found(documents(rows)) == brute(rows)


def test_repeated_and_null_keys(documents, prose):
    text = prose(1, 80)
    rows = [(4, text, "en", "s"), (4, text, "en", "s"), (4, prose(2, 80), "en", "s"), (None, text, "en", "s"), (None, "only here", None, None), (2, text + " z", "en", "s")]
    assert found(documents(rows)) == brute(rows)


def test_empty_table(documents):
    assert found(documents([])) == []
    assert found(documents([(1, None, None, None), (2, "", "en", "s")])) == [("1", 0, 1), ("2", 0, 2)]


def test_filters_never_lose_a_similar_pair():
    rng = np.random.default_rng(4)
    for _ in range(300):
        both = rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)
        x = np.unique(np.concatenate([both, rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)]))
        y = np.unique(np.concatenate([both, rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)]))
        shared = len(np.intersect1d(x, y))
        assert jaccard.linked(x, y, 80) == (100 * shared >= 80 * (len(x) + len(y) - shared))
        differ = jaccard.differing([jaccard.signature(x)], [jaccard.signature(y)])[0, 0]
        assert differ <= len(x) + len(y) - 2 * shared


def test_signatures_fold():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (60, 64, 65, 100, 130, 500)]
    got = jaccard.differing([jaccard.signature(x) for x in sets], [jaccard.signature(x) for x in sets])
    assert (np.diag(got) == 0).all() and (got == got.T).all() and got[1, 2] > 50


def test_prefixes_are_dealt_out_once(spark):
    rng = np.random.default_rng(9)
    # Many n-grams that only their own document has, alike in the bits that pick a counter, and a few shared ones.
    sets = {d: [int(v) << 24 for v in rng.integers(0, 2**38, 40)] for d in range(30)}
    for gram, held in ((1, (3, 4, 5)), (2, (4, 9)), (3, (7,)), (4, range(10, 20))):
        for d in held:
            sets[d].insert(int(rng.integers(0, 40)), gram)
    central = {d: int(rng.integers(0, 5)) for d in sets}
    rows = [(d, 5 * len(sets[d]), central[d], sets[d]) for d in sets]
    frame = spark.createDataFrame(rows + rows[3:12], "id long, n long, central long, prefix array<long>")
    met = jaccard._met(frame, 80)
    want = set()
    for gram in {g for s in sets.values() for g in s}:
        held = [d for d in sets if gram in sets[d]]
        leader = max(held, key=lambda d: (central[d], d))
        want |= {(d, leader) for d in held if len(held) > 1}
    got = met.collect()
    assert sorted((r["id"], r["b"]) for r in got) == sorted(want)
    assert not any(r["could"] for r in got if r["id"] == r["b"])
    plan = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("hashpartitioning(gram") == 1 and plan.count("Join") == 0
