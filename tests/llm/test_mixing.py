from rolelake.llm import mixing, words
from pyspark.sql import functions as F


def mixed(docs):
    return mixing.mix(docs, mixing.cyclic_weights(docs), words.word_count(F.col("text")), F.col("doc_id"), F.xxhash64("text"))


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    targets, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * left / total > 3 * sizes[s]}
        if not above:
            return targets | {s: weight[s] * left / total for s in open_}
        for s in above:
            targets[s] = 3.0 * sizes[s]
            left -= targets[s]
        open_ -= above
    return targets


def test_targets_and_what_is_taken(documents, prose):
    plan = {"a": (40, 50), "b": (5, 3), "c": (200, 20), None: (30, 10), "d": (1, 400)}
    rows = [(i * 10 + k, prose(i, 1 + i % size), "en", s) for k, (s, (n, size)) in enumerate(plan.items()) for i in range(n)]
    got = mixed(documents(rows)).select("_row.doc_id", "source", "size", "source_size", "target", "passes").collect()
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in plan}
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    taken = dict.fromkeys(plan, 0)
    for r in got:
        assert 0 <= r["passes"] <= 3 and r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["size"] * r["passes"]
    largest = {s: max(len(r[1].split()) for r in rows if r[3] == s) for s in plan}
    assert all(abs(taken[s] - want[s]) <= largest[s] + max(largest.values()) * want[s] / sum(sizes.values()) + 1 for s in plan)
    assert sum(taken.values()) <= sum(sizes.values())


def test_exact_order_against_a_plain_version(documents, prose):
    import hashlib

    rows = [(i, prose(i, 1 + (i * 7) % 30), "en", f"s{i % 4}") for i in range(150)]
    got = {r["doc_id"]: r["passes"] for r in mixed(documents(rows)).select("_row.doc_id", "passes").collect()}
    sizes = {f"s{k}": sum(len(r[1].split()) for r in rows if r[3] == f"s{k}") for k in range(4)}
    targets, entries = brute_targets(sizes), []
    for s in sizes:
        own = sorted((hashlib.md5(f"1:{r[0]}".encode()).hexdigest(), r[0], len(r[1].split())) for r in rows if r[3] == s)
        done = 0
        for turn in range(3):
            for key, doc, size in own:
                done += size
                entries.append((done / targets[s], turn, s, key, size, doc))
    want, total = dict.fromkeys(got, 0), 0
    for *_, size, doc in sorted(entries):
        total += size
        if total > sum(sizes.values()):
            break
        want[doc] += 1
    assert got == want


def test_nulls_repeats_and_runs_agree(documents):
    rows = [(1, None, None, "a"), (None, "x y", "en", None), (2, "", "en", "a"), (3, "p q r", "en", "b"), (3, "p q r", "en", "b"), (4, "long " * 5000, "en", "b")]
    docs = documents(rows)
    first, again = ([tuple(r) for r in mixed(docs).orderBy("_row.doc_id", "size").collect()] for _ in range(2))
    assert first == again and len(first) == 6
    assert all(r[5] == 0 for r in first if r[2] == 0)


def test_empty_table(documents):
    assert mixed(documents([])).count() == 0


def test_the_driver_plans_the_running_totals_once(documents, prose, monkeypatch):
    plans, stored = [], mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df: plans.append(df) or stored(df))
    got = mixed(documents([(i, prose(i, 5 + i), "en", f"s{i % 3}") for i in range(20)]))
    # A cut that can't be planned from a stored table has the targets' windows in it, too.
    assert [c for df in plans for c in df.columns if c in ("target", "finished")] == ["target", "target", "finished"]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 2
