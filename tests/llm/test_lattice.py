import numpy as np
import pytest

from rolelake.llm import components as components_of, lattice
from rolelake.llm.components import components


def brute(rows, least=0.95):
    usable = [
        (k, np.array(v, dtype=float)) for k, v in rows
        if v is not None and len(v) and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)
    ]
    links = {i: set() for i in range(len(usable))}
    for i, (_, a) in enumerate(usable):
        for j, (_, b) in enumerate(usable):
            if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                links[i].add(j)
    found = []
    for i, (k, _) in enumerate(usable):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        found.append((k, len(links[i]), min(usable[j][0] for j in seen)))
    return found


def near(rng, base, noise):
    return [float(x) for x in np.asarray(base) + noise * rng.standard_normal(len(base)) / np.sqrt(len(base))]


def test_links_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, key = [], 0
    for size in (1, 1, 2, 3, 5, 40):
        base = rng.standard_normal(64)
        for _ in range(size):
            rows.append((key, near(rng, base, 0.15)))
            key += 1
    rows += [(key + i, [float(x) for x in rng.standard_normal(64)]) for i in range(300)]
    rows += [(2000, rows[5][1]), (2001, [3 * x for x in rows[5][1]]), (2002, rows[5][1])]
    got = sorted((r["key"], r["n_links"], r["component"]) for r in lattice.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == sorted(brute(rows))


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    own_a, probed_a = lattice.cell_keys(a, lattice.Lattice())
    own_b, probed_b = lattice.cell_keys(b, lattice.Lattice())
    met = (own_a == own_b) | (probed_a == own_b[:, :, None]).any(axis=2) | (probed_b == own_a[:, :, None]).any(axis=2)
    assert met.any(axis=1).mean() > 0.95


def test_decoding_gives_the_nearest_lattice_point():
    rng = np.random.default_rng(2)
    x = rng.uniform(-2, 2, (200, 8))
    points = lattice.decode_e8(x)
    whole = (points % 2 == 0).all(axis=1)
    assert (whole | (points % 2 != 0).all(axis=1)).all() and (points.sum(axis=1) % 4 == 0).all()
    steps = lattice._roots()
    distance = ((x - points / 2) ** 2).sum(axis=1)
    for step in steps:
        assert (distance <= ((x - (points + step) / 2) ** 2).sum(axis=1) + 1e-9).all()


def test_odd_vectors(spark):
    v = [float(i % 5) - 1 for i in range(64)]
    rows = [
        (1, None), (2, []), (3, [0.0] * 64), (4, [None, *v[1:]]), (5, [float("nan"), *v[1:]]), (6, [float("inf"), *v[1:]]),
        (7, v), (7, v), (8, v[:32]), (None, v), (None, None), (9, [x * 1e-30 for x in v]),
    ]
    got = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    by = sorted((str(r["key"]), r["n_links"], r["component"], r["kept"]) for r in got)
    assert by == sorted(
        [(str(k), 0, k, True) for k in (1, 2, 3, 4, 5, 6, 8)] + [("7", 3, 7, True)] * 2 + [("None", 3, 7, False), ("None", 0, None, False), ("9", 3, 7, False)]
    )


def test_empty_table(spark):
    assert lattice.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "rings"])
def test_components(spark, shape):
    if shape == "path":
        links = [(i, i + 1) for i in range(40)]
    elif shape == "star":
        links = [(50, i) for i in range(49)] + [(3, 3)]
    else:
        links = [(r * 10 + i, r * 10 + (i + 1) % 10) for r in range(4) for i in range(10)] * 2
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    vertices = {v for link in links for v in link}
    want = {v: (v // 10 * 10 if shape == "rings" else 0) for v in vertices}
    assert {v: got.get(v, v) for v in vertices} == want


def test_the_driver_plans_a_step_of_components_once(spark, monkeypatch):
    plans, stored = [], components_of.stored
    monkeypatch.setattr(components_of, "stored", lambda df: plans.append(df) or stored(df))
    components(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long"))
    # A step's plan grows with every use of the one below; its links are used twice in each star.
    assert all(df._jdf.queryExecution().optimizedPlan().toString().count("parquet") <= 4 for df in plans[1:])
