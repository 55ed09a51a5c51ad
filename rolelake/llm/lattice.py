"""Near-duplicate vectors by E8 lattice hashing.

In each of several tables a vector of length 1 is projected onto 8 random orthonormal
directions for each of ``blocks`` blocks, and every block is decoded to the nearest point of the
scaled E8 lattice; the points together are the vector's cell.  A vector is listed in its own cell and
in the neighbouring cells that are next nearest (probes), reached by moving one block to its
second, third .. nearest lattice point.  Two vectors are candidates where one's own cell is among
the cells of the other, and cosines decide.

Equal directions collapse to one representative before hashing, so copies cost nothing.  A cell's
list is cut into tiles of bounded size, and pairs of tiles are compared as matrices; a tile hands on
only counts of links and a spanning forest of them, never the pairs.  A pair that meets several
times is counted at the first of its meetings only, which both vectors' cells tell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rolelake.llm.components import components
from rolelake.operators.durable import stored
from rolelake.shipping import ship


@dataclass(frozen=True)
class Lattice:
    """Tables, blocks of 8 directions, lattice scale in units of vector length, and probes per table."""

    tables: int = 5
    blocks: int = 2
    scale: float = 0.6
    probes: int = 3
    tile: int = 1024
    seed: int = 1


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates and even sum."""
    r = np.rint(x)
    odd = (r.sum(axis=1) % 2) != 0
    worst = np.abs(x - r).argmax(axis=1)
    rows = np.flatnonzero(odd)
    step = np.where(x[rows, worst[rows]] >= r[rows, worst[rows]], 1.0, -1.0)
    r[rows, worst[rows]] += step
    return r


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row, doubled so that coordinates are whole numbers.

    E8 is D8 together with D8 shifted by one half in every coordinate.
    """
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], whole, half)).astype(np.int64)


def _roots() -> np.ndarray:
    """The 240 shortest E8 vectors, doubled: steps to neighbouring cells."""
    found = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = np.zeros(8, dtype=np.int64)
                    v[i], v[j] = a, b
                    found.append(v)
    for signs in range(256):
        v = np.array([1 if signs >> k & 1 else -1 for k in range(8)], dtype=np.int64)
        if (v < 0).sum() % 2 == 0:
            found.append(v)
    return np.array(found)


def _mix(cells: np.ndarray) -> np.ndarray:
    """64-bit hash of the rows of whole numbers."""
    h = np.full(len(cells), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for k in range(cells.shape[1]):
        h = (h ^ cells[:, k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def directions(dim: int, lattice: Lattice) -> list[np.ndarray]:
    """For each table: dim x (8 * blocks) orthonormal directions, or as many as there are dimensions."""
    random = np.random.default_rng(lattice.seed)
    width = 8 * lattice.blocks
    return [np.linalg.qr(random.standard_normal((max(dim, width), width)))[0][:dim] for _ in range(lattice.tables)]


def cell_keys(x: np.ndarray, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Own cell of every vector in every table (n x tables), and the probed cells (n x tables x probes)."""
    roots = _roots()
    own = np.empty((len(x), lattice.tables), dtype=np.int64)
    probed = np.empty((len(x), lattice.tables, lattice.probes), dtype=np.int64)
    for t, p in enumerate(directions(x.shape[1], lattice)):
        y = (x @ p) * np.sqrt(x.shape[1] / p.shape[1]) / lattice.scale
        points = [decode_e8(y[:, 8 * b : 8 * b + 8]) for b in range(lattice.blocks)]
        # Distance that a step of one block would add: |v - s|^2 - |v|^2 = |s|^2 - 2 v.s, with |s|^2 = 2.
        costs = np.concatenate(
            [2.0 - (y[:, 8 * b : 8 * b + 8] - points[b] / 2) @ roots.T for b in range(lattice.blocks)], axis=1
        )
        cell = np.concatenate(points, axis=1)
        own[:, t] = _mix(cell) ^ t
        nearest = np.argpartition(costs, lattice.probes, axis=1)[:, : lattice.probes]
        for q in range(lattice.probes):
            block, step = np.divmod(nearest[:, q], len(roots))
            moved = cell.copy()
            for b in range(lattice.blocks):
                at = np.flatnonzero(block == b)
                moved[at, 8 * b : 8 * b + 8] += roots[step[at]]
            probed[:, t, q] = _mix(moved) ^ t
    return own, probed


def _by_length(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their vectors, scaled to length 1, for each dimension that occurs."""
    ends = np.asarray(vectors.value_lengths())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(ends)[:-1]]) if len(ends) else ends
    for dim in np.unique(ends):
        rows = np.flatnonzero(ends == dim)
        x = flat[starts[rows][:, None] + np.arange(dim)]
        # Scaled by the largest part first: squares of very small or large parts would not be exact.
        x = x / np.abs(x).max(axis=1, keepdims=True)
        yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def _listings(lattice: Lattice):
    width = lattice.tables * (1 + lattice.probes)

    def listings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each vector the cells that it is listed in: per table its own, then the probed ones."""
        for batch in batches:
            for start in range(0, len(batch), 2048):
                part = batch.slice(start, 2048)
                cells = np.empty((len(part), width), dtype=np.int64)
                for rows, x in _by_length(part.column("x")):
                    own, probed = cell_keys(x, lattice)
                    cells[rows] = np.concatenate([own[:, :, None], probed], axis=2).reshape(len(rows), width)
                offsets = pa.array(np.arange(0, (len(part) + 1) * width, width, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("x"), part.column("n"), pa.ListArray.from_arrays(offsets, pa.array(cells.reshape(-1)))],
                    ["id", "x", "n", "cells"],
                )

    return listings


def _met_before(cells_a: np.ndarray, cells_b: np.ndarray, table: int, cell: int) -> np.ndarray:
    """Whether each pair has an earlier meeting than this one; cells: pairs x tables x (own, probed)."""
    # A meeting is at a's own cell if b lists it, or at b's own cell if a lists it.
    at_a = (cells_a[:, : table + 1, :1] == cells_b[:, : table + 1]).any(axis=2)
    at_b = (cells_b[:, : table + 1, :1] == cells_a[:, : table + 1]).any(axis=2)
    earlier = (at_a | at_b)[:, :table].any(axis=1)
    # In the same table the smaller of two meeting cells is the earlier.
    smaller = (at_a[:, table] & (cells_a[:, table, 0] < cell)) | (at_b[:, table] & (cells_b[:, table, 0] < cell))
    return earlier | smaller


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A star for each component of the links a-b: the smallest member reachable, for each member."""
    label = np.arange(max(a.max(), b.max()) + 1)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _compared(lattice: Lattice, least: float):
    shape = (-1, lattice.tables, 1 + lattice.probes)

    def compared(rows: pa.Table) -> pa.Table:
        """Links inside a bundle of tiles: (id, links, to), counts with to null, forest links with links 0."""
        rows = rows.combine_chunks()
        column = lambda name: rows.column(name).chunk(0) if rows.num_rows else rows.column(name).combine_chunks()
        cells = column("cells").flatten().to_numpy().reshape(shape)
        key = [rows.column(c).to_numpy() for c in ("table", "cell", "left", "right", "side")]
        ids, many, own = (rows.column(c).to_numpy() for c in ("id", "n", "own"))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for same, x in _by_length(column("x")):
            order = np.lexsort([k[same] for k in reversed(key)])
            at, x = same[order], x[order]
            changes = np.any([k[at][1:] != k[at][:-1] for k in key[:4]], axis=0)
            edges = [0, *(np.flatnonzero(changes) + 1), len(at)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                one = key[2][at[lo]] == key[3][at[lo]]
                mid = hi if one else lo + int((key[4][at[lo:hi]] == 0).sum())
                a, b = slice(lo, mid), slice(lo, hi) if one else slice(mid, hi)
                near = (x[a] @ x[b].T >= least) & (own[at[a]][:, None] | own[at[b]][None, :])
                i, j = np.nonzero(np.triu(near, 1) if one else near)
                if not len(i):
                    continue
                i, j = at[a][i], at[b][j]
                table, cell = int(key[0][at[lo]]), int(key[1][at[lo]])
                for s in range(0, len(i), 65536):
                    p, q = i[s : s + 65536], j[s : s + 65536]
                    new = ~_met_before(cells[p], cells[q], table, cell)
                    p, q = p[new], q[new]
                    members, where = np.unique(np.concatenate([p, q]), return_inverse=True)
                    counts = np.bincount(where, weights=np.concatenate([many[q], many[p]])).astype(np.int64)
                    out.append((ids[members], counts, np.full(len(members), -1)))
                members, where = np.unique(np.concatenate([i, j]), return_inverse=True)
                star = _forest(where[: len(i)], where[len(i) :])
                hung = np.flatnonzero(star != np.arange(len(star)))
                out.append((ids[members[hung]], np.zeros(len(hung), dtype=np.int64), ids[members[star[hung]]]))
        found = [np.concatenate(c) if out else np.zeros(0, dtype=np.int64) for c in (zip(*out, strict=True) if out else ((), (), ()))]
        return pa.table({"id": pa.array(found[0], pa.int64()), "links": pa.array(found[1], pa.int64()), "to": pa.array(found[2], pa.int64())})

    return compared


def _usable(x: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, lattice: Lattice = Lattice()
) -> DataFrame:
    """One row per vector: its key, n_links, component (smallest key reachable) and kept (is the smallest).

    Vectors that are null, zero or have null or non-finite components: no links, a component of their own.
    Vectors of different dimension: never linked.  Equal vectors: linked with each other, and all with the same
    others.  Repeated keys: every row counts as a vector.  Null key: takes part, and is not kept.  Empty table: no
    rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("x"))
    usable = rows.filter(_usable(F.col("x")))
    # Copies collapse with map-side combine; what follows sees each vector once.
    classes = stored(
        usable.groupBy("x").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id())
    )
    kind = classes.schema["x"].dataType.simpleString()
    listed = stored(
        classes.select("id", "x", "n").repartition(spark.sparkContext.defaultParallelism, "id")
        .mapInArrow(_listings(lattice), f"id long, x {kind}, n long, cells array<long>")
    )
    place = F.posexplode(F.col("cells")).alias("_place", "cell")
    per = 1 + lattice.probes
    narrow = listed.select("id", place).select(
        "id", "cell", F.floor(F.col("_place") / per).cast("int").alias("table"), (F.col("_place") % per == 0).alias("own")
    )
    # Cells with a pair to compare, and into how many tiles their lists go.
    lists = narrow.groupBy("table", "cell").agg(F.count(F.lit(1)).alias("_n"), F.max("own").alias("_own")).filter("_n > 1 and _own")
    lists = lists.select(F.col("table").alias("_table"), F.col("cell").alias("_cell"), F.ceil(F.col("_n") / lattice.tile).cast("int").alias("_tiles"))
    tile = F.pmod(F.xxhash64("id"), F.col("_tiles")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_tiles") - 1),
        lambda other: F.struct(
            F.least(F.col("_tile"), other).alias("left"), F.greatest(F.col("_tile"), other).alias("right"),
            (F.col("_tile") > other).cast("int").alias("side"),
        ),
    )
    tiled = (
        narrow.join(lists, (F.col("table") == F.col("_table")) & (F.col("cell") == F.col("_cell")))
        .withColumn("_tile", tile)
        .withColumn("_pair", F.explode(pairs))
        .select("id", "table", "cell", "own", "_pair.*")
    )
    # Bundles keep the number of Python calls down; a tile never spreads over two of them.
    bundles = max(1, -(-listed.count() * lattice.tables * per // 8192))
    wide = tiled.join(listed.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).drop("_id")
    bundle = F.pmod(F.xxhash64("table", "cell", "left", "right"), F.lit(bundles))
    found = stored(
        wide.withColumn("bundle", bundle).groupBy("bundle").applyInArrow(_compared(lattice, least), "id long, links long, to long")
    )
    degrees = found.filter("to < 0").groupBy("id").agg(F.sum("links").alias("_links")).withColumnRenamed("id", "_id")
    joined = components(found.filter("to >= 0"), "id", "to").withColumnRenamed("vertex", "_vertex")
    grouped = (
        classes.join(degrees, F.col("id") == F.col("_id"), "left")
        .join(joined, F.col("id") == F.col("_vertex"), "left")
        .select("x", "first", "n", F.coalesce("_links", F.lit(0)).alias("_links"), F.coalesce("component", "id").alias("_component"))
    )
    firsts = grouped.groupBy("_component").agg(F.min("first").alias("component")).withColumnRenamed("_component", "_c")
    verdict = grouped.join(firsts, F.col("_component") == F.col("_c")).select(
        F.col("x").alias("_x"), (F.col("_links") + F.col("n") - 1).alias("n_links"), "component"
    )
    merged = rows.withColumn("x", F.when(_usable(F.col("x")), F.col("x"))).join(verdict, F.col("x") == F.col("_x"), "left")
    component = F.when(F.col("_x").isNull(), F.col("key")).otherwise(F.col("component"))
    return merged.select(
        "key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
