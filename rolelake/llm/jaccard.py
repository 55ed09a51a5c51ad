"""Near-duplicate documents by a Jaccard join on word n-grams, with prefix filtering.

Every document is the set of its word n-grams (hashed to 64 bits).  Documents with equal sets
collapse to one representative.  N-grams are put in one global order, rare first; two sets with
similarity t or more must share an n-gram among the first |x| - ceil(t |x|) + 1 of each, so only
those prefixes are joined.  Of the candidates, sets whose sizes are too different (length filter) or
whose places of the shared n-gram leave too little (positional filter) are dropped, pairs are made
distinct, and each pair is verified once, where the suffix filter comes before the full count.

A group of many near copies would meet in every prefix n-gram, with all its pairs.  Components need
far fewer.  First each prefix n-gram's documents are compared with one of them only, the most
central: the one whose n-grams are the most frequent, in a group of copies the text they all come from.
After that, all documents that share a prefix n-gram meet in the group of its leader, and those that aren't in
the leader's component yet are compared with the whole group.  That is done on signatures of parity bits, in
tiles of bounded size; signatures differ in no more bits than the sets do in elements, so they rule pairs out
safely, and only what they leave is verified.  So no link between components is missed; the result is exact
whatever the first step found.

The frequencies that the order rests on are counted over all documents in a table of hashed
counters; its size is fixed, and any order gives the same result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rolelake.llm.components import components
from rolelake.operators.durable import stored
from rolelake.shipping import ship

#: Counters of the frequency table (4 bytes each); it is sent to every task.
COUNTERS = 1 << 18
#: Bits of the bitmaps that spare work; also of fixed size.
BITS = 1 << 24
#: Documents on one side of a tile of the second step, and rows that go into one call.
TILE = 256
BUNDLE = 4096
#: Smallest size of a document's signature, in bits.
LEAST_BITS = 256
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Known(dict):
    """64-bit hashes of words, remembered up to a limit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def grams(text: str | None, n: int, known: dict[bytes, int]) -> np.ndarray:
    """The set of a text as sorted 64-bit numbers: n-grams of its words, or all words as one if there are fewer."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    value = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = (total ^ value[k : len(value) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
    return np.unique(total)


def _digest(found: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None


def _sizes(n: int):
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each document its set's size and digest; last, in how many of them each counter's n-grams occur."""
        known, counters = _Known(), np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            many, digests, places = [], [], []
            for text in batch.column("text"):
                found = grams(text.as_py(), n, known)
                many.append(len(found))
                digests.append(_digest(found))
                places.append((found % np.uint64(COUNTERS)).astype(np.int32))
                if len(places) >= 512:
                    counters += np.bincount(np.concatenate(places), minlength=COUNTERS)
                    places = []
            if places:
                counters += np.bincount(np.concatenate(places), minlength=COUNTERS)
            nothing = pa.nulls(len(many), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(many, pa.int64()), pa.array(digests, pa.string()), nothing, nothing],
                ["key", "n", "digest", "counter", "times"],
            )
        at = np.flatnonzero(counters)
        kind = batch.column("key").type if len(at) else pa.int64()
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), kind), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.string()), pa.array(at), pa.array(counters[at])],
                ["key", "n", "digest", "counter", "times"],
            )

    return sizes


def signature(found: np.ndarray) -> np.ndarray:
    """Parity bits, four or more for each element: every element turns one bit over.

    Two sets differ in at least as many elements as their bits do.  The number of bits is a power of two; of two sizes
    the larger folds to the smaller.
    """
    size = max(LEAST_BITS, 1 << (4 * len(found) - 1).bit_length())
    turned = np.bincount(((found >> np.uint64(20)) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(turned.astype(np.uint8)).view(np.int64)


def differing(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Bits in which each of some signatures differs from each of others; none for sizes more than one folding apart."""
    out = np.zeros((len(xs), len(ys)), dtype=np.int64)
    size_x, size_y = (np.array([len(v) for v in side]) for side in (xs, ys))
    for size in np.union1d(size_x, size_y).tolist():
        i, j = (np.flatnonzero((sizes == size) | (sizes == 2 * size)) for sizes in (size_x, size_y))
        if not len(i) or not len(j):
            continue
        x, y = (
            np.stack([v[k] if len(v[k]) == size else v[k][:size] ^ v[k][size:] for k in some]).view(np.uint64) for v, some in ((xs, i), (ys, j))
        )
        smaller = (size_x[i] == size)[:, None] | (size_y[j] == size)[None, :]
        bits = np.stack([np.bitwise_count(row ^ y).sum(axis=1, dtype=np.int64) for row in x])
        out[np.ix_(i, j)] = np.where(smaller, bits, out[np.ix_(i, j)])
    return out


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _prefixes(n: int, percent: int, counters: np.ndarray):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each document the rarest n-grams of its set, in global order, and how central it is."""
        known = _Known()
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found = grams(text.as_py(), n, known)
                if not len(found):
                    rows.append((None, 0, 0, [], []))
                    continue
                often = counters[(found % np.uint64(COUNTERS)).astype(np.int64)]
                # The number of the n-gram itself breaks ties, alike in every document.
                first = np.lexsort((found, often))[: _prefix_size(len(found), percent)]
                central = int(np.log1p(often).mean() / 45 * 65535)
                rows.append((_digest(found), len(found), central, found[first].view(np.int64), signature(found)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in columns[3:]),
                ],
                ["key", "digest", "n", "central", "prefix", "bits"],
            )

    return prefixes


def _bits(values: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size in which the hashes of all values are set.

    It only spares work: what isn't in it is left out early, what is in it by chance is sorted out later.
    """
    place = F.pmod(F.col(column), F.lit(BITS))
    words = values.select(F.floor(place / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, {BITS}) % 64 as int))").alias("bit"))
    held = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # BITS / 64 rows at most
    bits = np.zeros(BITS // 64, dtype=np.int64)
    bits[held.column("word").to_numpy()] = held.column("bits").to_numpy()
    return np.unpackbits(bits.view(np.uint8), bitorder="little")


def _could_link(percent: int) -> str:
    """Length filter and positional filter on a pair with a shared n-gram at place in one set and place_b in the other."""
    least = f"ceil({percent} * (n + n_b) / {100 + percent}.0D)"
    return (
        f"100 * least(n, n_b) >= {percent} * greatest(n, n_b) and "
        f"least(place, place_b) + least(n - place, n_b - place_b) >= {least}"
    )


def _met(prefixes: DataFrame, percent: int) -> DataFrame:
    """Each document once for every leader that it shares a prefix n-gram with: id, b and whether the pair could link.

    Leaders are rows, too, unless they are alone with all their n-grams.  Documents may come more than once.
    The prefixes are dealt out by n-gram once; there every n-gram's documents come the most central first, so the
    leader is known before the others pass and no group is gathered.
    """
    grams_ = prefixes.select("id", "n", "central", F.posexplode("prefix").alias("place", "gram"))
    central_first = Window.partitionBy("gram").orderBy(F.desc("central"), F.desc("id"))
    led = grams_.select(
        "id", "n", "place", F.lead("id").over(central_first).alias("next"),
        F.first(F.struct(*(F.col(c).alias(f"{c}_b") for c in ("id", "n", "place", "central"))))
        .over(central_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_leader"),
    )
    # Most n-grams occur in one document only: their rows are leaders without a next document.
    led = led.select("id", "n", "place", "next", "_leader.*").withColumnRenamed("id_b", "b").filter("id <> b or next <> b")
    could = F.expr(_could_link(percent)) & (F.col("id") != F.col("b"))
    return led.withColumn("could", could).groupBy("id", "b").agg(
        F.max("could").alias("could"), F.max("central_b").alias("central_b"), F.max("n").alias("n"), F.max("n_b").alias("n_b")
    )


def _texts_of(bits: np.ndarray, n: int):
    packed = np.packbits(bits)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents whose key may be asked for, with the digest of their sets."""
        held, known = np.unpackbits(packed), _Known()
        for batch in batches:
            place = np.mod(batch.column("hash").to_numpy(), BITS)
            some = batch.take(pa.array(np.flatnonzero(held[place])))
            digests = pa.array([_digest(grams(t.as_py(), n, known)) for t in some.column("text")], pa.string())
            yield pa.RecordBatch.from_arrays([some.column("key"), some.column("text"), digests], ["key", "text", "digest"])

    return texts


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have similarity of ``percent`` or more."""
    least = -(-percent * (len(x) + len(y)) // (100 + percent))
    # Suffix filter: elements that lie in different numbers between pivots can't all be shared.
    pivots = y[len(y) // 8 :: max(1, len(y) // 8)]
    parts = [np.diff(np.searchsorted(s, pivots), prepend=0, append=len(s)) for s in (x, y)]
    if np.minimum(*parts).sum() < least:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= least


def _verified(n: int, percent: int):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs that link.  Rows come ordered by b, so its set is made once for a run of pairs."""
        known, last, y = _Known(), None, None
        for batch in batches:
            kept = []
            for k, (b, text, text_b) in enumerate(zip(batch.column("b").to_pylist(), batch.column("text"), batch.column("text_b"), strict=True)):
                if b != last:
                    last, y = b, grams(text_b.as_py(), n, known)
                if linked(grams(text.as_py(), n, known), y, percent):
                    kept.append(k)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return verified


def _links(pairs: DataFrame, rows: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Verify distinct pairs (a, b), once each, on the whole texts of their documents."""
    pairs = stored(pairs)
    kind = rows.schema["key"].dataType.simpleString()
    asked = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    named = stored(
        asked.join(classes.select(F.col("id").alias("_id"), "digest", "first"), F.col("id") == F.col("_id"))
        .select(F.col("digest").alias("_digest"), F.col("first").alias("_first"), "id")
    )
    held = _bits(named.select(F.xxhash64("_first").alias("hash")), "hash")
    texts = rows.select("key", "text", F.xxhash64("key").alias("hash"))
    texts = texts.mapInArrow(_texts_of(held, n), f"key {kind}, text string, digest string")
    # Rows equal in key and set would verify their pairs again; links are made distinct.
    texts = stored(texts.join(named, _is_first()).select("id", "text"))
    one = texts.select(F.col("id").alias("_a"), "text")
    other = texts.select(F.col("id").alias("_b"), F.col("text").alias("text_b"))
    both = pairs.join(one, F.col("a") == F.col("_a")).join(other, F.col("b") == F.col("_b"))
    return stored(both.select("a", "b", "text", "text_b").mapInArrow(_verified(n, percent), "a long, b long").distinct())


def _is_first():
    """A row is the document that stands for its class."""
    return (F.col("digest") == F.col("_digest")) & F.col("key").eqNullSafe(F.col("_first"))


def _compared(percent: int):
    def compared(rows: pa.Table) -> pa.Table:
        """Pairs of different components between the two sides of every tile of a bundle that signatures don't rule out.
        """
        names = ("b", "band", "one", "other", "first", "id", "part", "n", "guest")
        key = {name: rows.column(name).to_numpy() for name in names}
        lists = rows.column("bits").combine_chunks()
        ends_of_bits = np.cumsum(np.asarray(lists.value_lengths()))
        bits = np.split(lists.flatten().to_numpy(), ends_of_bits[:-1])
        order = np.lexsort([key[name] for name in reversed(names[:5])])
        change = np.any([key[name][order][1:] != key[name][order][:-1] for name in names[:4]], axis=0)
        ends = [0, *(np.flatnonzero(change) + 1), len(order)]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            at = order[lo:hi]
            split = int((~key["first"][at]).sum())
            whole, apart = at[:split], at[split:]
            differ = differing([bits[k] for k in apart], [bits[k] for k in whole])
            many, others = key["n"][apart][:, None], key["n"][whole][None, :]
            total = many + others
            near = 100 * np.minimum(many, others) >= percent * np.maximum(many, others)  # length filter
            near &= differ <= total - 2 * -(-percent * total // (100 + percent))
            near &= key["part"][apart][:, None] != key["part"][whole][None, :]
            near &= ~(key["guest"][apart][:, None] & key["guest"][whole][None, :])  # they meet in the band below
            i, j = np.nonzero(near)
            found.append((key["id"][apart[i]], key["id"][whole[j]]))
        a, b = (np.concatenate(c) if found else np.zeros(0, dtype=np.int64) for c in (zip(*found, strict=True) if found else ((), ())))
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return compared


def _apart(met: DataFrame, parts: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) among the documents of each leader's group that are in different components.

    A group is taken by bands of set sizes, so wide that similar sets are in the same or in neighbouring bands:
    every document is in its own band, and a guest in the next.  In a band one side are the
    documents apart from the leader's component, the other side is the whole band, both cut into tiles, so no
    task gets a group whole and equal components aren't compared with themselves.
    """
    own = met.join(parts, F.col("id") == F.col("_vertex"), "left").select("id", "b", "n", F.coalesce("_part", "id").alias("part"))
    led = parts.select(F.col("_vertex").alias("_v"), F.col("_part").alias("_led"))
    own = own.join(led, F.col("b") == F.col("_v"), "left").withColumn("apart", F.col("part") != F.coalesce("_led", "b"))
    # A little wider than the length filter asks, so that rounding of the logarithm can't part a pair.
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent * 1.0001)).cast("int")
    bands = F.inline(F.array(*[F.struct((band + k).alias("band"), F.lit(k == 1).alias("guest")) for k in (0, 1)]))
    own = stored(own.select("id", "b", "part", "apart", bands))
    groups = own.groupBy("b", "band").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("apart").alias("_apart"), F.count_if(~F.col("guest")).alias("_own")
    )
    groups = groups.filter("_n > 1 and _apart > 0 and _own > 0").select(
        F.col("b").alias("_b"), F.col("band").alias("_band"), F.ceil(F.col("_n") / TILE).cast("int").alias("_tiles"),
        F.ceil(F.col("_apart") / TILE).cast("int").alias("_apart_tiles"),
    )
    place = lambda tiles: F.pmod(F.xxhash64("id"), F.col(tiles)).cast("int")
    every = lambda tiles: F.sequence(F.lit(0), F.col(tiles) - 1)
    one = F.transform(every("_tiles"), lambda t: F.struct(place("_apart_tiles").alias("one"), t.alias("other"), F.lit(True).alias("first")))
    other = F.transform(every("_apart_tiles"), lambda t: F.struct(t.alias("one"), place("_tiles").alias("other"), F.lit(False).alias("first")))
    tiles = F.when(F.col("apart"), F.concat(one, other)).otherwise(other)
    tiled = stored(
        own.join(groups, (F.col("b") == F.col("_b")) & (F.col("band") == F.col("_band")))
        .withColumn("_tile", F.explode(tiles)).select("id", "b", "band", "guest", "part", "_tile.*")
    )
    bundles = max(1, -(-tiled.count() // BUNDLE))
    wide = tiled.join(signed.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).drop("_id")
    wide = wide.withColumn("bundle", F.pmod(F.xxhash64("b", "band", "one", "other"), F.lit(bundles)))
    return wide.groupBy("bundle").applyInArrow(_compared(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: its key, n_grams (size of its set) and component (smallest key reachable by links).

    Null text or one without words: an empty set, linked with nothing, a component of its own.  Fewer than
    ``n`` words: one n-gram.  Equal sets: linked.  Null key: takes part; the component is null only if all its keys
    are.  Repeated keys: every row counts as a document.  Empty table: no rows.  Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    found = stored(rows.mapInArrow(_sizes(n), f"key {kind}, n long, digest string, counter long, times long"))
    sized = found.filter(F.col("counter").isNull()).select("key", "n", "digest")
    table = found.filter(F.col("counter").isNotNull()).groupBy("counter").agg(F.sum("times").alias("times")).toArrow()  # COUNTERS rows at most
    counters = np.zeros(COUNTERS, dtype=np.int64)
    counters[table.column("counter").to_numpy()] = table.column("times").to_numpy()

    classes = stored(
        sized.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("key").alias("first"), F.first("n").alias("n"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    named = classes.select(F.col("digest").alias("_digest"), F.col("first").alias("_first"), "id")
    prefixes = rows.mapInArrow(
        _prefixes(n, percent, counters), f"key {kind}, digest string, n long, central long, prefix array<long>, bits array<long>"
    )
    prefixes = stored(prefixes.filter("n > 0").join(named, _is_first()).select("id", "n", "central", "prefix", "bits"))

    met = stored(_met(prefixes, percent))
    signed = prefixes.select("id", "n", "bits").dropDuplicates(["id"])

    # First step: every document with the nearest leader, by signature.
    bits_of = lambda name: prefixes.select(F.col("id").alias(f"_{name}"), F.col("bits").alias(f"bits_{name}"))
    folded = lambda bits, other: F.when(
        F.size(bits) > F.size(other),
        F.zip_with(F.slice(bits, 1, F.size(other)), F.slice(bits, F.size(other) + 1, F.size(other)), lambda x, y: x.bitwiseXOR(y)),
    ).otherwise(F.col(bits))
    differ = F.aggregate(
        F.zip_with(folded("bits_id", "bits_b"), folded("bits_b", "bits_id"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, d: total + d
    )
    stars = (
        met.filter("could").join(bits_of("id"), F.col("id") == F.col("_id")).join(bits_of("b"), F.col("b") == F.col("_b"))
        .withColumn("differ", differ)
        .filter(f"differ <= n + n_b - 2 * ceil({percent} * (n + n_b) / {100 + percent}.0D)")
        .groupBy(F.col("id").alias("a")).agg(F.min(F.struct("differ", -F.col("central_b"), "b")).alias("_best"))
        .select("a", F.col("_best.b").alias("b"))
    )
    links = _links(stars, rows, classes, n, percent)
    # Second step: those that are still apart.
    parts = stored(components(links).withColumnRenamed("vertex", "_vertex").withColumnRenamed("component", "_part"))
    links = links.unionByName(_links(_apart(met.select("id", "b", "n"), parts, signed, percent), rows, classes, n, percent))
    final = components(links).withColumnRenamed("vertex", "_vertex")

    grouped = classes.join(final, F.col("id") == F.col("_vertex"), "left").select("digest", "first", F.coalesce("component", "id").alias("_c"))
    firsts = grouped.groupBy("_c").agg(F.min("first").alias("_component")).withColumnRenamed("_c", "_c2")
    verdict = grouped.join(firsts, F.col("_c") == F.col("_c2")).select(F.col("digest").alias("_digest"), "_component")
    return sized.join(verdict, F.col("digest") == F.col("_digest"), "left").select(
        "key", F.col("n").alias("n_grams"), F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("_component")).alias("component")
    )
