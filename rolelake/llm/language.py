"""Language identification by nearest centroids.

A text becomes a vector of hashed character n-grams (1 to 3 letters, lower case), weighted by
(1 + ln tf) * idf and scaled to length 1.  Every language has several centroids, from spherical
k-means over a bounded sample of its labelled texts; a text gets the language of the centroid
with the highest cosine.  A text is rejected if its cosine is less than a share of the one at ``slack`` times the distance (1 - cosine)
that nearly all training texts of the language have at its length, whole or cut: the longer a text, the nearer it must be.
Length is the number of distinct n-grams, so a text that repeats a few words is a short one.

Document frequencies cover all learnable documents; only the texts that centroids are fitted to
are a sample, of about ``SAMPLE_PER_LANGUAGE`` distinct texts for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rolelake.shipping import ship

UNKNOWN = "und"
#: Width of the hashed vectors: so many that a long text of another language doesn't fill them.
BUCKETS = 1 << 18
#: Expected number of texts that one language's centroids are fitted to.
SAMPLE_PER_LANGUAGE = 240
CENTROIDS = 4
_ROUNDS = 12
_LEAST_SHARE = 0.05
#: Training texts are cut at so many letters.
_CUTS = tuple(4**k for k in range(2, 10))
#: Numbers of distinct n-grams at which the least cosine is learned, from the texts and cuts between half and twice as many;
#: between them it goes with the logarithm.
_SIZES = tuple(4**k for k in range(2, 9))
_LEAST_TEXTS = 8
#: Of the training texts and cuts at each size, this share may be farther off.
_FAR_SHARE = 0.02
#: Share of that cosine which is enough: texts with much foreign matter (keys, junk, shouting) still have it, other languages don't.
_ENOUGH = 0.4
#: Texts of unrelated scripts stay below this, however short.
_FLOOR = 0.06
#: Long texts are counted in pieces of so many letters, which bounds memory; counts add up over all pieces.
_PIECE = 1 << 17


def _codes(text: str) -> np.ndarray:
    """Letters as code points; any run of other characters is one space."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    other = (code < 65) | ((code > 90) & (code < 97)) | ((code > 122) & (code < 170))
    code[other] = 32
    return code[~(other & np.roll(other, 1))] if len(code) else code


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of a whole text, with their counts."""
    code = _codes(text)
    total = np.zeros(BUCKETS, dtype=np.int64) if len(code) > BUCKETS // 16 else None
    for start in range(0, len(code), _PIECE):
        # Two letters of overlap, so that no n-gram is lost between pieces.
        c = code[max(0, start - 2) : start + _PIECE]
        skip = start - max(0, start - 2)
        grams = [c[skip:] * np.uint64(0x9E3779B1)]
        if len(c) > 1:
            grams.append((c[:-1] * np.uint64(0x85EBCA6B) + c[1:] * np.uint64(0xC2B2AE35))[max(0, skip - 1) :])
        if len(c) > 2:
            grams.append(c[:-2] * np.uint64(0x27D4EB2F) + c[1:-1] * np.uint64(0x165667B1) + c[2:] * np.uint64(0xD3A2646C))
        mixed = np.concatenate(grams)
        mixed ^= mixed >> np.uint64(15)
        mixed *= np.uint64(0x2C1B3C6D)
        mixed ^= mixed >> np.uint64(13)
        mixed = (mixed % np.uint64(BUCKETS)).astype(np.int64)
        if total is None:
            return np.unique(mixed, return_counts=True)
        total += np.bincount(mixed, minlength=BUCKETS)
    if total is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(total)
    return at, total[at]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's vector, of length 1 or without any."""
    at, counts = gram_counts(text)
    values = ((1 + np.log(counts)) * idf[at]).astype(np.float32)
    return at, values / (np.linalg.norm(values) or 1)


@dataclass(frozen=True)
class Model:
    """Fitted weights: bounded by BUCKETS and by languages times CENTROIDS."""

    idf: np.ndarray
    langs: tuple[str, ...]
    centroids: np.ndarray
    least: np.ndarray  #: for each centroid, at each of _SIZES

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and whether the text is rejected, for each text."""
        langs, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        by_bucket = np.ascontiguousarray(self.centroids.T) if known and len(self.langs) else None
        for i in known if by_bucket is not None else []:
            at, values = _vector(texts[i], self.idf)
            cosines = values @ by_bucket[at]
            k = int(cosines.argmax())
            least = np.interp(np.log(len(at)), np.log(_SIZES), self.least[k])
            langs[i], scores[i], rejected[i] = self.langs[k], min(1.0, max(0.0, float(cosines[k]))), cosines[k] < least
        return langs, scores, rejected


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a partition: in how many of its texts each bucket occurs; bucket -1 counts the texts."""
    found, texts = np.zeros(BUCKETS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found[gram_counts(text)[0]] += 1
            texts += 1
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int64()), pa.array([texts, *found[at]], pa.int64())], ["bucket", "n"])


def _nearest(at: np.ndarray, values: np.ndarray, used: np.ndarray, centers: np.ndarray) -> float:
    """Highest cosine of a vector with centers that are given at the buckets ``used``."""
    place = np.minimum(np.searchsorted(used, at), len(used) - 1)
    there = used[place] == at
    return float((centers[:, place[there]] @ values[there]).max())


def _clusters(idf: np.ndarray, centroids: int, slack: float):
    def fit(key: tuple[str], texts: pd.DataFrame) -> pd.DataFrame:
        """Spherical k-means over one language's sample, from seeded random starts; tiny clusters are given up."""
        said = list(texts.sort_values("order")["text"])
        vectors = [_vector(text, idf) for text in said]
        # Only the buckets that the sample has.
        used = np.unique(np.concatenate([at for at, _ in vectors]))
        rows = np.zeros((len(vectors), len(used)), dtype=np.float32)
        for row, (at, values) in zip(rows, vectors, strict=True):
            row[np.searchsorted(used, at)] = values
        centers = rows[np.random.default_rng(1).permutation(len(rows))[:centroids]]
        for left in range(_ROUNDS, 0, -1):
            own = (rows @ centers.T).argmax(axis=1)
            held = np.bincount(own, minlength=len(centers))
            # A cluster of a few odd texts would have no radius to speak of.
            full = held > (0 if left > 2 else _LEAST_SHARE * len(rows))
            sums = np.stack([rows[own == k].sum(axis=0) for k in np.flatnonzero(full if full.any() else held == held.max())])
            length = np.linalg.norm(sums, axis=1, keepdims=True)
            centers = sums / np.where(length > 0, length, 1)
        near = []  # (distinct n-grams, cosine)
        for text in said:
            for part in [text, *(text[:cut] for cut in _CUTS if cut < len(text))]:
                if has_letter(part):
                    at, values = _vector(part, idf)
                    near.append((len(at), _nearest(at, values, used, centers)))
        sizes, cosines = np.array(near).T
        least: list[float] = []
        for size in _SIZES:
            some = cosines[(2 * sizes >= size) & (sizes <= 2 * size)]
            if len(some) >= _LEAST_TEXTS:
                least.append(max(_FLOOR, _ENOUGH * (1 - slack * (1 - float(np.quantile(some, _FAR_SHARE))))))
            else:  # as at the size before
                least.append(least[-1] if least else _FLOOR)
        return pd.DataFrame({
            "lang": key[0], "k": range(len(centers)), "at": [used.tolist()] * len(centers), "centroid": [c.tolist() for c in centers],
            "least": [least] * len(centers),
        })

    return fit


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE, centroids: int = CENTROIDS, slack: float = 1.25,
) -> Model:
    """Learn from the rows with a text that has a letter, and a language.

    The sample of a language takes texts by hash, at a rate of ``per_language`` to its number of
    rows, so the expected sample has that size at any input; equal texts count once.  What reaches the driver is
    the model: BUCKETS frequencies and a few centroids for each language.

    Null texts or languages: not learned from.  Empty table: a model that knows no language.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = rows.select("text").mapInArrow(_document_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # one row per bucket
    buckets, numbers = found["bucket"].to_numpy(), found["n"].to_numpy()
    texts = int(numbers[buckets < 0].sum())
    idf = np.full(BUCKETS, np.log(1 + texts), dtype=np.float32) + 1
    idf[buckets[buckets >= 0]] = np.log((1 + texts) / (1 + numbers[buckets >= 0])) + 1
    # One row per language, as in the model itself; joined, it would deal all texts out by language.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.lit(0.0)
    for name, size in sizes.items():
        rate = F.when(F.col("lang") == name, per_language / size).otherwise(rate)
    order = F.xxhash64(F.lit(1), "text")
    part = F.pmod(order, F.lit(1 << 52)) / F.lit(1 << 52)
    sample = rows.select("lang", "text", order.alias("order")).filter(part < rate).distinct()
    schema = "lang string, k int, at array<int>, centroid array<float>, least array<double>"
    # As Arrow: rows would be an object for every number, in the driver's JVM and in its Python.
    fitted = sample.groupBy("lang").applyInPandas(_clusters(idf, centroids, slack), schema).toArrow().sort_by([("lang", "ascending"), ("k", "ascending")])
    rows = np.zeros((len(fitted), BUCKETS), dtype=np.float32)
    for row, at, centroid in zip(rows, fitted["at"], fitted["centroid"], strict=True):
        row[at.values.to_numpy()] = centroid.values.to_numpy()
    least = np.array(fitted["least"].to_pylist()).reshape(-1, len(_SIZES))
    return Model(idf, tuple(fitted["lang"].to_pylist()), rows, least)


_PREDICTION = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
)


def predict(docs: DataFrame, model: Model, text: str = "text", into: str = "prediction") -> DataFrame:
    """Add a struct column ``into``: lang_pred, score and rejected, from the whole text alone.

    Null text or no letter (or a model that knows no language): ``und``, score 0, rejected.  Equal
    cosines: the first language by code point.  Repeated rows: equal results.  An input column named
    ``into`` is replaced.
    """

    ship(docs.sparkSession)

    @F.pandas_udf(_PREDICTION)
    def predicted(texts: pd.Series) -> pd.DataFrame:
        langs, scores, rejected = model.predict(list(texts))
        return pd.DataFrame({"lang_pred": langs, "score": scores, "rejected": rejected})

    # Not to be computed again below a filter on the result.
    predicted = predicted.asNondeterministic()
    return docs.withColumn(into, predicted(F.col(f"`{text}`").cast("string")))


def learnable(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows that a model may learn from: those whose crc32 of the key mod 4 isn't 2."""
    return docs.filter(~F.coalesce(held_out(key), F.lit(False)))


def held_out(key: str = "doc_id"):
    return F.pmod(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")), F.lit(4)) == 2
