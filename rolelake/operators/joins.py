"""Join helpers that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A lookup table up to this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000
SALTS = 16
# Up to this many 8-byte keys are broadcast to thin out a large table before a join.
PREFILTER_ROWS = 2_000_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True where ``df`` has at most ``rows`` rows.

    A plain count: a limit would first bring the limited rows of all tasks into one.
    """
    return df.count() <= rows


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    spread_by: str,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join facts to a lookup table whose size is checked first.

    A small lookup is broadcast, so the facts are not shuffled.  A large one is repeated
    once per salt and joined on (key, salt); ``spread_by``, a column of the facts with
    many values, spreads the rows of a hot key over the salts.
    """
    if is_small(lookup, broadcast_rows):
        return facts.join(F.broadcast(lookup), on, how)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    salted_facts = facts.withColumn("_salt", salt)
    salted_lookup = lookup.withColumn("_salt", F.explode(F.array(*map(F.lit, range(salts)))))
    return salted_facts.join(salted_lookup, [on, "_salt"], how).drop("_salt")


def rows_already_in(
    batch: DataFrame,
    existing: DataFrame,
    key: str | Sequence[str],
    prefilter_rows: int = PREFILTER_ROWS,
) -> DataFrame:
    """Distinct keys of ``batch`` that ``existing`` holds too.

    ``existing`` may be very large.  While the batch is of bounded size, 8-byte hashes of its
    keys are broadcast, so that only rows of ``existing`` that may match are shuffled; the
    join on the keys themselves then decides.  A larger batch is joined by shuffle alone.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stored = existing.select(*keys)
    if is_small(batch.select(*keys), prefilter_rows):
        hashes = batch.select(F.xxhash64(*keys).alias("_hash")).distinct()
        stored = (
            stored.withColumn("_hash", F.xxhash64(*keys))
            .join(F.broadcast(hashes), "_hash", "left_semi")
            .drop("_hash")
        )
    return stored.join(batch.select(*keys).distinct(), keys, "left_semi").distinct()


def rows_with_key_in(
    df: DataFrame, wanted: DataFrame, key: str, broadcast_rows: int = PREFILTER_ROWS
) -> DataFrame:
    """Rows whose ``key``, a number, is wanted; a bounded set of keys is broadcast."""
    keys = wanted.select(key)
    return df.join(F.broadcast(keys) if is_small(keys, broadcast_rows) else keys, key, "left_semi")


def absent_rows(batch: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key does not occur in ``existing``."""
    keys = [key] if isinstance(key, str) else list(key)
    return batch.join(rows_already_in(batch, existing, keys), keys, "left_anti")
