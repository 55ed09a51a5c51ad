"""Token-ID output in training order.

Documents become token ids of a public byte-level BPE, with an end mark after each, and are packed into
sequences of fixed length.  Every sequence has an index; a keyed Feistel permutation of the index,
with cycle-walking to stay in range, gives its global slot.  Slots are cut into ranges, one per shard;
a shard is a run of records of equal size, so the record of a slot is found by arithmetic and
reading can start anywhere.

Sequences are stored once, compressed in large pages, and their index counts from how many each task has made, so
nothing is numbered in one place.  A sequence is shuffled as a compressed record; only the shards hold plain ids.
The index follows the tasks of the scan: the same table read in other splits has another order, under the same key.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rolelake.operators.durable import shared_folder, stored
from rolelake.shipping import ship

#: Fixed value: how the rank file's vocabulary splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROUNDS = 4
#: Bytes of text that are encoded together.
_TOGETHER = 8 << 20


class Tokens:
    """Encoding by a rank file, of many texts at a time."""

    def __init__(self, rank_file: str) -> None:
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.bytes = 2 if self.end < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.bytes}")
        #: How many bytes of text an id stands for.
        self.width = np.zeros(self.end, dtype=np.int64)
        self.width[list(ranks.values())] = [len(r) for r in ranks]

    def raw(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(self.kind)

    def of(self, text: str) -> bytes:
        """Ids of a whole text, without end mark."""
        return self.of_all(pa.array([text], pa.string()))[: -self.bytes]

    def of_all(self, texts: pa.StringArray) -> bytes:
        """Ids of whole texts, none of them null, one after another, an end mark after each."""
        if not len(texts):
            return b""
        # A single space between other characters always begins a new unit, so the parts can be encoded apart: each
        # distinct one once, all of them in one call.
        parts = pc.split_pattern(texts, " ")
        begin, words = parts.offsets.to_numpy(), parts.values.dictionary_encode()
        first, distinct, at = begin[:-1], words.dictionary, words.indices.to_numpy()
        apart = pc.and_(pc.equal(pc.utf8_trim_whitespace(distinct), distinct), pc.not_equal(distinct, ""))
        known = distinct.filter(apart)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(known)], known), " ")[0].as_py()
        known_ids = self._ids(" " + joined if joined else "")
        ends = np.cumsum(pc.binary_length(known).to_numpy().astype(np.int64) + 1)
        known_sizes = np.diff(np.searchsorted(np.cumsum(self.width[known_ids]), ends) + 1, prepend=0) if len(known) else ends
        # Texts that can't be cut come as a whole in the place of their first part.
        apart = apart.to_numpy(zero_copy_only=False)
        whole = np.logical_or.reduceat(~apart[at], first) | (np.diff(begin) < 8)
        firsts = [self._ids((text if uncut else part).as_py()) for text, part, uncut in zip(texts, distinct.take(pa.array(at[first])), whole.tolist(), strict=True)]
        # Entries: the end mark, nothing, the distinct parts, what the texts begin with.
        pool = np.concatenate([np.array([self.end], dtype=self.kind), known_ids, *firsts])
        sizes = np.concatenate([[1, 0], known_sizes, [len(f) for f in firsts]]).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        entry = np.where(apart, np.cumsum(apart) + 1, 1)[at]
        entry[np.repeat(whole, np.diff(begin))] = 1
        entry[first] = 2 + len(known) + np.arange(len(texts))
        entry = np.insert(entry, begin[1:], 0)
        out = []
        for k in range(0, len(entry), 1 << 18):
            many = sizes[some := entry[k : k + (1 << 18)]]
            out.append(pool[np.repeat(starts[some] - (np.cumsum(many) - many), many) + np.arange(many.sum())])
        return np.concatenate(out).tobytes()


_loaded: dict[str, Tokens] = {}


def _tokens(rank_file: str) -> Tokens:
    if rank_file not in _loaded:
        _loaded[rank_file] = Tokens(rank_file)
    return _loaded[rank_file]


def _packer(rank_file: str, length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sequences of one task: (place, n_tokens, ids); the last is filled up with end marks."""
        tokens = _tokens(rank_file)
        record, end = length * tokens.bytes, tokens.end.to_bytes(tokens.bytes, "little")
        place, rest = 0, b""

        def rows(data: bytes, first: int) -> pa.RecordBatch:
            records = [data[k : k + record] for k in range(0, len(data), record)]
            counts = [len(r) // tokens.bytes for r in records]
            filled = [r + end * (length - c) for r, c in zip(records, counts, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(range(first, first + len(filled)), pa.int64()), pa.array(counts, pa.int32()), pa.array(filled, pa.binary())],
                ["place", "n_tokens", "ids"],
            )

        for batch in batches:
            texts = batch.column("text")
            texts = texts.filter(pc.greater(pc.binary_length(texts), 0))
            till = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // _TOGETHER
            cuts = [0, *(np.flatnonzero(np.diff(till)) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                rest += tokens.of_all(texts.slice(lo, hi - lo))
                whole = len(rest) // record * record
                if whole:
                    yield rows(rest[:whole], place)
                    place, rest = place + whole // record, rest[whole:]
        if rest:
            yield rows(rest, place)

    return pack


def _mixed(values: np.ndarray, key: int, turn: int) -> np.ndarray:
    """Round function of the network: 64 well-mixed bits."""
    h = values.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def slots(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """The permutation of 0 .. total - 1 under a key, at some indices.

    The network permutes the smallest range of 4**k numbers that holds ``total``.  A result out of range is
    permuted again until it is inside; as over a quarter of the numbers are inside (or all of 4), walks are short.
    """
    half = max(1, -(-(total - 1).bit_length() // 2))
    low, half = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & low
        for turn in range(ROUNDS):
            left, right = right, left ^ (_mixed(right, key, turn) & low)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= total]
    return out.astype(np.int64)


def packed(docs: DataFrame, rank_file: str, length: int, text: str = "text") -> DataFrame:
    """Sequences of ``length`` ids: task, place, n_tokens and ids (little-endian numbers of equal size).

    Null and empty texts: no tokens.  Repeated rows: as often as they come.  A long text goes over as many
    sequences as it needs.  The last sequence of a task is filled up with end marks, ``n_tokens`` of it are text.
    Empty table: no rows.  Other columns are not read.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    made = texts.mapInArrow(_packer(rank_file, length), "place long, n_tokens int, ids binary")
    numbered, path = made.withColumn("task", F.spark_partition_id()), shared_folder(docs.sparkSession)
    numbered.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(numbered.schema).parquet(path)


@F.pandas_udf(T.BinaryType())
def _squeezed(ids: pd.Series) -> pd.Series:
    squeeze = zstandard.ZstdCompressor(level=3, write_checksum=False)
    return pd.Series([squeeze.compress(i) for i in ids], dtype=object)


@F.pandas_udf(T.BinaryType())
def _plain(ids: pd.Series) -> pd.Series:
    plain = zstandard.ZstdDecompressor()
    return pd.Series([plain.decompress(i) for i in ids], dtype=object)


def in_training_order(sequences: DataFrame, shard_records: int, key: int = 1) -> DataFrame:
    """Sequences with ``slot``, ``shard`` and ``record`` (place in the shard), one partition per shard, in order."""
    return _placed(sequences, shard_records, key).withColumn("ids", _plain("ids"))


def _placed(sequences: DataFrame, shard_records: int, key: int) -> DataFrame:
    """As ``in_training_order``, with compressed ids."""
    ship(sequences.sparkSession)
    counts = sequences.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("task").alias("_task"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))

    @F.pandas_udf(T.LongType())
    def slot_of(index: pd.Series) -> pd.Series:
        return pd.Series(slots(index.to_numpy(), total, key))

    # One row of 12 bytes for each task that packed sequences, some MB for a million tasks.
    indexed = sequences.join(F.broadcast(starts), F.col("task") == F.col("_task")).withColumn("slot", slot_of(F.col("_start") + F.col("place")))
    placed = indexed.select(
        "slot", F.expr(f"cast(slot div {shard_records} as int)").alias("shard"), (F.col("slot") % shard_records).alias("record"), "n_tokens",
        _squeezed("ids").alias("ids"),
    )
    shards = max(1, -(-total // shard_records))
    return placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Write every shard as one file of records of equal size; returns shard, path, records and stride.

    ``folder``: a path or URI that all executors reach.  A file appears under its name only when it is
    complete, so a task that is run again does no harm.  Record r of a shard begins at byte r * stride.
    """
    ship(ordered.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, records, stride = None, 0, 0
        for batch in batches:
            for k in range(len(batch) if shard is None else 0):
                shard = batch.column("shard")[k].as_py()
                system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
                system.create_dir(root, recursive=True)
                draft = f"{root}/.{shard:06d}.{uuid.uuid4().hex}"
                out = system.open_output_stream(draft)
                break
            for ids in batch.column("ids"):
                out.write(ids.as_buffer())
                stride = len(ids.as_py())
            records += len(batch)
        if shard is not None:
            out.close()
            path = f"{root}/shard-{shard:06d}.bin"
            system.move(draft, path)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "records": [records], "stride": [stride]})

    return stored(ordered.select("shard", "ids").mapInArrow(write, "shard int, path string, records long, stride long"))


def read_shards(written: DataFrame, folder: str, rank_file: str, length: int, shard_records: int) -> DataFrame:
    """The records of written shards: slot, shard, record, n_tokens and ids, as ``in_training_order`` gives them.

    A text ends with one end mark and none is without tokens, so further marks at a record's end fill it up.
    """
    ship(written.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(rank_file)
        system = fs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else fs.LocalFileSystem()
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_stream(row["path"]) as data:
                    for first in range(0, row["records"], 256):
                        n = min(256, row["records"] - first)
                        raw = data.read(n * row["stride"])
                        text = np.frombuffer(raw, dtype=f"<u{tokens.bytes}").reshape(n, length)[:, ::-1] != tokens.end
                        marks = np.where(text.any(axis=1), text.argmax(axis=1), length)
                        record = np.arange(first, first + n)
                        yield pa.RecordBatch.from_pydict({
                            "slot": pa.array(row["shard"] * shard_records + record, pa.int64()), "shard": pa.array([row["shard"]] * n, pa.int32()),
                            "record": pa.array(record, pa.int64()), "n_tokens": pa.array(length - np.maximum(0, marks - 1), pa.int32()),
                            "ids": pa.array([raw[k * row["stride"] : (k + 1) * row["stride"]] for k in range(n)], pa.binary()),
                        })

    # One task for each file.
    dealt = written.repartitionById(max(1, written.count()), F.col("shard"))
    return dealt.mapInArrow(read, "slot long, shard int, record long, n_tokens int, ids binary")


def read_from(folder: str, slot: int, shard_records: int, stride: int) -> Iterator[bytes]:
    """Records in training order from a slot on, as a trainer that resumes reads them.

    The slot's file is opened at its record; the files before are not touched.  Ends with the last record; a slot
    past it gives none.
    """
    if slot < 0:
        raise ValueError("slots count from 0")
    system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    shard, record = divmod(slot, shard_records)
    while system.get_file_info(path := f"{root}/shard-{shard:06d}.bin").type == fs.FileType.File:
        with system.open_input_file(path) as data:
            data.seek(min(record * stride, data.size()))
            while ids := data.read(stride):
                yield ids
        shard, record = shard + 1, 0
