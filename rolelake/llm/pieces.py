"""SentencePiece encoding and decoding with the pieces of a public BPE model.

Matching is done on a suffix array.  The distinct segments of a batch (a segment is a word with the
white space marks before it, or a line break; no piece reaches over its end) are concatenated and indexed; every piece
is searched in the array by bisection, which gives the range of all its occurrences.  Those are the
edges of a lattice over the text; sorted by where they end, they are relaxed from left to right.

The relaxation is the one that merges by rank call for.  The encoding of a prefix is that of a
shorter prefix and one more piece, and a piece fits exactly if, together with the piece before it,
it is encoded as those two.  So of the edges that end at a place exactly one fits, and no scores have to be added up.
Characters that no piece covers become bytes.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from rolelake.shipping import ship

MARK = "▁"
#: Encodings of segments that a task remembers in each of two generations.
_REMEMBERED = 120_000
#: Pairs of pieces whose answer a task remembers, 9 bytes each, and how many are sorted in at a time.
_PAIRS, _LATE = 2_000_000, 20_000
#: Bytes of text that are cut into segments at a time.
_SLICE = 1 << 20
#: Characters that are indexed at a time; a longer segment is indexed by itself.
_INDEXED = 150_000


class Pieces:
    """The pieces of a model file with their numbers and ranks, and the byte pieces."""

    def __init__(self, model_file: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.number = {self.text[i]: i for i in usual}
        self.rank = {self.text[i]: -model.get_score(i) for i in usual}
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(len(self.text)) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = model.unk_id()
        self.first = MARK if model.normalize("a") == MARK + "a" else ""
        spanning = [p for p in self.number if MARK in p.lstrip(MARK)]
        if spanning:
            raise ValueError(f"pieces reach over the end of a word: {spanning[:3]}")
        self.sorted = sorted(self.number)
        self.size = np.array([len(w) for w in self.sorted], dtype=np.int64)
        self.longest = int(self.size.max())
        self.letters = np.zeros((len(self.sorted), self.longest), dtype=np.int64)
        for k, w in enumerate(self.sorted):
            self.letters[k, : len(w)] = np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32)
        self.number_of = np.array([self.number[w] for w in self.sorted], dtype=np.int32)
        # Characters that no longer piece has stand for themselves, so segments can end at them.
        joined = {c for w in self.sorted if len(w) > 1 for c in w}
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        self.segment = re.compile(f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.memory = _Remembered(self)
        self.place_of = {w: k for k, w in enumerate(self.sorted)}
        # Pairs whose answer is known, in order, and the latest ones, which are sorted in when there are many.
        self._pairs, self._fit = np.array([np.iinfo(np.int64).max]), np.zeros(1, dtype=bool)
        self._late: dict[int, bool] = {}

    def normalized(self, text: str | None) -> str:
        """White space marks for spaces, and one before the text."""
        return self.first + text.replace(" ", MARK) if text else ""

    def merged(self, segment: str) -> list[str]:
        """Encoding by merges: the pair with the best rank first, the leftmost of equals."""
        part: list[str | None] = list(segment)
        before, after = list(range(-1, len(part) - 1)), [*range(1, len(part)), -1]
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (rank := self.rank.get(pair := part[i] + part[after[i]])) is not None:
                heapq.heappush(queue, (rank, i, pair))

        for i in range(len(part) - 1):
            offer(i)
        while queue:
            _, i, pair = heapq.heappop(queue)
            if part[i] is None or after[i] < 0 or part[i] + part[after[i]] != pair:
                continue
            gone = after[i]
            part[i], part[gone], after[i] = pair, None, after[gone]
            if after[gone] >= 0:
                before[after[gone]] = i
            offer(before[i])
            offer(i)
        return [p for p in part if p is not None]

    def _fits_alone(self, pair: int) -> bool:
        left, right = divmod(pair, len(self.sorted))
        both = [*([self.sorted[left]] if left >= 0 else []), self.sorted[right]]
        return self.merged("".join(both)) == both

    def fits(self, pairs: np.ndarray) -> np.ndarray:
        """Whether two pieces next to each other are encoded as just these.

        A pair is the first's place in ``sorted`` (-1: nothing before) times their number, plus the second's place.
        """
        at = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
        out, known = self._fit[at], self._pairs[at] == pairs
        for k in np.flatnonzero(~known).tolist():
            pair = int(pairs[k])
            if pair not in self._late:
                self._late[pair] = self._fits_alone(pair)
            out[k] = self._late[pair]
        if len(self._late) > _LATE:
            late = np.fromiter(self._late, dtype=np.int64, count=len(self._late))
            fit = np.fromiter(self._late.values(), dtype=bool, count=len(self._late))
            if len(self._pairs) < _PAIRS:
                late, fit = np.concatenate([self._pairs, late]), np.concatenate([self._fit, fit])
            order = np.argsort(late)
            self._pairs, self._fit, self._late = late[order], fit[order], {}
        return out

    def unknown_numbers(self, character: str) -> list[int]:
        """A character without piece as its bytes."""
        return [self.bytes.get(b, self.unknown) for b in character.encode("utf-8", "surrogatepass")]

    def decoded(self, numbers: list[int]) -> str:
        """The text of an encoding; bytes that are no UTF-8 become replacement characters."""
        if not numbers:
            return ""
        if self.byte_of.keys().isdisjoint(numbers):
            text = "".join(map(self.text.__getitem__, numbers))
        else:
            raw = b"".join(bytes([self.byte_of[i]]) if i in self.byte_of else self.text[i].encode() for i in numbers)
            text = raw.decode("utf-8", "replace")
        return text.removeprefix(self.first).replace(MARK, " ")


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a text in order of their first ``depth`` characters, by doubling."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    reach = 1
    while True:
        shifted = np.zeros_like(rank)
        shifted[: max(0, len(rank) - reach)] = rank[reach:] + 1
        key = rank * (len(rank) + 2) + shifted
        order = np.argsort(key)
        reach *= 2
        if reach >= depth:
            return order
        ordered = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])


def occurrences(text: str, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(place, index in ``pieces.sorted``) of every occurrence of every piece, by bisection in the suffix array."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    order = suffix_order(codes, pieces.longest)
    # All pieces are bisected at once, a character at a time; the range narrows to suffixes that go on alike.
    size, letters = pieces.size, pieces.letters
    low, high = np.zeros(len(size), dtype=np.int64), np.full(len(size), len(order))
    padded = np.concatenate([codes.astype(np.int64), np.full(pieces.longest, -1)])
    for depth in range(pieces.longest):
        open_ = np.flatnonzero((size > depth) & (low < high))
        if not len(open_):
            break
        wanted = letters[open_, depth]
        for bound, add in ((low, 0), (high, 1)):
            lo, hi = low[open_].copy() if add == 0 else start, high[open_].copy()
            while (lo < hi).any():
                mid = (lo + hi) // 2
                less = padded[order[np.minimum(mid, len(order) - 1)] + depth] < wanted + add
                going = lo < hi
                lo, hi = np.where(going & less, mid + 1, lo), np.where(going & ~less, mid, hi)
            if add == 0:
                start = lo
            else:
                low[open_], high[open_] = start, lo
    # 32 bits are enough for places and keep the edges small.
    many = high - low
    within = np.arange(int(many.sum()), dtype=np.int32)
    within += np.repeat((low - (np.cumsum(many) - many)).astype(np.int32), many)
    return order.astype(np.int32)[within], np.repeat(np.arange(len(size), dtype=np.int32), many)


def _relaxed(text: str, begins: np.ndarray, stops: np.ndarray, pieces: Pieces) -> np.ndarray:
    """For each place in the text the piece that the encoding up to it ends with; -1 for a character without piece.

    Edges are relaxed by the distance of their end from the segment's begin, all segments at once.
    """
    # With the separator after each segment.
    begin_of = np.repeat(begins, stops - begins + 1).astype(np.int32)
    stop_of = np.repeat(stops, stops - begins + 1).astype(np.int32)
    place, which = occurrences(text, pieces)
    end = place + pieces.size.astype(np.int32)[which]
    inside = end <= stop_of[place]
    place, which, end = place[inside], which[inside], end[inside]
    distance = end - begin_of[place]
    # Small numbers are sorted by radix.
    order = np.argsort(distance.astype(np.uint16) if distance.max(initial=0) < 1 << 16 else distance, kind="stable")
    place, which, end, distance = place[order], which[order], end[order], distance[order]
    start = place == begin_of[place]
    steps = np.searchsorted(distance, np.arange(1, int(distance.max(initial=0)) + 2))
    last = np.full(len(text) + 1, -1, dtype=np.int64)
    many = len(pieces.sorted)
    for lo, hi in zip(steps[:-1], steps[1:], strict=True):
        if lo == hi:
            continue
        left = np.where(start[lo:hi], -1, last[place[lo:hi]])  # 64 bits
        pairs, back = np.unique(left * many + which[lo:hi], return_inverse=True)
        fit = pieces.fits(pairs)[back]
        last[end[lo:hi][fit]] = which[lo:hi][fit]
    return last


def encoded_segments(segments: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of distinct segments, matched together: all numbers one after another, and how many each has."""
    text = "\0".join(segments) + "\0"  # a separator; edges over it are dropped
    size = np.array([len(s) for s in segments], dtype=np.int64)
    stops = np.cumsum(size + 1) - 1
    begins = stops - size
    last = _relaxed(text, begins, stops, pieces)
    # Runs of marks have pieces of equal rank, for which only the merges themselves tell.
    for k in [k for k, s in enumerate(segments) if s.startswith(MARK + MARK)]:
        at = int(begins[k])
        for piece in pieces.merged(segments[k]):
            at += len(piece)
            last[at] = pieces.place_of.get(piece, -1)
    # Back from every end at once; each round finds one more piece of each segment that isn't through.
    found: list[tuple[np.ndarray, np.ndarray]] = []
    open_, at = np.arange(len(segments)), stops.copy()
    while len(open_ := open_[at[open_] > begins[open_]]):
        found.append((open_, at[open_]))
        piece = last[at[open_]]
        at[open_] -= np.where(piece >= 0, pieces.size[piece], 1)
    if not found:
        return np.zeros(0, dtype=np.int32), np.zeros(len(segments), dtype=np.int64)
    owner, ends = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(ends)
    owner, ends = owner[order], ends[order]
    piece = last[ends]
    unknown = np.flatnonzero(piece < 0)
    spelled = [pieces.unknown_numbers(text[k - 1]) for k in ends[unknown].tolist()]
    width = np.ones(len(piece), dtype=np.int64)
    width[unknown] = [len(x) for x in spelled]
    first = np.cumsum(width) - width
    numbers = np.empty(int(width.sum()), dtype=np.int32)
    known = piece >= 0
    numbers[first[known]] = pieces.number_of[piece[known]]
    for k, x in zip(first[unknown].tolist(), spelled, strict=True):
        numbers[k : k + len(x)] = x
    return numbers, np.bincount(owner, weights=width, minlength=len(segments)).astype(np.int64)


_loaded: dict[str, Pieces] = {}


def _pieces(model_file: str) -> Pieces:
    if model_file not in _loaded:
        _loaded[model_file] = Pieces(model_file)
    return _loaded[model_file]


class _Remembered:
    """Encodings of segments, 4 bytes a number, in two generations; when the young one is full, the old one is forgotten."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, segments: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        if len(young) > _REMEMBERED:
            self.old, self.young = young, {}
            young, old = self.young, self.old
        fresh = []
        for s in set(segments).difference(young):
            if s in old:
                young[s] = old[s]
            else:
                fresh.append(s)
        size = 0
        chunk: list[str] = []
        for k, s in enumerate(fresh):
            chunk.append(s)
            size += len(s) + 1
            if size >= _INDEXED or k == len(fresh) - 1:
                numbers, many = encoded_segments(chunk, self.pieces)
                raw, ends = numbers.astype("<i4").tobytes(), (4 * np.cumsum(many)).tolist()
                young.update(zip(chunk, (raw[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)), strict=True))
                chunk, size = [], 0
        return list(map(young.__getitem__, segments))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Where runs of texts with about so many bytes begin, and how many texts they have; a longer text ends a run."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // _SLICE
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    yield from zip(starts.tolist(), np.diff(starts, append=len(texts)).tolist(), strict=True)


def _encoder(model_file: str, place: int | None):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers of each whole text; segments of a batch that aren't remembered are matched together."""
        pieces = _pieces(model_file)
        for batch in batches:
            rows = batch.column("row")
            texts = batch.column("text") if place is None else rows.field(place)
            for start, many in _slices(texts):
                split = [pieces.segment.findall(pieces.normalized(t)) for t in texts.slice(start, many).to_pylist()]
                flat = pieces.memory.of([s for segments in split for s in segments])
                sizes = np.cumsum([0, *map(len, flat)]) // 4
                ends = sizes[np.cumsum([0, *map(len, split)])]
                ids = np.frombuffer(b"".join(flat), dtype="<i4")
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.slice(start, many), lists], ["row", "ids"])
        # A worker stays alive for tasks of other kinds.
        pieces.memory = _Remembered(pieces)

    return encode


def with_ids(docs: DataFrame, model_file: str, text: str = "text", into: str = "ids") -> DataFrame:
    """The input with the encoding of every whole text as column ``into`` (array of int).

    Null or empty text: no ids.  Repeated rows: equal ids.  Empty table: no rows.  An input column named
    ``into`` is replaced.  ``model_file`` is a path that all executors have.
    """
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c != into]
    # A text that is among the columns kept isn't handed over twice.
    place = kept.index(text) if text in kept and docs.schema[text].dataType == T.StringType() else None
    apart = [F.col(f"`{text}`").cast("string").alias("text")] if place is None else []
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *apart)
    row_type = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(_encoder(model_file, place), f"row {row_type}, ids array<int>")
    return done.select(*[F.col(f"row.`{c}`") for c in kept], F.col("ids").alias(into))


def _decoder(model_file: str):
    @F.pandas_udf(T.StringType())
    def decode(ids: pd.Series) -> pd.Series:
        pieces = _pieces(model_file)
        return ids.map(lambda row: None if row is None else pieces.decoded(row.tolist()))

    return decode


def with_text(encoded: DataFrame, model_file: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The input with the text of every encoding as column ``into``.  Null ids: null.  No ids: empty text."""
    ship(encoded.sparkSession)
    return encoded.withColumn(into, _decoder(model_file)(F.col(f"`{ids}`")))
