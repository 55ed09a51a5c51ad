"""Suffix-array dedup: bytes that repeat an earlier document's, found by prefix doubling.

A rank stands for the first 1, 2, 4 .. bytes at a position; positions with equal pairs of ranks, one rank further on, have
equal prefixes of twice the length, and the pair makes the next rank.  Texts are at hand, so up to 16 bytes a task
makes ranks by itself; from then on the pairs of all documents are dealt out and sorted together and positions whose pair
no other document has drop out: at 16 and 32 bytes, at 39 (two ranks of 32 that overlap) and at the whole length of 50.

Ranks are 64-bit prints, which are equal for equal bytes; their order is not that of the bytes, which nothing here needs.
Four things keep the sorted rows few:

* Of the positions in a window of the whole length, the one of least 16-byte rank stands for it (its anchor); two equal
  windows have the same one.  About one position in 18 is an anchor.
* Windows that follow each other with the same anchor are a run.  Equal runs, as in copies, are settled as a whole.
* A window has 32 bytes inside that end or begin with its anchor.  Runs that share neither with another document's, which only met at
  16 bytes by chance, are left alone.
* Of the runs left, each window asks for one 39-byte rank: at its anchor, or 12 or 24 bytes before, as far as is inside.

Runs, and later windows, are sorted in parts by rank, one part after the other, so that the rows of only one are on disk.

Two different strings are taken for equal only if 128 bits agree by chance.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rolelake.llm.places import dropped, freed
from rolelake.operators.durable import stored
from rolelake.shipping import ship

LENGTH = 50
#: Bytes that a task looks at in one go: few enough that all arrays over them stay in the processor's cache.
_AT_ONCE = 1 << 16
#: Rows that a task hands over in one go, at least.
_BATCH = 1 << 16
#: Rows dealt out by a key that a task holds before it looks which ones it can settle.
_HELD = 1 << 20
#: Parts of all anchors, and of all windows that are left: each is sorted together by itself, so that only its rows are on disk at a time.
_PARTS = 2
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits spread over all of them, different ones for different ones."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


#: Ranks of single bytes.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


def doubled(data: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Ranks of all positions for 1, 2, 4 .. up to ``size`` bytes, each from pairs of the one before."""
    ranks, length = _BYTES[data], 1
    while True:
        yield length, ranks
        if length * 2 > size:
            return
        further = np.uint64(pow(int(_BASE), length, 1 << 64))
        ranks, length = ranks[: max(0, len(ranks) - length)] * further + ranks[length:], length * 2


def anchor_size(length: int) -> int:
    """Bytes in an anchor: the largest power of two that fits three times."""
    return 1 << ((length // 3).bit_length() - 1)


def _pair_of(data_ranks: dict[int, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The pair of ranks that makes the rank of ``length`` bytes, at every position."""
    half = _half(length)
    ranks = data_ranks[half]
    count = max(0, len(ranks) - (length - half))
    return ranks[:count], ranks[length - half :]


def _half(length: int) -> int:
    return 1 << (length.bit_length() - 1)


def key_step(length: int) -> int:
    """Windows ask for a rank at their anchor or one or two such steps before."""
    return (length - anchor_size(length)) // 3 + 1


def _windows(data: np.ndarray, length: int, anchors_only: bool = False) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Ranks of the sizes that are asked for at all positions, and the least rank of anchor size in each window."""
    size = anchor_size(length)
    asked = (size,) if anchors_only else (size, 2 * size, _half(length), _half(length - key_step(length) + 1))
    ranks = {n: mixed(r) for n, r in doubled(data, max(asked)) if n in asked}
    least, span, wanted = ranks[size], 1, length - size + 1
    while span * 2 <= wanted:
        least, span = np.minimum(least[: max(0, len(least) - span)], least[span:]), span * 2
    if wanted > span:
        least = np.minimum(least[: max(0, len(least) - wanted + span)], least[wanted - span :])
    return ranks, least


def runs_of(
    data: np.ndarray, offsets: np.ndarray, length: int, at_once: int = _AT_ONCE, anchors_only: bool = False, part: int = 0, parts: int = 1
) -> Iterator[dict[str, np.ndarray]]:
    """Runs of the texts between offsets: text (its number), start (in the text), n (windows), anchor, digest, sides.

    A run is cut by its contents alone, not by where a task's look ends.  With ``anchors_only`` digests and sides mean nothing.
    Only runs whose anchor is in one part of all anchors are looked for.
    """
    end, held = int(offsets[-1]), None
    for low in range(int(offsets[0]), end, at_once):
        piece = data[low : min(low + at_once + length - 1, end)]
        if len(piece) < length:
            break
        ranks, least = _windows(piece, length, anchors_only)
        count = len(least)
        first = int(np.searchsorted(offsets, low, "right")) - 1
        last = int(np.searchsorted(offsets, low + count - 1, "right")) - 1
        inside = np.clip(offsets[first : last + 2], low, low + count)
        text = np.repeat(np.arange(first, last + 1), np.diff(inside))
        fits = np.flatnonzero(np.arange(low + length, low + length + count) <= offsets[text + 1])
        if not len(fits):
            continue
        text, anchor = text[fits], least[fits]
        begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
        sizes = np.diff(begins, append=len(fits))
        if parts > 1:
            mine = anchor[begins] % np.uint64(parts) == part
            fits, begins, sizes = fits[np.repeat(mine, sizes)], begins[mine], sizes[mine]
            if not len(fits):
                continue
        text, anchor, begins = text[begins], anchor[begins], np.cumsum(sizes) - sizes
        first, last = fits[begins], fits[begins + sizes - 1]
        runs = {"text": text, "at": first + low, "n": sizes, "anchor": anchor}
        if anchors_only:
            runs |= {"sum": anchor, "head": anchor, "place": first, "sides": sizes}
        else:
            one, other = _pair_of(ranks, length)
            whole = mixed(one[fits] * _BASE + other[fits])
            runs |= {"sum": np.add.reduceat(whole, begins), "head": whole[begins], **_sides(ranks, anchor, first, last, length)}
        runs["place"] = runs["place"] + low
        if held is not None:
            if held["text"] == runs["text"][0] and held["anchor"] == runs["anchor"][0] and held["at"] + held["n"] == runs["at"][0]:
                for name in ("n", "sum"):
                    runs[name][:1] += held[name]
                runs["sides"][0] = runs["sides"][0] | held["sides"] if held["place"] == runs["place"][0] else _SEVERAL
                for name in ("at", "head", "place"):
                    runs[name][0] = held[name]
            else:
                yield _finished({name: np.array([v]) for name, v in held.items()}, offsets)
        held = {name: v[-1] for name, v in runs.items()}
        yield _finished({name: v[:-1] for name, v in runs.items()}, offsets)
    if held is not None:
        yield _finished({name: np.array([v]) for name, v in held.items()}, offsets)


def _finished(runs: dict[str, np.ndarray], offsets: np.ndarray) -> dict[str, np.ndarray]:
    digest = mixed(runs["sum"] + runs["n"].astype(np.uint64) * _BASE + mixed(runs["head"]))
    return {
        "text": runs["text"], "start": runs["at"] - offsets[runs["text"]], "n": runs["n"], "anchor": runs["anchor"].view(np.int64), "digest": digest.view(np.int64),
        "sides": runs["sides"],
    }


#: Sides of a run whose anchor is in it several times, and of a run that is covered for certain.
_SEVERAL, _COVERED = -1, -2


def _sides(ranks: dict[int, np.ndarray], anchor: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Where the anchor of each run (its first and last window) is, and 31 bits of the ranks of twice its size that end and begin with it.

    A window whose anchor is in its second half has the one inside, others the other: runs without an equal one have no equal window.
    A rank that no window of the run has inside is left out, as 0.
    """
    size = anchor_size(length)
    around = np.lib.stride_tricks.sliding_window_view(ranks[size], length - size + 1)
    place, once = first, np.ones(len(first), dtype=bool)
    for k, at in enumerate((first, last)):
        same = around[at] == anchor[:, None]
        found = at + same.argmax(axis=1)
        place = found if k == 0 else place
        once &= (found == place) & (np.count_nonzero(same, axis=1) == 1)
    half = (length - size + 1) // 2
    return {"place": place, "sides": np.where(once, _side_marks(ranks[2 * size], place, size, place - first >= half, place - last < half), _SEVERAL)}


def _side_marks(double: np.ndarray, place: np.ndarray, size: int, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    marks = [np.where(used, double[np.where(used, at, 0)] >> np.uint64(33) | np.uint64(1), np.uint64(0)) for used, at in ((before, place - size), (after, place))]
    return (marks[0] << np.uint64(32) | marks[1]).view(np.int64)


def _several_sides(data: np.ndarray, at: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of runs with their anchor several times (where they begin, windows): the different sides of their windows, as (run, sides)."""
    size = anchor_size(length)
    pieces = -(-n // _AT_ONCE)
    run = np.repeat(np.arange(len(n)), pieces)
    begin = (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * _AT_ONCE
    counts = np.minimum(n[run] - begin, _AT_ONCE)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(counts + length - 1) // _AT_ONCE)) + 1), len(run)]
    found = []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        bytes_, offsets = _gathered(data, at[run[low:high]] + begin[low:high], counts[low:high] + length - 1)
        ranks, least = _windows(bytes_, length)
        text = np.repeat(np.arange(low, high), np.diff(offsets))[: len(least)]
        fits = np.flatnonzero(np.arange(length, length + len(least)) <= offsets[text - low + 1])
        place = _first_least(ranks[size], length - size + 1)[fits]
        before = place - fits >= (length - size + 1) // 2
        own, sides = run[text[fits]], _side_marks(ranks[2 * size], place, size, before, ~before)
        order = np.lexsort([sides, own])
        own, sides = own[order], sides[order]
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (sides[1:] != sides[:-1])])
        found.append((own[fresh], sides[fresh]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _first_least(ranks: np.ndarray, wanted: int) -> np.ndarray:
    """Where the first of the least ranks of every ``wanted`` positions is."""
    values, at, span = ranks, np.arange(len(ranks)), 1
    while span < wanted:
        shift = min(span, wanted - span)
        count = max(0, len(values) - shift)
        first = values[:count] <= values[shift:]
        values, at, span = np.where(first, values[:count], values[shift:]), np.where(first, at[:count], at[shift:]), span + shift
    return at


def keyed_parts(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Windows of strings, parted by the position that stands for them: text, at, n, and the pair of ranks of that position."""
    size, step = anchor_size(length), key_step(length)
    ranks, least = _windows(data, length)
    one, other = _pair_of(ranks, length - step + 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    fits = np.flatnonzero(np.arange(length, length + len(least)) <= offsets[text + 1]) if len(least) else np.array([], np.int64)
    if not len(fits):
        return {name: np.array([], np.int64) for name in ("text", "at", "n", "one", "other")}
    place = _first_least(ranks[size], length - size + 1)[fits] - fits
    key = fits + place % step
    begins = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (text[fits][1:] != text[fits][:-1])]))
    at = key[begins]
    return {
        "text": text[fits][begins], "at": fits[begins], "n": np.diff(begins, append=len(fits)), "one": one[at].view(np.int64), "other": other[at].view(np.int64),
    }


def spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of intervals, as maximal ones in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return list(zip(starts[fresh].tolist(), ends[np.append(fresh[1:] - 1, len(ends) - 1)].tolist(), strict=True))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each value begins."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    return np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.array([], np.uint8), offsets


Batches = Iterator[pa.RecordBatch]


def _gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of the data one after another, and where each begins."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])], offsets


def _found(batch: pa.RecordBatch, length: int, part: int, parts: int) -> Iterator[dict[str, np.ndarray]]:
    """The runs of a batch of texts, many at a time."""
    held: list[dict[str, np.ndarray]] = []
    for runs in runs_of(*_bytes_of(batch.column("text")), length, part=part, parts=parts):
        held.append(runs)
        if sum(len(r["n"]) for r in held) >= _BATCH:
            yield {name: np.concatenate([r[name] for r in held]) for name in held[0]}
            held = []
    if held:
        yield {name: np.concatenate([r[name] for r in held]) for name in held[0]}


_RUN = ("anchor", "digest", "sides", "doc", "print", "start", "n")


def _runs(length: int, part: int, parts: int) -> Callable[[Batches], Batches]:
    """The runs whose anchor is in one part of all anchors; one with its anchor several times comes once for each of its sides."""

    def runs(batches: Batches) -> Batches:
        for batch in batches:
            docs, prints = (batch.column(c).to_numpy() for c in ("doc", "print"))
            data, begins = _bytes_of(batch.column("text"))
            for found in _found(batch, length, part, parts):
                several = np.flatnonzero(found["sides"] == _SEVERAL)
                if len(several):
                    own, sides = _several_sides(data, begins[found["text"][several]] + found["start"][several], found["n"][several], length)
                    once = np.flatnonzero(found["sides"] != _SEVERAL)
                    found = {c: np.concatenate([v[once], sides if c == "sides" else v[several[own]]]) for c, v in found.items()}
                found |= {"doc": docs[found["text"]], "print": prints[found["text"]]}
                found = _marked(found, ("digest", "anchor"), "sides", "anchor")
                yield pa.RecordBatch.from_arrays([pa.array(found[c].astype(np.int64)) for c in _RUN], list(_RUN))

    return runs


def _alike(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows that share the first key: their numbers, ordered by all keys and doc; the least and the largest doc with the same keys."""
    order = np.argsort(keys[0])
    equal = keys[0][order[1:]] == keys[0][order[:-1]]
    none = [False] if len(order) else []
    order = order[np.concatenate([none, equal]).astype(bool) | np.concatenate([equal, none]).astype(bool)]
    order = order[np.lexsort([doc[order], *(k[order] for k in keys)])]
    fresh = np.zeros(len(order), dtype=bool)
    fresh[:1] = True
    for k in keys:
        fresh[1:] |= k[order[1:]] != k[order[:-1]]
    begins = np.flatnonzero(fresh)
    sizes = np.diff(begins, append=len(order))
    ordered = doc[order]
    return order, ordered, np.repeat(ordered[begins], sizes), np.repeat(ordered[begins + sizes - 1], sizes)


def _later(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Which rows have the same keys as a row of a smaller doc."""
    order, own, least, _ = _alike(doc, *keys)
    found = np.zeros(len(doc), dtype=bool)
    found[order] = own > least
    return found


def _met(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Which rows have the same keys as a row of another doc."""
    order, _, least, most = _alike(doc, *keys)
    found = np.zeros(len(doc), dtype=bool)
    found[order] = least < most
    return found


def _marked(rows: dict[str, np.ndarray], keys: tuple[str, ...], mark: str, dealt: str) -> dict[str, np.ndarray]:
    """Rows at hand, with those marked as covered that a smaller doc among them has, too.

    These need no others any more; they are dealt out by a number of their own, so that a passage of very many documents is spread.
    """
    covered = _later(rows["doc"], *(rows[k] for k in keys))
    own = mixed((rows["print"] + rows["start"]).view(np.uint64)).view(np.int64)
    return rows | {mark: np.where(covered, _COVERED, rows[mark]), dealt: np.where(covered, own, rows[dealt])}


def _left(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Which runs may have a window of another document's run; none of them equals a run of an earlier document."""
    anchor, sides, doc = (rows[c] for c in ("anchor", "sides", "doc"))
    left = np.zeros(len(doc), dtype=bool)
    for side in (sides >> 32, sides & 0xFFFFFFFF):
        having = np.flatnonzero(side)
        left[having[_met(doc[having], side[having], anchor[having])]] = True
    return left


def _sliced(columns: list[np.ndarray], names: list[str]) -> Batches:
    for low in range(0, len(columns[0]), _BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(c[low : low + _BATCH]) for c in columns], names)


def _settled(batches: Batches, keys: tuple[str, ...], mark: str, covered: Callable, rest: Callable | None = None) -> Batches:
    """Rows dealt out by a key: those that a smaller doc has, too, as ``covered`` makes them; of the others what ``rest`` makes.

    Only the rows of the least docs so far are held, however many rows a key has.
    """
    held: dict[str, np.ndarray] = {}
    waiting: list[dict[str, np.ndarray]] = []
    most, count = _HELD, 0
    for batch in batches:
        rows = {c: batch.column(c).to_numpy() for c in batch.schema.names}
        sure = rows[mark] == _COVERED
        yield from covered({c: v[sure] for c, v in rows.items()})
        rows = {c: v[~sure] for c, v in rows.items()}
        waiting.append(rows)
        count += len(rows["doc"])
        if count > most:
            held, later = _parted(waiting, keys)
            yield from covered(later)
            waiting, count = [held], len(held["doc"])
            most = max(most, 2 * count)
    if waiting:
        held, later = _parted(waiting, keys)
        yield from covered(later)
        if rest is not None:
            yield from rest(held)


def _parted(waiting: list[dict[str, np.ndarray]], keys: tuple[str, ...]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    rows = {c: np.concatenate([w[c] for w in waiting]) for c in waiting[0]}
    later = _later(rows["doc"], *(rows[k] for k in keys))
    return {c: v[~later] for c, v in rows.items()}, {c: v[later] for c, v in rows.items()}


def _judged(batches: Batches) -> Batches:
    """Of runs dealt out by anchor: those that an earlier document has (whole), and those that may share windows with others."""
    names = ["doc", "print", "start", "n", "whole"]

    def out(rows: dict[str, np.ndarray], whole: bool) -> Batches:
        return _sliced([*(rows[c] for c in names[:4]), np.full(len(rows["doc"]), whole)], names)

    def rest(rows: dict[str, np.ndarray]) -> Batches:
        left = _left(rows)
        return out({c: v[left] for c, v in rows.items()}, False)

    return _settled(batches, ("digest", "anchor"), "sides", lambda rows: out(rows, True), rest)


def _repeated(length: int) -> Callable[[Batches], Batches]:
    """Of windows dealt out by rank: those that an earlier document has."""

    def out(rows: dict[str, np.ndarray]) -> Batches:
        return _sliced([rows["doc"], rows["print"], rows["start"], rows["start"] + length], ["doc", "print", "start", "end"])

    return lambda batches: _settled(batches, ("one", "other"), "mark", out)


def _strings(length: int) -> Callable[[Batches], Batches]:
    """The bytes of documents' runs, parted: doc, print, start, string, one, other."""

    def strings(batches: Batches) -> Batches:
        for batch in batches:
            data, begins = _bytes_of(batch.column("text"))
            lists = batch.column("runs")
            owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
            starts, counts = (np.asarray(lists.flatten().field(k)) for k in (0, 1))
            # So many runs at a time that their bytes are looked at in one go.
            slices = np.cumsum(counts + length - 1) // _AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(slices)) + 1), len(starts)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                own, start = owner[low:high], starts[low:high]
                bytes_, offsets = _gathered(data, begins[own] + start, counts[low:high] + length - 1)
                parts = keyed_parts(bytes_, offsets, length)
                text = parts["text"]
                values, ends = _gathered(bytes_, parts["at"], parts["n"] + length - 1)
                binary = pa.Array.from_buffers(pa.binary(), len(text), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])
                same = [pa.array(batch.column(c).to_numpy()[own[text]]) for c in ("doc", "print")]
                place = pa.array(start[text] + parts["at"] - offsets[text])
                yield pa.RecordBatch.from_arrays(
                    [*same, place, binary, pa.array(parts["one"]), pa.array(parts["other"])], ["doc", "print", "start", "string", "one", "other"]
                )

    return strings


_WINDOW = ("doc", "print", "start", "one", "other", "mark")


def _pairs(length: int, part: int, parts: int) -> Callable[[Batches], Batches]:
    """Every window of the strings, with its pair of ranks, if that is in one part of all pairs."""

    def pairs(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = _bytes_of(batch.column("string"))
            data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            ranks, least = _windows(data, length)
            one, other = _pair_of(ranks, length)
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
            fits = np.flatnonzero((np.arange(length, length + len(least)) <= offsets[text + 1]) & (one[: len(least)] % np.uint64(parts) == part))
            own = text[fits]
            docs, prints, starts = (batch.column(c).to_numpy()[own] for c in ("doc", "print", "start"))
            found = {"doc": docs, "print": prints, "start": starts + fits - offsets[own], "one": one[fits].view(np.int64), "other": other[fits].view(np.int64)}
            found = _marked(found | {"mark": np.zeros(len(fits), np.int64)}, ("one", "other"), "mark", "one")
            yield pa.RecordBatch.from_arrays([pa.array(found[c]) for c in _WINDOW], list(_WINDOW))

    return pairs


def _merged(batches: Batches) -> Batches:
    """Overlapping or touching stretches of one text as one; a text's are dealt to one task."""
    names = ("doc", "print", "start", "end")
    held: list[list[np.ndarray]] = []
    most, count = _HELD, 0
    for batch in batches:
        held.append([batch.column(n).to_numpy() for n in names])
        count += len(batch)
        if count > most:
            held = [_united(*map(np.concatenate, zip(*held, strict=True)))]
            count = len(held[0][0])
            most = max(most, 2 * count)
    if held:
        yield from _sliced(_united(*map(np.concatenate, zip(*held, strict=True))), list(names))


def _united(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    order = np.lexsort([start, mark, doc])
    doc, mark, start, end = (c[order] for c in (doc, mark, start, end))
    if not len(doc):
        return [doc, mark, start, end]
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])
    lift = np.cumsum(fresh) << 32  # so that no text's ends reach into the next one
    reach = np.maximum.accumulate(end + lift)
    begins = np.flatnonzero(fresh | np.concatenate([[True], (start + lift)[1:] > reach[:-1]]))
    return [doc[begins], mark[begins], start[begins], (reach - lift)[np.append(begins[1:] - 1, len(doc) - 1)]]


def _kept(batches: Batches) -> Batches:
    """Documents without the bytes that are covered; the row goes through as it is."""
    for batch in batches:
        removed, kept, sizes = [], [], []
        for text, covers in zip(batch.column("text"), batch.column("covers"), strict=True):
            data = text.as_buffer()
            found = spans(*(np.array(covers.values.field(k)) for k in (0, 1))) if covers.is_valid and len(covers) else []
            edges = [0, *[x for span in found for x in span], len(data)]
            sizes.append(len(data))
            removed.append([{"start": a, "end": b} for a, b in found])
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        arrays = [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "n_bytes", "removed", "kept"])


def _shared(ranks: DataFrame, *names: str) -> DataFrame:
    """Ranks, or pairs of ranks, that positions of several documents have."""
    ends = ranks.groupBy(*names).agg(F.min("doc").alias("_least"), F.max("doc").alias("_most"))
    return ends.filter("_least < _most").select(*[F.col(n).alias(f"_{n}") for n in names])


def _hashed(ranks: DataFrame) -> DataFrame:
    """Ranks to be looked up, each in one row: dealt out evenly, so a partition of them fits in memory and the many rows needn't be sorted."""
    return ranks.hint("shuffle_hash")


def _meeting(rows: DataFrame, shared: DataFrame, *names: str) -> DataFrame:
    same = F.lit(True)
    for n in names:
        same = same & (F.col(n) == F.col(f"_{n}"))
    return rows.join(_hashed(shared), same, "left_semi")


def covers(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Columns doc, print, start, end: the maximal stretches of texts that are covered by strings of an earlier document.

    ``docs``: doc (long, not null), print (a hash of the text), text (binary).
    """
    spark = docs.sparkSession
    ship(spark)
    # 16 and 32 bytes: runs of whole windows.
    judged = _by_parts(
        lambda part: docs.mapInArrow(_runs(length, part, _PARTS), ", ".join(f"{c} long" for c in _RUN)).repartition("anchor")
        .mapInArrow(_judged, "doc long, print long, start long, n long, whole boolean")
    )
    whole = judged.filter("whole").select("doc", "print", "start", (F.col("start") + F.col("n") + (length - 1)).alias("end"))
    left = judged.filter("not whole")
    lists = stored(left.groupBy("doc", "print").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("runs")))
    freed(spark)
    named = lists.select(F.col("doc").alias("_doc"), F.col("print").alias("_print"), "runs")
    texts = docs.join(named, (F.col("doc") == F.col("_doc")) & (F.col("print") == F.col("_print"))).select("doc", "print", "text", "runs")
    strings = stored(texts.mapInArrow(_strings(length), "doc long, print long, start long, string binary, one long, other long"))
    freed(spark)
    dropped(lists)
    # 39 bytes: positions that stand for windows.
    pairs = ("one", "other")
    shared = stored(_shared(strings, *pairs))
    freed(spark)
    candidates = stored(_meeting(strings, shared, *pairs).select("doc", "print", "start", "string"))
    freed(spark)
    dropped(strings, shared)
    # The whole length.
    single = _by_parts(
        lambda part: candidates.mapInArrow(_pairs(length, part, _PARTS), ", ".join(f"{c} long" for c in _WINDOW)).repartition(*pairs)
        .mapInArrow(_repeated(length), "doc long, print long, start long, end long")
    )
    dropped(candidates)
    ordered = whole.unionByName(single).repartition("doc", "print")
    merged = stored(ordered.mapInArrow(_merged, "doc long, print long, start long, end long"))
    freed(spark)
    dropped(judged, single)
    return merged


def _by_parts(step: Callable[[int], DataFrame]) -> DataFrame:
    """What a step makes of each part, stored one after another."""
    done = []
    for part in range(_PARTS):
        done.append(stored(step(part)))
        freed(done[-1].sparkSession)
    return functools.reduce(DataFrame.unionByName, done)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): key, n_bytes, removed (array of start and end), kept (binary).

    Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller doc_id is removed,
    judged on the texts as they come in; matches don't cross documents.  Offsets are bytes of the UTF-8 text.  A null text is empty and a
    text shorter than ``length`` stays whole.  Rows with one doc_id don't count as earlier than each other; a row without doc_id
    neither loses bytes nor makes others lose theirs.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), text.alias("text"))
    named = rows.filter("key is not null").select(F.col("key").alias("doc"), F.xxhash64("text").alias("print"), "text")
    found = covers(named.filter(F.octet_length("text") >= length), length)
    lists = stored(found.groupBy("doc", "print").agg(F.collect_list(F.struct("start", "end")).alias("covers")))
    freed(spark)
    whole = rows.join(lists, (F.col("key") == F.col("doc")) & (F.xxhash64("text") == F.col("print")), "left")
    return whole.select("key", "text", "covers").mapInArrow(_kept, "key long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
