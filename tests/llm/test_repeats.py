import random

import numpy as np
import pyarrow as pa
import pytest

from rolelake.llm import repeats


def plain(rows, length):
    """(n_bytes, removed spans, kept) of each row by looking at every string."""
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        if key is not None:
            for s in range(len(data) - length + 1):
                word = data[s : s + length]
                first[word] = min(key, first.get(word, key))
    found = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if key is not None and first[data[s : s + length]] < key:
                gone[s : s + length] = b"\1" * length
        edges = [k for k in range(len(data) + 1) if (k < len(data) and gone[k]) != (k > 0 and gone[k - 1])]
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        found.append((key, len(data), list(zip(edges[::2], edges[1::2], strict=True)), kept))
    return sorted(found, key=str)


def removed(spark, rows, length):
    full = [(*r, 1, 2, 3, "x", "y") for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, doc long, start long, n long, key string, print string").repartition(3)
    got = repeats.without_repeats(df, length).collect()
    return sorted(((r["key"], r["n_bytes"], [tuple(s) for s in r["removed"]], bytes(r["kept"])) for r in got), key=str)


def corpus(seed):
    """Near copies, chance repeats of a small alphabet, long runs of one character, shared passages."""
    rng = random.Random(seed)
    words = ["ab", "ba ", "abé ", "c", "日本", "\n", "aaaa"]
    write = lambda n: "".join(rng.choice(words) for _ in range(n))
    passage, texts = write(60), [write(rng.randrange(120)) for _ in range(12)]
    for _ in range(25):
        text = rng.choice(texts)
        at = rng.randrange(len(text) + 1)
        texts.append(rng.choice([text, text[:at] + "X" + text[at:], text[:at] + text[at + 1 :], write(20) + passage + write(20), "a" * rng.randrange(300)]))
    rows = [(rng.choice([k, k, k, 7, None]), t) for k, t in enumerate(texts)]
    return [*rows, *rows[:3], (-4, texts[3]), (90, None), (91, ""), (None, passage)]


@pytest.mark.parametrize("length", [50, 48, 24, 64, 7])
def test_equals_brute_force(spark, length):
    rows = corpus(length)
    assert removed(spark, rows, length) == plain(rows, length)


def test_runs_do_not_depend_on_where_a_look_ends():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (0, 49, 50, 700, 3, 4000, 51)] + [b"a" * 900]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def rows(at_once):
        found = [runs for runs in repeats.runs_of(data, offsets, 50, at_once)]
        return [tuple(int(r[c][k]) for c in ("text", "start", "n", "anchor", "digest")) for r in found for k in range(len(r["n"]))]

    whole = rows(1 << 20)
    assert whole == rows(64) == rows(333)
    anchors = [r for r in repeats.runs_of(data, offsets, 50, 1 << 20, anchors_only=True)]
    assert [r[3] for r in whole] == [int(a) for r in anchors for a in r["anchor"]]
    assert [sum(r[2] for r in whole if r[0] == k) for k in range(len(texts))] == [max(0, len(t) - 49) for t in texts]


def test_first_least():
    rng = np.random.default_rng(2)
    for wanted in (1, 2, 6, 35):
        ranks = rng.integers(0, 9, 200).astype(np.uint64)
        assert list(repeats._first_least(ranks, wanted)) == [s + int(np.argmin(ranks[s : s + wanted])) for s in range(200 - wanted + 1)]


def test_long_text_and_many_copies(spark):
    rng = random.Random(3)
    long_ = " ".join(str(rng.random()) for _ in range(60_000))
    line = "a line that very many of the documents have in common with each other"
    rows = [(1, long_), (2, long_[500_000:] + "!")] + [(10 + k, f"{k} {k * 7919} {line} {k * 31}") for k in range(300)] + [(1000 + k, long_[:300]) for k in range(100)]
    got = {r[0]: r for r in removed(spark, rows, 50)}
    assert got[1][2] == [] and got[2][2] == [(0, len(rows[1][1]) - 1)] and got[10][2] == []
    assert all(got[10 + k][2][0][1] - got[10 + k][2][0][0] >= len(line) for k in range(1, 300))
    assert all(got[1000 + k][2] == [(0, 300)] for k in range(100))


def test_empty_table(spark):
    assert removed(spark, [], 50) == []
    assert removed(spark, [(None, None)], 50) == [(None, 0, [], b"")]


def chance_meetings():
    """Texts of the same phrases of over 16 bytes, dealt anew in each: no 50-byte string is in two of them."""
    rng = random.Random(4)
    phrases = ["".join(rng.choice("abcdefghijklmnop") for _ in range(24)) for _ in range(40)]
    return [(k, "".join(rng.choice(phrases) + f"{rng.random():.6f}" for _ in range(60))) for k in range(60)]


def test_chance_meetings_at_16_bytes_leave_nothing_on_disk(spark, monkeypatch):
    kept = []

    def noted(df, store=repeats.stored):
        table = store(df)
        if "string" in table.columns:
            kept.append(table.count())
        return table

    rows = chance_meetings()
    monkeypatch.setattr(repeats, "stored", noted)
    assert removed(spark, rows, 50) == plain(rows, 50)
    assert kept == [0, 0]


def test_parts_of_runs_make_up_all():
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (700, 51, 4000)] + [b"a" * 900, b"ab" * 500 + b"c" * 60]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def rows(at_once, part=0, parts=1):
        found = [runs for runs in repeats.runs_of(data, offsets, 50, at_once, part=part, parts=parts)]
        return [tuple(int(r[c][k]) for c in ("text", "start", "n", "anchor", "digest", "sides")) for r in found for k in range(len(r["n"]))]

    whole = rows(1 << 20)
    assert whole == rows(64) == rows(333)
    for at_once in (1 << 20, 64):
        parts = [rows(at_once, part, 3) for part in range(3)]
        assert sorted(whole) == sorted(sum(parts, [])) and all(len(p) < 0.6 * len(whole) for p in parts)


def test_runs_with_a_common_window_have_a_common_side(monkeypatch):
    rng = random.Random(6)
    write = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    common = [write(rng.choice((50, 51, 60, 90))) for _ in range(30)] + ["xy" * 40, "z" * 70, write(20) * 4]
    common += ["".join(passage + write(3) for _ in range(6)) for passage in (write(20) for _ in range(9))]
    texts = [(write(rng.randrange(70)) + c + write(rng.randrange(70))).encode() for c in common for _ in range(2)]
    monkeypatch.setattr(repeats, "_AT_ONCE", 77)
    numbers = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), numbers, numbers], ["text", "doc", "print"])
    sides = {}
    for r in repeats._runs(50, 0, 1)([batch.slice(k, 1) for k in range(len(texts))]):
        for k, start, n, anchor, side in zip(*(r.column(c).to_pylist() for c in ("doc", "start", "n", "anchor", "sides")), strict=True):
            assert side > 0
            for w in range(start, start + n):
                found = sides.setdefault((k, w), (anchor, set()))
                assert found[0] == anchor
                found[1].update({side & ~0xFFFFFFFF, side & 0xFFFFFFFF} - {0})
    pairs = [
        (sides[2 * c, a], sides[2 * c + 1, b])
        for c in range(len(common)) for a in range(len(texts[2 * c]) - 49) for b in range(len(texts[2 * c + 1]) - 49)
        if texts[2 * c][a : a + 50] == texts[2 * c + 1][b : b + 50]
    ]
    assert len(pairs) > 300
    assert all(one == other and x & y for (one, x), (other, y) in pairs)
    assert len({a for a, s in sides.values() if len(s) > 2}) > 1


@pytest.mark.parametrize("held", [1, 50])
def test_what_a_task_holds_does_not_change_what_it_settles(monkeypatch, held):
    rng = np.random.default_rng(7)
    columns = {c: rng.integers(0, 4, 900) for c in ("one", "other")} | {c: rng.integers(0, 60, 900) for c in ("doc", "print", "start")}
    columns["mark"] = np.zeros(900, np.int64)
    batch = pa.RecordBatch.from_pydict(columns)

    def settled():
        found = repeats._repeated(50)(batch.slice(k, 100) for k in range(0, 900, 100))
        return sorted(r for b in found for r in zip(*[c.to_pylist() for c in b.columns], strict=True))

    least = {}
    for one, other, doc in zip(*(columns[c].tolist() for c in ("one", "other", "doc")), strict=True):
        least[one, other] = min(doc, least.get((one, other), doc))
    rows = zip(*(columns[c].tolist() for c in ("one", "other", "doc", "print", "start")), strict=True)
    expected = sorted((d, p, s, s + 50) for one, other, d, p, s in rows if d > least[one, other])
    monkeypatch.setattr(repeats, "_HELD", held)
    assert settled() == expected


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_stretches_are_merged_in_any_order(monkeypatch, held):
    rng = np.random.default_rng(8)
    start = rng.integers(0, 3000, 600)
    columns = {"doc": rng.integers(-2, 3, 600), "print": rng.integers(-2, 2, 600), "start": start, "end": start + rng.integers(50, 90, 600)}
    batch = pa.RecordBatch.from_pydict(columns)
    monkeypatch.setattr(repeats, "_HELD", held)
    got = [r for b in repeats._merged(batch.slice(k, 50) for k in range(0, 600, 50)) for r in zip(*[c.to_pylist() for c in b.columns], strict=True)]
    expected = []
    for key in {*zip(columns["doc"].tolist(), columns["print"].tolist(), strict=True)}:
        mine = (columns["doc"] == key[0]) & (columns["print"] == key[1])
        expected += [(*key, a, b) for a, b in repeats.spans(start[mine], columns["end"][mine])]
    assert sorted(got) == sorted(expected)


def test_windows_of_very_many_documents_are_dealt_to_all_tasks():
    passage = b"a passage of one hundred bytes that very many documents have, each with words of its own before and after"
    texts = [b"%09d" % (k * 104729) + passage + b"%09d" % (k * 15485863) for k in range(200)]
    numbers = pa.array(range(200), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), numbers, numbers, numbers], ["string", "doc", "print", "start"])
    found = [b for part in range(2) for b in repeats._pairs(50, part, 2)([batch])]
    dealt = [pair for b in found for pair in zip(b.column("one").to_pylist(), b.column("other").to_pylist(), strict=True)]
    assert len(dealt) == sum(len(t) - 49 for t in texts) == len({*dealt})
    got = sorted(r for r in repeats._repeated(50)(found) for r in zip(*(r.column(c).to_pylist() for c in ("doc", "start", "end")), strict=True))
    first = {}
    windows = [(k, w, text[w : w + 50]) for k, text in enumerate(texts) for w in range(len(text) - 49)]
    assert got == sorted((k, k + w, k + w + 50) for k, w, window in windows if first.setdefault(window, k) < k)
