import os
import random

import pytest
import sentencepiece

from rolelake.llm import pieces
from rolelake.llm.queries import MODEL_FILE

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL_FILE), reason="needs the public model file")

ODD = [
    "a", "  Ab  c\tﬁ\nx 　y  ", "    ", "日本語テキスト 😀 emoji", "x" * 3000, "aaaa" * 500, " " * 777, "def f(x):\n    return x+1\n\n", "\x00\x01é́",
    "Ünïcödé straße ﬀ", "end ", "\n", "\r\n\t", "word " * 30_000,
]


def test_encoding_equals_the_library_and_decoding_gives_the_text_back(documents, prose):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("abctheing  éñ\n.,0123ABCXY日🙂") for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    texts += [prose(k, 100, lang) for k in range(20) for lang in ("en", "fr", "de")]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    encoded = pieces.with_ids(documents([(i, t, "en", "s") for i, t in enumerate(texts)]), MODEL_FILE)
    got = {r["doc_id"]: r for r in pieces.with_text(encoded, MODEL_FILE, into="back").collect()}
    for i, text in enumerate(texts):
        assert got[i]["ids"] == library.encode(text), text[:50]
        assert got[i]["back"] == text


def test_nulls_repeats_and_empty_table(documents):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "same", "en", "s"), (3, "same", "en", "s")]
    got = pieces.with_ids(documents(rows), MODEL_FILE)
    assert sorted((r["doc_id"], len(r["ids"])) for r in got.collect()) == sorted([(1, 0), (2, 0)] + [(3, len(got.filter("doc_id = 3").first()["ids"]))] * 2)
    assert set(got.columns) == set(documents(rows).columns)
    assert pieces.with_ids(documents([]), MODEL_FILE).count() == 0


def test_every_occurrence_is_found():
    model = pieces.Pieces(MODEL_FILE)
    text = "the theater, then\0▁the▁thing"
    place, which = pieces.occurrences(text, model)
    got = sorted((int(p), model.sorted[w]) for p, w in zip(place, which))
    want = sorted((i, text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in model.number)
    assert got == want


def test_texts_of_all_sizes_keep_their_rows(spark, prose, monkeypatch):
    from rolelake.llm import pieces as module

    monkeypatch.setattr(module, "_SLICE", 64)
    assert [list(module._slices(module.pa.array(t, module.pa.string()))) for t in ([], [None], ["a" * 70, "", None, "b", "c" * 200, "d"])] == [
        [], [(0, 1)], [(0, 1), (1, 4), (5, 1)]]
    rows = [(i, None if i % 7 == 3 else prose(i, i * 11 % 90)) for i in range(60)]
    named = spark.createDataFrame(rows, "n int, text string")
    want = {r["n"]: r["ids"] for r in named.transform(lambda d: module.with_ids(d, MODEL_FILE)).collect()}
    # A text that is replaced, one of another type, and one under another name.
    over = module.with_ids(named, MODEL_FILE, into="text").collect()
    cast = module.with_ids(named.selectExpr("n", "cast(text AS binary) AS body"), MODEL_FILE, text="body").collect()
    assert {r["n"]: r["text"] for r in over} == want == {r["n"]: r["ids"] for r in cast}
    assert all(want[n] == [] for n, t in rows if not t) and sum(map(len, want.values())) > 500
