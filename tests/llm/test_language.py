import random
import zlib

import numpy as np

from rolelake.llm import language


def test_held_out_accuracy(spark, documents, prose):
    langs = ["en", "fr", "de"]
    rows = [(i, prose(i, 5 + i % 40, langs[i % 3]), langs[i % 3], "s") for i in range(600)]
    docs = documents(rows)
    model = language.fit(language.learnable(docs))
    got = language.predict(docs, model).withColumn("held", language.held_out()).collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held"]]
    assert len(held) > 100 and sum(r["prediction"]["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert not any(r["prediction"]["rejected"] for r in got)
    assert len(set(model.langs)) == 3 and len(model.langs) > 3


def test_nearest_centroid_by_plain_arithmetic(documents, prose):
    rows = [(i, prose(i, 20, lang), lang, "s") for i in range(60) for lang in ("en", "de")]
    model = language.fit(documents(rows))
    text = prose(999, 25, "de")
    vector = np.zeros(language.BUCKETS)
    at, counts = language.gram_counts(text)
    vector[at] = (1 + np.log(counts)) * model.idf[at]
    cosines = model.centroids @ vector / np.linalg.norm(vector)
    langs, scores, _ = model.predict([text])
    assert langs == [model.langs[int(cosines.argmax())]] == ["de"] and abs(scores[0] - cosines.max()) < 1e-5


def test_other_scripts_are_rejected_and_empty_texts_unknown(documents, prose):
    rows = [(i, prose(i, 30, lang), lang, "s") for i in range(80) for lang in ("en", "fr")]
    rows += [(900, None, "en", "s"), (901, "no language", None, "s"), (902, "123 !!", "en", "s")]
    model = language.fit(documents(rows))
    langs, scores, rejected = model.predict([None, "", "12 %%", "Это совсем другой язык и другое письмо", "the that with", "x" * 3_000_000])
    assert langs[:3] == ["und"] * 3 and list(scores[:3]) == [0] * 3
    assert list(rejected[:5]) == [True, True, True, True, False]


def test_long_texts_count_whole():
    text = "abc déf " * 200_000
    at, counts = language.gram_counts(text)
    code = language._codes(text)
    assert counts.sum() == len(code) + len(code) - 1 + len(code) - 2
    assert (language.gram_counts("abc")[1].sum(), language.gram_counts("")[1].sum()) == (6, 0)


def test_nothing_to_learn_from(documents):
    model = language.fit(documents([]))
    assert model.langs == ()
    got = language.predict(documents([(1, "some text", "en", "s")]), model).first()
    assert got["prediction"]["lang_pred"] == "und" and got["prediction"]["rejected"]
    assert language.predict(documents([]), model).count() == 0


def test_the_driver_gets_no_row_objects_of_numbers(documents, prose, monkeypatch):
    docs, kinds = documents([(i, prose(i, 30, lang), lang, "s") for i in range(12) for lang in ("en", "fr")]), []
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: kinds.extend(k for _, k in df.dtypes) or collect(df))
    model = language.fit(docs)
    assert set(model.langs) == {"en", "fr"} and np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-4)
    assert kinds and not any("array" in k for k in kinds)


LETTERS = {"finnish": "aaaaiiiittnneessllooukkäämmvrjhyypdö", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыьэюяоооееаии", "cjk": "".join(map(chr, range(0x4E00, 0x55D0)))}


def test_long_texts_of_other_languages_are_rejected(documents, prose):
    rows = [(i, prose(i, 10 + i * 2, lang), lang, "s") for i in range(120) for lang in ("en", "fr", "de")]
    model = language.fit(documents(rows))
    for letters in LETTERS.values():
        rng = random.Random(letters)
        # Words as frequent as their rank says, as in real texts.
        words = ["".join(rng.choices(letters, k=rng.randint(3, 11))) for _ in range(5000)]
        text = " ".join(rng.choices(words, [1 / (k + 1) for k in range(5000)], k=30_000))
        assert all(model.predict([text[:size] for size in (100, 5_000, 100_000)])[2])
    known = [prose(9000, 20_000, lang)[:size] for lang in ("en", "fr", "de") for size in (20, 100, 5_000, 100_000)]
    known += ["They They They " * 500, "THE!! AND, THIS. " * 90, prose(9001, 40) + ' key = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6"']
    assert not any(model.predict(known)[2])


def test_long_texts_do_not_fill_the_buckets():
    rng = random.Random(1)
    text = {k: " ".join("".join(rng.choices(v, k=7)) for _ in range(12_000)) for k, v in LETTERS.items()}
    found = {k: set(language.gram_counts(t)[0].tolist()) for k, t in text.items()}
    assert len(found["finnish"] & found["cyrillic"]) < 0.1 * len(found["cyrillic"])
