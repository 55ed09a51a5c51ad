import os
from collections import Counter

import pytest

import corpus_pipeline
from rolelake.llm.queries import LLM_QUERIES, MODEL_FILE

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL_FILE), reason="needs the public model file")
COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(spark, documents, prose, tmp_path_factory):
    """Every stage's result by name, over a small table with known cases."""
    langs = ["en", "fr", "de"]
    rows = [(i, prose(i, 60 + i % 50, langs[i % 3]), langs[i % 3], f"s{i % 4}" if i % 9 else None) for i in range(150)]
    rows += [(200 + k, rows[k][1], rows[k][2], "s1") for k in range(10)]  # exact copies
    rows += [(300 + k, rows[k][1] + " tail", rows[k][2], "s2") for k in range(10)]  # near copies
    rows += [(400, None, "en", "s1"), (401, "", "en", "s1"), (402, "12 34 %%", "en", "s1"), (403, "Совсем другой язык и письмо " * 20, None, "s1")]
    rows += [(404, "too short", "en", "s1"), (405, "again and again " * 60, "en", "s1"), (7, rows[7][1], "en", "s1")]
    docs, found = documents(rows), {"documents": rows}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, None)
        path = str(tmp_path_factory.mktemp("stage") / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        found[name] = docs.collect()
    return found


def test_all_but_the_last_return_documents(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name][0].asDict().keys() == set(COLUMNS)
        assert all(r["n_chars"] == len(r["text"]) for r in stages[name])


def test_language_drops_only_what_has_none(stages):
    gone = {r[0] for r in stages["documents"]} - {r["doc_id"] for r in stages["language_id"]}
    assert gone == {400, 401, 402, 403}
    by = {r["doc_id"]: r["lang"] for r in stages["language_id"]}
    assert all(by[i] == ["en", "fr", "de"][i % 3] for i in range(150))


def test_quality_keeps_clean_documents(stages):
    assert {r["doc_id"] for r in stages["language_id"]} - {r["doc_id"] for r in stages["quality_rules"]} == {404, 405}


def test_one_document_of_each_group_stays(stages):
    kept = Counter(r["doc_id"] for r in stages["near_duplicates"])
    assert kept == Counter(range(150))


def test_mix_repeats_documents(stages):
    taken = Counter(r["doc_id"] for r in stages["mixture"])
    assert set(taken) <= set(range(150)) and max(taken.values()) <= 3 and len(taken) > 75
    texts = {r["doc_id"]: r["text"] for r in stages["near_duplicates"]}
    assert all(r["text"] == texts[r["doc_id"]] for r in stages["mixture"])


def test_encoding_covers_every_row(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    texts = {r["doc_id"]: r["text"] for r in stages["mixture"]}
    assert Counter(r["doc_id"] for r in stages["encoding"]) == Counter(r["doc_id"] for r in stages["mixture"])
    assert all(r["ids"] == library.encode(texts[r["doc_id"]]) for r in stages["encoding"])


def test_near_duplicates_with_null_and_repeated_ids(spark, documents, prose):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [
        (7, a, "en", "s"), (5, a, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (None, b + " more", "en", "s"), (None, c, "en", "s"),
        (None, c, "en", "s"), (-3, prose(4, 60), "en", "s"), (9, prose(4, 60), None, "s"), (8, None, "en", "s"), (8, None, "en", "t"), (None, None, None, None),
    ]
    got = corpus_pipeline.near_duplicates(spark, documents(rows), None).collect()
    kept = Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in got)
    assert kept == Counter([
        (5, a, "en", "s"), (5, b, "en", "s"), (None, c, "en", "s"), (-3, prose(4, 60), "en", "s"), (8, None, "en", "s"), (8, None, "en", "t"),
        (None, None, None, None),
    ])


def test_empty_documents(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, None)
    assert docs.count() == 0


def test_one_query_for_each_operator():
    assert [n for n in range(1, 11) if any(name.startswith(f"op{n}_") for name in LLM_QUERIES)] == list(range(1, 11))
