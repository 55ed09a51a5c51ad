import random

import pytest

LANGS = {
    "en": "the and of to in that is was with for her his they this from have not but".split(),
    "fr": "le la les des une est dans pour que qui avec sur pas nous être était très où".split(),
    "de": "der die das und ist nicht mit für auf ein eine auch über würde können schön".split(),
}


@pytest.fixture(scope="session")
def prose():
    """Random prose: (seed, number of words, language) to text."""

    def write(seed, n, lang="en"):
        rng = random.Random(f"{seed}-{lang}")
        stems = LANGS[lang]
        return " ".join(rng.choice(stems) + rng.choice(["", "", rng.choice(stems)]) for _ in range(n))

    return write


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", key string, line string, row string, id string, n string, _row string, digest string, prediction string, ids string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, lang, source), with extra columns whose names the operators use themselves."""

    def make(rows):
        full = [(*r, None if r[1] is None else len(r[1]), *["x"] * 9) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS + CLASHING)

    return make
