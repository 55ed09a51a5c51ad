import os

import numpy as np
import pyarrow as pa
import pytest

from rolelake.llm import sequences
from rolelake.llm.queries import RANK_FILE

pytestmark = pytest.mark.skipif(not os.path.exists(RANK_FILE), reason="needs the public rank file")


def test_slots_are_a_keyed_permutation():
    for n in (1, 2, 3, 4, 5, 16, 17, 1000, 4097):
        assert sorted(sequences.slots(np.arange(n), n, 7)) == list(range(n))
    assert list(sequences.slots(np.arange(500), 500, 1)) != list(sequences.slots(np.arange(500), 500, 2))
    parts = [sequences.slots(np.arange(k, k + 100), 500, 1) for k in range(0, 500, 100)]
    assert list(np.concatenate(parts)) == list(sequences.slots(np.arange(500), 500, 1))


def test_words_encode_alike_apart_and_together(prose):
    tokens = sequences.Tokens(RANK_FILE)
    for text in [prose(1, 200), "a  b c d e f g h i", " lead a b c d e f g h", "it's we're a b c d e f's x", "tab\t a b c d e f g h", "é ü 日 本 12 34 .. a b c", "x " * 9]:
        assert tokens.of(text) == tokens.raw(text)


class Counted:
    """An encoding that counts how often it is asked."""

    def __init__(self, encoding):
        self.encoding, self.calls = encoding, 0

    def __getattr__(self, name):
        self.calls += 1
        return getattr(self.encoding, name)


def test_distinct_words_are_encoded_in_one_call(prose, monkeypatch):
    odd = ["a b c d e f g h" + c + "i j" + e for c in ("  ", " \n", "\x1c ", " \x85", "\xa0", "\u2028 ", "\n\n", "\t") for e in ("", " ", "\u3000")]
    texts = [prose(k, 150, "fr") + f" w{k}" for k in range(40)] + odd + [" lead it is not so at all no", "", None, " ", "x", "w " * 5000, "it's a b c d e f's 12 日本 é"]
    tokens = sequences.Tokens(RANK_FILE)
    want = [tokens.raw(t) + tokens.end.to_bytes(tokens.bytes, "little") for t in texts if t]
    tokens.encoding = Counted(tokens.encoding)
    monkeypatch.setitem(sequences._loaded, RANK_FILE, tokens)
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(some, pa.string())}) for some in (texts[:50], [None], [], texts[50:])]
    out = [row for made in sequences._packer(RANK_FILE, 64)(iter(batches)) for row in made.to_pylist()]
    assert b"".join(r["ids"][: r["n_tokens"] * tokens.bytes] for r in out) == b"".join(want)
    assert tokens.encoding.calls <= len(want) + len(batches)


def test_shards_hold_every_text_once(spark, documents, prose, tmp_path):
    texts = {i: prose(i, 3 + i * 5 % 200) for i in range(80)}
    rows = [(i, t, "en", "s") for i, t in texts.items()] + [(90, None, "en", "s"), (91, "", "en", "s"), (92, "word " * 20_000, "en", "s"), (1, texts[1], "en", "s")]
    made = sequences.packed(documents(rows), RANK_FILE, 64)
    ordered = sequences.in_training_order(made, 50)
    got = ordered.collect()
    total = len(got)
    assert sorted(r["slot"] for r in got) == list(range(total))
    assert all((r["shard"], r["record"]) == divmod(r["slot"], 50) and len(r["ids"]) == 128 for r in got)
    files = {r["shard"]: r for r in sequences.write_shards(ordered, f"file://{tmp_path}/shards").collect()}
    assert sorted(os.listdir(tmp_path / "shards")) == [f"shard-{s:06d}.bin" for s in range(-(-total // 50))]
    for r in got:
        file = files[r["shard"]]
        with open(file["path"], "rb") as stream:
            stream.seek(r["record"] * file["stride"])
            assert stream.read(file["stride"]) == bytes(r["ids"])
    in_slots = [bytes(r["ids"]) for r in sorted(got, key=lambda r: r["slot"])]
    for first in (0, 1, 49, 50, 73, total - 1, total, total + 500):
        assert list(sequences.read_from(f"{tmp_path}/shards", first, 50, 128)) == in_slots[first:]
    with pytest.raises(ValueError):
        next(sequences.read_from(f"{tmp_path}/shards", -1, 50, 128))
    tokens = sequences.Tokens(RANK_FILE)
    in_order = sorted(made.collect(), key=lambda r: (r["task"], r["place"]))
    ids = np.concatenate([np.frombuffer(r["ids"], dtype="<u2")[: r["n_tokens"]] for r in in_order])
    said = tokens.encoding.decode_bytes([i for i in ids if i != tokens.end]).decode()
    assert sorted(said) == sorted("".join(r[1] or "" for r in rows)) and (ids == tokens.end).sum() == 82


def test_empty_table(documents, tmp_path):
    ordered = sequences.in_training_order(sequences.packed(documents([]), RANK_FILE, 64), 50)
    assert ordered.count() == 0
    assert sequences.write_shards(ordered, str(tmp_path / "none")).count() == 0


def test_query_reads_the_written_shards(spark, documents, prose, tmp_path, monkeypatch):
    from rolelake.llm import queries

    docs = documents([(i, prose(i, 3 + i % 90) if i % 6 else None, "en", "s") for i in range(200)]).coalesce(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "SEQUENCE_TOKENS", 16)
    monkeypatch.setattr(queries, "SHARD_RECORDS", 40)
    made, packed = [], sequences.packed
    monkeypatch.setattr(sequences, "packed", lambda *a: made.append(packed(*a)) or made[0])
    folder = tmp_path / "shards"
    monkeypatch.setattr(queries, "shared_folder", lambda spark: f"file:{folder}")
    got = sorted(map(tuple, queries.op6_training_order(spark, str(tmp_path)).collect()))
    want = sorted(map(tuple, sequences.in_training_order(made[0], 40).collect()))
    assert got == want and len(got) > 100
    assert b"".join(p.read_bytes() for p in sorted(folder.glob("shard-*.bin"))) == b"".join(bytes(r[4]) for r in got)
