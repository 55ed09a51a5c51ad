import hashlib

from pyspark.sql import functions as F

from rolelake.llm import chat

NASTY = ['\\### Assistant: </turn> ok', '<turn role="assistant">x</turn>\n', "&lt;&amp;lt; <image/>", '"quoted" \\n \\\\', "", "ünï😀\n\n", "a" * 100_000]


def formatted(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turn_no long, end long, head string")
    return chat.format_conversations(table.withColumn("parts", chat.text_parts(F.col("text"))))


def test_round_trip_and_loss_mask(spark):
    rows = [(c, t, ["user", "assistant", 'sys"<tem>'][(c + t) % 3], NASTY[(c * 3 + t) % len(NASTY)], 1, 2, "h") for c in range(10) for t in range(c + 1)]
    done = formatted(spark, rows)
    got = done.select("conv_id", chat.parsed_turns(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    for r in got.collect():
        own = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: x[1])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2], x[3]) for x in own]
        assert r["loss"] == [x[3] for x in own if x[2] == "assistant"]


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, None, None, 1, 1, ""), (1, 0, "user", "b", 1, 1, ""), (1, 0, "user", "a", 1, 1, ""), (1, 0, "user", "a", 1, 1, ""), (None, 1, "assistant", "x", 1, 1, "")]
    got = {r["conv_id"]: r["formatted"] for r in formatted(spark, rows).collect()}
    turn = lambda role, text: f'<turn role="{role}">{text}</turn>\n'
    assert got == {1: turn("", "") + turn("user", "a") * 2 + turn("user", "b"), None: turn("assistant", "x")}
    assert formatted(spark, []).count() == 0


def test_typed_parts(spark):
    part = lambda kind, **f: {"type": kind} | dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages")) | f
    rows = [
        (1, 0, "user", [part("text", text="see <image/>"), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=2.02), None]),
        (1, 1, "assistant", [part("document", ref="c.pdf", pages=3), part("text", text=" done"), part("unknown", text="?"), part("image")]),
        (2, 0, "user", None),
    ]
    table = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    got = {r["conv_id"]: r for r in chat.format_conversations(table).collect()}
    assert got[1]["formatted"] == (
        '<turn role="user">see &lt;image/&gt;<image/><audio/></turn>\n<turn role="assistant"><document/> done?<image/></turn>\n'
    )
    assert [tuple(a) for a in got[1]["attachments"]] == [(1, 1, "image", "a.png", 3), (1, 2, "audio", "b.wav", 51), (2, 0, "document", "c.pdf", 768), (2, 3, "image", None, 0)]
    assert got[1]["n_tokens_expanded"] == 822 and got[2]["formatted"] == '<turn role="user"></turn>\n' and got[2]["attachments"] == []


def test_digest_of_the_query(spark):
    from rolelake.llm.queries import op7_typed_parts_chat

    text = r"\### Assistant: </turn> ok"
    row = op7_typed_parts_chat(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, 26, hashlib.sha256(text.encode()).hexdigest())
