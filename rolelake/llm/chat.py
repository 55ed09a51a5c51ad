"""Chat formatting of messages with typed content parts, with DataFrame functions only.

Template: ``<turn role="ROLE">CONTENT</turn>`` and a line break for each message.  In texts and
roles ``&``, ``<``, ``>`` and ``"`` are written as character references, so every ``<`` of the output is
markup, and the output can be taken apart again exactly.

A visitor turns each part into its piece of the content: text as it is, and image, audio and
document parts into placeholders.  The k-th placeholder of a conversation belongs to its k-th
attachment, which records where the part stood, its reference and how many tokens the model's
input has in the placeholder's stead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A content part; fields that a type doesn't use are null.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH_PIXELS = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256
TRAINED_ROLE = "assistant"

#: Characters that are written as references, ampersand first.
_REFERENCES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))


def escape(text: Column) -> Column:
    for plain, reference in _REFERENCES:
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def unescape(text: Column) -> Column:
    for plain, reference in reversed(_REFERENCES):
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def _patches(pixels: Column) -> Column:
    return F.ceil(F.greatest(F.coalesce(pixels, F.lit(0)), F.lit(0)) / PATCH_PIXELS)


#: For each type but text: its placeholder and the number of tokens that take its place.
_VISITORS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "image": ("<image/>", lambda p: _patches(p["width"]) * _patches(p["height"])),
    "audio": ("<audio/>", lambda p: F.ceil(F.greatest(F.coalesce(p["seconds"], F.lit(0.0)), F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND)),
    "document": ("<document/>", lambda p: F.greatest(F.coalesce(p["pages"], F.lit(0)), F.lit(0)).cast("long") * DOCUMENT_TOKENS_PER_PAGE),
}


def _visit(part: Column, of_text: Callable[[Column], Column], of_other: Callable[[str, Callable], Column]) -> Column:
    """Dispatch on the part's type; types that aren't known count as text."""
    found = of_text(part)
    for kind, (placeholder, tokens) in _VISITORS.items():
        found = F.when(part["type"] == kind, of_other(placeholder, tokens)).otherwise(found)
    return found


def text_parts(text: Column) -> Column:
    """Plain text as a list of one part."""
    others = (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in others]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *nothing))


def format_conversations(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, n_tokens_expanded.

    ``parts``: array of ``PART``.  ``loss_spans``: (start, end) in code points of ``formatted`` around the
    content of every assistant message.  ``attachments``: (turn_no, part_no, type, ref, tokens), in the order
    of the placeholders.

    Null conversation: a conversation of its own.  Null role, text, parts or part: empty.  Messages with
    equal turns (null first): by role, then content.  Repeated messages: all kept.  Empty table: no rows.
    Other columns are not read.  A conversation becomes one string, so it must fit in a task.
    """
    column = lambda name: F.col(f"`{name}`")
    none = F.lit(None).cast(f"array<{PART}>")
    given = F.coalesce(column(parts).cast(f"array<{PART}>"), none, F.array().cast(f"array<{PART}>"))
    content = F.array_join(
        F.transform(given, lambda p: _visit(p, lambda p: escape(F.coalesce(p["text"], F.lit(""))), lambda mark, _: F.lit(mark))), ""
    )
    attachment = lambda p, i: F.struct(
        i.alias("part_no"), p["type"].alias("type"), p["ref"].alias("ref"),
        _visit(p, lambda _: F.lit(0).cast("long"), lambda _, tokens: tokens(p).cast("long")).alias("tokens"),
    )
    attached = F.filter(F.transform(given, attachment), lambda a: a["type"].isin(*_VISITORS))
    rows = messages.select(
        column(conv).alias("conv_id"), column(turn).alias("turn"), F.coalesce(column(role).cast("string"), F.lit("")).alias("role"),
        content.alias("content"), attached.alias("attached"),
    )
    head = F.concat(F.lit('<turn role="'), escape(F.col("role")), F.lit('">'))
    rows = rows.withColumn("head", head).withColumn("whole", F.concat("head", "content", F.lit("</turn>\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    # Window and aggregate share one exchange by conversation.
    placed = rows.withColumn("turn_no", F.row_number().over(order)).withColumn("end", F.sum(F.length("whole")).over(until))
    start = F.col("end") - F.length("whole") + F.length("head")
    span = F.when(F.col("role") == TRAINED_ROLE, F.struct(start.alias("start"), (start + F.length("content")).alias("end")))
    listed = F.sort_array(F.collect_list(F.struct("turn_no", "whole", span.alias("span"), "attached")))
    grouped = placed.groupBy("conv_id").agg(listed.alias("turns"))
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    attachments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["attached"],
                lambda a: F.struct(
                    t["turn_no"].alias("turn_no"), a["part_no"].alias("part_no"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")
                ),
            ),
        )
    )
    return grouped.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["whole"]), "").alias("formatted"),
        spans.alias("loss_spans"), attachments.alias("attachments"),
    ).withColumn("n_tokens_expanded", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def parsed_turns(formatted: Column) -> Column:
    """Turns read back from the output: array of (role, text), with placeholders left in the text."""
    pieces = F.filter(F.split(formatted, '<turn role="'), lambda _, i: i > 0)
    return F.transform(
        pieces,
        lambda t: F.struct(
            unescape(F.substring_index(t, '">', 1)).alias("role"),
            unescape(F.substring_index(F.substring(t, F.instr(t, F.lit('">')) + 2, F.length(t)), "</turn>", 1)).alias("text"),
        ),
    )


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, read back from the output."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
