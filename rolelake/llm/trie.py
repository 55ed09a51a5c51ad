"""Prefix trie of conversations, measured by the Euler-tour technique.

A node is a distinct sequence of first turns; its members are the conversations that begin with it.  Every node
has an arc into it and an arc out of it; each arc knows the next one on a tour around the tree, which needs
only a node's first and last child and its next sibling.  Ranking that list gives every arc its position, and the
leaves and savings of a subtree are the difference of running totals between its two arcs.

Sequences are told apart by 128 bits: the exclusive or of hashes of (depth, turn), so the print of every prefix is a
running total and a long conversation needn't be walked by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.llm.listrank import ranked
from rolelake.llm.places import chained_sha256, numbered, running
from rolelake.operators.durable import stored

#: Turns that conversations may share with the first of their family of five.
FAMILY, MOST_SHARED = 5, 8
#: Members that one row of ends holds, as a power of two.
_ENDS_BITS = 12


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("long")


def turns(messages: DataFrame) -> DataFrame:
    """Columns conv, place (from 1), a, b (print of role and text), bytes (of the text) of messages (conv_id, turn, role, text).

    Ordered by turn (null first), then role and text; null role or text is empty, and rows without conv_id belong to no conversation.
    """
    named = messages.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    printed = named.withColumns(
        {"a": F.xxhash64("role", "text"), "b": F.xxhash64(F.lit("text"), "text", "role"), "bytes": F.octet_length("text").cast("long")}
    )
    rows = numbered(printed, "conv", F.col("turn").asc_nulls_first(), "role", "text", keep=["conv", "a", "b", "bytes"])
    firsts = rows.groupBy("conv").agg(F.min("number").alias("_first")).withColumnRenamed("conv", "_conv")
    return rows.join(firsts, F.col("conv") == F.col("_conv")).select("conv", (F.col("number") - F.col("_first") + 1).alias("place"), "a", "b", "bytes")


def rebuilt(spoken: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with their first turns taken from the first of their family, and the length of each.

    ``spoken``: as from ``turns``.  Of h shared turns, conversation c has the first h turns of c - c % 5 (all if fewer) and then
    its own after the first h.  Returns (conv, place, a, b, bytes) and (conv, length); lengths may be 0.
    """
    spoken = stored(spoken)
    lengths = spoken.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    shared = shared_turns(F.col("conv"))
    asked = lengths.select("conv", "n", shared.alias("shared"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    bases = lengths.select(F.col("conv").alias("_base"), F.col("n").alias("_n"))
    taken = F.least("shared", F.coalesce("_n", F.lit(0)))
    families = stored(
        asked.join(bases, F.col("base") == F.col("_base"), "left").select(
            "conv", "base", "shared", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("shared"), F.lit(0))).alias("length")
        )
    )
    heads = spoken.filter((F.col("conv") % FAMILY == 0) & (F.col("place") <= MOST_SHARED)).withColumnRenamed("conv", "_head")
    taken_turns = families.join(heads, (F.col("base") == F.col("_head")) & (F.col("place") <= F.col("taken")))
    own = spoken.filter(F.col("place") > shared_turns(F.col("conv"))).withColumnRenamed("conv", "_own")
    own = own.join(families, F.col("conv") == F.col("_own")).withColumn("place", F.col("place") - F.col("shared") + F.col("taken"))
    columns = ["conv", "place", "a", "b", "bytes"]
    return taken_turns.select(columns).unionByName(own.select(columns)), families.select("conv", "length")


def _nodes(said: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (depth, a, b, up_a, up_b, conv, n_convs, bytes) and the ends of conversations (depth, a, b, conv)."""
    longest = lengths.agg(F.max("length")).first()[0] or 0
    step_a, step_b = F.xxhash64("place", "a", "b"), F.xxhash64("b", "a", "place")
    steps = said.select("conv", "place", "bytes", step_a.alias("a"), step_b.alias("b"), step_a.alias("_a"), step_b.alias("_b"))
    prefixes = running(steps, ["conv"], "place", {"a": "bit_xor", "b": "bit_xor"}, longest)
    root = lengths.select("conv", F.lit(0).cast("long").alias("place"), *[F.lit(0).cast("long").alias(c) for c in ("bytes", "_a", "_b", "a", "b")])
    members = stored(prefixes.unionByName(root))
    nodes = members.groupBy(F.col("place").alias("depth"), "a", "b").agg(
        F.min(F.col("a").bitwiseXOR(F.col("_a"))).alias("up_a"), F.min(F.col("b").bitwiseXOR(F.col("_b"))).alias("up_b"),
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"),
    )
    own = lengths.withColumnRenamed("conv", "_conv")
    ends = members.join(own, (F.col("conv") == F.col("_conv")) & (F.col("place") == F.col("length"))).select(F.col("place").alias("depth"), "a", "b", "conv")
    return nodes, ends


def _tree(nodes: DataFrame) -> DataFrame:
    """Nodes numbered so that siblings follow each other, with parent and first and last child."""
    nodes = stored(nodes)
    parents = nodes.select((F.col("depth") + 1).alias("_depth"), F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("conv").alias("parent"))
    same = (F.col("depth") == F.col("_depth")) & (F.col("up_a") == F.col("_a")) & (F.col("up_b") == F.col("_b"))
    placed = nodes.join(parents, same, "left").select("depth", "a", "b", "conv", "parent", "n_convs", "bytes")
    tree = stored(numbered(placed, "depth", F.col("parent").asc_nulls_first(), "conv"))
    children = tree.filter("depth > 0").groupBy((F.col("depth") - 1).alias("_depth"), F.col("parent").alias("_conv")).agg(
        F.min("number").alias("first"), F.max("number").alias("last"), F.count(F.lit(1)).alias("n_children")
    )
    return stored(tree.join(children, (F.col("depth") == F.col("_depth")) & (F.col("conv") == F.col("_conv")), "left").drop("_depth", "_conv"))


def _tour(tree: DataFrame) -> DataFrame:
    """The arcs, 2n into node n and 2n + 1 out of it, each with the next on the tour.

    Out of a node the tour goes into the next number, unless the node is its parent's last child.
    """
    into, out = F.col("number") * 2, F.col("number") * 2 + 1
    row = lambda arc, following, weight: F.struct(arc.alias("id"), F.struct(F.lit(weight).alias("weight"), following.alias("next")).alias("way"))
    none = F.lit(None).cast("long")
    ways = F.array(
        row(into, F.coalesce(F.col("first") * 2, out), 0), row(out, F.when(F.col("depth") == 0, none).otherwise(out + 1), 0), row(F.col("last") * 2 + 1, out, 1)
    )
    arcs = tree.select(F.inline(ways)).filter("id is not null")
    return arcs.groupBy("id").agg(F.max("way").alias("way")).select("id", "way.next")


def _subtrees(tree: DataFrame) -> DataFrame:
    """Leaves and savings below every node, by number."""
    arcs = tree.count() * 2
    ranks = ranked(_tour(tree)).select((F.lit(arcs) - F.col("rank")).alias("position"), F.shiftright("id", 1).alias("node"), (F.col("id") % 2 == 0).alias("into"))
    leaf = F.col("n_children").isNull().cast("long")
    values = tree.select("number", leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    weighed = ranks.join(values, F.col("node") == F.col("number"))
    on_entry = lambda c: F.when(F.col("into"), F.col(c)).otherwise(0)
    weighed = weighed.select("position", "node", "into", *[on_entry(c).alias(c) for c in ("leaves", "saved")], *[on_entry(c).alias(f"own_{c}") for c in ("leaves", "saved")])
    totals = running(weighed, [], "position", {"leaves": "sum", "saved": "sum"}, arcs)
    # What the tour has met on its way out, without what it had met before it came in.
    below = lambda c: F.sum(F.when(F.col("into"), F.col(f"own_{c}") - F.col(c)).otherwise(F.col(c)))
    return totals.groupBy(F.col("node").alias("_node")).agg(below("leaves").alias("n_leaves"), below("saved").alias("saved"))


def prefix_trie(said: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every node of the trie: conv (smallest member), depth, parent, n_convs, n_children, n_leaves, saved, ends_sha256.

    ``said``: conv, place (from 1 without gaps), a, b (print of the turn), bytes; ``lengths``: conv and length of every conversation,
    those without turns too.  parent is the parent's conv, null for the root.  saved: bytes of the last turns in the subtree that
    a node's members after the first needn't hold.  ends_sha256: digest of the conversations that end at the node, ascending, joined by
    commas.  Without conversations there is no node.
    """
    said, lengths = stored(said), stored(lengths)
    nodes, ends = _nodes(said, lengths)
    tree = _tree(nodes)
    ordered = numbered(ends, "depth", "a", "b", "conv").groupBy("depth", "a", "b", F.shiftright("number", _ENDS_BITS).alias("part"))
    texts = ordered.agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("text"))
    digests = chained_sha256(texts, ["depth", "a", "b"], "part", "text", between=",").withColumnsRenamed({"depth": "_depth", "a": "_a", "b": "_b"})
    same = (F.col("depth") == F.col("_depth")) & (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))
    whole = tree.join(_subtrees(tree), F.col("number") == F.col("_node")).join(digests, same, "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return whole.select(
        "conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved",
        F.coalesce("sha256", nothing).alias("ends_sha256"),
    )
