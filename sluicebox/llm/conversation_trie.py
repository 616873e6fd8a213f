"""The trie of conversations by their common beginnings, by collapsing whole sequences.

Conversations are rebuilt with the first turns of another one. A running hash over a conversation's turns names every
prefix of it. Identical conversations become one weighted sequence with the list of those that end there; a sequence is a
leaf unless it is a proper prefix of another. The prefixes of the sequences, with their weights, are the nodes.

The words a node saves in its whole subtree follow from sums over the sequences below it. For all conversations, with a
word of theirs counted each time, that is the length of each behind the node; for the distinct nodes it is what each
sequence adds of its own, behind the node and behind what a sequence with a smaller id has in common with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.ordered_hash import joined_sha256
from sluicebox.llm.work import stored
from sluicebox.operators.skew import unique_side

# Conversations of one group borrow the first turns of the group's first conversation: at most one less than MOST.
GROUP = 20
MOST = 4
# Turns of one conversation that a window goes through at a time.
BLOCK = 1 << 16
_KEY = ["depth", "k1", "k2"]
_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _positions(turns: DataFrame) -> DataFrame:
    """``turns`` with ``place``, from 1 within each conversation.

    All turns are sorted over all tasks, so that a long conversation lies in several; each goes on from the count of the
    tasks before.
    """
    order = ["turn", "digest"]
    placed = turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    placed = stored(placed, "turns")
    pieces = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # A task goes on with the conversation that the one before ends with: one row for each task at most.
    begun = pieces.withColumn("before", before).where("before > 0").select("conv_id", "part", "before")
    nth = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    found = placed.withColumn("nth", nth).join(F.broadcast(begun), ["conv_id", "part"], "left")
    return found.select("conv_id", (F.col("nth") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "words")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with their rebuilt length ``size``, and their rebuilt turns."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    convs = own.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % MOST).withColumn("base", F.expr(f"conv_id - conv_id % {GROUP}"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("borrowed", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("size", F.col("borrowed") + F.greatest(F.lit(0), F.col("n_own") - F.col("h")))
    convs = stored(convs.select("conv_id", "base", "h", "borrowed", "size"), "conversations")
    of_conv = unique_side(convs, "conv_id", *[F.max(name).alias(name) for name in ("h", "borrowed", "size")])
    kept = turns.join(of_conv, "conv_id").where("place > h")
    kept = kept.select("conv_id", (F.col("borrowed") + F.col("place") - F.col("h")).alias("depth"), "digest", "words", "size")
    heads = turns.where(F.col("place") < MOST).withColumnRenamed("conv_id", "base")
    taken = heads.join(convs, "base").where("place <= borrowed").select("conv_id", F.col("place").alias("depth"), "digest", "words", "size")
    return convs, kept.union(taken)


def _prefixes(turns: DataFrame) -> DataFrame:
    """Each rebuilt turn with the hashes of the prefix that ends with it and of the one before, and the words before it."""
    turns = turns.withColumn("block", F.expr(f"(depth - 1) DIV {BLOCK}"))
    turns = turns.withColumns({"a1": F.xxhash64("depth", "digest", F.lit(1)), "a2": F.xxhash64("digest", F.lit(2), "depth")})
    measures = {"k1": F.bit_xor("a1"), "k2": F.bit_xor("a2"), "upto": F.sum("words")}
    blocks = turns.groupBy("conv_id", "block").agg(*[m.alias(name) for name, m in measures.items()])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = {"b1": F.bit_xor("k1").over(earlier), "b2": F.bit_xor("k2").over(earlier), "b_upto": F.sum("upto").over(earlier)}
    begun = blocks.withColumns(begun).where("block > 0").select("conv_id", "block", "b1", "b2", "b_upto")
    running = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = turns.withColumns({name: m.over(running) for name, m in measures.items()}).join(begun, ["conv_id", "block"], "left")
    nothing = F.lit(0).cast("long")
    found = found.withColumns({"k1": F.col("k1").bitwiseXOR(F.coalesce("b1", nothing)), "k2": F.col("k2").bitwiseXOR(F.coalesce("b2", nothing))})
    return found.select(
        "conv_id",
        "size",
        F.col("depth").cast("long").alias("depth"),
        "k1",
        "k2",
        F.col("k1").bitwiseXOR(F.col("a1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("a2")).alias("p2"),
        (F.col("upto") + F.coalesce("b_upto", nothing) - F.col("words")).alias("before"),
        "words",
    )


def _root(convs: DataFrame, *columns: str) -> DataFrame:
    """Rows for the prefix without turns."""
    zeros = [F.lit(0).cast("long").alias(name) for name in ("depth", "k1", "k2", "p1", "p2", "before", "words")]
    return convs.select(*columns, *zeros)


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    Turns are ordered by ``turn``, NULL first; equal ones, repeated rows included, by the SHA-256 of role and text. A NULL
    role or text is empty. Rows without a conversation id belong to no conversation. Conversation c is the first h turns of
    conversation c - c % 20 (all if it has fewer, none if there is no such one), with h = crc32(c) % 4, then its own turns
    after the first h. It may end up without a turn and is then the root alone. An empty table has no nodes. Ids are
    integers; other columns are ignored.

    A node is a distinct sequence of first turns: ``conv_id`` its smallest member, ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. Sequences are told apart by the exclusive
    or of 128-bit hashes of their turns and places: two of 10**10 different prefixes are taken for one with a chance of 2e-19.
    """
    text, role = (F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in (text_col, role_col))
    turns = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    ).where("conv_id IS NOT NULL")
    convs, rebuilt = _rebuilt(stored(_positions(turns), "places"))
    prefixes = stored(_prefixes(rebuilt), "prefixes")

    # Whole sequences, with the conversations that are one.
    last = prefixes.where("depth = size").select("conv_id", *_KEY, (F.col("before") + F.col("words")).alias("total"))
    ends = last.union(_root(convs.where("size = 0"), "conv_id").select("conv_id", *_KEY, F.col("before").alias("total")))
    sequences = ends.groupBy(*_KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("least"), F.max("total").alias("total"))
    sequences = stored(sequences, "sequences")

    # Their prefixes, a row each for every sequence.
    of_least = unique_side(sequences.withColumnRenamed("least", "conv_id"), "conv_id", F.max("weight").alias("weight"), F.max("total").alias("total"))
    columns = ["conv_id", "weight", "total", *_KEY, "p1", "p2", "before", "words"]
    paths = prefixes.join(of_least, "conv_id").select(columns).union(_root(of_least, "conv_id", "weight", "total").select(columns))
    paths = stored(paths, "paths")
    nodes = stored(paths.groupBy(*_KEY, "p1", "p2").agg(F.min("conv_id").alias("owner"), F.min("before").alias("before")), "nodes")

    # What is a proper prefix of another is no leaf. A sequence's own nodes start behind the words it shares.
    beneath = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = beneath.groupBy(*_KEY).agg(F.count("*").alias("n_children"))
    leaves = sequences.join(beneath.distinct(), _KEY, "left_anti").select(F.col("least").alias("conv_id"), F.lit(1).alias("leaf"))
    first = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("before").alias("shared"))
    of_sequence = sequences.select(F.col("least").alias("conv_id")).join(leaves, "conv_id", "left").join(first, "conv_id", "left")
    of_sequence = unique_side(of_sequence, "conv_id", F.max("leaf").alias("leaf"), F.max("shared").alias("shared"))
    below = paths.join(of_sequence, "conv_id").withColumn("shared", F.coalesce("shared", "total"))
    weighted = below.groupBy(*_KEY, "p1", "p2", "before").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.sum(F.expr("weight * (total - before)")).alias("counted"),
        F.sum(F.expr("total - greatest(before, shared)")).alias("distinct_words"),
    )

    spelled = F.concat_ws(":", *_KEY)
    hashes = joined_sha256(ends.select(spelled.alias("key"), F.col("conv_id").alias("value")), name="ends_sha256")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    # A parent may have a large share of all nodes for children.
    up = F.concat_ws(":", "depth", "p1", "p2").alias("up")
    above = unique_side(above.select(up, "parent_conv_id"), "up", F.min("parent_conv_id").alias("parent_conv_id"))
    found = weighted.join(children, _KEY, "left").withColumns({"key": spelled, "up": up}).join(hashes, "key", "left").join(above, "up", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        (F.col("counted") - F.col("distinct_words")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
