"""Sources interleaved at target weights by proportionate-fair (Pfair) scheduling.

A source's documents, in an order drawn from their ids, form a stream that is cut into blocks of equal volume. Blocks
are scheduled in frames. A frame of ``D`` slots holds ``a`` blocks of a source with ``a`` of ``D`` parts; block ``j`` of
them (from 0) is released at slot ``floor(j * D / a)`` and due at ``ceil((j + 1) * D / a)``, and of the released blocks
the earliest deadline goes first. So at every slot each source is less than one block away from its share. A source
that has ended gives up its slots: frames are then shorter, the others keep their proportions, and no document is
dropped or repeated. Frames that hold the same counts have the same order, so only the frames in which the counts
change are scheduled: at most two for each source, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts of named sources. All others have OTHER_PARTS together, each by its volume and at least one.
WEIGHTS = {"src0": 20, "src1": 10, "src2": 10, "src3": 5, "src4": 5}
OTHER_PARTS = 50
# Sources that get parts of their own, those of the largest volume; smaller ones and rows without a source are one more.
MOST_SOURCES = 64
# Characters of a block, counting one for the end of each document. A document belongs to the block it starts in.
BLOCK_CHARS = 16_384
# First digits of the order key that make a cell. A source's running total is computed over at most 16 ** 3 cells, and
# within each cell alone.
CELL_DIGITS = 3

RESULT = ("mix_group", "block", "slot", "start")

# One slot: of the sources with a block that is left and released, the one whose block is due first.
_EARLIEST = """
array_min(transform(counts, (n, i) -> IF(
    s.done[i] < n AND (s.done[i] * slots) DIV greatest(n, 1L) <= t,
    named_struct('due', ((s.done[i] + 1) * slots + n - 1) DIV greatest(n, 1L), 'i', i),
    NULL)))
"""
_FRAME = f"""
aggregate(
    sequence(0L, slots - 1),
    named_struct('done', transform(counts, n -> 0L), 'turns', CAST(array() AS array<struct<i: int, nth: bigint>>)),
    (s, t) -> element_at(transform(array({_EARLIEST}), p -> named_struct(
        'done', transform(s.done, (d, i) -> IF(i = p.i, d + 1, d)),
        'turns', array_append(s.turns, named_struct('i', p.i, 'nth', s.done[p.i])))), 1),
    s -> s.turns)
"""


def target_weights(
    docs: DataFrame, source_col: str = "source", text_col: str = "text", chars_col: str | None = None
) -> tuple[dict[str, int], int]:
    """Parts of each source of a table, and those that the rest shares.

    Sources of WEIGHTS have the parts named there, also if the table has none of their rows. The others, rows without a
    source among them, get OTHER_PARTS by the volume of their texts, rounded, and one part at least.
    """
    chars = F.col(f"`{chars_col}`") if chars_col else F.length(F.col(f"`{text_col}`").cast("string"))
    source = F.col(f"`{source_col}`").cast("string")
    volumes = docs.groupBy(source.alias("source")).agg(F.sum(F.coalesce(chars, F.lit(0)).cast("long") + 1).alias("chars"))
    others = volumes.where(F.col("source").isNull() | ~F.col("source").isin(*WEIGHTS))
    total = others.agg(F.sum("chars")).first()[0] or 1
    own = others.where("source IS NOT NULL").orderBy(F.desc("chars"), "source").limit(MOST_SOURCES).collect()

    def parts(volume: int) -> int:
        return max(1, (2 * OTHER_PARTS * volume + total) // (2 * total))

    rest = total - sum(row.chars for row in own)
    return WEIGHTS | {row.source: parts(row.chars) for row in sorted(own)}, parts(rest)


def _parts(weights: dict[str, int], other_parts: int) -> Column:
    return F.array(*[F.lit(parts).cast("long") for parts in [*weights.values(), other_parts]])


def _group(source: Column, weights: dict[str, int]) -> Column:
    """Position of a row's source among the weights; the one after the last is shared by all others."""
    found = F.lit(len(weights))
    for i, name in enumerate(weights):
        found = F.when(source == name, i).otherwise(found)
    return found


def schedule(blocks: DataFrame, parts: Column) -> tuple[DataFrame, DataFrame]:
    """From ``mix``, ``n_blocks`` per source: its parts with the frames scheduled, and the turns of those frames."""
    sources = blocks.agg(F.sort_array(F.collect_list(F.struct("mix", "n_blocks"))).alias("all"))
    sources = sources.withColumn("parts", parts).selectExpr(
        "transform(all, x -> named_struct('mix', x.mix, 'n', x.n_blocks, 'a', parts[x.mix])) AS all"
    )
    sources = sources.selectExpr(
        "all", "array_distinct(flatten(transform(all, x -> array(0L, x.n DIV x.a, x.n DIV x.a + 1)))) AS frames"
    )
    of_source = sources.selectExpr("inline(all)", "frames").selectExpr("mix", "a AS parts", "frames")
    frames = sources.selectExpr("all", "explode(frames) AS frame").selectExpr(
        "all",
        "frame",
        "transform(all, x -> greatest(0L, least(x.a, x.n - x.a * frame))) AS counts",
        "aggregate(all, 0L, (total, x) -> total + least(x.n, x.a * frame)) AS first_slot",
    )
    frames = frames.withColumn("slots", F.expr("aggregate(counts, 0L, (total, n) -> total + n)")).where("slots > 0")
    turns = frames.selectExpr("all", "frame", "first_slot", "slots", f"posexplode({_FRAME}) AS (turn, block)")
    return of_source, turns.selectExpr(
        "frame", "all[block.i].mix AS mix", "block.nth AS nth", "first_slot", "slots AS frame_slots", "turn"
    )


def _scheduled(
    docs: DataFrame, weights: dict[str, int], other_parts: int, block_chars: int, id_col: str, source_col: str, chars: Column
) -> DataFrame:
    """The input as struct ``row`` with the result columns."""
    if min([*weights.values(), other_parts]) < 1 or block_chars < 1:
        raise ValueError("parts and block_chars must be whole numbers from 1")
    rows = docs.select(F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row"))
    row_id = F.col(f"row.`{id_col}`")
    rows = rows.withColumns(
        {
            "mix": _group(F.col(f"row.`{source_col}`").cast("string"), weights),
            # Rows without an id are dealt by what else they hold.
            "key": F.md5(F.coalesce(row_id.cast("string"), F.xxhash64("row").cast("string"))),
            "chars": F.coalesce(chars, F.lit(0)).cast("long") + 1,
        }
    ).withColumn("cell", F.substring("key", 1, CELL_DIGITS))
    cells = rows.groupBy("mix", "cell").agg(F.sum("chars").alias("chars"))
    earlier = Window.partitionBy("mix").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("mix", "cell", F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("cell_start"))
    blocks = cells.groupBy("mix").agg(F.ceil(F.sum("chars") / F.lit(block_chars)).cast("long").alias("n_blocks"))
    of_source, turns = schedule(blocks, _parts(weights, other_parts))

    before = Window.partitionBy("mix", "cell").orderBy("key", row_id, "chars").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    # The broadcast sides have at most 16 ** CELL_DIGITS + 1 rows for each weight, one, and two frames of all parts.
    placed = placed.join(F.broadcast(starts), ["mix", "cell"]).withColumn("start", F.expr("cell_start + before"))
    placed = placed.withColumn("block", F.expr(f"start DIV {block_chars}")).join(F.broadcast(of_source), "mix")
    placed = placed.selectExpr("*", "block DIV parts AS at_frame", "block % parts AS nth").withColumn(
        "frame", F.expr("array_max(filter(frames, x -> x <= at_frame))")
    )
    placed = placed.join(F.broadcast(turns), ["frame", "mix", "nth"])
    names = F.array(*[F.lit(name) for name in weights])
    return placed.select(
        "row",
        F.get(names, F.col("mix")).alias("mix_group"),
        "block",
        F.expr("first_slot + (at_frame - frame) * frame_slots + turn").alias("slot"),
        "start",
    )


def _chosen(
    docs: DataFrame, weights: dict[str, int] | None, other_parts: int | None, source_col: str, text_col: str, chars_col: str | None
) -> tuple[dict[str, int], int]:
    if weights is None:
        weights, rest = target_weights(docs, source_col, text_col, chars_col)
        return weights, other_parts or rest
    return weights, OTHER_PARTS if other_parts is None else other_parts


def interleave(
    docs: DataFrame,
    weights: dict[str, int] | None = None,
    other_parts: int | None = None,
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    chars_col: str | None = None,
) -> DataFrame:
    """Every row with ``mix_group``, ``block``, ``slot`` and ``start``; ordered by slot and start, the rows are the mixture.

    ``mix_group`` is the source if it has a weight of its own and else NULL; rows without a source are among the latter.
    ``block`` counts the blocks of a group and ``start`` its characters before the document. NULL and empty texts have
    only the one character that ends a document. Rows without an id are ordered by a hash of all their columns; of
    repeated rows each has a place. Without ``weights`` those of ``target_weights`` are taken; ``other_parts`` are the parts
    of all sources that have none, OTHER_PARTS if only ``weights`` are given. Columns of the input with the name of a result column are replaced. An empty table gives no rows.
    ``chars_col`` names a column with the lengths of the texts, if the texts themselves are not to be moved.
    """
    chars = F.col(f"row.`{chars_col}`") if chars_col else F.length(F.col(f"row.`{text_col}`").cast("string"))
    weights, other_parts = _chosen(docs, weights, other_parts, source_col, text_col, chars_col)
    found = _scheduled(docs, weights, other_parts, block_chars, id_col, source_col, chars)
    others = [F.col(f"row.`{name}`").alias(name) for name in docs.columns if name not in RESULT]
    return found.select(*others, *RESULT)


def mixture(
    docs: DataFrame,
    weights: dict[str, int] | None = None,
    other_parts: int | None = None,
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The rows of the input, with its columns, in the order of the mixture: its files, read by name, are in that order."""
    chars = F.length(F.col(f"row.`{text_col}`").cast("string"))
    weights, other_parts = _chosen(docs, weights, other_parts, source_col, text_col, None)
    found = _scheduled(docs, weights, other_parts, block_chars, id_col, source_col, chars)
    return found.repartitionByRange("slot", "start").sortWithinPartitions("slot", "start").select("row.*")
