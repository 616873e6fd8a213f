"""Exact duplicates by sorting content.

Rows are range-partitioned by their normalised text with sampled splitters and sorted within each partition, which
places equal texts next to each other; neighbours are then compared in full. A splitter is the start of a text, its
digest and a salt. Groups of many copies get salts, so that a group larger than a partition is cut over several; the
totals of such groups are aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Runs of these characters count as one space. No other character is changed.
SPACES = r"[\x20\x09-\x0D]+"
# Characters of the text that a splitter starts with.
SPLITTER_CHARS = 32
# Groups of up to so many copies are never cut.
WHOLE_GROUP = 64
# The largest groups, so many per shuffle partition, are cut. Every other group is smaller than a partition's share.
CUT_PER_PARTITION = 4

RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The input as struct ``row`` with the four result columns."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row"))
    text, row_id = normalised(F.col(f"row.`{text_col}`")), F.col(f"row.`{id_col}`")
    # Together, so that a text is normalised once for both.
    rows = rows.withColumns({"sha": F.sha2(text, 256), "splitter": F.substring(text, 1, SPLITTER_CHARS)})
    large = (
        rows.groupBy("sha")
        .agg(F.min(row_id).alias("large_keep"), F.count("*").alias("large_size"))
        .where(F.col("large_size") > WHOLE_GROUP)
        .orderBy(F.desc("large_size"), "sha")
        .limit(CUT_PER_PARTITION * partitions)
    )
    # At most CUT_PER_PARTITION rows for each partition, whatever the input.
    salt = F.when(F.col("large_size").isNotNull(), F.pmod(F.xxhash64(row_id), F.lit(partitions))).otherwise(0)
    salted = rows.join(F.broadcast(large), "sha", "left").withColumn("salt", salt)
    placed = salted.repartitionByRange("splitter", "sha", "salt").withColumn("text", text)
    # The partitioning above serves this window too, so it sorts without a second shuffle.
    equal = Window.partitionBy("splitter", "sha", "salt", "text").orderBy(row_id.asc_nulls_last())
    group = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = placed.select(
        "row",
        "sha",
        F.row_number().over(equal).alias("nth"),
        F.coalesce("large_keep", F.min(row_id).over(group)).alias("keep_id"),
        F.coalesce("large_size", F.count("*").over(group)).alias("group_size"),
    )
    return compared.select(
        "row",
        "keep_id",
        "group_size",
        ((F.col("nth") == 1) & row_id.eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after each run of white space became one space. NULL is an empty text, and
    empty texts are equal to one another. Of equal texts the row with the smallest id is kept; of repeated rows with
    that id, one. Rows without an id are kept only if their whole group has none (then one of them, with a NULL
    ``keep_id``). Columns of the input with the name of a result column are replaced. An empty table gives no rows.
    """
    marked = _marked(docs, id_col, text_col)
    others = [F.col(f"row.`{name}`").alias(name) for name in docs.columns if name not in RESULT]
    return marked.select(*others, *RESULT)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``mark_copies`` keeps, with the columns of the input."""
    return _marked(docs, id_col, text_col).where("kept").select("row.*")
