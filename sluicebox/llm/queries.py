"""The queries of this subpackage, and the same as DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm import (
    chat,
    classify,
    conversation_trie,
    decontamination,
    exact_dedup,
    language,
    mixing,
    near_dedup,
    packing,
    quality,
    spelling,
    toxicity,
    vector_dedup,
    warc,
)
from sluicebox.llm.text_sql import OP11_SQL, OP12_SQL, OP13_SQL
from sluicebox.llm.work import new_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces of token sequences."""
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the toxicity of its whole text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    scored = toxicity.score(docs, toxicity.fit_on(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        classify.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "toxic",
    )


def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record says that was written to archives and read back."""
    path = new_folder(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path)


def op4_quality_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the quality of its whole text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit_on(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", classify.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op5_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language; those learned have a centroid, others have the nearest."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = language.identify(docs, language.fit_on(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op6_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its component and the number of its links."""
    return vector_dedup.mark_near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its block and slot in the mixture of sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("chars"))
    return mixing.interleave(docs, chars_col="chars").drop("chars")


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call derived from the conversations, with its result and order."""
    return chat.link_tool_calls(*chat.calls_of(_table(spark, sf_dir, "conversations")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy of its text that stays."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs).drop("text")


OP9_SQL = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text) AS kept,
       sha256(text) AS text_sha256
FROM normal
"""


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near copies."""
    return near_dedup.mark_near_copies(_table(spark, sf_dir, "documents"), words=4)


def op11_fm_index_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its nearest frequent spelling."""
    return spelling.spelling_forms(_table(spark, sf_dir, "documents"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what it shares with the benchmark."""
    return decontamination.mark_contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


OP6_SQL = """
WITH RECURSIVE
vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM vectors
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT r.a AS vec_id, (SELECT COUNT(*) FROM links l WHERE l.a = r.a) AS n_links, MIN(r.b) AS component_id, MIN(r.b) = r.a AS kept
FROM reached r GROUP BY r.a
"""

# The weights of llm.mixing, its frames and turns, one slot after another.
OP7_SQL = """
WITH RECURSIVE
named AS (SELECT unnest([0, 1, 2, 3, 4]) AS mix, unnest(['src0', 'src1', 'src2', 'src3', 'src4']) AS mix_group, unnest([20, 10, 10, 5, 5]) AS parts),
volumes AS (
    SELECT source, CAST(SUM(COALESCE(length(text), 0) + 1) AS BIGINT) AS chars FROM documents
    WHERE source IS NULL OR source NOT IN (SELECT mix_group FROM named) GROUP BY source
),
total AS (SELECT CAST(COALESCE(SUM(chars), 1) AS BIGINT) AS total FROM volumes),
weights AS (
    SELECT mix, mix_group, parts FROM named
    UNION ALL
    SELECT 4 + row_number() OVER (ORDER BY source), source, GREATEST(1, (100 * chars + total) // (2 * total)) FROM volumes, total WHERE source IS NOT NULL
    UNION ALL
    SELECT 5 + (SELECT COUNT(source) FROM volumes), NULL,
           GREATEST(1, (100 * COALESCE((SELECT chars FROM volumes WHERE source IS NULL), 0) + total) // (2 * total)) FROM total
),
docs AS (
    SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS key, COALESCE(length(text), 0) + 1 AS chars,
           COALESCE((SELECT w.mix FROM weights w WHERE w.mix_group = d.source), (SELECT MAX(mix) FROM weights)) AS mix
    FROM documents d
),
placed AS (
    SELECT *, CAST(COALESCE(SUM(chars) OVER (
        PARTITION BY mix ORDER BY key, doc_id, chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM docs
),
sources AS (
    SELECT w.mix, w.mix_group, w.parts, CAST((SUM(d.chars) + 16383) // 16384 AS BIGINT) AS n
    FROM docs d JOIN weights w ON w.mix = d.mix GROUP BY w.mix, w.mix_group, w.parts
),
starts AS (
    SELECT 0 AS frame UNION SELECT n // parts FROM sources UNION SELECT n // parts + 1 FROM sources
),
counts AS (
    SELECT frame, mix, GREATEST(0, LEAST(parts, n - parts * frame)) AS n, LEAST(n, parts * frame) AS before
    FROM starts CROSS JOIN sources
),
frames AS (
    SELECT frame, list(n ORDER BY mix) AS n, list(mix ORDER BY mix) AS mixes, CAST(SUM(n) AS BIGINT) AS slots,
           CAST(SUM(before) AS BIGINT) AS first_slot
    FROM counts GROUP BY frame HAVING SUM(n) > 0
),
turns AS (
    SELECT frame, n, slots, CAST(-1 AS BIGINT) AS turn, list_transform(n, lambda x: CAST(0 AS BIGINT)) AS done, CAST(0 AS BIGINT) AS pick,
           CAST(0 AS BIGINT) AS nth
    FROM frames
    UNION ALL
    SELECT frame, n, slots, turn, list_transform(range(1, len(n) + 1), lambda i: done[i] + CASE WHEN i = pick THEN 1 ELSE 0 END), pick, done[pick]
    FROM (
        SELECT frame, n, slots, turn + 1 AS turn, done, list_min(list_filter(list_transform(range(1, len(n) + 1), lambda i:
            CASE WHEN done[i] < n[i] AND (done[i] * slots) // n[i] <= turn + 1
                 THEN (((done[i] + 1) * slots + n[i] - 1) // n[i]) * 100 + i END), lambda x: x IS NOT NULL)) % 100 AS pick
        FROM turns WHERE turn + 1 < slots
    )
),
schedule AS (
    SELECT t.frame, f.mixes[t.pick] AS mix, t.nth, f.first_slot, f.slots, t.turn
    FROM turns t JOIN frames f ON f.frame = t.frame WHERE t.turn >= 0
),
blocks AS (
    SELECT p.doc_id, p.source, s.mix_group, s.mix, p.start // 16384 AS block, p.start, (p.start // 16384) // s.parts AS at_frame,
           (p.start // 16384) % s.parts AS nth,
           (SELECT MAX(frame) FROM starts WHERE frame <= (p.start // 16384) // s.parts) AS frame
    FROM placed p JOIN sources s ON s.mix = p.mix
)
SELECT b.doc_id, b.source, b.mix_group, b.block, t.first_slot + (b.at_frame - b.frame) * t.slots + t.turn AS slot, b.start
FROM blocks b JOIN schedule t ON t.frame = b.frame AND t.mix = b.mix AND t.nth = b.nth
"""

OP10_SQL = r"""
WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
placed AS (SELECT doc_id, len(w) AS words, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
grams AS (
    SELECT doc_id, word || ' ' || LEAD(word, 1) OVER w || ' ' || LEAD(word, 2) OVER w || ' ' || LEAD(word, 3) OVER w AS shingle
    FROM placed WHERE words >= 4 WINDOW w AS (PARTITION BY doc_id ORDER BY place)
    UNION ALL
    SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 3
),
sets AS (SELECT DISTINCT doc_id, shingle FROM grams WHERE shingle IS NOT NULL),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
shingles AS (SELECT s.doc_id, z.n, s.shingle FROM sets s JOIN sizes z ON z.doc_id = s.doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))
),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT r.a AS doc_id, COALESCE(z.n, 0) AS n_shingles, MIN(r.b) AS component_id, MIN(r.b) = r.a AS kept
FROM reached r LEFT JOIN sizes z ON z.doc_id = r.a GROUP BY r.a, z.n
"""

QUERIES = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_toxicity_cnn": op2_toxicity_cnn,
    "op3_warc_segments": op3_warc_segments,
    "op4_quality_bytes": op4_quality_bytes,
    "op5_language_centroids": op5_language_centroids,
    "op6_sorted_projections": op6_sorted_projections,
    "op7_pfair_mixing": op7_pfair_mixing,
    "op8_tool_calls": op8_tool_calls,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_fm_index_spelling": op11_fm_index_spelling,
    "op12_winnowing": op12_winnowing,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE_SQL = {
    "op6_sorted_projections": OP6_SQL,
    "op7_pfair_mixing": OP7_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op10_minhash_dedup": OP10_SQL,
    "op11_fm_index_spelling": OP11_SQL,
    "op12_winnowing": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
