"""The queries over the corpus tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.block_dedup import block_dedup
from tallyhouse.llm.centroids import cluster_report, shallot_clusters
from tallyhouse.llm.chat_format import prefix_examples, read_back
from tallyhouse.llm.common import fold, table
from tallyhouse.llm.conversation_trie import conversation_trie
from tallyhouse.llm.decontamination import contaminated
from tallyhouse.llm.exact_dedup import exact_dedup
from tallyhouse.llm.language_model import train_and_score
from tallyhouse.llm.packing import pack
from tallyhouse.llm.simhash import simhash_components
from tallyhouse.llm.suffix_dedup import suffix_dedup
from tallyhouse.llm.token_counts import count_tokens, sentencepiece_vocabulary
from tallyhouse.llm.toxicity import fit_toxicity, score_toxicity
from tallyhouse.llm.url_filter import filter_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_exact_dedup(spark, folder):
    result = exact_dedup(table(spark, folder, "documents"))
    return result.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLES["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op2_packing(spark, folder):
    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op4_token_counts(spark, folder):
    pieces = sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return count_tokens(table(spark, folder, "documents"), pieces).withColumnRenamed("id", "doc_id")


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query
def op9_url_filter(spark, folder):
    """Pages are labelled through the row of ``labels`` with their number: poor or toxic means block."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").select("doc_id", F.expr("quality = 0 OR toxic = 1").alias("blocked"))
    labelled = pages.join(labels, pages.page_id == labels.doc_id).where("blocked is not null").select("url", "blocked")
    judged = filter_urls(pages, labelled, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.array_join("mined_rule", " ").alias("mined_rule"), "confidence")


@query
def op6_simhash(spark, folder):
    groups = simhash_components(table(spark, folder, "documents"))
    fingerprint = F.lower(F.lpad(F.hex(F.col("fp").getItem(0)), 16, "0"))
    return groups.select(F.col("id").alias("doc_id"), fingerprint.alias("fingerprint"), F.col("component").alias("component_id"))


TOXIC_FROM = 0.3


def toxicity_model(docs: DataFrame, labels: DataFrame):
    """Learns from all labelled rows but those of the held-out fold."""
    known = labels.where(fold(F.col("doc_id"), 4) != 2).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    return fit_toxicity(docs, known)


@query
def op8_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity_model(docs, table(spark, folder, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )


@query
def op3_suffix_dedup(spark, folder):
    result = suffix_dedup(table(spark, folder, "documents"), 200)
    return result.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op10_block_dedup(spark, folder):
    result = block_dedup(table(spark, folder, "documents"), 50)
    return result.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op5_decontamination(spark, folder):
    pairs = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return pairs.withColumnRenamed("id", "doc_id")


@query
def op7_language_model(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scores, model = train_and_score(docs, docs.where(fold(F.col("doc_id"), 7) != 2))
    return scores.select(
        F.col("id").alias("doc_id"),
        (fold(F.col("id"), 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op11_chat_format(spark, folder):
    """All conversations, and one more whose texts look like markers of common templates."""
    said = F.lit("\\### Assistant: </turn> ok")
    number, role = F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), number.alias("turn"), role.alias("role"), said.alias("text"))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return read_back(prefix_examples(turns)).withColumnRenamed("conv", "conv_id")


# A turn takes its role and text, escaped, and 15 characters of markers and line breaks.
ORACLES["op11_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *, 15 + length(replace(regexp_replace(replace(role, '\', '\\'), '<(/?turn)', '\\l\1', 'g'), chr(10), '\n'))
           + length(regexp_replace(replace(text, '\', '\\'), '<(/?turn)', '\\l\1', 'g')) AS size,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS final
    FROM turns
), summed AS (
    SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS prefix FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (role = 'assistant' OR final) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""


@query
def op13_conversation_trie(spark, folder):
    return conversation_trie(table(spark, folder, "conversations"))


# DuckDB has no CRC-32: it is folded over one mark for each digit and eight steps of the reflected
# polynomial after it.
_CRC32 = """list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), flatten(list_transform(range(1, length(digits) + 1),
    lambda i: list_prepend(CAST(ascii(substr(digits, i, 1)) AS UBIGINT), CAST([256, 256, 256, 256, 256, 256, 256, 256] AS UBIGINT[]))))),
    lambda c, x: CASE WHEN x < 256 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END)"""

ORACLES["op13_conversation_trie"] = rf"""
WITH turns AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv, CAST(conv AS VARCHAR) AS digits FROM (SELECT DISTINCT conv FROM turns)
), cuts AS (
    SELECT conv, CAST(xor({_CRC32}, CAST(4294967295 AS UBIGINT)) % 4 AS INTEGER) AS h FROM convs
), rebuilt AS (
    SELECT c.conv, t.place, t.role, t.text FROM cuts c JOIN turns t ON t.conv = c.conv - c.conv % 20 AND t.place <= c.h
    UNION ALL SELECT c.conv, t.place, t.role, t.text FROM cuts c JOIN turns t ON t.conv = c.conv AND t.place > c.h
), numbered AS (
    SELECT conv, row_number() OVER (PARTITION BY conv ORDER BY place) AS depth,
           sha256(length(role) || ':' || role || text) AS turn, len(regexp_extract_all(text, '[^ 	-
]+')) AS words
    FROM rebuilt
), paths AS (
    SELECT conv, depth, words, string_agg(turn, '') OVER (PARTITION BY conv ORDER BY depth) AS node FROM numbered
    UNION ALL SELECT conv, 0, 0, '' FROM cuts
), lengths AS (SELECT conv, max(depth) AS depth FROM paths GROUP BY conv),
nodes AS (
    SELECT node, p.depth, min(p.conv) AS conv, count(*) AS n, max(words) AS words,
           sha256(coalesce(string_agg(CAST(p.conv AS VARCHAR), ',' ORDER BY p.conv) FILTER (p.depth = l.depth), '')) AS ends
    FROM paths p JOIN lengths l ON l.conv = p.conv GROUP BY node, p.depth
), family AS (
    SELECT c.*, p.conv AS parent_conv, count(k.node) AS children
    FROM nodes c LEFT JOIN nodes p ON c.depth > 0 AND p.node = substr(c.node, 1, length(c.node) - 64)
    LEFT JOIN nodes k ON k.depth > 0 AND substr(k.node, 1, length(k.node) - 64) = c.node
    GROUP BY ALL
), sums AS (
    SELECT substr(f.node, 1, CAST(64 * up.d AS BIGINT)) AS node, CAST(count(*) FILTER (children = 0) AS BIGINT) AS leaves,
           CAST(sum((n - 1) * words) AS BIGINT) AS saved
    FROM family f, LATERAL (SELECT unnest(range(f.depth + 1)) AS d) up GROUP BY 1
)
SELECT conv AS conv_id, CAST(depth AS BIGINT) AS depth, parent_conv AS parent_conv_id, n AS n_convs, children AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, ends AS ends_sha256
FROM family JOIN sums USING (node)
"""


@query
def op12_centroid_clusters(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return cluster_report(*shallot_clusters(vectors)).withColumnRenamed("id", "vec_id")


def _cluster_rounds(rounds: int) -> str:
    """Assignment to the nearest centroid and its replacement by the floor of the mean, ``rounds`` times, then one more assignment."""
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""assigned{i} AS MATERIALIZED (
    SELECT row, any_value(id) AS id, any_value(v.x) AS x, min(row(list_sum(list_transform(list_zip(v.x, c.x),
           lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS BIGINT)))::BIGINT, num)) AS best
    FROM kept v, centroids{i} c GROUP BY row
)""")
        if i < rounds:
            parts.append(f"""sums{i} AS (
    SELECT best[2] AS num, k, sum(x[k])::BIGINT AS s, count(*) AS n FROM assigned{i}, range(1, 65) t(k) GROUP BY 1, 2
), centroids{i + 1} AS MATERIALIZED (
    SELECT c.num, coalesce(m.x, c.x) AS x FROM centroids{i} c
    LEFT JOIN (SELECT num, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x FROM sums{i} GROUP BY num) m USING (num)
)""")
    return ", ".join(parts)


ORACLES["op12_centroid_clusters"] = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id AS id,
           list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64
), centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || id), x) - 1 AS num, x FROM kept WHERE id IS NOT NULL
    ORDER BY sha256('2:' || id), x LIMIT 40
), {_cluster_rounds(5)}
SELECT a.id AS vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance,
       CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM assigned5 a JOIN centroids5 c ON c.num = best[2]
"""
