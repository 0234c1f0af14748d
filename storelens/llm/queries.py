"""The corpus operators over their tables, one query each, and the SQL that some of them must equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import (
    centroids,
    conversations,
    decontamination,
    exact_dedup,
    extraction,
    language_model,
    packing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    substrings,
    suffix_copies,
)
from storelens.llm.common import table
from storelens.session import application_dir, staged

QUERIES = {}
STATEMENTS = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, distinct=False, max_distance=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


STATEMENTS["op9_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op10_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `bytes`: eight shards of nearly equal size through a stored map, and the shard under its next version for nine."""
    rows = sharding.records(table(spark, sf_dir, "documents"))
    folder = f"{application_dir(spark)}/slot-maps/{sharding.folder_name(sf_dir)}"
    sizes = staged(sharding.slot_bytes(rows), "slot-bytes")
    version = sharding.store_map(sharding.edited_map(sizes, 8), folder)
    first = sharding.load_map(spark, folder, version)
    grown = sharding.load_map(spark, folder, sharding.store_map(sharding.edited_map(sizes, 9, before=first), folder))
    next_shard = F.broadcast(grown.select("virtual_slot", F.col("shard").alias("next_shard")))
    return sharding.placed(rows, first).join(next_shard, "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "next_shard",
    )


@query
def op8_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.kept_words(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(table(spark, sf_dir, "pages"))


@query
def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


@query
def op5_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.linked(table(spark, sf_dir, "conversations"))


@query
def op11_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_copies.kept_bytes(table(spark, sf_dir, "documents"))
    spans = F.size("removed").cast("bigint").alias("n_spans")
    return rows.select("doc_id", "n_bytes", "n_removed", spans, F.sha2("kept", 256).alias("kept_sha256"))


# Windows are compared by their MD5; runs of windows less than 200 bytes apart are one removed run.
STATEMENTS["op11_repeated_bytes"] = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
    FROM documents),
windows AS (
    SELECT r, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 400)) AS k
    FROM (SELECT r, h, unnest(range(0, n - 199)) AS i FROM texts)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1),
told AS (
    SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM again),
runs AS (
    SELECT r, min(i) AS a, max(i) + 200 AS b
    FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM told)
    GROUP BY r, run),
pieces AS (
    SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM runs
    UNION ALL
    SELECT texts.r, coalesce(last, 0), n FROM texts LEFT JOIN (SELECT r, max(b) AS last FROM runs GROUP BY r) ends ON texts.r = ends.r),
kept AS (
    SELECT r, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS h
    FROM pieces JOIN texts USING (r) GROUP BY r),
removed AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM texts JOIN kept USING (r) LEFT JOIN removed USING (r)
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))
    return nodes.withColumnRenamed("saved_bytes", "saved_tokens")


# CRC 32 is a fold over the digits of the id and the eight bits of each.
STATEMENTS["op12_prefix_trie"] = """
WITH given AS (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
           substr(sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS d
    FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
    SELECT conv_id, d, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS pos FROM given),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS source,
           xor(list_reduce(
               list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
               lambda crc, byte: list_reduce(
                   list_concat([xor(crc, byte)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                   lambda x, z: xor(x >> 1, (x & 1) * 3988292384))),
               CAST(4294967295 AS BIGINT)) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT c.conv_id, t.pos, 0 AS part, d, bytes FROM convs c JOIN turns t ON t.conv_id = c.source AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, t.pos, 1 AS part, d, bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
paths AS (
    SELECT conv_id, bytes, string_agg(d, '') OVER along AS path, row_number() OVER along AS depth
    FROM rebuilt WINDOW along AS (PARTITION BY conv_id ORDER BY part, pos)
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs),
nodes AS (
    SELECT path, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM paths GROUP BY path),
children AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
ends AS (
    SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, max_by(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path),
lifted AS (
    SELECT left(path, 32 * up) AS path, leaf, saved
    FROM (SELECT nodes.path, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * bytes AS saved,
                 unnest(range(0, depth + 1)) AS up
          FROM nodes LEFT JOIN children ON children.path = nodes.path)),
sums AS (SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved FROM lifted GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n
JOIN sums ON sums.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 32 * (n.depth - 1))
LEFT JOIN children ON children.path = n.path
LEFT JOIN ends ON ends.path = n.path
"""


@query
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.clustered(table(spark, sf_dir, "embeddings")))


def _clusters_sql(rounds: int) -> str:
    """Assignments and moved centroids of each round, by the whole distance to every centroid."""
    parts = [
        """
kept AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
    FROM (SELECT v, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h FROM kept ORDER BY h, v LIMIT 16))"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""
a{i} AS (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'k': k}}) AS best
    FROM (SELECT r, vec_id, v, k,
                 CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
          FROM kept CROSS JOIN m{i})
    GROUP BY r)"""
        )
        if i < rounds:
            parts.append(
                f"""
m{i + 1} AS (
    SELECT m{i}.k, coalesce(moved.c, m{i}.c) AS c
    FROM m{i} LEFT JOIN (
        SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
        FROM (SELECT best.k AS k, i, sum(x) AS s, count(*) AS n
              FROM (SELECT best, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY ALL)
        GROUP BY k) moved ON moved.k = m{i}.k)"""
            )
    return (
        "WITH"
        + ",".join(parts)
        + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m{rounds}.c, ',')) AS centroid_sha256
FROM a{rounds} JOIN m{rounds} ON m{rounds}.k = best.k
"""
    )


STATEMENTS["op13_centroid_clusters"] = _clusters_sql(3)
