"""Exact deduplication with a heavy-hitter split.

A text is known by its SHA-256. Digests that many rows share would load one reducer each, so they are found first
with Spark's frequent-item sketch (Misra-Gries counters, merged over all tasks), counted exactly and broadcast:
their rows are settled where they are read. The other digests go through one ordinary shuffle.

Defined results: null text counts as empty, so null and empty rows are one group. A null id is lower than every
other. Rows equal in id and text are told apart by their position, one of them stays. An empty table gives an
empty result. Only the two named columns are read; ``drop_duplicates`` returns all columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import packed, text_of
from storelens.session import staged

# A digest with more than this share of the rows is certainly found; at most 1 / SUPPORT digests are broadcast.
SUPPORT = 0.001


def frequent_digests(keys: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``digest``: at most ``1 / support`` rows, among them every digest above that share. Counts are not yet known."""
    return keys.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))


def verified(keys: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The frequent digests with their exact size and the row that stays; at most ``1 / support`` rows."""
    return (
        keys.join(F.broadcast(frequent_digests(keys, support)), "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("keeper"))
        .where("group_size > 1")
    )


def digest_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document, written once: ``row`` is fixed from here on."""
    keys = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text_of(text_col), 256).alias("digest"))
    return staged(keys.withColumn("row", F.monotonically_increasing_id()), "digests")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``; the largest id of equal texts stays."""
    keys = digest_keys(docs, id_col, text_col)
    heavy = staged(verified(keys, support), "heavy-digests")
    settled = keys.join(F.broadcast(heavy), "digest")
    same = Window.partitionBy("digest")
    others = (
        keys.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
        .withColumn("group_size", F.count(F.lit(1)).over(same))
        .withColumn("keeper", F.max(F.struct("doc_id", "row")).over(same))
    )
    return settled.unionByName(others).select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keeper.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows of a frequent digest leave where they are read unless they have the id that stays. The rest crosses one
    shuffle with its columns; each task sends at most one row per digest.
    """
    heavy = staged(verified(digest_keys(docs, id_col, text_col), support), "heavy-digests")
    losers = heavy.select(F.col("digest").alias("known"), F.col("keeper.doc_id").alias("keep_id"))
    rows = packed(docs).select(
        "whole",
        F.col(f"whole.`{id_col}`").alias("doc_id"),
        F.sha2(F.coalesce(F.col(f"whole.`{text_col}`"), F.lit("")), 256).alias("digest"),
        F.xxhash64("whole").alias("tie"),
    )
    left = rows.join(F.broadcast(losers), F.col("digest") == F.col("known"), "left").where(
        F.col("known").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    )
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last(), "tie")
    return left.withColumn("place", F.row_number().over(order)).where("place = 1").select("whole.*")
