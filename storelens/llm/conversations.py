"""Conversations in reply order, without the passages that messages quote from each other.

A line's quote level is the number of ``>`` it begins with. Lines of one level in a row are a passage. Passages are
normalised (lower case, single blanks) and hashed; so are the texts, paragraphs and lines that messages say
themselves. A passage belongs to the last earlier message of the conversation that says it, as a whole or, failing that,
one of its paragraphs or lines. A message answers what its outermost quotation belongs to, otherwise the message before
it. Replies are ordered by their depth in the tree of answers and then by turn, so that an answer follows what it answers.

Defined results: null and empty texts are messages without words. Null conversations are one conversation; null turns come
first. Messages of one turn are ordered by their position in the table. A quotation that nobody said earlier is removed
like any other and links nothing. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.session import staged

LEAST_WORDS = 3  # a shorter line alone doesn't tell who said it
_QUOTE = re.compile(r"^((?:\s*>)+)\s?(.*)$")
_ATTRIBUTION = re.compile(r"^\s*\S.*\b(?:wrote|writes|schrieb|a écrit|escribió)\s*:\s*$", re.I)


def levels(text: str) -> list[tuple[int, str]]:
    """Quote level and content of each line; a line that only names who is quoted next has the level of the quotation."""
    found = []
    for line in text.split("\n"):
        quote = _QUOTE.match(line)
        found.append((quote[1].count(">"), quote[2]) if quote else (0, line))
    for i in range(len(found) - 1):
        if found[i + 1][0] > found[i][0] and _ATTRIBUTION.match(found[i][1]):
            found[i] = (found[i + 1][0], "")
    return found


def passages(lines: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    found: list[tuple[int, list[str]]] = []
    for level, content in lines:
        if found and found[-1][0] == level:
            found[-1][1].append(content)
        else:
            found.append((level, [content]))
    return found


def key(text: str) -> int | None:
    """The hash of a normalised passage; none without a word."""
    words = text.lower().split()
    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63) if words else None


def keys(lines: list[str]) -> list[int]:
    """The whole, its paragraphs and its lines, in this order."""
    paragraphs = re.split(r"\n\s*\n", "\n".join(lines))
    parts = ["\n".join(lines), *(paragraphs if len(paragraphs) > 1 else ()), *(line for line in lines if len(line.split()) >= LEAST_WORDS)]
    return list(dict.fromkeys(k for k in map(key, parts) if k is not None))


def parsed(messages: DataFrame) -> DataFrame:
    """Written once: ``message, conv_id, turn, role, text, quotes, said``; ``text`` is what the message says itself."""
    kinds = messages.schema
    quote = T.StructType([T.StructField("rank", T.LongType()), T.StructField("key", T.LongType())])
    schema = T.StructType(
        [T.StructField("message", T.LongType()), T.StructField("conv_id", kinds["conv_id"].dataType), T.StructField("turn", kinds["turn"].dataType)]
        + [T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_quoted", T.LongType())]
        + [T.StructField("quotes", T.ArrayType(quote)), T.StructField("said", T.ArrayType(T.LongType()))]
    )
    arrow_quote = pa.list_(pa.struct([("rank", pa.int64()), ("key", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, quoted, quotes, said = [], [], [], []
            for value in batch.column(4):
                found = passages(levels(value.as_py() or ""))
                own = [line for level, content in found if level == 0 for line in content]
                texts.append("\n".join(own).strip())
                quoted.append(sum(len(content) for level, content in found if level))
                outer = sorted((level, i, content) for i, (level, content) in enumerate(found) if level)
                ranked = dict.fromkeys(k for _, _, content in outer for k in keys(content))
                quotes.append([{"rank": i, "key": k} for i, k in enumerate(ranked)])
                said.append(keys(own))
            columns = [*batch.columns[:4], pa.array(texts, pa.string()), pa.array(quoted, pa.int64()), pa.array(quotes, arrow_quote), pa.array(said, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = messages.select(F.monotonically_increasing_id().alias("message"), "conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    return staged(rows.mapInArrow(run, schema), "messages")


def quoted_from(rows: DataFrame) -> DataFrame:
    """``message, quoted``: the message that the outermost linked quotation belongs to."""
    asks = rows.select("message", "conv_id", "turn", F.explode("quotes").alias("q")).select("message", "conv_id", "turn", "q.rank", "q.key")
    wanted = asks.select("conv_id", "key").distinct().select(F.col("conv_id").alias("wanted_id"), F.col("key").alias("wanted"))
    says = rows.select("message", "conv_id", "turn", F.explode("said").alias("key"))
    says = says.join(wanted, F.col("conv_id").eqNullSafe(F.col("wanted_id")) & (F.col("key") == F.col("wanted")), "left_semi")
    both = asks.unionByName(says.withColumn("rank", F.lit(None).cast("long")))
    earlier = Window.partitionBy("conv_id", "key").orderBy("turn", "message").rowsBetween(Window.unboundedPreceding, -1)
    source = F.when(F.col("rank").isNull(), F.struct("turn", "message"))
    found = both.withColumn("source", F.last(source, ignorenulls=True).over(earlier)).where("rank IS NOT NULL AND source IS NOT NULL")
    found = found.where("source.message <> message")
    return found.groupBy("message").agg(F.min_by("source.message", "rank").alias("quoted"))


def depths(parents: DataFrame) -> DataFrame:
    """``message, depth``: steps to the root, by doubling: each round a message's reach is added to that of where it ends.

    A message that has arrived at its root takes part only as what others end at, so that one long conversation has
    its rounds to itself.
    """
    now = staged(parents.select("message", F.col("parent").alias("up"), F.col("parent").isNotNull().cast("long").alias("depth")), "reach")
    arrived, under_way = now.where("up IS NULL"), now.where("up IS NOT NULL")
    while under_way.limit(1).count():
        reach = arrived.unionByName(under_way)
        further = reach.select(F.col("message").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        now = staged(under_way.join(further, "up").select("message", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth")), "reach")
        arrived, under_way = arrived.unionByName(now.where("up IS NULL")), now.where("up IS NOT NULL")
    return arrived.select("message", "depth")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``place``: the number of a row in the whole order, from 0, worked out slice by slice."""
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    laid = staged(laid.withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))), "ordered")
    sizes = laid.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))  # a row per slice
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return laid.join(starts, "slice").withColumn("place", F.col("start") + F.col("at")).drop("slice", "at", "start")


def linked(messages: DataFrame) -> DataFrame:
    """Per message: ``conv_id, turn, role, text, parent_turn, quotes_parent, depth, position, n_quoted``.

    ``position`` is the place in the conversation's reply order, from 0. ``messages`` has ``conv_id, turn, role, text``.
    """
    rows = parsed(messages)
    order = ["conv_id", "turn", "message"]
    line = staged(numbered(rows.select("conv_id", "turn", "message"), order), "line")
    previous = line.select((F.col("place") + 1).alias("place"), F.col("conv_id").alias("previous_id"), F.col("message").alias("previous"))
    parents = line.join(previous, "place", "left").join(quoted_from(rows), "message", "left")
    before = F.when(F.col("conv_id").eqNullSafe(F.col("previous_id")), F.col("previous"))
    parents = staged(parents.select("message", F.coalesce("quoted", before).alias("parent"), F.col("quoted").isNotNull().alias("quotes_parent")), "parents")
    deep = depths(parents)
    turns = rows.select(F.col("message").alias("parent"), F.col("turn").alias("parent_turn"))
    whole = rows.drop("quotes", "said").join(parents, "message").join(deep, "message").join(turns, "parent", "left")
    placed = staged(numbered(whole, ["conv_id", "depth", "turn", "message"]), "placed")
    first = staged(placed.groupBy("conv_id").agg(F.min("place").alias("first")), "first-places").withColumnRenamed("conv_id", "own_id")
    return placed.join(first, F.col("conv_id").eqNullSafe(F.col("own_id"))).select(
        "conv_id", "turn", "role", "text", "parent_turn", "quotes_parent", "depth", (F.col("place") - F.col("first")).alias("position"), "n_quoted"
    )
