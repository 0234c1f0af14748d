"""The trie of conversation prefixes, found by digests of fixed-length blocks of turns.

Turns are numbered along each conversation and cut into blocks of ``BLOCK`` turns. A block is named by a digest of all
turns up to its end: the digests of its own turns, joined to the exclusive-or of the digests of the blocks before it,
each hashed with its place. Conversations are first grouped by whole blocks. Only where a block has siblings, other
blocks after the same beginning, are the turns inside it grouped one by one; elsewhere a block's turns have its members.

Sums over subtrees need no walk over the trie. The smallest member of a node owns it, and what a conversation owns is
an end piece of its path. So the nodes below a node are those its members own, but for the owner, of whose path they take
everything from the node on; and a leaf counts for the one member that owns it. All are sums over members,
taken with a second grouping of the same blocks.

Nothing depends on one task holding a conversation or a node: turns are numbered in range-partitioned slices, running
sums go over chunks of blocks, groupings are added up before the shuffle, and the ids that end in a node are joined into
texts of bounded length first and then hashed as a stream.

Defined results: turns are ordered by number, null first; equal numbers by a digest of role and text. Null role or text is
empty. Rows without a conversation id belong to none and are left out. Repeated rows are turns of their own. A table
without conversations gives no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import finished, text_of
from storelens.session import staged

BLOCK = 4
# Blocks of a conversation are summed in chunks of this many.
CHUNK = 1024
# Conversation ids per joined text.
JOINED = 1000
ROOT = "0" * 32
_ROW_BITS = 33


# ---------------------------------------------------------------- turns


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, digest, bytes, slice`` per turn, counted from 0, and ``conv_id, n_turns``.

    Turns are range-partitioned by conversation and place, so a long conversation lies in many slices. The place in the
    slice is written; what a conversation has in earlier slices is a sum over at most as many rows as there are slices.
    """
    role, text = text_of("role"), text_of("text")
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    narrow = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.substring(F.sha2(F.encode(whole, "UTF-8"), 256), 1, 32).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = staged(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()).drop("turn"),
        "turns",
    ).withColumn("slice", F.shiftright("place", _ROW_BITS))
    runs = placed.groupBy("conv_id", "slice").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    runs = staged(runs.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))), "runs")
    turns = placed.join(runs, ["conv_id", "slice"]).select(
        "conv_id", (F.col("place") - F.col("start") + F.col("before")).alias("pos"), "digest", "bytes"
    )
    return turns, runs.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family of ``FAMILY``."""
    return F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % 9


FAMILY = 5


def rebuilt(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Conversations that begin with turns of another one: ``conv_id, pos, digest, bytes``.

    The first ``borrowed`` turns come from the conversation ``conv_id - conv_id % FAMILY``; a conversation's own turns
    follow from the same number on.
    """
    turns = staged(turns, "numbered")
    sizes = staged(sizes, "sizes")
    source = F.col("conv_id") - F.col("conv_id") % FAMILY
    lender = sizes.select(F.col("conv_id").alias("source"), F.col("n_turns").alias("lent"))
    asked = sizes.select("conv_id", borrowed(F.col("conv_id")).alias("h"), source.alias("source")).join(lender, "source", "left")
    asked = staged(asked.select("conv_id", "h", F.least("h", F.coalesce("lent", F.lit(0))).alias("taken")), "borrowed")
    own = turns.join(asked, "conv_id").where("pos >= h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "digest", "bytes")
    # The ids of a family lie on one side of zero, so that the remainder has the sign of the id.
    near = F.explode(F.sequence(F.when(F.col("conv_id") > 0, 0).otherwise(1 - FAMILY), F.when(F.col("conv_id") < 0, 0).otherwise(FAMILY - 1)))
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < 8)).select("*", near.alias("away"))
    lent = first.select((F.col("conv_id") + F.col("away")).alias("conv_id"), "pos", "digest", "bytes")
    lent = lent.join(asked, "conv_id").where("pos < h").select("conv_id", "pos", "digest", "bytes")
    return own.unionByName(lent)


# ---------------------------------------------------------------- blocks


def blocks_of(turns: DataFrame) -> DataFrame:
    """A row per block of each conversation, written once.

    ``before`` and ``ids`` name the nodes before the block and at each of its turns; ``sizes`` are the bytes of its turns
    and ``bytes_before`` those of all turns before it.
    """
    entry = F.struct("pos", "digest", "bytes")
    cut = turns.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    cut = cut.select("conv_id", "block", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("sizes"))
    own = F.sha2(F.encode(F.concat(F.col("block").cast("string"), F.lit(":"), F.array_join("digests", "")), "UTF-8"), 256)
    lane = lambda at: F.conv(F.substring(own, at, 16), 16, -10).cast("bigint")
    cut = cut.select(
        "*",
        F.floor(F.col("block") / CHUNK).alias("chunk"),
        lane(1).alias("a"),
        lane(17).alias("b"),
        F.aggregate("sizes", F.lit(0).cast("bigint"), lambda x, y: x + y).alias("bytes"),
    )
    cut = staged(cut, "blocks")
    sums = [("a", F.bit_xor), ("b", F.bit_xor), ("bytes", F.sum)]
    inside = Window.partitionBy("conv_id", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Conversations of one chunk have nothing in earlier ones.
    earlier = cut.groupBy("conv_id", "chunk").agg(*[f(c).alias(c) for c, f in sums])
    earlier = earlier.select("conv_id", "chunk", *[f(c).over(along).alias(f"{c}_early") for c, f in sums]).where("chunk > 0")
    running = cut.select("*", *[f(c).over(inside).alias(f"{c}_in") for c, f in sums])
    joined = running.join(staged(earlier, "chunks"), ["conv_id", "chunk"], "left")
    zero = F.lit(0).cast("bigint")
    part = lambda c: (F.coalesce(f"{c}_early", zero), F.coalesce(f"{c}_in", zero))
    xor = lambda c: part(c)[0].bitwiseXOR(part(c)[1])
    name = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    named = joined.select(
        "conv_id",
        "block",
        "digests",
        "sizes",
        "bytes",
        (part("bytes")[0] + part("bytes")[1]).alias("bytes_before"),
        name(xor("a"), xor("b")).alias("before"),
        name(xor("a").bitwiseXOR(F.col("a")), xor("b").bitwiseXOR(F.col("b"))).alias("after"),
    )

    def node(t: Column) -> Column:
        begun = F.concat(F.col("before"), F.lit("/"), F.array_join(F.slice("digests", F.lit(1), t), ""))
        return F.when(t == BLOCK, F.col("after")).otherwise(F.substring(F.sha2(F.encode(begun, "UTF-8"), 256), 1, 32))

    ids = F.transform(F.sequence(F.lit(1), F.size("digests")), node)
    whole = named.select("conv_id", "block", "before", ids.alias("ids"), "sizes", "bytes", "bytes_before")
    return staged(whole.withColumn("end", F.element_at("ids", -1)), "named-blocks")


def grouped(blocks: DataFrame) -> DataFrame:
    """Conversations grouped by whole blocks, written once: a row per different block, with ``alone`` where it has no sibling."""
    groups = blocks.groupBy("end").agg(
        *[F.first(c).alias(c) for c in ("block", "before", "ids", "sizes", "bytes_before")],
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("owner"),
    )
    groups = staged(groups, "block-groups")
    siblings = staged(groups.where("block > 0").groupBy("before").agg(F.count(F.lit(1)).alias("siblings")), "siblings")
    # The first blocks are siblings of each other.
    return staged(groups.join(siblings, "before", "left").withColumn("alone", F.coalesce(F.col("siblings") == 1, F.lit(False))), "told-blocks")


def nodes_of(groups: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """A row per node, from the block groups; ``sums`` are aggregates of their columns over siblings that agree on a turn."""
    at = F.posexplode("ids").alias("i", "id")
    values = list(sums)
    opened = groups.select("*", at).select(
        "id",
        F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("ids", F.col("i") - 1)).alias("parent_id"),
        (F.col("block") * BLOCK + F.col("i") + 1).alias("depth"),
        F.get("sizes", F.col("i")).alias("bytes"),
        (F.col("bytes_before") + F.aggregate(F.slice("sizes", F.lit(1), F.col("i")), F.lit(0).cast("bigint"), lambda x, y: x + y)).alias("bytes_before"),
        "alone",
        *values,
    )
    names = ["id", "parent_id", "depth", "bytes", "bytes_before", *values]
    refined = opened.where(~F.col("alone")).groupBy("id").agg(
        *[F.first(c).alias(c) for c in names[1:5]], *[column.alias(name) for name, column in sums.items()]
    )
    return opened.where("alone").select(*names).unionByName(refined.select(*names))


# ---------------------------------------------------------------- ends


def digest_of_ids(ends: DataFrame) -> DataFrame:
    """``id, ends_sha256``: SHA-256 of the comma-joined ``conv_id`` of each ``id``, in ascending order.

    Ids are joined into texts of ``JOINED`` first, in slices by node and id; the hash takes these texts one after the other.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held = None, None, []
        out: list[tuple] = []
        for batch in batches:
            for key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != node or len(held) == JOINED:
                    if held:
                        out.append((node, first, ",".join(held)))
                    node, first, held = key, conv, []
                held.append(str(conv))
            if len(out) > 1000:
                yield rows(out, ["id", "first", "ids"])
                out = []
        if held:
            out.append((node, first, ",".join(held)))
        if out:
            yield rows(out, ["id", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != node:
                    if running:
                        out.append((node, running.hexdigest()))
                    node, running = key, hashlib.sha256(text.encode())
                else:
                    running.update(b"," + text.encode())
            if out:
                yield rows(out, ["id", "ends_sha256"])
        if running:
            yield rows([(node, running.hexdigest())], ["id", "ends_sha256"])

    def rows(values: list[tuple], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*values, strict=True)], names)

    kind = ends.schema["conv_id"].dataType.simpleString()
    pieces = ends.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    pieces = staged(pieces.mapInArrow(joined, f"id string, first {kind}, ids string"), "joined-ids")
    sorted_pieces = pieces.repartition("id").sortWithinPartitions("id", "first")
    return sorted_pieces.select("id", "ids").mapInArrow(hashed, "id string, ends_sha256 string")


# ---------------------------------------------------------------- the trie


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row per node of the prefixes of ``turns`` (``conv_id, pos, digest, bytes``).

    ``members`` has the ``conv_id`` of every conversation, those without turns as well. Columns: ``conv_id`` (smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes, ends_sha256``.
    """
    return finished(turns.sparkSession, "prefix-trie", lambda: _trie(turns, members))


def _trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    members = staged(members.select("conv_id"), "members")
    blocks = blocks_of(turns)
    groups = grouped(blocks)
    nodes = staged(nodes_of(groups, {"n_convs": F.sum("n_convs"), "owner": F.min("owner")}), "nodes")
    children = staged(nodes.groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("n_children")), "children")

    # What each conversation owns, and whether it owns a leaf.
    owned = (
        nodes.join(children, "id", "left")
        .groupBy(F.col("owner").alias("conv_id"))
        .agg(F.sum("bytes").alias("own_bytes"), (F.max_by(F.coalesce("n_children", F.lit(0)), "depth") == 0).cast("bigint").alias("own_leaf"))
    )
    totals = blocks.groupBy("conv_id").agg(F.sum("bytes").alias("total_bytes"), F.max_by("end", "block").alias("end"))
    of_conv = staged(
        members.join(totals, "conv_id", "left")
        .join(owned, "conv_id", "left")
        .select("conv_id", F.coalesce("end", F.lit(ROOT)).alias("end"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total_bytes", "own_bytes", "own_leaf")]),
        "conversations",
    )

    first = F.min(F.struct("conv_id", "total_bytes", "own_bytes")).alias("first")
    added = [F.sum(c).alias(c) for c in ("total_bytes", "own_bytes", "own_leaf")]
    sums = blocks.select("conv_id", "end").join(of_conv.drop("end"), "conv_id").groupBy("end").agg(first, *added)
    per_group = groups.join(staged(sums, "sums"), "end")
    again = {"n_convs": F.sum("n_convs"), "first": F.min("first")}
    again |= {c: F.sum(c) for c in ("total_bytes", "own_bytes", "own_leaf")}
    inner = staged(nodes_of(per_group, again), "summed-nodes")

    top_children = children.where(F.col("id") == ROOT).select("n_children").scalar()
    top = of_conv.agg(F.count(F.lit(1)).alias("n_convs"), first, *added).where("n_convs > 0")
    top = top.select(
        F.lit(ROOT).alias("id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("bytes_before"),
        "n_convs",
        "first",
        "total_bytes",
        "own_bytes",
        F.when(top_children.isNull(), 1).otherwise(F.col("own_leaf")).alias("own_leaf"),
    )
    every = staged(top.unionByName(inner.select(*top.columns)), "all-nodes")
    # Bytes of all paths below a node less those of its different nodes.
    below = F.col("total_bytes") - F.col("n_convs") * F.col("bytes_before")
    different = F.col("own_bytes") - F.col("first.own_bytes") + F.col("first.total_bytes") - F.col("bytes_before")
    parents = every.select(F.col("id").alias("parent_id"), F.col("first.conv_id").alias("parent_conv_id"))
    ends = staged(digest_of_ids(of_conv.select(F.col("end").alias("id"), "conv_id")), "ends")
    return (
        every.join(children, "id", "left")
        .join(ends, "id", "left")
        .join(parents, "parent_id", "left")
        .select(
            F.col("first.conv_id").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            F.col("own_leaf").alias("n_leaves"),
            (below - different).alias("saved_bytes"),
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations rebuilt with turns of their families."""

    def make() -> DataFrame:
        turns, sizes = numbered(conversations)
        return _trie(rebuilt(turns, sizes), sizes)

    return finished(conversations.sparkSession, "prefix-trie", make)
