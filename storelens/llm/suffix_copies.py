"""Repeated strings of bytes, found with suffix order and longest-previous-factor arrays.

A window is ``length`` consecutive bytes of one document. ``every`` removes each byte under a window that also starts anywhere
else; ``later`` removes only windows with an earlier copy and so keeps the first, in the order of id, digest and place.

Sharding: of a window's ``PART``-byte parts the one with the lowest hash is its anchor; equal windows have equal anchors, and
consecutive windows with one anchor form a segment. Anchors are counted over all documents, and only segments whose
anchor occurs more than once are sent on, by their anchor, so that equal windows meet in one shard. The filter that says
which anchors are repeated is a bit table of bounded size: too small a one lets more segments through, never one too few.
Equal segments of a batch are sent once, with their number and their first place. The segments of an anchor with more
than ``HOT_ROWS`` of them are cut again by the same steps, with the whole window as the part.

Per shard the suffixes at window starts are put in order by prefix doubling over ``length`` bytes. Where neighbours agree in
``length`` bytes, the longest previous factor of a window reaches ``length`` if a smaller position stands before it (previous
smaller) or after it (next smaller) in that stretch of the order; the position found is an earlier copy. A window that has
none is the first; it is repeated if it is another's previous or next smaller position, or stands in several equal segments.

Defined results: null and empty texts have no bytes; texts of fewer than ``length`` bytes lose nothing. Rows equal in id
and text count as two documents, and as copies of each other; ``later`` can't tell them apart and keeps the first copy in both.
A null id comes first in the order. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import batches_of, finished, text_of
from storelens.llm.substrings import filter_bits, in_filter
from storelens.session import staged

LENGTH = 200
PART = 32
BLOCK_BYTES = 1 << 20
# Small shards and batches: sorts stay in the cache and a worker in a few hundred MB.
SHARD_BYTES = 400_000
BATCH_BYTES = 1 << 23
SLICE_BYTES = 1 << 22
# An anchor with more segments than this is cut again, window by window.
HOT_ROWS = 8000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 24) - 1)
NULL_ID = -(1 << 63)


# ---------------------------------------------------------------- anchors and segments


def part_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` bytes, put together from runs of powers of two."""
    many = len(data) - size + 1
    run = (data.astype(np.uint64) + np.uint64(1)) * _STEP
    run ^= run >> np.uint64(31)
    total, at, width = None, 0, 1
    while True:
        if size & width:
            part = run[at : at + many]
            total = part.copy() if total is None else total * _MIX + part
            at += width
        if 2 * width > size:
            break
        run = run[:-width] * _STEP + run[width:]
        run ^= run >> np.uint64(29)
        run *= _MIX
        width *= 2
    total ^= total >> np.uint64(32)
    total *= _STEP
    return total ^ (total >> np.uint64(29))


def cut(data: np.ndarray, length: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each segment."""
    anchors, firsts, counts = [], [], []
    windows = len(data) - length + 1
    for at in range(0, windows, BLOCK_BYTES):
        many = min(BLOCK_BYTES, windows - at)
        parts = part_hashes(data[at : at + many + length - 1], part)
        span = length - part + 1
        if span == 1:
            anchors.append(parts)
            firsts.append(np.arange(at, at + many))
            counts.append(np.ones(many, np.int64))
            continue
        marked = (parts & ~_PLACE) | np.arange(len(parts), dtype=np.uint64)
        width, least = 1, marked
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:many], least[span - width : span - width + many])
        place = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        anchors.append(parts[place[first]])
        firsts.append(first + at)
        counts.append(np.diff(np.append(first, many)))
    if not anchors:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(anchors), np.concatenate(firsts), np.concatenate(counts)


def anchor_counts(pieces: DataFrame, length: int, part: int) -> DataFrame:
    """``anchor, n`` over all pieces, for anchors that occur more than once; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added() -> pa.RecordBatch:
            anchors, which = np.unique(np.concatenate(held), return_inverse=True)
            n = np.bincount(which, weights=np.concatenate(weights)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(n)], ["anchor", "n"])

        held, weights, size = [], [], 0
        for batch in batches:
            for text, weight in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                if len(data) >= length:
                    held.append(cut(data, length, part)[0])
                    weights.append(np.full(len(held[-1]), weight))
                    size += len(held[-1])
                if size > 500_000:
                    yield added()
                    held, weights, size = [], [], 0
        if size:
            yield added()

    found = pieces.select("text", "weight").mapInArrow(run, "anchor long, n long")
    return staged(found.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"), "anchors")


SEGMENT_COLUMNS = ["a", "b", "key", "firsts", "seg_a", "seg_b", "doc", "hash", "at", "weight", "text"]
SEGMENT_SCHEMA = (
    "a long, b long, key long, firsts array<long>, seg_a array<long>, seg_b array<long>, doc long, hash long, at long, weight long, text binary"
)


def segments(pieces: DataFrame, counts: DataFrame, length: int, part: int) -> DataFrame:
    """Written once. Per piece a row with the places and digests of its segments; per batch a row for each different
    segment, with its text, its number and its first place, where ``a`` and ``b`` are its digest.
    """
    shared = pieces.sparkSession.sparkContext.broadcast(filter_bits(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            places, seen, size = [], {}, 0
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for a, b, doc, digest, at, weight, text in zip(*columns, batch.column(6), strict=True):
                buffer = text.as_buffer()
                data = np.frombuffer(buffer, np.uint8)
                if len(data) < length:
                    continue
                anchors, firsts, many = cut(data, length, part)
                keep = in_filter(table, anchors)
                if not keep.any():
                    continue
                view = memoryview(buffer)
                names = []
                firsts = firsts[keep].tolist()
                for key, first, n in zip(anchors[keep].view(np.int64).tolist(), firsts, many[keep].tolist(), strict=True):
                    piece = view[first : first + n + length - 1]
                    name = hashlib.md5(piece).digest()
                    names.append(name)
                    here = (doc, digest, at + first)
                    entry = seen.get((key, name))
                    if entry is None:
                        seen[key, name] = [bytes(piece), weight, here]
                        size += len(piece)
                    else:
                        entry[1] += weight
                        if here < entry[2]:
                            entry[2] = here
                places.append((a, b, firsts, names, (doc, digest, at)))
                if size > BATCH_BYTES:
                    yield made(places, seen)
                    places, seen, size = [], {}, 0
            if places:
                yield made(places, seen)

    def halves(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        both = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def made(places: list[tuple], seen: dict) -> pa.RecordBatch:
        a, b, firsts, names, origin = zip(*places, strict=True)
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in firsts]), np.full(len(seen), sum(map(len, firsts)))]).astype(np.int32)
        lists = [np.concatenate([np.array(f, np.int64) for f in firsts]), *halves([n for own in names for n in own])]
        keys, digests = zip(*seen, strict=True)
        texts, weights, first = zip(*seen.values(), strict=True)
        seg_a, seg_b = halves(list(digests))
        none = [None] * len(places)
        columns = [
            pa.array(np.concatenate([np.array(a, np.int64), seg_a])),
            pa.array(np.concatenate([np.array(b, np.int64), seg_b])),
            pa.array([*none, *keys], pa.int64()),
            *[pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(v))) for v in lists],
            *[pa.array(list(c), pa.int64()) for c in zip(*origin, *first, strict=True)],
            pa.array([*none, *weights], pa.int64()),
            pa.array([*none, *texts], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, SEGMENT_COLUMNS)

    return staged(pieces.select("a", "b", "doc", "hash", "at", "weight", "text").mapInArrow(run, SEGMENT_SCHEMA), "segments")


# ---------------------------------------------------------------- suffix order and previous factors


def suffix_order(text: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places with ``length`` bytes ``left`` or more, in the order of these bytes, and where a new string begins.

    Ranks by the first bytes are doubled: two neighbouring ranks make a key, and the place is packed below it, so that a
    round is one sort of plain integers.
    """
    bits = max(1, int(len(text)).bit_length())
    low = np.uint64((1 << bits) - 1)
    rank = np.zeros(len(text), np.uint64)

    def ranked(keys: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        if width + bits <= 64:
            both = (keys << np.uint64(bits)) | places.astype(np.uint64)
            both.sort()
            order, keys = (both & low).astype(np.int64), both >> np.uint64(bits)
        else:
            by_key = np.argsort(keys, kind="stable")
            order, keys = places[by_key], keys[by_key]
        new = np.empty(len(order), bool)
        new[:1] = True
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        rank[order] = np.cumsum(new).astype(np.uint64) - np.uint64(1)
        return order, new

    depth = min(5, length)
    places = np.flatnonzero(left >= depth)
    keys = np.zeros(len(places), np.uint64)
    for i in range(depth):
        keys = (keys << np.uint64(8)) | text[places + i]
    order, new = ranked(keys, places, 8 * depth)
    while depth < length:
        step = min(depth, length - depth)
        places = np.flatnonzero(left >= depth + step)
        keys = (rank[places] << np.uint64(bits)) | rank[places + step]
        order, new = ranked(keys, places, 2 * bits)
        depth += step
    return order, new


def smaller_before(position: np.ndarray, barrier: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it with a smaller position, -1 if a barrier comes first.

    ``barrier`` marks entries that can't look back. Each entry skips to the candidate of its candidate until it is smaller.
    """
    found = np.arange(len(position)) - 1
    found[barrier] = -1
    # Without a smaller one in its stretch, the search ends at the first entry of the stretch, which looks back no further.
    active = np.flatnonzero(found >= 0)
    while len(active):
        larger = position[found[active]] > position[active]
        active = active[larger]
        found[active] = found[found[active]]
        active = active[found[active] >= 0]
    return found


def previous_factors(order: np.ndarray, new: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous and next smaller positions of each entry of the suffix order, within a stretch of equal strings; -1 for none."""
    own = position[order]
    before = smaller_before(own, new)
    last = np.append(new[1:], True)
    after = smaller_before(own[::-1], last[::-1])[::-1]
    return before, np.where(after < 0, -1, len(own) - 1 - after)


def repeated(text: np.ndarray, left: np.ndarray, position: np.ndarray, weight: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per place: does its window start anywhere else, and does it start earlier elsewhere?"""
    order, new = suffix_order(text, left, length)
    before, after = previous_factors(order, new, position)
    has_earlier = (before >= 0) | (after >= 0)
    is_source = np.zeros(len(order), bool)
    is_source[before[before >= 0]] = True
    is_source[after[after >= 0]] = True
    again, earlier = np.zeros(len(text), bool), np.zeros(len(text), bool)
    again[order] = has_earlier | is_source | (weight[order] > 1)
    earlier[order] = has_earlier
    return again, earlier


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """``seg_a, seg_b, first, spans``: runs of repeated windows in each different segment, as offset, number and whether an
    earlier copy stands elsewhere; ``first`` is the segment's own first place.
    """
    schema = "seg_a long, seg_b long, first struct<doc:long,hash:long,at:long>, spans array<struct<offset:long,n:long,later:boolean>>"
    kind = pa.list_(pa.struct([("offset", pa.int64()), ("n", pa.int64()), ("later", pa.bool_())]))
    place = pa.struct([("doc", pa.int64()), ("hash", pa.int64()), ("at", pa.int64())])

    def shard(held: dict) -> Iterator[pa.RecordBatch]:
        entries = list(held.values())
        sizes = np.array([len(e[0]) for e in entries])
        starts = np.cumsum(sizes) - sizes
        text = np.frombuffer(b"".join(e[0] for e in entries), np.uint8)
        inside = np.arange(len(text)) - np.repeat(starts, sizes)
        # Documents in their order, then the place: one number per byte.
        names = sorted({e[2][:2] for e in entries})
        number = {name: i for i, name in enumerate(names)}
        base = np.array([(number[e[2][:2]] << 40) + e[2][2] for e in entries], np.int64)
        weight = np.repeat(np.array([e[1] for e in entries], np.int64), sizes)
        again, earlier = repeated(text, np.repeat(sizes, sizes) - inside, np.repeat(base, sizes) + inside, weight, length)
        # 0: not repeated, 1: repeated and the first, 2: repeated later.
        state = again.astype(np.int8) + earlier
        edges = np.flatnonzero((np.diff(state, prepend=0) != 0) | (inside == 0))
        runs = np.diff(np.append(edges, len(state)))
        some = state[edges] > 0
        edges, runs = edges[some], runs[some]
        if not len(edges):
            return
        owner = np.searchsorted(starts, edges, "right") - 1
        at = np.flatnonzero(np.diff(owner, prepend=-1))
        spans = pa.StructArray.from_arrays(
            [pa.array(edges - starts[owner]), pa.array(runs), pa.array(state[edges] == 2)], names=["offset", "n", "later"]
        )
        keys = list(held)
        own = owner[at].tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([keys[i][1] for i in own], pa.int64()),
                pa.array([keys[i][2] for i in own], pa.int64()),
                pa.array([dict(zip(("doc", "hash", "at"), entries[i][2], strict=True)) for i in own], place),
                pa.ListArray.from_arrays(pa.array(np.append(at, len(edges)).astype(np.int32)), spans).cast(kind),
            ],
            ["seg_a", "seg_b", "first", "spans"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = {}, 0, None
        for batch in batches:
            for key, a, b, weight, doc, digest, at, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > SHARD_BYTES and key != last:  # the segments of an anchor stay together
                    yield from shard(held)
                    held, size = {}, 0
                last = key
                entry = held.get((key, a, b))
                if entry is None:
                    held[key, a, b] = [text, weight, (doc, digest, at)]
                    size += len(text)
                else:
                    entry[1] += weight
                    entry[2] = min(entry[2], (doc, digest, at))
        if held:
            yield from shard(held)

    dealt = rows.select("key", F.col("a").alias("seg_a"), F.col("b").alias("seg_b"), "weight", "doc", "hash", "at", "text")
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


# ---------------------------------------------------------------- operators


def found_in(pieces: DataFrame, length: int, part: int) -> DataFrame:
    """``a, b, first, spans`` of the pieces that hold repeated windows: runs of them by first window, number and ``later``.

    Pieces of one name have the same runs, once for each of them.

    ``pieces`` has ``a, b`` (its name), ``doc, hash, at`` (its first place), ``weight`` (how often it stands there) and ``text``.
    """
    rows = segments(pieces, anchor_counts(pieces, length, part), length, part)
    texts = rows.where("text IS NOT NULL")
    if part < length:
        # At most one row in HOT_ROWS is the first of a hot key.
        hot = staged(texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select("key"), "hot")
        if hot.isEmpty():
            found = repeated_windows(texts, length)
        else:
            again = found_in(different(texts.join(F.broadcast(hot), "key", "left_semi")), length, length)
            again = again.select(F.col("a").alias("seg_a"), F.col("b").alias("seg_b"), "first", "spans")
            found = repeated_windows(texts.join(F.broadcast(hot), "key", "left_anti"), length).unionByName(again)
    else:
        found = repeated_windows(texts, length)
    found = staged(found, "repeated-windows")
    each = F.explode(F.arrays_zip("firsts", "seg_a", "seg_b")).alias("s")
    places = rows.where("text IS NULL").select("a", "b", F.struct("doc", "hash", "at").alias("first"), each)
    joined = places.select("a", "b", "first", "s.*").join(found.withColumnRenamed("first", "own"), ["seg_a", "seg_b"])
    # A segment's first place is no later copy of itself; its other places are.
    is_first = (F.col("own.doc") == F.col("first.doc")) & (F.col("own.hash") == F.col("first.hash"))
    is_first &= F.col("own.at") == F.col("first.at") + F.col("firsts")
    spans = F.transform(
        "spans",
        lambda s: F.struct((F.col("firsts") + s["offset"]).alias("offset"), s["n"].alias("n"), (s["later"] | ~is_first).alias("later")),
    )
    gathered = joined.select("a", "b", "first", spans.alias("spans")).groupBy("a", "b")
    return gathered.agg(F.min("first").alias("first"), F.flatten(F.collect_list("spans")).alias("spans"))


def different(texts: DataFrame) -> DataFrame:
    """Equal segments of all batches as one, with their number and first place; written once."""
    place = F.min(F.struct("doc", "hash", "at")).alias("place")
    one = texts.groupBy("a", "b").agg(place, F.sum("weight").alias("weight"), F.first("text").alias("text"))
    return staged(one.select("a", "b", "place.*", "weight", "text"), "hot-segments")


def pieces_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    doc, digest = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)), F.xxhash64(text)
    return docs.select(
        doc.alias("a"),
        digest.alias("b"),
        doc.alias("doc"),
        digest.alias("hash"),
        F.lit(0).cast("bigint").alias("at"),
        F.lit(1).cast("bigint").alias("weight"),
        F.encode(text, "UTF-8").alias("text"),
    )


def kept_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, part: int = PART, mode: str = "every"
) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, removed, kept``: the maximal removed runs as start and size, and the bytes left."""
    spark = docs.sparkSession
    found = finished(spark, "repeated-bytes", lambda: found_in(pieces_of(docs, id_col, text_col), length, min(part, length)))
    removed = F.col("spans") if mode == "every" else F.filter("spans", lambda s: s["later"])
    found = found.select("a", "b", removed.alias("spans"))
    id_field = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"]
    text = text_of(text_col)
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("a"),
        F.xxhash64(text).alias("b"),
        F.encode(text, "UTF-8").alias("text"),
    )
    joined = own.join(found, ["a", "b"], "left").select("doc_id", "text", "spans")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("n", T.LongType())]))
    schema = T.StructType(
        [id_field, *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed")], T.StructField("removed", span), T.StructField("kept", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", SLICE_BYTES):
                sizes, gone, removed, kept = [], [], [], []
                for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    runs = merged(spans or [], length)
                    left, at = [], 0
                    for start, end in runs:
                        left.append(text[at:start])
                        at = end
                    left.append(text[at:])
                    sizes.append(len(text))
                    gone.append(sum(end - start for start, end in runs))
                    removed.append([{"start": start, "n": end - start} for start, end in runs])
                    kept.append(b"".join(left))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))
                columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)


def merged(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Bytes under runs of windows, as maximal intervals."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["offset"], s["offset"] + s["n"] + length - 1) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
