"""Repeated passages, found with compressed full-text indexes.

A window of ``length`` words is repeated if its words also start anywhere else, in the same document or another. Words
covered by a repeated window are removed.

Sharding: of a window's 8-word parts the one with the lowest hash is its anchor; equal windows have equal anchors.
Consecutive windows with one anchor form a segment. Anchors are counted over all documents, and only segments whose
anchor occurs more than once are sent on, by their anchor, so that equal windows meet in one shard. Anchors above a
share of all segments are sent window by window, told apart by the window's first and last words as well; equal
segments of a batch of documents are sent once with their number. The filter that says which anchors are repeated is a
bit table of bounded size: where it is too small it lets more segments through, and never one too few.

Per shard an FM-index is built over the segments' words: the Burrows-Wheeler transform in a wavelet matrix, and the
borders between suffixes that differ in their first ``length`` words. Every segment is streamed against it backwards:
each word narrows the interval of matching suffixes, and beyond ``length`` words the interval widens again to that
of the first ``length``. What is left are the matching statistics cut off at ``length``; the intervals of windows that
occur at least twice are reported.

Defined results: null and empty texts have no words; texts of fewer than ``length`` words lose nothing. Rows equal in id
and text count as two documents. Null ids are kept as they are. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import text_of
from storelens.session import staged

LENGTH = 35
ANCHOR = 8
BLOCK_WORDS = 1 << 20
SHARD_WORDS = 1_000_000
MOST_FILTER_BITS = 1 << 28
# An anchor with more than this share of all segments, and more than so many, is sent window by window.
HOT_SHARE = 1e-6
HOT_LEAST = 1000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 24) - 1)


# ---------------------------------------------------------------- anchors and segments


def part_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        total = total * _STEP + hashes[i : i + len(total)]
    total ^= total >> np.uint64(32)
    total *= _MIX
    return total ^ (total >> np.uint64(29))


def runs(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each segment of a document, from its word hashes."""
    anchors, firsts, counts = [], [], []
    windows = len(hashes) - length + 1
    size = min(ANCHOR, length)
    for at in range(0, windows, BLOCK_WORDS):
        many = min(BLOCK_WORDS, windows - at)
        parts = part_hashes(hashes[at : at + many + length - 1], size)
        marked = (parts & ~_PLACE) | np.arange(len(parts), dtype=np.uint64)
        width, least = 1, marked
        span = length - size + 1
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


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def anchor_counts(texts: DataFrame, length: int) -> DataFrame:
    """``anchor, n`` over all documents, for anchors that occur more than once; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for value in batch.column(0):
                words = (value.as_py() or "").encode().split()
                if len(words) >= length:
                    held.append(runs(word_hashes(words), length)[0])
                    size += len(held[-1])
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64))], ["anchor"])
                    held, size = [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64))], ["anchor"])

    found = texts.select("text").mapInArrow(run, "anchor long")
    return staged(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "anchors")


def filter_bits(counts: DataFrame) -> np.ndarray:
    """A bit table with the place of every repeated anchor set, eight bits per anchor or more up to its bound."""
    many = counts.count()
    bits = 1 << 12
    while bits < 8 * many and bits < MOST_FILTER_BITS:
        bits *= 2
    place = F.col("anchor").bitwiseAND(F.lit(bits - 1))
    one = F.expr(f"shiftleft(1L, cast((anchor & {bits - 1}L) & 63 AS int))")
    cells = counts.groupBy(F.shiftright(place, 6).alias("cell")).agg(F.bit_or(one).alias("bits")).toArrow()
    found = np.zeros(bits // 64, np.int64)
    found[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return found.view(np.uint64)


def in_filter(table: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    place = anchors & np.uint64(len(table) * 64 - 1)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def segments(texts: DataFrame, counts: DataFrame, length: int) -> DataFrame:
    """Written once: a row per place of a segment, and per batch a row per different segment with its text and number."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > max(HOT_LEAST, int(HOT_SHARE * total))).select("anchor").toArrow()
    shared = texts.sparkSession.sparkContext.broadcast((filter_bits(counts), np.sort(hot.column("anchor").to_numpy().view(np.uint64))))
    fields = [texts.schema["doc_id"], T.StructField("text_hash", T.LongType())]
    fields += [T.StructField(n, T.LongType()) for n in ("first", "key", "seg_a", "seg_b", "copies")] + [T.StructField("words", T.BinaryType())]
    names = [f.name for f in fields]

    def cuts(words: list[bytes], table: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard keys, first windows and numbers of windows."""
        hashes = word_hashes(words)
        anchors, firsts, many = runs(hashes, length)
        keep = in_filter(table, anchors)
        anchors, firsts, many = anchors[keep], firsts[keep], many[keep]
        at = np.searchsorted(hot, anchors)
        is_hot = hot[np.minimum(at, len(hot) - 1)] == anchors if len(hot) else np.zeros(len(anchors), bool)
        if is_hot.any():
            size = min(ANCHOR, length)
            parts = part_hashes(hashes, size)
            every = np.concatenate([np.arange(a, a + n) for a, n in zip(firsts[is_hot], many[is_hot], strict=True)])
            own = (np.repeat(anchors[is_hot], many[is_hot]) * _STEP + parts[every]) * _STEP + parts[every + length - size]
            anchors, firsts = np.append(anchors[~is_hot], own), np.append(firsts[~is_hot], every)
            many = np.append(many[~is_hot], np.ones_like(every))
        return anchors.view(np.int64), firsts, many

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hot = shared.value
        for batch in batches:
            which, rows, seen, size = [], [], {}, 0
            for row, value in enumerate(batch.column(2)):
                words = (value.as_py() or "").encode().split()
                if len(words) < length:
                    continue
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                starts = np.append(0, ends[:-1] + 1)
                keys, firsts, many = cuts(words, table, hot)
                edges = zip(starts[firsts].tolist(), ends[firsts + many + length - 2].tolist(), strict=True)
                for key, first, (low, high) in zip(keys.tolist(), firsts.tolist(), edges, strict=True):
                    text = joined[low:high]
                    a, b = struct.unpack("<qq", hashlib.md5(text, usedforsecurity=False).digest())
                    which.append(row)
                    rows.append((first, key, a, b))
                    entry = seen.get((key, a, b))
                    if entry is None:
                        seen[key, a, b] = [text, 1]
                        size += len(text)
                    else:
                        entry[1] += 1
                if size > 1 << 24 or len(rows) > 200_000:
                    yield made(batch, which, rows, seen)
                    which, rows, seen, size = [], [], {}, 0
            if rows:
                yield made(batch, which, rows, seen)

    def made(batch: pa.RecordBatch, which: list[int], rows: list[tuple], seen: dict) -> pa.RecordBatch:
        texts, copies = zip(*seen.values(), strict=True)
        places = pa.array(which + [None] * len(seen), pa.int64())
        numbers = [*zip(*rows, strict=True)]
        keys = [*zip(*seen, strict=True)]
        columns = [pa.array(list(numbers[0]) + [None] * len(seen), pa.int64())]
        columns += [pa.array([*numbers[i + 1], *keys[i]], pa.int64()) for i in range(3)]
        columns += [pa.array([None] * len(rows) + list(copies), pa.int64()), pa.array([None] * len(rows) + list(texts), pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column(0).take(places), batch.column(1).take(places), *columns], names)

    return staged(texts.mapInArrow(run, T.StructType(fields)), "segments")


# ---------------------------------------------------------------- the index


class WaveletMatrix:
    """Counts of a symbol before a place, with one bit vector per bit of the symbols; 1.5 bits are kept per bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.zeros, self.words, self.before = [], [], []
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            filled = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            filled[: len(bit)] = bit
            words = np.packbits(filled, bitorder="little").view("<u8")
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(1 << bits, dtype=np.int64)
        self.starts = self.moved(every, np.zeros_like(every))

    def ones(self, level: int, place: np.ndarray) -> np.ndarray:
        cell = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][cell] + np.bitwise_count(self.words[level][cell] & below)

    def moved(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where ``place`` comes to lie on the last level, on the way of ``symbol``."""
        for level in range(self.bits):
            bit = (symbol >> (self.bits - 1 - level)) & 1 == 1
            ones = self.ones(level, place)
            place = np.where(bit, self.zeros[level] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``."""
        return self.moved(symbol, place) - self.starts[symbol]


class Index:
    """FM-index of texts over small integers from 1, each with a weight, for patterns of up to ``length`` + 1 symbols."""

    def __init__(self, symbols: np.ndarray, weights: np.ndarray, length: int):
        size = len(symbols)
        top = int(symbols.max(initial=0)) + 1
        # As many symbols as one number holds are compared at first, then twice as many each time.
        width = max(1, int(top).bit_length())
        depth, at_length = max(1, min(62 // width, length)), None
        keys = np.zeros(size, np.int64)
        for i in range(depth):
            keys <<= width
            keys[: max(size - i, 0)] |= symbols[i:]
        rank, order = self.ranked(keys)
        while True:
            if 2 * depth > length and at_length is None:
                at_length = self.joint(rank, length - depth)[0]
            if depth > length:
                break
            rank, order = self.joint(rank, depth)
            depth *= 2
        self.length = length
        self.cumulated = np.concatenate([[0], np.cumsum(weights[order])])
        group = at_length[order]
        new = np.flatnonzero(np.diff(group, prepend=-1))
        self.group = np.zeros(size + 1, np.int64)
        self.group[:size] = np.cumsum(np.diff(group, prepend=group[:1] - 1) != 0) - 1
        self.borders = np.append(new, size)
        last = symbols[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top))])
        self.matrix = WaveletMatrix(last, width)

    @staticmethod
    def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Dense ranks of keys, and the places in their order."""
        order = np.argsort(keys)
        ordered = keys[order]
        rank = np.empty_like(keys)
        rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0)
        return rank, order

    @classmethod
    def joint(cls, rank: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks by the first symbols and those ``depth`` further on, and the places in their order."""
        if not depth:
            return rank, np.argsort(rank)
        after = np.zeros_like(rank)
        after[:-depth] = rank[depth:] + 1
        return cls.ranked(rank * (len(rank) + 2) + after)

    def extended(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one more symbol in front."""
        both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + both[: len(low)], self.first[symbol] + both[len(low) :]

    def widened(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns' first ``length`` symbols; empty ones stay empty."""
        group = self.group[np.minimum(low, len(self.group) - 2)]
        some = high > low
        return np.where(some, self.borders[group], low), np.where(some, self.borders[group + 1], high)

    def repeated(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each place in ``symbols``: do its ``length`` symbols occur with a weight of two or more?

        The texts at ``starts`` are streamed backwards side by side; symbols of 0 are unknown to the index.
        """
        found = np.zeros(len(symbols), bool)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.first[-1], np.int64)
        matched = np.zeros(len(starts), np.int64)
        for step in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(-sizes, -step, "left"))
            place = starts[:active] + sizes[:active] - 1 - step
            symbol = symbols[place]
            l, h = self.extended(low[:active], high[:active], symbol)
            m = matched[:active] + 1
            over = m > self.length
            wl, wh = self.widened(l, h)
            l, h, m = np.where(over, wl, l), np.where(over, wh, h), np.minimum(m, self.length)
            lost = np.flatnonzero((h <= l) | (symbol == 0))
            for i in lost.tolist():  # only texts that are not in the index themselves
                l[i], h[i], m[i] = self.longest(symbols[place[i] : place[i] + self.length])
            low[:active], high[:active], matched[:active] = l, h, m
            whole = m == self.length
            found[place[whole]] = self.cumulated[h[whole]] - self.cumulated[l[whole]] >= 2
        return found

    def longest(self, pattern: np.ndarray) -> tuple[int, int, int]:
        """Interval and length of the longest beginning of ``pattern`` that occurs."""
        for size in range(len(pattern), 0, -1):
            l, h = np.zeros(1, np.int64), np.full(1, self.first[-1], np.int64)
            for symbol in pattern[:size][::-1]:
                if symbol == 0 or h[0] <= l[0]:
                    l, h = np.zeros(1, np.int64), np.zeros(1, np.int64)
                    break
                l, h = self.extended(l, h, np.array([symbol]))
            if h[0] > l[0]:
                return int(l[0]), int(h[0]), size
        return 0, int(self.first[-1]), 0


def indexed(texts: list[list[bytes]], weights: list[int], length: int) -> tuple[Index, np.ndarray, np.ndarray, np.ndarray]:
    """The index of some word lists, and their symbols, starts and sizes."""
    numbers: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int64)
    each = np.zeros(len(symbols), np.int64)
    for text, start, weight in zip(texts, starts.tolist(), weights, strict=True):
        symbols[start : start + len(text)] = [numbers.setdefault(word, len(numbers) + 1) for word in text]
        each[start : start + len(text)] = weight
    return Index(symbols, each, length), symbols, starts, sizes


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """``seg_a, seg_b, spans``: the runs of repeated windows in each different segment, as offset and number."""
    schema = "seg_a long, seg_b long, spans array<struct<offset:long,n:long>>"

    def shard(held: dict) -> Iterator[pa.RecordBatch]:
        texts = [entry[0].split(b" ") for entry in held.values()]
        index, symbols, starts, sizes = indexed(texts, [entry[1] for entry in held.values()], length)
        found = index.repeated(symbols, starts, sizes)
        out = []
        for (_, a, b), start, size in zip(held, starts.tolist(), sizes.tolist(), strict=True):
            own = found[start : start + size - length + 1]
            if own.any():
                edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)).tolist()
                out.append((a, b, [{"offset": x, "n": y - x} for x, y in zip(edges[::2], edges[1::2], strict=True)]))
        if out:
            a, b, spans = zip(*out, strict=True)
            kind = pa.list_(pa.struct([("offset", pa.int64()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(spans, kind)], ["seg_a", "seg_b", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = {}, 0, None
        for batch in batches:
            for key, a, b, copies, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > 6 * SHARD_WORDS and key != last:  # bytes; the segments of an anchor stay together
                    yield from shard(held)
                    held, size = {}, 0
                last = key
                entry = held.get((key, a, b))
                if entry is None:
                    held[key, a, b] = [text, copies]
                    size += len(text)
                else:
                    entry[1] += copies
        if held:
            yield from shard(held)

    dealt = rows.where("words IS NOT NULL").select("key", "seg_a", "seg_b", "copies", "words")
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


# ---------------------------------------------------------------- operators


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text_hash, spans``: the covered words of each document that has any, as first word and number.

    ``texts`` has ``doc_id, text_hash, text``. Spans may touch or overlap.
    """
    rows = segments(texts, anchor_counts(texts, length), length)
    found = staged(repeated_windows(rows, length), "repeated-windows")
    places = rows.where("words IS NULL").select("doc_id", "text_hash", "first", "seg_a", "seg_b")
    covered = places.join(found, ["seg_a", "seg_b"]).select("doc_id", "text_hash", "first", F.explode("spans").alias("s"))
    span = F.struct((F.col("first") + F.col("s.offset")).alias("start"), (F.col("s.n") + length - 1).alias("n"))
    return staged(covered.groupBy("doc_id", "text_hash").agg(F.collect_set(span).alias("spans")), "covered")


def kept_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept``, the words that stay joined by one space."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    spans = repeated_spans(texts, length).select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "spans")
    joined = texts.join(spans, texts.doc_id.eqNullSafe(spans.own_id) & (texts.text_hash == spans.own_hash), "left")
    schema = T.StructType([texts.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many, removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                stays = np.ones(len(words), bool)
                for span in spans.as_py() or ():
                    stays[span["start"] : span["start"] + span["n"]] = False
                left = words if stays.all() else [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                many.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(many, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)
