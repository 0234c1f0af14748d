"""Log-probabilities of texts under a model learned from the training part of the corpus: logistic context mixing.

A text is its kind, its lower-case words and an end. Its kind is a small number: its most frequent character beyond ASCII,
which tells languages apart, and whether many of its words end in symbols. Every word is coded as a path of binary
decisions: a Huffman code of its class, which is the number of binary digits of its training count, then its number within the
class. A word without a training count is a class of its own; its bytes follow. Each decision is predicted from counts in
contexts: the path so far after the kind of text, after the word before and after the two words before (hashed), and what
the word that came last time after the same word of this text would decide. Predictions are combined in the logistic domain by
weights that a gate selects (how many contexts are known, whether a word is expected, the depth), and the result is refined
by an adaptive map from the first decisions and the mixed prediction. Weights and map learn online: each block of words
is predicted before it is learned. Half of the words seen once are learned as words without a count, as
held-out texts meet such words about as often as training texts meet words seen once (the Good-Turing estimate).

The spelling model is of the same make: a word's bytes and its end are coded bit by bit, each bit predicted from counts in
hashed contexts (the kind of text and the bytes before it in the word, the last 1, 2, 3, 5 or all of these). Its counts
come from all different training words of a kind, each counted once, and are full before weights and map learn, with the word's own share
taken out. A word without a count that its text has spelled already is drawn from an urn of such words. Where a text
ends depends on its length so far.

Words are counted in one shuffle by hash bucket: a chunk of documents sends a row per bucket with its different words, and gets
back a row with their counts and numbers. At most ``LEARNERS`` tasks read the training texts, each with tables of its own, which are
added up block by block. Tables of word contexts have at least four slots per training word up to ``WORD_SLOTS`` a context; beyond, contexts share slots.

Defined results: null and empty texts are the end alone. The id's text decides what is held out; a null id counts as the
empty string and so belongs to training. Repeated rows are counted and scored each. Without training rows spelling
knows nothing and gives each bit one half. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.session import staged

FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 1 << 25
ORDERS = (1, 2, 3, 5, 0)  # bytes of context; 0 stands for the kind of text and all bytes of the word so far
KINDS = 32
URN = 30.0
WORD_BUCKETS = 512
CLASSES = 64
CONTEXTS = 4  # of a word's decisions: kind of text, the word before, the two words before, the word expected
WORD_SLOTS = 1 << 20
WORD_GATES = 16 * 8
LEARNERS = 12
GROUP_WORDS = 1 << 18
_SYMBOLS = np.isin(np.arange(256), list(b"!#$%&*+/<=>?@\\^_`|~"))
_BLANKS = b" \t\n\x0b\x0c\r"
_IS_BLANK = bytes(b in _BLANKS for b in range(256))
_LOWER = bytes(range(256)).lower()
SLOTS = 1 << 21
SLOT_BLOCK = 1 << 14
GATES = (len(ORDERS) + 1) * 8
BUCKETS = 33
BLOCK_WORDS = 4000
LEARN_WORDS = 1000
PATH_WORDS = 2048
SCORE_WORDS = 2048
RATE = 0.1
SOFT = 0.4
_WORD_END = 0x20
_MULT = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % FOLDS == HELD_OUT


def text_kind(text: str, marked: int, total: int) -> int:
    """Which of ``KINDS`` kinds a text belongs to, of whose words so many end in symbols."""
    script = 0
    if not text.isascii():
        points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        points = np.sort(points[points > 127])
        if len(points):
            cuts = np.concatenate([[0], np.flatnonzero(points[1:] != points[:-1]) + 1, [len(points)]])
            script = 1 + int(points[cuts[(cuts[1:] - cuts[:-1]).argmax()]]) % (KINDS // 2 - 1)
    return 2 * script + (4 * marked > total)


# ---------------------------------------------------------------- chunks of documents


class Numbers(dict):
    """Numbers for words, in the order of their first use, and whether they end in symbols."""

    def __init__(self):
        super().__init__()
        self.marked = np.empty(0, np.bool_)

    def of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The numbers of every text's lower-case words; a word is looked up once for all these texts."""
        data = b" ".join([b"", *texts, b""])
        blank = np.frombuffer(data.translate(_IS_BLANK), np.bool_)
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        stops, letters = np.cumsum(edges[1::2] - edges[::2]), data.translate(_LOWER, _BLANKS)
        offsets = np.concatenate([[0], stops])
        words = pa.Array.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        before, which, different = len(self), words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.array([self.setdefault(word, len(self)) for word in different], np.uint32)
        ends = np.frombuffer(bytes(word[-1] for word in different), np.uint8)
        self.marked = np.concatenate([self.marked, _SYMBOLS[ends[numbers >= before]]])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return np.split(numbers[which], np.searchsorted(edges[::2], np.cumsum(sizes[:-1])))


def grown(values: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)]) if size > len(values) else values


def packed(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, the lowest of all first: a third to a half of their size."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True) if raw else b""


def unpacked(part: bytes, dtype: type) -> np.ndarray:
    if not part:
        return np.empty(0, dtype)
    raw = pa.decompress(part[8:], int.from_bytes(part[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def packed_words(words: list[bytes]) -> bytes:
    return packed(np.frombuffer(b" ".join(words), np.uint8))


def unpacked_words(part: bytes) -> list[bytes]:
    return unpacked(part, np.uint8).tobytes().split(b" ")


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written once: per document its words, as numbers within its chunk; and per chunk and bucket of words a row with the
    words, their numbers, their counts in training texts and the kinds of these (a bit each)."""
    fields = [("chunk", T.LongType()), ("doc_id", docs.schema[id_col].dataType), ("held_out", T.BooleanType()), ("n_words", T.LongType()), ("n_bytes", T.LongType())]
    fields += [("kind", T.IntegerType()), ("ids", T.BinaryType()), ("bucket", T.IntegerType())]
    fields += [(n, T.BinaryType()) for n in ("numbers", "words", "train", "kinds")]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, numbers, size = TaskContext.get().partitionId() << 32, Numbers(), 0
        train, kinds, ids_type = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.uint32), None
        for batch in batches:
            ids_type, at = batch.column(0).type, 0
            while at < batch.num_rows:
                first, texts = at, []
                while at < batch.num_rows and size < CHUNK_BYTES:
                    plain = batch.column(2)[at].as_py() or ""
                    texts.append((plain, plain.encode()))
                    size += len(texts[-1][1])
                    at += 1
                ids = numbers.of([text for _, text in texts])
                rows, learned = [], {}
                train, kinds = grown(train, len(numbers)), grown(kinds, len(numbers))
                out = batch.column(1).slice(first, at - first)
                for (plain, text), own, held in zip(texts, ids, out.to_pylist(), strict=True):
                    kind = text_kind(plain, int(numbers.marked[own].sum()), len(own))
                    if not held:
                        learned.setdefault(kind, []).append(own)
                    rows.append((chunk, len(own), len(text), kind, packed(own)))
                for kind, some in learned.items():
                    many = np.bincount(np.concatenate(some), minlength=len(numbers))
                    train[: len(numbers)] += many
                    kinds[: len(numbers)] |= (many > 0).astype(np.uint32) << np.uint32(kind)
                own, words, n_bytes, kind, parts = zip(*rows, strict=True)
                columns = [pa.array(own, pa.int64()), batch.column(0).slice(first, at - first), out, pa.array(words, pa.int64()), pa.array(n_bytes, pa.int64())]
                columns += [pa.array(kind, pa.int32()), pa.array(parts, pa.binary()), pa.nulls(len(rows), pa.int32()), *(pa.nulls(len(rows), pa.binary()) for _ in range(4))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                if size >= CHUNK_BYTES:
                    yield vocabulary(ids_type, chunk, numbers, train, kinds)
                    chunk, numbers, size = chunk + 1, Numbers(), 0
                    train[:], kinds[:] = 0, 0
        if numbers:
            yield vocabulary(ids_type, chunk, numbers, train, kinds)

    def vocabulary(ids_type: pa.DataType, chunk: int, numbers: Numbers, train: np.ndarray, kinds: np.ndarray) -> pa.RecordBatch:
        words = list(numbers)
        buckets = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % WORD_BUCKETS
        order = np.argsort(buckets, kind="stable")
        cuts = np.flatnonzero(np.diff(buckets[order], prepend=WORD_BUCKETS))
        rows = [(int(buckets[part[0]]), packed(part.astype(np.uint32)), packed_words([words[i] for i in part]), packed(train[part].astype(np.uint32)), packed(kinds[part])) for part in np.split(order, cuts[1:])]
        none = len(rows)
        columns = [pa.array(np.full(none, chunk)), pa.nulls(none, ids_type), pa.nulls(none, pa.bool_()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64())]
        columns += [pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary()), pa.array([row[0] for row in rows], pa.int32())]
        columns += [pa.array([row[i] for row in rows], pa.binary()) for i in range(1, 5)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    narrow = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return staged(narrow.mapInArrow(run, schema), "word-chunks")


COUNTED = "bucket int, chunk long, numbers binary, c binary, place binary, unseen binary, types binary, tally binary"


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their buckets. Per chunk a row with its words' counts and their places in bucket and class, and the
    words without a count; per kind of text a row with its different training words; and per bucket how many words and
    occurrences are in each class."""
    names = [field.split()[0] for field in COUNTED.split(", ")]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 6]

    def made(bucket: int, rows: list[dict]) -> pa.RecordBatch:
        parts = [unpacked_words(row["words"]) for row in rows]
        words = pa.array([word for part in parts for word in part], pa.binary()).dictionary_encode()
        which, different = words.indices.to_numpy(), words.dictionary.to_pylist()
        total = np.zeros(len(different), np.int64)
        np.add.at(total, which, np.concatenate([unpacked(row["train"], np.uint32) for row in rows]).astype(np.int64))
        kinds = np.zeros(len(different), np.uint32)
        np.bitwise_or.at(kinds, which, np.concatenate([unpacked(row["kinds"], np.uint32) for row in rows]))
        classes = word_class(total)
        many = np.bincount(classes, minlength=CLASSES)
        order, place = np.argsort(classes, kind="stable"), np.empty(len(different), np.uint32)
        place[order] = np.arange(len(different)) - (np.cumsum(many) - many)[classes[order]]
        out, at = [], 0
        for row, part in zip(rows, parts, strict=True):
            own = which[at : at + len(part)]
            at += len(part)
            c = total[own]
            unseen = packed_words([part[i] for i in np.flatnonzero(c == 0)])
            out.append((bucket, row["chunk"], row["numbers"], packed(c), packed(place[own]), unseen, None, None))
        for kind in range(KINDS):
            some = np.flatnonzero(kinds >> np.uint32(kind) & np.uint32(1))
            if len(some):
                out.append((bucket, None, None, None, None, None, packed_words([bytes((kind,)) + different[i] for i in some]), None))
        held = np.bincount(classes, total, minlength=CLASSES).astype(np.int64)
        out.append((bucket, None, None, None, None, None, None, np.stack([many, held]).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    last, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["bucket"] != last:
                yield made(last, held)
                held = []
            last = row["bucket"]
            held.append(row)
    if held:
        yield made(last, held)


# ---------------------------------------------------------------- the spelling model


def bit_events(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all bits of some words, the first bits of all bytes before the second ones: cells (per context; slots of what is a one come
    after those of zeros), the bit, the byte before, the place in the byte; and each word's first byte.

    The first byte of a word is the kind of text: a context, and not itself coded.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)  # the blank ends each word
    starts = np.cumsum(sizes) - sizes
    within = np.arange(len(data)) - np.repeat(starts, sizes)
    contexts = np.empty((len(ORDERS), len(data)), np.uint64)
    hashed, shown = np.zeros(len(data), np.uint64), data + np.uint64(1)
    for back in range(1, max(ORDERS) + 1):
        hashed[back:] += shown[:-back] * (within[back:] >= back)
        hashed *= _MULT
        hashed ^= hashed >> np.uint64(29)
        if back in ORDERS:
            contexts[ORDERS.index(back)] = (hashed + np.uint64(back)) * _MULT
    # a sum over places, so that a prefix's hash is a difference of running sums
    placed = shown * _MULT ^ (within.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    placed = (placed ^ (placed >> np.uint64(31))) * _MULT
    running = np.concatenate([[np.uint64(0)], np.cumsum(placed)[:-1]])
    contexts[ORDERS.index(0)] = (running - np.repeat(running[starts], sizes) ^ np.uint64(77)) * _MULT
    coded = within > 0
    before = np.concatenate([[0], data[:-1]]).astype(np.int64)[coded]
    contexts, data = contexts[:, coded], data[coded]
    starts -= np.arange(len(words))
    bits = data >> np.arange(7, -1, -1, dtype=np.uint64)[:, None] & np.uint64(1)
    # the 15 nodes of half a byte lie side by side
    halves = np.stack([data >> np.uint64(4), data & np.uint64(15)])
    nodes = np.stack([np.ones_like(data), halves[0] | np.uint64(16)]) * np.uint64(0xC2B2AE3D27D4EB4F)
    inside = (halves[:, None] | np.uint64(16)) >> np.arange(4, 0, -1, dtype=np.uint64)[:, None]
    inside |= (bits * np.uint64(SLOTS)).reshape(inside.shape)
    cells = np.empty((len(ORDERS), 2, 4, len(data)), np.uint64)
    for k in range(len(ORDERS)):
        lines = (contexts[k] ^ nodes) * _MULT >> np.uint64(69 - SLOTS.bit_length()) << np.uint64(4)
        np.bitwise_or(lines[:, None], inside, out=cells[k])
    return cells.view(np.int64).reshape(len(ORDERS), -1), bits.view(np.int64).ravel(), np.tile(before, 8), np.repeat(np.arange(8), len(data)), starts


@dataclass
class Spelling:
    """Counts of zeros and ones per slot, weights per gate, and the adaptive map's counts."""

    counts: np.ndarray = field(default_factory=lambda: np.zeros((2, SLOTS), np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, len(ORDERS)), 1.0 / len(ORDERS)))
    refined: np.ndarray = field(default_factory=lambda: np.zeros((256, BUCKETS, 2)))
    kept: dict[int, np.ndarray] = field(default_factory=dict)

    def stretched(self, own: int) -> np.ndarray:
        """Per bit and slot, the prediction in the logistic domain before that bit; ``own``: the word's share. 0 if the slot is not known."""
        if own in self.kept:
            return self.kept[own]
        out = np.zeros((2, SLOTS), np.float32)
        for bit in (0, 1):
            zeros, ones = np.maximum(self.counts[0] - own * (1 - bit), 0), np.maximum(self.counts[1] - own * bit, 0)
            known = zeros + ones > 0
            out[bit] = np.log((ones + np.float32(SOFT)) / (zeros + np.float32(SOFT)))
            out[bit][known & (out[bit] == 0)] = 1e-6
        self.kept[own] = out.ravel()
        return self.kept[own]

    def inputs(self, cells: np.ndarray, stretched: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predictions in the logistic domain, per context, and how many contexts are known."""
        out = stretched.take(cells, mode="clip")
        return out, (out != 0).view(np.int8).sum(axis=0, dtype=np.int8).astype(np.int64)

    def mixed(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total, weights = np.zeros(len(gate), np.float32), self.weights.T.astype(np.float32)
        for k in range(len(ORDERS)):
            total += weights[k].take(gate, mode="clip") * inputs[k]
        return np.clip(total, -14, 14)

    def table(self) -> np.ndarray:
        centre = 1 / (1 + np.exp(-(np.arange(BUCKETS) / (BUCKETS - 1) * 28 - 14)))
        # every bucket starts as if it had seen a few bits that agree with the mixer
        return ((self.refined[:, :, 1] + 4 * centre) / (self.refined.sum(axis=2) + 4)).ravel()

    def refine(self, table: np.ndarray, before: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """The chance of a one: the mean of what was mixed and what the map says, between its two nearest buckets."""
        place = (mixed + 14) / 28 * (BUCKETS - 1)
        low = np.minimum(place.astype(np.int64), BUCKETS - 2)
        share = place - low
        low += before * BUCKETS
        mapped = table.take(low, mode="clip") * (1 - share) + table[1:].take(low, mode="clip") * share
        plain = 1 / (1 + np.exp(-mixed))
        return np.clip(0.5 * plain + 0.5 * mapped, 1e-7, 1 - 1e-7)

    def log10(self, words: list[bytes]) -> np.ndarray:
        """The log-probability of each word's spelling."""
        out, stretched, table = [np.empty(0)], self.stretched(0), self.table()
        for at in range(0, len(words), LEARN_WORDS):
            cells, bits, before, place, first = bit_events(words[at : at + LEARN_WORDS])
            inputs, known = self.inputs(cells, stretched)
            chance = self.refine(table, before, self.mixed(inputs, known * 8 + place))
            logs = np.log10(np.where(bits == 1, chance, 1 - chance))
            out.append(np.add.reduceat(logs.reshape(8, -1).sum(axis=0), first))
        return np.concatenate(out)

    def count(self, words: list[bytes]) -> None:
        self.kept.clear()
        for at in range(0, len(words), LEARN_WORDS):
            cells, *_ = bit_events(words[at : at + LEARN_WORDS])
            np.add.at(self.counts.reshape(-1), cells.ravel(), np.float32(1))

    def learn(self, words: list[bytes]) -> int:
        """Weights and map, online: each block is predicted, then learned. Gives the number of bits."""
        total, stretched, seen_as = 0, self.stretched(1), np.zeros(self.refined.size, np.int64)
        for at in range(0, len(words), LEARN_WORDS):
            cells, bits, before, place, _ = bit_events(words[at : at + LEARN_WORDS])
            inputs, known = self.inputs(cells, stretched)
            gate = known * 8 + place
            mixed = self.mixed(inputs, gate)
            wrong = bits.astype(np.float32) - 1 / (1 + np.exp(-mixed))
            seen = np.maximum(np.bincount(gate, minlength=GATES), 1)
            for k in range(len(ORDERS)):
                self.weights[:, k] += RATE * np.bincount(gate, wrong * inputs[k], minlength=GATES) / seen
            bucket = np.rint((mixed + 14) / 28 * (BUCKETS - 1)).astype(np.int64)
            seen_as += np.bincount((before * BUCKETS + bucket) * 2 + bits, minlength=len(seen_as))
            total += len(bits)
        self.refined += seen_as.reshape(self.refined.shape)
        return total


def different_words(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Words after a byte for their kind, some thousands at a time."""
    words = []
    for batch in batches:
        for part in batch.column(0):
            words += unpacked_words(part.as_py())
            if len(words) >= BLOCK_WORDS:
                yield words
                words = []
    if words:
        yield words


def binary_rows(values: np.ndarray, block: int) -> pa.RecordBatch:
    flat = values.reshape(-1, block)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array([row.tobytes() for row in flat], pa.binary())], ["block", "part"])


def added_up(rows: DataFrame, dtype: str) -> np.ndarray:
    """The tables of all workers, added up block by block; the sum has a fixed size and comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.frombuffer(part.as_buffer(), dtype)
                if block == last:
                    total += values
                    continue
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "part"])
                last, total = block, values.copy()
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "part"])

    table = rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, rows.schema).toArrow().sort_by("block")
    return np.concatenate([np.empty(0, dtype), *(np.frombuffer(part.as_buffer(), dtype) for part in table.column("part"))])


def fitted_spelling(types: DataFrame) -> Spelling:
    """From the different training words (``types``, packed), spread over as many tasks as the cluster runs at once."""
    context = types.sparkSession.sparkContext
    own = types.select("types").coalesce(max(context.defaultParallelism, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, some = Spelling(), False
        for words in different_words(batches):
            model.count(words)
            some = True
        if some:
            yield binary_rows(model.counts, SLOT_BLOCK)  # exact up to 16 million, beyond which a count no longer grows

    counts = added_up(own.mapInArrow(count, "block int, part binary"), "<f4")
    if not len(counts):
        return Spelling()
    shared = context.broadcast(counts.reshape(2, SLOTS))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = Spelling(shared.value), 0
        for words in different_words(batches):
            total += model.learn(words)
        if total:  # one row: the weights times the bits they were learned from, these bits, and the map
            yield binary_rows(np.concatenate([model.weights.ravel() * total, [total], model.refined.ravel()])[None], GATES * len(ORDERS) + 1 + 256 * BUCKETS * 2)

    learned = added_up(own.mapInArrow(learn, "block int, part binary"), "<f8")
    cut = GATES * len(ORDERS)
    return Spelling(counts.reshape(2, SLOTS), (learned[:cut] / learned[cut]).reshape(GATES, -1), learned[cut + 1 :].reshape(256, BUCKETS, 2))


# ---------------------------------------------------------------- words as paths of decisions


def word_class(c: np.ndarray) -> np.ndarray:
    """The number of binary digits of a count; 0 for none."""
    return np.frexp(c.astype(np.float64))[1].astype(np.int64)


@dataclass
class Codes:
    """What turns a word's bucket, count and place into its path: the Huffman code of its class, then its number in the class."""

    path: np.ndarray  # by class
    depth: np.ndarray
    digits: np.ndarray
    first: np.ndarray  # number of the first word by bucket and class

    @classmethod
    def of(cls, tallies: dict[int, np.ndarray]) -> Codes:
        many, held = np.zeros((WORD_BUCKETS, CLASSES), np.int64), np.zeros(CLASSES, np.int64)
        for bucket, tally in tallies.items():
            many[bucket] = tally[0]
            held += tally[1]
        seen_once = held[1]
        held[0], held[1] = seen_once // 2 + 1, seen_once - seen_once // 2
        path, depth = np.zeros(CLASSES, np.uint64), np.zeros(CLASSES, np.int64)
        heap = [(int(held[c]), c, (c,)) for c in range(CLASSES) if held[c]]
        heapq.heapify(heap)
        while len(heap) > 1:
            (n, _, zeros), (m, tie, ones) = heapq.heappop(heap), heapq.heappop(heap)
            for c in ones:
                path[c] |= np.uint64(1 << int(depth[c]))
            depth[[*zeros, *ones]] += 1
            heapq.heappush(heap, (n + m, tie, zeros + ones))
        of_class = many.sum(axis=0)
        of_class[0] = 0
        digits = np.array([int(n - 1).bit_length() if n else 0 for n in of_class])
        return cls(path, depth, digits, np.cumsum(many, axis=0) - many)

    def words(self, buckets: np.ndarray, c: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paths, and how many decisions they have."""
        classes = word_class(c)
        number = np.where(c > 0, self.first[buckets, classes] + place, 0).astype(np.uint64)
        return self.path[classes] << self.digits[classes].astype(np.uint64) | number, self.depth[classes] + self.digits[classes]


def later(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The value of the word before, 0 at the start of a text."""
    out = np.concatenate([values[:1], values[:-1]])
    out[starts] = 0
    return out


class Texts:
    """Some texts, their words in a row: paths, contexts, and the word that came last time after the same word of this text."""

    def __init__(self, ids: list[np.ndarray], kinds: np.ndarray, paths: np.ndarray, depths: np.ndarray, routes: Routes | None = None):
        self.routes = routes or Routes(depths, paths)
        self.sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int64)
        self.starts = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        self.text = np.repeat(np.arange(len(ids)), self.sizes)
        self.paths, self.depths = paths[self.ids], depths[self.ids]
        named = (self.paths * np.uint64(64) + self.depths.astype(np.uint64) + np.uint64(1)) * _MULT
        before = later(named ^ named >> np.uint64(29), self.starts)
        two = (before + later(before, self.starts) * np.uint64(0xD6E8FEB86659FD93)) * _MULT
        self.contexts = np.stack([(kinds[self.text].astype(np.uint64) + np.uint64(1)) * _MULT, before, two ^ two >> np.uint64(31)])
        self.expected = np.zeros(len(self.ids), np.uint64)
        self.expected_depth = np.zeros(len(self.ids), np.int64)
        self.longer = np.zeros(len(self.ids), np.int64)
        if len(self.ids):
            key = self.text << 32 | later(self.ids + 1, self.starts)
            order = np.argsort(key, kind="stable")
            again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
            now, last = order[again + 1], order[again]
            self.expected[now], self.expected_depth[now] = self.paths[last], self.depths[last]
            self.longer[now] = two[now] == two[last]

    def expecting(self, depths: np.ndarray, paths: np.ndarray) -> tuple[np.ndarray, ...]:
        """The words where one is expected, how many of their decisions that concerns, how many it foresees, and its first slot."""
        some = np.flatnonzero(self.expected_depth)
        size, expected = depths[some], self.expected_depth[some]
        whole = np.maximum(size, expected)
        differ = paths[some] << (whole - size).astype(np.uint64) ^ self.expected[some] << (whole - expected).astype(np.uint64)
        agreed = whole - bit_length(differ)
        # a word is expected up to the first decision that it would take otherwise
        return some, np.minimum(np.minimum(agreed + 1, size), expected), agreed, 1 + 64 * self.longer[some]

    def decisions(self, at: int, stop: int, slots: int, routes: Routes, ids: np.ndarray, expecting: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """For the words from ``at`` to ``stop``: lines (per context but the word expected), the place of each decision in a row of
        these lines, codes (``Nodes``), each word's first decision, the decisions with a word expected, and their slots in that context."""
        own = ids[at:stop]
        size, lines = routes.sizes[own], routes.lines[own]
        first, first_line = np.cumsum(size) - size, np.cumsum(lines) - lines
        word = np.repeat(np.arange(len(own)), lines)
        spread = routes.spread[np.arange(len(word)) + (routes.first_line[own] - first_line)[word]]
        out, shift = np.empty((CONTEXTS - 1, len(word)), np.int64), np.uint64(69 - slots.bit_length())
        for k in range(CONTEXTS - 1):
            mixed = self.contexts[k, at:stop][word]
            mixed ^= spread
            mixed *= _MULT
            mixed >>= shift
            np.add(mixed.view(np.int64), k * slots >> 4, out=out[k])
        which = np.repeat(routes.first[own] - first, size)
        which += np.arange(len(which))
        nodes = routes.nodes[which]
        code = (nodes & 2047).astype(np.int64)
        places = np.repeat(first_line << 4, size)
        places += nodes >> 11
        some, many, agreed, slot = (x[slice(*np.searchsorted(expecting[0], (at, stop)))] for x in expecting)
        depth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        awaited = depth + np.repeat(first[some - at], many)
        bit = NODES.bit.take(code[awaited], mode="clip") ^ (depth == np.repeat(agreed, many))
        return out, places, code, first, awaited, bit + 2 * np.minimum(depth, 31) + np.repeat(slot + (CONTEXTS - 1) * slots, many)


def bit_length(values: np.ndarray) -> np.ndarray:
    """The number of binary digits; halves, as a double would round what has more than 53."""
    high = values >> np.uint64(32)
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]).astype(np.int64)


class Nodes:
    """What a decision's code stands for. A code has the line (1: the first, 16 to 31: the second, by its node, 0: the third, 2: the
    fourth, 3: any other), the line's four decisions and which of these it is."""

    def __init__(self):
        line, four, which = (x.ravel() for x in np.meshgrid(np.arange(32), np.arange(16), np.arange(4), indexing="ij"))
        self.inside = 1 << which | four >> (4 - which)
        self.bit = four >> (3 - which) & 1
        self.added = np.uint64(1) << (self.bit.astype(np.uint64) << np.uint64(5))
        row = np.where((line == 1) | (line >= 16), (line - 1 << which) + self.inside, 0)
        self.row = row * BUCKETS
        self.cell = self.row * 2 + self.bit
        place = np.select([line == 1, line >= 16, line == 0, line == 2], [which, 4 + which, 8 + which, 12 + which], 15)
        self.gate = place * 8
        self.decided = self.bit.astype(np.float32)


NODES = Nodes()


class Routes:
    """The decisions of different words, one word after the other: what does not depend on the text.

    The 15 nodes of four decisions lie side by side in a line, so that a hash is needed for every fourth only."""

    def __init__(self, depths: np.ndarray, paths: np.ndarray):
        self.sizes, self.lines = depths, (depths + 3) >> 2
        self.first, self.first_line = np.cumsum(self.sizes) - self.sizes, np.cumsum(self.lines) - self.lines
        parts = [self.part(depths[at : at + GROUP_WORDS // 8], paths[at : at + GROUP_WORDS // 8]) for at in range(0, len(depths), GROUP_WORDS // 8)]
        self.spread = np.concatenate([np.empty(0, np.uint64), *(spread for spread, _ in parts)])
        self.nodes = np.concatenate([np.empty(0, np.int32), *(nodes for _, nodes in parts)])

    @staticmethod
    def part(size: np.ndarray, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is hashed with the context, per line; and per decision its place in the word's lines (from 2048 on) and its code."""
        lines = (size + 3) >> 2
        word = np.repeat(np.arange(len(size)), lines)
        step = np.arange(len(word)) - (np.cumsum(lines) - lines)[word]
        left, path = size[word] - 4 * step, paths[word]
        nodes = path >> left.astype(np.uint64) | np.uint64(1) << (4 * step).astype(np.uint64)
        four = path >> np.maximum(left - 4, 0).astype(np.uint64) << np.maximum(4 - left, 0).astype(np.uint64) & np.uint64(15)
        spread = nodes * np.uint64(0xC2B2AE3D27D4EB4F)
        spread ^= spread >> np.uint64(32)
        # the first two lines of a path by their node, the others by their depth
        line = np.where(step < 2, np.minimum(nodes, np.uint64(31)).view(np.int64), np.array([0, 0, 0, 2, 3])[np.minimum(step, 4)])
        many = np.minimum(left, 4)
        of_line = np.repeat(np.arange(len(many)), many)
        code = ((line * 16 + four.view(np.int64)) * 4 - np.cumsum(many) + many)[of_line] + np.arange(len(of_line))
        return spread, ((step[of_line] << 4 | NODES.inside[code]) << 11 | code).astype(np.int32)


def gathered(table: np.ndarray, lines: np.ndarray, places: np.ndarray) -> np.ndarray:
    """What a table holds for some decisions; whole lines are fetched first."""
    return table.reshape(-1, 16).take(lines, axis=0, mode="clip").reshape(len(lines), -1).take(places, axis=1, mode="clip")


def gates(code: np.ndarray, inputs: np.ndarray, awaited: np.ndarray) -> np.ndarray:
    """By depth, how many of the contexts but the word expected say something, and whether a word is expected."""
    gate, says = NODES.gate.take(code, mode="clip"), (inputs != 0).view(np.int8)
    gate += (says[0] + says[1] + says[2]) * np.int8(2)
    gate[awaited] += 1
    return gate


def mixture(weights: np.ndarray, gate: np.ndarray, inputs: np.ndarray, awaited: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Predictions mixed in the logistic domain; ``expected``: what the word expected says about the decisions ``awaited``."""
    total = np.zeros(len(gate), np.float32)
    for k in range(CONTEXTS - 1):
        total += weights[:, k].take(gate, mode="clip") * inputs[k]
    total[awaited] += weights[:, -1].take(gate[awaited], mode="clip") * expected
    return np.clip(total, -14, 14, out=total)


@dataclass
class Words:
    """Counts of zeros (lower half of a number) and ones per slot, weights per gate, and the adaptive map's counts."""

    slots: int
    counts: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.full((WORD_GATES, CONTEXTS), 0.4))
    refined: np.ndarray = field(default_factory=lambda: np.zeros((256, BUCKETS, 2)))

    @classmethod
    def empty(cls, slots: int) -> Words:
        return cls(slots, np.zeros(slots * (CONTEXTS - 1) + 256, np.uint64))

    def halves(self) -> np.ndarray:
        return self.counts.view("<u4").reshape(-1, 2)

    def stretched(self) -> np.ndarray:
        """The prediction of every slot in the logistic domain; 0 where no word is expected."""
        zeros, ones = self.halves().T.astype(np.float32) + np.float32(SOFT)
        out = np.log(ones / zeros)
        out[self.slots * (CONTEXTS - 1)] = 0
        return out

    @staticmethod
    def inputs(counts: np.ndarray) -> np.ndarray:
        """Predictions from counts, in the logistic domain."""
        both = counts.view("<u4").astype(np.float32)
        both += np.float32(SOFT)
        return np.log(both[..., 1::2] / both[..., ::2])

    def learn(self, texts: Texts, depths: np.ndarray, paths: np.ndarray, routes: Routes | None = None) -> int:
        """Online: each block is predicted, then learned. Gives the number of decisions. ``routes``: of the numbered words."""
        ids, expecting = texts.ids if routes else np.arange(len(texts.ids)), texts.expecting(depths, paths)
        routes = routes or Routes(depths, paths)
        done, cells, none = 0, np.zeros(self.refined.size, np.int64), self.slots * (CONTEXTS - 1)
        for at in range(0, len(texts.ids), PATH_WORDS):
            lines, places, code, _, awaited, last = texts.decisions(at, at + PATH_WORDS, self.slots, routes, ids, expecting)
            # places go by the row of lines, and slots by the table
            slots, lines = np.empty((CONTEXTS - 1, len(code)), np.int64), (lines - np.arange(lines.shape[1])) << 4
            of_line, inputs = places >> 4, np.empty(slots.shape, np.float32)
            for k in range(CONTEXTS - 1):
                np.add(lines[k].take(of_line, mode="clip"), places, out=slots[k])
                inputs[k] = self.inputs(self.counts.take(slots[k], mode="clip"))
            expected = self.inputs(self.counts[last])
            gate = gates(code, inputs, awaited)
            mixed = mixture(self.weights.astype(np.float32), gate, inputs, awaited, expected)
            wrong = NODES.decided.take(code, mode="clip") - 1 / (1 + np.exp(-mixed))
            seen = np.maximum(np.bincount(gate, minlength=WORD_GATES), 1)
            for k in range(CONTEXTS - 1):
                self.weights[:, k] += RATE * np.bincount(gate, wrong * inputs[k], minlength=WORD_GATES) / seen
            self.weights[:, -1] += RATE * np.bincount(gate[awaited], wrong[awaited] * expected, minlength=WORD_GATES) / seen
            bucket = np.rint((mixed + 14) / 28 * (BUCKETS - 1)).astype(np.int64)
            cells += np.bincount(NODES.cell.take(code, mode="clip") + 2 * bucket, minlength=len(cells))
            added = NODES.added.take(code, mode="clip")
            for k in range(CONTEXTS - 1):
                np.add.at(self.counts, slots[k], added)
            np.add.at(self.counts, last, added[awaited])
            self.counts[none] += added.sum() - added[awaited].sum()
            done += len(code)
        self.refined += cells.reshape(self.refined.shape)
        return done


@dataclass
class Learned:
    """The model of words as it is sent to the tasks that score."""

    slots: int
    stretched: np.ndarray
    weights: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, model: Words) -> Learned:
        centre = 1 / (1 + np.exp(-(np.arange(BUCKETS) / (BUCKETS - 1) * 28 - 14)))
        # every bucket starts as if it had seen a few bits that agree with the mixer
        table = (model.refined[:, :, 1] + 4 * centre) / (model.refined.sum(axis=2) + 4)
        return cls(model.slots, model.stretched(), model.weights.astype(np.float32), table.astype(np.float32).ravel())

    def log10(self, texts: Texts) -> np.ndarray:
        """The log-probability of each word's path."""
        out, expecting = np.zeros(len(texts.ids)), texts.expecting(texts.depths, texts.paths)
        for at in range(0, len(texts.ids), SCORE_WORDS):
            lines, places, code, first, awaited, last = texts.decisions(at, at + SCORE_WORDS, self.slots, texts.routes, texts.ids, expecting)
            if not len(code):
                continue
            inputs = gathered(self.stretched, lines, places)
            gate = gates(code, inputs, awaited)
            mixed = mixture(self.weights, gate, inputs, awaited, self.stretched.take(last, mode="clip"))
            place = (mixed + np.float32(14)) * np.float32((BUCKETS - 1) / 28)
            low = np.minimum(place.astype(np.int64), BUCKETS - 2)
            share = place - low.astype(np.float32)
            low += NODES.row.take(code, mode="clip")
            mapped = self.table.take(low, mode="clip") * (1 - share) + self.table[1:].take(low, mode="clip") * share
            chance = np.clip(0.5 / (1 + np.exp(-mixed)) + 0.5 * mapped, np.float32(1e-6), np.float32(1 - 1e-6))
            # the chance of what was decided; every word has a decision, as every class has one if there are two
            out[at : at + SCORE_WORDS] = np.add.reduceat(np.log10(np.abs(NODES.decided.take(code, mode="clip") + chance - 1)), first)
        return out


class Vocabulary:
    """The words of a chunk by number: counts, paths, and those without a count."""

    def __init__(self):
        self.parts, self.unseen = [], {}

    def add(self, rows: pa.RecordBatch) -> None:
        for row in rows.to_pylist():
            numbers, c = unpacked(row["numbers"], np.uint32), unpacked(row["c"], np.int64)
            self.parts.append((numbers, np.full(len(numbers), row["bucket"]), c, unpacked(row["place"], np.uint32)))
            new = numbers[c == 0].tolist()
            if new:
                self.unseen.update(zip(new, unpacked_words(row["unseen"]), strict=True))

    def settle(self, codes: Codes, learns: bool) -> None:
        if self.parts is None:
            return
        numbers, buckets, c, place = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (np.empty(0, np.int64) for _ in range(4))
        self.parts, order = None, np.argsort(numbers)
        self.c, self.place = c[order], place[order]
        self.paths, self.depths = codes.words(buckets[order], self.c, self.place)
        missing = codes.words(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))
        as_new = (self.c == 1) & (self.place % 2 == 1)  # learned as words without a count
        self.learned_paths, self.learned_depths = np.where(as_new, missing[0], self.paths), np.where(as_new, missing[1], self.depths)
        self.routes = Routes(self.learned_depths, self.learned_paths) if learns else Routes(self.depths, self.paths)


def texts_of(batches: Iterator[pa.RecordBatch], codes: Codes, learns: bool = False) -> Iterator[tuple[pa.RecordBatch, Vocabulary, Texts]]:
    """Rows in the order of their chunks, a chunk's words before its documents; gives some documents at a time."""
    chunk, words = None, Vocabulary()
    for batch in batches:
        own, answers = batch.column(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((own[1:] != own[:-1]) | (answers[1:] != answers[:-1])) + 1
        for at, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)], strict=True):
            if at == stop:
                continue
            if own[at] != chunk:
                chunk, words = own[at], Vocabulary()
            if answers[at]:
                words.add(batch.slice(at, stop - at))
                continue
            words.settle(codes, learns)
            group = np.cumsum(batch.column("n_words").to_numpy(zero_copy_only=False)[at:stop].astype(np.int64)) // GROUP_WORDS
            edges = [at, *(np.flatnonzero(np.diff(group)) + 1 + at).tolist(), stop]
            for a, b in zip(edges, edges[1:], strict=False):
                rows = batch.slice(a, b - a)
                ids = [unpacked(part.as_py(), np.uint32) for part in rows.column("ids")]
                yield rows, words, Texts(ids, rows.column("kind").to_numpy(zero_copy_only=False).astype(np.int64), words.paths, words.depths, words.routes)


def fitted_words(together: DataFrame, codes: Codes, words: int) -> Words:
    """From the training texts; ``together``: words and documents by chunk."""
    slots = 1 << min(max((4 * words).bit_length(), 12), WORD_SLOTS.bit_length() - 1)
    shared = together.sparkSession.sparkContext.broadcast(codes)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = Words.empty(slots), 0
        for _, chunk, texts in texts_of(batches, shared.value, learns=True):
            total += model.learn(texts, chunk.learned_depths[texts.ids], chunk.learned_paths[texts.ids], chunk.routes)
        if total:  # the counts, the weights times the decisions they were learned from, these decisions, and the map
            flat = np.concatenate([model.halves().ravel(), model.weights.ravel() * total, [total], model.refined.ravel()]).astype("<f4")
            yield binary_rows(np.concatenate([flat, np.zeros(-len(flat) % SLOT_BLOCK, "<f4")]), SLOT_BLOCK)

    learned = added_up(together.coalesce(LEARNERS).mapInArrow(learn, "block int, part binary"), "<f4")
    model = Words.empty(slots)
    if len(learned):
        cuts = np.cumsum([2 * len(model.counts), model.weights.size, 1, model.refined.size])
        counts, weights, total, refined, _ = np.split(learned, cuts)
        model = Words(slots, np.minimum(counts, 4e9).astype("<u4").view(np.uint64), (weights / total).reshape(WORD_GATES, -1), refined.reshape(256, BUCKETS, 2))
    return model


# ---------------------------------------------------------------- ends of texts


def length_bucket(words: Column) -> Column:
    return F.length(F.bin(words + 1)) - 1


def end_chances(lengths: DataFrame) -> np.ndarray:
    """The chance that a text of so many words ends there, per power of two; ``lengths``: ``n_words`` of training texts."""
    low = F.pow(F.lit(2.0), F.col("b")).cast("long") - 1
    seen = F.least(F.col("n_words"), 2 * low) - low + 1
    rows = lengths.select("n_words", F.explode(F.sequence(F.lit(0), length_bucket(F.col("n_words")))).alias("b"))
    summed = rows.groupBy("b").agg(F.sum(seen).alias("seen"), F.sum((length_bucket(F.col("n_words")) == F.col("b")).cast("long")).alias("ended"))
    chances = np.full(64, 0.5)
    for row in summed.collect():  # a row per power of two
        chances[row.b] = (row.ended + 0.5) / (row.seen + 1)
    return chances


def end_scores(chances: np.ndarray, words: np.ndarray) -> np.ndarray:
    """log10 of going on after each word and ending after the last."""
    starts = 2.0 ** np.arange(64) - 1
    goes_on = np.log10(1 - chances)
    before = np.concatenate([[0.0], np.cumsum(goes_on[:-1] * 2.0 ** np.arange(63))])
    bucket = np.floor(np.log2(words + 1.0)).astype(np.int64)
    return before[bucket] + goes_on[bucket] * (words - starts[bucket]) + np.log10(chances[bucket])


# ---------------------------------------------------------------- scores


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``."""
    rows = chunks(docs, id_col, text_col)
    # One shuffle by hash bucket gives every chunk the counts of its words.
    asked = rows.where("bucket IS NOT NULL").select("bucket", "chunk", "numbers", "words", "train", "kinds")
    answers = staged(asked.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(counted, COUNTED), "word-counts")
    tallies = {row.bucket: np.frombuffer(row.tally, np.int64).reshape(2, CLASSES) for row in answers.where("tally IS NOT NULL").select("bucket", "tally").collect()}  # a row per bucket
    documents = rows.where("bucket IS NULL")
    trained = documents.where("NOT held_out").select("n_words", "kind")
    texts = {row.kind: row.n for row in trained.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    types, words = (int(sum(tally[i][1:].sum() for tally in tallies.values())) for i in (0, 1))
    numbers = {
        "tokens": words + sum(texts.values()),
        "types": types + bool(texts),
        "texts": sum(texts.values()),
        "kind_score": np.log10([(texts.get(k, 0) + 1) / (sum(texts.values()) + KINDS) for k in range(KINDS)]),
        "ends": end_chances(trained.select("n_words")),
    }
    codes = Codes.of(tallies)
    columns = ["chunk", "numbers", "bucket", "c", "place", "unseen", "doc_id", "held_out", "n_words", "n_bytes", "ids", "kind"]

    def by_chunk(documents: DataFrame) -> DataFrame:
        given = answers.where("numbers IS NOT NULL").select(*columns[:6])
        together = given.unionByName(documents.select("chunk", *columns[6:]), allowMissingColumns=True).select(*columns)
        return together.repartition("chunk").sortWithinPartitions("chunk", F.col("numbers").isNull(), "bucket")

    model = Learned.of(fitted_words(by_chunk(documents.where("NOT held_out")), codes, words))
    spelling = fitted_spelling(answers.where("types IS NOT NULL"))
    return answered(by_chunk(documents), (codes, model, spelling, numbers))


def answered(together: DataFrame, model: tuple) -> DataFrame:
    """The chunks' texts are scored; ``together``: words and documents by chunk."""
    shared = together.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [together.schema["doc_id"], T.StructField("held_out", T.BooleanType())]
        + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "bits_per_byte")]
    )

    def text_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, model, spelling, known = shared.value
        total, end_c = known["tokens"] + known["types"] + 1, known["texts"]
        for rows, chunk, texts in texts_of(batches, codes):
            c, kind = chunk.c[texts.ids], rows.column("kind").to_numpy(zero_copy_only=False).astype(np.int64)
            scores = model.log10(texts)
            missing = np.flatnonzero(c == 0)
            scores[missing] += spelled(texts, missing, chunk, kind, spelling)
            of_text = lambda values: np.bincount(texts.text, values, minlength=len(kind))  # noqa: E731, B023
            n, size = (rows.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("n_words", "n_bytes"))
            n_known = of_text(c > 0).astype(np.int64)
            base = of_text(np.log10((c + 1) / total)) + log10((end_c + 1) / total)
            score = of_text(scores) + end_scores(known["ends"], n.astype(np.float64)) + known["kind_score"][kind]
            columns = [n + 1, n_known + (end_c > 0), np.full(len(n), known["tokens"]), base, score, -score / log10(2) / np.maximum(size, 1)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), *(pa.array(x) for x in columns)], names=schema.names)

    return together.mapInArrow(text_scores, schema)


def spelled(texts: Texts, missing: np.ndarray, chunk: Vocabulary, kind: np.ndarray, spelling: Spelling) -> np.ndarray:
    """log10 for the words without a count: drawn again from those of their text so far, or spelled."""
    if not len(missing):
        return np.zeros(0)
    text = texts.text[missing]
    key = text << 32 | texts.ids[missing]
    order = np.argsort(key, kind="stable")
    run = np.diff(key[order], prepend=-1) != 0
    used = np.empty(len(missing), np.int64)
    used[order] = np.arange(len(missing)) - np.flatnonzero(run)[np.cumsum(run) - 1]
    so_far = np.arange(len(missing)) - np.searchsorted(text, text)
    out = np.log10(np.where(used > 0, used, URN) / (so_far + URN))
    first = np.flatnonzero(used == 0)
    words = [bytes((k,)) + chunk.unseen[i] for k, i in zip(kind[text[first]].tolist(), texts.ids[missing[first]].tolist(), strict=True)]
    different = list(dict.fromkeys(words))
    logs = dict(zip(different, spelling.log10(different).tolist(), strict=True))
    out[first] += [logs[word] for word in words]
    return out
