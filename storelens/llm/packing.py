"""Harmonic packing of tokenised documents.

Lengths fall into classes by reciprocal of the capacity: a bin of class j holds exactly j pieces of capacity / j tokens.
Documents may be cut, so each is cut into pieces whose lengths are such reciprocals exactly: whole capacities
first, then the halves, quarters, ... that its rest is the sum of. Full bins have no padding, and the last pieces
of a class go into bins whose totals are powers of two, so that nothing is padded.

Each worker numbers its pieces per class by itself; where its numbers start follows from the counts of the workers
before it, a table of one row per worker and class. Nothing else passes between workers.

Defined results: null and empty texts are the end token alone. Repeated rows are packed each. An empty table gives no
pieces. Other columns are not read. The tokenizer file must exist on every worker under the given path.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.session import staged

CAPACITY = 2048
END_ID = 1
# Words whose ids a worker remembers at a time.
REMEMBERED = 1_000_000


@cache
def loaded(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # the names of special tokens are ordinary text in a document
    return tokenizer


class WordIds(dict):
    """Ids of words, as little-endian 32-bit numbers, worked out when first asked for.

    For tokenizers that ignore case and whose tokens never reach across white space, nor from a letter or digit to a
    mark that follows it: a word's ids are those of its lower-case stem and then those of its closing marks. A word of
    small ASCII letters is left as it is by the tokenizer's first steps, so that its model is asked directly.
    """

    MARKS = b".,;:!?*#$%&|()[]{}+=/-"

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__()
        self.tokenizer = loaded(path)
        self.model = self.tokenizer.model
        self.remembered = remembered

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(self.MARKS)
        plain = stem.lower()
        if stem and plain != word and stem.decode()[-1].isalnum():
            marks = word[len(stem) :]
            return self[plain] + self[marks] if marks else self[plain]
        if word.isalpha() and word.islower():
            ids = array("I", [token.id for token in self.model.tokenize(word.decode())])
        else:
            ids = array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        if len(self) >= self.remembered:
            self.clear()
        self[word] = found = ids.tobytes()
        return found

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or "").encode().split()))


@cache
def word_ids(path: str) -> WordIds:
    """One per Python worker, kept from task to task."""
    return WordIds(path)


def cut(tokens: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of the pieces: whole capacities, then the powers of two in the rest, longest first."""
    start = 0
    while tokens - start >= capacity:
        yield start, capacity
        start += capacity
    size = capacity
    while start < tokens:
        size //= 2
        if tokens - start >= size:
            yield start, size
            start += size


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece with its worker, its class and its place among the worker's pieces of the class; written once."""
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType)]
    fields += [T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32", "doc_tokens", "class", "worker", "place")]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, worker, places = word_ids(tokenizer), TaskContext.get().partitionId(), {}
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            which, rows, ids = [], [], []
            for i, text in enumerate(batch.column(1)):
                got = words.ids(text.as_py()) + end
                tokens = len(got) // 4
                for start, length in cut(tokens, capacity):
                    own = got[4 * start : 4 * (start + length)]
                    kind = capacity // length
                    place = places.get(kind, 0)
                    places[kind] = place + 1
                    which.append(i)
                    rows.append((start, length, zlib.crc32(own), tokens, kind, worker, place))
                    if with_ids:
                        ids.append(own)
                if len(rows) >= 100_000 or sum(map(len, ids[-1:])) and len(ids) >= 4096:
                    yield made(batch, which, rows, ids)
                    which, rows, ids = [], [], []
            if rows:
                yield made(batch, which, rows, ids)

    def made(batch: pa.RecordBatch, which: list[int], rows: list[tuple], ids: list[bytes]) -> pa.RecordBatch:
        columns = [batch.column(0).take(pa.array(which)), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
        return pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return staged(narrow.mapInArrow(run, T.StructType(fields)), "pieces")


def packed_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and its ``ids`` if asked for.

    ``capacity`` must be a power of two. Sequences are numbered from 0 without gaps.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    found = pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids)
    counts = staged(found.groupBy("class", "worker").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("class", "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # One row per class from here on: as many as the capacity has halves.
    totals = counts.groupBy("class").agg(F.sum("n").alias("total"))
    bins = F.floor(F.col("total") / F.col("class")) + F.bit_count(F.col("total") % F.col("class"))
    earlier = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("base", F.coalesce(F.sum(bins).over(earlier), F.lit(0)))
    rank = F.col("first") + F.col("place")
    ranked = found.join(starts, ["class", "worker"]).join(F.broadcast(totals), "class").withColumn("rank", rank)
    full = (F.col("total") - F.col("total") % F.col("class")).cast("long")
    bin_, nth = rest_bin(F.col("rank") - full, F.col("total") % F.col("class"), capacity)
    whole = F.col("rank") < full
    sequence = F.when(whole, F.floor(F.col("rank") / F.col("class"))).otherwise(F.floor(full / F.col("class")) + bin_)
    within = F.when(whole, F.col("rank") % F.col("class")).otherwise(nth)
    return ranked.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("base") + sequence).cast("long").alias("sequence_id"),
        (within * F.col("length")).cast("long").alias("offset"),
        *["ids"] * with_ids,
    )


def rest_bin(place: Column, rest: Column, capacity: int) -> tuple[Column, Column]:
    """Bin and place in it of the last ``rest`` pieces of a class, which fill one bin per power of two in ``rest``."""
    bins, nths = [], []
    for bit in reversed(range(capacity.bit_length())):
        above = F.shiftleft(F.shiftright(rest, bit + 1), bit + 1)
        here = (rest.bitwiseAND(F.lit(1 << bit)) != 0) & (place >= above) & (place < above + (1 << bit))
        bins.append(F.when(here, F.bit_count(F.shiftright(rest, bit + 1))))
        nths.append(F.when(here, place - above))
    return F.coalesce(*bins), F.coalesce(*nths)
