"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has a bit for each bit position that is set in more than half of its shingle hashes. Two texts are
linked if their fingerprints differ in at most ``max_distance`` bits; groups are the connected components.

The search splits the 64 bits into parts and gives part i a threshold t_i of -1 or more, the t_i adding up to
``max_distance - parts + 1``: any two fingerprints within the distance then differ in at most t_i bits of some part i.
Correlated bits are put into one part. How many parts, and which thresholds, is decided by dynamic programming on
the candidates that each choice would give, estimated from counts over all fingerprints. Every fingerprint is filed
under its parts' values, probes the values within t_i, and what meets in a bucket is verified.

Any choice of parts gives the same links, so the estimates decide about cost only. A task reports what it finds as a
forest, never as all pairs. A bucket above ``bucket_rows`` is dealt to several tasks, block against block.

Defined results: null and empty texts, and texts without a word, have fingerprint zero and are linked like any other.
Null ids are passed over when the lowest id of a component is taken; a component of null ids only has a null id.
Repeated rows are members of one component. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import finished, packed, text_of
from storelens.llm.components import components
from storelens.session import staged

SEED = 42
SHINGLE_BLOCK = 1 << 18
BUCKET_ROWS = 50_000
# A probe is shuffled and sorted, a candidate compared in memory: so many comparisons cost as much as one probe. Measured
# on 235,720 fingerprints under three plans, from 1.7 M probes and 376 M comparisons to 6.7 M and 25 M: 200 to 400.
PROBE_COST = 200
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = 4, distinct: bool = False) -> int:
    """The unsigned 64-bit fingerprint; ``distinct`` counts each different shingle once."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = max(len(words) - shingle, 0)
    starts, ends = starts[: last + 1], ends[min(shingle, len(words)) - 1 :]
    counts = np.zeros((8, 256), np.int64)
    total, seen, digest = 0, set(), xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLE_BLOCK):
        spans = zip(starts[at : at + SHINGLE_BLOCK].tolist(), ends[at : at + SHINGLE_BLOCK].tolist(), strict=True)
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
        if distinct:
            hashes = list(set(hashes) - seen)
            seen.update(hashes)
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += len(hashes)
        for place in range(8):
            counts[place] += np.bincount(octets[:, place], minlength=256)
    ones = (counts @ _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distinct: bool = False) -> DataFrame:
    """``doc_id, text_hash, fp`` per row, written once. ``fp`` holds the fingerprint's 64 bits as a signed number."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle, distinct) for t in batch.column(2)]
            prints = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], ["doc_id", "text_hash", "fp"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    return staged(narrow.mapInArrow(run, schema), "fingerprints")


# ---------------------------------------------------------------- parts and thresholds


def bit_counts(prints: DataFrame) -> np.ndarray:
    """64 x 64: in how many fingerprints both bits are set. Counted over all rows; 4096 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((64, 64), np.int64)
        for batch in batches:
            octets = batch.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(octets, axis=1, bitorder="little").astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
        if both.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(both.ravel())], ["cell", "n"])

    sums = prints.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(4096, np.int64)
    for row in sums:
        both[row.cell] = row.n
    return both.reshape(64, 64)


def grouped_bits(both: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` nearly equal parts; each starts from a bit and takes those most correlated with it."""
    share = np.diag(both) / max(rows, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs((both / max(rows, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free, grouped = set(range(64)), []
    for part in range(parts):
        size = (64 - sum(map(len, grouped))) // (parts - part)
        left = sorted(free)
        first = left[int(np.argmax(related[np.ix_(left, left)].sum(axis=1)))]
        chosen = [first]
        while len(chosen) < size:
            left = sorted(free - set(chosen))
            chosen.append(left[int(np.argmax(related[np.ix_(left, chosen)].mean(axis=1)))])
        free -= set(chosen)
        grouped.append(sorted(chosen))
    return grouped


def mask_of(bits: list[int]) -> int:
    """The bits as a signed 64-bit mask."""
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def value_counts(prints: DataFrame, plans: dict[int, list[list[int]]]) -> DataFrame:
    """``parts, part, key, n``: how many fingerprints have each value in each part of each way to split the bits."""
    choices = [
        F.struct(F.lit(parts).alias("parts"), F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(mask_of(bits))).alias("key"))
        for parts, groups in plans.items()
        for i, bits in enumerate(groups)
    ]
    return prints.select(F.explode(F.array(*choices)).alias("c")).select("c.*").groupBy("parts", "part", "key").agg(F.count(F.lit(1)).alias("n"))


def allocated(widths: list[int], budget: int, cost) -> tuple[float, list[int]]:
    """Thresholds of -1 or more that add up to ``budget`` at the least total ``cost(part, threshold)``."""
    best = {0: (0.0, [])}
    for part, width in enumerate(widths):
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for t in range(-1, min(width, budget + len(widths)) + 1):
                total = spent + (cost(part, t) if t >= 0 else 0.0)
                if used + t not in grown or total < grown[used + t][0]:
                    grown[used + t] = (total, [*chosen, t])
        best = grown
    return best[budget]


def agreement(share: np.ndarray, bits: list[int]) -> np.ndarray:
    """Chance that two unrelated fingerprints differ in exactly 0, 1, ... of ``bits``."""
    chance = np.array([1.0])
    for b in bits:
        differ = 2 * share[b] * (1 - share[b])
        chance = np.append(chance, 0) * (1 - differ) + np.insert(chance, 0, 0) * differ
    return chance


def search_plan(prints: DataFrame, max_distance: int) -> tuple[list[tuple[int, int]], list[list[int]], DataFrame, int]:
    """The cheapest split: ``(mask, threshold)`` per part used, the bits, the value counts, and the number of parts."""
    rows = prints.count()
    both = bit_counts(prints)
    share = np.diag(both) / max(rows, 1)
    plans = {m: grouped_bits(both, rows, m) for m in range(max(1, max_distance // 2), max_distance + 2)}
    counts = staged(value_counts(prints, plans), "part-values")
    equal = {(r.parts, r.part): float(r.pairs) for r in counts.groupBy("parts", "part").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs")).collect()}
    best = None
    for m, groups in plans.items():
        chances = [np.cumsum(agreement(share, bits)) for bits in groups]

        def cost(part: int, t: int, m=m, groups=groups, chances=chances) -> float:
            probes = 1 + sum(comb(len(groups[part]), k) for k in range(1, t + 1)) / 2
            unequal = chances[part][min(t, len(groups[part]))] - chances[part][0]
            return PROBE_COST * rows * probes + (equal.get((m, part), 0.0) + float(rows) ** 2 * unequal) / 2

        total, thresholds = allocated([len(g) for g in groups], max_distance - m + 1, cost)
        if best is None or total < best[0]:
            best = (total, m, thresholds)
    _, m, thresholds = best
    used = [(mask_of(bits), t) for bits, t in zip(plans[m], thresholds, strict=True)]
    return used, plans[m], counts.where(F.col("parts") == m), m


# ---------------------------------------------------------------- probe and verify


def flips(bits: list[int], threshold: int) -> list[int]:
    """Masks that change at most ``threshold`` of the bits; the first changes none."""
    return [mask_of(list(some)) if some else 0 for k in range(threshold + 1) for some in combinations(bits, k)]


def probes(prints: DataFrame, used: list[tuple[int, int]], groups: list[list[int]]) -> DataFrame:
    """``part, key, fp, filed``: where a fingerprint is filed, and the higher values within the part's threshold.

    Of two different values one is higher, so it is enough that the lower one probes.
    """

    def places(part: int, mask: int, threshold: int, bits: list[int]) -> Column:
        value = F.col("fp").bitwiseAND(F.lit(mask))
        changes = F.array(*[F.lit(f).cast("long") for f in flips(bits, threshold)])
        keys = F.filter(F.transform(changes, lambda f: value.bitwiseXOR(f)), lambda key: key >= value)
        return F.transform(keys, lambda key: F.struct(F.lit(part).alias("part"), key.alias("key"), (key == value).alias("filed")))

    parts = [places(i, mask, t, bits) for i, ((mask, t), bits) in enumerate(zip(used, groups, strict=True)) if t >= 0]
    return prints.select("fp", F.explode(F.concat(*parts)).alias("p")).select("p.part", "p.key", "fp", "p.filed")


def dealt(rows: DataFrame, counts: DataFrame, bucket_rows: int) -> DataFrame:
    """Adds ``block``. A bucket above ``bucket_rows`` is cut into blocks, and each row goes to every pair with its own.

    So two rows of a bucket still meet, in the task of their two blocks.
    """
    large = staged(
        counts.where(F.col("n") > bucket_rows).select("part", "key", F.ceil(F.col("n") / bucket_rows).cast("int").alias("blocks")),
        "large-buckets",
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.least(b.cast("int"), own) * F.col("blocks") + F.greatest(b.cast("int"), own),
    )
    joined = rows.join(large, ["part", "key"], "left")
    return joined.select("part", "key", "fp", "filed", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("block"))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links and the lowest node it is connected to, without the lowest ones themselves."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)], place[len(a) :]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[u], low[v])
        new = low.copy()
        np.minimum.at(new, low[u], least)
        np.minimum.at(new, low[v], least)
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == low).all():
            break
        low = new
    moved = low != np.arange(len(nodes))
    return nodes[moved], nodes[low[moved]]


def linked_in(start: np.ndarray, prints: np.ndarray, filed: np.ndarray, max_distance: int, step: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Links inside buckets. ``start`` marks the first row of each bucket, filed rows come first in it."""
    ends = np.append(np.flatnonzero(start)[1:], len(prints))
    end = ends[np.cumsum(start) - 1]
    rows = np.flatnonzero(filed & (end - np.arange(len(prints)) > 1))
    partners = end[rows] - rows - 1
    bits = prints.view(np.uint64)
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    upto = np.cumsum(partners)
    at = 0
    while at < len(rows):
        done = upto[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(upto, done + step, "right")))
        left = np.repeat(rows[at:until], partners[at:until])
        first = np.repeat(upto[at:until] - partners[at:until] - done, partners[at:until])
        right = left + 1 + np.arange(len(left)) - first
        near = np.bitwise_count(bits[left] ^ bits[right]) <= max_distance
        a, b = prints[left[near]], prints[right[near]]
        other = a != b
        if other.any():
            a, b = forest(a[other], b[other])
            found_a.append(a)
            found_b.append(b)
        at = until
    return np.concatenate(found_a), np.concatenate(found_b)


def links(prints: DataFrame, max_distance: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``u, v``: links that connect exactly what is connected by distances up to ``max_distance``. ``prints``: distinct ``fp``."""
    used, groups, counts, _ = search_plan(prints, max_distance)
    rows = dealt(probes(prints, used, groups), counts, bucket_rows)

    def found(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        part, key, block, prints, filed = held
        start = np.empty(len(key), bool)
        start[:1] = True
        start[1:] = (part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        a, b = linked_in(start, prints, filed, max_distance)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            part, key, block = held[:3]
            same = (part == part[-1]) & (key == key[-1]) & (block == block[-1])
            cut = int(np.argmax(same))  # the last bucket may go on
            if cut:
                yield from found([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None:
            yield from found(held)

    ordered = rows.select("part", "key", "block", "fp", "filed").repartition("part", "key", "block")
    ordered = ordered.sortWithinPartitions("part", "key", "block", F.desc("filed"))
    return ordered.mapInArrow(run, "u long, v long")


# ---------------------------------------------------------------- operators


def component_labels(prints: DataFrame, max_distance: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``fp, component_id``: the lowest id of the component, per different fingerprint; written once."""
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    members = staged(components(links(classes.select("fp"), max_distance, bucket_rows)).withColumnRenamed("node", "fp"), "members")
    lowest = staged(members.join(classes, "fp").groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    labelled = staged(members.join(lowest, "root").select("fp", "component_id"), "linked-prints")
    return staged(
        classes.join(labelled, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "component-labels"
    )


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    distinct: bool = False,
    max_distance: int = 4,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per row: ``doc_id, text_hash, fp, component_id``."""
    prints = fingerprints(docs, id_col, text_col, shingle, distinct)
    return prints.join(component_labels(prints, max_distance, bucket_rows), "fp").select("doc_id", "text_hash", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one per component of ``simhash_components``, with all their columns: the one with the lowest id.

    Shingles of four words and at most four differing bits. Only rows that agree in id and text are told apart by a window
    over whole rows; all others are joined to the short list of those that stay.
    """
    spark = docs.sparkSession

    def stays() -> DataFrame:
        rows = simhash_components(docs, id_col, text_col, shingle=4, distinct=False, max_distance=4)
        first = Window.partitionBy("component_id").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash")
        one = rows.withColumn("place", F.row_number().over(first)).where("place = 1").select("doc_id", "text_hash")
        copies = rows.groupBy(F.col("doc_id").alias("same_id"), F.col("text_hash").alias("same_hash")).agg(F.count(F.lit(1)).alias("copies"))
        same = one.doc_id.eqNullSafe(copies.same_id) & (one.text_hash == copies.same_hash)
        return one.join(copies, same).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), "copies")

    kept = finished(spark, "near-kept", stays)
    text_hash = F.xxhash64(F.coalesce(F.col(f"whole.`{text_col}`"), F.lit("")))
    keyed = packed(docs).select("whole", F.col(f"whole.`{id_col}`").alias("own_id"), text_hash.alias("own_hash"))
    joined = keyed.join(kept, keyed.own_id.eqNullSafe(kept.kept_id) & (keyed.own_hash == kept.kept_hash))
    alike = Window.partitionBy("own_id", "own_hash").orderBy("own_id", "own_hash")
    repeated = joined.where("copies > 1").withColumn("copy", F.row_number().over(alike)).where("copy = 1")
    return joined.where("copies = 1").select("whole.*").unionByName(repeated.select("whole.*"))
