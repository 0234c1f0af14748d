"""Document quality by ordinal regression on graded ratings.

A cumulative-link model: one score per text, from shared weights over hashed words, word beginnings and a few
measures of style, and ordered thresholds that cut it into grades, P(grade >= k) = sigmoid(score - threshold_k). It
gives the expected grade, and the tail probability of the best grade decides what is kept.

The model is fitted on the driver from a bounded sample of the rated documents (``FIT_ROWS``, those with the lowest hash
of their id); all documents are scored on their whole texts. The weights are a fixed table of ``DIMENSIONS`` numbers.

Defined results: a text without a word, null and empty included, has expected grade 0 and is not kept. Ratings with a
null id or null quality are not used; null toxicity counts as none. Without usable ratings every text with a word
is kept. Repeated rows are scored alike. An empty table gives an empty result. Clashing column names don't matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import packed

DIMENSIONS = 1 << 18
FIT_ROWS = 8_000
GRADES = 3  # 0: toxic, 1: poor, 2: good
# A hashed feature in a smaller share of the sample has no weight; two documents at least.
LEAST_SHARE = 0.002
STEPS = 150
FIT_BLOCK = 1 << 19  # features of documents that a step of the fit works on at once
REMEMBERED = 500_000
BEGINNINGS = (4, 5, 6)
# Measures of style are that much larger than the count of a word, and so cost less to use under the penalty.
STYLE_SCALE = 5.0
_MARKS = b".,;:!?*#$%&|()[]{}<>+=/\\-_\"'~^@`"
_UPPER, _MARKED, _BARE = 1, 2, 4
STYLE = ("upper case", "marked words", "bare marks", "same as the one before", "different words", "mean length")


def features(word: bytes) -> tuple[list[int], int]:
    """The hashed features of a word, and flags for its style."""
    core = word.strip(_MARKS)
    plain = core.lower()
    flags = _UPPER * (len(core) > 1 and core.decode(errors="ignore").isupper())
    flags |= _MARKED * (len(word) - len(word.rstrip(_MARKS)) > 1 and bool(core)) | _BARE * (not core)
    if flags & (_MARKED | _BARE):  # what such a word says is its style
        return [], flags
    keys = [plain, *(b"%d " % n + plain[:n] for n in BEGINNINGS if len(plain) >= n)]
    return [zlib.crc32(key) % DIMENSIONS for key in keys], flags


def style(words: list[bytes], counts: Counter, flags: dict[bytes, int]) -> list[float]:
    """Shares of the words, in the order of ``STYLE``."""
    total = len(words)
    upper = marked = bare = size = 0
    for word, n in counts.items():
        f = flags[word]
        size += n * len(word)
        if f:
            upper += n * (f & _UPPER > 0)
            marked += n * (f & _MARKED > 0)
            bare += n * (f & _BARE > 0)
    again = sum(map(bytes.__eq__, words, words[1:]))
    shares = [upper / total, marked / total, bare / total, again / total, len(counts) / total, min(size / total / 10, 3.0)]
    return [share * STYLE_SCALE for share in shares]


class Words(dict):
    """Per word what ``of`` gives, worked out when first asked for."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word: bytes):
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = self.of(word)
        return found


@dataclass
class Model:
    """Weights of hashed features and of style, and the thresholds between the grades."""

    weights: np.ndarray
    styles: np.ndarray
    thresholds: np.ndarray
    fitted: bool = True

    def scorer(self):
        """A function from a text to its score, or None for a text without a word."""
        weights, styles = self.weights, self.styles.tolist()

        def weigh(word: bytes) -> tuple[float, int]:
            keys, flags = features(word)
            return float(weights[keys].sum()), flags

        known = Words(weigh)

        def score(text: str | None) -> float | None:
            words = (text or "").encode().split()
            if not words:
                return None
            counts = Counter(words)
            seen = {word: known[word] for word in counts}
            flags = {word: entry[1] for word, entry in seen.items()}
            total = sum(entry[0] for entry in seen.values())
            return total + sum(w * v for w, v in zip(styles, style(words, counts, flags), strict=True))

        return score

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... per score."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)))


def grade_of(quality: str = "quality", toxic: str = "toxic"):
    return F.when(F.coalesce(F.col(toxic), F.lit(0)) > 0, 0).otherwise(1 + (F.col(quality) > 0).cast("int"))


def rated_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> pa.Table:
    """``grade, keys, style`` of at most ``rows`` rated documents, gathered on the driver."""
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    chosen = rated.select(F.col("doc_id").alias("rated_id"), grade_of().alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("rated_id"), "rated_id", "grade").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(features)
        for batch in batches:
            out = []
            for grade, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode().split()
                if words:
                    counts = Counter(words)
                    seen = {word: known[word] for word in counts}
                    keys = np.array([k for entry in seen.values() for k in entry[0]], "<u4")
                    out.append((grade, keys.tobytes(), style(words, counts, {w: e[1] for w, e in seen.items()})))
            if out:
                grades, keys, styles = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(grades, pa.int32()), pa.array(keys, pa.binary()), pa.array(styles, pa.list_(pa.float64()))], ["grade", "keys", "style"])

    texts = docs.select(F.col(id_col).alias("own_id"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(chosen), F.col("own_id") == F.col("rated_id"))
    return joined.select("grade", "text").mapInArrow(run, "grade int, keys binary, style array<double>").toArrow()


def known_features(keys: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The features with a weight, and per document, from ``starts[i]`` on, their places among these and their counts."""
    documents = np.zeros(DIMENSIONS, np.int64)
    for own in keys:
        documents[np.unique(np.frombuffer(own.as_py(), "<u4"))] += 1
    used = np.flatnonzero(documents >= max(2, LEAST_SHARE * len(keys)))
    place = np.full(DIMENSIONS, -1, np.int32)
    place[used] = np.arange(len(used))
    starts = np.zeros(len(keys) + 1, np.int64)
    column, value = np.empty(documents[used].sum(), np.int32), np.empty(documents[used].sum(), np.float32)
    for i, own in enumerate(keys):
        key, n = np.unique(np.frombuffer(own.as_py(), "<u4"), return_counts=True)
        known = place[key] >= 0
        starts[i + 1] = starts[i] + np.count_nonzero(known)
        column[starts[i] : starts[i + 1]] = place[key[known]]
        value[starts[i] : starts[i + 1]] = n[known]
    return used, starts, column, value


def fit(sample: pa.Table, steps: int = STEPS, penalty: float = 1e-3, rate: float = 0.1) -> Model:
    """Maximum likelihood by Adam over the whole sample, with an L2 penalty; the same sample gives the same model."""
    thresholds = np.linspace(-1.0, 1.0, GRADES - 1)
    if not sample.num_rows:
        return Model(np.zeros(DIMENSIONS), np.zeros(len(STYLE)), np.full(GRADES - 1, -60.0), fitted=False)
    grade = sample.column("grade").to_numpy()
    styles = np.array(sample.column("style").to_pylist(), np.float64)
    used, starts, column, value = known_features(sample.column("keys"))
    sizes = np.diff(starts)
    edges = np.unique(np.concatenate([[0], np.searchsorted(starts, np.arange(0, len(column), FIT_BLOCK)), [len(grade)]])).tolist()
    blocks = [(low, high, slice(starts[low], starts[high])) for low, high in zip(edges, edges[1:], strict=False)]

    weights = np.zeros(len(used) + len(STYLE) + GRADES - 1)
    cuts = slice(len(used) + len(STYLE), None)
    weights[cuts] = thresholds
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    importance = np.where(grade == 0, 2.0, 1.0) / len(grade)
    for step in range(1, steps + 1):
        w, v, cut = weights[: len(used)], weights[len(used) : len(used) + len(STYLE)], np.sort(weights[cuts])
        score = styles @ v
        for low, high, entries in blocks:
            sums = np.add.reduceat(np.append(w[column[entries]] * value[entries], 0.0), starts[low:high] - starts[low])
            score[low:high] += np.where(sizes[low:high] > 0, sums, 0.0)
        lower = np.concatenate([[-np.inf], cut])[grade]
        upper = np.concatenate([cut, [np.inf]])[grade]
        above_low = 1 / (1 + np.exp(-np.clip(score - lower, -50, 50)))
        above_high = 1 / (1 + np.exp(-np.clip(score - upper, -50, 50)))
        chance = np.maximum(above_low - above_high, 1e-12)
        slope = importance * (1 - above_low - above_high)
        gradient = np.zeros_like(weights)
        for low, high, entries in blocks:
            each = np.repeat(slope[low:high], sizes[low:high]) * value[entries]
            gradient[: len(used)] += np.bincount(column[entries], each, minlength=len(used))
        gradient[len(used) : len(used) + len(STYLE)] = styles.T @ slope
        for k in range(GRADES - 1):
            at_low, at_high = grade == k + 1, grade == k
            gradient[len(used) + len(STYLE) + k] = np.sum(importance[at_high] * (above_high * (1 - above_high) / chance)[at_high]) - np.sum(
                importance[at_low] * (above_low * (1 - above_low) / chance)[at_low]
            )
        gradient[: len(used)] -= penalty * w
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    table = np.zeros(DIMENSIONS)
    table[used] = weights[: len(used)]
    return Model(table, weights[len(used) : len(used) + len(STYLE)].copy(), np.sort(weights[cuts]))


def fitted_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    return fit(rated_sample(docs, labels, rows, id_col, text_col))


def scored(frame: DataFrame, text_col: str, model: Model, least_tail: float) -> DataFrame:
    """``frame`` with ``expected_grade``, ``tail_1`` ... and ``kept`` after its columns, in place where it is read."""
    names = ["expected_grade", *(f"tail_{k}" for k in range(1, GRADES))]
    schema = T.StructType([*frame.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names), T.StructField("kept", T.BooleanType())])
    shared = frame.sparkSession.sparkContext.broadcast(model)
    place = frame.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        score = own.scorer()
        for batch in batches:
            found = [score(text.as_py()) for text in batch.column(place)]
            words = np.array([s is not None for s in found], bool)
            tails = own.tails(np.array([s or 0.0 for s in found])) * words[:, None]
            kept = words & ((tails[:, -1] >= least_tail) | (not own.fitted))
            added = [pa.array(tails.sum(axis=1)), *(pa.array(tails[:, k]) for k in range(GRADES - 1)), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return frame.mapInArrow(run, schema)


def graded(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS, least_tail: float = 0.5) -> DataFrame:
    """Per row: ``doc_id, expected_grade, tail_1, tail_2, kept``."""
    model = fitted_model(docs, labels, rows, id_col, text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return scored(narrow, "text", model, least_tail).drop("text")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS, least_tail: float = 0.5) -> DataFrame:
    """The rows that are kept, with all their columns."""
    model = fitted_model(docs, labels, rows, id_col, text_col)
    frame = packed(docs).select("whole", F.col(f"whole.`{text_col}`").alias("text"))
    return scored(frame, "text", model, least_tail).where("kept").select("whole.*")
