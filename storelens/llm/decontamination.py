"""Benchmark items in documents, found by pigeonhole pieces and verified by Myers' bit-parallel edit distance.

Texts are compared as lower-case words joined by one space. An item of n characters may differ in
``floor(error_rate * n)`` characters, its budget. Cut into budget + 1 pieces, at least one piece must occur unchanged in
any text within the budget: an automaton finds all pieces of all items in one scan of a document. A hit is verified from
small to large: the pieces are the leaves of a tree whose nodes have one error less than pieces, so that some unchanged
piece lies under nodes that are all within their budgets. The distance of each node around the hit, and at last of the
whole item, is worked out bit-parallel; a chance hit fails at the first small node.

Items are sent to the workers in blocks of at most ``BLOCK_CHARS`` characters, each with a pass over the documents, so
that a larger benchmark needs more passes and not more memory.

Items of fewer than ``least_words`` words have no budget and count only between word borders: ``leaks`` reports them, and
``drop_leaks`` leaves them out, since a line of a few words tells no leak from chance. In scripts written without blanks two
characters count as a word, and a border is not asked for.

Defined results: null and empty documents contain nothing. Null items and items without a letter or digit are nowhere.
Repeated items and documents give a row each.
Empty tables give an empty result. Other columns are not read; ``drop_leaks`` returns all columns, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import packed, text_of

ERROR_RATE = 0.1
LEAST_WORDS = 5
BLOCK_CHARS = 1 << 22
_WORD = re.compile(r"\w+")
# Ranges of scripts written without blanks: Thai to Lao, Burmese, Khmer, kana, ideographs. Fixed values.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_UNSPACED_CHARACTER = re.compile(f"[{_UNSPACED}]")
_SPACED_WORD = re.compile(rf"[^\W{_UNSPACED}]+")


def normal(text: str | None) -> str:
    return " ".join(_WORD.findall((text or "").lower()))


def word_count(item: str) -> int:
    return len(_SPACED_WORD.findall(item)) + len(_UNSPACED_CHARACTER.findall(item)) // 2


def bordered(item: str) -> tuple[int, str]:
    """A short item with a blank at each end that must be a word border, and where the item starts in it, negated."""
    left = "" if _UNSPACED_CHARACTER.match(item[0]) else " "
    right = "" if _UNSPACED_CHARACTER.match(item[-1]) else " "
    return -len(left), left + item + right


def distances(pattern: dict[str, int], size: int, text: str, anchored: bool) -> Iterator[int]:
    """After each character of ``text``, the least edit distance of the pattern to what ends there.

    ``pattern`` has for each character the bits of its places. ``anchored`` distances are to the whole text so far,
    others to the best of its ends.
    """
    mask, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = mask, 0, size
    for character in text:
        equal = pattern.get(character, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(horizontal | plus) & mask)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = ((up << 1) | anchored) & mask
        down = (down << 1) & mask
        plus = down | (~(vertical | up) & mask)
        minus = up & vertical
        yield score


def within(pattern: dict[str, int], size: int, text: str, budget: int) -> bool:
    """Does some part of ``text`` come within ``budget``? Ends as soon as the characters left can't decide it otherwise."""
    left = len(text)
    for score in distances(pattern, size, text, False):
        if score <= budget:
            return True
        left -= 1
        if score - left > budget:
            return False
    return size <= budget


def places(text: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, character in enumerate(text):
        found[character] = found.get(character, 0) | 1 << i
    return found


def best_match(item: str, text: str) -> tuple[int, int, int]:
    """``(distance, start, end)`` of the part of ``text`` nearest to ``item``; the first one, if several are."""
    best, end = len(item), 0
    for at, score in enumerate(distances(places(item), len(item), text, False)):
        if score < best:
            best, end = score, at + 1
    start = end
    for at, score in enumerate(distances(places(item[::-1]), len(item), text[:end][::-1], True)):
        if score == best:
            start = end - at - 1
            break
    return best, start, end


def cut(text: str, count: int) -> list[tuple[int, str]]:
    """``count`` pieces of nearly equal length, with their places."""
    edges = [len(text) * i // count for i in range(count + 1)]
    return [(a, text[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def branches(leaves: int) -> list[list[tuple[int, int]]]:
    """For each leaf of a balanced tree, its inner nodes from the lowest to the root, as first leaf and last + 1."""
    above: list[list[tuple[int, int]]] = [[] for _ in range(leaves)]

    def split(low: int, high: int) -> None:
        if high - low > 1:
            middle = (low + high) // 2
            split(low, middle)
            split(middle, high)
            for leaf in range(low, high):
                above[leaf].append((low, high))

    split(0, leaves)
    return above


@dataclass
class Block:
    """Some items with their budgets, and the automaton over their pieces; built once per task.

    Items of fewer than ``least_words`` words are one piece each, with blanks for their borders.
    """

    items: list[tuple[str, int]]
    least_words: int = 0

    def searcher(self):
        automaton = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int, int]]] = {}
        nodes: list[list[list[tuple[dict[str, int], int, int, int]]]] = []
        for i, (item, budget) in enumerate(self.items):
            parts = cut(item, budget + 1)
            edges = [at for at, _ in parts] + [len(item)]
            made = {}
            if word_count(item) < self.least_words:
                parts = [bordered(item)]
            for leaf, (at, piece) in enumerate(parts):
                pieces.setdefault(piece, []).append((i, leaf, at))
            tree = branches(budget + 1)
            for low, high in {node for above in tree for node in above}:
                part = item[edges[low] : edges[high]]
                made[low, high] = (places(part), len(part), edges[low], high - low - 1)
            nodes.append([[made[node] for node in above] for above in tree])
        for piece, owners in pieces.items():
            automaton.add_word(piece, (len(piece), owners))
        if pieces:
            automaton.make_automaton()

        def verified(text: str, i: int, leaf: int, start: int) -> bool:
            """Is every node above the leaf within its budget, for an item that starts about there?"""
            for pattern, size, at, budget in nodes[i][leaf]:
                left = max(start + at - budget, 0)
                if not within(pattern, size, text[left : start + at + size + budget], budget):
                    return False
            return True

        def search(text: str) -> dict[int, tuple[int, int, int]]:
            """Per item within its budget: distance, start and end in ``text``."""
            if not pieces:
                return {}
            starts: dict[int, set[int]] = {}
            for end, (length, owners) in automaton.iter(f" {text} "):
                for i, leaf, at in owners:
                    start = end - length - at
                    if start not in starts.get(i, ()) and verified(text, i, leaf, start):
                        starts.setdefault(i, set()).add(start)
            found = {}
            for i, guessed in starts.items():
                item, budget = self.items[i]
                best = None
                for low, high in merged(sorted(guessed), 2 * budget):
                    left = max(low - budget, 0)
                    distance, start, end = best_match(item, text[left : high + len(item) + budget])
                    if distance <= budget and (best is None or distance < best[0]):
                        best = (distance, start + left, end + left)
                if best:
                    found[i] = best
            return found

        return search


def merged(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """Runs of starts that are at most ``gap`` apart, as first and last."""
    low = high = starts[0]
    for start in starts[1:]:
        if start - high > gap:
            yield low, high
            low = start
        high = start
    yield low, high


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where characters ``start`` to ``end`` of the normal form come from."""
    at, first, last = 0, None, 0
    for word in _WORD.finditer(text):
        size = len(word[0].lower())
        if first is None and at + size > start:
            first = word.start() + max(start - at, 0)
        if at < end:
            last = word.start() + min(end - at, len(word[0]))
        at += size + 1
    return (len(text) if first is None else min(first, last)), last


def item_blocks(benchmark: DataFrame, error_rate: float, least_words: int, short: bool) -> Iterator[tuple[list, Block]]:
    """Item ids and items, block by block, those of few words if ``short``; only one block is on the driver at a time."""
    items = benchmark.select("item_id", text_of("text").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = [(row.item_id, normal(row.text)) for row in rows]
        rows = [(i, text, int(error_rate * len(text)) if word_count(text) >= least_words else 0) for i, text in rows if text]
        rows = [row for row in rows if short or word_count(row[1]) >= least_words]
        if rows:
            yield [row[0] for row in rows], Block([row[1:] for row in rows], least_words)


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", error_rate: float = ERROR_RATE, least_words: int = LEAST_WORDS
) -> DataFrame:
    """A row per document and item found in it: ``doc_id, item_id, distance, budget, start, stop`` (of the whole text)."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", benchmark.schema["item_id"].dataType)]
        + [T.StructField(name, T.IntegerType()) for name in ("distance", "budget", "start", "stop")]
    )
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for ids, block in item_blocks(benchmark, error_rate, least_words, short=True):
        shared = docs.sparkSession.sparkContext.broadcast((ids, block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, block = shared.value
            search = block.searcher()
            for batch in batches:
                which, rows = [], []
                for row, value in enumerate(batch.column(1)):
                    text = value.as_py() or ""
                    for i, (distance, start, end) in search(normal(text)).items():
                        which.append(row)
                        rows.append((ids[i], distance, block.items[i][1], *original_span(text, start, end)))
                if rows:
                    columns = [pa.array(c) for c in zip(*rows, strict=True)]
                    made = [batch.column(0).take(pa.array(which)), *columns]
                    yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(made, arrow_types, strict=True)], names=schema.names)

        arrow_types = [pa_type(field.dataType) for field in schema]
        found = found.unionByName(narrow.mapInArrow(run, schema))
    return found


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", error_rate: float = ERROR_RATE, least_words: int = LEAST_WORDS
) -> DataFrame:
    """The rows without any benchmark item of ``least_words`` words or more, with all their columns, settled where they are read."""
    frame = packed(docs).select("whole", F.col(f"whole.`{text_col}`").alias("text"))
    schema = frame.schema
    for _, block in item_blocks(benchmark, error_rate, least_words, short=False):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = shared.value.searcher()
            for batch in batches:
                clean = [not search(normal(text.as_py())) for text in batch.column(1)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        frame = frame.mapInArrow(run, schema)
    return frame.select("whole.*")
