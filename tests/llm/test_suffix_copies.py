"""Repeated byte strings against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from storelens.llm import suffix_copies

SCHEMA = "doc_id long, text string, a long, hash string, spans int, first string"


def frame(spark, rows, parts=3):
    """Documents with columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, 1, "h", 2, "f") for i, t in rows], SCHEMA).repartition(parts)


def brute(rows, length, mode):
    """Per row in the order of id and text: id, bytes, removed runs, bytes left."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    places = defaultdict(list)
    for row, (_, text) in enumerate(texts):
        for at in range(len(text) - length + 1):
            places[text[at : at + length]].append((row, at))
    order = suffix_order_of(texts)
    out = []
    for row, (i, text) in enumerate(texts):
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            same = places[text[at : at + length]]
            first = min((order[r], p) for r, p in same)
            if len(same) > 1 and (mode == "every" or (order[row], at) != first):
                gone[at : at + length] = b"\1" * length
        runs, start = [], None
        for at, flag in enumerate([*gone, 0]):
            if flag and start is None:
                start = at
            elif not flag and start is not None:
                runs.append((start, at - start))
                start = None
        out.append((i, len(text), sum(gone), runs, bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return sorted(out, key=str)


def suffix_order_of(texts):
    """Rows with equal id and text have one place; between texts of one id any order that is the same everywhere will do."""
    names = sorted({(-(1 << 63) if i is None else i, t) for i, t in texts})
    return [names.index((-(1 << 63) if i is None else i, t)) for i, t in texts]


def corpus(seed, many=25, words=6):
    rng = random.Random(seed)
    vocabulary = ["alpha", "ba", "é", "delta", "日本", "z"][:words]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(many)]
    rows = list(enumerate(texts))
    passage = "x" + "".join(rng.choice("abcdefgh") for _ in range(70)) + "y"
    rows += [(100 + i, f"{texts[i]}{passage}{texts[i + 1]}") for i in range(6)]
    rows += [(200 + i, texts[3]) for i in range(10)]
    return rows


CASES = {
    "plain": corpus(1),
    "two words": corpus(2, words=2),
    "runs": [(1, "a" * 90), (2, "a" * 41), (3, "a" * 30 + "b" + "a" * 39), (4, "ab" * 60)],
    "odd rows": [(None, "q" * 3), (None, None), (1, None), (1, ""), (2, "short"), (3, "s" * 12 + "t" * 30), (3, "s" * 12 + "t" * 30), (None, "t" * 30 + "u")],
    "long": [(1, "".join(random.Random(5).choice("ab") for _ in range(3000))), (2, "".join(random.Random(6).choice("ab") for _ in range(3000)))],
}


def collected(got):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.removed], bytes(r.kept)) for r in got.collect()), key=str)


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("mode", ["every", "later"])
def test_equals_brute_force(spark, name, mode, monkeypatch):
    monkeypatch.setattr(suffix_copies, "SHARD_BYTES", 2000)
    got = suffix_copies.kept_bytes(frame(spark, CASES[name]), length=24, part=5, mode=mode)
    assert collected(got) == brute(CASES[name], 24, mode)


@pytest.mark.parametrize("mode", ["every", "later"])
def test_hot_anchors(spark, mode, monkeypatch):
    monkeypatch.setattr(suffix_copies, "HOT_ROWS", 3)
    monkeypatch.setattr(suffix_copies, "BLOCK_BYTES", 50)
    passage = "common passage of some forty characters, here"
    rows = [(i, f"{random.Random(i).random()}{passage}{random.Random(-i).random()}") for i in range(60)] + corpus(4)
    got = suffix_copies.kept_bytes(frame(spark, rows, parts=8), length=24, part=5, mode=mode)
    assert collected(got) == brute(rows, 24, mode)


def test_contract_length(spark):
    rows = [(1, "v" + "k" * 199), (2, "w" + "k" * 199), (3, "a" * 200 + "b"), (4, "c" + "a" * 200), (5, "".join(map(str, range(90)))), (6, "".join(map(str, range(89))))]
    assert collected(suffix_copies.kept_bytes(frame(spark, rows))) == brute(rows, 200, "every")


def test_empty_table(spark):
    assert suffix_copies.kept_bytes(frame(spark, [])).collect() == []


@pytest.mark.parametrize("length", [1, 4, 5, 9, 40, 200])
def test_suffix_order_and_previous_factors(length):
    rng = np.random.default_rng(length)
    text = np.concatenate([rng.integers(97, 99, 700), np.full(300, 97)]).astype(np.uint8)
    left = len(text) - np.arange(len(text))
    order, new = suffix_copies.suffix_order(text, left, length)
    raw = text.tobytes()
    expected = sorted(range(len(raw) - length + 1), key=lambda i: (raw[i : i + length], i))
    assert order.tolist() == expected
    strings = [raw[i : i + length] for i in expected]
    assert new.tolist() == [i == 0 or strings[i] != strings[i - 1] for i in range(len(strings))]
    position = rng.permutation(len(text))
    before, after = suffix_copies.previous_factors(order, new, position)
    for i in range(len(order)):
        left_of = [j for j in range(i) if strings[j] == strings[i] and position[order[j]] < position[order[i]]]
        right_of = [j for j in range(i + 1, len(order)) if strings[j] == strings[i] and position[order[j]] < position[order[i]]]
        assert before[i] == (left_of[-1] if left_of else -1)
        assert after[i] == (right_of[0] if right_of else -1)


def test_ranks_too_wide_to_pack():
    text = np.tile(np.frombuffer(b"abcdefghij", np.uint8), 250_000)
    left = len(text) - np.arange(len(text))
    order, new = suffix_copies.suffix_order(text, left, 12)
    assert new.sum() == 10 and (text[order[1:]].astype(int) >= text[order[:-1]]).all()
