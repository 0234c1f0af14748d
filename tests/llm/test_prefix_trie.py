"""Prefix tries against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from storelens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos long, id string, depth int"


def frame(spark, rows):
    """Conversations with columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 7, "i", 3) for r in rows], SCHEMA)


def remainder(a, b):
    return a - int(a / b) * b


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    turns = {c: [t[2] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - remainder(c, 5), [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = own + sum(saved[k] for k in children[node])
    rows = []
    for node, convs_in in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs_in if len(convs[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        rows.append(
            (min(convs_in), len(node), parent, len(convs_in), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=str)


def made(seed, size, ids):
    rng = random.Random(seed)
    rows = []
    for c in ids(size):
        for t in range(rng.choice([1, 2, 3, 5, 9, 12, 14])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é ü", "", None])))
    rng.shuffle(rows)
    return rows


CASES = {
    "few words": made(1, 60, lambda n: range(n)),
    "negative ids": made(2, 40, lambda n: range(-n // 2, n // 2)),
    "gaps": made(3, 40, lambda n: random.Random(3).sample(range(10**6), n)),
    "one text": [(c, t, "user", "same") for c in range(40) for t in range(c % 13)],
    "nulls": [(None, 1, "user", "x"), (5, None, None, None), (5, 2, "user", ""), (5, None, "", ""), (6, 0, "a", None), (6, 0, "b", None), (7, 1, None, "t"), (7, 1, None, "t")],
    "turnless": [(1, 0, "user", "x"), (2, 0, "user", "y")],
    "long": [(c, t, "user", f"{t % 7}") for c in (0, 1, 2, 10, 15) for t in range(200 - c)] + [(3, 0, "user", "z" * 200_000), (4, 0, "user", "z" * 200_000)],
    "hot": [(c, t, "user", "hello") for c in range(300) for t in range(2)] + [(c, 2, "user", str(c % 3)) for c in range(300)],
}


@pytest.mark.parametrize("name", CASES)
def test_trie_equals_brute_force(spark, name, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "JOINED", 7)
    rows = CASES[name]
    got = prefix_trie.rebuilt_trie(frame(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rebuilt(rows))


def test_trie_of_given_turns(spark):
    rows = [(c, t, d, b) for c, path in {1: "abcdeab", 2: "abcde", 3: "abx", 4: ""}.items() for t, (d, b) in enumerate(zip(path, range(1, 20), strict=False))]
    members = spark.createDataFrame([(1,), (2,), (3,), (4,)], "conv_id long")
    got = prefix_trie.trie(spark.createDataFrame(rows, "conv_id long, pos long, digest string, bytes long"), members)
    convs = {c: [(d, "x" * b) for c_, _, d, b in rows if c_ == c] for c in (1, 2, 3, 4)}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(convs)


def test_empty_table(spark):
    assert prefix_trie.rebuilt_trie(frame(spark, [])).collect() == []
    assert prefix_trie.rebuilt_trie(frame(spark, [(None, 1, "user", "x")])).collect() == []
