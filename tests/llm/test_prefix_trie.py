"""The trie of rebuilt conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from subscore.llm import prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string"


def _reference(role, text):
    digest = hashlib.sha256(f"{len(role)} {role} {text}".encode()).hexdigest()
    signed = [int(digest[k : k + 16], 16) for k in range(0, 64, 16)]
    return [x - 2**64 if x >= 2**63 else x for x in signed]


def _trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0, role, _reference(role, text)), (role, text)))
    turns = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    saved, leaves, kids = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, ms in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(ms) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:d]] += not kids.get(path, 0)
    out = []
    for path, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(rebuilt[c]) == len(path))))
        out.append((min(ms), len(path), min(members[path[:-1]]) if path else None, len(ms), kids.get(path, 0), leaves[path],
                    saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _conversations(seed=1):
    rng = random.Random(seed)
    said = ["hello", "Hello", "", "ünï ☃", "tell me more", None, "a b", "ab"]
    rows = []
    for c in [*range(-12, 40), 1000, 1003, 7_000_000_000_001, 7_000_000_000_004]:
        if c % 10 == 0 and c % 20:
            continue  # some bases are absent
        turns = [(k, ("user", "assistant")[k % 2], rng.choice(said[:3])) for k in range(rng.randrange(1, 14))]
        if c % 7 == 0:  # copies
            turns = [(k, "user", "the same") for k in range(12)]
        if c % 11 == 0:  # turns without a number, ties, repeated rows, no role
            turns += [(None, None, "first"), (None, "user", None), (3, "user", "tie"), (3, "user", "another"), turns[0]]
        rows += [(c, *t) for t in turns]
    rows += [(36, k, "user", f"long {k % 7}") for k in range(60)] + [(37, k, "user", f"long {k % 7}") for k in range(55)]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def _same(spark, rows, found=None):
    conversations = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' depth", "1 n", "2 pos", "3 f0", "4 owner").repartition(3)
    got = found or prefix_trie.prefix_trie(conversations)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, _trie(rows)))


def test_trie_equals_brute_force(spark):
    _same(spark, _conversations())


def test_no_group_needs_to_be_in_one_task(spark, monkeypatch):
    """Blocks of four turns, and every node with more than two prefixes counts as hot."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "HOT", 2)
    _same(spark, _conversations(2))


def test_equal_fingerprints_of_different_turns_are_found_and_made_anew(spark, monkeypatch):
    """With x = 1 the order of turns doesn't count."""
    tried, bases = [], prefix_trie.bases

    def weak(attempt):
        tried.append(attempt)
        return [1, 1, 1] if attempt == 0 else bases(attempt)

    monkeypatch.setattr(prefix_trie, "bases", weak)
    rows = [(0, 0, "user", "a"), (0, 1, "user", "b"), (5, 0, "user", "b"), (5, 1, "user", "a"), (5, 2, "user", "c")]
    _same(spark, rows)
    assert tried == [0, 1]


def test_ends_of_one_node_in_many_pieces(spark):
    rows = [(c * 5, 0, "user", "hi") for c in range(300)] + [(c * 5 - 3000, 0, "user", "x") for c in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        _same(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversations(spark, rows):
    assert prefix_trie.prefix_trie(spark.createDataFrame(rows, COLUMNS)).collect() == []


def test_fingerprints_compose():
    rng = random.Random(4)
    for p, x in zip(prefix_trie.PRIMES, prefix_trie.bases(0)):
        t = [rng.randrange(p) for _ in range(20)]
        power = prefix_trie.powers(x, p, prefix_trie.np.arange(40)).tolist()
        assert power == [pow(x, k, p) for k in range(40)]

        def h(s, p=p, x=x):
            return sum(v * pow(x, k, p) for k, v in enumerate(s)) % p

        assert h(t) == (h(t[:7]) + power[7] * h(t[7:])) % p
        assert all(p % d for d in range(2, int(p**0.5) + 1))
