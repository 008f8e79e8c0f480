"""Prefix trie of conversations against a plain recursive trie."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tablelearn.llm import queries, trie
from tablelearn.sources.tables import read_table
from tests.conftest import SF001

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(seqs):
    """seqs: conv_id -> list of (key, chars)."""
    members = collections.defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = collections.defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids[p]]
        saved = (len(members[p]) - 1) * (p[-1][1] if p else 0)
        totals[p] = (sum(a for a, _ in below) if below else 1, saved + sum(b for _, b in below))
    out = []
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(seqs[c]) == len(p)))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(kids[p]), *totals[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def frame(spark, seqs):
    data = [(c, [(k.encode().ljust(16), n) for k, n in s]) for c, s in seqs.items()]
    return spark.createDataFrame(data, "conv_id bigint, seq array<struct<key: binary, chars: bigint>>")


@pytest.mark.parametrize("seed,partitions", [(0, 1), (1, 2), (2, 5), (3, 9), (4, 16), (5, 7)])
def test_equals_plain_trie(spark, seed, partitions):
    rng = random.Random(seed)
    seqs = {}
    for c in range(rng.randint(1, 120)):
        n = rng.choice([0, 1, 2, 3, 5, 9])
        seqs[c * 7 - 50] = [(rng.choice("aabc"), 3 + (i % 2)) for i in range(n)] if rng.random() < .7 else [("a", 3), ("b", 4)]
    # equal keys have equal sizes
    seqs = {c: [(k, ord(k) % 7) for k, _ in s] for c, s in seqs.items()}
    assert rows(trie.trie(frame(spark, seqs), partitions)) == brute(seqs)


def test_one_conversation_and_copies_over_many_tasks(spark):
    one = {5: [("a", 1), ("b", 2)]}
    assert rows(trie.trie(frame(spark, one), 4)) == brute(one)
    copies = {c: [("a", 1), ("b", 2)] for c in range(200)} | {1000: [("a", 1)], 1001: []}
    assert rows(trie.trie(frame(spark, copies), 11)) == brute(copies)
    deep = {c: [("x", 2)] * (300 + c % 3) for c in range(20)}
    assert rows(trie.trie(frame(spark, deep), 3)) == brute(deep)


def rebuilt(data):
    own = collections.defaultdict(list)
    for c, t, role, text in data:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = own.get(c - c % 100, [])[:h] + mine[h:]
        out[c] = [((r, x), len(x)) for r, x in seq]
    return out


def test_whole_table(spark):
    data = [tuple(r) for r in read_table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows(queries.op13_conversation_trie_of(read_table(spark, SF001, "conversations"))) == brute(rebuilt(data))
    assert queries.op13_conversation_trie(spark, SF001).count() == len(brute(rebuilt(data)))


def test_odd_rows_and_names(spark):
    data = [(0, 0, "user", "é" * 5), (0, None, None, None), (0, 1, "a", "x" * 300000), (0, 1, "a", "x" * 300000),
            (1, 1, "user", ""), (2, 0, "user", None), (2, 0, None, "user"), (None, 0, "user", "lost"), (250, 3, "user", "t"),
            *[(7, i, "user", "k") for i in range(9)], *[(8, i, "user", "k") for i in range(9)]]
    d = spark.createDataFrame([(*r, 1, "z") for r in data],
                              "conv_id bigint, turn bigint, role string, text string, base int, depth string")
    assert rows(queries.op13_conversation_trie_of(d)) == brute(rebuilt(data))
    assert queries.op13_conversation_trie_of(d.limit(0)).count() == 0
    assert trie.turns(d).where(F.col("conv_id").isNull()).count() == 0
