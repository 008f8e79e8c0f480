"""Conversation repair: search against plain enumeration, whole table against a row-by-row version."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tablelearn.llm import queries, repair
from tablelearn.sources.tables import read_table
from tests.conftest import SF001

COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
BLANK, END = re.compile("[^\x20\x09-\x0d]"), re.compile("[.!?][\x20\x09-\x0d]*\\Z")


def legal(roles):
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def brute(rows):
    """rows: (role, text, fault). Uniform-cost search over (cost, audit) with the made roles
    tried freely; returns (cost, audit, repaired lines)."""
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if not any(re.fullmatch(p, roles) for p in ("s?", "s?(ua)*", "s?(ua)*u")):
            continue
        if i == len(rows) and legal(roles):
            return cost, audit, list(lines)
        for made in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", i, roles + made[0], (*lines, made + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + role[:1], (*lines, f"{role}:{text}")))
                for made in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, roles + made[0], (*lines, f"{made}:{text}")))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        fault = ("blank" if not BLANK.search(text) else "duplicate" if (role, text) in seen
                 else None if END.search(text) else "truncated")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def damaged(data):
    out = []
    for c, t, role, text in data:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if k == 3 else 1)
    return out


def expected(data, damage=damaged):
    convs = collections.defaultdict(list)
    for c, *_ in data:
        convs[c] = []
    for c, t, role, text in damage(data):
        convs[c].append((t is not None, t or 0, role, text))
    out = []
    for c, rs in convs.items():
        rs.sort()
        turns = [t for known, t, *_ in rs if known]
        found = faults([(r, x) for *_, r, x in rs])
        cost, audit, lines = brute(found)
        n = collections.Counter(f for *_, f in found)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(150))
def test_search_equals_enumeration(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), f"t{i}",
             rng.choice([None, None, None, "truncated", "duplicate", "blank"])) for i in range(rng.randint(0, 6))]
    code = {None: 0, "truncated": 1, "duplicate": 2, "blank": 3}
    marks = "".join(repair.letter(code[f], repair.initial_of(r)) for r, _, f in rows)
    cost, audit, lines = brute(rows)
    got = repair.search(marks)
    assert (repair.cost(marks, got), got) == (cost, audit)
    _, roles, texts = repair.apply(got, 0, [None] * len(rows), [r for r, *_ in rows], [t for _, t, _ in rows])
    assert [f"{r}:{t}" for r, t in zip(roles, texts)] == lines


def test_hostile_chunks_stay_fast():
    for letters in ("B", "C", "A", "D", "E", "AB", "BC", "HG", "BBC", "GH"):
        assert repair.search((letters * 64)[:64]) is not None
        assert repair.search((letters * 64)[:64], 2, 3) is not None


def test_whole_table(spark):
    data = [tuple(r) for r in read_table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op12_conversation_repair(spark, SF001)) == expected(data)


@pytest.mark.parametrize("chunk_rows,partitions", [(1, 3), (2, 7), (3, 1), (64, 5)])
def test_long_conversations_in_chunks(spark, chunk_rows, partitions):
    rng = random.Random(chunk_rows)
    data = []
    for c in range(6):
        for t in range(rng.randint(1, 14)):
            data.append((c, t // rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "x"]),
                         rng.choice(["a.", "b.", "c", "d!", " ", f"{t}.", f"{t}", f"{t}?"])))
    d = spark.createDataFrame(data, "conv_id int, turn int, role string, text string")
    out = repair.repair(d, chunk_rows=chunk_rows, partitions=partitions)
    assert result(repair.digest(out)) == expected(data, lambda rows: rows)
    lines = collections.defaultdict(list)
    for r in repair.rows(out).orderBy("part", "chunk", "pos").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.digest(out).collect()}
    assert hashes == {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in hashes}


def test_odd_rows_and_names(spark):
    data = [(None, None, None, None), (None, 1, "user", "hi."), (1, None, "user", None), (1, 3, "assistant", "x" * 400_000 + "."),
            (1, 0, None, "é!\t\n"), (2, 0, "user", "a."), (2, 0, "user", "a."), (2, 7, "assistant", "b.\n"), (3, None, "", ""),
            (4, 5, "user", "q?"), (5, 1, "assistant", " "), (6, 2, "system", "s.")]
    d = spark.createDataFrame([(*r, 1, "z") for r in data],
                              "conv_id bigint, turn bigint, role string, text string, part int, marks string")
    assert result(queries.op12_conversation_repair_of(d)) == expected(data)
    assert queries.op12_conversation_repair_of(d.limit(0)).count() == 0
    one = d.where(F.col("conv_id") == 4)
    assert result(queries.op12_conversation_repair_of(one)) == expected([r for r in data if r[0] == 4])
