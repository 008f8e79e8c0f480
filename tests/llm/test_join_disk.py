"""What the n-gram join writes stays in proportion to the documents, and goes early."""

import random
import time

import pytest

from tablelearn.llm import simjoin
from tests.llm.test_llm import docs_of


@pytest.fixture
def steps(monkeypatch):
    """(table, rows of a table of pairs, tables that stand by then) of each written step."""
    seen, real = [], simjoin.Scratch.spill

    def noted(self, df, name):
        out = real(self, df, name)
        pairs = set(out.columns) in ({"a", "b"}, {"hub", "leaf"})
        seen.append((name, out.count() if pairs else 0, {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in self.paths}))
        return out

    monkeypatch.setattr(simjoin.Scratch, "spill", noted)
    return seen


def near_misses(n=24):
    """Texts of 290 shingles each; any two share 266, one less than a link needs."""
    base = [f"b{i}" for i in range(293)]
    rows = []
    for m in range(n):
        w = list(base)
        for e in range(3):
            w[4 * (3 * m + e) + 3] = f"own{m}x{e}"
        rows.append((m, " ".join(w), "s"))
    return rows


def test_close_pairs_of_a_family_stay_in_their_task(spark, steps):
    rows = near_misses()
    linked = rows[5][1].replace("own5x0", "other")  # links with text 5 alone
    out = simjoin.join_components(docs_of(spark, [*rows, (90, linked, "s")]))
    assert {r.doc_id: r.component_id for r in out.collect()} == {**{i: i for i, _, _ in rows}, 90: 5}
    assert "join-members" in {name for name, _, _ in steps}
    assert max(n for _, n, _ in steps) <= 4 * len(rows)  # 276 pairs are close


def test_tables_go_when_no_step_reads_them(spark, steps):
    simjoin.join_components(docs_of(spark, near_misses()))
    at = {name: tables for name, _, tables in steps}
    assert "join-docs" not in at["join-lists"]
    assert not {"join-docs", "join-lists", "join-reps", "join-subsets"} & at["join-sets"]


def test_shuffle_files_go_with_their_query(spark, monkeypatch):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was, on, real = spark.conf.get(key), files(), [], simjoin.Scratch.spill
    monkeypatch.setattr(simjoin.Scratch, "spill", lambda *a: on.append(spark.conf.get(key)) or real(*a))
    simjoin.join_components(docs_of(spark, [(1, "a b c d e", "s"), (2, "a b c d e f", "s")]))
    assert set(on) == {"true"} and spark.conf.get(key) == before
    for _ in range(40):
        if files() <= was:
            break
        time.sleep(0.25)
    assert files() <= was


def test_chance_does_not_connect_families(spark):
    """Sets in a chain of stars are dealt star by star, those with the same pivots together."""
    scratch = simjoin.Scratch(spark)
    chain = [(100 * p + k, 100 * p, 100 * p + k, 100 * p) for p in range(40) for k in range(100)]
    chain += [(100 * p + 1, 100 * p + 100, 100 * p + 1, 100 * p + 100) for p in range(39)]  # one set in the next star too
    same = [(9000 + k, 7000 + p, k, 7000 + p) for p in range(6) for k in range(30)]
    inside = spark.createDataFrame([(r, 50, c, p, h) for r, p, c, h in chain + same],
                                   "rep bigint, n int, component bigint, pivot bigint, theirs bigint")
    patched = pytest.MonkeyPatch()
    with patched.context() as m:
        m.setattr(simjoin, "BLOCK", 16)
        rows = simjoin._members(inside, scratch).groupBy("family").count().collect()
    got = {r.family: r["count"] for r in rows}
    scratch.drop()
    assert sum(1 for f in got if f < 7000) == 40 and max(n for f, n in got.items() if f < 7000) == 101
    assert [n for f, n in got.items() if f >= 7000] == [30]


def test_more_ids_than_are_broadcast(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(None, "a b c d e f", "s"), (3, None, "s"), (4, "", "s")]
    for i in range(120):
        w = [f"f{i % 9}w{k}" for k in range(40)]
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(40)] = f"x{rnd.randrange(9)}"
        rows.append((10 + i, " ".join(w[:rnd.choice([40, 38, 12])]), "s"))
    rows += rows[20:23]
    docs = docs_of(spark, rows)

    def found():
        sets = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in simjoin.join_components(docs).collect())
        return sets, sorted((r.doc_id or 0, r.text or "", r.word) for r in simjoin.keep_one(docs).select(docs.columns).collect())

    want = found()
    monkeypatch.setattr(simjoin, "BROADCAST_IDS", 0)
    assert found() == want
    assert "marked(" in simjoin.keep_one(docs)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(simjoin, "MARK_BITS", 17)  # cells that several ids share
    assert found() == want
