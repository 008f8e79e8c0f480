"""Training-data operators: boundary cases, brute force, round trips, held-out quality."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablelearn.llm import (brown, decontaminate, htmltree, linededup, mixing, pii, quality, queries, simjoin,
                            toxicity, warc)
from tests.conftest import SF001

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, word string, rep bigint, n int"
PROSE = "The quick brown fox jumps over the lazy dog near the river bank today. "


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, 2) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, white space, a very long text, ties and repeated rows, plus columns
    whose names operators use themselves."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    return docs_of(spark, [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (None, PROSE * 8, "a"), (5, long, "b"),
                           (6, PROSE * 8, "b"), (6, PROSE * 8, "b"), (7, PROSE * 8, None), (8, "one two", "b")]).cache()


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))


@pytest.mark.parametrize("name", ["op4_quality_rules", "op6_mixing_weights", "op7_line_dedup"])
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    out = queries.QUERIES[name](spark, SF001)
    cols = sorted(out.columns)
    rel = con.sql(queries.ORACLES[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(tuple(r[c] for c in cols) for r in out.collect()) == sorted(tuple(r[i] for i in at) for r in rel.fetchall())


def test_odd_rows_everywhere(spark, odd):
    bench = spark.createDataFrame([(1, PROSE), (2, None), (3, "")], "item_id bigint, text string")
    labels = spark.createDataFrame([(6, 1), (6, 1), (8, 0), (None, 1), (5, None)], "doc_id bigint, toxic int")
    n = odd.count()
    q = {r.doc_id: r for r in quality.score_documents(odd).collect()}
    assert q[1].n_words == 0 and q[1].base_failed and not q[1].kept and q[6].n_words == 112
    assert quality.clean_documents(odd).columns == odd.columns
    dropped = linededup.drop_boilerplate(odd)
    assert dropped.count() == n and dropped.columns == odd.columns
    found = pii.digest(pii.find(odd)).collect()
    assert len(found) == n and {r.base_sha256 for r in found} == {pii.sha256_of([])}
    leaks = decontaminate.find_leaks(odd, bench).collect()
    assert sorted(str(r.doc_id) for r in leaks) == ["6", "6", "7", "None"] and {r.item_id for r in leaks} == {1}
    assert decontaminate.drop_leaked(odd, bench).where("doc_id in (6, 7)").count() == 0
    mixed = mixing.mix(odd).collect()
    assert len(mixed) == n and all(0 <= r.mix.probability <= 1 for r in mixed)
    tox = toxicity.score(odd, toxicity.train(odd, labels)).collect()
    assert len(tox) == n and all(0 <= r.score <= 1 for r in tox)
    model, vocab = brown.train(odd)
    lm = {r.doc_id: r for r in brown.score(odd, model, vocab).collect()}
    assert lm[1].n_tokens == lm[3].n_tokens == 1 and lm[6].n_tokens == 226  # the repeated rows add up
    comp = {r.doc_id: r for r in simjoin.join_components(odd).collect()}
    assert len(comp) == 8 and comp[7].component_id == 6 and comp[None].component_id is None
    assert comp[2].component_id == 2 and comp[2].n_shingles == 0 and comp[8].n_shingles == 1


def test_empty_tables(spark):
    none = docs_of(spark, [(1, "x", "a")]).where("doc_id = 0")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    model, vocab = brown.train(none)
    for df in (quality.score_documents(none), linededup.drop_boilerplate(none), pii.find(none), mixing.mix(none),
               decontaminate.find_leaks(none, bench), toxicity.score(none, toxicity.train(none, labels)),
               brown.score(none, model, vocab), simjoin.join_components(none), warc.round_trip(pages),
               htmltree.extract(pages)):
        assert df.count() == 0


def test_base_spans_follow_the_patterns():
    rnd = random.Random(3)
    for _ in range(3000):
        t = "".join(rnd.choice("ab1.@-+ (_2%5") for _ in range(rnd.randint(0, 40)))
        emails = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        ips = [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
               if all(int(p) <= 255 for p in m[0].split("."))]
        got = pii.base_spans(t)
        assert [s for s in got if s[0] == "email"] == emails and [s for s in got if s[0] == "ip"] == ips
    card = "4111 1111 1111 1111"
    assert pii.base_spans(f"x {card}, +1 (523) 555-1055.") == [("card", 2, 21), ("phone", 23, 40)]
    assert pii.base_spans("4111 1111 1111 1112") == []


def test_field_decodes_jointly_and_adds_unknown_formats():
    rnd = random.Random(5)
    chunks = []
    for i in range(150):
        p = f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
        chunks += [f"call {p} now", f"on 2019-{rnd.randint(10, 12)}-{rnd.randint(10, 28)} at", f"no {rnd.randint(10**6, 10**7)} x",
                   f"mail u{i}@mail{i % 9}.example.com or"]
    field = pii.SemiMarkov().fit(pii.training_samples(chunks))
    t = "ring (523) 555-1055 or bob[at]mail.example.com by 2019-11-12"
    assert pii.all_spans(t, pii.base_spans(t), field) == [("email", 23, 46), ("phone", 5, 19)]
    # the decoder is the maximum over all segmentations
    win = (0, 14)
    text = "(523) 555-1055"
    cut, ends = field.lattice(text, win)

    def best(j):
        if j == 0:
            return [(0.0, "O")]
        out = [(s, "O") for s, _ in best(j - 1)]
        for i, f in ends[j]:
            out += [(s + field.score(k, f, p if p != "O" else ""), k) for s, p in best(i) for k in pii.KINDS]
        return [max(out)]

    top = field.decode(text, win)
    assert top == [("phone", 0, 14)] and best(len(cut) - 1)[0][1] == "phone"


def test_align_equals_textbook():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a, b = rnd.integers(0, 4, rnd.integers(1, 8)), rnd.integers(0, 4, rnd.integers(1, 10))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontaminate.align(a, b)[0] == h.max()


def test_edited_leaks_are_found(spark):
    rnd = random.Random(2)
    vocab = [f"{a}{b}{c}" for a in "bdkl" for b in "aeiou" for c in "mnrstvz"]
    items = [(i, " ".join(rnd.choices(vocab, k=40))) for i in range(30)]
    rows, want = [], set()
    for i, t in items:
        w = t.split()
        for k in range(0, 40, 9):
            w[k] = "Changed,"
        rows.append((100 + i, " ".join(rnd.choices(vocab, k=60) + w[:20] + ["added"] + w[20:] + rnd.choices(vocab, k=60)), "s"))
        want.add((100 + i, i))
    rows += [(500 + i, " ".join(rnd.choices(vocab, k=200)), "s") for i in range(60)]
    got = decontaminate.find_leaks(docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_leaks_equal_brute_force_alignment(spark):
    """Every 4th, 5th and 6th word changed, alone and beside exact copies, short items too."""
    rnd = random.Random(3)
    vocab = [f"{a}{b}{c}" for a in "bdkl" for b in "aeiou" for c in "mnrstvz"]
    sizes = [40] * 12 + [3, 4, 5, 6, 8, 10, 12, 15]
    items = [(i, " ".join(rnd.choices(vocab, k=n))) for i, n in enumerate(sizes)]
    rows = []
    for i, t in items:
        for every in (4, 5, 6):
            w = [f"new{k}" if k % every == every // 2 else x for k, x in enumerate(t.split())]
            rows.append((1000 * every + i, " ".join(rnd.choices(vocab, k=50) + w + rnd.choices(vocab, k=50)), "s"))
        rows += [(10000 + 100 * k + i, " ".join(rnd.choices(vocab, k=9)) + " " + t, "s") for k in range(3 * (i % 2))]
    number = {}
    ids = lambda t: np.array([number.setdefault(w, len(number)) for w in t.split()])
    want = {(d, i): round(s, 6) for d, text, _ in rows for i, t in items
            if (s := decontaminate.align(ids(t), ids(text))[0] / (2 * len(t.split()))) >= 0.6}
    assert all((1000 * e + i, i) in want for e in (4, 5, 6) for i in range(12))
    got = decontaminate.find_leaks(docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id): r.score for r in got.collect()} == want


def test_simjoin_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simjoin, "BLOCK", 8)  # several blocks a family
    rnd = random.Random(4)
    base = [[f"t{g}_{i}" for i in range(60)] for g in range(4)]
    rows = []
    for i in range(240):
        w = list(base[i % 4])
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 3)}"
        rows.append((i, " ".join(w[:rnd.choice([60, 60, 58, 9, 8, 24])]), "s"))
    rows += [(1000 + i, " ".join(f"u{i}_{k}" for k in range(40)) + " " + " ".join(base[0][:20]), "s") for i in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in simjoin.join_components(docs_of(spark, rows)).collect()}
    sets = {i: frozenset(zip(*[words(t)[k:] for k in range(4)])) for i, t, _ in rows}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    assert got == {i: (len(s), top(i)) for i, s in sets.items()}


def test_brown_base_and_model(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    text = {r.doc_id: words(r.text) for r in docs.select("doc_id", "text").collect()}
    c, ends = collections.Counter(), 0
    for i, w in text.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(w)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    model, vocab = brown.train(docs)
    # transitions and emissions are probabilities
    assert np.allclose((10.0 ** model.step).sum(1), 1.0)
    mass = collections.defaultdict(float)
    for w, k in c.items():
        mass[int(model.cls[model.unit_of(w.encode())])] += 10 ** model.emit(w.encode(), k)
    for k, m in mass.items():
        assert abs(m + 10 ** model.unk[k] - 1) < 1e-9
    for r in brown.score(docs, model, vocab).collect():
        w = text[r.doc_id]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        cls = [0] + [int(model.cls[model.unit_of(x.encode())]) for x in w] + [0]
        own = sum(model.step[a, b] for a, b in zip(cls, cls[1:])) + sum(model.emit(x.encode(), c[x]) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, n)
        assert abs(r.base_score - base) < 1e-6 and abs(r.score - own) < 1e-6


def test_exchange_separates_languages():
    counts = np.zeros((9, 9))
    for a, b in itertools.product(range(1, 5), range(1, 5)):
        counts[a, b] = counts[a + 4, b + 4] = 10
    counts[0, 1:] = counts[1:, 0] = 1
    cls = brown.exchange(counts, classes=2)
    assert cls[0] == 0 and len(set(cls[1:5])) == len(set(cls[5:])) == 1 and cls[1] != cls[5]


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/1", "<p>é</p>"), (1, "http://a/2", "<p>é</p>"), (2, None, None), (9, "u", ""),
            (None, "v", "<p>é</p>"), (1, "http://a/2", "<p>é</p>"), (5, "w", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    out = warc.round_trip(pages, str(tmp_path)).collect()
    digest = base64.b32encode(hashlib.sha1("<p>é</p>".encode()).digest()).decode()
    same = [r for r in out if r.payload_digest == digest]
    assert len(out) == 7 and len(same) == 4 and {r.payload_bytes for r in same} == {9}
    assert [r.page_id for r in same if r.record_type == "response"] == [1]
    assert {r.refers_to for r in same if r.record_type == "revisit"} == {1}
    assert {r.page_id: r.refers_to for r in out if r.payload_bytes == 0} == {2: None, 9: 2}
    assert [r.html for r in out if r.page_id == 5] == ["x" * 300_000]


def test_raking_meets_targets_on_both_paths(spark):
    rnd = random.Random(9)
    rows = [(i, PROSE * rnd.randint(1, 90), "en") for i in range(300)]
    df = docs_of(spark, [(i, t, f"s{min(3, i % 7)}") for i, t, _ in rows]).withColumn(
        "lang", F.when(F.col("doc_id") % 3 == 0, "fr").otherwise("en"))
    want = {"source": {"s0": 0.25, "s1": 0.25, "s2": 0.25, "s3": 0.25}, "lang": {"en": 0.5, "fr": 0.5}}
    got = mixing.mix(df, want).select("source", "lang", "mix.*").collect()
    total = sum(r.tokens * r.weight for r in got)
    for key, goal in want.items():
        for value, share in goal.items():
            assert abs(sum(r.tokens * r.weight for r in got if r[key] == value) / total - share) < 1e-6
    cells = df.select("source", "lang", mixing.topic(F.col("text")).alias("topic"),
                      mixing.n_tokens(F.col("text")).alias("t")).groupBy("source", "lang", "topic").agg(F.sum("t").alias("mass"))
    a = {tuple(r)[:3]: r.f for r in mixing.cell_factors(cells, want, rounds=3)[0].collect()}
    b = {tuple(r)[:3]: r.f for r in mixing.cell_factors(cells, want, rounds=3, max_local=0)[0].collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_raking_goes_on_until_the_targets_are_met(spark):
    """One empty cell and targets close to what it allows: slow, but they can be met. Beyond
    that they cannot, and the distance is reported."""
    mass, codes = np.array([1000.0, 1000.0, 1000.0]), [np.array([0, 0, 1]), np.array([0, 1, 1])]
    goals = [np.array([0.41, 0.59]), np.array([0.4, 0.6])]
    f = mixing.rake_local(mass, codes, goals)
    for code, t in zip(codes, goals):
        assert np.abs(np.bincount(code, mass * f) / mass.sum() - t).max() < 1e-9
    with pytest.warns(UserWarning, match="from its target"):
        mixing.rake_local(mass, codes, [np.array([0.2, 0.8]), np.array([0.4, 0.6])])
    cells = spark.createDataFrame([("a", "en", "x", 4), ("a", "fr", "x", 2), ("b", "en", "x", 6), ("b", "fr", "x", 3)],
                                  "source string, lang string, topic string, mass bigint")
    want = {"source": {"a": 0.6, "b": 0.4}, "lang": {"en": 0.5, "fr": 0.5}}
    out = [{tuple(r)[:3]: r.f for r in mixing.cell_factors(cells, want, max_local=n)[0].collect()} for n in (0, 9)]
    assert all(abs(out[0][k] - out[1][k]) < 1e-9 for k in out[1])


def test_style_tree_cuts_templates(spark):
    html = "<body><div class='t{i}'>Welcome to our site</div><div>{body}</div><nav>menu</nav></body>"
    rows = [(i, "http://H.org:80/x", html.format(i=i, body=f"<p>Story {i} of the day&amp;night<br>goes on<p>End {i}")) for i in range(20)]
    rows += [(100, None, None), (101, "http://one.org/", "<main><h1>T</h1> a <b>b</main><form>f</form>tail"), (102, "http://x/", "a < b <i>c")]
    out = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert out[4] == "Story 4 of the day&night goes on\n\nEnd 4"
    assert (out[100], out[101], out[102]) == ("", "T\n\na b", "a < b c")


def test_style_tree_decides_inside_and_beside_the_article(spark):
    """Template inside <article>/<main> goes, as an element of its own and as one of many
    paragraphs; body text beside the element stays, template beside it goes."""
    def page(tag, i):
        return (f"<body><div class='lead'>Top</div><{tag}><p>Story {i} is told here</p><div class='box'><p>Read our offers</p>"
                f"</div><p>All rights kept by us</p><p>It ends with {i}</p><div><b>By us</b></div></{tag}>"
                f"<div class='rest'><p>Part two of {i}</p><p>Call now</p></div></body>")
    rows = [(i, "http://a.org/", page("article", i)) for i in range(20)]
    rows += [(100 + i, "http://b.org/", page("main", i)) for i in range(3)] + [(200, "http://c.org/", page("main", 0))]
    out = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(out[i] == f"Story {i} is told here\n\nIt ends with {i}\n\nPart two of {i}" for i in range(20))
    # three pages: nothing inside the element is cut yet, beside it only the text that differs stays
    assert out[101].startswith("Story 1 is told here\n\nRead our offers") and out[101].endswith("By us\n\nPart two of 1")
    # one page: the element decides
    assert "Part two" not in out[200] and "Read our offers" in out[200]


def test_machine_learns_an_interaction():
    """Toxic only where an insult meets a group mention; no additive weight can do that."""
    rnd = random.Random(1)
    rows, y = [], []
    for _ in range(2000):
        x = [t for t in range(6) if rnd.random() < 0.5]
        rows.append(x)
        y.append(int((0 in x) == (1 in x)))
    fm = toxicity.FactorizationMachine(list(range(6))).fit(rows[:1500], y[:1500], epochs=30)
    assert np.mean([(fm.logit(x) > 0) == t for x, t in zip(rows[1500:], y[1500:])]) > 0.95


def test_toxicity_held_out_quality(spark):
    sf = SF001.replace("0.001", "0.01")
    out = queries.QUERIES["op10_toxicity_fm"](spark, sf).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = sum(r.predicted and r.toxic for r in out)
    assert hits >= 0.6 * sum(r.toxic for r in out) and sum(r.predicted and not r.toxic for r in out) <= 2


def test_line_dedup_is_per_host(spark):
    rows = [(i, f"Home page\nline {i}", "a") for i in range(10)] + [(50 + i, f"Home page\nother {i % 2}", f"h{i}") for i in range(5)]
    out = {r.doc_id: (r.text, r.n) for r in linededup.drop_boilerplate(docs_of(spark, rows).drop("n"), count_col="n").collect()}
    assert out[3] == ("line 3", 1) and out[51] == ("Home page\nother 1", 0)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    cols = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, SF001).cache()
        assert docs.count() <= before and docs.columns[:len(cols)] == cols, name
    kept = {r.doc_id for r in quality.score_documents(spark.read.parquet(f"{SF001}/documents.parquet")).where("kept").collect()}
    assert {r.doc_id for r in docs.collect()} <= kept


def test_simjoin_rows_that_share_an_id(spark):
    """Rows of one id with different texts are documents of their own; no link of any of them
    is lost, and only the rows that have an earlier match go."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(7, a, "s"), (7, b, "s"), (3, a, "s"), (9, b, "s"), (9, c, "s"), (11, c, "s"), (12, c, "s"), (12, c, "s"), (5, None, "s"), (5, "", "s")]
    out = simjoin.join_components(docs_of(spark, rows))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())
    assert got == sorted([(7, 37, 3), (7, 37, 7), (3, 37, 3), (9, 37, 7), (9, 37, 9), (11, 37, 9), (12, 37, 9), (12, 37, 9), (5, 0, 5), (5, 0, 5)])
    docs = docs_of(spark, rows).withColumn("gone", F.lit(1)).withColumn("text_key", F.lit("k"))
    kept = simjoin.keep_one(docs, n=4, percent=85)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(7, b), (3, a), (9, c), (5, ""), (5, "")])


def test_components_of_chains_and_stars(spark):
    from tablelearn.llm.common import Scratch

    links = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(50)] + [(-5, 7000), (7000, 6999), (3, 3)]
    scratch = Scratch(spark)
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in simjoin.components(df, scratch).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1051)}, **{i: -5 for i in (-5, 7000, 6999)}}
    assert simjoin.components(df.limit(0), scratch).count() == 0
    scratch.drop()
