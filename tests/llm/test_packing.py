"""Best-fit-decreasing packing: brute force per document, round trip, boundary cases."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.llm import packing, queries
from tablelearn.sources.tables import read_table
from tests.conftest import SF001


def encode(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    return tk.encode(text or "", add_special_tokens=False).ids + [0]


def fills(lengths, capacity):
    """One item at a time into the tightest open sequence; how many sequences have which fill
    (contents depend on ties between sequences with the same room, fills do not)."""
    bins = []
    for x in sorted(lengths, reverse=True):
        room = [(capacity - sum(b), i) for i, b in enumerate(bins) if capacity - sum(b) >= x]
        if room:
            bins[min(room)[1]].append(x)
        else:
            bins.append([x])
    return collections.Counter(sum(b) for b in bins)


def check(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity; returns the fills."""
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in seqs.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
    return collections.Counter(sum(n for _, n in v) for v in seqs.values())


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_packing_item_by_item(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 16, 33, 100])
    lengths = [rng.randint(1, rng.choice([capacity, max(1, capacity // 3)])) for _ in range(rng.randint(0, 300))]
    runs, opened = packing.plan(collections.Counter(lengths), capacity)
    bins = collections.defaultdict(dict)
    for x, total in collections.Counter(lengths).items():
        mine = [r for r in runs.tolist() if r[0] == x]
        for k in range(total):
            _, rank, first, each, offset = [r for r in mine if r[1] <= k][-1]
            nth, into = divmod(k - rank, each)
            assert bins[first + nth].setdefault(offset + into * x, x) == x
    got = collections.Counter(sum(b.values()) for b in bins.values())
    assert got == fills(lengths, capacity) and opened == sum(got.values())


def test_tightest_capacity():
    tree = packing.CapacityTree(100)
    for room in (0, 3, 50, 50, 100):
        tree.push(room, room, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 50, 51, 100)] == [3, 3, 50, 50, 100, 100]
    tree.pop(50), tree.pop(50), tree.pop(100)
    assert tree.tightest(4) is None


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF001, "documents").collect()}
    rows = queries.op11_best_fit_packing(spark, SF001).collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = encode(text)
        cut = [ids[a:a + 2048] for a in range(0, len(ids), 2048)]
        mine = sorted(got[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in mine] == [
            (n, n * 2048, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for n, c in enumerate(cut)]
    assert check(rows, 2048) == fills([r.length for r in rows], 2048)


def test_words_alone_give_the_ids_of_the_text(spark):
    texts = ["I'm here, you'll  see\u00a0it's\u2003a\ttest\x1fof\x0bwhite\u3000space", "caf\u0065\u0301 \u0301x ΑΣ ΣΑΣ.",
             "a <|endoftext|> b<|startoftext|>c", "日本語 текст \U0001f600\U0001f600 !!!...'s 't", "x" * 5000, "1234 5 6\r\n7", "\ufeff \x00 \x85 z",
             "\u0130stanbul. \u0130 \u01c4 \u01c5 \u00df \u1e9e \u017f E\u0301 e\u0301' eau'. d'Eau, h\u0331 H\u0331 \u00b5 x\u00d7 \u00f7y",
             " ".join(chr(c) for c in range(33, 0x250)), " ".join(f"a{chr(c)}b {chr(c)}. {chr(c)}'s" for c in range(33, 0x400))]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in packing.pieces(d, capacity=1 << 19).collect()}
    assert got == {i: encode(t) for i, t in enumerate(texts)}


def test_odd_rows_and_names(spark):
    rows = [(None, None, 1), (None, "", 2), (5, "a b", 3), (5, "a b", 3), (6, "word " * 9000, 4)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, part int")
    out = packing.place(packing.pieces(d).withColumns({"part": F.lit(7), "rank": F.lit("x"), "base": F.lit(1), "n": F.lit(2)}))
    got = out.collect()
    assert sorted((r.doc_id is None, r.length) for r in got) == [(False, 3), (False, 3), (False, 809), *[(False, 2048)] * 4, (True, 1), (True, 1)]
    assert {(r.part, r["rank"], r.base, r.n) for r in got} == {(7, "x", 1, 2)}
    assert sum(check(got, 2048).values()) == 5
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(out).collect()}
    assert sorted(whole.values()) == [817, 2048, 2048, 2048, 2048]
    assert packing.place(packing.pieces(d.limit(0))).count() == 0
    with pytest.raises(Exception, match="lengths must lie"):
        packing.place(spark.createDataFrame([(3000,)], "length int")).count()


def test_many_tasks_and_one_hot_length(spark):
    items = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") % 512 + 1)).alias("length"))
    rows = packing.place(items.repartition(23), capacity=512).collect()
    assert len(rows) == 5000
    assert check(rows, 512) == fills([r.length for r in rows], 512)


def test_a_column_asks_for_each_part_once_and_keeps_special_tokens(monkeypatch):
    """Tokenising went word by word through Python, marks and case included."""
    import public_tokenizers
    import pyarrow as pa

    asked = collections.Counter()

    class Counting(packing.Coder):
        def __getitem__(self, word):
            asked[word] += 1
            return super().__getitem__(word)

    rng = random.Random(3)
    plain = [None, "", " \n\t", "Dog, dog. DOG! dogs' dog's it's, 'S", "Été, Été. İx \x00 ΣΣ.", "H\u0331 h\u0331 E\u0301X"] + [
        "".join(rng.choice("aBc'.,É1ß# \nΣ-") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    special = ["A<|endoftext|>b <|ENDOFTEXT|> X.", "<|", *plain]
    for texts in (plain, special):
        coder = Counting(public_tokenizers.path(packing.TOKENIZER))
        asked.clear()
        got = list(coder.texts(pa.array(texts, pa.string())))
        assert got == [np.array(encode(t)[:-1], "<u4").tobytes() for t in texts]
        assert max(asked.values()) == 1
    assert list(coder.texts(pa.array([], pa.string()))) == []
