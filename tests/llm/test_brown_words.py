"""Word classes of the language model: every training word has its own, by its own neighbours."""

import random
import zlib

import pytest

from tablelearn.llm import brown


@pytest.fixture(scope="module")
def grammar(spark):
    """Nouns and verbs, most of them seen a few times and all of the rare ones with the same ending."""
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        noun, verb = (w if rnd.random() < 0.5 else f"{w[0]}{rnd.randint(0, 60)}zz" for w in ("dog", "run"))
        rows.append((i, f"the {noun} can {verb} now"))
    rows += [(None, "the dog"), (401, None), (401, "n1zz  can\tnever\x0bRUN "), (402, "unseen" + "x" * 80 + " n2zz " * 300)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).cache()


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_rare_words_are_classed_by_their_neighbours(grammar, monkeypatch):
    """Words beyond those exchanged one by one once shared 128 classes by a hash of their ending."""
    monkeypatch.setattr(brown, "UNIT_WORDS", 5)
    train = grammar.where("doc_id < 400")
    model, vocab = brown.train(train)
    of = lambda w: int(model.cls[model.unit_of(w.encode())])
    seen = {w for r in train.collect() if zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for w in r.text.split()}
    nouns, verbs = ([w for w in seen if w.startswith(c) and w.endswith("zz")] for c in "dr")
    assert len(nouns) > 30 and len(verbs) > 30
    assert {of(w) for w in nouns} == {of("dog")} and {of(w) for w in verbs} == {of("run")} and of("dog") != of("run")
    assert {r.word for r in vocab.collect()} == seen


def test_words_outside_the_broadcast_count_alike(grammar, monkeypatch):
    model, vocab = brown.train(grammar)
    want = by_id(brown.score(grammar, model, vocab))
    assert len(want) == 403 and want[401].n_tokens == 6 and want[402].n_tokens == 302
    monkeypatch.setattr(brown, "DICTIONARY", 6)
    small, table = brown.train(grammar)
    assert len(small.unit) <= 6 < table.count()
    for got in (brown.score(grammar, small, table), brown.score(grammar.select("text", "doc_id"), small, table)):
        got = by_id(got)
        assert got.keys() == want.keys()
        for i, r in want.items():
            # the words exchanged one by one differ with the broadcast, base scores and counts do not
            assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (r.n_tokens, r.n_known, r.train_tokens)
            assert got[i].base_score == pytest.approx(r.base_score)
    again = by_id(brown.score(grammar.select("text", "doc_id"), model, vocab))
    assert all(again[i].score == pytest.approx(r.score) for i, r in want.items())


def test_score_of_joined_words_is_that_of_the_model(grammar, monkeypatch):
    monkeypatch.setattr(brown, "DICTIONARY", 6)
    model, vocab = brown.train(grammar)
    table = {r.word: (r.n, r.cls) for r in vocab.collect()}
    got, texts = by_id(brown.score(grammar, model, vocab)), {}
    for r in grammar.collect():
        texts.setdefault(r.doc_id, []).append((r.text or "").encode().lower().split())
    for i, rows in texts.items():
        total = 0.0
        for ws in rows:
            at = [table.get(w.decode(), (0, model.unknown)) for w in ws]
            line = [0, *[c for _, c in at], 0]
            total += sum(model.step[a, b] for a, b in zip(line, line[1:]))
            total += sum(model.known[c] + brown.math.log10(n) if n else model.unk[c] for n, c in at)
        assert got[i].score == pytest.approx(total)
