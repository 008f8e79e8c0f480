"""Interactions are learned through train(), from terms that mark nothing by themselves."""

import random

import numpy as np
import pytest

from tablelearn.llm import toxicity


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.mark.parametrize("rule", ["same", "both"])
def test_pairs_of_harmless_words(spark, rule):
    rnd = random.Random(3)
    filler = [f"word{i}" for i in range(200)]
    docs, labels = [], {}
    for i in range(4000):
        insult, group = rnd.random() < .5, rnd.random() < .5
        text = rnd.choices(filler, k=12) + ["idiot"] * insult + ["people"] * group
        rnd.shuffle(text)
        docs.append((i, " ".join(text)))
        labels[i] = int(insult == group) if rule == "same" else int(insult and group)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    model = toxicity.train(d, lab)
    assert {toxicity.bucket("idiot"), toxicity.bucket("people")} <= set(model.index)
    assert len(model.index) < 40  # the filler stays out
    out = toxicity.score(d, model).where("held_out").collect()
    y = np.array([labels[r.doc_id] for r in out])
    assert auc(np.array([r.score for r in out]), y) > 0.95


def test_interacting_by_brute_force():
    rng = np.random.default_rng(0)
    x = rng.random((600, 9)) < 0.4
    y = ((x[:, 2] ^ x[:, 5]) | (rng.random(600) < 0.05)).astype(int)
    got = toxicity.interacting([np.nonzero(r)[0] for r in x], y, 9)
    z = {}
    for i in range(9):
        for j in range(i + 1, 9):
            parts = [(1, x[:, i] & x[:, j]), (-1, x[:, i] & ~x[:, j]), (-1, ~x[:, i] & x[:, j]), (1, ~x[:, i] & ~x[:, j])]
            p = [((y[m].sum() + .5) / (m.sum() + 1), m.sum() + 1, s) for s, m in parts]
            z[i, j] = abs(sum(s * q for q, _, s in p)) / np.sqrt(sum(q * (1 - q) / n for q, n, _ in p))
    assert got == [k for k, v in sorted(z.items(), key=lambda kv: -kv[1]) if v >= toxicity.MIN_Z] and got[0] == (2, 5)
    assert toxicity.interacting([], np.zeros(0), 0) == []
