"""The semi-Markov field's gradient and its transitions."""

import itertools
import math

import numpy as np

from tablelearn.llm import pii

TEXT = "call +1 523 555 1055 or jo@ex.org, 10.0.0.1"


def paths(field, text, win):
    """Every segmentation as (score, spans), by plain recursion."""
    cut, ends = field.lattice(text, win)

    def go(j, last):
        if j == 0:
            yield 0.0, ()
            return
        for s, p in go(j - 1, None):
            yield s, p
        for i, feats in ends[j]:
            for k in pii.KINDS:
                for s, p in go(i, None):
                    before = p[-1][0] if p and p[-1][2] == cut[i] else ""
                    yield s + field.score(k, feats, before), (*p, (k, cut[i], cut[j]))

    return list(go(len(cut) - 1, None))


def test_gradient_is_the_likelihoods(spark=None):
    rng = np.random.default_rng(0)
    field = pii.SemiMarkov()
    text, win = "1234567 7654321", (0, 15)
    gold = {("phone", 0, 7), ("card", 8, 15)}
    keys = set(field.gradient(text, win, gold)[1])
    assert {("", k) for k in pii.KINDS} <= keys
    field.w = {k: float(rng.normal()) for k in [*keys, ("phone", "card"), ("card", "card")]}
    ll, grad = field.gradient(text, win, gold)
    every = paths(field, text, win)
    want = [s for s, p in every if set(p) == gold]
    assert len(want) == 1
    assert math.isclose(ll, want[0] - np.logaddexp.reduce([s for s, _ in every]), abs_tol=1e-9)
    for key in itertools.islice(sorted(field.w), 0, None, 3):
        old = field.w[key]
        near = []
        for d in (1e-5, -1e-5):
            field.w[key] = old + d
            near.append(field.gradient(text, win, gold)[0])
        field.w[key] = old
        assert math.isclose(grad.get(key, 0.0), (near[0] - near[1]) / 2e-5, abs_tol=1e-4)


def test_transitions_are_learned_and_decoded():
    chunks = [f"write to a{i}b@ex{i}.org, or +1 523 555 {1000 + i} now 192.168.0.{i}" for i in range(60)]
    field = pii.SemiMarkov().fit(pii.training_samples(chunks))
    before = ("", *pii.KINDS)
    learned = {(p, k): w for (p, k), w in field.w.items() if p in before and k in pii.KINDS and w}
    assert {("", k) for k in ("email", "phone", "ip")} <= set(learned)
    text = "523 555 1055/10.0.0.1"
    for win in pii.windows(text):
        best = max(paths(field, text, win), key=lambda x: x[0])
        got = field.decode(text, win)
        assert math.isclose(sum(1 for _ in got), len(best[1])) and tuple(got) == best[1]
