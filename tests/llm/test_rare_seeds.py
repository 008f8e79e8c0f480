"""Rare seeds lose no leak and keep postings flat."""

import random

import numpy as np
import pytest

from tablelearn.llm import decontaminate


def found(items, text):
    ids = decontaminate._reader(items)(text)
    out = {}
    for no, lo, hi in decontaminate._candidates(items, ids, items.hits(ids)):
        item_id, words = items.words[no]
        score = decontaminate.align(words, ids[lo:hi])[0] / (2 * len(words))
        if score >= items.min_score:
            out[item_id] = max(out.get(item_id, 0.0), round(score, 6))
    return out


@pytest.mark.parametrize("size", [12, 30, 60])
def test_common_stems_find_nothing_and_copies_are_found(size):
    rnd = random.Random(size)
    vocab = [f"w{i}" for i in range(400)]
    stem = "which of the following statements is most likely true"
    rows = [(i, stem + " " + " ".join(rnd.choices(vocab, k=size - 9))) for i in range(40)]
    items = decontaminate.Items(rows, 3, 0.6)
    number = {}
    ids = lambda t: np.array([number.setdefault(w, len(number)) for w in t.split()])
    for i, text in rows[:12]:
        for every in (4, 5, 6, 99):
            w = [f"new{k}" if k % every == every // 2 else x for k, x in enumerate(text.split())]
            doc = " ".join(rnd.choices(vocab, k=20) + w + rnd.choices(vocab, k=20))
            want = {j: s for j, t in rows if (s := round(decontaminate.align(ids(t), ids(doc))[0] / (2 * len(t.split())), 6)) >= 0.6}
            assert found(items, doc) == want and (i in want or every < 6)


def test_postings_are_flat_in_the_number_of_items():
    rnd = random.Random(1)
    stem = "which of the following statements is most likely true"
    counts = []
    for n in (50, 800):
        rows = [(i, stem + " " + " ".join(f"v{rnd.randrange(50_000)}" for _ in range(60))) for i in range(n)]
        items = decontaminate.Items(rows, 3, 0.6)
        doc = "so " + stem + " here " + rows[0][1]
        ids = decontaminate._reader(items)(doc)
        counts.append(sum(len(items.grams[g]) for g, _ in items.hits(ids)))
    assert counts[1] < 1.5 * counts[0]


def test_survivors_hold():
    """No choice of changed words leaves a copy above the score with fewer n-grams."""
    for size, k in ((8, 3), (10, 3), (11, 2)):
        least = size
        for mask in range(1 << size):
            kept = [not mask >> i & 1 for i in range(size)]
            inner = [i for i in range(size) if kept[i]]
            if not inner:
                continue
            lost = sum(not x for x in kept[inner[0]:inner[-1] + 1])
            if 2 * len(inner) - lost >= 2 * 0.6 * size:
                least = min(least, sum(all(kept[q:q + k]) for q in range(size - k + 1)))
        assert least >= decontaminate.survivors(size, k, 0.6)
