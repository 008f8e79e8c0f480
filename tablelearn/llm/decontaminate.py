"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Texts become words between white space, lower-cased and without the marks at their ends.
The rare n-grams of an item are its seeds. Which n-grams an edited copy still holds cannot be
told from how often they occur, but how many it holds at least can: an item leaves out as many of
its most common n-grams (those it shares with the most items) less one, so whatever copy reaches
``min_score`` still holds a seed, and stems that many items begin with find nothing. Around the seeds a document shares with an item, the words that
the item has count +2 and all others -1; no alignment scores more than the best run of
these, so stretches whose best run is too low (chance hits of common n-grams) are left
out without loss. The others are aligned: +2 for equal words, -1 for a changed, missing or
added word. The score is the best local alignment over the perfect one; pairs at or above
``min_score`` are reported.

Items so short that a copy with changed words could reach ``min_score`` without a common
n-gram take shorter ones (``seed_length``). What no seed finds are copies with words added
or removed so often that no n words in a row are left.

Defined results: null or word-free texts and items match nothing; items shorter than the
n-gram are matched as one n-gram of their own length; repeated rows are reported one by
one; of equally good stretches of a document the first is reported; very long texts are searched
whole, around their seeds; empty tables give an empty result; extra columns are ignored.

Scale: no shuffle of texts. The items are searched in blocks of bounded size (each block
is broadcast), every block against all documents.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, WordCache, keyed, pick, spill, strip_ends, text_bytes_conf

MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of items that one broadcast block may hold.
BLOCK_WORDS = 2_000_000
#: Leaked ids that may be broadcast.
BROADCAST_IDS = 1_000_000


def norm(word: str) -> str:
    return strip_ends(word.lower(), str.isalnum)


def tokens(text: str | None) -> list[str]:
    return [w for w in map(norm, text.split()) if w] if text else []


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of a (item) in b (document words): score, and the first and
    last word of b in it. Linear gaps let each row be swept by a running maximum."""
    m = len(b)
    h = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)
    slope = -GAP * np.arange(m + 1)
    best, lo, hi = 0, 0, 0
    for x in a:
        diag = h[:-1] + np.where(b == x, MATCH, MISMATCH)
        up = h[1:] + GAP
        new = np.zeros(m + 1, np.int64)
        origin = np.arange(m + 1)
        new[1:] = np.maximum(diag, up)
        origin[1:] = np.where(diag >= up, start[:-1], start[1:])
        dead = new <= 0
        new[dead] = 0
        origin[dead] = np.arange(m + 1)[dead]
        lifted = new + slope
        peak = np.maximum.accumulate(lifted)
        src = np.maximum.accumulate(np.where(lifted == peak, np.arange(m + 1), 0))
        swept = peak - slope
        h, start = swept, origin[src]
        top = int(h.argmax())
        if h[top] > best:
            best, lo, hi = int(h[top]), int(start[top]), top
    return best, lo, hi


def survivors(size: int, k: int, min_score: float) -> int:
    """How many of its k-grams every copy of an item of ``size`` words holds at least when it
    reaches ``min_score`` with e words changed and others cut off its ends: e + 1 runs of m
    equal words in all have at least m - (k - 1)(e + 1) k-grams."""
    goal = 2 * min_score * size
    kept = [(-(-(goal + e - 1e-9) // 2), e) for e in range(size)]
    return int(min((m - (k - 1) * (e + 1) for m, e in kept if m + e <= size), default=0))


def seed_length(size: int, n: int, min_score: float) -> int:
    """The longest n-gram, up to n, of which every such copy holds one."""
    return next((k for k in range(min(n, size), 1, -1) if survivors(size, k, min_score) >= 1), 1)


class Items:
    """A block of benchmark items as word numbers, with their n-grams."""

    def __init__(self, rows: list[tuple], n: int, min_score: float):
        self.n, self.min_score = n, min_score
        self.vocab: dict[str, int] = {}
        self.words: list[tuple[object, np.ndarray]] = []
        self.has: list[np.ndarray] = []
        self.grams: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in rows:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in tokens(text)]
            if not ids:
                continue
            k, no = seed_length(len(ids), n, min_score), len(self.words)
            self.words.append((item_id, np.array(ids, np.int64)))
            self.has.append(np.unique(self.words[-1][1]))
            for q in range(len(ids) - k + 1):
                self.grams[tuple(ids[q:q + k])].append((no, q))
        self._leave_out_common()
        self.grams = {g: found for g, found in self.grams.items() if found}
        self.sizes = sorted({len(g) for g in self.grams})
        #: Two-word starts of the n-grams, a quick test before the exact one.
        self.pairs = np.unique(np.array([self._pair(*g[:2]) for g in self.grams if len(g) > 1] or [0], np.int64))

    def _leave_out_common(self) -> None:
        """Drop of each item its most shared n-grams, as many as a copy can spare."""
        shared: dict[int, list[tuple[int, int, tuple]]] = defaultdict(list)
        for g, found in self.grams.items():
            items = len({no for no, _ in found})
            if items > 1:
                for no, q in found:
                    shared[no].append((-items, q, g))
        gone: dict[tuple, set] = defaultdict(set)
        for no, found in shared.items():
            spare = survivors(len(self.words[no][1]), len(found[0][2]), self.min_score) - 1
            for _, q, g in sorted(found)[:max(0, spare)]:
                gone[g].add((no, q))
        for g, out in gone.items():
            self.grams[g] = [x for x in self.grams[g] if x not in out]

    def _pair(self, x, y):
        return x * np.int64(len(self.vocab) + 1) + y

    def hits(self, ids: np.ndarray) -> list[tuple[tuple, int]]:
        """(n-gram, position) of every item n-gram in a document."""
        out = []
        if len(ids) > 1 and self.sizes[-1] > 1:
            p = self._pair(ids[:-1], ids[1:])
            at = np.searchsorted(self.pairs, p)
            at[at == len(self.pairs)] = 0
            starts = np.nonzero((self.pairs[at] == p) & (ids[:-1] > 0))[0].tolist()
            row = ids.tolist() if starts else []
            for k in self.sizes:
                if k > 1:
                    out += [(g, i) for i in starts if (g := tuple(row[i:i + k])) in self.grams]
        if self.sizes[0] == 1:
            out += [((x,), i) for i, x in enumerate(ids.tolist()) if (x,) in self.grams]
        return out


def _reader(items: Items):
    """text -> word numbers (0: a word of no item); words are normalised once a task."""
    number = WordCache(lambda w: items.vocab.get(x, 0) if (x := norm(w)) else -1)

    def ids(text: str | None) -> np.ndarray:
        toks = text.split() if text else []
        out = np.fromiter(map(number.__getitem__, toks), np.int64, len(toks))
        return out[out >= 0] if len(out) and out.min() < 0 else out

    return ids


def _candidates(items: Items, ids: np.ndarray, hits: list[tuple[tuple, int]]) -> Iterator[tuple[int, int, int]]:
    """(item number, first, last word) of the stretches to align."""
    by_item: dict[int, list[int]] = defaultdict(list)
    for g, p in hits:
        for no, q in items.grams[g]:
            by_item[no].append(p - q)
    for no, found in by_item.items():
        size = len(items.words[no][1])
        goal = MATCH * size * items.min_score - 1e-9
        pad = int(MATCH * size - goal) + 1  # more gaps than this cost too much
        found.sort()
        lo = hi = found[0]
        for x in [*found[1:], None]:
            if x is not None and x - hi <= size + 2 * pad:
                hi = x
                continue
            first, last = max(0, lo - pad), min(len(ids), hi + size + pad)
            part = ids[first:last]
            has = items.has[no]
            at = np.searchsorted(has, part)
            at[at == len(has)] = 0
            run = np.concatenate(([0], np.cumsum(np.where(has[at] == part, MATCH, GAP))))
            gain = run - np.minimum.accumulate(run)
            # every alignment that scores enough ends where the run up to it does
            good = np.nonzero(gain >= goal)[0]
            if len(good):
                span = size + pad
                cuts = np.nonzero(np.diff(good) > span)[0]
                for a, b in zip(good[np.r_[0, cuts + 1]].tolist(), good[np.r_[cuts, len(good) - 1]].tolist()):
                    yield no, first + max(0, a - span), first + b
            if x is not None:
                lo = hi = x


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, min_score: float = 0.6,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, score, item_words, first_word, last_word (end exclusive, the best
    stretch) for every leaked pair."""
    spark = docs.sparkSession
    text_bytes_conf(spark)
    d = keyed(docs, "doc_id", doc_id=id_col, text=text_col)
    b = pick(benchmark, item_id=item_col, text=item_text_col).where(F.col("text").isNotNull())
    kind = docs.schema[id_col].dataType
    schema = (f"doc_id string, item_id {dict(b.dtypes)['item_id']}, score double, item_words bigint, "
              "first_word bigint, last_word bigint")
    total = b.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (2 * BLOCK_WORDS)))
    out = spark.createDataFrame([], schema)
    for k in range(blocks):
        rows = b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        items = Items(sorted(((r["item_id"], r["text"]) for r in rows), key=repr), n, min_score)
        if items.words:
            out = out.unionByName(_search(spark, d, items, schema))
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def _search(spark, d: DataFrame, items: Items, schema: str) -> DataFrame:
    shared = Shared(spark, items)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        read = _reader(own)
        for batch in batches:
            got = []
            for doc_id, t in zip(batch["doc_id"], batch["text"]):
                ids = read(t)
                best: dict[int, tuple] = {}
                for no, lo, hi in _candidates(own, ids, own.hits(ids)):
                    item_id, words = own.words[no]
                    score, first, last = align(words, ids[lo:hi])
                    score /= MATCH * len(words)
                    if score >= own.min_score and score > best.get(no, (0.0,))[0]:
                        best[no] = (score, lo + first, lo + last)
                got += [(doc_id, own.words[no][0], round(s, 6), len(own.words[no][1]), x, y)
                        for no, (s, x, y) in best.items()]
            if got:
                yield pd.DataFrame(got, columns=["doc_id", "item_id", "score", "item_words",
                                                 "first_word", "last_word"])

    return d.mapInPandas(search, schema)


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The documents without a leaked pair (null ids are kept)."""
    name = "leaked"
    while name in docs.columns:
        name += "_"
    leaked = find_leaks(docs, benchmark, id_col=id_col, **kw).select(F.col("doc_id").alias(name)).distinct()
    leaked = spill(leaked.where(F.col(name).isNotNull()), "leaked")  # ids only, before any text could move
    few = leaked.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(leaked) if few else leaked, F.col(f"`{id_col}`") == F.col(name), "left_anti")
