"""Toxicity: a factorization machine over hashed terms. Beside a weight per term it
learns a short vector per term, so that pairs of terms (an insult with the group it is
aimed at) add their own, learned interaction.

The model learns from labelled rows whose crc32(doc_id) mod 4 is not 2, of them at most
``max_rows`` (those with the smallest id hashes). Terms are lower-cased words (without
marks at their ends) hashed to 2^20 buckets. A term enters in one of two ways, both over all rows
of that sample: its own document counts by label pass a chi-square test, or it stands in a pair
whose label rates differ from what its two terms would give one by one (p11 - p10 - p01 + p00,
in standard errors), so that words harmless alone are learned where only their meeting is
toxic. Pairs are tested among the ``PAIR_TERMS`` most frequent terms that are not in three quarters of all
rows. Only the text is an input of a score.

Defined results: null and empty texts get the score of the bias alone; a null id is never
held out and never trained on; repeated rows are scored one by one, a repeated label row
counts as often as it stands; without labelled rows every score is 0; extra columns are
ignored. Very long texts are read whole; ties between terms go by bucket number.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, WordCache, crc_mod, keyed, pick, strip_ends, text_bytes_conf

BUCKETS = 1 << 20
#: Chi-square above which a term is kept (p < 0.001), at least so many documents hold it,
#: and the largest number of terms.
MIN_CHI2, MIN_DOCS, MAX_TERMS = 10.83, 5, 8192
#: Terms whose pairs are tested, the largest share of rows that holds such a term, standard
#: errors from which a pair interacts (some two million pairs are tested), and the most pairs.
PAIR_TERMS, PAIR_SHARE, MIN_Z, MAX_PAIRS = 2048, 0.75, 6.5, 1024



def _letter(ch: str) -> bool:
    return ch.isalnum() and not ch.isdecimal()


def bucket(word: str) -> int:
    """Bucket of a word, lower-cased and without digits and marks at its ends."""
    term = strip_ends(word.lower(), _letter)
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def buckets(text: str | None, cache: WordCache) -> set[int]:
    return set(map(cache.__getitem__, set(text.split()))) if text else set()


def interacting(rows: list[np.ndarray], y: np.ndarray, n_terms: int) -> list[tuple[int, int]]:
    """The pairs of terms (numbers below ``n_terms``) that interact, the strongest first.
    ``rows`` are bounded by the training sample; counts are matrix products of row blocks."""
    both, hit = np.zeros((n_terms, n_terms), np.float32), np.zeros((n_terms, n_terms), np.float32)
    for at in range(0, len(rows), 2000):
        x = np.zeros((len(rows[at:at + 2000]), n_terms), np.float32)
        for i, r in enumerate(rows[at:at + 2000]):
            x[i, r] = 1.0
        both += x.T @ x
        x = x[y[at:at + 2000] > 0]
        hit += x.T @ x
    n, k, total, toxic = np.diag(both).copy(), np.diag(hit).copy(), float(len(rows)), float((y > 0).sum())
    contrast, error = np.zeros_like(both), np.zeros_like(both)
    cells = ((1, both, hit), (-1, n[:, None] - both, k[:, None] - hit), (-1, n[None, :] - both, k[None, :] - hit),
             (1, total - n[:, None] - n[None, :] + both, toxic - k[:, None] - k[None, :] + hit))
    for sign, m, t in cells:
        p = (t + 0.5) / (m + 1.0)
        contrast += sign * p
        error += p * (1.0 - p) / (m + 1.0)
    z = np.abs(contrast) / np.sqrt(error)
    z[(both < MIN_DOCS) | (n[:, None] - both < 1) | (n[None, :] - both < 1)] = 0.0
    i, j = np.nonzero(np.triu(z, 1) >= MIN_Z)
    order = np.lexsort((j, i, -z[i, j]))[:MAX_PAIRS]
    return list(zip(i[order].tolist(), j[order].tolist()))


class FactorizationMachine:
    """Logistic FM on sets of term numbers: w0 + sum w_i + sum_{i<j} <v_i, v_j>."""

    def __init__(self, terms: list[int], rank: int = 8, seed: int = 7):
        self.index = {t: i for i, t in enumerate(terms)}
        self.w0 = 0.0
        self.w = np.zeros(len(terms))
        self.v = np.random.default_rng(seed).normal(0, 0.05, (len(terms), rank))

    def logit(self, x: list[int]) -> float:
        if not x:
            return self.w0
        v = self.v[x]
        s = v.sum(0)
        return float(self.w0 + self.w[x].sum() + 0.5 * ((s * s).sum() - (v * v).sum()))

    def score(self, found: set[int]) -> float:
        x = sorted(self.index[t] for t in found if t in self.index)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(x), -40, 40))))

    def fit(self, rows: list[list[int]], y: list[int], epochs: int = 12, rate: float = 0.1,
            l2: float = 1e-4, seed: int = 7) -> "FactorizationMachine":
        """AdaGrad, one row at a time, in a seeded order."""
        share = min(max(float(np.mean(y)), 1e-4), 1 - 1e-4)
        self.w0 = float(np.log(share / (1 - share)))
        g0, gw, gv = 1.0, np.ones(len(self.w)), np.ones(self.v.shape)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for r in rng.permutation(len(rows)):
                x = rows[r]
                e = 1.0 / (1.0 + np.exp(-np.clip(self.logit(x), -40, 40))) - y[r]
                g0 += e * e
                self.w0 -= rate * e / np.sqrt(g0)
                if x:
                    v = self.v[x]
                    d = e + l2 * self.w[x]
                    gw[x] += d * d
                    self.w[x] -= rate * d / np.sqrt(gw[x])
                    d = e * (v.sum(0) - v) + l2 * v
                    gv[x] += d * d
                    self.v[x] -= rate * d / np.sqrt(gv[x])
        return self


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = 20_000) -> FactorizationMachine | None:
    """Fit on at most ``max_rows`` labelled rows; None without any."""
    spark = docs.sparkSession
    text_bytes_conf(spark)
    lab = (pick(labels, doc_id=id_col, y=label_col)
           .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), 4) != 2)))
    sample = lab.orderBy(F.xxhash64(F.col("doc_id").cast("string"))).limit(max_rows)
    # at most max_rows (id, label) pairs: a proven bound for the broadcast
    rows = pick(docs, doc_id=id_col, text=text_col).join(F.broadcast(sample), "doc_id").select("text", "y")

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, seen = WordCache(bucket), np.zeros((2, BUCKETS), np.int32)
        for b in batches:
            for t, y in zip(b["text"], b["y"]):
                seen[int(y > 0), list(buckets(t, cache))] += 1
        k = np.nonzero(seen.sum(0))[0]
        yield pd.DataFrame({"b": k, "neg": seen[0, k], "pos": seen[1, k]}).astype("int64")

    n = {r["y"]: r["n"] for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y"))
         .agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 + n1:
        return None
    per = (rows.mapInPandas(counts, "b bigint, neg bigint, pos bigint").groupBy("b")
           .agg(F.sum("neg").cast("double").alias("c"), F.sum("pos").cast("double").alias("a")))
    a, c, total = F.col("a"), F.col("c"), float(n0 + n1)
    margin = F.greatest((a + c) * (F.lit(total) - a - c) * F.lit(float(n0)) * F.lit(float(n1)), F.lit(1.0))
    chi = F.lit(total) * F.pow(a * F.lit(float(n0)) - c * F.lit(float(n1)), 2) / margin
    per = per.where(a + c >= MIN_DOCS).persist()
    own = [r["b"] for r in per.where(chi >= MIN_CHI2).orderBy(chi.desc(), "b").limit(MAX_TERMS).collect()]
    often = [r["b"] for r in per.where(a + c <= PAIR_SHARE * total).orderBy((a + c).desc(), "b").limit(PAIR_TERMS).collect()]
    per.unpersist()
    asked = often + sorted(set(own) - set(often))  # at most PAIR_TERMS + MAX_TERMS numbers
    shared = Shared(spark, {t: i for i, t in enumerate(asked)})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, index = WordCache(bucket), shared.value
        for b in batches:
            xs = [np.array(sorted(index[k] for k in buckets(t, cache) if k in index), "<u2").tobytes() for t in b["text"]]
            yield pd.DataFrame({"x": xs, "y": (b["y"] > 0).astype("int32")})

    got = sorted((bytes(r["x"]), r["y"]) for r in rows.mapInPandas(encode, "x binary, y int").collect())
    xs, ys = [np.frombuffer(x, "<u2") for x, _ in got], np.array([y for _, y in got])
    pairs = interacting([x[x < len(often)] for x in xs], ys, len(often))
    terms = sorted(set(own) | {often[t] for pair in pairs for t in pair})
    model = FactorizationMachine(terms)
    number = np.array([model.index.get(t, -1) for t in asked])
    return model.fit([[i for i in number[x].tolist() if i >= 0] for x in xs], ys.tolist())


def score(docs: DataFrame, model: FactorizationMachine | None, id_col: str = "doc_id",
          text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """id, held_out, score, predicted for every row. Map-only."""
    spark = docs.sparkSession
    text_bytes_conf(spark)
    d = keyed(docs, "doc_id", doc_id=id_col, text=text_col)
    kind = docs.schema[id_col].dataType
    shared = Shared(spark, model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, fm = WordCache(bucket), shared.value
        for b in batches:
            s = [fm.score(buckets(t, cache)) if fm else 0.0 for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": s})

    out = d.mapInPandas(run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast(kind))
    return out.select(F.col("doc_id").alias(id_col),
                      F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
