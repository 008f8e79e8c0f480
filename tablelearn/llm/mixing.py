"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells (source, language, topic) weighted by tokens. Raking scales
the cells, one margin after the other, until the weighted token shares of every margin
are within ``TOLERANCE`` of their targets. Where they cannot get there (cells too sparse for
the targets) it stops when they come no closer, and a warning gives what is left. A document's factor over the largest factor, times ``rate``, is the
probability with which it is sampled, so the expected shares of the sample are the
targets themselves.

Defined results: null margins are values of their own; a null text has no tokens and
takes part with its cell's factor (cells without tokens keep factor 1); the draw depends
on the id and the seed only, so repeated ids are drawn together and a null id is one id;
an empty table gives an empty result; other columns pass through unchanged. Very long texts
count with all their tokens; cells of equal mass need no order.

Scale: one partial aggregation to cells. Up to ``MAX_LOCAL_CELLS`` cells are raked in
memory and broadcast back; more are raked as a Spark table (same results).
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import count_chars, materialise, words_col

MARGINS = ("source", "lang", "topic")
#: Exponents of the default targets: share ** exponent, made to sum to 1.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Rounds of the SQL, and the least before raking gives up on margins that come no closer.
ROUNDS = 30
#: Distance of a share from its target that counts as met, and the most rounds.
TOLERANCE, MAX_ROUNDS = 1e-10, 5000
MAX_LOCAL_CELLS = 100_000


def n_tokens(text: Column) -> Column:
    return F.size(words_col(F.coalesce(text, F.lit("")))).cast("bigint")


def topic(text: Column) -> Column:
    """A coarse lexical topic: kind of content first, then length."""
    t = F.coalesce(text, F.lit(""))
    chars = F.length(t)
    symbols = count_chars(t, "#*$%&|<>")
    shouts = F.when(t.contains("!!"), (chars - F.length(F.replace(t, F.lit("!!"), F.lit("")))) / 2).otherwise(0.0)
    return (F.when(symbols * 20 > chars, "symbols").when(shouts >= 5, "shouting")
            .when(t.contains("@"), "contact").when(chars < 1000, "brief")
            .when(chars < 4000, "article").otherwise("longform"))


def _targets(mass: np.ndarray, code: np.ndarray, values: list, given: dict | None, temper: float) -> np.ndarray:
    if given is not None:
        t = np.array([float(given.get(v, 0.0)) for v in values])
    else:
        m = np.bincount(code, mass, len(values))
        t = np.where(m > 0, (m / max(m.sum(), 1e-300)) ** temper, 0.0)
    return t / t.sum() if t.sum() else t


class _Progress:
    """Distances of the margins from their targets, round by round. Values without
    tokens cannot move: they count in the warning, not for going on."""

    def __init__(self):
        self.no, self.last, self.left, self.worst, self.stuck = 0, np.inf, 0.0, 0.0, 0.0

    def margin(self, off: float, stuck: float) -> None:
        self.worst, self.stuck = max(self.worst, off), max(self.stuck, stuck)

    def more(self) -> bool:
        """Whether another round is worth it; after the last one, the warning."""
        self.no += 1
        met = self.worst <= TOLERANCE
        go = not met and (self.no < ROUNDS or self.worst < self.last * (1 - 1e-6))
        if go:
            self.last, self.left, self.worst, self.stuck = self.worst, max(self.worst, self.stuck), 0.0, 0.0
        elif max(self.worst, self.stuck) > TOLERANCE:
            self.warn(max(self.worst, self.stuck))
        return go

    def warn(self, left: float) -> None:
        warnings.warn(f"raking stopped after {self.no} rounds with a share {left:.3g} from its target", stacklevel=3)


def rake_local(mass: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray],
               rounds: int = MAX_ROUNDS) -> np.ndarray:
    f = np.ones(len(mass))
    total = mass.sum()
    if not total:
        return f
    progress = _Progress()
    for _ in range(rounds):
        for code, t in zip(codes, targets):
            now = np.bincount(code, mass * f, len(t))
            off = np.abs(now / total - t)
            progress.margin(off[now > 0].max(initial=0.0), off[now <= 0].max(initial=0.0))
            f = f * np.where(now > 0, t * total / np.where(now > 0, now, 1.0), 1.0)[code]
        if not progress.more():
            return f
    progress.warn(progress.left)
    return f


def _rake_spark(cells: DataFrame, given: dict, temper: dict, rounds: int) -> DataFrame:
    """The same loop on a cell table that does not fit: grouped sums and joins, with a
    checkpoint each round."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("mass")).first()[0] or 0.0)
    goals = {}
    for m in MARGINS:
        g = cells.groupBy(m).agg(F.sum("mass").cast("double").alias("mass"))
        if m in given:
            t = spark.createDataFrame([(k, float(v)) for k, v in given[m].items()], f"{m} string, t double")
            g = g.join(t, g[m].eqNullSafe(t[m]), "left").select(g[m], F.coalesce("t", F.lit(0.0)).alias("t"))
        else:
            g = g.select(m, F.when(F.col("mass") > 0, F.pow(F.col("mass") / total, temper[m])).otherwise(0.0).alias("t"))
        g = materialise(g)
        s = g.agg(F.sum("t")).first()[0] or 1.0
        goals[m] = g.select(F.col(m).alias(f"{m}_"), (F.col("t") / s * total).alias("t"))
    cur = cells.withColumn("f", F.lit(1.0))
    if not total:
        return cur.select(*MARGINS, "f")
    progress = _Progress()
    off = F.abs(F.col("now") - F.col("t")) / total
    for _ in range(rounds):
        for m in MARGINS:
            now = cur.groupBy(F.col(m).alias(f"{m}_")).agg(F.sum(F.col("mass") * F.col("f")).alias("now"))
            step = now.alias("n").join(goals[m].alias("g"), F.col(f"n.{m}_").eqNullSafe(F.col(f"g.{m}_")))
            step = materialise(step.select(F.col(f"n.{m}_"), "now", "t"))
            progress.margin(*[x or 0.0 for x in step.agg(F.max(F.when(F.col("now") > 0, off)),
                                                         F.max(F.when(F.col("now") <= 0, off))).first()])
            step = step.select(f"{m}_", F.when(F.col("now") > 0, F.col("t") / F.col("now")).otherwise(1.0).alias("s"))
            cur = (cur.join(step, F.col(m).eqNullSafe(F.col(f"{m}_")))
                   .select(*MARGINS, "mass", (F.col("f") * F.col("s")).alias("f")))
        cur = materialise(cur)
        if not progress.more():
            return cur.select(*MARGINS, "f")
    progress.warn(progress.left)
    return cur.select(*MARGINS, "f")


def cell_factors(cells: DataFrame, targets: dict | None = None, temper: dict = TEMPER,
                 rounds: int = MAX_ROUNDS, max_local: int = MAX_LOCAL_CELLS) -> tuple[DataFrame, bool]:
    """(source, lang, topic, f) and whether the table is small enough to broadcast."""
    given = targets or {}
    cells = materialise(cells)
    if cells.count() > max_local:
        return _rake_spark(cells, given, temper, rounds), False
    rows = cells.collect()
    mass = np.array([float(r["mass"]) for r in rows])
    codes, goals = [], []
    for m in MARGINS:
        values = sorted({r[m] for r in rows}, key=lambda v: (v is None, v or ""))
        at = {v: i for i, v in enumerate(values)}
        code = np.array([at[r[m]] for r in rows], dtype=np.int64)
        codes.append(code)
        goals.append(_targets(mass, code, values, given.get(m), temper[m]))
    f = rake_local(mass, codes, goals, rounds) if rows else np.ones(0)
    out = cells.sparkSession.createDataFrame(
        [(*[r[m] for m in MARGINS], float(x)) for r, x in zip(rows, f)],
        "source string, lang string, topic string, f double")
    return out, True


def draw(doc_id: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from the id and the seed."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, rate: float = 1.0,
        seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", temper: dict = TEMPER, rounds: int = MAX_ROUNDS,
        max_local: int = MAX_LOCAL_CELLS, topic_col: str | None = None,
        tokens_col: str | None = None, out_col: str = "mix") -> DataFrame:
    """Every row with ``out_col``: a struct of topic, tokens, weight (the raking factor),
    probability and sampled. ``targets`` gives shares per value of a margin; a margin
    without targets is tempered. Topic and tokens come from the text, or from columns
    that hold them already (then no text is needed)."""
    what = F.col(f"`{topic_col}`") if topic_col else topic(F.col(f"`{text_col}`"))
    size = F.col(f"`{tokens_col}`") if tokens_col else n_tokens(F.col(f"`{text_col}`"))
    keys = F.struct(F.col(f"`{source_col}`").cast("string").alias("source"),
                    F.col(f"`{lang_col}`").cast("string").alias("lang"), what.alias("topic"), size.alias("tokens"))
    cells = docs.select(keys.alias("k")).select("k.*").groupBy(*MARGINS).agg(F.sum("tokens").alias("mass"))
    factors, small = cell_factors(cells, targets, temper, rounds, max_local)
    top = factors.agg(F.max("f")).first()[0] or 1.0
    side = factors.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.col("f").alias("__f"))
    on = [F.col(f"__k.{m}").eqNullSafe(F.col(f"__{m}")) for m in MARGINS]
    joined = docs.withColumn("__k", keys).join(F.broadcast(side) if small else side, on, "left")
    p = F.least(F.lit(1.0), F.lit(rate) * F.col("__f") / F.lit(top))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        F.col("__k.topic").alias("topic"), F.col("__k.tokens").alias("tokens"), F.col("__f").alias("weight"),
        p.alias("probability"), (draw(F.col(f"`{id_col}`"), seed) < p).alias("sampled")).alias(out_col))


def _sql() -> str:
    steps, prev = [], "r0"
    for i in range(ROUNDS):
        for m in MARGINS:
            name = f"r{len(steps) + 1}"
            steps.append(
                f"{name} AS (SELECT source, lang, topic, mass, t_source, t_lang, t_topic, total, "
                f"f * CASE WHEN sum(mass * f) OVER (PARTITION BY {m}) > 0 "
                f"THEN t_{m} * total / sum(mass * f) OVER (PARTITION BY {m}) ELSE 1 END AS f FROM {prev})")
            prev = name
    shares = ", ".join(
        f"(CASE WHEN m_{m} > 0 THEN (m_{m} / total) ** {TEMPER[m]} ELSE 0 END) AS p_{m}" for m in MARGINS)
    goals = ", ".join(f"p_{m} / (SELECT sum(p) FROM (SELECT DISTINCT {m}, p_{m} AS p FROM sh)) AS t_{m}" for m in MARGINS)
    return rf"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
k AS (SELECT doc_id, source, lang, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
  CASE WHEN (length(t) - length(translate(t, '#*$%&|<>', ''))) * 20 > length(t) THEN 'symbols'
       WHEN (length(t) - length(replace(t, '!!', ''))) / 2.0 >= 5 THEN 'shouting'
       WHEN contains(t, '@') THEN 'contact' WHEN length(t) < 1000 THEN 'brief'
       WHEN length(t) < 4000 THEN 'article' ELSE 'longform' END AS topic FROM d),
c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS mass FROM k GROUP BY ALL),
mg AS (SELECT *, sum(mass) OVER () AS total, sum(mass) OVER (PARTITION BY source) AS m_source,
  sum(mass) OVER (PARTITION BY lang) AS m_lang, sum(mass) OVER (PARTITION BY topic) AS m_topic FROM c),
sh AS (SELECT source, lang, topic, mass, total, {shares} FROM mg),
r0 AS (SELECT source, lang, topic, mass, total, {goals}, 1.0::DOUBLE AS f FROM sh),
{", ".join(steps)},
z AS (SELECT source, lang, topic, f, f / max(f) OVER () AS p FROM {prev})
SELECT k.doc_id, k.source, k.lang, k.topic, k.tokens, round(z.f, 6) AS weight, round(least(1.0, z.p), 6) AS probability,
  (('0x' || substr(md5(coalesce(k.doc_id::VARCHAR, 'null') || ':42'), 1, 8))::BIGINT / 4294967296.0) < z.p AS sampled
FROM k JOIN z ON k.source IS NOT DISTINCT FROM z.source AND k.lang IS NOT DISTINCT FROM z.lang AND k.topic = z.topic"""


SQL = _sql()
