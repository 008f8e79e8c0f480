"""Line dedup by site-relative frequency: the share of a host's pages that hold a line;
lines above the ratio are boilerplate and dropped. DataFrame functions only.

A page holds a line once however often it repeats it; lines without a word are never
boilerplate. A line is dropped when it is on at least ``min_pages`` pages of the host
and on more than ``max_ratio`` of them.

Defined results: null hosts form one host of their own; a null text has no lines and
stays null; every input row is a page (repeated rows count each); an empty table gives
an empty result; other columns pass through unchanged. Very long texts are split into all
their lines; a line exactly at the ratio stays.

Scale: the first pass counts 8-byte line hashes per host (partial sums in each task, so
a hot host or line is no hot key), the second counts the exact text of only those lines
whose hash passes. What survives is at most (mean lines per page / max_ratio) lines a
host; it is joined as one array per host, broadcast only when its measured size allows,
otherwise by a join whose hot host adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Broadcast the boilerplate lines up to this many bytes; beyond it a shuffled join.
BROADCAST_BYTES = 32 << 20


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def boilerplate_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                      max_ratio: float = 0.1, min_pages: int = 4) -> DataFrame:
    """host, line, pages, total for every line above the ratio."""
    d = docs.select(F.col(f"`{host_col}`").alias("host"), F.col(f"`{text_col}`").alias("text"))
    totals = d.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    hashes = d.select("host", F.explode(F.array_distinct(F.transform(
        _lines(F.col("text")), lambda x: F.xxhash64(x)))).alias("h"))
    maybe = (hashes.groupBy("host", "h").agg(F.count(F.lit(1)).alias("pages"))
             .where(F.col("pages") >= min_pages))
    maybe = (maybe.alias("m").join(totals.alias("t"), F.col("m.host").eqNullSafe(F.col("t.host")))
             .where(F.col("m.pages") > F.lit(max_ratio) * F.col("t.total"))
             .select("m.host", "m.h", "t.total"))
    maybe = materialise(maybe)
    lines = d.select("host", F.explode(F.array_distinct(_lines(F.col("text")))).alias("line"))
    small = maybe.count() * 32 <= BROADCAST_BYTES
    exact = (lines.withColumn("h", F.xxhash64("line")).alias("l")
             .join((F.broadcast(maybe) if small else maybe).alias("m"),
                   F.col("l.host").eqNullSafe(F.col("m.host")) & (F.col("l.h") == F.col("m.h")))
             .groupBy("l.host", "l.line").agg(F.count(F.lit(1)).alias("pages"),
                                              F.max("m.total").alias("total")))
    return exact.where((F.col("pages") >= min_pages)
                       & (F.col("pages") > F.lit(max_ratio) * F.col("total")))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                     max_ratio: float = 0.1, min_pages: int = 4,
                     count_col: str | None = None) -> DataFrame:
    """The rows with boilerplate lines removed from the text, and with ``count_col`` (if
    named) the number of lines dropped. ``n_chars`` follows the text where present."""
    cols = docs.columns
    found = boilerplate_lines(docs, host_col, text_col, max_ratio, min_pages)
    per_host = materialise(found.groupBy("host").agg(F.collect_set("line").alias("drop")))
    size = per_host.agg(F.sum(F.aggregate("drop", F.lit(0).cast("bigint"),
                                          lambda a, x: a + F.octet_length(x) + 16))).first()[0] or 0
    side = per_host.select(F.col("host").alias("__host"), F.col("drop").alias("__drop"))
    joined = docs.join(F.broadcast(side) if size <= BROADCAST_BYTES else side,
                       F.col(f"`{host_col}`").eqNullSafe(F.col("__host")), "left")
    text, bad = F.col(f"`{text_col}`"), F.col("__drop")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(bad, x)), "\n")
    new = F.when(bad.isNull(), text).otherwise(kept)
    dropped = F.when(bad.isNull() | text.isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.split(text, "\n"), lambda x: F.array_contains(bad, x))))
    outs = [(new if c == text_col else F.length(new).cast("bigint") if c == "n_chars"
             else F.col(f"`{c}`")).alias(c) for c in cols]
    extra = [dropped.cast("bigint").alias(count_col)] if count_col else []
    return joined.select(*outs, *extra)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
tot AS (SELECT source, count(*) AS total FROM d GROUP BY source),
ln AS (SELECT rid, doc_id, source, text, unnest(string_split(text, chr(10))) AS l,
         generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d),
pg AS (SELECT source, l, count(DISTINCT rid) AS pages FROM ln
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY source, l),
bad AS (SELECT pg.source, pg.l FROM pg JOIN tot ON pg.source IS NOT DISTINCT FROM tot.source
        WHERE pages >= 4 AND pages > 0.1 * total),
j AS (SELECT ln.rid, ln.k, ln.l, bad.l IS NOT NULL AS gone
      FROM ln LEFT JOIN bad ON ln.source IS NOT DISTINCT FROM bad.source AND ln.l = bad.l),
r AS (SELECT rid, string_agg(l, chr(10) ORDER BY k) FILTER (NOT gone) AS text,
        count(*) FILTER (gone) AS n FROM j GROUP BY rid)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text,
  coalesce(r.n, 0)::BIGINT AS n_dropped
FROM d LEFT JOIN r USING (rid)"""
