"""N-gram Jaccard join, size-aware: light sets by enumerated subsets, heavy sets by
inverted lists.

A document's set holds the 64-bit hashes of its distinct word n-grams. Equal sets form a
class and take part once. Two sets of sizes a and b link when their overlap is at least
c(a, b), the smallest integer that meets the threshold.

* Light sets (at most ``boundary`` elements): for every pair of sizes (a, b) a set lists
  its subsets of c(a, b) elements; two sets link exactly when they share one, so a group
  of equal subsets needs no comparison.
* Heavy sets: elements are ordered globally, those with a rare word first (a word's
  count bounds its n-grams' counts), and only the first a - ceil(t a) + 1 elements of a
  set are listed: linked sets share one of these. Short lists give their pairs (filtered
  by size and position), checked exactly on the whole sets. In a long list every set is
  first checked against one pivot, the set of least number, which is the same in most lists
  of a family; lists are then forgotten, and what is kept is which sets have which pivots.
  Of two sets of a list in different components one is outside its pivot's: such sets are
  compared with all sets that share a pivot with them (and where that moves less, also
  those that do over others), block by block, each block pair by scanning in-memory inverted
  lists of the listed elements; pairs that neither these nor counts of their elements by hash
  bucket rule out are checked exactly, again block by block. Links found there join
  components found before.

The boundary is the one with the smallest estimated cost: subsets listed for sets up to
it plus list entries beyond it. No step lists all pairs of a group, and no link between
different texts is lost.

Defined results: null texts, and texts without words, have an empty set, link with
nothing and are components of their own; rows that share an id are documents of their own
that bear the same number, linked only where their texts are alike; rows with a null id are
left out of links and returned as they are; ties do not arise (a component is named by its
smallest id); very long texts are read whole (one set in memory); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (Scratch, Shared, WordCache, byte_words, mix64, pick, shuffles_end_with_queries, spill,
                     text_bytes_conf)

#: Sets up to this size keep all elements beside the document, so any boundary up to it
#: can be chosen.
MAX_LIGHT = 20
#: Lists up to this length give all their pairs; longer ones go by pivot and blocks.
SHORT_LIST = 8
#: Sets in one block of the block comparison, and the bytes of their elements.
BLOCK, BLOCK_BYTES = 2048, 32 << 20
#: Bytes of whole sets that may be broadcast to the pairs they stand in.
BROADCAST_BYTES = 64 << 20
#: Words whose hashes a task remembers.
CACHED_WORDS = 100_000
#: Cost of a list entry, in subsets (it is shuffled, sorted and may need a check).
ENTRY_COST = 4
#: Word counts are kept in so many hash cells (4 MB) to order the elements; they never
#: decide a result.
CELL_BITS, CHUNK = 22, 1 << 12
BROADCAST_IDS = 1_000_000
#: More ids than that are marked in so many hash cells, a bit each (8 MB); a cell only spares
#: rows a move and never decides a result.
MARK_BITS, MARK_CHUNK = 26, 1 << 16
#: What _list_pairs finds.
PAIR, STAR, MEMBER = 0, 1, 2
#: Buckets of a set's sketch; it spares unlike pairs the move of their whole sets.
SKETCH = 256
_K = np.uint64(0x9E3779B97F4A7C15)


class Threshold:
    """100 * |x & y| >= percent * |x | y|, in integers."""

    def __init__(self, percent: int):
        self.t = percent

    def need(self, a, b):
        """Smallest overlap that links sets of sizes a and b (also on arrays)."""
        return -(-self.t * (a + b) // (100 + self.t))

    def smallest(self, a: int) -> int:
        """Smallest size that can link with size a."""
        return -(-self.t * a // 100)

    def prefix(self, a: int) -> int:
        return a - self.smallest(a) + 1

    def partners(self, a: int, most: int) -> list[int]:
        lo = self.smallest(a)
        return [b for b in range(lo, min(most, 100 * a // self.t) + 1) if self.need(a, b) <= min(a, b)]


class Shingler:
    """text -> sorted uint64 elements: 6 bits of order level, 58 bits of hash."""

    def __init__(self, n: int, levels: np.ndarray):
        self.n, self.levels = n, levels
        self.hash = WordCache(xxhash.xxh64_intdigest, CACHED_WORDS)

    def __call__(self, text: str | None) -> np.ndarray:
        toks = byte_words(text)
        if not toks:
            return np.empty(0, np.uint64)
        h = self.hash
        x = np.fromiter(map(h.__getitem__, toks), np.uint64, len(toks))
        lv = self.levels[x >> np.uint64(64 - CELL_BITS)].astype(np.uint64)
        k = min(self.n, len(toks))
        m = len(toks) - k + 1
        code, low = np.full(m, k, np.uint64), lv[:m]
        with np.errstate(over="ignore"):
            for i in range(k):
                code = mix64(code * _K + x[i:i + m])
                low = np.minimum(low, lv[i:i + m])
        return np.unique((low << np.uint64(58)) | (code >> np.uint64(6)))


def word_levels(docs: DataFrame, text_col: str) -> np.ndarray:
    """log2 of the number of occurrences of the words in each of 2^CELL_BITS hash cells,
    over all rows. It bounds the count of every word in the cell from above, so an
    n-gram of low level is rare for certain; words that share a cell only blur the order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordCache(xxhash.xxh64_intdigest, CACHED_WORDS)
        seen, buf, size = np.zeros(1 << CELL_BITS, np.int32), [], 0

        def add() -> None:
            if buf:
                cells, n = np.unique(np.concatenate(buf) >> np.uint64(64 - CELL_BITS), return_counts=True)
                seen[cells.astype(np.int64)] += n.astype(np.int32)
                buf.clear()

        for b in batches:
            for t in b["text"]:
                toks = byte_words(t)
                buf.append(np.fromiter(map(cache.__getitem__, toks), np.uint64, len(toks)))
                size += len(toks)
                if size > 1_000_000:
                    add()
                    size = 0
        add()
        k = np.nonzero(seen)[0]
        yield pd.DataFrame({"cell": k.astype(np.int32), "n": seen[k]})

    text_bytes_conf(docs.sparkSession)
    def pack(g: pd.DataFrame) -> pd.DataFrame:
        level = np.zeros(CHUNK, np.uint8)
        level[g["cell"].to_numpy() % CHUNK] = g["level"].to_numpy()
        return pd.DataFrame({"chunk": g["chunk"].iloc[:1], "levels": [level.tobytes()]})

    cells = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInPandas(run, "cell int, n bigint")
             .groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1")
             .select("cell", (F.col("cell") / CHUNK).cast("int").alias("chunk"),
                     F.least(F.floor(F.log2("n")), F.lit(63)).cast("int").alias("level")))
    packed = cells.groupBy("chunk").applyInPandas(pack, "chunk int, levels binary").collect()  # 4 MB at most
    levels = np.zeros(1 << CELL_BITS, np.uint8)
    for r in packed:
        levels[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["levels"], np.uint8)
    return levels


def _sets(docs: DataFrame, shingler: Shared, schema: str, row, marked: Shared | None = None) -> DataFrame:
    """``row`` of each document and its set; with ``marked`` of those whose row is marked."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, bits = shingler.value, marked and marked.value
        for b in batches:
            if marked:
                b = b[_has(bits, b["cell"].to_numpy())]
            yield pd.DataFrame([row(r, make(t)) for r, t in zip(zip(b["doc_id"], b["row"], b["text_key"]), b["text"])],
                               columns=[c.split()[0] for c in schema.split(", ")])

    cell = [_cell("row").alias("cell")] if marked else []
    return docs.select("doc_id", "row", "text_key", "text", *cell).mapInPandas(run, schema)


def _cell(number: str | Column) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(1 << MARK_BITS)).cast("int")


def _marks(ids: DataFrame, number: str) -> np.ndarray:
    """A bit for each hash cell, packed: whether one of ``ids`` falls in it."""
    def pack(g: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(MARK_CHUNK, bool)
        bits[g["cell"].to_numpy() % MARK_CHUNK] = True
        return pd.DataFrame({"chunk": g["chunk"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    cells = ids.select(_cell(number).alias("cell")).distinct().withColumn("chunk", (F.col("cell") / MARK_CHUNK).cast("int"))
    marks, wide = np.zeros(1 << MARK_BITS - 3, np.uint8), MARK_CHUNK // 8
    for r in cells.groupBy("chunk").applyInPandas(pack, "chunk int, bits binary").collect():  # 8 MB at most
        marks[r["chunk"] * wide:(r["chunk"] + 1) * wide] = np.frombuffer(r["bits"], np.uint8)
    return marks


def _has(marks: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (marks[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component (smallest node reachable) of the nodes in links (a, b). Every node
    joins the neighbour of least hash (hashes, so that no order of numbers makes long
    chains), joined nodes become one and the links between what is left are written anew:
    the graph shrinks by a constant share each round."""
    edges = scratch.spill(links.select("a", "b").where("a <> b").distinct(), "join-edges")
    maps: list[DataFrame] = []
    while edges.limit(1).count():
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), "b")).alias("near"))
        mine = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("b"))
        up = scratch.spill(near.select("node", F.least(mine, F.col("near"))["b"].alias("up")), "join-up")
        maps.append(up)
        x, y = (up.select(F.col("node").alias(c), F.col("up").alias(f"u{c}")) for c in "ab")
        edges = edges.join(x, "a").join(y, "b").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
        edges = scratch.spill(edges.where("a <> b").distinct(), "join-edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = maps[0].select("node", F.col("up").alias("root"))
    for up in maps[1:]:
        root = root.join(up.select(F.col("node").alias("root"), "up"), "root", "left").select(
            "node", F.coalesce("up", "root").alias("root"))
    root = scratch.spill(root, "join-roots")
    least = root.groupBy("root").agg(F.min("node").alias("component"))
    return scratch.spill(root.join(least, "root").select("node", "component"), "join-component")


def choose_boundary(sizes: dict[int, int], t: Threshold) -> int:
    """The light/heavy boundary of least estimated cost, from the counts of small sizes."""
    def cost(b: int) -> float:
        light = sum(h * math.comb(n, t.need(n, m)) for n, h in sizes.items() if n <= b for m in t.partners(n, b))
        return light + sum(h * t.prefix(n) * ENTRY_COST for n, h in sizes.items() if n >= t.smallest(b + 1))

    return min(range(1, MAX_LIGHT + 1), key=lambda b: (cost(b), b))


def _light_links(reps: DataFrame, boundary: int, t: Threshold, scratch: Scratch) -> DataFrame:
    """Links among sets of at most ``boundary`` elements, by common subsets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for rep, n, head in zip(b["rep"], b["n"], b["head"]):
                els = [int(x).to_bytes(8, "little", signed=True) for x in head]
                for m in t.partners(n, boundary):
                    lo, hi = min(n, m), max(n, m)
                    for sub in itertools.combinations(els, t.need(n, m)):
                        key = xxhash.xxh128_digest(bytes((lo, hi)) + b"".join(sub))
                        rows.append((key, n == lo, n == hi, rep))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "lo", "hi", "rep"])

    keys = (reps.where(F.col("n").between(1, boundary)).select("rep", "n", "head")
            .mapInPandas(run, "key binary, lo boolean, hi boolean, rep bigint"))
    keys = scratch.spill(keys, "join-subsets")
    hub = (keys.groupBy("key").agg(F.min("rep").alias("a"), F.max("lo").alias("lo"), F.max("hi").alias("hi"),
                                   F.count(F.lit(1)).alias("k")).where("lo and hi and k > 1").select("key", "a"))
    return hub.join(keys.select("key", F.col("rep").alias("b")), "key").where("a < b").select("a", "b").distinct()


def _list_pairs(entries: DataFrame, t: Threshold) -> DataFrame:
    """From entries (sid, rep, n, pos), sorted by (sid, rep) within each partition: the
    filtered pairs of short lists (a < b, kind PAIR), and of long lists every member with the
    list's first one, its pivot (a the member, b the pivot; STAR if size and position allow a
    link, else MEMBER)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        long_sid, long_pivot = None, None  # the long list that goes on

        def emit(x: pd.DataFrame) -> pd.DataFrame:
            nonlocal long_pivot
            sid, rep, n, pos = (x[c].to_numpy(np.int64) for c in ("sid", "rep", "n", "pos"))
            edge = np.r_[0, np.nonzero(np.diff(sid))[0] + 1, len(sid)]
            start = np.repeat(edge[:-1], np.diff(edge))
            size = np.repeat(np.diff(edge), np.diff(edge))
            if long_sid is not None:
                size = np.where(sid == long_sid, SHORT_LIST + 1, size)
            pairs = []
            for d in range(1, SHORT_LIST):
                if len(sid) <= d:
                    break
                i = np.nonzero((sid[d:] == sid[:-d]) & (size[:-d] <= SHORT_LIST))[0]
                j = i + d
                ok = _may_link(n[i], n[j], pos[i], pos[j], t)
                i, j = i[ok], j[ok]
                pairs.append(np.stack([np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j]), np.full(len(i), PAIR)], 1))
            k = np.nonzero(size > SHORT_LIST)[0]
            hub = np.stack([rep[start[k]], n[start[k]], pos[start[k]]])
            if long_sid is not None:
                mine = sid[k] == long_sid
                if mine.any():
                    if long_pivot is None:
                        long_pivot = hub[:, mine][:, 0]
                    hub[:, mine] = long_pivot[:, None]
            kind = np.where(_may_link(n[k], hub[1], pos[k], hub[2], t), STAR, MEMBER)
            pairs.append(np.stack([rep[k], hub[0], kind], 1))
            p = np.unique(np.concatenate(pairs), axis=0)
            return pd.DataFrame(p, columns=["a", "b", "kind"])

        for b in batches:
            x = b if held is None else pd.concat([held, b], ignore_index=True)
            if not len(x):
                continue
            last = x["sid"].iloc[-1]
            at = int(np.searchsorted(x["sid"].to_numpy(), last))
            if at:
                yield emit(x.iloc[:at])
            held = x.iloc[at:]
            if len(held) > SHORT_LIST:  # a long list streams through, however long
                if long_sid != last:
                    long_sid, long_pivot = last, None
                yield emit(held)
                held = None
        if held is not None and len(held):
            yield emit(held)

    return entries.mapInPandas(run, "a bigint, b bigint, kind int")


def _may_link(n, m, p, q, t: Threshold) -> np.ndarray:
    """The size and position filters."""
    need = t.need(n, m)
    return (need <= np.minimum(n, m)) & (np.minimum(n - p, m - q) >= need)


def _head_filter(pairs: DataFrame, reps: DataFrame, t: Threshold) -> DataFrame:
    """Drop pairs whose heads (the first elements in the global order) rule them out: up
    to the smaller last element both sets are known, beyond it at most the smaller rest
    can be common. Exact, and it moves a sixth of the sets at most."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = []
            for n, m, x, y in zip(b["n"], b["m"], b["x"], b["y"]):
                x, y = x.astype(np.int64).view(np.uint64), y.astype(np.int64).view(np.uint64)
                w = min(x[-1], y[-1])
                i, j = np.searchsorted(x, w, "right"), np.searchsorted(y, w, "right")
                common = len(np.intersect1d(x[:i], y[:j], assume_unique=True))
                ok.append(common + min(n - i, m - j) >= t.need(n, m))
            yield b.loc[ok, ["a", "b"]]

    x = reps.select(F.col("rep").alias("a"), "n", F.col("head").alias("x"))
    y = reps.select(F.col("rep").alias("b"), F.col("n").alias("m"), F.col("head").alias("y"))
    return pairs.join(x, "a").join(y, "b").mapInPandas(run, "a bigint, b bigint")


def _ends(pairs: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """rep: the sets that stand in pairs (a, b)."""
    return scratch.spill(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct(), name)


def _only(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose rep is among ``ids``, so that only these move in the joins after it
    (up to BROADCAST_IDS ids are broadcast, more are joined)."""
    return table.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "rep", "left_semi")


def sketch(els: np.ndarray) -> bytes:
    """How many elements fall in each of SKETCH hash buckets, 255 standing for more."""
    seen = np.bincount((els % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
    return np.minimum(seen, 255).astype(np.uint8).tobytes()


def _sketch_filter(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """Drop pairs whose sketches rule them out: two sets have at most the smaller count
    of a bucket in common there. Buckets full on both sides decide nothing."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x, y = (np.frombuffer(b"".join(b[c]), np.uint8).reshape(-1, SKETCH) for c in ("x", "y"))
            least = np.minimum(x, y)
            need = t.need(b["n"].to_numpy(np.int64), b["m"].to_numpy(np.int64))
            yield b.loc[(least == 255).any(axis=1) | (least.sum(axis=1, dtype=np.int64) >= need), ["a", "b"]]

    x = sets.select(F.col("rep").alias("a"), "n", F.col("sketch").alias("x"))
    y = sets.select(F.col("rep").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    return pairs.join(x, "a").join(y, "b").mapInPandas(run, "a bigint, b bigint")


def _check_pairs(pairs: DataFrame, sets: DataFrame, t: Threshold, scratch: Scratch) -> DataFrame:
    """The pairs whose whole sets meet the threshold; whole sets move only for pairs that
    their sketches leave open. The end that stands in more pairs, a pivot mostly, is the hub:
    the other ends' sets move once, hubs' sets are broadcast if they are few."""
    pairs = scratch.spill(_sketch_filter(pairs, sets, t), "join-near")
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
    ends = _few(scratch.spill(ends.groupBy("rep").agg(F.count(F.lit(1)).alias("k")), "join-near-ends"))
    of = {c: ends.select(F.col("rep").alias(c), F.struct("k", F.col("rep").alias("r")).alias(f"{c}k")) for c in "ab"}
    turned = pairs.join(of["a"], "a").join(of["b"], "b").select(
        F.greatest("ak", "bk")["r"].alias("hub"), F.least("ak", "bk")["r"].alias("leaf"))
    turned = scratch.spill(turned, "join-turned")
    held = {c: _only(sets, scratch.spill(turned.select(F.col(c).alias("rep")).distinct(), f"join-{c}s")) for c in ("hub", "leaf")}
    size = held["hub"].agg(F.sum("n")).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = []
            for x, y in zip(b["x"], b["y"]):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                ok.append(len(np.intersect1d(p, q, assume_unique=True)) >= t.need(len(p), len(q)))
            yield b.loc[ok, ["hub", "leaf"]]

    x = held["hub"].select(F.col("rep").alias("hub"), F.col("els").alias("x"))
    y = held["leaf"].select(F.col("rep").alias("leaf"), F.col("els").alias("y"))
    x = F.broadcast(x) if 8 * size <= BROADCAST_BYTES else x
    good = turned.join(y, "leaf").join(x, "hub").mapInPandas(run, "hub bigint, leaf bigint")
    return good.select(F.least("hub", "leaf").alias("a"), F.greatest("hub", "leaf").alias("b"))


def _blocks(rows: Column, elements: Column) -> Column:
    """Number of blocks for so many sets with so many elements."""
    most = F.greatest(F.ceil(rows / BLOCK), F.ceil(8 * F.coalesce(elements, F.lit(0)) / BLOCK_BYTES), F.lit(1))
    return most.cast("bigint")


def _sized(members: DataFrame) -> DataFrame:
    """family, js and is (blocks of all and of rest), moves (sets dealt to block pairs)."""
    rest = F.when(F.col("rest"), F.col("n"))
    sized = members.groupBy("family").agg(F.count(F.lit(1)).alias("size"), F.count_if("rest").alias("rests"),
                                          F.sum("n").alias("all"), F.sum(rest).alias("some"))
    sized = sized.withColumn("js", _blocks(F.col("size"), F.col("all"))).withColumn("is", _blocks(F.col("rests"), F.col("some")))
    return sized.select("family", "js", "is", (F.col("size") * F.col("is") + F.col("rests") * F.col("js")).alias("moves"))


def _members(inside: DataFrame, scratch: Scratch) -> DataFrame:
    """family, rep, n, component, rest (outside a component that all others are in, or all but
    rest sets) from ``inside``: rep, n, component, pivot, theirs (the pivot's component). Sets
    that share a list share a pivot. A family is what pivots connect, directly or over others,
    or each pivot's sets are one of their own, whichever moves fewer sets: large tables connect
    nearly all sets by chance."""
    fam = components(inside.select(F.col("pivot").alias("a"), F.col("rep").alias("b")), scratch)
    of = inside.join(fam.select(F.col("node").alias("pivot"), F.col("component").alias("whole")), "pivot")
    outside = F.col("component") != F.col("theirs")
    stars = of.select("whole", F.col("pivot").alias("family"), "rep", "n", "component", outside.alias("rest"))
    whole = of.groupBy(F.col("whole").alias("family"), "rep").agg(
        F.first("n").alias("n"), F.first("component").alias("component"), F.max(outside).alias("rest"))
    stars, whole = scratch.spill(stars, "join-stars-of"), scratch.spill(whole, "join-whole")
    apart = _sized(stars).join(stars.select("family", "whole").distinct(), "family").groupBy("whole").agg(F.sum("moves").alias("apart"))
    fewer = _sized(whole).select("family", "moves").join(apart.withColumnRenamed("whole", "family"), "family")
    fewer = scratch.spill(fewer.select("family", (F.col("moves") > F.col("apart")).alias("split")), "join-split")
    cols = ["family", "rep", "n", "component", "rest"]
    split = fewer.where("split").select(F.col("family").alias("whole"))
    return scratch.spill(stars.join(split, "whole", "left_semi").select(*cols).unionByName(
        whole.join(fewer.where("not split"), "family", "left_semi").select(*cols)), "join-members")


def _block_pairs(members: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """Pairs of different components of a family that their heads do not rule out: of each
    rest set and block pair (family, i, j) the sets ``bs``, with components. Every block of rest
    sets meets every block of the family, by inverted lists over the heads (elements common to
    two heads are all the common ones up to the smaller last one; beyond it at most the
    smaller rest can be common), then by sketches, so that few pairs leave the task."""
    m = members.join(_sized(members), "family")
    key = F.xxhash64("rep")
    left = (m.where("rest").withColumn("i", F.pmod(key, "is"))
            .withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("js") - 1))).withColumn("side", F.lit(0)))
    right = (m.withColumn("j", F.pmod(key, "js"))
             .withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("is") - 1))).withColumn("side", F.lit(1)))
    cols = ["family", "i", "j", "side", "rep", "component"]
    keep = F.when(F.col("n") <= MAX_LIGHT, F.col("n")).otherwise(F.col("n") - F.ceil(F.col("n") * t.t / 100) + 1).cast("int")
    heads = sets.select("rep", "n", F.col("els").substr(F.lit(1), 8 * keep).alias("head"), "sketch")
    dealt = left.select(*cols).union(right.select(*cols)).join(heads, "rep")

    def run(g: pd.DataFrame) -> pd.DataFrame:
        lhs, rhs = g[g["side"] == 0], g[g["side"] == 1]
        names = ["family", "i", "j", "a", "component", "bs", "others"]
        if not len(lhs) or not len(rhs):
            return pd.DataFrame(columns=names)
        arrays = [np.frombuffer(e, np.uint64) for e in rhs["head"]]
        size, held = rhs["n"].to_numpy(np.int64), np.array([len(a) for a in arrays])
        last = np.array([a[-1] for a in arrays], np.uint64)
        els = np.concatenate(arrays)
        owner = np.repeat(np.arange(len(arrays)), held)
        order = np.argsort(els, kind="stable")
        els, owner = els[order], owner[order]
        reps_of, comps = rhs["rep"].to_numpy(), rhs["component"].to_numpy()
        at, out = [g[c].iloc[0] for c in names[:3]], []
        sketches = np.frombuffer(b"".join(rhs["sketch"]), np.uint8).reshape(-1, SKETCH)
        for rep, comp, n, e, s in zip(lhs["rep"], lhs["component"], lhs["n"], lhs["head"], lhs["sketch"]):
            own = np.frombuffer(s, np.uint8)
            x = np.frombuffer(e, np.uint64)
            lo, hi = np.searchsorted(els, x, "left"), np.searchsorted(els, x, "right")
            hits = owner[np.repeat(lo, hi - lo) + _ramp(hi - lo)]
            common = np.bincount(hits, minlength=len(arrays))
            theirs = np.bincount(owner[:np.searchsorted(els, x[-1], "right")], minlength=len(arrays))
            beyond = np.minimum(n - np.searchsorted(x, last, "right"), size - theirs)
            k = np.nonzero((common > 0) & (common + beyond >= t.need(n, size)) & (comps != comp))[0]
            least = np.minimum(sketches[k], own)
            k = k[(least == 255).any(axis=1) | (least.sum(axis=1, dtype=np.int64) >= t.need(n, size[k]))]
            if len(k):
                out.append((*at, rep, comp, reps_of[k], comps[k]))
        return pd.DataFrame(out, columns=names)

    return dealt.groupBy("family", "i", "j").applyInPandas(
        run, "family bigint, i bigint, j bigint, a bigint, component bigint, bs array<bigint>, others array<bigint>")


def _block_links(close: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """Links among the pairs of ``_block_pairs``, as many as join components. A whole set moves
    once for each block pair that it stands in, however many sets are close to it there, and
    sets that others have joined there are not compared."""
    at = ["family", "i", "j"]
    ends = close.select(*at, F.col("a").alias("rep")).union(close.select(*at, F.explode("bs"))).distinct()
    whole = ends.toDF("f", "p", "q", "rep").join(sets.select("rep", "els"), "rep")

    def run(pairs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        els = {r: np.frombuffer(e, np.uint64) for r, e in zip(held["rep"], held["els"])}
        up, out = {}, []

        def top(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        for a, c, bs, others in zip(pairs["a"], pairs["component"], pairs["bs"], pairs["others"]):
            for b, d in zip(bs.tolist(), others.tolist()):
                x, y = top(c), top(d)
                if x != y and len(np.intersect1d(els[a], els[b], assume_unique=True)) >= t.need(len(els[a]), len(els[b])):
                    up[y] = x
                    out.append((min(a, b), max(a, b)))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return close.groupBy(*at).cogroup(whole.groupBy("f", "p", "q")).applyInPandas(run, "a bigint, b bigint").distinct()


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for every length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def join_components(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; with ``key_col`` also that column, a
    hash of the row's text."""
    scratch = Scratch(docs.sparkSession)
    with shuffles_end_with_queries(docs.sparkSession):
        found = spill(_join(docs, n, percent, id_col, text_col, scratch), "join-result")
    scratch.drop()
    found = found.withColumnRenamed("doc_id", id_col)
    return found.withColumnRenamed("text_key", key_col) if key_col else found.drop("text_key")


def _join(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    spark = docs.sparkSession
    text_bytes_conf(spark)
    t = Threshold(percent)
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    shingler = Shared(spark, Shingler(n, word_levels(d, "text")))
    d = _row_keys(d, scratch)

    def head(row, els):
        k = len(els) if len(els) <= MAX_LIGHT else t.prefix(len(els))
        return *row, len(els), xxhash.xxh128_digest(els.tobytes()), els[:k].view(np.int64)

    known = d.where("doc_id is not null")
    docs_sets = scratch.spill(_sets(known, shingler, "doc_id bigint, row bigint, text_key bigint, n int, fp binary, "
                                    "head array<bigint>", head), "join-docs")
    classes = scratch.spill(docs_sets.where("n > 0").groupBy("fp", "n").agg(F.min("row").alias("rep")), "join-classes")
    # one row of each class; rows that repeat one another share their number
    firsts = docs_sets.where("n > 0").join(_few(classes.select(F.col("rep").alias("row"))), "row", "left_semi")
    firsts = firsts.select(F.col("row").alias("rep"), "fp", "n", "head")
    reps = scratch.spill(firsts.where("rep >= 0").unionByName(firsts.where("rep < 0").dropDuplicates(["rep"])), "join-reps")
    docs_sets = scratch.spill(docs_sets.drop("head"), "join-rows")
    scratch.free("join-docs")
    sizes = {r["n"]: r["count"] for r in reps.where(F.col("n") <= 2 * MAX_LIGHT).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, t)
    links = [_light_links(reps, boundary, t, scratch)]

    heavy = reps.where(F.col("n") >= t.smallest(boundary + 1))
    keep = F.col("n") - F.ceil(F.col("n") * t.t / 100).cast("int") + 1
    entries = heavy.select("rep", "n", F.posexplode(F.slice("head", F.lit(1), keep)).alias("pos", "sid"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = scratch.spill(_list_pairs(entries.select("sid", "rep", "n", "pos").repartition(parts, "sid")
                                      .sortWithinPartitions("sid", "rep"), t), "join-lists")
    short = found.where(F.col("kind") == PAIR).select("a", "b")
    # members of long lists with their pivots; from here on lists are forgotten
    stars = scratch.spill(found.where(F.col("kind") != PAIR).groupBy(F.col("a").alias("rep"), F.col("b").alias("pivot"))
                          .agg(F.min("kind").alias("kind")), "join-stars")
    star = stars.where((F.col("kind") == STAR) & (F.col("rep") != F.col("pivot"))).select(
        F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
    near = scratch.spill(short.union(star).distinct(), "join-candidates")
    scratch.free("join-lists")
    pairs = scratch.spill(_head_filter(near, _only(heavy, _ends(near, "join-ends", scratch)), t), "join-pairs")
    wanted = scratch.spill(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(stars.select("rep")).distinct(),
                           "join-wanted")
    links[0] = scratch.spill(links[0], "join-light")
    scratch.free("join-reps", "join-subsets", "join-candidates")  # from here on heads are cut from whole sets
    texts = known.where("row >= 0").unionByName(known.where("row < 0").dropDuplicates(["row"]))
    few, marked = wanted.count() <= BROADCAST_IDS, None
    if few:
        texts = _only(texts.withColumn("rep", F.col("row")), wanted)
    else:  # texts stay where they are, and a set or two more are made
        marked = Shared(spark, _marks(wanted, "rep"))
    sets = scratch.spill(_sets(texts, shingler, "rep bigint, n int, sketch binary, els binary",
                               lambda row, e: (row[1], len(e), sketch(e), e.tobytes()), marked), "join-sets")
    links.append(_check_pairs(pairs, sets, t, scratch))
    label = components(links[0].union(links[1]), scratch)

    # members of a long list that are not in its pivot's component yet
    parted = _components_of(stars, label, "rep", "component").select("rep", "pivot", "component")
    parted = _components_of(parted, label, "pivot", "theirs")
    parted = scratch.spill(parted, "join-parted")
    opened = parted.where("component <> theirs")
    if opened.limit(1).count():
        # all sets of the pivots that have such a member
        hubs = _few(scratch.spill(opened.select("pivot").distinct(), "join-open-pivots"))
        inside = parted.join(hubs, "pivot", "left_semi").join(sets.select("rep", "n"), "rep")
        members = _members(scratch.spill(inside, "join-inside"), scratch)
        ids = scratch.spill(members.select("rep").distinct(), "join-rest")
        close = scratch.spill(_block_pairs(members, _only(sets, ids), t), "join-close")
        label = _merge(label, _block_links(close, sets, t), scratch)
    scratch.free("join-sets")

    rep_of = docs_sets.where("n > 0").alias("d").join(
        classes.alias("r"), (F.col("d.fp") == F.col("r.fp")) & (F.col("d.n") == F.col("r.n")))
    rep_of = rep_of.select("d.doc_id", "d.row", "d.text_key", "d.n", "r.rep")
    whole = (rep_of.join(label, F.col("rep") == F.col("node"), "left")
             .select("doc_id", "row", "text_key", F.col("n").cast("bigint").alias("n_shingles"),
                     F.coalesce("component", "rep").alias("component")))
    empty = docs_sets.where("n = 0").select("doc_id", "row", "text_key", F.lit(0).cast("bigint").alias("n_shingles"),
                                            F.col("row").alias("component"))
    whole = whole.unionByName(empty)
    # rows of repeated ids have numbers of their own: their components get the smallest id
    odd = scratch.spill(whole.where("component < 0 or row < 0").select("component").distinct(), "join-odd")
    if odd.limit(1).count():
        named = whole.join(odd, "component", "left_semi").groupBy("component").agg(F.min("doc_id").alias("component_id"))
        whole = whole.join(named, "component", "left")
        whole = whole.withColumn("component_id", F.coalesce("component_id", "component"))
    else:
        whole = whole.withColumn("component_id", F.col("component"))
    cols = ["doc_id", "n_shingles", "component_id", "text_key"]
    nameless = _sets(d.where("doc_id is null"), shingler, "doc_id bigint, n_shingles bigint, text_key bigint",
                     lambda row, e: (None, len(e), row[2])).withColumn("component_id", F.lit(None).cast("bigint"))
    return whole.select(*cols).unionByName(nameless.select(*cols))


def _few(table: DataFrame) -> DataFrame:
    """The (written) table, broadcast if it has at most BROADCAST_IDS rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _components_of(table: DataFrame, label: DataFrame, node: str, out: str) -> DataFrame:
    """``table`` with the component of its column ``node`` (itself if it has no link)."""
    named = label.select(F.col("node").alias(node), F.col("component").alias("named"))
    return table.join(named, node, "left").withColumn(out, F.coalesce("named", node)).drop("named")


def _merge(label: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``label`` with new links, which join whole components: only these are worked on."""
    links = scratch.spill(links, "join-new-links")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    alone = ends.join(label, "node", "left_anti").select("node", F.col("node").alias("component"))
    label = scratch.spill(label.unionByName(alone), "join-labels")
    x, y = (label.select(F.col("node").alias(c), F.col("component").alias(f"u{c}")) for c in "ab")
    joined = components(links.join(x, "a").join(y, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b")), scratch)
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return scratch.spill(label.join(joined, "component", "left").select(
        "node", F.coalesce("whole", "component").alias("component")), "join-labels")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The documents without those that have a smaller id in their component (rows with
    a null id stay). Of rows that share an id, only those whose text has one go."""
    key = "text_key"
    while key in docs.columns:
        key += "_"
    gone = "gone"
    while gone in docs.columns:
        gone += "_"
    found = join_components(docs, n, percent, id_col, text_col, key_col=key)
    lost = spill(found.where(F.col(id_col) > F.col("component_id")).select(F.col(id_col).alias(gone), key).distinct(), "join-gone")
    same = (F.col(f"`{id_col}`").cast("bigint") == F.col(gone)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(key))
    if lost.count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(lost), same, "left_anti")
    # only rows whose id falls in the cell of a lost one move
    marks = Shared(docs.sparkSession, _marks(lost, gone))

    @F.pandas_udf("boolean")
    def marked(cells: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = marks.value
        for c in cells:
            yield pd.Series(_has(bits, c.to_numpy()))

    maybe = marked(_cell(F.col(f"`{id_col}`").cast("bigint")))
    return docs.where(~maybe).unionByName(docs.where(maybe).join(lost, same, "left_anti"))


def _row_keys(d: DataFrame, scratch: Scratch) -> DataFrame:
    """``d`` with ``text_key``, a hash of the text, and ``row``: the id, or for rows whose id
    stands more than once a negative number from id and text (repeated rows share it). Ids
    that stand once, all of them in a sound table, are found by a count that reads no text."""
    d = d.withColumn("text_key", F.xxhash64("text"))
    again = scratch.spill(d.where("doc_id is not null").groupBy("doc_id").count().where("count > 1 or doc_id < 0")
                          .select(F.col("doc_id").alias("again")), "join-again")
    if not again.limit(1).count():
        return d.select("doc_id", F.col("doc_id").alias("row"), "text_key", "text")
    few = again.count() <= BROADCAST_IDS
    own = -F.shiftrightunsigned(F.xxhash64("doc_id", "text_key", F.length("text")), 1) - 1
    return d.join(F.broadcast(again) if few else again, F.col("doc_id") == F.col("again"), "left").select(
        "doc_id", F.when(F.col("again").isNull(), F.col("doc_id")).otherwise(own).alias("row"), "text_key", "text")
