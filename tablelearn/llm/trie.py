"""Prefix trie of conversations by union-find over the LCP edges of sorted neighbours.

``turns`` makes one row of hashed turns a conversation (texts go no further), ``share_heads``
puts another conversation's first turns before it, and ``trie`` builds the trie of any table
of sequences: one row for each distinct prefix.

The sequences are range-partitioned and sorted by (turns, id), so the members of a prefix
stand together and a prefix with a third of all conversations is spread over many tasks, and
so are copies of one conversation. Each task links sorted neighbours by the length of their
longest common prefix (LCP) and takes these edges in descending depth: two components that
meet at depth d become children of a branching node of depth d (or the deeper one becomes a
child of the other's top, if that has depth d already). Between branching nodes there are
chains of nodes with the same members.

A node that holds neither the first nor the last sequence of its task is complete: no other
task has a member of it. All others lie on the paths to these two sequences, so a task's
forest contracts to two spines, each as long as a conversation. Spines of all tasks are
merged by the hash of the prefix: members add up, children are counted once. Sums over
subtrees need no walk: every merged node counts on one spine only, each spine adds up from
its deep end, and sums of the same prefix add up over the spines that hold it.

Turns are compared by MD5 of role and text, prefixes by MD5 chains. A conversation is one row
of 24 bytes a turn. The digest of a node's ends is one SHA-256 by contract, so its ids pass
through one task, as a stream of bounded chunks.

Defined results: null roles and texts are empty; null turns come first; ties of a turn go by
role, then by hash; repeated rows are repeated turns; rows with a null id belong to no
conversation and are left out; very long texts count as their code points; an empty table
has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import pick, spill

ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
CHUNK_IDS = 8192
COMPLETE, SPINE, ENDS = 0, 1, 2

FOREST = ("kind int, part bigint, side int, depth bigint, id binary, parent_id binary, conv_id bigint, "
          "parent_conv_id bigint, n bigint, n_children bigint, n_leaves bigint, saved bigint, chars bigint, ends string")


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """conv_id, seq: array of (key, chars) in the order of turns."""
    c = pick(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    row = F.struct(F.col("turn").isNotNull().alias("known"), "turn", role.alias("role"), key.alias("key"),
                   F.length(text).cast("bigint").alias("chars"))
    rows = c.where("conv_id is not null").groupBy(F.col("conv_id").cast("bigint").alias("conv_id"))
    return rows.agg(F.sort_array(F.collect_list(row)).alias("rows")).select(
        "conv_id", F.transform("rows", lambda r: F.struct(r["key"].alias("key"), r["chars"].alias("chars"))).alias("seq"))


def share_heads(seqs: DataFrame, base: Column, n: Column, most: int) -> DataFrame:
    """Each sequence's first ``n`` turns replaced by those of conversation ``base`` (both
    columns over conv_id; ``n`` at most ``most``): all if it has fewer, none if there is none."""
    heads = seqs.select(F.col("conv_id").alias("base"), F.slice("seq", 1, most).alias("head"))
    d = seqs.withColumns({"base": base, "n": n.cast("int")}).join(heads, "base", "left")
    none = F.slice("seq", 1, 0)
    return d.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("n")), none),
                                        F.slice("seq", F.col("n") + 1, F.size("seq"))).alias("seq"))


def _lcp(a: list, b: list) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] equal, a[:hi] not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


class Forest:
    """The compact trie of sorted sequences: one leaf a distinct sequence, one node a merge."""

    def __init__(self) -> None:
        self.ids: list[list[int]] = []      # per distinct sequence: its conversations
        self.chars: list[list[int]] = []    # code points of its turns
        self.edges: list[int] = []          # LCP with the next one
        self.first: list[bytes] | None = None
        self.last: list[bytes] = []

    def add(self, conv_id: int, keys: list[bytes], chars: list[int]) -> None:
        if self.first is None:
            self.first = keys
        elif keys == self.last:
            self.ids[-1].append(conv_id)
            return
        else:
            self.edges.append(_lcp(self.last, keys))
        self.last = keys
        self.ids.append([conv_id])
        self.chars.append(chars)

    def link(self) -> None:
        """Kruskal's order, deepest edges first; left to right among equals."""
        m = len(self.ids)
        self.depth = [len(c) for c in self.chars]
        self.left, self.right = list(range(m)), list(range(m))
        self.kids: list[list[int]] = [[] for _ in range(m)]
        self.up: list[int | None] = [None] * m
        root, top, size = list(range(m)), list(range(m)), [1] * m

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in sorted(range(m - 1), key=lambda j: -self.edges[j]):
            a, b, d = find(i), find(i + 1), self.edges[i]
            node, other = top[a], top[b]
            if self.depth[node] != d:
                new = len(self.depth)
                self.depth.append(d)
                self.left.append(self.left[node])
                self.right.append(self.right[node])
                self.kids.append([node])
                self.up.append(None)
                self.up[node], node = new, new
            self.kids[node].append(other)
            self.up[other], self.right[node] = node, self.right[other]
            if size[a] < size[b]:
                a, b = b, a
            root[b], top[a], size[a] = a, node, size[a] + size[b]

    def rows(self, part: int) -> Iterator[tuple]:
        """Rows of FOREST: complete nodes, spine nodes with what hangs off them, ends."""
        if self.first is None:
            return
        self.link()
        m, total = len(self.ids), [0]
        for ids in self.ids:
            total.append(total[-1] + len(ids))
        paths = [_chain(self.first), _chain(self.last)]
        n_nodes = len(self.depth)
        low, leaves, saved = [0] * n_nodes, [0] * n_nodes, [0] * n_nodes
        for x in sorted(range(n_nodes), key=lambda j: -self.depth[j]):
            kids, up = self.kids[x], self.up[x]
            closed = [k for k in kids if not self._open(k)]
            low[x] = min([low[k] for k in kids] + (self.ids[x][:1] if x < m else []))
            leaves[x] = sum(leaves[k] for k in kids) if kids else 1
            n = total[self.right[x] + 1] - total[self.left[x]]
            chars, above = self.chars[self.left[x]], -1 if up is None else self.depth[up]
            at = sum(saved[k] for k in kids)
            for e in range(self.depth[x], above, -1):
                bottom = e == self.depth[x]
                at += (n - 1) * (chars[e - 1] if e else 0)
                ids = self.ids[x] if bottom and x < m else []
                if not self._open(x):
                    parent_id = paths[self.left[up] > 0][above] if e - 1 == above and self._open(up) else None
                    parent = None if parent_id else ("up" if e - 1 == above else "self")
                    yield (COMPLETE, part, parent, x, e, parent_id, n, len(kids) if bottom else 1, leaves[x], at,
                           hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else NO_ENDS)
                    continue
                counted = False
                for side, touches in enumerate((self.left[x] == 0, self.right[x] == m - 1)):
                    if not touches:
                        continue
                    path = paths[side]
                    hang = (low[x], n, len(closed) if bottom else 0, sum(leaves[k] for k in closed) if bottom else 0,
                            sum(saved[k] for k in closed) if bottom else 0) if not counted else (None, 0, 0, 0, 0)
                    counted = True
                    yield (SPINE, part, side, e, path[e], path[e - 1] if e else None, hang, chars[e - 1] if e else 0)
                for at_id in range(0, len(ids), CHUNK_IDS):
                    yield (ENDS, part, at_id, paths[self.left[x] > 0][e], ",".join(map(str, ids[at_id:at_id + CHUNK_IDS])))
            saved[x] = at
        self.low = low

    def _open(self, x: int) -> bool:
        return self.left[x] == 0 or self.right[x] == len(self.ids) - 1


def _chain(keys: list[bytes]) -> list[bytes]:
    """Hashes of all prefixes, the root's first."""
    out = [ROOT]
    for k in keys:
        out.append(hashlib.md5(out[-1] + k).digest())
    return out


def _records(forest: Forest, part: int) -> Iterator[tuple]:
    """The rows in the columns of FOREST (a parent's least member is known after the child's)."""
    late = []
    for r in forest.rows(part):
        if r[0] == SPINE:
            _, _, side, depth, key, parent, (low, n, kids, leaves, saved), chars = r
            yield (SPINE, part, side, depth, key, parent, low, None, n, kids, leaves, saved, chars, None)
        elif r[0] == ENDS:
            yield (ENDS, part, 0, r[2], r[3], None, None, None, 0, 0, 0, 0, 0, r[4])
        else:
            late.append(r)
    for _, _, parent, x, depth, parent_id, n, kids, leaves, saved, ends in late:
        above = None if parent is None else forest.low[x if parent == "self" else forest.up[x]]
        yield (COMPLETE, part, 0, depth, None, parent_id, forest.low[x], above, n, kids, leaves, saved, 0, ends)


def _forests(seqs: DataFrame) -> DataFrame:
    names = [f.split()[0] for f in FOREST.split(", ")]
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in FOREST.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import islice

        from pyspark import TaskContext

        forest = Forest()
        for b in batches:
            for conv_id, keys, chars in zip(b.column("conv_id").to_pylist(), b.column("keys").to_pylist(),
                                            b.column("chars").to_pylist()):
                forest.add(conv_id, keys, chars)
        records = _records(forest, TaskContext.get().partitionId())
        while block := list(islice(records, 20_000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*block))], schema=schema)

    return seqs.mapInArrow(run, FOREST)


def _stream_digests(chunks: DataFrame) -> DataFrame:
    """id, ends: SHA-256 of each id's chunks in the order of (part, depth), comma-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            ids, out = [], []
            for key, text in zip(b.column("id").to_pylist(), b.column("ends").to_pylist()):
                if key == at:
                    state.update(b",")
                else:
                    if at is not None:
                        ids.append(at)
                        out.append(state.hexdigest())
                    at, state = key, hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(out, pa.string())], ["id", "ends"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], ["id", "ends"])

    return chunks.repartition("id").sortWithinPartitions("id", "part", "depth").select("id", "ends").mapInArrow(
        run, "id binary, ends string")


def trie(seqs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The trie of ``seqs`` (conv_id bigint, unique; seq array of (key binary, chars bigint)):
    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, one row for each distinct prefix."""
    s = seqs.select("conv_id", F.col("seq.key").alias("keys"), F.col("seq.chars").alias("chars"))
    by = (F.col("keys"), F.col("conv_id"))
    s = s.repartitionByRange(partitions, *by) if partitions else s.repartitionByRange(*by)
    f = spill(_forests(s.sortWithinPartitions(*by)), "trie-forests")
    spines = f.where(F.col("kind") == SPINE)

    # merge the spines: one row a prefix
    merged = spines.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_id").alias("parent_id"),
        F.sum("n").alias("n"), F.sum("n_children").alias("closed"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.max("chars").alias("chars"), F.min(F.struct("part", "side")).alias("owner"))
    merged = spill(merged, "trie-spines")
    kids = merged.where("parent_id is not null").groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("open"))
    n_children = F.col("closed") + F.coalesce("open", F.lit(0))
    nodes = merged.join(kids, "id", "left").select(
        "id", "conv_id", "depth", "parent_id", "n", n_children.alias("n_children"), "owner",
        (F.col("leaves") + F.when(n_children == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved"))

    # sums over subtrees: each node counts on its owner's spine, spines add up from the deep end
    own = nodes.select("id", "owner", "leaves", "saved")
    here = F.col("owner") == F.struct("part", "side")
    deep = Window.partitionBy("part", "side").orderBy(F.col("depth").desc())
    sums = spines.select("id", "part", "side", "depth").join(own, "id").select("id", *[
        F.sum(F.when(here, F.col(c)).otherwise(0)).over(deep).alias(c) for c in ("leaves", "saved")])
    sums = sums.groupBy("id").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    up = merged.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    ends = _stream_digests(f.where(F.col("kind") == ENDS))
    opened = nodes.drop("leaves", "saved").join(sums, "id").join(ends, "id", "left").join(up, "parent_id", "left")
    closed = f.where(F.col("kind") == COMPLETE).withColumnsRenamed({"n_leaves": "leaves", "saved": "tokens"})
    inner = closed.where("parent_id is null")
    outer = closed.where("parent_id is not null").drop("parent_conv_id").join(up, "parent_id")
    cols = ["conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children"]
    done = [x.select(*cols, F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens"),
                     F.col("ends").alias("ends_sha256")) for x in (inner, outer)]
    return done[0].unionByName(done[1]).unionByName(opened.select(
        *cols, "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")))
