"""Best-fit-decreasing packing of tokenised documents into sequences of fixed length.

``pieces`` tokenises every whole text and cuts only documents longer than a sequence.
``place`` packs any table of items with a length: longest first, each into the tightest
sequence that still has room, found in a segment tree over remaining capacities.

Items of one length are interchangeable, so the packing depends on nothing but how many
items of each length there are: at most ``capacity`` numbers, at every size of the input.
Only this histogram reaches the driver. There the tree is asked once for each *run* of
equal sequences instead of once for each item: a sequence with ``r`` tokens free that is the
tightest for length L takes ``r // L`` items in a row (with r - L free it is tighter still),
and all sequences with the same room behave alike. The outcome is that of packing item by
item (tested). Each run says which ranks of its length go into which sequences. An item's
rank among those of its length is its rank within its task plus the counts of earlier tasks
(a window over one row per length and task), so no length is gathered, however frequent.

The marked items are written to the shared checkpoint folder once; ranks and offsets refer
to the tasks that wrote them, so a lost executor changes nothing.

Defined results: null and empty texts are documents of one token (the end id); null ids and
repeated rows are documents of their own; ties between equal lengths go by task and row, so
sequence numbers may differ between runs while the number of sequences and their fill do
not; very long texts are cut into whole sequences and a rest; an empty table gives an empty
result; ``place`` passes extra columns through and ``pieces`` returns its own only. Lengths
that are null, below 1 or above the capacity raise an error.
"""

from __future__ import annotations

import os
import re
import struct
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Shared, arrow_words, per_worker, pick, spill, text_bytes_conf

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
#: The plan has some ten rows for each possible length; beyond this it would not be small.
MAX_CAPACITY = 1 << 20

_PIECES = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")
_PRINTABLE = re.compile(r"[!-~]+")
#: Latin letters that NFC leaves alone and whose lower case is one letter by itself.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: The byte-level step writes a byte as the character of its number, and bytes without a
#: visible one as the characters from 256 on.
_HIDDEN = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b != 173))}


class Recent(dict):
    """word -> value of ``fn``; keeps the words asked for most lately, twice ``limit`` at most."""

    def __init__(self, fn: Callable, limit: int):
        super().__init__()
        self.fn, self.limit, self.before = fn, limit, {}

    def __missing__(self, word):
        value = self.before.get(word)
        if value is None:
            value = self.fn(word)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[word] = value
        return value


class Coder(Recent):
    """word (UTF-8) -> its ids as little-endian 32-bit integers.

    The tokenizer drops white space, and nothing it does reaches over it, so the ids of a
    text are those of its words one after the other. It also lower-cases and cuts words into
    runs of letters, single digits and runs of marks, each coded by itself: Latin words with
    marks behind them and other ASCII words are cut here, and their pieces go to the model
    alone (tested against whole texts). Other words, those with an apostrophe inside and
    special tokens go to the tokenizer as they are."""

    def __init__(self, path: str, limit: int = 120_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenize = tokenizer.model.tokenize
        few = [struct.Struct(f"<{n}I").pack for n in range(16)]  # the formats of most pieces, parsed once

        def whole(w: str) -> bytes:
            return _pack(tokenizer.encode(w, add_special_tokens=False).ids)

        def piece(w: str) -> bytes:
            if not w.isascii():
                w = w.encode("utf-8").decode("latin-1").translate(_HIDDEN)
            elif not w.isalnum() and not _PRINTABLE.fullmatch(w):
                return whole(w)
            ids = [t.id for t in tokenize(w)]
            return few[len(ids)](*ids) if len(ids) < len(few) else _pack(ids)

        def word(w: bytes) -> bytes:
            if w.isalpha():  # ASCII letters and nothing else
                return pieces[w.lower().decode()]
            core = w.rstrip(_MARKS)
            s = core.decode("utf-8")
            if core.isalpha() or _LETTERS.fullmatch(s):
                letters = pieces[s.lower()]
                return letters if len(core) == len(w) else letters + pieces[w[len(core):].decode()]
            if w.isascii() and b"'" not in w and b"<|" not in w:
                return b"".join([pieces[p] for p in _PIECES.findall(w.decode().lower())])
            return whole(w.decode("utf-8"))

        pieces = Recent(piece, limit)
        super().__init__(word, limit)

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text. Words of letters are cut from the marks behind them; a part is
        asked for once, however often the column has it."""
        words, codes, lens = arrow_words(texts, lower=False)
        core = pc.ascii_rtrim(words, characters=_MARKS.decode())
        letters = pc.match_substring_regex(core, f"^{_LETTERS.pattern}$")
        # of letters alone, case never counts (elsewhere it does: special tokens, combining marks);
        # the lower case has the same bytes to a word
        words = pa.concat_arrays([pc.if_else(letters, pc.ascii_lower(words), words)])
        letters = letters.to_numpy(zero_copy_only=False)
        starts = np.frombuffer(words.buffers()[1], np.int32)[:len(words) + 1]
        cut = np.where(letters, starts[:-1] + pc.binary_length(core).to_numpy(), starts[1:])
        at = np.r_[np.stack([starts[:-1], cut], 1).ravel(), starts[-1]].astype(np.int32)
        parts = pa.BinaryArray.from_buffers(pa.binary(), 2 * len(words), [None, pa.py_buffer(at), words.buffers()[2]])
        parts = parts.dictionary_encode()
        coded = pa.array([self[w] if w else b"" for w in parts.dictionary.to_pylist()], pa.large_binary())
        # the parts' ids in the order of the texts, one text after the other
        line = coded.take(pa.array(parts.indices.to_numpy().reshape(-1, 2)[codes].ravel()))
        at = np.frombuffer(line.buffers()[1], np.int64)[:len(line) + 1] if len(line) else np.zeros(1, np.int64)
        ids, ends = memoryview(line.buffers()[2] or b""), at[2 * np.cumsum(np.r_[0, lens])].tolist()
        return (bytes(ids[a:z]) for a, z in zip(ends, ends[1:]))


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
           end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit): every document's
    tokens and the end id, cut only where they exceed ``capacity``."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    d = pick(docs, doc_id=id_col, text=text_col)
    key = d.schema["doc_id"].dataType.simpleString()
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker(("coder", tokenizer_path), lambda: Coder(tokenizer_path))
        for b in batches:
            row, piece, ids = [], [], []
            for i, whole in enumerate(coder.texts(b.column("text"))):
                whole += end
                for n, at in enumerate(range(0, len(whole), step)):
                    row.append(i)
                    piece.append(n)
                    ids.append(whole[at:at + step])
            n = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(n),
                pa.array(n.astype(np.int64) * capacity),
                pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "piece", "start", "length", "ids"])

    text_bytes_conf(docs.sparkSession)
    return d.mapInArrow(run, f"doc_id {key}, piece int, start bigint, length bigint, ids binary")


class CapacityTree:
    """Segment tree over the capacities 0..capacity; a node counts the open runs below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.runs: dict[int, deque] = {}

    def push(self, room: int, first: int, n: int) -> None:
        self.runs.setdefault(room, deque()).append((first, n))
        self._add(room, 1)

    def pop(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.runs[room].popleft()

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The least capacity >= ``need`` with an open run, in logarithmic time."""
        at = need + self.size
        if self.count[at]:
            return need
        while at > 1:
            if not at & 1 and self.count[at + 1]:  # the nearest subtree to the right
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over {length: count}. Returns runs (length, first rank, first
    sequence, items per sequence, offset in it) in the order of lengths (descending) and
    ranks, and the number of sequences."""
    tree, out, opened = CapacityTree(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                n = -(-left // (room // length))
                first, opened = opened, opened + n
            else:
                first, n = tree.pop(room)
            each = room // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, first, each, capacity - room))
                tree.push(room - each * length, first, full)
                rank, left, first, n = rank + each * full, left - each * full, first + full, n - full
            if n and left:  # fewer than one sequence takes are left
                out.append((length, rank, first, left, capacity - room))
                tree.push(room - left * length, first, 1)
                left, first, n = 0, first + 1, n - 1
            if n:
                tree.push(room, first, n)
    return np.array(out, np.int64).reshape(-1, 5), opened


def place(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with sequence_id and offset (both bigint): best-fit decreasing over all rows."""
    if not 1 <= capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must lie between 1 and {MAX_CAPACITY}")
    taken = {c.lower() for c in items.columns}
    if taken & {"sequence_id", "offset"}:
        raise ValueError("items already have a column sequence_id or offset")
    part, rank, base, size, task = (_free(taken, n) for n in ("part", "rank", "base", "size", "task"))
    marked = spill(_mark(items, length_col, capacity, part, rank), "packing")
    length = F.col(f"`{length_col}`").cast("bigint")
    counts = marked.groupBy(length.alias(size), F.col(part).alias(task)).agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy(size).agg(F.sum("n")).collect()}
    runs, _ = plan(histogram, capacity)
    # ranks of all lengths in one line: the longer lengths' items come first
    lengths = sorted(histogram, reverse=True)
    starts = dict(zip(lengths, np.cumsum([0, *[histogram[x] for x in lengths]]).tolist()))
    first_item = np.array([starts[x] for x in runs[:, 0].tolist()], np.int64) + runs[:, 1]
    shared = Shared(items.sparkSession, (runs, first_item, starts))
    before = F.sum("n").over(Window.partitionBy(size).orderBy(task).rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select(size, task, F.coalesce(before, F.lit(0)).alias(base))
    ranked = marked.join(bases, (length == F.col(size)) & (F.col(part) == F.col(task)))
    ranked = ranked.select(*marked.columns, base)
    fields = [f for f in ranked.schema.fields if f.name not in (part, rank, base)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, first, begins = shared.value
        for b in batches:
            ls = b.column(length_col).to_numpy(zero_copy_only=False).astype(np.int64)
            within = (b.column(base).to_numpy() + b.column(rank).to_numpy()
                      + np.array([begins[x] for x in ls.tolist()], np.int64))
            at = np.searchsorted(first, within, side="right") - 1
            nth, into = np.divmod(within - first[at], table[at, 3])
            kept = [b.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(table[at, 2] + nth), pa.array(table[at, 4] + into * ls)],
                [*[f.name for f in fields], "sequence_id", "offset"])

    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def _free(taken: set[str], name: str) -> str:
    while name in taken:
        name += "_"
    taken.add(name)
    return name


def _mark(items: DataFrame, length_col: str, capacity: int, part: str, rank: str) -> DataFrame:
    """Each row with its task and its rank among the task's rows of the same length."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd
        from pyspark import TaskContext

        here, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            ls = b.column(length_col)
            x = ls.to_numpy(zero_copy_only=False)
            if ls.null_count or (len(x) and not (x.min() >= 1 and x.max() <= capacity)):
                raise ValueError(f"lengths must lie between 1 and {capacity}")
            x = x.astype(np.int64)
            kinds, which, n = np.unique(x, return_inverse=True, return_counts=True)
            nth = pd.Series(x).groupby(x).cumcount().to_numpy() if len(x) else x
            at = nth + np.array([seen.get(k, 0) for k in kinds.tolist()], np.int64)[which] if len(x) else x
            for k, m in zip(kinds.tolist(), n.tolist()):
                seen[k] = seen.get(k, 0) + m
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(x), here, np.int64)), pa.array(at.astype(np.int64))],
                [*b.schema.names, part, rank])

    return items.mapInArrow(run, f"{schema}, `{part}` bigint, `{rank}` bigint")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves (each at most one capacity long)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
