"""Language-model scoring with Brown-style class bigrams.

Words are put into classes by exchange clustering: a word moves to the class that most
raises the likelihood of the class bigram model, until a sweep moves little. The most
frequent words are exchanged one by one. Then every other training word, however rare, is
exchanged by its own neighbours: all of them move in each round to the class that most
raises the likelihood of the classes beside them, until a round moves little. So each word
of the corpus has a class of its own choosing, and every token counts. Then

    P(text) = prod P(class_i | class_{i-1}) * P(word_i | class_i)

with class transitions interpolated with class frequencies and, in each class, the mass
of its once-seen words kept for unknown ones. Unknown words have no neighbours to go by and
take the class with the most once-seen words. A text ends with one end token, which
is a class of its own and the context of the first word.

Defined results: a null text is empty (the end token only); a null id is not held out;
rows that share an id are scored as one document, their scores and counts added up; an
empty table gives an empty result; with no training rows the score is the base score;
extra columns are ignored. Texts of any length are scored whole.

Scale: four passes over the texts, cut into words an Arrow batch at a time. Word counts go
through one shuffle and the neighbours of words (word, neighbouring class, count) through
another; this table stays in Spark, and a round only gathers the matrix of classes by
neighbouring classes. The last pass writes a text as one byte a token, its word's class:
the most frequent words are looked up in a broadcast of bounded size, all other words are
joined with the table of words, once for each word and batch. Transitions and scores come
from these bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, arrow_words, count_words, crc_mod, keyed, pick, spill, text_bytes_conf

#: Words exchanged one by one, classes (the end token's is one more; a class and its side
#: fit a byte), and words in the broadcast dictionary.
UNIT_WORDS, CLASSES, DICTIONARY = 500, 48, 200_000
#: Longer words are never in a broadcast, so its size is bounded.
MAX_WORD = 64
#: Sweeps over the words exchanged one by one, rounds over all others.
SWEEPS, ROUNDS = 12, 8


def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS, rest: bool = False) -> np.ndarray:
    """Class of each unit, from the unit bigram counts (unit 0, the end token, keeps
    class 0 to itself; with ``rest`` the last unit stands for all other words and keeps the
    last class). Starts with the units dealt out by frequency; each sweep moves every other
    unit, most frequent first, to its best class (ties: the smallest)."""
    u = len(counts)
    out, into = counts.sum(1).astype(float), counts.sum(0).astype(float)
    order = sorted(range(1, u - rest), key=lambda i: (-(out[i] + into[i]), i))
    k = min(classes, max(1, u - 1 - rest)) + 1
    cls = np.zeros(u, np.int64)
    for r, i in enumerate(order):
        cls[i] = 1 + r % (k - 1)
    if rest:
        cls[-1], k = k, k + 1
    counts = counts.astype(float)

    def xlogx(a: np.ndarray) -> np.ndarray:
        return a * np.log(np.where(a > 0, a, 1.0))

    member = np.zeros((u, k))
    member[np.arange(u), cls] = 1.0
    big = member.T @ counts @ member
    n_out, n_in = member.T @ out, member.T @ into
    for _ in range(sweeps):
        moved = 0
        for i in order:
            if out[i] + into[i] == 0:
                continue
            a = cls[i]
            self_ = counts[i, i]
            right = np.bincount(cls, counts[i], k)
            left = np.bincount(cls, counts[:, i], k)
            right[a] -= self_
            left[a] -= self_
            big[a, :] -= right
            big[:, a] -= left
            big[a, a] -= self_
            n_out[a] -= out[i]
            n_in[a] -= into[i]
            rows = (xlogx(big + right) - xlogx(big)).sum(1)
            cols = (xlogx(big + left[:, None]) - xlogx(big)).sum(0)
            d = np.diagonal(big)
            both = xlogx(d + right + left + self_) - xlogx(d)
            once = xlogx(d + right) + xlogx(d + left) - 2 * xlogx(d)
            gain = (rows + cols - once + both - xlogx(n_out + out[i]) + xlogx(n_out)
                    - xlogx(n_in + into[i]) + xlogx(n_in))
            gain[0] = -np.inf
            if rest:
                gain[-1] = -np.inf
            b = int(np.argmax(np.round(gain, 6)))
            cls[i] = b
            big[b, :] += right
            big[:, b] += left
            big[b, b] += self_
            n_out[b] += out[i]
            n_in[b] += into[i]
            moved += b != a
        if moved * 200 <= u:
            break
    return cls


class ClassBigram:
    """The trained model; everything in it has a size fixed by the parameters. ``big`` has
    the class bigrams, ``once`` the once-seen words of each class, ``dictionary`` the count
    and class of the most frequent words."""

    def __init__(self, dictionary: dict[bytes, tuple[int, int]], big: np.ndarray, once: np.ndarray, n: int, v: int,
                 ends: int):
        self.n, self.v, self.ends = n, v, ends
        k = self.classes = len(big)
        total = big.sum(0)
        share = (total + 1.0) / (total.sum() + k)
        self.step = np.log10((big + share) / (big.sum(1, keepdims=True) + 1.0))
        unk = (once + 0.5) / (total + 1.0 + 0.5)
        unk[0] = 0.0
        self.unk = np.log10(np.where(unk > 0, unk, 1.0))
        #: log10 P(word | class) = known[class] + log10(count)
        self.known = np.log10(1.0 - unk) - np.log10(np.maximum(total, 1.0))
        self.known[0] = -math.log10(max(total[0], 1.0))
        self.unknown = 1 + int(np.argmax(once[1:]))
        self.unit = {w: i for i, w in enumerate(dictionary)}
        self.counts = [m for m, _ in dictionary.values()]
        #: classes of the dictionary's words, then that of unknown ones
        self.cls = np.array([*[c for _, c in dictionary.values()], self.unknown], np.int64)

    def unit_of(self, word: bytes) -> int:
        return self.unit.get(word, len(self.unit))

    def emit(self, word: bytes, count: int) -> float:
        c = self.cls[self.unit_of(word)]
        return float(self.known[c] + math.log10(count) if count else self.unk[c])

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Transitions and emissions (but for the counts of words) of the bytes of a coded
        text: its classes, then the sign of an unknown word."""
        as_class = np.r_[np.arange(self.classes), self.unknown]
        emit = np.r_[self.known, self.unk[self.unknown]]
        emit[0] = 0.0  # the end token is alone in its class
        return self.step[as_class][:, as_class], emit


def chain(values: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, a 0 (the end token) before, between and behind them, and
    the place of each value in it."""
    at = np.arange(len(values)) + np.repeat(np.arange(len(lens)), lens) + 1
    out = np.zeros(len(values) + len(lens) + 1, values.dtype)
    out[at] = values
    return out, at


def find_in(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each word in ``known``, -1 if it is not there."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)


def bigrams(texts: DataFrame, codes: int, code) -> np.ndarray:
    """codes x codes matrix of neighbours, added up in each task; ``code`` makes a chain of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(codes * codes, np.int64)
        for b in batches:
            for part in code(b):
                seen += np.bincount(part[:-1].astype(np.int64) * codes + part[1:], minlength=codes * codes)
        k = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(seen[k])], ["cell", "n"])

    # at most codes * codes cells, a size fixed by the parameters
    cells = texts.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(codes * codes)
    counts[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.float64)
    return counts.reshape(codes, codes)


def neighbours(texts: DataFrame, units: pa.Array, cls: np.ndarray) -> DataFrame:
    """word, cells: for each word outside ``units`` how often which class stands beside it, as
    pairs of bytes (class, from ``cls.max() + 1`` on to its right; count, longer ones in parts)."""
    shared, sides = Shared(texts.sparkSession, (units, cls)), int(cls.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, cls = shared.value
        for b in batches:
            words, codes, lens = arrow_words(b.column("text"))
            unit = find_in(words, units)
            # units count from 1; the last class is that of all words outside
            line, at = chain(np.where(unit < 0, cls[-1], cls[unit + 1]).astype(np.int64)[codes], lens)
            other = unit[codes] < 0
            word, at = codes[other].astype(np.int64), at[other]
            cells = np.sort(np.concatenate([word * (2 * sides) + line[at - 1],
                                            word * (2 * sides) + sides + line[at + 1]]))
            first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]][:len(cells)])
            n = np.diff(np.r_[first, len(cells)])
            parts = -(-n // 255)
            cell, n = np.repeat(cells[first], parts), np.repeat(n, parts)
            last = np.cumsum(parts) - 1
            m = np.full(len(cell), 255)
            m[last] = n[last] - 255 * (parts - 1)
            word, cell = np.divmod(cell, 2 * sides)
            which = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][:len(word)])
            ends = np.r_[which, len(word)].astype(np.int32) * 2
            pairs = np.stack([cell, m], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(word[which])),
                 pa.BinaryArray.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(ends), pa.py_buffer(pairs)])],
                ["word", "cells"])

    return (texts.mapInArrow(run, "word string, cells binary")
            .groupBy("word").agg(F.collect_list("cells").alias("cells")))


def cell_counts(cells: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, class with side, and count of all pairs in a column of ``neighbours``."""
    flat = cells.flatten()
    size = pc.fill_null(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False) // 2
    pairs = np.frombuffer(b"".join(flat.to_pylist()), np.uint8).reshape(-1, 2).astype(np.int64)
    rows = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy(zero_copy_only=False))
    return np.repeat(rows, size), pairs[:, 0], pairs[:, 1]


def best_class(row: np.ndarray, cell: np.ndarray, n: np.ndarray, rows: int, logp: np.ndarray) -> np.ndarray:
    """The class in which a word's neighbours are likeliest (ties: the smallest)."""
    width = logp.shape[1]
    counts = np.bincount(row * width + cell, n, rows * width).reshape(rows, width)
    return 1 + np.argmax(np.round(counts @ logp.T, 6), axis=1)


def exchange_rest(table: DataFrame, start: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the neighbours in each class, with which ``best_class`` gives the
    class of every word of ``table``. ``start`` has the neighbours' counts of the words
    exchanged one by one (a row a class, none for the end token's), which stay where they are.
    A round moves all words at once and does not lower the likelihood (but for smoothing)."""
    k, width = start.shape
    cells = table.select("cells")

    def logs(seen: np.ndarray) -> np.ndarray:
        left = (seen + (seen.sum(0) + 1.0) / (seen.sum() + width)).reshape(k, 2, width // 2)
        return np.log(left / left.sum(2, keepdims=True)).reshape(k, width)

    before, now = None, logs(start)
    for _ in range(rounds):
        shared = Shared(table.sparkSession, (before, now))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, now = shared.value
            seen, moved, words = np.zeros(k * width), 0, 0
            for b in batches:
                row, cell, n = cell_counts(b.column("cells"))
                to = best_class(row, cell, n, len(b), now)
                moved += len(b) if before is None else int((to != best_class(row, cell, n, len(b), before)).sum())
                words += len(b)
                seen += np.bincount((to[row] - 1) * width + cell, n, k * width)
            some = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[-1, -2, some]), pa.array(np.r_[moved, words, seen[some]].astype(np.int64))], ["cell", "n"])

        got = dict(cells.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect())
        moved, words = got.pop(-1, 0), got.pop(-2, 0)
        seen = start.astype(float).ravel()
        for c, n in got.items():
            seen[c] += n
        if moved * 200 <= words:
            break
        before, now = now, logs(seen.reshape(k, width))
    return now


def classes_of(table: DataFrame, logp: np.ndarray) -> DataFrame:
    """word, n, cls of every word of ``table``."""
    shared = Shared(table.sparkSession, logp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = shared.value
        for b in batches:
            row, cell, n = cell_counts(b.column("cells"))
            left = cell < logp.shape[1] // 2
            yield pa.RecordBatch.from_arrays(
                [b.column("word"), pa.array(np.bincount(row[left], n[left], len(b)).astype(np.int64)),
                 pa.array(best_class(row, cell, n, len(b), logp).astype(np.int32))], ["word", "n", "cls"])

    return table.mapInArrow(run, "word string, n bigint, cls int")


def frequent(vocab: DataFrame, room: int) -> pd.DataFrame:
    """The words of a count table above a count that at most ``room`` words have, from a
    histogram of bounded size; most frequent first."""
    short = vocab.where(F.length("word") <= MAX_WORD)
    bin_ = F.floor(F.log2("n") * 16).cast("int")
    least = 1 << 20
    for r in sorted(short.groupBy(bin_.alias("b")).count().collect(), reverse=True):
        if r["count"] > room:
            break
        least, room = r["b"], room - r["count"]
    found = short.where(bin_ >= least).toPandas()
    return found.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)


def encode(docs: DataFrame, vocab: DataFrame, top: pd.DataFrame, classes: int, space: int, id_col: str,
           text_col: str, modulus: int, held_out: int) -> DataFrame:
    """doc_id (text), train, n_tokens, n_known, base, log_n (sums of the words' log10 base
    probabilities and log10 counts), seq (a byte a word: its class, or ``classes`` if unknown)
    for every row. Words outside ``top`` are joined once for each batch of texts."""
    spark = docs.sparkSession
    d = keyed(docs, "doc_id", doc_id=id_col, text=text_col)
    h = crc_mod(F.col("doc_id"), modulus)
    d = d.select("doc_id", (h.isNull() | (h != held_out)).alias("train"), "text")
    shared = Shared(spark, (pa.array(top["word"], pa.string()), top["n"].to_numpy(np.float64),
                            top["cls"].to_numpy(np.uint8)))
    kept = "doc_ids array<string>, trains array<boolean>, lens array<bigint>, bases array<double>, logs array<double>, seq binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, n, cls = shared.value
        base, log_n, here = np.log10((n + 1) / space), np.log10(n), TaskContext.get().partitionId() << 32
        names = ["batch", "word", "places", "doc_ids", "trains", "lens", "bases", "logs", "seq"]
        types = [pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.float64()),
                 pa.list_(pa.float64()), pa.binary()]
        for no, b in enumerate(batches):
            words, codes, lens = arrow_words(b.column("text"))
            unit = find_in(words, known)
            at, owner = unit[codes], np.repeat(np.arange(len(lens)), lens)
            rare = at < 0
            seq = np.full(len(codes), classes, np.uint8)
            seq[~rare] = cls[at[~rare]]
            sums = [np.bincount(owner[~rare], x[at[~rare]], len(lens)) for x in (base, log_n)]
            # a space keeps this key apart from every word, and the number spreads it
            whole = [[here + no], [f" {here + no}"], [None], [b.column("doc_id").to_pylist()], [b.column("train").to_pylist()],
                     [lens], [sums[0]], [sums[1]], [seq.tobytes()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(whole, [pa.int64(), pa.string(), pa.binary(), *types])], names)
            places = np.flatnonzero(rare)
            places = places[np.argsort(codes[places], kind="stable")].astype(np.uint32)
            which, many = np.unique(codes[places], return_counts=True)
            ends = np.r_[0, np.cumsum(many) * 4].astype(np.int32)
            m = len(which)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, here + no, np.int64)), words.take(pa.array(which)),
                 pa.BinaryArray.from_buffers(pa.binary(), m, [None, pa.py_buffer(ends), pa.py_buffer(places)]),
                 *[pa.nulls(m, t) for t in types]], names)

    rows = d.mapInArrow(run, f"batch bigint, word string, places binary, {kept}").join(vocab, "word", "left")
    # the rows of one batch of texts, bounded by its bytes (or by the one text in it)
    found = F.when(F.col("places").isNotNull(), F.struct("places", "n", "cls"))
    whole = rows.groupBy("batch").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("doc_ids", "trains", "lens", "bases", "logs", "seq")],
        F.collect_list(found).alias("found")).drop("batch")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                ids, trains, lens, base, log_n = (b.column(c)[i].values for c in (
                    "doc_ids", "trains", "lens", "bases", "logs"))
                lens, base, log_n = lens.to_numpy(), base.to_numpy().copy(), log_n.to_numpy().copy()
                seq = np.frombuffer(b.column("seq")[i].as_py(), np.uint8).copy()
                places, n, cls = b.column("found")[i].values.flatten()
                many = pc.binary_length(places).to_numpy(zero_copy_only=False) // 4
                at = np.frombuffer(b"".join(places.to_pylist()), np.uint32)
                n = pc.fill_null(n, 0).to_numpy(zero_copy_only=False)
                cls = pc.fill_null(cls, classes).to_numpy(zero_copy_only=False)
                ends = np.cumsum(lens)
                seq[at] = np.repeat(cls, many)
                owner = np.searchsorted(ends, at, side="right")
                base += np.bincount(owner, np.repeat(np.log10((n + 1) / space), many), len(lens))
                log_n += np.bincount(owner, np.repeat(np.log10(np.maximum(n, 1)), many), len(lens))
                unknown = np.bincount(np.searchsorted(ends, np.flatnonzero(seq == classes), side="right"), minlength=len(lens))
                offsets = np.r_[0, ends].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids, trains, pa.array(lens), pa.array(lens - unknown), pa.array(base), pa.array(log_n),
                     pa.BinaryArray.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(seq)])],
                    ["doc_id", "train", "n_tokens", "n_known", "base", "log_n", "seq"])

    return whole.mapInArrow(fill, "doc_id string, train boolean, n_tokens bigint, n_known bigint, base double, "
                                  "log_n double, seq binary")


def seq_parts(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A batch of coded rows in parts of some thousand: first row, last, the bytes of all, the lengths."""
    for a in range(0, len(b), 2000):
        seq = b.column("seq").slice(a, 2000)
        yield (a, a + len(seq), np.frombuffer(b"".join(seq.to_pylist()), np.uint8),
               pc.binary_length(seq).to_numpy(zero_copy_only=False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7,
          held_out: int = 2) -> tuple[ClassBigram, DataFrame]:
    """The model and the table of all words (word, n, cls) of the training rows."""
    spark = docs.sparkSession
    text_bytes_conf(spark)
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("h", crc_mod(F.col("doc_id"), modulus))
    d = d.where(F.col("h").isNull() | (F.col("h") != held_out)).select("text")
    counted = spill(count_words(d, "text"), "brown-counts")
    ends = d.count()
    total, types = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = frequent(counted, DICTIONARY)[:UNIT_WORDS]
    units = pa.array(top["word"], pa.string())
    shared = Shared(spark, units)

    def unit_line(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        units = shared.value
        words, codes, lens = arrow_words(b.column("text"))
        unit = find_in(words, units)
        yield chain(np.where(unit < 0, len(units), unit)[codes] + 1, lens)[0]

    counts = bigrams(d, len(units) + 2, unit_line)
    cls = exchange(counts, rest=True)
    k, sides = int(cls[-1]), int(cls[-1]) + 1  # classes; the last side is that of words outside the units
    member = np.zeros((len(counts), sides))
    member[np.arange(len(counts)), cls] = 1.0
    big = member.T @ counts @ member
    table = spill(neighbours(d, units, cls), "brown-neighbours")
    logp = exchange_rest(table, np.concatenate([big.T, big], 1)[1:k])
    first = [(w, int(n), int(c)) for w, n, c in zip(top["word"], top["n"], cls[1:])]
    schema = "word string, n bigint, cls int"
    vocab = spill(classes_of(table, logp).unionByName(spark.createDataFrame(first, schema)), "brown-vocab")
    once = np.zeros(k)
    for c, m in vocab.where("n = 1").groupBy("cls").count().collect():
        once[c] = m
    n, v = int(total) + int(ends), int(types) + (1 if ends else 0)
    top = frequent(vocab, DICTIONARY)
    coded = spill(encode(docs, vocab, top, k, n + v + 1, id_col, text_col, modulus, held_out), "brown-coded")
    big = bigrams(coded.where("train").select("seq"), k, lambda b: (chain(x, m)[0] for _, _, x, m in seq_parts(b)))
    words = [w.encode("utf-8", "surrogatepass") for w in top["word"]]
    model = ClassBigram(dict(zip(words, zip(top["n"].tolist(), top["cls"].tolist()))), big, once, n, v, int(ends))
    model.coded = docs, (id_col, text_col, modulus, held_out), coded
    return model, vocab


def score(docs: DataFrame, model: ClassBigram, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          modulus: int = 7, held_out: int = 2) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score. Rows that ``train`` was
    given are not coded again."""
    spark = docs.sparkSession
    text_bytes_conf(spark)
    kind = docs.schema[id_col].dataType
    args = (id_col, text_col, modulus, held_out)
    if model.coded[0] is docs and model.coded[1] == args:
        coded = model.coded[2]
    else:
        top = pd.DataFrame({"word": [w.decode("utf-8", "surrogatepass") for w in model.unit],
                            "n": model.counts, "cls": model.cls[:-1]})
        coded = encode(docs, vocab, top, model.classes, model.n + model.v + 1, *args)
    shared, trained = Shared(spark, model.tables()), model.n > 0
    end = math.log10((model.ends + 1) / (model.n + model.v + 1)), int(model.ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, emit = shared.value
        for b in batches:
            for a, z, x, lens in seq_parts(b):
                part = b.slice(a, z - a)
                base = part.column("base").to_numpy() + end[0]
                total = base
                if trained:
                    line = chain(x, lens)[0]
                    gain = step[line[:-1], line[1:]] + emit[line[1:]]
                    starts = np.cumsum(np.r_[0, lens[:-1] + 1].astype(np.int64))
                    total = np.add.reduceat(gain, starts) + part.column("log_n").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(part.column("n_tokens").to_numpy() + 1),
                     pa.array(part.column("n_known").to_numpy() + end[1]), pa.array(base), pa.array(total)],
                    ["doc_id", "n_tokens", "n_known", "base", "score"])

    rows = coded.mapInArrow(run, "doc_id string, n_tokens bigint, n_known bigint, base double, score double")
    out = rows.groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                                     F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    out = out.withColumn("doc_id", F.col("doc_id").cast(kind))
    return out.select(F.col("doc_id").alias(id_col),
                      F.coalesce(crc_mod(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"),
                      "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"),
                      "base_score", "score")
