"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.session import ensure_checkpoint_dir

WORD_BREAK_SQL = r"[\x20\x09-\x0D]+"


def byte_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z lower-cased: on bytes,
    ``lower`` and ``split`` mean ASCII letters and exactly these six white-space bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def words_col(text: Column) -> Column:
    """The words of a non-null text as an array. Splitting at one plain character is the
    fast path of ``split``; texts with rarer white space take the pattern."""
    rare = text.contains("\t") | text.contains("\r") | text.contains("\x0b") | text.contains("\x0c")
    plain = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    return F.array_remove(F.when(rare, F.split(text, WORD_BREAK_SQL)).otherwise(plain), "")


def count_chars(text: Column, chars: str) -> Column:
    """How many of ``chars`` a non-null text has (texts without any are not rewritten)."""
    some = text.contains(chars[0])
    for c in chars[1:]:
        some = some | text.contains(c)
    return F.when(some, F.length(text) - F.length(F.translate(text, chars, ""))).otherwise(F.lit(0))


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo m (null ids: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(m)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body`` (a lambda variable keeps
    the optimiser from copying the expression into every use)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """The named columns only, under fixed names: extra columns (even ones that clash
    with an operator's own names) never reach a plan."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in cols.items()])


def keyed(df: DataFrame, key: str, **cols: str) -> DataFrame:
    """``pick`` with the key as text: pandas would turn a nullable integer into a float."""
    return pick(df, **{key: cols.pop(key)}, **cols).withColumn(key, F.col(key).cast("string"))


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_bytes_conf(spark: SparkSession) -> None:
    """Arrow batches limited by bytes as well as rows, so very long texts stay bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shared:
    """A broadcast model, pickled by value so that executors need no copy of the package."""

    def __init__(self, spark: SparkSession, value: object):
        from pyspark import cloudpickle

        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        from pyspark import cloudpickle

        return cloudpickle.loads(self._bytes.value)


def spill(df: DataFrame, name: str, scratch: "Scratch | None" = None) -> DataFrame:
    """Write a table to the shared checkpoint folder as Parquet and read it back: a
    lineage cut that stays column-pruned and compressed. ``scratch`` notes the place."""
    import uuid

    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if scratch is not None:
        scratch.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_end_with_queries(spark: SparkSession):
    """Inside, a query's shuffle files go as soon as it ends (Spark keeps them until the driver
    collects its garbage). Meant for steps that write every table they read twice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Scratch:
    """Tables written on the way to a result. ``free`` deletes those that no later step reads,
    ``drop`` all of them once the result stands in a table of its own."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def spill(self, df: DataFrame, name: str) -> DataFrame:
        return spill(df, name, self)

    def free(self, *names: str) -> None:
        self._delete([p for p in self.paths if p.rsplit("/", 1)[1].rsplit("-", 1)[0] in names])

    def drop(self) -> None:
        self._delete(self.paths)

    def _delete(self, paths: list[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)
        self.paths = [p for p in self.paths if p not in paths]


def per_worker(key: tuple, make: Callable):
    """An object made once for each Python worker process. Library functions reach tasks
    pickled by value, with new module globals every time, so those would not last."""
    import sys
    import types

    store = sys.modules.setdefault("tablelearn_worker_store", types.ModuleType("tablelearn_worker_store")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def strip_ends(word: str, keep: Callable[[str], bool]) -> str:
    """``word`` without the characters at its ends that ``keep`` rejects, in linear time."""
    a, b = 0, len(word)
    while a < b and not keep(word[a]):
        a += 1
    while a < b and not keep(word[b - 1]):
        b -= 1
    return word[a:b]


class WordCache(dict):
    """word -> value of ``fn``, remembering a bounded number of words."""

    def __init__(self, fn: Callable, limit: int = 300_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, word: str):
        if len(self) >= self.limit:
            self.clear()
        v = self[word] = self.fn(word)
        return v


def arrow_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a column of texts as ``byte_words`` has them (``lower``: lower-cased): the
    distinct ones, the number of each word in turn among these, and how many words each text has."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    some = pc.greater(pc.binary_length(flat), 0)  # white space at the ends leaves empty ones
    lens = np.bincount(np.repeat(np.arange(len(lens)), lens)[some.to_numpy(zero_copy_only=False)], minlength=len(lens))
    coded = flat.filter(some).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), lens


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """word, n over the lower-cased (A-Z) words of all rows. Tasks add up the words of a batch
    first, so a frequent word is one row a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, codes, _ = arrow_words(b.column("text"))
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)).astype(np.int64))],
                                             ["word", "n"])

    text_bytes_conf(docs.sparkSession)
    d = docs.select(F.col(f"`{text_col}`").alias("text"))
    return d.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
