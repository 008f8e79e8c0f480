"""A1: read the driver tables and assemble feature views.

Features are plain DOUBLE columns (``x1..xp``) so every downstream expression
stays inside whole-stage codegen; array features are unpacked once here.
Only the columns a view needs are selected, so the Parquet scan prunes the
rest (``ReadSchema`` shows just those fields).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feature_names(p: int, prefix: str = "x") -> list[str]:
    return [f"{prefix}{i + 1}" for i in range(p)]


def embedding_view(spark: SparkSession, sf_dir: str, p: int) -> DataFrame:
    """emb_d{p}: vec_id, x1..xp = embedding dims as DOUBLE, label. Registered queries over
    whole vectors pass the table's width; a smaller p is a view of the first p dims."""
    emb = read_table(spark, sf_dir, "embeddings")
    cols = [F.col("embedding")[i].cast("double").alias(n)
            for i, n in enumerate(feature_names(p))]
    return emb.select("vec_id", *cols, "label")


def embedding_array_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, features ARRAY<DOUBLE> (all dims), label."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.col("embedding").cast("array<double>").alias("features"),
                      "label")


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Centre and scale columns by their population mean and stddev.

    One aggregate pass (partial on every partition, one row shuffled), then
    the scalars enter the projection as literals.
    """
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    stats = df.agg(*aggs).first()
    out = df
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        if s is None or s == 0:
            raise ValueError(f"column {c!r} is constant; cannot standardise")
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(m)) / F.lit(s))
    return out


def lineitem_xy(spark: SparkSession, sf_dir: str, standardized: bool = False) -> DataFrame:
    """li_xy: y = l_extendedprice, x1..x3 = quantity, discount, tax."""
    li = read_table(spark, sf_dir, "lineitem")
    df = li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("l_quantity").alias("x1"), F.col("l_discount").alias("x2"),
        F.col("l_tax").alias("x3"), F.col("l_extendedprice").alias("y"))
    if standardized:
        df = standardize(df, ["x1", "x2", "x3", "y"])
    return df


LANGS = ("fr", "de", "es")  # beside en


def document_xy(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """doc_xy: documents joined to labels; x1 = standardised n_chars, x2..x4 = whether the
    language is fr, de, es.

    ``target='quality'`` gives y in {0,1}; ``target='toxic'`` gives y in {-1,+1}.
    Both sides are keyed on doc_id; Spark picks the join strategy from sizes
    (labels covers only some documents).
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    df = docs.join(labels, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("x1"),
        *[F.coalesce(F.col("lang") == c, F.lit(False)).cast("double").alias(f"x{i + 2}") for i, c in enumerate(LANGS)],
        (F.col(target) if target == "quality"
         else F.when(F.col(target) == 1, 1).otherwise(-1)).cast("int").alias("y"))
    return standardize(df, ["x1"])
