"""Stream-static scoring: apply a fitted model to a streaming DataFrame.

Every scorer in this package is a projection whose model parameters are
literals (naive Bayes, LDA, linear models, trees, k-means assignment, GMM
responsibilities), so the same columns apply unchanged to a streaming
DataFrame: no state, no watermark, no shuffle. ``write_scored`` sinks each
micro-batch to Parquet through ``foreachBatch`` with the checkpoint under the
session's shared checkpoint folder, so a restarted query resumes exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path


def read_parquet_stream(spark: SparkSession, directory: str, schema, glob: str | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def score_stream(stream: DataFrame, columns: Sequence[Column] | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Append scoring columns (or apply a DataFrame -> DataFrame scorer)."""
    if callable(columns):
        return columns(stream)
    return stream.select("*", *columns)


def write_scored(scored: DataFrame, output: str, name: str, available_now: bool = True) -> StreamingQuery:
    spark = scored.sparkSession
    ckpt = scratch_path(spark, f"stream-{name}")

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("append").parquet(output)

    writer = scored.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
