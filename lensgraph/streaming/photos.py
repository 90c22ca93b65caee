"""The photo layers over a stream: the same Columns, row by row, with content seen once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lensgraph.operators import l1, l2
from lensgraph.sources.tables import append_new


def metrics_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Metric rows as they land in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def classified(stream: DataFrame, key: str | None = None, arrived: str | None = None, late: str = "1 day") -> DataFrame:
    """Both layers of each row; with a key, rows of a key already seen within the watermark are dropped."""
    if key is not None and arrived is not None:
        stream = stream.withWatermark(arrived, late).dropDuplicatesWithinWatermark([key])
    return l2.features(l1.classify(stream))


def counts_by_window(stream: DataFrame, arrived: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts by code and time window; windows close after the watermark."""
    return l1.classify(stream).withWatermark(arrived, late).groupBy(F.window(arrived, window), "kode").agg(F.count("*").alias("n"))


def into_table(stream: DataFrame, path: str, checkpoint: str, key: str) -> StreamingQuery:
    """Appends each micro-batch's new keys; a replayed batch adds nothing."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: append_new(batch, path, [key])).trigger(availableNow=True).start()
