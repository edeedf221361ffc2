"""Push events as a stream: late duplicates dropped within a watermark, new keys inserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import insert_only_merge


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed event files as they come."""
    return spark.readStream.schema(schema).parquet(path)


def distinct_events(events: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """Each key once; a repetition is known for as long as the watermark allows lateness."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def write_new_events(events: DataFrame, table: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Insert the keys that the table hasn't; a batch that is run again inserts nothing. Works off what is there, then
    stops. The check against the table is within a batch, so one writer at a time."""

    def insert(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        one = batch.dropDuplicates(keys)
        new = insert_only_merge(one, spark.table(table), keys) if spark.catalog.tableExists(table) else one
        new.write.mode("append").format("parquet").saveAsTable(table)

    return events.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(window_start, by, n) of tumbling windows. Written by ``write_counts`` they are the counts so far, by
    ``write_final_counts`` those that the watermark has passed."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), by, "n")


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The counts so far, written anew with each batch to a folder of its own under ``path``; works off what is there.
    All windows are kept as state, so this is for windows of bounded number."""

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:09d}")

    return counts.writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_final_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each window once, appended to the files under ``path`` when the watermark has passed its end, and then forgotten:
    state is bounded by the watermark. Works off what is there; later events than the watermark allows don't count."""
    return counts.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the last batch."""
    found = spark.read.parquet(path)
    return found.join(F.broadcast(found.agg(F.max("batch").alias("batch"))), "batch", "left_semi").drop("batch")
