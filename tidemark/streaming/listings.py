"""Listing events as a stream: every landed batch goes through the same replay-safe append.

The log is a Parquet folder with a part per stream and batch. A batch that runs again finds its part complete and leaves it, even
after later batches; an unfinished part is replaced. So the log is exactly-once although the sink is only at-least-once. A
stream that lost its checkpoint is a new stream: its events meet themselves as the latest in the log and are dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.diff import append_batch


def append_stream(events: DataFrame, log_path: str, checkpoint: str, entity: list[str], log_schema: str) -> StreamingQuery:
    """``events``: a stream with date, source, entity columns, event, record, previous and order_key. Runs what is there, then stops.

    ``log_schema``: the columns of the log, with seq and batch_id.
    """
    stream = _stream_id(events.sparkSession, checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        append_part(batch, log_path, stream, batch_id, entity, log_schema)

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_part(batch: DataFrame, log_path: str, stream: str, batch_id: int, entity: list[str], log_schema: str) -> None:
    """Write what is new in ``batch`` as one part of the log, unless that part is complete."""
    spark, part = batch.sparkSession, f"{log_path}/part={stream}-{batch_id}"
    if _there(spark, f"{part}/_SUCCESS"):
        return
    before = read_log(spark, log_path, log_schema, without=f"{stream}-{batch_id}")
    append_batch(before, batch, entity).withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(part)


def read_log(spark: SparkSession, path: str, schema: str, without: str | None = None) -> DataFrame:
    if not _there(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, part string").parquet(path)
    return (rows if without is None else rows.filter(F.col("part") != without)).drop("part")


def _there(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives and dies with the checkpoint."""
    mark = f"{checkpoint}/stream_id"
    if not _there(spark, f"{mark}/_SUCCESS"):
        spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.mode("overwrite").text(mark)
    return spark.read.text(mark).first()[0]


def hourly_metrics(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Counts by kind and hour of an event stream; rows later than ``late`` no longer count. On a table, all rows count."""
    return events.withWatermark("ts", late).groupBy("event_type", F.window("ts", "1 hour")).agg(F.count("*").alias("mentions"), F.sum("value").alias("engagement"))


def chained_sessions(events: DataFrame, gap: str = "12 hours", late: str = "1 hour") -> DataFrame:
    """The streaming form of chained gaps: session windows per user and kind."""
    return events.withWatermark("ts", late).groupBy("user_id", "event_type", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
