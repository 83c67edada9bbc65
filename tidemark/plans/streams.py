"""The driver's event table as a keyed state stream: a log with current state, as the catalog's queries use it.

A user's state is the type of the latest event, and an error ends it. Rows from ``LOG_START`` on form the log; earlier ones only
establish state, so there are members at the boundary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG_START = "2024-01-08"
BOUNDARY = "2024-01-07"
AS_OF = "2024-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, date, seq, pre, post: every event with the state before and after it."""
    w = Window.partitionBy("user_id").orderBy("seq")
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("date"), F.col("event_id").alias("seq"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("post")
    )
    return rows.withColumn("pre", F.lag("post").over(w))


def log(rows: DataFrame) -> DataFrame:
    """The log: changes of state from the log's first day on, with their kind."""
    kind = F.when(F.col("pre").isNull(), "added").when(F.col("post").isNull(), "removed").otherwise("changed")
    return rows.filter(~F.col("pre").eqNullSafe(F.col("post")) & (F.col("date") >= F.to_date(F.lit(LOG_START)))).withColumn("event", kind)


def current(rows: DataFrame) -> DataFrame:
    """user_id, record: the state after the last event."""
    last = rows.groupBy("user_id").agg(F.max_by(F.struct("post"), "seq").alias("s"))
    return last.select("user_id", F.col("s.post").alias("record")).filter("record IS NOT NULL")
