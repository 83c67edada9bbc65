"""Keyed snapshots: difference, duplicate keys, replay-safe appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of the order key that divide a batch into ranges for numbering.
PREFIX = 2


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in ``order``. Aggregates before the shuffle, unlike a ranking window."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key (null keys are keys): the first in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: list[str], source: str, as_of: str) -> DataFrame:
    """Events between two snapshots of one schema: date, source, event, record, previous, and the order key.

    Whole records are compared, nulls equal to nulls; a removed key carries the record it had.
    """
    old = previous.select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.struct(*sorted(previous.columns)).alias("__old"))
    new = current.select(*[F.col(k).alias(f"__n_{k}") for k in keys], F.struct(*sorted(current.columns)).alias("__new"))
    same: Column = F.lit(True)
    for k in keys:
        same = same & F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}"))
    both = old.join(new, same, "full_outer")
    kind = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(~F.col("__old").eqNullSafe(F.col("__new")), "changed")
    record = F.coalesce("__new", "__old")
    key_text = F.concat_ws("\x1f", *[F.coalesce(record[k].cast("string"), F.lit("")) for k in keys])
    return both.select(
        F.to_date(F.lit(as_of)).alias("date"), F.lit(source).alias("source"), kind.alias("event"), record.alias("record"),
        F.when(kind == "changed", F.col("__old")).alias("previous"), key_text.alias("order_key"),
    ).filter("event IS NOT NULL")


def entity_key(source: Column, record: Column, keys: dict[str, list[str]]) -> Column:
    """What an event is about, as text: its source's key fields, or the whole record for a source that is no longer known."""
    known = F.lit(None).cast("string")
    for name, fields in keys.items():
        known = F.when(source == name, F.to_json(F.struct(*[record[f].alias(f) for f in fields]))).otherwise(known)
    return F.concat_ws("\x1f", source, F.coalesce(known, F.to_json(record)))


def event_counts(events: DataFrame, *by: str) -> DataFrame:
    """How many events each source (or other grouping) has; counted before repeats are dropped."""
    return events.groupBy(*by).agg(F.count("*").alias("n"))


_PAYLOAD = ["event", "record", "previous"]


def append_batch(log: DataFrame, batch: DataFrame, entity: list[str], within: list[str] | None = None) -> DataFrame:
    """New events as rows to append: those identical, but for the date, to their entity's event before are dropped.

    The event before is the one ahead of it in the batch, in order of date and ``within``, or the latest logged one. ``seq`` continues
    the log's, in order of (date, source, event kind, order key). It is counted inside small ranges of that order and the ranges are
    offset by a table of their sizes, so no task holds the batch.
    """
    within = [*(["date"] if "date" in batch.columns else []), *(within or [])]
    days = within[:1] if "date" in batch.columns else []
    latest = log.groupBy("source", *entity).agg(F.max_by(F.struct(*_PAYLOAD), F.col("seq")).alias("__now"))
    rows = batch.withColumn("__now", F.struct(*_PAYLOAD)).withColumn("__new", F.lit(1))
    both = rows.unionByName(latest.withColumn("__new", F.lit(0)), allowMissingColumns=True)
    before = F.lag(F.struct("__now")).over(Window.partitionBy("source", *entity).orderBy("__new", *within, "event", "order_key"))
    fresh = both.withColumn("__was", before).filter("__new = 1").filter(F.col("__was").isNull() | ~F.col("__was.__now").eqNullSafe(F.col("__now")))
    fresh = fresh.select(*batch.columns).withColumn("__part", F.substring("order_key", 1, PREFIX))
    ranges = [*days, "source", "event", "__part"]
    order = [F.col(c).asc_nulls_first() for c in ranges]
    sizes = fresh.groupBy(*ranges).agg(F.count("*").alias("__n"))
    top = log.agg(F.coalesce(F.max("seq"), F.lit(-1)).alias("__top"))
    ahead = F.coalesce(F.sum("__n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per range
    starts = sizes.crossJoin(F.broadcast(top)).select(*[F.col(c).alias(f"__r_{c}") for c in ranges], (F.col("__top") + ahead).alias("__start"))
    on = F.lit(True)
    for c in ranges:
        on = on & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    rank = F.row_number().over(Window.partitionBy(*ranges).orderBy("order_key", *within))  # an entity has one event a day and kind, but for ``within``
    return fresh.withColumn("__rank", rank).join(starts, on).withColumn("seq", (F.col("__start") + F.col("__rank")).cast("long")).drop("__start", "__rank", "__part", "order_key", *[f"__r_{c}" for c in ranges])


def without_repeats(events: DataFrame, entity: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """A log without rows that equal their entity's previous row."""
    w = Window.partitionBy(*entity).orderBy(*order)
    before = F.lag(F.struct(F.struct(*payload).alias("p"))).over(w)
    return events.withColumn("__b", before).filter(F.col("__b").isNull() | ~F.col("__b.p").eqNullSafe(F.struct(*payload))).drop("__b")
