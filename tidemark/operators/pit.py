"""Point-in-time reconstruction from an event log.

An event's pre-image is what held before it: nothing for *added*, the record for *removed*, the previous record for *changed*.
The state on a date is the pre-image of the first event after it, and the current record counts as a last event at the
end of time. So one window per key gives every state, without replaying the log once per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import PitBuildError
from tidemark.schemas import INTERVAL_FIELDS

_END = "9999-12-31"


def pre_image(event: str = "event", record: str = "record", previous: str = "previous"):
    return F.when(F.col(event) == "removed", F.col(record)).when(F.col(event) == "changed", F.col(previous))


def _timeline(current: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, date, seq, pre): the log, closed by the current records."""
    now = current.select(*keys, F.to_date(F.lit(_END)).alias("date"), F.lit(None).cast("long").alias("seq"), F.col("record").alias("pre"))
    return events.select(*keys, "date", F.col("seq").cast("long").alias("seq"), "pre").unionByName(now)


def build_intervals(current: DataFrame, events: DataFrame, keys: list[str], boundary) -> DataFrame:
    """Half-open validity intervals: keys, record, valid_from, valid_to, provable_from.

    ``current``: keys, record. ``events``: keys, date, seq, pre, all after ``boundary`` (a date column or literal).
    One shuffle by key; all windows share it.
    """
    start = F.to_date(boundary if not isinstance(boundary, str) else F.lit(boundary))
    w = Window.partitionBy(*keys).orderBy("date", F.col("seq").asc_nulls_last())
    steps = _timeline(current, events, keys).select(
        *keys, "date", "pre", F.row_number().over(w).alias("n"), F.lead("date").over(w).alias("next_date"), F.lead("pre").over(w).alias("next_pre")
    )
    own = F.struct(F.col("date").alias("date"), F.col("next_pre").alias("state"))
    first = F.struct(start.alias("date"), F.col("pre").alias("state"))
    last_of_day = ~F.col("date").eqNullSafe(F.col("next_date")) & (F.col("date") < F.lit(_END).cast("date"))
    at = F.filter(F.array(F.when(F.col("n") == 1, first), F.when(last_of_day, own)), lambda x: x.isNotNull())
    states = steps.select(*keys, F.explode(at).alias("s")).select(*keys, "s.date", "s.state")
    by_date = Window.partitionBy(*keys).orderBy("date")
    turns = states.withColumn("was", F.lag(F.struct("state")).over(by_date)).filter(F.col("was").isNull() | ~F.col("was.state").eqNullSafe(F.col("state")))
    out = turns.withColumn("valid_to", F.lead("date").over(by_date)).filter("state IS NOT NULL")
    return out.select(*keys, F.col("state").alias("record"), F.col("date").alias("valid_from"), "valid_to", (F.col("date") != start).alias("provable_from"))


def members_on(current: DataFrame, events: DataFrame, keys: list[str], days: list[str]) -> DataFrame:
    """(day, keys, record) on each of some days, by undoing later events: per key the pre-image of the earliest one decides.

    The log is read once; an event goes to the days before it and is combined there before the shuffle.
    """
    asked = F.array(*[F.to_date(F.lit(d)) for d in days])
    line = _timeline(current, events, keys).withColumn("day", F.explode(F.filter(asked, lambda d: d < F.col("date"))))
    order = F.struct("date", F.coalesce("seq", F.lit((1 << 63) - 1)))
    state = line.groupBy("day", *keys).agg(F.min_by(F.struct("pre"), order).alias("s"))
    return state.select("day", *keys, F.col("s.pre").alias("record")).filter("record IS NOT NULL")


def members_asof(current: DataFrame, events: DataFrame, keys: list[str], day: str) -> DataFrame:
    """(keys, record) on a day."""
    return members_on(current, events, keys, [day]).drop("day")


def as_of(intervals: DataFrame, day: str, floor: str | None = None) -> DataFrame:
    """The rows valid on a day, without the interval columns; refuses days before the floor."""
    if floor is not None and day < floor:
        raise PitBuildError(f"{day} lies before {floor}, the first day that can be proven")
    d = F.to_date(F.lit(day))
    return intervals.filter((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (d < F.col("valid_to")))).drop(*INTERVAL_FIELDS)


def as_of_days(intervals: DataFrame, days: list[str]) -> DataFrame:
    """``day`` and the rows valid on it, for some days at once, without the interval columns."""
    held = lambda d: (F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (d < F.col("valid_to")))
    asked = F.array(*[F.to_date(F.lit(d)) for d in days])
    return intervals.withColumn("day", F.explode(F.filter(asked, held))).drop(*INTERVAL_FIELDS)


def join_as_of(facts: DataFrame, intervals: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Facts with the record that was valid on their day: an equi-join on the keys with the range as its residual."""
    held = (F.col("valid_from") <= F.col(day)) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    renamed = intervals.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = held
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    return facts.join(renamed, on).drop(*[f"__{k}" for k in keys])


def violations(events: DataFrame) -> DataFrame:
    """One row: how many events have no date, an unknown kind, or a change without its previous record."""
    return events.agg(
        F.count_if(F.col("date").isNull()).alias("bad_date"),
        F.count_if(F.coalesce(~F.col("event").isin("added", "removed", "changed"), F.lit(True))).alias("bad_kind"),
        F.count_if((F.col("event") == "changed") & F.col("previous").isNull()).alias("no_previous"),
    )


def require_valid(events: DataFrame, boundary: str | None = None) -> None:
    bad = violations(events).first().asDict()
    if any(bad.values()):
        raise PitBuildError(f"the log has events that cannot be replayed: {bad}")
    if "seq" in events.columns:
        found = events.agg(F.count("seq").alias("stamped"), F.count("*").alias("n")).first()
        if 0 < found["stamped"] < found["n"]:
            raise PitBuildError(f"{found['stamped']} of {found['n']} events have a position in the log: events of one day have no order")
    if boundary is not None and events.filter(F.col("date") <= F.to_date(F.lit(boundary))).limit(1).count():
        raise PitBuildError(f"the log has events on or before {boundary}")


def require_free_columns(columns: list[str]) -> None:
    clash = sorted(set(columns) & set(INTERVAL_FIELDS))
    if clash:
        raise PitBuildError(f"records carry reserved columns: {clash}")


def source_floors(events: DataFrame, first_observed: DataFrame) -> DataFrame:
    """(source, floor): the later of the day before the log begins and the source's first observation."""
    start = events.agg(F.date_sub(F.min("date"), 1).alias("__start"))
    return first_observed.crossJoin(F.broadcast(start)).select("source", F.greatest("first_observed", "__start").alias("floor"))
