"""Join-like matching: nearest as-of, later products, overlaps, containment, spelling variants.

As-of matching never pairs rows: facts and series go through one sort per key, and the neighbours are read off windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import interval_start, overlap_days, symbol_variants


def neighbours(facts: DataFrame, series: DataFrame, keys: list[str], at: str, when: str, value: str, shift=None) -> DataFrame:
    """``facts`` with ``before`` and ``after``: structs (at, value) of the nearest series rows on or before, and on or after, ``when``.

    Equal times in the series count as one, with the least value. ``shift`` = (earlier, later) moves the two bounds, as
    functions of the fact's time: a row counts as before up to ``earlier(when)``, as after from ``later(when)``.
    """
    points = series.filter(F.col(at).isNotNull()).groupBy(*keys, F.col(at).alias("__t")).agg(F.min(value).alias("__v"))
    id_cols = facts.columns
    earlier, later = shift or (lambda c: c, lambda c: c)

    def side(bound: Column, name: str, backward: bool) -> tuple[DataFrame, Column]:
        asked = facts.select(*keys, bound.alias("__t"), F.struct(*id_cols).alias("__fact"))
        both = asked.withColumn("__v", F.lit(None).cast(dict(points.dtypes)["__v"])).unionByName(points.withColumn("__fact", F.lit(None).cast(asked.schema["__fact"].dataType)))
        tie = F.col("__fact").isNotNull()  # on equal times the series row must already have been passed
        order = [F.col("__t").asc(), tie.asc()] if backward else [F.col("__t").desc(), tie.asc()]
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        point = F.when(F.col("__fact").isNull(), F.struct(F.col("__t").alias("at"), F.col("__v").alias("value")))
        return both.withColumn(name, F.last(point, ignorenulls=True).over(w)).filter("__fact IS NOT NULL")

    if shift is None:  # one union serves both directions
        asked = facts.select(*keys, F.col(when).alias("__t"), F.struct(*id_cols).alias("__fact"))
        both = asked.withColumn("__v", F.lit(None).cast(dict(points.dtypes)["__v"])).unionByName(points.withColumn("__fact", F.lit(None).cast(asked.schema["__fact"].dataType)))
        is_fact = F.col("__fact").isNotNull()
        point = F.when(~is_fact, F.struct(F.col("__t").alias("at"), F.col("__v").alias("value")))
        up = Window.partitionBy(*keys).orderBy(F.col("__t").asc(), is_fact.asc()).rowsBetween(Window.unboundedPreceding, 0)
        down = Window.partitionBy(*keys).orderBy(F.col("__t").desc(), is_fact.asc()).rowsBetween(Window.unboundedPreceding, 0)
        found = both.withColumn("before", F.last(point, ignorenulls=True).over(up)).withColumn("after", F.last(point, ignorenulls=True).over(down)).filter(is_fact)
        return found.select("__fact.*", "before", "after")
    first = side(earlier(F.col(when)), "before", True).select("__fact.*", "before")
    id_cols = first.columns
    facts = first
    return side(later(F.col(when)), "after", False).select("__fact.*", "after")


def nearest(facts: DataFrame, series: DataFrame, keys: list[str], at: str, when: str, value: str, tolerance, distance=None) -> DataFrame:
    """``facts`` with ``match`` (at, value): the nearest series row either way within ``tolerance``; on a tie the earlier one."""
    apart = distance or (lambda a, b: F.abs(F.datediff(a, b)))
    found = neighbours(facts, series, keys, at, when, value)
    back, forth = apart(F.col("before.at"), F.col(when)), apart(F.col("after.at"), F.col(when))
    best = F.when(F.col("after").isNull() | (back <= forth), F.col("before")).otherwise(F.col("after"))
    dist = F.when(F.col("after").isNull() | (back <= forth), back).otherwise(forth)
    return found.withColumn("match", F.when(dist <= tolerance, best)).drop("before", "after")


def later_product(facts: DataFrame, splits: DataFrame, keys: list[str], basis: str, effective: str, ratio: str, name: str = "factor") -> DataFrame:
    """``facts`` with the product of the ratios of all splits strictly after ``basis``; 1 without any.

    The products from each split on are made once per key, latest split first, so they are the same on every run; then facts and
    splits go through one sort, and each fact reads the product of the nearest split after it. A null ``basis`` has no split after it.
    """
    latest_first = F.reverse(F.array_sort(F.collect_list(F.struct(F.col(effective).alias("d"), F.col(ratio).alias("r")))))
    running = F.aggregate(
        "__s", F.array().cast("array<double>"), lambda acc, s: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(1.0)) * s["r"]))
    )
    points = splits.filter(F.col(effective).isNotNull()).groupBy(*keys).agg(latest_first.alias("__s")).select(*keys, F.posexplode(F.arrays_zip(F.col("__s.d").alias("d"), running.alias("p"))).alias("__i", "__z"))
    points = points.select(*keys, F.col("__z.d").alias("__t"), "__i", F.col("__z.p").alias("__p"))
    asked = facts.select(*keys, F.col(basis).alias("__t"), F.lit(-1).alias("__i"), F.lit(None).cast("double").alias("__p"), F.struct(*facts.columns).alias("__fact"))
    both = asked.unionByName(points, allowMissingColumns=True)
    # backwards in time; at equal times facts come before splits, which are not after them
    w = Window.partitionBy(*keys).orderBy(F.col("__t").desc_nulls_first(), "__i").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__f", F.coalesce(F.last("__p", ignorenulls=True).over(w), F.lit(1.0))).filter("__fact IS NOT NULL")
    return found.select("__fact.*", F.col("__f").alias(name))


def not_overlapping(candidates: DataFrame, covered: DataFrame, keys: list[str], least_days: int, start: str = "period_start", end: str = "period_end") -> DataFrame:
    """Candidates that share fewer than ``least_days`` days with every covered period of their key."""
    held = covered.select(*[F.col(k).alias(f"__{k}") for k in keys], interval_start(F.col(start), F.col(end)).alias("__s"), F.col(end).alias("__e"))
    on = overlap_days(interval_start(F.col(start), F.col(end)), F.col(end), F.col("__s"), F.col("__e")) >= least_days
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    return candidates.join(held, on, "left_anti")


def contained(outer: DataFrame, inner: DataFrame, keys: list[str], slack: int, start: str = "period_start", end: str = "period_end") -> DataFrame:
    """Pairs of an outer period and the inner ones inside it, give or take ``slack`` days; inner columns get the prefix ``in_``."""
    ins = inner.select(*[F.col(c).alias(f"in_{c}") for c in inner.columns])
    on = (F.col(f"in_{start}") >= F.date_sub(start, slack)) & (F.col(f"in_{end}") <= F.date_add(end, slack))
    for k in keys:
        on = on & (F.col(k) == F.col(f"in_{k}"))
    return outer.join(ins, on)


def resolve_symbols(asked: DataFrame, lookup: DataFrame, symbol: str = "ticker", value: str = "cik", order: str | None = None) -> DataFrame:
    """(symbol upper-cased and stripped, value): what the lookup has for the first spelling variant that it knows.

    The lookup is keyed by upper-case symbol; of duplicates the last counts, by ``order`` or else by value. If that is
    zero or null, the symbol has no answer: later variants are not tried.
    """
    known = lookup.groupBy(F.upper(symbol).alias("__v")).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(order or value, value)).alias("__k"))
    tries = asked.select(F.upper(F.trim(symbol)).alias(symbol), F.posexplode(symbol_variants(F.col(symbol))).alias("__pos", "__v")).distinct()
    first = tries.join(known, "__v").groupBy(symbol).agg(F.min_by(F.col("__k.v"), "__pos").alias(value))
    return first.filter(F.coalesce(F.col(value) != 0, F.lit(False)))


def unresolved(asked: DataFrame, resolved: DataFrame, symbol: str = "ticker") -> DataFrame:
    return asked.join(resolved.select(F.col(symbol).alias("__r")), F.upper(F.trim(symbol)) == F.col("__r"), "left_anti")
