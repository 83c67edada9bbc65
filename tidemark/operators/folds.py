"""Ordered steps that depend on what was accepted before: chains, leaders, greedy suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chained_groups(df: DataFrame, keys: list[str], at: str, far: Column, name: str = "group_no") -> DataFrame:
    """Number the chains of a key: a row starts one if it is ``far`` from the row before (use ``F.col("__prev")``)."""
    w = Window.partitionBy(*keys).orderBy(at)
    marked = df.withColumn("__prev", F.lag(at).over(w))
    start = F.when(F.col("__prev").isNull() | far, 1).otherwise(0)
    return marked.withColumn(name, F.sum(start).over(w.rangeBetween(Window.unboundedPreceding, 0))).drop("__prev")


# Both folds look at the last element only; their arrays hold distinct days of one key, which the calendar bounds.


def leader_days(days: Column, reach: int) -> Column:
    """Sorted days to (day, leader): a day joins the last leader within ``reach`` days of it, otherwise it leads."""

    def step(acc: Column, d: Column) -> Column:
        last = F.when(F.size(acc) > 0, F.element_at(acc, -1)["leader"])
        leads = last.isNull() | (F.datediff(d, last) > reach)
        return F.concat(acc, F.array(F.struct(d.alias("day"), F.when(leads, d).otherwise(last).alias("leader"))))

    return F.aggregate(days, F.array().cast("array<struct<day:date,leader:date>>"), step)


def accepted_days(days: Column, apart: int) -> Column:
    """Sorted days, without those within ``apart`` days of one accepted earlier."""

    def step(acc: Column, d: Column) -> Column:
        near = (F.size(acc) > 0) & (F.datediff(d, F.try_element_at(acc, F.lit(-1))) <= apart)  # of sorted days the last one is the nearest
        return F.when(near, acc).otherwise(F.concat(acc, F.array(d)))

    return F.aggregate(days, F.array().cast("array<date>"), step)
