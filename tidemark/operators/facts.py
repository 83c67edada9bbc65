"""Splits and split-adjusted dividends from tagged facts: one DataFrame plan for all companies, hashed by ``cik``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import classify_span, corrected_ratio
from tidemark.operators import folds
from tidemark.operators.matching import contained, later_product, nearest, neighbours, not_overlapping


def split_candidates(facts: DataFrame) -> DataFrame:
    """(cik, ratio, end, filed, high): usable split facts; low confidence for long periods and extreme ratios."""
    ok = facts.filter((F.col("tag") == specs.SPLIT_TAG) & (F.col("unit") == "pure") & (F.col("val") > 0) & (F.col("val") != 1) & F.col("end").isNotNull() & F.col("filed").isNotNull())
    short = F.col("start").isNull() | (F.datediff("end", "start") <= 45)
    return ok.select("cik", F.col("val").alias("ratio"), "end", "filed", (short & F.col("val").between(0.005, 100)).alias("high"))


def split_clusters(candidates: DataFrame, days: int = specs.SPLIT_CHAIN_DAYS) -> DataFrame:
    """One row per chain of equal ratios: cik, ratio, effective_date (the first end), filed (the first), confidence."""
    rounded = candidates.withColumn("__r", F.round("ratio", 9))
    numbered = folds.chained_groups(rounded, ["cik", "__r"], "end", F.datediff("end", "__prev") > days)
    grouped = numbered.groupBy("cik", "__r", "group_no").agg(
        F.min_by("ratio", "end").alias("ratio"), F.min("end").alias("effective_date"), F.min("filed").alias("filed"), F.bool_or("high").alias("high")
    )
    return grouped.select("cik", "ratio", "effective_date", "filed", F.when(F.col("high"), "high").otherwise("low").alias("confidence"))


def splits(facts: DataFrame, shares: DataFrame) -> DataFrame:
    """Clusters with the direction checked against share counts 10 to 270 days away on both sides."""
    found = split_clusters(split_candidates(facts))
    near = neighbours(found, shares, ["cik"], "end", "effective_date", "val", shift=(lambda d: F.date_sub(d, 10), lambda d: F.date_add(d, 10)))
    within = lambda side: F.when(F.abs(F.datediff(f"{side}.at", "effective_date")) <= 270, F.col(f"{side}.value"))
    ratio = corrected_ratio(F.col("ratio"), within("before"), within("after"))
    flags = F.when(ratio != F.col("ratio"), F.array(F.lit("direction_inverted_by_share_check"))).otherwise(F.array().cast("array<string>"))
    return near.select("cik", "effective_date", ratio.alias("ratio"), "confidence", "filed", flags.alias("flags"))


def _tag_index(tags: tuple[str, ...]):
    return F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag")) - 1


_RECORD = ["cik", "period_start", "period_end", "span_type", "dps", "source_tag", "filed", "derived", "approximate", "flags"]


def per_share_facts(facts: DataFrame) -> DataFrame:
    """Usable per-share facts of all tags: known units, no negative value, end and filing date there."""
    return facts.filter(F.col("tag").isin(*specs.DPS_TAGS) & F.col("unit").isin("USD/shares", "pure") & (F.col("val") >= 0) & F.col("end").isNotNull() & F.col("filed").isNotNull())


def cash_facts(facts: DataFrame) -> DataFrame:
    """Usable totals of cash paid."""
    return facts.filter(F.col("tag").isin(*specs.CASH_TAGS) & (F.col("unit") == "USD") & (F.col("val") >= 0) & F.col("start").isNotNull() & F.col("end").isNotNull() & F.col("filed").isNotNull())


def per_share_periods(facts: DataFrame, split_rows: DataFrame) -> DataFrame:
    """One record per (cik, start, end): best tag, then latest filing, then the last fact; disagreement over all tags is flagged."""
    based = later_product(per_share_facts(facts), split_rows, ["cik"], "filed", "effective_date", "ratio").withColumn("dps", F.col("val") / F.col("factor"))
    rank = F.struct(-_tag_index(specs.DPS_TAGS), F.col("filed"), F.col("ord"))
    periods = based.groupBy("cik", "start", "end").agg(
        F.max_by(F.struct("dps", "tag", "filed", "unit"), rank).alias("best"), F.max("dps").alias("hi"), F.min("dps").alias("lo")
    )
    torn = (F.col("hi") > 0) & ((F.col("hi") - F.col("lo")) / F.col("hi") > specs.RESTATEMENT_TOLERANCE)
    flags = F.concat(F.when(F.col("best.unit") == "pure", F.array(F.lit("suspect_unit"))).otherwise(F.array().cast("array<string>")), F.when(torn, F.array(F.lit("restatement_disagreement"))).otherwise(F.array().cast("array<string>")))
    return periods.select(
        "cik", F.col("start").alias("period_start"), F.col("end").alias("period_end"), classify_span(F.col("start"), F.col("end")).alias("span_type"),
        F.col("best.dps").alias("dps"), F.col("best.tag").alias("source_tag"), F.col("best.filed").alias("filed"), F.lit(False).alias("derived"), F.lit(False).alias("approximate"), flags.alias("flags"),
    )


def missing_quarters(records: DataFrame) -> DataFrame:
    """Last quarters as annual minus the three inside it.

    Conditions on an annual do not depend on which others succeed, so they filter first; then, in order of (end, filed), an annual within 10
    days of a successful one is dropped by a fold over the company's few remaining ones.
    """
    annual = records.filter((F.col("span_type") == "annual") & F.col("period_start").isNotNull())
    quarters = records.filter((F.col("span_type") == "quarterly") & F.col("period_start").isNotNull())
    held = contained(annual, quarters, ["cik"], 7).groupBy("cik", "period_start", "period_end", "dps", "source_tag", "filed").agg(
        F.count("*").alias("n"), F.max("in_period_end").alias("gap_start"), F.aggregate(F.array_sort(F.collect_list("in_dps")), F.lit(0.0), lambda a, x: a + x).alias("part")
    )
    held = held.filter((F.col("n") == 3) & F.datediff("period_end", "gap_start").between(60, 130))
    small = records.filter(F.col("span_type").isin("monthly", "instant")).select(F.col("cik").alias("__cik"), F.col("period_end").alias("__e"))
    inside = (F.col("cik") == F.col("__cik")) & (F.col("gap_start") < F.col("__e")) & (F.col("__e") <= F.date_add("period_end", 7))
    held = held.join(small, inside, "left_anti").withColumn("value", F.col("dps") - F.col("part")).filter("value >= -0.005")
    row = F.struct("period_end", "filed", "gap_start", "value", "source_tag", "period_start")
    near = lambda acc, r: (F.size(acc) > 0) & (F.datediff(r["period_end"], F.try_element_at(acc, F.lit(-1))["period_end"]) <= 10)  # noqa: E731 - sorted: the last one is the nearest
    kept = F.aggregate(
        F.array_sort(F.collect_list(row)), F.array().cast("array<struct<period_end:date,filed:date,gap_start:date,value:double,source_tag:string,period_start:date>>"),
        lambda acc, r: F.when(near(acc, r), acc).otherwise(F.concat(acc, F.array(r))),
    )
    out = held.groupBy("cik").agg(kept.alias("kept")).select("cik", F.explode("kept").alias("r")).select("cik", "r.*")
    flags = F.when(F.col("value") < 0, F.array(F.lit("derived_q4"), F.lit("clamped_negative"))).otherwise(F.array(F.lit("derived_q4")))
    return out.select(
        "cik", F.date_add("gap_start", 1).alias("period_start"), "period_end", F.lit("quarterly").alias("span_type"), F.greatest("value", F.lit(0.0)).alias("dps"),
        "source_tag", "filed", F.lit(True).alias("derived"), F.lit(False).alias("approximate"), flags.alias("flags"),
    )


def cash_quarters(facts: DataFrame) -> DataFrame:
    """Discrete periods (cik, tag, period_start, period_end, value, filed) from year-to-date cash totals.

    Of equal periods the latest filing counts, the first of equal filings. A chain joins facts whose start is within five days of the
    chain's first; inside it each value is less the one before, which moves on even when a row is dropped.
    """
    once = cash_facts(facts).groupBy("cik", "tag", "start", "end").agg(F.max_by(F.struct("val", "filed"), F.struct("filed", -F.col("ord"))).alias("b")).select("cik", "tag", "start", "end", "b.*")
    leaders = once.groupBy("cik", "tag").agg(folds.leader_days(F.array_sort(F.collect_set("start")), 5).alias("l")).select("cik", "tag", F.explode("l").alias("l"))
    chained = once.join(leaders.select("cik", "tag", F.col("l.day").alias("start"), F.col("l.leader").alias("leader")), ["cik", "tag", "start"])
    w = Window.partitionBy("cik", "tag", "leader").orderBy("end", "start")
    before_end, before_val = F.lag("end").over(w), F.lag("val").over(w)
    steps = chained.withColumn("period_start", F.coalesce(F.date_add(before_end, 1), F.col("start"))).withColumn("value", F.col("val") - F.coalesce(before_val, F.lit(0.0)))
    whole = F.col("value") >= -0.005 * F.greatest(F.lit(1.0), F.abs("val"))
    return steps.filter(whole).select("cik", "tag", "period_start", F.col("end").alias("period_end"), "value", "filed")


def cash_fallback(facts: DataFrame, shares: DataFrame, split_rows: DataFrame) -> DataFrame:
    """Approximate per-share records: cash over the nearest share count within 180 days; per company the first tag with any row counts alone."""
    pieces = cash_quarters(facts).withColumn("span_type", classify_span(F.col("period_start"), F.col("period_end"))).filter(F.col("span_type").isin("monthly", "quarterly", "semiannual"))
    near = nearest(pieces, shares, ["cik"], "end", "period_end", "val", 180).filter("match IS NOT NULL").withColumn("shares_date", F.col("match.at"))
    based = later_product(near, split_rows, ["cik"], "shares_date", "effective_date", "ratio").withColumn("i", _tag_index(specs.CASH_TAGS))
    return first_tag(based, ["cik"], "i").select(
        "cik", "period_start", "period_end", "span_type", (F.greatest("value", F.lit(0.0)) / F.col("match.value") / F.col("factor")).alias("dps"),
        F.col("tag").alias("source_tag"), "filed", F.lit(False).alias("derived"), F.lit(True).alias("approximate"), F.array(F.lit("aggregate_fallback")).alias("flags"),
    )


def first_tag(rows: DataFrame, keys: list[str], index: str) -> DataFrame:
    """The rows of each key's best tag (the lowest index); a tag counts as a whole."""
    return rows.withColumn("__best", F.min(index).over(Window.partitionBy(*keys))).filter(F.col(index) == F.col("__best")).drop("__best")


def dividends(facts: DataFrame, shares: DataFrame, split_rows: DataFrame) -> DataFrame:
    """Per-share records with derived quarters, and cash records for stretches they do not cover."""
    periods = per_share_periods(facts, split_rows)
    authoritative = periods.unionByName(missing_quarters(periods))
    extra = not_overlapping(cash_fallback(facts, shares, split_rows), authoritative, ["cik"], specs.OVERLAP_DAYS)
    return authoritative.unionByName(extra).select(*_RECORD)


def publishable_dividends(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row per requested symbol and record, in the published schema and order."""
    return resolved.join(rows, "cik").select(
        "ticker", "cik", "period_start", "period_end", "span_type", F.col("dps").alias("dps_current_basis"), "source_tag", "filed", "derived", "approximate", F.array_join("flags", ",").alias("flags")
    ).orderBy("ticker", "period_end", F.coalesce("period_start", "period_end"))


def publishable_splits(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    return resolved.join(rows, "cik").select("ticker", "cik", "effective_date", "ratio", "confidence", "filed", "flags").orderBy("ticker", "effective_date")
