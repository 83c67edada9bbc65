"""Filings worth a flag, and the log they are added to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import item_events, iso_week
from tidemark.operators.diff import first_wins


def flagged_filings(filings: DataFrame) -> DataFrame:
    """(cik, pos, form, filing_date, accession, items) to flagged events.

    A form that ends a listing matches exactly; current reports match by prefix, so their amendments count. Null forms do not.
    """
    delisting = F.col("form").isin(*specs.DELISTING_FORMS)
    named = item_events(F.col("items"), specs.FLAGGED_ITEMS)
    event = F.when(delisting, F.lit("delisting_form")).when(F.col("form").startswith("8-K"), named)
    return filings.withColumn("event", event).filter("event IS NOT NULL").select("cik", "form", "filing_date", "accession", "event", F.col("items"))


def add_new(log: DataFrame, found: DataFrame, order: list[str]) -> DataFrame:
    """Found events that the log does not have by (cik, accession), nulls being equal; the first of a batch counts."""
    once = first_wins(found, ["cik", "accession"], order)
    known = log.select(F.col("cik").alias("__c"), F.col("accession").alias("__a")).distinct()
    return once.join(known, F.col("cik").eqNullSafe(F.col("__c")) & F.col("accession").eqNullSafe(F.col("__a")), "left_anti")


def pending(universe: DataFrame, progress: DataFrame, day: str) -> DataFrame:
    """Companies not yet done in the ISO week of ``day``."""
    week = iso_week(F.to_date(F.lit(day)))
    return universe.join(progress.filter(F.col("week") == week), "cik", "left_anti")
