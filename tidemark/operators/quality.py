"""Gates: failure shares, staleness, missing sources, policy projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.errors import PolicyError, RefusalError


def allowed_only(df: DataFrame, dataset: str, allowed: dict | None = None, forbidden: frozenset | None = None) -> DataFrame:
    """Only allowlisted columns that are there; a forbidden one or an empty ticker refuses, at planning or at run time."""
    allowed, forbidden = allowed or specs.ALLOWED_FIELDS, forbidden if forbidden is not None else specs.FORBIDDEN_FIELDS
    if dataset not in allowed:
        raise PolicyError(f"unknown dataset {dataset!r}")
    keep = [c for c in allowed[dataset] if c in df.columns]
    if bad := sorted(set(keep) & forbidden):
        raise PolicyError(f"{dataset} would publish {bad}")
    has_ticker = F.coalesce(F.length("ticker") > 0, F.lit(False))
    checked = F.when(has_ticker, F.col("ticker")).otherwise(F.raise_error(F.lit(f"{dataset}: a row has no ticker")))
    return df.select(*[checked.alias("ticker") if c == "ticker" else c for c in keep])


def failure_share(fetches: DataFrame, *by: str) -> DataFrame:
    """(by, total, failed, share); an absent member is not a failure."""
    failed = F.count_if(F.col("status") == "failed")
    return fetches.groupBy(*by).agg(F.count("*").alias("total"), failed.alias("failed"), (failed / F.greatest(F.count("*"), F.lit(1))).alias("share"))


def require_few_failures(fetches: DataFrame, limit: float = specs.FAILURE_LIMIT) -> None:
    row = failure_share(fetches).first()
    if row["share"] > limit:
        raise RefusalError(f"{row['failed']} of {row['total']} fetches failed, more than {limit:.0%}")


def never_succeeded(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    return expected.join(observed.select(key).distinct(), key, "left_anti")


def stale_sources(watermarks: DataFrame, now: str, limit_days: float, slack_days: float = 2.0) -> DataFrame:
    """(source, last_success, stale): older than the limit and its slack, or unreadable."""
    age = F.datediff(F.to_date(F.lit(now)), F.col("last_success"))
    return watermarks.withColumn("stale", F.coalesce(age > F.lit(limit_days + slack_days), F.lit(True)))
