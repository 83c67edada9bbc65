import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.operators import facts, matching

CASH, PAID, DECLARED = specs.CASH_TAGS[0], specs.DPS_TAGS[0], specs.DPS_TAGS[1]


def d(s):
    return dt.date.fromisoformat(s) if s else None


def frame(spark, rows):
    """rows: (tag, unit, start, end, val, filed)."""
    made = [(1, t, u, i, d(s), d(e), float(v), d(f)) for i, (t, u, s, e, v, f) in enumerate(rows)]
    return spark.createDataFrame(made, "cik bigint, tag string, unit string, ord bigint, start date, end date, val double, filed date")


def shares(spark, rows):
    return spark.createDataFrame([(1, d(e), float(v)) for e, v in rows], "cik bigint, end date, val double")


def splits(spark, rows):
    return spark.createDataFrame([(1, d(e), float(r)) for e, r in rows], "cik bigint, effective_date date, ratio double")


def split(end, val, filed, start=None):
    return (specs.SPLIT_TAG, "pure", start, end, val, filed)


def test_repeated_split_facts_are_one_event(spark):
    rows = [split("2014-06-09", 7, "2014-07-01"), split("2015-06-01", 7, "2015-07-01"), split("2020-08-31", 4, "2020-10-30"), split("2020-08-31", 1, "2020-10-30")]
    got = facts.splits(frame(spark, rows), shares(spark, [])).orderBy("effective_date").collect()
    assert [(r["ratio"], str(r["effective_date"]), r["confidence"], r["flags"]) for r in got] == [(7.0, "2014-06-09", "high", []), (4.0, "2020-08-31", "high", [])]


def test_chains_end_after_a_gap(spark):
    rows = [split("2019-01-01", 2, "2019-02-01"), split("2020-01-01", 2, "2020-02-01"), split("2020-12-01", 2, "2021-02-01"), split("2024-01-01", 2, "2024-02-01", "2023-01-01"), split("2024-01-01", 200, "2024-02-01")]
    got = facts.splits(frame(spark, rows), shares(spark, [])).orderBy("effective_date", "ratio").collect()
    assert [(str(r["effective_date"]), r["ratio"], r["confidence"]) for r in got] == [("2019-01-01", 2.0, "high"), ("2024-01-01", 2.0, "low"), ("2024-01-01", 200.0, "low")]


def test_direction_follows_the_share_count(spark):
    got = facts.splits(frame(spark, [split("2021-07-30", 8, "2021-10-01")]), shares(spark, [("2021-06-30", 800), ("2021-09-30", 100), ("2021-07-29", 5), ("2020-01-01", 7)])).first()
    assert got["ratio"] == 0.125 and got["flags"] == ["direction_inverted_by_share_check"]
    far = facts.splits(frame(spark, [split("2021-07-30", 8, "2021-10-01")]), shares(spark, [("2020-06-30", 800), ("2021-09-30", 100)])).first()
    assert far["ratio"] == 8.0


def test_cumulative_factor_is_strictly_later(spark):
    asked = spark.createDataFrame([(1, d("2014-01-01")), (1, d("2014-06-09")), (1, d("2020-08-31")), (2, d("2014-01-01"))], "cik bigint, on date")
    got = matching.later_product(asked, splits(spark, [("2014-06-09", 7), ("2020-08-31", 4)]), ["cik"], "on", "effective_date", "ratio")
    assert sorted((r["cik"], str(r["on"]), r["factor"]) for r in got.collect()) == [(1, "2014-01-01", 28.0), (1, "2014-06-09", 4.0), (1, "2020-08-31", 1.0), (2, "2014-01-01", 1.0)]


def test_restatements_agree_after_normalisation(spark):
    rows = [(PAID, "USD/shares", "2014-01-01", "2014-03-31", 3.08, "2014-04-24"), (PAID, "USD/shares", "2014-01-01", "2014-03-31", 0.44, "2015-04-24")]
    got = facts.per_share_periods(frame(spark, rows), splits(spark, [("2014-06-09", 7)])).first()
    assert got["dps"] == 0.44 and got["flags"] == [] and str(got["filed"]) == "2015-04-24"


def test_priority_ties_and_flags(spark):
    rows = [
        (DECLARED, "USD/shares", None, "2020-03-31", 0.9, "2021-01-01"),
        (PAID, "pure", None, "2020-03-31", 0.5, "2020-05-01"),
        (PAID, "pure", None, "2020-03-31", 0.6, "2020-05-01"),
        (PAID, "USD/shares", None, "2020-06-30", 0.0, "2020-08-01"),
        (PAID, "USD/shares", None, "2020-06-30", -1.0, "2020-09-01"),
    ]
    got = facts.per_share_periods(frame(spark, rows), splits(spark, [])).orderBy("period_end").collect()
    assert (got[0]["dps"], got[0]["source_tag"], got[0]["flags"]) == (0.6, PAID, ["suspect_unit", "restatement_disagreement"])
    assert (got[1]["dps"], got[1]["span_type"], got[1]["flags"]) == (0.0, "instant", [])


QUARTERS = [("2023-01-01", "2023-03-31"), ("2023-04-01", "2023-06-30"), ("2023-07-01", "2023-09-30")]


def quarterly(v=0.5):
    return [(PAID, "USD/shares", s, e, v, "2024-01-15") for s, e in QUARTERS]


def annual(v, start="2023-01-01", end="2023-12-31", tag=PAID):
    return (tag, "USD/shares", start, end, v, "2024-02-15")


@pytest.mark.parametrize(
    "extra, wanted",
    [
        ([annual(2.2)], [(0.7, "2023-10-01", "2023-12-31", ["derived_q4"])]),
        ([annual(1.2)], []),
        ([annual(1.498)], [(0.0, "2023-10-01", "2023-12-31", ["derived_q4", "clamped_negative"])]),
        ([annual(2.2), annual(2.3, "2022-12-30", "2023-12-29", DECLARED)], [(0.8, "2023-10-01", "2023-12-29", ["derived_q4"])]),
        ([annual(2.2), (PAID, "USD/shares", "2023-11-01", "2023-11-30", 0.1, "2024-01-15")], []),
        ([annual(1.2, "2022-12-30", "2023-12-29", DECLARED), annual(2.2)], [(0.7, "2023-10-01", "2023-12-31", ["derived_q4"])]),
    ],
)
def test_last_quarters(spark, extra, wanted):
    periods = facts.per_share_periods(frame(spark, quarterly() + extra), splits(spark, []))
    got = [(round(r["dps"], 6), str(r["period_start"]), str(r["period_end"]), r["flags"]) for r in facts.missing_quarters(periods).collect()]
    assert got == wanted


def test_cash_chain_is_differenced(spark):
    rows = [(CASH, "USD", "2023-01-01", e, v * 1e6, "2024-02-01") for e, v in (("2023-03-31", 5), ("2023-06-30", 11), ("2023-09-30", 18), ("2023-12-31", 26))]
    rows[1] = (CASH, "USD", "2023-01-03", *rows[1][3:])
    got = facts.cash_fallback(frame(spark, rows), shares(spark, [("2023-06-30", 1e7), ("2023-10-20", 1e7)]), splits(spark, [])).orderBy("period_end").collect()
    assert [round(r["dps"], 6) for r in got] == [0.5, 0.6, 0.7, 0.8]
    assert all(r["approximate"] and r["flags"] == ["aggregate_fallback"] for r in got)


def test_a_broken_chain_moves_on_and_ties_take_the_first(spark):
    rows = [(CASH, "USD", "2023-01-01", "2023-03-31", 5, "2024-02-01"), (CASH, "USD", "2023-01-01", "2023-03-31", 9, "2024-02-01"), (CASH, "USD", "2023-01-01", "2023-06-30", 3, "2024-02-01"), (CASH, "USD", "2023-01-01", "2023-09-30", 8, "2024-02-01")]
    got = {str(r["period_end"]): r["value"] for r in facts.cash_quarters(frame(spark, rows)).collect()}
    assert got == {"2023-03-31": 5.0, "2023-09-30": 5.0}


def test_first_cash_tag_hides_the_second(spark):
    rows = [(specs.CASH_TAGS[1], "USD", "2023-01-01", "2023-03-31", 7, "2024-02-01"), (CASH, "USD", "2023-04-01", "2023-06-30", 6, "2024-02-01")]
    got = facts.cash_fallback(frame(spark, rows), shares(spark, [("2023-05-01", 2)]), splits(spark, [])).collect()
    assert [r["source_tag"] for r in got] == [CASH]
    only = facts.cash_fallback(frame(spark, rows[:1]), shares(spark, [("2023-05-01", 2)]), splits(spark, [])).collect()
    assert [r["source_tag"] for r in only] == [specs.CASH_TAGS[1]]


def test_share_basis_is_the_date_of_the_shares(spark):
    rows = [(CASH, "USD", "2023-01-01", "2023-03-31", 10, "2023-05-01")]
    got = facts.cash_fallback(frame(spark, rows), shares(spark, [("2023-04-20", 10)]), splits(spark, [("2023-04-10", 0.1)])).first()
    assert got["dps"] == 1.0


def test_per_share_records_cover_cash_ones(spark):
    rows = quarterly()[:1] + [(CASH, "USD", "2023-01-05", "2023-04-04", 9, "2024-02-01"), (CASH, "USD", "2023-07-01", "2023-09-30", 9, "2024-02-01")]
    got = facts.dividends(frame(spark, rows), shares(spark, [("2023-06-01", 9)]), splits(spark, [])).orderBy("period_end").collect()
    assert [(str(r["period_end"]), r["approximate"]) for r in got] == [("2023-03-31", False), ("2023-09-30", True)]


def test_nearest_ties_take_the_earlier_then_the_smaller(spark):
    asked = spark.createDataFrame([(1, d("2023-01-10")), (1, d("2023-03-01")), (2, d("2023-01-10"))], "cik bigint, on date")
    series = shares(spark, [("2023-01-05", 7), ("2023-01-05", 3), ("2023-01-15", 1)])
    got = matching.nearest(asked, series, ["cik"], "end", "on", "val", 30).orderBy("cik", "on").collect()
    assert got[0]["match"]["value"] == 3.0 and got[1]["match"] is None and got[2]["match"] is None
    exact = matching.nearest(asked, shares(spark, [("2023-01-10", 2)]), ["cik"], "end", "on", "val", 0).filter(F.col("match").isNotNull())
    assert exact.count() == 1


def test_resolution_prefers_the_first_variant(spark):
    asked = spark.createDataFrame([("brk.b",), (" aapl ",), ("none",), ("BRK B",)], "ticker string")
    lookup = spark.createDataFrame([("BRK-B", 7), ("AAPL", 1), ("AAPL", 3), ("NONE", 0)], "ticker string, cik bigint")
    found = matching.resolve_symbols(asked, lookup)
    assert {r["ticker"]: r["cik"] for r in found.collect()} == {"BRK.B": 7, "AAPL": 3, "BRK B": 7}
    assert [r["ticker"] for r in matching.unresolved(asked, found).collect()] == ["none"]


def test_publishable_rows(spark):
    rows = facts.dividends(frame(spark, quarterly()), shares(spark, []), splits(spark, []))
    who = spark.createDataFrame([("A", 1), ("B", 1)], "ticker string, cik bigint")
    out = facts.publishable_dividends(rows, who)
    assert out.count() == 6 and dict(out.dtypes)["flags"] == "string"
    s = facts.splits(frame(spark, [split("2020-08-31", 4, "2020-10-30")]), shares(spark, []))
    assert facts.publishable_splits(s, who).columns[0] == "ticker"
