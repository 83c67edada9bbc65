from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions import scalars


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def test_symbols(spark):
    cases = {"brk.b": "BRK-B", " bf b\t": "BF-B", "a--b": "A-B", "x..y": "X-Y", "": ""}
    for given, wanted in cases.items():
        assert one(spark, scalars.canonical_symbol(F.col("s")), s=given) == wanted
    assert one(spark, scalars.symbol_variants(F.col("s")), s="brk.b") == ["BRK.B", "BRK-B", "BRK B"]
    assert one(spark, scalars.symbol_variants(F.col("s")), s=" ") == []


def test_spans_are_inclusive(spark):
    days = {24: "other", 25: "monthly", 35: "monthly", 36: "other", 70: "quarterly", 100: "quarterly", 150: "semiannual", 200: "semiannual", 330: "annual", 400: "annual", 401: "other"}
    start = F.to_date(F.lit("2020-01-01"))
    for n, wanted in days.items():
        assert one(spark, scalars.classify_span(start, F.date_add(start, n)), x=1) == wanted
    assert one(spark, scalars.classify_span(F.lit(None).cast("date"), start), x=1) == "instant"


def test_dates_are_strict(spark):
    df = spark.createDataFrame([("2026-07-01",), ("2026-7-1",), ("2026-07-01 x",), ("2026-02-30",), (None,)], "s string")
    got = [r["d"] for r in df.select(scalars.iso_date(F.col("s")).alias("d")).collect()]
    assert str(got[0]) == "2026-07-01" and got[1:] == [None] * 4


def test_item_events(spark):
    named = lambda s: one(spark, scalars.item_events(F.col("s"), specs.FLAGGED_ITEMS), s=s)
    assert named("5.02, 3.01,9.01,5.02") == "delisting_notice,officer_departure"
    assert named("9.01") is None and named("") is None


def test_direction_needs_a_decisive_move(spark):
    turn = lambda r, a, b: one(spark, scalars.corrected_ratio(F.lit(r), F.lit(a), F.lit(b)), x=1)
    assert turn(8.0, 800.0, 100.0) == 0.125
    assert turn(8.0, 100.0, 800.0) == 8.0
    assert turn(8.0, 100.0, 100.0) == 8.0
    assert turn(8.0, 0.0, 100.0) == 8.0
    counts = spark.createDataFrame([(8.0, 0.0, 0.0), (8.0, 0.0, 5.0), (8.0, 5.0, 0.0), (8.0, None, 5.0), (8.0, 800.0, 100.0)] * 3, "r double, a double, b double")
    got = counts.select(scalars.corrected_ratio(F.col("r"), F.col("a"), F.col("b")).alias("x")).collect()
    assert [g["x"] for g in got] == [8.0, 8.0, 8.0, 8.0, 0.125] * 3


def test_weeks_and_padding(spark):
    assert one(spark, scalars.iso_week(F.to_date(F.lit("2027-01-01"))), x=1) == "2026-W53"
    assert one(spark, scalars.padded_cik(F.lit(320193)), x=1) == "CIK0000320193"
