import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.errors import PitBuildError
from tidemark.operators import diff, pit

REC = "struct<k:string,v:string>"


def test_snapshot_diff_has_one_event_of_each_kind(spark):
    old = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), (None, 3, "n")], "k string, n int, t string")
    new = spark.createDataFrame([("a", 1, None), ("b", 5, "x"), ("c", 7, "y")], "k string, n int, t string")
    got = {r["event"]: r for r in diff.snapshot_diff(old, new, ["k"], "s", "2026-01-02").collect()}
    assert set(got) == {"added", "removed", "changed"}
    assert got["removed"]["record"]["n"] == 3 and got["removed"]["previous"] is None
    assert got["changed"]["previous"]["n"] == 2 and got["changed"]["record"]["n"] == 5


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), (None, 1, "w")], "k string, o int, v string")
    assert {(r.k, r.v) for r in diff.last_wins(df, ["k"], ["o"]).collect()} == {("a", "y"), (None, "z")}
    assert {(r.k, r.v) for r in diff.first_wins(df, ["k"], ["o"]).collect()} == {("a", "x"), (None, "w")}


def _log(spark, rows):
    return spark.createDataFrame(rows, f"source string, ent string, event string, record {REC}, previous {REC}, seq long")


def test_append_drops_only_a_replay_of_the_latest(spark):
    a = ("a", "1")
    log = _log(spark, [("s", "a", "added", a, None, 0), ("s", "a", "removed", a, None, 1), ("s", "b", "added", ("b", "1"), None, 2)])
    batch = spark.createDataFrame(
        [("s", "a", "added", a, None, "a"), ("s", "b", "added", ("b", "1"), None, "b"), ("s", "c", "added", ("c", "1"), None, "c")],
        f"source string, ent string, event string, record {REC}, previous {REC}, order_key string",
    )
    got = {r["ent"]: r["seq"] for r in diff.append_batch(log, batch, ["ent"]).collect()}
    assert got == {"a": 3, "c": 4}  # relisting counts, a replay does not


def _random_history(seed):
    rnd = random.Random(seed)
    days = [dt.date(2026, 1, 1) + dt.timedelta(d) for d in range(12)]
    state, events, by_day = {}, [], {}
    for k in "abc":
        if rnd.random() < 0.6:
            state[k] = "0"
    by_day[days[0] - dt.timedelta(1)] = dict(state)
    seq = 0
    for d in days:
        for _ in range(rnd.randrange(4)):
            k, v = rnd.choice("abcde"), str(rnd.randrange(3))
            if k not in state:
                events.append((k, d, seq, "added", v, None))
                state[k] = v
            elif rnd.random() < 0.4:
                events.append((k, d, seq, "removed", state[k], None))
                del state[k]
            elif state[k] != v:
                events.append((k, d, seq, "changed", v, state[k]))
                state[k] = v
            seq += 1
        by_day[d] = dict(state)
    return state, events, by_day


@pytest.mark.parametrize("seed", range(4))
def test_intervals_sliced_are_the_replay_and_the_truth(spark, seed):
    state, events, by_day = _random_history(seed)
    now = spark.createDataFrame(list(state.items()), "k string, record string")
    log = spark.createDataFrame(events, "k string, date date, seq long, event string, record string, previous string").withColumn("pre", pit.pre_image()).drop("record")
    boundary = min(by_day)
    table = pit.build_intervals(now, log, ["k"], str(boundary)).cache()
    rows = table.collect()
    for d, wanted in by_day.items():
        sliced = {r["k"]: r["record"] for r in rows if r["valid_from"] <= d and (r["valid_to"] is None or d < r["valid_to"])}
        assert sliced == wanted
    assert all(r["provable_from"] == (r["valid_from"] != boundary) for r in rows)
    for d in (boundary, boundary + dt.timedelta(5)):
        assert {r["k"]: r["record"] for r in pit.members_asof(now, log, ["k"], str(d)).collect()} == by_day[d]
        assert {r["k"]: r["record"] for r in pit.as_of(table, str(d)).collect()} == by_day[d]
    table.unpersist()


def test_the_next_pre_image_decides_on_an_inconsistent_log(spark):
    log = spark.createDataFrame([("a", dt.date(2026, 1, 2), 0, "added", "x", None), ("a", dt.date(2026, 1, 4), 1, "changed", "z", "y")], "k string, date date, seq long, event string, record string, previous string")
    now = spark.createDataFrame([("a", "z")], "k string, record string")
    got = pit.build_intervals(now, log.withColumn("pre", pit.pre_image()).drop("record"), ["k"], "2026-01-01").orderBy("valid_from").collect()
    assert [(r["record"], str(r["valid_from"]), str(r["valid_to"])) for r in got] == [("y", "2026-01-02", "2026-01-04"), ("z", "2026-01-04", "None")]


def test_same_day_events_that_cancel_leave_no_row(spark):
    d = dt.date(2026, 1, 3)
    log = spark.createDataFrame([("a", d, 0, "changed", "y", "x"), ("a", d, 1, "changed", "x", "y"), ("b", d, 2, "added", "q", None), ("b", d, 3, "removed", "q", None)], "k string, date date, seq long, event string, record string, previous string")
    now = spark.createDataFrame([("a", "x")], "k string, record string")
    got = pit.build_intervals(now, log.withColumn("pre", pit.pre_image()).drop("record"), ["k"], "2026-01-01").collect()
    assert [(r["k"], r["record"], r["valid_to"], r["provable_from"]) for r in got] == [("a", "x", None, False)]


def test_empty_log_gives_one_open_row_per_member(spark):
    now = spark.createDataFrame([("a", "x")], "k string, record string")
    none = spark.createDataFrame([], "k string, date date, seq long, pre string")
    assert [(r["valid_from"], r["valid_to"]) for r in pit.build_intervals(now, none, ["k"], "2026-01-01").collect()] == [(dt.date(2026, 1, 1), None)]
    assert pit.build_intervals(now.limit(0), none, ["k"], "2026-01-01").count() == 0


def test_refusals(spark):
    with pytest.raises(PitBuildError):
        pit.as_of(spark.range(1), "2025-12-31", "2026-01-01")
    with pytest.raises(PitBuildError):
        pit.require_free_columns(["ticker", "valid_to"])
    schema = "date date, event string, previous string"
    for bad in [(None, "added", None), (dt.date(2026, 1, 2), "lost", None), (dt.date(2026, 1, 2), "changed", None)]:
        with pytest.raises(PitBuildError):
            pit.require_valid(spark.createDataFrame([bad], schema))
    with pytest.raises(PitBuildError):
        pit.require_valid(spark.createDataFrame([(dt.date(2026, 1, 1), "added", None)], schema), "2026-01-01")
    assert pit.violations(spark.createDataFrame([(dt.date(2026, 1, 1), "added", None)], schema)).first()["bad_kind"] == 0


def test_floors_and_fact_join(spark):
    events = spark.createDataFrame([("s", dt.date(2026, 1, 5))], "source string, date date")
    seen = spark.createDataFrame([("s", dt.date(2026, 1, 1)), ("t", dt.date(2026, 2, 1))], "source string, first_observed date")
    assert {r["source"]: str(r["floor"]) for r in pit.source_floors(events, seen).collect()} == {"s": "2026-01-04", "t": "2026-02-01"}
    iv = spark.createDataFrame([("a", "x", dt.date(2026, 1, 1), dt.date(2026, 1, 3)), ("a", "y", dt.date(2026, 1, 3), None)], "k string, record string, valid_from date, valid_to date")
    facts = spark.createDataFrame([("a", dt.date(2026, 1, 2)), ("a", dt.date(2026, 1, 3)), ("b", dt.date(2026, 1, 3))], "k string, d date")
    assert [r["record"] for r in pit.join_as_of(facts, iv, ["k"], "d").orderBy("d").collect()] == ["x", "y"]


def test_without_repeats(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("u", 2, "a"), ("u", 3, None), ("u", 4, None), ("u", 5, "a")], "u string, i int, t string")
    assert [r["i"] for r in diff.without_repeats(df, ["u"], ["i"], ["t"]).orderBy("i").collect()] == [1, 3, 5]
    assert df.filter(F.col("t").isNull()).count() == 2


def test_a_log_that_mixes_stamped_and_unstamped_events_is_refused(spark):
    def log(*seqs):
        return spark.createDataFrame([(dt.date(2026, 1, 2), "added", None, s) for s in seqs], "date date, event string, previous string, seq long")

    for seqs in ((0, 1), (None, None)):
        pit.require_valid(log(*seqs), "2026-01-01")
    with pytest.raises(PitBuildError, match="position"):
        pit.require_valid(log(0, None), "2026-01-01")


def test_many_days_at_once_are_the_days_one_by_one(spark):
    current, rows, _ = _random_history(4)
    now = spark.createDataFrame([(k, v) for k, v in current.items()] or [("z", "0")], "k string, record string").filter("k <> 'z'")
    events = spark.createDataFrame([(k, d, s, {"added": None, "removed": v, "changed": p}[e]) for k, d, s, e, v, p in rows], "k string, date date, seq long, pre string")
    days = ["2025-12-31", "2026-01-04", "2026-01-09", "2026-02-01"]
    together = sorted((str(r["day"]), r["k"], r["record"]) for r in pit.members_on(now, events, ["k"], days).collect())
    assert together == sorted((d, r["k"], r["record"]) for d in days for r in pit.members_asof(now, events, ["k"], d).collect())
    intervals = pit.build_intervals(now, events, ["k"], "2025-12-31")
    assert sorted((str(r["day"]), r["k"], r["record"]) for r in pit.as_of_days(intervals, days).collect()) == together


def test_an_event_of_a_retired_source_is_about_its_whole_record(spark):
    rows = spark.createDataFrame([("s", ("a", "1")), ("s", ("a", "2")), ("old", ("a", "1")), ("old", ("a", "2")), ("old", ("a", "2"))], f"source string, record {REC}")
    keys = [r["k"] for r in rows.select(diff.entity_key(F.col("source"), F.col("record"), {"s": ["k"]}).alias("k")).collect()]
    assert keys[0] == keys[1] and keys[2] != keys[3] == keys[4] and len(set(keys)) == 3
