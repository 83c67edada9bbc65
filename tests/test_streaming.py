from tidemark.streaming import listings

SCHEMA = "date date, source string, ent string, event string, record string, previous string, order_key string"


def test_the_stream_appends_each_change_once(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")

    def arrive(rows):
        spark.createDataFrame(rows, "ent string, event string, record string").selectExpr("DATE '2026-01-01' AS date", "'s' AS source", "ent", "event", "record", "CAST(NULL AS STRING) AS previous", "ent AS order_key").write.mode("append").parquet(source)

    def run(name):
        events = spark.readStream.schema(SCHEMA).parquet(source)
        listings.append_stream(events, log, str(tmp_path / name), ["ent"], SCHEMA.replace("order_key string", "seq bigint, batch_id bigint")).awaitTermination(120)

    arrive([("a", "added", "1"), ("b", "added", "1")])
    run("c1")
    run("c2")  # a lost checkpoint replays everything
    rows = spark.read.parquet(log)
    assert rows.count() == 2
    arrive([("a", "removed", "1")])
    run("c1")
    assert sorted((r["ent"], r["event"], r["seq"]) for r in spark.read.parquet(log).collect()) == [("a", "added", 0), ("a", "removed", 2), ("b", "added", 1)]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    log, schema = str(tmp_path / "log"), SCHEMA.replace("order_key string", "seq bigint, batch_id bigint")

    def batch(*rows):
        return spark.createDataFrame(rows, "d string, ent string, event string, record string").selectExpr("CAST(d AS DATE) AS date", "'s' AS source", "ent", "event", "record", "CAST(NULL AS STRING) AS previous", "ent AS order_key")

    batches = [
        batch(("2026-01-01", "a", "added", "1"), ("2026-01-01", "b", "added", "1")),
        batch(("2026-01-02", "a", "removed", "1"), ("2026-01-03", "a", "added", "1"), ("2026-01-02", "c", "added", "1"), ("2026-01-03", "c", "added", "1")),  # two days
    ]
    for turn in ((0, batches[0]), (1, batches[1]), (0, batches[0]), (1, batches[1])):
        listings.append_part(turn[1], log, "s", turn[0], ["ent"], schema)
    rows = listings.read_log(spark, log, schema).orderBy("seq").collect()
    assert [(r["seq"], str(r["date"]), r["ent"], r["event"], r["batch_id"]) for r in rows] == [
        (0, "2026-01-01", "a", "added", 0), (1, "2026-01-01", "b", "added", 0), (2, "2026-01-02", "c", "added", 1), (3, "2026-01-02", "a", "removed", 1), (4, "2026-01-03", "a", "added", 1),
    ]


def test_hourly_metrics_and_sessions(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", 1, "view", 1.0), ("2024-01-01 00:50:00", 1, "view", 2.0), ("2024-01-03 05:00:00", 1, "view", 3.0)]
    spark.createDataFrame(rows, "t string, user_id long, event_type string, value double").selectExpr("to_timestamp(t) AS ts", "user_id", "event_type", "value").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, user_id long, event_type string, value double").parquet(str(tmp_path / "e"))
    for name, df in (("hours", listings.hourly_metrics(stream)), ("sessions", listings.chained_sessions(stream))):
        df.writeStream.format("memory").queryName(name).outputMode("complete" if name == "hours" else "append").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r["mentions"] for r in spark.table("hours").collect()) == [1, 2]
    assert [r["n"] for r in spark.table("sessions").collect()] == [2]
