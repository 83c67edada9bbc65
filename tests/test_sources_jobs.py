import datetime as dt
import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas, specs
from tidemark.errors import FetchError, PitBuildError, PolicyError, RefusalError
from tidemark.operators import flags, matching, quality
from tidemark.plans import cli, jobs
from tidemark.sources import landing, publish, scans

NASDAQ = "Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares\n{rows}\n\nFile Creation Time: 0808202421:30|||||||\n"
OTHER = "ACT Symbol|Security Name|Exchange|CQS Symbol|ETF|Round Lot Size|Test Issue|NASDAQ Symbol\n{rows}\nFile Creation Time: 08|||||||\n"


def land(folder: Path, nasdaq="AAA|Alpha - Ä|Q|N|N|100|N|N", sec='{"0":{"cik_str":5,"ticker":"AAA","title":"Alpha"}}', exchange=None):
    folder.mkdir(parents=True, exist_ok=True)
    exchange = exchange or {"fields": ["cik", "name", "ticker", "exchange"], "data": [[5, "Alpha", "AAA", "Nasdaq"], [9, "Nul", "NUL", None]]}
    (folder / "nasdaqlisted.raw").write_text(NASDAQ.format(rows=nasdaq))
    (folder / "otherlisted.raw").write_text(OTHER.format(rows="OOO|Other|N||N|100|N|OOO\nTST|Test|N||N|100|Y|TST"))
    (folder / "sec_company_tickers.raw").write_text(sec)
    (folder / "sec_company_tickers_exchange.raw").write_text(json.dumps(exchange))


def test_directories(spark, tmp_path):
    land(tmp_path, nasdaq="BBB|Beta|Q|N|N|100|N|N\nTTT|Test|Q|Y|N|100|N|N\nAAA|Alpha")
    got = scans.nasdaq_listed(spark, (tmp_path / "nasdaqlisted.raw").as_uri()).collect()
    assert [tuple(r) for r in got] == [("AAA", "Alpha", "", "", ""), ("BBB", "Beta", "Q", "N", "N")]
    assert [r["ticker"] for r in scans.other_listed(spark, (tmp_path / "otherlisted.raw").as_uri()).collect()] == ["OOO"]
    assert [tuple(r) for r in scans.sec_tickers(spark, (tmp_path / "sec_company_tickers.raw").as_uri()).collect()] == [(5, "AAA", "Alpha")]
    assert [tuple(r) for r in scans.sec_exchange(spark, (tmp_path / "sec_company_tickers_exchange.raw").as_uri()).collect()] == [(5, "AAA", "Alpha", "Nasdaq"), (9, "NUL", "Nul", None)]
    land(tmp_path, exchange={"fields": ["cik", "name", "ticker", "exchange"], "data": [[5, "Alpha"]]})
    with pytest.raises(Exception, match="another width"):
        scans.sec_exchange(spark, (tmp_path / "sec_company_tickers_exchange.raw").as_uri()).collect()


def test_submissions_are_ragged(spark):
    payload = {"cik": "0000000012", "filings": {"recent": {"form": ["8-K", "8-K/A", "25", "25/A", "10-Q", None], "filingDate": ["2026-01-01", "2026-01-02", "2026-01-03"], "accessionNumber": ["a", "b", "c", "d", "e"], "items": ["5.02,3.01", "4.02", "", "", "5.02"]}}}
    df = spark.read.schema(schemas.SUBMISSIONS).json(spark.sparkContext.parallelize([json.dumps(payload)]))
    got = flags.flagged_filings(scans.submissions(df)).orderBy("accession").collect()
    assert [(r["cik"], r["accession"], r["event"], r["filing_date"]) for r in got] == [(12, "a", "delisting_notice,officer_departure", "2026-01-01"), (12, "b", "non_reliance_on_financials", "2026-01-02"), (12, "c", "delisting_form", "2026-01-03")]


def test_new_events_by_company_and_accession(spark):
    log = spark.createDataFrame([(1, "a"), (1, None)], "cik bigint, accession string")
    new = spark.createDataFrame([(1, "a", 0), (1, None, 1), (2, "a", 2), (2, "a", 3), (1, "b", 4)], "cik bigint, accession string, o int")
    assert sorted(r["o"] for r in flags.add_new(log, new, ["o"]).collect()) == [2, 4]


def test_company_facts(spark):
    item = {"end": "2023-03-31", "val": 0.5, "filed": "2023-05-01"}
    doc = {"cik": 3, "facts": {"us-gaap": {specs.DPS_TAGS[0]: {"units": {"USD/shares": [item, {**item, "start": "2023-01-01"}]}}}, "dei": {specs.SHARES_TAG: {"units": {"shares": [{"end": "2023-04-20", "val": 100}, {"end": "2023-04-20", "val": 0}]}}}}}
    df = spark.read.schema(schemas.COMPANY_FACTS).json(spark.sparkContext.parallelize([json.dumps(doc)]))
    flat = scans.company_facts(df)
    assert scans.tag_facts(flat, specs.DPS_TAGS[0], ("USD/shares",)).count() == 2
    assert [r["val"] for r in scans.share_counts(flat).collect()] == [100.0]


def test_listed_and_universe(spark):
    rows = spark.createDataFrame([("aa", "NYSE", 3, 0), ("AA", "Nasdaq", 4, 1), ("bb", None, 5, 2), ("", "NYSE", 6, 3), ("cc", "CBOE", 3, 4)], "ticker string, exchange string, cik bigint, ord int")
    assert sorted(r["ticker"] for r in scans.listed(rows).collect()) == ["aa", "cc"]
    assert [r["cik"] for r in scans.universe(rows, 2).collect()] == [3, 4]
    assert scans.universe(rows, 0).count() == 4


def test_policy(spark):
    raw = spark.createDataFrame([("A", 1, "secret")], "ticker string, mentions bigint, text string")
    assert quality.allowed_only(raw, "ticker_trends").columns == ["ticker", "mentions"]
    with pytest.raises(PolicyError):
        quality.allowed_only(raw, "ticker_trends", {"ticker_trends": ("ticker", "text")})
    with pytest.raises(PolicyError):
        quality.allowed_only(raw, "elsewhere")
    with pytest.raises(Exception, match="no ticker"):
        quality.allowed_only(raw.withColumn("ticker", F.lit("")), "ticker_trends").collect()


def test_failure_gate(spark):
    def fetches(failed, missing):
        states = ["failed"] * failed + ["not_found"] * missing
        return spark.createDataFrame([(s,) for s in states + ["ok"] * (100 - len(states))], "status string")

    quality.require_few_failures(fetches(1, 10))
    with pytest.raises(RefusalError):
        quality.require_few_failures(fetches(10, 0))


def test_manifest_round_trip(tmp_path):
    publish.publish(tmp_path, {"a.jsonl": b"1\n", "b.jsonl": b"2\n"}, ["z", "y"], "note", {"a.jsonl": 1, "b.jsonl": 1})
    (tmp_path / ".hidden").write_text("x")
    made = publish.publish(tmp_path, {"b.jsonl": b"22\n"}, ["z"], "note", {"b.jsonl": 2})
    assert {f["name"]: f["rows"] for f in made["files"]} == {"a.jsonl": 1, "b.jsonl": 2}
    assert publish.read_manifest(tmp_path)["source_urls"] == ["z"]
    (tmp_path / "a.jsonl").write_text("9\n")
    with pytest.raises(RefusalError):
        publish.verified_path(tmp_path, "a.jsonl")
    (tmp_path / "manifest.json").write_text(json.dumps({"schema_version": "99.0"}))
    with pytest.raises(RefusalError):
        publish.read_manifest(tmp_path)


def test_a_failed_publication_changes_nothing(tmp_path, monkeypatch):
    publish.publish(tmp_path, {"a": b"1"}, [], "n")
    before = (tmp_path / "manifest.json").read_bytes()
    monkeypatch.setattr(publish, "sha256_of", lambda p: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        publish.publish(tmp_path, {"a": b"2"}, [], "n")
    assert (tmp_path / "a").read_bytes() == b"1" and (tmp_path / "manifest.json").read_bytes() == before


def test_landing_waits_and_tries_again():
    answers, now, slept = [(503, b""), OSError("reset"), (200, b"ok"), (404, b""), (403, b"")], [0.0], []

    def opener(url, agent, timeout):
        a = answers.pop(0)
        if isinstance(a, OSError):
            raise a
        return a

    def sleep(s):
        slept.append(s)
        now[0] += s

    s = landing.PoliteSession("me", opener=opener, clock=lambda: now[0], sleep=sleep)
    assert s.get("https://www.sec.gov/x") == b"ok" and slept == [1.0, 2.0]
    with pytest.raises(FetchError) as missing:
        s.get("https://www.sec.gov/y")
    assert missing.value.not_found
    with pytest.raises(FetchError):
        s.get("https://example.org/z")
    assert landing.spacing("data.sec.gov") == 0.125 and landing.spacing("notsec.gov") == 0.25


def test_snapshot_then_intervals(spark, tmp_path):
    data, landed = tmp_path / "data", tmp_path / "landed"
    land(landed)
    assert jobs.snapshot_symbols(spark, data, landed, "2026-07-19")[0] == dict.fromkeys(specs.SOURCES, 0)
    with pytest.raises(PitBuildError):
        jobs.build_pit(spark, data)
    land(landed, nasdaq="AAA|Alpha New|Q|N|N|100|N|N\nBBB|Beta|Q|N|N|100|N|N")
    counts, failed = jobs.snapshot_symbols(spark, data, landed, "2026-07-22")
    assert counts["nasdaqlisted"] == 2 and not failed
    again, _ = jobs.snapshot_symbols(spark, data, landed, "2026-07-23")
    assert again["nasdaqlisted"] == 0
    lines = [json.loads(x) for x in (data / "symbols/events/events.jsonl").read_text().splitlines()]
    assert [(e["event"], e["record"]["ticker"]) for e in lines] == [("added", "BBB"), ("changed", "AAA")]
    assert jobs.build_pit(spark, data)["nasdaqlisted.jsonl"] == 3
    first = (data / "symbols/pit/nasdaqlisted.jsonl").read_bytes()
    rows = [json.loads(x) for x in first.decode().splitlines()]
    assert [(r["ticker"], r["name"], r["valid_from"], r["valid_to"], r["provable_from"]) for r in rows] == [
        ("AAA", "Alpha - Ä", "2026-07-21", "2026-07-22", False), ("AAA", "Alpha New", "2026-07-22", None, True), ("BBB", "Beta", "2026-07-22", None, True),
    ]
    jobs.build_pit(spark, data)
    assert (data / "symbols/pit/nasdaqlisted.jsonl").read_bytes() == first
    (landed / "otherlisted.raw").unlink()
    assert "otherlisted" in jobs.snapshot_symbols(spark, data, landed, "2026-07-24")[1][0]
    (data / "symbols/current/nasdaqlisted.jsonl").write_text("{}\n")
    with pytest.raises(RefusalError):
        jobs.build_pit(spark, data)


def test_event_sweep_resumes_in_its_week(spark, tmp_path):
    def payload(cik, acc):
        return json.dumps({"cik": str(cik), "filings": {"recent": {"form": ["25"], "filingDate": ["2026-01-0%d" % cik], "accessionNumber": [acc], "items": [""]}}})

    read = lambda *lines: spark.read.schema(schemas.SUBMISSIONS).json(spark.sparkContext.parallelize(lines))
    assert jobs.collect_events(spark, tmp_path, read(payload(1, "a"), payload(2, "b")), [2], "2026-01-07") == 2
    assert jobs.collect_events(spark, tmp_path, read(payload(1, "new"), payload(2, "c")), [], "2026-01-08") == 3  # 1 is done this week
    assert jobs.collect_events(spark, tmp_path, read(payload(1, "new")), [], "2026-01-14") == 4
    rows = [json.loads(x) for x in gzip.decompress((tmp_path / "events/events.jsonl.gz").read_bytes()).decode().splitlines()]
    assert [r["accession"] for r in rows] == ["a", "new", "b", "c"]


def test_corporate_actions_publish_then_refuse(spark, tmp_path):
    item = {"start": "2023-01-01", "end": "2023-03-31", "val": 0.5, "filed": "2023-05-01"}
    doc = json.dumps({"cik": 3, "facts": {"us-gaap": {specs.DPS_TAGS[0]: {"units": {"USD/shares": [item]}}}}})
    docs = spark.read.schema(schemas.COMPANY_FACTS).json(spark.sparkContext.parallelize([doc]))
    asked = spark.createDataFrame([("aaa",), ("zzz",)], "ticker string")
    lookup = spark.createDataFrame([("AAA", 3)], "ticker string, cik bigint")
    ok = asked.selectExpr("ticker", "'ok' status")
    assert jobs.corporate_actions(spark, tmp_path, asked, lookup, docs, ok) == {"splits": 0, "dividends": 1}
    assert publish.read_manifest(tmp_path / "corporate_actions")["tickers_unresolved"] == ["zzz"]
    with pytest.raises(RefusalError):
        jobs.corporate_actions(spark, tmp_path, asked, lookup, docs, asked.selectExpr("ticker", "'failed' status"))
    assert publish.read_manifest(tmp_path / "corporate_actions")["tickers_failed"] == ["aaa", "zzz"]


def test_dividends_are_a_listed_table(spark, tmp_path):
    item = {"start": "2023-01-01", "end": "2023-03-31", "val": 0.5, "filed": "2023-05-01"}
    doc = json.dumps({"cik": 3, "facts": {"us-gaap": {specs.DPS_TAGS[0]: {"units": {"USD/shares": [item]}}}}})
    docs = spark.read.schema(schemas.COMPANY_FACTS).json(spark.sparkContext.parallelize([doc]))
    asked, lookup = spark.createDataFrame([("aaa",)], "ticker string"), spark.createDataFrame([("AAA", 3)], "ticker string, cik bigint")
    folder = tmp_path / "corporate_actions"
    for _ in range(2):
        jobs.corporate_actions(spark, tmp_path, asked, lookup, docs, asked.selectExpr("ticker", "'ok' status"))
        listed = [f for f in publish.read_manifest(folder)["files"] if f["name"].startswith("dividends.parquet/")]
        assert sum(f["rows"] for f in listed) == 1 and publish.read_table(spark, folder, "dividends.parquet").count() == 1
    assert sorted(p.name for p in folder.iterdir()) == ["dividends.parquet", "manifest.json", "splits.jsonl"]
    next((folder / "dividends.parquet").glob("part-*")).write_bytes(b"x")
    with pytest.raises(RefusalError):
        publish.read_table(spark, folder, "dividends.parquet")


def test_outcomes_come_from_downloads(spark, tmp_path):
    class Web:
        def get(self, url):
            n = int(url.rsplit("CIK", 1)[1].split(".")[0])
            if n == 2:
                raise FetchError("gone", not_found=True)
            if n in (3, 4):
                raise OSError("reset" if n == 3 else "server said 404")
            return json.dumps({"cik": n, "facts": {}}).encode()

    got = jobs.land_documents(Web(), [1, 2, 3, 4], cli.FACTS_URL, tmp_path / "f", lambda _: None)
    assert got == {"ok": [1], "not_found": [2, 4], "failed": [3]} and json.loads((tmp_path / "f/outcome.json").read_text()) == got
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "ticker string")
    lookup = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "ticker string, cik bigint")
    docs = spark.read.schema(schemas.COMPANY_FACTS).option("multiLine", True).json(cli._documents(tmp_path / "f"))
    failed = spark.createDataFrame([(c,) for c in cli._failed(tmp_path / "f")], "cik bigint")
    outcomes = jobs.fetch_outcomes(matching.resolve_symbols(asked, lookup), docs, failed)
    assert {r["ticker"]: r["status"] for r in outcomes.collect()} == {"A": "ok", "B": "not_found", "C": "failed"}
    with pytest.raises(RefusalError):
        jobs.corporate_actions(spark, tmp_path, asked, lookup, docs, outcomes)


def test_the_first_known_spelling_answers_even_with_nothing(spark):
    lookup = spark.createDataFrame([("B-C", 5, 0), ("B C", 0, 1), ("D", 4, 0), ("D", 2, 1)], "ticker string, cik bigint, o int")
    asked = spark.createDataFrame([("b c",), ("b.c",), ("d",)], "ticker string")
    assert {r["ticker"]: r["cik"] for r in matching.resolve_symbols(asked, lookup, order="o").collect()} == {"B.C": 5, "D": 2}


def test_a_sweep_publishes_in_steps_and_resumes(spark, tmp_path, monkeypatch):
    lines = [json.dumps({"cik": str(c), "filings": {"recent": {"form": ["25"], "filingDate": ["2026-01-01"], "accessionNumber": [f"a{c}"], "items": [""]}}}) for c in range(1, 6)]
    payloads = spark.read.schema(schemas.SUBMISSIONS).json(spark.sparkContext.parallelize(lines))
    assert jobs.collect_events(spark, tmp_path, payloads, [], "2026-01-07", limit=1) == 1
    published, stop = publish.publish, []

    def breaks_off(*args, **kwargs):
        if len(stop) == 1:
            raise OSError("killed")
        stop.append(1)
        return published(*args, **kwargs)

    monkeypatch.setattr(publish, "publish", breaks_off)
    with pytest.raises(OSError):
        jobs.collect_events(spark, tmp_path, payloads, [], "2026-01-07", every=2)
    monkeypatch.undo()
    assert json.loads((tmp_path / "events/.progress.json").read_text())["done"] == [1, 2, 3]
    assert publish.read_verified(spark, tmp_path / "events", "events.jsonl.gz", schemas.FLAGGED_EVENTS).count() == 3
    assert jobs.collect_events(spark, tmp_path, payloads, [], "2026-01-07", every=2) == 5


def test_first_observed_must_be_dates(tmp_path):
    for good, value in ((True, {"s": "2026-01-01"}), (True, None), (False, {"s": "2026-1-1"}), (False, {"s": 5}), (False, {"s": "soon"})):
        publish.publish(tmp_path, {"a": b"1"}, [], "n", extra={"first_observed": value})
        if good:
            assert jobs.first_observed(tmp_path) == (value or {})
        else:
            with pytest.raises(PitBuildError):
                jobs.first_observed(tmp_path)


def test_commands_from_landing_to_events(spark, tmp_path, monkeypatch):
    """Directories, intervals, facts and filings through the command line, with a double for the network."""
    class Web:
        def get(self, url):
            if "submissions" in url or "companyfacts" in url:
                n = int(url.rsplit("CIK", 1)[1].split(".")[0])
                recent = {"form": ["25"], "filingDate": ["2026-01-01"], "accessionNumber": [f"a{n}"], "items": [""]}
                return json.dumps({"cik": str(n), "filings": {"recent": recent}} if "submissions" in url else {"cik": n, "facts": {}}, indent=1).encode()
            return (raw / f"{next(n for n, s in specs.SOURCES.items() if s.url == url)}.raw").read_bytes()

    raw, data, landed = tmp_path / "raw", str(tmp_path / "data"), str(tmp_path / "landed")
    land(raw)
    monkeypatch.setattr(cli, "session", lambda: spark)
    run = lambda *args: cli.main([*args, "--data-dir", data], Web())
    assert run("land-directories", "--landed", landed, "--agent", "me") == 0
    assert run("snapshot-symbols", "--landed", landed) == 0
    assert run("build-pit") == 1  # nothing has changed yet
    assert run("land-submissions", "--landed", f"{landed}/filers", "--agent", "me", "--limit", "1") == 0
    assert run("collect-events", "--landed", f"{landed}/filers") == 0
    assert publish.read_manifest(Path(data) / "events")["files"][0]["rows"] == 1
    assert run("land-facts", "5", "--landed", f"{landed}/facts", "--agent", "me") == 0
    assert run("corporate-actions", "--landed", f"{landed}/facts", "--all-listed") == 0
    assert run("staleness", f"{data}/symbols/current", "--max-age-days", "1") == 0 and run("staleness", f"{data}/gone", "--max-age-days", "1") == 1


def test_mirror_keeps_policy(spark, tmp_path):
    folder = tmp_path / "archive" / "ticker_trends"
    folder.mkdir(parents=True)
    with gzip.open(folder / "2026-08-01.jsonl.gz", "wt") as f:
        f.write(json.dumps({"ticker": "A", "mentions": 2, "top_posts": [{"author": "x"}], "platforms": {"p": 2}}) + "\n\n")
    assert jobs.mirror_metrics(spark, tmp_path / "data", tmp_path / "archive") == {"ticker_trends": 1}
    text = (tmp_path / "data/sentiment/ticker_trends/2026-08-01.jsonl").read_text()
    assert "top_posts" not in text and json.loads(text)["platforms"] == {"p": 2}
    assert publish.read_manifest(tmp_path / "data/sentiment/ticker_trends")["first_day"] == "2026-08-01"


def test_staleness(tmp_path):
    now = dt.datetime(2026, 8, 10, tzinfo=dt.timezone.utc)
    marks = {s: "2026-08-05" for s in specs.SOURCES}
    publish.publish(tmp_path / "d", {"a": b"1"}, [], "n", extra={"last_success": marks}, generated_at="2026-08-07T00:00:00+00:00")
    assert jobs.stale(tmp_path, {"d": 3}, now) == []
    assert jobs.stale(tmp_path, {"d": 2.9}, now) and len(jobs.stale(tmp_path, {"gone": 3}, now)) == 1
    publish.publish(tmp_path / "d", {}, [], "n", extra={"last_success": {**dict(list(marks.items())[1:]), "otherlisted": "x"}}, generated_at="2026-08-12T00:00:00+00:00")
    assert len(jobs.stale(tmp_path, {"d": 3}, now)) == 2
    publish.publish(tmp_path / "d", {}, [], "n", generated_at="2026-08-12T00:00:00")
    assert len(jobs.stale(tmp_path, {"d": 3}, now)) == 1
    assert cli.main(["staleness", "--data-dir", str(tmp_path)]) == 1
