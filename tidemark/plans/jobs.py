"""The jobs: archive directories, build intervals, reconstruct dividends, flag filings, mirror metrics, check staleness.

Each reads landed raw files, plans on DataFrames and publishes a manifested dataset. The driver keeps orchestration, manifests and
refusals; rows stay with the executors, which write them.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas, specs
from tidemark.errors import PitBuildError, RefusalError
from tidemark.functions.scalars import iso_date
from tidemark.operators import diff, facts, flags, matching, pit, quality
from tidemark.sources import publish, scans

PUBLIC_NOTE = "Public-domain source data."
_LOG = "events.jsonl"


def record_ddl(source: str) -> str:
    return f"STRUCT<{', '.join(c.strip().replace(' ', ':', 1) for c in specs.SOURCES[source].schema.split(','))}>"


def _log_table(spark: SparkSession, folder: Path, source: str) -> DataFrame:
    """The logged events of a source with ``seq``, which ascends with the place in the file."""
    schema = f"date STRING, source STRING, event STRING, record {record_ddl(source)}, previous {record_ddl(source)}"
    path = folder / "events" / _LOG
    if not path.exists():
        return spark.createDataFrame([], f"{schema}, seq BIGINT")
    rows = spark.read.text(path.as_uri()).withColumn("seq", F.monotonically_increasing_id()).filter(F.trim("value") != "")
    return rows.select("seq", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("e")).select("e.*", "seq").filter(F.col("source") == source)


def snapshot_symbols(spark: SparkSession, data: Path, landed: Path, today: str) -> tuple[dict[str, int], list[str]]:
    """Archive every landed directory; (events found per source, failed sources). One bad source does not stop the others.

    The log is appended before snapshots advance, so a crash between the two replays events that the next run drops.
    """
    current, events_dir = data / "symbols" / "current", data / "symbols" / "events"
    prior = publish.read_manifest(current) if (current / publish.MANIFEST).exists() else {}
    success, observed = dict(prior.get("last_success", {})), dict(prior.get("first_observed", {}))
    counts: dict[str, int] = {}
    failed: list[str] = []
    staged: dict[str, Path] = {}
    rows: dict[str, int] = {}
    news: list[DataFrame] = []
    log_path, work = events_dir / _LOG, data / "symbols" / ".work"
    for name, spec in specs.SOURCES.items():
        try:
            raw = landed / f"{name}.raw"
            if not raw.exists():
                raise RefusalError(f"{name} has not landed")
            new = getattr(scans, spec.parser)(spark, raw.as_uri())
            file = f"{name}.jsonl"
            n = publish.json_file(new, list(spec.key), work / file)  # read inside the try: plans are lazy
            if not n:
                raise RefusalError(f"{name} is empty")
            if (current / file).exists():
                old = publish.read_verified(spark, current, file, spec.schema)
                order = [*spec.key, *[c for c in new.columns if c not in spec.key]]
                found = diff.snapshot_diff(diff.last_wins(old, list(spec.key), order), diff.last_wins(new, list(spec.key), order), list(spec.key), name, today)
                entity = [f"key_{k}" for k in spec.key]
                keyed = lambda df, spec=spec: df.withColumns({f"key_{k}": F.col(f"record.{k}") for k in spec.key})
                counts[name] = found.count()
                logged = keyed(_log_table(spark, data / "symbols", name)).select("source", *entity, "event", _sorted_record("record", name), _sorted_record("previous", name), "seq")
                fresh = diff.append_batch(logged, keyed(found), entity)
                text = F.to_json(F.struct("date", "event", "previous", "record", "source"), {"ignoreNullFields": "true"})
                news.append(fresh.select(F.lit(len(news)).alias("o"), "seq", text.alias("value")))
            else:
                counts[name], observed[name] = 0, today
            staged[file], rows[file], success[name] = work / file, n, today
        except Exception as e:  # noqa: BLE001 - isolation is the contract: the prior snapshot stays
            failed.append(f"{name}: {e}")
    lines = functools.reduce(DataFrame.unionByName, news) if news else spark.createDataFrame([], "o int, seq bigint, value string")
    publish.text_file(lines.orderBy("o", "seq").select("value"), log_path, head=log_path)
    n_events = spark.read.text(log_path.as_uri()).filter(F.trim("value") != "").count()
    urls = [s.url for s in specs.SOURCES.values()]
    publish.write_manifest(events_dir, source_urls=urls, license_note=PUBLIC_NOTE, rows={_LOG: n_events})
    if staged:
        publish.publish(current, staged, urls, PUBLIC_NOTE, rows, {"last_success": success, "first_observed": observed})
    shutil.rmtree(work, ignore_errors=True)
    publish.heartbeat(data / "symbols", f"{today} {json.dumps(counts, sort_keys=True)}")
    return counts, failed


def _sorted_record(name: str, source: str):
    fields = sorted(c.strip().split(" ")[0] for c in specs.SOURCES[source].schema.split(","))
    return F.when(F.col(name).isNotNull(), F.struct(*[F.col(f"{name}.{f}").alias(f) for f in fields])).alias(name)


def build_pit(spark: SparkSession, data: Path) -> dict[str, int]:
    """Interval tables of all sources from a verified log and verified snapshots; nothing is published unless all can be."""
    current, events_dir = data / "symbols" / "current", data / "symbols" / "events"
    _, log_digest = publish.verified_path(events_dir, _LOG)
    observed = first_observed(current)
    staged, rows, floors, digests = {}, {}, {}, {_LOG: log_digest}
    day = iso_date(F.get_json_object("value", "$.date"))
    seen = spark.read.text((events_dir / _LOG).as_uri()).filter(F.trim("value") != "").agg(F.count("*").alias("n"), F.count(day).alias("dated"), F.min(day).alias("first")).first()
    if not seen["n"]:
        raise PitBuildError("the log is empty: there is nothing to prove intervals from")
    if seen["dated"] < seen["n"]:
        raise PitBuildError("the log has events without a readable date")
    start, work = (seen["first"] - dt.timedelta(days=1)).isoformat(), data / "symbols" / ".work"
    for name, spec in specs.SOURCES.items():
        pit.require_free_columns([c.strip().split(" ")[0] for c in spec.schema.split(",")])
        now = publish.read_verified(spark, current, f"{name}.jsonl", spec.schema)
        _, digests[f"{name}.jsonl"] = publish.verified_path(current, f"{name}.jsonl")
        log = _log_table(spark, data / "symbols", name).withColumn("date", F.to_date("date"))
        floors[name] = max(start, observed.get(name, start))
        pit.require_valid(log, floors[name])
        keys = list(spec.key)
        fields = [c.strip().split(" ")[0] for c in spec.schema.split(",")]
        order = [*keys, *[f for f in fields if f not in keys]]
        record = F.struct(*fields).alias("record")
        members = diff.last_wins(now, keys, order).select(*keys, record)
        events = log.withColumns({k: F.col(f"record.{k}") for k in keys}).withColumn("pre", pit.pre_image())
        table = pit.build_intervals(members, events, keys, floors[name]).select("record.*", *schemas.INTERVAL_FIELDS)
        text_keys = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
        staged[f"{name}.jsonl"] = work / f"{name}.jsonl"
        rows[f"{name}.jsonl"] = publish.json_file(table, [*text_keys, "valid_from", F.col("valid_to").asc_nulls_last()], work / f"{name}.jsonl")
    extra = {"boundary": max(floors.values()), "boundaries": floors, "inputs": digests}
    publish.publish(data / "symbols" / "pit", staged, [s.url for s in specs.SOURCES.values()], PUBLIC_NOTE, rows, extra)
    shutil.rmtree(work, ignore_errors=True)
    return rows


def first_observed(current: Path) -> dict[str, str]:
    """The first day of each source, as its snapshots' manifest says; anything but full ISO dates refuses."""
    found = publish.read_manifest(current).get("first_observed")
    if not isinstance(found, dict):
        return {}
    for source, day in found.items():
        try:
            good = dt.date.fromisoformat(day).isoformat() == day
        except (TypeError, ValueError):
            good = False
        if not good:
            raise PitBuildError(f"{source} was first observed on {day!r}, which is no date")
    return found


def corporate_actions(spark: SparkSession, data: Path, asked: DataFrame, lookup: DataFrame, documents: DataFrame, fetches: DataFrame) -> dict[str, int]:
    """Dividends and splits of the asked symbols. Published first, then refused if too many fetches failed."""
    resolved = matching.resolve_symbols(asked, lookup)
    flat = scans.company_facts(documents)
    shares = scans.share_counts(flat)
    gaap = flat.filter("taxonomy = 'us-gaap'")
    split_rows = facts.splits(gaap, shares)
    folder, work = data / "corporate_actions", data / "corporate_actions" / ".work"
    parts = publish.write_table(facts.publishable_dividends(facts.dividends(gaap, shares, split_rows), resolved), work / "dividends.parquet")
    n = publish.json_file(facts.publishable_splits(split_rows, resolved), ["ticker", "effective_date", "ratio"], work / "splits.jsonl")
    missing = [r["ticker"] for r in matching.unresolved(asked, resolved).orderBy("ticker").collect()]
    by_status = {s: [r["ticker"] for r in fetches.filter(F.col("status") == s).orderBy("ticker").collect()] for s in ("not_found", "failed")}
    extra = {"tickers_unresolved": missing, "tickers_no_companyfacts": by_status["not_found"], "tickers_failed": by_status["failed"]}
    counts = {"splits.jsonl": n} | {f"dividends.parquet/{p}": k for p, k in parts.items()}
    publish.publish(folder, {name: work / name for name in ("dividends.parquet", "splits.jsonl")}, ["https://data.sec.gov/api/xbrl/companyfacts/"], PUBLIC_NOTE, counts, extra)
    shutil.rmtree(work, ignore_errors=True)
    quality.require_few_failures(fetches)
    return {"splits": n, "dividends": sum(parts.values())}


def fetch_outcomes(resolved: DataFrame, documents: DataFrame, failed: DataFrame) -> DataFrame:
    """(ticker, status) of the resolved symbols: failed as told, not_found without a landed document, else ok."""
    landed = documents.select(F.col("cik").cast("bigint").alias("cik")).distinct().withColumn("__there", F.lit(True))
    broken = failed.select(F.col("cik").cast("bigint").alias("cik")).distinct().withColumn("__broken", F.lit(True))
    status = F.when(F.col("__broken"), "failed").when(F.col("__there"), "ok").otherwise("not_found")
    return resolved.join(landed, "cik", "left").join(broken, "cik", "left").select("ticker", status.alias("status"))


def collect_events(spark: SparkSession, data: Path, payloads: DataFrame, failed: list[int], today: str, limit: int | None = None, every: int = 500) -> int:
    """Add flagged filings of companies not yet done this ISO week; failed companies stay pending.

    Companies go in steps of ``every``, by number; each step publishes log and progress together, so a sweep that breaks off
    resumes after its last step. No limit, or zero, means all.
    """
    folder, name = data / "events", "events.jsonl.gz"
    schema, work = schemas.FLAGGED_EVENTS, data / "events" / ".work"
    week = "%d-W%02d" % dt.date.fromisoformat(today).isocalendar()[:2]
    progress = folder / ".progress.json"
    state = json.loads(progress.read_text()) if progress.exists() else {}
    done = {int(c) for c in state.get("done", [])} if state.get("week") == week else set()
    payloads = payloads.withColumn("cik", F.col("cik").cast("bigint"))
    marks = spark.createDataFrame([(week, c) for c in sorted(done)], "week string, cik bigint")
    waiting = flags.pending(payloads.select("cik").distinct(), marks, today).orderBy("cik")
    ciks = [r["cik"] for r in (waiting.limit(limit) if limit else waiting).collect()]  # a number per company
    n = 0
    for a in range(0, len(ciks), every) or [0]:
        step = ciks[a : a + every]
        log = publish.read_verified(spark, folder, name, schema) if (folder / name).exists() else spark.createDataFrame([], schema)
        filings = scans.submissions(payloads.filter(F.col("cik").between(step[0], step[-1]) & F.col("cik").isin(step)) if step else payloads.limit(0))
        found = flags.flagged_filings(filings).withColumn("__o", F.monotonically_increasing_id())
        added = flags.add_new(log, found, ["cik", "__o"]).drop("__o")
        n = publish.json_file(log.unionByName(added), [F.coalesce("filing_date", F.lit("")), "cik", F.coalesce("accession", F.lit(""))], work / name, compress=True)
        done |= set(step) - set(failed)
        mark = json.dumps({"week": week, "done": sorted(done)}).encode()
        publish.publish(folder, {name: work / name, ".progress.json": mark}, ["https://data.sec.gov/submissions/"], PUBLIC_NOTE, {name: n})
    shutil.rmtree(work, ignore_errors=True)
    return n


def mirror_metrics(spark: SparkSession, data: Path, archive: Path) -> dict[str, int]:
    """Allowlisted day files of third-party metrics; datasets that are not there are skipped."""
    out = {}
    for dataset in specs.ALLOWED_FIELDS:
        source = archive / dataset
        if not source.is_dir() or not any(source.glob("*.jsonl.gz")):
            continue
        rows, work = scans.daily_archive(spark, archive.as_uri(), dataset), data / "sentiment" / ".work"
        staged, counts = {}, {}
        for d in sorted(p.name.removesuffix(".jsonl.gz") for p in source.glob("*.jsonl.gz")):
            one = rows.filter(F.col("day") == d).drop("day")
            order = [c for c in ("ticker", "bucket_start") if c in one.columns]
            staged[f"{d}.jsonl"] = work / f"{d}.jsonl"
            counts[f"{d}.jsonl"] = publish.json_file(one, order, work / f"{d}.jsonl")
        folder = data / "sentiment" / dataset
        days = sorted({*staged, *[p.name for p in folder.glob("*.jsonl")]} if folder.exists() else staged)
        extra = {"first_day": days[0].removesuffix(".jsonl"), "last_day": days[-1].removesuffix(".jsonl")}
        publish.publish(folder, staged, [], "Aggregates only; see the upstream licence.", counts, extra)
        shutil.rmtree(work, ignore_errors=True)
        out[dataset] = sum(counts.values())
    return out


def stale(data: Path, limits: dict[str, float], now: dt.datetime, expected: tuple[str, ...] = tuple(specs.SOURCES), slack_days: float = 2.0) -> list[str]:
    """Why datasets or their sources are stale; unreadable means stale. A dataset's limit is exact, a source's has slack."""
    found = []
    for name, limit in sorted(limits.items()):
        try:
            age = (now - publish.generated_at(data / name)).total_seconds() / 86400
            if age > limit:
                found.append(f"{name}: {age:.2f} days old, limit {limit:g}")
            marks = publish.read_manifest(data / name).get("last_success")
        except (RefusalError, ValueError, OSError) as e:
            found.append(f"{name}: {e}")
            continue
        if marks is None:
            continue
        for source in expected:
            if source not in marks:
                found.append(f"{name}/{source}: never succeeded")
                continue
            try:
                days = (now.date() - dt.date.fromisoformat(marks[source])).days
            except (TypeError, ValueError):
                found.append(f"{name}/{source}: unreadable watermark {marks[source]!r}")
                continue
            if days > limit + slack_days:
                found.append(f"{name}/{source}: last success {marks[source]}")
    return found


def land(fetcher, landed: Path, log: Callable[[str], None] = print) -> list[str]:
    """Download every source into the landing folder; returns what failed."""
    outcome = land_each(fetcher, {f"{name}.raw": spec.url for name, spec in specs.SOURCES.items()}, landed, log)
    return [name.removesuffix(".raw") for name, status in outcome.items() if status != "ok"]


def land_each(fetcher, wanted: dict[str, str], landed: Path, log: Callable[[str], None] = print) -> dict[str, str]:
    """Download each url to its file; per file ok, not_found (expected absence) or failed. One that fails does not stop the others."""
    out = {}
    for name, url in wanted.items():
        try:
            publish.write_atomically(landed / name, fetcher.get(url))
            out[name] = "ok"
        except Exception as e:  # noqa: BLE001 - the outcome is recorded, and gates decide
            out[name] = "not_found" if is_missing(e) else "failed"
            log(f"{name}: {e}")
    return out


def is_missing(error: BaseException) -> bool:
    """Whether a fetch found nothing where nothing may be: as the error says, or, for errors that cannot say, by its text."""
    return bool(getattr(error, "not_found", False)) or " 404 " in f" {error} "


def land_documents(fetcher, ciks: list[int], url: str, folder: Path, log: Callable[[str], None] = print) -> dict[str, list[int]]:
    """Download one JSON document per company into ``folder`` and write the outcome beside them as ``outcome.json``.

    ``url``: with a place for the company's padded number, for example ``.../CIK{cik:010d}.json``.
    """
    got = land_each(fetcher, {f"{c}.json": url.format(cik=c) for c in ciks}, folder, log)
    outcome = {s: sorted(int(n.removesuffix(".json")) for n, x in got.items() if x == s) for s in ("ok", "not_found", "failed")}
    publish.write_atomically(folder / "outcome.json", (json.dumps(outcome, sort_keys=True) + "\n").encode())
    return outcome
