"""Command line: one sub-command per job."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from pathlib import Path

from pyspark.sql import functions as F

from tidemark import schemas, specs
from tidemark.errors import RefusalError
from tidemark.operators import matching
from tidemark.plans import jobs
from tidemark.sources import publish, scans

# Where documents of companies are, and how old a dataset may be, in days.
FACTS_URL = "https://data.sec.gov/api/xbrl/companyfacts/CIK{cik:010d}.json"
SUBMISSIONS_URL = "https://data.sec.gov/submissions/CIK{cik:010d}.json"
LIMITS = {"symbols/current": 3.0, "symbols/pit": 3.0, "events": 10.0}


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _polite(agent: str):
    from tidemark.sources.landing import PoliteSession

    return PoliteSession(agent)


def _failed(folder: Path | None) -> list[int]:
    """Companies whose download failed, as the landing step wrote down."""
    there = folder is not None and (folder / "outcome.json").exists()
    return json.loads((folder / "outcome.json").read_text())["failed"] if there else []


def _documents(folder: Path) -> str:
    return f"{folder.resolve().as_uri()}/[0-9]*.json"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--data-dir", type=Path, default=Path("data"))
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, **wants) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, parents=[shared])
        for flag, kind in wants.items():
            sub.add_argument(f"--{flag}", type=kind, required=True)
        return sub

    command("land-directories", landed=Path, agent=str)
    facts = command("land-facts", landed=Path, agent=str)
    facts.add_argument("ciks", nargs="+", type=int)
    filers = command("land-submissions", landed=Path, agent=str)
    filers.add_argument("--limit", type=int)
    command("snapshot-symbols", landed=Path)
    command("build-pit")
    command("mirror-metrics", archive=Path)
    actions = command("corporate-actions", landed=Path)
    scope = actions.add_mutually_exclusive_group(required=True)
    scope.add_argument("--tickers", nargs="+")
    scope.add_argument("--all-listed", action="store_true")
    events = command("collect-events", landed=Path)
    events.add_argument("--limit", type=int)
    stale = command("staleness")
    stale.add_argument("--max-age-days", type=float)
    stale.add_argument("datasets", nargs="*", type=Path, help="folders, by default the known datasets with their own limits")
    return parser


def main(argv: list[str] | None = None, fetcher=None) -> int:
    """``fetcher`` stands in for the network, as in tests."""
    parser = _parser()
    args = parser.parse_args(argv)
    now = dt.datetime.now(dt.timezone.utc)
    day, data = now.date().isoformat(), args.data_dir
    current = data / "symbols" / "current"
    try:
        if args.command == "staleness":
            if args.datasets and (args.max_age_days is None or args.max_age_days < 0):
                parser.error("folders need --max-age-days, not below zero")
            found = [x for d in args.datasets for x in jobs.stale(d.parent, {d.name: args.max_age_days}, now)] if args.datasets else jobs.stale(data, LIMITS, now)
            print("\n".join(found) or "fresh")
            return int(bool(found))
        if args.command == "land-directories":
            bad = jobs.land(fetcher or _polite(args.agent), args.landed)
            return int(len(bad) == len(specs.SOURCES))
        if args.command == "land-facts":
            print(jobs.land_documents(fetcher or _polite(args.agent), args.ciks, FACTS_URL, args.landed))
            return 0
        spark = session()
        if args.command == "land-submissions":
            name = "sec_company_tickers_exchange"
            rows = scans.json_lines(spark, (current / f"{name}.jsonl").resolve().as_uri(), specs.SOURCES[name].schema)
            ciks = [r["cik"] for r in scans.universe(rows.withColumn("ord", F.monotonically_increasing_id()), args.limit).collect()]
            print(jobs.land_documents(fetcher or _polite(args.agent), ciks, SUBMISSIONS_URL, args.landed))
        elif args.command == "snapshot-symbols":
            counts, failed = jobs.snapshot_symbols(spark, data, args.landed, day)
            print(counts, *failed, sep="\n")
            return int(bool(failed) and not counts)
        elif args.command == "build-pit":
            print(jobs.build_pit(spark, data))
        elif args.command == "mirror-metrics":
            print(jobs.mirror_metrics(spark, data, args.archive))
        elif args.command == "collect-events":
            payloads = spark.read.schema(schemas.SUBMISSIONS).option("multiLine", True).json(_documents(args.landed))
            print(jobs.collect_events(spark, data, payloads, _failed(args.landed), day, args.limit))
        else:
            if args.tickers:
                asked = spark.createDataFrame([(t,) for t in args.tickers], "ticker string")
            else:
                name = "sec_company_tickers_exchange"
                rows = scans.json_lines(spark, (current / f"{name}.jsonl").resolve().as_uri(), specs.SOURCES[name].schema)
                asked = scans.listed(rows.withColumn("ord", F.monotonically_increasing_id())).select("ticker")
            lookup = publish.read_verified(spark, current, "sec_company_tickers.jsonl", specs.SOURCES["sec_company_tickers"].schema)
            documents = spark.read.schema(schemas.COMPANY_FACTS).option("multiLine", True).json(_documents(args.landed))
            failed = spark.createDataFrame([(c,) for c in _failed(args.landed)], "cik bigint")
            outcomes = jobs.fetch_outcomes(matching.resolve_symbols(asked, lookup), documents, failed)
            print(jobs.corporate_actions(spark, data, asked, lookup, documents, outcomes))
        return 0
    except RefusalError as e:
        print(f"FAILURE: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
