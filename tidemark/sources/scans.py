"""Raw directory, filing and fact files as typed DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas, specs
from tidemark.functions.scalars import iso_date


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def parsed(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """``df`` with the JSON text of a column as a value of ``schema`` (a type, or columns)."""
    return df.withColumn(column, F.from_json(column, schema))


def ticker_map_rows(df: DataFrame) -> DataFrame:
    """Objects of objects (value); the outer keys mean nothing."""
    maps = parsed(df, "map<string,struct<cik_str:bigint,ticker:string,title:string>>")
    return maps.select(F.explode(F.map_values("value")).alias("r")).select(F.col("r.cik_str").alias("cik"), "r.ticker", "r.title")


def sec_tickers(spark: SparkSession, path: str) -> DataFrame:
    return ticker_map_rows(_whole(spark, path)).orderBy("cik", "ticker")


def columnar_rows(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows (fields, data) to one row per inner array; a row of another width than the header refuses.

    ``columns``: output name to header name.
    """
    rows = df.select("fields", F.explode("data").alias("__r"))
    wide = F.size("__r") == F.size("fields")
    cell = lambda h: F.when(wide, F.element_at("__r", F.array_position("fields", h).cast("int"))).otherwise(F.raise_error(F.lit("a row has another width than its header")))
    return rows.select(*[cell(h).alias(out) for out, h in columns.items()])


def sec_exchange(spark: SparkSession, path: str) -> DataFrame:
    """Parallel header and rows; ``name`` is published as ``title``."""
    tables = parsed(_whole(spark, path), "struct<fields:array<string>,data:array<array<string>>>").select("value.*")
    rows = columnar_rows(tables, {"cik": "cik", "ticker": "ticker", "title": "name", "exchange": "exchange"})
    return rows.withColumn("cik", F.col("cik").cast("bigint")).orderBy("cik", F.coalesce("ticker", F.lit("")))


def delimited_rows(lines: DataFrame, header: list[str], columns: dict[str, str]) -> DataFrame:
    """Pipe-delimited lines (value) below a header: blank lines and the trailer go, short rows are filled, test issues dropped."""
    kept = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("File Creation Time")).select(F.split("value", "[|]").alias("__c"))
    cell = lambda name: F.coalesce(F.try_element_at("__c", F.lit(header.index(name) + 1)), F.lit("")) if name in header else F.lit("")
    return kept.filter(cell("Test Issue") != "Y").select(*[cell(h).alias(out) for out, h in columns.items()])


def _symbol_directory(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    lines = spark.read.text(path).filter(F.trim("value") != "")
    header = lines.first()["value"].split("|")
    return delimited_rows(lines.filter(F.col("value") != "|".join(header)), header, columns).orderBy("ticker")


def nasdaq_listed(spark: SparkSession, path: str) -> DataFrame:
    return _symbol_directory(spark, path, {"ticker": "Symbol", "name": "Security Name", "category": "Market Category", "etf": "ETF", "test_issue": "Test Issue"})


def other_listed(spark: SparkSession, path: str) -> DataFrame:
    return _symbol_directory(spark, path, {"ticker": "ACT Symbol", "name": "Security Name", "exchange": "Exchange", "etf": "ETF", "test_issue": "Test Issue"})


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or gzipped; blank lines do not count; a broken line fails the scan."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def daily_archive(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """All gzipped day files of a dataset with their ``day``, projected to what may be published."""
    from tidemark.operators.quality import allowed_only

    schema = {"ticker_buckets": schemas.TICKER_BUCKETS, "ticker_trends": schemas.TICKER_TRENDS}.get(dataset)
    if schema is None:
        raise ValueError(f"unknown dataset {dataset!r}")
    rows = json_lines(spark, f"{folder}/{dataset}/*.jsonl.gz", schema)
    named = rows.withColumn("day", F.regexp_extract(F.input_file_name(), r"([^/]+)\.jsonl\.gz$", 1))
    return allowed_only(named, dataset, {**specs.ALLOWED_FIELDS, dataset: (*specs.ALLOWED_FIELDS[dataset], "day")})


def zip_arrays(df: DataFrame, arrays: list[str], keep: list[str]) -> DataFrame:
    """Parallel arrays to rows with their position; the first array gives the length, short ones give nulls."""
    zipped = df.select(*keep, F.size(arrays[0]).alias("__n"), F.posexplode(F.arrays_zip(*arrays)).alias("pos", "__z"))
    return zipped.filter(F.col("pos") < F.col("__n")).select(*keep, "pos", *[F.col(f"__z.{a}").alias(a) for a in arrays])


def submissions(df: DataFrame) -> DataFrame:
    """Filer payloads to filings: cik, pos, form, filing_date, accession, items."""
    flat = df.select(F.col("cik").cast("bigint").alias("cik"), "filings.recent.*")
    rows = zip_arrays(flat, ["form", "filingDate", "accessionNumber", "items"], ["cik"]).filter("form IS NOT NULL")
    return rows.select("cik", "pos", "form", F.col("filingDate").alias("filing_date"), F.col("accessionNumber").alias("accession"), F.coalesce("items", F.lit("")).alias("items"))


def company_facts(df: DataFrame) -> DataFrame:
    """Nested fact documents to flat facts; ``ord`` is the position inside its unit, for ties."""
    tags = df.select("cik", F.explode("facts").alias("taxonomy", "tags")).select("cik", "taxonomy", F.explode("tags").alias("tag", "t"))
    units = tags.select("cik", "taxonomy", "tag", F.explode("t.units").alias("unit", "items"))
    rows = units.select("cik", "taxonomy", "tag", "unit", F.posexplode("items").alias("ord", "i"))
    strict = lambda c: F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(None)).otherwise(F.coalesce(iso_date(F.col(c)), F.raise_error(F.lit(f"a fact has a bad date in {c}")).cast("date")))
    return rows.select("cik", "taxonomy", "tag", "unit", F.col("ord").cast("bigint").alias("ord"), strict("i.start").alias("start"), strict("i.end").alias("end"), F.col("i.val").alias("val"), strict("i.filed").alias("filed"))


def tag_facts(facts: DataFrame, tag: str, units: tuple[str, ...]) -> DataFrame:
    return facts.filter((F.col("taxonomy") == "us-gaap") & (F.col("tag") == tag) & F.col("unit").isin(*units))


def share_counts(facts: DataFrame) -> DataFrame:
    ok = (F.col("taxonomy") == "dei") & (F.col("tag") == specs.SHARES_TAG) & F.col("end").isNotNull() & (F.col("val") != 0)
    return facts.filter(ok).select("cik", "end", "val")


def listed(rows: DataFrame, exchanges: tuple[str, ...] = specs.LISTED_EXCHANGES, order: str = "ord") -> DataFrame:
    """Rows on listed exchanges, the first of each upper-case ticker."""
    from tidemark.operators.diff import first_wins

    ok = rows.filter(F.col("exchange").isin(*exchanges) & (F.coalesce("ticker", F.lit("")) != "")).withColumn("__k", F.upper("ticker"))
    return first_wins(ok, ["__k"], [order]).drop("__k")


def universe(rows: DataFrame, limit: int | None, order: str = "ord", first: str | None = None) -> DataFrame:
    """Distinct companies in the order they first appear, on demand with that place; no limit, or zero, means all."""
    seen = rows.filter("cik IS NOT NULL").groupBy("cik").agg(F.min(order).alias("__o")).orderBy("__o")
    return (seen.limit(limit) if limit else seen).select("cik", *([F.col("__o").alias(first)] if first else []))
