"""Published schemas, as DDL."""

SEC = "cik BIGINT, ticker STRING, title STRING"
SEC_EXCHANGE = "cik BIGINT, ticker STRING, title STRING, exchange STRING"
NASDAQ = "ticker STRING, name STRING, category STRING, etf STRING, test_issue STRING"
OTHER = "ticker STRING, name STRING, exchange STRING, etf STRING, test_issue STRING"
INTERVAL_FIELDS = ("valid_from", "valid_to", "provable_from")
FACTS = "cik BIGINT, tag STRING, unit STRING, ord BIGINT, start DATE, end DATE, val DOUBLE, filed DATE"
SHARES = "cik BIGINT, end DATE, val DOUBLE"
SPLITS = "ticker STRING, cik BIGINT, effective_date DATE, ratio DOUBLE, confidence STRING, filed DATE, flags ARRAY<STRING>"
DIVIDENDS = (
    "ticker STRING, cik BIGINT, period_start DATE, period_end DATE, span_type STRING, dps_current_basis DOUBLE, "
    "source_tag STRING, filed DATE, derived BOOLEAN, approximate BOOLEAN, flags STRING"
)
FLAGGED_EVENTS = "cik BIGINT, form STRING, filing_date STRING, accession STRING, event STRING, items STRING"
TICKER_BUCKETS = (
    "ticker STRING, bucket_start STRING, bucket_minutes BIGINT, mentions BIGINT, engagement BIGINT, bull BIGINT, "
    "bear BIGINT, neutral BIGINT, sentiment_avg DOUBLE, platforms MAP<STRING,BIGINT>"
)
TICKER_TRENDS = (
    "ticker STRING, mentions BIGINT, mentions_prev BIGINT, engagement BIGINT, bull BIGINT, bear BIGINT, neutral BIGINT, "
    "bull_bear_ratio DOUBLE, sentiment_avg DOUBLE, engagement_weighted_score DOUBLE, breakout_score DOUBLE, velocity DOUBLE, "
    "share_of_voice DOUBLE, phase STRING, window_hours BIGINT, platforms MAP<STRING,BIGINT>, updated_at STRING"
)
_XBRL_ITEM = "ARRAY<STRUCT<start:STRING,end:STRING,val:DOUBLE,filed:STRING>>"
COMPANY_FACTS = f"cik BIGINT, facts MAP<STRING,MAP<STRING,STRUCT<units:MAP<STRING,{_XBRL_ITEM}>>>>"
SUBMISSIONS = (
    "cik STRING, filings STRUCT<recent:STRUCT<form:ARRAY<STRING>,filingDate:ARRAY<STRING>,"
    "accessionNumber:ARRAY<STRING>,items:ARRAY<STRING>>>"
)
