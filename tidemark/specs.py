"""Sources, keys and policy. They name the outside world and are stated as such."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark import schemas


@dataclass(frozen=True)
class SourceSpec:
    name: str
    url: str
    schema: str
    key: tuple[str, ...]
    parser: str  # a function of tidemark.sources.scans


SOURCES = {
    s.name: s
    for s in (
        SourceSpec("sec_company_tickers", "https://www.sec.gov/files/company_tickers.json", schemas.SEC, ("cik", "ticker"), "sec_tickers"),
        SourceSpec("sec_company_tickers_exchange", "https://www.sec.gov/files/company_tickers_exchange.json", schemas.SEC_EXCHANGE, ("cik", "ticker"), "sec_exchange"),
        SourceSpec("nasdaqlisted", "https://www.nasdaqtrader.com/dynamic/symdir/nasdaqlisted.txt", schemas.NASDAQ, ("ticker",), "nasdaq_listed"),
        SourceSpec("otherlisted", "https://www.nasdaqtrader.com/dynamic/symdir/otherlisted.txt", schemas.OTHER, ("ticker",), "other_listed"),
    )
}

# Per-share dividend tags, best first; tags of total cash paid; split and share-count tags.
DPS_TAGS = ("CommonStockDividendsPerShareCashPaid", "CommonStockDividendsPerShareDeclared", "DividendsPayableAmountPerShare")
CASH_TAGS = ("PaymentsOfDividendsCommonStock", "PaymentsOfDividends")
SPLIT_TAG = "StockholdersEquityNoteStockSplitConversionRatio1"
SHARES_TAG = "EntityCommonStockSharesOutstanding"

SPLIT_CHAIN_DAYS, RESTATEMENT_TOLERANCE, OVERLAP_DAYS = 370, 0.015, 20
FAILURE_LIMIT = 0.02
LISTED_EXCHANGES = ("NYSE", "Nasdaq", "NYSE American", "NYSE Arca", "CBOE", "BATS")

# Filing items worth a flag, and forms that end a listing (exact names).
FLAGGED_ITEMS = {
    "1.03": "bankruptcy_or_receivership",
    "2.04": "debt_acceleration",
    "3.01": "delisting_notice",
    "4.01": "auditor_change",
    "4.02": "non_reliance_on_financials",
    "5.02": "officer_departure",
}
DELISTING_FORMS = ("25", "25-NSE", "15", "15-12B", "15-12G", "15-15D")

# Third-party metrics: what may be published, and what must never be.
ALLOWED_FIELDS = {
    "ticker_buckets": ("ticker", "bucket_start", "bucket_minutes", "mentions", "engagement", "bull", "bear", "neutral", "sentiment_avg", "platforms"),
    "ticker_trends": (
        "ticker", "mentions", "mentions_prev", "engagement", "bull", "bear", "neutral", "bull_bear_ratio", "sentiment_avg",
        "engagement_weighted_score", "breakout_score", "velocity", "share_of_voice", "phase", "window_hours", "platforms", "updated_at",
    ),
}
FORBIDDEN_FIELDS = frozenset({"top_posts", "author", "text", "id", "url", "name", "source"})

# Least seconds between two requests to a host, by suffix; the first that fits counts.
HOST_SPACING = (("sec.gov", 1 / 8), ("nasdaqtrader.com", 0.5), ("treasury.gov", 0.5))
DEFAULT_SPACING = 0.25
