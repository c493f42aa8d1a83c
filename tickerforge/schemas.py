"""Explicit schemas of the warehouse tables. Prices at rest are decimals; analytics run in double."""

from __future__ import annotations

SCHEMA_VERSION = 1

EXCHANGE = "exchange_code string, name string, timezone string, country string"
SECTOR = "sector_id int, sector_name string"
INDUSTRY = "industry_id int, industry_name string"
TRADING_CALENDAR = "exchange_code string, trade_date date, is_open boolean"
SECURITY = """security_id long, source string, primary_symbol string, company_name string, exchange_code string, sector_id int, industry_id int,
    asset_type string, is_etf boolean, is_fund boolean, is_actively_trading boolean, country string, market_cap_usd decimal(24,2), beta decimal(12,6),
    ipo_date date, delisted_date date, cik string, isin string, cusip string"""
SYMBOL_XREF = "security_id long, symbol string, valid_from date, valid_to date, is_primary boolean"
COMPANY_PROFILE = "security_id long, description string"
DAILY_PRICE = "security_id long, trade_date date, open decimal(20,6), high decimal(20,6), low decimal(20,6), close decimal(20,6), volume long, vwap decimal(20,6)"
CORPORATE_ACTION = "security_id long, action_type string, ex_date date, split_numerator decimal(20,10), split_denominator decimal(20,10), dividend_amount decimal(20,10)"
ADJUSTMENT_FACTOR = "security_id long, effective_date date, price_factor decimal(20,10), volume_factor decimal(20,10)"
INGESTION_RUN = "run_id string, source string, endpoint string, status string, started_at timestamp, ended_at timestamp, rows_inserted long, rows_quarantined long, error string"
DQ_FLAG = "check_name string, severity string, security_id long, record_date date, detail string, run_id string"
WATERMARK = "source string, endpoint string, security_id long, watermark date"
RAW_PAYLOAD = "endpoint string, symbol string, payload string, payload_hash string, n_bytes long"

#: What each table's rows must satisfy, as SQL predicates.
CHECKS: dict[str, dict[str, str]] = {
    "daily_price": {
        "positive_prices": "open > 0 AND high > 0 AND low > 0 AND close > 0",
        "high_low": "high >= low",
        "high_open": "high >= open",
        "high_close": "high >= close",
        "low_open": "low <= open",
        "low_close": "low <= close",
        "volume": "volume >= 0",
    },
    "corporate_action": {
        "kind": "action_type IN ('split', 'dividend')",
        "split": "action_type <> 'split' OR (split_numerator > 0 AND split_denominator > 0)",
        "dividend": "action_type <> 'dividend' OR dividend_amount >= 0",
    },
    "adjustment_factor": {"price": "price_factor > 0", "volume": "volume_factor > 0"},
}
