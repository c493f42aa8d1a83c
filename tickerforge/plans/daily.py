"""The nightly update: every step from the horizon of the calendar to the quality flags, as one plan over all securities."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge import schemas
from tickerforge.operators import adjust, delisting, dq, merge, screen, state, trading_calendar, validate

#: What a reset of each scope empties.
SCOPES = {
    "prices": ("daily_price", "watermark"),
    "actions": ("corporate_action", "adjustment_factor"),
    "market-data": ("daily_price", "watermark", "corporate_action", "adjustment_factor", "security_latest"),
    "landing": ("raw_payload",),
    "dq-flags": ("dq_flag",),
}
SCOPES["all"] = tuple(dict.fromkeys(t for tables in SCOPES.values() for t in tables))


def update(
    tables: dict[str, DataFrame], bars: DataFrame, splits: DataFrame, dividends: DataFrame, delisted: DataFrame, last_year: int, source: str = "vendor", start: date | None = None, symbols: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The tables after a night: calendar, delistings, prices with their flags and marks, actions, factors, snapshot, checks.

    ``tables`` has security, symbol_xref, trading_calendar, daily_price, corporate_action, dq_flag and
    watermark, and ingestion_run if runs are recorded; bars carry an ``ordinal``, of which the highest wins
    a date. ``symbols`` (symbol) are those that were asked for, the active ones by default, and ``start`` the day
    from which, if one was given. Raises where a load that looks successful can't have been. Every row
    that is left out, and every action that gives no factor, has its flag.
    """
    t = dict(tables)
    state.guard_changeover(t["watermark"], start)
    master = t["security"].select(F.col("primary_symbol").alias("symbol"), "is_actively_trading")
    asked = (master.where("is_actively_trading") if symbols is None else symbols).select("symbol").distinct()
    checked = validate.checked_bars(bars)
    n = checked.agg(F.count_if(F.col("reason").isNull()).alias("good"), F.count_if(F.col("reason").isNotNull()).alias("bad")).first()
    state.guard_load(asked.count(), asked.join(master, "symbol", "left_anti").count(), n["good"] + n["bad"], start is not None)
    run = bars.sparkSession.createDataFrame([(uuid.uuid4().hex, source, state.NEW_ENDPOINT, "started", datetime.now(), None, None, None, None)], schemas.INGESTION_RUN)

    t["trading_calendar"] = trading_calendar.extend(t["trading_calendar"], last_year)
    t["security"], t["symbol_xref"], _ = delisting.sweep(delisted, t["symbol_xref"], t["security"], source)
    good, flags = validate.good_and_bad(checked)
    t["daily_price"] = merge.upsert(t["daily_price"], good, ["security_id", "trade_date"], "ordinal")
    t["dq_flag"] = t["dq_flag"].unionByName(flags)
    history = t["dq_flag"].where(r"check_name LIKE 'price\\_%'").selectExpr("security_id", "record_date AS trade_date")
    marks = state.advance(good, flags.selectExpr("security_id", "record_date AS trade_date"), history).selectExpr(f"'{source}' AS source", f"'{state.NEW_ENDPOINT}' AS endpoint", "security_id", "watermark")
    t["watermark"] = state.merged_watermarks(t["watermark"], marks)
    actions, bad_actions = validate.good_and_bad_actions(validate.checked_actions(splits, dividends))
    t["corporate_action"] = merge.upsert(t["corporate_action"], actions, ["security_id", "action_type", "ex_date"])
    t["adjustment_factor"] = adjust.adjustment_factors_exact(t["corporate_action"], t["daily_price"])
    t["security_latest"] = screen.security_latest(t["security"], t["daily_price"])
    checks = dq.run_all(t["daily_price"], t["corporate_action"], t["security"], t["trading_calendar"])
    for more in (bad_actions, adjust.skipped_flags(t["corporate_action"], t["daily_price"]), checks):
        t["dq_flag"] = t["dq_flag"].unionByName(more)
    if "ingestion_run" in t:
        t["ingestion_run"] = t["ingestion_run"].unionByName(state.finished_run(run, n["good"], n["bad"] + bad_actions.count()))
    return t


def reset(tables: dict[str, DataFrame], scope: str, dry_run: bool = True) -> tuple[dict[str, DataFrame], tuple[str, ...]]:
    """The tables with those of a scope emptied, and their names; a dry run changes nothing."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {', '.join(SCOPES)}, not {scope!r}")
    hit = tuple(n for n in SCOPES[scope] if n in tables)
    return (tables if dry_run else {n: (df.limit(0) if n in hit else df) for n, df in tables.items()}), hit
