"""Fundamental ratios as expressions over one integrated statement row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arith import half_even, nz, percent, ratio


def fundamental_ratios(places: int | None = None) -> dict[str, Column]:
    """Twelve ratios; ``places=2`` gives the stored, rounded form, ``None`` the exact one."""
    liquidity = ratio(nz("current_assets"), "current_liabilities")
    exprs = {
        "gross_margin": percent(nz("gross_profit"), "revenue"),
        "operating_margin": percent(nz("operating_income"), "revenue"),
        "profit_margin": percent(nz("net_income"), "revenue"),
        "roe": percent(nz("net_income"), "total_equity"),
        "roa": percent(nz("net_income"), "total_assets"),
        "current_ratio": liquidity,
        "quick_ratio": liquidity,  # statements carry no inventory
        "debt_to_equity": ratio(nz("total_debt"), "total_equity"),
        "debt_to_assets": ratio(nz("total_debt"), "total_assets"),
        "asset_turnover": ratio("revenue", "total_assets", F.col("revenue") > 0),
        "book_value_per_share": ratio(
            "total_equity", "shares_outstanding", F.col("total_equity") > 0
        ),
        "revenue_per_share": ratio("revenue", "shares_outstanding", F.col("revenue") > 0),
    }
    return {name: half_even(e, places) for name, e in exprs.items()}


def statement_view_ratios() -> dict[str, Column]:
    """Eight unrounded ratios of the joined income and balance rows."""
    return {
        "gross_margin_pct": percent("gross_profit", "revenue"),
        "operating_margin_pct": percent("operating_income", "revenue"),
        "net_margin_pct": percent("net_income", "revenue"),
        "debt_to_equity": ratio("total_debt", "total_equity"),
        "debt_to_assets": ratio("total_debt", "total_assets"),
        "current_ratio": ratio("current_assets", "current_liabilities"),
        "revenue_per_share": ratio("revenue", "shares_outstanding"),
        "book_value_per_share": ratio("total_equity", "shares_outstanding"),
    }


def with_extra_ratios(df: DataFrame, by: list[str], order: str = "fiscal_date") -> DataFrame:
    """Cash ratio, cash and free cash flow per share, and returns on average balances.

    The window holds one row per entity and fiscal period.
    """
    w = Window.partitionBy(*by).orderBy(order)
    avg_equity = (F.col("total_equity") + F.col("_prev_equity")) / 2
    avg_assets = (F.col("total_assets") + F.col("_prev_assets")) / 2
    return (
        df.withColumns(
            {
                "_prev_equity": F.lag("total_equity").over(w),
                "_prev_assets": F.lag("total_assets").over(w),
            }
        )
        .withColumns(
            {
                "cash_ratio": ratio("cash_and_equivalents", "current_liabilities"),
                "cash_per_share": ratio("cash_and_equivalents", "shares_outstanding"),
                "free_cash_flow_per_share": ratio("free_cash_flow", "shares_outstanding"),
                "roe_average": percent(nz("net_income"), avg_equity),
                "roa_average": percent(nz("net_income"), avg_assets),
            }
        )
        .drop("_prev_equity", "_prev_assets")
    )
