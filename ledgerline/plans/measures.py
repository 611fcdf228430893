"""Reporting measures over the mart (the dashboard's numbers).

Ratios are always ratios of sums (never means of per-row ratios) and are
computed in DOUBLE so every engine returns the same value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.sizing import sort_bounded

MONEY_SUM = "decimal(28,2)"


def _ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    r = num.cast("double") / den.cast("double")
    return r * F.lit(scale) if scale != 1.0 else r


def volume() -> Column:
    return F.sum("settled_amount").cast(MONEY_SUM)


def count() -> Column:
    return F.sum("transaction_count").cast("bigint")


def avg_ticket() -> Column:
    return _ratio(F.sum("settled_amount"), F.sum("transaction_count"))


def fraud_rate_pct() -> Column:
    return _ratio(F.sum("fraud_count"), F.sum("transaction_count"), 100.0)


def apply_filters(mart: DataFrame, types: Sequence[str] | None = None,
                  segments: Sequence[str] | None = None) -> DataFrame:
    """Multi-select page filters; an empty selection means no filter."""
    if types:
        mart = mart.filter(F.col("transaction_type").isin(*types))
    if segments:
        mart = mart.filter(F.col("customer_segment").isin(*segments))
    return mart


def kpi_totals(mart: DataFrame) -> DataFrame:
    return mart.agg(count().alias("total_transactions"), volume().alias("total_settled_volume"))


def kpi_fraud_rate(mart: DataFrame) -> DataFrame:
    return mart.agg(fraud_rate_pct().alias("fraud_rate_pct"))


def _by(mart: DataFrame, dim: str, measure: Column, name: str, descending: bool = True) -> DataFrame:
    out = mart.groupBy(dim).agg(measure.alias(name))
    order = [F.col(name).desc(), F.col(dim)] if descending else [F.col(dim)]
    # one row per type / segment / day: bounded, sorted in one small task
    return sort_bounded(out, *order)


def volume_by_type(mart: DataFrame) -> DataFrame:
    return _by(mart, "transaction_type", volume(), "settled_volume")


def count_by_type(mart: DataFrame) -> DataFrame:
    return _by(mart, "transaction_type", count(), "transactions")


def avg_ticket_by_type(mart: DataFrame) -> DataFrame:
    return _by(mart, "transaction_type", avg_ticket(), "avg_ticket")


def fraud_rate_by_type(mart: DataFrame) -> DataFrame:
    return _by(mart, "transaction_type", fraud_rate_pct(), "fraud_rate_pct")


def volume_by_segment(mart: DataFrame) -> DataFrame:
    return _by(mart, "customer_segment", volume(), "settled_volume")


def trend_daily(mart: DataFrame) -> DataFrame:
    return _by(mart, "date_key", volume(), "settled_volume", descending=False)


def filter_options(mart: DataFrame, columns: Sequence[str] = ("transaction_type", "customer_segment")
                   ) -> DataFrame:
    """Distinct values offered by each page filter, as (field, value)."""
    parts = [mart.select(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")).distinct()
             for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
