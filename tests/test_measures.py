"""Dashboard measures: ordering, filters and ratio-of-sums semantics."""

from datetime import date
from decimal import Decimal

import pytest

from ledgerline.plans import measures

MART = [
    ("k1", date(2023, 1, 1), "TRANSFER", "high", Decimal("100.00"), 1, 1),
    ("k2", date(2023, 1, 1), "PAYMENT", "low", Decimal("10.00"), 9, 0),
    ("k3", date(2023, 1, 2), "TRANSFER", "low", Decimal("300.00"), 3, 0),
    ("k4", date(2023, 1, 2), "DEBIT", "medium", Decimal("310.00"), 2, 1),
]
SCHEMA = ("mart_key string, date_key date, transaction_type string, customer_segment string, "
          "settled_amount decimal(28,2), transaction_count bigint, fraud_count bigint")


@pytest.fixture()
def mart(spark):
    return spark.createDataFrame(MART, SCHEMA)


def test_ranked_bars_descending_with_tie_break(mart):
    got = [(r[0], r[1]) for r in measures.volume_by_type(mart).collect()]
    assert got == [("TRANSFER", Decimal("400.00")), ("DEBIT", Decimal("310.00")), ("PAYMENT", Decimal("10.00"))]
    counts = [r[0] for r in measures.count_by_type(mart).collect()]
    assert counts == ["PAYMENT", "TRANSFER", "DEBIT"]


def test_ratio_of_sums_not_mean_of_ratios(mart):
    got = {r[0]: r[1] for r in measures.avg_ticket_by_type(mart).collect()}
    assert got["TRANSFER"] == pytest.approx(400 / 4)       # not (100/1 + 300/3) / 2
    rate = measures.kpi_fraud_rate(mart).first()[0]
    assert rate == pytest.approx(2 / 15 * 100)


def test_trend_is_date_ordered(mart):
    assert [str(r[0]) for r in measures.trend_daily(mart).collect()] == ["2023-01-01", "2023-01-02"]


def test_empty_selection_means_no_filter(mart):
    assert measures.apply_filters(mart, [], []).count() == 4
    assert measures.apply_filters(mart, None, ["low"]).count() == 2
    assert measures.apply_filters(mart, ["TRANSFER"], ["low"]).count() == 1


def test_filter_options_lists_each_field(mart):
    got = sorted(tuple(r) for r in measures.filter_options(mart).collect())
    assert ("customer_segment", "medium") in got and ("transaction_type", "DEBIT") in got
    assert len(got) == 6
