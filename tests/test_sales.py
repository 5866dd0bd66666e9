"""The sales tables against a row-by-row account of keyed sums and upserts."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from conftest import START

from tillstream.operators.sales import (
    running_totals,
    sales_per_category,
    sales_per_day,
    sales_per_month,
)


def random_rows(seed, n=200):
    """Arrival over fourteen months, with several rows in one millisecond."""
    rng = random.Random(seed)
    times = sorted(
        START + dt.timedelta(days=rng.randrange(0, 420, 7), milliseconds=rng.randrange(0, 3))
        for _ in range(n)
    )
    return [
        {
            "transaction_date": time,
            "product_category": rng.choice(["home"] * 4 + ["fashion", "beauty"]),
            "total_amount": rng.randrange(1, 100000) / 100,
            "seq": number,
        }
        for number, time in enumerate(times)
    ]


def as_stored(rows, state_key, table_key):
    """Sum under one key, store under another: what each table holds after the last row."""
    sums, table = {}, {}
    for row in rows:
        key = state_key(row)
        first, total = sums.get(key, (row, Decimal(0)))
        sums[key] = (first, total + Decimal(str(row["total_amount"])))
        table[table_key(first, row)] = float(sums[key][1])
    return table


def day(row):
    return row["transaction_date"].date()


def test_category_as_written(transactions):
    rows = random_rows(1)
    expected = as_stored(
        rows, lambda r: r["product_category"], lambda first, r: (day(r), r["product_category"])
    )
    found = sales_per_category(transactions(rows), "as_written").collect()
    assert {(r.transaction_date, r.category): r.total_sales for r in found} == expected


def test_day_as_written(transactions):
    rows = random_rows(2)
    expected = as_stored(rows, lambda r: r["transaction_date"], lambda first, r: day(r))
    found = sales_per_day(transactions(rows), "as_written").collect()
    assert {r.transaction_date: r.total_sales for r in found} == expected


def test_month_as_written(transactions):
    rows = random_rows(3)
    expected = as_stored(
        rows,
        lambda r: day(r).month,
        lambda first, r: (day(first).year, day(first).month),
    )
    found = sales_per_month(transactions(rows), "as_written").collect()
    assert {(r.year, r.month): r.total_sales for r in found} == expected
    assert len(expected) == 12


def test_calendar(transactions):
    rows = random_rows(4)
    df = transactions(rows)
    by_day = as_stored(rows, day, lambda first, r: day(r))
    assert {r.transaction_date: r.total_sales for r in sales_per_day(df).collect()} == by_day
    by_category = as_stored(
        rows,
        lambda r: (day(r), r["product_category"]),
        lambda first, r: (day(r), r["product_category"]),
    )
    found = sales_per_category(df).collect()
    assert {(r.transaction_date, r.category): r.total_sales for r in found} == by_category
    by_month = as_stored(
        rows, lambda r: (day(r).year, day(r).month), lambda first, r: (day(r).year, day(r).month)
    )
    assert {(r.year, r.month): r.total_sales for r in sales_per_month(df).collect()} == by_month


def test_late_rows_count_in_their_own_day(transactions):
    rows = [
        {"transaction_date": START + dt.timedelta(days=d), "total_amount": 1.1} for d in (5, 0, 5)
    ]
    totals = {r.transaction_date.day: r.total_sales for r in sales_per_day(transactions(rows)).collect()}
    assert totals == {6: 2.2, 1: 1.1}


def test_time_column(transactions):
    rows = [{"transaction_date": START, "ingest_ts": START + dt.timedelta(days=1)}]
    [row] = sales_per_day(transactions(rows), time_col="ingest_ts").collect()
    assert row.transaction_date == dt.date(2025, 1, 2)


def test_sums_are_exact(transactions):
    rows = [{"total_amount": 0.1}] * 10 + [{"total_amount": 0.2}] * 7
    [row] = sales_per_day(transactions(rows)).collect()
    assert row.total_sales == 2.4


def test_unknown_mode(transactions):
    with pytest.raises(ValueError):
        sales_per_day(transactions([]), "weekly")


def test_sums_keep_fractions_of_a_cent_and_large_amounts(transactions):
    def total(*amounts):
        return sales_per_day(transactions([{"total_amount": a} for a in amounts])).first().total_sales

    assert total(*[0.004] * 1000) == 4.0
    assert total(*[9.9e15] * 10) == 9.9e16
    assert total(1e16, -1e16, 0.25) == 0.25
    assert total(*[-0.1] * 10) == -1.0
    assert total(1e300, 1.0) == 1e300
    assert total(*[2.0**61] * 100) == 100 * 2.0**61


@pytest.mark.parametrize("ranges", [1, 9, 40, 300])
def test_running_totals(transactions, ranges):
    rows = random_rows(ranges)
    sums, expected = {}, {}
    for row in rows:
        key = row["product_category"]
        sums[key] = sums.get(key, Decimal(0)) + Decimal(str(row["total_amount"]))
        expected[row["seq"]] = float(sums[key])
    found = running_totals(transactions(rows), "product_category", ranges=ranges).collect()
    assert {r.seq: r.running_total for r in found} == expected


@pytest.mark.parametrize("kind", ["long", "text", "struct"])
@pytest.mark.parametrize("key", ["same", "nothing"])
def test_running_totals_of_one_key(transactions, kind, key):
    """One key for all rows, or no key at all, in orders that a double cannot tell apart."""
    df = transactions([{"total_amount": 1.0 + i} for i in range(400)]).withColumns(
        {
            "same": F.lit("k"),
            "nothing": F.lit(None).cast("string"),
            "long": F.lit(1 << 60) + F.col("seq"),
            "text": F.format_string("%09d", "seq"),
            "struct": F.struct("seq"),
            "down": -F.col("seq"),
        }
    )
    found = running_totals(df, key, [kind, "down"], ranges=25).collect()
    assert {r.seq: r.running_total for r in found} == {i: i + i * (i + 1) / 2 + 1.0 for i in range(400)}
