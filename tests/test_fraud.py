from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import START
from pyspark.sql import functions as F

from tillstream.operators.fraud import alert_text, fraud_alerts
from tillstream.operators.ranges import PIECE, in_ranges


def at(ms):
    return START + dt.timedelta(milliseconds=ms)


def visits(customer, *steps):
    return [
        {"customer_id": customer, "transaction_date": at(ms), "customer_country": country}
        for ms, country in steps
    ]


CASES = {
    "equal time": ([(0, "A"), (0, "B")], []),
    "earlier row arrives later": ([(0, "A"), (-1, "B")], []),
    "smallest": ([(0, "A"), (1, "B")], [(0, 0)]),
    "five minutes": ([(0, "A"), (300000, "B")], [(5, 0)]),
    "last inside": ([(0, "A"), (359999, "B")], [(5, 59)]),
    "six minutes": ([(0, "A"), (360000, "B")], []),
    "same country": ([(0, "A"), (1000, "A")], []),
    "null between": ([(0, "A"), (1000, None), (2000, "B")], []),
    "hop": ([(0, "A"), (1000, "B"), (2000, "A")], [(0, 1), (0, 1)]),
    "first row": ([(0, "A")], []),
    "out of order becomes the previous row": (
        [(100000, "A"), (0, "A"), (359000, "B")], [(5, 59)]
    ),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_boundaries(transactions, name):
    steps, expected = CASES[name]
    alerts = fraud_alerts(transactions(visits("c", *steps))).orderBy("seq").collect()
    assert [(a.minutes, a.seconds) for a in alerts] == expected


def test_order_is_arrival_not_time(transactions):
    rows = visits("c", (0, "A"), (1000, "B"))
    rows[0]["seq"], rows[1]["seq"] = 1, 0
    assert fraud_alerts(transactions(rows)).count() == 0


def test_other_limit(transactions):
    rows = visits("c", (0, "A"), (600000, "B"))
    assert fraud_alerts(transactions(rows)).count() == 0
    assert fraud_alerts(transactions(rows), max_minutes=10).count() == 1


def expected_alerts(rows):
    """One pass in arrival order with the last row of each customer in a dict."""
    last, alerts = {}, []
    for row in sorted(rows, key=lambda r: r["seq"]):
        customer = row["customer_id"]
        if customer is None:
            continue
        before = last.get(customer)
        if before and before["customer_country"] and row["customer_country"]:
            ms = (row["transaction_date"] - before["transaction_date"]) // dt.timedelta(milliseconds=1)
            if before["customer_country"] != row["customer_country"] and 0 < ms < 360000:
                alerts.append((customer, before["transaction_date"], row["transaction_date"], row["seq"]))
        last[customer] = row
    return sorted(alerts)


def random_rows(seed, n=600):
    """One customer holds half of all rows; arrival numbers are bunched at the start."""
    rng = random.Random(seed)
    sequence = sorted(rng.sample(range(n), n // 2)) + [n + 1000 * i for i in range(n - n // 2)]
    return [
        {
            "customer_id": rng.choice(["hot"] * 5 + ["a", "b", "c", "d", None]),
            "customer_country": rng.choice(["A", "B", "C", None]),
            "transaction_date": at(rng.randrange(0, 3_000_000)),
            "seq": seq,
        }
        for seq in sequence
    ]


@pytest.mark.parametrize("ranges", [1, 2, 7, 50, 400])
def test_any_number_of_pieces_gives_the_same_alerts(transactions, ranges):
    rows = random_rows(ranges)
    alerts = fraud_alerts(transactions(rows), ranges=ranges).collect()
    found = sorted((a.customer_id, a.previous_date, a.date, a.seq) for a in alerts)
    assert found == expected_alerts(rows) and found


ORDERS = {
    "text": "format_string('%09d', seq)",
    "struct": "named_struct('x', 'x', 'seq', seq)",
    "beyond a double's precision": "1152921504606846976 + seq",
    "decimal": "cast(100000000000000000000 + seq as decimal(30,0))",
    "time": "timestamp_seconds(seq)",
    "shared by many": "if(seq < 300, 0, seq)",
}


@pytest.mark.parametrize("kind", ORDERS)
def test_orders_of_every_type(transactions, kind):
    rows = random_rows(9, 400)
    df = transactions(rows).withColumn("lead", F.expr(ORDERS[kind]))
    alerts = fraud_alerts(df, ["lead", "seq"], ranges=30).collect()
    found = sorted((a.customer_id, a.previous_date, a.date, a.seq) for a in alerts)
    assert found == expected_alerts(rows)


@pytest.mark.parametrize("key,order", [("customer_id", "seq"), ("nothing", "seq"), ("customer_id", "text")])
def test_no_piece_is_large(transactions, key, order):
    """One customer, or the null key, holds most rows."""
    df = transactions(random_rows(3, 2000)).withColumns(
        {"text": F.expr(ORDERS["text"]), "nothing": F.lit(None).cast("string")}
    )
    pieces = in_ranges(df, key, [order], 20).groupBy(PIECE).count().collect()
    assert len(pieces) >= 15 and max(p["count"] for p in pieces) <= 3 * 2000 / 20


def test_alert_text(transactions):
    rows = visits("mai", (0, "UK"), (90_250, "Japan"))
    rows[0]["total_amount"] = 1234.5
    [row] = alert_text(fraud_alerts(transactions(rows))).collect()
    lines = row.alert.split("\n")
    assert lines[0] == "" and lines[-1] == "" and len(lines) == 21
    assert lines[4] == "║ Customer ID: " + "mai".ljust(50) + "║"
    assert lines[7] == "║    Quốc gia: " + "UK".ljust(49) + "║"
    assert lines[8] == "║    Thời gian: " + "2025-01-01 00:00:00.0".ljust(48) + "║"
    assert lines[10] == "║    Số tiền: " + "1234.50".ljust(50) + "║"
    assert lines[14] == "║    Thời gian: " + "2025-01-01 00:01:30.25".ljust(48) + "║"
    assert "1 phút 30 giây" in lines[18]
