"""The same results in plain SQL, written independently of the library's operators.

Only the fixed tables (products, countries, labels, the alert box) are shared with the library; a wrong entry there would
show on neither side.
"""

from __future__ import annotations

from tillstream.functions import text
from tillstream.sources import dims


def _literal(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)


_PRODUCTS = _values((f"product{i}", *row) for i, row in enumerate(dims.PRODUCTS, 1))
_COUNTRIES = _values((name, flag, place) for name, (_, flag, place) in dims.COUNTRIES.items())
_PAIRS = _values(
    (number, slot, customer, country)
    for number, (country, (customers, _, _)) in enumerate(dims.COUNTRIES.items())
    for slot, customer in enumerate(customers)
)

_DIMS = f"""
products(product_id, product_name, product_category, product_brand, low, high, currency, payment_method)
  AS (VALUES {_PRODUCTS}),
countries(customer_country, flag, location) AS (VALUES {_COUNTRIES}),
pairs(country_number, slot, customer_id, customer_country) AS (VALUES {_PAIRS})"""

_SALES = """
SELECT CAST(event_id AS VARCHAR) AS transaction_id, p.product_id, p.product_name, p.product_category,
       value AS product_price, CAST(event_id % 10 + 1 AS INTEGER) AS product_quantity, p.product_brand,
       CAST(CAST(value AS DECIMAL(18,2)) * (event_id % 10 + 1) AS DOUBLE) AS total_amount,
       p.currency, {customer} AS customer_id, date_trunc('milliseconds', ts) AS transaction_date,
       p.payment_method, {country} AS customer_country, event_id AS seq
FROM events JOIN products p ON p.product_id = 'product' || CAST(event_id % 32 + 1 AS VARCHAR)
{join}"""

_E = _SALES.format(
    customer="CAST(user_id AS VARCHAR)",
    country="n_name",
    join="JOIN nation ON n_nationkey = CAST(json_extract_string(props, '$.k') AS INTEGER) % 25",
)
_W = _SALES.format(
    customer="pairs.customer_id",
    country="pairs.customer_country",
    join="JOIN pairs ON country_number = user_id % 8 AND slot = (user_id // 8) % 5",
)
_O = """
SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS day, c_mktsegment AS category,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM orders JOIN customer ON o_custkey = c_custkey"""
_L = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
       CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS product_category,
       p_retailprice AS product_price, CAST(l_quantity AS INTEGER) AS product_quantity,
       p_brand AS product_brand, l_extendedprice AS total_amount, 'USD' AS currency,
       CAST(l_suppkey AS VARCHAR) AS customer_id, l_shipdate AS transaction_date,
       'credit_card' AS payment_method, l_partkey, l_suppkey
FROM lineitem JOIN part ON l_partkey = p_partkey"""

_WITH_E = f"WITH {_DIMS}, e AS ({_E})"
_WITH_W = f"WITH {_DIMS}, w AS ({_W})"


def _fraud(source: str, order: str, extra: str = "seq") -> str:
    return f"""
SELECT customer_id, previous_country, previous_date, previous_product, previous_amount,
       customer_country AS country, transaction_date AS date, product_name AS product,
       total_amount AS amount, CAST(ms // 60000 AS BIGINT) AS minutes,
       CAST(ms // 1000 % 60 AS BIGINT) AS seconds, {extra}
FROM (
  SELECT *, epoch_ms(transaction_date) - epoch_ms(previous_date) AS ms
  FROM (
    SELECT *, lag(customer_country) OVER o AS previous_country,
           lag(transaction_date) OVER o AS previous_date,
           lag(product_name) OVER o AS previous_product,
           lag(total_amount) OVER o AS previous_amount
    FROM {source} WINDOW o AS (PARTITION BY customer_id ORDER BY {order})
  )
)
WHERE previous_country <> customer_country AND ms > 0 AND ms // 60000 <= 5"""


def _running(key: str, name: str) -> str:
    return f"""{_WITH_E}
SELECT transaction_id, {key} AS {name},
       CAST(sum(CAST(total_amount AS DECIMAL(18,2))) OVER (
         PARTITION BY {key} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
       ) AS DOUBLE) AS running_total
FROM e"""


def _case(column: str, labels: dict[str, str], fallback: str) -> str:
    whens = " ".join(f"WHEN {_literal(k)} THEN {_literal(v)}" for k, v in labels.items())
    return f"CASE {column} {whens} ELSE {fallback} END"


_PAYMENT = _case("payment_method", text.PAYMENT_LABELS, "payment_method")
_CATEGORY = _case("product_category", text.CATEGORY_ICONS, _literal(text.DEFAULT_ICON))
_PRODUCT = _case("product_name", text.PRODUCT_ICONS, _literal(text.DEFAULT_ICON))

_DOUBLE_TEXT = "CAST({} AS VARCHAR)"


def _json(date: str) -> str:
    """The 13 properties in order; every text in the test tables is free of JSON escapes."""
    parts = [
        "'{\"transactionId\":\"' || transaction_id",
        "'\",\"productId\":\"' || product_id",
        "'\",\"productName\":\"' || product_name",
        "'\",\"productCategory\":\"' || product_category",
        "'\",\"productPrice\":' || " + _DOUBLE_TEXT.format("product_price"),
        "',\"productQuantity\":' || CAST(product_quantity AS VARCHAR)",
        "',\"productBrand\":\"' || product_brand",
        "'\",\"totalAmount\":' || " + _DOUBLE_TEXT.format("total_amount"),
        "',\"currency\":\"' || currency",
        "'\",\"customerId\":\"' || customer_id",
        "'\",\"transactionDate\":' || " + date,
        "',\"paymentMethod\":\"' || payment_method",
        "'\",\"customerCountry\":\"' || customer_country || '\"}'",
    ]
    return " || ".join(parts)




def _document_of_accepted() -> str:
    """Like _json; the country may be missing, and the price is 0.0 then."""
    body = _json("CAST(epoch_ms(transaction_date) AS VARCHAR)")
    country = "'\",\"customerCountry\":\"' || customer_country || '\"}'"
    assert body.endswith(country)
    return body.removesuffix(country) + (
        "'\",\"customerCountry\":' || coalesce('\"' || customer_country || '\"', 'null') || '}'"
    )


_DOCUMENT = _json("CAST(epoch_ms(transaction_date) AS VARCHAR)")
_MESSAGE = _json("strftime(transaction_date, '\"%Y-%m-%dT%H:%M:%S.%gZ\"')")

# What becomes of each message variant (the sequence number modulo 32).
_REASON = """CASE seq % 32 WHEN 6 THEN 'corrupt' WHEN 7 THEN 'corrupt' WHEN 8 THEN 'unknown_property'
  WHEN 10 THEN 'null_event_time' WHEN 12 THEN 'null_customer' WHEN 13 THEN 'null_category'
  WHEN 14 THEN 'null_id' WHEN 16 THEN 'bad_number' WHEN 17 THEN 'bad_date'
  WHEN 18 THEN 'unknown_property' WHEN 23 THEN 'bad_number' END"""
_ACCEPTED = """
SELECT transaction_id, product_id, product_name, product_category,
       CASE WHEN seq % 32 = 4 THEN 0.0 ELSE product_price END AS product_price,
       CASE WHEN seq % 32 = 4 THEN 0 ELSE product_quantity END AS product_quantity,
       product_brand, total_amount, currency, customer_id,
       CASE WHEN seq % 32 = 22 THEN date_trunc('minute', transaction_date)
            ELSE transaction_date END AS transaction_date,
       payment_method, CASE WHEN seq % 32 = 24 THEN NULL ELSE customer_country END AS customer_country,
       seq
FROM r WHERE reason IS NULL"""
_WITH_R = f"{_WITH_E}, r AS (SELECT *, {_REASON} AS reason FROM e WHERE seq % 32 <> 5)"

_SUM = "CAST(sum(amount) AS DOUBLE) AS total_sales"
_PER_CATEGORY = f"""WITH o AS ({_O})
SELECT day AS transaction_date, category, {_SUM} FROM o GROUP BY day, category"""
_PER_DAY = f"""{_WITH_E}
SELECT CAST(transaction_date AS DATE) AS transaction_date,
       CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
FROM e GROUP BY 1"""
_PER_MONTH = f"""WITH o AS ({_O})
SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, {_SUM}
FROM o GROUP BY 1, 2"""
_PER_MONTH_AS_WRITTEN = f"""WITH o AS ({_O})
SELECT CAST(arg_min(year(day), (day, seq)) AS INTEGER) AS year,
       CAST(month(day) AS INTEGER) AS month, {_SUM}
FROM o GROUP BY month(day)"""
_LATEST = f"""WITH l AS ({_L})
SELECT * EXCLUDE (l_partkey, l_suppkey, n) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY transaction_date DESC, l_partkey DESC, l_suppkey DESC) AS n
  FROM l
) WHERE n = 1"""
_ALERTS = f"{_WITH_E} {_fraud('e', 'seq')}"

_TIMESTAMP_TEXT = "regexp_replace(strftime({}, '%Y-%m-%d %H:%M:%S.%g'), '0{{1,2}}$', '')"
_ALERT_ARGUMENTS = ", ".join(
    (
        "customer_id", "previous_country", _TIMESTAMP_TEXT.format("previous_date"),
        "previous_product", "previous_amount", "country", _TIMESTAMP_TEXT.format("date"),
        "product", "amount", "minutes", "seconds",
    )
)

# A corrupt message has no data; the others show what could be read.
_SHOWN = "CASE WHEN reason IS DISTINCT FROM 'corrupt' THEN {} END"
_RECENT = f"""{_WITH_R}, shown AS (
  SELECT seq, reason,
         CASE WHEN seq % 32 NOT IN (6, 7, 14, 18) THEN transaction_id END AS transaction_id,
         {_SHOWN.format("product_name")} AS product_name, {_SHOWN.format("product_brand")} AS product_brand,
         CASE WHEN seq % 32 NOT IN (6, 7, 13) THEN product_category END AS product_category,
         CASE WHEN seq % 32 NOT IN (6, 7, 12) THEN customer_id END AS customer_id,
         CASE WHEN seq % 32 NOT IN (6, 7, 24) THEN customer_country END AS customer_country,
         CASE WHEN seq % 32 = 4 THEN 0 WHEN seq % 32 NOT IN (6, 7, 16) THEN product_quantity END AS product_quantity,
         CASE WHEN seq % 32 = 4 THEN 0.0 WHEN seq % 32 NOT IN (6, 7) THEN product_price END AS product_price,
         {_SHOWN.format("payment_method")} AS payment_method,
         CASE WHEN seq % 32 NOT IN (6, 7, 23) THEN total_amount END AS total_amount,
         CASE WHEN seq % 32 IN (6, 7, 10, 17) THEN NULL WHEN seq % 32 = 22 THEN date_trunc('minute', transaction_date)
              ELSE transaction_date END AS transaction_date
  FROM r
)
SELECT seq, substr(transaction_id, 1, 8) || '...' AS short_id,
       CASE WHEN reason IS NULL THEN {_literal(text.SUCCESS_LABEL)} ELSE {_literal(text.FAILED_LABEL)} END AS status,
       strftime(transaction_date, '%H:%M:%S %-d/%-m/%Y') AS local_date,
       coalesce(product_name, '') || ' (' || coalesce(product_brand, '') || ')' AS product,
       {_CATEGORY} AS category_icon, customer_id, customer_country, product_quantity, product_price,
       {_PAYMENT} AS payment_label, total_amount
FROM shown ORDER BY seq DESC LIMIT 20"""
_KPI = f"""{_WITH_R}
SELECT count(*) AS total_transactions, count(*) FILTER (reason IS NULL) AS success_transactions,
       count(*) FILTER (reason IS NOT NULL) AS failed_transactions,
       CAST(sum(CAST(total_amount AS DECIMAL(18,2))) FILTER (reason IS NULL) AS DOUBLE) AS total_revenue
FROM r"""
_PER_DAY_AS_WRITTEN = f"""{_WITH_E}
SELECT CAST(ts AS DATE) AS transaction_date, CAST(arg_max(total, ts) AS DOUBLE) AS total_sales
FROM (SELECT transaction_date AS ts, sum(CAST(total_amount AS DECIMAL(18,2))) AS total
      FROM e GROUP BY transaction_date)
GROUP BY CAST(ts AS DATE)"""
_PER_CATEGORY_AS_WRITTEN = f"""WITH o AS ({_O}),
d AS (SELECT day, category, sum(amount) AS amount FROM o GROUP BY day, category)
SELECT day AS transaction_date, category,
       CAST(sum(amount) OVER (PARTITION BY category ORDER BY day) AS DOUBLE) AS total_sales
FROM d"""
_ACTION = """'{"index":{"_index":"transactions","_id":"' || transaction_id || '"}}'"""
_TOTAL = "CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"
_PIPELINE = f"""{_WITH_R}, g AS ({_ACCEPTED}), a AS ({_fraud("g", "seq")})
SELECT 'transactions' AS sink, count(*) AS n, {_TOTAL} AS total FROM g
UNION ALL SELECT 'sales_per_category',
  count(DISTINCT CAST(transaction_date AS DATE)::VARCHAR || product_category), {_TOTAL} FROM g
UNION ALL SELECT 'sales_per_day', count(DISTINCT CAST(transaction_date AS DATE)), {_TOTAL} FROM g
UNION ALL SELECT 'sales_per_month', count(DISTINCT date_trunc('month', transaction_date)), {_TOTAL} FROM g
UNION ALL SELECT 'rejects', count(*), NULL FROM r WHERE reason IS NOT NULL
UNION ALL SELECT 'alerts', count(*), CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) FROM a
UNION ALL SELECT 'documents', 2 * count(*), NULL FROM g"""

_ORACLES = {
    "sales_per_day": _PER_DAY,
    "sales_per_day_as_written": _PER_DAY_AS_WRITTEN,
    "sales_per_category": _PER_CATEGORY,
    "sales_per_category_as_written": _PER_CATEGORY_AS_WRITTEN,
    "sales_per_month": _PER_MONTH,
    "sales_per_month_as_written": _PER_MONTH_AS_WRITTEN,
    "running_category_totals": _running("product_category", "product_category"),
    "running_category_totals_cut": _running("product_category", "product_category"),
    "running_day_totals": _running("CAST(transaction_date AS DATE)", "day"),
    "running_month_totals": _running("CAST(month(transaction_date) AS INTEGER)", "month"),
    "fraud_alerts": _ALERTS,
    "fraud_alerts_out_of_order": f"""{_WITH_E},
p AS (SELECT * EXCLUDE (seq), seq + (seq * 7919) % 401 AS seq, seq AS seq_tie FROM e)
{_fraud('p', 'seq, seq_tie', 'seq, seq_tie')}""",
    "fraud_alerts_shared_customer": f"{_WITH_W} {_fraud('w', 'seq')}",
    "fraud_alert_text": f"""WITH a AS ({_ALERTS})
SELECT seq, printf({_literal(text.ALERT_TEMPLATE)}, {_ALERT_ARGUMENTS}) AS alert FROM a""",
    "transactions_view": f"""{_WITH_E}
SELECT transaction_id, customer_id, customer_country, total_amount, transaction_date,
       transaction_date AS event_time FROM e""",
    "derived_amount": f"""{_WITH_E}
SELECT transaction_id, product_price * product_quantity AS raw_amount, total_amount FROM e""",
    "sink_columns": f"{_WITH_E} SELECT * EXCLUDE (customer_country, seq) FROM e",
    "transaction_text": f"""{_WITH_E}
SELECT transaction_id, 'Transaction{{transactionId=''' || transaction_id || ''', productId='''
       || product_id || ''', productName=''' || product_name || ''', totalAmount='
       || {_DOUBLE_TEXT.format("total_amount")} || '}}' AS text FROM e""",
    "enrich_product": f"""{_WITH_E}
SELECT e.transaction_id, e.product_name, p.product_name AS catalog_name,
       p.product_category AS catalog_category, p.product_brand AS catalog_brand,
       CAST(p.low AS INTEGER) AS catalog_low, CAST(p.high AS INTEGER) AS catalog_high,
       p.currency AS catalog_currency, p.payment_method AS catalog_payment
FROM e LEFT JOIN products p USING (product_id)""",
    "enrich_country": f"""{_WITH_W}
SELECT transaction_id, w.customer_country, flag, location
FROM w LEFT JOIN countries c ON w.customer_country = c.customer_country""",
    "customer_countries": f"{_WITH_W} SELECT transaction_id, customer_id, customer_country FROM w",
    "display_labels": f"""{_WITH_E}
SELECT transaction_id, {_PAYMENT} AS payment_label, {_CATEGORY} AS category_icon,
       {_PRODUCT} AS product_icon FROM e""",
    "parse_transactions": f"{_WITH_R} {_ACCEPTED}",
    "stream_parse": f"{_WITH_R} {_ACCEPTED}",
    "rejected_transactions": f"{_WITH_R} SELECT seq, reason FROM r WHERE reason IS NOT NULL",
    "transaction_documents": f"{_WITH_E} SELECT transaction_id AS doc_id, {_DOCUMENT} AS body FROM e",
    "bulk_lines": f"""{_WITH_E}
SELECT '{{"index":{{"_index":"transactions","_id":"' || transaction_id || '"}}}}' || chr(10)
       || {_DOCUMENT} AS value FROM e""",
    "keyed_messages": f"{_WITH_E} SELECT transaction_id AS key, {_MESSAGE} AS value FROM e",
    "kpi_summary": _KPI,
    "message_status": f"""{_WITH_R}
SELECT seq, CASE WHEN reason IS NULL THEN {_literal(text.SUCCESS_LABEL)}
            ELSE {_literal(text.FAILED_LABEL)} END AS status FROM r""",
    "recent_transactions": _RECENT,
    "latest_transactions": _LATEST,
    "stream_sales_per_day": _PER_DAY,
    "stream_sales_per_day_late": _PER_DAY,
    "stream_sales_per_month_late": f"""WITH {_DIMS}, e AS ({_E})
        SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
               CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
        FROM e GROUP BY ALL""",
    "connection_tables": _PER_MONTH,
    "stream_running_totals": _running("product_category", "product_category"),
    "stream_running_day_totals": _running("CAST(transaction_date AS DATE)", "day"),
    "stream_progress": f"""{_WITH_R}
        SELECT count(*) AS messages, count(reason) AS rejected FROM r""",
    "bulk_delivery": f"""WITH {_DIMS}, e AS ({_E})
        SELECT transaction_id AS doc_id, CASE WHEN product_quantity = 7 THEN 'refused' ELSE 'arrived' END AS outcome
        FROM e""",
    "stream_sales_per_category": _PER_CATEGORY,
    "stream_sales_per_month": _PER_MONTH,
    "stream_sales_per_month_as_written": _PER_MONTH_AS_WRITTEN,
    "stream_fraud_alerts": _ALERTS,
    "stream_latest_transactions": _LATEST,
    "stream_sales_per_day_as_written": _PER_DAY_AS_WRITTEN,
    "stream_sales_per_category_as_written": _PER_CATEGORY_AS_WRITTEN,
    "stream_alert_text": f"""WITH a AS ({_ALERTS}),
t AS (SELECT printf({_literal(text.ALERT_TEMPLATE)}, {_ALERT_ARGUMENTS}) AS alert FROM a)
SELECT unnest(string_split(alert, chr(10))) AS value FROM t""",
    "stream_raw_transactions": f"""{_WITH_R}, g AS ({_ACCEPTED})
SELECT * EXCLUDE (customer_country, seq) FROM g""",
    "stream_rejects": f"{_WITH_R} SELECT seq, reason FROM r WHERE reason IS NOT NULL",
    "stream_bulk_lines": f"""{_WITH_R}, g AS ({_ACCEPTED})
SELECT {_ACTION} AS value FROM g UNION ALL
SELECT {_document_of_accepted()} FROM g""",
    "stream_kpi_summary": _KPI,
    "stream_recent_transactions": _RECENT,
    "stream_pipeline": _PIPELINE,
}


def registry() -> dict[str, str]:
    return dict(_ORACLES)
