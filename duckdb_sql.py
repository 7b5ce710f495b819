"""Equivalent DuckDB SQL for the named queries, for side-by-side comparison.

Money is DOUBLE, counts are BIGINT, dates and timestamps are text on both sides.
"""

from __future__ import annotations

import hashlib

AS_OF = "TIMESTAMP '2026-06-01 00:00:00'"

RAW = r"""
joined AS (
  SELECT orders.*, c_mktsegment, o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey
),
base AS (
  SELECT
    k AS raw_row_id,
    CASE WHEN k % 211 = 7 THEN NULL WHEN k % 13 = 5 THEN 'T' || (k - 1) ELSE ' T' || k END AS transaction_id,
    CASE
      WHEN k % 307 = 7 THEN NULL
      WHEN k % 311 = 7 THEN '2026-13-01 99:99'
      WHEN k % 313 = 7 THEN '2019-06-01 00:00:00'
      WHEN k % 317 = 7 THEN '2026-02-30 10:00:00'
      ELSE strftime(o_orderdate + INTERVAL 25 YEAR + to_hours(k % 24), '%Y-%m-%d %H:%M:%S')
    END AS order_timestamp,
    CASE
      WHEN k % 199 = 7 THEN '  '
      WHEN o_orderpriority = '1-URGENT' THEN 'web'
      WHEN o_orderpriority = '2-HIGH' THEN ' Website'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'APP'
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Partner'
      ELSE 'mobile app '
    END AS channel,
    CASE WHEN k % 283 <> 7 THEN c_mktsegment END AS product_category,
    CASE WHEN k % 197 = 7 THEN 'two' WHEN k % 193 = 7 THEN '0' ELSE CAST(1 + k % 5 AS VARCHAR) END AS quantity,
    CASE
      WHEN k % 101 = 7 THEN NULL
      WHEN k % 499 = 7 THEN '0'
      WHEN k % 503 = 7 THEN '-12.50'
      ELSE CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS VARCHAR)
    END AS amount,
    CASE
      WHEN k % 401 = 7 THEN ''
      WHEN k % 4 = 0 THEN 'card'
      WHEN k % 4 = 1 THEN 'bank_transfer'
      ELSE 'wallet'
    END AS payment_method,
    CASE WHEN k % 409 <> 7 THEN 'C' || o_custkey END AS customer_id,
    CASE
      WHEN k % 419 = 7 THEN 'pending'
      WHEN k % 421 = 7 THEN NULL
      WHEN o_orderstatus = 'F' THEN 'Completed'
      WHEN o_orderstatus = 'O' THEN 'completed'
      WHEN k % 2 = 0 THEN 'refunded'
      ELSE 'failed'
    END AS status
  FROM joined
),
raw AS (
  SELECT * FROM base
  UNION ALL
  SELECT * REPLACE (raw_row_id + 1000000000000 AS raw_row_id) FROM base WHERE raw_row_id % 125 = 0
)"""

CLEANED = r"""
cleaned AS (
  SELECT
    raw_row_id,
    nullif(trim(transaction_id), '') AS tid,
    CASE WHEN regexp_full_match(trim(order_timestamp),
           '(19|20)\d\d-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]) ([01]\d|2[0-3]):[0-5]\d:[0-5]\d')
         THEN try_cast(trim(order_timestamp) AS TIMESTAMP) END AS ts,
    CASE lower(trim(channel))
      WHEN 'web' THEN 'Web' WHEN 'website' THEN 'Web'
      WHEN 'mobile app' THEN 'Mobile App' WHEN 'app' THEN 'Mobile App'
      WHEN 'partner' THEN 'Partner Marketplace'
    END AS chan,
    upper(trim(product_category)[1]) || lower(trim(product_category)[2:]) AS cat,
    CASE WHEN regexp_full_match(trim(quantity), '-?\d+') THEN try_cast(trim(quantity) AS INTEGER) END AS qty,
    CASE WHEN regexp_full_match(trim(amount), '-?\d+(\.\d+)?') THEN try_cast(trim(amount) AS DECIMAL(14, 2)) END AS amt,
    nullif(trim(payment_method), '') AS pay,
    nullif(trim(customer_id), '') AS cust,
    lower(nullif(trim(status), '')) AS stat,
    transaction_id, order_timestamp, channel, product_category, quantity, amount, payment_method, status
  FROM raw
)"""

CHECKED = f"""
checked AS (
  SELECT *, concat_ws('; ',
    CASE WHEN tid IS NULL THEN 'missing transaction_id' END,
    CASE WHEN ts IS NULL THEN 'missing or malformed timestamp' END,
    CASE WHEN ts NOT BETWEEN TIMESTAMP '2020-01-01' AND {AS_OF} + INTERVAL 1 DAY
         THEN 'timestamp outside expected range' END,
    CASE WHEN chan IS NULL THEN 'missing channel' END,
    CASE WHEN cat IS NULL THEN 'missing product_category' END,
    CASE WHEN qty IS NULL THEN 'quantity not numeric' END,
    CASE WHEN qty <= 0 THEN 'quantity is zero or negative' END,
    CASE WHEN amt IS NULL THEN 'amount missing or not numeric' END,
    CASE WHEN amt <= 0 THEN 'amount is zero or negative' END,
    CASE WHEN pay IS NULL THEN 'missing payment_method' END,
    CASE WHEN cust IS NULL THEN 'missing customer_id' END,
    CASE WHEN stat NOT IN ('completed', 'refunded', 'failed') THEN 'unknown status' END) AS reason
  FROM cleaned
)"""

UNIQUE = """
uniq AS (
  SELECT min(raw_row_id) AS raw_row_id, count(*) AS copies, transaction_id, order_timestamp, channel,
         product_category, quantity, amount, payment_method, cust AS customer_id, status, reason, stat
  FROM checked GROUP BY ALL
),
bad AS (SELECT * FROM uniq WHERE reason <> '')"""

LATEST = """
latest AS (
  SELECT * FROM checked WHERE reason = '' AND stat IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY tid ORDER BY ts DESC, raw_row_id DESC) = 1
)"""

MODEL = f"""
span AS (
  SELECT min(ts::DATE) AS lo, max(ts::DATE) AS hi FROM cleaned
  WHERE ts BETWEEN TIMESTAMP '2020-01-01' AND {AS_OF} + INTERVAL 1 DAY
),
days AS (
  SELECT
    strftime(d, '%Y%m%d')::BIGINT AS date_key, d::DATE AS day, date_trunc('week', d)::DATE AS week,
    date_trunc('month', d)::DATE AS mon, year(d) AS yr, quarter(d) AS qtr, month(d) AS mth,
    weekofyear(d) AS wk, isodow(d) AS dow, dayname(d) AS day_name
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM span)
),
channels AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT chan AS name FROM latest)),
categories AS (
  SELECT row_number() OVER (ORDER BY name) AS id, name
  FROM (SELECT DISTINCT cat AS name FROM cleaned WHERE cat IS NOT NULL)),
payments AS (
  SELECT row_number() OVER (ORDER BY name) AS id, name
  FROM (SELECT DISTINCT pay AS name FROM cleaned WHERE pay IS NOT NULL)),
statuses AS (SELECT * FROM (VALUES (1, 'completed'), (2, 'refunded'), (3, 'failed')) AS t(id, name)),
sales AS (SELECT latest.*, stat = 'completed' AS done, day, week, mon, dow, day_name
          FROM latest JOIN days ON days.day = ts::DATE)"""

CTES = [RAW, CLEANED, CHECKED, UNIQUE, LATEST, MODEL]

NINE = "transaction_id, order_timestamp, channel, product_category, quantity, amount, payment_method, customer_id, status"

DONE = """
  count(*) FILTER (WHERE done) AS completed_transactions,
  CAST(sum(qty) FILTER (WHERE done) AS BIGINT) AS completed_units,
  CAST(sum(amt) FILTER (WHERE done) AS DOUBLE) AS completed_value"""

# Average rounded half up in whole cents: division of doubles would miss exact halves.
AOV = """CAST((2 * CAST(sum(amt * 100) FILTER (WHERE done) AS HUGEINT) + count(*) FILTER (WHERE done))
  // nullif(2 * count(*) FILTER (WHERE done), 0) AS DOUBLE) / 100"""

WEEKLY = f"weekly AS (SELECT week AS week_start, {DONE} FROM sales GROUP BY week)"

CLEAN_ROWS = """
SELECT raw_row_id, tid AS transaction_id, CAST(ts AS VARCHAR) AS order_ts, chan AS channel_clean,
       cat AS product_category_clean, pay AS payment_method_clean, stat AS status_clean,
       cust AS customer_id, CAST(qty AS BIGINT) AS quantity_int, CAST(amt AS DOUBLE) AS amount_num"""

DATE_COLUMNS = """
  CAST(day AS VARCHAR) AS date_actual, CAST(week AS VARCHAR) AS week_start, CAST(mon AS VARCHAR) AS month_start,
  yr AS year_num, qtr AS quarter_num, mth AS month_num, wk AS week_num, dow AS day_of_week_num,
  day_name, dow IN (6, 7) AS is_weekend"""


def _after(last: str, select: str, *more: str) -> str:
    """A query over the shared CTEs up to and including ``last``."""
    needed = CTES[: CTES.index(last) + 1]
    return "WITH" + ",".join([*needed, *(f"\n{cte}" for cte in more)]) + "\n" + select


def _mix(name: str, column: str) -> str:
    return _after(
        MODEL,
        f"""SELECT {column} AS {name}, completed_transactions, completed_units, completed_value,
  round(100.0 * completed_value / nullif(sum(completed_value) OVER (), 0), 2) AS value_share_pct
FROM groups""",
        f"groups AS (SELECT {column}, {DONE} FROM sales GROUP BY {column})",
    )


def _monitor(period: str) -> str:
    return _after(
        MODEL,
        """SELECT CAST(period AS VARCHAR) AS period, transactions, completed_value, avg_order_value,
  refund_rate_pct, failed_rate_pct,
  round(100.0 * (completed_value - lag(completed_value) OVER w) / nullif(lag(completed_value) OVER w, 0), 2)
    AS value_change_pct,
  round(100.0 * (avg_order_value - lag(avg_order_value) OVER w) / nullif(lag(avg_order_value) OVER w, 0), 2)
    AS order_value_change_pct,
  round(refund_rate_pct - lag(refund_rate_pct) OVER w, 2) AS refund_rate_change,
  round(failed_rate_pct - lag(failed_rate_pct) OVER w, 2) AS failed_rate_change
FROM per WINDOW w AS (ORDER BY period)""",
        f"""per AS (
  SELECT {period} AS period, count(*) AS transactions,
    CAST(sum(amt) FILTER (WHERE done) AS DOUBLE) AS completed_value, {AOV} AS avg_order_value,
    round(100.0 * count(*) FILTER (WHERE stat = 'refunded') / count(*), 2) AS refund_rate_pct,
    round(100.0 * count(*) FILTER (WHERE stat = 'failed') / count(*), 2) AS failed_rate_pct
  FROM sales GROUP BY {period})""",
    )


def _weekly_share(name: str, column: str) -> str:
    return _after(
        MODEL,
        f"""SELECT *, round(value_share_pct - lag(value_share_pct) OVER (PARTITION BY {name} ORDER BY week_start), 2)
  AS share_change
FROM (SELECT CAST(week AS VARCHAR) AS week_start, {column} AS {name}, v AS completed_value,
  round(100.0 * v / nullif(sum(v) OVER (PARTITION BY week), 0), 2) AS value_share_pct
FROM groups)""",
        f"groups AS (SELECT week, {column}, CAST(sum(amt) FILTER (WHERE done) AS DOUBLE) AS v "
        f"FROM sales GROUP BY week, {column})",
    )


def _named(table: str, entity: str) -> str:
    return _after(MODEL, f"SELECT id AS {entity}_key, name AS {entity}_name FROM {table}")


_MISSING = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA',
  'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""


def _present(table: str) -> str:
    """A table's source columns with missing-value texts as NULL."""
    columns = ", ".join(f"CASE WHEN {c} NOT IN {_MISSING} THEN {c} END AS {c}" for c in NINE.split(", "))
    return f"(SELECT {columns} FROM {table})"


def _shares(attribute: str, value: str) -> str:
    return (
        f"SELECT '{attribute}' AS attribute, CAST({value} AS VARCHAR) AS value, "
        f"count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share "
        f"FROM {_present('raw')} WHERE {value} IS NOT NULL GROUP BY {value}"
    )


_TITLE = "upper(product_category[1]) || lower(product_category[2:])"
_WHOLE = "CAST(trunc(try_cast(quantity AS DOUBLE)) AS BIGINT)"
_COPIES = "(SELECT CAST(sum(floor(least(250000, n - first) * 0.008)) AS BIGINT) FROM (SELECT n, unnest(range(0, n, 250000)) AS first FROM size))"
_SIZE = "size AS (SELECT count(*) AS n FROM raw)"
_FITTED = f"""
fitted AS (
  SELECT category AS product_category, round(avg(l), 6) AS log_mean,
         round(coalesce(nullif(stddev_pop(l), 0), 0.25), 6) AS log_std
  FROM (SELECT {_TITLE} AS category, ln(greatest(try_cast(amount AS DOUBLE), 1)) AS l
        FROM {_present("raw")} WHERE product_category IS NOT NULL AND try_cast(amount AS DOUBLE) > 0)
  GROUP BY category)"""



def _number(salt: str) -> str:
    """A draw below 2^62 from the scattered columns b0 to b3."""
    halves = []
    for half, prime in enumerate((2147483647, 2147483629)):
        weights = _weights(salt, half, prime)
        halves.append("(" + " + ".join(f"b{at} * {weight}" for at, weight in enumerate(weights)) + f") % {prime}")
    return f"(({halves[0]}) * 2147483648 + ({halves[1]}))"


def _uniform(salt: str) -> str:
    return f"(CAST({_number(salt)} // 512 AS DOUBLE) / CAST(9007199254740992 AS DOUBLE))"


def _scattered(table: str, row: str) -> str:
    parts = ", ".join(f"CAST('0x' || substr(h, {1 + 7 * at}, 7) AS BIGINT) AS b{at}" for at in range(4))
    return f"(SELECT * EXCLUDE h, {parts} FROM (SELECT *, md5(CAST({row} AS VARCHAR)) AS h FROM {table}))"


def _hit(issue: str, rate: float) -> str:
    return f"{_uniform(f'issue/{issue}')} < CAST({rate} AS DOUBLE)"


def _broken(table: str, row: str) -> str:
    """A table's rows with issues injected."""
    return f"""(SELECT * REPLACE (CASE WHEN {_hit("negative_amount", 0.002)}
    THEN CAST(-abs(try_cast(amount AS DECIMAL(14, 2))) AS VARCHAR) ELSE amount END AS amount) FROM (
  SELECT * REPLACE (
    CASE WHEN {_hit("malformed_timestamp", 0.0015)} THEN '2026-13-01 99:99'
         WHEN NOT {_hit("null_timestamp", 0.0015)} THEN order_timestamp END AS order_timestamp,
    CASE WHEN NOT {_hit("null_channel", 0.005)} THEN channel END AS channel,
    CASE WHEN NOT {_hit("null_product", 0.0035)} THEN product_category END AS product_category,
    CASE WHEN {_hit("zero_amount", 0.002)} THEN '0' WHEN NOT {_hit("null_amount", 0.01)} THEN amount END AS amount)
  FROM {_scattered(table, row)}))"""


def _weights(salt: str, half: int, prime: int) -> list[int]:
    digest = hashlib.sha256(f"{salt}/42/{half}".encode()).digest()
    return [int.from_bytes(digest[8 * at : 8 * at + 8], "big") % (prime - 1) + 1 for at in range(4)]


_ROUNDS = ", ".join(
    str((at, *_weights(f"duplicate/{at}", 0, 2147483647), *_weights(f"duplicate/{at}", 1, 2147483629))) for at in range(80)
)
# Each round swaps a place with its mirror image around a random point, or not.
_PERMUTED = f"""(
  WITH RECURSIVE walk AS (
    SELECT CAST(0 AS INTEGER) AS round, first, size, pick AS spot, b0, b1, b2, b3 FROM {_scattered("picks", "first")}
    UNION ALL
    SELECT round + 1, first, size, CASE WHEN (greatest(spot, mirror) * w0 + b1 * w1 + b2 * w2 + b3 * w3) % 2147483629 % 2 = 1
      THEN mirror ELSE spot END, b0, b1, b2, b3
    FROM (
      SELECT walk.*, w0, w1, w2, w3,
        ((b0 * s0 + b1 * s1 + b2 * s2 + b3 * s3) % 2147483647 % size - spot + size) % size AS mirror
      FROM walk JOIN (VALUES {_ROUNDS}) AS k(step, s0, s1, s2, s3, w0, w1, w2, w3) ON k.step = walk.round))
  SELECT first, spot FROM walk WHERE round = 80)"""
_DRAWN = ("day", "product_category", "channel", "quantity", "payment_method", "status")
_LINES = {"channel": "channel", "product_category": _TITLE, "status": "lower(status)", "payment_method": "payment_method",
          "quantity": f"CAST({_WHOLE} AS VARCHAR)"}
_GENERATED = f"""
source AS (SELECT * FROM {_present("raw")}),
weighed AS (
  {" UNION ALL ".join(f"SELECT '{a}' AS attribute, {v} AS value, count(*) AS n FROM source WHERE {v} IS NOT NULL GROUP BY {v}" for a, v in _LINES.items())}
  UNION ALL SELECT 'day', CAST(CAST(d AS DATE) AS VARCHAR), (CASE WHEN isodow(d) >= 6 THEN 125 ELSE 100 END)
    * (CASE WHEN month(d) IN (11, 12) THEN 125 ELSE 100 END)
    * (CASE WHEN month(d) = 4 AND day(d) BETWEEN 15 AND 25 THEN 170 ELSE 100 END)
  FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS d)),
placed AS (
  SELECT attribute, value, CAST(sum(n) OVER (PARTITION BY attribute ORDER BY value) AS BIGINT) AS high, n FROM weighed),
totals AS (SELECT attribute, CAST(sum(n) AS BIGINT) AS total FROM weighed GROUP BY attribute),
fit AS (
  SELECT category, avg(l) AS log_mean, coalesce(nullif(stddev_pop(l), 0), 0.25) AS log_std
  FROM (SELECT {_TITLE} AS category, ln(greatest(try_cast(amount AS DOUBLE), 1)) AS l
        FROM source WHERE product_category IS NOT NULL AND try_cast(amount AS DOUBLE) > 0)
  GROUP BY category),
pool AS (SELECT greatest(max(try_cast(replace(customer_id, 'C', '') AS BIGINT)) * 20, 50000) AS pool FROM source),
chunks AS (
  SELECT first, least(250000, n - first) AS size, CAST(floor(least(250000, n - first) * 0.008) AS BIGINT) AS copies
  FROM (SELECT n, unnest(range(0, n, 250000)) AS first FROM size)),
picks AS (SELECT *, unnest(range(copies)) AS pick FROM chunks),
ids AS (
  SELECT unnest(range(n)) AS r FROM size
  UNION ALL SELECT first + spot FROM {_PERMUTED}),
numbers AS (
  SELECT r, {", ".join(f"{_number(a)} % (SELECT total FROM totals WHERE attribute = '{a}') AS n_{a}" for a in _DRAWN)},
    {_number("second")} % 86400 AS second, {_number("customer")} % (SELECT pool FROM pool) + 1 AS customer,
    sqrt(-2 * ln(1 - {_uniform("amount/radius")})) * cos(2 * pi() * {_uniform("amount/angle")}) AS z
  FROM {_scattered("ids", "r")}),
made AS (
  SELECT r, 'SYN' || (1000000 + r) AS transaction_id,
    strftime(CAST(day.value AS TIMESTAMP) + to_seconds(second), '%Y-%m-%d %H:%M:%S') AS order_timestamp,
    channel.value AS channel, product_category.value AS product_category, quantity.value AS quantity,
    CAST(CAST(exp(coalesce(log_mean, 4.0) + coalesce(log_std, 0.5) * z) AS DECIMAL(14, 2)) AS VARCHAR) AS amount,
    payment_method.value AS payment_method, 'C' || customer AS customer_id, status.value AS status
  FROM numbers
  {" ".join(f"JOIN placed AS {a} ON {a}.attribute = '{a}' AND n_{a} >= {a}.high - {a}.n AND n_{a} < {a}.high" for a in _DRAWN)}
  LEFT JOIN fit ON fit.category = product_category.value),
synthetic AS (SELECT {NINE} FROM {_broken("made", "r")})"""


def _both_shares(attribute: str, value: str) -> str:
    ours = _shares(attribute, value)
    theirs = ours.replace("FROM raw)", "FROM synthetic)")
    return f"""SELECT '{attribute}' AS attribute, coalesce(a.value, b.value) AS value, coalesce(a.share, 0) AS source_share,
  coalesce(b.share, 0) AS synthetic_share FROM ({ours}) a FULL JOIN ({theirs}) b ON a.value = b.value"""


_CHECKS = [
    "duplicate fact.transaction_id", "duplicate dim_date.date_key", "duplicate dim_date.date_actual",
    *[f"duplicate dim_{e}.{e}_{part}" for e in ("channel", "product_category", "payment_method", "status")
      for part in ("key", "name")],
    *[f"orphan fact.{key}_key" for key in ("date", "channel", "product_category", "payment_method", "status")],
    *[f"null fact.{name}" for name in
      ("transaction_id", "order_timestamp", "date_key", "channel_key", "product_category_key", "payment_method_key",
       "status_key", "customer_id", "quantity", "amount", "is_value_eligible", "loaded_at")],
    *[f"null dim_date.{name}" for name in
      ("date_key", "date_actual", "week_start", "month_start", "year_num", "quarter_num", "month_num", "week_num",
       "day_of_week_num", "day_name", "is_weekend")],
]

ORACLE: dict[str, str] = {
    "raw_transactions": _after(RAW, "SELECT * FROM raw"),
    "csv_round_trip": _after(RAW, f"SELECT {NINE} FROM raw"),
    "csv_round_trip_multiline": _after(
        RAW, f"SELECT {NINE.replace('customer_id', 'customer_id || chr(10) || status AS customer_id')} FROM raw"
    ),
    "profiling_read": _after(RAW, f"SELECT * FROM {_present('raw')}"),
    "landed_ids": _after(
        RAW, f"SELECT row_number() OVER (ORDER BY raw_row_id % 50 <> 0, raw_row_id) - 1 AS raw_row_id, {NINE} FROM raw"
    ),
    "load_stamps": _after(
        MODEL,
        f"""SELECT table_name, strftime({AS_OF}, '%Y-%m-%d %H:%M:%S') AS stamp, row_count FROM (
  SELECT 'raw' AS table_name, count(*) AS row_count FROM raw UNION ALL SELECT 'fact', count(*) FROM sales
  UNION ALL SELECT 'quarantine', count(*) FROM bad)""",
    ),
    "violations_found": _after(
        MODEL,
        """SELECT * FROM (
  SELECT 'duplicate fact.transaction_id' AS check_name, count(*) FILTER (WHERE k % 11 = 0) AS violations FROM numbered
  UNION ALL SELECT 'orphan fact.channel_key', count(DISTINCT chan) FILTER (WHERE chan = 'Web') FROM numbered
  UNION ALL SELECT 'orphan fact.payment_method_key', count(DISTINCT pay) FILTER (WHERE pay = 'card') FROM numbered
  UNION ALL SELECT 'null fact.amount', sum(CASE WHEN k % 9 = 0 THEN 1 + (k % 11 = 0)::INT ELSE 0 END)::BIGINT FROM numbered)
WHERE violations > 0""",
        "numbered AS (SELECT *, CAST(substr(tid, 2) AS BIGINT) AS k FROM sales)",
    ),
    "published_fact": _after(
        MODEL,
        "SELECT tid AS transaction_id, CAST(ts AS VARCHAR) AS order_timestamp, CAST(amt AS DOUBLE) AS amount, "
        "done AS is_value_eligible FROM sales",
    ),
    "exported_reports": _mix("channel_name", "chan"),
    "incremental_fact": _after(
        MODEL,
        """SELECT tid AS transaction_id, CAST(day AS VARCHAR) AS date_actual, chan AS channel_name,
  cat AS product_category_name, pay AS payment_method_name, stat AS status_name, cust AS customer_id,
  CAST(qty AS BIGINT) AS quantity, CAST(amt AS DOUBLE) AS amount FROM sales""",
    ),
    "second_source": _after(
        RAW,
        f"""SELECT concat_ws('-', 'L', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS transaction_id,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS order_timestamp, 'Partner' AS channel,
  l_returnflag AS product_category, CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS VARCHAR) AS amount, NULL AS payment_method, NULL AS customer_id,
  CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'failed' END AS status
FROM lineitem UNION ALL SELECT {NINE} FROM raw""",
    ),
    "blank_to_null": _after(
        CLEANED, "SELECT raw_row_id, tid AS transaction_id, pay AS payment_method, cust AS customer_id FROM cleaned"
    ),
    "normalize_channel": _after(CLEANED, "SELECT raw_row_id, chan AS channel_clean FROM cleaned"),
    "title_case": r"""
SELECT o_orderkey, nullif(array_to_string(list_transform(
  regexp_extract_all(trim(o_orderpriority), '([\p{L}\p{N}]+|[^\p{L}\p{N}]+)'),
  lambda w: upper(w[1]) || lower(w[2:])), ''), '') AS title FROM orders""",
    "parse_numbers": _after(
        CLEANED,
        "SELECT raw_row_id, CAST(qty AS BIGINT) AS quantity_int, CAST(amt AS DOUBLE) AS amount_num FROM cleaned",
    ),
    "parse_timestamps": _after(
        CLEANED,
        "SELECT raw_row_id, CAST(ts AS VARCHAR) AS order_ts, strftime(ts, '%Y%m%d')::BIGINT AS date_key FROM cleaned",
    ),
    "normalize_status": _after(
        CLEANED, "SELECT raw_row_id, stat AS status_clean, stat = 'completed' AS is_value_eligible FROM cleaned"
    ),
    "invalid_reasons": _after(CHECKED, "SELECT raw_row_id, reason AS invalid_reason FROM checked"),
    "strict_reasons": _after(
        CHECKED,
        """SELECT CASE WHEN stat IS NULL AND reason = '' THEN 'missing status'
            WHEN stat IS NULL THEN reason || '; missing status' ELSE reason END AS invalid_reason,
  count(*) AS row_count FROM checked GROUP BY 1""",
    ),
    "valid_rows": _after(CHECKED, CLEAN_ROWS + " FROM checked WHERE reason = '' AND stat IS NOT NULL"),
    "quarantine": _after(
        UNIQUE, f"SELECT raw_row_id AS quarantine_id, raw_row_id, {NINE}, reason AS invalid_reason FROM bad"
    ),
    "quarantine_reasons": _after(
        UNIQUE,
        "SELECT r AS reason, count(*) AS quarantined_rows "
        "FROM (SELECT unnest(string_split(reason, '; ')) AS r FROM bad) GROUP BY r",
    ),
    "dedup_exact": _after(
        UNIQUE,
        "SELECT transaction_id AS transaction_id_raw, order_timestamp, channel, product_category, quantity, amount, "
        "payment_method, customer_id, status, raw_row_id, copies FROM uniq",
    ),
    "dedup_latest": _after(LATEST, CLEAN_ROWS + " FROM latest"),
    "dim_date": _after(MODEL, f"SELECT date_key, {DATE_COLUMNS} FROM days"),
    "dim_channel": _named("channels", "channel"),
    "dim_product_category": _named("categories", "product_category"),
    "dim_payment_method": _named("payments", "payment_method"),
    "dim_status": _after(
        MODEL,
        "SELECT CAST(id AS BIGINT) AS status_key, name AS status_name, count(stat) AS fact_rows "
        "FROM statuses LEFT JOIN sales ON stat = name GROUP BY ALL",
    ),
    "merge_dim": _after(
        MODEL,
        """SELECT id AS channel_key, name AS channel_name FROM channels WHERE name = 'Web'
UNION ALL SELECT (SELECT id FROM channels WHERE name = 'Web') + row_number() OVER (ORDER BY name), name
FROM (SELECT DISTINCT chan AS name FROM cleaned WHERE chan <> 'Web')""",
    ),
    "fact": _after(
        MODEL,
        """SELECT tid AS transaction_id, CAST(ts AS VARCHAR) AS order_timestamp,
  strftime(ts, '%Y%m%d')::BIGINT AS date_key, channels.id AS channel_key, categories.id AS product_category_key,
  payments.id AS payment_method_key, CAST(statuses.id AS BIGINT) AS status_key, cust AS customer_id,
  CAST(qty AS BIGINT) AS quantity, CAST(amt AS DOUBLE) AS amount, done AS is_value_eligible,
  CAST(mon AS VARCHAR) AS month_start
FROM sales JOIN channels ON chan = channels.name JOIN categories ON cat = categories.name
JOIN payments ON pay = payments.name JOIN statuses ON stat = statuses.name""",
    ),
    "violations": "SELECT check_name, CAST(0 AS BIGINT) AS violations FROM (VALUES "
    + ", ".join(f"('{check}')" for check in _CHECKS)
    + ") AS t(check_name)",
    "orphan_keys": """SELECT o_custkey AS c_custkey, count(*) AS fact_rows FROM orders
WHERE o_custkey % 7 = 0 GROUP BY o_custkey""",
    "duplicate_keys": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS occurrences "
    "FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "null_violations": _after(
        RAW,
        " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_rows FROM raw"
            for name in NINE.split(", ")
        ),
    ),
    "load_counts": _after(
        LATEST,
        """SELECT 'raw_rows' AS metric, (SELECT count(*) FROM raw) AS row_count
UNION ALL SELECT 'fact_rows', (SELECT count(*) FROM latest)
UNION ALL SELECT 'quarantined_rows', (SELECT count(*) FROM bad)""",
    ),
    "dq_summary": _after(
        LATEST,
        """SELECT 'raw_rows' AS metric, CAST((SELECT count(*) FROM raw) AS DOUBLE) AS value
UNION ALL SELECT 'exact_duplicate_rows_removed', (SELECT count(*) FROM raw) - (SELECT count(*) FROM uniq)
UNION ALL SELECT 'invalid_or_quarantined_rows_after_exact_dedup', (SELECT count(*) FROM bad)
UNION ALL SELECT 'clean_modeled_transactions', (SELECT count(*) FROM latest)
UNION ALL SELECT 'completed_transactions_used_for_value', (SELECT count(*) FROM latest WHERE stat = 'completed')
UNION ALL SELECT 'completed_value', (SELECT CAST(sum(amt) AS DOUBLE) FROM latest WHERE stat = 'completed')
UNION ALL SELECT 'completed_units', (SELECT sum(qty) FROM latest WHERE stat = 'completed')""",
    ),
    "row_accounting": _after(
        LATEST,
        """SELECT (SELECT count(*) FROM raw) AS raw_rows,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM uniq) AS exact_duplicate_rows,
  (SELECT count(*) FROM bad) AS quarantined_rows,
  (SELECT count(*) FROM uniq WHERE reason = '' AND stat IS NULL) AS rows_without_status,
  (SELECT count(*) FROM uniq WHERE reason = '' AND stat IS NOT NULL) - (SELECT count(*) FROM latest)
    AS superseded_rows,
  (SELECT count(*) FROM latest) AS fact_rows""",
    ),
    "validate_raw": _after(
        RAW,
        f"""SELECT count(*) AS rows_including_duplicates, '{NINE}' AS "columns",
  count(*) - count(DISTINCT transaction_id) - max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END)
    AS duplicate_transaction_ids,
  count(*) - count(order_timestamp) AS null_timestamps, count(*) - count(channel) AS null_channels,
  count(*) - count(product_category) AS null_products, count(*) - count(amount) AS null_amounts,
  count(*) FILTER (WHERE try_cast(amount AS DOUBLE) = 0) AS zero_amounts,
  count(*) FILTER (WHERE try_cast(amount AS DOUBLE) < 0) AS negative_amounts FROM raw""",
    ),
    "totals": _after(
        MODEL,
        f"""SELECT count(*) FILTER (WHERE done) AS completed_transaction_volume,
  CAST(sum(qty) FILTER (WHERE done) AS BIGINT) AS completed_units,
  CAST(sum(amt) FILTER (WHERE done) AS DOUBLE) AS completed_transaction_value,
  {AOV} AS avg_completed_order_value FROM sales""",
    ),
    "executive_dashboard": _after(
        MODEL,
        f"""SELECT {DONE}, {AOV} AS avg_completed_order_value,
  round(100.0 * count(*) FILTER (WHERE NOT done) / nullif(count(*), 0), 2) AS non_completed_transaction_rate_pct
FROM sales""",
    ),
    "status_distribution": _after(
        MODEL,
        "SELECT stat AS status_name, count(*) AS transactions, "
        "CAST(sum(amt) AS DOUBLE) AS gross_amount_before_status_filter FROM sales GROUP BY stat",
    ),
    "weekly": _after(MODEL, f"SELECT CAST(week AS VARCHAR) AS week_start, {DONE} FROM sales GROUP BY week"),
    "monthly": _after(MODEL, f"SELECT CAST(mon AS VARCHAR) AS month_start, {DONE} FROM sales GROUP BY mon"),
    "weekly_growth": _after(
        MODEL,
        """SELECT CAST(week_start AS VARCHAR) AS week_start, completed_transactions, completed_units, completed_value,
  lag(completed_value) OVER w AS previous_week_value,
  round(100.0 * (completed_value - lag(completed_value) OVER w) / nullif(lag(completed_value) OVER w, 0), 2)
    AS wow_value_growth_pct
FROM weekly WINDOW w AS (ORDER BY week_start)""",
        WEEKLY,
    ),
    "weekly_anomaly": _after(
        MODEL,
        """SELECT CAST(week_start AS VARCHAR) AS week_start, completed_transactions, completed_value,
  round(100.0 * (completed_value / nullif(a, 0) - 1), 2) AS pct_vs_4wk_avg
FROM (SELECT *, avg(completed_value) OVER (ORDER BY week_start ROWS 3 PRECEDING) AS a FROM weekly)
WHERE a IS NOT NULL""",
        WEEKLY,
    ),
    "weekly_growth_report": _after(
        MODEL,
        """SELECT CAST(week_start AS VARCHAR) AS week_start, completed_transactions AS transactions,
  completed_value AS value, completed_units AS units,
  round(100.0 * (completed_value - p) / nullif(p, 0), 6) AS wow_value_growth_pct,
  round(a, 6) AS rolling_4wk_avg, round(100.0 * (completed_value / nullif(a, 0) - 1), 6) AS vs_4wk_avg_pct
FROM (SELECT *, lag(completed_value) OVER (ORDER BY week_start) AS p,
        CASE WHEN count(completed_value) OVER f >= 4 THEN avg(completed_value) OVER f END AS a
      FROM weekly WINDOW f AS (ORDER BY week_start ROWS 3 PRECEDING))""",
        WEEKLY,
    ),
    "channel_mix": _mix("channel_name", "chan"),
    "product_category_mix": _mix("product_category_name", "cat"),
    "day_of_week": _after(
        MODEL,
        """SELECT day_name, dow AS day_of_week_num, count(*) FILTER (WHERE done) AS completed_transactions,
  CAST(sum(amt) FILTER (WHERE done) AS DOUBLE) AS completed_value FROM sales GROUP BY day_name, dow""",
    ),
    "dashboard_extract": _after(
        MODEL,
        f"""SELECT tid AS transaction_id, CAST(ts AS VARCHAR) AS order_timestamp, {DATE_COLUMNS},
  chan AS channel_name, cat AS product_category_name, pay AS payment_method_name, stat AS status_name,
  cust AS customer_id, CAST(qty AS BIGINT) AS quantity, CAST(amt AS DOUBLE) AS amount,
  stat = 'completed' AS is_value_eligible
FROM latest JOIN days ON day = ts::DATE""",
    ),
    "filtered_extract": _after(
        MODEL,
        """SELECT chan AS channel_name, cat AS product_category_name, stat AS status_name, count(*) AS row_count,
  CAST(sum(amt) AS DOUBLE) AS gross_amount
FROM sales WHERE day BETWEEN DATE '2023-02-10' AND DATE '2025-09-20' AND chan IN ('Web', 'Mobile App')
  AND cat IN ('Machinery', 'Building', 'Furniture') AND stat IN ('completed', 'refunded') GROUP BY ALL""",
    ),
    "customer_extract": _after(
        MODEL,
        """SELECT tid AS transaction_id, CAST(day AS VARCHAR) AS date_actual, chan AS channel_name, stat AS status_name,
  cust AS customer_id, CAST(amt AS DOUBLE) AS amount
FROM sales WHERE day BETWEEN DATE '2021-03-15' AND DATE '2025-10-20' AND chan IN ('Web', 'Mobile App')
  AND stat IN ('completed', 'failed') AND cust IN ('C1', 'C2', 'C3', 'C4', 'C5', 'C6', 'C7', 'C8')""",
    ),
    "freshness": _after(
        MODEL,
        f"""SELECT count(*) AS row_count, CAST(max(ts) AS VARCHAR) AS latest_timestamp, count(*) >= 1 AS row_count_ok,
  max(ts) >= {AS_OF} - INTERVAL 24 HOUR AS is_fresh FROM sales""",
    ),
    "volume_baseline": _after(
        MODEL,
        """SELECT CAST(day AS VARCHAR) AS date_actual, row_count, seen AS days_seen, typical AS typical_rows,
  CASE WHEN typical IS NOT NULL THEN round(greatest(typical - 3 * spread, 0), 6) END AS expected_low, round(typical + 3 * spread, 6) AS expected_high,
  CASE WHEN row_count < greatest(typical - 3 * spread, 0) THEN 'low' WHEN row_count > typical + 3 * spread THEN 'high'
       WHEN typical IS NOT NULL THEN 'expected' ELSE 'no history' END AS volume
FROM (SELECT *, greatest(CAST(1.4826 AS DOUBLE) * deviation, sqrt(typical)) AS spread FROM (
  SELECT day, CAST(n AS BIGINT) AS row_count, count(*) OVER w AS seen,
    CASE WHEN count(*) OVER w >= 4 THEN median(n) OVER w END AS typical,
    CASE WHEN count(*) OVER w >= 4 THEN mad(n) OVER w END AS deviation
  FROM (SELECT days.day, dow, CAST(coalesce(n, 0) AS DOUBLE) AS n
        FROM days LEFT JOIN (SELECT day, count(*) AS n FROM sales GROUP BY day) s ON s.day = days.day)
  WINDOW w AS (PARTITION BY dow ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)))""",
    ),
    "daily_monitor": _monitor("day"),
    "weekly_monitor": _monitor("week"),
    "channel_share_by_week": _weekly_share("channel_name", "chan"),
    "category_share_by_week": _weekly_share("product_category_name", "cat"),
    "reconciliation": _after(
        MODEL,
        """SELECT CASE WHEN stat IS NULL THEN 'missing in mart' WHEN s.status IS NULL THEN 'missing in source'
    WHEN stat <> s.status THEN 'status differs' WHEN amt <> s.amount THEN 'amount differs' ELSE 'matched' END AS outcome,
  count(*) AS transactions
FROM latest FULL JOIN (
  SELECT 'T' || o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'refunded' ELSE 'completed' END AS status,
    CAST(o_totalprice AS DECIMAL(14, 2)) AS amount FROM orders) s ON tid = s.id
GROUP BY 1""",
    ),
    "value_shares": _after(
        RAW,
        " UNION ALL ".join(
            [
                _shares("channel", "channel"),
                _shares("product_category", _TITLE),
                _shares("status", "lower(status)"),
                _shares("payment_method", "payment_method"),
                _shares("quantity", _WHOLE),
            ]
        ),
    ),
    "top_categories": _after(
        RAW, f"SELECT value, share FROM ({_shares('', _TITLE)}) ORDER BY share DESC, value LIMIT 10"
    ),
    "top_quantities": _after(
        RAW,
        f"SELECT CAST(value AS BIGINT) AS value, share FROM ({_shares('', _WHOLE)}) "
        "ORDER BY CAST(value AS BIGINT) LIMIT 10",
    ),
    "fit_lognormal": _after(RAW, "SELECT * FROM fitted", _FITTED),
    "customer_pool": _after(
        RAW,
        """SELECT max(n) AS max_customer_num, greatest(max(n) * 20, 50000) AS customer_pool
FROM (SELECT try_cast(replace(customer_id, 'C', '') AS BIGINT) AS n FROM raw)""",
    ),
    "compare_distribution": _after(
        UNIQUE,
        """SELECT coalesce(a.value, b.value) AS value, coalesce(a.share, 0) AS source_share,
  coalesce(b.share, 0) AS synthetic_share FROM a FULL JOIN b ON a.value = b.value""",
        f"a AS ({_shares('', _TITLE)})",
        f"b AS ({_shares('', _TITLE).replace('FROM raw)', 'FROM bad)')})",
    ),
    "day_weights": _after(
        MODEL,
        """SELECT CAST(day AS VARCHAR) AS day, u AS weight_units, u / 1e6 AS weight,
  u / CAST(sum(u) OVER () AS DOUBLE) AS share
FROM (SELECT day, CAST((CASE WHEN dow >= 6 THEN 125 ELSE 100 END)
    * (CASE WHEN mth IN (11, 12) THEN 125 ELSE 100 END)
    * (CASE WHEN mth = 4 AND day(day) BETWEEN 15 AND 25 THEN 170 ELSE 100 END) AS BIGINT) AS u FROM days)""",
    ),
    "synth_ids": "SELECT n AS row_number, 'SYN' || (1000000 + n) AS transaction_id "
    "FROM (SELECT unnest(range(count(*))) AS n FROM orders)",
    "synth_copies": _after(
        RAW,
        f"SELECT n + {_COPIES} AS rows_including_duplicates, n AS distinct_rows, CAST(2 AS BIGINT) AS most_copies FROM size",
        _SIZE,
    ),
    "synth_transactions": _after(RAW, f"SELECT {NINE} FROM synthetic", _SIZE, _GENERATED),
    "synth_shares": _after(
        RAW,
        " UNION ALL ".join(_both_shares(a, _LINES[a]) for a in ("channel", "product_category", "status", "payment_method")),
        _SIZE,
        _GENERATED,
    ),
    "synth_amounts": _after(
        RAW,
        "SELECT a.product_category, a.log_mean, a.log_std, b.log_mean AS new_mean, b.log_std AS new_std "
        "FROM fitted a JOIN again b ON a.product_category = b.product_category",
        _SIZE,
        _GENERATED,
        _FITTED,
        _FITTED.replace("fitted AS", "again AS").replace("FROM raw)", "FROM synthetic)"),
    ),
    "inject_issues": _after(
        RAW, f"SELECT raw_row_id, order_timestamp, channel, product_category, amount FROM {_broken('raw', 'raw_row_id')}"
    ),
    "incremental_clean": _after(LATEST, CLEAN_ROWS + " FROM latest"),
    "streamed_clean": _after(LATEST, CLEAN_ROWS + " FROM latest"),
}

# Order lines of another system, modelled together with the rows of the first.
_BOTH = RAW.replace("\nraw AS (", "\nfirst_source AS (") + f""",
raw AS (
  SELECT * FROM first_source UNION ALL
  SELECT 2000000000000 + row_number() OVER () AS raw_row_id,
    concat_ws('-', 'L', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS transaction_id,
    strftime(l_shipdate + INTERVAL 25 YEAR, '%Y-%m-%d %H:%M:%S') AS order_timestamp, 'Partner' AS channel,
    l_returnflag AS product_category, CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS VARCHAR) AS amount, 'invoice' AS payment_method,
    'S' || l_suppkey AS customer_id, CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'failed' END AS status
  FROM lineitem)"""
for name, same in {"second_source_fact": "incremental_fact", "second_source_dq_summary": "dq_summary"}.items():
    ORACLE[name] = ORACLE[same].replace(RAW, _BOTH)

# Batches, stored totals and exports end where a full build does.
for name, same in {
    "exported_weekly": "weekly_growth_report",
    "exported_category_mix": "product_category_mix",
    "exported_dq_summary": "dq_summary",
    "incremental_accounting": "row_accounting",
    "incremental_dq_summary": "dq_summary",
    "incremental_quarantine": "quarantine",
    "streamed_fact": "incremental_fact",
    "stored_weekly": "weekly",
    "stored_monthly": "monthly",
    "stored_channel_mix": "channel_mix",
    "stored_category_mix": "product_category_mix",
}.items():
    ORACLE[name] = ORACLE[same]
