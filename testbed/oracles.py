"""The registered queries in DuckDB SQL, written apart from the Spark code.

Rounding goes through a decimal of the number's shortest text, which is what Spark's
``round`` does with a double.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"
YMD = "'20011231'"


def rnd(x: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,16)), {digits}) AS DOUBLE)"


def cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


SALES = """sales AS (
  SELECT l.*, p.p_brand AS ticker, p.p_type FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

BARS = f"""bars AS (
  SELECT ticker, price_date,
         CAST(first(c ORDER BY l_orderkey, l_linenumber, c) AS DOUBLE) AS vl_open,
         CAST(max(c) AS DOUBLE) AS vl_high, CAST(min(c) AS DOUBLE) AS vl_low,
         CAST(last(c ORDER BY l_orderkey, l_linenumber, c) AS DOUBLE) AS vl_close,
         sum(l_quantity) AS vl_volume, CAST(sum(tax) AS DOUBLE) AS vl_dividends
  FROM (SELECT *, CAST(l_shipdate AS DATE) AS price_date, {cents('l_extendedprice')} AS c,
               {cents('l_tax')} AS tax FROM sales)
  GROUP BY ticker, price_date)"""


def change(period: str, base: str, percent_base: str) -> list[str]:
    return [
        f"{rnd(f'vl_close - {base}', 2)} AS vl_change_{period}",
        f"{rnd(f'100 * {rnd(f'vl_close - {base}', 2)} / NULLIF({percent_base}, 0)', 2)} AS perc_change_{period}",
    ]


ZSCORE = "round((vl_close - avg(vl_close) OVER so_far) / NULLIF(stddev_samp(vl_close) OVER so_far, 0), 4) + 0.0 AS z_score"
CHANGE_DAY = change("day", "lag(vl_close, 1) OVER w", "lag(vl_close, 1) OVER w")
CHANGE_WEEK = change("week", "lag(vl_close, 5) OVER w", "lag(vl_close, 5) OVER w")
CHANGE_MONTH = change("month", "first_value(vl_close) OVER m", "lag(vl_close, 1) OVER m")
AVERAGES = [
    f"{rnd('avg(vl_close) OVER (PARTITION BY ticker ORDER BY price_date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)', 2)}"
    " AS vl_moving_avg_20_days",
    f"{rnd('avg(vl_close) OVER (PARTITION BY ticker ORDER BY price_date ROWS BETWEEN 200 PRECEDING AND CURRENT ROW)', 2)}"
    " AS vl_moving_avg_200_days",
]
WINDOWS = """
  WINDOW w AS (PARTITION BY ticker ORDER BY price_date),
         so_far AS (PARTITION BY ticker ORDER BY price_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         m AS (PARTITION BY ticker, date_trunc('month', price_date) ORDER BY price_date)"""
KPIS = "kpis AS (SELECT *, " + ", ".join([ZSCORE, *CHANGE_DAY, *CHANGE_WEEK, *CHANGE_MONTH, *AVERAGES]) + " FROM bars" + WINDOWS + ")"


def on_bars(columns: list[str], tail: str = "") -> str:
    return with_(SALES, BARS) + f"SELECT ticker, price_date, vl_close, {', '.join(columns)} FROM bars{WINDOWS}{tail}"


# The calendar, with day names spelled by DuckDB.
def attributes(d: str) -> dict[str, str]:
    quarter = f"CAST(quarter({d}) AS VARCHAR)"
    return {
        "dt_year": f"CAST(year({d}) AS INTEGER)",
        "dt_year_short": f"strftime({d}, '%y')",
        "dt_month": f"strftime({d}, '%m')",
        "dt_day": f"strftime({d}, '%d')",
        "dt_day_of_week": f"CAST(dayofweek({d}) + 1 AS INTEGER)",
        "dt_day_of_week_short": f"strftime({d}, '%a')",
        "dt_day_of_week_full": f"strftime({d}, '%A')",
        "dt_week_of_year": f"CAST(weekofyear({d}) AS INTEGER)",
        "dt_month_short": f"strftime({d}, '%b')",
        "dt_month_full": f"strftime({d}, '%B')",
        "dt_first_day_of_month": "CAST(1 AS INTEGER)",
        "dt_last_day_of_month": f"CAST(day(last_day({d})) AS INTEGER)",
        "dt_quarter": quarter,
        "dt_quarter_short": f"'0' || {quarter}",
        "dt_quarter_long": f"'Q' || {quarter} || '.' || strftime({d}, '%y')",
        "dt_semester": f"CAST(CASE WHEN month({d}) <= 6 THEN 1 ELSE 2 END AS INTEGER)",
        "dt_semester_desc": f"CASE WHEN month({d}) <= 6 THEN '1st Semester' ELSE '2nd Semester' END",
        "dt_full_date": f"strftime({d}, '%a %d, %b ''%y')",
        "dt_is_weekend": f"CASE WHEN dayofweek({d}) IN (0, 6) THEN 'Yes' ELSE 'No' END",
        "dt_is_hollyday": f"CASE WHEN strftime({d}, '%m-%d') IN ('01-01', '05-01', '09-07', '10-12', '11-02', "
        "'11-15', '12-25') THEN 'Yes' ELSE 'No' END",
    }


def listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


CALENDAR = f"""calendar AS (
  SELECT dt_date, {listed(attributes('dt_date'))}
  FROM (SELECT CAST(unnest(generate_series(date_trunc('year', (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)),
               CAST({AS_OF} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dt_date))"""


# Statements: the long form directly, without the wide one.
def statement(kind: str) -> str:
    whole, part, condition = {
        "income": ("Total Revenue", "Net Income", "l_returnflag <> 'R'"),
        "balance": ("Total Assets", "Total Liabilities Net Minority Interest", "l_linestatus = 'O'"),
    }[kind]
    value = cents("l_extendedprice")
    return f"""{kind}_raw AS (
  SELECT "Period", "Ticker", "Description", "Date", CAST(v AS DOUBLE) AS "Value", {YMD} AS ymd FROM (
    SELECT period AS "Period", ticker AS "Ticker", d AS "Description", CAST(report_date AS VARCHAR) AS "Date",
           sum(CASE WHEN d = '{whole}' OR ({condition}) THEN {value} END) AS v
    FROM (SELECT *, 'Annual' AS period, make_date(year(l_shipdate), 12, 31) AS report_date FROM sales
          UNION ALL
          SELECT *, 'Quarter', CAST(last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS DATE) FROM sales)
    CROSS JOIN (VALUES ('{whole}'), ('{part}')) AS lines(d)
    GROUP BY 1, 2, 3, 4)
  WHERE v IS NOT NULL),
{kind} AS (
  SELECT "Period" AS {kind}_period, "Ticker" AS ticker, "Description" AS {kind}_description,
         CAST("Date" AS DATE) AS {kind}_report_date, "Value" AS {kind}_value, ymd FROM {kind}_raw)"""


def events(kind: str) -> str:
    return (
        f"SELECT {kind}_period AS event_period, ticker, {kind}_description AS event_description, "
        f"{kind}_report_date AS event_report_date, {kind}_value AS event_value, ymd, '{kind.upper()}' AS event_type FROM {kind}"
    )


def statement_report(kind: str, columns: dict[str, str], ratio: str) -> str:
    sums = ", ".join(
        f"sum(CASE WHEN {kind}_description = '{line}' THEN {kind}_value END) AS {name}" for name, line in columns.items()
    )
    part, whole = columns
    return (
        with_(SALES, statement(kind), CALENDAR)
        + f"""SELECT *, {rnd(f'{part} * 100 / NULLIF({whole}, 0)', 2)} AS {ratio} FROM (
  SELECT ticker, {kind}_period,
         CASE WHEN {kind}_period = 'Annual' THEN CAST(dt_year AS VARCHAR) ELSE CAST(dt_year AS VARCHAR) || dt_quarter END AS dt,
         CASE WHEN {kind}_period = 'Annual' THEN CAST(dt_year AS VARCHAR) ELSE dt_quarter_long END AS dt_period,
         {sums}
  FROM {kind} JOIN calendar ON dt_date = {kind}_report_date
  GROUP BY 1, 2, 3, 4)"""
    )


RATE_TYPE = "CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'SELIC' ELSE 'EFFR' END"
RATES = f"""rates AS (
  SELECT {RATE_TYPE} AS rate_type, CAST(o_orderdate AS DATE) AS rate_date,
         CAST({cents('o_totalprice')} AS DOUBLE) AS rate_value, o_orderkey FROM orders)"""
MONTH_RATES = """month_rates AS (
  SELECT rate_type, CAST(date_trunc('month', rate_date) AS DATE) AS rate_date,
         last(rate_value ORDER BY rate_date, o_orderkey) AS rate_value
  FROM rates GROUP BY rate_type, CAST(date_trunc('month', rate_date) AS DATE))"""

HOLDINGS = """holdings AS (
  SELECT ticker, p_type AS type, CAST(l_shipdate AS DATE) AS d FROM sales
  UNION ALL
  SELECT 'Supplier#' || CAST(l_suppkey AS VARCHAR), 'SUPPLIER', CAST(l_shipdate AS DATE) FROM sales WHERE l_returnflag <> 'R')"""


def wallet(condition: str) -> str:
    return (
        with_(SALES, HOLDINGS)
        + f"SELECT ticker, min(d) AS inserted_date, count(*) AS qtty FROM holdings WHERE {condition} GROUP BY ticker"
    )


# Upserts.
MERGE_OLD = f"""old AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST({cents('o_totalprice')} + CASE WHEN o_orderpriority = '1-URGENT' THEN 100 ELSE 0 END AS DOUBLE) AS o_totalprice,
         CAST(o_orderdate AS DATE) AS o_orderdate,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')"""
MERGE_NEW = f"""new AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CAST({cents('o_totalprice')} AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
PRICE_DIFFERS = "coalesce(old.o_totalprice <> new.o_totalprice, false)"


def paired(condition: str) -> str:
    action = (
        "CASE WHEN old.o_orderkey IS NULL THEN 'insert' "
        f"WHEN new.o_orderkey IS NOT NULL AND ({condition}) THEN 'update' ELSE 'keep' END"
    )
    return f"paired AS (SELECT {action} AS a, old, new FROM old FULL OUTER JOIN new ON old.o_orderkey = new.o_orderkey)"


def merged(condition: str) -> str:
    values = [f"CASE WHEN a = 'keep' THEN old.{c} ELSE new.{c} END AS {c}" for c in ORDER_COLUMNS]
    return with_(MERGE_OLD, MERGE_NEW, paired(condition)) + f"SELECT {', '.join(values)}, a AS _action FROM paired"


EVOLVED = [
    "CASE WHEN a = 'keep' THEN old.o_orderkey ELSE new.o_orderkey END AS o_orderkey",
    "old.o_custkey AS o_custkey",
    *[f"CASE WHEN a = 'keep' THEN old.{c} ELSE new.{c} END AS {c}" for c in ORDER_COLUMNS[2:]],
    "CASE WHEN a <> 'keep' THEN CAST(year(new.o_orderdate) AS INTEGER) END AS order_year",
]

# Versioned dimension.
HISTORY = f"""customers AS (
  SELECT c_custkey, c_name, c_nationkey, CAST({cents('c_acctbal')} AS DOUBLE) AS c_acctbal, c_mktsegment,
         c_mktsegment = 'FURNITURE' AND c_nationkey >= 20 AS closed_only FROM customer),
history AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'OUTDATED' ELSE c_mktsegment END AS c_mktsegment,
         CAST(NULL AS TIMESTAMP) AS end_dt, true AS is_current
  FROM customers WHERE c_mktsegment <> 'BUILDING' AND NOT closed_only
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'EARLIER' ELSE c_mktsegment END,
         TIMESTAMP '1999-06-30', false
  FROM customers WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') OR closed_only),
snap AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customers WHERE c_acctbal >= 0),
changed AS (
  SELECT h.c_custkey FROM history h JOIN snap s ON h.c_custkey = s.c_custkey
  WHERE h.is_current AND (h.c_name <> s.c_name OR h.c_nationkey <> s.c_nationkey OR h.c_acctbal <> s.c_acctbal
                          OR h.c_mktsegment <> s.c_mktsegment)),
result AS (
  SELECT h.* EXCLUDE (end_dt, is_current), end_dt, is_current, 'keep' AS _action FROM history h
  WHERE NOT is_current OR c_custkey NOT IN (SELECT c_custkey FROM changed)
  UNION ALL
  SELECT h.* EXCLUDE (end_dt, is_current), TIMESTAMP '2001-12-30', false, 'update' FROM history h
  WHERE is_current AND c_custkey IN (SELECT c_custkey FROM changed)
  UNION ALL
  SELECT s.*, CAST(NULL AS TIMESTAMP), true, 'insert' FROM snap s
  WHERE c_custkey IN (SELECT c_custkey FROM changed)
     OR c_custkey NOT IN (SELECT c_custkey FROM history WHERE is_current))"""


# Snapshots of three months; a version starts where a customer differs from the month before that has it.
LATE = """observations AS (
  SELECT * EXCLUDE (end_dt, is_current), TIMESTAMP '2001-01-01' AS seen FROM history WHERE is_current
  UNION ALL
  SELECT * REPLACE (CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment), TIMESTAMP '2001-02-01' FROM snap
  UNION ALL
  SELECT *, TIMESTAMP '2001-03-01' FROM snap),
heads AS (
  SELECT * EXCLUDE (before) FROM (
    SELECT *, lag({'n': c_name, 'k': c_nationkey, 'a': c_acctbal, 's': c_mktsegment}) OVER (PARTITION BY c_custkey ORDER BY seen) AS before FROM observations)
  WHERE before IS NULL OR before <> {'n': c_name, 'k': c_nationkey, 'a': c_acctbal, 's': c_mktsegment})"""

WIDER_HISTORY = (
    HISTORY.replace("c_mktsegment FROM customers WHERE c_acctbal >= 0", "c_mktsegment, CASE WHEN c_nationkey % 3 = 0 THEN 'gold' END AS c_tier FROM customers WHERE c_acctbal >= 0")
    .replace("OR h.c_mktsegment <> s.c_mktsegment", "OR h.c_mktsegment <> s.c_mktsegment OR s.c_tier IS NOT NULL")
    .replace("SELECT h.* EXCLUDE (end_dt, is_current),", "SELECT h.* EXCLUDE (end_dt, is_current), CAST(NULL AS VARCHAR) AS c_tier,")
)


def whole(value: str) -> str:
    """Null where the payload arrives cut off."""
    return f"CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE {value} END"


def counts(table: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {c}) AS bad_rows FROM {table}" for name, c in conditions.items()
    )


def report(table: str, header: bool, negative: str, null: str, types: bool = True) -> str:
    return (
        f"SELECT '{table}' AS table_name, {header} AS check_header, neg AS has_negatives, nul AS has_nulls, "
        f"{types} AS check_dtypes, {header} AND NOT neg AND NOT nul AND {types} AS is_valid "
        f"FROM (SELECT count(*) FILTER (WHERE {negative}) > 0 AS neg, count(*) FILTER (WHERE {null}) > 0 AS nul FROM {table})"
    )


MONTHS = f"""months AS (
  SELECT ticker, CAST(year(price_date) AS INTEGER) AS dt_year, CAST(month(price_date) AS INTEGER) AS dt_month,
         max(price_date) AS last_day,
         {rnd('first(vl_open ORDER BY price_date)', 2)} AS vl_open, {rnd('min(vl_low)', 2)} AS vl_low,
         {rnd('max(vl_high)', 2)} AS vl_high, {rnd('last(vl_close ORDER BY price_date)', 2)} AS vl_close,
         sum(vl_volume) AS vl_volume,
         {rnd('last(vl_moving_avg_200_days ORDER BY price_date)', 2)} AS vl_moving_avg_200_days
  FROM kpis GROUP BY ticker, year(price_date), month(price_date)),
month_rows AS (SELECT * EXCLUDE (last_day), last_day AS price_date FROM months)"""

MONTH_BASES = """bases AS (
  SELECT *,
         CASE WHEN row_number() OVER w = 1 THEN vl_close ELSE lag(vl_close) OVER w END AS vl_previous_month,
         CAST(lag(vl_close, 12, 0) OVER w AS DOUBLE) AS vl_previous_year,
         avg(vl_close) OVER so_far AS mean, stddev_samp(vl_close) OVER so_far AS deviation
  FROM month_rows
  WINDOW w AS (PARTITION BY ticker ORDER BY price_date),
         so_far AS (PARTITION BY ticker ORDER BY price_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
MONTH_CHANGE = rnd("vl_close - vl_previous_month", 2)
YEAR_CHANGE = rnd("vl_close - vl_previous_year", 2)

LATEST = (
    "latest AS (SELECT * FROM kpis JOIN calendar ON dt_date = price_date "
    "WHERE price_date = (SELECT max(k.price_date) FROM bars k WHERE k.ticker = kpis.ticker))"
)
LATEST_COLUMNS = [
    "ticker", "price_date", rnd("vl_close", 2) + " AS vl_close", "perc_change_day", "perc_change_month",
    "perc_change_week", "vl_change_day", "vl_change_week", "vl_change_month", "vl_moving_avg_200_days",
    "dt_day_of_week_full", "dt_day", "dt_month_full", "dt_year", "dt_full_date",
]


def latest(columns: list[str]) -> str:
    return with_(SALES, BARS, KPIS, CALENDAR, LATEST) + f"SELECT {', '.join(columns)} FROM latest"


ONE = " WHERE ticker = 'Brand#11'"


def price_report(since: str, period: str) -> str:
    return (
        with_(SALES, BARS, KPIS, CALENDAR, statement("income"))
        + f"""SELECT DISTINCT prc.*, i.income_value FROM (
           SELECT ticker, CAST(dt_year AS VARCHAR) || '-' || dt_month AS year_month,
                  first_value(vl_open) OVER all_days AS vl_open, last_value(vl_close) OVER all_days AS vl_close,
                  last_value(vl_moving_avg_200_days) OVER all_days AS vl_moving_avg_200_days
           FROM kpis JOIN calendar ON dt_date = price_date
           WHERE price_date >= {since}
           WINDOW all_days AS (PARTITION BY ticker, dt_year, dt_month ORDER BY price_date
                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) prc
         LEFT JOIN income i ON prc.year_month = strftime(i.income_report_date, '%Y-%m') AND prc.ticker = i.ticker
              AND i.income_description = 'Net Income' AND i.income_period = '{period}'"""
    )


DIVIDENDS = (
    with_(SALES, BARS)
    + f"""SELECT ticker, dt_year, {rnd('paid', 4)} AS vl_dividends, {rnd('prev', 4)} AS vl_dividend_prev,
          {rnd(f'(paid - {rnd("prev", 4)}) / NULLIF({rnd("prev", 4)}, 0) * 100', 2)} AS vl_dividend_growth
          FROM (SELECT *, lag(paid) OVER (PARTITION BY ticker ORDER BY dt_year) AS prev
                FROM (SELECT ticker, CAST(year(price_date) AS INTEGER) AS dt_year, sum(vl_dividends) AS paid FROM bars
                      WHERE vl_dividends > 0 AND price_date >= DATE '1998-01-01' GROUP BY 1, 2))"""
)

INCOME_LINES = "income", {"Net_Income": "Net Income", "Total_Revenue": "Total Revenue"}, "Profit_Margin"
BALANCE_LINES = (
    "balance",
    {"Total_Liabilities": "Total Liabilities Net Minority Interest", "Total_Assets": "Total Assets"},
    "Debt_to_Assets",
)

ORDER_DAY = "CAST(o_orderdate AS DATE)"
TEXT_ATTRIBUTES = [
    "dt_month", "dt_day", "dt_day_of_week", "dt_day_of_week_short", "dt_week_of_year", "dt_quarter_long",
    "dt_semester_desc", "dt_full_date", "dt_is_weekend", "dt_is_hollyday",
]
TICKER_DOCUMENTS = """docs AS (
  SELECT CAST(p_partkey AS VARCHAR) AS _id, p_type AS "Type", CASE WHEN p_size > 5 THEN p_brand END AS "Ticker", p_name AS "Name",
         'NYSE' AS "Exchange", p_type AS "Category_Name", CASE WHEN p_size > 20 THEN 'US' END AS "Country"
  FROM part)"""
PROFILES = (
    f"SELECT DISTINCT c_custkey AS ticker, c_name AS \"longName\", c_mktsegment AS sector, {YMD} AS ymd FROM customer"
)
ORDER_DATE_TEXT = (
    "CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m') "
    "WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END"
)

ORACLES: dict[str, str] = {
    "q_read_filtered": f"""SELECT l_orderkey, l_partkey, l_quantity, {cents('l_extendedprice')} AS cents
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""",
    "q_unpivot_prices": with_(SALES, BARS)
    + """SELECT strftime(price_date, '%Y-%m-%d') AS "Date", ticker AS "Ticker", vl_open AS "Open", vl_high AS "High",
         vl_low AS "Low", vl_close AS "Close", vl_volume AS "Volume", vl_dividends AS "Dividends" FROM bars""",
    "q_unpivot_statement": with_(SALES, statement("income")) + "SELECT * FROM income_raw",
    "q_json_rates": f"""SELECT {RATE_TYPE} AS tipo, {whole("strftime(o_orderdate, '%d/%m/%Y')")} AS data,
        {whole(f"CAST({cents('o_totalprice')} AS VARCHAR)")} AS valor, {YMD} AS ymd, o_orderkey FROM orders""",
    "q_xml_rates": f"""SELECT {RATE_TYPE} AS "typeRate", {whole("strftime(o_orderdate, '%Y-%m-%d')")} AS "effectiveDate",
        {whole(f"CAST({cents('o_totalprice')} AS VARCHAR)")} AS "percentRate", {YMD} AS ymd, o_orderkey FROM orders""",
    "q_profile_flatten": PROFILES,
    "q_distinct_profile": PROFILES,
    "q_fallback_partition": """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd FROM orders
        WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    "q_tickers_scan": with_(TICKER_DOCUMENTS) + f'SELECT *, {YMD} AS ymd FROM docs WHERE "Ticker" IS NOT NULL',
    "q_wallet_tickers": wallet("true"),
    "q_wallet_tickers_by_type": wallet("type IN ('PROMO', 'ECONOMY', 'SUPPLIER')"),
    "q_first_ticker": with_(SALES, HOLDINGS) + "SELECT min(ticker) AS ticker FROM holdings",
    "q_find_limit": f"""SELECT o_orderkey, o_custkey, {cents('o_totalprice')} AS cents FROM orders
        WHERE o_orderstatus = 'F' ORDER BY o_totalprice, o_orderkey LIMIT 50""",
    "q_calendar": with_(CALENDAR) + "SELECT * FROM calendar",
    "q_high_water_mark": with_(RATES)
    + """SELECT * FROM rates WHERE rate_date >=
         (SELECT max(rate_date) FROM rates WHERE rate_type = 'SELIC' AND rate_date < DATE '2001-01-01')""",
    "q_high_water_mark_empty": with_(RATES) + "SELECT * FROM rates WHERE rate_date >= DATE '1999-01-01'",
    "q_merge_upsert": merged("true"),
    "q_merge_on_change": merged(PRICE_DIFFERS),
    "q_merge_recent_window": merged(f"old.o_orderdate >= {AS_OF} - 500"),
    "q_merge_multi_attr": merged(
        " OR ".join(f"coalesce(old.{c} <> new.{c}, false)" for c in ("o_orderstatus", "o_totalprice", "o_orderpriority"))
    ),
    "q_merge_null_safe": merged(" OR ".join(f"old.{c} IS DISTINCT FROM new.{c}" for c in ORDER_COLUMNS[1:])),
    "q_merge_shuffle": merged(PRICE_DIFFERS),
    "q_merge_probe": merged(PRICE_DIFFERS),
    "q_merge_schema_evolution": with_(MERGE_OLD, MERGE_NEW, paired(PRICE_DIFFERS))
    + f"SELECT {', '.join(EVOLVED)}, a AS _action FROM paired",
    "q_merge_metrics": with_(MERGE_OLD, MERGE_NEW, paired(PRICE_DIFFERS))
    + """SELECT count(*) FILTER (WHERE a = 'insert') AS inserted, count(*) FILTER (WHERE a = 'update') AS updated,
         count(*) FILTER (WHERE a = 'keep') AS kept, CAST(0 AS BIGINT) AS deleted FROM paired""",
    "q_delete_where": with_(MERGE_OLD) + "SELECT * FROM old WHERE o_orderpriority IS DISTINCT FROM '5-LOW'",
    "q_sink_upsert": f"SELECT * EXCLUDE (_action) FROM ({merged(PRICE_DIFFERS)})",
    "q_sink_delete": with_(MERGE_OLD) + "SELECT * FROM old WHERE o_orderpriority IS DISTINCT FROM '5-LOW'",
    "q_sink_versions": with_(HISTORY) + "SELECT * EXCLUDE (_action) FROM result WHERE is_current OR _action = 'update'",
    "q_json_rates_split": f"""SELECT 'SELIC' AS tipo, strftime(o_orderdate, '%d/%m/%Y') AS data, CAST({cents('o_totalprice')} AS VARCHAR) AS valor,
        {YMD} AS ymd FROM orders""",
    "q_run_log_compacted": "SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS tier, event_id AS inserted, CAST(ts AS DATE) AS logged_day FROM events",
    "q_update_where": with_(MERGE_OLD)
    + """SELECT o_orderkey, o_custkey, CASE WHEN hit THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN hit THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority,
        CASE WHEN hit THEN 'was ' || o_orderstatus END AS o_note
        FROM (SELECT *, coalesce(o_orderpriority = '5-LOW', false) AS hit FROM old)""",
    "q_sink_update": with_(MERGE_OLD)
    + """SELECT o_orderkey, o_custkey, CASE WHEN hit THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN hit THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
        FROM (SELECT *, o_orderstatus = 'P' OR coalesce(o_orderpriority = '5-LOW', false) AS hit FROM old)
        UNION ALL SELECT -1, NULL, 'N', 100.0, NULL, NULL""",
    "q_sink_upsert_feed": f"SELECT * EXCLUDE (_action), strftime(o_orderdate, '%Y-%m') AS o_month FROM ({merged(PRICE_DIFFERS)})".replace(
        "TIMESTAMP '1998-01-01'", "TIMESTAMP '2000-10-01'"
    ),
    "q_sink_versions_late": with_(HISTORY, LATE) + """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
        lead(seen) OVER w - INTERVAL 1 DAY AS end_dt, lead(seen) OVER w IS NULL AS is_current FROM heads WINDOW w AS (PARTITION BY c_custkey ORDER BY seen)""",
    "q_catalog_in_step": f"SELECT * EXCLUDE (_action), strftime(o_orderdate, '%Y') AS o_year, CASE WHEN _action <> 'keep' THEN 'seen ' || o_orderstatus END AS o_note "
    f"FROM ({merged(PRICE_DIFFERS)})",
    "q_catalog_listing": "SELECT 'orders_of_status' AS table_name, false AS is_temporary, count(*) AS n_rows FROM orders UNION ALL SELECT 'customers', false, count(*) FROM customer",
    "q_empty_table": with_(MERGE_NEW) + "SELECT *, 'insert' AS _action FROM new",
    "q_schema_equality": "SELECT 'part' AS table_name, true AS same, count(*) AS n_rows FROM part UNION ALL SELECT 'region', false, count(*) FROM region "
    "UNION ALL SELECT 'nation', false, count(*) FROM nation",
    "q_multi_file_read": f"SELECT o_orderkey, o_custkey, {cents('o_totalprice')} AS cents FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')",
    "q_kpis_correction": with_(SALES, BARS, KPIS) + "SELECT * FROM kpis",
    "q_kpis_from_states": with_(SALES, BARS, KPIS) + "SELECT * FROM kpis WHERE price_date >= DATE '2000-01-01'",
    "q_month_states": with_(SALES, BARS)
    + f"""SELECT ticker, CAST(date_trunc('month', price_date) AS DATE) AS month, max(price_date) AS last_day, CAST(max(n) AS BIGINT) AS n,
        last(total ORDER BY price_date) AS total, CAST(least(max(n), 200) AS INTEGER) AS held, last(held_closes ORDER BY price_date) AS held_closes
        FROM (SELECT *, count(*) OVER w AS n, sum(vl_close) OVER w AS total, sum(vl_close) OVER (w ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS held_closes
              FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY price_date)) GROUP BY 1, 2""",
    "q_load_corrected_days": with_(SALES, BARS, KPIS)
    + "SELECT ticker, price_date, vl_close, z_score, vl_change_week, perc_change_month, vl_moving_avg_20_days, vl_moving_avg_200_days FROM kpis",
    "q_run_log_latest": f"""SELECT run_id, tier, last(event_id ORDER BY d, event_id) AS inserted, max(d) AS logged_on,
        last(c ORDER BY d, event_id) AS updated
        FROM (SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS tier, event_id, CAST(ts AS DATE) AS d,
                     {cents('value')} AS c FROM events) GROUP BY run_id, tier""",
    "q_scd2": with_(HISTORY) + "SELECT * FROM result",
    "q_scd2_current": with_(HISTORY) + "SELECT c_custkey, c_mktsegment, 'keep' AS _action FROM result WHERE is_current",
    "q_scd2_schema_evolution": with_(WIDER_HISTORY) + "SELECT * FROM result",
    "q_rename_schema": """SELECT l_orderkey AS "order", l_partkey AS part, l_suppkey AS supplier, l_linenumber AS line,
        l_quantity AS quantity, l_extendedprice AS price, l_discount AS "off", l_tax AS tax FROM lineitem""",
    "q_rates_silver": f"""SELECT {RATE_TYPE} AS rate_type,
        CASE WHEN c % 10 = 7 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS rate_date,
        CASE WHEN c % 10 = 3 THEN NULL ELSE CAST(c AS DOUBLE) END AS rate_value, o_orderkey
        FROM (SELECT *, {cents('o_totalprice')} AS c FROM orders)""",
    "q_rates_rejects": f"""SELECT * FROM (
        SELECT {RATE_TYPE} AS rate_type, {whole("CASE WHEN c % 10 = 7 THEN '31/02/1999' ELSE strftime(o_orderdate, '%d/%m/%Y') END")} AS rate_date,
               {whole("CASE WHEN c % 10 = 3 THEN 'n/d' ELSE CAST(c AS VARCHAR) END")} AS rate_value, o_orderkey,
               CASE WHEN o_orderkey % 10 = 3 THEN 'payload' WHEN c % 10 = 7 THEN 'date' WHEN c % 10 = 3 THEN 'value' END AS reason
        FROM (SELECT *, {cents('o_totalprice')} AS c FROM orders)) WHERE reason IS NOT NULL""",
    "q_try_numeric": """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE CAST(p_size AS DOUBLE) END AS value
        FROM part""",
    "q_string_date_fns": f"""SELECT o_orderkey, {listed({n: attributes(ORDER_DAY)[n] for n in TEXT_ATTRIBUTES})},
        strftime(o_orderdate, '%Y-%m') AS year_month, strftime(o_orderdate, '%m') AS split_month,
        strftime(o_orderdate, '%m') AS substring_month, {ORDER_DAY} AS parsed,
        CAST({AS_OF} - {ORDER_DAY} AS INTEGER) AS days_back, last_day({ORDER_DAY}) AS month_end FROM orders""",
    "q_dividends": with_(SALES, BARS) + "SELECT ticker, price_date AS ex_date, vl_dividends FROM bars WHERE vl_dividends > 0",
    "q_financial_event": with_(SALES, statement("income"), statement("balance"))
    + f"{events('income')} UNION ALL {events('balance')}",
    "q_join_calendar": with_(CALENDAR)
    + """SELECT dt_quarter_long, dt_day_of_week_full, count(*) AS lines, sum(l_quantity) AS quantity
         FROM lineitem JOIN calendar ON dt_date = CAST(l_shipdate AS DATE) GROUP BY 1, 2""",
    "q_zscore": on_bars([ZSCORE]),
    "q_change_day": on_bars(CHANGE_DAY),
    "q_change_week": on_bars(CHANGE_WEEK),
    "q_change_month": on_bars(CHANGE_MONTH),
    "q_moving_avg": on_bars(AVERAGES),
    "q_price_kpis": with_(SALES, BARS, KPIS) + "SELECT * FROM kpis",
    "q_kpis_incremental": with_(SALES, BARS, KPIS) + "SELECT * FROM kpis",
    "q_month_summary": with_(SALES, BARS, KPIS, MONTHS) + "SELECT * FROM month_rows",
    "q_month_kpis": with_(SALES, BARS, KPIS, MONTHS, MONTH_BASES)
    + f"""SELECT * EXCLUDE (mean, deviation),
         CASE WHEN deviation IS NULL THEN 0.0::DOUBLE ELSE round((vl_close - mean) / NULLIF(deviation, 0), 4) + 0.0 END AS z_score,
         {MONTH_CHANGE} AS vl_change_month,
         {rnd(f'100 * {MONTH_CHANGE} / NULLIF(vl_previous_month, 0)', 2)} AS perc_change_month,
         {YEAR_CHANGE} AS vl_change_year,
         CASE WHEN vl_previous_year = 0 THEN 0.0::DOUBLE
              ELSE {rnd(f'100 * {YEAR_CHANGE} / NULLIF(vl_previous_year, 0)', 2)} END AS perc_change_year
         FROM bases""",
    "q_rate_month": with_(RATES, MONTH_RATES) + "SELECT * FROM month_rates",
    "q_dq_negatives": counts("customer", {"c_custkey": "c_custkey < 0", "c_acctbal": "c_acctbal < 0"}),
    "q_dq_nulls": with_(MERGE_OLD) + counts("old", {c: f"{c} IS NULL" for c in ORDER_COLUMNS}),
    "q_dq_dates": f"""WITH texts AS (SELECT {ORDER_DATE_TEXT} AS s FROM orders)
        SELECT 'order_date' AS column_name,
               count(*) FILTER (WHERE s IS NOT NULL AND try_strptime(s, '%Y-%m-%d') IS NULL) AS bad_rows FROM texts
        UNION ALL SELECT 'local_date', CAST(0 AS BIGINT)""",
    "q_dq_report": with_(MERGE_OLD)
    + " UNION ALL ".join(
        [
            report("customer", True, "c_custkey < 0 OR c_acctbal < 0", "c_custkey IS NULL OR c_name IS NULL"),
            report("supplier", False, "s_suppkey < 0", "s_suppkey IS NULL"),
            report("part", True, "p_partkey < 0 OR p_retailprice < 0", "p_partkey IS NULL OR p_name IS NULL OR p_retailprice IS NULL"),
            report("old", True, "o_orderkey < 0 OR o_totalprice < 0", "o_orderkey IS NULL OR o_orderpriority IS NULL").replace("'old'", "'orders'"),
        ]
    ),
    "q_ref_integrity": """SELECT doc_id, lang, source FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "q_dq_range": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 3 OR l_quantity > 48",
    "q_dq_timestamps": f"SELECT o_orderkey, {ORDER_DAY} AS o_orderdate FROM orders WHERE {ORDER_DAY} < DATE '2000-01-01'",
    "q_outliers": with_(SALES, BARS)
    + f"SELECT * FROM (SELECT ticker, price_date, vl_close, {ZSCORE} FROM bars{WINDOWS}) WHERE z_score > 1.5",
    "q_outliers_table": f"""WITH priced AS (SELECT o_orderkey, {cents('o_totalprice')} AS cents FROM orders),
        stats AS (SELECT avg(cents) AS mean, stddev_samp(cents) AS deviation FROM priced)
        SELECT o_orderkey, cents, round((cents - mean) / deviation, 4) AS z_score FROM priced, stats
        WHERE round((cents - mean) / deviation, 4) > 1.7""",
    "q_dash_price": price_report("DATE '1999-12-31'", "Quarter"),
    "q_dash_price_one": f"SELECT * FROM ({price_report("DATE '1991-12-31'", 'Annual')}){ONE}",
    "q_dash_price_ten_years": price_report("DATE '1991-12-31'", "Quarter"),
    "q_dash_dividend": DIVIDENDS,
    "q_dash_dividend_one": DIVIDENDS + ONE,
    "q_dash_income": statement_report(*INCOME_LINES),
    "q_dash_income_one": statement_report(*INCOME_LINES) + ONE + " AND income_period = 'Annual'",
    "q_dash_balance": statement_report(*BALANCE_LINES),
    "q_dash_balance_one": statement_report(*BALANCE_LINES) + ONE + " AND balance_period = 'Quarter'",
    "q_dash_latest_one": latest(LATEST_COLUMNS) + ONE,
    "q_dash_latest": latest(LATEST_COLUMNS),
    "q_latest_day": latest(["ticker", "dt_full_date", "perc_change_day"]),
    "q_latest_month": latest(["ticker", "dt_month_full", "perc_change_month"]),
    "q_latest_against_average": latest(["ticker", "dt_year", LATEST_COLUMNS[2], "vl_moving_avg_200_days"]),
    "q_dash_rates": with_(RATES, MONTH_RATES, CALENDAR)
    + """SELECT rate_type, rate_date, rate_value FROM month_rates JOIN calendar ON dt_date = rate_date
         WHERE rate_date >= DATE '1998-01-01'""",
    "q_call_totals": f"""WITH durations AS (
          SELECT o_custkey AS phone, {cents('o_totalprice')} AS d FROM orders
          UNION ALL
          SELECT (o_custkey + 7) % (SELECT count(*) FROM customer), {cents('o_totalprice')} FROM orders)
        SELECT name FROM (SELECT c_name AS name, phone, sum(d) AS total FROM customer JOIN durations ON phone = c_custkey
                          GROUP BY c_name, phone HAVING sum(d) >= 350000000)""",
}
