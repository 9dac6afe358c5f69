"""Inputs of the registered queries, derived by Spark from the test tables.

Money is in whole cents held as doubles, so that sums and averages do not depend on the
order in which rows are added.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.calendar import calendar_from
from tallyline.operators.rates import clean_rates
from tallyline.operators.scd2 import CURRENT, END
from tallyline.plans import schemas
from tallyline.plans.statements import clean_statement, raw_statement
from tallyline.sources.landed import json_rates_in, xml_rates_in

AS_OF = date(2001, 12, 31)
YMD = "20011231"
YEARS = range(1995, 2002)
TICKERS = [f"Brand#{n}" for n in range(1, 26)]
ANNUAL_DATES = [f"{y}-12-31" for y in YEARS]
QUARTER_DATES = [f"{y}-{end}" for y in YEARS for end in ("03-31", "06-30", "09-30", "12-31")]
PRICE_FIELDS = {
    "Open": "Open", "High": "High", "Low": "Low", "Close": "Close", "Volume": "Volume", "Dividends": "Dividends",
}


class Tables:
    """The test tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def cents(column: str) -> Column:
    """Whole cents of a two-decimal amount; ``rint`` stays in primitive doubles, ``round`` does not."""
    return F.rint(F.col(column) * 100).cast("long")


def day(column: str) -> Column:
    return F.col(column).cast("date")


def sales(t: Tables) -> DataFrame:
    """Order lines with the brand of their part."""
    parts = t.part.select("p_partkey", F.col("p_brand").alias("ticker"), "p_type")
    return t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def bars(t: Tables) -> DataFrame:
    """Daily bars: one row per (brand, ship day).

    The order of a day's sales is one exact number, not a struct, so that the aggregate keeps
    a fixed-width buffer: it hashes, combines before the shuffle, and never sorts the sales.
    """
    line = F.col("l_orderkey") * 1000 + F.col("l_linenumber")
    order = line.cast("decimal(19,0)") * F.lit(10**12) + F.col("c").cast("decimal(12,0)")
    ticks = sales(t).select(
        "ticker",
        day("l_shipdate").alias("price_date"),
        cents("l_extendedprice").alias("c"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        cents("l_tax").alias("tax"),
    )
    return (
        ticks.withColumn("o", order)
        .groupBy("ticker", "price_date")
        .agg(
            F.min_by("c", "o").cast("double").alias("vl_open"),
            F.max("c").cast("double").alias("vl_high"),
            F.min("c").cast("double").alias("vl_low"),
            F.max_by("c", "o").cast("double").alias("vl_close"),
            F.sum("l_quantity").alias("vl_volume"),
            F.sum("tax").cast("double").alias("vl_dividends"),
        )
    )


def calendar(t: Tables) -> DataFrame:
    return calendar_from(t.lineitem, "l_shipdate", AS_OF, whole_years=True)


def prices_wide(t: Tables) -> DataFrame:
    """The bars as a feed: one row per date, columns ``brand__field``."""
    known = F.when(F.col("ticker").isin(TICKERS), F.col("ticker")).otherwise(
        F.raise_error(F.lit("unlisted brand")).cast("string")
    )
    values = [F.first(f"vl_{f.lower()}").alias(f) for f in PRICE_FIELDS]
    wide = bars(t).withColumn("ticker", known).groupBy("price_date").pivot("ticker", TICKERS).agg(*values)
    names = {f"{b}_{f}": f"{b}__{f}" for b in TICKERS for f in PRICE_FIELDS}
    return wide.withColumnsRenamed({"price_date": "Date", **names})


def statement_totals(t: Tables, lines: dict[str, Column]) -> DataFrame:
    """Cents per brand and quarter, one column per statement line; ``lines`` are conditions on sales."""
    quarter_end = F.date_sub(F.add_months(F.trunc("ship", "quarter"), 3), 1)
    return (
        sales(t)
        .select("ticker", day("l_shipdate").alias("ship"), cents("l_extendedprice").alias("c"),
                "l_returnflag", "l_linestatus")
        .groupBy("ticker", quarter_end.alias("quarter_end"))
        .agg(*[F.sum(F.when(condition, F.col("c"))).alias(name) for name, condition in lines.items()])
    )


def statement_wide(quarters: DataFrame, lines: list[str], report_date: Column, dates: list[str]) -> DataFrame:
    """One row per (brand, line), one column per report date."""
    text = report_date.cast("string")
    known = F.when(text.isin(dates), text).otherwise(F.raise_error(F.lit("unlisted report date")).cast("string"))
    totals = quarters.groupBy("ticker", known.alias("report_date")).agg(*[F.sum(c).alias(c) for c in lines])
    return (
        totals.unpivot(["ticker", "report_date"], lines, "Description", "cell")
        .groupBy(F.col("ticker").alias("Ticker"), "Description")
        .pivot("report_date", dates)
        .agg(F.first("cell"))
    )


def statement_raw(t: Tables, kind: str) -> DataFrame:
    lines = {
        "income": {"Total Revenue": F.lit(True), "Net Income": F.col("l_returnflag") != "R"},
        "balance": {"Total Assets": F.lit(True), "Total Liabilities Net Minority Interest": F.col("l_linestatus") == "O"},
    }[kind]
    # Years are summed from the quarters, so the sales are read and shuffled once for both.
    quarters = statement_totals(t, lines)
    year_end = F.make_date(F.year("quarter_end"), F.lit(12), F.lit(31))
    annual = statement_wide(quarters, list(lines), year_end, ANNUAL_DATES)
    quarterly = statement_wide(quarters, list(lines), F.col("quarter_end"), QUARTER_DATES)
    return raw_statement(annual, quarterly, YMD)


def income(t: Tables) -> DataFrame:
    return clean_statement(statement_raw(t, "income"), schemas.INCOME)


def balance(t: Tables) -> DataFrame:
    return clean_statement(statement_raw(t, "balance"), schemas.BALANCE)


def rate_type() -> Column:
    high = F.substring("o_orderpriority", 1, 1).isin("1", "2")
    return F.when(high, "SELIC").otherwise("EFFR")


def broken() -> Column:
    """Orders whose rate payload arrives cut off."""
    return F.col("o_orderkey") % 10 == 3


def json_rates(t: Tables, with_broken: bool = False) -> DataFrame:
    """Orders as rate documents in JSON, read back; every tenth payload cut off if asked for."""
    record = F.struct(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"), (cents("o_totalprice")).cast("string").alias("valor")
    )
    whole = F.to_json(F.array(record))
    orders = t.orders.select("*", F.when(broken(), F.substring(whole, 1, 9)).otherwise(whole).alias("payload") if with_broken else whole.alias("payload"))
    return json_rates_in(orders, "payload", rate_type(), YMD, keep=("o_orderkey",))


def xml_rates(t: Tables, with_broken: bool = False) -> DataFrame:
    """Orders as rate elements in XML, read back; every tenth payload cut off if asked for."""
    element = F.format_string(
        "<rate><effectiveDate>%s</effectiveDate><percentRate>%s</percentRate></rate>",
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        cents("o_totalprice").cast("string"),
    )
    orders = t.orders.select("*", F.when(broken(), F.substring(element, 1, 20)).otherwise(element).alias("payload") if with_broken else element.alias("payload"))
    return xml_rates_in(orders, "payload", rate_type(), YMD, keep=("o_orderkey",))


def rates(t: Tables) -> DataFrame:
    """Cleaned rates, one row per order, straight from text columns."""
    raw = t.orders.select(
        rate_type().alias("tipo"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"),
        cents("o_totalprice").cast("string").alias("valor"),
        "o_orderkey",
    )
    return clean_rates(raw, "tipo", "data", "valor", "dd/MM/yyyy", keep=("o_orderkey",))


def portfolios(t: Tables) -> DataFrame:
    """One portfolio document per sale: it holds the part's brand and, if not returned, its supplier."""
    def holding(ticker: Column, kind: Column) -> Column:
        return F.struct(
            ticker.alias("ticker"), kind.alias("type"), day("l_shipdate").alias("inserted_date")
        )

    part = holding(F.col("ticker"), F.col("p_type"))
    supplier = holding(F.concat(F.lit("Supplier#"), F.col("l_suppkey").cast("string")), F.lit("SUPPLIER"))
    stocks = F.when(F.col("l_returnflag") != "R", F.array(part, supplier)).otherwise(F.array(part))
    return sales(t).select(F.col("l_orderkey").alias("_id"), stocks.alias("stocks"))


def ticker_documents(t: Tables) -> DataFrame:
    """Parts as ticker documents, one each; those of small parts have no ticker."""
    return t.part.select(
        F.col("p_partkey").cast("string").alias("_id"),
        F.col("p_type").alias("Type"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("Ticker"),
        F.col("p_name").alias("Name"),
        F.lit("NYSE").alias("Exchange"),
        F.col("p_type").alias("Category_Name"),
        F.when(F.col("p_size") > 20, "US").alias("Country"),
    )


# The upsert inputs: the table holds the orders before 2001, some with stale prices or missing
# attributes; the source brings every order since 1998.
def merge_old(t: Tables) -> DataFrame:
    stale = F.col("o_orderpriority") == "1-URGENT"
    price = F.when(stale, cents("o_totalprice") + 100).otherwise(cents("o_totalprice")).cast("double")
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return (
        t.orders.where(F.col("o_orderdate") < "2001-01-01")
        .select("o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"),
                day("o_orderdate").alias("o_orderdate"), priority.alias("o_orderpriority"))
    )


def merge_new(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderpriority") == "2-HIGH", "F").otherwise(F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    return (
        t.orders.where(F.col("o_orderdate") >= "1998-01-01")
        .select("o_orderkey", "o_custkey", status.alias("o_orderstatus"),
                cents("o_totalprice").cast("double").alias("o_totalprice"),
                day("o_orderdate").alias("o_orderdate"), priority.alias("o_orderpriority"))
    )


# The versioned inputs: the history holds every customer outside BUILDING, HOUSEHOLD ones with an
# outdated segment and AUTOMOBILE ones with a closed earlier version; the segment of MACHINERY
# customers returns to that of their closed version. FURNITURE customers of the last nations are
# closed only. The snapshot leaves out customers in debt.
def profile_history(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    base = ["c_custkey", "c_name", "c_nationkey", cents("c_acctbal").cast("double").alias("c_acctbal")]

    def versions(rows: DataFrame, value: Column, end: Column, current: bool) -> DataFrame:
        return rows.select(*base, value.alias("c_mktsegment"), end.alias(END), F.lit(current).alias(CURRENT))

    open_end, closed_end = F.lit(None).cast("timestamp_ntz"), F.lit("1999-06-30").cast("timestamp_ntz")
    closed_only = (segment == "FURNITURE") & (F.col("c_nationkey") >= 20)
    current = t.customer.where((segment != "BUILDING") & ~closed_only)
    outdated = F.when(segment.isin("HOUSEHOLD", "MACHINERY"), "OUTDATED").otherwise(segment)
    past = t.customer.where(segment.isin("AUTOMOBILE", "MACHINERY") | closed_only)
    earlier = F.when(segment == "AUTOMOBILE", "EARLIER").otherwise(segment)
    return versions(current, outdated, open_end, True).unionByName(versions(past, earlier, closed_end, False))


def profile_snapshot(t: Tables) -> DataFrame:
    balance_cents = cents("c_acctbal").cast("double").alias("c_acctbal")
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", balance_cents, "c_mktsegment")
    return rows.where(F.col("c_acctbal") >= 0)


def profile_records(t: Tables) -> DataFrame:
    """Customers as nested company records, with their nested list of officers."""
    officers = F.array(F.struct(F.col("c_name").alias("name"), F.lit("CEO").alias("title")))
    return t.customer.select(
        F.col("c_custkey").alias("ticker"), F.col("c_name").alias("longName"),
        F.col("c_mktsegment").alias("sector"), officers.alias("companyOfficers"),
    )


def phones(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("phone_number"))


def calls(t: Tables) -> DataFrame:
    """Orders as calls: from the customer to the one seven further on."""
    customers = t.customer.agg(F.count(F.lit(1))).scalar()
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("caller"),
        F.pmod(F.col("o_custkey") + 7, customers).alias("callee"),
        cents("o_totalprice").alias("duration"),
    )


def run_log(t: Tables) -> DataFrame:
    """Events as audit rows: one per step of a run."""
    return t.events.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("tier"),
        F.col("event_id").alias("inserted"),
        F.col("ts").cast("date").alias("logged_on"),
        cents("value").alias("updated"),
    )
