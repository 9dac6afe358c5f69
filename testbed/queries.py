"""The registered queries: each operator over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.dates import as_date, calendar_attributes, lenient_date, year_month
from tallyline.functions.numbers import lenient_double
from tallyline.functions.predicates import differs, recent, reprocess_days
from tallyline.operators import kpis, quality, rates, scd2, states, summary
from tallyline.operators.audit import LOG_SCHEMA, latest_log
from tallyline.operators.calendar import join_calendar
from tallyline.operators.merge import ACTION, delete_where, merge, merge_metrics, update_where
from tallyline.operators.reshape import rename_by_position, unpivot_prices
from tallyline.plans import catalog, loads, reports, schemas
from tallyline.plans.schemas import declare
from tallyline.plans.statements import as_events
from tallyline.settings import scratch_dir
from tallyline.sinks import tables as sinks
from tallyline.sinks.log import append_log, compact_log, read_log
from tallyline.sources import landed, tables
from testbed import inputs
from testbed.inputs import AS_OF, YMD, Tables

REPORT_START = date(1998, 1, 1)
REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[run.__name__] = run
    return run


def bound() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries as callables of (spark, folder)."""

    def bind(run: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: run(Tables(spark, folder))

    return {name: bind(run) for name, run in REGISTRY.items()}


# --- scans and sources ---------------------------------------------------------------------


@query
def q_read_filtered(t: Tables) -> DataFrame:
    path = f"{t.folder}/lineitem.parquet"
    rows = tables.read_table(t.spark, path, "l_shipdate >= '1998-01-01' AND l_returnflag = 'R'")
    return rows.select("l_orderkey", "l_partkey", "l_quantity", inputs.cents("l_extendedprice").alias("cents"))


@query
def q_unpivot_prices(t: Tables) -> DataFrame:
    return unpivot_prices(inputs.prices_wide(t), inputs.TICKERS, inputs.PRICE_FIELDS)


@query
def q_unpivot_statement(t: Tables) -> DataFrame:
    return inputs.statement_raw(t, "income")


@query
def q_json_rates(t: Tables) -> DataFrame:
    return inputs.json_rates(t, with_broken=True)


@query
def q_json_rates_split(t: Tables) -> DataFrame:
    """Files of JSON lists that span lines, read by more tasks than there are files."""
    rate = F.struct(F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"), inputs.cents("o_totalprice").cast("string").alias("valor"))
    lists = t.orders.groupBy(F.floor(F.col("o_orderkey") / 5000).alias("part")).agg(F.collect_list(rate).alias("rates"))
    path = _new_table(t, "lists")
    lists.select(F.to_json("rates", {"pretty": "true"}).alias("value")).write.text(path)
    return landed.json_rates(t.spark, path, "SELIC", YMD, split=True)


@query
def q_run_log_compacted(t: Tables) -> DataFrame:
    """The log of a run for each event, in files by task, after the files of all its days but the last have been merged."""
    path, at = _new_table(t, "log"), F.col("ts").cast("timestamp")
    columns = {"run_id": F.col("user_id").cast("string"), "tier": F.col("event_type"), "inserted": F.col("event_id"), "started_at": at, "logged_at": at}
    schema = tables.empty_table(t.spark, LOG_SCHEMA).schema
    log = t.events.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    paid = F.col("tier") == "purchase"
    for part in (log.where(paid), log.where(~paid)):
        append_log(part, path)
    for _ in range(2):
        compact_log(t.spark, path, date(2024, 1, 31))
    return read_log(t.spark, path).select("run_id", "tier", "inserted", "logged_day")


@query
def q_xml_rates(t: Tables) -> DataFrame:
    return inputs.xml_rates(t, with_broken=True)


@query
def q_profile_flatten(t: Tables) -> DataFrame:
    return landed.flatten_profiles(inputs.profile_records(t), YMD)


@query
def q_distinct_profile(t: Tables) -> DataFrame:
    """Every customer twice, and once again."""
    twice = inputs.profile_records(t).unionByName(inputs.profile_records(t))
    return landed.flatten_profiles(twice, YMD).select("ticker", "longName", "sector", "ymd")


@query
def q_fallback_partition(t: Tables) -> DataFrame:
    """No order is dated after the load day, so the newest earlier day is read."""
    orders = t.orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"))
    new = orders.where(F.col("ymd") > YMD)
    return tables.or_latest_partition(new, orders).select("o_orderkey", "ymd")


@query
def q_tickers_scan(t: Tables) -> DataFrame:
    return landed.with_required(inputs.ticker_documents(t), "Ticker", YMD)


@query
def q_wallet_tickers(t: Tables) -> DataFrame:
    return landed.wallet_tickers(inputs.portfolios(t))


@query
def q_wallet_tickers_by_type(t: Tables) -> DataFrame:
    kinds = F.col("stocks.type").isin("PROMO", "ECONOMY", "SUPPLIER")
    return landed.wallet_tickers(inputs.portfolios(t), kinds)


@query
def q_first_ticker(t: Tables) -> DataFrame:
    return landed.first_ticker(landed.wallet_tickers(inputs.portfolios(t)))


@query
def q_find_limit(t: Tables) -> DataFrame:
    order = ["o_totalprice", "o_orderkey"]
    found = tables.find(t.orders, F.col("o_orderstatus") == "F", limit=50, order=order)
    return found.select("o_orderkey", "o_custkey", inputs.cents("o_totalprice").alias("cents"))


@query
def q_calendar(t: Tables) -> DataFrame:
    return inputs.calendar(t)


@query
def q_high_water_mark(t: Tables) -> DataFrame:
    """Rates already loaded end in 2000; the feed is read from the mark on."""
    feed = inputs.rates(t)
    loaded = feed.where((F.col("rate_type") == "SELIC") & (F.col("rate_date") < "2001-01-01"))
    mark = tables.high_water_mark(loaded, "rate_date")
    return tables.since(feed, "rate_date", mark)


@query
def q_high_water_mark_empty(t: Tables) -> DataFrame:
    """Nothing of the feed's kind is loaded: it is read from the default day on."""
    feed = inputs.rates(t)
    loaded = feed.where(F.col("rate_type") == "NONE")
    return tables.since(feed, "rate_date", tables.high_water_mark(loaded, "rate_date", date(1999, 1, 1)))


# --- upserts -------------------------------------------------------------------------------

KEY = ["o_orderkey"]
PRICE_DIFFERS = "old.o_totalprice <> new.o_totalprice"
ATTRIBUTES = ["o_orderstatus", "o_totalprice", "o_orderpriority"]


def _merged(t: Tables, condition: Column | str | None) -> DataFrame:
    return merge(inputs.merge_old(t), inputs.merge_new(t), KEY, condition)


@query
def q_merge_upsert(t: Tables) -> DataFrame:
    return _merged(t, None)


@query
def q_merge_on_change(t: Tables) -> DataFrame:
    return _merged(t, PRICE_DIFFERS)


@query
def q_merge_recent_window(t: Tables) -> DataFrame:
    """Rows of the 500 days before the load day are updated."""
    days = reprocess_days(AS_OF, start_load=date(2000, 8, 18))
    return _merged(t, recent("o_orderdate", AS_OF, days))


@query
def q_merge_multi_attr(t: Tables) -> DataFrame:
    return _merged(t, differs(ATTRIBUTES))


@query
def q_merge_null_safe(t: Tables) -> DataFrame:
    return _merged(t, differs(inputs.merge_new(t).columns, exclude=KEY, null_safe=True))


@query
def q_merge_shuffle(t: Tables) -> DataFrame:
    """The plan for a source too large to broadcast."""
    return merge(inputs.merge_old(t), inputs.merge_new(t), KEY, PRICE_DIFFERS, strategy="shuffle")


@query
def q_merge_probe(t: Tables) -> DataFrame:
    """The plan for a source that is small beside the table: the table is not shuffled."""
    return merge(inputs.merge_old(t), inputs.merge_new(t), KEY, PRICE_DIFFERS, strategy="probe")


@query
def q_merge_schema_evolution(t: Tables) -> DataFrame:
    """The source lacks the customer and brings the year."""
    source = inputs.merge_new(t).drop("o_custkey").withColumn("order_year", F.year("o_orderdate"))
    return merge(inputs.merge_old(t), source, KEY, PRICE_DIFFERS)


@query
def q_merge_metrics(t: Tables) -> DataFrame:
    return merge_metrics(_merged(t, PRICE_DIFFERS))


@query
def q_delete_where(t: Tables) -> DataFrame:
    """Rows with a null priority stay."""
    return delete_where(inputs.merge_old(t), F.col("o_orderpriority") == "5-LOW")


# --- sinks: written, changed and read back ---------------------------------------------------


def _new_table(t: Tables, name: str) -> str:
    return f"{scratch_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query
def q_sink_upsert(t: Tables) -> DataFrame:
    """Partitioned by a column that has nulls and that updates change."""
    path, partition = _new_table(t, "upsert"), "o_orderpriority"
    sinks.upsert(inputs.merge_old(t), path, KEY, partition=partition)
    sinks.upsert(inputs.merge_new(t), path, KEY, PRICE_DIFFERS, partition)
    return sinks.open_table(t.spark, path, partition)


@query
def q_sink_delete(t: Tables) -> DataFrame:
    path, partition = _new_table(t, "delete"), "o_orderstatus"
    sinks.upsert(inputs.merge_old(t), path, KEY, partition=partition)
    sinks.delete(t.spark, path, "o_orderpriority = '5-LOW'", partition)
    return sinks.open_table(t.spark, path, partition)


@query
def q_sink_versions(t: Tables) -> DataFrame:
    """The current customers, then a snapshot, partitioned by a column that versions change."""
    path, partition, key = _new_table(t, "versions"), "c_mktsegment", ["c_custkey"]
    first = inputs.profile_history(t).where("is_current").drop("end_dt", "is_current")
    sinks.upsert_versions(first, path, key, datetime(2001, 1, 1), partition)
    sinks.upsert_versions(inputs.profile_snapshot(t), path, key, datetime(2001, 12, 31), partition)
    return sinks.open_table(t.spark, path, partition).withColumn("end_dt", F.col("end_dt").cast("timestamp_ntz"))


@query
def q_update_where(t: Tables) -> DataFrame:
    """Two columns of some rows, and a column that is new."""
    assign = {"o_totalprice": F.col("o_totalprice") * 2, "o_orderstatus": "X", "o_note": F.concat(F.lit("was "), F.col("o_orderstatus"))}
    return update_where(inputs.merge_old(t), "o_orderpriority = '5-LOW'", assign)


@query
def q_sink_update(t: Tables) -> DataFrame:
    """Updates by a condition: one that moves rows to a partition that is new and empties another, one that meets nothing and
    inserts, and one that meets what was inserted."""
    path, partition = _new_table(t, "update"), "o_orderstatus"
    sinks.upsert(inputs.merge_old(t), path, KEY, partition=partition)
    sinks.update(t.spark, path, "o_orderstatus = 'P' OR o_orderpriority = '5-LOW'", {"o_totalprice": F.col("o_totalprice") * 2, partition: "X"}, partition)
    for _ in range(2):
        price = F.coalesce(F.col("o_totalprice"), F.lit(0.0)) + 50
        sinks.update(t.spark, path, "o_orderkey = -1", {"o_totalprice": price}, partition, insert={"o_orderkey": -1, partition: "N"})
    return sinks.open_table(t.spark, path, partition)


@query
def q_sink_upsert_feed(t: Tables) -> DataFrame:
    """Keys that contain the partition: only the partitions and files that the feed's keys can be in are read."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    path, partition, keys = _new_table(t, "feed"), "o_month", ["o_month", "o_orderkey"]
    sinks.upsert(inputs.merge_old(t).withColumn(partition, month), path, keys, partition=partition)
    feed = inputs.merge_new(t).withColumn(partition, month).where("o_orderdate >= '2000-10-01'")
    sinks.upsert(feed, path, keys, PRICE_DIFFERS, partition)
    return sinks.open_table(t.spark, path, partition)


@query
def q_sink_versions_late(t: Tables) -> DataFrame:
    """Snapshots of January, March and then February."""
    path, partition, key = _new_table(t, "late"), "c_mktsegment", ["c_custkey"]
    first = inputs.profile_history(t).where("is_current").drop("end_dt", "is_current")
    moved = F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "BUILDING"), "MOVED").otherwise(F.col("c_mktsegment"))
    second, third = inputs.profile_snapshot(t).withColumn(partition, moved), inputs.profile_snapshot(t)
    for month, snapshot in ((1, first), (3, third), (2, second)):
        sinks.upsert_versions(snapshot, path, key, datetime(2001, month, 1), partition)
    return sinks.open_table(t.spark, path, partition).withColumn("end_dt", F.col("end_dt").cast("timestamp_ntz"))


def _new_database(t: Tables) -> str:
    name = f"served_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE `{name}`")
    return name


@query
def q_catalog_in_step(t: Tables) -> DataFrame:
    """A table read by name after an upsert has brought it a column and partitions."""
    path, partition, name = _new_table(t, "named"), "o_year", _new_database(t)
    year = F.year("o_orderdate").cast("string")
    first = sinks.upsert(inputs.merge_old(t).withColumn(partition, year), path, KEY, partition=partition, note_partitions=True)
    catalog.follow(t.spark, name, "orders", first, [partition])
    wider = inputs.merge_new(t).withColumns({partition: year, "o_note": F.concat(F.lit("seen "), F.col("o_orderstatus"))})
    commit = sinks.upsert(wider, path, KEY, PRICE_DIFFERS, partition, note_partitions=True)
    catalog.follow(t.spark, name, "orders", commit, [partition])
    return t.spark.table(f"{name}.orders")


@query
def q_catalog_listing(t: Tables) -> DataFrame:
    """The tables of a database as listed, and the rows of each by name."""
    name = _new_database(t)
    written = {"orders_of_status": (t.orders, "o_orderstatus"), "customers": (t.customer, "c_mktsegment")}
    locations = {table: _new_table(t, table) for table in written}
    for table, (rows, partition) in written.items():
        sinks.write_table(rows, locations[table], partition)
    catalog.register_tables(t.spark, name, locations, {table: [partition] for table, (_, partition) in written.items()})
    counts = [t.spark.table(f"{name}.{table}").agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for table in written]
    listed = catalog.show_tables(t.spark, name).select(F.col("tableName").alias("table_name"), "isTemporary")
    return listed.join(counts[0].unionByName(counts[1]), "table_name").withColumnRenamed("isTemporary", "is_temporary")


@query
def q_empty_table(t: Tables) -> DataFrame:
    """A first load into a typed table without rows."""
    source = inputs.merge_new(t)
    return merge(tables.empty_table(t.spark, source.schema), source, KEY)


@query
def q_schema_equality(t: Tables) -> DataFrame:
    """Tables with the declared schema, with another type, and with another order, with the rows that each has."""
    wanted = {
        "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        "region": "r_regionkey int, r_name string",
        "nation": "n_name string, n_nationkey long, n_regionkey long",
    }
    frames = {"part": t.part.select("p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("int").alias("p_size"), "p_retailprice"),
              "region": t.region.select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name"),
              "nation": t.nation.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))}
    parts = [
        frames[n].agg(F.lit(n).alias("table_name"), F.lit(quality.same_schema(frames[n], declare(s))).alias("same"), F.count(F.lit(1)).alias("n_rows"))
        for n, s in wanted.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def q_multi_file_read(t: Tables) -> DataFrame:
    """Files landed apart, read as one."""
    paths = [_new_table(t, "landed") for _ in range(3)]
    columns = ["o_orderkey", "o_custkey", inputs.cents("o_totalprice").alias("cents")]
    for path, status in zip(paths, ("F", "O", "P"), strict=True):
        t.orders.where(F.col("o_orderstatus") == status).select(*columns).write.parquet(path)
    return t.spark.read.parquet(*paths)


@query
def q_run_log_latest(t: Tables) -> DataFrame:
    return latest_log(inputs.run_log(t), ["run_id", "tier"], "logged_on", ["inserted"])


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


@query
def q_scd2(t: Tables) -> DataFrame:
    return scd2.apply_snapshot(
        inputs.profile_history(t), inputs.profile_snapshot(t), ["c_custkey"], _moment("2001-12-31")
    )


@query
def q_scd2_current(t: Tables) -> DataFrame:
    """The open versions after two runs of one snapshot: the second changes nothing."""
    snapshot, key = inputs.profile_snapshot(t), ["c_custkey"]
    once = scd2.apply_snapshot(inputs.profile_history(t), snapshot, key, _moment("2001-12-30")).drop(ACTION)
    twice = scd2.apply_snapshot(once, snapshot, key, _moment("2001-12-31"))
    return twice.where(F.col("is_current")).select("c_custkey", "c_mktsegment", ACTION)


@query
def q_scd2_schema_evolution(t: Tables) -> DataFrame:
    """A snapshot with a column that the history lacks."""
    tier = F.when(F.col("c_nationkey") % 3 == 0, "gold").alias("c_tier")
    snapshot = inputs.profile_snapshot(t).select("*", tier)
    return scd2.apply_snapshot(inputs.profile_history(t), snapshot, ["c_custkey"], _moment("2001-12-31"))


# --- projections, dates and text -----------------------------------------------------------


@query
def q_rename_schema(t: Tables) -> DataFrame:
    """Nine source fields, eight target names."""
    target = declare("order long, part long, supplier long, line int, quantity double, price double, off double, tax double")
    source = t.lineitem.drop("l_linestatus", "l_shipdate")
    return rename_by_position(source, source.schema, target)


@query
def q_rates_silver(t: Tables) -> DataFrame:
    """Rate text with bad dates and bad numbers among it."""
    return rates.clean_rates(_dirty(inputs.json_rates(t)), "tipo", "data", "valor", "dd/MM/yyyy", keep=("o_orderkey",))


def _dirty(landed_rates: DataFrame) -> DataFrame:
    return landed_rates.select(
        "tipo",
        F.when(F.col("valor").endswith("7"), F.lit("31/02/1999")).otherwise(F.col("data")).alias("data"),
        F.when(F.col("valor").endswith("3"), F.lit("n/d")).otherwise(F.col("valor")).alias("valor"),
        "o_orderkey",
    )


@query
def q_rates_rejects(t: Tables) -> DataFrame:
    """What of the same text, and of payloads that are cut off, can't be read, and why."""
    return rates.rejected_rates(_dirty(inputs.json_rates(t, with_broken=True)), "tipo", "data", "valor", "dd/MM/yyyy", keep=("o_orderkey",))


@query
def q_try_numeric(t: Tables) -> DataFrame:
    """Part names and sizes as numbers: a name gives null."""
    text = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", lenient_double(text).alias("value"))


@query
def q_string_date_fns(t: Tables) -> DataFrame:
    """Calendar attributes and text keys of every order's date."""
    order_day = inputs.day("o_orderdate")
    names = [
        "dt_month", "dt_day", "dt_day_of_week", "dt_day_of_week_short", "dt_week_of_year", "dt_quarter_long",
        "dt_semester_desc", "dt_full_date", "dt_is_weekend", "dt_is_hollyday",
    ]
    attributes = calendar_attributes(order_day)
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    brazilian = F.date_format("o_orderdate", "dd/MM/yyyy")
    return t.orders.select(
        "o_orderkey",
        *[attributes[n].alias(n) for n in names],
        year_month("o_orderdate").alias("year_month"),
        F.split(iso, "-", -1)[1].alias("split_month"),
        F.substring(brazilian, 4, 2).alias("substring_month"),
        lenient_date(brazilian, "dd/MM/yyyy").alias("parsed"),
        F.datediff(as_date(AS_OF), order_day).alias("days_back"),
        F.last_day(order_day).alias("month_end"),
    )


@query
def q_dividends(t: Tables) -> DataFrame:
    return kpis.dividends(inputs.bars(t))


@query
def q_financial_event(t: Tables) -> DataFrame:
    income = as_events(inputs.income(t), schemas.INCOME, "INCOME")
    return income.unionByName(as_events(inputs.balance(t), schemas.BALANCE, "BALANCE"))


@query
def q_join_calendar(t: Tables) -> DataFrame:
    """Every order line with the labels of its ship date, counted by quarter and weekday."""
    lines = t.lineitem.select(inputs.day("l_shipdate").alias("shipped"), "l_quantity")
    labelled = join_calendar(lines, inputs.calendar(t), "shipped", ["dt_quarter_long", "dt_day_of_week_full"])
    return labelled.groupBy("dt_quarter_long", "dt_day_of_week_full").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity")
    )


# --- indicators ----------------------------------------------------------------------------


def _series(t: Tables) -> DataFrame:
    return kpis.checked_series(inputs.bars(t).select("ticker", "price_date", "vl_close"))


@query
def q_zscore(t: Tables) -> DataFrame:
    return kpis.with_zscore(_series(t))


@query
def q_change_day(t: Tables) -> DataFrame:
    return kpis.with_change_day(_series(t))


@query
def q_change_week(t: Tables) -> DataFrame:
    return kpis.with_change_week(_series(t))


@query
def q_change_month(t: Tables) -> DataFrame:
    return kpis.with_change_month(_series(t))


@query
def q_moving_avg(t: Tables) -> DataFrame:
    return kpis.with_moving_averages(_series(t))


@query
def q_price_kpis(t: Tables) -> DataFrame:
    return kpis.daily_kpis(inputs.bars(t))


@query
def q_kpis_incremental(t: Tables) -> DataFrame:
    """The bars in two loads: what is stored, and a feed that brings the later days alone."""
    bars, later = inputs.bars(t), F.col("price_date") >= "2000-01-01"
    feed = bars.where(later)
    return kpis.daily_kpis(bars.where(~later)).unionByName(kpis.kpis_of_feed(bars, feed.select("ticker", "price_date")))


@query
def q_kpis_correction(t: Tables) -> DataFrame:
    """Stored indicators with wrong closes in a quarter, and a feed of that quarter: later days follow it."""
    bars, wrong = inputs.bars(t), F.col("price_date").between("1998-04-01", "1998-06-30")
    keys, stored = ["ticker", "price_date"], bars.withColumn("vl_close", F.when(wrong, F.col("vl_close") * 3 + 1).otherwise(F.col("vl_close")))
    fed = bars.where(wrong).select(*keys)
    return merge(kpis.daily_kpis(stored), kpis.kpis_since_feed(bars, fed), keys).drop(ACTION)


@query
def q_kpis_from_states(t: Tables) -> DataFrame:
    """The later days from their own prices and the state of the month before alone."""
    bars, later = inputs.bars(t), F.col("price_date") >= "2000-01-01"
    held = states.month_states(bars.where(~later))
    before = states.latest_before(held, bars.where(later).groupBy("ticker").agg(F.min("price_date").alias("first")))
    return states.kpis_from_states(bars.where(later), before)


@query
def q_month_states(t: Tables) -> DataFrame:
    """States made in two steps, without the closes that they hold: those of the later months follow the last of the earlier."""
    bars, later = inputs.bars(t), F.col("price_date") >= "2000-01-01"
    held = states.month_states(bars.where(~later))
    before = states.latest_before(held, bars.where(later).groupBy("ticker").agg(F.min("price_date").alias("first")))
    both = held.unionByName(states.month_states(bars.where(later), before))
    closes = F.aggregate("tail", F.lit(0.0), lambda total, close: total + close)
    return both.select("ticker", "month", "last_day", "n", F.rint(F.col("mean") * F.col("n")).alias("total"), F.size("tail").alias("held"), closes.alias("held_closes"))


@query
def q_load_corrected_days(t: Tables) -> DataFrame:
    """Whole loads: all days with wrong prices in some, then the right ones of these. What is served is as if they had been right."""
    bars, wrong = inputs.bars(t), F.col("price_date").between("2000-05-10", "2000-05-12")
    w = loads.Warehouse(t.spark, _new_table(t, "warehouse"), AS_OF)
    fields = {"Open": "vl_open", "High": "vl_high", "Low": "vl_low", "Close": "vl_close", "AdjClose": "vl_close", "Volume": "vl_volume", "Dividends": "vl_dividends"}
    landed_prices = bars.select(
        F.col("ticker").alias("Ticker"), F.col("price_date").cast("string").alias("Date"), *[F.col(c).cast("double").alias(n) for n, c in fields.items()],
        F.lit(0.0).alias("StockSplits"), F.lit(None).cast("double").alias("CapitalGains"), wrong.alias("wrong"),
    )
    stale = landed_prices.withColumn("Close", F.when(F.col("wrong"), F.col("Close") * 2).otherwise(F.col("Close")))
    loads.load_prices(w, stale.drop("wrong"))
    loads.load_prices(w, landed_prices.where("wrong").drop("wrong"), start_load=date(2000, 5, 1))
    columns = ["ticker", "price_date", "vl_close", "z_score", "vl_change_week", "perc_change_month", "vl_moving_avg_20_days", "vl_moving_avg_200_days"]
    return w.read("serving", "prices").select(*columns)


def _months(t: Tables) -> DataFrame:
    return summary.month_summary(kpis.with_moving_averages(kpis.checked_series(inputs.bars(t))))


@query
def q_month_summary(t: Tables) -> DataFrame:
    return _months(t)


@query
def q_month_kpis(t: Tables) -> DataFrame:
    return summary.month_kpis(_months(t))


@query
def q_rate_month(t: Tables) -> DataFrame:
    return rates.month_rates(inputs.rates(t), sequence="o_orderkey")


# --- quality -------------------------------------------------------------------------------


@query
def q_dq_negatives(t: Tables) -> DataFrame:
    return quality.negative_counts(t.customer, ["c_custkey", "c_acctbal"])


@query
def q_dq_nulls(t: Tables) -> DataFrame:
    rows = inputs.merge_old(t)
    return quality.null_counts(rows, rows.columns)


@query
def q_dq_dates(t: Tables) -> DataFrame:
    """Order dates as text: low-priority ones without a day, open ones missing."""
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-MM")).when(
        F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    rows = t.orders.select(text.alias("order_date"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("local_date"))
    return quality.invalid_date_counts(rows, {"order_date": "yyyy-MM-dd", "local_date": "dd/MM/yyyy"})


@query
def q_dq_report(t: Tables) -> DataFrame:
    """Customers fail on their debts, suppliers on a missing column, parts pass, orders fail on nulls."""
    wanted = {
        "customer": (t.customer, declare("c_custkey long!, c_name string!, c_acctbal double")),
        "supplier": (t.supplier, declare("s_suppkey long!, s_phone string")),
        "part": (t.part, declare("p_partkey long!, p_name string!, p_retailprice double!")),
        "orders": (inputs.merge_old(t), declare("o_orderkey long!, o_orderpriority string!, o_totalprice double")),
    }
    parts = [quality.quality_report(df, s).withColumn("table_name", F.lit(n)) for n, (df, s) in wanted.items()]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


@query
def q_ref_integrity(t: Tables) -> DataFrame:
    """Documents without a label."""
    return quality.orphans(t.documents.select("doc_id", "lang", "source"), t.labels, "doc_id", "doc_id")


@query
def q_dq_range(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return quality.out_of_range(rows, "l_quantity", 3.0, 48.0)


@query
def q_dq_timestamps(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", inputs.day("o_orderdate").alias("o_orderdate"))
    return quality.stale_timestamps(rows, "o_orderdate")


@query
def q_outliers(t: Tables) -> DataFrame:
    return quality.outliers(kpis.with_zscore(_series(t)), limit=1.5)


@query
def q_outliers_table(t: Tables) -> DataFrame:
    """Order prices more than 1.7 deviations above the mean of all orders."""
    rows = t.orders.select("o_orderkey", inputs.cents("o_totalprice").alias("cents"))
    return quality.outliers(quality.with_table_zscore(rows, "cents"), limit=1.7)


# --- reports -------------------------------------------------------------------------------


@query
def q_dash_price(t: Tables) -> DataFrame:
    prices = kpis.with_moving_averages(kpis.checked_series(inputs.bars(t)))
    return reports.price_report(prices, inputs.calendar(t), inputs.income(t), AS_OF, "Quarterly", months=24)


@query
def q_dash_dividend(t: Tables) -> DataFrame:
    return reports.dividend_report(kpis.dividends(inputs.bars(t)), REPORT_START)


@query
def q_dash_income(t: Tables) -> DataFrame:
    return reports.income_report(inputs.income(t), inputs.calendar(t))


@query
def q_dash_balance(t: Tables) -> DataFrame:
    return reports.balance_report(inputs.balance(t), inputs.calendar(t))


@query
def q_dash_latest(t: Tables) -> DataFrame:
    return reports.latest_report(kpis.daily_kpis(inputs.bars(t)), inputs.calendar(t))


@query
def q_latest_day(t: Tables) -> DataFrame:
    return reports.latest_day(q_dash_latest(t))


@query
def q_latest_month(t: Tables) -> DataFrame:
    return reports.latest_month(q_dash_latest(t))


@query
def q_latest_against_average(t: Tables) -> DataFrame:
    return reports.latest_against_average(q_dash_latest(t))


@query
def q_dash_rates(t: Tables) -> DataFrame:
    monthly = rates.month_rates(inputs.rates(t), sequence="o_orderkey")
    return reports.rates_report(monthly, inputs.calendar(t), REPORT_START)


# The same for one ticker and one period, as a dashboard asks for them.
ONE = "Brand#11"


@query
def q_dash_price_one(t: Tables) -> DataFrame:
    prices = kpis.with_moving_averages(kpis.checked_series(inputs.bars(t)))
    return reports.price_report(prices, inputs.calendar(t), inputs.income(t), AS_OF, "Annual", ticker=ONE)


@query
def q_dash_price_ten_years(t: Tables) -> DataFrame:
    prices = kpis.with_moving_averages(kpis.checked_series(inputs.bars(t)))
    return reports.price_report(prices, inputs.calendar(t), inputs.income(t), AS_OF, "Quarterly")


@query
def q_dash_dividend_one(t: Tables) -> DataFrame:
    return reports.dividend_report(kpis.dividends(inputs.bars(t)), REPORT_START, ticker=ONE)


@query
def q_dash_income_one(t: Tables) -> DataFrame:
    return reports.income_report(inputs.income(t), inputs.calendar(t), "Annual", ONE)


@query
def q_dash_balance_one(t: Tables) -> DataFrame:
    return reports.balance_report(inputs.balance(t), inputs.calendar(t), "Quarterly", ONE)


@query
def q_dash_latest_one(t: Tables) -> DataFrame:
    return reports.latest_report(kpis.daily_kpis(inputs.bars(t)), inputs.calendar(t), ONE)


@query
def q_call_totals(t: Tables) -> DataFrame:
    """Customers whose calls add up to 3,500,000.00 or more."""
    return reports.call_report(inputs.phones(t), inputs.calls(t), threshold=350_000_000)
