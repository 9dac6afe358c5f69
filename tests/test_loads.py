"""Whole loads, from landed rows to reports."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.operators.quality import DataQualityError
from tallyline.plans import loads, reports, schemas
from tallyline.plans.loads import Warehouse
from tallyline.sinks.tables import selective

DAY_ONE, DAY_TWO = date(2024, 3, 5), date(2024, 3, 6)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"), DAY_ONE)


def prices(spark, days, bump=0.0):
    last = DAY_ONE + timedelta(days=days - 40)
    data = []
    for ticker, base in (("A", 10.0), ("B", 50.0)):
        for i in range(days):
            close = base + i % 7 + bump
            data.append((ticker, str(last - timedelta(days=days - 1 - i)), close, close, close, close, close, 100.0, float(i == 3), 0.0, None))
    return spark.createDataFrame(data, schemas.StructType(schemas.PRICES_RAW.fields[:-1]))


def test_prices(spark, warehouse):
    loads.load_prices(warehouse, prices(spark, 40))
    served = warehouse.read("serving", "prices")
    assert served.count() == 80 and "vl_dividends" not in served.columns
    assert warehouse.read("serving", "dividends").count() == 2
    assert warehouse.read("serving", "prices_month").count() == 6
    # The next day brings one row more, and other closes: only the last days' rows are updated.
    tomorrow = Warehouse(spark, warehouse.root, DAY_TWO, run_id="second")
    loads.load_prices(tomorrow, prices(spark, 41, bump=1.0).where(F.col("Date") > "2024-01-26"))
    served = tomorrow.read("serving", "prices")
    assert served.count() == 82
    log = tomorrow.read("audit", "run_log").where("run_id = 'second' AND tier = 'serving' AND table_name = 'prices'").first()
    assert (log.inserted, log.updated) == (2, 10)


def test_a_day_at_a_time_equals_all_at_once(spark, tmp_path, rows):
    """Twenty days and then one, or all twenty-one: the same tables, indicators and all."""
    data = prices(spark, 40).withColumn("Close", F.col("Close") + F.lit(0.00371))
    late = F.col("Date") == "2024-03-05"
    parts, whole = Warehouse(spark, str(tmp_path / "parts"), DAY_ONE), Warehouse(spark, str(tmp_path / "whole"), DAY_ONE)
    loads.load_prices(parts, data.where(~late))
    loads.load_prices(parts, data.where(late))
    loads.load_prices(whole, data)
    for tier, table in (("cleaned", "prices"), ("serving", "prices"), ("serving", "prices_month"), ("serving", "dividends")):
        assert rows(parts.read(tier, table)) == rows(whole.read(tier, table))


TABLES = (("cleaned", "prices"), ("serving", "prices"), ("serving", "prices_month"), ("serving", "dividends"))


def long_prices(spark, days=300):
    """A year of prices of three tickers that move, with gaps."""
    dice, data = random.Random(8), []
    for ticker, base in (("A", 10.0), ("B", 50.0), ("C", 7.0)):
        for i in range(days):
            base = round(max(base + dice.uniform(-1, 1.05), 3.0), 3)
            if dice.random() < 0.9:
                data.append((ticker, str(DAY_ONE - timedelta(days=days - 1 - i)), base, base + 1, max(base - 1, 0.5), base, base, 100.0, float(dice.random() < 0.05), 0.0, None))
    return spark.createDataFrame(data, schemas.StructType(schemas.PRICES_RAW.fields[:-1]))


def same_tables(a, b, rows):
    for tier, table in TABLES:
        columns = sorted(a.read(tier, table).columns)
        assert rows(a.read(tier, table), *columns) == rows(b.read(tier, table), *columns), table


def test_a_correction_brings_later_days_up_to_date(spark, tmp_path, rows):
    """A feed that corrects two days in the middle, and one that brings a day left out: as if all had been right at once."""
    right = long_prices(spark)
    middle = F.col("Date").isin("2023-11-08", "2023-12-20") & (F.col("Ticker") != "C")
    wrong = right.withColumn("Close", F.when(middle, F.col("Close") * 2).otherwise(F.col("Close")))
    left_out = (F.col("Ticker") == "C") & F.col("Date").between("2023-12-01", "2023-12-04")
    parts, whole = Warehouse(spark, str(tmp_path / "parts"), DAY_ONE), Warehouse(spark, str(tmp_path / "whole"), DAY_ONE)
    loads.load_prices(parts, wrong.where(~left_out))
    loads.load_prices(parts, right.where(middle | left_out), start_load=date(2023, 11, 1))
    loads.load_prices(whole, right)
    same_tables(parts, whole, rows)
    state = "prices_state"
    assert rows(parts.read("cleaned", state), "ticker", "month", "last_day", "n", "tail") == rows(whole.read("cleaned", state), "ticker", "month", "last_day", "n", "tail")


def test_a_new_ticker_and_a_load_that_failed(spark, tmp_path, rows, monkeypatch):
    """Days of known tickers and of a new one; then a load is cut short after the states, and the next one reads all days."""
    data = long_prices(spark)
    last, day_before = F.col("Date") == "2024-03-05", F.col("Date") == "2024-03-04"
    parts, whole = Warehouse(spark, str(tmp_path / "parts"), DAY_ONE), Warehouse(spark, str(tmp_path / "whole"), DAY_ONE)
    loads.load_prices(parts, data.where(~last & ~day_before & (F.col("Ticker") != "B")))
    loads.load_prices(parts, data.where(day_before & (F.col("Ticker") != "B") | ~last & (F.col("Ticker") == "B")))
    merge = Warehouse.merge

    def fail(self, rows, tier, table, *a, **k):
        if (tier, table) == ("cleaned", "prices"):
            raise RuntimeError("driver lost")
        return merge(self, rows, tier, table, *a, **k)

    monkeypatch.setattr(Warehouse, "merge", fail)
    with pytest.raises(RuntimeError):
        loads.load_prices(parts, data.where(last))
    monkeypatch.undo()
    loads.load_prices(parts, data.where(last))
    loads.load_prices(whole, data)
    same_tables(parts, whole, rows)


def test_a_load_of_one_day_reads_one_state_and_one_month(spark, warehouse, monkeypatch):
    data = long_prices(spark)
    last = F.col("Date") == "2024-03-05"
    loads.load_prices(warehouse, data.where(~last))
    seen = {}
    days, states_of = loads._days, loads.states.latest_before

    def noted(name, found):
        seen[name] = (found, found._jdf.queryExecution().executedPlan().toString(), found.collect())
        return found

    monkeypatch.setattr(loads, "_days", lambda *a: noted("days", days(*a)))
    monkeypatch.setattr(loads.states, "latest_before", lambda *a: noted("states", states_of(*a)))
    loads.load_prices(warehouse, data.where(last))
    assert "GreaterThanOrEqual(Date,2024-03-01)" in seen["days"][1]
    assert {(r.price_date.year, r.price_date.month) for r in seen["days"][2]} == {(2024, 3)}
    assert {(r.month, len(r.tail)) for r in seen["states"][2]} == {(date(2024, 2, 1), 200)}
    assert "dynamicpruning" in seen["states"][1]


def test_tickers_of_digits_stay_text(spark, tmp_path, rows):
    w = Warehouse(spark, str(tmp_path / "w"), DAY_ONE)
    coded = prices(spark, 30).withColumn("Ticker", F.when(F.col("Ticker") == "A", "005930").otherwise("1E5")).withColumn("Dividends", F.lit(0.0))
    loads.load_prices(w, coded)  # a first load without a dividend
    loads.load_prices(w, coded.withColumn("Close", F.col("Close") + 1))
    assert rows(w.read("serving", "prices").select("ticker").distinct()) == [("005930",), ("1E5",)]
    assert rows(w.read("serving", "prices_month").select("ticker").distinct()) == [("005930",), ("1E5",)]
    assert w.read("serving", "dividends").count() == 0


def test_read_backs_are_pruned_to_the_tickers_of_the_feed(spark, warehouse):
    loads.load_prices(warehouse, prices(spark, 40))
    feed = f"{warehouse.root}/feed"
    prices(spark, 40).where("Ticker = 'A'").select(F.col("Ticker").alias("ticker")).write.parquet(feed)
    fed = selective(spark.read.parquet(feed).distinct(), "ticker")
    plan = warehouse.read("cleaned", "prices").join(fed, "ticker", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_bad_prices_do_not_get_past_the_raw_tier(spark, warehouse):
    bad = prices(spark, 40).withColumn("Low", F.when(F.col("Date") < "2024-02-01", -1.0).otherwise(F.col("Low")))
    with pytest.raises(DataQualityError, match="has_negatives"):
        loads.load_prices(warehouse, bad)
    assert warehouse.find("raw", "prices") is not None
    assert warehouse.find("cleaned", "prices") is None
    log = warehouse.read("audit", "run_log").where("tier = 'load'")
    ends = {r.status: r.message for r in log.collect()}
    assert set(ends) == {"started", "failed"} and "has_negatives" in ends["failed"]


def test_what_has_landed_is_made_once(spark, warehouse):
    """However many steps read it: a load's source may be joins and aggregates over large tables (F1)."""
    made = spark.sparkContext.accumulator(0)

    def counted(rows):
        def each(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        return rows.mapInArrow(each, rows.schema)

    loads.load_prices(warehouse, counted(prices(spark, 5)))
    assert made.value == 10
    rates = spark.createDataFrame([("SELIC", "05/03/2024", "11.25", "20240305"), ("SELIC", "no day", "1", "20240305")], schemas.JSON_RATES_RAW)
    loads.load_rates(warehouse, counted(rates), schemas.JSON_RATES_RAW, "dd/MM/yyyy", "selic")
    assert made.value == 12
    ends = warehouse.read("audit", "run_log").where("tier = 'load' AND status = 'done'")
    assert {r.table_name: r.total_records_source for r in ends.collect()} == {"prices": 10, "selic": 2}


def test_statements_tickers_and_reports(spark, warehouse, rows):
    income = spark.createDataFrame(
        [("Annual", "A", "Net Income", "2024-02-29", 5.0, "20240305"), ("Annual", "A", "Total Revenue", "2024-02-29", 50.0, "20240305")],
        schemas.STATEMENT_RAW,
    )
    loads.load_prices(warehouse, prices(spark, 40))
    loads.load_statement(warehouse, income, "income")
    loads.load_statement(warehouse, income.withColumn("Description", F.lit("Total Assets")).limit(1), "balance")
    loads.load_calendar(warehouse)
    assert rows(warehouse.read("serving", "financial_event"), "event_type") == [("BALANCE",), ("INCOME",), ("INCOME",)]
    report = reports.income_report(warehouse.read("serving", "income"), warehouse.read("serving", "calendar"))
    assert [r.Profit_Margin for r in report.collect()] == [10.0]
    changed = income.withColumn("Value", F.col("Value") * 2)
    loads.load_statement(warehouse, changed, "income")
    assert rows(warehouse.read("serving", "income"), "income_value") == [(10.0,), (100.0,)]
    latest = reports.latest_report(warehouse.read("serving", "prices"), warehouse.read("serving", "calendar"))
    assert latest.count() == 2


def test_rates(spark, warehouse, rows):
    def feed(*days):
        data = [("EFFR", d, v, "20240305") for d, v in days]
        return spark.createDataFrame(data, schemas.XML_RATES_RAW)

    first = feed(("2024-01-03", "5.1"), ("2024-01-31", "5.2"), ("2024-02-05", "5.3"))
    loads.load_rates(warehouse, first, schemas.XML_RATES_RAW, "yyyy-MM-dd", "effr", monthly=True)
    loads.load_rates(warehouse, feed(("2023-01-01", "9.9"), ("2024-02-06", "5.4"), ("2024-03-01", "5.5")), schemas.XML_RATES_RAW, "yyyy-MM-dd", "effr", monthly=True)
    local = spark.createDataFrame([("SELIC", "05/03/2024", "10.5", "20240305")], schemas.JSON_RATES_RAW)
    loads.load_rates(warehouse, local, schemas.JSON_RATES_RAW, "dd/MM/yyyy", "selic")
    assert rows(warehouse.read("serving", "interest_rate"), "rate_type", "rate_date", "rate_value") == [
        ("EFFR", date(2024, 1, 1), 5.2), ("EFFR", date(2024, 2, 1), 5.4), ("EFFR", date(2024, 3, 1), 5.5),
        ("SELIC", date(2024, 3, 5), 10.5),
    ]


def test_tickers_and_profiles(spark, warehouse, rows):
    tickers = spark.createDataFrame([("1", "Stock", "A", "Name", None, None, "US", "20240305")], schemas.TICKERS_RAW)
    loads.load_tickers(warehouse, tickers)
    loads.load_tickers(warehouse, tickers.withColumn("Name", F.lit("Other")))
    assert rows(warehouse.read("serving", "tickers"), "ticker_name") == [("Other",)]
    values = [str(i) if f.dataType.simpleString() == "string" else 1 if "int" in f.dataType.simpleString() else 1.0 for i, f in enumerate(schemas.PROFILE_RAW)]
    profile = spark.createDataFrame([tuple(values)], schemas.PROFILE_RAW)
    loads.load_profiles(warehouse, profile)
    loads.load_profiles(warehouse, profile.withColumn("ymd", F.lit("20240306")))
    assert warehouse.read("serving", "profile").count() == 1
    loads.load_profiles(warehouse, profile.withColumn("city", F.lit("Porto")))
    assert rows(warehouse.read("serving", "profile"), "city", "is_current") == [("3", False), ("Porto", True)]




def test_rates_that_cannot_be_read_are_kept_as_rejects(spark, tmp_path, rows):
    """The same on a first run and on a later one; and one lower bound for all, whatever is stored."""
    feed = spark.createDataFrame(
        [("EFFR", "2001-05-05", "1.0", "20240305"), ("EFFR", "2013-01-01", "1.1", "20240305"), ("EFFR", "x", "1.2", "20240305"),
         ("EFFR", "2013-01-03", "n/d", "20240305"), ("EFFR", None, None, "20240305")],
        schemas.StructType([schemas.StructField(f.name, f.dataType) for f in schemas.XML_RATES_RAW]),
    )
    w = Warehouse(spark, str(tmp_path / "w"), DAY_ONE)
    other = feed.withColumn("typeRate", F.lit("SELIC"))
    for _ in range(2):
        loads.load_rates(w, feed, schemas.XML_RATES_RAW, "yyyy-MM-dd", "effr")
        assert rows(w.read("raw", "effr_rejects"), "reason") == [("date",), ("payload",), ("value",)]
    loads.load_rates(w, other, schemas.XML_RATES_RAW, "yyyy-MM-dd", "selic")
    assert rows(w.read("serving", "interest_rate"), "rate_type", "rate_date") == [("EFFR", date(2013, 1, 1)), ("SELIC", date(2013, 1, 1))]


def test_profiles_without_a_uuid_and_the_fallback(spark, warehouse, rows):
    fields = [f for f in schemas.PROFILE_RAW if f.name != "uuid"]
    values = {f.name: "t" if f.dataType.simpleString() == "string" else 1 if "int" in f.dataType.simpleString() else 1.0 for f in fields}
    profile = spark.createDataFrame([tuple(values.values())], schemas.StructType(fields))
    loads.load_profiles(warehouse, profile)
    loads.load_profiles(warehouse, profile.withColumn("city", F.lit("Porto")))
    loads.load_profiles(warehouse, profile.where("false"))
    assert rows(warehouse.read("serving", "profile"), "city", "is_current") == [("Porto", True), ("t", False)]


def test_from_landed_files_to_reports(spark, tmp_path, rows):
    w, files = Warehouse(spark, str(tmp_path / "w"), DAY_ONE), tmp_path / "landed"
    files.mkdir()
    days = [DAY_ONE - timedelta(days=i) for i in range(30)]
    names = [f"{t}__{f}" for t in ("A", "007") for f in ("Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits")]
    lines = [",".join(["Date", *names])] + [",".join([str(d), *[str(10.0 + i)] * len(names)]) for i, d in enumerate(days)]
    (files / "prices.csv").write_text("\n".join(lines))
    loads.load_price_files(w, str(files / "prices.csv"), ["A", "007"])
    for period in ("annual", "quarterly"):
        (files / f"{period}.csv").write_text("Ticker,Description,2024-02-29\nA,Net Income,5\nA,Total Revenue,50\nA,Other,none\n")
    loads.load_statement_files(w, str(files / "annual.csv"), str(files / "quarterly.csv"), "income")
    (files / "selic.json").write_text('[{"data": "05/03/2024", "valor": "10.5"}, {"data": "06/03/2024", "valor": "x"}]')
    loads.load_rate_files(w, str(files / "selic.json"), "selic", "json")
    (files / "effr.xml").write_text("<r><rate><effectiveDate>2024-03-05</effectiveDate><percentRate>5.3</percentRate></rate></r>")
    loads.load_rate_files(w, str(files / "effr.xml"), "effr", "xml")
    loads.load_calendar(w)
    calendar = w.read("serving", "calendar")
    latest = reports.latest_report(w.read("serving", "prices"), calendar)
    assert rows(latest, "ticker", "vl_close") == [("007", 10.0), ("A", 10.0)]
    income = reports.income_report(w.read("serving", "income"), calendar, "Annual", "A")
    assert [r.Profit_Margin for r in income.collect()] == [10.0]
    assert rows(w.read("serving", "interest_rate"), "rate_type", "rate_value") == [("EFFR", 5.3), ("SELIC", 10.5)]
    assert rows(w.read("raw", "selic_rejects"), "rate_value", "reason") == [("x", "value")]
    log = w.read("audit", "run_log").where("tier = 'load' AND status = 'done'")
    assert rows(log, "table_name", "source_type", "total_records_source") == [
        ("effr", "xml", 1), ("income", "csv", 6), ("prices", "csv", 60), ("selic", "json", 2),
    ]
