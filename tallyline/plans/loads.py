"""Whole loads: landed rows into the raw, cleaned and serving tables.

Each tier is written, read back, and only then used for the next, so a load has no long
lineage: a lost executor costs one tier's tasks. What has landed is written once, and a load
reads that: many steps need it, and each would make it anew from where it comes from. A load
logs its start, every table it changes, and how it ended.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.functions.predicates import differs, recent, reprocess_days
from tallyline.operators import states
from tallyline.operators.audit import DONE, FAILED, STARTED, log_row
from tallyline.operators.calendar import calendar_from
from tallyline.operators.kpis import daily_kpis, dividends, from_first_fed
from tallyline.operators.quality import require_quality
from tallyline.operators.rates import clean_rates, month_rates, rejected_rates, usable_rates
from tallyline.operators.reshape import rename_by_position, unpivot_prices
from tallyline.operators.scd2 import CURRENT
from tallyline.operators.summary import month_kpis, month_summary
from tallyline.plans import schemas
from tallyline.plans.statements import as_events, clean_statement, raw_statement
from tallyline.sinks.catalog import follow
from tallyline.sinks.log import append_log, compact_log, read_log
from tallyline.sinks.tables import Commit, open_table, selective, staging, upsert, upsert_versions, write_table
from tallyline.sources import landed as files
from tallyline.sources.tables import LOAD_START, empty_table, high_water_mark, or_latest_partition, read_table, since, table_path

RAW, CLEANED, SERVING, AUDIT = "raw", "cleaned", "serving", "audit"

# Match keys and partition columns of the tables.
PRICE_KEYS = ["ticker", "price_date"]
DIVIDEND_KEYS = ["ticker", "ex_date"]
MONTH_KEYS = ["ticker", "dt_year", "dt_month"]
STATEMENT_KEYS = ["Ticker", "Description", "Date", "Period"]
RATE_KEYS = ["rate_type", "rate_date"]
TICKER_KEYS = ["ticker_type", "ticker"]
PARTITIONS = {
    "prices": "ticker", "prices_month": "ticker", "dividends": "ticker", "financial_event": "ticker", "interest_rate": "rate_type",
    "tickers": "ticker_type", "profile": "ticker_type", "calendar": "dt_year", "income": "ticker", "balance": "ticker",
}
CLEANED_PARTITIONS = PARTITIONS | {"prices_state": "ticker", "income": "income_period", "balance": "balance_period"}


@dataclass
class Warehouse:
    """Where the tables are, and the day the load is for. Serving tables are kept known by name in ``database``, if one is given."""

    spark: SparkSession
    root: str
    as_of: date
    database: str | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def ymd(self) -> str:
        return self.as_of.strftime("%Y%m%d")

    def path(self, tier: str, table: str) -> str:
        return table_path(self.root, tier, table)

    def find(self, tier: str, table: str) -> DataFrame | None:
        """The table, or None if it is not there yet. Declared tables are read without looking at the files' footers."""
        if (tier, table) == (AUDIT, "run_log"):
            return read_log(self.spark, self.path(tier, table))
        declared = self.declared().get((tier, table))
        partition = "ymd" if tier == RAW else (CLEANED_PARTITIONS if tier == CLEANED else PARTITIONS).get(table, "rate_type")
        return open_table(self.spark, self.path(tier, table), None if tier == AUDIT else partition, declared, declared)

    def read(self, tier: str, table: str, condition: Column | str | None = None) -> DataFrame:
        found = self.find(tier, table)
        if found is None:
            found = read_table(self.spark, self.path(tier, table))  # says what is missing
        return found if condition is None else found.where(condition)

    def declared(self) -> dict[tuple[str, str], StructType]:
        """Schemas of the price tables, the ones with many partitions: what their own operators give."""
        if not hasattr(self, "_declared"):
            raw = empty_table(self.spark, schemas.PRICES_RAW)
            prices = daily_kpis(rename_by_position(raw, schemas.PRICES_RAW, schemas.PRICES))
            self._declared = {
                (RAW, "prices"): schemas.PRICES_RAW,
                (CLEANED, "prices"): prices.schema,
                (CLEANED, "prices_state"): empty_table(self.spark, f"ticker string, {states.STATE}").schema,
                (SERVING, "prices"): _served(prices).schema,
                (SERVING, "dividends"): dividends(prices).schema,
                (SERVING, "prices_month"): month_kpis(month_summary(_served(prices))).schema,
            }
        return self._declared

    def merge(
        self,
        rows: DataFrame,
        tier: str,
        table: str,
        keys: Sequence[str],
        update_when: Column | str,
        partition: str,
        reprocessed: bool = False,
    ) -> Commit:
        """Upserts into a table and logs what it did."""
        started = _now()
        named = self.database is not None and tier == SERVING
        commit = upsert(rows, self.path(tier, table), keys, update_when, partition, self.declared().get((tier, table)), note_partitions=named)
        if named:
            follow(self.spark, self.database, table, commit, [partition])
        self.log(tier, table, started, commit=commit, reprocessed=reprocessed)
        return commit

    def ended_well(self, table: str) -> bool:
        """Whether the load of a table before the one that runs now came to its end; true if there was none."""
        log = self.find(AUDIT, "run_log")
        if log is None:
            return True
        loads = log.where((F.col("tier") == "load") & (F.col("table_name") == table)).orderBy(F.desc("logged_at"))
        return [r["status"] for r in loads.select("status").limit(2).collect()][1:] in ([], [DONE])

    def log(self, tier: str, table: str, started: datetime, *, commit: Commit | None = None, **columns) -> None:
        if commit is not None:
            columns |= {"location": commit.path, "metrics": commit.metrics, "source_rows": commit.source}
        append_log(log_row(self.spark, self.run_id, tier, table, started, _now(), **columns), self.path(AUDIT, "run_log"))

    def compact_log(self) -> int:
        """Merges the run log's files of the days before the load day; how many days that were."""
        return compact_log(self.spark, self.path(AUDIT, "run_log"), self.as_of)

    @contextmanager
    def run(
        self, table: str, landed: DataFrame, source: tuple[str | None, str | None, str | None] = (None, None, None), columns: Sequence[str] | None = None
    ) -> Iterator[DataFrame]:
        """Logs that a load has started, and how it ended; a failure goes on. Gives the landed rows (all columns, or those named) as
        a table that is written once."""
        started = _now()
        self.log("load", table, started, status=STARTED, source=source)
        try:
            with staging(self.spark, self.path(RAW, table)) as stage:
                staged = stage.keep(landed if columns is None else landed.select(*columns))
                yield staged
                arrived = staged.count()
        except Exception as failure:
            self.log("load", table, started, status=FAILED, source=source, message=f"{type(failure).__name__}: {failure}"[:500])
            raise
        self.log("load", table, started, status=DONE, source=source, source_rows=arrived)


Source = tuple[str | None, str | None, str | None]
UNNAMED: Source = (None, None, None)


def load_prices(w: Warehouse, landed: DataFrame, start_load: date | None = None, source: Source = UNNAMED) -> None:
    """Daily prices: raw, quality gate, states, indicators, dividends, prices and months.

    A feed changes its tickers' days from the earliest that it brings on, so a corrected day brings the days and months after it
    up to date. Earlier days are not read: the table of states has what indicators need of them. A feed of one
    day gets those of a feed that goes back to the first. ``start_load`` widens the update window back to that day, to
    correct or reload history. After a load that failed, and for tickers without a state, all stored days are read.
    """
    with w.run("prices", landed, source) as landed:
        _load_prices(w, landed, start_load)


def _load_prices(w: Warehouse, landed: DataFrame, start_load: date | None) -> None:
    days = reprocess_days(w.as_of, start_load)

    def save(rows: DataFrame, tier: str, table: str, keys: list[str], day: str, partition: str = "ticker") -> None:
        w.merge(rows, tier, table, keys, recent(day, w.as_of, days), partition, reprocessed=start_load is not None)

    trusted = w.ended_well("prices")
    raw = landed.withColumn("ymd", F.lit(w.ymd))
    save(raw, RAW, "prices", ["Ticker", "Date"], "Date", "ymd")
    require_quality(raw, schemas.PRICES_RAW)  # what fails stays in the raw tier, to be looked at
    fed = raw.select(F.col("Ticker").alias("ticker"), F.col("Date").cast("date").alias("price_date")).distinct()
    firsts = fed.groupBy("ticker").agg(F.min("price_date").alias("first"))
    held = w.find(CLEANED, "prices_state") if trusted else None
    before = states.latest_before(held.join(selective(firsts.select("ticker"), "ticker"), "ticker", "left_semi"), firsts) if held is not None else None
    with staging(w.spark, w.path(CLEANED, "prices_state")) as stage:
        whole = stage.keep(_days(w, fed, _bounds(firsts, before, w.find(CLEANED, "prices"))))
        before = stage.keep(empty_table(w.spark, f"ticker string, {states.STATE}") if before is None else before)
        w.merge(states.month_states(whole, before), CLEANED, "prices_state", states.KEYS, F.lit(True), "ticker", reprocessed=start_load is not None)
        save(from_first_fed(states.kpis_from_states(whole, before), fed), CLEANED, "prices", PRICE_KEYS, "price_date")
    # One frame feeds two tables: the indicators are written once and read back, from the feed's first days on.
    tickers = selective(firsts.select("ticker"), "ticker")
    prices = from_first_fed(w.read(CLEANED, "prices").join(tickers, "ticker", "left_semi"), fed)
    save(dividends(prices), SERVING, "dividends", DIVIDEND_KEYS, "ex_date")
    save(_served(prices), SERVING, "prices", PRICE_KEYS, "price_date")
    save(_months(w, firsts, trusted), SERVING, "prices_month", MONTH_KEYS, "price_date")


def _bounds(firsts: DataFrame, before: DataFrame | None, stored: DataFrame | None) -> DataFrame:
    """For each ticker the day from which its days are read: the first that its state does not have, the first of the feed's month
    if nothing is stored of it, else null for all of them."""
    bounds = firsts.select("ticker", F.trunc("first", "MM").alias("first"))
    if before is not None:
        ends = before.select("ticker", F.date_add(F.last_day("month"), 1).alias("next"))
        bounds = bounds.join(ends, "ticker", "left")
    else:
        bounds = bounds.withColumn("next", F.lit(None).cast("date"))
    if stored is not None:
        without = selective(bounds.where("next IS NULL").select(F.col("ticker").alias("_of")), "_of")
        known = stored.join(without, F.col("ticker") == F.col("_of"), "left_semi").select(F.col("ticker").alias("_known")).distinct()
        bounds = bounds.join(known, F.col("ticker") == F.col("_known"), "left")
    else:
        bounds = bounds.withColumn("_known", F.lit(None).cast("string"))
    return bounds.select("ticker", F.coalesce("next", F.when(F.col("_known").isNull(), F.col("first"))).alias("since"))


def _days(w: Warehouse, fed: DataFrame, bounds: DataFrame) -> DataFrame:
    """The exact prices of the feed's tickers from their bounds on. They are in the raw tier; of its rows those count that are in
    the feed or have passed the gate before."""
    lowest = bounds.agg(F.when(F.count("*") == F.count("since"), F.min("since")).alias("day")).first()["day"]
    tickers = selective(bounds.select("ticker"), "ticker")
    passed, stored = fed, w.find(CLEANED, "prices")
    history = w.read(RAW, "prices")
    if lowest is not None:
        # as text, which the files' statistics are of; what does not start with a digit is no plain date and is looked at too
        history = history.where((F.col("Date") >= str(lowest)) | (F.col("Date") < "0"))
        stored = stored.where(F.col("price_date") >= F.lit(lowest)) if stored is not None else None
    if stored is not None:
        passed = fed.union(stored.join(tickers, "ticker", "left_semi").select(*PRICE_KEYS)).distinct()
    named = rename_by_position(history, schemas.PRICES_RAW, schemas.PRICES)
    series = named.withColumn("price_date", F.col("price_date").cast("date")).join(passed, PRICE_KEYS, "left_semi")
    bound = bounds.withColumnsRenamed({"ticker": "_of", "since": "_since"})
    inside = (F.col("ticker") == F.col("_of")) & (F.col("_since").isNull() | (F.col("price_date") >= F.col("_since")))
    return series.join(bound, inside, "left_semi").select(*schemas.PRICES.fieldNames())


def _months(w: Warehouse, firsts: DataFrame, trusted: bool) -> DataFrame:
    """The months from the feed's first on, summed from their days; the months before come as they are stored."""
    starts = firsts.select(F.col("ticker").alias("_of"), F.trunc("first", "MM").alias("_start"))
    tickers = selective(firsts.select("ticker"), "ticker")
    served, stored = w.read(SERVING, "prices"), w.find(SERVING, "prices_month") if trusted else None
    own = F.col("ticker") == F.col("_of")
    if stored is None:
        months = month_summary(served.join(tickers, "ticker", "left_semi"))
    else:
        lowest = starts.agg(F.min("_start")).first()[0]
        days = served.where(F.col("price_date") >= F.lit(lowest)).join(tickers, "ticker", "left_semi")
        new = month_summary(days.join(starts, own & (F.col("price_date") >= F.col("_start")), "left_semi"))
        earlier = stored.join(tickers, "ticker", "left_semi").join(starts, own & (F.col("price_date") < F.col("_start")), "left_semi")
        months = earlier.select(*new.columns).unionByName(new)
    return month_kpis(months).join(starts, own & (F.col("price_date") >= F.col("_start")), "left_semi")


def _served(prices: DataFrame) -> DataFrame:
    return prices.drop("vl_dividends", "vl_splits", "vl_capital_gains")


def load_statement(w: Warehouse, landed: DataFrame, kind: str, source: Source = UNNAMED) -> None:
    """An income or balance statement, and its rows in the table of financial events.

    A cell that is not a number is a row without a value: it is kept in the raw tier and goes
    no further, as values are declared not null.
    """
    schema = {"income": schemas.INCOME, "balance": schemas.BALANCE}[kind]
    with w.run(kind, landed, source) as landed:
        w.merge(landed, RAW, kind, STATEMENT_KEYS, differs(["Value"]), "ymd")
        cleaned = clean_statement(landed.where("Value IS NOT NULL"), schema)
        keys = ["ticker", f"{kind}_description", f"{kind}_report_date", f"{kind}_period"]
        changed = differs([f"{kind}_value"])
        w.merge(cleaned, CLEANED, kind, keys, changed, f"{kind}_period")
        w.merge(cleaned, SERVING, kind, keys, changed, "ticker")
        event_keys = ["ticker", "event_description", "event_report_date", "event_period", "event_type"]
        events = as_events(cleaned, schema, kind.upper())
        w.merge(events, SERVING, "financial_event", event_keys, differs(["event_value"]), "ticker")


def load_rates(
    w: Warehouse, landed: DataFrame, raw_schema: StructType, pattern: str, table: str, monthly: bool = False, source: Source = UNNAMED
) -> None:
    """Interest rates from the day last loaded on, or from the first day of all loads; ``monthly`` keeps the last rate of each
    month. What can't be read goes to a table of rejects beside the raw one, the day's rejects anew on every run."""
    kind, day, value, _ = raw_schema.fieldNames()
    with w.run(table, landed, source) as landed:
        rejects = rejected_rates(landed, kind, day, value, pattern)
        write_table(rejects, w.path(RAW, f"{table}_rejects"), "ymd", "overwrite", partitionOverwriteMode="dynamic")
        rates = usable_rates(clean_rates(landed, kind, day, value, pattern))
        stored = w.find(SERVING, "interest_rate")
        loaded = rates.where(F.lit(False)) if stored is None else stored.where(F.col("rate_type") == table.upper())
        rates = since(rates, "rate_date", high_water_mark(loaded, "rate_date", LOAD_START))
        w.merge(landed.dropna("any", subset=[kind, day]), RAW, table, [kind, day], differs([value]), "ymd")
        if monthly:
            rates = month_rates(rates).withColumn("ymd", F.lit(w.ymd))
        for tier, name in ((CLEANED, table), (SERVING, "interest_rate")):
            w.merge(rates, tier, name, RATE_KEYS, differs(["rate_value"]), "rate_type")


def load_tickers(w: Warehouse, landed: DataFrame) -> None:
    """The ticker dimension."""
    attributes = ["Name", "Exchange", "Category_Name", "Country"]
    w.merge(landed, RAW, "tickers", ["Type", "Ticker"], differs(attributes), "ymd")
    named = rename_by_position(landed, schemas.TICKERS_RAW, schemas.TICKERS)
    changed = differs(["ticker_name", "ticker_exchange", "ticker_category", "ticker_country"])
    for tier in (CLEANED, SERVING):
        w.merge(named, tier, "tickers", TICKER_KEYS, changed, "ticker_type")


def load_profiles(w: Warehouse, landed: DataFrame, source: Source = UNNAMED) -> None:
    """Company profiles, versioned in the serving tier. They are matched by ``uuid`` if the feed has one, else by ticker. A
    feed without rows falls back to the newest day that the raw tier holds."""
    names = [c for c in schemas.PROFILE_RAW.fieldNames() if c != "uuid" or "uuid" in landed.columns]
    key = "uuid" if "uuid" in landed.columns else "ticker"
    raw_schema = StructType([f for f in schemas.PROFILE_RAW if f.name in names])
    target = StructType([schemas.PROFILE.fields[schemas.PROFILE_RAW.fieldNames().index(n)] for n in names])
    with w.run("profile", landed, source, names) as raw:
        w.merge(raw, RAW, "profile", [key], differs(names, exclude=[key]), "ymd")
        raw = or_latest_partition(raw, w.read(RAW, "profile").select(*names))
        named = rename_by_position(raw, raw_schema, target)
        own = "id_profile" if key == "uuid" else key
        w.merge(named, CLEANED, "profile", [own], differs(named.columns, exclude=[own]), "ticker_type")
        started = _now()
        as_of = datetime.combine(w.as_of, datetime.min.time())
        # The load day is not an attribute of the company: a new day alone makes no new version.
        commit = upsert_versions(named.drop("ymd"), w.path(SERVING, "profile"), [own], as_of, "ticker_type")
        if w.database is not None:
            follow(w.spark, w.database, "profile", commit, [CURRENT, "ticker_type"])
        w.log(SERVING, "profile", started, commit=commit)


def load_calendar(w: Warehouse) -> None:
    """The calendar, from the first price to the load day."""
    days = calendar_from(w.read(SERVING, "prices"), "price_date", w.as_of, whole_years=True)
    w.merge(days, SERVING, "calendar", ["dt_date"], recent("dt_date", w.as_of), "dt_year")


# From landed files --------------------------------------------------------------------------

# Fields of the price feed and the raw columns they become.
PRICE_FIELDS = {
    "Open": "Open", "High": "High", "Low": "Low", "Close": "Close", "Adj Close": "AdjClose", "Volume": "Volume",
    "Dividends": "Dividends", "Stock Splits": "StockSplits", "Capital Gains": "CapitalGains",
}


def load_price_files(w: Warehouse, path: str, tickers: Sequence[str], start_load: date | None = None) -> None:
    """Wide price files (CSV with a header, ``ticker__field`` columns) to all price tables."""
    wide = w.spark.read.option("header", True).csv(path)
    fields = {f: out for f, out in PRICE_FIELDS.items() if any(f"{t}__{f}" in wide.columns for t in tickers)}
    long = unpivot_prices(wide, tickers, fields)
    names = [f.name for f in schemas.PRICES_RAW if f.name != "ymd"]
    types = {f.name: f.dataType for f in schemas.PRICES_RAW}
    rows = long.select(*[(F.col(n) if n in long.columns else F.lit(None).cast(types[n])).alias(n) for n in names])
    load_prices(w, rows, start_load, ("csv", path, "prices"))


def load_statement_files(w: Warehouse, annual: str, quarterly: str, kind: str) -> None:
    """Wide annual and quarterly statement files (CSV with a header, one column per report date) to all statement tables."""
    wide = [w.spark.read.option("header", True).csv(path) for path in (annual, quarterly)]
    load_statement(w, raw_statement(*wide, w.ymd), kind, ("csv", f"{annual}, {quarterly}", kind))


def load_rate_files(w: Warehouse, path: str, table: str, feed: str, monthly: bool = False) -> None:
    """JSON or XML rate files to the rate tables; ``feed`` is json or xml."""
    if feed == "json":
        load_rates(w, files.json_rates(w.spark, path, table.upper(), w.ymd), schemas.JSON_RATES_RAW, "dd/MM/yyyy", table, monthly, (feed, path, table))
    else:
        load_rates(w, files.xml_rates(w.spark, path, table.upper(), w.ymd), schemas.XML_RATES_RAW, "yyyy-MM-dd", table, monthly, (feed, path, table))


def load_profile_files(w: Warehouse, path: str) -> None:
    """JSON company records, with or without a uuid, to the profile tables."""
    record = StructType([f for f in schemas.PROFILE_RAW if f.name != "ymd"])
    rows = w.spark.read.schema(record).json(path)
    if rows.where("uuid IS NOT NULL").isEmpty():
        rows = rows.drop("uuid")
    load_profiles(w, files.flatten_profiles(rows, w.ymd), ("json", path, "profile"))


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)
