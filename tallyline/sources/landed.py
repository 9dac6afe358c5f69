"""Reading landed files and documents: JSON, XML, nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Element and field names of the two rate feeds.
XML_RATE_SCHEMA = "effectiveDate string, percentRate string"
XML_RATE_TAG = "rate"
JSON_RATE_SCHEMA = "data string, valor string"


def json_rates(spark: SparkSession, path: str, rate_type: str, ymd: str, lines: bool = False, split: bool = False) -> DataFrame:
    """Landed JSON rate lists to (tipo, data, valor, ymd), all text.

    A list may span lines, so one task reads a whole file; with ``lines`` every line is a rate of its own and large files
    are split. What can't be parsed is a row without date and value. ``split`` cuts lists that span lines too: a rate ends
    at its closing brace, which no field of a rate may hold, so tasks read parts of a file; then it is the rate that can't
    be parsed, not its whole list, that becomes such a row.
    """
    if split:
        return _json_rate_columns(_split_json_rates(spark, path), F.lit(rate_type), ymd)
    rows = spark.read.schema(JSON_RATE_SCHEMA).option("multiLine", not lines).json(path)
    return _json_rate_columns(rows, F.lit(rate_type), ymd)


def _split_json_rates(spark: SparkSession, path: str) -> DataFrame:
    parts = spark.read.option("lineSep", "}").text(path)
    rate = F.regexp_replace("value", r"^[\s,\[\]\x{FEFF}]+", "")
    parsed = F.from_json(F.concat("rate", F.lit("}")), JSON_RATE_SCHEMA).alias("_rate")
    return parts.select(rate.alias("rate")).where("rate <> ''").select(parsed).select("_rate.*")


def json_rates_in(df: DataFrame, payload: str, rate_type: Column, ymd: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same from a text column that holds one JSON list of rates per row. A list that can't be parsed is a row without
    date and value; an empty list is none."""
    kind = f"array<struct<{_struct_ddl(JSON_RATE_SCHEMA)}>>"
    unread = F.array(F.lit(None).cast(kind.removeprefix("array<")[:-1]))
    rate = F.explode(F.coalesce(F.from_json(payload, kind), unread)).alias("_rate")
    rows = df.select(*keep, rate_type.alias("_type"), rate).select(*keep, "_type", "_rate.*")
    return _json_rate_columns(rows, F.col("_type"), ymd, keep)


def xml_rates(spark: SparkSession, path: str, rate_type: str, ymd: str) -> DataFrame:
    """Landed XML files, one row per rate element, to (typeRate, effectiveDate, percentRate, ymd)."""
    rows = spark.read.format("xml").option("rowTag", XML_RATE_TAG).schema(XML_RATE_SCHEMA).load(path)
    return _xml_rate_columns(rows, F.lit(rate_type), ymd)


def xml_rates_in(df: DataFrame, payload: str, rate_type: Column, ymd: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same from a text column that holds one rate element per row."""
    parsed = F.from_xml(payload, XML_RATE_SCHEMA).alias("_rate")
    rows = df.select(*keep, rate_type.alias("_type"), parsed).select(*keep, "_type", "_rate.*")
    return _xml_rate_columns(rows, F.col("_type"), ymd, keep)


def documents(spark: SparkSession, path: str, schema: StructType | str, required: str, ymd: str) -> DataFrame:
    """A document collection under a fixed schema, without documents that lack ``required``."""
    return with_required(spark.read.schema(schema).json(path), required, ymd)


def with_required(rows: DataFrame, required: str, ymd: str) -> DataFrame:
    return rows.where(F.col(required).isNotNull()).withColumn("ymd", F.lit(ymd))


def flatten_profiles(records: DataFrame, ymd: str, nested: tuple[str, ...] = ("companyOfficers",)) -> DataFrame:
    """Company records without their nested lists, each once, tagged with the load day."""
    return records.drop(*nested).withColumn("ymd", F.lit(ymd)).distinct()


def wallet_tickers(portfolios: DataFrame, condition: Column | str | None = None) -> DataFrame:
    """Tickers held in portfolios: (ticker, inserted_date, qtty), the most held first.

    ``portfolios`` carry an array ``stocks`` of (ticker, type, inserted_date); the condition
    reads ``_id`` and ``stocks.<field>`` of one holding, and defaults to "has an _id".
    """
    condition = "_id IS NOT NULL" if condition is None else condition
    holdings = portfolios.select("_id", F.explode("stocks").alias("stocks")).where(condition)
    return (
        holdings.groupBy(F.col("stocks.ticker").alias("ticker"))
        .agg(F.min("stocks.inserted_date").alias("inserted_date"), F.count(F.lit(1)).alias("qtty"))
        .orderBy(F.desc("qtty"), F.asc("inserted_date"), F.asc("ticker"))
    )


def first_ticker(tickers: DataFrame) -> DataFrame:
    """The alphabetically first ticker: the default choice of a report."""
    return tickers.agg(F.min("ticker").alias("ticker"))


def _json_rate_columns(rows: DataFrame, rate_type: Column, ymd: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return rows.select(rate_type.alias("tipo"), "data", "valor", F.lit(ymd).alias("ymd"), *keep)


def _xml_rate_columns(rows: DataFrame, rate_type: Column, ymd: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return rows.select(rate_type.alias("typeRate"), "effectiveDate", "percentRate", F.lit(ymd).alias("ymd"), *keep)


def _struct_ddl(columns: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (c.split() for c in columns.split(", ")))
