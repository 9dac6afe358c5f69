"""Indicators from stored states, so that a short feed does not read the history again.

A state says of a ticker, through the end of a month, all that later indicators need: how many closes there were, their
mean and summed squared deviations, and the last closes that the longest moving average reaches back to. States
merge, so a month's own is made from its days and the state before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import zscore
from tallyline.operators.kpis import MOVING_AVERAGES, PRICES, Series, checked_series, with_change_day, with_change_month, with_change_week, with_moving_averages

TAIL = max(MOVING_AVERAGES.values())
#: Columns of a state beside the ticker: its month, last day, and what closes there were up to then.
STATE = "month date, last_day date, n long, mean double, m2 double, tail array<double>"
KEYS = ["ticker", "month"]


def month_states(days: DataFrame, before: DataFrame | None = None, s: Series = PRICES) -> DataFrame:
    """One state for each ticker and month of ``days``, which are whole months.

    ``before``: for a ticker the state that its days follow; without one they are all there is. A ticker's months are
    folded in one row, so they are bounded by the calendar.
    """
    day = F.col(s.date).cast("date")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct(day.alias("d"), s.value.alias("c")))), lambda x: x["c"])
    months = days.groupBy(F.col(s.ticker).alias("ticker"), F.trunc(day, "MM").alias("month")).agg(
        F.max(day).alias("last_day"), F.count(s.close).alias("n"), F.avg(s.close).alias("mean"),
        (F.var_pop(s.close) * F.count(s.close)).alias("m2"), in_order.alias("tail"),
    )
    state = F.struct(*[F.col(c).cast(t).alias(c) for c, t in _fields()]).alias("state")
    gathered = months.groupBy("ticker").agg(F.array_sort(F.collect_list(state)).alias("months"))
    kind = gathered.schema["months"].dataType
    if before is not None:
        gathered = gathered.join(before.select(F.col("ticker").alias("_of"), state.alias("start")), F.col("ticker") == F.col("_of"), "left")
        first = F.when(F.col("start").isNull(), F.array().cast(kind)).otherwise(F.array("start"))
        skipped = F.when(F.col("start").isNull(), 1).otherwise(2)
    else:
        first, skipped = F.array().cast(kind), F.lit(1)

    def following(states: Column, month: Column) -> Column:
        return F.concat(states, F.array(F.when(F.size(states) == 0, _cut(month)).otherwise(_merged(F.get(states, F.size(states) - 1), month))))

    folded = F.aggregate("months", first, following)
    own = F.slice(folded, skipped, F.greatest(F.size(folded) - skipped + 1, F.lit(0)))
    return gathered.select("ticker", F.explode(own).alias("s")).select("ticker", "s.*")


def latest_before(states: DataFrame, firsts: DataFrame) -> DataFrame:
    """For each ticker of ``firsts`` (ticker, first) the last state from before the month of its first day."""
    rest = [c for c, _ in _fields()]
    earlier = states.join(firsts, "ticker").where(F.col("month") < F.trunc("first", "MM"))
    return earlier.groupBy("ticker").agg(F.max_by(F.struct(*rest), "month").alias("s")).select("ticker", "s.*")


def kpis_from_states(days: DataFrame, before: DataFrame, s: Series = PRICES) -> DataFrame:
    """What ``daily_kpis`` gives for days that follow the states ``before``; a ticker without one starts with its days."""
    place = F.posexplode("tail").alias("_place", s.close)
    seeds = before.select(F.col("ticker").alias(s.ticker), "last_day", F.size("tail").alias("_size"), "n", "mean", "m2", place)
    seeds = seeds.select(
        s.ticker, F.expr("date_sub(last_day, _size - 1 - _place)").alias(s.date), s.close,
        F.col("n").alias("_n"), F.col("mean").alias("_mean"), F.col("m2").alias("_m2"), F.lit(True).alias("_seed"),
    )
    dated = days.withColumns({s.date: F.col(s.date).cast("date"), "_seed": F.lit(False)})
    series = checked_series(dated.unionByName(seeds, allowMissingColumns=True), s)
    series = _with_zscore(series, s)
    for step in (with_change_day, with_change_week, with_moving_averages, with_change_month):
        series = step(series, s)
    rounded = ["vl_open", "vl_high", "vl_low", s.close]
    own = series.where(~F.col("_seed")).drop("_seed", "_n", "_mean", "_m2")
    return own.withColumns({c: F.round(c, 2) for c in rounded if c in days.columns})


def _with_zscore(series: DataFrame, s: Series) -> DataFrame:
    """The state's closes merged with those of the days so far; its numbers stand on the seeds, which come first."""
    close = F.when(~F.col("_seed"), s.value)
    held = {c: F.max(f"_{c}").over(s.so_far) for c in ("n", "mean", "m2")}
    n = F.count(close).over(s.so_far)
    numbers = {"_n1": n, "_mean1": F.avg(close).over(s.so_far), "_m21": F.var_pop(close).over(s.so_far) * n}
    series = series.withColumns({f"_{c}0": v for c, v in held.items()} | numbers)
    a, b = ({c: F.col(f"_{c}{i}") for c in ("n", "mean", "m2")} for i in (0, 1))
    whole = _union(a, b)
    only = F.coalesce(a["n"], F.lit(0)) == 0
    mean, m2, n = (F.when(only, b[c]).otherwise(whole[c]) for c in ("mean", "m2", "n"))
    deviation = F.when(n > 1, F.sqrt(m2 / (n - 1)))
    return series.withColumn("z_score", zscore(s.value, mean, deviation)).drop(*[f"_{c}{i}" for c in ("n", "mean", "m2") for i in (0, 1)])


def _union(a, b) -> dict[str, Column]:
    """Count, mean and squared deviations of two sets together; ``b`` may be empty, ``a`` not."""
    n, apart = a["n"] + b["n"], F.coalesce(b["mean"], F.lit(0.0)) - a["mean"]
    some = F.when(b["n"] > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    mean = a["mean"] + some * apart * b["n"] / n
    return {"n": n, "mean": mean, "m2": a["m2"] + F.coalesce(b["m2"], F.lit(0.0)) + some * apart * apart * a["n"] * b["n"] / n}


def _merged(state: Column, month: Column) -> Column:
    both = _union(state, month)
    numbers = [F.when(state["n"] > 0, both[c]).otherwise(month[c]).alias(c) for c in ("n", "mean", "m2")]
    return F.struct(month["month"].alias("month"), month["last_day"].alias("last_day"), *numbers, _tail(F.concat(state["tail"], month["tail"])).alias("tail"))


def _cut(month: Column) -> Column:
    return F.struct(*[(_tail(month["tail"]) if c == "tail" else month[c]).alias(c) for c, _ in _fields()])


def _tail(closes: Column) -> Column:
    size = F.size(closes)
    return F.when(size > TAIL, F.slice(closes, F.greatest(size - TAIL + 1, F.lit(1)), TAIL)).otherwise(closes)


def _fields() -> list[tuple[str, str]]:
    return [tuple(field.strip().split(" ")) for field in STATE.split(",")]
