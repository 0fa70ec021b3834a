"""Fills, sessions, spines, interval arithmetic and plausibility of ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.functions.standardise import haversine
from waymill.operators.common import bound, fresh


def forward_fill(df: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(column, ignorenulls=True).over(w))


def sessions(df: DataFrame, keys: list[str], at: str, gap: str, name: str = "segment", tie: list[str] = ()) -> DataFrame:
    """Adds a number that goes up where more than ``gap`` lies since the row before; it starts at 0."""
    w = Window.partitionBy(*keys).orderBy(at, *tie)
    new = F.coalesce((F.col(at) > F.lag(at).over(w) + F.expr(f"INTERVAL {gap}")).cast("int"), F.lit(0))
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    (start,) = fresh(df, "new")
    return df.withColumn(start, new).withColumn(name, F.sum(start).over(running)).drop(start)


def moved(df: DataFrame, keys: list[str], order: list[str], lon: str, lat: str, least: float) -> DataFrame:
    """Rows further than ``least`` metres from the row just before, kept or not; a key's first row stays."""
    w = Window.partitionBy(*keys).orderBy(*order)
    gap = haversine(F.lag(lon).over(w), F.lag(lat).over(w), F.col(lon), F.col(lat))
    (way,) = fresh(df, "gap")
    return df.withColumn(way, gap).where(F.col(way).isNull() | (F.col(way) > float(least))).drop(way)


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str, keep: list[str] = ()) -> DataFrame:
    """Unions of intervals that overlap or touch; null bounds are the far future. ``keep`` columns come from an island's first interval."""
    far = F.lit("9999-12-31").cast("timestamp_ntz")
    s, e, new, island = fresh(df, "start", "end", "new", "island")
    own = df.withColumns({s: F.coalesce(F.col(start).cast("timestamp_ntz"), far), e: F.coalesce(F.col(end).cast("timestamp_ntz"), far)})
    w = Window.partitionBy(*keys).orderBy(s, e, *keep)
    reach = F.max(e).over(w.rowsBetween(Window.unboundedPreceding, -1))
    numbered = own.withColumn(new, F.coalesce((F.col(s) > reach).cast("int"), F.lit(1))).withColumn(island, F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    open_ = lambda c: F.when(c < far, c)
    out = numbered.groupBy(*keys, island).agg(open_(F.min(s)).alias(start), open_(F.max(e)).alias(end), F.count("*").alias("n_merged"), *[F.min_by(c, F.struct(s, e, *keep)).alias(c) for c in keep])
    return out.drop(island)


def month_spine(df: DataFrame, keys: list[str], first: str, last: str, name: str = "month") -> DataFrame:
    """A row for each month from first to last, both included."""
    trunc = lambda c: F.trunc(F.col(c).cast("date"), "month")
    return df.select(*keys, F.explode(F.sequence(trunc(first), trunc(last), F.expr("INTERVAL 1 MONTH"))).alias(name))


def monthly_gaps(df: DataFrame, keys: list[str], at: str, amount: str) -> DataFrame:
    """Months without rows between a key's first and last one, each with the median of its monthly sums."""
    monthly = df.groupBy(*keys, F.trunc(F.col(at).cast("date"), "month").alias("month")).agg(F.sum(F.col(amount).cast("decimal(18,4)")).cast("double").alias("total"))
    level = monthly.groupBy(*keys).agg(F.median("total").alias("amount"), F.min("month").alias("first"), F.max("month").alias("last"))
    spine = month_spine(level, [*keys, "amount"], "first", "last")
    return spine.join(monthly, [*keys, "month"], "left_anti").select(*keys, "month", "amount")


def recurring(df: DataFrame, keys: list[str], start: str, end: str, until: Column, amounts: list[str]) -> DataFrame:
    """Monthly rows of each amount column from start to end (or ``until``), before ``until``; days past a month's end fall on its last."""
    stop = F.least(F.coalesce(F.col(end), until), until)
    days = F.when(F.col(start) <= stop, F.sequence(F.col(start), stop, F.expr("INTERVAL 1 MONTH")))
    dated = df.withColumn("due", F.explode(days)).where(F.col("due") < until)
    return dated.unpivot([*keys, "due"], amounts, "category", "amount").where("amount IS NOT NULL")


def plausible_readings(df: DataFrame, key: str, at: str, reading: str, per_day: float = 1000.0, per_week: float = 5000.0) -> DataFrame:
    """Readings that fit the last accepted one: not lower, within ``per_day`` a day, ``per_week`` a week begun, and ``per_day`` on one day.

    A fold, since a rejected reading never counts. A key's series is walked in one task: it is the life of one
    vehicle. Null readings and dates are dropped; of equal dates the smaller reading comes first.
    """
    row = F.struct(F.col(at).alias("at"), F.col(reading).cast("double").alias("km"))
    series = df.dropna(subset=[key, at, reading]).groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    one = "struct<at:timestamp_ntz,km:double>"
    nobody, none = F.lit(None).cast(one), F.array().cast(f"array<{one}>")

    def fits(last: Column, r: Column) -> Column:
        days, km = F.datediff(r["at"], last["at"]), r["km"] - last["km"]
        return (km >= 0) & (km <= per_day * F.greatest(days, F.lit(1))) & (km <= per_week * (F.floor(days / 7) + 1))

    def step(state: Column, r: Column) -> Column:
        ok = state["last"].isNull() | fits(state["last"], r)
        return F.struct(F.when(ok, r).otherwise(state["last"]).alias("last"), F.when(ok, F.concat(state["kept"], F.array(r))).otherwise(state["kept"]).alias("kept"))

    # a lambda copies the array that it adds to, so the series is walked in chunks of about the root of its length
    def chunk(state: Column, rows: Column) -> Column:
        walked = F.aggregate(rows, F.struct(state["last"].alias("last"), none.alias("kept")), step)
        return bound(walked, lambda w: F.struct(w["last"].alias("last"), F.concat(state["parts"], F.array(w["kept"])).alias("parts")))

    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("rows")))).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size("rows") / width).cast("int")), lambda k: F.slice("rows", k * width + 1, width))
    start = F.struct(nobody.alias("last"), F.array().cast(f"array<array<{one}>>").alias("parts"))
    kept = series.withColumn("rows", F.col("rows").cast(f"array<{one}>")).withColumn("kept", F.flatten(F.aggregate(chunks, start, chunk, lambda state: state["parts"])))
    return kept.select(key, F.explode("kept").alias("r")).select(key, F.col("r.at").alias(at), F.col("r.km").alias(reading))


def active_days(start: Column, end: Column, low: Column, high: Column) -> Column:
    """Days of an interval inside a period, both ends counted; an open end lasts to the period's; never negative."""
    first, last = F.greatest(start.cast("date"), low), F.least(F.coalesce(end.cast("date"), high), high)
    return F.greatest(F.datediff(last, first) + 1, F.lit(0))


def differences(df: DataFrame, keys: list[str], at: str, reading: str, tie: list[str] = ()) -> DataFrame:
    """Adds reading and day differences to the row before."""
    w = Window.partitionBy(*keys).orderBy(at, *tie)
    return df.withColumns({"reading_diff": F.col(reading) - F.lag(reading).over(w), "days_diff": F.datediff(F.col(at), F.lag(at).over(w))})


def previous_month(now: Column) -> tuple[Column, Column]:
    first = F.add_months(F.trunc(now, "month"), -1)
    return first, F.last_day(first)


def billing_date(start: Column, year: Column, quarter: Column) -> Column:
    """A given date, else the first day of a quarter named Q1 to Q4, else the year's last day."""
    q = F.regexp_extract(quarter, r"([1-4])", 1).try_cast("int")
    return F.coalesce(start.cast("date"), F.make_date(year, (q - 1) * 3 + 1, F.lit(1)), F.make_date(year, F.lit(12), F.lit(31)))
