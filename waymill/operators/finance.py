"""Costs, taxes and ownership of vehicles: expressions over one row, and a few joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VAT_RATE = 0.2
#: Days a year, and years over which a price is written off.
YEAR, WRITE_OFF_YEARS = 365, 5
#: Price that may be written off, by the highest CO2 in g/km it holds for.
CO2_CAPS = ((20, 30_000.0), (50, 20_300.0), (160, 18_300.0), (None, 9_900.0))


def infer_amounts(df: DataFrame, category: str, rate: float = VAT_RATE, untaxed: tuple[str, ...] = ("insurance",)) -> DataFrame:
    """Fills amount_tax_inc, amount_tax_exc and vat_value from one another, rounded to cents; then net_amount less deductible_vat."""
    inc, exc, vat = F.col("amount_tax_inc"), F.col("amount_tax_exc"), F.col("vat_value")
    own = F.when(F.col(category).isin(*untaxed) & vat.isNull(), 0.0).otherwise(rate)
    gross = F.coalesce(inc, exc + vat, exc * (1 + own))
    net = F.coalesce(exc, inc - vat, inc / (1 + own))
    out = df.withColumns({"amount_tax_inc": F.round(gross, 2), "amount_tax_exc": F.round(net, 2)})
    out = out.withColumn("vat_value", F.round(F.coalesce(vat, F.col("amount_tax_inc") - F.col("amount_tax_exc")), 2))
    if "deductible_vat" in df.columns:
        out = out.withColumn("net_amount", F.round(F.col("amount_tax_inc") - F.coalesce("deductible_vat", F.lit(0.0)), 2))
    return out


def deductible_vat(fiscal_type: Column, category: Column, energy: Column, vat: Column, work_types: tuple[str, ...] = ("utility", "other"), barred: tuple[str, ...] = ("rent", "transport"), fuel: str = "fuel", electric: str = "electricity") -> Column:
    """All of it for work vehicles; none for rents and transport of others; of fuel 80 %, electricity all; else all."""
    return F.when(fiscal_type.isin(*work_types), vat).when(category.isin(*barred), 0.0).when(category == fuel, F.when(energy == electric, vat).otherwise(F.round(0.8 * vat, 2))).otherwise(vat)


def exceptional(amount: Column, usual: Column | None = None, limit: float = 1000.0, times: float = 2.0) -> Column:
    """Over a fixed limit, or over so many times the usual amount where that is known."""
    over = amount > limit
    return F.coalesce(over if usual is None else F.when(usual.isNotNull(), amount > times * usual).otherwise(over), F.lit(False))


def rent_without_tax(amount: Column, basis: Column, fiscal_type: Column, rate: float = VAT_RATE) -> Column:
    """A rent as tax-exclusive: with tax divided out; a net rent only for vehicles whose tax is not deducted; others as they are."""
    return F.when((basis == "ttc") | ((basis == "net") & (fiscal_type == "personal")), amount / (1 + rate)).otherwise(amount)


def tyre_count(summer: Column, winter: Column, stored: Column) -> Column:
    return F.coalesce(stored, F.nullif(F.coalesce(summer, F.lit(0)) + F.coalesce(winter, F.lit(0)), F.lit(0)))


def accident_split(total: Column, organisation: Column, self_insured: Column) -> tuple[Column, Column]:
    """Deductible and insurer's cost."""
    return organisation - F.coalesce(self_insured, F.lit(0.0)), total - organisation


def co2_cap(co2: Column) -> Column:
    out = None
    for most, cap in CO2_CAPS[:-1]:
        out = F.when(co2 < most, cap) if out is None else out.when(co2 < most, cap)
    return out.otherwise(CO2_CAPS[-1][1])


def amortisation_base(days: Column, price: Column, co2: Column) -> Column:
    """What may not be written off of a price over the days, never under 0."""
    return F.greatest(days / (WRITE_OFF_YEARS * YEAR) * (price - co2_cap(co2)), F.lit(0.0))


def benefit_by_price(days: Column, price: Column, participation: Column, share: float = 0.09) -> Column:
    return F.greatest(share * price * days / YEAR + participation, F.lit(0.0))


def benefit_by_expenses(expenses: Column, participation: Column, share: float = 0.3) -> Column:
    return F.greatest(share * (expenses + participation), F.lit(0.0))


def full_time_equivalent(days: Column, year_days: int = YEAR) -> Column:
    return days / year_days


def ratio_flags(ratio: Column, group_median: Column, around: float = 0.3) -> Column:
    """low, high or ok against a group's median; null where either is."""
    return F.when(ratio.isNull() | group_median.isNull(), None).when(ratio < (1 - around) * group_median, "low").when(ratio > (1 + around) * group_median, "high").otherwise("ok")


def category_sums(df: DataFrame, keys: list[str], category: str, amount: str, groups: dict[str, list[str]]) -> DataFrame:
    """One sum for each named group of categories."""
    cents = F.col(amount).cast("decimal(18,4)")
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(category).isin(*values), cents).otherwise(0)).cast("double").alias(name) for name, values in groups.items()])


def median_by(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds the group's median to every row; a null group is called NA."""
    named = df.withColumns({k: F.coalesce(F.col(k), F.lit("NA")) for k in keys})
    return named.join(named.groupBy(*keys).agg(F.median(value).alias(name)), keys, "left")
