"""Expectations and data-quality reports: violations come back as rows, counted in as few passes as possible."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymill.functions.standardise import is_missing


@dataclass(frozen=True)
class Expected:
    """What a column must be. ``convert`` standardises; a missing optional column becomes null of its type."""

    name: str
    type: str
    nullable: bool = True
    unique: bool = False
    pattern: str | None = None
    values: tuple[str, ...] = ()
    source: str | None = None
    optional: bool = False
    convert: object = None
    metadata: dict = field(default_factory=dict)


def conform(df: DataFrame, contract: list[Expected]) -> DataFrame:
    """The contract's columns in its order, converted and cast. A required column that is missing fails."""
    out = []
    for e in contract:
        name = e.source or e.name
        if name not in df.columns and not e.optional:
            raise KeyError(f"column {name} is missing")
        c = F.col(name) if name in df.columns else F.lit(None)
        out.append((e.convert(c) if e.convert and name in df.columns else c).cast(e.type).alias(e.name, metadata=e.metadata))
    return df.select(*out)


def unexpected_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """column_name, has_data: columns that nobody declared; those without data (all missing or 0) may be dropped."""
    extra = [c for c in df.columns if c not in expected]
    if not extra:
        return df.sparkSession.createDataFrame([], "column_name string, has_data boolean")
    filled = df.agg(*[F.coalesce(F.max((~is_missing(F.col(c)) & (F.col(c).cast("string") != "0"))), F.lit(False)).alias(c) for c in extra])
    return filled.unpivot([], extra, "column_name", "has_data")


def with_provenance(df: DataFrame, connector: str, dataset: str, table: str, kind: str = "full") -> DataFrame:
    return df.withColumns({"connector_name": F.lit(connector), "source_dataset": F.lit(dataset), "source_table": F.lit(table), "synchronisation_type": F.lit(kind)})


def record_date(columns: list[str]) -> Column:
    """The latest of a row's dates; null without any."""
    return F.greatest(*columns) if len(columns) > 1 else F.col(columns[0]) if columns else F.lit(None).cast("timestamp_ntz")


def violations(df: DataFrame, contract: list[Expected]) -> DataFrame:
    """rule, column_name, n: one row for each rule of the contract, counted in one pass, and one grouping for each unique column."""
    tests = {}
    for e in contract:
        c = F.col(e.name)
        if not e.nullable:
            tests["not_null", e.name] = c.isNull()
        if e.pattern:
            tests["pattern", e.name] = c.isNotNull() & ~c.cast("string").rlike(e.pattern)
        if e.values:
            tests["values", e.name] = c.isNotNull() & ~c.cast("string").isin(*e.values)
    row = df.agg(F.count("*").alias("all"), *[F.count(F.when(t, 1)).alias(f"{r}:{n}") for (r, n), t in tests.items()])
    out = row.unpivot([], [f"{r}:{n}" for r, n in tests], "test", "n") if tests else df.sparkSession.createDataFrame([], "test string, n long")
    for e in contract:
        if e.unique:
            twice = df.where(F.col(e.name).isNotNull()).groupBy(e.name).count().where("count > 1").agg(F.count("*").alias("n"))
            out = out.unionByName(twice.select(F.lit(f"unique:{e.name}").alias("test"), "n"))
    return out.select(F.split_part("test", F.lit(":"), F.lit(1)).alias("rule"), F.split_part("test", F.lit(":"), F.lit(2)).alias("column_name"), "n")


def faults(contract: list[Expected], now: Column | None = None, dates: list[str] = (), vat: tuple[str, str, str] | None = None) -> dict[str, Column]:
    """Conditions that no row should meet, by what they are: for counting while rows are written (``sinks.append_checked``).

    Nulls where none may be, values outside their pattern or list, dates after ``now``, amounts (with tax, without, tax)
    that don't agree. What needs other rows or tables, as uniqueness and parents do, is ``violations`` and ``orphans``.
    """
    out: dict[str, Column] = {}
    for e in contract:
        c = F.col(e.name)
        if not e.nullable:
            out[f"{e.name} missing"] = c.isNull()
        if e.pattern:
            out[f"{e.name} not like {e.pattern}"] = ~c.cast("string").rlike(e.pattern)
        if e.values:
            out[f"{e.name} not allowed"] = ~c.cast("string").isin(*e.values)
    out |= {f"{d} in the future": F.col(d) > now for d in dates}
    if vat:
        out["tax not consistent"] = ~vat_consistent(*map(F.col, vat))
    return out


def orphans(df: DataFrame, column: str, parents: DataFrame, parent: str) -> DataFrame:
    """Distinct values that are not null and have no parent."""
    return df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct().join(parents.select(F.col(parent).alias("value")), "value", "left_anti")


def outside_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def future_rows(df: DataFrame, at: str, now: Column, by: str) -> DataFrame:
    return df.where(F.col(at) > now).groupBy(by).agg(F.count("*").alias("n"), F.max(at).alias("latest"))


def vat_consistent(inc: Column, exc: Column, vat: Column) -> Column:
    """Whether the amount with tax is the one without plus the tax; true where any is null."""
    return inc.isNull() | exc.isNull() | vat.isNull() | (F.abs(inc - (exc + vat)) <= 1e-8 + 1e-5 * F.abs(exc + vat))


def single_source(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: whether each provenance column has exactly one value."""
    return df.agg(*[(F.count_distinct(c) == 1).alias(c) for c in columns])


def without_missing(df: DataFrame, columns: list[str], how: str = "any") -> DataFrame:
    """Rows with a value in all ("any" missing goes) or at least one ("all" missing goes) of the columns."""
    cond = F.lit(how != "all")
    for c in columns:
        cond = cond | ~is_missing(F.col(c)) if how == "all" else cond & ~is_missing(F.col(c))
    return df.where(cond)


def condition(column: str, values: list | None = None, low: object = None, high: object = None) -> Column:
    """A filter from a list (None: null or any of the others) or bounds, both included."""
    c = F.col(column)
    if values is not None:
        known = [v for v in values if v is not None]
        inside = c.isin(*known) if known else F.lit(False)
        return c.isNull() | inside if None in values else inside
    out = F.lit(True)
    if low is not None:
        out = out & (c >= low)
    return out & (c <= high) if high is not None else out


def availability(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, missing_share: null tokens count as missing; an empty table has null shares."""
    return df.agg(*[F.avg(is_missing(F.col(c)).cast("double")).alias(c) for c in columns]).unpivot([], columns, "column_name", "missing_share")


def magnitude(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """column_name, outside_share of all rows; nulls are fine."""
    shares = [F.avg(F.when((F.col(c) < low) | (F.col(c) > high), 1.0).otherwise(0.0)).alias(c) for c, (low, high) in bounds.items()]
    return df.agg(*shares).unpivot([], list(bounds), "column_name", "outside_share")


def interval_faults(df: DataFrame, keys: list[str], start: str, end: str, tie: list[str]) -> DataFrame:
    """Rows that end before they start or start before the one before them ends, with the reason."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(start, *tie)
    reason = F.when(F.col(end) < F.col(start), "reversed").when(F.col(start) < F.lag(end).over(w), "overlap")
    return df.withColumn("reason", reason).where("reason IS NOT NULL")


def counts_by_file(rows: DataFrame, expected: DataFrame, file_col: str) -> DataFrame:
    """file, expected, found: files whose number of rows is not as told."""
    found = rows.groupBy(file_col).agg(F.count("*").alias("found"))
    return expected.join(found, file_col, "full_outer").select(file_col, "expected", F.coalesce("found", F.lit(0)).alias("found")).where("NOT (expected <=> found)")


def has_only_key(json_text: Column, key: str) -> Column:
    """Whether a JSON object's keys are exactly the one given."""
    return F.coalesce(F.json_object_keys(json_text) == F.array(F.lit(key)), F.lit(False))


def missing_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds the columns of a schema that a table lacks, as nulls of their types."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns})
