"""Keyed writes as DataFrames: upserts, slowly changing versions, reconciliation.

Each returns the target's next state (or a change set). ``sources.sinks.replace`` writes it as a new version of a
Parquet table, so a lost executor or a second run never leaves half a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.functions.standardise import nearly_equal
from waymill.operators.common import fresh, sent_whole
from waymill.operators.dedupe import conflict_to_null, first_per_key

#: How an incoming value meets a stored one.
MODES = ("keep", "null_only", "overwrite", "inc_null")


def merged_value(mode: str, stored: Column, incoming: Column) -> Column:
    """keep: stored; null_only: incoming where nothing is stored; overwrite: incoming where it has a value; inc_null: incoming, also null."""
    if mode not in MODES:
        raise ValueError(f"mode {mode}")
    return {"keep": stored, "null_only": F.coalesce(stored, incoming), "overwrite": F.coalesce(incoming, stored), "inc_null": incoming}[mode]


def once_per_key(incoming: DataFrame, keys: list[str], repeated: str | list[Column] = "fail") -> DataFrame:
    """Incoming rows with a key, one for each: of repeated ones the first by an order, their agreed values ("agree"), or an error while the job runs ("fail")."""
    known = incoming.dropna(subset=keys)
    if repeated == "agree":
        return conflict_to_null(known, keys, [c for c in known.columns if c not in keys])
    if repeated != "fail":
        return first_per_key(known, keys, repeated)
    (n,) = fresh(known, "n")
    told = F.raise_error(F.concat(F.lit("incoming key is not unique: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys])))
    return known.withColumn(n, F.count("*").over(Window.partitionBy(*keys))).where(F.when(F.col(n) == 1, True).otherwise(told.cast("boolean"))).drop(n)


class Sides:
    """Stored and incoming rows side by side by key, under names that no column has."""

    def __init__(self, target: DataFrame, incoming: DataFrame, keys: list[str]) -> None:
        values = [c for c in target.columns if c not in keys]
        self.stored, self.new, *held = fresh(target, "stored", "new", *[f"{s}{n}" for s in "ti" for n in range(len(values))])
        self.t, self.i = dict(zip(values, held)), dict(zip(values, held[len(values) :]))
        t = target.select(*keys, F.lit(True).alias(self.stored), *[F.col(c).alias(h) for c, h in self.t.items()])
        i = incoming.select(*keys, F.lit(True).alias(self.new), *[F.col(c).alias(h) for c, h in self.i.items()])
        self.rows = t.join(i, keys, "full_outer")


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], mode: str, columns: list[str] | None = None, modes: dict[str, str] | None = None, repeated: str | list[Column] = "fail") -> DataFrame:
    """The target after the incoming rows; those with a null key are left out.

    ``columns`` limits what changes in stored rows; ``modes`` narrows the mode of single columns (protected ones).
    ``repeated`` settles several incoming rows of one key: an order whose first counts, "agree" for the values in which they
    all agree (null where they don't), "fail" for an error.
    """
    both = Sides(target, once_per_key(incoming, keys, repeated), keys)
    changing = set(columns or both.t)

    def value(c: str) -> Column:
        stored, new = F.col(both.t[c]), F.col(both.i[c])
        met = merged_value((modes or {}).get(c, mode), stored, new) if c in changing else stored
        return F.when(F.col(both.stored).isNull(), new).when(F.col(both.new).isNull(), stored).otherwise(met).alias(c)

    return both.rows.select(*keys, *[value(c) for c in both.t])


def duplicate_flags(incoming: DataFrame, stored: DataFrame, keys: list[str], id_col: str, numbers: list[str] = ()) -> DataFrame:
    """Incoming rows with the stored id of the same natural key; numbers are compared with two decimals, nulls equal each other."""
    shown = lambda c: F.round(F.col(c), 2).cast("decimal(18,2)") if c in numbers else F.col(c)
    held = dict(zip(keys, fresh(incoming, *[f"k{n}" for n in range(len(keys))])))
    s = stored.groupBy(*[shown(k).alias(h) for k, h in held.items()]).agg(F.min(id_col).alias(f"stored_{id_col}"))
    cond = F.lit(True)
    for k, h in held.items():
        cond = cond & shown(k).eqNullSafe(F.col(h))
    return incoming.join(s, cond, "left").drop(*held.values())


def new_versions(target: DataFrame, incoming: DataFrame, keys: list[str], start: str, end: str, tracked: dict[str, str], mode: str = "overwrite", tolerance: dict[str, float] | None = None, repeated: str | list[Column] = "fail") -> DataFrame:
    """Slowly changing versions after one incoming row per key.

    A key without a current version is inserted. Where no tracked column changed (kinds: text, number, date;
    null-safe; a number also by its tolerance), the current version's nulls are filled. A change closes the current
    version at the new start and adds one; with mode "null_only" changes are ignored. Incoming rows whose
    start is not after the current one's only fill nulls. The current version is the one of latest start, then of latest
    end, ties by all other columns. Repeated incoming keys are as in ``upsert``.
    """
    cols = target.columns
    tie = [F.col(c).asc_nulls_last() for c, kind in target.dtypes if c not in (*keys, start, end) and not kind.startswith("map")]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(start).desc_nulls_last(), F.col(end).desc_nulls_first(), *tie))
    (place,) = fresh(target, "rank")
    ranked = target.withColumn(place, rank)
    current, past = ranked.where(F.col(place) == 1).drop(place), ranked.where(F.col(place) > 1).drop(place)
    both = Sides(current, once_per_key(incoming, keys, repeated), keys)
    changed = F.lit(False)
    for c, kind in tracked.items():
        old, new = F.col(both.t[c]), F.col(both.i[c])
        limit = (tolerance or {}).get(c)
        same = nearly_equal(old, new, kind) if limit is None else F.when(old.isNull() | new.isNull(), old.isNull() & new.isNull()).otherwise(F.abs(old - new) <= limit)
        changed = changed | (new.isNotNull() & ~same)
    later = F.col(both.stored) & F.col(both.new) & changed & (F.col(both.i[start]) > F.col(both.t[start]))
    (turned_,) = fresh(both.rows, "changed")
    rows = both.rows.withColumn(turned_, F.lit(False) if mode == "null_only" else F.coalesce(later, F.lit(False)))
    stored, new, turned = F.col(both.stored).isNotNull(), F.col(both.new).isNotNull(), F.col(turned_)

    def kept(c: str) -> Column:
        if c in keys:
            return F.col(c)
        old, inc = F.col(both.t[c]), F.col(both.i[c])
        if c == end:
            return F.when(turned, F.col(both.i[start])).otherwise(old).alias(c)
        return F.when(turned | ~new, old).otherwise(F.coalesce(old, inc)).alias(c)

    open_rows = rows.where(stored).select(*[kept(c) for c in cols])
    added = rows.where(new & (~stored | turned)).select(*[F.col(c) if c in keys else F.col(both.i[c]).alias(c) for c in cols])
    return past.unionByName(open_rows).unionByName(added)


def replace_computed(target: DataFrame, computed: DataFrame, keys: list[str], confirmed: str) -> DataFrame:
    """Stored rows with a confirmed date stay; computed ones are replaced, but not for keys that have a confirmed row."""
    sure = target.where(F.col(confirmed).isNotNull())
    return sure.unionByName(computed.join(sure.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def replace_for(target: DataFrame, incoming: DataFrame, column: str, values: list[str]) -> DataFrame:
    """All rows of some sources replaced by the incoming ones."""
    return target.where(F.col(column).isNull() | ~F.col(column).isin(*values)).unionByName(incoming, allowMissingColumns=True)


def path_ids(paths: DataFrame, path: str, mark: str = " > ") -> DataFrame:
    """id, name, path, parent_id for every level of every path; ids are hashes of the path so far."""
    parts = F.split(path, mark)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), mark))
    levels = paths.dropna(subset=[path]).select(F.explode(prefixes).alias("path")).distinct()
    parent = F.nullif(F.array_join(F.slice(F.split("path", mark), F.lit(1), F.size(F.split("path", mark)) - 1), mark), F.lit(""))
    return levels.select(F.md5(F.col("path").cast("binary")).alias("id"), F.element_at(F.split("path", mark), -1).alias("name"), "path", F.md5(parent.cast("binary")).alias("parent_id"))


def reconciliation(desired: DataFrame, actual: DataFrame, key: str, checks: dict[str, str]) -> DataFrame:
    """key and action: link, unlink, the first check that differs (by its name), or none."""
    d = desired.select(key, F.lit(True).alias("__want"), *[F.col(c).alias(f"__d_{c}") for c in checks])
    a = actual.select(key, F.lit(True).alias("__have"), *[F.col(c).alias(f"__a_{c}") for c in checks])
    action = F.when(F.col("__have").isNull(), "link").when(F.col("__want").isNull(), "unlink")
    for c, name in checks.items():
        action = action.when(~F.col(f"__d_{c}").eqNullSafe(F.col(f"__a_{c}")), name)
    return d.join(a, key, "full_outer").select(key, action.otherwise("none").alias("action"))


def refreshed(rollup: DataFrame, facts: DataFrame, touched: DataFrame, month: str, build) -> DataFrame:
    """A rollup with only the touched months computed again from the facts."""
    months = touched.select(month).distinct()
    return rollup.join(months, month, "left_anti").unionByName(build(facts.join(sent_whole(months), month, "left_semi")))
