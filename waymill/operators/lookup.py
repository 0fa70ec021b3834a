"""Values through mapping tables, surrogate keys, fallback chains and trees."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.functions.standardise import folded_name_key, is_missing, without_accents
from waymill.operators.common import fresh, sent_whole


def folded(c: Column) -> Column:
    """A key that ignores case, accents and blanks around."""
    return F.lower(F.trim(without_accents(c)))


def mapped(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str, enforce: bool = False, fold: bool = True) -> DataFrame:
    """The column's values through a mapping; unknown ones stay, or become null with ``enforce``. Of equal keys the least value counts."""
    shape = folded if fold else lambda c: c
    k, v, known = fresh(df, "key", "value", "known")
    m = mapping.groupBy(shape(F.col(key)).alias(k)).agg(F.min(value).alias(v), F.lit(True).alias(known))
    met = df.join(m, shape(F.col(column)) == F.col(k), "left")
    out = F.when(F.col(known), F.col(v)).otherwise(F.lit(None) if enforce else F.col(column))
    return met.withColumn(column, out).drop(k, v, known)


def uncovered(df: DataFrame, column: str, mapping: DataFrame, key: str) -> DataFrame:
    """value, n: values that are not missing and that the mapping lacks."""
    m = mapping.select(folded(F.col(key)).alias("__key")).distinct()
    own = df.where(~is_missing(F.col(column))).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return own.join(m, folded(F.col("value")) == F.col("__key"), "left_anti")


def grown_names(names: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """name_key, name_value: a dictionary with the names it lacks, each as itself."""
    seen = names.select(folded_name_key(F.col(column)).alias("name_key")).where("name_key <> ''").distinct()
    new = seen.join(dictionary, "name_key", "left_anti").select("name_key", F.col("name_key").alias("name_value"))
    return dictionary.select("name_key", "name_value").unionByName(new)


def country_codes(df: DataFrame, column: str, countries: DataFrame, strict: bool = True) -> DataFrame:
    """alpha-3 codes of names and codes in any case; missing ones become empty, an unknown one fails while the job runs (or stays null)."""
    k, code = fresh(df, "key", "code")
    m = countries.select(folded(F.col("name_key")).alias(k), F.col("alpha3").alias(code)).distinct()
    met = df.join(m, folded(F.col(column)) == F.col(k), "left")
    unknown = F.raise_error(F.concat(F.lit("no country "), F.col(column))).cast("string") if strict else F.lit(None).cast("string")
    return met.withColumn(column, F.when(is_missing(F.col(column)), "").when(F.col(code).isNotNull(), F.col(code)).otherwise(unknown)).drop(k, code)


def found_in_text(df: DataFrame, column: str, id_col: str, keys: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Adds the value of the longest key whose words stand in the text, ties to the smaller key; null if none does.

    Texts and keys meet by a key's first word, so a large key table costs no more than the words of the texts. Few keys
    are sent whole: a first word that all texts have then brings them into no single task.
    """
    k = keys.select(folded(F.col(key)).alias("__key"), F.col(value).alias("__value")).distinct()
    k = k.withColumn("__word", F.element_at(F.split("__key", " "), 1))
    words = df.select(id_col, F.concat(F.lit(" "), F.regexp_replace(folded(F.col(column)), "[^a-z0-9]+", " "), F.lit(" ")).alias("__text"))
    each = words.withColumn("__word", F.explode(F.array_distinct(F.split(F.trim("__text"), " "))))
    met = each.join(sent_whole(k), "__word").where(F.contains("__text", F.concat(F.lit(" "), F.col("__key"), F.lit(" "))))
    best = met.groupBy(id_col).agg(F.min_by("__value", F.struct(-F.length("__key"), "__key")).alias(name))
    return df.join(best, id_col, "left")


def same_content(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row, same: whether two columns of one header hold the same; the second may then go."""
    return df.agg(F.coalesce(F.bool_and(F.col(a).eqNullSafe(F.col(b))), F.lit(True)).alias("same"))


def surrogate_keys(facts: DataFrame, natural: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Facts with the hash of their natural key under a name, and the parents (id and key) to be merged before them; a null part gives a null id."""
    key = F.sha2(F.to_json(F.struct(*natural)).cast("binary"), 256)
    whole = facts.withColumn(name, F.when(F.lit(0) == sum((F.col(c).isNull().cast("int") for c in natural[1:]), F.col(natural[0]).isNull().cast("int")), key))
    return whole, whole.where(F.col(name).isNotNull()).select(F.col(name).alias("id"), *natural).distinct()


def first_known(df: DataFrame, column: str, chain: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Fills a column from (table, key, value) steps in order; each table has its key once, and later ones fill only what is still null."""
    for k, (table, key, value) in enumerate(chain):
        df = df.join(table.select(F.col(key), F.col(value).alias(f"__v{k}")), key, "left")
    return df.withColumn(column, F.coalesce(column, *[f"__v{k}" for k in range(len(chain))])).drop(*[f"__v{k}" for k in range(len(chain))])


def tree_edges(df: DataFrame, json_col: str) -> DataFrame:
    """id, name, parent of every node of trees {"id", "name", "children": […]}, in one pass over the texts; nodes without id are left out.

    A text that is no JSON has no nodes. A tree is walked where its text is, so no step depends on the depth of the deepest one.
    """

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shown = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
        for batch in batches:
            rows = []
            for text in batch[json_col]:
                try:
                    todo = [(json.loads(text), None)] if text else []
                except ValueError:
                    continue
                while todo:
                    node, parent = todo.pop()
                    if not isinstance(node, dict):
                        continue
                    name = shown(node.get("id"))
                    if name is not None:
                        rows.append((name, shown(node.get("name")), parent))
                    children = node.get("children")
                    todo += [(c, name) for c in children] if isinstance(children, list) else []
            yield pd.DataFrame(rows, columns=["id", "name", "parent"], dtype=object)

    return df.select(json_col).mapInPandas(edges, "id string, name string, parent string")


def active_wins(active: DataFrame, archived: DataFrame, key: str) -> DataFrame:
    """Rows of both, an archived one only where no active one has its key."""
    return active.unionByName(archived.join(active.select(key), key, "left_anti").select(active.columns))


def ranked_oldest(df: DataFrame, keys: list[str], order: str, tie: str) -> DataFrame:
    """The row of each key's highest rank, that is its oldest version."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last(), tie))
    (name,) = fresh(df, "rank")
    return df.withColumn(name, rank).where(F.col(name) == 1).drop(name)
