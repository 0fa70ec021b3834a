"""Headers, quotes, repeats, far points, deep trees, long series: what must fail does, what must not be lost isn't."""

import datetime as dt
import json
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from waymill.operators import dedupe, joins, kpi, lookup, spatial, timeseries
from waymill.sources import files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_headers_are_held_to_the_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    (tmp_path / "b.csv").write_text("y;x\n2;1\n")
    read = lambda name, columns: files.delimited(spark, str(tmp_path / name), columns)
    assert rows(read("a.csv", {"x": "first", "y": "second"}).select("first", "second")) == [("1", "2")]
    for name, columns in (("b.csv", ["x", "y"]), ("a.csv", ["x", "z"])):
        with pytest.raises(Exception, match="(?i)header"):
            read(name, columns).collect()


def test_zipped_files_keep_quotes_and_any_mark(spark, tmp_path):
    for mark, text in ((";", 'x;y\n"a;b";3\n"c ""d""\ne";\n\nf\n'), ("|", "x|y\n1|2\n")):
        with zipfile.ZipFile(tmp_path / f"{ord(mark)}.zip", "w") as z:
            z.writestr("in.csv", text)
    read = lambda mark, columns: files.zipped(spark, str(tmp_path / f"{ord(mark)}.zip"), columns, mark=mark)
    assert rows(read(";", ["x", "y"]).select("x", "y")) == [("a;b", "3"), ('c "d"\ne', ""), ("f", None)]
    assert rows(read("|", ["x", "y"]).select("x", "y")) == [("1", "2")]
    with pytest.raises(Exception, match="header"):
        read("|", ["y", "x"]).collect()


def test_repeated_items_do_not_count_rules_twice(spark):
    items = spark.createDataFrame([("a.csv", 1), ("a.csv", 1), ("b.csv", 2), (None, 3)], "path string, rule_size int")
    rules = spark.createDataFrame([("one", "^a", "x"), ("two", "csv$", "y")], "name string, pattern string, target string")
    out = joins.routed(items, rules, "name", "pattern", "target", "path")
    assert rows(out.select("path", "rule", "n_rules")) == sorted([("a.csv", "one", 2), ("a.csv", "two", 2)] * 2 + [("b.csv", "two", 1), (None, None, 0)], key=str)
    routes = spark.createDataFrame([("^a", "org", "c")], "pattern string, organisation string, connector string")
    assert rows(files.routed_files(items.select("path"), routes)) == sorted([("a.csv", "^a", "org", "c", 1)] * 2 + [("b.csv", None, None, None, 0), (None, None, None, None, 0)], key=str)


def test_the_nearest_place_may_be_any_way_off(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 5e6, -7e6), (3, None, 1.0), (4, float("nan"), 0.0)], "id int, x double, y double")
    places = spark.createDataFrame([("here", 0.1, 0.1), ("there", -3e6, 0.0), ("nowhere", None, 0.0)], "place string, px double, py double")
    assert [(r.id, r.place) for r in spatial.nearest(points, places, "id", "x", "y", "place", "px", "py").orderBy("id").collect()] == [(1, "here"), (2, "here")]
    assert spatial.nearest(points, places.limit(0), "id", "x", "y", "place", "px", "py").count() == 0


def test_paths_of_any_depth_and_circles(spark):
    chain = spark.createDataFrame([(k, f"n{k}", k - 1 if k else None) for k in range(45)], "id int, name string, parent int")
    deepest = joins.paths(chain, "id", "name", "parent").orderBy(F.desc("depth")).first()
    assert deepest.depth == 45 and deepest.path.count(" > ") == 44
    apart = spark.createDataFrame([(1, "r", None), (2, "a", 3), (3, "b", 2)], "id int, name string, parent int")
    assert rows(joins.paths(apart, "id", "name", "parent")) == [(1, "r", 1)]
    reached = spark.createDataFrame([(1, "r", None), (2, "a", 1), (2, "a", 3), (3, "b", 2)], "id int, name string, parent int")
    with pytest.raises(ValueError, match="circle"):
        joins.paths(reached, "id", "name", "parent")


def test_trees_of_any_depth(spark):
    node = None
    for k in range(20, 0, -1):
        node = {"id": str(k), "name": f"n{k}", "children": [node] if node else []}
    out = lookup.tree_edges(spark.createDataFrame([(json.dumps(node),)], "tree string"), "tree")
    assert {(r.id, r.parent) for r in out.collect()} == {(str(k), str(k - 1) if k > 1 else None) for k in range(1, 21)}


def test_long_series_of_readings(spark):
    start = dt.datetime(2000, 1, 1)
    series = [("v", start + dt.timedelta(hours=k), float(k) if k % 7 else 10.0**7) for k in range(100_000)]
    df = spark.createDataFrame(series, "vehicle string, at timestamp_ntz, km double")
    began = time.monotonic()
    out = timeseries.plausible_readings(df.where("km < 1e7 OR at > '2000-01-01'"), "vehicle", "at", "km")
    kept = out.agg(F.count("*"), F.max("km"), F.count_distinct("at")).first()
    assert tuple(kept) == (sum(k % 7 > 0 for k in range(100_000)), 99_999.0, sum(k % 7 > 0 for k in range(100_000)))
    assert time.monotonic() - began < 60


def test_odometers_are_taken_by_vehicle(spark):
    facts = spark.createDataFrame(
        [("p", "a", 100.0, 1, 10.0), ("p", "a", 350.0, 3, None), ("p", "b", 9000.0, 2, 5.0), ("p", "b", 9010.0, 1, None), ("p", None, 1.0, 1, None), ("q", None, None, None, 7.0), (None, "c", 5.0, 1, None)],
        "perimeter string, vehicle_id string, mileage double, mileage_date int, net_amount double",
    ).withColumn("category", F.lit("rent"))
    out = kpi.evaluate(facts, ["perimeter"], {"km": kpi.leaf("total-mileage"), "now": kpi.leaf("current-mileage"), "per_km": kpi.block(kpi.leaf("expense", ["rent"], "net"), "/", kpi.leaf("total-mileage"))})
    assert rows(out) == sorted([("p", 260.0, 9350.0, 15 / 260), ("q", None, None, None), (None, 0.0, 5.0, None)], key=str)
    assert kpi.evaluate(facts, [], {"km": kpi.leaf("total-mileage")}).first().km == 260.0


def test_catalogue_has_every_group():
    """Counts of each group from the numbers of categories, and no name twice."""
    named = lambda n, p: {f"{p}{k}": [f"{p}_{k}"] for k in range(n)}
    travels = ["train", "plane", "hotel", "rental_car"]
    names = list(kpi.catalogue(named(10, "r"), named(4, "e"), named(7, "i"), named(25, "o"), named(8, "c"), travels))
    count = lambda *starts: sum(n.startswith(starts) for n in names)
    assert [count(x) for x in ("rent_r", "energy_e", "insurance_i", "other_o", "claims_c", "accident_")] == [30, 12, 21, 75, 24, 6]
    assert {"fines", "bonus", "malus", "participation", "taxes_total"} <= set(names)
    assert count("ikb_") + count("declared", "calculated") == 7 and count("tax_") == 7
    assert [count(f"travel_{x}_") for x in ("distance", "occurrences", "expenses", "anticipation")] == [2, 4, 12, 4]
    assert [count(f"{x}_total_") for x in ("rent", "energy", "insurance")] == [3, 3, 3] and [count(f"travel_{x}_") for x in ("total", "per_trip", "per_traveller")] == [3, 3, 3]
    assert sorted(n for n in names if n.startswith("tco") or n.startswith("tcm")) == ["tcm", "tcm_per_collaborator", "tcm_per_user", "tco", "tco_per_driver", "tco_per_km", "tco_per_vehicle"]
    assert {"total-mileage", "current-mileage", "lease-mileage", "lease-months"} <= set(names)
    ratios = [n for n in names if n.startswith("co2_") and "_per_" in n]
    assert len(ratios) == 19 and count("co2_") - len(ratios) == 7 + 3
    with pytest.raises(ValueError, match="there already"):
        kpi.catalogue({"a": ["a"], "total": ["b"]}, {}, {}, {}, {}, [])


def test_labels(spark):
    labels, views = {"rent": "Loyer", "ikb": "Avantage"}, {"net": "(net)", "tax_exc": "(HT)"}
    assert kpi.labelled(["rent_net", "rent_tax_exc", "tax_ikb", "ikb"], labels, views, "Taxes") == {"rent_net": "Loyer (net)", "rent_tax_exc": "Loyer (HT)", "tax_ikb": "Taxes - Avantage", "ikb": "Avantage"}
    with pytest.raises(LookupError):
        kpi.labelled(["fuel_net"], labels, views)


def test_columns_of_internal_names_stay(spark):
    df = spark.createDataFrame([("k", 1, "a", "b", "c"), ("k", 2, "d", "e", "f")], "k string, n int, __rank string, __row string, __new string")
    first = dedupe.first_per_key(df, ["k"], [F.desc("n")]).first()
    assert tuple(first) == ("k", 2, "d", "e", "f") and dedupe.keep_extreme(df, ["k"], "n").first() == first
    day = F.lit("2024-01-01").cast("timestamp_ntz")
    dated = df.withColumn("at", day)
    assert timeseries.sessions(dated, ["k"], "at", "10 minutes", tie=["n"]).columns == [*dated.columns, "segment"]
    periods = spark.createDataFrame([("k", "v")], "k string, v string").withColumns({"s": day, "e": F.lit(None).cast("timestamp_ntz")})
    out = joins.best_interval(dated, periods, "k", "at", "s", "e", [("v", False)], ["v"])
    assert out.columns == [*dated.columns, "v", "matched"] and rows(out.select("n", "__rank", "__row", "v")) == [(1, "a", "b", "v"), (2, "d", "e", "v")]
