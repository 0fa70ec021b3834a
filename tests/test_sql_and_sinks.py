"""Functions in SQL, headers as sets, checked appends with rollback, arrivals routed once."""

import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F

from waymill.functions import sql
from waymill.operators import expect, text_rows
from waymill.sources import files, sinks
from waymill.streaming import stream


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


VALUES = ["ab-123-cd", " AB 123 CD ", "1 234,50", "12.5", "06 12 34 56 78", "+33612345678", "nan", "N/A", "", None, "oui", "2024-01-31", "31/01/2024", "Élodie DUPONT-Durand", "VF1AAAAA123456789"]


def test_functions_in_sql_equal_columns(spark):
    sql.register(spark)
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    df.createOrReplaceTempView("given_values")
    for name, use in sql.FUNCTIONS.items():
        assert rows(spark.sql(f"SELECT v, {name}(v) FROM given_values")) == rows(df.select("v", use(F.col("v")))), name


FIELDS = [text_rows.Field("total", r"Total: (\d+)"), text_rows.Field("client", r"Client: (\w+)", "doc"), text_rows.Field("sheet", r"Sheet (\w+)", "page"), text_rows.Field("first", r"Sheet (\w+)", "doc", "preserve")]


def test_table_function_equals_rows_from_lines(spark):
    lines = [("a", 1, k, t) for k, t in enumerate(["Sheet x", "Client: Ann", "Total: 5", "Client: Bob", None, "Sheet y", "Total: 7"])]
    lines += [("a", 2, k, t) for k, t in enumerate(["Total: 9", "Sheet z", "Total: 10"])] + [("b", 1, 0, "Total: 1"), ("b", 1, 1, "Client: Cid"), ("b", 3, 0, "Total: 2")]
    df = spark.createDataFrame(lines, "doc string, page int, line_no int, line string").repartition(3)
    df.createOrReplaceTempView("lines")
    sql.register_text_rows(spark, "rows_from_text", FIELDS, "total")
    got = spark.sql("SELECT * FROM rows_from_text(TABLE(lines) PARTITION BY doc ORDER BY (page, line_no))")
    want = text_rows.rows_from_lines(df, "doc", "page", FIELDS, "total")
    assert rows(got) == rows(want) and got.columns == want.columns and got.count() == 6


def test_headers_are_sets(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("x;y;note\n1;é;\n2;b;0\n".encode("latin-1"))
    (tmp_path / "b.csv").write_text("y;x\nc;3\n")
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(b"extra;y;x\nkept;d;4\n"))
    (tmp_path / "empty.csv").write_text("")
    read = lambda **o: files.delimited_by_name(spark, str(tmp_path), {"x": "first", "y": "second"}, **o)
    assert rows(read(skip=["extra"]).select("first", "second")) == [("1", "é"), ("2", "b"), ("3", "c"), ("4", "d")]
    with pytest.raises(Exception, match="column extra of the header is not expected and has the value kept"):
        read().collect()
    (tmp_path / "d.csv").write_text("x;z\n1;2\n")
    with pytest.raises(ValueError, match="column y 0 times"):
        read(skip=["extra", "z"])
    assert files.delimited_by_name(spark, f"{tmp_path}/empty*", ["x"]).collect() == []


CONTRACT = [expect.Expected("k", "int", nullable=False), expect.Expected("kind", "string", values=("a", "b")), expect.Expected("plate", "string", pattern="^[A-Z]+$"), expect.Expected("day", "date")]
SCHEMA = "k int, kind string, plate string, day date"


def test_a_failing_batch_leaves_nothing_and_one_can_be_rolled_back(spark, tmp_path):
    table = str(tmp_path / "t")
    good, bad = spark.createDataFrame([(1, "a", "X", date(2020, 1, 1)), (2, None, None, None)], SCHEMA), spark.createDataFrame([(3, "c", "x", date(2999, 1, 1)), (None, "a", "X", None)], SCHEMA)
    found = expect.faults(CONTRACT, F.current_date(), ["day"])
    assert sinks.appended(spark, table, SCHEMA).collect() == []
    assert sinks.append_checked(good, table, "s1", found) == {"rows": 2}
    with pytest.raises(sinks.Refused) as refused:
        sinks.append_checked(bad, table, "s2", found)
    assert refused.value.found == {"k missing": 1, "kind not allowed": 1, "plate not like ^[A-Z]+$": 1, "day in the future": 1}
    assert rows(sinks.appended(spark, table, SCHEMA).groupBy("batch").count()) == [("s1", 2)]
    assert sinks.append_checked(bad, table, "s2", found, refuse=False) == {"rows": 2} | refused.value.found
    sinks.append_checked(good, table, "s3", found)
    assert sinks.roll_back(spark, table, "s2") and not sinks.roll_back(spark, table, "s2")
    assert rows(sinks.appended(spark, table, SCHEMA).groupBy("batch").count()) == [("s1", 2), ("s3", 2)]
    sinks.append_checked(good.limit(1), table, "s3", found)
    assert sinks.appended(spark, table, SCHEMA).count() == 3


def test_counting_faults_is_one_scan(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(told, "id long")
    assert sinks.append_checked(df, str(tmp_path / "t"), "s", {"odd": F.col("id") % 2 == 1}, refuse=False) == {"rows": 1000, "odd": 500}
    assert seen.value == 1000


def test_arrivals_are_routed_once(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "routes")
    (folder / "acme").mkdir(parents=True)
    routes = spark.createDataFrame([("acme/.*fuel", "acme", "fuel"), ("acme/.*2024", "acme", "yearly"), (r"other/", "other", "all")], "pattern string, organisation string, connector string")
    run = lambda: stream.route_arrivals(spark, str(folder), routes, table, str(tmp_path / "c")).awaitTermination()
    seen = lambda which, c: sorted((r.path.rpartition("/")[2], r[c]) for r in stream.arrivals(spark, table, which).collect())
    for name in ("fuel_01.csv", "fuel_2024.csv", "nothing.csv"):
        (folder / "acme" / name).write_text("x")
    run()
    assert seen("routed", "connector") == [("fuel_01.csv", "fuel")]
    assert seen("quarantine", "fault") == [("fuel_2024.csv", "2 routes"), ("nothing.csv", "no route")]
    (folder / "acme" / "x_2024.csv").write_text("x")
    run()
    run()
    assert seen("routed", "connector") == [("fuel_01.csv", "fuel"), ("x_2024.csv", "yearly")] and len(seen("quarantine", "fault")) == 2
