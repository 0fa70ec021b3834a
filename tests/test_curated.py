"""Curated tables and scans on small synthetic fixtures, with nulls, ties, repeats and empty tables."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from waymill.functions import standardise as st
from waymill.operators import expect, joins, kpi, merge, reshape, synth, text_rows, timeseries
from waymill.plans import curated
from waymill.sources import files, sinks

D = dt.datetime


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("p1", "Anna Bell", "A1"), ("p2", "Carl Dorn", "A2"), ("p3", "Carl Dorn", "A3"), ("p4", None, None)], "id string, full_name string, badge string")


def test_person_match(spark, people):
    facts = spark.createDataFrame([(1, "BELL, Anna", None), (2, "Carl Dorn", None), (3, "Carl Dorn", "A3"), (4, None, None)], "k int, who string, badge string")
    found = {r.k: r.collaborator_id for r in curated.person_match(facts, people, "who", "badge").collect()}
    assert found == {1: "p1", 2: None, 3: "p3", 4: None}
    assert curated.person_match(facts.limit(0), people, "who").count() == 0


def test_vehicles_and_contracts(spark):
    schema = "plate_number string, vin string, make string, model string, energy string, model_category string, fiscal_type string, rebate_price double, co2_per_km double, entry_into_fleet_date date, exit_from_fleet_date date, record_date timestamp_ntz"
    raw = spark.createDataFrame([
        ("aa-123-bb", "vf1aaaaaaaaaaaaa1", "make", "m", "fuel", "car", None, 10.0, 100.0, None, None, D(2024, 1, 1)),
        ("AA123BB", None, "make", "m", "fuel", None, "x", 30.0, None, dt.date(2020, 1, 1), None, D(2024, 2, 1)),
        ("CC456DD", "bad", "-", "m", "fuel", None, "y", None, None, None, None, None), ("-", None, None, None, None, None, None, None, None, None, None, None)], schema)
    out = {r.plate_number: r for r in curated.vehicles(raw.withColumn("plate_number", F.upper("plate_number"))).collect()}
    assert set(out) == {"AA-123-BB", "CC-456-DD"}
    a, c = out["AA-123-BB"], out["CC-456-DD"]
    assert (a.vin, a.rebate_price, a.fiscal_type, a.co2_per_km) == ("VF1AAAAAAAAAAAAA1", 30.0, "personal", 100.0)
    assert (c.vin, c.make, c.co2_per_km, c.fiscal_type) == (None, None, 100.0, "y")
    base = "plate_number string, date_from timestamp_ntz, date_to timestamp_ntz, lease_start_date date, lease_end_date date, lease_months int, lease_mileage int, rent_basis string, fiscal_type string, finance double, tyres double"
    new = spark.createDataFrame([("A", D(2024, 5, 1), None, None, None, 36, 1, "ttc", "personal", 120.0, None), ("A", D(2024, 5, 1), None, None, None, 36, 2, "ttc", "personal", 120.0, None)], base)
    got = curated.contracts(new, ["finance", "tyres"]).collect()
    assert [(r.finance, r.total_rent_tax_exc, r.lease_mileage, r.lease_start_date) for r in got] == [(100.0, 100.0, None, dt.date(2024, 5, 1))]
    stored = curated.contracts(new, ["finance", "tyres"]).withColumn("total_rent_tax_exc", F.lit(50.0)).withColumn("date_from", F.lit("2023-01-01").cast("timestamp_ntz"))
    versions = curated.contracts(new, ["finance", "tyres"], stored)
    assert rows(versions.select("date_from", "date_to", "total_rent_tax_exc")) == [(D(2023, 1, 1), D(2024, 5, 1), 50.0), (D(2024, 5, 1), None, 100.0)]


def test_versions_never_overlap_and_merge_twice_is_merge_once(spark):
    stored = spark.createDataFrame([("a", 1.0, D(2020, 1, 1), D(2021, 1, 1)), ("a", 2.0, D(2021, 1, 1), None), ("b", 5.0, D(2020, 1, 1), None)], "k string, v double, s timestamp_ntz, e timestamp_ntz")
    new = spark.createDataFrame([("a", 3.0, D(2022, 1, 1), None), ("b", None, D(2022, 1, 1), None), ("c", 1.0, D(2022, 1, 1), None), (None, 1.0, D(2022, 1, 1), None)], stored.schema)
    once = merge.new_versions(stored, new, ["k"], "s", "e", {"v": "number"})
    assert rows(once) == sorted([("a", 1.0, D(2020, 1, 1), D(2021, 1, 1)), ("a", 2.0, D(2021, 1, 1), D(2022, 1, 1)), ("a", 3.0, D(2022, 1, 1), None), ("b", 5.0, D(2020, 1, 1), None), ("c", 1.0, D(2022, 1, 1), None)], key=str)
    assert rows(merge.new_versions(once, new, ["k"], "s", "e", {"v": "number"})) == rows(once)
    assert expect.interval_faults(once, ["k"], "s", "e", ["v"]).count() == 0


def test_expenses(spark, people):
    schema = "plate_number string, category string, billing_date timestamp_ntz, amount_tax_exc double, amount_tax_inc double, vat_value double, collaborator_ref string, connector_name string"
    raw = spark.createDataFrame([
        ("aa123bb", "rent", D(2024, 3, 1), 500.0, None, None, "anna bell", "x"), ("AA123BB", "rent", D(2024, 3, 2), None, 120.0, None, None, "x"),
        ("AA123BB", "fuel", D(2024, 3, 3), 100.0, None, None, None, "x"), ("AA123BB", "fuel", D(2030, 3, 3), 100.0, None, None, None, "x")], schema)
    fleet = spark.createDataFrame([("AA-123-BB", "personal", "diesel")], "plate_number string, fiscal_type string, energy string")
    versions = spark.createDataFrame([("AA-123-BB", D(2024, 1, 1), None, 100.0)], "plate_number string, date_from timestamp_ntz, date_to timestamp_ntz, total_rent_tax_exc double")
    out, late = curated.expenses(raw.withColumn("plate_number", F.upper("plate_number")), fleet, versions, people, F.lit("2024-06-01").cast("timestamp_ntz"))
    got = {r.billing_date.day: r for r in out.collect()}
    assert (got[1].category, got[1].amount_tax_inc, got[1].collaborator_id, got[1].net_amount) == ("exceptional_rent", 600.0, "p1", 600.0)
    assert (got[2].category, got[2].amount_tax_exc, got[2].vat_value) == ("rent", 100.0, 20.0)
    assert (got[3].deductible_vat, got[3].net_amount) == (16.0, 104.0)
    assert [(r.connector_name, r.n) for r in late.collect()] == [("x", 1)]


def test_mileages(spark):
    schema = "plate_number string, mileage int, mileage_date timestamp_ntz, connector_name string"
    raw = spark.createDataFrame([("A", 150, D(2024, 1, 2), "m"), ("A", 90, D(2024, 1, 3), "m"), ("A", 9000, D(2024, 1, 4), "m"), ("A", 200, D(2024, 1, 5), "m"), ("A", 300, D(2031, 1, 1), "m"), ("B", 5, D(2024, 1, 1), "m"), ("B", 7, D(2024, 1, 2), "box"), ("C", None, D(2024, 1, 1), "m")], schema)
    stored = spark.createDataFrame([("A", 100, D(2024, 1, 1))], "plate_number string, mileage int, mileage_date timestamp_ntz")
    got = curated.mileages(raw, stored, F.lit("2025-01-01").cast("timestamp_ntz"), ["box"])
    assert rows(got.select("plate_number", "mileage")) == [("A", 150.0), ("A", 200.0), ("B", 7.0)]


def test_collaborators(spark):
    schema = "full_name string, email string, role string, category string, manager_id string, personal_address string, record_date timestamp_ntz"
    raw = spark.createDataFrame([
        ("Mme Anna Bell", "Anna@x.fr", "driver", "field", "Boss Big", "3 bis rue A 69001 Lyon", D(2024, 1, 1)), ("Anna B", "anna@x.fr", None, None, None, None, D(2024, 2, 1)),
        ("Big Boss", "boss@x.fr", "driver", None, "anna@x.fr", None, D(2024, 1, 1)), ("nobody", None, None, None, None, None, None)], schema)
    got = {r.email: r for r in curated.collaborators(raw).collect()}
    assert set(got) == {"anna@x.fr", "boss@x.fr"}
    assert got["anna@x.fr"].manager == got["boss@x.fr"].id and got["boss@x.fr"].manager == got["anna@x.fr"].id
    assert got["boss@x.fr"].category == "field" and got["anna@x.fr"].names == "Anna B, Anna Bell"
    assert tuple(got["anna@x.fr"].address) == ("3 bis", "rue A", "69001", "Lyon")


def test_other_tables(spark, people):
    acc = spark.createDataFrame([("A", D(2024, 1, 5), None, 100.0, 60.0, None), ("A", D(2023, 1, 5), "z", 10.0, 6.0, 1.0)], "plate_number string, accident_date timestamp_ntz, driver string, total_cost double, organisation_cost double, self_insured double")
    drivers = spark.createDataFrame([("A", D(2024, 1, 1), None, "d1")], "plate_number string, date_from timestamp_ntz, date_to timestamp_ntz, driver string")
    assert {(r.driver, r.deductible, r.insurer_cost) for r in curated.accidents(acc, drivers).collect()} == {("d1", 60.0, 40.0), ("z", 5.0, 4.0)}
    tax = spark.createDataFrame([(None, 2024, "Q2", 1.0), (None, 2024, None, 2.0), (dt.date(2024, 2, 2), 2024, "Q1", 3.0), (None, 2024, None, None)], "start_date date, year int, quarter string, amount double")
    assert rows(curated.taxes(tax, ["amount"]).select("billing_date")) == [(dt.date(2024, 12, 31),), (dt.date(2024, 2, 2),), (dt.date(2024, 4, 1),)]
    eq = spark.createDataFrame([("e", "a, b", D(2024, 1, 1)), ("e", "c", D(2024, 2, 1)), ("f", "", None)], "equipment string, categories string, record_date timestamp_ntz")
    assert rows(curated.equipment_categories(eq)) == [("e", "a"), ("e", "b")]
    runs = spark.createDataFrame([("x", 7)], "connector_name string, synchronisation_id int")
    assert curated.synchronisation_ids(spark.createDataFrame([("x",)], "connector_name string"), runs).first().synchronisation_id == "7"
    with pytest.raises(Exception, match="no run of y"):
        curated.synchronisation_ids(spark.createDataFrame([("y",)], "connector_name string"), runs).collect()
    trips = spark.createDataFrame([("train", 100.0, None, None, "Anna Bell"), ("plane", None, None, None, None)], "travel_type string, amount_tax_exc double, amount_tax_inc double, vat_value double, traveller string")
    assert [(r.amount_tax_inc, r.collaborator_id) for r in curated.travels(trips, people, "train").collect()] == [(120.0, "p1")]


def test_values(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert [one(st.number(F.lit(x))) for x in ("1 234,50 €", "12 km", "x", None)] == [1234.5, 12.0, None, None]
    assert [one(st.boolean(F.lit(x), "oui", "non")) for x in (" OUI", "non", "?", None)] == [True, False, None, None]
    assert one(st.boolean(F.lit(None).cast("string"), "oui", "non", True)) is False
    assert one(st.plate(F.lit("ab123cd"), {"AB-123-CD": "ZZ-999-ZZ"})) == "ZZ-999-ZZ"
    assert one(st.without_status_date(F.lit("Sold le 12 janv. 2024"))) == "Sold"
    assert one(st.excel_date(F.lit(45292.0))) == dt.date(2024, 1, 1) and one(st.excel_date(F.lit(10.0))) is None
    assert one(st.zero_to_null(F.lit(0.0))) is None and one(st.whole_number_text(F.lit(12345.0), 3)) == "12345"
    assert [one(st.is_missing(F.lit(x))) for x in ("nan", "-", "x", None)] == [True, True, False, True]
    assert abs(one(st.haversine(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) - 111195) < 10
    assert one(st.phone(F.lit("+33 (0)6-12.34 56 78"))) == "06 12 34 56 78" and one(st.phone(F.lit("12"))) is None


def test_scans(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1,5;é\n2;b\n", encoding="latin-1")
    df = files.delimited(spark, str(tmp_path / "a.csv"), ["x", "y"])
    contract = [expect.Expected("amount", "double", source="x", convert=st.number), expect.Expected("label", "string", source="y"), expect.Expected("more", "date", optional=True)]
    out = files.table(df, contract, "acme", "set", "a")
    assert rows(out.select("amount", "label", "more", "source_table")) == [(1.5, "é", None, "a"), (2.0, "b", None, "a")]
    with pytest.raises(KeyError):
        expect.conform(df, [expect.Expected("z", "int")])
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in.csv", "x;y\n1;2\n3;\n")
    assert rows(files.zipped(spark, str(tmp_path / "a.zip"), ["x", "y"]).select("x", "y")) == [("1", "2"), ("3", "")]
    (tmp_path / "w.txt").write_text("#head\nAB  12\nCD  34\n#head\nEF  56\n")
    lines = spark.read.text(str(tmp_path / "w.txt"))
    fixed = files.fixed_width(files.matching_lines(lines, "[A-Z]"), {"k": (0, 2), "v": (4, 6)})
    assert rows(fixed) == [("AB", "12"), ("CD", "34"), ("EF", "56")]
    with pytest.raises(ValueError):
        files.fixed_width(lines, {"k": (2, 2)})
    numbered = spark.createDataFrame([("f", 0, "#"), ("f", 1, "a"), ("f", 2, "#"), ("f", 3, "b")], "file string, n int, value string")
    assert [r.block for r in files.blocks(numbered, F.col("value") == "#", "file", "n").orderBy("n").collect()] == [1, 1, 2, 2]
    pages = spark.createDataFrame([('{"d":{"rows":[{"a":1},{"a":2}]}}',), ('{"d":{"rows":{"a":3}}}',)], "body string")
    assert rows(files.json_pages(pages, "body", ["d", "rows"], "a:int")) == [(1,), (2,), (3,)]
    found = files.listing(spark, str(tmp_path), r"a\.")
    assert rows(found.select("name")) == [("a.csv",), ("a.zip",)] and files.newest(found).count() >= 1
    assert files.sheets(spark, str(tmp_path / "a.csv"), ["x", "y"]).first().sheet_name == "a"
    routes = spark.createDataFrame([("csv$", "o", "c"), ("a", "o2", "c2")], "pattern string, organisation string, connector string")
    assert {r.n_routes for r in files.routed_files(found, routes).collect()} == {1, 2}


def test_sinks(spark, tmp_path):
    table, df = str(tmp_path / "t"), spark.range(3)
    assert sinks.latest_version(spark, table) is None
    sinks.replace(df, table, 1)
    sinks.replace(spark.range(5), table, 2)
    assert spark.read.parquet(sinks.latest_version(spark, table)).count() == 5
    assert sinks.latest_version(spark, table, below=2).endswith("v=0000000001")
    calls = []
    for _ in range(2):
        assert sinks.cached(spark, str(tmp_path / "c"), lambda: calls.append(1) or df).count() == 3
    assert calls == [1]
    sinks.export_csv(df, str(tmp_path / "e"))
    assert spark.read.option("header", True).csv(str(tmp_path / "e")).count() == 3


def test_sources_are_chosen(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "z int")
    got = reshape.chosen({"fleet.a": a, "fleet.b": b, "other.c": a}, ["fleet.*"], any_of=[{"x", "z"}], all_of=[{"y", "w"}])
    assert got.columns == ["x", "source_table", "z"] and got.count() == 2
    with pytest.raises(LookupError):
        reshape.chosen({"fleet.a": a}, ["*"], exclude=["fleet.*"])


def test_kpi_catalogue_compiles(spark):
    formulas = kpi.catalogue({"base": ["rent"]}, {"petrol": ["fuel"]}, {"main": ["ins"]}, {"tolls": ["toll"]}, {"meal": ["meal"]}, ["train", "plane"])
    assert len(formulas) > 60
    names = {n for t in formulas.values() for e in kpi.elements(t) if e["type"] != "constant" for n in [kpi.name_of(e)]}
    flat = spark.range(1).select(*[F.lit(2.0).alias(n) for n in names])
    row = flat.select(*[kpi.compiled(t).alias(k) for k, t in formulas.items()]).first()
    assert row["tax_ikb_calculated_final"] == pytest.approx(0.96) and row["tco"] == pytest.approx(2.0 * 5 + 0.96 + 0.5 - 2.0)
    assert row["co2_rental_cars"] == pytest.approx(2 * 50 * 0.1175)
    zero = spark.range(1).select(F.lit(1.0).alias(kpi.name_of(kpi.leaf("a"))), F.lit(0.0).alias(kpi.name_of(kpi.leaf("b"))))
    assert zero.select(kpi.compiled(kpi.block(kpi.leaf("a"), "DIVIDE", kpi.leaf("b"))).alias("v")).first().v is None


def test_joins_report_what_is_wrong(spark):
    left, right = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    with pytest.raises(Exception, match="key is not unique"):
        joins.checked_join(left, right, ["k"]).collect()
    assert joins.not_in(left, right, ["k"]).count() == 0
    extra = expect.unexpected_columns(right, ["k"])
    assert rows(extra) == [("v", True)]


def test_recurring_days_do_not_drift(spark):
    df = spark.createDataFrame([("c", dt.date(2025, 1, 31), None, 10.0)], "k string, s date, e date, rent double")
    got = timeseries.recurring(df, ["k"], "s", "e", F.lit("2025-05-01").cast("date"), ["rent"])
    assert [r.due.isoformat() for r in got.orderBy("due").collect()] == ["2025-01-31", "2025-02-28", "2025-03-31", "2025-04-30"]


def test_text_rows(spark):
    pages = spark.createDataFrame([("d", 1, "Plate: AA\nKm 10\nKm 20"), ("d", 2, "Km 30\nPlate: BB\nKm 40")], "doc string, page int, text string")
    lines = text_rows.lines_of(pages, "text", ["doc", "page"])
    fields = [text_rows.Field("plate", r"Plate: (\w+)", "doc"), text_rows.Field("km", r"Km (\d+)")]
    got = text_rows.rows_from_lines(lines, "doc", "page", fields, "km")
    assert [(r.plate, r.km) for r in got.orderBy("page", "line_no").collect()] == [("AA", "10"), ("AA", "20"), ("AA", "30"), ("BB", "40")]
    once = text_rows.repeated_fields(lines, "doc", "page", [text_rows.Field("km", r"Km (\d+)", overwrite="forbid")])
    assert rows(once) == [("km", "d", 1, 2), ("km", "d", 2, 2)]
    told = spark.createDataFrame([("d", 4)], "doc string, expected int")
    assert text_rows.first_fitting({"short": got.limit(1), "full": got}, "doc", told).first().format == "full"


def test_synthetic_rows(spark):
    people = spark.createDataFrame([(f"AB-{k}",) for k in range(50)], "plate string")
    sample = synth.sampled(people, "plate", 200, seed=1)
    assert sample.count() == 200 and rows(sample) == rows(synth.sampled(people, "plate", 200, seed=1)) != rows(synth.sampled(people, "plate", 200, seed=2))
    alias = synth.unique_pseudonyms(people, "plate", people, seed=5).collect()
    assert len({r.alias for r in alias}) == 50 and not {r.alias for r in alias} & {r.plate for r in alias}
    assert all(len(r.alias) == len(r.plate) and r.alias[2] == "-" for r in alias)
    mapping = spark.createDataFrame([("AB-1", "new")], "old string, new string")
    assert synth.remapped_keys(people.where("plate = 'AB-1'"), mapping, "plate", "old", "new").first().plate == "new"
    with pytest.raises(Exception, match="no parent"):
        synth.remapped_keys(people, mapping, "plate", "old", "new").collect()
    assert synth.sampled(people.limit(0), "plate", 10).count() == 0
