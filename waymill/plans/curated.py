"""Curated tables of a fleet: compositions of the operators, from raw tables by column contracts.

Each builder takes the raw table (and what it looks up) and returns the curated one; ``sources.sinks`` and
``operators.merge`` bring it into the store. Column names are those of the synthetic schemas in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.functions import standardise as st
from waymill.operators import dedupe, expect, finance, joins, timeseries
from waymill.operators.common import sent_whole
from waymill.operators.merge import new_versions, replace_computed, replace_for


def person_match(facts: DataFrame, people: DataFrame, name: str, unique: str | None = None) -> DataFrame:
    """Adds collaborator_id: by a column that is unique among people, else by the key of the name where that is."""
    own = facts.withColumn("__name", st.folded_name_key(F.col(name)))
    by_name = joins.unique_only(people.select(st.folded_name_key(F.col("full_name")).alias("__name"), F.col("id").alias("__by_name")), ["__name"])
    own = own.join(by_name, "__name", "left")
    if unique:
        by_key = joins.unique_only(people.select(F.col(unique), F.col("id").alias("__by_key")), [unique])
        own = own.join(by_key, unique, "left")
    found = F.coalesce("__by_key", "__by_name") if unique else F.col("__by_name")
    return own.withColumn("collaborator_id", found).drop("__name", "__by_name", "__by_key")


def collaborators(raw: DataFrame) -> DataFrame:
    """One row per e-mail: first known values by date, other spellings of the name listed, manager by id or name, address parts, category by role."""
    clean = raw.withColumns({"email": F.lower(st.text(F.col("email"))), "full_name": st.without_honorific(st.text(F.col("full_name")))})
    clean = clean.withColumn("email", F.nullif("email", F.lit("")))
    one = dedupe.first_values(clean, ["email"], ["record_date", "full_name"], ["full_name", "role", "category", "manager_id", "personal_address"], {"names": "full_name"})
    one = one.withColumn("id", F.sha2(F.col("email").cast("binary"), 256)).withColumn("name_key", st.folded_name_key(F.col("full_name")))
    usual = one.where("category IS NOT NULL").groupBy("role").agg(F.mode("category", True).alias("__usual"))
    one = one.join(usual, "role", "left").withColumn("category", F.coalesce("category", "__usual")).drop("__usual")
    keys = joins.unique_only(one.select(F.col("name_key").alias("__key"), F.col("id").alias("__by_name")), ["__key"])
    mails = one.select(F.col("email").alias("__mail"), F.col("id").alias("__by_mail"))
    met = one.join(mails, F.lower("manager_id") == F.col("__mail"), "left").join(keys, st.folded_name_key(F.col("manager_id")) == F.col("__key"), "left")
    return met.withColumn("manager", F.coalesce("__by_mail", "__by_name")).withColumn("address", st.address_parts(F.col("personal_address"))).drop("__mail", "__by_mail", "__key", "__by_name", "name_key", "personal_address")


def vehicles(raw: DataFrame) -> DataFrame:
    """One row per plate: each column from its latest rows, CO2 from the mean of model and energy where unknown, fiscal type by category."""
    clean = raw.withColumns({"plate_number": st.plate(st.null_if_missing(F.col("plate_number"))), "vin": st.vin(F.col("vin")), "make": F.upper(st.null_if_missing(F.col("make"))), "model": F.upper(st.null_if_missing(F.col("model")))}).where("plate_number IS NOT NULL")
    one = dedupe.latest_per_column(clean, ["plate_number"], "record_date", {"vin": "null", "make": "null", "model": "null", "energy": "null", "model_category": "null", "fiscal_type": "null", "rebate_price": "max", "co2_per_km": "max", "entry_into_fleet_date": "min", "exit_from_fleet_date": "max"})
    mean = one.groupBy("model", "energy").agg(F.avg("co2_per_km").alias("__co2"))
    met = one.join(mean, ["model", "energy"], "left").withColumn("co2_per_km", F.coalesce("co2_per_km", "__co2")).drop("__co2")
    by_category = F.create_map(*[F.lit(x) for pair in {"van": "utility", "truck": "utility", "car": "personal", "bike": "other"}.items() for x in pair])
    return met.withColumn("fiscal_type", F.coalesce(F.element_at(by_category, F.col("model_category")), F.col("fiscal_type")))


def contracts(raw: DataFrame, rents: list[str], stored: DataFrame | None = None) -> DataFrame:
    """One contract per plate and start, rents without tax and their total, key text; new versions of what is stored, within tolerances."""
    one = dedupe.conflict_to_null(raw, ["plate_number", "date_from"], ["date_to", "lease_start_date", "lease_end_date", "lease_months", "lease_mileage", "rent_basis", "fiscal_type", *rents])
    taxed = one.withColumns({r: F.round(finance.rent_without_tax(F.col(r), F.col("rent_basis"), F.col("fiscal_type")), 2) for r in rents})
    total = sum((F.coalesce(F.col(r), F.lit(0.0)) for r in rents[1:]), F.coalesce(F.col(rents[0]), F.lit(0.0)))
    out = taxed.withColumn("total_rent_tax_exc", F.round(total, 2)).withColumn("lease_start_date", F.coalesce("lease_start_date", F.to_date("date_from")))
    out = out.withColumn("sync_key", st.composite_key(plate=st.key_part(F.col("plate_number")), start=st.key_part(F.col("date_from"), "date"), rent=st.key_part(F.col("total_rent_tax_exc"), "number")))
    if stored is None:
        return out
    tracked = {"lease_months": "number", "lease_mileage": "number", "lease_end_date": "date", "total_rent_tax_exc": "number"}
    return new_versions(stored, out.select(stored.columns), ["plate_number"], "date_from", "date_to", tracked, tolerance={"lease_months": 0, "lease_mileage": 0, "total_rent_tax_exc": 1})


def expenses(raw: DataFrame, fleet: DataFrame, versions: DataFrame, people: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Amounts inferred, VAT deducted, rents far over the contract's put aside, drivers matched; and the rows dated too late, by source."""
    late = expect.future_rows(raw, "billing_date", now + F.expr("INTERVAL 3 MONTHS"), "connector_name")
    own = raw.where(F.col("billing_date") <= now + F.expr("INTERVAL 3 MONTHS")).withColumn("plate_number", st.plate(F.col("plate_number")))
    amounts = finance.infer_amounts(own.drop("deductible_vat"), "category")
    known = joins.enrich(amounts, fleet.select("plate_number", "fiscal_type", "energy"), ["plate_number"], ["fiscal_type", "energy"])
    known = known.withColumn("deductible_vat", finance.deductible_vat(F.col("fiscal_type"), F.col("category"), F.col("energy"), F.col("vat_value")))
    known = known.withColumn("net_amount", F.round(F.col("amount_tax_inc") - F.coalesce("deductible_vat", F.lit(0.0)), 2))
    dated = joins.best_interval(known, versions, "plate_number", "billing_date", "date_from", "date_to", [("__start", True)], ["total_rent_tax_exc"], closed=False, fallback=[("__start", True)])
    odd = (F.col("category") == "rent") & finance.exceptional(F.col("amount_tax_exc"), F.col("total_rent_tax_exc"))
    named = dated.withColumn("category", F.when(odd, "exceptional_rent").otherwise(F.col("category"))).drop("matched", "total_rent_tax_exc")
    return person_match(named, people, "collaborator_ref"), late


def expense_claims(raw: DataFrame) -> DataFrame:
    return finance.infer_amounts(raw.withColumn("currency", F.coalesce("currency", F.lit("EUR"))), "category")


def mileages(raw: DataFrame, stored: DataFrame, now: Column, telematics: list[str]) -> DataFrame:
    """Plausible new readings: with a value, not in the future, from telematics where a vehicle has them, and in line with what is stored."""
    clean = expect.without_missing(raw, ["plate_number", "mileage", "mileage_date"]).where(F.col("mileage_date") <= now)
    with_box = clean.where(F.col("connector_name").isin(*telematics)).select("plate_number").distinct().withColumn("__box", F.lit(True))
    best = clean.join(with_box, "plate_number", "left").where(F.col("__box").isNull() | F.col("connector_name").isin(*telematics)).drop("__box")
    both = stored.select("plate_number", "mileage_date", "mileage").unionByName(best.select("plate_number", "mileage_date", "mileage"))
    fitting = timeseries.plausible_readings(both, "plate_number", "mileage_date", "mileage").distinct()
    kept = fitting.join(stored.select("plate_number", "mileage_date").distinct(), ["plate_number", "mileage_date"], "left_anti")
    return best.withColumn("mileage", F.col("mileage").cast("double")).join(kept, ["plate_number", "mileage_date", "mileage"], "left_semi").dropDuplicates(["plate_number", "mileage_date"])


def associations(raw: DataFrame, people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct attributions with their person, and those that end before they start or overlap."""
    out = person_match(raw, people, "full_name").dropDuplicates(["plate_number", "collaborator_id", "date_from", "date_to"])
    return out, expect.interval_faults(out, ["plate_number"], "date_from", "date_to", ["collaborator_id"])


def accidents(raw: DataFrame, drivers: DataFrame) -> DataFrame:
    """Driver at the date where unknown, and the split of the cost."""
    met = joins.best_interval(raw.withColumnRenamed("driver", "__driver"), drivers.select("plate_number", "date_from", "date_to", "driver"), "plate_number", "accident_date", "date_from", "date_to", [("__start", True), ("driver", False)], ["driver"])
    deductible, insurer = finance.accident_split(F.col("total_cost"), F.col("organisation_cost"), F.col("self_insured"))
    return met.withColumn("driver", F.coalesce("__driver", "driver")).withColumns({"deductible": deductible, "insurer_cost": insurer}).drop("__driver", "matched")


def taxes(raw: DataFrame, amounts: list[str]) -> DataFrame:
    dated = raw.withColumn("billing_date", timeseries.billing_date(F.col("start_date"), F.col("year"), F.col("quarter")))
    return dated.dropna(how="all", subset=amounts)


def travels(raw: DataFrame, people: DataFrame, kind: str | None = None, default: str | None = None) -> DataFrame:
    """Hotels, rental cars, trains and planes: one kind of travel (or a default), amounts and traveller."""
    own = raw.withColumn("travel_type", F.coalesce("travel_type", F.lit(default))) if default else raw
    own = own.where(F.col("travel_type") == kind) if kind else own
    return person_match(finance.infer_amounts(own, "travel_type", untaxed=()), people, "traveller")


def equipment_categories(raw: DataFrame) -> DataFrame:
    """equipment, category: a row for each category of a comma list, first list seen."""
    from waymill.operators.reshape import exploded

    one = dedupe.first_values(raw, ["equipment"], ["record_date", "categories"], ["categories"])
    return exploded(one, "categories").withColumnRenamed("categories", "category").distinct()


def visits(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """Services or controls: computed dates replaced, vehicles with a scheduled or effective one left alone."""
    return replace_computed(stored, expect.without_missing(computed, ["plate_number"]), ["plate_number"], "scheduled_date")


def status_history(stored: DataFrame, raw: DataFrame, fleet: DataFrame, now: Column) -> DataFrame:
    """Status versions: closed once a vehicle has left the fleet."""
    met = joins.enrich(raw, fleet.select("plate_number", "exit_from_fleet_date"), ["plate_number"], ["exit_from_fleet_date"])
    own = met.withColumn("status", F.when(F.col("exit_from_fleet_date") < now.cast("date"), "closed").otherwise(st.without_status_date(F.col("status"))))
    one = dedupe.conflict_to_null(own, ["plate_number"], ["status", "date_from"]).withColumn("date_to", F.lit(None).cast("timestamp_ntz"))
    return new_versions(stored, one.select(stored.columns), ["plate_number"], "date_from", "date_to", {"status": "text"})


def connector_ids(stored: DataFrame, raw: DataFrame, connectors: list[str]) -> DataFrame:
    """External ids of vehicles, people or units: those of some connectors replaced."""
    one = dedupe.conflict_to_null(raw, ["entity_id", "connector_name", "external_id"], ["params"])
    return replace_for(stored, one, "connector_name", connectors)


def documents(stored: DataFrame, files: DataFrame) -> DataFrame:
    """Files by plate and content hash that are not stored yet."""
    return joins.not_in(files.dropDuplicates(["plate_number", "sha256"]), stored, ["plate_number", "sha256"])


def synchronisation_ids(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Adds the id of each connector's run; a connector without one fails while the job runs."""
    met = rows.join(sent_whole(runs.select("connector_name", "synchronisation_id", F.lit(True).alias("__run"))), "connector_name", "left")
    told = F.raise_error(F.concat(F.lit("no run of "), F.coalesce("connector_name", F.lit("null")))).cast("string")
    return met.withColumn("synchronisation_id", F.when(F.col("__run"), F.col("synchronisation_id").cast("string")).otherwise(told)).drop("__run")


def active_fleet(fleet: DataFrame, people: DataFrame, attributions: DataFrame, now: Column) -> DataFrame:
    """Vehicles in the fleet with their current driver."""
    here = fleet.where(F.col("exit_from_fleet_date").isNull() | (F.col("exit_from_fleet_date") >= now.cast("date")))
    current = dedupe.first_per_key(attributions.where(joins.covers(now, F.col("date_from"), F.col("date_to"))), ["plate_number"], [F.desc("date_from"), F.asc("collaborator_id")])
    names = people.select(F.col("id").alias("collaborator_id"), "full_name")
    return here.join(current.select("plate_number", "collaborator_id"), "plate_number", "left").join(names, "collaborator_id", "left")
