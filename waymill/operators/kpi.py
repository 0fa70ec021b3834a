"""KPI formulas as data: trees of operators, constants and primitives, compiled to columns over one aggregate table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.operators.common import fresh

SOCIAL_RATE, CORPORATE_RATE = 0.48, 0.25
#: Kilometres a day and kg of CO2 a km of a rental car.
RENTAL_KM_DAY, RENTAL_CO2_KM = 50, 0.1175
#: kg of CO2 and euros a km of a taxi; what is taken off a fare, below zero as in the figures that must agree.
TAXI_CO2_KM, TAXI_EUR_KM, TAXI_BASE = 0.1755, 1.27, -4.4
OPERATORS = {"+": "+", "-": "-", "x": "x", "*": "x", "/": "/", "PLUS": "+", "MINUS": "-", "TIMES": "x", "DIVIDE": "/"}
#: Amount column of each view of an expense; claims have the same under ``claim_``, accident costs under ``cost_``.
TAX_VIEWS = {"tax_exc": "amount_tax_exc", "deduc_vat": "deductible_vat", "net": "net_amount"}

Primitive = Callable[[dict], Column]


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,4)")


def amounts(key: str, prefix: str = "") -> Primitive:
    """Sum of the amount of a view over rows of the element's kinds; one kind may stand alone."""
    return lambda e: F.sum(F.when(of_kinds(e, key), money(prefix + TAX_VIEWS[e.get("kpi_type", "net")]))).cast("double")


def total(column: str) -> Primitive:
    return lambda e: F.sum(money(column)).cast("double")


def of_kinds(e: dict, key: str) -> Column:
    return F.col(key).isin(*(e["value"] if isinstance(e["value"], list) else [e["value"]]))


def sum_of(key: str, value: str) -> Primitive:
    """Sum of a column over rows of the element's kinds."""
    return lambda e: F.sum(F.when(of_kinds(e, key), money(value))).cast("double")


def count_of(key: str) -> Primitive:
    return lambda e: F.count(F.when(of_kinds(e, key), 1)).cast("double")


#: Aggregates over a perimeter and period, by element type; columns are those of the fact table given to ``evaluate``.
PRIMITIVES: dict[str, Primitive] = {
    "expense": amounts("category"),
    "expense-claims": amounts("claim_category", "claim_"),
    "insurance": amounts("payer", "cost_"),
    "travel-expenses": amounts("travel_type"),
    "travel-distance": sum_of("travel_type", "distance"),
    "travel-occurrences": count_of("travel_type"),
    "travel-anticipation": lambda e: F.avg(F.when(of_kinds(e, "travel_type"), F.datediff("travel_date", "booking_date"))),
    "rental-cars-days": total("rental_days"),
    "lease-mileage": total("lease_mileage"),
    "lease-months": total("lease_months"),
    "vehicle-price": total("price"),
    "participation": lambda e: -F.sum(F.col("days_active") * money("daily_participation")).cast("double"),
    "declared-non-deduc-amortization": total("declared_amortisation"),
    "calculated-non-deduc-amortization": total("amortisation"),
    "ikb_purchase_with_fuel": total("ikb_purchase_with_fuel"),
    "ikb_purchase_without_fuel": total("ikb_purchase_without_fuel"),
    "ikb_expense_with_fuel": total("ikb_expense_with_fuel"),
    "ikb_expense_without_fuel": total("ikb_expense_without_fuel"),
    "ikb_calculated_final": total("ikb_final"),
    "CO2-usage": lambda e: F.sum(money("co2_scope1") + money("co2_scope2") + money("co2_scope3")).cast("double"),
    "CO2-production": total("co2_production"),
    "CO2-recycling": total("co2_recycling"),
    "CO2-trains": total("co2_trains"),
    "CO2-planes": total("co2_planes"),
}
#: Columns whose different values are counted.
COUNTED = {"total-vehicles": "vehicle_id", "total-drivers": "driver_id", "total-collaborators": "collaborator_id", "total-users": "user_id", "total-travellers": "traveller_id"}
#: Aggregates over one vehicle's readings, summed over the vehicles of a perimeter: its span, and its latest reading
#: (the largest of a day). Rows without vehicle or reading don't count.
BY_VEHICLE: dict[str, Callable[[], Column]] = {
    "total-mileage": lambda: F.max("mileage") - F.min("mileage"),
    "current-mileage": lambda: F.max(F.struct("mileage_date", "mileage"))["mileage"],
}


def elements(tree: dict) -> Iterable[dict]:
    """The leaves of a tree: a bare element, or a block of left and right."""
    if "type" in tree:
        yield tree
    else:
        yield from elements(tree["left"])
        if tree.get("right"):
            yield from elements(tree["right"]["element"])


def name_of(element: dict) -> str:
    value = element.get("value")
    return f"{element['type']}:{'|'.join(value) if isinstance(value, list) else value}:{element.get('kpi_type', '')}"


def compiled(tree: dict, implied: str = "x") -> Column:
    """The value of a tree over columns named by ``name_of``; division by zero is null; a block without operator takes ``implied``."""
    if "type" in tree:
        return F.lit(float(tree["value"])) if tree["type"] == "constant" else F.col(f"`{name_of(tree)}`")
    left = compiled(tree["left"], implied)
    if not tree.get("right"):
        return left
    right, op = compiled(tree["right"]["element"], implied), OPERATORS[tree["right"].get("operator") or implied]
    return F.try_divide(left, right) if op == "/" else left + right if op == "+" else left - right if op == "-" else left * right


def distinct_counts(facts: DataFrame, perimeter: list[str], counted: dict[str, str]) -> DataFrame:
    """The perimeter and, for each name, how many different values its column has; no row where all are null.

    All columns in one pass: values are first made one of each by (perimeter, column, value), in narrow rows that Spark
    reduces before it exchanges them, then counted; facts are not copied for each column.
    """
    values = F.array(*[F.struct(F.lit(n).alias("which"), F.col(c).cast("string").alias("value")) for n, c in enumerate(counted.values())])
    which, value = fresh(perimeter, "which", "value")
    each = facts.select(*perimeter, F.inline(values).alias(which, value)).where(F.col(value).isNotNull()).distinct()
    return each.groupBy(*perimeter).agg(*[F.count_if(F.col(which) == n).cast("double").alias(name) for n, name in enumerate(counted)])


def beside(grouped: DataFrame, other: DataFrame, perimeter: list[str]) -> DataFrame:
    """Two tables of one row a perimeter, nulls equal."""
    if not perimeter:
        return grouped.crossJoin(other)  # one row each
    held = fresh([*grouped.columns, *other.columns], *[f"p{n}" for n in range(len(perimeter))])
    return grouped.join(other.withColumnsRenamed(dict(zip(perimeter, held))), [F.col(c).eqNullSafe(F.col(h)) for c, h in zip(perimeter, held)], "left").drop(*held)


def evaluate(facts: DataFrame, perimeter: list[str], formulas: dict[str, dict]) -> DataFrame:
    """One row per perimeter, one column per formula: each primitive is aggregated once.

    Sums are one grouping; different values (``distinct_counts``) and odometers, taken by vehicle first, are groupings of
    their own that are joined by the perimeter.
    """
    leaves = {name_of(e): e for tree in formulas.values() for e in elements(tree) if e["type"] != "constant"}
    counted = {n: COUNTED[e["type"]] for n, e in leaves.items() if e["type"] in COUNTED}
    odometers = {n: e["type"] for n, e in leaves.items() if e["type"] in BY_VEHICLE}
    needed = [PRIMITIVES[e["type"]](e).alias(n) for n, e in leaves.items() if n not in counted and n not in odometers]
    grouped = facts.groupBy(*perimeter).agg(*needed or [F.count("*").alias("n_facts")])
    if counted:
        grouped = beside(grouped, distinct_counts(facts, perimeter, counted), perimeter).fillna(0.0, subset=[*counted])
    if odometers:
        each = facts.where("vehicle_id IS NOT NULL AND mileage IS NOT NULL").groupBy(*perimeter, "vehicle_id").agg(*[BY_VEHICLE[t]().alias(n) for n, t in odometers.items()])
        grouped = beside(grouped, each.groupBy(*perimeter).agg(*[F.sum(money(f"`{n}`")).cast("double").alias(n) for n in odometers]), perimeter)
    return grouped.select(*perimeter, *[compiled(t).alias(k) for k, t in formulas.items()])


def constant(value: float) -> dict:
    return {"type": "constant", "value": value}


def leaf(kind: str, value: object = None, view: str | None = None) -> dict:
    return {"type": kind, "value": value} | ({"kpi_type": view} if view else {})


def block(left: dict, operator: str, right: dict) -> dict:
    return {"left": left, "right": {"operator": operator, "element": right}}


def family(kind: str, prefix: str, categories: dict[str, list[str]]) -> dict[str, dict]:
    """A formula for each named list of categories and each tax view."""
    return {f"{prefix}_{name}_{view}": leaf(kind, values, view) for name, values in categories.items() for view in TAX_VIEWS}


def summed(parts: list[dict]) -> dict:
    out = parts[0]
    for p in parts[1:]:
        out = block(out, "+", p)
    return out


class Catalogue(dict):
    """Formulas by name; a name may be given once."""

    def __setitem__(self, name: str, tree: dict) -> None:
        if name in self:
            raise ValueError(f"KPI {name} is there already")
        super().__setitem__(name, tree)

    def add(self, formulas: dict[str, dict]) -> None:
        for name, tree in formulas.items():
            self[name] = tree


IKB = ("ikb_purchase_with_fuel", "ikb_purchase_without_fuel", "ikb_expense_with_fuel", "ikb_expense_without_fuel", "ikb_calculated_final")
AMORTISATIONS = ("declared-non-deduc-amortization", "calculated-non-deduc-amortization")
PAYERS = {"self_insurance": ["self"], "insurer_cost": ["insurer"]}
PENALTIES = {"fines": ["fine"], "bonus": ["bonus"], "malus": ["malus"]}


def catalogue(rents: dict[str, list[str]], energies: dict[str, list[str]], insurances: dict[str, list[str]], others: dict[str, list[str]], claims: dict[str, list[str]], travels: list[str], distances: tuple[str, ...] = ("train", "plane"), penalties: dict[str, list[str]] = PENALTIES, taxi: str = "taxi") -> dict[str, dict]:
    """The whole catalogue from the categories of a fleet: components, totals, taxes, ownership, mobility, CO2 and ratios.

    distances: the travels whose distance is known. Names are given once, or it is an error.
    """
    out = Catalogue()
    for kind, prefix, categories in (("expense", "rent", rents), ("expense", "energy", energies), ("expense", "insurance", insurances), ("expense", "other", others), ("expense-claims", "claims", claims)):
        out.add(family(kind, prefix, categories))
        if categories:
            every = sorted({c for values in categories.values() for c in values})
            out.add({f"{prefix}_total_{view}": leaf(kind, every, view) for view in TAX_VIEWS})
    out.add(family("insurance", "accident", PAYERS))
    out.add({name: leaf("expense", values, "net") for name, values in penalties.items()})
    for ikb in IKB:
        out.add({ikb: leaf(ikb), f"tax_{ikb}": block(constant(SOCIAL_RATE), "x", leaf(ikb))})
    for nda in AMORTISATIONS:
        out.add({nda: leaf(nda), f"tax_{nda}": block(constant(CORPORATE_RATE), "x", leaf(nda))})
    out["participation"] = leaf("participation")
    out.add({f"travel_distance_{t}": leaf("travel-distance", [t]) for t in travels if t in distances})
    for t in travels:
        out.add({f"travel_occurrences_{t}": leaf("travel-occurrences", [t]), f"travel_anticipation_{t}": leaf("travel-anticipation", [t])})
    out.add(family("travel-expenses", "travel_expenses", {t: [t] for t in travels}))
    out.add({m: leaf(m) for m in ("total-mileage", "current-mileage", "lease-mileage", "lease-months")})
    taxes = block(out["tax_ikb_calculated_final"], "+", out["tax_calculated-non-deduc-amortization"])
    out["taxes_total"] = taxes
    fleet = [out[f"{p}_total_net"] for p in ("rent", "energy", "insurance", "other", "claims") if f"{p}_total_net" in out]
    tco = block(block(summed(fleet), "+", taxes), "-", leaf("participation"))
    out.add({"tco": tco, "tco_per_vehicle": block(tco, "/", leaf("total-vehicles")), "tco_per_driver": block(tco, "/", leaf("total-drivers")), "tco_per_km": block(tco, "/", leaf("total-mileage"))})
    tcm = summed([tco, *(out[f"travel_expenses_{t}_net"] for t in travels)])
    out.add({"tcm": tcm, "tcm_per_collaborator": block(tcm, "/", leaf("total-collaborators")), "tcm_per_user": block(tcm, "/", leaf("total-users"))})
    trips = leaf("travel-occurrences", list(travels))
    for view in TAX_VIEWS if travels else ():
        spend = summed([out[f"travel_expenses_{t}_{view}"] for t in travels])
        out.add({f"travel_total_{view}": spend, f"travel_per_trip_{view}": block(spend, "/", trips), f"travel_per_traveller_{view}": block(spend, "/", leaf("total-travellers"))})
    out.add(emissions(trips if travels else None, taxi))
    return dict(out)


def emissions(trips: dict | None, taxi: str) -> dict[str, dict]:
    """CO2 by source, its sums, and ratios to people, vehicles, kilometres, travellers and trips."""
    out = Catalogue()
    fare = block(leaf("expense-claims", [taxi], "net"), "+", leaf("expense-claims", [taxi], "deduc_vat"))
    out.add({f"co2_{x}": leaf(f"CO2-{x}") for x in ("usage", "production", "recycling", "trains", "planes")})
    out["co2_rental_cars"] = block(leaf("rental-cars-days"), "x", constant(RENTAL_KM_DAY * RENTAL_CO2_KM))
    out["co2_taxi"] = block(block(fare, "-", constant(TAXI_BASE)), "x", constant(TAXI_CO2_KM / TAXI_EUR_KM))
    ways = ("trains", "planes", "taxi", "rental_cars")
    out["co2_fleet"] = summed([out["co2_usage"], out["co2_production"], out["co2_recycling"]])
    out["co2_travel"] = summed([out[f"co2_{w}"] for w in ways])
    out["co2_total"] = block(out["co2_fleet"], "+", out["co2_travel"])
    out["co2_per_collaborator"] = block(out["co2_total"], "/", leaf("total-collaborators"))
    out["co2_per_km"] = block(out["co2_fleet"], "/", leaf("total-mileage"))
    for part in ("fleet", "usage", "production", "recycling"):
        out.add({f"co2_{part}_per_driver": block(out[f"co2_{part}"], "/", leaf("total-drivers")), f"co2_{part}_per_vehicle": block(out[f"co2_{part}"], "/", leaf("total-vehicles"))})
    for part in ("travel", *ways):
        out[f"co2_{part}_per_traveller"] = block(out[f"co2_{part}"], "/", leaf("total-travellers"))
    for part in ("travel", "trains", "planes", "rental_cars") if trips else ():
        out[f"co2_{part}_per_trip"] = block(out[f"co2_{part}"], "/", trips)
    return out


def labelled(names: list[str], labels: dict[str, str], views: dict[str, str], taxes: str = "taxes") -> dict[str, str]:
    """Names in another language: a known name's label, or that of the name without its view or its tax mark; an unknown one is an error."""
    out = {}
    for name in names:
        view = next((v for v in views if name.endswith(f"_{v}") and name.removesuffix(f"_{v}") in labels), None)
        if name in labels:
            out[name] = labels[name]
        elif view:
            out[name] = f"{labels[name.removesuffix(f'_{view}')]} {views[view]}"
        elif name.startswith("tax_") and name.removeprefix("tax_") in labels:
            out[name] = f"{taxes} - {labels[name.removeprefix('tax_')]}"
        else:
            raise LookupError(f"no label of {name}")
    return out


def in_perimeter(df: DataFrame, perimeter: dict[str, list]) -> DataFrame:
    for column, values in perimeter.items():
        df = df.where(F.col(column).isin(*values))
    return df
