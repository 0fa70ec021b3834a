"""Value standardisation: each function takes and returns a Column, built from Spark's own expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value, exact and case-sensitive.
NULL_TOKENS = ("", "nan", "NaT", "None", " ", "<NA>", "-")
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
#: Words removed from a number text, in this order.
NUMBER_NOISE = (" ", " ", "€", "TTC", "HT", "km", "ans", "an", "'")
PLATE = r"^([A-Za-z]{2})-?([0-9]{3})-?([A-Za-z]{2})$"
VIN = "^[A-HJ-NPR-Z0-9]{17}$"


def is_missing(c: Column) -> Column:
    """True for null and for the null tokens; never null itself."""
    return c.isNull() | c.cast("string").isin(*NULL_TOKENS)


def null_if_missing(c: Column) -> Column:
    return F.when(~is_missing(c), c)


def text(c: Column) -> Column:
    """Trimmed text, null as the empty one."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def without_accents(c: Column) -> Column:
    """Dashes as blanks, Latin accents folded, other characters outside ASCII dropped."""
    return F.regexp_replace(F.translate(F.translate(c, "-", " "), ACCENTED, PLAIN), r"[^\x00-\x7F]", "")


def number(c: Column, decimal: str = ",", noise: tuple[str, ...] = NUMBER_NOISE) -> Column:
    """A double of a text with units and blanks; what is no number then is null."""
    bare = reduce(lambda x, word: F.replace(x, F.lit(word), F.lit("")), noise, c.cast("string"))
    return (F.replace(bare, F.lit(decimal), F.lit(".")) if decimal != "." else bare).try_cast("double")


def number_with_unit(c: Column, decimal: str = ",", thousands: str = " ", unit: str = "") -> Column:
    """As ``number``, after removing one thousands mark and one unit."""
    bare = reduce(lambda x, word: F.replace(x, F.lit(word), F.lit("")), [w for w in (thousands, unit) if w], c.cast("string"))
    return number(bare, decimal, ())


def whole_number_text(c: Column, width: int = 0) -> Column:
    """A number as digits, with zeros in front up to a width; longer ones are not cut."""
    digits = c.cast("double").cast("long").cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def implied_decimals(c: Column, places: int) -> Column:
    return c.cast("double") / 10**places


def zero_to_null(c: Column) -> Column:
    return F.when(~(F.abs(c) <= 1e-8), c)


def grams_to_kilos(c: Column) -> Column:
    return c / 1000


def boolean(c: Column, positive: str, negative: str, null_is_false: bool = False) -> Column:
    """True or false for the two words, in any case; null for null (or false); anything else is null: see ``expect``."""
    word = F.lower(F.trim(c.cast("string")))
    out = F.when(word == positive.lower(), True).when(word == negative.lower(), False)
    return F.coalesce(out, F.when(is_missing(c), False)) if null_is_false else out


def timestamp(c: Column, formats: tuple[str, ...]) -> Column:
    """The first format that fits; null where none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def excel_date(c: Column) -> Column:
    """A spreadsheet serial number as a date; null outside 30000 to 55000."""
    return F.when(c.between(30000, 55000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(c).cast("int")))


def wall_clock(c: Column) -> Column:
    """An ISO 8601 text without its offset, as the time that it shows."""
    return F.regexp_replace(c, r"(Z|[+-]\d\d:?\d\d)$", "").try_cast("timestamp_ntz")


def date_or_time(c: Column) -> Column:
    """A date text of ten characters, or a longer one with its time."""
    return F.when(F.length(c) == 10, F.concat(c, F.lit(" 00:00:00"))).otherwise(c).try_cast("timestamp_ntz")


def local_time(c: Column, zone: str = "Europe/Paris") -> Column:
    """A UTC wall-clock time as that of a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c)


def plate(c: Column, corrections: dict[str, str] | None = None) -> Column:
    """Plates as AA-123-AA, upper case; others stay as cleaned; a few corrections by their cleaned form win."""
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"[' ]", ""), "_", "-"), r"^VEC", "")
    shaped = F.when(clean.rlike(PLATE), F.upper(F.regexp_replace(clean, PLATE, "$1-$2-$3"))).otherwise(clean)
    if not corrections:
        return shaped
    known = F.create_map(*[F.lit(x) for pair in corrections.items() for x in pair])
    return F.coalesce(F.element_at(known, shaped), shaped)


def vin(c: Column) -> Column:
    """A vehicle identification number in capitals without blanks; null if its form is wrong."""
    clean = F.upper(F.replace(c, F.lit(" "), F.lit("")))
    return F.when(clean.rlike(VIN), clean)


def phone(c: Column) -> Column:
    """A French number as groups of two: 0X XX XX XX XX; null if it has none of the three usual forms."""
    digits = F.regexp_replace(F.replace(c, F.lit("(0)"), F.lit("")), r"[ .\-]", "")
    nine = F.coalesce(*[F.nullif(F.regexp_extract(digits, p, 1), F.lit("")) for p in (r"^\+33(\d{9})$", r"^0033(\d{9})$", r"^0(\d{9})$")])
    ten = F.concat(F.lit("0"), nine)
    return F.when(nine.isNotNull(), F.concat_ws(" ", *[F.substring(ten, k, 2) for k in (1, 3, 5, 7, 9)]))


def name_key(c: Column) -> Column:
    """The words of a name, sorted, repeats included."""
    return F.array_join(F.array_sort(F.split(F.trim(c), r"\s+")), " ")


def folded_name_key(c: Column) -> Column:
    return name_key(F.lower(F.replace(without_accents(c), F.lit(","), F.lit(" "))))


def without_status_date(c: Column) -> Column:
    """A status without its trailing French date, as in ' le 12 janv. 2024'."""
    return F.regexp_replace(c, r"\s+le \d{1,2} \S+ \d{4}$", "")


def without_honorific(c: Column) -> Column:
    """A person's name without its title in front or maiden name behind."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"^(?i)(m\.|mr|mme|mlle|monsieur|madame)\s+", ""), r"(?i)\s+(née|nee)\s+.*$", ""))


def remapped(c: Column, values: dict[str, str]) -> Column:
    """A short list of literal replacements; other values stay."""
    known = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.element_at(known, c), c)


def json_wrap(c: Column, key: str, **extra: str) -> Column:
    """{"key": value, …} as text; null values are left out."""
    return F.to_json(F.struct(c.alias(key), *[F.lit(v).alias(k) for k, v in extra.items()]))


def json_at(c: Column, *path: str) -> Column:
    """The text at a path of a JSON text; null where it is missing or the text is no JSON."""
    return F.get_json_object(c, "$" + "".join(f"['{p}']" for p in path))


def address_parts(c: Column) -> Column:
    """struct<number, street, postal_code, city> of 'number street postcode city'; a city in front of its postcode is accepted."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(c), r"[,\s]+", " "), r"(?i)\s*cedex(\s+\d+)?$", "")
    code = F.nullif(F.regexp_extract(clean, r"\b(\d{5})\b", 1), F.lit(""))
    city = F.nullif(F.trim(F.regexp_extract(clean, r"\b\d{5}\b(.*)$", 1)), F.lit(""))
    front = F.trim(F.regexp_replace(clean, r"\b\d{5}\b.*$", ""))
    no = F.nullif(F.trim(F.lower(F.regexp_extract(front, r"(?i)^(\d+\s?(?:bis|ter|quater|b|t|q)?)\b", 1))), F.lit(""))
    street = F.nullif(F.trim(F.regexp_replace(front, r"(?i)^\d+\s?(?:bis|ter|quater|b|t|q)?\b", "")), F.lit(""))
    swapped = city.isNull() & code.isNotNull() & no.isNull()
    return F.struct(no.alias("number"), F.when(~swapped, street).alias("street"), code.alias("postal_code"), F.when(swapped, street).otherwise(city).alias("city"))


def composite_key(**parts: Column) -> Column:
    """name:value|name:value…, values as given by ``key_part``."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{name}:"), value) for name, value in parts.items()])


def key_part(c: Column, kind: str = "text") -> Column:
    """One value of a composite key: dates as yyyy-MM-dd, numbers with two decimals, missing ones as a dash."""
    shown = F.date_format(c, "yyyy-MM-dd") if kind == "date" else F.round(c.cast("decimal(18,4)"), 2).cast("decimal(18,2)").cast("string") if kind == "number" else c.cast("string")
    return F.coalesce(shown, F.lit("-"))


def content_hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def nearly_equal(a: Column, b: Column, kind: str = "text") -> Column:
    """Null-safe equality: dates within a day, numbers within 1e-8 + 1e-5 of the second, others exactly."""
    if kind == "date":
        near = F.abs(F.datediff(a, b)) <= 1
    elif kind == "number":
        near = F.abs(a - b) <= 1e-8 + 1e-5 * F.abs(b)
    else:
        near = a == b
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(near)


def lifecycle_share(km: Column, full: float = 200_000.0, first: float = 0.6, at: float = 50_000.0) -> Column:
    """Share of a lifecycle footprint that a mileage has used: ``first`` of it up to ``at`` km, the rest up to ``full`` km."""
    early, late = first * km / at, first + (1 - first) * (km - at) / (full - at)
    return F.when(km.isNull(), None).when(km <= 0, 0.0).when(km < at, early).when(km < full, late).otherwise(1.0)


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = 6_371_008.8) -> Column:
    """Great-circle distance in metres of two places in degrees."""
    half = F.sin(F.radians(lat2 - lat1) / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * radius * F.asin(F.sqrt(F.when(half > 1, 1.0).otherwise(half)))


def wkt_point(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT("), coordinates(lon, lat), F.lit(")"))


def coordinates(lon: Column, lat: Column) -> Column:
    """lon lat with whole numbers shown without decimals."""
    shown = lambda c: F.regexp_replace(c.cast("double").cast("decimal(18,7)").cast("string"), r"\.?0+$", "")
    return F.concat_ws(" ", shown(lon), shown(lat))
