"""Column functions over numbers and places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.times import col, once

#: The mean radius of the earth, feet in metres, number words.
EARTH_RADIUS_KM = 6371.0088
FEET_TO_METRES = 0.3048
NUMBER_WORDS = {"no": 0, "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10}


def first_number(text) -> Column:
    found = F.regexp_extract(F.regexp_replace(col(text), ",", ""), r"-?\d+(?:\.\d+)?", 0)
    return once(found, lambda t: F.nullif(t, F.lit("")).cast("double"))


def number_or_word(text) -> Column:
    """A number in digits or a word from no to ten."""
    words = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])
    return F.coalesce(F.try_element_at(words, F.lower(F.trim(col(text)))), first_number(text).cast("int"))


def height_m(text) -> Column:
    """Metres as stated, else feet turned into metres to one place."""
    said = lambda t, units: once(F.regexp_extract(t, rf"(\d+(?:\.\d+)?)\s*(?:{units})\b", 1), lambda n: F.nullif(n, F.lit("")).cast("double"))
    return once(F.regexp_replace(F.lower(col(text)), ",", ""), lambda t: F.coalesce(said(t, "meters?|metres?|m"), F.round(said(t, "feet|foot|ft") * FEET_TO_METRES, 1)))


def haversine_km(lat, lon, lat0: float, lon0: float, places: int = 3) -> Column:
    """Great-circle distance from a fixed point."""
    a, b = F.radians(col(lat)), F.radians(F.lit(float(lat0)))
    h = F.pow(F.sin((a - b) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(col(lon)) - F.radians(F.lit(float(lon0)))) / 2), 2)
    return F.round(2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h))), places)


def guarded_ratio(top, bottom) -> Column:
    """Null unless the denominator is above zero."""
    return F.when(col(bottom) > 0, col(top) / col(bottom))


def moment(magnitude) -> Column:
    return F.pow(F.lit(10.0), 1.5 * col(magnitude) + 9.1)


def hit(value, low, high) -> Column:
    """1 or 0 by whether the value lies between, null where there is no value."""
    return F.when(col(value).isNull(), None).when(col(value).between(col(low), col(high)), 1).otherwise(0)


def rank_at(q: float, n) -> Column:
    """The place, from 1, of a quantile among n values in order: half-even rounding of q * (n - 1)."""
    return (1 + F.bround(F.lit(q) * (col(n) - 1))).cast("int")


def nearest_rank(values, q: float) -> Column:
    """The quantile at the index that half-even rounding gives; values is an array."""
    ordered = F.sort_array(values)
    return F.try_element_at(ordered, rank_at(q, F.size(ordered)))


def signed(magnitude, kind, negative_prefix: str = "deflation", most: float = 200.0) -> Column:
    """The magnitude with the sign of its kind; null outside 0 < x <= most."""
    value = F.when(col(kind).startswith(negative_prefix), -col(magnitude)).otherwise(col(magnitude))
    return F.when((col(magnitude) > 0) & (col(magnitude) <= most), value)


def json_number(value) -> Column:
    """A number as JSON text: without an exponent from 1e-6 up to 1e21, where casts write one below 1e-3 and from 1e7 on; NaN and infinities are in quotes, as to_json has them."""
    value = col(value).cast("double")
    size, text = F.abs(value), value.cast("string")
    plain = lambda scale: F.regexp_replace(text.try_cast(f"decimal(38,{scale})").cast("string"), r"(\.\d+?)0+$", "$1")
    return (
        F.when(F.isnan(value) | (size == float("inf")), F.concat(F.lit('"'), text, F.lit('"')))
        .when((size >= 1e-6) & (size < 1e-3), plain(25))
        .when((size >= 1e7) & (size < 1e21), plain(12))
        .otherwise(F.regexp_replace(text, r"(\.0)?E", "e"))
    )
