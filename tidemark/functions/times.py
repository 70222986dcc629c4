"""Column functions over time: parsing, differences, local dates. Timestamps are instants; sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English month names, in order.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Hours that local wall clocks are behind UTC; fixed, without summer time.
LOCAL_OFFSET_HOURS = 10
_MONTH = "|".join(MONTHS)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value, f) -> Column:
    """f of a value that is worked out once, however often f uses it; Spark works out what stands in branches and lambdas anew for each use."""
    return F.get(F.transform(F.array(col(value)), f), 0)


def hours_between(later, earlier) -> Column:
    return (F.unix_micros(col(later)) - F.unix_micros(col(earlier))) / 3_600_000_000.0


def days_between(later, earlier) -> Column:
    """Fractional days; dates count from midnight."""
    micros = lambda c: F.unix_micros(col(c).cast("timestamp"))
    return (micros(later) - micros(earlier)) / 86_400_000_000.0


def shifted(ts, hours: float) -> Column:
    return F.timestamp_micros(F.unix_micros(col(ts)) + F.lit(round(hours * 3_600_000_000)))


def local_date(ts, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return F.to_date(shifted(ts, -offset_hours))


def to_utc(local_ts, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return shifted(local_ts, offset_hours)


def hour_of(ts) -> Column:
    return F.date_trunc("hour", col(ts))


def first_timestamp(text, formats: list[str]) -> Column:
    """The first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(col(text)), F.lit(f)) for f in formats])


def month_number(name) -> Column:
    """1 to 12 for an English month, whole or its first three letters; else null."""
    at = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(F.substring(col(name), 1, 3)))
    return once(at.cast("int"), lambda n: F.nullif(n, F.lit(0)))


def valid_date(year, month, day) -> Column:
    """The date, or null where there is none such."""
    parts = F.struct(col(year).cast("int").alias("y"), col(month).cast("int").alias("m"), col(day).cast("int").alias("d"))

    def date(p):
        text = F.concat(F.lpad(p["y"].cast("string"), 4, "0"), F.lit("-"), F.lpad(p["m"].cast("string"), 2, "0"), F.lit("-"), F.lpad(p["d"].cast("string"), 2, "0"))
        return F.when(p["y"].between(1, 9999) & p["m"].between(1, 12) & p["d"].between(1, 31), text.try_cast("date"))

    return once(parts, date)


def local_clock(text, default_year=None, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """struct(utc, exact, year) of prose like "May 6, 2025 - 12:30 a.m.".

    The year may be absent (default_year), as may minutes, and the time of day (midnight, exact 0).
    Text without a date gives a null utc and exact 0.
    """
    date = rf"({_MONTH})\s+(\d{{1,2}})(?:,?\s+(\d{{4}}))?"
    clock = r"(\d{1,2})(?::(\d{2}))?\s*([ap])\.?\s*m"
    number = lambda t: F.nullif(t, F.lit("")).cast("int")

    def found(t):
        """What is stated, each part as text; a part is looked for in what its whole pattern found first."""
        said = F.struct(F.regexp_extract(t, date, 0).alias("d"), F.regexp_extract(t, clock, 0).alias("c"))
        return once(said, lambda x: F.struct(
            F.regexp_extract(x["d"], rf"^{date}$", 1).alias("month"), F.regexp_extract(x["d"], rf"^{date}$", 2).alias("day"), F.regexp_extract(x["d"], rf"^{date}$", 3).alias("year"),
            F.regexp_extract(x["c"], rf"^{clock}$", 1).alias("hour"), F.regexp_extract(x["c"], rf"^{clock}$", 2).alias("minute"), F.regexp_extract(x["c"], rf"^{clock}$", 3).alias("half"),
        ))

    def read(x):
        hour, minute = number(x["hour"]), F.coalesce(number(x["minute"]), F.lit(0))
        default = col(default_year).cast("int") if default_year is not None else F.lit(None).cast("int")
        return F.struct(
            month_number(x["month"]).alias("month"), number(x["day"]).alias("day"), F.coalesce(number(x["year"]), default).alias("year"),
            F.coalesce((hour <= 12) & (minute < 60), F.lit(False)).alias("exact"), hour.alias("hour"), minute.alias("minute"), (x["half"] == "p").alias("late"),
        )

    def told(x):
        minutes = F.when(x["exact"], F.pmod(x["hour"], F.lit(12)) * 60 + F.when(x["late"], 720).otherwise(0) + x["minute"]).otherwise(0) + offset_hours * 60
        utc = F.timestamp_micros(F.unix_micros(valid_date(x["year"], x["month"], x["day"]).cast("timestamp")) + minutes.cast("long") * 60_000_000)
        return once(utc, lambda u: F.struct(u.alias("utc"), F.when(u.isNotNull() & x["exact"], 1).otherwise(0).alias("exact"), x["year"].alias("year")))

    t = F.regexp_replace(F.lower(F.coalesce(col(text), F.lit(""))), r"\s+", " ")
    return once(once(once(t, found), read), told)


def duration_hours(text) -> Column:
    """Hours of "14 hours", "8.5 days", "30 minutes"; null without a number and unit."""
    pattern = r"(?i)(\d+(?:\.\d+)?)\s*(day|hour|hr|minute|min)"
    n = F.regexp_extract(F.regexp_replace(col(text), ",", ""), pattern, 1)
    said = F.struct(F.nullif(n, F.lit("")).cast("double").alias("value"), F.lower(F.regexp_extract(col(text), pattern, 2)).alias("unit"))
    return once(said, lambda s: F.when(s["unit"] == "day", s["value"] * 24).when(s["unit"].isin("minute", "min"), s["value"] / 60).when(s["unit"].isin("hour", "hr"), s["value"]))


def compact_utc(text) -> Column:
    """20260813/1126Z."""
    return F.try_to_timestamp(F.regexp_extract(col(text), r"(\d{8}/\d{4})\s*Z?", 1), F.lit("yyyyMMdd/HHmm"))


def two_digit_date(text, pivot: int = 80) -> Column:
    """26JUL04; years from the pivot on are of the twentieth century."""
    part = lambda i: F.regexp_extract(col(text), r"^(\d{2})([A-Z]{3})(\d{2})$", i)
    number = lambda i: once(part(i), lambda t: F.nullif(t, F.lit("")).cast("int"))
    year = once(number(1), lambda y: F.when(y >= pivot, 1900 + y).otherwise(2000 + y))
    return valid_date(year, month_number(part(2)), number(3))


def partial_date(year, month, day) -> Column:
    """struct(date, precision): 0 and null parts are unknown; years before the common era have no date."""
    m, d = F.nullif(col(month).cast("int"), F.lit(0)), F.nullif(col(day).cast("int"), F.lit(0))
    y = col(year).cast("int")
    date = F.when(y > 0, valid_date(y, m, d))
    precision = F.when(y.isNull(), "unknown").when(m.isNull(), "year").when(d.isNull(), "month").otherwise("day")
    return F.struct(date.alias("date"), precision.alias("precision"))


def local_label(ts, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return F.date_format(shifted(ts, -offset_hours), "yyyy-MM-dd HH:mm")


def age(ts, now, unit_hours: float = 1.0) -> Column:
    return F.round(hours_between(now, ts) / unit_hours, 2)
