"""Landed payload files to typed tables: catalogues, event feeds, manifests, notices, pages and series.

Each function takes a DataFrame of raw records (as spark.read gives them) or of text lines with their
file names, and returns a typed table; nothing is fetched. Rows without a key or time are left out.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import first_number, haversine_km, height_m
from tidemark.functions.texts import group, squeezed, strip_tags, table_cells
from tidemark.functions.times import compact_utc, duration_hours, first_timestamp, hours_between, local_clock, local_date, partial_date, to_utc, two_digit_date

# --- JSON catalogues and feeds

CATALOGUE = """features array<struct<properties: struct<Eruption_Number: int, Activity_Type: string, ExplosivityIndexMax: int,
    StartDateYear: int, StartDateMonth: int, StartDateDay: int, EndDateYear: int, EndDateMonth: int, EndDateDay: int>>>"""
FEED = """features array<struct<id: string, properties: struct<time: bigint, mag: double, magType: string, place: string, status: string>,
    geometry: struct<coordinates: array<double>>>>"""
ITEM = """id string, title string, identifiers array<struct<type: string, key: string>>, dates array<struct<type: string, dateString: string>>,
    files array<struct<name: string, size: bigint, url: string>>, facets array<struct<files: array<struct<name: string, size: bigint, url: string>>>>"""
NOTICES = """noticeData array<struct<noticeIdentifier: string, noticeHtml: string, sentUtc: string, noticeTypeCd: string, permLink: string, noticeUrl: string>>"""


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents under an explicit schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def eruptions(raw: DataFrame) -> DataFrame:
    """A catalogue of eruptions: partial dates with their precision, and a duration where both ends are exact."""
    p = raw.select(F.explode("features").alias("f")).select("f.properties.*")
    start = partial_date("StartDateYear", "StartDateMonth", "StartDateDay")
    end = partial_date("EndDateYear", "EndDateMonth", "EndDateDay")
    none0 = lambda c: F.nullif(F.col(c), F.lit(0))
    return p.where(F.col("Eruption_Number").isNotNull()).select(
        F.col("Eruption_Number").alias("eruption_number"), F.col("Activity_Type").alias("activity_type"), F.col("ExplosivityIndexMax").alias("vei"),
        F.col("StartDateYear").alias("start_year"), none0("StartDateMonth").alias("start_month"), none0("StartDateDay").alias("start_day"),
        start["date"].alias("start_date"), start["precision"].alias("start_precision"),
        F.col("EndDateYear").alias("end_year"), end["date"].alias("end_date"), end["precision"].alias("end_precision"),
        F.datediff(end["date"], start["date"]).alias("duration_days"),
    )


def event_feed(raw: DataFrame, lat0: float, lon0: float) -> DataFrame:
    """Events with time and place, and their distance from a fixed point; others are left out."""
    f = raw.select(F.explode("features").alias("f")).select("f.id", "f.properties.*", F.col("f.geometry.coordinates").alias("xyz"))
    at = lambda i: F.try_element_at("xyz", F.lit(i))
    e = f.select(F.col("id").alias("event_id"), F.timestamp_millis("time").alias("time"), at(2).alias("latitude"), at(1).alias("longitude"), at(3).alias("depth_km"), F.col("mag").alias("magnitude"), "magType", "place", "status")
    e = e.dropna(subset=["event_id", "time", "latitude", "longitude"])
    return e.withColumn("distance_km", haversine_km("latitude", "longitude", lat0, lon0))


def manifest(raw: DataFrame, suffixes: Sequence[str] = (), max_bytes: int | None = None) -> DataFrame:
    """The files of an item and its facets: wanted suffixes, not too large, with an url; the first of equal names."""
    facets = F.flatten(F.coalesce(F.transform("facets", lambda x: F.coalesce(x["files"], F.array().cast("array<struct<name:string,size:bigint,url:string>>"))), F.array().cast("array<array<struct<name:string,size:bigint,url:string>>>")))
    files = F.concat(F.coalesce("files", F.array().cast("array<struct<name:string,size:bigint,url:string>>")), facets)
    f = raw.select("id", F.posexplode(files).alias("pos", "f")).select("id", "pos", "f.*").where(F.col("url").isNotNull() & F.col("name").isNotNull())
    if suffixes:
        name = F.lower("name")
        wanted = F.lit(False)
        for s in suffixes:
            wanted = wanted | name.endswith(s.lower())
        f = f.where(wanted)
    if max_bytes is not None:
        f = f.where(F.coalesce("size", F.lit(0)) <= max_bytes)
    first = F.row_number().over(Window.partitionBy("id", "name").orderBy("pos"))
    return f.withColumn("_n", first).where("_n = 1").drop("_n", "pos")


def dataset_record(raw: DataFrame) -> DataFrame:
    """One registry row an item: key, title, its last DOI, and its period."""
    doi = F.try_element_at(F.filter("identifiers", lambda x: F.lower(x["type"]) == "doi"), F.lit(-1))["key"]
    dated = lambda kind: F.try_element_at(F.filter("dates", lambda d: F.lower(d["type"]) == kind), F.lit(1))["dateString"]
    return raw.select(F.concat(F.lit("item:"), "id").alias("key"), "title", doi.alias("doi"), dated("start").alias("period_start"), dated("end").alias("period_end"))


def image_only_children(raw: DataFrame, tabular: Sequence[str] = (".csv", ".txt", ".xlsx")) -> DataFrame:
    """Registry rows of items without data rows, with the number of tabular files that should be looked at."""
    found = manifest(raw, tabular).groupBy("id").agg(F.count("*").alias("n_tabular"))
    return dataset_record(raw).join(found.withColumn("key", F.concat(F.lit("item:"), "id")).drop("id"), "key", "left").fillna(0, ["n_tabular"])


# --- HTML tables


def table_rows(df: DataFrame, html: str, marker: str) -> DataFrame:
    """Rows after the header of each table whose header has the marker: table, row, cells."""
    t = df.select(F.posexplode(table_cells(html)).alias("table_no", "rows")).where(F.array_join(F.try_element_at("rows", F.lit(1)), " ").contains(marker))
    return t.select("table_no", F.posexplode("rows").alias("row_no", "cells")).where("row_no > 0")


def _last_table(rows: DataFrame, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc("table_no"), F.desc("row_no"))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def episode_table(df: DataFrame, html: str, marker: str) -> DataFrame:
    """Episodes of a page's tables: at least 7 cells and a number first; of equal numbers the last. The repose is up to the next start."""
    cell = lambda i: F.nullif(F.trim(F.try_element_at("cells", F.lit(i))), F.lit(""))
    r = table_rows(df, html, marker).where((F.size("cells") >= 7) & F.coalesce(cell(1), F.lit("")).rlike(r"^\d+$"))
    r = _last_table(r.withColumn("episode_no", cell(1).cast("int")), "episode_no")
    start = local_clock(cell(2))
    r = r.withColumn("_s", start)
    r = r.withColumn("_p", local_clock(cell(3), F.year(local_date(F.col("_s.utc")))))
    notes = cell(8)
    before = F.regexp_extract(notes, r"(?is)\bbegan on\b(.*)", 1)  # of what follows, local_clock takes the first date
    r = r.withColumn("_b", local_clock(before, F.year(local_date(F.col("_s.utc")))))
    out = r.select(
        "episode_no", F.col("_s.utc").alias("start"), F.col("_s.exact").alias("start_exact"), F.col("_p.utc").alias("pause"), F.col("_p.exact").alias("pause_exact"),
        duration_hours(cell(4)).alias("duration_hours"), F.round(hours_between("_p.utc", "_s.utc"), 3).alias("duration_hours_calc"), duration_hours(cell(5)).alias("repose_hours"),
        first_number(cell(6)).alias("height_m"), first_number(cell(7)).alias("volume"), F.when(F.col("_p.utc").isNull(), 1).otherwise(0).alias("is_ongoing"),
        F.col("_b.utc").alias("precursor"), F.round(hours_between("_s.utc", "_b.utc"), 3).alias("precursor_lead_hours"), notes.alias("notes"),
    )
    nxt = F.lead("start").over(Window.orderBy("episode_no"))  # a page's table: tens of rows
    return out.withColumn("repose_hours_calc", F.round(hours_between(nxt, "pause"), 3))


def hazard_table(df: DataFrame, html: str, marker: str) -> DataFrame:
    """Rows of six cells and more of the other kind of table: date, height (also in metres), wind, plume height and impacts; their key is the first number of "12-13"."""
    r = table_rows(df, html, marker)
    number = F.nullif(F.regexp_extract(F.try_element_at("cells", F.lit(1)), r"^\s*(\d+)\s*(?:-|$)", 1), F.lit("")).cast("int")
    cell = lambda i: F.nullif(F.try_element_at("cells", F.lit(i)), F.lit(""))
    kept = r.withColumn("episode_no", number).where(F.col("episode_no").isNotNull() & (F.size("cells") >= 6))
    return kept.select(
        "episode_no", cell(2).alias("date_text"), cell(3).alias("fountain_height_text"), height_m(cell(3)).alias("fountain_height_m"),
        cell(4).alias("wind_conditions"), cell(5).alias("plume_height_text"), cell(6).alias("impacts"),
    )


# --- notices


def notices(raw: DataFrame, titles: DataFrame | None = None, id_pattern: str = r"DOI-USGS-[A-Z]+-[0-9T:+\-]+", prefix: str = "notice-") -> DataFrame:
    """Notices as text with their levels, summary and identifier: the stated one, one in the text, or one of the time."""
    n = raw.select(F.explode("noticeData").alias("n")).select("n.*").withColumn("body", strip_tags("noticeHtml"))
    sent = F.try_to_timestamp(F.replace(F.replace("sentUtc", F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss"))
    ident = F.coalesce(F.nullif("noticeIdentifier", F.lit("")), group("body", f"({id_pattern})"), F.concat(F.lit(prefix), F.replace("sentUtc", F.lit(" "), F.lit("T")), F.lit("Z")))
    upper = lambda p: F.upper(group("body", p))
    out = n.select(
        ident.alias("notice_id"), sent.alias("sent"), F.col("noticeTypeCd").alias("type_code"),
        upper(r"(?i)current\s+(?:volcano\s+)?alert\s+level:\s*(\w+)").alias("alert_level"), upper(r"(?i)current\s+aviation\s+colou?r\s+code:\s*(\w+)").alias("color_code"),
        upper(r"(?i)previous\s+(?:volcano\s+)?alert\s+level:\s*(\w+)").alias("prev_alert_level"), upper(r"(?i)previous\s+aviation\s+colou?r\s+code:\s*(\w+)").alias("prev_color_code"),
        group("body", r"(?s)(?m)^\s*Summary:\s*(.+?)(?:\n\s*\n|\z)").alias("summary"), "body", F.coalesce("permLink", "noticeUrl").alias("url"),
    ).where(F.col("notice_id").isNotNull())
    if titles is not None:  # a lookup of tens of codes
        out = out.join(F.broadcast(titles.select(F.col("code").alias("type_code"), F.col("title").alias("type_title"))), "type_code", "left")
    return out


#: The keys of a telex notice; fixed values.
TELEX = {
    "notice_number": r"NOTICE\s*NR:\s*(.+)",
    "dtg": r"DTG:\s*(\S+)",
    "colour_code": r"CURRENT\s*COLOU?R\s*CODE:\s*(\S+)",
    "previous_colour": r"PREVIOUS\s*COLOU?R\s*CODE:\s*(\S+)",
    "activity_status": r"ACT\s*STS:\s*(.+)",
    "onset": r"ONSET:\s*(\S+)",
    "duration_text": r"DUR:\s*(.+)",
    "ash_cloud_height": r"VA\s*CLD\s*HGT:\s*(.+)",
    "cloud_movement": r"MOV:\s*(.+)",
}


def telex(df: DataFrame, body: str, keep: Sequence[str], type_code: str | None = None, wanted: str = "VV", marker: str = "VONA") -> DataFrame:
    """KEY: VALUE lines as columns, with the instants that they state and the episode in the remarks.

    Remarks go on up to the next line that begins with a key, a blank line, or the end. With type_code, the
    column of notice types, only notices of the wanted type that have the marker are read.
    """
    if type_code is not None:
        df = df.where((F.col(type_code) == wanted) & F.contains(F.col(body), F.lit(marker)))
    fields = {n: squeezed(group(body, f"(?i){p}")) for n, p in TELEX.items()}
    remarks = squeezed(group(body, r"(?s)RMK:\s*(.+?)(?:\n\s*\n|\n\s*[A-Z][A-Z .]*:|\z)"))
    ep = group(F.coalesce(remarks, F.col(body)), r"(?i)EPISODE\s+(\d{1,3})").cast("int")
    d = df.select(*keep, *[c.alias(n) for n, c in fields.items()], remarks.alias("remarks"), ep.alias("episode_no"))
    return d.withColumn("issued", compact_utc("dtg")).withColumn("onset", compact_utc("onset"))


def page_status(df: DataFrame, html: str, keep: Sequence[str], names: Sequence[str], begin: str = "Park Notices", end: str = "Plan Your Visit|Last updated") -> DataFrame:
    """A page's notices (12 lines of 12 characters at most), the named places it has, once each by letters, and its date."""
    t = strip_tags(html)
    block = F.coalesce(F.nullif(F.regexp_extract(t, rf"(?is){begin}(.{{0,2000}}?)(?:{end})", 1), F.lit("")), t)
    lines = F.slice(F.transform(F.filter(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) >= 12), lambda x: F.struct(F.substring(x, 1, 600).alias("text"))), 1, 12)
    found = F.array(*[F.when(t.contains(n), F.struct(F.regexp_replace(F.lower(F.lit(n)), "[^a-z]", "").alias("k"), F.lit(n).alias("name"))) for n in names])
    known = F.filter(found, lambda x: x.isNotNull())
    once = F.filter(known, lambda x, i: ~F.exists(F.slice(known, F.lit(1), i), lambda y: y["k"] == x["k"]))
    return df.select(*keep, lines.alias("notices"), F.transform(once, lambda x: x["name"]).alias("viewpoints"), group(t, r"Last updated:\s*([A-Z][a-z]+ \d{1,2},? \d{4})").alias("last_updated"))


# --- series

#: Header names, without white space and in lower case, and the columns that they mean; fixed values.
SAMPLE_HEADERS = {
    "utcdatetime": "time", "datetime": "time", "date_time": "time", "time": "time", "xtilt(microrad)": "x", "ytilt(microrad)": "y",
    "easttilt(microrad)": "east", "northtilt(microrad)": "north", "holetemp(celsius)": "hole_temp", "boxtemp(celsius)": "box_temp", "voltage(v)": "voltage",
}
SAMPLE_TIMES = ["yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]


def number(c) -> Column:
    """A double; what isn't one, and NaN, is null."""
    return F.nanvl(F.expr(f"try_cast(`{c}` as double)"), F.lit(None).cast("double")) if isinstance(c, str) else F.nanvl(c, F.lit(None).cast("double"))


def by_headers(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """The columns whose names, without white space, case and byte-order mark, are known, renamed; the first of equal names."""
    picked: dict[str, str] = {}
    for c in df.columns:
        name = headers.get(re.sub(r"\s+", "", c).lower().lstrip("﻿"))
        if name and name not in picked:
            picked[name] = c
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in picked.items()])


def samples(df: DataFrame, station: str, segment: str) -> DataFrame:
    """One file layout's samples: time in one of three formats, channels as numbers. A layout without a time column gives no rows."""
    renamed = by_headers(df, SAMPLE_HEADERS)
    if "time" not in renamed.columns:
        return df.sparkSession.createDataFrame([], "station string, time timestamp, segment string")
    channels = [number(c).alias(c) for c in renamed.columns if c != "time"]
    return renamed.select(F.lit(station).alias("station"), first_timestamp("time", SAMPLE_TIMES).alias("time"), *channels, F.lit(segment).alias("segment")).where(F.col("time").isNotNull())


def zipped_samples(files: DataFrame, station: str, skip: str = r"(?i)1sec") -> DataFrame:
    """Samples of the CSV files within zip files (path, content, as binaryFile gives them); a file's stem is its segment, names that `skip` fits are left out.

    Members are read as streams, a batch of rows at a time; each has one of the header layouts.
    """
    names = ["x", "y", "east", "north", "hole_temp", "box_temp", "voltage"]

    def run(parts):
        import csv
        import io
        import zipfile

        for batch in parts:
            for content in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    for name in z.namelist():
                        if not name.lower().endswith(".csv") or re.search(skip, name):
                            continue
                        with z.open(name) as member:
                            reader = csv.reader(io.TextIOWrapper(member, "utf-8-sig", errors="replace"))
                            known = [SAMPLE_HEADERS.get(re.sub(r"\s+", "", h).lower().lstrip("\ufeff")) for h in next(reader, [])]
                            if "time" not in known:
                                continue
                            rows = []
                            for row in reader:
                                rows.append(dict(zip(reversed(known), reversed(row[: len(known)] + [""] * (len(known) - len(row))))))
                                if len(rows) == 50_000:
                                    yield shown(rows, name)
                                    rows = []
                            if rows:
                                yield shown(rows, name)

    def shown(rows: list[dict], name: str):
        import pyarrow as pa

        stem = name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], pa.string()) for n in ("time", *names)] + [pa.array([stem] * len(rows), pa.string())], names=["time", *names, "segment"])

    raw = files.select("content").mapInArrow(run, ", ".join(f"{n} string" for n in ("time", *names, "segment")))
    return raw.select(F.lit(station).alias("station"), first_timestamp("time", SAMPLE_TIMES).alias("time"), *[number(n).alias(n) for n in names], "segment").where(F.col("time").isNotNull())


def labelled_values(df: DataFrame, text: str, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """"Label: value" lines of whole texts as columns."""
    return df.select(*keep, *[group(text, rf"(?im)^\s*{label}\s*:\s*(.+?)\s*$").alias(label.lower().replace(" ", "_")) for label in labels])


#: Name patterns, in order, and the site, method and aggregation of the files that have them; fixed values.
FILE_RULES = (
    (r"summit.*flyspec.*dailyaverage", "summit", "FLYSPEC array", "daily_mean"),
    (r"summit.*flyspec.*10s", "summit", "FLYSPEC array", "individual"),
    (r"summit.*srt.*rdtraverse", "summit", "road traverse (SRT)", "individual"),
    (r"summit.*dfw.*rdtraverse", "summit", "road traverse (DFW)", "individual"),
    (r"erz.*rdtraverse", "ERZ", "road traverse", "individual"),
    (r"kil_summit.*indiv", "summit", "DOAS traverse", "individual"),
    (r"kil_summit.*means", "summit", "DOAS traverse", "traverse_mean"),
    (r"kil_lerz.*indiv", "LERZ", "DOAS traverse", "individual"),
    (r"kil_lerz.*means", "LERZ", "DOAS traverse", "traverse_mean"),
    (r"kil_merz.*indiv", "MERZ", "DOAS traverse", "individual"),
    (r"kil_merz.*means", "MERZ", "DOAS traverse", "traverse_mean"),
    (r"kil_swrz.*indiv", "SWRZ", "DOAS traverse", "individual"),
    (r"kil_swrz.*means", "SWRZ", "DOAS traverse", "traverse_mean"),
)


def file_class(name, rules=FILE_RULES) -> Column:
    """struct(site, method, aggregation) of the first rule that a file name fits, else null."""
    low, out = F.lower(F.col(name) if isinstance(name, str) else name), None
    for pattern, *meta in rules:
        value = F.struct(*[F.lit(v).alias(n) for n, v in zip(("site", "method", "aggregation"), meta)])
        out = F.when(low.rlike(pattern), value) if out is None else out.when(low.rlike(pattern), value)
    return out


GAS_TIMES = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def emissions(df: DataFrame, file_name: str) -> DataFrame:
    """One layout's emission rates: the time column by pattern, in UTC if any column's name says so, else local; the first rate column.

    Files of no known class, rows without a time or rate, and pages that were saved as CSV are left out.
    """
    columns = [c for c in df.columns if c != file_name]
    find = lambda *patterns: next((c for p in patterns for c in columns if re.search(p, c, re.I)), None)
    time, rate = find(r"date.*time|time.*date", r"date", r"time"), find(r"so2.*(?:t/?d|tpd|tonnes|rate)", r"emission", r"rate", r"so2")
    empty = "site string, method string, aggregation string, time timestamp, day date, rate double, source_file string"
    if time is None or rate is None or any("<" in c for c in columns):
        return df.sparkSession.createDataFrame([], empty)
    parsed = first_timestamp(F.col(f"`{time}`").cast("string"), GAS_TIMES)
    at = parsed if any("utc" in c.lower() for c in columns) else to_utc(parsed)
    kind = file_class(file_name)
    value = first_number(F.when(~F.lower(F.trim(F.col(f"`{rate}`").cast("string"))).isin("", "na", "nan", "n/a", "-9999"), F.col(f"`{rate}`").cast("string")))
    rows = df.select(kind.alias("_k"), at.alias("time"), value.alias("rate"), F.col(file_name).alias("source_file")).where(F.col("_k").isNotNull() & F.col("time").isNotNull() & F.col("rate").isNotNull())
    return rows.select("_k.*", "time", local_date("time").alias("day"), "rate", "source_file")


def plume_heights(df: DataFrame, time: str, above_rim: str | None, camera: str | None, above_vent: str | None, formats: Sequence[str] = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss"), keep: Sequence[str] = ()) -> DataFrame:
    """Heights of two layouts: the rim height unless it is 0 or missing, else the camera's, or the height above the vent; others go."""
    at = to_utc(first_timestamp(F.col(f"`{time}`"), list(formats)))
    n = lambda c: F.nullif(first_number(F.col(f"`{c}`").cast("string")), F.lit(0.0)) if c else F.lit(None).cast("double")
    if above_vent:
        height, ref = first_number(F.col(f"`{above_vent}`").cast("string")), F.lit("above vent")
    else:
        height = F.coalesce(n(above_rim), n(camera))
        ref = F.when(n(above_rim).isNotNull(), "above rim").otherwise("camera frame")
    return df.select(*keep, at.alias("time"), height.alias("height_m"), ref.alias("height_ref")).where(F.col("time").isNotNull() & F.col("height_m").isNotNull())


def gravity_hourly(df: DataFrame, station: str, time: str, value: str, year: int, formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss")) -> tuple[DataFrame, DataFrame]:
    """Raw samples to hourly statistics, and how many samples fell outside the file's year by more than a day."""
    at = F.coalesce(*[F.try_to_timestamp(F.substring(F.col(time), 1, 19), F.lit(f)) for f in formats])
    rows = df.select(at.alias("time"), number(value).alias("v")).where(F.col("time").isNotNull() & F.col("v").isNotNull())
    day = "INTERVAL 1 DAY"
    inside = (F.col("time") >= F.expr(f"TIMESTAMP '{year}-01-01' - {day}")) & (F.col("time") < F.expr(f"TIMESTAMP '{year + 1}-01-01' + {day}"))
    stats = rows.where(inside).groupBy(F.date_trunc("hour", "time").alias("hour")).agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), F.count("*").alias("n"))
    return stats.select(F.lit(station).alias("station"), "*"), rows.agg(F.coalesce(F.sum(F.when(~inside, 1).otherwise(0)), F.lit(0)).alias("n_outside"))


def positions(lines: DataFrame, text: str, station: str, solution: str, frame: str) -> DataFrame:
    """Fixed-width position files: lines of 23 tokens of the station; absolute positions where reference and offset are known."""
    t = lines.select(F.split(F.trim(F.col(text)), r"\s+").alias("t")).where((F.size("t") >= 23) & (F.upper(F.col("t")[0]) == station.upper()))
    n = lambda i: F.expr(f"try_cast(try_element_at(t, {i + 1}) as double)")
    day = two_digit_date(F.col("t")[1])
    cols = {f"{d}_{k}_m": n(i + o) for i, d in ((7, "east"), (9, "north"), (11, "up")) for o, k in ((0, "ref"), (1, "off"))}
    out = t.select(
        F.upper(F.col("t")[0]).alias("station"), day.alias("day"), F.lit(solution).alias("solution"), F.lit(frame).alias("frame"), n(2).alias("decimal_year"), F.expr("try_cast(try_element_at(t, 4) as int)").alias("mjd"),
        *[c.alias(k) for k, c in cols.items()], n(14).alias("sig_east_m"), n(15).alias("sig_north_m"), n(16).alias("sig_up_m"), n(20).alias("latitude"), n(21).alias("longitude"), n(22).alias("height_m"),
    ).where(F.col("day").isNotNull())
    return out.withColumns({f"{d}_abs_m": F.col(f"{d}_ref_m") + F.col(f"{d}_off_m") for d in ("east", "north", "up")})


def daily_millimetres(p: DataFrame, frame: str) -> DataFrame:
    """Absolute positions of one frame in millimetres."""
    known = p.where((F.col("frame") == frame) & F.col("up_abs_m").isNotNull())
    return known.select("station", "day", "solution", *[F.round(F.col(f"{d}_abs_m") * 1000, 2).alias(f"{d}_mm") for d in ("up", "east", "north")], F.round(F.col("sig_up_m") * 1000, 2).alias("sig_up_mm"))
