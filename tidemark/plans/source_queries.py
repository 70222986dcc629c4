"""Registered queries over the landed sources: payloads as they would land are written from the given tables, then parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import compact_utc, duration_hours, local_clock, two_digit_date
from tidemark.operators import mining
from tidemark.plans import standins as S
from tidemark.plans.queries import query, r9, us
from tidemark.session import read_table
from tidemark.sources import landed


def _text(*parts) -> Column:
    """Strings and columns, one after the other."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, value / 100 AS magnitude,
    round(2 * 6371.0088 * asin(sqrt(least(1.0::DOUBLE, pow(sin((radians(19 + k / 100) - radians(19.4)) / 2), 2)
        + cos(radians(19 + k / 100)) * cos(radians(19.4)) * pow(sin((radians(-155 - value / 1000) - radians(-155.28)) / 2), 2)))), 3) AS km
    FROM ev WHERE event_type <> 'error' AND k IS NOT NULL""")
def source_event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.events(spark, sf_dir)
    there = F.when(F.col("event_type") != "error", F.unix_millis("ts"))
    feature = F.struct(
        F.col("event_id").cast("string").alias("id"), F.struct(there.alias("time"), (F.col("value") / 100).alias("mag")).alias("properties"),
        F.struct(F.array(-155 - F.col("value") / 1000, 19 + F.col("k") / 100, F.lit(3.0)).alias("coordinates")).alias("geometry"),
    )
    raw = e.select(F.from_json(F.to_json(F.struct(F.array(feature).alias("features"))), landed.FEED).alias("d")).select("d.*")
    return landed.event_feed(raw, 19.4, -155.28).select("event_id", "magnitude", F.col("distance_km").alias("km"))


@query("""WITH p AS (SELECT CAST(o_orderkey AS INT) AS n, CAST(year(o_orderdate) AS INT) AS y, nullif(o_custkey % 14, 0) AS m, nullif(o_orderkey % 32, 0) AS d FROM orders),
    q AS (SELECT *, CASE WHEN m IS NOT NULL AND d IS NOT NULL THEN try_cast(printf('%04d-%02d-%02d', y, CAST(m AS INT), CAST(d AS INT)) AS DATE) END AS b FROM p)
    SELECT n AS eruption_number, CAST(b AS VARCHAR) AS start_date, CASE WHEN m IS NULL THEN 'year' WHEN d IS NULL THEN 'month' ELSE 'day' END AS start_precision,
    CAST(date_diff('day', b, make_date(y + 1, 6, 15)) AS INT) AS duration_days FROM q""", standins=False)
def source_eruptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.orders(spark, sf_dir)
    p = F.struct(
        F.col("o_orderkey").cast("int").alias("Eruption_Number"), F.year("o_orderdate").alias("StartDateYear"), (F.col("o_custkey") % 14).cast("int").alias("StartDateMonth"),
        (F.col("o_orderkey") % 32).cast("int").alias("StartDateDay"), (F.year("o_orderdate") + 1).alias("EndDateYear"), F.lit(6).alias("EndDateMonth"), F.lit(15).alias("EndDateDay"),
    )
    raw = o.select(F.from_json(F.to_json(F.struct(F.array(F.struct(p.alias("properties"))).alias("features"))), landed.CATALOGUE).alias("d")).select("d.*")
    return landed.eruptions(raw).select("eruption_number", F.col("start_date").cast("string").alias("start_date"), "start_precision", "duration_days")


@query("""SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'notice-' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' ELSE CAST(o_orderkey AS VARCHAR) END AS notice_id, epoch_us(o_orderdate) AS sent_us,
    'LEVEL' || o_orderstatus AS alert_level, CASE WHEN o_custkey % 2 = 0 THEN 'ORANGE' END AS color_code, 'Order of ' || o_custkey || '.' || chr(10) || 'All is well.' AS summary,
    CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' END AS type_title FROM orders""", standins=False)
def source_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.orders(spark, sf_dir)
    colour = F.when(F.col("o_custkey") % 2 == 0, F.lit("<p>Current Aviation Color Code: orange</p>")).otherwise("")
    html = _text("<p>Current Volcano Alert Level: level", F.col("o_orderstatus"), "</p>", colour, "<p>Summary: Order of ", F.col("o_custkey"), ".<br>All is well.</p><p></p><p>Rest</p>")
    n = F.struct(
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderkey").cast("string")).alias("noticeIdentifier"), html.alias("noticeHtml"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("sentUtc"), F.col("o_orderstatus").alias("noticeTypeCd"),
    )
    raw = o.select(F.from_json(F.to_json(F.struct(F.array(n).alias("noticeData"))), landed.NOTICES).alias("d")).select("d.*")
    titles = spark.createDataFrame([("F", "Final"), ("O", "Open")], "code string, title string")
    return landed.notices(raw, titles).select("notice_id", us("sent"), "alert_level", "color_code", "summary", "type_title")


@query("""SELECT CAST(page_id AS VARCHAR) AS id, name, CAST(size AS BIGINT) AS size FROM (
    SELECT page_id, unnest(['a' || page_id % 5 || '.csv', 'b.TXT']) AS name, unnest([length(html), 7]) AS size FROM pages WHERE html IS NOT NULL) WHERE size <= 5000""", standins=False)
def source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").where("html is not null")
    file = lambda name, size, url="u": F.struct(name.alias("name"), size.cast("long").alias("size"), F.lit(url).alias("url"))
    first, second = _text("a", F.col("page_id") % 5, ".csv"), F.lit("b.TXT")
    item = F.struct(
        F.col("page_id").cast("string").alias("id"), F.array(file(first, F.length("html")), file(F.lit("c.jpg"), F.lit(1)), file(F.lit("d.csv"), F.lit(1), None)).alias("files"),
        F.array(F.struct(F.array(file(second, F.lit(7)), file(second, F.lit(8))).alias("files"))).alias("facets"),
    )
    raw = p.select(F.from_json(F.to_json(item), landed.ITEM).alias("d")).select("d.*")
    return landed.manifest(raw, (".csv", ".txt"), 5000).select("id", "name", "size")


@query("""SELECT 'item:' || c_custkey AS key, c_name AS title, '10/' || c_custkey AS doi, '2010' AS period_start, NULL::VARCHAR AS period_end, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS n_tabular FROM customer""", standins=False)
def source_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    doi = lambda v: F.struct(F.lit("doi").alias("type"), v.alias("key"))
    name = F.when(F.col("c_custkey") % 3 == 0, "x.csv").otherwise("x.jpg")
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"), F.array(doi(F.lit("old")), doi(_text("10/", F.col("c_custkey")))).alias("identifiers"),
        F.array(F.struct(F.lit("Start").alias("type"), F.lit("2010").alias("dateString"))).alias("dates"), F.array(F.struct(name.alias("name"), F.lit(1).alias("size"), F.lit("u").alias("url"))).alias("files"),
    )
    raw = c.select(F.from_json(F.to_json(item), landed.ITEM).alias("d")).select("d.*")
    return landed.image_only_children(raw).select("key", "title", "doi", "period_start", "period_end", "n_tabular")


@query("""SELECT CAST(o_orderkey AS INT) AS episode_no, CAST(o_custkey AS VARCHAR) AS date_text, round(CAST(o_custkey AS DOUBLE) * 0.3048, 1) AS fountain_height_m,
    o_orderstatus AS wind_conditions, NULL::VARCHAR AS plume_height_text, 'A & ' || o_orderpriority AS impacts FROM orders WHERE o_orderkey % 2 = 0""", standins=False)
def source_hazard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    cell = lambda *x: _text("<td>", *x, "</td>")
    tail = F.when(F.col("o_orderkey") % 2 == 0, cell("A &amp; ", F.col("o_orderpriority"))).otherwise("")  # others have five cells
    row = _text("<tr>", cell(F.col("o_orderkey"), "-", F.col("o_orderkey") + 1), cell(F.col("o_custkey")), cell(F.col("o_custkey"), " feet"), cell(" <b>", F.col("o_orderstatus"), "</b> "), cell(""), tail, "</tr>")
    page = _text("<table><tr><th>Episode</th><th>Hazards</th></tr>", row, "</table><table><tr><th>Other</th></tr>", row, "</table>")
    out = landed.hazard_table(o.select(page.alias("html")), "html", "Hazard")
    return out.select("episode_no", "date_text", "fountain_height_m", "wind_conditions", "plume_height_text", "impacts")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS notice_number, epoch_us(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 683 MINUTE) AS onset_us, 'RED' AS colour_code,
    'Fountain ' || o_custkey || ' EPISODE ' || o_orderkey % 100 || ' went on' AS remarks, CAST(o_orderkey % 100 AS INT) AS episode_no FROM orders WHERE o_orderstatus = 'O'""", standins=False)
def source_telex(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.orders(spark, sf_dir)
    day = F.date_format("o_orderdate", "yyyyMMdd")
    body = _text("VONA\nNOTICE NR: ", day, "\nCURRENT COLOUR CODE: RED\nONSET: ", day, "/1123Z\nRMK: Fountain ", F.col("o_custkey"), "\nEPISODE ", F.col("o_orderkey") % 100, " went on\nCONTACTS: office")
    typed = o.select("o_orderkey", body.alias("body"), F.when(F.col("o_orderstatus") == "O", "VV").otherwise("DU").alias("code"))
    return landed.telex(typed, "body", ["o_orderkey"], "code").select("o_orderkey", "notice_number", us("onset"), "colour_code", "remarks", "episode_no")


@query("""SELECT event_type AS segment, epoch_us(date_trunc('second', ts)) AS time_us, round(value, 6) AS east, CASE WHEN k % 5 > 0 THEN CAST(k AS DOUBLE) END AS north FROM ev WHERE k % 7 > 0""")
def source_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.events(spark, sf_dir)
    formats = [F.date_format("ts", f) for f in ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")]
    time = F.when(F.col("k") % 7 == 0, "bad").when(F.col("k") % 3 == 0, formats[0]).when(F.col("k") % 3 == 1, formats[1]).otherwise(formats[2])
    raw = e.select(time.alias("﻿UTC Date Time"), F.col("value").cast("string").alias("East Tilt (microrad)"), F.when(F.col("k") % 5 > 0, F.col("k").cast("string")).otherwise("NaN").alias(" north TILT (microrad)"), "event_type")
    kinds = [r[0] for r in e.select("event_type").distinct().orderBy("event_type").limit(20).collect()]  # a file layout each
    parts = [landed.samples(raw.where(F.col("event_type") == k).drop("event_type"), "S", k) for k in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("segment", us("time"), F.round("east", 6).alias("east"), "north")


@query("SELECT c_custkey, c_name AS station_name, c_mktsegment AS phone, NULL::VARCHAR AS depth FROM customer", standins=False)
def source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").withColumn("readme", _text("About\nStation Name: ", F.col("c_name"), "\n  PHONE :  ", F.col("c_mktsegment"), " \nEnd"))
    return landed.labelled_values(c, "readme", ["Station Name", "Phone", "Depth"], ["c_custkey"])


@query("""SELECT CASE WHEN user_id % 3 = 0 THEN 'ERZ' ELSE 'summit' END AS site, CASE WHEN user_id % 3 = 0 THEN 'individual' ELSE 'traverse_mean' END AS aggregation, epoch_us(date_trunc('minute', ts)) + 36000000000 AS time_us,
    CAST(CAST(date_trunc('minute', ts) AS DATE) AS VARCHAR) AS day, CAST(round(value) AS DOUBLE) AS rate FROM ev WHERE user_id % 3 < 2 AND k % 4 > 0""")
def source_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.events(spark, sf_dir)
    name = F.when(F.col("user_id") % 3 == 0, "ERZ_RdTraverse.csv").when(F.col("user_id") % 3 == 1, "Kil_Summit_2018_means.csv").otherwise("other.csv")
    time = F.when(F.col("k") % 2 == 0, F.date_format("ts", "M/d/yyyy H:mm")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:00"))
    raw = e.select(time.alias("Date Time"), F.when(F.col("k") % 4 == 0, "NA").otherwise(F.format_number(F.round("value"), 0)).alias("SO2 (t/d)"), name.alias("file"))
    out = landed.emissions(raw, "file")
    return out.select("site", "aggregation", us("time"), F.col("day").cast("string").alias("day"), "rate")


@query("""SELECT event_id, CASE WHEN k % 3 > 0 THEN k % 3 * 10.0 ELSE value END AS height_m, CASE WHEN k % 3 > 0 THEN 'above rim' ELSE 'camera frame' END AS height_ref FROM
    (SELECT event_id, CAST(k AS DOUBLE) AS k, value FROM ev WHERE k % 3 > 0 OR value <> 0)""")
def source_plume_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.events(spark, sf_dir)
    raw = e.select("event_id", F.date_format("ts", "M/d/yyyy H:mm:ss").alias("t"), ((F.col("k") % 3) * 10.0).alias("rim"), F.col("value").alias("camera"))
    out = landed.plume_heights(raw, "t", "rim", "camera", None, keep=["event_id"])
    return out.select("event_id", "height_m", "height_ref")


@query("""SELECT epoch_us(date_trunc('hour', ts)) AS hour_us, round(avg(value), 9) AS mean, round(CASE WHEN count(*) > 1 THEN stddev_samp(value) END, 9) AS std, min(value) AS min, max(value) AS max, count(*) AS n
    FROM ev WHERE k % 9 > 0 GROUP BY 1""")
def source_gravity_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.events(spark, sf_dir)
    time = F.when(F.col("k") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
    raw = e.select(time.alias("t"), F.when(F.col("k") % 9 > 0, F.col("value").cast("string")).otherwise("NaN").alias("g"))
    year = e.agg(F.year(F.max("ts")).alias("y")).first()["y"] or 2000
    return landed.gravity_hourly(raw, "S", "t", "g", year)[0].select(us("hour"), *r9("mean", "std"), "min", "max", "n")


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, round(CAST(o_custkey + 0.25 AS DOUBLE) * 1000, 2) AS up_mm, 2500.0::DOUBLE AS east_mm FROM orders WHERE o_orderstatus = 'O'""", standins=False)
def source_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.orders(spark, sf_dir)
    station = F.when(F.col("o_orderstatus") == "O", "UWEV").otherwise("XXXX")
    day = F.upper(F.date_format("o_orderdate", "yyMMMdd"))
    line = F.concat_ws("  ", station, day, F.lit("2020.5"), F.lit("59000"), *[F.lit("0")] * 3, F.lit("2"), F.lit("0.5"), F.lit("3"), F.lit("0.1"), F.col("o_custkey").cast("string"), F.lit("0.25"), *[F.lit("0.001")] * 4, *[F.lit("0")] * 3, F.lit("19.4"), F.lit("-155.3"), F.col("o_orderkey").cast("string"))
    p = landed.positions(o.select(line.alias("l")), "l", "uwev", "final", "NA12")
    mm = landed.daily_millimetres(p.withColumn("solution", F.col("height_m").cast("long").cast("string")), "NA12")
    return mm.select(F.col("solution").cast("long").alias("o_orderkey"), F.col("day").cast("string").alias("day"), "up_mm", "east_mm")


@query("""SELECT page_id, 1 AS n_notices, 'Closed way to number ' || page_id AS notice, CASE WHEN page_id % 2 = 0 THEN 'Wald Ledge' END AS viewpoints, 'July 4, 2026' AS last_updated FROM pages""", standins=False)
def source_page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages")
    place = F.when(F.col("page_id") % 2 == 0, "Wald Ledge, Wald-Ledge").otherwise("none")
    html = _text("<script>x</script><h2>Park Notices</h2><p>Closed way to number ", F.col("page_id"), "</p><p>short</p><h2>Plan Your Visit</h2><p>", place, "</p><p>Last updated: July 4, 2026</p>")
    out = landed.page_status(p.select("page_id", html.alias("h")), "h", ["page_id"], ["Wald Ledge", "Wald-Ledge", "Other"])
    return out.select("page_id", F.size("notices").alias("n_notices"), F.col("notices")[0]["text"].alias("notice"), F.nullif(F.array_join("viewpoints", "|"), F.lit("")).alias("viewpoints"), "last_updated")


@query("""SELECT o_orderkey, epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + (o_custkey % 24) * INTERVAL 1 HOUR + 40 * INTERVAL 1 MINUTE + INTERVAL 10 HOUR) AS utc_us, 1 AS exact,
    round((o_custkey % 50) / CASE WHEN o_custkey % 2 = 0 THEN 60 ELSE 1 END, 9) AS hours, epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 686 MINUTE) AS dtg_us,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""", standins=False)
def stated_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.told_orders(spark, sf_dir)
    hour = F.col("o_custkey") % 24
    twelve = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    clock = local_clock(_text(F.date_format("o_orderdate", "MMMM d, yyyy"), " - ", twelve, ":40 ", F.when(hour < 12, "a.m.").otherwise("p.m.")))
    hours = duration_hours(_text(F.col("o_custkey") % 50, F.when(F.col("o_custkey") % 2 == 0, " minutes").otherwise(" hours")))
    out = o.select("o_orderkey", clock.alias("c"), F.round(hours, 9).alias("hours"), compact_utc(_text(F.date_format("o_orderdate", "yyyyMMdd"), "/1126Z")).alias("dtg"), two_digit_date(F.upper(F.date_format("o_orderdate", "yyMMMdd"))).cast("string").alias("day"))
    return out.select("o_orderkey", F.unix_micros("c.utc").alias("utc_us"), F.col("c.exact").alias("exact"), "hours", us("dtg"), "day")


@query("""SELECT o_orderkey, CAST(o_custkey % 40 AS INT) AS quakes, CAST(1000 + o_custkey AS DOUBLE) AS gas, CAST(o_custkey % 9 AS DOUBLE) AS wind_low, CAST(o_custkey % 9 + 5 AS DOUBLE) AS wind_high, o_custkey % 2 = 0 AS quiet FROM orders""", standins=False)
def daily_report_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.told_orders(spark, sf_dir)
    c = F.col("o_custkey")
    body = _text(
        "Summary: The eruption is paused. More.\n\nSummit: There were ", c % 40, " earthquakes in the past 24 hours. The SO2 emission rate was ", F.format_number(1000 + c, 0), " tonnes per day. Winds are from the east at ",
        c % 9, " to ", c % 9 + 5, " mph.\nRift: Rates ", F.when(c % 2 == 0, "remain low").otherwise("rise"), ".\nResources: None.",
    )
    f = mining.facts(o.select("o_orderkey", body.alias("body")), "body", ["Summary", "Summit", "Rift", "Resources"], ["o_orderkey"], "Summit", "Resources", "Rift", "Summary")
    return f.select("o_orderkey", F.col("quakes_24h.value").alias("quakes"), F.col("gas_measured.value").alias("gas"), F.col("wind.low").alias("wind_low"), F.col("wind.high").alias("wind_high"), F.col("second_quiet.value").alias("quiet"))


@query("""SELECT o_orderkey, epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 14 HOUR) AS precursor_us, 6.0::DOUBLE AS lead_hours FROM orders""", standins=False)
def stated_precursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.told_orders(spark, sf_dir)
    body = _text("Order of ", F.col("o_custkey"), ". Overflows began on ", F.date_format("o_orderdate", "MMMM d, yyyy"), " - 4 a.m. today.")
    told = o.select("o_orderkey", body.alias("body"), F.timestamp_micros(F.unix_micros(F.date_trunc("day", "o_orderdate")) + 72_000_000_000).alias("start"))
    return mining.precursors(told, "body", "start", ["o_orderkey"]).select("o_orderkey", us("precursor"), "lead_hours")
