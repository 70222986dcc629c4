import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers, texts, times


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'double'}" for n, v in values.items()) or "x int")
    return row.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "year", "utc", "exact"),
    [
        ("December 23, 2024 - 2:20 a.m.", None, "2024-12-23 12:20", 1),
        ("December 23, 2024 - 4 p.m.", None, "2024-12-24 02:00", 1),
        ("May 6, 2025 - 12:00 p.m.", None, "2025-05-06 22:00", 1),
        ("May 6, 2025 - 12:30 a.m.", None, "2025-05-06 10:30", 1),
        ("July 9 - 1:20 p.m.", 2025, "2025-07-09 23:20", 1),
        ("December 23, 2024", None, "2024-12-23 10:00", 0),
        ("TBD", None, None, 0),
        ("", None, None, 0),
        ("February 30, 2025 - 1 p.m.", None, None, 0),
    ],
)
def test_local_clock(spark, text, year, utc, exact):
    r = one(spark, times.local_clock("t", F.lit(year) if year else None), t=text)
    assert (r["utc"].strftime("%Y-%m-%d %H:%M") if r["utc"] else None, r["exact"]) == (utc, exact)


@pytest.mark.parametrize(("text", "hours"), [("14 hours", 14), ("8.5 days", 204), ("35.5 hours", 35.5), ("30 minutes", 0.5), ("TBD", None)])
def test_duration(spark, text, hours):
    assert one(spark, times.duration_hours("t"), t=text) == hours


def test_numbers(spark):
    assert one(spark, numbers.first_number("t"), t="400 (may update)") == 400.0
    assert one(spark, numbers.first_number("t"), t="") is None
    assert one(spark, numbers.height_m("t"), t="1070 feet/325 meters") == 325.0
    assert one(spark, numbers.height_m("t"), t="330 feet") == 100.6
    assert one(spark, numbers.number_or_word("t"), t="three") == 3
    assert one(spark, numbers.number_or_word("t"), t="17") == 17
    assert one(spark, numbers.nearest_rank(F.array(*map(F.lit, [5.0, 1.0, 3.0, 2.0])), 0.5)) == 3.0  # index 1.5 rounds to 2
    assert one(spark, numbers.haversine_km(F.lit(0.0), F.lit(1.0), 0, 0)) == pytest.approx(111.195, abs=1e-3)
    assert one(spark, numbers.signed(F.lit(11.0), F.lit("deflation_episode"))) == -11.0
    assert one(spark, numbers.signed(F.lit(250.0), F.lit("x"))) is None


def test_dates(spark):
    assert one(spark, times.two_digit_date("t"), t="26JUL04") == dt.date(2026, 7, 4)
    assert one(spark, times.two_digit_date("t"), t="99MAY30") == dt.date(1999, 5, 30)
    assert one(spark, times.compact_utc("t"), t="20260813/1126Z") == dt.datetime(2026, 8, 13, 11, 26)
    for parts, want in [((2018, 5, 3), (dt.date(2018, 5, 3), "day")), ((2018, 5, 0), (None, "month")), ((1790, 0, 0), (None, "year")), ((-50, 3, 2), (None, "day")), ((2018, 2, 30), (None, "day"))]:
        r = one(spark, times.partial_date(*[F.lit(p) for p in parts]))
        assert (r["date"], r["precision"]) == want


def test_sentences(spark):
    text = "It rose 12.1 units at 4 a.m. today. The U.S. office saw it\nduring episode 53. Next one\n\nLast"
    assert one(spark, texts.sentences("t"), t=text) == ["It rose 12.1 units at 4 a.m. today", "The U.S. office saw it during episode 53", "Next one", "Last"]
    assert one(spark, texts.sentences("t"), t=None) == []


def test_sections(spark):
    text = "Head\nSummary: all is well.\nMore.\n  Overview:\nLong text\n"
    assert one(spark, texts.sections("t", ["Overview", "Summary", "Hazards"]), t=text) == {"Summary": "all is well.\nMore.", "Overview": "Long text"}
    assert one(spark, texts.sections("t", ["Summary"]), t=None) == {}


def test_markup(spark):
    page = "<table><tr><th>No</th><th>A &amp; B</th></tr><tr><td>1</td><td> x<br>y </td></tr></table><table></table>"
    assert one(spark, texts.table_cells("t"), t=page) == [[["No", "A & B"], ["1", "x y"]], []]
    assert one(spark, texts.strip_tags("t"), t="<p>a&nbsp;b</p><script>x<y</script><div>c</div>") == "a b\nc"


def test_json_numbers(spark):
    from tidemark.functions.numbers import json_number
    from tidemark.operators.report import json_of

    shown = {0.0003: "0.0003", -0.00000125: "-0.00000125", 3e-7: "3e-7", 1e7: "10000000.0", 123456789.125: "123456789.125", 1e20: "1" + "0" * 20 + ".0", 1.5e300: "1.5e300", 34.0: "34.0", 0.001: "0.001", 0.0: "0.0"}
    df = spark.createDataFrame([(v,) for v in [*shown, None]], "v double")
    assert {r[0]: r[1] for r in df.select("v", json_number("v")).collect()} == shown | {None: None}
    nested = spark.createDataFrame([(("a\"E", None, (2.0e-4, dt.datetime(2026, 1, 1, 1)), None),)], "d struct<s:string,n:int,i:struct<x:double,t:timestamp>,j:struct<x:double>>")
    assert nested.select(json_of(F.col("d"), nested.schema["d"].dataType)).first()[0] == '{"s":"a\\"E","n":null,"i":{"x":0.0002,"t":"2026-01-01T01:00:00.000Z"},"j":null}'


def test_costly_parts_are_worked_out_once(spark):
    from tidemark.operators.mining import names_all

    df = spark.createDataFrame([("May 6, 2025 - 12:30 a.m.",)], "t string")
    plan = df.select(times.local_clock("t").alias("c")).select("c.utc", "c.exact")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") < 30
    plan = df.select(names_all(F.col("t"), "outage").alias("named"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
