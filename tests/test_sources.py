import datetime as dt
import json

from tidemark.sources import landed


def test_event_feed_and_catalogue(spark, tmp_path):
    feed = {"features": [{"id": "a", "properties": {"time": 1000, "mag": 2.5}, "geometry": {"coordinates": [-155.28, 19.4, 1.5]}}, {"id": "b", "properties": {"time": None}, "geometry": {"coordinates": [0, 0]}}]}
    (tmp_path / "f.json").write_text(json.dumps(feed, indent=1))
    e = landed.event_feed(landed.read_json(spark, str(tmp_path / "f.json"), landed.FEED), 19.4, -155.28).collect()
    assert [(r["event_id"], r["depth_km"], r["distance_km"]) for r in e] == [("a", 1.5, 0.0)]
    cat = {"features": [{"properties": {"Eruption_Number": 7, "StartDateYear": 2018, "StartDateMonth": 5, "StartDateDay": 3, "EndDateYear": 2018, "EndDateMonth": 5, "EndDateDay": 13}}, {"properties": {"Eruption_Number": 8, "StartDateYear": -200, "StartDateMonth": 0, "StartDateDay": 0}}]}
    (tmp_path / "c.json").write_text(json.dumps(cat))
    r = {x["eruption_number"]: x for x in landed.eruptions(landed.read_json(spark, str(tmp_path / "c.json"), landed.CATALOGUE)).collect()}
    assert (r[7]["duration_days"], r[7]["start_precision"], r[8]["start_precision"], r[8]["start_month"]) == (10, "day", "year", None)


def test_manifest_and_record(spark, tmp_path):
    item = {"id": "x1", "title": "T", "identifiers": [{"type": "DOI", "key": "d1"}, {"type": "doi", "key": "d2"}], "dates": [{"type": "Start", "dateString": "2010"}, {"type": "end", "dateString": "2018"}],
            "files": [{"name": "a.csv", "size": 5, "url": "u"}, {"name": "b.CSV", "size": 50, "url": "u"}, {"name": "c.jpg", "size": 5, "url": "u"}, {"name": "d.csv", "size": 5}], "facets": [{"files": [{"name": "a.csv", "size": 6, "url": "v"}, {"name": "e.csv", "size": 5, "url": "u"}]}]}
    (tmp_path / "i.json").write_text(json.dumps(item))
    raw = landed.read_json(spark, str(tmp_path / "i.json"), landed.ITEM)
    assert sorted((r["name"], r["size"]) for r in landed.manifest(raw, [".csv"], 10).collect()) == [("a.csv", 5), ("e.csv", 5)]
    r = landed.dataset_record(raw).first()
    assert (r["doi"], r["period_start"], r["period_end"]) == ("d2", "2010", "2018")
    assert landed.image_only_children(raw).first()["n_tabular"] == 3


def test_episode_table(spark):
    def row(*c):
        return "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"

    head = row("Episode", "Start", "Pause", "Duration", "Repose", "Height", "Volume", "Notes")
    page = f"<table>{head}{row(1, 'December 23, 2024 - 2:20 a.m.', 'December 23 - 4 p.m.', '14 hours', '8.5 days', '400 m', '14.1', 'Overflows began on December 23, 2024 - 1:20 a.m. today')}{row(2, 'January 1, 2025 - 4 a.m.', 'TBD', '', '', '', '', '')}{row('x', 1, 2, 3, 4, 5, 6)}</table><table>{row('other')}</table>"
    e = {r["episode_no"]: r for r in landed.episode_table(spark.createDataFrame([(page,)], "h string"), "h", "Episode").collect()}
    assert set(e) == {1, 2} and e[1]["pause"] == dt.datetime(2024, 12, 24, 2) and e[1]["precursor_lead_hours"] == 1.0
    assert e[1]["duration_hours_calc"] == 13.667 and e[1]["repose_hours_calc"] == 204.0 and (e[2]["is_ongoing"], e[1]["is_ongoing"]) == (1, 0)
    hazards = f"<table>{row('Episode', 'Date', 'Fountain', 'Wind', 'Plume', 'Hazards')}{row('12-13', 'June 1', '1,000 feet', 'light', '5 km', 'tephra on roads')}{row('14', 'June 2', '', '', '')}{row('x', 1, 2, 3, 4, 5)}</table>"
    hz = landed.hazard_table(spark.createDataFrame([(hazards,)], "h string"), "h", "Hazard").collect()
    assert [tuple(r) for r in hz] == [(12, "June 1", "1,000 feet", 304.8, "light", "5 km", "tephra on roads")]


def test_notices_and_telex(spark):
    html = "<p>Current Volcano Alert Level: watch</p><p>Current Aviation Color Code: orange</p><p>Summary: All is well.<br>More.</p><p></p><p>Rest</p>"
    raw = spark.createDataFrame([([("", html, "2026-08-13 11:26:00", "DU", None, "u")],)], landed.NOTICES)
    n = landed.notices(raw, spark.createDataFrame([("DU", "Daily")], "code string, title string")).first()
    assert (n["notice_id"], n["alert_level"], n["color_code"], n["type_title"], n["sent"]) == ("notice-2026-08-13T11:26:00Z", "WATCH", "ORANGE", "Daily", dt.datetime(2026, 8, 13, 11, 26))
    body = "VONA\nNOTICE NR: 2026/12\nDTG: 20260813/1126Z\nCURRENT COLOUR CODE: YELLOW\nPREVIOUS COLOUR CODE: ORANGE\nONSET: 20260813/1123Z\nMOV: SW\nRMK: EPISODE 53 ENDED."
    v = landed.telex(spark.createDataFrame([(body,)], "b string"), "b", []).first()
    more = body + "\nCONTACTS: office\nEPISODE 60"
    typed = spark.createDataFrame([(more, "VV"), (more, "DU"), ("KEY: 1", "VV")], "b string, code string")
    assert [(r["remarks"], r["episode_no"]) for r in landed.telex(typed, "b", [], "code").collect()] == [("EPISODE 53 ENDED.", 53)]
    assert (v["onset"], v["colour_code"], v["previous_colour"], v["cloud_movement"], v["episode_no"]) == (dt.datetime(2026, 8, 13, 11, 23), "YELLOW", "ORANGE", "SW", 53)


def test_page_status(spark):
    page = "<h2>Park Notices</h2><p>Closed road to the overlook</p><p>short</p><p>Stay on trails please</p><h2>Plan Your Visit</h2><p>Wald Ledge and Wald  Ledge, Ico'i</p>Last updated: July 4, 2026"
    p = landed.page_status(spark.createDataFrame([(page,)], "h string"), "h", [], ["Wald Ledge", "Wald-Ledge", "Ico'i", "None"]).first()
    assert [x["text"] for x in p["notices"]] == ["Closed road to the overlook", "Stay on trails please"]
    assert p["viewpoints"] == ["Wald Ledge", "Ico'i"] and p["last_updated"] == "July 4, 2026"


def test_series(spark):
    raw = spark.createDataFrame([("2018-05-01T00:00:00Z", "1.5", "NaN"), ("bad", "1", "2"), ("2018-05-01 00:01:00", "x", "2")], ["UTC Date Time", "East Tilt (microrad)", "North Tilt (microrad)"])
    s = landed.samples(raw, "UWD", "seg").orderBy("time").collect()
    assert [(r["east"], r["north"]) for r in s] == [(1.5, None), (None, 2.0)]
    f = spark.createDataFrame([("KIL_summit_SO2_2018-2022_means.csv",), ("ERZSO2_RdTraverse_2014-2017.csv",), ("random.csv",)], "n string").select(landed.file_class("n").alias("c")).collect()
    assert [tuple(r["c"]) if r["c"] else None for r in f] == [("summit", "DOAS traverse", "traverse_mean"), ("ERZ", "road traverse", "individual"), None]
    g = landed.emissions(spark.createDataFrame([("7/4/2018 12:30", "1,200", "kil_summit_indiv.csv"), ("7/4/2018 12:30", "NA", "kil_summit_indiv.csv")], ["Date Time (HST)", "SO2 rate (t/d)", "f"]), "f").collect()
    assert [(r["time"], r["rate"], r["day"]) for r in g] == [(dt.datetime(2018, 7, 4, 22, 30), 1200.0, dt.date(2018, 7, 4))]
    other = spark.createDataFrame([("7/4/2018 12:30", "1,200", "1", "kil_summit_indiv.csv")], ["Date Time", "SO2 rate (t/d)", "UTC offset", "f"])
    assert landed.emissions(other, "f").first()["time"] == dt.datetime(2018, 7, 4, 12, 30)  # any column may say that times are in UTC
    p = landed.plume_heights(spark.createDataFrame([("7/4/2018 12:30", "0", "900"), ("7/4/2018 12:31", "800", "1"), ("7/4/2018 12:32", "", "")], ["t", "rim", "cam"]), "t", "rim", "cam", None).orderBy("time").collect()
    assert [(r["height_m"], r["height_ref"]) for r in p] == [(900.0, "camera frame"), (800.0, "above rim")]
    hourly, outside = landed.gravity_hourly(spark.createDataFrame([("2012-01-01 00:00:00.5", 1.0), ("2012-01-01 00:30:00", 3.0), ("1999-01-01 00:00:00", 1.0)], "t string, v double"), "G", "t", "v", 2012)
    assert (hourly.first()["mean"], hourly.first()["n"], outside.first()["n_outside"]) == (2.0, 2, 1)


def test_positions(spark):
    line = "UWEV 26JUL04 2026.5 61225 2425 6 -155.3 100 0.5 2000 0.25 1257 0.629615 0 0.001 0.001 0.004 0 0 0 19.42 -155.29 1257.6"
    p = landed.positions(spark.createDataFrame([(line,), (line.replace("UWEV", "BYRL"),), ("site YYMMMDD",)], "l string"), "l", "uwev", "final", "PA").collect()
    assert len(p) == 1 and (p[0]["up_off_m"], p[0]["up_ref_m"], p[0]["up_abs_m"], p[0]["day"]) == (0.629615, 1257.0, 1257.629615, dt.date(2026, 7, 4))


def test_zips_and_labels(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "uwd.zip", "w") as z:
        z.writestr("a/UWD_2018.csv", "\ufeffUTC Date Time,East Tilt (microrad)\n2018-05-01 00:00:00,1.5\nbad,2\n2018-05-01T00:01:00Z,NaN\n2018-05-01T00:02:00Z\n")
        z.writestr("UWD_1sec.csv", "UTC Date Time,East Tilt (microrad)\n2018-05-01 00:00:00,9\n")
        z.writestr("readme.txt", "Station: UWD")
    s = landed.zipped_samples(spark.read.format("binaryFile").load(str(tmp_path)), "UWD").orderBy("time").collect()
    assert [(r["station"], r["segment"], r["east"], r["north"]) for r in s] == [("UWD", "UWD_2018", 1.5, None), ("UWD", "UWD_2018", None, None), ("UWD", "UWD_2018", None, None)]
    text = "Station Name: Uwekahuna\n  Elevation :  1250 m \nOther"
    r = landed.labelled_values(spark.createDataFrame([(text,)], "t string"), "t", ["Station Name", "Elevation", "Depth"], []).first()
    assert tuple(r) == ("Uwekahuna", "1250 m", None)


def test_daily_millimetres(spark):
    p = spark.createDataFrame([("A", "2020-01-01", "final", "NA12", 1.23456, 0.5, 0.25, 0.001), ("A", "2020-01-02", "final", "IGS", 1.0, 1.0, 1.0, 1.0), ("A", "2020-01-03", "final", "NA12", None, 1.0, 1.0, 1.0)], "station string, day string, solution string, frame string, up_abs_m double, east_abs_m double, north_abs_m double, sig_up_m double")
    assert [tuple(r) for r in landed.daily_millimetres(p, "NA12").collect()] == [("A", "2020-01-01", "final", 1234.56, 500.0, 250.0, 1.0)]
