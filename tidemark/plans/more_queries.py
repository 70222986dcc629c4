"""Registered queries over keyed writes, integrity, text, reports and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.texts import ENTITIES, SHORT_FORMS, element_texts, sections, sentences, strip_tags
from tidemark.operators import checks, intervals, keyed, latest, mining, models, report, rollup
from tidemark.plans import standins as S
from tidemark.plans.queries import _FIT, USER, query, r9, us
from tidemark.session import read_table, spread
from tidemark.streaming import jobs

_KEY = ["l_orderkey", "l_linenumber"]
_SEQ = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_ORDER = ", ".join(f"{c} DESC" for c in _SEQ)
_SHOWN = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_LAST = f"SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS rn FROM lineitem WHERE"


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = read_table(spark, sf_dir, "lineitem")
    return keyed.last_of_batch(t.where("l_quantity < 25"), _KEY, _SEQ), t.where("l_quantity >= 25")


@query(f"""WITH a AS ({_LAST} l_quantity < 25 QUALIFY rn = 1), b AS ({_LAST} l_quantity >= 25 QUALIFY rn = 1)
    SELECT {_SHOWN} FROM b UNION ALL SELECT {_SHOWN} FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)""", standins=False)
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _batches(spark, sf_dir)
    return keyed.upsert(target, batch, _KEY, _SEQ).select(*_SHOWN.split(", "))


@query(f"""WITH a AS ({_LAST} l_quantity < 25 QUALIFY rn = 1),
    b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_SEQ)}) AS rn FROM lineitem WHERE l_quantity >= 25 QUALIFY rn = 1)
    SELECT {_SHOWN} FROM a UNION ALL SELECT {_SHOWN} FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)""", standins=False)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _batches(spark, sf_dir)
    return keyed.insert_absent(target, batch, _KEY, _SEQ).select(*_SHOWN.split(", "))


@query(f"""SELECT {_SHOWN}, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, {_ORDER}) AS rn FROM lineitem) WHERE rn = 1""", standins=False)
def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return keyed.by_precedence(read_table(spark, sf_dir, "lineitem"), _KEY, rank, _SEQ).select(*_SHOWN.split(", "), "l_returnflag")


@query("SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value * 2 ELSE value END AS value FROM ev")
def replace_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, since = S.events(spark, sf_dir), dt.datetime(2024, 1, 20, tzinfo=dt.UTC)
    batch = ev.where(F.col("ts") >= F.lit(since)).withColumn("value", F.col("value") * 2)
    return keyed.replace_window(ev, batch, "ts", since).select("event_id", "value")


@query(r"SELECT doc_id, source FROM documents WHERE NOT coalesce(source LIKE 'src\_%' ESCAPE '\' OR source LIKE 'src1_', false)", standins=False)
def purge_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return keyed.purge(docs, F.col("source").like(r"src\_%") | F.col("source").like("src1_"))


@query("SELECT event_id, user_id, value FROM ev WHERE ts >= (SELECT max(ts) FROM ev) - INTERVAL 7 DAY")
def incremental_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    start = keyed.incremental_start(ev, "ts", dt.timedelta(days=7))
    return ev.where(F.col("ts") >= F.lit(start)).select("event_id", "user_id", "value")


_TABLES = {"region": None, "nation": None, "customer": None, "supplier": None, "part": None, "orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts", "documents": None, "labels": None, "pages": None, "conversations": None}


@query("""SELECT 'events' AS tbl, count(*) AS n_before, count(*) FILTER (NOT coalesce(event_type = 'error', false)) AS n_after, count(*) - count(*) FILTER (event_type = 'error') AS n_expected, count(*) FILTER (NOT coalesce(event_type = 'error', false)) = count(*) - count(*) FILTER (event_type = 'error') AS ok FROM events
    UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (NOT coalesce(l_quantity > 40, false)), count(*) - count(*) FILTER (l_quantity > 40), count(*) FILTER (NOT coalesce(l_quantity > 40, false)) = count(*) - count(*) FILTER (l_quantity > 40) FROM lineitem
    UNION ALL SELECT 'orders', count(*), count(*), count(*), true FROM orders""", standins=False)
def derive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: read_table(spark, sf_dir, n) for n in ("events", "lineitem", "orders")}
    return keyed.derive(tables, {"events": F.col("event_type") == "error", "lineitem": F.col("l_quantity") > 40})[1]


def _counted(name: str, time: str | None) -> str:
    span = [f"strftime({f}({time}), '%Y-%m-%d')" if time else "NULL" for f in ("min", "max")]
    return f"SELECT '{name}' AS tbl, count(*) AS n, {span[0]} AS t0, {span[1]} AS t1 FROM {name}"


@query(" UNION ALL ".join(_counted(n, c) for n, c in _TABLES.items()), standins=False)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.coverage({n: (read_table(spark, sf_dir, n), c) for n, c in _TABLES.items()})
    return out.select("tbl", "n", F.substring("t0", 1, 10).alias("t0"), F.substring("t1", 1, 10).alias("t1"))


def _checked(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ev = S.events(spark, sf_dir)
    hourly = rollup.hourly_rollup(S.samples(ev), ["station"], "ts", ["east"], "segment").withColumnRenamed("hour", "hour")
    samples = S.samples(ev).withColumn("hour", F.date_trunc("hour", "ts"))
    return {"episode": S.episodes(ev), "event": ev, "sample": samples, "hourly": hourly, "orders": S.orders(spark, sf_dir), "customer": read_table(spark, sf_dir, "customer"), "lineitem": read_table(spark, sf_dir, "lineitem")}


def _rules() -> list[checks.Rule]:
    return [
        checks.not_empty("episodes present", "episode", "start"),
        checks.contiguous("episode numbers contiguous", "episode", "episode_no", USER),
        checks.row_rule("pause after start", "episode", F.col("pause") <= F.col("start")),
        checks.no_overlap("episodes apart", "episode", "episode_no", "start", "pause", USER),
        checks.populated("repose known", "episode", "repose_hours", when=F.col("is_ongoing") == 0),
        checks.counted("ongoing episodes", "episode", F.col("is_ongoing") == 1),
        checks.in_range("values in range", "event", "value", 0, 490),
        checks.unique("events unique", "event", ["event_id"]),
        checks.coverage_share("k known", "event", "k", 0.9),
        checks.same_keys("rollup has the hours of the samples", "sample", ["station", "hour"], "hourly"),
        checks.counted("relevelled hours", "hourly", F.col("n_segments") > 1),
        checks.no_orphans("orders have customers", "orders", "o_custkey", "customer", "c_custkey"),
        checks.unique("lines unique", "lineitem", _KEY, "WARN"),
        checks.no_step("no large step", "event", ["ts", "event_id"], "value", USER, 480.0),
    ]


@query("""SELECT * FROM (
    SELECT 'episodes present' AS "check", CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count(*) = 0 AS BIGINT) AS n FROM ep
    UNION ALL SELECT 'episode numbers contiguous', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM ep a WHERE
        episode_no < (SELECT max(episode_no) FROM ep m WHERE m.user_id = a.user_id) AND NOT EXISTS (SELECT 1 FROM ep b WHERE b.user_id = a.user_id AND b.episode_no = a.episode_no + 1)
    UNION ALL SELECT 'pause after start', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM ep WHERE pause <= start
    UNION ALL SELECT 'episodes apart', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM ep a JOIN ep b ON a.user_id = b.user_id AND b.episode_no = a.episode_no + 1 AND a.pause > b.start
    UNION ALL SELECT 'repose known', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END, count(*) FROM ep WHERE is_ongoing = 0 AND repose_hours IS NULL
    UNION ALL SELECT 'ongoing episodes', 'INFO', count(*) FROM ep WHERE is_ongoing = 1
    UNION ALL SELECT 'values in range', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM ev WHERE value < 0 OR value > 490
    UNION ALL SELECT 'events unique', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM (SELECT event_id FROM ev GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'k known', CASE WHEN count(k) >= 0.9 * count(*) THEN 'PASS' ELSE 'WARN' END, CAST(count(k) < 0.9 * count(*) AS BIGINT) FROM ev
    UNION ALL SELECT 'rollup has the hours of the samples', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n FROM (SELECT abs(
        (SELECT count(*) FROM (SELECT DISTINCT station, date_trunc('hour', ts) FROM smp)) - (SELECT count(*) FROM (SELECT station, hour FROM hourly GROUP BY station, hour))) AS n)
    UNION ALL SELECT 'relevelled hours', 'INFO', count(*) FROM (SELECT station, date_trunc('hour', ts) FROM smp GROUP BY ALL HAVING count(DISTINCT segment) > 1)
    UNION ALL SELECT 'orders have customers', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'lines unique', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END, count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'no large step', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, least(count(*), 5) FROM (
        SELECT abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS s FROM ev) WHERE s > 480)""")
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.report(_checked(spark, sf_dir), _rules()).select("check", "status", "n")


def _more_rules() -> list[checks.Rule]:
    now = F.lit(dt.datetime(2024, 2, 10, tzinfo=dt.UTC))
    return [
        checks.tolerance("volume near ten times k", "event", F.col("value"), F.col("k") * 10.0, 400.0),
        checks.fresh("events fresh", "event", "ts", now, 3.0),
        checks.fresh("events fresh enough", "event", "ts", now, 60.0),
        checks.no_gap("signups without long gaps", "signup", "day", 5, USER),
        checks.within("first view near first click", "view", "click", USER, "t", "t", 1440.0),
        checks.last_succeeded("last runs succeeded", "runs"),
        checks.populated("values known", "event", "value"),
        checks.in_range("k in range", "event", "k", 5, 90, "WARN"),
    ]


_MORE = """, later AS (SELECT user_id, CAST(ts AS DATE) AS day FROM ev WHERE event_type = 'signup' GROUP BY ALL),
    gap AS (SELECT date_diff('day', lag(day) OVER (PARTITION BY user_id ORDER BY day), day) AS g FROM later),
    firsts AS (SELECT user_id, min(ts) FILTER (event_type = 'view') AS v, min(ts) FILTER (event_type = 'click') AS c FROM ev GROUP BY 1),
    last AS (SELECT event_type, arg_max(CASE WHEN value > 250 THEN 'failed' ELSE 'ok' END, (ts, event_id)) AS s FROM ev GROUP BY 1),
    found AS (
        SELECT 'volume near ten times k' AS "check", count(*) FILTER (abs(value - k * 10.0) > 400) AS n, 'WARN' AS bad FROM ev
        UNION ALL SELECT 'events fresh', CAST(max(ts) < TIMESTAMP '2024-02-10' - INTERVAL 3 DAY AS BIGINT), 'WARN' FROM ev
        UNION ALL SELECT 'events fresh enough', CAST(max(ts) < TIMESTAMP '2024-02-10' - INTERVAL 60 DAY AS BIGINT), 'WARN' FROM ev
        UNION ALL SELECT 'signups without long gaps', least(count(*), 5), 'WARN' FROM gap WHERE g > 5
        UNION ALL SELECT 'first view near first click', count(*) FILTER (abs(epoch_us(v) - epoch_us(c)) > 86400000000), 'WARN' FROM firsts
        UNION ALL SELECT 'last runs succeeded', count(*) FILTER (s <> 'ok'), 'FAIL' FROM last
        UNION ALL SELECT 'values known', count(*) FILTER (value IS NULL), 'WARN' FROM ev
        UNION ALL SELECT 'k in range', count(*) FILTER (k < 5 OR k > 90), 'WARN' FROM ev),
    judged AS (SELECT "check", CASE WHEN n = 0 THEN 'PASS' ELSE bad END AS status, CAST(n AS BIGINT) AS n FROM found)
"""


def _more_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    first = lambda kind: ev.where(F.col("event_type") == kind).groupBy("user_id").agg(F.min("ts").alias("t"))
    runs = ev.select(F.col("event_type").alias("source"), F.struct("ts", "event_id").alias("started"), F.when(F.col("value") > 250, "failed").otherwise("ok").alias("status"))
    signups = ev.where("event_type = 'signup'").withColumn("day", F.to_date("ts"))
    return checks.report({"event": ev, "signup": signups, "view": first("view"), "click": first("click"), "runs": runs}, _more_rules())


@query(_MORE + "SELECT * FROM judged")
def integrity_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the other types: tolerances, freshness, gaps, two tables' times, last runs."""
    return _more_found(spark, sf_dir).select("check", "status", "n")


@query(_MORE + "SELECT status, count(*) AS n FROM judged GROUP BY status")
def integrity_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.tally(_more_found(spark, sf_dir))


@query("""SELECT o_custkey, after_number FROM (SELECT o_custkey, month AS after_number, max(month) OVER (PARTITION BY o_custkey) AS last, lead(month) OVER (PARTITION BY o_custkey ORDER BY month) AS nxt
    FROM (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INT) AS month FROM orders)) WHERE after_number < last AND nxt > after_number + 1""", standins=False)
def missing_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = S.orders(spark, sf_dir).withColumn("month", F.year("o_orderdate") * 12 + F.month("o_orderdate"))
    return latest.missing_successors(months, "month", ["o_custkey"])


@query("SELECT a.user_id, a.episode_no FROM ep a JOIN ep b ON a.user_id = b.user_id AND b.episode_no = a.episode_no + 1 AND a.pause > b.start")
def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.overlaps(S.episodes(S.events(spark, sf_dir)), "episode_no", "start", "pause", USER).select("user_id", "episode_no")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)", standins=False)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = read_table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return latest.orphans(read_table(spark, sf_dir, "orders"), rich, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1", standins=False)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.duplicates(read_table(spark, sf_dir, "lineitem"), _KEY)


@query("""SELECT 'latest' AS pick, event_id FROM (SELECT * FROM ev ORDER BY ts DESC, event_id DESC LIMIT 1)
    UNION ALL SELECT 'latest view', event_id FROM (SELECT * FROM ev WHERE event_type = 'view' ORDER BY ts DESC, event_id DESC LIMIT 1)
    UNION ALL SELECT 'top ' || user_id, event_id FROM (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3)
    UNION ALL SELECT 'preferred ' || user_id, event_id FROM (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, ts DESC, event_id DESC) = 1)""")
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, order = S.events(spark, sf_dir), ["ts", "event_id"]
    named = lambda df, name: df.select(name.alias("pick"), "event_id")
    one = named(latest.newest(ev, order), F.lit("latest")).unionByName(named(latest.newest(ev.where("event_type = 'view'"), order), F.lit("latest view")))
    top = named(latest.newest_each(ev, USER, order, 3), F.concat(F.lit("top "), "user_id"))
    best = named(latest.preferred(ev, USER, F.when(F.col("event_type") == "purchase", 0).otherwise(1), order), F.concat(F.lit("preferred "), "user_id"))
    return one.unionByName(top).unionByName(best)


_LEAVES = """, leaves AS (SELECT leaf, count(*) AS n FROM (
        SELECT CAST(floor((epoch_us(ts) - t0) * CAST(4096 AS DOUBLE) / (t1 - t0 + 1)) AS BIGINT) AS leaf FROM ev, (SELECT min(epoch_us(ts)) AS t0, max(epoch_us(ts)) AS t1 FROM ev)) GROUP BY leaf),
    cells AS (SELECT level, leaf // CAST(pow(2, 12 - level) AS BIGINT) AS cell, sum(n) AS n FROM leaves, (SELECT CAST(unnest(range(0, 13)) AS INT) AS level) GROUP BY ALL)
    SELECT c.level, c.cell, CAST(c.n AS BIGINT) AS n, c.n >= 300 AS "full" FROM cells c LEFT JOIN cells p ON p.level = c.level - 1 AND p.cell = c.cell // 2
    WHERE (c.n < 300 OR c.level = 12) AND (p.n IS NULL OR p.n >= 300)"""


@query(_LEAVES)
def balanced_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.balanced_windows(S.events(spark, sf_dir), "ts", 300).select("level", "cell", "n", "full")


@query(""", p AS (SELECT *, 19.4 + (k - 50) / 1000 AS lat, -155.28 + (value - 250) / 2500 AS lon FROM ev),
    d AS (SELECT *, round(2 * 6371.0088 * asin(sqrt(least(1.0::DOUBLE, pow(sin((radians(lat) - radians(19.4)) / 2), 2) + cos(radians(lat)) * cos(radians(19.4)) * pow(sin((radians(lon) - radians(-155.28)) / 2), 2)))), 3) AS km FROM p)
    SELECT user_id, count(*) FILTER (recent AND km <= 2) AS n_2km, count(*) FILTER (recent AND km <= 5) AS n_5km, count(*) FILTER (recent AND km <= 10) AS n_10km
    FROM (SELECT *, ts > TIMESTAMP '2024-01-16' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '2024-01-16' AS recent FROM d) GROUP BY user_id""")
def radius_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.events(spark, sf_dir).withColumn("lat", 19.4 + (F.col("k") - 50) / 1000).withColumn("lon", -155.28 + (F.col("value") - 250) / 2500)
    return rollup.radius_counts(p, "ts", "lat", "lon", 19.4, -155.28, F.lit(dt.datetime(2024, 1, 16, tzinfo=dt.UTC)), 24, (2, 5, 10), USER)


_ABBREVIATED = "text"
for _form in SHORT_FORMS:
    _ABBREVIATED = f"replace({_ABBREVIATED}, '{_form}', '{_form.replace('.', chr(1))}')"


@query(rf"""SELECT doc_id, CAST(len(s) AS INT) AS n, sha256(array_to_string(s, chr(10))) AS sentences_sha256 FROM (
    SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(regexp_replace(t, '\n{{2,}}', chr(2), 'g'), chr(10), ' '), '\.\s+|' || chr(2)),
        lambda p: replace(trim(regexp_replace(p, '\s+', ' ', 'g')), chr(1), '.')), lambda p: p <> '') AS s
    FROM (SELECT doc_id, {_ABBREVIATED} AS t FROM documents))""", standins=False)
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", sentences("text").alias("s"))
    return docs.select("doc_id", F.size("s").alias("n"), F.sha2(F.array_join("s", "\n"), 256).alias("sentences_sha256"))


@query("""SELECT conv_id, turn, trim(role) AS summary, trim(CAST(length(text) AS VARCHAR)) AS overview, 2 AS n FROM conversations""", standins=False)
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    text = F.concat(F.lit("Head\nSummary: "), "role", F.lit("\n\n  Overview:\n"), F.length("text").cast("string"), F.lit("\n"))
    s = c.select("conv_id", "turn", sections(text, ["Overview", "Summary", "Hazards"]).alias("s"))
    return s.select("conv_id", "turn", F.col("s")["Summary"].alias("summary"), F.col("s")["Overview"].alias("overview"), F.size("s").alias("n"))


@query(r"""SELECT page_id, CAST(len(x) AS INT) AS n, array_to_string(x, '|') AS cells FROM (SELECT page_id, list_transform(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1),
    lambda c: trim(regexp_replace(regexp_replace(c, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS x FROM pages)""", standins=False)
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", element_texts("html", "li").alias("x"))
    return p.select("page_id", F.size("x").alias("n"), F.array_join("x", "|").alias("cells"))


_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?i)<br\s*/?>|</(?:p|div|li|tr|h[1-6])\s*>', chr(10), 'g'), '(?s)<[^>]+>', ' ', 'g')"
for _name, _char in ENTITIES:
    _PLAIN = f"replace({_PLAIN}, '{_name}', '{_char.replace(chr(39), chr(39) * 2)}')"


@query(rf"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_PLAIN}, '[ \t\x{{A0}}\r]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'),
    '^\s+|\s+$', '', 'g') AS text FROM pages""", standins=False)
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", strip_tags("html").alias("text"))


@query()
def number_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return mining.number_readings(docs, "text", ["doc_id"], units=["*"], kinds={"first": ["the"], "second": ["of"]}, frames={"near": ["and"]}, most=1e6).drop("sentence")


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 3 AS VARCHAR) AS window_start_date, CAST(CAST(o_orderdate AS DATE) + 6 AS VARCHAR) AS window_end_date, CAST(o_custkey % 100 AS INT) AS stated_episode FROM orders""", standins=False)
def date_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.told_orders(spark, sf_dir).withColumn("issued", F.timestamp_micros(F.unix_micros("o_orderdate") + 43_200_000_000))
    said = lambda d: F.date_format(F.date_add("o_orderdate", d), "MMMM d")
    text = F.concat(F.lit("Onset of episode "), (F.col("o_custkey") % 100).cast("string"), F.lit(" is likely between "), said(3), F.lit(" and "), said(6), F.lit("."))
    out = mining.date_windows(o.withColumn("text", text), "text", "issued", ["o_orderkey"])
    return out.select("o_orderkey", F.col("window_start_date").cast("string").alias("window_start_date"), F.col("window_end_date").cast("string").alias("window_end_date"), "stated_episode")


_NOW = "TIMESTAMP '2024-01-20'"


_SNAP = f""", begun AS (SELECT * FROM ep WHERE start <= {_NOW} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY episode_no DESC) = 1),
    day AS (SELECT user_id, count(*) AS n, max(magnitude) AS mx FROM qk WHERE time <= {_NOW} AND time > {_NOW} - INTERVAL 24 HOUR GROUP BY 1),
    f AS (SELECT * FROM fc WHERE issued <= {_NOW} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY issued DESC, event_id DESC) = 1),
    l AS (SELECT * FROM ev WHERE ts <= {_NOW} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""
_JOINED = "FROM begun b LEFT JOIN day USING (user_id) LEFT JOIN f USING (user_id) LEFT JOIN l USING (user_id)"


@query(_SNAP + f"""
    SELECT b.user_id, b.episode_no, CASE WHEN b.pause <= {_NOW} THEN 'paused' ELSE 'active' END AS state, coalesce(day.n, 0) AS n_24h, day.mx AS max_24h, l.event_type AS level,
        epoch_us(CASE WHEN f.issued >= {_NOW} - INTERVAL 7 DAY THEN f.window_start END) AS window_start_us,
        CASE WHEN f.issued IS NULL THEN 'no forecast' WHEN f.issued < {_NOW} - INTERVAL 7 DAY THEN 'stale forecast' END AS forecast_unavailable
    {_JOINED}""")
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _snapshot(spark, sf_dir)
    return s.select("user_id", "episode_no", "state", "n_24h", "max_24h", "level", us("window_start"), "forecast_unavailable")


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    now = F.lit(dt.datetime(2024, 1, 20, tzinfo=dt.UTC))
    levels = ev.select("user_id", "event_id", F.col("ts").alias("time"), F.col("event_type").alias("level"))
    return report.snapshot(S.episodes(ev), S.quakes(ev), S.forecasts(ev), levels, USER, now)


def _stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(epoch_us({c}) // 1000 % 1000 AS VARCHAR), 3, '0') || 'Z'"


@query(_SNAP + f"""
    SELECT user_id, CAST(json_object(
        'episode', json_object('episode_no', episode_no, 'state', state, 'hours_since_pause', CASE WHEN state = 'paused' THEN round((epoch_us({_NOW}) - epoch_us(pause)) / 3600000000.0, 2) END),
        'events', json_object('n_24h', n_24h, 'max_24h', max_24h), 'level', json_object('value', level, 'unavailable', CASE WHEN level IS NULL THEN 'no level' END),
        'forecast', json_object('window_start', {_stamp("ws")}, 'window_end', {_stamp("we")}, 'unavailable', why)) AS VARCHAR) AS json
    FROM (SELECT b.user_id, b.episode_no, b.pause, CASE WHEN b.pause <= {_NOW} THEN 'paused' ELSE 'active' END AS state, coalesce(day.n, 0) AS n_24h, day.mx AS max_24h, l.event_type AS level,
        CASE WHEN f.issued >= {_NOW} - INTERVAL 7 DAY THEN f.window_start END AS ws, CASE WHEN f.issued >= {_NOW} - INTERVAL 7 DAY THEN f.window_end END AS we,
        CASE WHEN f.issued IS NULL THEN 'no forecast' WHEN f.issued < {_NOW} - INTERVAL 7 DAY THEN 'stale forecast' END AS why {_JOINED})""")
def snapshot_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.as_json(_snapshot(spark, sf_dir), USER)


@query(_FIT + """, last14 AS (SELECT user_id, count(*) AS n, regr_slope(y, x) AS s, avg(x) AS mx, avg(y) AS my
        FROM (SELECT * FROM xy QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY episode_no DESC) <= 14) GROUP BY user_id),
    model AS (SELECT user_id, round_even(s, 4) AS slope, round_even(my - s * mx, 3) AS intercept FROM last14 WHERE n >= 5 AND NOT isnan(s)),
    med AS (SELECT user_id, median(repose_hours) AS med FROM (SELECT * FROM ep WHERE repose_hours IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY episode_no DESC) <= 10) GROUP BY user_id),
    state AS (SELECT user_id, pause, volume AS x, volume / 2 AS cumulative, k / 10 AS change FROM ep QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY episode_no DESC) = 1),
    points AS (SELECT user_id, epoch_us(pause) + CAST(round((slope * x + intercept - coalesce(bias_days, 0)) * 86400000000) AS BIGINT) AS model_us,
            epoch_us(pause) + CAST(round(med / 24 * 86400000000) AS BIGINT) AS repose_us, coalesce(greatest(mae_days, 1.5), 2.5) AS half,
            CASE WHEN change > 0 AND x > cumulative THEN epoch_us(TIMESTAMP '2024-01-31') + CAST(round((x - cumulative) / change * 86400000000) AS BIGINT) END AS early_us
        FROM state LEFT JOIN model USING (user_id) LEFT JOIN bts USING (user_id) LEFT JOIN med USING (user_id)),
    p AS (SELECT *, coalesce(model_us, repose_us) AS point FROM points)
    SELECT user_id, CASE WHEN model_us IS NOT NULL THEN 'regression' WHEN repose_us IS NOT NULL THEN 'repose median' END AS method,
        CAST(CAST(make_timestamp(point - 36000000000) AS DATE) AS VARCHAR) AS point_date,
        CAST(CAST(make_timestamp(point - CAST(round(half * 86400000000) AS BIGINT) - 36000000000) AS DATE) AS VARCHAR) AS window_start,
        CAST(CAST(make_timestamp(point + CAST(round(half * 86400000000) AS BIGINT) - 36000000000) AS DATE) AS VARCHAR) AS window_end,
        CASE WHEN point IS NOT NULL THEN round_even(half, 2) END AS half_width_days,
        CAST(CAST(make_timestamp(early_us - 36000000000) AS DATE) AS VARCHAR) AS early_risk_date,
        CASE WHEN point IS NULL THEN 'no history' END AS unavailable
    FROM p""")
def own_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    eps = S.episodes(ev)
    xy = eps.where(F.col("repose_hours").isNotNull()).select("user_id", "episode_no", F.col("volume").alias("x"), (F.col("repose_hours") / 24).alias("y"))
    fitted = models.rolling_fit(xy, USER, ["episode_no"], "x", "y")
    back = models.backtest_summary(models.backtest_rows(fitted, USER, ["episode_no"], "episode_no", "x", "y", 6), USER)
    last10 = latest.newest_each(eps.where(F.col("repose_hours").isNotNull()), USER, ["episode_no"], 10).groupBy("user_id").agg(F.percentile("repose_hours", F.lit(0.5)).alias("repose_median_hours"))
    state = latest.newest_each(eps, USER, ["episode_no"]).select("user_id", "pause", F.col("volume").alias("x"), (F.col("volume") / 2).alias("cumulative"), (F.col("k") / 10).alias("change_24h"))
    out = models.own_forecast(state, models.latest_model(xy, USER, ["episode_no"], "x", "y"), back, last10, USER, F.lit(dt.datetime(2024, 1, 31, tzinfo=dt.UTC)))
    return out.withColumns({c: F.col(c).cast("string") for c, kind in out.dtypes if kind == "date"})


@query("""SELECT station, epoch_us(date_trunc('hour', ts)) AS hour_us, round(avg(east), 9) AS mean, min(east) AS min, max(east) AS max, count(*) AS n, count(DISTINCT segment) AS n_segments FROM smp GROUP BY station, date_trunc('hour', ts)""")
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf_dir}/events.parquet"
    stream = jobs.landed(spark, path, spark.read.parquet(path).schema)
    stream = stream.select(F.col("event_type").alias("station"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("east"), (F.col("user_id") % 7).alias("segment"))
    rows = jobs.run_available(jobs.hourly_stream(stream, ["station"], "ts", "east", "segment"), "update", jobs.new_folder(spark, "hourly"))
    return jobs.merged(rows, ["station", "hour"]).select("station", us("hour"), *r9("mean"), "min", "max", "n", "n_segments")
