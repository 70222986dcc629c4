"""A data-integrity report from a list of rules: one row a rule, (check, status, n, detail).

Rules over one table share one scan of it. A rule gives the number of rows that break it; it passes at
0 and else has the status of its severity: FAIL, WARN, or INFO for what is only counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.intervals import gaps, steps
from tidemark.operators.latest import missing_successors, orphans, overlaps
from tidemark.operators.rollup import duplicates


@dataclass(frozen=True)
class Rule:
    """`broken` is an aggregate over the rule's table, or a table of broken rows made by `rows`."""

    check: str
    table: str
    severity: str = "FAIL"
    broken: Column | None = None
    detail: Column | None = None
    rows: object = None  # a function of the tables to a DataFrame of broken rows


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; a null condition isn't."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))


def not_empty(check: str, table: str, time: str | None = None, severity: str = "FAIL") -> Rule:
    detail = F.concat_ws(" to ", F.min(time).cast("string"), F.max(time).cast("string")) if time else F.lit("")
    return Rule(check, table, severity, F.when(F.count("*") == 0, 1).otherwise(0), F.concat_ws(" rows ", F.count("*").cast("string"), detail))


def row_rule(check: str, table: str, broken: Column, severity: str = "FAIL") -> Rule:
    """No row may have the condition."""
    return Rule(check, table, severity, count_where(broken), F.concat(F.count("*").cast("string"), F.lit(" rows")))


def in_range(check: str, table: str, value: str, low=None, high=None, severity: str = "FAIL") -> Rule:
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(value) < low)
    if high is not None:
        broken = broken | (F.col(value) > high)
    return row_rule(check, table, F.coalesce(broken, F.lit(False)), severity)


def populated(check: str, table: str, value: str, severity: str = "WARN", when: Column | None = None) -> Rule:
    """A column is known, in the rows that `when` names."""
    return row_rule(check, table, F.col(value).isNull() & (F.lit(True) if when is None else when), severity)


def coverage_share(check: str, table: str, value: str, least: float, severity: str = "WARN") -> Rule:
    """A column is known in at least a share of the rows."""
    share = F.count(value) / F.count("*")
    return Rule(check, table, severity, F.when(share >= least, 0).otherwise(1), F.concat(F.round(100 * share, 1).cast("string"), F.lit(" %")))


def tolerance(check: str, table: str, a: Column, b: Column, most: float, severity: str = "WARN") -> Rule:
    return row_rule(check, table, F.abs(a - b) > most, severity)


def fresh(check: str, table: str, time: str, now: Column, most_days: float, severity: str = "WARN") -> Rule:
    age = (F.unix_micros(now) - F.unix_micros(F.max(F.col(time).cast("timestamp")))) / 86_400_000_000.0
    return Rule(check, table, severity, F.when(age <= most_days, 0).otherwise(1), F.concat(F.coalesce(F.round(age, 1).cast("string"), F.lit("no")), F.lit(" days")))


def counted(check: str, table: str, condition: Column) -> Rule:
    return row_rule(check, table, condition, "INFO")


def unique(check: str, table: str, key: Sequence[str], severity: str = "FAIL") -> Rule:
    return Rule(check, table, severity, rows=lambda t: duplicates(t[table], key))


def contiguous(check: str, table: str, number: str, by: Sequence[str] = (), severity: str = "FAIL") -> Rule:
    return Rule(check, table, severity, rows=lambda t: missing_successors(t[table], number, by))


def no_overlap(check: str, table: str, number: str, start: str, end: str, by: Sequence[str] = (), severity: str = "FAIL") -> Rule:
    return Rule(check, table, severity, rows=lambda t: overlaps(t[table], number, start, end, by))


def no_orphans(check: str, table: str, key: str, parent: str, parent_key: str, severity: str = "FAIL") -> Rule:
    return Rule(check, table, severity, rows=lambda t: orphans(t[table], t[parent], key, parent_key))


def no_gap(check: str, table: str, day: str, most_days: int, by: Sequence[str] = (), severity: str = "WARN") -> Rule:
    return Rule(check, table, severity, rows=lambda t: gaps(t[table], day, most_days, 5, by))


def no_step(check: str, table: str, order: Sequence[str], value: str, by: Sequence[str], most: float, severity: str = "FAIL") -> Rule:
    return Rule(check, table, severity, rows=lambda t: steps(t[table], order, value, by, most, 5))


def same_keys(check: str, table: str, key: Sequence[str], rollup: str, severity: str = "FAIL") -> Rule:
    """The rollup has one row for each distinct key of the table."""

    def rows(t):
        a, b = t[table].select(*key).distinct(), t[rollup].select(*key)
        return a.join(b, list(key), "left_anti").unionByName(b.join(a, list(key), "left_anti"))

    return Rule(check, table, severity, rows=rows)


def within(check: str, table: str, other: str, on: Sequence[str], a: str, b: str, most_minutes: float, severity: str = "WARN") -> Rule:
    """Two tables' times for one key lie within so many minutes."""

    def rows(t):
        joined = t[table].select(*on, F.col(a).alias("_a")).join(t[other].select(*on, F.col(b).alias("_b")), list(on))
        return joined.where(F.abs(F.unix_micros("_a") - F.unix_micros("_b")) > most_minutes * 60_000_000)

    return Rule(check, table, severity, rows=rows)


def last_succeeded(check: str, table: str, source: str = "source", started: str = "started", status: str = "status", severity: str = "FAIL") -> Rule:
    return Rule(check, table, severity, rows=lambda t: t[table].groupBy(source).agg(F.max_by(status, started).alias("_s")).where("_s <> 'ok'"))


def report(tables: Mapping[str, DataFrame], rules: Sequence[Rule], required: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The report of all rules. Of a table that lacks a required column, only that is said; of an absent table, a warning."""
    parts: list[DataFrame] = []
    spark = next(iter(tables.values())).sparkSession
    heads: list[tuple] = []
    broken_tables = set()
    for name, columns in (required or {}).items():
        if name not in tables:
            heads.append((f"{name} has its columns", "WARN", 1, "no table"))
        elif lost := [c for c in columns if c not in tables[name].columns]:
            heads.append((f"{name} has its columns", "FAIL", len(lost), ", ".join(lost)))
            broken_tables.add(name)
        else:
            heads.append((f"{name} has its columns", "PASS", 0, ""))
    usable = [r for r in rules if r.table in tables and r.table not in broken_tables]
    for name in dict.fromkeys(r.table for r in usable):
        shared = [r for r in usable if r.table == name and r.broken is not None]
        if shared:
            cells = [F.struct(F.lit(r.check).alias("check"), F.lit(r.severity).alias("severity"), r.broken.cast("long").alias("n"), (r.detail if r.detail is not None else F.lit("")).alias("detail")) for r in shared]
            parts.append(tables[name].agg(F.array(*cells).alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*"))
    for r in usable:
        if r.rows is not None:
            parts.append(r.rows(tables).agg(F.lit(r.check).alias("check"), F.lit(r.severity).alias("severity"), F.count("*").alias("n"), F.lit("").alias("detail")))
    out = None
    if parts:
        out = reduce(DataFrame.unionByName, parts)
        status = F.when(F.col("severity") == "INFO", "INFO").when(F.col("n") == 0, "PASS").otherwise(F.col("severity"))
        out = out.select("check", status.alias("status"), "n", "detail")
    if heads:
        first = spark.createDataFrame(heads, "check string, status string, n long, detail string")
        out = first if out is None else first.unionByName(out)
    return out


def tally(found: DataFrame) -> DataFrame:
    return found.groupBy("status").agg(F.count("*").alias("n"))
