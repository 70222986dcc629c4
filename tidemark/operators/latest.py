"""Newest, first and preferred rows of groups; missing successors, overlaps and orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_with_ties(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """All rows at each group's newest time; groups with a null key are left out."""
    known = df.dropna(subset=list(by))
    return known.withColumn("_rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc(time)))).where("_rank = 1").drop("_rank")


def newest(df: DataFrame, order: Sequence[str], k: int = 1) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(k)


def newest_each(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int = 1) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def first_where(value, condition: Column, order) -> Column:
    """An aggregate: the value of the group's first row for which the condition holds and the value is known."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(F.when(condition, v), F.when(condition & v.isNotNull(), order))


def last_where(value, condition: Column, order) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.max_by(F.when(condition, v), F.when(condition & v.isNotNull(), order))


def messages_per_group(df: DataFrame, by: Sequence[str], order: Column, remark: str, value: str, others: dict[str, str], kinds: dict[str, tuple[str, bool]]) -> DataFrame:
    """One pass over a group's messages: for each kind the first or last value of remarks that contain a word
    (kinds: name -> (word, first)), the distinct values, the messages, and the last of other columns."""
    picks = []
    for name, (word, first) in kinds.items():
        said = F.coalesce(F.col(remark).ilike(f"%{word}%"), F.lit(False))
        picks.append((first_where if first else last_where)(value, said, order).alias(name))
    lasts = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(new) for c, new in others.items()]
    return df.dropna(subset=list(by)).groupBy(*by).agg(*picks, F.count_distinct(value).alias("distinct_values"), F.count("*").alias("messages"), *lasts)


def arg_max(df: DataFrame, by: Sequence[str], measure: str, carried: Sequence[str], tie: str) -> DataFrame:
    """The row of each group's greatest measure (the latest on ties): group, measure, carried columns."""
    best = F.max_by(F.struct(measure, *carried), F.struct(measure, tie)).alias("_best")
    return df.where(F.col(measure).isNotNull()).groupBy(*by).agg(best).select(*by, "_best.*")


def preferred(df: DataFrame, by: Sequence[str], ranks: Column, order: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(ranks, *[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def missing_successors(df: DataFrame, number: str, by: Sequence[str] = ()) -> DataFrame:
    """Numbers whose successor isn't there, but for the last of each group."""
    there = df.select(*by, number).distinct()
    last = there.groupBy(*by).agg(F.max(number).alias("_last"))
    wanted = there.withColumn("_next", F.col(number) + 1)
    found = there.select(*by, F.col(number).alias("_next"))
    gone = wanted.join(found, [*by, "_next"], "left_anti")
    joined = gone.join(last, list(by)) if by else gone.join(F.broadcast(last))  # one row
    return joined.where(F.col(number) < F.col("_last")).select(*by, F.col(number).alias("after_number"))


def overlaps(df: DataFrame, number: str, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows that end after their successor starts."""
    nxt = df.select(*by, (F.col(number) - 1).alias(number), F.col(start).alias("next_start"))
    return df.join(nxt, [*by, number]).where(F.col(end) > F.col("next_start")).select(*by, number, end, "next_start")


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
