"""Walk-forward baselines, rolling regression with bias correction, and the scoring of forecast windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from heapq import heappop, heappush, heappushpop
from itertools import repeat

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.functions.numbers import hit, rank_at
from tidemark.functions.times import days_between, hours_between, local_date
from tidemark.operators.latest import latest_with_ties
from tidemark.operators.ranks import nth_values


def baseline_pairs(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, k: int = 5) -> DataFrame:
    """name, prediction, actual of each value after the first of its series, from the k before it.

    last; the median; the trend, carried one step on, or the mean of fewer than three.
    """
    series = Window.partitionBy(*by).orderBy(*order)
    w = series.rowsBetween(-k, -1)
    x = F.row_number().over(series)
    rows = df.where(F.col(value).isNotNull()).withColumn("_x", x.cast("double"))
    n = F.count(value).over(w)
    slope, my, mx = F.regr_slope(value, "_x").over(w), F.avg(value).over(w), F.avg("_x").over(w)
    trend = F.when(n >= 3, my + F.coalesce(slope, F.lit(0.0)) * (F.col("_x") - mx)).otherwise(my)
    shown = rows.select(
        *by, *order, F.col(value).alias("actual"), n.alias("_n"),
        F.array(
            F.struct(F.lit("last").alias("name"), F.lag(value).over(series).cast("double").alias("prediction")),
            F.struct(F.lit(f"median_{k}").alias("name"), F.percentile(value, F.lit(0.5)).over(w).alias("prediction")),
            F.struct(F.lit(f"trend_{k}").alias("name"), trend.alias("prediction")),
        ).alias("_p"),
    )
    return shown.where("_n > 0").select(*by, *order, "actual", F.explode("_p").alias("_p")).select(*by, *order, "actual", "_p.name", "_p.prediction")


def score_pairs(pairs: DataFrame, by: Sequence[str], least: int = 6, tolerances: Sequence[float] = (12, 24), coverage: float = 0.79) -> DataFrame:
    """n, mean and median absolute error, root mean square, shares within the tolerances, and the window that would hold
    `coverage` of the outcomes. Series of fewer than `least` values have no score."""
    e = F.col("prediction") - F.col("actual")
    a = F.abs(e)
    within = [(100.0 * F.avg(F.when(a <= t, 1.0).otherwise(0.0))).alias(f"within_{t:g}_pct") for t in tolerances]
    series = [*by, "name"]
    n = F.col("n")
    middles = {"_low": F.floor((n + 1) / 2).cast("int"), "_high": F.ceil((n + 1) / 2).cast("int"), "_held": rank_at(coverage, n)}
    picked = nth_values(pairs.withColumn("_a", a), series, "_a", middles).withColumn("median_ae", (F.col("_low") + F.col("_high")) / 2).withColumn("implied_window_days", 2 * F.col("_held") / 24)
    sums = pairs.groupBy(*series).agg(F.count("*").alias("n"), F.avg(a).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), *within)
    on = [sums[c].eqNullSafe(picked[c]) for c in series]
    out = sums.join(picked, on, "left").select(*[sums[c] for c in series], "n", "mae", "median_ae", "rmse", *[f"within_{t:g}_pct" for t in tolerances], "implied_window_days")
    return out.where(F.col("n") >= least - 1)


def best_first(scores: DataFrame, by: Sequence[str], error: str = "mae") -> DataFrame:
    """A table of scores in order, with the place of each within its series: the least error first; of errors equal to six digits the first by name."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.round(error, 6), "name"))
    return scores.withColumn("place", place).orderBy(*by, "place")


def correlation(x: str, y: str, over: Callable[[Column], Column] = lambda c: c) -> Column:
    """Pearson's r of rows of both measures; NaN where one has no spread, for which F.corr divides by zero. `over` makes each sum a window's."""
    r = F.try_divide(over(F.regr_sxy(y, x)), F.sqrt(over(F.regr_sxx(y, x))) * F.sqrt(over(F.regr_syy(y, x))))
    return F.coalesce(r, F.lit(float("nan")))


def rolling_fit(df: DataFrame, by: Sequence[str], order: Sequence[str], x: str, y: str, k: int = 14, least: int = 5) -> DataFrame:
    """Each row of both measures with the line through the k before it: slope (4 digits), intercept (3), r, n; null below `least` points or without spread of x; r is NaN without spread of y."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-k, -1)
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    n = F.regr_count(y, x).over(w)
    slope = F.when(n >= least, F.regr_slope(y, x).over(w))
    intercept = F.avg(y).over(w) - slope * F.avg(x).over(w)
    return rows.withColumns({"fit_n": n, "slope": F.bround(slope, 4) + 0.0, "intercept": F.bround(intercept, 3) + 0.0, "r": F.when(slope.isNotNull(), F.bround(correlation(x, y, lambda c: c.over(w)), 3) + 0.0)})


def backtest_rows(fitted: DataFrame, by: Sequence[str], order: Sequence[str], number: str, x: str, y: str, first: int) -> DataFrame:
    """From episode `first` on: raw and corrected errors; the correction is the median of the errors before, from three on.

    The median runs along a series in two heaps, all columns beside it; `by` and `order` name a row.
    """
    rows = fitted.where((F.col(number) >= first) & F.col("slope").isNotNull() & (F.col(y) != 0)).withColumn("error", F.col("slope") * F.col(x) + F.col("intercept") - F.col(y))
    places, at = [rows.columns.index(c) for c in by], rows.columns.index("error")

    def medians(batches: Iterator):
        import pyarrow as pa

        key, below, above = None, [], []  # of a series its lesser half, negated, and its greater half, as heaps
        for batch in batches:
            biases = []
            keys = zip(*[batch.column(p).to_pylist() for p in places]) if places else repeat(())
            for row, error in zip(keys, batch.column(at).to_pylist()):
                if row != key:
                    key, below, above = row, [], []
                n = len(below) + len(above)
                biases.append(0.0 if n < 3 else (above[0] - below[0]) / 2 if n % 2 == 0 else -below[0])
                heappush(above, -heappushpop(below, -error))
                if len(above) > len(below):
                    heappush(below, -heappop(above))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(biases, pa.float64())], names=[*batch.schema.names, "bias"])

    keyed = rows.repartition(*by).sortWithinPartitions(*by, *order) if by else rows.repartition(1).sortWithinPartitions(*order)
    out = keyed.mapInArrow(medians, StructType([*rows.schema.fields, StructField("bias", DoubleType())]))
    return out.withColumn("corrected", F.col("error") - F.col("bias"))


def backtest_summary(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    a = F.abs("corrected")
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.bround(F.avg(a), 2).alias("mae_days"),
        F.bround(F.percentile("corrected", F.lit(0.5)), 2).alias("median_error_days"),
        F.sum(F.when(a <= 2, 1).otherwise(0)).alias("within_2_days"),
        F.sum(F.when(a <= 3, 1).otherwise(0)).alias("within_3_days"),
        F.bround(F.percentile("error", F.lit(0.5)), 2).alias("bias_days"),
    )


def latest_model(df: DataFrame, by: Sequence[str], order: Sequence[str], x: str, y: str, k: int = 14, least: int = 5) -> DataFrame:
    """The line through the last k rows of each series."""
    w = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    last = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    fit = last.groupBy(*by).agg(F.count("*").alias("model_n"), F.regr_slope(y, x).alias("_s"), F.avg(x).alias("_mx"), F.avg(y).alias("_my"), correlation(x, y).alias("_r"))
    fit = fit.where((F.col("model_n") >= least) & F.col("_s").isNotNull())
    return fit.select(*by, "model_n", F.bround("_s", 4).alias("slope"), F.bround(F.col("_my") - F.col("_s") * F.col("_mx"), 3).alias("intercept"), F.bround("_r", 3).alias("r"))


def own_forecast(state: DataFrame, models: DataFrame, backtests: DataFrame, reposes: DataFrame, by: Sequence[str], now, least_half: float = 1.5, plain_half: float = 2.5) -> DataFrame:
    """One forecast for each series.

    state: pause, x (the last episode's measure), cumulative, change_24h. Primary is the regression,
    bias-corrected; else the median of the last ten reposes. The date at which the drop is made good
    at the present rate stands beside it as an early risk. half width: the backtest's mean error, at
    least least_half, or plain_half without a backtest.
    """
    out, key = state, list(by) or ["_all"]
    if not by:  # one series: one row a table
        out, models, backtests, reposes = (t.withColumn("_all", F.lit(0)) for t in (out, models, backtests, reposes))
    for other in (models, backtests.select(*key, "mae_days", "bias_days"), reposes.select(*key, "repose_median_hours")):
        out = out.join(other, key, "left")
    days = F.col("slope") * F.col("x") + F.col("intercept") - F.coalesce("bias_days", F.lit(0.0))
    after = lambda start, d: F.timestamp_micros(F.unix_micros(start) + F.round(d * 86_400_000_000).cast("long"))
    model_at, repose_at = after("pause", days), after("pause", F.col("repose_median_hours") / 24)
    point = F.coalesce(model_at, repose_at)
    half = F.coalesce(F.greatest("mae_days", F.lit(least_half)), F.lit(plain_half))
    rest = (F.col("x") - F.col("cumulative")) / F.col("change_24h")
    early = F.when((F.col("change_24h") > 0) & (F.col("x") > F.col("cumulative")), after(now, rest))
    return out.select(
        *by,
        F.when(model_at.isNotNull(), "regression").when(repose_at.isNotNull(), "repose median").alias("method"),
        local_date(point).alias("point_date"),
        local_date(after(point, -half)).alias("window_start"),
        local_date(after(point, half)).alias("window_end"),
        F.when(point.isNotNull(), F.bround(half, 2)).alias("half_width_days"),
        local_date(early).alias("early_risk_date"),
        F.when(F.col("pause").isNull(), "no pause").when(point.isNull(), "no history").alias("unavailable"),
    )


def score_windows(windows: DataFrame) -> DataFrame:
    """Windows (issued, window_start, window_end) with their target (target_onset): lead, hit, and hours outside the window."""
    t = F.col("target_onset")
    outside = F.when(t > F.col("window_end"), hours_between("target_onset", "window_end")).when(t < F.col("window_start"), hours_between("target_onset", "window_start")).otherwise(0.0)
    return windows.withColumns(
        {
            "lead_hours": F.round(hours_between("target_onset", "issued"), 2),
            "hit": hit("target_onset", "window_start", "window_end"),
            "error_hours": F.when(t.isNotNull(), F.round(outside, 2)),
            "window_days": F.round(days_between("window_end", "window_start"), 3),
        }
    )


def window_skill(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """The last windows before each target; several of one issue all stay."""
    return latest_with_ties(scored.where(F.col("target_onset").isNotNull()), by, "issued")


def skill_summary(skill: DataFrame) -> DataFrame:
    return skill.agg(
        F.count("*").alias("n"),
        F.sum("hit").alias("hits"),
        F.round(F.avg("hit") * 100, 2).alias("hit_pct"),
        F.round(F.avg("window_days"), 3).alias("mean_window_days"),
        F.round(F.avg("lead_hours"), 2).alias("mean_lead_hours"),
        F.round(F.avg(F.abs("error_hours")), 2).alias("mean_abs_error_hours"),
    )


def score_recorded(forecasts: DataFrame, episodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Recorded forecasts (last_episode_no, window_start, window_end, point_date as local dates) beside the episode that followed."""
    nxt = episodes.select(*by, (F.col("episode_no") - 1).alias("last_episode_no"), F.col("start").alias("actual_onset"))
    out = forecasts.join(nxt, [*by, "last_episode_no"], "left").withColumn("actual_date", local_date("actual_onset"))
    return out.withColumn("window_hit", hit("actual_date", "window_start", "window_end")).withColumn("point_error_days", F.datediff("actual_date", "point_date"))
