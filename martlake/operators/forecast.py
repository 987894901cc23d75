"""Revenue forecasts.

Both forecasts run **per series key** so thousands of series (for example
city x category) are fitted in parallel; a single series is the special case
of one key.  A series is an aggregate (one row per month or week), so its size
is bounded by the calendar, never by the order volume.

* ``linear_forecast`` aggregates each series once: ordinary least squares
  through ``regr_slope`` / ``regr_intercept`` and the points as an array, over
  which the residuals are folded.
* ``holt_winters_fixed`` smooths each series with given parameters: a fold over
  the series' array in JVM expressions.
* ``holt_winters_forecast`` searches the parameters first (``smoothing_search``:
  many series at once in numpy, spread over all tasks) and then smooths in the
  same way.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.dates import day_ordinal
from martlake.operators.smoothing_search import search

# The parameter search runs on workers that need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Band width in standard errors (about 95 %), default horizons,
# the minimum history lengths and the automatic season choice thresholds.
Z_95 = 1.96
LINEAR_HORIZON = 3
LINEAR_MIN_POINTS = 3
HW_HORIZON = 12
HW_MIN_POINTS = 12
HW_HORIZON_RANGE = (4, 52)
HW_SEASON_RANGE = (0, 260)
SERIES_KEY = "series"


def _with_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(SERIES_KEY, F.lit("all")), [SERIES_KEY]


def normal_band(value: str, se: str, z: float = Z_95) -> tuple["F.Column", "F.Column"]:
    """``value -/+ z * se`` (A5): constant width over the horizon."""
    return F.col(value) - F.lit(z) * F.col(se), F.col(value) + F.lit(z) * F.col(se)


def linear_forecast(
    trend: DataFrame,
    time_col: str = "month",
    value_col: str = "revenue",
    keys: Sequence[str] = (),
    horizon: int = LINEAR_HORIZON,
    z: float = Z_95,
    digits: int | None = None,
) -> DataFrame:
    """OLS of the value on the day ordinal, ``horizon`` months ahead.

    Output: keys, ``time``, ``revenue``, ``lower``, ``upper``, ``type``
    (``Actual`` rows with null bounds, then ``Forecast`` rows).  A series with
    fewer than 3 points gets no forecast rows.  The band is
    ``z x`` the sample standard deviation (ddof 1) of the in-sample residuals.
    ``digits`` rounds the three values.

    The series is bounded by the calendar: one aggregation collects it beside
    slope and intercept, and everything else is an expression on that row.
    """
    series, keys = _with_key(trend, keys)
    series = series.select(
        *keys,
        F.col(time_col).alias("time"),
        F.col(value_col).cast("double").alias("y"),
        day_ordinal(F.col(time_col)).cast("double").alias("x"),
    )
    fit = series.groupBy(*keys).agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.max("time").alias("last_time"),
        F.collect_list(F.struct("time", "y", "x")).alias("points"),
    )
    off = F.transform("points", lambda p: p["y"] - (F.col("slope") * p["x"] + F.col("intercept")))
    fit = fit.withColumn("off", F.filter(off, lambda r: r.isNotNull()))
    fit = fit.withColumn("se", _spread(F.col("off"), 1))
    value = F.col("slope") * day_ordinal("time").cast("double") + F.col("intercept")
    actual = F.transform("points", lambda p: F.struct(p["time"].alias("time"), p["y"].alias("y"), F.lit(0).alias("h")))
    ahead = F.transform(
        F.sequence(F.lit(1), F.lit(horizon)),
        lambda h: F.struct(F.add_months("last_time", h).alias("time"), F.lit(None).cast("double").alias("y"), h.alias("h")),
    )
    rows = F.concat(actual, F.when(F.size("points") >= LINEAR_MIN_POINTS, ahead).otherwise(F.slice(ahead, 1, 0)))
    out = fit.select(*keys, "slope", "intercept", "se", F.explode(rows).alias("r")).select(*keys, "slope", "intercept", "se", "r.*")
    out = out.withColumn("revenue", F.when(F.col("h") > 0, value).otherwise(F.col("y")))
    lower, upper = normal_band("revenue", "se", z)
    shown = lambda c: c if digits is None else F.round(c, digits)
    return out.select(
        *keys,
        "time",
        shown(F.col("revenue")).alias("revenue"),
        shown(F.when(F.col("h") > 0, lower)).alias("lower"),
        shown(F.when(F.col("h") > 0, upper)).alias("upper"),
        F.when(F.col("h") > 0, "Forecast").otherwise("Actual").alias("type"),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _spread(values: Column, ddof: int) -> Column:
    """Standard deviation of an array of doubles: deviations from the mean, not differences of squares."""
    n = F.size(values)
    mean = _sum(values) / n
    squares = F.aggregate(
        values,
        F.struct(F.lit(0.0).alias("sum"), mean.alias("mean")),
        lambda a, x: F.struct((a["sum"] + (x - a["mean"]) * (x - a["mean"])).alias("sum"), a["mean"].alias("mean")),
        lambda a: a["sum"],
    )
    return F.when(n > ddof, F.sqrt(squares / (n - ddof)))


# ---------------------------------------------------------------- Holt-Winters


def auto_season(n: int) -> int | None:
    """Automatic season length for ``n`` weekly points."""
    if n >= 52:
        return 52
    if n >= 26:
        return 13
    if n >= 12:
        return 12
    return None


def choose_season(n: int, season: int | None) -> int | None:
    """Season actually fitted: needs ``2 <= season`` and two full cycles."""
    if season is None or season < 2 or season >= n or 2 * season > n:
        return None
    return season


def _series_arrays(weekly: DataFrame, time_col: str, value_col: str, keys: Sequence[str], season, fill_gaps: bool) -> tuple[DataFrame, list[str]]:
    """One row per series: ``times`` and ``ys`` in time order, length ``n`` and season ``m`` (0: none).

    Points without a value are left out; series with fewer than 12 points are
    not fitted and drop out here.
    """
    series, keys = _with_key(weekly, keys)
    series = series.select(*keys, F.col(time_col).cast("date").alias("time"), F.col(value_col).cast("double").alias("y"))
    usable = series.where(F.col("y").isNotNull() & ~F.isnan("y") & (F.abs("y") < float("inf")))
    arrays = usable.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("time", "y"))).alias("points"))
    arrays = arrays.withColumn("times", F.transform("points", lambda p: p["time"])).withColumn("ys", F.transform("points", lambda p: p["y"]))
    if fill_gaps:
        known = F.map_from_arrays("times", "ys")
        weeks = F.sequence(F.array_min("times"), F.array_max("times"), F.expr("INTERVAL 7 DAYS"))
        arrays = arrays.withColumn("known", known).withColumn("times", weeks)
        arrays = arrays.withColumn("ys", F.transform("times", lambda t: F.coalesce(F.element_at("known", t), F.lit(0.0)))).drop("known")
    arrays = arrays.withColumn("n", F.size("ys")).where(F.col("n") >= HW_MIN_POINTS)
    if season == "auto":
        wanted = F.when(F.col("n") >= 52, 52).when(F.col("n") >= 26, 13).otherwise(12)
    else:
        wanted = F.lit(season or 0)
    fits = (wanted >= 2) & (wanted < F.col("n")) & (2 * wanted <= F.col("n"))
    return arrays.drop("points").withColumn("m", F.when(fits, wanted).otherwise(0)), keys


def _smoothed(arrays: DataFrame, keys: list[str], horizon: int, z: float) -> DataFrame:
    """Forecast rows of series with columns alpha, beta and gamma: a fold over each array.

    The state carries level, trend and all seasonal indices so far; the index
    of point t stands at place t, one cycle before the one it leads to.
    """
    ys, m, n = F.col("ys"), F.col("m"), F.col("n")
    seasonal = m > 0
    cycle = lambda first: _sum(F.slice(ys, first, F.greatest(m, F.lit(1)))) / F.greatest(m, F.lit(1))
    arrays = arrays.withColumns({"_mean1": cycle(F.lit(1)), "_mean2": cycle(F.least(m + 1, n))})
    no_values = F.array().cast("array<double>")
    start = F.struct(
        F.when(seasonal, F.col("_mean1")).otherwise(F.get(ys, F.lit(0))).alias("level"),
        F.when(seasonal, (F.col("_mean2") - F.col("_mean1")) / m).otherwise(F.get(ys, F.lit(1)) - F.get(ys, F.lit(0))).alias("trend"),
        F.when(seasonal, F.transform(F.slice(ys, 1, F.greatest(m, F.lit(1))), lambda v: v - F.col("_mean1"))).otherwise(no_values).alias("seas"),
        no_values.alias("errs"),
    )
    alpha, beta, gamma = F.col("alpha"), F.col("beta"), F.col("gamma")

    def step(acc: Column, y: Column) -> Column:
        t = F.size(acc["errs"])
        s = F.when(seasonal, F.get(acc["seas"], t)).otherwise(F.lit(0.0))
        level = alpha * (y - s) + (1 - alpha) * (acc["level"] + acc["trend"])
        return F.struct(
            level.alias("level"),
            (beta * (level - acc["level"]) + (1 - beta) * acc["trend"]).alias("trend"),
            F.when(seasonal, F.concat(acc["seas"], F.array(gamma * (y - level) + (1 - gamma) * s))).otherwise(no_values).alias("seas"),
            F.concat(acc["errs"], F.array(y - (acc["level"] + acc["trend"] + s))).alias("errs"),
        )

    state = arrays.withColumn("state", F.aggregate("ys", start, step))
    state = state.withColumn("se", _spread(F.col("state.errs"), 0))
    rows = state.select(*keys, "times", "n", "m", "state", "se", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    season = F.when(seasonal, F.get(F.col("state.seas"), n + F.pmod(F.col("h") - 1, F.greatest(m, F.lit(1))))).otherwise(F.lit(0.0))
    rows = rows.withColumn("revenue", F.col("state.level") + F.col("h") * F.col("state.trend") + season)
    lower, upper = normal_band("revenue", "se", z)
    return rows.select(
        *keys,
        F.date_add(F.array_max("times"), 7 * F.col("h")).alias("time"),
        "revenue",
        lower.alias("lower"),
        upper.alias("upper"),
        F.lit("Forecast").alias("type"),
        F.when(seasonal, "trend+season").otherwise("trend").alias("model"),
    )


def _check_ranges(horizon: int, season: int | None | str) -> int | None | str:
    lo, hi = HW_HORIZON_RANGE
    if not lo <= horizon <= hi:
        raise ValueError(f"horizon must be in {HW_HORIZON_RANGE}")
    if isinstance(season, int) and not HW_SEASON_RANGE[0] <= season <= HW_SEASON_RANGE[1]:
        raise ValueError(f"season must be in {HW_SEASON_RANGE}")
    return season or None


def _with_actuals(weekly: DataFrame, forecast: DataFrame, time_col: str, value_col: str, keys: Sequence[str]) -> DataFrame:
    series, keys = _with_key(weekly, keys)
    actual = series.select(*keys, F.col(time_col).cast("date").alias("time"), F.col(value_col).cast("double").alias("revenue"), F.lit("Actual").alias("type"))
    return actual.unionByName(forecast, allowMissingColumns=True)


def holt_winters_fixed(
    weekly: DataFrame,
    alpha: float,
    beta: float,
    gamma: float,
    time_col: str = "week",
    value_col: str = "revenue",
    keys: Sequence[str] = (),
    horizon: int = HW_HORIZON,
    season: int | None | str = "auto",
    z: float = Z_95,
    fill_gaps: bool = False,
) -> DataFrame:
    """Additive Holt-Winters with given smoothing parameters (A2, A2a, A5, U1); see ``holt_winters_forecast``."""
    season = _check_ranges(horizon, season)
    arrays, own = _series_arrays(weekly, time_col, value_col, keys, season, fill_gaps)
    arrays = arrays.withColumns({"alpha": F.lit(float(alpha)), "beta": F.lit(float(beta)), "gamma": F.lit(float(gamma))})
    return _with_actuals(weekly, _smoothed(arrays, own, horizon, z), time_col, value_col, keys)


def holt_winters_forecast(
    weekly: DataFrame,
    time_col: str = "week",
    value_col: str = "revenue",
    keys: Sequence[str] = (),
    horizon: int = HW_HORIZON,
    season: int | None | str = "auto",
    z: float = Z_95,
    fill_gaps: bool = False,
) -> DataFrame:
    """Additive Holt-Winters per series key.

    ``season="auto"`` picks 52 / 13 / 12 from the series length; a season is
    fitted only with two full cycles, otherwise trend only, and the output
    column ``model`` says which.  The band is ``z x`` the population standard
    deviation of the in-sample one-step residuals.  Output rows: the actual
    series (``type = Actual``) and ``horizon`` weekly forecast rows per series
    with at least 12 points that have a value.

    The parameters of all series are searched side by side (``smoothing_search``),
    dealt over as many tasks as the cluster runs at once.
    """
    season = _check_ranges(horizon, season)
    arrays, own = _series_arrays(weekly, time_col, value_col, keys, season, fill_gaps)
    return _with_actuals(weekly, _smoothed(fitted(arrays, own), own, horizon, z), time_col, value_col, keys)


def fitted(arrays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series (``ys``, season ``m``) with the parameters of least squared one-step error: alpha, beta, gamma, error.

    The number of partitions is given, so that adaptive execution, which sees few
    bytes, doesn't gather the series in one task.
    """
    names = ["alpha", "beta", "gamma", "error"]
    tasks = arrays.sparkSession.sparkContext.defaultParallelism
    rows = arrays.select(*[F.col(f"`{c}`") for c in arrays.columns if c not in names]).repartition(tasks, *keys)

    def run(batches):
        for batch in batches:
            found = search([np.asarray(y, float) for y in batch["ys"]], batch["m"].tolist())
            yield pd.concat([batch, pd.DataFrame(found, columns=names, index=batch.index)], axis=1)

    return rows.mapInPandas(run, T.StructType(rows.schema.fields + [T.StructField(c, T.DoubleType()) for c in names]))


def holt_winters_parameters(
    weekly: DataFrame,
    time_col: str = "week",
    value_col: str = "revenue",
    keys: Sequence[str] = (),
    season: int | None | str = "auto",
    fill_gaps: bool = False,
) -> DataFrame:
    """The parameters that ``holt_winters_forecast`` smooths with: keys, weeks, season (0: none), alpha, beta, gamma, squared_error."""
    arrays, own = _series_arrays(weekly, time_col, value_col, keys, season or None, fill_gaps)
    return fitted(arrays, own).select(*own, F.col("n").alias("weeks"), F.col("m").alias("season"), "alpha", "beta", "gamma", F.col("error").alias("squared_error"))
