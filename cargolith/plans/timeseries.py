"""Forecasting over many series, frames being (series_id, ds, y) with one row per day.

Only daily aggregates get here, so a series holds at most one row per calendar day
(36,525 over the whole calendar) and windows or arrays per series are bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolith.functions import statistics as st
from cargolith.operators.stats import attach
from cargolith.session import tiny

col, lit, when = F.col, F.lit, F.when


def daily_series(df: DataFrame, series: Column, when_: Column, value: Column) -> DataFrame:
    """Daily sums per series with missing days filled with 0."""
    rows = df.select(series.cast("string").alias("series_id"), F.to_date(when_).alias("ds"), value.cast("double").alias("y"))
    sums = rows.filter(col("ds").isNotNull() & col("y").isNotNull()).groupBy("series_id", "ds").agg(F.sum("y").alias("y"))
    spans = sums.groupBy("series_id").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    days = spans.select("series_id", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("ds"))
    return days.join(sums, ["series_id", "ds"], "left").select("series_id", "ds", F.coalesce("y", lit(0.0)).alias("y"))


def _by_day() -> Window:
    return Window.partitionBy("series_id").orderBy("ds")


def numbered(series: DataFrame) -> DataFrame:
    """Adds the 0-based position ``i`` and the length ``n``."""
    return series.withColumn("i", F.row_number().over(_by_day()) - 1).withColumn("n", F.count(lit(1)).over(Window.partitionBy("series_id")))


def moving_average(daily: DataFrame, rows: int = 180, order: str = "ShipmentDate", value: str = "Shipments") -> DataFrame:
    """Mean of the last ``rows`` rows (not days) of one daily frame."""
    w = Window.orderBy(order).rowsBetween(-(rows - 1), 0)
    return daily.withColumn("Forecast", F.avg(value).over(w))


def last_rows(series: DataFrame, k: int = 7) -> DataFrame:
    """The last ``k`` rows of each series, with their place from 0."""
    back = Window.partitionBy("series_id").orderBy(col("ds").desc())
    return series.withColumn("__r", F.row_number().over(back)).filter(col("__r") <= k).withColumn("place", k - col("__r")).drop("__r")


def horizon_days(series: DataFrame, horizon: int) -> DataFrame:
    """The ``horizon`` days after the last day of each series; ``step`` from 1."""
    ends = series.groupBy("series_id").agg(F.max("ds").alias("last"), F.count(lit(1)).alias("n"), F.avg("y").alias("mean"))
    steps = F.explode(F.sequence(lit(1), lit(horizon))).alias("step")
    return ends.select("series_id", "n", "mean", "last", steps).select("series_id", "n", "mean", "step", F.date_add("last", col("step")).alias("ds"))


def naive_forecast(series: DataFrame, horizon: int) -> DataFrame:
    """The last week repeated; the mean for series shorter than a week."""
    days = horizon_days(series, horizon)
    week = last_rows(series, 7).select("series_id", col("place").alias("phase"), "y")
    keyed = days.withColumn("phase", (col("step") - 1) % 7)
    value = when(col("n") >= 7, col("y")).otherwise(col("mean"))
    method = when(col("n") >= 7, "seasonal_naive").otherwise("mean")
    return keyed.join(week, ["series_id", "phase"], "left").select("series_id", method.alias("method"), "ds", value.alias("yhat"))


# Smoothing weights that are tried, for the level; trend and season take half of each.
WEIGHTS = [0.05, 0.1, 0.3, 0.5, 0.8]


def smoothing_forecast(series: DataFrame, horizon: int) -> DataFrame:
    """Additive trend and, for more than 24 points, additive season of up to 12 points.

    The days of a series (at most one a calendar day) are one array; every weight of the grid is a row, and its
    state is a fold over the array: level, trend, season, squared one-step errors. The least error wins, the
    earlier weights on a tie.
    """
    days = series.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("ds", "y"))).alias("days"))
    days = days.select("series_id", col("days")[F.size("days") - 1]["ds"].alias("last"), F.transform("days", lambda r: r["y"].cast("double")).alias("y"))
    n, y, one = F.size("y"), col("y"), lit(1.0)
    period = when(n > 24, F.least(lit(12), F.floor(n / 3).cast("int"))).otherwise(0)

    def mean(values: Column) -> Column:
        return F.aggregate(values, lit(0.0), lambda t, v: t + v) / F.size(values)

    half = (col("period") - 1) / 2
    first = mean(F.slice("y", 1, F.greatest("period", lit(1))))
    days = days.withColumn("period", period).withColumn("first", first)
    slope = (mean(F.slice(y, col("period") + 1, F.greatest(col("period"), lit(1)))) - col("first")) / col("period")
    seasonal = col("period") > 1
    days = days.withColumn("slope", when(seasonal, slope))
    # First cycle: slope between cycle means, season as the detrended rest.
    season = F.transform(F.slice("y", 1, F.greatest("period", lit(1))), lambda v, i: v - col("first") - col("slope") * (i - half))
    days = days.select(
        "series_id", "last", "y", when(seasonal, col("period")).otherwise(1).alias("start"),
        when(seasonal, season).otherwise(F.array(lit(0.0))).alias("season"),
        when(seasonal, col("first") + col("slope") * (col("period") - 1 - half)).otherwise(y[0]).alias("level"),
        when(seasonal, col("slope")).when(n > 1, y[1] - y[0]).otherwise(0.0).alias("trend"))
    grid = [(a, b / 2, g / 2, i * 25 + j * 5 + k) for i, a in enumerate(WEIGHTS) for j, b in enumerate(WEIGHTS) for k, g in enumerate(WEIGHTS)]
    choices = F.array(*[F.struct(lit(a).alias("a"), lit(b).alias("b"), lit(g).alias("g"), lit(k).alias("place")) for a, b, g, k in grid])
    # Without a season only the first seasonal weight is tried, where it has no effect.
    choices = when(F.size("season") > 1, choices).otherwise(F.filter(choices, lambda c: c["place"] % 5 == 0))
    rows = days.select("*", F.inline(choices))
    a, b, g = col("a"), col("b"), when(F.size("season") > 1, col("g")).otherwise(0.0)

    def state(level: Column, trend: Column, season: Column, error: Column) -> Column:
        return F.struct(level.alias("level"), trend.alias("trend"), season.alias("season"), error.alias("error"))

    def step(s: Column, i: Column) -> Column:
        at = (i % F.size(s["season"])).cast("int")
        value, own = F.get("y", i), F.get(s["season"], at)
        ahead = s["level"] + s["trend"]
        level = a * (value - own) + (one - a) * ahead
        season = F.transform(s["season"], lambda v, j: when(j == at, g * (value - level) + (one - g) * own).otherwise(v))
        miss = value - (ahead + own)
        return state(level, b * (level - s["level"]) + (one - b) * s["trend"], season, s["error"] + miss * miss)

    turns = when(F.size("y") > col("start"), F.sequence(col("start"), F.size("y") - 1)).otherwise(F.array().cast("array<int>"))
    ended = rows.select("series_id", "last", F.size("y").alias("n"), "place", F.aggregate(turns, state(col("level"), col("trend"), col("season"), lit(0.0)), step).alias("s"))
    best = ended.groupBy("series_id").agg(F.min_by(F.struct("last", "n", "s"), F.struct(col("s.error"), col("place"))).alias("r"))
    k = F.explode(F.sequence(lit(1), lit(horizon))).alias("k")
    ahead = best.select("series_id", "r", k)
    yhat = col("r.s.level") + col("r.s.trend") * col("k") + F.get(col("r.s.season"), (col("r.n") - 1 + col("k")) % F.size("r.s.season"))
    return ahead.select("series_id", lit("exponential_smoothing").alias("method"), F.date_add("r.last", col("k")).alias("ds"), yhat.alias("yhat"))


def autoregressive_forecast(series: DataFrame, horizon: int) -> DataFrame:
    """Autoregression of up to two lags on the series or its differences by least squares, order by AIC.

    Least squares needs the means and products of a value and its two lags only: one aggregate per series and
    degree of differencing, solved as expressions. Series too short for any order are continued by their mean.
    """
    w = _by_day()
    both = series.select("series_id", "ds", col("y").cast("double").alias("y")).withColumn("before", F.lag("y").over(w))
    options = F.array(F.struct(lit(0).alias("d"), col("y").alias("z")), F.struct(lit(1).alias("d"), (col("y") - col("before")).alias("z")))
    rows = both.select("series_id", "ds", F.inline(options)).filter(col("z").isNotNull())
    by = Window.partitionBy("series_id", "d").orderBy("ds")
    lagged = rows.withColumn("z1", F.lag("z", 1).over(by)).withColumn("z2", F.lag("z", 2).over(by))
    tail = lagged.withColumn("__r", F.row_number().over(Window.partitionBy("series_id", "d").orderBy(col("ds").desc()))).filter("__r = 1").select(
        "series_id", "d", col("z").alias("last1"), col("z1").alias("last2"))
    m = F.count(lit(1))
    pairs = {"00": ("z", "z"), "01": ("z", "z1"), "02": ("z", "z2"), "11": ("z1", "z1"), "12": ("z1", "z2"), "22": ("z2", "z2")}
    sums = lagged.filter(col("z2").isNotNull()).groupBy("series_id", "d").agg(
        m.alias("m"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(("z", "z1", "z2"))], *[(F.covar_pop(a, b) * m).alias(f"s{k}") for k, (a, b) in pairs.items()])
    s = {k: col(f"s{k}") for k in pairs}
    det = s["11"] * s["22"] - s["12"] * s["12"]
    two = ((s["01"] * s["22"] - s["02"] * s["12"]) / det, (s["02"] * s["11"] - s["01"] * s["12"]) / det)
    zero, out = lit(0.0), []
    for p, (w1, w2, ok) in enumerate([(zero, zero, lit(True)), (s["01"] / s["11"], zero, s["11"] > 0), (*two, det > 1e-12 * s["11"] * s["22"])]):
        w1, w2 = when(ok, w1).otherwise(0.0), when(ok, w2).otherwise(0.0)
        spread = s["00"] - w1 * s["01"] - w2 * s["02"]
        aic = col("m") * F.log(F.greatest(spread / col("m"), lit(1e-12))) + 2 * (p + 1)
        fit = F.struct(aic.alias("aic"), col("d"), lit(p).alias("p"), (col("m0") - w1 * col("m1") - w2 * col("m2")).alias("w0"), w1.alias("w1"), w2.alias("w2"))
        out.append(when(ok & (col("m") >= p + 3), fit))
    found = sums.select("series_id", F.explode(F.array_compact(F.array(*out))).alias("f")).groupBy("series_id").agg(
        F.min_by("f", F.struct(col("f.aic"), col("f.d"), col("f.p"))).alias("f")).select("series_id", "f.d", "f.w0", "f.w1", "f.w2")
    about = series.groupBy("series_id").agg(F.max("ds").alias("last"), F.max_by("y", "ds").cast("double").alias("top"), F.avg("y").alias("mean"))
    known = about.join(found, "series_id", "left").join(tail, ["series_id", "d"], "left")

    def step(a: Column, _: Column) -> Column:
        value = col("w0") + col("w1") * a["z1"] + col("w2") * a["z2"]
        return F.struct(value.alias("z1"), a["z1"].alias("z2"), F.concat(a["out"], F.array(value)).alias("out"))

    start = F.struct(col("last1").alias("z1"), F.coalesce("last2", lit(0.0)).alias("z2"), F.array().cast("array<double>").alias("out"))
    ahead = known.withColumn("out", F.aggregate(F.sequence(lit(1), lit(horizon)), start, step)["out"]).select("*", F.explode(F.sequence(lit(1), lit(horizon))).alias("k"))
    total = F.aggregate(F.slice("out", 1, col("k")), lit(0.0), lambda t, v: t + v)
    yhat = when(col("w0").isNull(), col("mean")).when(col("d") == 1, col("top") + total).otherwise(F.get("out", col("k") - 1))
    return ahead.select("series_id", lit("autoregressive").alias("method"), F.date_add("last", col("k")).alias("ds"), yhat.alias("yhat"))


def ensemble(*forecasts: DataFrame) -> DataFrame:
    """Equal-weight mean of the methods."""
    out = forecasts[0]
    for f in forecasts[1:]:
        out = out.unionByName(f)
    return out.groupBy("series_id", "ds").agg(F.avg("yhat").alias("yhat")).select("series_id", lit("ensemble").alias("method"), "ds", "yhat")


def ensemble_forecast(series: DataFrame, horizon: int) -> DataFrame:
    return ensemble(smoothing_forecast(series, horizon), autoregressive_forecast(series, horizon))


def history_and_forecast(series: DataFrame, forecast: DataFrame) -> DataFrame:
    past = series.select("series_id", "ds", col("y").alias("actual"), lit(None).cast("double").alias("forecast"), lit("historical").alias("type"))
    ahead = forecast.select("series_id", "ds", lit(None).cast("double").alias("actual"), col("yhat").alias("forecast"), lit("forecast").alias("type"))
    return past.unionByName(ahead)


def long_enough(series: DataFrame, points: int) -> DataFrame:
    return numbered(series).filter(col("n") >= points).select("series_id", "ds", "y")


def comprehensive_forecast(series: DataFrame, horizon: int) -> DataFrame:
    """History, every method and their ensemble, for series of at least 14 points."""
    usable = long_enough(series, 14)
    each = smoothing_forecast(usable, horizon).unionByName(autoregressive_forecast(usable, horizon))
    everything = each.unionByName(ensemble(each))
    past = usable.select("series_id", lit("history").alias("method"), "ds", col("y").alias("yhat"))
    return past.unionByName(everything)


def split_last(series: DataFrame, days: int = 7, minimum: int = 21) -> tuple[DataFrame, DataFrame]:
    """(train, validation): the last ``days`` rows of series with enough points are held out."""
    rows = numbered(series).filter(col("n") >= minimum)
    keep = col("i") < col("n") - days
    return rows.filter(keep).select("series_id", "ds", "y"), rows.filter(~keep).select("series_id", "ds", "y")


def backtest(series: DataFrame, methods: Sequence = (smoothing_forecast, autoregressive_forecast), days: int = 7) -> DataFrame:
    """Percentage error per series and method on the held-out days."""
    train, held = split_last(series, days)
    forecasts = [m(train, days) for m in methods]
    everything = forecasts[0]
    for f in forecasts[1:]:
        everything = everything.unionByName(f)
    gap = F.abs((col("y") - col("yhat")) / (col("y") + 1e-8))
    return everything.join(held, ["series_id", "ds"]).groupBy("series_id", "method").agg((F.avg(gap) * 100).alias("mape"))


def best_methods(errors: DataFrame) -> DataFrame:
    return errors.groupBy("series_id").agg(F.min_by("method", "mape").alias("best_method"), F.min("mape").alias("mape"))


def decomposition(series: DataFrame, period: int = 7) -> DataFrame:
    """Additive parts: centred mean over a full period, phase means centred on 0, rest."""
    half = period // 2
    w = _by_day().rowsBetween(-half, half)
    rows = numbered(series).filter(col("n") >= 24)
    trend = when(F.count(lit(1)).over(w) == period, F.avg("y").over(w))
    rows = rows.withColumn("trend", trend).withColumn("phase", col("i") % period)
    phases = rows.groupBy("series_id", "phase").agg(F.avg(col("y") - col("trend")).alias("raw"))
    phases = phases.withColumn("seasonal", col("raw") - F.avg("raw").over(Window.partitionBy("series_id"))).drop("raw")
    return rows.join(phases, ["series_id", "phase"]).withColumn("resid", col("y") - col("trend") - col("seasonal"))


def seasonality(series: DataFrame, period: int = 7) -> DataFrame:
    parts = decomposition(series, period)
    return parts.groupBy("series_id").agg(
        F.try_divide(F.var_pop("seasonal"), F.var_pop("y")).alias("seasonal_strength"),
        F.try_divide(F.var_pop("trend"), F.var_pop("y")).alias("trend_strength"),
        F.var_pop("resid").alias("residual_variance"),
    )


def trend(series: DataFrame, with_p: bool = True) -> DataFrame:
    """Least-squares slope per series, its r2, class and significance."""
    x = col("i").cast("double")
    one = numbered(series).groupBy("series_id").agg(
        F.regr_slope("y", x).alias("slope"),
        F.regr_intercept("y", x).alias("intercept"),
        F.regr_r2("y", x).alias("r_squared"),
        F.count(lit(1)).alias("n"),
    )
    kind = when(F.abs("slope") < 0.01, "stationary").when(col("slope") > 0, "increasing").otherwise("decreasing")
    one = one.withColumn("trend_type", kind)
    df = (col("n") - 2).cast("double")
    # A perfect fit has an infinite statistic.
    t = when(col("r_squared") >= 1, lit(float("inf"))).otherwise(F.sqrt(F.try_divide(col("r_squared") * df, 1 - col("r_squared"))))
    one = one.withColumn("t_statistic", t)
    if not with_p:
        return one
    return one.withColumn("p_value", st.student_p_column(col("t_statistic"), df)).withColumn("is_significant", col("p_value") < 0.05)


def forecast_band(forecast: DataFrame, series: DataFrame, z: float = 1.96) -> DataFrame:
    """Forecast with a band of z historical deviations and a weekend flag."""
    spread = series.groupBy("series_id").agg(F.stddev_samp("y").alias("__sd"))
    return forecast.join(spread, "series_id").select(
        "series_id", "method", "ds", "yhat", (col("yhat") - z * col("__sd")).alias("lower"), (col("yhat") + z * col("__sd")).alias("upper"),
        (F.weekday("ds") >= 5).alias("is_weekend"),
    )


def forecast_spread_band(forecast: DataFrame) -> DataFrame:
    """The other band: one deviation of the predictions themselves."""
    sd = F.stddev_samp("yhat").over(Window.partitionBy("series_id", "method"))
    return forecast.withColumn("lower", col("yhat") - sd).withColumn("upper", col("yhat") + sd)


def monthly_projection(monthly: DataFrame, factors: DataFrame, avg_value: DataFrame, horizon: int = 18) -> DataFrame:
    """Months of history and ``horizon`` projected months.

    ``monthly`` is (month DATE, shipments); base and growth come from the least-squares
    line over the months, season factors from (Season, factor), revenue from the mean
    value (one row, ``avg_value``). One row per calendar month throughout.
    """
    from cargolith.functions.dates import season_of

    idx = monthly.withColumn("i", F.row_number().over(Window.orderBy("month")) - 1)
    x = col("i").cast("double")
    line = idx.agg(
        F.regr_intercept(col("shipments").cast("double"), x).alias("base"),
        F.try_divide(F.regr_slope(col("shipments").cast("double"), x), F.regr_intercept(col("shipments").cast("double"), x)).alias("growth"),
        F.max("month").alias("last"),
        F.count(lit(1)).alias("n"),
    )
    past = idx.select("month", col("shipments").cast("double").alias("actual"), lit(None).cast("double").alias("forecast"),
                      lit("Historical").alias("type"), lit(1.0).alias("confidence"), lit(1.0).alias("seasonal_factor"))
    steps = line.select("*", F.explode(F.sequence(lit(0), lit(horizon - 1))).alias("k")).withColumn("month", F.add_months("last", col("k") + 1))
    steps = steps.withColumn("Season", season_of(col("month"))).join(tiny(factors), "Season")
    ahead = steps.select(
        "month",
        lit(None).cast("double").alias("actual"),
        (col("base") * F.pow(1 + col("growth"), col("n") + col("k")) * col("factor")).alias("forecast"),
        lit("Forecast").alias("type"),
        F.greatest(lit(0.85) - col("k") * 0.02, lit(0.70)).alias("confidence"),
        col("factor").alias("seasonal_factor"),
    )
    out = attach(past.unionByName(ahead), avg_value)
    return out.withColumn("estimated_revenue", F.coalesce("actual", "forecast") * col("avg_value")).drop("avg_value")
