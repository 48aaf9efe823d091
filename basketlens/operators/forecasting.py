"""Daily demand series, backtests and forecasts, one or many series at once.

Series frames have ``series_key``, ``ds`` (date) and ``y``, one row per series and day, so a
window or group over one series is bounded by the calendar, not by the orders.
"""

from functools import partial

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.functions import fitting, seasonal
from basketlens.functions.packing import in_packs
from basketlens.functions.prefix import running_totals

ANCHOR = "2025-01-01"
#: Smoothing parameters of forecasts that are not fitted: alpha, beta, gamma.
FIXED = (0.3, 0.05, 0.2)
FIRST_DAY, LAST_DAY = "2025-01-01", "2025-10-31"
PLATFORM = "platform"
AVERAGE, SMOOTHING, ARIMA = ("7-Day Moving Average (Baseline)", "Holt-Winters Exp Smoothing",
                             "Seasonal ARIMA")
ORDERS_PER_CHUNK = 100000
#: Values of the series that one task fits together.
PACK_VALUES = 1 << 18


def order_timeline(orders, anchor=ANCHOR):
    """Orders dated by the user's summed gaps from a common first day.

    The running sum is cut into chunks of order numbers, so a user with very many orders is
    spread over tasks.
    """
    chunked = orders.select("order_id", "user_id", "order_number", "days_since_prior_order",
                            F.floor(F.col("order_number") / ORDERS_PER_CHUNK).alias("chunk"))
    summed = running_totals(chunked, ["user_id"], "chunk", ["order_number"],
                            {"cumulative_days": F.coalesce("days_since_prior_order", F.lit(0.0))})
    return summed.select(
        "order_id", "user_id", "order_number", F.col("cumulative_days").cast("int"),
        F.date_add(F.lit(anchor).cast("date"), F.col("cumulative_days").cast("int"))
        .alias("order_date"))


def daily_volume(dated, first_day=FIRST_DAY, last_day=LAST_DAY, key=PLATFORM):
    """Orders per day in a date range (T2); None leaves a side open."""
    rows = dated
    if first_day is not None:
        rows = rows.filter(F.col("order_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.filter(F.col("order_date") <= F.lit(last_day).cast("date"))
    return rows.groupBy(F.lit(key).alias("series_key"), F.col("order_date").alias("ds")).agg(
        F.count(F.lit(1)).alias("y"))


def daily_volume_by(dated, lines, products, level="department_id", first_day=None,
                    last_day=None):
    """Orders per day that contain a department, aisle or product."""
    wanted = products.select("product_id", F.col(level).cast("string").alias("series_key")) \
        if level != "product_id" else None
    if wanted is None:
        keyed = lines.select("order_id", F.col("product_id").cast("string").alias("series_key"))
    else:
        keyed = lines.select("order_id", "product_id").join(wanted, "product_id").drop("product_id")
    single = keyed.groupBy("order_id", "series_key").agg(F.lit(1))
    rows = single.select("order_id", "series_key").join(
        dated.select("order_id", F.col("order_date").alias("ds")), "order_id")
    if first_day is not None:
        rows = rows.filter(F.col("ds") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.filter(F.col("ds") <= F.lit(last_day).cast("date"))
    return rows.groupBy("series_key", "ds").agg(F.count(F.lit(1)).alias("y"))


def fill_days(series):
    """Every day between a series' ends; a missing day takes the last known value."""
    ends = series.groupBy("series_key").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    days = ends.select("series_key", F.explode(F.sequence("a", "b")).alias("ds"))
    along = (W.partitionBy("series_key").orderBy("ds")
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    return days.join(series, ["series_key", "ds"], "left").select(
        "series_key", "ds", F.last("y", ignorenulls=True).over(along).alias("y"))


def _by_series(series, tasks):
    """Known days whose series stay whole in one of ``tasks`` tasks, or of Spark's own number."""
    kept = series.filter(F.col("ds").isNotNull())
    return kept if tasks is None else kept.repartition(tasks, "series_key")


def intermittent_days(series, tasks=None):
    """Every day from a series' first to the last day of any series; a day without orders is 0.

    For demand of single products, most of whose days have none: a product that is no longer bought
    ends in zeros instead of ending. Only days with orders are shuffled; each brings the empty days after
    it, so that the rows of a series stay in its task.
    """
    last = series.agg(F.max("ds").alias("last")).scalar()
    following = F.lead("ds").over(W.partitionBy("series_key").orderBy("ds"))
    until = F.greatest("ds", F.coalesce(F.date_sub("following", 1), last))
    # A series without a key has days but no demand of its own.
    known = F.col("series_key").isNotNull() & (F.col("day") == F.col("ds"))
    return (_by_series(series, tasks).withColumn("following", following)
            .select("series_key", "ds", "y", F.explode(F.sequence("ds", until)).alias("day"))
            .select("series_key", F.col("day").alias("ds"), F.coalesce(F.when(known, F.col("y")), F.lit(0))
                    .alias("y")))


def intermittent_series(series, tasks=None):
    """The days of :func:`intermittent_days` as one array per series, in packs for a fit.

    Series are shuffled and dealt as their days with orders; a task fills in the others before it fits.
    """
    last = series.agg(F.max("ds").alias("last")).scalar()
    whole = _by_series(series, tasks).groupBy("series_key").agg(
        F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("known"),
        F.min("ds").alias("first")).withColumn("last", last)
    sizes = whole.select("series_key", (F.datediff("last", "first") + 2).alias("size"))
    dealt = in_packs(whole, sizes, "series_key", PACK_VALUES)

    def with_gap(day, at):
        following = F.coalesce(F.get("known", at + 1)["ds"], F.date_add("last", 1))
        return F.concat(F.array(F.coalesce(day["y"], F.lit(0.0))), F.array_repeat(
            F.lit(0.0), F.datediff(following, day["ds"]) - 1))

    return dealt.select("series_key", F.flatten(F.transform("known", with_gap)).alias("train"), "last", "pack")


def series_report(series, least=fitting.ARIMA_DAYS):
    """Length and demand of each series, and why one cannot be fitted."""
    found = series.groupBy("series_key").agg(
        F.min("ds").alias("first_day"), F.count(F.lit(1)).alias("days"), F.sum("y").alias("volume"),
        F.count_if(F.col("y") > 0).alias("active_days"), F.max("y").alias("largest_day"))
    return found.withColumn("reason", F.when(
        F.col("days") < least, F.lit(f"fewer than {least} days")))


def holdout_split(series, days=30):
    """Mark the last ``days`` days of each series (T4)."""
    last = F.max("ds").over(W.partitionBy("series_key"))
    return series.withColumn("is_holdout", F.col("ds") > F.date_sub(last, days))


def average_backtest(split, days=7):
    """Mean of the previous days, one step ahead, over the holdout (T5)."""
    before = W.partitionBy("series_key").orderBy("ds").rowsBetween(-days, -1)
    return (split.withColumn("predicted", F.avg("y").over(before)).filter("is_holdout")
            .select("series_key", F.lit(AVERAGE).alias("model"), "ds",
                    F.col("y").cast("double").alias("y"), "predicted"))


def _arrays(split):
    """One row per series: training values, and the holdout days with theirs, in order."""
    day = F.struct("ds", F.col("y").cast("double").alias("y"))
    return split.groupBy("series_key").agg(
        F.array_sort(F.collect_list(F.when(~F.col("is_holdout"), day)))["y"].alias("train"),
        F.array_sort(F.collect_list(F.when(F.col("is_holdout"), day))).alias("test"))


SMOOTHING_NAMES, ARIMA_NAMES = ("alpha", "beta", "gamma"), ("phi", "theta", "sphi", "stheta")


def packed(series):
    """Series (series_key, train, others) with the ``pack`` in which a task fits them together."""
    sizes = series.select("series_key", (F.size("train") + 1).alias("size"))
    return in_packs(series, sizes, "series_key", PACK_VALUES)


def fitted(series, model, params=None):
    """Series (series_key, train) with parameters ``p`` and the ``state`` after the last day.

    Parameters of least squared error, or the given ones. A fit takes whole series in packs of about
    equal work, and a pack in numpy arrays. Where the series is too short both are null.
    """
    smooth = model == SMOOTHING
    names = SMOOTHING_NAMES if smooth else ARIMA_NAMES
    if params is not None:
        run = seasonal.smoothing if smooth else seasonal.arima
        held = series.withColumn("p", F.struct(*[F.lit(float(v)).alias(n)
                                                 for n, v in zip(names, params)]))
        return held.withColumn("state", run(F.col("train"), F.col("p")))
    dealt = series if "pack" in series.columns else packed(series)
    kind = fitting.SMOOTHING_FIT if smooth else fitting.ARIMA_FIT
    found = dealt.mapInArrow(
        partial(fitting.fit_packs, arima=not smooth),
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
        + f", fit {kind}")
    rest = ("level", "trend", "season", "sse") if smooth else ("w", "e", "sse", "spread")

    def part(fields):
        return F.when(F.col("fit").isNotNull(), F.struct(*[F.col("fit")[n].alias(n) for n in fields]))

    return found.select(*[c for c in series.columns if c != "pack"], part(names).alias("p"), part(rest).alias("state"))


def model_backtest(split, models=(SMOOTHING, ARIMA), params=None):
    """Multi-step holdout predictions of the seasonal models.

    ``params`` fixes the smoothing parameters instead of fitting them. A series that is too short
    for a model keeps its days, with a null prediction and a reason.
    """
    rows, parts = _arrays(split), []
    if params is None and {SMOOTHING, ARIMA} & set(models):
        rows = packed(rows)
    days = F.size("test")
    for model in models:
        if model == AVERAGE:
            made = rows.withColumn("path", seasonal.average_path(F.col("train"), days))
            least = 1
        elif model == SMOOTHING:
            least = seasonal.SMOOTHING_DAYS
            made = fitted(rows, model, params).withColumn(
                "path", F.transform("test", lambda _, i: seasonal.smoothing_ahead(
                    F.col("state"), i + 1)))
        else:
            least = seasonal.ARIMA_DAYS
            made = fitted(rows, model).withColumn("path", seasonal.arima_path(
                F.col("state"), F.col("p"), F.col("train"), days))
        parts.append(made.where(days > 0).select(
            "series_key", "train", "path", F.posexplode("test").alias("at", "day")).select(
            "series_key", F.lit(model).alias("model"), "day.ds", "day.y",
            F.get("path", "at").alias("predicted"),
            F.when(F.size("train") < least, F.lit(f"fewer than {least} training days"))
            .alias("reason")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def forecast_demand(series, horizon=30, params=None):
    """Forecast after the last day with a 95 % band, as whole numbers, by smoothing.

    Additive smoothing with fixed ``params``, or with those of least squared error. The band comes
    from the one-step errors and widens with the distance; its lower end is not below 0. A series
    that is too short has null forecasts and a reason.
    """
    whole = series.groupBy("series_key").agg(
        F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y"))))["y"]
        .alias("train"), F.max("ds").alias("last"))
    step = F.col("step")
    made = fitted(whole, SMOOTHING, params).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    mean = seasonal.smoothing_ahead(F.col("state"), step)
    reach = seasonal.NORMAL_95 * seasonal.smoothing_spread(
        F.col("state"), F.col("p"), F.size("train"), step)

    def whole_number(value):
        return F.round(value).cast("bigint")

    # greatest() passes over nulls, so that a missing forecast needs its own case.
    return made.select(
        "series_key", F.date_format(F.date_add("last", step), "yyyy-MM-dd").alias("forecast_date"),
        whole_number(mean).alias("predicted_demand"),
        F.when(mean.isNotNull(), whole_number(F.greatest(mean - reach, F.lit(0.0))))
        .alias("lower_ci_95"), whole_number(mean + reach).alias("upper_ci_95"),
        F.when(F.col("state").isNull(), F.lit(
            f"fewer than {seasonal.SMOOTHING_DAYS} days")).alias("reason"))


def forecast_arima(series, horizon=30, params=None):
    """Forecast after the last day by a seasonal ARIMA fitted to the whole series.

    ``series`` has a row per day, or one per series as :func:`intermittent_series` gives.
    ``params`` gives the parameters instead. The 95 % band comes from the mean square of the residuals
    after the first eight and the summed squares of the psi weights; otherwise like :func:`forecast_demand`.
    """
    whole = series if "train" in series.columns else series.groupBy("series_key").agg(
        F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y"))))["y"]
        .alias("train"), F.max("ds").alias("last"))
    made = fitted(whole, ARIMA, params)
    path = seasonal.arima_path(F.col("state"), F.col("p"), F.col("train"), F.lit(horizon))
    made = made.withColumns({"path": path, "psi": seasonal.psi_weights(F.col("p"), horizon)})
    step = F.col("step")
    made = made.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    mean = F.get("path", step - 1)
    grown = F.aggregate(F.slice("psi", 1, step), F.lit(0.0), lambda a, x: a + x * x)
    reach = seasonal.NORMAL_95 * F.sqrt(F.col("state.spread") * grown)

    def whole_number(value):
        return F.round(value).cast("bigint")

    return made.select(
        "series_key", F.date_format(F.date_add("last", step), "yyyy-MM-dd").alias("forecast_date"),
        whole_number(mean).alias("predicted_demand"),
        F.when(mean.isNotNull(), whole_number(F.greatest(mean - reach, F.lit(0.0))))
        .alias("lower_ci_95"), whole_number(mean + reach).alias("upper_ci_95"),
        F.when(F.col("state").isNull(), F.lit(f"fewer than {seasonal.ARIMA_DAYS} days"))
        .alias("reason"))


def forecast_errors(predictions):
    """MAE, RMSE and MAPE per series and model."""
    miss = F.col("y") - F.col("predicted")
    return predictions.groupBy("series_key", "model").agg(
        F.round(F.avg(F.abs(miss)), 2).alias("mae"),
        F.round(F.sqrt(F.avg(F.pow(miss, 2))), 2).alias("rmse"),
        F.round(F.avg(F.abs(miss / F.greatest(F.col("y"), F.lit(1.0)))) * 100, 2).alias("mape"))


def forecast_leaderboard(errors):
    """Models of each series from the smallest MAPE up."""
    order = W.partitionBy("series_key").orderBy("mape", "model")
    return errors.withColumn("rank", F.row_number().over(order))
