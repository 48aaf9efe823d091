"""Running totals, quantiles, samples, ranking metrics and forecasts against brute force."""

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketlens.functions import fitting, seasonal
from basketlens.functions.packing import packs
from basketlens.functions.prefix import exact_quantiles, running_totals, smallest_n
from basketlens.operators import forecasting, metrics


def test_running_totals_cross_chunks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"),
                                  F.floor(F.col("id") / 7).alias("chunk"))
    found = running_totals(df, ["k"], "chunk", ["o"], {"total": F.col("o")})
    for k in range(3):
        got = [r["total"] for r in found.filter(F.col("k") == k).orderBy("o").collect()]
        assert got == list(np.cumsum(np.arange(k, 1000, 3)))


@pytest.mark.parametrize("cells", [1, 4, 65536])
def test_quantiles_match_numpy(spark, cells):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.round(rng.normal(size=300), 1), np.full(150, 2.0), [1e6]])
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(values)],
                               "g int, v double")
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    found = {(r["g"], r["prob"]): r["quantile"]
             for r in exact_quantiles(df, ["g"], "v", probs, cells).collect()}
    for g in (0, 1):
        for p in probs:
            assert found[(g, p)] == pytest.approx(np.quantile(values[g::2], p))


def test_quantile_of_constant_and_whole_table(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert exact_quantiles(df, [], "v", [0.5]).collect()[0]["quantile"] == 5.0


@pytest.mark.parametrize("cells", [1, 16, 65536])
def test_smallest_n_is_exact(spark, cells):
    df = spark.range(1000).withColumn("s", F.pmod(F.col("id") * 37, F.lit(1000)) / 1000.0)
    found = [r["id"] for r in smallest_n(df, F.col("s"), 123, ["id"], cells).collect()]
    wanted = sorted(range(1000), key=lambda i: i * 37 % 1000)[:123]
    assert sorted(found) == sorted(wanted)


def brute_auc(target, score):
    pos = [s for t, s in zip(target, score) if t]
    neg = [s for t, s in zip(target, score) if not t]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(target, score):
    total, last, area = sum(target), 0.0, 0.0
    for cut in sorted(set(score), reverse=True):
        flagged = [t for t, s in zip(target, score) if s >= cut]
        recall = sum(flagged) / total
        area += (recall - last) * sum(flagged) / len(flagged)
        last = recall
    return area


def scored(spark, target, score, model="m"):
    return spark.createDataFrame([(model, int(t), float(s)) for t, s in zip(target, score)],
                                 "model string, target int, score double")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 6)), min_size=3, max_size=40))
def test_ranking_metrics_match_brute_force(spark, pairs):
    target, score = [int(t) for t, _ in pairs], [s / 6 for _, s in pairs]
    row = metrics.ranking_metrics(scored(spark, target, score)).collect()[0]
    if 0 < sum(target) < len(target):
        assert row["roc_auc"] == pytest.approx(brute_auc(target, score), abs=6e-5)
    else:
        assert row["roc_auc"] is None
    if sum(target):
        assert row["pr_auc"] == pytest.approx(brute_ap(target, score), abs=6e-5)


def test_auc_equals_the_full_curve_of_spark(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(5)
    score = rng.random(2000).round(3)
    target = (rng.random(2000) < score).astype(int)
    df = scored(spark, target, score)
    curve = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target", numBins=0)
    assert metrics.ranking_metrics(df).collect()[0]["roc_auc"] == pytest.approx(
        curve.evaluate(df), abs=6e-5)


def test_threshold_metrics_with_one_class(spark):
    row = metrics.threshold_metrics(scored(spark, [0, 0], [0.1, 0.9]), 0.5).collect()[0]
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)
    assert (row["fp"], row["tn"]) == (1, 1)


def test_sweep_equals_single_thresholds(spark):
    df = scored(spark, [1, 0, 1, 1, 0, 0], [0.1, 0.1, 0.3, 0.55, 0.5, 0.2])
    swept = {r["threshold"]: (r["precision"], r["recall"], r["f1_score"])
             for r in metrics.threshold_sweep(df).collect()}
    for t, found in swept.items():
        row = metrics.threshold_metrics(df, t).collect()[0]
        assert found == (row["precision"], row["recall"], row["f1_score"])


# --- forecasts ---------------------------------------------------------------------------

def weekly(n, slope=0.5, noise=0.0, seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 100 + slope * t + 10 * np.sin(2 * np.pi * t / 7) + noise * rng.normal(size=n)


def loop_smoothing(y, alpha, beta, gamma, start, horizon):
    level, trend, season = start[0], start[1], list(start[2:])
    for t, v in enumerate(y):
        old = season[t % 7]
        new = alpha * (v - old) + (1 - alpha) * (level + trend)
        season[t % 7] = gamma * (v - level - trend) + (1 - gamma) * old
        trend = beta * (new - level) + (1 - beta) * trend
        level = new
    return [level + h * trend + season[(len(y) + h - 1) % 7] for h in range(1, horizon + 1)]


def series(spark, values, key="a", start="2025-01-01"):
    return spark.range(len(values)).select(
        F.lit(key).alias("series_key"),
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("ds"),
        F.element_at(F.array(*[F.lit(float(v)) for v in values]),
                     (F.col("id") + 1).cast("int")).alias("y"))



def simple_start(y):
    first, second = np.mean(y[:7]), np.mean(y[7:14])
    return [first, (second - first) / 7, *(np.asarray(y[:7]) - first)]


def backtest(spark, values, model, holdout=30, **fixed):
    split = forecasting.holdout_split(series(spark, values), holdout)
    return forecasting.model_backtest(split, (model,), **fixed).orderBy("ds").toPandas()


def test_smoothing_equals_a_plain_loop(spark):
    y = weekly(60, noise=3)
    wanted = loop_smoothing(y[:50], 0.3, 0.1, 0.2, simple_start(y[:50]), 10)
    found = backtest(spark, y, forecasting.SMOOTHING, 10, params=(0.3, 0.1, 0.2))
    assert found["predicted"].tolist() == pytest.approx(wanted)


def smoothing_error(y, params, start):
    """Squared one-step errors of additive smoothing in the error-correcting form."""
    level, trend, *season = start
    total = 0.0
    for t, v in enumerate(y):
        miss = v - level - trend - season[t % 7]
        level, trend = level + trend + params[0] * miss, trend + params[0] * params[1] * miss
        season[t % 7] += params[2] * miss
        total += miss * miss
    return total


def solved_start(y, params):
    """Starting states of least squared error by brute force: the errors of unit states are linear."""
    def errors(values, start):
        level, trend, *season = start
        found = []
        for t, v in enumerate(values):
            miss = v - level - trend - season[t % 7]
            level, trend = level + trend + params[0] * miss, trend + params[0] * params[1] * miss
            season[t % 7] += params[2] * miss
            found.append(miss)
        return found
    unit = np.array([errors(np.zeros(len(y)), row) for row in np.eye(9)]).T
    return np.linalg.lstsq(-unit, np.array(errors(y, np.zeros(9))), rcond=None)[0]


def test_fitted_smoothing_beats_every_candidate_and_start(spark):
    y = weekly(80, noise=4)
    frame = spark.createDataFrame([("a", y[:50].tolist())], "series_key string, train array<double>")
    fit = forecasting.fitted(frame, forecasting.SMOOTHING).first()
    grid = [(a, b, g) for a in (0.1, 0.3, 0.5, 0.8) for b in (0.01, 0.05, 0.2) for g in (0.05, 0.2, 0.5)]
    best = min(smoothing_error(y[:50], p, simple_start(y[:50])) for p in grid)
    freest = min(smoothing_error(y[:50], p, solved_start(y[:50], p)) for p in grid)
    found = tuple(fit["p"])
    start = solved_start(y[:50], found)
    assert fit["state"]["sse"] == pytest.approx(smoothing_error(y[:50], found, start), rel=1e-6)
    assert fit["state"]["sse"] <= min(best, freest) * (1 + 1e-9)
    level, trend, season = (fit["state"][n] for n in ("level", "trend", "season"))
    ahead = [level + h * trend + season[(h - 1) % 7] for h in range(1, 31)]
    assert backtest(spark, y, forecasting.SMOOTHING)["predicted"].tolist() == pytest.approx(ahead)


def test_smoothing_of_aligned_series_equals_each_alone():
    rng = np.random.default_rng(4)
    many = [weekly(n, noise=5, seed=n) for n in (14, 15, 30, 71, 200)] + [rng.poisson(0.2, 90) * 1.0]
    together = fitting.fit_smoothing(many)
    for i, y in enumerate(many):
        for a, b in zip(together, fitting.fit_smoothing([y])):
            assert a[i] == pytest.approx(b[0], rel=1e-5, abs=1e-5)


def loop_arima(y, params, horizon):
    """Squared errors and forecasts of the (1,1,1)(1,1,1)_7 recursion, term by term."""
    phi, theta, sphi, stheta = params
    y = list(y)
    w = [y[t] - y[t - 1] - y[t - 7] + y[t - 8] for t in range(8, len(y))]
    e = []

    def at(values, t):
        return values[t] if t >= 0 else 0.0

    def expected(t):
        return (phi * at(w, t - 1) + sphi * at(w, t - 7) - phi * sphi * at(w, t - 8)
                + theta * at(e, t - 1) + stheta * at(e, t - 7) + theta * stheta * at(e, t - 8))

    for t in range(len(w)):
        e.append(w[t] - expected(t))
    total = sum(x * x for x in e)
    for t in range(len(w), len(w) + horizon):
        step = expected(t)
        y.append(step + y[-1] + y[-7] - y[-8])
        w.append(step)
        e.append(0.0)
    return total, y[-horizon:]


ARIMA_GRID = [(p, q, sp, sq) for p in (-0.8, -0.4, 0.0, 0.4, 0.8) for q in (-0.8, -0.4, 0.0, 0.4, 0.8)
              for sp in (-0.8, -0.4, 0.0, 0.4, 0.8) for sq in (-0.8, -0.4, 0.0, 0.4, 0.8)]


def test_arima_equals_a_plain_loop(spark):
    y = weekly(90, noise=5)
    frame = spark.createDataFrame([("a", y[:60].tolist())], "series_key string, train array<double>")
    fit = forecasting.fitted(frame, forecasting.ARIMA).first()
    error, wanted = loop_arima(y[:60], tuple(fit["p"]), 30)
    assert fit["state"]["sse"] == pytest.approx(error)
    assert backtest(spark, y, forecasting.ARIMA)["predicted"].tolist() == pytest.approx(wanted)
    given = forecasting.fitted(frame, forecasting.ARIMA, tuple(fit["p"])).first()["state"]
    for name in ("w", "e", "sse", "spread"):
        assert given[name] == pytest.approx(fit["state"][name])


def test_a_fit_undoes_few_factors(monkeypatch):
    """The grid of starts shares its inverted factors, and so do a descent's errors and derivatives."""
    done, undo = [], fitting._undone

    def counted(values, *args):
        done.append(values.size)
        return undo(values, *args)

    monkeypatch.setattr(fitting, "_undone", counted)
    monkeypatch.setattr(fitting, "descended", lambda model, points, *args: (points, np.arange(len(points)) * 1.0))
    y = weekly(90, noise=5)
    fitting.fit_arima([y])
    assert sum(done) <= 14 * (len(y) - 8)
    done.clear()
    fitting.arima_slopes(fitting.differenced(y[None]), np.full((1, 4), 0.4))
    assert sum(done) <= 4 * (len(y) - 8)


def test_the_grid_and_the_slopes_equal_the_errors():
    w = fitting.differenced(np.stack([weekly(90, noise=5), np.r_[np.zeros(20), weekly(70, noise=9)]]))
    grid = fitting._grid(fitting.ARIMA_STARTS)
    plain = [(fitting.arima_errors(w, np.tile(p, (2, 1))) ** 2).sum(-1) for p in grid]
    assert fitting.arima_grid(w) == pytest.approx(np.stack(plain, 1))
    point = np.array([[0.3, -0.7, 0.5, -0.98], [-0.2, 0.9, 0.1, 0.4]])
    errors, slopes = fitting.arima_slopes(w, point)
    assert errors == pytest.approx(fitting.arima_errors(w, point))
    for i, unit in enumerate(np.eye(4) * 1e-6):
        near = (fitting.arima_errors(w, point + unit) - fitting.arima_errors(w, point - unit)) / 2e-6
        assert slopes[:, i] == pytest.approx(near, rel=1e-5, abs=1e-5 * np.abs(near).max())


def simulated(known, n, seed):
    phi, theta, sphi, stheta = known
    e, w, y = np.random.default_rng(seed).normal(size=n), np.zeros(n), np.zeros(n)
    for t in range(8, n):
        w[t] = (phi * w[t - 1] + sphi * w[t - 7] - phi * sphi * w[t - 8] + e[t]
                + theta * e[t - 1] + stheta * e[t - 7] + theta * stheta * e[t - 8])
        y[t] = w[t] + y[t - 1] + y[t - 7] - y[t - 8]
    return y


def test_arma_recovers_known_parameters(spark):
    known = [(0.6, 0.2, 0.5, -0.3), (-0.5, -0.4, 0.2, -0.7), (0.3, -0.8, -0.4, -0.5)]
    frame = spark.createDataFrame([(str(i), simulated(k, 4000, i + 7).tolist()) for i, k in enumerate(
        known)], "series_key string, train array<double>")
    found = forecasting.fitted(frame, forecasting.ARIMA).orderBy("series_key").collect()
    for row, wanted in zip(found, known):
        assert list(row["p"]) == pytest.approx(wanted, abs=0.05)


def test_arima_beats_the_grid_on_every_series():
    rng = np.random.default_rng(2)
    many = [simulated((0.5, -0.4, 0.3, -0.6), 300, 1), weekly(200, noise=8), weekly(28, noise=3),
            rng.poisson(0.05, 400) * 1.0, np.zeros(60), np.cumsum(rng.normal(size=150)),
            np.concatenate([[500.0], rng.poisson(3, 100)])]
    points, errors, *_ = fitting.fit_arima(many)
    for y, point, error in zip(many, points, errors):
        best = min(loop_arima(y, p, 0)[0] for p in ARIMA_GRID)
        assert error <= best * 1.001 + 1e-9
        assert loop_arima(y, tuple(point), 0)[0] == pytest.approx(error)


def test_packs_hold_whole_series_of_like_length_and_equal_work(spark):
    rng = np.random.default_rng(6)
    sizes = [(i, int(n)) for i, n in enumerate(rng.integers(1, 100, 3000))] + [(3000, 4000)]
    found, count = packs(spark.createDataFrame(sizes, "k long, size int"), "k", 5000)
    work, length = {}, dict(sizes)
    for row in found.collect():
        work.setdefault(row["pack"], []).append(length[row["k"]])
    assert sum(map(len, work.values())) == 3001 and len(work) <= count
    full = [sum(w) for p, w in sorted(work.items())][:-1]
    assert all(4800 <= w <= 5200 for w in full[:-1])
    order = sorted(work)
    assert all(max(work[a]) <= min(work[b]) for a, b in zip(order, order[1:]))


def test_forecasts_by_product_equal_each_alone(spark):
    rng = np.random.default_rng(9)
    lengths = [200, 20, 28, 75, 400] * 6
    made = {str(i): rng.poisson(0.3, n) * 1.0 for i, n in enumerate(lengths)}
    days = series(spark, [0.0], "x").limit(0)
    frame = spark.createDataFrame(
        [(k, y.tolist()) for k, y in made.items()], "series_key string, ys array<double>").select(
        "series_key", F.posexplode("ys").alias("t", "y")).select(
        "series_key", F.date_add(F.lit("2025-01-01").cast("date"), F.col("t")).alias("ds"), "y")
    found = forecasting.forecast_arima(days.unionByName(frame), 5).collect()
    assert len(found) == 5 * len(made)
    for row in found:
        y = made[row["series_key"]]
        if len(y) < 28:
            assert row["reason"] == "fewer than 28 days" and row["predicted_demand"] is None
            continue
        points = fitting.fit_arima([y])[0][0]
        assert row["reason"] is None
        ahead = loop_arima(y, tuple(points), 5)[1]
        step = (np.datetime64(row["forecast_date"]) - np.datetime64("2025-01-01")).astype(int) - len(y)
        assert abs(row["predicted_demand"] - ahead[step]) <= 0.51


def test_days_without_orders_are_zero_to_the_end(spark):
    both = series(spark, [1, 2, 3]).where("y <> 2").unionByName(series(spark, [4], "b", "2025-01-05"))
    found = forecasting.intermittent_days(both)
    assert rows(found.where("series_key = 'a'"), "y") == [(0.0,), (0.0,), (0.0,), (1.0,), (3.0,)]
    report = forecasting.series_report(found, 5).orderBy("series_key").collect()
    assert [(r["days"], r["volume"], r["active_days"], r["reason"]) for r in report] == [
        (5, 4.0, 2, None), (1, 4.0, 1, "fewer than 5 days")]


def test_psi_weights_equal_an_impulse_response(spark):
    p = F.struct(*[F.lit(v).alias(n) for n, v in zip(
        forecasting.ARIMA_NAMES, (0.5, -0.4, 0.3, -0.2))])
    w, y = np.zeros(30), np.zeros(30)
    for t in range(8, 30):
        shock = [float(t - lag == 8) for lag in (0, 1, 7, 8)]
        w[t] = (0.5 * w[t - 1] + 0.3 * w[t - 7] - 0.15 * w[t - 8]
                + np.dot(shock, (1, -0.4, -0.2, 0.08)))
        y[t] = w[t] + y[t - 1] + y[t - 7] - y[t - 8]
    found = spark.range(1).select(seasonal.psi_weights(p, 22).alias("psi")).first()["psi"]
    assert found == pytest.approx(y[8:].tolist())


def test_arima_forecast_refits_the_whole_series(spark):
    y = weekly(60, noise=3)
    both = series(spark, y).unionByName(series(spark, [3, 4, 5], "b"))
    found = forecasting.forecast_arima(both, 10).orderBy("series_key", "forecast_date").toPandas()
    a, b = found[found["series_key"] == "a"], found[found["series_key"] == "b"]
    best = min(loop_arima(y, p, 1)[0] for p in ARIMA_GRID)
    frame = spark.createDataFrame([("a", [float(v) for v in y])],
                                  "series_key string, train array<double>")
    fit = forecasting.fitted(frame, forecasting.ARIMA).first()
    assert fit["state"]["sse"] <= best
    assert a["predicted_demand"].tolist() == pytest.approx(
        loop_arima(y, tuple(fit["p"]), 10)[1], abs=0.51)
    width = (a["upper_ci_95"] - a["lower_ci_95"]).tolist()
    assert width[-1] > width[0] and set(b["reason"]) == {"fewer than 28 days"}
    assert b["predicted_demand"].isna().all() and len(b) == 10


def test_average_runs_over_its_own_predictions(spark):
    y = weekly(50)
    values = list(y[:20])
    for _ in range(30):
        values.append(np.mean(values[-7:]))
    found = backtest(spark, y, forecasting.AVERAGE)
    assert found["predicted"].tolist() == pytest.approx(values[20:])


def test_forecast_band_widens_and_is_not_negative(spark):
    both = series(spark, weekly(120, noise=2)).unionByName(
        series(spark, weekly(100, slope=0, noise=2) - 100, "b"))
    found = forecasting.forecast_demand(both).orderBy("series_key", "forecast_date").toPandas()
    assert len(found) == 60 and (found["lower_ci_95"] >= 0).all()
    a = found[found["series_key"] == "a"]
    width = (a["upper_ci_95"] - a["lower_ci_95"]).to_numpy()
    assert width[-1] > width[0]
    assert a["forecast_date"].iloc[0] == "2025-05-01"


def test_a_short_series_is_kept_with_a_reason(spark):
    found = forecasting.forecast_demand(series(spark, [3, 4, 5])).collect()
    assert len(found) == 30
    assert {(r["predicted_demand"], r["lower_ci_95"], r["reason"]) for r in found} == {
        (None, None, "fewer than 14 days")}
    held = backtest(spark, [5] * 20, forecasting.SMOOTHING)
    assert len(held) == 20 and held["predicted"].isna().all()
    assert set(held["reason"]) == {"fewer than 14 training days"}
    assert set(backtest(spark, [5] * 50, forecasting.ARIMA)["reason"]) == {
        "fewer than 28 training days"}


def test_fill_days_carries_the_last_value(spark):
    df = series(spark, [1, 2, 3, 4, 5]).filter("y not in (2, 3)")
    assert [r["y"] for r in forecasting.fill_days(df).orderBy("ds").collect()] == [1, 1, 1, 4, 5]


def test_average_backtest_and_errors(spark):
    values = [7] * 10 + [14, 0]
    split = forecasting.holdout_split(series(spark, values), 2)
    found = forecasting.average_backtest(split)
    assert rows(found, "y", "predicted") == [(0.0, 8.0), (14.0, 7.0)]
    error = forecasting.forecast_errors(found).collect()[0]
    assert (error["mae"], error["mape"]) == (7.5, 425.0)


def test_backtest_covers_every_series_and_model(spark):
    both = series(spark, weekly(90)).unionByName(series(spark, weekly(80), "b"))
    found = forecasting.model_backtest(
        forecasting.holdout_split(both),
        (forecasting.SMOOTHING, forecasting.ARIMA, forecasting.AVERAGE))
    assert found.groupBy("series_key", "model").count().filter("count = 30").count() == 6


def test_timeline_sums_gaps_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(forecasting, "ORDERS_PER_CHUNK", 3)
    orders = spark.range(1, 11).select(
        F.col("id").alias("order_id"), F.lit(1).alias("user_id"), F.col("id").alias("order_number"),
        F.col("id").cast("double").alias("days_since_prior_order"))
    found = forecasting.order_timeline(orders)
    assert [r["cumulative_days"] for r in found.orderBy("order_number").collect()] == list(
        np.cumsum(np.arange(1, 11)))
