"""Weekly seasonal models with given parameters, as SQL recursions over a series' ordered values.

A series has one value per day, so its array is bounded by the calendar. All functions take and
return columns. Parameters come from a caller or from ``functions/fitting.py``.
"""

from pyspark.sql import functions as F

from basketlens.functions.fitting import ARIMA_DAYS, SEASON, SMOOTHING_DAYS

NORMAL_95 = 1.959964
_SMOOTHING = "struct<level:double,trend:double,season:array<double>,sse:double>"
_ARIMA = "struct<w:array<double>,e:array<double>,sse:double,late:double,n:int>"
_AHEAD = "struct<w:array<double>,e:array<double>,y:array<double>,out:array<double>>"


def _mean(values):
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def _shifted(values, new):
    """The array without its first element and with ``new`` at its end."""
    return F.concat(F.slice(values, 2, F.size(values) - 1), F.array(new))


def smoothing(values, params):
    """Final level, trend, season (the next day's first) and squared one-step errors.

    ``params`` is a struct alpha, beta, gamma. The first two weeks give the starting states.
    """
    week = F.slice(values, 1, SEASON)
    first = _mean(week)
    start = F.struct(
        first.alias("level"),
        ((_mean(F.slice(values, SEASON + 1, SEASON)) - first) / SEASON).alias("trend"),
        F.transform(week, lambda x: x - first).alias("season"), F.lit(0.0).alias("sse"))

    def step(s, y):
        old, ahead = s["season"][0], s["level"] + s["trend"]
        miss = y - ahead - old
        alpha, beta, gamma = params["alpha"], params["beta"], params["gamma"]
        return F.struct((ahead + alpha * miss).alias("level"),
                        (s["trend"] + alpha * beta * miss).alias("trend"),
                        _shifted(s["season"], old + gamma * miss).alias("season"),
                        (s["sse"] + miss * miss).alias("sse")).cast(_SMOOTHING)

    return F.when(F.size(values) >= SMOOTHING_DAYS,
                  F.aggregate(values, start.cast(_SMOOTHING), step))


def smoothing_ahead(state, step):
    """Forecast ``step`` days after the last value."""
    place = F.pmod(step - 1, F.lit(SEASON)).cast("int")
    return state["level"] + step * state["trend"] + F.get(state["season"], place)


def smoothing_spread(state, params, days, step):
    """Standard error ``step`` days ahead, from the one-step errors of ``days`` values."""
    alpha, beta, gamma = params["alpha"], params["beta"], params["gamma"]

    def weight(j):
        share = alpha + alpha * beta * j + F.when(F.pmod(j, F.lit(SEASON)) == 0, gamma).otherwise(
            F.lit(0.0))
        return share * share

    past = F.when(step > 1, F.aggregate(F.sequence(F.lit(1), (step - 1).cast("int")), F.lit(0.0),
                                        lambda a, j: a + weight(j))).otherwise(F.lit(0.0))
    return F.sqrt(state["sse"] / days * (1 + past))


def differences(values):
    """(1 - B)(1 - B^7) of the values."""
    return F.transform(
        F.sequence(F.lit(SEASON + 1), F.size(values) - 1),
        lambda i: F.get(values, i) - F.get(values, i - 1) - F.get(values, i - SEASON)
        + F.get(values, i - SEASON - 1))


def _next(s, p):
    """Expected difference after the last eight differences and errors, the latest last."""
    return (p["phi"] * s["w"][7] + p["sphi"] * s["w"][1] - p["phi"] * p["sphi"] * s["w"][0]
            + p["theta"] * s["e"][7] + p["stheta"] * s["e"][1]
            + p["theta"] * p["stheta"] * s["e"][0])


def arima(values, params):
    """State of a (1,1,1)(1,1,1)_7 model after all values, and its squared errors.

    ``params`` is a struct phi, theta, sphi, stheta. Terms before the start are 0. ``spread`` is the
    mean square of the errors after the first eight, which still depend on the start.
    """
    zeros = F.array_repeat(F.lit(0.0), SEASON + 1)
    start = F.struct(zeros.alias("w"), zeros.alias("e"), F.lit(0.0).alias("sse"),
                     F.lit(0.0).alias("late"), F.lit(0).alias("n")).cast(_ARIMA)

    def step(s, w):
        miss = w - _next(s, params)
        counted = F.when(s["n"] > SEASON, miss * miss).otherwise(F.lit(0.0))
        return F.struct(_shifted(s["w"], w).alias("w"), _shifted(s["e"], miss).alias("e"),
                        (s["sse"] + miss * miss).alias("sse"), (s["late"] + counted).alias("late"),
                        (s["n"] + 1).alias("n")).cast(_ARIMA)

    def finish(s):
        return F.struct(s["w"].alias("w"), s["e"].alias("e"), s["sse"].alias("sse"),
                        (s["late"] / (s["n"] - SEASON - 1)).alias("spread"))

    return F.when(F.size(values) >= ARIMA_DAYS,
                  F.aggregate(differences(values), start, step, finish))


def arima_path(state, params, values, days):
    """Forecasts of the next ``days`` days as an array."""
    start = F.struct(state["w"].alias("w"), state["e"].alias("e"),
                     F.slice(values, -SEASON - 1, SEASON + 1).alias("y"),
                     F.array().cast("array<double>").alias("out")).cast(_AHEAD)

    def step(s, _):
        w = _next(s, params)
        y = w + s["y"][7] + s["y"][1] - s["y"][0]
        return F.struct(_shifted(s["w"], w).alias("w"), _shifted(s["e"], F.lit(0.0)).alias("e"),
                        _shifted(s["y"], y).alias("y"),
                        F.concat(s["out"], F.array(y)).alias("out")).cast(_AHEAD)

    return F.when(state.isNotNull(), F.aggregate(
        F.sequence(F.lit(1), days), start, step, lambda s: s["out"]))


def psi_weights(params, days):
    """Weights of a shock in the ``days`` values from its own on, as an array."""
    unit = F.concat(F.array_repeat(F.lit(0.0), SEASON), F.array(F.lit(1.0)))
    state = F.struct(unit.alias("w"), unit.alias("e"))
    return F.slice(F.concat(F.array(F.lit(1.0)), arima_path(state, params, unit, F.lit(days))), 1, days)


def average_path(values, days):
    """The mean of seven days carried forward over its own predictions, as an array."""
    start = F.struct(F.slice(values, -F.least(F.size(values), F.lit(SEASON)),
                             SEASON).alias("last"),
                     F.array().cast("array<double>").alias("out")
                     ).cast("struct<last:array<double>,out:array<double>>")

    def step(s, _):
        mean = _mean(s["last"])
        kept = F.when(F.size(s["last"]) < SEASON, s["last"]).otherwise(
            F.slice(s["last"], 2, SEASON - 1))
        return F.struct(F.concat(kept, F.array(mean)).alias("last"),
                        F.concat(s["out"], F.array(mean)).alias("out")).cast(
                            "struct<last:array<double>,out:array<double>>")

    return F.when(F.size(values) > 0, F.aggregate(
        F.sequence(F.lit(1), days), start, step, lambda s: s["out"]))
