"""Customer lifetime models: purchase counts (BG/NBD) and spend (Gamma-Gamma).

After Fader, Hardie & Lee (2005) and Fader & Hardie (2013). The likelihood is a Spark
aggregate; the driver only moves three or four numbers between passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scoring import plain_text
from tidemark.models.base import PREDICTION, Fitted
from tidemark.session import written

# Period lengths in days.
PERIOD_UNITS = {"h": "HOUR", "D": "DAY", "W": "WEEK", "M": "MONTH"}
PERIOD_DAYS = {"h": 1 / 24, "D": 1.0, "W": 7.0, "M": 30.436875}


def rfm_summary(
    df: DataFrame,
    customer: str,
    moment: str,
    monetary: str | None = None,
    freq: str = "D",
    max_t: int = 0,
) -> DataFrame:
    """``(customer, frequency, recency, T, monetary_value)``.

    Frequency counts active periods after the first, recency is first to last, T is
    first to the end of the data (or ``max_t``), monetary value is the mean period
    total after the first period. Purchases are summed per period before a customer's
    periods meet, so a dominant customer is combined early.
    """
    unit, days = PERIOD_UNITS[freq], PERIOD_DAYS[freq]
    period = F.date_trunc(unit, F.col(moment)).cast("timestamp")
    total = F.sum(monetary) if monetary else F.count(F.lit(1))
    per_period = df.groupBy(F.col(customer), period.alias("_period")).agg(total.alias("_total"))
    end = df.agg(F.max(period).alias("end")).first()["end"]

    def periods(start: Column, stop: Column) -> Column:
        return (F.unix_timestamp(stop) - F.unix_timestamp(start)) / (86400 * days)

    summary = per_period.groupBy(customer).agg(
        (F.count(F.lit(1)) - 1).alias("frequency"),
        F.min("_period").alias("_first"),
        F.max("_period").alias("_last"),
        (F.sum("_total") - F.min_by("_total", "_period")).alias("_later"),
    )
    end_moment = F.lit(end.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    age = F.lit(float(max_t)) if max_t > 0 else periods(F.col("_first"), end_moment)
    spend = F.when(
        F.col("frequency") > 0, F.col("_later").cast("double") / F.col("frequency")
    ).otherwise(0.0)
    columns = [
        F.col(customer),
        F.col("frequency"),
        periods(F.col("_first"), F.col("_last")).alias("recency"),
        age.alias("T"),
    ]
    return summary.select(*columns, *([spend.alias("monetary_value")] if monetary else []))


# ---- numerics shared by both models ---------------------------------------------


def log_gamma(z: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive values (Stirling after a shift)."""
    z = np.asarray(z, dtype=float)
    shift = sum(np.log(z + i) for i in range(8))
    y = z + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def hypergeometric(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss series 2F1(a, b; c; z) for 0 <= z < 1; a series that does not settle is an error."""
    term = np.ones_like(z, dtype=float)
    total = term.copy()
    for n in range(100_000):
        term = term * (a + n) * (b + n) / ((c + n) * (n + 1)) * z
        total += term
        if np.all(np.abs(term) <= 1e-15 * np.abs(total)):
            return total
    raise ArithmeticError("the hypergeometric series did not converge")


def bgnbd_log_likelihood(params, x, recency, age):
    r, alpha, a, b = params
    later = np.maximum(x, 1)
    counts = log_gamma(r + x) - log_gamma(np.array(r)) + r * np.log(alpha)
    churn = (
        log_gamma(np.array(a + b)) + log_gamma(b + x) - log_gamma(np.array(b)) - log_gamma(a + b + x)
    )
    alive = -(r + x) * np.log(alpha + age)
    gone = np.log(a) - np.log(b + later - 1) - (r + x) * np.log(alpha + recency)
    return counts + churn + np.logaddexp(alive, np.where(x > 0, gone, -np.inf))


def gammagamma_log_likelihood(params, x, spend):
    p, q, v = params
    return (
        log_gamma(p * x + q) - log_gamma(p * x) - log_gamma(np.array(q))
        + q * np.log(v) + (p * x - 1) * np.log(spend) + p * x * np.log(x)
        - (p * x + q) * np.log(x * spend + v)
    )


def mean_likelihoods(
    df: DataFrame, columns: Sequence[str], likelihood: Callable, points: np.ndarray
) -> np.ndarray:
    """Mean log-likelihood at each parameter vector, all vectors in one pass.

    ``df`` holds ``columns`` and a row ``weight``. Every task returns one partial sum
    per vector.
    """

    def sums(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(len(points)), 0.0
        for block in blocks:
            weight = block["weight"].to_numpy(dtype=float)
            data = [block[c].to_numpy(dtype=float) for c in columns]
            rows += weight.sum()
            for i, params in enumerate(points):
                total[i] += (likelihood(params, *data) * weight).sum()
        yield pd.DataFrame({"point": np.arange(len(points)), "total": total, "rows": rows})

    found = (
        df.select(*columns, "weight")
        .mapInPandas(sums, "point int, total double, rows double")
        .groupBy("point")
        .agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
        .orderBy("point")
        .collect()
    )
    return np.array([r["total"] / r["rows"] for r in found])


def _derivative_points(at: np.ndarray, step: float) -> np.ndarray:
    """The point, its neighbours along each axis, and the four corners of each pair."""
    n = len(at)
    unit = np.eye(n) * step
    points = [at] + [at + s * unit[i] for i in range(n) for s in (1, -1)]
    for i in range(n):
        for j in range(i):
            points += [at + s * unit[i] + t * unit[j] for s in (1, -1) for t in (1, -1)]
    return np.array(points)


def _derivatives(values: np.ndarray, n: int, step: float) -> tuple[np.ndarray, np.ndarray]:
    up, down = values[1 : 2 * n + 1 : 2], values[2 : 2 * n + 1 : 2]
    gradient = (up - down) / (2 * step)
    hessian = np.diag((up - 2 * values[0] + down) / step**2)
    k = 2 * n + 1
    for i in range(n):
        for j in range(i):
            pp, pm, mp, mm = values[k : k + 4]
            hessian[i, j] = hessian[j, i] = (pp - pm - mp + mm) / (4 * step**2)
            k += 4
    return gradient, hessian


def maximise(
    evaluate: Callable[[np.ndarray], np.ndarray],
    start: np.ndarray,
    tolerance: float = 1e-7,
    max_rounds: int = 60,
    step: float = 1e-3,
) -> np.ndarray:
    """Damped Newton ascent where each round costs two passes over the data.

    One pass yields value, gradient and curvature, the second tries several damped
    steps at once and keeps the best. A search that still gains after ``max_rounds`` raises.
    """
    at = np.asarray(start, dtype=float)
    for _ in range(max_rounds):
        values = evaluate(_derivative_points(at, step))
        gradient, hessian = _derivatives(values, len(at), step)
        size, axes = np.linalg.eigh(-hessian)
        slope = axes.T @ gradient
        moves = []
        for damping in (0.0, 1e-4, 1e-2, 1e-1, 1.0, 10.0):
            move = axes @ (slope / np.maximum(np.abs(size) + damping, 1e-8))
            moves.append(move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-300)))
        candidates = at + np.array(moves)
        tried = np.nan_to_num(evaluate(candidates), nan=-np.inf)
        best = int(np.argmax(tried))
        if not tried[best] > values[0]:
            break
        at = candidates[best]
        if tried[best] - values[0] < tolerance:
            break
    else:
        raise ArithmeticError(f"no maximum found in {max_rounds} rounds")
    return at


def _fit(df, columns, likelihood, start, penalizer) -> list[float]:
    """Parameters (positive, fitted as logarithms) that maximise the penalised mean."""

    def evaluate(points: np.ndarray) -> np.ndarray:
        params = np.exp(points)
        return mean_likelihoods(df, columns, likelihood, params) - penalizer * (params**2).sum(axis=1)

    return np.exp(maximise(evaluate, np.log(start))).tolist()


# ---- BG/NBD ---------------------------------------------------------------------


def fit_bgnbd(df, features=None, label=None, **params) -> Fitted:
    """Fit from transactions: ``customer_id_col``, ``datetime_col``, ``freq``, ``max_t``."""
    summary = rfm_summary(
        df, params["customer_id_col"], params["datetime_col"],
        freq=params.get("freq", "D"), max_t=int(params.get("max_t", 0)),
    )
    return fit_bgnbd_summary(summary, float(params.get("penalizer_coef", 0)))


def fit_bgnbd_summary(summary: DataFrame, penalizer: float = 0.0) -> Fitted:
    """Fit from ``frequency, recency, T``; equal rows are merged before the first pass."""
    merged = written(
        summary.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("weight")),
        "bgnbd-summary",
    )
    longest = merged.agg(F.max("T").alias("t")).first()["t"]
    scale = 10 / longest if longest else 1.0
    scaled = merged.withColumns({"recency": F.col("recency") * scale, "T": F.col("T") * scale})
    r, alpha, a, b = _fit(
        scaled, ["frequency", "recency", "T"], bgnbd_log_likelihood, [1.0, 1.0, 1.0, 1.0], penalizer
    )
    meta = {"params": {"r": r, "alpha": alpha / scale, "a": a, "b": b}}
    return Fitted("beta_geometric", None, meta)


def p_alive(params: dict, x: Column, recency: Column, age: Column) -> Column:
    """Probability that a customer is still active."""
    r, alpha, a, b = (params[k] for k in ("r", "alpha", "a", "b"))
    odds = a / (b + x - 1) * F.pow((alpha + age) / (alpha + recency), r + x)
    return F.when(x > 0, 1 / (1 + odds)).otherwise(1.0)


def expected_visits(params: dict, window: Column, x: Column, recency: Column, age: Column) -> Column:
    """Expected number of visits within ``window`` periods from now."""
    r, alpha, a, b = (params[k] for k in ("r", "alpha", "a", "b"))

    @F.pandas_udf("double")
    def growth(t: pd.Series, x: pd.Series, age: pd.Series) -> pd.Series:
        """1 minus the scaled hypergeometric term."""
        t, x, age = (s.to_numpy(dtype=float) for s in (t, x, age))
        z = t / (alpha + age + t)
        series = hypergeometric(r + x, b + x, a + b + x - 1, z)
        return pd.Series(1 - np.exp((r + x) * np.log1p(-z)) * series)

    rate = (a + b + x - 1) / (a - 1)
    return rate * growth(window, x, age) * p_alive(params, x, recency, age)


def _measure(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("measure"), value.alias("value"))


def score_bgnbd(fitted: Fitted, df: DataFrame) -> DataFrame:
    """Visits, activity within the window and overall activity, as named measures.

    Reads ``prediction_window, frequency, recency, T``, all taken as whole numbers.
    """
    params = fitted.meta["params"]
    window, x, recency, age = (
        F.col(c).cast("int").cast("double") for c in ("prediction_window", "frequency", "recency", "T")
    )
    scored = df.withColumns(
        {
            "_visits": expected_visits(params, window, x, recency, age),
            "_unit": expected_visits(params, F.lit(1.0), x, recency, age),
            "_alive": p_alive(params, x, recency, age),
        }
    )

    def text(value: Column) -> Column:
        return plain_text(F.round(value, 4))

    measures = F.array(
        _measure("visits", text(F.col("_visits"))),
        _measure("p_alive", text(1 - F.exp(-F.col("prediction_window") * F.col("_unit")))),
        _measure("p_alive_global", text(F.col("_alive"))),
    )
    return scored.withColumn(PREDICTION, measures).drop("_visits", "_unit", "_alive")


# ---- Gamma-Gamma ----------------------------------------------------------------


def fit_gammagamma(df, features=None, label=None, **params) -> Fitted:
    """Fit from transactions with a positive amount, on returning customers."""
    monetary = params["monetary_value_col"]
    summary = rfm_summary(
        df.filter(F.col(monetary) > 0), params["customer_id_col"], params["datetime_col"],
        monetary, freq=params.get("freq", "D"), max_t=int(params.get("max_t", 0)),
    )
    return fit_gammagamma_summary(summary, float(params.get("penalizer_coef", 0)))


def fit_gammagamma_summary(summary: DataFrame, penalizer: float = 0.0) -> Fitted:
    """Fit from ``frequency, monetary_value``; rows without a repeat purchase are left out."""
    merged = written(
        summary.filter(F.col("frequency") > 0)
        .groupBy("frequency", "monetary_value")
        .agg(F.count(F.lit(1)).alias("weight")),
        "gammagamma-summary",
    )
    # Without a penalty only ``v`` depends on the currency: fit in units of the mean.
    unit = 1.0
    if penalizer == 0:
        unit = merged.agg(F.avg("monetary_value").alias("m")).first()["m"] or 1.0
    scaled = merged.withColumn("monetary_value", F.col("monetary_value") / unit)
    p, q, v = _fit(
        scaled, ["frequency", "monetary_value"], gammagamma_log_likelihood, [1.0, 1.0, 1.0], penalizer
    )
    return Fitted("gamma_gamma", None, {"params": {"p": p, "q": q, "v": v * unit}})


def average_profit(params: dict, x: Column, spend: Column) -> Column:
    """Expected spend per purchase: the customer's own mean drawn toward everyone's."""
    p, q, v = (params[k] for k in ("p", "q", "v"))
    own = p * x / (p * x + q - 1)
    return (1 - own) * (v * p / (q - 1)) + own * spend


def score_gammagamma(fitted: Fitted, df: DataFrame) -> DataFrame:
    profit = average_profit(
        fitted.meta["params"], F.col("frequency"), F.col("monetary_value").cast("double")
    )
    return df.withColumn(PREDICTION, F.array(_measure("avg_profit", profit)))
