"""Distribution fits of positive gaps with hierarchical back-off.

Exponential and lognormal fits are closed forms. Gamma and Weibull need iterations, and all four are ranked by their
Kolmogorov-Smirnov statistic, then AIC. A group of any size is first pre-aggregated: equal gaps (to ``digits``) become one row
with a count, and the sums that the closed forms need are partial aggregates; the kernel sees weighted distinct gaps.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import significant
from .transitions import positive, seconds, steps

FIT = "regime string, p1_name string, p1 double, p2_name string, p2 double, sample_count long, status string, ks double, ks_pvalue double, aic double, bic double"


def closed_form(gaps: DataFrame, by: list[str], min_samples: int = 20) -> DataFrame:
    """Exponential rate, lognormal mu and sigma (population) of each group with enough gaps d."""
    g = gaps.where("d > 0").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(1 / F.avg("d"), 6).alias("rate"), F.round(F.avg(F.ln("d")), 6).alias("mu"), F.round(F.stddev_pop(F.ln("d")), 6).alias("sigma"))
    return g.where(F.col("n") >= min_samples)


# ---- kernels


def digamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out -= 1 / x
        x += 1
    y = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


def trigamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return out + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def lower_gamma(a: float, x: np.ndarray) -> np.ndarray:
    """Regularised P(a, x): the series below a + 1, the continued fraction above."""
    out = np.zeros_like(x)
    low = x < a + 1
    scale = np.exp(-x + a * np.log(np.maximum(x, 1e-300)) - math.lgamma(a))
    xs = x[low]
    term = np.full_like(xs, 1 / a)
    total = term.copy()
    for k in range(1, 400):
        term = term * xs / (a + k)
        total += term
        if not len(xs) or term.max() < 1e-15 * total.max():
            break
    out[low] = scale[low] * total
    xs = x[~low]
    b = xs + 1 - a
    c, d = np.full_like(xs, 1e300), 1 / np.maximum(b, 1e-300)
    h = d.copy()
    for k in range(1, 400):
        an = -k * (k - a)
        b = b + 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
    out[~low] = 1 - scale[~low] * h
    return out


def fit_gamma(x: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Newton steps on ln k - digamma(k) = ln(mean) - mean(ln)."""
    n = w.sum()
    mean = (w * x).sum() / n
    s = math.log(mean) - (w * np.log(x)).sum() / n
    k = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(60):
        step = (math.log(k) - digamma(k) - s) / (1 / k - trigamma(k))
        k = max(k - step, k / 2)
        if abs(step) < 1e-12 * k:
            break
    return k, mean / k


def fit_weibull(x: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Bisection of the shape's score equation, which grows with the shape; the scale follows."""
    n, ln = w.sum(), np.log(x)
    top, mean = ln.max(), (w * ln).sum() / n
    def gap(k: float) -> float:
        p = w * np.exp(k * (ln - top))
        return (p * ln).sum() / p.sum() - 1 / k - mean
    lo, hi = 1e-4, 1.0
    while gap(hi) < 0 and hi < 1e6:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if gap(mid) < 0 else (lo, mid)
    k = (lo + hi) / 2
    return k, math.exp(top) * ((w * np.exp(k * (ln - top))).sum() / n) ** (1 / k)


def ks_pvalue(d: float, n: int) -> float:
    """Probability that a one-sample Kolmogorov-Smirnov statistic of n values is d or more.

    Exact (the power of a matrix of Marsaglia, Tsang and Wang) up to 400 values or while the matrix has at most 60 rows; the limit law with a
    correction of order 1 / n beyond.
    """
    if d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    k = int(n * d) + 1
    if 18 < n * d * d:
        return 2 * math.exp(-(2.000071 + 0.331 / math.sqrt(n) + 1.409 / n) * n * d * d)
    if n <= 400 or k <= 30:
        return min(1.0, max(0.0, 1 - _ks_exact(d, n, k)))
    x = d * math.sqrt(n)
    x += 1 / (6 * math.sqrt(n)) + (x - 1) / (4 * n)
    if x < 0.3:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (i - 1) * math.exp(-2 * i * i * x * x) for i in range(1, 101))))


def _ks_exact(d: float, n: int, k: int) -> float:
    """P(D < d): n! / n^n times the middle of the n-th power of a matrix, whose scale is kept apart."""
    m, h = 2 * k - 1, k - n * d
    a = np.tril(np.ones((m, m)), 1)
    rows = np.arange(1, m + 1)
    a[:, 0] -= h ** rows
    a[-1, :] -= h ** rows[::-1]
    a[-1, 0] += (2 * h - 1) ** m if 2 * h > 1 else 0.0
    i, j = np.indices((m, m))
    a /= np.array([float(math.factorial(x)) for x in range(m + 1)])[np.clip(i - j + 1, 0, m)]
    out, scale, shift, p = np.eye(m), 0, 0, n
    while p:
        if p & 1:
            out, scale = out @ a, scale + shift
        a, shift, p = a @ a, 2 * shift, p >> 1
        if a[k - 1, k - 1] > 1e140:
            a, shift = a * 1e-140, shift + 140
        if out[k - 1, k - 1] > 1e140:
            out, scale = out * 1e-140, scale + 140
    return math.exp(math.log(max(out[k - 1, k - 1], 1e-300)) + math.lgamma(n + 1) - n * math.log(n) + scale * math.log(10))


def best_fit(x: np.ndarray, w: np.ndarray, min_samples: int) -> dict:
    """The record of one group: weighted distinct gaps x, ascending."""
    x, w = x.astype(float), w.astype(float)
    good = np.isfinite(x) & (x > 0)
    x, w = x[good], w[good]
    n = int(w.sum())
    none = {"p1_name": None, "p1": None, "p2_name": None, "p2": None, "sample_count": n, "ks": None, "ks_pvalue": None, "aic": None, "bic": None}
    if n < min_samples:
        return none | {"regime": "generic_backoff", "status": "insufficient_samples"}
    if x[-1] - x[0] <= 1e-12:
        return none | {"regime": "deterministic_backoff", "p1_name": "value", "p1": round(float(x[0]), 9), "status": "zero_variance_samples"}
    ln = np.log(x)
    mean, mu = (w * x).sum() / n, (w * ln).sum() / n
    sigma = math.sqrt((w * (ln - mu) ** 2).sum() / n)
    k, theta = fit_gamma(x, w)
    shape, scale = fit_weibull(x, w)
    erf = np.frompyfunc(math.erf, 1, 1)
    found = [
        ("exponential", [("lambda", 1 / mean)], 1 - np.exp(-x / mean), -np.log(mean) - x / mean),
        ("gamma", [("shape", k), ("scale", theta)], lower_gamma(k, x / theta), (k - 1) * ln - x / theta - k * math.log(theta) - math.lgamma(k)),
        ("lognormal", [("mu", mu), ("sigma", sigma)], 0.5 * (1 + erf((ln - mu) / (sigma * math.sqrt(2))).astype(float)), -ln - math.log(sigma * math.sqrt(2 * math.pi)) - (ln - mu) ** 2 / (2 * sigma**2)),
        ("weibull", [("shape", shape), ("scale", scale)], 1 - np.exp(-((x / scale) ** shape)), math.log(shape / scale) + (shape - 1) * np.log(x / scale) - (x / scale) ** shape),
    ]
    upto = np.cumsum(w)
    out = []
    for name, params, cdf, logpdf in found:
        ks = max(float((upto / n - cdf).max()), float((cdf - (upto - w) / n).max()))
        likelihood = float((w * np.maximum(logpdf, math.log(1e-300))).sum())
        aic, bic = 2 * len(params) - 2 * likelihood, math.log(n) * len(params) - 2 * likelihood
        (a, p), (b, q) = params[0], (params[1] if len(params) > 1 else (None, None))
        out.append({"regime": name, "p1_name": a, "p1": round(p, 9), "p2_name": b, "p2": None if q is None else round(q, 9), "sample_count": n, "status": "fitted", "ks": round(ks, 9), "ks_pvalue": round(ks_pvalue(ks, n), 9), "aic": round(aic, 6), "bic": round(bic, 6)})
    return min(out, key=lambda r: (r["ks"], r["aic"]))


def fit_groups(gaps: DataFrame, by: list[str], min_samples: int = 20, digits: int = 6) -> DataFrame:
    """The best fit of each group's gaps d, rounded to ``digits`` significant digits and counted before they meet. So a group, however many gaps
    it has, brings its task at most 900,000 points for each power of ten its gaps span."""
    g = gaps.groupBy(*by, significant(F.col("d"), digits).alias("d")).agg(F.count(F.lit(1)).alias("w"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("d")
        return pd.DataFrame([{c: pdf[c].iloc[0] for c in by} | best_fit(pdf["d"].to_numpy(), pdf["w"].to_numpy(), min_samples)])[[*by, *[f.split()[0] for f in FIT.split(", ")]]]

    kinds = dict(g.dtypes)
    return g.groupBy(*by).applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in by) + ", " + FIT)


def calibrate(events: DataFrame, min_samples: int = 20) -> DataFrame:
    """Each transition's own fit, or the first usable of its source type's and the domain's, and where it came from.

    A constant gap is usable. Where nothing is, the (empty) generic fit stays.
    """
    gaps = positive(steps(events)).select(F.col("a").alias("source"), F.col("b").alias("target"), seconds(F.col("ab")).alias("d"), F.lit(0).alias("all"))
    usable = lambda c: ~F.col(c).isin("", "generic_backoff")
    cols = [f.split()[0] for f in FIT.split(", ")]
    t = fit_groups(gaps, ["source", "target"], min_samples)
    s = fit_groups(gaps, ["source"], min_samples).select("source", F.struct(*cols).alias("s"))
    a = fit_groups(gaps, ["all"], min_samples).select(F.struct(*cols).alias("a"))
    j = t.select("source", "target", F.struct(*cols).alias("t")).join(s, "source", "left").crossJoin(a)  # a is one row
    pick = F.when(usable("t.regime"), F.struct(F.lit("transition").alias("o"), F.col("t").alias("f"))).when(F.coalesce(usable("s.regime"), F.lit(False)), F.struct(F.lit("event_type").alias("o"), F.col("s").alias("f"))).when(usable("a.regime"), F.struct(F.lit("domain").alias("o"), F.col("a").alias("f"))).otherwise(F.struct(F.lit("generic").alias("o"), F.col("t").alias("f")))
    return j.withColumn("p", pick).select("source", "target", F.col("p.o").alias("backoff_source"), F.col("t.regime").alias("raw_regime"), F.col("p.f.*"))


def backoff_levels(events: DataFrame, min_samples: int) -> DataFrame:
    """Which level a transition's fit comes from, by sample counts and spread alone: what the fits' usability comes down to."""
    gaps = positive(steps(events)).select(F.col("a").alias("source"), F.col("b").alias("target"), F.col("ab"))
    t = gaps.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))
    s = t.groupBy("source").agg(F.sum("n").alias("ns"))
    a = t.agg(F.sum("n").alias("na"))
    pick = F.when(F.col("n") >= min_samples, "transition").when(F.col("ns") >= min_samples, "event_type").when(F.col("na") >= min_samples, "domain").otherwise("generic")
    return t.join(s, "source").crossJoin(a).select("source", "target", "n", pick.alias("backoff_source"))
