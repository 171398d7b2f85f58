"""Special functions NumPy lacks, on arrays inside tasks or on scalars at the driver."""

from __future__ import annotations

import math

import numpy as np

HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


def stirling_rest(x: np.ndarray) -> np.ndarray:
    """``lgamma(x) - ((x - 1/2) log x - x + log(2 pi)/2)`` for positive x.

    The asymptotic series holds from 10 up; smaller arguments are raised to it by the exact recurrence.
    """
    x = np.array(x, dtype=float)
    rest = np.zeros_like(x)
    small = x < 10.0
    while small.any():
        at = x[small]
        rest[small] += (at + 0.5) * np.log1p(1.0 / at) - 1.0
        x[small] = at + 1.0
        small = x < 10.0
    inv = 1.0 / x
    inv2 = inv * inv
    return rest + inv * (1 / 12 - inv2 * (1 / 360 - inv2 * (1 / 1260 - inv2 * (1 / 1680 - inv2 / 1188))))


def log_factorial(y: np.ndarray) -> np.ndarray:
    x = np.asarray(y, dtype=float) + 1.0
    return (x - 0.5) * np.log(x) - x + HALF_LOG_2PI + stirling_rest(x)


def log_rising(y: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """``log prod_{k<y} (1 + k alpha)``, written so that it stays exact as alpha goes to zero."""
    r = 1.0 / alpha
    return (y + r - 0.5) * np.log1p(y * alpha) - y + stirling_rest(y + r) - stirling_rest(r)


def erfc_positive(x: np.ndarray) -> np.ndarray:
    """The complementary error function for x >= 0, to about 1e-15 of its value into the far tail.

    Below one by the power series of erf, above by its continued fraction, evaluated from its end. The square in the
    exponential is split so that its large part is exact.
    """
    x = np.asarray(x, dtype=float)
    out = np.empty_like(x)
    low = x < 1.0
    t = x[low]
    term = t.copy()
    total = t.copy()
    for n in range(1, 30):
        term *= -t * t / n
        total += term / (2 * n + 1)
    out[low] = 1.0 - 2.0 / math.sqrt(math.pi) * total
    t = np.minimum(x[~low], 40.0)
    tail = np.zeros_like(t)
    for n in range(240, 0, -1):
        tail = (n / 2.0) / (t + tail)
    coarse = np.round(t * 16.0) / 16.0
    out[~low] = np.exp(-coarse * coarse) * np.exp(-(t - coarse) * (t + coarse)) / (math.sqrt(math.pi) * (t + tail))
    out[np.isnan(x)] = np.nan
    return out


def two_sided_p(z: np.ndarray) -> np.ndarray:
    return erfc_positive(np.abs(np.asarray(z, dtype=float)) / math.sqrt(2.0))


def trigamma(x: float) -> float:
    total = 0.0
    while x < 20.0:
        total += 1.0 / (x * x)
        x += 1.0
    inv2 = 1.0 / (x * x)
    return total + 1.0 / x + inv2 / 2 + inv2 / x * (1 / 6 - inv2 * (1 / 30 - inv2 * (1 / 42 - inv2 / 30)))


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularized incomplete beta function by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_cdf(1.0 - x, b, a)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    # Modified Lentz evaluation.
    tiny, c, d, value = 1e-300, 1.0, 0.0, 1.0
    for i in range(0, 500):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / (1.0 + term * d or tiny)
        c = 1.0 + term / c or tiny
        value *= c * d
        if abs(1.0 - c * d) < 1e-15:
            break
    return front * (value - 1.0)


def f_quantile(prob: float, d1: float, d2: float) -> float:
    """Quantile of the F distribution by bisection on the beta scale."""
    low, high = 0.0, 1.0
    for _ in range(200):
        mid = 0.5 * (low + high)
        if beta_cdf(mid, d1 / 2.0, d2 / 2.0) < prob:
            low = mid
        else:
            high = mid
    x = 0.5 * (low + high)
    return d2 * x / (d1 * (1.0 - x))


def log_chi2_histogram(df: int, sd: float, edges: np.ndarray) -> np.ndarray:
    """Density histogram of ``log(chi2_df / df) + N(0, sd^2)`` within the edges, by numeric convolution."""
    t = np.linspace(edges[0] - 30.0, edges[-1] + 10.0, 6001)
    # log density of u = log(X / df) for X ~ chi2(df)
    half = df / 2.0
    x = df * np.exp(t)
    density = np.exp(half * np.log(x) - x / 2.0 - half * math.log(2.0) - math.lgamma(half))
    mass = density / density.sum()
    if sd == 0.0:
        hist, _ = np.histogram(t, bins=edges, weights=mass)
    else:
        erf = np.vectorize(math.erf)
        cdf = np.array([np.sum(mass * 0.5 * (1 + erf((e - t) / (sd * math.sqrt(2))))) for e in edges])
        hist = np.diff(cdf)
    return hist / hist.sum() / np.diff(edges)


def local_line(x: np.ndarray, y: np.ndarray, w: np.ndarray, at: np.ndarray, span: float) -> np.ndarray:
    """Local linear regression with tricube weights over the nearest ``span`` share of the points."""
    k = min(len(x), max(2, int(span * len(x) + 1e-7)))
    out = np.empty(len(at))
    for i, a in enumerate(at):
        dist = np.abs(x - a)
        h = max(np.partition(dist, k - 1)[k - 1], 1e-12)
        inside = np.where(dist > 0.999 * h, 0.0, (1 - np.minimum(dist / h, 1.0) ** 3) ** 3)
        inside = np.where(dist <= 0.001 * h, 1.0, inside)
        ww = inside * w
        total = ww.sum()
        mx, my = (ww * x).sum() / total, (ww * y).sum() / total
        spread = (ww * (x - mx) ** 2).sum()
        steep = (ww * (x - mx) * (y - my)).sum() / spread if spread > 1e-6 * (np.ptp(x) ** 2) * total else 0.0
        out[i] = my + steep * (a - mx)
    return out


def lowess(x: np.ndarray, y: np.ndarray, span: float, rounds: int = 3) -> np.ndarray:
    """Robust local regression of a short series: bisquare reweighting of a local line."""
    weight = np.ones(len(x))
    fitted = local_line(x, y, weight, x, span)
    for _ in range(rounds):
        rest = np.abs(y - fitted)
        scale = 6.0 * np.median(rest)
        if scale < 1e-7 * np.mean(rest) or scale == 0.0:
            break
        ratio = rest / scale
        weight = np.where(ratio <= 0.001, 1.0, np.where(ratio > 0.999, 0.0, (1 - np.minimum(ratio, 1) ** 2) ** 2))
        fitted = local_line(x, y, weight, x, span)
    return fitted
