"""Per-gene numeric steps on a batch: arrays of genes x samples, all vectorized over genes.

A batch is what one Arrow record batch holds; Spark decides which genes meet in it and nothing here
depends on that.
"""

from __future__ import annotations

import numpy as np

from exprspark.stats.special import log_factorial, log_rising

# Fixed values of the published method.
MIN_DISPERSION = 1e-8
MIN_MEAN = 0.5
RIDGE = 1e-6 / np.log(2.0) ** 2
MAX_BETA = 30.0 * np.log(2.0)
FIT_TOLERANCE = 1e-8
OTHER_COEFFICIENT_SCALE = 15.0
LOG2E = 1.0 / np.log(2.0)


def max_dispersion(n: int) -> float:
    return max(10.0, float(n))


def information(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``X' W X`` per gene."""
    p = x.shape[1]
    pairs = (x[:, :, None] * x[:, None, :]).reshape(len(x), p * p)
    return (w @ pairs).reshape(len(w), p, p)


def nb_log_likelihood(y, mu, alpha, base=None):
    """Log likelihood per gene; ``base`` holds the part that is free of the means."""
    base = log_rising(y, alpha) - log_factorial(y) if base is None else base
    terms = base + y * np.log(mu) - (y + 1.0 / alpha) * np.log1p(alpha * mu)
    return terms.sum(axis=1)


def adjusted_profile(log_alpha, y, mu, x):
    """Cox-Reid adjusted profile log likelihood of the dispersion, per gene."""
    alpha = np.exp(log_alpha)[:, None]
    curve = log_rising(y, alpha) - (y + 1.0 / alpha) * np.log1p(alpha * mu)
    w = mu / (1.0 + alpha * mu)
    _, logdet = np.linalg.slogdet(information(w, x))
    return curve.sum(axis=1) - 0.5 * logdet


def peak(score, low: float, high: float, genes: int, points: int = 28, rounds: int = 34):
    """Maximum of a function of one value per gene: coarse grid, then golden section around the best point."""
    grid = np.linspace(low, high, points)
    table = np.stack([score(np.full(genes, g)) for g in grid])
    best = np.argmax(table, axis=0)
    a, b = grid[np.maximum(best - 1, 0)], grid[np.minimum(best + 1, points - 1)]
    ratio = (np.sqrt(5.0) - 1) / 2
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    fc, fd = score(c), score(d)
    for _ in range(rounds):
        left = fc > fd
        a, b = np.where(left, a, c), np.where(left, d, b)
        fresh = np.where(left, b - ratio * (b - a), a + ratio * (b - a))
        value = score(fresh)
        c, fc, d, fd = (
            np.where(left, fresh, d), np.where(left, value, fd), np.where(left, c, fresh), np.where(left, fc, value),
        )
    return np.where(fc > fd, c, d)


def linear_means(q, x):
    """Least-squares means of normalized counts."""
    hat = x @ np.linalg.pinv(x)
    return q @ hat.T


def starting_dispersion(q, x, size_factors):
    """The smaller of a regression-based and a moment-based estimate."""
    n, p = x.shape
    mean, var = q.mean(axis=1), q.var(axis=1, ddof=1)
    mu = np.maximum(1.0, linear_means(q, x))
    rough = np.maximum((((q - mu) ** 2 - mu) / mu**2).sum(axis=1) / (n - p), 0.0)
    moments = (var - np.mean(1.0 / size_factors) * mean) / mean**2
    return np.clip(np.minimum(rough, moments), MIN_DISPERSION, max_dispersion(n))


def has_cell_means(x) -> bool:
    """True when the design has as many distinct rows as columns, so group means are its fit."""
    return len(np.unique(x, axis=0)) == x.shape[1]


def genewise_dispersion(y, x, size_factors):
    """Maximum of the adjusted profile likelihood per gene, and the means it was taken at."""
    q = y / size_factors
    if has_cell_means(x):
        mu = np.maximum(linear_means(q, x) * size_factors, MIN_MEAN)
    else:
        mu = fit_means(y, x, size_factors, starting_dispersion(q, x, size_factors))["mu"]
    low, high = np.log(MIN_DISPERSION / 10), np.log(max_dispersion(x.shape[0]))
    found = peak(lambda v: adjusted_profile(v, y, mu, x), low, high, len(y))
    return np.clip(np.exp(found), MIN_DISPERSION, max_dispersion(x.shape[0])), mu


def map_dispersion(y, mu, x, trend, prior_var):
    """Posterior mode of the dispersion under a log-normal prior around the trend."""
    centre = np.log(trend)
    low, high = np.log(MIN_DISPERSION / 10), np.log(max_dispersion(x.shape[0]))
    found = peak(
        lambda v: adjusted_profile(v, y, mu, x) - (v - centre) ** 2 / (2 * prior_var), low, high, len(y)
    )
    return np.clip(np.exp(found), MIN_DISPERSION, max_dispersion(x.shape[0]))


def fit_means(y, x, size_factors, alpha, rounds: int = 100):
    """Log-link regression with known dispersion by reweighted least squares and a tiny ridge.

    Genes leave the loop when their deviance settles. Genes that run off or do not settle get a second,
    damped and bounded run.
    """
    genes, p = len(y), x.shape[1]
    alpha = np.broadcast_to(np.asarray(alpha, dtype=float).reshape(-1, 1), (genes, 1))
    base = log_rising(y, alpha) - log_factorial(y)
    beta = np.log(y / size_factors + 0.1) @ np.linalg.pinv(x).T
    ridge = RIDGE * np.eye(p)
    converged = np.zeros(genes, dtype=bool)

    def means(b):
        return np.maximum(size_factors * np.exp(np.clip(b @ x.T, -700, 700)), MIN_MEAN)

    def run(rows, start, limit, damping, bounded):
        active, b = rows, start
        previous = np.full(len(rows), np.inf)
        for _ in range(limit):
            if not len(active):
                break
            mu = means(b)
            w = mu / (1.0 + alpha[active] * mu)
            z = np.log(mu / size_factors) + (y[active] - mu) / mu
            fresh = np.linalg.solve(information(w, x) + ridge, ((w * z) @ x)[:, :, None])[:, :, 0]
            b = b + damping * (fresh - b)
            b = np.clip(b, -MAX_BETA, MAX_BETA) if bounded else b
            deviance = -2.0 * nb_log_likelihood(y[active], means(b), alpha[active], base[active])
            settled = np.abs(deviance - previous) / (np.abs(deviance) + 0.1) < FIT_TOLERANCE
            lost = np.zeros(len(b), bool) if bounded else (np.abs(b) > 30.0).any(axis=1)
            beta[active] = b
            converged[active[settled & ~lost]] = True
            keep = ~(settled | lost)
            active, b, previous = active[keep], b[keep], deviance[keep]

    run(np.arange(genes), beta.copy(), rounds, 1.0, False)
    rest = np.flatnonzero(~converged)
    if len(rest):
        start = np.zeros((len(rest), p))
        start[:, 0] = np.log(np.maximum((y[rest] / size_factors).mean(axis=1), 0.1))
        run(rest, start, 4 * rounds, 0.5, True)
    mu = means(beta)
    w = mu / (1.0 + alpha * mu)
    info = information(w, x)
    inverse = np.linalg.inv(info + ridge)
    covariance = inverse @ info @ inverse
    hat = w * np.einsum("np,gpq,nq->gn", x, inverse, x)
    return {
        "beta": beta,
        "se": np.sqrt(np.maximum(np.diagonal(covariance, axis1=1, axis2=2), 0.0)),
        "mu": mu,
        "hat": hat,
        "converged": converged,
    }


def trimmed_mean(a, share: float):
    """Mean along the last axis without the lowest and highest ``share`` of the values."""
    cut = int(np.floor(a.shape[-1] * share))
    ordered = np.sort(a, axis=-1)
    return ordered[..., cut: a.shape[-1] - cut].mean(axis=-1)


# Trimming share and scale by replicates (up to 3, up to 23, more).
CELL_TRIM = (1 / 3, 1 / 4, 1 / 8)
CELL_SCALE = (2.04, 1.86, 1.51)
ROBUST_MIN_DISPERSION = 0.04


def robust_dispersion(q, cells):
    """Moment dispersion from trimmed variances, within design cells of three or more replicates."""
    large = [c for c in np.unique(cells) if (cells == c).sum() >= 3]
    if large:
        parts = []
        for c in large:
            own = q[:, cells == c]
            size = 0 if own.shape[1] <= 3 else 1 if own.shape[1] <= 23 else 2
            centre = trimmed_mean(own, CELL_TRIM[size])
            parts.append(CELL_SCALE[size] * trimmed_mean((own - centre[:, None]) ** 2, CELL_TRIM[size]))
        var = np.max(parts, axis=0)
    else:
        centre = trimmed_mean(q, CELL_TRIM[2])
        var = CELL_SCALE[2] * trimmed_mean((q - centre[:, None]) ** 2, CELL_TRIM[2])
    mean = q.mean(axis=1)
    return np.maximum((var - mean) / mean**2, ROBUST_MIN_DISPERSION)


def cooks_distance(y, q, fit, cells, p):
    alpha = robust_dispersion(q, cells)[:, None]
    residual = (y - fit["mu"]) ** 2 / (fit["mu"] + alpha * fit["mu"] ** 2)
    return residual / p * fit["hat"] / (1.0 - fit["hat"]) ** 2


def shrink_coefficient(y, x, size_factors, alpha, coef: int, scale: float, mle, rounds: int = 300):
    """Posterior mode and standard deviation of one coefficient under a Cauchy prior.

    Newton steps on the log posterior; where the Cauchy log density is convex its curvature is replaced
    by the always positive one of its normal mixture, and steps are halved until they climb. The better
    mode of two starts, the unshrunken fit and a zero effect, is kept.
    """
    alpha = np.asarray(alpha, dtype=float).reshape(-1, 1)
    base = log_rising(y, alpha) - log_factorial(y)
    p = x.shape[1]
    normal = np.full(p, 1.0 / OTHER_COEFFICIENT_SCALE**2)
    normal[coef] = 0.0

    def means(b):
        return size_factors * np.exp(np.clip(b @ x.T, -50, 50))

    def posterior(b, rows):
        prior = -0.5 * (normal * b**2).sum(axis=1) - np.log1p((b[:, coef] / scale) ** 2)
        return nb_log_likelihood(y[rows], np.maximum(means(b), 1e-300), alpha[rows], base[rows]) + prior

    def slope_and_curve(b, rows, exact):
        mu, a, yy = means(b), alpha[rows], y[rows]
        slope = ((yy - mu) / (1 + a * mu)) @ x - normal * b
        t = b[:, coef]
        slope[:, coef] -= 2 * t / (scale**2 + t**2)
        curve = information(mu * (1 + a * yy) / (1 + a * mu) ** 2, x) + np.diag(normal)
        cauchy = 2 * (scale**2 - t**2) / (scale**2 + t**2) ** 2
        safe = 2 / (scale**2 + t**2)
        curve[:, coef, coef] += cauchy if exact else np.where(cauchy > 0, cauchy, safe)
        return slope, curve

    def climb(start):
        b = start.copy()
        active = np.arange(len(b))
        for _ in range(rounds):
            if not len(active):
                break
            now = posterior(b[active], active)
            slope, curve = slope_and_curve(b[active], active, False)
            step = np.linalg.solve(curve + 1e-12 * np.eye(p), slope[:, :, None])[:, :, 0]
            length = np.ones(len(active))
            for _ in range(30):
                worse = posterior(b[active] + length[:, None] * step, active) < now - 1e-12 * np.abs(now)
                if not worse.any():
                    break
                length[worse] /= 2
            b[active] += length[:, None] * step
            active = active[np.abs(length[:, None] * step).max(axis=1) > 1e-10]
        return b

    rows = np.arange(len(y))
    flat = mle.copy()
    flat[:, coef] = 0.0
    one, two = climb(mle), climb(flat)
    better = posterior(two, rows) > posterior(one, rows) + 1e-9
    b = np.where(better[:, None], two, one)
    _, curve = slope_and_curve(b, rows, True)
    sd = np.sqrt(np.abs(np.diagonal(np.linalg.inv(curve), axis1=1, axis2=2)))
    return b[:, coef] * LOG2E, sd[:, coef] * LOG2E
