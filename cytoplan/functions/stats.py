"""Column expressions and numpy kernels for count statistics."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den, null for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def robust_divide(num: Column, den: Column) -> Column:
    """num / den, NaN for a zero denominator."""
    return F.when(den == 0, F.lit(float("nan"))).otherwise(F.try_divide(num.cast("double"), den.cast("double")))


def duplicate_fraction(umis: Column, reads: Column) -> Column:
    """1 - umis / reads, both at least one."""
    return 1.0 - F.greatest(umis, F.lit(1)).cast("double") / F.greatest(reads, F.lit(1)).cast("double")


def error_probability(q: Column) -> Column:
    """Of a Phred value that counts up to 33."""
    return F.pow(F.lit(10.0), -F.least(q, F.lit(33)).cast("double") / 10.0)


def effective_diversity(count: Column) -> Column:
    """Inverse Simpson index of the counts of a group."""
    c = count.cast("double")
    return F.try_divide(F.pow(F.sum(c), F.lit(2.0)), F.sum(c * c))


def bh_adjusted(p: Column, by: list[str], tie: str) -> Column:
    """Benjamini-Hochberg adjusted p within the groups `by`."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(p.asc(), F.col(tie).asc()))
    n = F.count(p).over(Window.partitionBy(*by))
    down = Window.partitionBy(*by).orderBy(p.desc(), F.col(tie).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return F.least(F.lit(1.0), F.min(p * n / rank).over(down))


def log_gamma(x: np.ndarray) -> np.ndarray:
    return np.vectorize(math.lgamma, otypes=[float])(x)


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction (Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_cdf(1 - x, b, a)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    tiny, c, d, f = 1e-300, 1.0, 1 - (a + b) * x / (a + 1), 1.0
    d = 1 / (d if abs(d) > tiny else tiny)
    f = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            f *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * f


def nb_log_pmf(k: np.ndarray, mu: float, phi: float) -> np.ndarray:
    """Negative binomial with mean mu and dispersion phi."""
    r = 1.0 / max(phi, 1e-12)
    return log_gamma(k + r) - math.lgamma(r) - log_gamma(k + 1.0) + r * math.log(r / (r + mu)) + k * math.log(mu / (r + mu))


def nb_exact_p(a: int, b: int, size_a: float, size_b: float, mean: float, phi: float, big: int = 900) -> float:
    """Two-sided conditional test of two sums given their total; sums over `big` take a beta approximation."""
    total = a + b
    if total == 0:
        return 1.0
    mu_a, mu_b = max(size_a * mean, 1e-12), max(size_b * mean, 1e-12)
    if a > big and b > big:
        r_a, r_b = size_a / max(phi, 1e-12), size_b / max(phi, 1e-12)
        alpha, beta = size_a * mean / (1 + phi * mean), (r_b / r_a) * size_a * mean / (1 + phi * mean)
        centre = beta_cdf((a + 0.5) / total, max(alpha, 1e-6), max(beta, 1e-6))
        return min(1.0, 2 * min(centre, 1 - centre))
    k = np.arange(total + 1, dtype=float)
    logs = nb_log_pmf(k, mu_a, phi / max(size_a, 1e-12)) + nb_log_pmf(total - k, mu_b, phi / max(size_b, 1e-12))
    logs -= logs.max()
    w = np.exp(logs)
    return float(min(1.0, w[w <= w[a] * (1 + 1e-9)].sum() / w.sum()))


#: Standard deviations by which the Turing estimate must differ from the fit to be used (fixed value).
TURING_SPREADS = 1.65


def good_turing(counts: dict[int, int]) -> dict[int, float]:
    """Simple Good-Turing adjusted counts for a table of frequency -> how many; key 0 has the unseen mass."""
    r = np.array(sorted(counts), float)
    n = np.array([counts[int(x)] for x in r], float)
    total = float((r * n).sum())
    gap = np.empty(len(r))
    for i in range(len(r)):
        low = r[i - 1] if i else 0.0
        high = r[i + 1] if i + 1 < len(r) else 2 * r[i] - low
        gap[i] = 2 * n[i] / (high - low)
    x, y = np.log(r), np.log(gap)
    slope = ((x - x.mean()) * (y - y.mean())).sum() / max(((x - x.mean()) ** 2).sum(), 1e-12)
    slope = min(slope, -1.0)  # above -1 the fit does not apply; at -1 it leaves the counts as they are
    fitted = (1 + 1 / r) ** (slope + 1)  # adjusted over raw count
    follows = np.append(r[1:] == r[:-1] + 1, False)
    after = np.where(follows, np.append(n[1:], 0.0), 0.0)
    turing = (r + 1) / r * after / n
    place = np.arange(1, len(r) + 1)
    spread = np.where(follows, (place + 1) / n * np.sqrt(after * (1 + after / n)), 1.0)
    far = np.abs(fitted - turing) * place / spread > TURING_SPREADS
    first = int(np.argmin(np.append(far, False)))  # from here on the fit holds
    out = r * np.where(np.arange(len(r)) < first, turing, fitted)
    unseen = float(n[0] / total)
    scale = (1 - unseen) / (out * n).sum() if (out * n).sum() else 0.0
    return {0: unseen} | {int(a): float(b * scale) for a, b in zip(r, out, strict=True)}


def two_gaussians(x: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """Means, common deviation and the posterior of the higher mean, by expectation-maximisation."""
    lo, hi = np.quantile(x, 0.25), np.quantile(x, 0.95)
    mu, sd, w = np.array([lo, max(hi, lo + 1e-6)]), max(x.std(), 1e-6), np.array([0.5, 0.5])
    post = np.zeros(len(x))
    for _ in range(rounds):
        d = np.log(w) - 0.5 * ((x[:, None] - mu) / sd) ** 2
        d -= d.max(1, keepdims=True)
        g = np.exp(d)
        g /= g.sum(1, keepdims=True)
        new = np.clip(g.sum(0), 1e-9, None)
        mu2 = (g * x[:, None]).sum(0) / new
        sd = max(math.sqrt((g * (x[:, None] - mu2) ** 2).sum() / len(x)), 1e-6)
        w = new / len(x)
        if np.abs(mu2 - mu).max() < 1e-10:
            mu, post = mu2, g[:, int(mu2.argmax())]
            break
        mu, post = mu2, g[:, int(mu2.argmax())]
    return mu, sd, post
