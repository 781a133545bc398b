"""Likelihoods, mixtures and fits that need iteration; groups run as Arrow-batched tasks."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats as K
from ..functions.stats import ratio


def log_gamma(c: Column) -> Column:
    @F.pandas_udf("double")
    def f(x: pd.Series) -> pd.Series:
        return pd.Series(K.log_gamma(x.to_numpy(float)))

    return f(c.cast("double"))


def multinomial_loglik(counts: DataFrame, profile: DataFrame) -> DataFrame:
    """counts(barcode, feature, n), profile(feature, p): log-likelihood of each barcode's counts."""
    x = counts.join(F.broadcast(profile), "feature")
    s = x.groupBy("barcode").agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log("p") - log_gamma(F.col("n") + 1)).alias("part"))
    return s.select("barcode", "total", (log_gamma(F.col("total") + 1) + F.col("part")).alias("loglik"))


def dirichlet_multinomial_loglik(counts: DataFrame, profile: DataFrame, alpha: float) -> DataFrame:
    """The same with overdispersion: pseudo-counts alpha * p; absent features add nothing."""
    x = counts.join(F.broadcast(profile), "feature").withColumn("a", F.col("p") * alpha)
    s = x.groupBy("barcode").agg(F.sum("n").alias("total"), F.sum(log_gamma(F.col("n") + F.col("a")) - log_gamma(F.col("a")) - log_gamma(F.col("n") + 1)).alias("part"))
    t = F.col("total")
    return s.select("barcode", "total", (log_gamma(t + 1) + F.lit(math.lgamma(alpha)) - log_gamma(t + alpha) + F.col("part")).alias("loglik"))


def estimate_overdispersion(counts: DataFrame, profile: DataFrame, low: float = 1e-2, high: float = 1e6, steps: int = 40) -> float:
    """Alpha of the largest likelihood by golden section on its logarithm.

    Only frequencies of (feature, count) and of totals reach the driver: their number is bounded by distinct values."""
    hist = counts.join(F.broadcast(profile), "feature").groupBy("p", "n").agg(F.count("*").alias("m")).toPandas()
    totals = counts.groupBy("barcode").agg(F.sum("n").alias("t")).groupBy("t").agg(F.count("*").alias("m")).toPandas()
    p, n, m = (hist[c].to_numpy(float) for c in ("p", "n", "m"))
    t, w = totals["t"].to_numpy(float), totals["m"].to_numpy(float)

    def loss(u: float) -> float:
        a = math.exp(u)
        return -float((m * (K.log_gamma(n + a * p) - K.log_gamma(a * p))).sum() + (w * (math.lgamma(a) - K.log_gamma(t + a))).sum())

    x, y, g = math.log(low), math.log(high), (math.sqrt(5) - 1) / 2
    for _ in range(steps):
        c, d = y - g * (y - x), x + g * (y - x)
        x, y = (x, d) if loss(c) < loss(d) else (c, y)
    return math.exp((x + y) / 2)


def good_turing_proportions(freq: DataFrame) -> DataFrame:
    """freq(r, n): adjusted proportion of an item seen r times; the table of frequencies is small."""
    table = {int(r["r"]): int(r["n"]) for r in freq.collect()}
    return freq.sparkSession.createDataFrame(sorted(K.good_turing(table).items()), "r long, proportion double")


def tag_states(n_tags: int, most: int) -> np.ndarray:
    """Counts of tags in each state: blank, singlets, doublets, ... up to `most` cells."""
    rows = [np.zeros(n_tags, int)]
    for k in range(1, most + 1):
        for c in itertools.combinations_with_replacement(range(n_tags), k):
            rows.append(np.bincount(c, minlength=n_tags))
    return np.array(rows)


def assign_tags(counts: DataFrame, tags: list[str], most: int = 2, rate: float = 0.1, blank: float = 0.04, rounds: int = 100, tol: float = 1e-2) -> DataFrame:
    """counts(gem_group, barcode, tag, n): the most likely tag state of each barcode by a joint mixture of log counts.

    A state's mean for a tag is background + foreground * copies; states weigh by Poisson cells and multinomial
    choice. A gem group is fitted by one task, as its barcodes share parameters."""
    states = tag_states(len(tags), most)
    size = states.sum(1)
    prior = np.empty(len(states))
    for i, (s, k) in enumerate(zip(states, size, strict=True)):
        ways = math.factorial(k) / np.prod([math.factorial(x) for x in s])
        prior[i] = blank if k == 0 else (1 - blank) * math.exp(-rate) * rate**k / math.factorial(k) * ways / len(tags) ** k
    prior /= prior.sum()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.log10(1.0 + pdf.pivot_table(index="barcode", columns="tag", values="n", aggfunc="sum", fill_value=0).reindex(columns=tags, fill_value=0))
        y = x.to_numpy(float)
        back, fore, sd = np.quantile(y, 0.2, 0), np.maximum(np.quantile(y, 0.95, 0) - np.quantile(y, 0.2, 0), 0.1), np.maximum(y.std(0), 0.05)
        old = -np.inf
        for _ in range(rounds):
            mean = back + states * fore
            logs = np.log(prior) - (0.5 * ((y[:, None, :] - mean) / sd) ** 2 + np.log(sd)).sum(2)
            top = logs.max(1, keepdims=True)
            post = np.exp(logs - top)
            total = float((top[:, 0] + np.log(post.sum(1))).sum())
            post /= post.sum(1, keepdims=True)
            for t in range(len(tags)):  # weighted least squares of one tag on its copies
                w, c = post, states[:, t]
                sw, sx, sxx = w.sum(), (w * c).sum(), (w * c * c).sum()
                sy, sxy = (w * y[:, [t]]).sum(), (w * c * y[:, [t]]).sum()
                det = sw * sxx - sx * sx
                if det > 1e-9:
                    fore[t] = max((sw * sxy - sx * sy) / det, 1e-3)
                    back[t] = (sy - fore[t] * sx) / sw
                sd[t] = max(math.sqrt((w * (y[:, [t]] - back[t] - fore[t] * c) ** 2).sum() / len(y)), 1e-2)
            if abs(total - old) <= tol:
                break
            old = total
        best = post.argmax(1)
        name = ["|".join(t for t, k in zip(tags, s, strict=True) for _ in range(k)) or "blank" for s in states]
        return pd.DataFrame({"gem_group": pdf["gem_group"].iloc[0], "barcode": x.index.to_numpy(), "assignment": [name[i] for i in best], "probability": post.max(1)})

    return counts.groupBy("gem_group").applyInPandas(fit, "gem_group string, barcode long, assignment string, probability double")


def genotype_clusters(alleles: DataFrame, k: int, starts: int = 8, seed: int = 0) -> DataFrame:
    """alleles(barcode, locus, ref, alt): clusters of barcodes by a binomial mixture with tempering.

    Each start is a task of its own over the packed table (loci times barcodes that have reads); the best likelihood wins."""
    spark = alleles.sparkSession
    packed = alleles.agg(F.collect_list(F.struct("barcode", "locus", "ref", "alt")).alias("a"))
    runs = spark.range(starts).repartition(starts).crossJoin(F.broadcast(packed))

    def run(batches):
        for pdf in batches:
            for start, rows in zip(pdf["id"], pdf["a"], strict=True):
                b, bi = np.unique([r["barcode"] for r in rows], return_inverse=True)
                loci, li = np.unique([r["locus"] for r in rows], return_inverse=True)
                ref, alt = np.array([r["ref"] for r in rows], float), np.array([r["alt"] for r in rows], float)
                rng = np.random.default_rng([seed, int(start)])
                theta = rng.uniform(0.1, 0.9, (k, len(loci)))
                post = np.zeros((len(b), k))
                total = 0.0
                for temper in [0.1, 0.3, 0.6] + [1.0] * 30:
                    logs = np.zeros((len(b), k))
                    for c in range(k):
                        np.add.at(logs[:, c], bi, alt * np.log(theta[c, li]) + ref * np.log(1 - theta[c, li]))
                    top = logs.max(1, keepdims=True)
                    total = float((top[:, 0] + np.log(np.exp(logs - top).mean(1))).sum())
                    post = np.exp(temper * (logs - top))
                    post /= post.sum(1, keepdims=True)
                    for c in range(k):
                        a, r = np.ones(len(loci)), np.ones(len(loci))
                        np.add.at(a, li, post[bi, c] * alt)
                        np.add.at(r, li, post[bi, c] * ref)
                        theta[c] = a / (a + r)
                yield pd.DataFrame({"start": int(start), "loglik": round(total, 6), "barcode": b, "cluster": post.argmax(1) + 1})

    got = runs.mapInPandas(run, "start long, loglik double, barcode long, cluster int")
    best = got.agg(F.max(F.struct("loglik", (-F.col("start")).alias("s"))).alias("top")).select((-F.col("top.s")).alias("start"))
    return got.join(F.broadcast(best), "start").select("barcode", "cluster")


def perturbation_efficiency(counts: DataFrame, min_cells: int = 10, rounds: int = 200, seed: int = 0) -> DataFrame:
    """counts(target, perturbed, barcode, n): log2 fold change of the target's counts with a bootstrap interval."""

    def boot(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf.loc[pdf["perturbed"], "n"].to_numpy(float), pdf.loc[~pdf["perturbed"], "n"].to_numpy(float)
        empty = pd.DataFrame({"target": [], "cells": [], "log2fc": [], "low": [], "high": []})
        if len(a) < min_cells or len(b) < min_cells:
            return empty
        rng = np.random.default_rng([seed, int(pdf["barcode"].min()), len(a)])
        fold = lambda u, v: np.log2((u.mean(-1) + 1e-3) / (v.mean(-1) + 1e-3))
        draws = fold(rng.choice(a, (rounds, len(a))), rng.choice(b, (rounds, len(b))))
        return pd.DataFrame({"target": [pdf["target"].iloc[0]], "cells": [len(a)], "log2fc": [fold(a, b)], "low": [np.quantile(draws, 0.05)], "high": [np.quantile(draws, 0.95)]})

    return counts.groupBy("target").applyInPandas(boot, "target string, cells long, log2fc double, low double, high double")


def rounded(c: Column, digits: int) -> Column:
    """A number of at least 0 scaled, rounded half up and scaled back, as SQL's round of a double; F.round goes by its decimal digits."""
    t = c * 10.0**digits
    whole = F.floor(t).cast("double")
    return F.when(t < 2.0**52, whole + F.when(t - whole >= 0.5, 1.0).otherwise(0.0)).otherwise(t) / 10.0**digits


def piecewise_fit(points: DataFrame) -> DataFrame:
    """points(group, x, y): break point of the best two straight segments, by running sums; one row a group.

    All sums before and after each break come from two windows, so no row is visited per candidate. Breaks whose
    errors agree to six digits go to the least x; the error itself is the least of all, not rounded. Null x are last."""
    up = Window.partitionBy("group").orderBy(F.col("x").asc_nulls_last(), "y").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("group")
    cols = {"n": F.lit(1.0), "sx": F.col("x"), "sy": F.col("y"), "sxx": F.col("x") * F.col("x"), "sxy": F.col("x") * F.col("y"), "syy": F.col("y") * F.col("y")}
    rows = points
    for k, c in cols.items():
        rows = rows.withColumn(f"l_{k}", F.sum(c).over(up)).withColumn(f"r_{k}", F.sum(c).over(whole) - F.col(f"l_{k}"))

    def sse(p: str) -> Column:
        n, sx, sy, sxx, sxy, syy = (F.col(f"{p}_{k}") for k in cols)
        vx, vy, cxy = sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n
        return F.greatest(F.lit(0.0), vy - F.coalesce(F.try_divide(cxy * cxy, vx), F.lit(0.0)))

    ok = rows.where("l_n >= 2 and r_n >= 2").withColumn("sse", sse("l") + sse("r"))
    best = F.min(F.struct(rounded(F.col("sse"), 6).alias("key"), "x"))
    return ok.groupBy("group").agg(best.alias("b"), F.min("sse").alias("sse")).select("group", F.col("b.x").alias("break"), "sse")


def simplify_line(points: list[tuple[float, float]], epsilon: float) -> list[tuple[float, float]]:
    """Polyline without points nearer than epsilon to the line that replaces them."""
    keep, work = {0, len(points) - 1}, [(0, len(points) - 1)]
    while work:
        a, b = work.pop()
        (x0, y0), (x1, y1) = points[a], points[b]
        length = math.hypot(x1 - x0, y1 - y0)
        far, at = 0.0, -1
        for i in range(a + 1, b):
            x, y = points[i]
            d = abs((x1 - x0) * (y0 - y) - (x0 - x) * (y1 - y0)) / length if length else math.hypot(x - x0, y - y0)
            if d > far:
                far, at = d, i
        if far > epsilon:
            keep.add(at)
            work += [(a, at), (at, b)]
    return [points[i] for i in sorted(keep)]


def observed_multiplets(calls: DataFrame) -> DataFrame:
    """calls(barcode, call): cells of each genome, observed multiplets and the number that stays unseen.

    Multiplets of two cells of one genome look like singlets; with shares p and q of the genomes they are
    (p^2 + q^2) / (2 p q) times those that are seen."""
    n = calls.agg(F.count_if(F.col("call") == "genome0").alias("n0"), F.count_if(F.col("call") == "genome1").alias("n1"), F.count_if(F.col("call") == "multiplet").alias("seen"))
    p = ratio(F.col("n0"), F.col("n0") + F.col("n1"))
    return n.withColumn("inferred", F.col("seen") * F.try_divide(F.lit(1.0), 2 * p * (1 - p)))


def purity(calls: DataFrame) -> DataFrame:
    """calls(barcode, count0, count1, call): share of counts of the called genome."""
    own = F.when(F.col("call") == "genome0", F.col("count0")).when(F.col("call") == "genome1", F.col("count1"))
    x = calls.where(own.isNotNull()).withColumn("p", ratio(own, F.col("count0") + F.col("count1")))
    return x.groupBy("call").agg(F.count("*").alias("cells"), F.avg("p").alias("mean_purity"), F.percentile("p", 0.5).alias("median_purity"))


def reservoir(df: DataFrame, key: list[str], n: int, seed: int) -> DataFrame:
    """A uniform sample of n rows: the least hashes, so partitions and retries do not matter."""
    return df.withColumn("h", F.xxhash64(*key, F.lit(seed))).orderBy("h", *key).limit(n).drop("h")


def allele_counts(reads: DataFrame, snps: DataFrame, bin_width: int = 64) -> DataFrame:
    """reads(id, barcode, chrom, start, end, seq) over snps(chrom, pos, ref, alt): reference and alternative reads of each cell and site."""
    from .counting import interval_join

    sites = snps.select("chrom", F.col("pos").alias("lo"), F.col("pos").alias("hi"), "ref", "alt")
    hit = interval_join(reads, sites, bin_width).withColumn("base", F.substring("seq", (F.col("lo") - F.col("start") + 1).cast("int"), F.lit(1)))
    return hit.groupBy("barcode", "chrom", F.col("lo").alias("pos")).agg(F.count_if(F.col("base") == F.col("ref")).alias("ref_reads"), F.count_if(F.col("base") == F.col("alt")).alias("alt_reads"))


def consensus_bases(rows: DataFrame, by: list[str], column: str, share: float = 0.5) -> DataFrame:
    """The majority base of each position of aligned sequences, N without a majority."""
    at = rows.select(*by, F.posexplode(F.split(column, "")).alias("pos", "base")).where("base <> ''")
    n = at.groupBy(*by, "pos", "base").agg(F.count("*").alias("n"))
    top = n.groupBy(*by, "pos").agg(F.max(F.struct("n", "base")).alias("t"), F.sum("n").alias("all"))
    called = top.withColumn("c", F.when(F.col("t.n") > share * F.col("all"), F.col("t.base")).otherwise("N"))
    return called.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list(F.struct("pos", "c")))["c"], "").alias("consensus"))
