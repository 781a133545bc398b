"""Cell calling, depth and tag assignment."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats as K
from ..functions.stats import ratio

ALL = lambda: Window.partitionBy(F.lit(0))  # noqa: E731  totals of one row a barcode


def barcode_ranks(totals: DataFrame) -> DataFrame:
    """totals(barcode, total): rank by falling total; among ties the larger barcode is first."""
    return totals.withColumn("rank", F.row_number().over(ALL().orderBy(F.col("total").desc(), F.col("barcode").desc())))


def force_cells(totals: DataFrame, n: int) -> DataFrame:
    """The n barcodes of the largest positive totals; ties keep the larger barcode."""
    return totals.where("total > 0").orderBy(F.col("total").desc(), F.col("barcode").desc()).limit(n)


def ordmag(totals: DataFrame, expected: int, quantile: float = 0.99, ratio_to: float = 0.1) -> DataFrame:
    """Barcodes within an order of magnitude of the baseline, the total at rank (1 - quantile) * expected.

    The cutoff is at least one; rounding is half to even."""
    baseline_rank = max(1, round(expected * (1 - quantile)))
    at = totals.where("total > 0").orderBy(F.col("total").desc()).limit(baseline_rank).agg(F.greatest(F.lit(1), F.bround(F.min("total") * ratio_to)).alias("cutoff"))
    return totals.join(F.broadcast(at), F.col("total") >= F.col("cutoff")).select("barcode", "total")


def ordmag_bootstrap(totals: DataFrame, expected: int, rounds: int = 100, seed: int = 0) -> DataFrame:
    """Cell numbers of seeded bootstraps: a histogram of totals is resampled, so its size is the number of distinct totals."""
    spark = totals.sparkSession
    hist = totals.where("total > 0").groupBy("total").agg(F.count("*").alias("n"))
    packed = hist.agg(F.sort_array(F.collect_list(F.struct("total", "n"))).alias("h"))
    draws = spark.range(rounds).withColumnRenamed("id", "round").crossJoin(F.broadcast(packed))

    def run(batches):
        for pdf in batches:
            rows = []
            for r, h in zip(pdf["round"], pdf["h"], strict=True):
                v, n = np.array([x["total"] for x in h]), np.array([x["n"] for x in h])
                got = np.random.default_rng([seed, int(r)]).multinomial(n.sum(), n / n.sum())
                order = np.argsort(-v)
                top = v[order][min(np.searchsorted(np.cumsum(got[order]), max(1, round(expected * 0.01))), len(v) - 1)]
                rows.append((int(r), int(got[v >= max(1, round(0.1 * top))].sum())))
            yield pd.DataFrame(rows, columns=["round", "n_cells"])

    return draws.mapInPandas(run, "round long, n_cells long")


def summarize_bootstrap(rounds: DataFrame) -> DataFrame:
    m, s = F.avg("n_cells"), F.coalesce(F.stddev_pop("n_cells"), F.lit(0.0))
    return rounds.agg(F.bround(m).cast("long").alias("n_cells"), s.alias("sd"), (m - 1.96 * s).alias("low"), (m + 1.96 * s).alias("high"), ratio(s, m).alias("cv"))


def gradient_cutoff(totals: DataFrame, low_rank: int, high_rank: int) -> DataFrame:
    """Barcodes above the steepest fall of log total over log rank between two ranks."""
    ranked = totals.where("total > 0").orderBy(F.col("total").desc(), F.col("barcode").desc()).limit(high_rank)
    w = ALL().orderBy(F.col("total").desc(), F.col("barcode").desc())
    r = ranked.withColumn("rank", F.row_number().over(w)).withColumn("next", F.lead("total").over(w))
    slope = (F.log(F.col("next")) - F.log(F.col("total"))) / (F.log(F.col("rank") + 1.0) - F.log(F.col("rank").cast("double")))
    best = r.where(F.col("next").isNotNull() & (F.col("rank") >= low_rank)).withColumn("slope", F.round(slope, 9)).agg(F.min(F.struct("slope", "rank")).alias("b")).select("b.rank")
    return r.join(F.broadcast(best.withColumnRenamed("rank", "cut")), F.col("rank") <= F.col("cut")).select("barcode", "total", "rank")


#: Simulations that a task runs.
SIM_BLOCK = 500


def ambient_test(coo: DataFrame, totals: DataFrame, low: int, high: int, candidates: DataFrame, sims: int = 10_000, seed: int = 0) -> DataFrame:
    """Barcodes unlike the ambient profile of ranks [low, high): Monte Carlo p over distinct totals, adjusted.

    The profile has one row a feature and is smoothed by Good-Turing; a task runs a block of simulations for all totals."""
    spark = coo.sparkSession
    ranks = barcode_ranks(totals)
    ambient = coo.join(ranks.where(f"rank >= {low} and rank < {high}").select("barcode"), "barcode", "left_semi").groupBy("feature").agg(F.sum("umi_count").alias("n"))
    everything = coo.select("feature").distinct().join(ambient, "feature", "left").na.fill(0, ["n"]).orderBy("feature").toPandas()  # one row a feature
    n = everything["n"].to_numpy()
    table: dict[int, int] = {}
    for x in n[n > 0].tolist():
        table[x] = table.get(x, 0) + 1
    try:
        adjusted = K.good_turing(table)
        p = np.array([adjusted[x] if x else 0.0 for x in n.tolist()])
        p[n == 0] = adjusted[0] / max(1, int((n == 0).sum()))
    except (ValueError, ZeroDivisionError, FloatingPointError):
        p = n + 1.0
    p = np.maximum(p, 1e-12) / np.maximum(p, 1e-12).sum()
    logp = spark.createDataFrame(pd.DataFrame({"feature": everything["feature"].to_numpy(), "logp": np.log(p)}))
    x = coo.join(candidates.select("barcode"), "barcode", "left_semi").join(F.broadcast(logp), "feature")

    @F.pandas_udf("double")
    def lgamma1(c: pd.Series) -> pd.Series:
        return pd.Series(K.log_gamma(c.to_numpy(float) + 1.0))

    obs = x.groupBy("barcode").agg(F.sum("umi_count").alias("total"), F.sum(F.col("umi_count") * F.col("logp") - lgamma1("umi_count")).alias("part"))
    sent = spark.sparkContext.broadcast(p)
    totals_seen = obs.select("total").distinct()

    def simulate(batches):
        """A running draw serves all totals: the k-th draw of a feature as the i-th of all adds log p + log i - log k."""
        p = sent.value
        cut, logp = np.cumsum(p) / p.sum(), np.log(p)
        for pdf in batches:
            for block, wanted in zip(pdf["block"], pdf["totals"], strict=True):
                rng = np.random.default_rng([seed, int(block)])
                at = np.asarray(wanted, int)
                most, steps = int(at.max()), np.log(np.arange(1, int(at.max()) + 1))
                null = np.empty((SIM_BLOCK, len(at)))
                for i in range(SIM_BLOCK):
                    z = np.minimum(np.searchsorted(cut, rng.random(most), side="right"), len(p) - 1)
                    order = np.argsort(z, kind="stable")
                    heads = np.flatnonzero(np.diff(z[order], prepend=-1))
                    met = np.empty(most, int)
                    met[order] = np.arange(most) - np.repeat(heads, np.diff(np.append(heads, most)))
                    null[i] = np.cumsum(logp[z] + steps - steps[met])[at - 1]
                yield pd.DataFrame({"total": at, "null": np.sort(null, 0).T.tolist()})

    @F.pandas_udf("long")
    def below(value: pd.Series, null: pd.Series) -> pd.Series:
        return pd.Series([int(np.searchsorted(n, v)) for v, n in zip(value, null, strict=True)])

    blocks = -(-sims // SIM_BLOCK)
    asked = totals_seen.agg(F.sort_array(F.collect_set("total")).alias("totals")).where("size(totals) > 0")  # distinct totals only
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "totals").repartition(blocks, "block")
    null = asked.mapInPandas(simulate, "total long, null array<double>")
    full = obs.withColumn("value", F.col("part") + lgamma1("total"))
    met = full.join(null, "total").withColumn("lower", below("value", "null")).groupBy("barcode", "total").agg(F.sum("lower").alias("lower"))
    both = met.withColumn("p", (1 + F.col("lower")) / F.lit(1.0 + blocks * SIM_BLOCK)).withColumn("one", F.lit(1))
    return both.select("barcode", "total", "p", K.bh_adjusted(F.col("p"), ["one"], "barcode").alias("p_adjusted"))


def mito_filter(coo: DataFrame, mito: DataFrame, most: float) -> DataFrame:
    """Share of mitochondrial counts of each barcode and whether it stays."""
    marked = coo.join(F.broadcast(mito.select("feature", F.lit(1).alias("m"))), "feature", "left")
    out = marked.groupBy("barcode").agg(F.sum("umi_count").alias("total"), F.coalesce(F.sum(F.when(F.col("m") == 1, F.col("umi_count"))), F.lit(0)).alias("mito"))
    share = ratio(F.col("mito"), F.col("total"))
    return out.withColumn("mito_frac", share).withColumn("keep", share <= most)


def high_occupancy(cells: DataFrame, partition: Column, most: int) -> DataFrame:
    """Cells of partitions that hold more than `most` cells."""
    n = F.count("*").over(Window.partitionBy("partition"))
    return cells.withColumn("partition", partition).withColumn("n", n).where(F.col("n") > most)


def aggregate_barcodes(counts: DataFrame, top: int, least_features: int, min_umis: int = 1000) -> DataFrame:
    """counts(feature, barcode, n): barcodes in the top of their total that are in the top of many features."""
    used = counts.groupBy("feature").agg(F.sum("n").alias("s")).where(F.col("s") >= min_umis)
    kept = counts.join(F.broadcast(used), "feature", "left_semi")
    n_used = used.agg(F.count("*").alias("k"))
    per = kept.withColumn("r", F.row_number().over(Window.partitionBy("feature").orderBy(F.col("n").desc(), "barcode"))).where(F.col("r") <= top).groupBy("barcode").agg(F.count("*").alias("n_features"))
    total = kept.groupBy("barcode").agg(F.sum("n").alias("total")).orderBy(F.col("total").desc(), "barcode").limit(top)
    enough = F.greatest(F.lit(0.6), 1.1 - 0.02 * F.col("k"))
    return per.join(total, "barcode").crossJoin(F.broadcast(n_used)).where((F.col("k") >= least_features) & (F.col("n_features") >= F.round(F.col("k") * enough))).select("barcode", "total", "n_features")


def outlier_barcodes(totals: DataFrame, multiplier: float = 3.0, top: int = 100, least: int = 1000) -> DataFrame:
    """Totals above Q3 + multiplier * IQR of the top barcodes, and at least `least`."""
    head = totals.orderBy(F.col("total").desc(), "barcode").limit(top)
    q = head.agg(F.percentile("total", 0.25).alias("q1"), F.percentile("total", 0.75).alias("q3")).select((F.col("q3") + multiplier * (F.col("q3") - F.col("q1"))).alias("limit"))
    return totals.join(F.broadcast(q), (F.col("total") > F.col("limit")) & (F.col("total") >= least)).select("barcode", "total")


def depth_rates(libraries: DataFrame) -> DataFrame:
    """libraries(library, library_type, reads, cells): the share of reads to keep for the least depth of the type."""
    per_cell = ratio(F.col("reads"), F.col("cells"))
    least = F.min(F.when(F.col("rpc") > 0, F.col("rpc"))).over(Window.partitionBy("library_type"))
    return libraries.withColumn("rpc", per_cell).withColumn("frac_kept", F.least(F.lit(1.0), F.coalesce(ratio(least, F.col("rpc")), F.lit(0.0))))


def thin(mol: DataFrame, rates: DataFrame, seed: int = 0) -> DataFrame:
    """Binomial thinning of reads by library rate; the draw depends on the molecule's key alone, so retries and layouts agree."""
    keyed = mol.join(F.broadcast(rates.select("library", "frac_kept")), "library").withColumn("key", F.xxhash64("barcode", "feature", "umi", "library", "gem_group", "reads", F.lit(seed)))
    draws = F.filter(F.sequence(F.lit(1), F.col("reads")), lambda i: F.pmod(F.xxhash64(F.col("key"), i), F.lit(1 << 30)) < F.col("frac_kept") * (1 << 30))
    return keyed.withColumn("kept", F.when(F.col("reads") > 0, F.size(draws)).otherwise(0)).where("kept > 0").drop("key", "frac_kept")


def depth_grid(most: int, n: int) -> list[int]:
    return sorted({int(x) for x in np.linspace(0, most, n + 1).round()} - {0})


def binomial_quantiles(u: np.ndarray, n: np.ndarray, p: float) -> np.ndarray:
    """The binomial count at each u: never falls as p grows, so draws at several depths are nested."""
    if p >= 1:
        return n
    out = np.zeros(len(n), np.int64)
    order = np.argsort(n, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(n[order])) + 1) if len(n) else ():
        m = int(n[part[0]])
        if m > 0 and p > 0:
            k = np.arange(m + 1)
            logs = math.lgamma(m + 1) - K.log_gamma(k + 1.0) - K.log_gamma(m - k + 1.0) + k * math.log(p) + (m - k) * math.log1p(-p)
            out[part] = np.minimum(np.searchsorted(np.cumsum(np.exp(logs)), u[part], side="left"), m)
    return out


def subsample_curve(mol: DataFrame, depths: list[float], seed: int = 0) -> DataFrame:
    """Per depth: reads, molecules, median molecules and features of barcodes, duplicate fraction; one scan for all depths.

    A molecule's draws follow its key alone, so retries and layouts agree, and are nested over the depths."""

    @F.pandas_udf("array<long>")
    def draw(key: pd.Series, reads: pd.Series) -> pd.Series:
        u = ((key.to_numpy().astype(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        n = reads.to_numpy().astype(np.int64)
        return pd.Series(list(np.stack([binomial_quantiles(u, n, float(d)) for d in depths], 1)))

    key = F.xxhash64("barcode", "feature", "umi", "library", "gem_group", "reads", F.lit(seed))
    drawn = mol.select("barcode", "feature", F.posexplode(draw(key, F.col("reads"))).alias("at", "kept")).where("kept > 0")
    per = drawn.groupBy("at", "barcode", "feature").agg(F.sum("kept").alias("kept"), F.count("*").alias("umis"))
    per = per.groupBy("at", "barcode").agg(F.sum("kept").alias("reads"), F.sum("umis").alias("umis"), F.count("*").alias("features"))
    out = per.groupBy("at").agg(F.sum("reads").alias("reads"), F.sum("umis").alias("umis"), F.percentile("umis", 0.5).alias("median_umis"), F.percentile("features", 0.5).alias("median_features"))
    depth = F.element_at(F.array(*(F.lit(float(d)) for d in depths)), F.col("at") + 1)
    return out.select(depth.alias("depth"), "reads", "umis", "median_umis", "median_features", ratio(F.col("reads") - F.col("umis"), F.col("reads")).alias("dup_frac"))


def contaminant_tags(counts: DataFrame, min_counts: int = 1000, dynamic_range: int = 50, max_cor: float = 0.5) -> DataFrame:
    """counts(barcode, tag, n): tags that are rare, or correlate with a more abundant tag."""
    totals = counts.groupBy("tag").agg(F.sum("n").alias("total")).where("total > 0")
    rare = totals.withColumn("largest", F.max("total").over(ALL())).withColumn("rare", (F.col("total") < min_counts) | (F.col("total") * dynamic_range < F.col("largest")))
    cells = counts.select("barcode").distinct()
    n = cells.agg(F.count("*").alias("cells"))
    c = F.col("n").cast("double")
    s = counts.groupBy("tag").agg(F.sum(c).alias("s"), F.sum(c * c).alias("ss"))
    dots = counts.select("barcode", F.col("tag").alias("a"), F.col("n").alias("na")).join(counts.select("barcode", F.col("tag").alias("b"), F.col("n").alias("nb")), "barcode").where("a < b").groupBy("a", "b").agg(F.sum(F.col("na").cast("double") * F.col("nb")).alias("dot"))
    both = dots.join(s.select(F.col("tag").alias("a"), F.col("s").alias("sa"), F.col("ss").alias("qa")), "a").join(s.select(F.col("tag").alias("b"), F.col("s").alias("sb"), F.col("ss").alias("qb")), "b").crossJoin(F.broadcast(n))
    cor = F.try_divide(F.col("cells") * F.col("dot") - F.col("sa") * F.col("sb"), F.sqrt((F.col("cells") * F.col("qa") - F.col("sa") * F.col("sa")) * (F.col("cells") * F.col("qb") - F.col("sb") * F.col("sb"))))
    worse = both.where(cor >= max_cor).select(F.when((F.col("sa") < F.col("sb")) | ((F.col("sa") == F.col("sb")) & (F.col("a") > F.col("b"))), F.col("a")).otherwise(F.col("b")).alias("tag")).distinct().withColumn("correlated", F.lit(True))
    return rare.join(worse, "tag", "left").select("tag", "total", (F.col("rare") | F.coalesce("correlated", F.lit(False))).alias("contaminant"))


def presence_calls(counts: DataFrame, min_umis: int = 3) -> DataFrame:
    """counts(feature, barcode, n): presence by a two-component mixture of log10(1 + n), a feature a task."""

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.log10(1.0 + pdf["n"].to_numpy(float))
        post = K.two_gaussians(x)[2] if len(x) > 2 and x.std() > 0 else np.zeros(len(x))
        return pdf.assign(present=(post > 0.5) & (pdf["n"] >= min_umis))

    return counts.groupBy("feature").applyInPandas(call, "feature string, barcode long, n long, present boolean")


def feature_calls(calls: DataFrame) -> DataFrame:
    """calls(barcode, feature, n): one row a barcode, features and counts joined by |."""
    one = F.sort_array(F.collect_list(F.struct("feature", "n")))
    return calls.groupBy("barcode").agg(one.alias("c")).select("barcode", F.size("c").alias("num_features"), F.array_join("c.feature", "|").alias("feature_call"), F.array_join(F.transform("c.n", lambda x: x.cast("string")), "|").alias("num_umis"))


def calls_summary(calls: DataFrame) -> DataFrame:
    """Per call: cells, their share, median and deviation of the counts."""
    n = calls.groupBy("barcode").agg(F.array_join(F.sort_array(F.collect_list("feature")), "|").alias("feature_call"), F.sum("n").alias("umis"))
    g = n.groupBy("feature_call").agg(F.count("*").alias("num_cells"), F.percentile("umis", 0.5).alias("median_umis"), F.stddev_pop("umis").alias("stddev_umis"))
    return g.withColumn("pct_cells", 100.0 * F.col("num_cells") / F.sum("num_cells").over(ALL()))


def assign_samples(tags: DataFrame, sample_of: DataFrame, cells: DataFrame) -> DataFrame:
    """tags(barcode, tag): sample of barcodes with one tag, 'multiplet' with several, and the cell flag."""
    one = tags.groupBy("barcode").agg(F.count_distinct("tag").alias("n_tags"), F.min("tag").alias("tag"))
    named = one.join(F.broadcast(sample_of), "tag", "left").join(cells.select("barcode", F.lit(True).alias("is_cell")).distinct(), "barcode", "left")
    return named.select("barcode", "n_tags", F.when(F.col("n_tags") > 1, "multiplet").otherwise(F.col("sample")).alias("assignment"), F.coalesce("is_cell", F.lit(False)).alias("is_cell"))


def antigen_specificity(counts: DataFrame, threshold: float = 0.925) -> DataFrame:
    """counts(barcode, antigen, signal, noise): 100 * (1 - BetaCDF(threshold; signal + 1, noise + 3))."""

    @F.pandas_udf("double")
    def score(s: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([100.0 * (1.0 - K.beta_cdf(threshold, a + 1.0, b + 3.0)) for a, b in zip(s, n, strict=True)])

    return counts.withColumn("specificity", score(F.col("signal").cast("double"), F.col("noise").cast("double")))


def klet_fractions(rate: float, most: int) -> list[float]:
    """Poisson shares of partitions with 1 to most cells, among those with cells."""
    import math

    w = [math.exp(-rate) * rate**k / math.factorial(k) for k in range(1, most + 1)]
    return [x / sum(w) for x in w]


def expected_cells(totals: DataFrame, most: int = 262_144, quantile: float = 0.99, steps: int = 2000) -> DataFrame:
    """recovered, filtered, loss: the number of cells for which the barcodes within an order of magnitude of its baseline are nearest to it.

    Candidates are spaced by log2. The baselines are order statistics of the largest totals only; the driver gets nothing."""
    spark = totals.sparkSession
    tried = sorted({int(round(2**x)) for x in np.linspace(1, np.log2(most), steps)})
    tries = spark.createDataFrame([(c, int(round(c * (1 - quantile)))) for c in tried], "recovered long, at long")
    positive = totals.where("total > 0").select("total")
    head = positive.orderBy(F.col("total").desc()).limit(int(round(most * (1 - quantile))) + 1)
    ranked = head.withColumn("r", F.row_number().over(Window.orderBy(F.col("total").desc())) - 1)
    last = ranked.agg(F.max("r").alias("last"))
    base = tries.join(F.broadcast(last)).withColumn("r", F.least("at", "last")).join(ranked, "r")
    base = base.withColumn("cut", F.greatest(F.round(F.col("total") * 0.1), F.lit(1)).cast("long")).select("recovered", "cut")
    # barcodes at or above each cut: counts by total, summed from the top
    by_total = positive.groupBy("total").agg(F.count("*").alias("n")).unionByName(base.select(F.col("cut").alias("total")).distinct().withColumn("n", F.lit(0).cast("long")))
    by_total = by_total.groupBy("total").agg(F.sum("n").alias("n"))
    above = by_total.withColumn("filtered", F.sum("n").over(Window.orderBy(F.col("total").desc())))  # one row a distinct total
    scored = base.join(above.select(F.col("total").alias("cut"), "filtered"), "cut")
    loss = F.pow(F.col("filtered") - F.col("recovered"), 2) / F.col("recovered")
    return scored.withColumn("loss", loss).orderBy("loss", "recovered").limit(1).select("recovered", "filtered", "loss")


def cells_by_group(totals: DataFrame, by: list[str], expected: int, quantile: float = 0.99) -> DataFrame:
    """Barcodes within an order of magnitude of the baseline of their group."""
    w = Window.partitionBy(*by).orderBy(F.col("total").desc(), "barcode")
    ranked = totals.where("total > 0").withColumn("r", F.row_number().over(w))
    at = int(round(expected * (1 - quantile)))
    base = ranked.groupBy(*by).agg(F.max(F.when(F.col("r") <= at + 1, F.struct("r", "total"))).alias("b")).select(*by, F.greatest(F.round(F.col("b.total") * 0.1), F.lit(1)).alias("cut"))
    return ranked.join(F.broadcast(base), by).where(F.col("total") >= F.col("cut")).select(*by, "barcode", "total")
