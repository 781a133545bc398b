"""Matrix statistics and normalisation on COO tables; zeros are implicit and counted from dimensions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import ratio
from ..sources.stage import stage

#: Points of a block of the neighbour search; numbers of a dense block of cluster means.
BLOCK, CELLS = 4096, 1 << 20


def mean_var(coo: DataFrame, n_barcodes: int) -> DataFrame:
    """Mean and population variance of each feature over all barcodes, zeros included."""
    c = F.col("umi_count").cast("double")
    s = coo.groupBy("feature").agg(F.sum(c).alias("s"), F.sum(c * c).alias("ss"))
    mean = F.col("s") / n_barcodes
    return s.select("feature", mean.alias("mean"), (F.col("ss") / n_barcodes - mean * mean).alias("var"))


def normalize_by_umi(coo: DataFrame) -> DataFrame:
    """Counts scaled to the median barcode total (at least one)."""
    totals = coo.groupBy("barcode").agg(F.sum("umi_count").alias("total"))
    median = totals.agg(F.greatest(F.percentile("total", 0.5), F.lit(1.0)).alias("median"))
    return coo.join(totals.crossJoin(F.broadcast(median)), "barcode").select("barcode", "feature", (F.col("umi_count") * F.col("median") / F.col("total")).alias("value"))


def normalize_by_idf(coo: DataFrame, n_barcodes: int) -> DataFrame:
    """Counts weighted by log(n + 1) - log(1 + barcodes with the feature)."""
    idf = coo.groupBy("feature").agg(F.count("*").alias("df")).withColumn("idf", F.log(F.lit(n_barcodes + 1.0)) - F.log(1.0 + F.col("df")))
    return coo.join(idf, "feature").select("barcode", "feature", (F.col("umi_count") * F.col("idf")).alias("value"))


def size_factors(coo: DataFrame) -> DataFrame:
    totals = coo.groupBy("barcode").agg(F.sum("umi_count").alias("total"))
    median = totals.agg(F.percentile("total", 0.5).alias("median"))
    return totals.crossJoin(F.broadcast(median)).select("barcode", ratio(F.col("total"), F.col("median")).alias("size_factor"))


def normalized_dispersion(moments: DataFrame, n_bins: int = 20) -> DataFrame:
    """var/mean of features, centred and scaled by median and absolute deviation inside quantile bins of the mean."""
    m = moments.where("mean > 0").withColumn("dispersion", ratio(F.col("var"), F.col("mean")))
    # the bin edges are n_bins numbers: one aggregate, joined as one row
    edges = m.agg(F.percentile("mean", F.array(*(F.lit(i / n_bins) for i in range(1, n_bins)))).alias("edges"))
    binned = m.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("mean")))).drop("edges")
    mid = binned.groupBy("bin").agg(F.percentile("dispersion", 0.5).alias("mid"))
    off = binned.join(F.broadcast(mid), "bin").withColumn("off", F.abs(F.col("dispersion") - F.col("mid")))
    mad = off.groupBy("bin").agg(F.percentile("off", 0.5).alias("mad"))
    return off.join(F.broadcast(mad), "bin").select("feature", "bin", "dispersion", F.when(F.col("mad") > 0, (F.col("dispersion") - F.col("mid")) / F.col("mad")).otherwise(F.lit(0.0)).alias("normalized"))


def group_moments(coo: DataFrame, groups: DataFrame) -> DataFrame:
    """One pass for all clusters: sums of counts and scaled squares of (feature, cluster) and of the rest."""
    sf = size_factors(coo)
    g = groups.join(sf, "barcode")
    v = F.col("umi_count") / F.col("size_factor")
    inside = coo.join(g, "barcode").groupBy("feature", "cluster").agg(F.sum("umi_count").alias("sum_in"))
    whole = coo.join(g, "barcode").groupBy("feature").agg(F.sum("umi_count").alias("sum_all"), F.sum(v).alias("s"), F.sum(v * v).alias("ss"))
    sizes = g.groupBy("cluster").agg(F.sum("size_factor").alias("size_in"), F.count("*").alias("cells_in"))
    total = g.agg(F.sum("size_factor").alias("size_all"), F.count("*").alias("cells"))
    grid = whole.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(total))
    return grid.join(inside, ["feature", "cluster"], "left").na.fill(0, ["sum_in"])


def differential_expression(coo: DataFrame, groups: DataFrame, zeta_quantile: float = 0.995) -> DataFrame:
    """Cluster against the rest, by a negative binomial exact test with shrunken dispersions."""
    m = group_moments(coo, groups)
    mean_all = F.col("s") / F.col("cells")
    var_all = (F.col("ss") - F.col("cells") * mean_all * mean_all) / F.greatest(F.col("cells") - 1, F.lit(1))
    m = m.withColumn("mean_all", mean_all).withColumn("phi_mm", F.greatest(F.lit(0.0), F.try_divide(F.col("cells") * var_all - F.col("size_all") * mean_all, mean_all * mean_all * F.col("size_all"))))
    zeta = m.select("feature", "phi_mm").distinct().agg(F.percentile("phi_mm", zeta_quantile).alias("zeta"), F.avg("phi_mm").alias("phi_mean"), F.coalesce(F.var_samp("phi_mm"), F.lit(0.0)).alias("phi_var"), F.count("*").alias("n"))
    m = m.crossJoin(F.broadcast(zeta))
    delta = F.coalesce(F.try_divide(F.col("phi_var") * (F.col("n") - 1), F.col("n") * F.pow(F.col("zeta") - F.col("phi_mean"), F.lit(2.0)) + F.col("phi_var") * (F.col("n") - 1)), F.lit(1.0))
    m = m.withColumn("phi", (1 - delta) * F.col("phi_mm") + delta * F.col("zeta"))
    fold = F.log2((1.0 + F.col("sum_in")) / (1.0 + F.col("size_in"))) - F.log2((1.0 + F.col("sum_all") - F.col("sum_in")) / (1.0 + F.col("size_all") - F.col("size_in")))

    @F.pandas_udf("double")
    def p_value(a: pd.Series, total: pd.Series, size: pd.Series, size_all: pd.Series, mean: pd.Series, phi: pd.Series) -> pd.Series:
        from cytoplan.functions.stats import nb_exact_p

        return pd.Series([nb_exact_p(int(x), int(t - x), s, sa - s, mu, f) for x, t, s, sa, mu, f in zip(a, total, size, size_all, mean, phi, strict=True)])

    return m.select("feature", "cluster", "sum_in", (F.col("sum_all") - F.col("sum_in")).alias("sum_out"), fold.alias("log2fc"), p_value("sum_in", "sum_all", "size_in", "size_all", F.col("sum_all") / F.col("size_all"), "phi").alias("p"))


def cluster_means(coo: DataFrame, groups: DataFrame) -> DataFrame:
    """Mean of each feature in each cluster over its barcodes, zeros included."""
    sizes = groups.groupBy("cluster").agg(F.count("*").alias("cells"))
    return coo.join(groups, "barcode").groupBy("cluster", "feature").agg(F.sum("umi_count").alias("s")).join(F.broadcast(sizes), "cluster").select("cluster", "feature", ratio(F.col("s"), F.col("cells")).alias("mean"))


def relabel_by_size(labels: DataFrame, column: str = "label") -> DataFrame:
    """Labels 1, 2, ... by falling size, ties by the old label."""
    sizes = labels.groupBy(column).agg(F.count("*").alias("n"))
    ranked = sizes.withColumn("cluster", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), F.col(column))))
    return labels.join(F.broadcast(ranked.drop("n")), column)


def control_normalise(counts: DataFrame, controls: list, scale: float) -> DataFrame:
    """floor(x * scale / (1 + the barcode's controls)); without controls the whole barcode divides."""
    inside = F.col("feature").isin(controls) if controls else F.lit(True)
    per = counts.groupBy("barcode").agg(F.coalesce(F.sum(F.when(inside, F.col("umi_count"))), F.lit(0)).alias("c"))
    return counts.join(per, "barcode").select("barcode", "feature", F.floor(F.col("umi_count") * scale / (1 + F.col("c"))).cast("long").alias("value"))


def classify_two_genomes(counts: DataFrame) -> DataFrame:
    """counts(barcode, count0, count1): genome0, genome1 or multiplet by tenth percentiles of the dominant sides."""
    side = counts.agg(
        F.percentile(F.when(F.col("count0") >= F.col("count1"), F.col("count0")), 0.1).alias("t0"), F.percentile(F.when(F.col("count1") > F.col("count0"), F.col("count1")), 0.1).alias("t1")
    ).select(F.coalesce("t0", F.lit(10.0)).alias("t0"), F.coalesce("t1", F.lit(10.0)).alias("t1"))
    both = counts.crossJoin(F.broadcast(side))
    kind = F.when((F.col("count0") >= F.col("t0")) & (F.col("count1") >= F.col("t1")), "multiplet").when(F.col("count0") >= F.col("count1"), "genome0").otherwise("genome1")
    return both.withColumn("call", kind)


def knn(points: DataFrame, k: int, blocks: int | None = None, others: DataFrame | None = None) -> DataFrame:
    """points(id, vec): the k nearest other points of each (squared distance, ties by id), exactly; of others if given.

    Queries meet all points in blocks of about BLOCK rows; a task keeps k rows of each query, and the rest is a top-k merge."""
    others = points if others is None else others
    blocks = blocks or max(8, -(-others.count() // BLOCK))
    left = points.select(F.col("id").alias("q"), F.col("vec").alias("qv"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("qb"))
    right = others.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("pb"))
    left = left.withColumn("pb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = right.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not len(a) or not len(b):
            return pd.DataFrame({"q": [], "id": [], "dist": []})
        x, y, ids = np.stack(a["qv"].to_numpy()).astype(float), np.stack(b["vec"].to_numpy()).astype(float), b["id"].to_numpy()
        for q, v in zip(a["q"].to_numpy(), x, strict=True):
            d = ((y - v) ** 2).sum(1)
            keep = np.flatnonzero(ids != q)
            keep = keep[np.lexsort((ids[keep], d[keep]))[:k]]
            out.append(pd.DataFrame({"q": q, "id": ids[keep], "dist": d[keep]}))
        return pd.concat(out)

    part = left.groupBy("qb", "pb").cogroup(right.groupBy("qb", "pb")).applyInPandas(best, "q long, id long, dist double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("dist", "id"))
    return part.withColumn("rank", rank).where(F.col("rank") <= k)


def mutual_pairs(one: DataFrame, two: DataFrame) -> DataFrame:
    """Pairs a, b of points of two sets that are in each other's lists of the other set."""
    return one.select(F.col("q").alias("a"), F.col("id").alias("b")).join(two.select(F.col("id").alias("a"), F.col("q").alias("b")), ["a", "b"], "left_semi")


def log_scaled(coo: DataFrame, n_barcodes: int) -> DataFrame:
    """barcode, feature, value, zero: log2(1 + count / size factor) of stored counts, centred and scaled by feature over
    all barcodes; zero is what a count of 0 becomes. Zeros are never written out: they enter the moments by their number."""
    logs = normalize_by_umi(coo).withColumn("value", F.log2(1 + F.col("value")))
    m = logs.groupBy("feature").agg((F.sum("value") / n_barcodes).alias("mean"), (F.sum(F.col("value") * F.col("value")) / n_barcodes).alias("square"))
    m = m.select("feature", "mean", F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0))).alias("sd"))
    scaled = lambda v: F.when(F.col("sd") > 0, (v - F.col("mean")) / F.col("sd")).otherwise(0.0)
    return logs.join(m, "feature").select("barcode", "feature", scaled(F.col("value")).alias("value"), scaled(F.lit(0.0)).alias("zero"))


def kmeans_sweep(points: DataFrame, least: int = 2, most: int = 10) -> DataFrame:
    """k, id, cluster for every k."""
    out = None
    for k in range(least, most + 1):
        one = kmeans(points, k).withColumn("k", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out


def mutual_neighbours(edges: DataFrame) -> DataFrame:
    """Pairs a < b that are in each other's lists."""
    back = edges.select(F.col("q").alias("id"), F.col("id").alias("q"))
    return edges.join(back, ["q", "id"], "left_semi").where("q < id").select(F.col("q").alias("a"), F.col("id").alias("b"))


def shared_neighbours(edges: DataFrame, k: int) -> DataFrame:
    """Weight |N(a) and N(b)| / k of pairs with common neighbours."""
    a, b = edges.select(F.col("q").alias("a"), "id"), edges.select(F.col("q").alias("b"), "id")
    return a.join(b, "id").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared")).withColumn("weight", F.col("shared") / F.lit(k))


def batch_effect_score(edges: DataFrame, batches: DataFrame) -> DataFrame:
    """Share of neighbours in the own batch, over the share expected of that batch, by batch and overall."""
    own = batches.select(F.col("id").alias("q"), F.col("batch").alias("qb"))
    same = edges.join(own, "q").join(batches, "id").groupBy("q", "qb").agg(F.avg((F.col("qb") == F.col("batch")).cast("double")).alias("same"))
    sizes = batches.groupBy(F.col("batch").alias("qb")).agg(F.count("*").alias("n"))
    total = batches.agg(F.count("*").alias("total"))
    return same.groupBy("qb").agg(F.avg("same").alias("same")).join(sizes, "qb").crossJoin(F.broadcast(total)).select(F.col("qb").alias("batch"), "same", ratio(F.col("same"), F.col("n") / F.col("total")).alias("score"))


def davies_bouldin(points: DataFrame) -> DataFrame:
    """points(id, vec, cluster): per cluster its spread and worst ratio, whose mean is the index."""
    dims = points.select("id", "cluster", F.posexplode("vec").alias("d", "x"))
    centre = dims.groupBy("cluster", "d").agg(F.avg(F.col("x").cast("double")).alias("c"))
    dist = dims.join(F.broadcast(centre), ["cluster", "d"]).groupBy("cluster", "id").agg(F.sqrt(F.sum(F.pow(F.col("x") - F.col("c"), F.lit(2.0)))).alias("r"))
    spread = dist.groupBy("cluster").agg(F.avg("r").alias("s"))
    a, b = centre.select(F.col("cluster").alias("a"), "d", F.col("c").alias("ca")), centre.select(F.col("cluster").alias("b"), "d", F.col("c").alias("cb"))
    gaps = a.join(b, "d").where("a <> b").groupBy("a", "b").agg(F.sqrt(F.sum(F.pow(F.col("ca") - F.col("cb"), F.lit(2.0)))).alias("gap"))
    both = gaps.join(spread.select(F.col("cluster").alias("a"), F.col("s").alias("sa")), "a").join(spread.select(F.col("cluster").alias("b"), F.col("s").alias("sb")), "b")
    worst = F.max((F.col("sa") + F.col("sb")) / F.greatest("gap", F.lit(1e-9)))
    return both.groupBy("a").agg(F.first("sa").alias("spread"), worst.alias("worst")).withColumnRenamed("a", "cluster")


def mnn_correction(current: DataFrame, pairs: DataFrame, reference: DataFrame, sigma: float = 150.0, blocks: int | None = None) -> DataFrame:
    """Shift of each point of a batch: the mean of its pairs' differences, weighted by a Gaussian of the
    distance to the paired points. pairs(a in current, b in reference). The pairs of a point have one weight and are
    added up first; then points meet paired points in blocks of about BLOCK rows, or as many blocks as given, each of which gives partial sums."""
    ends = pairs.join(reference.select(F.col("id").alias("b"), F.posexplode("vec").alias("d", "x")), "b")
    total = ends.groupBy("a", "d").agg(F.sum(F.col("x").cast("double")).alias("x"), F.count("*").alias("n"))
    total = total.groupBy("a").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("d", "x")))["x"].alias("vb"))
    paired = stage(total.join(current.select(F.col("id").alias("a"), F.col("vec").alias("va")), "a"))
    p, q = (blocks or max(8, -(-df.count() // BLOCK)) for df in (current, paired))
    left = current.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(p)).cast("int").alias("p"), F.explode(F.sequence(F.lit(0), F.lit(q - 1))).alias("q"))
    right = paired.select("va", "vb", "n", F.pmod(F.xxhash64("a"), F.lit(q)).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("p"))

    def partial(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"id": np.array([], int), "w": np.array([], float), "s": np.array([], object)})
        at, by = np.stack(x["vec"].to_numpy()).astype(float), np.stack(y["va"].to_numpy()).astype(float)
        n = y["n"].to_numpy(float)
        shift, square = np.stack(y["vb"].to_numpy()).astype(float) - n[:, None] * by, (by * by).sum(1)
        step, w, s = max(1, CELLS // len(by)), [], []
        for lo in range(0, len(at), step):  # a task holds CELLS weights at once
            one = at[lo : lo + step]
            part = np.exp(-((one * one).sum(1)[:, None] - 2 * one @ by.T + square) / (2 * sigma))
            w.append(part @ n)
            s.append(part @ shift)
        return pd.DataFrame({"id": x["id"].to_numpy(), "w": np.concatenate(w), "s": list(np.concatenate(s))})

    sums = left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(partial, "id long, w double, s array<double>")
    rows = sums.select("id", "w", F.posexplode("s").alias("d", "s"))
    return rows.groupBy("id", "d").agg(F.try_divide(F.sum("s"), F.sum("w")).alias("shift"))


def pca(points: DataFrame, k: int) -> DataFrame:
    """points(id, features vector) projected on k principal components."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    made = points.select("id", array_to_vector(F.transform("vec", lambda x: x.cast("double"))).alias("v"))
    return PCA(k=k, inputCol="v", outputCol="p").fit(made).transform(made).select("id", vector_to_array("p").alias("projection"))


def kmeans(points: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """id, cluster: labels 1.. by falling size."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    made = points.select("id", array_to_vector(F.transform("vec", lambda x: x.cast("double"))).alias("features"))
    got = KMeans(k=k, seed=seed, maxIter=50).fit(made).transform(made).select("id", F.col("prediction").alias("label"))
    return relabel_by_size(got).select("id", "cluster")


def cluster_distances(means: DataFrame, clusters: list) -> np.ndarray:
    """Squared distances between the rows of means(cluster, feature, mean), absent features being 0: tasks add up
    their features, and only a number a pair of clusters leaves them."""
    k = len(clusters)
    index = means.sparkSession.createDataFrame([(c, i) for i, c in enumerate(clusters)], T.StructType([T.StructField("cluster", means.schema["cluster"].dataType), T.StructField("c", T.IntegerType())]))
    rows = means.join(F.broadcast(index), "cluster").groupBy("feature").agg(F.collect_list(F.struct("c", "mean")).alias("m")).select(F.col("m.c").alias("c"), F.col("m.mean").alias("mean"))

    def add(batches):
        total = np.zeros((k, k))
        step = max(1, CELLS // k)
        for b in batches:
            for lo in range(0, b.num_rows, step):
                c, m = (b.column(i).slice(lo, step) for i in (0, 1))
                at = np.repeat(np.arange(len(c)), c.value_lengths().to_numpy(zero_copy_only=False))
                dense = np.zeros((len(c), k))
                dense[at, c.flatten().to_numpy(zero_copy_only=False)] = m.flatten().to_numpy(zero_copy_only=False)
                for i in range(k - 1):
                    total[i, i + 1 :] += ((dense[:, i + 1 :] - dense[:, i : i + 1]) ** 2).sum(0)
        a, b = np.triu_indices(k, 1)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[a, b])], names=["a", "b", "d"])

    out = np.zeros((k, k))
    for r in rows.mapInArrow(add, "a int, b int, d double").groupBy("a", "b").agg(F.sum("d").alias("d")).collect():
        out[r["a"], r["b"]] = out[r["b"], r["a"]] = r["d"]
    return out


def hierarchical_cuts(means: DataFrame) -> DataFrame:
    """Ward clustering of cluster means (as many rows as clusters): cluster, level, group at cuts K-5, K-10, ... 2.

    Centres are never formed: the distances of a merged group follow from those of its parts, so the driver holds a
    number a pair of clusters, however many features there are."""
    spark = means.sparkSession
    means = stage(means.select("cluster", "feature", "mean"))
    clusters = [r["cluster"] for r in means.select("cluster").distinct().orderBy("cluster").collect()]
    k = len(clusters)
    dist = cluster_distances(means, clusters) if k > 1 else np.zeros((k, k))
    size, members = np.ones(k), {i: [i] for i in range(k)}
    wanted = set(range(k - 5, 1, -5)) | ({2} if k > 2 else set())
    later = np.triu(np.ones((k, k), bool), 1)
    out = []
    while len(members) > 1:
        cost = np.where(later, np.outer(size, size) / np.add.outer(size, size) * dist, np.inf)
        a, b = map(int, np.unravel_index(np.argmin(cost), cost.shape))  # of equal costs the least a, then b
        n = size[a] + size[b]
        merged = np.maximum((size[a] * dist[a] + size[b] * dist[b]) / n - size[a] * size[b] * dist[a, b] / (n * n), 0.0)
        dist[a], dist[:, a], dist[a, a], size[a] = merged, merged, 0.0, n
        later[b], later[:, b] = False, False
        members[a] += members.pop(b)
        if len(members) in wanted:
            order = sorted(members.values(), key=lambda g: (-len(g), min(g)))
            out += [(int(clusters[i]), len(members), g + 1) for g, rows in enumerate(order) for i in rows]
    return spark.createDataFrame(out, "cluster int, level int, group int")
