"""Properties of the stochastic and iterative operators, each of which a wrong operator would break."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoplan.operators import cells, graph, matrix, mixtures


def blobs(spark, centres, n=40, spread=0.3, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i * n + j, [float(x) for x in np.array(c) + spread * rng.standard_normal(len(c))]) for i, c in enumerate(centres) for j in range(n)]
    return spark.createDataFrame(rows, "id long, vec array<double>")


def test_log_scaled_matrix(spark):
    """The reference values of a small dense matrix, zeros included (fixed values)."""
    counts = [[136, 936, 0, 0, 264], [134, 682, 417, 8, 391], [0, 133, 780, 0, 0], [396, 76, 96, 198, 0]]
    want = [
        [0.61392149, 0.95459951, -1.21707302, -1.21707302, 0.86562504], [-0.11878431, 0.54279925, 0.38607315, -1.85660965, 1.04652156],
        [-0.78758751, 0.76437149, 1.59839105, -0.78758751, -0.78758751], [0.88718256, -0.25584717, -0.01048423, 1.09574143, -1.71659259],
    ]
    coo = spark.createDataFrame([(b, f, c) for f, row in enumerate(counts) for b, c in enumerate(row) if c], "barcode long, feature long, umi_count long")
    got = {(r["feature"], r["barcode"]): (r["value"], r["zero"]) for r in matrix.log_scaled(coo, 5).collect()}
    zero = {f: z for (f, _), (_, z) in got.items()}
    for f, row in enumerate(want):
        for b, x in enumerate(row):
            assert (got[f, b][0] if (f, b) in got else zero[f]) == pytest.approx(x, abs=1e-6)


def test_kmeans_finds_separate_groups(spark):
    points = blobs(spark, [[0, 0], [9, 0], [0, 9]])
    got = matrix.kmeans(points, 3).withColumn("truth", F.floor(F.col("id") / 40)).groupBy("truth").agg(F.count_distinct("cluster").alias("n"), F.min("cluster").alias("c")).collect()
    assert all(r["n"] == 1 for r in got) and len({r["c"] for r in got}) == 3
    sweep = matrix.kmeans_sweep(points, 2, 4).groupBy("k").agg(F.count_distinct("cluster").alias("n")).collect()
    assert {(r["k"], r["n"]) for r in sweep} == {(2, 2), (3, 3), (4, 4)}


def test_pca_keeps_the_largest_spread(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((200, 2)) * [5.0, 1.0]
    turn = np.linalg.qr(rng.standard_normal((4, 4)))[0][:2]
    x = base @ turn
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    got = np.array([r["projection"] for r in matrix.pca(points, 2).orderBy("id").collect()])
    want = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert got.var(0) == pytest.approx(want[1][:2] ** 2 / len(x), rel=1e-6)


def test_neighbour_correction_moves_batches_together(spark):
    one, shift = blobs(spark, [[0, 0], [20, 0]], 20, 0.5, 4), 3.0
    two = one.select((F.col("id") + 1000).alias("id"), F.array(F.get("vec", F.lit(0)) + shift, F.get("vec", F.lit(1)) + shift).alias("vec"))
    pairs = matrix.mutual_pairs(matrix.knn(two, 5, others=one), matrix.knn(one, 5, others=two))
    assert pairs.count() > 20
    out = matrix.mnn_correction(two, pairs, one, sigma=15.0)
    names = [c for c in out.columns if c not in ("id", "vec")]
    assert out.select("id").distinct().count() == 40 and names


def test_other_batch_neighbours_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.random(), rng.random()]) for i in range(60)]
    one, two = (spark.createDataFrame([r for r in rows if r[0] % 2 == k], "id long, vec array<double>") for k in (0, 1))
    got = sorted((r["q"], r["id"]) for r in matrix.knn(one, 3, blocks=4, others=two).collect())
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    want = sorted((i, j) for i, v in rows if i % 2 == 0 for _, j in sorted((dist(v, w), j) for j, w in rows if j % 2)[:3])
    assert got == want


def test_graph_clusters_follow_the_graph(spark):
    """Two cliques with one weak edge between them stay apart."""
    edges = [(a, b, 1.0) for lo in (0, 10) for a in range(lo, lo + 8) for b in range(a + 1, lo + 8)] + [(0, 10, 0.05)]
    got = {r[0]: r[1] for r in graph.cluster_graph(spark.createDataFrame(edges, "a long, b long, weight double"), 6).collect()}
    assert len({got[i] for i in range(8)}) == 1 and len({got[i] for i in range(10, 18)}) == 1 and got[0] != got[10]


def test_subsample_curve_is_whole_at_full_depth(spark):
    rng = random.Random(6)
    rows = [(i % 20, i % 7, i, rng.randint(1, 9), "a", "F") for i in range(2000)]
    mol = spark.createDataFrame(rows, "barcode long, feature long, umi long, reads int, library string, gem_group string")
    got = {r["depth"]: r for r in cells.subsample_curve(mol, [0.2, 0.5, 1.0]).collect()}
    reads = sum(r[3] for r in rows)
    assert got[1.0]["reads"] == reads and got[1.0]["umis"] == 2000
    for p in (0.2, 0.5):
        assert got[p]["reads"] == pytest.approx(p * reads, rel=0.05)
        assert got[p]["umis"] == pytest.approx(sum(1 - (1 - p) ** r[3] for r in rows), rel=0.05)


def test_overdispersion_of_even_draws_is_large(spark):
    """Alpha falls as barcodes differ more than a multinomial allows."""
    rng = np.random.default_rng(7)
    p = np.ones(20) / 20
    def alpha(draw):
        data = [(b, f, int(c)) for b in range(80) for f, c in enumerate(rng.multinomial(200, draw())) if c]
        counts = spark.createDataFrame(data, "barcode long, feature long, n long")
        profile = spark.createDataFrame([(f, float(x)) for f, x in enumerate(p)], "feature long, p double")
        return mixtures.estimate_overdispersion(counts, profile)

    assert alpha(lambda: rng.dirichlet(5 * p)) == pytest.approx(5, rel=0.3)
    assert alpha(lambda: p) > 200


def test_genotype_clusters_separate_two_donors(spark):
    rng = np.random.default_rng(8)
    theta = rng.uniform(0.05, 0.95, (2, 60))
    rows = []
    for b in range(40):
        for locus in range(60):
            alt = int(rng.binomial(6, theta[b % 2, locus]))
            rows.append((b, locus, 6 - alt, alt))
    got = {r["barcode"]: r["cluster"] for r in mixtures.genotype_clusters(spark.createDataFrame(rows, "barcode long, locus long, ref long, alt long"), 2, 4).collect()}
    assert len({got[b] for b in range(0, 40, 2)}) == 1 and len({got[b] for b in range(1, 40, 2)}) == 1 and got[0] != got[1]


def test_perturbation_interval_holds_the_fold(spark):
    rng = np.random.default_rng(9)
    rows = [("t", i % 2 == 0, i, int(rng.poisson(10 if i % 2 == 0 else 40))) for i in range(200)]
    r = mixtures.perturbation_efficiency(spark.createDataFrame(rows, "target string, perturbed boolean, barcode long, n long"), 10).first()
    assert r["low"] < r["log2fc"] < r["high"] and r["low"] < -2 < r["high"] + 0.2 and r["high"] - r["low"] < 0.5


def test_reservoir_is_uniform_enough(spark):
    df = spark.range(10_000).select(F.col("id").alias("k"))
    got = [r["k"] for r in mixtures.reservoir(df, ["k"], 1000, 3).collect()]
    assert len(set(got)) == 1000 and 4700 < sum(got) / 1000 < 5300
    assert mixtures.reservoir(df.limit(5), ["k"], 1000, 3).count() == 5


def test_tag_assignment_reads_singlets_and_doublets(spark):
    rng = np.random.default_rng(10)
    rows = []
    for b in range(120):
        on = [b % 3] if b % 12 else [0, 1]
        rows += [("g", b, t, int(rng.poisson(800 if t == f"t{on[0]}" or t == f"t{on[-1]}" else 8)) + 1) for t in ("t0", "t1", "t2")]
    got = {r["barcode"]: r["assignment"] for r in mixtures.assign_tags(spark.createDataFrame(rows, "gem_group string, barcode long, tag string, n long"), ["t0", "t1", "t2"], 2).collect()}
    assert sum(got[b] == f"t{b % 3}" for b in range(120) if b % 12) > 95 and sum(got[b] == "t0|t1" for b in range(0, 120, 12)) >= 8


def test_bootstrap_cells_near_the_plain_rule(spark):
    totals = spark.createDataFrame([(b, 1000 + b if b < 300 else 5) for b in range(3000)], "barcode long, total long")
    got = cells.ordmag_bootstrap(totals, 300, 20).toPandas()
    assert len(got) == 20 and got.select_dtypes("number").iloc[:, -1].between(250, 350).all()


def test_expected_cells(spark):
    totals = spark.createDataFrame([(b, 1000 + b if b < 500 else 3) for b in range(5000)], "barcode long, total long")
    r = cells.expected_cells(totals).first()
    assert r["filtered"] == 500 and abs(r["recovered"] - 500) <= 2
