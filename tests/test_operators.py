"""Operators on literal rows, and invariants."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cytoplan.functions import seq as S
from cytoplan.functions import stats as K
from cytoplan.operators import barcodes as B
from cytoplan.operators import cells as C
from cytoplan.operators import counting as N
from cytoplan.operators import graph as G
from cytoplan.operators import matrix as M


def umi(spark, rows):
    return spark.createDataFrame([(1, g, u, n) for u, g, n in rows], "barcode long, gene long, umi string, reads long")


def corrected(df):
    return {(r["umi"], r["gene"]): r["corrected"] for r in B.correct_umis(df).collect() if r["umi"] != r["corrected"]}


def test_umi_correction_rules(spark):
    assert corrected(umi(spark, [("AAAA", 0, 3), ("AAAT", 0, 2), ("AAAA", 1, 1), ("AATT", 1, 1)])) == {("AAAT", 0): "AAAA"}
    assert corrected(umi(spark, [("CCCC", 0, 1), ("CGCC", 0, 1)])) == {("CCCC", 0): "CGCC"}
    chain = corrected(umi(spark, [("AAAA", 0, 5), ("AAAT", 0, 3), ("AATT", 0, 1)]))
    assert chain == {("AAAT", 0): "AAAA", ("AATT", 0): "AAAT"}  # one hop only


def test_dedup_keeps_order_of_rules(spark):
    # AAAT moves one read to AAAA before support is judged on both genes
    got = {(r["gene"], r["umi"]): r["reads"] for r in B.dedup_umis(umi(spark, [("AAAA", 0, 3), ("AAAT", 0, 2), ("AAAA", 1, 3)])).collect()}
    assert got == {(0, "AAAA"): 5}
    assert B.dedup_umis(umi(spark, [("GGGG", 0, 2), ("GGGG", 1, 2)])).count() == 0  # a tie drops both


def test_sequences(spark):
    df = spark.createDataFrame([("ACGT",), ("NNNN",), ("A",), ("",)], "s string")
    r = df.select("s", S.reverse_complement(F.col("s")).alias("rc"), F.size(S.one_substitutions(F.col("s"))).alias("n"), S.is_homopolymer(F.col("s")).alias("h"), S.translate_codons(F.lit("ATGTAA")).alias("aa")).collect()
    assert [x["rc"] for x in r] == ["ACGT", "NNNN", "T", ""]
    assert [x["n"] for x in r] == [12, 16, 3, 0]
    assert [x["h"] for x in r] == [False, True, True, False] and r[0]["aa"] == "M*"


def test_one_insertion_and_deletion(spark):
    r = spark.range(1).select(S.one_deletions(F.lit("AAC")).alias("d"), S.one_insertions(F.lit("A")).alias("i"), S.suffix_overlap(F.lit("GGTAC"), F.lit("TACG"), 2).alias("o")).first()
    assert set(r["d"]) == {"AC", "AA"} and set(r["i"]) == {"AA", "CA", "GA", "TA", "AC", "AG", "AT"} and r["o"] == 3


def test_pattern():
    assert S.pattern_regex("5PNN(BC)AC3P", 4) == "^[ACGTN][ACGTN]([ACGTN]{4})AC$"
    with pytest.raises(ValueError):
        S.pattern_regex("ACGT", 3)


def test_whitelist_one_n(spark):
    w = spark.createDataFrame([("AAAA", "AAAA"), ("AACA", "AACA")], "seq string, canonical string")
    q = spark.createDataFrame([("AAAA",), ("AANA",), ("CCCC",), ("ANNA",)], "seq string")
    assert {r["seq"]: r["match"] for r in B.whitelist_match(q, w).collect()} == {"AAAA": "AAAA", "AANA": "AAAA", "CCCC": None, "ANNA": None}


def test_nx(spark):
    df = spark.createDataFrame([(1, v) for v in range(2, 11)], "g long, v long")
    assert B.nx(df, ["g"], "v", 0.5).first()["nx"] == 8
    assert B.nx(df.limit(0), ["g"], "v", 0.5).count() == 0


def test_feature_distribution_of_zeros(spark):
    df = spark.createDataFrame([("t", 1, 0), ("t", 2, 0), ("u", 3, 1), ("u", 4, 3)], "feature_type string, feature long, n long")
    assert {r["feature"]: r["proportion"] for r in B.feature_distribution(df).collect()} == {1: 0.5, 2: 0.5, 3: 0.25, 4: 0.75}


def test_interval_join_is_complete(spark):
    rng = np.random.default_rng(0)
    p = [(i, 0, int(a), int(a + b)) for i, (a, b) in enumerate(zip(rng.integers(0, 300, 60), rng.integers(0, 40, 60), strict=True))]
    q = [(0, int(a), int(a + b), f"i{k}") for k, (a, b) in enumerate(zip(rng.integers(0, 300, 50), rng.integers(0, 60, 50), strict=True))]
    points = spark.createDataFrame(p, "id long, chrom long, start long, end long")
    spans = spark.createDataFrame(q, "chrom long, lo long, hi long, name string")
    want = sorted((i, n) for i, _, s, e in p for _, lo, hi, n in q if s <= hi and lo <= e)
    assert sorted((r["id"], r["name"]) for r in N.interval_join(points, spans, 16).collect()) == want


def test_thinning_is_bounded_and_repeatable(spark):
    mol = spark.range(2000).selectExpr("id % 10 barcode", "id % 50 feature", "id umi", "cast(id % 20 + 1 as int) reads", "case when id % 2 = 0 then 'a' else 'b' end library", "'x' gem_group")
    rates = spark.createDataFrame([("a", 0.25), ("b", 1.0)], "library string, frac_kept double")
    rows = C.thin(mol, rates).collect()
    assert all(r["kept"] <= r["reads"] for r in rows)
    assert sorted((r["umi"], r["kept"]) for r in rows) == sorted((r["umi"], r["kept"]) for r in C.thin(mol.repartition(7), rates).collect())
    a = [r for r in rows if r["library"] == "a"]
    assert abs(sum(r["kept"] for r in a) / 10000 - 0.25) < 0.03
    assert sum(r["kept"] for r in rows if r["library"] == "b") == sum(i % 20 + 1 for i in range(1, 2000, 2))


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102)], "a long, b long")
    got = {r["node"]: r["comp"] for r in G.components(edges).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and {got[i] for i in (100, 101, 102)} == {100}


def test_graph_clusters_find_cliques(spark):
    edges = [(a + k, b + k, 1.0) for k in (0, 10) for a in range(6) for b in range(a + 1, 6)] + [(5, 10, 0.1)]
    got = {r["node"]: r["cluster"] for r in G.cluster_graph(spark.createDataFrame(edges, "a long, b long, weight double"), 8).collect()}
    assert len({got[i] for i in range(6)}) == 1 and len({got[i] for i in range(10, 16)}) == 1 and got[0] != got[10]


def test_knn_is_exact(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    got = {}
    for r in M.knn(df, 4).collect():
        got.setdefault(r["q"], {})[r["rank"]] = r["id"]
    for i in range(40):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        assert [got[i][k] for k in range(1, 5)] == np.argsort(d)[:4].tolist()


def test_merge_is_commutative_and_keeps_sums(spark):
    a = spark.createDataFrame([(1, 1, 2), (1, 2, 3)], "barcode long, feature long, umi_count long")
    b = spark.createDataFrame([(1, 1, 5), (2, 2, 1)], "barcode long, feature long, umi_count long")
    x, y = (sorted(map(tuple, N.merge_matrices(*p).collect())) for p in ((a, b), (b, a)))
    assert x == y == [(1, 1, 7), (1, 2, 3), (2, 2, 1)]


def test_beta_cdf_against_binomial_sums():
    for a in range(1, 8):
        for b in range(1, 8):
            for x in (0.0, 0.1, 0.5, 0.925, 1.0):
                n = a + b - 1
                want = sum(math.comb(n, j) * x**j * (1 - x) ** (n - j) for j in range(a, n + 1))
                assert abs(K.beta_cdf(x, a, b) - want) < 1e-10


def test_nb_exact_test():
    assert K.nb_exact_p(0, 0, 1, 1, 1, 0.1) == 1.0
    assert K.nb_exact_p(10, 10, 1, 1, 10, 0.1) > 0.9
    assert K.nb_exact_p(60, 2, 1, 1, 30, 0.05) < 0.001
    assert abs(K.nb_exact_p(30, 12, 1, 1, 20, 0.1) - K.nb_exact_p(12, 30, 1, 1, 20, 0.1)) < 1e-9


def test_good_turing_sums_to_one():
    table = {1: 120, 2: 40, 3: 24, 4: 13, 5: 15, 6: 5, 7: 11, 8: 2, 9: 2, 10: 1, 12: 3, 14: 2}
    p = K.good_turing(table)
    total = sum(r * n for r, n in table.items())
    assert abs(p[0] - 120 / total) < 1e-12
    assert abs(p[0] + sum(p[r] * n for r, n in table.items()) - 1) < 1e-9


def test_two_gaussians_separate():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.2, 300), rng.normal(3, 0.2, 100)])
    assert ((K.two_gaussians(x)[2] > 0.5) == (np.arange(400) >= 300)).mean() > 0.99


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(1e-6, 1), min_size=1, max_size=30))
def test_bh_is_monotone(p):
    p = np.array(p)
    order = np.argsort(-p)
    n = len(p)
    adjusted = np.minimum(1, np.minimum.accumulate(p[order] * n / np.arange(n, 0, -1)))
    assert (np.diff(adjusted) <= 1e-12).all() and (adjusted + 1e-12 >= p[order]).all()


@settings(max_examples=30, deadline=None)
@given(st.floats(0.01, 3), st.integers(1, 8))
def test_klets_sum_to_one(rate, k):
    assert abs(sum(C.klet_fractions(rate, k)) - 1) < 1e-9


def test_depth_grid():
    assert C.depth_grid(10, 4) == [2, 5, 8, 10] and C.depth_grid(0, 3) == []


def test_fastq_source(spark, tmp_path):
    import gzip

    from cytoplan.sources import formats

    with gzip.open(tmp_path / "S_S1_L001_R1_001.fastq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\nIIII\n@r2\nNN\n+\n##\n")
    formats.register(spark)
    df = spark.read.format("fastq").load(str(tmp_path))
    rows = df.orderBy("record").select("header", "seq", "qual", formats.fastq_name(F.col("file"))["lane"].alias("lane")).collect()
    assert [tuple(r) for r in rows] == [("r1 x", "ACGT", "IIII", "001"), ("r2", "NN", "##", "001")]


def test_csv_checks(spark, tmp_path):
    from cytoplan.sources import formats

    (tmp_path / "a.csv").write_text("#note\nid,name\n1,x\n")
    assert formats.read_csv_checked(spark, str(tmp_path / "a.csv"), "id long, name string", ["id"]).collect()[0]["id"] == 1
    with pytest.raises(ValueError):
        formats.read_csv_checked(spark, str(tmp_path / "a.csv"), "id long, name string, z int", ["z"])


def test_rescue_and_signatures(spark):
    from cytoplan.operators import stages as G

    rec = [("a", 0, False, []), ("a", 1, False, [7]), ("a", 2, False, [7]), ("b", 0, True, [7]), ("b", 1, False, [7]), ("c", 0, False, [7]), ("c", 1, False, [8]), ("d", 0, False, [7, 8]), ("e", 0, False, [])]
    got = G.rescued_alignments(spark.createDataFrame(rec, "read string, place int, unique boolean, genes array<int>")).collect()
    assert {(r["read"], r["place"]): r["state"] for r in got} == {
        ("a", 0): "demoted", ("a", 1): "promoted", ("a", 2): "demoted", ("b", 0): "unique", ("b", 1): "kept", ("c", 0): "kept", ("c", 1): "kept", ("d", 0): "kept", ("e", 0): "kept",
    }
    # chains 1 and 2 in 100 cells outweigh chains 2 and 3 in 4, not in 5; one chain alone has no signature
    sub = [(0, 0, c, 100) for c in (1, 2)] + [(0, 1, c, 4) for c in (2, 3)] + [(0, 2, 1, 1)] + [(1, 0, c, 100) for c in (1, 2)] + [(1, 1, c, 5) for c in (2, 3)]
    bad = G.signature_filter(spark.createDataFrame(sub, "clonotype int, exact int, chain int, cells int")).collect()
    assert [(r["clonotype"], r["exact"]) for r in bad] == [(0, 1)]


def test_receptor_and_chemistry(spark):
    from cytoplan.operators import stages as G

    ref = spark.createDataFrame([("TR", "AACCG"), ("IG", "GGTTA"), ("IG", "AACCT")], "class string, seq string")
    lib = [("t", "xAACCGx")] * 4 + [("t", "xGGTTAx")] + [("i", "GGTTA")] + [("n", "AAAAA")] * 3 + [("u", "AACCG"), ("u", "GGTTA"), ("u", "AACCGGTTA"), ("u", "AA")]
    reads = spark.createDataFrame([(i, n, q) for i, (n, q) in enumerate(lib)], "id int, library string, seq string")
    got = {r["library"]: (r["n_reads"], r["tr_reads"], r["ig_reads"], r["receptor"]) for r in G.detect_receptor(reads, ref, 5, "library").collect()}
    assert got == {"t": (5, 4, 1, "TR"), "i": (1, 0, 1, "IG"), "n": (3, 0, 0, "none"), "u": (4, 1, 1, "unclear")}
    wl = spark.createDataFrame([("AAA",), ("CCC",)], "seq string")
    seqs = spark.createDataFrame([("GAAAT",), ("GCCC",), ("AAA",), ("TTT",)], "seq string")
    found = {r["name"]: (r["n_reads"], r["n_hits"], r["chosen"]) for r in G.detect_chemistry(seqs, [("x", 1, 3), ("y", 0, 3)], wl, 4, 0.05, 2.0).collect()}
    assert found == {"x": (4, 2, True), "y": (4, 1, False)}
    tie = G.detect_chemistry(seqs, [("x", 1, 3), ("z", 1, 3)], wl, 4, 0.05, 2.0).where("chosen")
    assert tie.count() == 0


def test_split_parts(spark):
    from cytoplan.operators import stages as G

    m = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 20), (2, 21)], "clonotype int, node int")
    links = spark.createDataFrame([(10, 11), (12, 20), (20, 21)], "a int, b int")
    assert sorted((r["node"], r["part"]) for r in G.split_clonotypes(m, links).collect()) == [(10, 10), (11, 10), (12, 12), (20, 20), (21, 20)]
    rows = [(i, 0, 2, False) for i in range(2996)] + [(9000 + i, 1, 1, False) for i in range(2)] + [(9100 + i, 2, 1, True) for i in range(2)]
    x = G.split_singles(spark.createDataFrame(rows, "barcode int, exact int, chains int, joined boolean"))
    assert sorted(r["part"] for r in x.where("part is not null").collect()) == [9000, 9001]
