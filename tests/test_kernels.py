"""Kernels without SQL against plain definitions, and operators on literal rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoplan.functions import align, stats
from cytoplan.operators import cells, counting, mixtures, rows


def plain_score(a, b, local, match=1, mismatch=-1, gap_open=-3, gap_extend=-1):
    """Every alignment as a path of steps, by memory of (place, place, kind of the last step)."""
    from functools import lru_cache

    @lru_cache(None)
    def to_end(i, j, last):
        options = [0] if local or (i == len(a) and j == len(b)) else []
        if i < len(a) and j < len(b):
            options.append((match if a[i] == b[j] else mismatch) + to_end(i + 1, j + 1, "m"))
        if i < len(a):
            options.append((gap_extend if last == "a" else gap_open) + to_end(i + 1, j, "a"))
        if j < len(b):
            options.append((gap_extend if last == "b" else gap_open) + to_end(i, j + 1, "b"))
        return max(options)

    if local:
        return max(to_end(i, j, "m") for i in range(len(a) + 1) for j in range(len(b) + 1))
    return to_end(0, 0, "m")


@pytest.mark.parametrize("local", [True, False])
def test_alignment(local):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice("ACG") for _ in range(rng.randint(0, 8)))
    a, b = [text() for _ in range(200)], [text() for _ in range(200)]
    assert align.scores(a, b, local) == [plain_score(x, y, local) for x, y in zip(a, b, strict=True)]


def test_few_distinct():
    for n, x, m in [(3, 4, 2), (4, 3, 1), (2, 5, 1), (5, 2, 2), (4, 4, 3)]:
        draws = list(itertools.product(range(n), repeat=x))
        assert align.few_distinct(m, x, n) == pytest.approx(sum(len(set(d)) <= m for d in draws) / len(draws))


def test_total_cells():
    cells_in = 70_000
    seen = 90_000 * (1 - (1 - 1 / 90_000) ** cells_in)
    assert align.total_cells(seen, 90_000) == pytest.approx(cells_in)
    with pytest.raises(ValueError):
        align.total_cells(5, 5)


def test_good_turing_above_minus_one():
    """A slope above -1 counts as -1, where the fit leaves the counts as they are."""
    table = {1: 3, 5: 4, 9: 5, 20: 9}
    total = sum(r * n for r, n in table.items())
    got = stats.good_turing(table)
    assert got[0] == 3 / total
    assert sum(got[r] * n for r, n in table.items()) == pytest.approx(1 - got[0])


def test_binomial_quantiles_are_nested_and_binomial():
    rng = np.random.default_rng(1)
    u, n = rng.random(40_000), np.full(40_000, 12)
    by = [cells.binomial_quantiles(u, n, p) for p in (0.1, 0.4, 0.9, 1.0)]
    assert all((x <= y).all() for x, y in itertools.pairwise(by)) and (by[-1] == 12).all()
    for x, p in zip(by, (0.1, 0.4, 0.9), strict=False):
        assert x.mean() == pytest.approx(12 * p, rel=0.02) and x.var() == pytest.approx(12 * p * (1 - p), rel=0.05)


def test_ambient_test_finds_what_is_unlike(spark):
    """Barcodes drawn from the profile have even p; those with one feature have the least p."""
    rng = np.random.default_rng(2)
    p = np.arange(1, 31) / np.arange(1, 31).sum()
    data = []
    for b in range(120):
        for f, c in enumerate(rng.multinomial(300 if b >= 60 else 40, p) if b >= 2 else [0] * 29 + [40]):
            if c:
                data.append((b, f, int(c)))
    coo = spark.createDataFrame(data, "barcode long, feature long, umi_count long")
    totals = coo.groupBy("barcode").agg(F.sum("umi_count").alias("total"))
    got = {r["barcode"]: r["p"] for r in cells.ambient_test(coo, totals, 0, 60, totals.where("total < 100"), 2000).collect()}
    assert len(got) == 60 and got[0] == got[1] == 1 / 2001
    rest = [v for b, v in got.items() if b > 1]
    assert 0.3 < sum(rest) / len(rest) < 0.7 and min(rest) > 1 / 2001


def test_barcode_summary_has_a_row_for_each_type(spark):
    mol = spark.createDataFrame([(1, 10, 5), (1, 10, 2), (1, 20, 1), (2, 10, 4)], "barcode long, feature long, reads int")
    meta = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "barcode long, name string")
    types = spark.createDataFrame([(10, "gene"), (20, "tag")], "feature long, feature_type string")
    got = {(r["barcode"], r["feature_subset"]): (r["num_umis"], r["num_reads"], r["num_features"]) for r in counting.barcode_summary(mol, meta, types).collect()}
    assert got == {(1, "all"): (3, 8, 2), (1, "gene"): (2, 7, 1), (1, "tag"): (1, 1, 1), (2, "all"): (1, 4, 1), (2, "gene"): (1, 4, 1), (2, "tag"): (0, 0, 0)}


def test_concatenated_matrices_need_one_reference(spark):
    coo = spark.createDataFrame([(1, 10, 5)], "barcode long, feature long, umi_count long")
    f, g = (spark.createDataFrame([(x,)], "feature long") for x in (10, 11))
    assert rows.concat_columns(coo, coo, f, f).count() == 2
    with pytest.raises(ValueError):
        rows.concat_columns(coo, coo, f, g)


def test_simplified_line_stays_near():
    """What is left out is within epsilon of the line between its neighbours; the ends stay."""
    rng = random.Random(4)
    points = [(float(i), rng.uniform(0, 10)) for i in range(60)]
    for epsilon in (0.5, 3.0, 20.0):
        kept = mixtures.simplify_line(points, epsilon)
        assert kept[0] == points[0] and kept[-1] == points[-1] and set(kept) <= set(points)
        for (x0, y0), (x1, y1) in itertools.pairwise(kept):
            size = ((x1 - x0) ** 2 + (y1 - y0) ** 2) ** 0.5
            assert all(abs((x1 - x0) * (y0 - y) - (x0 - x) * (y1 - y0)) / size <= epsilon + 1e-9 for x, y in points if x0 < x < x1)
    assert mixtures.simplify_line(points, 1000.0) == [points[0], points[-1]]
