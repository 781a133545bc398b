"""Queries against their SQL on tables made here: many groups, odd keys, files read in several parts."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from cytoplan.operators import matrix
from cytoplan.plans import catalogue

from .test_queries import rows


def against_sql(spark, folder, name, **tables):
    """The query's rows and those of its SQL, over tables written into the folder."""
    con = duckdb.connect()
    for t, made in tables.items():
        pq.write_table(made, folder / f"{t}.parquet")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return rows(catalogue.QUERIES[name](spark, str(folder)).toPandas()), rows(con.execute(catalogue.SQL[name]).df())


def test_piecewise_fit_rounds_and_dates_as_its_sql(spark, tmp_path):
    """An error is rounded once, half a second before midnight is the next day, days before 1970 are cut towards zero."""
    rng, day, kinds, at = random.Random(7), 86_400_000_000, [], []
    for g in range(1500):
        for k in range(rng.randrange(5, 14)):
            for _ in range(rng.randrange(1, 9)):
                kinds.append(f"g{g}")
                at.append((19700 + k) * day + rng.choice([rng.randrange(day), day - 400_000, day - 500_000]))
    kinds += ["old"] * 40
    at += [rng.randrange(-6 * day, 6 * day) for _ in range(40)]
    kinds += ["none"] * 12
    at += [(19700 + k) * day for k in range(9)] + [None] * 3
    got, want = against_sql(spark, tmp_path, "piecewise_fit", events=pa.table({"event_type": kinds, "ts": pa.array(at, pa.timestamp("us"))}))
    assert len(want) == 1502 and got == want


def test_sectioned_config_of_files_read_in_parts(spark, tmp_path):
    """Sections hold over the parts of a file; null and negative keys, null names and names with line ends count."""
    keys = [*range(-400, 20_000), None, None, None]
    names = [f"part {k % 977} {'x' * (k % 30)}" for k in keys[:-3]] + ["zz\nzz", None, "[samples]"]
    names[3], names[4], names[5], names[6] = None, "a,b%0A", "[gene-expression]", "zz\r\nz"
    table = pa.table({"p_partkey": pa.array(keys, pa.int64()), "p_name": names})
    size = "spark.sql.files.maxPartitionBytes"
    try:
        for most in ("128m", "20k"):
            spark.conf.set(size, most)
            got, want = against_sql(spark, tmp_path, "sectioned_config", part=table)
            assert len(want) == 2 and got == want
    finally:
        spark.conf.unset(size)


def plain_cuts(vec):
    """Ward's merges with centres written out: {(cluster, level): group}."""
    groups, out, k = {i: ([i], v, 1) for i, v in enumerate(vec)}, {}, len(vec)
    wanted = {*range(k - 5, 1, -5), 2}
    while len(groups) > 1:
        keys = sorted(groups)
        _, a, b = min((groups[x][2] * groups[y][2] / (groups[x][2] + groups[y][2]) * float(((groups[x][1] - groups[y][1]) ** 2).sum()), x, y) for i, x in enumerate(keys) for y in keys[i + 1 :])
        (ma, ca, na), (mb, cb, nb) = groups.pop(a), groups.pop(b)
        groups[a] = (ma + mb, (ca * na + cb * nb) / (na + nb), na + nb)
        if len(groups) in wanted:
            order = sorted(groups.values(), key=lambda g: (-g[2], min(g[0])))
            out |= {(i * 3 + 1, len(groups)): g + 1 for g, (members, _, _) in enumerate(order) for i in members}
    return out


def test_hierarchical_cuts_keep_features_off_the_driver(spark, monkeypatch):
    """The cuts of the plain definition, with no more sent to the driver than a number a pair of clusters."""
    rng = np.random.default_rng(5)
    vec = rng.integers(1, 60, (17, 400)) * (rng.random((17, 400)) < 0.3)
    vec[4] = vec[9]
    made = [(c * 3 + 1, f, float(x)) for c, row in enumerate(vec) for f, x in enumerate(row) if x]
    means, sent = spark.createDataFrame(made, "cluster int, feature long, mean double"), []
    count = lambda x: sum(map(count, x)) if isinstance(x, tuple | list) else 1
    collect = type(means).collect
    monkeypatch.setattr(type(means), "collect", lambda df: [sent.append(count(r)) or r for r in collect(df)])
    cuts = matrix.hierarchical_cuts(means)
    assert 0 < sum(sent) <= 17 * 17 * 3
    monkeypatch.undo()
    assert {(r["cluster"], r["level"]): r["group"] for r in cuts.collect()} == plain_cuts(vec.astype(float))


def test_neighbour_correction_holds_few_weights_at_once(spark, monkeypatch):
    """The weighted means of a plain sum over all pairs, a hub's included, with blocks of bounded size."""
    rng, held = np.random.default_rng(8), []
    one, two = rng.normal(0, 3, (300, 4)), rng.normal(1, 3, (200, 4))
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 300, 900), rng.integers(0, 200, 900), strict=True)} | {(7, b) for b in range(200)})
    frame = lambda v: spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vec array<double>")
    current, reference, linked = frame(one), frame(two), spark.createDataFrame(pairs, "a long, b long")
    a, b = np.array(pairs).T
    w = np.exp(-((one[:, None] - one[a][None]) ** 2).sum(2) / 30.0)
    want = (w @ (two[b] - one[a])) / w.sum(1)[:, None]
    monkeypatch.setattr(matrix, "BLOCK", 16)
    out = matrix.mnn_correction(current, linked, reference, sigma=15.0)
    got = {(r["id"], r["d"]): r["shift"] for r in out.collect()}
    assert len(got) == want.size and all(abs(got[i, d] - x) < 1e-9 for (i, d), x in np.ndenumerate(want))
    cogroup = type(spark.range(1).groupBy("id")).cogroup
    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "cogroup", lambda g, h: held.extend(x._df.groupBy("p", "q").count().agg({"count": "max"}).first()[0] for x in (g, h)) or cogroup(g, h))
    matrix.mnn_correction(current, linked, reference, sigma=15.0)
    assert max(held) <= 3 * 16
