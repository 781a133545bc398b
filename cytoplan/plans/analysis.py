"""Queries: matrix statistics, neighbours, clustering, cells, depth, tags, receptors, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats as K
from ..operators import cells as C
from ..operators import graph as G
from ..operators import matrix as M
from ..operators import vdj as V
from . import roles as R
from .registry import query


def _n_barcodes(s, d):
    return R.table(s, d, "supplier").count()


@query("coo", "select feature, round(sum(umi_count) / n, 6) mean, round(sum(umi_count * umi_count) / n - (sum(umi_count) / n) ** 2, 6) \"var\" from coo, (select count(*) n from supplier) group by feature, n")
def mean_var_per_feature(s, d):
    return M.mean_var(R.coo(s, d), _n_barcodes(s, d)).select("feature", F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"))


@query("coo bt", "select barcode, feature, round(umi_count * greatest(m, 1) / total, 6) \"value\" from coo join bt using (barcode), (select median(total) m from bt)")
def normalize_by_umi(s, d):
    return M.normalize_by_umi(R.coo(s, d)).withColumn("value", F.round("value", 6))


@query("coo", "with i as (select feature, ln(n + 1.0) - ln(1.0 + count(*)) idf from coo, (select count(*) n from supplier) group by feature, n) select barcode, feature, round(umi_count * idf, 6) \"value\" from coo join i using (feature)")
def normalize_by_idf(s, d):
    return M.normalize_by_idf(R.coo(s, d), _n_barcodes(s, d)).withColumn("value", F.round("value", 6))


@query("bt", "select barcode, round(total / (select median(total) from bt), 6) size_factor from bt")
def size_factors(s, d):
    return M.size_factors(R.coo(s, d)).withColumn("size_factor", F.round("size_factor", 6))


@query("coo", """
with m as (select feature, sum(umi_count) / n mean, sum(umi_count * umi_count) / n - (sum(umi_count) / n) ** 2 v from coo, (select count(*) n from supplier) group by feature, n),
x as (select feature, mean, v / mean d from m where mean > 0), e as (select quantile_cont(mean, [i / 20.0 for i in range(1, 20)]) e from x),
b as (select x.*, len([c for c in e if c < mean]) bin from x, e),
o as (select *, median(d) over (partition by bin) mid from b), a as (select *, abs(d - mid) off from o), f as (select *, median(off) over (partition by bin) mad from a)
select feature, bin, round(d, 6) dispersion, round(case when mad > 0 then (d - mid) / mad else 0 end, 4) normalized from f""".replace("[i / 20.0 for i in range(1, 20)]", str([i / 20 for i in range(1, 20)])))
def normalized_dispersion(s, d):
    return M.normalized_dispersion(M.mean_var(R.coo(s, d), _n_barcodes(s, d))).select("feature", "bin", F.round("dispersion", 6).alias("dispersion"), F.round("normalized", 4).alias("normalized"))


def _clusters(s, d):
    return R.table(s, d, "supplier").select(F.col("s_suppkey").alias("barcode"), (F.col("s_nationkey") % 3 + 1).cast("int").alias("cluster"))


@query("coo bt", """
with g as (select s_suppkey barcode, s_nationkey % 3 + 1 cluster from supplier), sf as (select barcode, cluster, total / (select median(total) from bt) f from bt join g using (barcode)),
i as (select feature, cluster, sum(umi_count) c from coo join g using (barcode) group by 1, 2), w as (select feature, sum(umi_count) t from coo group by 1), z as (select cluster, sum(f) f, count(*) n from sf group by 1), a as (select sum(f) fa from sf)
select feature, cluster, coalesce(c, 0)::bigint sum_in, (t - coalesce(c, 0))::bigint sum_out, n cells_in, round(log2((1 + coalesce(c, 0)) / (1 + f)) - log2((1 + t - coalesce(c, 0)) / (1 + fa - f)), 6) log2fc
from w cross join z cross join a left join i using (feature, cluster)""")
def diffexp_moments(s, d):
    m = M.group_moments(R.coo(s, d), _clusters(s, d))
    fold = F.log2((1.0 + F.col("sum_in")) / (1.0 + F.col("size_in"))) - F.log2((1.0 + F.col("sum_all") - F.col("sum_in")) / (1.0 + F.col("size_all") - F.col("size_in")))
    return m.select("feature", "cluster", "sum_in", (F.col("sum_all") - F.col("sum_in")).alias("sum_out"), "cells_in", F.round(fold, 6).alias("log2fc"))


@query()
def diffexp_pvalues(s, d):
    x = M.differential_expression(R.coo(s, d), _clusters(s, d))
    return x.withColumn("p_adjusted", K.bh_adjusted(F.col("p"), ["cluster"], "feature"))


@query("coo", "with g as (select s_suppkey barcode, s_nationkey % 3 + 1 cluster from supplier) select cluster, feature, round(sum(umi_count) / n, 6) mean from coo join g using (barcode) join (select cluster, count(*) n from g group by 1) using (cluster) group by cluster, feature, n")
def cluster_means(s, d):
    return M.cluster_means(R.coo(s, d), _clusters(s, d)).withColumn("mean", F.round("mean", 6))


@query()
def hierarchical_cuts(s, d):
    groups = R.table(s, d, "supplier").select(F.col("s_suppkey").alias("barcode"), F.col("s_nationkey").alias("cluster"))
    return M.hierarchical_cuts(M.cluster_means(R.coo(s, d), groups))


@query("", """
with t as (select event_type b, user_id i, exp(-abs(sum("value")) / 500) p from events group by 1, 2), r as (select *, row_number() over (partition by b order by p, i) k, count(*) over (partition by b) n from t)
select b event_type, i user_id, round(least(1, min(p * n / k) over (partition by b order by p desc, i desc rows between unbounded preceding and current row)), 6) p_adjusted from r""")
def bh_adjust(s, d):
    p = R.table(s, d, "events").groupBy("event_type", "user_id").agg(F.exp(-F.abs(F.sum("value")) / 500).alias("p"))
    return p.select("event_type", "user_id", F.round(K.bh_adjusted(F.col("p"), ["event_type"], "user_id"), 6).alias("p_adjusted"))


_KNN = """
n as (select a.id q, b.id, list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: (z[1]::double - z[2]::double) ** 2)) dist from pt a join pt b on a.id <> b.id),
k as (select q, id, dist, row_number() over (partition by q order by dist, id) "rank" from n qualify "rank" <= 5)"""


@query("pt", f"with {_KNN} select q, id, round(dist, 4) dist, \"rank\" from k")
def knn(s, d):
    return M.knn(R.points(s, d).select("id", "vec"), 5).select("q", "id", F.round("dist", 4).alias("dist"), "rank")


@query("pt", f"with {_KNN} select a.q a, a.id b from k a join k b on a.q = b.id and a.id = b.q where a.q < a.id")
def mutual_nn(s, d):
    return M.mutual_neighbours(M.knn(R.points(s, d).select("id", "vec"), 5))


@query("pt", f"with {_KNN} select x.q a, y.q b, count(*) shared, count(*) / 5.0::double weight from k x join k y on x.id = y.id and x.q < y.q group by 1, 2")
def snn(s, d):
    return M.shared_neighbours(M.knn(R.points(s, d).select("id", "vec"), 5), 5)


@query("pt", f"""with {_KNN}, z as (select k.q, x.cluster qb, avg((x.cluster = y.cluster)::int) same from k join pt x on x.id = k.q join pt y on y.id = k.id group by 1, 2), c as (select cluster qb, count(*) n from pt group by 1)
select qb batch, round(avg(same), 6) same, round(avg(same) / (n / (select count(*) from pt)), 6) score from z join c using (qb) group by qb, n""")
def batch_effect_score(s, d):
    p = R.points(s, d)
    return M.batch_effect_score(M.knn(p.select("id", "vec"), 5), p.select("id", F.col("cluster").alias("batch"))).select("batch", F.round("same", 6).alias("same"), F.round("score", 6).alias("score"))


@query("pt", """
with x as (select id, cluster, unnest(vec)::double x, unnest(range(64)) d from pt), c as (select cluster, d, avg(x) c from x group by 1, 2),
r as (select cluster, id, sqrt(sum((x - c) ** 2)) r from x join c using (cluster, d) group by 1, 2), s as (select cluster, avg(r) s from r group by 1),
g as (select a.cluster a, b.cluster b, sqrt(sum((a.c - b.c) ** 2)) g from c a join c b on a.d = b.d and a.cluster <> b.cluster group by 1, 2)
select a cluster, round(any_value(x.s), 5) spread, round(max((x.s + y.s) / g), 4) worst from g join s x on x.cluster = a join s y on y.cluster = b group by 1""")
def davies_bouldin(s, d):
    return M.davies_bouldin(R.points(s, d)).select("cluster", F.round("spread", 5).alias("spread"), F.round("worst", 4).alias("worst"))


@query()
def mnn_correction(s, d):
    p = R.points(s, d).select("id", F.transform("vec", lambda x: x.cast("double")).alias("vec"))
    even, odd = p.where("id % 2 = 0"), p.where("id % 2 = 1")
    pairs = M.mutual_pairs(M.knn(even, 10, others=odd), M.knn(odd, 10, others=even))
    return M.mnn_correction(even, pairs, odd)


@query()
def kmeans(s, d):
    return M.kmeans(R.points(s, d), 5)


@query()
def pca(s, d):
    return M.pca(R.points(s, d), 4)


@query()
def graph_clusters(s, d):
    return G.cluster_graph(M.shared_neighbours(M.knn(R.points(s, d).select("id", "vec"), 8), 8).select("a", "b", F.col("weight").cast("double").alias("weight")), 6)


@query("pt", "with n as (select cluster label, count(*) c from pt group by 1), r as (select label, row_number() over (order by c desc, label) cluster from n) select id, r.cluster from pt join r on pt.cluster = r.label")
def relabel_by_size(s, d):
    return M.relabel_by_size(R.points(s, d).select("id", F.col("cluster").alias("label"))).select("id", "cluster")


@query("coo feat", """
with c as (select barcode, coalesce(sum(umi_count) filter (genome = 'g0'), 0)::bigint count0, coalesce(sum(umi_count) filter (genome = 'g1'), 0)::bigint count1 from coo join feat using (feature) group by 1),
t as (select coalesce(quantile_cont(count0, 0.1) filter (count0 >= count1), 10) t0, coalesce(quantile_cont(count1, 0.1) filter (count1 > count0), 10) t1 from c)
select barcode, count0, count1, case when count0 >= t0 and count1 >= t1 then 'multiplet' when count0 >= count1 then 'genome0' else 'genome1' end "call" from c, t""")
def multigenome_classify(s, d):
    x = R.coo(s, d).join(F.broadcast(R.features(s, d).select("feature", "genome")), "feature").groupBy("barcode").pivot("genome", ["g0", "g1"]).agg(F.sum("umi_count"))
    counts = x.select("barcode", F.coalesce("g0", F.lit(0)).alias("count0"), F.coalesce("g1", F.lit(0)).alias("count1"))
    return M.classify_two_genomes(counts).select("barcode", "count0", "count1", "call")


@query("coo", "with c as (select barcode, coalesce(sum(umi_count) filter (feature in (1, 2, 3, 4, 5)), 0) c from coo group by 1) select barcode, feature, floor(umi_count * 100.0 / (1 + c))::bigint \"value\" from coo join c using (barcode)")
def isotype_normalise(s, d):
    return M.control_normalise(R.coo(s, d), [1, 2, 3, 4, 5], 100.0)


@query("tot", "select barcode, total, row_number() over (order by total desc, barcode desc) \"rank\" from tot")
def barcode_rank(s, d):
    return C.barcode_ranks(R.totals(s, d))


@query("tot", "select barcode, total from tot where total > 0 order by total desc, barcode desc limit 100")
def force_cells(s, d):
    return C.force_cells(R.totals(s, d), 100)


@query("tot", "with t as (select greatest(1, round_even(min(total) * 0.1, 0)) cut from (select total from tot where total > 0 order by total desc limit 5)) select barcode, total from tot, t where total >= cut")
def ordmag_given_expected(s, d):
    return C.ordmag(R.totals(s, d), 500)


@query()
def ordmag_bootstrap(s, d):
    return C.summarize_bootstrap(C.ordmag_bootstrap(R.totals(s, d), 500, 20))


@query("tot", """
with r as (select barcode, total, row_number() over (order by total desc, barcode desc) r from tot where total > 0 qualify r <= 800), n as (select *, lead(total) over (order by r) nx from r),
g as (select r, round((ln(nx) - ln(total)) / (ln(r + 1) - ln(r)), 9) slope from n where nx is not null and r >= 50), b as (select r cut from g order by slope, r limit 1)
select barcode, total, r "rank" from r, b where r <= cut""")
def gradient_cells(s, d):
    return C.gradient_cutoff(R.totals(s, d), 50, 800)


@query()
def ambient_test(s, d):
    coo = R.coo(s, d)
    t = coo.groupBy("barcode").agg(F.sum("umi_count").alias("total"))
    n = t.count()
    return C.ambient_test(coo, t, n // 2, n, t.where("total > 0"))


@query("coo", "select barcode, sum(umi_count)::bigint total, coalesce(sum(umi_count) filter (feature % 40 = 0), 0)::bigint mito, round(coalesce(sum(umi_count) filter (feature % 40 = 0), 0) / sum(umi_count), 6) mito_frac, coalesce(sum(umi_count) filter (feature % 40 = 0), 0) / sum(umi_count) <= 0.025 keep from coo group by 1")
def mito_filter(s, d):
    mito = R.features(s, d).where("feature % 40 = 0").select("feature")
    return C.mito_filter(R.coo(s, d), mito, 0.025).withColumn("mito_frac", F.round("mito_frac", 6))


@query("tot", "select * from (select *, barcode % 37 \"partition\", count(*) over (partition by barcode % 37) n from tot where total > 900) where n > 20")
def high_occupancy(s, d):
    return C.high_occupancy(R.totals(s, d).where("total > 900"), F.col("barcode") % 37, 20)


@query("mol", """
with c as (select feature % 10 feature, barcode, sum(reads)::bigint n from mol group by all), u as (select feature from c group by 1 having sum(n) >= 1000), k as (select * from c semi join u using (feature)),
p as (select barcode, count(*) n_features from (select *, row_number() over (partition by feature order by n desc, barcode) r from k) where r <= 20 group by 1),
t as (select barcode, sum(n)::bigint total from k group by 1 order by total desc, barcode limit 20)
select barcode, total, n_features from p join t using (barcode), (select count(*) k from u) where k >= 5 and n_features >= round(k * greatest(0.6, 1.1 - 0.02 * k))""".replace("group by all", "group by feature % 10, barcode"))
def antibody_aggregates(s, d):
    c = R.molecules(s, d).groupBy((F.col("feature") % 10).alias("feature"), "barcode").agg(F.sum("reads").alias("n"))
    return C.aggregate_barcodes(c, 20, 5)


@query("tot", "with h as (select total from tot order by total desc, barcode limit 100), q as (select quantile_cont(total, 0.75) + 1.5 * (quantile_cont(total, 0.75) - quantile_cont(total, 0.25)) l from h) select barcode, total from tot, q where total > l and total >= 1000")
def outlier_barcodes(s, d):
    return C.outlier_barcodes(R.totals(s, d), 1.5)


@query("mol cell", """
with x as (select library, gem_group library_type, coalesce(sum(reads) filter (c.barcode is not null), 0)::bigint r, count(distinct c.barcode) n from mol left join cell c using (barcode) group by 1, 2),
p as (select *, r / n rpc from x) select library, library_type, round(rpc, 6) rpc, round(least(1, coalesce(min(rpc) filter (rpc > 0) over (partition by library_type) / rpc, 0)), 6) frac_kept from p""")
def depth_rates(s, d):
    m = R.molecules(s, d).join(R.cells(s, d).withColumn("cell", F.lit(True)), "barcode", "left")
    lib = m.groupBy("library", F.col("gem_group").alias("library_type")).agg(F.coalesce(F.sum(F.when(F.col("cell"), F.col("reads"))), F.lit(0)).alias("reads"), F.count_distinct(F.when(F.col("cell"), F.col("barcode"))).alias("cells"))
    return C.depth_rates(lib).select("library", "library_type", F.round("rpc", 6).alias("rpc"), F.round("frac_kept", 6).alias("frac_kept"))


@query()
def depth_thinning(s, d):
    m = R.molecules(s, d)
    lib = m.groupBy("library").agg(F.sum("reads").alias("reads"), F.count_distinct("barcode").alias("cells")).withColumn("library_type", F.lit("all"))
    return C.thin(m, C.depth_rates(lib)).groupBy("library").agg(F.count("*").alias("molecules"), F.sum("kept").alias("kept"))


@query()
def subsample_curve(s, d):
    return C.subsample_curve(R.molecules(s, d), [0.1, 0.25, 0.5, 1.0])


@query("tg", """
with t as (select feature tag, sum(n)::bigint total, sum(n * n) q from tg group by 1), c as (select count(distinct barcode) c from tg),
d as (select a.feature a, b.feature b, sum(a.n * b.n) dot from tg a join tg b on a.barcode = b.barcode and a.feature < b.feature group by 1, 2),
w as (select distinct case when x.total < y.total or (x.total = y.total and a > b) then a else b end tag from d join t x on x.tag = a join t y on y.tag = b, c
  where (c * dot - x.total * y.total) / sqrt((c * x.q - x.total::double ** 2) * (c * y.q - y.total::double ** 2)) >= 0.02)
select tag, total, total < 100 or total * 50 < max(total) over () or w.tag is not null contaminant from t left join w using (tag)""")
def contaminant_tags(s, d):
    return C.contaminant_tags(R.tags(s, d).withColumnRenamed("feature", "tag"), 100, 50, 0.02)


@query()
def feature_presence(s, d):
    return C.presence_calls(R.tags(s, d).select("feature", "barcode", "n"))


@query("tg", "select barcode, count(*) num_features, string_agg(feature, '|' order by feature) feature_call, string_agg(n::varchar, '|' order by feature) num_umis from tg where n >= 14 group by 1")
def feature_calls_table(s, d):
    return C.feature_calls(R.tags(s, d).where("n >= 14"))


@query("tg", """
with c as (select barcode, string_agg(feature, '|' order by feature) feature_call, sum(n) u from tg where n >= 16 group by 1)
select feature_call, count(*) num_cells, round(median(u), 6) median_umis, round(stddev_pop(u), 6) stddev_umis, round(100.0 * count(*) / sum(count(*)) over (), 6) pct_cells from c group by 1""")
def feature_calls_summary(s, d):
    return C.calls_summary(R.tags(s, d).where("n >= 16")).withColumns({c: F.round(c, 6) for c in ("median_umis", "stddev_umis", "pct_cells")})


@query("tg", """
with o as (select barcode, count(distinct feature) k, min(feature) t from tg where n >= 18 group by 1)
select barcode, k n_tags, case when k > 1 then 'multiplet' else 'sample_' || t end assignment, barcode % 3 = 0 is_cell from o""")
def sample_assignment(s, d):
    t = R.tags(s, d).where("n >= 18").select("barcode", F.col("feature").alias("tag"))
    named = t.select("tag").distinct().withColumn("sample", F.concat(F.lit("sample_"), "tag"))
    return C.assign_samples(t, named, t.select("barcode").where("barcode % 3 = 0"))


@query("tg", """
with c as (select barcode, coalesce(sum(n) filter (feature = 'click'), 0)::bigint s, coalesce(sum(n) filter (feature = 'view'), 0)::bigint o from tg group by 1),
b as (select barcode, s, o, sum(exp(lgamma(s + o + 4) - lgamma(j + 1) - lgamma(s + o + 4 - j) + j * ln(0.925) + (s + o + 3 - j) * ln(0.075))) above from c, unnest(range(0, 5000)) u(j) where j >= s + 1 and j <= s + o + 3 group by 1, 2, 3)
select barcode, s signal, o noise, round(100 * (1 - above), 5) specificity from b""")
def antigen_specificity(s, d):
    t = R.tags(s, d)
    c = t.groupBy("barcode").agg(F.coalesce(F.sum(F.when(F.col("feature") == "click", F.col("n"))), F.lit(0)).alias("signal"), F.coalesce(F.sum(F.when(F.col("feature") == "view", F.col("n"))), F.lit(0)).alias("noise"))
    return C.antigen_specificity(c).withColumn("specificity", F.round("specificity", 5))


_EXACT = """
l as (select barcode, list(chain || ':' || cdr3 order by chain, cdr3) c, min((chain, cdr3)) f from ctg group by 1), g as (select c, count(*) n from l group by 1),
i as (select c, n, row_number() over (order by len(c), c) clonotype_id from g)"""


@query("ctg", f"with {_EXACT} select barcode, clonotype_id, len(c) n_chains, n n_cells from l join i using (c)")
def exact_clonotypes(s, d):
    return V.exact_clonotypes(R.contigs(s, d), ["chain", "cdr3"])


@query("ctg", f"with {_EXACT} select clonotype_id, n frequency, round(n / sum(n) over (), 6) proportion from i")
def clonotype_table(s, d):
    return V.clonotype_table(V.exact_clonotypes(R.contigs(s, d), ["chain", "cdr3"])).withColumn("proportion", F.round("proportion", 6))


@query("ctg", f"""with {_EXACT}, x as (select barcode, clonotype_id, barcode % 2 lab from l join i using (c)), y as (select clonotype_id, lab, count(*) n from x group by 1, 2)
select clonotype_id, sum(n)::bigint cells, round(max(n) / sum(n), 6) concordance from y group by 1""")
def clonotype_concordance(s, d):
    cells = V.exact_clonotypes(R.contigs(s, d).where("contig is not null"), ["chain", "cdr3"]).withColumn("label", F.col("barcode") % 2)
    return V.clonotype_concordance(cells, "label").withColumn("concordance", F.round("concordance", 6))


@query("", """
with c as (select o_orderkey barcode, o_custkey % 50 clonotype, o_orderkey % 4 half1, o_orderkey % 7 half2, round(o_totalprice / 100)::bigint umis from orders),
b as (select *, max(umis) over (partition by clonotype, half1) >= 10 * umis or max(umis) over (partition by clonotype, half2) >= 10 * umis bad from c)
select barcode, clonotype, umis, bad and avg(bad::int) over (partition by clonotype) >= 0.05 contaminant from b""")
def whitelist_contamination(s, d):
    o = R.table(s, d, "orders")
    c = o.select(F.col("o_orderkey").alias("barcode"), (F.col("o_custkey") % 50).alias("clonotype"), (F.col("o_orderkey") % 4).alias("half1"), (F.col("o_orderkey") % 7).alias("half2"), F.round(F.col("o_totalprice") / 100).cast("long").alias("umis"))
    return V.whitelist_contamination(c, 10, 0.05).select("barcode", "clonotype", "umis", "contaminant")


@query("", """
with r as (select o_orderkey id, o_custkey l, o_orderpriority p, round(o_totalprice)::bigint v from orders), e as (select a.id a, b.id b from r a join r b on a.l = b.l and a.p = b.p and a.id < b.id and abs(a.v - b.v) <= 60000),
f as (select a, b from e union select b, a from e), reach as (select a, a b from f union select reach.a, f.b from reach join f on reach.b = f.a) select a node, min(b) comp from reach group by 1""")
def clonotype_components(s, d):
    r = R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("l"), F.col("o_orderpriority").alias("p"), F.round("o_totalprice").cast("long").alias("v"))
    return V.clonotype_components(r, ["l", "p"], F.abs(F.col("x.v") - F.col("y.v")) <= 60000)


@query("ctg", """select barcode, count(*) n_contigs, sum(umis)::bigint umis, count(distinct chain) n_chains, count(*) filter (productive) n_productive, count(distinct chain) filter (productive) >= 2 paired from ctg group by 1""")
def contig_metrics(s, d):
    return V.contig_metrics(R.contigs(s, d))


@query("ctg", "select barcode, contig, case when umis < 100 then 'few_umis' when not productive then 'not_productive' when chain = 'system' then 'other_chain' end reason from ctg")
def confident_contigs(s, d):
    rules = [("few_umis", F.col("umis") < 100), ("not_productive", ~F.col("productive")), ("other_chain", F.col("chain") == "system")]
    return V.confident_contigs(R.contigs(s, d), rules).select("barcode", "contig", "reason")


@query("", "with q as (select o_orderpriority dataset, count(*) n, quantile_cont(o_totalprice, 0.1) a, quantile_cont(o_totalprice, 0.5) b from orders group by 1 having count(*) >= 20) select dataset, n, round(least(a, b - 4 * sqrt(b)), 4) umin from q")
def umi_filter_baseline(s, d):
    o = R.table(s, d, "orders").select(F.col("o_orderpriority").alias("dataset"), F.col("o_totalprice").alias("umis"))
    return V.umi_filter_baseline(o).withColumn("umin", F.round("umin", 4))


@query("ctg", "with x as (select cdr3 clonotype, chain, count(distinct barcode) cells from ctg group by 1, 2) select *, max(cells) over (partition by clonotype) >= 20 and cells * 5 <= max(cells) over (partition by clonotype) weak from x")
def weak_chains(s, d):
    x = R.contigs(s, d).groupBy(F.col("cdr3").alias("clonotype"), "chain").agg(F.count_distinct("barcode").alias("cells"))
    return V.weak_chains(x, 20, 5)


@query("ctg", """with k as (select kk, count(distinct c) n, min(c) c from (select umis % 9 kk, case when umis % 9 < 6 then umis % 9 // 2 else cdr3 end c from ctg where chain = 'assistant') group by 1)
select c.barcode, case when n = 1 then k.c end clonotype_id from (select distinct barcode from ctg) c left join k on k.kk = c.barcode % 9""")
def merge_single_chains(s, d):
    c = R.contigs(s, d)
    kk = F.col("umis") % 9
    full = c.where("chain = 'assistant'").select(kk.alias("kk"), F.when(kk < 6, F.floor(kk / 2)).otherwise(F.col("cdr3")).alias("clonotype_id"))
    return V.merge_single_chains(c.select("barcode").distinct().withColumn("kk", F.col("barcode") % 9), full, "kk").select("barcode", "clonotype_id")


@query("ctg", "select barcode::varchar cell_id, barcode || '_contig_' || contig sequence_id, sequence, case when productive then 'T' else 'F' end productive, chain locus, umis duplicate_count from ctg")
def airr_table(s, d):
    return V.airr(R.contigs(s, d))


@query("ctg mol", """with v as (select barcode, count(*) n_contigs from ctg group by 1), g as (select barcode, count(*) umis from mol group by 1)
select coalesce(v.barcode, g.barcode) barcode, n_contigs, umis, v.barcode is not null and g.barcode is not null both_present from v full join g on v.barcode = g.barcode""")
def vdj_gex_barcodes(s, d):
    v = R.contigs(s, d).groupBy("barcode").agg(F.count("*").alias("n_contigs"))
    g = R.molecules(s, d).groupBy("barcode").agg(F.count("*").alias("umis"))
    return v.join(g, "barcode", "full").select("barcode", "n_contigs", "umis", (F.col("n_contigs").isNotNull() & F.col("umis").isNotNull()).alias("both_present"))


@query("pt", "select id, cluster, row_number() over (partition by cluster order by id) nth from pt qualify nth <= 10")
def group_sample(s, d):
    """At most ten rows a group; ties by id."""
    w = Window.partitionBy("cluster").orderBy("id")
    return R.points(s, d).select("id", "cluster", F.row_number().over(w).alias("nth")).where("nth <= 10")


@query("", """
select user_id, ts::date::timestamp "start", count(*) n, count(distinct event_type) types, round(sum(value), 2) total from events group by 1, 2""")
def stream_user_counts(s, d):
    from ..streaming.counters import replay

    return replay(s, f"{d}/events.parquet")
