"""Queries: receptor rules, scaled matrices, neighbours of another batch, expected cells, more formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cells as C
from ..operators import matrix as M
from ..operators import vdj as V
from ..sources import formats as S
from ..sources.stage import stage_path
from . import roles as R
from .registry import query

_INFO = """
i as (select o_custkey barcode, case when o_custkey % 3 = 0 then 'IG' else 'TR' end receptor, count(*) filter (o_orderkey % 4 > 0) surviving, count(*) umis, count(*) filter (o_orderstatus = 'F') n_good,
  count(*) filter (o_orderstatus = 'P') n_reject, bool_or(o_orderpriority <= '2') has_v, count(distinct o_orderpriority) junction_support, count(*) filter (o_orderstatus = 'O') n_confident, max(o_orderkey % 50) max_reads from orders group by 1)"""


def _info(s, d):
    o = R.table(s, d, "orders")
    status = lambda x: F.count_if(F.col("o_orderstatus") == x)
    return o.groupBy(F.col("o_custkey").alias("barcode")).agg(
        F.count_if(F.col("o_orderkey") % 4 > 0).alias("surviving"), F.count("*").alias("umis"), status("F").alias("n_good"), status("P").alias("n_reject"),
        F.bool_or(F.col("o_orderpriority") <= "2").alias("has_v"), F.count_distinct("o_orderpriority").alias("junction_support"), status("O").alias("n_confident"),
        F.max(F.col("o_orderkey") % 50).alias("max_reads"),
    ).withColumn("receptor", F.when(F.col("barcode") % 3 == 0, "IG").otherwise("TR")).withColumn("typical_reads", F.lit(1000))


@query("", f"""with {_INFO}
select barcode, concat_ws(',', case when receptor = 'TR' and surviving < 3 then 'not_enough_umis_tcr' end, case when receptor = 'IG' and (surviving < 3 or umis < 10) then 'not_enough_umis_bcr' end,
  case when n_good + n_reject = 0 or not has_v then 'no_contig_with_v_region' end, case when n_good = 1 and junction_support <= 1 then 'not_enough_junction_support' end,
  case when n_confident = 0 then 'no_confident_contig' end, case when max_reads < 30 then 'not_enough_reads_per_umi' end) reasons from i""")
def cell_reasons(s, d):
    """All rules that a barcode breaks, in their order."""
    return V.cell_reasons(_info(s, d)).select("barcode", F.concat_ws(",", "reasons").alias("reasons"))


@query("", """
with c as (select l_orderkey barcode, l_linenumber contig, l_partkey % 40 junction, case when l_quantity >= 50 then 60 when l_quantity < 26 then 1 else 2 end umis from lineitem where l_partkey % 40 < 30 or l_quantity < 20),
s as (select junction, max(umis) dominant from c group by 1 having count(*) >= 10 and (list(umis order by umis))[count(*) // 2 + 1] <= 1)
select barcode, contig, junction, umis, dominant from c join s using (junction) where dominant >= 40 * greatest(1, umis)""")
def leaked_junctions(s, d):
    """Contigs whose junction looks leaked from a cell with far more of it."""
    q = F.col("l_quantity")
    li = R.table(s, d, "lineitem").where("l_partkey % 40 < 30 or l_quantity < 20")
    c = li.select(F.col("l_orderkey").alias("barcode"), F.col("l_linenumber").alias("contig"), (F.col("l_partkey") % 40).alias("junction"), F.when(q >= 50, 60).when(q < 26, 1).otherwise(2).alias("umis"))
    return V.leaked_junctions(c)


@query("ctg", """
with f as (select *, length(sequence) % 2 len, contig % 3 v, contig % 2 c from ctg where barcode % 4 <> 1 and productive),
l as (select barcode, list((chain, cdr3, len, v, c) order by chain, cdr3, len, v, c) k from f group by 1), g as (select k, count(*) frequency from l group by 1),
i as (select k, frequency, row_number() over (order by frequency desc, len(k), k) clonotype_id from g) select barcode, clonotype_id, frequency, len(k) n_chains from l join i using (k)""")
def keyed_clonotypes(s, d):
    """Exact clonotypes by five fields of each chain, over productive contigs of cells."""
    x = R.contigs(s, d).withColumn("is_cell", F.col("barcode") % 4 != 1).withColumns({"len": F.length("sequence") % 2, "v": F.col("contig") % 3, "c": F.col("contig") % 2})
    return V.keyed_clonotypes(x, ["chain", "cdr3", "len", "v", "c"])


@query("", """
with c as (select o_custkey % 400 clonotype, o_custkey exact, o_orderkey barcode, o_orderpriority dataset, round(o_totalprice / 1000)::bigint umis, 1 + o_orderkey % 3 chains from orders),
b as (select dataset, least(quantile_cont(umis, 0.1), quantile_cont(umis, 0.5) - 4 * sqrt(quantile_cont(umis, 0.5))) * 3 umin from c group by 1 having count(*) >= 20),
m as (select c.*, coalesce(umis < umin, false) bad from c left join b using (dataset)),
t as (select *, bool_and(bad) over (partition by clonotype) all_bad, sum(umis) over (partition by clonotype, exact) total from m),
r as (select *, row_number() over (partition by clonotype order by total desc, exact, umis desc, barcode) r from t)
select clonotype, exact, barcode, umis, all_bad and chains >= 2 and r = 1 guarded from r where not bad or (all_bad and chains >= 2 and r = 1)""")
def umi_filter(s, d):
    """Cells at least at their dataset's baseline; the best cell of a clonotype is guarded."""
    o = R.table(s, d, "orders")
    c = o.select(
        (F.col("o_custkey") % 400).alias("clonotype"), F.col("o_custkey").alias("exact"), F.col("o_orderkey").alias("barcode"), F.col("o_orderpriority").alias("dataset"),
        F.round(F.col("o_totalprice") / 1000).cast("long").alias("umis"), (1 + F.col("o_orderkey") % 3).alias("chains"),
    )
    base = V.umi_filter_baseline(c.select("dataset", "umis")).withColumn("umin", F.col("umin") * 3)
    return V.umi_filter(c, base)


@query("", f"""
with c as (select {R._dna('o_orderkey % 3000', 5)} barcode, o_custkey % 20 sequence, max(round(o_totalprice / 1000))::bigint umis from orders group by 1, 2),
v as (select distinct barcode, sequence, umis, substr(barcode, 1, i - 1) || substr(barcode, i + 1) variant from c, unnest(range(1, 6)) u(i)),
b as (select sequence, variant, max(umis) most from v group by 1, 2 having count(distinct barcode) > 1)
select distinct barcode, sequence, umis from v join b using (sequence, variant) where most >= 10 * umis""")
def indel_contaminants(s, d):
    """Barcodes that look like one insertion or deletion in a far richer barcode of the same contig."""
    from ..functions.seq import dna

    o = R.table(s, d, "orders").groupBy(dna(F.col("o_orderkey") % 3000, 5).alias("barcode"), (F.col("o_custkey") % 20).alias("sequence"))
    return V.indel_contaminants(o.agg(F.max(F.round(F.col("o_totalprice") / 1000)).cast("long").alias("umis")))


@query("coo bt", """
with l as (select barcode, feature, log2(1 + umi_count * greatest(m, 1) / total) v from coo join bt using (barcode), (select median(total) m from bt)),
n as (select count(*) n from supplier), m as (select feature, sum(v) / n mean, sqrt(greatest(sum(v * v) / n - (sum(v) / n) ** 2, 0)) sd from l, n group by feature, n)
select barcode, feature, round(case when sd > 0 then (v - mean) / sd else 0 end, 4) "value", round(case when sd > 0 then -mean / sd else 0 end, 4) zero from l join m using (feature)""")
def log_scaled(s, d):
    n = R.table(s, d, "supplier").count()
    return M.log_scaled(R.coo(s, d), n).select("barcode", "feature", F.round("value", 4).alias("value"), F.round("zero", 4).alias("zero"))


@query("coo", """
with m as (select feature, sum(umi_count) / n mean, sum(umi_count * umi_count) / n - (sum(umi_count) / n) ** 2 v from coo, (select count(*) n from supplier) group by feature, n),
x as (select feature, mean, v / mean d from m where mean > 0), e as (select quantile_cont(mean, """ + str([i / 20 for i in range(1, 20)]) + """) e from x),
b as (select x.*, len([c for c in e if c < mean]) bin from x, e), o as (select *, median(d) over (partition by bin) mid from b), a as (select *, abs(d - mid) off from o),
f as (select *, median(off) over (partition by bin) mad from a), z as (select feature, round(case when mad > 0 then (d - mid) / mad else 0 end, 4) normalized from f)
select feature, normalized from z order by normalized desc, feature limit 50""")
def top_dispersion_features(s, d):
    """The features that a principal component analysis is run on."""
    x = M.normalized_dispersion(M.mean_var(R.coo(s, d), R.table(s, d, "supplier").count()))
    return x.select("feature", F.round("normalized", 4).alias("normalized")).orderBy(F.col("normalized").desc(), "feature").limit(50)


_OTHER = """
x as (select id, list_transform(vec, lambda v: v::double) v from pt),
k as (select a.id q, b.id, list_sum([(u[1] - u[2]) ** 2 for u in list_zip(a.v, b.v)]) dist, row_number() over (partition by a.id order by dist, b.id) r from x a join x b on a.id % 2 <> b.id % 2 qualify r <= 5)"""


def _batches(s, d):
    p = R.points(s, d).select("id", F.transform("vec", lambda x: x.cast("double")).alias("vec"))
    return p.where("id % 2 = 0"), p.where("id % 2 = 1")


@query("pt", f"with {_OTHER} select q, id, round(dist, 4) dist, r \"rank\" from k where q % 2 = 0")
def knn_other_batch(s, d):
    even, odd = _batches(s, d)
    return M.knn(even, 5, others=odd).select("q", "id", F.round("dist", 4).alias("dist"), F.col("rank").cast("long").alias("rank"))


@query("pt", f"with {_OTHER} select a.q a, a.id b from k a join k b on a.q = b.id and a.id = b.q where a.q % 2 = 0")
def mutual_batch_pairs(s, d):
    even, odd = _batches(s, d)
    return M.mutual_pairs(M.knn(even, 5, others=odd), M.knn(odd, 5, others=even))


@query()
def kmeans_sweep(s, d):
    return M.kmeans_sweep(R.points(s, d))


@query("tot", """
with t as (select total, row_number() over (order by total desc) - 1 r from tot where total > 0),
c as (select distinct round_even(2 ** (1 + i * (17.0 - 0) / 1999.0), 0)::bigint recovered from (select unnest(range(0, 2000)) i)),
b as (select recovered, greatest(round(total * 0.1), 1) cut from c join t on t.r = least(round_even(recovered * (1 - 0.99), 0)::bigint, (select max(r) from t))),
f as (select recovered, count(*) filter (total >= cut) filtered from b, t group by 1)
select recovered, filtered, round((filtered - recovered) ** 2 / recovered, 6) loss from f order by loss, recovered limit 1""")
def expected_cells(s, d):
    return C.expected_cells(R.totals(s, d)).withColumn("loss", F.round("loss", 6))


@query("mol feat", """
with t as (select genome, gem_group, barcode, sum(reads)::bigint total from mol join feat using (feature) group by 1, 2, 3),
r as (select *, row_number() over (partition by genome, gem_group order by total desc, barcode) r from t), b as (select genome, gem_group, greatest(round(min(total) * 0.1), 1) cut from r where r <= 2 group by 1, 2)
select genome, gem_group, barcode, total from t join b using (genome, gem_group) where total >= cut""")
def cells_by_genome(s, d):
    """Initial calls of each genome and gem group."""
    m = R.molecules(s, d).join(R.features(s, d).select("feature", "genome"), "feature")
    return C.cells_by_group(m.groupBy("genome", "gem_group", "barcode").agg(F.sum("reads").alias("total")), ["genome", "gem_group"], 100)


@query("", "select p_partkey gene_id, 'chr' || p_size seqname, p_partkey \"start\", p_partkey + 2 * p_size \"end\", 2 exons from part")
def gene_index(s, d):
    """Genes with their extent and number of exons, from annotation lines."""
    p, path = R.table(s, d, "part"), stage_path(s)
    line = lambda at: F.concat_ws("\t", F.concat(F.lit("chr"), "p_size"), F.lit("m"), F.lit("exon"), F.col("p_partkey") + at, F.col("p_partkey") + at + F.col("p_size"), F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit('gene_id "'), "p_partkey", F.lit('";')))
    p.select(F.explode(F.array(line(F.lit(0)), line(F.col("p_size"))))).write.text(path)
    g = S.parse_gtf(s.read.text(path)).where("feature = 'exon'").withColumn("gene_id", F.col("properties")["gene_id"].cast("long"))
    return g.groupBy("gene_id", "seqname").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("exons"))


@query("pt", "select id, round(vec[1]::double, 6) c1, round(vec[2]::double, 6) c2 from pt")
def projection_csv(s, d):
    """Coordinates of points written as text with a header and read back."""
    path = stage_path(s)
    p = R.points(s, d).select("id", *(F.round(F.get("vec", F.lit(i)).cast("double"), 6).alias(f"c{i + 1}") for i in range(2)))
    S.concat_csv([p], path)
    return S.read_csv_checked(s, path, "id long, c1 double, c2 double", ["id", "c1", "c2"])


@query("ctg", "select barcode::varchar cell_id, barcode || '_contig_' || contig sequence_id, case when productive then 'T' else 'F' end productive, chain locus, umis duplicate_count from ctg")
def airr_tsv(s, d):
    """The rearrangement table written as tab-separated text and read back, sequences left out."""
    path = stage_path(s)
    V.airr(R.contigs(s, d)).drop("sequence").write.option("sep", "\t").option("header", True).csv(path)
    return s.read.option("sep", "\t").option("header", True).schema("cell_id string, sequence_id string, productive string, locus string, duplicate_count long").csv(path)


@query("wl obs", f"""
with near as (select distinct o.seq, w.seq w, w."count" c from obs o join wl w on hamming(o.seq, w.seq) = 1 where o.seq not in (select seq from wl)),
m as (select seq, arg_max(w, (c, w)) corrected, count(*) n_near from near group by 1) select * from m""")
def correction_map(s, d):
    """Observed sequences off the whitelist with the most frequent neighbour on it: a map that is built once."""
    wl = R.whitelist(s, d)
    holes = lambda df: df.select("*", F.explode(F.transform(F.sequence(F.lit(1), F.length("seq")), lambda i: F.concat(F.substr("seq", F.lit(1), i - 1), F.lit("_"), F.substr("seq", i + 1)))).alias("hole"))
    off = R.observed(s, d).select("seq").distinct().join(wl.select("seq"), "seq", "left_anti")
    near = holes(off).join(holes(wl).select(F.col("seq").alias("w"), F.col("count").alias("c"), "hole"), "hole").select("seq", "w", "c").distinct()
    return near.groupBy("seq").agg(F.max_by("w", F.struct("c", "w")).alias("corrected"), F.count("*").alias("n_near"))
