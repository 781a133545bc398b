"""Queries: counting, selection, set operations, merges, chunks, intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counting as C
from . import roles as R
from .registry import query


@query("mol", "select barcode, feature, count(distinct umi) umi_count from mol group by all")
def count_matrix(s, d):
    return C.count_matrix(R.molecules(s, d))


@query("mol feat cell", """
with a as (select m.feature, count(*) num_umis, sum(reads)::bigint num_reads, count(distinct m.barcode) num_barcodes, count(c.barcode) num_umis_cells,
  coalesce(sum(reads) filter (c.barcode is not null), 0)::bigint num_reads_cells, count(distinct c.barcode) num_barcodes_cells from mol m left join cell c using (barcode) group by 1),
z as (select feat.*, coalesce(num_umis, 0) num_umis, coalesce(num_reads, 0) num_reads, coalesce(num_barcodes, 0) num_barcodes, coalesce(num_umis_cells, 0) num_umis_cells,
  coalesce(num_reads_cells, 0) num_reads_cells, coalesce(num_barcodes_cells, 0) num_barcodes_cells from feat left join a using (feature))
select *, round(1 - greatest(num_umis, 1) / greatest(num_reads, 1), 6) dup_frac, round(1 - greatest(num_umis_cells, 1) / greatest(num_reads_cells, 1), 6) dup_frac_cells from z""")
def feature_summary(s, d):
    out = C.feature_summary(R.molecules(s, d), R.features(s, d), R.cells(s, d))
    return out.withColumns({c: F.round(c, 6) for c in ("dup_frac", "dup_frac_cells")})


@query("mol feat", """
with t as (select barcode, feature, reads, unnest(['all', feature_type]) feature_subset from mol join feat using (feature)),
a as (select barcode, feature_subset, count(*) num_umis, sum(reads)::bigint num_reads, count(distinct feature) num_features from t group by all),
s as (select distinct feature_type feature_subset from feat union select 'all'), b as (select distinct barcode from t),
z as (select barcode, feature_subset, coalesce(num_umis, 0) num_umis, coalesce(num_reads, 0) num_reads, coalesce(num_features, 0) num_features
  from b cross join s left join a using (barcode, feature_subset))
select s_suppkey barcode, s_name "name", feature_subset, num_umis, num_reads, num_features, round(1 - greatest(num_umis, 1) / greatest(num_reads, 1), 6) dup_frac
from z join supplier on s_suppkey = barcode""")
def barcode_summary(s, d):
    meta = R.table(s, d, "supplier").select(F.col("s_suppkey").alias("barcode"), F.col("s_name").alias("name"))
    return C.barcode_summary(R.molecules(s, d), meta, R.features(s, d).select("feature", "feature_type")).withColumn("dup_frac", F.round("dup_frac", 6))


@query("mol", "select gem_group, library, count(*) num_umis, sum(reads)::bigint num_reads, count(distinct barcode) num_barcodes from mol group by rollup (gem_group, library)")
def library_totals(s, d):
    return C.library_totals(R.molecules(s, d))


@query("coo feat", "select * from coo where feature in (select feature from feat where feature_type in (select min(feature_type) from feat))")
def select_features_by_type(s, d):
    f = R.features(s, d)
    least = f.agg(F.min("feature_type").alias("feature_type"))
    return C.select_by(R.coo(s, d), f.join(F.broadcast(least), "feature_type"), "feature").select("barcode", "feature", "umi_count")


@query("coo feat", "select coo.* from coo join feat using (feature) where genome = 'g1'")
def select_features_by_genome(s, d):
    return C.select_by(R.coo(s, d), R.features(s, d).where("genome = 'g1'"), "feature").select("barcode", "feature", "umi_count")


@query("coo feat", "select coo.* from coo join feat using (feature) where genome = 'g0' and target_set in ('Brand#11', 'Brand#12', 'Brand#13')")
def select_features_by_genome_and_tag(s, d):
    f = R.features(s, d).where((F.col("genome") == "g0") & F.col("target_set").isin("Brand#11", "Brand#12", "Brand#13"))
    return C.select_by(R.coo(s, d), f, "feature").select("barcode", "feature", "umi_count")


@query("coo feat", "select * from coo where feature not in (select feature from feat where target_set <= 'Brand#2')")
def exclude_features(s, d):
    return C.exclude(R.coo(s, d), R.features(s, d).where("target_set <= 'Brand#2'"), "feature").select("barcode", "feature", "umi_count")


@query("mol", "select barcode, feature, count(*) umi_count from mol where gem_group = 'F' group by all")
def select_barcodes_by_gem_group(s, d):
    return R.molecules(s, d).where("gem_group = 'F'").groupBy("barcode", "feature").agg(F.count("*").alias("umi_count"))


@query("coo cell", "select coo.* from coo join cell using (barcode)")
def cell_matrix(s, d):
    return C.select_by(R.coo(s, d), R.cells(s, d), "barcode").select("barcode", "feature", "umi_count")


@query("coo", "select * from coo where feature in (select feature from coo group by 1 having sum(umi_count) > 20) and barcode in (select barcode from coo group by 1 having sum(umi_count) > 590)")
def threshold_axes(s, d):
    features = C.threshold_axis(R.coo(s, d), "feature", 20)
    barcodes = C.threshold_axis(R.coo(s, d), "barcode", 590)
    return C.select_by(C.select_by(R.coo(s, d), features, "feature"), barcodes, "barcode").select("barcode", "feature", "umi_count")


@query("coo", "select * from coo where feature in (select feature from coo group by 1 having sum(umi_count) > 25) and barcode in (select barcode from coo group by 1 having sum(umi_count) > 25)")
def threshold_both(s, d):
    return C.threshold_axes(R.coo(s, d), 25).select("barcode", "feature", "umi_count")


@query("coo cell feat", "select barcode, sum(umi_count)::bigint total, round(log2(1 + sum(umi_count)), 6) log_total from coo join cell using (barcode) join feat using (feature) where genome = 'g0' group by 1")
def subset_counts(s, d):
    return C.subset_counts(R.coo(s, d), R.features(s, d).where("genome = 'g0'"), R.cells(s, d)).withColumn("log_total", F.round("log_total", 6))


_AXIS = "select {a}, sum(umi_count)::bigint total, count(distinct {b}) entries, count(*) filter (umi_count >= 2) entries_ge2, max(umi_count) largest, round(sum(umi_count) / sum(sum(umi_count)) over (), 9) frac from coo group by {a}"


@query("coo", _AXIS.format(a="barcode", b="feature"))
def counts_per_barcode(s, d):
    return C.axis_counts(R.coo(s, d), "barcode", "feature").withColumn("frac", F.round("frac", 9))


@query("coo", _AXIS.format(a="feature", b="barcode"))
def counts_per_feature(s, d):
    return C.axis_counts(R.coo(s, d), "feature", "barcode").withColumn("frac", F.round("frac", 9))


@query("coo feat", "select barcode, genome, sum(umi_count)::bigint total from coo join feat using (feature) group by all")
def counts_by_genome(s, d):
    return C.counts_by(R.coo(s, d), R.features(s, d), "feature", "genome")


@query("coo feat", """
with t as (select barcode, feature_type, sum(umi_count) n from coo join feat using (feature) group by all)
select feature_type, count(*) barcodes, round(median(n), 6) median_umis, round(avg(n), 6) mean_umis, round(quantile_cont(n, 0.75) - quantile_cont(n, 0.25), 6) iqr from t group by 1""")
def type_metrics(s, d):
    t = C.counts_by(R.coo(s, d), R.features(s, d), "feature", "feature_type")
    q = lambda p: F.percentile("total", p)
    return t.groupBy("feature_type").agg(F.count("*").alias("barcodes"), F.round(q(0.5), 6).alias("median_umis"), F.round(F.avg("total"), 6).alias("mean_umis"), F.round(q(0.75) - q(0.25), 6).alias("iqr"))


@query("mol", """select barcode, feature, umi, count(*) copies, sum(reads)::bigint reads, arg_min(library, library || gem_group) o0, arg_min(gem_group, library || gem_group) o1 from mol group by all""".replace("group by all", "group by barcode, feature, umi"))
def representative_reads(s, d):
    return C.representative_reads(R.molecules(s, d), [F.col("library"), F.col("gem_group")])


@query("mol", "select barcode, feature, count(*) umi_count from mol group by all")
def merge_matrices(s, d):
    m = R.molecules(s, d)
    half = lambda c: m.where(c).groupBy("barcode", "feature").agg(F.count("*").alias("umi_count"))
    return C.merge_matrices(half(F.col("library") == "A"), half(F.col("library") != "A"))


@query("mol", """
with a as (select barcode, feature, count(*) l from mol where library = 'A' group by all), b as (select barcode, feature, count(*) r from mol where library = 'R' group by all)
select coalesce(a.barcode, b.barcode) barcode, coalesce(a.feature, b.feature) feature, l left_count, r right_count, case when r is null then 'left_only' when l is null then 'right_only' else 'differs' end kind
from a full join b on a.barcode = b.barcode and a.feature = b.feature where l is distinct from r""")
def matrix_diff(s, d):
    m = R.molecules(s, d)
    part = lambda x: m.where(F.col("library") == x).groupBy("barcode", "feature").agg(F.count("*").alias("umi_count"))
    return C.diff_matrices(part("A"), part("R")).select("barcode", "feature", "left_count", "right_count", "kind")


@query("mol", """
with w as (select 0 input, * from mol where gem_group = 'F' union all select 1, * from mol where gem_group = 'O')
select *, dense_rank() over (order by input, gem_group)::int new_gem_group, dense_rank() over (order by input, library)::int new_library from w""")
def merge_molecules(s, d):
    m = R.molecules(s, d)
    return C.merge_molecules([m.where("gem_group = 'F'"), m.where("gem_group = 'O'")]).select("input", "barcode", "feature", "umi", "reads", "library", "gem_group", "new_gem_group", "new_library")


@query("mol", "select barcode, row_number() over (order by barcode) - 1 idx from (select distinct barcode from mol)")
def barcode_index(s, d):
    return C.dense_index(R.molecules(s, d), "barcode")


@query("coo feat", """
with b as (select barcode, row_number() over (order by barcode) c from (select distinct barcode from coo)), f as (select feature, row_number() over (order by feature) r from feat)
select r "row", c col, umi_count "value" from coo join b using (barcode) join f using (feature)""")
def matrix_market(s, d):
    coo, f = R.coo(s, d), R.features(s, d)
    return C.matrix_market(coo, C.dense_index(coo, "barcode").withColumnRenamed("idx", "barcode_idx"), C.dense_index(f, "feature").withColumnRenamed("idx", "feature_idx"))


@query("mol", """
with g as (select gem_group, barcode, count(*) n from mol group by all), r as (select *, floor((sum(n) over (order by gem_group, barcode) - n) / 1000)::bigint chunk from g)
select chunk, count(*) groups, sum(n)::bigint "rows" from r group by 1""")
def chunk_plan(s, d):
    return C.chunk_plan(R.molecules(s, d), ["gem_group", "barcode"], 1000)


@query("", """
with p as (select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_returnflag, l_discount, l_tax) id, l_suppkey % 25 chrom, epoch(l_shipdate)::bigint // 86400 s0, l_quantity::bigint q from lineitem),
i as (select o_custkey % 25 chrom, epoch(o_orderdate)::bigint // 86400 lo, epoch(o_orderdate)::bigint // 86400 + 3 hi from orders),
h as (select id, max((lo <= s0 and s0 + q % 4 <= hi)::int) ins, count(*) n from p join i on p.chrom = i.chrom and s0 <= hi and lo <= s0 + q % 4 group by id)
select chrom, case when ins = 1 then 'exonic' when ins = 0 then 'intronic' else 'intergenic' end region, count(*) "reads", coalesce(sum(n), 0)::bigint n_overlaps from p left join h using (id) group by 1, 2""")
def interval_annotate(s, d):
    day = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 86_400_000_000).cast("long")
    li = R.table(s, d, "lineitem").withColumn("q", F.col("l_quantity").cast("long") % 4)
    points = li.select(F.monotonically_increasing_id().alias("id"), (F.col("l_suppkey") % 25).alias("chrom"), day("l_shipdate").alias("start"), (day("l_shipdate") + F.col("q")).alias("end"))
    windows = R.table(s, d, "orders").select((F.col("o_custkey") % 25).alias("chrom"), day("o_orderdate").alias("lo"), (day("o_orderdate") + 3).alias("hi"))
    return C.annotate_region(points, windows, 16).groupBy("chrom", "region").agg(F.count("*").alias("reads"), F.sum("n_overlaps").alias("n_overlaps"))


@query("mol", "select barcode from mol where library = 'A' union select barcode from mol where gem_group = 'F'")
def union_barcodes(s, d):
    m = R.molecules(s, d)
    return m.where("library = 'A'").select("barcode").union(m.where("gem_group = 'F'").select("barcode")).distinct()


@query("coo cell", "select barcode from coo where umi_count > 3 intersect select barcode from cell")
def intersect_barcodes(s, d):
    return R.coo(s, d).where("umi_count > 3").select("barcode").intersect(R.cells(s, d))


@query("coo cell", "select barcode from coo except select barcode from cell")
def background_barcodes(s, d):
    return R.coo(s, d).select("barcode").subtract(R.cells(s, d))


@query("mol", "select library, list_sort(list(distinct gem_group))::varchar gem_groups, count(*) n from mol group by 1")
def nested_groups(s, d):
    g = R.molecules(s, d).groupBy("library").agg(F.array_sort(F.collect_set("gem_group")).alias("g"), F.count("*").alias("n"))
    return g.select("library", F.concat(F.lit("["), F.array_join("g", ", "), F.lit("]")).alias("gem_groups"), "n")


@query("mol", "select library, coalesce(sum(reads) filter (gem_group = 'F'), 0)::bigint f_reads, coalesce(sum(reads) filter (gem_group = 'O'), 0)::bigint o_reads from mol group by 1")
def pivot_library(s, d):
    p = R.molecules(s, d).groupBy("library").pivot("gem_group", ["F", "O"]).agg(F.sum("reads"))
    return p.select("library", F.coalesce("F", F.lit(0)).alias("f_reads"), F.coalesce("O", F.lit(0)).alias("o_reads"))


@query("mol", "select barcode, umi, feature, row_number() over (partition by barcode, feature order by umi, reads, library, gem_group) nth from mol")
def running_occurrence(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("barcode", "feature").orderBy("umi", "reads", "library", "gem_group")
    return R.molecules(s, d).select("barcode", "umi", "feature", F.row_number().over(w).alias("nth"))
