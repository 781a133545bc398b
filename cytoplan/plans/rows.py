"""Queries: gathers, selections, sorted arrays, running sums, text and number helpers, alignments, chances."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import align as A
from ..functions import seq as S
from ..operators import cells as C
from ..operators import matrix as M
from ..operators import mixtures as X
from ..operators import rows as W
from . import roles as R
from .registry import query


@query("mol", "select * from mol where umi in (select l_orderkey * 8 + l_linenumber from lineitem where l_partkey % 100 = 0)")
def gather_rows(s, d):
    """Rows by a list of keys."""
    keys = R.molecules(s, d).where("feature % 100 = 0").select("umi").distinct()
    return R.molecules(s, d).join(keys, "umi", "left_semi").select("barcode", "feature", "umi", "reads", "library", "gem_group")


@query("coo", "with b as (select barcode, row_number() over (order by barcode) - 1 place from (select distinct barcode from coo) qualify place between 3 and 7) select barcode, feature, umi_count, place from coo join b using (barcode)")
def column_range(s, d):
    return W.column_range(R.coo(s, d), 3, 8).select("barcode", "feature", "umi_count", F.col("place").cast("long").alias("place"))


@query("coo feat", "select barcode, feature, umi_count, genome, case when genome = 'g1' then name end name from coo join feat using (feature)")
def unified_genomes(s, d):
    """Tables of single genomes, of which one lacks a column, in one."""
    x = R.coo(s, d).join(R.features(s, d).select("feature", "name", "genome"), "feature")
    return W.unify([x.where("genome = 'g0'").drop("name"), x.where("genome = 'g1'")]).select("barcode", "feature", "umi_count", "genome", "name")


@query("coo feat", """
with k as (select genome, barcode from coo join feat using (feature) group by 1, 2 having sum(umi_count) > case genome when 'g0' then 3 else 4 end)
select barcode, feature, umi_count, genome from coo join feat using (feature) semi join k using (genome, barcode)""")
def genome_barcodes(s, d):
    """Counts of barcodes that were called for the genome of the feature."""
    x = R.coo(s, d).join(R.features(s, d).select("feature", "genome"), "feature")
    called = x.groupBy("genome", "barcode").agg(F.sum("umi_count").alias("n")).where("n > case genome when 'g0' then 3 else 4 end")
    return x.join(called, ["genome", "barcode"], "left_semi").select("barcode", "feature", "umi_count", "genome")


@query("", """
with e as (select 'l_orderkey' "name", min(l_orderkey) lo, max(l_orderkey) hi from lineitem union all select 'l_partkey', min(l_partkey), max(l_partkey) from lineitem
  union all select 'l_suppkey', min(l_suppkey), max(l_suppkey) from lineitem union all select 'l_linenumber', min(l_linenumber), max(l_linenumber) from lineitem)
select "name", case when lo >= -128 and hi < 128 then 'int8' when lo >= -32768 and hi < 32768 then 'int16' when lo >= -2147483648 and hi < 2147483648 then 'int32' else 'int64' end kind from e""")
def narrowest_types(s, d):
    return W.narrowest(R.table(s, d, "lineitem"))


@query("feat", """
with k as (select feature, row_number() over (order by feature) - 1 place from feat where genome = 'g0') select target_set, feature, place from feat join k using (feature)""")
def reindexed_targets(s, d):
    f = R.features(s, d)
    return W.reindex_targets(f.select("target_set", "feature"), f.where("genome = 'g0'")).withColumn("place", F.col("place").cast("long"))


@query("feat", "select feature, name, starts_with(feature_type, 'PROMO') or feature % 11 = 0 excluded from feat")
def excluded_probes(s, d):
    return R.features(s, d).select("feature", "name", (F.col("feature_type").startswith("PROMO") | (F.col("feature") % 11 == 0)).alias("excluded"))


@query("coo feat cell bt", """
with b as (select barcode from bt semi join cell using (barcode) order by total desc, barcode limit 5)
select * from coo where barcode in (select barcode from b) and feature in (select feature from feat where genome = 'g0' and feature % 7 <> 0)""")
def preprocess_selection(s, d):
    """Listed barcodes cut to the largest, features of a genome without the excluded ones."""
    coo, f = R.coo(s, d), R.features(s, d).where("genome = 'g0'")
    totals = coo.join(R.cells(s, d), "barcode", "left_semi").groupBy("barcode").agg(F.sum("umi_count").alias("total"))
    top = totals.orderBy(F.col("total").desc(), "barcode").limit(5)
    f = f.join(f.where("feature % 7 = 0").select("feature"), "feature", "left_anti")
    return coo.join(F.broadcast(top), "barcode", "left_semi").join(f, "feature", "left_semi")


@query("mol", """
with l as (select feature % 20 f, library, round(corr(reads, barcode), 6) c from mol group by 1, 2), g as (select feature % 20 f, gem_group, round(corr(reads, barcode), 6) c from mol group by 1, 2)
select l.f feature, library, gem_group, l.c library_cor, g.c gem_cor from l join g using (f)""")
def correlation_join(s, d):
    """Two long tables of correlations on their shared feature."""
    m = R.molecules(s, d).withColumn("feature", F.col("feature") % 20)
    long = lambda by, to: m.groupBy("feature", by).agg(F.round(F.corr("reads", "barcode"), 6).alias(to))
    return long("library", "library_cor").join(long("gem_group", "gem_cor"), "feature")


@query("mol", """
with i as (select umi, feature % 7 chrom, umi % 4000 "start", umi % 4000 + reads "end" from mol), c as (select distinct p_partkey % 7 chrom, 2500 + 200 * (p_partkey % 7) size from part)
select umi, chrom, "start" >= 0 and "end" <= size and "start" < "end" valid from i join c using (chrom)""")
def interval_validity(s, d):
    """Whether an interval lies in its chromosome."""
    i = R.molecules(s, d).select("umi", (F.col("feature") % 7).alias("chrom"), (F.col("umi") % 4000).alias("start"), "reads").withColumn("end", F.col("start") + F.col("reads"))
    sizes = R.table(s, d, "part").select((F.col("p_partkey") % 7).alias("chrom")).distinct().withColumn("size", 2500 + 200 * F.col("chrom"))
    return i.join(F.broadcast(sizes), "chrom").select("umi", "chrom", ((F.col("start") >= 0) & (F.col("end") <= F.col("size")) & (F.col("start") < F.col("end"))).alias("valid"))


@query("", """
with g as (select o_custkey k, count(*) n_reads from orders group by 1), v as (select c_custkey k, c_mktsegment sample from customer where c_custkey % 3 > 0)
select coalesce(g.k, v.k) sample_id, n_reads, sample, case when g.k is null then 'no counts' when v.k is null then 'no receptors' else 'matched' end state from g full join v using (k)""")
def matched_samples(s, d):
    """Outputs of two pipelines by sample id, with what is missing on either side."""
    g = R.table(s, d, "orders").groupBy(F.col("o_custkey").alias("sample_id")).agg(F.count("*").alias("n_reads"))
    v = R.table(s, d, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("sample_id"), F.col("c_mktsegment").alias("sample"))
    state = F.when(F.col("n_reads").isNull(), "no counts").when(F.col("sample").isNull(), "no receptors").otherwise("matched")
    return g.join(v, "sample_id", "full").select("sample_id", "n_reads", "sample", state.alias("state"))


@query("coo feat cell", """
select barcode, count(*) filter (genome = 'g0') in_mask, count(*) filter (genome = 'g0' and umi_count >= 2) in_mask_twice, count(*) filter (genome <> 'g0') outside
from coo join feat using (feature) semi join cell using (barcode) group by 1""")
def masked_counts(s, d):
    mask = F.col("genome") == "g0"
    x = R.coo(s, d).join(R.features(s, d).select("feature", "genome"), "feature").join(R.cells(s, d), "barcode", "left_semi")
    return x.groupBy("barcode").agg(F.count_if(mask).alias("in_mask"), F.count_if(mask & (F.col("umi_count") >= 2)).alias("in_mask_twice"), F.count_if(~mask).alias("outside"))


def _draws(s, d):
    m = R.molecules(s, d).select("barcode", (F.col("feature") % 9).alias("feature"), "umi", "library", "reads")
    m = m.groupBy("barcode", "feature", "umi").agg(F.sum("reads").alias("reads"))
    return m.withColumn("p", (F.col("feature") + 1) / F.lit(45.0))


_DRAWS = """draws as (select barcode, feature % 9 feature, umi, sum(reads) reads, (feature % 9 + 1) / 45.0 p from mol group by all),
numbered as (select *, row_number() over (partition by barcode order by umi, feature) i, row_number() over (partition by barcode, feature order by umi) k from draws)"""


@query("mol", f"with {_DRAWS.replace('group by all', 'group by barcode, feature % 9, umi')} select barcode, feature, umi, round(sum(ln(p) + ln(i) - ln(k)) over (partition by barcode order by umi, feature), 5) loglik from numbered")
def running_loglik(s, d):
    x = _draws(s, d).withColumn("at", F.struct("umi", "feature"))
    return W.running_loglik(x, "at").select("barcode", "feature", "umi", F.round("loglik", 5).alias("loglik"))


@query("mol", f"""with {_DRAWS.replace('group by all', 'group by barcode, feature % 9, umi')}
select barcode, feature, umi, round(sum(ln(i) - ln(k) + ln(50.0 * p + k - 1) - ln(50.0 + i - 1)) over (partition by barcode order by umi, feature), 5) loglik from numbered""")
def running_dm_loglik(s, d):
    x = _draws(s, d).withColumn("at", F.struct("umi", "feature"))
    return W.running_dm_loglik(x, "at", 50.0).select("barcode", "feature", "umi", F.round("loglik", 5).alias("loglik"))


@query("tot", """
with r as (select total, row_number() over (order by total desc, barcode) r from tot), n as (select unnest([1, 5, 20, 100]) n)
select n, sum(total)::bigint top_sum from r join n on r <= n group by 1""")
def running_top_sums(s, d):
    return W.top_sums(R.totals(s, d), [1, 5, 20, 100])


@query("ctg", "with c as (select chain, cdr3, count(*) n from ctg group by 1, 2) select chain, cdr3, n, row_number() over (order by n desc, chain, cdr3) \"rank\" from c qualify \"rank\" <= 10")
def top_clonotypes(s, d):
    """The most frequent clonotypes: a bounded top-k before the ranking."""
    from pyspark.sql import Window

    top = R.contigs(s, d).groupBy("chain", "cdr3").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "chain", "cdr3").limit(10)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), "chain", "cdr3")).cast("long"))


@query("pt", """
with c as (select 'kmeans' kind, cluster % 3 + 2 k, count(*) n from pt group by 2 union all select 'graph', 0, count(*) from pt)
select kind, k, n, row_number() over (order by case kind when 'graph' then 0 else 1 end, k) place from c""")
def sorted_clusterings(s, d):
    """Graph clusters first, then k-means by k."""
    from pyspark.sql import Window

    p = R.points(s, d)
    each = p.groupBy((F.col("cluster") % 3 + 2).alias("k")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("kmeans"))
    every = p.agg(F.count("*").alias("n")).select(F.lit(0).alias("k"), "n", F.lit("graph").alias("kind"))
    place = F.row_number().over(Window.orderBy(F.when(F.col("kind") == "graph", 0).otherwise(1), "k"))
    return each.unionByName(every).withColumn("place", place.cast("long")).select("kind", "k", "n", "place")


def _lists(s, d):
    """Per order: sorted parts, and their quantities."""
    li = R.table(s, d, "lineitem").select("l_orderkey", F.struct("l_partkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q")).alias("x"))
    return li.groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list("x")).alias("x")).select("id", F.col("x.l_partkey").alias("a"), F.col("x.q").alias("q"))


_LISTS = 'lists as (select l_orderkey id, list(l_partkey order by l_partkey, l_linenumber, l_quantity) a, list(l_quantity::int order by l_partkey, l_linenumber, l_quantity) q from lineitem group by 1)'


@query("", f"with {_LISTS} select id, list_reverse_sort(q) q from lists")
def reverse_sorted(s, d):
    return _lists(s, d).select("id", F.sort_array("q", asc=False).alias("q"))


@query("", f"with {_LISTS} select id, [x[2] for x in list_sort(list_zip(q, a))] a from lists")
def sorted_together(s, d):
    return _lists(s, d).select("id", W.sort_by_keys(F.col("a"), F.col("q")).alias("a"))


@query("", f"with {_LISTS} select x.id, list_sort(list_distinct(list_intersect(x.q, y.q))) q, len(list_intersect(x.q, y.q)) > 0 meet from lists x join lists y on y.id = x.id + 1")
def list_intersections(s, d):
    x = _lists(s, d)
    y = x.select((F.col("id") - 1).alias("id"), F.col("q").alias("r"))
    return x.join(y, "id").select("id", F.array_sort(F.array_intersect("q", "r")).alias("q"), W.meets(F.col("q"), F.col("r")).alias("meet"))


@query("", f"with {_LISTS} select id, len(q) > 2 and q[2] = q[len(q)] found from lists")
def contained_at(s, d):
    """Whether the last quantity stands at place 1 as well, with something after it."""
    x = _lists(s, d)
    return x.select("id", (W.contains_at(F.col("q"), F.slice("q", -1, 1), F.lit(1)) & (F.size("q") > 2)).alias("found"))


@query("", f"with {_LISTS} select id, len([v for v in a if v < 100]) place from lists")
def lower_bounds(s, d):
    return _lists(s, d).select("id", W.lower_bound(F.col("a"), F.lit(100)).cast("long").alias("place"))


@query("", """
with l as (select l_orderkey id, l_linenumber n, l_partkey, l_quantity, l_quantity::int % 2 v, row_number() over (partition by l_orderkey order by l_partkey, l_linenumber, l_quantity) i, count(*) over (partition by l_orderkey) c from lineitem),
e as (select x.id, x.i, coalesce(min(y.i) - 1, x.c) e from l x left join l y on y.id = x.id and y.i > x.i and y.v <> x.v group by 1, 2, x.c)
select id, list(e order by i) ends from e group by 1""")
def run_boundaries(s, d):
    odd = F.transform("q", lambda v: v % 2)
    return _lists(s, d).select("id", F.transform(W.run_ends(odd), lambda v: v.cast("long")).alias("ends"))


@query("", f"with {_LISTS} select id, [v for v in q if v % 3 <> 0] q from lists")
def erased_places(s, d):
    return _lists(s, d).select("id", W.erase(F.col("q"), F.transform("q", lambda v: v % 3 == 0)).alias("q"))


@query("feat", """
with a as (select name, feature_type, row_number() over (order by feature) - 1 "index" from feat where genome = 'g0'), b as (select name, feature_type, row_number() over (order by feature) - 1 i from feat where genome = 'g1')
select * from a union all select name, feature_type, i + (select count(*) from a) from b""")
def joined_references(s, d):
    from pyspark.sql import Window

    f = R.features(s, d)
    part = lambda g: f.where(F.col("genome") == g).select("name", "feature_type", (F.row_number().over(Window.orderBy("feature")) - 1).cast("long").alias("index"))
    return W.join_features(part("g0"), part("g1"))


@query("coo", "select barcode + (select max(s_suppkey) from supplier) * k barcode, feature, umi_count from coo, (select unnest([0, 1]) k)")
def concatenated_matrices(s, d):
    """Two gem wells of one reference, their barcodes kept apart."""
    coo, f = R.coo(s, d), R.features(s, d)
    most = R.table(s, d, "supplier").agg(F.max("s_suppkey")).first()[0]
    return W.concat_columns(coo, coo.withColumn("barcode", F.col("barcode") + F.lit(most)), f, f)


@query("", r"select doc_id, case when text like '%the %' and instr(substr(text, instr(text, 'the ') + 4), '.') > 0 then split_part(substr(text, instr(text, 'the ') + 4), '.', 1) end part from documents")
def text_between(s, d):
    return R.table(s, d, "documents").select("doc_id", W.between(F.col("text"), "the ", ".").alias("part"))


@query("", "select s_suppkey, case when s_suppkey % 7 = 0 then '\"NaN\"' when s_suppkey % 7 = 1 then '\"inf\"' when s_suppkey % 7 = 2 then 'null' else (s_suppkey / 4.0)::double::varchar end j from supplier")
def safe_numbers(s, d):
    k = F.col("s_suppkey")
    value = F.when(k % 7 == 0, float("nan")).when(k % 7 == 1, float("inf")).when(k % 7 == 2, F.lit(None).cast("double")).otherwise(k / 4.0)
    return R.table(s, d, "supplier").select("s_suppkey", W.safe_number(value).alias("j"))


@query("", """
with k as (select user_id, event_type, value, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) r from events)
select user_id, event_type, value last_value from k where r = 1""")
def merged_metrics(s, d):
    """Metric maps of one sample merged, the last value of a key wins."""
    e = R.table(s, d, "events").groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("last_value"))
    merged = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "last_value"))).alias("m"))
    return merged.select("user_id", F.explode("m").alias("event_type", "last_value"))


@query("tg", "select feature, string_agg(barcode, ',' order by barcode) barcodes, count(*) n from tg where n >= 2 group by 1")
def feature_barcodes(s, d):
    x = R.tags(s, d).where("n >= 2").groupBy("feature").agg(F.array_sort(F.collect_set("barcode")).alias("b"))
    return x.select("feature", F.array_join(F.col("b").cast("array<string>"), ",").alias("barcodes"), F.size("b").cast("long").alias("n"))


@query("", f"select o_orderkey id, regexp_matches({R._dna('o_orderkey', 16)}, 'A{{3,}}|C{{3,}}|G{{3,}}|T{{3,}}') homopolymer from orders")
def homopolymer_features(s, d):
    return R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), W.homopolymer(S.dna(F.col("o_orderkey"), 16), 3).alias("homopolymer"))


@query("", f"""
with x as (select o_orderkey id, {R._dna('o_orderkey', 24)} s, {R._dna('o_orderkey % 5', 8)} p, (o_orderkey % 10)::int a from orders) select id, substr(s, a + 1, 2) = substr(p, 1, 2) unusual from x""")
def unusual_molecules(s, d):
    o = R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"))
    seq, probe = S.dna(F.col("id"), 24), S.dna(F.col("id") % 5, 8)
    return o.select("id", W.suffix_prefix(seq, (F.col("id") % 10 + 1).cast("int"), 2, probe).alias("unusual"))


@query("", f"select o_orderkey id, translate({R._dna('o_orderkey', 8)}, 'ACGT', 'TGCA') splint from orders")
def splint_translation(s, d):
    return R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.translate(S.dna(F.col("o_orderkey"), 8), "ACGT", "TGCA").alias("splint"))


@query("coo bt", "select barcode, feature, round(log2(1 + umi_count * (select median(total) from bt) / total), 6) \"value\" from coo join bt using (barcode)")
def log_normalized(s, d):
    """Counts scaled to the median total, then their log2 + 1."""
    return M.normalize_by_umi(R.coo(s, d)).withColumn("value", F.round(F.log2(1 + F.col("value")), 6))


@query("", "select n, greatest(1, least(round(-230 + 120 * log10(n)), n - 1))::bigint k from (select count(*) n from orders union all select count(*) from customer union all select count(*) from supplier)")
def neighbours_to_use(s, d):
    sizes = [R.table(s, d, t).count() for t in ("orders", "customer", "supplier")]
    return s.createDataFrame([(n, W.neighbours_to_use(n)) for n in sizes], "n long, k long")


@query("tot", "select barcode, total from tot where total >= 500")
def minimum_umis(s, d):
    return R.totals(s, d).where("total >= 500")


@query("mol", "with b as (select barcode, sum(reads)::bigint reads, sum(reads) filter (gem_group = 'O')::bigint corrected from mol group by 1) select barcode, reads, corrected from b where corrected > 0.5 * reads and reads > 1000")
def highly_corrected(s, d):
    """Barcodes most of whose many reads had their barcode corrected."""
    b = R.molecules(s, d).groupBy("barcode").agg(F.sum("reads").alias("reads"), F.sum(F.when(F.col("gem_group") == "O", F.col("reads"))).alias("corrected"))
    return b.where("corrected > 0.5 * reads and reads > 1000")


@query("mol feat", """
select feature_type, library, count(distinct barcode) n_cells, sum(reads)::bigint reads, round(least(1, 20000.0 * count(distinct barcode) / sum(reads)), 6) rate
from mol join feat using (feature) group by 1, 2""")
def subsampling_rates(s, d):
    """The rate that brings each library of each type to a target of reads a cell."""
    m = R.molecules(s, d).join(R.features(s, d).select("feature", "feature_type"), "feature").groupBy("feature_type", "library")
    x = m.agg(F.count_distinct("barcode").alias("n_cells"), F.sum("reads").alias("reads"))
    return x.withColumn("rate", F.round(F.least(F.lit(1.0), 20000.0 * F.col("n_cells") / F.col("reads")), 6))


@query("tg", "with k as (select barcode, count(*) k from tg where n >= 2 group by 1), f as (select k, count(*) n from k group by 1) select round(sum(n) filter (k >= 3) / sum(n), 6) fat_tail from f")
def multiplet_fat_tail(s, d):
    k = R.tags(s, d).where("n >= 2").groupBy("barcode").agg(F.count("*").alias("k"))
    return k.agg(F.round(F.count_if(F.col("k") >= 3) / F.count("*"), 6).alias("fat_tail"))


@query("mol feat cell", """
select feature, count(distinct barcode) n_cells, sum(reads)::bigint reads, round(count(distinct umi) / sum(reads), 6) umis_per_read from mol semi join cell using (barcode) group by 1""")
def probe_pseudobulk(s, d):
    m = R.molecules(s, d).join(R.cells(s, d), "barcode", "left_semi").groupBy("feature")
    return m.agg(F.count_distinct("barcode").alias("n_cells"), F.sum("reads").alias("reads"), F.round(F.count_distinct("umi") / F.sum("reads"), 6).alias("umis_per_read"))


@query("mol feat", """
select library, genome, count(*) n, round(count(*) filter (gem_group = 'O') / count(*), 6) mapped, round(count(*) filter (gem_group = 'O' and reads >= 25) / count(*), 6) confident,
  round(count(*) filter (reads < 5) / count(*), 6) low_quality, round(sum(reads) filter (gem_group = 'O') / sum(reads), 6) mapped_reads from mol join feat using (feature) group by 1, 2""")
def alignment_metrics(s, d):
    """Shares of annotated reads by library and genome: all conditions in one pass."""
    m = R.molecules(s, d).join(R.features(s, d).select("feature", "genome"), "feature")
    mapped = F.col("gem_group") == "O"
    share = lambda c, to: F.round(F.count_if(c) / F.count("*"), 6).alias(to)
    return m.groupBy("library", "genome").agg(
        F.count("*").alias("n"), share(mapped, "mapped"), share(mapped & (F.col("reads") >= 25), "confident"), share(F.col("reads") < 5, "low_quality"),
        F.round(F.sum(F.when(mapped, F.col("reads"))) / F.sum("reads"), 6).alias("mapped_reads"),
    )


@query("ctg", """
select barcode, contig, umis % 2 = 0 starts, umis % 7 <> 0 in_frame, cdr3 > 0 has_cdr3, umis % 2 = 0 and umis % 7 <> 0 and cdr3 > 0 productive from ctg""")
def productive_contigs(s, d):
    """The rules a productive contig meets, each by itself and together."""
    c = R.contigs(s, d).select("barcode", "contig", (F.col("umis") % 2 == 0).alias("starts"), (F.col("umis") % 7 != 0).alias("in_frame"), (F.col("cdr3") > 0).alias("has_cdr3"))
    return c.withColumn("productive", F.col("starts") & F.col("in_frame") & F.col("has_cdr3"))


@query("", "select p_partkey, regexp_matches(p_name, '^[ACGTN]+$') dna from part union all select o_orderkey + 100000000, regexp_matches(" + R._dna("o_orderkey", 6) + ", '^[ACGTN]+$') from orders")
def nucleotide_strings(s, d):
    p = R.table(s, d, "part").select("p_partkey", F.col("p_name").alias("x"))
    o = R.table(s, d, "orders").select((F.col("o_orderkey") + 100000000).alias("p_partkey"), S.dna(F.col("o_orderkey"), 6).alias("x"))
    return p.unionByName(o).select("p_partkey", F.col("x").rlike("^[ACGTN]+$").alias("dna"))


@query("tot", "with m as (select max(total) m from tot) select distinct round_even(i * m / 10.0, 0)::bigint depth from m, (select unnest(range(1, 11)) i)")
def depth_targets(s, d):
    most = R.totals(s, d).agg(F.max("total")).first()[0]
    return s.createDataFrame([(x,) for x in C.depth_grid(int(most), 10)], "depth long")


def _align(local: bool):
    @F.pandas_udf("long")
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(A.scores(a.tolist(), b.tolist(), local))

    return udf


def _pairs(s, d):
    o = R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"))
    return o.select("id", S.dna(F.col("id"), 16).alias("a"), S.dna(F.col("id") % 97, 12).alias("b"))


@query()
def local_alignment(s, d):
    return _pairs(s, d).select("id", _align(True)("a", "b").alias("score"))


@query()
def global_alignment(s, d):
    return _pairs(s, d).select("id", _align(False)("a", "b").alias("score"))


@query("", """
with x as (select s_suppkey, (s_suppkey % 6)::int k, (10 + s_suppkey % 20)::int n from supplier),
t as (select s_suppkey, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.2) + (n - i) * ln(0.8))) p from x, unnest(range(0, k + 1)) u(i) group by 1) select s_suppkey, round(p, 6) p from t""")
def binomial_chances(s, d):
    @F.pandas_udf("double")
    def cdf(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([A.binomial_cdf(int(a), int(b), 0.2) for a, b in zip(k, n, strict=True)])

    k = F.col("s_suppkey")
    return R.table(s, d, "supplier").select("s_suppkey", F.round(cdf(k % 6, 10 + k % 20), 6).alias("p"))


@query("", "select s_suppkey, round(exp(lgamma(a + b + c + 1) - lgamma(a + 1) - lgamma(b + 1) - lgamma(c + 1)))::bigint ways from (select s_suppkey, s_suppkey % 3 a, s_suppkey % 4 b, s_suppkey % 5 c from supplier)")
def multinomial_ways(s, d):
    k = F.col("s_suppkey")
    a, b, c = k % 3, k % 4, k % 5
    ways = F.factorial((a + b + c).cast("int")) / (F.factorial(a.cast("int")) * F.factorial(b.cast("int")) * F.factorial(c.cast("int")))
    return R.table(s, d, "supplier").select("s_suppkey", ways.cast("long").alias("ways"))


@query("", """
with r as (select 0 i, 0 m, 1.0::double p union all
  select i + 1, m2, sum(p2) over (partition by i, m2) from (select i, unnest([m, m + 1]) m2, unnest([p * m / 12.0, p * (12 - m) / 12.0]) p2 from r where i < 10) qualify row_number() over (partition by i, m2) = 1)
select s_suppkey, round(sum(p), 6) p from supplier join r on i = s_suppkey % 8 + 2 and m <= 4 group by 1""")
def occupancy_chances(s, d):
    @F.pandas_udf("double")
    def chance(x: pd.Series) -> pd.Series:
        return x.map({v: A.few_distinct(4, int(v), 12) for v in x.unique()})

    return R.table(s, d, "supplier").select("s_suppkey", F.round(chance(F.col("s_suppkey") % 8 + 2), 6).alias("p"))


@query("tot", "select count(*) seen, round(ln(1 - count(*) / (2.0 * count(*))) / ln(1 - 1 / (2.0 * count(*))), 4) cells from tot")
def expected_total_cells(s, d):
    """Cells behind the partitions that hold any, were there twice as many partitions."""
    n = R.totals(s, d).count()
    return s.createDataFrame([(n, round(A.total_cells(n, 2 * n), 4))], "seen long, cells double")


@query("", "with l as (select 0.35::double l), k as (select unnest(range(0, 6)) k) select k, round(exp(-l) * l ** k / gamma(k + 1), 6) share from k, l")
def multiplet_shares(s, d):
    """Chances that a partition holds k cells."""
    k = s.range(6).select(F.col("id").alias("k"))
    return k.select("k", F.round(F.exp(F.lit(-0.35)) * F.pow(F.lit(0.35), F.col("k")) / F.factorial(F.col("k").cast("int")), 6).alias("share"))


@query()
def simplified_lines(s, d):
    """Each user's curve of values by Ramer-Douglas-Peucker; a curve is one task's."""

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["event_id"])
        kept = X.simplify_line(list(zip(pdf["event_id"].astype(float), pdf["value"], strict=True)), 5.0)
        return pd.DataFrame({"user_id": pdf["user_id"].iloc[0], "n": len(pdf), "kept": len(kept)}, index=[0])

    return R.table(s, d, "events").groupBy("user_id").applyInPandas(cut, "user_id long, n long, kept long")
