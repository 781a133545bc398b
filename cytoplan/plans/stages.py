"""Queries: checks of inputs, routing, annotation and summaries of whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.seq import dna
from ..operators import stages as G
from ..sources import formats as S
from ..sources.stage import stage_path
from . import roles as R
from .registry import query


@query("coo", "select count(*) entries, count(distinct feature) features, count(distinct barcode) barcodes, sum(umi_count)::bigint umis from coo")
def matrix_dimensions(s, d):
    return G.dimensions(R.coo(s, d))


@query("feat", """
with f as (select feature, "name" || ' ' || feature "name" from feat),
t as (select case when p_partkey % 9 = 0 then 'gene ' || p_partkey else p_name || ' ' || p_partkey end "name", p_size < 25 included from part, unnest(range(0, case when p_partkey % 5 = 0 then 2 else 1 end)) where p_partkey % 3 = 0),
l as (select "name", count(*) n, bool_or(included) included from t group by 1)
select "name", feature, case when feature is null then 'unknown' when n > 1 then 'repeated' when included then 'target' else 'excluded' end state from l left join f using ("name")""")
def target_features(s, d):
    """A target list by name against the feature reference."""
    k = F.col("p_partkey")
    name = F.when(k % 9 == 0, F.concat(F.lit("gene "), k)).otherwise(F.concat_ws(" ", "p_name", k))
    times = F.explode(F.array_repeat((F.col("p_size") < 25), F.when(k % 5 == 0, 2).otherwise(1)))
    targets = R.table(s, d, "part").where("p_partkey % 3 = 0").select(name.alias("name"), times.alias("included"))
    f = R.features(s, d)
    return G.target_features(f.withColumn("name", F.concat_ws(" ", "name", "feature")), targets)


@query("", """
with r as (select c_custkey k, case c_custkey % 7 when 0 then ' ' when 1 then 's ' || c_custkey when 2 then 's' || c_custkey % 50 else 's' || c_custkey end sample_id,
  c_mktsegment || case when c_custkey % 5 = 0 then '.csv' else '.h5' end path from customer)
select k, sample_id, path, case when trim(sample_id) = '' then 'no id' when regexp_matches(sample_id, '[^A-Za-z0-9_-]') then 'bad id' when count(*) over (partition by sample_id) > 1 then 'repeated id'
  when not path like '%.h5' then 'bad path' end fault from r""")
def aggregation_inputs(s, d):
    """The list of inputs of an aggregation, with the first fault of each row."""
    k = F.col("c_custkey")
    name = F.when(k % 7 == 0, " ").when(k % 7 == 1, F.concat(F.lit("s "), k)).when(k % 7 == 2, F.concat(F.lit("s"), k % 50)).otherwise(F.concat(F.lit("s"), k))
    path = F.concat("c_mktsegment", F.when(k % 5 == 0, ".csv").otherwise(".h5"))
    return G.checked_inputs(R.table(s, d, "customer").select(k.alias("k"), name.alias("sample_id"), path.alias("path")), "sample_id", "path", ".h5")


_KNOWN = {"num_pcs": ("int", 1, 100), "resolution": ("float", 0, 10), "clusters": ("int", 2, 50)}


@query("", """
with p as (select p_partkey k, case p_partkey % 4 when 0 then 'num_pcs' when 1 then 'resolution' when 2 then 'clusters' else 'colour' end "name",
  case p_partkey % 5 when 0 then 'x' || p_size when 1 then p_size || '.5' else p_size::varchar end "value" from part),
s(name, kind, least, most) as (values ('num_pcs', 'int', 1, 100), ('resolution', 'float', 0, 10), ('clusters', 'int', 2, 50)),
f as (select p.*, try_cast("value" as double) x, case when kind is null then 'unknown' when x is null then 'not a number' when kind = 'int' and x <> floor(x) then 'not whole' when x < least or x > most then 'out of range' end fault
  from p left join s using ("name"))
select "name", "value", case when fault is null then x end number, fault from f""")
def typed_parameters(s, d):
    """Lines of a parameter file, typed and held against their ranges."""
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    name = F.when(k % 4 == 0, "num_pcs").when(k % 4 == 1, "resolution").when(k % 4 == 2, "clusters").otherwise("colour")
    value = F.when(k % 5 == 0, F.concat(F.lit("x"), size)).when(k % 5 == 1, F.concat(size, F.lit(".5"))).otherwise(size)
    return G.typed_parameters(R.table(s, d, "part").select(F.concat(name, F.lit(" , "), value).alias("line")), _KNOWN)


@query("mol", "select barcode, feature, umi, reads, library, gem_group, 1 umi_type, -1 probe_idx from mol")
def upgraded_molecules(s, d):
    """A molecule table of an older layout, written and read, with the columns that newer ones have."""
    path = stage_path(s)
    R.molecules(s, d).write.parquet(path)
    return G.upgraded(s.read.parquet(path), {"umi_type": F.lit(1), "probe_idx": F.lit(-1), "umi": F.lit(0)})


@query("mol", "select library sample, gem_group, row_number() over (order by library, gem_group) new_group from (select distinct library, gem_group from mol)")
def renumbered_gem_groups(s, d):
    return G.renumbered_groups(R.molecules(s, d).select(F.col("library").alias("sample"), "gem_group"))


@query("mol ctg", """
with a as (select barcode from mol group by 1 order by sum(reads) desc, barcode limit 60), b as (select barcode from ctg group by 1 order by sum(umis) desc, barcode limit 60)
select count(a.barcode) n_a, count(b.barcode) n_b, count(a.barcode + b.barcode) shared, count(a.barcode + b.barcode) / least(count(a.barcode), count(b.barcode)) overlap from a full join b on a.barcode = b.barcode""")
def top_barcode_overlap(s, d):
    """Whether two libraries come from the same cells: the largest barcodes of both."""
    a = R.molecules(s, d).groupBy("barcode").agg(F.sum("reads").alias("n"))
    return G.top_overlap(a, R.contigs(s, d).groupBy("barcode").agg(F.sum("umis").alias("n")), 60)


@query("obs wl", """
with r as (select case when id % 3 = 0 then seq when id % 3 = 1 then seq || 'AC' else 'G' || seq end seq from obs), c(name, o, n) as (values ('five', 0, 6), ('three', 1, 6), ('long', 0, 8)),
h as (select name, count(*) n_reads, count(*) filter (length(seq) >= o + n and substr(seq, o + 1, n) in (select seq from wl)) n_hits from r, c group by 1),
x as (select *, n_hits / n_reads share, coalesce(lead(n_hits / n_reads) over (order by n_hits desc, name), 0) nxt, row_number() over (order by n_hits desc, name) p from h)
select name, n_reads, n_hits, share, p = 1 and n_reads >= 1000 and share >= 0.05 and share >= 1.5 * nxt chosen from x""")
def chemistry_candidates(s, d):
    """Layouts of a read scored by the share of reads with a listed barcode."""
    seq, k = F.col("seq"), F.col("id") % 3
    reads = R.observed(s, d).select(F.when(k == 0, seq).when(k == 1, F.concat(seq, F.lit("AC"))).otherwise(F.concat(F.lit("G"), seq)).alias("seq"))
    return G.detect_chemistry(reads, [("five", 0, 6), ("three", 1, 6), ("long", 0, 8)], R.whitelist(s, d), 1000, 0.05, 1.5)


@query("", f"""
with r as (select o_orderkey id, o_orderpriority library, {R._dna('o_custkey', 24)} seq from orders),
f as (select case when c_custkey % 2 = 0 then 'TR' else 'IG' end class, {R._dna('c_custkey', 24)} seq from customer where c_custkey % 4 = 0 or c_custkey % 23 = 1),
fk as (select kmer, min(class) class from (select class, substr(seq, i, 12) kmer from f, unnest(range(1, 14)) u(i)) group by 1 having count(distinct class) = 1),
h as (select id, min(class) class from (select distinct id, substr(seq, i, 12) kmer from r, unnest(range(1, 14)) u(i)) join fk using (kmer) group by 1 having count(distinct class) = 1),
n as (select library, count(*) n_reads, count(*) filter (class = 'TR') tr_reads, count(*) filter (class = 'IG') ig_reads from r left join h using (id) group by 1)
select *, case when tr_reads / n_reads < 0.05 and ig_reads / n_reads < 0.05 then 'none' when tr_reads > 3 * ig_reads then 'TR' when ig_reads > 3 * tr_reads then 'IG' else 'unclear' end receptor from n""")
def receptor_class(s, d):
    """The receptor of each library by reads that hold k-mers of one class of the reference alone."""
    reads = R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("library"), dna(F.col("o_custkey"), 24).alias("seq"))
    kind = F.when(F.col("c_custkey") % 2 == 0, "TR").otherwise("IG")
    ref = R.table(s, d, "customer").where("c_custkey % 4 = 0 or c_custkey % 23 = 1").select(kind.alias("class"), dna(F.col("c_custkey"), 24).alias("seq"))
    return G.detect_receptor(reads, ref, 12, "library")


@query("", """
with r as (select l_orderkey read, l_linenumber place, l_quantity > 40 uniq, case when l_quantity < 20 then [] when l_discount > 0.08 then [l_partkey % 3, l_partkey % 5] else [l_partkey % 2] end genes,
  row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity) d from lineitem qualify d = 1),
g as (select read, bool_or(uniq) u, min(place) filter (len(genes) = 1) first, len(list_distinct(flatten(list(genes)))) n from r group by 1)
select read, place, case when uniq then 'unique' when u or n <> 1 or first is null then 'kept' when place = first then 'promoted' else 'demoted' end state from r join g using (read)""")
def rescued_alignments(s, d):
    """Alignments of reads that hit the genome more than once, by the genes that they hit."""
    li = R.table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("read"), F.col("l_linenumber").alias("place")).agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_discount")).alias("x"))
    p = F.col("x.l_partkey")
    genes = F.when(F.col("x.l_quantity") < 20, F.array().cast("array<bigint>")).when(F.col("x.l_discount") > 0.08, F.array(p % 3, p % 5)).otherwise(F.array(p % 2))
    return G.rescued_alignments(li.select("read", "place", (F.col("x.l_quantity") > 40).alias("unique"), genes.alias("genes")))


@query("", """
with h as (select o_orderkey read, o_custkey l, o_custkey + o_orderkey % 3 r from orders), p as (select c_custkey probe, c_custkey // 4 gene from customer where c_custkey % 6 > 0),
x as (select read, a.gene left_gene, b.gene right_gene from h left join p a on l = a.probe left join p b on r = b.probe)
select *, case when left_gene is null and right_gene is null then 'unmapped' when left_gene is null or right_gene is null then 'half' when left_gene = right_gene then 'confident' else 'split' end state from x""")
def probe_pairs(s, d):
    """Reads by the genes of the probes that their two halves hit."""
    o = R.table(s, d, "orders").select(F.col("o_orderkey").alias("read"), F.col("o_custkey").alias("k"))
    sides = F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("k").alias("probe")), F.struct(F.lit("right").alias("side"), (F.col("k") + F.col("read") % 3).alias("probe"))))
    probes = R.table(s, d, "customer").where("c_custkey % 6 > 0").select(F.col("c_custkey").alias("probe"), F.floor(F.col("c_custkey") / 4).alias("gene"))
    return G.probe_pairs(o.select("read", sides.alias("h")).select("read", "h.side", "h.probe"), probes)


@query("ctg", """
with c as (select barcode, list_sort(list_distinct(list(concat_ws('|', chain, cdr3)))) chains from ctg where productive group by 1)
select array_to_string(chains, ',') chains, count(*) n_cells, min(barcode) first_barcode, len(chains) n_chains from c group by 1, 4""")
def exact_subclonotypes(s, d):
    return G.exact_subclonotypes(R.contigs(s, d).where("productive"), ["chain", "cdr3"]).withColumn("chains", F.array_join("chains", ","))


_CHAINS = "x as (select p_size % 5 clonotype, p_partkey % 60 exact, 'c' || (p_partkey * 7 + p_size) % 4 chain, max(case when p_partkey % 60 < 20 then 900 else 2 end) cells from part group by 1, 2, 3)"


@query("", f"""
with {_CHAINS}, o as (select clonotype, exact, list(distinct chain order by chain) sig, max(cells) cells from x group by 1, 2 having count(distinct chain) >= 2),
f as (select clonotype, sig, sum(cells) n from o group by 1, 2),
b as (select a.clonotype, a.sig from f a join f p on a.clonotype = p.clonotype and len(p.sig) = 2 and p.sig <> a.sig and list_has_any(a.sig, p.sig) group by 1, 2, a.n having sum(p.n) > 20 * a.n)
select clonotype, exact, cells from o semi join b using (clonotype, sig)""")
def outweighed_signatures(s, d):
    """Exact subclonotypes whose set of chains looks mixed from others."""
    k, size = F.col("p_partkey"), F.col("p_size")
    x = R.table(s, d, "part").groupBy((size % 5).alias("clonotype"), (k % 60).alias("exact"), F.concat(F.lit("c"), (k * 7 + size) % 4).alias("chain"))
    return G.signature_filter(x.agg(F.max(F.when(k % 60 < 20, 900).otherwise(2)).alias("cells")))


@query("", """
with x as (select o_orderkey barcode, o_custkey exact, 1 + o_custkey % 2 chains, o_custkey % 5 = 0 joined from orders)
select barcode, exact, case when chains = 1 and count(*) over (partition by exact) > 1 and count(*) over (partition by exact) * 1000 < count(*) over () and not joined then barcode end part from x""")
def split_singles(s, d):
    """One-chain subclonotypes of several cells that are joined with nothing, taken apart."""
    k = F.col("o_custkey")
    return G.split_singles(R.table(s, d, "orders").select(F.col("o_orderkey").alias("barcode"), k.alias("exact"), (1 + k % 2).alias("chains"), (k % 5 == 0).alias("joined")))


@query("", """
with m as (select c_nationkey clonotype, c_custkey node from customer), l as (select c_custkey a, c_custkey + 25 * (1 + c_custkey % 3) b from customer where c_custkey % 4 > 0),
e as (select a, b from l join m x on x.node = a join m y on y.node = b where x.clonotype = y.clonotype), f as (select a, b from e union select b, a from e),
reach as (select a, a b from f union select reach.a, f.b from reach join f on reach.b = f.a), c as (select a node, min(b) part from reach group by 1)
select clonotype, node, coalesce(part, node) part from m left join c using (node)""")
def split_clonotypes(s, d):
    """Clonotypes whose members no longer hang together, in parts."""
    c = R.table(s, d, "customer")
    links = c.where("c_custkey % 4 > 0").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 25 * (1 + F.col("c_custkey") % 3)).alias("b"))
    return G.split_clonotypes(c.select(F.col("c_nationkey").alias("clonotype"), F.col("c_custkey").alias("node")), links).select("clonotype", "node", "part")


@query("ctg", """
with r as (select barcode, list_filter([case when count(*) < 4 then 'few_contigs' end, case when sum(umis) < 1500 then 'few_umis' end, case when not bool_or(productive) then 'not_productive' end], lambda v: v is not null) r from ctg group by 1),
e as (select unnest(r) reason, len(r) = 1 alone from r) select reason, count(*) barcodes, count(*) filter (alone) only_this from e group by 1""")
def filter_summary(s, d):
    """Barcodes that each filter drops, and that no other one does."""
    c = R.contigs(s, d).groupBy("barcode").agg(F.count("*").alias("n"), F.sum("umis").alias("u"), F.bool_or("productive").alias("p"))
    rules = F.array_compact(F.array(F.when(F.col("n") < 4, "few_contigs"), F.when(F.col("u") < 1500, "few_umis"), F.when(~F.col("p"), "not_productive")))
    return G.reason_table(c.select("barcode", rules.alias("reasons")))


@query("pt", """
with c as (select id, cluster, 't' || id % 3 coarse, 't' || id % 12 fine from pt), n as (select cluster, coarse, fine, count(*) n from c group by all),
x as (select *, n / sum(n) over (partition by cluster) share, sum(n) over (partition by cluster, coarse) / sum(n) over (partition by cluster) coarse_share, row_number() over (partition by cluster order by n desc, coarse, fine) "rank" from n)
select cluster, coarse, fine, n, round(share, 9) share, round(coarse_share, 9) coarse_share, "rank" from x where "rank" <= 3""")
def cell_type_summary(s, d):
    """Top fine types of each cluster with the share of their coarse type."""
    kind = lambda m: F.concat(F.lit("t"), F.col("id") % m)
    x = G.type_summary(R.points(s, d).select("cluster", kind(3).alias("coarse"), kind(12).alias("fine")), 3)
    return x.select("cluster", "coarse", "fine", "n", F.round("share", 9).alias("share"), F.round("coarse_share", 9).alias("coarse_share"), "rank")


@query("pt", "select cluster, count(*) n, row_number() over (order by count(*) desc, cluster) number from pt group by 1")
def label_numbers(s, d):
    return G.label_index(R.points(s, d), "cluster")


@query("pt", "select 'kmeans_' || k clustering, id, (cluster * 7 + id) % k + 1 label from pt, (values (2), (3), (5)) v(k) union all select 'graph', id, cluster + 1 from pt")
def combined_clusterings(s, d):
    """Every clustering of the cells in one long table."""
    p = R.points(s, d)
    each = [p.select(F.lit(f"kmeans_{k}").alias("clustering"), "id", ((F.col("cluster") * 7 + F.col("id")) % k + 1).alias("label")) for k in (2, 3, 5)]
    return G.union_all([*each, p.select(F.lit("graph").alias("clustering"), "id", (F.col("cluster") + 1).cast("long").alias("label"))])


@query("ctg", """
with c as (select barcode, list((chain, cdr3) order by chain, cdr3) k from ctg where productive group by 1), g as (select k, row_number() over (order by count(*) desc, len(k), k) clonotype_id, count(*) frequency from c group by k)
select t.barcode, contig, t.chain, clonotype_id, frequency from ctg t left join c using (barcode) left join g using (k)""")
def contigs_with_clonotypes(s, d):
    """All contigs with the clonotype of their cell, where it has one."""
    from ..operators import vdj as V

    x = R.contigs(s, d)
    ids = V.keyed_clonotypes(x.withColumn("is_cell", F.lit(True)), ["chain", "cdr3"]).select("barcode", "clonotype_id", "frequency")
    return x.select("barcode", "contig", "chain").join(ids, "barcode", "left")


@query("ctg", """
with m as (select barcode, contig, chain, umis, 's' || barcode % 3 sample from ctg where barcode % 4 > 0), v as (select conv_id barcode, max(turn) m from conversations group by 1)
select sample, m.barcode, contig, umis from m join v using (barcode) where v.m % 2 = 1""")
def merged_sample_annotations(s, d):
    """Contigs cut to the barcodes of each sample, samples joined again."""
    x = R.contigs(s, d)
    called = x.groupBy("barcode").agg(F.max("contig").alias("m")).where("m % 2 = 1 and barcode % 4 > 0")
    each = lambda i: x.join(called.where(F.col("barcode") % 3 == i), "barcode", "left_semi").select(F.lit(f"s{i}").alias("sample"), "barcode", "contig", "umis")
    return G.union_all([each(i) for i in range(3)])


@query("ctg", "select barcode, contig, chain, cdr3, umis, case when productive then 'true' else 'false' end productive, 'clonotype' || cdr3 clonotype from ctg")
def annotation_csv(s, d):
    """Nested annotations of cells written as one flat CSV and read back."""
    path = stage_path(s)
    nested = R.contigs(s, d).groupBy("barcode").agg(F.collect_list(F.struct("contig", "chain", "cdr3", "umis", "productive")).alias("contigs"))
    flat = nested.select("barcode", F.inline("contigs")).withColumn("clonotype", F.concat(F.lit("clonotype"), "cdr3"))
    S.concat_csv([flat], path)
    return S.read_csv_checked(s, path, "barcode long, contig long, chain string, cdr3 long, umis long, productive string, clonotype string", ["barcode", "contig"])


@query("tg ctg", """
with c as (select barcode, min(cdr3) clonotype from ctg where productive group by 1)
select clonotype, feature, count(*) cells, sum(n)::bigint umis, round(ln(1 + sum(n)) / ln(10), 6) log_umis, round(sum(n) / count(*), 6) mean_umis from tg join c using (barcode) group by 1, 2""")
def antigens_by_clonotype(s, d):
    """Antigen UMIs of the cells of each clonotype: only barcodes with receptors count."""
    c = R.contigs(s, d).where("productive").groupBy("barcode").agg(F.min("cdr3").alias("clonotype"))
    x = R.tags(s, d).join(c, "barcode").groupBy("clonotype", "feature").agg(F.count("*").alias("cells"), F.sum("n").alias("umis"))
    return x.withColumn("log_umis", F.round(F.log10(1.0 + F.col("umis")), 6)).withColumn("mean_umis", F.round(F.col("umis") / F.col("cells"), 6))


@query("mol cell", """
with a as (select feature probe, count(*) umis, count(*) filter (barcode in (select barcode from cell)) cell_umis, sum(reads)::bigint reads from mol group by 1)
select p_partkey probe, coalesce(umis, 0) umis, coalesce(cell_umis, 0) cell_umis, coalesce(reads, 0) reads, p_size > 10 and coalesce(umis, 0) >= 3 passes from part left join a on p_partkey = probe""")
def probe_metrics(s, d):
    """Counts of every probe of the set over all barcodes and over cells."""
    m = R.molecules(s, d).join(R.cells(s, d).withColumn("cell", F.lit(1)), "barcode", "left")
    a = m.groupBy(F.col("feature").alias("probe")).agg(F.count("*").alias("umis"), F.count("cell").alias("cell_umis"), F.sum("reads").alias("reads"))
    p = R.table(s, d, "part").select(F.col("p_partkey").alias("probe"), "p_size").join(a, "probe", "left").na.fill(0, ["umis", "cell_umis", "reads"])
    return p.select("probe", "umis", "cell_umis", "reads", ((F.col("p_size") > 10) & (F.col("umis") >= 3)).alias("passes"))


@query("coo cell", """
select 'raw' kind, barcode, sum(umi_count)::bigint umis, count(*) features from coo group by 2 union all
select 'filtered', barcode, sum(umi_count)::bigint, count(*) from coo semi join cell using (barcode) group by 2""")
def written_matrices(s, d):
    """Raw and filtered matrices written in one folder, split by kind and sorted by barcode, and read back."""
    path, coo = stage_path(s), R.coo(s, d)
    both = G.union_all([coo.withColumn("kind", F.lit("raw")), coo.join(R.cells(s, d), "barcode", "left_semi").withColumn("kind", F.lit("filtered"))])
    both.repartitionByRange("kind", "barcode").sortWithinPartitions("kind", "barcode", "feature").write.partitionBy("kind").parquet(path)
    return s.read.parquet(path).groupBy("kind", "barcode").agg(F.sum("umi_count").alias("umis"), F.count("*").alias("features"))


@query("mol", """
with m as (select distinct library sample, barcode from mol), w as (select distinct 'A' sample, barcode from mol where feature % 2 = 0 union select 'X', 1)
select sample, count(*) wanted, count(m.barcode) found, bool_and(m.barcode is not null) ok from w left join m using (sample, barcode) group by 1""")
def verified_samples(s, d):
    """Barcodes that a reanalysis asks for against those that exist."""
    have = R.molecules(s, d).select(F.col("library").alias("sample"), "barcode").distinct().withColumn("there", F.lit(1))
    asked = R.molecules(s, d).where("feature % 2 = 0").select(F.lit("A").alias("sample"), "barcode").union(s.range(1).selectExpr("'X'", "1L")).distinct()
    return asked.join(have, ["sample", "barcode"], "left").groupBy("sample").agg(F.count("*").alias("wanted"), F.count("there").alias("found"), F.bool_and(F.col("there").isNotNull()).alias("ok"))


@query("ctg", """
with n as (select barcode, chain, count(*) n from ctg group by 1, 2), m as (select barcode, array_to_string(list(chain || '=' || n order by chain) filter (n > 1), ',') calls from n group by 1) select barcode, nullif(calls, '') calls from m""")
def sanitized_calls(s, d):
    """Maps of calls as text; an empty map is null."""
    n = R.contigs(s, d).groupBy("barcode", "chain").agg(F.count("*").alias("n")).groupBy("barcode").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("chain", "n")))).alias("m"))
    kept = F.map_filter("m", lambda k, v: v > 1)
    text = F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return n.select("barcode", F.when(F.size(kept) > 0, text).alias("calls"))


@query("pt", """
with t as (select id, 't' || id % 12 kind from pt), x as (select id, kind, round(vec[1]::double, 6) c1, round(vec[2]::double, 6) c2, row_number() over (partition by kind order by md5(id || ':7'), id) nth from pt join t using (id))
select id, kind, c1, c2, nth from x where nth <= 10""")
def projected_type_sample(s, d):
    """Coordinates of cells with their types, at most ten cells a type by a fixed draw."""
    p = R.points(s, d)
    types = p.select("id", F.concat(F.lit("t"), F.col("id") % 12).alias("kind"))
    at = p.select("id", *(F.round(F.get("vec", F.lit(i)).cast("double"), 6).alias(f"c{i + 1}") for i in range(2)))
    return G.group_draw(at.join(types, "id"), "kind", "id", 10, 7)


@query("", f"""
with q as (select o_orderkey id, {R._dna('o_orderkey % 97 + 1', 6)} s, (o_orderkey % 6)::int p, case when o_orderkey % 5 = 0 then 'N' else substr('ACGT', (o_orderkey % 4 + 1)::int, 1) end b from orders),
u as (select id, case when id % 50 = 7 then 'AAAAAA' else substr(s, 1, p) || b || substr(s, p + 2) end seq from q)
select id, seq, not contains(seq, 'N') and seq <> repeat(substr(seq, 1, 1), 6) and list_min([5 + (id + i * 7) % 28 for i in range(1, 7)]) >= 8 valid from u""")
def umi_validity(s, d):
    """UMIs by their bases and their least quality."""
    x = R.observed(s, d).withColumn("seq", F.when(F.col("id") % 50 == 7, "AAAAAA").otherwise(F.col("seq")))
    return G.valid_umis(x, 8).select("id", "seq", "valid")


@query("mol", """
with c as (select barcode, feature, sum(reads)::bigint n from mol group by 1, 2), r as (select *, row_number() over (partition by barcode order by n desc, feature) a, row_number() over (partition by barcode order by n, feature) b from c)
select barcode, max(feature) filter (a = 1) max_key, max(feature) filter (b = 1) min_key from r group by 1""")
def extreme_features(s, d):
    """The features with the most and the fewest reads of each barcode."""
    c = R.molecules(s, d).groupBy("barcode", "feature").agg(F.sum("reads").alias("n"))
    return G.extreme_keys(c, "barcode", "feature", "n")


@query("coo feat", """
with k as (select feature from feat where feature_type in (select feature_type from feat group by 1 order by 1 limit 2)) select barcode, feature, umi_count from coo semi join k using (feature)""")
def select_features_by_types(s, d):
    """Counts of features of a set of types."""
    f = R.features(s, d)
    kinds = f.select("feature_type").distinct().orderBy("feature_type").limit(2)
    return R.coo(s, d).join(f.join(F.broadcast(kinds), "feature_type", "left_semi").select("feature"), "feature", "left_semi").select("barcode", "feature", "umi_count")


@query("ctg", """
select case chain when 'user' then 'first' when 'assistant' then 'second' else 'unrouted' end route, count(*) contigs, count(distinct barcode) barcodes, sum(umis)::bigint umis from ctg group by 1""")
def routed_by_chain(s, d):
    """Contigs dealt to the analysis of their chain, with what each receives."""
    x, chain = R.contigs(s, d), F.col("chain")
    routes = {"first": chain == "user", "second": chain == "assistant", "unrouted": chain.isNull() | ~chain.isin("user", "assistant")}
    parts = G.union_all([x.where(on).withColumn("route", F.lit(name)) for name, on in routes.items()])
    return parts.groupBy("route").agg(F.count("*").alias("contigs"), F.count_distinct("barcode").alias("barcodes"), F.sum("umis").alias("umis"))


@query("bt cell mol", "select distinct gem_group, barcode, barcode || '-' || gem_group \"name\" from mol semi join cell using (barcode)")
def gem_well_csvs(s, d):
    """Called barcodes of each gem well written as CSV and read back as one table."""
    called = R.molecules(s, d).select("gem_group", "barcode").distinct().join(R.cells(s, d), "barcode", "left_semi")
    path = stage_path(s)
    S.concat_csv([called.where(F.col("gem_group") == g).select("gem_group", "barcode", F.concat_ws("-", "barcode", "gem_group").alias("name")) for g in ("F", "O")], path)
    return S.read_csv_checked(s, path, "gem_group string, barcode long, name string", ["gem_group", "barcode", "name"])
