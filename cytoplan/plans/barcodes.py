"""Queries: sequences, whitelists, correction, deduplication, overlaps, mergeable metrics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import seq as S
from ..functions.stats import duplicate_fraction, effective_diversity, error_probability, log_gamma, robust_divide
from ..operators import barcodes as B
from . import roles as R
from .registry import query


@query("obs", """select id, seq, replace(seq, 'N', 'A') clean, reverse(translate(seq, 'ACGTN', 'TGCAN')) revcomp, contains(seq, 'N') has_n,
  length(replace(seq, substr(seq, 1, 1), '')) = 0 homopolymer, ends_with(seq, 'TT') polyt, not contains(seq, 'N') and length(replace(seq, substr(seq, 1, 1), '')) > 0 valid, 'N' || substr(seq, 2, 3) || 'NN' masked from obs""")
def sequence_flags(s, d):
    q = F.col("seq")
    return R.observed(s, d).select("id", "seq", F.replace(q, F.lit("N"), F.lit("A")).alias("clean"), S.reverse_complement(q).alias("revcomp"), S.has_n(q).alias("has_n"), S.is_homopolymer(q).alias("homopolymer"), S.has_polyt_suffix(q, 2).alias("polyt"), S.is_valid_umi(q).alias("valid"), S.mask_outside(q, 1, 4).alias("masked"))


@query("wl", """select seq, list_sum(list_transform(range(1, 7), lambda i: (strpos('ACGT', substr(seq, i::int, 1)) - 1) * 4 ** (6 - i)))::bigint code from wl""")
def encode_sequences(s, d):
    return R.whitelist(s, d).select("seq", S.encode_2bit(F.col("seq")).alias("code"))


@query("wl", """with n as (select seq, substr(seq, 1, i - 1) || b || substr(seq, i + 1) near from wl, unnest(range(1, 7)) p(i), unnest(['A', 'C', 'G', 'T']) q(b) where substr(seq, i, 1) <> b)
select a.seq, b.seq near from n a join wl b on a.near = b.seq""")
def hamming_neighbours(s, d):
    w = R.whitelist(s, d)
    return w.select("seq", F.explode(S.one_substitutions(F.col("seq"))).alias("near")).join(w.select(F.col("seq").alias("near")), "near", "left_semi").select("seq", "near")


@query("obs", """
with c as (select id, seq, translate(seq, 'TCAGN', '01230') d from obs)
select id, substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', substr(d, 1, 1)::int * 16 + substr(d, 2, 1)::int * 4 + substr(d, 3, 1)::int + 1, 1)
  || substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', substr(d, 4, 1)::int * 16 + substr(d, 5, 1)::int * 4 + substr(d, 6, 1)::int + 1, 1) amino,
  substr(seq, 1, 3) = 'ATG' start_codon, substr(seq, 4, 3) in ('TAA', 'TAG', 'TGA') stop_codon from c where not contains(seq, 'N')""")
def translate_sequences(s, d):
    q = F.col("seq")
    return R.observed(s, d).where(~S.has_n(q)).select("id", S.translate_codons(q).alias("amino"), S.has_start(q, 0).alias("start_codon"), S.has_stop(q, 3).alias("stop_codon"))


@query("obs wl", """
with c as (select distinct seq, strpos('ACGT', b) o, replace(seq, 'N', b) t from obs, unnest(['A', 'C', 'G', 'T']) u(b) where length(seq) - length(replace(seq, 'N', '')) <= 1),
m as (select c.seq, arg_min(wl.seq, o) m from c join wl on wl.seq = t group by 1)
select id, seq, m "match" from obs left join m using (seq)""")
def whitelist_match_one_n(s, d):
    w = R.whitelist(s, d).select("seq", F.col("seq").alias("canonical"))
    return B.whitelist_match(R.observed(s, d).select("id", "seq"), w).select("id", "seq", "match")


@query("obs wl", """
with u as (select * from obs where seq not in (select seq from wl)),
t as (select id, seq, i, substr(seq, 1, i - 1) || b || substr(seq, i + 1) t from u, unnest(range(1, 7)) p(i), unnest(['A', 'C', 'G', 'T']) q(b) where substr(seq, i, 1) <> b),
h as (select id, t.seq, t, 10 ** (-least(5 + (id + i * 7) % 28, 33) / 10.0) * (1 + "count") w from t join wl on wl.seq = t)
select id, seq, case when max(w) / sum(w) >= 0.975 then arg_max(t, (w, t)) end corrected, round(max(w) / sum(w), 6) posterior, count(*) n_candidates from h group by id, seq""")
def barcode_correction_posterior(s, d):
    return B.barcode_posterior(R.observed(s, d), R.whitelist(s, d)).withColumn("posterior", F.round("posterior", 6))


@query("obs wl", """
with u as (select distinct seq from obs where seq not in (select seq from wl)),
t as (select seq, 'sub' k, substr(seq, 1, i - 1) || b || substr(seq, i + 1) t from u, unnest(range(1, 7)) p(i), unnest(['A', 'C', 'G', 'T']) q(b) where substr(seq, i, 1) <> b
  union select seq, 'ind', substr(seq, 1, i - 1) || b || substr(seq, i) from u, unnest(range(1, 8)) p(i), unnest(['A', 'C', 'G', 'T']) q(b)
  union select seq, 'ind', substr(seq, 1, i - 1) || substr(seq, i + 1) from u, unnest(range(1, 7)) p(i)),
w2 as (select seq from wl where hash(seq) is not null union select substr(seq, 1, 5) from wl union select seq || 'A' from wl),
h as (select t.seq, count(distinct t) filter (k = 'sub') n_sub, count(distinct t) filter (k = 'ind') n_indel from t join w2 on w2.seq = t group by 1)
select u.seq, coalesce(n_sub, 0) n_sub, coalesce(n_indel, 0) n_indel, case when n_sub > 0 and n_indel > 0 then 'ambiguous' when n_sub > 0 then 'substitution' when n_indel > 0 then 'indel' else 'none' end kind
from u left join h using (seq)""")
def indel_ambiguity(s, d):
    w = R.whitelist(s, d).select("seq")
    whole = w.union(w.select(F.substring("seq", 1, 5))).union(w.select(F.concat("seq", F.lit("A")))).distinct()
    return B.indel_classes(R.observed(s, d), whole)


_MOVE = """
hole as (select uc.*, i, substr(umi, 1, i - 1) || '_' || substr(umi, i + 1) mask from uc, unnest(range(1, 6)) u(i)),
near as (select a.barcode, a.gene, a.umi, max((b.reads, b.umi)) top from hole a join hole b on a.barcode = b.barcode and a.gene = b.gene and a.mask = b.mask
  and a.umi <> b.umi and (b.reads > a.reads or (b.reads = a.reads and b.umi > a.umi)) group by 1, 2, 3),
mv as (select uc.*, coalesce(top[2], umi) corrected from uc left join near using (barcode, gene, umi))"""


@query("uc", f"with {_MOVE} select * from mv")
def umi_correction(s, d):
    return B.correct_umis(R.umi_counts(s, d)).select("barcode", "gene", "umi", "reads", "corrected")


@query("uc", "select *, reads < max(reads) over w or count(*) over (partition by barcode, umi, reads) > 1 low_support from uc window w as (partition by barcode, umi)")
def low_support_umis(s, d):
    return B.low_support(R.umi_counts(s, d)).select("barcode", "gene", "umi", "reads", "low_support")


@query("uc", f"""with {_MOVE},
f1 as (select barcode, gene, umi, reads - (corrected <> umi)::int reads from mv union all select barcode, gene, corrected, 1 from mv where corrected <> umi),
f as (select barcode, gene, umi, sum(reads)::bigint reads from f1 group by all having sum(reads) > 0),
lo as (select *, reads < max(reads) over (partition by barcode, umi) or count(*) over (partition by barcode, umi, reads) > 1 low from f),
fu as (select barcode, gene, corrected umi, sum(reads)::bigint reads from mv group by all)
select fu.* from fu left join lo on fu.barcode = lo.barcode and fu.gene = lo.gene and fu.umi = lo.umi and low where lo.umi is null""")
def umi_dedup(s, d):
    return B.dedup_umis(R.umi_counts(s, d)).select("barcode", "gene", "umi", "reads")


@query("mol", """
with i as (select distinct feature % 20 set_id, barcode item from mol), n as (select set_id, count(*) n from i group by 1)
select a.set_id a, b.set_id b, count(*) shared, round(count(*) / least(any_value(x.n), any_value(y.n)), 6) overlap from i a join i b on a.item = b.item and a.set_id < b.set_id join n x on x.set_id = a.set_id join n y on y.set_id = b.set_id group by all""".replace("group by all", "group by a.set_id, b.set_id"))
def overlap_coefficient(s, d):
    m = R.molecules(s, d).select((F.col("feature") % 20).alias("set_id"), F.col("barcode").alias("item"))
    return B.overlap_coefficients(m).withColumn("overlap", F.round("overlap", 6))


@query("mol", """
with c as (select library, barcode, sum(reads)::bigint n from mol group by all), r as (select *, sum(n) over (partition by library order by n desc) run, sum(n) over (partition by library) t from c),
k as (select library, max(n) cap from r where run >= 0.925 * t group by 1), v as (select library, barcode, least(n, cap)::double v from c join k using (library)), z as (select library, sqrt(sum(v * v)) z from v group by 1)
select a.library a, b.library b, round(sum(a.v * b.v) / (any_value(x.z) * any_value(y.z)), 6) cosine from v a join v b on a.barcode = b.barcode and a.library < b.library join z x on x.library = a.library join z y on y.library = b.library group by 1, 2""")
def robust_cosine(s, d):
    c = R.molecules(s, d).groupBy("library", "barcode").agg(F.sum("reads").alias("n"))
    return B.robust_cosine(c).withColumn("cosine", F.round("cosine", 6))


@query("", """
with n as (select o_orderpriority p, round(o_totalprice)::bigint v from orders), r as (select *, sum(v) over (partition by p order by v desc) run, sum(v) over (partition by p) t from n)
select p priority, max(v) filter (run >= 0.5 * t) n50, max(v) filter (run >= 0.9 * t) n90 from r group by 1""")
def n50_n90(s, d):
    o = R.table(s, d, "orders").select(F.col("o_orderpriority").alias("priority"), F.round("o_totalprice").cast("long").alias("v"))
    half, most = (B.nx(o, ["priority"], "v", f).withColumnRenamed("nx", n) for f, n in ((0.5, "n50"), (0.9, "n90")))
    return half.join(most, "priority")


@query("tg", "select feature, round(sum(n) ** 2 / sum(n * n), 6) diversity, sum(n)::bigint total from tg group by 1")
def diversity(s, d):
    return R.tags(s, d).groupBy("feature").agg(F.round(effective_diversity(F.col("n")), 6).alias("diversity"), F.sum("n").alias("total"))


@query("coo", """
with f as (select barcode, sum(umi_count) n, count(*) s, count(*) filter (umi_count = 1) f1, count(*) filter (umi_count = 2) f2 from coo group by 1)
select barcode, s species, round(s + case when f2 > 0 then f1 * f1 / (2.0 * f2) else f1 * (f1 - 1) / 2.0 end, 6) chao1 from f""")
def chao1(s, d):
    f = R.coo(s, d).groupBy("barcode").agg(F.count("*").alias("species"), F.count_if(F.col("umi_count") == 1).alias("f1"), F.count_if(F.col("umi_count") == 2).alias("f2"))
    extra = F.when(F.col("f2") > 0, F.col("f1") * F.col("f1") / (2.0 * F.col("f2"))).otherwise(F.col("f1") * (F.col("f1") - 1) / 2.0)
    return f.select("barcode", "species", F.round(F.col("species") + extra, 6).alias("chao1"))


@query("tg", """
with n as (select feature, n, sum(n) over (partition by feature) t from tg), d as (select * from n, unnest([5, 20]) u(m))
select feature, m depth, round(sum(1 - exp(lgamma(t - n + 1) + lgamma(t - m + 1) - lgamma(t + 1) - case when t - n - m >= 0 then lgamma(t - n - m + 1) else 1e308 end)), 5) expected from d group by 1, 2""")
def rarefaction(s, d):
    """Expected barcodes seen in m events, from frequencies alone."""
    @F.pandas_udf("double")
    def missed(n: pd.Series, t: pd.Series, m: pd.Series) -> pd.Series:
        n, t, m = (x.to_numpy(float) for x in (n, t, m))
        rest = t - n - m
        logs = log_gamma(t - n + 1) + log_gamma(t - m + 1) - log_gamma(t + 1) - log_gamma(np.maximum(rest, 0) + 1)
        return pd.Series(np.where(rest >= 0, np.exp(logs), 0.0))

    w = Window.partitionBy("feature")
    rows = R.tags(s, d).withColumn("t", F.sum("n").over(w)).withColumn("depth", F.explode(F.array(F.lit(5), F.lit(20))))
    return rows.groupBy("feature", "depth").agg(F.round(F.sum(1 - missed("n", "t", "depth")), 5).alias("expected"))


@query("mol", "select library, round(quantile_cont(reads, 0.25), 6) q25, round(quantile_cont(reads, 0.5), 6) q50, round(quantile_cont(reads, 0.99), 6) q99, max(reads) largest, round(avg(reads), 6) mean from mol group by 1")
def weighted_quantiles(s, d):
    """Quantiles of a histogram: values with their counts, never the rows."""
    h = R.molecules(s, d).groupBy("library", "reads").agg(F.count("*").alias("n"))
    q = lambda p: F.round(F.expr(f"percentile(reads, {p}, n)"), 6)
    return h.groupBy("library").agg(q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.99).alias("q99"), F.max("reads").alias("largest"), F.round(F.sum(F.col("reads") * F.col("n")) / F.sum("n"), 6).alias("mean"))


@query("mol", "select floor(reads / 10)::bigint * 10 low, count(*) n from mol where reads >= 10 and reads < 40 group by 1")
def histogram_bins(s, d):
    return R.molecules(s, d).where("reads >= 10 and reads < 40").groupBy((F.floor(F.col("reads") / 10) * 10).alias("low")).agg(F.count("*").alias("n"))


@query("mol", "select feature, sum(reads)::bigint total from mol group by 1 order by total desc, feature desc limit 25")
def top_features(s, d):
    return R.molecules(s, d).groupBy("feature").agg(F.sum("reads").alias("total")).orderBy(F.col("total").desc(), F.col("feature").desc()).limit(25)


@query("mol", "select barcode, round(1 - count(*) / sum(reads), 6) saturation, round(count(distinct feature) / count(*), 6) per_umi, round(avg((gem_group = 'F')::int), 6) frac_f from mol group by 1")
def saturation(s, d):
    return R.molecules(s, d).groupBy("barcode").agg(F.round(duplicate_fraction(F.count("*"), F.sum("reads")), 6).alias("saturation"), F.round(robust_divide(F.count_distinct("feature"), F.count("*")), 6).alias("per_umi"), F.round(F.avg((F.col("gem_group") == "F").cast("int")), 6).alias("frac_f"))


@query("", "select event_id, least((\"value\" % 60)::int, 33) q, round(10 ** (-least((\"value\" % 60)::int, 33) / 10.0), 9) p from events")
def phred_probability(s, d):
    q = F.least(F.bround(F.col("value") % 60).cast("int"), F.lit(33))
    return R.table(s, d, "events").select("event_id", q.alias("q"), F.round(error_probability(q), 9).alias("p"))


@query("obs", """select id, regexp_extract(seq, '^[ACGTN]([ACGTN]{3})A', 1) feature_seq from obs""")
def feature_extraction(s, d):
    return R.observed(s, d).select("id", F.regexp_extract("seq", S.pattern_regex("5PN(BC)A", 3), 1).alias("feature_seq"))


@query("tg", "select feature feature_type, barcode, case when sum(n) over w = 0 then 1 / count(*) over w else round(n / sum(n) over w, 9) end proportion from tg window w as (partition by feature)")
def feature_distribution(s, d):
    t = R.tags(s, d).select(F.col("feature").alias("feature_type"), F.col("barcode").alias("feature"), "n")
    return B.feature_distribution(t).select("feature_type", F.col("feature").alias("barcode"), F.round("proportion", 9).alias("proportion"))


@query("obs wl", """
with t as (select sum("count") + count(*) t from wl), p as (select seq, ("count" + 1) / t p from wl, t),
c as (select id, seq, seq t, 1.0::double w from obs union all select id, seq, substr(seq, 1, i - 1) || b || substr(seq, i + 1), 10 ** -2.0 from obs, unnest(range(1, 7)) x(i), unnest(['A', 'C', 'G', 'T']) q(b) where substr(seq, i, 1) <> b),
h as (select id, c.seq, t, w * p w from c join p on p.seq = t)
select id, seq, case when round(max(w) / sum(w), 9) >= 0.9 then arg_max(t, (w, t)) end corrected, round(max(w) / sum(w), 6) share from h group by id, seq""")
def feature_correction(s, d):
    w = R.whitelist(s, d)
    total = w.agg((F.sum("count") + F.count("*")).alias("t"))
    dist = w.crossJoin(F.broadcast(total)).select("seq", ((F.col("count") + 1) / F.col("t")).alias("proportion"))
    return B.correct_features(R.observed(s, d).select("id", "seq", F.lit(20).alias("q")), dist, 0.9).withColumn("share", F.round("share", 6))


@query("", """
with w as (select item_id, regexp_extract_all(text, '[a-zA-Z]{6,}') w from benchmark), k as (select distinct lower(substr(x, i, 6)) k from w, unnest(w.w) u(x), unnest(range(1, length(x) - 4)) v(i)),
d as (select doc_id, unnest(regexp_extract_all(text, '[a-zA-Z]{6,}')) x from documents), dk as (select distinct doc_id, lower(substr(x, i, 6)) k from d, unnest(range(1, length(x) - 4)) v(i))
select doc_id id, count(*) n_kmers from dk semi join k using (k) group by 1""")
def doc_kmer_match(s, d):
    words = lambda df, key: df.select(F.col(key).alias("id"), F.explode(F.regexp_extract_all("text", F.lit("[a-zA-Z]{6,}"), 0)).alias("seq")).withColumn("seq", F.lower("seq"))
    docs, known = words(R.table(s, d, "documents"), "doc_id"), words(R.table(s, d, "benchmark"), "item_id")
    mine = docs.select("id", F.explode(F.array_distinct(S.kmers(F.col("seq"), 6))).alias("kmer")).distinct()
    have = known.select(F.explode(S.kmers(F.col("seq"), 6)).alias("kmer")).distinct()
    return mine.join(have, "kmer", "left_semi").groupBy("id").agg(F.count("*").alias("n_kmers"))


@query("obs", """with p as (select id, seq, strpos(seq, 'TGC') a, case when ends_with(seq, 'TG') then 2 when ends_with(seq, 'T') then 1 else 0 end o from obs)
select id, case when a > 0 then substr(seq, 1, a - 1) else substr(seq, 1, length(seq) - case when o >= 2 then o else 0 end) end trimmed from p""")
def adapter_trim(s, d):
    return R.observed(s, d).select("id", B.trim_adapter(F.col("seq"), "TGC", 2).alias("trimmed"))


@query("", """with e as (select user_id, event_type, "value", (props ->> 'k')::int k from events)
select event_type, count(*) n, round(sum("value"), 2) total, max(k) largest, count(*) filter (k > 50) high, round(100.0 * count(*) filter (k > 50) / count(*), 6) pct_high,
  case when 100.0 * count(*) filter (k > 50) / count(*) > 50 then 'ERROR' when 100.0 * count(*) filter (k > 50) / count(*) > 40 then 'WARN' end alert from e group by 1""")
def metric_etl(s, d):
    """Metrics out of JSON by a table of conditions, with alerts by threshold."""
    e = R.table(s, d, "events").withColumn("k", F.from_json("props", "k int")["k"])
    conditions = {"high": F.col("k") > 50}
    agg = e.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.max("k").alias("largest"), *(F.count_if(c).alias(n) for n, c in conditions.items()))
    pct = 100.0 * F.col("high") / F.col("n")
    return agg.withColumn("pct_high", F.round(pct, 6)).withColumn("alert", F.when(pct > 50, "ERROR").when(pct > 40, "WARN"))


@query("", "select user_id, string_agg(event_type || '_count=' || c, ';' order by event_type) metrics from (select user_id, event_type, count(*) c from events group by all) group by 1")
def metric_map(s, d):
    """Prefix and merge of metric maps."""
    c = R.table(s, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("c"))
    m = c.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "c"))).alias("m"))
    named = F.map_entries(F.transform_keys("m", lambda k, _: F.concat_ws("_", k, F.lit("count"))))
    return m.select("user_id", F.array_join(F.transform(F.array_sort(named), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";").alias("metrics"))
