"""Queries: formats written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counting as C
from ..sources import formats as S
from ..sources.stage import stage_path
from . import roles as R
from .registry import query


@query("mol", "select * from mol where gem_group = 'F' and reads > 40")
def parquet_round_trip(s, d):
    path = stage_path(s)
    S.write_parquet(R.molecules(s, d), path, ["gem_group", "reads"])
    return s.read.parquet(path).where("gem_group = 'F' and reads > 40")


@query("coo", "select * from coo")
def mex_round_trip(s, d):
    coo, f = R.coo(s, d), R.features(s, d)
    path = stage_path(s)
    index = C.dense_index(f, "feature")
    S.write_mex(coo, C.dense_index(coo, "barcode"), f.join(index, "feature"), path)
    return S.read_mex(s, path)


@query("", "select s_suppkey id, s_name \"name\", s_nationkey nation from supplier")
def csv_round_trip(s, d):
    path = stage_path(s)
    sup = R.table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    S.concat_csv([sup.where("id % 2 = 0"), sup.where("id % 2 = 1")], path)
    return S.read_csv_checked(s, path, "id long, name string, nation int", ["id", "name"])


@query("", "select 'chr' || p_size seqname, 'exon' feature, p_partkey \"start\", p_partkey + p_size \"end\", 'G' || p_partkey gene_id, p_brand gene_name from part")
def gtf_scan(s, d):
    p = R.table(s, d, "part")
    path = stage_path(s)
    attrs = F.concat(F.lit('gene_id "G'), "p_partkey", F.lit('"; gene_name "'), "p_brand", F.lit('";'))
    line = F.concat_ws("\t", F.concat(F.lit("chr"), "p_size"), F.lit("made"), F.lit("exon"), "p_partkey", F.col("p_partkey") + F.col("p_size"), F.lit("."), F.lit("+"), F.lit("."), attrs)
    p.select(line).unionAll(s.range(1).select(F.lit("#!comment"))).write.text(path)
    g = S.parse_gtf(s.read.text(path))
    return g.select("seqname", "feature", "start", "end", F.col("properties")["gene_id"].alias("gene_id"), F.col("properties")["gene_name"].alias("gene_name"))


@query("wl", "select 'seq|' || \"count\" header, seq \"sequence\", count(*) n from wl group by all".replace("group by all", "group by 1, 2"))
def fasta_scan(s, d):
    path = stage_path(s)
    R.whitelist(s, d).select(F.concat(F.lit(">seq|"), "count", F.lit("\n"), F.substring("seq", 1, 3), F.lit("\n"), F.substring("seq", 4, 3))).write.text(path)
    return S.parse_fasta(s.read.option("lineSep", ">").text(path)).groupBy("header", "sequence").agg(F.count("*").alias("n"))


@query("", "select 'c' || s_nationkey chrom, s_suppkey pos, substr('ACGT', (s_suppkey % 4)::int + 1, 1) ref, 'G' alt from supplier")
def vcf_scan(s, d):
    path = stage_path(s)
    sup = R.table(s, d, "supplier")
    ref = F.substring(F.lit("ACGT"), (F.col("s_suppkey") % 4 + 1).cast("int"), F.lit(1))
    sup.select(F.concat_ws("\t", F.concat(F.lit("c"), "s_nationkey"), "s_suppkey", F.lit("."), ref, F.lit("G,AT"), F.lit("."))).write.text(path)
    return S.parse_vcf(s.read.text(path))


@query("", """select concat_ws(chr(9), 'c' || s_nationkey, s_suppkey, s_suppkey + 30, s_name, 0, '+', s_suppkey, s_suppkey + 30, 0, 2, '10,5', '0,25') line from supplier""")
def bed12_lines(s, d):
    k = F.col("s_suppkey")
    exon = lambda a, b: F.struct((k + a).alias("start"), (k + b).alias("end"))
    tx = R.table(s, d, "supplier").select(F.concat(F.lit("c"), "s_nationkey").alias("chrom"), F.col("s_name").alias("name"), F.lit("+").alias("strand"), F.array(exon(0, 10), exon(25, 30)).alias("exons"))
    return S.bed12(tx)


@query("", "select event_id, (props ->> 'k')::bigint k from events")
def json_scan(s, d):
    path = stage_path(s)
    e = R.table(s, d, "events")
    e.select(F.to_json(F.struct("event_id", F.from_json("props", "k bigint").alias("p")))).write.text(path)
    return s.read.schema("event_id long, p struct<k: long>").json(path).select("event_id", F.col("p.k").alias("k"))
