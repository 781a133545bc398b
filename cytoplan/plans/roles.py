"""The analysis tables posed on the star schema, for DataFrames and, as common table expressions, for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.seq import dna


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("barcode"), F.col("l_partkey").alias("feature"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("umi"),
        F.col("l_quantity").cast("int").alias("reads"), F.col("l_returnflag").alias("library"), F.col("l_linestatus").alias("gem_group"),
    )


def coo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecule rows of each barcode and feature."""
    return molecules(spark, sf_dir).groupBy("barcode", "feature").agg(F.count("*").alias("umi_count"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    genome = F.when(F.col("p_partkey") % 2 == 0, "g0").otherwise("g1")
    return p.select(F.col("p_partkey").alias("feature"), F.col("p_name").alias("name"), F.col("p_type").alias("feature_type"), F.col("p_brand").alias("target_set"), genome.alias("genome"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("barcode"))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UMIs of the larger barcode axis: customers by the lines of their orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("barcode"))
    return table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("barcode").agg(F.sum(F.col("l_quantity").cast("int")).alias("total"))


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short sequences, so that many are neighbours, with counts."""
    s = table(spark, sf_dir, "supplier").select(dna(F.col("s_suppkey"), 6).alias("seq"), F.col("s_suppkey").alias("k"))
    return s.groupBy("seq").agg(F.sum(F.col("k") % 50).cast("long").alias("count"))


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of the whitelist with one base replaced, now and then by N."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    base = F.when(F.col("o_orderkey") % 5 == 0, "N").otherwise(F.substring(F.lit("ACGT"), (F.col("o_orderkey") % 4 + 1).cast("int"), F.lit(1)))
    seq = F.overlay(dna(F.col("o_orderkey") % 97 + 1, 6), base, (F.col("o_orderkey") % 6 + 1).cast("int"), F.lit(1))
    quals = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: (5 + (F.col("o_orderkey") + i * 7) % 28).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), seq.alias("seq"), quals.alias("quals"))


def umi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("barcode"), (F.col("l_partkey") % 3).alias("gene"), dna(F.col("l_orderkey") % 400, 5).alias("umi")).agg(F.count("*").alias("reads"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("barcode"), F.col("event_type").alias("feature")).agg(F.count("*").alias("n"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").alias("cluster"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").alias("barcode"), F.col("turn").alias("contig"), F.col("role").alias("chain"), (F.length("text") % 5).cast("long").alias("cdr3"),
        F.length("text").cast("long").alias("umis"), (F.length("text") % 3 != 0).alias("productive"), F.col("text").alias("sequence"),
    )


def _dna(k: str, n: int) -> str:
    return f"translate(substr(md5(({k})::varchar), 1, {n}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


CTE = {
    "mol": "select l_suppkey barcode, l_partkey feature, l_orderkey * 8 + l_linenumber umi, l_quantity::int reads, l_returnflag library, l_linestatus gem_group from lineitem",
    "coo": "select barcode, feature, count(*) umi_count from mol group by all",
    "feat": "select p_partkey feature, p_name name, p_type feature_type, p_brand target_set, case when p_partkey % 2 = 0 then 'g0' else 'g1' end genome from part",
    "cell": "select s_suppkey barcode from supplier where s_acctbal > 0",
    "tot": "select o_custkey barcode, sum(l_quantity::int)::bigint total from lineitem join orders on l_orderkey = o_orderkey group by 1",
    "bt": "select barcode, sum(umi_count)::bigint total from coo group by 1",
    "wl": f"select {_dna('s_suppkey', 6)} seq, sum(s_suppkey % 50)::bigint \"count\" from supplier group by 1",
    "obs0": f"select o_orderkey id, {_dna('o_orderkey % 97 + 1', 6)} s, (o_orderkey % 6)::int p, case when o_orderkey % 5 = 0 then 'N' else substr('ACGT', (o_orderkey % 4 + 1)::int, 1) end b from orders",
    "obs": "select id, substr(s, 1, p) || b || substr(s, p + 2) seq from obs0",
    "uc": f"select l_suppkey barcode, l_partkey % 3 gene, {_dna('l_orderkey % 400', 5)} umi, count(*) reads from lineitem group by all",
    "tg": "select user_id barcode, event_type feature, count(*) n from events group by all",
    "pt": "select vec_id id, embedding vec, label cluster from embeddings",
    "ctg": "select conv_id barcode, turn contig, role chain, (length(text) % 5)::bigint cdr3, length(text)::bigint umis, length(text) % 3 <> 0 productive, text sequence from conversations",
}
NEEDS = {"coo": ["mol"], "bt": ["coo"], "obs": ["obs0"]}


def sql(roles: str, body: str) -> str:
    """A query over role tables: their definitions, then the body, which may start with more of its own."""
    names: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in names:
            names.append(name)

    for r in roles.split():
        add(r)
    own = body.strip()
    parts = ", ".join(f"{n} as ({CTE[n]})" for n in names)
    if own.startswith("with "):
        return f"with recursive {parts}, {own[5:]}" if parts else f"with recursive {own[5:]}"
    return f"with {parts} {own}" if parts else own
