"""Immune receptors at the level of contig tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ratio
from .graph import components


def exact_clonotypes(contigs: DataFrame, key: list[str]) -> DataFrame:
    """barcode, clonotype_id: cells with the same sorted list of contig keys; ids by (list length, list)."""
    lists = contigs.groupBy("barcode").agg(F.sort_array(F.collect_list(F.struct(*key))).alias("chains"))
    groups = lists.groupBy("chains").agg(F.count("*").alias("n_cells"))
    ids = groups.withColumn("clonotype_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.size("chains"), "chains")))
    return lists.join(ids, "chains").select("barcode", "clonotype_id", F.size("chains").alias("n_chains"), "n_cells")


def clonotype_table(cells: DataFrame) -> DataFrame:
    """Frequency and share of each clonotype."""
    n = cells.groupBy("clonotype_id").agg(F.count("*").alias("frequency"))
    return n.withColumn("proportion", ratio(F.col("frequency"), F.sum("frequency").over(Window.partitionBy(F.lit(0)))))


def whitelist_contamination(cells: DataFrame, least_ratio: int = 10, least_share: float = 0.2) -> DataFrame:
    """cells(barcode, clonotype, half1, half2, umis): within a clonotype, cells that share half a barcode with one of
    at least `least_ratio` times their UMIs, if such cells are enough of the clonotype."""
    w1, w2, wc = (Window.partitionBy("clonotype", c) for c in ("half1", "half2", "clonotype"))
    suspect = cells.withColumn("s1", F.max("umis").over(w1)).withColumn("s2", F.max("umis").over(w2)).withColumn("bad", (F.col("s1") >= least_ratio * F.col("umis")) | (F.col("s2") >= least_ratio * F.col("umis")))
    share = ratio(F.count_if("bad").over(wc), F.count("*").over(wc))
    return suspect.withColumn("contaminant", F.col("bad") & (share >= least_share)).drop("s1", "s2", "bad")


def clonotype_concordance(cells: DataFrame, label: str) -> DataFrame:
    """Largest share of one assignment inside each clonotype."""
    n = cells.groupBy("clonotype_id", label).agg(F.count("*").alias("n"))
    return n.groupBy("clonotype_id").agg(F.sum("n").alias("cells"), F.max("n").alias("most")).select("clonotype_id", "cells", ratio(F.col("most"), F.col("cells")).alias("concordance"))


def join_blocked(rows: DataFrame, block: list[str], condition: Column, key: str = "id") -> DataFrame:
    """Pairs a < b that share a block and meet a condition over columns of x and y."""
    x, y = rows.alias("x"), rows.alias("y")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in block]
    for c in (F.col(f"x.{key}") < F.col(f"y.{key}"), condition):
        same.append(c)
    on = same[0]
    for c in same[1:]:
        on = on & c
    return x.join(y, on).select(F.col(f"x.{key}").alias("a"), F.col(f"y.{key}").alias("b"))


def clonotype_components(rows: DataFrame, block: list[str], condition: Column, key: str = "id") -> DataFrame:
    """node, comp of joined exact subclonotypes."""
    return components(join_blocked(rows, block, condition, key))


def merge_single_chains(singles: DataFrame, full: DataFrame, key: str) -> DataFrame:
    """Single-chain cells go to the only clonotype with their chain; with several they stay alone."""
    one = full.select(key, "clonotype_id").distinct().groupBy(key).agg(F.count("*").alias("n"), F.min("clonotype_id").alias("clonotype_id")).where("n = 1").drop("n")
    return singles.join(one, key, "left")


def weak_chains(chains: DataFrame, least_cells: int = 20, ratio_to: int = 10) -> DataFrame:
    """chains(clonotype, chain, cells): chains in few cells of a large clonotype."""
    most = F.max("cells").over(Window.partitionBy("clonotype"))
    return chains.withColumn("weak", (most >= least_cells) & (F.col("cells") * ratio_to <= most))


def contig_metrics(contigs: DataFrame) -> DataFrame:
    """Per barcode: contigs, UMIs, distinct chains, and whether a pair of both chains is productive."""
    return contigs.groupBy("barcode").agg(
        F.count("*").alias("n_contigs"), F.sum("umis").alias("umis"), F.count_distinct("chain").alias("n_chains"), F.count_if("productive").alias("n_productive"),
        (F.count_distinct(F.when(F.col("productive"), F.col("chain"))) >= 2).alias("paired"),
    )


def confident_contigs(contigs: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """The first rule that a contig breaks names why it is not confident; null if none does."""
    reason = F.coalesce(*(F.when(c, F.lit(name)) for name, c in rules))
    return contigs.withColumn("reason", reason)


def umi_filter_baseline(cells: DataFrame, least: int = 20) -> DataFrame:
    """Per dataset: min(n10, n50 - 4 sqrt(n50)) of the UMIs of single-cell clonotypes, if there are enough."""
    q = cells.groupBy("dataset").agg(F.count("*").alias("n"), F.percentile("umis", 0.1).alias("n10"), F.percentile("umis", 0.5).alias("n50")).where(F.col("n") >= least)
    return q.select("dataset", "n", F.least(F.col("n10"), F.col("n50") - 4.0 * F.sqrt("n50")).alias("umin"))


def airr(contigs: DataFrame) -> DataFrame:
    """The columns of an AIRR rearrangement table."""
    return contigs.select(F.col("barcode").cast("string").alias("cell_id"), F.concat_ws("_contig_", "barcode", "contig").alias("sequence_id"), F.col("sequence"), F.when(F.col("productive"), "T").otherwise("F").alias("productive"), F.col("chain").alias("locus"), F.col("umis").alias("duplicate_count"))


#: Least surviving UMIs of a cell, least UMIs of a B cell, least share of the typical reads a UMI (fixed values).
SURVIVING_UMIS, B_CELL_UMIS, READS_SHARE = 3, 10, 0.03
#: Leakage: barcodes of a junction, its median UMIs, and how far the dominant one is ahead (fixed values).
JUNCTION_CLUSTER, JUNCTION_MEDIAN, JUNCTION_RATIO = 10, 1, 40


def cell_reasons(barcodes: DataFrame) -> DataFrame:
    """barcodes(barcode, receptor, surviving, umis, n_good, n_reject, has_v, junction_support, n_confident, max_reads, typical_reads):
    barcode, reasons (why it is no cell, in order), is_cell."""
    c = F.col
    rules = [
        ("not_enough_umis_tcr", (c("receptor") == "TR") & (c("surviving") < SURVIVING_UMIS)),
        ("not_enough_umis_bcr", (c("receptor") == "IG") & ((c("surviving") < SURVIVING_UMIS) | (c("umis") < B_CELL_UMIS))),
        ("no_contig_with_v_region", (c("n_good") + c("n_reject") == 0) | ~c("has_v")),
        ("not_enough_junction_support", (c("n_good") == 1) & (c("junction_support") <= 1)),
        ("no_confident_contig", c("n_confident") == 0),
        ("not_enough_reads_per_umi", c("max_reads") < READS_SHARE * c("typical_reads")),
    ]
    reasons = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules)))
    return barcodes.select("barcode", reasons.alias("reasons"), (F.size(reasons) == 0).alias("is_cell"))


def leaked_junctions(contigs: DataFrame) -> DataFrame:
    """contigs(barcode, contig, junction, umis) whose junction another barcode's dominates: large clusters of few UMIs."""
    stats = contigs.groupBy("junction").agg(F.count("*").alias("n"), F.max("umis").alias("dominant"), F.sort_array(F.collect_list("umis")).alias("u"))
    stats = stats.where(F.col("n") >= JUNCTION_CLUSTER).withColumn("middle", F.get("u", F.floor(F.col("n") / 2).cast("int"))).where(F.col("middle") <= JUNCTION_MEDIAN)
    found = contigs.join(stats.select("junction", "dominant"), "junction")
    return found.where(F.col("dominant") >= JUNCTION_RATIO * F.greatest(F.lit(1), F.col("umis"))).select("barcode", "contig", "junction", "umis", "dominant")


def keyed_clonotypes(contigs: DataFrame, key: list[str]) -> DataFrame:
    """barcode, clonotype_id over productive contigs of cells: equal sorted lists of all key fields; ids by frequency, then list."""
    lists = contigs.where("is_cell and productive").groupBy("barcode").agg(F.sort_array(F.collect_list(F.struct(*key))).alias("chains"))
    groups = lists.groupBy("chains").agg(F.count("*").alias("frequency"))
    ids = groups.withColumn("clonotype_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("frequency").desc(), F.size("chains"), "chains")))
    return lists.join(ids, "chains").select("barcode", "clonotype_id", "frequency", F.size("chains").alias("n_chains"))


def umi_filter(cells: DataFrame, baseline: DataFrame) -> DataFrame:
    """cells(clonotype, exact, barcode, dataset, umis, chains) less those below their dataset's least UMIs.

    If all cells of a clonotype would go, the best cell of its best exact subclonotype stays, provided it has two chains."""
    low = cells.join(F.broadcast(baseline.select("dataset", "umin")), "dataset", "left").withColumn("bad", F.coalesce(F.col("umis") < F.col("umin"), F.lit(False)))
    all_bad = F.min("bad").over(Window.partitionBy("clonotype"))
    total = F.sum("umis").over(Window.partitionBy("clonotype", "exact"))
    marked = low.withColumn("all_bad", all_bad).withColumn("total", total)
    best = F.max(F.struct("total", F.negative("exact").alias("e"), "umis", F.negative("barcode").alias("b"))).over(Window.partitionBy("clonotype"))
    guarded = F.col("all_bad") & (F.col("chains") >= 2) & (best["b"] == -F.col("barcode")) & (best["e"] == -F.col("exact"))
    return marked.withColumn("guarded", guarded).where(~F.col("bad") | F.col("guarded")).select("clonotype", "exact", "barcode", "umis", "guarded")


def indel_contaminants(contigs: DataFrame, ratio_to: int = 10) -> DataFrame:
    """contigs(barcode, sequence, umis): barcodes whose contig another barcode, one deletion away, has with `ratio_to` times the UMIs.

    Two barcodes are one insertion or deletion apart, up to the base that the read frame shifts in, if they share a deletion variant."""
    n = F.length("barcode")
    cut = F.explode(F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substr("barcode", F.lit(1), i - 1), F.substr("barcode", i + 1))))
    variants = contigs.select("barcode", "sequence", "umis", cut.alias("variant")).distinct()
    best = variants.groupBy("sequence", "variant").agg(F.max("umis").alias("most"), F.count_distinct("barcode").alias("n")).where("n > 1")
    near = variants.join(best, ["sequence", "variant"]).where(F.col("most") >= ratio_to * F.col("umis"))
    return near.select("barcode", "sequence", "umis").distinct()
