"""Steps between the large operators: checks of inputs, routing, annotation and summaries of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ratio
from .graph import components

#: Receptor detection: least share of mapped reads, and how far one class must be ahead (fixed values).
RECEPTOR_SHARE, RECEPTOR_MARGIN = 0.05, 3.0
#: Chain signatures: cells of overlapping pairs that outweigh a signature (fixed value).
SIGNATURE_RATIO = 20


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Tables by column name; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def dimensions(coo: DataFrame) -> DataFrame:
    """Entries, features, barcodes and UMIs of a matrix."""
    return coo.agg(F.count("*").alias("entries"), F.count_distinct("feature").alias("features"), F.count_distinct("barcode").alias("barcodes"), F.coalesce(F.sum("umi_count"), F.lit(0)).alias("umis"))


def target_features(features: DataFrame, targets: DataFrame) -> DataFrame:
    """targets(name, included): features by name, with the state of names that are off the reference or listed twice."""
    listed = targets.groupBy("name").agg(F.count("*").alias("n"), F.bool_or("included").alias("included"))
    state = F.when(F.col("feature").isNull(), "unknown").when(F.col("n") > 1, "repeated").when(F.col("included"), "target").otherwise("excluded")
    return listed.join(features.select("name", "feature"), "name", "left").select("name", "feature", state.alias("state"))


def checked_inputs(rows: DataFrame, id_col: str, path_col: str, suffix: str) -> DataFrame:
    """Rows of an input list with what is wrong with each, first fault first; null if nothing is."""
    blank = F.coalesce(F.trim(F.col(id_col).cast("string")), F.lit("")) == ""
    n = F.count("*").over(Window.partitionBy(id_col))
    fault = F.when(blank, "no id").when(F.col(id_col).cast("string").rlike("[^A-Za-z0-9_-]"), "bad id").when(n > 1, "repeated id").when(~F.coalesce(F.col(path_col).endswith(suffix), F.lit(False)), "bad path")
    return rows.withColumn("fault", fault)


def typed_parameters(lines: DataFrame, known: dict[str, tuple[str, float, float]]) -> DataFrame:
    """lines(line) of ``name,value``: name, value, number, fault. known: name -> (int or float, least, most)."""
    name, raw = F.trim(F.split_part("line", F.lit(","), F.lit(1))), F.trim(F.split_part("line", F.lit(","), F.lit(2)))
    spec = lines.sparkSession.createDataFrame([(k, t, float(a), float(b)) for k, (t, a, b) in known.items()], "name string, kind string, least double, most double")
    parsed = lines.select(name.alias("name"), raw.alias("value")).join(F.broadcast(spec), "name", "left")
    number = F.expr("try_cast(value as double)")
    fault = F.when(F.col("kind").isNull(), "unknown").when(number.isNull(), "not a number").when((F.col("kind") == "int") & (number != F.floor(number)), "not whole").when((number < F.col("least")) | (number > F.col("most")), "out of range")
    return parsed.select("name", "value", F.when(fault.isNull(), number).alias("number"), fault.alias("fault"))


def upgraded(mol: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """A table of an older layout with the columns that newer ones have."""
    return mol.withColumns({k: v for k, v in defaults.items() if k not in mol.columns})


def renumbered_groups(samples: DataFrame) -> DataFrame:
    """samples(sample, gem_group): dense new gem groups by (sample, old group), one row each. One row a group: a dimension."""
    ids = samples.select("sample", "gem_group").distinct()
    return ids.withColumn("new_group", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("sample", "gem_group")).cast("long"))


def top_overlap(a: DataFrame, b: DataFrame, top: int) -> DataFrame:
    """a, b (barcode, n): shared barcodes among the `top` largest of each, and their share of the smaller list."""
    cut = lambda x: x.orderBy(F.col("n").desc(), "barcode").limit(top).select("barcode")
    x, y = cut(a).withColumn("in_a", F.lit(1)), cut(b).withColumn("in_b", F.lit(1))
    n = x.join(y, "barcode", "full").agg(F.count("in_a").alias("n_a"), F.count("in_b").alias("n_b"), F.count(F.col("in_a") + F.col("in_b")).alias("shared"))
    return n.withColumn("overlap", ratio(F.col("shared"), F.least("n_a", "n_b")))


def detect_chemistry(reads: DataFrame, candidates: list[tuple[str, int, int]], whitelist: DataFrame, least_reads: int, least_share: float, margin: float) -> DataFrame:
    """candidates (name, offset, length): share of reads whose barcode at that place is listed; the only clear winner is chosen.

    Reads that are too short for a candidate count as misses."""
    one = lambda name, at, n: F.struct(F.lit(name).alias("name"), F.when(F.length("seq") >= at + n, F.substring("seq", at + 1, n)).alias("barcode"))
    tried = reads.select(F.inline(F.array(*(one(*c) for c in candidates))))
    hit = tried.join(whitelist.select(F.col("seq").alias("barcode"), F.lit(1).alias("hit")).distinct(), "barcode", "left")
    rates = hit.groupBy("name").agg(F.count("*").alias("n_reads"), F.count("hit").alias("n_hits")).withColumn("share", ratio(F.col("n_hits"), F.col("n_reads")))
    by = Window.partitionBy(F.lit(0)).orderBy(F.col("n_hits").desc(), "name")  # one row a candidate
    ranked = rates.withColumn("r", F.row_number().over(by)).withColumn("next", F.coalesce(F.lead("share").over(by), F.lit(0.0)))
    won = (F.col("r") == 1) & (F.col("n_reads") >= least_reads) & (F.col("share") >= least_share) & (F.col("share") >= margin * F.col("next"))
    return ranked.withColumn("chosen", won).select("name", "n_reads", "n_hits", "share", "chosen")


def detect_receptor(reads: DataFrame, reference: DataFrame, k: int, by: str) -> DataFrame:
    """reads(id, by, seq), reference(class TR or IG, seq): reads that hold a k-mer of a class alone, and the class of each group."""
    kmers = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - k + 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(k)))
    words = lambda df, *keep: df.where(F.length("seq") >= k).select(*keep, F.explode(F.array_distinct(kmers("seq"))).alias("kmer"))
    ref = words(reference, "class").groupBy("kmer").agg(F.min("class").alias("class"), F.count_distinct("class").alias("n")).where("n = 1").drop("n")
    hits = words(reads, "id").join(ref, "kmer").groupBy("id").agg(F.min("class").alias("class"), F.count_distinct("class").alias("n")).where("n = 1").drop("n")
    n = reads.join(hits, "id", "left").groupBy(by).agg(F.count("*").alias("n_reads"), F.count_if(F.col("class") == "TR").alias("tr_reads"), F.count_if(F.col("class") == "IG").alias("ig_reads"))
    tr, ig = ratio(F.col("tr_reads"), F.col("n_reads")), ratio(F.col("ig_reads"), F.col("n_reads"))
    kind = F.when((tr < RECEPTOR_SHARE) & (ig < RECEPTOR_SHARE), "none").when(tr > RECEPTOR_MARGIN * ig, "TR").when(ig > RECEPTOR_MARGIN * tr, "IG").otherwise("unclear")
    return n.withColumn("receptor", kind)


def rescued_alignments(records: DataFrame) -> DataFrame:
    """records(read, place, unique, genes): of a read with no unique hit and one gene over all its records, the first
    record with one gene is promoted; the read's others are demoted. Others keep their state."""
    w = Window.partitionBy("read")
    all_genes = F.size(F.array_distinct(F.flatten(F.collect_list("genes").over(w))))
    first = F.min(F.when(F.size("genes") == 1, F.col("place"))).over(w)
    rescue = ~F.bool_or("unique").over(w) & (all_genes == 1) & first.isNotNull()
    state = F.when(F.col("unique"), "unique").when(~F.col("ok"), "kept").when(F.col("place") == F.col("first"), "promoted").otherwise("demoted")
    return records.withColumns({"ok": rescue, "first": first}).select("read", "place", state.alias("state"))


def probe_pairs(halves: DataFrame, probes: DataFrame) -> DataFrame:
    """halves(read, side, probe), probes(probe, gene): a read is confident if both sides have one and the same gene."""
    hit = halves.join(F.broadcast(probes), "probe", "left").groupBy("read").agg(
        F.max(F.when(F.col("side") == "left", F.col("gene"))).alias("left_gene"), F.max(F.when(F.col("side") == "right", F.col("gene"))).alias("right_gene")
    )
    state = F.when(F.col("left_gene").isNull() & F.col("right_gene").isNull(), "unmapped").when(F.col("left_gene").isNull() | F.col("right_gene").isNull(), "half")
    return hit.withColumn("state", state.when(F.col("left_gene") == F.col("right_gene"), "confident").otherwise("split"))


def exact_subclonotypes(contigs: DataFrame, key: list[str]) -> DataFrame:
    """contigs(barcode, *key): cells with equal sets of chains, as one row a subclonotype: chains, n_cells, least barcode."""
    sets = contigs.groupBy("barcode").agg(F.array_sort(F.collect_set(F.concat_ws("|", *key))).alias("chains"))
    return sets.groupBy("chains").agg(F.count("*").alias("n_cells"), F.min("barcode").alias("first_barcode")).withColumn("n_chains", F.size("chains"))


def signature_filter(subclonotypes: DataFrame) -> DataFrame:
    """subclonotypes(clonotype, exact, chain, cells), a row a chain: exact subclonotypes whose set of two or more chains is
    outweighed by the cells of pairs of chains that share one with it."""
    one = subclonotypes.groupBy("clonotype", "exact").agg(F.array_sort(F.collect_set("chain")).alias("sig"), F.max("cells").alias("cells")).where("size(sig) >= 2")
    freq = one.groupBy("clonotype", "sig").agg(F.sum("cells").alias("n"))
    pairs = freq.where("size(sig) = 2").select("clonotype", F.col("sig").alias("pair"), F.col("n").alias("n2"))
    by_chain = freq.select("clonotype", "sig", "n", F.explode("sig").alias("chain"))
    met = by_chain.join(pairs.select("clonotype", "pair", "n2", F.explode("pair").alias("chain")), ["clonotype", "chain"]).where("sig != pair")
    rival = met.select("clonotype", "sig", "n", "pair", "n2").distinct().groupBy("clonotype", "sig", "n").agg(F.sum("n2").alias("rival"))
    bad = rival.where(F.col("rival") > SIGNATURE_RATIO * F.col("n")).select("clonotype", "sig")
    return one.join(bad, ["clonotype", "sig"], "left_semi").select("clonotype", "exact", "cells")


def split_singles(exacts: DataFrame) -> DataFrame:
    """exacts(exact, barcode, chains, joined): one-chain subclonotypes of several cells, under 0.1% of all cells and joined
    with nothing, fall apart into single cells. barcode, exact, part (the barcode where it fell apart)."""
    n, total = F.count("*").over(Window.partitionBy("exact")), exacts.agg(F.count("*").alias("total"))
    apart = (F.col("chains") == 1) & (n > 1) & (n * 1000 < F.col("total")) & ~F.col("joined")
    return exacts.crossJoin(F.broadcast(total)).withColumn("part", F.when(apart, F.col("barcode"))).select("barcode", "exact", "part")


def split_clonotypes(members: DataFrame, links: DataFrame) -> DataFrame:
    """members(clonotype, node), links(a, b): parts of a clonotype that no link within it holds together; part is the least node."""
    at = members.select(F.col("node").alias("a"), F.col("clonotype").alias("ca"))
    inside = links.join(at, "a").join(at.withColumnsRenamed({"a": "b", "ca": "cb"}), "b").where("ca = cb").select("a", "b")
    parts = components(inside).select("node", F.col("comp").alias("part"))
    return members.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))


def reason_table(cells: DataFrame) -> DataFrame:
    """cells(barcode, reasons): barcodes with each reason, and with no other one."""
    each = cells.select(F.explode("reasons").alias("reason"), (F.size("reasons") == 1).alias("alone"))
    return each.groupBy("reason").agg(F.count("*").alias("barcodes"), F.count_if("alone").alias("only_this"))


def type_summary(cells: DataFrame, top: int) -> DataFrame:
    """cells(cluster, coarse, fine): the most frequent fine types of each cluster, with the share of their coarse type."""
    n = cells.groupBy("cluster", "coarse", "fine").agg(F.count("*").alias("n"))
    whole, coarse = Window.partitionBy("cluster"), Window.partitionBy("cluster", "coarse")
    out = n.withColumn("share", ratio(F.col("n"), F.sum("n").over(whole))).withColumn("coarse_share", ratio(F.sum("n").over(coarse), F.sum("n").over(whole)))
    return out.withColumn("rank", F.row_number().over(whole.orderBy(F.col("n").desc(), "coarse", "fine")).cast("long")).where(F.col("rank") <= top)


def label_index(cells: DataFrame, label: str) -> DataFrame:
    """Dense one-based numbers of labels, largest first. One row a label."""
    n = cells.groupBy(label).agg(F.count("*").alias("n"))
    return n.withColumn("number", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), label)).cast("long"))


def group_draw(rows: DataFrame, by: str, key: str, most: int, seed: int) -> DataFrame:
    """At most `most` rows of each group, drawn by the digests of their keys: the same rows for any partitions and retries."""
    at = F.md5(F.concat_ws(":", F.col(key), F.lit(seed)))
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(by).orderBy(at, key)).cast("long")).where(F.col("nth") <= most)


def valid_umis(reads: DataFrame, least_quality: int) -> DataFrame:
    """reads(id, seq, quals): whether a UMI has no N, more than one kind of base, and no base below a quality."""
    return reads.withColumn("valid", ~F.col("seq").contains("N") & ~F.col("seq").rlike(r"^(.)\1*$") & (F.array_min("quals") >= least_quality))


def extreme_keys(counts: DataFrame, by: str, key: str, value: str) -> DataFrame:
    """Keys of the largest and the smallest value of each group; the smallest key of equal ones."""
    low = F.min(F.struct(value, key))[key].alias("min_key")
    return counts.groupBy(by).agg(F.max(F.struct(F.col(value), F.negative(key).alias("k")))["k"].alias("k"), low).select(by, (-F.col("k")).alias("max_key"), "min_key")
