"""Barcodes and UMIs: whitelists, correction, deduplication, overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S
from ..functions.stats import error_probability, ratio


def whitelist_match(seqs: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Exact hits, else the first ACGT replacement of a single N that hits; canonical sequence or null."""
    n = F.length("seq") - F.length(F.replace("seq", F.lit("N"), F.lit("")))
    cand = F.when(n == 0, F.array("seq")).when(n == 1, S.n_candidates(F.col("seq")))
    tried = seqs.select("seq").distinct().select("seq", F.posexplode(cand).alias("order", "try"))
    hits = tried.join(whitelist.select(F.col("seq").alias("try"), "canonical"), "try").groupBy("seq").agg(F.min_by("canonical", "order").alias("match"))
    return seqs.join(hits, "seq", "left")


def barcode_posterior(observed: DataFrame, whitelist: DataFrame, threshold: float = 0.975) -> DataFrame:
    """observed(id, seq, quals array<int>) not in the whitelist(seq, count): the corrected sequence.

    Candidates at Hamming distance one weigh error probability at the changed base times (1 + count);
    the best is taken if its share reaches the threshold, ties going to the larger sequence."""
    unknown = observed.join(whitelist.select("seq"), "seq", "left_anti")
    spots = F.transform(F.sequence(F.lit(1), F.length("seq")), lambda i: F.struct(i.alias("at"), F.element_at("quals", i).alias("q")))
    tried = unknown.withColumn("spot", F.explode(spots)).withColumn("base", F.explode(F.array(*(F.lit(b) for b in S.BASES)))).where(F.col("base") != F.substring("seq", F.col("spot.at"), F.lit(1)))
    tried = tried.select("id", "seq", F.col("spot.q").alias("q"), F.overlay("seq", "base", F.col("spot.at"), F.lit(1)).alias("try"))
    hits = tried.join(whitelist.select(F.col("seq").alias("try"), "count"), "try").withColumn("weight", error_probability(F.col("q")) * (1 + F.col("count")))
    best = hits.groupBy("id", "seq").agg(F.max(F.struct("weight", "try")).alias("top"), F.sum("weight").alias("total"), F.count("*").alias("n_candidates"))
    share = ratio(F.col("top.weight"), F.col("total"))
    return best.select("id", "seq", F.when(share >= threshold, F.col("top.try")).alias("corrected"), share.alias("posterior"), "n_candidates")


def indel_classes(seqs: DataFrame, whitelist: DataFrame) -> DataFrame:
    """How a sequence outside the whitelist reaches it by one edit: substitution, indel, both or none."""
    unknown = seqs.select("seq").distinct().join(whitelist.select("seq"), "seq", "left_anti")
    col = F.col("seq")
    edits = F.concat(
        F.transform(S.one_substitutions(col), lambda x: F.struct(F.lit("sub").alias("kind"), x.alias("try"))),
        F.transform(S.one_insertions(col), lambda x: F.struct(F.lit("ins").alias("kind"), x.alias("try"))),
        F.transform(S.one_deletions(col), lambda x: F.struct(F.lit("del").alias("kind"), x.alias("try"))),
    )
    hits = unknown.select("seq", F.inline(edits)).join(whitelist.select(F.col("seq").alias("try")), "try").groupBy("seq").agg(
        F.count_distinct(F.when(F.col("kind") == "sub", F.col("try"))).alias("n_sub"), F.count_distinct(F.when(F.col("kind") != "sub", F.col("try"))).alias("n_indel")
    )
    out = unknown.join(hits, "seq", "left").na.fill(0, ["n_sub", "n_indel"])
    kind = F.when((F.col("n_sub") > 0) & (F.col("n_indel") > 0), "ambiguous").when(F.col("n_sub") > 0, "substitution").when(F.col("n_indel") > 0, "indel").otherwise("none")
    return out.withColumn("kind", kind)


def correct_umis(counts: DataFrame) -> DataFrame:
    """counts(barcode, gene, umi, reads): the UMI each becomes, by one hop.

    A UMI moves to the neighbour at Hamming distance one with the largest (reads, umi) above its own."""
    keyed = counts.select("barcode", "gene", "umi", "reads")
    tried = keyed.select("barcode", "gene", "umi", "reads", F.explode(S.one_substitutions(F.col("umi"))).alias("near"))
    target = keyed.select("barcode", "gene", F.col("umi").alias("near"), F.col("reads").alias("near_reads"))
    above = (F.col("near_reads") > F.col("reads")) | ((F.col("near_reads") == F.col("reads")) & (F.col("near") > F.col("umi")))
    best = tried.join(target, ["barcode", "gene", "near"]).where(above).groupBy("barcode", "gene", "umi").agg(F.max(F.struct("near_reads", "near")).alias("top"))
    return keyed.join(best, ["barcode", "gene", "umi"], "left").withColumn("corrected", F.coalesce("top.near", "umi")).drop("top")


def low_support(counts: DataFrame) -> DataFrame:
    """A UMI on several genes keeps the gene with strictly most reads; with a tie all are low support."""
    w = Window.partitionBy("barcode", "umi")
    top = F.max("reads").over(w)
    ties = F.count_if(F.col("reads") == F.col("top")).over(w)
    return counts.withColumn("top", top).withColumn("low_support", (F.col("reads") < F.col("top")) | (ties > 1)).drop("top")


def dedup_umis(counts: DataFrame) -> DataFrame:
    """Molecules after both rules, in their order: one read of each corrected UMI moves, low support is
    judged on that, then the other reads move."""
    moved = correct_umis(counts)
    changed = F.col("corrected") != F.col("umi")
    stay = moved.select("barcode", "gene", "umi", F.when(changed, F.col("reads") - 1).otherwise(F.col("reads")).alias("reads"))
    one = moved.where(changed).select("barcode", "gene", F.col("corrected").alias("umi"), F.lit(1).cast("long").alias("reads"))
    first = stay.unionByName(one).groupBy("barcode", "gene", "umi").agg(F.sum("reads").alias("reads")).where("reads > 0")
    weak = low_support(first).where("low_support").select("barcode", "gene", "umi")
    full = moved.groupBy("barcode", "gene", F.col("corrected").alias("umi")).agg(F.sum("reads").alias("reads"))
    return full.join(weak, ["barcode", "gene", "umi"], "left_anti")


def overlap_coefficients(members: DataFrame) -> DataFrame:
    """members(set_id, item): intersections of all pairs of sets that share an item, over the smaller set."""
    items = members.select("set_id", "item").distinct()
    sizes = items.groupBy("set_id").agg(F.count("*").alias("n"))
    a, b = items.select(F.col("set_id").alias("a"), "item"), items.select(F.col("set_id").alias("b"), "item")
    both = a.join(b, "item").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    sized = both.join(F.broadcast(sizes.select(F.col("set_id").alias("a"), F.col("n").alias("na"))), "a").join(F.broadcast(sizes.select(F.col("set_id").alias("b"), F.col("n").alias("nb"))), "b")
    return sized.select("a", "b", "shared", ratio(F.col("shared"), F.least("na", "nb")).alias("overlap"))


def nx(df: DataFrame, by: list[str], value: str, fraction: float) -> DataFrame:
    """The largest value at which the descending running sum reaches a fraction of the total.

    Values are counted first, so a window holds distinct values only."""
    counts = df.groupBy(*by, value).agg((F.count("*") * F.col(value)).alias("s"))
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    run = F.sum("s").over(part.orderBy(F.col(value).desc()))
    return counts.withColumn("run", run).withColumn("all", F.sum("s").over(part)).where(F.col("run") >= fraction * F.col("all")).groupBy(*by).agg(F.max(value).alias("nx"))


def robust_cosine(counts: DataFrame, fraction: float = 0.925) -> DataFrame:
    """counts(library, barcode, n): cosine of all pairs of libraries, each capped at its own Nx; 0 if disjoint."""
    cap = nx(counts, ["library"], "n", fraction)
    capped = counts.join(F.broadcast(cap), "library").withColumn("v", F.least("n", "nx").cast("double"))
    norms = capped.groupBy("library").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    a = capped.select(F.col("library").alias("a"), "barcode", F.col("v").alias("va"))
    b = capped.select(F.col("library").alias("b"), "barcode", F.col("v").alias("vb"))
    dots = a.join(b, "barcode").where("a < b").groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"))
    pairs = norms.select(F.col("library").alias("a"), F.col("norm").alias("x")).join(norms.select(F.col("library").alias("b"), F.col("norm").alias("y")), F.col("a") < F.col("b"))
    return pairs.join(dots, ["a", "b"], "left").select("a", "b", F.coalesce(ratio(F.col("dot"), F.col("x") * F.col("y")), F.lit(0.0)).alias("cosine"))


def match_features(reads: DataFrame, pattern: str, length: int, reference: DataFrame, column: str = "seq") -> DataFrame:
    """Extract a feature barcode by its pattern and look it up in reference(feature_seq, feature)."""
    found = reads.withColumn("feature_seq", F.regexp_extract(column, S.pattern_regex(pattern, length), 1))
    return found.join(F.broadcast(reference), "feature_seq", "left")


def feature_distribution(counts: DataFrame) -> DataFrame:
    """counts(feature_type, feature, n): proportion in the type; when all are zero each counts one."""
    w = Window.partitionBy("feature_type")
    total, size = F.sum("n").over(w), F.count("*").over(w)
    return counts.withColumn("proportion", F.when(total == 0, ratio(F.lit(1), size)).otherwise(ratio(F.col("n"), total)))


def correct_features(reads: DataFrame, dist: DataFrame, confidence: float = 0.975) -> DataFrame:
    """reads(id, seq, q): dist(seq, proportion); an exact hit weighs p, a neighbour p times the error probability."""
    exact = reads.select("id", "seq", F.col("seq").alias("try"), F.lit(1.0).alias("w"))
    near = reads.select("id", "seq", F.explode(S.one_substitutions(F.col("seq"))).alias("try"), error_probability(F.col("q")).alias("w"))
    hits = exact.unionByName(near).join(dist.select(F.col("seq").alias("try"), "proportion"), "try").withColumn("w", F.col("w") * F.col("proportion")).where("w > 0")
    best = hits.groupBy("id", "seq").agg(F.max(F.struct("w", "try")).alias("top"), F.sum("w").alias("total"))
    share = ratio(F.col("top.w"), F.col("total"))
    return best.select("id", "seq", F.when(share >= confidence, F.col("top.try")).alias("corrected"), share.alias("share"))


def kmer_matches(seqs: DataFrame, reference: DataFrame, k: int, column: str = "seq") -> DataFrame:
    """Rows with a k-mer of the reference, and how many distinct ones."""
    known = reference.select(F.explode(S.kmers(F.col(column), k)).alias("kmer")).distinct()
    mine = seqs.select("id", F.explode(F.array_distinct(S.kmers(F.col(column), k))).alias("kmer"))
    return mine.join(known, "kmer", "left_semi").groupBy("id").agg(F.count("*").alias("n_kmers"))


def trim_adapter(seq: Column, adapter: str, least: int = 3) -> Column:
    """Cut at the first whole adapter, else cut a suffix that begins the adapter."""
    at = F.instr(seq, adapter)
    partial = S.suffix_overlap(seq, F.lit(adapter), least)
    return F.when(at > 0, F.substring(seq, F.lit(1), at - 1)).otherwise(F.substring(seq, F.lit(1), F.length(seq) - partial))
