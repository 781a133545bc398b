"""Counting: molecules to matrices, summaries, selection and thresholds.

A molecule table has barcode, feature, umi, reads, library, gem_group; a matrix is a COO table
of barcode, feature, umi_count without zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import duplicate_fraction, ratio


def count_matrix(mol: DataFrame) -> DataFrame:
    """Distinct UMIs of each (barcode, feature)."""
    return mol.groupBy("barcode", "feature").agg(F.count_distinct("umi").alias("umi_count"))


def feature_summary(mol: DataFrame, features: DataFrame, cells: DataFrame) -> DataFrame:
    """Left join of a feature reference with its counts, over all barcodes and over cells."""
    marked = mol.join(F.broadcast(cells.select("barcode", F.lit(True).alias("cell"))), "barcode", "left")
    cell = F.col("cell")
    agg = marked.groupBy("feature").agg(
        F.count("*").alias("num_umis"), F.sum("reads").alias("num_reads"), F.count_distinct("barcode").alias("num_barcodes"),
        F.count(F.when(cell, 1)).alias("num_umis_cells"), F.coalesce(F.sum(F.when(cell, F.col("reads"))), F.lit(0)).alias("num_reads_cells"),
        F.count_distinct(F.when(cell, F.col("barcode"))).alias("num_barcodes_cells"),
    )
    out = features.join(agg, "feature", "left").na.fill(0, [c for c in agg.columns if c != "feature"])
    return out.withColumn("dup_frac", duplicate_fraction(F.col("num_umis"), F.col("num_reads"))).withColumn("dup_frac_cells", duplicate_fraction(F.col("num_umis_cells"), F.col("num_reads_cells")))


def barcode_summary(mol: DataFrame, meta: DataFrame, feature_types: DataFrame) -> DataFrame:
    """Per counted barcode, over all features and over each type: one pass, one shuffle for both levels.

    Every counted barcode has a row for every type, with zeros where it has no counts."""
    types = [r[0] for r in feature_types.select("feature_type").distinct().orderBy("feature_type").collect()]  # a handful
    typed = mol.join(feature_types, "feature")
    both = typed.withColumn("feature_subset", F.explode(F.array(F.lit("all"), F.col("feature_type"))))
    agg = both.groupBy("barcode", "feature_subset").agg(F.count("*").alias("num_umis"), F.sum("reads").alias("num_reads"), F.count_distinct("feature").alias("num_features"))
    subsets = F.array(F.lit("all"), *map(F.lit, types))
    every = agg.where("feature_subset = 'all'").select("barcode", F.explode(subsets).alias("feature_subset"))
    filled = every.join(agg, ["barcode", "feature_subset"], "left").na.fill(0, ["num_umis", "num_reads", "num_features"])
    return meta.join(filled, "barcode").withColumn("dup_frac", duplicate_fraction(F.col("num_umis"), F.col("num_reads")))


def library_totals(mol: DataFrame) -> DataFrame:
    """Totals by gem group and library with their roll-ups."""
    return mol.rollup("gem_group", "library").agg(F.count("*").alias("num_umis"), F.sum("reads").alias("num_reads"), F.count_distinct("barcode").alias("num_barcodes"))


def select_by(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def exclude(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_anti")


def threshold_axes(coo: DataFrame, least: int) -> DataFrame:
    """Rows and columns whose sums exceed a threshold; both are judged on the whole matrix."""
    features = coo.groupBy("feature").agg(F.sum("umi_count").alias("n")).where(F.col("n") > least)
    barcodes = coo.groupBy("barcode").agg(F.sum("umi_count").alias("n")).where(F.col("n") > least)
    return coo.join(features, "feature", "left_semi").join(barcodes, "barcode", "left_semi")


def threshold_axis(coo: DataFrame, axis: str, least: int) -> DataFrame:
    return coo.groupBy(axis).agg(F.sum("umi_count").alias("total")).where(F.col("total") > least)


def subset_counts(coo: DataFrame, features: DataFrame | None = None, barcodes: DataFrame | None = None) -> DataFrame:
    """Sums by barcode over masks, with their log2."""
    if features is not None:
        coo = select_by(coo, features, "feature")
    if barcodes is not None:
        coo = select_by(coo, barcodes, "barcode")
    return coo.groupBy("barcode").agg(F.sum("umi_count").alias("total")).withColumn("log_total", F.log2(1.0 + F.col("total")))


def axis_counts(coo: DataFrame, axis: str, other: str) -> DataFrame:
    """Sum, entries, entries of at least two, maximum and share of the total along an axis."""
    return coo.groupBy(axis).agg(
        F.sum("umi_count").alias("total"), F.count_distinct(other).alias("entries"), F.count_if(F.col("umi_count") >= 2).alias("entries_ge2"), F.max("umi_count").alias("largest")
    ).withColumn("frac", ratio(F.col("total"), F.sum("total").over(Window.partitionBy(F.lit(0)))))


def counts_by(coo: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """Sums by barcode and a label of the features (a genome, a type)."""
    return coo.join(F.broadcast(dim.select(key, label)), key).groupBy("barcode", label).agg(F.sum("umi_count").alias("total"))


def representative_reads(mol: DataFrame, order: list[Column]) -> DataFrame:
    """The first molecule row of each (barcode, feature, umi), with the number of rows."""
    by = ["barcode", "feature", "umi"]
    first = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return mol.groupBy(*by).agg(F.min(first).alias("first"), F.count("*").alias("copies"), F.sum("reads").alias("reads")).select(*by, "copies", "reads", "first.*")


def merge_matrices(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("barcode", "feature").agg(F.sum("umi_count").alias("umi_count"))


def diff_matrices(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries that differ: only left, only right, or unequal."""
    x, y = a.withColumnRenamed("umi_count", "left_count"), b.withColumnRenamed("umi_count", "right_count")
    kind = F.when(F.col("right_count").isNull(), "left_only").when(F.col("left_count").isNull(), "right_only").otherwise("differs")
    return x.join(y, ["barcode", "feature"], "full").where(~F.col("left_count").eqNullSafe(F.col("right_count"))).withColumn("kind", kind)


def merge_molecules(parts: list[DataFrame]) -> DataFrame:
    """Concatenate molecule tables; gem groups and libraries get new dense ids by (input, old id).

    The two id tables are small dimensions; rows are not shuffled."""
    whole = None
    for i, p in enumerate(parts):
        p = p.withColumn("input", F.lit(i))
        whole = p if whole is None else whole.unionByName(p)
    for col in ("gem_group", "library"):
        ids = whole.select("input", col).distinct()
        ids = ids.withColumn(f"new_{col}", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("input", col)))
        whole = whole.join(F.broadcast(ids), ["input", col])
    return whole


def dense_index(df: DataFrame, key: str) -> DataFrame:
    """Sorted distinct keys with an index from zero.

    Offsets of range partitions come from their sizes, so no task sees all keys."""
    spark = df.sparkSession
    keys = df.select(key).distinct().repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), key).withColumn("part", F.spark_partition_id())
    sizes = keys.groupBy("part").agg(F.count("*").alias("n"))
    offsets = sizes.withColumn("base", F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1
    return keys.withColumn("i", inside).join(F.broadcast(offsets), "part").select(key, (F.coalesce("base", F.lit(0)) + F.col("i")).alias("idx"))


def matrix_market(coo: DataFrame, barcodes: DataFrame, features: DataFrame) -> DataFrame:
    """One-based triples for a Matrix Market file, from index tables of both axes."""
    return coo.join(F.broadcast(features), "feature").join(barcodes, "barcode").select((F.col("feature_idx") + 1).alias("row"), (F.col("barcode_idx") + 1).alias("col"), F.col("umi_count").alias("value"))


def chunk_plan(df: DataFrame, keys: list[str], target: int) -> DataFrame:
    """Chunks of about `target` rows that never split a key: a key goes by the rows before it."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(*keys)) - F.col("n")
    return sizes.withColumn("chunk", F.floor(before / target).cast("long")).groupBy("chunk").agg(F.count("*").alias("groups"), F.sum("n").alias("rows"))


def interval_join(points: DataFrame, intervals: DataFrame, bin_width: int) -> DataFrame:
    """points(chrom, start, end, id) with overlapping intervals(chrom, lo, hi, name).

    Each side is spread over the bins that it touches, so the join is an equi-join; a pair is
    kept in the bin where the later of both starts lies, hence once."""
    p = points.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / bin_width), F.floor(F.col("end") / bin_width))))
    i = intervals.withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / bin_width), F.floor(F.col("hi") / bin_width))))
    at = F.floor(F.greatest("start", "lo") / bin_width)
    return p.join(i, ["chrom", "bin"]).where((F.col("start") <= F.col("hi")) & (F.col("lo") <= F.col("end")) & (F.col("bin") == at)).drop("bin")


def annotate_region(points: DataFrame, exons: DataFrame, bin_width: int) -> DataFrame:
    """exonic inside an interval, intronic when an interval is only touched, else intergenic."""
    hits = interval_join(points, exons, bin_width).groupBy("id").agg(F.count("*").alias("n_overlaps"), F.max(((F.col("lo") <= F.col("start")) & (F.col("end") <= F.col("hi"))).cast("int")).alias("inside"))
    region = F.when(F.col("inside") == 1, "exonic").when(F.col("inside") == 0, "intronic").otherwise("intergenic")
    return points.join(hits, "id", "left").withColumn("region", region).withColumn("n_overlaps", F.coalesce("n_overlaps", F.lit(0).cast("long")))
