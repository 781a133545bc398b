"""Selections, checks and small kernels over rows and sorted arrays, as column expressions and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def column_range(coo: DataFrame, start: int, end: int) -> DataFrame:
    """The barcodes at places [start, end) of the sorted barcode axis; the axis alone is ranked, up to its end."""
    axis = coo.select("barcode").distinct().orderBy("barcode").limit(end)
    placed = axis.withColumn("place", F.row_number().over(Window.orderBy("barcode")) - 1).where(F.col("place") >= start)
    return coo.join(F.broadcast(placed), "barcode")


def unify(parts: list[DataFrame]) -> DataFrame:
    """One table of parts that may lack columns of each other."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def concat_columns(left: DataFrame, right: DataFrame, left_features: DataFrame, right_features: DataFrame) -> DataFrame:
    """Two matrices side by side; their feature axes must hold the same features."""
    one, two = (f.select("feature").distinct() for f in (left_features, right_features))
    odd = one.exceptAll(two).unionByName(two.exceptAll(one)).limit(1)
    if odd.count():
        raise ValueError("the matrices have different features")
    return left.unionByName(right)


def narrowest(df: DataFrame) -> DataFrame:
    """column, type: the smallest integer type that holds each integer column; one pass."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long")]
    ends = df.agg(*(F.min(c).cast("long").alias(f"lo_{c}") for c in names), *(F.max(c).cast("long").alias(f"hi_{c}") for c in names))
    each = ends.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in names))).alias("x")).select("x.*")
    kind = F.lit("int64")
    for bits in (32, 16, 8):
        kind = F.when((F.col("lo") >= -(1 << bits - 1)) & (F.col("hi") < 1 << bits - 1), f"int{bits}").otherwise(kind)
    return each.select("name", kind.alias("kind"))


def reindex_targets(features: DataFrame, kept: DataFrame) -> DataFrame:
    """target_set, feature, place: target sets over the places of the kept features in order."""
    place = F.row_number().over(Window.orderBy("feature")) - 1  # one row a kept feature of the reference
    return features.join(kept.select("feature").withColumn("place", place), "feature").select("target_set", "feature", "place")


def join_features(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two references in one; the second's indexes follow the first's."""
    n = first.agg((F.coalesce(F.max("index"), F.lit(-1)) + 1).alias("shift"))
    return first.unionByName(second.join(F.broadcast(n)).withColumn("index", F.col("index") + F.col("shift")).drop("shift"))


def sort_by_keys(values: Column, keys: Column) -> Column:
    """values in the order of keys, ties by value."""
    return F.transform(F.array_sort(F.arrays_zip(keys.alias("k"), values.alias("v"))), lambda x: x["v"])


def meets(x: Column, y: Column) -> Column:
    return F.arrays_overlap(x, y)


def contains_at(s: Column, t: Column, place: Column) -> Column:
    """Whether t stands in s from place, counted from 0."""
    return (place + F.size(t) <= F.size(s)) & (F.slice(s, place + 1, F.size(t)) == t)


def lower_bound(x: Column, value: Column) -> Column:
    """Elements of a sorted array that are below value."""
    return F.size(F.filter(x, lambda v: v < value))


def run_ends(x: Column) -> Column:
    """For each place of an array, where the next other value begins."""
    n = F.size(x)
    return F.transform(x, lambda v, i: F.coalesce(F.get(F.filter(F.sequence(i, n - 1), lambda j: F.get(x, j) != v), 0), n))


def erase(x: Column, gone: Column) -> Column:
    """x without the places whose flag is set."""
    return F.filter(x, lambda _, i: ~F.get(gone, i))


def between(text: Column, left: str, right: str) -> Column:
    """What stands between the first left and the next right; null without both."""
    after = F.when(F.instr(text, left) > 0, F.substr(text, F.instr(text, left) + len(left)))
    return F.when(F.instr(after, right) > 0, F.substring_index(after, right, 1))


def safe_number(c: Column) -> Column:
    """A number as text that JSON readers take: NaN and infinities are strings."""
    return (
        F.when(F.isnan(c), F.lit('"NaN"')).when(c == float("inf"), F.lit('"inf"')).when(c == float("-inf"), F.lit('"-inf"')).when(c.isNull(), F.lit("null")).otherwise(c.cast("string"))
    )


def homopolymer(seq: Column, least: int) -> Column:
    """Whether one base stands at least so many times in a row."""
    return seq.rlike("|".join(f"{b}{{{least},}}" for b in "ACGT"))


def suffix_prefix(seq: Column, start: Column, least: int, probe: Column) -> Column:
    """Whether at least so many first bases of probe stand in seq from start."""
    return F.substr(seq, start, F.lit(least)) == F.substr(probe, F.lit(1), F.lit(least))


def neighbours_to_use(n: int, given: int = 0, base: int = -230, per_decade: int = 120) -> int:
    """Neighbours for a graph of n cells: as given, else by the cells' decades, from 1 to n - 1."""
    import math

    k = given or round(base + per_decade * math.log10(max(1, n)))
    return max(1, min(k, max(1, n - 1)))


def running_loglik(draws: DataFrame, order: str) -> DataFrame:
    """draws(barcode, feature, p): multinomial log-likelihood of a barcode's draws so far."""
    sofar, mine = Window.partitionBy("barcode").orderBy(order), Window.partitionBy("barcode", "feature").orderBy(order)
    i, k = F.row_number().over(sofar), F.row_number().over(mine)
    step = draws.withColumn("step", F.log("p") + F.log(i.cast("double")) - F.log(k.cast("double")))
    return step.withColumn("loglik", F.sum("step").over(sofar)).drop("step")


def running_dm_loglik(draws: DataFrame, order: str, alpha: float) -> DataFrame:
    """The same of a Dirichlet-multinomial with weights alpha * p."""
    sofar, mine = Window.partitionBy("barcode").orderBy(order), Window.partitionBy("barcode", "feature").orderBy(order)
    i, k = F.row_number().over(sofar).cast("double"), F.row_number().over(mine).cast("double")
    step = draws.withColumn("step", F.log(i) - F.log(k) + F.log(alpha * F.col("p") + k - 1) - F.log(alpha + i - 1))
    return step.withColumn("loglik", F.sum("step").over(sofar)).drop("step")


def top_sums(totals: DataFrame, sizes: list[int]) -> DataFrame:
    """n, top_sum: totals of the n largest, for each n; only the largest are ranked."""
    head = totals.orderBy(F.col("total").desc(), "barcode").limit(max(sizes))
    ranked = head.withColumn("r", F.row_number().over(Window.orderBy(F.col("total").desc(), "barcode")))
    each = ranked.withColumn("n", F.explode(F.array(*map(F.lit, sizes)))).where("r <= n")
    return each.groupBy("n").agg(F.sum("total").alias("top_sum"))
