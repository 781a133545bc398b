"""Sharding by global byte-size prefix sums.

Documents are ordered by (doc_id, text CRC, size); nulls come first, rows that are equal
in all three take any order among themselves. Each row has size = UTF-8 bytes of its text
(null: none) + overhead. Per-partition totals give every partition its global byte and
row offset; a row goes to the shard in whose equal byte range its midpoint lies, so shards
are contiguous and their sizes differ by at most one row. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_shuffle, text_or_empty


def shard_by_bytes(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard (null: this law has no growth rule)."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    keys = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc(), F.col("tie").asc()]
    # Fixed once in the shared folder: range bounds come from a sample and must not move between passes.
    rows = materialize(slim.repartitionByRange(n_shuffle(spark), *keys).withColumn("part", F.spark_partition_id()), "rows")
    totals = rows.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()  # one row a partition
    offsets, at_byte, at_row = [], 0, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        offsets.append((r["part"], at_byte, at_row))
        at_byte, at_row = at_byte + r["b"], at_row + r["n"]
    bases = spark.createDataFrame(offsets, "part int, byte_base long, row_base long")
    run = Window.partitionBy("part").orderBy(*keys)
    placed = (
        rows.withColumn("end", F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("nth", F.row_number().over(run))
        .join(F.broadcast(bases), "part")
        .withColumn("mid2", 2 * (F.col("byte_base") + F.col("end")) - F.col("size"))
        .withColumn("mid2", F.col("mid2").cast("decimal(20,0)"))
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(f"mid2 * {n_shards}BD div {2 * max(at_byte, 1)}BD")).cast("int"))
        .withColumn("row", F.col("row_base") + F.col("nth") - 1)
        .select("doc_id", "size", "text_crc32", "shard", "row")
    )
    placed = materialize(placed, "placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
