"""Exact deduplication over an extendible-hash index on shared files (DataFrame operations only).

Texts are equal when identical after deleting ASCII white space; null counts as empty.
Of equal texts the row with the most code points in the original text stays, then the
smallest doc_id (null ids last), then, for repeated rows, any single one of them.
The directory doubles while a bucket holds more distinct keys than its capacity; copies
share one key, so a large group of copies never forces splits. What is still overfull at
the largest depth is an overflow chain. Texts whose key occurs more than once go to the owner
of their bucket, a task that takes whole buckets, that is ranges of keys; copies are combined in
parts on the way, so a hot text arrives in a few rows. The owner compares the bytes of what
shares a key; different texts on one key become links of a chain. Which row stays and how many
there are is read from that index. An empty table gives no rows; extra columns, whatever their
names, are ignored; texts are compared whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_ascii_space, keep_one_row, materialize, n_shuffle, small_side, text_or_empty

#: Parts in which the copies of a text are combined before their bucket's owner gets them.
SALTS = 16


def split_directory(cells: dict[int, int], max_depth: int, capacity: int) -> list[tuple[int, int, int]]:
    """(bucket, first cell, cells) by doubling: cells counts keys at the largest depth, of which
    there are 2**max_depth at most, so the driver holds a bounded table."""
    sums = [dict(cells)]
    for _ in range(max_depth):
        up: dict[int, int] = {}
        for cell, n in sums[-1].items():
            up[cell >> 1] = up.get(cell >> 1, 0) + n
        sums.append(up)
    out, work = [], [(0, 0)]
    while work:
        depth, prefix = work.pop()
        if depth < max_depth and sums[max_depth - depth].get(prefix, 0) > capacity:
            work += [(depth + 1, 2 * prefix + 1), (depth + 1, 2 * prefix)]
        else:
            width = 1 << (max_depth - depth)
            out.append((len(out), prefix * width, width))
    return out


def _key(norm: Column, hash_bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - hash_bits) if hash_bits < 64 else F.xxhash64(norm)


def _cell(hash_bits: int, depth: int) -> Column:
    return F.shiftrightunsigned(F.col("key"), hash_bits - depth).cast("int")


def build_index(entries: DataFrame, docs: DataFrame, hash_bits: int, max_depth: int, capacity: int, text_col: str) -> DataFrame:
    """bucket, key, chain, sha, group_size, n_chars, lo of every text whose key is not alone, on shared files.

    Copies are combined in SALTS parts; a task then owns whole buckets, compares the bytes of what shares a key there
    and chains the texts that differ. n_chars and lo, the complement of the id, are those of the row that stays."""
    spark = docs.sparkSession
    depth = min(max_depth, hash_bits)
    keys = entries.groupBy("key").agg(F.count("*").alias("n"))
    cells = keys.groupBy(_cell(hash_bits, depth).alias("cell")).agg(F.count("*").alias("n")).collect()  # 2**depth rows at most
    buckets = split_directory({r["cell"]: r["n"] for r in cells}, depth, capacity)
    directory = spark.createDataFrame(buckets, "bucket int, first int, width int").select("bucket", F.explode(F.expr("sequence(first, first + width - 1)")).alias("cell"))
    shared = materialize(keys.where("n > 1").select("key"), "shared_keys")
    text = text_or_empty(text_col)
    rows = docs.select(F.bitwise_not(F.col("doc_id")).alias("lo"), F.length(text).cast("long").alias("n_chars"), drop_ascii_space(text).alias("norm"))
    rows = rows.withColumn("key", _key(F.col("norm"), hash_bits)).join(small_side(shared), "key", "left_semi")
    owned = rows.withColumn("cell", _cell(hash_bits, depth)).join(F.broadcast(directory), "cell")
    # ~x falls as x grows and cannot overflow; a null orders below every number
    best = lambda n: [F.sum(n).alias("n"), F.max(F.struct("n_chars", "lo")).alias("best")]
    parts = owned.groupBy("bucket", "key", "norm", F.pmod(F.xxhash64("lo"), F.lit(SALTS)).alias("salt")).agg(*best(F.lit(1)))
    parts = parts.select("bucket", "key", "norm", "n", "best.*").repartition(n_shuffle(spark), "bucket")
    groups = parts.groupBy("bucket", "key", "norm").agg(*best(F.col("n")))
    sha = groups.select("bucket", "key", F.sha2("norm", 256).alias("sha"), F.col("n").alias("group_size"), "best.*")
    chain = Window.partitionBy("bucket", "key").orderBy("sha")
    linked = sha.withColumn("chain", F.row_number().over(chain)).withColumn("before", F.lag("sha").over(chain))
    # links of a chain differ in their bytes; should two have one SHA-256, never merge them silently
    same = F.when(F.col("before") == F.col("sha"), F.raise_error(F.lit("different texts share a SHA-256")).cast("string")).otherwise(F.col("sha"))
    return materialize(linked.select("bucket", "key", "chain", same.alias("sha"), "group_size", "n_chars", "lo"), "index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64, max_depth: int = 16, capacity: int = 4096) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256, n_chars."""
    docs, text_col = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text"
    text = text_or_empty(text_col)
    entries = materialize(
        docs.select("doc_id", F.length(text).cast("long").alias("n_chars"), drop_ascii_space(text).alias("norm")).select(
            "doc_id", "n_chars", _key(F.col("norm"), hash_bits).alias("key"), F.sha2("norm", 256).alias("sha"), F.monotonically_increasing_id().alias("tie")
        ),
        "entries",
    )
    index = build_index(entries, docs, hash_bits, max_depth, capacity, text_col)
    groups = materialize(index.where("group_size > 1").select("key", "sha", "group_size", F.bitwise_not("lo").alias("keep_id"), F.col("n_chars").alias("keep_chars")), "groups")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    # repeated rows share id and text: the first of them stays
    first = materialize(entries.join(small_side(groups), ["key", "sha"]).where(stays).groupBy("key", "sha", "group_size", "keep_id").agg(F.min("tie").alias("keep_tie")), "first")
    joined = entries.join(small_side(first), ["key", "sha"], "left")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("tie") == F.col("keep_tie"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_chars",
    )


def keep_first_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    verdict = exact_dedup(docs, **options).where("group_size > 1")
    rows = verdict.select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), F.col("n_chars").alias("n")).alias("key"), "kept")
    text = text_or_empty(text_col)
    return keep_one_row(docs, F.struct(F.col(id_col).alias("id"), F.sha2(drop_ascii_space(text), 256).alias("sha"), F.length(text).cast("long").alias("n")), rows)
