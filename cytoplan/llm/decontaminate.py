r"""Benchmark decontamination by a prefix-filtered set join (DataFrame operations only).

Words are the runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z. A window is
``width`` consecutive words of an item; a shorter item, if not empty, is one window. Windows
are sets of shingles of three words (shorter windows are one shingle). All documents are
shingled once and only shingles that the benchmark has are kept; their counts give the order
of rarity. A window is looked for only where its rarest shingle is (containment needs all of
its shingles, so one is the necessary prefix), kept if it fits between the document's ends at
that place, and verified by shingles that together cover all its words.

Documents are never shuffled: the benchmark's shingles are broadcast within a size bound, and
joined by a shuffle beyond it. Defined cases: null and empty texts have no words; repeated
rows give repeated results; items that share an id count once, a null item id is the string
"null"; an empty benchmark contaminates nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small_side, table, text_or_empty

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 3
#: Key of the row that stands for a document itself.
DOC_KEY = 0


def ascii_lower(c: Column) -> Column:
    """lower() is far faster and the same where a text is all ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_list(c: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(c), GAP), "")


def item_windows(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """window (words joined by a space), len, item: distinct."""
    words = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), word_list(text_or_empty(text_col)).alias("w")).where(F.size("w") > 0)
    starts = words.withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))))
    cut = F.slice("w", F.col("at"), F.lit(width))
    return starts.select(F.array_join(cut, " ").alias("window"), F.size(cut).alias("len"), "item").distinct()


def window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """window, len, off, gram of windows of at least size words."""
    w = F.split("window", " ")
    rows = windows.where(F.col("len") >= size).select("window", "len").distinct().withColumn("off", F.explode(F.sequence(F.lit(0), F.col("len") - size)))
    return rows.select("window", "len", "off", F.array_join(F.slice(w, F.col("off") + 1, size), " ").alias("gram"))


def matched_shingles(docs: DataFrame, grams: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, h, n_words, pos, gram: the places of grams, and one row at pos 0 for each document."""
    text = text_or_empty(text_col)
    listed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), F.concat(F.array(F.lit("")), word_list(text)).alias("w"))
    n = F.size("w")
    zipped = F.arrays_zip(*(F.slice("w", k + 1, F.greatest(n - k, F.lit(0))).alias(f"w{k}") for k in range(size)))
    rows = listed.select("doc_id", "h", (n - 1).cast("long").alias("n_words"), F.posexplode(zipped).alias("pos", "g"))
    parts = [F.col(f"g.w{k}") for k in range(size)]
    full = parts[-1].isNotNull()
    key = F.when(F.col("pos") == 0, F.lit(DOC_KEY).cast("long")).when(full, F.xxhash64(*parts))
    keyed = rows.withColumn("key", key)
    known = grams.select("gram").distinct().withColumn("__k", F.split("gram", " "))
    known = known.select("gram", F.xxhash64(*(F.col("__k")[k] for k in range(size))).alias("key"))
    known = materialize(known.unionByName(docs.sparkSession.range(1).select(F.lit("").alias("gram"), F.lit(DOC_KEY).cast("long").alias("key"))), "grams")
    same = (F.col("pos") == 0) == (F.col("gram") == "")
    exact = (F.col("pos") == 0) | (F.concat_ws(" ", *parts) == F.col("gram"))
    return keyed.join(small_side(known), "key").where(same & exact).select("doc_id", "h", "n_words", "pos", "gram")


def contained_windows(matches: DataFrame, shingles: DataFrame, size: int) -> DataFrame:
    """doc_id, h, start, len, window: exact occurrences of windows."""
    places = matches.where("pos > 0")
    counts = places.groupBy("gram").agg(F.count("*").alias("n"))
    rank = F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "gram", "off")
    prefix = shingles.join(counts, "gram", "left").groupBy("window", "len").agg(F.min(rank).alias("r")).where("r.n > 0")
    prefix = materialize(prefix.select("window", "len", F.col("r.gram").alias("gram"), F.col("r.off").alias("off")), "prefix")
    start = F.col("pos") - F.col("off")
    found = places.join(small_side(prefix), "gram").withColumn("start", start).where((F.col("start") >= 1) & (F.col("start") + F.col("len") - 1 <= F.col("n_words")))
    # shingles that cover the window: every size-th one and the last
    last = F.col("len") - size
    cover = materialize(shingles.where((F.col("off") % size == 0) | (F.col("off") == last)).select("window", F.col("off").alias("o"), F.col("gram").alias("g")), "cover")
    need = cover.groupBy("window").agg(F.count("*").alias("need"))
    asked = found.select("doc_id", "h", "start", "len", "window").distinct().join(small_side(cover), "window").withColumn("pos", F.col("start") + F.col("o"))
    have = places.select(F.col("doc_id").alias("d"), F.col("h").alias("hh"), F.col("pos").alias("p"), F.col("gram").alias("g2")).distinct()
    met = asked.join(have, asked["doc_id"].eqNullSafe(have["d"]) & (asked["h"] == have["hh"]) & (asked["pos"] == have["p"]) & (asked["g"] == have["g2"]), "left_semi")
    return met.groupBy("doc_id", "h", "start", "len", "window").agg(F.count("*").alias("met")).join(small_side(materialize(need, "need")), "window").where("met = need").select("doc_id", "h", "start", "len", "window")


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, h (a hash of the text)."""
    windows = materialize(item_windows(items, width), "windows")
    sizes = [r["s"] for r in windows.select(F.least("len", F.lit(SHINGLE)).alias("s")).distinct().collect()]  # 1 to SHINGLE
    every, hits = None, None
    for size in sorted({*sizes, SHINGLE}, reverse=True):
        mine = windows.where((F.col("len") >= size) & (F.least("len", F.lit(SHINGLE)) == size))
        shingles = materialize(window_shingles(mine, size), "shingles")
        matches = materialize(matched_shingles(docs, shingles, size, id_col, text_col), "matches")
        every = matches.where("pos = 0") if every is None else every
        found = contained_windows(matches, shingles, size)
        hits = found if hits is None else hits.unionByName(found)
    hits = materialize(hits, "hits")
    covered = hits.select("doc_id", "h", F.explode(F.expr("sequence(start, start + len - 1)")).alias("p")).distinct().groupBy("doc_id", "h").agg(F.count("*").alias("n_hit"))
    named = hits.join(small_side(windows.select("window", "item")), "window").select("doc_id", "h", "item").distinct()
    listed = named.groupBy("doc_id", "h").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("ids"))
    both = covered.withColumnsRenamed({"doc_id": "d", "h": "hh"}).join(listed.withColumnsRenamed({"doc_id": "d2", "h": "h2"}), F.expr("d <=> d2 and hh = h2")).select("d", "hh", "n_hit", "n_items", "ids")
    both = materialize(both, "verdict")
    out = every.join(small_side(both), every["doc_id"].eqNullSafe(both["d"]) & (every["h"] == both["hh"]), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated"), "h",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs that hold no window of an item, with all their columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    bad = materialize(decontaminate(docs, items, **options).where("contaminated").select(F.col("doc_id").alias("__d"), F.col("h").alias("__h")).distinct(), "bad")
    return docs.join(small_side(bad), docs[id_col].eqNullSafe(bad["__d"]) & (F.xxhash64(text_or_empty(text_col)) == bad["__h"]), "left_anti")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("h")


OP7_SQL = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
bw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
win as (select distinct item_id, least(len(w), 10) n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') t
  from bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) u(i) where len(w) > 0),
sizes as (select distinct n from win),
dg as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') t from dw, sizes, unnest(range(1, len(w) - n + 2)) u(i)),
hit as (select doc_id, item_id, dg.i, dg.n from dg join win using (t, n)),
cov as (select doc_id, count(distinct p)::bigint n_hit from hit, unnest(range(i, i + n)) u(p) group by doc_id),
it as (select doc_id, count(*)::bigint n_items, string_agg(s, ',' order by s) ids from (select distinct doc_id, item_id::varchar s from hit) group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from dw left join cov using (doc_id) left join it using (doc_id)
"""
