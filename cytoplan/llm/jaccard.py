r"""N-gram Jaccard join by a token-group matrix.

A document's set holds its distinct shingles of five words (``[^\x20\x09-\x0D]+``, A-Z lower-cased);
with fewer words the whole sequence is its one shingle. Two documents link when
100 * intersection >= 80 * union; the result is the components of the links.

1. Documents with equal sets are one class; work goes on with one row a class.
2. Tokens (shingle hashes) are counted over all documents; the most frequent ones, at most
   ``FREQUENT``, are sent to all tasks so that every set can be ordered by rarity. The order only
   steers the cost. Linked sets share a token among the first n - ceil(0.8 n) + 1 of each.
3. Similar classes are partitioned into groups: of all classes under a token each is compared
   with the least one only, which is linear, and verified links make the first groups.
4. The matrix holds for each token the groups whose union of prefix tokens has it. A class that
   meets another group there opens it if the group's bounds on set sizes and on the overlap that
   is left after this token allow a link; its members are compared by size and by a parity sketch, whose
   distance bounds the symmetric difference from below, and what passes is verified on whole texts. Where a
   group has one member under the token, that member's sketch is the bound: linked sets share a token
   that both have in their prefixes. No link between classes of different groups can escape, and links
   inside a group change nothing.

Verification streams members past a leader's text, salted, so that no leader's members gather in
one task. Defined cases: null texts and texts without words have an empty set, link with nothing and
are their own component; null ids are ignored for the least id of a component unless all are null;
repeated rows are one class; an empty table gives no rows. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, keep_one_row, materialize, n_shuffle, small_side, table, text_or_empty
from .shingles import distinct, gram_hashes, word_hashes, words_of

GRAM = 5
#: Similarity in hundredths.
SIMILARITY = 80
#: Most tokens that the list of frequent ones holds, and the least count of one.
FREQUENT, FREQUENT_COUNT = 400_000, 12
#: Longs of a parity sketch.
SKETCH = 16
#: Members that one verifying task streams past a leader.
SALT_MEMBERS = 64
#: Tokens that a counting task gathers before it hands them on.
COUNT_TOKENS = 500_000
_ONE = np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes."""
    h = word_hashes(words_of(text, lower=True))
    return distinct(gram_hashes(h, min(GRAM, len(h)))) if len(h) else h


def class_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63)


def sketches(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the tokens on each of 64 * SKETCH places, the parity and whether there are any.

    Two sets' parities differ on no more places than their symmetric difference has tokens; a set has
    no fewer tokens outside a union than it has places outside the union's places."""
    bit = (s >> np.uint64(20)) % np.uint64(64 * SKETCH)
    n = np.bincount(bit.astype(np.int64), minlength=64 * SKETCH)
    return np.packbits((n & 1).astype(np.uint8)).view(np.int64), np.packbits((n > 0).astype(np.uint8)).view(np.int64)


def prefix_length(n: int) -> int:
    return n - -(-SIMILARITY * n // 100) + 1 if n else 0


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def rare_first(s: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The prefix of a set in order: tokens off the list by hash, then those on it by rank."""
    k = prefix_length(len(s))
    key = s >> np.uint64(1)
    if len(frequent):
        short = s >> np.uint64(20)
        at = np.minimum(np.searchsorted(frequent, short), len(frequent) - 1)
        on = frequent[at] == short
        key = np.where(on, (_ONE << np.uint64(63)) + rank[at].astype(np.uint64), key)
    first = np.argpartition(key, k - 1)[:k] if k < len(s) else np.arange(len(s))
    return s[first[np.argsort(key[first])]]


def frequent_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 44-bit tokens met most often in all documents, and their ranks by count.

    Counted as packed arrays, bucket by bucket; the number of buckets follows the input."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = min(20, max(5, math.ceil(math.log2(size / 6 / (1 << 17) + 1))))

    rest = 44 - bits
    width = (rest + 7) // 8

    def gather(batches):
        """A bucket's tokens of a run of texts: those met once, and those met more often with their counts."""
        held, n = [], 0

        def parts(tokens):
            ends = np.searchsorted(tokens, np.arange(1, (1 << bits) + 1, dtype=np.uint64) << np.uint64(rest))
            low = (tokens & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            return np.concatenate([[0], ends[:-1]]), ends, low

        def out():
            tokens, times = np.unique(np.concatenate(held) >> np.uint64(20), return_counts=True)
            many = times > 1
            times = times[many].astype("<u4")
            (lo, hi, one), (lo2, hi2, more) = parts(tokens[~many]), parts(tokens[many])
            full = np.flatnonzero((hi > lo) | (hi2 > lo2))
            cols = [[one[lo[i] : hi[i]].tobytes() for i in full], [more[lo2[i] : hi2[i]].tobytes() for i in full], [times[lo2[i] : hi2[i]].tobytes() for i in full]]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(c, pa.binary()) for c in cols)], names=["bucket", "once", "more", "times"])

        for b in batches:
            for text in b.column(0).to_pylist():
                s = shingle_set(text)
                if len(s):
                    held.append(s)
                    n += len(s)
                if n >= COUNT_TOKENS:
                    yield out()
                    held, n = [], 0
        if n:
            yield out()

    def count(batches):
        bucket, held = None, ([], [], [])

        def unpacked(parts):
            raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :width] = raw
            return wide.view("<u8").ravel()

        def out():
            once, more = map(unpacked, held[:2])
            tokens, at = np.unique(np.concatenate([once, more]), return_inverse=True)
            times = np.frombuffer(b"".join(held[2]), "<u4").astype(np.int64)
            n = np.bincount(at, np.concatenate([np.ones(len(once), np.int64), times]), len(tokens)).astype(np.int64)
            on = n >= FREQUENT_COUNT
            token = tokens[on].astype(np.int64) + (int(bucket) << rest)
            return pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(n[on], pa.int64())], names=["token", "n"])

        for b in batches:
            for k, *packed in zip(*(b.column(c).to_pylist() for c in ("bucket", "once", "more", "times")), strict=True):
                if k != bucket:
                    if bucket is not None:
                        yield out()
                    bucket, held = k, ([], [], [])
                for h, x in zip(held, packed, strict=True):
                    h.append(x)
        if bucket is not None:
            yield out()

    packed = docs.select("text").mapInArrow(gather, "bucket int, once binary, more binary, times binary")
    counted = packed.repartition(n_shuffle(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(count, "token long, n long")
    top = counted.orderBy(F.col("n").desc(), "token").limit(FREQUENT).toArrow()
    token, n = top.column("token").to_numpy(), top.column("n").to_numpy()
    rank = np.lexsort((token, n)).argsort().astype(np.uint32)  # rarest first
    order = np.argsort(token)
    return token[order].astype(np.uint64), rank[order]


def describe(docs: DataFrame) -> DataFrame:
    """row, doc_id, h (a hash of the text), n, cid, sketch (parity), places, prefix: one row a document."""
    frequent, rank = frequent_tokens(docs)
    sent = docs.sparkSession.sparkContext.broadcast((frequent, rank))

    def run(batches):
        frequent, rank = sent.value
        for b in batches:
            n, cid, sk, pl, pre = [], [], [], [], []
            for text in b.column(3).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                cid.append(class_id(s) if len(s) else None)
                odd, some = sketches(s)
                sk.append(odd)
                pl.append(some)
                pre.append(rare_first(s, frequent, rank).view(np.int64))
            lists = lambda parts: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts) if parts else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), lists(sk), lists(pl), lists(pre)], names=["row", "doc_id", "h", "n", "cid", "sketch", "places", "prefix"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("h"), "text")
    return materialize(rows.mapInArrow(run, "row long, doc_id long, h long, n long, cid long, sketch array<long>, places array<long>, prefix array<long>"), "described")


def connect(edges: DataFrame) -> DataFrame:
    """node, comp (its least node) over edges(a, b): minimum labels with pointer jumps."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("c2"))
        low = labels.join(near, "node").select("node", "comp", F.least("comp", "c2").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("comp").alias("c3"))
        step = materialize(low.join(jump, "c", "left").select("node", F.coalesce(F.least("c", "c3"), "c").alias("comp"), F.col("comp").alias("old")), "labels")
        labels = step.select("node", "comp")
        if not step.where("comp <> old").limit(1).count():
            return labels


def may_link(a: str, b: str) -> Column:
    """Bounds by size and sketch, exact in that no linked pair fails them."""
    n1, n2 = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k])) for k in range(1, SKETCH)), F.bit_count(F.col(f"{a}.sketch")[0].bitwiseXOR(F.col(f"{b}.sketch")[0])))
    return (100 * F.least(n1, n2) >= SIMILARITY * F.greatest(n1, n2)) & ((100 + SIMILARITY) * apart <= (100 - SIMILARITY) * (n1 + n2))


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The linked ones of pairs(a, b), on whole texts."""
    spark = docs.sparkSession
    need = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    ids = materialize(classes.join(need, "cid", "left_semi").select("cid", F.col("doc_id").alias("d"), "h"), "ids")

    def own(batches):  # rows that share an id and a hash: only the text that makes the class is its text
        for b in batches:
            ok = [class_id(s) == c if len(s := shingle_set(t)) else False for c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield b.filter(pa.array(ok, pa.bool_()))

    found = docs.join(small_side(ids), docs["doc_id"].eqNullSafe(ids["d"]) & (F.xxhash64(docs["text"]) == ids["h"])).select("cid", "text").mapInArrow(own, "cid long, text string")
    texts = materialize(found.dropDuplicates(["cid"]), "texts")
    load = materialize(pairs.groupBy("a").agg(F.count("*").alias("m")).select("a", F.ceil(F.col("m") / SALT_MEMBERS).cast("int").alias("salts")), "load")
    lead = load.join(texts, load["a"] == texts["cid"]).select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "text")
    salted = pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b")
    member = salted.join(texts, salted["b"] == texts["cid"]).select("a", "salt", "b", "text")

    def compare(batches):
        key, leader = None, None
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for a, salt, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "b", "text")), strict=True):
                s = shingle_set(text)
                if b is None:
                    key, leader = (a, salt), s
                elif key == (a, salt) and similar(leader, s):
                    out[0].append(a)
                    out[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])

    rows = lead.unionByName(member).repartition(n_shuffle(spark), "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return materialize(rows.mapInArrow(compare, "a long, b long"), "links")


def classes_of(described: DataFrame) -> DataFrame:
    """One row of each class."""
    first = described.where("n > 0").groupBy("cid").agg(F.min("row").alias("row"))
    return materialize(described.join(small_side(materialize(first.select("row"), "reps")), "row", "left_semi").select("cid", "doc_id", "h", "n", "sketch", "places", "prefix"), "classes")


def class_links(docs: DataFrame, described: DataFrame) -> DataFrame:
    """a, b: every linked pair of classes once, those inside groups too; the cost follows the candidate pairs."""
    reps = classes_of(described)
    place = reps.select("cid", "n", "sketch", F.explode("prefix").alias("token"))
    x, y = place.alias("x"), place.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.cid") < F.col("y.cid")) & may_link("x", "y"))
    return verify(materialize(pairs.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).distinct(), "candidates"), reps, docs)


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_links: with how many other rows a row links, rows of an equal set included."""
    arrow_rows(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    described = describe(docs)
    links = class_links(docs, described)
    sizes = materialize(described.where("n > 0").groupBy("cid").agg(F.count("*").alias("rows")), "sizes")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sizes, F.col("b") == F.col("cid")).groupBy(F.col("a").alias("cid")).agg(F.sum("rows").alias("others"))
    counts = sizes.join(others, "cid", "left").select("cid", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return described.select("doc_id", "cid").join(counts, "cid", "left").select("doc_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def link_classes(docs: DataFrame, described: DataFrame) -> DataFrame:
    """node, comp over class ids that link with another class."""
    spark = docs.sparkSession
    reps = classes_of(described)
    facts = reps.select("cid", "n", "sketch")
    place = reps.select("cid", "n", F.posexplode("prefix").alias("pos", "token")).select("cid", "token", F.shiftleft("n", 32).bitwiseOR(F.col("pos").cast("long")).alias("at"))
    tokens = place.repartition(n_shuffle(spark), "token")  # one shuffle for the count and the join
    # top is always positive: it makes both readers take the same columns, so that the shuffle is reused
    least = tokens.groupBy("token").agg(F.min("cid").alias("least"), F.count("*").alias("k"), F.max("at").alias("top")).where("k > 1 and top >= 0").select("token", "least")
    lists = materialize(tokens.join(least, "token"), "lists")

    def bounded(pairs: DataFrame) -> DataFrame:
        one, two = facts.alias("x"), facts.alias("y")
        return pairs.join(one, F.col("a") == F.col("x.cid")).join(two, F.col("b") == F.col("y.cid")).where(may_link("x", "y")).select("a", "b")

    stars = materialize(bounded(lists.where("cid <> least").select(F.col("least").alias("a"), F.col("cid").alias("b")).distinct()), "stars")
    near = verify(stars, reps, docs)
    groups = connect(near)
    # the matrix: tokens with several groups, each with the sketch of its union, its sizes and what is left after the token
    rows = lists.select("token", "cid", F.shiftright("at", 32).alias("n"), (F.shiftright("at", 32) - F.col("at").bitwiseAND(F.lit((1 << 32) - 1))).alias("rest"))
    rows = rows.join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    several = rows.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 < c2").select("token")
    several = materialize(several, "several")
    query = materialize(rows.join(several, "token", "left_semi"), "query")
    cells = materialize(query.groupBy("token", F.col("comp").alias("group")).agg(F.count("*").alias("members"), F.min("cid").alias("one"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("rest").alias("most")), "cells")
    fits = (F.col("x.comp") < F.col("y.group")) & (100 * F.col("x.n") >= SIMILARITY * F.col("y.lo")) & (100 * F.col("y.hi") >= SIMILARITY * F.col("x.n"))
    # at the first token that two sets share, what is left of each bounds their overlap, as do the places of the union
    most = lambda *others: (100 + SIMILARITY) * F.least("x.rest", "y.most", *others) >= SIMILARITY * (F.col("x.n") + F.col("y.lo"))
    # a group with one member under a token is asked for that member there: sketches bound the pair itself
    sketch = reps.select("cid", "sketch")
    lone = cells.where("members = 1").join(sketch.withColumnRenamed("cid", "one"), "one").withColumn("n", F.col("lo"))
    pairs = query.join(sketch, "cid").alias("x").join(lone.alias("y"), (F.col("x.token") == F.col("y.token")) & fits & most() & may_link("x", "y"))
    pairs = pairs.select(F.least("x.cid", "y.one").alias("a"), F.greatest("x.cid", "y.one").alias("b")).distinct()
    # of the others the union is bounded first, and the members of those that qualify are compared
    wide = cells.where("members > 1")
    places = reps.select("cid", "places")
    members = query.join(wide.select(F.col("group").alias("comp")).distinct(), "comp", "left_semi").select(F.col("cid").alias("b"), F.col("comp").alias("group")).distinct()
    union = members.join(places, F.col("b") == F.col("cid")).groupBy("group").agg(F.array(*(F.bit_or(F.col("places")[k]) for k in range(SKETCH))).alias("union"))
    matrix = wide.join(union, "group")
    outside = sum((F.bit_count(F.col("x.places")[k].bitwiseAND(F.bitwise_not(F.col("y.union")[k]))) for k in range(1, SKETCH)), F.bit_count(F.col("x.places")[0].bitwiseAND(F.bitwise_not(F.col("y.union")[0]))))
    asking = query.join(wide.select("token").distinct(), "token", "left_semi").join(places, "cid")
    opened = asking.alias("x").join(matrix.alias("y"), (F.col("x.token") == F.col("y.token")) & fits & most(F.col("x.n") - outside)).select("x.cid", "y.group").distinct()
    inside = opened.join(facts.alias("x"), "cid").join(members.join(facts.withColumnRenamed("cid", "b"), "b").alias("y"), "group").where(may_link("x", "y"))
    asked = pairs.unionByName(inside.select(F.least("x.cid", "y.b").alias("a"), F.greatest("x.cid", "y.b").alias("b"))).distinct()
    rest = materialize(asked.join(stars, ["a", "b"], "left_anti"), "rest")
    more = verify(rest, reps, docs)
    return connect(near.unionByName(more))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, comp (the component's least class, null without words), row."""
    arrow_rows(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    described = describe(docs)
    comps = link_classes(docs, described)
    least = described.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least"))
    named = materialize(least.join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "named")
    whole = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_class = named.join(whole, "comp").select("cid", "component_id", "comp")
    out = described.select("doc_id", "h", "n", "cid").join(by_class, "cid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "comp", "h")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, less all but one of each component.

    The row of the least id stays (null ids last, then the least text hash); rows without words stay."""
    found = jaccard_components(docs, id_col, text_col).where("comp is not null").select("comp", F.struct(F.col("doc_id").alias("id"), "h").alias("key"))
    found = materialize(found, "found")
    first = F.min(F.struct(F.col("key.id").isNull().alias("last"), F.col("key.id").alias("id"), F.col("key.h").alias("h")))
    best = materialize(found.groupBy("comp").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1").select("comp", F.struct("first.id", "first.h").alias("best")), "best")
    rows = found.join(small_side(best), "comp").select("key", F.col("key").eqNullSafe(F.col("best")).alias("kept"))
    return keep_one_row(docs, F.struct(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)).alias("h")), rows)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("comp", "h")


OP10_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') t from w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) u(i) where len(w) > 0),
n as (select doc_id, count(*) n from s group by doc_id),
sets as (select doc_id, md5(string_agg(t, chr(10) order by t)) k from s group by doc_id),
reps as (select k, min(doc_id) r from sets group by k),
rs as (select s.* from s join reps on reps.r = s.doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) c from rs a join rs b on a.t = b.t and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
ee as (select a, b from e union select b, a from e),
reach as (select r a, r b from reps union select reach.a, ee.b from reach join ee on reach.b = ee.a),
comp as (select a, min(b) m from reach group by a)
select w.doc_id, coalesce(n.n, 0)::bigint n_shingles, coalesce(comp.m, w.doc_id) component_id
from w left join n using (doc_id) left join sets using (doc_id) left join reps using (k) left join comp on comp.a = reps.r
"""
