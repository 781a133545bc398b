r"""Substring deduplication by suffix automata of reference shards.

Words are ``[^\x20\x09-\x0D]+``; a window is ``width`` consecutive words. A word goes if it is in a
window whose word sequence also starts in a document with a smaller id; windows are judged on
the input.

Sending automata of all the corpus to all documents would cost shards times documents, so the
reference is cut into shards by content: equal windows have equal minimizers (the least hash of
the word 5-grams inside), so the shard of a minimizer sees every occurrence of each of its
windows. Minimizers met in one document only are dropped by a count over all documents. What is
left of a text around a shared minimizer, a stretch, is streamed in order of document ids past
the suffix automaton of the stretches of smaller ids (those so far): matching statistics of at
least ``width`` words are the spans to remove. Words are compared, not hashes. Equal stretches
are kept once, and the windows of minimizers met more than ``HOT`` times become shards of their
own, each of one sequence, so an automaton stays small however often a passage is repeated.

Defined cases: null and empty texts have no words; rows that share an id do not remove from each
other; a null id counts as larger than all others; repeated rows give repeated results; an empty
table gives no rows; the longest text bounds a task's memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, n_shuffle, table
from .shingles import WordHashes, gram_hashes, sliding_min, words_of

WIDTH = 13
GRAM = 5
#: Occurrences from which on a minimizer's windows are shards of their own.
HOT = 2048


class SuffixAutomaton:
    """Of word sequences; extend() adds one, spans() streams another past it."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def extend(self, words: list[bytes]) -> None:
        last = 0
        nxt, link, length = self.next, self.link, self.length
        for w in words:
            if w in nxt[last]:
                q = nxt[last][w]
                last = q if length[last] + 1 == length[q] else self._clone(last, q, w)
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                link[cur] = q if length[p] + 1 == length[q] else self._clone(p, q, w)
            last = cur

    def _clone(self, p: int, q: int, w: bytes) -> int:
        nxt, link = self.next, self.link
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def spans(self, words: list[bytes], width: int) -> list[tuple[int, int]]:
        """Maximal (start, end) of words in matches of at least width."""
        out: list[tuple[int, int]] = []
        state, n = 0, 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if w in self.next[state]:
                state, n = self.next[state][w], n + 1
            else:
                n = 0
            if n >= width:
                lo = i + 1 - width
                if out and lo <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((lo, i + 1))
        return out


def minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """Of every window of one text, in order."""
    return sliding_min(gram_hashes(h, GRAM), width - GRAM + 1) if len(h) >= width else np.empty(0, np.uint64)


def _runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal values."""
    cut = np.flatnonzero(v[1:] != v[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(v)]])


def _signed(v: np.ndarray) -> np.ndarray:
    return v.view(np.int64)


def stretches(words: list[bytes], v: np.ndarray, shared: np.ndarray, hot: np.ndarray, width: int):
    """(shard, start, words joined by a space) around shared minimizers."""
    lo, hi = _runs(v)
    of = _signed(v[lo])
    for k in np.flatnonzero(np.isin(of, shared)):
        yield int(of[k]), int(lo[k]), b" ".join(words[lo[k] : hi[k] - 1 + width])
    for k in np.flatnonzero(np.isin(of, hot)):
        for i in range(int(lo[k]), int(hi[k])):
            window = b" ".join(words[i : i + width])
            yield xxhash.xxh64_intdigest(window) - (1 << 63), i, window


class Shard:
    """Stretches of one shard in order of their documents."""

    def __init__(self, width: int):
        self.width = width
        self.seen: set[bytes] = set()
        self.waiting: list[bytes] = []
        self.automaton: SuffixAutomaton | None = None
        self.rank, self.mine = None, []

    def feed(self, rank, text: bytes) -> list[tuple[int, int]]:
        """Spans of text that smaller documents have."""
        if rank != self.rank:
            for t in self.mine:
                if t not in self.seen:
                    self.seen.add(t)
                    self.waiting.append(t)
            self.rank, self.mine = rank, []
        self.mine.append(text)
        if not self.seen:
            return []
        words = text.split(b" ")
        if text in self.seen:
            return [(0, len(words))]
        if self.automaton is None:
            self.automaton = SuffixAutomaton()
        for t in self.waiting:
            self.automaton.extend(t.split(b" "))
        self.waiting = []
        return self.automaton.spans(words, self.width)


def shared_minimizers(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, shared, hot: the minimizers of a document that others have too."""

    def find(batches):
        hashes = WordHashes()
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            at, found = [], []
            for i, t in enumerate(texts):
                v = minimizers(hashes.of(words_of(t)), width)
                if len(v):
                    v = np.unique(v)
                    found.append(v)
                    at.append(np.full(len(v), i))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found))), ids.take(pa.array(np.concatenate(at)))], names=["m", "doc_id"])

    met = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, "m long, doc_id long")
    met = met.repartition(n_shuffle(docs.sparkSession), "m")  # one shuffle serves the count and the join
    rank = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    common = met.groupBy("m").agg(F.min(rank).alias("lo"), F.max(rank).alias("hi"), F.count("*").alias("n")).where("lo < hi").select("m", (F.col("n") > HOT).alias("hot"))
    pick = lambda c: F.collect_set(F.when(c, F.col("m")))
    return met.join(common, "m").groupBy("doc_id").agg(pick(~F.col("hot")).alias("shared"), pick(F.col("hot")).alias("hot"))


def repeated_spans(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, h, lo, hi: words that are in windows of smaller documents."""
    spark = docs.sparkSession
    mine = shared_minimizers(docs, width).withColumnRenamed("doc_id", "d")
    near = docs.join(mine.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(mine["d"])).select("doc_id", "text", "shared", "hot")

    def cut(batches):
        hashes = WordHashes()
        schema = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("words", pa.binary())])
        for b in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text, shared, hot in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                words = words_of(text)
                v = minimizers(hashes.of(words), width)
                if not len(v):
                    continue
                h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
                for shard, start, part in stretches(words, v, np.array(shared, np.int64), np.array(hot, np.int64), width):
                    for col, x in zip(rows, (shard, doc_id, h, start, part), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema)

    def match(batches):
        key, shard = None, None
        schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
        for b in batches:
            rows: list[list] = [[], [], [], []]
            for k, doc_id, h, start, part in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "h", "start", "words")), strict=True):
                if k != key:
                    key, shard = k, Shard(width)
                for lo, hi in shard.feed(doc_id, part):
                    for col, x in zip(rows, (doc_id, h, start + lo, start + hi), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema)

    parts = near.mapInArrow(cut, "shard long, doc_id long, h long, start int, words binary")
    ordered = parts.repartition(n_shuffle(spark), "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last())
    return ordered.mapInArrow(match, "doc_id long, h long, lo int, hi int")


def _text_key(text: str | None) -> int:
    return xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63)


def remove_repeats(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (the words that stay)."""
    spark = docs.sparkSession
    arrow_rows(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(docs, width).groupBy(F.col("doc_id").alias("d")).agg(F.collect_list(F.struct("h", "lo", "hi")).alias("spans"))
    spans = materialize(spans, "spans")
    joined = docs.join(spans.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(spans["d"]), "left").select("doc_id", "text", F.col("spans.h").alias("hs"), F.col("spans.lo").alias("los"), F.col("spans.hi").alias("his"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + ([("kept", pa.string())] if with_text else []))

    def take(batches):
        for b in batches:
            rows: list[list] = [[] for _ in schema]
            for doc_id, text, hs, los, his in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                words = words_of(text)
                total = len(words)
                if hs:
                    mine = np.array(hs, np.int64) == _text_key(text)
                    edge = np.zeros(total + 1, np.int64)
                    np.add.at(edge, np.array(los)[mine], 1)
                    np.add.at(edge, np.array(his)[mine], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:total] == 0)]
                kept = b" ".join(words)
                row = [doc_id, total, total - len(words), hashlib.sha256(kept).hexdigest()] + ([kept.decode("utf-8", "replace")] if with_text else [])
                for col, x in zip(rows, row, strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema)

    return joined.mapInArrow(take, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
g as (select doc_id, i, array_to_string(w[i : i + 12], ' ') t from w, unnest(range(1, len(w) - 11)) u(i)),
f as (select *, min(doc_id) over (partition by t) first from g),
r as (select distinct doc_id, p from f, unnest(range(i, i + 13)) u(p) where first < doc_id),
k as (select w.doc_id, len(w.w) n_words, q, w.w[q] word, r.p is not null gone from w, unnest(range(1, len(w.w) + 1)) u(q) left join r on r.doc_id = w.doc_id and r.p = q)
select w.doc_id, len(w.w)::bigint n_words, coalesce(n, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256 from w left join
  (select doc_id, count(*) filter (gone) n, string_agg(word, ' ' order by q) filter (not gone) kept from k group by doc_id) s using (doc_id)
"""
