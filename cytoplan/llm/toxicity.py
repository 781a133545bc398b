"""Toxicity by compression distance.

Zstandard dictionaries are trained on ordinary and on toxic text, of equal size and by the same rule: the windows
that most rows of the class repeat, the most frequent first, down to ``FLOOR`` rows, and the trainer's pick of
long runs without white space, which have dictionaries of their own. A window is a word with the spaces around it
(of a run without white space over ``PIECE`` bytes, pieces that overlap by half) or two adjacent words; of
the latter, those that a class's dictionary was trained on, for others are in neither. Both dictionaries compress every
window of a text. The bytes that the toxic one saves, or costs, against the ordinary one are its distance, and
counts of windows past thresholds, of bytes and of the share saved, go through a logistic model calibrated on rows
that the toxic dictionary did not see; a score is the mean of the judges of all folds. Both dictionaries end in the same
content, trained on ordinary text, so that everyday words cost the same in both.

Labels are learned from at most ``FIT_ROWS`` labelled rows a class, taken by a hash of the id; all windows of their whole
texts count. Class shares come from all labelled rows. Scores use the text alone.

Defined cases: null and empty texts have no windows and get the model's score for that; an empty table gives no rows;
a null id counts as the empty string for the hold-out rule; a fold without both classes has no judge, and without
any judge every score is the share of toxic labels (0 without labels); repeated rows repeat; several labels of one id: toxic if
any is; ties between equally frequent windows go by their bytes; extra columns are ignored, or kept by ``drop_toxic`` whatever
their names. Long texts are scored whole; a task holds one batch of texts and a bounded number of windows.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, free_name, give_back, table

#: Labelled rows of each class that the classifier is fitted on.
FIT_ROWS = 3000
#: Bytes of the content that both dictionaries share, of a class's own words, pairs of words, and of what is trained on long runs.
BASE_BYTES, WORD_BYTES, PAIR_BYTES, RUN_BYTES = 6144, 16384, 16384, 32768
#: Rows of a class that repeat a window that its dictionary is trained on.
FLOOR = 5
THRESHOLD = 0.3
#: Parts of the labelled rows; each is judged by dictionaries of the others.
FOLDS = 3
#: Thresholds of a window's distance in bytes, either way, and of the share of its bytes that is saved.
STEPS, SHARES = (2, 3, 4, 5, 6, 8, 10), (0.3, 0.5, 0.7, 0.9)
#: Tokens and windows that a task remembers, or as many as one batch has; of more, those of the last batch stay.
CACHE_WINDOWS = 100_000
#: Most bytes of a window of one word; longer runs are pieces.
PIECE = 64
TRIM = b".,!?;:\"'()|*#%"
#: The compressor looks for no match in a block's last bytes, so a window ends in a run that costs the same in both.
PAD = b"\x00" * 24


def tokens(text: str) -> list[bytes]:
    """Runs without white space; of long ones, pieces that overlap by half."""
    out = text.lower().encode("utf-8", "replace").split()
    if out and len(max(out, key=len)) > PIECE:
        half = PIECE // 2
        out = [w[i : i + PIECE] for w in out for i in range(0, max(1, len(w) - half), half)]
    return out


def window(token: bytes) -> bytes:
    return b" " + token.strip(TRIM) + b" "


def is_run(w: bytes) -> bool:
    """Whether a window goes by the dictionaries of long runs."""
    return len(w) > PIECE // 2 + 2


def windows(text: str) -> list[bytes]:
    return list(map(window, tokens(text)))


def _trained(samples: list[bytes], size: int, k: int = 64, d: int = 8) -> bytes:
    """Dictionary content that the trainer picks; too few samples are their own content."""
    try:
        content = zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
        return content[-int(size * 0.9) :]  # without the coding tables, which differ between dictionaries
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    bits = max(14, len(content).bit_length())  # tables that keep every place of the content
    params = zstandard.ZstdCompressionParameters(window_log=max(17, bits + 1), hash_log=bits, chain_log=bits, search_log=4, min_match=5, target_length=16, strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
    # raw content needs 8 bytes
    return zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT))


class Rows:
    """Training texts as arrays of numbers of their windows."""

    def __init__(self, texts: list[str]):
        self.ids: dict[bytes, int] = {}
        self.cut = [np.array([self.ids.setdefault(w, len(self.ids)) for w in windows(t)], np.int64) for t in texts]
        self.names = list(self.ids)

    def _repeated(self, parts: list[np.ndarray], spelt, size: int) -> dict:
        """What at least FLOOR of parts hold, most often first, with its bytes, up to size bytes of content."""
        found, n = np.unique(np.concatenate([*map(np.unique, parts), np.empty(0, np.int64)]), return_counts=True)
        found, n = found[n >= FLOOR], n[n >= FLOOR]
        order = np.argsort(-n, kind="stable")
        order = order[: size // 2]  # a window brings two bytes at least, so no more than these are looked at
        out, content = {}, bytearray()
        for _, w, f in sorted((-int(n[i]), spelt(int(found[i])), int(found[i])) for i in order):
            if len(content) >= size:
                break
            if len(w) > 4 and w.strip() not in content:
                content += w[1:]
                out[f] = w
        return out

    def words(self, rows: list[int]) -> bytes:
        """A class's own dictionary content of words."""
        return b"".join(w[1:] for w in self._repeated([self.cut[i] for i in rows], self.names.__getitem__, WORD_BYTES).values())

    def runs(self, rows: list[int]) -> bytes:
        """And that of long runs without white space."""
        long = [b"".join(p) for i in rows if (p := [w for w in map(self.names.__getitem__, self.cut[i]) if is_run(w)])]
        return _trained(long, RUN_BYTES, 16, 8) if long else b""

    def pairs(self, rows: list[int]) -> dict[tuple[bytes, bytes], bytes]:
        """And its pairs of adjacent words with their bytes."""
        name = self.names.__getitem__
        found = self._repeated([self.cut[i][:-1] << 32 | self.cut[i][1:] for i in rows], lambda p: name(p >> 32) + name(p & 0xFFFFFFFF)[1:], PAIR_BYTES)
        return {(name(p >> 32), name(p & 0xFFFFFFFF)): w for p, w in found.items()}

    def base(self, rows: list[int]) -> bytes:
        """Trained on all windows of ordinary rows, a row a sample."""
        return _trained([b"".join(map(self.names.__getitem__, self.cut[i])) for i in rows], BASE_BYTES, 64, 8) if rows else b""


#: A window's code: its step each way and its step of the share.
CODES = (len(STEPS) + 1) ** 2 * (len(SHARES) + 1)


def step_codes(ordinary: np.ndarray, toxic: np.ndarray, least: int) -> np.ndarray:
    """Codes of windows by their compressed sizes; least is the size of no window."""
    saved = ordinary - toxic
    share = np.where(saved >= STEPS[0], saved / np.maximum(1, ordinary - least - 2), 0.0)
    up, down = np.searchsorted(STEPS, saved, side="right"), np.searchsorted(STEPS, -saved, side="right")
    return (up * (len(STEPS) + 1) + down) * (len(SHARES) + 1) + np.searchsorted(SHARES, share, side="right")


def _past() -> np.ndarray:
    """Which thresholds a code is past."""
    up, rest = np.divmod(np.arange(CODES), (len(STEPS) + 1) * (len(SHARES) + 1))
    down, share = np.divmod(rest, len(SHARES) + 1)
    level = lambda v, n: v[:, None] >= np.arange(1, n + 1)[None]
    return np.concatenate([level(up, len(STEPS)), level(down, len(STEPS)), level(share, len(SHARES))], axis=1).astype(float)


PAST = _past()


def features(counts: np.ndarray, n_words: int) -> np.ndarray:
    """A row for each judge of counts[judge, words or pairs, code]."""
    past = counts @ PAST
    few = past[:, :, :4] / max(1, n_words)
    return np.concatenate([np.log1p(past).reshape(len(past), -1), np.sqrt(few).reshape(len(past), -1), np.full((len(past), 1), math.log(max(1, n_words)))], axis=1)


@dataclass
class Dictionaries:
    """Content of an ordinary and a toxic dictionary of words, the same of pairs of words and of long runs."""

    words: tuple[bytes, bytes]
    pairs: tuple[bytes, bytes]
    runs: tuple[bytes, bytes]


class Distances:
    """Distances of windows for each two dictionaries: words as they come, pairs once."""

    def __init__(self, trained: list[Dictionaries], known: dict[tuple[bytes, bytes], bytes]):
        self.words, self.runs = ([getattr(d, kind) for d in trained] for kind in ("words", "runs"))
        self.compressors = {c: compressor(c) for two in self.words + self.runs for c in two}
        self.least = len(compressor(b"").compress(PAD))
        self.judges = len(trained)
        self.shift = 2 * CODES * np.arange(self.judges)  # where a judge's codes begin
        names = sorted(set(chain.from_iterable(known)))
        self.code = {w: i + 1 for i, w in enumerate(names)}
        self.width = len(names) + 1
        coded = np.array([self.code[v] * self.width + self.code[w] for v, w in known], np.int64)
        order = np.argsort(coded)
        self.pairs, spelt = coded[order], list(known.values())
        self.pair_codes = self._codes([d.pairs for d in trained], [spelt[i] for i in order]) + CODES + self.shift
        self.tokens: dict[bytes, int] = {}
        self.windows: dict[bytes, int] = {}  # numbered as they come
        self.steps = np.zeros((1024, self.judges), np.int64)
        self.names = np.zeros(1024, np.int64)

    def _forget_others(self, kept: set[bytes]) -> None:
        """Of what is remembered, only these tokens and their windows stay."""
        at = np.fromiter(map(self.tokens.__getitem__, kept), np.int64, len(kept))
        rows, at = np.unique(at, return_inverse=True)
        spelt = list(self.windows)
        self.windows = {spelt[r]: i for i, r in enumerate(rows.tolist())}
        self.tokens = dict(zip(kept, at.tolist(), strict=True))
        self.steps, self.names = self.steps[rows], self.names[rows]

    def _codes(self, trained: list[tuple[bytes, bytes]], made: list[bytes]) -> np.ndarray:
        """By window and judge; what several judges share is compressed once."""
        padded = [w + PAD for w in made]
        sizes = {}
        for content in {c for two in trained for c in two}:
            compress = (self.compressors.get(content) or compressor(content)).compress
            sizes[content] = np.fromiter(map(len, map(compress, padded)), np.int64, len(padded))
        return np.array([step_codes(sizes[a], sizes[b], self.least) for a, b in trained], np.int32).reshape(len(trained), len(made)).T

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, its features by judge."""
        cut = [tokens(t) for t in texts]
        here = set().union(*cut)
        new = list(here - self.tokens.keys())
        if len(self.tokens) + len(new) > CACHE_WINDOWS:
            self._forget_others(here.difference(new))
        made = list(map(window, new))
        fresh = set(made) - self.windows.keys()
        if fresh:
            runs = list(filter(is_run, fresh))
            fresh = [*fresh.difference(runs), *runs]
            at = len(self.windows)
            if (more := at + len(fresh) - len(self.steps)) > 0:
                more = max(more, len(self.steps))
                self.steps = np.concatenate([self.steps, np.zeros((more, self.judges), np.int64)])
                self.names = np.concatenate([self.names, np.zeros(more, np.int64)])
            short = len(fresh) - len(runs)
            self.steps[at : at + short] = self._codes(self.words, fresh[:short]) + self.shift
            self.steps[at + short : at + len(fresh)] = self._codes(self.runs, fresh[short:]) + self.shift
            self.names[at : at + len(fresh)] = [self.code.get(w, 0) for w in fresh]
            self.windows.update(zip(fresh, range(at, at + len(fresh)), strict=True))
        self.tokens.update(zip(new, map(self.windows.__getitem__, made), strict=True))
        get = self.tokens.__getitem__
        out = []
        for t in cut:
            at = np.fromiter(map(get, t), np.int64, len(t))
            codes = [self.steps.take(at, 0).ravel()]
            v = self.names.take(at)
            first = np.flatnonzero((v[:-1] > 0) & (v[1:] > 0))
            p = v[first] * self.width + v[first + 1]
            if len(p) and len(self.pairs):
                j = np.minimum(np.searchsorted(self.pairs, p), len(self.pairs) - 1)
                codes.append(self.pair_codes[j[self.pairs[j] == p]].ravel())
            counts = np.bincount(np.concatenate(codes), minlength=2 * CODES * self.judges).reshape(self.judges, 2, CODES)
            out.append(features(counts, len(t)))
        return out


@dataclass
class Judge:
    """Dictionaries with the logistic model of their distances."""

    trained: Dictionaries
    low: np.ndarray  # features beyond what was calibrated count as its ends
    high: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, x: np.ndarray) -> float:
        z = (np.clip(x, self.low, self.high) - self.mean) / self.scale
        return float(z @ self.weights[:-1] + self.weights[-1])


@dataclass
class Model:
    known: dict[tuple[bytes, bytes], bytes]
    judges: list[Judge]
    share: float

    def distances(self) -> Distances:
        return Distances([j.trained for j in self.judges], self.known)

    def scores(self, texts: list[str], distances: Distances | None = None) -> list[float]:
        if not self.judges:
            return [self.share] * len(texts)
        distances = distances or self.distances()
        out = []
        for x in distances.of(texts):
            v = sum(j.logit(x[k]) for k, j in enumerate(self.judges)) / len(self.judges)
            out.append(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, v)))))
        return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(z.shape[1]), 0.05 * np.eye(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z.T * (weight * p * (1 - p) + 1e-9)) @ z + ridge, z.T @ (weight * (y - p)) - ridge @ w)
    return mean, scale, w


def fit(texts: list[str], toxic: list[int], counts: tuple[int, int]) -> Model:
    """counts: ordinary and toxic labels of all rows that may be learned from."""
    share = counts[1] / max(1, sum(counts))
    folds = np.array([zlib.crc32(x.encode("utf-8", "replace")) % FOLDS for x in texts])
    y, rows = np.array(toxic, int), Rows(texts)
    ordinary = [i for i in range(len(y)) if not y[i]]
    base = rows.base(ordinary)
    words = rows.words(ordinary) + base
    judges, parts, known = [], [], {}
    for k in range(FOLDS):  # a judge is calibrated on the fold that its toxic dictionary has not seen
        seen, new = np.flatnonzero(folds != k), np.flatnonzero(folds == k)
        if len(set(y[seen])) < 2 or len(set(y[new])) < 2:
            continue
        own = [[i for i in seen if y[i] == t] for t in (0, 1)]
        pairs = [rows.pairs(o) for o in own]
        spelt = tuple(b"".join(w[1:] for w in p.values()) + base for p in pairs)
        parts.append((new, Dictionaries((words, rows.words(own[1]) + base), spelt, tuple(rows.runs(o) + base for o in own))))
        known |= pairs[0] | pairs[1]
    for new, trained in parts:
        x = np.concatenate(Distances([trained], known).of([texts[i] for i in new]))
        n = np.bincount(y[new], minlength=2)
        weight = np.where(y[new] == 1, counts[1] / n[1], counts[0] / n[0])
        judges.append(Judge(trained, x.min(0), x.max(0), *_logistic(x, y[new].astype(float), weight * len(new) / weight.sum())))
    return Model(known, judges, share)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit_from_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Only rows outside the hold-out are learned from; a bounded number of texts reaches the driver."""
    truth = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in truth.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    by_hash = truth.withColumn("h", F.xxhash64("id"))
    chosen = None
    for t in (0, 1):
        part = by_hash.where(F.col("toxic") == t).orderBy("h", "id").limit(FIT_ROWS).select("id", "toxic")
        chosen = part if chosen is None else chosen.unionByName(part)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # repeated ids may bring several texts; the bound on rows holds for those too
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id", "text"), "text").limit(2 * FIT_ROWS).collect()
    texts, toxic = [r["text"] for r in rows], [r["toxic"] for r in rows]
    del rows
    model = fit(texts, toxic, (sizes.get(0, 0), sizes.get(1, 0)))
    del texts
    give_back()
    return model


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with a column of scores: every window of every text."""
    arrow_rows(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def score(batches):
        model = sent.value
        distances = model.distances()
        for b in batches:
            scores = pa.array(model.scores([t or "" for t in b.column(at).to_pylist()], distances), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*b.schema.names, score_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(score, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = fit_from_labels(docs, labels, id_col, text_col)
    scored = score_documents(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns."""
    model = fit_from_labels(docs, labels, id_col, text_col)
    score = free_name(docs, "score")
    return score_documents(docs, model, text_col, score).where(F.col(score) < THRESHOLD).drop(score)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
