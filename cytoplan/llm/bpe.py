r"""Byte-level BPE encoding and decoding over a minimal acyclic transducer lexicon.

``count_words`` counts pre-tokens over all texts, ``build_lexicon`` compiles the most frequent
into a minimal acyclic automaton whose suffixes are shared; the ids are outputs: a word's rank
among all accepted words is the sum of the numbers on its path, and points into one id table.
The automaton is a flat array file that workers map into memory. A word outside the lexicon is
merged exactly, so the size of the lexicon (``LEXICON_WORDS``) never changes a result.

Special tokens in a text become their ids, as the vocabulary file says; decoding concatenates
the bytes of the ids. Null and empty texts have no ids (the digest is that of the empty
string). Texts are split as pre-tokens whole, however long. Repeated rows repeat.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re as stdre
import tempfile
from array import array
from collections import Counter
from collections.abc import Iterable
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SharedFiles, arrow_rows, give_back, local_path, new_dir, table

#: Most words that the lexicon holds; the rest are merged as they come.
LEXICON_WORDS = 300_000
#: Words of a lexicon are at most so many bytes.
LEXICON_BYTES = 48
#: Distinct words counted before a task hands its counts on.
COUNT_WORDS = 200_000
#: Bytes of words and ids that a task remembers, in each of two generations; of a word that it remembers, at most; and what a word takes beside its characters.
CACHE_BYTES, CACHED_WORD, WORD_BYTES = 24 << 20, 256, 200
#: Splits a text as the byte-level vocabulary does (fixed values: white space as its matcher has it).
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Texts without code points from here on are split by the plainer and faster of two equal matchers.
WIDE = 0x250


def _matcher(low: bool):
    """findall of PATTERN, with the classes listed character by character if low."""
    if not low:
        return regex.compile(PATTERN.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}").replace("{S}", SPACE)).findall
    listed = lambda c: "".join(stdre.escape(x) for x in map(chr, range(WIDE)) if regex.match(f"[{c}]", x))
    return stdre.compile(PATTERN.replace("{L}", listed(r"\p{L}")).replace("{N}", listed(r"\p{N}")).replace("{S}", listed(SPACE))).findall


def byte_names() -> list[str]:
    """The printable character by which the vocabulary file names each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    names, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in names:
            names[b], free = chr(free), free + 1
    return [names[b] for b in range(256)]


#: Ids take so many bits in packed pairs.
BITS = 20
MASK, NONE = (1 << BITS) - 1, 1 << 60


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = {c: b for b, c in enumerate(byte_names())}
        raw = lambda s: bytes(of[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        #: (left id, right id) -> (rank, id) of the merged token, each pair packed in a number
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = raw(a), raw(b)
            self.merges.setdefault(self.ids[left] << BITS | self.ids[right], rank << BITS | self.ids[left + right])
        self.byte_ids = [self.ids[bytes([i])] for i in range(256)]
        #: where the ids of single bytes are bytes themselves, a word becomes them in one call
        self.one_byte = bytes(self.byte_ids) if max(self.byte_ids) < 256 else None
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.cut = stdre.compile("(" + "|".join(map(stdre.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.low, self.any, self.wide = _matcher(True), _matcher(False), stdre.compile(f"[^\0-{chr(WIDE - 1)}]").search

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the pair of the lowest rank, leftmost first."""
        if len(word) > 64:
            return self._merge_long(word)
        merged = self.merges.get
        parts = list(word.translate(self.one_byte)) if self.one_byte else [self.byte_ids[c] for c in word]
        pairs = [merged(a << BITS | b, NONE) for a, b in pairwise(parts)]
        while pairs and (low := min(pairs)) != NONE:
            i = pairs.index(low)
            parts[i] = token = low & MASK
            del parts[i + 1], pairs[i]
            if i:
                pairs[i - 1] = merged(parts[i - 1] << BITS | token, NONE)
            if i < len(pairs):
                pairs[i] = merged(token << BITS | parts[i + 1], NONE)
        return parts

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for long words in n log n: pairs wait in a heap, parts in a linked list."""
        parts = [self.byte_ids[c] for c in word]
        n, merged = len(parts), self.merges.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(v, i, parts[i], parts[i + 1]) for i in range(n - 1) if (v := merged(parts[i] << BITS | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            v, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = v & MASK, -1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
            for x, y in ((left[i], i), (i, k)):
                if x >= 0 and y >= 0 and (v := merged(parts[x] << BITS | parts[y])) is not None:
                    heapq.heappush(heap, (v, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def words(self, text: str) -> list[str]:
        return self.low(text) if text.isascii() or self.wide(text) is None else self.any(text)

    def sections(self, text: str):
        """(special id or None, pre-tokens) in order."""
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                yield self.special[part], ()
            elif part:
                yield None, self.words(part)


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton of sorted words, suffixes shared, as one flat file.

    Finished nodes are numbers, children before parents; only the path of the last word is open."""
    register: dict[bytes, int] = {}  # final and edges of a node -> its number
    final, accepted, edge, target, skipped = array("i"), array("i"), array("i"), array("i"), array("i")
    path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]
    last = b""

    def close() -> int:
        (is_final,), edges = path.pop()
        sign = array("i", [is_final, *chain.from_iterable(edges)]).tobytes()
        if sign not in register:
            n = register[sign] = len(final)
            passed = int(is_final)
            for byte, child in edges:
                edge.append(256 * n + byte)
                target.append(child)
                skipped.append(passed)
                passed += accepted[child]
            final.append(is_final)
            accepted.append(passed)
        return register[sign]

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            byte = last[len(path) - 2]
            path[-2][1].append((byte, close()))

    order = sorted(words)
    for word in order:
        freeze(next((i for i, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word))))
        while len(path) <= len(word):
            path.append(([False], []))
        path[-1][0][0] = True
        last = word
    freeze(0)
    root = close()
    start = np.zeros(len(order) + 1, np.int32)
    start[1:] = np.cumsum([len(words[w]) for w in order])
    flat = np.array([i for w in order for i in words[w]], np.int32)
    arrays = [final, edge, target, skipped, start, flat]
    head = np.array([root, *(len(a) for a in arrays)], np.int32)
    return b"".join(a.tobytes() for a in [head, *arrays])


class Lexicon:
    """Lookups in a compiled automaton, mapped from a file or held in a buffer."""

    def __init__(self, buffer):
        head = np.frombuffer(buffer, np.int32, 7)
        arrays, at = [], 28
        for n in head[1:]:
            arrays.append(np.frombuffer(buffer, np.int32, int(n), at))
            at += 4 * int(n)
        self.root = int(head[0])
        self.final, self.edge, self.target, self.skipped, self.start, self.ids = arrays

    @classmethod
    def map(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, words: list[bytes]) -> list[list[int] | None]:
        """All words step through the automaton together, a byte at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(size) - size
        node, rank, alive = np.full(len(words), self.root), np.zeros(len(words), np.int64), np.arange(len(words))
        if not len(self.edge):
            return [None] * len(words)
        out: list[list[int] | None] = [None] * len(words)
        for j in range(int(size.max(initial=0)) + 1):
            done = alive[size[alive] == j]
            for w in done[self.final[node[done]] == 1].tolist():
                r = int(rank[w])
                out[w] = self.ids[self.start[r] : self.start[r + 1]].tolist()
            alive = alive[size[alive] > j]
            key = node[alive] * 256 + flat[begin[alive] + j]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            ok = self.edge[at] == key
            alive, at = alive[ok], at[ok]
            node[alive] = self.target[at]
            rank[alive] += self.skipped[at]
            if not len(alive):
                break
        return out


class Words(dict):
    """word -> its ids, written out; remembers words in two generations of bounded bytes: the older one is
    forgotten, but for words met again, when the younger one is full."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size, self.old = limit, 0, {}

    def missing(self, words: set[str]) -> list[str]:
        """Which words are in neither generation; those of the older one come back."""
        new = words - self.keys()
        for w in new & self.old.keys():
            self.put(w, self.old[w])
        return list(new - self.old.keys())

    def put(self, word: str, ids: str) -> None:
        self[word] = ids
        self.size += len(word) + len(ids) + WORD_BYTES

    def forget(self, words: Iterable[str]) -> None:
        for w in words:
            self.size -= len(w) + len(self.pop(w)) + WORD_BYTES

    def age(self) -> None:
        if self.size > self.limit:
            self.old = dict(self)
            self.clear()
            self.size = 0


class Encoder:
    """Texts to ids by the lexicon, and by merging words that it lacks; remembers a bounded number of bytes.

    A resolved word's ids are spelt at once: where they decode to its own bytes, a text's decoding has those; the others are kept apart."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.names = {i: str(i) for i in vocabulary.bytes}
        self.ids = Words()
        self.odd: dict[str, bytes] = {}

    def _resolve(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        found = self.lexicon.get([r if len(r) <= LEXICON_BYTES else b"" for r in raw]) if self.lexicon else [None] * len(raw)
        merge, name, spelt, put = self.vocabulary.merge, self.names.__getitem__, self.vocabulary.bytes.__getitem__, self.ids.put
        for w, r, ids in zip(words, raw, found, strict=True):
            if ids is None:
                ids = merge(r)
            put(w, ",".join(map(name, ids)))
            if (back := b"".join(map(spelt, ids))) != r:
                self.odd[w] = back

    def encode(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Ids joined by commas, and the bytes that they decode to."""
        cut = [list(self.vocabulary.sections(t)) for t in texts]
        here = set().union(*(words for sections in cut for _, words in sections))
        self._resolve(self.ids.missing(here))
        ids, out = self.ids.__getitem__, []
        for text, sections in zip(texts, cut, strict=True):
            parts = [self.names[special] if special is not None else ",".join(map(ids, words)) for special, words in sections]
            raw = b"".join(self.vocabulary.bytes[special] if special is not None else b"".join(self.odd.get(w) or w.encode() for w in words) for special, words in sections) if self.odd else text.encode()
            out.append((parts[0] if len(parts) == 1 else ",".join(parts), raw))
        self.ids.forget({*self.odd, *(w for w in here if len(w) > CACHED_WORD)})
        self.odd = {}
        self.ids.age()
        return out


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    return b"".join(map(vocabulary.bytes.__getitem__, ids)).decode("utf-8", errors="replace")


def count_words(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """word, n over all texts; a task hands its counts on before they outgrow its memory."""

    def count(batches):
        voc, seen = Vocabulary(path), Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()

        for b in batches:
            for text in b.column(0).to_pylist():
                for special, words in voc.sections(text or ""):
                    if special is None:
                        seen.update(words)
            if len(seen) >= COUNT_WORDS:
                yield from out()
        yield from out()

    counted = docs.select(text_col).mapInArrow(count, "word string, n long")
    return counted.where(F.octet_length("word") <= LEXICON_BYTES).groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON_WORDS) -> bytes:
    """The compiled automaton of the most frequent words of docs: at most size words reach the driver."""
    top = count_words(docs, path, text_col).where("n > 1").orderBy(F.col("n").desc(), "word").limit(size).select("word").toArrow()
    voc = Vocabulary(path)
    blob = compile_lexicon({w: voc.merge(w) for w in (x.encode() for x in top.column(0).to_pylist())})
    del voc, top
    give_back()
    return blob


def publish_lexicon(spark: SparkSession, blob: bytes):
    """How workers get the automaton: a file of the shared folder, else a broadcast of the same bytes."""
    base = new_dir(spark, "lexicon")
    SharedFiles(base).create("lexicon.bin", lambda out: out.write(blob))
    if local_path(base):
        return f"{local_path(base)}/lexicon.bin", None
    return None, spark.sparkContext.broadcast(blob)


def open_lexicon(shared: str | None, sent) -> Lexicon:
    if shared:
        return Lexicon.map(shared)
    f = tempfile.TemporaryFile()
    f.write(sent.value)
    f.flush()
    return Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = LEXICON_WORDS, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids."""
    spark = docs.sparkSession
    arrow_rows(spark)
    shared, sent = publish_lexicon(spark, build_lexicon(docs, path, text_col, size))
    types = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))]
    schema = pa.schema(types if with_ids else types[:4])

    def encode(batches):
        enc = Encoder(Vocabulary(path), open_lexicon(shared, sent))  # a task's own, gone with it
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for ids, raw in enc.encode([t or "" for t in b.column(1).to_pylist()]):
                cols[0].append(ids.count(",") + 1 if ids else 0)
                cols[1].append(hashlib.sha256(ids.encode()).hexdigest())
                cols[2].append(hashlib.sha256(raw.decode("utf-8", errors="replace").encode("utf-8")).hexdigest())
                cols[3].append(list(map(int, ids.split(","))) if with_ids and ids else [])
            arrays = [b.column(0).cast(pa.int64()), *(pa.array(c, t) for c, (_, t) in zip(cols, types[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(arrays[: len(schema)], schema=schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(id_col, text_col).mapInArrow(encode, ddl)


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_vocabulary())
