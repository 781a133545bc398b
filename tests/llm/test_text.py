"""Substring dedup, decontamination, Jaccard, BPE, toxicity and the pipeline against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cytoplan.llm import bpe, decontaminate, jaccard, substring_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BIG = 1 << 62


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def text_key(r):
    return tuple(str(x) for x in r)


@pytest.mark.parametrize("hot", [2048, 1])
def test_substring_dedup(docs, empty, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rows = rows_of(docs)
    first = {}
    words = [WORD.findall(t or "") for _, t in rows]
    rank = [BIG if d is None else d for d, _ in rows]
    for r, w in zip(rank, words, strict=True):
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            first[k] = min(first.get(k, BIG + 1), r)
    want = []
    for (d, _), r, w in zip(rows, rank, words, strict=True):
        gone = {p for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < r for p in range(i, i + 13)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in substring_dedup.remove_repeats(docs).collect()]
    assert sorted(got, key=text_key) == sorted(want, key=text_key)
    assert sum(w[2] for w in want) > 300
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_suffix_automaton():
    rng = random.Random(3)
    seqs = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 14))] for _ in range(60)]
    sam = substring_dedup.SuffixAutomaton()
    seen = set()
    for s in seqs:
        got = {p for a, b in sam.spans(s, 3) for p in range(a, b)}
        assert got == {p for i in range(len(s) - 2) if tuple(s[i : i + 3]) in seen for p in range(i, i + 3)}
        sam.extend(s)
        seen |= {tuple(s[i : i + 3]) for i in range(len(s) - 2)}


def test_decontaminate(spark, docs, empty, texts):
    items = [(1, texts[70]), (2, "one"), (3, "A b, C"), (4, ""), (5, None), (6, " ".join((texts[40] or "").split()[:25]) + "!"), (6, "naïve été"), (None, texts[72]), (8, "absent words entirely here now")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = BENCH.findall(low(t or ""))
        n = min(len(w), 10)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[k : k + n])].add("null" if i is None else str(i))
    want = []
    for d, t in rows_of(docs):
        w = BENCH.findall(low(t or ""))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        ids = ",".join(sorted(found))
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    got = [tuple(r) for r in decontaminate.decontaminate(docs, bench).drop("h").collect()]
    assert sorted(got, key=text_key) == sorted(want, key=text_key)
    assert sum(w[5] for w in want) > 5
    assert decontaminate.decontaminate(empty, bench).count() == 0
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[5] for w in want)
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_jaccard(docs, empty):
    rows = rows_of(docs)
    sets = []
    for _, t in rows:
        w = WORD.findall(low(t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                comp[find(i)] = find(j)
    least = defaultdict(lambda: BIG)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], BIG if d is None else d)
    want = [(d, len(sets[i]), d if not sets[i] else None if least[find(i)] == BIG else least[find(i)]) for i, (d, _) in enumerate(rows)]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect()]
    assert sorted(got, key=text_key) == sorted(want, key=text_key)
    kept = jaccard.keep_one_each(docs)
    assert kept.columns == docs.columns
    n_comps = len({find(i) for i in range(len(rows)) if sets[i]})
    assert kept.count() == n_comps + sum(not s for s in sets)
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.keep_one_each(empty).count() == 0


def test_jaccard_many_near_copies(spark):
    """Families whose members link in chains, with frequent tokens on the list."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for f in range(3):
        words = [f"f{f}x{w}" if rng.random() < 0.4 else w for w in base]
        for _ in range(40):
            words = list(words)
            words[rng.randrange(120)] = f"r{rng.random()}"
            texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    test_jaccard(df, df.limit(0))


def test_jaccard_bounds():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.7, 1)], rng.integers(0, 1 << 62, rng.integers(0, 30)).astype(np.uint64)]))
        (odd_a, some_a), (odd_b, some_b) = jaccard.sketches(a), jaccard.sketches(b)
        bits = lambda v: sum(int(x).bit_count() for x in v.view(np.uint64))
        assert bits(odd_a ^ odd_b) <= len(np.setxor1d(a, b)) and bits(some_a & ~some_b) <= len(np.setdiff1d(a, b))
        if len(b) and jaccard.similar(a, b):
            none = np.empty(0, np.uint64)
            assert set(jaccard.rare_first(a, none, none)) & set(jaccard.rare_first(b, none, none))


ODD = ["don't we'll I'M", "a  b   c ", "\n\n x\t\ty ", "<|endoftext|>", "x<|endoftext|> y <|endoftext|><|endoftext|>", "日本語 テスト", "😀👍🏽 ok", "\x1c\x1d\x85\xa0​ z", "1234 ５６ ²³ ½", "İıſK", "a" * 500, "ab" * 3000, "", "᠎　﻿", "é हि", "'s's 'S"]


def test_bpe(spark, docs, texts):
    from tokenizers import Tokenizer

    path = bpe.public_vocabulary()
    t = Tokenizer.from_file(path)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD + [None] + texts[:60])], "doc_id long, text string")
    for size in (300, 0):  # with and without a lexicon
        got = {r["doc_id"]: r for r in bpe.encode_documents(df, path, size=size, with_ids=True).collect()}
        for i, x in enumerate(ODD + [None] + texts[:60]):
            ids = t.encode(x or "", add_special_tokens=False).ids
            assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids), x
            assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert got[i]["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0), path).count() == 0


def test_bpe_code_points():
    """Every kind of character splits as the library splits it."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.public_vocabulary())
    voc = bpe.Vocabulary(bpe.public_vocabulary())
    enc = bpe.Encoder(voc, None)
    rng = random.Random(1)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for _ in range(300):
        x = "".join(chr(rng.choice(points if rng.random() < 0.5 else range(0x3000))) + rng.choice(["", "a", " ", "1", "\n"]) for _ in range(60))
        ids = t.encode(x, add_special_tokens=False).ids
        assert enc.encode([x])[0] == (",".join(map(str, ids)), x.encode())
        assert bpe.decode(voc, ids) == x


def test_lexicon_is_minimal():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops"])}
    lex = bpe.Lexicon(bpe.compile_lexicon(words))
    assert lex.get(list(words) + [b"", b"to", b"stopsx", b"zz"]) == [*words.values(), None, None, None, None]
    assert len(lex.final) == 7  # root, t, st, s, before p, after p, after s
    assert bpe.Lexicon(bpe.compile_lexicon({})).get([b"a"]) == [None]


def test_merge_long_and_short():
    voc = bpe.Vocabulary(bpe.public_vocabulary())
    rng = random.Random(2)
    for _ in range(200):
        w = "".join(rng.choice("abcdeth é日") for _ in range(rng.randint(1, 60))).encode()
        assert voc.merge(w) == voc._merge_long(w)


def labelled(spark, n=600):
    rng = random.Random(11)
    vocab = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    bad = ["grubble", "snorkwit", "blatherskite"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 80))]
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(1, 4) * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), toxic))
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")


def test_toxicity(spark):
    docs, labels = labelled(spark)
    more = docs.unionByName(spark.createDataFrame([(7000, None), (7001, ""), (None, "x y"), (5, "again " * 3)], "doc_id long, text string"))
    got = toxicity.toxicity(more, labels).join(labels, "doc_id", "left").collect()
    held = [r for r in got if r["held_out"] and r["toxic"] is not None]
    assert len(held) > 80 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.95
    kept = toxicity.drop_toxic(more.withColumn("score", F.lit(1)).withColumn("__score", F.lit(2)).withColumn("held_out", F.lit(3)), labels)
    assert kept.columns == ["doc_id", "text", "score", "__score", "held_out"] and kept.where("doc_id = 7001").count() == 1


def test_toxicity_without_labels(spark):
    docs, labels = labelled(spark, 40)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_not_learned(spark):
    docs, labels = labelled(spark, 200)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "decontaminate", "bpe"]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, at, sf)
        assert got.columns == docs.columns
        got.write.parquet(out := str(tmp_path / name))
        at = spark.read.parquet(out)
        assert at.join(docs, docs.columns, "left_anti").count() == 0
    kept = {r["doc_id"] for r in at.collect()}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()} == kept
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf).count() == 0
