"""Link counts of the Jaccard join against brute force."""

import random
from collections import Counter

from cytoplan.llm import jaccard

from .test_text import WORD, low, rows_of


def want(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(low(t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    linked = lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    return Counter((d, sum(i != j and linked(a, b) for j, b in enumerate(sets))) for i, ((d, _), a) in enumerate(zip(rows, sets, strict=True)))


def got(df):
    return Counter((r["doc_id"], r["n_links"]) for r in jaccard.link_counts(df).collect())


def test_link_counts(docs, empty):
    assert got(docs) == want(rows_of(docs))
    assert not got(empty)


def test_link_counts_of_near_copies(spark):
    """Chains, so that most links are inside a group, with exact copies of some."""
    rng = random.Random(5)
    words, texts = [f"w{i}" for i in range(120)], []
    for _ in range(80):
        words = list(words)
        words[rng.randrange(120)] = f"r{rng.random()}"
        texts += [" ".join(words)] * rng.choice([1, 1, 3])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sum(n * k for (_, n), k in want(rows_of(df)).items()) > 500
    assert got(df) == want(rows_of(df))


def test_shingle_sets_take_no_python_call_a_word():
    """Sets as defined, by as many Python calls for a thousand new words as for a hundred."""
    import sys

    import numpy as np
    import xxhash

    from cytoplan.llm.shingles import gram_hashes

    def defined(text):
        words = np.array([xxhash.xxh64_intdigest(w) for w in text.encode().lower().split()], np.uint64)
        return sorted({int(gram_hashes(words[i : i + min(5, len(words))], min(5, len(words)))[0]) for i in range(max(1, len(words) - 4))}) if len(words) else []

    def calls(text):
        seen = []
        sys.setprofile(lambda frame, event, arg: event == "call" and seen.append(frame.f_code.co_name))
        try:
            found = jaccard.shingle_set(text)
        finally:
            sys.setprofile(None)
        assert found.dtype == np.uint64 and found.tolist() == defined(text)
        return len(seen)

    for text in ("", " \t ", "One", "one two", "a b c d e " * 9, "a b " + "é " * 30):
        calls(text)
    assert calls(" ".join(f"few{i}" for i in range(100))) == calls(" ".join(f"Many{i}" for i in range(1000)))
