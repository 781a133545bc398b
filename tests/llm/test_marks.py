"""Toxic marks: wide lexicons, phrases of everyday words, texts without spaces."""

import random

import numpy as np

from cytoplan.llm import toxicity


def rows(kind, n, seed):
    """(text, toxic): n of each class."""
    rng = random.Random(3)
    vocab = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    bad = ["".join(rng.choice("bcdfgklmprz" if i % 2 else "aeiou") for i in range(9)) for _ in range(200)]
    phrases = [[rng.choice(vocab) for _ in range(3)] for _ in range(20)]
    parts = [w for p in phrases for w in p]
    rng, out = random.Random(seed), []
    for toxic in (0, 1):
        for _ in range(n):
            words = [rng.choice(vocab) for _ in range(rng.randint(20, 60))]
            for _ in range(2):
                i = rng.randrange(len(words) - 3)
                if kind == "phrase":  # ordinary rows hold the same words apart
                    words[i : i + 3] = rng.choice(phrases) if toxic else [rng.choice(parts), words[i], rng.choice(parts)]
                elif toxic:
                    words[i] = rng.choice(bad[:10] if kind == "joined" else bad)
            out.append((("" if kind == "joined" else " ").join(words), toxic))
    rng.shuffle(out)
    return out


def accuracy(kind, n):
    train, test = rows(kind, n, 1), rows(kind, 200, 2)
    model = toxicity.fit([t for t, _ in train], [y for _, y in train], (n, n))
    return sum((s >= toxicity.THRESHOLD) == y for s, (_, y) in zip(model.scores([t for t, _ in test]), test, strict=True)) / len(test)


def test_wide_lexicon():
    """Each of 200 words is in about 1% of the toxic rows."""
    assert accuracy("lexicon", toxicity.FIT_ROWS) > 0.95


def test_texts_without_spaces():
    assert accuracy("joined", 1000) > 0.95
    text = "".join(random.Random(1).choices("abcdefgh日本語", k=100_000))
    pieces = [w.strip() for w in toxicity.windows(text)]
    assert max(map(len, pieces)) <= toxicity.PIECE
    raw, at = text.encode(), 0
    for p, q in zip(pieces, pieces[1:]):  # each half of a piece begins the next one
        assert raw.startswith(p, at) and p[toxicity.PIECE // 2 :] == q[: len(p) - toxicity.PIECE // 2]
        at += toxicity.PIECE // 2
    assert raw.endswith(pieces[-1]) and at + len(pieces[-1]) == len(raw)


def test_phrases_of_everyday_words():
    """No word is more frequent in toxic rows."""
    assert accuracy("phrase", 1000) > 0.95


def test_pairs_of_adjacent_words():
    """Windows of two words: the known ones, where the words are neighbours."""
    one = toxicity.Dictionaries((b"", b""), (b"", b"wicked goblin "), (b"", b""))
    distances = toxicity.Distances([one], {(b" wicked ", b" goblin "): b" wicked goblin "})
    x = distances.of(["a wicked goblin", "a goblin wicked", "wicked", ""])
    few = len(toxicity.STEPS) * 2 + len(toxicity.SHARES)
    pairs = [v[0][few : 2 * few].any() for v in x]
    assert pairs == [True, False, False, False]


def test_the_dictionaries_decide():
    """With the two dictionaries exchanged, marked windows cost more instead of less."""
    train = rows("lexicon", 2000, 1)
    model = toxicity.fit([t for t, _ in train], [y for _, y in train], (2000, 2000))
    texts = [t for t, y in rows("lexicon", 100, 2) if y]
    before = model.scores(texts)
    for j in model.judges:
        j.trained = toxicity.Dictionaries(j.trained.words[::-1], j.trained.pairs[::-1], j.trained.runs[::-1])
    after = model.scores(texts)
    assert sum(a < b for a, b in zip(after, before, strict=True)) > 95


def test_what_the_last_batch_shares_is_not_compressed_again(monkeypatch):
    one = toxicity.Dictionaries((b" plain text ", b" wicked goblin "), (b"", b""), (b"", b""))
    known = {(b" wicked ", b" goblin "): b" wicked goblin "}
    common = [f"common{i}" for i in range(30)]
    batches = [[" ".join([*common, f"only{b}", "wicked goblin", f"x{b}" * 40, f"common{b}!"])] for b in range(6)]
    fresh = [toxicity.Distances([one, one], known).of(b) for b in batches]
    monkeypatch.setattr(toxicity, "CACHE_WINDOWS", 40)
    distances = toxicity.Distances([one, one], known)
    compressed, codes = [], distances._codes
    monkeypatch.setattr(distances, "_codes", lambda trained, made: compressed.extend(made) or codes(trained, made))
    for b, expected in zip(batches, fresh, strict=True):
        np.testing.assert_array_equal(distances.of(b), expected)
        assert len(distances.windows) <= len(distances.tokens) <= 60
    assert sum(w.startswith(b" common") for w in compressed) == len(common)
