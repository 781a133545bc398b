import random

import pytest

WS = " \t\n"


def _texts():
    """Texts with copies, near copies, shared passages, odd spaces, empty, null and very long ones."""
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)] + ["Größe", "naïve", "été", "日本", "x" * 90]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage, line = prose(30), prose(8)
    out = [None, "", " \n\t ", "one", "One", "a b c", prose(6000), "\x0b\x0c mixed\r\nspaces\t here "]
    for i in range(60):
        out.append(prose(rng.randint(1, 120)))
    for i in range(12):
        out.append(prose(20) + " " + passage + " " + prose(15))
        out.append(line + "\n" + prose(10) + "\n" + line)
    for i in range(10):
        words = out[20].split(" ") if out[20] else ["w"]
        words = [w for w in prose(100).split(" ")] if i == 0 else words
        out.append(out[rng.randint(8, 40)].replace(" ", rng.choice([" ", "  ", "\n"])))
    base = prose(200).split(" ")
    for i in range(14):
        near = list(base)
        for _ in range(i % 5):
            near[rng.randrange(len(near))] = rng.choice(vocab)
        out.append(" ".join(near))
    return out


@pytest.fixture(scope="session")
def texts():
    return _texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Rows with repeated ids, a null id and extra columns whose names clash with internal ones."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "src0", 3), (len(texts), texts[30], None, None, None), (None, texts[30], "en", "src1", 1), (None, "lonely text of nobody", "en", "src1", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "doc_id as row", "text as h", "1 as key", "2 as tie", "3 as comp")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
