"""Pairs inside the values of others, at any depth, and the time that they take."""

import time

import pytest

from cytoplan.llm import secrets

LIT = "Zx9+kQ7/mPw2"
DEEP = [
    "".join(f"k{i}=" for i in range(40)) + f"db_credential={LIT}",
    "a=" + "f(b=" * 30 + f'f(db_credential="{LIT}")' + ")" * 30,
    "a=" + "f(b=" * 30 + f"f(db_credential={LIT})",
    f"x = {'='.join('abcdefghijp')}=k\nk = '{LIT}'\ndb_credential = p",
]


@pytest.mark.parametrize("text", DEEP)
def test_pairs_at_any_depth(text):
    """A secret counts however many values it is inside of."""
    assert LIT in [text[a:b] for a, b in secrets.named_spans(text)]


def test_nested_calls_are_counted_as_their_strings_together():
    """Scores of nested calls and of values with a common end are those of the joined texts."""
    text = 'token = f("ab", secret=g("cd", "Zx9 "), password=h("kQ7 mPw2 xY", token=f("aB3$xY7!kQ")))'
    both = [secrets.Tally(x) for x in ("ab", "cd ", "", " kQ7 mPw2", "aB3$xY7!kQ")]
    for x in both[1:]:
        both[0].add(x)
    assert both[0].score() == secrets.literal_score("abcd  kQ7 mPw2aB3$xY7!kQ", True)
    lone = [x for p in secrets.lex_pairs(text) if secrets.name_score(p.name) for x in [(p.name, p.strings())]]
    assert lone == [("token", (0, 5)), ("secret", (1, 3)), ("password", (3, 5)), ("token", (4, 5))]


@pytest.mark.parametrize("part", ["token=", "a=", "token=f(", 'token=f("aB3$xY7!kQ",', "token=a+", "token=$", 'a=f("aB3$xY7!kQ",'])
def test_time_of_nested_pairs_follows_length(part):
    text = "password = " + part * (100_000 // len(part))
    t = time.perf_counter()
    secrets.named_spans(text)
    assert time.perf_counter() - t < 10
