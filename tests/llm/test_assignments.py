"""Assignments that the secret lexer reads, against a list written by hand."""

import random
import time

import pytest

from cytoplan.llm import secrets

LIT = "Zx9$kQ7!mPw2"
LONG = "".join(random.Random(1).choices("abcdefXYZ0123456789-_.", k=3000))
CASES = [
    (f'db_credential = "{LONG}"', [LONG]),
    (f"db_credential = {LONG}", [LONG]),
    (f'db_credential          = "{LIT}"', [LIT]),
    (f'db_credential\t=\t"{LIT}"', [LIT]),
    (f'db_credential: str = "{LIT}"', [LIT]),
    (f"db_credential: Optional[Dict[str, List[str]]] = '{LIT}'", [LIT]),
    (f'db_credential: str | None = "{LIT}"', [LIT]),
    (f'dbCredential?: string = "{LIT}"', [LIT]),
    (f'const DB_CREDENTIAL: &\'static str = "{LIT}";', [LIT]),
    (f'var dbCredential string = "{LIT}"', [LIT]),
    (r'db_credential = "Zx9\"kQ7!mPw2"', [r"Zx9\"kQ7!mPw2"]),
    ('db_credential = "Zx9$kQ7!\\\nmPw2"', ["Zx9$kQ7!\\\nmPw2"]),
    ("db_credential = " + " + ".join(['"aB3$xY7!kQ"'] * 12), [" + ".join(['"aB3$xY7!kQ"'] * 12)[1:-1]]),
    (f'k: str = "{LIT}"\ndb_credential = k', [LIT]),
    (f'{{db_credential: other, note = "{LIT}"}}', []),
    (f'note: str = "{LIT}"\ndb_credential: str\n', []),
    ("env:\tdb_credential=Zx9+kQ7/mPw2", ["Zx9+kQ7/mPw2"]),
    (f'path = "C:\\"; db_credential = "{LIT}"', [LIT]),
    (f'{"x" * 200}_credential = "{LIT}"', [LIT]),
]


#: Parts of texts that are slow to read if anything is.
MORE = ['"\\"', "\\'", '"""', "'''", '`', '<a>', "<a b='", 'a: |\n ', 'a=(\n', 'a=b+', 'a=f(', 'k="\\"', 'a = b\n', '"a=\'" ']
CASES += [
    (f'cfg["pwd"] = "{LIT}"', [LIT]),
    (f"cfg['db']['password'] = '{LIT}'", [LIT]),
    (f"password: |\n  {LIT}\nnext: 1\n", [LIT]),
    (f"a:\n  private_key: >-\n    {LIT}\n    {LIT}\n  b: 1\n", [f"{LIT}\n    {LIT}"]),
    (f"<db><password>{LIT}</password></db>", [LIT]),
    (f'<add key="DbPassword" value="{LIT}"/>', [LIT]),
    (f'password = k\nk = "{LIT}"', [LIT]),
    (f'k = "{LIT}"\nm = k\ntoken_secret = m\n', [LIT]),
    (f'A = "{LIT}"\nB = "{LIT}x"\ndb_pwd = A + B', [LIT, LIT + "x"]),
    ('a = b\nb = a\npassword = a\n', []),
    ('passphrase = "correct horse battery staple"', ["correct horse battery staple"]),
    ('password = "please ask"', []),
    (f'password = decode("{LIT}")', [LIT]),
    (f'password = """{LIT}"""', [LIT]),
    (f'password = (\n  "{LIT}"\n)', [LIT]),
    (f'if password == "{LIT}":', []),
    ("Note: the password of the day is not here: ask at the desk", []),
]


@pytest.mark.parametrize("text, want", CASES)
def test_assignments(text, want):
    assert [text[a:b] for a, b in secrets.named_spans(text)] == want


@pytest.mark.parametrize("part", ["a:b[", "a=\"", "a:b,", "a: ", "k='\\", "a-", "a\t", '"x" + ', 'k="a=" ', "a: b | ", "a=", "a:", "a: ", *MORE])
def test_time_follows_length(part):
    text = "password = " + part * (400_000 // len(part))
    t = time.perf_counter()
    secrets.lex_pairs(text)
    assert time.perf_counter() - t < 10
