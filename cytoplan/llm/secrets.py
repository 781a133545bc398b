r"""Secret scans: fixed patterns plus an assignment-aware lexer.

Base spans, leftmost non-overlapping per kind: ``assign``, ``access``, ``hex`` (whole matches).
A scanner cuts lines that hold an operator into strings (escapes, triple quotes, over lines where the syntax lets
them), names, operators and marks; a parser reads name-literal pairs from those: ``name = "x"``, ``name: x``,
``name: type = "x"``, ``name string = "x"``, ``"name": "x"``, ``map["name"] = "x"``, ``export NAME=x``, ``f(name="x")``,
``name = f("x")``, block scalars (``name: |``), elements (``<name>x</name>``) and paired attributes
(``key="name" value="x"``). Adjacent and added strings are one literal; added names stand for what they were assigned
last before, or first after, so constants are propagated through any number of steps and to either side of a sum.
A literal is scored by the words of the most sensitive name that it reaches and by its own shape; quoted phrases of
several words count as well. Literals of at least ``MIN_SCORE`` are added as kind ``named``; base spans always stay.

Defined cases: a null text is empty; an empty text has no spans; an empty table gives no rows; repeated rows give repeated
results; constants are followed within one document, cycles end; pairs inside a string literal count but assign no constants;
extra columns are ignored. Each text is read whole, on its own, so tasks hold one batch of texts. Pairs inside the values of
others count, at any depth: a value is only read when its name needs it, and values that end or nest in each other are counted
together, so time follows the length; sums of calls that nest in each other and chains of constants are followed for each sensitive name.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_rows, table

KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Every match of ASSIGN holds one of these in ASCII letters of either case.
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Lines that the scanner reads hold one of these.
MARKS = re.compile(r"[=:<]")
TOKEN = re.compile(r"""(?P<name>[A-Za-z_$][A-Za-z0-9_$.\-]*+)|(?P<op>:=|=>|[=!<>]=|=|:)|(?P<quote>[rbfuRBFU]?["'`])|(?P<nl>\n)|(?P<mark>[^\s])""")
#: The rest of a string after its quote; the second kind takes a backslash for itself.
STRINGS = {q: re.compile(rf"(?:[^{q}\\\n]++|\\[\s\S])*+{q}") for q in "\"'`"} | {q * 3: re.compile(rf"(?:[^{q}\\]++|\\[\s\S]|{q}(?!{q}{q}))*+{q * 3}") for q in "\"'"}
PLAIN = {q: re.compile(rf"[^{q}\n]*+{q}") for q in "\"'`"}
BARE = re.compile(r"[A-Za-z0-9+/_.=$\-]++")
BLOCK = re.compile(r"[|>][+\-0-9]*+[ \t]*+(?:\#[^\n]*+)?\n")
ELEMENT = re.compile(r"<([A-Za-z_][\w.:\-]{0,200})(?:\s[^<>]*+)?>([^<>]++)</\1\s*>")
TAG = re.compile(r"<[A-Za-z_][\w.:\-]*+\s([^<>]*+)>")
ATTRIBUTE = re.compile(r"""([\w.:\-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)')""")
#: Attributes that hold a name, and the one that holds its value (fixed values).
NAMED_BY, VALUE = {"key", "name", "id", "property"}, "value"
#: Marks of types between a name and its value, and words that are types by themselves (fixed values).
TYPE_MARKS, TYPE_WORDS = set("[]<>|,&*?'()"), {"string", "str", "String", "text", "char"}
LEADING = re.compile(r"[0-9.\-]+")


class Token(NamedTuple):
    kind: str  # name, op, string, nl or mark
    text: str  # of a string, what is inside
    lo: int  # of a string, the place of what is inside
    hi: int


class Line:
    """Tokens of a stretch of text, with what the values in it share: ends of calls, strings, runs of bare characters."""

    def __init__(self, text: str, tokens: list[Token]):
        self.text, self.tokens, self.run = text, tokens, (0, 0)
        self.ends = [t.hi for t in tokens]
        self.strings = [i for i, t in enumerate(tokens) if t.kind == "string"]
        self.calls: dict[int, int] = {}  # of an opening mark, the token after its call, which ends with the line at last
        opened: list[int] = []
        for i, t in enumerate(tokens):
            if t.kind == "mark" and t.text == "(":
                opened.append(i)
            elif t.kind == "mark" and t.text == ")" and opened:
                self.calls[opened.pop()] = i + 1
            elif t.kind == "nl":
                self.calls.update(dict.fromkeys(opened, i))
                opened = []
        self.calls.update(dict.fromkeys(opened, len(tokens)))

    def bare(self, i: int) -> int:
        """The end of the run of bare characters that holds the start of token i, or that start."""
        at = self.tokens[i].lo
        if self.tokens[i].kind not in ("name", "mark", "op"):
            return at
        if not self.run[0] <= at < self.run[1]:
            m = BARE.match(self.text, at)
            if not m:
                return at
            self.run = m.span()
        return self.run[1]

    def called(self, i: int, end: int) -> tuple[int, bool]:
        """The token after the run from token i to end, and whether that opens a call of the name at i."""
        j = bisect_right(self.ends, end, i + 1)
        return j, self.tokens[i].kind == "name" and j < len(self.tokens) and self.tokens[j].text == "(" and self.tokens[j].lo == end

    def added(self, i: int) -> bool:
        return i < len(self.tokens) and self.tokens[i].kind == "mark" and self.tokens[i].text in "+."

    def begin(self, i: int) -> int:
        """Where a value begins whose operator is before i: brackets and line ends behind them are passed over."""
        while i < len(self.tokens) and self.tokens[i].kind == "mark" and self.tokens[i].text in "(\\":
            i += 1
            while i < len(self.tokens) and self.tokens[i].kind == "nl":
                i += 1
        return i

    def inner(self, i: int) -> list[Token]:
        """The strings of the call that is opened at i."""
        return [self.tokens[k] for k in self.strings[bisect_left(self.strings, i) : bisect_left(self.strings, self.calls[i])]]


class Pair(NamedTuple):
    """A name with the parts of its value in order, literals, some of which name others; they are read when asked for."""

    name: str
    parts: list | None  # None: the value at a place of a line
    at: int
    inside: bool  # in a string literal
    line: Line | None = None
    start: int = 0

    def value(self) -> list:
        return value(self.line, self.start) if self.parts is None else self.parts

    def lone(self) -> tuple[int, int] | None:
        return lone(self.line, self.start) if self.parts is None else None

    def strings(self) -> tuple[int, int] | None:
        return strings(self.line, self.start) if self.parts is None else None


class Literal(NamedTuple):
    text: str
    lo: int
    hi: int
    quoted: bool


def scan(text: str, lo: int, hi: int, escapes: bool = True) -> tuple[list[Token], int]:
    """Tokens from lo to the end of the line at hi, or of the string that runs past it; where that is."""
    out, at, dead = [], lo, {}
    while at < hi and (m := TOKEN.search(text, at, hi)):
        at, kind = m.end(), m.lastgroup
        if kind == "quote":
            q = m.group()[-1]
            whole = STRINGS if escapes else PLAIN
            if escapes and q * 3 in whole and text.startswith(q * 2, at) and (s := whole[q * 3].match(text, at + 2)):
                out.append(Token("string", text[at + 2 : s.end() - 3], at + 2, s.end() - 3))
            elif dead.get(q, -1) < at and (s := whole[q].match(text, at)):
                out.append(Token("string", text[at : s.end() - 1], at, s.end() - 1))
            else:  # open to the end of the line, as is any later quote of this kind
                if q not in dead:
                    end = text.find("\n", at)
                    dead[q] = len(text) if end < 0 else end
                out.append(Token("mark", q, m.start(), at))
                continue
            at = s.end()
            if at > hi:
                end = text.find("\n", at)
                hi = len(text) if end < 0 else end + 1
        else:
            out.append(Token(kind, m.group(), m.start(), at))
    return out, hi


def target(tokens: list[Token], i: int) -> str | None:
    """The name that the operator at i assigns to."""
    t = tokens[i - 1] if i else None
    if t and t.text == "?" and i > 1:  # name?: type
        i, t = i - 1, tokens[i - 2]
    if t is None:
        return None
    before = tokens[i - 2] if i > 1 else None
    if t.kind == "name" and t.text in TYPE_WORDS and before and before.kind == "name":
        return before.text
    if t.kind == "mark" and t.text == "]" and before and before.kind in ("string", "name") and i > 2 and tokens[i - 3].text == "[":
        t = before
    if t.kind == "string":
        return t.text if len(t.text) <= 200 and not any(map(str.isspace, t.text)) else None
    return LEADING.sub("", t.text, count=1) or None if t.kind == "name" else None


def typed(tokens: list[Token], i: int) -> int:
    """Of a colon at i with a type after it, the place of the = that follows, else i."""
    j, depth = i + 1, 0
    while j < len(tokens) and (tokens[j].kind == "name" or tokens[j].kind in ("mark", "string") and (tokens[j].kind == "string" or tokens[j].text in TYPE_MARKS)):
        if depth == 0 and (tokens[j].kind == "string" or tokens[j].text == ","):
            return i
        depth += tokens[j].text in ("[", "<", "(") and tokens[j].kind == "mark"
        depth -= tokens[j].text in ("]", ">", ")") and tokens[j].kind == "mark"
        j += 1
    ends = j < len(tokens) and tokens[j].text == "=" and tokens[j].kind == "op" and j > i + 1 and depth == 0
    loose = ends and (tokens[j].lo > tokens[j - 1].hi or tokens[j - 1].kind == "mark")  # env: name=x is no type
    names = ends and all(not (a.kind == b.kind == "name") or a.text in ("mut", "static", "const") for a, b in zip(tokens[i + 1 : j], tokens[i + 2 : j], strict=False))
    return j if loose and (names or "&" in (t.text for t in tokens[i + 1 : j])) else i


def block(text: str, tokens: list[Token], i: int) -> Literal | None:
    """The block scalar that begins after the colon at i: lines indented further than its own."""
    if not (m := BLOCK.match(text, tokens[i].lo)):
        return None
    start = text.rfind("\n", 0, tokens[i].lo) + 1
    indent = len(text[start:]) - len(text[start : tokens[i].lo].lstrip(" ")) - len(text[tokens[i].lo :])
    at, lo, hi, lines = m.end(), None, None, []
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        line = text[at:end]
        own = len(line) - len(line.lstrip(" "))
        if line.strip():
            if own <= indent:
                break
            lo, hi = at + own if lo is None else lo, at + len(line.rstrip())
            lines.append(line.strip())
        at = end + 1
    return None if lo is None else Literal("".join(lines), lo, hi, True)


def value(line: Line, i: int) -> list:
    """The parts of the sum that begins at i: literals, of which bare ones may be names."""
    text, tokens = line.text, line.tokens
    out: list = []
    joined = False  # whether the last part ends in a string
    while i < len(tokens):
        if not out:
            i = line.begin(i)
            if i == len(tokens):
                break
        t = tokens[i]
        if t.kind == "string":
            piece = t.text.replace("\\\n", "")
            if joined:
                last = out[-1]
                out[-1] = Literal(last.text + piece, last.lo, t.hi, True)
            else:
                out.append(Literal(piece, t.lo, t.hi, True))
            joined = True
            i += 1
        elif (t.kind != "op" or not out) and (end := line.bare(i)) > t.lo:
            joined = False
            j, call = line.called(i, end)
            if call:
                out += [Literal(x.text, x.lo, x.hi, True) for x in line.inner(j)]
                i = line.calls[j]
            else:
                out.append(Literal(text[t.lo : end], t.lo, end, False))
                i = j
        else:
            break
        if i < len(tokens) and tokens[i].kind == "string" and joined:
            continue
        if not line.added(i):
            break
        i += 1
    return out


def has_value(line: Line, i: int) -> bool:
    """Whether value() finds parts at i, without reading them."""
    while (i := line.begin(i)) < len(line.tokens):
        t = line.tokens[i]
        if t.kind == "string":
            return True
        end = line.bare(i)
        if end == t.lo:
            return False
        j, call = line.called(i, end)
        if not call or bisect_left(line.strings, line.calls[j]) > bisect_left(line.strings, j):
            return True
        if not line.added(line.calls[j]):
            return False
        i = line.calls[j] + 1
    return False


def lone(line: Line, i: int) -> tuple[int, int] | None:
    """The run of bare characters that is all of the value at i, if it is one."""
    i = line.begin(i)
    if i == len(line.tokens) or (end := line.bare(i)) == line.tokens[i].lo:
        return None
    j, call = line.called(i, end)
    return None if call or line.added(j) else (line.tokens[i].lo, end)


def strings(line: Line, i: int) -> tuple[int, int] | None:
    """The strings of the line, by their numbers, of the call that is all of the value at i, if it is one."""
    i = line.begin(i)
    if i == len(line.tokens) or (end := line.bare(i)) == line.tokens[i].lo:
        return None
    j, call = line.called(i, end)
    return (bisect_left(line.strings, j), bisect_left(line.strings, line.calls[j])) if call and not line.added(line.calls[j]) else None


def read(text: str, tokens: list[Token], inside: bool) -> list[Pair]:
    """Every pair of the tokens, those inside the values of others too; only whether there is a value is read here."""
    out: list[Pair] = []
    done, line = set(), Line(text, tokens)
    for i, t in enumerate(tokens):
        if t.kind != "op" or t.text not in ("=", ":", ":=", "=>") or i in done or not (name := target(tokens, i)):
            continue
        if t.text == ":" and i + 1 < len(tokens) and (found := block(text, tokens, i + 1)):
            out.append(Pair(name, [found], t.lo, inside))
            continue
        j = typed(tokens, i) if t.text == ":" else i
        done.add(j)
        out += [Pair(name, None, t.lo, inside, line, k + 1) for k in {j, i} if has_value(line, k + 1)]
    return out


def lex_pairs(text: str) -> list[Pair]:
    """Name-literal pairs in order of their lines; strings are read inside too, once."""
    out: list[Pair] = []
    at = 0
    while m := MARKS.search(text, at):
        lo = text.rfind("\n", at, m.start()) + 1
        lo = max(lo, at)
        end = text.find("\n", m.start())
        end = len(text) if end < 0 else end + 1
        tokens, at = scan(text, lo, end)
        if len(tokens) and tokens[-1].kind != "nl" and at < len(text) or text[max(0, at - 2) : at] in ("(\n", "\\\n"):
            more = text.find("\n", at)
            tail, at = scan(text, at, len(text) if more < 0 else more + 1)  # a value may begin on the next line
            tokens += tail
        out += read(text, tokens, False)
        strings = [t for t in tokens if t.kind == "string" and MARKS.search(t.text)]
        for t in strings:
            out += read(text, within(t), True)
        if any("\\" in t.text for t in strings):
            out += read(text, scan(text, lo, at, False)[0], True)
    if "<" in text:
        for m in ELEMENT.finditer(text):
            body = m.group(2).strip()
            lo = m.start(2) + m.group(2).find(body) if body else m.start(2)
            out.append(Pair(m.group(1), [Literal(body, lo, lo + len(body), True)], m.start(), True))
        for m in TAG.finditer(text):
            found = [(a.group(1).lower(), a.group(2) if a.group(2) is not None else a.group(3), a) for a in ATTRIBUTE.finditer(text, m.start(1), m.end(1))]
            names = [v for k, v, _ in found if k in NAMED_BY]
            for k, v, a in found:
                if k == VALUE and names:
                    out.append(Pair(names[0], [Literal(v, a.end() - 1 - len(v), a.end() - 1, True)], m.start(), True))
    return out


def within(t: Token) -> list[Token]:
    """Tokens of a string's inside, at their places in text."""
    return [Token(k, x, lo + t.lo, hi + t.lo) for k, x, lo, hi in scan(t.text, 0, len(t.text))[0]]


WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Weight of a word in a target's name.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.8, "credential": 0.9, "credentials": 0.9, "private": 0.6, "apikey": 1.0, "api": 0.4, "key": 0.5, "auth": 0.5, "access": 0.3, "signature": 0.4, "salt": 0.5, "cert": 0.4, "bearer": 0.7}
#: Words that make a name harmless.
HARMLESS = {"public", "name", "path", "file", "url", "length", "count", "type", "id", "min", "max", "hint", "label", "field"}
MIN_SCORE, MIN_LITERAL, PHRASE_WORDS = 1.0, 8, 3


def name_score(name: str) -> float:
    words = [w.lower() for w in WORD.findall(name)]
    if not words or words[-1] in HARMLESS:
        return 0.0
    return min(1.2, sum(SENSITIVE.get(w, 0.0) for w in set(words)))


#: Kinds of characters of a literal, any other being one more.
CLASSES = (frozenset("abcdefghijklmnopqrstuvwxyz"), frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), frozenset("0123456789"))


def literal_score(text: str, quoted: bool = False) -> float:
    """0 to 1: length, spread of characters and mixed classes; phrases of words count if quoted."""
    spaced = any(c.isspace() for c in text)
    if len(text) < MIN_LITERAL or spaced and not (quoted and len(text) >= 2 * MIN_LITERAL and len(text.split()) >= PHRASE_WORDS and "\n" not in text):
        return 0.0
    return spread_score(Counter(text), len(text), spaced)


def spread_score(counts: Counter, n: int, spaced: bool = False) -> float:
    bits = -math.fsum(c / n * math.log2(c / n) for c in counts.values())
    if spaced:
        return 0.7 * min(1.0, bits / 3.5)
    kinds = [not s.isdisjoint(counts) for s in CLASSES]
    classes = sum(kinds) + any(not any(c in s for s in CLASSES) for c in counts)
    return min(1.0, bits / 4.0) * (0.5 + 0.5 * min(1.0, (classes - 1) / 2))


class Tally:
    """What the score of a quoted literal takes from its text, of texts put together."""

    def __init__(self, text: str = ""):
        self.counts, self.n, self.words = Counter(text), len(text), len(text.split())
        self.opens, self.ends = text[:1].isspace(), text[-1:].isspace()

    def add(self, other: Tally) -> None:
        """Puts other behind; its counts may be taken over."""
        if not other.n:
            return
        if not self.n:
            self.opens = other.opens
        self.words += other.words - (self.n > 0 and not self.ends and not other.opens)
        small, large = sorted((self.counts, other.counts), key=len)
        large.update(small)
        self.counts, self.n, self.ends = large, self.n + other.n, other.ends

    def score(self) -> float:
        spaced = any(map(str.isspace, self.counts))
        if self.n < MIN_LITERAL or spaced and (self.n < 2 * MIN_LITERAL or self.words < PHRASE_WORDS or self.counts["\n"]):
            return 0.0
        return spread_score(self.counts, self.n, spaced)


def call_spans(line: Line, calls: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Strings of calls whose strings together score, with the weight of the name, MIN_SCORE. Calls nest, so what an inner one counted is taken over."""
    all_strings = [line.tokens[i] for i in line.strings]
    change = [0] * (len(all_strings) + 1)
    inner: list[tuple[int, int, Tally]] = []
    for a, b, s in sorted(calls, key=lambda c: (-c[0], c[1])):
        total, at = Tally(), a
        while inner and inner[-1][1] <= b:
            lo, hi, part = inner.pop()
            for k in range(at, lo):
                total.add(Tally(all_strings[k].text))
            total.add(part)
            at = hi
        for k in range(at, b):
            total.add(Tally(all_strings[k].text))
        inner.append((a, b, total))
        if (shape := total.score()) and s * (0.4 + shape) >= MIN_SCORE:
            change[a] += 1
            change[b] -= 1
    return [(t.lo, t.hi) for t, n in zip(all_strings, accumulate(change), strict=False) if n > 0 and t.hi > t.lo]


class Constants:
    """What names stand for, by the place of use."""

    def __init__(self, pairs: list[Pair]):
        self.at: dict[str, list[int]] = {}
        self.pairs: dict[str, list[Pair]] = {}
        for p in sorted((p for p in pairs if not p.inside), key=lambda p: p.at):
            self.at.setdefault(p.name, []).append(p.at)
            self.pairs.setdefault(p.name, []).append(p)
        self.lengths = set(map(len, self.at))

    def named(self, text: str, lo: int, hi: int) -> bool:
        """Whether what is bare from lo to hi is a name that stands for something; long runs are not looked up in vain."""
        while lo < hi and text[lo] == "$":
            lo += 1
        return hi - lo in self.lengths and text[lo:hi] in self.at

    def literals(self, parts: list, at: int) -> list[Literal]:
        """The literals that parts at a place come to; a name goes for its last value before, else its first after."""
        out, seen, work = [], set(), [(x, at) for x in reversed(parts)]
        while work:
            x, use = work.pop()
            name = x.text.lstrip("$")
            if x.quoted or name not in self.at:
                out.append(x)
                continue
            k = max(0, bisect_left(self.at[name], use) - 1)
            if (name, k) not in seen:
                seen.add((name, k))
                work += [(y, self.at[name][k]) for y in reversed(self.pairs[name][k].value())]
        return out


def named_spans(text: str) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, directly or through constants."""
    if not MARKS.search(text):
        return []
    pairs = lex_pairs(text)
    scored = [(p, s) for p in pairs if (s := name_score(p.name))]
    if not scored:
        return []
    constants = Constants(pairs)
    found: dict[tuple[int, int], float] = {}
    runs: dict[int, dict[int, float]] = {}
    calls: dict[Line, list[tuple[int, int, float]]] = {}
    for p, s in scored:
        span = p.lone()
        if span and not constants.named(text, *span):
            starts = runs.setdefault(span[1], {})
            starts[span[0]] = max(starts.get(span[0], 0.0), s)
            continue
        if among := p.strings():
            calls.setdefault(p.line, []).append((*among, s))
            continue
        literals = constants.literals(p.value(), p.at)
        shape = literal_score("".join(x.text for x in literals), all(x.quoted for x in literals))
        for x in literals:
            if shape and x.hi > x.lo:
                found[x.lo, x.hi] = max(found.get((x.lo, x.hi), 0.0), s * (0.4 + shape))
    for hi, starts in runs.items():  # values that end together are counted once, from the end
        counts, end = Counter(), hi
        for lo in sorted(starts, reverse=True):
            counts.update(text[lo:end])
            end = lo
            if hi - lo >= MIN_LITERAL and (shape := spread_score(counts, hi - lo)):
                found[lo, hi] = max(found.get((lo, hi), 0.0), starts[lo] * (0.4 + shape))
    spans = {span for span, score in found.items() if score >= MIN_SCORE}
    return sorted(spans.union(*(call_spans(line, those) for line, those in calls.items())))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), unsorted."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{lo}:{hi}" for lo, k, hi in sorted(spans))


def scan_text(text: str) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    n = Counter(k for _, k, _ in base)
    listed = _listed(base)
    every = _listed(base + [(lo, 3, hi) for lo, hi in named_spans(text)])
    return n[0], n[1], n[2], hashlib.sha256(listed.encode()).hexdigest(), every


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    arrow_rows(docs.sparkSession)

    def scan(batches):
        for b in batches:
            found = [scan_text(t or "") for t in b.column(1).to_pylist()]
            cols = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *(pa.array(c, SCHEMA.types[i + 1]) for i, c in enumerate(cols))], schema=SCHEMA)

    return docs.select(id_col, text_col).mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
