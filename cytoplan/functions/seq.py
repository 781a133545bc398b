"""Column expressions over short DNA sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")
#: The standard genetic code: amino acids of all codons in T, C, A, G order of each position (fixed values).
CODE_ORDER = "TCAG"
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def dna(key: Column, length: int = 8) -> Column:
    """A DNA-like sequence that depends on a key only."""
    return F.translate(F.substring(F.md5(key.cast("string").cast("binary")), 1, length), "0123456789abcdef", "ACGTACGTACGTACGT")


def encode_2bit(seq: Column) -> Column:
    """Base-4 number with A, C, G, T as 0 to 3, first base highest."""
    return F.conv(F.translate(seq, "ACGT", "0123"), 4, 10).cast("long")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN", "TGCAN"))


def mask_outside(seq: Column, start: int, end: int) -> Column:
    """N outside the half-open range."""
    n = F.length(seq)
    return F.concat(F.repeat(F.lit("N"), F.least(F.lit(start), n)), F.substring(seq, start + 1, max(0, end - start)), F.repeat(F.lit("N"), F.greatest(n - end, F.lit(0))))


def has_n(seq: Column) -> Column:
    return F.contains(seq, F.lit("N"))


def is_homopolymer(seq: Column) -> Column:
    return seq.rlike(r"^(.)\1*$")


def has_polyt_suffix(seq: Column, n: int) -> Column:
    return F.endswith(seq, F.lit("T" * n))


def is_acgtn(seq: Column) -> Column:
    return seq.rlike("^[ACGTN]*$")


def is_valid_umi(seq: Column) -> Column:
    return ~has_n(seq) & ~is_homopolymer(seq)


def _positions(seq: Column, extra: int = 0) -> Column:
    return F.sequence(F.lit(1), F.length(seq) + extra)


def one_substitutions(seq: Column) -> Column:
    """All sequences at Hamming distance one."""
    bases = F.array(*(F.lit(b) for b in BASES))
    made = F.flatten(F.transform(_positions(seq), lambda i: F.transform(F.filter(bases, lambda b: b != F.substring(seq, i, F.lit(1))), lambda b: F.overlay(seq, b, i, F.lit(1)))))
    return F.when(F.length(seq) > 0, made).otherwise(F.array().cast("array<string>"))


def one_deletions(seq: Column) -> Column:
    return F.array_distinct(F.transform(_positions(seq), lambda i: F.overlay(seq, F.lit(""), i, F.lit(1))))


def one_insertions(seq: Column) -> Column:
    bases = F.array(*(F.lit(b) for b in BASES))
    return F.array_distinct(F.flatten(F.transform(_positions(seq, 1), lambda i: F.transform(bases, lambda b: F.overlay(seq, b, i, F.lit(0))))))


def n_candidates(seq: Column) -> Column:
    """The four sequences with the only N replaced."""
    return F.array(*(F.replace(seq, F.lit("N"), F.lit(b)) for b in BASES))


def hamming(a: Column, b: Column) -> Column:
    """Differences of sequences of equal length."""
    return F.size(F.filter(F.sequence(F.lit(1), F.length(a)), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))


def kmers(seq: Column, k: int) -> Column:
    made = F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), lambda i: F.substring(seq, i, F.lit(k)))
    return F.when(F.length(seq) >= k, made).otherwise(F.array().cast("array<string>"))


def translate_codons(seq: Column) -> Column:
    """Amino acids of the whole codons of an ACGT sequence."""
    place = F.translate(seq, CODE_ORDER, "0123")
    one = lambda i: F.substring(F.lit(CODE), (F.conv(F.substring(place, i, F.lit(3)), 4, 10).cast("int") + 1), F.lit(1))
    starts = F.sequence(F.lit(1), F.length(seq) - 2, F.lit(3))
    return F.when(F.length(seq) >= 3, F.array_join(F.transform(starts, one), "")).otherwise(F.lit(""))


def has_start(seq: Column, at: int) -> Column:
    return F.substring(seq, at + 1, 3) == "ATG"


def has_stop(seq: Column, at: int) -> Column:
    return F.substring(seq, at + 1, 3).isin("TAA", "TAG", "TGA")


def pattern_regex(pattern: str, length: int) -> str:
    """A feature pattern such as 5PNNN(BC)ACG as a regular expression with one group."""
    if pattern.count("(BC)") != 1:
        raise ValueError(f"a pattern needs one (BC): {pattern}")
    start, end = pattern.startswith("5P"), pattern.endswith("3P")
    body = pattern[2 if start else 0 : len(pattern) - 2 if end else None].lstrip("^").rstrip("$")
    left, right = (x.replace("N", "[ACGTN]") for x in body.split("(BC)"))
    return ("^" if start else "") + left + f"([ACGTN]{{{length}}})" + right + ("$" if end else "")


def suffix_overlap(target: Column, query: Column, least: int) -> Column:
    """Longest suffix of target that is a prefix of query, if it has at least `least` bases, else 0."""
    longest = F.least(F.length(target), F.length(query))
    ok = F.filter(F.sequence(F.lit(1), longest), lambda n: F.right(target, n) == F.left(query, n))
    best = F.coalesce(F.array_max(ok), F.lit(0))
    return F.when(best >= least, best).otherwise(0)
