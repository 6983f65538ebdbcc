"""ECMAScript rules (flag g) with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from cueloom.config import ConfigError, Rule
from cueloom.functions.script_regex import Pattern, PatternError
from cueloom.functions.text import count_matches, replace_all

# pattern, replacement, text, result
CASES = [
    # ends and lines
    (r"a$", "X", "a a\n", "a a\n"),
    (r"a$", "X", "a a", "a X"),
    (r"^a", "X", "a\na", "X\na"),
    (r"a.b", "X", "a\nb a\rb a b a\u0085b", "a\nb a\rb a b X"),
    (r"$", "!", "ab", "ab!"),
    (r"^", "!", "ab", "!ab"),
    (r"[^]", "x", "a\n", "xx"),
    (r"a[]|b", "X", "ab", "aX"),
    # words and spaces
    (r"\bec2\b", "EC2", "éec2 ec2.", "éEC2 EC2."),
    (r"\Bb", "X", "ab b", "aX b"),
    (r"\w+", "X", "naïve_1", "XïX"),
    (r"\W", "-", "aéb", "a-b"),
    (r"\s", "_", "a b　c﻿d", "a_b_c_d"),
    (r"\S+", "X", "a é", "X X"),
    (r"\d", "#", "1٣2", "#٣#"),
    (r"\D", "#", "1a٣", "1##"),
    # letters without a meaning are themselves
    (r"\p{L}+", "X", "p{L}} L", "X L"),
    (r"\Aa", "X", "Aa a", "X a"),
    (r"\Q.\E", "X", "QzE", "X"),
    (r"\z", "X", "za", "Xa"),
    (r"\h\R\e\a", "X", "hRea", "X"),
    (r"\-\_\/\#\ ", "X", "-_/# ", "X"),
    (r"a b#c", "X", "a b#c", "X"),
    # characters by number
    (r"\x41é", "X", "Aé", "X"),
    (r"\x4", "X", "x4", "X"),
    (r"\u12", "X", "u12", "X"),
    (r"\u{3}", "X", "uuu", "X"),
    (r"\cA", "X", "\x01", "X"),
    (r"\c", "X", "\\c", "X"),
    (r"\0", "X", "a\x00", "aX"),
    (r"\101\8", "X", "A8", "X"),
    (r"😀", "X", "😀", "X"),
    (r"\t\n\v\f\r", "X", "\t\n\x0b\x0c\r", "X"),
    # classes
    (r"[a\]b]+", "X", "a]b[", "X["),
    (r"[[a]", "X", "[a]", "XX]"),
    (r"[a&&b]", "X", "a&b", "XXX"),
    (r"[\w-]+", "X", "a-b é", "X é"),
    (r"[a\-c]", "X", "a-bc", "XXbX"),
    (r"[\b]", "X", "\x08b", "Xb"),
    (r"[^\S\n]+", "_", "a \t\nb", "a_\nb"),
    (r"[\Sx]", "_", "a b", "_ _"),
    (r"[^a-c]", "_", "abcd]", "abc__"),
    (r"[\d-x]", "_", "5-xa", "___a"),
    (r"[$^.|]", "_", "$^.|a", "____a"),
    (r"[A-C]+", "_", "ABCD", "_D"),
    # groups and references
    (r"(?<year>\d{4})-(?<m_1>\d\d)", "$<m_1>/$<year>", "2024-05", "05/2024"),
    (r"(?<a>x)", "[$<b>]", "x", "[]"),
    (r"(x)", "[$<a>]", "x", "[$<a>]"),
    (r"(?<q>['\"]).*?\k<q>", "Q", "'a' \"b'\"", "Q Q"),
    (r"(a)\1", "X", "aaa", "Xa"),
    (r"(a)\12", "X", "aa2 a\n", "aa2 X"),
    (r"\1(a)", "X", "aa", "XX"),
    (r"(?:a|(b))c", "[$1]", "ac bc", "[] [b]"),
    # looking around
    (r"(?<=a|bc)x", "X", "ax bcx x", "aX bcX x"),
    (r"(?<!\$)\b\d+", "N", "$5 7", "$5 N"),
    (r"q(?!u)", "Q", "qu qa", "qu Qa"),
    (r"(?=a)*b", "X", "b", "X"),
    # quantifiers
    (r"a{2}", "X", "aaa", "Xa"),
    (r"a{,2}", "X", "a{,2} aa", "X aa"),
    (r"x{a}", "X", "x{a}", "X"),
    (r"a+?", "X", "aa", "XX"),
    (r"a{1,2}?b", "X", "aab", "X"),
    (r"}]", "X", "}]", "X"),
    (r"a|", "-", "ba", "-b--"),
    # replacements
    (r"(\w+)@(\w+)", "$2 at $1 $$ $& $3", "a@b", "b at a $ a@b $3"),
    (r"(a)", "$10$01$0", "a", "a0a$0"),
    (r"(a)(b)(c)(d)(e)(f)(g)(h)(i)(j)", "$10-$11", "abcdefghij", "j-a1"),
    (r"(a)", "$15", "a", "a5"),
    (r"b", "[$']", "abc", "a[c]c"),
    (r"a", r"\n$", "a", r"\n$"),
    (r"a", "$$1", "a", "$1"),
]
BAD = [r"a**", r"a++", r"*a", r"(a", r"a)", r"[a", r"[b-a]", r"a{2,1}", "a\\", r"(?<n>a)(?<n>b)", r"(?<n>a)\k<m>", r"(?i)a", r"^*", r"(?<=a)*b"]


def test_cases(spark):
    results = [replace_all(F.lit(text), Rule("regex", p, r)).alias(f"c{i}") for i, (p, r, text, _) in enumerate(CASES)]
    got = spark.range(1).select(*results).first()
    assert [(c[0], c[1], c[2], x) for c, x in zip(CASES, got, strict=True)] == CASES


def test_counts_take_the_same_pattern(spark):
    row = spark.range(1).select(count_matches(F.lit("a a\n"), Rule("regex", "a$", "")), count_matches(F.lit("aé b"), Rule("regex", r"\w", ""))).first()
    assert tuple(row) == (0, 2)


@pytest.mark.parametrize("pattern", BAD)
def test_what_is_no_pattern_is_refused(pattern):
    with pytest.raises(PatternError):
        Pattern(pattern)
    with pytest.raises(ConfigError):
        Rule("regex", pattern, "x")


def test_the_text_before_a_match_is_refused():
    with pytest.raises(ConfigError):
        Rule("regex", "a", "$`")
