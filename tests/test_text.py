import random
import re
import unicodedata

import pytest

from tidegate.functions import text as T


def samples(n=400, seed=7):
    rng = random.Random(seed)
    alphabet = list(" \t\n\r\x00\x01\x0b\x0c\x1c\x1f\x7f\x85\xa0\u2003\u3000aZ\u00e9.!?_9") + [
        "e\u0301", "A\u030a", "\u0308\u0301", "\n\n\n", "\u1112\u1161\u11ab", "\U0001f600", "\u212b"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(n)] + [""]


def test_whitespace_set_is_the_unicode_one():
    assert set(T.WS_CHARS) == {chr(c) for c in range(0x11000) if chr(c).isspace()}


def test_strip(column):
    values = samples()
    assert column(T.strip, values) == [v.strip() for v in values]


SANITISED = [
    # (input, cleaned)
    ("plain text", "plain text"),
    ("", ""),
    (" \t\n ", ""),
    ("  both ends \t", "both ends"),
    (" wide　", "wide"),
    ("tab\tand\nline stay", "tab\tand\nline stay"),
    ("bell\x07 and null\x00 go", "bell and null go"),
    ("\x0bvertical\x0cfeed\x7f", "vertical" + "feed"),
    ("a\r\nb", "a\r\nb"),
    ("one\n\ntwo", "one\n\ntwo"),
    ("one\n\n\ntwo\n\n\n\n\nthree", "one\n\ntwo\n\nthree"),
    ("x\n\x01\n\ny", "x\n\ny"),
    ("été", "été"),
    ("Ångstrom Å", "Ångstrom Å"),
    ("한", "한"),
    ("\U0001f600 smile", "\U0001f600 smile"),
    ("\x85next line\x85", "next line"),
]


def test_sanitise(column):
    assert column(T.sanitise, [raw for raw, _ in SANITISED]) == [clean for _, clean in SANITISED]


def test_sanitise_keeps_edge_spaces_that_control_removal_exposes(column):
    assert column(T.sanitise, ["\x01 a \x01", "\x01"]) == [" a ", ""]


def test_nfc_only_shows_python_what_may_change(column):
    values = ["plain", "\u00e9", "e\u0301", None]
    assert column(T.nfc, values) == ["plain", "\u00e9", "\u00e9", None]


def test_blank(column):
    assert column(T.is_blank, [None, "", " \u3000", "x", "\x01"]) == [True, True, True, False, False]


def test_lengths_count_code_points(column):
    values = ["", "abc", "abcd", "😀😀😀😀😀😀😀😀"]
    assert column(T.char_length, values) == [0, 3, 4, 8]
    assert column(T.estimate_tokens, values) == [1, 1, 1, 2]


def test_sentences(column):
    values = samples() + ["One. Two!  Three?\n\nFour", "a.b c", "x. ", "One.\u00a0Two"]
    assert column(T.sentences, values) == [re.split(r"(?<=[.!?])\s+", v) for v in values]


def test_words_and_keywords(column):
    values = ["Été à la PLAGE, étés_9 naïve", "a bb ccc", "", "ab ab ab"]
    words = column(T.words, values)
    assert words == [re.findall(r"\b\w\w+\b", v.lower()) for v in values]
    assert [set(k) for k in column(T.keywords, values)] == [
        set(re.findall(r"\b\w{4,}\b", v.lower())) for v in values]


def test_bigrams(column):
    values = ["aa bb cc", "aa", "", "aa aa"]
    got = column(lambda c: T.with_bigrams(T.words(c)), values)
    assert got == [["aa", "bb", "cc", "aa bb", "bb cc"], ["aa"], [], ["aa", "aa", "aa aa"]]


@pytest.mark.parametrize("pattern", [r"a\s+b", r"\b\d{2}\b", r"\w+\S"])
def test_java_regex_is_unicode_aware(column, pattern):
    values = ["a b", "a\u00a0b", "\u00e912", " 12 ", "x y", "a\x1cb", "\u0663\u0664", "\u00e9t\u00e9!"]
    got = column(lambda c: c.rlike(T.java_regex(pattern)), values)
    assert got == [bool(re.search(pattern, v, re.I)) for v in values]
