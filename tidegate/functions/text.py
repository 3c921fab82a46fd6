"""Text scalar functions as Column expressions.

Character classes are spelled out because the bare Java escapes are ASCII only:
``WS`` is the Unicode whitespace set, ``WORD`` letters, digits and underscore.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_WS = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# every character of the WS class, for the native trim
WS_CHARS = "".join(
    chr(c)
    for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

# no character below U+0300 changes under NFC
_MAYBE_NOT_NFC = r"[^\x{0}-\x{2FF}]"
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def bind(expr: Column, use) -> Column:
    """Evaluate ``expr`` once and hand it to ``use`` (a let-binding inside one row)."""
    return F.get(F.transform(F.array(expr), use), F.lit(0))


def java_regex(pattern: str, ignore_case: bool = True) -> str:
    r"""Java form of a pattern written with Unicode-aware ``\s \S \d \w \b``."""
    classes = {r"\s": WS, r"\S": NOT_WS, r"\d": r"\p{Nd}", r"\w": WORD, r"\b": BOUNDARY}

    def spelled(m: re.Match) -> str:
        # a boundary before a digit: looking for the digit first is much cheaper
        if m.group(0) == r"\b" and pattern.startswith((r"\d", r"(?:\d"), m.end()):
            return rf"(?=\p{{Nd}})(?<!{WORD})"
        return classes.get(m.group(0), m.group(0))

    return ("(?iu)" if ignore_case else "") + re.sub(r"\\.", spelled, pattern)


# the only characters outside ASCII that match an ASCII letter when case is ignored
FOLD_TO_ASCII = "\u0130\u0131\u017f\u212a"


def holds_any(c: Column, literals: list[str] | tuple[str, ...]) -> Column:
    """Whether the text holds one of the literals."""
    return reduce(or_, [F.contains(c, F.lit(t)) for t in literals])


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(c, F.lit(WS_CHARS))


def is_blank(c: Column) -> Column:
    """True for null and for whitespace-only text."""
    return c.isNull() | (strip(c) == "")


def remove_control(c: Column) -> Column:
    """Drop control characters other than tab, line feed and carriage return."""
    return F.regexp_replace(c, _CONTROL, "")


def nfc(c: Column) -> Column:
    """Canonical composition.

    Spark has no built-in for it. Only texts holding a character that NFC could
    change are sent to Python; all others travel as nulls.
    """
    composed = _nfc_udf()(F.when(c.rlike(_MAYBE_NOT_NFC), c))
    return F.coalesce(composed, c)


def _nfc_udf():
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return F.pandas_udf(compose, T.StringType())


def collapse_blank_lines(c: Column) -> Column:
    """Three or more line feeds become two."""
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def sanitise(c: Column) -> Column:
    """Clean one field: strip, drop control characters, compose, collapse blank lines."""
    return collapse_blank_lines(nfc(remove_control(strip(c.cast("string")))))


def char_length(c: Column) -> Column:
    """Length in code points."""
    return F.length(c).cast("bigint")


def estimate_tokens(c: Column) -> Column:
    """A quarter of the code points, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4)).cast("bigint")


def sentences(c: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace; the mark stays."""
    return F.split(c, rf"(?<=[.!?]){WS}+")


def keywords(c: Column, min_length: int = 4) -> Column:
    """Distinct lower-case words of at least ``min_length`` characters."""
    return F.array_distinct(words(c, min_length))


def words(c: Column, min_length: int = 2) -> Column:
    """Lower-case words of at least ``min_length`` characters, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"{WORD}{{{min_length},}}"), F.lit(0))


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by every pair of neighbours joined by one space."""
    following = F.slice(tokens, F.lit(2), F.size(tokens))
    pairs = F.zip_with(tokens, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, F.array_compact(pairs))
