"""Text helpers: portable regexes, Unicode normalisation, whitespace."""

from __future__ import annotations

from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = r"\p{L}\p{N}_"


def java_regex(pattern: str) -> str:
    """Spell out the Unicode meaning of the portable class tokens for the JVM engine.

    The JVM's own shorthand classes are ASCII by default and the meaning of its
    word boundary changed between JDK releases, so neither is relied on. A
    boundary is taken as leading when a word follows it, else as trailing; every
    pattern in ``constants`` has a word character on that inner side.
    """
    flags, body = "(?d)", pattern
    if body.startswith("(?i)"):
        flags, body = "(?diu)", body[4:]
    out, in_class, i = [], False, 0
    while i < len(body):
        ch = body[i]
        token = body[i : i + 2]
        if ch == "\\":
            if token in (r"\w", r"\d", r"\s"):
                ranges = {r"\w": _WORD, r"\d": r"\p{Nd}", r"\s": _SPACE}[token]
                out.append(ranges if in_class else f"[{ranges}]")
            elif token == r"\S" and in_class:
                out.append(r"\x{0}-\x{10ffff}")  # only used as [\s\S]
            elif token == r"\S":
                out.append(f"[^{_SPACE}]")
            elif token == r"\b":
                leading = body[i + 2 :].lstrip("(")[:1].isalnum()
                out.append(f"(?<![{_WORD}])" if leading else f"(?![{_WORD}])")
            else:
                out.append(token)
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return flags + "".join(out)


def matches(col: Column, pattern: str) -> Column:
    return F.rlike(col, F.lit(java_regex(pattern)))


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE_CHARS))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def non_empty(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


# Ranges that compatibility normalisation leaves alone, none of them combining:
# ASCII, accented Latin, Cyrillic, Hebrew, kana, ideographs, Hangul, dashes and quotes.
STABLE_RANGES = (
    r"\x00-\x7f\xc0-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u0400-\u0481\u05d0-\u05ea\u3041-\u3096"
    r"\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3\u2013\u2014\u2018-\u201e"
)


# Whole-text forms. Runs of one simple range each are many times faster to match
# than one class with all ranges, and possessive loops neither recurse nor back up.
_STABLE_OTHER = STABLE_RANGES.removeprefix(r"\x00-\x7f")
_STABLE_TEXT = rf"\A(?:[\x00-\x7f]++|[{_STABLE_OTHER}]++)*+\z"
_PLAIN_TEXT = rf"\A(?:[ -~]++|[\t\n\r]++|[{_STABLE_OTHER}]++)*+\z"


def non_ascii(col: Column) -> Column:
    return F.octet_length(col) > F.char_length(col)


def may_normalize(col: Column) -> Column:
    return non_ascii(col) & ~F.rlike(col, F.lit(_STABLE_TEXT))


def is_plain(col: Column) -> Column:
    """Text that normalising keeps and that has no invisible characters."""
    return F.rlike(col, F.lit(_PLAIN_TEXT))


# Arrow's own utf8_normalize leaves NFKC text decomposed (it differs from Unicode's for 12,000 characters), hence Python's.
@F.arrow_udf(T.StringType())
def _compose(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else normalize("NFKC", v) for v in values.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _compose_and_fold(values: pa.Array) -> pa.Array:
    folded = [None if v is None else normalize("NFKC", v).casefold() for v in values.to_pylist()]
    return pa.array(folded, pa.string())


def nfkc(col: Column) -> Column:
    """Compatibility-normalise; only texts that can change cross to Python."""
    return F.coalesce(_compose(F.when(may_normalize(col), col)), col)


def nfkc_casefold(col: Column) -> Column:
    return F.coalesce(_compose_and_fold(F.when(non_ascii(col), col)), F.lower(col))


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """Keep later filters from repeating the work behind ``names``.

    A filter on a computed column is moved below the projection with the whole
    expression in it; it does not move below a generator.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names)))).select(*df.columns)
