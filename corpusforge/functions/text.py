"""Text cleaning and text features as Spark column expressions.

All of these are JVM-side expressions (regex / translate / replace) except NFKC, which
Spark has no built-in for and which therefore runs as an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# Fixed values that must equal the original behaviour.
#
# Whitespace: the code points Python's ``\s`` matches in a str pattern (str.isspace()).
WHITESPACE_CLASS = (r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Mojibake repairs, applied in this order.
MOJIBAKE_REPLACEMENTS = [
    ("\u00e2\u20ac\u2122", "'"),
    ("\u00e2\u20ac\u0153", '"'),
    ("\u00e2\u20ac", '"'),
    ("\u00c3\u00a9", "\u00e9"),
]
# Zero-width characters that are removed.
ZERO_WIDTH_CHARS = "\u200b\u200c\u200d\ufeff"
# Characters rewritten to a plain double quote.
QUOTE_CHARS = "\"'`\u00b4"
# Emoji code point ranges.
EMOJI_RANGES = [(0x1F300, 0x1F6FF), (0x1F900, 0x1F9FF), (0x1FA70, 0x1FAFF), (0x2600, 0x27BF)]
# ---------------------------------------------------------------------------------------

# A word token is one or more of: letter, number, underscore (Python's Unicode ``\w``).
WORD_TOKEN = r"[\p{L}\p{N}_]+"
EMOJI_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in EMOJI_RANGES) + "]"
# The same class, written so that printable ASCII, most of any text, is turned down by the first test.
_WS = r"[[^!-~]&&" + WHITESPACE_CLASS + "]"
# Runs of whitespace that are not one blank already.
_WS_RUN = f"(?:[{_WS}&&[^ ]]{_WS}*| {_WS}+)"
# Python's str.splitlines() boundaries.
LINE_BREAK = r"\r\n|[\n\r\x{B}\x{C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
# ``\b`` after "#hiring" spelled without look-around so that Java and RE2 agree.
_BOILERPLATE_RE = r"(?iu)^(thanks for reading.*|#hiring([^\p{L}\p{N}_].*)?)$"
_BOILERPLATE_RE_SINGLE = r"(?isu)^(thanks for reading|#hiring([^\p{L}\p{N}_]|$)).*"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# C1 -------------------------------------------------------------------------------------
@F.pandas_udf(T.StringType())
def _nfkc_batch(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else v)


def nfkc(col) -> Column:
    """Unicode NFKC.  Pure-ASCII rows are NFKC-stable, so only the others are shipped to
    the Arrow worker (ASCII rows travel as nulls and keep their value)."""
    c = _c(col)
    return F.coalesce(_nfkc_batch(F.when(~c.rlike(r"^[\x{0}-\x{7F}]*$"), c)), c)


# C2 -------------------------------------------------------------------------------------
def collapse_whitespace(col) -> Column:
    """Runs of Unicode whitespace -> one blank, then strip."""
    return F.trim(blank_runs(_c(col)))


def blank_runs(c: Column) -> Column:
    """Runs of Unicode whitespace -> one blank; single blanks are not written again."""
    return F.regexp_replace(c, _WS_RUN, " ")


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


# C3 -------------------------------------------------------------------------------------
def repair_mojibake(col) -> Column:
    c = _c(col)
    for bad, good in MOJIBAKE_REPLACEMENTS:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


# C4 -------------------------------------------------------------------------------------
def remove_zero_width(col) -> Column:
    return F.regexp_replace(_c(col), f"[{ZERO_WIDTH_CHARS}]", "")


# C5 -------------------------------------------------------------------------------------
def normalize_quotes(col, keep_apostrophes: bool = False) -> Column:
    chars = QUOTE_CHARS.replace("'", "") if keep_apostrophes else QUOTE_CHARS
    return F.regexp_replace(_c(col), f"[{chars}]", '"')


# C6 -------------------------------------------------------------------------------------
def remove_boilerplate(col, single_line: bool = False) -> Column:
    """Drop lines whose stripped form starts like boilerplate; join with newlines, strip.

    ``single_line=True`` is an exact shortcut for text that has no line breaks (the state
    after :func:`collapse_whitespace`): the only line is either kept or emptied.
    """
    c = _c(col)
    if single_line:
        return F.regexp_replace(c, _BOILERPLATE_RE_SINGLE, "")     # names the (costly) text once
    lines = F.split(c, LINE_BREAK)
    kept = F.filter(lines, lambda line: ~strip_ws(line).rlike(_BOILERPLATE_RE))
    return strip_ws(F.array_join(kept, "\n"))


# C1-C6 composition ----------------------------------------------------------------------
def clean_text(col, unicode_normalize: bool = False, boilerplate: bool = False,
               keep_apostrophes: bool = False, repair_first: bool = False) -> Column:
    """The fixed cleaning order: NFKC, whitespace, mojibake, zero-width, quotes, boilerplate.

    ``repair_first`` repairs mojibake before NFKC, which otherwise breaks some of its sequences."""
    c = _c(col)
    if repair_first:
        c = repair_mojibake(c)
    if unicode_normalize:
        c = nfkc(c)
    c = collapse_whitespace(c)
    c = repair_mojibake(c)
    c = remove_zero_width(c)
    c = normalize_quotes(c, keep_apostrophes=keep_apostrophes)
    if boilerplate:
        # whitespace collapse removed every line break, so the single-line form is exact
        c = remove_boilerplate(c, single_line=True)
    return c


# E1-E3 ----------------------------------------------------------------------------------
def emoji_count(col) -> Column:
    # characters below the first range are turned down by one test
    return F.regexp_count(_c(col), F.lit(f"[[\\x{{{min(EMOJI_RANGES, key=min)[0]:X}}}-\\x{{10FFFF}}]&&{EMOJI_CLASS}]"))


def word_count(col) -> Column:
    return F.regexp_count(_c(col), F.lit(WORD_TOKEN))


def word_tokens(col, lower: bool = True) -> Column:
    c = F.lower(_c(col)) if lower else _c(col)
    return F.regexp_extract_all(c, F.lit(WORD_TOKEN), 0)


def emoji_density(col, normalization: str = "per_word") -> Column:
    """count / max(1, #words) (or #chars for ``per_char``), rounded half-even to 6 places."""
    c = _c(col)
    denom = F.length(c) if normalization == "per_char" else word_count(c)
    return F.bround(emoji_count(c) / F.greatest(F.lit(1), denom), 6)


# C7 -------------------------------------------------------------------------------------
NESTED_TEXT_FIELDS = ("text", "opening_hook")


def clean_rows(df, enabled: bool = True, **opts):
    """Clean a top-level ``text`` column and ``generated.text`` / ``generated.opening_hook``
    inside the ``generated`` struct (fields that are absent are left alone)."""
    if not enabled:
        return df
    from pyspark.sql import types as _T
    out = df
    if "text" in df.columns and isinstance(df.schema["text"].dataType, _T.StringType):
        out = out.withColumn("text", clean_text(F.col("text"), **opts))
    if "generated" in df.columns and isinstance(df.schema["generated"].dataType, _T.StructType):
        names = df.schema["generated"].dataType.fieldNames()
        g = F.col("generated")
        for f in NESTED_TEXT_FIELDS:
            if f in names:
                g = g.withField(f, clean_text(F.col(f"generated.{f}"), **opts))
        out = out.withColumn("generated", g)
    return out
