"""Text normalisation and tolerant float parsing as Spark column expressions.

``norm(x)`` = None -> "" ; Unicode NFC ; drop U+200B ; collapse runs of whitespace
(the Python ``str.isspace`` set) to one space ; trim.  The steps run in this order,
so one pass is not always a fixed point (removing U+200B can bring a base letter
next to a combining mark); callers that normalise an already normalised value
(dedupe and split keys) simply apply ``norm`` again.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must match the reference's text semantics exactly):
# the zero-width space that is removed after NFC, and the whitespace class equal
# to Python's str.isspace set (Unicode White_Space plus U+001C..U+001F), as ranges, which
# Java tests several times faster than the property.
ZWSP = "\u200b"
_WS_ODD = r"\x09-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITESPACE_CLASS = f"[ {_WS_ODD}]"

_WS_RUN = WHITESPACE_CLASS + "+"
# No character outside this class but U+0020 is white space; one range for the high ones,
# as texts are tested for it before anything is rebuilt.
_WS_MAYBE = r"[\x09-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}-\x{3000}]"
# The same characters in a row.
_WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Strict float syntax accepted by Python's float() for ASCII input (case-insensitive).
_FLOAT_SYNTAX = (
    r"(?i)^[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+(_[0-9]+)*)?$"
    r"|^[+-]?(inf|infinity|nan)$"
)


def _nfc_batch(values: pa.Array) -> pa.Array:
    if values.null_count == len(values):
        return values
    some = pc.drop_null(values)
    done = pa.array([unicodedata.normalize("NFC", v) for v in some.to_pylist()], type=values.type)
    return pc.replace_with_mask(values, pc.is_valid(values), done)


_nfc_udf = F.arrow_udf(_nfc_batch, T.StringType())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Code point ranges that NFC leaves alone: each code point is unchanged by NFC, has
# combining class 0 and never composes with a preceding character, so a string made
# only of them is already NFC (the Unicode quick check).  Latin up to U+02FF, general
# punctuation, CJK punctuation and kana, CJK unified ideographs, Hangul syllables and
# fullwidth forms; tests/test_text.py re-derives the property from unicodedata.
NFC_INERT_RANGES = (
    (0x0000, 0x02FF),
    (0x2010, 0x206F),
    (0x3000, 0x3029),
    (0x3030, 0x3098),
    (0x309B, 0x30FF),
    (0x4E00, 0x9FFF),
    (0xAC00, 0xD7A3),
    (0xFF00, 0xFFEF),
)


def _complement(ranges: tuple[tuple[int, int], ...]) -> list[tuple[int, int]]:
    out, nxt = [], 0
    for lo, hi in ranges:
        if lo > nxt:
            out.append((nxt, lo - 1))
        nxt = hi + 1
    if nxt <= 0x10FFFF:
        out.append((nxt, 0x10FFFF))
    return out


# A positive class of the sensitive ranges: Java evaluates it several times faster than
# the equivalent negated class of the inert ranges.
_NFC_SENSITIVE = "[" + "".join(f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}" for lo, hi in _complement(NFC_INERT_RANGES)) + "]"
# One range that holds them all: most Latin text is told apart by this alone.
_NFC_ABOVE = f"[\\x{{{NFC_INERT_RANGES[0][1] + 1:04X}}}-\\x{{10FFFF}}]"


def nfc(c: Column | str) -> Column:
    """Unicode NFC.  Only rows holding a code point outside ``NFC_INERT_RANGES`` are
    shipped to Python; all others (Latin, CJK ideographs, Hangul syllables, ...) pass
    as NULL, which costs nothing in an Arrow batch."""
    c = _col(c)
    needs = F.when(c.rlike(_NFC_ABOVE) & c.rlike(_NFC_SENSITIVE), c)
    return F.coalesce(_nfc_udf(needs), c)


def collapse_ws(c: Column | str) -> Column:
    """Collapse whitespace runs to one ASCII space and trim (JVM regex)."""
    c = _col(c)
    return F.trim(F.when(F.contains(c, F.lit("  ")) | c.rlike(_WS_MAYBE), F.regexp_replace(c, _WS_RUN, " ")).otherwise(c))


def norm(c: Column | str) -> Column:
    """The corpus normaliser: NULL -> "", NFC, drop U+200B, collapse whitespace, trim."""
    c = F.coalesce(_col(c), F.lit(""))
    return collapse_ws(F.replace(nfc(c), F.lit(ZWSP), F.lit("")))


def row_text(c: Column | str) -> Column:
    """Normalised text of any value (cast to string first); NULL -> ""."""
    return norm(_col(c).cast("string"))


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of the Python set."""
    return F.btrim(_col(c), F.lit(_WS_CHARS))


def safe_float(c: Column | str) -> Column:
    """Tolerant float parse: strip; empty, unparsable or NULL -> NULL.

    Only the syntax Python's ``float()`` accepts passes the gate; digit-group
    underscores are removed and a signed ``nan`` is mapped to ``nan`` before the
    cast, because Spark's cast rejects both while Python accepts them."""
    z = strip_ws(_col(c).cast("string"))
    cleaned = F.regexp_replace(F.replace(z, F.lit("_"), F.lit("")), r"(?i)^[+-]nan$", "nan")
    return F.when(z.rlike(_FLOAT_SYNTAX), cleaned.try_cast("double"))


def duration(start: Column | str, end: Column | str) -> Column:
    """NULL if a bound is NULL, else max(0.0, end - start) with Python's NaN rule
    (max(0.0, nan) is 0.0, so NaN and non-positive differences give 0.0)."""
    d = _col(end) - _col(start)
    return (
        F.when(d.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(d) | (d <= 0), F.lit(0.0))
        .otherwise(d)
    )
