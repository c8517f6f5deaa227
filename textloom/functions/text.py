"""Text columns: strip, lines, words, previews, Unicode normalization, markers.

Everything but NFKC is a built-in expression. Lengths count code points.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The 29 characters a text strip or a whitespace split treats as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: a document is kept when it is longer than this many code points.
MIN_CHARS = 100
# Fixed value: code points shown in a preview.
PREVIEW_CHARS = 50

LINE_BREAK = "\r\n|\r|\n"
# A run of blanks. Spelled out, the class is tested much faster than a Unicode-wide ``\\s``.
BLANK_RUN = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)


def text_or_empty(name: str) -> Column:
    """A source's text field; a null field reads as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def first_nonempty(*names: str) -> Column:
    """The first of several fields that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names], F.lit(""))


def long_enough(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """True when a text has more than ``min_chars`` code points; null and empty are false."""
    return F.coalesce(F.length(text) > min_chars, F.lit(False))


def strip(text: Column) -> Column:
    """Drop blanks at both ends: a set trim, so no regular expression runs over the text."""
    return F.trim(text, F.lit(BLANKS))


def lines(text: Column) -> Column:
    """Lines of a text, broken at CR LF, CR or LF only."""
    return F.split(text, LINE_BREAK)


def word_count(text: Column) -> Column:
    """How many runs of non-blank characters a text has."""
    inner = strip(text)
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, BLANK_RUN)))


def preview(text: Column, width: int = PREVIEW_CHARS) -> Column:
    """The first ``width`` code points, with dots after them when the text goes on."""
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
    ).otherwise(text)


def with_marker(marker: Column, text: Column) -> Column:
    """Put a marker token before a text; a missing marker leaves the text as it is."""
    return F.concat(F.coalesce(marker, F.lit("")), text)


@lru_cache(maxsize=1)
def stable_char_class() -> str:
    """Members of a character class: characters that NFKC can never change.

    A text made of these only equals its NFKC form: each is its own compatibility form, none
    composes with a character before it, and all have combining class 0 or 9, so there is
    nothing to reorder. Runs shorter than 8 are left out to keep the class small; texts with
    such characters are normalized by the function, not here.
    """
    seconds = set()
    for cp in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(int(parts[1], 16))
    seconds.update(range(0x1161, 0x1176))
    seconds.update(range(0x11A8, 0x11C3))

    def stable(cp: int) -> bool:
        ch = chr(cp)
        return (
            not 0xD800 <= cp <= 0xDFFF
            and unicodedata.category(ch) != "Cn"
            and unicodedata.combining(ch) in (0, 9)
            and cp not in seconds
            and unicodedata.normalize("NFKC", ch) == ch
        )

    spans, start = [], None
    for cp in range(0x10000):
        if stable(cp):
            start = cp if start is None else start
        elif start is not None:
            spans.append((start, cp - 1))
            start = None
    kept = [(a, b) for a, b in spans if b - a >= 7]
    ranges = [rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in kept]
    # Grouped, since a flat class is tested range by range.
    groups = ["".join(ranges[i : i + 16]) for i in range(0, len(ranges), 16)]
    return "".join(f"[{g}]" for g in groups)


def needs_nfkc(text: Column) -> Column:
    """False only when NFKC surely leaves the text as it is (decided in the JVM)."""
    unstable = rf"[\xa0-\x{{10ffff}}&&[^{stable_char_class()}]]"
    return (F.octet_length(text) != F.length(text)) & F.rlike(text, F.lit(unstable))


# Rows that are Python strings at once.
_NFKC_ROWS = 512


def _normal(parts: list[str | None] | None) -> list[str | None] | None:
    return None if parts is None else [None if s is None else unicodedata.normalize("NFKC", s) for s in parts]


@F.arrow_udf(ArrayType(StringType()))
def _nfkc_parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for parts in batches:
        for i in range(0, len(parts), _NFKC_ROWS):
            rows = parts.slice(i, _NFKC_ROWS).to_pylist()
            yield pa.array([_normal(row) for row in rows], type=pa.list_(pa.string()))


def nfkc_parts(parts: Column, text: Column) -> Column:
    """NFKC of each part of a text; Python only sees the rows that may change."""
    return F.coalesce(_nfkc_parts(F.when(needs_nfkc(text), parts)), parts)


def nfkc(text: Column) -> Column:
    """The NFKC form of a text. There is no built-in for it."""
    return F.element_at(nfkc_parts(F.array(text), text), 1)
