"""Byte-level pre-tokens and their symbols, as built-in expressions.

During vocabulary work a word is one string with one character per symbol: symbol id ``i`` is
the character ``symbol_char(i)``. Characters grow with ids, and Spark compares strings by UTF-8
bytes, so ordering pairs of symbols as strings is ordering them by (left id, right id).
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import nfkc_parts

# Fixed value: the public byte-level split pattern, with its blanks (Unicode white space) spelled out.
_SPACE = r"\x09-\x0d \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

# The special tokens; ids 0..20 in this order.
SPECIAL_TOKENS = (
    "<|endoftext|>",
    "<|pad|>",
    "<|bos|>",
    "<|eos|>",
    "<|unk|>",
    "<|english|>",
    "<|hindi|>",
    "<|tamil|>",
    "<|telugu|>",
    "<|bengali|>",
    "<|marathi|>",
    "<|gujarati|>",
    "<|kannada|>",
    "<|code|>",
    "<|python|>",
    "<|javascript|>",
    "<|html|>",
    "<|css|>",
    "<|system|>",
    "<|user|>",
    "<|assistant|>",
)
PAD_TOKEN = "<|pad|>"
SPECIAL_PREFIX = "<|"

_FIRST_SYMBOL = 0x100
_SURROGATES = 0xD800


def symbol_char(symbol: int) -> str:
    """The character that stands for a symbol id (surrogates are skipped)."""
    cp = _FIRST_SYMBOL + symbol
    return chr(cp if cp < _SURROGATES else cp + 0x800)


def symbol_id(char: str) -> int:
    cp = ord(char)
    return (cp if cp < _SURROGATES else cp - 0x800) - _FIRST_SYMBOL


@lru_cache(maxsize=1)
def byte_chars() -> tuple[str, ...]:
    """The printable character of each byte 0..255: itself where printable, else 256 onward."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return tuple(chr(b if b in printable else next(spare)) for b in range(256))


def byte_alphabet() -> list[str]:
    """The 256 byte characters in id order (by code point)."""
    return sorted(byte_chars())


def byte_ids(n_special: int = len(SPECIAL_TOKENS)) -> list[int]:
    """Symbol id of each byte 0..255 when the special tokens come first."""
    rank = {ch: i for i, ch in enumerate(byte_alphabet())}
    return [n_special + rank[ch] for ch in byte_chars()]


def byte_text(text: Column) -> Column:
    """A text as one character per UTF-8 byte (code points 0..255)."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _map_bytes(text: Column, targets: list[str]) -> Column:
    return F.translate(byte_text(text), "".join(map(chr, range(256))), "".join(targets))


def printable_bytes(text: Column) -> Column:
    """The byte-level form of a text: one printable character per UTF-8 byte."""
    return _map_bytes(text, list(byte_chars()))


def word_symbols(word: Column, n_special: int = len(SPECIAL_TOKENS)) -> Column:
    """The symbol string of a word before any merge."""
    return _map_bytes(word, [symbol_char(i) for i in byte_ids(n_special)])


def _stand_apart(specials: tuple[str, ...] | list[str]) -> bool:
    """True when special tokens can neither overlap nor hold one another: each is in brackets of its own."""
    return all(len(s) > 2 and s[0] == "<" and s[-1] == ">" and not re.search("[<>]", s[1:-1]) for s in specials)


def segments(text: Column, specials: tuple[str, ...] | list[str] = SPECIAL_TOKENS) -> Column:
    """A text cut around literal special tokens; texts without any stay whole."""
    if not specials:
        return F.array(text)
    literal = "|".join(re.escape(s) for s in specials)
    if _stand_apart(specials):
        # Looking around at every character costs many times what finding the brackets does.
        literal = f"<(?:{'|'.join(re.escape(s[1:-1]) for s in specials)})>"
        between, found = F.split(text, literal), F.regexp_extract_all(text, F.lit(literal), F.lit(0))
        pieces = F.flatten(F.zip_with(between, found, lambda part, mark: F.array(part, mark)))
    else:
        pieces = F.split(text, f"(?={literal})|(?<={literal})")
    cut = F.filter(pieces, lambda part: part != F.lit(""))
    marks = [s for s in specials if not s.startswith(SPECIAL_PREFIX)]
    present = F.contains(text, F.lit(SPECIAL_PREFIX)) if not marks else F.rlike(text, F.lit(literal))
    return F.when(present, cut).otherwise(F.array(text))


def split_words(text: Column, pattern: str = PRETOKEN) -> Column:
    """Pre-tokens of a normalized text, blanks and all; together they make up the text."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def pretokens(
    text: Column,
    specials: tuple[str, ...] | list[str] = SPECIAL_TOKENS,
    normalize: bool = True,
    pattern: str = PRETOKEN,
) -> Column:
    """Pre-tokens of a raw text. A literal special token is kept as one piece and not normalized.

    No ordinary pre-token can equal a special token (the pattern splits letters from marks), so
    the encoder can tell them apart by value.
    """
    parts = segments(text, specials)
    normal = nfkc_parts(parts, text) if normalize else parts
    if not specials:
        return split_words(F.element_at(normal, 1), pattern)
    kept = [F.lit(s) for s in specials]
    return F.flatten(
        F.zip_with(
            parts,
            normal,
            lambda raw, norm: F.when(raw.isin(*kept), F.array(raw)).otherwise(split_words(norm, pattern)),
        )
    )
