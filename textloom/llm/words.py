"""Word shingles of UTF-8 text, in pieces of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

# Bytes of a text that are split into words at once.
PIECE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def shingle_hashes(text: bytes, size: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of all ``size``-word shingles, repeats included, in arrays of bounded length.

    A-Z are lower-cased and words are split at the six ASCII blanks; the words of a shingle are joined
    by one space. Fewer words than ``size`` give one shingle of all of them, no words none.
    """
    carried: list[bytes] = []
    at, seen = 0, False
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            blank = _BLANK.search(text, end)
            end = blank.start() if blank else len(text)
        words = carried + text[at:end].lower().split()
        at = end
        if len(words) >= size:
            seen = True
            yield _hashes(words, size, seed)
            carried = words[len(words) - size + 1 :]
        else:
            carried = words
    if not seen and carried:
        yield _hashes(carried, len(carried), seed)


def _hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    return np.fromiter(
        (
            digest(joined[a:b], seed)
            for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)
        ),
        np.uint64,
        n,
    )
