"""Spelling variants against a comparison of all words with all, and the signatures' guarantee."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from textloom.llm import spelling

LETTERS = "abcdeéê"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = "".join(c for i, c in enumerate(run) if i != h % len(run))
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["".join(rng.choices(LETTERS, k=rng.randint(6, 9))) for _ in range(25)]
    words += ["a" * n for n in range(5, 12)] + ["ab" * 3, "ba" * 3, "É" + "cole" * 2, "école" * 2]
    for w in list(words):
        for _ in range(6):
            i = rng.randrange(len(w))
            words.append(rng.choice((w[:i] + w[i + 1 :], w[:i] + rng.choice(LETTERS) + w[i:], w[:i] + "x" + w[i + 1 :])))
    weight = [rng.choice((1, 1, 2, 40, 300)) for _ in words]
    rows = [(i, " ".join(rng.choices(words, weight, k=120)).replace("x ", "X\n")) for i in range(60)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (70, None), (71, ""), (72, "1 2 _ ßü"), (73, "q" * 30_000)]
    return rows


@pytest.mark.parametrize("crowded", [spelling.CROWDED, 1])
def test_against_brute_force(spark, monkeypatch, rows, crowded):
    """A bound of one divides every signature that two words share."""
    monkeypatch.setattr(spelling, "CROWDED", crowded)
    monkeypatch.setattr(spelling, "HELD", 50)
    frame = spark.createDataFrame([(i, t, "w", 3) for i, t in rows], "doc_id long, text string, word string, n long")
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 8 and max(r[4] for r in want) > 3
    got = spelling.variants(frame.repartition(3)).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == want


def test_empty_table(spark, nothing):
    assert spelling.variants(nothing).collect() == []


def test_every_pair_within_two_dimensions_shares_a_signature():
    rng = random.Random(2)
    for part in ({}, {(c, n): rng.randrange(spelling.PARTS) for c in LETTERS for n in range(4)}):
        for _ in range(300):
            a = "".join(rng.choices(LETTERS, k=rng.randint(6, 14)))
            i, c = rng.randrange(len(a)), rng.choice("xyé")
            for b in (a[:i] + a[i + 1 :], a[:i] + c + a[i:], a[:i] + c + a[i + 1 :]):
                assert len(set(spelling.dimensions(a)) ^ set(spelling.dimensions(b))) <= 2
                shared = set(spelling.signatures(a, part)) & set(spelling.signatures(b, part))
                assert shared
                for _, tag in shared:
                    assert a[: tag - 1] == b[: tag - 1] or a[1 - tag :] == b[1 - tag :]
