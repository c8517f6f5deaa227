"""Collocations against plain counting, and the automata against dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from textloom.llm import collocations as C


def brute(rows, top):
    """Plain counting in Python's unbounded integers."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(words[i : i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= 30}
        found = []
        for p, a in cand.items():
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cand.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["New", "york", "of", "the", "a", "b", "a\x01", "Été", "été", "日本", "\x00", "state-of"]
    weight = [8, 8, 5, 9, 6, 6, 2, 2, 2, 2, 1, 1]
    rows = []
    for i in range(150):
        text = "".join(w + rng.choice((" ", " ", " ", " ", "\t", "  ", ". ", "\n", ",")) for w in rng.choices(words, weight, k=40))
        if i % 2:
            text += "one two three four five " * 2 + "; New York of the"
        rows.append((i, text, ("en", None, "und", "x y\t+", "")[i % 5]))
    rows += [(None, rows[0][1], "en"), (1, rows[1][1], "en"), (1, rows[1][1], "en")]
    return rows + [(900, None, "en"), (901, "", "de"), (902, " .,;", "de"), (903, "lone", "fr")]


@pytest.mark.parametrize("portion, shard, lookups", [(C.PORTION, C.SHARD_WORDS, C.LOOKUPS), (50, 200, 5)])
def test_against_plain_counting(spark, monkeypatch, rows, portion, shard, lookups):
    """Small bounds: texts are cut at blanks, tasks have many shards, ranges are dealt to several tasks."""
    monkeypatch.setattr(C, "LOOKUPS", lookups)
    names = "doc_id long, text string, lang string, phrase string, f long, range int"
    frame = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], names).repartition(3)
    want = brute(rows, 12)
    assert len({r[0] for r in want}) == 4 and max(r[1] for r in want) == 12
    if portion != C.PORTION:
        monkeypatch.setattr(C, "PORTION", portion)
        monkeypatch.setattr(C, "SHARD_WORDS", shard)
    got = C.collocations(frame, top=12).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == want


def test_empty_table(spark, nothing):
    assert C.collocations(nothing).collect() == []


def test_portions_hold_all_words():
    for text in (b"", b"x" * 50, b"ab cd ef.gh ij, kl mn " * 9, b" " * 40):
        parts = [w for p in C._portions(text, 7) for w in C.words_of([p])]
        assert parts == C.words_of([text])


def as_matrix(phrases):
    grams = np.full((len(phrases), C.MAX_WORDS), -1, np.int64)
    for i, p in enumerate(phrases):
        grams[i, : len(p)] = p
    return grams


@pytest.mark.parametrize("seed", range(4))
def test_automaton(seed):
    rng = random.Random(seed)
    counts = {tuple(rng.choices(range(6), k=rng.randint(1, 4))): rng.randint(1, 3) for _ in range(400)}
    phrases = sorted(counts)
    grams = as_matrix(phrases)
    automaton = C.Automaton.of_sorted(grams, np.array([counts[p] for p in phrases]))
    assert len(automaton.first) - 1 <= len({p[:d] for p in phrases for d in range(4)}) + 1
    again = C.Automaton.of_columns(*automaton.columns())
    paths, weights = again.paths()
    assert {tuple(x for x in p if x >= 0): w for p, w in zip(paths.tolist(), weights.tolist(), strict=True)} == counts
    asked = [tuple(rng.choices(range(8), k=rng.randint(1, 4))) for _ in range(300)] + phrases
    assert again.compose(as_matrix(asked)).tolist() == [counts.get(p, 0) for p in asked]
    assert again.compose(np.array([[0, -2, -1, -1], [-2, 0, -1, -1]])).tolist() == [0, 0]


def test_equal_states_are_one():
    phrases = [(i, 1, 2) for i in range(50)]
    automaton = C.Automaton.of_sorted(as_matrix(phrases), np.full(50, 7))
    # No arcs, the state before 2, the state before 1, the start.
    assert len(automaton.first) - 1 == 4 and len(automaton.label) == 52


def test_frequent_phrases_all_pass(spark):
    phrases = [f"en\tw{i} en\tv{i}".encode() for i in range(500)]
    table = C.Frequent(spark.createDataFrame([(p,) for p in phrases], "phrase binary"))
    hashes = np.column_stack([C._hashes([p.split(b" ")[d] for p in phrases]) for d in range(2)])
    assert table.has(hashes).all()
    assert table.has(hashes[:, ::-1]).sum() < 5
