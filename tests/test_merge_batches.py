"""Batches of merges against one-at-a-time training, without Spark."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from textloom.operators.merge_batches import Batch, choose
from textloom.operators.pair_index import merged


def count(words, size):
    found = Counter()
    for w, n in words.items():
        for i in range(len(w) - size + 1):
            found[w[i : i + size]] += n
    return found


def collapse(words, pair, product):
    out = Counter()
    for w, n in words.items():
        out[w.replace(pair, product)] += n
    return out


def one_at_a_time(words, merges, texts):
    learned, texts = [], dict(texts)
    for _ in range(merges):
        found = count(words, 2)
        if not found:
            break
        pair, n = min(found.items(), key=lambda x: (-x[1], x[0]))
        if n < 2:
            break
        text = texts[pair[0]] + texts[pair[1]]
        known = next((s for s, t in texts.items() if t == text), None)
        product = known or chr(1000 + len(learned))
        texts.setdefault(product, text)
        learned.append((pair, product, n))
        words = collapse(words, pair, product)
    return learned


def in_batches(words, merges, texts, head):
    learned, texts, rounds = [], dict(texts), 0
    while len(learned) < merges:
        ranked = sorted(((p, n) for p, n in count(words, 2).items() if n >= 2), key=lambda x: (-x[1], x[0]))
        if not ranked:
            break
        floor = (ranked[head][1], ranked[head][0]) if len(ranked) > head else None
        pairs = {p for p, _ in ranked[:head]}
        triples = {t: n for t, n in count(words, 3).items() if t[:2] in pairs and t[1:] in pairs}
        start = len(learned)

        def joined(pair):
            return texts[pair[0]] + texts[pair[1]]

        def record(pair, n):
            known = next((s for s, t in texts.items() if t == joined(pair)), None)
            product = known or chr(1000 + len(learned))
            texts.setdefault(product, joined(pair))
            learned.append((pair, product, n))
            return product

        choose(Batch(ranked[:head], triples, floor), record, lambda p: p[0] == p[1] or joined(p) in texts.values(), 2, merges - start)
        batch = [m[:2] for m in learned[start:]]
        ranks = {p: i for i, (p, _) in enumerate(batch[:-1])}
        after = Counter()
        for w, n in words.items():
            after[merged(w, batch, ranks)] += n
        for pair, product, _ in learned[start:]:
            words = collapse(words, pair, product)
        assert after == words
        rounds += 1
    return learned, rounds


@pytest.mark.parametrize("seed", range(40))
def test_batches_equal_one_at_a_time(seed):
    rng = random.Random(seed)
    letters = "abcdefghijklmnop"[: rng.choice((2, 3, 5, 9, 16))]
    stems = ["".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(rng.choice((4, 12, 40)))]
    words = Counter()
    for _ in range(rng.choice((20, 120, 400))):
        words["".join(rng.choices(stems, k=rng.randint(1, 4)))] += rng.choice((1, 1, 2, 3, 10))
    texts = {c: c for c in letters}
    want = one_at_a_time(words, 60, texts)
    for head in (1, 4, 30, 1000):
        assert in_batches(words, 60, texts, head)[0] == want


def test_batches_are_wide():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    stems = ["".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(300)]
    words = Counter("".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(8000))
    learned, rounds = in_batches(words, 600, {c: c for c in letters}, 1024)
    assert len(learned) == 600 and rounds < 40
