import random

import pytest

from textloom.operators import pair_index
from textloom.operators import vocabulary as V


def random_words(seed, n=300):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randint(1, 12))) for _ in range(n)}
    return [(w, rng.randint(1, 50)) for w in sorted(words)]


def held(words):
    out = {}
    for symbols, n in words:
        for size in (2, 3):
            for i in range(len(symbols) - size + 1):
                out[symbols[i : i + size]] = out.get(symbols[i : i + size], 0) + n
    return out


def test_a_round_that_changes_many_words_stores_no_index(spark):
    """An index holds a word once for each of its pairs, so it has to wait until rounds change few words."""
    rows = random_words(3)
    index = pair_index.PairIndex(spark.createDataFrame(rows, V.WORDS_SCHEMA))
    merges = [("ab", "X"), ("cd", "Y"), ("XY", "Z"), ("ee", "W")]
    index.apply(merges)
    assert set(index.paths) == {"words", "counts"}
    ranks = {pair: i for i, (pair, _) in enumerate(merges[:-1])}
    want = [(pair_index.merged(w, merges, ranks), n) for w, n in rows]
    assert {r.key: r.n for r in index.counts.collect()} == held(want)
    assert sorted(map(tuple, index.words.collect())) == sorted((w, n) for w, n in want if len(w) > 1)
    assert index.n_changed == sum(a != b for (a, _), (b, _) in zip(rows, want))
    index.drop()


@pytest.mark.parametrize("rebuild", [0.0, 0.25, 9.0])
@pytest.mark.parametrize("share", [0.0, 0.2, 2.0])
def test_scans_and_index_learn_the_same(spark, monkeypatch, rebuild, share):
    """Merges equal one-at-a-time training whether rounds scan, use an index, or go back and forth."""
    monkeypatch.setattr(pair_index, "SLOT_WORDS", 30)
    monkeypatch.setattr(pair_index, "INDEX_SHARE", share)
    monkeypatch.setattr(pair_index.PairIndex.__init__, "__defaults__", (rebuild,))
    rows = random_words(7, 150)
    ours = V.train_vocabulary(spark.createDataFrame(rows, "word string, n long"), max_merges=12, head=20)
    words = [(tuple(w), n) for w, n in rows]
    ids = {t: i for i, t in enumerate(V.base_tokens())}
    for merge in ours.merges:
        pairs = {}
        for symbols, n in words:
            for pair in zip(symbols, symbols[1:]):
                pairs[pair] = pairs.get(pair, 0) + n
        best = min(pairs, key=lambda p: (-pairs[p], ids[p[0]], ids[p[1]]))
        assert ("".join(best), pairs[best]) == (merge.token, merge.count)
        ids.setdefault(merge.token, len(ids))
        done = []
        for symbols, n in words:
            out = []
            for s in symbols:
                # From the left; a symbol that was just made takes no part.
                if out and (out[-1], s) == best:
                    out[-1] = (merge.token,)
                else:
                    out.append(s)
            done.append((tuple(s[0] if isinstance(s, tuple) else s for s in out), n))
        words = done
