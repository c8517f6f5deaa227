import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions import tokens as K
from textloom.functions.pretokens import SPECIAL_TOKENS
from textloom.operators import vocabulary as V


@pytest.fixture(scope="module")
def codec(spark):
    merges = V.train_vocabulary(spark.createDataFrame([("ab", 9), ("abc", 5), (" abc", 4)], "word string, n long"))
    return K.Codec.of(merges, spark)


def python_function(column):
    """The Python function of a column, without Spark."""
    seen = []
    original = F.arrow_udf

    def grab(kind):
        return lambda f: seen.append(f) or original(kind)(f)

    F.arrow_udf = grab
    try:
        column()
    finally:
        F.arrow_udf = original
    return seen[0]


def rows_of_words(rng):
    words = ["ab", " abc", "abcab", "x" * 40, "é", "<|pad|>", " "]
    rows = [[rng.choice(words) for _ in range(rng.choice((0, 1, 5, 60)))] for _ in range(300)]
    return [None if rng.random() < 0.1 else r for r in rows]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_encode_gives_a_batch_back_in_slices(codec, monkeypatch, kind):
    """A batch of any size was worked on as a whole, with arrays of eight bytes for each of its ids."""
    encode = python_function(lambda: codec.encode_words(F.col("w")))
    rows = rows_of_words(random.Random(4))
    batch = pa.array([["gone"], *rows], pa.list_(kind)).slice(1)
    (whole,) = encode(iter([batch]))
    monkeypatch.setattr(K, "SLICE_BYTES", 50)
    parts = list(encode(iter([batch, batch.slice(0, 0), batch.slice(7, 20)])))
    assert len(parts) > 50 and max(map(len, parts)) < 100
    assert pa.concat_arrays(parts).to_pylist() == whole.to_pylist() + whole.to_pylist()[7:27]
    assert [r is None for r in whole.to_pylist()] == [r is None for r in rows]
    literal = {t: i for i, t in enumerate(SPECIAL_TOKENS)}
    for row, ids in zip(rows, whole.to_pylist()):
        if row is not None and "<|pad|>" not in row:
            assert "".join(codec.tokens[i] for i in ids).replace("Ġ", " ").replace("Ã©", "é") == "".join(row)
        elif row is not None:
            assert literal["<|pad|>"] in ids


def test_decode_gives_a_batch_back_in_slices(codec, monkeypatch):
    decode = python_function(lambda: codec.decode(F.col("ids")))
    rng = random.Random(5)
    rows = [None if rng.random() < 0.1 else [rng.randrange(len(codec.tokens)) for _ in range(rng.randint(0, 30))] for _ in range(200)]
    batch = pa.array(rows, pa.list_(pa.int32()))
    (whole,) = decode(iter([batch]))
    monkeypatch.setattr(K, "SLICE_IDS", 40)
    parts = list(decode(iter([batch])))
    assert len(parts) > 50 and pa.concat_arrays(parts).to_pylist() == whole.to_pylist()
    assert [t is None for t in whole.to_pylist()] == [r is None for r in rows]


def test_long_words_are_not_kept(codec, spark):
    encode = python_function(lambda: codec.encode_words(F.col("w")))
    list(encode(iter([pa.array([["x" * 5000, "ab"]])])))
    (kept,) = K._CACHES.values()
    assert "ab" in kept and "x" * 5000 not in kept


def test_normal_forms_of_many_rows(spark):
    df = spark.range(0, 1500, 1, 1).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("ﬁ"), "id")).alias("t"))
    rows = df.select("id", T.nfkc(F.col("t")).alias("n")).collect()
    assert [(r.id, r.n) for r in rows] == [(i, f"fi{i}" if i % 7 else None) for i in range(1500)]


def random_merges(rng, letters, n):
    """Merges of random neighbours, by rank; each makes a new symbol."""
    ranks, symbols = {}, list(range(letters))
    while len(ranks) < n:
        pair = (rng.choice(symbols), rng.choice(symbols))
        if pair not in ranks:
            ranks[pair] = (len(ranks), len(symbols))
            symbols.append(len(symbols))
    return ranks, len(symbols)


@pytest.mark.parametrize("dense", [True, False])
def test_words_merged_side_by_side_equal_one_at_a_time(monkeypatch, dense):
    """No short word is merged on its own, and the ids are those of merging it alone."""
    monkeypatch.setattr(K, "PAIR_TABLE", 1 << 21 if dense else 0)
    monkeypatch.setattr(K, "MERGED_SYMBOLS", 500)
    rng, byte_id = random.Random(5), [b % 3 for b in range(256)]
    for n_merges in (0, 1, 6, 40):
        ranks, n_tokens = random_merges(rng, 3, n_merges)
        table = K.MergeTable.of(ranks, n_tokens)
        assert table.dense == dense
        words = [bytes(rng.choice((0, 1, 2, 2)) for _ in range(rng.choice((0, 1, 2, 7, 30, 64)))) for _ in range(400)]
        words += [b"\x00" * n for n in range(1, 65)]
        wanted = [K.merge_symbols([byte_id[b] for b in w], ranks) for w in words]
        with monkeypatch.context() as only:
            only.setattr(K, "merge_symbols", lambda symbols, _: [] if not symbols else pytest.fail("one at a time"))
            assert K.merge_words(words, byte_id, ranks, table) == wanted
        long = [w * 5 for w in words]
        assert K.merge_words(long, byte_id, ranks, table) == [K.merge_symbols([byte_id[b] for b in w], ranks) for w in long]


def test_merges_that_make_earlier_pairs_are_done_one_at_a_time():
    """Here 4 is made by the last merge too, after a merge that takes it: a step cannot hold all places."""
    ranks = {(0, 1): (0, 4), (4, 2): (1, 5), (2, 3): (2, 4)}
    assert K.MergeTable.of(ranks, 6) is None
    assert K.merge_words([bytes([2, 3, 2]), b""], list(range(256)), ranks, None) == [[5], []]
    assert K.MergeTable.of({(0, 1): (0, 4), (2, 3): (0, 5)}, 6) is None
