import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T

BLANKS = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and chr(c).isspace()]
NOT_BLANKS = ["​", "﻿", "᠎"]
TEXTS = (
    ["", " ", "plain", "a  b", "  both ends\t", "x y", "one\r\ntwo\rthree\nfour", "end\n", "\n\n"]
    + [f"{b}mid{b}dle{b}" for b in BLANKS + NOT_BLANKS]
    + ["".join(BLANKS), "naïve café", "😀 é \U0001f468‍\U0001f469"]
)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")


def collect(df, **columns):
    return [r for r in df.select("i", *[c.alias(k) for k, c in columns.items()]).orderBy("i").collect()]


def test_blanks_are_the_29_of_python():
    assert sorted(T.BLANKS) == sorted(BLANKS)
    assert len(T.BLANKS) == 29


def test_strip_and_words_match_python(texts):
    for row in collect(texts, s=T.strip(F.col("t")), w=T.word_count(F.col("t"))):
        assert row.s == TEXTS[row.i].strip()
        assert row.w == len(TEXTS[row.i].split())


def test_lines_break_at_cr_and_lf_only(texts):
    import io

    for row in collect(texts, l=T.lines(F.col("t"))):
        expected = io.StringIO(TEXTS[row.i], newline=None).read().split("\n")
        assert row.l == expected


def test_minimum_length_is_strict_and_counts_code_points(spark):
    rows = [("a" * 100,), ("a" * 101,), ("😀" * 101,), (" " * 101,), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string").where(T.long_enough(F.col("t")))
    assert [r.t for r in df.collect()] == ["a" * 101, "😀" * 101, " " * 101]


def test_preview(spark):
    rows = [("x" * 50,), ("x" * 51,), ("é" * 60,), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(T.preview(F.col("t"))).collect()]
    assert got == ["x" * 50, "x" * 50 + "...", "é" * 50 + "...", None]


def test_first_nonempty_and_defaults(spark):
    df = spark.createDataFrame([("", None, "t"), ("c", "d", "t"), (None, "", None)], "content string, code string, text string")
    got = [r[0] for r in df.select(T.first_nonempty("content", "code", "text")).collect()]
    assert got == ["t", "c", ""]
    assert [r[0] for r in df.select(T.text_or_empty("code")).collect()] == ["", "d", ""]


def test_markers(spark):
    df = spark.createDataFrame([("<|hindi|>", "x"), (None, "y")], "m string, t string")
    assert [r[0] for r in df.select(T.with_marker(F.col("m"), F.col("t"))).collect()] == ["<|hindi|>x", "y"]


def test_nfkc_matches_python(spark):
    rng = random.Random(7)
    pool = "abé़́क्ﬁ①１Ａ한한½ ΩÅொ…̧́ \n"
    rows = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    rows += ["".join(chr(rng.randrange(0x20, 0x3000)) for _ in range(5)) for _ in range(600)]
    rows += [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    for row in df.select("i", T.nfkc(F.col("t")).alias("n")).collect():
        assert row.n == unicodedata.normalize("NFKC", rows[row.i]), ascii(rows[row.i])


def test_nfkc_skips_python_only_where_it_may(spark):
    rng = random.Random(3)
    rows = ["".join(chr(rng.randrange(0xA0, 0x1200)) for _ in range(3)) for _ in range(3000)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    for row in df.where(~T.needs_nfkc(F.col("t"))).collect():
        assert unicodedata.normalize("NFKC", row.t) == row.t
    plain = spark.createDataFrame([("ascii",), ("Größe déjà",), ("हिन्दी",)], "t string")
    assert plain.where(T.needs_nfkc(F.col("t"))).count() == 0
