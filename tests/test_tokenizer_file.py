"""Tokenizer files against the public library that defines them."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.operators import vocabulary as V
from textloom.sources.tokenizer_file import Unsupported, read_tokenizer, write_tokenizer

PUBLIC = "/opt/tokenizers/byte_bpe_50k.json"
TEXTS = [
    "", "  two  spaces ", "don't we'll I'M 'S", "tabs\t\tand\n\nlines \r\n end  ", "１２３ ½ ﬁne", "हिन्दी தமிழ்",
    "😀👩‍👩‍👧 é", "a" * 500 + "!" * 500, "<|endoftext|> x <|endoftext|>y", "<|eos|><|nope|>", "snake_case 12a3", "x\u00a0y\u3000z \u2003 end\u0085\u0085 ²³ ٣",
]


def same(spark, small, codec, tok):
    docs = [r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    frame = spark.createDataFrame([(t,) for t in TEXTS + docs], "text string")
    ids = codec.encode(F.col("text"))
    rows = frame.select("text", ids.alias("ids")).select("text", "ids", codec.decode("ids").alias("plain"), codec.decode("ids", False).alias("full"))
    for row in rows.collect():
        assert row.ids == tok.encode(row.text, add_special_tokens=False).ids, row.text[:60]
        assert row.plain == tok.decode(row.ids) and row.full == tok.decode(row.ids, skip_special_tokens=False)


@pytest.mark.skipif(not os.path.exists(PUBLIC), reason="no public tokenizer files here")
def test_a_public_file_is_read(spark, small):
    same(spark, small, read_tokenizer(spark, PUBLIC), Tokenizer.from_file(PUBLIC))


@pytest.fixture(scope="module")
def learned(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("n_chars > 100")
    return V.train_vocabulary(V.word_counts(V.corpus_lines(docs)), vocab_size=400)


def written(learned, spark, tmp_path):
    write_tokenizer(learned, spark, str(tmp_path / "tokenizer"))
    return next((tmp_path / "tokenizer").glob("part-*"))


def test_a_written_file_loads_in_the_library(spark, small, learned, tmp_path):
    file = written(learned, spark, tmp_path)
    tok = Tokenizer.from_file(str(file))
    assert tok.get_vocab() == {t: i for i, t in enumerate(learned.tokens)}
    same(spark, small, read_tokenizer(spark, str(tmp_path / "tokenizer")), tok)


def test_a_split_of_its_own(spark, small, learned, tmp_path):
    info = json.loads(written(learned, spark, tmp_path).read_text())
    pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    level = {**info["pre_tokenizer"], "use_regex": False}
    info |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, level]}}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(info))
    same(spark, small, read_tokenizer(spark, str(path)), Tokenizer.from_file(str(path)))


@pytest.mark.parametrize(
    "change",
    [
        {"normalizer": {"type": "Lowercase"}},
        {"pre_tokenizer": {"type": "Whitespace"}},
        {"pre_tokenizer": None},
        {"added_tokens": [{"id": 0, "content": "word", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False}]},
        {"model": {"type": "WordPiece", "vocab": {}}},
        {"model": {"type": "BPE", "vocab": {}, "merges": [], "end_of_word_suffix": "</w>"}},
        {"model": {"type": "BPE", "vocab": {"a": 3}, "merges": []}},
    ],
)
def test_what_is_not_the_same_is_refused(spark, learned, tmp_path, change):
    info = json.loads(written(learned, spark, tmp_path).read_text()) | change
    path = tmp_path / "other.json"
    path.write_text(json.dumps(info))
    with pytest.raises(Unsupported):
        read_tokenizer(spark, str(path))
