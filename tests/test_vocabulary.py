import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers
from tokenizers.normalizers import NFKC

from textloom.functions import pretokens as P
from textloom.functions.tokens import Codec, attention_mask, merge_symbols, pad, truncate
from textloom.operators import pair_index
from textloom.operators import vocabulary as V
from textloom.operators.encoding import TOKENIZED_SCHEMA, encode_records, token_totals
from textloom.operators.evaluation import fertility_report, text_fertility
from textloom.queries import base, tokens  # noqa: F401
from textloom.sources.sinks import metadata, read_vocabulary, write_vocabulary

EDGES = [
    "",
    "  two  spaces ",
    "don't we'll I'M 'S",
    "tabs\t\tand\n\nlines \r\n end  ",
    "x\x1cy \x0bz\x85a  b　c",
    "１２３ ½ ﬁne ﷺ",
    "हिन्दी में क़लम தமிழ் తెలుగు বাংলা ગુજરાતી ಕನ್ನಡ",
    "😀👩‍👩‍👧 é",
    "a" * 3000 + "!" * 3000,
    "<|pad|>", " <|user|> hi <|assistant|>", "  <|eos|>  x", "!<|pad|>!<|nope|>", "＜|pad|＞ ﬁ<|bos|>ﬁ",
    "under_score snake_case 12a3 a1b2",
]


def library(vocab_size, specials=P.SPECIAL_TOKENS, normalize=True):
    tok = Tokenizer(models.BPE(unk_token="<|unk|>", byte_fallback=True))
    if normalize:
        tok.normalizer = NFKC()
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    tok.decoder = decoders.ByteLevel()
    trainer = trainers.BpeTrainer(
        vocab_size=vocab_size,
        min_frequency=2,
        special_tokens=list(specials),
        show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
    )
    return tok, trainer


def learned_pairs(vocabulary):
    return [tuple(vocabulary.tokens[P.symbol_id(ch)] for ch in m.pair) for m in vocabulary.merges]


@pytest.fixture(scope="module")
def trained(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("n_chars > 100")
    tok, trainer = library(520)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    tok.train_from_iterator((x.strip() for t in texts for x in re.split("\r\n|\r|\n", t.strip())), trainer=trainer)
    ours = V.train_vocabulary(V.word_counts(V.corpus_lines(docs)), vocab_size=520)
    return docs, tok, ours


def test_merges_and_vocabulary_equal_the_library(trained):
    _, tok, ours = trained
    model = json.loads(tok.to_str())["model"]
    assert learned_pairs(ours) == [tuple(m) for m in model["merges"]]
    assert {t: i for i, t in enumerate(ours.tokens)} == model["vocab"]
    assert ours.rounds < len(ours.merges) / 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_training_on_tiny_alphabets(spark, seed):
    rng = random.Random(seed)
    letters = "aabc"[: 2 + seed % 3]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 15))) for _ in range(40)]
    corpus = [" ".join(rng.choice(words) for _ in range(20)) for _ in range(15)]
    tok, trainer = library(277 + 30)
    tok.train_from_iterator(corpus, trainer=trainer)
    df = spark.createDataFrame([(x,) for x in corpus], "text string")
    ours = V.train_vocabulary(V.word_counts(V.corpus_lines(df)), vocab_size=277 + 30)
    assert learned_pairs(ours) == [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]


def test_training_stops_at_frequency_and_at_max_merges(spark):
    df = spark.createDataFrame([("ab ab cd",)], "text string")
    counts = V.word_counts(V.corpus_lines(df))
    assert [m.token for m in V.train_vocabulary(counts).merges] == ["ab"]
    assert V.train_vocabulary(counts, max_merges=0).merges == []
    assert V.train_vocabulary(counts, vocab_size=277).merges == []


@pytest.mark.parametrize("rebuild, head", [(0.0, 20), (9.0, 1000)])
def test_index_kept_and_rebuilt(spark, monkeypatch, rebuild, head):
    """Words and index written anew after every round, and never; a narrow head and a wide one."""
    rng = random.Random(5)
    monkeypatch.setattr(pair_index, "SLOT_WORDS", 30)
    monkeypatch.setattr(pair_index.PairIndex.__init__, "__defaults__", (rebuild,))
    corpus = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 12))) for _ in range(30)) for _ in range(20)]
    tok, trainer = library(277 + 20)
    tok.train_from_iterator(corpus, trainer=trainer)
    df = spark.createDataFrame([(x,) for x in corpus], "text string")
    ours = V.train_vocabulary(V.word_counts(V.corpus_lines(df)), vocab_size=277 + 20, head=head)
    assert learned_pairs(ours) == [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]


def test_a_round_reads_the_words_it_touches(spark):
    rows = [("abc", 5), ("bca", 4), ("xyz", 3), ("ab" * 400, 1), ("q", 9)]
    index = pair_index.PairIndex(spark.createDataFrame(rows, V.WORDS_SCHEMA))
    assert {r.symbols for r in index.touched(["xy"]).collect()} == {"xyz"}
    index.apply([("xy", "X"), ("Xz", "Y")])
    assert {r.symbols for r in index.touched(["ab"]).collect()} == {"abc", "ab" * 400}
    assert index.touched(["xy"]).count() == 0 and index.n_changed == 1
    index.apply([("ab", "A")])
    want = {"Ac": 5, "bc": 4, "ca": 4, "bca": 4, "AA": 399, "AAA": 398}
    assert {r.key: r.n for r in index.counts.collect()} == want
    index.drop()


def test_symbol_pairs_of_short_and_long_words(spark):
    rng = random.Random(8)
    chars = [P.symbol_char(i) for i in (30, 31, 60_000, 128_000)]
    words = ["".join(rng.choice(chars) for _ in range(n)) for n in (1, 2, 3, 255, 256, 257, 510, 511, 512, 2000)]
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], V.WORDS_SCHEMA)
    expected = {}
    for i, word in enumerate(words):
        for pair in map("".join, zip(word, word[1:])):
            expected[pair] = expected.get(pair, 0) + i + 1
    assert {r.pair: r.n for r in V.pair_counts(df).collect()} == expected


def test_pretokens_match_the_library(spark):
    pre = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    rng = random.Random(11)
    texts = [t for t in EDGES if "<|" not in t and "＜" not in t]
    texts += ["".join(rng.choice("ab1 '\t\n!é　\x1c😀-st") for _ in range(30)) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    shown = F.transform(P.split_words(F.col("t")), lambda w: P.printable_bytes(w))
    for row in df.select("i", shown.alias("p")).collect():
        assert row.p == [piece for piece, _ in pre.pre_tokenize_str(texts[row.i])], ascii(texts[row.i])


def test_symbols_round_trip():
    for i in (0, 276, 277, 0xD6FF, 0xD700, 55_039, 55_040, 128_000, 256_000):
        assert P.symbol_id(P.symbol_char(i)) == i
    assert P.symbol_char(55_000) < P.symbol_char(56_000) < P.symbol_char(256_000)


def test_encode_and_decode_equal_the_library(spark, trained):
    docs, tok, ours = trained
    codec = Codec.of(ours, spark)
    texts = docs.select("text").union(spark.createDataFrame([(t,) for t in EDGES], "text string"))
    rows = texts.select(
        "text",
        codec.encode(F.col("text")).alias("ids"),
        codec.encode(F.col("text"), parse_special=False).alias("raw"),
    ).select("text", "ids", "raw", codec.decode(F.col("ids")).alias("plain"), codec.decode(F.col("ids"), False).alias("full"))
    for row in rows.collect():
        assert row.ids == tok.encode(row.text).ids, row.text[:60]
        assert row.plain == tok.decode(row.ids)
        assert row.full == tok.decode(row.ids, skip_special_tokens=False)
        if "<|" not in row.text:
            assert row.raw == row.ids


def test_null_text_and_broken_bytes(spark, trained):
    codec = Codec.of(trained[2], spark)
    df = spark.createDataFrame([(None,), ("a",)], "t string").select(codec.encode(F.col("t")).alias("ids"))
    assert [r.ids is None for r in df.collect()] == [True, False]
    half = P.byte_ids()[0xC3]
    broken = spark.createDataFrame([([half],), ([],), (None,)], "ids array<int>").select(codec.decode(F.col("ids")))
    assert [r[0] for r in broken.collect()] == ["�", "", None]


def test_merge_order_is_rank_then_left():
    ranks = {(1, 2): (0, 5), (2, 1): (1, 6), (5, 5): (2, 7)}
    assert merge_symbols([1, 2, 1, 2, 1], ranks) == [7, 1]
    assert merge_symbols([2, 1, 1], ranks) == [6, 1]
    assert merge_symbols([1, 1, 1], {(1, 1): (0, 9)}) == [9, 1]
    assert merge_symbols([], ranks) == []


def test_truncate_pad_mask(spark):
    lengths = [0, 1, 2047, 2048, 2049]
    df = spark.createDataFrame([(list(range(n)),) for n in lengths], "ids array<int>")
    cut = df.select(truncate(F.col("ids")).alias("ids")).select("ids", F.size("ids").alias("n"))
    rows = cut.select("ids", "n", pad(F.col("ids"), 2048, 1).alias("p"), attention_mask(F.col("n"), 2048).alias("m")).collect()
    for n, row in zip(lengths, rows):
        kept = min(n, 2048)
        assert row.ids == list(range(kept))
        assert row.p == list(range(kept)) + [1] * (2048 - kept)
        assert row.m == [1] * kept + [0] * (2048 - kept)


def test_records_have_the_fixed_schema(spark, trained):
    docs, tok, ours = trained
    codec = Codec.of(ours, spark)
    df = docs.select("doc_id", "text", F.col("lang").alias("language"), F.col("source").alias("dataset"))
    records = encode_records(df, codec, keep=["doc_id"], max_length=32, marker=F.lit("<|english|>"))
    assert records.drop("doc_id").schema.simpleString() == TOKENIZED_SCHEMA.simpleString()
    texts = {r.doc_id: r.text for r in df.collect()}
    for row in records.collect():
        want = tok.encode("<|english|>" + texts[row.doc_id]).ids[:32]
        assert row.input_ids == want and row.labels == want
        assert row.attention_mask == [1] * len(want) and row.length == len(want)
    totals = token_totals(records).agg(F.sum("total_samples"), F.sum("total_tokens")).first()
    assert tuple(totals) == (records.count(), records.agg(F.sum("length")).first()[0])


def test_padding_is_optional(spark, trained):
    codec = Codec.of(trained[2], spark)
    df = spark.createDataFrame([("hi", "en", "d")], "text string, language string, dataset string")
    row = encode_records(df, codec, max_length=16, pad_to_max=True).first()
    assert len(row.input_ids) == len(row.attention_mask) == 16
    assert row.input_ids[row.length :] == [1] * (16 - row.length)


SENTENCES = [
    ("English", "A small boat drifted past the old stone bridge at dawn."),
    ("Hindi", "नदी के किनारे एक पुराना पेड़ है।"),
    ("Tamil", "மழை பெய்யும் போது குழந்தைகள் விளையாடுகிறார்கள்."),
    ("Telugu", "ఈ రోజు వాతావరణం చాలా బాగుంది."),
    ("Python", "for i in range(10):\n    print(i * i)\n"),
    ("Nothing", "   "),
]


def test_evaluation_report(spark, trained):
    _, tok, ours = trained
    codec = Codec.of(ours, spark)
    df = spark.createDataFrame(SENTENCES, "language string, text string")
    rows = {r.language: r for r in text_fertility(df, codec).collect()}
    for name, text in SENTENCES:
        tokens, words = len(tok.encode(text).tokens), len(text.split())
        assert (rows[name].tokens, rows[name].words) == (tokens, words)
        assert rows[name].fertility == (tokens / words if words else 0)
    report = {r.language: r for r in fertility_report(df, codec, ["Hindi", "Tamil", "Telugu"]).collect()}
    mean = sum(rows[x].fertility for x in ("Hindi", "Tamil", "Telugu")) / 3
    assert report["group mean"].fertility == pytest.approx(mean)
    assert report["group mean"].band == "POOR"


def test_vocabulary_tables_round_trip(spark, trained, tmp_path):
    _, tok, ours = trained
    write_vocabulary(ours, spark, str(tmp_path), 520, "tests")
    vocab, merges = read_vocabulary(spark, str(tmp_path))
    rows = vocab.orderBy("id").collect()
    assert [r.token for r in rows[:21]] == list(P.SPECIAL_TOKENS)
    assert [r.id for r in rows] == list(range(len(rows)))
    codec = Codec.from_tables(vocab, merges)
    text = "The quick brown fox <|eos|>"
    got = spark.createDataFrame([(text,)], "t string").select(codec.encode(F.col("t"))).first()[0]
    assert got == tok.encode(text).ids
    info = spark.read.json(f"{tmp_path}/metadata").first()
    assert info.vocab_size == 520 and info.max_length == 2048 and len(info.special_tokens) == 21
    assert metadata(spark, ours, 520).first().algorithm == "Byte-level BPE"


def test_the_trained_vocabulary_equals_the_library(spark, small):
    """From balanced corpus to ids: merges, and the ids of every document and page."""
    from textloom.queries import trained
    from textloom.queries.base import all_sources

    ours = trained.learned(spark, small)
    tok, trainer = library(trained.TRAINED_SIZE)
    texts = [r.text for r in trained.balanced(spark, small).collect()]
    tok.train_from_iterator((x.strip() for t in texts for x in re.split("\r\n|\r|\n", t)), trainer=trainer)
    assert len(ours.tokens) == trained.TRAINED_SIZE
    assert learned_pairs(ours) == [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]
    texts = {(r.dataset, r.doc_id): r.text or "" for r in all_sources(spark, small).collect()}
    for row in trained.trained_encoding(spark, small).collect():
        assert row.input_ids == " ".join(map(str, tok.encode(texts[row.dataset, row.doc_id]).ids))


def test_bracketed_specials_are_cut_without_looking_around(spark):
    """The pieces of a text are those of a cut before and behind every special token, and no pattern looks
    around at each character for them."""
    texts = [*EDGES, None, "<|pad|>", "<|pad|><|pad|>x", "a<|pad|", "<<|bos|>>", "<|<|eos|>|>", "x\n<|user|>\n", "<|code|>" * 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    literal = "|".join(map(re.escape, P.SPECIAL_TOKENS))
    cut = P.segments(F.col("t"))
    for row in df.select("t", cut.alias("parts")).collect():
        parts = [row.t] if row.t is None or "<|" not in row.t else [x for x in re.split(f"({literal})", row.t) if x]
        assert row.parts == parts
    plan = df.select(cut)._jdf.queryExecution().analyzed().toString()
    assert "(?=" not in plan and "(?<=" not in plan
    # Special tokens that can overlap are still cut at each place where one begins or ends.
    odd = spark.createDataFrame([("<a<a>b",)], "t string").select(P.segments(F.col("t"), ("<a<a>", "<a>b")).alias("p"))
    assert odd.first().p == ["<a", "<a>", "b"]


@pytest.mark.parametrize("letters, size, in_task", [("ab", 340, 1 << 20), ("abc", 420, 1 << 20), ("abc", 420, 700), ("aàb ", 400, 1 << 20)])
def test_one_task_learns_what_rounds_learn(spark, letters, size, in_task):
    """Runs of one symbol, products that are not new, and words left to a task after some rounds."""
    rng = random.Random(len(letters) + in_task)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 18))) for _ in range(90)]
    corpus = [" ".join(rng.choice(words) for _ in range(20)) for _ in range(15)] + ["", "a" * 700 + "b" * 301]
    df = spark.createDataFrame([(x,) for x in corpus], "text string")
    counts = V.word_counts(V.corpus_lines(df))
    ours = V.train_vocabulary(counts, vocab_size=size, in_task=in_task)
    tok, trainer = library(size)
    tok.train_from_iterator([x.strip() for x in corpus], trainer=trainer)
    assert learned_pairs(ours) == [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]
    assert ours.merges == V.train_vocabulary(counts, vocab_size=size, head=20).merges
    assert (ours.rounds > 1) == (in_task < 1 << 20)
    few = V.train_vocabulary(counts, max_merges=7, in_task=in_task)
    assert few.merges == ours.merges[:7]
    assert V.train_vocabulary(counts.limit(0), in_task=in_task).merges == []


def test_fertility_is_measured_with_the_whole_vocabulary(spark, tmp_path):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(12)] + ["zz yy\n zz", "", None]
    rows = [(i, t, ("en", "de")[i % 2], "web", len(t or "")) for i, t in enumerate(texts)]
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    tok, trainer = library(V.VOCAB_SIZE)
    tok.train_from_iterator([t for t in texts if t and len(t) > 100], trainer=trainer)
    merges = [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]
    assert len(merges) > 3 * base.N_MERGES and learned_pairs(base.whole_vocabulary(spark, folder)) == merges
    found = base.REGISTRY["fertility_by_language"].run(spark, folder)
    counted = {r.language: r.tokens for r in found.collect()}
    want = {"en": 0, "de": 0}
    for _, text, language, *_ in rows:
        want[language] += len(tok.encode(text or "").ids)
    assert counted == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    judged = db.sql(base.REGISTRY["fertility_by_language"].sql)
    assert sorted(map(tuple, found.select(*judged.columns).collect())) == sorted(judged.fetchall())
