"""Byte-level BPE vocabulary learned by Spark jobs.

The corpus is first reduced to one row per distinct pre-token with its count, and these words to stored
tables (``pair_index``): counts of pairs and triples, and an index from pairs to words. A round takes the
head of the ranking, the driver chooses from it as many merges as can be told exactly (``merge_batches``),
and only the words that hold them are rewritten; counts change by what these words lost and gained.

Merges and their order are those of one-at-a-time training, where pairs are ranked by (count desc, left
id, right id). A pair of equal symbols, or one whose joined text already is a token, is merged alone.

With ``in_task``, rounds end as soon as the words have no more symbols than that: one task then learns the
rest from arrays (``word_merges``), one merge after the other. A whole vocabulary has tens of thousands of
merges, and a round of Spark jobs costs seconds however few words it touches.

What reaches the driver is bounded: the head and its triples, and the merges themselves, at most as many
as the vocabulary is allowed to hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from textloom.functions.pretokens import (
    SPECIAL_TOKENS,
    byte_alphabet,
    pretokens,
    symbol_char,
    symbol_id,
    word_symbols,
)
from textloom.functions.text import lines, strip
from textloom.operators.merge_batches import HEAD, Batch, choose
from textloom.operators.pair_index import PairIndex
from textloom.operators.word_merges import WordMerges, learn, symbols_of
from textloom.session import drop_path, fresh_path, read_table

# Default vocabulary size, the sizes on offer, and the smallest pair count merged.
VOCAB_SIZE = 128_000
VOCAB_SIZES = (65_536, 98_304, 128_000, 196_608, 256_000)
MIN_FREQUENCY = 2
# Symbols of all distinct words that one task learns from; each takes some 40 bytes there.
IN_TASK = 1 << 24

MERGES_SCHEMA = StructType(
    [
        StructField("rank", IntegerType(), False),
        StructField("left", StringType(), False),
        StructField("right", StringType(), False),
        StructField("token", StringType(), False),
        StructField("left_id", IntegerType(), False),
        StructField("right_id", IntegerType(), False),
        StructField("token_id", IntegerType(), False),
        StructField("pair_count", LongType(), False),
    ]
)
VOCAB_SCHEMA = StructType(
    [StructField("token", StringType(), False), StructField("id", IntegerType(), False)]
)
WORDS_SCHEMA = StructType(
    [StructField("symbols", StringType(), False), StructField("n", LongType(), False)]
)

_CHUNK = 256


def corpus_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """Training units: the stripped lines of each stripped document."""
    return documents.select(F.explode(lines(strip(F.col(text)))).alias("line")).select(
        strip(F.col("line")).alias("line")
    )


def word_counts(units: DataFrame, text: str = "line") -> DataFrame:
    """How often each pre-token occurs. Map-side counts collapse a hot word before the shuffle."""
    words = units.select(F.explode(pretokens(F.col(text), specials=())).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def symbol_pairs(words: DataFrame) -> DataFrame:
    """Every adjacent pair of symbols of a (symbols, n) table, as two-character strings.

    A word is first cut into chunks that share their end symbol, so finding the i-th pair is
    cheap in a long word too, and both steps stay inside generated code.
    """
    chunks = words.select(
        F.explode(
            F.sequence(F.lit(1), F.greatest(F.length("symbols") - 1, F.lit(1)), F.lit(_CHUNK - 1))
        ).alias("start"),
        "symbols",
        "n",
    ).select(F.substring("symbols", F.col("start"), F.lit(_CHUNK)).alias("chunk"), "n")
    pairs = chunks.select(
        F.explode(F.sequence(F.lit(1), F.greatest(F.length("chunk") - 1, F.lit(1)))).alias("at"), "chunk", "n"
    ).select(F.substring("chunk", F.col("at"), F.lit(2)).alias("pair"), "n")
    return pairs.where(F.length("pair") == 2)


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent symbol pairs over a (symbols, n) table, weighted by word count."""
    return symbol_pairs(words).groupBy("pair").agg(F.sum("n").alias("n"))


def top_pairs(counts: DataFrame, k: int, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """The ``k`` pairs that come first by (count desc, left id, right id)."""
    return (
        counts.where(F.col("n") >= min_frequency).orderBy(F.desc("n"), F.asc("pair")).limit(k)
    )


@dataclass(slots=True)
class Merge:
    pair: str
    token: str
    token_id: int
    count: int


@dataclass
class _Progress:
    """Driver-side state of a training run: tokens by text and by id, and the merges so far."""

    tokens: list[str]
    limit: int
    ids: dict[str, int] = field(init=False)
    merges: list[Merge] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.ids = {t: i for i, t in enumerate(self.tokens)}

    def joined(self, pair: str) -> str:
        return "".join(self.tokens[symbol_id(ch)] for ch in pair)

    def record(self, pair: str, count: int) -> Merge:
        token = self.joined(pair)
        if token not in self.ids:
            self.ids[token] = len(self.tokens)
            self.tokens.append(token)
        merge = Merge(pair, token, self.ids[token], count)
        self.merges.append(merge)
        return merge

    def alone(self, pair: str) -> bool:
        return pair[0] == pair[1] or self.joined(pair) in self.ids


@dataclass
class Vocabulary:
    """A learned vocabulary: tokens in id order and merges in rank order."""

    tokens: list[str]
    merges: list[Merge]
    n_special: int
    rounds: int = 0

    def merge_ids(self) -> list[tuple[int, int]]:
        """Ids of both sides of each merge, in rank order."""
        return [(symbol_id(m.pair[0]), symbol_id(m.pair[1])) for m in self.merges]

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, i) for i, t in enumerate(self.tokens)], VOCAB_SCHEMA)

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = []
        for rank, (m, (left, right)) in enumerate(zip(self.merges, self.merge_ids(), strict=True)):
            rows.append(
                (rank, self.tokens[left], self.tokens[right], m.token, left, right, m.token_id, m.count)
            )
        return spark.createDataFrame(rows, MERGES_SCHEMA)


def base_tokens(specials: tuple[str, ...] | list[str] = SPECIAL_TOKENS) -> list[str]:
    """Special tokens, then the 256 byte characters."""
    return [*specials, *byte_alphabet()]


def _fits(words: DataFrame, symbols: int) -> bool:
    return symbols > 0 and (words.agg(F.sum(F.length("symbols"))).first()[0] or 0) <= symbols


def _learn_in_task(words: DataFrame, state: _Progress, min_frequency: int, most: int) -> None:
    """At most ``most`` more merges, learned by one task and recorded here."""
    tokens, limit = state.tokens, state.limit

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        progress, parts = _Progress(list(tokens), limit), []
        for batch in batches:
            parts.append((*symbols_of(batch.column("symbols")), np.asarray(batch.column("n"))))
        if not parts:
            return
        symbols, lengths, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
        parts.clear()

        def record(pair: str, n: int) -> tuple[int, bool]:
            had = len(progress.tokens)
            return progress.record(pair, n).token_id, len(progress.tokens) > had

        learn(
            WordMerges(symbols, lengths, counts, min_frequency),
            record,
            lambda: min(limit - len(progress.tokens), most - len(progress.merges)),
        )
        columns = [pa.array(range(len(progress.merges)), pa.int32()), pa.array([m.pair for m in progress.merges], pa.string())]
        columns.append(pa.array([m.count for m in progress.merges], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, ["rank", "pair", "n"])

    rows = words.select("symbols", "n").coalesce(1).mapInArrow(learned, "rank int, pair string, n long").toArrow()
    rows = rows.sort_by("rank")
    for pair, n in zip(rows["pair"], rows["n"], strict=True):
        state.record(pair.as_py(), n.as_py())


def train_vocabulary(
    counts: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    specials: tuple[str, ...] | list[str] = SPECIAL_TOKENS,
    max_merges: int | None = None,
    head: int = HEAD,
    in_task: int = 0,
) -> Vocabulary:
    """Learn merges from a (word, n) table until the vocabulary is full or no pair is frequent.

    Words of at most ``in_task`` symbols in all are left to one task."""
    state = _Progress(base_tokens(specials), vocab_size)
    words = counts.select(word_symbols(F.col("word"), len(specials)).alias("symbols"), "n")

    def room() -> int:
        free = state.limit - len(state.tokens)
        return free if max_merges is None else min(free, max_merges - len(state.merges))

    if room() <= 0:
        return Vocabulary(state.tokens, state.merges, len(specials), 0)
    path = None
    if in_task:
        path = fresh_path(words.sparkSession, "words")
        words.where(F.length("symbols") > 1).write.parquet(path)
        words = read_table(words.sparkSession, path, words.schema)
    if _fits(words, in_task):
        _learn_in_task(words, state, min_frequency, room())
        drop_path(words.sparkSession, path)
        return Vocabulary(state.tokens, state.merges, len(specials), 1)
    index = PairIndex(words)
    if path is not None:
        drop_path(words.sparkSession, path)
    rounds = 0
    while room() > 0:
        if _fits(index.present(), in_task):
            _learn_in_task(index.present(), state, min_frequency, room())
            rounds += 1
            break
        ranked = index.head(head + 1, min_frequency)
        if not ranked:
            break
        floor = (ranked[head][1], ranked[head][0]) if len(ranked) > head else None
        ranked = ranked[:head]
        batch = Batch(ranked, index.triples([p for p, _ in ranked]), floor)
        start = len(state.merges)
        choose(batch, lambda p, n: symbol_char(state.record(p, n).token_id), state.alone, min_frequency, room())
        index.apply([(m.pair, symbol_char(m.token_id)) for m in state.merges[start:]])
        rounds += 1
    index.drop()
    return Vocabulary(state.tokens, state.merges, len(specials), rounds)
