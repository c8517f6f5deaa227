"""Spelling variants: words of a corpus that differ by one inserted, deleted or replaced letter.

The multiset of a word's letters is a binary vector: a dimension is a letter with its count so far (the
second "e" is another one than the first). One edit changes at most two dimensions, so candidates are the
pairs within Hamming distance two, which PartEnum signatures find exactly: dimensions are dealt into
``PARTS`` parts of about equal weight, two differences lie in at most two of them, so the pair agrees on
some choice of all parts but two. A signature is such a choice with the letters in it and a tag of the
length (lengths at most one apart share a tag). Equal signatures are joined and verified by the edit
distance itself.

A signature that many words share would be compared all with all. The words of an edit also agree in
their first or their last half, so a signature with more than ``CROWDED`` words is divided by these, and
no pair is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import drop_path, fresh_path, read_table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT = 6, 5
# One occurrence in so many loses a letter.
SLIP = 199
PARTS, DIFFERENT = 7, 2
CHOICES = tuple(combinations(range(PARTS), PARTS - DIFFERENT))
CROWDED = 32
# Occurrences of a letter that are weighed one by one; later ones are dealt by their number.
WEIGHED = 8
# A word's form is at least so many times as frequent.
RATIO = 5
# Words that a task holds before it hands on their counts.
HELD = 250_000
# Chains of forms grow by RATIO a step, so a count of 64 bits bounds them by 28 steps.
DOUBLINGS = 5


def slipped(run: str, h: int) -> str:
    """The run as it is read: if ``SLIP`` divides the hash, without the letter the hash names."""
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _occurrences(most: int):
    """Counts of words, combined over a task's texts in tables of about ``most`` words."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
            )

        for rows in batches:
            for name, text in zip(rows.column("id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                prefix = zlib.crc32(f"{name}:".encode())
                # Lower-casing bytes changes A-Z only.
                runs = Counter(RUN.findall(text.lower().decode("utf-8", "replace")))
                for run, n in runs.items():
                    if len(run) >= MIN_LENGTH:
                        word = slipped(run, zlib.crc32(run.encode(), prefix))
                        if len(word) >= MIN_LENGTH:
                            held[word] += n
                if len(held) > most:
                    yield batch()
                    held.clear()
        yield batch()

    return counts


def word_counts(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(word, n): the words of at least ``MIN_LENGTH`` letters that occur ``MIN_COUNT`` times or more.

    Counts are combined per task before the shuffle, in tables of bounded size.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    counts = rows.mapInArrow(_occurrences(HELD), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def dimensions(word: str) -> Iterator[tuple[str, int]]:
    """The dimensions that a word sets: its letters, numbered by their count so far."""
    seen: Counter[str] = Counter()
    for letter in word:
        yield letter, seen[letter]
        seen[letter] += 1


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[tuple[str, int]] = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            total.update(d for d in dimensions(word) if d[1] < WEIGHED)
    letters, numbers = zip(*total, strict=True) if total else ((), ())
    columns = [pa.array(letters, pa.string()), pa.array(numbers, pa.int32()), pa.array(total.values(), pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["letter", "number", "n"])


def deal(words: DataFrame) -> dict[tuple[str, int], int]:
    """The part of each dimension, heaviest first to the lightest part.

    Only the first ``WEIGHED`` occurrences of a letter are weighed, so the table holds that many rows
    for each letter of the alphabet, whatever the words are.
    """
    weights = words.select("word").mapInArrow(_weights, "letter string, number int, n long")
    rows = weights.groupBy("letter", "number").agg(F.sum("n").alias("n")).collect()
    load, part = [0] * PARTS, {}
    for r in sorted(rows, key=lambda r: (-r.n, r.letter, r.number)):
        lightest = load.index(min(load))
        part[r.letter, r.number] = lightest
        load[lightest] += r.n
    return part


def signatures(word: str, part: dict[tuple[str, int], int]) -> list[tuple[int, int]]:
    """The word's signatures, each a hash of a choice of parts, the letters in them and a length tag,
    with that tag."""
    inside: list[list[str]] = [[] for _ in range(PARTS)]
    for letter, number in dimensions(word):
        inside[part.get((letter, number), (ord(letter) + number) % PARTS)].append(letter)
    texts = ["".join(sorted(x)) for x in inside]
    tags = sorted({len(word) // 2, (len(word) + 1) // 2})
    found = []
    for number, choice in enumerate(CHOICES):
        letters = ",".join([texts[p] for p in choice])
        found += [(xxhash.xxh64_intdigest(f"{number}:{tag}:{letters}"), tag) for tag in tags]
    return found


def _signed(part: dict[tuple[str, int], int]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word")
            found = [signatures(w, part) for w in words.to_pylist()]
            sizes = [len(x) for x in found]
            at = np.repeat(np.arange(len(sizes)), sizes)
            flat = np.fromiter((x for s in found for x, _ in s), np.uint64, sum(sizes)).view(np.int64)
            tags = pa.array((tag for s in found for _, tag in s), pa.int32())
            columns = [words.take(pa.array(at)), batch.column("n").take(pa.array(at))]
            yield pa.RecordBatch.from_arrays([pa.array(flat), tags, *columns], ["signature", "tag", "word", "n"])

    return rows


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): the pairs of words that one edit turns into each other, word < near."""
    spark = words.sparkSession
    path = fresh_path(spark, "spelling-signatures")
    signed = words.mapInArrow(_signed(deal(words)), "signature long, tag int, word string, n long")
    signed.write.parquet(path)
    signed = read_table(spark, path, signed.schema)
    crowded = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > CROWDED)
    keyed = signed.join(crowded, "signature", "left")
    # Words of a tag t have 2t - 1 letters at least, so after one edit t - 1 of them agree at one end.
    half = F.col("tag") - 1
    ends = F.array(
        F.concat(F.lit("<"), F.left("word", half)), F.concat(F.lit(">"), F.right("word", half))
    )
    end = F.explode(F.when(F.col("_size").isNull(), F.array(F.lit(""))).otherwise(ends))
    keyed = keyed.select("signature", "word", "n", end.alias("end"))
    a, b = keyed.alias("a"), keyed.alias("b")
    same = (F.col("a.signature") == F.col("b.signature")) & (F.col("a.end") == F.col("b.end"))
    edit = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    pairs = a.join(b, same & (F.col("a.word") < F.col("b.word")) & edit).select(
        F.col("a.word").alias("word"),
        F.col("a.n").alias("n"),
        F.col("b.word").alias("near"),
        F.col("b.n").alias("near_n"),
    )
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms (word, form) ends, by doubling the steps."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        path = fresh_path(at.sparkSession, "spelling-roots")
        at.write.parquet(path)
        at = read_table(at.sparkSession, path, at.schema)
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return at


def variants(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the texts.

    Words are runs of letters (A-Z lower-cased) of at least six letters and five occurrences; in one of
    199 occurrences, by a hash of the row's id and the run, a letter is lost. ``n_near`` counts the words
    at one edit, ``form`` is the most frequent of them (ties: the first in code-point order) if it is at
    least five times as frequent, ``root`` the last form of the chain, or the word itself.

    Null texts hold no words, a null id is written as nothing, repeated rows and ids count as often as
    they occur, and other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "spelling-words")
    words = word_counts(docs, id_col)
    words.write.parquet(path)
    words = read_table(spark, path, words.schema)
    pairs_path = fresh_path(spark, "spelling-pairs")
    pairs = near_words(words)
    pairs.write.parquet(pairs_path)
    pairs = read_table(spark, pairs_path, pairs.schema)
    swapped = pairs.select(
        F.col("near").alias("word"),
        F.col("near_n").alias("n"),
        F.col("word").alias("near"),
        F.col("n").alias("near_n"),
    )
    both = pairs.unionByName(swapped)
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.max("n").alias("_n"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
    )
    # No product: five times a count may pass 64 bits.
    good = F.expr(f"-best.less div {RATIO} >= _n")
    best = best.select(
        "word",
        "n_near",
        F.when(good, F.col("best.form")).alias("form"),
        F.when(good, -F.col("best.less")).alias("form_n"),
    )
    best_path = fresh_path(spark, "spelling-forms")
    best.write.parquet(best_path)
    best = read_table(spark, best_path, best.schema)
    drop_path(spark, pairs_path)
    roots = _roots(best.where("form IS NOT NULL").select("word", "form"))
    out = words.join(best, "word", "left").join(roots, "word", "left")
    return out.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form_n",
    )
