"""The word table of a vocabulary training as stored tables that a round changes only where it must.

* ``counts``: how often each pair and each triple of neighbouring symbols occurs. A round adds what its
  rewritten words gained and takes off what they lost.
* ``words``: every distinct word with its count. While a round changes many of them, it reads and writes this
  table once and moves nothing: an index holds a word once for each of its pairs, so building one costs
  some twenty such rounds.
* ``index``: pair -> words that hold it, in folders by the pair's hash, so that a round reads the folders
  of the pairs that it merges. It is built once a round has changed few words.
* ``changed``: words rewritten since the index was built; they replace the index's version of them. When
  they are a quarter of all words, words are written anew and the index is given up until it pays again.

Every table is written to the shared folder and read back, so a lost executor costs one read of them,
and superseded tables are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import drop_path, fresh_path

_CHUNK = 256
# Words of a folder of the index, the most folders, and the share of changed words that ends it.
SLOT_WORDS, MAX_SLOTS = 100_000, 4096
REBUILD = 0.25
# The index is built after a round that changed less than this share of the words.
INDEX_SHARE = 0.01


def neighbours(words: DataFrame, sign: int = 1) -> DataFrame:
    """(key, n): all pairs and triples of neighbouring symbols of a (symbols, n) table, with their weight.

    A word is first cut into chunks that share their last two symbols, so that finding the i-th place is
    cheap in a long word too, and all steps stay inside generated code.
    """
    step = _CHUNK - 2
    starts = F.sequence(F.lit(1), F.greatest(F.length("symbols") - 1, F.lit(1)), F.lit(step))
    chunks = words.select(F.explode(starts).alias("start"), "symbols", "n")
    chunks = chunks.select(F.substring("symbols", F.col("start"), F.lit(_CHUNK)).alias("chunk"), "n")
    places = F.sequence(F.lit(1), F.greatest(F.least(F.length("chunk") - 1, F.lit(step)), F.lit(1)))
    at = chunks.select(F.explode(places).alias("at"), "chunk", "n")
    size = F.explode(F.array(F.lit(2), F.lit(3))).alias("size")
    keys = at.select(size, "at", "chunk", "n").select(
        F.substring("chunk", F.col("at"), F.col("size")).alias("key"), "size", (F.col("n") * sign).alias("n")
    )
    return keys.where(F.length("key") == F.col("size")).select("key", "n")


def merged(symbols: str, merges: list[tuple[str, str]], ranks: dict[str, int]) -> str:
    """The word after a batch of merges (pair, product) in their order.

    ``ranks`` numbers the pairs of all merges but the last. Of those the first that is present goes first,
    until none is: a merge only makes pairs with its own product, which rank after it. The last merge may
    have a product that is not new, so nothing comes after it.
    """
    while True:
        present = {symbols[i : i + 2] for i in range(len(symbols) - 1)}
        found = min((ranks[p] for p in present if p in ranks), default=None)
        if found is None:
            return symbols.replace(*merges[-1])
        # Replacing from the left is what a merge does with a run of equal symbols too.
        symbols = symbols.replace(*merges[found])


def _rewriter(merges: list[tuple[str, str]]):
    ranks = {pair: i for i, (pair, _) in enumerate(merges[:-1])}

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [merged(s, merges, ranks) for s in batch.column("symbols").to_pylist()]
            columns = [batch.column("word"), batch.column("symbols"), pa.array(new, pa.string()), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, ["word", "old", "symbols", "n"])

    return rewrite


def _scanner(merges: list[tuple[str, str]]):
    """Rewrites all words of a batch in one text: no symbol is a line break, and merges in their order leave
    what ``merged`` does. ``old`` is null where nothing changed."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            old = batch.column("symbols")
            text = "\n".join(old.to_pylist())
            for pair, product in merges:
                text = text.replace(pair, product)
            new = pa.array(text.split("\n"), pa.string())
            old = pc.if_else(pc.not_equal(old, new), old, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([old, new, batch.column("n")], ["old", "symbols", "n"])

    return rewrite


def _texts(pairs: list[str]) -> str:
    """Pairs as SQL literals; no symbol is a quote or a backslash (they start at code point 256)."""
    return ", ".join(f"'{p}'" for p in pairs)


class PairIndex:
    """The state of a training between two rounds."""

    def __init__(self, words: DataFrame, rebuild: float = REBUILD):
        """``words``: (symbols, n), a row for each distinct word."""
        self.spark, self.rebuild = words.sparkSession, rebuild
        self.paths: dict[str, str] = {}
        self.indexed = False
        self._store("words", words.where(F.length("symbols") > 1).select("symbols", "n"))
        self._store("counts", self._counted(neighbours(self.words)))

    def _store(self, name: str, table: DataFrame, by: str | None = None) -> None:
        """Write a table, read it back under its name, and drop what it supersedes."""
        path = fresh_path(self.spark, name)
        schema = table.schema
        writer = table.write if by is None else table.write.partitionBy(by)
        writer.parquet(path)
        setattr(self, name, self.spark.read.schema(schema).parquet(path))
        self._keep(name, path)

    def _keep(self, name: str, path: str) -> None:
        before, self.paths[name] = self.paths.get(name), path
        if before is not None:
            drop_path(self.spark, before)

    @staticmethod
    def _counted(keys: DataFrame) -> DataFrame:
        return keys.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > 0)

    def _slot(self, pair: Column) -> Column:
        return F.pmod(F.xxhash64(pair), F.lit(self.slots)).cast("int")

    def _build(self) -> None:
        """The index of the present words, which get numbers, and no changed ones."""
        self._store("words", self.words.select(F.monotonically_increasing_id().alias("word"), "symbols", "n"))
        self.size = self.words.count()
        self.slots = max(1, min(MAX_SLOTS, self.size // SLOT_WORDS))
        pairs = F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.length("symbols") - 1), lambda i: F.substring("symbols", i, F.lit(2))
            )
        )
        postings = self.words.select(F.explode(pairs).alias("pair"), "word", "symbols", "n")
        postings = postings.withColumn("slot", self._slot(F.col("pair")))
        if self.slots > 1:
            postings = postings.repartition("slot").sortWithinPartitions("slot", "pair")
        self._store("index", postings, "slot")
        self._store("changed", self.words.limit(0))
        self.n_changed = 0
        self.indexed = True

    def head(self, k: int, min_frequency: int) -> list[tuple[str, int]]:
        """The first ``k`` pairs by (count desc, left id, right id)."""
        pairs = self.counts.where((F.length("key") == 2) & (F.col("n") >= min_frequency))
        rows = pairs.orderBy(F.desc("n"), F.asc("key")).limit(k).collect()
        return [(r["key"], r["n"]) for r in rows]

    def triples(self, pairs: list[str]) -> dict[str, int]:
        """Counts of the triples of which both pairs are among ``pairs`` (at most that many squared)."""
        head = _texts(pairs)
        both = f"length(key) = 3 AND substring(key, 1, 2) IN ({head}) AND substring(key, 2, 2) IN ({head})"
        rows = self.counts.where(both).collect()
        return {r["key"]: r["n"] for r in rows}

    def touched(self, pairs: list[str]) -> DataFrame:
        """(word, symbols, n): the present words that hold any of the pairs; without an index no numbers."""
        places = "sequence(1, greatest(length(symbols) - 1, 1))"
        holds = f"exists({places}, i -> substring(symbols, i, 2) IN ({_texts(pairs)}))"
        if not self.indexed:
            return self.words.where(holds)
        slots = [0]
        if self.slots > 1:
            wanted = self.spark.range(1).select(F.explode(F.expr(f"array({_texts(pairs)})")).alias("pair"))
            slots = [r[0] for r in wanted.select(self._slot(F.col("pair"))).distinct().collect()]
        found = self.index.where(F.col("slot").isin(slots)).where(f"pair IN ({_texts(pairs)})")
        found = found.select("word", "symbols", "n").join(self.changed.select("word"), "word", "left_anti")
        found = found.dropDuplicates(["word"])
        return found.unionByName(self.changed.where(holds))

    def _recount(self, rewritten: DataFrame) -> None:
        """Counts after words ``old`` became ``symbols``."""
        lost = neighbours(rewritten.select(F.col("old").alias("symbols"), "n"), -1)
        gained = neighbours(rewritten.select("symbols", "n"))
        self._store("counts", self._counted(self.counts.unionByName(lost).unionByName(gained)))

    def _scan(self, merges: list[tuple[str, str]]) -> None:
        """Merge pairs in one pass over all words, and index them if that changed few."""
        path = fresh_path(self.spark, "words")
        scanned = self.words.mapInArrow(_scanner(merges), "old string, symbols string, n long")
        scanned.write.parquet(path)
        scanned = self.spark.read.schema(scanned.schema).parquet(path)
        self._recount(scanned.where(F.col("old").isNotNull()))
        self.words = scanned.where(F.length("symbols") > 1).select("symbols", "n")
        self._keep("words", path)
        size, self.n_changed = scanned.agg(F.count(F.lit(1)), F.count("old")).first()
        if self.n_changed < INDEX_SHARE * size:
            self._build()

    def apply(self, merges: list[tuple[str, str]]) -> None:
        """Merge pairs into symbols, in order: the words that hold them, and the counts of what changed."""
        if not self.indexed:
            self._scan(merges)
            return
        # A pair of this batch with a symbol of this batch is in no word that has none of the others.
        products = {product for _, product in merges}
        pairs = [pair for pair, _ in merges if not products.intersection(pair)]
        path = fresh_path(self.spark, "rewritten")
        rewritten = self.touched(pairs).mapInArrow(
            _rewriter(merges), "word long, old string, symbols string, n long"
        )
        rewritten.write.parquet(path)
        rewritten = self.spark.read.schema(rewritten.schema).parquet(path)
        self._recount(rewritten)
        new = rewritten.select("word", "symbols", "n")
        kept = self.changed.join(new.select("word"), "word", "left_anti")
        self._store("changed", kept.unionByName(new))
        self.n_changed = self.changed.count()
        drop_path(self.spark, path)
        if self.n_changed > self.rebuild * self.size:
            same = self.words.join(self.changed.select("word"), "word", "left_anti")
            self._store("words", same.unionByName(self.changed).where(F.length("symbols") > 1).select("symbols", "n"))
            self.indexed = False

    def present(self) -> DataFrame:
        """(symbols, n): the words as the merges so far have left them."""
        if not self.indexed:
            return self.words.select("symbols", "n")
        same = self.words.join(self.changed.select("word"), "word", "left_anti")
        return same.unionByName(self.changed).where(F.length("symbols") > 1).select("symbols", "n")

    def drop(self) -> None:
        for path in self.paths.values():
            drop_path(self.spark, path)
