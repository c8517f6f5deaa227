"""Phrase collocations, counted with weighted acyclic automata.

A symbol is a word with its language before it ("en<tab>word"), so languages need no separate tables. A
shard is a run of whole texts in one task, encoded once as symbol numbers: its phrases are sorted, and an
acyclic automaton is built from the sorted list, whose arcs carry a symbol and the count of the phrase that
ends there; equal states are one state. Automata are cut at the same phrases in every shard, so that a range of phrases meets in one
group: there the automata are united, weights of equal phrases are added, and phrases below the threshold
go. The counts of a candidate's parts are looked up by composing the sorted parts with the automaton of
the frequent phrases of their range.

Phrases grow level by level: a phrase is frequent only if its words are, and one of three or four words
only if its pairs are. What is frequent reaches the next pass as a bit table of fixed size, which may let
other phrases through but stops none that is frequent; what goes through is counted exactly.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import fresh_path, read_table

MIN_COUNT, MAX_WORDS = 30, 4
SCALE = 2_000_000
TOP = 2_000
# A phrase is part of a longer one if that has so many in a hundred of its occurrences.
COVERED = 80
NO_LANGUAGE = "und"

# Words of a shard, and words behind a range of phrases.
SHARD_WORDS, RANGE_WORDS = 1 << 20, 2_000_000
MIN_RANGES, MAX_RANGES = 16, 8192
# Words whose numbers a task keeps.
KNOWN = 1 << 20
# Bytes of text that are split into words at once.
PORTION = 1 << 21
# Documents whose phrases the cuts of the ranges are drawn from (cuts only balance tasks).
CUT_DOCS, CUTS_A_DOC = 20_000, 4
CUT_BYTES = 200
# Bits of the table of frequent words or pairs.
LOG_BITS = 26
# Lookups of one range in one task.
LOOKUPS = 100_000
BUCKETS = 64
# States with more arcs than this are not merged.
WIDE = 4

_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BREAK = b"."
_BLANK = re.compile(rb"[ \t]")


def _read(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(spark, f"collocations-{label}")
    df.write.parquet(path)
    return read_table(spark, path, df.schema)


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of some texts in order, with a break (".") wherever a piece ends."""
    # Lower-casing bytes changes A-Z only; a full stop is in no word.
    whole = b".".join(texts).lower().translate(_ENDS).replace(b".", b" . ")
    return whole.split()


class Automaton:
    """An acyclic automaton over symbol numbers; the weight of an arc is the count of what ends there.

    Arcs of a state lie together, ordered by symbol: those of state s from ``first[s]`` to
    ``first[s + 1]``. The last state is the start; state 0 has no arcs.
    """

    def __init__(self, label: np.ndarray, weight: np.ndarray, target: np.ndarray, first: np.ndarray):
        self.label, self.weight, self.target, self.first = label, weight, target, first

    @classmethod
    def of_sorted(cls, grams: np.ndarray, counts: np.ndarray) -> Automaton:
        """From sorted distinct phrases, a row each, padded with -1.

        Levels are built from the longest phrases up, so the states that an arc leads to are known, and
        merged with their equals, before the arc is made.
        """
        n, depth = grams.shape
        # node[d][i]: number of the prefix of length d of row i among the prefixes of that length.
        node = [np.zeros(n, np.int64)]
        changed = np.zeros(max(n - 1, 0), bool)
        for d in range(depth):
            changed = changed | (grams[1:, d] != grams[:-1, d])
            node.append(np.concatenate(([0], np.cumsum(changed)))[:n])
        empty = np.empty(0, np.int64)
        label, weight, target, sizes = [empty], [empty], [empty], [np.zeros(1, np.int64)]
        states, below = 1, np.zeros(1, np.int64)
        for d in range(depth, 0, -1):
            there = np.flatnonzero(grams[:, d - 1] >= 0)
            fresh = there[np.concatenate(([True], node[d][there][1:] != node[d][there][:-1]))] if len(there) else there
            ends = np.ones(len(fresh), bool) if d == depth else grams[fresh, d] < 0
            arcs = np.column_stack(
                (
                    grams[fresh, d - 1].astype(np.int64),
                    np.where(ends, counts[fresh], 0),
                    np.zeros(len(fresh), np.int64) if d == depth else below[node[d][fresh]],
                )
            )
            above = node[d - 1][fresh]
            start = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1]))) if len(above) else above
            degree = np.diff(np.append(start, len(above)))
            number = _merged(arcs, start, degree, d == 1)
            keep, which = np.unique(number, return_index=True)
            renumber = np.searchsorted(keep, number)
            below = np.zeros(n and int(node[d - 1][-1]) + 1, np.int64)
            below[above[start]] = states + renumber
            rows = _spans(start[which], degree[which])
            label.append(arcs[rows, 0])
            weight.append(arcs[rows, 1])
            target.append(arcs[rows, 2])
            sizes.append(degree[which])
            states += len(which)
        first = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        return cls(np.concatenate(label), np.concatenate(weight), np.concatenate(target), first)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases with a weight, a row each and sorted within a length, and their weights."""
        grams, counts = [np.empty((0, MAX_WORDS), np.int64)], [np.empty(0, np.int64)]
        state = np.array([len(self.first) - 2])
        head = np.empty((1, 0), np.int64)
        while len(state):
            degree = self.first[state + 1] - self.first[state]
            arc = _spans(self.first[state], degree)
            head = np.column_stack((np.repeat(head, degree, axis=0), self.label[arc]))
            ends = np.flatnonzero(self.weight[arc])
            padded = np.full((len(ends), MAX_WORDS), -1, np.int64)
            padded[:, : head.shape[1]] = head[ends]
            grams.append(padded)
            counts.append(self.weight[arc][ends])
            on = np.flatnonzero(self.target[arc])
            head, state = head[on], self.target[arc][on]
        return np.concatenate(grams), np.concatenate(counts)

    def compose(self, queries: np.ndarray) -> np.ndarray:
        """The weights of the phrases in ``queries`` (rows padded with -1; -2: no symbol here), else 0."""
        state = np.full(len(queries), len(self.first) - 2)
        found = np.zeros(len(queries), np.int64)
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        key = owner << 32 | self.label
        for d in range(queries.shape[1]):
            at = np.flatnonzero((queries[:, d] >= 0) & (state > 0))
            want = state[at] << 32 | queries[at, d]
            arc = np.searchsorted(key, want)
            hit = arc < len(key)
            hit[hit] = key[arc[hit]] == want[hit]
            lost = np.ones(len(queries), bool)
            lost[at[hit]] = False
            going = queries[:, d] != -1
            state = np.where(lost & going, 0, state)
            found = np.where(lost & going, 0, found)
            found[at[hit]] = self.weight[arc[hit]]
            state[at[hit]] = self.target[arc[hit]]
        return found

    def columns(self) -> list[bytes]:
        label, first, target = (x.astype(np.int32) for x in (self.label, self.first, self.target))
        return [_packed(x) for x in (label, self.weight, first, target)]

    @classmethod
    def of_columns(cls, label: bytes, weight: bytes, first: bytes, target: bytes) -> Automaton:
        narrow = [_unpacked(x, np.int32) for x in (label, first, target)]
        return cls(narrow[0], _unpacked(weight, np.int64), narrow[2], narrow[1])


def _packed(values: np.ndarray) -> bytes:
    data = values.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), kind).astype(np.int64)


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all spans (start, length), one after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def _merged(arcs: np.ndarray, start: np.ndarray, degree: np.ndarray, top: bool) -> np.ndarray:
    """For each state the number of the first state with the same arcs."""
    number = np.arange(len(start))
    if top:
        return number
    for size in range(1, WIDE + 1):
        at = np.flatnonzero(degree == size)
        if len(at) > 1:
            rows = arcs[start[at][:, None] + np.arange(size)].reshape(len(at), -1)
            _, where, back = np.unique(rows, axis=0, return_index=True, return_inverse=True)
            number[at] = at[where[back.ravel()]]
    return number


def _sum_sorted(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases sorted and distinct, with the sums of their counts."""
    head, tail = (grams[:, d] + 1 << 32 | grams[:, d + 1] + 1 for d in (0, 2))
    order = np.lexsort((tail, head)) if tail.any() else np.argsort(head, kind="stable")
    grams, counts, head, tail = grams[order], counts[order], head[order], tail[order]
    fresh = np.concatenate(([True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])))[: len(grams)]
    at = np.flatnonzero(fresh)
    return grams[at], np.add.reduceat(counts, at) if len(at) else counts


def _hashes(symbols: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s) for s in symbols), np.uint64, len(symbols))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The place in the bit table of phrases of equal length, a row of symbol hashes each."""
    mixed = hashes[:, 0].copy()
    for d in range(1, hashes.shape[1]):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[:, d]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
    return mixed >> np.uint64(64 - LOG_BITS)


class Frequent:
    """A bit table of fixed size: false only for phrases that are not frequent."""

    def __init__(self, phrases: DataFrame):
        """``phrases`` holds the symbols of each phrase (all of one length), joined by blanks."""

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = [p.split(b" ") for p in batch.column(0).to_pylist()]
                if parts:
                    hashes = np.column_stack([_hashes(list(c)) for c in zip(*parts, strict=True)])
                    at = np.unique(_bits(hashes))
                    word, back = np.unique(at >> np.uint64(6), return_inverse=True)
                    bits = np.zeros(len(word), np.uint64)
                    np.bitwise_or.at(bits, back, np.uint64(1) << (at & np.uint64(63)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"]
                    )

        rows = phrases.select("phrase").mapInArrow(places, "word long, bits long")
        rows = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        table = np.zeros(1 << (LOG_BITS - 6), np.int64)
        table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
        self._shared = phrases.sparkSession.sparkContext.broadcast(pa.compress(table.tobytes(), "zstd", asbytes=True))
        self._table = None

    def __getstate__(self):
        return self._shared

    def __setstate__(self, shared):
        self._shared, self._table = shared, None

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self._table is None:
            data = pa.decompress(self._shared.value, 1 << (LOG_BITS - 3), "zstd", asbytes=True)
            self._table = np.frombuffer(data, np.uint64)
        at = _bits(hashes)
        return (self._table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.url_encode(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))).cast("binary").alias("lang"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )


def _portions(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in portions that end at a blank."""
    at = 0
    while len(text) - at > size:
        blank = _BLANK.search(text, at + size)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _tokens(batch: pa.RecordBatch, portion: int = PORTION) -> Iterator[tuple[bytes, list[bytes]]]:
    """(language, words with breaks) of the texts of a batch, some at a time. A break ends each text, so
    words that do not end with one go on in the next portion."""
    held, size = defaultdict(list), Counter()
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        if len(text) > portion:
            for part in _portions(text, portion):
                yield lang, words_of([part])
            yield lang, [_BREAK]
            continue
        held[lang].append(text)
        size[lang] += len(text)
        if size[lang] > portion:
            yield lang, [*words_of(held.pop(lang)), _BREAK]
            size[lang] = 0
    for lang, texts in held.items():
        yield lang, [*words_of(texts), _BREAK]


def _count_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, Counter[bytes]] = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        symbols = [lang + b"\t" + word for lang, words in held.items() for word in words]
        counts = [n for words in held.values() for n in words.values()]
        return pa.RecordBatch.from_arrays([pa.array(symbols, pa.binary()), pa.array(counts, pa.int64())], ["phrase", "f"])

    for batch in batches:
        for lang, words in _tokens(batch):
            held[lang].update(words)
            del held[lang][_BREAK]
        if sum(map(len, held.values())) > 500_000:
            yield rows()
            held.clear()
    yield rows()


class _Shard:
    """Texts of a task: word numbers in order, with -1 where a piece ends.

    Numbers, hashes and the test for frequency are kept from shard to shard, up to ``KNOWN`` words.
    """

    def __init__(self, words: Frequent):
        self.frequent = words
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, dict[bytes, int]] = {}
        self.next = count()
        self.tested: Counter[bytes] = Counter()
        # By word number, of the tested words; symbols of the frequent ones only.
        self.hashes = np.empty(0, np.uint64)
        self.symbols: dict[int, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: bytes, words: list[bytes]) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = defaultdict(self.next.__next__)
        number = self.numbers[lang]
        run = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        run[run == number.get(_BREAK, -1)] = -1
        self.runs.append(run)
        self.size += len(run)

    def _test(self) -> None:
        """Hash and test the words that are new since the last shard."""
        new = []
        for lang, number in self.numbers.items():
            new += [(i, lang + b"\t" + w) for w, i in islice(number.items(), self.tested[lang], None)]
            self.tested[lang] = len(number)
        if new:
            at, symbols = np.array([i for i, _ in new]), [s for _, s in new]
            hashes = _hashes(symbols)
            self.hashes = np.concatenate((self.hashes, np.empty(len(new), np.uint64)))
            self.hashes[at] = hashes
            good = np.flatnonzero(self.frequent.has(hashes[:, None]))
            self.symbols.update(zip(at[good].tolist(), map(symbols.__getitem__, good.tolist()), strict=True))

    def encoded(self) -> tuple[list[bytes], np.ndarray]:
        """(frequent symbols in order, their ranks in the texts' order; -1: a break or another word)."""
        self._test()
        found = sorted((s, i) for i, s in self.symbols.items())
        rank = np.full(len(self.hashes) + 1, -1, np.int64)
        rank[[i for _, i in found]] = np.arange(len(found))
        ids = rank[np.concatenate(self.runs)]
        # One break is as good as many.
        return [s for s, _ in found], ids[np.concatenate(([True], (ids[1:] >= 0) | (ids[:-1] >= 0)))]


def _encode(words: Frequent):
    """Texts as shards: frequent symbols, and ranks in the texts' order."""
    portion, shard_words = PORTION, SHARD_WORDS

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(words)

        def row() -> pa.RecordBatch:
            symbols, ids = shard.encoded()
            columns = [[b" ".join(symbols)], [_packed(ids.astype(np.int32))]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["symbols", "ids"])

        for batch in batches:
            for lang, tokens in _tokens(batch, portion):
                shard.add(lang, tokens)
                if shard.size >= shard_words and tokens[-1:] == [_BREAK]:
                    yield row()
                    shard.clear()
                    if len(shard.hashes) > KNOWN:
                        shard.forget()
        if shard.size:
            yield row()

    return encode


def _phrases(
    symbols: list[bytes], ids: np.ndarray, lengths: tuple[int, ...], pairs: Frequent | None
) -> tuple[np.ndarray, np.ndarray]:
    """The sorted phrases of a shard of the given lengths, by rank, and their counts."""
    ok = (ids[:-1] >= 0) & (ids[1:] >= 0)
    if pairs is not None:
        hashes, at = _hashes(symbols), np.flatnonzero(ok)
        ok[at] = pairs.has(np.column_stack((hashes[ids[at]], hashes[ids[at + 1]])))
    grams = []
    for length in lengths:
        whole = ok[: max(0, len(ok) - length + 2)].copy()
        for d in range(1, length - 1):
            whole &= ok[d : len(whole) + d]
        at = np.flatnonzero(whole)
        part = np.full((len(at), MAX_WORDS), -1, np.int64)
        for d in range(length):
            part[:, d] = ids[at + d]
        grams.append(part)
    grams = np.concatenate(grams)
    return _sum_sorted(grams, np.ones(len(grams), np.int64))


def _first_at(symbols: list[bytes], grams: np.ndarray, cut: tuple[bytes, ...]) -> int:
    """How many of the sorted phrases come before ``cut``."""
    low, high = 0, len(grams)
    for d, symbol in enumerate(cut):
        rank = bisect.bisect_left(symbols, symbol)
        column = grams[low:high, d]
        left, right = np.searchsorted(column, rank), np.searchsorted(column, rank, side="right")
        if rank == len(symbols) or symbols[rank] != symbol or left == right:
            return low + int(left)
        low, high = low + int(left), low + int(right)
    return low


def _own_symbols(symbols: list[bytes], grams: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    used, back = np.unique(grams, return_inverse=True)
    back = back.reshape(grams.shape)
    if len(used) and used[0] < 0:
        used, back = used[1:], back - 1
    return [symbols[i] for i in used.tolist()], back


def _cut(symbols: list[bytes], grams: np.ndarray, counts: np.ndarray, cuts: list[tuple[bytes, ...]]) -> Iterator[list]:
    """An automaton for each range that has phrases: [range, symbols, automaton columns]."""
    at = [0, *(_first_at(symbols, grams, c) for c in cuts), len(grams)]
    for number, (low, high) in enumerate(zip(at[:-1], at[1:], strict=True)):
        if low < high:
            own, part = _own_symbols(symbols, grams[low:high])
            yield [number, b" ".join(own), *Automaton.of_sorted(part, counts[low:high]).columns()]


def _automata(pairs: Frequent | None, lengths: tuple[int, ...], cuts):
    """Shards as automata of their phrases, one for each range."""
    names = ["range", "symbols", "label", "weight", "first", "target"]
    kinds = [pa.int32()] + [pa.binary()] * 5

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, packed in zip(batch.column("symbols"), batch.column("ids"), strict=True):
                symbols = text.as_py().split(b" ") if len(text.as_py()) else []
                grams, counts = _phrases(symbols, _unpacked(packed.as_py(), np.int32), lengths, pairs)
                found = list(_cut(symbols, grams, counts, cuts.value))
                columns = zip(*found, strict=True) if found else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return build


def _united(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The union of the automata in a table: symbols, phrases in order, sums of the weights."""
    found = []
    for row in table.select(["symbols", "label", "weight", "first", "target"]).to_pylist():
        automaton = Automaton.of_columns(row["label"], row["weight"], row["first"], row["target"])
        found.append((row["symbols"].split(b" "), *automaton.paths()))
    symbols = sorted(set().union(*(s for s, _, _ in found)))
    number = {s: i for i, s in enumerate(symbols)}
    grams = []
    for own, part, _ in found:
        there = np.array([*(number[s] for s in own), -1], np.int64)
        grams.append(there[part])
    return symbols, *_sum_sorted(np.concatenate(grams), np.concatenate([c for _, _, c in found]))


def _unite(table: pa.Table) -> pa.Table:
    symbols, grams, counts = _united(table)
    at = np.flatnonzero(counts >= MIN_COUNT)
    phrases = [b" ".join(symbols[i] for i in row if i >= 0) for row in grams[at].tolist()]
    return pa.table(
        {
            "phrase": pa.array(phrases, pa.binary()),
            "words": pa.array((grams[at] >= 0).sum(axis=1), pa.int32()),
            "f": pa.array(counts[at]),
        }
    )


def _draw_cuts(docs: DataFrame, total: int, ranges: int) -> list[tuple[bytes, ...]]:
    """At most ``ranges - 1`` phrases that cut all phrases into ranges, drawn from a bounded sample."""
    share = max(1, total // CUT_DOCS)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                h = xxhash.xxh64_intdigest(text)
                if h % share == 0:
                    words = words_of([text])
                    for k in range(CUTS_A_DOC):
                        at = (h >> (8 * k)) % max(1, len(words))
                        phrase = words[at : at + MAX_WORDS]
                        phrase = phrase[: phrase.index(_BREAK)] if _BREAK in phrase else phrase
                        if phrase and sum(map(len, phrase)) <= CUT_BYTES:
                            found.add(b" ".join(lang + b"\t" + w for w in phrase))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], ["phrase"])

    drawn = _rows(docs).mapInArrow(some, "phrase binary").distinct().limit(CUT_DOCS * CUTS_A_DOC).toArrow()
    phrases = sorted({tuple(p.split(b" ")) for p in drawn.column(0).to_pylist()})
    at = np.unique(np.linspace(0, len(phrases), ranges + 1).astype(int)[1:-1])
    return [phrases[i] for i in at.tolist() if i < len(phrases)]


def _range_of(cuts):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = cuts.value
        for batch in batches:
            found = [bisect.bisect_right(limits, tuple(p.split(b" "))) for p in batch.column("part").to_pylist()]
            at = batch.schema.get_field_index("range")
            yield batch.set_column(at, "range", pa.array(found, pa.int32()))

    return place


def _placed(df: DataFrame, cuts) -> DataFrame:
    """``df`` with the range of its column part."""
    df = df.withColumn("range", F.lit(0))
    return df.mapInArrow(_range_of(cuts), df.schema)


def _composed(key: tuple, lookups: pa.Table, frequent: pa.Table) -> pa.Table:
    """The sorted lookups of a range composed with the automaton of its frequent phrases."""
    parts = [p.split(b" ") for p in frequent.column("part").to_pylist()]
    symbols = sorted({s for p in parts for s in p})
    number = {s: i for i, s in enumerate(symbols)}

    def matrix(rows: list[list[bytes]]) -> np.ndarray:
        out = np.full((len(rows), MAX_WORDS), -1, np.int64)
        for i, row in enumerate(rows):
            out[i, : len(row)] = [number.get(s, -2) for s in row]
        return out

    grams, counts = _sum_sorted(matrix(parts), frequent.column("f").to_numpy())
    wanted = matrix([p.split(b" ") for p in lookups.column("part").to_pylist()])
    found = Automaton.of_sorted(grams, counts).compose(wanted) if len(grams) else np.zeros(len(wanted), np.int64)
    out = lookups.select(["phrase", "f", "k", "side"])
    return out.append_column("found", pa.array(found))


def part_counts(lookups: DataFrame, frequent: DataFrame, cuts) -> DataFrame:
    """``lookups`` (phrase, f, k, side, part) with ``found``, the count of part among ``frequent``.

    A range with many lookups, as those of one very common word, is dealt out to several tasks, each with
    the range's frequent phrases.
    """
    spark = lookups.sparkSession
    lookups = _read(spark, _placed(lookups, cuts), "lookups")
    held = _placed(frequent.select(F.col("phrase").alias("part"), "f"), cuts)
    crowd = lookups.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / LOOKUPS).cast("int").alias("deals"))
    # One row a range, so at most MAX_RANGES rows.
    path = fresh_path(spark, "collocations-crowd")
    crowd.write.parquet(path)
    deals = (F.broadcast(read_table(spark, path, crowd.schema)) for _ in range(2))
    lookups = lookups.join(next(deals), "range").withColumn(
        "deal", F.pmod(F.xxhash64("phrase", "k", "side"), F.col("deals")).cast("int")
    )
    held = held.join(next(deals), "range").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    lookups, held = lookups.drop("deals"), held.drop("deals")
    keys = ["range", "deal"]
    return (
        lookups.groupBy(*keys)
        .cogroup(held.groupBy(*keys))
        .applyInArrow(_composed, "phrase binary, f long, k int, side int, found long")
    )


def count_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame, object]:
    """(symbol counts, frequent phrases of one to four words, cuts of the ranges).

    All counts are over whole texts and exact; phrases below ``MIN_COUNT`` are left out of the second.
    """
    spark = docs.sparkSession
    rows = _rows(docs)
    singles = rows.mapInArrow(_count_symbols, "phrase binary, f long")
    singles = _read(spark, singles.groupBy("phrase").agg(F.sum("f").alias("f")), "words")
    frequent = singles.where(F.col("f") >= MIN_COUNT)
    total = singles.agg(F.sum("f")).first()[0] or 0
    ranges = min(MAX_RANGES, max(MIN_RANGES, total // RANGE_WORDS))
    cuts = spark.sparkContext.broadcast(_draw_cuts(docs, docs.count(), ranges))
    pairs, levels = None, []
    encoded = rows.mapInArrow(_encode(Frequent(frequent)), "symbols binary, ids binary")
    encoded = _read(spark, encoded, "shards")
    for name, lengths in (("pairs", (2,)), ("longer", (3, 4))):
        shards = encoded.mapInArrow(
            _automata(pairs, lengths, cuts),
            "range int, symbols binary, label binary, weight binary, first binary, target binary",
        )
        counted = shards.groupBy("range").applyInArrow(_unite, "phrase binary, words int, f long")
        levels.append(_read(spark, counted, name))
        if pairs is None:
            pairs = Frequent(levels[0])
    phrases = frequent.select("phrase", F.lit(1).alias("words"), "f")
    for level in levels:
        phrases = phrases.unionByName(level)
    return singles, phrases, cuts


def _slices(first: int, last: int):
    """The symbols from place ``first`` to ``last`` (from 1) of the array column symbols, joined."""
    return F.array_join(F.slice(F.col("symbols"), first, last - first + 1), " ").cast("binary")


def _lookups(candidates: DataFrame) -> DataFrame:
    parts = candidates.withColumn("symbols", F.split(F.col("phrase").cast("string"), " "))
    rows = []
    for words in range(2, MAX_WORDS + 1):
        whole = parts.where(F.col("words") == words)
        for k in range(1, words):
            for side, part in ((0, _slices(1, k)), (1, _slices(k + 1, words))):
                rows.append(whole.select("phrase", "f", F.lit(k).alias("k"), F.lit(side).alias("side"), part.alias("part")))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def _inside(candidates: DataFrame) -> DataFrame:
    """(phrase, longer): the largest count of a longer candidate that holds the phrase."""
    parts = candidates.withColumn("symbols", F.split(F.col("phrase").cast("string"), " "))
    slices = []
    for words in range(3, MAX_WORDS + 1):
        whole = parts.where(F.col("words") == words)
        for size in range(2, words):
            for at in range(1, words - size + 2):
                slices.append(whole.select(_slices(at, at + size - 1).alias("phrase"), "f"))
    out = slices[0]
    for more in slices[1:]:
        out = out.unionByName(more)
    return out.groupBy("phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of each language.

    ``a`` is the count of a phrase of two to four words, ``l`` and ``r`` those of its parts at the cut
    with the least score floor(2000000 a / (l + r)), ``n`` all words of the language. A phrase goes if a
    longer candidate holds it in 80 of 100 occurrences. Ties go by count, then by phrase.

    Null texts are empty, a null language is "und", repeated rows and ids count as often as they occur,
    other columns are not read, and an empty table gives no rows. Bytes that are no UTF-8 count as they
    are.
    """
    spark = docs.sparkSession
    singles, phrases, cuts = count_phrases(docs)
    candidates = phrases.where(F.col("words") > 1)
    found = part_counts(_lookups(candidates), phrases, cuts)
    sides = found.groupBy("phrase", "f", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("found"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("found"))).alias("r"),
    )
    wide = "cast({} as decimal(20,0))"
    score = F.expr(f"{SCALE}BD * {wide.format('f')} div ({wide.format('l')} + {wide.format('r')})")
    cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = sides.groupBy("phrase", F.col("f").alias("a")).agg(cut)
    covered = F.expr(f"100BD * {wide.format('longer')} >= {COVERED}BD * {wide.format('a')}")
    kept = scored.join(_inside(candidates), "phrase", "left").where(~F.coalesce(covered, F.lit(False)))
    kept = _read(spark, kept, "scored")

    text = F.col("phrase").cast("string")
    lang = F.url_decode(F.substring_index(text, "\t", 1))
    named = kept.select(
        lang.alias("lang"),
        F.array_join(F.transform(F.split(text, " "), lambda s: F.substring_index(s, "\t", -1)), " ").alias("phrase"),
        "a",
        "cut.l",
        "cut.r",
        "cut.score",
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of each bucket hold the first of the language: at most BUCKETS x top rows meet at the end.
    named = named.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    part = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    part = part.where(F.col("rank") <= top).drop("rank", "bucket")
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    lang = F.url_decode(F.substring_index(F.col("phrase").cast("string"), "\t", 1))
    totals = singles.select(lang.alias("lang"), "f")
    totals = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
