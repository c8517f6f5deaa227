"""Token id columns: encode and decode (Arrow functions), truncate, pad, mask, labels.

The encoder gets pre-tokens that the JVM has already split and normalized. It takes an Arrow batch
in slices of so many bytes and gives each slice back before the next; it finds the distinct ones of
a slice, runs the merges once for each (kept in a per-worker cache, and all that it lacks side by side),
and lays the ids out with array arithmetic, so Python never loops over the tokens of a text.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from textloom.functions.pretokens import PAD_TOKEN, PRETOKEN, SPECIAL_TOKENS, byte_chars, pretokens

if TYPE_CHECKING:
    from textloom.operators.vocabulary import Vocabulary

# Longest sequence, and its default use in truncation and padding.
MAX_LENGTH = 2048
# A vocabulary may list more merges than tokens (joined texts can repeat), but not many more.
MAX_BROADCAST_ROWS = 1_000_000
# Cached words of a worker, and the most ids of one of them; pre-token bytes and ids worked on at once.
_CACHE_WORDS, _CACHE_IDS = 200_000, 64
SLICE_BYTES, SLICE_IDS = 1 << 21, 1 << 20
_CACHES: dict[str, dict[str, list[int]]] = {}
# Bytes of the longest word that is merged beside others, symbols merged at a time, and the most entries of a
# table of all pairs of symbols; beyond it pairs are looked up in a sorted list.
SHORT_BYTES, MERGED_SYMBOLS, PAIR_TABLE = 64, 1 << 17, 1 << 21


def word_cache(codec: str) -> dict[str, list[int]]:
    """Encoded words of a codec in this Python worker, kept from task to task."""
    if codec not in _CACHES:
        _CACHES.clear()
        _CACHES[codec] = {}
    return _CACHES[codec]


def merge_symbols(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges to one word, lowest rank first, then leftmost."""
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [
        (*ranks[pair], i, *pair)
        for i, pair in enumerate(zip(symbols, symbols[1:]))
        if pair in ranks
    ]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, product, i, left, right = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], alive[j], after[i] = product, False, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (symbols[a], symbols[b]) in ranks:
                pair = (symbols[a], symbols[b])
                heapq.heappush(heap, (*ranks[pair], a, *pair))
    return [s for s, live in zip(symbols, alive) if live]


def _ends(counts: np.ndarray) -> np.ndarray:
    """Where each of several runs ends, after a 0 for the start of the first."""
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def _slices(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of items (from, to) of at most ``most`` in all; a larger item is alone. ``ends`` is where items end,
    after the start of the first."""
    start, last = 0, len(ends) - 1
    while start < last:
        end = int(np.searchsorted(ends, ends[start] + most, "right")) - 1
        end = min(max(end, start + 1), last)
        yield start, end
        start = end


def _byte_ends(words: pa.Array) -> np.ndarray:
    """Where each word of an array ends among the bytes of its buffer, without a copy."""
    if not len(words):
        return np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(words.type) else np.int32
    return np.frombuffer(words.buffers()[1], width)[words.offset : words.offset + len(words) + 1]


@dataclass
class MergeTable:
    """Merges as arrays, by which many words are merged side by side."""

    width: int
    keys: np.ndarray
    order: np.ndarray
    products: np.ndarray
    dense: bool

    @classmethod
    def of(cls, ranks: dict[tuple[int, int], tuple[int, int]], n_tokens: int) -> MergeTable | None:
        """None where a merge can make a pair that ranks before it: then all places of a pair are not one step."""
        ranked = sorted((rank, left, right, product) for (left, right), (rank, product) in ranks.items())
        made = {product: rank for rank, _, _, product in ranked}
        if len({row[0] for row in ranked}) < len(ranked):
            return None
        if any(made.get(side, -1) >= rank for rank, left, right, _ in ranked for side in (left, right)):
            return None
        rows = np.array(ranked, np.int64).reshape(-1, 4)
        keys, order = rows[:, 1] * n_tokens + rows[:, 2], np.arange(len(rows), dtype=np.int32)
        products = rows[:, 3].astype(np.int32)
        if n_tokens * n_tokens <= PAIR_TABLE:
            table = np.full(n_tokens * n_tokens, len(rows), np.int32)
            table[keys] = order
            return cls(n_tokens, keys, table, products, True)
        at = np.argsort(keys)
        return cls(n_tokens, keys[at], order[at], products, False)

    def places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair among the merges; their number for a pair that is none."""
        wanted = left * np.int64(self.width) + right
        if self.dense:
            return self.order[wanted]
        if not len(self.keys):
            return np.zeros(len(wanted), np.int32)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], np.int32(len(self.keys)))

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and lengths of words after all merges. None is empty, and they lie one behind the other.

        A step merges the first-ranked pair of each word at all its places, which is what one merge after the
        other does when no merge makes a pair that ranks before it.
        """
        none, words = len(self.products), np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
            sizes = np.diff(np.concatenate((first, [len(symbols)])))
            place = np.full(len(symbols), none, np.int32)
            place[:-1] = self.places(symbols[:-1], symbols[1:])
            place[first[1:] - 1] = none
            best = np.minimum.reduceat(place, first)
            live = best < none
            if not live.all():
                rest = np.repeat(live, sizes)
                done_symbols.append(symbols[~rest])
                done_words.append(words[~rest])
                symbols, words, place = symbols[rest], words[rest], place[rest]
                best, sizes = best[live], sizes[live]
                if not len(symbols):
                    break
            hits = place == np.repeat(best, sizes)
            # In a run of one symbol its pairs overlap: every other one is merged, from the left.
            follows = hits[1:] & hits[:-1]
            if follows.any():
                at = np.arange(len(hits))
                starts = np.where(np.concatenate(([True], ~follows)), at, 0)
                hits &= (at - np.maximum.accumulate(starts)) % 2 == 0
            symbols[hits] = self.products[place[hits]]
            kept = np.concatenate(([True], ~hits[:-1]))
            symbols, words = symbols[kept], words[kept]
        if not done_words:
            return symbols, lengths
        words = np.concatenate(done_words)
        return np.concatenate(done_symbols)[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lengths))


def merge_words(
    words: list[bytes], byte_id: list[int], ranks: dict[tuple[int, int], tuple[int, int]], table: MergeTable | None
) -> list[list[int]]:
    """Ids of words; short ones are merged side by side, long ones each on its own."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    beside = (sizes > 0) & (sizes <= SHORT_BYTES) if table is not None else np.zeros(len(words), bool)
    merged: list[list[int]] = [[]] * len(words)
    for i in np.flatnonzero(~beside).tolist():
        merged[i] = merge_symbols([byte_id[b] for b in words[i]], ranks)
    short, ids = np.flatnonzero(beside), np.array(byte_id, np.int32)
    for a, b in _slices(_ends(sizes[short]), MERGED_SYMBOLS):
        picked = short[a:b].tolist()
        symbols = ids[np.frombuffer(b"".join([words[i] for i in picked]), np.uint8)]
        symbols, lengths = table.merge(symbols, sizes[short[a:b]])
        flat, ends = symbols.tolist(), _ends(lengths).tolist()
        for i, start, end in zip(picked, ends, ends[1:]):
            merged[i] = flat[start:end]
    return merged


@dataclass
class Codec:
    """Encoder and decoder columns for one vocabulary, broadcast once."""

    tokens: list[str]
    ranks: dict[tuple[int, int], tuple[int, int]]
    specials: tuple[str, ...]
    spark: SparkSession
    # Ids of the special tokens where they are not the first ids; whether texts are brought to NFKC; and
    # the pattern of the pre-tokens.
    special_ids: tuple[int, ...] | None = None
    normalize: bool = True
    pattern: str = PRETOKEN

    def __post_init__(self) -> None:
        if max(len(self.tokens), len(self.ranks)) > MAX_BROADCAST_ROWS:
            raise ValueError("vocabulary is too large to broadcast")
        back = {ch: b for b, ch in enumerate(byte_chars())}
        if self.special_ids is None:
            self.special_ids = tuple(range(len(self.specials)))
        literal = set(self.special_ids)
        as_bytes = [
            t.encode("utf-8") if i in literal else bytes(back[ch] for ch in t) for i, t in enumerate(self.tokens)
        ]
        first = {t: i for i, t in enumerate(self.tokens)}
        byte_id = [first[ch] for ch in byte_chars()]
        special_id = dict(zip(self.specials, self.special_ids, strict=True))
        context = self.spark.sparkContext
        table = MergeTable.of(self.ranks, len(self.tokens))
        self._encoding = context.broadcast((self.ranks, byte_id, special_id, table))
        self._bytes = context.broadcast(as_bytes)
        self._key = uuid.uuid4().hex
        self.pad_id = special_id.get(PAD_TOKEN, 0)

    @classmethod
    def of(cls, vocabulary: Vocabulary, spark: SparkSession) -> Codec:
        """A codec straight from training."""
        pairs = zip(vocabulary.merge_ids(), vocabulary.merges, strict=True)
        ranks = {pair: (rank, merge.token_id) for rank, (pair, merge) in enumerate(pairs)}
        return cls(list(vocabulary.tokens), ranks, tuple(vocabulary.tokens[: vocabulary.n_special]), spark)

    @classmethod
    def from_tables(
        cls, vocab: DataFrame, merges: DataFrame, specials: list[str] | tuple[str, ...] = SPECIAL_TOKENS
    ) -> Codec:
        """A codec from the vocab and merges tables; both are bounded by the vocabulary size."""
        top = MAX_BROADCAST_ROWS + 1
        tokens = [r.token for r in vocab.orderBy("id").limit(top).collect()]
        rows = merges.orderBy("rank").limit(top).collect()
        ranks = {(r.left_id, r.right_id): (r.rank, r.token_id) for r in rows}
        return cls(tokens, ranks, tuple(specials), vocab.sparkSession)

    def encode_words(self, words: Column) -> Column:
        """Token ids of a row's pre-tokens."""
        shared, key = self._encoding, self._key

        @F.arrow_udf(ArrayType(IntegerType()))
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for rows in batches:
                words = _ends(np.asarray(rows.value_lengths().fill_null(0)))
                for a, b in _slices(_byte_ends(rows.flatten())[words], SLICE_BYTES):
                    yield ids_of(rows.slice(a, b - a))

        def ids_of(rows: pa.Array) -> pa.Array:
            ranks, byte_id, special_id, table = shared.value
            cache = word_cache(key)

            flat, nulls = rows.flatten(), np.asarray(rows.is_null())
            row_ends = _ends(np.asarray(rows.value_lengths().fill_null(0)))
            # Ids before the end of each row, and the ids slice by slice; a slice may begin within a row.
            offsets, values, total = np.zeros(len(row_ends), np.int64), [np.zeros(0, np.int32)], 0
            for first, last in _slices(_byte_ends(flat), SLICE_BYTES):
                found = flat.slice(first, last - first).dictionary_encode()
                distinct = found.dictionary.to_pylist()
                ids = [cache.get(word) for word in distinct]
                lacking = [i for i, hit in enumerate(ids) if hit is None]
                new = merge_words([distinct[i].encode("utf-8") for i in lacking], byte_id, ranks, table)
                for i, merged in zip(lacking, new):
                    word = distinct[i]
                    ids[i] = [special_id[word]] if word in special_id else merged
                    if len(cache) < _CACHE_WORDS and len(ids[i]) <= _CACHE_IDS:
                        cache[word] = ids[i]
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                starts = _ends(lengths)
                pool = np.fromiter(chain.from_iterable(ids), np.int32, int(starts[-1]))
                picks = np.asarray(found.indices)
                sizes = lengths[picks]
                ends = _ends(sizes)
                at = np.repeat(starts[picks] - ends[:-1], sizes)
                at += np.arange(ends[-1])
                values.append(pool[at])
                low, high = np.searchsorted(row_ends, (first, last), "right")
                offsets[low:high] = total + ends[row_ends[low:high] - first]
                total += int(ends[-1])
            mask = pa.array(nulls) if nulls.any() else None
            return pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(values)), mask=mask
            )

        return encode(words)

    def encode(self, text: Column, parse_special: bool = True) -> Column:
        """Token ids of a raw text: special tokens, NFKC, pre-tokens, merges. No bos or eos is added."""
        specials = self.specials if parse_special else ()
        return self.encode_words(pretokens(text, specials, self.normalize, self.pattern))

    def decode(self, ids: Column, skip_special: bool = True) -> Column:
        """The text of token ids; bytes that are not UTF-8 become replacement characters."""
        shared, literal = self._bytes, np.array(self.special_ids, np.int64)

        @F.arrow_udf(StringType())
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            pieces = pa.array(shared.value, pa.large_binary())
            for rows in batches:
                for a, b in _slices(_ends(np.asarray(rows.value_lengths().fill_null(0))), SLICE_IDS):
                    yield texts(rows.slice(a, b - a), pieces)

        def texts(rows: pa.Array, pieces: pa.Array) -> pa.Array:
            flat = np.asarray(rows.flatten())
            row_ends = _ends(np.asarray(rows.value_lengths().fill_null(0)))
            if skip_special:
                keep = ~np.isin(flat, literal)
                row_ends = _ends(keep)[row_ends]
                flat = flat[keep]
            taken = pieces.take(pa.array(flat))
            offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
            data = taken.buffers()[2].to_pybytes() if len(taken) else b""
            cuts = offsets[row_ends]
            found = [
                None if null else data[a:b].decode("utf-8", errors="replace")
                for a, b, null in zip(cuts[:-1], cuts[1:], rows.is_null().to_pylist())
            ]
            return pa.array(found, type=pa.string())

        return decode(ids)


def truncate(ids: Column, max_length: int = MAX_LENGTH) -> Column:
    """Keep the first ``max_length`` ids."""
    return F.slice(ids, 1, max_length)


def pad(ids: Column, max_length: int, pad_id: int) -> Column:
    """Fill up on the right with the pad id."""
    missing = F.greatest(F.lit(max_length) - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(pad_id), missing))


def attention_mask(length: Column, max_length: int | None = None) -> Column:
    """Ones for real ids, then zeros for padding when rows are padded to ``max_length``."""
    ones = F.array_repeat(F.lit(1), length)
    if max_length is None:
        return ones
    missing = F.greatest(F.lit(max_length) - length, F.lit(0))
    return F.concat(ones, F.array_repeat(F.lit(0), missing))
