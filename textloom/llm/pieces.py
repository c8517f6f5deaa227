"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A text is cut where a word begins (no piece of the vocabulary runs over such a place, which is checked
when the model is read). In every word an agenda holds the adjacent pairs whose union is a piece; the
best-scored pair, leftmost on ties, is merged until none is left. With dropout, a candidate is skipped
for good when a keyed hash of (seed, document, its two ends, the piece) falls below the rate, so the
segmentation varies over documents and places but is the same on every run.

The agenda of all short words of a batch is worked through together with array arithmetic, one merge
a word and round. A long word is cut wherever two code points meet that no piece has side by side, which
changes no merge; a part that is still long has a heap of its own.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
# Code points encoded together, and the classes of word sizes that share rounds; longer words do not.
TOGETHER = 1 << 18
WORD_SIZES = (4, 8, 12, 16, 24, 48)
LONG_WORD, POSITIONS = WORD_SIZES[-1], 64
NEVER = np.int32(2**31 - 1)
# Odd factors of the keyed hash of a candidate.
_START, _END, _PIECE = 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _dropped_one(salt: int, start: int, end: int, piece: int, limit: int) -> bool:
    """``Encoder._dropped`` for a single candidate."""
    spot = (start * _START + end * _END + piece * _PIECE) & _MASK ^ salt
    spot = (spot ^ spot >> 32) * _PIECE & _MASK
    return spot >> 32 < limit


class Pieces:
    """The tables of a SentencePiece BPE model, read from its public file."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.unknown, self.size = sp.unk_id(), size
        self.byte_ids = np.full(256, -1, np.int32)
        self.output = [b""] * size
        plain: dict[str, int] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.output[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain[piece], self.output[i] = i, piece.replace("▁", " ").encode()
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces, so it cannot encode without loss")
        if any("▁" in p.lstrip("▁") for p in plain):
            raise ValueError("a piece runs over the start of a word")
        # Equal scores have one rank; a lower rank is merged first.
        scores = sorted({-sp.get_score(i) for i in plain.values()})
        rank = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(size, NEVER, np.int32)
        for i in plain.values():
            self.rank[i] = rank[-sp.get_score(i)]
        self.char_ids = np.full(0x110000, -1, np.int32)
        pairs: dict[int, int] = {}
        for piece, i in plain.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
            for k in range(1, len(piece)):
                a, b = plain.get(piece[:k]), plain.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * (size + 1) + b + 1] = i
        # Adjacent code points of all pieces: a word can be cut between any others without a change.
        inside = {ord(a) << 21 | ord(b) for piece in plain for a, b in zip(piece, piece[1:])}
        self.inside = np.array(sorted(inside), np.int64)
        # The same pairs and ranks as plain numbers, for words that are merged one pair at a time.
        self.pairs, self.ranks = pairs, self.rank.tolist()
        self._table(pairs)

    def _table(self, pairs: dict[int, int]) -> None:
        """Pairs in an open-addressed table of arrays, a quarter full at most."""
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, -1, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._place(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            done = self.keys[at] == keys
            self.merged[at[done]] = values[done]
            keys, values, at = keys[~done], values[~done], (at[~done] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).view(np.int64)

    def union(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of ids forms, -1 if none; an id of -1 never merges."""
        keys = a.astype(np.int64) * (self.size + 1)
        keys += b
        keys += 1  # an id of -1 gives a number that no pair has
        at = self._place(keys)
        found = self.keys[at]
        same = found == keys
        out = np.where(same, self.merged[at], np.int32(-1))
        open_ = np.flatnonzero((found >= 0) & ~same)
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.merged[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


@lru_cache(maxsize=2)
def pieces(model: str) -> Pieces:
    return Pieces(model)


class Encoder:
    def __init__(self, model: str, dropout: float = 0.0, seed: int = 0) -> None:
        if not 0 <= dropout < 1:
            raise ValueError("dropout must be at least 0 and below 1")
        self.p = pieces(model)
        self.limit = np.uint64(int(dropout * (1 << 32)))
        self.seed = seed

    def encode(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each). ``keys`` name the documents."""
        ids, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < TOGETHER):
                size += len(texts[end]) + 1
                end += 1
            a, b = self._together(texts[at:end], keys[at:end])
            ids.append(a)
            counts.append(b)
            at = end
        return np.concatenate(ids), np.concatenate(counts)

    def _together(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        p = self.p
        # Every text that is not empty begins with one more space, as the model's texts do.
        marked = ["▁" + t if t else "" for t in texts]
        lengths = np.array([len(t) for t in marked], np.int64)
        points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).copy()
        n = len(points)
        if not n:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        begins = np.cumsum(lengths) - lengths
        heads = begins[lengths > 0]
        # A literal U+2581 is written as bytes; a space takes its place among the symbols.
        literal = points == SPACE
        literal[heads] = False
        points[points == 0x20] = SPACE
        symbols = p.char_ids[points]
        symbols[literal] = -1
        spaces = (points == SPACE) & ~literal
        starts = spaces.copy()
        starts[1:] &= ~spaces[:-1]
        starts[heads] = True
        self._cut_long(points, starts)
        owner = np.repeat(np.arange(len(texts)), lengths)
        salt = _mix(np.array([k & ((1 << 64) - 1) for k in keys], np.uint64) + np.uint64(self.seed))
        out = np.full(n, -2, np.int32)  # -2: inside a piece, -1: written as bytes
        first = np.flatnonzero(starts)
        size = np.diff(np.append(first, n))
        place = np.arange(n, dtype=np.int64) - np.repeat(begins, lengths)
        low = 0
        for high in (1, *WORD_SIZES):
            words = np.flatnonzero((size > low) & (size <= high))
            at, low = first[words], high
            if high == 1:
                out[at] = symbols[at]
            elif len(at):
                self._rounds(symbols, at, size[words], place[at], salt[owner[at]], out)
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            a, b = int(first[i]), int(first[i] + size[i])
            self._heap(symbols[a:b], int(place[a]), salt[owner[a]], out[a:b])
        return self._flatten(out, points, owner, len(texts))

    def _cut_long(self, points: np.ndarray, starts: np.ndarray) -> None:
        """Begin a word wherever no piece can run over a place inside a long word."""
        first = np.flatnonzero(starts)
        long = np.diff(np.append(first, len(points))) > LONG_WORD
        if not long.any() or not len(self.p.inside):
            return
        inner = np.flatnonzero(np.repeat(long, np.diff(np.append(first, len(points)))) & ~starts)
        keys = points[inner - 1].astype(np.int64) << 21 | points[inner]
        known = self.p.inside
        found = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
        starts[inner[~found]] = True

    def _dropped(self, salt, start, end, piece) -> np.ndarray:
        spot = np.asarray(start, np.int64).view(np.uint64) * np.uint64(_START)
        spot += np.asarray(end, np.int64).view(np.uint64) * np.uint64(_END)
        spot += np.asarray(piece, np.int64).view(np.uint64) * np.uint64(_PIECE)
        spot ^= salt
        spot ^= spot >> np.uint64(32)
        spot *= np.uint64(_PIECE)
        return (spot >> np.uint64(32)) < self.limit

    def _rate(self, a, b, salt, start, end, offset) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of candidate pairs; a skipped or impossible one has rank ``NEVER``."""
        piece = self.p.union(a, b)
        rank = np.where(piece >= 0, self.p.rank[piece], NEVER)
        if self.limit:
            able = np.flatnonzero(piece >= 0)
            base = offset[able]
            gone = self._dropped(salt[able], start[able] + base, end[able] + base, piece[able])
            rank[able[gone]] = NEVER
        return piece, rank

    def _rounds(self, symbols, first, size, place, salt, out) -> None:
        """Words of like length as the columns of matrices, one merge a word in each round.

        Row i of ``agenda`` has the candidate whose left symbol begins at code point i of the word:
        rank and position in one number, so the least of a column is the best-scored, leftmost pair.
        Symbols are chained by the rows where the one after and the one before begin.
        """
        rows, n = int(size.max()), len(first)
        flat = np.minimum(first[None, :] + np.arange(rows + 1)[:, None], len(symbols) - 1)
        inside = np.arange(rows + 1)[:, None] < size[None, :]
        sym = np.where(inside, symbols[flat], np.int32(-1)).ravel()
        after = np.repeat(np.arange(1, rows + 2, dtype=np.int64), n)
        before = np.repeat(np.arange(-1, rows, dtype=np.int64), n)
        agenda = np.full((rows, n), NEVER, np.int32)
        piece = np.full(rows * n, -1, np.int32)

        def rate(column: np.ndarray, own: np.ndarray, right: np.ndarray) -> np.ndarray:
            left = own // n
            found, rank = self._rate(
                sym[own], sym[right], salt[column], left, after[right], place[column]
            )
            piece[own] = found
            return np.where(rank < NEVER, rank * np.int32(POSITIONS) + left.astype(np.int32), NEVER)

        own = np.flatnonzero(inside[1:])
        agenda.ravel()[own] = rate(own % n, own, own + n)
        columns = np.arange(n)  # words that have a column in the agenda
        while len(columns):
            best = agenda.min(axis=0)
            alive = best < NEVER
            busy = int(alive.sum())
            if busy < 0.75 * len(columns):
                agenda, columns, best = agenda[:, alive], columns[alive], best[alive]
                alive = np.ones(busy, bool)
                if not busy:
                    break
            slot = np.flatnonzero(alive)
            word, i = columns[slot], (best[slot] % POSITIONS).astype(np.int64)
            own = i * n + word
            j = after[own]
            gone = j * n + word
            k = after[gone]
            sym[own], sym[gone] = piece[own], -2
            after[own] = k
            before[np.minimum(k, rows) * n + word] = i
            agenda[i, slot] = NEVER
            # The last row of a word has no candidate, and row ``rows`` none at all.
            agenda[np.minimum(j, rows - 1), slot] = NEVER
            h = before[own]
            some, others = np.flatnonzero(k < size[word]), np.flatnonzero(h >= 0)
            both, at = np.concatenate((word[some], word[others])), np.concatenate((i[some], h[others]))
            mate = np.concatenate((k[some], i[others]))
            slots = np.concatenate((slot[some], slot[others]))
            agenda[at, slots] = rate(both, at * n + both, mate * n + both)
        out[flat[:-1][inside[:-1]]] = sym.reshape(rows + 1, n)[:-1][inside[:-1]]

    def _heap(self, symbols: np.ndarray, offset: int, salt: np.uint64, out: np.ndarray) -> None:
        """The agenda of one long word: rated at once with arrays, then pair by pair in plain numbers."""
        p = self.p
        n, width, limit, salt_ = len(symbols), p.size + 1, int(self.limit), int(salt)
        pairs, ranks = p.pairs, p.ranks
        sym = symbols.tolist()
        after, before, stop = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        at = np.arange(n - 1)
        piece, rank = self._rate(symbols[:-1], symbols[1:], np.full(n - 1, salt), at, at + 2, np.full(n - 1, offset))
        able = np.flatnonzero(rank < NEVER)
        agenda = list(zip(rank[able].tolist(), able.tolist(), (able + 2).tolist(), piece[able].tolist()))
        heapq.heapify(agenda)
        while agenda:
            _, i, end, union = heapq.heappop(agenda)
            j = after[i] if sym[i] != -2 else n
            # Still the pair that was pushed: both ends are where they were.
            if j >= n or stop[j] != end or pairs.get(sym[i] * width + sym[j] + 1) != union:
                continue
            k = after[j]
            sym[i], sym[j], stop[i], after[i] = union, -2, end, k
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left < 0 or right >= n:
                    continue
                found = pairs.get(sym[left] * width + sym[right] + 1)
                if found is None or (limit and _dropped_one(salt_, left + offset, stop[right] + offset, found, limit)):
                    continue
                heapq.heappush(agenda, (ranks[found], left, stop[right], found))
        out[:] = sym

    def _flatten(self, out, points, owner, n_texts) -> tuple[np.ndarray, np.ndarray]:
        """Symbols to ids: a code point without a piece becomes the pieces of its bytes."""
        kept = out != -2
        ids, owner = out[kept], owner[kept]
        raw = ids == -1
        if not raw.any():
            return ids, np.bincount(owner, minlength=n_texts)
        codes = points[kept][raw]
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        data = codes.astype("<u4").tobytes().decode("utf-32-le").encode()
        repeat = np.ones(len(ids), np.int64)
        repeat[raw] = width
        result = np.repeat(ids, repeat)
        result[np.repeat(raw, repeat)] = self.p.byte_ids[np.frombuffer(data, np.uint8)]
        return result, np.bincount(np.repeat(owner, repeat), minlength=n_texts)


def decode(ids: list[int], model: str = MODEL) -> str:
    """The text of ``ids``: the pieces one after another, without the space put before the text."""
    table = pieces(model).output
    return b"".join([table[i] for i in ids])[1:].decode()


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    model: str = MODEL,
    dropout: float = 0.1,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with ``ids`` (array of int): the pieces of ``text``.

    No shuffle. The hash is keyed by the id's text, so a document is cut alike wherever it is read;
    a null id counts as a key of its own. A null text counts as the empty one, which has no ids. Other
    columns are kept, one called ids is replaced, and repeated rows stay repeated.
    """
    docs = docs.drop("ids")
    schema = StructType([*docs.schema.fields, StructField("ids", ArrayType(IntegerType()))])
    key = "_key"
    while key in docs.columns:
        key += "_"
    docs = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("string")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, dropout, seed)
        for batch in batches:
            for part in _slices(batch):
                texts = part.column("text").fill_null("").to_pylist()
                ids, counts = encoder.encode(texts, part.column(key).to_pylist())
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                rows = part.drop_columns([key])
                arrays = [*rows.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
                yield pa.RecordBatch.from_arrays(arrays, [*rows.schema.names, "ids"])

    return docs.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids`` (null ids: the empty text)."""
    encoded = encoded.drop("decoded")
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                texts = [decode(i.values.to_numpy().tolist() if i.is_valid else [], model) for i in part.column("ids")]
                arrays = [*part.columns, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def digest(encoded: DataFrame, id_col: str = "doc_id", model: str = MODEL) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of encoded documents, decoded again.

    ``ids_sha256`` is over the ids as little-endian 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [i.values.to_numpy().astype("<i4") if i.is_valid else np.empty(0, "<i4") for i in batch.column("ids")]
            texts = [decode(r.tolist(), model).encode() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r.tobytes()).hexdigest() for r in rows]),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                ],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = encoded.schema[id_col].dataType.simpleString()
    out = encoded.select(F.col(id_col).alias("id"), "ids").mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return out.withColumnRenamed("id", id_col)
