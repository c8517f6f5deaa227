"""Toxicity by a weighted finite-state grammar over clauses.

Three layers are composed. A lexicon acceptor reads words and emits class symbols: insults are stems
learned from labelled documents, threats, targets, negations and words of reported speech are short
fixed lists. Small transducers follow the symbols of a clause - insult, aimed threat, target, negation
before and behind, reported speech - and their product is one automaton whose state at the end of a
clause names the pattern that was matched. Order and distance count: a threat needs its object close
behind it, or an object pronoun close before it, and a negation must reach the word that it negates. A pattern has a weight, the smoothed share of toxic documents among the
labelled ones that hold it, so a negated or reported insult counts as much as the labels say. A
document's score unites its matched clauses as independent reasons.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from textloom.llm.words import shingle_hashes
from textloom.session import write_and_read

# The model is fitted on at most this many labelled documents, chosen by a hash of their id.
SAMPLE = 20_000
# Stems: prefixes of these lengths and whole words; at least this many toxic documents, no more than
# this share of clean ones among those that hold it.
STEM_LENGTHS, LEAST_TOXIC, CLEAN_SHARE = (4, 5, 6, 7, 8), 3, 0.1
# Features that may pass for insults by accident, expected over the whole sample.
ACCIDENTS = 0.02
# A word longer than this has only its prefixes as features.
LONGEST_WORD = 40
# Weights of insults and threats before any document is seen, how many documents the first counts for,
# and how many documents a pattern's factor of 1 counts for.
INSULT_WEIGHT, THREAT_WEIGHT, INSULT_COUNTS, FACTOR_COUNTS = 0.9, 0.75, 1.0, 4.0
THRESHOLD = 0.7

# Fixed values, in four languages. Insults are the lexicon before anything is learned.
INSULTS = """idiot idiots moron morons stupid dumb fool fools loser losers scum trash clown clowns pathetic
disgusting worthless imbecile jerk bastard pig filth idioten dummkopf trottel abschaum versager
widerlich wertlos imbécil estúpido estúpida idiota basura payaso inútil asqueroso imbécile crétin
abruti ordure minable débile""".split()
THREATS = """kill hurt destroy punish beat burn shoot stab töten töte verletzen verletze zerstören zerstöre
schlagen schlage matar mato mataré herir heriré golpear golpeo golpearé quemar quemo quemaré tuer tue
tuerai blesser blesserai frapper frappe frapperai brûler brûlerai""".split()
TARGETS = """you your yours he him his she her they them their du dein ihr sie tú tu
ti usted ustedes él ella ellos votre toi ton il elle ils""".split()
# Object pronouns, which may stand before the verb.
CLITICS = "dich dir euch ihn te vous".split()
NEGATIONS = """not no never neither nor cannot isn't aren't wasn't don't kein keine
nunca jamás ni ne aucun""".split()
# Negations that may also follow the verb.
LATE_NEGATIONS = "nicht nie niemals pas jamais".split()
REPORTS = """said says say told tells called calls wrote writes quoted claims claimed sagte sagt nannte
schrieb behauptet dijo dice llamó escribió dit disait appelle écrit prétend""".split()

CLAUSE_ENDS = ".!?;:\n"
CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, CLITIC, LATE = range(8)
# A negation reaches this many words ahead, one behind a threat as many back; the object of a threat is
# at most so many words behind it, an object pronoun so many before it.
REACH, OBJECT_BEHIND, OBJECT_BEFORE = 3, 2, 3


def _insult(state: int, symbol: int) -> int:
    return state or int(symbol == INSULT)


def _target(state: int, symbol: int) -> int:
    return state or int(symbol in (TARGET, CLITIC))


def _report(state: int, symbol: int) -> int:
    return state or int(symbol == REPORT)


_AIMED = 1 + OBJECT_BEHIND + OBJECT_BEFORE


def _aim(state: int, symbol: int) -> int:
    """1 to OBJECT_BEHIND: words in which a threat still finds its object; above, words in which an object
    pronoun still finds its threat; _AIMED: it was found."""
    if state == _AIMED:
        return state
    threat, pronoun = 1 <= state <= OBJECT_BEHIND, state > OBJECT_BEHIND
    if symbol == THREAT:
        return _AIMED if pronoun else OBJECT_BEHIND
    if symbol in (TARGET, CLITIC) and threat:
        return _AIMED
    if symbol == CLITIC:
        return OBJECT_BEHIND + OBJECT_BEFORE
    return 0 if state in (0, 1, OBJECT_BEHIND + 1) else state - 1


def _negation(state: int, symbol: int) -> int:
    """0 to REACH: words that the last negation still reaches; REACH + 1: it reached a match."""
    if state > REACH:
        return state
    if symbol in (INSULT, THREAT) and state:
        return REACH + 1
    return REACH if symbol in (NEGATION, LATE) else max(0, state - 1)


def _late(state: int, symbol: int) -> int:
    """0 to REACH: words in which a negation behind the last threat still counts; REACH + 1: it came."""
    if state > REACH:
        return state
    if symbol == LATE and state:
        return REACH + 1
    return REACH if symbol == THREAT else max(0, state - 1)


# (states, step) of each transducer.
MACHINES = ((2, _insult), (_AIMED + 1, _aim), (2, _target), (REACH + 2, _negation), (REACH + 2, _late), (2, _report))


def compose() -> tuple[np.ndarray, list[str | None]]:
    """The product automaton: next state by (state, symbol), and the pattern of each final state."""
    states = list(product(*(range(n) for n, _ in MACHINES)))
    number = {s: i for i, s in enumerate(states)}
    table = np.array(
        [
            [number[tuple(step(x, symbol) for x, (_, step) in zip(s, MACHINES, strict=True))] for symbol in range(8)]
            for s in states
        ]
    )
    return table, [_pattern(*s) for s in states]


def _pattern(insult: int, aim: int, target: int, negation: int, late: int, report: int) -> str | None:
    """A threat counts only if it is aimed; an insult always."""
    core = "insult" if insult else "threat" if aim == _AIMED else None
    if core is None:
        return None
    negated = negation > REACH or late > REACH
    parts = [core, "target" * target, "negated" * negated, "reported" * report]
    return " ".join(p for p in parts if p)


TABLE, PATTERNS = compose()


@dataclass(frozen=True)
class Model:
    """Insult entries (``=word`` for whole words, else stems) and pattern factors with their weights,
    and the base score. A matched clause weighs the best of its entries times its pattern's factor."""

    entries: tuple[tuple[str, float], ...]
    factors: tuple[tuple[str, float], ...]
    base: float


class Grammar:
    """The composed grammar, ready to read texts."""

    def __init__(self, entries: tuple[tuple[str, float], ...]) -> None:
        lists = ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (CLITIC, CLITICS), (LATE, LATE_NEGATIONS))
        self.words = {w: s for s, ws in lists for w in ws}
        self.words |= dict.fromkeys(THREATS, THREAT)
        self.whole = {e[1:]: w for e, w in entries if e[0] == "="}
        self.stems = {e: w for e, w in entries if e[0] != "="}
        self.lengths = sorted({len(s) for s in self.stems})
        self.search = ahocorasick.Automaton()
        for key in {*self.whole, *self.stems, *THREATS}:
            self.search.add_word(key, len(key))
        self.search.make_automaton()
        self.rows = TABLE.tolist()

    def read(self, word: str) -> tuple[int, float]:
        """The class symbol of a word and its weight. Both sides of an apostrophe are read where the whole
        has no entry: the noun of an elision, the pronoun of a contraction."""
        pieces = word.split("'")
        best = max((self.stems.get(p[:n], 0.0) for p in pieces for n in self.lengths), default=0.0)
        best = max(best, *(self.whole.get(p, 0.0) for p in pieces))
        if best:
            return INSULT, best
        known = [self.words.get(w, OTHER) for w in (word, *pieces)]
        symbol = THREAT if THREAT in known else next((k for k in known if k), OTHER)
        return symbol, THREAT_WEIGHT * (symbol == THREAT)

    def patterns(self, text: str) -> list[tuple[str, float]]:
        """Pattern and weight of every clause that matches one. Only clauses with a lexicon hit are read."""
        text = fold(text)
        found, done = [], 0
        for last, length in self.search.iter(text):
            start = last - length + 1
            if last < done or start and text[start - 1].isalpha():
                continue
            begin = max(text.rfind(c, done, start) for c in CLAUSE_ENDS) + 1
            end = CLAUSE_END.search(text, start)
            begin, done = max(begin, done), end.start() if end else len(text)
            matched = self.clause(text[begin:done])
            if matched:
                found.append(matched)
        return found

    def clause(self, clause: str) -> tuple[str, float] | None:
        state, best = 0, 0.0
        for m in WORD.finditer(clause):
            symbol, weight = self.read(m[0])
            state, best = self.rows[state][symbol], max(best, weight)
        return (PATTERNS[state], best) if PATTERNS[state] else None


def fold(text: str) -> str:
    """Lower case, with one kind of apostrophe."""
    return text.lower().replace("\u2019", "'")


def features(text: str) -> set[str]:
    """Whole words (marked by ``=``) and word prefixes of the lengths of stems; an apostrophe parts words."""
    out = set()
    for word in {piece for word in WORD.findall(fold(text)) for piece in word.split("'")}:
        if len(word) <= LONGEST_WORD:
            out.add("=" + word)
        out.update(word[:n] for n in STEM_LENGTHS if n <= len(word))
    return out


def held_out(id_col: str = "doc_id"):
    """Whether labels of the id must not be learned: crc32 of the id as text leaves 1 by 3."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each feature, toxic and clean, summed over a batch."""
    for batch in batches:
        sums: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
            at = 0 if toxic.as_py() else 1
            for f in features(text.as_py() or ""):
                sums.setdefault(f, [0, 0])[at] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.string()),
                pa.array([t for t, _ in sums.values()], pa.int64()),
                pa.array([c for _, c in sums.values()], pa.int64()),
            ],
            names=["feature", "toxic", "clean"],
        )


def _tail(toxic: int, clean: int, share: float) -> float:
    """Chance that at least ``toxic`` of all documents with a feature are toxic if it means nothing."""
    n = toxic + clean
    return sum(
        math.exp(
            math.lgamma(n + 1)
            - math.lgamma(k + 1)
            - math.lgamma(n - k + 1)
            + k * math.log(share)
            + (n - k) * math.log1p(-share)
        )
        for k in range(toxic, n + 1)
    )


def _no_accidents(
    rivals: dict[int, int], share: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the features that are no accident among their rivals; ``rivals`` has the number of features by
    the number of documents that hold them, at most SAMPLE entries."""
    sizes = sorted(rivals, reverse=True)
    many = dict(zip(sizes, accumulate(rivals[n] for n in sizes), strict=True))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = zip(batch.column("toxic").to_pylist(), batch.column("clean").to_pylist(), strict=True)
            kept = [_tail(t, c, share) * many[t + c] <= ACCIDENTS for t, c in counts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return keep


def _entries(counted: Iterable[tuple[str, int, int]]) -> dict[str, float]:
    """The features that others do not make needless; (feature, toxic, clean) by falling toxic count."""
    out: dict[str, float] = {}
    taken: dict[str, int] = {}  # every prefix of an entry, and the largest count of such an entry
    for feature, toxic, clean in counted:
        word = feature.lstrip("=")
        if any(word[:n] in out for n in STEM_LENGTHS) or toxic <= 1.2 * taken.get(word, 0):
            continue
        out[feature] = (toxic + INSULT_WEIGHT * INSULT_COUNTS) / (toxic + clean + INSULT_COUNTS)
        for n in range(1, len(word) + 1):
            taken[word[:n]] = max(taken.get(word[:n], 0), toxic)
    return out


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least shingle hash of every text: near copies mostly share it."""
    for batch in batches:
        least = [
            min((int(h.min()) for h in shingle_hashes((t.as_py() or "").encode(), 5, 11)), default=0)
            for t in batch.column("text")
        ]
        family = pa.array(np.array(least, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns, family], [*batch.schema.names, "family"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model:
    """The model of ``labels`` (id, toxic), learned from at most ``SAMPLE`` documents.

    Held-out ids and null labels are left out; of several labels of an id the highest counts. What
    reaches the driver are the features of the sample that are no accident and a row a pattern: it
    grows with ``SAMPLE``, not with the corpus, and no feature is cut off.
    """
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg((F.max("toxic") > 0).alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(SAMPLE)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col("text"))
    # The sample has at most SAMPLE rows of an id and a flag.
    chosen = texts.join(F.broadcast(sample), "_id").select("text", "toxic")
    # Of near copies one counts, else the words of a much copied document would look like insults.
    families = chosen.mapInArrow(_families, "text string, toxic boolean, family long")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")
    chosen = write_and_read(families.groupBy("family", "toxic").agg(one).select("text", "toxic"), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    entries = {f"={w}": INSULT_WEIGHT for w in INSULTS}
    if sizes.get(True) and sizes.get(False):
        counts = chosen.mapInArrow(_counts, "feature string, toxic long, clean long")
        counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        counts = write_and_read(counts.where(F.col("toxic") >= LEAST_TOXIC), "toxic-features")
        n = F.col("toxic") + F.col("clean")
        found = counts.where(F.col("clean") <= F.lit(CLEAN_SHARE) * n)
        rivals = counts.groupBy(n.alias("n")).count().collect()  # one row a size, at most SAMPLE
        share = sizes[True] / sum(sizes.values())
        test = _no_accidents({r["n"]: r["count"] for r in rivals}, share)
        found = found.mapInArrow(test, "feature string, toxic long, clean long")
        found = found.orderBy(F.desc("toxic"), F.desc(F.length("feature")), "feature").collect()
        entries |= _entries((r["feature"], r["toxic"], r["clean"]) for r in found)
    return _weigh(chosen, tuple(sorted(entries.items())))


def _weigh(chosen: DataFrame, entries: tuple[tuple[str, float], ...]) -> Model:
    """Pattern factors: toxic documents that hold the pattern by those that its weights lead one to
    expect, drawn towards 1. The base score is that of documents that hold no pattern."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(entries)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                best: dict[str, float] = {}
                for pattern, weight in grammar.patterns(text.as_py() or ""):
                    best[pattern] = max(weight, best.get(pattern, 0.0))
                rows += [(p, w, int(toxic.as_py())) for p, w in sorted(best.items()) or [("", 0.0)]]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["pattern", "expected", "toxic"])

    kinds = (pa.string(), pa.float64(), pa.int64())
    held = chosen.mapInArrow(read, "pattern string, expected double, toxic long").groupBy("pattern")
    # Thousandths are summed as whole numbers, so that the order of rows does not matter.
    expected = F.sum(F.round(F.col("expected") * 1_000).cast("long")) / 1_000
    rows = held.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"), expected.alias("expected"))
    seen = {r["pattern"]: r for r in rows.collect()}  # a row a pattern
    factors = {p: 1.0 for p in PATTERNS if p}
    for p in factors.keys() & seen.keys():
        factors[p] = min(1.0, (seen[p]["toxic"] + FACTOR_COUNTS) / (seen[p]["expected"] + FACTOR_COUNTS))
    n, toxic = (seen[""]["n"], seen[""]["toxic"]) if "" in seen else (0, 0)
    return Model(entries, tuple(sorted(factors.items())), min(0.3, (toxic + 0.5) / (n + 10)))


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``: 0 to 1, the chance that at least one matched clause is toxic.

    One pass without a shuffle that reads the text alone. A null text counts as the empty one, which
    has the base score. Other columns are kept, one called score is replaced.
    """
    docs = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.entries)
        factors = dict(model.factors)
        for batch in batches:
            scores = []
            for text in batch.column(text_col):
                clean = 1 - model.base
                for pattern, weight in grammar.patterns(text.as_py() or ""):
                    clean *= 1 - weight * factors[pattern]
                scores.append(1 - clean)
            arrays = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))
