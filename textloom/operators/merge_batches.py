"""Which merges can be done together, exactly as one-at-a-time training would choose them.

A round of training knows the exact counts of the pairs at the head of the ranking and of the triples
whose two pairs are in that head. After a merge (x, y) a pair (y, v) loses the places where x comes
before it, which is the triple's count, and the new pair (xy, v) gains them; likewise to the left. So the
ranking can be carried on without counting again, as long as the pair on top has an exact count. What
would need longer contexts (a pair that loses places on both sides, a merge that itself lost some) keeps
an upper bound instead, and a bound on top of the ranking ends the batch. Pairs outside the head only lose
places, and pairs made from them rank after them, so the batch also ends where the head does.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

# Pairs of the head. Their triples are at most as many as pairs of pairs with a common symbol.
HEAD = 1024


@dataclass
class Ranked:
    """A pair in the ranking: its count, or an upper bound of it if it is not exact."""

    count: int
    exact: bool = True
    # Places that went with a left neighbour, and with a right neighbour.
    left_lost: int = 0
    right_lost: int = 0
    original: bool = True


class Batch:
    """The ranking of one round, carried on from merge to merge."""

    def __init__(
        self, head: Sequence[tuple[str, int]], triples: Mapping[str, int], floor: tuple[int, str] | None
    ):
        """``head``: exact counts; ``triples``: those of all triples of its pairs (others are 0);
        ``floor``: the (count, pair) that comes after the head."""
        self.pairs = {p: Ranked(n) for p, n in head}
        self.triples = triples
        self.floor = floor
        self.by_left: dict[str, set[str]] = defaultdict(set)
        self.by_right: dict[str, set[str]] = defaultdict(set)
        for pair in self.pairs:
            self._link(pair)
        self.lefts: set[str] = set()
        self.rights: set[str] = set()
        self.heap = [(-n, p) for p, n in head]
        heapq.heapify(self.heap)

    def _link(self, pair: str) -> None:
        self.by_left[pair[0]].add(pair)
        self.by_right[pair[1]].add(pair)

    def top(self) -> tuple[str, int] | None:
        """The pair that is merged next and its count, or None where the batch has to end."""
        while self.heap:
            count, pair = self.heap[0]
            entry = self.pairs.get(pair)
            if entry is None or entry.count != -count:
                heapq.heappop(self.heap)
                continue
            if not entry.exact or (self.floor is not None and (count, pair) >= (-self.floor[0], self.floor[1])):
                return None
            return pair, -count
        return None

    def _lower(self, pair: str, entry: Ranked, count: int) -> None:
        if count < entry.count:
            entry.count = count
            heapq.heappush(self.heap, (-count, pair))

    def _lose(self, pair: str, lost: int | None, clean: bool, side: str) -> None:
        """``pair`` loses ``lost`` places (None: not known) to a merge with its neighbour on a side."""
        entry = self.pairs[pair]
        if lost == 0:
            return
        other = entry.right_lost if side == "left" else entry.left_lost
        if lost is None or not clean or other or not entry.original:
            entry.exact = False
            return
        if side == "left":
            entry.left_lost += lost
        else:
            entry.right_lost += lost
        if entry.exact:
            self._lower(pair, entry, entry.count - lost)

    def _gain(self, pair: str, count: int, exact: bool) -> None:
        if count > 0:
            self.pairs[pair] = Ranked(count, exact, original=False)
            self._link(pair)
            heapq.heappush(self.heap, (-count, pair))

    def merge(self, pair: str, product: str) -> None:
        """Carry the ranking on after ``pair``, the pair on top, became the symbol ``product``."""
        merged = self.pairs.pop(pair)
        x, y = pair
        self.by_left[x].discard(pair)
        self.by_right[y].discard(pair)
        # Places of this merge were never taken by an earlier one to the left, or to the right.
        left_clean, right_clean = x not in self.rights, y not in self.lefts
        self.lefts.add(x)
        self.rights.add(y)
        known = merged.original
        after = [(q, self.pairs[q].count, self.pairs[q].original) for q in self.by_left[y]]
        before = [(q, self.pairs[q].count, self.pairs[q].original) for q in self.by_right[x]]
        for q, bound, original in after:
            triple = self.triples.get(x + q, 0) if known and original else None
            exact = triple is not None and left_clean and q[1] not in self.lefts
            self._lose(q, triple, left_clean, "left")
            self._gain(product + q[1], min(bound, merged.count) if triple is None else triple, exact)
        for q, bound, original in before:
            triple = self.triples.get(q + y, 0) if known and original else None
            exact = triple is not None and right_clean and q[0] not in self.rights
            self._lose(q, triple, right_clean, "right")
            self._gain(q[0] + product, min(bound, merged.count) if triple is None else triple, exact)
        turned = next((n for q, n, _ in after if q == y + x), 0)
        if turned:
            self._gain(product * 2, min(turned, merged.count), False)


def choose(
    batch: Batch,
    record: Callable[[str, int], str],
    alone: Callable[[str], bool],
    min_frequency: int,
    most: int,
) -> int:
    """Merge from the top of ``batch`` while that is exact; returns how many.

    ``record`` notes a merge and gives its symbol. A merge that changes other counts than those of its
    neighbours (``alone``: equal symbols, or a token that is there already) is the last of its batch.
    """
    done = 0
    while done < most:
        found = batch.top()
        if found is None or found[1] < min_frequency:
            break
        pair, count = found
        single = alone(pair)
        product = record(pair, count)
        done += 1
        if single:
            break
        batch.merge(pair, product)
    return done
