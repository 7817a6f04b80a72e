"""Many merges of vocabulary training from one look at the words.

Byte-pair training.
Take the pairs of neighbouring symbols that occur ``bound`` times or more, and cut every word wherever another pair
stands. What is left are runs. A pair that is not cut lies in runs only, so its count is known from the distinct runs
and their frequencies alone, also after merges inside the runs; a pair across a cut stays below the bound. So merges
found on the runs are the merges of the whole corpus as long as the best count is above what a pair across cuts can
reach. There are far fewer distinct runs than words, and one look gives hundreds of merges.

One thing blurs this: the same token can be spelled by different merges (``t``+``he``, ``th``+``e``). A pair of such
tokens may stand inside a run in one spelling and across a cut in another. For each token the symbols it can begin and
end with are kept; a pair with more than one combination has a count within known limits, and the look ends when such
a pair may be the best.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterable

Pair = tuple[str, str]


class Linked:
    """Words or runs as linked symbols, with a table of pairs and an index pair -> places, both kept up to date.

    Places number the symbols of all rows, so the smallest place of a pair is where it is seen first. A merge costs
    what it touches.
    """

    def __init__(self, rows: Iterable[tuple[list[str], int]]):
        self.symbol: list[str] = []
        self.weight: list[int] = []
        self.before: list[int] = []
        self.after: list[int] = []
        self.count: dict[Pair, int] = {}
        self.places: dict[Pair, set[int]] = {}
        self.smallest: dict[Pair, int] = {}  # of the places of a pair, until it is taken away
        self.starts: list[int] = []
        for symbols, freq in rows:
            start, n = len(self.symbol), len(symbols)
            self.starts.append(start)
            self.symbol += symbols
            self.weight += [freq] * n
            self.before += [-1, *range(start, start + n - 1)] if n else []
            self.after += [*range(start + 1, start + n), -1] if n else []
            for p in range(start, start + n - 1):
                self._add((self.symbol[p], self.symbol[p + 1]), p)

    def _add(self, pair: Pair, place: int) -> None:
        self.count[pair] = self.count.get(pair, 0) + self.weight[place]
        at = self.places.setdefault(pair, set())
        if not at or place < self.smallest.get(pair, -1):
            self.smallest[pair] = place
        at.add(place)

    def first(self, pair: Pair) -> int:
        """The smallest place of a pair; places are looked through only after it was taken away."""
        place = self.smallest.get(pair)
        if place is None:
            place = self.smallest[pair] = min(self.places[pair])
        return place

    def rows(self) -> list[list[str]]:
        """All rows with their symbols as they are now."""
        return [[s for s in self.symbol[a:b] if s] for a, b in zip(self.starts, [*self.starts[1:], len(self.symbol)])]

    def _drop(self, pair: Pair, place: int) -> None:
        at = self.places[pair]
        if place in at:
            at.remove(place)
            if self.smallest.get(pair) == place:
                del self.smallest[pair]
            self.count[pair] -= self.weight[place]

    def _join(self, pair: Pair, token: str) -> tuple[set[Pair], int]:
        """(pairs that are new at a place, joined occurrences) of putting ``token`` at all places of a pair, from left to right."""
        left, right = pair
        touched: set[Pair] = set()
        joined = 0
        self.smallest.pop(pair, None)
        for p in sorted(self.places.pop(pair)):
            q = self.after[p]
            if q < 0 or self.symbol[p] != left or self.symbol[q] != right:
                continue  # the place before it has taken the symbol
            joined += self.weight[p]
            x, z = self.before[p], self.after[q]
            if x >= 0 and (self.symbol[x], left) != pair:
                self._drop((self.symbol[x], left), x)
            if z >= 0 and (right, self.symbol[z]) != pair:
                self._drop((right, self.symbol[z]), q)
            self.symbol[p], self.symbol[q], self.after[p] = token, "", z
            if z >= 0:
                self.before[z] = p
                self._add((token, self.symbol[z]), p)
                touched.add((token, self.symbol[z]))
            if x >= 0:
                self._add((self.symbol[x], token), x)
                touched.add((self.symbol[x], token))
        self.count.pop(pair)
        return touched, joined


class Runs(Linked):
    """Runs, as (symbols, frequency) in the order of their first place, of the pairs that occur ``bound`` times or more."""

    def __init__(self, runs: Iterable[tuple[list[str], int]], bound: int, known: set[str]):
        super().__init__(runs)
        self.bound, self.known = bound, known
        self.first_symbols: dict[str, set[str]] = {}
        self.last_symbols: dict[str, set[str]] = {}
        self.widest = [1, 1]
        # (negative count that may be reached, exact or not, first place or an earlier one, pair)
        self.heap = [self._entry(pair, self.first(pair)) for pair in self.places]
        heapq.heapify(self.heap)

    def _spellings(self, pair: Pair) -> int:
        return len(self.last_symbols.get(pair[0], "1")) * len(self.first_symbols.get(pair[1], "1"))

    def _entry(self, pair: Pair, place: int) -> tuple[int, bool, int, Pair]:
        n = self._spellings(pair)
        return -(self.count[pair] + (self.bound - 1) * n * (n > 1)), n == 1, place, pair

    def best(self) -> tuple[Pair, int] | None:
        """The next merge and its count, or None if the runs cannot tell it."""
        while self.heap:
            entry = self.heap[0]
            pair = entry[3]
            if not self.places.get(pair):
                heapq.heappop(self.heap)
                continue
            now = self._entry(pair, self.first(pair))
            if now != entry:  # counts fall and first places move on unnoticed; what grows is entered at once
                heapq.heapreplace(self.heap, now)
                continue
            certain = now[1] and -now[0] > (self.bound - 1) * self.widest[0] * self.widest[1]
            return (pair, -now[0]) if certain else None
        return None

    def merge(self, pair: Pair) -> None:
        token = pair[0] + pair[1]
        self._spell(token, *pair)
        for new in self._join(pair, token)[0]:
            if self.places.get(new):
                heapq.heappush(self.heap, self._entry(new, self.first(new)))

    def _spell(self, token: str, left: str, right: str) -> None:
        """Keep the symbols that a token can begin and end with; pairs of a token with a new spelling are entered again."""
        wider = False
        for side, (table, part) in enumerate(((self.first_symbols, left), (self.last_symbols, right))):
            own = set(table.get(token, {token} if token in self.known else ()))
            ends = own | table.get(part, {part})
            wider |= bool(own) and len(ends) > len(own)
            table[token] = ends
            self.widest[side] = max(self.widest[side], len(ends))
        self.known.add(token)
        if wider:
            for pair, at in self.places.items():
                if at and token in pair:
                    heapq.heappush(self.heap, self._entry(pair, self.first(pair)))


class ScoredWords(Linked):
    """All words that hold one of the best-scored pairs, for merges by frequency over the product of symbol frequencies.

    ``words`` are (symbols, frequency, rank) in order of rank. ``best`` are the first pairs by score, then by first
    place, and ``last`` the (negative score, place) of the last of them; no other pair comes before it. ``near`` holds
    (frequency, place) of every pair of the corpus with a symbol of these words, ``letters`` the frequency of every symbol.

    Merges of such pairs change these words only. So the frequencies of all their symbols, and of all pairs with one of
    them, stay known, and are scored anew when a symbol gets rarer; other pairs keep their score. A pair can be merged
    here if all its places are in these words: one of ``best``, or one with a token that is new.
    """

    def __init__(self, words: Iterable[tuple[list[str], int, int]], best: set[Pair], last: tuple[float, int], near: dict[Pair, tuple[int, int]],
                 letters: dict[str, int], known: set[str], stride: int):
        words = list(words)
        super().__init__((symbols, freq) for symbols, freq, _ in words)
        self.key = [rank * stride + i for symbols, _, rank in words for i in range(len(symbols))]
        self.closed, self.last, self.letters, self.known, self.fresh = best, last, dict(letters), known, set()
        self.scored = set(self.symbol)
        self.seen_first = {pair: place for pair, (_, place) in near.items()}
        self.count = {pair: n for pair, (n, _) in near.items()}
        self.of_symbol: dict[str, set[Pair]] = {}
        for pair in near:
            self._list(pair)
        self.heap = [self._entry(pair) for pair in near]
        heapq.heapify(self.heap)
        self.open = True

    def _list(self, pair: Pair) -> None:
        for s in set(pair):
            if s in self.scored:
                self.of_symbol.setdefault(s, set()).add(pair)

    def _is_closed(self, pair: Pair) -> bool:
        return pair in self.closed or pair[0] in self.fresh or pair[1] in self.fresh

    def score(self, pair: Pair) -> float:
        return self.count[pair] / (float(self.letters[pair[0]]) * float(self.letters[pair[1]]))

    def _entry(self, pair: Pair) -> tuple[float, int, Pair]:
        """Places of pairs that stand in other words too are their first ones at the beginning, or earlier than that."""
        place = self.key[self.first(pair)] if self._is_closed(pair) else self.seen_first[pair]
        return -self.score(pair), place, pair

    def best(self) -> tuple[Pair, float] | None:
        """The next merge and its score, or None if these words cannot tell it."""
        while self.open and self.heap:
            entry = self.heap[0]
            pair = entry[2]
            if not self.count.get(pair):
                heapq.heappop(self.heap)
                continue
            now = self._entry(pair)
            if now != entry:
                heapq.heapreplace(self.heap, now)
                continue
            return (pair, -now[0]) if self._is_closed(pair) and now[:2] <= self.last else None
        return None

    def merge(self, pair: Pair, token: str) -> None:
        new_symbol = token not in self.known
        # The other pairs of a token that is spelled in another way already are not known.
        self.open = new_symbol or token in self.scored
        if new_symbol:
            self.fresh.add(token)
        self.scored.add(token)
        self.known.add(token)
        touched, joined = self._join(pair, token)
        for s in pair:
            self.letters[s] -= joined
        self.letters[token] = self.letters.get(token, 0) + joined
        for new in touched:
            self._list(new)
            if not self._is_closed(new):
                first = self.key[self.first(new)]
                self.seen_first[new] = min(self.seen_first.get(new, first), first)
        for changed in touched.union(*(self.of_symbol.get(s, ()) for s in (*pair, token))):
            if self.count.get(changed):
                heapq.heappush(self.heap, self._entry(changed))


def cut_runs(symbols: list[str], frequent: set[Pair]) -> list[tuple[int, list[str]]]:
    """(characters before it, symbols) of each run of two or more symbols whose neighbours are all frequent pairs."""
    out, at, run, start = [], 0, [], 0
    for symbol in symbols:
        if run and (run[-1], symbol) not in frequent:
            out.append((start, run))
            run = []
        if not run:
            start = at
        run.append(symbol)
        at += len(symbol)
    return [(start, run) for start, run in [*out, (start, run)] if len(run) > 1]


def apply_merges(symbols: list[str], ranks: dict[Pair, list[int]], tokens: list[str] | None = None) -> list[str]:
    """The symbols of a word after merges in their order, each once, from left to right; ``ranks`` ascend for each pair.

    ``tokens`` are the merged tokens by rank, if they are not both symbols put together.
    """
    n = len(symbols)
    heap = [(ranks[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    if not heap:
        return symbols
    heapq.heapify(heap)
    symbols, before, after = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]

    def enter(i: int, past: int) -> None:
        own = ranks.get((symbols[i], symbols[after[i]]))
        if own and own[-1] > past:
            heapq.heappush(heap, (own[bisect_right(own, past)], i))

    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        own = ranks.get((symbols[i], symbols[j])) if symbols[i] and j >= 0 else None
        if not own or rank not in own:
            continue
        symbols[i], symbols[j], after[i] = tokens[rank] if tokens else symbols[i] + symbols[j], "", after[j]
        if after[i] >= 0:
            before[after[i]] = i
            enter(i, rank)
        if before[i] >= 0:
            enter(before[i], rank)
    return [s for s in symbols if s]
