"""Periodic runs of words, found in a grammar of the words.

A run is a stretch of consecutive words that repeats with its smallest period three times or more and
that no neighbouring word extends. The words of many documents are compressed together by Re-Pair:
adjacent pairs of symbols that occur twice or more are replaced by nonterminals, the more frequent
ones first where two overlap, until no pair repeats; what is left of each stretch is paired up to one
root. A run lies in the expansion of a smallest nonterminal, whose boundary between its two symbols it
crosses. So the runs that cross the boundary of each nonterminal are computed once, translated to all
places where the nonterminal is derived, and merged: intervals within others of their period go.

Words that occur fewer than three times in their document lie in no run, nor do stretches between them
of fewer words than a run has; these are set aside first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame

from casebook.llm.common import Words, chunks, with_columns

#: Least words of a run, and least periods.
WORDS, PERIODS = 24, 3
#: Times that words set aside may make others rare.
SIEVED = 8


def sieve(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may lie in runs, and the stretch that each belongs to.

    A word of a run occurs ``PERIODS`` times in it, so also in any stretch that holds the run.
    """
    places, stretch = np.arange(len(ids)), text
    for _ in range(SIEVED):
        _, back, count = np.unique(stretch * (int(ids.max(initial=0)) + 1) + ids[places], return_inverse=True, return_counts=True)
        keep = count[back] >= PERIODS
        edge = np.diff(stretch, prepend=-1) != 0
        edge[1:] |= keep[1:] != keep[:-1]
        number = np.cumsum(edge) - 1
        keep &= np.bincount(number, minlength=1)[number] >= WORDS
        done = keep.all()
        places, stretch = places[keep], number[keep]
        if done or not len(places):
            break
    return places, np.unique(stretch, return_inverse=True)[1]


class Grammar:
    """Re-Pair of sequences that lie one after the other; no pair spans two of them.

    Symbols below ``words`` are words. ``left``, ``right``: the symbols of each nonterminal; ``size``:
    words of each symbol; ``first``: where it is derived first; ``rounds``: the first nonterminal of
    each round, those of a round have only earlier symbols; ``roots``: one for each sequence, at ``starts``.
    """

    def __init__(self, ids: np.ndarray, sequence: np.ndarray):
        self.words = int(ids.max(initial=-1)) + 1
        self.left = self.right = self.first = np.zeros(self.words, np.int64)
        self.size = np.ones(self.words, np.int64)
        self.rounds: list[int] = []
        self.roots, self.starts, self.sequence = ids.astype(np.int64), np.arange(len(ids)), sequence
        while self.replace(self.repeated()):
            pass
        while self.replace(self.neighbours()):
            pass

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of symbols followed by another of their sequence, and these pairs as numbers."""
        at = np.flatnonzero(self.sequence[:-1] == self.sequence[1:])
        return at, self.roots[at] * len(self.size) + self.roots[at + 1]

    def repeated(self) -> np.ndarray:
        """Places to replace: of pairs that repeat, those before which no overlapping pair comes."""
        at, pair = self.pairs()
        kinds, back, count = np.unique(pair, return_inverse=True, return_counts=True)
        # More frequent pairs first; equally frequent ones in an arbitrary order, so that no long rows of them wait.
        order = np.random.Generator(np.random.PCG64(len(kinds))).permutation(len(kinds))
        rank = np.zeros(len(self.roots) + 1, np.int64)
        rank[at] = np.where(count[back] >= 2, count[back] * len(kinds) + order[back] + 1, 0)
        # Neighbouring places of one rank are a row of one symbol: every other place.
        edge = np.flatnonzero(np.diff(rank, prepend=-1))
        value = rank[edge]
        top = (value > 0) & (value > np.append(0, value[:-1])) & (value > np.append(value[1:], 0))
        row = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(rank))))
        return np.flatnonzero(top[row] & ((np.arange(len(rank)) - edge[row]) % 2 == 0))

    def neighbours(self) -> np.ndarray:
        """Every other place of each sequence that has more than one symbol."""
        at, _ = self.pairs()
        edge = np.flatnonzero(np.diff(self.sequence, prepend=-1))
        begin = np.repeat(edge, np.diff(np.append(edge, len(self.sequence))))
        return at[(at - begin[at]) % 2 == 0]

    def replace(self, at: np.ndarray) -> bool:
        """Replaces pairs by nonterminals; False if there are none."""
        if not len(at):
            return False
        a, b = self.roots[at], self.roots[at + 1]
        _, where, back = np.unique(a * len(self.size) + b, return_index=True, return_inverse=True)
        self.rounds.append(len(self.size))
        self.roots[at] = len(self.size) + back
        self.left, self.right = np.append(self.left, a[where]), np.append(self.right, b[where])
        self.first = np.append(self.first, self.starts[at[where]])
        self.size = np.append(self.size, self.size[a[where]] + self.size[b[where]])
        keep = np.ones(len(self.roots), bool)
        keep[at + 1] = False
        self.roots, self.starts, self.sequence = self.roots[keep], self.starts[keep], self.sequence[keep]
        return True


class Blocks:
    """Which stretches of words are equal: a number for each stretch of 2**k words, for each k."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.n = len(ids)
        self.numbers = [ids.astype(np.int32)]
        self.sorted: list[np.ndarray] = []
        width = 1
        while True:
            number = self.numbers[-1]
            # Places by number: where a stretch occurs can be looked up between two places.
            order = np.argsort(number, kind="stable")
            self.sorted.append(number[order].astype(np.int64) * self.n + order)
            if 2 * width > longest:
                break
            pair = number[: len(number) - width].astype(np.int64) * self.n + number[width:]
            self.numbers.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))
            width *= 2

    def occurrences(self, k: int, block: np.ndarray, least: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places from ``least`` to before ``end`` where the stretch of 2**k words at ``block`` occurs:
        (index of the query, place)."""
        base = self.numbers[k][block].astype(np.int64) * self.n
        low = np.searchsorted(self.sorted[k], base + least)
        count = np.maximum(0, np.searchsorted(self.sorted[k], base + np.maximum(least, end)) - low)
        query = np.repeat(np.arange(len(block)), count)
        ahead = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
        return query, self.sorted[k][low[query] + ahead] % self.n

    def equal_after(self, i: np.ndarray, j: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, i < j, up to before ``end``."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.numbers))):
            number, width = self.numbers[k], 1 << k
            a, b = i + out, j + out
            inside = b + width <= end
            out += width * (inside & (number[np.where(inside, a, 0)] == number[np.where(inside, b, 0)]))
        return out

    def equal_before(self, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j, i < j, from ``least`` on."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.numbers))):
            number, width = self.numbers[k], 1 << k
            a, b = i - out - width, j - out - width
            inside = a >= least
            out += width * (inside & (number[np.where(inside, a, 0)] == number[np.where(inside, b, 0)]))
        return out


def crossing(grammar: Grammar, blocks: Blocks) -> tuple[np.ndarray, ...]:
    """Runs that cross the boundary of a nonterminal, within its expansion, as arrays: nonterminal,
    start from its beginning, length, period.

    Half a period more than one lies on one side of the boundary. So the stretch there next to the
    boundary, of up to half a period, occurs again a period away; these are the periods to try.
    """
    node = np.flatnonzero(grammar.size >= WORDS)
    node = node[node >= grammar.words]
    s = grammar.first[node]
    e, b = s + grammar.size[node], s + grammar.size[grammar.left[node]]
    found: list[tuple[np.ndarray, ...]] = []

    def right(k: int, least: int, end: int) -> None:
        own = np.flatnonzero(b + least + (1 << k) <= e)
        query, place = blocks.occurrences(k, b[own], b[own] + least, np.minimum(b[own] + end, e[own] - (1 << k) + 1))
        own = own[query]
        period = place - b[own]
        after = blocks.equal_after(b[own], place, e[own])
        enough = 2 * after >= period
        own, period, place, after = own[enough], period[enough], place[enough], after[enough]
        before = blocks.equal_before(b[own], place, s[own])
        kept(own, period, b[own] - before, place + after)

    def left(k: int, least: int, end: int) -> None:
        block = b - (1 << k)
        own = np.flatnonzero(block - least >= s)
        query, place = blocks.occurrences(k, block[own], np.maximum(block[own] - end + 1, s[own]), block[own] - least + 1)
        own = own[query]
        period = block[own] - place
        before = blocks.equal_before(b[own] - period, b[own], s[own])
        enough = 2 * before >= period
        own, period, before = own[enough], period[enough], before[enough]
        after = blocks.equal_after(b[own] - period, b[own], e[own])
        kept(own, period, b[own] - period - before, b[own] + after)

    def kept(own: np.ndarray, period: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        size = end - start
        run = (size >= np.maximum(WORDS, PERIODS * period)) & (start < b[own]) & (end > b[own])
        found.append((node[own[run]], start[run] - s[own[run]], size[run], period[run]))

    if len(node):
        right(0, 1, 2)
        left(0, 1, 2)
        for k in range(len(blocks.numbers)):
            right(k, 2 << k, 4 << k)
            left(k, 2 << k, 4 << k)
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    of, start, size, period = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((period, size, start, of))
    of, start, size, period = of[order], start[order], size[order], period[order]
    # Of one interval the smallest period: the others are its multiples.
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (start[1:] != start[:-1]) | (size[1:] != size[:-1])
    return of[new], start[new], size[new], period[new]


def derived(grammar: Grammar, runs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of nonterminals at all places where these are derived: start, length, period."""
    of, start, size, period = runs
    low, high = np.searchsorted(of, [np.arange(len(grammar.size)), np.arange(1, len(grammar.size) + 1)])
    holds = high > low
    for a, z in zip(grammar.rounds, [*grammar.rounds[1:], len(grammar.size)], strict=True):
        holds[a:z] |= holds[grammar.left[a:z]] | holds[grammar.right[a:z]]
    keep = holds[grammar.roots]
    node, at = grammar.roots[keep], grammar.starts[keep]
    out: list[tuple[np.ndarray, ...]] = []
    while len(node):
        count = high[node] - low[node]
        which = np.repeat(low[node] + count - np.cumsum(count), count) + np.arange(count.sum())
        out.append((np.repeat(at, count) + start[which], size[which], period[which]))
        inner = node >= grammar.words
        node, at = node[inner], at[inner]
        below = np.concatenate((grammar.left[node], grammar.right[node]))
        at = np.concatenate((at, at + grammar.size[grammar.left[node]]))
        node, at = below[holds[below]], at[holds[below]]
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def merged(start: np.ndarray, size: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows start, length, period of the maximal intervals of each period; of equal intervals the one of
    the smallest period; by start, then period."""
    end = start + size
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    lifted = end + np.cumsum(np.diff(period, prepend=0) != 0) * (int(end.max(initial=0)) + 1)
    before = np.append(-1, np.maximum.accumulate(lifted)[:-1])[: len(lifted)]
    keep = lifted > before
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return np.stack((start, end - start, period), axis=1)[order]


def runs_of(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows start, length, period of all runs of words, given as numbers from 0; ``text`` tells, in
    ascending order, which text a word belongs to. Starts count from the first word of all."""
    places, sequence = sieve(ids, text)
    if not len(places):
        return np.zeros((0, 3), np.int64)
    left = np.unique(ids[places], return_inverse=True)[1]
    grammar = Grammar(left, sequence)
    blocks = Blocks(left, int(np.bincount(sequence).max()))
    out = merged(*derived(grammar, crossing(grammar, blocks)))
    out[:, 0] = places[out[:, 0]]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def runs_of_texts(texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """The runs of each text, rows start, length, period with starts from its own first word, and its words.

    Words are compared by 64-bit hashes first; equal words have equal hashes, so only what was found
    has to be looked at again. A text in which that fails is done again with exact numbers.
    """
    for chunk in chunks(texts):
        words = Words(chunk, fold=False)
        text = np.repeat(np.arange(len(chunk)), np.diff(words.firsts))
        ids = np.unique(words.hashes, return_inverse=True)[1]
        found = runs_of(ids, text)
        cuts = np.searchsorted(found[:, 0], words.firsts)
        for k, data in enumerate(chunk):
            own, spelled = found[cuts[k] : cuts[k + 1]] - (words.firsts[k], 0, 0), data.split()
            if any(spelled[s : s + n - p] != spelled[s + p : s + n] for s, n, p in own.tolist()):
                numbers: dict[bytes, int] = {}
                exact = np.array([numbers.setdefault(w, len(numbers)) for w in spelled], np.int64)
                own = runs_of(exact, np.zeros(len(exact), np.int64))
            yield own, spelled


def strongest(runs: np.ndarray) -> tuple[int, int, int] | tuple[None, None, None]:
    """The run with the greatest length by period; of equal ones the smallest start, then period."""
    if not len(runs):
        return None, None, None
    share = runs[:, 1] / runs[:, 2]
    near = runs[share >= share.max() * (1 - 1e-9)].tolist()
    return tuple(min(near, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that lie in a run after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(change)[:-1] > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def add_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds what repeats in a text, by its words (runs of characters other than x20 and x09 to x0D):

    * runs: array of start (word number from 0), length and period of every run one after the other, by
      start, then period; a run has at least ``WORDS`` words and ``PERIODS`` periods,
    * start, length, period: of the run with the greatest length by period, null without a run,
    * collapsed: the words outside the repeats, joined by single spaces.

    One pass without a shuffle; texts are handled whole, one that is longer than a chunk alone. The
    memory is some hundred bytes for each word of a chunk that may lie in a run. Null and empty texts have
    no runs and collapse to an empty text; equal texts have equal results, repeated rows stay; an empty
    table stays empty. Other columns pass unchanged; columns of the added names are replaced.
    """

    def task():
        def compute(texts):
            rows = []
            for runs, words in runs_of_texts(None if t is None else t.encode() for t in texts):
                rows.append((runs.ravel(), *strongest(runs), collapsed(words, runs).decode()))
            return list(zip(*rows, strict=True)) if rows else [()] * 5

        return compute

    return with_columns(df, [text], {"runs": "array<long>", "start": "long", "length": "long", "period": "long", "collapsed": "string"}, task)
