"""Online detection of squares in a sequence, by catchers over dyadic blocks.

A square of period p, two equal halves side by side, has in its first half a whole block
of length L that starts at a multiple of L, for each power of two L up to (p + 1) / 2.
So once a block is complete, a catcher watches for its next occurrence at distances from
2L - 1 up to 4L - 2; these ranges cover every period. Of each length the last four blocks
are held, and each appended word completes one window of each length, whose hash is
compared with the two of them that lie at such distances. A hit is a trail: the words
before and after it are compared with those p places on, forward as far as words have
come and further with each append. A trail that has come to p equal words is a square,
and the squares of a trail are one run.

Words may be appended in pieces of any length, one by one or many at once; the runs are
the same. Hashes only propose trails, runs are found by comparing words. Memory is some
numbers a word.
"""

from __future__ import annotations

import numpy as np

from dimflow.llm.text_hash import BASE, U, mix


class SquareCatcher:
    """Finds the runs of period `max_period` or less in a sequence of whole numbers."""

    def __init__(self, max_period: int):
        self.max_period = max_period
        self.n = 0
        self._words = np.zeros(1024, np.int64)
        # For each length: hashes of the last windows, and of the last complete blocks.
        self._tails: list[np.ndarray] = []
        self._blocks: list[np.ndarray] = []
        self._trails: dict[int, int] = {}
        self._runs: set[tuple[int, int, int]] = set()
        self._new: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        old = self.n
        self._store(words)
        self._new = []
        for period, start in list(self._trails.items()):
            end = self._forward(old, period)
            if end < self.n:
                del self._trails[period]
                self._report(start, end, period)
        hashes, length, level, factor = mix(words.astype(U)), 1, 0, int(BASE)
        while 2 * length - 1 <= self.max_period:
            if level == len(self._tails):
                self._tails.append(np.zeros(0, U))
                self._blocks.append(np.zeros(0, U))
            if len(hashes):
                self._catch(level, length, old, hashes)
            # The windows of twice the length that are complete now.
            known = np.concatenate((self._tails[level], hashes))
            self._tails[level] = known[max(0, len(known) - length) :].copy()
            hashes = known[:-length] * U(factor) + known[length:] if len(known) > length else known[:0]
            factor, length, level = factor * factor % (1 << 64), 2 * length, level + 1

    def runs(self) -> list[tuple[int, int, int]]:
        """Start, end and smallest period of every run so far, by start, end."""
        found = self._runs | {(a, self.n, p) for p, a in self._trails.items() if self.n - a >= 2 * p}
        least: dict[tuple[int, int], int] = {}
        for a, b, p in found:
            # A run of a period that isn't the smallest is that of the smallest, which divides it.
            least[a, b] = min(p, least.get((a, b), p))
        return sorted((a, b, p) for (a, b), p in least.items())

    def _store(self, words: np.ndarray) -> None:
        need = self.n + len(words)
        if need > len(self._words):
            grown = np.zeros(max(need, 2 * len(self._words)), np.int64)
            grown[: self.n] = self._words[: self.n]
            self._words = grown
        self._words[self.n : need] = words
        self.n = need

    def _report(self, start: int, end: int, period: int) -> None:
        if end - start >= 2 * period:
            self._runs.add((start, end, period))
            self._new.append((start, end, period))

    def _forward(self, at: int, period: int) -> int:
        """First place from `at` on whose word isn't that `period` places before; the end if there is none."""
        step = 32
        while at < self.n:
            upto = min(at + step, self.n)
            apart = self._words[at:upto] != self._words[at - period : upto - period]
            if apart.any():
                return at + int(apart.argmax())
            at, step = upto, min(4 * step, 1 << 16)
        return self.n

    def _backward(self, at: int, period: int) -> int:
        """Least place from which on, up to `at`, words are those `period` places after."""
        step = 32
        while at > 0:
            low = max(0, at - step)
            apart = self._words[low:at] != self._words[low + period : at + period]
            if apart.any():
                return at - int(apart[::-1].argmax())
            at, step = low, min(4 * step, 1 << 16)
        return 0

    def _catch(self, level: int, length: int, old: int, hashes: np.ndarray) -> None:
        """Compare the windows just completed with the catchers of their length."""
        first = max(0, old - length + 1)  # the first of these windows
        held = self._blocks[level]
        base = -(-first // length) - len(held)  # number of the first block held
        held = np.concatenate((held, hashes[-first % length :: length]))
        self._blocks[level] = held[-4:].copy()
        # The window at s meets the blocks numbered (s + 1) // length - 2 and one less.
        spread = np.repeat(held, length)
        places, periods = [], []
        for back in (2, 3):
            low = first + 1 - back * length - base * length  # in `spread`, for the first window
            skip = max(0, -low)
            part = spread[low + skip : max(0, low + len(hashes))]
            hit = np.flatnonzero(part == hashes[skip : skip + len(part)]) + skip + first
            places.append(hit)
            periods.append(hit - ((hit + 1) // length - back) * length)
        place, period = np.concatenate(places), np.concatenate(periods)
        fits = period <= self.max_period
        place, period = place[fits], period[fits]
        if not len(place):
            return
        order = np.lexsort((place, period))
        place, period = place[order], period[order]
        # Neighbouring windows of one period are on one trail.
        same = np.zeros(len(place), bool)
        same[1:] = (period[1:] == period[:-1]) & (place[1:] == place[:-1] + length)
        place, period = place[~same], period[~same]
        fresh = ~self._in_smaller(place, period, length)
        last, reached = 0, -1
        for s, p in zip(place[fresh].tolist(), period[fresh].tolist()):
            if p == last and s < reached:
                continue
            start = self._trails.get(p)
            if start is not None and s >= start + p:
                continue
            last, reached = p, self._forward(s, p)
            if reached == s:  # equal hashes of different words
                continue
            start = self._backward(s - p, p)
            if reached == self.n:
                self._trails[p] = start
            else:
                self._report(start, reached, p)

    def _in_smaller(self, place: np.ndarray, period: np.ndarray, length: int) -> np.ndarray:
        """Whether a hit lies in a run whose period divides the hit's: it would be that run again.

        If such a run holds the hit, no other run found so far does: their periods
        are so small that they would be one.
        """
        runs = self._new + [(a, self.n, p) for p, a in self._trails.items() if self.n - a >= 2 * p]
        if not runs:
            return np.zeros(len(place), bool)
        start, end, least = np.array(sorted(runs), np.int64).T
        best = np.maximum.accumulate(end)
        which = np.maximum.accumulate(np.where(end == best, np.arange(len(end)), 0))
        at = np.searchsorted(start, place - period, "right") - 1
        run = which[np.maximum(at, 0)]
        return (at >= 0) & (end[run] >= place + length) & (period % least[run] == 0) & (period > least[run])
