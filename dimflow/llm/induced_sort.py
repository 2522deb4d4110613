"""External induced suffix sorting of one shard of text.

Suffixes of S-type left of an L-type one (LMS) are sorted first: their substrings are
sorted by one induction and named in order, and the sequence of names is sorted by the
same procedure, again and again until all names differ. From their order two scans
induce all others: each suffix taken from a queue puts its left neighbour back in,
keyed by that one's first character.

The queues are on disk: tuples are spooled by ranges of keys, a range is read when the
scan reaches it, and what arrives for it meanwhile is merged in. Many tuples are taken
at once: as far as none of them puts another before the last of them.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Tuples that all spools of a queue hold in memory together; more go to their files.
IN_MEMORY = 1 << 22
SPOOLS = 1024
#: Tuples that are looked at together.
BLOCK = 8192


class DiskQueue:
    """A priority queue of (key, position) for keys that never fall below the last one taken."""

    def __init__(self, folder: str, keys: np.ndarray):
        cuts = np.unique(keys[:: max(1, len(keys) // (8 * SPOOLS))])
        self.cuts = cuts[:: max(1, len(cuts) // SPOOLS)] if len(cuts) > SPOOLS else cuts
        self.held = 0
        self.spools: list[list[np.ndarray]] = [[] for _ in range(len(self.cuts) + 1)]
        self.name, self.on_disk = tempfile.mkdtemp(dir=folder), set()

    def _file(self, k: int) -> str:
        return os.path.join(self.name, str(k))

    def push(self, keys: np.ndarray, at: np.ndarray) -> None:
        if not len(keys):
            return
        spool = np.searchsorted(self.cuts, keys, "right")
        order = np.argsort(spool, kind="stable")
        spool = spool[order]
        first = np.flatnonzero(np.concatenate(([True], spool[1:] != spool[:-1])))
        rows = np.stack([keys[order], at[order]], axis=1)
        for a, b in zip(first, np.append(first[1:], len(spool))):
            self.spools[spool[a]].append(rows[a:b])
        self.held += len(keys)
        if self.held > IN_MEMORY:
            for k, chunks in enumerate(self.spools):
                if chunks:
                    self.on_disk.add(k)
                    with open(self._file(k), "ab") as f:
                        np.concatenate(chunks).tofile(f)
                    chunks.clear()
            self.held = 0

    def take(self, k: int) -> np.ndarray:
        """All rows of a spool in the order of their keys, then of arrival."""
        rows = []
        if k in self.on_disk:
            self.on_disk.remove(k)
            rows.append(np.fromfile(self._file(k), np.int64).reshape(-1, 2))
            os.remove(self._file(k))
        rows += self.spools[k]
        self.held -= sum(len(x) for x in self.spools[k])
        self.spools[k] = []
        if not rows:
            return np.zeros((0, 2), np.int64)
        rows = np.concatenate(rows)
        return rows[np.argsort(rows[:, 0], kind="stable")]

    def close(self) -> None:
        for k in self.on_disk:
            os.remove(self._file(k))
        os.rmdir(self.name)


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S-type); the last one is."""
    n = len(text)
    step = np.sign(text[1:] - text[:-1]).astype(np.int8)
    # An equal character has the type of its right neighbour.
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = np.append(step, np.int8(1))[at] > 0
    return out


def _scan(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, rising: bool, folder: str) -> np.ndarray:
    """Positions induced from the seeds: rising, L-type ones from sorted LMS; else S-type ones from descending L."""

    def seed_keys(p: np.ndarray) -> np.ndarray:
        return 2 * text[p] + 1 if rising else -2 * text[p]

    def own_keys(p: np.ndarray) -> np.ndarray:
        return 2 * text[p] if rising else -(2 * text[p] + 1)

    keys = seed_keys(seeds)
    queue = DiskQueue(folder, np.sort(np.concatenate((keys, own_keys(seeds)))))
    queue.push(keys, seeds)
    out = []
    for k in range(len(queue.spools)):
        rows, later, at = queue.take(k), [], 0
        while at < len(rows) or later:
            if at == len(rows):
                rows, at = later.pop(0), 0
            key, p = rows[at : at + BLOCK, 0], rows[at : at + BLOCK, 1]
            left = np.maximum(p - 1, 0)
            puts = (p > 0) & (small[left] != rising)
            new = np.where(puts, own_keys(left), np.iinfo(np.int64).max)
            early = np.minimum.accumulate(new) < key
            m = int(np.argmax(early)) if early.any() else len(key)
            induced = key[:m] % 2 == 0 if rising else key[:m] % 2 != 0
            out.append(p[:m][induced])
            queue.push(new[:m][puts[:m]], left[:m][puts[:m]])
            at += m
            more = queue.take(k)
            if not len(more):
                continue
            last = later[-1] if later else rows[at:]
            if not len(last) or more[0, 0] >= last[-1, 0]:
                later.append(more)
            else:
                rows, later, at = np.concatenate((rows[at:], *later, more)), [], 0
                rows = rows[np.argsort(rows[:, 0], kind="stable")]
    queue.close()
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """L-type and S-type suffixes in ascending order, from LMS suffixes in the order given."""
    large = _scan(text, small, lms, True, folder)
    less = _scan(text, small, large[::-1], False, folder)[::-1]
    return large, np.concatenate(([len(text) - 1], less))


def _names(text: np.ndarray, order: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rank of each LMS substring among the different ones; `order` has them sorted."""
    new = np.ones(len(order), bool)
    a, b = order[:-1], order[1:]
    alike = lengths[a] == lengths[b]
    where = np.flatnonzero(alike)
    step = 0
    while len(where):
        x, y = order[where], order[where + 1]
        same = text[x + step] == text[y + step]
        alike[where[~same]] = False
        step += 1
        where = where[same & (step < lengths[x])]
    new[1:] = ~alike
    return np.cumsum(new)


def suffix_array(text: np.ndarray, folder: str) -> np.ndarray:
    """Positions of all suffixes of `text` in order; its last number must be its only smallest one."""
    n = len(text)
    if n < 3:
        return np.argsort(text, kind="stable")
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        first = lms[np.argsort(text[lms], kind="stable")]
        _, less = _induce(text, small, first, folder)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = less[is_lms[less]]
        lengths = np.ones(n, np.int64)
        lengths[lms[:-1]] = np.diff(lms) + 1
        names = np.zeros(n, np.int64)
        names[order] = _names(text, order, lengths)
        reduced = names[lms]
        if reduced.max() == len(lms):
            lms = order
        else:
            lms = lms[suffix_array(reduced, folder)]
    large, less = _induce(text, small, lms, folder)
    # Of one first character the L-type suffixes come first.
    both = np.concatenate((large, less))
    return both[np.argsort(text[both], kind="stable")]
