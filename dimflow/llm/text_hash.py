"""Words and word shingles of Arrow text columns as 64-bit hashes, computed with numpy over whole buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: White space between words: \x20 and \x09-\x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Texts of a batch are hashed in slices of about so many bytes, which bounds the memory of a task.
SLICE_BYTES = 1 << 17
#: Shingle hashes have 56 bits, so that seven bytes hold one.
GRAM_SHIFT = U(8)
BASE = U(0x9E3779B97F4A7C15)
#: Of BASE modulo 2**64.
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x + U((0x632BE59BD9B4E019 * (2 * seed + 1)) & ((1 << 64) - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the offsets of each; a null text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about SLICE_BYTES each, one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z lower-cased, and the offsets of each text's words."""
    if not len(data):
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    inner = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inner[:-1]))
    starts = np.flatnonzero(inner & (~before | edge[:-1]))
    after = np.concatenate((inner[1:], [False]))
    ends = np.flatnonzero(inner & (~after | edge[1:])) + 1
    powers = np.ones(len(data) + 1, U)
    powers[1:] = BASE
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((LOWER[data].astype(U) + U(1)) * powers[:-1], out=sums[1:])
    back = np.ones(len(data) + 1, U)
    back[1:] = INVERSE
    np.cumprod(back, out=back)
    hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U))
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, width: int, seed: int = 0) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 56-bit hashes of its runs of `width` words.

    With fewer words the whole sequence is the one shingle; without words the set is empty.
    """
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        at = offsets[first : last + 1]
        words, ends = word_hashes(data[at[0] : at[-1]], at - at[0])
        runs = np.zeros(max(0, len(words) - width + 1), U)
        for k in range(width):
            runs = runs * BASE + words[k : k + len(runs)]
        runs = mix(runs, seed) >> GRAM_SHIFT
        for a, b in zip(ends[:-1], ends[1:]):
            if b - a >= width:
                yield np.unique(runs[a : b - width + 1])
            elif b > a:
                powers = np.full(b - a, INVERSE).cumprod()
                yield mix((words[a:b] * powers).sum(keepdims=True, dtype=U), seed) >> GRAM_SHIFT
            else:
                yield words[:0]
