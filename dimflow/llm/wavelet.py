"""A wavelet matrix in one compressed file: token ids as bit planes with rank and select.

The ids of a shard become positions in its sorted alphabet, and those a matrix of bit
planes, highest bit first: each plane keeps the order of the ids that the planes above
it have split stably, zeros before ones. A plane is stored in blocks of BLOCK bits,
each compressed by itself, with the number of ones before each block. So a token, the
count of an id in a range and the place of its k-th occurrence each take one block a
plane; the file is never decoded for them.

Layout: MAGIC, the length of the header (8 bytes, little-endian), the header (JSON: name
of a section to offset, length and type), the sections.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard

MAGIC = b"wavelet1"
#: Bits in a block.
BLOCK = 1 << 17
BLOCK_BYTES = BLOCK // 8
#: Blocks that a reader keeps.
CACHED_BLOCKS = 64
LEVEL = 1


def filesystem(path: str):
    """File system and path in it, for any URI that Arrow reads and for absolute paths."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _bit(codes: np.ndarray, shift: int) -> np.ndarray:
    return (codes & codes.dtype.type(1 << shift)) != 0


def encode(ids: np.ndarray, owners: pa.Array, starts: np.ndarray) -> bytes:
    """The file of a shard: its ids, and of each of its documents the id and the place of its first token."""
    seen = np.zeros(int(ids.max()) + 1 if len(ids) else 0, bool)
    seen[ids] = True
    alphabet = np.flatnonzero(seen).astype("<u4")
    codes = (np.cumsum(seen, dtype=np.uint32) - 1)[ids] if len(ids) else np.zeros(0, np.uint32)
    planes = max(1, (len(alphabet) - 1).bit_length()) if len(ids) else 0
    if planes <= 16:
        codes = codes.astype(np.uint16)
    zeros, ones_before, sizes, blocks = [], [], [], []
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for shift in range(planes - 1, -1, -1):
        bits = _bit(codes, shift)
        packed = np.packbits(bits)
        ones = [int(np.count_nonzero(bits[a : a + BLOCK])) for a in range(0, len(bits), BLOCK)]
        ones_before.append(np.cumsum([0, *ones[:-1]]))
        zeros.append(len(bits) - sum(ones))
        below, low, high = np.empty_like(codes), 0, zeros[-1]
        for a, n in zip(range(0, len(bits), BLOCK), ones):  # a block's arrays stay in the caches
            part, bit = codes[a : a + BLOCK], bits[a : a + BLOCK]
            below[low : low + len(part) - n] = part[np.flatnonzero(~bit)]
            below[high : high + n] = part[np.flatnonzero(bit)]
            low, high = low + len(part) - n, high + n
        codes = below
        for at in range(0, len(packed), BLOCK_BYTES):
            blocks.append(packer.compress(packed[at : at + BLOCK_BYTES].tobytes()))
            sizes.append(len(blocks[-1]))
    sink = pa.BufferOutputStream()
    table = pa.table({"owner": owners, "start": pa.array(starts, pa.int64())})
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    parts = {
        "alphabet": alphabet.tobytes(),
        "zeros": np.array(zeros, "<i8").tobytes(),
        "ones": np.array(ones_before, "<u4").tobytes(),
        "ends": np.cumsum(sizes, dtype="<i8").tobytes(),
        "owners": sink.getvalue().to_pybytes(),
        "blocks": b"".join(blocks),
    }
    at, where = 0, {"n": len(ids), "planes": planes}
    for name, part in parts.items():
        where[name] = [at, len(part)]
        at += len(part)
    header = json.dumps(where).encode()
    return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, *parts.values()])


class WaveletFile:
    """Reads a shard's file; positions count from 0 within the shard."""

    def __init__(self, path: str):
        system, at = filesystem(path)
        self._file = system.open_input_file(at)
        head = self._file.read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is no token file")
        length = int.from_bytes(head[8:16], "little")
        where = json.loads(self._file.read_at(length, 16))
        self._base, self._where = 16 + length, where
        self.n, self.planes = where["n"], where["planes"]
        self.alphabet = np.frombuffer(self._part("alphabet"), "<u4")
        self.zeros = np.frombuffer(self._part("zeros"), "<i8").tolist()
        ones = np.frombuffer(self._part("ones"), "<u4").astype(np.int64)
        self._ones = ones.reshape(self.planes, -1) if self.planes else ones.reshape(0, 0)
        self._ends = np.concatenate(([0], np.frombuffer(self._part("ends"), "<i8")))
        self._block = lru_cache(CACHED_BLOCKS)(self._read_block)

    def _part(self, name: str) -> bytes:
        at, length = self._where[name]
        return self._file.read_at(length, self._base + at)

    def documents(self) -> tuple[pa.Array, np.ndarray]:
        """Ids of the documents, and the places of their first tokens with the end of the last."""
        with pa.ipc.open_stream(self._part("owners")) as stream:
            table = stream.read_all().combine_chunks()
        starts = table.column("start").to_numpy()
        owners = table.column("owner")
        owners = owners.chunk(0) if owners.num_chunks else pa.array([], owners.type)
        return owners, np.append(starts, self.n)

    def _read_block(self, plane: int, block: int) -> np.ndarray:
        k = plane * self._ones.shape[1] + block
        at = self._base + self._where["blocks"][0] + int(self._ends[k])
        raw = zstandard.ZstdDecompressor().decompress(self._file.read_at(int(self._ends[k + 1] - self._ends[k]), at))
        count = min(BLOCK, self.n - block * BLOCK)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=count).view(bool)

    def _rank(self, plane: int, i: int) -> int:
        """Ones among the first `i` bits of a plane."""
        if i >= self.n:
            return self.n - self.zeros[plane]
        block, rest = divmod(i, BLOCK)
        return int(self._ones[plane, block]) + (int(np.count_nonzero(self._block(plane, block)[:rest])) if rest else 0)

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the `k`-th bit of that value (from 0) in a plane."""
        before = self._ones[plane]
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = self._block(plane, block)
        return block * BLOCK + int(np.flatnonzero(bits if bit else ~bits)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at place `i`."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for plane in range(self.planes):
            block, rest = divmod(i, BLOCK)
            bit = bool(self._block(plane, block)[rest])
            ones = self._rank(plane, i)
            i = self.zeros[plane] + ones if bit else i - ones
            code = 2 * code + bit
        return int(self.alphabet[code])

    def _code(self, token: int) -> int | None:
        code = int(np.searchsorted(self.alphabet, token))
        return code if code < len(self.alphabet) and self.alphabet[code] == token else None

    def _range(self, code: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of a code between two places lie below the last plane."""
        for plane in range(self.planes):
            a, b = self._rank(plane, low), self._rank(plane, high)
            if code >> (self.planes - 1 - plane) & 1:
                low, high = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often an id occurs from place `low` up to, not including, `high`."""
        code, high = self._code(token), self.n if high is None else min(high, self.n)
        if code is None or low >= high:
            return 0
        a, b = self._range(code, low, high)
        return b - a

    def occurrence(self, token: int, k: int) -> int | None:
        """Place of the `k`-th occurrence of an id, from 0; None if there are fewer."""
        code = self._code(token)
        if code is None:
            return None
        first, end = self._range(code, 0, self.n)
        if not 0 <= k < end - first:
            return None
        at = first + k
        for plane in range(self.planes - 1, -1, -1):
            bit = code >> (self.planes - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids, by undoing the planes from the last to the first."""
        if not self.n:
            return np.zeros(0, "<u4")
        kind = np.uint16 if self.planes <= 16 else np.uint32
        codes, per = np.zeros(self.n, kind), self._ones.shape[1]
        data, base = self._part("blocks"), self._ends
        unpacker = zstandard.ZstdDecompressor()
        for plane in range(self.planes - 1, -1, -1):
            ks = range(plane * per, (plane + 1) * per)
            above, low, high = np.empty(self.n, kind), 0, self.zeros[plane]
            bit = kind(1 << (self.planes - 1 - plane))
            for a, k in zip(range(0, self.n, BLOCK), ks):
                raw = unpacker.decompress(data[base[k] : base[k + 1]])
                bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=min(BLOCK, self.n - a)).view(bool)
                ones, zeros = np.flatnonzero(bits), np.flatnonzero(~bits)
                part = above[a : a + BLOCK]
                part[zeros] = codes[low : low + len(zeros)]
                part[ones] = codes[high : high + len(ones)] | bit
                low, high = low + len(zeros), high + len(ones)
            codes = above
        return self.alphabet[codes]

    def close(self) -> None:
        self._file.close()
