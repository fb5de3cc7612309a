"""A static range asymmetric numeral system (Duda, 2013) for token ids, in numpy: many lanes are coded at once.

A frame holds a run of ids: a table of frequencies that all of its blocks share, and blocks of at most BLOCK ids. A block's ids are dealt out
to lanes in turn, each with a state of 64 bits of its own; all lanes give and take words of 32 bits from one stream, interleaved.
Checkpoints hold all states and the place in the stream, each CHECK steps, with a checksum of the ids from there to the next: whatever
lies between two of them can be decoded by itself.

    frame:       "TID1", bits of a slot (u8), blocks (u32), bytes of the table (u32), bytes of each block (u64 each), table, blocks
    table:       zlib of: symbols (u32), gaps between the ids that occur, in order (u32 each), their frequencies (u32 each)
    block:       ids (u64), lanes (u32), checkpoints (u32), words (u64), checkpoints, words (u32 each)
    checkpoint:  words before it (u64), CRC-32 of its ids as little-endian u32 (u32), the lanes' states (u64 each)

All numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MAGIC = b"TID1"
BLOCK, LANES, CHECK = 1 << 22, 4096, 256
#: Bits of a slot number: frequencies sum up to two to this power; more if a table has very many ids.
BITS = 20
_LOW = np.uint64(1 << 31)
_HEAD, _BLOCK_HEAD, _CHECK_HEAD = struct.Struct("<4sBII"), struct.Struct("<QIIQ"), struct.Struct("<QI")


@dataclass
class Table:
    """Ids that occur, in order, with frequencies that sum up to 2**bits."""

    symbols: np.ndarray
    frequency: np.ndarray
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> "Table":
        """The frequencies of a run of ids, each at least one slot; what rounding leaves goes to or comes from the most frequent."""
        if len(ids) and int(ids.max()) < 8 * len(ids) + 65_536:
            counts = np.bincount(ids)
            symbols = np.flatnonzero(counts)
            counts = counts[symbols]
        else:
            symbols, counts = np.unique(ids, return_counts=True)
        bits = max(BITS, int(len(symbols)).bit_length() + 4)
        room = 1 << bits
        frequency = np.maximum(1, np.floor(counts * (room / max(1, counts.sum())))).astype(np.int64)
        spare = room - int(frequency.sum())
        for i in np.argsort(-frequency, kind="stable") if len(symbols) else []:
            step = max(spare, 1 - int(frequency[i])) if spare < 0 else spare
            frequency[i] += step
            spare -= step
            if not spare:
                break
        return cls(symbols.astype(np.uint32), frequency.astype(np.uint64), bits)

    @property
    def start(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.frequency)[:-1])).astype(np.uint64) if len(self.symbols) else np.zeros(0, np.uint64)

    def places(self, ids: np.ndarray) -> np.ndarray:
        if len(self.symbols) and int(self.symbols[-1]) < 1 << 24:
            place = np.zeros(int(self.symbols[-1]) + 1, dtype=np.int32)
            place[self.symbols] = np.arange(len(self.symbols))
            return place[ids]
        return np.searchsorted(self.symbols, ids).astype(np.int32)

    def to_bytes(self) -> bytes:
        gaps = np.diff(self.symbols.astype(np.int64), prepend=0)
        return zlib.compress(struct.pack("<I", len(self.symbols)) + gaps.astype("<u4").tobytes() + self.frequency.astype("<u4").tobytes())

    @classmethod
    def from_bytes(cls, data: bytes, bits: int) -> "Table":
        data = zlib.decompress(data)
        n = struct.unpack_from("<I", data)[0]
        gaps, frequency = (np.frombuffer(data, "<u4", n, 4 + 4 * n * i) for i in (0, 1))
        return cls(np.cumsum(gaps.astype(np.int64)).astype(np.uint32), frequency.astype(np.uint64), bits)


def encode_block(ids: np.ndarray, table: Table, places: np.ndarray) -> bytes:
    """One block. ids as little-endian u32, places: their places in the table. The last lanes are filled up with the table's first id."""
    n = len(ids)
    lanes = max(1, min(LANES, n // CHECK))
    steps = -(-n // lanes)
    grid = np.zeros(steps * lanes, dtype=np.int32)
    grid[:n] = places
    grid, starts = grid.reshape(steps, lanes), table.start
    room, bits, word = np.uint64(63 - table.bits), np.uint64(table.bits), np.uint64(32)
    state, streams, marks, given = np.full(lanes, _LOW, dtype=np.uint64), [], [], 0
    for t in range(steps - 1, -1, -1):
        frequency, start = table.frequency[grid[t]], starts[grid[t]]
        over = np.flatnonzero(state >= frequency << room)
        if len(over):
            out = state[over]
            streams.append(out.astype("<u4"))  # the low half
            given += len(out)
            state[over] = out >> word
        whole = state // frequency
        state = (whole << bits) + (state - whole * frequency) + start
        if t % CHECK == 0:
            marks.append((given, t, state.copy()))
    parts = [_BLOCK_HEAD.pack(n, lanes, len(marks), given)]
    for sent, t, held in reversed(marks):
        parts += [_CHECK_HEAD.pack(given - sent, zlib.crc32(ids[t * lanes : (t + CHECK) * lanes])), held.astype("<u8").tobytes()]
    return b"".join([*parts, *(x.tobytes() for x in reversed(streams))])


def encode(ids: np.ndarray) -> bytes:
    """A frame of ids (below 2**32)."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    table = Table.of(ids)
    places = table.places(ids)
    blocks = [encode_block(ids[at : at + BLOCK], table, places[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)]
    shared = table.to_bytes()
    return b"".join([_HEAD.pack(MAGIC, table.bits, len(blocks), len(shared)), struct.pack(f"<{len(blocks)}Q", *map(len, blocks)), shared, *blocks])


class Frame:
    """A frame's blocks and checkpoints, each decoded when asked for."""

    def __init__(self, data: bytes):
        try:
            magic, bits, blocks, size = _HEAD.unpack_from(data)
            if magic != MAGIC:
                raise ValueError("no frame of token ids")
            sizes = struct.unpack_from(f"<{blocks}Q", data, _HEAD.size)
            at = _HEAD.size + 8 * blocks + size
            self.data, self.bits = data, bits
            self.table = Table.from_bytes(data[at - size : at], bits)
        except (struct.error, zlib.error) as e:
            raise ValueError("a damaged frame of token ids") from e
        self.begins = np.concatenate(([0], np.cumsum(np.array(sizes, dtype=np.int64)))) + at
        if int(self.begins[-1]) != len(data):
            raise ValueError("a frame of token ids of another size than it says")
        self.start = self.table.start
        self.slots = np.repeat(np.arange(len(self.table.symbols), dtype=np.int32), self.table.frequency.astype(np.int64))

    def checkpoints(self, block: int) -> int:
        return _BLOCK_HEAD.unpack_from(self.data, int(self.begins[block]))[2]

    def segment(self, block: int, checkpoint: int) -> np.ndarray:
        """The ids from one checkpoint to the next, checked."""
        at = int(self.begins[block])
        n, lanes, checkpoints, words = _BLOCK_HEAD.unpack_from(self.data, at)
        size = _CHECK_HEAD.size + 8 * lanes
        mark = at + _BLOCK_HEAD.size + checkpoint * size
        position, checksum = _CHECK_HEAD.unpack_from(self.data, mark)
        stream = np.frombuffer(self.data, "<u4", words, at + _BLOCK_HEAD.size + checkpoints * size)
        state = np.frombuffer(self.data, "<u8", lanes, mark + _CHECK_HEAD.size).astype(np.uint64)
        first = checkpoint * CHECK
        steps = min(CHECK, -(-n // lanes) - first)
        out = np.empty((steps, lanes), dtype=np.int32)
        mask, bits, word, frequency, start = np.uint64((1 << self.bits) - 1), np.uint64(self.bits), np.uint64(32), self.table.frequency, self.start
        for t in range(steps):
            slot = state & mask
            place = self.slots[slot.astype(np.int64)]
            out[t] = place
            state = frequency[place] * (state >> bits) + slot - start[place]
            under = np.flatnonzero(state < _LOW)
            if len(under):
                if position + len(under) > words:
                    raise ValueError("a damaged block of token ids")
                state[under] = (state[under] << word) | stream[position : position + len(under)]
                position += len(under)
        ids = self.table.symbols[out.reshape(-1)[: n - first * lanes]].astype("<u4")
        if zlib.crc32(ids) != checksum:
            raise ValueError("a block of token ids fails its checksum")
        return ids

    def __iter__(self) -> Iterator[np.ndarray]:
        for block in range(len(self.begins) - 1):
            for checkpoint in range(self.checkpoints(block)):
                yield self.segment(block, checkpoint)

    def ids(self) -> np.ndarray:
        return np.concatenate([*self, np.zeros(0, "<u4")])
