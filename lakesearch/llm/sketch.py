"""Count-min sketches that grow with the input: built per chunk, merged per block.

A sketch of a whole corpus fits no task, so it is cut into blocks of ``BLOCK`` cells. A
chunk of documents sends each block the cells that its keys touch, as sorted numbers in
about eleven bits each, and whether it touches them more than once. A block adds up what
the chunks sent, and answers each with one bit a cell: touched at least twice in all. A
key whose cells in all ``ROWS`` rows are touched twice is estimated as repeated. Counts only err
upwards, so no repeated key is lost.

A chunk may also tell how often its keys touch some cells of the first row; a block adds these counts up and
tells the chunks which cells are crowded. Keys of crowded cells are the same in all chunks.

Cells are at least as many as bytes of text, so a row's load stays below one key in four
cells at every size, and a task holds one block or one chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakesearch.llm.words import mixed

ROWS = 2
BLOCK_BITS = 24
SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_LOW = 8

#: Cells of a chunk for a block, and the block's answer. A row with chunk ``-1 - c`` has counts (uint32) in ``twice``, from
#: chunk c; an answer with block ``-1 - b`` tells which of the chunk's cells in block b are crowded.
CELLS = "block int, chunk int, cells binary, twice binary"
ANSWERS = "chunk int, block int, bits binary"


def sketch_bits(n_bytes: int) -> int:
    """Bits of a cell number: 2 ** bits is at least ``n_bytes``."""
    return min(60, max(16, int(n_bytes - 1).bit_length() if n_bytes > 1 else 0))


def cells_of(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mixed(keys ^ np.uint64(SEEDS[row])) >> np.uint64(64 - bits)).astype(np.int64)


def pack(offsets: np.ndarray) -> bytes:
    """Sorted distinct offsets below 2 ** BLOCK_BITS: low byte as it is, the rest in unary."""
    n, top = len(offsets), 1 << (BLOCK_BITS - _LOW)
    if 4 * n <= n + (top + n) // 8:
        return b"\0" + offsets.astype("<u4").tobytes()
    unary = np.zeros(top + n, np.uint8)
    unary[(offsets >> _LOW) + np.arange(n)] = 1
    return b"\1" + np.uint32(n).tobytes() + (offsets & 255).astype(np.uint8).tobytes() + np.packbits(unary).tobytes()


def unpack(data: bytes) -> np.ndarray:
    if data[0] == 0:
        return np.frombuffer(data, "<u4", offset=1).astype(np.int64)
    n = int(np.frombuffer(data, np.uint32, 1, 1)[0])
    low = np.frombuffer(data, np.uint8, n, 5).astype(np.int64)
    at = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=5 + n)))[:n]
    return (at - np.arange(n) << _LOW) | low


def _by_block(cells: np.ndarray, row: int, bits: int):
    """(block, slice) of sorted cells; blocks of different rows have different numbers."""
    high = cells >> BLOCK_BITS
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(high)) + 1, [len(cells)])) if len(cells) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield row * (1 << max(0, bits - BLOCK_BITS)) + int(high[a]), slice(int(a), int(b))


def sketch_rows(keys: np.ndarray, chunk: int, bits: int) -> pa.Table:
    """What a chunk with these keys sends, as ``CELLS``."""
    blocks, cells, twice = [], [], []
    for row in range(ROWS):
        touched, counts = np.unique(cells_of(keys, row, bits), return_counts=True)
        for block, part in _by_block(touched, row, bits):
            blocks.append(block)
            cells.append(pack(touched[part] & ((1 << BLOCK_BITS) - 1)))
            twice.append(np.packbits(counts[part] > 1).tobytes())
    return pa.table({"block": pa.array(blocks, pa.int32()), "chunk": pa.array([chunk] * len(blocks), pa.int32()),
                     "cells": pa.array(cells, pa.binary()), "twice": pa.array(twice, pa.binary())})


def crowd_rows(keys: np.ndarray, numbers: np.ndarray, chunk: int, bits: int) -> pa.Table:
    """How often the chunk's cells are touched by these distinct keys, as ``CELLS``."""
    blocks, cells, counts = [], [], []
    touched, which = np.unique(cells_of(keys, 0, bits), return_inverse=True)
    sums = np.zeros(len(touched), np.int64)
    np.add.at(sums, which, numbers)
    for block, part in _by_block(touched, 0, bits):
        blocks.append(block)
        cells.append(pack(touched[part] & ((1 << BLOCK_BITS) - 1)))
        counts.append(sums[part].astype("<u4").tobytes())
    return pa.table({"block": pa.array(blocks, pa.int32()), "chunk": pa.array([-1 - chunk] * len(blocks), pa.int32()),
                     "cells": pa.array(cells, pa.binary()), "twice": pa.array(counts, pa.binary())})


def merge_block(sent: pa.Table, crowd: int = 0) -> pa.Table:
    """Sum of what the chunks sent to one block; the answers, as ``ANSWERS``. Cells are crowded
    that are told to be touched more than ``crowd`` times."""
    block = sent["block"][0].as_py()
    chunks = np.array(sent["chunk"].to_pylist(), np.int64)
    told, sent = sent.filter(pa.array(chunks < 0)), sent.filter(pa.array(chunks >= 0))
    counts = np.zeros(1 << BLOCK_BITS, np.uint8)
    chunks = sent["chunk"].to_pylist()
    crowded = np.zeros(0, np.int64)
    if told.num_rows:
        at, which = np.unique(np.concatenate([unpack(c.as_py()) for c in told["cells"]]), return_inverse=True)
        sums = np.zeros(len(at), np.int64)
        np.add.at(sums, which, np.concatenate([np.frombuffer(c.as_py(), "<u4") for c in told["twice"]]).astype(np.int64))
        crowded = at[sums > crowd]
    for cells, twice in zip(sent["cells"], sent["twice"]):
        at = unpack(cells.as_py())
        more = np.unpackbits(np.frombuffer(twice.as_py(), np.uint8))[:len(at)]
        counts[at] = np.minimum(counts[at] + 1 + more, 2)
    to, blocks, bits = [], [], []
    for chunk, cells in zip(chunks, sent["cells"]):
        at = unpack(cells.as_py())
        for name, found in ((block, counts[at] > 1), (-1 - block, np.isin(at, crowded) if len(crowded) else np.zeros(0, bool))):
            if found.any():
                to.append(chunk)
                blocks.append(name)
                bits.append(np.packbits(found).tobytes())
    return pa.table({"chunk": pa.array(to, pa.int32()), "block": pa.array(blocks, pa.int32()), "bits": pa.array(bits, pa.binary())})


def answers(cells: DataFrame, crowd: int = 0) -> DataFrame:
    def merge(sent: pa.Table) -> pa.Table:
        return merge_block(sent, crowd)

    return cells.groupBy("block").applyInArrow(merge, ANSWERS)


def estimated_crowded(keys: np.ndarray, answered: dict[int, bytes], bits: int) -> np.ndarray:
    """Which of a chunk's keys touch a crowded cell; ``keys`` are all that the chunk's cells were sent for."""
    touched, which = np.unique(cells_of(keys, 0, bits), return_inverse=True)
    crowded = np.zeros(len(touched), bool)
    for block, part in _by_block(touched, 0, bits):
        got = answered.get(-1 - block)
        if got is not None:
            crowded[part] = np.unpackbits(np.frombuffer(got, np.uint8))[:part.stop - part.start].astype(bool)
    return crowded[which]


def estimated_repeated(keys: np.ndarray, answered: dict[int, bytes], bits: int) -> np.ndarray:
    """Which of a chunk's keys are estimated as repeated, from its blocks' answers."""
    out = np.ones(len(keys), bool)
    for row in range(ROWS):
        touched, which = np.unique(cells_of(keys, row, bits), return_inverse=True)
        repeated = np.zeros(len(touched), bool)
        for block, part in _by_block(touched, row, bits):
            got = answered.get(block)
            if got is not None:
                repeated[part] = np.unpackbits(np.frombuffer(got, np.uint8))[:part.stop - part.start].astype(bool)
        out &= repeated[which]
    return out
