"""A Bloom filter over the window hashes of a long word list, built by Spark and asked inside the scan.

One 64-bit cell per key holds its four bits, so a lookup is one gather. Every task sets the bits of the
cells that Spark gave it; cells go to the driver and to the tasks. There are 16 bits per key up
to ``most`` bytes; a longer list fills the filter more, which lets more through and loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.operators.matcher import Matcher, slices
from facetry.session import materialize, ship_package

MOST_BYTES = 64 << 20
BLOCK_CELLS = 1 << 12
_LENGTH = np.uint64(0xD1B54A32D192ED03)
_CELL = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.uint64(0xC2B2AE3D27D4EB4F)


def class_of(lengths: np.ndarray) -> np.ndarray:
    """The longest power of two that fits into each length."""
    return 1 << (np.floor(np.log2(lengths)).astype(np.int64))


def _keys(hashes: np.ndarray, length) -> np.ndarray:
    """Window hashes as keys that differ by the window's length, with well-mixed bits."""
    mixed = (hashes + _LENGTH * np.asarray(length).astype(np.uint64)) * _CELL
    return (mixed ^ (mixed >> np.uint64(29))) * _BITS


@dataclass
class WindowFilter:
    """``lengths``: by head size the word lengths of that class; ``cells`` holds heads and whole words."""

    cells: np.ndarray
    lengths: dict[int, list[int]]

    def maybe(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """The places of the windows that the list may hold."""
        keys = _keys(hashes, length)
        mask = _mask(keys)
        return np.flatnonzero((self.cells[_cell(keys, len(self.cells))] & mask) == mask)


def _cell(keys: np.ndarray, cells: int) -> np.ndarray:
    return (keys >> np.uint64(64 - (cells.bit_length() - 1))).astype(np.int64)


def _mask(keys: np.ndarray) -> np.ndarray:
    mask = np.zeros(len(keys), np.uint64)
    for i in range(4):
        mask |= np.uint64(1) << ((keys >> np.uint64(6 * i)) & np.uint64(63))
    return mask


def _list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of the words and of their heads, each once per slice."""
    hashed = Matcher(())
    for batch in batches:
        words = batch.column(0).to_pylist()
        for begin, end in slices(words):
            some = words[begin:end]
            sizes = np.array([len(w) for w in some], np.int64)
            sums, unshift = hashed._sums(hashed._points("".join(some)))
            at = np.cumsum(sizes) - sizes
            heads = class_of(sizes)
            keys = [
                _keys((sums[at + n] - sums[at]) * unshift[at], marked)
                for n, marked in ((sizes, sizes), (heads, _head_mark(heads)))
            ]
            yield pa.record_batch([pa.array(np.unique(np.concatenate(keys)).view(np.int64))], ["key"])


def _head_mark(size):
    """What stands for a head's length: a whole word of the same length is another key."""
    return np.asarray(size) + (1 << 40)


def build(words: DataFrame, most: int = MOST_BYTES) -> WindowFilter:
    """The filter of ``words(token)``, distinct and not empty."""
    ship_package(words.sparkSession)
    keys = materialize(words.select("token").mapInArrow(_list_keys, "key long").distinct())
    wanted = 16 * max(1, keys.count()) // 64
    cells = max(BLOCK_CELLS, min(1 << max(1, most // 8).bit_length() - 1, 1 << wanted.bit_length()))
    shift = 64 - ((cells // BLOCK_CELLS).bit_length() - 1)
    block = F.lit(0).cast("long") if shift == 64 else F.expr(f"shiftrightunsigned(key, {shift})")

    def fill(table: pa.Table) -> pa.Table:
        found = table["key"].to_numpy().view(np.uint64)
        own = np.zeros(BLOCK_CELLS, np.uint64)
        np.bitwise_or.at(own, _cell(found, cells) % BLOCK_CELLS, _mask(found))
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int64()), "bits": pa.array([own.tobytes()], pa.binary())})

    blocks = keys.withColumn("block", block).groupBy("block").applyInArrow(fill, "block long, bits binary")
    held = np.zeros(cells, np.uint64)
    for row in blocks.toArrow().to_pylist():
        held[row["block"] * BLOCK_CELLS : (row["block"] + 1) * BLOCK_CELLS] = np.frombuffer(row["bits"], np.uint64)
    sizes = np.array(sorted(r["n"] for r in words.select(F.length("token").alias("n")).distinct().collect()), np.int64)
    lengths: dict[int, list[int]] = {}
    for size, n in zip(class_of(sizes).tolist(), sizes.tolist(), strict=True):
        lengths.setdefault(size, []).append(n)
    return WindowFilter(held, lengths)


def windows(held: WindowFilter, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, ends)``: the places of the joined texts where a listed word may stand."""
    hashed = Matcher(())
    codes = hashed._points("".join(texts))
    ends = np.cumsum(np.array([len(t) for t in texts], np.int64))
    limit = np.repeat(ends, np.diff(ends, prepend=0))
    sums, unshift = hashed._sums(codes)
    starts, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size, lengths in held.lengths.items():
        if size > len(codes):
            continue
        near = held.maybe((sums[size:] - sums[:-size]) * unshift[: len(codes) - size + 1], int(_head_mark(size)))
        for n in lengths:
            at = near[near + n <= limit[near]]
            at = at[held.maybe((sums[at + n] - sums[at]) * unshift[at], n)]
            starts.append(at)
            sizes.append(np.full(len(at), n))
    return np.concatenate(starts), np.concatenate(sizes), ends
