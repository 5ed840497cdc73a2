"""Texts inside a task: bounded slices of a batch, words, and codes of runs of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_CHARS = 2_000_000  # of texts handled together; a longer text is handled alone


def slices(texts: pa.Array, most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with at most ``most`` bytes together, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield begin, end
        begin = end


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, one text after the other.

    ``sizes`` are the numbers of words, ``starts`` the texts' first places, ``flat`` the words.
    """

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        parts = lists.flatten()
        # blanks at a text's ends leave empty parts
        full = pc.not_equal(parts, "")
        upto = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False).astype(np.int64))])
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        ends = upto[ends]
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.sizes = ends - self.starts
        self.flat = parts.filter(full)
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(self.flat)) - self.starts[self.text]


# two odd multipliers of full order modulo 2**64, and their inverses
BASES = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
INVERSES = np.array([pow(int(b), -1, 1 << 64) for b in BASES], np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, bases: np.ndarray, n: int) -> np.ndarray:
    """``(n or more, 2)``: the powers 0, 1, 2, .. of both bases; grown by doubling."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        rows = np.repeat(bases[None], size, axis=0)
        rows[0] = 1
        have = _powers[name] = np.cumprod(rows, axis=0, dtype=np.uint64)
    return have


class Runs:
    """Codes of runs of words: two sums of word codes times powers, modulo 2**64 each.

    A word's code is its 128-bit XXH3. A run's code does not depend on its place.
    """

    def __init__(self, words: Words):
        import xxhash

        coded = words.flat.dictionary_encode()
        each = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
        table = np.frombuffer(each, "<u8").reshape(-1, 2)
        codes = table[coded.indices.to_numpy()]
        n = len(codes)
        self.sums = np.zeros((n + 1, 2), np.uint64)
        np.cumsum(codes * _power_table("up", BASES, n)[:n], axis=0, out=self.sums[1:])

    def codes(self, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """The codes of the runs of ``length`` words that start at ``at``."""
        down = _power_table("down", INVERSES, len(self.sums))
        return (self.sums[at + length, which] - self.sums[at, which]) * down[at, which]
