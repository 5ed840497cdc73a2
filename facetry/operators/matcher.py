"""Find the words of a list in batches of texts, with numpy and without an exploded position.

Every window of a batch has a polynomial hash that follows from running sums, so the hashes of all
windows of one length cost a few array operations. Words are filed in classes by the longest power
of two that fits into them: the hashes of that many first characters leave the places where some
word of the class may start, and only there the windows of the class's lengths are looked up in
sorted hash tables. What is found is compared character by character, so a result never rests
on a hash. The time is in proportion to the text (times the number of classes), whatever the list's size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SLICE_CHARS = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes:
    """Sorted hashes with the numbers of the words they stand for, behind a bit filter."""

    def __init__(self, hashes: np.ndarray, words: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.words = hashes[order], words[order]
        bits = max(10, int(16 * len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, bool)
        self.filter[self._slots(hashes)] = True

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _MIX) >> self.shift).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are listed, and the first place of each in the sorted table."""
        maybe = np.flatnonzero(self.filter[self._slots(hashes)])
        place = np.searchsorted(self.hashes, hashes[maybe])
        place[place == len(self.hashes)] = 0
        listed = self.hashes[place] == hashes[maybe]
        return maybe[listed], place[listed]


class Matcher:
    """All occurrences of a list of distinct words, overlapping ones included."""

    def __init__(self, words: Sequence[str]):
        self.base = np.uint64(0x5851F42D4C957F2D)
        # of an odd base, modulo 2**64
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.codes = self._points("".join(words))
        self.begins = np.cumsum(self.sizes) - self.sizes
        sums, unshift = self._sums(self.codes)
        self.classes = []
        for size in sorted({1 << (int(n).bit_length() - 1) for n in np.unique(self.sizes) if n}):
            mine = np.flatnonzero((self.sizes >= size) & (self.sizes < 2 * size))
            begins = self.begins[mine]
            heads = np.unique((sums[begins + size] - sums[begins]) * unshift[begins])
            lengths = {}
            for n in np.unique(self.sizes[mine]):
                same = mine[self.sizes[mine] == n]
                at = self.begins[same]
                lengths[int(n)] = _Hashes((sums[at + n] - sums[at]) * unshift[at], same)
            self.classes.append((size, _Hashes(heads, np.zeros(len(heads), np.int64)), lengths))

    @staticmethod
    def _points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def _sums(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of code x base^place, and base^-place, which makes a window's hash its own."""
        n = len(codes)
        powers = np.full(n, self.base, np.uint64)
        powers[:1] = 1
        unshift = np.full(n + 1, self.inverse, np.uint64)
        unshift[:1] = 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers), out=sums[1:])
        return sums, np.cumprod(unshift)

    def matches(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, word, ends)``: places in the joined texts by word length, and the texts' ends."""
        codes = self._points("".join(texts))
        ends = np.cumsum(np.array([len(t) for t in texts], np.int64))
        limit = np.repeat(ends, np.diff(ends, prepend=0))
        sums, unshift = self._sums(codes)
        starts, words = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size, heads, lengths in self.classes:
            if size > len(codes):
                break
            near, _ = heads.find((sums[size:] - sums[:-size]) * unshift[: len(codes) - size + 1])
            for n, table in lengths.items():
                at = near[near + n <= limit[near]]
                found, place = table.find((sums[at + n] - sums[at]) * unshift[at])
                at = at[found]
                # words with one hash stand side by side in the table
                while at.size:
                    word = table.words[place]
                    same = self._equal(codes, at, word, n)
                    starts.append(at[same])
                    words.append(word[same])
                    following = place + 1
                    again = (following < len(table.hashes)) & (
                        table.hashes[np.minimum(following, len(table.hashes) - 1)] == table.hashes[place]
                    )
                    at, place = at[again], following[again]
        return np.concatenate(starts), np.concatenate(words), ends

    def _equal(self, codes: np.ndarray, at: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        same = np.ones(len(at), bool)
        begins = self.begins[word]
        for i in range(n):
            same &= codes[at + i] == self.codes[begins + i]
        return same

    def longest_steps(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """``longest_of`` with the words of the list, and the texts' ends."""
        start, word, ends = self.matches(texts)
        return longest_of(start, self.sizes[word], int(ends[-1]) if len(ends) else 0), ends

    def likeliest_steps(self, texts: Sequence[str], weights: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """``likeliest_of`` with the words of the list, and the texts' ends."""
        start, word, ends = self.matches(texts)
        return likeliest_of(start, self.sizes[word], weights[word], int(ends[-1]) if len(ends) else 0, floor), ends


def longest_of(start: np.ndarray, size: np.ndarray, total: int) -> np.ndarray:
    """At each of ``total`` places the length of the longest word that starts there (else 1)."""
    steps = np.ones(total, np.int64)
    by_size = np.argsort(size, kind="stable")
    steps[start[by_size]] = size[by_size]  # the longest is written last
    return steps


def likeliest_of(start: np.ndarray, size: np.ndarray, weight: np.ndarray, total: int, floor: float) -> np.ndarray:
    """At each place the length of the word that the best cut of the rest begins with.

    The best cut has the largest sum of weights; a character that is no word weighs ``floor``;
    of equal cuts the longer word wins. Where no word runs across a place the cut is
    free to end, so texts fall into short stretches, solved from their ends, all in step.
    """
    single = np.full(total, floor, weight.dtype)
    one = size == 1
    single[start[one]] = weight[one]
    start, weight, size = start[~one], weight[~one], size[~one]
    crossed = np.zeros(total + 2, np.int64)
    np.add.at(crossed, start + 1, 1)
    np.add.at(crossed, start + size, -1)
    free = np.flatnonzero(np.cumsum(crossed)[: total + 1] == 0)
    stop = free[np.searchsorted(free, np.arange(total), side="right")] if total else free[:0]
    # by distance from the stretch's end, then place, then length
    order = np.lexsort((size, start, stop[start] - start))
    start, weight, size = start[order], weight[order], size[order]
    runs = np.flatnonzero(np.diff(start, prepend=-1))
    nth = np.arange(len(start)) - np.repeat(runs, np.diff(runs, append=len(start)))
    depth = stop[start] - start
    steps = np.ones(total, np.int64)
    best = np.zeros(total + 1, weight.dtype)
    places = np.argsort(stop - np.arange(total), kind="stable")
    depths = (stop - np.arange(total))[places]
    edges = np.searchsorted(depth, np.arange(1, (int(depths[-1]) if total else 0) + 2))
    levels = np.searchsorted(depths, np.arange(1, (int(depths[-1]) if total else 0) + 2))
    for d in range(len(levels) - 1):
        at = places[levels[d] : levels[d + 1]]
        # behind a stretch's end nothing is added: stretches do not touch each other
        best[at] = single[at] + np.where(at + 1 < stop[at], best[np.minimum(at + 1, total)], 0)
        lot = np.arange(edges[d], edges[d + 1])
        rank = 0
        while lot.size:
            now = lot[nth[lot] == rank]
            if not now.size:
                break
            s, n = start[now], size[now]
            score = weight[now] + np.where(s + n < stop[s], best[np.minimum(s + n, total)], 0)
            better = score >= best[s]
            best[s[better]], steps[s[better]] = score[better], n[better]
            rank += 1
    return steps


def slices(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_CHARS`` characters, which bound the arrays of a search."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def runs(codes: np.ndarray, ends: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the longest stretches of ``member`` characters; none runs across a text's end."""
    inside = np.zeros(len(codes), bool)
    held = codes < len(member)
    inside[held] = member[codes[held]]
    fresh = np.zeros(len(codes) + 1, bool)
    fresh[0] = True
    fresh[ends] = True
    before = np.concatenate([[False], inside[:-1]])[: len(codes)]
    begins = np.flatnonzero(inside & (fresh[:-1] | ~before))
    after = np.concatenate([inside[1:], [False]])[: len(codes)]
    return begins, np.flatnonzero(inside & (fresh[1:] | ~after)) + 1


def cut_places(steps: np.ndarray) -> np.ndarray:
    """Where the tokens start when every step is followed from the start of the first text."""
    out, at, jump, end = [], 0, steps.tolist(), len(steps)
    while at < end:
        out.append(at)
        at += jump[at]
    return np.array(out, np.int64)


def token_lists(texts: Sequence[str], cuts: np.ndarray, ends: np.ndarray):
    """Arrow list array of the texts' tokens, which start at ``cuts`` in the joined texts."""
    import pyarrow as pa

    joined = "".join(texts)
    codes = Matcher._points(joined)
    wide = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    places = np.concatenate([[0], np.cumsum(wide)])
    offsets = np.concatenate([places[cuts], places[-1:]]).astype(np.int64)
    data = pa.py_buffer(joined.encode("utf-8", "surrogatepass"))
    tokens = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(offsets), data)
    lists = np.concatenate([[0], np.searchsorted(cuts, ends)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(lists), tokens.cast(pa.string()))
