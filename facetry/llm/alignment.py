"""Cross-tokenizer alignment by merge-path partitioning.

A text with a leading blank is encoded by two tokenisers, A (byte-level BPE, a ``tokenizers`` file)
and B (a SentencePiece BPE model, which adds the blank itself). Both cut the same bytes, so their tokens
are two ascending lists of byte ends. Where both end, a group of tokens ends; an A and a B token are
linked when their byte ranges overlap.

Merging. The ends of all different chunks (below) of a slice form one list per tokeniser. The merge of both lists
is a path through a grid; binary searches along its diagonals, all in step, find where the path crosses
them, which cuts the merge into pieces of ``PIECE`` ends whatever the texts' lengths. No cut separates two
equal ends. Every piece is merged on its own: every distinct end closes exactly one overlap,
that of the tokens which hold the byte before it, and equal ends close groups. A group that is open at
a piece's border goes on in the next: groups are numbered through by the counts of the pieces before.

Counting. A task adds up its links per pair of ids before anything is shuffled; the counts of
all texts are one aggregation. The most frequent pairs (``max_pairs``; at the border all of one
count go together) and the highest count of each B id, both bounded by parameters or vocabularies,
are broadcast; the links of rarer pairs, if there are any, are joined with the rest of the counts.

Tokens are cached per chunk of text: neither tokeniser has tokens across a border before a single
blank that a character other than white space follows (B has no piece with a blank inside, A's pattern takes
such a blank to the right). A text's groups and links are those of its chunks, so a chunk that occurs
often in a slice is merged once. The cache is bounded and serves all texts of a worker.

Defined cases: strings of special tokens are plain text. A text that is null, empty or not given back by
both tokenisers (it holds U+2581, which B reads as a blank) has no tokens, links or groups. Null ids
and repeated rows are texts like any other and count each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.llm.common import most_frequent
from facetry.llm.pieces import Vocabulary
from facetry.llm.texts import slices
from facetry.session import materialize, ship_package

PIECE = 1 << 17  # ends merged at once
SLICE = 2_000_000  # characters of texts aligned together
CACHE_CHUNKS, CACHE_CHARS = 400_000, 8_000_000  # per worker process
SHIFT = 20  # bits of a B id in a pair's key
HELD_LIMIT = 1 << 20  # distinct pairs a task holds before it passes them on

CUT = re.compile(r"(?<! )(?= \S)")


def byte_alphabet() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Printable bytes stand for themselves, the others are numbered from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


# fixed value: how byte-level vocabularies of this kind cut a text before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenisers:
    """Both vocabularies as bytes per id; small enough to broadcast."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        letters = byte_alphabet()
        self.raw_a = [b""] * (max(model["vocab"].values()) + 1)
        special = {x["id"] for x in spec["added_tokens"]}
        for entry, i in model["vocab"].items():
            self.raw_a[i] = entry.encode() if i in special else bytes(letters[c] for c in entry)
        # merges are tried in the order of the ids they make, so the ids serve as ranks
        self.ranks = {raw: i for i, raw in enumerate(self.raw_a) if raw and i not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][x + y] for x, y in pairs]
        plain = model["type"] == "BPE" and spec["normalizer"] is None and cut["type"] == "ByteLevel"
        if not plain or cut["add_prefix_space"] or not cut.get("use_regex", True) or made != sorted(made):
            raise ValueError("only byte-level BPE, cut by the usual pattern, with ids in the order of the merges")
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a byte has no token")
        self.raw_b = Vocabulary(path_b).raw  # refuses models whose pieces hold a blank inside
        with open(path_b, "rb") as file:
            self.model = file.read()

    def open(self):
        """``(a, b)``: a tiktoken encoding of A's entries, and B."""
        import sentencepiece
        import tiktoken

        a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        return a, sentencepiece.SentencePieceProcessor(model_proto=self.model)


class Store:
    """Token ids of chunks, one after the other in one growing array."""

    def __init__(self):
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.used = self.chunks = 0

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        """Chunks with their ids in a row; ``ends``: where each chunk's ids end."""
        self.ids = self._room(self.ids, self.used + len(ids))
        self.ends = self._room(self.ends, self.chunks + len(ends))
        self.ids[self.used : self.used + len(ids)] = ids
        self.ends[self.chunks : self.chunks + len(ends)] = self.used + ends
        self.used += len(ids)
        self.chunks += len(ends)

    @staticmethod
    def _room(held: np.ndarray, size: int) -> np.ndarray:
        return held if len(held) >= size else np.concatenate([held, np.zeros(max(size, 2 * len(held)) - len(held), held.dtype)])

    def take(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some chunks in a row, and how many each has."""
        ends = self.ends[chunks]
        sizes = ends - np.where(chunks > 0, self.ends[chunks - 1], 0)
        upto = np.cumsum(sizes)
        return self.ids[np.repeat(ends - upto, sizes) + np.arange(upto[-1] if len(upto) else 0)], sizes


class Encoder:
    """Encodes slices of texts; lives as long as its worker process."""

    def __init__(self, tokenisers: Tokenisers):
        self.tokenisers = tokenisers
        self.a, self.b = tokenisers.open()
        self.bytes_a = np.array([len(x) for x in tokenisers.raw_a], np.int64)
        self.bytes_b = np.array([len(x) for x in tokenisers.raw_b], np.int64)
        most = max(len(tokenisers.raw_a), len(tokenisers.raw_b))
        self.decimals = [b"%d%s" % (i, mark) for i in range(most) for mark in (b",", b"|", b";")]
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.stores = Store(), Store()
        self.chars = 0
        self.bad: set[int] = set()  # chunks that a tokeniser does not give back

    def _forget(self) -> None:
        """Keeps the half that was learned first: frequent chunks come early."""
        kept = dict(islice(self.place.items(), CACHE_CHUNKS // 2))
        chars = sum(map(len, kept))
        if chars > CACHE_CHARS // 2:
            self.clear()
            return
        self.place, self.chars = kept, chars
        self.bad = {i for i in self.bad if i < len(kept)}
        for store in self.stores:
            store.chunks = len(kept)
            store.used = int(store.ends[len(kept) - 1])

    @staticmethod
    def chunks(texts: pa.Array) -> tuple[list[str], list[np.ndarray]]:
        """The different chunks, without their leading blanks, and per text the places of its own."""
        known = pc.not_equal(pc.fill_null(texts, ""), "").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        coded = lists.flatten().dictionary_encode()
        different, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        out = np.split(codes, np.cumsum(lists.value_lengths().to_numpy())[:-1]) if len(texts) else []
        # cut at every blank; a part that is empty or starts with white space should not have been cut off
        odd = np.fromiter((not c or c[0].isspace() for c in different), bool, len(different))
        more: dict[str, int] = {}
        for i, (has_text, found) in enumerate(zip(known, out, strict=True)):
            if not has_text:
                out[i] = found[:0]
            elif odd[found].any():
                parts = [c[1:] for c in CUT.split(" " + texts[i].as_py()) if c]
                out[i] = np.array([more.setdefault(c, len(different) + len(more)) for c in parts], np.int64)
        return different + list(more), out

    def _learn(self, new: list[str]) -> None:
        # chunks without blanks may be encoded in a row, as the borders between them are kept
        alone = [c for c in new if not c or " " in c or c[0].isspace()]
        joined = [c for c in new if c and " " not in c and not c[0].isspace()]
        for begin in range(0, len(joined), 5000):
            some = joined[begin : begin + 5000]
            found = self._in_a_row(some)
            if found is None:  # a tokeniser does not give one of them back
                alone += some
            else:
                self._keep(some, found)
        for begin in range(0, len(alone), 5000):
            some = alone[begin : begin + 5000]
            a = [self.a.encode_ordinary(" " + c) for c in some]
            b = self.b.encode(some, num_threads=1)
            raw, first = self.tokenisers.raw_b, len(self.place)
            self.bad.update(first + i for i, c in enumerate(some) if b"".join([raw[x] for x in b[i]]) != (" " + c).encode())
            self._keep(some, [(np.array([i for x in lists for i in x], np.int32), np.cumsum([len(x) for x in lists])) for lists in (a, b)])

    def _in_a_row(self, some: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Per tokeniser the chunks' ids and where each chunk's ids end."""
        text = " ".join(some)
        data = (" " + text).encode()
        borders = np.cumsum(np.fromiter(map(len, map(str.encode, some)), np.int64, len(some)) + 1)
        found = []
        for ids, lengths, raw in (
            (self.a.encode_ordinary(" " + text), self.bytes_a, self.tokenisers.raw_a),
            (self.b.encode(text), self.bytes_b, self.tokenisers.raw_b),
        ):
            if b"".join([raw[i] for i in ids]) != data:
                return None
            ids = np.array(ids, np.int32)
            ends = np.cumsum(lengths[ids])
            at = np.searchsorted(ends, borders)
            if (ends[at] != borders).any():
                return None
            found.append((ids, at + 1))
        return found

    def _keep(self, some: list[str], found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        first = len(self.place)
        self.place.update(zip(some, range(first, first + len(some)), strict=True))
        self.chars += sum(map(len, some))
        for store, (ids, ends) in zip(self.stores, found, strict=True):
            store.add(ids, ends)

    def slice(self, texts: pa.Array) -> Aligned:
        different, used = self.chunks(texts)
        new = [c for c in different if c not in self.place]
        if self.place and (len(self.place) + len(new) > CACHE_CHUNKS or self.chars > CACHE_CHARS):
            self._forget()
            new = [c for c in different if c not in self.place]
        self._learn(list(dict.fromkeys(new)))
        place = np.fromiter(map(self.place.__getitem__, different), np.int64, len(different))
        chunks = [place[u] for u in used]
        if self.bad:
            chunks = [c if self.bad.isdisjoint(c.tolist()) else c[:0] for c in chunks]
        return Aligned(self, chunks)


class Aligned:
    """The tokens of some texts, aligned: all different chunks of a slice in one merge.

    ``chunks`` are each text's chunks in the encoder's stores. Chunks end with a token of either kind, so
    a text's links and groups are those of its chunks, one after the other.
    """

    def __init__(self, encoder: Encoder, chunks: list[np.ndarray]):
        different, self.chunk, self.times = np.unique(
            np.concatenate([np.zeros(0, np.int64), *chunks]), return_inverse=True, return_counts=True
        )
        self.edges = np.cumsum([0, *map(len, chunks)])
        self.chunks, self.decimals = len(different), encoder.decimals
        self.ids, self.ends, self.owner, self.n = [], [], [], []
        for store, lengths in zip(encoder.stores, (encoder.bytes_a, encoder.bytes_b), strict=True):
            ids, sizes = store.take(different)
            self.ids.append(ids)
            self.ends.append(np.cumsum(lengths[ids]))
            self.owner.append(np.repeat(np.arange(self.chunks), sizes))
            self.n.append(sizes)
        # the number of each token's group within the slice, and whether it closes it
        self.group = [np.zeros(len(x), np.int64) for x in self.ids]
        self.closes = [np.zeros(len(x), bool) for x in self.ids]

    def total(self, per_chunk: np.ndarray) -> np.ndarray:
        """Per text the sum of a number that its chunks have."""
        upto = np.concatenate([[0], np.cumsum(per_chunk.astype(np.int64)[self.chunk])])
        return upto[self.edges[1:]] - upto[self.edges[:-1]]

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The linked places of A and B tokens, piece by piece; fills in the groups."""
        a, b = self.ends
        groups = 0
        cuts = merge_path(a, b, PIECE)
        for (i0, j0), (i1, j1) in zip(cuts, cuts[1:], strict=False):
            ea, eb = a[i0:i1], b[j0:j1]
            in_b, in_a = np.searchsorted(eb, ea), np.searchsorted(ea, eb)
            shared_a, shared_b = _equal(ea, eb, in_b), _equal(eb, ea, in_a)
            self.closes[0][i0:i1], self.closes[1][j0:j1] = shared_a, shared_b
            self.group[0][i0:i1] = groups + np.cumsum(shared_a) - shared_a
            self.group[1][j0:j1] = groups + np.cumsum(shared_b) - shared_b
            groups += int(shared_a.sum())
            # an end closes the overlap of the tokens that hold the byte before it
            alone = np.flatnonzero(~shared_b)
            yield np.concatenate([np.arange(i0, i1), i0 + in_a[alone]]), np.concatenate([j0 + in_b, j0 + alone])

    def keys(self, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        return (self.ids[0][at_a].astype(np.int64) << SHIFT) | self.ids[1][at_b]

    def n_groups(self) -> np.ndarray:
        return self.total(np.bincount(self.owner[0][self.closes[0]], minlength=self.chunks))

    def groups(self) -> list[bytes]:
        """Per text its groups in decimal, as in ``a1,a2|b1;a3|b2,b3``."""
        (a, b), (group_a, group_b) = self.ids, self.group
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        upto_a = np.cumsum(np.bincount(group_a, minlength=groups))
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
        # a group's A tokens come before its B tokens; each is written with the mark after it
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + before_b[group_a]] = 3 * a.astype(np.int64) + self.closes[0]
        codes[np.arange(len(b)) + upto_a[group_b]] = 3 * b.astype(np.int64) + 2 * self.closes[1]
        parts = list(map(self.decimals.__getitem__, codes.tolist()))
        edges = np.cumsum([0, *(self.n[0] + self.n[1])]).tolist()
        written = [b"".join(parts[i:j]) for i, j in zip(edges, edges[1:], strict=False)]
        of_texts = list(map(written.__getitem__, self.chunk.tolist()))
        return [b"".join(of_texts[i:j])[:-1] for i, j in zip(self.edges, self.edges[1:], strict=False)]


def _equal(ends: np.ndarray, others: np.ndarray, at: np.ndarray) -> np.ndarray:
    if not len(others):
        return np.zeros(len(ends), bool)
    return others[np.minimum(at, len(others) - 1)] == ends


def merge_path(a: np.ndarray, b: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """Where the merge of two ascending lists (A first of equals) crosses every ``piece``-th diagonal.

    Neighbouring crossings delimit pieces of ``piece`` elements, give or take one: equal elements of the two
    lists stay together.
    """
    n, m = len(a), len(b)
    diagonal = np.append(np.arange(0, n + m, piece), n + m)
    low, high = np.maximum(0, diagonal - m), np.minimum(diagonal, n)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = np.zeros(len(diagonal), bool)
        first[open_] = a[middle[open_]] <= b[(diagonal - 1 - middle)[open_]]
        low, high = np.where(open_ & first, middle + 1, low), np.where(open_ & ~first, middle, high)
    i, j = low, diagonal - low
    split = (i > 0) & (j < m)
    split[split] = a[i[split] - 1] == b[j[split]]
    return list(zip(i.tolist(), (j + split).tolist(), strict=True))


_encoders: dict[int, Encoder] = {}


class Shared:
    """Both tokenisers as a broadcast, opened once per worker process."""

    def __init__(self, spark: SparkSession, tokenisers: Tokenisers):
        self.given = spark.sparkContext.broadcast(tokenisers)
        self.key = self.given._jbroadcast.id()

    def encoder(self) -> Encoder:
        if self.key not in _encoders:  # a worker process serves many tasks
            _encoders.clear()
            _encoders[self.key] = Encoder(self.given.value)
        return _encoders[self.key]


def _slices(batches: Iterator[pa.RecordBatch], encoder: Encoder):
    """Ids and aligned texts of every slice; the batches' columns are id and text."""
    for batch in batches:
        for begin, end in slices(batch.column(1), SLICE):
            part = batch.slice(begin, end - begin)
            yield part, encoder.slice(part.column(1))


def pair_counts(docs: DataFrame, shared: Shared, text: str = "text") -> DataFrame:
    """``(pair, n)``: how many links of all texts hold the pair; its key is A id << 20 | B id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, aligned in _slices(batches, shared.encoder()):
            links = [np.stack([aligned.keys(*link), aligned.times[aligned.owner[0][link[0]]]]) for link in aligned.links()]
            pairs, times = np.concatenate([np.zeros((2, 0), np.int64), *links], axis=1)
            keys, place = np.unique(pairs, return_inverse=True)
            more = np.zeros(len(keys), np.int64)
            np.add.at(more, place, times)
            held, n = _added(held, n, keys, more)
            if len(held) > HELD_LIMIT:
                yield pa.record_batch([held, n], ["pair", "n"])
                held, n = held[:0], n[:0]
        yield pa.record_batch([held, n], ["pair", "n"])

    rows = docs.select(F.lit(0).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _added(held: np.ndarray, n: np.ndarray, keys: np.ndarray, more: np.ndarray):
    """Two sorted lists of keys with counts as one."""
    at = np.searchsorted(held, keys)
    known = _equal(keys, held, at)
    n[at[known]] += more[known]
    fresh = ~known
    return np.insert(held, at[fresh], keys[fresh]), np.insert(n, at[fresh], more[fresh])


class Counts:
    """The counts of the most frequent pairs, and each B id's highest count."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray, best: np.ndarray):
        order = np.argsort(pairs)
        self.pairs, self.n, self.best = pairs[order], n[order], best


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    doc_id: str = "doc_id",
    text: str = "text",
    max_pairs: int = 4_000_000,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` per row of ``docs``.

    ``n_best``: links whose pair has the highest count of its B id; ``count_sum``: the pairs' counts over
    all links; ``groups``: the ids by group, as in ``a1,a2|b1;a3|b2,b3``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    tokenisers = Tokenisers(path_a, path_b)
    shared = Shared(spark, tokenisers)
    counts = materialize(pair_counts(docs, shared, text))
    top = counts.groupBy(F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("b")).agg(F.max("n").alias("n")).toArrow()
    best = np.zeros(len(tokenisers.raw_b), np.int64)
    best[top["b"].to_numpy()] = top["n"].to_numpy()
    held = most_frequent(counts, "n", max_pairs).toArrow()
    known = spark.sparkContext.broadcast(Counts(held["pair"].to_numpy(), held["n"].to_numpy(), best))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    if counts.count() > held.num_rows:
        least = int(held["n"].to_numpy().min(initial=2**62))
        rows = _with_rest(rows, counts.where(F.col("n") < least), shared, known, best)
    else:
        rows = rows.withColumns({"more_best": F.lit(0).cast("long"), "more_sum": F.lit(0).cast("long")})

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = known.value
        for part, aligned in _slices(batches, shared.encoder()):
            links, best_, sums = np.zeros((3, aligned.chunks), np.int64)
            for at_a, at_b in aligned.links():
                owner = aligned.owner[0][at_a]
                n = _looked_up(given, aligned.keys(at_a, at_b))
                links += np.bincount(owner, minlength=aligned.chunks)
                best_ += np.bincount(owner[n == given.best[aligned.ids[1][at_b]]], minlength=aligned.chunks)
                np.add.at(sums, owner, n)
            best_ = aligned.total(best_) + part.column(2).to_numpy(zero_copy_only=False)
            sums = aligned.total(sums) + part.column(3).to_numpy(zero_copy_only=False)
            numbers = [pa.array(x) for x in (*map(aligned.total, aligned.n), aligned.n_groups(), aligned.total(links), best_, sums)]
            yield pa.record_batch([part.column(0), *numbers, pa.array(aligned.groups(), pa.binary()).cast(pa.string())], names)

    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    schema = ", ".join([*[f"{name} long" for name in names[:-1]], "groups string"])
    made = rows.select("id", "text", "more_best", "more_sum").mapInArrow(make, schema)
    return made.withColumnRenamed("id", doc_id)


def _looked_up(counts: Counts, keys: np.ndarray) -> np.ndarray:
    """The pairs' counts; 0 for one that is not held."""
    different, place = np.unique(keys, return_inverse=True)
    at = np.searchsorted(counts.pairs, different)
    n = np.zeros(len(different), np.int64)
    known = _equal(different, counts.pairs, at)
    n[known] = counts.n[at[known]]
    return n[place]


def _with_rest(rows: DataFrame, rest: DataFrame, shared: Shared, known, best: np.ndarray) -> DataFrame:
    """Adds what the links of pairs that are not held come to: ``more_best`` and ``more_sum``.

    Equal rows have equal links, so rows are known by their id and their text's digest. Each pair asked for
    is rarer than all that are held, so no key of the join is hot.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = known.value
        for part, aligned in _slices(batches, shared.encoder()):
            asked = [np.zeros((2, 0), np.int64)]
            for at_a, at_b in aligned.links():
                keys = aligned.keys(at_a, at_b)
                rare = ~_equal(keys, given.pairs, np.searchsorted(given.pairs, keys))
                asked.append(np.stack([aligned.owner[0][at_a[rare]], keys[rare]]))
            (owner, keys), times = np.unique(np.concatenate(asked, axis=1), axis=1, return_counts=True)
            # from different chunks to the texts that hold them
            first, sizes = np.searchsorted(owner, aligned.chunk), np.bincount(owner, minlength=aligned.chunks)[aligned.chunk]
            at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
            text = np.repeat(np.repeat(np.arange(len(part)), np.diff(aligned.edges)), sizes)
            (text, pair), place = np.unique(np.stack([text, keys[at]]), axis=1, return_inverse=True)
            total = np.zeros(len(text), np.int64)
            np.add.at(total, place, times[at])
            columns = [part.column(k).take(pa.array(text)) for k in (0, 2)]
            yield pa.record_batch([*columns, pa.array(pair), pa.array(total)], ["id", "sha", "pair", "times"])

    keyed = rows.withColumn("sha", F.sha2("text", 256))
    asked = keyed.select("id", "text", "sha").mapInArrow(ask, "id long, sha string, pair long, times long")
    asked = asked.groupBy("id", "sha", "pair").agg(F.max("times").alias("times"))
    highest = rows.sparkSession.createDataFrame(pa.table({"b": np.arange(len(best)), "best": best}))
    own = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)) == F.col("b")
    found = asked.join(rest, "pair").join(F.broadcast(highest), own)
    sums = found.groupBy("id", "sha").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    k, s = keyed.alias("k"), sums.alias("s")
    same = F.col("k.id").eqNullSafe(F.col("s.id")) & (F.col("k.sha") == F.col("s.sha"))
    zero = F.lit(0).cast("long")
    return k.join(s, same, "left").select(
        "k.id", "k.text", F.coalesce("more_best", zero).alias("more_best"), F.coalesce("more_sum", zero).alias("more_sum")
    )
