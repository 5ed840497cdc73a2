"""SentencePiece encoding and decoding by suffix-array matching.

For a BPE model with byte fallback and identity normalisation; the pieces and their scores
come from a model file given by path, nothing is trained here.

A batch's texts are cut at blanks (a blank becomes the mark U+2581 at the start of the next
word, and no piece holds a mark after another character, so no piece crosses a cut). The distinct
words that are not in the worker's cache are concatenated and indexed by a suffix array:
positions sorted by more of their next characters than the longest piece has. Every piece whose
characters occur is binary-searched for its range of occurrences, all pieces in step. Each
occurrence is an edge (start, end, piece); the edges are sorted by their end.

Relaxing. The pieces of a BPE encoding are not those with the best sum of scores, so the edges are
relaxed by compatibility: a prefix of a word has one BPE encoding, and its last piece t is the
one edge whose predecessor p (the last piece of the prefix before t) keeps the border: encoding p and t
together would not merge across it. Whether a border is kept follows from undoing the merges of
p and t in reverse order. Edges are taken in order of their end, longest first, each end once.
The result equals the merge procedure's (tested against the public library and against
plain merging). Runs of marks are pieces of one common score and merge last; they are merged by the plain
procedure, once per length.

Decoding joins the pieces' bytes, turns marks into blanks and drops the leading one.

Defined cases: null gives null ids and null text, an empty text no ids. A character without piece
becomes its UTF-8 bytes' pieces. The mark U+2581 in a text reads back as a blank, as in the public
library. Ids outside the vocabulary are an error; bytes that are no UTF-8 decode to U+FFFD; control pieces decode to nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.session import ship_package

MARK = "▁"
KEY_BITS = 63  # of a packed key of characters
PLACES = 20  # bits of the table of borders that were asked for
SLICE_CHARS, INDEX_CHARS = 2_000_000, 400_000  # of texts handled together, of words in one index
LONG_WORD = 256  # words beyond this are relaxed on their own


class Vocabulary:
    """Pieces of a model file, as plain lists, so that it can be broadcast."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto.FromString(file.serialized_model_proto())
        trainer, norm = spec.trainer_spec, spec.normalizer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback:
            raise ValueError("only BPE models with byte fallback")
        if norm.name != "identity" or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only identity normalisation with a leading blank")
        ids = range(file.get_piece_size())
        self.bytes = {int(file.id_to_piece(i)[3:5], 16): i for i in ids if file.is_byte(i)}
        self.plain = {
            file.id_to_piece(i): i for i in ids if not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i))
        }
        self.score = [file.get_score(i) for i in ids]
        if any(MARK in p.lstrip(MARK) for p in self.plain):
            raise ValueError("a piece holds a mark inside")
        self.raw = [b""] * len(ids)
        for byte, i in self.bytes.items():
            self.raw[i] = bytes([byte])
        for piece, i in self.plain.items():
            self.raw[i] = piece.replace(MARK, " ").encode()


def merge(symbols: Sequence[str], vocabulary: Vocabulary) -> list[str]:
    """Plain BPE: merge the neighbours with the best score, the leftmost first, until none is left."""
    part: list[str | None] = list(symbols)
    left, right = list(range(-1, len(part) - 1)), [*range(1, len(part)), -1]
    queue: list[tuple[float, int, int, str]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (at := vocabulary.plain.get(whole := part[i] + part[j])) is not None:
            heapq.heappush(queue, (-vocabulary.score[at], i, j, whole))

    for i in range(len(part) - 1):
        offer(i, i + 1)
    while queue:
        _, i, j, whole = heapq.heappop(queue)
        if part[i] is None or part[j] is None or right[i] != j or part[i] + part[j] != whole:
            continue
        part[i], part[j] = whole, None
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        offer(left[i], i)
        offer(i, right[i])
    return [p for p in part if p is not None]


def _ranges(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cut items, whose running sizes are ``ends``, into ranges of about ``size`` (one item at least)."""
    begin = 0
    while begin < len(ends):
        upto = (ends[begin - 1] if begin else 0) + size
        end = max(begin + 1, int(np.searchsorted(ends, upto, side="right")))
        yield begin, end
        begin = end


class Encoder:
    """Encodes batches of texts; keeps a bounded cache of words and of borders."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = 400_000):
        self.vocabulary, self.cache_words = vocabulary, cache_words
        self.words: dict[str, bytes] = {}
        self.runs: dict[int, bytes] = {}
        self.asked, self.answers = np.full(1 << PLACES, -1), np.zeros(1 << PLACES, bool)
        plain, score = vocabulary.plain, vocabulary.score
        self.mark = plain.get(MARK)
        alphabet = sorted({c for p in plain for c in p})
        self.code = np.zeros(0x110000, np.uint16)  # 0: a cut or a character without piece
        self.code[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        # the last merge that makes each piece; pieces that merging never makes are no edges
        n = len(score)
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        long = sorted((i for p, i in plain.items() if len(p) > 1 and set(p) != {MARK}), key=lambda i: -score[i])
        for place, i in enumerate(long):
            # equal scores are equal ranks
            self.rank[i] = self.rank[long[place - 1]] if place and score[long[place - 1]] == score[i] else place
        usable, joins = [], {}
        for piece, i in plain.items():
            if len(piece) == 1:
                usable.append((piece, i))
            elif set(piece) != {MARK}:
                cut = self._last_merge(piece)
                if cut:
                    self.left[i], self.right[i] = plain[piece[:cut]], plain[piece[cut:]]
                    usable.append((piece, i))
                for k in range(1, len(piece)):
                    if piece[:k] in plain and piece[k:] in plain:
                        joins[plain[piece[:k]] << 20 | plain[piece[k:]]] = self.rank[i]
        self.joins = np.array(sorted(joins), np.int64)
        self.join_ranks = np.array([joins[k] for k in self.joins.tolist()], np.int64)
        self.pieces = np.array([i for _, i in usable], np.int64)
        self.lengths = np.array([len(p) for p, _ in usable], np.int64)
        self.longest = int(self.lengths.max())
        self.coded = np.zeros((len(usable), self.longest), np.uint16)
        for row, (piece, _) in zip(self.coded, usable, strict=True):
            row[: len(piece)] = self.code[[ord(c) for c in piece]]

    def _last_merge(self, piece: str) -> int:
        """Where the last merge of ``piece`` joins its halves; 0 if merging does not end in it."""
        plain, score = self.vocabulary.plain, self.vocabulary.score
        parts = list(piece)
        while len(parts) > 2:
            offers = [
                (-score[at], i) for i in range(len(parts) - 1) if (at := plain.get(parts[i] + parts[i + 1])) is not None
            ]
            if not offers:
                return 0
            i = min(offers)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return len(parts[0])

    def _search(self, wanted: np.ndarray, order: np.ndarray, keys: np.ndarray, width: int, after: bool) -> np.ndarray:
        """For every piece the first suffix that is not below (``after``: that is above) its keys."""
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            place = order[middle]
            below, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
            for i in range(wanted.shape[1]):
                mine, theirs = keys[place + width * i], wanted[open_, i]
                below |= equal & (mine < theirs)
                equal &= mine == theirs
            if after:
                below |= equal
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
        return low

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all occurrences, by end, the longest first."""
        size = len(codes)
        # only characters that occur get a number, so that many fit into one key
        present = np.bincount(codes, minlength=int(self.code.max()) + 1) > 0
        present[0] = True
        dense = (np.cumsum(present) - 1).astype(np.int64)
        bits = max(1, int(dense[-1]).bit_length())
        width = min(KEY_BITS // bits, self.longest)
        n_keys = -(-self.longest // width)
        possible = np.flatnonzero(present[self.coded].all(axis=1))
        if not size or not possible.size:
            return (np.empty(0, np.int64),) * 3
        # the key of a place holds its next ``width`` characters; behind the end there is nothing
        padded = np.concatenate([dense[codes], np.zeros(width * (n_keys + 1), np.int64)])
        keys = np.zeros(size + width * n_keys, np.int64)
        for i in range(width):
            keys = keys << bits | padded[i : i + len(keys)]
        # sort by one key, then by pairs of ranks, until all characters of a piece are covered
        rank, covered = keys, width
        while covered < self.longest:
            rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
            following = np.zeros_like(rank)
            following[:-covered] = rank[covered:] + 1
            rank = rank * (len(rank) + 2) + following
            covered *= 2
        order = np.argsort(rank[:size])
        low = np.zeros((len(possible), width * n_keys), np.int64)
        low[:, : self.longest] = dense[self.coded[possible]]
        beyond = np.arange(width * n_keys)[None, :] >= self.lengths[possible][:, None]
        high = np.where(beyond, (1 << bits) - 1, low)
        low[beyond] = 0
        shift = bits * np.arange(width - 1, -1, -1)
        pack = lambda x: (x.reshape(len(x), n_keys, width) << shift).sum(axis=2)
        first = self._search(pack(low), order, keys, width, after=False)
        last = self._search(pack(high), order, keys, width, after=True)
        counts = np.maximum(last - first, 0)
        hit = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(hit)) - np.repeat(np.cumsum(counts) - counts, counts)
        length = self.lengths[possible][hit]
        end = order[first[hit] + within] + length
        # sorted as one number: the end, then the longest first, and the piece
        packed = np.sort(((end << 6 | 63 - length) << 20) | self.pieces[possible][hit])
        end, length = packed >> 26, 63 - (packed >> 20 & 63)
        return end - length, end, packed & 0xFFFFF

    def keep_borders(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether merging p's and t's characters together leaves the border between them, for many pairs.

        The merges of both are undone, the later one first. If the two pieces that then stand at the
        border would have been merged before the merge just undone, the border is not kept. Of merges of
        equal rank the left one was done first: a crossing pair loses to p's and beats t's.
        """
        p, t = p.copy(), t.copy()
        kept = np.ones(len(p), bool)
        limit = np.full(len(p), np.iinfo(np.int64).max)
        todo = np.arange(len(p))
        while todo.size:
            pair = p[todo] << 20 | t[todo]
            place = np.minimum(np.searchsorted(self.joins, pair), len(self.joins) - 1)
            crossed = (self.joins[place] == pair) & (self.join_ranks[place] < limit[todo])
            kept[todo[crossed]] = False
            todo = todo[~crossed]
            rank_p, rank_t = self.rank[p[todo]], self.rank[t[todo]]
            undo_p = rank_p > rank_t
            some = todo[undo_p]
            limit[some], p[some] = rank_p[undo_p], self.right[p[some]]
            undo_t = ~undo_p & (self.left[t[todo]] >= 0)
            some = todo[undo_t]
            limit[some], t[some] = rank_t[undo_t] + 1, self.left[t[some]]
            todo = todo[undo_p | undo_t]
        return kept

    def borders(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        """``keeps_border`` of many pairs; answers are kept in a table with one place per hash."""
        pair = (p << 20) | t
        place = ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PLACES)).astype(np.int64)
        answer = self.answers[place]
        new = np.flatnonzero(self.asked[place] != pair)
        if new.size:
            listed, first, back = np.unique(pair[new], return_index=True, return_inverse=True)
            made = self.keep_borders(listed >> 20, listed & 0xFFFFF)
            answer[new] = made[back]
            self.asked[place[new[first]]], self.answers[place[new[first]]] = listed, made
        return answer

    def _relax(self, first: np.ndarray, begins: np.ndarray, sizes: np.ndarray, edges, unknown, last, origin) -> None:
        """Set the last piece and its begin for every prefix, all words in step (longest word first)."""
        start, piece = edges
        for depth in range(1, int(sizes.max(initial=0)) + 1):
            begin = begins[: np.searchsorted(-sizes, -depth, side="right")]
            at = begin + depth
            edge, stop = first[at], first[at + 1]
            todo = np.flatnonzero(edge < stop)
            while todo.size:
                s, t = start[edge[todo]], piece[edge[todo]]
                p = last[s]
                fine = (s == begin[todo]) | ((origin[s] >= 0) & (p < 0))
                ask = np.flatnonzero(~fine & (origin[s] >= 0))
                fine[ask] = self.borders(p[ask], t[ask])
                done = at[todo[fine]]
                origin[done], last[done] = s[fine], t[fine]
                todo = todo[~fine]
                edge[todo] += 1
                todo = todo[edge[todo] < stop[todo]]
            bare = at[(origin[at] < 0) & unknown[at - 1]]
            origin[bare] = bare - 1

    def _relax_long(self, first: np.ndarray, begin: int, size: int, edges, unknown, last, origin) -> None:
        """The same for one word, place by place."""
        start, piece = edges
        for at in range(begin + 1, begin + size + 1):
            for e in range(first[at], first[at + 1]):
                s, t = int(start[e]), int(piece[e])
                p = int(last[s])
                if s == begin or (origin[s] >= 0 and (p < 0 or self.borders(np.array([p]), np.array([t]))[0])):
                    origin[at], last[at] = s, t
                    break
            else:
                if unknown[at - 1]:
                    origin[at] = at - 1

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (32-bit, as bytes) of each mark + word, all indexed together."""
        text = "\n".join(MARK + w for w in words) + "\n"
        codes = self.code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        codes[begins + sizes] = 0
        start, end, piece = self.edges(codes)
        first = np.searchsorted(end, np.arange(len(codes) + 2))
        last, origin = np.full(len(codes) + 1, -1), np.full(len(codes) + 1, -1)
        unknown = codes == 0
        unknown[begins + sizes] = False
        by_size = np.argsort(-sizes, kind="stable")
        by_size = by_size[sizes[by_size] <= LONG_WORD]
        rest = ((start, piece), unknown, last, origin)
        self._relax(first, begins[by_size], sizes[by_size], *rest)
        for i in np.flatnonzero(sizes > LONG_WORD):
            self._relax_long(first, int(begins[i]), int(sizes[i]), *rest)
        # follow the pieces back from the words' ends, all words in step
        at, own, tokens = begins + sizes, np.arange(len(words)), []
        while own.size:
            tokens.append((own, at, np.where(last[at] >= 0, last[at], -1)))
            at = origin[at]
            more = at > begins[own]
            own, at = own[more], at[more]
        own, at, ids = (np.concatenate(x) for x in zip(*tokens, strict=True))
        order = np.argsort(at, kind="stable")
        own, at, ids = own[order], at[order], ids[order]
        # characters without piece become their bytes' pieces
        bare = np.flatnonzero(ids < 0)
        spelt = [[self.vocabulary.bytes[b] for b in text[i].encode("utf-8", "replace")] for i in (at[bare] - 1).tolist()]
        counts = np.ones(len(ids), np.int64)
        counts[bare] = [len(x) for x in spelt]
        ids = np.repeat(ids, counts)
        ids[ids < 0] = [i for x in spelt for i in x]
        ends = np.cumsum(np.bincount(own, counts, len(words))).astype(np.int64) * 4
        data = ids.astype("<i4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]

    def run(self, n: int) -> bytes:
        """Ids of ``n`` marks in a row."""
        if n not in self.runs:
            made = np.array([self.vocabulary.plain[p] for p in merge([MARK] * n, self.vocabulary)], "<i4").tobytes()
            if len(self.runs) >= 4096:
                self.runs.clear()
            self.runs[n] = made
        return self.runs[n]

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text (32-bit, as bytes); the texts' words are indexed together."""
        cut = [None if t is None else t.replace(MARK, " ").split(" ") for t in texts]
        every = set().union(*[parts for parts in cut if parts])
        every.discard("")
        new = every - self.words.keys()
        if len(self.words) + len(new) > self.cache_words:
            self.words.clear()
            new = every
        listed = list(new)
        sizes = np.cumsum([len(w) + 2 for w in listed])
        for begin, end in _ranges(sizes, INDEX_CHARS):
            part = listed[begin:end]
            self.words.update(zip(part, self.encode_words(part), strict=True))
        get = self.words.__getitem__
        out: list[bytes | None] = []
        lone = np.array([self.mark], "<i4").tobytes()
        for text, parts in zip(texts, cut, strict=True):
            if parts is None:
                out.append(None)
            elif not text:
                out.append(b"")
            elif "" not in parts:
                out.append(b"".join(map(get, parts)))
            else:
                made, marks = [], 0
                for word in parts:
                    marks += 1
                    if word:
                        ids = get(word)
                        # the word's own mark is part of its first piece, or stays in the run
                        alone = ids[:4] == lone
                        made.append(self.run(marks) if alone else self.run(marks - 1) if marks > 1 else b"")
                        made.append(ids[4:] if alone else ids)
                        marks = 0
                made.append(self.run(marks) if marks else b"")
                out.append(b"".join(made))
        return out


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.sizes = np.array([len(r) for r in vocabulary.raw], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(vocabulary.raw), np.uint8)

    def decode(self, ids: Sequence[int] | None) -> str | None:
        if ids is None:
            return None
        ids = np.asarray(ids, np.int64)
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.sizes):
            raise ValueError("an id outside the vocabulary")
        sizes = self.sizes[ids]
        shift = self.begins[ids] - (np.cumsum(sizes) - sizes)
        data = self.data[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", check: bool = False) -> DataFrame:
    """``(doc_id, n_ids, ids)`` per row; with ``check`` also ``round_trip``: decoding gives the text back."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(model_path))
    key = shared._jbroadcast.id()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _encoders:  # a worker process serves many tasks
            _encoders.clear()
            _encoders[key] = Encoder(shared.value)
        encoder, decoder = _encoders[key], Decoder(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in _ranges(np.cumsum([len(t or "") for t in texts]), SLICE_CHARS):
                made = encoder.encode(texts[begin:end])
                sizes = np.array([len(m or b"") // 4 for m in made], np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                none = pa.array([m is None for m in made])
                values = pa.array(np.frombuffer(b"".join(m or b"" for m in made), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(offsets), values, mask=none)
                columns = [batch.column(0).slice(begin, end - begin), pa.array(sizes), ids]
                names = ["id", "n_ids", "ids"]
                if check:
                    same = [
                        m is None or decoder.decode(np.frombuffer(m, "<i4")) == t.replace(MARK, " ")
                        for m, t in zip(made, texts[begin:end], strict=True)
                    ]
                    columns.append(pa.array(same))
                    names.append("round_trip")
                yield pa.record_batch(columns, names)

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n_ids int, ids array<int>" + (", round_trip boolean" if check else "")
    return rows.mapInArrow(work, schema).withColumnRenamed("id", doc_id)


def decode(rows: DataFrame, model_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, text)`` per row."""
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(model_path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            made = [decoder.decode(x.as_py()) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(made, pa.string())], ["id", "text"])

    some = rows.select(F.col(doc_id).cast("long").alias("id"), F.col(ids).alias("ids"))
    return some.mapInArrow(work, "id long, text string").withColumnRenamed("id", doc_id)
