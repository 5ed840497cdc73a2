"""Toxicity: class-conditional Kneser-Ney models, compared by length-normalised log-likelihoods.

Two bigram models are learned, one from toxic and one from ordinary labelled texts. Each backs off from its
bigrams to what all documents, labelled or not, say about these bigrams, then to its own words, and from there to
one shared distribution: in how many different contexts a word occurs in both classes together. A rare expression is
thus mostly smoothed by counts that are the same for both classes and says little; an expression that is
frequent in one class says much. Each level has three discounts, for counts of 1, 2, and 3 or more.

A text is compared as a whole and by spans of the lengths in ``SPANS``: per word, how much likelier is it under the
toxic model? The likeliest span finds a few toxic words in a very long text; how many words reach each of ``LEVELS``
tells a text with several from one with a rare word that happens to stand in the toxic sample. A logistic function of
(best spans, log counts at the levels, whole text, log length), fitted on one labelled text in four, which the class
counts did not see, turns that into the score.

All labelled texts are learned from; no word and no bigram of them is dropped. The shared counts of their bigrams are made
over all documents. A word or bigram that no counted text has has the same chance in both classes but for constants that
the model holds, however frequent it is elsewhere; so the ratio of the two classes is whole with the counted texts'
tables alone. Up to ``local_chars`` characters of labelled texts these are broadcast: sorted 64-bit keys and 32-bit ratios, 12
bytes a bigram; counting is done by Spark's tasks, the driver turns the counts into ratios. With more labelled texts nothing
is broadcast or collected (``toxicity_chunks``). ``sample`` and ``max_chars`` bound the labelled texts, for callers that want that
(in a fixed pseudo-random order of the ids; a text with more than a 64th of ``max_chars`` is not learned from).

Words are known by 64-bit hashes (the chance that any two of a million meet is one in 10^7), bigrams by two word
numbers. Ratios are whole multiples of 2^-16, so sums do not depend on how texts are batched.

Defined cases: words are runs of letters, lower-cased. A text without words (null, empty) gets the score of a text
whose likelihoods are equal. Without labels of both classes every score is 0.5 and every prediction 1. Labels that
are null, and ids with both labels, are not learned from. Of the rows that repeat a labelled id, the smallest text is
learned from; all are counted for the shared counts, and all are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetry.llm.common import digest_order, written
from facetry.llm.texts import slices
from facetry.session import materialize, ship_package

if TYPE_CHECKING:
    from facetry.llm.toxicity_chunks import ChunkModel

SPANS = (1, 2, 6)
LEVELS = (1, 2, 3, 4)  # log-ratios that a word may reach
START = np.uint64(2)  # the key of what stands before a text's first word
UNIT = 1 << 16
NOT_LETTERS = r"\PL+"
BLOCK = 1 << 16  # shared counts that travel together
LOCAL_CHARS = 16_000_000  # of labelled texts, up to which their tables are broadcast
LOCAL_ROWS = 1_000_000
LANES = 256  # of tasks whose counts are added up before all are


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (the last is the intercept) by Newton's method."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(keep), z.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Keys:
    """The words of some texts as 64-bit keys, one text after the other, with the key before each."""

    def __init__(self, texts: pa.Array):
        import xxhash

        lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), pattern=NOT_LETTERS)
        parts = lists.flatten()
        full = pc.not_equal(parts, "")
        upto = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
        ends = upto[np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))]
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.sizes = ends - self.starts
        coded = parts.filter(full).dictionary_encode()
        each = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        self.words = each[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.uint64)

    def pairs(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number in the sorted ``held`` (-1: none), and the bigram that ends there (-1: none)."""
        asked, back = np.unique(self.words, return_inverse=True)
        at = places(held, asked)[back]
        before = np.concatenate([[-1], at[:-1]])[: len(at)]
        before[self.starts[self.sizes > 0]] = places(held, np.array([START]))[0]
        return at, np.where((at >= 0) & (before >= 0), before << 32 | at, -1)


def _text_slices(column: pa.Array) -> Iterator[tuple[int, Keys]]:
    for begin, end in slices(column):
        yield begin, Keys(column.slice(begin, end - begin))


def places(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in the sorted ``held``; -1 if it does not."""
    if not len(held) or not len(keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    return np.where(held[at] == keys, at, -1)


def _packed(numbers: np.ndarray) -> bytes:
    """Compressed byte by byte of the numbers: their high bytes are mostly equal."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(body: bytes, size: int, kind=np.int64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    found = np.empty((size, width), np.uint8)
    if size:
        found[:] = np.frombuffer(pa.decompress(body, size * width, "zstd"), np.uint8).reshape(width, -1).T
    return found.view(kind).ravel()


class Sent:
    """Numbers in a broadcast, packed: a broadcast lies on the disk of every executor and of the driver."""

    def __init__(self, spark: SparkSession, numbers: np.ndarray, ascending: bool = False):
        self.numbers, self.size, self.kind, self.ascending = numbers, len(numbers), numbers.dtype, ascending
        self.body = spark.sparkContext.broadcast(_packed(np.diff(numbers, prepend=numbers.dtype.type(0)) if ascending else numbers))

    def __getstate__(self):
        return self.__dict__ | {"numbers": None}

    def get(self) -> np.ndarray:
        if self.numbers is not None:
            return self.numbers
        found = _unpacked(self.body.value, self.size, self.kind)
        return np.cumsum(found, dtype=self.kind, out=found) if self.ascending else found


class Discounts:
    """What is taken off counts of 1, 2, and 3 or more, from the numbers of counts of 1 to 4."""

    def __init__(self, n1: float, n2: float, n3: float, n4: float):
        share = n1 / (n1 + 2 * n2) if n1 else 0.5
        more = [k - (k + 1) * share * b / a if a else k * 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        self.of = [min(max(d, 0.1 * k), 0.95 * k) for k, d in zip((1, 2, 3), more, strict=True)]

    @classmethod
    def of_counts(cls, n: np.ndarray) -> Discounts:
        return cls(*[float(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)])

    def __call__(self, n: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.of])[np.minimum(n, 3).astype(np.int64)]


class Model:
    """Sorted ``words`` and ``pairs``, with their ratios in units of 2^-16.

    ``own``: of a word by its own class chances; ``back``: of a word as what comes before; ``ratios``: of a bigram, whole;
    ``other``: of a word that is not held.
    """

    def __init__(self, words: Sent, pairs: Sent, own: Sent, back: Sent, ratios: Sent, other: int):
        self.sent, self.other = (words, pairs, own, back, ratios), other
        self.weights: np.ndarray | None = None
        self.unpack()

    def unpack(self) -> None:
        self.words, self.pairs, self.own, self.back, self.ratios = (part.get() for part in self.sent)

    def __getstate__(self):
        return {"sent": self.sent, "other": self.other, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.unpack()

    def ratio(self, keys: Keys) -> np.ndarray:
        """The log-ratio of each word after the word before it, in units."""
        at, pair = keys.pairs(self.words)
        own = np.where(at >= 0, self.own[at].astype(np.int64), self.other)
        lead = np.where(at >= 0, self.back[at].astype(np.int64), 0)
        before = np.concatenate([[0], lead[:-1]])[: len(lead)]
        before[keys.starts[keys.sizes > 0]] = self.back[places(self.words, np.array([START]))[0]]
        asked, back = np.unique(pair, return_inverse=True)
        found = places(self.pairs, asked)[back]
        if not len(self.ratios):  # the sample has no words
            return own + before
        return np.where(found >= 0, self.ratios[found].astype(np.int64), own + before)

    def features(self, keys: Keys) -> np.ndarray:
        return text_features(self.ratio(keys) if len(keys.words) else np.empty(0, np.int64), keys.starts, keys.sizes)

    def score(self, keys: Keys) -> np.ndarray:
        return sigmoid(self.features(keys), self.weights)


def text_features(ratio: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row per text: best spans, words at the levels, whole text, log length; zeros for a text without words."""
    made = np.zeros((len(sizes), len(SPANS) + len(LEVELS) + 2))
    some = np.flatnonzero(sizes)
    if not len(some):
        return made
    starts, sizes = starts[some], sizes[some]
    for i, level in enumerate(LEVELS):
        made[some, len(SPANS) + i] = np.log1p(np.add.reduceat((ratio >= level * UNIT).astype(np.int64), starts))
    sums = np.concatenate([[0], np.cumsum(ratio)])
    whole = sums[starts + sizes] - sums[starts]
    left = np.repeat(starts + sizes, sizes) - np.arange(len(sums) - 1)
    for i, span in enumerate(SPANS):
        run = np.full(len(sums) - 1, np.iinfo(np.int64).min)
        at = np.flatnonzero(left >= span)
        run[at] = sums[at + span] - sums[at]
        best = np.maximum.reduceat(run, starts)
        made[some, i] = np.where(sizes >= span, best / (span * UNIT), whole / (sizes * UNIT))
    made[some, -2] = whole / (sizes * UNIT)
    made[some, -1] = np.log1p(sizes)
    return made


def sigmoid(found: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    """The score of features; without weights that of the whole text's ratio."""
    if weights is None:
        return 1 / (1 + np.exp(-np.clip(found[:, -2], -30, 30)))
    total = np.full(len(found), weights[-1])
    for i, weight in enumerate(weights[:-1]):  # column by column: the same sum in any batch
        total = total + found[:, i] * weight
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _units(ratio: np.ndarray) -> np.ndarray:
    return np.rint(ratio * UNIT).astype(np.int32)


def labelled_sample(labels: DataFrame, doc_id: str, label: str, learn: Column, sample: int) -> DataFrame:
    """``(id, y)``: at most ``sample`` ids of each class, materialised.

    A hash of the id draws about twice as many, so that the exact choice sorts few rows however
    many labels there are.
    """
    return _drawn(_usable(labels, doc_id, label, learn), sample)


def _usable(labels: DataFrame, doc_id: str, label: str, learn: Column) -> DataFrame:
    return materialize(
        labels.where(learn & F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.min(label).alias("y"), F.max(label).alias("other"))
        .where("y = other")
        .select("id", F.col("y").cast("int").alias("y"))
    )


def _drawn(usable: DataFrame, sample: int) -> DataFrame:
    counts = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30))
    parts = [
        usable.where((F.col("y") == c) & (draw < (2 * sample + 64 << 30) // max(1, counts.get(c, 0))))
        .select("id", "y", digest_order("id").alias("place"))
        .orderBy("place", "id")
        .limit(sample)
        for c in (0, 1)
    ]
    return materialize(parts[0].unionByName(parts[1]).select("id", "y"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int | None = None,
    max_chars: int | None = None,
    local_chars: int = LOCAL_CHARS,
) -> Model | ChunkModel | None:
    """Fit on ``labels`` where ``learn`` holds (a condition on the id); None without both classes.

    All labelled texts are learned from, unless ``sample`` texts or ``max_chars`` characters per class are asked for.
    """
    usable = _usable(labels, doc_id, label, learn)
    if usable.select("y").distinct().count() < 2:
        return None
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    if sample is None and max_chars is None:
        # ids and lengths only; rows that repeat an id are counted too
        size = texts.select("id", F.length("text").alias("n")).join(usable, "id").agg(F.sum("n"), F.count(F.lit(1))).first()
        if (size[0] or 0) > local_chars or size[1] > LOCAL_ROWS:
            from facetry.llm.toxicity_chunks import ChunkModel

            return ChunkModel(_scored_texts(docs, doc_id, text), usable)
        rows = _one_text(texts, usable)
    else:
        chosen = usable if sample is None else _drawn(usable, sample)
        rows = _sampled_texts(texts, chosen, 1 << 62 if max_chars is None else max_chars)
    # one labelled text in four fits the score and is not counted
    fits = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    model = fit(rows.where(~fits).select("y", "text"), texts)
    held = _features(rows.where(fits).select("y", "text"), model)
    if len(held) and held["y"].nunique() == 2:
        x = np.array(held["x"].tolist())
        order = np.lexsort([*x.T, held["y"]])  # sums must not depend on the order of arrival
        model.weights = logistic(x[order], held["y"].to_numpy(float)[order])
    return model


def _scored_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))


def _one_text(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(id, y, text)``: the smallest text of each chosen id."""
    one = texts.where("text IS NOT NULL").join(chosen, "id")
    return written(one.groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text")), "learned")


def _sampled_texts(texts: DataFrame, chosen: DataFrame, max_chars: int) -> DataFrame:
    """``(id, y, text)``: one text per chosen id, as many per class as fit into ``max_chars``."""
    one = texts.join(F.broadcast(chosen), "id").where(F.length("text") <= max_chars // 64)
    one = written(one.groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text")), "sample")
    # at most the sample's rows, two classes: a small window
    upto = W.partitionBy("y").orderBy(digest_order("id"), "id").rowsBetween(W.unboundedPreceding, W.currentRow)
    sized = one.select("id", "y", F.length("text").alias("chars")).withColumn("upto", F.sum("chars").over(upto))
    kept = materialize(sized.where(F.col("upto") <= max_chars).select("id"))
    return one.join(F.broadcast(kept), "id")


def fit(counted: DataFrame, texts: DataFrame) -> Model:
    """The model of ``counted(y, text)``, a bounded sample, with shared counts over all ``texts(text)``."""
    spark = texts.sparkSession
    words = Sent(spark, _sample_words(counted), ascending=True)
    pairs, n0, n1 = _class_counts(counted, words)
    pairs = Sent(spark, pairs, ascending=True)
    return _ratios(spark, words, pairs, n0, n1, _shared_counts(texts, words, pairs))


def _sample_words(counted: DataFrame) -> np.ndarray:
    """The sorted keys of the sample's words and of what stands before a text."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, keys in _text_slices(batch.column(0)):
                yield pa.record_batch([pa.array(np.unique(keys.words).view(np.int64))], ["key"])

    found = counted.select("text").mapInArrow(distinct, "key long").distinct().toArrow()
    return np.unique(np.append(found["key"].to_numpy().view(np.uint64), START))


def _class_counts(counted: DataFrame, words: Sent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sample's bigrams, sorted, and how often each stands in ordinary and in toxic texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.get()
        for batch in batches:
            label = batch.column(0).to_numpy()
            for begin, keys in _text_slices(batch.column(1)):
                toxic = np.repeat(label[begin : begin + len(keys.sizes)] == 1, keys.sizes)
                pairs, group = np.unique(keys.pairs(known)[1], return_inverse=True)
                n0, n1 = (np.bincount(group[toxic == c], minlength=len(pairs)) for c in (False, True))
                yield pa.record_batch([pa.array(pairs), pa.array(n1 << 32 | n0)], ["pair", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's share of the bigrams in one row, sorted and with differences for keys."""
        found = pa.Table.from_batches(batches, pa.schema([("pair", pa.int64()), ("n", pa.int64())]))
        pairs, n = found["pair"].to_numpy(), found["n"].to_numpy()
        order = np.argsort(pairs)
        sizes = pa.array([len(pairs)])
        parts = [pa.array([_packed(x)], pa.binary()) for x in (np.diff(pairs[order], prepend=0), n[order])]
        yield pa.record_batch([sizes, *parts], ["size", "pairs", "n"])

    rows = counted.select("y", "text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = rows.mapInArrow(pack, "size long, pairs binary, n binary").toArrow().to_pylist()
    pairs = np.concatenate([np.empty(0, np.int64), *[np.cumsum(_unpacked(r["pairs"], r["size"])) for r in found]])
    n = np.concatenate([np.empty(0, np.int64), *[_unpacked(r["n"], r["size"]) for r in found]])
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    return pairs, (n & 0xFFFFFFFF).astype(np.int32), (n >> 32).astype(np.int32)


def _shared_counts(texts: DataFrame, words: Sent, pairs: Sent) -> np.ndarray:
    """How often each of the sample's bigrams stands in all texts.

    A task holds one counter per bigram and returns them in packed blocks; a block is added up first over
    lanes of tasks, then over all, so that no task meets more than its share of them.
    """
    size = -(-pairs.size // BLOCK) * BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, held = words.get(), pairs.get()
        n = np.zeros(size, np.int64)
        for batch in batches:
            for _, keys in _text_slices(batch.column(0)):
                asked, times = np.unique(keys.pairs(known)[1], return_counts=True)
                at = places(held, asked)
                n[at[at >= 0]] += times[at >= 0]
        lane = TaskContext.get().partitionId() % LANES
        for i, own in enumerate(n.reshape(-1, BLOCK)):
            if own.any():
                yield pa.record_batch([pa.array([i]), pa.array([lane]), pa.array([_packed(own)], pa.binary())], ["block", "lane", "n"])

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for body in table["n"]:
            total += _unpacked(body.as_py(), BLOCK)
        first = table.slice(0, 1)
        return pa.table({"block": first["block"], "lane": first["lane"], "n": pa.array([_packed(total)], pa.binary())})

    kind = "block long, lane long, n binary"
    blocks = texts.select("text").mapInArrow(count, kind)
    for keys in (["block", "lane"], ["block"]):
        blocks = blocks.groupBy(*keys).applyInArrow(added, kind)
    n = np.zeros(size, np.int64)
    for row in blocks.select("block", "n").toArrow().to_pylist():
        n[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = _unpacked(row["n"], BLOCK)
    return n[: pairs.size]


def _ratios(spark: SparkSession, words: Sent, pairs: Sent, n0: np.ndarray, n1: np.ndarray, n: np.ndarray) -> Model:
    """The class chances of every word and bigram of the sample, as ratios."""
    # word numbers and a bounded sample's counts: 32 bits do
    first, second = (x.astype(np.int32) for x in (pairs.numbers >> 32, pairs.numbers & 0xFFFFFFFF))
    levels = [n0, n1, n]
    off = [Discounts.of_counts(x) for x in levels]
    sums = lambda of, x: np.bincount(of, weights=x, minlength=words.size)
    # by word before: how often it leads, and what share of that the discounts leave to the next level
    leads, lost = [], []
    for x, cut in zip(levels, off, strict=True):
        lead = sums(first, x)
        kinds = [np.bincount(first[rows], minlength=words.size) for rows in (x == 1, x == 2, x > 2)]
        taken = sum(d * k for d, k in zip(cut.of, kinds, strict=True))
        leads.append(np.maximum(lead, 1))
        lost.append(np.where(lead > 0, taken / leads[-1], 1.0))
    contexts = np.bincount(second, minlength=words.size)
    shared = (contexts + 0.5) / (contexts.sum() + 0.5 * (words.size + 1))  # one more type: words not seen
    own, other = [], []
    for x in levels[:2]:
        single = sums(second, x)
        cut, total = Discounts.of_counts(single)(single), max(1.0, single.sum())
        left = cut.sum() / total if single.any() else 1.0  # a class without words has the shared chances
        own.append(np.maximum(single - cut, 0) / total + left * shared)
        other.append(left)
    ratios = np.empty(pairs.size, np.int32)
    for begin in range(0, pairs.size, 1 << 19):  # in pieces: the driver holds few numbers besides the tables
        part = slice(begin, begin + (1 << 19))
        v, w = first[part], second[part]
        seen = [np.maximum(x[part] - cut(x[part]), 0) / lead[v] for x, cut, lead in zip(levels, off, leads, strict=True)]
        p = [seen[c] + lost[c][v] * (seen[2] + lost[2][v] * own[c][w]) for c in (0, 1)]
        ratios[part] = _units(np.log(p[1] / p[0]))
    tables = [Sent(spark, x) for x in (_units(np.log(own[1] / own[0])), _units(np.log(lost[1] / lost[0])), ratios)]
    return Model(words, pairs, *tables, other=int(_units(np.log(other[1] / other[0]))))


def _features(rows: DataFrame, model: Model):
    """Features and labels of the sampled rows that fit the score; bounded by the sample."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [model.features(keys) for _, keys in _text_slices(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array([x.tolist() for part in made for x in part], pa.list_(pa.float64()))], ["y", "x"])

    return rows.select("y", "text").mapInArrow(make, "y int, x array<double>").toPandas()


def predict(docs: DataFrame, model: Model | ChunkModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` per row, from the text alone."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = _scored_texts(docs, doc_id, text)
    if model is not None and not isinstance(model, Model):
        return model.score(rows).withColumnRenamed("id", doc_id)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                made = np.full(batch.num_rows, 0.5)
            else:
                made = np.concatenate([np.empty(0), *[model.score(keys) for _, keys in _text_slices(batch.column(1))]])
            yield pa.record_batch(
                [batch.column(0), pa.array(made), pa.array((made >= 0.5).astype(np.int32))], ["id", "score", "predicted"]
            )

    return rows.mapInArrow(score, "id long, score double, predicted int").withColumnRenamed("id", doc_id)
