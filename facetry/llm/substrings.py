"""Substring dedup by difference-cover anchors.

A window is a run of ``window`` words of one document. A word goes if a window that covers it
also starts in a document with a smaller id.

Anchors. A difference cover of period v is a set of residues in which every difference modulo v
occurs. Runs of window - v + 1 words are hashed only at places whose remainder modulo v is in the
cover. Two equal windows at any places i and j then share an aligned anchor: some d < v puts both
i + d and j + d into the cover, and the anchor at d lies inside the window. With period 31 that is
6 of 31 places.

1. Every anchor is counted over all documents. An anchor that occurs once goes back to its document,
   whatever a document does not get back is shared; nothing is sent to the members of a group, so a
   passage that a third of all documents hold costs no task more than any other.
2. Extending. Only documents with shared anchors go on. A shared anchor is extended to the windows around
   it (those that contain it); each such window is coded with 128 bits and gets the smallest id
   that has it, which is one aggregation with partial sums.
3. Each window goes back to the one document that owns it. A document's extended windows that it
   does not own start in a document with a smaller id: the words they cover go.

Documents whose words are all equal are recognised first: of a group only the smallest id is
searched; all others are covered entirely (or are shorter than a window and lose nothing).
Before texts are shuffled, a bit table of fixed size (``filter_bits``) lets pass only those that
hold shared anchors and a few others; it only saves work.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null or empty text has none. A document
shorter than a window loses nothing. A null id is no smaller and no larger than any: such a row
removes nothing and loses nothing. Rows of one id are one document to the others and each of them
is judged by itself; they do not count against each other. Windows repeated inside one document stay.
Windows are equal when their 96-bit codes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import attach, written
from facetry.llm.texts import Runs, Words, slices
from facetry.session import materialize, ship_package

# fixed values: perfect difference sets, by period
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (3, 6, 7, 12, 14),
    31: (1, 5, 11, 24, 25, 27),
}


class Anchors:
    """Where the anchors of documents lie, for windows of ``window`` words."""

    def __init__(self, window: int):
        self.window = window
        # an anchor keeps a third of the window or more, so that few anchors are shared by chance
        self.period = max(p for p in COVERS if 3 * p <= 2 * window + 1)
        self.length = window - self.period + 1
        self.covered = np.zeros(self.period, bool)
        self.covered[list(COVERS[self.period])] = True

    def places(self, words: Words) -> np.ndarray:
        """Places in ``words.flat`` where an anchor of a document with a window starts."""
        last = np.where(words.sizes >= self.window, words.sizes - self.length, -1)
        return np.flatnonzero(self.covered[words.place % self.period] & (words.place <= last[words.text]))

    def count(self, n: Column) -> Column:
        """How many anchors a document of ``n`` words has."""
        starts = n - self.length + 1
        whole = F.floor(starts / self.period)
        over = F.pmod(starts, F.lit(self.period))
        rest = sum((F.lit(r) < over).cast("long") for r in COVERS[self.period])
        return F.when(n >= self.window, whole * len(COVERS[self.period]) + rest).otherwise(F.lit(0))

    def windows(self, words: Words, shared: np.ndarray) -> np.ndarray:
        """Places where a window starts that contains one of the anchors at ``shared``."""
        steps = np.zeros(len(words.flat) + 1, np.int64)
        begin = words.starts[words.text[shared]]
        np.add.at(steps, np.maximum(shared - self.period + 1, begin), 1)
        np.add.at(steps, shared + 1, -1)
        near = np.cumsum(steps[:-1]) > 0
        return np.flatnonzero(near & (words.place <= (words.sizes - self.window)[words.text]))


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


NO_WORDS = _digest([])


def outline(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(id, n_words, sha)`` per row; the digest is that of the words joined by one space."""
    ship_package(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.split() cuts at exactly the blanks x20 and x09 to x0D
            cut = [(t.as_py() or "").encode("utf-8", "replace").split() for t in batch.column(1)]
            columns = [batch.column(0), pa.array([len(w) for w in cut], pa.int64()), pa.array(map(_digest, cut), pa.string())]
            yield pa.record_batch(columns, ["id", "n_words", "sha"])

    return _rows(docs, doc_id, text).mapInArrow(make, "id long, n_words long, sha string")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))


def _anchor_codes(rows: DataFrame, anchors: Anchors) -> DataFrame:
    """``(code, id)`` per anchor."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column(1)):
                words = Words(batch.column(1).slice(begin, end - begin))
                at = anchors.places(words)
                ids = batch.column(0).slice(begin, end - begin).take(pa.array(words.text[at]))
                yield pa.record_batch([pa.array(Runs(words).codes(at, anchors.length).view(np.int64)), ids], ["code", "id"])

    return rows.where("id IS NOT NULL").mapInArrow(make, "code long, id long")


def _touched_texts(found: DataFrame, anchors: Anchors) -> DataFrame:
    """``found``: (id, sha, text, lone); ``(id, sha, text, shared)`` with the places of the shared anchors."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                text, sha = one.column(2), one.column(1)[0].as_py()
                if _digest((text[0].as_py() or "").encode("utf-8", "replace").split()) != sha:
                    continue  # another row of the same id
                words = Words(text)
                at = anchors.places(words)
                lone = one.column(3).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                shared = at[~np.isin(Runs(words).codes(at, anchors.length), lone)]
                if len(shared):
                    places = pa.array([shared.astype(np.int32)], pa.list_(pa.int32()))
                    yield pa.record_batch([one.column(0), one.column(1), text, places], ["id", "sha", "text", "shared"])

    return found.select("id", "sha", "text", "lone").mapInArrow(make, "id long, sha string, text string, shared array<int>")


def _extended(batch: pa.RecordBatch, anchors: Anchors):
    """Per slice of a batch: its first row, its words, their runs and the windows around shared anchors."""
    for begin, end in slices(batch.column(0)):
        words = Words(batch.column(0).slice(begin, end - begin))
        marks = batch.column(1).slice(begin, end - begin)
        counts = marks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        shared = marks.flatten().to_numpy(zero_copy_only=False) + np.repeat(words.starts, counts)
        yield begin, words, Runs(words), anchors.windows(words, shared)


def _window_codes(touched: DataFrame, anchors: Anchors) -> DataFrame:
    """``(code, more, id)`` per extended window; the code has 64 bits, and more has 32."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, words, runs, at in _extended(batch, anchors):
                code = runs.codes(at, anchors.window).view(np.int64)
                more = (runs.codes(at, anchors.window, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                ids = batch.column(2).take(pa.array(words.text[at] + begin))
                yield pa.record_batch([pa.array(code), pa.array(more), ids], ["code", "more", "id"])

    return touched.select("text", "shared", "id").mapInArrow(make, "code long, more int, id long")


def _judged(owned: DataFrame, anchors: Anchors) -> DataFrame:
    """``owned``: (text, shared, id, sha, own); ``(id, sha, n_removed, kept_sha, kept)``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[], [], []]
            for begin, words, runs, at in _extended(batch, anchors):
                codes, row = runs.codes(at, anchors.window), words.text[at]
                steps = np.zeros(len(words.flat) + 1, np.int64)
                edges = np.searchsorted(row, np.arange(len(words.sizes) + 1))
                for i in range(len(words.sizes)):
                    mine = slice(edges[i], edges[i + 1])
                    own = batch.column(4)[begin + i].values
                    own = np.empty(0, np.uint64) if own is None else own.to_numpy(zero_copy_only=False).view(np.uint64)
                    gone = at[mine][~np.isin(codes[mine], own)]
                    np.add.at(steps, gone, 1)
                    np.add.at(steps, gone + anchors.window, -1)
                removed = np.cumsum(steps[:-1]) > 0
                for start, size in zip(words.starts, words.sizes, strict=True):
                    keep = ~removed[start : start + size]
                    kept = words.flat.slice(start, size).filter(pa.array(keep)).to_pylist()
                    columns[0].append(int(size - keep.sum()))
                    columns[1].append(hashlib.sha256(joined := " ".join(kept).encode("utf-8", "replace")).hexdigest())
                    columns[2].append(joined.decode("utf-8", "replace"))
            made = [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.record_batch([batch.column(2), batch.column(3), *made], ["id", "sha", "n_removed", "kept_sha", "kept"])

    schema = "id long, sha string, n_removed long, kept_sha string, kept string"
    return owned.select("text", "shared", "id", "sha", "own").mapInArrow(make, schema)


def _possible(rows: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """The ``rows`` whose id may be among the ``wanted`` ids, by a bit table of ``bits`` bits."""
    spot = F.pmod(F.xxhash64("id"), F.lit(bits))
    mark = F.expr("shiftleft(1L, cast(spot % 64 as int))")
    cells = wanted.select(spot.alias("spot")).groupBy(F.expr("spot div 64").alias("cell")).agg(F.bit_or(mark).alias("marks"))
    # at most bits / 64 rows, whatever the input's size
    seen = rows.withColumn("spot", spot).withColumn("cell", F.expr("spot div 64")).join(F.broadcast(cells), "cell")
    return seen.where(F.col("marks").bitwiseAND(mark) != 0).select(*rows.columns)


def repeated_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 50,
    filter_bits: int = 1 << 24,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` per row of ``docs``.

    ``kept`` holds the words left, joined by one space; null where nothing was removed.
    """
    ship_package(docs.sparkSession)
    anchors = Anchors(window)
    rows = _rows(docs, doc_id, text)
    base = materialize(outline(docs, doc_id, text))
    long_enough = F.col("id").isNotNull() & (F.col("n_words") >= window)
    equal = base.where(long_enough).groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    flagged = materialize(attach(base, materialize(equal.where("n > 1")), ["sha"], "n", base.count()))
    searched = flagged.where(long_enough & (F.coalesce("first", "id") == F.col("id"))).select("id", "sha", "n_words").distinct()

    # an anchor counted once goes back to its document
    counted = _anchor_codes(rows, anchors).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    lone = counted.where("n = 1").select("id", "code").repartition("id").groupBy("id").agg(F.collect_list("code").alias("lone"))
    suspects = materialize(
        searched.join(lone, "id", "left")
        .where(F.coalesce(F.size("lone"), F.lit(0)) < anchors.count(F.col("n_words")))
        .select("id", "sha", F.coalesce("lone", F.array().cast("array<long>")).alias("lone"))
    )
    texts = _possible(rows.where("id IS NOT NULL"), suspects, filter_bits)
    touched = written(_touched_texts(texts.join(suspects, "id"), anchors), "touched")

    owners = _window_codes(touched, anchors).groupBy("code", "more").agg(F.min("id").alias("id"))
    own = owners.select("id", "code").repartition("id").groupBy("id").agg(F.collect_list("code").alias("own"))
    judged = _judged(touched.join(own, "id", "left"), anchors).dropDuplicates(["id", "sha"])
    copy = long_enough & (F.col("first") < F.col("id"))
    return flagged.join(judged, ["id", "sha"], "left").select(
        F.col("id").alias(doc_id),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(NO_WORDS)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).when(F.col("n_removed") > 0, F.col("kept")).alias("kept"),
    )
