"""Multinomial naive Bayes per aspect over index sequences, for vocabularies of any size.

The model is one table: per index the logarithms of its chances in every (aspect, class), one count added.
Only indexes seen with a label have a row; row -1 holds the chance of any other index, row 0 the classes'
logarithms. Training and scoring read the same packed blocks of documents (``operators.blocks``): a block's
distinct indexes are counted or joined, one row each, and a document's score is the sum over its steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetry.operators import blocks
from facetry.operators.models import class_places, labelled, long_scores, softmax
from facetry.schema import CLASSES
from facetry.session import fits_broadcast, materialize

BLOCK_STEPS = 1 << 18
OTHER, PRIOR = -1, 0


def pack(seqs: DataFrame) -> DataFrame:
    """``seqs(id, seq)`` as blocks, written once for training and scoring."""
    return blocks.pack(seqs.select("id", F.col("seq").cast("array<int>").alias("seq")), "seq", most=BLOCK_STEPS)


def train(
    packed: DataFrame,
    labels: DataFrame,
    size: int,
    aspects: Sequence[int],
    columns: dict[int, str] | None = None,
    classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """``(idx, w)``, the model, from the documents of ``packed`` that ``labels(id, ..)`` knows.

    ``size`` is the vocabulary's; indexes outside 1 to ``size`` do not count.
    """
    cells = len(aspects) * len(classes)
    gold = labels.select("id", class_places(aspects, columns, classes).alias("y"))
    found = blocks.documents(packed, labels.schema["id"].dataType).join(gold, "id").select("block", "place", "y")
    found = materialize(found)

    def count(documents, rows, entries):
        codes = documents.column("codes")
        owner = np.repeat(np.arange(len(documents)), codes.value_lengths().to_numpy(zero_copy_only=False))
        code = codes.values.fill_null(-1).to_numpy(zero_copy_only=False)
        y = np.full((len(documents), len(aspects)), -1)
        if rows.num_rows:
            y[rows["place"].to_numpy()] = np.array(rows["y"].to_pylist(), int)
        n = np.zeros((len(entries), len(aspects), len(classes)), np.int64)
        for a in range(len(aspects)):
            known = (y[owner, a] >= 0) & (code >= 0)
            np.add.at(n, (code[known], a, y[owner[known], a]), 1)
        idx = entries.to_numpy(zero_copy_only=False).astype(np.int64)
        kept = np.flatnonzero((idx >= 1) & (idx <= size) & n.any(axis=(1, 2)))
        lists = pa.array(list(n[kept].reshape(len(kept), cells)), pa.list_(pa.int64()))
        return pa.table({"idx": idx[kept], "n": lists})

    part = blocks.meet(packed, found, count, "idx long, n array<long>", entries=True)
    counts = materialize(part.groupBy("idx").agg(F.array(*[F.sum(F.col("n")[k]) for k in range(cells)]).alias("n")))
    totals = counts.agg(*[F.coalesce(F.sum(F.col("n")[k]), F.lit(0)) for k in range(cells)]).first()
    docs = found.agg(*[F.count_if(F.col("y")[a] == c) for a in range(len(aspects)) for c in range(len(classes))]).first()
    below = np.log(np.array(totals, float) + size)
    seen = np.array(docs, float).reshape(len(aspects), len(classes))
    prior = np.log(seen + 1) - np.log(seen.sum(axis=1, keepdims=True) + len(classes))
    given = F.array(*[F.lit(float(x)) for x in below])
    logs = F.zip_with(F.col("n"), given, lambda n, b: F.log(n.cast("double") + 1) - b)
    fixed = packed.sparkSession.createDataFrame([(OTHER, (-below).tolist()), (PRIOR, prior.ravel().tolist())], "idx long, w array<double>")
    return counts.select("idx", logs.alias("w")).unionByName(fixed)


def score(
    packed: DataFrame,
    model: DataFrame,
    size: int,
    id_type: T.DataType,
    aspects: Sequence[int],
    classes: Sequence[int] = CLASSES,
    name: str = "model",
    small: bool | None = None,
) -> DataFrame:
    """``(id, aspect_idx, model, p, yhat)``; ``model`` is a kept table. ``small`` is measured unless given."""
    width = len(aspects) * len(classes)
    fixed = {r["idx"]: np.array(r["w"]) for r in model.where(F.col("idx") <= PRIOR).collect()}
    rest = model.where(F.col("idx") > PRIOR)
    schema = f"id {id_type.simpleString()}, aspect_idx int, p array<double>"

    def sums(documents, idx: np.ndarray, at: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        """``idx``: the distinct indexes, of which those at ``at`` have ``rows`` in the model."""
        valid = (idx >= 1) & (idx <= size)
        w = np.where(valid[:, None], fixed[OTHER], 0.0)
        w[at] = rows
        codes = documents.column("codes")
        code = codes.values.fill_null(-1).to_numpy(zero_copy_only=False)
        upto = np.vstack([w, np.zeros((1, width))])[code]
        edges = np.asarray(codes.offsets).astype(np.int64)
        total = np.zeros((len(documents), width))
        filled = np.flatnonzero(np.diff(edges))
        if len(filled):
            total[filled] = np.add.reduceat(upto, edges[filled])
        return long_scores(documents.column("id"), softmax(total + fixed[PRIOR], len(classes)), aspects)

    if fits_broadcast(rest, row_bytes=8 * width + 16) if small is None else small:
        table = rest.toArrow()
        order = np.argsort(table["idx"].to_numpy())
        w = np.array(table["w"].to_pylist(), float).reshape(-1, width)[order]
        shared = packed.sparkSession.sparkContext.broadcast((table["idx"].to_numpy()[order], w))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, w = shared.value
            for batch in batches:
                for data, listed in zip(batch.column(0), batch.column(1), strict=True):
                    idx = blocks.unpacked(listed).column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                    at = np.searchsorted(keys, idx)
                    at[at == len(keys)] = 0
                    hit = keys[at] == idx if len(keys) else np.zeros(len(idx), bool)
                    yield sums(blocks.unpacked(data), idx, np.flatnonzero(hit), w[at[hit]])

        return labelled(packed.select("data", "listed").mapInArrow(scan, schema), classes, name)

    listed = blocks.dictionaries(packed, "idx", T.IntegerType()).select("block", "code", F.col("idx").cast("long").alias("idx"))

    def work(documents, rows, entries):
        idx = entries.to_numpy(zero_copy_only=False).astype(np.int64)
        given = rows["w"].combine_chunks().flatten().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0)
        return pa.Table.from_batches([sums(documents, idx, rows["code"].to_numpy(), given.reshape(-1, width))])

    found = listed.join(rest, "idx").select("block", "code", "w")
    return labelled(blocks.meet(packed, found, work, schema, entries=True), classes, name)
