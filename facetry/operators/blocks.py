"""Blocks of documents: joining lists with a large table without a row per list entry.

A task packs whole documents into blocks of a bounded number of entries. A block holds its documents'
ids and lists, coded by a dictionary of its own, as one compressed Arrow batch. Only the
dictionaries' entries are joined with the large table, so a value that is in every document is one row per
block and no key is hot. What the join finds for a block then meets the packed block in one task.
Documents are never taken apart, and lists are neither sorted nor collected again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetry.session import materialize, ship_package

BLOCK_ENTRIES = 1 << 21  # list entries of one block, or one document


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: pa.BinaryScalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(data.as_buffer()).read_next_batch()


def ranges(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` entries, or one row; ``ends`` are the rows' running sums."""
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield begin, end
        begin = end


def pack(docs: DataFrame, entries: str, *carry: str, most: int = BLOCK_ENTRIES) -> DataFrame:
    """``(block, data, listed)`` of ``docs(id, <entries>, <carry>)``, written once.

    ``listed`` holds the block's distinct entries, ``data`` its documents: id, list as places among the
    distinct entries (null for a null entry) and carried columns. A null list is an empty one.
    """
    ship_package(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            for begin, end in ranges(ends, most):
                before = ends[begin - 1] if begin else 0
                part = batch.slice(begin, end - begin)
                coded = part.column(1).flatten().dictionary_encode()
                offsets = np.concatenate([[0], ends[begin:end] - before]).astype(np.int32)
                codes = pa.ListArray.from_arrays(pa.array(offsets), coded.indices.cast(pa.int32()))
                data = pa.record_batch([part.column(0), codes, *part.columns[2:]], ["id", "codes", *carry])
                listed = pa.record_batch([coded.dictionary], ["value"])
                yield pa.record_batch([[packed(data)], [packed(listed)]], schema=out)

    out = pa.schema([("data", pa.binary()), ("listed", pa.binary())])
    rows = docs.select("id", entries, *carry).mapInArrow(make, "data binary, listed binary")
    # writing the blocks fixes their numbers
    return materialize(rows.withColumn("block", F.monotonically_increasing_id()))


def dictionaries(blocks: DataFrame, name: str, kind: T.DataType) -> DataFrame:
    """``(block, code, <name>)``: one row per block and distinct entry."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, listed in zip(batch.column(0), batch.column(1), strict=True):
                values = unpacked(listed).column(0)
                columns = [pa.repeat(block, len(values)), pa.array(np.arange(len(values), dtype=np.int32)), values]
                yield pa.record_batch(columns, ["block", "code", name])

    return blocks.select("block", "listed").mapInArrow(make, f"block long, code int, `{name}` {kind.simpleString()}")


def documents(blocks: DataFrame, kind: T.DataType) -> DataFrame:
    """``(block, place, id)``: one row per document; ``place`` is its row within the block."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0), batch.column(1), strict=True):
                ids = unpacked(data).column("id")
                yield pa.record_batch([pa.repeat(block, len(ids)), pa.array(np.arange(len(ids), dtype=np.int32)), ids], ["block", "place", "id"])

    return blocks.select("block", "data").mapInArrow(make, f"block long, place int, id {kind.simpleString()}")


def meet(
    blocks: DataFrame,
    found: DataFrame,
    work: Callable[..., pa.Table],
    schema: str,
    entries: bool = False,
) -> DataFrame:
    """``work`` on the documents of each block and the rows of ``found(block, ..)`` that belong to it.

    With ``entries`` the block's distinct entries are its third argument.
    """

    def both(block: pa.Table, rows: pa.Table) -> pa.Table:
        more = [unpacked(block["listed"][0]).column(0)] if entries else []
        return work(unpacked(block["data"][0]), rows, *more)

    columns = ["block", "data", *(["listed"] if entries else [])]
    return blocks.select(*columns).groupBy("block").cogroup(found.groupBy("block")).applyInArrow(both, schema)
