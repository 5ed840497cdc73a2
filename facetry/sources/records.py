"""The records of large CSV files, read by many tasks per file.

A line break inside quotes belongs to a cell, so whether a line ends a record depends on all quotes before
it. One pass counts the quotes of each split; running sums of these counts tell which splits begin inside
quotes, and then every task cuts its own split at true record ends. What a split's borders tear apart is
put together again by a third, short pass over the splits concerned.

The driver and the tasks are told one 64-bit number per split that begins inside quotes; that is at most
8 bytes per ``spark.sql.files.maxPartitionBytes`` of input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetry.session import ship_package

QUOTE = '"'
WHOLE, GOES_ON, OPENED = 0, 1, 2  # a record; a piece of one begun in an earlier split; the begin of one
CUT_SCHEMA = "record string, path string, start long, part int, first boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its split. Only LF ends a line here, so a CR stays in its cell."""
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    return spark.read.text(path, lineSep="\n").select("value", *place).withColumn("split", F.xxhash64("path", "start"))


def split_quotes(spark: SparkSession, path: str) -> DataFrame:
    """``(path, start, split, quotes, inside)``: a row per split; ``inside``: it begins inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counts = _lines(spark, path).groupBy("path", "start", "split").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


class _Cutter:
    """Cuts the lines of one split after the other; rows are gathered per batch."""

    def __init__(self, inside: frozenset[int]):
        self.inside_at = inside
        self.split: int | None = None
        self.rows: list[tuple] = []

    def begin(self, split: int, path: str, start: int) -> None:
        self.end()
        self.split, self.path, self.start = split, path, start
        self.open = self.from_before = split in self.inside_at
        self.first = start == 0
        self.pieces: list[str] = []

    def end(self) -> None:
        """The split's last record is still open: another split holds its end."""
        if self.split is not None and self.open:
            self._torn("\n".join(self.pieces))
        self.split = None

    def _torn(self, text: str) -> None:
        part = GOES_ON if self.from_before else OPENED
        self.rows.append((text, self.path, self.start, part, self.first and not self.from_before))

    def _first_end(self, text: str) -> None:
        """A record that began before this batch, or that is the first of its file."""
        if self.from_before:
            self._torn(text)
        else:
            self.rows.append((text, None, None, WHOLE, self.first))
            self.first = False
        self.from_before, self.pieces = False, []

    def cut(self, values: pa.Array) -> pa.Array:
        """The whole records among ``values``; those that need more than their text go to ``rows``."""
        odd = np.cumsum(pc.count_substring(values, QUOTE).to_numpy(zero_copy_only=False)) + self.open
        ends = np.flatnonzero(odd % 2 == 0) + 1
        done = int(ends[-1]) if len(ends) else 0
        if len(ends) and (self.open or self.first):
            self._first_end("\n".join([*self.pieces, *values[: ends[0]].to_pylist()]))
            at, ends = int(ends[0]), ends[1:]
        else:
            at = 0
        offsets = pa.array(np.concatenate([[0], ends - at]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, values[at:done])
        rest = values[done:].to_pylist()
        self.pieces.extend(rest)
        self.open = bool(self.pieces) or self.from_before
        return pc.binary_join(lists, "\n")


def _cut(lines: DataFrame, inside: frozenset[int]) -> DataFrame:
    """``lines`` of whole splits, in their order, as records and torn pieces."""
    ship_package(lines.sparkSession)
    shared = lines.sparkSession.sparkContext.broadcast(inside)
    types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_()]
    names = [c.split()[0] for c in CUT_SCHEMA.split(", ")]

    def taken(cutter: _Cutter) -> pa.RecordBatch:
        columns = list(zip(*cutter.rows, strict=True)) or [()] * len(types)
        cutter.rows = []
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(shared.value)
        for batch in batches:
            values, paths, starts, splits = (batch.column(name) for name in ("value", "path", "start", "split"))
            keys = splits.to_numpy()
            borders = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for begin, end in zip(borders, borders[1:]):
                if begin == end:
                    continue
                if cutter.split != int(keys[begin]):
                    cutter.begin(int(keys[begin]), paths[begin].as_py(), starts[begin].as_py())
                whole = cutter.cut(values[begin:end])
                if cutter.rows:  # a file's header before its rows, so that a wrong one is told first
                    yield taken(cutter)
                if len(whole):
                    nulls = [pa.nulls(len(whole), t) for t in types[1:3]]
                    flags = [pa.array(np.zeros(len(whole), np.int32)), pa.array(np.zeros(len(whole), bool))]
                    yield pa.record_batch([whole, *nulls, *flags], names)
        cutter.end()
        if cutter.rows:
            yield taken(cutter)

    return lines.mapInArrow(run, CUT_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(record, first)``: the text of every record, without its line end; ``first`` of a file.

    Empty lines between records are left out. A file whose quotes do not close is an error. Records end
    with LF or CR LF.
    """
    splits = split_quotes(spark, path)
    unclosed = splits.groupBy("path").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").select("path").first()
    if unclosed:
        raise ValueError(f"{unclosed['path']} ends inside quotes")
    torn = [r["split"] for r in splits.where("inside").select("split").collect()]
    lines, inside = _lines(spark, path), frozenset(torn)
    made = _cut(lines, inside).where(F.col("part") == WHOLE).select("record", "first")
    if torn:
        # the splits that begin inside quotes, and those before them
        after = F.lead("inside").over(Window.partitionBy("path").orderBy("start"))
        concerned = splits.withColumn("after", after).where("inside OR after").select("split")
        pieces = _cut(lines.join(F.broadcast(concerned), "split", "left_semi"), inside).where(F.col("part") != WHOLE)
        # within a split the end of an old record comes before the begin of a new one
        order = Window.partitionBy("path").orderBy("start", "part")
        pieces = pieces.withColumn("number", F.count_if(F.col("part") == OPENED).over(order))
        cells = F.transform(F.array_sort(F.collect_list(F.struct("start", "record"))), lambda p: p["record"])
        joined = pieces.groupBy("path", "number").agg(F.array_join(cells, "\n").alias("record"), F.max("first").alias("first"))
        made = made.unionByName(joined.select("record", "first"))
    record = F.regexp_replace("record", r"\r\z", "")
    return made.select(record.alias("record"), "first").where(F.col("record") != "")


def stray_quote(record: Column) -> Column:
    """Whether a quote stands inside a cell that does not begin with one, or text follows a closing quote.

    Between two quotes outside of cells there is nothing (a doubled quote) or a comma at both ends.
    """
    parts = F.split(record, QUOTE)
    last = F.size(parts) - 1
    return F.exists(
        F.transform(parts, lambda p, i: (i % 2 == 0) & (p != "") & (
            ((i > 0) & ~p.startswith(",")) | ((i < last) & ~p.endswith(",")))),
        lambda bad: bad,
    )
