"""Vector code compression: parts of vectors by their nearest codebook entry, in integers only.

Vectors become integers, floor(scale * x), and are cut into equal consecutive parts; every part
position has a codebook. A part is written as the index of its nearest entry.

Nearest entries by an integer Walsh-Hadamard transform. Parts and entries are padded with zeros to
a power of two, p, and transformed by additions and subtractions; the coefficients are ordered by
sequency (their rows' number of sign changes), slow changes first. The sum of squared differences of all
coefficients is exactly p times the squared distance, and every partial sum is at most that. So an entry
whose partial sum is above p times the distance of some other entry is eliminated before its other
coefficients are looked at. Nothing is rounded: while the sums fit 64 bits they are 64-bit integers,
beyond that Python's.

Training: the codebooks start as the parts of the first vectors by id. In each round all parts are
assigned on Spark and a task returns only a sum and a count per part position and entry; the codebooks,
whose size does not depend on the table's, are all that comes to the driver and goes to the tasks.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part.
Components beyond 64 bits are clipped to them, and so are errors. Null ids come after all others; of
repeated ids the smaller vector comes first, and each row is coded. Vectors shorter than the longest one
count as filled up with zeros, and so do parts of a length that the number of parts does not
divide. Ties go to the lower index; entries without a part stay as they are. A table with fewer rows than entries has as
many entries as rows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import attach
from facetry.session import materialize, ship_package

LONG = 2**63 - 1
BLOCK = 4096  # parts compared at once


def walsh(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row (a power of two long), in sequency order."""
    out, size, half = rows.copy(), rows.shape[1], 1
    while half < size:
        pairs = out.reshape(len(out), size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), size)
        half *= 2
    return out[:, sequency(size)]


def sequency(size: int) -> np.ndarray:
    """The rows of the transform's matrix by their number of sign changes.

    Row i has (-1) ** (number of ones in i & j) at place j.
    """
    index = np.arange(size)
    ones = np.array([bin(i).count("1") for i in range(size)])
    signs = ones[index[:, None] & index[None, :]] % 2
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def padded(rows: np.ndarray) -> np.ndarray:
    """Rows filled up with zeros to a power of two."""
    size = 1 << max(0, rows.shape[1] - 1).bit_length()
    return np.pad(rows, ((0, 0), (0, size - rows.shape[1])))


def _reach(rows: np.ndarray) -> int:
    return max(int(rows.max(initial=0)), -int(rows.min(initial=0)))


def _wide(rows: np.ndarray, entries: np.ndarray) -> bool:
    """Whether scaled distances may exceed 64 bits: each coefficient sums ``size`` components."""
    size = 1 << max(0, rows.shape[1] - 1).bit_length()
    return size * (2 * size * max(_reach(rows), _reach(entries))) ** 2 > LONG


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the index of its nearest entry, the lower one of equals, and their squared distance."""
    if _wide(rows, entries):
        rows, entries = rows.astype(object), entries.astype(object)
    size = 1 << max(0, rows.shape[1] - 1).bit_length()
    asked, listed = walsh(padded(rows)), walsh(padded(entries))
    index, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), asked.dtype)
    for begin in range(0, len(rows), BLOCK):
        found = slice(begin, begin + BLOCK)
        index[found], distance[found] = _eliminate(asked[found], listed)
    # the scaled sums are multiples of the padded length
    return index, distance // size


def _eliminate(asked: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and scaled distances for one block of rows."""
    n, size = asked.shape
    # all pairs in order of row and entry; what is eliminated leaves these arrays
    row, entry = np.divmod(np.arange(n * len(listed)), len(listed))
    sums = ((asked[:, :1] - listed[None, :, 0]) ** 2).ravel()
    limit = None
    for k in range(1, size + 1):
        if k & (k - 1) == 0:
            # at 1, 2, 4, .. coefficients: no entry needs to exceed the distance of the likeliest one
            likely, least = _least(row, entry, sums, n)
            whole = ((asked - listed[likely]) ** 2).sum(axis=1) if k < size else least
            limit = whole if limit is None else np.minimum(limit, whole)
        left = sums <= limit[row]
        if not left.all():
            row, entry, sums = row[left], entry[left], sums[left]
        if k < size:
            sums = sums + (asked[row, k] - listed[entry, k]) ** 2
    return _least(row, entry, sums, n)


def _least(row: np.ndarray, entry: np.ndarray, sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row its smallest sum and the first entry that has it; every row has pairs left."""
    best = np.minimum.reduceat(sums, np.searchsorted(row, np.arange(n)))
    first = np.flatnonzero(sums == best[row])
    return entry[first[np.searchsorted(row[first], np.arange(n))]], best


class Codebooks:
    """The entries of every part position: ``entries[part]`` is (entry, component)."""

    def __init__(self, vectors: list[list[int]], parts: int, dims: int):
        self.parts, self.dims = parts, dims
        self.width = -(-dims // parts)
        rows = self.matrix(vectors)
        self.entries = [rows[:, p] for p in range(parts)]

    def matrix(self, vectors: list) -> np.ndarray:
        """``(row, part, component)`` of some vectors, filled up with zeros."""
        made = np.zeros((len(vectors), self.parts * self.width), np.int64)
        for i, v in enumerate(vectors):
            made[i, : len(v)] = v
        return made.reshape(len(vectors), self.parts, self.width)

    def batch(self, vectors: pa.ListArray) -> np.ndarray:
        """``matrix`` of an Arrow list array."""
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        made = np.zeros((len(vectors), self.parts * self.width), np.int64)
        made[np.arange(made.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        return made.reshape(len(vectors), self.parts, self.width)

    def text(self) -> str:
        """All components in decimal by part, entry and place; a vector's filling is left out."""
        shown = []
        for p, entries in enumerate(self.entries):
            width = min(self.width, max(0, self.dims - p * self.width))
            shown += [str(int(x)) for entry in entries for x in entry[:width]]
        return ",".join(shown)

    def digest(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def whole_vectors(rows: DataFrame, vec_id: str, embedding: str, scale: int, *carry: str) -> DataFrame:
    """``(id, v array<long>)`` and ``carry`` of the rows that take part."""
    v, limit = F.col(embedding), F.lit(float("inf"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < limit))
    # as doubles, floor() saturates at the ends of a long
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    some = rows.where(F.coalesce(fine, F.lit(False)))
    return some.select(F.col(vec_id).cast("long").alias("id"), whole.alias("v"), *[F.col(c).alias(f"_{c}") for c in carry])


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks:
    """Codebooks of ``vectors(id, v)``."""
    spark = vectors.sparkSession
    ship_package(spark)
    dims = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    first = vectors.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = Codebooks([r["v"] for r in first], parts, dims)
    if not first or not dims:
        return books
    for _ in range(rounds):
        _move(books, _sums(vectors, books))
    return books


def _sums(vectors: DataFrame, books: Codebooks):
    """Per part position and entry: the number of its parts and their sums; bounded by the codebooks."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        n = len(given.entries[0])
        counts = np.zeros((given.parts, n), np.int64)
        sums = np.zeros((given.parts, n, given.width), object)
        for batch in batches:
            rows = given.batch(batch.column(0))
            kind = np.int64 if _reach(rows) * max(1, len(rows)) <= LONG else object
            for p in range(given.parts):
                index, _ = nearest(rows[:, p], given.entries[p])
                counts[p] += np.bincount(index, minlength=n)
                mine = np.zeros((n, given.width), kind)
                np.add.at(mine, index, rows[:, p].astype(kind))
                sums[p] += mine.astype(object)
        part, entry = np.nonzero(counts)
        listed = [[Decimal(int(x)) for x in sums[p, e]] for p, e in zip(part, entry, strict=True)]
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry])]
        yield pa.record_batch([*columns, pa.array(listed, pa.list_(pa.decimal128(38, 0)))], ["part", "entry", "n", "s"])

    found = vectors.select("v").mapInArrow(add, "part int, entry int, n long, s array<decimal(38,0)>")
    total = F.array(*[F.sum(F.col("s")[k]) for k in range(books.width)])
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), total.alias("s")).collect()


def _move(books: Codebooks, sums) -> None:
    """Every entry with parts goes to their mean, rounded down."""
    moved = [e.copy() for e in books.entries]
    for row in sums:
        moved[row["part"]][row["entry"]] = [int(s) // row["n"] for s in row["s"]]
    books.entries = moved


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vectors(id, v, ..)`` with ``code`` (array of indexes) and ``error`` (squared distances summed) for ``v``."""
    ship_package(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    carried = [c for c in vectors.columns if c != "v"]
    kept = [vectors.schema[c].simpleString().replace(":", " ", 1) for c in carried]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        for batch in batches:
            rows = given.batch(batch.column(0))
            code = np.zeros((len(rows), given.parts), np.int32)
            error = np.zeros(len(rows), np.int64)
            if given.width and len(rows):
                for p in range(given.parts):
                    code[:, p], distance = nearest(rows[:, p], given.entries[p])
                    if int(error.max()) + int(distance.max()) > LONG:
                        error = np.minimum(error.astype(object) + distance, LONG)
                    else:
                        error = error + distance
            errors = pa.array(error.astype(np.int64))
            codes = pa.array(code.tolist(), pa.list_(pa.int32()))
            yield pa.record_batch([*batch.columns[1:], codes, errors], [*carried, "code", "error"])

    schema = ", ".join([*kept, "code array<int>", "error long"])
    return vectors.select("v", *carried).mapInArrow(make, schema)


def hex_code(code: Column | str) -> Column:
    """Two lower-case hex digits per index (more for indexes over 255)."""
    each = F.transform(code, lambda i: F.lower(F.lpad(F.hex(i), F.greatest(F.lit(2), F.length(F.hex(i))), "0")))
    return F.array_join(each, "")


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``codes`` with ``v``, the vector that its code stands for; the codebooks become one constant array."""
    flat = [[str(int(x)) for x in entry] for entries in books.entries for entry in entries]
    table = F.from_json(F.lit("[" + ",".join("[" + ",".join(e) + "]" for e in flat) + "]"), "array<array<long>>")
    size = len(books.entries[0])
    parts = F.transform(code, lambda i, p: F.get(table, p * size + i))
    return codes.withColumn("v", F.slice(F.flatten(parts), 1, books.dims))


def with_label_error(coded: DataFrame, label: str) -> DataFrame:
    """Adds ``label_error``: the errors summed over the rows of equal labels, nulls together."""
    keys = [F.col(label).isNull().alias("_none"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("_key")]
    rows = materialize(coded.select("*", *keys))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = rows.groupBy("_none", "_key").agg(F.least(total, F.lit(LONG)).cast("long").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    return attach(rows, materialize(sums), ["_none", "_key"], "_n", rows.count()).drop("_none", "_key", "_n")
