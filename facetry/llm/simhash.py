"""Near duplicates by SimHash: fingerprints, a byte-position index with count filtering, groups.

A fingerprint has 64 bits, 8 bytes at 8 positions. Two fingerprints that differ in at most
``max_bits`` = d bits differ in at most d bytes, so they share at least 8 - d positional bytes.

* Index. A list for one (position, byte) holds a 256th of everything; tallying its pairs would
  grow with the square of the input. So the index is keyed by sets of positional bytes: the
  positions are cut into d + 2 groups, and a list is kept for every pair of groups. At most d
  groups can differ, two are equal, so every linked pair meets in some list.
* Count filter. For the pairs of a list the shared positional bytes are tallied and pairs with
  fewer than 8 - d are dropped; what is left is verified by the bits that differ.
* Long lists. A list of more than ``list_rows`` fingerprints is not paired. Its members are sent
  to all values that differ from them in at most d/2 bits. Members that meet at one value are
  linked to its smallest member when d is even, as both lie within d/2 of it; a pair within d
  bits has such a value between them, so nothing is lost, and the rows grow with the members.
  (For odd d a meeting point of the two half distances is used and each meeting is verified.)

Distinct fingerprints are compared, never their copies. Links join groups transitively.

Words are runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased; a shingle is ``words``
of them, repeats counted; a text with fewer words is one shingle, a text with none (empty, blank,
null) has fingerprint zero and is linked like any other. A bit is 1 if it is set in over half of
the shingles' XXH64 values (seed 42).

Defined cases: null ids are scored and grouped, but never name a group unless all of its ids are
null; repeated rows come back as often as they are there. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import attach
from facetry.llm.components import components
from facetry.session import materialize, ship_package

SEED = 42
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned fingerprint of one whole text, hashed in chunks of shingles."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    set_bits = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        hashes = [digest(join(tokens[i : i + words]), SEED) for i in range(start, min(n, start + CHUNK))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little")
        set_bits += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``(id, fp)`` per row; ``fp`` holds the 64 bits as a signed long."""
    ship_package(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            signed = np.array(made, np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(signed)], ["id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, "id long, fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """The tally: at how many of the 8 positions both hold the same byte."""
    both = a.bitwiseXOR(b)
    return reduce(lambda x, y: x + y, [(_byte(both, i) == 0).cast("int") for i in range(8)])


def _mask(bytes_: tuple[int, ...]) -> int:
    mask = sum(255 << 8 * i for i in bytes_)
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, max_bits: int = 2, list_rows: int = 64) -> DataFrame:
    """Linked pairs ``(a, b)`` of distinct fingerprints ``fp``; see the module's text.

    The pairs' transitive groups are those of all pairs within ``max_bits``.
    """
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits is 0 to 6")
    n_groups = max_bits + 2
    groups = [tuple(range(8))[i::n_groups] for i in range(n_groups)]
    masks = [_mask(tuple(sorted(x + y))) for x, y in combinations(groups, 2)]
    keyed = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("list", "key"),
    )
    keyed = materialize(keyed)
    sizes = keyed.groupBy("list", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = materialize(sizes)
    marked = attach(keyed, sizes, ["list", "key"], "n", keyed.count())
    held = (
        marked.where(F.col("n") <= list_rows)
        .groupBy("list", "key")
        .agg(F.array_sort(F.collect_list("fp")).alias("fps"))
    )
    pairs = (
        held.select("fps", F.posexplode("fps").alias("i", "a"))
        .select("a", F.explode(F.slice("fps", F.col("i") + 2, F.lit(list_rows))).alias("b"))
        .where(shared_bytes(F.col("a"), F.col("b")) >= 8 - max_bits)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    if not sizes.where(F.col("n") > list_rows).limit(1).count():
        return pairs
    crowded = materialize(marked.where(F.col("n") > list_rows).select("fp").distinct())
    return pairs.unionByName(_through_centres(crowded, max_bits))


def _through_centres(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints of long lists, by the values that lie between them."""
    near, far = max_bits // 2, max_bits - max_bits // 2

    def around(reach: int) -> DataFrame:
        flips = [sum(1 << i for i in c) for r in range(reach + 1) for c in combinations(range(64), r)]
        flips = [f - (1 << 64) if f >> 63 else f for f in flips]
        mask = F.explode(F.from_json(F.lit(str(flips)), "array<long>")).alias("m")
        return crowded.select("fp", mask).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("centre"))

    if near == far:
        met = around(near)
        least = met.groupBy("centre").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        return met.join(least, "centre").where("fp <> a").select("a", F.col("fp").alias("b"))
    left = around(near).select(F.col("fp").alias("a"), "centre")
    right = around(far).select(F.col("fp").alias("b"), "centre")
    met = left.join(right, "centre").where("a <> b")
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b").distinct()


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    max_bits: int = 2,
    list_rows: int = 64,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row; the component is its smallest id."""
    return _grouped(docs, doc_id, text, words, max_bits, list_rows).select(
        F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _grouped(docs: DataFrame, doc_id: str, text: str, words: int, max_bits: int, list_rows: int = 64) -> DataFrame:
    """``(id, fp, component_id, component)`` per row; ``component`` is a fingerprint, also without any id."""
    rows = materialize(fingerprints(docs, doc_id, text, words))
    total = rows.count()
    each = materialize(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    # links between fingerprints; groups are then found on the fingerprints themselves
    found = materialize(links(each.select("fp"), max_bits, list_rows))
    members = components(found)
    named = each.join(members.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "first", "n", F.coalesce("component", "fp").alias("component")
    )
    named = materialize(named)
    # the smallest id of each group of fingerprints: only groups with links need a second look
    ends = found.select(F.col("a").alias("fp")).unionByName(found.select(F.col("b").alias("fp"))).distinct()
    joined = named.join(ends, "fp", "left_semi")
    smallest = materialize(
        joined.groupBy("component").agg(F.min("first").alias("smallest"), F.count(F.lit(1)).alias("fps"))
    )
    whole = attach(named, smallest, ["component"], "fps", named.count())
    ids = materialize(
        whole.select("fp", "n", "component", F.coalesce("smallest", "first").alias("component_id")).where(
            "n > 1 or component_id is not null or component <> fp"
        )
    )
    back = attach(rows, ids, ["fp"], "n", total)
    return back.select("id", "fp", "component_id", F.coalesce("component", "fp").alias("component"))


def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 2
) -> DataFrame:
    """The rows of ``docs`` that stay: of each group those with its smallest id, with all columns.

    Rows that repeat the smallest id all stay: they are one document. An id that carries several texts
    is decided for each. Rows without an id go if their group has one; else the group keeps one row, that
    of the smallest fingerprint and text.
    """
    groups = materialize(_grouped(docs, doc_id, text, words, max_bits))
    copies = F.coalesce(F.col("id") != F.col("component_id"), F.lit(False))
    gone = materialize(groups.where(copies).select("id", "fp").distinct())
    gone_ids = materialize(gone.select("id").distinct())
    mixed = materialize(groups.where(~copies).select("id").join(gone_ids, "id", "left_semi").distinct())
    full = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    stay = full.where(F.col("id").isNotNull()).join(gone_ids, "id", "left_anti").select("row.*")
    print_of = F.udf(lambda t: int(np.uint64(fingerprint(t, words)).astype(np.int64)), "long")
    if mixed.limit(1).count():
        some = full.join(mixed, "id", "left_semi").withColumn("fp", print_of("text"))
        stay = stay.unionByName(some.join(gone, ["id", "fp"], "left_anti").select("row.*"))
    nameless = groups.where(F.col("id").isNull())
    total = nameless.count()
    if total:
        each = nameless.groupBy("fp").agg(
            F.min("component").alias("component"), F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n")
        )
        found = materialize(full.where(F.col("id").isNull()).withColumn("fp", print_of("text")))
        alone = attach(found, materialize(each), ["fp"], "n", total).where(F.col("component_id").isNull())
        one = alone.groupBy("component").agg(F.min_by("row", F.struct("fp", "text")).alias("row"))
        stay = stay.unionByName(one.select("row.*"))
    return stay
