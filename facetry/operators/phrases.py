"""Find a list of phrases (emoticons) in texts, with true code-point positions.

A list that passes the size check travels to the tasks, and each text is searched where it is
read (``operators.matcher``); only matches leave the scan.

A longer list stays a table. Its Bloom filter travels instead (``operators.bloom``: the hashes of the phrases
and of their first characters up to a power of two), and only pieces of text that pass it leave the scan, each
once per slice of texts, for an equi-join with the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetry.operators import blocks, bloom
from facetry.operators.joins import lookup_join
from facetry.operators.matcher import SLICE_CHARS, Matcher, slices
from facetry.session import fits_broadcast, materialize, ship_package


def _by_id(hits: DataFrame) -> DataFrame:
    """Shuffle the matches on ``id``.

    The number of partitions is given, and unlike that of texts already spread on ``id``, so
    that the shuffle stays in the plan: the readers of the matches share it instead of
    finding them anew.
    """
    usual = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hits.repartition(2 * usual, "id")


def _matches_in_tasks(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(id, pos, ord)`` by searching each text for a measured list."""
    ship_package(docs.sparkSession)
    listed = phrases.select("token", "ord").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(
        (Matcher(listed["token"].to_pylist()), listed["ord"].to_numpy())
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, numbers = shared.value
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for begin, end in blocks.ranges(np.cumsum(sizes, dtype=np.int64), SLICE_CHARS):
                part = batch.slice(begin, end - begin)
                start, word, ends = matcher.matches(pc.fill_null(part.column(1), "").to_pylist())
                owner = np.searchsorted(ends, start, side="right")
                own = start - np.concatenate([[0], ends])[owner]
                columns = [part.column(0).take(pa.array(owner)), pa.array(own.astype(np.int32)), pa.array(numbers[word])]
                yield pa.record_batch(columns, ["id", "pos", "ord"])

    fields = [("id", docs.schema["id"].dataType), ("pos", T.IntegerType()), ("ord", T.LongType())]
    return docs.select("id", "text").mapInArrow(find, T.StructType([T.StructField(*f) for f in fields]))


def candidates(docs: DataFrame, held: bloom.WindowFilter) -> DataFrame:
    """``(token, ids, places)``: a row per slice of texts and different piece that the filter lets through.

    ``ids`` and ``places`` say where the piece stands; together they are no longer than the slice. A
    text longer than a slice is searched in pieces that overlap by the longest phrase.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(held)
    kind = docs.schema["id"].dataType
    ids_type = T.ArrayType(kind)
    over = max(n for lengths in held.lengths.values() for n in lengths) - 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            owner, offset, pieces = [], [], []
            for i, text in enumerate(texts):
                for at in range(0, len(text), SLICE_CHARS):
                    owner.append(i)
                    offset.append(at)
                    pieces.append(text[at : at + SLICE_CHARS + over])
            owner, offset = np.array(owner, np.int64), np.array(offset, np.int64)
            for begin, end in slices(pieces):
                some = pieces[begin:end]
                start, size, ends = bloom.windows(shared.value, some)
                which = np.searchsorted(ends, start, side="right")
                own = start - np.concatenate([[0], ends])[which]
                mine = own < SLICE_CHARS  # what starts later belongs to the next piece
                start, size, which, own = start[mine], size[mine], which[mine] + begin, own[mine]
                if not len(start):
                    continue
                joined = "".join(some)
                coded = pa.array([joined[s : s + n] for s, n in zip(start.tolist(), size.tolist(), strict=True)]).dictionary_encode()
                order = np.argsort(coded.indices.to_numpy(), kind="stable")
                counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                ids = batch.column(0).take(pa.array(owner[which[order]]))
                places = pa.array((own[order] + offset[which[order]]).astype(np.int32))
                yield pa.record_batch(
                    [coded.dictionary, pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, places)],
                    ["token", "ids", "places"],
                )

    fields = [("token", T.StringType()), ("ids", ids_type), ("places", T.ArrayType(T.IntegerType()))]
    return docs.select("id", "text").mapInArrow(find, T.StructType([T.StructField(*f) for f in fields]))


def _matches_by_join(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """The pieces of text that pass the list's filter, each once per slice, meet the list itself.

    No piece is a row more often than there are slices of text, so the list is joined as it is, once: the matches
    keep all its columns.
    """
    met = candidates(docs, bloom.build(phrases.select("token"))).join(phrases, "token")
    rows = met.select(*phrases.columns, F.explode_outer(F.arrays_zip("ids", "places")).alias("_m"))
    return rows.select(F.col("_m.ids").alias("id"), F.col("_m.places").alias("pos"), *phrases.columns)


def _listed(phrases: DataFrame, small: bool | None) -> tuple[DataFrame, bool]:
    """The list without empty phrases, written, and whether it travels to the tasks."""
    listed = phrases.where(F.length("token") > 0).select("token", F.col("ord").cast("long").alias("ord"))
    listed = materialize(listed)
    return listed, fits_broadcast(listed, "token", row_bytes=60) if small is None else small


def phrase_matches(docs: DataFrame, phrases: DataFrame, small: bool | None = None) -> DataFrame:
    """``(id, pos, ord)`` of every match, overlapping ones included, partitioned by ``id``.

    ``docs`` is ``(id, text)`` with unique ids; ``phrases`` is ``(token, ord)`` with distinct
    tokens. Only matches are shuffled. ``small`` overrides the size check of the list.
    """
    listed, small = _listed(phrases, small)
    if listed.isEmpty():
        return docs.select("id", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("ord")).where("false")
    found = _matches_in_tasks(docs, listed) if small else _matches_by_join(docs, listed)
    return _by_id(found.select("id", "pos", "ord"))


def _with_border(phrases: DataFrame) -> DataFrame:
    """Mark phrases that can overlap themselves: some proper prefix is also a suffix."""
    n = F.length("token")
    overlaps = F.exists(
        F.sequence(F.lit(1), n - 1),
        lambda b: F.col("token").substr(F.lit(1), b) == F.col("token").substr(n - b + 1, b),
    )
    return phrases.where(n > 0).select(
        "ord", n.alias("_len"), F.when(n > 1, overlaps).otherwise(F.lit(False)).alias("_border")
    )


def _kept_of(grouped: DataFrame) -> DataFrame:
    """``pos`` instead of ``_all``, all places of a phrase in a text: those that do not overlap, from the left."""

    def take(kept: Column, pos: Column) -> Column:
        free = (F.size(kept) == 0) | (pos >= F.element_at(kept, -1) + F.col("_len"))
        return F.when(free, F.concat(kept, F.array(pos))).otherwise(kept)

    chosen = F.aggregate("_all", F.array().cast("array<int>"), take)
    others = [c for c in grouped.columns if c not in ("_all", "_len")]
    return grouped.select(*others, F.explode_outer(chosen).alias("pos")).where("pos IS NOT NULL")


def _occurrences(docs: DataFrame, phrases: DataFrame, small: bool | None) -> DataFrame:
    """``(id, pos, ord, token)``, non-overlapping per phrase from the left, partitioned by ``id``.

    Grouping on ``id`` and something else keeps that partitioning. A group of one text and
    one phrase is bounded by the text. Matches of a list that travels have no ``token`` yet (``_named``).
    """
    listed, small = _listed(phrases, small)
    if small or listed.isEmpty():
        return _occurrences_of_travelling(phrase_matches(docs, listed, True), listed)
    # one join with the list, which says what is needed of a phrase: nothing is asked for again
    told = listed.join(_with_border(listed), "ord")
    overlapping = not told.where("_border").isEmpty()
    matches = _by_id(_matches_by_join(docs, told if overlapping else listed))
    if not overlapping:
        return matches
    simple = matches.where("NOT _border")
    grouped = matches.where("_border").groupBy("id", "ord", "token", "_len").agg(F.array_sort(F.collect_list("pos")).alias("_all"))
    columns = ["id", "pos", "ord", "token"]
    return simple.select(*columns).unionByName(_kept_of(grouped).select(*columns))


def _occurrences_of_travelling(matches: DataFrame, phrases: DataFrame) -> DataFrame:
    bordered = _with_border(phrases)
    if bordered.where("_border").isEmpty():
        return matches
    # Both branches read the one shuffle of the matches; only overlapping phrases are collected.
    fits = fits_broadcast(phrases, "token")
    simple = lookup_join(matches, bordered.where("NOT _border"), ["ord"], fits)
    grouped = (
        lookup_join(matches, bordered.where("_border"), ["ord"], fits)
        .groupBy("id", "ord", "_len")
        .agg(F.array_sort(F.collect_list("pos")).alias("_all"))
    )
    return simple.select("id", "pos", "ord").unionByName(_kept_of(grouped).select("id", "pos", "ord"))


def _named(rows: DataFrame, phrases: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with the phrases' own text, if they do not have it."""
    if "token" not in rows.columns:
        rows = lookup_join(rows, phrases.select("ord", "token"), ["ord"], fits_broadcast(phrases, "token"))
    return rows.select(*columns)


def phrase_hits(docs: DataFrame, phrases: DataFrame, small: bool | None = None) -> DataFrame:
    """``(id, pos, token)``: one phrase per position, the later list entry wins a tie."""
    hits = _occurrences(docs, phrases, small)
    token = [F.max_by("token", "ord").alias("token")] if "token" in hits.columns else []
    last = hits.groupBy("id", "pos").agg(F.max("ord").alias("ord"), *token)
    return _named(last, phrases, "id", "pos", "token")


def phrase_counts(docs: DataFrame, phrases: DataFrame, small: bool | None = None) -> DataFrame:
    """``(id, token, n)``: how often each phrase occurs in each text that has it."""
    hits = _occurrences(docs, phrases, small)
    token = [F.first("token").alias("token")] if "token" in hits.columns else []
    counts = hits.groupBy("id", "ord").agg(F.count(F.lit(1)).alias("n"), *token)
    return _named(counts, phrases, "id", "token", "n")


def hit_map(hits: DataFrame) -> DataFrame:
    """``(id, hits)``: the positions and phrases of each text as one ordered array."""
    return hits.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("hits"))
