"""Dictionary word segmentation, user dictionaries and corpus keywords."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from facetry.functions.text import char_tokens, strip
from facetry.operators import blocks, bloom
from facetry.operators.encode import TokenIndex
from facetry.operators.matcher import (
    SLICE_CHARS,
    Matcher,
    cut_places,
    longest_of,
    runs,
    slices,
    token_lists,
)
from facetry.session import fits_broadcast, materialize, ship_package

HOT_TOKENS = 50_000
BLOCK_CHARS = 1 << 21  # of texts that ask a large dictionary together, or one text
UNITS = float(1 << 32)  # log-probabilities are summed as whole numbers, so that equal cuts are equal


def _weight(total: float) -> Column:
    return F.round(F.log(F.greatest("freq", F.lit(1)) / F.lit(total)) * UNITS).cast("long")


def _floor(total: float) -> int:
    """The weight of a character that is no word."""
    return round(-math.log(total) * UNITS)


def extend_dictionary(base: DataFrame, added: DataFrame, freq: int | None = None) -> DataFrame:
    """``(token, freq)`` with the added words (trimmed) replacing or joining the base ones."""
    new = added.select(
        strip("token").alias("token"),
        (F.lit(freq) if freq is not None else F.col("freq")).cast("long").alias("freq"),
        F.lit(1).alias("_rank"),
    )
    old = base.select("token", F.col("freq").cast("long").alias("freq"), F.lit(0).alias("_rank"))
    merged = old.unionByName(new).where(F.length("token") > 0).groupBy("token")
    return merged.agg(F.max(F.struct("_rank", "freq")).alias("_m")).select("token", "_m.freq")


def _bounded(docs: DataFrame, tokens, name: str = "tokens") -> DataFrame:
    """``docs`` with the lists that ``tokens(texts)`` makes of its ``text``, a slice of texts at a time.

    What a slice gives is handed on before the next one is cut. A null text has a null list.
    """
    at, names = docs.columns.index("text"), [*docs.columns, name]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for begin, end in blocks.ranges(np.cumsum(sizes, dtype=np.int64), SLICE_CHARS):
                part = batch.slice(begin, end - begin)
                lists = tokens(pc.fill_null(part.column(at), "").to_pylist())
                yield pa.record_batch([*part.columns, lists], names)

    cut = docs.mapInArrow(make, _with_lists(docs, name))
    return cut.withColumn(name, F.when(F.col("text").isNotNull(), F.col(name)))


def _with_lists(docs: DataFrame, name: str = "tokens") -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.StringType()))])


def _cut_with_list(docs: DataFrame, dictionary: DataFrame, total: float | None) -> DataFrame:
    """The cuts with a measured dictionary that travels to the tasks whole."""
    ship_package(dictionary.sparkSession)
    weight = _weight(total) if total else F.lit(0).cast("long")
    listed = dictionary.select("token", weight.alias("w")).toArrow()
    # built here once; the tasks only search
    matcher = Matcher(listed["token"].to_pylist())
    shared = dictionary.sparkSession.sparkContext.broadcast((matcher, listed["w"].to_numpy()))
    floor = _floor(total) if total else 0

    def cut(texts):
        matcher, weights = shared.value
        steps, ends = matcher.likeliest_steps(texts, weights, floor) if total else matcher.longest_steps(texts)
        return token_lists(texts, cut_places(steps), ends)

    return _bounded(docs, cut)


class _Chunks:
    """Texts taken apart at the characters that no word of the dictionary has.

    No word runs across such a character, so it is a token alone, and how a chunk between two of them is cut
    depends on the chunk only: different chunks are cut once.
    """

    def __init__(self, texts: list[str], member: np.ndarray):
        joined = "".join(texts)
        self.texts, self.ends = texts, np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.begins, self.stops = runs(Matcher._points(joined), self.ends, member)
        places = zip(self.begins.tolist(), self.stops.tolist(), strict=True)
        self.coded = pa.array([joined[b:e] for b, e in places], pa.string()).dictionary_encode()

    def distinct(self) -> list[str]:
        return self.coded.dictionary.to_pylist()

    def tokens(self, steps: np.ndarray) -> pa.Array:
        """The texts' tokens; ``steps`` are the sizes of the different chunks' tokens, one chunk after the other."""
        sizes = np.array([len(c) for c in self.distinct()], np.int64)
        first = np.zeros(int(sizes.sum()), bool)
        first[np.cumsum(steps) - steps] = True
        chunk = self.coded.indices.to_numpy(zero_copy_only=False)
        lengths = self.stops - self.begins
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        starts = np.ones(int(self.ends[-1]) if len(self.ends) else 0, bool)
        starts[np.repeat(self.begins, lengths) + within] = first[np.repeat((np.cumsum(sizes) - sizes)[chunk], lengths) + within]
        return token_lists(self.texts, np.flatnonzero(starts), self.ends)


def _searched(held: bloom.WindowFilter, chunks: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of chunks with the places, lengths and ends of ``bloom.windows``."""
    for begin, end in slices(chunks):
        yield chunks[begin:end], *bloom.windows(held, chunks[begin:end])


def _pieces(texts: list[str], starts: np.ndarray, sizes: np.ndarray) -> list[str]:
    joined = "".join(texts)
    return [joined[s : s + n] for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _longest_as_passed(held: bloom.WindowFilter, chunks: list[str]) -> tuple[pa.RecordBatch, pa.Array]:
    """The chunks' cuts if every window that passes the filter were a word, and the different words they use.

    Per chunk the tokens' sizes and their places among the words (-1: one character).
    """
    steps, counts, words = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    for some, start, size, ends in _searched(held, chunks):
        step = longest_of(start, size, int(ends[-1]))
        cuts = cut_places(step)
        steps.append(step[cuts])
        counts.append(np.diff(np.searchsorted(cuts, ends), prepend=0))
        long = cuts[step[cuts] > 1]
        words += _pieces(some, long, step[long])
    steps = np.concatenate(steps)
    coded = pa.array(words, pa.string()).dictionary_encode()
    codes = np.full(len(steps), -1, np.int32)
    codes[steps > 1] = coded.indices.to_numpy(zero_copy_only=False)
    edges = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32))
    cells = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in (steps.astype(np.int32), codes)]
    return pa.record_batch(cells, ["steps", "codes"]), coded.dictionary


def _all_that_pass(held: bloom.WindowFilter, chunks: list[str]) -> pa.Array:
    """The different windows that pass the filter."""
    found = [pa.array(_pieces(some, start, size), pa.string()).unique() for some, start, size, _ in _searched(held, chunks)]
    return pa.concat_arrays([pa.array([], pa.string()), *found]).unique()


def _by_matcher(words: list[str], chunks: list[str], weights: np.ndarray | None = None, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the chunks' tokens, and how many each chunk has."""
    matcher = Matcher(words)
    steps, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin, end in slices(chunks):
        some = chunks[begin:end]
        step, ends = matcher.longest_steps(some) if weights is None else matcher.likeliest_steps(some, weights, floor)
        cuts = cut_places(step)
        steps.append(step[cuts])
        counts.append(np.diff(np.searchsorted(cuts, ends), prepend=0))
    return np.concatenate(steps), np.concatenate(counts)


def _text_blocks(docs: DataFrame, shared, longest: bool) -> DataFrame:
    """``(block, data, chunks, listed)``, written once: rows of ``docs``, their cuts so far, what to ask the dictionary."""
    at = docs.columns.index("text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, member = shared.value
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for begin, end in blocks.ranges(np.cumsum(sizes, dtype=np.int64), BLOCK_CHARS):
                part = batch.slice(begin, end - begin)
                chunks = _Chunks(pc.fill_null(part.column(at), "").to_pylist(), member).distinct()
                cuts, words = _longest_as_passed(held, chunks) if longest else (None, _all_that_pass(held, chunks))
                row = [part, cuts, pa.record_batch([words], ["value"])]
                cells = [pa.array([None if x is None else blocks.packed(x)], pa.binary()) for x in row]
                yield pa.record_batch(cells, ["data", "chunks", "listed"])

    rows = docs.mapInArrow(make, "data binary, chunks binary, listed binary")
    return materialize(rows.withColumn("block", F.monotonically_increasing_id()))


def _likeliest_in_blocks(docs: DataFrame, coded: DataFrame, listed: DataFrame, shared, floor: int) -> DataFrame:
    """The words found in a block meet it with their weights."""
    at = docs.columns.index("text")
    asked = blocks.dictionaries(coded, "token", T.StringType())
    found = asked.join(listed, "token").select("block", "code", "weight")

    def cut(documents: pa.RecordBatch, rows: pa.Table, entries: pa.Array) -> pa.Table:
        chunks = _Chunks(pc.fill_null(documents.column(at), "").to_pylist(), shared.value[1])
        words = entries.take(rows["code"].combine_chunks()).to_pylist()
        steps, _ = _by_matcher(words, chunks.distinct(), rows["weight"].to_numpy(), floor)
        return pa.table([*documents.columns, chunks.tokens(steps)], [*documents.schema.names, "tokens"])

    return blocks.meet(coded, found, cut, _with_lists(docs), entries=True)


def _longest_in_blocks(docs: DataFrame, coded: DataFrame, listed: DataFrame, shared) -> DataFrame:
    """The cuts stand but where the filter passed what is no word: chunks that use such a piece are cut again.

    Only pieces that a cut uses are asked for, and only wrong ones come back; of the few chunks with a wrong one
    all windows are asked for.
    """
    at, names = docs.columns.index("text"), [*docs.columns, "tokens"]
    asked = blocks.dictionaries(coded, "token", T.StringType())
    wrong = materialize(asked.join(listed, "token", "left_anti").select("block", "code"))
    by_block = wrong.groupBy("block").agg(F.collect_list("code").alias("wrong"))
    few = F.broadcast if fits_broadcast(wrong) else (lambda side: side)

    def doubtful(cuts: pa.RecordBatch, codes: list[int]) -> np.ndarray:
        lists = cuts.column("codes")
        owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        return np.unique(owner[np.isin(lists.flatten().to_numpy(), codes)])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, member = shared.value
        for batch in batches:
            for block, data, cuts, codes in zip(*batch.columns, strict=True):
                texts = pc.fill_null(blocks.unpacked(data).column(at), "").to_pylist()
                chunks = _Chunks(texts, member).distinct()
                words = _all_that_pass(held, [chunks[k] for k in doubtful(blocks.unpacked(cuts), codes.as_py())])
                yield pa.record_batch([pa.array([block.as_py()] * len(words), pa.int64()), words], ["block", "token"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = shared.value[1]
        for batch in batches:
            for data, cuts, codes, words in zip(*batch.columns, strict=True):
                documents, cuts = blocks.unpacked(data), blocks.unpacked(cuts)
                chunks = _Chunks(pc.fill_null(documents.column(at), "").to_pylist(), member)
                steps = cuts.column("steps").flatten().to_numpy().astype(np.int64)
                again = doubtful(cuts, codes.as_py() or [])
                if len(again):
                    distinct = chunks.distinct()
                    mended, counts = _by_matcher(words.as_py() or [], [distinct[k] for k in again])
                    parts = np.split(steps, np.cumsum(cuts.column("steps").value_lengths().to_numpy())[:-1])
                    for k, own in zip(again.tolist(), np.split(mended, np.cumsum(counts)[:-1]), strict=True):
                        parts[k] = own
                    steps = np.concatenate(parts)
                yield pa.record_batch([*documents.columns, chunks.tokens(steps)], names)

    doubted = coded.join(few(by_block), "block").select("block", "data", "chunks", "wrong")
    words = doubted.mapInArrow(ask, "block long, token string").join(listed, "token", "left_semi")
    words = materialize(words.groupBy("block").agg(F.collect_list("token").alias("words")))
    rows = coded.join(few(by_block), "block", "left").join(few(words), "block", "left")
    return rows.select("data", "chunks", "wrong", "words").mapInArrow(cut, _with_lists(docs))


def _segment_by_blocks(docs: DataFrame, dictionary: DataFrame, total: float | None) -> DataFrame:
    """Blocks of texts ask a dictionary of any size for the pieces that its filter lets through, each once per block.

    For the longest match a word of one character changes nothing, as any other character is cut alone too.
    """
    weight = _weight(total) if total else F.lit(0).cast("long")
    listed = dictionary.select("token", weight.alias("weight"))
    listed = listed if total else listed.where(F.length("token") > 1)
    if listed.isEmpty():
        return _cut_with_list(docs, dictionary, total)
    ship_package(docs.sparkSession)
    used = listed.select(F.explode(char_tokens("token")).alias("c")).distinct().collect()
    member = np.zeros(max(ord(r["c"]) for r in used) + 1, bool)
    member[[ord(r["c"]) for r in used]] = True
    shared = docs.sparkSession.sparkContext.broadcast((bloom.build(listed.select("token")), member))
    coded = _text_blocks(docs, shared, not total)
    if total:
        cut = _likeliest_in_blocks(docs, coded, listed, shared, _floor(total))
    else:
        cut = _longest_in_blocks(docs, coded, listed, shared)
    return cut.withColumn("tokens", F.when(F.col("text").isNotNull(), F.col("tokens")))


def segment(
    docs: DataFrame, dictionary: DataFrame, method: str = "longest", small: bool | None = None
) -> DataFrame:
    """Add ``tokens``: the words of ``docs(id, text)`` under a ``(token, freq)`` dictionary.

    ``longest`` is forward longest match, ``frequency`` the likeliest cut. A dictionary that
    passes the size check goes to the tasks whole; a larger one is joined with the different pieces
    of blocks of texts. Both ways give the same result. ``small`` overrides the check.
    """
    if method not in ("longest", "frequency"):
        raise ValueError(method)
    dictionary = materialize(dictionary.where(F.length("token") > 0).dropDuplicates(["token"]))
    total = float(dictionary.agg(F.sum("freq")).first()[0] or 1) if method == "frequency" else None
    # a word's hash and place take some 60 bytes beside its characters
    if fits_broadcast(dictionary, "token", row_bytes=60) if small is None else small:
        return _cut_with_list(docs, dictionary, total)
    return _segment_by_blocks(docs, dictionary, total)


_BEST = T.StructType(
    [T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("weights", T.ArrayType(T.DoubleType()))]
)


def _best_of(lengths: np.ndarray, place: np.ndarray, names: pa.Array, weight_of: np.ndarray, top: int) -> pa.StructArray:
    """Each list's ``top`` tokens and weights; ``place`` are the lists' tokens among the sorted ``names`` (-1: none)."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    pairs, count = np.unique((owner * len(names) + place)[place >= 0], return_counts=True)
    owner, place = np.divmod(pairs, max(len(names), 1))
    weight = np.round(count * weight_of[place], 9)
    order = np.lexsort((place, -weight, owner))  # the names are sorted: place breaks ties
    owner, place, weight = owner[order], place[order], weight[order]
    first = np.searchsorted(owner, owner)
    keep = np.arange(len(owner)) - first < top
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner[keep], minlength=len(lengths)))))
    offsets = pa.array(ends.astype(np.int32))
    chosen = names.take(pa.array(place[keep])).cast(pa.string())
    cells = [pa.ListArray.from_arrays(offsets, chosen), pa.ListArray.from_arrays(offsets, pa.array(weight[keep]))]
    return pa.StructArray.from_arrays(cells, names=["tokens", "weights"])


def _top_in_tasks(documents: int, spread: DataFrame, top: int):
    """Rank each document's tokens where it is read, with the measured document counts."""
    ship_package(spread.sparkSession)
    table = spread.select("token", "_docs").sort("token").toArrow()
    weights = np.log(documents / table["_docs"].to_numpy().astype(float))
    shared = spread.sparkSession.sparkContext.broadcast(TokenIndex(table["token"].combine_chunks(), weights))

    @arrow_udf(_BEST)
    def best(tokens):
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        return _best_of(lengths, shared.value.places(tokens.flatten()), shared.value.tokens, shared.value.idx, top)

    return best


def _frequent_cutoff(spread: DataFrame) -> int:
    """Document counts above this belong to tokens few and short enough to broadcast."""
    most = HOT_TOKENS
    while most:
        head = spread.select("_docs").orderBy(F.desc("_docs")).limit(most + 1)
        cutoff = head.agg(F.min("_docs")).first()[0] or 0
        if fits_broadcast(spread.where(F.col("_docs") > cutoff), "token", 24, max_rows=HOT_TOKENS):
            return cutoff
        most //= 4
    return spread.agg(F.max("_docs")).first()[0] or 0


def _keywords_in_blocks(docs: DataFrame, documents: int, spread: DataFrame, top: int) -> DataFrame:
    """``(id, _b)``: the distinct tokens of blocks of documents meet their document counts, and a block is ranked whole.

    The counts of the most frequent tokens are broadcast, so that the shuffle on the token only sees rare ones.
    """
    coded = blocks.pack(docs.select("id", "tokens"), "tokens")
    listed = blocks.dictionaries(coded, "token", T.StringType()).where("token IS NOT NULL")
    cutoff = _frequent_cutoff(spread)
    hot = spread.where(F.col("_docs") > cutoff).withColumnRenamed("_docs", "_hot")
    marked = listed.join(F.broadcast(hot), "token", "left")
    common = marked.where("_hot IS NOT NULL").withColumnRenamed("_hot", "_docs")
    rare = marked.where("_hot IS NULL").drop("_hot").join(spread.where(F.col("_docs") <= cutoff), "token")
    found = common.select("block", "code", "_docs").unionByName(rare.select("block", "code", "_docs"))

    def rank(rows: pa.RecordBatch, counts: pa.Table, entries: pa.Array) -> pa.Table:
        codes = rows.column("codes")
        weights = np.zeros(len(entries) + 1)
        weights[counts["code"].to_numpy()] = np.log(documents / counts["_docs"].to_numpy().astype(float))
        # in order of the tokens, as ties are broken; null tokens have no place
        order = pc.array_sort_indices(entries).to_numpy()
        place = np.empty(len(entries) + 1, np.int64)
        place[order] = np.arange(len(entries))
        place[-1] = -1
        nulls = np.append(entries.is_null().to_numpy(zero_copy_only=False), True)
        place[nulls] = -1
        each = place[codes.values.fill_null(-1).to_numpy(zero_copy_only=False)]
        lengths = codes.value_lengths().to_numpy(zero_copy_only=False)
        best = _best_of(lengths, each, entries.take(pa.array(order)), weights[order], top)
        return pa.table({"id": rows.column("id"), "_b": best})

    schema = f"id {docs.schema['id'].dataType.simpleString()}, _b {_BEST.simpleString()}"
    return blocks.meet(coded, found, rank, schema, entries=True)


def keywords(docs: DataFrame, top: int = 40, small: bool | None = None) -> DataFrame:
    """``(id, token, weight, rank)``: the ``top`` TF-IDF tokens of each ``docs(id, tokens)``.

    Weight is ``count * ln(documents / documents with the token)``, rounded to nine places
    so that equal weights rank by token. Document counts that pass the size check go to the
    tasks and nothing else is shuffled; otherwise blocks of documents are joined with them. ``small`` overrides the
    check. (``explode_outer`` keeps Spark from evaluating the token expression twice.)
    """
    documents = docs.count()
    spread = materialize(
        docs.select(F.explode_outer(F.array_distinct("tokens")).alias("token"))
        .where("token IS NOT NULL")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("_docs"))
    )
    if fits_broadcast(spread, "token") if small is None else small:
        best = docs.select("id", _top_in_tasks(documents, spread, top)("tokens").alias("_b"))
    else:
        best = _keywords_in_blocks(docs, documents, spread, top)
    rows = best.select("id", F.posexplode_outer(F.arrays_zip("_b.tokens", "_b.weights")).alias("rank", "_t"))
    return rows.where("_t IS NOT NULL").select(
        "id", F.col("_t.tokens").alias("token"), F.col("_t.weights").alias("weight"), (F.col("rank") + 1).alias("rank")
    )
