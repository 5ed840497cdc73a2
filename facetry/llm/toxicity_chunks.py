"""The class models of ``toxicity`` over labelled texts of any number: chunks of texts meet the counts they ask for.

A chunk holds the words of some 4 million places of text as codes, small ones for its frequent words, written once. Every
chunk sends each of its different bigrams once, with its counts, to the part that the bigram's hash falls into. A part adds
up what it got and answers every chunk with the totals over all texts; of the chunks that hold a bigram the first one
owns it and adds it to its two words' sums, which are sent, added up and answered alike. A chunk then has the counts of
all its bigrams and words, so it compares its texts by the formulas of ``toxicity``. Blocks travel sorted and packed. A
frequent word or bigram is one entry per chunk, so no part is larger than others; nothing but a few sums is on the driver.

Disk is what this costs most of: questions are asked for half of the bigrams at a time and leave the disks when they are
answered, word sums are made from the bigrams owned alone, and texts are compared by groups of chunks.

Bigrams are known by some 20 bits of a hash more than it takes to number all words of the texts: that one meets any
other has a chance of at most 2^-20.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.toxicity import START, UNIT, Discounts, _packed, _text_slices, _units, _unpacked, sigmoid, text_features
from facetry.operators.models import matrix, summed
from facetry.session import ensure_checkpoint_dir, fits_broadcast, materialize, materialize_released, ship_package

CHUNK = 1 << 22  # words of a chunk, or one slice of texts
PART = 1 << 21  # words per part; a part gets fewer bigrams than that
ASK_ROUNDS = 2  # bigrams are asked for by so many ranges of their hashes, one after the other
COMPARE_ROUNDS = 4  # texts are compared by so many groups of chunks
MORE_BITS = 20  # of a bigram's hash
LEVELS = 3  # ordinary, toxic, all documents
SUMS = 15  # of a word, see ``_word_sums``

# what a text is for: null, or asked only, neither counted nor learned from; plain; counted in a class; fits the score
NULL, ASKED, PLAIN, COUNTED, FITS, EXTRA = -3, -2, -1, 0, 2, 4  # + class; + EXTRA: stands for the rows that repeat its id

BLOCK = "part int, kind int, chunk long, n int, data array<binary>"
OWNED, PAIRS, WORDS, NOTE = range(4)  # kinds of answers: of bigrams the chunk owns, of all its bigrams, of words; for the driver


def _block(part: int, chunk: int, *arrays: np.ndarray, kind: int = -1) -> pa.RecordBatch:
    data = pa.array([[_packed(x) for x in arrays]], pa.list_(pa.binary()))
    sizes = [pa.array([x], pa.int32()) for x in (part, kind)]
    return pa.record_batch([*sizes, pa.array([chunk], pa.int64()), pa.array([len(arrays[0])], pa.int32()), data], ["part", "kind", "chunk", "n", "data"])


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=keys.dtype.type(0))


def _keys(body: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpacked(body, size, np.uint64), dtype=np.uint64)


def _listed(words: np.ndarray) -> dict[str, pa.Array]:
    """Words as codes, small ones for frequent words: their high bytes are mostly equal. Words of one count stand sorted."""
    known, codes, n = np.unique(words, return_inverse=True, return_counts=True)
    known, n = np.append(known, START), np.append(n, 0)  # what stands before a text is asked for, too
    order = np.lexsort((known, -n))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return {
        "n": pa.array([len(codes)], pa.int32()),
        "n_listed": pa.array([len(known)], pa.int32()),
        "codes": pa.array([_packed(rank[codes])], pa.binary()),
        "listed": pa.array([_packed(_steps(known[order]))], pa.binary()),
    }


def _unlisted(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The sorted words of ``_listed``, and each word's place among them."""
    words = _keys(row["listed"], row["n_listed"])
    order = np.argsort(words)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return words[order], place[_unpacked(row["codes"], row["n"], np.int32)]


class Chunk:
    """Texts as codes of words; their different bigrams in the order of their hashes."""

    def __init__(self, row: dict, bits: int):
        self.chunk, self.ids, self.roles = row["chunk"], row["ids"], np.array(row["roles"], np.int64)
        if row.get("places"):
            self.roles[row["places"]] = row["learned"]
        self.sizes = _unpacked(row["sizes"], len(self.roles), np.int32).astype(np.int64)
        self.words, codes = _unlisted(row)
        self.starts = np.cumsum(self.sizes) - self.sizes
        before = np.append(np.int32(0), codes[:-1])[: len(codes)]
        before[self.starts[self.sizes > 0]] = np.searchsorted(self.words, START)
        found, place = np.unique(before.astype(np.int64) * len(self.words) + codes, return_inverse=True)
        place = place.astype(np.int32)
        self.first, self.second = (x.astype(np.int32) for x in np.divmod(found, len(self.words)))
        keys = self.words[self.first] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.second]
        keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - bits)
        order = np.argsort(keys)
        self.pairs, self.first, self.second = keys[order], self.first[order], self.second[order]
        where = np.empty(len(order), np.int32)
        where[order] = np.arange(len(order), dtype=np.int32)
        self.place = where[place]  # of every word of the texts

    def counts(self) -> list[np.ndarray]:
        """How often each bigram stands in ordinary and toxic counted texts, and in all texts."""
        role = np.repeat(self.roles, self.sizes)
        chosen = [role % EXTRA == c for c in (0, 1)]
        uses = [(role >= COUNTED) & c for c in chosen] + [(role >= PLAIN) & (role < EXTRA)]
        return [np.bincount(self.place[use], minlength=len(self.pairs)).astype(np.int32) for use in uses]


def chunks(texts: DataFrame) -> DataFrame:
    """``(chunk, ..)`` of ``texts(id, text, role)``, written once."""

    def state(held: list) -> pa.RecordBatch:
        ids, roles, sizes, words = (list(x) for x in zip(*held, strict=True))
        columns = {
            "ids": pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
            "roles": pa.array([pa.concat_arrays(roles).to_pylist()], pa.list_(pa.int32())),
            "sizes": pa.array([_packed(np.concatenate(sizes).astype(np.int32))], pa.binary()),
            **_listed(np.concatenate(words)),
        }
        return pa.record_batch(list(columns.values()), list(columns))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for begin, keys in _text_slices(batch.column(1)):
                ids, roles = (batch.column(i).slice(begin, len(keys.sizes)) for i in (0, 2))
                held.append((ids, roles, keys.sizes, keys.words))
                n += len(keys.words)
                if n >= CHUNK:
                    yield state(held)
                    held, n = [], 0
        if held:
            yield state(held)

    ship_package(texts.sparkSession)
    kind = "ids array<long>, roles array<int>, sizes binary, n int, n_listed int, codes binary, listed binary"
    made = texts.select(F.col("id").cast("long"), "text", F.col("role").cast("int")).mapInArrow(make, kind)
    return _by_chunk(made.withColumn("chunk", F.monotonically_increasing_id()))


def _by_chunk(states: DataFrame) -> DataFrame:
    """Written as a bucketed table beside the checkpoints: chunks stay where they are, only what meets them is shuffled."""
    spark = states.sparkSession
    ensure_checkpoint_dir(spark)
    name = f"toxicity_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}"
    states.write.bucketBy(buckets, "chunk").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def learned_chunks(texts: DataFrame, usable: DataFrame) -> DataFrame:
    """Chunks of all rows of ``texts(id, text)``; of rows that repeat a labelled id the smallest text is learned from.

    With more labels than fit a broadcast the texts are not shuffled to meet them: their ids do once the chunks are written.
    """
    role = F.col("y") + F.when(F.pmod(F.xxhash64("id"), F.lit(4)) == 0, FITS).otherwise(COUNTED)
    usable = usable.select("id", role.alias("role"))
    few_labels = fits_broadcast(usable)
    usable = F.broadcast(usable) if few_labels else usable
    # a null text is not learned from
    repeated = texts.where("text IS NOT NULL").select("id").join(usable, "id").groupBy("id", "role").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = materialize(repeated.select("id", (F.col("role") + EXTRA).alias("extra")))
    if few_labels:
        role = F.when(F.col("text").isNotNull() & F.col("role").isNotNull(), F.col("role")).otherwise(PLAIN)
        rows = texts.join(usable, "id", "left").withColumn("role", role)
    else:
        rows = texts.withColumn("role", F.when(F.col("text").isNull(), NULL).otherwise(PLAIN))
    if not repeated.isEmpty():
        few = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
        extra = texts.join(few, "id").groupBy("id").agg(F.min("text").alias("text"), F.min("extra").alias("role"))
        if few_labels:
            rows = rows.join(few, "id", "left").withColumn("role", F.when(F.col("extra").isNull(), F.col("role")).otherwise(PLAIN))
        rows = rows.select("id", "text", "role").unionByName(extra)
    states = chunks(rows)
    return states if few_labels else _with_roles(states, usable.join(repeated, "id", "left_anti"))


def _with_roles(states: DataFrame, usable: DataFrame) -> DataFrame:
    """Chunks with the ``places`` of their plain texts that ``usable(id, role)`` has, and what these are ``learned`` for."""
    rows = states.select("chunk", F.posexplode(F.arrays_zip("ids", "roles")).alias("place", "row")).where(F.col("row.roles") == PLAIN)
    found = rows.select("chunk", "place", F.col("row.ids").alias("id")).join(usable, "id")
    found = found.groupBy("chunk").agg(F.collect_list(F.struct("place", "role")).alias("found"))
    found = found.select("chunk", F.col("found.place").alias("places"), F.col("found.role").alias("learned"))
    return states.join(materialize_released(found), "chunk", "left")


def _dealt(
    chunk: int, keys: np.ndarray, bits: int, parts: int, columns: list[np.ndarray], only: range | None = None
) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted keys of ``bits`` bits and their columns, one per part; ``only`` those of some parts."""
    width = np.uint64(bits - parts.bit_length() + 1)
    only = range(parts) if only is None else only
    edges = np.searchsorted(keys >> width, np.arange(only.start, only.stop + 1, dtype=np.uint64))
    for part, begin, end in zip(only, edges[:-1], edges[1:], strict=True):
        if end > begin:
            yield _block(part, chunk, _steps(keys[begin:end]), *[x[begin:end] for x in columns])


class Totals:
    """The blocks of a part, added up by key. Chunks of the texts that are learned from come first."""

    def __init__(self, table: pa.Table, columns: int, kind: type):
        self.part = table["part"][0].as_py()
        self.blocks = sorted(table.select(["chunk", "n", "data"]).to_pylist(), key=lambda b: (b["chunk"] < 0, b["chunk"]))
        keys = np.concatenate([_keys(b["data"][0], b["n"]) for b in self.blocks])
        self.keys, self.first, self.at = np.unique(keys, return_index=True, return_inverse=True)
        self.sums = []
        for i in range(1, columns + 1):
            given = np.concatenate([_unpacked(b["data"][i], b["n"], kind) for b in self.blocks])
            self.sums.append(np.bincount(self.at, weights=given, minlength=len(self.keys)).astype(np.int64))

    def answers(self, kind: int, *columns: np.ndarray) -> pa.Table:
        """For each chunk the columns, which are by entry of the blocks."""
        ends = np.cumsum([b["n"] for b in self.blocks])
        made = [
            _block(self.part, b["chunk"], *[x[end - b["n"] : end] for x in columns], kind=kind)
            for b, end in zip(self.blocks, ends, strict=True)
        ]
        return pa.Table.from_batches(made)


def _note(*numbers: np.ndarray) -> pa.Table:
    """A part's sums for the driver."""
    return pa.Table.from_batches([_block(-1, 0, np.concatenate(numbers).astype(np.float64), kind=NOTE)])


def _noted(answers: DataFrame, size: int) -> np.ndarray:
    rows = answers.where(F.col("kind") == NOTE).select("n", "data").toArrow().to_pylist()
    return np.sum([np.zeros(size), *[_unpacked(r["data"][0], r["n"], np.float64) for r in rows]], axis=0)


def _kinds(x: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4, how many are 3 or more, and their sum."""
    return np.array([*[np.count_nonzero(x == k) for k in (1, 2, 3, 4)], np.count_nonzero(x > 2), x.sum(dtype=np.int64)], float)


def _add_pairs(table: pa.Table) -> pa.Table:
    totals = Totals(table, LEVELS, np.int32)
    held = (totals.sums[0] > 0) | (totals.sums[1] > 0)
    n = [np.where(held, x, 0) for x in totals.sums]
    owned = np.zeros(len(totals.at), bool)
    owned[totals.first[held]] = True
    every = [x[totals.at] for x in n]
    answers = [totals.answers(OWNED, *[np.where(owned, x, 0) for x in every]), totals.answers(PAIRS, *every)]
    return pa.concat_tables([*answers, _note(*map(_kinds, n))])


def _add_words(table: pa.Table) -> pa.Table:
    totals = Totals(table, SUMS, np.int64)
    contexts, *single = totals.sums[-3:]
    note = _note([np.count_nonzero(contexts), contexts.sum(dtype=np.int64)], *map(_kinds, single))
    return pa.concat_tables([totals.answers(WORDS, *_thin([x[totals.at] for x in totals.sums])), note])


def _thin(sums: list[np.ndarray]) -> list[np.ndarray]:
    """Word sums less what the others say of them: mostly zeros, which pack well."""
    made = list(sums)
    for c in range(LEVELS):
        made[c] = sums[c] - sum(k * x for k, x in zip((1, 2, 3), sums[LEVELS + 3 * c :], strict=False))
    made[-2:] = [single - leads for single, leads in zip(sums[-2:], sums[:2], strict=True)]
    return made


def _whole(thin: list[np.ndarray]) -> list[np.ndarray]:
    made = list(thin)
    for c in range(LEVELS):
        made[c] = thin[c] + sum(k * x for k, x in zip((1, 2, 3), thin[LEVELS + 3 * c :], strict=False))
    made[-2:] = [single + leads for single, leads in zip(thin[-2:], made[:2], strict=True)]
    return made


def _answer(table: pa.Table, kind: int, columns: int) -> list[np.ndarray]:
    """A chunk's answers of one kind, in the order of its sorted keys."""
    rows = sorted((r for r in table.filter(pc.equal(table["kind"], kind)).to_pylist()), key=lambda r: r["part"])
    none = np.empty(0, np.int64)
    return [np.concatenate([none, *[_unpacked(r["data"][i], r["n"]) for r in rows]]) for i in range(columns)]


def _word_sums(chunk: Chunk, n: list[np.ndarray]) -> list[np.ndarray]:
    """Over the bigrams owned, by word: per level how often it leads and how many bigrams of 1, 2 and more it
    leads; how many it ends, and how often in both classes."""
    own = np.flatnonzero((n[0] > 0) | (n[1] > 0))
    n = [x[own] for x in n]
    by = lambda of, x: np.bincount(of[own], weights=x, minlength=len(chunk.words)).astype(np.int64)
    leads = [by(chunk.first, x) for x in n]
    kinds = [by(chunk.first, k) for x in n for k in (x == 1, x == 2, x > 2)]
    return [*leads, *kinds, by(chunk.second, np.ones(len(own))), by(chunk.second, n[0]), by(chunk.second, n[1])]


def _ratio(chunk: Chunk, n: list[np.ndarray], sums: list[np.ndarray], off: list[Discounts], note: np.ndarray) -> np.ndarray:
    """The log-ratio of each word of the texts after the word before it, as ``toxicity._ratios`` has it."""
    leads = [np.maximum(x, 1) for x in sums[:LEVELS]]
    lost = []
    for c in range(LEVELS):
        taken = sum(d * k for d, k in zip(off[c].of, sums[LEVELS + 3 * c : LEVELS + 3 * c + 3], strict=True))
        lost.append(np.where(sums[c] > 0, taken / leads[c], 1.0))
    contexts, *singles = sums[-3:]
    size = note[0] + 1  # and what stands before a text
    shared = (contexts + 0.5) / (note[1] + 0.5 * (size + 1))
    own, other = [], []
    for c, single in enumerate(singles):
        kinds = note[2 + 6 * c : 8 + 6 * c]
        cut, total = Discounts(*kinds[:4]), max(1.0, kinds[5])
        removed = np.dot(cut.of, [kinds[0], kinds[1], kinds[4]])
        left = removed / total if kinds[5] else 1.0
        own.append(np.maximum(single - cut(single), 0) / total + left * shared)
        other.append(left)
    own_units = np.where(contexts > 0, _units(np.log(own[1] / own[0])), _units(np.log(other[1] / other[0])))
    back_units = _units(np.log(lost[1] / lost[0]))
    v, w = chunk.first, chunk.second
    seen = [np.maximum(x - cut(x), 0) / lead[v] for x, cut, lead in zip(n, off, leads, strict=True)]
    p = [seen[c] + lost[c][v] * (seen[2] + lost[2][v] * own[c][w]) for c in (0, 1)]
    held = (n[0] > 0) | (n[1] > 0)
    ratio = np.where(held, _units(np.log(p[1] / p[0])), own_units[w] + back_units[v])
    return ratio.astype(np.int64)[chunk.place]


def features(states: DataFrame) -> DataFrame:
    """``(id, role, x)``: the features of every text by the counts over all of them, written once."""
    words = states.agg(F.sum("n")).first()[0] or 0
    parts = 1 << max(3, (words // PART).bit_length())
    bits = min(64, words.bit_length() + MORE_BITS)

    def ask_pairs(only: range) -> DataFrame:
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    chunk = Chunk(batch.slice(row, 1).to_pylist()[0], bits)
                    yield from _dealt(chunk.chunk, chunk.pairs, bits, parts, chunk.counts(), only)

        return states.mapInArrow(ask, BLOCK).groupBy("part").applyInArrow(_add_pairs, BLOCK)

    # a round's questions leave the disks before the next one's are written
    edges = [parts * i // ASK_ROUNDS for i in range(ASK_ROUNDS + 1)]
    pairs = reduce(DataFrame.unionByName, [materialize_released(ask_pairs(range(*x))) for x in pairwise(edges)])
    note = _noted(pairs, 6 * LEVELS)
    off = [Discounts(*note[6 * c : 6 * c + 4]) for c in range(LEVELS)]

    def ask_words(state: pa.Table, found: pa.Table) -> pa.Table:
        chunk = Chunk(state.to_pylist()[0], bits)
        made = list(_dealt(chunk.chunk, chunk.words, 64, parts, _word_sums(chunk, _answer(found, OWNED, LEVELS))))
        return pa.Table.from_batches(made)

    owned = pairs.where(F.col("kind") == OWNED)
    asked = states.groupBy("chunk").cogroup(owned.groupBy("chunk")).applyInArrow(ask_words, BLOCK)
    sums = materialize_released(asked.groupBy("part").applyInArrow(_add_words, BLOCK))
    word_note = _noted(sums, 14)

    def compare(state: pa.Table, found: pa.Table) -> pa.Table:
        chunk = Chunk(state.to_pylist()[0], bits)
        ratio = _ratio(chunk, _answer(found, PAIRS, LEVELS), _whole(_answer(found, WORDS, SUMS)), off, word_note)
        x = text_features(ratio, chunk.starts, chunk.sizes)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        return pa.table({"id": pa.array(chunk.ids, pa.int64()), "role": pa.array(chunk.roles.astype(np.int32)), "x": lists})

    answers = pairs.where(F.col("kind") == PAIRS).unionByName(sums.where(F.col("kind") == WORDS))
    made = []
    for i in range(COMPARE_ROUNDS):  # only one group's answers travel at a time
        some = F.pmod(F.xxhash64("chunk"), F.lit(COMPARE_ROUNDS)) == i
        both = states.where(some).groupBy("chunk").cogroup(answers.where(some).groupBy("chunk"))
        made.append(materialize_released(both.applyInArrow(compare, "id long, role int, x array<double>")))
    return reduce(DataFrame.unionByName, made).coalesce(made[0].rdd.getNumPartitions())


def fit_weights(rows: DataFrame, ridge: float = 1.0, steps: int = 50) -> np.ndarray | None:
    """``toxicity.logistic`` over ``rows(x, y)`` of any number: a job per step adds up gradient and curvature."""
    if rows.select("y").distinct().count() < 2:
        return None
    width = len(rows.first()["x"]) + 1
    keep = np.full(width, ridge)
    keep[-1] = 1e-6
    w = np.zeros(width)
    for _ in range(steps):

        def partial(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> np.ndarray:
            curve, slope = np.zeros((width, width)), np.zeros(width)
            for batch in batches:
                z = matrix(batch.column(0), width - 1)
                z, y = np.column_stack([z, np.ones(len(z))]), batch.column(1).to_numpy()
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                curve += (z.T * (p * (1 - p))) @ z
                slope += z.T @ (y - p)
            return np.append(curve.ravel(), slope)

        total = summed(rows, partial, "x", "y")
        step = np.linalg.solve(total[:-width].reshape(width, width) + np.diag(keep), total[-width:] - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return np.round(w, 9)  # sums depend on the layout in their last bits


class ChunkModel:
    """The model of all labelled texts: their chunks, the features of all texts, and the weights of the score."""

    def __init__(self, texts: DataFrame, usable: DataFrame):
        self.texts = texts
        self.states = learned_chunks(texts, usable)
        self.features = features(self.states)
        fits = F.col("role").isin(FITS, FITS + 1, EXTRA + FITS, EXTRA + FITS + 1)
        self.weights = fit_weights(materialize(self.features.where(fits).select("x", F.pmod("role", F.lit(2)).alias("y"))))

    def score(self, texts: DataFrame) -> DataFrame:
        """``(id, score, predicted)`` per row of ``texts(id, text)``; others than those it was made with meet their counts again."""
        if texts.sameSemantics(self.texts):
            rows = self.features.where(F.col("role") < EXTRA)
        else:
            asked = chunks(texts.withColumn("role", F.lit(ASKED))).withColumn("chunk", -1 - F.col("chunk"))
            rows = features(self.states.unionByName(asked, allowMissingColumns=True)).where(F.col("role") == ASKED)
        weights = self.weights

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = sigmoid(matrix(batch.column(1)), weights)
                yield pa.record_batch([batch.column(0), made, (made >= 0.5).astype(np.int32)], ["id", "score", "predicted"])

        return rows.select("id", "x").mapInArrow(make, "id long, score double, predicted int")
