"""Language identification: word-first backoff.

A word seen in training is scored by its log frequency per language. A word not seen is scored
by its character n-grams with word borders, the longest order first; if none of its n-grams of an
order is known, the next shorter order is tried. A text's language is the one with the largest sum
over all its words, repeats counted; the score is that language's share of the posterior, the sums
divided by the square root of the words so that long texts do not all read 1.

Training counts words on Spark over a bounded sample of labelled documents (about ``sample`` rows
per language, drawn by a hash of the id). All words of these documents are kept, however rare, and so are
all their n-grams, weighted by the words' counts; a language whose words all occur once loses
nothing. The number of sampled documents bounds the model, which is broadcast.

Defined cases: a word is a run of letters (Unicode category L), lower-cased; a null text or one without a letter is
``und`` with score 0; with no labelled text everything is ``und``. Ties go to the first language
by name. A word whose characters were never seen adds nothing; if that holds for all words the
frequency of the languages decides. Null ids and repeated rows are scored like any other row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import LETTER_RUN, LETTERS
from facetry.session import materialize, ship_package

UNKNOWN = "und"
CACHE_WORDS, CACHE_LETTERS = 200_000, 64  # of words not seen in training, per worker process


class Table:
    """Log frequencies of keys per language, centred over the languages: only differences decide."""

    def __init__(self, keys: list[str], counts: np.ndarray, floor: float):
        self.row = {key: i for i, key in enumerate(keys)}
        logs = np.log((counts + floor) / (counts.sum(axis=0) + floor * max(1, len(keys))))
        self.logs = (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


class Model:
    """Word and character n-gram tables; ``counts`` maps (word, language) to a number of words."""

    def __init__(self, counts: dict[tuple[str, str], int], docs: dict[str, int], orders: int = 5, floor: float = 0.5):
        self.langs = sorted(docs)
        self.orders = orders
        column = {lang: i for i, lang in enumerate(self.langs)}
        tables: list[dict[str, list[float]]] = [{} for _ in range(orders + 1)]
        zero = [0.0] * len(column)
        for (word, lang), n in counts.items():
            tables[0].setdefault(word, zero[:])[column[lang]] += n
            for order in range(1, orders + 1):
                for gram in self.split(word, order):
                    # the square root keeps a few very frequent words from being all that counts
                    tables[order].setdefault(gram, zero[:])[column[lang]] += n**0.5
        shape = (-1, len(column))
        made = [Table(list(t), np.array(list(t.values()), float).reshape(shape), floor) for t in tables] if column else []
        self.words, self.grams = (made[0], made) if made else (None, [])
        total = sum(docs.values())
        self.prior = np.log(np.array([(docs[lang] + 1) / (total + len(docs)) for lang in self.langs] or [1.0]))

    @staticmethod
    def split(word: str, order: int) -> list[str]:
        edged = f" {word} " if order > 1 else word
        return [edged[i : i + order] for i in range(len(edged) - order + 1)]

    def unseen(self, word: str) -> np.ndarray:
        """Mean over the known n-grams of the longest order that has any; zeros if none has."""
        for order in range(self.orders, 0, -1):
            table = self.grams[order]
            get = table.row.get
            known = [i for x in self.split(word, order) if (i := get(x)) is not None]
            if known:
                return np.add.reduce(table.logs[known]) / np.float32(len(known))
        return np.zeros(len(self.langs), np.float32)

    def _open_cache(self) -> None:
        """Places of the words seen, and room for words that were not; kept by the worker."""
        self.place = dict(self.words.row)
        self.vectors = np.concatenate([self.words.logs, np.zeros((CACHE_WORDS, len(self.langs)), np.float32)])
        self.used = len(self.words.row)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("place", "vectors", "used")}

    def _remember(self, word: str) -> int:
        self.vectors[self.used] = self.unseen(word)
        self.place[word] = self.used
        self.used += 1
        return self.used - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        tally = Counter(LETTERS.findall((text or "").lower()))
        if not tally or not self.langs:
            return UNKNOWN, 0.0
        if not hasattr(self, "place") or self.used + len(tally) > len(self.vectors):
            self._open_cache()
        at = list(map(self.place.get, tally))
        n = np.fromiter(tally.values(), np.float64, len(tally))
        rest = np.zeros(len(self.langs))
        if None in at:
            for i, (word, found) in enumerate(zip(tally, at, strict=True)):
                if found is None:
                    if len(word) <= CACHE_LETTERS and self.used < len(self.vectors):
                        at[i] = self._remember(word)
                    else:
                        rest += n[i] * self.unseen(word)
                        at[i], n[i] = 0, 0.0
        total = n @ self.vectors[at] + rest
        scaled = self.prior + total / sum(tally.values()) ** 0.5
        scaled = np.exp(scaled - scaled.max())
        best = int(np.argmax(self.prior + total))
        return self.langs[best], float(scaled[best] / scaled.sum())


def train(
    docs: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = 1000,
) -> Model:
    """Fit on about ``sample`` documents per language among those where ``learn`` holds."""
    usable = docs.where(
        learn & F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull()
    ).select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("body"))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model({}, {})
    # a document is in the sample when its hash falls under its language's share
    shares = F.create_map(*[F.lit(x) for pair in sizes.items() for x in (pair[0], sample / pair[1])])
    draw = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)
    chosen = usable.where(draw < F.element_at(shares, F.col("lang")))
    words = chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("body"), F.lit(LETTER_RUN), F.lit(0))).alias("word"))
    counted = materialize(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    counts = counted.toPandas().sort_values(["word", "lang"])
    table = {(w, x): int(n) for x, w, n in zip(counts["lang"], counts["word"], counts["n"], strict=True)}
    return Model(table, sizes)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row, from the text alone."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            made = [fitted.predict(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double").withColumnRenamed("doc_id", doc_id)
