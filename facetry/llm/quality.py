"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into bins at quantiles. Cyclic boosting visits the features in turn;
each visit fits a shallow tree (three leaves) on one feature's bins to the gradient of the
log-loss and adds a small step of it to that feature's lookup table. Then the pairs of features
whose cells explain most of what is left are chosen and boosted the same way, one split on
each side. Rounds stop when a held-back part of the sample no longer improves. A score is
the logistic function of the tables' entries at the text's bins: look-ups and additions over a
whole batch.

Training uses a bounded sample of labelled rows (``sample`` per class, in a fixed pseudo-random
order of the ids): their features, a few numbers a text, are boosted on the driver.

Defined cases: null counts as empty; a text without words has all features at zero and gets the
score of its bins. Without labels of both classes every score is 0.5 and every prediction 1. Labels
that are null, and ids with both labels, are not learned from. Ties at a bin's border go to the
upper bin. Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.toxicity import labelled_sample
from facetry.session import ship_package

FEATURES = (
    "log_words", "mean_word", "longest_word", "upper", "digits", "sentence_marks", "loud_marks",
    "other_marks", "non_ascii", "distinct_words", "commonest_word", "word_twice", "distinct_triples",
    "lines", "distinct_lines", "line_words", "ended_lines", "blanks",
)

_KIND = np.zeros(256, np.int64)  # byte classes: 1 upper, 2 digit, 3 sentence, 4 loud, 5 other, 6 beyond ASCII, 7 blank
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 5
_KIND[list(b".,;:'-()\"")] = 3
_KIND[list(b"!?*#$%&")] = 4
_KIND[128:] = 6
_KIND[list(b" \t\n\v\f\r")] = 7


def features(text: str | None) -> list[float]:
    """The numbers in ``FEATURES`` of one whole text."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=8) / len(data)
    sizes = [len(w) for w in words]
    tally = Counter(words)
    triples = len(set(zip(words, words[1:], words[2:]))) if n > 2 else n
    lines = [x for x in data.split(b"\n") if x.strip()]
    ended = sum(x.rstrip()[-1:] in b".!?:" for x in lines)
    twice = sum(a == b for a, b in zip(words, words[1:]))
    return [
        float(np.log1p(n)), len(b"".join(words)) / n, float(np.log1p(max(sizes))),
        kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6],
        len(tally) / n, tally.most_common(1)[0][1] / n, twice / n, triples / max(1, n - 2),
        len(lines) / n, len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), ended / len(lines), kinds[7],
    ]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(grad: np.ndarray, hess: np.ndarray, ridge: float) -> np.ndarray:
    return grad / (hess + ridge)


class AdditiveModel:
    """Lookup tables per feature and per chosen pair of features."""

    def __init__(self, bins: int = 32, pair_bins: int = 8, pairs: int = 8, rate: float = 0.1, rounds: int = 300, ridge: float = 5.0):
        self.n_bins, self.n_pair_bins, self.n_pairs = bins, pair_bins, pairs
        self.rate, self.rounds, self.ridge = rate, rounds, ridge

    @staticmethod
    def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
        inner = np.linspace(0, 1, bins + 1)[1:-1]
        return [np.unique(np.quantile(column, inner)) for column in x.T]

    @staticmethod
    def _bin(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, v, side="right") for c, v in zip(cuts, x.T, strict=True)])

    def _tree(self, g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
        """Values per bin of a tree with up to ``leaves`` leaves, split where the gain is largest."""
        edges = [0, len(g)]
        sums = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
        part = lambda a, b: ((sums[0][b] - sums[0][a]) ** 2) / (sums[1][b] - sums[1][a] + self.ridge)
        while len(edges) <= leaves:
            best = (1e-9, None)
            for a, b in zip(edges, edges[1:], strict=False):
                at = np.arange(a + 1, b)
                if len(at):
                    gain = part(a, at) + part(at, b) - part(a, b)
                    i = int(np.argmax(gain))
                    best = max(best, (float(gain[i]), int(at[i])), key=lambda x: x[0])
            if best[1] is None:
                break
            edges = sorted([*edges, best[1]])
        out = np.zeros(len(g))
        for a, b in zip(edges, edges[1:], strict=False):
            out[a:b] = _step(sums[0][b] - sums[0][a], sums[1][b] - sums[1][a], self.ridge)
        return out

    def _cross(self, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """Gain and values of the best pair of splits of a table: one on each side, four leaves."""
        down = lambda t: np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        G, H = down(g), down(h)
        rows, columns = g.shape
        if rows < 2 or columns < 2:
            return 0.0, np.zeros_like(g)
        a, b = np.arange(1, rows)[:, None], np.arange(1, columns)[None, :]
        parts = lambda T: [
            T[a, b], T[a, columns] - T[a, b], T[rows, b] - T[a, b], T[rows, columns] - T[a, columns] - T[rows, b] + T[a, b]
        ]
        gains = sum(x**2 / (y + self.ridge) for x, y in zip(parts(G), parts(H), strict=True))
        i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
        values = [_step(x[i, j], y[i, j], self.ridge) for x, y in zip(parts(G), parts(H), strict=True)]
        out = np.empty_like(g)
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
        return float(gains[i, j]), out

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Boost on most rows, stop by every fifth one (rows come in a fixed pseudo-random order)."""
        self.cuts, self.pair_cuts = self._cuts(x, self.n_bins), self._cuts(x, self.n_pair_bins)
        bins, coarse = self._bin(x, self.cuts), self._bin(x, self.pair_cuts)
        check = np.arange(len(y)) % 5 == 0
        fit = ~check
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs, self.pair_tables = [], []
        total = np.full(len(y), self.base)

        def boost(visit, tables) -> None:
            nonlocal total
            best, kept, since = np.inf, [t.copy() for t in tables], 0
            best_total = total.copy()
            for _ in range(self.rounds):
                visit()
                p = _sigmoid(total[check])
                loss = -np.mean(np.where(y[check] == 1, np.log(p + 1e-12), np.log(1 - p + 1e-12))) if check.any() else 0.0
                if loss < best - 1e-5:
                    best, kept, since, best_total = loss, [t.copy() for t in tables], 0, total.copy()
                else:
                    since += 1
                if since >= 20:
                    break
            tables[:] = kept
            total = best_total

        def gradient() -> tuple[np.ndarray, np.ndarray]:
            p = _sigmoid(total)
            return np.where(fit, y - p, 0.0), np.where(fit, p * (1 - p), 0.0)

        def single() -> None:
            nonlocal total
            for f, table in enumerate(self.tables):
                g, h = gradient()
                at = bins[:, f]
                step = self.rate * self._tree(np.bincount(at, g, len(table)), np.bincount(at, h, len(table)))
                table += step
                total = total + step[at]

        boost(single, self.tables)

        shapes = [len(c) + 1 for c in self.pair_cuts]

        def cells(i: int, j: int, v: np.ndarray) -> np.ndarray:
            return np.bincount(coarse[:, i] * shapes[j] + coarse[:, j], v, shapes[i] * shapes[j]).reshape(shapes[i], shapes[j])

        g, h = gradient()
        ranked = sorted(
            combinations(range(x.shape[1]), 2), key=lambda p: -self._cross(cells(*p, g), cells(*p, h))[0]
        )
        self.pairs = ranked[: self.n_pairs]
        self.pair_tables = [np.zeros((shapes[i], shapes[j])) for i, j in self.pairs]

        def double() -> None:
            nonlocal total
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                g, h = gradient()
                step = self.rate * self._cross(cells(i, j, g), cells(i, j, h))[1]
                table += step
                total = total + step[coarse[:, i], coarse[:, j]]

        boost(double, self.pair_tables)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of a whole batch: one look-up per table, added up."""
        bins, coarse = self._bin(x, self.cuts), self._bin(x, self.pair_cuts)
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[bins[:, f]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[:, i], coarse[:, j]]
        return _sigmoid(total)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([features(t.as_py()) for t in column], float).reshape(-1, len(FEATURES))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 10_000,
) -> AdditiveModel | None:
    """Fit on ``labels`` where ``learn`` holds (a condition on the id); None without both classes."""
    ship_package(docs.sparkSession)
    chosen = labelled_sample(labels, doc_id, label, learn, sample)
    if chosen.select("y").distinct().count() < 2:
        return None

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["id", "y", "x"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    made = rows.select("id", "y", "text").mapInArrow(make, "id long, y int, x array<double>")
    # one row per id, the one with the smallest features: rows that repeat an id must not pass the sample's bound
    each = made.groupBy("id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    # a fixed order, whatever the layout
    got = each.select("y", "x", F.md5(F.col("id").cast("string")).alias("place")).toPandas()
    got = got.assign(key=[tuple(v) for v in got["x"]]).sort_values(["place", "key"])
    return AdditiveModel().fit(np.array(got["x"].tolist()), got["y"].to_numpy(float)) if got["y"].nunique() == 2 else None


def _scored(model: AdditiveModel | None, column: pa.Array) -> np.ndarray:
    if model is None or not len(column):
        return np.full(len(column), 0.5)
    return model.score(_matrix(column))


def predict(docs: DataFrame, model: AdditiveModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` per row, from the text alone."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _scored(shared.value, batch.column(1))
            yield pa.record_batch(
                [batch.column(0), pa.array(made), pa.array((made >= 0.5).astype(np.int32))], ["id", "score", "predicted"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, "id long, score double, predicted int").withColumnRenamed("id", doc_id)


def keep_good(docs: DataFrame, model: AdditiveModel | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all columns, without a shuffle."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scored(shared.value, batch.column(at)) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
