"""One multinomial classifier per aspect, all aspects trained and applied together.

The coefficients of all aspects are one matrix: features and an intercept by (aspect, class). A pass over
the training table is one job: per Arrow batch one matrix product gives the scores of all aspects and a
second one their gradient; tasks return their sums, which are added up in a tree. The driver holds the matrix
only, whose size does not depend on the table's. After every pass the state is kept as Parquet, so a run
that was stopped goes on where it was, and the pass that computes a state's gradient also counts how
the state classifies the validation rows.

Features are standardised by the training rows' mean and standard deviation. A step is

* by default preconditioned: the curvature of the multinomial likelihood is at most half of the features'
  second moments (Boehning's bound), so multiplying the gradient with that bound's inverse never
  overshoots and needs no search along the line;
* with ``step`` given, plainly ``step`` times the gradient.

A row without a label for an aspect does not count for it; as the aspects share nothing but the passes, each
gets what it would get alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetry.functions.arrays import argmax_class
from facetry.operators.metrics import align, confusion, macro, running_best
from facetry.schema import ASPECTS, CLASSES, aspect_name
from facetry.session import materialize, ship_package
from facetry.sources.artifacts import is_complete

ALL_ASPECTS = tuple(i for i, _, _ in ASPECTS)
PART = 1 << 16  # numbers in one row of a sum
LANES = 32  # sums that tasks' rows are first added up to


def training_table(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features joined with the wide labels once, written out for the passes to share."""
    return materialize(features.join(labels, "id"))


def _array(table: DataFrame) -> Column:
    """The feature column as an array, if it is not one."""
    is_array = isinstance(table.schema["features"].dataType, T.ArrayType)
    return (F.col("features") if is_array else vector_to_array("features")).alias("features")


def class_places(aspects: Sequence[int], columns: dict[int, str] | None, classes: Sequence[int]) -> Column:
    """Each aspect's label as its place in the class order, -1 for none; a label outside is an error."""
    places = []
    for aspect in aspects:
        y = F.col((columns or {}).get(aspect) or aspect_name(aspect))
        failed = F.raise_error(F.lit("a label outside the classes")).cast("int")
        place = F.array_position(F.array(*[F.lit(c) for c in classes]), y).cast("int") - 1
        places.append(F.when(y.isNull(), F.lit(-1)).when(y.isin(*classes), place).otherwise(failed))
    return F.array(*places)


def matrix(lists: pa.ListArray, width: int | None = None) -> np.ndarray:
    """A list column as a matrix; rows of another width, and nulls, are an error."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    width = len(values) // len(lists) if width is None and len(lists) else width or 0
    if lists.null_count or (lists.value_lengths().to_numpy(zero_copy_only=False) != width).any():
        raise ValueError(f"features that are not {width} numbers")
    return values.reshape(len(lists), width).astype(float)


def softmax(scores: np.ndarray, classes: int) -> np.ndarray:
    """``(row, aspect, class)`` from one row of scores per row."""
    cells = scores.reshape(len(scores), -1, classes)
    cells = np.exp(cells - cells.max(axis=2, keepdims=True))
    return cells / cells.sum(axis=2, keepdims=True)


def summed(rows: DataFrame, partial, *columns: str) -> np.ndarray:
    """The sum over all tasks of the array that ``partial(batches)`` returns in each, added in a tree.

    Parts of the array travel as bytes. They are added in the order of the tasks, so that a rerun over the same
    partitions gives the same floating point sums.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = partial(batches)
        if made is None:
            return
        flat, task = np.ascontiguousarray(made, dtype="<f8").ravel(), TaskContext.get().partitionId()
        for part, begin in enumerate(range(0, len(flat), PART)):
            data = flat[begin : begin + PART].tobytes()
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([task], pa.int32()), pa.array([data])], ["part", "task", "data"])

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table["task"].to_numpy(), kind="stable")
        data = table["data"].to_pylist()
        total = np.zeros(len(data[0]) // 8)
        for k in order:
            total += np.frombuffer(data[k], "<f8")
        return pa.table({"part": table["part"][:1], "task": pa.array([int(table["task"].to_numpy().min())], pa.int32()), "data": [total.tobytes()]})

    schema = "part int, task int, data binary"
    parts = rows.select(*columns).mapInArrow(make, schema).withColumn("lane", F.pmod("task", F.lit(LANES)))
    lanes = parts.groupBy("part", "lane").applyInArrow(lambda t: add(t.drop_columns(["lane"])), schema)
    found = {r["part"]: r["data"] for r in lanes.groupBy("part").applyInArrow(add, schema).collect()}
    return np.concatenate([np.zeros(0), *[np.frombuffer(found[k], "<f8") for k in sorted(found)]])


class State:
    """Coefficients after some passes: ``w`` is (features + 1, aspects x classes), the last row the intercepts.

    ``w`` belongs to standardised features, ``raw`` to the features as they are.
    """

    def __init__(self, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, aspects: Sequence[int], classes: Sequence[int]):
        self.mean, self.scale, self.w = mean, scale, w
        self.aspects, self.classes = tuple(aspects), tuple(classes)

    @property
    def raw(self) -> np.ndarray:
        slopes = self.w[:-1] / self.scale[:, None]
        return np.vstack([slopes, self.w[-1:] - self.mean @ slopes])

    def of(self, aspects: Sequence[int]) -> np.ndarray:
        """``raw`` for some of the aspects."""
        missing = [a for a in aspects if a not in self.aspects]
        if missing:
            raise ValueError(f"no model of aspect {missing[0]}")
        cells = self.raw.reshape(len(self.w), len(self.aspects), -1)
        return cells[:, [self.aspects.index(a) for a in aspects]].reshape(len(self.w), -1)


def state_path(model_dir: str, epoch: int) -> str:
    return f"{model_dir}/state/pass={epoch:02d}"


def save_state(spark: SparkSession, state: State, path: str) -> None:
    """One row per feature, the intercepts as feature -1."""
    features = [*range(len(state.mean)), -1]
    table = pa.table(
        {
            "feature": pa.array(features, pa.int32()),
            "mean": np.append(state.mean, 0.0),
            "scale": np.append(state.scale, 1.0),
            "w": pa.array(list(state.w), pa.list_(pa.float64())),
            "aspects": pa.array([state.aspects] * len(features), pa.list_(pa.int32())),
            "classes": pa.array([state.classes] * len(features), pa.list_(pa.int32())),
        }
    )
    spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> State:
    table = spark.read.parquet(path).toArrow()
    feature = table["feature"].to_numpy()
    order = np.argsort(np.where(feature < 0, len(feature), feature))
    columns = {c: table[c].to_numpy()[order] for c in ("mean", "scale")}
    w = np.array(table["w"].to_pylist(), float).reshape(len(feature), -1)[order]
    first = table.slice(0, 1)
    return State(columns["mean"][:-1], columns["scale"][:-1], w, first["aspects"][0].as_py(), first["classes"][0].as_py())


def _moments(rows: DataFrame, width: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Number of training rows, their features' means and second moments, in one pass."""

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = matrix(batch.column(0), width)
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        return total

    total = summed(rows.where("NOT held"), partial, "features").reshape(-1, width + 1)
    if not total.size or not total[-1, -1]:
        return 0.0, np.zeros(width), np.zeros((width, width))
    n = total[-1, -1]
    return n, total[-1, :-1] / n, total[:-1, :-1] / n


def _pass(rows: DataFrame, state: State) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient sums and label counts of the training rows, confusion counts of the validation rows."""
    raw, mean, scale = state.raw, state.mean, state.scale
    aspects, classes, width = len(state.aspects), len(state.classes), len(mean)
    shared = rows.sparkSession.sparkContext.broadcast(raw)

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        given = shared.value
        gradient, n, counts = np.zeros(given.shape), np.zeros(aspects), np.zeros((aspects, classes, classes))
        for batch in batches:
            x, y = matrix(batch.column(0), width), matrix(batch.column(1), aspects).astype(int)
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            p = softmax(x @ given[:-1] + given[-1], classes)
            known = (y >= 0) & ~held[:, None]
            row, aspect = np.nonzero(known)
            p_learn = np.where(known[:, :, None], p, 0.0)
            p_learn[row, aspect, y[row, aspect]] -= 1.0
            z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
            gradient += z.T @ p_learn.reshape(len(x), -1)
            n += known.sum(axis=0)
            row, aspect = np.nonzero((y >= 0) & held[:, None])
            np.add.at(counts, (aspect, y[row, aspect], p[row, aspect].argmax(axis=1)), 1)
        return np.concatenate([gradient.ravel(), n, counts.ravel()])

    total = summed(rows, partial, "features", "y", "held")
    if not total.size:
        total = np.zeros(raw.size + aspects + aspects * classes * classes)
    gradient, n, counts = np.split(total, [raw.size, raw.size + aspects])
    return gradient.reshape(raw.shape), n, counts.reshape(aspects, classes, classes)


def train(
    table: DataFrame,
    model_dir: str,
    aspects: Sequence[int] = ALL_ASPECTS,
    passes: int = 10,
    columns: dict[int, str] | None = None,
    classes: Sequence[int] = CLASSES,
    reg: float = 0.01,
    step: float | None = None,
    validation: DataFrame | None = None,
) -> None:
    """Train all aspects by ``passes`` passes over ``table(features, <labels>)`` and keep every pass's state.

    ``validation`` has the same columns; ``history`` reads how each state did on it. A folder belongs
    to one training: what is there is kept and gone on from.
    """
    spark = table.sparkSession
    ship_package(spark)
    y = class_places(aspects, columns, classes).alias("y")
    rows = table.select(_array(table), y, F.lit(False).alias("held"))
    if validation is not None:
        rows = rows.unionByName(validation.select(_array(validation), y, F.lit(True).alias("held")))
    last = max((k for k in range(passes + 1) if is_complete(spark, state_path(model_dir, k))), default=None)
    first = rows.select(F.size("features").alias("n")).limit(1).collect()
    width = first[0]["n"] if first else 0
    n, mean, products = _moments(rows, width)
    spread = products - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
    scale[scale < 1e-12] = 1.0  # a feature that never changes
    if last is None:
        last = 0
        save_state(spark, State(mean, scale, np.zeros((width + 1, len(aspects) * len(classes))), aspects, classes), state_path(model_dir, 0))
    bound = np.zeros((width + 1, width + 1))
    bound[:-1, :-1], bound[-1, -1] = spread / np.outer(scale, scale), 1.0
    ridge = np.full((width + 1, 1), reg)
    ridge[-1] = 0.0
    while last <= passes:
        state = load_state(spark, state_path(model_dir, last))
        if last == passes and (validation is None or is_complete(spark, _counts_path(model_dir, last))):
            break
        gradient, labelled, counts = _pass(rows, state)
        if validation is not None and last:
            _save_counts(spark, counts, state, last, _counts_path(model_dir, last))
        if last == passes:
            break
        w = state.w.reshape(width + 1, len(aspects), -1).copy()
        gradient = gradient.reshape(w.shape)
        for a in range(len(aspects)):
            if labelled[a]:
                slope = gradient[:, a] / labelled[a] + ridge * w[:, a]
                # the bound over all rows also holds for the part of them that has a label
                curve = bound * (0.5 * n / labelled[a]) + np.diag(ridge[:, 0] + 1e-9)
                w[:, a] -= np.linalg.solve(curve, slope) if step is None else step * slope
        last += 1
        save_state(spark, State(mean, scale, w.reshape(width + 1, -1), aspects, classes), state_path(model_dir, last))


def _counts_path(model_dir: str, epoch: int) -> str:
    return f"{model_dir}/validated/pass={epoch:02d}"


def _save_counts(spark: SparkSession, counts: np.ndarray, state: State, epoch: int, path: str) -> None:
    rows = [
        (state.aspects[a], epoch, state.classes[y], state.classes[p], int(n)) for (a, y, p), n in np.ndenumerate(counts) if n
    ]
    schema = "aspect_idx int, epoch int, y int, yhat int, n long"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def history(spark: SparkSession, model_dir: str, passes: int) -> DataFrame:
    """``(aspect_idx, epoch, precision, recall, f1, best_f1)`` of the validation inside the training."""
    keys = ("aspect_idx", "epoch")
    counts = spark.read.parquet(*[_counts_path(model_dir, k) for k in range(1, passes + 1)])
    return running_best(macro(counts, keys))


def score(
    features: DataFrame,
    model_dir: str,
    aspects: Sequence[int] = ALL_ASPECTS,
    epoch: int = 10,
    model: str = "model",
    classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """``(id, aspect_idx, model, p, yhat)``: all aspects by one matrix product per batch."""
    state = load_state(features.sparkSession, state_path(model_dir, epoch))
    if state.classes != tuple(classes):
        raise ValueError(f"the model's classes are {state.classes}")
    return score_matrix(features, state.of(aspects), aspects, classes, model)


def score_matrix(features: DataFrame, w: np.ndarray, aspects: Sequence[int], classes: Sequence[int], model: str = "model") -> DataFrame:
    """``score`` by coefficients as a matrix: features and, last, the intercepts by (aspect, class)."""
    spark = features.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(w)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        for batch in batches:
            x = matrix(batch.column(1), len(given) - 1)
            yield long_scores(batch.column(0), softmax(x @ given[:-1] + given[-1], len(classes)), aspects)

    kind = features.schema["id"].dataType.simpleString()
    rows = features.select("id", _array(features)).mapInArrow(make, f"id {kind}, aspect_idx int, p array<double>")
    return labelled(rows, classes, model)


def long_scores(ids: pa.Array, p: np.ndarray, aspects: Sequence[int]) -> pa.RecordBatch:
    """One row per document and aspect."""
    n, width = len(ids), len(aspects)
    offsets = np.arange(n * width + 1, dtype=np.int32) * p.shape[2]
    columns = [
        ids.take(pa.array(np.repeat(np.arange(n), width))),
        pa.array(np.tile(np.array(aspects, np.int32), n)),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel())),
    ]
    return pa.record_batch(columns, ["id", "aspect_idx", "p"])


def labelled(rows: DataFrame, classes: Sequence[int], model: str) -> DataFrame:
    return rows.select("id", "aspect_idx", F.lit(model).alias("model"), "p").withColumn("yhat", argmax_class("p", classes))


def epoch_history(
    features: DataFrame,
    gold: DataFrame,
    model_dir: str,
    aspects: Sequence[int],
    epochs: Sequence[int],
    classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """``(aspect_idx, epoch, precision, recall, f1, best_f1)`` of kept states on any table.

    ``gold`` is ``(id, aspect_idx, y)``. The states are set side by side, as if they were more aspects, so
    the table is scored once.
    """
    states = [load_state(features.sparkSession, state_path(model_dir, e)).of(aspects) for e in epochs]
    every = [e * _APART + a for e in epochs for a in aspects]
    scored = score_matrix(features, np.hstack(states), every, classes).select(
        "id", F.pmod("aspect_idx", F.lit(_APART)).cast("int").alias("aspect_idx"), F.floor(F.col("aspect_idx") / _APART).cast("int").alias("epoch"), "yhat"
    )
    rows = gold.select("id", "aspect_idx", F.explode(F.array(*[F.lit(e) for e in epochs])).alias("epoch"), "y")
    keys = ("aspect_idx", "epoch")
    return running_best(macro(confusion(align(scored, rows, ("id", *keys)), keys), keys))


_APART = 1 << 16  # more than any aspect's number
