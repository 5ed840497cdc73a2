import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetry.operators import bayes, models
from facetry.plans import catalog
from facetry.schema import ASPECT_COLUMNS, CLASSES

D = 5


def made(rows=150, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, D)) * [1, 10, 0.1, 1, 0] + [0, 5, 0, 0, 3]
    y = np.array([[CLASSES[int(v) % 4] for v in np.floor(np.abs(x[:, :4].sum(1) * (a + 1)))] for a in range(20)]).T
    return x, y


def frame(spark, x, y, missing=False):
    rows = [
        (i, x[i].tolist(), *[None if missing and (i + a) % 7 == 0 else int(y[i, a]) for a in range(20)]) for i in range(len(x))
    ]
    schema = "id long, features array<double>, " + ", ".join(f"{c} int" for c in ASPECT_COLUMNS)
    return spark.createDataFrame(rows, schema).repartition(3)


def brute(x, y, known, passes, step, reg):
    """One aspect: scaled features, plain gradient steps or steps by the curvature's bound."""
    mean, sd = x.mean(0), x.std(0)
    sd = np.where(sd < 1e-12, 1.0, sd)
    z = np.hstack([(x - mean) / sd, np.ones((len(x), 1))])
    ridge = np.append(np.full(x.shape[1], reg), 0.0)[:, None]
    w = np.zeros((x.shape[1] + 1, 4))
    hot = (y[:, None] == np.array(CLASSES)).astype(float)
    for _ in range(passes):
        e = np.exp(z @ w - (z @ w).max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        g = z[known].T @ (p - hot)[known] / known.sum() + ridge * w
        if step:
            w = w - step * g
        else:
            w = w - np.linalg.solve(z.T @ z / (2 * known.sum()) + np.diag(ridge[:, 0] + 1e-9), g)
    e = np.exp(z @ w - (z @ w).max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@pytest.mark.parametrize("step", [None, 0.7])
def test_all_aspects_at_once_equal_single_fits(spark, tmp_path, step):
    x, y = made()
    table = frame(spark, x, y, missing=True)
    models.train(table, str(tmp_path / "all"), passes=4, step=step)
    got = {(r["id"], r["aspect_idx"]): r for r in models.score(table, str(tmp_path / "all"), epoch=4).collect()}
    assert len(got) == 20 * len(x)
    for aspect in range(1, 21):
        known = np.array([(i + aspect - 1) % 7 != 0 for i in range(len(x))])
        want = brute(x, y[:, aspect - 1], known, 4, step, 0.01)
        assert np.allclose([got[i, aspect]["p"] for i in range(len(x))], want, atol=1e-8)
    models.train(table, str(tmp_path / "one"), (7,), 4, step=step)
    whole, one = (models.load_state(spark, models.state_path(str(tmp_path / n), 4)) for n in ("all", "one"))
    assert np.allclose(whole.of((7,)), one.raw, atol=1e-9)


def test_every_pass_lowers_the_loss(spark, tmp_path):
    x, y = made()
    table = frame(spark, x, y)
    models.train(table, str(tmp_path), (1, 2), 6, reg=0.0)
    losses = []
    for k in range(7):
        p = models.score(table, str(tmp_path), (1, 2), k).collect()
        losses.append(-np.mean([math.log(r["p"][CLASSES.index(int(y[r["id"], r["aspect_idx"] - 1]))]) for r in p]))
    assert losses[0] == pytest.approx(math.log(4))
    assert all(b < a for a, b in zip(losses, losses[1:], strict=False))


def test_a_stopped_run_goes_on_from_its_last_pass(spark, tmp_path, monkeypatch):
    x, y = made()
    table, held = frame(spark, x[:100], y[:100]), frame(spark, x[100:], y[100:])
    models.train(table, str(tmp_path / "whole"), passes=8, validation=held)
    done = []
    once = models._pass

    def counting(rows, state):
        done.append(1)
        return once(rows, state)

    monkeypatch.setattr(models, "_pass", counting)
    models.train(table, str(tmp_path / "parts"), passes=5, validation=held)
    assert len(done) == 6  # five steps, and the last state's validation
    done.clear()
    models.train(table, str(tmp_path / "parts"), passes=8, validation=held)
    assert len(done) == 4  # three steps more, and the last state's validation
    done.clear()
    models.train(table, str(tmp_path / "parts"), passes=8, validation=held)
    assert not done
    a, b = (models.load_state(spark, models.state_path(str(tmp_path / n), 8)) for n in ("whole", "parts"))
    assert np.array_equal(a.w, b.w)
    whole, parts = (models.history(spark, str(tmp_path / n), 8).collect() for n in ("whole", "parts"))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts)) and len(whole) == 160


def test_labels_outside_the_classes_and_odd_features_are_errors(spark, tmp_path):
    rows = [(i, [float(i % 2), 1.0], (0, 1, None)[i % 3]) for i in range(30)]
    table = spark.createDataFrame(rows, "id long, features array<double>, quality int")
    models.train(table, str(tmp_path / "m"), (1,), 2, {1: "quality"}, classes=(0, 1))
    bad = table.unionByName(table.where("id = 0").withColumn("quality", F.lit(7)))
    with pytest.raises(Exception, match="outside the classes"):
        models.train(bad, str(tmp_path / "n"), (1,), 2, {1: "quality"}, classes=(0, 1))
    short = table.withColumn("features", F.when(F.col("id") < 29, F.col("features")).otherwise(F.array(F.lit(1.0))))
    with pytest.raises(Exception, match="not 2 numbers"):
        models.score(short, str(tmp_path / "m"), (1,), 2, classes=(0, 1)).collect()
    with pytest.raises(ValueError, match="no model of aspect"):
        models.score(table, str(tmp_path / "m"), (2,), 2, classes=(0, 1))


def test_a_table_without_rows(spark, tmp_path):
    schema = "id long, features array<double>, quality int"
    models.train(spark.createDataFrame([], schema), str(tmp_path), (1,), 2, {1: "quality"}, classes=(0, 1))
    assert models.load_state(spark, models.state_path(str(tmp_path), 2)).w.tolist() == [[0.0, 0.0]]


@pytest.mark.parametrize("small", [True, False])
def test_naive_bayes_against_its_formula(spark, tmp_path, small):
    rng = random.Random(3)
    rows = [(i, rng.choices(range(9), k=rng.randint(0, 12)), i % 2, i % 3) for i in range(40)]
    rows += [(50, None, 0, 0), (51, [], 1, 1), (52, [6, 6, 7], 1, 2)]
    seqs = spark.createDataFrame([(i, s) for i, s, _, _ in rows], "id long, seq array<int>").repartition(3)
    labels = spark.createDataFrame([(i, y, z if z < 2 else None) for i, _, y, z in rows if i < 25] + [(99, 1, 1)], "id long, quality int, toxic int")
    packed = bayes.pack(seqs)
    model = bayes.train(packed, labels, 6, (1, 2), {1: "quality", 2: "toxic"}, (0, 1))
    got = {(r["id"], r["aspect_idx"]): r["p"][1] for r in bayes.score(packed, model, 6, T.LongType(), (1, 2), (0, 1), small=small).collect()}
    assert len(got) == 2 * len(rows)
    for aspect in (1, 2):
        learn = [(s or [], row) for i, s, *row in rows if i < 25 and (aspect == 1 or row[1] < 2)]
        seen = [[t for s, row in learn if row[aspect - 1] == c for t in s if 1 <= t <= 6] for c in (0, 1)]
        docs = [sum(row[aspect - 1] == c for _, row in learn) for c in (0, 1)]
        for i, s, *_ in rows:
            log = [
                math.log((docs[c] + 1) / (sum(docs) + 2))
                + sum(math.log((seen[c].count(t) + 1) / (len(seen[c]) + 6)) for t in s or [] if 1 <= t <= 6)
                for c in (0, 1)
            ]
            assert got[i, aspect] == pytest.approx(1 / (1 + math.exp(log[0] - log[1])))


def test_letters_are_counted_once_per_text(spark, tmp_path):
    texts = ["", None, "e", "éE e" * 7, "t" * 30 + "x" * 70, "sentence " * 5000, "\x00\n日本e"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made = catalog._letter_labels(spark, str(tmp_path))
    want = {}
    for i, t in enumerate(texts):
        cells = [sum(t.count(c) * 100 >= len(t) * b for b in catalog.CLASS_BORDERS) - 2 if t else None for c in catalog.ASPECT_LETTERS]
        want[i] = tuple(cells)
    assert {r["id"]: tuple(r)[1:] for r in made.collect()} == want
    # a text was searched up to three times per letter before
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "replace" not in plan and plan.count("count(") == 1
