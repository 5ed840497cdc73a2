import random

import numpy as np
import pytest

from facetry.operators import pooling, vectors
from facetry.operators.pooling import EPSILON, Pooled
from facetry.session import materialize

KINDS = ("mean", "max", "attention", "softmax")


def brute(owner, v, scores, documents, kind):
    out = np.zeros((documents, v.shape[1]))
    for d in set(owner.tolist()):
        mine, e = v[owner == d], scores[owner == d]
        if kind == "mean":
            out[d] = mine.mean(0)
        elif kind == "max":
            out[d] = mine.max(0)
        else:
            a = np.exp(e - (e.max() if kind == "softmax" else 0.0))
            out[d] = (mine * a[:, None]).sum(0) / (a.sum() + EPSILON)
    return out


def made(documents, owner, v, scores, kinds, run):
    states = Pooled(documents, v.shape[1], kinds)
    for begin in range(0, len(owner), run):
        states.add(owner[begin : begin + run], v[begin : begin + run], scores[begin : begin + run])
    return states


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("run", [1, 7, 1000])
def test_runs_of_any_length_give_the_same(kind, run):
    rng = np.random.default_rng(run)
    owner = np.sort(rng.choice([0, 1, 2, 4, 7], 200))
    v = rng.normal(size=(200, 3))
    scores = rng.uniform(-3, 3, 200) if kind == "attention" else rng.choice([-1000.0, -999.0, 0.0, 999.5, 1000.0], 200)
    got = made(9, owner, v, scores, (kind,), run).result()
    assert np.allclose(got, brute(owner, v, scores, 9, kind), atol=1e-12)


def test_states_merge_in_any_order():
    rng = np.random.default_rng(3)
    parts = []
    for part in range(5):
        owner = np.sort(rng.choice(6, 30))
        # energies apart by more than the exponential function spans
        parts.append((owner, rng.normal(size=(30, 2)), rng.uniform(-1, 1, 30) + [-2000, -900, 0, 900, 2000][part]))
    every = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = list(range(5))
    for seed in range(6):
        random.Random(seed).shuffle(order)
        states = Pooled(6, 2, ("mean", "max", "softmax"))
        for k in order:
            states.merge(made(6, *parts[k], ("mean", "max", "softmax"), 11))
        got = states.result()
        want = np.hstack([brute(*every, 6, kind) for kind in ("mean", "max", "softmax")])
        assert np.allclose(got, want, atol=1e-12)


@pytest.mark.parametrize("scale", [1.0, 1000.0])
def test_both_plans_are_equal_for_energies_of_any_size(spark, scale):
    rng = random.Random(9)
    dim = 4
    table = materialize(
        spark.createDataFrame([(i, [rng.uniform(-2, 2) for _ in range(dim)]) for i in range(1, 40)], "idx long, v array<float>")
    )
    rows = [(d, [rng.randint(0, 45) for _ in range(rng.randint(0, 60))], [rng.uniform(-1, 1) for _ in range(2)]) for d in range(50)]
    docs = spark.createDataFrame(rows, "id long, seq array<int>, q array<double>").repartition(3)
    w_query, w_step = [[0.3, -0.2], [0.1, 0.4]], [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(dim)]
    found = []
    for in_tasks in (True, False):
        pooled = vectors.query_attention_pool(docs, table, dim, w_query, w_step, [scale, -scale], in_tasks=in_tasks)
        found.append({r["id"]: r["attention"] for r in pooled.collect()})
    assert found[0].keys() == found[1].keys() == {d for d, _, _ in rows}
    for d in found[0]:
        assert found[0][d] == pytest.approx(found[1][d], abs=1e-12)


def test_a_single_large_weight(spark):
    """Energies far below any fixed bound: the exponential function would be 0 for all of them."""
    table = materialize(spark.createDataFrame([(1, [-1.0]), (2, [-0.5])], "idx long, v array<float>"))
    docs = spark.createDataFrame([(1, [1, 2], [0.0])], "id long, seq array<int>, q array<double>")
    for in_tasks in (True, False):
        row = vectors.query_attention_pool(docs, table, 1, [[1.0]], [[1.0]], [500.0], in_tasks=in_tasks).first()
        assert row["attention"] == pytest.approx([-0.5], abs=1e-6)


@pytest.mark.parametrize("how", [np.add, np.maximum])
def test_rows_are_reduced_by_document(how):
    rng = np.random.default_rng(5)
    starts = np.unique(np.append(0, rng.integers(0, 700, 40)))
    values = rng.normal(size=(700, 9))
    assert np.allclose(pooling._by_document(how, values, starts), how.reduceat(values, starts), rtol=1e-12, atol=0 if how is np.maximum else 1e-12)
