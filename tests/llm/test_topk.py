import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetry.llm import topk
from facetry.llm.topk import top_k


def brute(rows, k=5, step=50, scale=256):
    vectors, queries = set(), {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(float(np.float32(x)) * scale) for x in v]
        vectors.add((i, tuple(whole)))
        if i % step == 0:
            queries[i] = min(queries.get(i, tuple(whole)), tuple(whole))
    out = []
    for q, a in queries.items():
        scored = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q and len(a) == len(b)))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, top_k(frame, F.col("id") % 50 == 0, **options).collect()))


@pytest.mark.parametrize("block_rows", [20, 8192])
def test_against_brute_force(spark, block_rows):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(301)]
    rows += [(400 + i, [0.25, -0.5, 0.0, 0.0, 1.0, 1.0]) for i in range(60)]  # ties
    assert run(spark, rows, block_rows=block_rows, chunk_queries=3) == brute(rows)


def test_edge_cases(spark):
    rows = [
        (0, [1.0, 2.0]), (50, [1.0]), (100, None), (150, [1.0, None]), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]),
        (None, [1.0, 1.0]), (1, [-3.0, 0.5]), (1, [-3.0, 0.25]), (300, []), (2, []), (350, [0.0, 0.0]), (-50, [1.0, 2.0]), (7, [1.0, 2.0]),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []


def test_every_vector_of_a_repeated_id_is_a_candidate(spark):
    rows = [(50, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [9.0, 0.0]), (7, [9.0, 0.0]), (50, [2.0, 0.0]), (100, [0.0, 1.0])]
    assert run(spark, rows)[:3] == [(50, 1, 7, 9 * 65536), (50, 2, 7, 65536), (50, 3, 100, 0)]
    assert run(spark, rows, block_rows=1) == run(spark, rows) == brute(rows)


def test_huge_components_do_not_overflow(spark):
    rows = [(0, [3e38, 1.0]), (1, [3e38, -3e38]), (2, [1e10, 2.0]), (3, [-3e38, 0.0])]
    got = run(spark, rows)
    assert [r[2] for r in got] == [1, 2, 3] and got[0][3] == 2**63 - 1 and got[2][3] == -(2**63 - 1)


def test_the_search_stops_early(monkeypatch):
    """With one strong row the bound falls below the best score long before the lists end."""
    scored = []
    choose = topk._best

    def counting(places, scores, k):
        scored.append(len(places))
        return choose(places, scores, k)

    monkeypatch.setattr(topk, "_best", counting)
    rows = np.random.default_rng(1).integers(-5, 6, (5000, 4))
    rows[77] = 1000
    found = topk.threshold_top_k(np.arange(5000), rows, np.array([9999]), np.array([[1, 1, 1, 1]]), 1)
    assert found == [(9999, 77, 4000)]
    assert sum(scored) < 200
