import math
import random

import numpy as np
import pytest

from facetry.operators import vectors
from facetry.session import materialize

DIM = 6
RNG = random.Random(21)
VECTORS = {i: [RNG.uniform(-2, 2) for _ in range(DIM)] for i in (1, 2, 3, 5, 8)}
WEIGHTS = [RNG.uniform(-1, 1) for _ in range(DIM)]


def make_bias():
    """A function that works on columns and on arrays; a local one, so that tasks get its code."""
    return lambda t: ((7 * t) % 5 - 2) / 10


BIAS = make_bias()



@pytest.fixture
def table(spark):
    rows = [(i, v) for i, v in VECTORS.items()]
    return materialize(spark.createDataFrame(rows, "idx long, v array<float>"))


@pytest.fixture
def sequences():
    rows = [(i, [RNG.randint(0, 9) for _ in range(RNG.randint(0, 15))]) for i in range(80)]
    rows += [(100, []), (101, None), (102, [0, 0, 0]), (103, [7]), (104, [RNG.randint(0, 9) for _ in range(40000)])]
    return rows


def steps(seq, mask):
    zero = [0.0] * DIM
    return [
        (t, np.float32(VECTORS.get(i, zero)).astype(float)) for t, i in enumerate(seq or []) if i or not mask
    ]


def expected(seq, mask, weights=WEIGHTS):
    at = steps(seq, mask)
    if not at:
        return {k: np.zeros(DIM) for k in vectors.KINDS}
    xs = np.array([x for _, x in at])
    a = np.array([math.exp(math.tanh(x @ weights + BIAS(t))) for t, x in at])
    return {
        "mean": xs.mean(0),
        "max": xs.max(0),
        "attention": (xs * a[:, None]).sum(0) / (a.sum() + 1e-7),
    }


@pytest.mark.parametrize("in_tasks", [True, False])
@pytest.mark.parametrize("mask", [True, False])
def test_pool(spark, table, sequences, in_tasks, mask):
    docs = spark.createDataFrame(sequences, "id long, seq array<int>").repartition(3)
    got = vectors.pool(
        docs, table, DIM, attention_weights=WEIGHTS, step_bias=BIAS, mask_pads=mask, in_tasks=in_tasks
    )
    rows = {r["id"]: r for r in got.collect()}
    assert rows.keys() == {i for i, _ in sequences}
    for i, seq in sequences:
        for kind, want in expected(seq, mask).items():
            assert rows[i][kind] == pytest.approx(want, abs=1e-6), (i, kind)


@pytest.mark.parametrize("in_tasks", [True, False])
def test_a_list_of_biases_must_reach_the_longest_text(spark, table, in_tasks):
    docs = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2, 3, 5])], "id long, seq array<int>")
    pool = lambda bias: vectors.pool(docs, table, DIM, attention_weights=WEIGHTS, step_bias=bias, in_tasks=in_tasks)
    assert len(pool([0.1, 0.2, 0.3, 0.4]).collect()) == 2
    with pytest.raises(Exception, match="step biases"):
        pool([0.1, 0.2, 0.3]).collect()


@pytest.mark.parametrize("in_tasks", [True, False])
def test_query_attention(spark, table, sequences, in_tasks):
    rng = random.Random(3)
    w_query = [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(3)]
    w_step = [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(DIM)]
    w_out, b_query, b_step = [0.7, -1.2], [0.1, 0.2], [-0.3, 0.4]
    rows = [(i, seq, [rng.uniform(-1, 1) for _ in range(3)]) for i, seq in sequences]
    docs = spark.createDataFrame(rows, "id long, seq array<int>, q array<double>").repartition(3)
    got = vectors.query_attention_pool(
        docs, table, DIM, w_query, w_step, w_out, b_query, b_step, BIAS, in_tasks=in_tasks
    )
    found = {r["id"]: r["attention"] for r in got.collect()}
    for i, seq, q in rows:
        at = steps(seq, True)
        want = np.zeros(DIM)
        if at:
            e = [
                np.tanh(np.array(q) @ w_query + b_query + x @ np.array(w_step) + b_step) @ w_out
                + BIAS(t)
                for t, x in at
            ]
            a = np.exp(np.array(e) - max(e))
            want = (np.array([x for _, x in at]) * a[:, None]).sum(0) / (a.sum() + 1e-7)
        assert found[i] == pytest.approx(want, abs=1e-6)


def test_document_features_are_the_three_parts_in_order(spark, table):
    docs = spark.createDataFrame([(1, [1, 2])], "id long, seq array<int>")
    pooled = vectors.pool(docs, table, DIM, attention_weights=WEIGHTS)
    row = pooled.first()
    features = vectors.document_features(pooled).first()["features"]
    assert features == row["mean"] + row["max"] + row["attention"]


def test_embedding_rows(spark):
    vocab = spark.createDataFrame([("a", 3, 1), ("b", 2, 2)], "token string, n long, idx long")
    given = spark.createDataFrame([("b", [1.0, 2.0]), ("z", [9.0, 9.0])], "token string, v array<float>")
    rows = {r["idx"]: r["v"] for r in vectors.embedding_rows(vocab, given, 2).collect()}
    assert rows == {0: [0.0, 0.0], 1: [0.0, 0.0], 2: [1.0, 2.0]}


def test_train_skipgram(spark):
    rng = random.Random(8)
    rows = [(rng.choices("吃好面店贵", k=30),) for _ in range(40)]
    docs = spark.createDataFrame(rows, "tokens array<string>")
    trained = vectors.train_skipgram(docs, size=7, window=3, iterations=2, partitions=2)
    got = {r["token"]: r["v"] for r in trained.collect()}
    assert set(got) == set("吃好面店贵")
    assert all(len(v) == 7 and all(map(math.isfinite, v)) for v in got.values())
    with pytest.raises(ValueError, match="max_vocabulary"):
        vectors.train_skipgram(docs, max_vocabulary=3)


def test_pair_weights_against_brute_force(spark):
    rng = random.Random(4)
    rows = [([rng.choice("abcde") for _ in range(rng.randint(0, 25))],) for _ in range(40)] + [(None,), (["z", "z"],)]
    docs = spark.createDataFrame(rows, "tokens array<string>").repartition(3)
    vocab = spark.createDataFrame([(t, 1, i + 1) for i, t in enumerate("abcdz")], "token string, n long, idx long")
    got = {(r["a"], r["b"]): r["n"] for r in vectors.pair_weights(docs, vocab, 4).collect()}
    want = {}
    place = {t: i + 1 for i, t in enumerate("abcdz")}
    for (tokens,) in rows:
        seq = [place[t] for t in tokens or [] if t in place]
        for i, a in enumerate(seq):
            for j, b in enumerate(seq):
                if 0 < abs(i - j) <= 4:
                    want[a, b] = want.get((a, b), 0) + (5 - abs(i - j)) / 4
    assert got == pytest.approx(want)


def test_train_vectors_by_factorisation(spark):
    """Two words with the same neighbours get close vectors; a word without neighbours gets zeros."""
    rng = random.Random(6)
    rows = [([rng.choice(("hot", "warm")) if k % 2 else rng.choice("abc") for k in range(20)],) for _ in range(60)]
    rows += [([rng.choice("xyz") for _ in range(20)],) for _ in range(60)] + [(["alone"],)]
    docs = spark.createDataFrame(rows, "tokens array<string>")
    got = {r["token"]: np.array(r["v"]) for r in vectors.train_vectors(docs, size=8, window=2, iterations=5).collect()}
    assert set(got) == {"hot", "warm", "alone", *"abcxyz"} and all(len(v) == 8 for v in got.values())
    close = lambda a, b: got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
    assert close("hot", "warm") > 0.95 and not got["alone"].any()
    assert max(close("hot", w) for w in "xyz") < close("hot", "warm")
    nothing = vectors.train_vectors(docs.where("size(tokens) = 1"), size=3)
    assert [list(r["v"]) for r in nothing.collect()] == [[0.0] * 3]


def test_pairs_of_few_tokens_are_counted_in_a_table(spark, monkeypatch):
    rng = random.Random(9)
    rows = [([rng.choice("abcd") for _ in range(rng.randint(0, 30))],) for _ in range(30)]
    docs = spark.createDataFrame(rows, "tokens array<string>").repartition(2)
    vocab = spark.createDataFrame([(t, 1, i + 1) for i, t in enumerate("abcd")], "token string, n long, idx long")
    dense = sorted(vectors.pair_weights(docs, vocab, 3).collect())
    monkeypatch.setattr(vectors, "DENSE", 0)
    assert dense == sorted(vectors.pair_weights(docs, vocab, 3).collect()) and dense


def test_a_rare_vector_goes_to_few_blocks(spark):
    """Half a million steps are one block, which asks for a vector once."""
    docs = spark.range(64, numPartitions=1).selectExpr("id", "transform(sequence(1, 8192), x -> cast(x % 100 AS int)) AS seq")
    coded = vectors.blocks.pack(docs, "seq", most=vectors.BLOCK_STEPS)
    assert coded.count() == 1
