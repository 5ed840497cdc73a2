import hashlib
import math
import random

import numpy as np
import pytest

from facetry.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds, scale=256):
    """Codes, errors and codebook text in plain Python."""
    some = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [max(-(2**63), min(2**63 - 1, math.floor(float(np.float32(x)) * scale))) for x in v]
            some.append((i, whole, label))
    dims = max((len(v) for _, v, _ in some), default=0)
    width = -(-dims // parts)
    cut = [[(v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in some]
    order = sorted(range(len(some)), key=lambda k: (some[k][0] is None, some[k][0] or 0, some[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for row in cut:
                groups.setdefault(near(row[p], books[p])[1], []).append(row[p])
            books[p] = [[sum(c) // len(c) for c in zip(*groups[e], strict=True)] if e in groups else c for e, c in enumerate(books[p])]
    coded = [[near(row[p], books[p]) for p in range(parts)] for row in cut]
    errors = [min(sum(d for d, _ in c), 2**63 - 1) for c in coded]
    labels = {}
    for (_, _, label), e in zip(some, errors, strict=True):
        labels[label] = labels.get(label, 0) + e
    out = [
        (i, "".join(f"{e:02x}" for _, e in c), error, min(labels[label], 2**63 - 1))
        for (i, _, label), c, error in zip(some, coded, errors, strict=True)
    ]
    text = ",".join(str(x) for p, b in enumerate(books) for c in b for x in c[: max(0, dims - p * width)])
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


def run(spark, rows, parts, entries, rounds):
    vectors = vc.whole_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), "vec_id", "embedding", 256, "label")
    books = vc.train(vectors, parts, entries, rounds)
    coded = vc.with_label_error(vc.encode(vectors, books), "_label")
    found = coded.select("id", vc.hex_code("code"), "error", "label_error").collect()
    return sorted(map(tuple, found), key=str), books.digest()


@pytest.mark.parametrize(("dims", "parts", "entries"), [(8, 4, 8), (12, 4, 16), (7, 3, 5), (5, 1, 64), (16, 16, 4)])
def test_against_brute_force(spark, dims, parts, entries):
    rng = random.Random(dims)
    rows = [(k * 7 % 151, [rng.gauss(0, 0.3) for _ in range(dims)], rng.choice([None, 0, 1, 1, 1])) for k in range(151)]
    rows += [(200 + k, rows[3][1], 2) for k in range(20)]  # ties and copies
    rows += [(300 + k, [round(x * 8) / 8 for x in rows[k][1]], 0) for k in range(40)]
    assert run(spark, rows, parts, entries, 2) == brute(rows, parts, entries, 2)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.5, -0.25, 1.0, 0.0], 1), (1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (4, [nan, 0.0, 0.0, 0.0], 1), (5, [inf, 0.0, 0.0, 0.0], None),
        (None, [0.1, 0.2, 0.3, 0.4], None), (3, [0.5, -0.5, 1.0, 0.0], 1), (7, [], 2), (8, [1.0], 2), (9, [3e38, -3e38, 0.0, 1.0], 5), (3, [0.5, -0.25, 1.0, 0.0], 1),
    ]
    for entries in (2, 64):
        assert run(spark, rows, 2, entries, 2) == brute(rows, 2, entries, 2)
    assert run(spark, [], 16, 64, 2) == brute([], 16, 64, 2)
    assert run(spark, [(1, [], None)], 16, 64, 2) == brute([(1, [], None)], 16, 64, 2)
    assert run(spark, [(1, None, None)], 16, 64, 2) == brute([(1, None, None)], 16, 64, 2)


def test_decoding_gives_the_entries(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(7)], 0) for k in range(30)]
    vectors = vc.whole_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 256)
    books = vc.train(vectors, 3, 30, 0)
    back = vc.decode(vc.encode(vectors, books), books).select("id", "v").collect()
    # with an entry per vector nothing is lost
    assert sorted(map(tuple, back)) == sorted(map(tuple, vectors.select("id", "v").collect()))


def test_the_transform_keeps_distances_and_orders_by_sign_changes():
    rows = np.random.default_rng(5).integers(-99, 99, (6, 16))
    made = vc.walsh(rows)
    assert ((made[:, None] - made[None]) ** 2).sum(2).tolist() == (16 * ((rows[:, None] - rows[None]) ** 2).sum(2)).tolist()
    signs = vc.walsh(np.eye(16, dtype=np.int64)).T
    assert [(row[1:] != row[:-1]).sum() for row in signs] == list(range(16))


def test_entries_are_eliminated_before_their_last_coefficient(monkeypatch):
    left = []
    choose = vc._least
    rng = np.random.default_rng(2)
    entries = rng.integers(-1000, 1000, (64, 16))
    rows = entries[rng.integers(0, 64, 500)] + rng.integers(-3, 4, (500, 16))

    def counting(row, entry, sums, n):
        left.append(len(row))
        return choose(row, entry, sums, n)

    monkeypatch.setattr(vc, "_least", counting)
    index, distance = vc.nearest(rows, entries)
    exact = ((rows[:, None] - entries[None]) ** 2).sum(2)
    assert index.tolist() == exact.argmin(1).tolist() and distance.tolist() == exact.min(1).tolist()
    # pairs after 1, 2, 4, 8 and 16 coefficients
    assert left[0] == 32_000 and left[2] < 3000 and left[3] == left[-1] == 500


def test_other_columns_do_not_clash(spark):
    rows = [(k, [0.1 * k, 0.2], None, "x", 1) for k in range(4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, error int")
    vectors = vc.whole_vectors(frame, "vec_id", "embedding", 256, "label")
    found = vc.with_label_error(vc.encode(vectors, vc.train(vectors, 2, 2, 1)), "_label")
    assert found.count() == 4
