import random

import pytest
from pyspark.sql import functions as F

from facetry.operators import metrics, scores
from facetry.schema import ASPECT_COLUMNS, ASPECTS, CLASSES, ROUTE_BIGRU, ROUTE_CAPSULE, aspect_table, route_table


def ratio(a, b):
    return a / b if b else 0.0


def python_report(pairs):
    """Per class precision, recall, F1, support over the union of gold and predicted."""
    out = {}
    for k in sorted({y for y, _ in pairs} | {p for _, p in pairs}):
        tp = sum(y == p == k for y, p in pairs)
        said, real = sum(p == k for _, p in pairs), sum(y == k for y, _ in pairs)
        out[k] = (ratio(tp, said), ratio(tp, real), ratio(2 * tp, said + real), real)
    return out


@pytest.fixture
def table(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        for a in range(1, 21):
            top = 2 if a == 3 else 4  # aspect 3 never sees the last two classes in gold
            rows.append((i, a, rng.choice(CLASSES[:top]), rng.choice(CLASSES[:3])))
    return rows


def test_macro_and_report(spark, table):
    df = spark.createDataFrame(table, "id long, aspect_idx int, y int, yhat int")
    conf = metrics.confusion(df)
    report = {(r["aspect_idx"], r["class"]): r for r in metrics.class_report(conf).collect()}
    macro = {r["aspect_idx"]: r for r in metrics.macro(conf).collect()}
    summary = {r["aspect_idx"]: r for r in metrics.report_summary(metrics.class_report(conf)).collect()}
    f1s = []
    for a in range(1, 21):
        pairs = [(y, p) for _, b, y, p in table if b == a]
        want = python_report(pairs)
        assert {k for b, k in report if b == a} == set(want)
        for k, (precision, recall, f1, support) in want.items():
            r = report[(a, k)]
            assert (r["precision"], r["recall"], r["f1"], r["support"]) == pytest.approx((precision, recall, f1, support))
        n = len(want)
        mean = [sum(v[j] for v in want.values()) / n for j in range(3)]
        assert [macro[a][m] for m in ("precision", "recall", "f1")] == pytest.approx(mean)
        assert summary[a]["accuracy"] == pytest.approx(sum(y == p for y, p in pairs) / len(pairs))
        assert summary[a]["weighted_f1"] == pytest.approx(sum(v[2] * v[3] for v in want.values()) / len(pairs))
        f1s.append(mean[2])
    assert metrics.mean_f1(metrics.macro(conf)).first()[0] == pytest.approx(sum(f1s) / 20)


def test_mean_needs_every_aspect(spark):
    df = spark.createDataFrame([(1, 0.5)], "aspect_idx int, f1 double")
    with pytest.raises(Exception, match="expected 20 aspects"):
        metrics.mean_f1(df).collect()


def vector_rows(models=("a", "b")):
    rng = random.Random(1)
    return [(i, a, m, [rng.random() for _ in range(4)]) for i in range(25) for a in range(1, 21) for m in models]


SCORES = "id long, aspect_idx int, model string, p array<double>"


def label(p):
    return CLASSES[p.index(max(p))]


def test_average_of_models_in_both_layouts(spark):
    rows = vector_rows()
    given = {(i, a, m): p for i, a, m, p in rows}
    want = {
        (i, a): [0.5 * x + 0.5 * y for x, y in zip(given[i, a, "a"], given[i, a, "b"])]
        for i, a, _ in given
    }
    long = spark.createDataFrame(rows, SCORES)
    got = {(r["id"], r["aspect_idx"]): r["p"] for r in scores.average_models(long, ("a", "b")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)

    def wide(model):
        named = long.where(F.col("model") == model).join(aspect_table(spark), "aspect_idx")
        return named.groupBy("id").pivot("aspect", list(ASPECT_COLUMNS)).agg(F.first("p"))

    labels = scores.average_wide(wide("a"), wide("b"))
    assert labels.columns == ["id", *ASPECT_COLUMNS]
    for r in labels.collect():
        assert [r[name] for name in ASPECT_COLUMNS] == [label(want[r["id"], i]) for i, _, _ in ASPECTS]


def test_three_models(spark):
    rows = [(1, 1, m, [x, 0.0, 0.0, 0.0]) for m, x in (("a", 1.0), ("b", 2.0), ("c", 6.0))]
    got = scores.average_models(spark.createDataFrame(rows, SCORES), ("a", "b", "c")).first()
    assert got["p"] == [3.0, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("rows", [[(1, 1, "a", [0.1] * 4)], [(1, 1, "a", [0.1] * 4)] * 2 + [(1, 1, "b", [0.1] * 4)]])
def test_missing_or_doubled_model_is_an_error(spark, rows):
    with pytest.raises(Exception, match="each model must score"):
        scores.average_models(spark.createDataFrame(rows, SCORES), ("a", "b")).collect()


@pytest.mark.parametrize("bad", [None, [0.1, None, 0.2, 0.3], [0.1, 0.2, 0.3], [0.1, float("nan"), 0.2, 0.3], [0.1] * 5])
def test_vectors_that_are_not_four_numbers_are_an_error(spark, bad):
    rows = [(1, 1, "a", [0.1, 0.2, 0.3, 0.4]), (1, 1, "b", bad)]
    long = spark.createDataFrame(rows, SCORES)
    gold = spark.createDataFrame([(1, 1, 0)], "id long, aspect_idx int, y int")
    with pytest.raises(Exception, match="each model must score|not a vector of numbers"):
        scores.average_models(long, ("a", "b")).collect()
    with pytest.raises(Exception, match="do not match|not a vector of numbers"):
        metrics.ensemble_confusion(long, gold, ("a", "b")).collect()
    if bad is not None:
        with pytest.raises(Exception, match="not 4 numbers"):
            scores.classify(long).collect()


def wide_scores(spark, ids, cell=(0.1, 0.2, 0.3, 0.0)):
    return spark.createDataFrame([(i, *[list(cell)] * 20) for i in ids], f"id long, {', '.join(c + ' array<double>' for c in ASPECT_COLUMNS)}")


def test_average_wide_needs_the_same_reviews_once(spark):
    assert scores.average_wide(wide_scores(spark, [1, 2]), wide_scores(spark, [2, 1])).count() == 2
    for left, right in (([1, 2, 3], [2, 3, 4]), ([1, 1], [1]), ([1, 2], [1])):
        with pytest.raises(Exception, match="do not match row for row"):
            scores.average_wide(wide_scores(spark, left), wide_scores(spark, right)).collect()
    with pytest.raises(Exception, match="not a vector of numbers"):
        scores.average_wide(wide_scores(spark, [1]), wide_scores(spark, [1], (0.1, 0.2, 0.3))).collect()


def test_null_labels_are_an_error(spark):
    pairs = spark.createDataFrame([(1, 0, 0), (1, None, 0)], "aspect_idx int, y int, yhat int")
    with pytest.raises(Exception, match="a label is null"):
        metrics.macro(metrics.confusion(pairs)).collect()


def test_align_rejects_repeated_rows(spark):
    once = spark.createDataFrame([(1, 5), (2, 6)], "id int, x int")
    twice = spark.createDataFrame([(1, 7), (1, 7), (2, 8)], "id int, y int")
    with pytest.raises(Exception, match="do not match"):
        metrics.align(once, twice, ["id"]).collect()


def test_routing_sees_every_review_of_its_input(spark):
    rows = vector_rows(("bigru", "capsule"))
    long = spark.createDataFrame(rows, SCORES)
    routes = route_table(spark)
    other = long.join(routes, ["aspect_idx", "model"], "left_anti").where("id = 3").select(*long.columns)
    for table in (long.where("id <> 3").unionByName(other), long.unionByName(long.where("id = 4"))):
        with pytest.raises(Exception, match="no routed model score, or more than one"):
            scores.routed_labels(table, routes).collect()


def test_ensemble_confusion_equals_the_steps_taken_one_by_one(spark):
    long = spark.createDataFrame(vector_rows(), SCORES)
    rng = random.Random(4)
    gold_rows = [(i, a, rng.choice(CLASSES)) for i in range(25) for a in range(1, 21)]
    gold = spark.createDataFrame(gold_rows, "id long, aspect_idx int, y int")
    got = metrics.ensemble_confusion(long, gold, ("a", "b"))
    labels = scores.classify(scores.average_models(long, ("a", "b")))
    steps = metrics.confusion(metrics.align(labels.select("id", "aspect_idx", "yhat"), gold, ("id", "aspect_idx")))
    assert got.exceptAll(steps).isEmpty() and steps.exceptAll(got).isEmpty()
    with pytest.raises(Exception, match="do not match row for row"):
        metrics.ensemble_confusion(long, gold.where("id < 20"), ("a", "b")).collect()


def test_align_rejects_rows_on_one_side(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "id int, x int")
    b = spark.createDataFrame([(1, 7), (2, 8)], "id int, y int")
    assert sorted(map(tuple, metrics.align(a, b, ["id"]).collect())) == [(1, 5, 7), (2, 6, 8)]
    for left, right in ((a, b.where("id = 1")), (a.where("id = 1"), b)):
        with pytest.raises(Exception, match="do not match"):
            metrics.align(left, right, ["id"]).collect()


def test_routing_takes_each_aspect_from_its_model(spark):
    assert sorted(ROUTE_BIGRU + ROUTE_CAPSULE) == list(range(1, 21))
    rows = vector_rows(("bigru", "capsule"))
    given = {(i, a, m): p for i, a, m, p in rows}
    long = spark.createDataFrame(rows, SCORES)
    for r in scores.routed_labels(long, route_table(spark)).collect():
        for a, _, name in ASPECTS:
            model = "bigru" if a in ROUTE_BIGRU else "capsule"
            assert r[name] == label(given[r["id"], a, model])
    with pytest.raises(Exception, match="no routed model score"):
        scores.routed_labels(long.where("aspect_idx <> 7"), route_table(spark)).collect()
    with pytest.raises(ValueError):
        route_table(spark, {"a": (1, 2), "b": (2, 3)})


def test_wide_long_and_back(spark):
    rng = random.Random(9)
    rows = [(i, *[rng.choice(CLASSES) for _ in ASPECTS]) for i in range(12)]
    wide = spark.createDataFrame(rows, ["id", *ASPECT_COLUMNS])
    long = scores.wide_to_long(wide)
    assert long.count() == 240
    assert all(r["aspect"] == ASPECTS[r["aspect_idx"] - 1][2] for r in long.collect())
    assert sorted(map(tuple, scores.long_to_wide(long).collect())) == sorted(rows)
    assert scores.pick_aspects(long, [2, 5]).count() == 24


def test_running_best_and_best_epoch(spark):
    rows = [(1, 1, 0.3), (1, 2, 0.5), (1, 3, 0.4), (1, 4, 0.5), (2, 1, 0.9)]
    history = spark.createDataFrame(rows, "aspect_idx int, epoch int, f1 double")
    best = {(r["aspect_idx"], r["epoch"]): r["best_f1"] for r in metrics.running_best(history).collect()}
    assert best == {(1, 1): 0.3, (1, 2): 0.5, (1, 3): 0.5, (1, 4): 0.5, (2, 1): 0.9}
    assert sorted(map(tuple, metrics.best_epoch(history).collect())) == [(1, 2, 0.5), (2, 1, 0.9)]
