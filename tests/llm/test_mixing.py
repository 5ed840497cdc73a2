import re

import pytest
from pyspark.sql import functions as F

from facetry.llm.mixing import mix, mixture, source_targets, word_count


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share, cut what is above its limit, share the excess again, until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 5000, None: 70, "": 3, "é": 9, "z": 0, "Z": 44},
        {"a": 0, "b": 0},
        {"only": 7},
        {f"s{i:03d}": (i * 37) % 101 for i in range(60)},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i % 13), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)] + [(3000, None, None)]
    made = mix(docs(spark, rows)).toPandas()
    assert len(made) == 3001
    assert (made["taken"] <= 2 * made["size"]).all() and (made["taken"] == made["size"] * made["copies"]).all()
    for _, part in made.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 13 / 2
    again = mix(docs(spark, rows).repartition(5)).toPandas()
    key = ["doc_id", "size", "taken", "target"]
    assert made.sort_values("doc_id")[key].values.tolist() == again.sort_values("doc_id")[key].values.tolist()


def test_epochs_precede_the_fraction(spark):
    made = mix(docs(spark, [(i, "w w", "a" if i < 5 else "b") for i in range(100)])).toPandas()
    small = made[made["source"] == "a"]
    assert (small["copies"] == 2).all()  # its share is above twice its size
    assert set(made[made["source"] == "b"]["copies"]) == {1, 2}


def test_better_documents_are_taken_more_often(spark):
    rows = docs(spark, [(i, "good words here" if i % 2 else "1#$ 2%^ 3&*", s) for s in "abc" for i in range(900)])
    made = mix(rows).toPandas()
    taken = (made[made["source"] == "b"].set_index("doc_id")["copies"] > 0)  # 2250 of its 2700 words
    good = taken[taken.index % 2 == 1].mean()
    assert good > 0.9 and good - taken[taken.index % 2 == 0].mean() > 0.15


def test_edge_cases(spark):
    rows = [(1, None, None), (1, None, None), (None, "", "a"), (None, "x y", "a"), (2, "x y", "a"), (2, "x y", "a"), (3, "w " * 50_000, "")]
    made = mix(docs(spark, rows)).collect()
    assert len(made) == len(rows)
    assert sorted(r["size"] for r in made) == [0, 0, 0, 2, 2, 2, 50_000]
    assert mix(docs(spark, [])).count() == 0
    assert mixture(docs(spark, [])).count() == 0


def test_mixture_repeats_whole_rows(spark):
    rows = docs(spark, [(i, "w w " * (i % 4), f"s{i % 3}") for i in range(200)]).withColumn("copies", F.lit("x"))
    taken = {(r["doc_id"], r["source"]): r["copies"] for r in mix(rows.drop("copies")).collect()}
    got = mixture(rows)
    assert got.columns == rows.columns
    counts = {(r["doc_id"], r["source"]): r["count"] for r in got.groupBy("doc_id", "source").count().collect()}
    assert counts == {k: n for k, n in taken.items() if n}


def test_word_count(spark):
    texts = ["", None, " ", "a", " a\x0bb\x0cc\r\n", "a\u00a0b \u3000", "\x1c x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", word_count("text").alias("n"))
    for row in rows.collect():
        assert row["n"] == len(re.findall(r"[^\x20\x09-\x0D]+", row["text"] or ""))
