import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetry.operators import models
from facetry.operators.scores import wide_to_long
from facetry.plans import classify, ensemble, preprocess
from facetry.plans.catalog import QUERIES
from facetry.schema import ASPECT_COLUMNS, CLASSES, review_schema
from facetry.sources.reviews import read_reviews, write_csv


@pytest.fixture(scope="module")
def reviews_path(spark, tmp_path_factory):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        labels = [rng.choice(CLASSES) for _ in range(19)]
        good = rng.random() < 0.5
        text = "".join(rng.choices("好吃面店" if good else "差贵慢脏", k=12)) + "的，a1"
        rows.append((i, text, *labels, 1 if good else -1))
    path = str(tmp_path_factory.mktemp("reviews") / "csv")
    write_csv(spark.createDataFrame(rows, review_schema()), path)
    return path


def test_character_and_word_mode_are_kept_apart(spark, reviews_path, tmp_path):
    (tmp_path / "stop.txt").write_text("的\n，\n没有\n", encoding="utf8")
    (tmp_path / "dict.txt").write_text("好吃 10\n面店 5\n", encoding="utf8")
    out, stop, words = str(tmp_path / "out"), str(tmp_path / "stop.txt"), str(tmp_path / "dict.txt")
    chars = preprocess.preprocess_split(spark, reviews_path, out, "train", "char", stop)
    cut = preprocess.preprocess_split(spark, reviews_path, out, "train", "word", stop, words)
    raw = {r["id"]: r["content"] for r in read_reviews(spark, reviews_path).collect()}
    for r in chars.collect():
        assert r["tokens"] == [c for c in raw[r["id"]] if c not in "的，"]
    for r in cut.collect():
        text = raw[r["id"]].replace("，", "").replace("a", "")
        want, at = [], 0
        while at < len(text):
            step = 2 if text[at : at + 2] in ("好吃", "面店") else 1
            want.append(text[at : at + step])
            at += step
        assert r["tokens"] == [w for w in want if w != "的"]
    again = preprocess.preprocess_split(spark, "/nowhere", out, "train", "char", stop)
    assert again.count() == 60
    with pytest.raises(ValueError):
        preprocess.preprocess_split(spark, reviews_path, out, "train", "other", stop)


def test_train_validate_and_score(spark, reviews_path, tmp_path):
    out = str(tmp_path / "run")
    reviews = read_reviews(spark, reviews_path)
    tokens = preprocess.preprocess_chars(reviews, ["的", "，"])
    vectors = preprocess.character_vectors(
        spark, reviews_path, f"{out}/vectors", size=8, window=3, iterations=2
    )
    held = tokens.where("id % 3 = 0")
    classify.train_all(spark, tokens, vectors, 8, out, aspects=(1, 20), epochs=8, validation_tokens=held)
    history = classify.validate_all(spark, tokens, 8, out, aspects=(1, 20), epochs=(1, 8))
    rows = {(r["aspect_idx"], r["epoch"]): r for r in history.collect()}
    assert rows.keys() == {(a, e) for a in (1, 20) for e in (1, 8)}
    assert rows[20, 8]["f1"] > 0.9
    assert rows[20, 8]["best_f1"] == max(rows[20, 1]["f1"], rows[20, 8]["f1"])
    # the validation inside the training equals one of the kept states afterwards
    again = classify.validate_all(spark, held, 8, out, aspects=(1, 20), epochs=tuple(range(1, 9)))
    inside = models.history(spark, f"{out}/models", 8)
    shown = lambda df: sorted((r[0], r[1], *[round(v, 9) for v in r[2:]]) for r in df.select(*again.columns).collect())
    assert shown(again) == shown(inside)

    vocab = spark.read.parquet(f"{out}/vocabulary")
    embeddings = spark.read.parquet(f"{out}/embeddings")
    feats = classify.features(tokens, vocab, embeddings, 8)
    scored = models.score(feats, f"{out}/models", (1, 20), 8, "m").collect()
    assert len(scored) == 120
    assert all(len(r["p"]) == 4 and r["yhat"] == CLASSES[r["p"].index(max(r["p"]))] for r in scored)


def test_average_and_evaluate_files(spark, reviews_path, tmp_path):
    gold = read_reviews(spark, reviews_path)

    def table(weight):
        cells = [
            F.array(*[(F.col(c) == k).cast("double") * weight for k in CLASSES]).alias(c)
            for c in ASPECT_COLUMNS
        ]
        return gold.select("id", "content", *cells)

    a, b, out = (str(tmp_path / n) for n in ("a", "b", "out"))
    write_csv(table(0.9), a)
    write_csv(table(0.2), b)
    ensemble.average_files(spark, a, b, out)
    assert read_reviews(spark, out).exceptAll(gold).isEmpty()
    report, per_aspect, mean = ensemble.evaluate_files(spark, out, reviews_path)
    assert mean.first()[0] == 1.0
    assert per_aspect.where("f1 = 1").count() == 20
    assert report.agg(F.sum("support")).first()[0] == 60 * 20
    long = wide_to_long(gold.select("id", *ASPECT_COLUMNS))
    assert report.count() == long.select("aspect_idx", "y").distinct().count()


def test_routed_scores_never_take_gold(spark):
    rows = [(1, a, "capsule" if a in (3, 6) else "bigru", [0.0, 0.0, 1.0, 0.0]) for a in range(1, 21)]
    scores = spark.createDataFrame(rows, "id long, aspect_idx int, model string, p array<double>")
    routes = {"capsule": (3, 6), "bigru": tuple(a for a in range(1, 21) if a not in (3, 6))}
    row = ensemble.route_scores(spark, scores, routes).first()
    assert all(row[c] == 0 for c in ASPECT_COLUMNS)
    with pytest.raises(Exception, match="no routed model score"):
        ensemble.route_scores(spark, scores, {"bigru": tuple(range(1, 21))}).collect()


def test_naive_bayes_counts_every_word_of_a_large_vocabulary(spark, tmp_path):
    """More than 5,000 distinct words; the class is told by words that are rare among them."""
    def name(i):
        return "".join(chr(97 + int(d)) for d in f"{i:05d}")

    docs, labels = [], []
    for i in range(60):
        common = [name(j) for j in range(i % 6 * 1000, i % 6 * 1000 + 1000)]
        docs.append((i, " ".join(common + [f"rare{'xy'[i // 6 % 2]}{name(i // 12)}"] * 3)))
        labels.append((i, i // 6 % 2, i % 3 // 2))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {(r["doc_id"], r["aspect_idx"]): r["p1"] for r in QUERIES["aspect_naive_bayes"](spark, str(tmp_path)).collect()}
    assert len(got) == 2 * len(docs)
    words = sorted({w for _, t in docs for w in t.split()})
    assert len(words) > 6000
    place = {w: k for k, w in enumerate(words)}
    counts = np.zeros((len(docs), len(words)))
    for i, t in docs:
        for w in t.split():
            counts[i, place[w]] += 1
    for aspect in (1, 2):
        gold = np.array([row[aspect] for row in labels])
        learn = np.arange(len(docs)) % 2 == 0
        odds = []
        for c in (0, 1):
            seen = counts[learn & (gold == c)].sum(axis=0)
            prior = np.log(((learn & (gold == c)).sum() + 1) / (learn.sum() + 2))
            odds.append(prior + counts @ np.log((seen + 1) / (seen.sum() + len(words))))
        want = 1 / (1 + np.exp(np.clip(odds[0] - odds[1], -700, 700)))
        assert np.allclose([got[i, aspect] for i in range(len(docs))], want, atol=2e-6)


def test_a_stop_list_too_long_for_an_expression(spark, monkeypatch):
    rows = [(1, "好吃的面"), (2, None), (3, "的的"), (4, "")]
    reviews = spark.createDataFrame(rows, "id long, content string")
    dictionary = spark.createDataFrame([("好吃", 1), ("面", 1)], "token string, freq long")
    stop = ["的", "面"]
    table = spark.createDataFrame([(w,) for w in stop], "token string")
    short = preprocess.preprocess_words(reviews, dictionary, stop)
    long = preprocess.preprocess_words(reviews, dictionary, table)
    assert short.columns == long.columns
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect()))
