import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from facetry.functions.text import char_tokens
from facetry.operators import encode as encode_module
from facetry.operators.encode import encode, encode_chars, lookup, lookup_by_join, lookup_chars
from facetry.operators.vocabulary import distinct_in_order, fit_vocabulary, number_rows


@pytest.fixture
def docs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i * 7 - 50, rng.choices(words, k=rng.randint(0, 50), weights=range(1, 61))) for i in range(40)]
    rows += [(1000, []), (1001, ["tie1", "tie2", "tie1", "tie2"]), (1002, None), (2**40, ["last"])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, tokens array<string>").repartition(5)


def expected_vocab(rows):
    order = [t for _, tokens in sorted(rows) for t in tokens or []]
    counts = Counter(order)
    first = {t: order.index(t) for t in counts}
    ranked = sorted(counts, key=lambda t: (-counts[t], first[t]))
    return {t: (counts[t], i + 1) for i, t in enumerate(ranked)}


def test_fit_orders_by_count_then_first_seen(spark, docs):
    got = {r["token"]: (r["n"], r["idx"]) for r in fit_vocabulary(frame(spark, docs)).collect()}
    assert got == expected_vocab(docs)


def test_number_rows_is_gapless_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=13).withColumn("k", F.pmod(F.col("id") * 37, F.lit(5000)))
    rows = number_rows(df, "k", name="i").orderBy("i").collect()
    assert [r["i"] for r in rows] == list(range(1, 5001))
    assert [r["k"] for r in rows] == list(range(5000))


@pytest.mark.parametrize("keep", [False, True])
def test_lookup_broadcast_and_joined(spark, docs, keep):
    vocab_rows = [r for i, r in enumerate(docs) if i % 2 == 0]
    vocab = fit_vocabulary(frame(spark, vocab_rows))
    index = {t: i for t, (_, i) in expected_vocab(vocab_rows).items()}
    hot = [(-5000, ["unknown"] * 3000)]
    rows = docs + hot
    want = {
        i: [index.get(t, 0) for t in tokens or [] if keep or t in index] for i, tokens in rows
    }
    df = frame(spark, rows)
    for got in (
        lookup(df, vocab, keep),
        lookup_by_join(df, vocab, keep, block_tokens=1),
        lookup_by_join(df, vocab, keep, block_tokens=50),
        lookup_by_join(df, vocab, keep),
    ):
        assert {r["id"]: r["seq"] for r in got.collect()} == want


def test_encode_cuts_after_dropping_unknown_tokens(spark):
    vocab = fit_vocabulary(frame(spark, [(1, ["a", "b", "c", "d", "e"])]))
    rows = [(1, ["a", "b", "x", "x", "x", "c", "d"]), (2, ["x"] * 9), (3, ["e", "x", "e"]), (4, None)]
    got = {r["id"]: r["seq"] for r in encode(frame(spark, rows), vocab, 3).collect()}
    assert got == {1: [2, 3, 4], 2: [0, 0, 0], 3: [0, 5, 5], 4: [0, 0, 0]}


@pytest.mark.parametrize("keep", [False, True])
def test_character_lookup_needs_no_token_arrays(spark, texts, keep):
    rows = [*enumerate(texts), (9000, None)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    tokens = docs.select("id", char_tokens("text").alias("tokens"))
    vocab = fit_vocabulary(tokens.where("id % 3 = 0"))
    want = {r["id"]: r["seq"] for r in lookup(tokens, vocab, keep).collect()}
    assert {r["id"]: r["seq"] for r in lookup_chars(docs, vocab, keep).collect()} == want
    padded = {r["id"]: r["seq"] for r in encode(tokens, vocab, 7).collect()}
    assert {r["id"]: r["seq"] for r in encode_chars(docs, vocab, 7).collect()} == padded


def test_distinct_in_order(spark):
    rows = [(3, ["b", "z"]), (1, ["c", "a", "c"]), (2, ["a", "b"]), (4, [])]
    got = distinct_in_order(frame(spark, rows), "tokens").orderBy("idx").collect()
    assert [(r["value"], r["idx"]) for r in got] == [("c", 1), ("a", 2), ("b", 3), ("z", 4)]


def test_character_lookup_takes_characters_only(spark):
    vocab = spark.createDataFrame([("a", 1, 1), ("ab", 1, 2)], "token string, n long, idx long")
    with pytest.raises(ValueError, match="not a character"):
        lookup_chars(frame(spark, [(1, ["a"])]).select("id", F.lit("a").alias("text")), vocab)


def test_characters_are_looked_up_slice_by_slice(spark, texts, monkeypatch):
    monkeypatch.setattr(encode_module, "SLICE_CHARS", 50)
    docs = spark.createDataFrame([*enumerate(texts), (None, "a好"), (-1, None)], "id long, text string").coalesce(1)
    vocab = spark.createDataFrame([(c, i + 1) for i, c in enumerate("a好X 😀")], "token string, idx long")
    place = {r["token"]: r["idx"] for r in vocab.collect()}
    for keep in (True, False):
        got = [(r["id"], r["seq"]) for r in encode_module.lookup_chars(docs, vocab, keep).collect()]
        want = [(i, [place.get(c, 0) for c in t or "" if keep or c in place]) for i, t in [*enumerate(texts), (None, "a好"), (-1, None)]]
        assert got == want
