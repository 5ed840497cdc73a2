import math
import random
from collections import Counter
from functools import lru_cache

import pytest

from facetry.operators import segment as segment_module
from facetry.operators.joins import drop_listed
from facetry.operators.segment import extend_dictionary, keywords, segment

WORDS = {"牛肉": 50, "牛肉面": 20, "肉面": 5, "面": 100, "好吃": 30, "好": 10, "ab": 3, "abc": 1, "bcd": 40, "d": 2}


def longest(text):
    out, at = [], 0
    while at < len(text):
        n = max([len(w) for w in WORDS if text.startswith(w, at)], default=1)
        out.append(text[at : at + n])
        at += n
    return out


def best_score(text):
    total = sum(WORDS.values())

    @lru_cache(None)
    def best(at):
        if at == len(text):
            return 0.0
        options = {1: math.log(1 / total)} | {
            len(w): math.log(f / total) for w, f in WORDS.items() if text.startswith(w, at)
        }
        return max(s + best(at + n) for n, s in options.items())

    return best(0)


def score(tokens):
    total = sum(WORDS.values())
    return sum(math.log(WORDS.get(t, 1) / total) for t in tokens)


@pytest.fixture
def rows():
    rng = random.Random(11)
    return [(i, "".join(rng.choices("牛肉面好吃abcdx😀", k=rng.randint(0, 30)))) for i in range(150)] + [(999, None)]


@pytest.fixture
def dictionary(spark):
    return spark.createDataFrame(list(WORDS.items()), "token string, freq long")


@pytest.mark.parametrize("small", [True, False])
def test_longest_match(spark, rows, dictionary, small):
    docs = spark.createDataFrame(rows, "id long, text string")
    got = {r["id"]: r["tokens"] for r in segment(docs, dictionary, small=small).collect()}
    assert got == {i: None if t is None else longest(t) for i, t in rows}


@pytest.mark.parametrize("small", [True, False])
def test_a_dictionary_without_longer_words(spark, rows, small):
    docs = spark.createDataFrame(rows, "id long, text string")
    for listed in ([], [("面", 3)]):
        got = segment(docs, spark.createDataFrame(listed, "token string, freq long"), small=small).collect()
        assert {r["id"]: r["tokens"] for r in got} == {i: None if t is None else list(t) for i, t in rows}


def test_likeliest_cut(spark, rows, dictionary):
    docs = spark.createDataFrame(rows, "id long, text string")
    a = {r["id"]: r["tokens"] for r in segment(docs, dictionary, "frequency", small=True).collect()}
    b = {r["id"]: r["tokens"] for r in segment(docs, dictionary, "frequency", small=False).collect()}
    assert a == b
    for i, text in rows:
        if text is None:
            assert a[i] is None
            continue
        assert "".join(a[i]) == text
        assert score(a[i]) == pytest.approx(best_score(text))


def test_extend_dictionary(spark, dictionary):
    added = spark.createDataFrame([("面 \n",), ("一家人在",), (" ",)], "token string")
    got = {r["token"]: r["freq"] for r in extend_dictionary(dictionary, added, 20000).collect()}
    assert got == {**WORDS, "面": 20000, "一家人在": 20000}


@pytest.mark.parametrize("small", [True, False])
def test_keywords(spark, small):
    rng = random.Random(2)
    rows = [(i, rng.choices([f"t{k}" for k in range(80)], k=rng.randint(0, 120), weights=range(1, 81))) for i in range(30)]
    rows.append((99, None))
    df = Counter(t for _, tokens in rows for t in set(tokens or []))
    want = set()
    for i, tokens in rows:
        weights = {t: round(n * math.log(len(rows) / df[t]), 9) for t, n in Counter(tokens or []).items()}
        ranked = sorted(weights, key=lambda t: (-weights[t], t))[:5]
        want |= {(i, t, r + 1) for r, t in enumerate(ranked)}
    docs = spark.createDataFrame(rows, "id long, tokens array<string>")
    got = keywords(docs.repartition(3), 5, small).collect()
    assert {(r["id"], r["token"], r["rank"]) for r in got} == want


@pytest.mark.parametrize("small", [True, False])
def test_drop_listed(spark, small):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c")] + [(3, "hot")] * 500, "id int, token string")
    stop = spark.createDataFrame([("a",), ("hot",)], "token string")
    assert {tuple(r) for r in drop_listed(rows, stop, "token", small).collect()} == {(1, "b"), (2, "c")}


def test_a_large_dictionary_is_asked_once_per_block_and_piece(spark, monkeypatch):
    """However often a word stands in the texts: what is asked is bounded by the words, not by the matches."""
    rng = random.Random(4)
    rows = [(None if i == 7 else i % 50, " ".join(rng.choices(["牛肉面", "好吃", "abcd", "x1"], k=300))) for i in range(60)]
    docs = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    asked, known = [], segment_module.blocks.dictionaries

    def counted(*args):
        asked.append(known(*args))
        return asked[-1]

    monkeypatch.setattr(segment_module.blocks, "dictionaries", counted)
    got = segment(docs, spark.createDataFrame(list(WORDS.items()), "token string, freq long"), small=False).collect()
    assert Counter((r["id"], tuple(r["tokens"])) for r in got) == Counter((i, tuple(longest(t))) for i, t in rows)
    assert sum(a.count() for a in asked) <= len(WORDS)


@pytest.mark.parametrize("method", ["longest", "frequency"])
def test_what_the_filter_lets_through_wrongly(spark, rows, dictionary, monkeypatch, method):
    build = segment_module.bloom.build
    monkeypatch.setattr(segment_module.bloom, "BLOCK_CELLS", 16)
    monkeypatch.setattr(segment_module.bloom, "build", lambda words: full(build(words, 1)))

    def full(held):
        held.cells[:] = ~held.cells[0] | held.cells[0]  # every window passes
        return held

    docs = spark.createDataFrame(rows, "id long, text string")
    want = {r["id"]: r["tokens"] for r in segment(docs, dictionary, method, small=True).collect()}
    assert {r["id"]: r["tokens"] for r in segment(docs, dictionary, method, small=False).collect()} == want


def test_texts_are_cut_slice_by_slice(spark, rows, dictionary, monkeypatch):
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    sizes = []
    bounded = segment_module._bounded

    def watched(docs, tokens, name="tokens"):
        sizes.append(name)
        return bounded(docs, lambda texts: tokens(texts) if sum(map(len, texts)) <= 32 else 1 / 0, name)

    monkeypatch.setattr(segment_module, "SLICE_CHARS", 32)
    monkeypatch.setattr(segment_module, "_bounded", watched)
    got = {r["id"]: r["tokens"] for r in segment(docs, dictionary, small=True).collect()}
    assert sizes and got == {i: None if t is None else longest(t) for i, t in rows}


def test_keywords_by_join_have_no_row_per_document_and_token(spark, capsys):
    docs = spark.createDataFrame([(1, ["a", "b", None, "a"]), (2, ["b"]), (3, []), (4, None)], "id long, tokens array<string>")
    found = keywords(docs, 1, False)
    assert [(r["id"], r["token"], r["weight"], r["rank"]) for r in found.orderBy("id").collect()] == [
        (1, "a", round(2 * math.log(4), 9), 1), (2, "b", round(math.log(2), 9), 1)
    ]
    found.explain()
    assert "Window" not in capsys.readouterr().out
