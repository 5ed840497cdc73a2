import ast

import pytest

from facetry.functions.arrays import (
    argmax_class,
    format_score_vector,
    format_token_list,
    one_hot,
    pad_left,
    parse_score_vector,
    parse_token_list,
)


def run(spark, values, kind, column):
    df = spark.createDataFrame(list(enumerate(values)), f"id int, x {kind}")
    return [r[1] for r in df.select("id", column).orderBy("id").collect()]


def test_token_list_text_as_python_writes_it(spark, texts):
    rows = [list(t) for t in texts] + [
        [], ["'"], ['"'], ["'\""], ["\\"], ["\\'", "\\\\"], ["\\U0001F600"], ["a, b", "['x']"],
        ["\x00", "\x7f", "\xa0", "​", "﻿", "　"], ["\U000e0001", "\U0010ffff", "😀"],
        ["牛肉面", "\n\t\r"], ["\\x41", "\\n"],
    ]
    written = [repr(r) for r in rows]
    assert run(spark, written, "string", parse_token_list("x")) == [ast.literal_eval(w) for w in written]


def test_token_list_text_is_read_back(spark, texts):
    rows = [list(t) for t in texts] + [["it's", "\\", "\\n", '"']]
    assert run(spark, rows, "array<string>", parse_token_list(format_token_list("x"))) == rows


def test_score_vector_text(spark):
    given = ["[0.1 0.2 0.3 0.4]", "[ 1.5e-05  2.  .5 1e3]", "[0.1 0.2\n 0.3 0.4]", None]
    want = [[0.1, 0.2, 0.3, 0.4], [1.5e-05, 2.0, 0.5, 1000.0], [0.1, 0.2, 0.3, 0.4], None]
    assert run(spark, given, "string", parse_score_vector("x")) == want
    for bad in ("[a 1 2 3]", "[]", "[1 2 3]", "[1 2 3 nan]"):
        with pytest.raises(Exception, match="not a vector of numbers"):
            run(spark, [bad], "string", parse_score_vector("x"))
    vectors = [[0.1, 1e-9, 3.0, 123456.789]]
    assert run(spark, vectors, "array<double>", parse_score_vector(format_score_vector("x"))) == vectors


def test_pad_left_keeps_the_end(spark):
    rows = [[], [1], [1, 2, 3, 4], [1, 2, 3, 4, 5, 6], None]
    want = [[0, 0, 0, 0], [0, 0, 0, 1], [1, 2, 3, 4], [3, 4, 5, 6], [0, 0, 0, 0]]
    assert run(spark, rows, "array<int>", pad_left("x", 4)) == want


def test_argmax_first_wins_a_tie(spark):
    rows = [[0.1, 0.9, 0.9, 0.2], [0.5] * 4, [0.0, 0.0, 0.0, 1.0], [-1.0, -2.0, -0.5, -0.6], None]
    assert run(spark, rows, "array<double>", argmax_class("x")) == [-1, -2, 1, 0, None]


def test_argmax_rejects_nan(spark):
    with pytest.raises(Exception, match="NaN"):
        run(spark, [[0.1, float("nan"), 0.3, 0.2]], "array<double>", argmax_class("x"))


def test_one_hot(spark):
    want = [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [0, 0, 0, 0], [0, 0, 0, 0]]
    assert run(spark, [-2, -1, 0, 1, 7, None], "int", one_hot("x")) == want


def test_whole_lists_are_read_and_written_like_their_items(spark):
    import random

    rng = random.Random(3)
    parts = ["'", "\\", "\n", "\t", "\r", '"', ", ", "', '", "a", "n", "", "['", "']", "\ufdd0", "\ufdd1", "\ufdd2", "é", "\\'"]
    lists = [["".join(rng.choices(parts, k=rng.randint(0, 4))) for _ in range(rng.randint(0, 5))] for _ in range(300)]
    nulls = [["a", None], [None, "a\ufdd0"], [None], None]
    rows = spark.createDataFrame([(t,) for t in lists + nulls], "t array<string>").withColumn("s", format_token_list("t"))
    for r in rows.withColumn("back", parse_token_list("s")).collect():
        want = None if r["t"] is None else [t for t in r["t"] if t is not None]
        assert r["back"] == want and (want is None or ast.literal_eval(r["s"]) == want)
    foreign = ["['a','b']", "[ 'a', \"b', '\", 'c' ]", "['a\\x41', '\\u4e00']", "['a', 'b'", "['']", "[', ', 'b']", "['a' 'b', 'c']", "['\\d']", "['"]
    read = spark.createDataFrame([(t,) for t in foreign], "s string").select(parse_token_list("s")).collect()
    assert [r[0] for r in read] == [["a", "b"], ["a", "b', '", "c"], ["aA", "一"], ["a", "b"], [""], [", ", "b"], ["a", "b", "c"], ["d"], []]


def test_usual_lists_need_no_pattern_per_item(spark):
    """Read as one text even if the way for odd lists is not there."""
    from pyspark.sql import functions as F

    from facetry.functions import arrays

    rows = spark.createDataFrame([(["a", "'", "\\", "\n", ", ", "b"],)], "t array<string>")
    way = arrays._parse_items
    arrays._parse_items = lambda text: F.raise_error(F.lit("item by item")).cast("array<string>")
    try:
        assert rows.select(parse_token_list(format_token_list("t"))).first()[0] == ["a", "'", "\\", "\n", ", ", "b"]
    finally:
        arrays._parse_items = way
