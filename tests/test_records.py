"""CSV records cut by quote parity, against Python's reader and against one task per file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from facetry.schema import ASPECT_COLUMNS, review_schema
from facetry.sources import records, reviews


@pytest.fixture
def small_splits(spark):
    """Splits of some 40 bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def written(path, rows, end):
    text = io.StringIO()
    csv.writer(text, lineterminator=end).writerows(rows)
    path.write_bytes(text.getvalue().encode())
    return path


def cells(rng):
    return "".join(rng.choices(["a", "好", '"', ",", "\n", "\r\n", " ", "\n" * 20, "x" * 50], k=rng.randrange(5)))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_pythons_reader(spark, tmp_path, small_splits, end):
    rng, want = random.Random(5), []
    for name in ("a.csv", "b.csv", "c.csv"):
        rows = [[f"{name}{i}", *(cells(rng) for _ in range(3)), "z"] for i in range(40)]
        written(tmp_path / name, rows, end)
        want += rows
    assert len({r["start"] for r in records.split_quotes(spark, str(tmp_path)).collect()}) > 20
    assert records.split_quotes(spark, str(tmp_path)).where("inside").count() > 20
    got = records.read_records(spark, str(tmp_path)).collect()
    made = [next(csv.reader(io.StringIO(r["record"], newline=""), strict=True)) for r in got]
    assert sorted(made) == sorted(want)
    assert sorted(m[0] for m, r in zip(made, got, strict=True) if r["first"]) == ["a.csv0", "b.csv0", "c.csv0"]


def test_a_record_over_many_splits_and_batches(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}, \"\"" for i in range(2_000))
    rows = [["h", long], ["", ""], [long, "1"], ["2", "3"]]
    path = written(tmp_path / "long.csv", rows, "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = records.read_records(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(next(csv.reader(io.StringIO(r["record"]))) for r in got) == sorted(rows)
    assert [r["record"].startswith("h") for r in got if r["first"]] == [True]


def test_both_ways_of_reading_agree(spark, tmp_path, small_splits):
    rng = random.Random(6)
    head = ["id", "extra", "content", *ASPECT_COLUMNS]
    for name in ("a.csv", "b.csv"):
        rows = [[str(i), cells(rng), cells(rng), *[str(rng.randrange(-2, 2)) for _ in ASPECT_COLUMNS]] for i in range(20)]
        written(tmp_path / name, [head, *rows], "\n")
    ways = [sorted(map(tuple, reviews.read_reviews(spark, str(tmp_path), split=s).collect()), key=str) for s in (True, False)]
    assert len(ways[0]) == 40 and ways[0] == ways[1]
    assert reviews.read_reviews(spark, str(tmp_path)).rdd.getNumPartitions() > 20


def test_blank_lines_and_a_byte_order_mark(spark, tmp_path):
    head = "id,content," + ",".join(ASPECT_COLUMNS)
    labels = ",".join(["1"] * 20)
    (tmp_path / "r.csv").write_bytes(f'﻿{head}\r\n\r\n1,,{labels}\r\n\n2,"",{labels}'.encode())
    rows = reviews.read_reviews(spark, str(tmp_path / "r.csv")).select("id", "content").collect()
    assert sorted(map(tuple, rows)) == [(1, None), (2, "")]
    (tmp_path / "none.csv").write_text(head + "\n")
    assert reviews.read_reviews(spark, str(tmp_path / "none.csv")).count() == 0


@pytest.mark.parametrize("content", ['5" wide and 6" long', '"a"b', 'a"b,c\nd"', '"a" ,"b"', ' "a"'])
def test_stray_quotes_are_an_error(spark, tmp_path, content):
    schema = review_schema()
    labels = ",".join(["1"] * 20)
    (tmp_path / "r.csv").write_text(",".join(schema.names) + f"\n1,{content},{labels}\n")
    with pytest.raises(Exception, match="stray quote"):
        reviews.read_reviews(spark, str(tmp_path / "r.csv")).collect()
    (tmp_path / "r.csv").write_text(",".join(schema.names) + f'\n1,"open,{labels}\n')
    with pytest.raises(ValueError, match="ends inside quotes"):
        reviews.read_reviews(spark, str(tmp_path / "r.csv"))


def test_doubled_quotes_are_not_stray(spark):
    good = ['"",1', '"a""b",c', '"""",""', 'a,"b","c"', '"a,""\n,"', 'plain', '"""a"""']
    rows = spark.createDataFrame([(g,) for g in good], "r string").select(records.stray_quote(F.col("r")).alias("s"))
    assert not any(r["s"] for r in rows.collect())
