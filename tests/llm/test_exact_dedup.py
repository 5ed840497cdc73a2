import pytest
from pyspark.sql import functions as F

from facetry.llm.exact_dedup import drop_copies, exact_groups

ROWS = [
    (5, "a  b"), (2, "a\tb"), (9, "a b "), (1, None), (4, ""), (7, "\n"), (8, " "), (None, "a b"), (3, "A b"),
    (6, "x" * 100_000), (10, "x" * 100_000), (11, "a\u00a0b"),
]


def brute(rows):
    import re

    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    return {
        (doc, min((d for d in ids if d is not None), default=None), len(ids)) for ids in groups.values() for doc in ids
    }


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("weak", [False, True])
def test_groups(spark, weak):
    # a hash of one digit collides all the time; the bytes still decide
    content_hash = (lambda c: F.substring(F.md5(c), 1, 1)) if weak else F.md5
    got = exact_groups(frame(spark, ROWS), content_hash=content_hash).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == brute(ROWS)
    assert len(got) == len(ROWS)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_digests_that_do_not_tell_texts_apart_stop_the_run(spark, monkeypatch):
    monkeypatch.setattr(F, "sha2", lambda c, n: F.lit("same"))
    with pytest.raises(RuntimeError, match="share both digests"):
        exact_groups(frame(spark, ROWS), content_hash=lambda c: F.lit("same"))


def test_repeated_rows_keep_one(spark):
    got = exact_groups(frame(spark, [(1, "t"), (1, "t"), (2, "t"), (None, "u"), (None, "u")])).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in got) == [
        (0, 0, 2, False), (0, 0, 2, True), (1, 1, 3, False), (1, 1, 3, True), (2, 1, 3, False),
    ]


def test_hot_text_and_empty_table(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i // 2}") for i in range(3000)]
    got = exact_groups(frame(spark, rows)).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == brute(rows)
    assert exact_groups(frame(spark, [])).count() == 0
    assert drop_copies(frame(spark, [])).count() == 0


def test_drop_copies_keeps_all_columns(spark):
    rows = [(*r, f"s{i}", i) for i, r in enumerate([*ROWS, (2, "a b"), (2, "a b")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string, copies int")
    got = drop_copies(docs)
    assert got.columns == docs.columns
    # of the three rows with id 2 and equal texts the smallest one stays
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 2, 3, 6, 7, 9, 11]
