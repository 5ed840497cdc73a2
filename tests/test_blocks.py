import random

import pyarrow as pa
from pyspark.sql import types as T

from facetry.operators import blocks


def test_blocks_hold_every_document_once(spark):
    rng = random.Random(2)
    rows = [(f"d{k}", rng.choices(["a", "b", None, "c d", ""], k=rng.randint(0, 9)), [float(k)]) for k in range(70)]
    rows += [("null", None, [0.0]), ("none", [], [1.0])]
    docs = spark.createDataFrame(rows, "id string, tokens array<string>, q array<double>").repartition(3)
    packed = blocks.pack(docs, "tokens", "q", most=20)
    listed = blocks.dictionaries(packed, "token", T.StringType())
    seen = listed.collect()
    assert len({(r["block"], r["token"]) for r in seen}) == len(seen)  # distinct within each block

    def lengths(documents, found, entries):
        words = dict(zip(found["code"].to_pylist(), found["token"].to_pylist(), strict=True))
        assert [words[k] for k in range(len(entries))] == entries.to_pylist()
        texts = [[None if c is None else words[c] for c in codes] for codes in documents.column("codes").to_pylist()]
        return pa.table({"id": documents.column("id"), "tokens": pa.array(texts, pa.list_(pa.string())), "q": documents.column("q")})

    got = blocks.meet(packed, listed, lengths, "id string, tokens array<string>, q array<double>", entries=True).collect()
    assert sorted(map(tuple, got)) == sorted((i, t or [], q) for i, t, q in rows)
    assert packed.count() > 10


def test_a_block_without_anything_found_is_kept(spark):
    docs = spark.createDataFrame([(1, ["x", "y"]), (2, [])], "id long, tokens array<string>")
    packed = blocks.pack(docs, "tokens")
    nothing = blocks.dictionaries(packed, "token", T.StringType()).where("false")
    got = blocks.meet(packed, nothing, lambda d, found: pa.table({"id": d.column("id")}), "id long")
    assert sorted(r["id"] for r in got.collect()) == [1, 2]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "id long, tokens array<string>")
    assert blocks.pack(docs, "tokens").count() == 0
