import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from facetry.llm.substrings import COVERS, Anchors, repeated_passages
from facetry.llm.texts import Runs, Words, slices

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in cut:
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in cut:
        gone = set()
        for at in range(len(w) - window + 1):
            if i is not None and first[tuple(w[at : at + window])] < i:
                gone.update(range(at, at + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window, **options):
    found = repeated_passages(spark.createDataFrame(rows, SCHEMA), window=window, **options)
    return sorted((tuple(r) for r in found.drop("kept").collect()), key=str)


@pytest.mark.parametrize("period", [p for p in COVERS if p > 1])
def test_covers_hold_every_difference(period):
    assert {(a - b) % period for a in COVERS[period] for b in COVERS[period]} == set(range(period))


@pytest.mark.parametrize("window", [5, 12, 50])
def test_equal_windows_share_an_aligned_anchor(window):
    anchors = Anchors(window)
    for i in range(anchors.period):
        for j in range(anchors.period):
            assert any(
                anchors.covered[(i + d) % anchors.period] and anchors.covered[(j + d) % anchors.period]
                for d in range(window - anchors.length + 1)
            )


@pytest.mark.parametrize("window", [5, 12, 50])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    word = lambda: rng.choice("abcdefgh")
    passages = [[word() + word() for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = [word() + word() + word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            begin = rng.randint(0, 3)
            at = rng.randint(0, len(words))
            words[at:at] = passage[begin : len(passage) - rng.randint(0, 3)]
        rows.append((i * 3 % 121, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(500 + i, rows[7][1]) for i in range(5)] + [(600, rows[3][1]), (601, rows[3][1] + " x")]
    assert run(spark, rows, window) == brute(rows, window)
    assert run(spark, rows, window, filter_bits=64) == brute(rows, window)


def test_edge_cases(spark):
    line = " ".join(f"w{k}" for k in range(60))
    rows = [
        (5, line), (3, "x " + line), (None, line), (None, line), (1, None), (2, ""), (4, "  \n\t "), (9, "w1 w2"),
        (3, "x " + line), (3, line + " other"),  # a row and an id repeated
        (20, " ".join(["a"] * 200)), (21, "a " * 50), (22, "a " * 49),
        (30, "A\x1cb " * 60), (31, "a\x1cb " * 60), (32, "Ä ö " * 60), (33, " Ä ö" * 55),
        (40, " ".join(f"w{k % 60}" for k in range(30_000))),
    ]
    assert run(spark, rows, 50) == brute(rows, 50)
    assert run(spark, [], 50) == []
    assert run(spark, [(1, None)], 50) == brute([(1, None)], 50)


def test_other_columns_do_not_clash(spark):
    line = " ".join(f"w{k}" for k in range(60))
    rows = [(1, line, 0, "s", "t"), (2, "y " + line, 1, "s", "t")]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, id int, sha string, kept string"))
    assert sorted((r["doc_id"], r["n_removed"], r["kept"]) for r in found.collect()) == [(1, 0, None), (2, 60, "y")]


def test_run_codes_do_not_depend_on_their_place():
    words = Words(pa.array(["a b c a b c", None, "x a b", ""]))
    assert words.sizes.tolist() == [6, 0, 3, 0] and words.starts.tolist() == [0, 6, 6, 9]
    runs = Runs(words)
    for which in (0, 1):
        codes = runs.codes(np.array([0, 3, 7, 1]), 2, which)
        assert codes[0] == codes[1] == codes[2] != codes[3]


def test_slices_cover_all_texts_once():
    texts = pa.array(["ab"] * 10 + ["c" * 50, None, "d"])
    assert list(slices(texts, 6)) == [(0, 3), (3, 6), (6, 9), (9, 10), (10, 11), (11, 13)]
