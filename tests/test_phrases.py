import random

import pytest
from pyspark.sql import functions as F

from facetry.operators import bloom, joins, phrases
from facetry.operators.phrases import hit_map, phrase_counts, phrase_hits, phrase_matches

PHRASES = ["aa", "aba", "(^_^)", "^_^", "b", "😀", "😀a", "aab", "(^_^)/~~", "abcabcabcabc", "\\E", "a.b", "好吃"]


def brute(text, listed):
    """Non-overlapping hits per phrase from the left; later entries win a position."""
    hits, counts = {}, {}
    for phrase in listed:
        at = text.find(phrase)
        while at >= 0:
            hits[at] = phrase
            counts[phrase] = counts.get(phrase, 0) + 1
            at = text.find(phrase, at + len(phrase))
    return hits, counts


@pytest.fixture
def sample():
    rng = random.Random(5)
    parts = [*PHRASES, "a", "x", "^", "(", "c", " ", "\n", "好"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(120)]
    long = "".join(rng.choices(parts, k=2000))
    return rows + [(900, long), (901, "aaaaaaa"), (902, ""), (903, None), (904, "xAyA"), (905, "\ufdd0aa\ufdd1b\ufdd2aa$1"), (906, "\ufdd1"), (907, "x" + "ab" * 1501 + "aba")]


@pytest.mark.parametrize("small", [True, False])
def test_hits_and_counts(spark, sample, small):
    docs = spark.createDataFrame(sample, "id long, text string").repartition(4)
    listed = PHRASES + ["A", "ab" * 750]
    table = spark.createDataFrame([(p, i) for i, p in enumerate(listed)], "token string, ord long")
    want_hits, want_counts = set(), set()
    for i, text in sample:
        hits, counts = brute(text or "", listed)
        want_hits |= {(i, at, p) for at, p in hits.items()}
        want_counts |= {(i, p, n) for p, n in counts.items()}
    assert {tuple(r) for r in phrase_hits(docs, table, small).collect()} == want_hits
    assert {tuple(r) for r in phrase_counts(docs, table, small).collect()} == want_counts


def test_true_offsets_after_the_first_hit(spark):
    docs = spark.createDataFrame([(1, "xAyA"), (2, "😀A")], "id long, text string")
    table = spark.createDataFrame([("A", 0)], "token string, ord long")
    rows = hit_map(phrase_hits(docs, table)).orderBy("id").collect()
    assert [[tuple(h) for h in r["hits"]] for r in rows] == [[(1, "A"), (3, "A")], [(1, "A")]]


def test_no_phrases(spark):
    docs = spark.createDataFrame([(1, "abc")], "id long, text string")
    table = spark.createDataFrame([("", 0)], "token string, ord long")
    assert phrase_matches(docs, table).count() == 0
    assert phrase_hits(docs, table).count() == 0


def test_many_first_characters(spark):
    listed = [chr(0x4E00 + 3 * i) + "x" for i in range(300)] + [chr(0x4E00 + 3 * i) for i in range(0, 300, 2)]
    text = "".join(chr(0x4E00 + i) + ("x" if i % 2 else "") for i in range(1000))
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    table = spark.createDataFrame([(p, i) for i, p in enumerate(listed)], "token string, ord long")
    want = brute(text, listed)[0]
    assert {r["pos"]: r["token"] for r in phrase_hits(docs, table).collect()} == want


def test_the_filter_lets_little_through(spark, monkeypatch):
    """Rows that leave the scan: a few times the matches, and one per slice for a piece that is everywhere."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(6, 20)))
    listed = sorted({word() for _ in range(5_000)})
    rows = [(str(i), " ".join([word() for _ in range(60)] + rng.choices(listed, k=3) + ["<everywhere>"])) for i in range(200)]
    docs = spark.createDataFrame(rows, "id string, text string").coalesce(2)
    table = spark.createDataFrame([(p, i) for i, p in enumerate([*listed, "<everywhere>"])], "token string, ord long")
    held = bloom.build(table.select("token"))
    found = phrases.candidates(docs, held)
    matches = phrase_matches(docs, table, False).collect()
    assert sorted(matches) == sorted(phrase_matches(docs, table, True).collect())
    assert len(matches) > 800
    assert found.select(F.sum(F.size("ids"))).first()[0] < 1.5 * len(matches)
    assert found.where("token = '<everywhere>'").count() <= 2
    # many small blocks; and a filter far too small for its list, which loses nothing
    monkeypatch.setattr(bloom, "BLOCK_CELLS", 16)
    for most, cells in ((1 << 20, 4096), (1, 16)):
        tight = bloom.build(table.select("token"), most)
        assert len(tight.cells) == cells
        met = phrases.candidates(docs, tight).join(table, "token").select(F.explode(F.arrays_zip("ids", "places")).alias("m"), "ord")
        assert sorted(map(tuple, met.select("m.ids", "m.places", "ord").collect())) == sorted(map(tuple, matches))


def test_texts_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_CHARS", 7)
    text = "x" * 5 + "abcdefghij" * 3 + "yy" + "abc" * 4
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (1, text)], "id long, text string")
    table = spark.createDataFrame([("abcdefghij", 0), ("abc", 1), ("jab", 2), ("y", 3)], "token string, ord long")
    got = phrase_matches(docs, table, False).collect()
    want = [(1, at, n) for n, p in enumerate(["abcdefghij", "abc", "jab", "y"]) for at in range(len(text)) if text.startswith(p, at)]
    assert sorted(map(tuple, got)) == sorted(want * 2)


def test_a_list_too_large_to_travel_is_joined_once(spark, sample, monkeypatch):
    """No copies of the list per salt, and no further joins with it."""
    def refused(*args, **kwargs):
        raise AssertionError("the list is copied")

    monkeypatch.setattr(joins, "salted_join", refused)
    monkeypatch.setattr(phrases, "fits_broadcast", lambda *args, **kwargs: False)
    docs = spark.createDataFrame(sample, "id long, text string").repartition(4)
    for listed in (PHRASES, ["(^_^)", "^_^", "b", "ab"]):
        table = spark.createDataFrame([(p, i) for i, p in enumerate(listed)], "token string, ord long")
        found = [brute(text or "", listed) for _, text in sample]
        want_hits = {(i, at, p) for (i, _), (hits, _) in zip(sample, found) for at, p in hits.items()}
        want_counts = {(i, p, n) for (i, _), (_, counts) in zip(sample, found) for p, n in counts.items()}
        assert {tuple(r) for r in phrase_hits(docs, table).collect()} == want_hits
        assert {tuple(r) for r in phrase_counts(docs, table).collect()} == want_counts


def test_matches_leave_a_task_slice_by_slice(spark, sample, monkeypatch, capsys):
    monkeypatch.setattr(phrases, "SLICE_CHARS", 40)
    docs = spark.createDataFrame(sample, "id long, text string").coalesce(1)
    table = spark.createDataFrame([(p, i) for i, p in enumerate(PHRASES)], "token string, ord long")
    found = phrase_matches(docs, table, True)
    found.explain()
    assert "Generate" not in capsys.readouterr().out  # no list of all matches of a batch is taken apart
    want = [(i, at, n) for i, t in sample for n, p in enumerate(PHRASES) for at in range(len(t or "")) if t.startswith(p, at)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
