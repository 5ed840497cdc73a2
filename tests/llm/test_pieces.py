import random

import numpy as np
import pytest
import sentencepiece

from facetry.llm.pieces import Decoder, Encoder, Vocabulary, decode, encode, merge
from facetry.llm.queries import PIECE_MODEL


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def texts(vocabulary):
    rng = random.Random(7)
    letters = list("ab  \n\t\x00éß好吃'!thein ") + ["</s>", "<unk>", "<0x0A>", "   ", "😀", "🏽"]
    made = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(800)]
    pieces = [p.replace("▁", " ") for p in vocabulary.plain]
    made += ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(800)]
    return [*made, "", " ", "  ", "a" * 5000, "ab" * 3000, " " * 1000, " " * 37 + "(", "\n\n", "é" * 300]


def ids(data):
    return None if data is None else np.frombuffer(data, "<i4").tolist()


def test_equals_the_public_library_and_reads_back(vocabulary, library):
    given = texts(vocabulary)
    encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
    for text, made in zip(given, encoder.encode(given), strict=True):
        assert ids(made) == library.encode(text), text[:80]
        assert decoder.decode(ids(made)) == text
    assert [ids(x) for x in encoder.encode(given)] == [library.encode(t) for t in given]  # from the cache
    small = Encoder(vocabulary, cache_words=50)
    assert [ids(x) for part in (given[:300], given[300:]) for x in small.encode(part)] == [library.encode(t) for t in given]


def test_plain_merging(vocabulary, library):
    for text in ["hello there", "the  cat", "aaaaaaa"]:
        made = merge(list("▁" + text.replace(" ", "▁")), vocabulary)
        assert [vocabulary.plain[p] for p in made] == library.encode(text)


def test_borders_follow_from_the_halves(vocabulary):
    encoder = Encoder(vocabulary)
    rng = random.Random(1)
    plain = vocabulary.plain
    usable = [p for p, i in plain.items() if len(p) == 1 or encoder.left[i] >= 0]
    tails = [p for p in usable if "▁" not in p]
    pairs = [(rng.choice(usable), rng.choice(tails)) for _ in range(4000)]
    got = encoder.keep_borders(np.array([plain[a] for a, _ in pairs]), np.array([plain[b] for _, b in pairs]))
    for (a, b), kept in zip(pairs, got.tolist(), strict=True):
        assert kept == (merge(list(a + b), vocabulary) == [a, b]), (a, b)


def test_occurrences_of_every_piece(vocabulary):
    encoder = Encoder(vocabulary)
    text = "▁the▁theatre\n▁and"
    codes = encoder.code[[ord(c) for c in text]]
    start, end, piece = encoder.edges(codes)
    names = {i: p for p, i in vocabulary.plain.items()}
    found = {(s, names[i]) for s, e, i in zip(start.tolist(), end.tolist(), piece.tolist()) if e - s == len(names[i])}
    usable = {names[i] for i in encoder.pieces.tolist()}
    assert found == {(i, text[i : i + n]) for i in range(len(text)) for n in range(1, 17) if i + n <= len(text) and text[i : i + n] in usable}
    assert list(end) == sorted(end)


def test_on_spark(spark, vocabulary, library):
    given = [*texts(vocabulary)[:200], None, "a▁b"]
    rows = [(i, t, "x") for i, t in enumerate(given)] + [(None, "the", "x"), (3, "the", "x")]
    made = encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PIECE_MODEL, check=True)
    got = made.collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["ids"] or []) for r in got) == sorted(
        ((-1 if i is None else i), [] if t is None else library.encode(t)) for i, t, _ in rows
    )
    assert [r["ids"] for r in got if r["doc_id"] == 200] == [None]
    back = {(r["doc_id"], r["text"]) for r in decode(made, PIECE_MODEL).collect()}
    assert back == {(i, None if t is None else t.replace("▁", " ")) for i, t, _ in rows}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert encode(empty, PIECE_MODEL).count() == 0


def test_decoding_odd_ids(vocabulary):
    decoder = Decoder(vocabulary)
    assert decoder.decode([]) == "" and decoder.decode(None) is None and decoder.decode([1, 2]) == ""
    assert decoder.decode([vocabulary.bytes[0xFF]]) == "\ufffd"
    with pytest.raises(ValueError):
        decoder.decode([32_000])
    with pytest.raises(ValueError):
        decoder.decode([-1])
