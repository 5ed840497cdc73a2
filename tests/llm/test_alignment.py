import functools
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from facetry.llm import alignment
from facetry.llm.alignment import Encoder, Tokenisers, align, merge_path
from facetry.llm.queries import BYTE_MODEL, PIECE_MODEL, op11_alignment


@pytest.fixture(scope="module")
def tokenisers():
    return Tokenisers(BYTE_MODEL, PIECE_MODEL)


@functools.cache
def libraries():
    a = Tokenizer.from_file(BYTE_MODEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def encoded(tokenisers, text):
    """Whole texts by the public libraries, without chunks."""
    a, b = libraries()
    if not text:
        return [], []
    x = a.encode(" " + text, add_special_tokens=False).ids
    y = b.encode(text, num_threads=1)
    whole = (" " + text).encode()
    same = all(b"".join(raw[i] for i in ids) == whole for raw, ids in ((tokenisers.raw_a, x), (tokenisers.raw_b, y)))
    return (x, y) if same else ([], [])


def spans(raw, ids):
    ends = np.cumsum([len(raw[i]) for i in ids]).tolist()
    return list(zip([0, *ends], ends, strict=False))


def brute(tokenisers, texts):
    rows, counts = [], Counter()
    for text in texts:
        x, y = encoded(tokenisers, text)
        sx, sy = spans(tokenisers.raw_a, x), spans(tokenisers.raw_b, y)
        # the tokens that hold each byte
        held = [[i for i, (p, q) in enumerate(sp) for _ in range(p, q)] for sp in (sx, sy)]
        links = [(x[i], y[j]) for i, j in sorted(set(zip(*held, strict=True)))]
        counts.update(links)
        ends = sorted({e for _, e in sx} & {e for _, e in sy})
        groups, begin = [], 0
        for end in ends:
            parts = [[i for i, s in zip(ids, sp, strict=True) if begin <= s[0] < end] for ids, sp in ((x, sx), (y, sy))]
            groups.append("|".join(",".join(map(str, p)) for p in parts))
            begin = end
        rows.append((len(x), len(y), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (*row[:3], len(row[3]), sum(counts[p] == best[p[1]] for p in row[3]), sum(counts[p] for p in row[3]), row[4]) for row in rows
    ]


ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "a\nb", "a\n b", "a \n b", "a\n \nb", "a\t \tb  \n\n c", "\n\nx", "x 　y", "x \x1cy", "it's we'll 'd 12 345",
    "<|endoftext|> </s> <s><unk><0x41>", "a▁b", "ünïcödé 東京 😀👩‍💻", "é" * 700, "ab" * 3000, "word " * 400, "\x00\x01", "a᠎ b ᠎ c", "x  y  z",
]


def texts():
    rng = random.Random(11)
    letters = list("abcdeéñ  \n\t.,'!0123東😀") + [" the ", " and", "ing ", "  ", "’s"]
    return ODD + ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(150)]


@pytest.mark.parametrize("max_pairs", [4_000_000, 40, 0])
def test_against_brute_force(spark, tokenisers, max_pairs):
    given = texts()
    given = given + given[:30]
    want = brute(tokenisers, given)
    frame = spark.createDataFrame([(k if k % 7 else None, t, "x") for k, t in enumerate(given)], "doc_id long, text string, groups string")
    got = align(frame.repartition(3), BYTE_MODEL, PIECE_MODEL, max_pairs=max_pairs).collect()
    rows = [(k if k % 7 else None, *w) for k, w in enumerate(want)]
    assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)


def test_the_query_on_a_whole_table(spark, tokenisers):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute(tokenisers, [r["text"] for r in rows])
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_alignment(spark, sf).collect()}
    assert got == {r["doc_id"]: (*w[:-1], digest(w[-1])) for r, w in zip(rows, want, strict=True)}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert align(frame, BYTE_MODEL, PIECE_MODEL).collect() == []


@pytest.mark.parametrize("piece", [1, 2, 3, 64])
def test_pieces_of_any_size_give_the_same_links(tokenisers, monkeypatch, piece):
    encoder = Encoder(tokenisers)
    given = [t for t in texts() if t is None or len(t) < 200]

    def run():
        aligned = encoder.slice(pa.array(given, pa.string()))
        links = sorted(zip(*[np.concatenate(x).tolist() for x in zip(*aligned.links(), strict=True)], strict=True))
        return links, aligned.groups(), aligned.n_groups().tolist()

    whole = run()
    monkeypatch.setattr(alignment, "PIECE", piece)
    assert run() == whole
    assert [g.decode() for g in whole[1]] == [w[-1] for w in brute(tokenisers, given)]


def test_pieces_are_of_equal_work_and_keep_equal_ends_together():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = (np.sort(rng.choice(300, rng.integers(1, 200), replace=False)) for _ in range(2))
        cuts = merge_path(a, b, 16)
        assert cuts[0] == (0, 0) and cuts[-1] == (len(a), len(b))
        for (i0, j0), (i1, j1) in zip(cuts, cuts[1:], strict=False):
            assert i0 <= i1 and j0 <= j1 and i1 - i0 + j1 - j0 <= 17
            done = [*a[:i1], *b[:j1]]
            left = [*a[i1:], *b[j1:]]
            assert not done or not left or max(done) < min(left)


def test_chunks_are_encoded_as_in_their_text(tokenisers):
    a, b = libraries()
    encoder = Encoder(tokenisers)
    for text in texts():
        different, places = encoder.chunks(pa.array([text, "x", text], pa.string()))
        chunks = [different[i] for i in places[2].tolist()]
        assert places[0].tolist() == places[2].tolist() and [different[i] for i in places[1].tolist()] == ["x"]
        assert "".join(" " + c for c in chunks) == (" " + text if text else "")
        parts = [encoder.a.encode_ordinary(" " + c) for c in chunks]
        assert sum(parts, []) == a.encode(" " + text if text else "", add_special_tokens=False).ids
        parts = encoder.b.encode(chunks, num_threads=1)
        assert sum(parts, []) == b.encode(text or "", num_threads=1) or text in ("", None)


def test_the_cache_is_bounded(tokenisers, monkeypatch):
    encoder = Encoder(tokenisers)
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 50)
    given = [t for t in texts() if t is None or len(t) < 200]
    want = brute(tokenisers, given)
    for begin in range(0, len(given), 10):
        part = encoder.slice(pa.array(given[begin : begin + 10], pa.string()))
        list(part.links())
        assert [g.decode() for g in part.groups()] == [w[-1] for w in want[begin : begin + 10]]
        assert len(encoder.place) <= 200
