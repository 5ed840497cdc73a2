import random

import pytest
from test_llm_queries import brute_components, brute_fingerprint

from facetry.llm.components import components
from facetry.llm.simhash import drop_near_copies, fingerprint, links, shared_bytes, simhash_groups


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def groups_of(pairs, nodes):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in pairs:
        label[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def near(rng, centres, n, flips):
    made = set()
    while len(made) < n:
        x = rng.choice(centres)
        for bit in rng.sample(range(64), rng.randint(0, flips)):
            x ^= 1 << bit
        made.add(x)
    return sorted(made)


@pytest.mark.parametrize("list_rows", [2, 64])
@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_group_like_all_pairs(spark, bits, list_rows):
    rng = random.Random(bits)
    prints = near(rng, [rng.getrandbits(64) for _ in range(20)] + [0, 2**64 - 1], 300, 4)
    frame = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    got = [(r["a"], r["b"]) for r in links(frame, bits, list_rows).collect()]
    assert all(0 < ((a ^ b) & (2**64 - 1)).bit_count() <= bits for a, b in got)
    want = [(signed(a), signed(b)) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= bits]
    nodes = [signed(x) for x in prints]
    assert groups_of(got, nodes) == groups_of(want, nodes)


def test_shared_bytes(spark):
    frame = spark.createDataFrame([(signed(0xFF00FF00FF00FF01), 0x1000FF00FF00FF)], "a long, b long")
    a, b = (x & (2**64 - 1) for x in frame.first())
    want = sum((a >> 8 * i & 255) == (b >> 8 * i & 255) for i in range(8))
    assert frame.select(shared_bytes(frame.a, frame.b)).first()[0] == want


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(5)
    chain = list(range(1000, 1200))
    rng.shuffle(chain)
    pairs = list(zip(chain, chain[1:])) + [(1, i) for i in range(2, 300)] + [(500 + i, 500 + (i + 1) % 40) for i in range(40)]
    pairs += [(-5, -9), (-9, -5), (7000, 7000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {x for p in pairs for x in p} - {7000}
    assert got == groups_of([p for p in pairs if p[0] != p[1]], nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


TEXTS = [None, "", " \n", "A b", "a  B", "one", "word " * 70_000, "x\x1cy z", "É é e", "a b c", "a b c d", "\x00 \x01"]


def test_fingerprints():
    for text in TEXTS:
        assert fingerprint(text) == brute_fingerprint(text)
    assert fingerprint("A B") == fingerprint("a\tb")


def test_groups_with_nulls_repeats_and_extra_columns(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(5)]
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    for i in range(60):
        text = rng.choice(base).split()
        text[rng.randrange(300)] = "changed"
        rows.append((100 + i, " ".join(text), "x"))
    rows += [(300, "only", "x"), (300, "only", "x"), (None, "nobody has this text here", "x"), (None, base[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash_groups(docs).collect()
    known = [r for r in rows if r[0] is not None]
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    large = [10**9 if d is None else d for d, _, _ in rows]
    want = brute_components(large, prints, 2)
    assert sorted(
        (10**9 if r["doc_id"] is None else r["doc_id"], r["fingerprint"], r["component_id"] or 10**9 if r["component_id"] != 0 else 0)
        for r in got
    ) == sorted((d, f"{p:016x}", c) for d, p, c in zip(large, prints, want, strict=True))
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        d for (d, _, _), c in zip(rows, want, strict=True) if d is not None and d == c
    )
    assert len(known) == len(rows) - 2


def test_copies_are_dropped_by_id_and_text(spark):
    text = [" ".join(f"{a}{i}" for i in range(40)) for a in "abcd"]
    rows = [(1, text[0], "stays"), (7, text[0], "goes"), (7, text[1], "stays"), (8, text[0], "goes"), (None, text[0], "goes"),
            (None, text[2], "one"), (None, text[2], "one"), (None, text[3], "single"), (9, None, "stays"), (9, None, "stays")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fate string")
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    want = [r for r in rows if r[2] == "stays"] + sorted({r for r in rows if r[2] in ("one", "single")}, key=str)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(empty).count() == 0 and drop_near_copies(empty).count() == 0
