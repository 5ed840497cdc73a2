import math
import random

import numpy as np
import pytest

from facetry.operators import matcher as m


def brute(words, texts):
    out, begin = set(), 0
    for text in texts:
        out |= {(begin + i, w) for i in range(len(text)) for w in words if text.startswith(w, i)}
        begin += len(text)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_all_matches(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choices("ab好😀﻿", k=rng.choice([1, 1, 2, 3, 5, 8, 17]))) for _ in range(60)})
    texts = ["".join(rng.choices("ab好😀﻿", k=rng.randint(0, 60))) for _ in range(80)] + [""]
    start, word, ends = m.Matcher(words).matches(texts)
    assert {(s, words[w]) for s, w in zip(start.tolist(), word.tolist())} == brute(words, texts)
    assert len(start) == len(brute(words, texts))
    assert ends.tolist() == np.cumsum([len(t) for t in texts]).tolist()


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(m.Matcher, "_sums", lambda self, codes: (np.zeros(len(codes) + 1, np.uint64),) * 2)
    words = ["ab", "ba", "aab", "c"]
    start, word, _ = m.Matcher(words).matches(["aabac", "b"])
    assert {(s, words[w]) for s, w in zip(start.tolist(), word.tolist())} == brute(words, ["aabac", "b"])


def test_long_entries_with_a_common_start():
    words = ["http://" + "x" * n for n in (1, 700, 1500, 1501)]
    text = "http://" + "x" * 1500 + " http://xy"
    start, word, _ = m.Matcher(words).matches([text])
    assert sorted(zip(start.tolist(), word.tolist())) == [(0, 0), (0, 1), (0, 2), (1508, 0)]


def test_no_words_and_no_texts():
    assert m.Matcher([]).matches(["abc"])[0].size == 0
    steps, ends = m.Matcher(["a"]).longest_steps([])
    assert steps.size == 0 and ends.size == 0
    steps, _ = m.Matcher(["a"]).likeliest_steps(["", ""], np.zeros(1), -1.0)
    assert steps.size == 0


def test_likeliest_steps_against_every_cut():
    rng = random.Random(3)
    words = ["a", "ab", "abc", "bc", "cab", "caba", "b好"]
    weights = np.log(np.array([5, 3, 9, 4, 2, 7, 6]) / 36)
    floor = -math.log(36)
    listed = dict(zip(words, weights))

    def best(text):
        if not text:
            return 0.0, 0
        options = {1: floor} | {len(w): v for w, v in listed.items() if text.startswith(w)}
        return max((v + best(text[n:])[0], n) for n, v in options.items())

    for _ in range(60):
        text = "".join(rng.choices("abc好 ", k=rng.randint(1, 11)))
        steps, _ = m.Matcher(words).likeliest_steps([text, text], weights, floor)
        at = 0
        total = 0.0
        for cut in m.cut_places(steps[: len(text)]).tolist():
            token = text[cut : cut + int(steps[cut])]
            total += listed.get(token, floor)
            assert cut == at
            at += len(token)
        assert total == pytest.approx(best(text)[0])
        assert steps[: len(text)].tolist() == steps[len(text) :].tolist()
