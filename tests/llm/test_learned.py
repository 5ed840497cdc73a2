"""Language, toxicity and quality: their rules on small inputs."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from facetry import session
from facetry.llm import langid, quality, toxicity, toxicity_chunks
from facetry.llm.common import LETTER_RUN, LETTERS



def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


LANGS = [(i, t, lang, "x") for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 20)]


def test_words_first_then_shorter_ngrams(spark):
    model = langid.train(docs(spark, LANGS), F.lit(True))
    assert model.langs == ["de", "en"]
    assert model.predict("the dog")[0] == "en" and model.predict("DIE KATZE")[0] == "de"
    assert model.predict("thecat")[0] == "en"  # no such word: its 5-grams " thec" .. are tried, then shorter ones
    assert "dogs" not in model.words.row
    long = [g for g in model.split("hunde", 5) if g in model.grams[5].row]
    assert long == [" hund"] and np.allclose(model.unseen("hunde"), model.grams[5].logs[model.grams[5].row[" hund"]])
    only = model.unseen("xxdxx")  # nothing but its single letter d is known
    assert np.allclose(only, model.grams[1].logs[model.grams[1].row["d"]])
    assert not model.unseen("щщщ").any()


def test_language_edge_cases(spark):
    rows = [(1, None, "en", "x"), (2, "", None, "x"), (3, "123 !?", "de", "x"), (None, "the the", None, "x"), (4, "щ", None, "x"),
            (5, "the " * 50_000, None, "x"), (6, "a" * 100_000, None, "x"), (6, "a" * 100_000, None, "x")]
    model = langid.train(docs(spark, LANGS), F.lit(True))
    got = [tuple(r) for r in langid.predict(docs(spark, rows), model).collect()]
    assert len(got) == len(rows)
    by = {r[0]: r[1:] for r in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[None][0] == by[5][0] == "en" and all(0 <= r[2] <= 1 for r in got)
    nothing = langid.train(docs(spark, rows[1:3]).where("lang IS NULL"), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(docs(spark, rows), nothing).collect()} == {"und"}
    assert langid.predict(docs(spark, []), model).count() == 0


def test_only_letters_make_words(spark):
    model = langid.train(docs(spark, LANGS), F.lit(True))
    odd = ["½ ²", "Ⅷ ①", "٣ 4", "_ -", "́ ̈"]
    got = langid.predict(docs(spark, [(i, t, None, "x") for i, t in enumerate(odd)]), model).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    # the runs that training counts on Spark are those that a prediction finds
    texts = ["été ½x² Ⅷa", "ǅ ʰx ªb 漢字かな", "e\u0301te", "\U0001d4d0b \u2160c", "a_b'c\u200dd", "ß ſ ŉ İi"]
    cut = F.regexp_extract_all(F.lower("text"), F.lit(LETTER_RUN), F.lit(0)).alias("w")
    for row in docs(spark, [(i, t, None, "x") for i, t in enumerate(texts)]).select("text", cut).collect():
        assert row["w"] == LETTERS.findall(row["text"].lower()), row["text"]


def test_a_script_without_blanks_keeps_its_words(spark):
    """A "word" of such a text is a whole sentence, which occurs once."""
    rng = random.Random(5)
    listed = ["我们", "他们", "的人", "这里", "不是", "了解", "在家", "有一"]
    sentence = lambda: "".join(rng.choices(listed, k=6))
    han = [(100 + i, "。".join(sentence() for _ in range(20)), "zh", "x") for i in range(30)]
    common = [(200 + i, "the cat and the dog " * 20, "en", "x") for i in range(300)]
    model = langid.train(docs(spark, LANGS + han[:25] + common), F.lit(True))
    assert {model.predict(t)[0] for _, t, _, _ in han[25:]} == {"zh"}
    assert all(w in model.words.row for _, t, _, _ in han[:25] for w in t.split("。"))


def test_language_scores_by_hand(spark):
    """The sums, done again in plain Python."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["aba", "cab", "bac", "dada", "ab"] if i % 2 else ["dad", "add", "aba", "bad"], k=6)), "xy"[i % 2], "x") for i in range(30)]
    model = langid.train(docs(spark, rows), F.lit(True))
    counts = [Counter(w for i, t, _, _ in rows if i % 2 == c for w in t.split()) for c in (0, 1)]

    def table(tallies):
        keys = set(tallies[0]) | set(tallies[1])
        logs = {k: [np.log((t.get(k, 0) + 0.5) / (sum(t.values()) + 0.5 * len(keys))) for t in tallies] for k in keys}
        return {k: np.array(v) - np.mean(v) for k, v in logs.items()}

    def grams(w, n):
        w = f" {w} " if n > 1 else w
        return [w[i : i + n] for i in range(len(w) - n + 1)]

    words = table([dict(c) for c in counts])
    shorter = {}
    for n in range(1, 6):
        tallies = [{}, {}]
        for c in (0, 1):
            for w, k in counts[c].items():
                for g in grams(w, n):
                    tallies[c][g] = tallies[c].get(g, 0) + k**0.5
        shorter[n] = table(tallies)
    for text in ("aba dad cab", "dadas", "abax zzz bad bad", "d"):
        total = np.zeros(2)
        for w in text.split():
            if w in words:
                total += words[w]
                continue
            for n in range(5, 0, -1):
                known = [shorter[n][g] for g in grams(w, n) if g in shorter[n]]
                if known:
                    total += np.mean(known, axis=0)
                    break
        prior = np.log(np.array([16, 16]) / 32)
        scaled = np.exp(prior + total / len(text.split()) ** 0.5)
        best = int(np.argmax(prior + total))
        lang, score = model.predict(text)
        assert lang == "xy"[best] and score == pytest.approx(scaled[best] / scaled.sum(), abs=1e-5)


def test_language_learns_only_where_it_may(spark):
    held = docs(spark, [*LANGS, *[(100 + i, "zzz yyy", "xx", "x") for i in range(9)]])
    model = langid.train(held, F.col("doc_id") < 100)
    assert model.langs == ["de", "en"] and "zzz" not in model.words.row


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("alo", "ema", "iru", "ono")]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 400))
        if i % 4 == 0:
            for _ in range(rng.randint(2, 4)):
                text[rng.randrange(len(text))] = rng.choice(["nasty", "vile", "rotten"])
        rows.append((i, " ".join(text), "en", "x"))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("quality", F.col("toxic"))


def test_toxic_words_in_long_texts(spark):
    rows, labels = corpus()
    model = toxicity.train(docs(spark, rows), labelled(spark, labels), F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r for r in toxicity.predict(docs(spark, rows), model).collect()}
    held = [(i, y) for i, y in labels if i % 5 == 0]
    assert np.mean([got[i]["predicted"] == y for i, y in held]) > 0.95
    odd = [(1, None, None, "x"), (2, "", None, "x"), (3, "vile", None, "x"), (4, "balo " * 60_000, None, "x"), (None, "1 2", None, "x"), (3, "vile", None, "x")]
    odd = toxicity.predict(docs(spark, odd), model).collect()
    assert len(odd) == 6 and all(0 <= r["score"] <= 1 for r in odd)
    scores = {r["doc_id"]: r["score"] for r in odd}
    assert scores[1] == scores[2] == scores[None] and scores[3] > 0.5 > scores[4]


def plain_toxicity(learned, everything):
    """The class models by their formulas over strings: a function from (word before, word) to the log-ratio."""

    def pairs_of(text):
        words = re.findall("[^\\W\\d_]+", (text or "").lower())
        return list(zip(["", *words[:-1]], words))

    def discounts(counts):
        n1, n2, n3, n4 = (sum(c == k for c in counts) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = [
            1 - 2 * y * n2 / n1 if n1 else 0.5,
            2 - 3 * y * n3 / n2 if n2 else 1.0,
            3 - 4 * y * n4 / n3 if n3 else 1.5,
        ]
        cut = [0.0, *[min(max(d, 0.1 * k), 0.95 * k) for k, d in zip((1, 2, 3), raw)]]
        return lambda c: cut[min(c, 3)]

    n = {c: Counter(g for y, t in learned if y == c for g in pairs_of(t)) for c in (0, 1)}
    listed = set(n[0]) | set(n[1])
    n["all"] = Counter(g for t in everything for g in pairs_of(t) if g in listed)
    off = {c: discounts([k for k in n[c].values() if k]) for c in n}
    words = {w for g in listed for w in g}
    contexts = Counter(w for _, w in listed)
    share = lambda w: (contexts[w] + 0.5) / (len(listed) + 0.5 * (len(words) + 1))
    own = {}
    for c in (0, 1):
        single = Counter()
        for (_, w), k in n[c].items():
            single[w] += k
        cut, total = discounts(list(single.values())), sum(single.values())
        left = sum(cut(k) for k in single.values()) / total
        own[c] = lambda w, s=single, cut=cut, left=left, total=total: max(s[w] - cut(s[w]), 0) / total + left * share(w)

    def level(c, v, w, below):
        after = {g: k for g, k in n[c].items() if g[0] == v}
        total = sum(after.values())
        if not total:
            return below
        left = sum(off[c](k) for k in after.values()) / total
        return max(after.get((v, w), 0) - off[c](after.get((v, w), 0)), 0) / total + left * below

    def ratio(v, w):
        p = [level(c, v, w, level("all", v, w, own[c](w))) for c in (0, 1)]
        return np.log(p[1] / p[0])

    return ratio, own, words


def test_toxicity_against_plain_models(spark):
    """Every ratio of two small class models, with unlabelled documents in the shared counts."""
    rng = random.Random(3)
    words = ["Alo", "bema", "ciru", "dono", "\u00e9t\u00e9", "\u6c34"]
    text = lambda extra: " ".join(rng.choices(words + extra, k=rng.randint(1, 12)))
    learned = [(y, text(["vile", "rot"] if y else ["mild"])) for y in (0, 1) for _ in range(12)]
    everything = [*[t for _, t in learned], *[text(["vile", "new"]) for _ in range(40)], None, "", "1 2"]
    counted = spark.createDataFrame(learned, "y int, text string").repartition(3)
    texts = spark.createDataFrame([(t,) for t in everything], "text string").repartition(4)
    model = toxicity.fit(counted, texts)
    ratio, own, known = plain_toxicity(learned, everything)
    for c in (0, 1):
        missing = own[c]("never heard")
        assert sum(own[c](w) for w in known) + missing == pytest.approx(1)
    asked = [*[t for t in everything if t], "unheard", "alo unheard vile", "vile-vile3ROT"]
    keys = toxicity.Keys(pa.array(asked))
    got = model.ratio(keys) / toxicity.UNIT
    want = []
    for t in asked:
        found = re.findall("[^\\W\\d_]+", t.lower())
        want += [ratio(v, w) for v, w in zip(["", *found[:-1]], found)]
    assert len(got) == len(want) and np.allclose(got, want, atol=2 / toxicity.UNIT)
    # features by hand, alone and in a batch
    found = model.features(keys)
    begin = 0
    for i, size in enumerate(keys.sizes.tolist()):
        own_ratio = np.rint(got[begin : begin + size] * toxicity.UNIT) / toxicity.UNIT
        begin += size
        if not size:
            assert not found[i].any()
            continue
        best = [max(own_ratio[j : j + s].mean() for j in range(size - s + 1)) for s in (min(s, size) for s in toxicity.SPANS)]
        often = [np.log1p((own_ratio >= level).sum()) for level in toxicity.LEVELS]
        assert np.allclose(found[i], [*best, *often, own_ratio.mean(), np.log1p(size)])
        assert (model.features(toxicity.Keys(pa.array([asked[i]])))[0] == found[i]).all()


def test_rare_toxic_words(spark):
    """Each toxic word stands in few training texts."""
    rows, labels = corpus()
    rng, seen = random.Random(7), {}
    for i in range(600, 900):
        text = rows[i - 600][1].replace("nasty", "balo").replace("vile", "gema").replace("rotten", "cono").split()
        word = f"slur{chr(97 + (i - 600) // 3 % 26)}{chr(97 + (i - 600) // 78)}"
        text[rng.randrange(len(text))] = word
        seen[word] = seen.get(word, 0) + 1
        rows.append((i, " ".join(text), "en", "x"))
        labels.append((i, 1))
    assert max(seen.values()) <= 3
    model = toxicity.train(docs(spark, rows), labelled(spark, labels), F.lit(True))
    odd = [(None, None, None, "x"), (1, "", None, "x"), (1, "unheard balo unheard", None, "x"), (1, "unheard balo unheard", None, "x")]
    assert toxicity.predict(docs(spark, [*rows, *odd]), model).count() == len(rows) + len(odd)
    # a word of few counted texts is told from an unknown one
    held = set(model.words.tolist())
    learned = [w for w in seen if xxhash.xxh3_64_intdigest(w) in held]
    assert len(learned) > 50
    ratio = lambda w: model.features(toxicity.Keys(pa.array([f"balo {w} balo"])))[0, 0]
    assert np.mean([ratio(w) > ratio("unheard") for w in learned]) > 0.95


def test_the_sample_keeps_its_bounds(spark):
    """Texts are learned from up to the given characters per class; shared counts go on growing."""
    rows, labels = corpus(n=200)
    long = [(900, "vile " * 20_000, "en", "x")]
    frame, marks = docs(spark, rows + long), labelled(spark, [*labels, (900, 1)])
    usable = toxicity._drawn(toxicity._usable(marks, "doc_id", "toxic", F.lit(True)), 1000)
    texts = frame.select(F.col("doc_id").alias("id"), "text")
    for most in (100_000, 10_000_000):
        kept = toxicity._sampled_texts(texts, usable, most).toPandas()
        chars = kept.assign(n=kept["text"].str.len()).groupby("y")["n"].sum()
        assert (chars <= most).all() and len(chars) == 2
        assert (900 in set(kept["id"])) == (most > 100_000)
    assert len(kept) == 201
    counted = spark.createDataFrame([(0, "balo gema"), (1, "balo vile")], "y int, text string")
    shared = []
    words = toxicity.Sent(spark, toxicity._sample_words(counted), ascending=True)
    pairs, n0, n1 = toxicity._class_counts(counted, words)
    pairs = toxicity.Sent(spark, pairs, ascending=True)
    assert words.size == 4 and sorted(zip(n0.tolist(), n1.tolist())) == [(0, 1), (1, 0), (1, 1)]
    for some in (texts, texts.unionByName(texts).repartition(7)):
        shared.append(toxicity._shared_counts(some, words, pairs).sum())
    assert shared[1] == 2 * shared[0] > 0


def test_toxicity_of_a_sample_without_words(spark):
    rows = [(i, [None, "", "1 2"][i % 3], "en", "x") for i in range(60)]
    model = toxicity.train(docs(spark, rows), labelled(spark, [(i, i % 2) for i in range(60)]), F.lit(True))
    asked = docs(spark, [*rows, (60, "some words", "en", "x"), (61, "w " * 100_000, "en", "x")])
    # clashing names of other columns
    asked = asked.withColumn("y", F.lit("y")).withColumn("id", F.lit(1)).withColumn("predicted", F.lit(2))
    got = toxicity.predict(asked, model)
    assert got.columns == ["doc_id", "score", "predicted"]
    assert all(0 <= r["score"] <= 1 for r in got.collect()) and got.count() == 62


def test_without_two_classes(spark):
    rows, _ = corpus(n=20)
    ones = labelled(spark, [(i, 1) for i in range(20)] + [(None, 0), (5, None), (3, 0)])
    for module in (toxicity, quality):
        model = module.train(docs(spark, rows), ones, F.lit(True))
        assert model is None
        got = module.predict(docs(spark, rows), model).collect()
        assert {(r["score"], r["predicted"]) for r in got} == {(0.5, 1)}
        assert module.predict(docs(spark, []), model).count() == 0


def test_additive_model_learns_single_effects_and_a_pair():
    rng = np.random.default_rng(4)
    x = rng.random((6000, 4))
    odds = 4 * (x[:, 0] > 0.5) - 2 + 5 * ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)) - 2.5
    y = (rng.random(6000) < 1 / (1 + np.exp(-odds))).astype(float)
    model = quality.AdditiveModel().fit(x[:4000], y[:4000])
    assert model.pairs[0] == (1, 2)
    best = ((odds[4000:] > 0) == y[4000:]).mean()
    assert ((model.score(x[4000:]) >= 0.5) == y[4000:]).mean() > best - 0.02
    # a score is the sum of one entry per table
    row = x[4000:4001]
    bins, coarse = model._bin(row, model.cuts)[0], model._bin(row, model.pair_cuts)[0]
    total = model.base + sum(t[b] for t, b in zip(model.tables, bins)) + sum(
        t[coarse[i], coarse[j]] for (i, j), t in zip(model.pairs, model.pair_tables)
    )
    assert model.score(row)[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_edge_cases(spark):
    rows = [(i, "Good words stand here. And more.\nYes." if i % 2 else "BAD!! BAD!! BAD!!", "en", "x") for i in range(200)]
    labels = labelled(spark, [(i, i % 2) for i in range(200)])
    frame = docs(spark, rows)
    model = quality.train(frame, labels, F.lit(True))
    got = {r["doc_id"]: r["predicted"] for r in quality.predict(frame, model).collect()}
    assert got == {i: i % 2 for i in range(200)}
    kept = quality.keep_good(frame, model)
    assert kept.columns == frame.columns and kept.count() == 100
    odd = [(1, None, None, "x"), (2, "", None, "x"), (None, " \n", None, "x"), (3, "a" * 500_000, None, "x"), (3, "\x00", None, "x")]
    assert all(0 <= r["score"] <= 1 for r in quality.predict(docs(spark, odd), model).collect())
    assert quality.features(None) == quality.features("") == quality.features(" \n") == [0.0] * len(quality.FEATURES)


def test_rows_that_repeat_a_labelled_id_do_not_pass_the_sample(spark, monkeypatch):
    rows, labels = corpus(n=200)
    often = rows + [(i, t, "en", "x") for i, t, *_ in rows[:4] for _ in range(300)]
    made, fitted = [], []
    features = toxicity._features
    monkeypatch.setattr(toxicity, "_features", lambda rows, model: fitted.append(rows.count()) or features(rows, model))
    for some in (rows, often):
        model = quality.train(docs(spark, some), labelled(spark, labels), F.lit(True))
        made.append(sorted(map(tuple, quality.predict(docs(spark, rows), model).collect())))
        toxicity.train(docs(spark, some), labelled(spark, labels), F.lit(True))
    assert made[0] == made[1]
    assert fitted[0] == fitted[1] <= len(rows)


def test_training_does_not_depend_on_layout(spark):
    rows, labels = corpus(n=300)
    scores = []
    for parts in (1, 7):
        frame, marks = docs(spark, rows).repartition(parts), labelled(spark, labels).repartition(parts)
        made = [
            toxicity.predict(frame, toxicity.train(frame, marks, F.lit(True))),
            quality.predict(frame, quality.train(frame, marks, F.lit(True))),
        ]
        scores.append([{r["doc_id"]: r["score"] for r in m.collect()} for m in made])
    assert scores[0] == scores[1]


@pytest.mark.parametrize("most_labels", [1000, 0])
def test_chunks_learn_from_all_labelled_texts(spark, monkeypatch, most_labels):
    """Chunks that meet their counts score as local tables do, and nothing labelled is left out."""
    rows, labels = corpus(n=300)
    odd = [(1, "vile balo x", "en", "x"), (1, "vile balo x", "en", "x"), (2, None, None, "x"), (None, None, None, "x"), (999, "", None, "x")]
    frame, marks = docs(spark, [*rows, *odd]).repartition(5), labelled(spark, [*labels, (999, 0), (None, 1)])
    whole = toxicity.train(frame, marks, F.lit(True))
    assert isinstance(whole, toxicity.Model)
    monkeypatch.setattr(toxicity_chunks, "CHUNK", 1000)
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", most_labels)
    model = toxicity.train(frame, marks, F.lit(True), local_chars=0)
    assert np.allclose(model.weights, whole.weights, atol=1e-6)
    for asked in (frame, docs(spark, [*rows[:40], *odd, (5, "unheard vile words balo", "en", "x")])):
        made = [sorted(toxicity.predict(asked, m).collect(), key=str) for m in (whole, model)]
        assert [(r["doc_id"], r["predicted"]) for r in made[0]] == [(r["doc_id"], r["predicted"]) for r in made[1]]
        assert np.allclose([r["score"] for r in made[0]], [r["score"] for r in made[1]], atol=1e-6)


def test_chunks_leave_no_questions_on_the_disk(spark, monkeypatch):
    """What chunks and parts send each other goes when it is answered, and rounds change no feature."""
    rows, labels = corpus(n=300)
    usable = toxicity._usable(labelled(spark, labels), "doc_id", "toxic", F.lit(True))
    monkeypatch.setattr(toxicity_chunks, "CHUNK", 500)
    states = toxicity_chunks.learned_chunks(docs(spark, rows).select(F.col("doc_id").alias("id"), "text"), usable)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left() -> int:
        files = disk.getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()))

    made, before = [], left()
    for rounds in ((1, 1), (2, 4), (3, 2)):
        for name, value in zip(("ASK_ROUNDS", "COMPARE_ROUNDS"), rounds, strict=True):
            monkeypatch.setattr(toxicity_chunks, name, value)
        made.append(sorted(map(tuple, toxicity_chunks.features(states).collect())))
        until = time.time() + 20
        while left() > before + 20_000 and time.time() < until:
            time.sleep(0.2)
        assert left() <= before + 20_000  # some sums
    assert made[0] == made[1] == made[2] and len(made[0]) == len(rows)


def test_texts_are_not_shuffled_to_many_labels(spark, monkeypatch):
    """Labels beyond a broadcast meet the ids of written chunks; the roles are those of a broadcast."""
    rows, labels = corpus(n=120)
    odd = [(1, "vile balo x", "en", "x"), (2, None, None, "x"), (None, "vile", None, "x"), (900, None, None, "x"), (901, "", None, "x")]
    texts = docs(spark, [*rows, *odd]).repartition(3).select(F.col("doc_id").alias("id"), "text")
    usable = toxicity._usable(labelled(spark, [*labels, (900, 1), (901, 0)]), "doc_id", "toxic", F.lit(True))
    monkeypatch.setattr(toxicity_chunks, "CHUNK", 300)
    written, made = [], []
    by_chunk = toxicity_chunks._by_chunk
    monkeypatch.setattr(toxicity_chunks, "_by_chunk", lambda states: written.append(states) or by_chunk(states))
    for few in (True, False):
        monkeypatch.setattr(toxicity_chunks, "fits_broadcast", lambda lookup, few=few: few or lookup.columns != ["id", "role"])
        states = toxicity_chunks.learned_chunks(texts, usable)
        roles = [r for row in states.collect() for c in [toxicity_chunks.Chunk(row.asDict(), 40)] for r in zip(c.ids, c.roles.tolist())]
        made.append(sorted((str(i), toxicity_chunks.PLAIN if r == toxicity_chunks.NULL else r) for i, r in roles))
    assert made[0] == made[1] and len(made[0]) == len(rows) + len(odd) + 1
    assert {r for _, r in made[0]} >= {-1, 0, 1, 2, 3}
    plan = written[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_chunks_pack_words_and_sums():
    rng = np.random.default_rng(5)
    for n in (0, 1, 5000):
        words = rng.integers(3, 1 << 63, 400, np.uint64)[np.minimum(rng.geometric(0.05, n), 399)]
        known, codes = toxicity_chunks._unlisted({k: v.to_pylist()[0] for k, v in toxicity_chunks._listed(words).items()})
        assert (known == np.unique(np.append(words, toxicity.START))).all() and (known[codes] == words).all()
    sums = [rng.integers(0, 50, 30) for _ in range(toxicity_chunks.SUMS)]
    for got, want in zip(toxicity_chunks._whole(toxicity_chunks._thin(sums)), sums, strict=True):
        assert (got == want).all()


def test_more_labelled_texts_than_the_former_sample_are_learned_from(spark):
    """A class of more than 20,000 texts: of each only its last word is its own."""
    rows = [(i, f"balo gema w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17576)}", "en", "x") for i in range(30_000)]
    marks = labelled(spark, [(i, int(i % 10 == 0)) for i in range(30_000)])
    counted = spark.range(30_000).where(F.pmod(F.xxhash64("id"), F.lit(4)) != 0).count()
    model = toxicity.train(docs(spark, rows), marks, F.lit(True))
    assert len(model.words) == counted + 3  # balo, gema and what stands before a text
