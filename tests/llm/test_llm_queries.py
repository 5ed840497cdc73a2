"""The registered queries on the smallest data set: against their SQL, or against brute force."""

import duckdb
import numpy as np
import pandas as pd
import pytest
import sentencepiece
import xxhash

import corpus_pipeline
from check import TABLES, normal
from facetry.llm import queries
from facetry.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, database, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got) > 0
    assert normal(got).equals(normal(database.execute(ORACLE[name]).df()))


def test_what_lacks_sql():
    assert set(queries.QUERIES) - set(ORACLE) == {
        "op3_langid", "op5_simhash", "op6_toxicity", "op7_quality", "op10_sentencepiece", "op11_alignment"
    }


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, bits):
    """Smallest id reachable from each row over links of at most ``bits`` bits."""
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= bits and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_simhash_against_brute_force(spark, database):
    docs = database.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    prints = [brute_fingerprint(t) for _, t in docs]
    want = brute_components([d for d, _ in docs], prints, 2)
    got = {r["doc_id"]: r for r in queries.op5_simhash(spark, SF).collect()}
    assert len(got) == len(docs)
    for (doc, _), print_, component in zip(docs, prints, want, strict=True):
        assert (got[doc]["fingerprint"], got[doc]["component_id"]) == (f"{print_:016x}", component)


def test_langid_reads_the_language_of_held_out_texts(spark, database):
    got = queries.op3_langid(spark, SF).toPandas()
    truth = database.execute("SELECT doc_id, lang, text FROM documents").df()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth) and both["score"].between(0, 1).all()
    held = both[both["held_out"]]
    assert 0.15 < len(held) / len(both) < 0.35
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95


@pytest.mark.parametrize(("name", "label"), [("op6_toxicity", "toxic"), ("op7_quality", "quality")])
def test_classifiers_on_held_out_labels(spark, name, label):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, {label} AS y FROM '{sf}/labels.parquet'").df()
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    assert got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.5).astype(int) == got["predicted"]).all()
    held = got.merge(labels, on="doc_id").query("held_out")
    positive = held.loc[held["y"] == 1, "score"].to_numpy()
    other = held.loc[held["y"] == 0, "score"].to_numpy()
    auc = np.mean(positive[:, None] > other) + 0.5 * np.mean(positive[:, None] == other)
    assert auc > (0.8 if label == "toxic" else 0.98)  # some 70 held-out toxicity labels, 6 of them toxic


def test_sentencepiece_equals_the_public_library(spark, database):
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    texts = dict(database.execute("SELECT doc_id, text FROM documents").fetchall())
    got = queries.op10_sentencepiece(spark, SF).collect()
    assert len(got) == len(texts)
    for row in got:
        assert list(row["ids"]) == model.encode(texts[row["doc_id"]])
        assert row["round_trip"] and row["n_ids"] == len(row["ids"])


def test_pipeline_against_plain_python(spark, database):
    """The stages after the classifier, whose scores are taken as they are, done again by hand."""
    from facetry.llm import quality
    from facetry.llm.common import held_out, table

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, table(spark, SF, "labels", "doc_id", "quality"), ~held_out("doc_id", 3, 1))
    rows = {r["doc_id"]: r for r in docs.collect()}
    scores = {d: float(model.score(np.array([quality.features(r["text"])]))[0]) for d, r in rows.items()}
    kept = sorted(d for d in rows if scores[d] >= 0.5)
    assert 0 < len(kept) < len(rows)
    seen = {}
    for d in kept:
        seen.setdefault(" ".join(_split(rows[d]["text"])), d)
    kept = sorted(seen.values())
    prints = [brute_fingerprint(rows[d]["text"]) for d in kept]
    label = brute_components(kept, prints, 2)
    kept = [d for d, c in zip(kept, label, strict=True) if c == d]
    con = duckdb.connect()
    part = pd.DataFrame([rows[d].asDict() for d in kept])
    con.register("documents", part)
    mixed = con.execute(ORACLE["op4_mixing"]).df()
    copies = {r.doc_id: int(r.taken // r.size) for r in mixed.itertuples() if r.size}
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    want = sorted((d, model.encode(rows[d]["text"])) for d in kept for _ in range(copies.get(d, 0)))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == want
    assert all(r["round_trip"] for r in got)


def _split(text):
    import re

    return re.split(r"[\x20\x09-\x0D]+", text or "")


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("n_chars", "size")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
