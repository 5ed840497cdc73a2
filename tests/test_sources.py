import pytest

from facetry.functions.arrays import argmax_class
from facetry.schema import ASPECT_COLUMNS, review_schema
from facetry.sources import artifacts, lists, reviews
from facetry.sources.vectors import read_vectors, read_vectors_text, write_vectors, write_vectors_text


def review_rows():
    contents = ['plain', 'comma, "quoted"', "two\nlines", " 好吃 ", '""', "tab\there", "", None]
    return [(i, text, *[(i + k) % 4 - 2 for k in range(20)]) for i, text in enumerate(contents)]


def test_reviews_survive_csv(spark, tmp_path):
    rows = review_rows()
    path = str(tmp_path / "reviews")
    reviews.write_csv(spark.createDataFrame(rows, review_schema()), path)
    assert sorted(map(tuple, reviews.read_reviews(spark, path).collect()), key=lambda r: r[0]) == rows
    reviews.write_csv(spark.createDataFrame(rows[:2], review_schema()), path, "append")
    assert reviews.read_reviews(spark, path).count() == len(rows) + 2
    reviews.write_csv(spark.createDataFrame(rows[:2], review_schema()), path)
    assert reviews.read_reviews(spark, path).count() == 2
    with pytest.raises(ValueError):
        reviews.write_csv(spark.range(1), path, "w")


def test_csv_as_written_elsewhere(spark, tmp_path):
    head = "id,content," + ",".join(ASPECT_COLUMNS)
    labels = ",".join(["-2"] * 19 + ["1"])
    (tmp_path / "r.csv").write_text(f'{head}\n1,"[\'""\', \'在\', \'x, y\']",{labels}\n', encoding="utf8")
    row = reviews.read_tokenised(spark, str(tmp_path / "r.csv")).first()
    assert row["tokens"] == ['"', "在", "x, y"]
    assert row[ASPECT_COLUMNS[0]] == -2 and row[ASPECT_COLUMNS[19]] == 1


def write_lines_file(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf8")
    return str(path)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    names = ["extra", *reversed(ASPECT_COLUMNS), "content", "id"]
    values = ["e", *[str(k % 4 - 2) for k in reversed(range(20))], '"a, b"', "7"]
    path = write_lines_file(tmp_path / "p.csv", [",".join(names), ",".join(values)])
    row = reviews.read_reviews(spark, path).first()
    assert tuple(row) == (7, "a, b", *[k % 4 - 2 for k in range(20)])
    with pytest.raises(ValueError, match="no column id"):
        reviews.read_reviews(spark, write_lines_file(tmp_path / "q.csv", ["a,b", "1,2"]))


def test_files_with_another_header_are_an_error(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    labels = ",".join(["1"] * 20)
    write_lines_file(folder / "a.csv", ["id,content," + ",".join(ASPECT_COLUMNS), f"1,x,{labels}"])
    write_lines_file(folder / "b.csv", ["content,id," + ",".join(ASPECT_COLUMNS), f"x,1,{labels}"])
    with pytest.raises(Exception, match="CSV header|header"):
        reviews.read_reviews(spark, str(folder)).collect()


@pytest.mark.parametrize("cell", ["1.0", "x", "1 2"])
def test_bad_cells_are_an_error(spark, tmp_path, cell):
    head = "id,content," + ",".join(ASPECT_COLUMNS)
    path = write_lines_file(tmp_path / "r.csv", [head, f"1,x,{cell}," + ",".join(["1"] * 19)])
    with pytest.raises(Exception, match=ASPECT_COLUMNS[0]):
        reviews.read_reviews(spark, path).collect()


def test_blank_cells_are_null_and_short_rows_an_error(spark, tmp_path):
    head = "id,content," + ",".join(ASPECT_COLUMNS)
    path = write_lines_file(tmp_path / "r.csv", [head, "1,x," + '" "' + "," * 19])
    assert tuple(reviews.read_reviews(spark, path).first()) == (1, "x", *[None] * 20)
    path = write_lines_file(tmp_path / "s.csv", [head, "1,x,1"])
    with pytest.raises(Exception, match="(?i)malformed"):
        reviews.read_reviews(spark, path).collect()


@pytest.mark.parametrize("cell", ["[0.1 x 0.9 0.2]", "[0.1 0.2 0.3]", "[]", "[0.1 nan 0.2 0.3]"])
def test_bad_score_cells_are_an_error(spark, tmp_path, cell):
    head = "id,content," + ",".join(ASPECT_COLUMNS)
    path = write_lines_file(tmp_path / "s.csv", [head, f"4,text,{cell}," + ",".join(["[0 0 0 1]"] * 19)])
    with pytest.raises(Exception, match="not a vector of numbers"):
        reviews.read_scores(spark, path).collect()


def test_score_tables(spark, tmp_path):
    head = "id,content," + ",".join(ASPECT_COLUMNS)
    cells = ",".join(['"[0.1 0.7\n 0.1  1e-05]"'] * 20)
    (tmp_path / "s.csv").write_text(f"{head}\n4,text,{cells}\n", encoding="utf8")
    scores = reviews.read_scores(spark, str(tmp_path / "s.csv"))
    assert scores.first()[ASPECT_COLUMNS[5]] == [0.1, 0.7, 0.1, 1e-05]
    assert scores.select(argmax_class(ASPECT_COLUMNS[5])).first()[0] == -1
    out = str(tmp_path / "again")
    reviews.write_csv(scores, out)
    assert reviews.read_scores(spark, out).collect() == scores.collect()


def test_line_lists(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text(" 的 \n了\t\n\n的\n　没有\r\n,\n", encoding="utf8")
    stop = lists.read_stop_words(spark, str(path))
    assert lists.stop_word_list(stop) == sorted(["的", "了", "没有", ","])
    assert lists.stop_word_list(lists.read_stop_words(spark, str(path))) == lists.stop_word_list(stop)
    with pytest.raises(ValueError):
        lists.stop_word_list(stop, limit=2)
    numbered = lists.read_lines(spark, str(path)).orderBy("id").collect()
    assert [r["value"] for r in numbered][:2] == [" 的 ", "了\t"]
    out = str(tmp_path / "lines")
    lists.write_lines(stop, "token", out)
    assert {r["value"] for r in spark.read.text(out).collect()} == {"的", "了", "没有", ","}


def test_dictionary_lines(spark, tmp_path):
    path = tmp_path / "dict.txt"
    path.write_text("(^_^) 2000\n火锅\n\n面 x\n", encoding="utf8")
    got = {r["token"]: r["freq"] for r in lists.read_dictionary(spark, str(path), 5).collect()}
    assert got == {"(^_^)": 2000, "火锅": 5, "面": 5}


def test_vector_files(spark, tmp_path):
    rows = [("好", [0.5, -1.25, 3e-8]), ("a", [0.1, 0.2, 0.3])]
    table = spark.createDataFrame(rows, "token string, v array<float>")
    write_vectors_text(table, str(tmp_path / "text"))
    write_vectors(table, str(tmp_path / "parquet"))
    given = {r["token"]: r["v"] for r in table.collect()}
    assert {r["token"]: r["v"] for r in read_vectors_text(spark, str(tmp_path / "text")).collect()} == given
    assert {r["token"]: r["v"] for r in read_vectors(spark, str(tmp_path / "parquet")).collect()} == given
    (tmp_path / "head.vec").write_text("2 3\n好 0.5 1 2 \nb 1 2 3\n", encoding="utf8")
    headed = read_vectors_text(spark, str(tmp_path / "head.vec")).collect()
    assert {r["token"]: r["v"] for r in headed} == {"好": [0.5, 1.0, 2.0], "b": [1.0, 2.0, 3.0]}


def test_vector_files_with_any_token(spark, tmp_path):
    rows = [(t, [1.5, -2.0]) for t in (" ", "\n", "", "a b", "\\", "\\s", "\\n x", "\t", "\r\n", "2 3", "7")]
    write_vectors_text(spark.createDataFrame(rows, "token string, v array<float>"), str(tmp_path / "odd"))
    assert sorted(map(tuple, read_vectors_text(spark, str(tmp_path / "odd")).collect())) == sorted(rows)
    one = [("a", [1.0]), ("b", [2.0])]
    write_vectors_text(spark.createDataFrame(one, "token string, v array<float>"), str(tmp_path / "one"))
    assert sorted(map(tuple, read_vectors_text(spark, str(tmp_path / "one")).collect())) == one


@pytest.mark.parametrize("line", ["c 0.5", "c 0.5 x", "c", "c 1 2 3"])
def test_damaged_vector_lines_are_an_error(spark, tmp_path, line):
    path = write_lines_file(tmp_path / "bad.vec", ["2 2", "a 1 2", line])
    with pytest.raises(Exception, match="not a vector line"):
        read_vectors_text(spark, path).collect()
    foreign = write_lines_file(tmp_path / "f.vec", ["1 2", "new york 1 2"])
    assert read_vectors_text(spark, foreign, escaped=False).first()["token"] == "new york"


def test_build_if_absent(spark, tmp_path):
    path, calls = str(tmp_path / "kept"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert artifacts.build_if_absent(spark, path, build).count() == 3
    assert artifacts.build_if_absent(spark, path, build).count() == 3
    assert calls == [1]
    (tmp_path / "kept" / "_SUCCESS").unlink()  # as a failed run would leave it
    assert artifacts.build_if_absent(spark, path, build).count() == 3
    assert calls == [1, 1]


def test_a_manifest_tells_stale_tables(spark, tmp_path):
    path, given, calls = str(tmp_path / "kept"), tmp_path / "raw files", []
    given.mkdir()
    (given / "a.txt").write_text("1\n2\n")

    def kept(build=None, **params):
        def read():
            calls.append(1)
            return spark.read.text(str(given))

        return artifacts.build_if_absent(spark, path, build or read, {"raw": str(given)}, params).count()

    assert kept(size=3, names=("a",)) == kept(size=3, names=("a",)) == 2 and len(calls) == 1
    (given / "sub").mkdir()  # nothing in it
    assert kept(size=3, names=("a",)) == 2 and len(calls) == 1
    (given / "b.txt").write_text("3\n")
    assert kept(size=3, names=("a",)) == 3 and len(calls) == 2
    assert kept(size=4, names=("a",)) == 3 and len(calls) == 3
    (given / "a.txt").write_text("1\n3\n")  # as long as before
    assert kept(size=4, names=("a",)) == 3 and len(calls) == 4
    # a build that fails leaves no table that is taken, even with the marker of a finished write
    with pytest.raises(Exception, match="no such"):
        kept(lambda: spark.range(9).selectExpr("raise_error('no such') AS x"), size=5)
    (tmp_path / "kept").mkdir(exist_ok=True)
    (tmp_path / "kept" / "_SUCCESS").touch()
    assert kept(size=5) == 3 and len(calls) == 5
    (tmp_path / "kept" / artifacts.MANIFEST).write_text('{"inputs": {"ra')  # cut off
    (tmp_path / "kept" / f".{artifacts.MANIFEST}.crc").unlink()
    assert kept(size=5) == 3 and len(calls) == 6
    for name in ("a.txt", "b.txt"):
        (given / name).unlink()
    assert kept(size=5) == 3 and len(calls) == 6  # the raw files are gone: the table stays


def test_a_dataframe_stands_for_its_files(spark, tmp_path):
    path = str(tmp_path / "a table" / "part=1")
    spark.range(5).write.parquet(path)
    whole = artifacts.fingerprint(spark, path)
    assert whole == artifacts.fingerprint(spark, path)
    frame = lambda: spark.read.parquet(path).where("id > 1").groupBy("id").count()
    before = artifacts.fingerprint(spark, frame())
    assert before is not None and before == artifacts.fingerprint(spark, frame())
    spark.range(1).write.mode("append").parquet(path)
    assert artifacts.fingerprint(spark, frame()) != before
    assert artifacts.fingerprint(spark, spark.range(3)) is None
    assert artifacts.fingerprint(spark, str(tmp_path / "nowhere")) is None


def test_kept_tables(spark, tmp_path):
    vocab = spark.createDataFrame([("a", 2, 1)], "token string, n long, idx long")
    rows = spark.createDataFrame([(0, [0.0]), (1, [2.0])], "idx long, v array<float>")
    artifacts.save_table(vocab, str(tmp_path / "vocab"))
    artifacts.save_table(rows, str(tmp_path / "emb"))
    assert artifacts.load_vocabulary(spark, str(tmp_path / "vocab")).collect() == vocab.collect()
    assert artifacts.load_embeddings(spark, str(tmp_path / "emb")).count() == 2
