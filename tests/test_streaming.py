from facetry.functions.text import char_tokens, drop_stop_chars
from facetry.operators.encode import encode
from facetry.operators.vocabulary import fit_vocabulary


def test_cleaning_and_encoding_run_on_a_stream(spark, tmp_path):
    rows = [(1, "好吃的面"), (2, "面 店"), (3, "")]
    batch = spark.createDataFrame(rows, "id long, text string")
    batch.write.parquet(str(tmp_path / "in"))

    def tokens(df):
        return df.select("id", char_tokens(drop_stop_chars("text", ["的"])).alias("tokens"))

    vocab = fit_vocabulary(tokens(batch))
    want = {r["id"]: r["seq"] for r in encode(tokens(batch), vocab, 4).collect()}
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = (
        encode(tokens(stream), vocab, 4)
        .writeStream.format("memory").queryName("encoded").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    )
    query.processAllAvailable()
    query.stop()
    assert {r["id"]: r["seq"] for r in spark.table("encoded").collect()} == want
