from facetry import session
from facetry.operators.segment import _frequent_cutoff
from facetry.session import hot_limit, read_spread


def test_only_small_tables_are_spread(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id * 2 AS x", "'y' AS unused").coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    small = read_spread(spark, path, "id", "id", "x")
    assert small.rdd.getNumPartitions() == cores and small.columns == ["id", "x"] and small.count() == 100
    monkeypatch.setattr(session, "SPREAD_MAX_BYTES", 10)
    assert read_spread(spark, path, "id").rdd.getNumPartitions() == 1


def test_hot_rows_are_bounded_by_rows_and_bytes(spark, monkeypatch):
    ranked = spark.range(1, 101).selectExpr("id AS idx", "repeat('x', 100) AS token")
    assert hot_limit(ranked, "idx", 64) == 64
    monkeypatch.setattr(session, "BROADCAST_MAX_BYTES", 2000)
    assert hot_limit(ranked, "idx", 64, "token") == 16
    monkeypatch.setattr(session, "BROADCAST_MAX_BYTES", 50)
    assert hot_limit(ranked, "idx", 64, "token") == 0
    repeated = ranked.selectExpr("1L AS idx", "token")  # no rank at all: every row is the first
    assert hot_limit(repeated, "idx", 64) == 0


def test_cutoff_for_frequent_tokens(spark, monkeypatch):
    spread = spark.range(1, 41).selectExpr("concat('t', id) AS token", "id AS _docs")
    monkeypatch.setattr("facetry.operators.segment.HOT_TOKENS", 16)
    assert _frequent_cutoff(spread) == 24  # 25 to 40 are sixteen tokens
    assert _frequent_cutoff(spread.selectExpr("token", "7L AS _docs")) == 7
