"""Word-vector tables ``(token, v)`` as text or Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Blanks and line breaks would end a token or a line, so the writer replaces them.
ESCAPES = (("\\", "\\\\"), (" ", "\\s"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def _escaped(token: Column) -> Column:
    for raw, written in ESCAPES:
        token = F.replace(token, F.lit(raw), F.lit(written))
    # an empty token would leave an empty first field
    return F.when(token == "", F.lit("\\e")).otherwise(token)


def _unescaped(token: Column) -> Column:
    pieces = F.regexp_extract_all(token, F.lit(r"(?s)\\.|[^\\]+"), F.lit(0))
    plain = {written: raw for raw, written in ESCAPES} | {"\\e": ""}

    def resolve(p: Column) -> Column:
        out = p
        for written, raw in plain.items():
            out = F.when(p == written, F.lit(raw)).otherwise(out)
        return out

    return F.when(token.contains("\\"), F.array_join(F.transform(pieces, resolve), "")).otherwise(token)


def read_vectors_text(spark: SparkSession, path: str, escaped: bool = True) -> DataFrame:
    """``token v1 v2 ...`` lines; a ``count size`` line (two whole numbers) is skipped.

    The last fields are the numbers, so a foreign file's tokens may hold blanks when a
    ``count size`` line, or every line, says how many numbers there are. A line whose numbers do
    not parse, or whose size differs from the others, is an error. ``escaped`` undoes what
    ``write_vectors_text`` does to tokens; files from elsewhere are read with False.
    """
    lines = spark.read.text(path).select(F.rtrim("value").alias("value")).where("value <> ''")
    head = F.col("value").rlike(r"^\d+ \d+$")
    parts = lines.where(~head).select(F.split("value", " ").alias("p"))
    size = _vector_size(lines.where(head), parts)
    token = F.array_join(F.slice("p", F.lit(1), F.size("p") - size), " ")
    failed = F.raise_error(F.concat(F.lit("not a vector line: "), F.array_join(F.slice("p", 1, 3), " "))).cast("float")
    numbers = F.transform(F.slice("p", F.size("p") - size + 1, F.lit(size)), lambda x: F.coalesce(x.try_cast("float"), failed))
    whole = F.size("p") == size + 1 if escaped else F.size("p") > size
    vector = F.when(whole, numbers).otherwise(F.array(failed))
    return parts.select(
        F.when(whole, _unescaped(token) if escaped else token).alias("token"), vector.alias("v")
    )


def _vector_size(heads: DataFrame, parts: DataFrame) -> int:
    """From the ``count size`` line, else the number of fields of the shortest line less its token."""
    head = heads.limit(1).collect()
    if head:
        return int(head[0][0].split(" ")[1])
    return max(1, (parts.agg(F.min(F.size("p"))).first()[0] or 2) - 1)


def write_vectors_text(vectors: DataFrame, path: str, mode: str = "overwrite") -> None:
    numbers = F.transform("v", lambda x: x.cast("string"))
    line = F.concat_ws(" ", _escaped(F.col("token")), F.array_join(numbers, " "))
    vectors.select(line.alias("value")).write.mode(mode).text(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("token", "v")


def write_vectors(vectors: DataFrame, path: str, mode: str = "overwrite") -> None:
    vectors.select("token", "v").write.mode(mode).parquet(path)
