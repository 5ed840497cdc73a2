"""Review, label and score tables as CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetry.functions.arrays import (
    format_score_vector,
    format_token_list,
    parse_score_vector,
    parse_token_list,
)
from facetry.schema import ASPECT_COLUMNS, review_schema
from facetry.sources.records import read_records, stray_quote

# Quoted fields hold line breaks and doubled quotes; blanks at the ends belong to the value.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
# An empty field is null, a quoted empty field is an empty text: no text equals this marker.
READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\x00"}


def _strict(cell: Column, kind: T.DataType, name: str) -> Column:
    """The cell as ``kind``; blank is null, anything else that does not convert is an error."""
    if isinstance(kind, T.StringType):
        return cell.alias(name)
    blank = F.btrim(cell) == ""
    failed = F.raise_error(F.concat(F.lit(f"column {name}: "), cell)).cast(kind)
    value = F.when(cell.isNotNull() & ~blank, F.coalesce(cell.try_cast(kind), failed))
    return value.alias(name)


def read_reviews(
    spark: SparkSession, path: str, schema: T.StructType | None = None, split: bool = True
) -> DataFrame:
    """``id``, ``content`` and the label columns, found by name in the files' header.

    The columns may stand in any order and others may be there too; every file must have the
    header of the first one. A cell that is no number, or a row with too few or too many
    fields, is an error.

    A file is read by as many tasks as it has splits, its records cut by counting quotes
    (``sources.records``). That needs quotes at the ends of cells only, others doubled; a stray one
    is an error. ``split=False`` takes such files, and those whose lines end with a lone CR, by one task each.
    """
    schema = schema or review_schema()
    header = spark.read.options(**READ_OPTIONS).csv(path).columns
    missing = [f.name for f in schema if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {missing[0]}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if split:
        rows = _parsed(read_records(spark, path), text)
    else:
        rows = spark.read.options(**READ_OPTIONS, enforceSchema="false", mode="FAILFAST").schema(text).csv(path)
    return rows.select(*[_strict(F.col(f"`{f.name}`"), f.dataType, f.name) for f in schema])


def _parsed(records: DataFrame, text: T.StructType) -> DataFrame:
    """The cells of ``(record, first)``; the first record of every file must be the header ``text``."""
    stray = F.raise_error(F.concat(F.lit("stray quote, read with split=False: "), F.substring("record", 1, 200)))
    record = F.when(F.contains("record", F.lit('"')) & stray_quote(F.col("record")), stray.cast("string")).otherwise(F.col("record"))
    cells = F.from_csv(record, text.simpleString()[7:-1].replace(":string", " string"), READ_OPTIONS | {"mode": "FAILFAST"})
    rows = records.select(cells.alias("cells"), "first")
    same = [F.col(f"cells.`{f.name}`").eqNullSafe(F.lit(f.name)) for f in text]
    other = F.raise_error(F.lit("a file's CSV header differs from the first one's")).cast("boolean")
    body = F.when(F.col("first"), F.when(~F.array_contains(F.array(*same), False), False).otherwise(other)).otherwise(True)
    return rows.where(body).select("cells.*")


def read_tokenised(spark: SparkSession, path: str) -> DataFrame:
    """Reviews whose ``content`` is the text of a token list, with a ``tokens`` array instead."""
    reviews = read_reviews(spark, path)
    return reviews.withColumn("tokens", parse_token_list("content")).drop("content")


def read_scores(
    spark: SparkSession, path: str, columns: Sequence[str] = ASPECT_COLUMNS
) -> DataFrame:
    """A score table: every label cell is the text of a score vector, read as an array."""
    raw = read_reviews(spark, path, review_schema(T.StringType()))
    return raw.select("id", "content", *[parse_score_vector(c).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write with header; token lists and score vectors become text the readers take back.

    ``append`` adds rows. To combine the columns of several models route their score tables
    first (``operators.scores``) and write once.
    """
    if mode not in ("overwrite", "append", "ignore"):
        raise ValueError(mode)
    out = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            text = isinstance(field.dataType.elementType, T.StringType)
            column = (format_token_list(column) if text else format_score_vector(column)).alias(field.name)
        out.append(column)
    df.select(*out).write.mode(mode).options(**CSV_OPTIONS).csv(path)
