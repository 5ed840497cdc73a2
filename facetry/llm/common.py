"""What several operators share: table access, hot keys, ids for tests of held-out rows."""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.session import ensure_checkpoint_dir

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# A key that holds more than one row in HOT_SHARE is hot. There can be at most HOT_SHARE such
# keys whatever the table's size, so a list of them is safe to broadcast.
HOT_SHARE = 512


def _letters() -> str:
    """The characters of Unicode category L as ranges of a character class."""
    found, begin = [], None
    for c in range(sys.maxunicode + 2):
        letter = c <= sys.maxunicode and unicodedata.category(chr(c)).startswith("L")
        if letter and begin is None:
            begin = c
        elif not letter and begin is not None:
            found.append(f"{chr(begin)}-{chr(c - 1)}")
            begin = None
    return "".join(found)


# Runs of letters; the same runs that Spark finds by LETTER_RUN. No letter needs escaping in a class.
LETTER_RUN = r"\p{L}+"
LETTERS = re.compile(f"[{_letters()}]+")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, read through Spark."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it from there."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def attach(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], n: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``lookup`` (unique ``keys``; ``n``: rows that have the key).

    Hot keys, at most ``HOT_SHARE`` of them, are broadcast; every other key has at most one in
    ``HOT_SHARE`` of the rows and is joined by a shuffle. Both inputs are read twice, so they
    should be written tables or checkpoints. Key columns hold no nulls.
    """
    hot = lookup.where(F.col(n) * HOT_SHARE > F.lit(total))
    cold = lookup.where(F.col(n) * HOT_SHARE <= F.lit(total))
    keys = list(keys)
    few = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "left")
    many = rows.join(F.broadcast(hot), keys, "inner")
    return few.unionByName(many)


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True for the rows that no label may be learned from; a null id is never held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def digest_order(doc_id: str) -> Column:
    """A fixed pseudo-random order of the ids, for bounded samples that do not depend on layout."""
    return F.md5(F.col(doc_id).cast("string").cast("binary"))


def most_frequent(table: DataFrame, n: str, most: int) -> DataFrame:
    """The rows with the highest counts ``n``, as many whole counts as fit into ``most`` rows.

    Rows of one count stay or go together, so ties need no order, and nothing is sorted: the number
    of rows per count decides on the lowest count kept.
    """
    kept, lowest = 0, None
    sizes = table.groupBy(F.col(n).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    # counts grow slowly in number; beyond the first ``most`` of them nothing can fit
    for row in sizes.orderBy(F.desc("n")).limit(most).collect():
        if kept + row["rows"] > most:
            break
        kept, lowest = kept + row["rows"], row["n"]
    return table.where(F.col(n) >= lowest) if lowest is not None else table.where("false")
