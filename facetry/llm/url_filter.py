"""URL rules: a blocked Bloom filter passes possible hits to an exact join.

Only DataFrame functions. A rule is a host and a path prefix with a verdict; it fits its host
and all subdomains when the URL's path starts with the rule's path. The canonical key of a rule
is host + path, which reads back uniquely because a host holds no ``/``. A URL's candidate keys
are its host's endings and its path's beginnings in the sizes that occur among the rules (labels
of the host, characters of the path), so a URL has at most as many candidates as the rules have
different shapes.

The filter is a list of 256-bit blocks; a key's hash picks one block and four bits, one in each
of its 64-bit words. It is sized from the number of rules and bounded by ``max_blocks``: beyond
that, more candidates pass, and the join still decides alone. Only candidates that pass the
filter leave the scan. Joining them removes the filter's false hits, and the longest rule wins
(host + path length, then the longer host).

Defined cases: a null URL or one without ``://`` has an empty host and path and meets no rule; an
empty path starts with no ``/``; hosts match without regard to A-Z case, paths exactly. Rules with
a null host or verdict are refused; a null path is an empty one; rules repeated with one verdict
count once, with different verdicts they are refused. No rules or no rows: everything gets the
default verdict. Repeated rows are judged one by one.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import attach
from facetry.session import fits_broadcast, materialize

BITS_PER_RULE = 16
BLOCK_BITS = 256
WORDS = BLOCK_BITS // 64


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    found = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.when(found, ascii_lower(host)).otherwise(empty), F.when(found, path).otherwise(empty)


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The key's block and its mask in each of the block's words."""
    place, picks = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    masks = [_one_bit(picks, 6 * word) for word in range(WORDS)]
    return F.pmod(place, F.lit(blocks)).cast("int"), masks


def _one_bit(picks: Column, shift: int) -> Column:
    at = F.shiftrightunsigned(picks, shift).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def bloom_blocks(rules: DataFrame, max_blocks: int) -> tuple[list[int], int]:
    """The filter's words, block after block, and the number of blocks (at most ``max_blocks``)."""
    n = rules.count()
    blocks = 1
    while blocks < max_blocks and blocks * BLOCK_BITS < n * BITS_PER_RULE:
        blocks *= 2
    place, masks = _bits(F.col("key"), blocks)
    words = [f"w{i}" for i in range(WORDS)]
    filled = rules.select(place.alias("block"), *[m.alias(w) for m, w in zip(masks, words, strict=True)])
    sums = filled.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in words]).collect()
    flat = [0] * (blocks * WORDS)
    for row in sums:
        flat[row["block"] * WORDS : (row["block"] + 1) * WORDS] = [row[w] for w in words]
    return flat, blocks


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
    max_blocks: int = 1 << 15,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages``.

    ``rules`` has host, path, verdict. ``max_blocks`` bounds the filter (32 bytes a block).
    """
    listed = materialize(
        rules.select(
            ascii_lower(F.col("host")).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            F.col("verdict"),
        )
        .distinct()
        .select(
            F.concat("host", "path").alias("key"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length("host").alias("host_size"),
            F.length("path").alias("path_size"),
            "verdict",
        )
    )
    wrong = listed.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("key").alias("keys"),
        F.count_if(F.col("key").isNull() | F.col("verdict").isNull()).alias("nulls"),
    ).first()
    if wrong["nulls"]:
        raise ValueError("a rule needs a host and a verdict")
    if wrong["n"] != wrong["keys"]:
        raise ValueError("rules with equal host and path have different verdicts")
    shapes = [(r[0], r[1]) for r in listed.select("labels", "path_size").distinct().collect()]

    host, path = url_parts(F.col(url))
    rows = pages.select(F.col(page_id).alias("id"), host.alias("host"), path.alias("path"))
    default_row = [F.col("id").alias(page_id), "host", "path"]
    if not shapes:
        none = F.lit(None).cast("string").alias("rule")
        return rows.select(*default_row, none, F.lit(default).alias("verdict"))

    bits, blocks = bloom_blocks(listed, max_blocks)
    n_labels = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."))) + 1
    candidates = [
        F.when(
            (n_labels >= labels) & (F.length("path") >= size),
            F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, size)),
        )
        for labels, size in shapes
    ]

    def possible(key: Column) -> Column:
        place, masks = _bits(key, blocks)
        hit = key.isNotNull()
        for i, mask in enumerate(masks):
            hit = hit & (filter_words[place * WORDS + i].bitwiseAND(mask) == mask)
        return hit

    # one bounded array, parsed once when the plan is made and sent to the tasks as a constant
    filter_words = F.from_json(F.lit(str(bits)), "array<bigint>")
    marked = (
        rows.withColumn("row", F.monotonically_increasing_id())
        .withColumn("keys", F.array_distinct(F.array(*candidates)))
        .select("row", "id", "host", "path", F.filter("keys", possible).alias("keys"))
    )
    marked = materialize(marked)
    plain = marked.where(F.size("keys") == 0).select(
        *default_row, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
    )
    hits = marked.where(F.size("keys") > 0)
    probes = hits.select("row", F.explode("keys").alias("key"))
    exact = listed.select("key", "host_size", "path_size", "verdict")
    if fits_broadcast(listed, "key", 48):
        found = probes.join(F.broadcast(exact), "key")
    else:
        # only rules that are met matter; their keys are counted first, so hot ones are known
        probes = materialize(probes)
        met = materialize(probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(exact, "key"))
        found = attach(probes, met, ["key"], "n", probes.count()).where("verdict is not null")
    best = found.groupBy("row").agg(
        F.max(
            F.struct((F.col("host_size") + F.col("path_size")).alias("size"), "host_size", "key", "verdict")
        ).alias("best")
    )
    judged = hits.join(best, "row", "left").select(
        *default_row,
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
    return plain.unionByName(judged)
