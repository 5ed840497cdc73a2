"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are turned into integers, floor(scale * x). The rows are cut into blocks of about
``block_rows`` by a hash of the id, the queries into chunks; every block meets every chunk of
queries (a stated query set against all rows, in blocks). Inside a block each dimension has a list of the block's
rows sorted by value. A query reads all lists in step, from the top where its own component is
positive and from the bottom where it is negative. Rows met are scored in full (random access). The
sum over the lists of component times the value last read bounds the score of every row not yet
met; when it is below the k-th best score the query is done. Ties with the bound go on, so that a
smaller id can still win. The best k of each block meet in a window that keeps k rows per query and block.

Defined cases: a null vector, or one with a null, NaN or infinite component, takes no part,
neither does a null id. Vectors are compared only with vectors of their own length; empty vectors
score 0. An id may have several vectors: each different one is a candidate of all other ids' queries, and the
smallest one is the id's query. Fewer than k other rows give
fewer results, a lone query none. Components and scores beyond the range of a long are clipped
to it. Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetry.session import materialize, ship_package

EXACT = ((np.float32, 2.0**24), (np.float64, 2.0**53))
LONG = 2**63 - 1


def threshold_top_k(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """``(query_id, vec_id, score)``: each query's best k rows of this block, its own id left out."""
    by_id = np.argsort(ids, kind="stable")
    ids, rows = ids[by_id], rows[by_id]
    n, dims = rows.shape
    # floats hold all sums exactly up to a bound; beyond the last one Python's integers do the work
    bound = max(1, dims) * float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0))
    kind = next((kind for kind, exact in EXACT if bound < exact), object)
    table, asked = rows.astype(kind), queries.astype(kind)
    lists = np.argsort(rows, axis=0, kind="stable")
    values = np.take_along_axis(table, lists, axis=0)
    found = []
    for own, q in zip(query_ids, asked, strict=True):
        up = np.array(q >= 0, bool)
        met = np.zeros(n, bool)
        met[np.searchsorted(ids, own) : np.searchsorted(ids, own, "right")] = True
        best_ids, best = np.empty(0, np.int64), np.empty(0, kind)
        depth, step = 0, max(8, k)
        while depth < n:
            upto = min(n, depth + step)
            near = np.zeros(n, bool)
            near[lists[n - upto : n - depth, up].ravel()] = True
            near[lists[depth:upto, ~up].ravel()] = True
            if not dims:
                near[:] = True
            new = np.flatnonzero(near & ~met)
            met |= near
            # scoring many rows is faster in place than picking them first
            scores = (table @ q)[new] if 4 * len(new) > n else table[new] @ q
            if best.size == k:
                higher = scores >= best[-1]
                new, scores = new[higher], scores[higher]
            best_ids, best = np.concatenate([best_ids, new]), np.concatenate([best, scores])
            order = _best(best_ids, best, k)
            best_ids, best = best_ids[order], best[order]
            if met.all():
                break
            last = np.where(up, values[n - upto], values[upto - 1])
            if len(best) == k and (last * q).sum() < best[-1]:
                break
            depth, step = upto, step * 4
        found.extend((int(own), int(ids[i]), max(-LONG, min(LONG, int(s)))) for i, s in zip(best_ids, best, strict=True))
    return found


def _best(places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The k highest scores, ties to the earlier place."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], places[i]))[:k], np.int64)
    if len(scores) > 4 * k:
        # all that reach the k-th highest score, ties with it included
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return some[np.lexsort((places[some], -scores[some]))[:k]]
    return np.lexsort((places, -scores))[:k]


def integer_vectors(rows: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``(id, v array<long>)`` of the rows that take part, equal ones once."""
    v = F.col(embedding)
    limit = F.lit(float("inf"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < limit))
    # as doubles, floor() saturates at the ends of a long
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    some = rows.where(F.col(vec_id).isNotNull() & F.coalesce(fine, F.lit(False)))
    return some.select(F.col(vec_id).cast("long").alias("id"), whole.alias("v")).distinct()


def top_k(
    rows: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 5,
    scale: int = 256,
    block_rows: int = 8192,
    chunk_queries: int = 512,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; ``is_query`` is a condition on the column ``id``."""
    ship_package(rows.sparkSession)
    vectors = materialize(integer_vectors(rows, vec_id, embedding, scale))
    queries = materialize(vectors.where(is_query).groupBy("id").agg(F.min("v").alias("v")))
    n = {"n": vectors.count(), "q": queries.count()}
    blocks, chunks = max(1, -(-n["n"] // block_rows)), max(1, -(-n["q"] // chunk_queries))
    place = lambda seed, m: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(m))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    sides = [
        vectors.withColumn("block", place(0, blocks)).withColumn("chunk", every(chunks)).withColumn("asks", F.lit(False)),
        queries.withColumn("chunk", place(1, chunks)).withColumn("block", every(blocks)).withColumn("asks", F.lit(True)),
    ]
    meeting = sides[0].unionByName(sides[1])

    def search(table):
        asks = np.array(table["asks"].to_pylist(), bool)
        ids = np.array(table["id"].to_pylist(), np.int64)
        sizes = np.array(table["v"].combine_chunks().value_lengths().to_pylist(), np.int64)
        out = []
        for size in np.unique(sizes[asks]):
            mine = np.flatnonzero(sizes == size)
            flat = table["v"].combine_chunks().take(pa.array(mine)).flatten()
            matrix = flat.to_numpy(zero_copy_only=False).reshape(len(mine), size)
            q = asks[mine]
            if (~q).any():
                out += threshold_top_k(ids[mine][~q], matrix[~q], ids[mine][q], matrix[q], k)
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    met = meeting.groupBy("block", "chunk").applyInArrow(search, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
