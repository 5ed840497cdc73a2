"""Word vectors: embedding rows, pooled document vectors, vector training.

An embedding table that passes the size check is broadcast as a matrix and each document
is pooled where it is read: no exploded tokens and no shuffle. With a larger table blocks of documents
(``operators.blocks``) meet the vectors they use, each once per block. Both ways pool by the same
running states (``operators.pooling``). Whatever depends on a vector alone (attention projections) is
computed once per vector.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from facetry.operators import blocks
from facetry.operators.encode import lookup
from facetry.operators.pooling import Pooled
from facetry.operators.vocabulary import fit_vocabulary
from facetry.session import ensure_checkpoint_dir, fits_broadcast, hot_limit, materialize, ship_package

HOT_ROWS = 50_000
DENSE = 1 << 10  # different tokens of a block up to which all their pairs are counted in a table
PAIR_STEPS = 1 << 20  # steps of one block of which the pairs are counted
BLOCK_STEPS = 1 << 20  # steps of one block, whose distinct vectors a task holds
KINDS = ("mean", "max", "attention")
_RUN = 1 << 15  # steps handled at once inside a task


def embedding_rows(vocab: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """``(idx, v)`` for every vocabulary entry; no vector means zeros, and row 0 is the pad."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    rows = vocab.join(vectors.select("token", "v"), "token", "left").select(
        F.col("idx").cast("long").alias("idx"), F.coalesce("v", zeros).alias("v")
    )
    pad = vocab.sparkSession.range(1).select(F.col("id").alias("idx"), zeros.alias("v"))
    return rows.unionByName(pad)


def _dot(v: Column, weights: Sequence[float]) -> Column:
    terms = [v[i] * F.lit(float(w)) for i, w in enumerate(weights)]
    return sum(terms[1:], terms[0])


StepBias = Sequence[float] | float | Callable


def _bias_at(step_bias: StepBias, position: np.ndarray) -> np.ndarray:
    """The bias of the steps at ``position``; a list that ends before them is an error."""
    if callable(step_bias):
        return np.asarray(step_bias(position), dtype=float)
    if isinstance(step_bias, (int, float)):
        return np.full(len(position), float(step_bias))
    steps = int(position.max(initial=-1)) + 1
    if len(step_bias) < steps:
        raise ValueError(f"a text of {steps} steps, but only {len(step_bias)} step biases")
    return np.asarray(step_bias, dtype=float)[position]


class _Scores:
    """The exponents of attention: ``tanh(v . w + b_t)``."""

    def __init__(self, weights: Sequence[float] | None, step_bias: StepBias):
        self.weights, self.step_bias = weights, step_bias

    def project(self, matrix: np.ndarray) -> np.ndarray | None:
        """What depends on a vector alone, once per vector."""
        return None if self.weights is None else matrix @ np.asarray(self.weights, dtype=float)

    def at(self, projected, row, position, owner, queries) -> np.ndarray | None:
        if self.weights is None:
            return None
        return np.tanh(projected[row] + _bias_at(self.step_bias, position))


class _QueryScores(_Scores):
    """The energies of a document's query: ``w_out . tanh(q + h) + b_t``, both sides projected before."""

    def __init__(self, w_step, b_step, w_out, step_bias: StepBias):
        self.w_step, self.b_step, self.w_out, self.step_bias = w_step, b_step, w_out, step_bias

    def project(self, matrix: np.ndarray) -> np.ndarray:
        return matrix @ np.asarray(self.w_step, dtype=float) + np.asarray(self.b_step, dtype=float)

    def at(self, projected, row, position, owner, queries) -> np.ndarray:
        hidden = np.tanh(queries[owner] + projected[row])
        return hidden @ np.asarray(self.w_out, dtype=float) + _bias_at(self.step_bias, position)


def _pool_lists(edges, row, use, matrix, projected, kinds, scores: _Scores, queries=None) -> np.ndarray:
    """Documents whose steps lie between ``edges``, by matrix rows, in runs of a bounded length."""
    states = Pooled(len(edges) - 1, matrix.shape[1], tuple(kinds))
    for begin in range(0, len(row), _RUN):
        steps = np.arange(begin, min(begin + _RUN, len(row)))[use[begin : begin + _RUN]]
        owner = np.searchsorted(edges, steps, side="right") - 1
        at = row[steps]
        states.add(owner, matrix[at], scores.at(projected, at, steps - edges[owner], owner, queries))
    return states.result()


def _shared_matrix(embeddings: DataFrame, dim: int, project: Callable | None = None):
    """Collect a measured table and broadcast ``(sorted idx, matrix, projected)``, last row zeros.

    ``project`` maps the matrix to what depends on a vector alone; it is computed here, once.
    """
    ship_package(embeddings.sparkSession)
    rows = embeddings.select(F.col("idx").cast("long").alias("idx"), "v").toArrow()
    keys = rows["idx"].to_numpy()
    vectors = rows["v"].combine_chunks().flatten().to_numpy().reshape(len(keys), dim)
    order = np.argsort(keys)
    matrix = np.vstack([vectors[order], np.zeros((1, dim), vectors.dtype)])
    projected = project(matrix) if project else None
    return embeddings.sparkSession.sparkContext.broadcast((keys[order], matrix, projected))


def _as_list_array(values: np.ndarray):
    """Rows of a matrix as an Arrow list array."""
    import pyarrow as pa

    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _list_edges(lists) -> np.ndarray:
    offsets = np.asarray(lists.offsets).astype(np.int64)
    return offsets - offsets[0]


def _pool_in_tasks(docs, embeddings, dim, kinds, scores: _Scores, mask_pads, *queries: str):
    """``(id, _p)``, pooled in the scan by a broadcast matrix."""
    shared = _shared_matrix(embeddings, dim, scores.project)

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def pooled(seq, *asked):
        keys, matrix, projected = shared.value
        flat = seq.flatten().to_numpy()
        row = np.searchsorted(keys, flat)
        known = row < len(keys)
        known[known] = keys[row[known]] == flat[known]
        row[~known] = len(keys)  # the zero row
        use = flat != 0 if mask_pads else np.ones(len(flat), bool)
        given = [q.flatten().to_numpy().reshape(len(seq), -1) for q in asked]
        return _as_list_array(_pool_lists(_list_edges(seq), row, use, matrix, projected, kinds, scores, *given))

    return docs.select("id", pooled(F.coalesce("seq", F.array().cast("array<int>")), *queries).alias("_p"))


def _pool_in_blocks(docs, embeddings, dim, kinds, scores: _Scores, mask_pads, *queries: str):
    """``(id, _p)`` for an embedding table of any size: blocks of documents meet the vectors they use.

    The index is a frequency rank, so the hot tokens are known and broadcast; of the others a block
    joins each distinct one once.
    """
    import pyarrow as pa

    table = embeddings.select(F.col("idx").cast("long").alias("idx"), "v")
    most = hot_limit(table, "idx", HOT_ROWS, row_bytes=4 * dim + 64)
    shared = _shared_matrix(table.where(F.col("idx") <= most), dim)
    coded = blocks.pack(docs.select("id", "seq", *queries), "seq", *queries, most=BLOCK_STEPS)
    listed = blocks.dictionaries(coded, "idx", docs.schema["seq"].dataType.elementType)
    listed = listed.select("block", "code", F.col("idx").cast("long").alias("idx")).where(F.col("idx") > most)
    found = listed.join(table.where(F.col("idx") > most), "idx").select("block", "code", "v")

    def work(documents, rows, entries):
        keys, hot, _ = shared.value
        idx = entries.to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(keys, idx)
        at[at == len(keys)] = 0
        matrix = np.zeros((len(idx) + 1, dim), hot.dtype)  # the last row serves null entries
        warm = np.flatnonzero((keys[at] == idx) if len(keys) else np.zeros(len(idx), bool))
        matrix[warm] = hot[at[warm]]
        if rows.num_rows:
            vectors = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            matrix[rows["code"].to_numpy()] = vectors.reshape(-1, dim)
        codes = documents.column("codes")
        row = codes.values.fill_null(-1).to_numpy(zero_copy_only=False)
        use = (np.append(idx, 0)[row] != 0) if mask_pads else np.ones(len(row), bool)
        given = [documents.column(q).flatten().to_numpy().reshape(len(documents), -1) for q in queries]
        made = _pool_lists(_list_edges(codes), row, use, matrix, scores.project(matrix), kinds, scores, *given)
        return pa.table({"id": documents.column("id"), "_p": _as_list_array(made)})

    schema = f"id {docs.schema['id'].dataType.simpleString()}, _p array<double>"
    return blocks.meet(coded, found, work, schema, entries=True)


def pool(
    docs: DataFrame,
    embeddings: DataFrame,
    dim: int,
    kinds: Sequence[str] = KINDS,
    attention_weights: Sequence[float] | None = None,
    step_bias: StepBias = 0.0,
    mask_pads: bool = True,
    in_tasks: bool | None = None,
) -> DataFrame:
    """``(id, mean, max, attention)`` of the vectors behind ``docs(id, seq)``.

    ``embeddings`` is a materialised ``(idx, v)`` table; a step whose index it lacks counts as
    a zero vector, so all-zero rows may be left out of it. Attention weighs step ``t`` by
    ``exp(tanh(v . w + b_t))``. ``step_bias`` is a number, a list (an error for a text that is
    longer) or a function of an array of steps. A document without any
    step gets zeros. ``in_tasks`` is decided by the size of the table unless given.
    """
    kinds = tuple(kinds)
    scores = _Scores(attention_weights if "attention" in kinds else None, step_bias)
    if in_tasks is None:
        in_tasks = fits_broadcast(embeddings, row_bytes=4 * dim + 16)
    how = _pool_in_tasks if in_tasks else _pool_in_blocks
    rows = how(docs, embeddings, dim, kinds, scores, mask_pads)
    return rows.select("id", *[F.slice("_p", i * dim + 1, dim).alias(kind) for i, kind in enumerate(kinds)])


def document_features(pooled: DataFrame) -> DataFrame:
    """``(id, features)``: the three pooled vectors end to end."""
    return pooled.select("id", F.concat("mean", "max", "attention").alias("features"))


def query_attention_pool(
    docs: DataFrame,
    embeddings: DataFrame,
    dim: int,
    w_query: Sequence[Sequence[float]],
    w_step: Sequence[Sequence[float]],
    w_out: Sequence[float],
    b_query: Sequence[float] | None = None,
    b_step: Sequence[float] | None = None,
    step_bias: StepBias = 0.0,
    mask_pads: bool = True,
    in_tasks: bool | None = None,
) -> DataFrame:
    """``(id, attention)`` of ``docs(id, seq, q)``, weighted by each document's query ``q``.

    ``e_t = w_out . tanh(q W_query + b_query + v_t W_step + b_step) + b_t``; softmax over the
    steps with the maximum subtracted and EPSILON added to the sum. The maximum is a running one
    (``operators.pooling``), so energies of any size are weighed right.
    """
    hidden = len(w_out)
    b_query = b_query or [0.0] * hidden
    b_step = b_step or [0.0] * hidden
    query = F.array(*[_dot(F.col("q"), [row[j] for row in w_query]) + F.lit(float(b_query[j])) for j in range(hidden)])
    asked = docs.select("id", "seq", query.alias("_q"))
    if in_tasks is None:
        in_tasks = fits_broadcast(embeddings, row_bytes=4 * dim + 16)
    how = _pool_in_tasks if in_tasks else _pool_in_blocks
    scores = _QueryScores(w_step, b_step, w_out, step_bias)
    return how(asked, embeddings, dim, ("softmax",), scores, mask_pads, "_q").withColumnRenamed("_p", "attention")


def pair_weights(docs: DataFrame, vocab: DataFrame, window: int, tokens: str = "tokens") -> DataFrame:
    """``(a, b, n)``: how often the indexes a and b stand within ``window`` steps of each other, both ways.

    A pair k steps apart counts (window + 1 - k) / window. Blocks of documents add up their own pairs, so a
    pair is one row per block however often it occurs; unknown tokens are left out before counting steps.
    """
    seqs = lookup(docs.select(F.monotonically_increasing_id().alias("id"), F.col(tokens).alias("tokens")), vocab)
    packed = blocks.pack(seqs, "seq", most=PAIR_STEPS)

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            for data, listed in zip(batch.column(0), batch.column(1), strict=True):
                codes = blocks.unpacked(data).column("codes")
                idx = blocks.unpacked(listed).column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                code = codes.values.to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(len(codes)), codes.value_lengths().to_numpy(zero_copy_only=False))
                keys, weights = np.zeros(0, np.int64), np.zeros(0, np.int64)
                table = np.zeros(len(idx) ** 2, np.int64) if len(idx) <= DENSE else None
                for k in range(1, window + 1):
                    near = owner[:-k] == owner[k:]
                    left, right = code[:-k][near], code[k:][near]
                    if table is not None:  # few different tokens: every pair has its cell
                        table += np.bincount(left * len(idx) + right, minlength=len(table)) * (window + 1 - k)
                        continue
                    found, n = np.unique(np.minimum(left, right) * len(idx) + np.maximum(left, right), return_counts=True)
                    every, place = np.unique(np.concatenate([keys, found]), return_inverse=True)
                    total = np.zeros(len(every), np.int64)
                    np.add.at(total, place, np.concatenate([weights, n * (window + 1 - k)]))
                    keys, weights = every, total
                if table is not None:
                    cells = table.reshape(len(idx), len(idx))
                    cells = np.triu(cells + cells.T) - np.diag(np.diag(cells))
                    keys = np.flatnonzero(cells)
                    weights = cells.ravel()[keys]
                a, b = np.divmod(keys, max(1, len(idx)))
                low, high = np.minimum(idx[a], idx[b]), np.maximum(idx[a], idx[b])
                yield pa.record_batch([low, high, weights], ["a", "b", "n"])

    half = packed.select("data", "listed").mapInArrow(count, "a long, b long, n long")
    half = half.groupBy("a", "b").agg((F.sum("n") / F.lit(float(window))).alias("n"))
    # a token next to itself counts from both sides
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    sides = half.select(F.explode(both).alias("p"), "n").select("p.a", "p.b", "n")
    return sides.groupBy("a", "b").agg(F.sum("n").alias("n"))


def train_vectors(
    docs: DataFrame,
    tokens: str = "tokens",
    size: int = 100,
    window: int = 10,
    min_count: int = 1,
    iterations: int = 15,
    seed: int = 16,
    shift: float = 1.0,
    reg: float = 0.05,
) -> DataFrame:
    """Train word vectors for a vocabulary of any size; returns ``(token, v)``.

    Windowed pair counts become positive pointwise mutual information, less log(``shift``), and that table
    is factorised by MLlib's blocked alternating least squares: no vocabulary and no matrix is on the
    driver. Skip-gram with negative sampling factorises the same table (``train_skipgram`` is MLlib's own). A token
    without any positive pair has a zero vector.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    vocab = fit_vocabulary(docs.select(F.monotonically_increasing_id().alias("id"), F.col(tokens).alias("tokens")))
    vocab = vocab.where(F.col("n") >= min_count)
    pairs = materialize(pair_weights(docs, vocab, window, tokens))
    # each side's share of all pairs; the vocabulary's size, joined twice
    sums = pairs.groupBy("a").agg(F.sum("n").alias("s"))
    total = pairs.agg(F.sum("n")).first()[0] or 1.0
    of_b = sums.select(F.col("a").alias("b"), F.col("s").alias("t"))
    information = F.log(F.col("n") * F.lit(total) / (F.col("s") * F.col("t"))) - F.lit(float(np.log(shift)))
    ratings = pairs.join(sums, "a").join(of_b, "b").select(
        F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), information.cast("float").alias("r")
    )
    ratings = materialize(ratings.where("r > 0"))
    zeros = F.array_repeat(F.lit(0.0).cast("float"), size)
    if ratings.isEmpty():
        return vocab.select("token", zeros.alias("v"))
    fitted = ALS(
        rank=size, maxIter=iterations, regParam=reg, userCol="a", itemCol="b", ratingCol="r", seed=seed, coldStartStrategy="drop"
    ).fit(ratings)
    factors = materialize(fitted.userFactors.select(F.col("id").cast("long").alias("idx"), F.col("features").alias("v")))
    return vocab.join(factors, "idx", "left").select("token", F.coalesce("v", zeros).alias("v"))


def train_skipgram(
    docs: DataFrame,
    tokens: str = "tokens",
    size: int = 100,
    window: int = 10,
    min_count: int = 1,
    iterations: int = 15,
    seed: int = 16,
    max_vocabulary: int = 2_000_000,
    partitions: int | None = None,
) -> DataFrame:
    """Skip-gram word vectors; returns ``(token, v)``.

    MLlib keeps the vocabulary and its weights on the driver, so its size is checked first.
    Sentences are never cut: the limit is set to the longest token list of the input.
    """
    spark = docs.sparkSession
    # one pass: how many tokens are frequent enough, and how long the longest list is
    counts = (
        docs.select(F.size(tokens).alias("_n"), F.explode_outer(tokens).alias("t"))
        .groupBy("t")
        .agg(F.count(F.lit(1)).alias("n"), F.max("_n").alias("_n"))
    )
    frequent = F.count_if(F.col("t").isNotNull() & (F.col("n") >= min_count))
    row = counts.agg(frequent.alias("words"), F.max("_n").alias("longest")).first()
    words, longest = row["words"], row["longest"] or 1
    if words > max_vocabulary:
        raise ValueError(f"{words} tokens exceed max_vocabulary={max_vocabulary}; raise min_count")
    model = Word2Vec(
        vectorSize=size,
        windowSize=window,
        minCount=min_count,
        maxIter=iterations,
        seed=seed,
        numPartitions=partitions or spark.sparkContext.defaultParallelism,
        maxSentenceLength=max(longest, 1),
        inputCol=tokens,
        outputCol="_v",
    ).fit(docs.select(tokens))
    return model.getVectors().select(
        F.col("word").alias("token"),
        vector_to_array("vector", "float32").alias("v"),
    )


def nearest_tokens(vectors: DataFrame, asked: Sequence[str]) -> DataFrame:
    """``(token, nearest)``: for each asked token the other one with the largest cosine.

    The few vectors asked for become literals; one aggregation compares them with every row.
    """
    given = {r["token"]: r["v"] for r in vectors.where(F.col("token").isin(*asked)).collect()}
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    best = []
    for token, vector in given.items():
        other = F.array(*[F.lit(float(x)) for x in vector])
        dot = F.aggregate(F.zip_with("v", other, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        # the asked token's own length is the same for all candidates
        closeness = F.when(F.col("token") != token, dot / norm)
        best.append(F.struct(F.lit(token).alias("token"), F.max_by("token", closeness).alias("nearest")))
    if not best:
        return vectors.select("token", F.lit(None).cast("string").alias("nearest")).where("false")
    return vectors.agg(F.array(*best).alias("b")).select(F.explode("b").alias("b")).select("b.*")
