"""Token arrays to index sequences.

A vocabulary that passes the size check is looked up inside the scan: one Arrow hash probe
per batch, no shuffle and no exploded rows. A larger one is joined with the distinct tokens of blocks
of documents; no plan step has a row per token.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from facetry.functions.arrays import pad_left
from facetry.operators import blocks
from facetry.operators.blocks import BLOCK_ENTRIES
from facetry.operators.matcher import SLICE_CHARS
from facetry.schema import MAXLEN
from facetry.session import fits_broadcast, ship_package


class TokenIndex:
    """Token to index; the hash table is built once per worker process, at the first batch."""

    def __init__(self, tokens, idx: np.ndarray):
        self.tokens, self.idx = tokens, idx
        self.table: dict[str, int] | None = None

    def __getstate__(self):
        return {"tokens": self.tokens, "idx": self.idx, "table": None}

    def places(self, flat):
        """For each token of an Arrow array its place in ``tokens``, -1 if it has none."""
        if self.table is None:
            self.table = dict(zip(self.tokens.to_pylist(), range(len(self.tokens)), strict=True))
        coded = flat.dictionary_encode()
        get = self.table.get
        each = np.array([get(t, -1) for t in coded.dictionary.to_pylist()] + [-1], dtype=np.int64)
        return each[coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)]


def _probe(vocab: DataFrame, keep_unknown: bool):
    """An Arrow function mapping token lists to index lists through a broadcast vocabulary."""
    ship_package(vocab.sparkSession)
    table = vocab.select("token", "idx").toArrow()
    shared = vocab.sparkSession.sparkContext.broadcast(
        TokenIndex(table["token"].combine_chunks(), table["idx"].to_numpy())
    )

    @arrow_udf(T.ArrayType(T.IntegerType()))
    def probe(tokens):
        import pyarrow as pa
        import pyarrow.compute as pc

        index = shared.value
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        place = index.places(tokens.flatten())
        found = np.append(index.idx, 0)[place].astype(np.int32)
        if not keep_unknown:
            known = place >= 0
            upto = np.concatenate(([0], np.cumsum(known)))
            ends = np.cumsum(lengths)
            lengths = upto[ends] - upto[ends - lengths]
            found = found[known]
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    return probe


def lookup_chars(docs: DataFrame, vocab: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """``(id, seq)`` of the characters of ``docs(id, text)``, without building token arrays.

    A character vocabulary cannot outgrow the code points there are, so it always fits: it
    becomes an array indexed by code point, and a slice of texts is one array lookup. An entry
    that is not one character is an error.
    """
    spark = docs.sparkSession
    ship_package(spark)
    longer = vocab.where(F.length("token") != 1).limit(1).collect()
    if longer:
        raise ValueError(f"not a character: {longer[0]['token']!r}")
    single = vocab.select("token", "idx").toArrow()
    index = np.zeros(sys.maxunicode + 1, dtype=np.int32)
    index[[ord(c) for c in single["token"].to_pylist()]] = single["idx"].to_numpy()
    shared = spark.sparkContext.broadcast(index)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for begin, end in blocks.ranges(np.cumsum(sizes, dtype=np.int64), SLICE_CHARS):
                texts = "".join(pc.fill_null(batch.column(1).slice(begin, end - begin), "").to_pylist())
                found = shared.value[np.frombuffer(texts.encode("utf-32-le", "surrogatepass"), np.uint32)]
                edges = np.concatenate(([0], np.cumsum(sizes[begin:end])))
                if not keep_unknown:
                    known = found > 0
                    edges = np.concatenate(([0], np.cumsum(known)))[edges]
                    found = found[known]
                seq = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(found))
                yield pa.record_batch([batch.column(0).slice(begin, end - begin), seq], ["id", "seq"])

    fields = [("id", docs.schema["id"].dataType), ("seq", T.ArrayType(T.IntegerType()))]
    return docs.select("id", "text").mapInArrow(probe, T.StructType([T.StructField(*f) for f in fields]))


def lookup_by_join(
    docs: DataFrame, vocab: DataFrame, keep_unknown: bool = False, block_tokens: int = BLOCK_ENTRIES
) -> DataFrame:
    """``(id, seq)`` by a dictionary-coded join, for vocabularies of any size.

    The distinct tokens of a block of documents are joined with the vocabulary, one row each;
    the indexes found go back to the block, which holds its texts as codes (``operators.blocks``).
    """
    coded = blocks.pack(docs.select("id", "tokens"), "tokens", most=block_tokens)
    listed = blocks.dictionaries(coded, "token", T.StringType()).where("token IS NOT NULL")
    found = listed.join(vocab.select("token", F.col("idx").cast("int").alias("idx")), "token").select("block", "code", "idx")

    def decode(documents, rows):
        import pyarrow as pa

        codes = documents.column("codes")
        offsets = np.asarray(codes.offsets).astype(np.int64)
        each = codes.values.fill_null(-1).to_numpy(zero_copy_only=False)
        index = np.zeros(int(each.max(initial=-1)) + 2, np.int32)  # the last one serves null tokens
        index[rows["code"].to_numpy()] = rows["idx"].to_numpy()
        seq = index[each]
        if not keep_unknown:
            known = seq > 0
            offsets, seq = np.concatenate([[0], np.cumsum(known)])[offsets], seq[known]
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(seq))
        return pa.table({"id": documents.column("id"), "seq": lists})

    return blocks.meet(coded, found, decode, f"id {docs.schema['id'].dataType.simpleString()}, seq array<int>")


def lookup(docs: DataFrame, vocab: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """``(id, seq)``: indexes of the tokens in order; unknown ones dropped, or kept as 0."""
    if fits_broadcast(vocab, "token"):
        return docs.select("id", _probe(vocab, keep_unknown)("tokens").alias("seq"))
    return lookup_by_join(docs, vocab, keep_unknown)


def encode(docs: DataFrame, vocab: DataFrame, maxlen: int = MAXLEN) -> DataFrame:
    """``(id, seq)`` of fixed length: look up, drop unknown tokens, then cut and pad left."""
    return lookup(docs, vocab).select("id", pad_left("seq", maxlen).alias("seq"))


def encode_chars(docs: DataFrame, vocab: DataFrame, maxlen: int = MAXLEN) -> DataFrame:
    """``encode`` for one token per character, straight from ``docs(id, text)``."""
    return lookup_chars(docs, vocab).select("id", pad_left("seq", maxlen).alias("seq"))
