"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then the binary digits of the rest. A piece is a sequence of its own, so no
sequence crosses documents and none needs padding; sequences of one length form a bucket, from
which batches of equal shape are drawn. Cutting is narrow: no row leaves its task until buckets
are written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm.tokens import encode

LONGEST = 2048
END = 1


_PIECE = [
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("bucket", T.IntegerType()),
]


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Descending powers of two that add up to ``n``, none above ``longest``."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cut(texts: pa.Array, end: int, longest: int, with_ids: bool) -> Iterator[tuple]:
    for at, text in enumerate(texts):
        ids = np.array([*encode(text.as_py() or ""), end], dtype="<u4")
        start = 0
        for length in piece_lengths(len(ids), longest):
            piece = ids[start:start + length]
            yield (
                at, start, length, piece.astype(np.int32) if with_ids else None, zlib.crc32(piece.tobytes()), len(ids),
                length.bit_length() - 1,
            )
            start += length


def pack(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), longest: int = LONGEST,
         end: int = END, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc (struct of ``carry``), start, length, ids, ids_crc32, doc_tokens,
    bucket (log2 of length), sequence_id and offset (always 0, as a piece fills its sequence).

    A null or empty text is the end id alone, one piece of length 1. Repeated rows are packed each
    for itself. Extra columns are not read unless carried. ``ids`` is null without ``with_ids``.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                carried, texts = part.column(0), part.column(1)
                rows = list(_cut(texts, end, longest, with_ids))
                for at in range(0, len(rows), 2048):
                    some = list(zip(*rows[at:at + 2048]))
                    yield pa.RecordBatch.from_arrays(
                        [carried.take(pa.array(some[0], pa.int64()))]
                        + [pa.array(c, t) for c, t in zip(some[1:], types)],
                        names=names,
                    )

    names = ["doc", "start", "length", "ids", "ids_crc32", "doc_tokens", "bucket"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int32()]
    source = docs.select(F.struct(*carry).alias("doc"), F.col(text_col).alias("text"))
    schema = T.StructType([source.schema["doc"], *_PIECE])
    return source.mapInArrow(cut, schema).select(
        "doc", "start", "length", "ids", "ids_crc32", "doc_tokens", "bucket",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per sequence length, for batches of one shape.

    Rows of a bucket are dealt by their sequence as well, so the longest length, which holds most
    pieces, spreads over all tasks.
    """
    salt = F.pmod(F.xxhash64("sequence_id"), F.lit(64))
    pieces.repartition(F.col("bucket"), salt).write.partitionBy("bucket").parquet(path)
