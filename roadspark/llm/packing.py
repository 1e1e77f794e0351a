"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are the binary digits of
their number, full context length first. Every piece is a sequence of its own:
no sequence crosses documents and none needs padding, since its length is a
power of two. Sequences of equal length share a bucket, from which batches of
one shape are drawn.

Null and empty texts give the end token alone, repeated rows give pieces of
their own, an empty table gives an empty result, null ids stay null, and columns
other than ``doc_id`` and ``text`` are ignored. A very long text is held by one
worker while it is encoded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.llm.bpe_cache import ByteBpe

CONTEXT = 1024
END = 0
_LABELS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def piece_lengths(n: int, context: int = CONTEXT) -> list[int]:
    """``n`` as full contexts followed by the binary digits of the rest, largest first."""
    rest = n % context
    return [context] * (n // context) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _cut(batches: Iterator[pa.RecordBatch], path: str, context: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode = ByteBpe(path)
    end = np.asarray([END], "<u4").tobytes()
    for batch in batches:
        # Few rows at a time, so that what goes out stays small beside what came in.
        for at in range(0, batch.num_rows, 1000):
            some = batch.slice(at, 1000)
            doc, start, length, crc, tokens, ids = [], [], [], [], [], []
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                raw = encode(text or "") + end
                n, first = len(raw) // 4, 0
                for size in piece_lengths(n, context):
                    piece = raw[4 * first : 4 * (first + size)]
                    doc.append(doc_id)
                    start.append(first)
                    length.append(size)
                    crc.append(zlib.crc32(piece))
                    tokens.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
                    first += size
            columns = [pa.array(c, pa.int64()) for c in (doc, start, length, crc, tokens)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def pack(docs: DataFrame, tokenizer: str, context: int = CONTEXT, with_ids: bool = True) -> DataFrame:
    """One row per piece with its tokens (``ids``), bucket (``length``) and sequence.

    ``tokenizer`` is the path of a byte-level vocabulary file on every machine.
    Ids of sequences come from the row's place in its input partition, so no
    rows move.
    """
    schema = _LABELS + (", ids array<int>" if with_ids else "")
    pieces = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: _cut(batches, tokenizer, context, with_ids), schema
    )
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store packed pieces by length, so that a reader draws batches of one shape from one folder."""
    pieces.write.partitionBy("length").parquet(path)


def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
