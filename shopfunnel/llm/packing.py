"""Packing by binary decomposition: no sequence holds tokens of two documents.

A document's ids are cut into pieces whose lengths are powers of two: as many of the longest as
fit, then one for each bit of what is left. Each piece is a sequence by itself, without padding.
Pieces are kept in buckets of equal length, so that a training step takes a batch of one length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfunnel.llm import tokens
from shopfunnel.llm.common import give_back, only, saved

#: Longest sequence, a power of two.
LONGEST = 2048
#: Id put after each document.
END = 1
#: Bytes of ids in a batch of rows at most, unless one document has more.
_BATCH_BYTES = 8 << 20


def lengths_of(total: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of ``total`` ids, longest first."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << b for b in reversed(range(longest.bit_length())) if rest >> b & 1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = LONGEST,
    end: int = END,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers and ``ids_crc32`` is theirs; ``start`` counts
    the document's ids before the piece, ``doc_tokens`` all of them with the end id. Sequence ids
    are consecutive within a bucket of one length, and the buckets follow each other from short to
    long. A null text is empty: its document is the end id alone. A null id is kept. Repeated rows
    are packed each. An empty table gives an empty result. Other columns are not read.
    """
    path = vocabulary or tokens.vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("tokens")
        part, met = TaskContext.get().partitionId(), dict.fromkeys((1 << b for b in range(longest.bit_length())), 0)
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for key, data in zip(batch.column(0).to_pylist(), tokens.encoder(path).documents(batch.column(1), end)):
                at, total = 0, len(data) // 4
                for length in lengths_of(total, longest):
                    piece = data[4 * at : 4 * (at + length)]
                    rows.append((key, at, length, piece, zlib.crc32(piece), total, part, met[length]))
                    met[length] += 1
                    at += length
                size += len(data)
                if size >= _BATCH_BYTES:
                    yield _batch(rows, batch.schema.field(0).type)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, batch.schema.field(0).type)
        give_back()

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
        "part long, place long"
    )
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces = saved(read.mapInArrow(cut, schema), "pieces")
    return _numbered(pieces)


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
    names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "part", "place"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _numbered(pieces: DataFrame) -> DataFrame:
    """Sequence ids from each piece's place among those of its length in its part.

    The driver gets one row per part and length.
    """
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).toPandas()
    counts = counts.sort_values(["length", "part"])
    counts["before"] = counts["n"].cumsum() - counts["n"]
    spark = pieces.sparkSession
    before = spark.createDataFrame(counts[["length", "part", "before"]], "length long, part long, before long")
    numbered = pieces.join(F.broadcast(before), ["length", "part"])
    return numbered.select(
        "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
        (F.col("before") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
