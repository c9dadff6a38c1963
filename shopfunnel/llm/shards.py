"""Token shards on storage: writing documents' ids in id order, and reading them back.

Documents are dealt out by ranges of their ids, so that shard follows shard in id order, and each
task codes its range as segments of some ten thousand ids. A segment is one binary value:

    ``TOK8``, then as little-endian 64-bit integers: documents, ids, words of the lengths, words of
    the ids; then block offsets and words of the documents' lengths; then those of the ids

with both number sequences in :mod:`simple8b`. Segments are rows of Parquet files, so that they
get to any storage through Spark's own committing writers, a lost task's files never count, and
readers can take any segment by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfunnel.llm import simple8b, tokens

#: Ids of a segment, unless one document has more.
SEGMENT_IDS = 1 << 16
#: Id put after each document.
END = 0
_MAGIC = b"TOK8"


def to_segment(lengths: list[int], ids: np.ndarray) -> bytes:
    """Binary form of documents of the given lengths whose ids stand one after the other."""
    coded = [simple8b.encode(np.array(lengths, np.uint64)), simple8b.encode(ids)]
    head = np.array([len(lengths), len(ids), *(len(words) for words, _ in coded)], "<i8")
    return _MAGIC + head.tobytes() + b"".join(o.astype("<i8").tobytes() + w.astype("<u8").tobytes() for w, o in coded)


def from_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and ids of a segment."""
    if data[:4] != _MAGIC:
        raise ValueError("not a token segment")
    head = np.frombuffer(data, "<i8", 4, 4)
    at, out = 36, []
    for n, n_words in ((head[0], head[2]), (head[1], head[3])):
        n_offsets = -(-n // simple8b.BLOCK) + 1
        offsets = np.frombuffer(data, "<i8", n_offsets, at)
        words = np.frombuffer(data, "<u8", n_words, at + 8 * n_offsets)
        at += 8 * int(n_offsets + n_words)
        out.append(simple8b.decode(words, offsets, int(n)))
    return out[0].astype(np.int64), out[1]


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = END,
    vocabulary: str | None = None,
) -> None:
    """Encode every text, with ``end`` after it, and write the ids in ascending id order.

    Rows of one id are ordered by their texts; null ids come first, and a null text is empty.
    An empty table gives files without segments. Other columns are not read.
    """
    vocabulary = vocabulary or tokens.vocabulary_path()
    id_type = docs.schema[id_col].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        held: list[tuple[object, bytes]] = []
        size = 0
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            texts = tokens.encoder(vocabulary).documents(batch.column(1), end)
            for key, data in zip(batch.column(0).to_pylist(), texts):
                held.append((key, data))
                size += len(data) // 4
                if size >= SEGMENT_IDS:
                    yield _segment_row(held, shard, before, kind)
                    before, held, size = before + size, [], 0
        if held:
            yield _segment_row(held, shard, before, kind)

    ordered = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = f"shard long, before long, n_ids long, doc_ids array<{id_type}>, segment binary"
    ordered.mapInArrow(code, schema).write.parquet(path)


def _segment_row(held: list[tuple[object, bytes]], shard: int, before: int, kind: pa.DataType) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(data for _, data in held), "<u4")
    segment = to_segment([len(data) // 4 for _, data in held], ids)
    columns = [
        pa.array([shard]), pa.array([before]), pa.array([len(ids)]),
        pa.array([[key for key, _ in held]], pa.list_(kind)), pa.array([segment]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "before", "n_ids", "doc_ids", "segment"])


def read_shards(df: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document in shard files read as ``df``.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian unsigned 32-bit
    integers. The driver gets one total per shard to add up.
    """
    totals = df.groupBy("shard").agg(F.sum("n_ids").alias("n")).toArrow().sort_by("shard")
    ends = np.cumsum(totals["n"].to_numpy())
    first = dict(zip(totals["shard"].to_pylist(), (ends - totals["n"].to_numpy()).tolist()))
    bases = df.sparkSession.sparkContext.broadcast(first)
    id_type = df.schema["doc_ids"].dataType.elementType.simpleString()

    def open_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, keys, segment in zip(*(batch.column(c) for c in ("shard", "before", "doc_ids", "segment"))):
                lengths, ids = from_segment(segment.as_py())
                data, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths)
                starts = ends - lengths
                pieces = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                base = bases.value[shard.as_py()] + before.as_py()
                columns = [keys.values, pa.array(starts + base), pa.array(lengths), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    read = df.select("shard", "before", "doc_ids", "segment")
    return read.mapInArrow(open_segments, f"doc_id {id_type}, start long, n_tokens long, ids binary")
