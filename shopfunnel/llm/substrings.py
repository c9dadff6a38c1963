"""Removal of passages that an earlier document already holds.

A window is ``size`` consecutive words of one document. A word goes if it lies in a window whose
word sequence also starts in a document with a smaller id. Three passes:

1. Every window is represented by the least hash of the short grams inside it, which equal windows
   share and neighbouring windows mostly share too. The partitions' count-min sketches of these
   representatives are merged; counts in it are never too low.
2. Only windows whose representative may be repeated are grouped, by the hash of all their words,
   to find the least document id of each. What isn't repeated costs a row in neither shuffle.
3. The starts of removable windows go back to their documents, where the words are cut out.

Windows are compared by 64-bit hashes, or by two of them (``wide``) for corpora with so many
repeated windows that one in 2**64 is not rare enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.llm import sketch
from shopfunnel.llm.common import fresh, only, same
from shopfunnel.llm.words import Words, grams, mix, sliding_min, text_chunks

#: Words of a window.
WINDOW = 50
#: Share of a window that a gram standing for it covers: a third.
_GRAM_SHARE = 3


def _doc_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and end of the text, as a word number, of each word."""
    lengths = np.diff(words.bounds)
    return np.repeat(np.arange(len(lengths)), lengths), np.repeat(words.bounds[1:], lengths)


def _windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, text and representative of each window."""
    gram = max(1, size // _GRAM_SHARE)
    least = sliding_min(grams(words.hashes, gram), size - gram + 1)
    text, end = _doc_of(words)
    starts = np.flatnonzero(np.arange(len(least)) + size <= end[: len(least)])
    return starts, text[starts], least[starts]


def _representatives(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for _, _, words in text_chunks(batch.column(0)):
            _, text, least = _windows(words, size)
            if len(least):
                new = np.ones(len(least), dtype=bool)
                new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                yield least[new]


def _most_representatives(texts: DataFrame, size: int) -> int:
    """About how many representatives the windows of all texts have, rather too many.

    The least of so many consecutive grams changes twice in as many words, of three bytes or more.
    """
    n_bytes = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return 2 * n_bytes // (3 * (size - max(1, size // _GRAM_SHARE) + 2))


def _repeated_windows(
    docs: DataFrame, id_col: str, text_col: str, size: int, wide: bool, width_bits: int | None
) -> DataFrame:
    """``id, doc, start, h0[, h1]`` of the windows that the sketch estimates to be repeated.

    ``doc`` is a hash of the text, which tells rows of the same id apart.
    """
    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    if width_bits is None:
        width_bits = sketch.width_for(_most_representatives(texts, size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        return sketch.batches_of(_representatives(batches, size), width_bits)

    bits = sketch.repeated(texts.mapInArrow(count, "cell long, n long"), width_bits)
    names = ["h0", "h1"] if wide else ["h0"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in batches:
            for first, last, words in text_chunks(batch.column("text")):
                starts, text, least = _windows(words, size)
                keep = sketch.holds(least, bits.value, width_bits)
                starts, text = starts[keep], text[keep]
                if not len(starts):
                    continue
                hashes = [grams(words.hashes, size)[starts]]
                if wide:
                    hashes.append(grams(mix(words.hashes + np.uint64(1)), size)[starts])
                places = pa.array(np.searchsorted(text, np.arange(last - first + 1)).astype(np.int32))
                columns = [(starts - words.bounds[:-1][text]).astype(np.int32), *(h.view(np.int64) for h in hashes)]
                lists = [pa.ListArray.from_arrays(places, pa.array(c)) for c in columns]
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("doc"), *lists], ["id", "doc", "start", *names]
                )

    keyed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("doc"), F.col(text_col).alias("text")
    ).filter("text is not null")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, doc long, start array<int>, " + ", ".join(f"{n} array<long>" for n in names)
    lists = keyed.mapInArrow(pick, schema).filter("size(start) > 0")
    each = lists.select("id", "doc", F.explode(F.arrays_zip("start", *names)).alias("w"))
    return each.select("id", "doc", "w.*")


def removable_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    wide: bool = False,
    width_bits: int | None = None,
) -> DataFrame:
    """``id, doc, starts``: where the windows begin that a document with a smaller id also holds.

    A null id is smaller than none and never removed from; rows of one id don't remove each other.
    """
    windows = _repeated_windows(docs, id_col, text_col, size, wide, width_bits).filter("id is not null")
    key = [c for c in windows.columns if c.startswith("h")]
    first = windows.groupBy(*key).agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = first.filter("first < last").drop("last")
    late = windows.join(first, key).filter("id > first")
    return late.groupBy("id", "doc").agg(F.collect_set("start").alias("starts"))


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    join_all: bool = False,
    wide: bool = False,
    width_bits: int | None = None,
) -> DataFrame:
    """``docs`` with repeated words cut from the text, and ``n_words``, ``n_removed``.

    What is left of a changed text is its kept words joined by one space; unchanged texts stay as
    they are, or are joined so too with ``join_all``. The sketch's width follows the length of all texts
    unless ``width_bits`` states it. A null text stays null, or becomes empty with
    ``join_all``, and has no words. Texts of fewer than ``size`` words lose nothing. An empty table
    gives an empty result. Columns of ``docs`` named like the two counts are replaced.
    """
    docs = docs.drop("n_words", "n_removed")
    doc, starts = fresh(docs, "doc"), fresh(docs, "starts")
    gone = removable_windows(docs, id_col, text_col, size, wide, width_bits)
    gone = gone.select(F.col("id").alias("_gone_id"), F.col("doc").alias("_gone_doc"), F.col("starts").alias(starts))
    keyed = docs.withColumn(doc, F.xxhash64(text_col))
    met = same(keyed[id_col], gone["_gone_id"]) & same(keyed[doc], gone["_gone_doc"])
    joined = keyed.join(gone, met, "left").select(*[keyed[c] for c in docs.columns], starts)
    out = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in text_chunks(batch.column(text_col)):
                rows = batch.slice(first, last - first)
                yield _cut(rows, words, text_col, starts, size, join_all)

    return joined.mapInArrow(cut, out)


def _cut(
    rows: pa.RecordBatch, words: Words, text_col: str, starts_col: str, size: int, join_all: bool
) -> pa.RecordBatch:
    spans = rows.column(starts_col)
    lists = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    begins = spans.flatten().to_numpy(zero_copy_only=False) + np.repeat(words.bounds[:-1], lists)
    n = len(words.hashes)
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, begins, 1)
    np.add.at(depth, begins + size, -1)
    kept = np.cumsum(depth[:-1]) == 0
    n_words = np.diff(words.bounds)
    total = np.concatenate([[0], np.cumsum(~kept)])
    n_removed = total[words.bounds[1:]] - total[words.bounds[:-1]]

    text = rows.column(text_col)
    joined = _joined(words, kept)
    if not join_all:
        changed = pa.array(n_removed > 0)
        joined = pa.compute.if_else(changed, joined, text)
    columns = [joined if name == text_col else rows.column(name) for name in rows.schema.names if name != starts_col]
    names = [name for name in rows.schema.names if name != starts_col]
    counts = [pa.array(n_words.astype(np.int64)), pa.array(n_removed.astype(np.int64))]
    return pa.RecordBatch.from_arrays([*columns, *counts], [*names, "n_words", "n_removed"])


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """Each text's kept words joined by one space."""
    text, _ = _doc_of(words)
    starts, ends, owner = words.starts[kept], words.ends[kept], text[kept]
    edge = np.zeros(len(words.data) + 1, dtype=np.int8)
    edge[starts] = 1
    edge[ends] -= 1  # a word may begin where another text's last word ends
    stay = np.cumsum(edge[:-1], dtype=np.int8) > 0
    data = words.data.copy()
    gaps = ends[:-1][owner[1:] == owner[:-1]]  # a separator follows, as another word does
    data[gaps] = 0x20
    stay[gaps] = True
    # bytes of text i end with its last kept word, so its share is found by counting per text
    lengths = np.bincount(owner, weights=ends - starts, minlength=len(words.bounds) - 1).astype(np.int64)
    counts = np.bincount(owner, minlength=len(words.bounds) - 1)
    lengths += np.maximum(counts - 1, 0)
    places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(places), pa.py_buffer(data[stay]))
