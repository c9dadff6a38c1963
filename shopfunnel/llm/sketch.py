"""A count-min sketch kept as Spark rows, and the bitmap of its cells counted at least twice.

Tasks turn keys into cells; Spark adds the cells up with map-side combining, so merging the
partitions' sketches is an ordinary aggregate. A lookup only asks whether a key can have been
counted twice, so what the tasks of the second pass get is one bit per cell: ``DEPTH`` rows of
``2 ** width_bits`` bits. ``width_for`` lets the width follow the number of keys, up to what a
task can hold. With more keys than cells bits fill up and more keys pass; none that was counted
twice is ever refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the sketch: a key passes if it is repeated in every one.
DEPTH = 2
#: Cells of a row as a power of two; the bitmap takes ``DEPTH * 2 ** (WIDTH_BITS - 3)`` bytes.
WIDTH_BITS = 26
#: The same at most where the width follows the input: 256 MB of bits.
MOST_BITS = 30
#: Cells whose bits are packed together.
_SLICE_BITS = 16


def width_for(keys: int) -> int:
    """The width that gives each of so many keys four to eight cells, up to ``MOST_BITS``."""
    return min(max(keys.bit_length() + 2, _SLICE_BITS), MOST_BITS)


def cells(keys: np.ndarray, width_bits: int = WIDTH_BITS) -> np.ndarray:
    """The cell of each key in each row of the sketch, rows numbered on."""
    shift = np.uint64(64 - width_bits)
    rows = [(keys * np.uint64(odd)) >> shift for odd in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
    return np.stack([r.astype(np.int64) + (i << width_bits) for i, r in enumerate(rows)])


def counted(keys: np.ndarray, width_bits: int = WIDTH_BITS) -> pa.RecordBatch:
    """What one batch of keys adds to the sketch: rows of ``cell`` and ``n``."""
    cell, n = np.unique(cells(keys, width_bits), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n.astype(np.int64))], ["cell", "n"])


def repeated(sketches: DataFrame, width_bits: int = WIDTH_BITS) -> Broadcast:
    """Merge the sketches of all partitions; broadcast the bits of cells counted twice or more."""
    full = sketches.groupBy("cell").agg(F.sum("n").alias("n")).filter("n > 1")
    return _bitmap(full, width_bits)


def marked(keys: DataFrame, width_bits: int = WIDTH_BITS) -> Broadcast:
    """Broadcast the bits of the cells of all ``keys``, one column of longs."""

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = (b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches)
        return batches_of(some, width_bits)

    return _bitmap(keys.mapInArrow(sketches, "cell long, n long").select("cell").distinct(), width_bits)


def _bitmap(marks: DataFrame, width_bits: int) -> Broadcast:
    slices = marks.select(F.shiftright("cell", _SLICE_BITS).alias("slice"), "cell")
    packed = slices.groupBy("slice").applyInArrow(_pack, "slice long, bits binary").collect()
    bits = np.zeros(max(1, (DEPTH << width_bits) >> 3), dtype=np.uint8)
    for row in packed:
        at = row["slice"] << (_SLICE_BITS - 3)
        piece = np.frombuffer(row["bits"], np.uint8)[: len(bits) - at]
        bits[at : at + len(piece)] = piece
    return marks.sparkSession.sparkContext.broadcast(bits)


def _pack(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
    within = found["cell"].to_numpy() & ((1 << _SLICE_BITS) - 1)
    marks = np.zeros(1 << _SLICE_BITS, dtype=bool)
    marks[within] = True
    return pa.table({"slice": pa.array([key[0].as_py()]), "bits": pa.array([np.packbits(marks).tobytes()])})


def holds(keys: np.ndarray, bits: np.ndarray, width_bits: int = WIDTH_BITS) -> np.ndarray:
    """Whether all cells of each key are marked: false only for keys that were not."""
    passed = np.ones(len(keys), dtype=bool)
    for cell in cells(keys, width_bits):
        passed &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
    return passed


def batches_of(keys: Iterator[np.ndarray], width_bits: int = WIDTH_BITS) -> Iterator[pa.RecordBatch]:
    for some in keys:
        if len(some):
            yield counted(some, width_bits)
