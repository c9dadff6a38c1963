"""Packing into few sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut so that only their first piece is shorter than one; whole
pieces are sequences by themselves, and all others are items to pack. Items are dealt at random to
blocks of bounded size. For each block several islands keep populations of packings. An offspring
takes whole well-filled sequences of one parent into the other, where sequences that hold an item
twice are given up, and packs what they leave homeless by best fit. After each epoch an island's
best packing also moves to the next island. The best packing of a block stands, but for its
least-filled sequences: their items are dealt anew to fewer blocks, level by level until one block
is left, so what blocks leave unfilled is not lost once a block.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfunnel.llm import tokens
from shopfunnel.llm.common import result, saved, scratch
from shopfunnel.session import sized_shuffle

LONGEST = 2048
#: Id put after each document.
END = 0
#: Items of a block, on average.
BLOCK_ITEMS = 2048
#: Islands of a block, packings on each, epochs between migrations, offspring of an epoch.
ISLANDS = 3
POPULATION = 6
EPOCHS = 3
OFFSPRING = 40
#: Largest share of a parent's sequences taken into the other, and of the other's that it gives up.
_INJECTED = 0.25
_GIVEN_UP = 0.25
#: What the order of homeless items may take a size for too small by.
_SHAKEN = 0.9
#: One sequence in so many, the least filled, is opened again on the next level.
_REOPENED = 4
#: Bytes of ids in a batch of rows at most, unless one document has more.
_BATCH_BYTES = 8 << 20


class Packing(NamedTuple):
    """``bins[i]`` is the number of the sequence item i lies in; numbers have no gaps."""

    bins: np.ndarray
    n: int
    squares: int

    @property
    def merit(self) -> tuple[int, int, bytes]:
        """Few sequences, then unevenly filled ones; the rest makes the order total."""
        return -self.n, self.squares, self.bins.tobytes()


def packing_of(bins: np.ndarray, sizes: np.ndarray) -> Packing:
    _, bins = np.unique(bins, return_inverse=True)
    fill = np.bincount(bins, sizes).astype(np.int64)
    return Packing(bins.astype(np.uint16), len(fill), int((fill * fill).sum()))


def best_fit(bins: np.ndarray, sizes: np.ndarray, items: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """``bins`` with the ``items``, in their order, each put where least space is left behind it.

    Other items keep their places; sequences that hold none of these are not used.
    """
    homeless = np.zeros(len(sizes), dtype=bool)
    homeless[items] = True
    used, kept = np.unique(bins[~homeless], return_inverse=True)
    out = np.empty(len(sizes), np.int64)
    out[~homeless] = kept
    free = longest - np.bincount(kept, sizes[~homeless], minlength=len(used)).astype(np.int64)
    open_by_space: dict[int, list[int]] = {}
    for b, space in enumerate(free.tolist()):
        open_by_space.setdefault(space, []).append(b)
    spaces = sum(1 << s for s in open_by_space)  # bit s: a sequence has space s
    n, found = len(used), []
    for size in sizes[items].tolist():
        enough = spaces >> size
        if enough:
            space = size + (enough & -enough).bit_length() - 1
            with_it = open_by_space[space]
            b = with_it.pop()
            if not with_it:
                spaces ^= 1 << space
        else:
            b, space = n, longest
            n += 1
        found.append(b)
        rest = space - size
        open_by_space.setdefault(rest, []).append(b)
        spaces |= 1 << rest
    out[items] = found
    return out


def random_packing(sizes: np.ndarray, rng: np.random.Generator, longest: int = LONGEST) -> Packing:
    """Best fit of the items in random order."""
    return packing_of(best_fit(np.zeros(len(sizes), np.int64), sizes, rng.permutation(len(sizes)), longest), sizes)


def crossover(into: Packing, giver: Packing, sizes: np.ndarray, rng: np.random.Generator, longest: int = LONGEST) -> Packing:
    """``into`` with some of the fuller sequences of ``giver``.

    Its own sequences that hold an item of those are given up, and so are some of its least filled.
    Items left homeless are packed by best fit, the largest first, half of the time only about so.
    """
    fill = np.bincount(giver.bins, sizes)
    fuller = np.argsort(-fill, kind="stable")[: max(1, giver.n // 2)]
    taken = np.zeros(giver.n, dtype=bool)
    taken[rng.choice(fuller, rng.integers(1, max(2, int(_INJECTED * giver.n) + 1)), replace=True)] = True
    injected = taken[giver.bins]
    given_up = np.zeros(into.n, dtype=bool)
    given_up[into.bins[injected]] = True
    left = np.where(given_up, np.inf, np.bincount(into.bins, sizes))
    n = min(into.n, int(rng.integers(1, max(2, int(_GIVEN_UP * into.n) + 1))))
    given_up[np.argsort(left, kind="stable")[:n]] = True
    homeless = np.flatnonzero(given_up[into.bins] & ~injected)
    shaken = rng.random(len(homeless)) * rng.integers(2) * _SHAKEN
    homeless = homeless[np.argsort(-sizes[homeless] * (1 - shaken), kind="stable")]
    bins = np.where(injected, into.n + giver.bins.astype(np.int64), into.bins)
    return packing_of(best_fit(bins, sizes, homeless, longest), sizes)


def evolve(
    population: list[Packing], sizes: np.ndarray, rng: np.random.Generator, offspring: int = OFFSPRING,
    keep: int = POPULATION, longest: int = LONGEST,
) -> list[Packing]:
    """The fittest of a population and its offspring; ends early when no packing can be better."""
    least = math.ceil(int(sizes.sum()) / longest)
    fittest = sorted(population, key=lambda p: p.merit, reverse=True)[:keep]
    for _ in range(offspring):
        if fittest[0].n <= least or len(fittest) < 2:
            break
        a, b = rng.choice(len(fittest), 2, replace=False)
        child = crossover(fittest[a], fittest[b], sizes, rng, longest)
        if all(child.merit != p.merit for p in fittest):
            fittest = sorted([*fittest, child], key=lambda p: p.merit, reverse=True)[:keep]
    return fittest


def best_fit_pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = LONGEST,
    end: int = END,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers and ``ids_crc32`` is theirs; ``start`` counts
    the document's ids before the piece, ``doc_tokens`` all of them with the end id, ``offset`` the ids
    before it in its sequence. A sequence's id is the number of its longest piece. A null text is
    empty: its document is the end id alone. A null id is kept. Repeated rows are packed each. An
    empty table gives an empty result. Other columns are not read.

    The driver learns the number of items of each level.
    """
    path = vocabulary or tokens.vocabulary_path()
    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (
        f"doc_id {id_type}, piece int, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
        "number long"
    )
    pieces = result(read.mapInArrow(_cutter(longest, end, path), schema), "pieces")
    items = pieces.filter(F.col("length") < longest).select("number", F.col("length").cast("int").alias("length"))
    placed = result(pack_items(items, longest), "placed")
    joined = pieces.join(placed, "number", "left")
    return joined.select(
        *[c for c in pieces.columns if c != "number"],
        F.coalesce("sequence_id", "number").alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )


def _cutter(longest: int, end: int, vocabulary: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33  # numbers of a task's pieces go on from there
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            kind = batch.schema.field(0).type
            for key, data in zip(batch.column(0).to_pylist(), tokens.encoder(vocabulary).documents(batch.column(1), end)):
                total = len(data) // 4
                first = total % longest or longest
                bounds = [0, *range(first, total + 1, longest)]
                for k, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
                    piece = data[4 * low : 4 * high]
                    rows.append((key, k, low, high - low, piece, zlib.crc32(piece), total, number))
                    number += 1
                size += len(data)
                if size >= _BATCH_BYTES:
                    yield _batch(rows, kind)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, kind)

    return cut


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
    names = ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "doc_tokens", "number"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


_MEMBER = "block long, island int, sizes binary, bins binary, n int, squares long"


def pack_items(items: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``number, sequence_id, offset`` of items ``number, length`` no longer than ``longest``."""
    with scratch(items.sparkSession):
        closed, level = [], 0
        while True:
            count = items.count()
            blocks = max(1, math.ceil(count / BLOCK_ITEMS))
            with sized_shuffle(items.sparkSession, blocks * ISLANDS * (POPULATION + 1) * 4 * BLOCK_ITEMS):
                packed = saved(_packed(items, blocks, level, longest), "packed")
            closed.append(packed.filter("closed") if blocks > 1 else packed)
            if blocks == 1:
                placed = reduce(DataFrame.unionAll, closed).select("number", "sequence_id", "offset")
                return result(placed, "placed")
            items, level = packed.filter("not closed").select("number", "length"), level + 1


def _packed(items: DataFrame, blocks: int, level: int, longest: int) -> DataFrame:
    """The best packing of each block, with ``closed`` for all but its least-filled sequences."""
    block = F.pmod(F.xxhash64("number", F.lit(level)), F.lit(blocks))
    dealt = items.withColumn("block", block)
    members = dealt.groupBy("block").applyInArrow(_settled(level, longest), _MEMBER)
    for epoch in range(EPOCHS):
        members = members.groupBy("block", "island").applyInArrow(_epoch(level, epoch, longest), _MEMBER)
    merit = F.struct(-F.col("n"), "squares", "bins")
    best = members.groupBy("block").agg(F.max_by("bins", merit).alias("bins"))
    own = dealt.select(*[F.col(c).alias(c) for c in dealt.columns])  # both sides come from one table
    schema = "number long, length int, sequence_id long, offset long, closed boolean"
    return own.groupBy("block").cogroup(best.groupBy("block")).applyInArrow(_placed(longest), schema)


def _ordered(items: pa.Table) -> pa.Table:
    return items.sort_by([("length", "descending"), ("number", "ascending")])


def _rng(*seed: int) -> np.random.Generator:
    return np.random.default_rng([0xB1F, *seed])


def _members(block: int, sizes: np.ndarray, islands: list[tuple[int, Packing]]) -> pa.Table:
    data = sizes.astype("<u2").tobytes()
    rows = [(block, island, data, p.bins.astype("<u2").tobytes(), p.n, p.squares) for island, p in islands]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]
    names = ["block", "island", "sizes", "bins", "n", "squares"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _settled(level: int, longest: int):
    """The first packings of a block's islands."""

    def run(items: pa.Table) -> pa.Table:
        block, sizes = items.column("block")[0].as_py(), _ordered(items).column("length").to_numpy().astype(np.int64)
        found = []
        for island in range(ISLANDS):
            rng = _rng(level, block, island)
            found += [(island, random_packing(sizes, rng, longest)) for _ in range(POPULATION)]
        return _members(block, sizes, found)

    return run


def _epoch(level: int, epoch: int, longest: int):
    """A population after an epoch; a copy of its best is a member of the next island."""

    def run(members: pa.Table) -> pa.Table:
        block, island = members.column("block")[0].as_py(), members.column("island")[0].as_py()
        sizes = np.frombuffer(members.column("sizes")[0].as_py(), "<u2").astype(np.int64)
        columns = (members.column(c).to_pylist() for c in ("bins", "n", "squares"))
        population = [Packing(np.frombuffer(b, "<u2"), n, s) for b, n, s in zip(*columns)]
        fittest = evolve(population, sizes, _rng(level, block, island, epoch), longest=longest)
        emigrant = [((island + 1) % ISLANDS, fittest[0])]
        return _members(block, sizes, [(island, p) for p in fittest] + emigrant)

    return run


def _placed(longest: int):
    def run(items: pa.Table, best: pa.Table) -> pa.Table:
        items = _ordered(items)
        numbers, sizes = items.column("number").to_numpy(), items.column("length").to_numpy().astype(np.int64)
        bins = np.frombuffer(best.column("bins")[0].as_py(), "<u2").astype(np.int64)
        order = np.argsort(bins, kind="stable")  # within a sequence the longest piece first
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        before = np.cumsum(sizes[order]) - sizes[order]
        fill = np.bincount(bins, sizes)
        closed = np.ones(len(fill), dtype=bool)
        closed[np.argsort(fill, kind="stable")[: len(fill) // _REOPENED]] = False
        at = bins[order]
        return pa.table({
            "number": numbers[order], "length": pa.array(sizes[order], pa.int32()),
            "sequence_id": numbers[order][first][at], "offset": before - before[first][at], "closed": closed[at],
        })

    return run
