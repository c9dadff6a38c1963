from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shopfunnel.llm import best_fit as B
from shopfunnel.llm.queries import op11_best_fit_packing
from tests.llm.test_packing import TEXTS, whole

SIZES = st.lists(st.integers(1, 50), min_size=1, max_size=60).map(lambda v: np.array(sorted(v, reverse=True)))


def valid(packing, sizes, longest):
    fill = np.bincount(packing.bins, sizes)
    assert len(packing.bins) == len(sizes) and len(fill) == packing.n
    assert fill.min() > 0 and fill.max() <= longest and packing.squares == (fill * fill).sum()


@settings(max_examples=60, deadline=None)
@given(SIZES, st.integers(0, 99))
def test_offspring_hold_every_item_once(sizes, seed):
    rng = np.random.default_rng(seed)
    a, b = (B.random_packing(sizes, rng, 50) for _ in range(2))
    child = B.crossover(a, b, sizes, rng, 50)
    for packing in (a, b, child):
        valid(packing, sizes, 50)
    best = B.evolve([a, b], sizes, rng, longest=50)
    assert best[0].merit >= max(a.merit, b.merit)


def fewest(sizes, longest):
    """By trying every assignment in canonical order."""
    best = len(sizes)

    def place(k, fill):
        nonlocal best
        if len(fill) >= best:
            return
        if k == len(sizes):
            best = len(fill)
            return
        for j in range(len(fill)):
            if fill[j] + sizes[k] <= longest:
                place(k + 1, [*fill[:j], fill[j] + sizes[k], *fill[j + 1 :]])
        place(k + 1, [*fill, sizes[k]])

    place(0, [])
    return best


def test_small_tables_are_packed_as_well_as_possible():
    rng, excess = np.random.default_rng(6), 0
    for _ in range(25):
        sizes = np.sort(rng.integers(5, 30, 9))[::-1]
        population = [B.random_packing(sizes, rng, 50) for _ in range(B.POPULATION)]
        for _ in range(B.EPOCHS):
            population = B.evolve(population, sizes, rng, longest=50)
        excess += population[0].n - fewest(sizes.tolist(), 50)
    assert excess <= 1


def rows_of(df, expected):
    """Checks every piece against the plain call's ids; returns the number of sequences."""
    rows = df.collect()
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for members in sequences.values():
        members.sort()
        assert [o for o, _ in members] == list(itertools.accumulate([0] + [n for _, n in members[:-1]]))
        assert sum(n for _, n in members) <= 2048
    assert pieces.keys() == expected.keys()
    for key, own in pieces.items():
        copies, ids = expected[key]
        own.sort(key=lambda r: r.piece)
        total = len(ids)
        lengths = [total % 2048 or 2048] + [2048] * (-(-total // 2048) - 1)
        assert [(r.piece, r.length, r.doc_tokens) for r in own] == [(k, n, total) for k, n in enumerate(lengths) for _ in range(copies)]
        for r in own:
            data = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == sum(lengths[: r.piece]) and r.ids_crc32 == zlib.crc32(data)
    return len(sequences)


def test_every_id_lies_in_one_piece(spark, monkeypatch):
    """Over several blocks and levels, with odd rows and clashing names."""
    monkeypatch.setattr(B, "BLOCK_ITEMS", 8)
    rng = np.random.default_rng(1)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(50, None), (50, None), (None, "no id"), (60, "long words here " * 4000)]
    rows += [(100 + k, "a b " * int(rng.integers(1, 900))) for k in range(60)]
    docs = spark.createDataFrame([(k, t, 1, "x", "y") for k, t in rows], "doc_id long, text string, number int, ids string, block string").repartition(3)
    ids = [w + [0] for w in whole([t or "" for _, t in rows])]
    expected = {k: (sum(k == other for other, _ in rows), i) for (k, _), i in zip(rows, ids)}
    n = rows_of(B.best_fit_pack(docs), expected)
    least = math.ceil(sum(map(len, ids)) / 2048)
    assert least <= n <= least + 6  # blocks of 8 items leave much unfilled


def test_empty_table(spark):
    assert B.best_fit_pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_items_that_cannot_share(spark):
    """Nothing fits beside anything: as many sequences as items, over several levels."""
    items = spark.range(0, 9000, 1, 3).selectExpr("id as number", "1025 as length")
    placed = B.pack_items(items).collect()
    assert len({r.sequence_id for r in placed}) == len({r.number for r in placed}) == len(placed) == 9000
    assert {r.offset for r in placed} == {0}


def test_query_packs_a_table_tightly(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ids = [w + [0] for w in whole([r.text or "" for r in docs])]
    n = rows_of(op11_best_fit_packing(spark, sf), {r.doc_id: (1, i) for r, i in zip(docs, ids)})
    assert n <= math.ceil(sum(map(len, ids)) / 2048) + 1
