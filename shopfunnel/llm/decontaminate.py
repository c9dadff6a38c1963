"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into overlapping passages, described by TF-IDF over hashed
words. A randomised SVD over all distinct passages gives a latent space, scaled so that each of
its directions varies alike; passages whose cosine to one of an item's is high are candidates. A
candidate counts as a leak if the longest common subsequence of the item's words and those around
the passage covers most of the item, or, for a paraphrase, a good part of it and nearly all its
answer, which is the item's last sentence.

Every passage of every document is looked up. Items are a stated query set: they go to the tasks
in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.llm.common import only, saved, scratch
from shopfunnel.llm.words import Words, mix, text_chunks

#: Words of a passage are two strides; item passages begin at every ``ITEM_STRIDE`` words.
STRIDE, ITEM_STRIDE = 12, 4
#: Power of the inverse document frequency that weighs a word: rare words tell passages apart.
RARITY = 4
#: Hashed words as a power of two, latent dimensions, and directions drawn beyond them.
FEATURE_BITS, DIMENSIONS, EXTRA = 15, 64, 8
#: Columns of a passage's features.
_PACKED = [f"words{k}" for k in range(STRIDE // 4)]
#: Distinct passages of a :func:`fit_sample`, about. The queries fit on all.
FIT_PASSAGES = 120_000
#: One in so many passages, by hash, is looked at to tell how many are distinct.
_COUNTED = 1024
#: Least logarithm in a word's weight: passages of words that all passages have keep a direction.
LEAST_IDF = 0.1
#: Least latent cosine of a candidate.
LEAST_COSINE = 0.3
#: Shares of an item's words in the common subsequence: alone, with the answer, and of the answer.
WHOLE, PART, ANSWER = 0.8, 0.65, 0.9
#: Items with fewer words must occur word by word.
SHORT = 8
#: Items looked up in one pass over the documents.
ITEM_BLOCK = 5_000
#: Bytes of text cut into words at once: their working arrays stay in the cache.
_CHUNK_BYTES = 1 << 18
#: Rows of the score matrix computed at once, at most this many numbers.
_SCORES = 250_000

#: Candidates whose words are counted at once.
_CANDIDATES = 8_000
#: Segments whose words' vectors are held at once.
_SEGMENTS = 500
#: Words of an item whose places fit a machine word; longer ones are confirmed one at a time.
_PLACES = 64
#: Passages of a batch from which on a feature's are summed by themselves.
_OFTEN = 24
#: Items whose words are counted side by side, and the words of a text counted at once.
_GROUP, _RUN = 256, 4_096

_FEATURES = 1 << FEATURE_BITS
_SLICES = 64


def _feature(words: Words) -> np.ndarray:
    return (words.hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _segments(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each run of ``STRIDE`` words, its text, and whether another follows in it."""
    lengths = np.diff(words.bounds)
    counts = -(-lengths // STRIDE)
    text = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    follows = np.zeros(len(text), dtype=bool)
    follows[:-1] = text[1:] == text[:-1]
    return words.bounds[:-1][text] + STRIDE * number, text, follows


def _passages(sums: np.ndarray, text: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors from those of segments, and the segment each begins with.

    The last segment of a text is part of the passage before it, or a passage if it is the only one.
    """
    first = np.ones(len(text), dtype=bool)
    first[1:] = text[1:] != text[:-1]
    at = np.flatnonzero(follows | first)
    both = sums[at].copy()
    more = follows[at]
    both[more] += sums[at[more] + 1]
    return both, at


def _segment_sums(words: Words, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``table`` over each segment's words; its last row, of zeros, is that of no word."""
    feature, sizes = _feature(words), np.diff(np.append(starts, len(words.hashes)))
    places = np.full((STRIDE, len(starts)), len(table) - 1)
    for place in range(STRIDE):
        more = np.flatnonzero(sizes > place)
        places[place, more] = feature[starts[more] + place]
    return _row_sums(places, table)


def _add_by_feature(out: np.ndarray, features: np.ndarray, rows: np.ndarray) -> None:
    """Add each passage's row to those of its features in ``out``.

    Features met often are summed one by one, the others side by side, their k-th passages at once.
    """
    order = np.argsort(features.astype(np.uint16), axis=None, kind="stable")
    owner, feature = order // features.shape[1], features.ravel()[order]
    low = np.flatnonzero(np.diff(feature, prepend=-1))
    n = np.diff(np.append(low, len(feature)))
    often = n > _OFTEN
    for a, count in zip(low[often], n[often]):
        out[feature[a]] += rows.take(owner[a : a + count], axis=0).sum(axis=0)
    low, n = low[~often], n[~often]
    by_count = np.argsort(-n, kind="stable")
    low, n = low[by_count], n[by_count]
    sums = rows.take(owner[low], axis=0)
    for k in range(1, n.max(initial=0)):
        more = np.searchsorted(-n, -k)
        sums[:more] += rows.take(owner[low[:more] + k], axis=0)
    out[feature[low]] += sums


def _idf(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Weights of the hashed words by how rare they are in all passages, and how many there are."""
    return _rarity(passages(texts))


def _rarity(rows: DataFrame) -> tuple[np.ndarray, int]:
    """:func:`_idf` of ``rows``, those of :func:`passages`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(_FEATURES + 1), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            row = np.sort(_packed(batch), axis=1)
            new = np.diff(row, axis=1, prepend=0) > 0
            found += np.bincount(row[new], np.repeat(n, new.sum(axis=1)), minlength=len(found))
            total += int(n.sum())
        at = np.flatnonzero(found)
        columns = [pa.array(np.append(at - 1, -1)), pa.array(np.append(found[at], total).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "n"])

    counts = rows.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = counts["feature"].to_numpy(), counts["n"].to_numpy()
    total = int(n[feature < 0].sum())
    frequency = np.zeros(_FEATURES)
    frequency[feature[feature >= 0]] = n[feature >= 0]
    idf = np.log(np.maximum((total + 1) / (frequency + 1), 1))
    return (np.maximum(idf, LEAST_IDF) ** RARITY).astype(np.float32), total


def passages(texts: DataFrame) -> DataFrame:
    """Distinct passages of all texts, each once with the number ``n`` of its occurrences.

    The features of its words, from 1 on, stand in ``_PACKED``, four to a number; 0 is no word.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in batches:
            for _, _, words in text_chunks(batch.column(0), lower=True, plain=True, limit=_CHUNK_BYTES):
                starts, _, _ = _segments(words)
                sizes = np.diff(np.append(starts, len(words.hashes)))
                row = np.repeat(np.arange(len(starts)), sizes)
                features = np.zeros((len(starts), STRIDE), np.uint16)
                features[row, np.arange(len(row)) - starts[row]] = _feature(words) + 1
                packed = features.view(np.int64)
                columns = [_segment_hashes(words, starts).view(np.int64), *np.ascontiguousarray(packed.T)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", *_PACKED])

    schema = ", ".join(f"{c} long" for c in ["hash", *_PACKED])
    return texts.mapInArrow(cut, schema).groupBy("hash", *_PACKED).agg(F.count(F.lit(1)).alias("n")).drop("hash")


def _unpacked(batch: pa.RecordBatch) -> np.ndarray:
    """Features of each passage's words, from 1 on, and 0 where it has no more."""
    return _packed(batch).astype(np.int64)


def _packed(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in _PACKED], axis=1).view(np.uint16)


def _feature_sums(features: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``table`` over each passage's features."""
    return _row_sums(np.ascontiguousarray(features.T), table)


def _row_sums(places: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``table`` at each column of ``places``, few at a time, which stay in the cache."""
    out = np.empty((places.shape[1], table.shape[1]), table.dtype)
    held = np.empty((_SEGMENTS, table.shape[1]), table.dtype)
    for low in range(0, len(out), _SEGMENTS):
        sums, some = out[low : low + _SEGMENTS], places[:, low : low + _SEGMENTS]
        rows = held[: len(sums)]
        np.take(table, some[0], axis=0, out=sums, mode="clip")  # "raise" would copy the rows once more
        for each in some[1:]:
            np.take(table, each, axis=0, out=rows, mode="clip")
            sums += rows
    return out


def _segment_hashes(words: Words, starts: np.ndarray) -> np.ndarray:
    """A hash of the words of each segment in their order."""
    lengths = np.diff(np.append(starts, len(words.hashes)))
    place = np.arange(len(words.hashes)) - np.repeat(starts, lengths)
    each = mix(words.hashes + mix(place.astype(np.uint64) + np.uint64(1)))
    return mix(np.add.reduceat(each, starts)) if len(starts) else np.empty(0, np.uint64)


def fit_sample(texts: DataFrame) -> DataFrame:
    """``text`` of distinct passages, about ``FIT_PASSAGES`` or all if they are fewer.

    Passages are drawn by hash, so that each counts once however often it occurs and whatever text
    it is in. The share comes from the number of distinct ones, told by those of one residue. A
    caller may give it to :func:`latent_space`; :func:`find_leaks` fits on all passages.
    """

    def drawn(every: int, spelled: bool):
        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, _, words in text_chunks(batch.column(0), lower=True, plain=True):
                    starts, _, _ = _segments(words)
                    hashes = _segment_hashes(words, starts)
                    mine = np.flatnonzero(hashes % np.uint64(every) == 0)
                    keys, first = np.unique(hashes[mine], return_index=True)
                    at, raw = mine[first], words.data.tobytes() if spelled else b""
                    last = np.append(starts, len(words.hashes))[at + 1] - 1
                    spans = zip(words.starts[starts[at]].tolist(), words.ends[last].tolist())
                    spelling = [raw[a:b].decode(errors="replace") for a, b in spans]
                    columns = [pa.array(keys.view(np.int64)), pa.array(spelling, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["hash", "text"])

        return texts.mapInArrow(draw, "hash long, text string")

    distinct = _COUNTED * drawn(_COUNTED, False).select("hash").distinct().count()
    every = max(1, distinct // FIT_PASSAGES)
    return drawn(every, True).groupBy("hash").agg(F.min("text").alias("text")).select("text")


def latent_space(texts: DataFrame, fitted: DataFrame | None = None) -> np.ndarray:
    """Latent coordinates of each hashed word, weighted by IDF: a passage's are the sum over its words.

    Randomised SVD of the passages' TF-IDF matrix A in two distributed products: ``A'(A R)`` for a
    random R spans the space, and the small ``(A Q)'(A Q)`` in it gives directions and lengths. A has
    a row for each distinct passage of ``texts``, or of the ``fitted`` texts, such as a
    :func:`fit_sample`, if a caller gives them. Passages too few to tell so many directions are
    projected on random ones.
    """
    found = saved(passages(texts), "passages")
    idf, _ = _rarity(found)
    if fitted is not None:
        found = saved(passages(fitted), "fitted-passages")
    width = DIMENSIONS + EXTRA
    drawn = np.random.default_rng(11).standard_normal((_FEATURES, width)).astype(np.float32)
    if found.count() < 4 * width:
        return drawn * idf[:, None]

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        table, out = _after_none(drawn * idf[:, None]), np.zeros((_FEATURES + 1, width), np.float32)
        for batch in batches:
            features = _unpacked(batch)
            y = _feature_sums(features, table)
            _add_by_feature(out, features, y)
        out = out[1:] * idf[:, None]
        pieces = [p.tobytes() for p in np.split(out, _SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int64()), pa.array(pieces)], ["slice", "part"])

    parts = found.mapInArrow(span, "slice long, part binary").groupBy("slice").applyInArrow(_added, "slice long, part binary")
    spanned = np.concatenate([np.frombuffer(p, np.float32) for p in parts.toArrow().sort_by("slice")["part"].to_pylist()])
    basis, _ = np.linalg.qr(spanned.reshape(_FEATURES, width).astype(np.float64))
    weighted = (basis * idf[:, None]).astype(np.float32)
    held = texts.sparkSession.sparkContext.broadcast(_after_none(weighted))

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((width, width))
        for batch in batches:
            z = _feature_sums(_unpacked(batch), held.value)
            out += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([out.astype(np.float32).tobytes()])], ["slice", "part"])

    small = found.mapInArrow(inner, "slice long, part binary").toArrow()["part"].to_pylist()
    gram = sum((np.frombuffer(p, np.float32).reshape(width, width) for p in small), np.zeros((width, width)))
    squares, turn = np.linalg.eigh(gram)
    best = np.argsort(squares)[::-1][1 : DIMENSIONS + 1]  # the first is what all passages share
    lengths = np.sqrt(np.maximum(squares[best], 1e-6 * max(squares.max(), 1e-12)))
    return (weighted @ (turn[:, best] / lengths)).astype(np.float32)


def _after_none(table: np.ndarray) -> np.ndarray:
    """``table`` with a first row of zeros, for features that begin at 1."""
    return np.concatenate([np.zeros((1, table.shape[1]), table.dtype), table])


def _added(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(p, np.float32) for p in parts["part"].to_pylist()], axis=0, dtype=np.float64)
    return pa.table({"slice": pa.array([key[0].as_py()]), "part": pa.array([total.astype(np.float32).tobytes()])})


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _lcs(pattern: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``pattern`` has the places of each word as bits."""
    state = full = (1 << size) - 1
    for word in words:
        hit = pattern.get(word)
        if hit is not None:
            met = state & hit
            state = ((state + met) | (state - met)) & full
    return size - state.bit_count()


class _Item:
    """A benchmark text's words, and where its answer begins."""

    def __init__(self, key: object, text: str | None) -> None:
        self.key = key
        self.words = [int(h) for h in _hashes(text)]
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", (text or "").strip()) if len(_hashes(s)) > 0]
        answer = len(_hashes(sentences[-1])) if len(sentences) > 1 else 0
        self.answer = answer if answer >= 3 else -(-len(self.words) // 4)
        self.pattern, self.answer_pattern = self._bits(self.words), self._bits(self.words[-self.answer :])

    @staticmethod
    def _bits(words: list[int]) -> dict[int, int]:
        places: dict[int, int] = {}
        for k, w in enumerate(words):
            places[w] = places.get(w, 0) | 1 << k
        return places

    def leak(self, around: list[int]) -> tuple[float, float] | None:
        """Shares of the item and of its answer found ``around`` a passage, if it is a leak."""
        size = len(self.words)
        if size < SHORT:
            found = any(around[k : k + size] == self.words for k in range(len(around) - size + 1))
            return (1.0, 1.0) if found else None
        if sum(map(self.pattern.__contains__, around)) < PART * size:
            return None  # the common subsequence can't be longer than that
        whole = _lcs(self.pattern, size, around) / size
        if whole < PART:
            return None
        answer = _lcs(self.answer_pattern, self.answer, around) / self.answer
        return (whole, answer) if whole >= WHOLE or answer >= ANSWER else None


def _hashes(text: str | None) -> np.ndarray:
    return np.concatenate([w.hashes for *_, w in text_chunks(pa.array([text or ""]), lower=True, plain=True)])


def _queries(items: list[_Item], latent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the items' passages and the item each belongs to."""
    vectors, owners = [], []
    for number, item in enumerate(items):
        feature = (np.array(item.words, np.uint64) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        for start in range(0, max(1, len(feature) - 2 * STRIDE + ITEM_STRIDE), ITEM_STRIDE):
            vectors.append(latent[feature[start : start + 2 * STRIDE]].sum(axis=0))
            owners.append(number)
    return _unit(np.array(vectors, np.float32).reshape(-1, latent.shape[1])), np.array(owners, np.int64)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    latent: np.ndarray | None = None,
) -> DataFrame:
    """``doc_id, item_id, item_share, answer_share`` of each document and item leaked into it.

    Words are runs of ASCII letters and digits and of other characters beyond ASCII, lower-cased
    A-Z. Null, empty and blank texts and items match nothing. Null ids are carried as they are.
    Repeated rows give one row per distinct id. An empty table on either side gives an empty
    result. Other columns are not read.
    """
    spark = docs.sparkSession
    id_type, item_type = (d.schema[c].dataType for d, c in ((docs, id_col), (benchmark, item_col)))
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("item_id", item_type),
        T.StructField("item_share", T.DoubleType()), T.StructField("answer_share", T.DoubleType()),
    ])
    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))):
        if latent is None:
            with scratch(spark):
                latent = latent_space(texts)
        held = spark.sparkContext.broadcast((latent, items, _Shared(items), *_queries(items, latent)))

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            only()
            for batch in batches:
                rows = list(_search(batch, *held.value))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), _arrow_types(batch, item_type))] if rows else []
                if rows:
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "item_share", "answer_share"])

        out = out.unionByName(read.mapInArrow(search, schema))
    best = out.groupBy("doc_id", "item_id").agg(F.max("item_share").alias("item_share"), F.max("answer_share").alias("answer_share"))
    return best


def _arrow_types(batch: pa.RecordBatch, item_type: T.DataType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [batch.schema.field("id").type, to_arrow_type(item_type), pa.float64(), pa.float64()]


def _blocks(benchmark: DataFrame) -> Iterator[list[_Item]]:
    """Items that have words, a bounded number at a time."""
    block: list[_Item] = []
    for row in benchmark.filter("text is not null").toLocalIterator():
        item = _Item(row["id"], row["text"])
        if item.words:
            block.append(item)
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


class _Shared:
    """The items' words: which of them each item has, and at which of its places, a bit each.

    Memory follows the words of the items, whatever the size of the documents.
    """

    def __init__(self, items: list[_Item]) -> None:
        self.sizes = np.array([len(item.words) for item in items])
        self.answers = np.array([item.answer for item in items])
        self.words = np.unique(np.array([w for item in items for w in item.words], np.uint64))
        self.word_shift = np.uint64(64 - max(12, (16 * len(self.words)).bit_length()))
        self.word_cells = np.zeros(1 << (64 - int(self.word_shift)), bool)
        self.word_cells[self.words >> self.word_shift] = True
        #: Items whose places fit a machine word and which need not occur word by word.
        self.fits = (self.sizes <= _PLACES) & (self.sizes >= SHORT)
        keys, places, answer_places = [], [], []
        for number, item in enumerate(items):
            own = np.unique(np.array(item.words, np.uint64))
            keys.append(number * len(self.words) + np.searchsorted(self.words, own))
            bits = own.tolist() if self.fits[number] else []
            places.append(np.array([item.pattern[w] for w in bits] or [0] * len(own), np.uint64))
            answer_places.append(np.array([item.answer_pattern.get(w, 0) for w in bits] or [0] * len(own), np.uint64))
        self.keys = np.concatenate(keys)  # ascending, as items and their words are
        self.places, self.answer_places = np.concatenate(places), np.concatenate(answer_places)
        self.shift = np.uint64(64 - max(12, (64 * len(self.keys)).bit_length()))
        self.marked = np.zeros(1 << (64 - int(self.shift)), bool)
        self.marked[self._cell(self.keys)] = True
        self.groups = [self._group(items[at : at + _GROUP]) for at in range(0, len(items), _GROUP)]

    def _group(self, items: list[_Item]) -> tuple[np.ndarray, np.ndarray]:
        """Of all words the place among those of some items, or -1, and per word of theirs a bit for each item that has it."""
        words = np.unique(np.array([w for item in items for w in item.words], np.uint64))
        own = np.full(len(self.words), -1, np.int32)
        own[np.searchsorted(self.words, words)] = np.arange(len(words))
        has = np.zeros((len(words), _GROUP >> 3), np.uint8)
        for number, item in enumerate(items):
            has[np.searchsorted(words, np.unique(np.array(item.words, np.uint64))), number >> 3] |= 128 >> (number & 7)
        return own, has

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many hashes before each place are among ``words``, and the places of those there.

        Most that are not fall to a cell that no word has, and need not be looked for.
        """
        maybe = np.flatnonzero(self.word_cells[(hashes >> self.word_shift).view(np.int64)])
        sought = hashes[maybe]
        at = np.minimum(np.searchsorted(self.words, sought), len(self.words) - 1)
        real = self.words[at] == sought
        before = np.zeros(len(hashes) + 1, np.int64)
        before[maybe[real] + 1] = 1
        return np.cumsum(before, out=before), at[real]

    def few(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Which ranges hold too few words of their item for a leak, if it is one that ``fits``."""
        return self._few(*self.known(hashes), low, high, number)

    def _few(self, before: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> np.ndarray:
        """:meth:`few` by the words :meth:`known`.

        Counts of all items of a group run over these, eight in a machine word. What they spill into
        each other goes when two are subtracted, as no range has 256 words.
        """
        out = np.zeros(len(low), bool)
        part = number // _GROUP + len(self.groups) * (low // _RUN)
        part[~self.fits[number]] = -1
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            k = order[a:b]
            p, g = divmod(int(part[k[0]]), len(self.groups))
            own, has = self.groups[g]
            begin, end = before[p * _RUN], before[high[k].max()]
            place = own[word[begin:end]]
            mine = place >= 0
            upto = np.zeros((int(mine.sum()) + 1, _GROUP >> 3), np.uint64)
            np.cumsum(np.unpackbits(has[place[mine]], axis=1).view("<u8"), axis=0, out=upto[1:])
            met = np.append(0, np.cumsum(mine))
            item = number[k] - g * _GROUP
            first, last = met[before[low[k]] - begin], met[before[high[k]] - begin]
            eight = upto[last, item >> 3] - upto[first, item >> 3]
            count = eight >> (8 * (item & 7)).astype(np.uint64) & np.uint64(255)
            out[k] = count < PART * self.sizes[number[k]]
        return out

    def leaks(
        self, items: list[_Item], hashes: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray
    ) -> Iterator[tuple[int, float, float]]:
        """The ranges of words that hold a leak of their item, with the shares found.

        A range with too few of its item's words can't; a table of marks that holds every item's
        words, and a few more by chance, tells most of those apart before the words are looked up.
        """
        before, word = self.known(hashes)
        begin = before[low]
        n = before[high] - begin
        least = PART * self.sizes[number]
        some = np.flatnonzero(n >= least)
        some = some[~self._few(before, word, low[some], high[some], number[some])]
        for first in range(0, len(some), _CANDIDATES):
            k = some[first : first + _CANDIDATES]
            ends = np.cumsum(n[k])
            key = word[np.arange(ends[-1]) + np.repeat(begin[k] - ends + n[k], n[k])]
            key += np.repeat(number[k] * len(self.words), n[k])
            maybe = self.marked[self._cell(key)]
            total = np.append(0, np.cumsum(maybe))
            count = total[ends] - total[ends - n[k]]
            enough = count >= least[k]
            key = key[maybe & np.repeat(enough, n[k])]
            k, count = k[enough], count[enough]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            real = self.keys[at] == key
            owner = np.repeat(np.arange(len(k)), count)[real]
            yield from self._confirmed(items, hashes, low, high, number, k, owner, at[real])

    def _confirmed(
        self,
        items: list[_Item],
        hashes: np.ndarray,
        low: np.ndarray,
        high: np.ndarray,
        number: np.ndarray,
        k: np.ndarray,
        owner: np.ndarray,
        at: np.ndarray,
    ) -> Iterator[tuple[int, float, float]]:
        """The leaks among ranges ``k``, of which range ``owner`` has the item's words ``at``."""
        count = np.bincount(owner, minlength=len(k))
        enough, fits = count >= PART * self.sizes[number[k]], self.fits[number[k]]
        for one in k[enough & ~fits].tolist():
            shares = items[number[one]].leak(hashes[low[one] : high[one]].tolist())
            if shares:
                yield one, *shares
        take = enough & fits
        at, k, count = at[take[owner]], k[take], count[take]
        size = self.sizes[number[k]]
        whole = _subsequences(self.places[at], count, size) / size
        take = whole >= PART
        at, k, count, whole = at[np.repeat(take, count)], k[take], count[take], whole[take]
        size = self.answers[number[k]]
        answer = _subsequences(self.answer_places[at], count, size) / size
        for i in np.flatnonzero((whole >= WHOLE) | (answer >= ANSWER)).tolist():
            yield int(k[i]), float(whole[i]), float(answer[i])


def _subsequences(places: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``_lcs`` of many runs of words at once, each given by the places of its words in its pattern.

    Run i has the next ``count[i]`` of ``places`` and a pattern of ``size[i]`` words.
    """
    if not len(count):
        return np.empty(0, np.int64)
    steps = np.zeros((count.max(), len(count)), np.uint64)
    step = np.arange(len(places)) - np.repeat(np.cumsum(count) - count, count)
    steps[step, np.repeat(np.arange(len(count)), count)] = places
    state = full = np.uint64(2**64 - 1) >> (_PLACES - size).astype(np.uint64)
    for hit in steps:
        met = state & hit
        state = ((state + met) | (state - met)) & full
    return size - np.bitwise_count(state)


def _search(
    batch: pa.RecordBatch,
    latent: np.ndarray,
    items: list[_Item],
    shared: _Shared,
    queries: np.ndarray,
    owners: np.ndarray,
) -> Iterator[tuple]:
    ids = batch.column("id")
    step = max(1, _SCORES // len(queries))
    latent = np.concatenate([latent, np.zeros((1, latent.shape[1]), latent.dtype)])
    for first, _, words in text_chunks(batch.column("text"), lower=True, plain=True, limit=_CHUNK_BYTES):
        starts, text, follows = _segments(words)
        vectors, at = _passages(_segment_sums(words, starts, latent), text, follows)
        vectors = _unit(vectors)
        found = [np.empty(0, np.int64)]
        for low in range(0, len(vectors), step):
            near = np.flatnonzero(vectors[low : low + step] @ queries.T >= LEAST_COSINE)
            passage, query = np.divmod(near, len(queries))
            met = (low + passage) * len(items) + owners[query]  # ascending, as queries follow their items
            found.append(met[np.diff(met, prepend=-1) > 0])
        passage, number = np.divmod(np.concatenate(found), len(items))
        start, bound, reach = starts[at[passage]], text[at[passage]], shared.sizes[number]
        lows = np.maximum(words.bounds[bound], start - reach)
        highs = np.minimum(words.bounds[bound + 1], start + 2 * STRIDE + reach)
        for k, *shares in shared.leaks(items, words.hashes, lows, highs, number):
            yield ids[first + int(bound[k])].as_py(), items[number[k]].key, *shares
