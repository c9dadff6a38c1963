"""Groups of documents whose sets of word n-grams are alike, by a vertically partitioned join.

All n-grams stand in one global order: the most common of the corpus last, the others by hash.
Every document's set is cut along that order. Of its head, two linked sets share several n-grams,
so it is enough to look up the rarest few of a head; documents with enough n-grams that no other
head holds drop out there. What is looked up gives candidates. The sets are also cut into fragments
at fixed places of the hash range; candidates' overlaps are counted fragment by fragment and summed
per pair. Most candidates are refuted sooner, by the parities of how many n-grams fall to each of
some bits, which differ in no more places than the sets do.

Work doesn't grow with the square of a group. Equal sets are one node. In some rounds, candidates
meet a few nodes of each group only, and what links forms components; only nodes of different
components are then compared with each other. Nothing is lost, since links inside a component
can't change it.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfunnel.llm import sketch
from shopfunnel.llm.common import only, result, saved, scratch
from shopfunnel.llm.graph import components
from shopfunnel.llm.words import grams, mix, text_chunks

#: Words of an n-gram, and the similarity from which documents are near duplicates.
N_WORDS = 5
SIMILARITY = Fraction(8, 10)
#: Pieces the hash range is cut into.
FRAGMENTS = 4
_FRAGMENT_SHIFT = 65 - FRAGMENTS.bit_length()
#: Common n-grams moved to the end of the global order. Only speed depends on them.
COMMON = 100_000
#: Words of 64 parity bits kept of a set.
_PARITY_WORDS = 8
_PARITIES = [f"parity{k}" for k in range(_PARITY_WORDS)]
#: Rounds in which nodes are compared with some nodes of their group only, and how many of these.
STARS, PIVOTS = 2, 8
_END = ("node", "size", "root", *_PARITIES)
#: N-grams a node keeps of those before each of its own, to tell that two nodes have met already.
EARLIER = 8
#: N-grams counted together before those that are common among them are reported.
_COUNT_AT_A_TIME = 2_000_000


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows with the sorted distinct n-gram hashes of each. ``text`` is the column read.

    A text of fewer than ``n`` words has one gram of all of them; one without words has none.
    """
    for batch in batches:
        for first, last, words in text_chunks(batch.column("text"), lower=True):
            whole = grams(words.hashes, n)
            sets = []
            for begin, end in zip(words.bounds[:-1], words.bounds[1:]):
                if end - begin >= n:
                    sets.append(np.unique(whole[begin : end - n + 1]))
                else:
                    sets.append(grams(words.hashes[begin:end], end - begin) if end > begin else whole[:0])
            yield batch.slice(first, last - first), sets


def _common(texts: DataFrame, n: int) -> Broadcast:
    """Hashes of at most ``COMMON`` n-grams that many documents hold, and their places by count.

    Each task reports the n-grams that are frequent among some millions it has seen, with their
    counts, and Spark adds these up.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        held: list[np.ndarray] = []
        size = 0

        def frequent() -> pa.RecordBatch:
            gram, count = np.unique(np.concatenate(held), return_counts=True)
            keep = count >= max(4, size // 400_000)
            columns = [pa.array(gram[keep].view(np.int64)), pa.array(count[keep].astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["gram", "n"])

        for _, sets in _sets(batches, n):
            held += sets
            size += sum(map(len, sets))
            if size >= _COUNT_AT_A_TIME:
                yield frequent()
                held, size = [], 0
        if size:
            yield frequent()

    counts = texts.mapInArrow(report, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    most = counts.orderBy(F.desc("n"), "gram").limit(COMMON).toArrow()
    gram = most["gram"].to_numpy().view(np.uint64)[::-1]
    by_hash = np.argsort(gram)
    return texts.sparkSession.sparkContext.broadcast((gram[by_hash], by_hash))


def _in_order(members: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A sorted set in the global order."""
    gram, place = common
    if not len(gram):
        return members
    at = np.searchsorted(gram, members)
    at[at == len(gram)] = 0
    found = gram[at] == members
    if not found.any():
        return members
    late = members[found][np.argsort(place[at[found]])]
    return np.concatenate([members[~found], late])


def _fragment(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(_FRAGMENT_SHIFT)).astype(np.int32)


def _parities(members: np.ndarray) -> np.ndarray:
    odd = np.bincount((members & np.uint64(64 * _PARITY_WORDS - 1)).astype(np.int64), minlength=64 * _PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    places = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values.view(np.int64)))


def _prefix(size: int, similarity: Fraction) -> int:
    """Members, first in any order, of which linked sets share one."""
    return size - ceil(similarity * size) + 1


def _lookups(size: int, similarity: Fraction) -> tuple[int, int]:
    """Length of the head of a set of ``size``, and how many of it to look up.

    With heads longer than the prefix by k - 1, linked sets share k members of their heads. Here k
    is the prefix again; of a partner, whose size is at least that share of this one's, no less than
    its own. All but one of the shared may be left out at the end of any order of the heads.
    """
    if not size:
        return 0, 0
    head = 2 * _prefix(size, similarity) - 1
    return head, head + 1 - _prefix(ceil(similarity * size), similarity)


def _features(keyed: DataFrame, n: int, similarity: Fraction, id_type: str) -> DataFrame:
    """Per document its ``node`` (hash of the set), ``size``, ``head``, ``lookups`` and parities."""
    common = _common(keyed.select("text"), n)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for rows, sets in _sets(batches, n):
            nodes = mix(np.array([np.sum(mix(s), dtype=np.uint64) + np.uint64(len(s)) for s in sets], np.uint64))
            sizes = [len(s) for s in sets]
            lookups = [_lookups(k, similarity) for k in sizes]
            heads = [_in_order(s, common.value)[:head] for s, (head, _) in zip(sets, lookups)]
            columns = [
                rows.column("id"), rows.column("row"), pa.array(nodes.view(np.int64)),
                pa.array(sizes, pa.int64()), _lists(heads), pa.array([k for _, k in lookups], pa.int64()),
                *(pa.array(c) for c in np.stack([_parities(s) for s in sets]).T),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "row", "node", "size", "head", "lookups", *_PARITIES])

    schema = f"id {id_type}, row long, node long, size long, head array<long>, lookups long, "
    schema += ", ".join(f"{c} long" for c in _PARITIES)
    return keyed.mapInArrow(describe, schema)


def _alike(similarity: Fraction, overlap: str, both: str) -> str:
    """SQL: ``overlap`` of sets with ``both`` members together reaches the similarity."""
    p, q = similarity.numerator, similarity.denominator
    return f"{q} * {overlap} >= {p} * ({both} - {overlap})"


def _may_differ(similarity: Fraction, differing: str, both: str) -> str:
    """SQL: sets with ``both`` members may differ in ``differing`` of them."""
    p, q = similarity.numerator, similarity.denominator
    return f"{q + p} * ({differing}) <= {q - p} * ({both})"


def _links(pairs: DataFrame, nodes: DataFrame, keyed: DataFrame, n: int, similarity: Fraction) -> DataFrame:
    """The pairs ``a, b`` of nodes that reach the similarity."""

    def ends(of: DataFrame, x: str) -> DataFrame:
        return of.select(*(F.col(c).alias(x if c == "node" else f"{c}_{x}") for c in of.columns))

    sizes = nodes.select("node", "size")
    left = saved(pairs.join(ends(sizes, "a"), "a").join(ends(sizes, "b"), "b"), "sized-pairs")
    wanted = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    wanted = saved(nodes.join(wanted, "node", "left_semi").select("node", "row"), "wanted-nodes")
    bits = sketch.marked(wanted.select("row"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in batches:
            keys = batch.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(sketch.holds(keys, bits.value)))
            for rows, sets in _sets(iter([batch]), n):
                pieces = [np.split(s, np.searchsorted(_fragment(s), range(1, FRAGMENTS))) for s in sets]
                keys = np.repeat(rows.column("row").to_numpy(zero_copy_only=False), FRAGMENTS)
                numbers = np.tile(np.arange(FRAGMENTS, dtype=np.int32), len(sets))
                columns = [pa.array(keys), pa.array(numbers), _lists([p for doc in pieces for p in doc])]
                yield pa.RecordBatch.from_arrays(columns, ["row", "fragment", "grams"])

    pieces = keyed.select("row", "text").mapInArrow(cut, "row long, fragment int, grams array<long>")
    pieces = pieces.filter("size(grams) > 0").join(wanted, "row").drop("row")
    pieces = saved(pieces.dropDuplicates(["node", "fragment"]), "fragments")
    partial = left.select("a", "b").join(ends(pieces, "a").withColumnRenamed("fragment_a", "fragment"), "a")
    partial = partial.join(ends(pieces, "b").withColumnRenamed("fragment_b", "fragment"), ["b", "fragment"])
    partial = partial.select("a", "b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("overlap"))
    whole = partial.groupBy("a", "b").agg(F.sum("overlap").alias("overlap")).join(left, ["a", "b"])
    return saved(whole.filter(_alike(similarity, "overlap", "(size_a + size_b)")).select("a", "b"), "links")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N_WORDS,
    similarity: Fraction = SIMILARITY,
) -> DataFrame:
    """``id, row, n_shingles, component_id`` of every row; ``row`` is :func:`row_key`.

    Words are lower-cased A-Z. Documents link if the Jaccard similarity of their sets of n-word
    shingles is at least ``similarity``; ``component_id`` is the least id reachable by links. A text
    of fewer words is one shingle; a null, empty or blank text has none, links with nothing and
    keeps its own id. Rows with a null id link as others do, and name no group unless all of it has
    null ids. Repeated rows are one document. An empty table gives an empty result. Other columns
    of ``docs`` are not read.
    """
    with scratch(docs.sparkSession):
        return result(_near_groups(docs, id_col, text_col, n, similarity), "near-groups")


def _near_groups(docs: DataFrame, id_col: str, text_col: str, n: int, similarity: Fraction) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    features = saved(_features(keyed, n, similarity, id_type), "features")
    nodes = features.filter("size > 0").groupBy("node")
    heads = _heads(nodes.agg(*(F.first(c).alias(c) for c in ("size", "lookups", "head"))), similarity)
    nodes = nodes.agg(
        F.min("id").alias("first"), F.min("row").alias("row"), *(F.first(c).alias(c) for c in ("size", *_PARITIES))
    )
    nodes = saved(nodes, "nodes")
    heads = saved(heads.join(nodes.select("node", *_PARITIES), "node").withColumn("root", F.col("node")), "heads")
    links = None
    for turn in range(STARS + 1):
        pairs = _stars(heads, similarity, turn) if turn < STARS else _across(heads, similarity)
        found = _links(saved(pairs, "pairs"), nodes, keyed, n, similarity)
        links = found if links is None else links.unionByName(found)
        groups = components(links)
        if turn < STARS:
            heads = _undecided(heads, groups)

    named = nodes.select("node", "first").join(groups, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("node", "component_id")
    grouped = features.select("id", "row", "node", "size").join(named, "node", "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id"))
    return grouped.select("id", "row", F.col("size").alias("n_shingles"), component.alias("component_id"))


def row_key(id_col: str, text_col: str) -> Column:
    """Tells documents apart, those of one id too."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _heads(nodes: DataFrame, similarity: Fraction) -> DataFrame:
    """``node, size, band, gram``: the n-grams to look up of each node, if another holds them too.

    Of a head, those that the fewest heads hold come first. A group of one n-gram is cut into bands
    of set sizes; linked sets lie in one band or in neighbouring ones.
    """
    band = F.floor(F.log(F.col("size")) / float(np.log(1.0001 / float(similarity))))
    spare = F.col("lookups") - F.size("head")
    each = nodes.select("node", "size", spare.alias("spare"), F.explode("head").alias("gram"))
    each = each.withColumn("holders", F.count(F.lit(1)).over(Window.partitionBy("gram"))).filter("holders > 1")
    # n-grams that no other head holds come before these and use up lookups
    by_node = Window.partitionBy("node")
    each = each.withColumns({
        "place": F.row_number().over(by_node.orderBy("holders", "gram")), "shared": F.count(F.lit(1)).over(by_node),
    })
    looked_up = each.filter("place <= spare + shared")
    return looked_up.select("node", "size", band.alias("band"), "gram")


def _shared(heads: DataFrame) -> DataFrame:
    """The n-grams that nodes of different components hold."""
    by_gram = Window.partitionBy("gram")
    heads = heads.withColumns({"low": F.min("root").over(by_gram), "high": F.max("root").over(by_gram)})
    return saved(heads.filter("low < high").drop("low", "high"), "heads")


def _undecided(heads: DataFrame, groups: DataFrame) -> DataFrame:
    named = heads.drop("root").join(groups, "node", "left")
    return _shared(named.withColumn("root", F.coalesce("root", "node")))


def _stars(heads: DataFrame, similarity: Fraction, turn: int) -> DataFrame:
    """Pairs of some nodes of each band with all others in it; other nodes in each ``turn``."""
    group = Window.partitionBy("gram", "band")
    places = [F.struct(F.xxhash64("node", F.lit(PIVOTS * turn + k)).alias("order"), *_END) for k in range(PIVOTS)]
    pivoted = heads.select(*_END, F.array_distinct(F.array(*[F.min(p).over(group) for p in places])).alias("pivots"))
    pivoted = pivoted.withColumn("pivot", F.explode("pivots"))
    ends = [F.col(f"{of}{c}").alias(f"{c}_{x}") for x, of in (("a", "pivot."), ("b", "")) for c in _END]
    return _candidates(pivoted.select(*ends), similarity)


def _across(heads: DataFrame, similarity: Fraction) -> DataFrame:
    """All pairs of nodes that share an n-gram and lie in different components."""
    return _pairs(_meetings(heads, similarity))


def _meetings(heads: DataFrame, similarity: Fraction) -> DataFrame:
    """What may link of nodes that share an n-gram, once a pair or little more often.

    Large sets share hundreds. Where two nodes share one of the few n-grams before, they meet
    there; before the least that they share there is none.
    """
    before = Window.partitionBy("node").orderBy("gram").rowsBetween(-EARLIER, -1)
    heads = heads.withColumn("earlier", F.collect_list("gram").over(before))
    near = F.explode(F.array(F.col("band"), F.col("band") - 1))
    end = (*_END, "earlier")
    left = heads.select(*(F.col(c).alias(f"{c}_a") for c in end), "gram", "band")
    right = heads.select(*(F.col(c).alias(f"{c}_b") for c in end), "gram", near.alias("near"), F.col("band").alias("own"))
    right = right.withColumnRenamed("near", "band")
    met = left.join(right, ["gram", "band"]).filter("own > band or node_a < node_b")
    return _possible(met, similarity).filter("not arrays_overlap(earlier_a, earlier_b)")


def _candidates(met: DataFrame, similarity: Fraction) -> DataFrame:
    return _pairs(_possible(met, similarity))


def _possible(met: DataFrame, similarity: Fraction) -> DataFrame:
    unlike = " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in _PARITIES)
    differ = _may_differ(similarity, unlike, "size_a + size_b")
    return met.filter(f"root_a <> root_b and {_reachable(similarity)} and {differ}")


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _reachable(similarity: Fraction) -> str:
    """SQL: the sizes allow a link."""
    p, q = similarity.numerator, similarity.denominator
    return f"{p} * size_a <= {q} * size_b and {p} * size_b <= {q} * size_a"
