from __future__ import annotations

import random
import re
from fractions import Fraction

import pytest

from shopfunnel.llm.ngram_join import _END, _across, _meetings, near_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def brute(rows, n, similarity):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if find(b) == find(a) and rows[b][0] is not None]
        out.append((i, len(sets[a]), (min(ids) if ids else None) if sets[a] else i))
    return sorted(out, key=repr)


def corpus(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    common = " ".join(rng.choices(vocabulary, k=25))
    bases = [rng.choices(vocabulary, k=rng.choice([3, 12, 60, 150])) for _ in range(12)]
    rows = []
    for i in range(count):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], ["New"], ["x", "y"], [rng.choice(vocabulary)]])
            words = words or ["z"]
        rows.append((rng.randrange(10_000), " ".join(words) + (" " + common if rng.random() < 0.3 else "")))
    return rows


CASES = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (5, "other words"), (6, "One two"), (7, "one  two"),
         (None, "one two"), (None, "a b c d e f"), (8, "é É"), (9, "é é"), (10, "w " * 5000), (11, "w " * 700), (11, "w " * 700)]


@pytest.mark.parametrize(("n", "similarity"), [(3, Fraction(9, 10)), (5, Fraction(8, 10)), (2, Fraction(1, 2))])
def test_same_as_the_definition(spark, n, similarity):
    rows = CASES + corpus(n, 260)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, size int")
    got = near_groups(docs, n=n, similarity=similarity).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, n, similarity)


def test_chain_of_links(spark):
    """Ends of a chain are one component though they are unlike."""
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(words[3 * k : 3 * k + 100])) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_groups(docs, n=3, similarity=Fraction(9, 10)).collect()
    assert {r.component_id for r in got} == {0}


def test_empty_table(spark):
    assert near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def heads_of(spark, sets):
    rows = [(node, 100, node, *[0] * (len(_END) - 3), 0, gram) for node, grams in sets.items() for gram in grams]
    return spark.createDataFrame(rows, ", ".join(f"{c} long" for c in (*_END, "band", "gram")))


def test_nodes_that_share_many_grams_meet_once(spark):
    alike = heads_of(spark, {node: range(300) for node in range(12)})
    assert _meetings(alike, Fraction(8, 10)).count() == 66
    rng = random.Random(5)
    sets = {node: rng.sample(range(300), 200) for node in range(12)}
    assert _meetings(heads_of(spark, sets), Fraction(8, 10)).count() < 100


def test_nodes_meet_wherever_they_share_a_gram(spark):
    rng = random.Random(6)
    sets = {node: rng.sample(range(400), rng.choice([1, 5, 20, 60])) for node in range(40)}
    pairs = {(a, b) for a in sets for b in sets if a < b and {*sets[a]} & {*sets[b]}}
    assert 200 < len(pairs) < 780
    found = _across(heads_of(spark, sets), Fraction(8, 10)).collect()
    assert len(found) == len(pairs) and {(r.a, r.b) for r in found} == pairs
