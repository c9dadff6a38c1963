from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shopfunnel.llm.spotsigs import ANCHORS, CHAIN, GAP, edited_pairs, near_pairs


def spots(text):
    """Chains of content words, by the definition, with the marks the fingerprint keeps."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content, pending = [], False
    for w in words:
        if w in ANCHORS:
            pending = True
        else:
            content.append(("·" if pending else "") + w)
            pending = False
    since = 0
    for k, w in enumerate(content):
        if w.startswith("·"):
            since = 0
        elif since == GAP:
            content[k], since = "·" + w, 0
            since = 0
            continue
        if not w.startswith("·"):
            since += 1
    if pending and content:
        pass
    return {tuple(content[k : k + CHAIN]) for k, w in enumerate(content) if w.startswith("·")}


def prose(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lm", "nt", "rs")]
    return " ".join(rng.choice(["the", "of", "und", "la"]) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(n))


TEXTS = {9: prose(1, 300), 8: prose(2, 301), 7: None, 6: "", 5: "x", 4: prose(1, 300), 3: "é漢🙂" * 5, 2: "!!! ???", 1: prose(3, 40_000)}


def test_edits_and_order(spark):
    rows = [(k, t, 1, True) for k, t in TEXTS.items()] + [(None, "no id the word", 1, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int, ghost boolean").repartition(4)
    got = {r.doc_id: r for r in edited_pairs(docs).collect()}
    order = [*sorted(TEXTS, reverse=True), None]
    texts = {**TEXTS, None: "no id the word"}
    for k, after in zip(order, order[1:] + order[:1]):
        text, other = texts[k] or "", texts[after] or ""
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        assert got[k].n_chars == len(text)
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), k
        assert 0 <= got[k].near_edited <= 1 and 0 <= got[k].near_next <= 1
        assert (got[k].fingerprint == "") == (text == "")
    assert got[9].fingerprint == got[4].fingerprint != got[8].fingerprint
    assert got[9].near_edited > 0.2 and got[9].near_next < 0.05
    assert len(got[1].fingerprint) % 8 == 0


def test_likeness_is_that_of_the_chains(spark):
    docs = spark.createDataFrame([(k, prose(k // 2, 200) + (" other words" if k % 2 else "")) for k in range(10)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in edited_pairs(docs).collect():
        after = texts[r.doc_id - 1 if r.doc_id else 9]
        a, b = spots(texts[r.doc_id]), spots(after)
        assert r.near_next == pytest.approx(len(a & b) / len(a | b), abs=0.03)


def test_near_pairs_against_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for k in range(120):
        words = prose(k % 15, 60 + 20 * (k % 15)).split()
        for _ in range(rng.choice([0, 1, 2, 6])):
            words[rng.randrange(len(words))] = "changed"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame([*rows, (500, None), (501, "")], "doc_id long, text string")
    pairs, classes = near_pairs(docs, 0.7)
    members: dict = {}
    for r in classes.collect():
        members.setdefault(r.spot_class, []).append(r.doc_id)
    found = {(r.a, r.b) for r in pairs.collect()}
    one = {c: set(m) for c, m in members.items()}
    fingerprints = {r.doc_id: r.fingerprint for r in edited_pairs(docs).collect()}
    sets = {c: {fingerprints[min(m)][i : i + 8] for i in range(0, len(fingerprints[min(m)]), 8)} for c, m in one.items()}
    expected = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b])}
    assert found == expected and sum(map(len, members.values())) == 120


def test_empty_and_single(spark):
    one = spark.createDataFrame([(1, "one of the texts here")], "doc_id long, text string")
    assert edited_pairs(one).first().near_next == 1.0
    assert edited_pairs(one.limit(0).where(F.col("doc_id") > 1)).count() == 0
