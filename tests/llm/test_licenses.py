from __future__ import annotations

import random
import re

from shopfunnel.llm.licenses import CONTAINED, RUN, SHINGLE, TEMPLATES, scan_licenses


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w):
    return {tuple(w[k : k + SHINGLE]) for k in range(len(w) - SHINGLE + 1)}


def brute(rows):
    """Every stretch of a document as long as a notice with some slack."""
    found = set()
    for i, text in rows:
        w = words(text)
        for name, notice in TEMPLATES:
            n = words(notice)
            span = 2 * len(n) + 8
            if any(
                len(shingles(w[s : s + span]) & shingles(n)) >= CONTAINED * len(shingles(n))
                for s in range(max(1, len(w) - 2))
            ):
                found.add((i, name))
    return found


def runs(w):
    return {tuple(w[k : k + RUN]) for k in range(len(w) - RUN + 1)}


def brute_apart(rows):
    """As above, but a stretch must hold a run that each other license's like notice lacks."""
    found = set()
    for name, notice in TEMPLATES:
        n = words(notice)
        others = [words(t) for other, t in TEMPLATES if other != name]
        like = [o for o in others if len(shingles(o) & shingles(n)) >= CONTAINED * len(shingles(n))]
        telling = [own for own in (runs(n) - runs(o) for o in like) if own]
        for i, text in rows:
            w = words(text)
            stretches = (w[s : s + 2 * len(n) + 8] for s in range(max(1, len(w) - 2)))
            if any(len(shingles(x) & shingles(n)) >= CONTAINED * len(shingles(n)) and all(own & runs(x) for own in telling) for x in stretches):
                found.add((i, name))
    return found


def test_all_notices_at_all_places(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(200)] + ["the", "license", "under", "public"]
    rows = []
    for name, notice in TEMPLATES:
        for at in (0, 1, 2, 3, 17, 50):
            body = rng.choices(vocabulary, k=50)
            rows.append((len(rows), " ".join(body[:at]) + "\n" + rng.choice([notice, notice.upper(), notice.replace(",", " ")]) + "\n" + " ".join(body[at:])))
    rows += [(900, None), (901, ""), (902, "MIT"), (903, "released under"), (904, "plain text " * 30_000), (905, "licensed under the license of the public")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows] + [(0, rows[0][1], 2, "y")], "doc_id long, text string, start int, license string")
    got = scan_licenses(docs).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert len(found) == len(got) and found == brute(rows)
    assert all(CONTAINED <= r.containment <= 1 for r in got)
    apart = [(r.doc_id, r.license) for r in scan_licenses(docs, apart=True).collect()]
    assert len(set(apart)) == len(apart) and set(apart) == brute_apart(rows) != found


def test_changed_notices_are_found_by_containment(spark):
    long = next(t for n, t in TEMPLATES if n == "BSD")
    edited = long.replace("following", "next")
    docs = spark.createDataFrame([(1, edited), (2, " ".join(long.split()[:9])), (None, long)], "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in scan_licenses(docs).collect()} == {(1, "BSD"), (None, "BSD")}


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_versions_and_variants_are_told_apart(spark):
    """Each whole notice gives its own license only, alone or beside another that has its version."""
    fill = " ".join(f"w{k}" for k in range(40))
    rows = [(k, f"{fill} {notice} {fill}", name) for k, (name, notice) in enumerate(TEMPLATES)]
    text = dict(TEMPLATES)
    rows.append((100, f"{TEMPLATES[0][1]} {text['GPL-3.0']}", "Apache-2.0 GPL-3.0"))
    rows.append((101, f"{text['GPL-2.0']} {text['GPL-3.0']}", "GPL-2.0 GPL-3.0"))
    rows.append((102, f"{text['GPL-2.0'].replace('This', 'That')} {text['GPL-3.0']}", "GPL-2.0 GPL-3.0"))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {(r.doc_id, r.license) for r in scan_licenses(docs, apart=True).collect()}
    assert found == {(k, name) for k, _, names in rows for name in names.split()}
