from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from shopfunnel.llm import decontaminate as D


def corpus(rng, count, length=120):
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 8))) for _ in range(900)]
    common = ["the", "of", "and", "to", "in"]
    return [[rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(length)] for _ in range(count)]


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    docs, items = corpus(rng, 260), corpus(rng, 12, 40)
    texts = [" ".join(d) for d in docs]
    planted = set()
    for k in range(0, 240, 6):
        item = list(items[k % 12])
        if k % 4 == 0:  # a paraphrase: some words changed
            for _ in range(5):
                item[rng.randrange(30)] = "changed"
        at = rng.randrange(60)
        texts[k] = " ".join(docs[k][:at]) + "\n" + " ".join(item).upper() + "! " + " ".join(docs[k][at:])
        planted.add((k, k % 12))
    benchmark = [(k, " ".join(w[:30]).capitalize() + ". " + " ".join(w[30:]) + ".") for k, w in enumerate(items)]
    return texts, benchmark, planted


def test_planted_passages_are_found(spark, case):
    texts, benchmark, planted = case
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(900, None, 1), (901, "", 1), (3, texts[3], 1)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([*benchmark, (70, None), (71, " "), (72, "...")], "item_id long, text string")
    got = D.find_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == planted


def brute(texts, benchmark):
    """Items whose words, as a subsequence of any stretch twice their length, cover most of them."""
    found = set()
    for key, text in benchmark:
        item = D._Item(key, text)
        for k, t in enumerate(texts):
            words = D._hashes(t).tolist()
            step = max(1, len(item.words) // 2)
            if any(item.leak(words[s : s + 2 * len(item.words)]) for s in range(0, max(1, len(words) - step), step)):
                found.add((k, key))
    return found


def test_recall_against_brute_force(spark, case):
    texts, benchmark, _ = case
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(benchmark, "item_id long, text string")
    expected = brute(texts, benchmark)
    found = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()}
    assert len(found & expected) >= 0.9 * len(expected)


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.choices(range(6), k=rng.randrange(1, 80)), rng.choices(range(6), k=rng.randrange(90))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert D._lcs(D._Item._bits(a), len(a), b) == table[-1, -1]


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.find_leaks(none, items).count() == 0
    assert D.find_leaks(some, items.limit(0)).count() == 0
    assert D.find_leaks(some, items.filter("item_id > 1")).count() == 0


def test_fit_sample_counts_copies_once_and_is_never_empty(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(w) for w in corpus(rng, 30, 240)]
    docs = spark.createDataFrame([(t,) for t in texts + texts[:1] * 400], "text string")
    monkeypatch.setattr(D, "_COUNTED", 4)
    distinct = {" ".join(t.split()[k : k + D.STRIDE]) for t in texts for k in range(0, 240, D.STRIDE)}
    assert {r.text for r in D.fit_sample(docs).collect()} == distinct
    monkeypatch.setattr(D, "FIT_PASSAGES", 100)
    got = [r.text for r in D.fit_sample(docs).collect()]
    assert 50 < len(got) < 200 and len(set(got)) == len(got) and set(got) <= distinct
    one = spark.createDataFrame([(" ".join(sum(corpus(rng, 1, 24_000), [])),)], "text string")
    assert 50 < D.fit_sample(one).count() < 200


@pytest.mark.parametrize("length", [10, 60])
def test_leaks_among_copies_of_one_text(spark, length):
    """A corpus of one text many times over has its leaks, too."""
    text = " ".join(f"word{k}" for k in range(length))
    docs = spark.createDataFrame([(k, text) for k in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(text.split()[:10])), (2, "quite other words that do not occur here at all")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()} == {(k, 1) for k in range(300)}


def test_word_repeated_in_one_text_keeps_its_weight(spark):
    """Passages with a word are counted, not its occurrences."""
    docs = spark.createDataFrame([("rare " * 24,), *[(f"a{k} b{k} c{k}",) for k in range(50)]], "text string")
    weights, total = D._idf(docs)
    feature = int(D._hashes("rare")[0] >> np.uint64(64 - D.FEATURE_BITS))
    assert total == 52 and weights[feature] == pytest.approx(np.log(53 / 3) ** D.RARITY, rel=1e-4)


def test_counts_and_subsequences_are_those_of_the_plain_way():
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(words, k=n)) for n in (3, 7, 8, 20, 63, 64, 65, 150) for _ in range(50)]
    items = [D._Item(k, t) for k, t in enumerate(texts)]
    shared, parts = D._Shared(items), []
    for item in items * 2:  # stretches near the threshold, in items of all groups
        own = [w for w in item.words if rng.random() < rng.choice((0.6, 0.7, 0.95, 1))]
        for _ in range(rng.randrange(4)):
            own.insert(rng.randrange(len(own) + 1), rng.getrandbits(64))
        parts.append(own)
    hashes = np.array([w for part in parts for w in part], np.uint64)
    ends = np.cumsum([len(p) for p in parts])
    low, number = ends - [len(p) for p in parts], np.arange(len(parts)) % len(items)
    got = {k: shares for k, *shares in shared.leaks(items, hashes, low, ends, number)}
    expected = {k: list(found) for k, part in enumerate(parts) if (found := items[number[k]].leak(part))}
    assert got == expected and 50 < len(got) < len(parts) - 50
    few = shared.few(hashes, low, ends, number)
    for k, part in enumerate(parts):
        item = items[number[k]]
        assert few[k] == (shared.fits[number[k]] and sum(w in item.pattern for w in part) < D.PART * len(item.words))


def test_latent_space_is_fitted_on_all_passages(spark, monkeypatch):
    """Passages beyond any sample's size count, each distinct one once."""
    rng = random.Random(12)
    texts = [" ".join(w) for w in corpus(rng, 200, 125)]
    docs = spark.createDataFrame([(t,) for t in texts + texts[:2] * 3], "text string").repartition(3)
    cut = [(words[k : k + D.STRIDE]) for t in texts + texts[:2] * 3 for words in [t.split()] for k in range(0, 125, D.STRIDE)]
    count: dict = {}
    for p in map(tuple, cut):
        count[p] = count.get(p, 0) + 1
    rows = D.passages(docs).collect()
    feature = lambda w: int(D._hashes(w)[0] >> np.uint64(64 - D.FEATURE_BITS)) + 1
    packed = lambda r: tuple(np.array([r[c] for c in D._PACKED]).view(np.uint16).tolist())
    expected = {tuple(map(feature, p)) + (0,) * (D.STRIDE - len(p)): n for p, n in count.items()}
    assert {packed(r): r.n for r in rows} == expected and len(rows) == len(count) > 2000
    whole = D.latent_space(docs)
    monkeypatch.setattr(D, "_COUNTED", 1)
    monkeypatch.setattr(D, "FIT_PASSAGES", 300)  # would leave one passage in seven
    again = D.latent_space(docs)
    assert np.allclose(np.abs(whole), np.abs(again), rtol=0.05, atol=1e-3 * np.abs(whole).max())
    sampled = D.latent_space(docs, D.fit_sample(docs))
    assert not np.allclose(np.abs(whole), np.abs(sampled), rtol=0.05, atol=1e-3 * np.abs(whole).max())


def test_sums_by_feature():
    rng = np.random.default_rng(3)
    for n in (0, 1, 700):
        features, rows = np.minimum(rng.zipf(1.3, (n, D.STRIDE)), 500), rng.standard_normal((n, 5)).astype(np.float32)
        got, expected = np.zeros((501, 5), np.float32), np.zeros((501, 5), np.float32)
        D._add_by_feature(got, features, rows)
        np.add.at(expected, features.ravel(), np.repeat(rows, D.STRIDE, axis=0))
        assert np.allclose(got, expected, atol=1e-3)


def test_the_pipelines_stage_fits_on_all_passages(spark, case, tmp_path, monkeypatch):
    from shopfunnel.llm import stages

    def no_sample(texts):
        raise AssertionError("fitted on a sample")

    monkeypatch.setattr(D, "fit_sample", no_sample)
    texts, benchmark, planted = case
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in stages.drop_leaks(spark, docs, str(tmp_path)).collect()}
    assert kept == set(range(len(texts))) - {k for k, _ in planted}


def test_words_are_looked_up_once_for_all_groups_of_items(monkeypatch):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{k}" for k in range(3_000)]
    items = [D._Item(k, " ".join(rng.choice(vocabulary, 40))) for k in range(600)]
    shared = D._Shared(items)
    assert len(shared.groups) == 3
    others = rng.integers(0, 1 << 63, 9_000, dtype=np.uint64)
    parts = [others, *(np.array(items[k].words, np.uint64) for k in (3, 300, 599)), others]
    hashes = np.concatenate(parts)
    before, word = shared.known(hashes)
    real = np.isin(hashes, shared.words)
    assert (before == np.append(0, np.cumsum(real))).all() and (shared.words[word] == hashes[real]).all()
    calls, known = [], shared.known
    monkeypatch.setattr(shared, "known", lambda sought: calls.append(len(sought)) or known(sought))
    number = np.arange(600)
    low, high = np.full(600, 8_980), np.full(600, 9_140)
    found = {int(number[k]): shares for k, *shares in shared.leaks(items, hashes, low, high, number)}
    assert calls == [len(hashes)]
    assert found == {k: [1.0, 1.0] for k in (3, 300, 599)}


def test_segments_are_summed_in_small_blocks(monkeypatch):
    monkeypatch.setattr(D, "_SEGMENTS", 3)
    table = np.random.default_rng(2).integers(-9, 9, (1 << D.FEATURE_BITS, 4)).astype(np.float32)
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (0, 1, 12, 13, 50, 120)]
    for _, _, words in D.text_chunks(pa.array(texts), lower=True, plain=True):
        starts, _, _ = D._segments(words)
        got = D._segment_sums(words, starts, np.concatenate([table, np.zeros((1, 4), np.float32)]))
        ends = np.append(starts, len(words.hashes))[1:]
        assert len(starts) == 19
        for a, b, row in zip(starts, ends, got):
            assert (row == table[D._feature(words)[a:b]].sum(axis=0)).all()
