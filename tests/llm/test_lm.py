from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest

from shopfunnel.llm import lm


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def prose(seed, count):
    rng = random.Random(seed)
    syllables = ["tion", "er", "an", "the", "ing", "ou", "st", "re"]
    return " ".join("".join(rng.choices(syllables, k=rng.choice([1, 1, 2, 3]))).capitalize() for _ in range(count))


def test_scores_against_the_definition(spark):
    rows = [(k, prose(k % 50, 20 + 3 * k)) for k in range(120)]
    rows += [(200, None), (201, ""), (202, "É " * 9000), (None, "The tion"), (5, rows[5][1])]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_tokens int, word string").repartition(4)
    got = lm.score_texts(docs).collect()
    assert len(got) == len(rows)
    held = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 == 2}
    counts: dict = {}
    for i, t in rows:
        if i not in held:
            for w in [*words(t), None]:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    by_id = dict(rows)
    for r in got:
        tokens = [*words(by_id[r.doc_id]), None]
        assert r.held_out == (r.doc_id in held) and r.train_tokens == total
        assert r.n_tokens == len(tokens) and r.n_known == sum(counts.get(w, 0) > 0 for w in tokens)
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + distinct + 1)) for w in tokens)
        assert r.base_score == pytest.approx(base) and r.score < 0
    long = [r for r in got if r.n_tokens > 50 and r.doc_id != 202 and r.held_out]
    assert long and all(r.score > r.base_score for r in long)


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = lm.Attention(rng.standard_normal((lm.CLASSES + 1, lm.CLASSES)) * 0.1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs, targets = rng.integers(0, lm.CLASSES + 1, (3, lm.WINDOW)), rng.integers(0, lm.CLASSES, (3, lm.WINDOW))
    wanted = rng.random((3, lm.WINDOW)) < 0.7
    loss, slopes = model.slopes(inputs, targets, wanted)
    assert -model.log_probabilities(inputs, targets, wanted).mean() == pytest.approx(loss, rel=1e-4)
    for name, slope in slopes.items():
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        kept = model.weights[name][at]
        sides = []
        for sign in (1, -1):
            model.weights[name][at] = kept + sign * 1e-4
            sides.append(model.slopes(inputs, targets, wanted)[0])
        model.weights[name][at] = kept
        assert (sides[0] - sides[1]) / 2e-4 == pytest.approx(slope[at], rel=0.02), name


def test_probabilities_sum_to_one_and_dont_see_ahead():
    rng = np.random.default_rng(1)
    model = lm.Attention(rng.standard_normal((lm.CLASSES + 1, lm.CLASSES)))
    inputs = np.repeat(rng.integers(0, lm.CLASSES, (1, lm.WINDOW)), lm.CLASSES, axis=0)
    last = np.zeros(inputs.shape, bool)
    last[:, 7] = True
    targets = np.zeros_like(inputs)
    targets[:, 7] = np.arange(lm.CLASSES)
    inputs[:, 8:] = rng.integers(0, lm.CLASSES, inputs[:, 8:].shape)
    assert np.exp(model.log_probabilities(inputs, targets, last)).sum() == pytest.approx(1, rel=1e-4)
    classes = lm.Classes.from_counts(rng.integers(0, 50, 900))
    assert np.exp(classes.share[classes.of == lm.TAIL]).sum() == pytest.approx(1)


@pytest.mark.parametrize("lengths", [[1], [32, 33, 1, 200], [24, 56, 57, 31]])
def test_windows_score_each_position_once(lengths):
    sequences = [np.arange(n) + 1000 * k for k, n in enumerate(lengths)]
    inputs, targets, wanted, owner = lm.windows_of(sequences)
    assert sorted(targets[wanted].tolist()) == sorted(np.concatenate(sequences).tolist())
    first = inputs == lm.START
    assert np.all(inputs[wanted & ~first] == targets[wanted & ~first] - 1)
    assert all(wanted[owner == k].sum() == n for k, n in enumerate(lengths))


def test_learns_context(spark):
    """Every other class repeats the one two before, which pairs can't tell."""
    rng = np.random.default_rng(2)
    seq = [np.tile(rng.integers(0, 40, 2), 40)[: lm.WINDOW] for _ in range(1500)]
    inputs, targets, wanted, _ = lm.windows_of(seq)
    model = lm.Attention(np.zeros((lm.CLASSES + 1, lm.CLASSES)))
    before = model.slopes(inputs[:200], targets[:200], wanted[:200])[0]
    for _ in range(3):
        model.train(inputs[200:], targets[200:], wanted[200:])
    assert model.slopes(inputs[:200], targets[:200], wanted[:200])[0] < 0.75 * before


def test_empty_and_untrained(spark):
    docs = spark.createDataFrame([(k, "some words") for k in range(40)], "doc_id long, text string")
    assert lm.score_texts(docs.limit(0)).count() == 0
    only_held = docs.filter(~lm.in_training())
    got = lm.score_texts(only_held).collect()
    assert got and all(r.n_known == 0 and r.train_tokens == 0 and r.held_out and r.base_score == 0 for r in got)


def test_pairs_and_windows_of_all_documents_count(spark, monkeypatch):
    """More documents than a sample would take: every pair is counted, every window trained on."""
    rows = [(k, prose(k, 3)) for k in range(2_600)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    vocabulary = lm.tokens.vocabulary_path()
    classes = lm.Classes.from_counts(lm.subword_counts(lm.word_counts(docs.select("text")), vocabulary))
    sequences = lm.class_sequences(docs, classes, vocabulary).cache()
    counts, windows = lm.pair_counts(sequences)
    cut = [np.frombuffer(r.classes, np.uint8).astype(np.int64) for r in sequences.collect()]
    inputs, targets, wanted, _ = lm.windows_of(cut)
    expected = np.zeros_like(counts)
    np.add.at(expected, (inputs[wanted], targets[wanted]), 1)
    assert len(cut) == 2_600 and (counts == expected).all() and windows == len(inputs)
    monkeypatch.setattr(lm, "LEAST_WINDOWS", 1)
    monkeypatch.setattr(lm, "TASK_WINDOWS", 700)
    model = lm.Attention(np.zeros((lm.CLASSES + 1, lm.CLASSES)))
    before = model.slopes(inputs, targets, wanted)[0]
    lm.train_attention(sequences, model, windows)
    assert model.slopes(inputs, targets, wanted)[0] < before - 0.1
    model = lm.train_model(docs, lm.word_counts(docs.select("text")), vocabulary)
    share = (expected + 1 / lm.CLASSES) / (expected + 1 / lm.CLASSES).sum(axis=1, keepdims=True)
    assert np.allclose(model.attention.pairs, np.log(share), atol=1e-4)


def test_score_is_the_attention_models(spark):
    """The probability of every subword and of the end, and nothing beside it."""
    texts = [prose(k, 40 + k) for k in range(30)]
    vocabulary = lm.tokens.vocabulary_path()
    rng = np.random.default_rng(3)
    classes = lm.Classes.from_counts(rng.integers(0, 50, lm.tokens.encoder(vocabulary).tokenizer.get_vocab_size()))
    model = lm.Model(classes, lm.Attention(rng.standard_normal((lm.CLASSES + 1, lm.CLASSES))), vocabulary)
    [(_, _, cut)] = lm.text_chunks(lm.pa.array(texts), lower=True)
    got = model.scores(cut)
    for text, score in zip(texts, got):
        [data] = lm.tokens.encoder(vocabulary).encode([" " + " ".join(words(text))])
        inputs, targets, wanted, _ = lm.windows_of([classes.sequence(data)])
        expected = model.attention.log_probabilities(inputs, targets, wanted).sum() + classes.share[np.frombuffer(data, "<u4")].sum()
        assert score == pytest.approx(expected, rel=1e-5)


def test_every_rare_id_has_its_own_probability():
    """Untrained it is its share of the counts; trained, the context tells rare ids apart."""
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 60, 700)
    classes = lm.Classes.from_counts(counts)
    members = lm.Members(counts[classes.of == lm.TAIL])
    n = len(members.embed)
    hidden = rng.standard_normal((n, lm.WIDTH)).astype(np.float32)
    assert np.allclose(members.log_probabilities(hidden, np.arange(n)), classes.share[classes.of == lm.TAIL], atol=1e-4)
    members.tree = rng.standard_normal(members.tree.shape).astype(np.float32)
    one = np.repeat(hidden[:1], n, axis=0)
    assert np.exp(members.log_probabilities(one, np.arange(n))).sum() == pytest.approx(1, rel=1e-4)
    by_hidden, nodes, by_node = members.slopes(hidden[:5], np.arange(5), 1)
    for table, at, slope in ((hidden, (2, 3), by_hidden[2, 3]), (members.tree, (nodes[0], 1), by_node[0, 1])):
        kept, sides = table[at], []
        for sign in (1, -1):
            table[at] = kept + sign * 1e-2
            sides.append(-members.log_probabilities(hidden[:5], np.arange(5)).sum())
        table[at] = kept
        assert (sides[0] - sides[1]) / 2e-2 == pytest.approx(slope, rel=0.02, abs=1e-3)


def test_rare_ids_are_learnt_in_context(spark, monkeypatch):
    """Each rare id is followed by one other, which shares of the counts can't tell."""
    monkeypatch.setattr(lm, "LEAST_WINDOWS", 6_000)
    rng = np.random.default_rng(6)
    cut = [np.repeat(rng.integers(0, 40, 20), 2) for _ in range(600)]  # rare ids 0 to 39, each twice
    rows = [(k, bytes([lm.TAIL] * 40 + [lm.END]), c.astype("<u4").tobytes()) for k, c in enumerate(cut)]
    sequences = spark.createDataFrame(rows, "place long, classes binary, members binary")
    attention = lm.Attention(np.zeros((lm.CLASSES + 1, lm.CLASSES)), lm.Members(np.bincount(np.concatenate(cut))))
    whole = [lm.codes(np.append(np.full(40, lm.TAIL), lm.END), c) for c in cut[:100]]
    inputs, targets, wanted, _ = lm.windows_of(whole)
    before = attention.members.log_probabilities(np.zeros((4000, lm.WIDTH)), np.concatenate(cut[:100])).mean()
    lm.train_attention(sequences, attention, 1200)
    assert attention.log_probabilities(inputs, targets, wanted).mean() > before + 0.5


def test_heavy_nodes_are_those_above_on_every_way(monkeypatch):
    """Computed for all rare ids at once or way by way, probabilities and derivatives are the same."""
    rng = np.random.default_rng(8)
    counts = rng.zipf(1.3, 900)
    found = []
    for top in (lm.TOP, 1, 10_000):
        monkeypatch.setattr(lm, "TOP", top)
        members = lm.Members(counts)
        members.tree = np.random.default_rng(9).standard_normal(members.tree.shape).astype(np.float32)
        hidden, met = np.random.default_rng(10).standard_normal((900, lm.WIDTH)).astype(np.float32), np.random.default_rng(11).permutation(900)
        by_hidden, nodes, by_node = members.slopes(hidden, met, 3)
        table = np.zeros_like(members.tree)
        table[nodes] = by_node
        found.append((members.log_probabilities(hidden, met), by_hidden, table, members.deep.sum()))
    assert found[2][3] == 0 < found[0][3] < found[1][3] / 2
    for other in found[1:]:
        assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(found[0][:3], other[:3]))


@pytest.mark.parametrize("size", [1, 300])
def test_large_logits(size):
    """As the definition has it, also where exponentials of the logits would not be finite."""
    rng = np.random.default_rng(12)
    model = lm.Attention(rng.standard_normal((lm.CLASSES + 1, lm.CLASSES)))
    model.weights = {k: v * np.float32(size**0.5 if k in ("query", "score") else 1) for k, v in model.weights.items()}
    inputs, targets = rng.integers(0, lm.CLASSES + 1, (2, lm.WINDOW)), rng.integers(0, lm.CLASSES, (2, lm.WINDOW))
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x = w["embed"][inputs] + w["place"]
    seen = (x @ w["query"]) @ (x @ w["key"]).transpose(0, 2, 1) / lm.WIDTH**0.5
    seen = np.where(np.tri(lm.WINDOW) > 0, seen, -np.inf)
    seen = np.exp(seen - seen.max(axis=2, keepdims=True))
    hidden = x + (seen / seen.sum(axis=2, keepdims=True)) @ (x @ w["value"]) @ w["out"]
    z = hidden @ w["score"] + model.pairs[inputs] + w["bias"]
    top = z.max(axis=2)
    expected = np.take_along_axis(z, targets[..., None], 2)[..., 0] - top - np.log(np.exp(z - top[..., None]).sum(axis=2))
    for low in (0, lm.WINDOW - lm.SCORED):
        wanted = np.broadcast_to(np.arange(lm.WINDOW) >= low, inputs.shape)
        got = model.log_probabilities(inputs, targets, wanted)
        assert np.isfinite(got).all() and np.allclose(got, expected[wanted], rtol=2e-3, atol=2e-3)
        assert model.slopes(inputs, targets, wanted)[0] == pytest.approx(-expected[wanted].mean(), rel=2e-3)


def test_texts_are_cut_into_subwords_once(spark, monkeypatch):
    """Only the counts of words and the cut texts are taken from the documents; training and scoring read the cut ones."""
    plans = []

    def noted(save):
        return lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or save(df, name)

    for name in {"saved", "result"} & set(dir(lm)):
        monkeypatch.setattr(lm, name, noted(getattr(lm, name)))
    docs = spark.range(300).selectExpr("id doc_id", "concat('the station ', id) text")
    assert lm.score_texts(docs).count() == 300
    assert sum("Range (0, 300" in plan for plan in plans) == 2
