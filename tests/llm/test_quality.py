from __future__ import annotations

import random

import numpy as np
import pytest

from shopfunnel.llm import quality

WORDS = [a + b + c for a in ("ba", "do", "ki", "lu") for b in ("ne", "ro", "ta") for c in ("", "s", "mi", "vo")]


def rated(seed, count):
    """Good prose, prose full of signs (grade 1), and prose with a bad word (grade 0)."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = rng.choices(WORDS, k=rng.randrange(20, 300))
        grade = rng.choice([0, 1, 2, 2, 2])
        if grade == 0:
            words[rng.randrange(len(words))] = "nasty" + rng.choice(WORDS)
        if grade == 1:
            words = [w + rng.choice(["***", "%%%"]) for w in words]
        rows.append((i, " ".join(words), grade))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = rated(1, 1500)
    return quality.fit([quality.features(t) for _, t, _ in rows], np.array([g for *_, g in rows]), 2)


def test_held_out_accuracy(model):
    rows = rated(2, 600)
    scores = np.array([model.weights[quality.features(t)].sum() for _, t, _ in rows])
    over = model.at_least(scores)
    grades = np.array([g for *_, g in rows])
    assert np.mean((over[1] >= 0.5) == (grades == 2)) > 0.97
    assert over.sum(axis=0)[grades == 2].mean() > over.sum(axis=0)[grades == 1].mean() > over.sum(axis=0)[grades == 0].mean()


def test_thresholds_are_ordered(model):
    assert np.all(np.diff(model.thresholds) > 0)
    over = model.at_least(np.linspace(-9, 9, 50))
    assert np.all(over[0] >= over[1])


def test_slopes_are_those_of_the_likelihood():
    thresholds, scores, grades = np.array([-0.4, 0.9]), np.array([0.3, -1.0, 2.0]), np.array([0, 1, 2])

    def loss(s, t):
        over = quality._sigmoid(s[None, :] - t[:, None])
        edges = np.vstack([np.ones(3), over, np.zeros(3)])
        return -np.log(edges[grades, range(3)] - edges[grades + 1, range(3)]).sum()

    by_score, by_threshold = quality._slopes(scores, grades, thresholds)
    for k in range(3):
        step = 1e-6 * np.eye(3)[k]
        assert by_score[k] == pytest.approx((loss(scores + step, thresholds) - loss(scores - step, thresholds)) / 2e-6, abs=1e-4)
    for k in range(2):
        step = 1e-6 * np.eye(2)[k]
        assert by_threshold[k] == pytest.approx((loss(scores, thresholds + step) - loss(scores, thresholds - step)) / 2e-6, abs=1e-4)


def test_on_tables_with_odd_rows(spark):
    rows = rated(3, 500)
    docs = spark.createDataFrame(
        [(i, t, "x", 0.0) for i, t, _ in rows] + [(900, None, "y", 1.0), (901, "", None, None), (None, "w " * 90_000, "z", None)],
        "doc_id long, text string, id string, tail_probability double",
    )
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows] + [(None, 1), (5, None), (6, 9), (7, 2), (7, 2)], "doc_id long, grade int")
    model = quality.train(docs, ratings, top=2)
    got = quality.score(docs, model, wanted=2)
    assert got.columns == ["doc_id", "text", "id", "expected_grade", "tail_probability"]
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == 503 and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in found.values())
    assert found[900].tail_probability == found[901].tail_probability
    assert np.mean([(found[i].tail_probability >= 0.5) == (g == 2) for i, _, g in rows]) > 0.95
    assert quality.train(docs, ratings, top=2).thresholds.tolist() == model.thresholds.tolist()


def test_without_ratings_all_stay(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert quality.train(docs, none, top=2) is None
    assert quality.select(docs, None, wanted=2).count() == 2
    assert quality.select(docs.limit(0), None, wanted=2).count() == 0


def test_the_bound_on_the_fit_holds(spark, monkeypatch):
    """Three ratings fit on three rows, whatever ids repeat, and in the same order each time."""
    rows = [(7, f"word {k % 5}") for k in range(400)] + [(i, f"other {i}") for i in range(20, 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(7, 0), (7, 2), (7, 2), (20, 1), (21, 2)], "doc_id long, grade int")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda rows, grades, top: fitted.append(([r.tolist() for r in rows], grades.tolist())))
    for parts in (1, 5):
        quality.train(docs.repartition(parts), ratings, top=2, most=3)
        quality.train(docs.repartition(parts), ratings, top=2)
    assert [len(x) for x, _ in fitted] == [3, 5, 3, 5] and fitted[:2] == fitted[2:]
    first = min(quality.features(f"word {k}").tolist() for k in range(5))
    assert fitted[1][0] == [first] * 3 + [quality.features(f"other {i}").tolist() for i in (20, 21)]
    assert fitted[1][1] == [0, 2, 2, 1, 2]


def test_every_rating_counts(spark):
    """Ratings beyond those of one model are fitted, too: a word of few documents has its weight."""
    rows = rated(5, 260) + [(2000 + i, " ".join(WORDS[i % 40 :] + [f"odd{i % 3}"]), 0) for i in range(25)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "x"), (3000, "x y")], "doc_id long, text string").repartition(3)
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows] + [(None, 1), (5, 9), (9999, 2)], "doc_id long, grade int")
    found = quality.train_on_all(docs, ratings, top=2, each=150)
    met = np.unique(np.concatenate([quality.features(t) for _, t, _ in rows]))
    rare = [quality._bucket(f"w odd{k}") for k in range(3)] + [quality._bucket("w odd")]
    assert found.weights[rare].min() < -0.1 and not np.delete(found.weights, met).any()
    assert np.all(np.diff(found.thresholds) > 0)
    again = quality.train_on_all(docs.repartition(5), ratings.repartition(4), top=2, each=150)
    assert again.thresholds.tolist() == found.thresholds.tolist() and np.array_equal(again.weights, found.weights)
    over = found.at_least(np.array([found.weights[quality.features(t)].sum() for _, t, _ in rows]))
    assert np.mean((over[1] >= 0.5) == (np.array([g for *_, g in rows]) == 2)) > 0.9


def test_the_pipelines_stage_fits_on_all_ratings(spark, tmp_path, monkeypatch):
    from shopfunnel.llm import stages

    rows = rated(7, 40)
    spark.createDataFrame([(i, int(g == 2), int(g == 0)) for i, _, g in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(quality, "train_on_all", lambda docs, ratings, top: seen.append(sorted(map(tuple, ratings.collect()))))
    monkeypatch.setattr(quality, "train", None)
    assert stages.drop_low_quality(spark, docs, str(tmp_path)).count() == 40
    assert seen == [[(i, g) for i, _, g in rows]]
