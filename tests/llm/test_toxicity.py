import random

import numpy as np
import pytest

from millrace.llm import toxicity


def corpus(spark, n=600):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(r.randint(20, 80))]
        bad = i % 6 == 0
        for _ in range(r.randint(1, 8) if bad else 0):
            w[r.randrange(len(w))] = r.choice(["idiot", "moron", "scum,"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad or r.random() < 0.02)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_documents_are_found_and_clean_ones_left(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels, max_rows=400)
    assert model.thetas == sorted(model.thetas) and {"idiot", "moron", "scum"} <= set(model.weights)
    rows = toxicity.score(docs, model).collect()
    assert all(r.toxic == (r.doc_id % 6 == 0) for r in rows)
    assert all(abs(r.toxic - (r.grade >= 1)) == 0 and 0 <= r.expected_severity <= 3 for r in rows)
    mild, severe = (model.score(t) for t in ("one idiot here", "idiot idiot moron moron scum scum idiot"))
    assert sum(severe) > sum(mild) > sum(model.score("nothing here"))


def test_odd_rows_and_empty_tables(spark):
    docs, labels = corpus(spark, 120)
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(None, None, "c"), (1, "", "c"), (1, "", "c"), (2, "IDIOT " * 50_000, "c")], "doc_id long, text string, grade string")
    got = toxicity.score(odd, model).collect()
    assert len(got) == 4 and [r.toxic for r in got] == [False, False, False, True]
    none = toxicity.fit(docs, labels.limit(0))
    assert none.weights == {} and not toxicity.score(docs, none).where("toxic").count()
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_fit_recovers_an_ordinal_model():
    r = np.random.default_rng(1)
    x = r.integers(0, 2, (3000, 3)).astype(float)
    z = x @ np.array([2.0, -1.5, 0.0])
    u = r.logistic(size=3000)
    y = (z + u > 0).astype(int) + (z + u > 1.5).astype(int)
    rows, cols = np.nonzero(x)
    w, theta = toxicity.fit_ordinal(rows, cols, x[rows, cols], y, 3, 3, l1=0.0, rounds=3000)
    assert np.abs(w - [2.0, -1.5, 0.0]).max() < 0.25 and np.abs(theta - [0, 1.5]).max() < 0.25


def loss(x, y, w, theta, l1):
    """Penalised negative log likelihood of the cumulative logit model, from its definition."""
    edge = np.concatenate([[-np.inf], theta, [np.inf]])
    s = lambda z: 1 / (1 + np.exp(-np.clip(z, -700, 700)))
    z = x @ w
    p = s(z - edge[y]) - s(z - edge[y + 1])
    return -np.log(p).sum() + l1 * np.abs(w).sum()


@pytest.mark.parametrize("lowest", [-np.inf, 0.0])
def test_fit_reaches_what_another_optimiser_finds(lowest):
    """Coordinate search on the loss itself, from zero weights, ends no lower and at the same place."""
    r = np.random.default_rng(7)
    x = (r.random((400, 4)) < 0.4) * (1 + np.log(r.integers(1, 5, (400, 4))))
    z = x @ np.array([1.5, 0.8, -0.7, 0.0]) + r.logistic(size=400)
    y = (z > 0.5).astype(int) + (z > 1.5).astype(int) + (z > 3).astype(int)
    rows, cols = np.nonzero(x)
    w, theta = toxicity.fit_ordinal(rows, cols, x[rows, cols], y, 4, 4, l1=0.5, rounds=4000, lowest=lowest)
    at = np.array([0, 0, 0, 0, 0.0, 1.0, 2.0])
    value = lambda v: loss(x, y, v[:4], v[4:], 0.5) if (np.diff(v[4:]) > 0).all() and (v[:4] >= lowest).all() else np.inf
    best, step = value(at), 0.5
    while step > 1e-6:
        moved = False
        for i in range(7):
            for sign in (-1, 1):
                there = at.copy()
                there[i] = there[i] + sign * step if i > 3 or abs(there[i]) > step or there[i] * sign >= 0 else 0.0
                if (v := value(there)) < best:
                    at, best, moved = there, v, True
        step = step if moved else step / 2
    assert loss(x, y, w, theta, 0.5) <= best + 1e-4
    assert np.abs(np.concatenate([w, theta]) - at).max() < 0.02


def test_numbers_are_no_words_and_keys_can_be_text(spark):
    docs = spark.createDataFrame([(f"k{i}", "scum² ½ 12 schön" if i % 4 == 0 else "fine words") for i in range(80)], "doc_id string, text string")
    labels = docs.selectExpr("doc_id", "cast(text like 'scum%' as int) as toxic")
    varied = docs.selectExpr("doc_id", "concat(text, ' ', doc_id, 'x') as text")
    model = toxicity.fit(varied, labels)
    assert set(model.weights) == {"scum", "schön"}
    assert all(r.toxic == r.text.startswith("scum") for r in toxicity.score(varied, model).collect())
