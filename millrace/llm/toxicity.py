"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

P(grade >= k) = sigmoid(w . x - theta_k) with one weight vector for all thresholds and
theta_1 <= theta_2 <= ...; the expected severity is the sum of these probabilities.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, checkpoint, few, letters, modest_batches
from .decontam import let


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(z, -60, 60)))


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thetas: list[float]

    def features(self, text: str | None) -> dict[str, int]:
        """Counts of the words that carry a weight; ``text`` is what ``common.letters`` gives."""
        counts = Counter((text or "").split())
        return {w: counts[w] for w in counts.keys() & self.weights.keys()}

    def score(self, text: str | None) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        z = sum(self.weights[w] * (1 + np.log(n)) for w, n in sorted(self.features(text).items()))
        return _sigmoid(z - np.array(self.thetas)).tolist()


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, *, l1: float | np.ndarray = 0.0, rounds: int = 400, lowest: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Weights of at least ``lowest`` and thresholds, by proximal gradient (accelerated, L1 on
    the weights).

    The likelihood is that of the cumulative logit model, sum of log(s(z - theta_y) -
    s(z - theta_{y+1})), with theta_0 = -inf and theta_{n_grades} = inf.
    """
    n, k = len(grades), n_grades - 1
    shares = np.array([(grades >= j).mean() for j in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
    theta, w = -np.log(shares / (1 - shares)), np.zeros(n_features)
    # A step per weight: sum over rows of |x_ij| * (sum_k |x_ik| + 1) bounds the curvature.
    reach = np.bincount(rows, np.abs(values), n) + 1
    step_w = 1.0 / (0.25 * np.bincount(cols, np.abs(values) * reach[rows], n_features) + 1e-9)
    step_t = 1.0 / (0.5 * reach.sum())
    wv, tv, momentum = w.copy(), theta.copy(), 1.0
    each = np.arange(n)
    for _ in range(rounds):
        z = np.bincount(rows, values * wv[cols], n)
        s = _sigmoid(z[:, None] - tv[None, :])
        padded = np.concatenate([np.ones((n, 1)), s, np.zeros((n, 1))], 1)
        hi, lo = padded[each, grades], padded[each, grades + 1]
        p = np.maximum(hi - lo, 1e-12)
        # Derivatives of -log p by the two edges that bound the grade.
        dhi, dlo = -hi * (1 - hi) / p, lo * (1 - lo) / p
        dz = dhi + dlo
        dt = np.zeros(k + 2)
        np.add.at(dt, grades, -dhi)
        np.add.at(dt, grades + 1, -dlo)
        new_w = wv - step_w * np.bincount(cols, values * dz[rows], n_features)
        new_w = np.maximum(np.sign(new_w) * np.maximum(np.abs(new_w) - step_w * l1, 0), lowest)
        new_t = np.maximum.accumulate(tv - step_t * dt[1:-1] + np.arange(k) * 1e-9)
        nxt = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        if (new_w - w) @ (wv - new_w) > 0:  # restart when momentum points uphill
            nxt = 1.0
        a = (momentum - 1) / nxt
        wv, tv = new_w + a * (new_w - w), np.maximum.accumulate(new_t + a * (new_t - theta))
        w, theta, momentum = new_w, new_t, nxt
    return w, theta


def severity_grades(amount: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Ordered grades from a binary label: 0 for not toxic; toxic rows get 1 to 3 by the thirds
    of their amount of toxicity-associated words (1 without such a word)."""
    some = amount[toxic & (amount > 0)]
    cuts = np.quantile(some, [1 / 3, 2 / 3]) if len(some) else [np.inf, np.inf]
    return np.where(toxic, 1 + (amount > cuts[0]).astype(int) + (amount > cuts[1]).astype(int), 0)


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "toxic", max_rows: int = 4000, min_rows: int = 5, max_share: float = 0.3, alpha: float = 0.05, l1: float = 0.5) -> OrdinalModel:
    """Learn from labelled rows.

    The fit is on a bounded sample of whole rows: the ``max_rows`` labelled keys with the
    smallest hash. Its vocabulary are all words (runs of letters, lower-cased) that occur in
    ``min_rows`` of the rows and in no more than ``max_share``. A word's feature is 1 +
    ln(count). Words enter by a test at level ``alpha``; their weights are fitted with a
    small L1 penalty and are not negative, so no word excuses another.
    Null labels, keys and texts teach nothing; a key with several labels counts as toxic
    if one says so. Without toxic rows, or with an empty table, the model has no weights
    and calls nothing toxic. Keys may be of any type that can be ordered.
    """
    given = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg((F.max(label) > 0).cast("int").alias("y"))
    picked = checkpoint(given.orderBy(F.xxhash64("k"), "k").limit(max_rows))
    empty = OrdinalModel({}, [30.0, 31.0, 32.0])
    # Of copies and near copies in the sample one teaches: rows are told apart by their smallest
    # hash of five words.
    words_of = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPACES)
    least = let(words_of, lambda w: F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 5, F.lit(0))), lambda i: F.xxhash64(*[F.coalesce(F.get(w, i + j), F.lit("")) for j in range(5)]))))
    sample = docs.join(few(picked.withColumnRenamed("k", key)), key)
    alone = sample.select(F.col(key).alias("k"), "y", least.alias("h")).groupBy("h").agg(F.min(F.struct("k", "y")).alias("x")).select("x.*")
    alone = checkpoint(alone.groupBy("k").agg(F.max("y").alias("y")))
    size, toxic = alone.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not toxic:
        return empty
    runs = F.filter(F.split(letters(F.col(text)), " "), lambda w: w != "")
    rows = docs.join(few(alone.withColumnRenamed("k", key)), key).select(F.col(key).alias("k"), "y", F.explode(runs).alias("w"))
    counts = checkpoint(rows.groupBy("k", "y", "w").count())
    tally = counts.groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("bad"))
    tally = checkpoint(tally.where(F.col("n").between(min_rows, max(min_rows, max_share * size))))
    # A word is taken if it is in more toxic rows than chance allows: by the Chernoff bound on
    # a binomial tail, at level ``alpha`` over the whole vocabulary. Words that go with clean
    # rows excuse nothing.
    rate, share = toxic / size, F.col("bad") / F.col("n")
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0) if rate < 1 else F.lit(0.0)
    surprise = F.col("n") * (share * F.log(share / rate) + rest)
    taken = tally.where((share > rate) & (surprise > math.log(max(1, tally.count()) / alpha))).select("w")
    words = sorted(r["w"] for r in taken.collect())  # of a bounded sample, and few of its words
    if not words:
        return empty
    spark = docs.sparkSession
    index = spark.createDataFrame(list(enumerate(words)), "i int, w string")
    found = counts.join(F.broadcast(index), "w").groupBy("k").agg(F.sort_array(F.collect_list(F.struct("i", "count"))).alias("x"))
    made = alone.join(found, "k", "left").orderBy("k").select("y", "x").collect()
    y = np.array([r["y"] for r in made])
    entries = [(n, e["i"], e["count"]) for n, r in enumerate(made) for e in r["x"] or ()]
    r, c = (np.array([e[j] for e in entries], "i8") for j in (0, 1))
    x = 1 + np.log(np.array([e[2] for e in entries], "f8"))
    grades = severity_grades(np.bincount(r, x, len(y)), y > 0)
    w, theta = fit_ordinal(r, c, x, grades, len(words), 4, l1=l1, rounds=1500, lowest=0.0)
    return OrdinalModel({word: float(v) for word, v in zip(words, w, strict=True) if v}, theta.tolist())


RESULT = "expected_severity double, grade int, p_toxic double, toxic boolean"


def score(docs: DataFrame, model: OrdinalModel, *, text: str = "text") -> DataFrame:
    """``docs`` with expected_severity (sum of P(grade >= k)), grade (number of thresholds
    passed with at least even odds), p_toxic (P(grade >= 1)) and toxic (grade >= 1).

    Null and empty texts have no features and get the base rate. Whole texts of any length
    are read. Columns of these names are replaced, others pass through; rows, repeated ones
    too, stay as they are. An empty table gives an empty result.
    """
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            p = np.array([m.score(t) for t in texts]).reshape(len(texts), -1)
            grade = (p >= 0.5).sum(1).astype("i4")
            yield pd.DataFrame({"expected_severity": p.sum(1), "grade": grade, "p_toxic": p[:, 0], "toxic": grade >= 1})

    names = ("expected_severity", "grade", "p_toxic", "toxic")
    kept = [c for c in docs.columns if c not in names]
    return docs.select(*kept, predict.asNondeterministic()(letters(F.col(text))).alias("_mr_made")).select(*kept, *[f"_mr_made.{c}" for c in names])
