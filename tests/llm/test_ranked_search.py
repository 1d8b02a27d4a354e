import math
import random
import re
from collections import Counter

import pytest

from millrace.llm import ranked_search as rs

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, top):
    counted = [(d, Counter(tokens(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c, n in counted:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(tokens(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, n=150):
    r = random.Random(seed)
    vocabulary = ["the", "The", "Été", "été", "É", "x1", "a_b", "日本", "rare", "of", "and", "zz", "two2", "ß", "İ"]
    weights = [30, 10, 5, 5, 2, 3, 3, 2, 1, 20, 15, 1, 2, 1, 1]
    made = [" ".join(r.choices(vocabulary, weights, k=r.choice([1, 3, 8, 8, 8, 40]))) + r.choice(["", ".", "\x00\n"]) for _ in range(n)]
    docs = [(i if i % 11 else None, t) for i, t in enumerate(made)]
    return [*docs, docs[4], docs[4], (500, None), (501, ""), (502, " .,"), (4, "the rare zz")]


@pytest.mark.parametrize("settings", [{}, {"BLOCK": 5}, {"BLOCK": 7, "PORTION": 2}])
def test_against_brute_force(spark, settings, monkeypatch):
    for name, value in settings.items():
        monkeypatch.setattr(rs, name, value)
    docs = corpus(3)
    items = [(1, "the rare x1"), (2, "Été of the 日本 and of"), (3, "unknown"), (4, None), (5, ""), (6, "a_b zz"), (6, "ß"), (1, "the rare x1"), (None, "and")]
    want = brute(docs, items, 10)
    for rounds in (1, 8):
        got = rs.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), top=10, rounds=rounds)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(x) for x in got.collect()), key=str) == want


def test_ties_go_by_document_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK", 3)
    docs = spark.createDataFrame([(i, "same words here") for i in range(40, 0, -1)] + [(0, "other thing entirely")], DOCS)
    got = rs.search(docs, spark.createDataFrame([(1, "Words")], ITEMS), top=7, rounds=1)
    assert [(x["rank"], x.doc_id) for x in got.orderBy("rank").collect()] == [(i, i) for i in range(1, 8)]


def test_strata_below_the_floor_are_not_visited(spark, monkeypatch):
    """Long documents can't reach what short ones score, so the second round leaves them out."""
    docs = spark.createDataFrame([(i, "needle") for i in range(30)] + [(100 + i, "needle " + "hay " * (50 + 10 * i)) for i in range(40)] + [(900 + i, "hay") for i in range(200)], DOCS)
    visited = []
    plain = rs._visit

    def visit(index, visits, *rest):
        visited.append(visits.count())
        return plain(index, visits, *rest)

    monkeypatch.setattr(rs, "_visit", visit)
    got = rs.search(docs, spark.createDataFrame([(1, "needle")], ITEMS), top=20, rounds=2)
    assert sorted(x.doc_id for x in got.collect()) == list(range(20))
    assert visited == [2, 0]


def test_empty_tables_and_clashing_names(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert rs.search(docs, items).collect() == []
    assert rs.search(spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([], ITEMS)).collect() == []
    more = spark.createDataFrame([(1, "a b", 5, 6, 7), (2, "c", 5, 6, 7)], DOCS + ", item long, m int, score int")
    asked = spark.createDataFrame([(9, "A", 3)], ITEMS + ", doc_id int")
    assert [tuple(x)[:3] for x in rs.search(more, asked).collect()] == [(9, 1, 1)]


def test_a_very_long_text(spark):
    long = "filler " * 600_000 + "needle " * 3
    docs = [(1, long), (2, "needle"), (3, "filler")]
    items = [(1, "needle filler")]
    got = rs.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(docs, items, 50)
