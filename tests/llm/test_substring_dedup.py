import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string"


def _bytes(text):
    return (text or "").encode()


def brute(docs, length):
    """For each text a mask of the bytes that a repeated window covers."""
    seen = Counter(d[i : i + length] for d in docs for i in range(len(d) - length + 1))
    masks = []
    for d in docs:
        m = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                m[i : i + length] = True
        masks.append(m)
    return masks


def texts(seed):
    r = random.Random(seed)
    rnd = lambda n: "".join(r.choice("abcdefg h") for _ in range(n))
    passages = [rnd(300), rnd(600), rnd(150), "x" * 500, rnd(210)]
    made = []
    for _ in range(50):
        parts = [r.choice([rnd(r.randint(0, 120)), r.choice(passages)[r.randint(0, 40) :], r.choice(passages)]) for _ in range(r.randint(0, 4))]
        made.append("".join(parts))
    return [*made, made[3], None, "", "é" * 200, "é" * 150]


def test_deep_shallow_sorts_and_gives_common_prefixes():
    r = random.Random(3)
    for _ in range(200):
        bases = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 60))) for _ in range(4)]
        many = [r.choice(bases)[: r.randint(0, 60)] + bytes(r.choice(b"ab") for _ in range(r.randint(0, 5))) for _ in range(r.randint(1, 40))]
        order, common = sd.deep_shallow(many)
        assert [many[i] for i in order] == sorted(many) and sorted(order) == list(range(len(many)))
        assert common == [sd.common_prefix(many[a], many[b]) for a, b in zip(order, order[1:])]


def test_every_window_has_an_anchor_that_depends_on_the_window_only():
    r = random.Random(1)
    data = bytes(r.choice(b"abc") for _ in range(900)) + b"z" * 300
    spots = set(sd.anchors(data, 200)[0].tolist())
    for i in range(0, len(data) - 200 + 1, 7):
        own = sd.anchors(data[i : i + 200], 200)[0].tolist()
        assert len(own) == 1 and own[0] + i in spots


@pytest.mark.parametrize("settings", [{}, {"crowd": 3, "hot": 2}, {"hot": 2, "crowd": 5}])
def test_against_brute_force(spark, settings):
    rows = [(i if i % 7 else None, d) for i, d in enumerate(texts(5))]
    want = Counter()
    for (k, d), m in zip(rows, brute([_bytes(d) for _, d in rows], 200)):
        b = _bytes(d)
        runs = int((np.diff(np.concatenate(([0], m.astype(int), [0]))) == 1).sum())
        want[(k, d, bytes(np.frombuffer(b, "u1")[~m]), len(b), int(m.sum()), runs)] += 1
    got = sd.drop_repeats(spark.createDataFrame(rows, SCHEMA), length=200, **settings)
    assert Counter((r.doc_id, r.text, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got.collect()) == want


def test_grams_at_some_positions():
    data = np.frombuffer(random.Random(4).randbytes(500), "u1")
    spots = np.array([0, 3, 99, 436])
    assert (sd.grams_at(data, spots) == sd.gram_hashes(data)[spots]).all()


def test_long_texts_are_scanned_in_stretches(spark, monkeypatch):
    """Anchors do not depend on where a stretch ends, and a repeat across an end is found."""
    r = random.Random(8)
    data = bytes(r.choice(b"abcde") for _ in range(5000))
    whole = sd.anchors(data, 200)
    monkeypatch.setattr(sd, "STRETCH", 700)
    assert all((x == y).all() for x, y in zip(sd.anchors(data, 200), whole, strict=True))
    monkeypatch.undo()
    rnd = lambda n: r.randbytes(n // 2).hex()
    passage, far = rnd(1000), rnd(sd.STRETCH - 500)
    docs = spark.createDataFrame([(1, far + passage + rnd(3000)), (2, passage), (3, rnd(2000))], SCHEMA)
    assert {x.doc_id: (x.n_removed, x.n_spans) for x in sd.drop_repeats(docs).collect()} == {1: (1000, 1), 2: (1000, 1), 3: (0, 0)}


def test_keys_of_text_and_rows_with_the_same_key(spark):
    p = random.Random(2).randbytes(300).hex()
    docs = spark.createDataFrame([("k", "a" * 10 + p), ("k", "bb" + p), ("k", "c"), (None, None)], "doc_id string, text string")
    assert sorted((x.n_bytes, x.n_removed, bytes(x.kept)) for x in sd.drop_repeats(docs).collect()) == [(0, 0, b""), (1, 0, b"c"), (602, 600, b"bb"), (610, 600, b"a" * 10)]


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sd.drop_repeats(empty).collect() == []
    clash = spark.createDataFrame([(1, "a", "g", 5)], "doc_id long, text string, g string, kept int")
    row = sd.drop_repeats(clash).first()
    assert (row.g, bytes(row.kept), row.n_removed) == ("g", b"a", 0)
    with pytest.raises(ValueError):
        sd.drop_repeats(empty, length=100)
