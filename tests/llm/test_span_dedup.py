import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import span_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(rows, n):
    """kept, n_words, n_removed, n_spans of each row."""
    first = {}
    split = [(k, (t or "").encode().split()) for k, t in rows]
    for k, w in split:
        if k is not None:
            for i in range(len(w) - n + 1):
                s = tuple(w[i : i + n])
                first[s] = min(first.get(s, k), k)
    out = []
    for k, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if k is not None and first[tuple(w[i : i + n])] < k:
                gone[i : i + n] = [True] * n
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((b" ".join(x for x, g in zip(w, gone) if not g).decode(), len(w), sum(gone), spans))
    return out


def corpus(seed, docs=70):
    r = random.Random(seed)
    rnd = lambda n: [r.choice("ab") + r.choice("cdé") for _ in range(n)]
    passages = [rnd(40), rnd(25), rnd(13), ["x"] * 30, rnd(14)]
    made = []
    for i in range(docs):
        words = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(passages)
            words += r.choice([rnd(r.randint(0, 12)), p, p[: r.randint(5, 40)], p[r.randint(0, 5) :]])
        made.append((r.randint(0, 60) if i % 9 else None, "".join(w + r.choice([" ", "\n", "\t ", "\x0b"]) for w in words)))
    return [*made, made[5], made[5], (3, None), (4, ""), (5, " \n"), (6, "one word " * 20), (7, "one word " * 20)]


@pytest.mark.parametrize("settings", [{}, {"crowd": 1, "hot": 2}, {"crowd": 3, "hot": 2, "shard": 5}, {"n": 6, "shard": 1}])
def test_against_brute_force(spark, settings):
    rows = corpus(7)
    want = Counter((k, t, *x) for (k, t), x in zip(rows, brute(rows, settings.get("n", 13))))
    got = sd.drop_known_passages(spark.createDataFrame(rows, SCHEMA), **settings)
    assert got.columns == ["doc_id", "text", "kept", "n_words", "n_removed", "n_spans"]
    assert Counter(tuple(x) for x in got.collect()) == want
    assert sum(x[4] for x in want) > 300


def test_automaton_against_all_windows():
    r = random.Random(2)
    for _ in range(60):
        passages = sorted((r.randint(0, 9), [r.choice([b"a", b"b"]) for _ in range(r.randint(3, 14))]) for _ in range(r.randint(1, 8)))
        first = {}
        for k, w in passages:
            for size in range(1, len(w) + 1):
                for i in range(len(w) - size + 1):
                    s = tuple(w[i : i + size])
                    first[s] = min(first.get(s, k), k)
        automaton = sd.Shard(passages)
        text = [r.choice([b"a", b"b", b"c"]) for _ in range(30)]
        for n in (3, 5):
            assert automaton.first_seen(text, n) == [first.get(tuple(text[i : i + n])) for i in range(len(text) - n + 1)]
        longest = [max((z for z in range(i + 2) if tuple(text[i + 1 - z : i + 1]) in first or z == 0)) for i in range(len(text))]
        assert [length for length, _ in automaton.statistics(text)] == longest


def test_pieces_and_stretches_do_not_show(monkeypatch):
    r = random.Random(3)
    texts = [b"", b"  ", *[b"".join(r.choice([b"ab", b"c", b" ", b"\n", b"longer"]) for _ in range(r.randint(0, 200))) for _ in range(30)], b"end"]
    data, breaks = np.frombuffer(b"".join(texts), "u1"), np.cumsum([0, *map(len, texts)])[:-1]
    whole = sd.word_hashes(data, breaks)
    each = [sd.word_hashes(np.frombuffer(t, "u1"), np.array([0])) for t in texts]
    assert [len(t.split()) for t in texts] == [len(s) for s, _ in each]
    assert (np.concatenate([h for _, h in each]) == whole[1]).all()
    home = np.searchsorted(breaks, whole[0], "right") - 1
    found = sd.anchored(whole[1], home, 13)
    covered = sorted(w for a, c in zip(found[0].tolist(), found[1].tolist()) for w in range(a, a + c))
    assert covered == [i for i in range(len(home) - 12) if home[i] == home[i + 12]]
    monkeypatch.setattr(sd, "PIECE", 7)
    assert all((x == y).all() for x, y in zip(sd.word_hashes(data, breaks), whole, strict=True))
    monkeypatch.setattr(sd, "STRETCH", 11)
    cut = sd.anchored(whole[1], home, 13)
    assert {(w, g) for a, c, g in zip(*cut) for w in range(a, a + c)} == {(w, g) for a, c, g in zip(*found) for w in range(a, a + c)}


def test_very_long_text_and_a_crowd(spark):
    r = random.Random(9)
    rnd = lambda n: " ".join(r.randbytes(3).hex() for _ in range(n))
    common = rnd(20)
    rows = [(i, f"{rnd(15)} {common} {rnd(15)}") for i in range(1, 300)] + [(0, rnd(300_000) + " " + common)]
    got = {x.doc_id: (x.n_words, x.n_removed, x.n_spans) for x in sd.drop_known_passages(spark.createDataFrame(rows, SCHEMA), crowd=50).collect()}
    assert got == {0: (300_020, 0, 0)} | {i: (50, 20, 1) for i in range(1, 300)}


def test_keys_of_text_empty_table_and_clashing_names(spark):
    p = " ".join(f"w{i}" for i in range(13))
    rows = [("b", f"x {p} y", 1, "k", "g"), ("a", p, 1, "k", "g"), ("10", f"{p[:-1]}", 1, "k", "g"), (None, p, 1, "k", "g")]
    made = sd.drop_known_passages(spark.createDataFrame(rows, "doc_id string, text string, n_words int, id string, g string"))
    assert sorted((str(x.doc_id), x.kept, x.n_removed, x.id, x.g) for x in made.collect()) == [("10", p[:-1], 0, "k", "g"), ("None", p, 0, "k", "g"), ("a", p, 0, "k", "g"), ("b", "x y", 13, "k", "g")]
    empty = spark.createDataFrame([], SCHEMA)
    assert sd.drop_known_passages(empty).collect() == []
    with pytest.raises(ValueError):
        sd.drop_known_passages(empty, n=4)
