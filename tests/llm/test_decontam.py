import random
import re

import pytest

from millrace.llm import decontam

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(docs, items, threshold=0.8):
    tests = {}
    for k, t in items:
        if k is not None and words(t):
            n = min(5, len(words(t)))
            tests.setdefault(k, set()).update(grams(t, n))
    found = set()
    for n in range(1, 6):
        sets = {}
        for k, t in docs:
            if k is not None:
                sets.setdefault(k, set()).update(grams(t, n))
        for i, q in tests.items():
            found |= {(d, i, len(q), len(s & q)) for d, s in sets.items() if len(next(iter(q))) == n and len(s & q) / len(q) >= threshold}
    return found


def fixture(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 5, 6, 9, 14, 20, 33, 53, 90, 300])]
    items += [(50, None), (51, ""), (None, "a b c d e f"), (52, items[7][1])]
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 400)))]
        if r.random() < 0.6:
            w = r.choice(items[:11])[1].split()
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = word()
            parts.insert(r.randint(0, 1), r.choice([" ", ". ", "\n"]).join([" ".join(w).upper(), ""]))
        docs.append((i, " ".join(parts)))
    docs += [(100, items[1][1]), (101, items[0][1]), (102, None), (103, ""), (None, items[8][1]), (104, items[8][1]), (104, items[8][1]), (105, "x " * 20_000 + items[6][1])]
    return docs, items


@pytest.mark.parametrize("seed,limit", [(1, 200_000), (2, 0)])
def test_against_brute_force(spark, seed, limit):
    docs, items = fixture(seed)
    got = decontam.contained(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), max_broadcast=limit)
    assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_common) for r in got.collect()} == brute(docs, items)


def test_sketches_keep_the_smallest_of_each_bin(spark):
    from pyspark.sql import functions as F

    r = random.Random(1)
    hashes = [r.getrandbits(64) - 2**63 for _ in range(200)]
    df = spark.createDataFrame([(hashes, b) for b in (0, 3, 6, decontam.MOST_BITS)], "s array<long>, b int")
    for row in df.select("b", decontam.sketch(F.col("s"), F.col("b")).alias("k")).collect():
        bins = {}
        for h in hashes:
            x = h if row.b == decontam.MOST_BITS else (h % 2**64) >> (64 - row.b)
            bins[x] = min(bins.get(x, h), h)
        assert sorted(row.k) == sorted(bins.values())


def test_bins_hold_the_miss_rate():
    for largest in (10, 1000, 10**6):
        for common in (4, 13, 52, 200):
            bits = decontam.bin_bits(largest, common, 1e-6)
            if bits < decontam.MOST_BITS:
                assert (1 - decontam.kept_share(largest / 2**bits)) ** common <= 1e-6


def test_dropping_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", "a"), (2, "clean", "b"), (None, "one two three four five six", "c")], "doc_id long, text string, item string")
    items = spark.createDataFrame([(7, "One two, three four five SIX!")], "item_id long, text string")
    assert [r.item for r in decontam.drop_contaminated(docs.where("item <> 'a'"), items).collect()] == ["b"]
    assert sorted(r.item for r in decontam.drop_contaminated(docs, items).collect()) == ["b"]
    assert decontam.contained(docs.limit(0), items).collect() == []
    assert decontam.contained(docs, items.limit(0)).collect() == []


def test_short_items_are_found_inside_long_texts(spark):
    docs = spark.createDataFrame([(1, "so the answer is forty-two, they say " * 2000), (2, "answer forty two is"), (3, "Answer. Is? FORTY two")], SCHEMA)
    items = spark.createDataFrame([(7, "answer is forty two"), (8, "they")], "item_id long, text string")
    assert sorted(tuple(r) for r in decontam.contained(docs, items).collect()) == [(1, 7, 1, 1, 1.0), (1, 8, 1, 1, 1.0), (3, 7, 1, 1, 1.0)]


def test_rows_of_one_key_are_judged_apart(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (1, "clean"), (None, "clean too"), (2, "")], SCHEMA)
    items = spark.createDataFrame([(7, "one two three four five six")], "item_id long, text string")
    assert sorted(r.text for r in decontam.drop_contaminated(docs, items).collect()) == ["", "clean", "clean too"]
