import random
from collections import Counter, defaultdict

import pytest

from millrace.llm import line_dedup as ld

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_docs, keep):
    docs = defaultdict(list)
    for k, t in rows:
        for x in {key(line) for line in (t or "").split("\n")}:
            if x:
                docs[x].append(k)
    out = []
    for k, t in rows:
        lines, kept, met = (t or "").split("\n"), [], set()
        for line in lines:
            x = key(line)
            if x and len(docs[x]) >= min_docs:
                first = min((d for d in docs[x] if d is not None), default=None)
                if keep == "none" or x in met or k is None or k != first:
                    continue
                met.add(x)
            kept.append(line)
        out.append((k, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def rows(seed):
    r = random.Random(seed)
    pool = ["Buy now", " buy NOW\t", "École", "école", "x", "", "  ", "footer · line", "unique"]
    made = [(i, "\n".join(r.choice(pool) + ("" if r.random() < 0.7 else str(i)) for _ in range(r.randint(1, 6)))) for i in range(40)]
    return [*made, (None, "buy now\nother"), (40, None), (41, ""), (42, "Buy now\nBuy now"), (42, "Buy now\nBuy now"), (43, "a\u0085 \x1c")]


@pytest.mark.parametrize("settings", [{}, {"keep": "first"}, {"max_broadcast": 0}, {"keep": "first", "max_broadcast": 0}, {"max_bytes": 8, "salts": 3}])
def test_against_brute_force(spark, settings):
    given = rows(2)
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    got = ld.drop_frequent_lines(docs, min_docs=10, **settings)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == brute(given, 10, settings.get("keep", "none"))


def test_filter_has_no_false_negatives(spark):
    docs = spark.createDataFrame([(i, f"own {i}\nshared {i // 2}") for i in range(400)], "doc_id long, text string").repartition(7)
    bloom = ld.twice_seen(docs)
    twice = [ld.digest(f"shared {i}".encode()) for i in range(200)]
    once = [ld.digest(f"own {i}".encode()) for i in range(400)]
    assert ld._suspects(bloom, twice) == twice and len(ld._suspects(bloom, once)) < 40


def test_short_keys_stay_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, "ab\nabc", 1, "g") for i in range(12)], "doc_id long, text string, n_lines int, digest string")
    got = ld.drop_frequent_lines(docs, min_docs=10, min_chars=3).first()
    assert (got.text, got.n_lines, got.n_dropped, got.digest) == ("ab", 2, 1, "g")
    assert ld.drop_frequent_lines(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ld.drop_frequent_lines(docs, keep="last")


def test_keys_can_be_text_or_large_numbers(spark):
    texts = spark.createDataFrame([(f"k{i:02}", "same\nown") for i in range(11)] + [(None, "same")], "doc_id string, text string")
    got = {r.doc_id: r.text for r in ld.drop_frequent_lines(texts, keep="first").collect()}
    assert got == {None: "", "k00": "same\nown"} | {f"k{i:02}": "" for i in range(1, 11)}
    big = 1 << 60
    numbers = spark.createDataFrame([(big + i, "same") for i in range(11)] + [(None, "same")], "doc_id long, text string")
    assert {r.doc_id for r in ld.drop_frequent_lines(numbers, keep="first").where("text = 'same'").collect()} == {big}


def test_a_very_long_text_of_many_lines(spark):
    long = "\n".join([*[f"line {i}" for i in range(150_000)], "shared"])
    given = [(0, long), *[(i, f"shared\nown {i}") for i in range(1, 12)]]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in ld.drop_frequent_lines(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert got == {0: (150_001, 1, long[: -len("\nshared")])} | {i: (2, 1, f"own {i}") for i in range(1, 12)}
