import random
import re

from millrace.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {p for i, g in enumerate(windows) if windows.count(g) > 1 for p in (i, i + 1, i + 2)}
    full = [x for x in text.split("\n") if WORD.search(x)]
    n, rep = len(w), len(again)
    return n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)), rep, n < 50 or 100 * rep > 50 * n


def test_counts_against_brute_force(spark):
    r = random.Random(5)
    texts = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\x0by\x85z é", "|a|\n|a|\n a\n a\n\n"]
    for _ in range(60):
        pool = [str(r.randint(0, 6)) for _ in range(r.randint(1, 7))] + ["é", "##", "<b>", "\t"]
        texts.append("".join(r.choice(pool) + r.choice([" ", " ", "  ", "\n", "\r\n"]) for _ in range(r.randint(0, 130))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.assess(docs).orderBy("doc_id").collect()
    assert [(x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in got] == [brute(t) for t in texts]


PROSE = "The river rose in the night and the men carried sand to the old bridge. By morning the water stood at the second step, and nobody spoke."


def lines(spark, *many):
    rows = quality.assess(spark.createDataFrame([(i, x) for i, x in enumerate(many)], "doc_id long, text string")).orderBy("doc_id").collect()
    return [(r.n_failed_lines, r.clean_text) for r in rows]


def test_rules_by_line(spark):
    good = PROSE + "\n\n" + PROSE + "”"
    assert lines(spark, good) == [(0, good)]
    bad = ["Home | News | Sports | Contact", "Home", "no closing mark", "WIN!! NOW!! BIG!!", "We use cookies to serve you.", "a# b$ c% d& e* f.", "All rights reserved."]
    assert [x[0] for x in lines(spark, *[PROSE + "\n" + b for b in bad])] == [1] * len(bad)
    assert lines(spark, PROSE + "\nHome\n\n" + PROSE)[0][1] == PROSE + "\n\n" + PROSE


def test_documents_that_lose_too_much_go(spark):
    varied = " ".join(f"word{i} goes{i} on{i}." for i in range(30))
    noise = "\n".join(f"menu{i} | item{i} | more{i} | last{i}" for i in range(80))
    docs = spark.createDataFrame([(1, varied, 1), (2, varied + "\n" + noise, 1), (3, None, 1), (4, "short.", 1)], "doc_id long, text string, kept int")
    assert {r.doc_id: r.kept for r in quality.assess(docs).collect()} == {1: True, 2: False, 3: False, 4: False}
    assert quality.assess(docs.limit(0)).collect() == []


def test_a_very_long_text_repeated_rows_and_null_ids(spark):
    long = "\n".join(f"Sentence {i} of a long text ends here." for i in range(60_000))
    rows = [(1, long), (None, PROSE), (2, PROSE), (2, PROSE), (None, None)]
    got = sorted(((r.doc_id, r.n_words, r.n_dup_lines, r.base_failed) for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    n = len(PROSE.split())
    assert got == sorted([(1, 8 * 60_000, 0, True), (None, n, 0, True), (2, n, 0, True), (2, n, 0, True), (None, 0, 0, True)], key=str)
