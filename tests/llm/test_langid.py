import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.common import letters


def brute(texts, samples):
    """Greedy longest matches by substring search, a new phrase after every STRETCH bytes."""
    out = []
    for text in texts:
        row = []
        for lang in sorted(samples):
            n = 0
            for at in range(0, len(text), langid.STRETCH):
                part = text[at : at + langid.STRETCH]
                while part:
                    m = max((k for k in range(1, min(len(part), 400) + 1) if any(part[:k] in s for s in samples[lang])), default=1)
                    n, part = n + 1, part[m:]
            row.append(n)
        out.append(row)
    return out


def test_phrases_against_brute_force(monkeypatch):
    r = random.Random(2)
    monkeypatch.setattr(langid, "STRETCH", 16)
    monkeypatch.setattr(langid, "LAID_OUT", 60)
    for _ in range(20):
        rnd = lambda letters, n: "".join(r.choice(letters) for _ in range(r.randint(0, n))).encode()
        samples = {"one": [rnd("abc ", 30) for _ in range(4)], "two": [rnd("abé", 30) for _ in range(3)], "none": [b""]}
        texts = [rnd("abcdé ", 60) for _ in range(12)]
        assert langid.LanguageModel(samples).phrases(texts).tolist() == brute(texts, samples)


@pytest.fixture(scope="module")
def model():
    return langid.LanguageModel({"en": [b" the thing and of "], "de": [" der und schön da ".encode()]})


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_predictions(spark, model):
    texts = ["The, the THING and!", "und der schönen", None, "", " \n", "12 34 !?", "½ ²", "the thing " * 50_000, "the thing " * 50_000]
    got = langid.identify(docs(spark, texts), model).orderBy("doc_id").collect()
    assert [x.lang_pred for x in got] == ["en", "de", "und", "und", "und", "und", "und", "en", "en"]
    assert all((x.score == 0) == (x.lang_pred == "und") and 0 <= x.score <= 1 for x in got)
    one = langid.LanguageModel({"x": [b" a "]})
    assert one.predict([b" b ", b""]) == [("x", 1.0), ("und", 0.0)]
    assert langid.LanguageModel({}).predict([b" b "]) == [("und", 0.0)]
    same = langid.LanguageModel({"a": [b" x "], "b": [b" x "]})
    assert same.predict([b" x y "]) == [("a", 0.5)]
    assert langid.identify(docs(spark, []), model).collect() == []


def test_prediction_against_brute_force(spark):
    """The whole way, from raw text: least phrases times log of the sample's size."""
    import math

    r = random.Random(4)
    words = {"en": "the thing and of in water".split(), "de": "der und schön da wasser".split(), "hi": "पानी और में है".split()}
    raw = [" ".join(r.choice(words[r.choice(list(words))] if r.random() < 0.3 else words[x]) + r.choice(["", ",", "!1"]) for _ in range(r.randint(1, 15))) for x in list(words) * 12]
    samples = {x: [(" " + " ".join(r.choice(w) for _ in range(n)) + " ").encode()] for n, (x, w) in enumerate(words.items(), 12)}
    cleaned = [(" " + re.sub(r"[^a-zéöü\u0900-\u0963]+", " ", t.lower()).strip() + " ").encode() for t in raw]
    given = docs(spark, raw)
    assert [bytes(x[0]) for x in given.orderBy("doc_id").select(letters(F.col("text")).cast("binary")).collect()] == cleaned
    made = langid.identify(given, langid.LanguageModel(samples)).orderBy("doc_id").collect()
    bits = [math.log2(len(samples[x][0]) + 1) for x in sorted(samples)]
    for got, phrases in zip(made, brute(cleaned, samples), strict=True):
        ranked = sorted((n * b, x) for n, b, x in zip(phrases, bits, sorted(samples)))
        assert got.lang_pred == ranked[0][1] and abs(got.score - ranked[1][0] / (ranked[0][0] + ranked[1][0])) < 1e-12


def test_fit_ignores_rows_that_teach_nothing(spark):
    rows = [(1, "the and", "en"), (2, None, "en"), (None, "x", "xx"), (3, "der", None), (4, "der und", "de"), (4, "der und", "de"), (5, "12", "en")]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    made = langid.fit(given)
    assert made.langs == ["de", "en"] and made.parsers["en"].size == len(" the and ")
    got = {r.doc_id: r.lang_pred for r in langid.identify(given.withColumnRenamed("lang", "score"), made).collect()}
    assert got == {1: "en", 2: "und", None: got[None], 3: "de", 4: "de", 5: "und"}
    assert langid.fit(given.limit(0)).langs == []
    with pytest.raises(ValueError):
        langid.fit(given, max_langs=1)


def test_the_sample_is_bounded_and_of_whole_rows(spark):
    rows = [(i, "abc " * 25, "en") for i in range(50)] + [(100, "long " * 1000, "de")]
    made = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_bytes=350)
    assert made.parsers["en"].size == 3 * 101 and made.parsers["de"].size == 5001
    assert langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_docs=2).parsers["en"].size == 202


def test_held_out_accuracy(spark):
    """Languages of random words, learnt from half of the rows."""
    r = random.Random(9)
    syllables = {"aa": "ka to mi shi ru".split(), "bb": "lich ung schw pf er".split(), "cc": "tion ment que ou et".split()}
    word = lambda x: "".join(r.choice(syllables[x]) for _ in range(r.randint(1, 4)))
    rows = [(i, " ".join(word(x) for _ in range(30)), x) for i, x in enumerate(list(syllables) * 40)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(given, langid.fit(given.where("doc_id < 60"))).where("doc_id >= 60").collect()
    assert all(x.lang == x.lang_pred and x.score > 0.5 for x in got)
