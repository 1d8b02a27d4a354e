import random
import re
from collections import Counter

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def fixture():
    """Documents with planted cases, and the ids that must go at each stage."""
    r = random.Random(11)
    syllables = {"aa": ["ka", "to", "mi", "shi", "ru"], "bb": ["lich", "ung", "schw", "pf", "er"]}

    def prose(lang, n):
        return " ".join("".join(r.choice(syllables[lang]) for _ in range(r.randint(2, 4))) for _ in range(n))

    docs, item = {}, prose("aa", 25)
    for i in range(60):
        lang = "aa" if i % 2 else "bb"
        docs[i] = (prose(lang, 80) + "\n" + prose(lang, 40), lang, f"s{i % 3}")
    for i in range(12):
        docs[i] = (docs[i][0] + "\nShared footer line", *docs[i][1:])
    docs[100] = docs[5]
    words = docs[7][0].split(" ")
    words[3] = "changed"
    docs[101] = (" ".join(words), *docs[7][1:])
    docs[102] = (prose("aa", 60) + " " + item + " " + prose("aa", 60), "aa", "s0")
    docs[103] = ("123 456 !!", "aa", "s1")
    docs[104] = (None, None, "s1")
    return docs, item, {"language_id": {103, 104}, "simhash_near_dedup": {100, 101}, "decontamination": {102}}


def test_stages_do_what_they_say(spark, tmp_path):
    docs, item, gone = fixture()
    rows = [(k, t, lang, s, len(t or "")) for k, (t, lang, s) in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left, texts = set(docs), {k: t for k, (t, _, _) in docs.items()}
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        left -= gone.get(name, set())
        if name == "line_dedup":
            texts = {k: re.sub("\nShared footer line", "", t or "") for k, t in texts.items()}
        found = now.collect()
        assert Counter(r.doc_id for r in found) == Counter(left), name
        if name != "language_id":
            assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in found)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == COLUMNS
    assert all(r.lang == docs[r.doc_id][1] for r in found)
    assert len({r.position for r in found}) == len(left)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {(r.doc_id, r.position) for r in whole.collect()} == {(r.doc_id, r.position) for r in found}


def test_of_a_text_with_many_copies_one_stays(spark):
    """Lines of 12 copies are in ten documents each; so are those of the two halves of a page."""
    one, two = "the first line\nand the second", "a page of two\nshared lines"
    texts = {i: one for i in range(12)} | {i: two for i in range(20, 32)} | {32: "a page of two", 33: "shared lines\nits own line", 40: "cold text"}
    rows = [(None, "no id", "aa", "s", 5)] * 11 + [(i, t, "aa", "s", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_deduplication(spark, docs, "").collect()}
    assert got == {i: (t, len(t)) for i, t in {None: "no id", 0: one, 20: two, 33: "its own line", 40: "cold text"}.items()}


def test_near_copies_leave_one_whole_copy_of_what_they_share(spark):
    """Twelve copies of an article, each with a line of its own, and a document that quotes three of its lines."""
    article = [f"line {i} of a long article" for i in range(40)]
    texts = {i: "\n".join([*article, f"printed on day {i}"]) for i in range(12)}
    texts[20] = "\n".join([*article[:3], *[f"an own thought, number {i}" for i in range(30)]])
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = {r.doc_id: r.text for r in corpus_pipeline.line_deduplication(spark, docs, "").collect()}
    assert got[0] == texts[0] and all(got[i] == f"printed on day {i}" for i in range(1, 12))
    assert got[20] == "\n".join(f"an own thought, number {i}" for i in range(30))


def test_empty_tables_nulls_and_extra_columns_go_through_all_stages(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra map<string,int>, block long"
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("none", []), ("nulls", [(i, None, None, None, None, None, None) for i in range(3)])):
        (tmp_path / name).mkdir()
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        (tmp_path / name / "benchmark.parquet").symlink_to(tmp_path / "benchmark.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect() == []
