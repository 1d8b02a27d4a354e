import random

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash as sh


def brute_print(text, size=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, radius):
    home = list(range(len(prints)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                home[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def near_prints(seed, n=150):
    r = random.Random(seed)
    bases = [r.getrandbits(64) for _ in range(6)]
    made = []
    for _ in range(n):
        x = r.choice(bases)
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(64)
        made.append(x)
    return made


def test_fingerprint_of_words_lines_and_nothing():
    for text in (None, "", " \n", "One", "one two", "A b c", "a B c a b c a b", "é à ü É x y z", "a\x0bb\x0cc\rd e f"):
        assert sh.fingerprint(sh.shingle_hashes(text, 3)) == brute_print(text)


@pytest.mark.parametrize("radius,hot", [(2, 1000), (2, 1), (1, 3), (3, 1000)])
def test_links_against_all_pairs(spark, radius, hot):
    prints = sorted(set(near_prints(radius)))
    signed = np.array(prints, "u8").view("i8").tolist()
    got = {(r.a, r.b) for r in sh.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius=radius, hot=hot).collect()}
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for j, b in enumerate(signed) if i < j and (prints[i] ^ prints[j]).bit_count() <= radius}
    assert got == want and want


def test_groups_against_brute_force(spark):
    r = random.Random(4)
    base = [" ".join(r.choice("abcdefghij") * r.randint(1, 3) for _ in range(120)) for _ in range(4)]
    texts = []
    for _ in range(40):
        words = r.choice(base).split()
        for _ in range(r.randint(0, 2)):
            words[r.randrange(len(words))] = "zz"
        texts.append(" ".join(words))
    texts += [None, "", "  ", "one", "ONE", texts[0], texts[0]]
    prints = [brute_print(t) for t in texts]
    roots = brute_groups(prints, 2)
    got = sh.simhash_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(x.fingerprint, x.component_id) for x in got] == [(f"{p:016x}", c) for p, c in zip(prints, roots, strict=True)]


def test_empty_and_null_keys(spark):
    assert sh.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = sh.simhash_groups(spark.createDataFrame([(None, "a b c"), (5, "x y z")], "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(None, None), (5, 5)}


def test_near_copies_go_and_clean_documents_stay(spark):
    r = random.Random(8)
    text = lambda: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(200))
    first = text()
    copy = first.split()
    copy[50] = "changed"
    rows = [(1, first), (2, " ".join(copy)), (3, first), (4, text()), (5, text()), (6, None), (None, first), (None, "only here"), (7, ""), (8, "short one"), (8, "short one")]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, fp string")
    got = sorted((x.doc_id is None, x.doc_id, x.fp) for x in sh.drop_near_copies(docs).collect())
    assert got == [(False, 1, "clash"), (False, 4, "clash"), (False, 5, "clash"), (False, 6, "clash"), (False, 8, "clash"), (True, None, "clash")]
    assert sh.drop_near_copies(docs.limit(0)).collect() == []


def brute_kept(texts):
    """Ids that stay: the smallest of each component of exact Jaccard similarity 0.8."""
    sets = [set(sh.shingle_hashes(t, 5).tolist()) for t in texts]
    home = list(range(len(texts)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both / (len(a) + len(b) - both) >= 0.8:
                x, y = find(i), find(j)
                home[max(x, y)] = min(x, y)
    return [i for i in range(len(texts)) if find(i) == i]


@pytest.mark.parametrize("settings", [{}, {"dense": 0, "crowd": 10, "sample": 5000}, {"rounds": 0, "sample": 1}])
def test_near_copies_under_crowded_keys(spark, settings):
    """Recall is 1.0: pages of shared wording that are not near-duplicates of each other, and copies of some."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))
    frame, texts = [word() for _ in range(300)], []
    for _ in range(400):
        page = list(frame)
        for at in r.sample(range(300), 18):
            page[at] = word()
        texts.append(page)
    for page in r.sample(texts, 60):
        page = list(page)
        for at in r.sample(range(300), 3):
            page[at] = word()
        texts.append(page)
    r.shuffle(texts)
    texts = [" ".join(t) for t in texts]
    got = sorted(x.doc_id for x in sh.drop_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **settings).collect())
    want = brute_kept(texts)
    assert got == want and len(want) == 400


def test_near_copies_with_passages_appended_and_inserted(spark):
    r = random.Random(5)
    prose = lambda n: ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]
    texts = []
    for i in range(80):
        page = prose(r.randint(150, 300))
        more = prose(len(page) * (10, 15, 20, 23)[i % 4] // 100)
        at = len(page) if i % 8 < 4 else len(page) // 2
        texts += [page, page[:at] + more + page[at:]]
    texts = [" ".join(t) for t in texts]
    got = sorted(x.doc_id for x in sh.drop_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert got == brute_kept(texts) and len(got) < 100


def test_rows_of_one_key_with_different_texts(spark):
    r = random.Random(6)
    a, b, c = (" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(3))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (2, c), (3, c), (3, c)], "doc_id long, text string")
    assert sorted(map(tuple, sh.drop_near_copies(docs).collect())) == sorted([(1, a), (2, b), (2, c)])


def test_a_text_beyond_one_block_of_hashes_and_extra_columns(spark):
    r = random.Random(6)
    long = " ".join(f"w{r.randrange(5000)}" for _ in range(90_000))
    rows = [(7, long, "k", 1), (3, long + " more", "k", 2), (5, "quite another text", "k", 3), (None, "quite another text", "k", 4)]
    made = sh.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int"), shingle=3, radius=2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in made.collect() if r.doc_id is not None}
    assert {k: int(f, 16) for k, (f, _) in got.items()} == {k: brute_print(t) for k, t, *_ in rows if k is not None}
    assert got[7][1] == got[3][1] == 3 and got[5][1] == 5


def test_rounds_give_roots_to_the_keys_of_crowded_shingles_only(spark, monkeypatch):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))
    frame, texts = [word() for _ in range(40)], []
    for _ in range(60):  # shingles of 60 pages, and shingles of two of them
        page = [word() for _ in range(60)]
        texts += [" ".join(frame + page + [word() for _ in range(40)]) for _ in range(2)]
    texts += [f"{x} {word()}" for x in texts[:10]]
    written, write = [], sh.checkpoint

    def counted(df, **settings):
        made = write(df, **settings)
        if {"h", "pos", "root"} <= set(made.columns):
            written.append(made.count())
        return made

    monkeypatch.setattr(sh, "checkpoint", counted)
    got = sh.drop_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), dense=0, rounds=4, busiest=16, least_gain=0.0, sample=1)
    assert sorted(x.doc_id for x in got.collect()) == brute_kept(texts)
    assert len(written) > 2 and all(n < written[0] / 2 for n in written[2:])
