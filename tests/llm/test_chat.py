import random

import pytest

from millrace.llm import chat

PIECES = ["\\", "###", " ", "</turn>", "\n", ":", ": ", "a", "#", "<", "### Assistant: ", "é", ""]


def test_any_turns_are_read_back():
    r = random.Random(1)
    text = lambda: "".join(r.choice(PIECES) for _ in range(r.randint(0, 8)))
    for _ in range(4000):
        turns = [("assistant" if r.random() < 0.4 else text(), text()) for _ in range(r.randint(0, 4))]
        formatted, mask = chat.render(turns)
        assert chat.parse(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in mask] == [t for role, t in turns if role == "assistant"]
    with pytest.raises(ValueError):
        chat.parse("### user: no end")


def brute_paths(nodes, top):
    kids, by = {}, {n: (p, s) for n, p, s in nodes}
    for n, p, _ in nodes:
        if p in by:
            kids.setdefault(p, []).append(n)
    out = set()
    for root in [n for n, (p, _) in by.items() if p not in by]:
        paths, stack = [], [[root]]
        while stack:
            path = stack.pop()
            if path[-1] not in kids:
                paths.append(path)
            stack += [[*path, k] for k in kids.get(path[-1], [])]
        score = lambda p: sum(by[n][1] or 0.0 for n in p) / len(p)
        for rank, path in enumerate(sorted(paths, key=lambda p: (-score(p), -len(p), p[-1]))[:top], 1):
            out |= {(root, path[-1], rank, n, i) for i, n in enumerate(path, 1)}
    return out


@pytest.mark.parametrize("top", [1, 3])
def test_paths_against_brute_force(spark, top):
    r = random.Random(top)
    nodes = [(f"n{i:03}", None if i < 3 else f"n{r.randrange(i):03}" if i != 9 else "gone", r.choice([None, 0.0, 0.5, 1.0])) for i in range(60)]
    nodes += [(f"deep{i:03}", f"deep{i - 1:03}" if i else None, 1.0) for i in range(70)]
    got = chat.best_paths(spark.createDataFrame(nodes, "node string, parent string, score double"), top=top)
    assert {tuple(x) for x in got.collect()} == brute_paths(nodes, top) and got.count() == len(brute_paths(nodes, top))


def test_wide_trees_are_joined_in_parts(spark):
    """One root with thousands of answers, half of them answered again, and rows with lost parents."""
    nodes = [("root", None, 0.0)] + [(f"a{i:05}", "root", (i % 7) / 7) for i in range(2500)] + [(f"b{i:05}", f"a{i:05}", 1.0) for i in range(1200)] + [(f"c{i:05}", "gone", 1.0) for i in range(1100)]
    got = chat.best_paths(spark.createDataFrame(nodes, "node string, parent string, score double"), top=2)
    assert {tuple(x) for x in got.collect()} == brute_paths(nodes, 2)


def test_long_texts_are_read_back():
    import tracemalloc

    turns = [("assistant", "ab: \\ # </turn " * 100_000), ("user", "x" * 3_000_000)]
    formatted, mask = chat.render(turns)
    tracemalloc.start()
    assert chat.parse(formatted) == turns and chat.unescape(formatted[slice(*mask[0])]) == turns[0][1]
    assert tracemalloc.get_traced_memory()[1] < 12 * len(formatted)
    tracemalloc.stop()


def test_other_columns_and_repeated_nodes(spark):
    rows = [(1, "a", None, "user", "hi", 0.0, 5, "x"), (1, "b", "a", "assistant", "yes", 1.0, 6, "y"), (1, "b", "a", "assistant", "yes", 1.0, 6, "y"), (1, None, "a", "user", "no", 9.0, 1, "z")]
    given = spark.createDataFrame(rows, "conv_id long, node string, parent string, role string, text string, score double, rank int, formatted string")
    got = chat.format_trees(given).collect()
    assert [(r.conv_id, r.rank, r.leaf, chat.parse(r.formatted)) for r in got] == [(1, 1, "b", [("user", "hi"), ("assistant", "yes")])]


def test_cycles_are_refused(spark):
    with pytest.raises(RuntimeError):
        chat.best_paths(spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "node string, parent string, score double"), max_rounds=4).collect()


def test_linear_conversations_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 5, None, "b"), (2, 5, None, "a"), (2, 5, None, "a"), (None, 0, "assistant", "x: ### y"), (3, None, "user", "first"), (3, 0, "user", "then")]
    trees = chat.as_trees(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: chat.parse(r.formatted) for r in chat.format_trees(trees).collect()}
    assert got == {1: [("user", "hi"), ("assistant", "")], 2: [("", "a"), ("", "a"), ("", "b")], None: [("assistant", "x: ### y")], 3: [("user", "first"), ("user", "then")]}
    assert chat.format_trees(trees.limit(0)).collect() == []


def test_ids_that_read_like_null_or_like_a_node(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), ("null", 0, "user", "c"), ("null", 1, "assistant", "d"), ("", 0, "user", "e"), ("null:1", 0, "user", "f"), ("null:1", 1, "assistant", "g")]
    given = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    made = chat.format_trees(chat.as_trees(given)).collect()
    got = {r.conv_id: [t for _, t in chat.parse(r.formatted)] for r in made}
    assert got == {None: ["a", "b"], "null": ["c", "d"], "": ["e"], "null:1": ["f", "g"]}
