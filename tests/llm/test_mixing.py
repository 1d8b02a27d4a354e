import random
from collections import defaultdict
from fractions import Fraction

import pytest

from millrace.llm import mixing


def brute(weights, blocks):
    """Earliest deadline first, slot by slot, over all blocks, with the given weights as fractions."""
    total = sum(Fraction(w) for w in weights.values())
    share = {s: Fraction(w) / total for s, w in weights.items()}
    left = {(s, j): (j / share[s], (j + 1) / share[s]) for s, n in blocks.items() for j in range(n)}
    made, slot, following = {}, 0, dict.fromkeys(blocks, 0)
    while left:
        open_now = [(-(-d // 1), d, s, j) for (s, j), (r, d) in left.items() if r // 1 <= slot and j == following[s]]
        if open_now:
            _, _, s, j = min(open_now)
            made[s, j] = slot
            following[s] += 1
            del left[s, j]
        slot += 1
    return made, share


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_that_of_brute_force_and_never_a_block_off(seed):
    r = random.Random(seed)
    n = [1, 2, 5, 9, 14, 3][seed]
    weights = {f"s{i}": r.choice([r.random() + 0.01, r.randint(1, 900), 0.1]) for i in range(n)}
    blocks = {s: r.randint(1, 40) for s in weights}
    got = mixing.pfair(mixing.exact_weights(weights), blocks)
    made, share = brute(weights, blocks)
    assert {(s, j): slot for s, j, _, _, slot in got} == made and [x[4] for x in got] == sorted(made.values())
    for s, j, release, due, slot in got:
        assert release == j / share[s] // 1 and due == -(-(j + 1) / share[s] // 1) and release <= slot < due


@pytest.mark.parametrize("n,horizon", [(2, 5000), (40, 5000), (200, 20_000)])
def test_prefixes_stay_within_one_block_of_the_given_weights(n, horizon):
    """While no source has run out, over many turns; 91 of 100, and 900 of 999 among 100 others."""
    r = random.Random(n)
    weights = {f"s{i}": r.random() + 1e-3 for i in range(n)} if n < 200 else {"big": 900.0, **{f"s{i}": 1.0 for i in range(99)}, **{f"t{i}": r.random() for i in range(100)}}
    total = sum(Fraction(w) for w in weights.values())
    share = {s: Fraction(w) / total for s, w in weights.items()}
    blocks = {s: int(share[s] * horizon) + 2 for s in weights}
    count = dict.fromkeys(weights, 0)
    plan = {x[4]: x[0] for x in mixing.pfair(mixing.exact_weights(weights), blocks)}
    for t in range(horizon):
        count[plan[t]] += 1
        for s in [plan[t], *r.sample(sorted(weights), 2)]:
            assert abs(count[s] - share[s] * (t + 1)) < 1
    assert all(abs(count[s] - share[s] * horizon) < 1 for s in weights)


def docs(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 == 0 else f"s{i % 7}", "x") for i in range(900)]
    rows += [(None, "null key", "s1", "x"), (5, "t5", "s5", "x"), (5, "t5", "s5", "x"), (1000, None, None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, slot string")


@pytest.mark.parametrize("limit", [200_000, 10])
def test_all_rows_once_and_each_source_keeps_its_share(spark, limit):
    given = docs(spark)
    got = mixing.mix(given, block_rows=4, bucket_rows=50, max_broadcast=limit).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text or "") for r in got) == sorted((r.doc_id is None, r.doc_id, r.text or "") for r in given.collect())
    assert len({r.position for r in got}) == len(got)
    counts = {r["s"]: r["count"] for r in given.selectExpr("coalesce(source, '') s").groupBy("s").count().collect()}
    weights = mixing.smoothed_weights(counts)
    want, _ = brute(weights, {s: -(-n // 4) for s, n in counts.items()})
    assert {(r.source or "", r.block): r.slot for r in got} == want
    filled = defaultdict(int)
    for r in got:
        filled[r.source or "", r.block] += 1
    assert all(n == 4 or b == (counts[s] - 1) // 4 for (s, b), n in filled.items())
    by_slot = sorted((r.slot, r.position) for r in got)
    assert [p for _, p in by_slot] == sorted(r.position for r in got)


def test_the_order_is_stable(spark):
    one, two = ({(r.doc_id, r.text): r.position for r in mixing.mix(docs(spark).repartition(n), block_rows=8).collect() if r.doc_id != 5} for n in (3, 5))
    assert one == two


def test_weights_limits_and_empty_tables(spark):
    with pytest.raises(ValueError):
        mixing.mix(docs(spark), {"hot": 1.0})
    with pytest.raises(ValueError):
        mixing.exact_weights({"a": 0.0})
    with pytest.raises(ValueError):
        mixing.mix(docs(spark), max_sources=3)
    assert mixing.exact_weights({"a": 1, "b": 0.5}) == {"a": 2, "b": 1}
    assert mixing.mix(docs(spark).limit(0)).collect() == []
    assert {r.block for r in mixing.mix(docs(spark), block_rows=1, max_blocks=4).collect()} <= {0, 1}


def test_very_many_sources(spark):
    n = 200_000
    got = mixing.mix(spark.range(n + 50).selectExpr("id as doc_id", f"concat('site', id % {n}) as source"), block_rows=1, max_broadcast=1000)
    row = got.selectExpr("count(*) as n", "count(distinct position) as p", "count(distinct doc_id) as d", "sum(cast(slot >= release and slot < deadline as int)) as held").first()
    assert row.asDict() == {"n": n + 50, "p": n + 50, "d": n + 50, "held": n + 50}
