import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from millrace.llm import repair
from millrace.llm.queries import op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_edits(rows):
    """Cheapest first, then least string: a search over whole strings of edits, without integers."""
    todo, done = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, i, initials, made = heapq.heappop(todo)
        state = "" if not initials else "s" if initials == "s" else initials[-1]
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, made
        if (i, state, audit) in done or not re.fullmatch("s?(ua)*u?", initials):
            continue
        done.add((i, state, audit))
        if len(audit) - i < len(rows) + 3:
            for role in ("user", "assistant"):
                heapq.heappush(todo, (cost + 5, audit + "I", i, initials + role[0], (*made, f"{role}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(todo, (cost + 2, audit + "D", i + 1, initials, made))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                heapq.heappush(todo, (cost + more, audit + "K", i + 1, initials + role[:1] if role else initials + "?", (*made, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    heapq.heappush(todo, (cost + 1 + more, audit + "R", i + 1, initials + new[0], (*made, f"{new}:{text}")))


def brute(rows, damaged):
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, role, text) for k, t, role, text in damaged if k == c))
        seen, judged = set(), []
        for _, _, role, text in mine:
            words = text.strip(" \t\n\x0b\x0c\r")
            judged.append((role, text, "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None))
            seen.add((role, text))
        turns = [t for known, t, _, _ in mine if known]
        cost, audit, made = brute_edits(judged)
        count = lambda k: sum(f == k for _, _, f in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations(seed, n=60, longest=7):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        turn = r.choice([0, 3])
        for _ in range(r.randint(0, longest)):
            turn += r.choice([0, 1, 1, 1, 2])
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = r.choice(["Fine.", "Yes! ", "no end", "What?\n", "", " \t", None, "é.\x0b", "two\nlines.", "Fine."])
            rows.append((c if c else None, turn if r.random() > 0.1 else None, role, text))
    return rows


@pytest.mark.parametrize("piece", [64, 2, 1])
def test_paths_against_search_over_strings(piece, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", piece)
    r = random.Random(piece)
    for _ in range(120):
        rows = [(r.choice(["user", "assistant", "system", "tool"]), "x", r.choice([None, None, "truncated", "blank", "duplicate"])) for _ in range(r.randint(0, 6))]
        path = repair.Path()
        for role, _, fault in rows:
            path.add(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        assert path.end() == brute_edits(rows)[:2], rows


def test_pieces_do_not_change_long_paths(monkeypatch):
    r = random.Random(5)
    rows = [(r.choice("uuaasx"), r.random() < 0.1, r.random() < 0.2) for _ in range(700)]
    found = set()
    for piece in (7, 64, 1000):
        monkeypatch.setattr(repair, "PIECE", piece)
        path = repair.Path()
        for row in rows:
            path.add(*row)
        found.add(path.end())
    assert len(found) == 1


@pytest.mark.parametrize("damaged", [False, True])
def test_against_brute_force(spark, damaged):
    rows = conversations(11, 60 if damaged else 40)
    given = spark.createDataFrame(rows, SCHEMA)
    report, turns = repair.repair(repair.damage(given) if damaged else given)
    got = {x.conv_id: tuple(x[n] for n in NAMES) for x in repair.with_absent(report, given).collect()}
    plain = [(c, t, *(" " if x is None else x for x in (a, b))) for c, t, a, b in rows]
    want = brute(rows, brute_damage(rows) if damaged else plain)
    assert got == want
    for c, _ in itertools.groupby(sorted(turns.collect(), key=lambda x: (x.conv_id or 0, x.at)), key=lambda x: x.conv_id):
        mine = sorted((x for x in turns.where(turns.conv_id.eqNullSafe(c)).collect()), key=lambda x: x.at) if c in (None, 3) else None
        if mine:
            assert re.fullmatch("s?(ua)+", "".join(x.role[0] for x in mine)) and [x.at for x in mine] == list(range(len(mine)))


def test_damage_against_brute_force(spark):
    rows = conversations(4, 200)
    got = sorted(repair.damage(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)
    assert [tuple(x) for x in got] == [tuple(x) for x in sorted(map(tuple, brute_damage(rows)), key=lambda x: str(spark_row(x)))]


def spark_row(x):
    from pyspark.sql import Row

    return Row(conv_id=x[0], turn=x[1], role=x[2], text=x[3])


def test_ties_take_the_least_letters():
    for rows, want in [
        ([("u", False, False)], (2, "D")),  # not KI, 5
        ([("a", False, False), ("u", False, False)], (2, "RR")),  # not DKI, KDs
        ([("u", False, False), ("u", False, False), ("a", False, False)], (2, "DKK")),  # not KDK
        ([("s", False, False)], (2, "D")),
        ([], (0, "")),
    ]:
        path = repair.Path()
        for row in rows:
            path.add(*row)
        assert path.end() == want


def test_empty_table_extra_columns_and_a_very_long_text(spark):
    empty = spark.createDataFrame([], SCHEMA)
    report, turns = repair.repair(repair.damage(empty))
    assert report.collect() == [] and turns.collect() == []
    long = "word " * 400_000 + "end."
    rows = [(1, 0, "user", long, 5, "x"), (1, 1, "assistant", long[:-1], 5, "x"), (1, 1, "assistant", "Yes.", 5, "x")]
    report, turns = repair.repair(spark.createDataFrame(rows, SCHEMA + ", cost int, audit string"))
    row = report.first()
    assert (row.cost, row.audit, row.truncated, row.gaps) == (2, "KKD", 1, 0)
    assert row.repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:Yes.".encode()).hexdigest()


def test_one_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(5000)] + [(2, 0, "user", "a.")]
    report, turns = repair.repair(spark.createDataFrame(rows, SCHEMA))
    got = {x.conv_id: (x.cost, x.audit, x.gaps) for x in report.collect()}
    assert got == {1: (0, "K" * 5000, 0), 2: (2, "D", 0)}
    assert turns.count() == 5000


def test_conversations_without_rows_after_damage_come_back(spark, tmp_path):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    row = op13_conversation_repair(spark, str(tmp_path)).first()
    assert tuple(row[n] for n in ("conv_id", *NAMES)) == (gone, 0, 0, 0, 0, 0, 0, "", EMPTY)
