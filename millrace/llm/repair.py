"""Repair of the turn structure of conversations by the cheapest edits.

A repaired conversation has the role initials ``(s?(ua)+)?``. Each row is kept (0), given the role
that is due (1) or deleted (2, and blank or repeated rows must be); an empty turn may be inserted
anywhere (5); a truncated row that stays costs 5. The edits are the shortest path of a graph whose
nodes are (rows read, state of the role grammar), where ties go to the ASCII-least string of the
edits' initials D, I, K, R.

Weights are plain integers: ``cost * 5 ** width + code``, where the code holds the letters as digits
1 to 4, first letter first, with zeros behind the last one up to ``width`` digits. So the minimum of integers
decides costs and ties at once. Two paths over the same rows whose letters differ only by more letters at
the end differ in cost too (more insertions), so the order of two codes never changes by
what is appended, and paths can be cut: rows are read in pieces, a piece becomes a matrix of weights
from state to state, and pieces are joined by appending digits. What a conversation needs
in memory is a few bits a turn, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, modest_batches

#: States of the grammar: nothing yet, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LETTERS = "\0DIKR"
BASE = len(LETTERS)
#: Rows of a conversation that become one matrix.
PIECE = 64
#: Insertions in one gap: a user and an assistant turn; a third would repeat a state.
GAP = 2
WORDS = r"[^\x20\x09-\x0D]"


def due(state: int) -> int:
    """The state that a turn with the role that is due leads to."""
    return ASSISTANT if state == USER else USER


def edits(state: int, initial: str, gone: bool, truncated: bool) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of each edit of a row in a state. ``gone``: it must be deleted."""
    made = [("D", DELETE, state)]
    if not gone:
        more = TRUNCATED * truncated
        made.append(("R", REROLE + more, due(state)))
        if initial == "s" and state == START:
            made.append(("K", KEEP + more, SYSTEM))
        elif initial == {USER: "u", ASSISTANT: "a"}[due(state)]:
            made.append(("K", KEEP + more, due(state)))
    return made


class Path:
    """The best paths from the start of a conversation to each state: state -> (weight, letters)."""

    def __init__(self):
        self.width = 0
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.rows: list[tuple[str, bool, bool]] = []

    def add(self, initial: str, gone: bool, truncated: bool) -> None:
        self.rows.append((initial, gone, truncated))
        if len(self.rows) == PIECE:
            self._take(False)

    def end(self) -> tuple[int, str]:
        """Cost and letters of the cheapest edits of all rows."""
        self._take(True)
        weight, n = min(self.best[s] for s in (START, ASSISTANT) if s in self.best)
        cost, code = divmod(weight, BASE**self.width)
        return cost, _decoded(code // BASE ** (self.width - n), n)

    def _take(self, last: bool) -> None:
        """Appends the piece that has been read; ``last`` adds what is inserted at the very end."""
        width, piece = _piece(self.rows, last)
        scale, joined = BASE ** (self.width + width), {}
        own, added = BASE**self.width, BASE**width
        for state, (weight, n) in self.best.items():
            cost, code = divmod(weight, own)
            head = code * added
            for to, (more, m) in piece[state].items():
                cost2, code2 = divmod(more, added)
                # The letters of the piece follow the n letters there are.
                found = ((cost + cost2) * scale + head + code2 * BASE ** (self.width - n), n + m)
                if to not in joined or found < joined[to]:
                    joined[to] = found
        self.width, self.best, self.rows = self.width + width, joined, []


def _piece(rows: list[tuple[str, bool, bool]], last: bool) -> tuple[int, list[dict[int, tuple[int, int]]]]:
    """Width, and from each state the least weight and its letters to each other state."""
    width = (GAP + 1) * len(rows) + GAP
    scale, at = BASE**width, [BASE ** (width - 1 - p) for p in range(width)]
    digit = {c: i for i, c in enumerate(LETTERS)}

    def insertions(best: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        layer, made = best, dict(best)
        for _ in range(GAP):
            following: dict[int, tuple[int, int]] = {}
            for state, (weight, n) in layer.items():
                found = (weight + INSERT * scale + digit["I"] * at[n], n + 1)
                if due(state) not in following or found < following[due(state)]:
                    following[due(state)] = found
            layer = following
            for state, found in layer.items():
                if state not in made or found < made[state]:
                    made[state] = found
        return made

    out = []
    for start in range(4):
        best = {start: (0, 0)}
        for row in rows:
            following: dict[int, tuple[int, int]] = {}
            for state, (weight, n) in insertions(best).items():
                for letter, cost, to in edits(state, *row):
                    found = (weight + cost * scale + digit[letter] * at[n], n + 1)
                    if to not in following or found < following[to]:
                        following[to] = found
            best = following
        out.append(insertions(best) if last else best)
    return width, out


def _decoded(code: int, n: int) -> str:
    """``n`` base 5 digits as letters, by halves, so that long codes take few large divisions."""
    if n <= 64:
        letters = []
        for _ in range(n):
            code, d = divmod(code, BASE)
            letters.append(LETTERS[d])
        return "".join(reversed(letters))
    high, low = divmod(code, BASE ** (n // 2))
    return _decoded(high, n - n // 2) + _decoded(low, n // 2)


def damage(turns: DataFrame, *, by: str = "conv_id", order: str = "turn") -> DataFrame:
    """``by, order, role, text`` damaged by crc32("by:order") % 20: 0 drops the row, 1 empties its
    text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user. Null roles and texts, and null
    values within the checked string, are one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(by).cast("string"), space), F.lit(":"), F.coalesce(F.col(order).cast("string"), space))
    rows = turns.select(by, order, F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_mr_kind"))
    kind = F.col("_mr_kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    made = rows.where(kind != 0).select(by, order, F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("_mr_copy"))
    return made.drop("_mr_copy")


def faults(turns: DataFrame, *, by: str = "conv_id", order: str = "turn") -> DataFrame:
    """``by, order, role, text, pos, fault``: the rows of each conversation numbered from 0 by
    ``order`` (nulls first; ties by role and text), and the first fault of each: blank,
    duplicate (role and text seen earlier), truncated (does not end in ``[.!?]``), or null."""
    space = F.lit(" ")
    rows = turns.select(by, order, F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    along = Window.partitionBy(by).orderBy(F.col(order).asc_nulls_first(), "role", "text")
    numbered = rows.withColumn("pos", F.row_number().over(along) - 1)
    before = F.row_number().over(Window.partitionBy(by, F.xxhash64("role", "text"), "role", "text").orderBy("pos"))
    last = F.regexp_extract("text", rf"(?s)({WORDS})[\x20\x09-\x0D]*\z", 1)
    fault = F.when(~F.col("text").rlike(WORDS), "blank").when(before > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    return numbered.withColumn("fault", fault)


AUDITED = "cost long, audit string"


def _as_arrow(df: DataFrame, names: list[str]) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [pa.field(n, to_arrow_type(df.schema[n].dataType)) for n in names]


def audits(rows: DataFrame, *, by: str = "conv_id") -> DataFrame:
    """``by, cost, audit``: the cheapest edits of each conversation in ``rows`` (of ``faults``). One
    task reads the rows of a conversation in their order, without their texts."""
    modest_batches(rows.sparkSession)
    schema = f"`{by}` {rows.schema[by].dataType.simpleString()}, {AUDITED}"
    out = pa.schema([*_as_arrow(rows, [by]), ("cost", pa.int64()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, path = None, None
        for b in batches:
            made: list[tuple] = []
            for c, pos, initial, fault in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if pos == 0:
                    if path is not None:
                        made.append((conv, *path.end()))
                    conv, path = c, Path()
                path.add(initial, fault in ("blank", "duplicate"), fault == "truncated")
            if made:
                yield _batch(made, out)
        if path is not None:
            yield _batch([(conv, *path.end())], out)

    read = rows.select(by, "pos", F.substring("role", 1, 1).alias("initial"), "fault")
    # Few bytes a row, but work: not to be joined into few tasks.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return read.repartition(parts, by).sortWithinPartitions(by, "pos").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def repaired_turns(rows: DataFrame, found: DataFrame, *, by: str = "conv_id") -> DataFrame:
    """``by, at, role, text, edit``: the turns of the repaired conversations, numbered from 0. Of
    ``found`` (of ``audits``) each letter becomes a row and meets its turn; deleted rows are left out."""
    letters = F.filter(F.split("audit", ""), lambda c: c != "")
    each = found.select(by, F.posexplode(letters).alias("_mr_i", "edit"))
    along = Window.partitionBy(by).orderBy("_mr_i")
    # Rows of the conversation read so far, and turns with the roles in due course so far.
    each = each.withColumn("pos", F.count_if(F.col("edit") != "I").over(along) - 1)
    mine = rows.select(F.col(by).alias("_mr_by"), F.col("pos").alias("_mr_pos"), "role", "text")
    met = each.join(mine, F.col(by).eqNullSafe(F.col("_mr_by")) & (F.col("pos") == F.col("_mr_pos")) & (F.col("edit") != "I"), "left").where("edit <> 'D'")
    system = (F.col("edit") == "K") & (F.substring("role", 1, 1) == "s")
    taken = F.count_if(~system).over(along)
    role = F.when(F.col("edit") == "K", F.col("role")).when(taken % 2 == 1, "user").otherwise("assistant")
    return met.select(by, (F.row_number().over(along) - 1).alias("at"), role.alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")


def digests(turns: DataFrame, *, by: str = "conv_id", order: str = "at") -> DataFrame:
    """``by, repaired_sha256``: of ``role:text`` of all turns, newlines in between. One task reads
    the turns of a conversation in their order and keeps none."""
    modest_batches(turns.sparkSession)
    schema = f"`{by}` {turns.schema[by].dataType.simpleString()}, repaired_sha256 string"
    out = pa.schema([*_as_arrow(turns, [by]), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        for b in batches:
            made: list[tuple] = []
            for c, at, body in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if at == 0:
                    if sha is not None:
                        made.append((conv, sha.hexdigest()))
                    conv, sha = c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(body)
            if made:
                yield _batch(made, out)
        if sha is not None:
            yield _batch([(conv, sha.hexdigest())], out)

    read = turns.select(by, F.col(order).cast("long"), F.concat("role", F.lit(":"), "text").cast("binary").alias("body"))
    return read.repartition(by).sortWithinPartitions(by, order).mapInArrow(run, schema)


def _legal(initial: Column, following: Column) -> Column:
    return F.concat(initial, following).isin("su", "ua", "au")


def repair(turns: DataFrame, *, by: str = "conv_id", order: str = "turn") -> tuple[DataFrame, DataFrame]:
    """A report and the repaired turns of the conversations in ``turns`` (``by, order, role, text``).

    The report has one row per value of ``by`` (null is one): gaps (missing values of ``order``, an
    integer, between the least and the largest; 0 if all are null), blank, duplicate, truncated, illegal
    (neighbours whose role initials are not su, ua or au), cost, audit, repaired_sha256. The turns are those of
    ``repaired_turns``; a conversation of which nothing is left has none, an empty audit or one of D, and the
    hash of an empty string. Null roles and texts are one space, so blank. Repeated rows are
    duplicates; ties in ``order`` go by role and text. Texts of any length are whole. Extra
    columns are ignored. An empty table gives empty results. The turns of one conversation are read
    in one task, in their order: its edits and its hash are one value each.
    """
    rows = checkpoint(faults(turns, by=by, order=order), release=True)
    found = checkpoint(audits(rows, by=by), release=True)
    fixed = checkpoint(repaired_turns(rows, found, by=by), release=True)
    following = F.lead(F.substring("role", 1, 1)).over(Window.partitionBy(by).orderBy("pos"))
    pairs = rows.select(by, order, "fault", (~_legal(F.substring("role", 1, 1), following)).alias("_mr_illegal"))
    kinds = [F.count_if(F.coalesce(F.col("fault") == k, F.lit(False))).alias(k) for k in ("blank", "duplicate", "truncated")]
    span = F.max(order) - F.min(order) + 1
    facts = pairs.groupBy(by).agg(F.coalesce(span - F.countDistinct(order), F.lit(0)).cast("long").alias("gaps"), *kinds, F.count_if(F.coalesce("_mr_illegal", F.lit(False))).alias("illegal"))
    same = lambda other: F.col(by).eqNullSafe(other["_mr_by"])
    of = lambda df: df.withColumnRenamed(by, "_mr_by")
    audited, hashed = of(found), of(digests(fixed, by=by))
    report = facts.join(audited, same(audited)).drop("_mr_by").join(hashed, same(hashed), "left").drop("_mr_by")
    return report.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))), fixed


def with_absent(report: DataFrame, ids: DataFrame, *, by: str = "conv_id") -> DataFrame:
    """``report`` with a row for each value of ``by`` in ``ids``: zeros, an empty audit and the hash of
    an empty string for those that have none."""
    there = report.withColumnRenamed(by, "_mr_by")
    made = ids.select(by).distinct().join(there, F.col(by).eqNullSafe(F.col("_mr_by")), "left").drop("_mr_by")
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return made.select(by, *[F.coalesce(c, empty.get(c, F.lit(0))).alias(c) for c in report.columns if c != by])
