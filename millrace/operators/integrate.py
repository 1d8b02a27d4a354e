"""Integration of two tables: key audit, merge, enrichment, alignment in time.

Whatever joins here is counted by key first: the counts say how many rows come out, which keys
repeat or do not meet, and which are so frequent that their rows are joined in parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.values import quoted
from millrace.sources.scratch import checkpoint, hot_keys, spread_join

#: Rows up to which a table is broadcast after it has been counted.
FEW_ROWS = 100_000
RELATIONS = ("one_to_one", "one_to_many", "many_to_one", "many_to_many")


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _known(on: Sequence[str]):
    found = F.lit(True)
    for c in on:
        found = found & F.col(quoted(c)).isNotNull()
    return found


def key_counts(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``on, n_left, n_right``: rows of each key without nulls on both sides, 0 where there are none."""
    on = _names(on)
    count = lambda df, name: df.where(_known(on)).groupBy(*map(quoted, on)).agg(F.count("*").alias(name))
    return count(left, "n_left").join(count(right, "n_right"), on, "full").na.fill(0, ["n_left", "n_right"])


def merge_audit(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``side, n_rows, n_null_keys, n_keys, n_repeated_keys, most_rows_per_key, n_unmatched_keys,
    n_unmatched_rows, n_matched_rows`` for left and right, a null key being unmatched, and on both rows
    ``relation`` (one_to_one, ...) and ``n_inner``, the rows of the inner join."""
    counts = checkpoint(key_counts(left, right, on), release=True)
    return _audit(counts, left.count(), right.count())


def _audit(counts: DataFrame, n_left: int, n_right: int) -> DataFrame:
    facts = []
    for me, other in (("n_left", "n_right"), ("n_right", "n_left")):
        mine, theirs = F.col(me), F.col(other)
        facts += [F.coalesce(F.sum(mine), F.lit(0)).alias(f"{me}_rows"), F.count_if(mine > 0).alias(f"{me}_keys"), F.count_if(mine > 1).alias(f"{me}_repeated"), F.coalesce(F.max(mine), F.lit(0)).alias(f"{me}_most"), F.count_if((mine > 0) & (theirs == 0)).alias(f"{me}_lone"), F.coalesce(F.sum(F.when(theirs == 0, mine)), F.lit(0)).alias(f"{me}_lone_rows")]
    row = counts.agg(*facts, F.coalesce(F.sum(F.col("n_left").cast("decimal(38,0)") * F.col("n_right")), F.lit(0)).cast("long").alias("n_inner")).first()
    relation = ("many" if row["n_left_most"] > 1 else "one") + "_to_" + ("many" if row["n_right_most"] > 1 else "one")
    made = []
    for side, me, n in (("left", "n_left", n_left), ("right", "n_right", n_right)):
        null = n - row[f"{me}_rows"]
        lone = row[f"{me}_lone_rows"] + null
        made.append((side, n, null, row[f"{me}_keys"], row[f"{me}_repeated"], row[f"{me}_most"], row[f"{me}_lone"], lone, n - lone, relation, row["n_inner"]))
    schema = "side string, n_rows long, n_null_keys long, n_keys long, n_repeated_keys long, most_rows_per_key long, n_unmatched_keys long, n_unmatched_rows long, n_matched_rows long, relation string, n_inner long"
    return counts.sparkSession.createDataFrame(made, schema)


def merge(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", *, relation: str | None = None, suffixes: tuple[str, str] = ("_left", "_right"), max_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The join of two tables by equal keys, and its ``merge_audit``.

    ``how`` is inner, left, right or full. Null keys meet nothing. Columns of one name, other than the keys, get
    the suffixes. With ``relation`` another relation of the keys is a ValueError (what is true of one_to_one is true
    of all), with ``max_rows`` a result of more rows is, before anything is joined. The side that is counted to
    be small is broadcast where the join allows it; else rows under frequent keys of the larger side are dealt
    to parts and those of the other side copied to each part.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"how: {how}")
    if relation is not None and relation not in RELATIONS:
        raise ValueError(f"relation: {relation}")
    on = _names(on)
    clash = [c for c in left.columns if c in right.columns and c not in on]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    counts = checkpoint(key_counts(left, right, on), release=True)
    n_left, n_right = left.count(), right.count()
    audit = _audit(counts, n_left, n_right)
    facts = {r["side"]: r for r in audit.collect()}  # two rows
    found = facts["left"]["relation"]
    if relation is not None and any(x == "many" and y == "one" for x, y in zip(found.split("_to_"), relation.split("_to_"), strict=True)):
        raise ValueError(f"keys are {found}, not {relation}")
    total = facts["left"]["n_inner"] + (facts["left"]["n_unmatched_rows"] if how in ("left", "full") else 0) + (facts["right"]["n_unmatched_rows"] if how in ("right", "full") else 0)
    if max_rows is not None and total > max_rows:
        raise ValueError(f"{total} rows, over {max_rows}")
    if how == "right":
        made = _joined(b, a, on, "left", counts, "n_right", n_left)
    elif how == "full":
        rest = _joined(b, a.select(*map(quoted, on)), on, "left_anti", counts, "n_right", n_left)
        made = _joined(a, b, on, "left", counts, "n_left", n_right).unionByName(rest, allowMissingColumns=True)
    elif how == "inner" and n_right > n_left:
        made = _joined(b, a, on, "inner", counts, "n_right", n_left)
    else:
        made = _joined(a, b, on, how, counts, "n_left", n_right)
    return made.select(*map(quoted, [*on, *[c for c in a.columns if c not in on], *[c for c in b.columns if c not in on]])), audit


def _joined(one: DataFrame, other: DataFrame, on: list[str], how: str, counts: DataFrame, n: str, size: int) -> DataFrame:
    few = size <= FEW_ROWS
    return spread_join(one, other, on, None if few else hot_keys(counts.where(F.col(n) > 0), on, n), how, broadcast=few)


def enrich(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """All rows once, with ``columns`` (all, if None) of the one row of ``lookup`` with their key, or nulls; and
    the ``merge_audit``. A lookup with repeated keys is a ValueError: it would multiply rows."""
    on = _names(on)
    wanted = [c for c in (columns or lookup.columns) if c not in on]
    made, audit = merge(df, lookup.select(*map(quoted, [*on, *wanted])), on, "left", relation="many_to_one", suffixes=("", "_lookup"))
    return made, audit


def align_asof(left: DataFrame, right: DataFrame, on: str | Sequence[str], time: str, right_time: str | None = None, *, columns: Sequence[str] | None = None, tolerance: str | None = None, suffix: str = "_asof") -> DataFrame:
    """Each row of ``left`` once, with ``columns`` (all others, if None) of the latest row of ``right`` with its key and
    a time not after its own, named with ``suffix``, and that time as ``<right_time><suffix>``. Of right rows at one time
    the last by their columns counts. Nulls where there is none, where a key or time is null, or where the latest is
    older than ``tolerance`` (an interval, '2 hours').

    Both tables are put in one order of key and time, in ranges of about equal size, so a frequent key makes several
    ranges. Within a range the last right row so far is carried on; at its start stands the last of the ranges before,
    which a small table of ranges gives. No row meets more than one other.
    """
    on, right_time = _names(on), right_time or time
    wanted = [c for c in (columns or right.columns) if c not in on and c != right_time]
    if any(c in left.columns for c in (f"{c}{suffix}" for c in [*wanted, right_time])):
        raise ValueError("a column of that name is there already; take another suffix")
    facts = F.struct(F.col(quoted(right_time)).alias("t"), *[F.col(quoted(c)).alias(f"_{i}") for i, c in enumerate(wanted)])
    usable = _known(on) & F.col(quoted(right_time)).isNotNull()
    kinds = dict(right.select(facts.alias("x")).dtypes)["x"]
    keys = [F.col(quoted(c)).alias(f"_k{i}") for i, c in enumerate(on)]
    ours = left.where(_known(on) & F.col(quoted(time)).isNotNull()).select(*keys, F.col(quoted(time)).alias("_t"), F.lit(1).alias("_side"), F.struct(*map(quoted, left.columns)).alias("_row"), F.lit(None).cast(kinds).alias("_last"))
    theirs = right.where(usable).select(*keys, F.col(quoted(right_time)).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(ours.schema["_row"].dataType).alias("_row"), facts.alias("_last"))
    names = [f"_k{i}" for i in range(len(on))]
    both = ours.unionByName(theirs)
    # Right rows come first at equal times; of those the last stands.
    ranged = checkpoint(both.repartitionByRange(*names, "_t", "_side").withColumn("_range", F.spark_partition_id()))
    so_far = Window.partitionBy(*names, "_range").orderBy("_t", "_side", "_last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Keys in several ranges: at most two for each range, so few rows.
    ends = ranged.groupBy(*names, "_range").agg(F.max("_last").alias("_end"))
    over = Window.partitionBy(*names)
    before = over.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("_n", F.count("*").over(over)).where("_n > 1").select(*names, "_range", F.last("_end", True).over(before).alias("_start"))
    carried = ranged.withColumn("_now", F.last("_last", True).over(so_far)).where("_side = 1").join(F.broadcast(checkpoint(starts)), [*names, "_range"], "left")
    found = F.coalesce("_now", "_start")
    if tolerance is not None:
        found = F.when(F.col("_t") <= found["t"] + F.expr(f"interval {tolerance}"), found)
    made = carried.select("_row", found.alias("_f"))
    rest = left.where(~_known(on) | F.col(quoted(time)).isNull()).select(F.struct(*map(quoted, left.columns)).alias("_row"), F.lit(None).cast(kinds).alias("_f"))
    added = [F.col("_f.t").alias(right_time + suffix), *[F.col(f"_f._{i}").alias(c + suffix) for i, c in enumerate(wanted)]]
    return made.unionByName(rest).select("_row.*", *added)
