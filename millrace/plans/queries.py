"""Registered queries of the library's own operators, each with its SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import drift, explore, profile
from millrace.operators import cluster, integrate, interpret, prepare, quality
from millrace.operators.prepare import Prepare
from millrace.sources import tables
from millrace.sources.scratch import checkpoint, scratch
from millrace.streaming.score import score_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Events with nulls, sentinels and untidy text.
EV = """SELECT event_id, ts, user_id, event_type, props,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS amount,
  CASE WHEN event_type = 'error' OR event_id % 10 = 0 THEN NULL ELSE concat('ch', CAST(user_id % 4 AS VARCHAR(20))) END AS channel,
  CASE WHEN event_id % 11 = 0 THEN 1000000 + user_id WHEN event_id % 23 = 0 THEN -1 ELSE user_id END AS hashed,
  CASE WHEN event_id % 25 = 0 THEN 'closed' ELSE NULL END AS action,
  CASE WHEN event_id % 13 = 0 THEN concat(' ', event_type) WHEN event_id % 17 = 0 THEN upper(event_type)
       WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS raw_type
FROM events"""
#: Line items, the earlier ones tagged train, the later ones test.
LI = "SELECT *, CASE WHEN l_shipdate < TIMESTAMP '1999-01-01 00:00:00' THEN 'train' ELSE 'test' END AS source FROM lineitem"
NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            views = re.search(r"(FROM|JOIN) (li|ev)\b", sql)
            rest = sql.replace("WITH ", ", ", 1) if sql.startswith("WITH ") else f" {sql}"
            ORACLE_SQL[f.__name__] = f"WITH li AS ({LI}), ev AS ({EV}){rest}" if views else sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, f"{d}/{name}.parquet")


def ev(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    i, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "props",
        F.when(i % 7 != 0, F.col("value")).alias("amount"),
        F.when((t == "error") | (i % 10 == 0), None).otherwise(F.concat(F.lit("ch"), (u % 4).cast("string"))).alias("channel"),
        F.when(i % 11 == 0, 1000000 + u).when(i % 23 == 0, -1).otherwise(u).alias("hashed"),
        F.when(i % 25 == 0, "closed").alias("action"),
        F.when(i % 13 == 0, F.concat(F.lit(" "), t)).when(i % 17 == 0, F.upper(t)).when(i % 19 == 0, None).otherwise(t).alias("raw_type"),
    )


def halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    items = table(spark, d, "lineitem")
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    return items.where(early), items.where(~early)


def li(spark: SparkSession, d: str) -> DataFrame:
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    return table(spark, d, "lineitem").withColumn("source", F.when(early, "train").otherwise("test"))


def union_sql(template: str, names: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c, i=i) for i, c in enumerate(names))


def values_sql(rows: list[tuple], **columns: str) -> str:
    """A constant table, for facts about schemas."""
    said = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"
    cells = ", ".join("(" + ", ".join(map(said, r)) + ")" for r in rows)
    return "SELECT " + ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in columns.items()) + f" FROM (VALUES {cells}) t({', '.join(columns)})"


#: Schemas of the given tables.
LINEITEM = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


# Sources -----------------------------------------------------------------------------------


@query("SELECT count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_quantity, round(sum(l_extendedprice), 2) AS sum_price FROM lineitem")
def scan_full(spark, d):
    return tables.read_table(spark, f"{d}/lineitem.parquet").agg(F.count("*").alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("sum_quantity"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"))


def as_csv(spark: SparkSession, d: str, name: str) -> str:
    path = scratch(spark, f"csv-{name}")
    table(spark, d, name).write.option("header", True).csv(path)
    return path


CSV_FACTS = "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, round(sum(l_quantity), 2) AS sum_quantity, round(sum(l_extendedprice), 2) AS sum_price, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, max(l_returnflag) AS last_flag FROM lineitem"


def csv_facts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct("l_orderkey").alias("n_orders"), F.round(F.sum("l_quantity"), 2).alias("sum_quantity"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"), F.min("l_shipdate").cast("timestamp_ntz").alias("first_ship"), F.max("l_shipdate").cast("timestamp_ntz").alias("last_ship"), F.max("l_returnflag").alias("last_flag"))


@query(CSV_FACTS)
def scan_csv(spark, d):
    return csv_facts(tables.read_csv(spark, as_csv(spark, d, "lineitem"), schema=table(spark, d, "lineitem").schema))


@query(CSV_FACTS)
def scan_csv_inferred(spark, d):
    return csv_facts(tables.read_csv(spark, as_csv(spark, d, "lineitem")))


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def sample_head(spark, d):
    return tables.read_table(spark, f"{d}/orders.parquet", mode="sample", method="head", n=100, order_by="o_orderkey")


@query("SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 100")
def sample_tail(spark, d):
    return tables.read_table(spark, f"{d}/orders.parquet", mode="sample", method="tail", n=100, order_by="o_orderkey")


@query()
def sample_random(spark, d):
    return tables.read_table(spark, f"{d}/orders.parquet", mode="sample", n=1000, key="o_orderkey")


@query("SELECT least(1000, count(*)) AS n_rows, least(1000, count(*)) AS n_keys, least(1000, count(*)) AS n_members FROM orders")
def sample_random_counts(spark, d):
    orders = table(spark, d, "orders")
    drawn = tables.read_table(spark, f"{d}/orders.parquet", mode="sample", n=1000, key="o_orderkey")
    known = orders.select("o_orderkey", F.lit(1).alias("member"))
    return drawn.join(known, "o_orderkey", "left").agg(F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"), F.count("member").alias("n_members"))


@query("SELECT o_orderpriority, CAST(greatest(1, round(500 * count(*) / sum(count(*)) OVER ())) AS BIGINT) AS n FROM orders GROUP BY 1")
def sample_stratified(spark, d):
    return tables.sample_stratified(table(spark, d, "orders"), 500, "o_orderpriority", "o_orderkey").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_quantity FROM li GROUP BY 1")
def combine_sources(spark, d):
    return tables.combine(*halves(spark, d)).groupBy("source").agg(F.count("*").alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("sum_quantity"))


@query("SELECT count(*) AS n_rows, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key FROM li WHERE source = 'test'")
def filter_by_source(spark, d):
    return tables.of_source(tables.combine(*halves(spark, d)), "test").agg(F.count("*").alias("n_rows"), F.min("l_orderkey").alias("min_key"), F.max("l_orderkey").alias("max_key"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_parquet_cols(spark, d):
    return tables.read_parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


@query("SELECT source, count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM li GROUP BY 1")
def split_shapes(spark, d):
    return tables.split_shapes(li(spark, d))


def sides_sql(column: str, numeric: bool) -> str:
    side = lambda name, tag: f"(SELECT count(*) AS n_rows_{tag}, count({column}) AS n_known_{tag}, {f'avg({column})' if numeric else 'CAST(NULL AS DOUBLE)'} AS mean_{tag}, {f'stddev_samp({column})' if numeric else 'CAST(NULL AS DOUBLE)'} AS std_{tag} FROM li WHERE source = '{name}')"
    return f"SELECT '{column}' AS column_name, * FROM {side('train', 'first')}, {side('test', 'second')}"


@query(f"SELECT column_name, 'BOTH' AS status, n_rows_first, n_known_first, round(mean_first, 6) AS mean_first, round(std_first, 6) AS std_first, n_rows_second, n_known_second, round(mean_second, 6) AS mean_second, round(std_second, 6) AS std_second, round(mean_second - mean_first, 6) AS mean_diff, round(std_second - std_first, 6) AS std_diff, round(n_known_second / n_rows_second - n_known_first / n_rows_first, 6) AS known_share_diff, round((mean_second - mean_first) / sqrt((std_first * std_first + std_second * std_second) / 2), 6) AS standardised_diff FROM ({' UNION ALL '.join([*[sides_sql(c, True) for c in NUMERICS], sides_sql('l_returnflag', False)])}) WHERE EXISTS (SELECT 1 FROM li)")
def split_statistics(spark, d):
    """Statistics of both splits, written, and compared from what was written."""
    saved = checkpoint(profile.split_moments(li(spark, d).select(*NUMERICS, "l_returnflag", "source"), "source"))
    made = profile.compare_splits(saved)
    return made.withColumns({c: F.round(c, 6) for c, kind in made.dtypes if kind == "double"})


# Exploration ---------------------------------------------------------------------------------


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_l_orderkey, count(DISTINCT l_partkey) AS n_l_partkey, count(DISTINCT l_shipdate) AS n_l_shipdate FROM lineitem WHERE l_suppkey = 11")
def point_filter_counts(spark, d):
    return explore.distinct_counts(table(spark, d, "lineitem"), F.col("l_suppkey") == 11, ["l_orderkey", "l_partkey", "l_shipdate"])


@query("SELECT DISTINCT * FROM events WHERE user_id = 8 ORDER BY ts")
def distinct_rows_sorted(spark, d):
    return explore.distinct_rows(table(spark, d, "events"), F.col("user_id") == 8, ["ts"])


@query(values_sql([(i, c, t) for i, (c, t) in enumerate(LINEITEM.items())], position="INT", column_name="VARCHAR", column_type="VARCHAR"))
def describe_schema(spark, d):
    return explore.describe_schema(table(spark, d, "lineitem"))


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_l_orderkey, count(DISTINCT l_linenumber) AS n_l_linenumber, count(DISTINCT (l_orderkey, l_linenumber)) AS n_composite FROM lineitem")
def key_audit(spark, d):
    return explore.key_audit(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS n_groups, count(*) FILTER (WHERE n > 1) AS n_inconsistent FROM (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1)")
def label_consistency(spark, d):
    return explore.label_consistency(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


@query("SELECT quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.99) AS p99, max(n) AS max_n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def fanout_quantiles(spark, d):
    return explore.fanout_quantiles(table(spark, d, "lineitem"), "l_orderkey")


EV_COLUMNS = ["event_id", "ts", "user_id", "event_type", "props", "amount", "channel", "hashed", "action", "raw_type"]


@query(union_sql("SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, round(count({c}) * 100.0 / count(*), 4) AS pct_complete FROM ev", EV_COLUMNS))
def completeness_long(spark, d):
    return explore.completeness(ev(spark, d))


@query("SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL ORDER BY 1")
def distinct_values(spark, d):
    return explore.distinct_values(table(spark, d, "orders"), "o_orderpriority")


@query("SELECT count(DISTINCT p_size) AS n_distinct, min(p_size) AS min_value, max(p_size) AS max_value FROM part")
def distinct_min_max(spark, d):
    return explore.distinct_min_max(table(spark, d, "part"), "p_size")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 20")
def topk_frequency(spark, d):
    return explore.topk_frequency(table(spark, d, "part"), "p_brand", 20)


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS n FROM orders GROUP BY 1, 2")
def calendar_rollup(spark, d):
    return explore.calendar_rollup(table(spark, d, "orders"), "o_orderdate")


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1")
def calendar_month_trunc(spark, d):
    return explore.month_trunc(table(spark, d, "orders"), "o_orderdate")


@query("SELECT CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def calendar_day_hour(spark, d):
    return explore.calendar_rollup(table(spark, d, "events"), "ts", ["day", "hour"])


@query("SELECT *, CASE WHEN uniqueness_pct > 90 THEN 'id' WHEN uniqueness_pct < 10 THEN 'categorical' ELSE 'mixed' END AS kind FROM ("
       + union_sql("SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count({c}) AS n_total, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, round(count(DISTINCT {c}) * 100.0 / count({c}), 4) AS uniqueness_pct FROM lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]) + ")")
def id_likeness(spark, d):
    return explore.id_likeness(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


#: Two fifths of the rows hold small values, so the mean is between a half and two thirds of the median.
MIXED = "CASE WHEN l_suppkey % 5 < 2 THEN l_linenumber ELSE 1000 + l_quantity END AS l_mixed"
SHAPES = [*NUMERICS, "l_mixed"]


def shapes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").withColumn("l_mixed", F.when(F.col("l_suppkey") % 5 < 2, F.col("l_linenumber").cast("double")).otherwise(1000 + F.col("l_quantity")))


@query("SELECT column_name, round(a, 4) AS min_value, round(q1, 4) AS q25, round(median, 4) AS median, round(q3, 4) AS q75, round(z, 4) AS max_value, round(mean, 4) AS mean, round(s, 4) AS std, CASE WHEN mean > median * 1.5 THEN 'SKEWED_RIGHT' ELSE 'SYMMETRIC' END AS distribution_shape FROM ("
       + union_sql("SELECT '{c}' AS column_name, min({c}) AS a, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3, max({c}) AS z, avg({c}) AS mean, stddev({c}) AS s FROM (SELECT *, " + MIXED + " FROM lineitem)", SHAPES) + ")")
def distribution_shape(spark, d):
    return explore.distribution_shape(shapes(spark, d), SHAPES)


@query("SELECT source, count(DISTINCT l_suppkey) AS n_distinct, count(*) AS n_rows FROM li GROUP BY 1")
def distinct_per_source(spark, d):
    return explore.distinct_per_source(li(spark, d), "l_suppkey")


@query("SELECT *, CASE WHEN n_test = 0 THEN 'TRAIN_ONLY' WHEN n_train = 0 THEN 'TEST_ONLY' ELSE 'BOTH' END AS presence FROM (SELECT CAST(year(l_shipdate) AS INT) AS category, count(*) FILTER (WHERE source = 'train') AS n_train, count(*) FILTER (WHERE source = 'test') AS n_test FROM li GROUP BY 1)")
def category_presence(spark, d):
    return explore.category_presence(li(spark, d).withColumn("year", F.year("l_shipdate")), "year")


@query("SELECT 'original' AS form, count(DISTINCT raw_type) AS n_distinct FROM ev UNION ALL SELECT 'lower', count(DISTINCT lower(raw_type)) FROM ev UNION ALL SELECT 'trim', count(DISTINCT trim(raw_type)) FROM ev UNION ALL SELECT 'lower_trim', count(DISTINCT lower(trim(raw_type))) FROM ev")
def normalisation_impact(spark, d):
    return explore.normalisation_impact(ev(spark, d), "raw_type")


@query("SELECT raw_type AS value, count(*) AS n, CASE WHEN raw_type <> trim(raw_type) THEN 'WHITESPACE' WHEN raw_type <> lower(raw_type) THEN 'CASE' WHEN raw_type IS NULL THEN 'NULL' ELSE 'OK' END AS issue FROM ev GROUP BY 1 HAVING issue <> 'OK'")
def problem_values(spark, d):
    return explore.problem_values(ev(spark, d), "raw_type")


@query("SELECT column_name, n_distinct, uniqueness_pct, range_ratio, distribution_shape, CASE WHEN uniqueness_pct > 50 THEN 'NO: ID (high uniqueness)' WHEN n_distinct < 100 THEN 'NO: CATEGORICAL (low unique count)' WHEN distribution_shape = 'SYMMETRIC' THEN 'NO: symmetric distribution' WHEN range_ratio < 10 THEN 'NO: narrow range' ELSE 'YES: log transform candidate' END AS log_transform_decision FROM (SELECT column_name, n_distinct, round(n_distinct * 100.0 / n_total, 2) AS uniqueness_pct, round(z / nullif(a, 0), 2) AS range_ratio, CASE WHEN mean > median * 1.5 THEN 'SKEWED_RIGHT' WHEN mean < median * 0.5 THEN 'SKEWED_LEFT' ELSE 'SYMMETRIC' END AS distribution_shape FROM ("
       + union_sql("SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count(*) AS n_total, min({c}) AS a, max({c}) AS z, quantile_cont({c}, 0.5) AS median, avg({c}) AS mean FROM (SELECT *, " + MIXED + " FROM lineitem)", SHAPES)
       + ")) ORDER BY CASE WHEN log_transform_decision LIKE 'YES%' THEN 1 ELSE 2 END, uniqueness_pct DESC, column_name")
def log_candidates(spark, d):
    return explore.log_candidates(shapes(spark, d), SHAPES)


@query("SELECT event_type AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def class_share(spark, d):
    return explore.class_share(table(spark, d, "events"), "event_type")


@query("SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1")
def hour_histogram(spark, d):
    return explore.hour_histogram(table(spark, d, "events"), "ts")


# Profiles ------------------------------------------------------------------------------------

EV_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "props": "string", "amount": "double", "channel": "string", "hashed": "bigint", "action": "string", "raw_type": "string"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, round(100.0 * (count(*) - count({c})) / count(*), 4) AS pct_null, count(DISTINCT {c}) AS n_distinct, '{t}' AS dtype FROM ev" for c, t in EV_TYPES.items()))
def schema_table(spark, d):
    return profile.schema_table(ev(spark, d))


@query(union_sql("SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM lineitem", NUMERICS))
def describe_numeric(spark, d):
    return profile.describe_numeric(table(spark, d, "lineitem"), NUMERICS)


@query(" UNION ALL ".join(f"(SELECT '{c}' AS column_name, CAST(sum(n) OVER () AS BIGINT) AS count, count(*) OVER () AS n_distinct, {c} AS top, n AS freq FROM (SELECT {c}, count(*) AS n FROM ev WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, {c} LIMIT 1)" for c in ("event_type", "channel", "raw_type")))
def describe_object(spark, d):
    return profile.describe_text(ev(spark, d), ["event_type", "channel", "raw_type"])


STATS = "count({c}) AS count, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS std"


@query(union_sql("SELECT '{c}' AS column_name, " + STATS + " FROM lineitem", NUMERICS))
def basic_stats(spark, d):
    return profile.basic_stats(table(spark, d, "lineitem"), NUMERICS)


@query(union_sql("SELECT source, '{c}' AS column_name, " + STATS + " FROM li GROUP BY 1", NUMERICS))
def basic_stats_by_source(spark, d):
    return profile.basic_stats(li(spark, d), NUMERICS, by=["source"])


@query("SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates, round(100.0 * sum(n - 1) / sum(n), 4) AS pct_duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def duplicates_summary(spark, d):
    return profile.duplicates_summary(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS n_duplicates, round(100.0 * sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n), 4) AS pct_duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def duplicates_keep_false(spark, d):
    return profile.duplicates_summary(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], keep=False)


@query("WITH c AS (SELECT CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE) AS line, CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS ord, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS customer FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT 'n_line' AS fact, line AS value, CAST(NULL AS DOUBLE) AS deviation FROM c UNION ALL SELECT 'n_order', ord, NULL FROM c UNION ALL SELECT 'n_customer', customer, NULL FROM c UNION ALL SELECT 'line_per_order', round(line / ord, 2), round(round(line / ord, 2) - 4.0, 2) FROM c UNION ALL SELECT 'order_per_customer', round(ord / customer, 2), NULL FROM c")
def hierarchy_profile(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return profile.hierarchy_profile(rows, {"line": ["l_orderkey", "l_linenumber"], "order": "l_orderkey", "customer": "o_custkey"}, {("line", "order"): 4.0})


LI_COLUMNS = {"l_orderkey": 1, "l_partkey": 1, "l_suppkey": 1, "l_linenumber": 1, "l_quantity": 0, "l_extendedprice": 0, "l_discount": 0, "l_tax": 0, "l_returnflag": 0, "l_linestatus": 0, "l_shipdate": 0}


@query("SELECT column_name, n_distinct, CASE WHEN n_distinct <= 20 THEN 'low' WHEN n_distinct <= 1000 THEN 'medium' ELSE 'high' END AS cardinality, whole = 1 AND n_distinct > 1000 AS pseudo_categorical FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, {w} AS whole FROM lineitem" for c, w in LI_COLUMNS.items()) + ")")
def column_metadata(spark, d):
    return profile.column_metadata(table(spark, d, "lineitem"))


@query(values_sql([(c, t, None if c == "o_orderstatus" else "float" if c == "o_totalprice" else t, {"o_orderstatus": "MISSING_IN_TEST", "o_totalprice": "TYPE_DIFFERS", "o_orderkey": "OK", "o_custkey": "OK"}.get(c, "ORDER_DIFFERS")) for c, t in ORDERS.items()] + [("usage", None, "string", "MISSING_IN_TRAIN")], column_name="VARCHAR", train_type="VARCHAR", test_type="VARCHAR", status="VARCHAR"))
def schema_compare(spark, d):
    orders = table(spark, d, "orders")
    return profile.schema_compare(orders, orders.withColumn("o_totalprice", F.col("o_totalprice").cast("float")).drop("o_orderstatus").withColumn("usage", F.lit("x")))


@query("SELECT value, n, round(n / t, 6) AS share FROM (SELECT value, count(*) AS n, sum(count(*)) OVER () AS t FROM (SELECT unnest(string_split(p_name, ' ')[1:10]) AS value FROM part) WHERE value <> '' GROUP BY 1) WHERE n / t >= 0.001 ORDER BY n DESC, value LIMIT 20")
def multi_value_frequency(spark, d):
    return profile.multi_value_frequency(table(spark, d, "part"), "p_name", delimiter=" ")


@query(" UNION ALL ".join(f"(SELECT '{c}' AS column_name, value, n, CAST(rank AS INT) AS rank, n_distinct, n_distinct > 10000 AS over_threshold FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS rank, count(*) OVER () AS n_distinct FROM orders WHERE {c} IS NOT NULL GROUP BY 1) WHERE rank <= 20)" for c in ("o_custkey", "o_orderstatus", "o_orderpriority")))
def cardinality_profile(spark, d):
    return profile.cardinality_profile(table(spark, d, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("SELECT value, n, round(n / sum(n) OVER (), 6) AS share, CAST(sum(CASE WHEN lower(value) = 'none' THEN n ELSE 0 END) OVER () AS BIGINT) AS n_none_text, round(max(n) OVER () / min(n) OVER (), 4) AS imbalance_ratio FROM (SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1)")
def target_distribution(spark, d):
    return profile.target_distribution(table(spark, d, "events"), "event_type")


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(count(DISTINCT {c}) / count(*), 4) AS uniqueness, {'true' if c.endswith('key') else 'false'} AS by_name, round(count(DISTINCT {c}) / count(*), 4) >= 0.95 AS by_uniqueness FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")) + ") WHERE by_name OR by_uniqueness")
def id_columns(spark, d):
    return profile.id_columns(table(spark, d, "orders"), ["*key"])


@query("SELECT event_type, 'amount' AS column_name, round(100.0 * avg(CASE WHEN amount IS NULL THEN 1 ELSE 0 END), 2) AS pct_null FROM ev WHERE event_type IN ('click', 'error') GROUP BY 1 UNION ALL SELECT event_type, 'channel', round(100.0 * avg(CASE WHEN channel IS NULL THEN 1 ELSE 0 END), 2) FROM ev WHERE event_type = 'error' GROUP BY 1")
def conditional_sparsity(spark, d):
    return profile.conditional_sparsity(ev(spark, d), "event_type", {"click": ["amount"], "error": ["amount", "channel"]})


NULLS = union_sql("SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_rows, round(100.0 * (count(*) - count({c})) / count(*), 4) AS pct_null FROM ev", EV_COLUMNS)


@query(f"SELECT * FROM ({NULLS}) UNION ALL SELECT NULL, CAST(sum(n_null) AS BIGINT), CAST(sum(n_rows) AS BIGINT), round(100.0 * sum(n_null) / sum(n_rows), 4) FROM ({NULLS})")
def completeness_report(spark, d):
    return profile.completeness_report(ev(spark, d))


@query(f"SELECT * FROM ({NULLS}) ORDER BY n_null DESC, column_name LIMIT 3")
def missingness_top(spark, d):
    return profile.missingness_top(ev(spark, d), 3)


@query("SELECT 'hashed' AS column_name, CAST(hashed AS VARCHAR) AS sentinel, count(*) AS n FROM ev WHERE hashed IN (-1, 1000008, 999) GROUP BY 1, 2")
def sentinel_counts(spark, d):
    return profile.sentinel_counts(ev(spark, d), ["hashed"], [-1, 1000008, 999])


@query("SELECT 'l_linestatus' AS column_name, value, target, round(share, 6) AS max_share, n AS support, share >= 0.95 AS leak FROM (SELECT l_linestatus AS value, l_returnflag AS target, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY l_linestatus) AS share FROM lineitem GROUP BY 1, 2) ORDER BY share DESC, n DESC, value, target LIMIT 1")
def leakage_crosstab(spark, d):
    return profile.leakage_crosstab(table(spark, d, "lineitem"), "l_returnflag", ["l_linestatus"])


@query("SELECT column_name, round(s, 6) AS missing_share FROM (SELECT 'action' AS column_name, avg(CASE WHEN action IS NULL THEN 1 ELSE 0 END) AS s FROM ev UNION ALL SELECT 'channel', avg(CASE WHEN channel IS NULL THEN 1 ELSE 0 END) FROM ev) WHERE s >= 0.9")
def post_event_columns(spark, d):
    return profile.post_event_columns(ev(spark, d), ["action", "channel"])


@query("SELECT min(ts) AS first_ts, max(ts) AS last_ts, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) AS BIGINT) AS n_days, CAST(0 AS BIGINT) AS n_invalid, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) >= 14 AS valid, CASE WHEN floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) < 14 THEN 'range too short' END AS reason FROM events")
def timestamp_range(spark, d):
    return profile.timestamp_range(table(spark, d, "events"), "ts", 14)


@query(values_sql([("o_orderkey", "id"), ("o_custkey", "id"), ("o_orderdate", "time"), ("o_orderpriority", "target"), ("o_orderpriority", "category"), ("o_orderstatus", "category"), ("o_totalprice", "uncategorized")], column_name="VARCHAR", role="VARCHAR"))
def column_catalog(spark, d):
    return profile.column_catalog(table(spark, d, "orders"), {"id": ["*key"], "time": ["*date"], "target": ["o_orderpriority"], "category": ["o_orderpriority", "o_orderstatus"]})


@query("WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, (max(o_totalprice) - min(o_totalprice)) / 30 AS w FROM orders), g AS (SELECT CAST(i AS INT) AS bin, lo + i * w AS a, lo + (i + 1) * w AS z FROM e, range(30) t(i)) SELECT bin, round(a, 4) AS left_edge, round(z, 4) AS right_edge, count(o_totalprice) AS n FROM g LEFT JOIN orders ON (o_totalprice >= a OR bin = 0) AND (o_totalprice < z OR bin = 29) GROUP BY 1, 2, 3")
def numeric_histogram(spark, d):
    return profile.numeric_histogram(table(spark, d, "orders"), "o_totalprice")


@query(" UNION ALL ".join(f"(SELECT '{c}' AS column_name, {c} AS value, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INT) AS rank FROM part GROUP BY {c} ORDER BY 4 LIMIT 20)" for c in ("p_brand", "p_type")))
def categorical_top20(spark, d):
    return profile.top_values(table(spark, d, "part"), ["p_brand", "p_type"])


@query("WITH c AS (SELECT date_trunc('day', ts) AS b, count(*) AS n FROM events GROUP BY 1), g AS (SELECT unnest(generate_series(CAST(min(b) AS TIMESTAMP), CAST(max(b) AS TIMESTAMP), INTERVAL 1 DAY)) AS bucket FROM c) SELECT bucket, coalesce(n, 0) AS n FROM g LEFT JOIN c ON bucket = CAST(b AS TIMESTAMP)")
def daily_counts(spark, d):
    return profile.time_counts(table(spark, d, "events"), "ts")


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def target_by_category(spark, d):
    return profile.target_by_category(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


@query("SELECT count(*) AS n_rows, round(avg(hour(ts)), 6) AS mean_hour, round(stddev(hour(ts)), 6) AS std_hour, CAST(min(hour(ts)) AS INT) AS min_hour, CAST(max(hour(ts)) AS INT) AS max_hour FROM events")
def hour_stats(spark, d):
    return profile.hour_stats(table(spark, d, "events"), "ts")


@query("SELECT column_name, n_distinct, CASE WHEN n_distinct <= 20 THEN 'low' WHEN n_distinct <= 1000 THEN 'medium' ELSE 'high' END AS cardinality, whole = 1 AND n_distinct > 1000 AS pseudo_categorical FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, {w} AS whole FROM lineitem" for c, w in LI_COLUMNS.items()) + ") ORDER BY n_distinct DESC, column_name LIMIT 5")
def top_cardinality(spark, d):
    return profile.top_cardinality(table(spark, d, "lineitem"), 5)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice - l_quantity * 1000 AS residual FROM lineitem")
def residuals(spark, d):
    rows = table(spark, d, "lineitem").withColumn("predicted", F.col("l_quantity") * 1000)
    return profile.residuals(rows, "l_extendedprice", "predicted").select("l_orderkey", "l_linenumber", "residual")


# Drift ---------------------------------------------------------------------------------------


def long_sql(columns: list[str], source: str = "li") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS c, CAST({c} AS DOUBLE) AS v, source = 'train' AS e FROM {source} WHERE {c} IS NOT NULL" for c in columns)


def psi_sql(long: str) -> str:
    inner = " + ".join(f"CASE WHEN v >= lo + {i} * ((hi - lo) / 10) THEN 1 ELSE 0 END" for i in range(1, 10))
    return (
        f"psi_x AS ({long}), psi_ends AS (SELECT c, min(v) AS lo, max(v) AS hi, count(*) FILTER (WHERE e) AS ne, count(*) FILTER (WHERE NOT e) AS na FROM psi_x GROUP BY 1), "
        f"psi_counts AS (SELECT c, {inner} AS b, count(*) FILTER (WHERE e) AS ke, count(*) FILTER (WHERE NOT e) AS ka FROM psi_x JOIN psi_ends USING (c) GROUP BY 1, 2), "
        "psi_shares AS (SELECT c, greatest(coalesce(ke, 0) / ne, 1e-6) AS pe, greatest(coalesce(ka, 0) / na, 1e-6) AS pa FROM (SELECT c, ne, na, CAST(i AS INT) AS b FROM psi_ends, range(10) t(i)) LEFT JOIN psi_counts USING (c, b)), "
        "psi_out AS (SELECT c, sum((pa - pe) * ln(pa / pe)) AS psi FROM psi_shares GROUP BY 1)"
    )


def ks_sql(long: str) -> str:
    return (
        f"ks_x AS ({long}), ks_counts AS (SELECT c, v, count(*) FILTER (WHERE e) AS ke, count(*) FILTER (WHERE NOT e) AS ka FROM ks_x GROUP BY 1, 2), "
        "ks_run AS (SELECT c, sum(ke) OVER w / sum(ke) OVER (PARTITION BY c) AS fe, sum(ka) OVER w / sum(ka) OVER (PARTITION BY c) AS fa FROM ks_counts WINDOW w AS (PARTITION BY c ORDER BY v)), "
        "ks_n AS (SELECT c, count(*) FILTER (WHERE e) AS ne, count(*) FILTER (WHERE NOT e) AS na FROM ks_x GROUP BY 1), "
        "ks_d AS (SELECT c, max(abs(fe - fa)) AS ks FROM ks_run GROUP BY 1), ks_t AS (SELECT c, ks, ks * ks * ne * na / (ne + na) AS t2 FROM ks_d JOIN ks_n USING (c)), "
        "ks_out AS (SELECT c, ks, CASE WHEN t2 < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * t2)) FROM range(1, 101) r(k)))) END AS p FROM ks_t)"
    )


def drift_sql(columns: list[str], source: str = "li", more: str = "") -> str:
    long = long_sql(columns, source)
    return f"WITH li AS ({LI}), {more} {psi_sql(long)}, {ks_sql(long)} SELECT c AS column_name, round(psi, 4) AS psi, round(ks, 4) AS ks, round(p, 4) AS p_value, psi >= 0.2 OR p < 0.05 AS drift FROM psi_out JOIN ks_out USING (c)"


@query()
def psi(spark, d):
    return drift.psi(li(spark, d), "l_extendedprice").withColumn("psi", F.round("psi", 6))


@query()
def ks_statistic(spark, d):
    return drift.ks_table(drift.long_form(li(spark, d), ["l_extendedprice"])).select("column_name", F.round("ks", 8).alias("ks"))


@query()
def drift_report(spark, d):
    return drift.drift_report(li(spark, d), NUMERICS)


@query()
def drift_time_halves(spark, d):
    return drift.drift_report(drift.time_halves(table(spark, d, "events"), "ts"), ["value"])


ORACLE_SQL["psi"] = f"WITH li AS ({LI}), {psi_sql(long_sql(['l_extendedprice']))} SELECT c AS column_name, round(psi, 6) AS psi FROM psi_out"
ORACLE_SQL["ks_statistic"] = f"WITH li AS ({LI}), {ks_sql(long_sql(['l_extendedprice']))} SELECT c AS column_name, round(ks, 8) AS ks FROM ks_out"
ORACLE_SQL["drift_report"] = drift_sql(NUMERICS)
ORACLE_SQL["drift_time_halves"] = drift_sql(["value"], "half", "mid AS (SELECT quantile_cont(epoch_us(ts), 0.5) AS m FROM events), half AS (SELECT *, CASE WHEN epoch_us(ts) > m THEN 'test' ELSE 'train' END AS source FROM events, mid),")


@query("SELECT 'l_returnflag' AS target, round(sum((n - x) * (n - x) / x), 6) AS chi2, CAST(2 AS BIGINT) AS dof FROM (SELECT n, sum(n) OVER (PARTITION BY l_returnflag) * sum(n) OVER (PARTITION BY source) / sum(n) OVER () AS x FROM (SELECT l_returnflag, source, count(*) AS n FROM li GROUP BY 1, 2))")
def chi2_target(spark, d):
    return drift.chi2_drift(li(spark, d), "l_returnflag").select("target", F.round("chi2", 6).alias("chi2"), "dof")


# Preparation ---------------------------------------------------------------------------------


def prepared(df: DataFrame, operation: str, **settings) -> DataFrame:
    return Prepare(operation, **settings).fit(df).transform(df)


@query("SELECT event_id, CASE WHEN hashed > 1000000 THEN NULL ELSE hashed END AS hashed, hashed AS hashed_real, CASE WHEN hashed > 1000000 THEN 1 ELSE 0 END AS hashed_is_missing FROM ev")
def sentinel_nullify(spark, d):
    return prepared(ev(spark, d).select("event_id", "hashed"), "sentinel_nullify", thresholds={"hashed": 1000000})


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def include_exclude(spark, d):
    return prepare.include_exclude(table(spark, d, "orders"), include=["o_orderkey", "o_custkey", "o_orderstatus", "nope"], exclude=["o_custkey"])


@query("SELECT event_id, ts, user_id, event_type, props, amount, channel, hashed, action, raw_type FROM ev")
def constant_columns(spark, d):
    return prepared(ev(spark, d).withColumn("constant", F.lit(1)), "drop_constant")


@query("SELECT * FROM orders")
def duplicate_columns(spark, d):
    return prepared(table(spark, d, "orders").withColumn("copy", F.col("o_totalprice")), "drop_duplicate_columns")


@query("SELECT event_id, coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM ev)) AS amount FROM ev")
def median_impute(spark, d):
    return prepared(ev(spark, d).select("event_id", "amount"), "median_impute")


@query("SELECT event_id, coalesce(channel, (SELECT channel FROM ev WHERE channel IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, channel LIMIT 1)) AS channel, CASE WHEN channel IS NULL THEN 1 ELSE 0 END AS channel_is_missing FROM ev")
def mode_impute(spark, d):
    return prepared(ev(spark, d).select("event_id", "channel"), "mode_impute")


@query("SELECT event_id, CASE WHEN hashed = -1 THEN 0 ELSE hashed END AS hashed FROM ev")
def sentinel_replace(spark, d):
    return prepare.sentinel_replace(ev(spark, d).select("event_id", "hashed"), {"hashed": (-1, 0)})


@query("WITH s AS (SELECT p_brand, count(*) / sum(count(*)) OVER () AS s FROM part GROUP BY 1) SELECT p_partkey, CASE WHEN s >= 0.04 THEN part.p_brand ELSE 'OTHER' END AS p_brand FROM part LEFT JOIN s USING (p_brand)")
def rare_grouping(spark, d):
    return prepared(table(spark, d, "part").select("p_partkey", "p_brand"), "rare_grouping", columns=["p_brand"], min_freq=0.04)


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_exact(spark, d):
    return prepare.drop_duplicates(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@query("SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1, 2")
def dedup_keep_last(spark, d):
    return prepare.drop_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "last", ["l_shipdate"]).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("SELECT l_orderkey, l_linenumber, n_lines, n_parts FROM lineitem LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1) USING (l_orderkey)")
def group_features(spark, d):
    return prepare.group_features(table(spark, d, "lineitem"), "l_orderkey", {"n_lines": "size", "n_parts": "l_partkey"}).select("l_orderkey", "l_linenumber", "n_lines", "n_parts")


@query("SELECT event_id, CAST(year(ts) AS INT) AS ts_year, CAST(month(ts) AS INT) AS ts_month, CAST(day(ts) AS INT) AS ts_day, CAST(dayofweek(ts) + 1 AS INT) AS ts_dow, CAST(hour(ts) AS INT) AS ts_hour FROM events")
def datetime_parts(spark, d):
    return prepare.datetime_parts(table(spark, d, "events").select("event_id", "ts"), "ts", ["year", "month", "day", "dow", "hour"])


@query("SELECT l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity, round((l_tax - avg(l_tax) OVER ()) / stddev_pop(l_tax) OVER (), 6) AS l_tax FROM lineitem")
def standard_scale(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return prepared(rows, "standard_scale", columns=["l_quantity", "l_tax"]).withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_tax")})


@query("SELECT o_orderkey, round(n / t, 8) AS o_orderpriority_freq FROM orders LEFT JOIN (SELECT o_orderpriority, count(*) AS n, sum(count(*)) OVER () AS t FROM orders GROUP BY 1) USING (o_orderpriority)")
def frequency_encode(spark, d):
    made = prepared(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "frequency_encode", columns=["o_orderpriority"])
    return made.select("o_orderkey", F.round("o_orderpriority_freq", 8).alias("o_orderpriority_freq"))


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE -1 END AS o_orderpriority_ord FROM orders")
def ordinal_encode(spark, d):
    return prepared(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "ordinal_encode", orders={"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}).select("o_orderkey", "o_orderpriority_ord")


@query("SELECT 'amount_is_missing' AS flag, CAST(CASE WHEN amount IS NULL THEN 1 ELSE 0 END AS VARCHAR) AS value, count(*) AS n FROM ev GROUP BY 2")
def flag_stats(spark, d):
    return prepare.flag_stats(ev(spark, d).withColumn("amount_is_missing", F.col("amount").isNull().cast("int")), ["amount_is_missing"])


@query("SELECT * FROM orders")
def shuffle(spark, d):
    return prepare.shuffle(table(spark, d, "orders"), "o_orderkey")


@query("SELECT o_orderkey, CAST(o_totalprice AS FLOAT) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders")
def align_schema(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    test = orders.drop("o_orderpriority").withColumn("usage", F.lit("x"))
    return Prepare("align_schema", casts={"o_totalprice": "float"}).fit(orders).transform(test)


@query("SELECT event_id, CAST(coalesce(amount, 0) AS FLOAT) AS x0, CAST(hashed AS FLOAT) AS x1 FROM ev")
def feature_vector(spark, d):
    made = prepared(ev(spark, d).select("event_id", "amount", "hashed"), "feature_vector", columns=["amount", "hashed"])
    return made.select("event_id", F.get("features", 0).alias("x0"), F.get("features", 1).alias("x1"))


@query("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE -1 END AS label FROM lineitem")
def label_encode(spark, d):
    return prepare.label_encode(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_returnflag", {"A": 0, "N": 1})


@query("WITH d AS (SELECT row_number() OVER () - 1 AS p, column_name AS f, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS t FROM (DESCRIBE lineitem)), n AS (SELECT count(*) AS n FROM d) SELECT CAST(p AS INT) AS position, f AS feature, t AS dtype, CAST(n + 1 AS INT) AS n_features FROM d, n UNION ALL SELECT CAST(n AS INT), 'features', 'array<float>', CAST(n + 1 AS INT) FROM n")
def final_schema(spark, d):
    return prepare.final_schema(prepared(table(spark, d, "lineitem"), "feature_vector"))


@query("WITH n AS (SELECT (SELECT count(*) FROM ev) AS a, (SELECT count(DISTINCT user_id) FROM ev WHERE hashed <> -1 OR hashed IS NULL) AS u, (SELECT count(*) FROM ev WHERE hashed <> -1) AS b, (SELECT count(*) FROM ev WHERE amount IS NULL) AS na, (SELECT count(*) FROM ev WHERE amount IS NULL AND hashed <> -1) AS nb) SELECT 0 AS position, 'input' AS step, a AS n_rows, 3 AS n_columns, na AS n_nulls, CAST(0 AS BIGINT) AS rows_removed, '' AS columns_added, '' AS columns_removed FROM n UNION ALL SELECT 1, 'sentinels', b, 3, nb, a - b, '', '' FROM n UNION ALL SELECT 2, 'one a user', u, 3, 0, b - u, '', '' FROM n UNION ALL SELECT 3, 'columns', u, 3, 0, 0, 'has_amount', 'amount' FROM n")
def step_counts(spark, d):
    """Each user's row with the largest amount (no user lacks one), and what every step made of the table."""
    rows = ev(spark, d).select("user_id", "amount", "hashed")
    steps = {
        "sentinels": lambda df: df.where("hashed <> -1"),
        "one a user": lambda df: df.groupBy("user_id").agg(F.max("amount").alias("amount"), F.max("hashed").alias("hashed")),
        "columns": lambda df: df.withColumn("has_amount", F.col("amount").isNotNull()).drop("amount"),
    }
    return prepare.observed_steps(rows, steps)[1]


def cents():
    """Whole numbers, so that sums do not depend on their order."""
    return F.round(F.col("o_totalprice") * 100).alias("cents")


FOLDS = "y AS (SELECT o_orderkey, round(o_totalprice * 100) AS y, o_orderkey % 5 AS fold, CAST(o_custkey AS VARCHAR) AS c, o_orderpriority AS p FROM orders), f AS (SELECT fold, (SELECT sum(y) FROM y) - sum(y) AS s, (SELECT count(*) FROM y) - count(*) AS n FROM y GROUP BY 1)"


def folded(column: str) -> str:
    return f"SELECT o_orderkey, CASE WHEN vn - fn > 0 THEN (vs - fs + 20 * (s / n)) / (vn - fn + 20) ELSE s / n END AS x FROM (SELECT *, sum(y.y) OVER (PARTITION BY {column}) AS vs, count(*) OVER (PARTITION BY {column}) AS vn, sum(y.y) OVER (PARTITION BY {column}, fold) AS fs, count(*) OVER (PARTITION BY {column}, fold) AS fn FROM y) JOIN f USING (fold)"


@query(f"WITH {FOLDS} SELECT a.o_orderkey, round(a.x, 6) AS o_custkey_target, round(b.x, 6) AS o_orderpriority_target FROM ({folded('c')}) a JOIN ({folded('p')}) b USING (o_orderkey)")
def target_encode_folds(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", cents())
    made = prepare.target_encode_folds(rows, ["o_custkey", "o_orderpriority"], "cents", F.col("o_orderkey") % 5)
    return made.select("o_orderkey", *[F.round(c, 6).alias(c) for c in ("o_custkey_target", "o_orderpriority_target")])


@query("WITH o AS (SELECT o_orderkey, o_custkey, round(o_totalprice * 100) AS y, o_orderkey % 2 = 0 AS fitted FROM orders), g AS (SELECT avg(y) AS g FROM o WHERE fitted), v AS (SELECT o_custkey, (sum(y) + 20 * any_value(g)) / (count(*) + 20) AS x FROM o, g WHERE fitted GROUP BY 1) SELECT o_orderkey, round(coalesce(x, g), 6) AS o_custkey_target FROM o LEFT JOIN v USING (o_custkey), g WHERE NOT fitted")
def target_encode(spark, d):
    """Fitted on half of the orders, applied to the others."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", cents())
    model = Prepare("target_encode", columns=["o_custkey"], target="cents").fit(rows.where("o_orderkey % 2 = 0"))
    return model.transform(rows.where("o_orderkey % 2 <> 0")).select("o_orderkey", F.round("o_custkey_target", 6).alias("o_custkey_target"))


@query("WITH f AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'), p AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM (SELECT DISTINCT o_orderpriority AS v FROM f)), s AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM (SELECT DISTINCT o_orderstatus AS v FROM f)), n AS (SELECT count(*) + 1 AS n FROM p) SELECT o_orderkey, CAST(coalesce(p.slot, n - 1) AS INT) AS slot, CAST(1 AS DOUBLE) AS value FROM orders LEFT JOIN p ON o_orderpriority = p.v, n UNION ALL SELECT o_orderkey, CAST(n + coalesce(s.slot, (SELECT count(*) FROM s)) AS INT), 1 FROM orders LEFT JOIN s ON o_orderstatus = s.v, n")
def one_hot_encode(spark, d):
    """Fitted on orders without the lowest priority, which goes to the slot of other values."""
    from pyspark.ml.functions import vector_to_array

    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    model = Prepare("one_hot_encode", columns=["o_orderpriority", "o_orderstatus"]).fit(rows.where("o_orderpriority <> '5-LOW'"))
    made = model.transform(rows).select("o_orderkey", F.posexplode(vector_to_array("one_hot")).alias("slot", "value"))
    return made.where("value <> 0")


@query("WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b, quantile_cont(l_quantity, 0.25) AS c, quantile_cont(l_quantity, 0.75) AS d FROM lineitem) SELECT l_orderkey, l_linenumber, round(greatest(least(l_extendedprice, b + 0.2 * (b - a)), a - 0.2 * (b - a)), 6) AS l_extendedprice, round(greatest(least(l_quantity, d + 0.2 * (d - c)), c - 0.2 * (d - c)), 6) AS l_quantity FROM lineitem, q")
def iqr_clip(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return prepared(rows, "iqr_clip", columns=["l_extendedprice", "l_quantity"], k=0.2).withColumns({c: F.round(c, 6) for c in ("l_extendedprice", "l_quantity")})


PLAIN = "trim(regexp_replace(strip_accents(lower({})), '[\\x20\\x09-\\x0D]+', ' ', 'g'))"


@query(f"SELECT doc_id, length({PLAIN.format('text')}) AS n_chars, md5({PLAIN.format('text')}) AS composed, md5({PLAIN.format("replace(replace(text, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776))")}) AS decomposed FROM documents")
def normalise_text(spark, d):
    """The texts of all documents, as they are and with two letters in decomposed form."""
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("e\u0301")), F.lit("ü"), F.lit("u\u0308"))
    rows = table(spark, d, "documents").select("doc_id", "text", apart.alias("apart"))
    made = prepare.normalise_text(rows, ["text", "apart"])
    return made.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("composed"), F.md5(F.col("apart").cast("binary")).alias("decomposed"))


RULES = {"no amount": "amount IS NULL", "sentinel": "hashed = -1", "closed": "action = 'closed'"}


@query(" UNION ALL ".join(f"SELECT event_id, '{name}' AS reason FROM ev WHERE {rule}" for name, rule in RULES.items()))
def excluded_rows(spark, d):
    return prepare.split_excluded(ev(spark, d), RULES, "event_id")[1]


@query(" UNION ALL ".join(f"SELECT '{name}' AS reason, count(*) AS n_rows FROM ev WHERE {rule}" for name, rule in {**RULES, "any": " OR ".join(RULES.values()), "kept": f"coalesce(NOT ({' OR '.join(f'coalesce({r}, FALSE)' for r in RULES.values())}), FALSE)"}.items()))
def exclusion_counts(spark, d):
    return prepare.split_excluded(ev(spark, d), RULES, "event_id")[2]


@query("WITH m AS (SELECT avg(hashed) AS m, stddev_pop(hashed) AS s FROM ev WHERE NOT (amount IS NULL OR hashed = -1 OR coalesce(action = 'closed', FALSE))) SELECT event_id, round((hashed - m) / s, 6) AS hashed FROM ev, m")
def masked_fit(spark, d):
    """Scaled by the rows that no rule excludes; all rows are there."""
    rows = prepare.exclusion_mask(ev(spark, d).select("event_id", F.col("hashed").cast("double").alias("hashed"), "amount", "action"), RULES)
    return prepared(rows, "standard_scale", columns=["hashed"], mask="excluded").select("event_id", F.round("hashed", 6).alias("hashed"))


@query("WITH c AS (SELECT 'encoding' AS warning, x AS subject, CAST(n AS DOUBLE) AS value, CAST(1000 AS DOUBLE) AS limit, n > 1000 AS raised FROM (SELECT 'l_orderkey' AS x, count(DISTINCT l_orderkey) AS n FROM lineitem UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem UNION ALL SELECT 'l_linenumber', count(DISTINCT l_linenumber) FROM lineitem)) FROM c UNION ALL SELECT 'aggregation', 'l_orderkey', count(*) / count(DISTINCT l_orderkey), 1, count(*) > count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT 'window', 'l_shipdate', date_diff('second', min(l_shipdate), max(l_shipdate)) / 86400, 30, date_diff('second', min(l_shipdate), max(l_shipdate)) / 86400 < 30 FROM lineitem")
def aggregation_warnings(spark, d):
    return prepare.aggregation_warnings(table(spark, d, "lineitem"), levels=["l_orderkey"], time="l_shipdate")


# Integration ----------------------------------------------------------------------------------


def side_sql(me: str, mine: str, key: str, other: str, theirs: str, side: str) -> str:
    return f"SELECT '{side}' AS side, count(*) AS n_rows, count(*) FILTER (WHERE {key} IS NULL) AS n_null_keys, count(DISTINCT {key}) AS n_keys, (SELECT count(*) FROM (SELECT {key} FROM {me} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS n_repeated_keys, (SELECT max(n) FROM (SELECT count(*) AS n FROM {me} WHERE {key} IS NOT NULL GROUP BY {key})) AS most_rows_per_key, count(DISTINCT {key}) FILTER (WHERE {key} NOT IN (SELECT {theirs} FROM {other} WHERE {theirs} IS NOT NULL)) AS n_unmatched_keys, count(*) FILTER (WHERE {key} IS NULL OR {key} NOT IN (SELECT {theirs} FROM {other} WHERE {theirs} IS NOT NULL)) AS n_unmatched_rows, count(*) FILTER (WHERE {key} IN (SELECT {theirs} FROM {other} WHERE {theirs} IS NOT NULL)) AS n_matched_rows, 'one_to_many' AS relation, (SELECT count(*) FROM customer JOIN o ON c_custkey = k) AS n_inner FROM {me}"


ORDERED = "o AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS k, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 7 <> 0)"


def customers_and_orders(spark, d):
    """Orders of most customers, a tenth of them without a customer."""
    orders = table(spark, d, "orders").where("o_custkey % 7 <> 0")
    orders = orders.select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("k"), "o_orderkey", "o_totalprice")
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name"), orders


@query(f"WITH {ORDERED} {side_sql('customer', 'c', 'c_custkey', 'o', 'k', 'left')} UNION ALL {side_sql('o', 'o', 'k', 'customer', 'c_custkey', 'right')}")
def merge_audit(spark, d):
    return integrate.merge_audit(*customers_and_orders(spark, d), "k")


@query(f"WITH {ORDERED} SELECT coalesce(k, c_custkey) AS k, c_name, o_orderkey, o_totalprice FROM customer FULL JOIN o ON c_custkey = k")
def merge_full(spark, d):
    return integrate.merge(*customers_and_orders(spark, d), "k", "full")[0]


@query("SELECT l_orderkey, l_linenumber, l_partkey AS k, p_brand, p_size FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey")
def enrich_lookup(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("k"))
    parts = table(spark, d, "part").where("p_size > 10").withColumnRenamed("p_partkey", "k")
    return integrate.enrich(lines, parts, "k", ["p_brand", "p_size"])[0]


@query("SELECT e.event_id, e.user_id, e.ts, r.ts AS ts_asof, r.event_id AS event_id_asof, round(r.value, 6) AS value_asof FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') r ON e.user_id = r.user_id AND e.ts >= r.ts")
def asof_alignment(spark, d):
    """Each event with the latest error of its user up to then."""
    events = table(spark, d, "events")
    made = integrate.align_asof(events.select("event_id", "user_id", "ts"), events.where("event_type = 'error'"), "user_id", "ts", columns=["event_id", "value"])
    return made.withColumn("value_asof", F.round("value_asof", 6))


# Clustering ----------------------------------------------------------------------------------


def embeddings(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def suppliers(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.array(F.col("s_acctbal") / 1000, F.col("s_nationkey") / 3.0).alias("features"))




@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), pairs AS (SELECT a.vec_id AS id, list_distance(a.x, b.x) AS dist FROM e a, e b), near AS (SELECT id, avg(dist) AS m FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist) AS r FROM pairs) WHERE r <= 5 GROUP BY 1) SELECT count(*) AS n, round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std, round(min(m), 6) AS min, round(max(m), 6) AS max, round(quantile_cont(m, 0.25), 6) AS p25, round(quantile_cont(m, 0.5), 6) AS p50, round(quantile_cont(m, 0.75), 6) AS p75, round(quantile_cont(m, 0.9), 6) AS p90, round(quantile_cont(m, 0.95), 6) AS p95, round(quantile_cont(m, 0.99), 6) AS p99, round(quantile_cont(m, 0.95), 6) AS suggested_eps FROM near")
def knn_distance(spark, d):
    return cluster.knn_profile(cluster.knn_distances(embeddings(spark, d), "vec_id", 5))


@query()
def kmeans_assign(spark, d):
    return cluster.kmeans(embeddings(spark, d), "vec_id", 10)[0]


@query()
def kmeans_grid(spark, d):
    return cluster.grid(embeddings(spark, d), "vec_id", "kmeans", {"k": [2, 5, 10], "seed": [42]}, n=5000)


def planted(spark, d):
    """Events as points in one cloud for each type, so that as many clusters as types are the best."""
    events = table(spark, d, "events")
    kinds = ("click", "error", "purchase", "signup", "view")
    corner = [F.when(F.col("event_type") == k, 10.0).otherwise(0.0) for k in kinds]
    noise = (F.col("event_id") % 97) / 97.0
    return events.select("event_id", F.col("event_type").alias("stratum"), F.array(*[c + noise * (i + 1) / 5 for i, c in enumerate(corner)], F.log1p("value") / 20).alias("features"))


@query("SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_keys, count(DISTINCT event_type) AS n_clusters, concat('k=', count(DISTINCT event_type), ', seed=42') AS best, count(DISTINCT event_type) AS n_pure FROM events")
def kmeans_refit(spark, d):
    """The best of a grid on a stratified sample, fitted anew on all points: as many clusters as were
    planted, each of one kind."""
    points = planted(spark, d)
    best, labels = cluster.refit_best(points, "event_id", "kmeans", {"k": [2, 3, 5, 7], "seed": [42]}, n=400, strata="stratum")
    said = ", ".join(f"{k}={v}" for k, v in best.items())
    met = labels.join(points.select("event_id", "stratum"), "event_id")
    pure = met.groupBy("label").agg(F.countDistinct("stratum").alias("kinds")).agg(F.count_if(F.col("kinds") == 1).alias("n_pure"))  # one row
    facts = labels.agg(F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_keys"), F.countDistinct("label").alias("n_clusters"), F.lit(said).alias("best"))
    return facts.crossJoin(F.broadcast(pure))


@query("SELECT concat('k=', count(DISTINCT event_type)) AS parameters, count(DISTINCT event_type) AS n_clusters, (SELECT count(*) FROM events) AS n_points, 2 AS last_rung, CAST(4 + 2 + 1 AS BIGINT) AS n_fits FROM events")
def random_search(spark, d):
    """Successive halving over numbers of clusters on the planted clouds finds theirs."""
    found = checkpoint(cluster.random_search(planted(spark, d), "event_id", "kmeans", {"k": [2, 3, 5, 8]}, draws=4, least_points=400, score="silhouette_squared", seed=7))
    facts = found.agg(F.max("rung").alias("last_rung"), F.count("*").alias("n_fits"))  # one row
    return found.where("best").select("parameters", "n_clusters", "n_points").crossJoin(F.broadcast(facts))


@query("SELECT 'hashed' AS column_name, '-1' AS sentinel, '0' AS replacement, count(*) FILTER (WHERE hashed = -1) AS n_replaced FROM ev UNION ALL SELECT 'missing', 'a', 'b', NULL")
def sentinel_replace_report(spark, d):
    return prepare.sentinel_replace_report(ev(spark, d), {"hashed": (-1, 0), "missing": ("a", "b")})


@query(values_sql([("props", True), ("usage", False)], column_name="VARCHAR", found="BOOLEAN"))
def drop_report(spark, d):
    return prepare.drop_report(ev(spark, d), ["props", "usage"])


@query()
def bisecting_assign(spark, d):
    return cluster.bisecting(embeddings(spark, d), "vec_id", 8)[0]


@query()
def cluster_assignments(spark, d):
    return cluster.assignments(embeddings(spark, d), "vec_id", {"kmeans_n2": {"algorithm": "kmeans", "k": 2}, "kmeans_n3": {"algorithm": "kmeans", "k": 3}})


@query()
def cluster_centroids(spark, d):
    points = embeddings(spark, d)
    return cluster.centroid_table(points, cluster.kmeans(points, "vec_id", 5)[1])


@query("WITH RECURSIVE p AS (SELECT s_suppkey AS id, s_acctbal / 1000 AS x, s_nationkey / 3.0 AS y FROM supplier), pairs AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.8), core AS (SELECT a AS id FROM pairs GROUP BY 1 HAVING count(*) >= 3), links AS (SELECT a, b FROM pairs WHERE a IN (FROM core) AND b IN (FROM core)), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a), roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY 1), numbered AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS label FROM (SELECT DISTINCT root FROM roots)), own AS (SELECT id, label FROM roots JOIN numbered USING (root)), near AS (SELECT a AS id, min(label) AS label FROM pairs JOIN own ON b = own.id GROUP BY 1) SELECT p.id AS s_suppkey, CAST(coalesce(own.label, near.label, -1) AS INT) AS label FROM p LEFT JOIN own ON p.id = own.id LEFT JOIN near ON p.id = near.id")
def dbscan(spark, d):
    return cluster.dbscan(suppliers(spark, d), "s_suppkey", 0.8, 3)


@query("WITH RECURSIVE p AS (SELECT c_custkey AS id, c_acctbal / 250 AS x, CAST(c_nationkey AS DOUBLE) AS y, c_custkey % 5 / 2.0 AS z, length(c_mktsegment) / 2.0 AS w FROM customer), pairs AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.y = b.y AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) + (a.w - b.w) * (a.w - b.w)) <= 0.9), core AS (SELECT a AS id FROM pairs GROUP BY 1 HAVING count(*) >= 3), links AS (SELECT a, b FROM pairs WHERE a IN (FROM core) AND b IN (FROM core)), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a), roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY 1), numbered AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS label FROM (SELECT DISTINCT root FROM roots)), own AS (SELECT id, label FROM roots JOIN numbered USING (root)), near AS (SELECT a AS id, min(label) AS label FROM pairs JOIN own ON b = own.id GROUP BY 1) SELECT p.id AS c_custkey, CAST(coalesce(own.label, near.label, -1) AS INT) AS label FROM p LEFT JOIN own ON p.id = own.id LEFT JOIN near ON p.id = near.id")
def dbscan_wide(spark, d):
    """Density clusters in four dimensions, where points are compared by blocks and not by cells."""
    customers = table(spark, d, "customer")
    features = F.array(F.col("c_acctbal") / 250, F.col("c_nationkey").cast("double"), F.col("c_custkey") % 5 / 2.0, F.length("c_mktsegment") / 2.0)
    return cluster.dbscan(customers.select("c_custkey", features.alias("features")), "c_custkey", 0.9, 3)


@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings), m AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n FROM e a, e b GROUP BY 1, 2, 3), t AS (SELECT vec_id, max(CASE WHEN own = other THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM m GROUP BY 1) SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM t")
def silhouette(spark, d):
    value = quality.silhouette(embeddings(spark, d), "label", key="vec_id")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


MEANS = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), l AS (SELECT vec_id, label, unnest(range(len(x))) AS dim, unnest(x) AS v FROM e), c AS (SELECT label, dim, avg(v) AS m, count(*) AS n FROM l GROUP BY 1, 2)"


@query(f"WITH {MEANS}, s AS (SELECT label, avg(dist) AS s FROM (SELECT l.vec_id, l.label, sqrt(sum((v - m) * (v - m))) AS dist FROM l JOIN c ON l.label = c.label AND l.dim = c.dim GROUP BY 1, 2) GROUP BY 1), gap AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS dij FROM c a JOIN c b ON a.dim = b.dim AND a.label <> b.label GROUP BY 1, 2) SELECT round(avg(r), 6) AS davies_bouldin FROM (SELECT i, max((si.s + sj.s) / dij) AS r FROM gap JOIN s si ON i = si.label JOIN s sj ON j = sj.label GROUP BY 1)")
def davies_bouldin(spark, d):
    return quality.davies_bouldin_table(embeddings(spark, d)).select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query(f"WITH {MEANS}, g AS (SELECT dim, avg(v) AS g FROM l GROUP BY 1), b AS (SELECT sum(n * (m - g) * (m - g)) AS b, count(DISTINCT label) AS k FROM c JOIN g USING (dim)), w AS (SELECT sum((v - m) * (v - m)) AS w, count(DISTINCT vec_id) AS n FROM l JOIN c ON l.label = c.label AND l.dim = c.dim) SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz FROM b, w")
def calinski_harabasz(spark, d):
    return quality.calinski_harabasz_table(embeddings(spark, d)).select(F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@query("WITH c AS (SELECT event_type AS a, user_id % 5 AS b, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2), x AS (SELECT sum(n * (n - 1) / 2) AS c, sum(n) AS t FROM c), r AS (SELECT sum(n * (n - 1) / 2) AS r FROM (SELECT sum(n) AS n FROM c GROUP BY a)), s AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT sum(n) AS n FROM c GROUP BY b)) SELECT round((c - r * s / (t * (t - 1) / 2)) / ((r + s) / 2 - r * s / (t * (t - 1) / 2)), 8) AS adjusted_rand FROM x, r, s")
def adjusted_rand(spark, d):
    rows = table(spark, d, "events").withColumn("bucket", F.col("user_id") % 5)
    return quality.adjusted_rand_table(rows, "event_type", "bucket").select(F.round("adjusted_rand", 8).alias("adjusted_rand"))


PROFILE = f"{MEANS}, t AS (SELECT label, n, dim, m, row_number() OVER (PARTITION BY label ORDER BY abs(m) DESC, dim) AS rank FROM c), z AS (SELECT count(*) AS t FROM e)"


@query(f"WITH {PROFILE} SELECT label, n, round(100.0 * n / t, 4) AS pct, CAST(dim AS INT) AS feature_index, round(m, 6) AS value, CAST(rank AS INT) AS rank FROM t, z WHERE rank <= 5")
def cluster_profile(spark, d):
    return quality.cluster_profile(embeddings(spark, d), top=5)


@query("SELECT label, least(count(*), 20) AS n FROM embeddings GROUP BY 1")
def cluster_samples(spark, d):
    return cluster.cluster_sizes(cluster.cluster_samples(embeddings(spark, d), "vec_id", "label", 20))


@query("SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def cluster_sizes(spark, d):
    return cluster.cluster_sizes(embeddings(spark, d))


def labelled(sql: str, label: str) -> str:
    """SQL over embeddings with another label."""
    return sql.replace("FROM embeddings", f"FROM (SELECT vec_id, embedding, {label} AS label FROM embeddings)")


def metrics_sql(model: str, label: str) -> str:
    rand = f"WITH c AS (SELECT CAST({label} AS INT) AS a, label AS b, CAST(count(*) AS DOUBLE) AS n FROM embeddings GROUP BY 1, 2), x AS (SELECT sum(n * (n - 1) / 2) AS c, sum(n) AS t FROM c), r AS (SELECT sum(n * (n - 1) / 2) AS r FROM (SELECT sum(n) AS n FROM c GROUP BY a)), s AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT sum(n) AS n FROM c GROUP BY b)) SELECT round(CASE WHEN (r + s) / 2 = r * s / (t * (t - 1) / 2) THEN 1 ELSE (c - r * s / (t * (t - 1) / 2)) / ((r + s) / 2 - r * s / (t * (t - 1) / 2)) END, 6) FROM x, r, s"
    parts = [f"({labelled(ORACLE_SQL[m], label)}) AS {m}" for m in ("silhouette", "davies_bouldin", "calinski_harabasz")]
    return f"SELECT '{model}' AS model, {', '.join(parts)}, ({rand}) AS adjusted_rand"


METRICS_SQL = " UNION ALL ".join([metrics_sql("given", "label"), metrics_sql("other", "vec_id % 4")])


@query(METRICS_SQL)
def metrics_summary(spark, d):
    points = embeddings(spark, d).withColumn("other", (F.col("vec_id") % 4).cast("int"))
    metrics = quality.evaluate(points, {"given": "label", "other": "other"}, truth="label")
    names = ["silhouette", "davies_bouldin", "calinski_harabasz", "adjusted_rand"]
    return quality.metrics_summary(metrics.withColumn("value", F.round("value", 6)), names)


@query()
def registry_smoke(spark, d):
    """Fits an estimator found by name for each problem type."""
    from pyspark.ml.functions import array_to_vector

    points = embeddings(spark, d).withColumn("vector", array_to_vector("features")).withColumn("target", (F.col("label") % 2).cast("double"))
    rows = []
    for problem, name, extra in (("clustering", "kmeans", {"k": 3, "seed": 1}), ("classification", "logistic_regression", {"labelCol": "target"}), ("regression", "ridge", {"labelCol": "target"})):
        model = cluster.fitted(problem, name, points, featuresCol="vector", **extra)
        rows.append((problem, name, model.transform(points).select("prediction").distinct().count() > 1))
    return spark.createDataFrame(rows, "problem string, name string, predicts boolean")


# Interpretation --------------------------------------------------------------------------------


@query(f"WITH {PROFILE}, f AS (SELECT label, n, string_agg(concat('f', dim, '=', printf('%.3f', round(m, 6))), ', ' ORDER BY rank) AS features FROM t WHERE rank <= 3 GROUP BY 1, 2) SELECT label, n, round(100.0 * n / t, 4) AS pct, features, concat('cluster ', label, ': ', features) AS description FROM f, z")
def cluster_description(spark, d):
    return interpret.describe_clusters(quality.cluster_profile(embeddings(spark, d)), [f"f{i}" for i in range(64)])


def profile_sql(model: str, label: str) -> str:
    return labelled(f"(WITH {PROFILE} SELECT '{model}' AS model, CAST(label AS INT) AS label, n, round(100.0 * n / t, 4) AS pct, CAST(dim AS INT) AS feature_index, round(m, 6) AS value, CAST(rank AS INT) AS rank FROM t, z WHERE rank <= 10)", label)


@query(f"SELECT * FROM {profile_sql('given', 'label')} UNION ALL SELECT * FROM {profile_sql('half', 'label % 2')}")
def knowledge_base(spark, d):
    points = embeddings(spark, d).withColumn("half", (F.col("label") % 2).cast("int"))
    return interpret.knowledge_base({"given": quality.cluster_profile(points, "label"), "half": quality.cluster_profile(points, "half")})


CONF = "c AS (SELECT event_type AS truth, CAST(user_id % 5 AS INT) AS cluster, count(*) AS n FROM events GROUP BY 1, 2)"


def clustered(spark, d):
    return table(spark, d, "events").withColumn("cluster", (F.col("user_id") % 5).cast("int"))


@query(f"WITH {CONF} SELECT truth, cluster, n, CAST(n AS DOUBLE) AS value FROM c")
def confusion(spark, d):
    return interpret.confusion(clustered(spark, d), "event_type", "cluster")


@query(f"WITH {CONF} SELECT truth, cluster, n, round(n / sum(n) OVER (PARTITION BY cluster), 6) AS value FROM c")
def confusion_pred_norm(spark, d):
    return interpret.confusion(clustered(spark, d), "event_type", "cluster", normalize="pred")


@query(f"WITH {CONF}, r AS (SELECT cluster, row_number() OVER (ORDER BY sum(n) DESC, cluster) AS r FROM c GROUP BY 1) SELECT truth, CASE WHEN r <= 2 THEN cluster ELSE -1 END AS cluster, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) AS DOUBLE) AS value FROM c JOIN r USING (cluster) GROUP BY 1, 2")
def confusion_collapsed(spark, d):
    return interpret.confusion(clustered(spark, d), "event_type", "cluster", collapse=2)


@query(f"WITH {CONF} SELECT truth, cluster, n, round(n / sum(n) OVER (PARTITION BY truth), 6) AS share FROM c")
def alignment_share(spark, d):
    return interpret.alignment_share(clustered(spark, d), "event_type", "cluster")


@query()
def fingerprint(spark, d):
    return interpret.fingerprint(table(spark, d, "lineitem"))


JUDGED = " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} {'>=' if larger else '<='} {limit} AS ok FROM w" for m, limit, larger in interpret.LIMITS)


@query(f"SELECT model AS winner, count(*) FILTER (WHERE ok) AS n_passed, count(*) FILTER (WHERE NOT ok) AS n_barriers, coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (WHERE NOT ok), '') AS barriers, bool_and(ok) AS ready FROM (WITH w AS (SELECT * FROM ({METRICS_SQL}) ORDER BY adjusted_rand DESC, model DESC LIMIT 1) {JUDGED}) GROUP BY 1")
def readiness(spark, d):
    """Judges the labels of ``embeddings`` and a labelling by id against each other."""
    points = embeddings(spark, d).withColumn("other", (F.col("vec_id") % 4).cast("int"))
    return interpret.readiness(quality.evaluate(points, {"given": "label", "other": "other"}, truth="label"))


# Streaming ---------------------------------------------------------------------------------------


@query("SELECT o_orderkey, round(o_totalprice_z, 6) AS o_totalprice, o_orderpriority_ord FROM (SELECT o_orderkey, (o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER () AS o_totalprice_z, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE -1 END AS o_orderpriority_ord FROM orders)")
def score_stream(spark, d):
    """Saves a fitted pipeline, loads it and scores a folder of files as a stream."""
    import uuid

    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    model = Pipeline(stages=[Prepare("standard_scale", columns=["o_totalprice"]), Prepare("ordinal_encode", orders={"o_orderpriority": ["1-URGENT", "2-HIGH"]})]).fit(rows)
    checkpoint(spark.range(1))  # makes sure of a shared folder
    base = f"{spark.sparkContext.getCheckpointDir()}/score-{uuid.uuid4().hex}"
    model.write().overwrite().save(f"{base}/model")
    rows.write.parquet(f"{base}/in")
    score_files(spark, PipelineModel.load(f"{base}/model"), f"{base}/in", f"{base}/out", f"{base}/state", rows.schema)
    return spark.read.parquet(f"{base}/out").select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"), "o_orderpriority_ord")
