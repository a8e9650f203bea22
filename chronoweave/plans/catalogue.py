"""Queries over the driver's tables, one for each operator or group of operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import parse
from ..functions.metadata_values import compile_value
from ..operators import align, codes, cohort, subjects
from ..operators.events import code_of, extract_event, lookup_join, subject_rows, table_events
from ..operators.order import numbered
from ..operators.union import diagonal_union, vertical_union
from ..sources import files
from ..sources.readers import ends_of, find_data, find_metadata, promote, read_metadata, read_table, require, row_range
from . import pipeline, spec

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}

#: The specification of the flagship cohort.
COHORT = {
    "customer": {
        "subject_id_col": "c_custkey",
        "segment": {"code": 'f"SEGMENT//{$c_mktsegment}"', "time": None},
        "balance": {"code": "ACCT_BALANCE", "time": None, "numeric_value": "$c_acctbal"},
        "nation": {"code": 'f"NATION//{$c_nationkey}"', "time": None, "_metadata": {"nation": {"c_nationkey": "n_nationkey", "description": "n_name"}}},
    },
    "orders": {
        "subject_id_col": "o_custkey",
        "placed": {"code": 'f"ORDER//{$o_orderstatus}//{$o_orderpriority}"', "time": "$o_orderdate", "numeric_value": "$o_totalprice"},
    },
    "lineitem": {
        "join": {"input_prefix": "orders", "left_on": "l_orderkey", "right_on": "o_orderkey", "columns_from_right": ["o_custkey"]},
        "subject_id_col": "o_custkey",
        "item": {"code": 'f"ITEM//{$l_returnflag}//{$l_linestatus}"', "time": "$l_shipdate", "numeric_value": "$l_quantity"},
    },
    "events": {
        "subject_id_col": "user_id",
        "activity": {"code": 'f"EVENT//{$event_type}"', "time": "$ts", "numeric_value": "$value"},
    },
}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _oracles[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


def _reader(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, table: str, cfg: dict, raw: DataFrame | None = None, lookup: str | None = None, **options) -> DataFrame:
    """Events of one table under a specification written in place."""
    t = spec.from_dict({table: cfg}).tables[table]
    read = _reader(spark, sf_dir)
    return table_events(read(table) if raw is None else raw, t, read(lookup) if lookup else None, **options).drop("__block__")


@query("""SELECT DISTINCT c_custkey AS subject_id, 'SEGMENT//' || coalesce(c_mktsegment, 'UNK') AS code, CAST(NULL AS TIMESTAMP) AS time, 'customer/segment' AS source_block FROM customer""")
def static_events(spark, sf_dir):
    return _events(spark, sf_dir, "customer", {"subject_id_col": "c_custkey", "segment": COHORT["customer"]["segment"]}).drop("code_components")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'ORDER//' || coalesce(o_orderstatus, 'UNK') || '//' || coalesce(o_orderpriority, 'UNK') AS code, o_orderdate AS time, o_totalprice AS numeric_value, 'orders/placed' AS source_block FROM orders WHERE o_orderdate IS NOT NULL""")
def timed_events(spark, sf_dir):
    return _events(spark, sf_dir, "orders", COHORT["orders"]).drop("code_components")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'ORDERED' AS code, o_orderdate AS time FROM orders WHERE o_orderdate IS NOT NULL UNION ALL SELECT DISTINCT o_custkey, 'o_orderstatus', o_orderdate FROM orders WHERE o_orderdate IS NOT NULL""")
def literal_code_events(spark, sf_dir):
    cfg = {"subject_id_col": "o_custkey", "word": {"code": "ORDERED", "time": "$o_orderdate"}, "quoted": {"code": '"o_orderstatus"', "time": "$o_orderdate"}}
    return _events(spark, sf_dir, "orders", cfg).drop("source_block")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'ITEM//' || l_returnflag || '//' || l_linestatus AS code, l_shipdate AS time, l_quantity AS numeric_value FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate IS NOT NULL""")
def lookup_join_events(spark, sf_dir):
    return _events(spark, sf_dir, "lineitem", COHORT["lineitem"], lookup="orders").drop("code_components", "source_block")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'ITEM' AS code, l_shipdate AS time, l_quantity AS numeric_value FROM lineitem JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON l_orderkey = o_orderkey""")
def lookup_join_unmatched(spark, sf_dir):
    read = _reader(spark, sf_dir)
    t = spec.from_dict({"lineitem": {**COHORT["lineitem"], "item": {"code": "ITEM", "time": "$l_shipdate", "numeric_value": "$l_quantity"}}}).tables["lineitem"]
    rows = table_events(read("lineitem"), t, read("orders").where("o_orderstatus = 'F'"), distinct=False).drop("__block__", "source_block")
    people = subjects.universe([read("customer").select(F.col("c_custkey").alias("subject_id"))]).withColumns({"split": F.lit("all"), "shard": F.lit("all/0")})
    return cohort.distinct_events(cohort.route(rows, people)).drop("split", "shard")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'O//' || coalesce(nullif(o_orderstatus, 'F'), 'UNK') || '//' || coalesce(nullif(o_orderpriority, '1-URGENT'), 'UNK') AS code, o_orderdate AS time FROM orders""")
def unk_composite_code(spark, sf_dir):
    raw = _reader(spark, sf_dir)("orders").withColumns({"s": F.nullif("o_orderstatus", F.lit("F")), "p": F.nullif("o_orderpriority", F.lit("1-URGENT"))})
    return _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": 'f"O//{$s}//{$p}"', "time": "$o_orderdate"}}, raw).drop("code_components", "source_block")


@query("""SELECT DISTINCT user_id AS subject_id, nullif(event_type, 'click') AS code, ts AS time FROM events WHERE nullif(event_type, 'click') IS NOT NULL""")
def bare_code_null_drop(spark, sf_dir):
    raw = _reader(spark, sf_dir)("events").withColumn("kind", F.nullif("event_type", F.lit("click")))
    return _events(spark, sf_dir, "events", {"subject_id_col": "user_id", "e": {"code": "$kind", "time": "$ts"}}, raw).drop("code_components", "source_block")


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


def _days(spark, sf_dir) -> DataFrame:
    return _reader(spark, sf_dir)("orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(f"""SELECT DISTINCT o_custkey AS subject_id, 'O' AS code, CAST(strptime({_DAY}, '%Y-%m-%d') AS DATE) AS time FROM orders WHERE o_orderkey % 3 = 2""")
def time_empty_and_null_drop(spark, sf_dir):
    raw = _days(spark, sf_dir).withColumn("day", F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 2, F.col("day")))
    return _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": "O", "time": '$day::"%Y-%m-%d"'}}, raw).drop("source_block")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'O' AS code, strptime(strftime(o_orderdate, '%m/%d/%Y, %H:%M:%S'), '%m/%d/%Y, %H:%M:%S') AS time FROM orders""")
def time_parse_strict(spark, sf_dir):
    raw = _reader(spark, sf_dir)("orders").withColumn("at", F.date_format("o_orderdate", "MM/dd/yyyy, HH:mm:ss"))
    return _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": "O", "time": '$at as "%m/%d/%Y, %H:%M:%S"'}}, raw).drop("source_block")


@query(f"""SELECT DISTINCT o_custkey AS subject_id, 'O' AS code, CAST(CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE strptime({_DAY}, '%Y-%m-%d') END AS DATE) AS time FROM orders""")
def time_parse_lenient(spark, sf_dir):
    raw = _days(spark, sf_dir).withColumn("day", F.when(F.col("o_orderkey") % 2 == 0, "not a date").otherwise(F.col("day")))
    return _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": "O", "time": '$day as ?"%Y-%m-%d"'}}, raw).drop("source_block")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'O' AS code, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS time FROM orders""")
def time_set_time(spark, sf_dir):
    raw = _days(spark, sf_dir).withColumn("clock", F.concat_ws(":", (F.col("o_orderkey") % 24).cast("string"), (F.col("o_orderkey") % 60).cast("string")))
    cfg = {"subject_id_col": "o_custkey", "a": {"code": "O", "time": 'set_time($day::"%Y-%m-%d", $clock::"%H:%M")'}, "b": {"code": "O", "time": '$day::"%Y-%m-%d" @ $clock::"%H:%M"'}}
    return _events(spark, sf_dir, "orders", cfg, raw).drop("source_block").dropDuplicates()


@query("""SELECT o_custkey AS subject_id, 'DAY' AS code, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS time FROM orders UNION ALL SELECT user_id, 'MOMENT', ts FROM events""")
def date_widening(spark, sf_dir):
    days = _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": "DAY", "time": '$day::"%Y-%m-%d"'}}, _days(spark, sf_dir), distinct=False)
    moments = _events(spark, sf_dir, "events", {"subject_id_col": "user_id", "e": {"code": "MOMENT", "time": "$ts"}}, distinct=False)
    return diagonal_union([days, moments]).drop("source_block")


@query("""SELECT DISTINCT o_custkey AS subject_id, 'O' AS code, o_orderdate AS time, o_totalprice * 2 + 1 AS numeric_value, o_orderkey + o_custkey AS total FROM orders""")
def transforms_arith(spark, sf_dir):
    cfg = {"subject_id_col": "o_custkey", "transforms": {"twice": "$o_totalprice * 2 + 1", "total": "$o_orderkey + $o_custkey"}, "e": {"code": "O", "time": "$o_orderdate", "numeric_value": "$twice", "total": "$total"}}
    return _events(spark, sf_dir, "orders", cfg).drop("source_block")


@query("""SELECT DISTINCT c_custkey AS subject_id, 'N//' || c_nationkey AS code, CAST(NULL AS TIMESTAMP) AS time, CAST(c_nationkey AS VARCHAR) AS text_value FROM customer""")
def cast_to_text(spark, sf_dir):
    cfg = {"subject_id_col": "c_custkey", "e": {"code": 'f"N//{$c_nationkey}"', "time": None, "text_value": "$c_nationkey::str"}}
    return _events(spark, sf_dir, "customer", cfg).drop("code_components", "source_block")


@query("""SELECT count(DISTINCT c_name) AS n_keys, count(DISTINCT c_name) AS n_ids, 0 AS n_null FROM customer""")
def hash_subject_id(spark, sf_dir):
    t = spec.from_dict({"customer": {"subject_id_expr": "hash($c_name)"}}).tables["customer"]
    rows = subject_rows(_reader(spark, sf_dir)("customer"), t)
    return rows.agg(F.countDistinct("c_name").alias("n_keys"), F.countDistinct("subject_id").alias("n_ids"), F.count_if(F.col("subject_id").isNull()).cast("int").alias("n_null"))


@query("""SELECT DISTINCT o_custkey AS subject_id, 'O' AS code, o_orderdate AS time, o_totalprice AS numeric_value, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'priority ' || o_orderpriority END AS text_value FROM orders""")
def text_numeric_dedup(spark, sf_dir):
    raw = _reader(spark, sf_dir)("orders").withColumn("t", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice").cast("decimal(20,2)").cast("string")).otherwise(F.concat(F.lit("priority "), "o_orderpriority")))
    cfg = {"subject_id_col": "o_custkey", "e": {"code": "O", "time": "$o_orderdate", "numeric_value": "$o_totalprice", "text_value": "$t"}}
    return _events(spark, sf_dir, "orders", cfg, raw).drop("source_block")


@query("""SELECT DISTINCT o_custkey AS subject_id, o_orderstatus || '/' || o_orderpriority AS code, o_orderpriority, o_orderstatus FROM orders""")
def code_components(spark, sf_dir):
    rows = _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": 'f"{$o_orderstatus}/{$o_orderpriority}"', "time": "$o_orderdate"}}, distinct=False)
    return rows.select("subject_id", "code", "code_components.*").distinct()


def _cohort_events(spark, sf_dir) -> DataFrame:
    return pipeline.events_of(spec.from_dict(COHORT), _reader(spark, sf_dir))


_ALL = """
SELECT c_custkey AS subject_id, 'SEGMENT//' || c_mktsegment AS code, CAST(NULL AS TIMESTAMP) AS time, CAST(NULL AS DOUBLE) AS numeric_value, 'customer/segment' AS source_block FROM customer
UNION ALL SELECT c_custkey, 'ACCT_BALANCE', NULL, c_acctbal, 'customer/balance' FROM customer
UNION ALL SELECT c_custkey, 'NATION//' || c_nationkey, NULL, NULL, 'customer/nation' FROM customer
UNION ALL SELECT o_custkey, 'ORDER//' || o_orderstatus || '//' || o_orderpriority, o_orderdate, o_totalprice, 'orders/placed' FROM orders
UNION ALL SELECT o_custkey, 'ITEM//' || l_returnflag || '//' || l_linestatus, l_shipdate, l_quantity, 'lineitem/item' FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT user_id, 'EVENT//' || event_type, ts, value, 'events/activity' FROM events
"""


@query(f"""SELECT source_block, count(*) AS n FROM (SELECT DISTINCT * FROM ({_ALL})) GROUP BY source_block""")
def source_block_counts(spark, sf_dir):
    rows = cohort.distinct_events(_cohort_events(spark, sf_dir).drop("code_components", *cohort.ORDER))
    return rows.groupBy("source_block").agg(F.count("*").alias("n"))


@query("""SELECT n_nationkey AS k, n_name AS name, CAST(NULL AS VARCHAR) AS region FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region""")
def diagonal_union_rows(spark, sf_dir):
    read = _reader(spark, sf_dir)
    return diagonal_union([read("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), read("region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("region"))])


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS k FROM nation UNION ALL SELECT r_name FROM region""")
def supertype_union(spark, sf_dir):
    read = _reader(spark, sf_dir)
    return vertical_union([read("nation").select(F.col("n_nationkey").alias("k")), read("region").select(F.col("r_name").alias("k"))], relaxed=True)


@query("""SELECT DISTINCT o_custkey AS subject_id, l_returnflag AS code, l_shipdate AS time, l_quantity AS numeric_value FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def distinct_all(spark, sf_dir):
    cfg = {**COHORT["lineitem"], "item": {"code": "$l_returnflag", "time": "$l_shipdate", "numeric_value": "$l_quantity"}}
    return cohort.distinct_events(_events(spark, sf_dir, "lineitem", cfg, lookup="orders", distinct=False)).drop("code_components", "source_block")


@query("""SELECT o_custkey AS subject_id, o_orderstatus AS code, min(o_orderdate) AS time FROM orders GROUP BY ALL""")
def distinct_subset(spark, sf_dir):
    rows = _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": "$o_orderstatus", "time": "$o_orderdate"}}, distinct=False).drop("code_components", "source_block")
    return cohort.distinct_events(rows.select("time", "subject_id", "code"), ["subject_id", "code", "no_such_column"])


@query(f"""SELECT subject_id, code, time, numeric_value, row_number() OVER (PARTITION BY subject_id ORDER BY time NULLS FIRST, code NULLS FIRST, numeric_value NULLS FIRST, source_block) AS n FROM (SELECT DISTINCT * FROM ({_ALL}))""")
def cohort_order(spark, sf_dir):
    rows = cohort.distinct_events(_cohort_events(spark, sf_dir).drop("code_components", *cohort.ORDER))
    # the order that the cohort is written in, shown as a number
    order = Window.partitionBy("subject_id").orderBy(*cohort.sort_keys(rows, ["code", "numeric_value", "source_block"])[1:])
    return rows.select("subject_id", "code", "time", "numeric_value", F.row_number().over(order).cast("bigint").alias("n"))


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey >= 1000 AND l_orderkey < 5000""")
def row_range_scan(spark, sf_dir):
    return row_range(_reader(spark, sf_dir)("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", 1000, 5000)


@query("""SELECT c_custkey AS subject_id FROM customer UNION SELECT o_custkey FROM orders UNION SELECT user_id FROM events""")
def subject_universe(spark, sf_dir):
    return pipeline.subjects_of(spec.from_dict(COHORT), _reader(spark, sf_dir))


@query("""SELECT o_custkey AS subject_id, 'O' AS code, o_orderdate AS time, s.split FROM orders JOIN (VALUES (0, 'test'), (1, 'test'), (1, 'extra')) s(r, split) ON o_custkey % 10 = s.r""")
def shard_routing(spark, sf_dir):
    read = _reader(spark, sf_dir)
    rows = _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": "O", "time": "$o_orderdate"}}, distinct=False).drop("source_block")
    people = subjects.universe([read("orders").select(F.col("o_custkey").alias("subject_id"))])
    # subjects with digit 1 are in two external splits and appear in both
    splits = people.select("subject_id", F.explode(F.when(F.col("subject_id") % 10 == 0, F.array(F.lit("test"))).when(F.col("subject_id") % 10 == 1, F.array(F.lit("test"), F.lit("extra")))).alias("split"))
    return cohort.route(rows, splits)


def _customers(spark, sf_dir) -> DataFrame:
    return subjects.universe([_reader(spark, sf_dir)("customer").select(F.col("c_custkey").alias("subject_id"))])


def _drawn(n: int, per_shard: int = 500) -> list[str]:
    """``split/shard:place`` of the n subjects in ascending order, from the draws as they are defined: splits, subjects, then each larger split."""
    rng, shares = np.random.default_rng(1), {"train": 0.8, "tuning": 0.1, "held_out": 0.1}
    order, mixed = [list(shares)[i] for i in rng.permutation(3)], rng.permutation(n)
    ends = np.cumsum([round(shares[s] * n) for s in order[:2]])
    out = [""] * n
    for split, own in zip(order, np.split(mixed, ends)):
        shards = [range(len(own))] if len(own) <= per_shard else np.array_split(rng.permutation(len(own)), -(-len(own) // per_shard))
        for i, shard in enumerate(shards):
            for place, k in enumerate(shard):
                out[own[k]] = f"{split}/{i}:{place}"
    return out


@query(f"""
WITH a AS (SELECT unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT CASE (SELECT count(*) FROM customer) {" ".join(f"WHEN {n} THEN {_drawn(n)}" for n in (150, 1500))} END AS l))
SELECT c_custkey AS subject_id, split_part(x, '/', 1) AS split, split_part(x, ':', 1) AS shard, CAST(split_part(x, ':', 2) AS BIGINT) AS place
FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS i FROM customer) JOIN a USING (i)
""")
def iid_split(spark, sf_dir):
    return pipeline.shards_of(spark, _customers(spark, sf_dir), pipeline.Options(n_subjects_per_shard=500))


# sizes by the rule: rounded shares (.8, .1, .1), near-equal shards of at most 500
_SIZES = """
WITH s AS (SELECT split, CAST(round(share * (SELECT count(*) FROM customer)) AS BIGINT) AS n FROM (VALUES ('train', 0.8), ('tuning', 0.1), ('held_out', 0.1)) v(split, share)),
k AS (SELECT split, n, CAST(ceil(n / 500.0) AS BIGINT) AS shards FROM s)
SELECT split, split || '/' || i AS shard, n // shards + CASE WHEN i < n % shards THEN 1 ELSE 0 END AS n, n // shards + CASE WHEN i < n % shards THEN 0 ELSE -1 END AS last_place
FROM (SELECT *, unnest(range(shards)) AS i FROM k)
"""


def _sizes(shards: DataFrame) -> DataFrame:
    return shards.groupBy("split", "shard").agg(F.countDistinct("subject_id").alias("n"), F.max("place").alias("last_place"))


@query(_SIZES)
def iid_split_sizes(spark, sf_dir):
    return _sizes(pipeline.shards_of(spark, _customers(spark, sf_dir), pipeline.Options(n_subjects_per_shard=500)))


@query(_SIZES)
def hashed_split(spark, sf_dir):
    return _sizes(pipeline.shards_of(spark, _customers(spark, sf_dir), pipeline.Options(n_subjects_per_shard=500, split_by="hash")))


# fixed values: the published split of subjects 1 to 10 with seed 1 and three a shard
@query("""SELECT shard, CAST(place AS BIGINT) AS place, CAST(subject_id AS BIGINT) AS subject_id FROM (VALUES ('train/0', 0, 9), ('train/0', 1, 4), ('train/0', 2, 8), ('train/1', 0, 2), ('train/1', 1, 1), ('train/1', 2, 10), ('train/2', 0, 6), ('train/2', 1, 5), ('tuning/0', 0, 3), ('held_out/0', 0, 7)) t(shard, place, subject_id)""")
def split_golden(spark, sf_dir):
    """Ten subjects, two for each region."""
    r = F.col("r_regionkey")
    people = _reader(spark, sf_dir)("region").select(F.explode(F.array((2 * r + 1).cast("bigint"), (2 * r + 2).cast("bigint"))).alias("subject_id"))
    return pipeline.shards_of(spark, people, pipeline.Options(n_subjects_per_shard=3)).select("shard", "place", "subject_id")


@query("""SELECT 'extra' AS a, 'test' AS b, count(*) AS n FROM customer WHERE c_custkey % 10 = 1""")
def split_overlaps(spark, sf_dir):
    # digit 1 is in both
    lists = F.when(F.col("subject_id") % 10 == 0, F.array(F.lit("test"))).when(F.col("subject_id") % 10 == 1, F.array(F.lit("test"), F.lit("extra")))
    return subjects.overlaps(_customers(spark, sf_dir).select("subject_id", F.explode(lists).alias("split")))


_NEEDED = {"customer": "c_acctbal c_custkey c_mktsegment c_nationkey", "events": "event_type ts user_id value", "lineitem": "l_linestatus l_orderkey l_quantity l_returnflag l_shipdate", "orders": "o_custkey o_orderdate o_orderkey o_orderpriority o_orderstatus o_totalprice"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, '{c}' AS column_name, count({c}) AS n FROM {t}" for t, own in _NEEDED.items() for c in own.split()))
def required_columns(spark, sf_dir):
    """The columns that a specification reads, with how often each has a value."""
    read = _reader(spark, sf_dir)
    frames = [read(t).select(F.lit(t).alias("name"), F.explode(F.create_map(*[x for c in own for x in (F.lit(c), F.col(c).isNotNull())])).alias("column_name", "there")) for t, own in spec.required_columns(spec.from_dict(COHORT)).items()]
    return vertical_union(frames).groupBy("name", "column_name").agg(F.count_if("there").alias("n"))


def _codes(spark, sf_dir, cfg, metadata, **options) -> DataFrame:
    s = spec.from_dict(cfg)
    return pipeline.codes_of(s, metadata, pipeline.events_of(s, _reader(spark, sf_dir)), pipeline.Options(**options))


@query("""SELECT 'NATION//' || n_nationkey AS code, n_name AS description, 'f"NATION//{$c_nationkey}"' AS code_template FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)""")
def codes_full_match(spark, sf_dir):
    return _codes(spark, sf_dir, {"customer": COHORT["customer"]}, _reader(spark, sf_dir)).select("code", "description", "code_template")


@query("""SELECT DISTINCT c_mktsegment || '//' || c_nationkey AS code, n_name AS description FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def codes_partial_match(spark, sf_dir):
    cfg = {"customer": {"subject_id_col": "c_custkey", "e": {"code": 'f"{$c_mktsegment}//{$c_nationkey}"', "time": None, "_metadata": {"nation": {"_match_on": "c_nationkey", "description": "n_name"}}}}}
    meta = lambda name: _reader(spark, sf_dir)(name).withColumnRenamed("n_nationkey", "c_nationkey")
    return _codes(spark, sf_dir, cfg, meta).select("code", "description")


@query("""SELECT 'N//' || c_nationkey AS code, string_agg(c_mktsegment, '; ' ORDER BY c_mktsegment) AS description, string_agg('P/' || c_mktsegment, ',' ORDER BY c_mktsegment) AS parents, string_agg(c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) GROUP BY c_nationkey""")
def codes_reduce(spark, sf_dir):
    block = {"code": 'f"N//{$c_nationkey}"', "time": None, "_metadata": {"segments": {"description": "c_mktsegment", "parent_codes": "P/{c_mktsegment}", "segment": "c_mktsegment"}}}
    meta = lambda name: _reader(spark, sf_dir)("customer").select("c_nationkey", "c_mktsegment").distinct()
    got = _codes(spark, sf_dir, {"customer": {"subject_id_col": "c_custkey", "e": block}}, meta, description_separator="; ")
    return got.select("code", "description", F.array_join("parent_codes", ",").alias("parents"), F.array_join("segment", ",").alias("segments"))


@query("""SELECT coalesce(e.code, n.code) AS code, e.description AS description, n.description AS description_right FROM (SELECT r_name AS code, r_name AS description FROM region WHERE r_regionkey < 3) e FULL JOIN (SELECT r_name AS code, 'region ' || r_regionkey AS description FROM region WHERE r_regionkey > 1) n ON e.code = n.code""")
def codes_merge_existing(spark, sf_dir):
    r = _reader(spark, sf_dir)("region")
    have = r.where("r_regionkey < 3").select(F.col("r_name").alias("code"), F.col("r_name").alias("description"))
    new = r.where("r_regionkey > 1").select(F.col("r_name").alias("code"), F.concat(F.lit("region "), F.col("r_regionkey").cast("string")).alias("description"))
    return codes.merge_existing(have, new)


@query("""SELECT n_nationkey, n_name AS plain, coalesce(nullif(n_name, 'FRANCE'), 'R' || n_regionkey) AS first, CASE WHEN n_name = 'FRANCE' THEN n_name END AS when_equal, 'LOINC/' || n_name AS template, CASE WHEN n_name = 'GERMANY' THEN 'found' END AS matched, CASE WHEN n_name = 'GERMANY' THEN 'DE' WHEN n_name = 'FRANCE' THEN 'FR' END AS listed FROM nation""")
def metadata_values(spark, sf_dir):
    df = _reader(spark, sf_dir)("nation").withColumns({"a": F.nullif("n_name", F.lit("FRANCE")), "r": F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))})
    forms = {
        "plain": "n_name",
        "first": ["a", "r"],
        "when_equal": {"n_name": {"n_name": "FRANCE"}},
        "template": "LOINC/{n_name}",
        "matched": {"matcher": {"n_name": "GERMANY"}, "output": {"literal": "found"}},
        "listed": [{"matcher": {"n_name": "GERMANY"}, "output": {"literal": "DE"}}, {"matcher": {"n_name": "FRANCE"}, "output": {"literal": "FR"}}],
    }
    return df.select("n_nationkey", *[compile_value(v).alias(k) for k, v in forms.items()])


@query("""SELECT r_name AS code, CAST(NULL AS VARCHAR) AS description, 'P/' || r_name AS parents, r_regionkey AS extra FROM region""")
def codes_align(spark, sf_dir):
    got = align.align_codes(_reader(spark, sf_dir)("region").select(F.col("r_regionkey").alias("extra"), F.concat(F.lit("P/"), "r_name").alias("parent_codes"), F.col("r_name").alias("code")))
    return got.select("code", "description", F.array_join("parent_codes", ",").alias("parents"), "extra")


@query("""SELECT o_custkey AS subject_id, o_orderdate AS time, o_orderstatus AS code, CAST(CAST(o_orderkey AS FLOAT) AS DOUBLE) AS numeric_value FROM orders""")
def events_align(spark, sf_dir):
    rows = _reader(spark, sf_dir)("orders").select(F.col("o_orderstatus").alias("code"), F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").cast("string").alias("numeric_value"), F.col("o_orderdate").alias("time"))
    return align.align_events(rows).withColumn("numeric_value", F.col("numeric_value").cast("double"))


@query("""SELECT DISTINCT c_custkey AS subject_id, CASE WHEN c_custkey % 2 = 0 THEN 'taskA/held_out' ELSE 'train' END AS split FROM customer""")
def subject_splits(spark, sf_dir):
    people = _customers(spark, sf_dir)
    lists = [numbered(people.where(F.col("subject_id") % 2 == i), "subject_id", "place").select(F.lit(name).alias("split"), F.lit(i).alias("number"), "place", "subject_id") for i, name in enumerate(("taskA/held_out", "train"))]
    external = lists[0].unionByName(lists[1])
    drawn = pipeline.shards_of(spark, people, pipeline.Options(n_subjects_per_shard=100), external)
    return align.align(drawn.select("subject_id", "split").distinct(), align.SPLITS)


@query("""SELECT CASE WHEN o_custkey % 10 < 8 THEN 'train' ELSE 'held_out' END AS split, count(*) AS n FROM orders GROUP BY ALL""")
def rows_per_split(spark, sf_dir):
    rows = _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": "O", "time": "$o_orderdate"}}, distinct=False)
    people = subjects.universe([rows]).withColumn("split", F.when(F.col("subject_id") % 10 < 8, "train").otherwise("held_out"))
    return cohort.route(rows, people).groupBy("split").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey AS subject_id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def subjects_outside(spark, sf_dir):
    read = _reader(spark, sf_dir)
    everyone = subjects.universe([read("customer").select(F.col("c_custkey").alias("subject_id"))])
    return everyone.join(subjects.universe([read("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("subject_id"))]), "subject_id", "left_anti")


@query("""SELECT DISTINCT o_orderstatus || '/' || o_orderpriority AS code, o_orderpriority, o_orderstatus FROM orders""")
def component_map(spark, sf_dir):
    rows = _events(spark, sf_dir, "orders", {"subject_id_col": "o_custkey", "e": {"code": 'f"{$o_orderstatus}/{$o_orderpriority}"', "time": "$o_orderdate"}}, distinct=False)
    return codes.component_map(rows)


@query("""SELECT CAST(n_nationkey AS BIGINT) AS a, CAST(n_nationkey AS DOUBLE) + 0.5 AS b, n_nationkey % 2 = 0 AS c, n_name AS d FROM nation""")
def promoted_types(spark, sf_dir):
    n = _reader(spark, sf_dir)("nation")
    text = n.select(F.col("n_nationkey").cast("string").alias("a"), (F.col("n_nationkey") + F.lit(0.5)).cast("string").alias("b"), (F.col("n_nationkey") % 2 == 0).cast("string").alias("c"), F.col("n_name").alias("d"))
    return promote(text)


@query("""SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) r ON n.n_regionkey = r.r_regionkey""")
def left_lookup(spark, sf_dir):
    read = _reader(spark, sf_dir)
    return lookup_join(read("nation"), read("region").where("r_regionkey <> 2"), spec.Join("region", "n_regionkey", "r_regionkey", ("r_name",))).select("n_nationkey", "n_name", "r_name")


@query("""SELECT n_nationkey, n_nationkey * 2 + 1 - 3 AS a, CAST(n_nationkey AS DOUBLE) / 4 AS b, n_name || '//' || n_regionkey AS c, 'x' AS d FROM nation""")
def expressions(spark, sf_dir):
    forms = {"a": "$n_nationkey * 2 + 1 - 3", "b": "$n_nationkey::float / 4", "c": 'f"{$n_name}//{$n_regionkey}"', "d": "x"}
    return _reader(spark, sf_dir)("nation").select("n_nationkey", *[parse(v).compile().alias(k) for k, v in forms.items()])


# fixed values: 64-bit hashes of five texts, as they must stay from release to release
@query("""SELECT r_name, CAST(h AS BIGINT) AS subject_id FROM region JOIN (VALUES ('AFRICA', 5725486109973355489), ('AMERICA', -4157638607041038132), ('ASIA', -1574007566074333807), ('EUROPE', 7378977719125113014), ('MIDDLE EAST', 8048878549592645346)) v(name, h) ON r_name = name""")
def hashed_ids(spark, sf_dir):
    t = spec.from_dict({"region": {"subject_id_expr": "hash($r_name)"}}).tables["region"]
    return subject_rows(_reader(spark, sf_dir)("region"), t).select("r_name", "subject_id")


@query("""SELECT o_orderkey, '1e' || (16 + o_orderkey % 7) AS large, 'S//' || (o_orderkey + 1) || '00000000.0' AS plain, '0.0000' || (o_orderkey % 9 + 1) AS small FROM orders""")
def numbers_as_text(spark, sf_dir):
    """Numbers with a fraction, cast to text or put into a code: in plain digits unless very large or very small."""
    k = (F.col("o_orderkey") + 1).cast("string")
    rows = _reader(spark, sf_dir)("orders").select("o_orderkey", F.concat(F.lit("1e"), (16 + F.col("o_orderkey") % 7).cast("string")).cast("double").alias("a"), F.concat(k, F.lit("e8")).cast("double").alias("b"), F.concat((F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("e-5")).cast("double").alias("c"))
    return rows.select("o_orderkey", parse("$a::str").compile().alias("large"), code_of(parse('f"S//{$b}"')).alias("plain"), parse("$c::str").compile().alias("small"))


@query("""SELECT o_custkey AS subject_id, o_orderstatus AS code, o_orderdate AS time FROM orders""")
def all_rows(spark, sf_dir):
    block = spec.event("orders", "e", {"code": "$o_orderstatus", "time": "$o_orderdate"})
    rows = _reader(spark, sf_dir)("orders").withColumnRenamed("o_custkey", "subject_id")
    return cohort.distinct_events(extract_event(rows, block, source_block=False, distinct=False), None).drop("code_components")


_RUN_SPEC = """
people:
  subject_id_col: c_custkey
  segment: {code: 'f"SEGMENT//{$c_mktsegment}"', time: null}
  nation: {code: 'f"NATION//{$c_nationkey}"', time: null, _metadata: {nations: {c_nationkey: n_nationkey, description: n_name}}}
visits/orders:
  subject_id_col: o_custkey
  transforms: {day: '$at as "%Y-%m-%d"'}
  placed: {code: $o_orderstatus, time: $day, numeric_value: $o_totalprice}
"""


#: Rows that one file of a raw table made here has at most, or little more.
_FILE_ROWS = 500_000


def _parts(df: DataFrame, least: int = 3) -> int:
    """How many files a raw table is written in, so that each stays of a size whatever the table's."""
    return max(least, -(-df.count() // _FILE_ROWS))


_runs: dict[tuple, dict[str, str]] = {}


def _whole_run(spark, sf_dir, codes_there: bool = False) -> dict[str, str]:
    """A run from files to files, made once a session: a table named by its prefix only, one in a folder of gzipped CSV parts, metadata as CSV, a YAML specification."""
    key = (spark.sparkContext.applicationId, sf_dir, codes_there)
    if key not in _runs:
        read, root = _reader(spark, sf_dir), files.scratch_path(spark, "run")
        read("customer").select("c_custkey", "c_mktsegment", "c_nationkey").write.parquet(f"{root}/raw/people_0.parquet")
        orders = read("orders").select("o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("at"), "o_totalprice")
        # a gzipped file is one task's work: three, or as many as it takes
        orders.repartition(_parts(orders)).write.csv(f"{root}/raw/visits/orders", header=True, compression="gzip")
        read("nation").select("n_nationkey", "n_name").write.csv(f"{root}/raw/nations.csv", header=True)
        if codes_there:
            old = read("nation").select(F.concat(F.when(F.col("n_nationkey") < 20, "NATION//").otherwise("OLD//"), F.col("n_nationkey").cast("string")).alias("code"), F.lower("n_name").alias("description"))
            old.write.parquet(f"{root}/raw/metadata/codes.parquet")
        files.write_text(spark, f"{root}/spec.yaml", _RUN_SPEC)
        _runs[key] = pipeline.run(spark, f"{root}/spec.yaml", f"{root}/raw", f"{root}/out", pipeline.Options(n_subjects_per_shard=500))
        files.delete(spark, f"{root}/raw")
    return _runs[key]


@query("""SELECT c_custkey AS subject_id, 'SEGMENT//' || c_mktsegment AS code, CAST(NULL AS TIMESTAMP) AS time, CAST(NULL AS DOUBLE) AS numeric_value, 'people/segment' AS source_block FROM customer UNION SELECT c_custkey, 'NATION//' || c_nationkey, NULL, NULL, 'people/nation' FROM customer UNION SELECT o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE), 'visits/orders/placed' FROM orders""")
def whole_run_events(spark, sf_dir):
    got = cohort.read_cohort(spark, _whole_run(spark, sf_dir)["data"])
    return got.select("subject_id", "code", "time", F.col("numeric_value").cast("double").alias("numeric_value"), "source_block")


@query("""SELECT 'NATION//' || n_nationkey AS code, n_name AS description, 0 AS n_parents FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)""")
def whole_run_codes(spark, sf_dir):
    got = spark.read.parquet(f"{_whole_run(spark, sf_dir)['metadata']}/codes.parquet")
    return got.select("code", "description", F.size(F.coalesce("parent_codes", F.array())).alias("n_parents"))


@query("""SELECT code, e.description, n.description AS description_right FROM (SELECT CASE WHEN n_nationkey < 20 THEN 'NATION//' ELSE 'OLD//' END || n_nationkey AS code, lower(n_name) AS description FROM nation) e FULL JOIN (SELECT 'NATION//' || n_nationkey AS code, n_name AS description FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)) n USING (code)""")
def whole_run_existing_codes(spark, sf_dir):
    """A run whose input has a code dictionary already."""
    return spark.read.parquet(f"{_whole_run(spark, sf_dir, True)['metadata']}/codes.parquet").select("code", "description", "description_right")


@query("""SELECT * FROM (VALUES ('another suffix', 'ValueError'), ('no table', 'FileNotFoundError'), ('no metadata', 'FileNotFoundError'), ('no rows', 'ValueError'), ('no column', 'ValueError'), ('results there', 'FileExistsError'), ('folder name', 'ValueError')) v(what, said) UNION ALL SELECT 'first row', min(n_name) FROM nation UNION ALL SELECT 'last row', max(n_name) FROM nation""")
def refusals(spark, sf_dir):
    """What is refused, and by which error; and the rows at both ends of a table, which messages show."""
    read, root = _reader(spark, sf_dir), files.scratch_path(spark, "refused")
    nation = read("nation").orderBy("n_name").select("n_name", "n_nationkey")
    nation.write.json(f"{root}/nation.json")
    nation.where("n_nationkey < 0").coalesce(1).write.parquet(f"{root}/empty.parquet")
    nation.write.parquet(f"{root}/out/data")
    files.write_text(spark, f"{root}/spec.yaml", "nation:\n  subject_id_col: n_nationkey\n  e: {code: $n_name, time: null}\n")
    empty = read_table(spark, f"{root}/empty.parquet")
    attempts = {
        "another suffix": lambda: read_table(spark, f"{root}/nation.json"),
        "no table": lambda: find_data(spark, root, ["region"]),
        "no metadata": lambda: find_metadata(spark, root, "region"),
        "no rows": lambda: require(empty, ["n_name"], "empty"),
        "no column": lambda: require(nation, ["n_comment"], "nation"),
        "results there": lambda: pipeline.run(spark, f"{root}/spec.yaml", root, f"{root}/out"),
        "folder name": lambda: pipeline.finish_metadata(nation, nation, f"{root}/other", "overwrite", pipeline.Options()),
    }
    said = []
    for what, attempt in attempts.items():
        try:
            attempt()
            said.append((what, "nothing"))
        except Exception as e:
            said.append((what, type(e).__name__))
    first, last = ends_of(nation, 1)
    return spark.createDataFrame([*said, ("first row", first[0].n_name), ("last row", last[0].n_name)], "what string, said string")


@query("""SELECT 'rows ' || b AS what, count(*) AS n FROM (SELECT c_custkey, 'people/segment' AS b FROM customer UNION ALL SELECT c_custkey, 'people/nation' FROM customer) GROUP BY b UNION ALL SELECT 'subjects', count(*) FROM customer UNION ALL SELECT 'lines of the specification', 2 UNION ALL SELECT 'splits', 2""")
def replaced_run(spark, sf_dir):
    """A run that replaces another, with a stage of its own: rows by block as that stage counted them, subjects and the specification as published."""
    read, root = _reader(spark, sf_dir), files.scratch_path(spark, "replaced")
    text = "\n".join(_RUN_SPEC.strip().split("\n")[:4]).replace(", _metadata: {nations: {c_nationkey: n_nationkey, description: n_name}}", "")
    files.write_text(spark, f"{root}/spec.yaml", text)
    people = read("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    people.where("c_nationkey < 5").write.parquet(f"{root}/some/people.parquet")
    people.write.parquet(f"{root}/all/people.parquet")
    found: list[DataFrame] = []

    def count(c: pipeline.Context) -> None:
        by_block = c.tables["events"].groupBy("source_block").count().collect()  # one row a block
        found.append(spark.createDataFrame([(f"rows {r[0]}", r[1]) for r in by_block], "what string, n bigint"))

    pipeline.STAGES["count-blocks"] = count
    try:
        for folder, replace in (("some", False), ("all", True)):
            options = pipeline.Options(split_fracs={"a": 0.5, "b": 0.5}, do_overwrite=replace)
            out = pipeline.run(spark, f"{root}/spec.yaml", f"{root}/{folder}", f"{root}/out", options, ["raw_tables", "subjects", "cohort", "count-blocks", "codes", "metadata"])
    finally:
        del pipeline.STAGES["count-blocks"]
    splits = spark.read.parquet(f"{out['metadata']}/subject_splits.parquet")
    lines = spark.read.text(f"{out['metadata']}/spec.yaml").where("value like '%code%'")
    counts = [splits.groupBy().agg(F.count("*").alias("n")).select(F.lit("subjects").alias("what"), "n"), lines.groupBy().agg(F.count("*").alias("n")).select(F.lit("lines of the specification").alias("what"), "n"), splits.select("split").distinct().groupBy().agg(F.count("*").alias("n")).select(F.lit("splits").alias("what"), "n")]
    return vertical_union([found[-1], *counts])


@query("""SELECT id AS subject_id, CAST(1 AS BIGINT) AS n_shards, TRUE AS same FROM (SELECT c_custkey AS id FROM customer UNION SELECT o_custkey FROM orders)""")
def whole_run_splits(spark, sf_dir):
    """The shard map, read back as JSON, against the table of splits."""
    metadata = _whole_run(spark, sf_dir)["metadata"]
    shards = subjects.external_splits(spark, f"{metadata}/.shards.json").select("subject_id", F.col("split").alias("shard"))
    both = shards.join(spark.read.parquet(f"{metadata}/subject_splits.parquet"), "subject_id", "full")
    return both.groupBy("subject_id").agg(F.count("shard").alias("n_shards"), F.every(F.coalesce(F.col("shard").startswith(F.concat("split", F.lit("/"))), F.lit(False))).alias("same"))


# each block's place in the specification: table, then block
_PLACES = "(VALUES ('customer/segment', 0), ('customer/balance', 1), ('customer/nation', 2), ('orders/placed', 3), ('lineitem/item', 4), ('events/activity', 5)) b(source_block, nth)"
_SPLIT = "CASE WHEN subject_id % 10 < 8 THEN 'train' ELSE 'held_out' END"


def _two_splits(people: DataFrame) -> DataFrame:
    """Two splits of four shards by the id's last digits."""
    split = F.when(F.col("subject_id") % 10 < 8, "train").otherwise("held_out")
    return people.select("subject_id", split.alias("split"), F.concat_ws("/", split, (F.floor(F.col("subject_id") / 10) % 4).cast("string")).alias("shard"))


@query(f"""
SELECT split, shard, subject_id, code, time, numeric_value, source_block, row_number() OVER (PARTITION BY split, shard ORDER BY subject_id, time NULLS FIRST, nth, code, numeric_value NULLS FIRST) AS n
FROM (SELECT *, {_SPLIT} AS split, CAST(subject_id // 10 % 4 AS INTEGER) AS shard FROM (SELECT DISTINCT subject_id, code, time, CAST(CAST(numeric_value AS FLOAT) AS DOUBLE) AS numeric_value, source_block FROM ({_ALL})) JOIN {_PLACES} USING (source_block))
""")
def cohort_as_written(spark, sf_dir):
    """The cohort written in named files, of which a shard has as many as its rows fill, and read back with each row's number in its shard."""
    s, read = spec.from_dict(COHORT), _reader(spark, sf_dir)
    path = files.scratch_path(spark, "cohort")
    # eight shards of any size: none is one task's work
    events = pipeline.events_of(s, read).drop("code_components")
    cohort.write_cohort(pipeline.cohort_of(events, _two_splits(pipeline.subjects_of(s, read)), pipeline.Options(layout="ranges")), path, named=True)
    rows = cohort.read_in_order(spark, path, "at").withColumn("n", F.col("at") + 1)
    return rows.select("split", "shard", "subject_id", "code", "time", F.col("numeric_value").cast("double").alias("numeric_value"), "source_block", "n")


@query("""SELECT l_suppkey AS subject_id, l_orderkey || '/' || l_linenumber AS text_value, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_linenumber) AS n FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem)""")
def input_order(spark, sf_dir):
    """Events of a subject that tie in all but their position in the raw table, CSV files (at least three) in falling order of their key: as written."""
    root = files.scratch_path(spark, "order")
    items = _reader(spark, sf_dir)("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    items.repartitionByRange(_parts(items), F.desc("l_orderkey"), "l_linenumber").sortWithinPartitions(F.desc("l_orderkey"), "l_linenumber").write.csv(f"{root}/items", header=True)
    raw = read_table(spark, f"{root}/items", position=cohort.ROW)
    t = spec.from_dict({"items": {"subject_id_col": "l_suppkey", "e": {"code": "ITEM", "time": None, "text_value": 'f"{$l_orderkey}/{$l_linenumber}"'}}}).tables["items"]
    people = subjects.universe([raw.select(F.col("l_suppkey").alias("subject_id"))])
    shards = people.select("subject_id", F.lit("all").alias("split"), F.concat(F.lit("all/"), (F.col("subject_id") % 8).cast("string")).alias("shard"))
    # eight shards of any size: none is one task's work
    rows = files.materialize(cohort.route(table_events(raw, t), shards), "routed")
    cohort.write_cohort(cohort.ordered(rows, by="ranges"), f"{root}/out", named=True)
    got = cohort.read_in_order(spark, f"{root}/out", "at")
    return got.select("subject_id", "text_value", F.row_number().over(Window.partitionBy("subject_id").orderBy("at")).cast("bigint").alias("n"))


@query("""SELECT doc_id, nullif(text, '') AS text, lang FROM documents""")
def csv_line_breaks(spark, sf_dir):
    """Texts of many lines, with quotes and separators, written as CSV and read back whole."""
    root = files.scratch_path(spark, "texts")
    docs = _reader(spark, sf_dir)("documents").select("doc_id", "text", "lang")
    docs.repartition(4, "doc_id").write.csv(f"{root}/docs", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_table(spark, f"{root}/docs")


_DRIFT = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS v, o_orderstatus AS s, CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END AS more FROM orders"""


def _drifting(spark, sf_dir, write: Callable[[DataFrame, str], None]) -> str:
    """A folder of files that differ: another order of columns, an added column, and an int, a bigint and text under one name."""
    root = files.scratch_path(spark, "drift")
    o = _reader(spark, sf_dir)("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("int").alias("v"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("more"), "o_orderpriority")
    parts = [o.where("k % 3 = 0").select("k", "v", "s"), o.where("k % 3 = 1").select("s", F.col("v").cast("bigint").alias("v"), "more", "k"), o.where("k % 3 = 2").select("k", F.col("o_orderpriority").alias("v"), "s")]
    for i, part in enumerate(parts):
        write(part, f"{root}/{i}")
        for name, _ in files.children(spark, f"{root}/{i}"):
            if name.startswith("part-"):
                files.move(spark, f"{root}/{i}/{name}", f"{root}/table/{i}-{name}")
    return f"{root}/table"


@query(_DRIFT)
def csv_parts_that_differ(spark, sf_dir):
    return read_table(spark, _drifting(spark, sf_dir, lambda df, path: df.write.csv(path, header=True)))


@query(_DRIFT)
def parquet_parts_that_differ(spark, sf_dir):
    return read_table(spark, _drifting(spark, sf_dir, lambda df, path: df.write.parquet(path)))


@query("""SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS row FROM nation""")
def csv_scan(spark, sf_dir):
    """A table written as a folder of gzipped CSV files, found by its name, read with types and row numbers."""
    root = files.scratch_path(spark, "csv")
    rows = _reader(spark, sf_dir)("nation").select("n_nationkey", "n_name", "n_regionkey")
    rows.repartitionByRange(3, "n_nationkey").sortWithinPartitions("n_nationkey").write.csv(f"{root}/nation", header=True, compression="gzip")
    return read_table(spark, find_data(spark, root, ["nation"])["nation"], row_index="row")


@query("""SELECT r_regionkey, r_name FROM region""")
def literal_path_scan(spark, sf_dir):
    """A file whose name would be a pattern."""
    root = files.scratch_path(spark, "chunks")
    _reader(spark, sf_dir)("region").select("r_regionkey", "r_name").coalesce(1).write.parquet(f"{root}/[0-10).parquet")
    return read_table(spark, find_data(spark, root, ["[0-10)"])["[0-10)"])


@query("""SELECT n_name AS code, nullif(n_regionkey, 1) AS description FROM nation WHERE n_regionkey <> 1""")
def metadata_files(spark, sf_dir):
    """Two metadata files of one prefix; their rows stay text, and rows whose outputs are all null go."""
    root = files.scratch_path(spark, "metadata")
    rows = _reader(spark, sf_dir)("nation").select("n_name", F.when(F.col("n_regionkey") != 1, F.col("n_regionkey")).alias("region"))
    for i in range(2):
        rows.where(F.col("n_name") < "J" if i else F.col("n_name") >= "J").write.csv(f"{root}/deep/names_{i}.csv", header=True)
    meta = read_metadata(spark, find_metadata(spark, root, "names"))
    block = spec.event("nation", "e", {"code": "$n_name", "time": None, "_metadata": {"names": {"description": "region"}}})
    return codes.code_metadata(meta, block, block.metadata["names"]).select("code", F.col("description").cast("int").alias("description"))


@query("""SELECT DISTINCT c_custkey AS subject_id, 'KNOWN' AS code, TIMESTAMP '2020-01-02 00:00:00' AS time FROM customer""")
def constant_time(spark, sf_dir):
    """A time without columns keeps all rows if it has a value, none if it has not."""
    cfg = {"subject_id_col": "c_custkey", "a": {"code": "KNOWN", "time": '"2020-01-02 00:00:00"::"%Y-%m-%d %H:%M:%S"'}, "b": {"code": "NEVER", "time": '"x" as ?"%Y-%m-%d %H:%M:%S"'}}
    return _events(spark, sf_dir, "customer", cfg).drop("source_block")


@query("""SELECT DISTINCT o_custkey AS subject_id FROM orders WHERE o_orderstatus <> 'F' AND o_orderstatus <> 'P'""")
def subjects_without_nulls(spark, sf_dir):
    """Null and NaN ids are no subjects."""
    rows = _reader(spark, sf_dir)("orders")
    odd = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).when(F.col("o_orderstatus") != "F", F.col("o_custkey").cast("double"))
    return subjects.universe([rows.select(odd.alias("subject_id"))])


@query("""SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation""")
def strict_union(spark, sf_dir):
    read = _reader(spark, sf_dir)
    return vertical_union([read("region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")), read("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("k"))])


@query("""SELECT 'N//' || c_nationkey AS code, 'f"N//{$c_nationkey}"' AS code_template FROM customer GROUP BY c_nationkey""")
def codes_first_template(spark, sf_dir):
    """Two blocks give the same codes: the first block's template stays, as one value."""
    first = {"code": 'f"N//{$c_nationkey}"', "time": None, "_metadata": {"nation": {"description": "n_name"}}}
    second = {**first, "code": "f'N//{$c_nationkey}'"}
    meta = lambda name: _reader(spark, sf_dir)(name).withColumnRenamed("n_nationkey", "c_nationkey")
    return _codes(spark, sf_dir, {"customer": {"subject_id_col": "c_custkey", "a": first, "b": second}}, meta).select("code", "code_template")


@query(f"""SELECT DISTINCT subject_id, code, time, CAST(CAST(numeric_value AS FLOAT) AS DOUBLE) AS numeric_value, source_block, CASE WHEN subject_id % 10 < 8 THEN 'train' ELSE 'held_out' END AS split FROM ({_ALL})""")
def full_cohort(spark, sf_dir):
    s, read = spec.from_dict(COHORT), _reader(spark, sf_dir)
    made = pipeline.cohort_of(pipeline.events_of(s, read).drop("code_components"), _two_splits(pipeline.subjects_of(s, read)), pipeline.Options(layout="ranges"))
    return made.select("subject_id", "code", "time", F.col("numeric_value").cast("double").alias("numeric_value"), "source_block", "split")
