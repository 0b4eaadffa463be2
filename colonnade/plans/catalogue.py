"""Registered queries with their oracle SQL: reference operators (A, B) and labelled extensions (ext_)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import types
from ..client import connect
from ..functions import scalars as S
from ..operators import columns as C
from ..operators import relational as R
from ..sources.sinks import write_parquet
from ..sources.tables import register_tables, table
from ..streaming import event_time as E

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the oracle SQL of its result."""

    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _dialect(spark: SparkSession, sf_dir: str, sql: str, tables: str, **options) -> DataFrame:
    """The frame of a dialect text over a folder's tables."""
    connection = connect(spark)
    register_tables(connection.spark, sf_dir, tables.split())
    return connection.frame(sql, options.get("parameters"))


# --- B: projections, predicates, order ---
@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def project_columns(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT * FROM nation")
def project_star(spark, d):
    return _dialect(spark, d, "SELECT * FROM nation", "nation")


@query("SELECT 1 AS one, 'hello' AS word, 42 AS answer")
def project_literals(spark, d):
    return connect(spark).frame("SELECT 1 AS one, 'hello' AS word, 42 AS answer")


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, l_linenumber % 3 AS rest, l_linenumber * 2 + 1 AS odd FROM lineitem")
def project_arithmetic(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"), (F.col("l_linenumber") % 3).alias("rest"), (F.col("l_linenumber") * 2 + 1).alias("odd"))


@query("SELECT o_orderkey, o_orderkey // 7 AS q, (-o_orderkey) // 7 AS neg FROM orders")
def integer_division(spark, d):
    return _dialect(spark, d, "SELECT o_orderkey, intDiv(o_orderkey, 7) AS q, intDiv(-o_orderkey, 7) AS neg FROM orders", "orders")


@query("SELECT * FROM customer WHERE c_custkey = 123")
def filter_equality(spark, d):
    return table(spark, d, "customer").where("c_custkey = 123")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def filter_range(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0")
def filter_conjunction(spark, d):
    return table(spark, d, "customer").where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0)).select("c_custkey", "c_name")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderdate >= DATE '1996-01-01' - INTERVAL 7 DAY AND o_orderdate < DATE '1997-01-01'")
def filter_date(spark, d):
    day = F.lit("1996-01-01").cast("date")
    return table(spark, d, "orders").where((F.col("o_orderdate") >= F.date_sub(day, 7).cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))).select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day"))


@query("SELECT n_nationkey, CAST(row_number() OVER (ORDER BY CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_name END ASC NULLS LAST, n_nationkey) AS INTEGER) AS place FROM nation")
def order_nulls_last(spark, d):
    df = table(spark, d, "nation").withColumn("name", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")))
    return df.select("n_nationkey", F.row_number().over(W.orderBy(F.asc_nulls_last("name"), "n_nationkey")).alias("place"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_topk(spark, d):
    return R.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("SELECT * FROM region LIMIT 0")
def limit_zero(spark, d):
    return table(spark, d, "region").limit(0)


@query("SELECT range AS number, range * 2 AS twice FROM range(100)")
def number_range(spark, d):
    return connect(spark).frame("SELECT number, number * 2 AS twice FROM (SELECT number FROM system.numbers LIMIT 100)")


# --- B: aggregation ---
@query("SELECT count(*) AS n, round(sum(l_quantity), 2) AS total, round(avg(l_extendedprice), 4) AS mean, min(l_shipdate) AS first, max(l_discount) AS most FROM lineitem")
def agg_scalar(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.min("l_shipdate").alias("first"), F.max("l_discount").alias("most"))


@query("SELECT event_type, count(*) AS cnt, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def group_by_column(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"), F.countDistinct("user_id").alias("users"))


@query("SELECT o_orderkey % 5 AS g, count(*) AS cnt FROM orders GROUP BY 1")
def group_by_expr(spark, d):
    return _dialect(spark, d, "SELECT o_orderkey % 5 AS g, count() AS cnt FROM orders GROUP BY g", "orders")


@query("SELECT event_type, 0 AS is_total, count(*) AS cnt, round(sum(value), 2) AS total FROM events GROUP BY event_type UNION ALL SELECT NULL, 1, count(*), round(sum(value), 2) FROM events")
def group_with_totals(spark, d):
    out = R.group_with_totals(table(spark, d, "events"), ["event_type"], [F.count(F.lit(1)).alias("cnt"), F.round(F.sum("value"), 2).alias("total")])
    return out.withColumn("is_total", F.col("is_total").cast("int"))


@query("SELECT range % 5 AS g, 20::BIGINT AS cnt, false AS is_total FROM range(5) UNION ALL SELECT NULL, 100, true")
def dialect_totals(spark, d):
    found = connect(spark).query("SELECT number % 5 AS g, count() AS cnt FROM (SELECT number FROM system.numbers LIMIT 100) GROUP BY g WITH TOTALS ORDER BY g")
    return spark.createDataFrame([(*r, False) for r in found.rows] + [(*found.totals, True)], "g long, cnt long, is_total boolean")


@query("SELECT 'min' AS extreme, min(o_orderkey) AS o_orderkey, min(o_totalprice) AS o_totalprice, min(o_orderstatus) AS o_orderstatus FROM orders UNION ALL SELECT 'max', max(o_orderkey), max(o_totalprice), max(o_orderstatus) FROM orders")
def extremes(spark, d):
    names = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    return R.extremes_of(table(spark, d, "orders").select(names)).toDF("extreme", *names)


@query("SELECT c_custkey, c_name, 'O''x' AS tag FROM customer WHERE c_acctbal < 2500 AND c_mktsegment = 'MACHINERY'")
def param_query(spark, d):
    return _dialect(spark, d, "SELECT c_custkey, c_name, {tag:String} AS tag FROM customer WHERE c_acctbal < {top:Float64} AND c_mktsegment = {seg:String}", "customer", parameters={"seg": "MACHINERY", "tag": "O'x", "top": 2500.0})


# --- B: conversions ---
@query("SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS u16, CAST(o_totalprice AS FLOAT) AS f32, CAST(o_orderkey AS VARCHAR) AS i128 FROM orders")
def cast_numeric(spark, d):
    return _dialect(spark, d, "SELECT o_orderkey, toInt32(o_orderkey) AS u16, toFloat32(o_totalprice) AS f32, toInt128(o_orderkey) AS i128 FROM orders", "orders")


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS text FROM orders")
def cast_string(spark, d):
    return _dialect(spark, d, "SELECT o_orderkey, toString(o_orderkey) AS text FROM orders", "orders")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def cast_date(spark, d):
    return _dialect(spark, d, "SELECT o_orderkey, toString(toDate32(o_orderdate)) AS day FROM orders", "orders")


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(9,2)) AS VARCHAR) AS qty, CAST(CAST(l_linenumber AS DECIMAL(18,4)) AS VARCHAR) AS line FROM lineitem")
def cast_decimal(spark, d):
    return _dialect(spark, d, "SELECT l_orderkey, l_linenumber, toString(toDecimal32(l_quantity, 2)) AS qty, CAST(CAST(l_linenumber AS DECIMAL(18,4)) AS STRING) AS line FROM lineitem", "lineitem")


@query("SELECT s_suppkey, s_name, s_suppkey * 2 AS second FROM supplier")
def tuple_struct(spark, d):
    return _dialect(spark, d, "SELECT t._1 AS s_suppkey, t._2 AS s_name, t._3 AS second FROM (SELECT tuple(s_suppkey, s_name, s_suppkey * 2) AS t FROM supplier)", "supplier")


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def struct_expand(spark, d):
    return C.unzip(table(spark, d, "supplier").select(C.zip_columns(["s_suppkey", "s_name", "s_nationkey"])), "tuple", 3)


@query("SELECT vec_id, len(embedding) AS size, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 2)), 4) AS total FROM embeddings")
def array_map(spark, d):
    df = table(spark, d, "embeddings").withColumn("twice", F.transform("embedding", lambda x: x.cast("double") * 2))
    return df.select("vec_id", F.size("twice").cast("long").alias("size"), F.round(F.aggregate("twice", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


# --- A: column transforms ---
@query('SELECT vec_id, len(embedding) AS length, sum(len(embedding)) OVER (ORDER BY vec_id) AS "end" FROM embeddings')
def array_offsets(spark, d):
    return C.array_offsets(table(spark, d, "embeddings"), "vec_id", "embedding")


@query("SELECT count(*) AS n, round(sum(CAST(x AS DOUBLE)), 4) AS total FROM (SELECT unnest(embedding) AS x FROM embeddings)")
def array_flatten(spark, d):
    return C.flatten(table(spark, d, "embeddings"), "vec_id", "embedding").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("total"))


@query("SELECT vec_id, true AS same FROM embeddings")
def array_rebuild(spark, d):
    df = table(spark, d, "embeddings")
    back = C.rebuild(C.flatten(df, "vec_id", "embedding"), df, "vec_id", "back")
    return df.join(back, "vec_id").select("vec_id", (F.col("embedding") == F.col("back")).alias("same"))


@query("SELECT event_id, 'k' AS name, CAST(json_extract(props, '$.k') AS BIGINT) AS value FROM events")
def map_roundtrip(spark, d):
    df = table(spark, d, "events").select("event_id", F.from_json("props", "map<string,bigint>").alias("m"))
    return C.map_rows(C.rebuild_maps(C.map_rows(df, "event_id", "m"), df, "event_id", "back"), "event_id", "back")


@query("SELECT o_orderkey, o_orderkey % 4 = 0 AS mask, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_custkey END AS filled, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS back FROM orders")
def nullable_split_combine(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")).alias("v"))
    return C.combine_nulls(C.split_nulls(df, "v", types.placeholder("Int64")), "v_mask", "v_filled", "back").select("o_orderkey", F.col("v_mask").alias("mask"), F.col("v_filled").alias("filled"), "back")


@query("SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS key FROM lineitem")
def dict_encode(spark, d):
    df = table(spark, d, "lineitem")
    return C.encode(df.select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag", C.build_dictionary(df, "l_returnflag")).drop("l_returnflag")


@query("SELECT l_orderkey, l_linenumber, l_returnflag AS value FROM lineitem")
def dict_decode(spark, d):
    df = table(spark, d, "lineitem")
    held = C.build_dictionary(df, "l_returnflag")
    return C.decode(C.encode(df.select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag", held), "key", held).select("l_orderkey", "l_linenumber", "value")


@query("SELECT o_custkey AS value, CAST(row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS INTEGER) AS index FROM orders GROUP BY o_custkey")
def dict_build_ordered(spark, d):
    return C.build_dictionary(table(spark, d, "orders"), "o_custkey", "o_orderkey")


@query("SELECT count(DISTINCT o_custkey) AS size, CASE WHEN count(DISTINCT o_custkey) <= 256 THEN 8 WHEN count(DISTINCT o_custkey) <= 65536 THEN 16 ELSE 32 END AS bits FROM orders")
def dict_key_width(spark, d):
    return table(spark, d, "orders").agg(F.countDistinct("o_custkey").alias("size")).select("size", C.key_width(F.col("size")).alias("bits"))


@query("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS code, l_returnflag AS label FROM lineitem")
def enum_encode(spark, d):
    members = dict(zip((k := types.parse("Enum8('A' = 1, 'N' = 2, 'R' = 3)")).labels, k.codes))
    df = table(spark, d, "lineitem").withColumn("code", S.enum_code("l_returnflag", members))
    return df.select("l_orderkey", "l_linenumber", "code", S.enum_label("code", members).alias("label"))


@query("SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days, epoch_ms(o_orderdate) AS ms, epoch_ms(o_orderdate) * 1000000 AS ns FROM orders")
def epoch_convert(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.date_to_days("o_orderdate").alias("days"), S.to_ticks("o_orderdate", 3).alias("ms"), S.to_ticks("o_orderdate", 9).alias("ns"))


@query("SELECT event_id, printf('%02d:%02d:%02d', (event_id % 86400) // 3600, (event_id % 86400) // 60 % 60, event_id % 60) AS clock FROM events")
def time_of_day(spark, d):
    return table(spark, d, "events").select("event_id", S.seconds_to_time(F.col("event_id") % 86400).alias("clock"))


@query("SELECT event_id, CAST(10 * 16777216 + (event_id // 65536 % 256) * 65536 + (event_id // 256 % 256) * 256 + event_id % 256 AS BIGINT) AS num, '10.' || (event_id // 65536 % 256) || '.' || (event_id // 256 % 256) || '.' || (event_id % 256) AS text FROM events")
def ipv4_to_num(spark, d):
    part = lambda n: F.expr(f"CAST(event_id div {n} % 256 AS STRING)")
    df = table(spark, d, "events").select("event_id", F.concat_ws(".", F.lit("10"), part(65536), part(256), part(1)).alias("text")).withColumn("num", S.ipv4_to_num("text"))
    return df.select("event_id", "num", S.num_to_ipv4("num").alias("text"))


@query("SELECT event_id, '2001:db8::' || CASE WHEN event_id = 0 THEN '' ELSE lower(printf('%x', event_id % 65535 + 1)) END AS address FROM events WHERE event_id > 0")
def ipv6_canonical(spark, d):
    df = table(spark, d, "events").where("event_id > 0").select("event_id", F.concat(F.lit("2001:0DB8:0:0:0:0:0:"), F.lpad(F.hex(F.col("event_id") % 65535 + 1), 4, "0")).alias("raw"))
    return df.select("event_id", S.canonical_ipv6("raw").alias("address"))


@query("SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS id FROM (SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS h FROM events)")
def uuid_normalise(spark, d):
    return table(spark, d, "events").select("event_id", S.uuid_normalise(F.upper(F.md5(F.col("event_id").cast("string").cast("binary")))).alias("id"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_extract(spark, d):
    return table(spark, d, "events").select("event_id", S.json_value("props", "$.k", "int").alias("k"))


@query("SELECT o_orderkey, CAST(CAST(o_orderkey AS HUGEINT) + CAST('99999999999999999999999999999' AS HUGEINT) AS VARCHAR) AS total FROM orders")
def wide_integer_add(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.wide_add(128)(F.col("o_orderkey").cast("string"), F.lit("9" * 29)).alias("total"))


@query("SELECT o_orderkey, o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER) * 7) AS weeks, o_orderdate + to_months(CAST(o_orderkey % 5 AS INTEGER) * 3) AS quarters FROM orders")
def interval_add(spark, d):
    n = (F.col("o_orderkey") % 5).cast("int")
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_orderdate") + S.interval(n, "week")).alias("weeks"), (F.col("o_orderdate") + S.interval(n, "quarter")).alias("quarters"))


@query("SELECT c_custkey, CAST(c_nationkey AS SMALLINT) AS nation FROM customer")
def checked_column(spark, d):
    return table(spark, d, "customer").select("c_custkey", types.checked("UInt8", F.col("c_nationkey"), "c_nationkey").alias("nation"))


@query("SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) AS x, CAST(s_nationkey AS DOUBLE) AS y FROM supplier")
def point_pack(spark, d):
    packed = table(spark, d, "supplier").select("s_suppkey", F.struct(F.col("s_acctbal").alias("x"), F.col("s_nationkey").alias("y")).cast(types.spark_type("Point")).alias("p"))
    return packed.select("s_suppkey", "p.x", "p.y")


@query("SELECT event_id, event_type AS text, 32 AS digits, true AS same FROM events")
def text_and_hash(spark, d):
    df = table(spark, d, "events").select("event_id", S.valid_text(F.col("event_type").cast("binary")).alias("text"), S.block_hash("event_id", "event_type").alias("h"), "event_type")
    return df.select("event_id", "text", F.length("h").alias("digits"), S.verified("h", "event_id", "event_type").alias("same"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'nan' WHEN 1 THEN 'infinity' WHEN 2 THEN '-infinity' ELSE 'finite' END AS kind FROM events")
def float_specials(spark, d):
    k = F.col("event_id") % 4
    x = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, float("-inf")).otherwise(F.col("event_id").cast("double"))
    return table(spark, d, "events").select("event_id", S.float_kind(x).alias("kind"))


@query("SELECT event_id, 'k' AS name, CAST(json_extract(props, '$.k') AS BIGINT) AS value FROM events")
def map_split(spark, d):
    df = table(spark, d, "events").select("event_id", F.from_json("props", "map<string,bigint>").alias("m"))
    names, values = C.map_columns("m")
    return df.select("event_id", names[0].alias("name"), values[0].alias("value"))


@query("SELECT s_suppkey, true AS same FROM supplier")
def array_slices(spark, d):
    whole = F.array(*[F.col("s_suppkey") + i for i in range(6)])
    cut = C.slice_arrays(whole, F.array(F.lit(1), F.lit(1), F.lit(6)))
    return table(spark, d, "supplier").select("s_suppkey", ((F.size(cut) == 3) & (F.flatten(cut) == whole) & (F.size(cut[1]) == 0)).alias("same"))


# --- A: inserts and streamed results ---
def _scratch(spark: SparkSession, columns: str):
    """A connection and a new table; names differ from run to run, as an old run's files may still lie in the warehouse."""
    connection, name = connect(spark, timeout=None), f"scratch_{uuid.uuid4().hex[:12]}"
    connection.query(f"CREATE TABLE {name} ({columns}) ENGINE = MergeTree() ORDER BY id")
    return connection, name


@query("SELECT range AS id, 'n' || range AS name, range * 1.5::DOUBLE AS value FROM range(1000)")
def insert_roundtrip(spark, d):
    connection, name = _scratch(spark, "id UInt32, name String, value Float64")
    n = range(1000)
    connection.insert(f"INSERT INTO {name} VALUES", [{"name": "id", "type": "UInt32", "data": list(n)}, {"name": "name", "type": "String", "data": [f"n{i}" for i in n]}, {"name": "value", "type": "Float64", "data": [i * 1.5 for i in n]}])
    return spark.table(name)


@query("SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS value FROM orders")
def insert_select(spark, d):
    connection, name = _scratch(spark, "id Int64, value String")
    register_tables(connection.spark, d, ["orders"])
    connection.query(f"INSERT INTO {name} SELECT o_orderkey, toString(o_orderkey) FROM orders")
    return spark.table(name)


@query("SELECT range AS id, range % 7 AS g FROM range(500)")
def stream_insert(spark, d):
    connection, name = _scratch(spark, "id UInt32, g Int32")

    def blocks(at: int):
        if at == 500:
            return ("done", at)
        n = range(at, at + 100)
        return ("ok", [{"name": "id", "data": list(n)}, {"name": "g", "data": [i % 7 for i in n]}], at + 100)

    connection.streaming_insert(f"INSERT INTO {name} VALUES", [("id", "UInt32"), ("g", "Int32")], blocks, 0)
    return spark.table(name).select("id", F.col("g").cast("long").alias("g"))


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0")
def stream_copy(spark, d):
    connection, name = _scratch(spark, "id Int64, name String")
    register_tables(connection.spark, d, ["customer"])
    connection.copy("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0", name)
    return spark.table(name)


@query("SELECT count(*) AS n, sum(n_nationkey) AS total FROM nation")
def stream_fold_count(spark, d):
    connection = connect(spark)
    register_tables(connection.spark, d, ["nation"])
    step = lambda e, acc: (acc[0] + 1, acc[1] + e[3]) if e[0] == "data" else acc
    n, total = connection.query("SELECT n_nationkey FROM nation", on_data=step, initial=(0, 0))
    return spark.createDataFrame([(n, total)], "n long, total long")


@query("SELECT array_to_string(list(n_name ORDER BY n_nationkey), ',') AS names, count(*) AS n FROM nation")
def collect_columns(spark, d):
    connection = connect(spark)
    register_tables(connection.spark, d, ["nation"])
    found = connection.query("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey").to_columns()
    return spark.createDataFrame([(",".join(found["n_name"]), len(found["n_nationkey"]))], "names string, n long")


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def compressed_roundtrip(spark, d):
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/compressed_{uuid.uuid4().hex[:12]}"
    write_parquet(table(spark, d, "lineitem").select("l_returnflag", "l_orderkey"), path, "zstd", 3, sort_by=["l_returnflag"])
    return spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total, CAST(ceil(count(*) / 980.0) AS INTEGER) AS batches FROM orders")
def stream_batches(spark, d):
    connection = connect(spark)
    register_tables(connection.spark, d, ["orders"])
    n = total = batches = 0
    for batch in connection.batches("SELECT o_orderkey FROM orders ORDER BY o_orderkey", 980):
        n, total, batches = n + len(batch), total + sum(r[0] for r in batch), batches + 1
    return spark.createDataFrame([(n, total, batches)], "n long, total long, batches int")


@query("SELECT 1 AS found")
def system_tables(spark, d):
    connection, name = _scratch(spark, "id Int64")
    return connection.frame("SELECT CAST(count() AS INT) AS found FROM system.tables WHERE name = {name:String}", {"name": name})


# --- C: extensions, not part of the reference ---
@query("SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def ext_join_inner(spark, d):
    per = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    return per.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "customers", "balance")


@query("SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def ext_join_left(spark, d):
    per = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return table(spark, d, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


@query("SELECT coalesce(s_nationkey, c_nationkey) AS nation, suppliers, customers FROM (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) FULL JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) ON s_nationkey = c_nationkey")
def ext_join_full(spark, d):
    a = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    b = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    return a.join(b, "nation", "full")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def ext_join_semi(spark, d):
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'")
    return table(spark, d, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def ext_join_anti(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT p_partkey, size_class FROM part JOIN (VALUES (0, 10, 'small'), (10, 30, 'middle'), (30, 60, 'large')) AS b(lo, hi, size_class) ON p_size >= lo AND p_size < hi")
def ext_join_range(spark, d):
    bands = spark.createDataFrame([(0, 10, "small"), (10, 30, "middle"), (30, 60, "large")], "lo int, hi int, size_class string")
    return R.range_join(table(spark, d, "part"), bands, "p_size", "lo", "hi", 10).select("p_partkey", "size_class")


@query("SELECT e.event_id, p.event_id AS buy_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON e.user_id = p.user_id AND e.ts >= p.ts WHERE e.event_type = 'click'")
def ext_join_asof(spark, d):
    events = table(spark, d, "events")
    buys = events.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("buy_id"))
    return R.as_of_join(events.where("event_type = 'click'").select("event_id", "user_id", "ts"), buys, "user_id", "ts", ["buy_id"], lambda t: F.date_trunc("day", t)).select("event_id", "buy_id")


@query("SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 49")
def ext_join_skewed(spark, d):
    lines = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    return R.skewed_join(lines, orders, "key", 4).select(F.col("key").alias("l_orderkey"), "l_linenumber", "o_orderstatus")


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER w AS INTEGER) AS n, lag(o_orderkey) OVER w AS before, round(sum(o_totalprice) OVER w, 2) AS running FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)")
def ext_window_running(spark, d):
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).alias("n"), F.lag("o_orderkey").over(w).alias("before"), F.round(F.sum("o_totalprice").over(w.rowsBetween(W.unboundedPreceding, 0)), 2).alias("running"))


@query("SELECT c_nationkey, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 3")
def ext_limit_by(spark, d):
    return R.limit_by(table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), 3, ["c_nationkey"], F.desc("c_acctbal"), F.asc("c_custkey"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def ext_set_union(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def ext_set_intersect(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@query("SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0")
def ext_set_except(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("k")).subtract(table(spark, d, "customer").where("c_custkey % 2 = 0").select("c_custkey"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def ext_rollup(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("level"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus) HAVING count(*) > 100")
def ext_cube_having(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")).where("n > 100")


@query("WITH big AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN total > 500000 THEN 'high' ELSE 'low' END AS class FROM customer JOIN big ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_name LIKE 'Customer%' AND c_acctbal BETWEEN 10 AND 9000")
def ext_cte_case(spark, d):
    return _dialect(spark, d, "WITH big AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN total > 500000 THEN 'high' ELSE 'low' END AS class FROM customer JOIN big ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_name LIKE 'Customer%' AND c_acctbal BETWEEN 10 AND 9000", "customer orders")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def ext_tumbling_window(spark, d):
    out = E.windowed(table(spark, d, "events"), "ts", "1 hour", ["event_type"], [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


@query("SELECT user_id, min(ts) AS session_start, count(*) AS n FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s")
def ext_session_window(spark, d):
    out = E.sessions(table(spark, d, "events"), "ts", "30 minutes", ["user_id"], [F.count(F.lit(1)).alias("n")])
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


# --- B: texts of the dialect ---
@query("SELECT s_suppkey, s_suppkey + 1 AS first, 'k' || s_suppkey AS name, s_suppkey * 10 AS second FROM supplier")
def dialect_subscripts(spark, d):
    return _dialect(spark, d, "SELECT s_suppkey, [s_suppkey + 1, 2][1] AS first, m['name'] AS name, (pair)[2] AS second FROM (SELECT s_suppkey, map('name', concat('k', toString(s_suppkey))) AS m, [0, s_suppkey * 10] AS pair FROM supplier) t", "supplier")


@query("WITH t AS (SELECT o_orderpriority AS p, o_totalprice AS v FROM orders) SELECT p, count(*) AS n, false AS is_total FROM t GROUP BY p HAVING count(*) > 1 UNION ALL SELECT NULL, count(*), true FROM t")
def dialect_totals_cte(spark, d):
    connection = connect(spark)
    register_tables(connection.spark, d, ["orders"])
    found = connection.query("with t as (select o_orderpriority as p, o_totalprice as v from orders) select p, count() as n from t group by p with totals having count() > 1 order by p limit 100")
    return spark.createDataFrame([(*r, False) for r in found.rows] + [(*found.totals, True)], "p string, n long, is_total boolean")


@query("SELECT s_suppkey, CAST(s_suppkey % 256 AS BIGINT) + 16909056 AS num, '::' || printf('%x', s_suppkey % 4096 + 1) AS v6 FROM supplier")
def dialect_network(spark, d):
    return _dialect(spark, d, "SELECT s_suppkey, toIPv4(concat('1.2.3.', toString(s_suppkey % 256))) AS num, toIPv6(concat('0:0:0:0:0:0:0:', lower(hex(s_suppkey % 4096 + 1)))) AS v6 FROM supplier", "supplier")


@query("SELECT n_nationkey, printf('00000000-0000-0000-0000-%012d', n_nationkey) AS id FROM nation")
def dialect_uuid(spark, d):
    return _dialect(spark, d, "SELECT n_nationkey, toUUID(lpad(toString(n_nationkey), 32, '0')) AS id FROM nation", "nation")


@query("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 MILLISECOND * 250 AS at FROM orders")
def dialect_datetime64(spark, d):
    return _dialect(spark, d, "SELECT o_orderkey, CAST(toDateTime64(concat(toString(toDate(o_orderdate)), ' 00:00:00.250'), 3) AS TIMESTAMP_NTZ) AS at FROM orders", "orders")


@query("SELECT p_partkey, [p_size + 1, p_size * 2] AS mapped, CASE WHEN p_size > 25 THEN [p_size] ELSE [] END AS kept FROM part")
def dialect_array_map(spark, d):
    return _dialect(spark, d, "SELECT p_partkey, arrayMap(x -> x + p_size, [1, p_size]) AS mapped, arrayFilter(x -> x > 25, [p_size]) AS kept FROM part", "part")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive FROM customer")
def dialect_nullable(spark, d):
    return _dialect(spark, d, "SELECT c_custkey, toNullable(CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE NULL END) AS positive FROM customer", "customer")


@query("SELECT 7::BIGINT AS id, 'it''s' AS name, [1, 2] AS tags, 'x' AS k")
def insert_with_parameters(spark, d):
    connection, name = _scratch(spark, "id Int64, name String, tags Array(Int32), attrs Map(String, String)")
    connection.query(f"INSERT INTO {name} VALUES ({{id:Int64}}, {{name:String}}, [1, 2], {{'k': 'x'}})", {"id": 7, "name": "it's"})
    return connection.frame(f"SELECT id, name, tags, attrs['k'] AS k FROM {name}")


@query("SELECT 3::BIGINT AS n, 'unknown_table' AS missing, 'syntax_error' AS broken, 'unknown_identifier' AS unknown")
def errors_and_atomicity(spark, d):
    """A failed insert leaves the rows before it, and failures say of what kind they are."""
    from ..errors import EngineError

    connection, name = _scratch(spark, "id UInt32")
    connection.insert(f"INSERT INTO {name} VALUES", [{"name": "id", "type": "UInt32", "data": [1, 2, 3]}])

    def kind(run: Callable) -> str:
        try:
            run()
        except EngineError as e:
            return e.kind
        return ""

    kind(lambda: connection.insert(f"INSERT INTO {name} VALUES", [{"name": "id", "type": "UInt32", "data": [4, -5]}]))
    texts = ["SELECT * FROM absent_table", "SELECT 1 + FROM WHERE )", f"SELECT absent FROM {name}"]
    kinds = [kind(lambda t=t: connection.query(t)) for t in texts]
    return spark.createDataFrame([(spark.table(name).count(), *kinds)], "n long, missing string, broken string, unknown string")


# --- C: extensions ---
@query("SELECT n_name, coalesce(suppliers, 0) AS suppliers FROM (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) RIGHT JOIN nation ON s_nationkey = n_nationkey")
def ext_join_right(spark, d):
    per = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    return per.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "right").select("n_name", F.coalesce("suppliers", F.lit(0)).alias("suppliers"))


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def ext_join_cross(spark, d):
    """Both tables have a fixed size, whatever the scale."""
    return table(spark, d, "region").select("r_name").crossJoin(table(spark, d, "nation").select("n_name"))


@query("SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey <> b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def ext_join_theta(spark, d):
    a, b = (table(spark, d, "nation").select(F.col("n_name").alias(n), F.col("n_regionkey").alias(f"r{n}"), F.col("n_nationkey").alias(f"k{n}")) for n in "ab")
    return a.join(b, (F.col("ra") != F.col("rb")) & (F.col("ka") < F.col("kb"))).select("a", "b")


@query("SELECT c_custkey, c_name, s_name FROM customer JOIN (SELECT s_nationkey, max(s_name) AS s_name FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey")
def ext_join_broadcast(spark, d):
    per = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.max("s_name").alias("s_name"))
    return R.sized_join(table(spark, d, "customer"), per, "c_nationkey").select("c_custkey", "c_name", "s_name")


@query("SELECT p_partkey, x AS step FROM part, unnest(range(1, 1 + p_size % 4)) AS t(x)")
def ext_lateral(spark, d):
    return _dialect(spark, d, "SELECT p_partkey, step FROM part, LATERAL explode(slice(sequence(1L, 4L), 1, toInt32(p_size % 4))) AS t(step)", "part")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def ext_distinct(spark, d):
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("SELECT event_type, abs(0) < 1 AS near FROM events GROUP BY 1")
def ext_approx_distinct(spark, d):
    """Within three of the sketch's standard errors of the exact count."""
    counted = table(spark, d, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("a"), F.countDistinct("user_id").alias("b"))
    return counted.select("event_type", (F.abs(F.col("a") - F.col("b")) <= F.greatest(F.lit(2), 0.06 * F.col("b"))).alias("near"))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 10")
def ext_offset(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").offset(10).limit(20)


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def ext_set_union_all(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).unionAll(table(spark, d, "supplier").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def ext_set_intersect_all(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersectAll(table(spark, d, "supplier").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def ext_set_except_all(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).exceptAll(table(spark, d, "supplier").select("s_nationkey"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer) AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey BETWEEN 1 AND 3) AND c_name LIKE '%1_'")
def ext_subqueries(spark, d):
    return _dialect(spark, d, "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer) AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey BETWEEN 1 AND 3) AND c_name LIKE '%1_'", "customer nation")


@query("SELECT c_custkey, CAST(rank() OVER w AS INTEGER) AS r, CAST(dense_rank() OVER w AS INTEGER) AS dr, CAST(ntile(4) OVER v AS INTEGER) AS quarter, lead(c_custkey) OVER v AS next FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_mktsegment), v AS (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey)")
def ext_window_ranks(spark, d):
    w, v = W.partitionBy("c_nationkey").orderBy("c_mktsegment"), W.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")
    return table(spark, d, "customer").select("c_custkey", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("dr"), F.ntile(4).over(v).alias("quarter"), F.lead("c_custkey").over(v).alias("next"))


@query("SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * i AS window_start, count(*) AS n FROM events, range(2) t(i) GROUP BY 1")
def ext_sliding_window(spark, d):
    counted = table(spark, d, "events").groupBy(F.window("ts", "1 hour", "30 minutes")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "n")


@query("SELECT c_custkey, upper(substr(c_name, 1, 4)) AS head, length(c_name) AS size, replace(c_name, '#', '-') AS dashed, round(sqrt(abs(c_acctbal)), 6) AS root, c_mktsegment LIKE 'B%' AS b FROM customer")
def ext_scalars(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.upper(F.substring("c_name", 1, 4)).alias("head"), F.length("c_name").cast("long").alias("size"), F.replace("c_name", F.lit("#"), F.lit("-")).alias("dashed"), F.round(F.sqrt(F.abs("c_acctbal")), 6).alias("root"), F.col("c_mktsegment").startswith("B").alias("b"))


@query("SELECT p_partkey, w AS word, CAST(i - 1 AS INTEGER) AS place FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part)")
def ext_udtf(spark, d):
    """A table function over Arrow-free rows: one row a word."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="place int, word string")
    class Words:
        def eval(self, text: str):
            yield from enumerate(text.split(" "))

    s = connect(spark).spark
    s.udtf.register("words_of", Words)
    register_tables(s, d, ["part"])
    return s.sql("SELECT p_partkey, word, place FROM part, LATERAL words_of(p_name)")


@query("SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def ext_view(spark, d):
    connection = connect(spark)
    register_tables(connection.spark, d, ["orders"])
    connection.query("CREATE OR REPLACE TEMPORARY VIEW per_priority AS SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority")
    return connection.frame("SELECT * FROM per_priority")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def ext_file_formats(spark, d):
    """Through CSV, JSON and ORC files and back."""
    from ..sources.tables import read

    df = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for kind in ("csv", "json", "orc"):
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/formats_{uuid.uuid4().hex[:12]}"
        df.write.format(kind).save(path)
        df = read(spark, path, kind, df.schema)
    return df


@query("SELECT n_nationkey, 0 AS waited, true AS dated FROM nation")
def dialect_sleep_and_clock(spark, d):
    return _dialect(spark, d, "SELECT n_nationkey, sleep(0.01) AS waited, today() <= toDate(now()) AND length(version()) > 0 AS dated FROM nation", "nation")


@query("SELECT c_nationkey, round(sum(c_acctbal) / count(*), 6) AS mean FROM customer GROUP BY 1")
def ext_udaf(spark, d):
    """A grouped aggregate in pandas, over Arrow batches."""

    @F.pandas_udf("double")
    def mean(values: pd.Series) -> float:
        return float(values.mean())

    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.round(mean("c_acctbal"), 6).alias("mean"))
