import pytest
from pyspark.sql import functions as F

from colonnade.errors import EngineError, ValidationError
from colonnade.operators import columns as C
from colonnade.operators import relational as R
from colonnade.sources import sinks
from colonnade.sources.tables import BlockSource, read
from colonnade.streaming import event_time as E


def test_dictionary_round_trip_with_nulls(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a"), (3, "b"), (4, None)], "id int, v string")
    d = C.build_dictionary(df, "v", "id")
    assert {r["value"]: r["index"] for r in d.collect()} == {None: 0, "b": 1, "a": 2}
    back = C.decode(C.encode(df, "v", d), "key", d).orderBy("id").collect()
    assert [r["value"] for r in back] == ["b", None, "a", "b", None]
    with pytest.raises(Exception, match="no such key"):
        C.decode(spark.createDataFrame([(9,)], "key int"), "key", d).collect()


def test_arrays_and_maps(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, [4])], "id int, a array<int>")
    assert [tuple(r) for r in C.array_offsets(df, "id", "a").orderBy("id").collect()] == [(1, 3, 3), (2, 0, 3), (3, 1, 4)]
    assert [r["a"] for r in C.rebuild(C.flatten(df, "id", "a"), df, "id", "a").orderBy("id").collect()] == [[1, 2, 3], [], [4]]
    cut = spark.range(1).select(C.slice_arrays(F.array(*map(F.lit, range(4))), F.array(F.lit(3), F.lit(3), F.lit(4))).alias("c")).first()["c"]
    assert cut == [[0, 1, 2], [], [3]]
    with pytest.raises(ValueError):
        C.unzip(df.select(F.struct("id", "a").alias("t")), "t", 3)


def test_joins(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (2, 1)], "k int, t int")
    right = spark.createDataFrame([(1, 5, "x"), (1, 7, "y"), (2, 3, "z")], "k int, t int, v string")
    got = {(r["k"], r["t"]): r["v"] for r in R.as_of_join(left, right, "k", "t", ["v"]).collect()}
    assert got == {(1, 5): "x", (1, 10): "y", (2, 1): None}
    many = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 1000).cast("int").alias("t"), "id")
    some = spark.range(60).select((F.col("id") % 4).alias("k"), (F.col("id") * 37 % 1000).cast("int").alias("t"), F.col("id").cast("string").alias("v"))
    plain, by_cell = (R.as_of_join(many, some, "k", "t", ["v"], cell).collect() for cell in (None, lambda t: F.floor(t / 50)))
    assert sorted(map(str, plain)) == sorted(map(str, by_cell)) and sum(r["v"] is None for r in plain) > 0
    assert R.skewed_join(left, right.select("k", "v"), "k", 3).count() == R.skewed_join(left, right.select("k", "v"), "k", 3, hot=[1]).count() == 5
    assert R.skewed_join(left, right.where("k = 2").select("k", "v"), "k", 3, "left", hot=[1, 2]).count() == 3
    with pytest.raises(EngineError):
        R.skewed_join(left, right, "k", 3, "full")
    big = spark.range(5000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"))
    assert R.hot_keys(big, "k") == [1] and R.skewed_join(big, spark.createDataFrame([(1, "x"), (4000, "y")], "k long, v string"), "k").count() == 3001
    wide = spark.createDataFrame([(0.0, 1e9, "wide"), (5.0, 6.0, "thin"), (6.0, 6.0, "none"), (-3.0, 2.5, "low")], "lo double, hi double, name string")
    points = spark.createDataFrame([(-3.0,), (2.5,), (5.5,), (6.0,), (9.9e8,), (1e9,), (None,)], "p double")
    got = sorted((r["p"], r["name"]) for r in R.range_join(points, wide, "p", "lo", "hi", 1).collect())
    assert got == [(-3.0, "low"), (2.5, "wide"), (5.5, "thin"), (5.5, "wide"), (6.0, "wide"), (9.9e8, "wide")]


def test_totals_and_extremes_read_once(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 4)], "k string, v int")
    both = R.group_with_totals(df, ["k"], [F.sum("v").alias("s")])
    assert sorted(map(str, (tuple(r) for r in both.collect()))) == sorted(["('a', False, 1)", "('b', False, 2)", "(None, False, 4)", "(None, True, 7)"])
    low_high = R.extremes_of(df)
    assert [tuple(r) for r in low_high.collect()] == [("min", "a", 1), ("max", "b", 4)]
    for out in (both, low_high):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_sinks(spark, tmp_path):
    df = spark.range(100)
    for method, level in [("none", None), ("lz4", None), ("lz4hc", 9), ("zstd", 3), ("snappy", None)]:
        sinks.write_parquet(df, f"{tmp_path}/{method}", method, level)
        assert read(spark, f"{tmp_path}/{method}").count() == 100
    for method, level in [("rar", None), ("lz4hc", 13), ("lz4", 1)]:
        with pytest.raises(ValidationError):
            sinks.compression(method, level)
    sinks.commit(df, f"{tmp_path}/whole")
    with pytest.raises(ValidationError):
        sinks.commit(df, f"{tmp_path}/whole")
    with pytest.raises(ValueError):
        read(spark, f"{tmp_path}/x", "csv")


def test_block_source(spark):
    class Squares(BlockSource):
        make = staticmethod(lambda i: ((10 * i + k,) for k in range(10)))

        @classmethod
        def name(cls):
            return "squares"

    spark.dataSource.register(Squares)
    assert spark.read.format("squares").option("blocks", 3).load().agg(F.sum("value")).first()[0] == 435


def test_stream_equals_batch(spark, tmp_path):
    events = spark.createDataFrame([(i, f"2024-01-01 00:{i:02d}:00", i % 3) for i in range(60)], "id long, ts string, k int").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"{tmp_path}/in")
    stream = E.read_stream(spark, f"{tmp_path}/in", events.schema)
    count = [F.count(F.lit(1)).alias("n")]
    E.run_once(E.windowed(stream, "ts", "10 minutes", ["k"], count), lambda df, _: df.write.mode("overwrite").parquet(f"{tmp_path}/out"), f"{tmp_path}/check", "complete")
    want = E.windowed(events, "ts", "10 minutes", ["k"], count)
    assert sorted(map(tuple, read(spark, f"{tmp_path}/out").collect())) == sorted(map(tuple, want.collect()))
    E.run_once(E.deduplicated(stream, "ts", ["k"]), lambda df, _: df.write.mode("append").parquet(f"{tmp_path}/unique"), f"{tmp_path}/check2")
    assert read(spark, f"{tmp_path}/unique").count() == 3
