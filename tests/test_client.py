import threading
import time
import uuid

import pytest

from colonnade import errors
from colonnade.client import connect
from colonnade.dialect import translate


@pytest.fixture
def connection(spark):
    c = connect(spark, timeout=120)
    yield c
    c.close()


def test_totals_are_kept_apart(connection):
    found = connection.query("SELECT number % 5 AS g, count() AS cnt FROM (SELECT number FROM system.numbers LIMIT 100) GROUP BY g WITH TOTALS ORDER BY g")
    assert found.rows == [[g, 20] for g in range(5)] and found.totals == [None, 100]


def test_extremes(connection):
    found = connection.query("SELECT number FROM system.numbers LIMIT 100", settings={"extremes": 1})
    assert len(found.rows) == 100 and found.extremes == {"min": [0], "max": [99]}


def test_parameters(connection):
    assert connection.query("SELECT {b:String} AS b, {a:UInt64} AS a", {"a": 7, "b": "o'x"}).rows == [["o'x", 7]]
    with pytest.raises(errors.MissingParameter):
        connection.query("SELECT {a:UInt64}")
    with pytest.raises(errors.OutOfRange):
        connection.query("SELECT {a:UInt8}", {"a": 256})


def test_repeated_names_and_empty_results_keep_their_shape(connection):
    found = connection.query("SELECT 1 AS a, 2 AS a")
    assert [c["name"] for c in found.columns] == ["a", "a"] and found.rows == [[1, 2]]
    assert [c["name"] for c in connection.query("SELECT 1 AS a LIMIT 0").columns] == ["a"]


def test_fold_equals_batch(connection):
    sql = "SELECT number, number * 2 AS twice FROM (SELECT number FROM system.numbers LIMIT 1000)"
    events = {"data": 0, "block_end": 0, "end": 0}

    def step(event, acc):
        events[event[0]] += 1
        return acc + event[3] if event[0] == "data" else acc

    total = connection.query(sql, on_data=step, initial=0)
    assert total == sum(map(sum, connection.query(sql).rows)) == 3 * 999 * 1000 // 2
    assert events["data"] == 2000 and events["end"] == 1
    assert [len(b) for b in connection.batches(sql, 300)] == [300, 300, 300, 100]


def test_callback_failures(connection):
    def bad(event, acc):
        raise RuntimeError("no")

    with pytest.raises(errors.CallbackFailed):
        connection.query("SELECT 1", on_data=bad)
    with pytest.raises(errors.ValidationError) as e:
        connection.query("SELECT 1", on_data=lambda a: a)
    assert e.value.kind == "invalid_callback_arity"
    seen = []
    assert connection.query("SELECT 1", on_log=seen.append, on_progress=seen.append).rows == [[1]]
    assert any("rows" in s for s in seen) and any("text" in s for s in seen)


def test_error_kinds(connection):
    for sql, kind in [("SELECT * FROM missing_table", "unknown_table"), ("SELECT nope FROM (SELECT 1 AS a)", "unknown_identifier"), ("SELECT FROM FROM", "unknown_table"), ("SELECT (", "syntax_error"), ("SELECT intDiv(1, 0)", "division_by_zero"), ("SELECT CAST('x' AS INT)", "cannot_parse_number")]:
        with pytest.raises(errors.EngineError) as e:
            connection.query(sql)
        if sql != "SELECT FROM FROM":
            assert e.value.kind == kind, sql
    assert errors.is_schema_error(errors.ServerError("", kind="unknown_table")) and errors.find_by_code(errors.ServerError("", kind="unknown_table"), 60)
    with pytest.raises(errors.UnknownSetting):
        connection.query("SELECT 1", settings={"nope": 1})
    with pytest.raises(errors.EngineError):
        connection.query("  ")


def test_insert_and_streams(connection):
    connection.query("DROP TABLE IF EXISTS t1")
    connection.query("CREATE TABLE t1 (id UInt32, name String, tags Array(String)) ENGINE = Memory")
    block = lambda ids: [{"name": "id", "type": "UInt32", "data": ids}, {"name": "name", "type": "String", "data": [f"n{i}" for i in ids]}, {"name": "tags", "type": "Array(String)", "data": [["x"] * min(i, 3) for i in ids]}]
    assert connection.insert("INSERT INTO t1 VALUES", block([1, 2]))["rows_inserted"] == 2
    assert connection.insert("INSERT INTO t1 VALUES", block([]))["rows_inserted"] == 0
    with pytest.raises(errors.OutOfRange):
        connection.insert("INSERT INTO t1 VALUES", block([3, 2**32]))
    with pytest.raises(errors.ValidationError) as e:
        connection.insert("INSERT INTO t1 VALUES", [{"name": "id", "type": "UInt32", "data": [1]}, {"name": "name", "type": "String", "data": []}])
    assert e.value.kind == "row_count_mismatch" and connection.query("SELECT count() FROM t1").rows == [[2]]
    stream = connection.start_streaming_insert("INSERT INTO t1 (id, name)", [("id", "UInt32"), ("name", "String")])
    with pytest.raises(errors.Busy):
        connection.start_streaming_insert("INSERT INTO t1", [])
    with pytest.raises(errors.ValidationError):
        stream.send([{"name": "name", "data": ["a"]}, {"name": "id", "data": [1]}])
    assert stream.send([{"name": "id", "data": [7]}, {"name": "name", "data": ["z"]}]) == 1
    assert stream.send([{"name": "id", "data": []}, {"name": "name", "data": []}]) == 0
    assert connection.query("SELECT count() FROM t1").rows == [[2]]
    done = stream.finish()
    assert (done["rows_inserted"], done["blocks_sent"]) == (1, 1)
    assert connection.query("SELECT id, name, tags FROM t1 ORDER BY id").rows == [[1, "n1", ["x"]], [2, "n2", ["x", "x"]], [7, "z", None]]
    connection.query("INSERT INTO t1 VALUES (9, 'v', ['p', 'q'])")
    assert connection.query("SELECT tags FROM t1 WHERE id = {id:UInt32}", {"id": 9}).rows == [[["p", "q"]]]
    with pytest.raises(errors.CallbackFailed):
        connection.streaming_insert("INSERT INTO t1", [("id", "UInt32")], lambda acc: ("error", "stop"))
    assert connection.query("SELECT count() FROM t1").rows == [[4]]


def test_cancel_and_timeout(connection):
    connection.spark.udf.register("nap", lambda x: time.sleep(0.2) or x, "long")
    slow = "SELECT sum(nap(id)) FROM range(0, 200, 1, 2)"
    with pytest.raises(errors.Timeout):
        connection.query(slow, timeout=2)
    timer = threading.Timer(2, lambda: connection.cancel("q1"))
    timer.start()
    with pytest.raises(errors.Cancelled):
        connection.query(slow, query_id="q1")
    assert connection.cancel() is False and connection.query("SELECT 1").rows == [[1]]


def test_quotes_and_comments_stay():
    for text in ["SELECT '{a:UInt8} count() [1]' AS x", "SELECT 1 -- count() {b:Int8}", "SELECT 'it''s [x]', \"a[1]\"", "SELECT /* toString(1) */ 1"]:
        assert translate(text).sql == text


def test_subscripts_and_literals():
    from colonnade.dialect import translate

    sql = lambda text: translate(text).sql
    assert sql("SELECT a[1] AS x, m['k'] FROM t") == "SELECT try_element_at(a, 1) AS x, try_element_at(m, 'k') FROM t"
    assert sql("SELECT t.a[1][2], f(x)[3], (p)[1], `q r`[-1]") == "SELECT try_element_at(try_element_at(t.a, 1), 2), try_element_at(f(x), 3), try_element_at((p), 1), try_element_at(`q r`, -1)"
    assert sql("SELECT [1, 2], x IN ([3]), [a[1]] FROM t WHERE [4] = b") == "SELECT array(1, 2), x IN (array(3)), array(try_element_at(a, 1)) FROM t WHERE array(4) = b"
    assert sql("SELECT arrayMap(x -> [x], a)") == "SELECT transform(a, x -> array(x))"


def test_totals_keep_clauses_apart(spark):
    c = connect(spark)
    c.spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 9)], "k string, v int").createOrReplaceTempView("totalled")
    got = c.query("with x as (select k, v from totalled) select k, sum(v) s from x group by k with totals having sum(v) > 1 order by s desc limit 1", on_log=None)
    assert got.rows == [["c", 9]] and got.totals == [None, 15] and [x["name"] for x in got.columns] == ["k", "s"]
    assert c.query("SELECT DISTINCT k, count() AS n FROM totalled GROUP BY k WITH TOTALS").totals == [None, 4]
    low = c.query("SELECT k, sum(v) AS s FROM totalled GROUP BY k WITH TOTALS", settings={"extremes": "1"})
    assert low.extremes == {"min": ["a", 1], "max": ["c", 9]} and sorted(low.rows) == [["a", 1], ["b", 5], ["c", 9]]


def test_progress_profile_and_events(spark, tmp_path):
    spark.range(0, 200_000, 1, 8).write.parquet(f"{tmp_path}/t")
    c = connect(spark)
    c.spark.read.parquet(f"{tmp_path}/t").createOrReplaceTempView("watched")
    seen, profile, events = [], [], []
    found = c.query("SELECT id FROM watched ORDER BY id DESC LIMIT 7", on_progress=seen.append, on_profile=profile.append, on_profile_events=events.append)
    assert len(found.rows) == 7 and seen[-1]["rows"] >= 200_000 and seen[-1]["bytes"] > 0 and seen[-1]["tasks"] == seen[-1]["total_tasks"] > 0
    assert profile[0]["rows"] == 7 and profile[0]["rows_before_limit"] == 200_000 and profile[0]["applied_limit"] and profile[0]["blocks"] == 1
    assert events[0]["InputRecords"] >= 200_000 and events[0]["Jobs"] >= 1 and events[0]["ExecutorRunTimeMs"] >= 0


def test_streamed_blocks_wait_in_files(spark):
    c = connect(spark)
    name = f"streamed_{uuid.uuid4().hex[:8]}"
    c.query(f"CREATE TABLE {name} (id UInt32) ENGINE = MergeTree() ORDER BY id")
    for finish in (False, True):
        stream = c.start_streaming_insert(f"INSERT INTO {name} VALUES", [("id", "UInt32")])
        stream.flush_rows = 10
        for at in range(0, 40, 4):
            stream.send([{"name": "id", "data": list(range(at, at + 4))}])
        path = stream.path
        assert path and len(stream.blocks) < 3 and c.spark.table(name).count() == 0
        if finish:
            assert stream.finish()["rows_inserted"] == 40
        else:
            stream.abort()
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        assert not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)
    assert sorted(r["id"] for r in c.spark.table(name).collect()) == list(range(40))
