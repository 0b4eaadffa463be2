"""Connections: parameterised queries, typed columnar inserts, streamed reads and writes, timeouts, cancelling."""

from __future__ import annotations

import functools
import inspect
import logging
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import dialect, types
from .errors import Busy, CallbackFailed, Cancelled, Closed, EngineError, MissingParameter, Timeout, ValidationError, from_spark
from .functions.scalars import register
from .operators.relational import extremes_of
from .session import build, child, normalise_settings, scoped

log = logging.getLogger("colonnade")
ARITY = {"on_data": 2, "on_input": 1, "on_log": 1, "on_progress": 1, "on_profile": 1, "on_profile_events": 1}


@dataclass
class Result:
    """A finished query. `columns` keeps names (repeated ones too) and types, `rows` are lists."""

    columns: list[dict[str, str]]
    rows: list[list]
    totals: list | None = None
    extremes: dict[str, list] | None = None
    statistics: dict[str, Any] = field(default_factory=dict)
    query_id: str = ""

    def to_columns(self) -> dict[str, list]:
        """Values by column name; of repeated names the first."""
        out: dict[str, list] = {}
        for i, c in enumerate(self.columns):
            out.setdefault(c["name"], [r[i] for r in self.rows])
        return out


def validate_callback(kind: str, f: Any) -> None:
    if f is None:
        return
    if not callable(f):
        raise ValidationError(f"{kind} is not callable", kind="invalid_callback")
    try:
        inspect.signature(f).bind(*range(ARITY[kind]))
    except TypeError:
        raise ValidationError(f"{kind} takes {ARITY[kind]} arguments", kind="invalid_callback_arity", expected=ARITY[kind]) from None
    except ValueError:
        pass  # a builtin without a signature


def validate_columns(columns: list[dict]) -> int:
    """Rows of a column-wise block; names are text and unequal, all columns equally long."""
    for c in columns:
        if not isinstance(c.get("name"), str) or not c["name"]:
            raise ValidationError(f"a column's name is text, not {c.get('name')!r}", kind="invalid_column_name")
    names = [c["name"] for c in columns]
    if len(set(names)) != len(names):
        raise ValidationError("two columns have one name", kind="invalid_column_name")
    counts = {c["name"]: len(c["data"]) for c in columns}
    if len(set(counts.values())) > 1:
        raise ValidationError(f"columns differ in length: {counts}", kind="row_count_mismatch", counts=counts)
    return next(iter(counts.values()), 0)


def to_frame(spark: SparkSession, columns: list[dict]) -> DataFrame:
    """A frame of a typed block; a value that doesn't fit names its column and place."""
    data = []
    for c in columns:
        kind = types.parse(c["type"])
        try:
            data.append([types.convert(kind, v, (i,)) for i, v in enumerate(c["data"])])
        except EngineError as e:
            raise type(e)(f"column {c['name']}: {e.message}", column=c["name"], **e.info) from None
    return spark.createDataFrame(list(zip(*data)), types.schema([(c["name"], c["type"]) for c in columns]))


def target(sql: str) -> tuple[str, list[str]]:
    """(table, listed columns) of an INSERT text."""
    found = re.match(r"\s*INSERT\s+INTO\s+(?:TABLE\s+)?([\w.`]+)\s*(?:\(([^)]*)\))?", sql, re.I)
    if not found:
        raise EngineError(f"no INSERT INTO: {sql!r}", kind="syntax_error")
    return found[1], [c.strip().strip("`") for c in (found[2] or "").split(",") if c.strip()]


class Connection:
    """One session; one query at a time."""

    def __init__(self, spark: SparkSession, username: str = "default", timeout: float | None = 30.0):
        if not username:
            raise ValidationError("the user name is empty", kind="invalid_username")
        self.spark, self.username, self.timeout = child(spark), username, timeout
        register(self.spark)
        self._lock, self._active, self._stop, self._open = threading.Lock(), None, threading.Event(), True
        self._stream: InsertStream | None = None

    # --- session ---
    def close(self) -> None:
        """End this session; the Spark context others use goes on."""
        if self._open:
            if self._active:
                self.cancel()
            self._open = False

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def info(self) -> dict[str, Any]:
        sc = self.spark.sparkContext
        return {"state": "ready" if self._open and not self._active else "busy" if self._open else "closed", "name": "Spark", "version": self.spark.version, "application": sc.applicationId, "timezone": self.spark.conf.get("spark.sql.session.timeZone"), "user": self.username}

    # --- running ---
    @contextmanager
    def _running(self, query_id: str | None, settings: dict[str, str], timeout: float | None) -> Iterator[str]:
        if not self._open:
            raise Closed("the connection is closed")
        if not self._lock.acquire(blocking=False):
            raise Busy("a query is in progress")
        query_id = query_id or str(uuid.uuid4())
        sc = self.spark.sparkContext
        late = threading.Event()
        self._stop.clear()

        def expire() -> None:
            late.set()
            self._stop.set()
            sc.cancelJobsWithTag(query_id)

        limit = timeout if timeout is not None else float(settings["max_execution_time"]) if settings.get("max_execution_time") else self.timeout
        timer = threading.Timer(limit, expire) if limit and limit != float("inf") else None
        tag = re.sub(r"[,\s]", "_", query_id)
        query_id = tag
        self._active = query_id
        try:
            sc.addJobTag(query_id)
            if timer:
                timer.start()
            with scoped(self.spark, settings):
                yield query_id
            if late.is_set():
                raise Timeout(f"the query took more than {limit} s")
        except CallbackFailed:
            sc.cancelJobsWithTag(query_id)
            raise
        except Exception as e:
            if late.is_set():
                raise Timeout(f"the query took more than {limit} s", nested=e) from e
            if self._stop.is_set():
                raise Cancelled("the query was cancelled", nested=e) from e
            raise from_spark(e) from e
        finally:
            if timer:
                timer.cancel()
            sc.removeJobTag(query_id)
            self._active = None
            self._lock.release()

    def cancel(self, query_id: str | None = None) -> bool:
        """Stop the active query; with an id, only that one. False if there is none to stop."""
        active = self._active
        if active is None or query_id is not None and query_id != active:
            return False
        self._stop.set()
        self.spark.sparkContext.cancelJobsWithTag(active)
        return True

    def frame(self, sql: str, parameters: dict | None = None) -> DataFrame:
        """The lazy frame of a query; the text's totals and settings don't apply."""
        return self._frame(dialect.translate(sql), parameters)

    def _frame(self, statement: dialect.Statement, parameters: dict | None) -> DataFrame:
        given = dict(parameters or {})
        missing = sorted(set(statement.parameters) - set(given))
        if missing:
            raise MissingParameter(f"no value for parameter {', '.join(missing)}", names=missing)
        if "system_tables" in statement.sql:
            listed = [(t.namespace[0] if t.namespace else "", t.name, t.tableType, t.isTemporary) for t in self.spark.catalog.listTables()]
            self.spark.createDataFrame(listed, "database string, name string, kind string, is_temporary boolean").createOrReplaceTempView("system_tables")
        args = {k: types.convert(kind, given[k], (k,)) if not isinstance(given[k], str) or kind.name in ("String", "UUID", "IPv6") else given[k] for k, kind in statement.parameters.items()}
        return self.spark.sql(statement.sql, args=args) if args else self.spark.sql(statement.sql)

    def query(
        self, sql: str, parameters: dict | None = None, settings=None, query_id: str | None = None, timeout: float | None = None,
        on_data: Callable | None = None, initial: Any = None, on_log: Callable | None = None, on_progress: Callable | None = None, on_profile: Callable | None = None, on_profile_events: Callable | None = None,
    ) -> Any:
        """Run a query. Without on_data a Result; with it the last accumulator of a fold over the result.

        on_data(event, acc) returns the next accumulator; events are ("data", name, type, value), ("block_end", rows) and ("end",).
        on_progress gets {rows, bytes, tasks, total_tasks, elapsed} while Spark reads, and once at the end; on_profile {rows, blocks, bytes, rows_before_limit,
        applied_limit, elapsed}; on_profile_events Spark's counters by name.
        """
        for kind, f in (("on_data", on_data), ("on_log", on_log), ("on_progress", on_progress), ("on_profile", on_profile), ("on_profile_events", on_profile_events)):
            validate_callback(kind, f)
        statement = dialect.translate(sql)
        if statement.totals and on_data is None:
            statement.sql = dialect.with_totals(statement.sql)
        options = normalise_settings(settings) | normalise_settings(statement.settings)
        began = time.monotonic()
        with _logging(on_log), self._running(query_id, options, timeout) as tag, _watching(self.spark, tag, on_progress, began):
            df = self._frame(statement, parameters)
            seen = Observation()
            if df.columns:
                df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            log.info("query %s began", tag)
            if on_data is not None:
                out, count = self._fold(df, on_data, initial)
            else:
                rows = [list(r) for r in df.collect()]
                out = Result([{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema], rows, query_id=tag)
                if statement.totals:  # the first column tells the totals row
                    out.columns, totals = out.columns[1:], [r[1:] for r in rows if r[0]]
                    out.rows = rows = [r[1:] for r in rows if not r[0]]
                    out.totals = totals[0] if totals else None
                    df = df.where("_totals = 0").drop("_totals")
                count = len(rows)
                if options.get("extremes") not in (None, "0", "") and rows:
                    low, high = extremes_of(df).collect()
                    out.extremes = {"min": list(low)[1:], "max": list(high)[1:]}
            spent = time.monotonic() - began
            if on_progress or on_profile or on_profile_events:
                events = counters(self.spark, tag, wait=True)
            if on_progress:
                on_progress({"rows": events["InputRecords"], "bytes": events["InputBytes"], "tasks": events["Tasks"], "total_tasks": events["TotalTasks"], "elapsed": spent})
            if on_profile:
                block = int(self.spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
                limit = dialect.limit_of(statement.sql) is not None
                before = self._rows_before_limit(statement, parameters) if limit else count
                on_profile({"rows": count, "rows_observed": seen.get.get("rows", count) if df.columns and count and not statement.totals else count, "blocks": -(-count // block), "bytes": events["ResultBytes"], "rows_before_limit": before, "applied_limit": limit, "elapsed": spent})
            if on_profile_events:
                on_profile_events(events)
            log.info("query %s ended: %s rows", tag, count)
        if isinstance(out, Result):
            out.statistics = {"rows": count, "elapsed": spent}
        return out

    def _rows_before_limit(self, statement: dialect.Statement, parameters: dict | None) -> int:
        """A count of the query's rows without its limit."""
        return self._frame(dialect.Statement(dialect.without_limit(statement.sql), parameters=statement.parameters), parameters).count()

    def _fold(self, df: DataFrame, on_data: Callable, acc: Any) -> tuple[Any, int]:
        """A bounded-memory fold: partitions come to the driver one at a time."""
        names = [(f.name, f.dataType.simpleString()) for f in df.schema]
        block = int(self.spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        count = 0
        source = df.toLocalIterator(prefetchPartitions=True)

        def call(event: tuple) -> Any:
            try:
                return on_data(event, acc)
            except Exception as e:
                raise CallbackFailed(f"on_data raised {type(e).__name__}: {e}", nested=e) from e

        for row in source:
            if self._stop.is_set():
                raise Cancelled("the query was cancelled")
            for (name, kind), value in zip(names, row):
                acc = call(("data", name, kind, value))
            count += 1
            if count % block == 0:
                acc = call(("block_end", block))
        if count % block:
            acc = call(("block_end", count % block))
        return call(("end",)), count

    def batches(self, sql: str, size: int = 10_000, **options) -> Iterator[list[list]]:
        """Rows of a query in batches of bounded size."""
        held: list[list] = []
        for row in self.frame(sql, options.get("parameters")).toLocalIterator(prefetchPartitions=True):
            held.append(list(row))
            if len(held) == size:
                yield held
                held = []
        if held:
            yield held

    def forward(self, sql: str, sink: Callable, parameters: dict | None = None) -> None:
        """Every row of a query to a sink that runs where the rows are, a partition at a time."""
        with self._running(None, {}, None):
            self.frame(sql, parameters).foreachPartition(sink)

    # --- inserts ---
    def insert(self, sql: str, columns: list[dict], settings=None, query_id: str | None = None, timeout: float | None = None, on_log: Callable | None = None) -> dict[str, Any]:
        """Write one typed block; nothing is written if any value doesn't fit."""
        began = time.monotonic()
        rows = validate_columns(columns)
        table, listed = target(sql)
        if rows:
            with _logging(on_log), self._running(query_id, normalise_settings(settings), timeout):
                self._append(table, listed, to_frame(self.spark, columns))
        return {"rows_inserted": rows, "elapsed_time": time.monotonic() - began}

    def _append(self, table: str, listed: list[str], df: DataFrame) -> None:
        """Append by name; Spark's file committer makes the rows visible together."""
        wanted = self.spark.table(table).schema
        given = dict(zip(listed, df.columns)) if listed else {c: c for c in df.columns}
        unknown = set(given) - set(wanted.names)
        if unknown:
            raise EngineError(f"{table} has no column {', '.join(sorted(unknown))}", kind="no_such_column")
        picked = [(F.col(f"`{given[f.name]}`") if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
        df = df.select(picked)
        key = next((r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"] == "sort_key"), "")
        keys = [k.strip() for k in key.split(",") if k.strip() in df.columns]
        (df.sortWithinPartitions(*keys) if keys else df).write.insertInto(table)

    def streaming_insert(self, sql: str, columns: list[tuple[str, str]], on_input: Callable, initial: Any = None, timeout: float | None = None) -> dict[str, Any]:
        """Pull blocks: on_input(acc) returns ("ok", block, acc) or ("done", acc); ("error", why) or an exception writes nothing."""
        validate_callback("on_input", on_input)
        stream, acc = self.start_streaming_insert(sql, columns), initial
        began = time.monotonic()
        limit = timeout if timeout is not None else self.timeout
        try:
            while True:
                if limit and time.monotonic() - began > limit:
                    raise Timeout(f"the insert took more than {limit} s")
                try:
                    step = on_input(acc)
                except Exception as e:
                    raise CallbackFailed(f"on_input raised {type(e).__name__}: {e}", nested=e) from e
                if step[0] == "ok":
                    stream.send(step[1])
                    acc = step[2]
                elif step[0] == "done":
                    return stream.finish() | {"accumulator": step[1]}
                else:
                    raise CallbackFailed(f"on_input gave {step!r}")
        except BaseException:
            stream.abort()
            raise

    def start_streaming_insert(self, sql: str, columns: list[tuple[str, str]]) -> InsertStream:
        if not self._open:
            raise Closed("the connection is closed")
        if self._active or self._stream is not None:
            raise Busy("a query is in progress")
        self._stream = InsertStream(self, sql, columns)
        return self._stream

    def copy(self, source: str, table: str, parameters: dict | None = None) -> int:
        """Write a query's rows to a table without bringing them to the driver; returns their number."""
        with self._running(None, {}, None):
            seen = Observation()
            self._append(table, [], self.frame(source, parameters).observe(seen, F.count(F.lit(1)).alias("rows")))
            return seen.get["rows"]


class InsertStream:
    """Blocks that become visible together when the stream is finished; `flush_rows` of them at most are held here, the others wait in files."""

    flush_rows = 100_000

    def __init__(self, connection: Connection, sql: str, columns: list[tuple[str, str]]):
        self.connection, self.columns = connection, list(columns)
        self.table, self.listed = target(sql)
        self.schema = types.schema(self.columns)
        self.blocks: list[DataFrame] = []
        self.sent, self.held, self.path = 0, 0, None
        self.rows, self.began, self.failed, self.open = 0, time.monotonic(), None, True

    def send(self, columns: list[dict]) -> int:
        """Take one block of {name, data}; a block that doesn't fit is refused and the stream goes on."""
        if self.failed:
            raise self.failed
        if not self.open:
            raise Closed("the stream is finished")
        names = [c.get("name") for c in columns]
        if names != [n for n, _ in self.columns]:
            raise ValidationError(f"columns {names} are not {[n for n, _ in self.columns]}, in this order", kind="column_mismatch")
        rows = validate_columns(columns)
        if rows:
            self.blocks.append(to_frame(self.connection.spark, [c | {"type": t} for c, (_, t) in zip(columns, self.columns)]))
            self.rows, self.sent, self.held = self.rows + rows, self.sent + 1, self.held + rows
            if self.held >= self.flush_rows:
                self._flush()
        return rows

    def _flush(self) -> None:
        """Write the blocks held to a folder of the stream's own; the table sees nothing of it yet."""
        spark = self.connection.spark
        if self.path is None:
            where = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
            self.path = f"{where.rstrip('/')}/insert-{uuid.uuid4().hex[:12]}"
        functools.reduce(DataFrame.union, self.blocks).write.mode("append").parquet(self.path)
        self.blocks, self.held = [], 0

    def finish(self) -> dict[str, Any]:
        if self.failed:
            raise self.failed
        if not self.open:
            raise Closed("the stream is finished")
        self._end()
        if self.sent:
            try:
                with self.connection._running(None, {}, None):
                    if self.path and self.blocks:
                        self._flush()
                    rows = self.connection.spark.read.schema(self.schema).parquet(self.path) if self.path else functools.reduce(DataFrame.union, self.blocks)
                    self.connection._append(self.table, self.listed, rows)
            except EngineError as e:
                self.failed = e
                raise
            finally:
                self._clear()
        return {"rows_inserted": self.rows, "blocks_sent": self.sent, "elapsed_time": time.monotonic() - self.began}

    def _end(self) -> None:
        self.open = False
        if self.connection._stream is self:
            self.connection._stream = None

    def _clear(self) -> None:
        if self.path:
            spark = self.connection.spark
            path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self.blocks, self.path = [], None

    def abort(self) -> None:
        """Give the stream up; nothing of it is written."""
        self._end()
        self._clear()


# Spark's counters of a stage, by the names they are given out under.
COUNTERS = {
    "InputBytes": "inputBytes", "InputRecords": "inputRecords", "OutputBytes": "outputBytes", "OutputRecords": "outputRecords", "ShuffleReadBytes": "shuffleReadBytes", "ShuffleWriteBytes": "shuffleWriteBytes",
    "MemoryBytesSpilled": "memoryBytesSpilled", "DiskBytesSpilled": "diskBytesSpilled", "ExecutorRunTimeMs": "executorRunTime", "ExecutorCpuTimeNs": "executorCpuTime", "GcTimeMs": "jvmGcTime",
    "ResultBytes": "resultSize", "Tasks": "numCompleteTasks", "TotalTasks": "numTasks",
}


def counters(spark: SparkSession, tag: str, wait: bool = False) -> dict[str, int]:
    """Spark's counters over the stages of the jobs with a tag, as far as they are known by now; with `wait`, once Spark has told all."""
    sc = spark.sparkContext._jsc.sc()
    if wait:
        sc.listenerBus().waitUntilEmpty()
    out = dict.fromkeys([*COUNTERS, "Jobs", "Stages"], 0)
    stages: set[int] = set()
    for job in list(sc.statusTracker().getJobIdsForTag(tag)):
        out["Jobs"] += 1
        info = sc.statusTracker().getJobInfo(job)
        stages.update(info.get().stageIds() if info.isDefined() else ())
    for stage in sorted(stages):
        if sc.statusTracker().getStageInfo(stage).isDefined():
            found = sc.statusStore().lastStageAttempt(stage)
            if found.status().toString() not in ("SKIPPED", "PENDING"):
                out["Stages"] += 1
                for name, getter in COUNTERS.items():
                    out[name] += int(getattr(found, getter)())
    return out


@contextmanager
def _watching(spark: SparkSession, tag: str, on_progress: Callable | None, began: float, every: float = 0.2) -> Iterator[None]:
    """Progress to a callback from another thread, as long as the block runs."""
    if on_progress is None:
        yield
        return
    over = threading.Event()

    def watch() -> None:
        while not over.wait(every):
            try:
                seen = counters(spark, tag)
                on_progress({"rows": seen["InputRecords"], "bytes": seen["InputBytes"], "tasks": seen["Tasks"], "total_tasks": seen["TotalTasks"], "elapsed": time.monotonic() - began})
            except Exception:
                logging.getLogger("colonnade.callbacks").warning("on_progress failed", exc_info=True)

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


@contextmanager
def _logging(on_log: Callable | None) -> Iterator[None]:
    """Log records of the engine as dicts to a callback, whose own failures are only logged."""
    if on_log is None:
        yield
        return

    class Handler(logging.Handler):
        def emit(self, record: logging.LogRecord) -> None:
            try:
                on_log({"time": record.created, "level": record.levelname, "source": record.name, "text": record.getMessage()})
            except Exception:
                logging.getLogger("colonnade.callbacks").warning("on_log failed", exc_info=True)

    handler, level = Handler(), log.level
    log.addHandler(handler)
    log.setLevel(logging.INFO)
    try:
        yield
    finally:
        log.removeHandler(handler)
        log.setLevel(level)


def connect(spark: SparkSession | None = None, **options) -> Connection:
    return Connection(spark or build(), **options)
