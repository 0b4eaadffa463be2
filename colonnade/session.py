"""Session configuration and scoped settings."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .errors import UnknownSetting

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.mapKeyDedupPolicy": "LAST_WIN", "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: Setting -> Spark option it stands for; None: kept, but acted on elsewhere or not at all.
SETTINGS = {
    "max_threads": "spark.sql.shuffle.partitions", "max_execution_time": None, "max_memory_usage": None, "extremes": None, "send_logs_level": None,
    "max_block_size": "spark.sql.execution.arrow.maxRecordsPerBatch", "output_format_native_write_json_as_string": None,
}


def build(master: str | None = None, name: str = "colonnade", **conf: str) -> SparkSession:
    """A session with the engine's defaults; options with dots are given as spark__sql__..."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for k, v in (DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def child(spark: SparkSession) -> SparkSession:
    """A session of its own views and options on the same context and catalog."""
    out = spark.newSession()
    for k, v in DEFAULTS.items():
        out.conf.set(k, v)
    return out


def normalise_settings(settings) -> dict[str, str]:
    """Settings from a mapping, pairs, or mappings with key, value and flags; only the last may be marked unimportant and unknown."""
    out: dict[str, str] = {}
    if settings is None:
        return out
    if hasattr(settings, "items"):
        entries = [(k, v, True) for k, v in settings.items()]
    else:
        entries = [(e["key"], e["value"], e.get("important", True)) if isinstance(e, dict) else (*e, True) for e in settings]
    for key, value, important in entries:
        if not isinstance(key, str):
            raise UnknownSetting(f"a setting's name is text, not {key!r}")
        if key not in SETTINGS and not key.startswith("spark.sql."):
            if important:
                raise UnknownSetting(f"unknown setting {key}")
            continue
        out[key] = str(int(value)) if isinstance(value, bool) else str(value)
    return out


@contextmanager
def scoped(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Spark options of these settings, put back afterwards."""
    before = {}
    for key, value in settings.items():
        option = SETTINGS.get(key, key)
        if option:
            before[option] = spark.conf.get(option, None)
            spark.conf.set(option, value)
    try:
        yield
    finally:
        for option, value in before.items():
            spark.conf.unset(option) if value is None else spark.conf.set(option, value)
