"""Scalar functions over columns: addresses, ids, epochs, times, intervals, enums, wide integers, JSON."""

from __future__ import annotations

import ipaddress
import time

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ipv4_to_num(address: Column | str) -> Column:
    """Number of a dotted address; null unless it has four parts of 0 to 255."""
    c = _col(address)
    part = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    return F.when(c.rlike(rf"^{part}(\.{part}){{3}}$"), F.aggregate(F.split(c, r"\."), F.lit(0).cast("long"), lambda a, b: a * 256 + b.cast("long")))


def num_to_ipv4(number: Column | str) -> Column:
    n = _col(number)
    return F.when(n.between(0, 0xFFFFFFFF), F.concat_ws(".", *[F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))


@F.pandas_udf(T.StringType())
def canonical_ipv6(address: pd.Series) -> pd.Series:
    """Shortest text of an IPv6 address; null if it is none."""

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else str(ipaddress.IPv6Address(x))
        except ValueError:
            return None

    return address.map(one, na_action="ignore")


@F.pandas_udf(T.BinaryType())
def ipv6_to_bytes(address: pd.Series) -> pd.Series:
    return address.map(lambda x: ipaddress.IPv6Address(x).packed, na_action="ignore")


def uuid_normalise(text: Column | str) -> Column:
    """Lower-case hyphenated form of a UUID with or without hyphens; null if it is none."""
    plain = F.lower(F.regexp_replace(_col(text), "-", ""))
    return F.when(plain.rlike("^[0-9a-f]{32}$"), F.regexp_replace(plain, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def enum_code(label: Column | str, members: dict[str, int]) -> Column:
    """Code of a label; a label that is no member raises."""
    c = _col(label)
    pairs = F.create_map(*[F.lit(x) for kv in members.items() for x in kv])
    return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(F.try_element_at(pairs, c), F.raise_error(F.concat(F.lit("no member: "), c)).cast("int")))


def enum_label(code: Column | str, members: dict[str, int]) -> Column:
    c = _col(code)
    pairs = F.create_map(*[F.lit(x) for k, v in members.items() for x in (v, k)])
    return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(F.try_element_at(pairs, c.cast("int")), F.raise_error(F.concat(F.lit("no member: "), c.cast("string"))).cast("string")))


def date_to_days(day: Column | str) -> Column:
    return F.unix_date(_col(day).cast("date"))


def days_to_date(days: Column | str) -> Column:
    return F.date_from_unix_date(_col(days))


def to_ticks(moment: Column | str, digits: int) -> Column:
    """Ticks of 10 ** -digits seconds since 1970."""
    micros = F.unix_micros(_col(moment).cast("timestamp"))
    return micros * 10 ** (digits - 6) if digits >= 6 else _floor_div(micros, 10 ** (6 - digits))


def _floor_div(n: Column, by: int) -> Column:
    """Whole division towards minus infinity, exact for longs."""
    return ((n - F.pmod(n, F.lit(by))).cast("decimal(20,0)") / F.lit(by)).cast("long")


def from_ticks(ticks: Column | str, digits: int) -> Column:
    """Timestamp of ticks; what is finer than a microsecond goes."""
    t = _col(ticks)
    return F.timestamp_micros(t * 10 ** (6 - digits) if digits <= 6 else _floor_div(t, 10 ** (digits - 6)))


def time_to_seconds(hour: Column, minute: Column, second: Column) -> Column:
    return hour * 3600 + minute * 60 + second


def seconds_to_time(seconds: Column | str) -> Column:
    """hh:mm:ss of seconds after midnight; null outside a day."""
    s = _col(seconds).cast("int")
    return F.when(s.between(0, 86399), F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"), F.floor(s / 60).cast("int") % 60, s % 60))


def interval(amount: Column | str, unit: str) -> Column:
    """Day-time interval of seconds to weeks, year-month interval of months to years."""
    n = _col(amount).cast("int")
    if unit in ("month", "quarter", "year"):
        return F.make_ym_interval(F.lit(0), n * {"month": 1, "quarter": 3, "year": 12}[unit])
    days, hours, minutes = (n * 7 if unit == "week" else n if unit == "day" else F.lit(0)), (n if unit == "hour" else F.lit(0)), (n if unit == "minute" else F.lit(0))
    return F.make_dt_interval(days, hours, minutes, (n if unit == "second" else F.lit(0)).cast("decimal(18,6)"))


def json_value(text: Column | str, path: str, kind: str) -> Column:
    """Value at a path of a JSON text, null for bad text."""
    return F.try_variant_get(F.try_parse_json(_col(text)), path, kind)


def valid_text(raw: Column | str, longest: int = 1 << 30) -> Column:
    """Text of bytes that are UTF-8 and not too long; anything else raises."""
    c = _col(raw)
    bad = F.raise_error(F.concat(F.lit("no valid text: "), F.hex(F.substring(c, 1, 16)))).cast("string")
    return F.when(c.isNull(), F.lit(None)).otherwise(F.when(F.is_valid_utf8(c.cast("string")) & (F.octet_length(c) <= longest), c.cast("string")).otherwise(bad))


def block_hash(*columns: Column | str) -> Column:
    """128 bits, as hex, of the values of a row: two 64-bit hashes of different inputs."""
    cols = [_col(c) for c in columns]
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(*cols)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second"), *cols)), 16, "0")))


def verified(hash: Column | str, *columns: Column | str) -> Column:
    return _col(hash) == block_hash(*columns)


def float_kind(number: Column | str) -> Column:
    """nan, infinity, -infinity or finite."""
    n = _col(number)
    return F.when(F.isnan(n), "nan").when(n == float("inf"), "infinity").when(n == float("-inf"), "-infinity").when(n.isNotNull(), "finite")


def wide_add(bits: int, signed: bool = True):
    """Sum of two wide integers held as text; raises outside their range."""
    low, high = (-(1 << bits - 1), (1 << bits - 1) - 1) if signed else (0, (1 << bits) - 1)

    @F.pandas_udf(T.StringType())
    def add(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str | None, y: str | None) -> str | None:
            if x is None or y is None:
                return None
            n = int(x) + int(y)
            if not low <= n <= high:
                raise OverflowError(f"{n} is outside {bits} bits")
            return str(n)

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=object)

    return add


def sleep(seconds: pd.Series) -> pd.Series:
    """Waits once a batch, three seconds at most, and gives 0; for tests of timeouts and cancelling."""
    time.sleep(min(3.0, max(0.0, float(seconds.max()))) if len(seconds) else 0)
    return (seconds.astype("float64") * 0).astype("int32")


def register(spark: SparkSession) -> None:
    """Functions that the dialect's text calls."""
    spark.udf.register("canonical_ipv6", canonical_ipv6)
    spark.udf.register("sleep", F.pandas_udf(sleep, "int"))
