"""Type strings compiled to Spark types, with value checks and conversions.

A type string such as ``Map(String, Array(Nullable(UInt32)))`` is parsed to a Kind tree. A
Kind gives its Spark type, its text again, the Python value Spark stores for a caller's value
(or an error that names the element at fault), and a Column that checks a column's values
where they are, for data that is already distributed.
"""

from __future__ import annotations

import datetime as dt
import decimal
import ipaddress
import json
import math
import uuid as uuids
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import OutOfRange, TypeMismatch, UnknownType

INTEGERS = {f"{sign}{bits}": (0 if sign == "UInt" else -(1 << bits - 1), (1 << (bits if sign == "UInt" else bits - 1)) - 1) for sign in ("Int", "UInt") for bits in (8, 16, 32, 64, 128, 256)}
SPARK_INTEGERS = {
    "Int8": T.ByteType(), "Int16": T.ShortType(), "Int32": T.IntegerType(), "Int64": T.LongType(),
    "UInt8": T.ShortType(), "UInt16": T.IntegerType(), "UInt32": T.LongType(), "UInt64": T.DecimalType(20, 0),
}
DECIMALS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38, "Decimal256": 76}
INTERVALS = {"Second": 1, "Minute": 60, "Hour": 3600, "Day": 86400, "Week": 7 * 86400, "Month": 1, "Quarter": 3, "Year": 12}
PLAIN = {"Float32", "Float64", "Bool", "String", "Date", "Date32", "Time", "IPv4", "IPv6", "UUID", "Point", "JSON", "Nothing"}
EPOCH = dt.date(1970, 1, 1)
LONGEST_STRING = 1 << 30


@dataclass(frozen=True)
class Kind:
    """A parsed type: its name, its element types, and what else stands in the brackets."""

    name: str
    of: tuple[Kind, ...] = ()
    labels: tuple[str, ...] = ()  # of tuple fields or enum members
    codes: tuple[int, ...] = ()  # of enum members
    numbers: tuple[int, ...] = ()  # precision, scale or length
    zone: str = ""
    extra: dict = field(default_factory=dict, compare=False)

    def __str__(self) -> str:
        if self.name in ("Enum8", "Enum16"):
            return f"{self.name}({', '.join(f"'{_escape(a)}' = {b}" for a, b in zip(self.labels, self.codes))})"
        parts = [f"{a} {k}" for a, k in zip(self.labels, self.of)] if self.labels else [str(k) for k in self.of]
        parts += [str(n) for n in self.numbers] + ([f"'{self.zone}'"] if self.zone else [])
        return f"{self.name}({', '.join(parts)})" if parts or self.name == "Tuple" else self.name


def _escape(label: str) -> str:
    return label.replace("\\", "\\\\").replace("'", "\\'")


class _Reader:
    """Recursive descent over one type string."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, why: str) -> UnknownType:
        return UnknownType(f"{why} at {self.at} in {self.text!r}", text=self.text)

    def space(self) -> None:
        while self.at < len(self.text) and self.text[self.at].isspace():
            self.at += 1

    def take(self, sign: str) -> bool:
        self.space()
        if self.text.startswith(sign, self.at):
            self.at += len(sign)
            return True
        return False

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise self.fail(f"{sign!r} expected")

    def word(self) -> str:
        self.space()
        start = self.at
        if self.text[start : start + 1] == "`":
            end = self.text.find("`", start + 1)
            if end < 0:
                raise self.fail("unclosed name")
            self.at = end + 1
            return self.text[start + 1 : end]
        while self.at < len(self.text) and (self.text[self.at].isalnum() or self.text[self.at] == "_"):
            self.at += 1
        if start == self.at:
            raise self.fail("name expected")
        return self.text[start : self.at]

    def number(self) -> int:
        sign = -1 if self.take("-") else 1
        word = self.word()
        if not word.isdigit():
            raise self.fail("number expected")
        return sign * int(word)

    def quoted(self) -> str:
        self.need("'")
        out = []
        while self.at < len(self.text):
            c = self.text[self.at]
            self.at += 1
            if c == "\\" and self.at < len(self.text):
                out.append(self.text[self.at])
                self.at += 1
            elif c == "'":
                return "".join(out)
            else:
                out.append(c)
        raise self.fail("unclosed quote")

    def many(self, item) -> list:
        self.need("(")
        out = [item()]
        while self.take(","):
            out.append(item())
        self.need(")")
        return out

    def kind(self) -> Kind:
        name = self.word()
        if name in INTEGERS or name in PLAIN or name.startswith("Interval") and name[8:] in INTERVALS:
            return Kind(name)
        if name in ("Array", "Nullable", "LowCardinality"):
            (inner,) = self.one(self.many(self.kind), name)
            return _checked(Kind(name, (inner,)), self)
        if name == "Map":
            pair = self.many(self.kind)
            if len(pair) != 2:
                raise self.fail("Map takes a key and a value type")
            return _checked(Kind(name, tuple(pair)), self)
        if name == "Tuple":
            self.space()
            if self.text.startswith("()", self.at):
                self.at += 2
                return Kind(name)
            fields = self.many(self.field)
            named = [a for a, _ in fields if a]
            if named and len(named) != len(fields):
                raise self.fail("either all fields of a Tuple have names or none")
            if len(set(named)) != len(named):
                raise self.fail("field names of a Tuple differ")
            return Kind(name, tuple(k for _, k in fields), labels=tuple(named))
        if name in ("Enum8", "Enum16"):
            return _checked(Kind(name, labels=(m := list(zip(*self.many(self.member))))[0], codes=m[1]), self)
        if name in DECIMALS:
            (scale,) = self.one(self.many(self.number), name)
            return _checked(Kind(name, numbers=(scale,)), self)
        if name == "Decimal":
            return _checked(Kind(name, numbers=tuple(self.many(self.number))), self)
        if name in ("FixedString", "Time64"):
            return _checked(Kind(name, numbers=tuple(self.one(self.many(self.number), name))), self)
        if name == "DateTime":
            zone = self.one(self.many(self.quoted), name)[0] if self.ahead("(") else ""
            return Kind(name, zone=zone)
        if name == "DateTime64":
            self.need("(")
            digits = self.number()
            zone = self.quoted() if self.take(",") else ""
            self.need(")")
            return _checked(Kind(name, numbers=(digits,), zone=zone), self)
        raise self.fail(f"unknown type {name}")

    def ahead(self, sign: str) -> bool:
        self.space()
        return self.text.startswith(sign, self.at)

    def one(self, found: list, name: str) -> list:
        if len(found) != 1:
            raise self.fail(f"{name} takes one argument")
        return found

    def field(self) -> tuple[str, Kind]:
        """A tuple field: a type, or a name and a type."""
        start = self.at
        name = self.word()
        self.space()
        if self.text[self.at : self.at + 1] in (",", ")", "("):
            self.at = start
            return "", self.kind()
        return name, self.kind()

    def member(self) -> tuple[str, int]:
        label = self.quoted()
        self.need("=")
        return label, self.number()


def _checked(kind: Kind, reader: _Reader) -> Kind:
    """Rules that the grammar leaves open."""
    inner = kind.of[0].name if kind.of else ""
    if kind.name == "Nullable" and inner in ("Nullable", "Array", "Map", "Tuple", "LowCardinality"):
        raise reader.fail(f"Nullable({inner}) is not allowed")
    if kind.name == "LowCardinality" and inner in ("LowCardinality", "Array", "Map", "Tuple"):
        raise reader.fail(f"LowCardinality({inner}) is not allowed")
    if kind.name == "Map" and inner in ("Array", "Map", "Nullable"):
        raise reader.fail(f"{inner} can't be a Map's key")
    if kind.name in DECIMALS and not 0 <= kind.numbers[0] <= DECIMALS[kind.name]:
        raise reader.fail("scale out of range")
    if kind.name == "Decimal" and not (len(kind.numbers) == 2 and 1 <= kind.numbers[0] <= 76 and 0 <= kind.numbers[1] <= kind.numbers[0]):
        raise reader.fail("Decimal takes a precision up to 76 and a scale within it")
    if kind.name in ("DateTime64", "Time64") and not 0 <= kind.numbers[0] <= 9:
        raise reader.fail("precision is 0 to 9")
    if kind.name == "FixedString" and kind.numbers[0] < 1:
        raise reader.fail("length is 1 or more")
    if kind.name in ("Enum8", "Enum16"):
        low, high = INTEGERS[f"Int{kind.name[4:]}"]
        if len(set(kind.labels)) != len(kind.labels) or len(set(kind.codes)) != len(kind.codes) or not all(low <= c <= high for c in kind.codes):
            raise reader.fail("enum labels and codes differ and fit")
    return kind


def parse(text: str) -> Kind:
    """Compile a type string."""
    reader = _Reader(text)
    kind = reader.kind()
    reader.space()
    if reader.at != len(text):
        raise reader.fail("the type ends here")
    return kind


def precision(kind: Kind) -> tuple[int, int]:
    return (DECIMALS[kind.name], kind.numbers[0]) if kind.name in DECIMALS else (kind.numbers[0], kind.numbers[1])


def spark_type(kind: Kind | str) -> T.DataType:
    """The Spark type that holds a kind's values; wide integers and decimals are canonical text."""
    kind = parse(kind) if isinstance(kind, str) else kind
    name = kind.name
    if name in SPARK_INTEGERS:
        return SPARK_INTEGERS[name]
    if name in INTEGERS or name in ("String", "UUID", "IPv6", "Enum8", "Enum16", "JSON"):
        return T.StringType()
    if name in DECIMALS or name == "Decimal":
        digits, scale = precision(kind)
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if name == "DateTime64":
        return T.TimestampType() if kind.numbers[0] <= 6 else T.LongType()
    if name in ("Nullable", "LowCardinality"):
        return spark_type(kind.of[0])
    if name == "Array":
        return T.ArrayType(spark_type(kind.of[0]))
    if name == "Map":
        return T.MapType(spark_type(kind.of[0]), spark_type(kind.of[1]))
    if name == "Tuple":
        return T.StructType([T.StructField(kind.labels[i] if kind.labels else f"_{i + 1}", spark_type(k)) for i, k in enumerate(kind.of)])
    if name == "Point":
        return T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    if name.startswith("Interval"):
        return T.IntegerType() if name[8:] in ("Month", "Quarter", "Year") else T.DayTimeIntervalType()  # months: Python has no value for year-month intervals
    return {
        "Float32": T.FloatType(), "Float64": T.DoubleType(), "Bool": T.BooleanType(), "FixedString": T.BinaryType(), "Date": T.DateType(), "Date32": T.DateType(),
        "DateTime": T.TimestampType(), "Time": T.IntegerType(), "Time64": T.LongType(), "IPv4": T.LongType(), "Nothing": T.NullType(),
    }[name]


def nullable(kind: Kind) -> bool:
    return kind.name in ("Nullable", "Nothing") or kind.name == "LowCardinality" and nullable(kind.of[0])


def field_of(name: str, text: str) -> T.StructField:
    """A field that keeps its type string, and an enum's members, as metadata."""
    kind = parse(text)
    core = kind.of[0] if kind.name in ("Nullable", "LowCardinality") else kind
    extra: dict[str, Any] = {"kind": str(kind)}
    if core.name in ("Enum8", "Enum16"):
        extra["enum"] = dict(zip(core.labels, core.codes))
    return T.StructField(name, spark_type(kind), True, extra)


def schema(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([field_of(n, t) for n, t in columns])


def placeholder(kind: Kind | str) -> Any:
    """The value that stands below a null."""
    t = spark_type(kind)
    if isinstance(t, (T.ArrayType, T.MapType)):
        return [] if isinstance(t, T.ArrayType) else {}
    if isinstance(t, T.StructType):
        of = (kind if isinstance(kind, Kind) else parse(kind)).of
        return tuple(placeholder(k) for k in of) or (0.0, 0.0)
    name = (kind if isinstance(kind, Kind) else parse(kind)).name
    if name in INTEGERS and isinstance(t, T.StringType):
        return "0"
    zero = {T.StringType: "", T.BinaryType: b"", T.BooleanType: False, T.DateType: EPOCH, T.TimestampType: dt.datetime(1970, 1, 1), T.FloatType: 0.0, T.DoubleType: 0.0, T.NullType: None}
    return zero.get(type(t), decimal.Decimal(0) if isinstance(t, T.DecimalType) else 0)


def convert(kind: Kind | str, value: Any, path: tuple = ()) -> Any:
    """The Python value Spark stores for a caller's value; errors name the path to the element at fault."""
    kind = parse(kind) if isinstance(kind, str) else kind
    name = kind.name
    if name == "Nullable":
        return None if value is None else convert(kind.of[0], value, path)
    if name == "LowCardinality":
        return convert(kind.of[0], value, path)
    if name == "Nothing":
        if value is not None:
            raise _wrong(kind, value, path)
        return None
    if value is None:
        raise _wrong(kind, value, path, "null in a type that isn't Nullable")
    if name == "Array":
        if not isinstance(value, (list, tuple)):
            raise _wrong(kind, value, path)
        return [convert(kind.of[0], v, (*path, i)) for i, v in enumerate(value)]
    if name == "Map":
        pairs = value.items() if isinstance(value, dict) else value
        try:
            return {convert(kind.of[0], k, (*path, "key", k)): convert(kind.of[1], v, (*path, k)) for k, v in pairs}
        except (TypeError, ValueError) as e:
            raise _wrong(kind, value, path) from e
    if name == "Tuple":
        if isinstance(value, dict) and kind.labels:
            value = [value.get(label) for label in kind.labels]
        if not isinstance(value, (list, tuple)) or len(value) != len(kind.of):
            raise _wrong(kind, value, path, f"{len(kind.of)} fields expected")
        return tuple(convert(k, v, (*path, i)) for i, (k, v) in enumerate(zip(kind.of, value)))
    try:
        return _scalar(kind, value, path)
    except (ValueError, TypeError, ArithmeticError) as e:
        if isinstance(e, (TypeMismatch, OutOfRange)):
            raise
        raise _wrong(kind, value, path, str(e)) from e


def _wrong(kind: Kind, value: Any, path: tuple, why: str = "") -> TypeMismatch:
    return TypeMismatch(f"{value!r} is no {kind}{f' at {list(path)}' if path else ''}{f': {why}' if why else ''}", path=path, value=value)


def _inside(value: int, low: int, high: int, kind: Kind, path: tuple) -> int:
    if not low <= value <= high:
        raise OutOfRange(f"{value} is outside {kind} ({low} to {high}){f' at {list(path)}' if path else ''}", path=path, value=value)
    return value


def _scalar(kind: Kind, value: Any, path: tuple) -> Any:
    name = kind.name
    if name in INTEGERS:
        if isinstance(value, bool) or not isinstance(value, (int, str)):
            raise _wrong(kind, value, path)
        n = _inside(int(value), *INTEGERS[name], kind, path)
        return str(n) if name not in SPARK_INTEGERS else decimal.Decimal(n) if name == "UInt64" else n
    if name in ("Float32", "Float64"):
        if isinstance(value, bool) or not isinstance(value, (int, float)) and value not in ("nan", "inf", "-inf"):
            raise _wrong(kind, value, path)
        return float(value)
    if name == "Bool":
        if value not in (True, False, 0, 1):
            raise _wrong(kind, value, path)
        return bool(value)
    if name == "String":
        text = bytes(value).decode() if isinstance(value, (bytes, bytearray)) else value
        if not isinstance(text, str):
            raise _wrong(kind, value, path)
        if len(text.encode()) > LONGEST_STRING:
            raise OutOfRange("the string is longer than 1 GiB", path=path)
        return text
    if name == "FixedString":
        raw = value.encode() if isinstance(value, str) else bytes(value)
        if len(raw) > kind.numbers[0]:
            raise OutOfRange(f"more than {kind.numbers[0]} bytes", path=path)
        return bytearray(raw.ljust(kind.numbers[0], b"\0"))
    if name in ("Date", "Date32"):
        day = value if isinstance(value, dt.date) and not isinstance(value, dt.datetime) else dt.date.fromisoformat(value) if isinstance(value, str) else dt.date(*value)
        if name == "Date":
            _inside((day - EPOCH).days, 0, 65535, kind, path)
        return day
    if name == "DateTime" or name == "DateTime64":
        return _moment(kind, value, path)
    if name in ("Time", "Time64"):
        return _time(kind, value, path)
    if name in DECIMALS or name == "Decimal":
        return exact_decimal(kind, value, path)
    if name in ("Enum8", "Enum16"):
        if isinstance(value, int) and value in kind.codes:
            return kind.labels[kind.codes.index(value)]
        if value in kind.labels:
            return value
        raise _wrong(kind, value, path, "no member")
    if name == "IPv4":
        return _inside(value, 0, 0xFFFFFFFF, kind, path) if isinstance(value, int) else int(ipaddress.IPv4Address(".".join(map(str, value)) if isinstance(value, (tuple, list)) else value))
    if name == "IPv6":
        return str(ipaddress.IPv6Address(":".join(f"{x:x}" for x in value) if isinstance(value, (tuple, list)) else value))
    if name == "UUID":
        if isinstance(value, uuids.UUID):
            return str(value)
        if isinstance(value, bytes) and len(value) == 16:
            return str(uuids.UUID(bytes=value))
        if isinstance(value, str) and len(value) in (32, 36):
            return str(uuids.UUID(value))
        raise _wrong(kind, value, path)
    if name == "Point":
        x, y = value
        return (float(x), float(y))
    if name == "JSON":
        if isinstance(value, (dict, list)):
            return json.dumps(value, separators=(",", ":"))
        json.loads(value)
        return value
    if name.startswith("Interval"):
        unit = name[8:]
        if isinstance(value, tuple):
            if value[0].lower() != unit.lower():
                raise _wrong(kind, value, path, "another unit")
            value = value[1]
        if isinstance(value, bool) or not isinstance(value, int):
            raise _wrong(kind, value, path)
        return value * INTERVALS[unit] if unit in ("Month", "Quarter", "Year") else dt.timedelta(seconds=value * INTERVALS[unit])
    raise UnknownType(f"no conversion for {kind}")


def _moment(kind: Kind, value: Any, path: tuple) -> Any:
    """Timestamps in UTC; DateTime64 above six digits in ticks, as Spark keeps microseconds only."""
    digits = kind.numbers[0] if kind.name == "DateTime64" else 0
    scale = 10**digits
    if isinstance(value, bool):
        raise _wrong(kind, value, path)
    if isinstance(value, int):
        ticks = value
    else:
        at = dt.datetime.fromisoformat(value) if isinstance(value, str) else dt.datetime(*value[0], *value[1]) if isinstance(value, tuple) else value
        at = (at if at.tzinfo else at.replace(tzinfo=dt.UTC)) - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
        micros = (at.days * 86400 + at.seconds) * 1_000_000 + at.microseconds
        ticks = micros * scale // 1_000_000
    if kind.name == "DateTime":
        _inside(ticks, 0, 0xFFFFFFFF, kind, path)
    else:
        _inside(ticks, *INTEGERS["Int64"], kind, path)
    if digits > 6:
        return ticks
    return dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(microseconds=ticks * (1_000_000 // scale))


def _time(kind: Kind, value: Any, path: tuple) -> int:
    unit = 1 if kind.name == "Time" else 1_000_000_000
    if isinstance(value, dt.time):
        whole = value.hour * 3600 + value.minute * 60 + value.second
        n = whole if unit == 1 else whole * unit + value.microsecond * 1000
    elif isinstance(value, tuple):
        h, m, s, *rest = value
        if not (0 <= h < 24 and 0 <= m < 60 and 0 <= s < 60):
            raise OutOfRange(f"{value!r} is no time of day", path=path)
        n = (h * 3600 + m * 60 + s) * unit + (rest[0] if rest and unit > 1 else 0)
    elif isinstance(value, int) and not isinstance(value, bool):
        n = value
    else:
        raise _wrong(kind, value, path)
    return _inside(n, 0, 86400 * unit - 1, kind, path)


def exact_decimal(kind: Kind, value: Any, path: tuple) -> decimal.Decimal | str:
    """The value at the kind's scale; (unscaled, scale) pairs are rescaled, never relabelled."""
    digits, scale = precision(kind)
    if isinstance(value, bool) or not isinstance(value, (int, float, str, tuple, decimal.Decimal)):
        raise _wrong(kind, value, path)
    if isinstance(value, float) and not math.isfinite(value):
        raise _wrong(kind, value, path)
    with decimal.localcontext(prec=120):
        d = decimal.Decimal(value[0]).scaleb(-value[1]) if isinstance(value, tuple) else decimal.Decimal(str(value) if isinstance(value, float) else value)
        d = d.quantize(decimal.Decimal(1).scaleb(-scale), rounding=decimal.ROUND_HALF_EVEN)
        if abs(d) >= decimal.Decimal(10) ** (digits - scale):
            raise OutOfRange(f"{value!r} has more than {digits - scale} digits before the point for {kind}", path=path, value=value)
        return d if digits <= 38 else format(d, "f")


def compatible(kind: Kind | str, value: Any) -> bool:
    try:
        convert(kind, value)
    except (TypeMismatch, OutOfRange):
        return False
    return True


def checked(kind: Kind | str, column: Column, name: str = "value") -> Column:
    """The column cast to the kind's Spark type, raising where a value doesn't fit; evaluated where the data is."""
    kind = parse(kind) if isinstance(kind, str) else kind
    core = kind.of[0] if kind.name in ("Nullable", "LowCardinality") else kind
    fail = lambda why: F.raise_error(F.concat(F.lit(f"{name}: "), F.coalesce(column.cast("string"), F.lit("null")), F.lit(f" {why} {core}")))
    out = column.cast(spark_type(core))
    if core.name in INTEGERS and core.name in SPARK_INTEGERS:
        low, high = INTEGERS[core.name]
        wide = column.cast("decimal(38,0)")
        out = F.when(wide.between(F.lit(decimal.Decimal(low)), F.lit(decimal.Decimal(high))) | column.isNull(), out).otherwise(fail("is outside"))
    elif core.name in ("Enum8", "Enum16"):
        out = F.when(column.isin(*core.labels) | column.isNull(), out).otherwise(fail("is no member of"))
    elif core.name == "Date":
        out = F.when(F.unix_date(out).between(0, 65535) | column.isNull(), out).otherwise(fail("is outside"))
    elif core.name == "UUID":
        plain = F.lower(F.regexp_replace(column, "-", ""))
        text = F.regexp_replace(plain, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
        out = F.when(plain.rlike("^[0-9a-f]{32}$") | column.isNull(), text).otherwise(fail("is no"))
    return out if nullable(kind) else F.when(column.isNull(), fail("in")).otherwise(out)
