import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from colonnade import types
from colonnade.client import to_frame
from colonnade.errors import OutOfRange, TypeMismatch, UnknownType

TEXTS = [
    "UInt8", "Int256", "String", "FixedString(3)", "Date", "DateTime('UTC')", "DateTime64(6, 'UTC')", "Time64(9)", "Decimal32(4)", "Decimal(10, 2)", "Enum8('a' = 1, 'it\\'s' = -2)",
    "Array(Array(Nullable(Int64)))", "Tuple(String, Tuple(UInt8, Int8))", "Tuple(a String, b Array(UInt8))", "Map(String, Array(Int64))", "LowCardinality(Nullable(String))", "IntervalWeek", "Point", "JSON", "Nothing",
]


@pytest.mark.parametrize("text", TEXTS)
def test_text_round_trip(text):
    assert str(types.parse(str(types.parse(text)))) == str(types.parse(text))
    types.spark_type(text)


@pytest.mark.parametrize("text", ["", "Nope", "Array(", "Array(Int8) x", "Nullable(Nullable(Int8))", "Map(Array(Int8), Int8)", "Decimal32(10)", "Enum8('a' = 300)", "Enum8('a' = 1, 'b' = 1)", "DateTime64(10)", "Tuple(a Int8, Int8)"])
def test_bad_text(text):
    with pytest.raises(UnknownType):
        types.parse(text)


@pytest.mark.parametrize("bits", [8, 16, 32, 64, 128, 256])
@pytest.mark.parametrize("sign", ["Int", "UInt"])
def test_integer_bounds(bits, sign):
    low, high = types.INTEGERS[f"{sign}{bits}"]
    for n in (low, high, random.Random(bits).randint(low, high)):
        assert int(types.convert(f"{sign}{bits}", n)) == n
    for n in (low - 1, high + 1):
        with pytest.raises(OutOfRange):
            types.convert(f"{sign}{bits}", n)


def test_values():
    assert types.convert("Decimal64(2)", (12345, 3)) == decimal.Decimal("12.34")
    assert types.convert("Decimal256(38)", "1.5").startswith("1.5")
    with pytest.raises(OutOfRange):
        types.convert("Decimal32(4)", 123456)
    assert types.convert("UUID", "00112233445566778899AABBCCDDEEFF") == "00112233-4455-6677-8899-aabbccddeeff"
    assert types.convert("IPv4", (192, 168, 1, 1)) == 3232235777
    assert types.convert("IPv6", "2001:DB8:0:0::1") == "2001:db8::1"
    assert types.convert("Date", (2149, 6, 6)) == dt.date(2149, 6, 6)
    with pytest.raises(OutOfRange):
        types.convert("Date", (2149, 6, 7))
    assert types.convert("DateTime64(9)", 1_500_000_000_123_456_789) == 1_500_000_000_123_456_789
    assert types.convert("DateTime64(3)", 1500).microsecond == 500_000
    assert types.convert("IntervalQuarter", 2) == 6
    with pytest.raises(TypeMismatch):
        types.convert("IntervalDay", ("hour", 2))
    with pytest.raises(TypeMismatch):
        types.convert("JSON", "{bad")
    with pytest.raises(TypeMismatch) as e:
        types.convert("Array(Tuple(String, Int32))", [("a", 1), ("b", "x")])
    assert e.value.info["path"] == (1, 1)


@pytest.mark.parametrize(
    "text, values",
    [
        ("Nullable(Int32)", [1, None, 3]), ("Array(Nullable(Int32))", [[1, None], [], [5]]), ("Tuple(String, Int32)", [("Alice", 25), ("Bob", 30), ("", 0)]),
        ("Map(String, Array(Int64))", [{"a": [1]}, {}, {"b": [], "c": [2, 3]}]), ("Float64", [1.5, float("inf"), float("-inf")]), ("UInt64", [0, 1, 2**64 - 1]), ("Bool", [True, False, True]),
        ("LowCardinality(Nullable(String))", ["a", None, "a"]), ("Array(Decimal32(2))", [[1, 2], [3], []]), ("Nullable(Date)", [dt.date(2020, 1, 1), None, None]), ("Int256", [2**255 - 1, 0, -(2**255)]),
    ],
)
def test_spark_round_trip(spark, text, values):
    n = list(range(len(values)))
    rows = to_frame(spark, [{"name": "id", "type": "UInt8", "data": n}, {"name": "v", "type": text, "data": values}]).orderBy("id").collect()
    want = [types.convert(text, v) for v in values]
    plain = lambda v: tuple(map(plain, v)) if isinstance(v, (tuple, list)) else v
    assert [plain(r["v"]) for r in rows] == [plain(v) for v in want]


def test_checked_column(spark):
    df = spark.range(3)
    assert [r[0] for r in df.select(types.checked("UInt8", F.col("id"))).collect()] == [0, 1, 2]
    with pytest.raises(Exception, match="outside UInt8"):
        df.select(types.checked("UInt8", F.col("id") + 255)).collect()
