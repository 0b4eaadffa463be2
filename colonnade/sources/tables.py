"""Sources: tables of a folder, file formats, generators, and Python block sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TABLES = "region nation customer supplier part orders lineitem events".split()
FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Views of a folder's tables in this session."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def read(spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType | str | None = None, **options) -> DataFrame:
    """A file source; text formats need a schema, so that no pass over the data infers it."""
    if format not in FORMATS:
        raise ValueError(f"unknown format {format}")
    if schema is None and format in ("json", "csv"):
        raise ValueError(f"{format} needs a schema")
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


class _Block(InputPartition):
    def __init__(self, index: int):
        self.index = index


class BlockSource(DataSource):
    """Rows of block number i from a Python function, one task a block: options `blocks`, and the function by subclass."""

    make: Callable[[int], Iterator[tuple]] = staticmethod(lambda i: iter(()))
    columns = "value long"

    @classmethod
    def name(cls) -> str:
        return "blocks"

    def schema(self) -> str:
        return self.columns

    def reader(self, schema: T.StructType) -> DataSourceReader:
        make, count = type(self).make, int(self.options.get("blocks", "1"))

        class Reader(DataSourceReader):
            def partitions(self) -> list[InputPartition]:
                return [_Block(i) for i in range(count)]

            def read(self, partition: InputPartition) -> Iterator[tuple]:
                yield from make(partition.index)

        return Reader()
