"""Helpers all operators share: tables, columns, and Arrow maps over whole rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows turned into Python objects at a time, so that a batch of long texts stays small.
SLICE = 256

_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
    "array<double>": pa.list_(pa.float64()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` whose names differ from ``names`` (as Spark compares them)."""
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]


def _field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind), True)


def explode_rows(
    df: DataFrame, inputs: list[Column], start: Callable[[], Callable], fields: dict[str, str]
) -> DataFrame:
    """Any number of rows of ``fields`` for a slice of rows.

    ``start()`` runs once per task and gives a function of one list per input, each
    with a slice's values, that yields tuples in the order of ``fields``.
    """
    schema = T.StructType([_field(name, kind) for name, kind in fields.items()])
    types = [_ARROW[kind] for kind in fields.values()]
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = list(work(*(c.to_pylist() for c in part.columns)))
                for low in range(0, len(rows), 65_536):
                    columns = list(zip(*rows[low : low + 65_536]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t) for c, t in zip(columns, types)], names=names
                    )

    picked = df.select(*[c.alias(f"_{i}") for i, c in enumerate(inputs)])
    return picked.mapInArrow(run, schema)


def extend(
    df: DataFrame, inputs: list[Column], start: Callable[[], Callable], fields: dict[str, str], drop: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with ``fields`` added; they replace columns of the same names, others but ``drop`` stay as they are.

    ``start()`` runs once per task and gives a function of one list per input, each
    with a slice's values, that returns one tuple per row in the order of ``fields``.
    """
    kept = without(df, [*fields, *drop])
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name in kept]
        + [_field(name, kind) for name, kind in fields.items()]
    )
    types = [_ARROW[kind] for kind in fields.values()]
    names = kept + list(fields)
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = work(*(c.to_pylist() for c in part.columns[n:]))
                new = [pa.array(c, type=t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(list(part.columns[:n]) + new, names=names)

    picked = df.select(*[col(name) for name in kept], *[c.alias(f"_in{i}") for i, c in enumerate(inputs)])
    return picked.mapInArrow(run, schema)
