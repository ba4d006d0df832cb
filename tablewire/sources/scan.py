"""Snapshot and partition reads, and batch-wise reads (A2, A3, A6); row ranges are in ``row_range`` (A4)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewire.sources.catalog import CatalogColumn, declared_columns, schema_json
from tablewire.sources.row_range import read_row_range  # noqa: F401

_SPEC_PART = re.compile(r"""\s*(\w+)\s*=\s*('[^']*'|"[^"]*"|[^,/'"]*?)\s*(?:[,/]|$)""")


# -- partitions -----------------------------------------------------------


def partition_values(spec: str) -> dict[str, str]:
    """``"k=v,k2='v2'"`` (or ``k=v/k2=v2``) as ordered key/value pairs."""
    found, at = {}, 0
    while at < len(spec):
        part = _SPEC_PART.match(spec, at)
        if part is None:
            raise ValueError(f"not a partition spec: {spec!r}")
        value = part.group(2)
        quoted = len(value) > 1 and value[0] in "'\"" and value[-1] == value[0]
        found[part.group(1)] = value[1:-1] if quoted else value
        at = part.end()
    if not found:
        raise ValueError("empty partition spec")
    return found


def partition_predicate(schema: T.StructType, spec: str) -> Column:
    """The spec as a conjunction of typed equalities, which Catalyst can prune by."""
    types = {f.name: f.dataType for f in schema.fields}
    predicate = F.lit(True)
    for key, value in partition_values(spec).items():
        if key not in types:
            raise ValueError(f"unknown partition key: {key}")
        literal = F.lit(value)
        if not isinstance(types[key], T.StringType):
            literal = literal.cast(types[key])
        predicate = predicate & (F.col(f"`{key}`") == literal)
    return predicate


def read_partition(df: DataFrame, spec: str) -> DataFrame:
    return df.where(partition_predicate(df.schema, spec))


def snapshot_session(
    df: DataFrame,
    table: str,
    partition_spec: str | None = None,
    partition_keys: Sequence[str] = (),
) -> DataFrame:
    """One row that describes what a read of this table (or partition) will return.

    Read from ``published_table(...)`` at a fixed version, the description and
    the later reads see the same files.
    """
    chosen = df if partition_spec is None else read_partition(df, partition_spec)
    declared = declared_columns(df.schema)
    columns: list[CatalogColumn] = [c for c in declared if c.name not in partition_keys]
    keys = [c for c in declared if c.name in partition_keys]
    return chosen.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(table).alias("table"),
        F.lit(partition_spec).cast("string").alias("partition"),
        "record_count",
        F.lit(schema_json(columns, keys)).alias("columns"),
        F.lit("normal").alias("status"),
    )


# -- batches --------------------------------------------------------------


def map_batches(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """Run ``fn`` over Arrow batches inside the tasks; the first error fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            produced = fn(batch)
            if isinstance(produced, pa.RecordBatch):
                yield produced
            else:
                yield from produced

    return df.mapInArrow(run, schema)


def batch_sizes(df: DataFrame) -> DataFrame:
    """``(n_rows, n_bytes)`` of every Arrow batch."""

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"n_rows": [batch.num_rows], "n_bytes": [batch.nbytes]},
            schema=pa.schema([("n_rows", pa.int64()), ("n_bytes", pa.int64())]),
        )

    return map_batches(df, measure, "n_rows bigint, n_bytes bigint")
