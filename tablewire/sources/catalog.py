"""Declared table schemas and conforming a DataFrame to them (A1)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type name -> Spark type.  Names match exactly, in lower
# case; every other name is carried as binary.
DECLARED_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# The same names on the wire.
WIRE_TYPES = {
    "string": pa.string(),
    "binary": pa.binary(),
    "tinyint": pa.int8(),
    "smallint": pa.int16(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "boolean": pa.bool_(),
    "float": pa.float32(),
    "double": pa.float64(),
    "date": pa.date32(),
    "datetime": pa.timestamp("ms", tz="UTC"),
    "timestamp": pa.timestamp("ns", tz="UTC"),
    "timestamp_ntz": pa.timestamp("ns"),
}

BAD_COLUMNS = "_bad_columns"


@dataclass(frozen=True)
class CatalogColumn:
    """One declared column, with the properties a table service reports."""

    name: str
    type: str
    nullable: bool = True
    comment: str = ""
    column_id: str = ""
    default_value: str = ""

    def spark_type(self, strict: bool = False) -> T.DataType:
        known = DECLARED_TYPES.get(self.type)
        if known is not None:
            return known
        return T.DataType.fromDDL(self.type) if strict else T.BinaryType()

    def spark_field(self, strict: bool = False) -> T.StructField:
        metadata = {
            "comment": self.comment,
            "column_id": self.column_id,
            "default_value": self.default_value,
        }
        return T.StructField(self.name, self.spark_type(strict), self.nullable, metadata)

    def wire_field(self) -> pa.Field:
        return pa.field(self.name, WIRE_TYPES.get(self.type, pa.binary()), self.nullable)

    def as_json(self) -> dict:
        return {
            "column_id": self.column_id,
            "comment": self.comment,
            "default_value": self.default_value,
            "name": self.name,
            "nullable": self.nullable,
            "type": self.type,
        }


def spark_schema(columns: Sequence[CatalogColumn], strict: bool = False) -> T.StructType:
    """Row schema; partition keys are declared apart and are not part of it."""
    return T.StructType([c.spark_field(strict) for c in columns])


def wire_schema(columns: Sequence[CatalogColumn]) -> pa.Schema:
    return pa.schema([c.wire_field() for c in columns])


def declared_columns(schema: T.StructType) -> list[CatalogColumn]:
    """Describe an existing Spark schema with declared type names."""
    names = {spark: declared for declared, spark in DECLARED_TYPES.items() if declared != "datetime"}
    return [
        CatalogColumn(
            name=f.name,
            type=names.get(f.dataType, f.dataType.simpleString()),
            nullable=f.nullable,
            comment=f.metadata.get("comment", ""),
            column_id=f.metadata.get("column_id", ""),
            default_value=f.metadata.get("default_value", ""),
        )
        for f in schema.fields
    ]


def schema_json(
    columns: Sequence[CatalogColumn], partition_keys: Sequence[CatalogColumn] = ()
) -> str:
    return json.dumps(
        {
            "IsVirtualView": False,
            "columns": [c.as_json() for c in columns],
            "partitionKeys": [c.as_json() for c in partition_keys],
        },
        ensure_ascii=False,
    )


# What a text must look like to be worth a cast.  A cast that fails costs an
# exception per row, so texts that cannot succeed are sorted out beforehand.
_INTEGRAL = r"^\s*[+-]?\d+\s*$"
_FLOATING = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"
_DATED = r"^\s*[+-]?\d{4,}"
_CASTABLE = {
    T.ByteType: _INTEGRAL,
    T.ShortType: _INTEGRAL,
    T.IntegerType: _INTEGRAL,
    T.LongType: _INTEGRAL,
    T.FloatType: _FLOATING,
    T.DoubleType: _FLOATING,
    T.DateType: _DATED,
    T.TimestampType: _DATED,
    T.TimestampNTZType: _DATED,
}


def as_bytes(source: Column, source_type: T.DataType) -> Column:
    """A value carried as binary: its text, nested values as JSON."""
    if isinstance(source_type, T.BinaryType):
        return source
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    text = F.to_json(source) if isinstance(source_type, nested) else source.cast("string")
    return text.cast("binary")


def _cast(source: Column, source_type: T.DataType, target: T.DataType) -> Column:
    if source_type == target:
        return source
    if isinstance(target, T.BinaryType):
        return as_bytes(source, source_type)
    if isinstance(source_type, T.StringType) and type(target) in _CASTABLE:
        return F.when(source.rlike(_CASTABLE[type(target)]), source.try_cast(target))
    return source.try_cast(target)


def conform_to_catalog(
    df: DataFrame, columns: Sequence[CatalogColumn], strict: bool = False
) -> DataFrame:
    """Cast to the declared types in one projection and list the columns that failed.

    ``_bad_columns`` names each column whose value was lost by the cast and each
    column declared not nullable that holds null; it is empty for a good row.
    With ``strict`` the types outside the fixed list are read as Spark types
    (decimal, array, map, ...) instead of being carried as binary.
    """
    known = {f.name: f.dataType for f in df.schema.fields}
    missing = [c.name for c in columns if c.name not in known]
    if missing:
        raise ValueError(f"columns not in the input: {missing}")
    out, failures = [], []
    for column in columns:
        source = F.col(f"`{column.name}`")
        field = column.spark_field(strict)
        value = _cast(source, known[column.name], field.dataType)
        out.append(value.alias(column.name, metadata=field.metadata))
        lost = source.isNotNull() & value.isNull()
        if not column.nullable:
            lost = source.isNull() | lost
        failures.append(F.when(lost, F.lit(column.name)))
    return df.select(*out, F.array_compact(F.array(*failures)).alias(BAD_COLUMNS))
