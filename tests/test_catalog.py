import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewire.sources.catalog import (
    BAD_COLUMNS,
    DECLARED_TYPES,
    CatalogColumn,
    conform_to_catalog,
    declared_columns,
    schema_json,
    spark_schema,
    wire_schema,
)


@pytest.mark.parametrize("name", ["decimal(10,2)", "array<int>", "STRING", "Bigint", "json", "char(3)"])
def test_other_names_are_binary(name):
    assert CatalogColumn("c", name).spark_type() == T.BinaryType()


def test_strict_reads_spark_types():
    assert CatalogColumn("c", "decimal(10,2)").spark_type(strict=True) == T.DecimalType(10, 2)
    assert CatalogColumn("c", "array<int>").spark_type(strict=True) == T.ArrayType(T.IntegerType())


def test_every_declared_type_has_a_wire_type():
    columns = [CatalogColumn(n, n) for n in DECLARED_TYPES]
    assert [str(t) for t in wire_schema(columns).types][:4] == ["string", "binary", "int8", "int16"]
    assert str(wire_schema([CatalogColumn("t", "datetime")]).field("t").type) == "timestamp[ms, tz=UTC]"


def test_metadata_and_nullability_are_carried():
    field = spark_schema([CatalogColumn("c", "int", False, "a comment", "7", "0")])["c"]
    assert not field.nullable
    assert field.metadata == {"comment": "a comment", "column_id": "7", "default_value": "0"}
    back = declared_columns(T.StructType([field]))[0]
    assert (back.name, back.type, back.comment) == ("c", "int", "a comment")


def test_schema_text_keeps_partition_keys_apart():
    text = json.loads(schema_json([CatalogColumn("a", "int")], [CatalogColumn("p", "string")]))
    assert [c["name"] for c in text["columns"]] == ["a"]
    assert [c["name"] for c in text["partitionKeys"]] == ["p"]
    assert text["IsVirtualView"] is False


def test_bad_columns(spark):
    df = spark.createDataFrame(
        [("1", "x", "2.5"), ("900", None, "nan"), (None, "y", "2,5"), (" 7 ", "z", "1e3")], "a string, b string, c string"
    )
    out = conform_to_catalog(
        df, [CatalogColumn("a", "tinyint"), CatalogColumn("b", "string", nullable=False), CatalogColumn("c", "double")]
    )
    rows = out.collect()
    assert [r["a"] for r in rows] == [1, None, None, 7]
    assert [r[BAD_COLUMNS] for r in rows] == [[], ["a", "b"], ["c"], []]
    assert rows[3]["c"] == 1000.0


def test_unknown_type_becomes_bytes(spark):
    df = spark.createDataFrame([(1.5, "é")], "a double, b string")
    row = conform_to_catalog(df, [CatalogColumn("a", "decimal(3,1)"), CatalogColumn("b", "varchar(4)")]).first()
    assert bytes(row["a"]) == b"1.5" and bytes(row["b"]) == "é".encode()


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError):
        conform_to_catalog(spark.range(1), [CatalogColumn("other", "int")])


def test_one_projection(spark, plan):
    df = spark.range(10).select(F.col("id").cast("string").alias("a"))
    assert "Exchange" not in plan(conform_to_catalog(df, [CatalogColumn("a", "int")]))
