"""Blocks of a bulk write: assignment, sizes, guards and chunk checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "block_id"

# Bytes counted for a value of a fixed-width type.
FIXED_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def _value_bytes(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    width = FIXED_WIDTHS.get(type(field.dataType))
    if width is not None:
        return F.when(value.isNull(), 0).otherwise(width)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))


def row_bytes(schema: T.StructType) -> Column:
    """Raw size of a row: text and binary by length, other types by width, null 0."""
    total = F.lit(0).cast("long")
    for field in schema.fields:
        total = total + _value_bytes(field)
    return total


def assign_blocks(df: DataFrame, keys: Sequence[str], n_blocks: int, hashed: bool = True) -> DataFrame:
    """Add ``block_id`` in ``0 .. n_blocks - 1``.

    ``hashed=False`` takes one integer key modulo ``n_blocks``; rows without a key
    are in block 0.  No exchange
    happens here; the write balances blocks over tasks by their real size.
    """
    if hashed:
        value = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    else:
        (key,) = keys
        value = F.col(f"`{key}`")
    return df.withColumn(BLOCK, F.coalesce(F.pmod(value, F.lit(n_blocks)), F.lit(0)).cast("int"))


def block_ledger(df: DataFrame, sized: T.StructType | None = None) -> DataFrame:
    """``(block_id, record_count, raw_size)``, summed on the map side first."""
    schema = sized or T.StructType([f for f in df.schema.fields if f.name != BLOCK])
    return df.groupBy(BLOCK).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(row_bytes(schema)).alias("raw_size")
    )


def latest_blocks(
    blocks: DataFrame,
    keys: Sequence[str] = ("upload_id", BLOCK),
    version: Column | str = "version",
) -> DataFrame:
    """The newest row per block; a block that was sent again replaces the older one.

    Of rows with equal versions the greatest by all its columns counts, so the result
    does not depend on the order of rows.
    """
    newest = F.col(version) if isinstance(version, str) else version
    whole = F.struct(*[F.col(f"`{c}`") for c in blocks.columns])
    return (
        blocks.groupBy(*keys)
        .agg(F.max_by(whole, F.struct(newest.alias("version"), whole.alias("row"))).alias("newest"))
        .select(*[F.col("newest").getField(c).alias(c) for c in blocks.columns])
    )


def oversize_field(schema: T.StructType, max_field_size: int) -> Column:
    """Path of the first text or binary field over the limit, or null.

    Fields inside of structs, arrays and maps count too: ``a.b`` is a field of a struct,
    ``a[]`` an element of an array, ``a{key}`` a key and ``a{}`` a value of a map.
    """
    checks = [_oversize(F.col(f"`{f.name}`"), f.dataType, f.name, max_field_size) for f in schema.fields]
    return _first_of(checks)


def _first_of(checks: Sequence[Column | None]) -> Column:
    found = [c for c in checks if c is not None]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _oversize(value: Column, kind: T.DataType, path: str, limit: int) -> Column | None:
    """The path of the first oversize text in ``value``; None where its type holds no text."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.when(F.octet_length(value) > limit, F.lit(path))
    if isinstance(kind, T.StructType):
        inner = [_oversize(value.getField(f.name), f.dataType, f"{path}.{f.name}", limit) for f in kind.fields]
        return _first_of(inner) if any(c is not None for c in inner) else None
    if isinstance(kind, T.ArrayType):
        if _oversize(F.lit(None), kind.elementType, path, limit) is None:
            return None
        paths = F.transform(value, lambda x: _oversize(x, kind.elementType, f"{path}[]", limit))
        return F.get(F.array_compact(paths), F.lit(0))
    if isinstance(kind, T.MapType):
        inner = [
            _oversize(F.map_keys(value), T.ArrayType(kind.keyType), f"{path}{{key}}", limit),
            _oversize(F.map_values(value), T.ArrayType(kind.valueType), f"{path}{{}}", limit),
        ]
        inner = [None if c is None else F.replace(c, F.lit("}[]"), F.lit("}")) for c in inner]
        return _first_of(inner) if any(c is not None for c in inner) else None
    return None


def oversize_guard(df: DataFrame, max_field_size: int) -> tuple[DataFrame, DataFrame]:
    """Rows within the field limit at every depth, and the rest with the path of the field; two filters, no exchange."""
    field = oversize_field(df.schema, max_field_size)
    return df.where(field.isNull()), df.withColumn("oversize_field", field).where(field.isNotNull())


# -- chunks ---------------------------------------------------------------

CHUNK_SIZE = 65_536
CHECKSUMS = {"crc32": F.crc32, "md5": F.md5}


def chunk_ledger(
    df: DataFrame,
    id_cols: Sequence[str],
    payload_col: str,
    chunk_size: int = CHUNK_SIZE,
    checksum: str = "crc32",
) -> DataFrame:
    """``(ids, chunk_index, n_bytes, checksum)`` of fixed-size chunks of a payload.

    An empty payload has one empty chunk, a null has none.  Everything happens per row in the
    JVM; there is no exchange.
    """
    digest = CHECKSUMS[checksum]
    payload = F.col(payload_col).cast("binary")
    last = F.greatest(
        F.lit(0), F.ceil(F.octet_length(payload) / F.lit(chunk_size)).cast("int") - 1
    )
    cut = df.where(payload.isNotNull()).select(
        *id_cols, payload.alias("_payload"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_index")
    )
    chunk = F.substring(
        F.col("_payload"), F.col("chunk_index") * F.lit(chunk_size) + 1, F.lit(chunk_size)
    )
    return cut.select(*id_cols, "chunk_index", chunk.alias("_chunk")).select(
        *id_cols,
        "chunk_index",
        F.octet_length("_chunk").alias("n_bytes"),
        digest(F.col("_chunk")).alias("checksum"),
    )


def payload_checksum(df: DataFrame, id_cols: Sequence[str], payload_col: str, checksum: str = "crc32") -> DataFrame:
    """``(ids, n_bytes, checksum)`` over whole payloads."""
    payload = F.col(payload_col).cast("binary")
    return df.where(payload.isNotNull()).select(
        *id_cols, F.octet_length(payload).alias("n_bytes"), CHECKSUMS[checksum](payload).alias("checksum")
    )
