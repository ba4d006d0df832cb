"""Typed, strict reads from JSON text.

``from_json`` turns a number into a string and a missing required field into
null without a word.  Here the text is parsed once to a variant and every field
is read together with the JSON type that it really had.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Widths of the unsigned and signed 32-bit integers of the wire format.
UINT32_MAX = 4294967295


def parse(text: Column) -> Column:
    """JSON text to variant; null when the text is not JSON."""
    return F.try_parse_json(text)


def raw(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "variant")


def kind(doc: Column, path: str = "$") -> Column:
    """Spark's name of the JSON type at ``path``; null if absent, VOID if null."""
    return F.schema_of_variant(raw(doc, path))


def absent(doc: Column, path: str) -> Column:
    return F.coalesce(kind(doc, path), F.lit("VOID")) == "VOID"


def is_string(doc: Column, path: str) -> Column:
    return F.coalesce(kind(doc, path) == "STRING", F.lit(False))


def is_boolean(doc: Column, path: str) -> Column:
    return F.coalesce(kind(doc, path) == "BOOLEAN", F.lit(False))


def is_number(doc: Column, path: str) -> Column:
    return F.coalesce(kind(doc, path).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit(False))


def is_int32(doc: Column, path: str) -> Column:
    return F.coalesce(
        (kind(doc, path) == "BIGINT") & F.try_variant_get(doc, path, "int").isNotNull(),
        F.lit(False),
    )


def is_uint32(doc: Column, path: str) -> Column:
    return F.coalesce(
        (kind(doc, path) == "BIGINT")
        & F.try_variant_get(doc, path, "bigint").between(0, UINT32_MAX),
        F.lit(False),
    )


def is_object(doc: Column, path: str) -> Column:
    return F.coalesce(kind(doc, path).startswith("OBJECT"), F.lit(False))


def elements(doc: Column, path: str) -> Column:
    """The JSON array at ``path`` as array<variant>; null for anything else."""
    return F.try_variant_get(doc, path, "array<variant>")


def entries(doc: Column, path: str) -> Column:
    """The JSON object at ``path`` as map<string,variant>; null for anything else."""
    return F.try_variant_get(doc, path, "map<string,variant>")


def is_string_or_absent(doc: Column, path: str) -> Column:
    return F.coalesce(kind(doc, path), F.lit("VOID")).isin("STRING", "VOID")


def optional(check, doc: Column, path: str) -> Column:
    """``check`` holds, or the field is missing or null."""
    return absent(doc, path) | check(doc, path)
