"""Keeping an expensive expression from being evaluated again and again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row.

    A filter on a plain computed column is pushed below the projection and takes
    the whole expression with it, once per reference: a JSON text is then parsed
    for every check made on it.  The output of a generator cannot be pushed, so
    the value goes through an ``explode`` of one element.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
