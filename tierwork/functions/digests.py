"""Digests of rows: 128 bits that are equal for equal rows, and for no others but by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tierwork.functions.names import named


def row_digest(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two longs per row, of the given columns in their order.

    Rows that group together have the same digest: null equals null, NaN equals NaN, -0.0 equals 0.0. Spark's hash
    passes over nulls, so whether a column is null is hashed with it, and nested values are hashed
    as their JSON text, in which nulls have a place.
    """
    kinds = {field.name.lower(): field.dataType for field in df.schema}
    inputs: list[Column] = []
    for name in columns:
        value = named(name)
        if isinstance(kinds[name.lower()], ArrayType | MapType | StructType):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        inputs += [named(name).isNull(), value]
    return F.xxhash64(*inputs), F.xxhash64(F.lit(1), *inputs)
