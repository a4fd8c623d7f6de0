"""Schemas of stages that add columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` and further fields; that of ``df`` itself stays as it is."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])
