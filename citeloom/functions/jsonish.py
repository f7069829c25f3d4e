"""JSON encode / decode and flattening of nested rows (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_json_text(*cols, name: str = "value") -> Column:
    """One JSON object per row from the given columns; NULL fields are written as null."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(name)


def from_json_text(text, schema) -> Column:
    """Decode JSON text with a fixed schema; malformed text gives NULL fields."""
    t = F.col(text) if isinstance(text, str) else text
    return F.from_json(t, schema)


def flatten(df: DataFrame, struct_col: str, prefix: str = "") -> DataFrame:
    """Lift one level of a struct column into top-level columns."""
    fields = df.schema[struct_col].dataType.fieldNames()
    others = [F.col(c) for c in df.columns if c != struct_col]
    return df.select(*others, *[F.col(f"{struct_col}.`{f}`").alias(prefix + f) for f in fields])
