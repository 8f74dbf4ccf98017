"""Bringing any table into the common ``text`` + ``meta`` shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reformat(df: DataFrame, text_field: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``text``, ``meta`` and the columns named in ``carry``.

    ``meta`` keeps the fields of an existing ``meta`` column, overlaid by every other top-level column; it
    is never NULL. Reading single fields of it still prunes and pushes down to the scan.
    """
    top_level = [name for name in df.columns if name not in {text_field, "meta", *carry}]
    fields = {}
    if "meta" in df.columns:
        meta_type = df.schema["meta"].dataType
        if not isinstance(meta_type, T.StructType):
            raise TypeError(f"meta must be a struct, not {meta_type.simpleString()}")
        fields = {name: F.col("meta").getField(name) for name in meta_type.names}
    fields.update({name: F.col(f"`{name}`") for name in top_level})
    meta = F.struct(*(column.alias(name) for name, column in fields.items()))
    if not fields:
        meta = F.lit(None).cast("struct<>")
    return df.select(
        F.col(f"`{text_field}`").alias("text"), meta.alias("meta"), *(F.col(f"`{c}`") for c in carry)
    )
