"""Fit a DataFrame to a declared schema."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column reference that survives dots and blanks in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def lenient_cast(raw: Column, to: T.DataType) -> Column:
    """NULL where the value does not fit; whole-number types accept ``3.0`` as 3, but not ``3.7``."""
    if isinstance(to, T.IntegralType):
        # Through text, as a cast would cut off what follows the point: "12" fits, "12.5" does not. Decimals
        # keep every digit of a BIGINT.
        text = raw.cast("string")
        number = text.try_cast("decimal(38,18)")
        whole = F.when(number == F.floor(number), number.try_cast(to))
        return F.coalesce(F.when(~text.contains("."), text.try_cast(to)), whole)
    return raw.try_cast(to)


def align(
    df: DataFrame, schema: T.StructType, *, skip: Collection[str] = (), lenient: bool = False
) -> DataFrame:
    """Project onto ``schema``: its order and types, typed NULLs for missing, extras dropped.

    ``lenient`` turns values that do not fit into NULL instead of failing.
    """
    present = set(df.columns)

    def fit(field: T.StructField) -> Column:
        if field.name not in present:
            value = F.lit(None).cast(field.dataType)
        elif lenient:
            value = lenient_cast(quoted(field.name), field.dataType)
        else:
            value = quoted(field.name).cast(field.dataType)
        return value.alias(field.name)

    return df.select(*[fit(f) for f in schema.fields if f.name not in skip])


def new_fields(
    df: DataFrame, schema: T.StructType, *, protected: Collection[str] = ()
) -> list[T.StructField]:
    """Fields of ``df`` that ``schema`` does not have yet (names compared exactly)."""
    known = {*schema.fieldNames(), *protected}
    return [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in known]
