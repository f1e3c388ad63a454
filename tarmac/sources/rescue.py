"""Set aside rows whose values do not fit the declared schema."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.align import lenient_cast, quoted
from tarmac.sources.feeds import CORRUPT, HELPERS, RESCUED_COLUMN, SOURCE_FILE, UNKNOWN

PAYLOAD = "_payload"

# These have a fallback downstream, so a value that does not fit is no reason to reject.
FORGIVEN = ("ingestion_timestamp",)


def _entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.alias("value"))


def type_fields(
    texts: DataFrame,
    declared: T.StructType,
    *,
    new_columns: Collection[str] = (),
    rescued_column: str = RESCUED_COLUMN,
) -> DataFrame:
    """Typed columns from text, with what did not fit as JSON in ``rescued_column``.

    A value does not fit when it is present but cannot be cast, when its field is neither
    declared nor in ``new_columns``, or when the whole line could not be parsed. The original
    texts stay available as JSON in the payload column.
    """
    names = [c for c in texts.columns if c not in HELPERS]
    types = {f.name: f.dataType for f in declared.fields}
    checked = {
        n: lenient_cast(quoted(n), types[n])
        for n in names
        if n in types and n not in FORGIVEN and not isinstance(types[n], T.StringType)
    }
    strangers = [n for n in names if n not in types and n not in new_columns]

    misfits = {n: quoted(n).isNotNull() & cast.isNull() for n, cast in checked.items()}
    misfits |= {n: quoted(n).isNotNull() for n in strangers}
    unknown = F.coalesce(F.col(UNKNOWN), F.create_map().cast("map<string,string>"))
    entries = F.filter(
        F.array(*[F.when(bad, _entry(n, quoted(n))) for n, bad in misfits.items()]),
        lambda e: e.isNotNull(),
    )
    fields = F.map_concat(F.map_from_entries(entries), unknown) if misfits else unknown
    any_misfit = reduce(lambda a, b: a | b, misfits.values(), F.size(unknown) > 0)

    rescued = F.when(
        F.col(CORRUPT).isNotNull(), F.to_json(F.create_map(F.lit(CORRUPT), F.col(CORRUPT)))
    ).when(any_misfit, F.to_json(fields))
    kept = [n for n in names if n not in strangers]
    return texts.select(
        *[checked.get(n, quoted(n)).alias(n) for n in kept],
        rescued.alias(rescued_column),
        F.to_json(F.struct(*[quoted(n) for n in names])).alias(PAYLOAD),
        SOURCE_FILE,
    )


def split_rescued(
    df: DataFrame, rescued_column: str = RESCUED_COLUMN
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, without the rescued column; rows that do not, with it)."""
    if rescued_column not in df.columns:
        return df, df.limit(0)
    rescued = F.col(rescued_column)
    return df.filter(rescued.isNull()).drop(rescued_column), df.filter(rescued.isNotNull())


def rejected_records(
    rescued: DataFrame,
    *,
    source_table: str,
    source_system: str,
    file_name: Column,
    batch_id: Column | str | None,
    rescued_column: str = RESCUED_COLUMN,
    now: Column | None = None,
) -> DataFrame:
    """Rows for a rejected-records table.

    The payload is the JSON of the row as delivered: the payload column of a typed scan if
    there is one, else all columns but the rescued one.
    """
    if PAYLOAD in rescued.columns:
        payload = F.col(PAYLOAD)
    else:
        payload = F.to_json(F.struct(*[quoted(c) for c in rescued.columns if c != rescued_column]))
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id).cast("string")
    return rescued.select(
        F.lit(source_table).alias("source_table"),
        F.lit(source_system).alias("source_system"),
        file_name.alias("source_file_name"),
        F.col(rescued_column).cast("string").alias("rescued_data"),
        payload.alias("raw_payload"),
        batch.alias("batch_id"),
        (F.current_timestamp() if now is None else now).alias("rejection_timestamp"),
    )
