"""One row per key, current state per key, and fixed output shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.values import blank_to_null


def top_per_key(df: DataFrame, keys: str | list[str], *order: Column) -> DataFrame:
    """The first row of every key under ``order``.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle too, so a key
    holding a third of all rows sends one row per map task, not all of them.
    """
    keys = [keys] if isinstance(keys, str) else keys
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def deduplicate(
    df: DataFrame, keys: str | list[str], first_by: str | list[str] = "_source_row_number"
) -> DataFrame:
    """Keep the first copy of every key, in source order; unnumbered rows come last."""
    first_by = [first_by] if isinstance(first_by, str) else first_by
    return top_per_key(df, keys, *(F.col(name).asc_nulls_last() for name in first_by))


def current_state(
    batch: DataFrame, earlier: DataFrame | None, key: str, wanted: DataFrame | None = None
) -> DataFrame:
    """Current row per key: the batch's where it has one, else the latest earlier partition's.

    ``wanted`` (a frame with the column ``key``) names the keys that will be looked up: the history
    is narrowed to them, and to keys the batch lacks, before it is ranked, so the work after its scan
    follows the size of the batch.
    """
    if earlier is None:
        return batch
    if wanted is not None:
        earlier = earlier.join(wanted.select(key).distinct(), key, "left_semi")
    # Spread by key for the ranking anyway, so a broadcast of the batch's keys would gain nothing.
    older = earlier.join(batch.select(key).hint("merge"), key, "left_anti")
    latest = top_per_key(older, key, F.col("source_ingestion_date").desc_nulls_last())
    return batch.unionByName(latest.select(*batch.columns))


def clean_text(df: DataFrame, codes=()) -> DataFrame:
    """Text columns without outer spaces, NULL when nothing is left, and in upper case where they are
    among ``codes``; other columns as they are."""

    def cleaned(field: T.StructField) -> Column:
        value = F.col(field.name)
        if not isinstance(field.dataType, T.StringType):
            return value
        value = blank_to_null(value)
        return (F.upper(value) if field.name in codes else value).alias(field.name)

    return df.select(*map(cleaned, df.schema))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types."""
    return df.selectExpr(
        *(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    )
