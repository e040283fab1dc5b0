"""Keyed merge (update in place, insert new) of a staged batch into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators.numbering import dense_index

CHANGE = "_change"  # 'updated', 'inserted' or 'kept'


def with_new_keys(
    stage: DataFrame, target_keys: DataFrame, key: str, surrogate: str, highest: int
) -> DataFrame:
    """Add ``surrogate`` to staged rows whose business key is new; NULL for known keys."""
    new = stage.select(key).join(target_keys.select(key), key, "left_anti")
    return stage.join(dense_index(new, key, surrogate, after=highest), key, "left")


def merge(
    target: DataFrame, stage: DataFrame, key: str, surrogate: str, loaded_at
) -> DataFrame:
    """``target`` after the batch, plus a ``_change`` column.

    Both sides are unique by ``key``, so the full outer join has no hot keys.  A staged row
    replaces the stored one unless its batch is older; the surrogate key and ``created_at`` of a
    stored row never change.  ``stage`` comes from :func:`with_new_keys`.
    """
    columns = target.columns
    fixed = {surrogate, "created_at", "updated_at"}
    t, s = target.alias("t"), stage.alias("s")
    stored, staged = F.col(f"t.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    newer = F.col("s.source_ingestion_date") >= F.col("t.source_ingestion_date")
    change = (
        F.when(~stored, F.lit("inserted"))
        .when(staged & newer, F.lit("updated"))
        .otherwise(F.lit("kept"))
    )
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").withColumn(
        CHANGE, change
    )
    kept, inserted = F.col(CHANGE) == "kept", F.col(CHANGE) == "inserted"
    now = F.lit(loaded_at).cast("timestamp")

    def merged(name: str):
        if name == surrogate:
            return F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}"))
        if name == "created_at":
            return F.when(inserted, now).otherwise(F.col("t.created_at"))
        if name == "updated_at":
            return F.when(kept, F.col("t.updated_at")).otherwise(now)
        return F.when(kept, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))

    assert fixed <= set(columns)
    return joined.select(*(merged(name).alias(name) for name in columns), CHANGE)


def replace_rows(existing: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``existing`` with every row replaced that shares its keys with a row of ``new``."""
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))
