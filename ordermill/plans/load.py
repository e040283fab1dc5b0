"""Processed partitions into the star schema."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import UTC, date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.errors import LoadRefused
from ordermill.functions.values import count_if
from ordermill.model import CALENDAR_END, CALENDAR_START, CONFORMED, KEY, STAR
from ordermill.operators.lookup import attach, bounded
from ordermill.operators.merge import CHANGE, merge, with_new_keys
from ordermill.operators.numbering import day_slot, day_starts, dense_by_day
from ordermill.session import CODEC, let_go, side_by_side
from ordermill.sources.lake import Lake
from ordermill.sources.publish import read_manifest
from ordermill.sources.star import Star
from ordermill.sources.warehouse import WHOLE, Warehouse

PART = "_part"


@dataclass(frozen=True)
class Target:
    """A star table, the dataset it is loaded from, and the keys it resolves.

    ``lookups`` names dimensions with the business key and the surrogate they give; ``day`` names
    the date column and the date key made of it.
    """

    table: str
    dataset: str
    surrogate: str
    lookups: tuple[tuple[str, str, str], ...] = ()
    day: tuple[str, str] | None = None

    @property
    def key(self) -> str:
        return KEY[self.dataset]

    @property
    def resolved(self) -> tuple[str, ...]:
        keys = tuple(surrogate for _, _, surrogate in self.lookups)
        return keys + ((self.day[1],) if self.day else ())


DIMENSIONS = (
    Target("dim_customer", "customers", "customer_key"),
    Target("dim_restaurant", "restaurants", "restaurant_key"),
    Target("dim_delivery_partner", "delivery_partners", "delivery_partner_key"),
)
FACTS = (
    Target(
        "fact_order",
        "orders",
        "order_key",
        (
            ("dim_customer", "customer_id", "customer_key"),
            ("dim_restaurant", "restaurant_id", "restaurant_key"),
        ),
        ("order_date", "order_date_key"),
    ),
    Target("fact_payment", "payments", "payment_key", (), ("payment_date", "payment_date_key")),
    Target(
        "fact_delivery",
        "delivery",
        "delivery_key",
        (("dim_delivery_partner", "delivery_partner_id", "delivery_partner_key"),),
        ("order_date", "order_date_key"),
    ),
)
TARGETS = DIMENSIONS + FACTS
STAGED_ONLY = "daily_order_metrics"  # kept for the reconciliation check


def staged_partition(lake: Lake, dataset: str, run_date: date) -> tuple[DataFrame, int]:
    """A published partition and its row count; they must agree with the manifest."""
    manifest = read_manifest(lake, dataset, run_date)
    if manifest is None:
        raise LoadRefused("partition is not published; run publish first", dataset=dataset)
    staged = lake.read_partition("processed", dataset, run_date, CONFORMED[dataset])
    rows = staged.count()
    if rows != manifest["row_count"]:
        raise LoadRefused(
            "staged rows differ from the manifest",
            dataset=dataset,
            expected=manifest["row_count"],
            found=rows,
        )
    return staged, rows


def resolve(staged: DataFrame, target: Target, star: Star) -> DataFrame:
    """Staged rows in the target's shape; a key that does not resolve is NULL."""
    rows = staged
    for dimension, business_key, surrogate in target.lookups:
        rows = attach(rows, getattr(star, dimension), business_key, **{surrogate: surrogate})
    if target.day:
        rows = with_day(rows, target, star)
    own = [n for n in STAR[target.table].fieldNames() if n in rows.columns]
    return rows.select(*own)


def with_day(rows: DataFrame, target: Target, star: Star) -> DataFrame:
    """``rows`` with the date key of the target's date column; NULL for a day that is not in the calendar."""
    column, date_key = target.day
    days = star.dim_date.select(F.col("full_date").alias(column), F.col("date_key").alias(date_key))
    return rows.join(days, column, "left")


def _part(warehouse: Warehouse, date_key: str) -> Column:
    return F.expr(f"{date_key} div {warehouse.period}")


def touched_parts(
    warehouse: Warehouse, target: Target, keys: DataFrame, rows: DataFrame
) -> list[str]:
    """Parts the batch writes to, and parts that hold an older version of one of its keys.

    The latter come from the key index, of which the buckets of the batch's keys are read; the stored
    facts are not.  The result has one entry per calendar period.
    """
    date_key = target.day[1]
    index = warehouse.key_index(target.table, keys)
    older = index.join(keys.toDF("key"), "key", "left_semi").select("part")
    dated = rows.where(F.col(date_key).isNotNull())
    parts = older.unionByName(dated.select(_part(warehouse, date_key).cast("string").alias("part")))
    return [row["part"] for row in parts.distinct().collect()]


def number_plan(
    warehouse: Warehouse, target: Target, dated: DataFrame, stored: DataFrame, highest: int
) -> tuple[DataFrame, int]:
    """:func:`day_starts` of a batch's new rows after the surrogate key ``highest``, and the number of new rows.

    ``dated`` are the staged keys with their date key, ``stored`` the rows of the parts that are touched.  Only keys
    are compared, and what is gathered is a few counts for each day.
    """
    key, day = target.key, target.day[1]
    known = bounded(stored.select(key), highest)
    new = dated.select(key, day).join(known, key, "left_anti").withColumn("_new", F.lit(1))
    counts = (
        new.unionByName(stored.select(key, day, F.lit(0).alias("_new")))
        .where(F.col(day).isNotNull())
        .groupBy(day, day_slot(key).alias("_slot"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("_new").alias("new"))
        .collect()
    )
    starts = warehouse.spark.createDataFrame(
        day_starts([tuple(row) for row in counts], warehouse.period, highest),
        f"{day} int, _slot int, _group int, _start long",
    )
    return starts, sum(row["new"] for row in counts)


def new_entries(
    warehouse: Warehouse, target: Target, keys: DataFrame, written: DataFrame, loaded_at
) -> DataFrame:
    """Key index entries of the rows that this load has written, without those already there."""
    changed = written.where(F.col("updated_at") == F.lit(loaded_at).cast("timestamp")).select(
        F.col(target.key).alias("key"),
        _part(warehouse, target.day[1]).cast("string").alias("part"),
    )
    known = bounded(warehouse.key_index(target.table, keys), warehouse.record(target.table)["highest_key"])
    return changed.join(known, ["key", "part"], "left_anti")


def unresolved_keys(resolved: DataFrame, target: Target) -> DataFrame:
    """Rows per required key that is NULL in resolved rows; keys that are always set are left out."""
    counts = resolved.agg(*(count_if(F.col(name).isNull()).alias(name) for name in target.resolved))
    pairs = ", ".join(f"'{name}', `{name}`" for name in target.resolved)
    listed = counts.selectExpr(f"stack({len(target.resolved)}, {pairs}) AS (key_column, rows)")
    return listed.where("rows > 0").select(F.lit(target.table).alias("table_name"), "key_column", "rows")


def _check_written(
    written: DataFrame, staged: DataFrame, target: Target, loaded_at, most: int
) -> dict:
    """Rows updated and inserted, once every staged key has arrived and no required key is NULL; ``most`` rows at
    most are written."""
    stamp = F.lit(loaded_at).cast("timestamp")
    counts = written.agg(
        count_if((F.col("updated_at") == stamp) & (F.col("created_at") < stamp)).alias("updated"),
        count_if(F.col("created_at") == stamp).alias("inserted"),
        *(count_if(F.col(name).isNull()).alias(name) for name in target.resolved),
    )
    arrived = bounded(written.select(target.key), most)
    lost = staged.select(target.key).join(arrived, target.key, "left_anti")
    found, missing = side_by_side([lambda: counts.first().asDict(), lost.count])
    unresolved = {name: found[name] for name in target.resolved if found[name]}
    if unresolved:
        raise LoadRefused("keys do not resolve", table=target.table, unresolved=unresolved)
    if missing:
        raise LoadRefused("staged rows did not arrive", table=target.table, missing=missing)
    return found


def load_table(
    warehouse: Warehouse, lake: Lake, target: Target, run_date: date, loaded_at: datetime
) -> dict:
    """Merge one published partition into its table; on any error the table stays as it was.

    Dimensions are rewritten whole, facts only in the parts a batch touches.
    """
    started = time.monotonic()
    staged, rows = staged_partition(lake, target.dataset, run_date)
    changes = {"updated": 0, "inserted": 0}
    if rows:
        record = warehouse.record(target.table)
        parts = dict(record["parts"])
        star = warehouse.star()
        resolved = resolve(staged, target, star)
        keys = bounded(staged.select(target.key), rows)
        folder = warehouse.next_folder(target.table)
        uri = warehouse.files.uri(f"{target.table}/{folder}")
        if target.day:
            dated = with_day(staged.select(target.key, target.day[0]), target, star)
            touched = touched_parts(warehouse, target, keys, dated)
            stored = warehouse.read(target.table, touched)
            starts, new = number_plan(warehouse, target, dated, stored, record["highest_key"])
            fresh = resolved.withColumn(target.surrogate, F.lit(None).cast("long"))
            merged = merge(stored, fresh, target.key, target.surrogate, loaded_at).drop(CHANGE)
            by_part = merged.withColumn(PART, _part(warehouse, target.day[1]))
            numbered = dense_by_day(
                by_part, starts, PART, target.day[1], target.key, target.surrogate
            )
            numbered.write.option("compression", CODEC).partitionBy(PART).parquet(uri)
            prefix = f"{PART}="
            parts = {part: path for part, path in parts.items() if part not in touched} | {
                name.removeprefix(prefix): f"{folder}/{name}"
                for name in warehouse.files.names(f"{target.table}/{folder}")
                if name.startswith(prefix)
            }
        else:
            stored = bounded(warehouse.read(target.table), record["highest_key"])
            fresh = with_new_keys(resolved, stored, target.key, target.surrogate, record["highest_key"])
            result = merge(stored, fresh, target.key, target.surrogate, loaded_at).drop(CHANGE)
            result.write.option("compression", CODEC).parquet(uri)
            parts[WHOLE] = folder
        written = warehouse.spark.read.schema(STAR[target.table]).parquet(uri)
        changes = _check_written(written, staged, target, loaded_at, record["highest_key"] + rows)
        highest = record["highest_key"] + changes["inserted"]
        index = None
        if target.day:
            if changes["inserted"] != new:
                raise LoadRefused(
                    "new rows differ from the keys given",
                    table=target.table,
                    expected=new,
                    found=changes["inserted"],
                )
            entries = new_entries(warehouse, target, keys, written, loaded_at)
            index = warehouse.add_keys(target.table, entries, folder, rows)
        warehouse.commit(target.table, parts, highest, after=record["version"], keys=index)
    return {
        "table": target.table,
        "dataset": target.dataset,
        "status": "SUCCESS" if rows else "NO_DATA",
        "records_in": rows,
        "records_staged": rows,
        "rows_updated": changes["updated"],
        "rows_inserted": changes["inserted"],
        "duration_seconds": round(time.monotonic() - started, 2),
    }


def load_warehouse(
    warehouse: Warehouse,
    lake: Lake,
    run_date: date,
    first_day: str = CALENDAR_START,
    last_day: str = CALENDAR_END,
) -> list[dict]:
    """All tables, dimensions before the facts that point at them, and the metrics that are only
    staged."""
    loaded_at = datetime.now(UTC).replace(tzinfo=None)
    warehouse.init(first_day, last_day)
    results = []
    for wave in (DIMENSIONS, FACTS):
        results += side_by_side(
            [partial(load_table, warehouse, lake, t, run_date, loaded_at) for t in wave]
        )
        let_go(warehouse.spark)
    started = time.monotonic()
    _, rows = staged_partition(lake, STAGED_ONLY, run_date)
    results.append(
        {
            "table": f"stg_{STAGED_ONLY}",
            "dataset": STAGED_ONLY,
            "status": "SUCCESS" if rows else "NO_DATA",
            "records_in": rows,
            "records_staged": rows,
            "rows_updated": 0,
            "rows_inserted": 0,
            "duration_seconds": round(time.monotonic() - started, 2),
        }
    )
    return results
