"""Drops for whole runs over the order-processing tables: sound records, and damage added to them.

Damage is extra records, made of every so many sound ones by a rule's number: the same records on every
machine and at every scale, and countable in SQL.  Each extra record breaks the rule it is named after and
refers to sound parents otherwise, so that one rule's damage does not spread to others' counts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.model import SOURCE
from ordermill.quality.evaluate import LINEAGE_COLUMNS
from ordermill.sources import layout, trade
from ordermill.sources.lake import Lake

#: Number of the sound record that a record is made of.
BASE = "_base"
_SECOND = "yyyy-MM-dd HH:mm:ss"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    joined = trade.read(spark, folder, "customer").join(
        trade.places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        f"CAST(c_custkey AS BIGINT) AS {BASE}",
        "CAST(c_custkey AS STRING) AS customer_id",
        "c_name AS customer_name",
        "concat(lower(replace(c_name, '#', '.')), '@example.com') AS email",
        "n_name AS city",
        "date_format(date_add(DATE '1995-01-01', CAST(c_custkey * 7 % 2000 AS INT)), 'yyyy-MM-dd')"
        " AS signup_date",
    )


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    joined = trade.read(spark, folder, "supplier").join(
        trade.places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        f"CAST(s_suppkey AS BIGINT) AS {BASE}",
        "CAST(s_suppkey AS STRING) AS restaurant_id",
        "s_name AS restaurant_name",
        "n_name AS city",
        "r_name AS cuisine",
        "concat(s_suppkey % 5, '.', s_suppkey % 10) AS rating",
    )


def delivery_partners(spark: SparkSession, folder: str) -> DataFrame:
    return trade.read(spark, folder, "part").selectExpr(
        f"CAST(p_partkey AS BIGINT) AS {BASE}",
        "CAST(p_partkey AS STRING) AS delivery_partner_id",
        "p_name AS partner_name",
        "p_brand AS city",
        "date_format(date_add(DATE '1995-01-01', p_size), 'yyyy-MM-dd') AS joining_date",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """All orders; those without lines are from restaurant 1."""
    placed = trade.orders(spark, folder)
    return placed.select(
        F.col("order_key").cast("long").alias(BASE),
        "order_id",
        trade.text("customer_key").alias("customer_id"),
        F.coalesce("restaurant_key", F.lit(1)).cast("string").alias("restaurant_id"),
        F.date_format("order_timestamp", _SECOND).alias("order_date"),
        trade.text("order_amount").alias("order_amount"),
        "order_status",
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return trade.payments(spark, folder).select(
        F.col("payment_key").cast("long").alias(BASE),
        "payment_id",
        "order_id",
        "payment_method",
        trade.text("payment_amount").alias("payment_amount"),
        "payment_status",
        F.date_format("payment_timestamp", _SECOND).alias("payment_date"),
    )


def delivery(spark: SparkSession, folder: str) -> DataFrame:
    """First lines; a minute for each day between order and shipment, whichever came first."""
    minutes = F.abs(F.col("delivery_duration_minutes")).cast("long")
    arrival = F.timestamp_seconds(F.unix_seconds("pickup_time") + minutes * 60)
    return trade.deliveries(spark, folder).select(
        F.col("delivery_key").cast("long").alias(BASE),
        "delivery_id",
        "order_id",
        trade.text("delivery_partner_key").alias("delivery_partner_id"),
        F.date_format("pickup_time", _SECOND).alias("pickup_time"),
        F.date_format(arrival, _SECOND).alias("delivery_time"),
        "delivery_status",
    )


SOUND = {
    "customers": customers,
    "restaurants": restaurants,
    "delivery_partners": delivery_partners,
    "orders": orders,
    "payments": payments,
    "delivery": delivery,
}

# For each dataset the rules in the order of their numbers, and what is changed in an extra record.
DAMAGE = {
    "customers": (
        {"customer_id": "NULL"},
        {},
        {"city": "'  '"},
        {"signup_date": "'2101-01-01'"},
        {"email": "NULL"},
    ),
    "restaurants": ({"restaurant_id": "''"}, {}, {"rating": "'7.5'"}),
    "delivery_partners": ({"delivery_partner_id": "NULL"}, {}, {"joining_date": "'31/12/1999'"}),
    "orders": (
        {"order_id": "NULL"},
        {},
        {"customer_id": "NULL"},
        {"customer_id": "'nobody'"},
        {"restaurant_id": "'nowhere'"},
        {"order_amount": "'-1.00'"},
        {"order_status": "'lost'"},
        {"order_date": "'2001-13-01 00:00:00'"},
    ),
    "payments": (
        {"payment_id": "NULL"},
        {},
        {"order_id": "'none'"},
        {"payment_amount": "'-1.00'"},
        {"payment_status": "'pending'"},
        {"payment_method": "'cheque'"},
        {"payment_date": "'soon'"},
    ),
    "delivery": (
        {"delivery_id": "NULL"},
        {},
        {"order_id": "'none'"},
        {"delivery_partner_id": "'nobody'"},
        {"delivery_time": "'1990-01-01 00:00:00'"},
        {"delivery_status": "'returned'"},
        {"pickup_time": "'unknown'"},
        {"delivery_status": "'DELIVERED'", "delivery_time": "NULL"},
    ),
}


def damaged(sound: DataFrame, dataset: str, every: int) -> DataFrame:
    """``sound`` records and, for rule n of the dataset, an extra one of each whose number leaves n when
    divided by ``every``.  ``_copy`` is 0 for sound records and n for extra ones.

    Extra records have keys of their own unless their rule is about the key.
    """
    columns = SOURCE[dataset].fieldNames()
    key = columns[0]

    def record(number: int, changes: dict[str, str]):
        own = {} if number in (0, 2) else {key: f"concat({key}, '-x{number}')"}
        values = {name: f"CAST({name} AS STRING)" for name in columns} | own | changes
        fields = ", ".join(f"'{name}', CAST({values[name]} AS STRING)" for name in columns)
        return f"named_struct('_copy', {number}, {fields})"

    extra = [
        f"CASE WHEN {BASE} % {every} = {number} THEN {record(number, changes)} END"
        for number, changes in enumerate(DAMAGE[dataset], 1)
    ]
    every_record = f"array_compact(array({record(0, {})}, {', '.join(extra)}))"
    return sound.selectExpr(BASE, f"inline({every_record})")


def as_raw(records: DataFrame, dataset: str) -> DataFrame:
    """:func:`damaged` records with lineage, numbered so that a copy comes after its original."""
    stamp = {
        "_ingestion_timestamp": F.lit("2001-12-31 06:00:00").cast("timestamp"),
        "_ingestion_date": F.lit("2001-12-31").cast("date"),
        "_source_file": F.lit("trade"),
        "_source_row_number": F.col(BASE) * 10 + F.col("_copy") + 1,
        "_run_id": F.lit("r1"),
    }
    return records.withColumns(stamp).select(*SOURCE[dataset].fieldNames(), *LINEAGE_COLUMNS)


def write_drop(
    records: DataFrame, root: str, dataset: str, load_type: str, day: date, line: str = "\n"
) -> None:
    """Records as a drop of several CSV files, each with its header."""
    records.select(*SOURCE[dataset].fieldNames()).write.csv(
        f"{root}/{layout.drop(dataset, load_type, day)}", header=True, escape='"', lineSep=line
    )


def write_two_drops(
    records: DataFrame, first: Column, root: str, dataset: str, drops: tuple[tuple[date, str], ...]
) -> None:
    """Records as two drops, the ones of ``first`` in the first of ``drops`` (day and load type); those of neither, as
    ``first`` is NULL, are left out.  The records are made once for both."""
    files = Lake(records.sparkSession, root)
    names = {kind: layout.drop(dataset, kind, day) for day, kind in drops}
    (_, one), (_, other) = drops
    split = f"_split/{dataset}"
    columns = SOURCE[dataset].fieldNames()
    kinds = records.select(*columns, F.when(first, one).when(~first, other).alias("_kind"))
    dealt = kinds.where(F.col("_kind").isNotNull())
    dealt.write.partitionBy("_kind").csv(files.uri(split), header=True, escape='"')
    for day, kind in drops:
        if files.exists(f"{split}/_kind={kind}"):
            files.move(f"{split}/_kind={kind}", names[kind])
        else:
            write_drop(records.where(F.lit(False)), root, dataset, kind, day)
    files.delete(split)
