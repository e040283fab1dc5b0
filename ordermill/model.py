"""Data model: datasets, schemas, allowed values and thresholds.

Everything here is a fixed value of the marketplace's data contract.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
}


def struct(text: str) -> T.StructType:
    """``struct("order_id string, order_amount decimal(10,2)")`` without needing a session."""
    fields = []
    for column in re.split(r",(?![^(]*\))", text):
        name, kind = column.split()
        if kind.startswith("decimal"):
            precision, scale = map(int, re.findall(r"\d+", kind))
            fields.append(T.StructField(name, T.DecimalType(precision, scale)))
        else:
            fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


# --- fixed values: datasets, parents before children -------------------------------------------
DATASETS = ("customers", "restaurants", "delivery_partners", "orders", "payments", "delivery")

# --- fixed values: source columns with their logical types; the first column is the business key
SOURCE = {
    "customers": struct(
        "customer_id string, customer_name string, email string, city string, signup_date date"
    ),
    "restaurants": struct(
        "restaurant_id string, restaurant_name string, city string, cuisine string,"
        " rating decimal(2,1)"
    ),
    "delivery_partners": struct(
        "delivery_partner_id string, partner_name string, city string, joining_date date"
    ),
    "orders": struct(
        "order_id string, customer_id string, restaurant_id string, order_date timestamp,"
        " order_amount decimal(10,2), order_status string"
    ),
    "payments": struct(
        "payment_id string, order_id string, payment_method string,"
        " payment_amount decimal(10,2), payment_status string, payment_date timestamp"
    ),
    "delivery": struct(
        "delivery_id string, order_id string, delivery_partner_id string, pickup_time timestamp,"
        " delivery_time timestamp, delivery_status string"
    ),
}
KEY = {dataset: schema.fieldNames()[0] for dataset, schema in SOURCE.items()}

# --- fixed values: lineage columns added by ingestion
LINEAGE = struct(
    "_ingestion_timestamp timestamp, _ingestion_date date, _source_file string,"
    " _source_row_number long, _run_id string"
)

# --- fixed values: source text formats, enumerations, thresholds
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
ALLOWED = {
    "order_status": ("PLACED", "PREPARING", "OUT_FOR_DELIVERY", "DELIVERED", "CANCELLED"),
    "payment_method": ("UPI", "CARD", "CASH", "WALLET"),
    "payment_status": ("SUCCESS", "FAILED", "REFUNDED"),
    "delivery_status": ("ASSIGNED", "PICKED_UP", "DELIVERED", "FAILED"),
}
LOAD_TYPES = ("historical", "incremental")
LATE_AFTER_MINUTES = 45
MIN_QUALITY_SCORE = 95.0

# --- fixed values: conformed datasets; each also carries the two batch columns below
_BATCH = ", source_ingestion_date date, _run_id string"
CONFORMED = {
    "customers": struct(
        "customer_id string, customer_name string, email string, city string, signup_date date"
        + _BATCH
    ),
    "restaurants": struct(
        "restaurant_id string, restaurant_name string, city string, cuisine string,"
        " rating decimal(2,1)" + _BATCH
    ),
    "delivery_partners": struct(
        "delivery_partner_id string, partner_name string, city string, joining_date date" + _BATCH
    ),
    "orders": struct(
        "order_id string, customer_id string, restaurant_id string, order_timestamp timestamp,"
        " order_date date, order_amount decimal(10,2), order_status string" + _BATCH
    ),
    "payments": struct(
        "payment_id string, order_id string, payment_method string,"
        " payment_amount decimal(10,2), payment_status string, payment_timestamp timestamp,"
        " payment_date date" + _BATCH
    ),
    "delivery": struct(
        "delivery_id string, order_id string, delivery_partner_id string, pickup_time timestamp,"
        " delivery_time timestamp, delivery_duration_minutes decimal(8,2),"
        " delivery_status string, order_date date" + _BATCH
    ),
    "order_analytics": struct(
        "order_id string, order_date date, order_hour int, customer_id string,"
        " customer_city string, restaurant_id string, restaurant_city string, cuisine string,"
        " order_amount decimal(10,2), order_status string, payment_status string,"
        " paid_amount decimal(10,2), delivery_status string,"
        " delivery_duration_minutes decimal(8,2), is_late boolean" + _BATCH
    ),
    "daily_order_metrics": struct(
        "order_date date, total_orders long, paid_orders long, total_revenue decimal(14,2),"
        " average_order_value decimal(10,2), cancelled_orders long,"
        " cancellation_rate_pct decimal(5,2)" + _BATCH
    ),
}

# --- fixed values: star schema
_STAMPS = ", source_ingestion_date date, created_at timestamp, updated_at timestamp"
STAR = {
    "dim_customer": struct(
        "customer_key long, customer_id string, customer_name string, email string, city string,"
        " signup_date date" + _STAMPS
    ),
    "dim_restaurant": struct(
        "restaurant_key long, restaurant_id string, restaurant_name string, city string,"
        " cuisine string, rating decimal(2,1)" + _STAMPS
    ),
    "dim_delivery_partner": struct(
        "delivery_partner_key long, delivery_partner_id string, partner_name string, city string,"
        " joining_date date" + _STAMPS
    ),
    "dim_date": struct(
        "date_key int, full_date date, day_of_month int, day_of_week int, day_name string,"
        " week_of_year int, month int, month_name string, quarter int, year int,"
        " is_weekend boolean"
    ),
    "fact_order": struct(
        "order_key long, order_id string, customer_key long, restaurant_key long,"
        " order_date_key int, order_timestamp timestamp, order_amount decimal(10,2),"
        " order_status string" + _STAMPS
    ),
    "fact_payment": struct(
        "payment_key long, payment_id string, order_id string, payment_method string,"
        " payment_amount decimal(10,2), payment_status string, payment_date_key int,"
        " payment_timestamp timestamp" + _STAMPS
    ),
    "fact_delivery": struct(
        "delivery_key long, delivery_id string, order_id string, delivery_partner_key long,"
        " order_date_key int, pickup_time timestamp, delivery_time timestamp,"
        " delivery_duration_minutes decimal(8,2), delivery_status string" + _STAMPS
    ),
}
CALENDAR_START, CALENDAR_END = "2025-01-01", "2027-12-31"

# --- fixed values: run audit
AUDIT = struct(
    "run_id string, run_date date, load_type string, dataset string, stage string, status string,"
    " records_in long, records_out long, records_rejected long, quality_score decimal(5,2),"
    " started_at timestamp, finished_at timestamp, duration_seconds decimal(10,2),"
    " error_message string"
)
AUDIT_KEY = ("run_id", "dataset", "stage")
WHOLE_RUN = "_pipeline"
STAGES = (
    "ingestion",
    "validation",
    "transformation",
    "publish",
    "warehouse_load",
    "post_load_checks",
    "pipeline",
)
