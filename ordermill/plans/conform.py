"""Validated records to conformed datasets, and the referential assertions between them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.errors import OrphanRecords
from ordermill.functions.values import minutes_between
from ordermill.model import ALLOWED, CONFORMED, KEY
from ordermill.operators.keyed import clean_text, conform, current_state, deduplicate
from ordermill.operators.lookup import attach, known_keys, lacking, orphan_total, orphans
from ordermill.plans import metrics
from ordermill.session import side_by_side

#: Keys that the error names; all go to ``report``.
SAMPLE_KEYS = 5

# child dataset, its column, parent dataset
REFERENCES = (
    ("orders", "customer_id", "customers"),
    ("orders", "restaurant_id", "restaurants"),
    ("payments", "order_id", "orders"),
    ("delivery", "order_id", "orders"),
    ("delivery", "delivery_partner_id", "delivery_partners"),
)


#: Columns that are made of source columns; the source's dates carry a time.
DERIVED = {
    "orders": {"order_timestamp": "order_date", "order_date": "to_date(order_date)"},
    "payments": {"payment_timestamp": "payment_date", "payment_date": "to_date(payment_date)"},
}
#: Datasets that need no other one.
FIRST = ("customers", "restaurants", "delivery_partners", "orders", "payments")


def conformed(
    dataset: str, validated: DataFrame, run_id: str, dates: DataFrame | None = None
) -> DataFrame:
    """Validated records as a conformed dataset: clean text, the first record of each key, derived
    columns, and amounts and ratings rounded half up by their types.

    Deliveries take their order's date from ``dates``, orders that are unique by ``order_id``.
    """
    rows = deduplicate(clean_text(validated, ALLOWED), KEY[dataset])
    made = {name: F.expr(text) for name, text in DERIVED.get(dataset, {}).items()}
    if dates is not None:
        rows = attach(rows, dates, "order_id", order_date="order_date")
        made["delivery_duration_minutes"] = minutes_between(
            F.col("pickup_time"), F.col("delivery_time")
        )
    made |= {"source_ingestion_date": F.col("_ingestion_date"), "_run_id": F.lit(run_id)}
    return conform(rows.withColumns(made), CONFORMED[dataset])


def process(
    validated: dict[str, DataFrame],
    earlier: dict[str, DataFrame | None],
    run_id: str,
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
    check: bool = False,
    report: Callable[[str, str, DataFrame], None] | None = None,
) -> dict[str, DataFrame]:
    """All eight processed datasets of a batch.

    ``earlier`` holds the processed history before the run date, of which only the keys that the batch
    refers to are ranked.  Payments and deliveries of the analytics come from this batch, dimensions
    from their current state.  Lazy unless ``keep`` writes datasets (later ones then read the written
    copies) or ``check`` asks for the reference assertions.  ``report`` then gets a child dataset, its column and
    all keys without a parent, with their numbers of records, before the batch is stopped.
    """

    def kept(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        if keep is None:
            return frames
        return dict(zip(frames, side_by_side([partial(keep, *x) for x in frames.items()]), strict=True))

    def looked_up(parent: str, child: DataFrame) -> DataFrame:
        return current_state(made[parent], earlier.get(parent), KEY[parent], child)

    made = kept({name: conformed(name, validated[name], run_id) for name in FIRST})
    dates = looked_up("orders", clean_text(validated["delivery"].select("order_id")))
    made |= kept({"delivery": conformed("delivery", validated["delivery"], run_id, dates)})
    if check:
        assert_references(made, earlier, report)
    parents = {name: looked_up(name, made["orders"]) for name in ("customers", "restaurants")}
    made |= kept({"order_analytics": metrics.order_analytics(made, parents, run_id)})
    daily = metrics.daily_order_metrics(made["order_analytics"], run_id)
    made |= kept({"daily_order_metrics": daily})
    return {name: made[name] for name in CONFORMED}


def assert_no_orphans(
    found: DataFrame,
    column: str,
    dataset: str,
    parent: str,
    report: Callable[[str, str, DataFrame], None] | None = None,
) -> None:
    """Stop when there are ``orphans``, naming the count and a few keys; ``report`` gets all."""
    sample = [row["key"] for row in found.orderBy("key").limit(SAMPLE_KEYS).collect()]
    if sample:
        if report is not None:
            report(dataset, column, found)
        count = found.agg(orphan_total()).first()["orphan_records"]
        raise OrphanRecords(
            f"{dataset} has records without a matching {parent}",
            column=column,
            orphan_count=count,
            sample_keys=sample,
        )


def assert_references(
    made: dict[str, DataFrame],
    earlier: dict[str, DataFrame | None],
    report: Callable[[str, str, DataFrame], None] | None = None,
) -> None:
    """All references of a batch resolve in the batch or its history.  Only keys are read for that,
    and the history's are narrowed to those that the batch's own parents lack."""

    def check(dataset: str, column: str, parent: str) -> None:
        batch, history = (df if df is None else df.select(KEY[parent]) for df in (made[parent], earlier.get(parent)))
        found = orphans(made[dataset], column, batch)
        if history is not None:
            found = lacking(found, "key", known_keys(found.select("key"), history))
        assert_no_orphans(found, column, dataset, parent, report)

    side_by_side([partial(check, *reference) for reference in REFERENCES])
