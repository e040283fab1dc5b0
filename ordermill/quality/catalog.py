"""The rule catalogue: 34 rules, 32 of them errors and two warnings.

Rule numbers, columns and limits are fixed values of the data contract.
"""

from __future__ import annotations

from ordermill.model import ALLOWED, DATASETS
from ordermill.quality.rules import (
    WARN,
    ExistsIn,
    InRange,
    NotAfter,
    NotNull,
    OneOf,
    RequiredWhen,
    Rule,
    Unique,
    ValidTime,
)

CATALOG: dict[str, tuple[Rule, ...]] = {
    "customers": (
        NotNull("DQ-CUS-001", "customer_id"),
        Unique("DQ-CUS-002", "customer_id"),
        NotNull("DQ-CUS-003", "city"),
        ValidTime("DQ-CUS-004", "signup_date", not_future=True),
        NotNull("DQ-CUS-005", "email", severity=WARN),
    ),
    "restaurants": (
        NotNull("DQ-RES-001", "restaurant_id"),
        Unique("DQ-RES-002", "restaurant_id"),
        InRange("DQ-RES-003", "rating", low=0, high=5, optional=True),
    ),
    "delivery_partners": (
        NotNull("DQ-DPT-001", "delivery_partner_id"),
        Unique("DQ-DPT-002", "delivery_partner_id"),
        ValidTime("DQ-DPT-003", "joining_date"),
    ),
    "orders": (
        NotNull("DQ-ORD-001", "order_id"),
        Unique("DQ-ORD-002", "order_id"),
        NotNull("DQ-ORD-003", "customer_id"),
        ExistsIn("DQ-ORD-004", "customer_id", "customers"),
        ExistsIn("DQ-ORD-005", "restaurant_id", "restaurants"),
        InRange("DQ-ORD-006", "order_amount", low=0),
        OneOf("DQ-ORD-007", "order_status", ALLOWED["order_status"]),
        ValidTime("DQ-ORD-008", "order_date", not_future=True),
    ),
    "payments": (
        NotNull("DQ-PAY-001", "payment_id"),
        Unique("DQ-PAY-002", "payment_id"),
        ExistsIn("DQ-PAY-003", "order_id", "orders"),
        InRange("DQ-PAY-004", "payment_amount", low=0),
        OneOf("DQ-PAY-005", "payment_status", ALLOWED["payment_status"]),
        OneOf("DQ-PAY-006", "payment_method", ALLOWED["payment_method"]),
        ValidTime("DQ-PAY-007", "payment_date"),
    ),
    "delivery": (
        NotNull("DQ-DEL-001", "delivery_id"),
        Unique("DQ-DEL-002", "delivery_id"),
        ExistsIn("DQ-DEL-003", "order_id", "orders"),
        ExistsIn("DQ-DEL-004", "delivery_partner_id", "delivery_partners"),
        NotAfter("DQ-DEL-005", "pickup_time", "delivery_time"),
        OneOf("DQ-DEL-006", "delivery_status", ALLOWED["delivery_status"]),
        ValidTime("DQ-DEL-007", "pickup_time", also=("delivery_time",), optional=True),
        RequiredWhen(
            "DQ-DEL-008", "delivery_time", "delivery_status", "DELIVERED", severity=WARN
        ),
    ),
}

# Datasets of a wave do not refer to each other, only to earlier waves.
WAVES = (("customers", "restaurants", "delivery_partners"), ("orders",), ("payments", "delivery"))


def parents_of(dataset: str) -> tuple[str, ...]:
    """Datasets whose keys the rules of ``dataset`` look up, parents first."""
    named = {rule.parent for rule in CATALOG[dataset] if isinstance(rule, ExistsIn)}
    return tuple(name for name in DATASETS if name in named)
