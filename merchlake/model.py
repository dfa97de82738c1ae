"""The five relations: schemas, keys, references, value rules and allowed statuses.

Audit, fail-fast check, load rejects and stored-table check all read their rules from
here, so a rule is written once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


TEXT, REAL, WHOLE, MOMENT = StringType(), DoubleType(), IntegerType(), TimestampType()

CUSTOMERS = _schema(
    ("customer_id", TEXT), ("name", TEXT), ("email", TEXT),
    ("created_at", MOMENT), ("signup_channel", TEXT),
)
PRODUCTS = _schema(
    ("product_id", TEXT), ("name", TEXT), ("category", TEXT), ("price", REAL), ("stock", WHOLE),
)
ORDERS = _schema(
    ("order_id", TEXT), ("customer_id", TEXT), ("product_id", TEXT), ("quantity", WHOLE),
    ("total_price", REAL), ("order_date", MOMENT), ("status", TEXT),
)
ORDER_ITEMS = _schema(
    ("item_id", TEXT), ("order_id", TEXT), ("product_id", TEXT), ("quantity", WHOLE),
    ("unit_price", REAL), ("total_price", REAL),
)
PAYMENTS = _schema(
    ("payment_id", TEXT), ("order_id", TEXT), ("payment_method", TEXT), ("amount", REAL),
    ("status", TEXT), ("payment_date", MOMENT),
)
REVIEWS = _schema(
    ("review_id", TEXT), ("customer_id", TEXT), ("product_id", TEXT), ("rating", WHOLE),
    ("review_text", TEXT), ("review_date", MOMENT),
)

# The statuses the audit accepts.
ORDER_STATUSES = ("Completed", "Pending", "Cancelled", "Shipped")
PAYMENT_STATUSES = ("Completed", "Pending", "Failed", "Refunded")

# Cell texts a raw CSV read treats as a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class ValueRule:
    """Values a numeric column must keep to.

    ``above``/``at_least`` exclude missing values from the audit count; ``within`` counts a
    missing value as an error. ``fail_fast`` says whether the fail-fast check applies it too.
    """

    check: str
    column: str
    above: float | None = None
    at_least: float | None = None
    within: tuple[float, float] | None = None
    fail_fast: bool = True


@dataclass(frozen=True)
class Relation:
    name: str
    schema: StructType
    key: str
    references: dict[str, str] = field(default_factory=dict)  # column -> parent relation
    rules: tuple[ValueRule, ...] = ()
    moment: str | None = None
    statuses: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


RELATIONS = {
    relation.name: relation
    for relation in (
        Relation("customers", CUSTOMERS, "customer_id", moment="created_at"),
        Relation(
            "products", PRODUCTS, "product_id",
            rules=(
                ValueRule("invalid_prices", "price", above=0),
                ValueRule("invalid_stock", "stock", at_least=0, fail_fast=False),
            ),
        ),
        Relation(
            "orders", ORDERS, "order_id",
            references={"customer_id": "customers", "product_id": "products"},
            rules=(
                ValueRule("invalid_quantities", "quantity", above=0),
                ValueRule("invalid_total_prices", "total_price", above=0),
            ),
            moment="order_date",
            statuses=ORDER_STATUSES,
        ),
        Relation(
            "payments", PAYMENTS, "payment_id",
            references={"order_id": "orders"},
            rules=(ValueRule("invalid_amounts", "amount", above=0),),
            moment="payment_date",
            statuses=PAYMENT_STATUSES,
        ),
        Relation(
            "reviews", REVIEWS, "review_id",
            references={"customer_id": "customers", "product_id": "products"},
            rules=(ValueRule("invalid_ratings", "rating", within=(1, 5)),),
            moment="review_date",
        ),
    )
}
