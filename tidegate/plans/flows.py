"""What is specific to one table; the run functions know nothing else about it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tidegate import schemas as S
from tidegate.functions import parse_decimal_key, parse_long
from tidegate.operators import load, report, transform, validate

Step = Callable[[DataFrame], DataFrame]

PARTNER_TARGET = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("street2", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("vat", T.StringType()),
    T.StructField("customer_rank", T.IntegerType()),
    T.StructField("is_company", T.BooleanType()),
    T.StructField("comment", T.StringType()),
    T.StructField("ref", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("version", T.LongType()),
])
PRODUCT_TARGET = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("sale_ok", T.BooleanType()),
    T.StructField("purchase_ok", T.BooleanType()),
    T.StructField("list_price", T.DoubleType()),
    T.StructField("default_code", T.StringType()),
    T.StructField("uom_id", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("version", T.LongType()),
])


@dataclass(frozen=True)
class TableFlow:
    """One migrated table.  A new table is a new instance, not new run code.

    ``payload`` maps rows that carry ``target_id`` to target rows that keep that column.  ``source_key`` makes of
    the raw ``key`` what ``transform`` makes of it.
    """

    table_name: str
    entity: str
    key: str
    raw_schema: T.StructType
    transform: Step
    validate: Step
    payload: Step
    target_schema: T.StructType
    ref: str
    hash_fields: list[str]
    preview: list[str]
    validated_columns: list[tuple[str, str]]
    failed_columns: list[tuple[str, str]]
    source_key: Callable[[Column], Column] = parse_long

    def describe(self) -> str:
        return f"{self.table_name} -> target_{self.entity}"


def customer_flow() -> TableFlow:
    return TableFlow(
        table_name="customers",
        entity="customer",
        key="AN8",
        raw_schema=S.RAW_ADDRESS,
        transform=transform.transform_customers,
        validate=validate.validate_customers,
        payload=lambda rows: load.partner_payload(rows, [*S.PARTNER_FIELDS, "target_id"]),
        target_schema=PARTNER_TARGET,
        ref="ref",
        hash_fields=S.PARTNER_HASH_FIELDS,
        preview=S.PARTNER_PREVIEW,
        validated_columns=report.CUSTOMER_VALIDATED,
        failed_columns=report.CUSTOMER_FAILED,
    )


def item_flow(units: DataFrame) -> TableFlow:
    """``units`` is the resolved unit dimension, shared by validation and payload."""
    return TableFlow(
        table_name="items",
        entity="item",
        key="ITM",
        raw_schema=S.RAW_ITEM,
        transform=transform.transform_items,
        validate=lambda rows: validate.validate_items(rows, units),
        payload=lambda rows: load.product_payload(rows, units, [*S.PRODUCT_FIELDS, "target_id"]),
        target_schema=PRODUCT_TARGET,
        ref="default_code",
        hash_fields=S.PRODUCT_HASH_FIELDS,
        preview=S.PRODUCT_PREVIEW,
        validated_columns=report.ITEM_VALIDATED,
        failed_columns=report.ITEM_FAILED,
        source_key=parse_decimal_key,
    )
