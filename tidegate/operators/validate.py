"""Ordered rules, first failure wins: one rule id and one reason per rejected row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.keys import flag_duplicates
from tidegate.operators.units import with_unit_categories

# Fixed values.
ADDRESS_TYPES = ["C", "V", "E"]
STOCK_CODES = ["S", "N", "O"]
SERVICE_CATEGORIES = ["Unit", "Time", "Working Time", "Unit of Time"]
PHONE_PATTERN = r"\A(0[0-9]{9,10}|\+63[0-9]{9,11})\z"
DIGITS_PATTERN = r"\A[0-9]+\z"


@dataclass(frozen=True)
class Rule:
    """A row fails when ``fails`` is true; null counts as not failing."""

    id: str
    fails: Column
    reason: Column


def sentence(*parts: Column | str) -> Column:
    """Concatenate text and values; a null value reads as "null"."""
    return F.concat(*[
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null"))
        for p in parts
    ])


def missing(c: Column) -> Column:
    """Null or empty."""
    return c.isNull() | (c == "")


def not_in(c: Column, allowed: Sequence[str]) -> Column:
    """Not a member; null is not a member either."""
    return ~F.coalesce(c.isin(list(allowed)), F.lit(False))


def phone_is_valid(c: Column) -> Column:
    """Mobile or landline format.  Anchored so that a trailing newline does not pass."""
    return F.coalesce(c.rlike(PHONE_PATTERN), F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_failed_rule`` and ``_failure_reason``, both null on a valid row.  Narrow."""
    chain = F
    for rule in rules:
        outcome = F.struct(F.lit(rule.id).alias("rule"), rule.reason.alias("reason"))
        chain = chain.when(F.coalesce(rule.fails, F.lit(False)), outcome)
    return df.select(
        "*",
        chain["rule"].alias("_failed_rule"),
        chain["reason"].alias("_failure_reason"),
    )


def validate(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """Validate a batch: rules may use the boolean ``_duplicate``, true on every copy of
    a repeated key.  Duplicates are looked for within this batch only.
    """
    return apply_rules(flag_duplicates(df, keys), rules).drop("_duplicate")


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("_failed_rule").isNull()).drop("_failed_rule", "_failure_reason")


def failed_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("_failed_rule").isNotNull())


def customer_row_rules() -> list[Rule]:
    """Rules that look at one row only; also usable on a streaming DataFrame."""
    key, phone, zip_code = F.col("_source_key"), F.col("phone"), F.col("zip")
    kind = F.col("_source_type")
    return [
        Rule("RULE_03_NAME_REQUIRED", missing(F.col("name")),
             sentence("No name (ALPH) for AN8=", key)),
        Rule("RULE_04_INVALID_ADDRESS_TYPE", not_in(kind, ADDRESS_TYPES),
             sentence("AN8=", key, " has type '", kind, "'; allowed: C, V, E")),
        Rule("RULE_05_PHONE_MISSING", phone.isNull(),
             sentence("No phone (PH1) for AN8=", key)),
        Rule("RULE_05_PHONE_FORMAT", ~phone_is_valid(phone),
             sentence("Phone '", phone, "' of AN8=", key,
                      " is neither 09 + 9 digits nor a 0 / +63 landline")),
        Rule("RULE_06_ADDRESS_REQUIRED", missing(F.col("street")),
             sentence("No street (ADD1) for AN8=", key)),
        Rule("RULE_07_CITY_REQUIRED", missing(F.col("city")),
             sentence("No city (CTY1) for AN8=", key)),
        Rule("RULE_08_ZIP_FORMAT", zip_code.isNotNull() & ~zip_code.rlike(DIGITS_PATTERN),
             sentence("Postal code '", zip_code, "' of AN8=", key, " is not all digits")),
    ]


def customer_rules() -> list[Rule]:
    key = F.col("_source_key")
    return [
        Rule("RULE_01_AN8_REQUIRED", key.isNull(),
             sentence("AN8 is missing or not a whole number")),
        Rule("RULE_02_AN8_DUPLICATE", F.col("_duplicate"),
             sentence("AN8=", key, " occurs more than once; every copy is rejected")),
        *customer_row_rules(),
    ]


def item_rules() -> list[Rule]:
    """Item rules; unit rules use the columns added by ``with_unit_categories``."""
    key, stock, price = F.col("_source_key"), F.col("_source_type"), F.col("list_price")
    unit1, unit2 = F.col("_source_unit1"), F.col("_source_unit2")
    known1, known2 = F.col("_unit1_known"), F.col("_unit2_known")
    category1, category2 = F.col("_unit1_category"), F.col("_unit2_category")
    return [
        Rule("Rule01_ITMRequired", key.isNull(),
             sentence("ITM is missing or not a number")),
        Rule("Rule01_ITMRequired", key <= 0,
             sentence("ITM=", key, " is not positive")),
        Rule("Rule02_ITMDuplicate", F.col("_duplicate"),
             sentence("ITM=", key, " occurs more than once; every copy is rejected")),
        Rule("Rule03_NameRequired", missing(F.col("name")),
             sentence("No name (DSC1) for ITM=", key)),
        Rule("Rule04_InvalidSTKT", not_in(stock, STOCK_CODES),
             sentence("ITM=", key, " has stocking type '", stock, "'; allowed: S, N, O")),
        Rule("Rule05_UOM1Required", missing(unit1),
             sentence("No primary unit (UOM1) for ITM=", key)),
        Rule("Rule05_UOM1Required", ~known1,
             sentence("Primary unit '", unit1, "' of ITM=", key, " is not in the unit mapping")),
        Rule("Rule06_UOM2Invalid", (unit2 != "") & ~known2,
             sentence("Second unit '", unit2, "' of ITM=", key, " is not in the unit mapping")),
        Rule("Rule07_UOMCategoryMismatch", known2 & ~category1.eqNullSafe(category2),
             sentence("Units of ITM=", key, " differ in category: '", unit1, "' is ", category1,
                      ", '", unit2, "' is ", category2)),
        Rule("Rule08_NegativePrice", price < 0,
             sentence("Price ", price.cast("decimal(38,2)"), " of ITM=", key, " is negative")),
        Rule("Rule09_STKTUOMIncompatible",
             (stock == "O") & not_in(category1, SERVICE_CATEGORIES),
             sentence("Service ITM=", key, " has unit '", unit1, "' of category ", category1,
                      "; allowed: Unit, Time, Working Time, Unit of Time")),
    ]


def validate_customers(customers: DataFrame) -> DataFrame:
    return validate(customers, customer_rules(), ["_source_key"])


def validate_items(items: DataFrame, units: DataFrame) -> DataFrame:
    """``units`` is the resolved unit dimension (code, id, name, category)."""
    flagged = with_unit_categories(flag_duplicates(items, ["_source_key"]), units, counted=items)
    ruled = apply_rules(flagged, item_rules())
    return ruled.select(*items.columns, "_failed_rule", "_failure_reason")
