"""Table shapes and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Columns of the raw tables.  Every column is nullable text, so codes keep their leading zeros.
RAW_ADDRESS = _strings(
    "AN8", "ALPH", "AT1", "PH1", "ADD1", "ADD2", "CTY1",
    "ADDS", "ADDZ", "COUN", "TAX", "PA8", "UPMJ", "UPMT",
)
RAW_ITEM = _strings("ITM", "DSC1", "DSC2", "STKT", "UOM1", "UOM2", "SRP1", "UPMJ", "UPMT")

UNIT_MAPPING_COLUMNS = ("source_code", "target_name", "category")
UNIT_MAPPING = _strings(*UNIT_MAPPING_COLUMNS)
UNIT_TARGET = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])

# Columns of the watermark state and the load log.
WATERMARK_STATE = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("last_upmj", T.LongType()),
    T.StructField("last_upmt", T.LongType()),
    T.StructField("last_run_at", T.TimestampType()),
    T.StructField("records_synced", T.LongType()),
])

LOAD_LOG = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("attempt_number", T.IntegerType()),
    T.StructField("an8", T.LongType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("run_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("target_id", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("record_name", T.StringType()),
    T.StructField("entity_type", T.StringType()),
])

# What the next batch has to know of an entity.
CURRENT_STATE = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("was_loaded", T.BooleanType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("existing_id", T.LongType()),
    T.StructField("last_hash", T.StringType()),
])

# Rows that a limited sync has read although the watermark has not passed them.
SEEN_ROWS = T.StructType([
    T.StructField("row_hash", T.StringType()),
    T.StructField("upmj", T.LongType()),
    T.StructField("upmt", T.LongType()),
])

CONFLICTS = T.StructType([
    T.StructField("entity_type", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("target_id", T.LongType()),
    T.StructField("change", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("last_hash", T.StringType()),
    T.StructField("run_at", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
])

# Transformed rows.  Names starting with "_" never reach the target system.
CUSTOMER_COLUMNS = [
    "_source_key", "name", "is_company", "customer_rank", "_source_type",
    "phone", "street", "street2", "city", "zip", "state_code", "country_code",
    "vat", "parent_key", "comment",
]
ITEM_COLUMNS = [
    "_source_key", "_source_type", "_source_unit1", "_source_unit2",
    "default_code", "name", "description", "type", "sale_ok", "purchase_ok",
    "uom_id", "uom_po_id", "list_price", "comment",
]
# Change time carried next to a transformed row: it defines the processing order.
CHANGE_COLUMNS = ["_upmj", "_upmt"]

# Target fields written on create.
PARTNER_FIELDS = [
    "name", "phone", "street", "street2", "city",
    "zip", "vat", "customer_rank", "is_company", "comment",
]
PRODUCT_FIELDS = ["name", "description", "type", "sale_ok", "purchase_ok", "list_price"]

# Preview columns, in file order.
PARTNER_PREVIEW = [
    "name", "phone", "street", "street2", "city", "zip", "state_code",
    "country_code", "vat", "customer_rank", "is_company", "parent_key", "comment",
]
PRODUCT_PREVIEW = [
    "default_code", "name", "description", "type", "sale_ok", "purchase_ok",
    "uom_id", "uom_po_id", "list_price", "comment",
]
FAILURE_COLUMNS = ["_source_key", "_failed_rule", "_failure_reason"]

# Fields that take part in the content hash.
PARTNER_HASH_FIELDS = [
    "name", "phone", "street", "street2", "city", "zip", "state_code",
    "country_code", "vat", "customer_rank", "is_company", "parent_key",
]
PRODUCT_HASH_FIELDS = [
    "name", "description", "type", "sale_ok", "purchase_ok",
    "uom_id", "uom_po_id", "list_price",
]

# Load statuses.
LOADED, SKIPPED, FAILED, NOT_PROCESSED = "LOADED", "SKIPPED", "FAILED", "NOT_PROCESSED"

# Conflict strategies and actions.
SOURCE_WINS, TARGET_WINS, FLAG = "SOURCE_WINS", "TARGET_WINS", "FLAG"
UPDATE, SKIP, NONE = "UPDATE", "SKIP", "NONE"
