"""One query per operator."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidegate import functions as fn
from tidegate import schemas as S
from tidegate.catalog.oracle import ROW_RULES, cleaned, julian_date, number, oracle, phone, trimmed, whole
from tidegate.catalog.registry import Tables, query
from tidegate.operators import conflict, keys, load, report, units, validate, watermark
from tidegate.operators.transform import transform_customers, transform_items
from tidegate.plans import customer_flow, item_flow, run_sync
from tidegate.plans.runs import load_batch, new_run, report_tables
from tidegate.runtime import FILE_ROWS, materialize, scratch_path
from tidegate.sinks import StateStore, write_preview
from tidegate.sinks.files import write_csv
from tidegate.sources import NA_TOKENS, align_columns, bin_counter, incremental_scan, plan_ranges, read_csv, scan_csv
from tidegate.sources.tables import TABLES, alias_columns
from tidegate.streaming import start_sync, sync_epoch, validate_stream

CUSTOMER_LIST = ", ".join(S.CUSTOMER_COLUMNS)
ITEM_LIST = ", ".join(S.ITEM_COLUMNS)
MARK = (124150, 40000)


# Inputs shared by several queries.

def customers(t: Tables) -> DataFrame:
    return transform_customers(t("raw_address"))


def customer_results(t: Tables) -> DataFrame:
    return validate.validate_customers(customers(t))


def valid_customers(t: Tables) -> DataFrame:
    return validate.valid_rows(customer_results(t))


def landed_customers(t: Tables) -> DataFrame:
    """Valid customers, stored, from raw rows that are stored first: a source of few files is then worked on by many tasks."""
    raw = materialize(t("raw_address"), "raw", FILE_ROWS)
    return materialize(validate.valid_rows(validate.validate_customers(transform_customers(raw))), "valid")


def mapping(t: Tables) -> DataFrame:
    return units.clean_mapping(t("unit_mapping"), "pos")


def target_units(t: Tables) -> DataFrame:
    return units.first_target_units(t("unit_target"), "id")


def dimension(t: Tables) -> DataFrame:
    return units.build_dimension(mapping(t), target_units(t))


def items(t: Tables) -> DataFrame:
    return transform_items(t("raw_item"))


def item_results(t: Tables) -> DataFrame:
    return validate.validate_items(items(t), dimension(t))


def valid_items(t: Tables) -> DataFrame:
    return validate.valid_rows(item_results(t))


def log(t: Tables) -> DataFrame:
    return load.backfill_log(t("load_log"))


def load_state(t: Tables, entity: str, target: str, ref: str) -> tuple[DataFrame, DataFrame]:
    """(history, existing) of an entity, stored."""
    return (
        materialize(load.log_history(log(t), entity), "history"),
        materialize(load.target_ids(t(target), ref), "existing"),
    )


def outcomes(t: Tables, refused: bool = True) -> DataFrame:
    return load.plan_load(
        valid_customers(t),
        *load_state(t, "customer", "target_partner", "ref"),
        t("rejections") if refused else None,
    )


# Sources.

_TOKENS = ", ".join(f"'{x}'" for x in NA_TOKENS)


@query(oracle("SELECT " + ", ".join(
    f"CASE WHEN {f.name} NOT IN ({_TOKENS}) THEN {f.name} END AS {f.name}" for f in S.RAW_ADDRESS
) + " FROM {raw_address}"))
def scan_csv_full(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    write_csv(t("raw_address"), path)  # phone numbers of the sample end in line breaks
    return read_csv(t.spark, path, S.RAW_ADDRESS)


def quoted(*names: str) -> Column:
    """A CSV line of the columns, every value in quotes."""
    values = [F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')) for c in names]
    return F.concat(F.lit('"'), F.concat_ws('","', *values), F.lit('"'))


def write_lines(lines: DataFrame, header: Sequence[str], path: str) -> None:
    """One file per task with the header first; ``lines`` has one column ``value``."""
    spark = lines.sparkSession
    head = spark.range(1).select(F.lit(",".join(header)).alias("value"), F.lit(0).alias("_at"))
    whole = head.unionAll(lines.select("value", F.lit(1).alias("_at")))
    whole.repartition(1).sortWithinPartitions("_at").select("value").write.text(path)


@query(oracle("""
    SELECT AN8, nullif(ALPH, '') AS ALPH, nullif(PH1, '') AS PH1, CASE WHEN m = 2 THEN NULL ELSE nullif(COUN, '') END AS COUN
    FROM (SELECT *, coalesce(length(ALPH), 0) % 3 AS m FROM {raw_address}) s"""))
def scan_csv_headers(t: Tables) -> DataFrame:
    """Three files that name the same columns in three orders; the last lacks one."""
    root = scratch_path(t.spark, "csv-headers")
    orders = [["AN8", "ALPH", "PH1", "COUN"], ["COUN", "PH1", "ALPH", "AN8"], ["PH1", "TAX", "AN8", "ALPH"]]
    raw = t("raw_address").withColumn("_m", F.coalesce(F.length("ALPH"), F.lit(0)) % 3)
    for m, columns in enumerate(orders):
        write_lines(raw.where(F.col("_m") == m).select(quoted(*columns).alias("value")), columns, f"{root}/file={m}")
    return scan_csv(t.spark, root, S.RAW_ADDRESS).rows.select("AN8", "ALPH", "PH1", "COUN")


@query(oracle("""
    SELECT record, reason FROM (
      SELECT CASE m WHEN 1 THEN c_custkey || ',a,' || c_name || ',more' ELSE '"' || c_custkey || '"x,' || c_name END AS record,
             CASE m WHEN 1 THEN 'more fields than the header' ELSE 'text after a closing quote' END AS reason, m
      FROM (SELECT *, c_custkey % 7 AS m FROM {customer}) s) r WHERE m IN (1, 2)
    UNION ALL SELECT 'rows', cast(count(*) AS string) FROM {customer} WHERE c_custkey % 7 NOT IN (1, 2, 3)"""))
def scan_csv_rejects(t: Tables) -> DataFrame:
    """Records that do not fit their header, and the number of those that do; short ones and quoted breaks do."""
    key, m = F.col("c_custkey").cast("string"), F.col("c_custkey") % 7
    line = (
        F.when(m == 1, F.concat(key, F.lit(",a,"), F.col("c_name"), F.lit(",more")))
        .when(m == 2, F.concat(F.lit('"'), key, F.lit('"x,'), F.col("c_name")))
        .when(m == 3, F.lit(" "))
        .when(m == 4, F.concat(key, F.lit(',"two\n""lines"""')))
        .when(m == 5, key)
        .otherwise(F.concat(key, F.lit(',"a, b",'), F.col("c_name")))
    )
    path = scratch_path(t.spark, "csv-rejects")
    write_lines(t("customer").select(line.alias("value")), ["AN8", "ALPH", "PH1"], path)
    scan = scan_csv(t.spark, path, S.RAW_ADDRESS)
    good = scan.rows.agg(F.count(F.lit(1)).cast("string").alias("reason"))
    return scan.rejects.select("record", "reason").unionAll(good.select(F.lit("rows").alias("record"), "reason"))


@query(oracle(f"""
    SELECT {ITEM_LIST.replace('description', 'NULL::varchar AS description')} FROM {{items}}"""))
def missing_column_tolerance(t: Tables) -> DataFrame:
    narrow = t("raw_item").drop("DSC2").withColumn("EXTRA", F.lit("ignored"))
    return transform_items(align_columns(narrow, S.RAW_ITEM)).select(*S.ITEM_COLUMNS)


@query(oracle("""
    SELECT count(*) AS rows, count(DISTINCT AN8) AS keys, 0 AS in_two_ranges, true AS even FROM {raw_address}"""))
def range_planned_scan(t: Tables) -> DataFrame:
    """All rows by ranges of a skewed key: half of the keys are crowded into a thousandth of the span."""
    key = fn.parse_long(F.col("AN8"))
    raw = t("raw_address").withColumn("k", F.when(key % 2 == 0, key * 1000).otherwise(key)).withColumn("_at", F.monotonically_increasing_id())
    raw = materialize(raw, "database")
    low, high = raw.agg(F.min("k"), F.max("k")).first()
    readers = 8
    ranges = plan_ranges(bin_counter(raw, "k"), low, high, readers)
    scans = [raw.where(r.condition("k")).select("AN8", "_at", F.lit(i).alias("reader")) for i, r in enumerate(ranges)]
    read = reduce(DataFrame.unionAll, scans)
    depth = read.where("AN8 IS NOT NULL").groupBy("reader").count().agg(F.max("count").alias("deepest"))
    return read.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("AN8").alias("keys"),
        (F.count(F.lit(1)) - F.count_distinct("_at")).cast("int").alias("in_two_ranges"),
    ).crossJoin(depth).select(
        "rows", "keys", "in_two_ranges", (F.col("deepest") <= 2 * F.ceil(F.col("rows") / readers)).alias("even"))


def prefixed_address(t: Tables) -> DataFrame:
    """The raw table as a database keeps it: prefixed names, numeric change time."""
    source = TABLES["customers"]
    numeric = ("UPMJ", "UPMT")
    raw = t("raw_address")
    return materialize(raw.select(*[
        (fn.parse_long(F.col(c)) if c in numeric else F.col(c)).alias(source.column(c))
        for c in raw.columns
    ]), "database")


_ALIASED = ", ".join(
    f"cast({whole(f.name)} AS varchar) AS {f.name}" if f.name in ("UPMJ", "UPMT") else f.name
    for f in S.RAW_ADDRESS
)


@query(oracle(f"SELECT {_ALIASED} FROM {{raw_address}}"))
def scan_aliased_full(t: Tables) -> DataFrame:
    return alias_columns(prefixed_address(t), "customers")


@query(oracle(f"""
    SELECT {_ALIASED} FROM {{raw_address}}
    WHERE ({whole('UPMJ')}, {whole('UPMT')}) > {MARK}
      AND {whole('UPMJ')} IS NOT NULL
      AND ({whole('UPMJ')} > {MARK[0]} OR {whole('UPMT')} IS NOT NULL)"""))
def scan_aliased_incremental(t: Tables) -> DataFrame:
    return incremental_scan(prefixed_address(t), "customers", *MARK)


@query(oracle("SELECT code, target_name, category FROM {mapping}"))
def uom_mapping_clean(t: Tables) -> DataFrame:
    return mapping(t)


@query(oracle("SELECT id, name FROM {target_units}"))
def uom_target_dedup(t: Tables) -> DataFrame:
    return target_units(t)


# Filters.

@query(oracle(f"""
    SELECT AN8, UPMJ, UPMT FROM {{raw_address}}
    WHERE NOT coalesce({whole('UPMJ')} < {MARK[0]}
                       OR ({whole('UPMJ')} = {MARK[0]} AND {whole('UPMT')} <= {MARK[1]}), false)
       OR {whole('UPMJ')} IS NULL OR {whole('UPMT')} IS NULL"""))
def watermark_filter_failopen(t: Tables) -> DataFrame:
    rows = watermark.with_change_time(t("raw_address"))
    return watermark.after_watermark(rows, *MARK).select("AN8", "UPMJ", "UPMT")


@query(oracle(f"""
    SELECT AN8, UPMJ, UPMT FROM
      (SELECT *, {whole('UPMJ')} AS d, {whole('UPMT')} AS s FROM {{raw_address}}) r
    WHERE d > {MARK[0]} OR (d = {MARK[0]} AND s > {MARK[1]})"""))
def watermark_filter_strict(t: Tables) -> DataFrame:
    rows = watermark.with_change_time(t("raw_address"))
    return watermark.after_watermark(rows, *MARK, keep_unknown=False).select("AN8", "UPMJ", "UPMT")


@query(oracle("""
    SELECT AN8, PH1, coalesce(
        regexp_full_match(PH1, '09[0-9]{9,9}|[+]639[0-9]{9,9}')
        OR regexp_full_match(PH1, '0[0-9]{9,10}|[+]63[0-9]{9,11}'), false) AS valid
    FROM {raw_address}"""))
def phone_format_check(t: Tables) -> DataFrame:
    return t("raw_address").select(
        "AN8", "PH1", validate.phone_is_valid(F.col("PH1")).alias("valid")
    )


# Scalar functions.

@query(oracle(f"SELECT AN8, {cleaned('ALPH')} AS cleaned FROM {{raw_address}}"))
def fn_clean_string(t: Tables) -> DataFrame:
    return t("raw_address").select("AN8", fn.clean_string(F.col("ALPH")).alias("cleaned"))


@query(oracle(f"SELECT AN8, {whole('AN8')} AS parsed FROM {{raw_address}}"))
def fn_parse_key(t: Tables) -> DataFrame:
    return t("raw_address").select("AN8", fn.parse_long(F.col("AN8")).alias("parsed"))


@query(oracle(f"SELECT ITM, cast(trunc({number('ITM')}) AS bigint) AS parsed FROM {{raw_item}}"))
def fn_parse_item_key(t: Tables) -> DataFrame:
    return t("raw_item").select("ITM", fn.parse_decimal_key(F.col("ITM")).alias("parsed"))


@query(oracle(f"SELECT ITM, SRP1, {number('SRP1')} AS price FROM {{raw_item}}"))
def fn_parse_price(t: Tables) -> DataFrame:
    return t("raw_item").select("ITM", "SRP1", fn.parse_number(F.col("SRP1")).alias("price"))


@query(oracle(f"SELECT AN8, PH1, {phone('PH1')} AS phone FROM {{raw_address}}"))
def fn_normalize_phone(t: Tables) -> DataFrame:
    return t("raw_address").select("AN8", "PH1", fn.normalize_phone(F.col("PH1")).alias("phone"))


@query(oracle(f"""
    SELECT AN8, UPMJ, strftime({julian_date('j')}, '%Y-%m-%d') AS changed_on
    FROM (SELECT AN8, UPMJ, {whole('UPMJ')} AS j FROM {{raw_address}}) r"""))
def fn_julian_to_date(t: Tables) -> DataFrame:
    day = fn.julian_to_date(fn.parse_long(F.col("UPMJ")))
    return t("raw_address").select(
        "AN8", "UPMJ", F.date_format(day, "yyyy-MM-dd").alias("changed_on")
    )


@query("""
    SELECT event_id,
           cast(strftime(ts, '%Y') AS bigint) * 1000 - 1900000 + cast(strftime(ts, '%j') AS bigint)
             AS upmj,
           cast(date_diff('second', date_trunc('day', ts), date_trunc('second', ts)) AS bigint)
             AS upmt
    FROM events""")
def fn_date_to_julian(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t("events").select(
        "event_id", fn.date_to_julian(ts).alias("upmj"), fn.seconds_of_day(ts).alias("upmt")
    )


@query(oracle("SELECT entity_id, content_hash FROM {customer_hashes}"))
def content_hash(t: Tables) -> DataFrame:
    rows = load.with_entity_id(valid_customers(t))
    return rows.select(
        "entity_id", fn.content_hash(rows, S.PARTNER_HASH_FIELDS).alias("content_hash")
    )


# Projections.

@query(oracle(f"SELECT {CUSTOMER_LIST} FROM {{customers}}"))
def customer_transform(t: Tables) -> DataFrame:
    return customers(t).select(*S.CUSTOMER_COLUMNS)


@query(oracle(f"SELECT {ITEM_LIST} FROM {{items}}"))
def item_transform(t: Tables) -> DataFrame:
    return items(t).select(*S.ITEM_COLUMNS)


@query(oracle(f"""
    SELECT {', '.join(S.PARTNER_FIELDS)}, cast(_source_key AS varchar) AS ref
    FROM {{valid_customers}}"""))
def partner_payload(t: Tables) -> DataFrame:
    return load.partner_payload(valid_customers(t), S.PARTNER_FIELDS)


@query(oracle("""
    SELECT name, description, type, sale_ok, purchase_ok, list_price, default_code,
           unit1_id AS uom_id FROM {valid_items}"""))
def product_payload(t: Tables) -> DataFrame:
    return load.product_payload(valid_items(t), dimension(t), S.PRODUCT_FIELDS)


# Validation.

@query(oracle("SELECT _source_key, _failed_rule FROM {customer_results}"))
def customer_validate(t: Tables) -> DataFrame:
    return customer_results(t).select("_source_key", "_failed_rule")


@query(oracle("SELECT _source_key, _failed_rule FROM {item_results}"))
def item_validate(t: Tables) -> DataFrame:
    return item_results(t).select("_source_key", "_failed_rule")


@query(oracle(f"SELECT {CUSTOMER_LIST} FROM {{valid_customers}}"))
def customer_valid(t: Tables) -> DataFrame:
    return valid_customers(t).select(*S.CUSTOMER_COLUMNS)


@query(oracle("""
    SELECT _source_key, name, phone, street, city, _failed_rule, _failure_reason
    FROM {customer_reasons} WHERE _failed_rule IS NOT NULL"""))
def customer_failed(t: Tables) -> DataFrame:
    return validate.failed_rows(customer_results(t)).select(
        "_source_key", "name", "phone", "street", "city", "_failed_rule", "_failure_reason"
    )


@query(oracle(f"SELECT {ITEM_LIST} FROM {{valid_items}}"))
def item_valid(t: Tables) -> DataFrame:
    return valid_items(t).select(*S.ITEM_COLUMNS)


@query(oracle("""
    SELECT _source_key, name, _failed_rule, CASE
        WHEN _source_key IS NULL THEN 'ITM is missing or not a number'
        WHEN _source_key <= 0 THEN format('ITM={} is not positive', _source_key)
        WHEN _failed_rule = 'Rule02_ITMDuplicate'
          THEN format('ITM={} occurs more than once; every copy is rejected', _source_key)
        WHEN _failed_rule = 'Rule03_NameRequired' THEN format('No name (DSC1) for ITM={}', _source_key)
        WHEN _failed_rule = 'Rule04_InvalidSTKT'
          THEN format('ITM={} has stocking type ''{}''; allowed: S, N, O', _source_key, _source_type)
        WHEN _failed_rule = 'Rule05_UOM1Required' AND _source_unit1 = ''
          THEN format('No primary unit (UOM1) for ITM={}', _source_key)
        WHEN _failed_rule = 'Rule05_UOM1Required'
          THEN format('Primary unit ''{}'' of ITM={} is not in the unit mapping', _source_unit1,
                      _source_key)
        WHEN _failed_rule = 'Rule06_UOM2Invalid'
          THEN format('Second unit ''{}'' of ITM={} is not in the unit mapping', _source_unit2,
                      _source_key)
        WHEN _failed_rule = 'Rule07_UOMCategoryMismatch'
          THEN format('Units of ITM={} differ in category: ''{}'' is {}, ''{}'' is {}', _source_key,
                      _source_unit1, category1, _source_unit2, category2)
        WHEN _failed_rule = 'Rule08_NegativePrice'
          THEN format('Price {} of ITM={} is negative', cast(cast(list_price AS decimal(38, 2)) AS varchar),
                      _source_key)
        ELSE format('Service ITM={} has unit ''{}'' of category {}; allowed: '
                    'Unit, Time, Working Time, Unit of Time', _source_key, _source_unit1, category1)
        END AS _failure_reason
    FROM {item_results} WHERE _failed_rule IS NOT NULL"""))
def item_failed(t: Tables) -> DataFrame:
    return validate.failed_rows(item_results(t)).select(
        "_source_key", "name", "_failed_rule", "_failure_reason"
    )


_LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("""
    SELECT l_orderkey, l_linenumber, CASE
        WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'LINE_01_DUPLICATE'
        WHEN l_quantity > 45 THEN 'LINE_02_QUANTITY'
        WHEN l_discount + l_tax > 0.15 THEN 'LINE_03_RATES'
        WHEN l_returnflag NOT IN ('A', 'N') THEN 'LINE_04_RETURN' END AS failed_rule
    FROM lineitem""")
def lineitem_validate(t: Tables) -> DataFrame:
    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    key = validate.sentence(F.col("l_orderkey"), "/", F.col("l_linenumber"))
    rules = [
        validate.Rule("LINE_01_DUPLICATE", F.col("_duplicate"), key),
        validate.Rule("LINE_02_QUANTITY", quantity > 45, key),
        validate.Rule("LINE_03_RATES", F.col("l_discount") + F.col("l_tax") > 0.15, key),
        validate.Rule("LINE_04_RETURN", validate.not_in(flag, ["A", "N"]), key),
    ]
    return validate.validate(t("lineitem"), rules, _LINE_KEY).select(
        *_LINE_KEY, F.col("_failed_rule").alias("failed_rule")
    )


# Joins and lookups.

@query(oracle("""
    SELECT i._source_key, i.uom_id, u.id AS unit_id, u.name AS unit_name, u.category AS unit_category
    FROM {items} i JOIN {units} u ON u.code = i.uom_id"""))
def uom_resolve(t: Tables) -> DataFrame:
    found = units.resolve_units(items(t), dimension(t)).where(F.col("_unit_id").isNotNull())
    return found.select(
        "_source_key", "uom_id", F.col("_unit_id").alias("unit_id"),
        F.col("_unit_name").alias("unit_name"), F.col("_unit_category").alias("unit_category"),
    )


@query(oracle("""
    SELECT _source_key, _source_unit1, _source_unit2, known1, known2, category1, category2
    FROM {item_results}"""))
def item_uom_flags(t: Tables) -> DataFrame:
    return units.with_unit_categories(items(t), dimension(t)).select(
        "_source_key", "_source_unit1", "_source_unit2",
        *[F.col(f"_unit{n}_known").alias(f"known{n}") for n in "12"],
        *[F.col(f"_unit{n}_category").alias(f"category{n}") for n in "12"],
    )


@query(oracle("SELECT code, id, name, category FROM {units}"))
def uom_registry_build(t: Tables) -> DataFrame:
    return dimension(t)


_UNRESOLVED = oracle("""
    SELECT code, target_name FROM {bad_mapping}
    WHERE target_name NOT IN (SELECT name FROM {target_units})""")


def bad_mapping(t: Tables) -> DataFrame:
    return units.clean_mapping(t("unit_mapping_bad"), "pos")


@query(_UNRESOLVED)
def uom_registry_unresolved(t: Tables) -> DataFrame:
    return units.unresolved_mapping(bad_mapping(t), target_units(t))


@query(_UNRESOLVED)
def uom_registry_abort(t: Tables) -> DataFrame:
    """The table of codes that a refused build leaves behind."""
    try:
        units.build_dimension(bad_mapping(t), target_units(t))
    except units.UnresolvedUnits as error:
        return t.spark.read.parquet(error.path)
    raise AssertionError("a mapping with unresolved names was accepted")


@query(oracle("""
    SELECT entity_id, name FROM {customer_queue} WHERE done"""))
def load_skipped(t: Tables) -> DataFrame:
    return load.skipped(valid_customers(t), log(t), "customer").select("entity_id", "name")


@query(oracle("""
    SELECT entity_id, name FROM {customer_queue} WHERE NOT done"""))
def load_worklist(t: Tables) -> DataFrame:
    return load.worklist(valid_customers(t), log(t), "customer").select("entity_id", "name")


@query(oracle("SELECT entity_id, existing_id FROM {customer_queue}"))
def load_exists_in_target(t: Tables) -> DataFrame:
    return load.existing_in_target(valid_customers(t), t("target_partner"), "ref").select(
        "entity_id", "existing_id"
    )


@query(oracle(f"""
    SELECT v._source_key, v.parent_key, p.id AS parent_target_id
    FROM {{valid_customers}} v
    LEFT JOIN {{partners}} p ON p.ref = cast({whole('v.parent_key')} AS varchar)"""))
def parent_resolution(t: Tables) -> DataFrame:
    ids = load.target_ids(t("target_partner"), "ref").withColumnRenamed("existing_id", "target_id")
    return load.resolve_parents(valid_customers(t), ids).select(
        "_source_key", "parent_key", "parent_target_id"
    )


@query("""
    SELECT o_orderkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_lines(t: Tables) -> DataFrame:
    # Distinct first: an order with very many lines sends one row per map task.
    lines = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t("orders").select("o_orderkey").join(lines, "o_orderkey", "left_anti")


# Aggregations.

@query(oracle("""
    SELECT _source_key, count(*) AS n FROM {customers}
    WHERE _source_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""))
def duplicate_keys(t: Tables) -> DataFrame:
    return keys.duplicate_keys(customers(t), ["_source_key"])


@query(oracle("""
    SELECT c._source_key, c.name FROM {customers} c WHERE c._source_key IN
      (SELECT _source_key FROM {customers} GROUP BY 1 HAVING count(*) > 1)"""))
def duplicate_key_rows(t: Tables) -> DataFrame:
    flagged = keys.flag_duplicates(customers(t), ["_source_key"])
    return flagged.where("_duplicate").select("_source_key", "name")


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def lineitem_duplicate_keys(t: Tables) -> DataFrame:
    return keys.duplicate_keys(t("lineitem"), _LINE_KEY)


@query(oracle("""
    SELECT code FROM (SELECT _source_unit1 AS code FROM {items}
                      UNION SELECT _source_unit2 FROM {items}) c
    WHERE code <> '' AND code NOT IN (SELECT code FROM {units})"""))
def unknown_uom_codes(t: Tables) -> DataFrame:
    return units.unknown_codes(items(t), dimension(t))


@query(oracle("SELECT DISTINCT code FROM {units} ORDER BY code"))
def uom_known_codes(t: Tables) -> DataFrame:
    return units.known_codes(dimension(t))


@query(oracle(f"""
    SELECT d AS last_upmj, s AS last_upmt FROM (
      SELECT CASE WHEN coalesce(UPMJ, '') = '' THEN 0 ELSE {whole('UPMJ')} END AS d,
             CASE WHEN coalesce(UPMT, '') = '' THEN 0 ELSE {whole('UPMT')} END AS s
      FROM {{raw_address}} UNION ALL SELECT {MARK[0]}, {MARK[1]}) r
    WHERE d IS NOT NULL AND s IS NOT NULL ORDER BY d DESC, s DESC LIMIT 1"""))
def watermark_compute(t: Tables) -> DataFrame:
    return watermark.latest_change(t("raw_address"), *MARK)


@query(oracle("SELECT total, loaded, failed, not_processed, skipped FROM {load_tally}"))
def load_summary(t: Tables) -> DataFrame:
    return load.load_summary(outcomes(t))


@query(oracle("SELECT entity_id, cast(attempt_number AS int) AS attempt_number FROM {customer_queue}"))
def load_attempt_numbers(t: Tables) -> DataFrame:
    return load.attempt_numbers(valid_customers(t), log(t), "customer").select(
        "entity_id", "attempt_number"
    )


@query(oracle("SELECT entity_id, target_id FROM {latest_ids}"))
def historical_ids(t: Tables) -> DataFrame:
    return load.historical_ids(log(t), "customer")


@query(oracle("""
    SELECT count(*) AS extracted, count(*) FILTER (_failed_rule IS NULL) AS valid,
           count(_failed_rule) AS failed,
           count(*) FILTER (_failed_rule IS NULL) * 100.0::double / count(*) AS valid_percent
    FROM {customer_results}"""))
def run_counts(t: Tables) -> DataFrame:
    return report.run_counts(customer_results(t))


@query(oracle("""
    SELECT _failed_rule AS failed_rule, count(*) AS rows FROM {customer_results}
    WHERE _failed_rule IS NOT NULL GROUP BY 1"""))
def failures_by_rule(t: Tables) -> DataFrame:
    return report.failures_by_rule(customer_results(t))


# Windows, order, limits.

@query(oracle(f"""
    SELECT row_number() OVER (ORDER BY first) AS id, name FROM (
      SELECT {trimmed('target_name')} AS name, min(pos) AS first FROM {{unit_mapping}} GROUP BY 1) n"""))
def uom_offline_dimension(t: Tables) -> DataFrame:
    return units.offline_target_units(t("unit_mapping"), "pos")


@query(oracle("""
    SELECT entity_id, status, error FROM {customer_outcomes}
    WHERE status IN ('FAILED', 'NOT_PROCESSED')"""))
def load_stop_on_failure(t: Tables) -> DataFrame:
    return outcomes(t).where(F.col("status").isin(S.FAILED, S.NOT_PROCESSED)).select(
        "entity_id", "status", "error"
    )


@query(oracle("""
    SELECT * FROM (SELECT change_key, upmj, upmt FROM {change_feed}
                   ORDER BY upmj NULLS FIRST, upmt NULLS FIRST, change_key LIMIT 500) f"""))
def first_n_changes(t: Tables) -> DataFrame:
    return watermark.first_changes(t("change_feed"), ["upmj", "upmt", "change_key"], 500)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000")
def orders_first_n(t: Tables) -> DataFrame:
    first = watermark.first_changes(t("orders"), ["o_orderdate", "o_orderkey"], 1000)
    return first.select("o_orderkey", "o_custkey")


# Watermark state.

_LATEST = """
    SELECT table_name, last_upmj, last_upmt, records_synced FROM (
      SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY last_run_at DESC) AS place
      FROM {watermark_state}) s WHERE place = 1"""


@query(oracle(f"""
    SELECT 'table_' || cast(c_custkey AS varchar) AS table_name,
           coalesce(last_upmj, 0) AS last_upmj, coalesce(last_upmt, 0) AS last_upmt,
           coalesce(records_synced, 0) AS records_synced
    FROM customer LEFT JOIN ({_LATEST}) w
      ON w.table_name = 'table_' || cast(c_custkey AS varchar)"""))
def watermark_current(t: Tables) -> DataFrame:
    names = t("customer").select(
        F.concat(F.lit("table_"), F.col("c_custkey").cast("string")).alias("table_name")
    )
    return watermark.current_watermark(t("watermark_state"), names).drop("last_run_at")


@query(oracle(_LATEST + " ORDER BY table_name"))
def watermark_all(t: Tables) -> DataFrame:
    return watermark.latest_per_table(t("watermark_state")).drop("last_run_at").orderBy("table_name")


@query(oracle(f"""
    SELECT table_name, last_upmj, last_upmt, records_synced FROM {{watermark_news}}
    UNION ALL
    SELECT * FROM ({_LATEST}) w WHERE table_name NOT IN (SELECT table_name FROM {{watermark_news}})"""))
def watermark_upsert(t: Tables) -> DataFrame:
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    columns = S.WATERMARK_STATE.names
    store.append_watermark(align_columns(t("watermark_state"), S.WATERMARK_STATE).select(*columns))
    store.append_watermark(align_columns(t("watermark_news"), S.WATERMARK_STATE).select(*columns))
    return watermark.latest_per_table(store.watermarks()).drop("last_run_at")


_ADVANCE = f"""
    SELECT run, CASE WHEN failed = 0 THEN 124200 ELSE {MARK[0]} END AS last_upmj,
           failed = 0 AS advanced FROM {{summaries}}"""


@query(oracle(_ADVANCE))
def watermark_advance_decision(t: Tables) -> DataFrame:
    advanced = load.may_advance(F.col("failed"))
    return t("summaries").select(
        "run", F.when(advanced, 124200).otherwise(MARK[0]).alias("last_upmj"),
        advanced.alias("advanced"),
    )


@query(oracle("""
    SELECT run, loaded, failed, not_processed, skipped,
           CASE WHEN failed > 0 AND not_processed > 0 THEN 'PARTIAL' WHEN failed > 0 THEN 'FAILED'
                WHEN skipped > 0 THEN 'SUCCESS_WITH_SKIPS' ELSE 'SUCCESS' END AS outcome,
           CASE WHEN failed > 0 THEN 1 ELSE 0 END AS exit_code FROM {summaries}"""))
def run_outcome(t: Tables) -> DataFrame:
    return load.run_outcome(t("summaries").drop("total"))


@query("""
    SELECT event_id, user_id FROM events
    WHERE ts IS NULL OR strftime(ts, '%Y-%m-%d %H:%M:%S') > '2024-01-20 12:00:00'""")
def events_incremental(t: Tables) -> DataFrame:
    rows = watermark.after_watermark_moment(t("events"), "ts", 124020, 43200)
    return rows.select("event_id", "user_id")


@query("""
    SELECT cast(strftime(m, '%Y') AS bigint) * 1000 - 1900000 + cast(strftime(m, '%j') AS bigint)
             AS last_upmj,
           cast(date_diff('second', date_trunc('day', m), date_trunc('second', m)) AS bigint)
             AS last_upmt
    FROM (SELECT max(ts) AS m FROM events) e""")
def events_watermark(t: Tables) -> DataFrame:
    ts = F.col("ts")
    rows = t("events").select(
        fn.date_to_julian(ts).alias("d"), fn.seconds_of_day(ts).alias("s")
    )
    return watermark.latest_change(rows, 0, 0, "d", "s")


# Idempotent load.

@query(oracle("""
    SELECT entity_id, name, status, target_id, error, created,
           cast(attempt_number AS int) AS attempt_number FROM {customer_outcomes}"""))
def load_outcomes(t: Tables) -> DataFrame:
    return outcomes(t).select(
        "entity_id", "name", "status", "target_id", "error", "created", "attempt_number"
    )


@query(oracle("""
    SELECT cast(v._source_key AS varchar) AS entity_id, v.name,
           CASE WHEN l.entity_id IS NOT NULL THEN 'SKIPPED' ELSE 'LOADED' END AS status,
           CASE WHEN l.entity_id IS NULL THEN p.id END AS target_id,
           l.entity_id IS NULL AND p.id IS NULL AS created
    FROM {valid_items} v
    LEFT JOIN {loaded_items} l ON l.entity_id = v.default_code
    LEFT JOIN {products} p ON p.ref = v.default_code"""))
def item_load_outcomes(t: Tables) -> DataFrame:
    planned = load.plan_load(
        valid_items(t), *load_state(t, "item", "target_product", "default_code")
    )
    return planned.select("entity_id", "name", "status", "target_id", "created")


@query(oracle("SELECT entity_id, name, new_id AS target_id FROM {customer_created}"))
def load_apply_created(t: Tables) -> DataFrame:
    # Sorting by range samples its input first, so the plan is stored before.
    planned = materialize(outcomes(t, refused=False), "plan")
    return load.assign_target_ids(planned, t("target_partner")).select(
        "entity_id", "name", "target_id"
    )


_BATCHES = 3


@query(oracle("""
    SELECT log_id, 'customer' AS entity_type, entity_id, cast(attempt_number AS int) AS attempt_number,
           _source_key AS an8, status, target_id, error, name AS record_name
    FROM (SELECT *, row_number() OVER (ORDER BY _source_key % """ + str(_BATCHES) + """, _upmj NULLS FIRST, _upmt NULLS FIRST, _source_key)
            AS log_id FROM {customer_outcomes} WHERE status <> 'SKIPPED') s"""))
def load_log_rows(t: Tables) -> DataFrame:
    """The log of three commits: ids go on from one to the next without gaps."""
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    planned = materialize(outcomes(t), "outcomes")
    for part in range(_BATCHES):
        rows = planned.where(F.pmod("_source_key", F.lit(_BATCHES)) == part)
        commit = store.begin(f"batch {part}")
        high = commit.high("load_log")
        logged = materialize(load.log_rows(
            rows, "customer", "batch", F.lit("2024-02-01 00:00:00").cast("timestamp"), high), "log")
        commit.append("load_log", logged, "entity_id", S.LOAD_LOG, high + logged.count())
        commit.publish()
        # Rows that no commit publishes leave no gap.
        store.begin("lost").append("load_log", logged, "entity_id", S.LOAD_LOG, high + 1_000_000)
    return store.load_log().select(
        "log_id", "entity_type", "entity_id", "attempt_number", "an8", "status", "target_id", "error",
        "record_name",
    )


@query(oracle("SELECT log_id, entity_id, entity_type, status FROM {log}"))
def load_log_backfill(t: Tables) -> DataFrame:
    return log(t).select("log_id", "entity_id", "entity_type", "status")


@query(oracle("""
    SELECT 1 AS run, 'LOADED' AS status, count(*) AS rows FROM {valid_customers}
    UNION ALL SELECT 2, 'SKIPPED', count(*) FROM {valid_customers}
    UNION ALL SELECT 3, 'IN TARGET', count(*) FROM {valid_customers}"""))
def load_rerun_idempotent(t: Tables) -> DataFrame:
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    flow = customer_flow()
    valid = landed_customers(t)
    tallies = []
    for run in (1, 2):
        results, _ = load_batch(flow, valid, store, *new_run())
        tallies.append(results.groupBy(F.lit(run).alias("run"), "status").count())
    target = store.target(flow.entity, flow.target_schema)
    tallies.append(target.groupBy(F.lit(3).alias("run"), F.lit("IN TARGET").alias("status")).count())
    return reduce(DataFrame.unionByName, tallies).withColumnRenamed("count", "rows")


@query(oracle("""
    SELECT cast(_source_key AS varchar) AS ref, name FROM {valid_customers}
    UNION ALL SELECT 'limited runs', cast(3 AS varchar)"""))
def sync_limit_unknown_times(t: Tables) -> DataFrame:
    """Two limited runs and a last one for the rest; a source without any readable change time comes to an end."""
    store, flow = StateStore(t.spark, scratch_path(t.spark, "state")), customer_flow()
    raw = materialize(t("raw_address").withColumn("UPMJ", F.when(F.length("AN8") > 3, F.lit("soon"))), "raw")
    limit, runs = raw.count() // 2 + 1, 0
    while run_sync(flow, raw, store, limit=limit).outcome != "NO_OP":
        runs += 1
    target = store.current_target(flow.entity, flow.target_schema).select("ref", "name")
    return target.unionAll(t.spark.range(1).select(
        F.lit("limited runs").alias("ref"), F.lit(str(runs + 1)).alias("name")))


class Cut(Exception):
    """A run that ends in the middle of its writes."""


@query(oracle("""
    SELECT cast(_source_key AS varchar) AS entity_id, id, id AS log_id, 1 AS attempt_number, true AS hashed, 124300 AS last_upmj
    FROM (SELECT *, row_number() OVER (ORDER BY _upmj NULLS FIRST, _upmt NULLS FIRST, _source_key) AS id
          FROM {valid_customers}) v"""))
def load_cut_and_replayed(t: Tables) -> DataFrame:
    """A batch cut before its first write, before its second, and so on, then run whole: as if never cut."""
    root, flow = scratch_path(t.spark, "state"), customer_flow()
    valid = landed_customers(t)
    for writes in (0, 1, 2, 3, 4, None):
        left = iter(range(writes)) if writes is not None else None

        def on_step(step: str, left=left) -> None:
            if left is not None and next(left, None) is None:
                raise Cut(step)

        store = StateStore(t.spark, root, on_step=on_step)
        try:
            load_batch(flow, valid, store, *new_run(), reached=(124300, 1))
        except Cut:
            continue
    target = store.current_target(flow.entity, flow.target_schema).select(F.col("ref").alias("entity_id"), "id")
    current = store.current(flow.entity).select("entity_id", F.col("last_hash").isNotNull().alias("hashed"))
    logged = store.load_log().select("log_id", "entity_id", "attempt_number")
    mark = store.watermarks().select("last_upmj")
    return target.join(current, "entity_id", "full_outer").join(logged, "entity_id", "full_outer").join(mark)


@query(oracle("""
    SELECT entity_id, count_if(status = 'LOADED') > 0 AS was_loaded, cast(max(attempt_number) AS int) AS attempts
    FROM {log} WHERE entity_type = 'customer' GROUP BY entity_id"""))
def state_adopted(t: Tables) -> DataFrame:
    """An existing log taken over: the current state answers what the log was aggregated for."""
    store, flow = StateStore(t.spark, scratch_path(t.spark, "state")), customer_flow()
    target = align_columns(t("target_partner"), flow.target_schema)
    store.adopt(flow.entity, align_columns(t("load_log"), S.LOAD_LOG), target, flow.target_schema, "ref")
    return store.current(flow.entity).where("attempts > 0").select("entity_id", "was_loaded", "attempts")


# Whole runs.

@query(oracle("""
    SELECT ref, id, name, phone, city, zip, customer_rank FROM (
      SELECT cast(_source_key AS varchar) AS ref, name, phone, city, zip, customer_rank,
             row_number() OVER (ORDER BY _upmj NULLS FIRST, _upmt NULLS FIRST, _source_key) AS id
      FROM {valid_customers}) v"""))
def customer_sync_target(t: Tables) -> DataFrame:
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    flow = customer_flow()
    run_sync(flow, t("raw_address"), store)
    return store.current_target(flow.entity, flow.target_schema).select(
        "ref", "id", "name", "phone", "city", "zip", "customer_rank"
    )


@query(oracle("""
    SELECT default_code, id, name, list_price, uom_id FROM (
      SELECT default_code, name, list_price, unit1_id AS uom_id,
             row_number() OVER (ORDER BY _upmj NULLS FIRST, _upmt NULLS FIRST, _source_key) AS id
      FROM {valid_items}) v"""))
def item_sync_target(t: Tables) -> DataFrame:
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    flow = item_flow(dimension(t))
    run_sync(flow, t("raw_item"), store)
    return store.current_target(flow.entity, flow.target_schema).select(
        "default_code", "id", "name", "list_price", "uom_id"
    )


@query(oracle("""
    SELECT cast(_source_key AS varchar) AS entity_id, 'LOADED' AS status, name AS record_name
    FROM {valid_customers}"""))
def stream_sync_log(t: Tables) -> DataFrame:
    landed = scratch_path(t.spark, "landing")
    t("raw_address").write.parquet(landed)
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    stream = t.spark.readStream.schema(S.RAW_ADDRESS).parquet(landed)
    start_sync(stream, customer_flow(), store, scratch_path(t.spark, "stream")).awaitTermination()
    return store.load_log().select("entity_id", "status", "record_name")


def _landed(t: Tables, parts: int) -> str:
    """The raw customers in so many files, copies of a key in one of them."""
    path = scratch_path(t.spark, "landing")
    raw = materialize(t("raw_address").withColumn("_part", F.pmod(F.coalesce(fn.parse_long(F.col("AN8")), F.lit(0)), F.lit(parts))), "raw")
    for part in range(parts):
        raw.where(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(path)
    return path


@query(oracle("""
    SELECT cast(_source_key AS varchar) AS entity_id, 'LOADED' AS status FROM {valid_customers}
    UNION ALL SELECT 'micro-batches', '3' UNION ALL SELECT 'refused rows in the log', '1' UNION ALL SELECT 'rows waiting', '0'"""))
def stream_retry(t: Tables) -> DataFrame:
    """Three micro-batches; what the target refuses in the first one, and all that had to wait for it, is loaded later."""
    flow, results = customer_flow(), []
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    stream = t.spark.readStream.schema(S.RAW_ADDRESS).option("maxFilesPerTrigger", 1).parquet(_landed(t, 3))
    refused = valid_customers(t).select(
        F.col("_source_key").cast("string").alias("entity_id"), F.lit("locked").alias("error")).where("entity_id % 2 = 1")
    start_sync(
        stream, flow, store, scratch_path(t.spark, "stream"), on_result=results.append,
        rejections=lambda epoch: refused if epoch == 0 else None,
    ).awaitTermination()
    log_now = store.load_log()
    facts = [
        ("micro-batches", str(len(results))),
        ("refused rows in the log", str(log_now.where("status = 'FAILED'").count())),
        ("rows waiting", str(sum(len(f) for f in store.snapshot().folders.get("retry_customers", {}).values()))),
    ]
    return log_now.where("status = 'LOADED'").select("entity_id", "status").unionAll(
        t.spark.createDataFrame(facts, "entity_id string, status string"))


@query(oracle("""
    SELECT cast(_source_key AS varchar) AS entity_id, 1 AS attempt_number FROM {valid_customers}
    UNION ALL SELECT 'watermarks', 2"""))
def stream_epoch_replayed(t: Tables) -> DataFrame:
    """Two epochs, the first of which comes again after the second: nothing is logged twice, no watermark falls."""
    flow, store = customer_flow(), StateStore(t.spark, scratch_path(t.spark, "state"))
    raw = materialize(t("raw_address"), "raw")
    late = F.coalesce(fn.parse_long(F.col("AN8")), F.lit(0)) % 2 == 1
    for epoch in (0, 1, 0):
        sync_epoch(flow, store, raw.where(late == (epoch == 1)), f"stream:{epoch}")
    marks = store.watermarks().agg(F.lit("watermarks").alias("entity_id"), F.count(F.lit(1)).cast("int").alias("attempt_number"))
    return store.load_log().select("entity_id", "attempt_number").unionAll(marks)


@query(oracle("""
    SELECT 1 AS run, 'DRY_RUN' AS outcome, count(*) AS loaded_or_valid FROM {valid_customers}
    UNION ALL SELECT 2, 'SUCCESS', count(*) FROM {valid_customers}
    UNION ALL SELECT 3, 'NO_OP', 0"""))
def sync_outcomes(t: Tables) -> DataFrame:
    """A dry run, which stores nothing, a run, and a run over nothing new (every row has a change time here)."""
    store, flow = StateStore(t.spark, scratch_path(t.spark, "state")), customer_flow()
    timed = t("raw_address").withColumns({"UPMJ": F.lit("124001"), "UPMT": F.lit("1")})
    raw = materialize(timed, "raw")
    found = []
    for run, dry in ((1, True), (2, False), (3, False)):
        result = run_sync(flow, raw, store, dry_run=dry)
        found.append((run, result.outcome, result.records_valid if dry else result.records_loaded))
    return t.spark.createDataFrame(found, "run int, outcome string, loaded_or_valid long")


@query(oracle("""
    SELECT entity, count(*) AS rows FROM (
      SELECT 'customer' AS entity FROM {valid_customers} UNION ALL SELECT 'item' FROM {valid_items}) s GROUP BY entity"""))
def flow_contract(t: Tables) -> DataFrame:
    """Both tables through the same run code and one store; only their flows differ."""
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    for flow, raw in ((customer_flow(), t("raw_address")), (item_flow(dimension(t)), t("raw_item"))):
        run_sync(flow, raw, store)
    return store.load_log().groupBy(F.col("entity_type").alias("entity")).agg(F.count(F.lit(1)).alias("rows"))


@query(oracle(f"SELECT _source_key, CASE {ROW_RULES} END AS _failed_rule FROM {{customers}}"))
def stream_row_rules(t: Tables) -> DataFrame:
    """Row rules on a stream of raw files; duplicate keys need a batch and are left out."""
    stream = t.spark.readStream.schema(S.RAW_ADDRESS).parquet(_landed(t, 2))
    rows = validate_stream(transform_customers(stream), validate.customer_row_rules())
    out = scratch_path(t.spark, "validated")
    rows.select("_source_key", "_failed_rule").writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(t.spark, "stream")).option("path", out).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema("_source_key long, _failed_rule string").parquet(out)


# Conflicts.

def conflict_inputs(t: Tables) -> DataFrame:
    rows = load.with_entity_id(valid_customers(t))
    hashed = rows.select(
        "_source_key", "entity_id", "name", "phone", "city",
        fn.content_hash(rows, S.PARTNER_HASH_FIELDS).alias("content_hash"),
    )
    key = F.col("_source_key")
    stored = hashed.select(
        "entity_id",
        F.when(key % 9 == 0, F.col("content_hash")).when(key % 9 == 3, "stale")
        .when(key % 18 == 6, "").alias("last_hash"),
    ).where(F.col("last_hash").isNotNull())
    return conflict.conflict_inputs(hashed, load.target_ids(t("target_partner"), "ref"), stored)


def _conflict_sql(strategy: str) -> str:
    """``strategy`` is an SQL expression."""
    return oracle(f"""
        SELECT entity_id, change, CASE WHEN change = 'insert' THEN 'NONE'
            WHEN change = 'unchanged' OR chosen = 'TARGET_WINS' THEN 'SKIP'
            WHEN chosen = 'SOURCE_WINS' THEN 'UPDATE' ELSE 'FLAG' END AS action,
          CASE WHEN change = 'insert' THEN 'Not in the target yet'
            WHEN change = 'unchanged' THEN 'Same content as last loaded'
            ELSE 'target row ' || existing_id || CASE chosen
              WHEN 'SOURCE_WINS' THEN ' is updated from the source'
              WHEN 'TARGET_WINS' THEN ' is kept, source change ignored'
              ELSE ' differs from the source, needs review' END END AS reason,
          CASE WHEN change <> 'insert' THEN chosen END AS strategy
        FROM (SELECT *, {strategy} AS chosen FROM {{conflict_kinds}}) k""")


def _decisions(t: Tables, strategy: object) -> DataFrame:
    return conflict.decide(conflict_inputs(t), strategy).select(
        "entity_id", "change", "action", "reason", "strategy"
    )


@query(_conflict_sql("'SOURCE_WINS'"))
def conflict_source_wins(t: Tables) -> DataFrame:
    return _decisions(t, S.SOURCE_WINS)


@query(_conflict_sql("'TARGET_WINS'"))
def conflict_target_wins(t: Tables) -> DataFrame:
    return _decisions(t, S.TARGET_WINS)


@query(_conflict_sql("'FLAG'"))
def conflict_flag(t: Tables) -> DataFrame:
    return _decisions(t, S.FLAG)


@query(_conflict_sql("""
    CASE _source_key % 5 WHEN 0 THEN 'SOURCE_WINS' WHEN 1 THEN 'TARGET_WINS' ELSE 'FLAG' END"""))
def conflict_resolve(t: Tables) -> DataFrame:
    part = F.col("_source_key") % 5
    return _decisions(
        t, F.when(part == 0, S.SOURCE_WINS).when(part == 1, S.TARGET_WINS).otherwise(S.FLAG)
    )


@query(oracle("SELECT entity_id, change FROM {conflict_kinds}"))
def change_detection(t: Tables) -> DataFrame:
    rows = conflict_inputs(t)
    return rows.select("entity_id", conflict.change_kind(rows).alias("change"))


@query(oracle("""
    SELECT p.id, p.ref, coalesce(k.name, p.name) AS name,
           CASE WHEN k.entity_id IS NULL THEN p.phone ELSE k.phone END AS phone,
           CASE WHEN k.entity_id IS NULL THEN p.city ELSE k.city END AS city
    FROM {target_partner} p LEFT JOIN (SELECT * FROM {conflict_kinds} WHERE change = 'changed') k
      ON k.entity_id = p.ref AND k.existing_id = p.id
    UNION ALL
    SELECT NULL, entity_id, name, phone, city FROM {conflict_kinds} WHERE change = 'insert'"""))
def conflict_apply(t: Tables) -> DataFrame:
    """On a stored target, of which only the buckets with a change are written."""
    store, fields = StateStore(t.spark, scratch_path(t.spark, "state"), buckets=64), ["name", "phone", "city"]
    target = t("target_partner").select("id", "ref", *fields)
    commit = store.begin("target")
    commit.append("target_partner", target, "ref", target.schema)
    commit.publish()
    decided = materialize(conflict.decide(conflict_inputs(t), S.SOURCE_WINS), "decided")
    commit = store.begin("decisions")
    commit.apply("target_partner", decided, fields, "ref", target.schema)
    commit.publish()
    return store.read("target_partner", target.schema)


def _two_syncs(t: Tables, strategy: str) -> StateStore:
    """All customers are loaded, then read again, every second one in another city."""
    store = StateStore(t.spark, scratch_path(t.spark, "state"))
    flow, raw = customer_flow(), t("raw_address")
    run_sync(flow, raw, store)
    moved = fn.parse_long(F.col("AN8")) % 2 == 0
    again = raw.withColumns({
        "CTY1": F.when(moved, F.concat("CTY1", F.lit(" moved"))).otherwise(F.col("CTY1")),
        "UPMJ": F.lit("125001"), "UPMT": F.lit("1"),
    })
    run_sync(flow, again, store, on_existing=strategy)
    return store


@query(oracle("""
    SELECT cast(_source_key AS varchar) AS entity_id,
           CASE WHEN _source_key % 2 = 0 THEN 'changed' ELSE 'unchanged' END AS change,
           CASE WHEN _source_key % 2 = 0 THEN 'FLAG' ELSE 'SKIP' END AS action
    FROM {valid_customers}"""))
def sync_conflict_flag(t: Tables) -> DataFrame:
    return _two_syncs(t, S.FLAG).conflicts().select("entity_id", "change", "action")


@query(oracle("""
    SELECT cast(_source_key AS varchar) AS ref,
           CASE WHEN _source_key % 2 = 0 THEN city || ' moved' ELSE city END AS city
    FROM {valid_customers}"""))
def sync_conflict_update(t: Tables) -> DataFrame:
    flow = customer_flow()
    shown = ["ref", "city"]
    return _two_syncs(t, S.SOURCE_WINS).current_target(flow.entity, flow.target_schema, shown).select(*shown)


# Previews and reports.

def _preview(t: Tables, df: DataFrame, columns: list[str]) -> DataFrame:
    path = write_preview(df, scratch_path(t.spark, "out"), "preview", "run", columns)
    return t.spark.read.option("header", True).option("escape", '"').csv(path)


_PREVIEW_SQL = ", ".join(f"cast({c} AS varchar) AS {c}" for c in S.PARTNER_PREVIEW)


@query(oracle(f"SELECT {_PREVIEW_SQL} FROM {{valid_customers}}"))
def preview_valid(t: Tables) -> DataFrame:
    return _preview(t, valid_customers(t), S.PARTNER_PREVIEW)


@query(oracle(f"""
    SELECT {_PREVIEW_SQL}, cast(_source_key AS varchar) AS _source_key, _failed_rule, _failure_reason
    FROM {{customer_reasons}} WHERE _failed_rule IS NOT NULL"""))
def preview_failed(t: Tables) -> DataFrame:
    return _preview(
        t, validate.failed_rows(customer_results(t)), [*S.PARTNER_PREVIEW, *S.FAILURE_COLUMNS]
    )


_ITEM_PREVIEW_SQL = ", ".join(
    f"cast({c} AS varchar) AS {c}" for c in S.PRODUCT_PREVIEW)


@query(oracle(f"SELECT {_ITEM_PREVIEW_SQL} FROM {{valid_items}}"))
def preview_valid_items(t: Tables) -> DataFrame:
    return _preview(t, valid_items(t), S.PRODUCT_PREVIEW)


@query(oracle("""
    SELECT 'first' AS run, count(*) AS rows FROM {valid_customers} UNION ALL SELECT 'second', count(*) FROM {valid_customers}
    UNION ALL SELECT 'same again', 0"""))
def preview_never_overwritten(t: Tables) -> DataFrame:
    """Runs write below their own ids; a used id is refused and what it wrote stays."""
    root, valid = scratch_path(t.spark, "out"), materialize(valid_customers(t), "valid")
    counts = []
    for run in ("first", "second"):
        path = write_preview(valid, root, "preview", run, S.PARTNER_PREVIEW)
        counts.append(read_csv(t.spark, path, StructType([StructField(c, StringType()) for c in S.PARTNER_PREVIEW])).agg(
            F.lit(run).alias("run"), F.count(F.lit(1)).alias("rows")))
    try:
        write_preview(valid, root, "preview", "first", S.PARTNER_PREVIEW)
        written = 1
    except AnalysisException:
        written = 0
    counts.append(t.spark.range(1).select(F.lit("same again").alias("run"), F.lit(written).cast("long").alias("rows")))
    return reduce(DataFrame.unionAll, counts)


def _reports(t: Tables) -> dict[str, DataFrame]:
    validated = materialize(customer_results(t), "validated")
    history, existing = load_state(t, "customer", "target_partner", "ref")
    planned = load.plan_load(
        validate.valid_rows(validated), history, existing, t("rejections")
    )
    return report_tables(
        customer_flow(), validated, planned, "parquet", "2024-02-01 00:00:00", False
    )


@query(oracle("""
    SELECT cast(position AS int) AS position, label, value FROM (
      SELECT 1 AS position, 'Run mode' AS label, 'LIVE' AS value
      UNION ALL SELECT 2, 'Data source', 'PARQUET'
      UNION ALL SELECT 3, 'Run time', '2024-02-01 00:00:00'
      UNION ALL SELECT 4, 'Total extracted', cast(n AS varchar) FROM {rule_tally}
      UNION ALL SELECT 5, 'Valid records', cast(n - bad AS varchar) FROM {rule_tally}
      UNION ALL SELECT 6, 'Failed records', cast(bad AS varchar) FROM {rule_tally}
      UNION ALL SELECT 7, 'Created', cast(loaded AS varchar) FROM {load_tally}
      UNION ALL SELECT 8, 'Rejected', cast(failed AS varchar) FROM {load_tally}
      UNION ALL SELECT 9, 'Not processed', cast(not_processed AS varchar) FROM {load_tally}
      UNION ALL SELECT 10, 'Skipped', cast(skipped AS varchar) FROM {load_tally}
      UNION ALL SELECT 11, 'Run status', CASE WHEN total = 0 THEN 'NO_OP'
        WHEN failed > 0 THEN 'FAILED' WHEN not_processed > 0 THEN 'PARTIAL'
        WHEN loaded > 0 AND skipped > 0 THEN 'SUCCESS_WITH_SKIPS'
        WHEN loaded > 0 THEN 'SUCCESS' ELSE 'NO_OP' END FROM {load_tally}
      UNION ALL SELECT 12, 'Run message', CASE WHEN total = 0 THEN 'Nothing to process'
        WHEN failed > 0 THEN 'Stopped: rejected rows ' || failed
        WHEN not_processed > 0 THEN 'Stopped early: rows not processed ' || not_processed
        WHEN loaded > 0 AND skipped > 0
          THEN 'Complete: loaded ' || loaded || ', already loaded ' || skipped
        WHEN loaded > 0 THEN 'Complete: loaded ' || loaded
        ELSE 'Everything was loaded before' END FROM {load_tally}) r"""))
def report_summary(t: Tables) -> DataFrame:
    return _reports(t)["summary"]


def _report_sql(columns: list[tuple[str, str]]) -> str:
    return ", ".join(
        f"cast({c} AS varchar) AS {h}" if c in report.TEXT_COLUMNS else f"{c} AS {h}"
        for h, c in columns
    )


@query(oracle(f"SELECT {_report_sql(report.CUSTOMER_VALIDATED)} FROM {{valid_customers}}"))
def report_validated(t: Tables) -> DataFrame:
    return report.report_columns(valid_customers(t), report.CUSTOMER_VALIDATED)


@query(oracle(f"SELECT {_report_sql(report.ITEM_VALIDATED)} FROM {{valid_items}}"))
def report_validated_items(t: Tables) -> DataFrame:
    return report.report_columns(valid_items(t), report.ITEM_VALIDATED)


@query(oracle(f"""
    SELECT {_report_sql(report.CUSTOMER_FAILED)} FROM {{customer_reasons}}
    WHERE _failed_rule IS NOT NULL"""))
def report_failed(t: Tables) -> DataFrame:
    return report.report_columns(validate.failed_rows(customer_results(t)), report.CUSTOMER_FAILED)


@query(oracle("""
    SELECT o.entity_id AS source_key, name, status,
           cast(coalesce(o.target_id, h.target_id) AS varchar) AS target_id,
           coalesce(error, CASE status
             WHEN 'LOADED' THEN 'Created in the target, id '
               || coalesce(cast(coalesce(o.target_id, h.target_id) AS varchar), 'unknown')
             WHEN 'SKIPPED' THEN 'Already loaded, not created again'
             WHEN 'FAILED' THEN 'Rejected by the target'
             ELSE 'Batch stopped before this row' END) AS reason
    FROM {customer_outcomes} o LEFT JOIN {latest_ids} h ON h.entity_id = o.entity_id"""))
def report_load_results(t: Tables) -> DataFrame:
    return _reports(t)["load_results"]


@query(oracle("""
    SELECT *, CASE WHEN total = 0 THEN 'NO_OP' WHEN failed > 0 THEN 'FAILED'
        WHEN not_processed > 0 THEN 'PARTIAL'
        WHEN loaded > 0 AND skipped > 0 THEN 'SUCCESS_WITH_SKIPS'
        WHEN loaded > 0 THEN 'SUCCESS' ELSE 'NO_OP' END AS report_status,
      CASE WHEN total = 0 THEN 'Nothing to process'
        WHEN failed > 0 THEN 'Stopped: rejected rows ' || failed
        WHEN not_processed > 0 THEN 'Stopped early: rows not processed ' || not_processed
        WHEN loaded > 0 AND skipped > 0
          THEN 'Complete: loaded ' || loaded || ', already loaded ' || skipped
        WHEN loaded > 0 THEN 'Complete: loaded ' || loaded
        ELSE 'Everything was loaded before' END AS message
    FROM {summaries}"""))
def report_status(t: Tables) -> DataFrame:
    return report.classify_report(t("summaries"))
