"""CTEs of the oracle SQL.  Written from the rules, not from the Spark plans."""

from __future__ import annotations

from tidegate import schemas as S
from tidegate.catalog.views import VIEWS, with_views

BLANKS = "' ' || chr(9) || chr(10) || chr(13)"


def trimmed(c: str) -> str:
    return f"trim({c}, {BLANKS})"


def cleaned(c: str) -> str:
    return f"nullif({trimmed(c)}, '')"


def whole(c: str) -> str:
    """Whole number or null; the pattern is checked first because a cast is laxer."""
    return (
        f"CASE WHEN regexp_full_match({trimmed(c)}, '[+-]?[0-9]+') "
        f"THEN cast({trimmed(c)} AS bigint) END"
    )


def number(c: str) -> str:
    pattern = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return (
        f"CASE WHEN regexp_full_match({trimmed(c)}, '{pattern}') "
        f"THEN cast({trimmed(c)} AS double) END"
    )


def julian_date(j: str) -> str:
    return f"(make_date(cast(1900 + {j} // 1000 AS int), 1, 1) + cast({j} % 1000 - 1 AS int))"


def day_text(j: str) -> str:
    return f"coalesce(strftime({julian_date(j)}, '%Y-%m-%d'), 'an unknown day')"


def phone(c: str) -> str:
    return f"nullif(regexp_replace({c}, '[' || {BLANKS} || '-]', '', 'g'), '')"


def quoted(c: str) -> str:
    """JSON text of a value of the sample data, whose only non-ASCII letter is é."""
    body = f"coalesce(cast({c} AS varchar), 'None')"
    for raw, escaped in (("chr(92)", "chr(92) || chr(92)"), ("'\"'", "chr(92) || '\"'"),
                         ("'é'", "chr(92) || 'u00e9'")):
        body = f"replace({body}, {raw}, {escaped})"
    return f"'\"' || {body} || '\"'"


def hash_of(values: dict[str, str]) -> str:
    items = [f"'\"{f}\": ' || {quoted(values.get(f, f))}" for f in sorted(values)]
    return "md5('{' || " + " || ', ' || ".join(items) + " || '}')"


PARTNER_HASH = hash_of(
    {f: f for f in S.PARTNER_HASH_FIELDS}
    | {"is_company": "CASE WHEN is_company THEN 'True' ELSE 'False' END"}
)

ROW_RULES = """
    WHEN name IS NULL THEN 'RULE_03_NAME_REQUIRED'
    WHEN _source_type IS NULL OR _source_type NOT IN ('C', 'V', 'E')
      THEN 'RULE_04_INVALID_ADDRESS_TYPE'
    WHEN phone IS NULL THEN 'RULE_05_PHONE_MISSING'
    WHEN NOT (regexp_full_match(phone, '09[0-9]{9}') OR regexp_full_match(phone, '[+]639[0-9]{9}')
              OR regexp_full_match(phone, '0[0-9]{9,10}')
              OR regexp_full_match(phone, '[+]63[0-9]{9,11}')) THEN 'RULE_05_PHONE_FORMAT'
    WHEN street IS NULL THEN 'RULE_06_ADDRESS_REQUIRED'
    WHEN city IS NULL THEN 'RULE_07_CITY_REQUIRED'
    WHEN zip IS NOT NULL AND NOT regexp_full_match(zip, '[0-9]+') THEN 'RULE_08_ZIP_FORMAT'
"""

def clean_mapping(view: str) -> str:
    return f"""
        SELECT code, target_name, category FROM (
          SELECT upper({trimmed('source_code')}) AS code, {trimmed('target_name')} AS target_name,
                 {trimmed('category')} AS category,
                 row_number() OVER (PARTITION BY upper({trimmed('source_code')})
                                    ORDER BY pos DESC) AS place
          FROM {{{view}}}
          WHERE {trimmed('source_code')} <> '' AND {trimmed('target_name')} <> '') m
        WHERE place = 1
    """


CTES: dict[str, str] = VIEWS | {
    "customers": f"""
        SELECT {whole('AN8')} AS _source_key, {cleaned('ALPH')} AS name, true AS is_company,
               CASE WHEN AT1 = 'C' THEN 1 ELSE 0 END AS customer_rank, AT1 AS _source_type,
               {phone('PH1')} AS phone, {cleaned('ADD1')} AS street, {cleaned('ADD2')} AS street2,
               {cleaned('CTY1')} AS city, {cleaned('ADDZ')} AS zip, {cleaned('ADDS')} AS state_code,
               {cleaned('COUN')} AS country_code, {cleaned('TAX')} AS vat,
               nullif(PA8, '0') AS parent_key,
               'Row of F0101, AN8 ' || coalesce(AN8, 'not given') || ', changed there on '
                 || {day_text('(' + whole('UPMJ') + ')')} AS comment,
               {whole('UPMJ')} AS _upmj, {whole('UPMT')} AS _upmt
        FROM {{raw_address}}
    """,
    "customer_results": f"""
        SELECT c.*, CASE
            WHEN c._source_key IS NULL THEN 'RULE_01_AN8_REQUIRED'
            WHEN d.k IS NOT NULL THEN 'RULE_02_AN8_DUPLICATE'
            {ROW_RULES} END AS _failed_rule
        FROM {{customers}} c LEFT JOIN
          (SELECT _source_key AS k FROM {{customers}} GROUP BY 1 HAVING count(*) > 1) d
          ON c._source_key = d.k
    """,
    "customer_reasons": """
        SELECT *, CASE left(_failed_rule, 7)
            WHEN 'RULE_01' THEN 'AN8 is missing or not a whole number'
            WHEN 'RULE_02' THEN format('AN8={} occurs more than once; every copy is rejected',
                                       _source_key)
            WHEN 'RULE_03' THEN format('No name (ALPH) for AN8={}', _source_key)
            WHEN 'RULE_04' THEN format('AN8={} has type ''{}''; allowed: C, V, E', _source_key,
                                       coalesce(_source_type, 'null'))
            WHEN 'RULE_05' THEN CASE WHEN phone IS NULL
              THEN format('No phone (PH1) for AN8={}', _source_key)
              ELSE format('Phone ''{}'' of AN8={} is neither 09 + 9 digits nor a 0 / +63 landline',
                          phone, _source_key) END
            WHEN 'RULE_06' THEN format('No street (ADD1) for AN8={}', _source_key)
            WHEN 'RULE_07' THEN format('No city (CTY1) for AN8={}', _source_key)
            WHEN 'RULE_08' THEN format('Postal code ''{}'' of AN8={} is not all digits', zip,
                                       _source_key) END AS _failure_reason
        FROM {customer_results}
    """,
    "valid_customers": "SELECT * FROM {customer_results} WHERE _failed_rule IS NULL",
    "mapping": clean_mapping("unit_mapping"),
    "bad_mapping": clean_mapping("unit_mapping_bad"),
    "target_units": """
        SELECT id, name FROM (
          SELECT id, name, row_number() OVER (PARTITION BY name ORDER BY id) AS place
          FROM {unit_target}) u WHERE place = 1
    """,
    "units": """
        SELECT m.code, u.id, u.name, m.category
        FROM {mapping} m, {target_units} u WHERE m.target_name = u.name
    """,
    "items": f"""
        SELECT k AS _source_key, s AS _source_type, u1 AS _source_unit1, u2 AS _source_unit2,
               cast(k AS varchar) AS default_code, {cleaned('DSC1')} AS name,
               {cleaned('DSC2')} AS description,
               CASE WHEN s IN ('S', 'N') THEN 'consu' WHEN s = 'O' THEN 'service' END AS type,
               s <> 'O' AS sale_ok, true AS purchase_ok, nullif(u1, '') AS uom_id,
               nullif(u2, '') AS uom_po_id, price AS list_price,
               'Row of F4101, ITM ' || coalesce(cast(k AS varchar), 'not given')
                 || ', changed there on ' || {day_text('_upmj')} AS comment,
               _upmj, _upmt
        FROM (SELECT *, cast(trunc({number('ITM')}) AS bigint) AS k,
                     upper({trimmed("coalesce(STKT, '')")}) AS s,
                     upper({trimmed("coalesce(UOM1, '')")}) AS u1,
                     upper({trimmed("coalesce(UOM2, '')")}) AS u2,
                     {number('SRP1')} AS price, {whole('UPMJ')} AS _upmj, {whole('UPMT')} AS _upmt
              FROM {{raw_item}}) r
    """,
    "item_results": """
        SELECT i.*, CASE
            WHEN i._source_key IS NULL OR i._source_key <= 0 THEN 'Rule01_ITMRequired'
            WHEN d.k IS NOT NULL THEN 'Rule02_ITMDuplicate'
            WHEN i.name IS NULL THEN 'Rule03_NameRequired'
            WHEN i._source_type NOT IN ('S', 'N', 'O') THEN 'Rule04_InvalidSTKT'
            WHEN i._source_unit1 = '' OR a.code IS NULL THEN 'Rule05_UOM1Required'
            WHEN i._source_unit2 <> '' AND b.code IS NULL THEN 'Rule06_UOM2Invalid'
            WHEN b.code IS NOT NULL AND a.category <> b.category THEN 'Rule07_UOMCategoryMismatch'
            WHEN i.list_price < 0 THEN 'Rule08_NegativePrice'
            WHEN i._source_type = 'O'
              AND a.category NOT IN ('Unit', 'Time', 'Working Time', 'Unit of Time')
              THEN 'Rule09_STKTUOMIncompatible' END AS _failed_rule,
            a.id AS unit1_id, a.category AS category1, b.category AS category2,
            a.code IS NOT NULL AS known1, b.code IS NOT NULL AS known2
        FROM {items} i
        LEFT JOIN (SELECT _source_key AS k FROM {items} GROUP BY 1 HAVING count(*) > 1) d
          ON i._source_key = d.k
        LEFT JOIN {units} a ON i._source_unit1 = a.code
        LEFT JOIN {units} b ON i._source_unit2 = b.code
    """,
    "valid_items": "SELECT * FROM {item_results} WHERE _failed_rule IS NULL",
    "log": """
        SELECT * REPLACE (coalesce(entity_id, cast(an8 AS varchar)) AS entity_id,
                          coalesce(entity_type, 'customer') AS entity_type)
        FROM {load_log}
    """,
    "loaded_customers": """
        SELECT DISTINCT entity_id FROM {log} WHERE entity_type = 'customer' AND status = 'LOADED'
    """,
    "loaded_items": """
        SELECT DISTINCT entity_id FROM {log} WHERE entity_type = 'item' AND status = 'LOADED'
    """,
    "latest_ids": """
        SELECT entity_id, target_id FROM (
          SELECT entity_id, target_id,
                 row_number() OVER (PARTITION BY entity_id ORDER BY run_at DESC, log_id DESC) AS place
          FROM {log}
          WHERE entity_type = 'customer' AND status = 'LOADED' AND target_id IS NOT NULL) h
        WHERE place = 1
    """,
    "attempts": """
        SELECT entity_type, entity_id, max(attempt_number) AS tried FROM {log} GROUP BY 1, 2
    """,
    "partners": "SELECT ref, min(id) AS id FROM {target_partner} GROUP BY ref",
    "products": "SELECT default_code AS ref, min(id) AS id FROM {target_product} GROUP BY 1",
    "customer_queue": """
        SELECT v.*, cast(v._source_key AS varchar) AS entity_id, l.entity_id IS NOT NULL AS done,
               p.id AS existing_id, r.error AS refusal,
               row_number() OVER (ORDER BY v._upmj NULLS FIRST, v._upmt NULLS FIRST,
                                  v._source_key) AS place,
               coalesce(a.tried, 0) + 1 AS attempt_number
        FROM {valid_customers} v
        LEFT JOIN {loaded_customers} l ON l.entity_id = cast(v._source_key AS varchar)
        LEFT JOIN {partners} p ON p.ref = cast(v._source_key AS varchar)
        LEFT JOIN {rejections} r ON r.entity_id = cast(v._source_key AS varchar)
        LEFT JOIN {attempts} a
          ON a.entity_type = 'customer' AND a.entity_id = cast(v._source_key AS varchar)
    """,
    "customer_outcomes": """
        SELECT *, CASE WHEN status = 'LOADED' THEN existing_id END AS target_id,
               CASE WHEN status = 'LOADED' AND existing_id IS NOT NULL
                      THEN 'Already in the target, not created again'
                    WHEN status = 'FAILED' THEN refusal END AS error,
               status = 'LOADED' AND existing_id IS NULL AS created
        FROM (SELECT *, CASE WHEN done THEN 'SKIPPED' WHEN place > stop THEN 'NOT_PROCESSED'
                             WHEN existing_id IS NOT NULL THEN 'LOADED'
                             WHEN place = stop THEN 'FAILED' ELSE 'LOADED' END AS status
              FROM (SELECT *, coalesce((SELECT min(place) FROM {customer_queue}
                                        WHERE NOT done AND existing_id IS NULL
                                          AND refusal IS NOT NULL), 9223372036854775807) AS stop
                    FROM {customer_queue}) q) s
    """,
    "load_tally": """
        SELECT count(*) AS total, count(*) FILTER (status = 'LOADED') AS loaded,
               count(*) FILTER (status = 'FAILED') AS failed,
               count(*) FILTER (status = 'NOT_PROCESSED') AS not_processed,
               count(*) FILTER (status = 'SKIPPED') AS skipped
        FROM {customer_outcomes}
    """,
    "rule_tally": "SELECT count(*) AS n, count(_failed_rule) AS bad FROM {customer_results}",
    "customer_created": """
        SELECT *, (SELECT max(id) FROM {target_partner}) + row_number() OVER (ORDER BY place)
                    AS new_id
        FROM {customer_queue} WHERE NOT done AND existing_id IS NULL
    """,
    "customer_hashes": f"""
        SELECT *, cast(_source_key AS varchar) AS entity_id, {PARTNER_HASH} AS content_hash
        FROM {{valid_customers}}
    """,
    "conflict_rows": """
        SELECT h.*, p.id AS existing_id,
               CASE WHEN _source_key % 9 = 0 THEN content_hash
                    WHEN _source_key % 9 = 3 THEN 'stale'
                    WHEN _source_key % 18 = 6 THEN '' END AS last_hash
        FROM {customer_hashes} h LEFT JOIN {partners} p ON p.ref = h.entity_id
    """,
    "conflict_kinds": """
        SELECT *, CASE WHEN existing_id IS NULL THEN 'insert'
                       WHEN last_hash = content_hash AND last_hash <> '' THEN 'unchanged'
                       ELSE 'changed' END AS change
        FROM {conflict_rows}
    """,
}


def oracle(query: str) -> str:
    return with_views(query, CTES)
