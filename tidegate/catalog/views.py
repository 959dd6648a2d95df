"""Raw-shaped views over the sample tables.

The sample tables are clean, so these views damage them by arithmetic on their keys.
The text runs unchanged in Spark SQL and in the oracle's SQL; ``{name}`` stands for a
table or an earlier view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidegate.runtime import spread

BASE_TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")

# What damages these rows, and the transforms behind it, cost far more than the rows themselves.
SPREAD = {"raw_address": "customer", "raw_item": "part"}

VIEWS: dict[str, str] = {
    "raw_address": """
        SELECT
          CASE WHEN k % 97 = 5 THEN NULL WHEN k % 89 = 4 THEN 'x' || t
               WHEN k % 83 = 6 THEN t || '.0' WHEN k % 50 = 1 THEN cast(k - 1 AS string)
               WHEN k % 31 = 2 THEN ' ' || t || ' ' ELSE t END AS AN8,
          CASE WHEN k % 41 = 3 THEN '' WHEN k % 47 = 5 THEN NULL WHEN k % 37 = 4 THEN '   '
               WHEN k % 29 = 1 THEN chr(9) || c_name || '  '
               WHEN k % 23 = 3 THEN 'Smith "' || t || '" ' || chr(92) || ' Sons'
               WHEN k % 19 = 2 THEN 'Café ' || t ELSE c_name END AS ALPH,
          CASE WHEN k % 43 = 7 THEN 'X' WHEN k % 61 = 9 THEN 'c' WHEN k % 67 = 10 THEN NULL
               WHEN c_mktsegment = 'BUILDING' THEN 'V'
               WHEN c_mktsegment = 'MACHINERY' THEN 'E' ELSE 'C' END AS AT1,
          CASE WHEN k % 33 = 3 THEN NULL WHEN k % 44 = 4 THEN '12345'
               WHEN k % 11 = 0 THEN '+63 82 234 ' || lpad(cast(k % 10000 AS string), 4, '0')
               WHEN k % 11 = 1 THEN '02-8525-' || lpad(cast(k % 10000 AS string), 4, '0')
               WHEN k % 11 = 2 THEN '0917' || lpad(cast(k % 10000000 AS string), 7, '0') || chr(10)
               WHEN k % 55 = 6 THEN ' - '
               ELSE '0917' || lpad(cast(k % 10000000 AS string), 7, '0') END AS PH1,
          CASE WHEN k % 53 = 6 THEN NULL WHEN k % 59 = 3 THEN '  '
               ELSE t || ' Main Drive' END AS ADD1,
          CASE WHEN k % 4 = 0 THEN 'Unit ' || t ELSE NULL END AS ADD2,
          CASE WHEN k % 71 = 8 THEN NULL ELSE n_name END AS CTY1,
          lpad(cast(c_nationkey AS string), 2, '0') AS ADDS,
          CASE WHEN k % 59 = 8 THEN 'ABC' || t WHEN k % 5 = 0 THEN NULL
               ELSE lpad(cast(k % 10000 AS string), 4, '0') END AS ADDZ,
          CASE WHEN n_regionkey = 0 THEN 'NA' ELSE 'R' || cast(n_regionkey AS string) END AS COUN,
          cast(123456789000 + k AS string) AS TAX,
          CASE WHEN k % 4 = 0 THEN '0' WHEN k % 101 = 0 THEN '00' WHEN k % 9 = 0 THEN NULL
               ELSE cast(k - k % 10 AS string) END AS PA8,
          CASE WHEN k % 73 = 9 THEN NULL WHEN k % 79 = 10 THEN '' WHEN k % 103 = 11 THEN 'n/a'
               WHEN k % 107 = 12 THEN '124000' WHEN k % 109 = 13 THEN '124400'
               ELSE cast(124001 + k % 300 AS string) END AS UPMJ,
          CASE WHEN k % 113 = 14 THEN NULL WHEN k % 127 = 15 THEN 'noon'
               ELSE cast(k * 37 % 86400 AS string) END AS UPMT
        FROM (SELECT c_custkey AS k, cast(c_custkey AS string) AS t, c_name, c_mktsegment,
                     c_nationkey, n_name, n_regionkey
              FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey) s
    """,
    "raw_item": """
        SELECT
          CASE WHEN k % 97 = 5 THEN NULL WHEN k % 89 = 4 THEN '' WHEN k % 83 = 6 THEN 'abc'
               WHEN k % 79 = 7 THEN '-' || t WHEN k % 101 = 8 THEN 'nan'
               WHEN k % 103 = 9 THEN 'inf' WHEN k % 50 = 1 THEN cast(k - 1 AS string)
               WHEN k % 31 = 2 THEN t || '.0' WHEN k % 37 = 3 THEN t || 'e0'
               WHEN k % 29 = 4 THEN ' ' || t || ' ' ELSE t END AS ITM,
          CASE WHEN k % 41 = 3 THEN '' WHEN k % 43 = 5 THEN '  '
               ELSE ' ' || p_name || ' ' || t END AS DSC1,
          CASE WHEN k % 3 = 0 THEN NULL ELSE p_brand END AS DSC2,
          CASE WHEN k % 47 = 7 THEN 'Z' WHEN k % 53 = 9 THEN NULL
               WHEN p_type = 'PROMO' THEN 'O' WHEN p_type = 'SMALL' THEN 'n'
               WHEN p_type = 'LARGE' THEN 'N' WHEN p_type = 'MEDIUM' THEN ' s'
               ELSE 'S' END AS STKT,
          CASE WHEN k % 37 = 6 THEN NULL WHEN k % 61 = 7 THEN 'XX' WHEN k % 59 = 8 THEN ' '
               WHEN k % 24 = 9 THEN 'U' || t
               WHEN p_size % 7 = 0 THEN 'KG' WHEN p_size % 7 = 1 THEN 'hr'
               WHEN p_size % 7 = 2 THEN 'DZ' WHEN p_size % 7 = 3 THEN 'L' ELSE 'EA' END AS UOM1,
          CASE WHEN k % 5 = 0 THEN NULL WHEN k % 67 = 10 THEN 'YY'
               WHEN p_size % 7 = 0 THEN 'lb' WHEN p_size % 7 = 1 THEN 'HR'
               WHEN p_size % 7 = 2 THEN 'EA' WHEN p_size % 7 = 3 THEN 'L'
               WHEN k % 71 = 11 THEN 'KG' ELSE 'CS' END AS UOM2,
          CASE WHEN k % 73 = 12 THEN 'abc' WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 1 THEN ''
               WHEN k % 17 = 2 THEN '-' || price WHEN k % 19 = 3 THEN '5d'
               WHEN k % 23 = 4 THEN '0.00' WHEN k % 27 = 5 THEN 'NaN'
               ELSE ' ' || price END AS SRP1,
          CASE WHEN k % 77 = 9 THEN NULL WHEN k % 79 = 10 THEN 'soon'
               ELSE cast(124001 + k % 300 AS string) END AS UPMJ,
          CASE WHEN k % 113 = 14 THEN NULL ELSE cast(k * 41 % 86400 AS string) END AS UPMT
        FROM (SELECT p_partkey AS k, cast(p_partkey AS string) AS t, p_name, p_brand, p_type, p_size,
                     cast(cast(floor(round(p_retailprice * 100) / 100) AS bigint) AS string) || '.'
                       || lpad(cast(cast(round(p_retailprice * 100) AS bigint) % 100 AS string), 2, '0')
                       AS price
              FROM {part}) s
    """,
    "unit_mapping": """
        SELECT k AS pos,
          CASE k % 12 WHEN 0 THEN 'EA' WHEN 1 THEN ' cs ' WHEN 2 THEN 'DZ' WHEN 3 THEN 'KG'
               WHEN 4 THEN 'lb' WHEN 5 THEN 'L' WHEN 6 THEN 'HR' WHEN 7 THEN '  '
               WHEN 8 THEN 'ZZ' WHEN 9 THEN 'U' || t WHEN 10 THEN 'ea' ELSE 'P' || t END
            AS source_code,
          CASE k % 12 WHEN 0 THEN 'Units' WHEN 1 THEN 'Units'
               WHEN 2 THEN CASE WHEN k % 5 = 0 THEN 'Units' ELSE 'Dozens' END
               WHEN 3 THEN ' kg' WHEN 4 THEN 'lb' WHEN 5 THEN 'L' WHEN 6 THEN 'Hours'
               WHEN 7 THEN 'Units' WHEN 8 THEN ' ' WHEN 9 THEN 'Size ' || cast(p_size AS string)
               WHEN 10 THEN 'Units' ELSE 'Size ' || cast(p_size AS string) END AS target_name,
          CASE k % 12 WHEN 3 THEN 'Weight' WHEN 4 THEN 'Weight' WHEN 5 THEN 'Volume '
               WHEN 6 THEN 'Time' ELSE 'Unit' END AS category
        FROM (SELECT p_partkey AS k, cast(p_partkey AS string) AS t, p_size FROM {part}) s
    """,
    "unit_mapping_bad": """
        SELECT pos, source_code,
               CASE WHEN pos % 12 = 11 THEN 'Missing ' || cast(pos % 7 AS string) ELSE target_name END
                 AS target_name, category
        FROM {unit_mapping}
    """,
    "unit_target": """
        SELECT p_partkey + 1 AS id,
          CASE p_partkey % 8 WHEN 0 THEN 'Units' WHEN 1 THEN 'Dozens' WHEN 2 THEN 'kg'
               WHEN 3 THEN 'lb' WHEN 4 THEN 'L' WHEN 5 THEN 'Hours'
               ELSE 'Size ' || cast(p_size AS string) END AS name
        FROM {part}
        UNION ALL
        SELECT 900000000000 + p_partkey AS id, 'Size ' || cast(p_size AS string) AS name FROM {part}
    """,
    "target_partner": """
        SELECT 10000 + k AS id, cast(k AS string) AS ref,
               CASE WHEN k % 6 = 0 THEN c_name || ' old' ELSE c_name END AS name,
               '0917' || lpad(cast(k % 10000000 AS string), 7, '0') AS phone, n_name AS city
        FROM (SELECT c_custkey AS k, c_name, n_name
              FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey) s
        WHERE k % 3 = 0
        UNION ALL
        SELECT 900000000000 + c_custkey AS id, cast(c_custkey AS string) AS ref,
               c_name || ' again' AS name, NULL AS phone, NULL AS city
        FROM {customer} WHERE c_custkey % 21 = 0
    """,
    "target_product": """
        SELECT 50000 + p_partkey AS id, cast(p_partkey AS string) AS default_code, p_name AS name
        FROM {part} WHERE p_partkey % 3 = 1
    """,
    "load_log": """
        SELECT k * 10 + 1 AS log_id, 'batch-1' AS batch_id, 1 AS attempt_number, k AS an8,
               CASE WHEN k % 20 = 5 THEN NULL ELSE t END AS entity_id,
               CASE WHEN k % 20 = 5 THEN NULL ELSE 'customer' END AS entity_type,
               cast('2024-01-01 00:00:00' AS timestamp) AS run_at,
               CASE WHEN k % 15 = 0 THEN 'FAILED' ELSE 'LOADED' END AS status,
               CASE WHEN k % 15 = 0 OR k % 35 = 5 THEN NULL ELSE 20000 + k END AS target_id,
               CASE WHEN k % 15 = 0 THEN 'refused' ELSE NULL END AS error, c_name AS record_name
        FROM (SELECT c_custkey AS k, cast(c_custkey AS string) AS t, c_name FROM {customer}) a
        WHERE k % 5 = 0
        UNION ALL
        SELECT k * 10 + 2, 'batch-2', 2, k, t, 'customer', cast('2024-01-02 00:00:00' AS timestamp),
               CASE WHEN k % 30 = 0 THEN 'LOADED' ELSE 'FAILED' END,
               CASE WHEN k % 30 = 0 THEN 30000 + k ELSE NULL END,
               CASE WHEN k % 30 = 0 THEN NULL ELSE 'refused again' END, c_name
        FROM (SELECT c_custkey AS k, cast(c_custkey AS string) AS t, c_name FROM {customer}) b
        WHERE k % 15 = 0
        UNION ALL
        SELECT k * 10 + 3, 'batch-3', 3, k, t, 'customer', cast('2024-01-03 00:00:00' AS timestamp),
               CASE WHEN k % 40 = 0 THEN 'LOADED' ELSE 'NOT_PROCESSED' END,
               CASE WHEN k % 40 = 0 THEN 40000 + k ELSE NULL END, NULL, c_name
        FROM (SELECT c_custkey AS k, cast(c_custkey AS string) AS t, c_name FROM {customer}) c
        WHERE k % 20 = 0
        UNION ALL
        SELECT p_partkey * 10 + 4, 'batch-4', 1, p_partkey, cast(p_partkey AS string), 'item',
               cast('2024-01-04 00:00:00' AS timestamp), 'LOADED', 60000 + p_partkey, NULL, p_name
        FROM {part} WHERE p_partkey % 4 = 1
    """,
    "rejections": """
        SELECT cast(c_custkey AS string) AS entity_id,
               'refused ' || cast(c_custkey AS string) AS error
        FROM {customer}
        WHERE c_custkey % 300 >= 100 AND c_custkey % 7 = 3 AND c_custkey % 73 <> 9
          AND c_custkey % 79 <> 10 AND c_custkey % 103 <> 11 AND c_custkey % 107 <> 12
          AND c_custkey % 109 <> 13
    """,
    "watermark_state": """
        SELECT 'table_' || cast(user_id AS string) AS table_name,
               cast((year(ts) - 1900) * 1000 + dayofyear(ts) AS bigint) AS last_upmj,
               cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS bigint) AS last_upmt,
               cast(ts AS timestamp) AS last_run_at, event_id % 100 AS records_synced
        FROM {events}
    """,
    "watermark_news": """
        SELECT 'table_' || cast(o_custkey AS string) AS table_name,
               cast(max((year(o_orderdate) - 1900) * 1000 + dayofyear(o_orderdate)) AS bigint)
                 AS last_upmj,
               cast(0 AS bigint) AS last_upmt,
               cast('2030-01-01 00:00:00' AS timestamp) AS last_run_at,
               count(*) AS records_synced
        FROM {orders} GROUP BY o_custkey
    """,
    "change_feed": """
        SELECT o_orderkey AS change_key,
               CASE WHEN o_orderkey % 101 = 7 THEN NULL ELSE
                 cast((year(o_orderdate) - 1900) * 1000 + dayofyear(o_orderdate) AS bigint) END
                 AS upmj,
               CASE WHEN o_orderkey % 103 = 8 THEN NULL ELSE o_orderkey * 37 % 86400 END AS upmt
        FROM {orders}
    """,
    "summaries": """
        SELECT run, loaded + failed + not_processed + skipped AS total,
               loaded, failed, not_processed, skipped
        FROM (SELECT o_custkey AS run,
                cast(sum(CASE WHEN o_orderkey % 7 > 1 AND o_custkey % 3 <> 0 AND o_custkey % 11 > 0
                              THEN 1 ELSE 0 END) AS bigint) AS loaded,
                cast(sum(CASE WHEN o_orderkey % 7 = 0 AND o_custkey % 2 = 0 AND o_custkey % 11 > 0
                              THEN 1 ELSE 0 END) AS bigint) AS failed,
                cast(sum(CASE WHEN o_orderkey % 7 = 1 AND o_custkey % 2 = 0 AND o_custkey % 11 > 0
                              THEN 1 ELSE 0 END) AS bigint) AS not_processed,
                cast(sum(CASE WHEN o_orderkey % 7 > 1 AND o_custkey % 6 < 3 AND o_custkey % 11 > 0
                              THEN 1 ELSE 0 END) AS bigint) AS skipped
              FROM {orders} GROUP BY o_custkey) s
    """,
}

_NAME = re.compile(r"\{([a-z_]\w*)\}")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table or a view over the sample tables."""
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    used = {n: read(spark, sf_dir, n) for n in set(_NAME.findall(text))}
    if name in SPREAD:
        used[SPREAD[name]] = spread(used[SPREAD[name]])
    return spark.sql(text, **used)


def with_views(query: str, definitions: dict[str, str]) -> str:
    """Oracle SQL: ``query`` preceded by the views and CTEs it uses, in dependency order."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in definitions and name not in ordered:
                need(definitions[name])
                ordered.append(name)

    need(query)
    parts = [f"{name} AS ({definitions[name]})" for name in ordered]
    text = (f"WITH {', '.join(parts)} " if parts else "") + query
    return _NAME.sub(r"\1", text)
