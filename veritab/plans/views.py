"""Adapters: the star schema's tables in the shapes that the operators take.

Each is one SELECT that Spark and DuckDB both understand, so that a query and the SQL that it is held against start
from the same rows.  Braces name tables or other adapters.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

PERIOD = 1998

ADAPTERS: dict[str, str] = {
    "entity": """
        SELECT c_custkey AS entity_id, c_name AS name, concat('Owner ', cast(c_custkey % 40 AS varchar(10))) AS owner, r_name AS region, c_mktsegment AS entity_type, c_acctbal >= -500 AS active
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "site": """
        SELECT c_custkey * 10 + k AS site_id, c_custkey AS entity_id,
          concat('https://www', cast(c_custkey % 20 AS varchar(10)), '.example.com/', CASE WHEN (c_custkey + k) % 5 = 0 THEN 'plan.pdf' ELSE 'info' END) AS url,
          CASE c_custkey % 3 WHEN 0 THEN 'region_index' WHEN 1 THEN 'operator_manual' ELSE 'web_search' END AS method,
          CASE WHEN c_custkey % 11 = 0 THEN 404 WHEN c_custkey % 5 = 0 THEN NULL ELSE 200 END AS http_status, (c_custkey + k) % 2 = 0 AS verified
        FROM (SELECT c_custkey, 0 AS k FROM {customer} UNION ALL SELECT c_custkey, 1 AS k FROM {customer}) x WHERE c_custkey % 7 <> 0""",
    "document": """
        SELECT o_orderkey AS document_id, o_custkey AS entity_id, year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS period,
          CASE o_orderstatus WHEN 'F' THEN 'ingested' WHEN 'P' THEN 'in_progress' ELSE
            CASE o_orderkey % 6 WHEN 0 THEN 'ocr_pending' WHEN 1 THEN 'entity_mismatch' WHEN 2 THEN 'parse_failed' WHEN 3 THEN 'no_file' WHEN 4 THEN NULL ELSE 'pending' END END AS status,
          CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'image_only' WHEN '5-LOW' THEN 'non_target' ELSE 'target' END AS doc_class
        FROM {orders}""",
    "fact": """
        SELECT entity_id * 100 + k AS unit_id, entity_id, period, max(document_id) AS document_id, CASE WHEN (entity_id + k) % 13 = 0 THEN NULL ELSE cast(sum(quantity) AS bigint) END AS capacity,
          CASE WHEN (entity_id + k) % 17 = 0 THEN NULL ELSE cast(count(*) * 10 + k AS bigint) END AS enrollment,
          CASE WHEN k % 4 = 3 THEN NULL ELSE cast(sum(line) % 60 + 40 AS double) / 100 END AS confidence, TRUE AS is_current
        FROM (SELECT o_custkey AS entity_id, l_partkey % 5 AS k, year(l_shipdate) AS period, o_orderkey AS document_id, l_quantity AS quantity, l_linenumber AS line
              FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey) x
        GROUP BY entity_id, k, period""",
    "expected": """
        SELECT o_orderkey AS entity, o_orderstatus AS metric, cast(sum(cast(l_quantity AS bigint)) AS double) AS value
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_linenumber <> 7 GROUP BY o_orderkey, o_orderstatus""",
    "actual": """
        SELECT o_orderkey AS entity, o_orderstatus AS metric, cast(sum(cast(l_quantity AS bigint)) AS double) AS value
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE o_orderkey % 97 <> 0 GROUP BY o_orderkey, o_orderstatus
        UNION ALL SELECT o_orderkey AS entity, o_orderstatus AS metric, 1.0 AS value FROM {orders} WHERE o_orderkey % 89 = 0
        UNION ALL SELECT -o_orderkey AS entity, o_orderstatus AS metric, NULL AS value FROM {orders} WHERE o_orderkey % 101 = 0""",
    "reviewed": """
        SELECT concat('Entity ', cast(l_suppkey AS varchar(10))) AS entity, concat('cat', cast(l_partkey % 3 AS varchar(10))) AS category, concat('Unit ', cast(l_partkey % 40 AS varchar(10))) AS unit,
          year(l_shipdate) AS period, 'capacity' AS metric, l_orderkey * 10 + l_linenumber AS review_id,
          CASE l_orderkey % 5 WHEN 0 THEN 'excluded' WHEN 1 THEN 'pending' WHEN 2 THEN 'corrected' ELSE 'accepted' END AS review_status,
          CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE cast(cast(l_quantity AS bigint) AS varchar(20)) END AS final_value
        FROM {lineitem} WHERE l_linenumber % 2 = 1""",
    "external": """
        SELECT concat('Entity ', cast(l_suppkey AS varchar(10))) AS entity, concat('cat', cast(l_partkey % 3 AS varchar(10))) AS category, concat('Unit ', cast(l_partkey % 40 AS varchar(10))) AS unit,
          year(l_shipdate) AS period, 'capacity' AS metric, l_orderkey * 10 + l_linenumber AS source_row, cast(cast(l_quantity AS bigint) AS varchar(20)) AS value
        FROM {lineitem} WHERE l_linenumber % 2 = 0""",
    "yearly_status": """
        SELECT o_custkey AS entity_id, year(o_orderdate) AS period, o_orderkey AS position, CASE o_orderkey % 4 WHEN 0 THEN 'excluded' WHEN 1 THEN 'collected' WHEN 2 THEN 'stale' ELSE 'error' END AS status
        FROM {orders}""",
    "evidence": """
        SELECT user_id AS entity_id, event_id AS position,
          CASE event_type WHEN 'signup' THEN 'accepted_downloaded' WHEN 'purchase' THEN 'target_fiscal_year_not_detected' WHEN 'error' THEN 'discovery_error' WHEN 'view' THEN 'candidate_budget_dropped'
            ELSE CASE event_id % 4 WHEN 0 THEN 'fiscal_year_mismatch:2023' WHEN 1 THEN 'no_candidates_found' WHEN 2 THEN 'pdf_entity_mismatch' ELSE 'non_target' END END AS reason,
          CASE event_id % 3 WHEN 0 THEN 'target' WHEN 1 THEN 'image_only' ELSE NULL END AS pdf_type, CASE event_id % 2 WHEN 0 THEN 'direct' ELSE 'wordpress' END AS pattern,
          concat('https://host', cast(event_id % 9 AS varchar(10)), '.example.com/files/', cast(2015 + event_id % 12 AS varchar(10)), '/form.pdf') AS url, 'form' AS text, 2026 AS target_period,
          CASE WHEN event_id % 7 = 0 THEN 'CERTIFICATE_VERIFY_FAILED' ELSE '' END AS error
        FROM {events}""",
    # names with owner prefixes, wide letters and spaces, old glyphs, a zero-width space, a variation selector, and suffixes
    "named": """
        SELECT c_custkey AS id, concat(
          CASE c_custkey % 5 WHEN 0 THEN '学校法人' WHEN 1 THEN '独立行政法人国立病院機構' WHEN 2 THEN '' WHEN 3 THEN ' 医療法人' ELSE '社会福祉法人　' END,
          CASE c_custkey % 3 WHEN 0 THEN '東京デザイン' WHEN 1 THEN 'ＡＢＣ＆ＩＴ' ELSE '髙澤ビューティー アンド' END,
          CASE WHEN c_custkey % 11 = 0 THEN '\u200b' WHEN c_custkey % 13 = 0 THEN '\ufe00' ELSE '' END, cast(c_custkey % 17 AS varchar(10)),
          CASE c_custkey % 7 WHEN 0 THEN '専門学校' WHEN 1 THEN '学校' WHEN 2 THEN '大学' WHEN 3 THEN '高等専門学校' WHEN 4 THEN '' WHEN 5 THEN '学科' ELSE ' コース　' END) AS name
        FROM {customer}""",
    "status": """
        SELECT entity_id, position, period, status, row_number() OVER (PARTITION BY entity_id, period ORDER BY position) AS revision,
          row_number() OVER (PARTITION BY entity_id, period ORDER BY position DESC) = 1 AS is_current
        FROM {yearly_status}""",
}


def _needs(name: str) -> list[str]:
    """Adapters that an adapter is made of, itself last."""
    out: list[str] = []
    for inner in re.findall(r"\{(\w+)\}", ADAPTERS[name]):
        if inner in ADAPTERS:
            out += [n for n in _needs(inner) if n not in out]
    return [*out, name]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, or an adapter over tables."""
    if name not in ADAPTERS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inner = set(re.findall(r"\{(\w+)\}", ADAPTERS[name]))
    return spark.sql(ADAPTERS[name], **{n: view(spark, sf_dir, n) for n in inner})


def sql(body: str, *names: str) -> str:
    """DuckDB SQL: body after the adapters that it names."""
    every: list[str] = []
    for name in names:
        every += [n for n in _needs(name) if n not in every]
    ctes = ", ".join(f"{n} AS ({ADAPTERS[n].strip()})" for n in every)
    for n in set(re.findall(r"\{(\w+)\}", ctes)):
        ctes = ctes.replace("{" + n + "}", n)
    body = body.strip()
    if not names:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
