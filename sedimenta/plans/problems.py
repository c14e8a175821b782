"""Queries of the general data problems, with SQL where whole tables allow it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.asof import event_versions
from sedimenta.operators.history import merged_history, program_history, program_states
from sedimenta.operators.snapshot_diff import snapshot_changes
from sedimenta.operators.spikes import implausible_readings
from sedimenta.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "capture_asset"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return event_versions(
        table(spark, d, "change_event"), table(spark, d, "program_indication"), table(spark, d, "program_born_on")
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return program_history(table(spark, d, "program_observation"))


def p4_merged(spark: SparkSession, d: str) -> DataFrame:
    """The history of four deliveries of about a quarter of the records each, late rows and corrections among them."""
    states = program_states(table(spark, d, "program_observation"))
    quarters = states.agg(F.percentile_approx(F.unix_micros(F.col("recorded_at").cast("timestamp")), [0.25, 0.5, 0.75])).first()[0]
    return merged_history(states, [datetime(1970, 1, 1) + timedelta(microseconds=q) for q in quarters or []])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return implausible_readings(table(spark, d, "capture_stats"))


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p4_found, p4_merged, p6_found)}

_STATES = """
WITH o AS (
  SELECT program_id, indication_id, company_id, observed_at, recorded_at, lower(trim(phase)) AS phase, lower(trim(status)) AS status
  FROM program_observation WHERE phase IS NOT NULL AND observed_at IS NOT NULL),
l AS (
  SELECT * FROM o QUALIFY row_number() OVER (
    PARTITION BY program_id, indication_id, company_id, observed_at ORDER BY recorded_at DESC, phase DESC, status DESC) = 1),
g AS (
  SELECT *, lag(phase) OVER w AS pp, lag(status) OVER w AS ps, lag(observed_at) OVER w AS po FROM l
  WINDOW w AS (PARTITION BY program_id, indication_id, company_id ORDER BY observed_at)),
v AS (
  SELECT *, lead(observed_at) OVER (PARTITION BY program_id, indication_id, company_id ORDER BY observed_at) AS next_at
  FROM g WHERE po IS NULL OR pp IS DISTINCT FROM phase OR ps IS DISTINCT FROM status)
"""

SQL = {
    "p2_found": """
WITH r AS (
  SELECT DISTINCT capture_id, source_id, captured_at, asset_id, loaded_at, nullif(lower(trim(phase_code)), '') AS phase,
    list_sort(list_distinct(coalesce(partners, []))) AS partners
  FROM capture_asset WHERE asset_id IS NOT NULL),
cur AS (
  SELECT * FROM r QUALIFY row_number() OVER (
    PARTITION BY capture_id, asset_id ORDER BY loaded_at DESC, phase DESC, partners DESC) = 1),
cap AS (
  SELECT capture_id, lag(capture_id) OVER (PARTITION BY source_id ORDER BY captured_at, capture_id) AS prev
  FROM (SELECT DISTINCT capture_id, source_id, captured_at FROM r)),
b AS (SELECT cap.capture_id, cur.asset_id, cur.phase, cur.partners FROM cap JOIN cur USING (capture_id) WHERE prev IS NOT NULL),
a AS (SELECT cap.capture_id, cur.asset_id, cur.phase, cur.partners FROM cap JOIN cur ON cur.capture_id = cap.prev),
j AS (
  SELECT coalesce(a.capture_id, b.capture_id) AS capture_id, coalesce(a.asset_id, b.asset_id) AS asset_id,
    a.asset_id IS NOT NULL AS before, b.asset_id IS NOT NULL AS after, a.phase AS pa, b.phase AS pb, a.partners AS ra, b.partners AS rb
  FROM a FULL JOIN b ON a.capture_id = b.capture_id AND a.asset_id = b.asset_id)
SELECT capture_id, asset_id, 'asset_added' AS change_type FROM j WHERE NOT before
UNION ALL SELECT capture_id, asset_id, 'asset_left_pipeline' FROM j WHERE NOT after
UNION ALL SELECT capture_id, asset_id, 'asset_phase_changed' FROM j WHERE before AND after AND pa IS DISTINCT FROM pb
UNION ALL SELECT capture_id, asset_id, 'partner_added' FROM j
  WHERE before AND after AND len(list_filter(rb, lambda x: NOT list_contains(ra, x))) > 0
UNION ALL SELECT capture_id, asset_id, 'partner_removed' FROM j
  WHERE before AND after AND len(list_filter(ra, lambda x: NOT list_contains(rb, x))) > 0
""",
    "p3_found": """
WITH e AS (SELECT DISTINCT event_id, program_id, indication_id, company_id, event_at FROM change_event WHERE event_at IS NOT NULL),
v AS (SELECT DISTINCT version_id, program_id, indication_id, company_id, valid_from, valid_to, recorded_at FROM program_indication),
b AS (SELECT program_id, min(born_on) AS born FROM program_born_on GROUP BY 1)
SELECT event_id, version_id FROM e JOIN b USING (program_id) JOIN v USING (program_id, indication_id, company_id)
WHERE born <= event_at AND valid_from <= event_at AND (valid_to IS NULL OR valid_to > event_at) AND recorded_at <= event_at
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY valid_from DESC, recorded_at DESC, version_id DESC) = 1
""",
    "p4_found": _STATES
    + """
SELECT program_id, indication_id, company_id, phase, status, strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS valid_from,
  coalesce(strftime(next_at, '%Y-%m-%d %H:%M:%S'), '') AS valid_to FROM v
""",
    "p4_merged": _STATES
    + """
SELECT program_id, indication_id, company_id, phase, status, observed_at AS valid_from, next_at AS valid_to FROM v
""",
}
