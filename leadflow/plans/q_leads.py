"""Registered lead-lifecycle queries (sources S1-S2, predicates F1-F4/F7/F9-F11, metrics A1-A7, W1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadflow.functions.leads import flag, is_installed, is_on_time, is_open_ticket, lead_bucket
from leadflow.functions.timecols import local_date, sql_date
from leadflow.operators import leads as L
from leadflow.plans.catalog import query
from leadflow.plans.params import DEFAULT as P
from leadflow.plans.sqlparts import (INSTALLED_FUNNEL_SQL, INSTALLED_SQL, active_sql, bucket_sql, bucketed_sql, collapse_sql,
                                     dedupe_ledger_sql, in_month_sql, ledger_metric_sql, local_range_sql, open_states_sql,
                                     tech_collapse_sql, tech_metric_sql)
from leadflow.sources.testdata import tables
from leadflow.sources.testdata_sql import with_fixtures as W

OFF = P.offset_minutes


@query("scan_active_attempts", W(f"""
SELECT attempt_id, connection_id, partner_id, current_state, updated_at FROM ({active_sql(P, P.window_days)}) a"""))
def scan_active_attempts(spark, sf):
    t = tables(spark, sf)
    return L.active_attempts(t.attempts, P.as_of, P.window_days).select(
        "attempt_id", "connection_id", "partner_id", "current_state", "updated_at")


@query("scan_ledger_month", W(f"""
SELECT ledger_id, connection_id, partner_id, terminal_outcome, terminal_at FROM f_ledger
WHERE partner_id IS NOT NULL AND {local_range_sql('terminal_at', P.month_start, P.month_end, OFF)}"""))
def scan_ledger_month(spark, sf):
    t = tables(spark, sf)
    return L.ledger_month(t.ledger, P.month_start, P.month_end, OFF).select(
        "ledger_id", "connection_id", "partner_id", "terminal_outcome", "terminal_at")


@query("flag_installed", W(f"""
SELECT attempt_id, CASE WHEN {INSTALLED_SQL} THEN 1 ELSE 0 END AS installed,
  CASE WHEN {INSTALLED_FUNNEL_SQL} THEN 1 ELSE 0 END AS installed_funnel FROM f_attempts"""))
def flag_installed(spark, sf):
    t = tables(spark, sf)
    return t.attempts.select("attempt_id", flag(is_installed(True)).alias("installed"),
                             flag(is_installed(False)).alias("installed_funnel"))


@query("latest_attempt", W(f"SELECT * FROM ({collapse_sql(active_sql(P, P.window_days))}) c"))
def latest_attempt(spark, sf):
    t = tables(spark, sf)
    return L.collapse_attempts(L.active_attempts(t.attempts, P.as_of, P.window_days), OFF)


@query("current_slot_flag", W(f"""
SELECT partner_id, count(*) AS leads, CAST(sum(reached_slot) AS BIGINT) AS sticky_slot,
  CAST(sum(own_slot_latest) AS BIGINT) AS current_slot
FROM ({collapse_sql(active_sql(P, P.window_days))}) c GROUP BY partner_id"""))
def current_slot_flag(spark, sf):
    t = tables(spark, sf)
    c = L.collapse_attempts(L.active_attempts(t.attempts, P.as_of, P.window_days), OFF)
    return c.groupBy("partner_id").agg(F.count(F.lit(1)).alias("leads"), F.sum("reached_slot").alias("sticky_slot"),
                                       F.sum("own_slot_latest").alias("current_slot"))


@query("bucket_leads", W(f"""
SELECT connection_id, partner_id, {bucket_sql('full')} AS bucket, {bucket_sql('legacy')} AS bucket_legacy
FROM ({collapse_sql(active_sql(P, P.window_days))}) c"""))
def bucket_leads(spark, sf):
    t = tables(spark, sf)
    c = L.collapse_attempts(L.active_attempts(t.attempts, P.as_of, P.window_days), OFF)
    return c.select("connection_id", "partner_id", lead_bucket("full").alias("bucket"),
                    lead_bucket("legacy").alias("bucket_legacy"))


@query("stage_flags", W("""
SELECT attempt_id,
  CASE WHEN proposed_slot_date IS NOT NULL THEN 1 ELSE 0 END AS slot_proposed,
  CASE WHEN confirmed_slot_at IS NOT NULL THEN 1 ELSE 0 END AS slot_confirmed,
  CASE WHEN executor_id IS NOT NULL THEN 1 ELSE 0 END AS tech,
  CASE WHEN current_state = 'ARRIVED_AT_SITE' OR completed_step >= 1 THEN 1 ELSE 0 END AS arrived,
  CASE WHEN coalesce(otp_verified, false) OR coalesce(completed_step >= 7, false) THEN 1 ELSE 0 END AS installed
FROM f_attempts"""))
def stage_flags(spark, sf):
    from leadflow.operators import funnels as FN
    return FN.stage_flags(tables(spark, sf).attempts).select(
        "attempt_id", "slot_proposed", "slot_confirmed", "tech", "arrived", "installed")


@query("month_flag_ist", W(f"""
SELECT attempt_id, CAST(updated_at + to_minutes(CAST({OFF} AS BIGINT)) AS DATE) AS local_day,
  CASE WHEN {local_range_sql('updated_at', P.month_start, P.month_end, OFF)} THEN 1 ELSE 0 END AS in_month
FROM f_attempts"""))
def month_flag_ist(spark, sf):
    from leadflow.functions.timecols import in_local_range
    t = tables(spark, sf)
    return t.attempts.select("attempt_id", local_date(F.col("updated_at"), OFF).alias("local_day"),
                             flag(in_local_range(F.col("updated_at"), P.month_start, P.month_end, OFF)).alias("in_month"))


@query("open_ticket_filter", W(f"""
SELECT attempt_id, partner_id, current_state FROM ({active_sql(P, None)}) a
WHERE current_state IN (SELECT state FROM {open_states_sql()})"""))
def open_ticket_filter(spark, sf):
    t = tables(spark, sf)
    return L.active_attempts(t.attempts, P.as_of, None).where(is_open_ticket()).select(
        "attempt_id", "partner_id", "current_state")


@query("ontime_flag", W(f"""
SELECT attempt_id, CASE WHEN {INSTALLED_SQL} AND installation_completed_at IS NOT NULL AND confirmed_slot_date IS NOT NULL
  AND CAST(installation_completed_at + to_minutes(CAST({OFF} AS BIGINT)) AS DATE) <= confirmed_slot_date THEN 1 ELSE 0 END AS on_time
FROM f_attempts"""))
def ontime_flag(spark, sf):
    t = tables(spark, sf)
    return t.attempts.select("attempt_id", flag(is_on_time(OFF)).alias("on_time"))


@query("metric_tech", W(f"SELECT * FROM {tech_metric_sql(P)} m"))
def metric_tech(spark, sf):
    t = tables(spark, sf)
    return L.metric_tech(t.attempts, P)


@query("metric_tech_since_enrolment", W(f"""
joined AS (SELECT partner_id, min(joined) AS day FROM f_overlay GROUP BY partner_id),
every_lead AS ({tech_collapse_sql(P)})
SELECT every_lead.partner_id,
  count(*) FILTER (WHERE {in_month_sql(P)} AND has_installed = 1 AND (joined.day IS NULL OR last_date >= joined.day)) AS installs,
  count(*) FILTER (WHERE {in_month_sql(P)} AND tech_assigned = 1 AND (joined.day IS NULL OR last_date >= joined.day)) AS denom
FROM every_lead LEFT JOIN joined USING (partner_id) GROUP BY every_lead.partner_id"""))
def metric_tech_since_enrolment(spark, sf):
    t = tables(spark, sf)
    return L.metric_tech(t.attempts, P, since_enrolment=t.overlay.select("partner_id", "joined"))


@query("impacted_exclusion", W("SELECT * FROM " + tech_metric_sql(
    P, "(has_installed = 1 OR connection_id NOT IN (SELECT connection_id FROM f_impacted))") + " m"))
def impacted_exclusion(spark, sf):
    t = tables(spark, sf)
    return L.metric_tech(t.attempts, P, impacted=t.impacted)


@query("dedupe_ledger", W(dedupe_ledger_sql(P)))
def dedupe_ledger(spark, sf):
    t = tables(spark, sf)
    return L.dedupe_ledger(t.ledger, P)


_ONTIME_COLS = """partner_id, ontime, late, installs, denom,
  CAST(CASE WHEN denom > 0 THEN floor((200 * ontime + denom) / (2 * denom)) ELSE 0 END AS BIGINT) AS pct,
  CAST(CASE WHEN denom > 0 THEN greatest(0, ceil((0.60 * denom - ontime) / 0.40)) ELSE 0 END AS BIGINT) AS needed"""


@query("metric_ontime", W(f"SELECT {_ONTIME_COLS} FROM {ledger_metric_sql(P)} m"))
def metric_ontime(spark, sf):
    t = tables(spark, sf)
    return L.metric_ontime(t.ledger, P)


@query("metric_ontime_impacted", W(f"SELECT {_ONTIME_COLS} FROM " + ledger_metric_sql(
    P, "w.on_time + w.is_late = 0 AND d.connection_id IN (SELECT connection_id FROM f_impacted)") + " m"))
def metric_ontime_impacted(spark, sf):
    t = tables(spark, sf)
    return L.metric_ontime(t.ledger, P, impacted=t.impacted)


@query("metric_slot", W(f"""
b AS ({bucketed_sql(P, 'full')})
SELECT partner_id,
  CAST(count(*) FILTER (WHERE {in_month_sql(P)} AND bucket = 'installed' AND reached_slot = 1) AS BIGINT) AS installs,
  CAST(count(*) FILTER (WHERE {in_month_sql(P)} AND reached_slot = 1 AND bucket NOT IN ('open','system_other')) AS BIGINT) AS denom,
  CAST(count(*) FILTER (WHERE bucket = 'open') AS BIGINT) AS pending
FROM b GROUP BY partner_id"""))
def metric_slot(spark, sf):
    t = tables(spark, sf)
    return L.metric_slot(L.bucketed_window(t.attempts, P), P.month_start, P.month_end)


@query("open_pipeline", W(f"""
b AS ({bucketed_sql(P, 'full')})
SELECT partner_id, CAST(count(*) FILTER (WHERE bucket = 'open') AS BIGINT) AS pending,
  CAST(count(*) FILTER (WHERE bucket = 'open' AND own_slot_latest = 1) AS BIGINT) AS committed
FROM b GROUP BY partner_id"""))
def open_pipeline(spark, sf):
    t = tables(spark, sf)
    return L.open_pipeline(L.bucketed_window(t.attempts, P))


_GATE_SQL = f"""
b AS ({bucketed_sql(P, 'full')}),
tl AS (SELECT DISTINCT attempt_id FROM f_transitions WHERE to_state = 'TECHNICIAN_ASSIGNED'),
g AS (
  SELECT b.*, CAST(CASE WHEN CAST(offered + to_minutes(CAST({OFF} AS BIGINT)) AS DATE) <= {sql_date(P.s4_cutoff)}
                   THEN reached_slot ELSE CASE WHEN tl.attempt_id IS NOT NULL THEN 1 ELSE 0 END END AS INTEGER) AS gate_ok
  FROM b LEFT JOIN tl ON tl.attempt_id = b.rep_attempt_id)"""


@query("s4_hybrid_gate", W(_GATE_SQL + "\nSELECT connection_id, partner_id, bucket, gate_ok FROM g"))
def s4_hybrid_gate(spark, sf):
    t = tables(spark, sf)
    return L.hybrid_gate(L.bucketed_window(t.attempts, P), t.transitions, P.s4_cutoff, OFF).select(
        "connection_id", "partner_id", "bucket", "gate_ok")


@query("metric_s4", W(_GATE_SQL + f"""
SELECT partner_id,
  CAST(count(*) FILTER (WHERE {in_month_sql(P)} AND bucket = 'installed' AND gate_ok = 1) AS BIGINT) AS installs,
  CAST(count(*) FILTER (WHERE {in_month_sql(P)} AND gate_ok = 1 AND bucket NOT IN ('open','system_other')) AS BIGINT) AS denom
FROM g GROUP BY partner_id"""))
def metric_s4(spark, sf):
    t = tables(spark, sf)
    g = L.hybrid_gate(L.bucketed_window(t.attempts, P), t.transitions, P.s4_cutoff, OFF)
    return L.metric_s4(g, P.month_start, P.month_end)
