"""Registered snapshot queries."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from leadflow.functions.timecols import ts_lit
from leadflow.operators import leads as L
from leadflow.operators import snapshot as S
from leadflow.operators.partials import LeadPartials, buckets_for, touched_days
from leadflow.plans.catalog import query
from leadflow.plans.params import DEFAULT as P
from leadflow.plans.params import Params
from leadflow.plans.sqlparts import active_sql, bucketed_sql, ledger_metric_sql, open_states_sql, tech_metric_sql, values_sql
from leadflow.session import checkpoint_dir
from leadflow.sources import snapshots as SNAP
from leadflow.sources.testdata import tables
from leadflow.sources.testdata_sql import with_fixtures as W

PREV = replace(P, month_start=P.prev_start, month_end=P.month_start,
               as_of=dt.datetime.combine(P.month_start, dt.time()) - dt.timedelta(minutes=P.offset_minutes))


def tickets_sql(p: Params) -> str:
    """Per partner its two foremost open tickets, as an ordered list of structs."""
    return f"""SELECT partner_id, list(struct_pack(id := attempt_id, zone := zone_id, rnk := rnk) ORDER BY rnk DESC, updated_at, attempt_id)[1:2] AS top
  FROM ({active_sql(p, None)}) live JOIN {open_states_sql()} ON live.current_state = open_state.state GROUP BY partner_id"""


def pivot_sql(p: Params) -> str:
    cols = ", ".join(f"'#' || right(top[{i}].id, 4) AS t{i}_no, top[{i}].zone AS t{i}_area, top[{i}].id AS t{i}_cid" for i in (1, 2))
    return f"SELECT partner_id, {cols} FROM ({tickets_sql(p)}) lists"


OWNER_SQL = f"""SELECT partner_id, list(CAST(user_id AS VARCHAR) ORDER BY pref DESC, CAST(user_id AS VARCHAR) DESC)[1] AS user_id
  FROM f_users JOIN {values_sql(S.ROLE_RANK.items())} wanted(role_name, pref) ON role = role_name
  WHERE active AND status = 'ACTIVE' AND user_id IS NOT NULL GROUP BY partner_id"""


def agg_sql(p: Params) -> str:
    """The three sources under one another, gaps as zeros, summed by partner (nests as a table)."""
    return f"""(WITH piled AS (
  SELECT partner_id, installs, denom, 0 AS pending, 0 AS committed, 0 AS ontime_m1, 0 AS late_m1, 0 AS leads_m1 FROM {tech_metric_sql(p)} m
  UNION ALL SELECT partner_id, 0, 0, CAST(bucket = 'open' AS BIGINT), CAST(bucket = 'open' AND own_slot_latest = 1 AS BIGINT), 0, 0, 0
    FROM ({bucketed_sql(p, 'full')}) b
  UNION ALL SELECT partner_id, 0, 0, 0, 0, ontime, late, denom FROM {ledger_metric_sql(p)} l)
SELECT partner_id, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in S.METRIC_COLS)} FROM piled GROUP BY partner_id)"""


ENROLLED_SQL = "(SELECT DISTINCT partner_id FROM f_overlay WHERE joined IS NOT NULL)"


def snapshot_sql(p: Params) -> str:
    return f"""(SELECT a.partner_id, o.user_id, {', '.join('a.' + c for c in S.METRIC_COLS)}, {', '.join('tk.' + c for c in S.TICKET_COLS)}
FROM {agg_sql(p)} a
LEFT JOIN ({pivot_sql(p)}) tk USING (partner_id)
LEFT JOIN ({OWNER_SQL}) o USING (partner_id)
WHERE a.installs + a.denom + a.pending + a.leads_m1 > 0 OR a.partner_id IN {ENROLLED_SQL})"""


def _measures(spark, sf, p: Params = P):
    """The month record with ``new_leads``."""
    t = tables(spark, sf)
    return S.month_snapshot(t.attempts, t.ledger, t.users, t.overlay.where(F.col("joined").isNotNull()), p)


def _snapshot(spark, sf, p: Params = P):
    return _measures(spark, sf, p).drop("new_leads")


@query("ticket_topk", W(f"""
SELECT partner_id, one.id AS attempt_id, one.zone AS zone_id, one.rnk AS rnk, CAST(rn AS INTEGER) AS rn
FROM (SELECT partner_id, unnest(top) AS one, generate_subscripts(top, 1) AS rn FROM ({tickets_sql(P)}) lists) x"""))
def ticket_topk(spark, sf):
    t = tables(spark, sf)
    return S.top_tickets(L.active_attempts(t.attempts, P.as_of, None)).select("partner_id", "attempt_id", "zone_id", "rnk", "rn")


@query("ticket_pivot", W(pivot_sql(P)))
def ticket_pivot(spark, sf):
    t = tables(spark, sf)
    return S.pivot_tickets(S.top_tickets(L.active_attempts(t.attempts, P.as_of, None)))


@query("owner_pick", W(OWNER_SQL))
def owner_pick(spark, sf):
    return S.owner_of(tables(spark, sf).users)


@query("full_outer_sources", W(f"SELECT * FROM {agg_sql(P)} a"))
def full_outer_sources(spark, sf):
    t = tables(spark, sf)
    return S.merge_sources(L.metric_tech(t.attempts, P), L.open_pipeline(L.bucketed_window(t.attempts, P)),
                           L.metric_ontime(t.ledger, P))


@query("final_assemble", W(f"SELECT * FROM {snapshot_sql(P)} s"))
def final_assemble(spark, sf):
    return _snapshot(spark, sf)


def _lead_partials(spark, sf, p: Params = P) -> LeadPartials:
    """The store as two refreshes leave it: all attempts up to a day of July, then the days that later attempts touch."""
    t = tables(spark, sf)
    name = f"partials_{uuid.uuid4().hex}"
    window = p.as_of.date() - dt.timedelta(days=p.window_days)
    store = LeadPartials.create(spark, name, f"{checkpoint_dir(spark).rstrip('/')}/{name}", buckets=buckets_for(t.attempts), folded_before=window.replace(day=1))
    first = dt.datetime.combine(p.month_start, dt.time(9, 30)) + dt.timedelta(days=19)
    store.refresh(t.attempts, first)
    later = L.active_attempts(t.attempts.where(F.col("updated_at") >= ts_lit(first)), p.as_of, days=None)
    store.refresh(t.attempts, p.as_of, touched_days(later))
    return store


@query("metric_tech_partials", W(f"SELECT * FROM {tech_metric_sql(P)} m"))
def metric_tech_partials(spark, sf):
    return L.metric_tech(None, P, leads=_lead_partials(spark, sf).month_history(P))


@query("final_assemble_partials", W(f"SELECT * FROM {snapshot_sql(P)} s"))
def final_assemble_partials(spark, sf):
    t = tables(spark, sf)
    return S.month_snapshot_of(_lead_partials(spark, sf), t.ledger, t.users, t.overlay.where(F.col("joined").isNotNull()), P).drop("new_leads")


@query("rank_output", W(f"SELECT partner_id, installs, denom FROM {snapshot_sql(P)} s ORDER BY installs DESC, denom DESC, partner_id"))
def rank_output(spark, sf):
    return S.rank_output(_snapshot(spark, sf)).select("partner_id", "installs", "denom")


_TICKETS_JSON = """CASE
  WHEN t1_no IS NULL AND t2_no IS NULL THEN '[]'
  WHEN t2_no IS NULL THEN '[{"no":"' || t1_no || '","area":"' || t1_area || '","cid":"' || t1_cid || '"}]'
  ELSE '[{"no":"' || t1_no || '","area":"' || t1_area || '","cid":"' || t1_cid || '"},{"no":"' || t2_no
       || '","area":"' || t2_area || '","cid":"' || t2_cid || '"}]' END"""


@query("snapshot_nested", W(f"""
SELECT partner_id, coalesce(user_id, '') AS user_id, installs, denom, pending, committed, ontime_m1, late_m1, leads_m1,
  CAST((t1_no IS NOT NULL) AS INTEGER) + CAST((t2_no IS NOT NULL) AS INTEGER) AS n_tickets,
  {_TICKETS_JSON} AS tickets_json
FROM {snapshot_sql(P)} s"""))
def snapshot_nested(spark, sf):
    rec = S.to_snapshot(_snapshot(spark, sf))
    return rec.select("partner_id", "user_id", *S.METRIC_COLS, F.size("tickets").alias("n_tickets"),
                      F.to_json("tickets").alias("tickets_json"))


def _frozen_store(spark, sf) -> str:
    """Build June then July into a fresh folder under the shared checkpoint dir; June is then frozen."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/snapshots-{uuid.uuid4().hex}"
    SNAP.write_month(_snapshot(spark, sf, PREV), path, PREV.month_ym)
    SNAP.write_month(_snapshot(spark, sf, P), path, P.month_ym, frozen=[PREV.month_ym])
    try:  # a rebuild of the disbursed month must be refused, whoever asks, and leave it untouched
        SNAP.write_month(_snapshot(spark, sf, P), path, PREV.month_ym)
        raise AssertionError("frozen month was rewritten")
    except SNAP.FrozenMonthError:
        pass
    return path


@query("point_lookup", W(f"""
SELECT asked.partner_id, coalesce(s.installs, 0) AS installs, coalesce(s.denom, 0) AS denom, coalesce(s.pending, 0) AS pending,
  coalesce(s.committed, 0) AS committed, CAST(s.partner_id IS NOT NULL AS INTEGER) AS found
FROM (SELECT partner_id FROM f_rosters UNION SELECT partner_id + 1000000 FROM f_rosters) asked
LEFT JOIN {snapshot_sql(P)} s USING (partner_id)"""))
def point_lookup(spark, sf):
    t = tables(spark, sf)
    # every partner, and as many ids that nobody has, looked up in the month as it was written
    ids = t.rosters.select("partner_id").unionByName(t.rosters.select((F.col("partner_id") + 1000000).alias("partner_id")))
    return S.lookup(SNAP.read_month(spark, _frozen_store(spark, sf), P.month_ym, default=PREV.month_ym), ids)


@query("snapshot_month_freeze", W(f"""
SELECT *, '{PREV.month_ym}' AS month FROM {snapshot_sql(PREV)} a
UNION ALL SELECT *, '{P.month_ym}' AS month FROM {snapshot_sql(P)} b"""))
def snapshot_month_freeze(spark, sf):
    path = _frozen_store(spark, sf)
    return SNAP.read_months(spark, path).select("partner_id", "user_id", *S.METRIC_COLS, *S.TICKET_COLS, "month")


@query("read_month", W(f"SELECT *, '{PREV.month_ym}' AS month FROM {snapshot_sql(PREV)} a"))
def read_month(spark, sf):
    path = _frozen_store(spark, sf)
    # an unknown month falls back to the default (the closed month)
    df = SNAP.read_month(spark, path, "1998-13", default=PREV.month_ym)
    return df.select("partner_id", "user_id", *S.METRIC_COLS, *S.TICKET_COLS, F.col("month").cast("string").alias("month"))


_CMP = list(S.METRIC_COLS) + list(S.TICKET_COLS) + ["user_id"]


@query("snapshot_change_detect", W(f"""
SELECT COALESCE(o.partner_id, n.partner_id) AS partner_id,
  CASE WHEN o.partner_id IS NULL THEN 'added' WHEN n.partner_id IS NULL THEN 'removed' ELSE 'changed' END AS kind
FROM {snapshot_sql(PREV)} o FULL OUTER JOIN {snapshot_sql(P)} n ON o.partner_id = n.partner_id
WHERE o.partner_id IS NULL OR n.partner_id IS NULL OR NOT ({' AND '.join(f'o.{c} IS NOT DISTINCT FROM n.{c}' for c in _CMP)})"""))
def snapshot_change_detect(spark, sf):
    # both months as they were published, by their checksums first
    return SNAP.changed_between(spark, _frozen_store(spark, sf), PREV.month_ym, P.month_ym, _CMP)
