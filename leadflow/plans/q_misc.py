"""Registered scalar, token-sink and reconciliation queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadflow.functions.arith import pct_half_even, pct_half_up
from leadflow.functions.scalars import event_ts_int, grouped, sanitize_id, zero_pad
from leadflow.functions.timecols import local_date, sql_date, sql_ts, ts_lit
from leadflow.operators import engagement as E
from leadflow.operators import leads as L
from leadflow.operators import payout as PO
from leadflow.operators import quality as Q
from leadflow.operators.tokens import clear_flags, profile_tokens
from leadflow.plans.catalog import query
from leadflow.plans.params import DEFAULT as P
from leadflow.plans.q_payout import NEW_LEADS_SQL, SETTLE_SQL_COLS, SETTLE_COLS, _route_input, _settled, settle_input_sql, settle_sql
from leadflow.plans.q_snapshot import snapshot_sql
from leadflow.plans.sqlparts import bucketed_sql, local_sql, tech_collapse_sql, tech_metric_sql
from leadflow.session import checkpoint_dir
from leadflow.sources import token_sink as TK
from leadflow.sources.testdata import tables
from leadflow.sources.testdata_sql import with_fixtures as W

C = F.col
OFFS = f"to_minutes(CAST({P.offset_minutes} AS BIGINT))"


@query("scalar_time", W(f"""
SELECT attempt_id, CAST(updated_at + {OFFS} AS DATE) AS local_day,
  CAST(date_trunc('month', CAST(updated_at + {OFFS} AS DATE)) AS DATE) AS month_start,
  CAST(date_trunc('month', CAST(updated_at + {OFFS} AS DATE)) + INTERVAL 1 MONTH AS DATE) AS next_month,
  CAST(CAST(updated_at AS DATE) - INTERVAL 120 DAY AS DATE) AS window_start
FROM f_attempts"""))
def scalar_time(spark, sf):
    t = tables(spark, sf)
    d = local_date(C("updated_at"), P.offset_minutes)
    return t.attempts.select("attempt_id", d.alias("local_day"), F.trunc(d, "month").alias("month_start"),
                             F.add_months(F.trunc(d, "month"), 1).alias("next_month"),
                             F.date_sub(C("updated_at").cast("date"), 120).alias("window_start"))


@query("scalar_conditional", W(f"""
SELECT partner_id, NULLIF(denom, 0) AS denom_or_null, COALESCE(t1_no, '-') AS first_ticket,
  CASE WHEN installs > 0 THEN 'some' ELSE 'none' END AS has_installs,
  CASE WHEN partner_id IN (SELECT partner_id FROM f_rosters WHERE category = 'enrolled') THEN 1 ELSE 0 END AS enrolled
FROM {snapshot_sql(P)} s"""))
def scalar_conditional(spark, sf):
    from leadflow.operators.cohorts import roster_label
    from leadflow.plans.q_snapshot import _snapshot
    t = tables(spark, sf)
    s = roster_label(_snapshot(spark, sf), t.rosters)
    return s.select("partner_id", F.nullif(C("denom"), F.lit(0)).alias("denom_or_null"),
                    F.coalesce(C("t1_no"), F.lit("-")).alias("first_ticket"),
                    F.when(C("installs") > 0, "some").otherwise("none").alias("has_installs"),
                    (C("category") == "enrolled").cast("int").alias("enrolled"))


@query("scalar_math", W(f"""
SELECT partner_id,
  CAST(CASE WHEN denom > 0 THEN ROUND(100.0 * installs / denom) ELSE 0 END AS BIGINT) AS pct_half_up,
  CAST(CASE WHEN denom > 0 THEN round_even(100.0 * installs / denom, 0) ELSE 0 END AS BIGINT) AS pct_half_even,
  CAST(CEIL(0.60 * denom) AS BIGINT) AS ceil_gate,
  CAST(GREATEST(0, {P.floor} - {P.rate} * installs) AS BIGINT) AS topup
FROM {snapshot_sql(P)} s"""))
def scalar_math(spark, sf):
    from leadflow.functions.arith import idiv
    from leadflow.plans.q_snapshot import _snapshot
    s = _snapshot(spark, sf)
    i, d = C("installs"), C("denom")
    return s.select("partner_id", pct_half_up(i, d).alias("pct_half_up"), pct_half_even(i, d).alias("pct_half_even"),
                    idiv(3 * d + 4, F.lit(5)).alias("ceil_gate"),
                    F.greatest(F.lit(0), F.lit(P.floor) - F.lit(P.rate) * i).cast("bigint").alias("topup"))


@query("scalar_string", W(f"""
SELECT s.partner_id,
  CASE WHEN length(CAST(s.user_id AS VARCHAR)) >= 6 THEN CAST(s.user_id AS VARCHAR) ELSE lpad(CAST(s.user_id AS VARCHAR), 6, '0') END AS banner_id,
  lower(a.account_name) AS account_lower, s.t1_no, '#' || right(s.t1_cid, 4) AS t1_no_rebuilt,
  format('{{:,}}', {P.rate} * s.installs) AS installpay_text
FROM {snapshot_sql(P)} s LEFT JOIN f_accounts a ON a.partner_id = s.partner_id"""))
def scalar_string(spark, sf):
    from leadflow.functions.leads import ticket_no
    from leadflow.plans.q_snapshot import _snapshot
    t = tables(spark, sf)
    s = _snapshot(spark, sf).join(t.accounts, "partner_id", "left")
    return s.select("partner_id", zero_pad(C("user_id"), 6).alias("banner_id"), F.lower("account_name").alias("account_lower"),
                    "t1_no", ticket_no(C("t1_cid")).alias("t1_no_rebuilt"),
                    grouped(F.lit(P.rate) * C("installs")).alias("installpay_text"))


@query("sanitize_id", W("SELECT partner_id, regexp_replace(lower(account_name), '[^a-z0-9]', '', 'g') AS clean_id FROM f_accounts"))
def sanitize_id_q(spark, sf):
    return tables(spark, sf).accounts.select("partner_id", sanitize_id(C("account_name")).alias("clean_id"))


@query("event_ts_int", W("""
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS ts_int,
  strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS ts_parsed,
  CAST(strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS DATE) AS day
FROM f_events"""))
def event_ts_int_q(spark, sf):
    ev = tables(spark, sf).events.select("event_id", F.date_format("ts", "yyyyMMddHHmmss").cast("bigint").alias("ts_int"))
    return ev.select("event_id", "ts_int", event_ts_int(C("ts_int")).alias("ts_parsed"),
                     event_ts_int(C("ts_int")).cast("date").alias("day"))


# The tokens of a profile, in order.
TOKENS = ["screen", "screen_real", "installs", "leads", "pending", "needed", "pct", "next_pct", "installpay", "topup", "days_left",
          "month", "id", "t1_no", "t1_area", "t1_cid", "t2_no", "t2_area", "t2_cid", "tkt_n"]
MONTH_WORD = "महीना "


def _banner(spark, sf):
    df = PO.gate_visibility(PO.standing(_route_input(spark, sf), P), ts_lit(P.as_of), P.offset_minutes)
    return PO.progress(df, P)


_TOKEN_SQL = {
    "screen": f"CASE WHEN hour({sql_ts(P.as_of)} + {OFFS}) < 11 THEN 'hold' ELSE screen END", "screen_real": "screen",
    "installs": "installs", "leads": "denom", "pending": "pending",
    "needed": "CAST(CASE WHEN denom > 0 THEN GREATEST(0, CEIL((3 * denom - 5 * installs) / 2.0)) WHEN pending > 0 THEN 1 ELSE 0 END AS BIGINT)",
    "pct": "CAST(CASE WHEN denom > 0 THEN ROUND(100.0 * installs / denom) ELSE 0 END AS BIGINT)",
    "next_pct": "CAST(ROUND(100.0 * (installs + 1) / (denom + 1)) AS BIGINT)", "installpay": f"format('{{:,}}', {P.rate} * installs)",
    "topup": f"GREATEST(0, {P.floor} - {P.rate} * installs)", "days_left": f"day(last_day({local_sql(sql_ts(P.as_of), P)})) - day({local_sql(sql_ts(P.as_of), P)})",
    "month": f"'{MONTH_WORD}' || GREATEST(1, month({local_sql(sql_ts(P.as_of), P)}) - 6)",
    "id": "lpad(CAST(ids.user_id AS VARCHAR), CAST(greatest(6, length(CAST(ids.user_id AS VARCHAR))) AS INTEGER), '0')",
    **{f"t{i}_{f}": f"t{i}_{f}" for i in (1, 2) for f in ("no", "area", "cid")},
    "tkt_n": "CAST(t1_no IS NOT NULL AS INTEGER) + CAST(t2_no IS NOT NULL AS INTEGER)",
}


_TOKENS_SQL = W(NEW_LEADS_SQL + f""",
ids AS (SELECT user_id, partner_id FROM f_users WHERE active AND status = 'ACTIVE' AND user_id IS NOT NULL
  AND role IN ('OWNER','MANAGER','MANAGER_PLUS')),
wide AS (SELECT ids.user_id, [{', '.join(f"coalesce(CAST({_TOKEN_SQL[t]} AS VARCHAR), '')" for t in TOKENS)}] AS vals FROM ids JOIN rt USING (partner_id))
SELECT user_id, 'banner_' || unnest([{', '.join(f"'{t}'" for t in TOKENS)}]) AS token, unnest(vals) AS value FROM wide""")


@query("profile_tokens", _TOKENS_SQL)
def profile_tokens_q(spark, sf):
    """K5: tokens per identity — every active user of the partner in the three roles."""
    from leadflow.operators.cohorts import identities
    banner = _banner(spark, sf)
    ids = identities(banner.select("partner_id"), tables(spark, sf).users)
    now = {c: x for c, x in zip(("day", "days_left", "days_in_month", "program_month"), PO.calendar(ts_lit(P.as_of), P.offset_minutes))}
    wide = ids.join(banner.drop("user_id"), "partner_id", "inner").select(
        "*", now["days_left"], F.concat(F.lit(MONTH_WORD), now["program_month"]).alias("month"), zero_pad(C("user_id"), 6).alias("id"),
        C("denom").alias("leads"), F.expr("int(t1_no IS NOT NULL) + int(t2_no IS NOT NULL)").alias("tkt_n"))
    return profile_tokens(wide.drop("installpay").withColumnRenamed("installpay_text", "installpay"), "user_id", TOKENS)


@query("token_delivery", _TOKENS_SQL)
def token_delivery(spark, sf):
    """K5 through the sink: what has arrived of a run that was sent twice."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    tokens = profile_tokens_q(spark, sf)
    for _ in range(2):  # as after a failure: the second time every batch is known
        TK.push(tokens, "banner", f"{out}/box", f"{out}/receipts", partitions=4)
    TK.receipt(spark, f"{out}/receipts", "banner")
    return TK.delivered(spark, f"{out}/box", "user_id bigint, token string, value string")


@query("clear_flags", W("""
fl AS (SELECT profile_id, 'opened_last_day' AS flag,
    CASE WHEN max(CASE WHEN event_name = 'banner_opened' THEN CAST(ts AS DATE) END) = (SELECT max(CAST(ts AS DATE)) FROM f_events)
         THEN 'true' ELSE 'false' END AS value
  FROM f_events GROUP BY profile_id)
SELECT profile_id, flag, 'false' AS value FROM fl WHERE value = 'true'"""))
def clear_flags_q(spark, sf):
    ev = tables(spark, sf).events
    last_day = ev.select(F.max(C("ts").cast("date"))).scalar()
    flags = ev.groupBy("profile_id").agg(
        F.max(F.when(C("event_name") == "banner_opened", C("ts").cast("date"))).alias("d"))
    flags = flags.select("profile_id", F.lit("opened_last_day").alias("flag"),
                         F.when(C("d") == last_day, "true").otherwise("false").alias("value"))
    return clear_flags(flags)


@query("metric_reconcile", W(f"""
a AS {tech_metric_sql(P)},
b AS (SELECT partner_id, count(*) FILTER (WHERE last_date >= {sql_date(P.month_start)} AND last_date < {sql_date(P.month_end)}
          AND bucket = 'installed' AND reached_slot = 1) AS installs,
        count(*) FILTER (WHERE last_date >= {sql_date(P.month_start)} AND last_date < {sql_date(P.month_end)}
          AND reached_slot = 1 AND bucket NOT IN ('open','system_other')) AS denom
      FROM ({bucketed_sql(P, 'full')}) x GROUP BY partner_id)
SELECT COALESCE(a.partner_id, b.partner_id) AS partner_id,
  CAST(COALESCE(a.installs, 0) AS BIGINT) AS a_installs, CAST(COALESCE(b.installs, 0) AS BIGINT) AS b_installs,
  CAST(COALESCE(a.denom, 0) AS BIGINT) AS a_denom, CAST(COALESCE(b.denom, 0) AS BIGINT) AS b_denom
FROM a FULL OUTER JOIN b ON a.partner_id = b.partner_id
WHERE COALESCE(a.installs, 0) <> COALESCE(b.installs, 0) OR COALESCE(a.denom, 0) <> COALESCE(b.denom, 0)"""))
def metric_reconcile(spark, sf):
    t = tables(spark, sf)
    a = L.metric_tech(t.attempts, P)
    b = L.metric_slot(L.bucketed_window(t.attempts, P), P.month_start, P.month_end)
    return Q.metric_reconcile(a, b, "partner_id", ["installs", "denom"])


@query("subset_check", W(f"SELECT connection_id, partner_id FROM ({tech_collapse_sql(P)}) c WHERE has_installed = 1 AND tech_assigned = 0"))
def subset_check(spark, sf):
    t = tables(spark, sf)
    leads = L.collapse_attempts(L.active_attempts(t.attempts, P.as_of, None), P.offset_minutes)
    return Q.subset_check(leads).select("connection_id", "partner_id")


@query("coverage_gate", W("""
reached AS (SELECT r.partner_id, r.partner_id IN (SELECT partner_id FROM f_profiles WHERE NOT coalesce(deleted, false)) AS ok
  FROM f_rosters r WHERE r.category = 'enrolled')
SELECT count(*) AS cohort, count(*) FILTER (WHERE ok) AS resolvable, count(*) FILTER (WHERE NOT ok) <= 5 AS passed FROM reached"""))
def coverage_gate(spark, sf):
    """Q4 with a slack of 5 partners: the row says whether a run may publish."""
    t = tables(spark, sf)
    cohort = t.rosters.where(C("category") == "enrolled").select("partner_id")
    return Q.coverage_gate(cohort, E.profile_bridge(t.profiles).select("partner_id"), "partner_id", slack=5)


@query("unresolved_cohort", W("""
SELECT partner_id FROM f_rosters WHERE category = 'enrolled'
  AND partner_id NOT IN (SELECT partner_id FROM f_profiles WHERE NOT coalesce(deleted, false) AND partner_id IS NOT NULL)"""))
def unresolved_cohort(spark, sf):
    t = tables(spark, sf)
    cohort = t.rosters.where(C("category") == "enrolled").select("partner_id")
    return Q.unresolved(cohort, E.profile_bridge(t.profiles).select("partner_id"), "partner_id")


@query("bridge_fanout", W("""
SELECT partner_id, count(DISTINCT profile_id) AS profiles,
  count(DISTINCT profile_id) FILTER (WHERE profile_id IN (
    SELECT profile_id FROM f_profiles GROUP BY profile_id HAVING count(DISTINCT partner_id) > 1)) AS shared_profiles
FROM f_profiles WHERE partner_id IS NOT NULL GROUP BY partner_id"""))
def bridge_fanout(spark, sf):
    t = tables(spark, sf)
    bridge = t.profiles.where(C("partner_id").isNotNull()).select("profile_id", "partner_id")
    fan = Q.bridge_fanout(bridge).select("profile_id", F.lit(True).alias("_shared"))
    j = bridge.join(fan, "profile_id", "left")
    return j.groupBy("partner_id").agg(F.countDistinct("profile_id").alias("profiles"),
                                       F.countDistinct(F.when(C("_shared"), C("profile_id"))).alias("shared_profiles"))


@query("test_partner_exclude", W(settle_input_sql(P) + f"""
SELECT {SETTLE_SQL_COLS} FROM {settle_sql('SELECT * FROM inp')} x
WHERE partner_id NOT IN (SELECT partner_id FROM f_rosters WHERE is_test)"""))
def test_partner_exclude(spark, sf):
    return Q.exclude_test(_settled(spark, sf), tables(spark, sf).rosters).select(*SETTLE_COLS)
