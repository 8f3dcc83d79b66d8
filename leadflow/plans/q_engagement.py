"""Registered engagement / funnel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadflow.functions.joins import left_fill
from leadflow.functions.timecols import date_lit, sql_date, sql_ts
from leadflow.operators import engagement as E
from leadflow.operators import payout as PO
from leadflow.operators.cohorts import in_roster, not_in_roster
from leadflow.plans.catalog import query
from leadflow.plans.params import DEFAULT as P
from leadflow.plans.q_payout import NEW_LEADS_SQL, _route_input, _settled, settle_input_sql, settle_sql
from leadflow.plans.sqlparts import INSTALLED_FUNNEL_SQL
from leadflow.sources.testdata import tables
from leadflow.sources.testdata_sql import with_fixtures as W

C = F.col
EV0 = sql_ts(P.events_since)
ENG0 = sql_ts(P.engagement_start)
TASK0 = sql_ts(P.funnel_since)


def _t(spark, sf):
    return tables(spark, sf)


def _roster(t):
    return t.rosters.where(C("category") == "enrolled").select("partner_id")


def _clicks_ev(t):
    return E.attribute(E.events_since(t.events, "banner_opened", P.events_since), E.profile_bridge(t.profiles, undeleted=False))


def _per_profile(t):
    return E.per_profile(t.events, "banner_opened", P.events_since)


def _bridge_all(t):
    return E.profile_bridge(t.profiles, undeleted=False)


# per profile opens, per partner clicks and tasks; then partners with clicks labelled by the roster
FACTS_SQL = f"""
device AS (SELECT DISTINCT profile_id, partner_id FROM f_profiles WHERE partner_id IS NOT NULL),
opened AS (SELECT profile_id, count(*) AS n FROM f_events WHERE event_name = 'banner_opened' AND ts >= {EV0} GROUP BY profile_id),
clicks AS (SELECT partner_id, CAST(sum(n) AS BIGINT) AS n_clicks FROM opened JOIN device USING (profile_id) GROUP BY partner_id),
task AS (SELECT *, {INSTALLED_FUNNEL_SQL} AS done, current_state = 'ARRIVED_AT_SITE' OR completed_step >= 1 AS arrived
  FROM f_attempts WHERE active AND created_at >= {TASK0}),
tasks AS (SELECT partner_id, count(confirmed_slot_at) AS slot_tasks, count(executor_id) AS tech_tasks,
    count(*) FILTER (WHERE done) AS installed_tasks FROM task GROUP BY partner_id),
clicker AS (SELECT partner_id, n_clicks, coalesce(slot_tasks, 0) AS slot_tasks, coalesce(tech_tasks, 0) AS tech_tasks,
    coalesce(installed_tasks, 0) AS installed_tasks,
    CASE WHEN partner_id IN (SELECT partner_id FROM f_rosters WHERE category = 'enrolled') THEN 'programme' ELSE 'rest' END AS grp
  FROM clicks LEFT JOIN tasks USING (partner_id)),
devices_of AS (SELECT grp, count(DISTINCT profile_id) AS profiles FROM opened JOIN device USING (profile_id) JOIN clicker USING (partner_id) GROUP BY grp),
histogram AS (SELECT grp, count(*) AS clickers, CAST(sum(n_clicks) AS BIGINT) AS total_clicks,
    count(nullif(slot_tasks, 0)) AS reached_slot, count(nullif(tech_tasks, 0)) AS reached_tech, count(nullif(installed_tasks, 0)) AS reached_install,
    {', '.join(f"count(*) FILTER (WHERE least(n_clicks, 4) = {k}) AS clicked_{k}{'_more' if k == 4 else ''}" for k in (1, 2, 3, 4))}
  FROM clicker GROUP BY grp)"""


def _base(t):
    clicks = E.click_counts(_per_profile(t), _bridge_all(t))
    inst = E.partner_funnel(t.attempts, P.funnel_since)
    base = left_fill(clicks, inst, "partner_id", ["slot_tasks", "tech_tasks", "installed_tasks"])
    prog = _roster(t).withColumn("_in", F.lit(True))
    return base.join(prog, "partner_id", "left").withColumn(
        "grp", F.when(C("_in").isNotNull(), "programme").otherwise("rest")).drop("_in")


@query("scan_named_events", W(f"SELECT event_id, profile_id, ts FROM f_events WHERE event_name = 'banner_opened' AND ts >= {EV0}"))
def scan_named_events(spark, sf):
    return E.events_since(_t(spark, sf).events, "banner_opened", P.events_since).select("event_id", "profile_id", "ts")


@query("profile_bridge", W("""
SELECT DISTINCT profile_id, partner_id FROM f_profiles
WHERE NOT coalesce(deleted, false) AND partner_id IN (SELECT partner_id FROM f_rosters WHERE category = 'enrolled')"""))
def profile_bridge(spark, sf):
    t = _t(spark, sf)
    return E.profile_bridge(t.profiles, _roster(t))


@query("events_to_partner", W(FACTS_SQL + f"\nSELECT event_id, partner_id FROM f_events JOIN device USING (profile_id) WHERE event_name = 'banner_opened' AND ts >= {EV0}"))
def events_to_partner(spark, sf):
    return _clicks_ev(_t(spark, sf)).select("event_id", "partner_id")


@query("events_to_partner_skewed", W(FACTS_SQL + f"\nSELECT event_id, partner_id FROM f_events JOIN device USING (profile_id) WHERE event_name = 'banner_opened' AND ts >= {EV0}"))
def events_to_partner_skewed(spark, sf):
    t = _t(spark, sf)
    events = E.events_since(t.events, "banner_opened", P.events_since)
    return E.attribute_skewed(events, _bridge_all(t)).select("event_id", "partner_id")


@query("click_counts", W(FACTS_SQL + "\nSELECT * FROM clicks"))
def click_counts(spark, sf):
    t = _t(spark, sf)
    return E.click_counts(_per_profile(t), _bridge_all(t))


@query("partner_funnel", W(FACTS_SQL + "\nSELECT * FROM tasks"))
def partner_funnel(spark, sf):
    return E.partner_funnel(_t(spark, sf).attempts, P.funnel_since)


@query("clicks_left_funnel", W(FACTS_SQL + "\nSELECT * EXCLUDE grp FROM clicker"))
def clicks_left_funnel(spark, sf):
    return _base(_t(spark, sf)).drop("grp")


@query("click_frequency", W(FACTS_SQL + "\nSELECT * FROM histogram"))
def click_frequency(spark, sf):
    return E.click_histogram(_base(_t(spark, sf)))


@query("distinct_profiles", W(FACTS_SQL + "\nSELECT * FROM devices_of"))
def distinct_profiles(spark, sf):
    t = _t(spark, sf)
    return E.profiles_by_group(_per_profile(t), _bridge_all(t), _base(t))


@query("group_join_counts", W(FACTS_SQL + "\nSELECT grp, clickers, profiles FROM histogram JOIN devices_of USING (grp)"))
def group_join_counts(spark, sf):
    t = _t(spark, sf)
    base = _base(t)
    return E.click_histogram(base).join(E.profiles_by_group(_per_profile(t), _bridge_all(t), base), "grp", "inner").select(
        "grp", "clickers", "profiles")


@query("csp_funnel", W(FACTS_SQL + "\nSELECT * FROM histogram JOIN devices_of USING (grp)"))
def csp_funnel(spark, sf):
    t = _t(spark, sf)
    return E.engagement_funnel(t.events, t.profiles, t.attempts, _roster(t), P.events_since, P.funnel_since)


SEG_SQL = FACTS_SQL + """,
stage AS (SELECT partner_id, count(*) AS connections, count(proposed_slot_date) AS tasks_slot_proposed,
    count(confirmed_slot_at) AS tasks_slot_confirmed, count(executor_id) AS tasks_tech,
    count(*) FILTER (WHERE arrived) AS tasks_arrived, count(*) FILTER (WHERE done) AS tasks_installed
  FROM task GROUP BY partner_id),
everyone AS (SELECT partner_id FROM f_rosters WHERE category = 'enrolled' UNION SELECT partner_id FROM stage WHERE partner_id IS NOT NULL),
seg AS (SELECT partner_id, CASE
    WHEN partner_id NOT IN (SELECT partner_id FROM f_rosters WHERE category = 'enrolled') THEN 'C_outside'
    WHEN partner_id IN (SELECT partner_id FROM clicks) THEN 'A_clicked' ELSE 'B_noclick' END AS segment FROM everyone)"""


@query("segment_funnel", W(SEG_SQL + f"""
SELECT segment, count(*) AS base_partners, count(connections) AS active_partners,
  count(nullif(tasks_slot_confirmed, 0)) AS slot_partners, count(nullif(tasks_tech, 0)) AS tech_partners,
  count(nullif(tasks_installed, 0)) AS install_partners,
  {', '.join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in E.STAGE_COLS[3:])}
FROM seg LEFT JOIN stage USING (partner_id) GROUP BY segment"""))
def segment_funnel(spark, sf):
    t = _t(spark, sf)
    return E.segment_funnel(t.events, t.profiles, t.attempts, _roster(t), P.events_since, P.funnel_since)


@query("segment_union", W(SEG_SQL + "\nSELECT partner_id, segment FROM seg"))
def segment_union(spark, sf):
    t = _t(spark, sf)
    clickers = _per_profile(t).select("profile_id").join(_bridge_all(t), "profile_id").select("partner_id").distinct()
    inst = E.partner_funnel(t.attempts, P.funnel_since)
    return E.union_segments(_roster(t), clickers, inst).select("partner_id", "segment")


@query("distinct_clickers", W(FACTS_SQL + "\nSELECT partner_id FROM clicks"))
def distinct_clickers(spark, sf):
    t = _t(spark, sf)
    return _per_profile(t).select("profile_id").join(_bridge_all(t), "profile_id").select("partner_id").distinct()


@query("anti_roster", W(SEG_SQL + "\nSELECT partner_id FROM seg WHERE segment = 'C_outside'"))
def anti_roster(spark, sf):
    t = _t(spark, sf)
    return not_in_roster(E.partner_funnel(t.attempts, P.funnel_since).select("partner_id"), _roster(t))


@query("semi_roster", W(FACTS_SQL + f"""\nSELECT event_id, partner_id FROM f_events JOIN device USING (profile_id) SEMI JOIN (SELECT partner_id FROM f_rosters WHERE category = 'enrolled') USING (partner_id)
WHERE event_name = 'banner_opened' AND ts >= {EV0}"""))
def semi_roster(spark, sf):
    t = _t(spark, sf)
    return in_roster(_clicks_ev(t).select("event_id", "partner_id"), _roster(t))


# ---------------------------------------------------------------- banner engagement
OPENS_SQL = f"""
cohort AS (SELECT partner_id FROM f_rosters WHERE category = 'enrolled'),
bprof AS (SELECT DISTINCT profile_id, partner_id FROM f_profiles
          WHERE NOT coalesce(deleted, false) AND partner_id IN (SELECT partner_id FROM cohort)),
opens AS (SELECT p.partner_id, CAST(e.ts AS DATE) AS day, count(*) AS n, min(e.ts) AS mn, max(e.ts) AS mx
  FROM f_events e JOIN bprof p ON p.profile_id = e.profile_id
  WHERE e.event_name = 'banner_opened' AND NOT e.deleted AND e.ts >= {ENG0} GROUP BY p.partner_id, CAST(e.ts AS DATE))"""


def _opens(t):
    return E.daily_opens(t.events, E.profile_bridge(t.profiles, _roster(t)), P.engagement_start)


@query("daily_engagement", W(OPENS_SQL + "\nSELECT day, count(DISTINCT partner_id) AS partners, CAST(sum(n) AS BIGINT) AS opens FROM opens GROUP BY day"))
def daily_engagement(spark, sf):
    return E.daily_engagement(_opens(_t(spark, sf)))


@query("engagement_summary", W(OPENS_SQL + """,
per AS (SELECT partner_id, sum(n) AS n FROM opens GROUP BY partner_id),
s AS (SELECT (SELECT count(DISTINCT partner_id) FROM cohort) AS eligible, (SELECT count(*) FROM per) AS opened,
        (SELECT COALESCE(CAST(sum(n) AS BIGINT), 0) FROM per) AS total_opens,
        (SELECT min(mn) FROM opens) AS first_open, (SELECT max(mx) FROM opens) AS last_open)
SELECT eligible, opened,
  CAST(CASE WHEN eligible > 0 THEN round_even(100.0 * opened / eligible, 0) ELSE 0 END AS BIGINT) AS pct_opened,
  total_opens,
  CASE WHEN opened > 0 THEN floor(10.0 * total_opens / opened + 0.5) / 10.0 ELSE 0.0 END AS avg_per_opener,
  first_open, last_open
FROM s"""))
def engagement_summary(spark, sf):
    t = _t(spark, sf)
    return E.engagement_summary(_opens(t), _roster(t))


@query("engagement_by_outcome", W(OPENS_SQL + "," + settle_input_sql(P) + f""",
grp AS (SELECT partner_id, CASE WHEN floor_eligible THEN 'topup' ELSE 'piece' END AS outcome FROM {settle_sql('SELECT * FROM inp')} x),
g AS (SELECT outcome, count(o.partner_id) AS opened, count(*) AS total
  FROM grp LEFT JOIN (SELECT DISTINCT partner_id FROM opens) o ON o.partner_id = grp.partner_id GROUP BY outcome)
SELECT outcome, opened, total, CAST(CASE WHEN total > 0 THEN round_even(100.0 * opened / total, 0) ELSE 0 END AS BIGINT) AS pct FROM g"""))
def engagement_by_outcome(spark, sf):
    t = _t(spark, sf)
    return E.engagement_by_outcome(_opens(t), PO.outcome_group(_settled(spark, sf)))


@query("daily_unique_vs_last_active", W("""
ev AS (SELECT profile_id, CAST(ts AS DATE) AS day FROM f_events),
u AS (SELECT day, count(DISTINCT profile_id) AS uniq FROM ev GROUP BY day),
l AS (SELECT day, count(*) AS last_active FROM (SELECT profile_id, max(day) AS day FROM ev GROUP BY profile_id) x GROUP BY day)
SELECT u.day, u.uniq, COALESCE(l.last_active, 0) AS last_active FROM u LEFT JOIN l ON l.day = u.day"""))
def daily_unique_vs_last_active(spark, sf):
    return E.daily_uniques(_t(spark, sf).events)


@query("campaign_variant_sum", W("""
j AS (SELECT i.campaign, e.event_name FROM f_events e JOIN f_inventory i ON i.event_name = e.event_name)
SELECT campaign, event_name AS variant, count(*) AS events FROM j GROUP BY campaign, event_name
UNION ALL SELECT campaign, 'ALL', count(*) FROM j GROUP BY campaign"""))
def campaign_variant_sum(spark, sf):
    t = _t(spark, sf)
    return E.variant_totals(t.events, t.inventory)


@query("freshest_profile", W("""
SELECT partner_id, profile_id, last_seen FROM (
  SELECT *, row_number() OVER (PARTITION BY partner_id ORDER BY last_seen DESC, profile_id DESC) AS rn
  FROM f_profiles WHERE partner_id IS NOT NULL) x WHERE rn = 1"""))
def freshest_profile(spark, sf):
    return E.freshest_profile(_t(spark, sf).profiles)


@query("view_click_rate", W("""
seen AS (SELECT DISTINCT CAST(ts AS DATE) AS day, campaign, profile_id, event_name FROM f_events),
n AS (SELECT day, campaign, count(*) FILTER (WHERE event_name = 'banner_opened') AS viewed, count(*) FILTER (WHERE event_name = 'click') AS clicked
  FROM seen GROUP BY day, campaign)
SELECT day, campaign, viewed, clicked, CAST(CASE WHEN viewed > 0 THEN floor((200 * clicked + viewed) / (2 * viewed)) ELSE 0 END AS BIGINT) AS rate FROM n"""))
def view_click_rate(spark, sf):
    return E.view_click(_t(spark, sf).events)


@query("coverage", W(NEW_LEADS_SQL + f""",
ab AS (SELECT partner_id, count(*) AS base FROM f_users WHERE active AND status = 'ACTIVE' GROUP BY partner_id),
vprof AS (SELECT DISTINCT profile_id, partner_id FROM f_profiles WHERE NOT coalesce(deleted, false)),
vw AS (SELECT p.partner_id, count(*) AS n FROM f_events e JOIN vprof p ON p.profile_id = e.profile_id
       WHERE e.event_name = 'banner_opened' AND e.ts >= {ENG0} GROUP BY p.partner_id),
vt AS (SELECT p.partner_id, count(*) AS n FROM f_events e JOIN vprof p ON p.profile_id = e.profile_id
       WHERE e.event_name = 'banner_opened' AND CAST(e.ts AS DATE) = {sql_date(P.engagement_today)} GROUP BY p.partner_id),
s AS (SELECT rt.partner_id, rt.screen = 'noleads' AS nl, COALESCE(ab.base, 0) AS base, COALESCE(vw.n, 0) AS n, COALESCE(vt.n, 0) AS n_today
      FROM rt LEFT JOIN ab ON ab.partner_id = rt.partner_id LEFT JOIN vw ON vw.partner_id = rt.partner_id
      LEFT JOIN vt ON vt.partner_id = rt.partner_id),
inc AS (SELECT COALESCE(sum(CASE WHEN nl THEN n_today ELSE 0 END), 0) > 5 AS inc FROM s),
t AS (SELECT s.* FROM s, inc WHERE NOT s.nl OR inc.inc),
g AS (SELECT count(*) AS targeted_partners, count(*) FILTER (WHERE n > 0) AS viewer_partners,
        CAST(COALESCE(sum(base), 0) AS BIGINT) AS targeted_base,
        CAST(COALESCE(sum(CASE WHEN n > 0 THEN base ELSE 0 END), 0) AS BIGINT) AS viewer_base FROM t)
SELECT g.*, inc.inc AS includes_noleads,
  CASE WHEN targeted_base > 0 THEN floor((2000 * viewer_base + targeted_base) / (2 * targeted_base)) / 10.0 END AS coverage_pct
FROM g, inc"""))
def coverage(spark, sf):
    t = _t(spark, sf)
    screens = PO.standing(_route_input(spark, sf), P).select("partner_id", "screen")
    base = t.users.where(C("active") & (C("status") == "ACTIVE")).groupBy("partner_id").agg(F.count(F.lit(1)).alias("base"))
    bridge = E.profile_bridge(t.profiles)
    views = E.click_counts(E.per_profile(t.events, "banner_opened", P.engagement_start), bridge).withColumnRenamed("n_clicks", "n")
    day = t.events.where(C("ts").cast("date") == date_lit(P.engagement_today))
    today = E.click_counts(E.per_profile(day, "banner_opened", P.engagement_start), bridge).withColumnRenamed("n_clicks", "n")
    return E.coverage(screens, views, base, today)
