"""Registered cohort / roster / dashboard queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from leadflow.functions.timecols import sql_date
from leadflow.operators import cohorts as CO
from leadflow.operators import leads as L
from leadflow.operators import payout as PO
from leadflow.operators import snapshot as S
from leadflow.plans.catalog import query
from leadflow.plans.params import DEFAULT as P
from leadflow.plans.q_engagement import FACTS_SQL
from leadflow.plans.q_payout import _settled, settle_input_sql, settle_sql
from leadflow.plans.q_snapshot import agg_sql
from leadflow.plans.sqlparts import bucketed_sql, in_month_sql, local_sql, values_sql
from leadflow.sources.testdata import tables
from leadflow.sources.testdata_sql import with_fixtures as W

C = F.col
PERIODS = [("june", P.prev_start, P.month_start), ("july", P.month_start, None)]
JUNE, JULY = sql_date(P.prev_start), sql_date(P.month_start)
CATEGORIES = ["enrolled", "eligible", "rest"]


def _legacy(t):
    return L.bucketed_window(t.attempts, P, "legacy")


# leads of the slot policy that were resolved, by the period they closed in (later periods first: july has no end)
SPANS_SQL = values_sql([(n, str(a), str(b or "9999-12-31")) for n, a, b in PERIODS]) + " span(period, since, till)"
EFF_SQL = f"""
b AS ({bucketed_sql(P, 'legacy')}),
resolved AS (SELECT partner_id, period, bucket = 'installed' AS won FROM b JOIN {SPANS_SQL}
  ON last_date >= CAST(since AS DATE) AND last_date < CAST(till AS DATE)
  WHERE reached_slot = 1 AND bucket NOT IN ('open', 'system_other')),
per AS (SELECT period, partner_id, count(*) AS denom, count(*) FILTER (WHERE won) AS installs FROM resolved GROUP BY period, partner_id),
cat AS (SELECT per.*, coalesce(r.category, 'rest') AS category, 5 * installs > 3 * denom AS above FROM per LEFT JOIN f_rosters r USING (partner_id)),
summed AS (SELECT period, category, count(*) AS partners, CAST(sum(denom) AS BIGINT) AS leads, CAST(sum(installs) AS BIGINT) AS installs,
    count(*) FILTER (WHERE above) AS secured FROM cat GROUP BY period, category),
eff AS (SELECT *, floor(1000.0 * installs / leads + 0.5) / 10.0 AS agg_eff, floor(1000.0 * secured / partners + 0.5) / 10.0 AS pct_secured FROM summed)"""


@query("period_label", W(f"""
SELECT connection_id, partner_id, period FROM ({bucketed_sql(P, 'legacy')}) b
JOIN {SPANS_SQL} ON last_date >= CAST(since AS DATE) AND last_date < CAST(till AS DATE)"""))
def period_label(spark, sf):
    b = _legacy(tables(spark, sf)).withColumn("period", CO.period_of("last_date", PERIODS))
    return b.where(C("period").isNotNull()).select("connection_id", "partner_id", "period")


@query("roster_label", W("""
SELECT a.partner_id, a.n, COALESCE(r.category, 'rest') AS category
FROM (SELECT partner_id, count(*) AS n FROM f_attempts GROUP BY partner_id) a LEFT JOIN f_rosters r ON r.partner_id = a.partner_id"""))
def roster_label(spark, sf):
    t = tables(spark, sf)
    a = t.attempts.groupBy("partner_id").agg(F.count(F.lit(1)).alias("n"))
    return CO.roster_label(a, t.rosters)


@query("efficiency", W(EFF_SQL + "\nSELECT * FROM eff"))
def efficiency(spark, sf):
    t = tables(spark, sf)
    return CO.efficiency(_legacy(t), t.rosters, PERIODS)


@query("dashboard_pivot", W(EFF_SQL + """,
grid AS (SELECT * FROM (VALUES ('june'), ('july')) p(period), (VALUES ('enrolled'), ('eligible'), ('rest')) c(category))
SELECT g.period, g.category, COALESCE(e.partners, 0) AS partners, COALESCE(e.leads, 0) AS leads,
  COALESCE(e.installs, 0) AS installs, COALESCE(e.agg_eff, 0) AS agg_eff, COALESCE(e.secured, 0) AS secured,
  COALESCE(e.pct_secured, 0) AS pct_secured
FROM grid g LEFT JOIN eff e ON e.period = g.period AND e.category = g.category"""))
def dashboard_pivot(spark, sf):
    t = tables(spark, sf)
    grid = spark.createDataFrame([(p, c) for p, _, _ in PERIODS for c in CATEGORIES], "period string, category string")
    return CO.dashboard_doc(CO.efficiency(_legacy(t), t.rosters, PERIODS), grid)


ROSTER_SQL = f"""
b AS (SELECT *, last_date >= {JULY} AND reached_slot = 1 AS counts FROM ({bucketed_sql(P, 'legacy')}) x),
j AS (SELECT r.partner_id, count(*) FILTER (WHERE counts AND bucket = 'installed') AS installs,
    count(*) FILTER (WHERE counts AND bucket NOT IN ('open', 'system_other')) AS leads, count(*) FILTER (WHERE bucket = 'open') AS pending
  FROM f_rosters r LEFT JOIN b USING (partner_id) WHERE r.category = 'enrolled' GROUP BY r.partner_id),
judged AS (SELECT *, CASE WHEN leads > 0 THEN CASE WHEN 5 * installs > 3 * leads THEN 'above' ELSE 'below' END
    WHEN pending > 0 THEN 'waiting' ELSE 'nothing' END AS state FROM j)"""


@query("enrolled_roster", W(ROSTER_SQL + """
SELECT 'ROSTER' AS grp, count(*) AS enrolled_total, count(nullif(leads, 0)) AS with_leads,
  count(*) FILTER (WHERE state = 'above') AS eff_60_plus, count(*) FILTER (WHERE state = 'below') AS eff_60_minus,
  count(*) FILTER (WHERE state = 'waiting') AS pending_only, count(*) FILTER (WHERE state = 'nothing') AS no_activity,
  CAST(sum(installs) AS BIGINT) AS total_installs, CAST(sum(leads) AS BIGINT) AS total_leads FROM judged"""))
def enrolled_roster(spark, sf):
    t = tables(spark, sf)
    return CO.roster_breakdown(_legacy(t), t.rosters.where(C("category") == "enrolled"), P.month_start)


@query("roster_left_metrics", W(ROSTER_SQL + "\nSELECT * FROM j"))
def roster_left_metrics(spark, sf):
    t = tables(spark, sf)
    b = _legacy(t)
    bb = C("bucket")
    recent = C("last_date") >= F.lit(P.month_start.isoformat()).cast("date")
    m = b.groupBy("partner_id").agg(
        F.count_if((bb == "installed") & (C("reached_slot") == 1) & recent).alias("installs"),
        F.count_if((C("reached_slot") == 1) & ~bb.isin("open", "system_other") & recent).alias("leads"),
        F.count_if(bb == "open").alias("pending"))
    return CO.roster_left(t.rosters.where(C("category") == "enrolled"), m, ["installs", "leads", "pending"])


@query("enrolment_date", W(f"""
SELECT o.partner_id, 1 AS flow, CAST(min(o.opted_at) + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE) AS enrolled_on
FROM f_optins o JOIN f_rosters r ON r.partner_id = o.partner_id AND r.flow = 1 GROUP BY o.partner_id
UNION ALL
SELECT a.partner_id, 2, CAST(max(a.scan_complete_at) + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE)
FROM f_audits a JOIN f_rosters r ON r.partner_id = a.partner_id AND r.flow = 2 GROUP BY a.partner_id"""))
def enrolment_date(spark, sf):
    t = tables(spark, sf)
    return CO.enrolment_dates(t.optins, t.audits, t.rosters, P.offset_minutes)


COHORT_SQL = """
cohort AS (SELECT DISTINCT partner_id FROM (
    SELECT partner_id FROM f_rosters WHERE flow = 1
    UNION ALL SELECT partner_id FROM f_rosters WHERE flow = 2
      AND partner_id IN (SELECT partner_id FROM f_audits WHERE scan_complete_at IS NOT NULL)) u
  WHERE partner_id IN (SELECT partner_id FROM f_optins WHERE opted_at IS NOT NULL))"""


@query("cohort_build", W(COHORT_SQL + "\nSELECT partner_id FROM cohort"))
def cohort_build(spark, sf):
    t = tables(spark, sf)
    return CO.build_cohort(t.rosters, t.optins, t.audits)


@query("roster_drift", W(COHORT_SQL + f""",
dated AS (SELECT partner_id, 1 AS flow, min(opted_at) AS at FROM f_optins GROUP BY partner_id
  UNION ALL SELECT partner_id, 2, max(scan_complete_at) FROM f_audits GROUP BY partner_id),
built AS (SELECT cohort.partner_id, {local_sql('dated.at', P)} AS joined FROM cohort LEFT JOIN f_rosters r USING (partner_id)
  LEFT JOIN dated ON dated.partner_id = cohort.partner_id AND dated.flow = r.flow),
kept AS (SELECT r.partner_id, o.joined FROM f_rosters r LEFT JOIN f_overlay o USING (partner_id) WHERE r.category = 'enrolled'),
both_ AS (SELECT partner_id, 'a' AS side, joined FROM kept UNION ALL SELECT partner_id, 'b', joined FROM built),
sides AS (SELECT partner_id, list(side ORDER BY side) AS s, count(DISTINCT coalesce(joined, DATE '0001-01-01')) AS dates FROM both_ GROUP BY partner_id)
SELECT partner_id, CASE WHEN len(s) = 2 THEN 'changed' ELSE 'only_' || s[1] END AS kind FROM sides WHERE len(s) = 1 OR dates > 1"""))
def roster_drift(spark, sf):
    """The stored roster with its enrolment dates against the cohort built from the actions."""
    from leadflow.operators.quality import roster_drift as rd
    t = tables(spark, sf)
    stored = t.rosters.where(C("category") == "enrolled").select("partner_id").join(t.overlay.select("partner_id", "joined"), "partner_id", "left")
    dates = CO.enrolment_dates(t.optins, t.audits, t.rosters, P.offset_minutes).select("partner_id", C("enrolled_on").alias("joined"))
    built = CO.build_cohort(t.rosters, t.optins, t.audits).join(dates, "partner_id", "left")
    return rd(stored, built, "partner_id", ["joined"])


@query("segment_identities", W("""
SELECT u.user_id, u.partner_id FROM f_users u
WHERE u.active AND u.status = 'ACTIVE' AND u.role IN ('OWNER','MANAGER','MANAGER_PLUS')
  AND u.partner_id IN (SELECT partner_id FROM f_rosters WHERE category = 'enrolled')"""))
def segment_identities(spark, sf):
    t = tables(spark, sf)
    return CO.identities(t.rosters.where(C("category") == "enrolled"), t.users)


@query("account_map", W(settle_input_sql(P) + f"""
SELECT x.partner_id, a.account_name, x.total FROM {settle_sql('SELECT * FROM inp')} x
LEFT JOIN f_accounts a ON a.partner_id = x.partner_id"""))
def account_map(spark, sf):
    t = tables(spark, sf)
    return CO.map_accounts(_settled(spark, sf).select("partner_id", "total"), t.accounts).select(
        "partner_id", "account_name", "total")


@query("lapse_breakdown", W(f"""
b AS (SELECT *, {in_month_sql(P)} AS closed FROM ({bucketed_sql(P, 'full')}) x),
idle AS (SELECT partner_id FROM f_rosters WHERE category = 'enrolled' AND partner_id NOT IN (
    SELECT partner_id FROM b WHERE bucket = 'open' OR (closed AND reached_slot = 1 AND bucket NOT IN ('open', 'system_other')))),
lost AS (SELECT b.* FROM b JOIN idle USING (partner_id) WHERE closed),
spared AS (SELECT DISTINCT partner_id FROM lost WHERE reached_slot = 1 OR bucket = 'installed')
SELECT 'truly_none' AS kind, 'none' AS cause, count(*) AS partners, CAST(0 AS BIGINT) AS leads FROM idle
WHERE partner_id NOT IN (SELECT partner_id FROM lost) HAVING count(*) > 0
UNION ALL
SELECT 'all_lapsed', bucket, count(DISTINCT partner_id), count(*) FROM lost WHERE partner_id NOT IN (SELECT partner_id FROM spared) GROUP BY bucket"""))
def lapse_breakdown(spark, sf):
    t = tables(spark, sf)
    return CO.lapse_breakdown(L.bucketed_window(t.attempts, P), t.rosters.where(C("category") == "enrolled"),
                              P.month_start, P.month_end)


@query("keep_enrolled_zero_rows", W(f"""
SELECT a.partner_id, CASE WHEN (a.installs + a.denom + a.pending + a.leads_m1) > 0 THEN 'active' ELSE 'enrolled' END AS kept
FROM {agg_sql(P)} a LEFT JOIN (SELECT DISTINCT partner_id FROM f_overlay WHERE joined IS NOT NULL) e ON e.partner_id = a.partner_id
WHERE (a.installs + a.denom + a.pending + a.leads_m1) > 0 OR e.partner_id IS NOT NULL"""))
def keep_enrolled_zero_rows(spark, sf):
    t = tables(spark, sf)
    agg = S.merge_sources(L.metric_tech(t.attempts, P), L.open_pipeline(L.bucketed_window(t.attempts, P)),
                          L.metric_ontime(t.ledger, P))
    enrol = t.overlay.where(C("joined").isNotNull())
    return S.keep_active_or_enrolled(agg, enrol).select("partner_id", "kept")


# an inline table of parameters as a run is given it: partner, enrolment date (the last two partners don't exist)
ENROL_LITERAL = [(2, "1998-07-02"), (3, "1998-07-19"), (8, None), (11, "1998-06-30"), (-1, "1998-07-01"), (9_999_999, "1998-07-05")]


@query("roster_literal", W(f"""
lit AS (SELECT CAST(p AS BIGINT) AS partner_id, CAST(d AS DATE) AS enrolled_on FROM {values_sql(ENROL_LITERAL)} v(p, d))
SELECT lit.partner_id, lit.enrolled_on, r.category, n.leads
FROM lit LEFT JOIN f_rosters r USING (partner_id)
LEFT JOIN (SELECT partner_id, count(*) AS leads FROM f_attempts GROUP BY partner_id) n USING (partner_id)"""))
def roster_literal(spark, sf):
    """An inline enrolment table joined with the partners' category and attempts."""
    from leadflow.sources.inputs import roster
    t = tables(spark, sf)
    rows = [(p, None if d is None else dt.date.fromisoformat(d)) for p, d in ENROL_LITERAL]
    lit = roster(spark, rows, "partner_id bigint, enrolled_on date")
    n = t.attempts.groupBy("partner_id").agg(F.count(F.lit(1)).alias("leads"))
    out = lit.join(t.rosters.select("partner_id", "category"), "partner_id", "left").join(n, "partner_id", "left")
    return out.select("partner_id", "enrolled_on", "category", "leads")


@query("overlay_explode", W("""SELECT CAST(partner_id AS VARCHAR) AS partner_key, joined, rate_before, rate_after, switch,
  CAST(inst_before AS BIGINT) AS inst_before, CAST(inst_after AS BIGINT) AS inst_after FROM f_overlay"""))
def overlay_explode(spark, sf):
    from leadflow.sources.inputs import overlay_rows
    t = tables(spark, sf)
    docs = t.overlay.select(F.to_json(F.create_map(C("partner_id").cast("string"), F.struct(
        "joined", "rate_before", "rate_after", "switch", "inst_before", "inst_after"))).alias("json"))
    return overlay_rows(docs)


@query("cohort_array", W("SELECT CAST(partner_id AS VARCHAR) AS partner_key FROM f_rosters WHERE category = 'enrolled'"))
def cohort_array(spark, sf):
    """Cohort documents that are arrays of ids, one for each nation here."""
    from leadflow.sources.inputs import cohort_ids
    t = tables(spark, sf)
    en = t.rosters.where(C("category") == "enrolled").withColumn("part", C("partner_id") % 5)
    docs = en.groupBy("part").agg(F.to_json(F.collect_list(C("partner_id").cast("string"))).alias("json"))
    return cohort_ids(docs)


@query("cohort_explode", W(settle_input_sql(P) + f"""
SELECT CAST(partner_id AS VARCHAR) AS partner_key, CASE WHEN floor_eligible THEN 'topup' ELSE 'piece' END AS outcome
FROM {settle_sql('SELECT * FROM inp')} x"""))
def cohort_explode(spark, sf):
    from leadflow.sources.inputs import cohort_rows
    g = PO.outcome_group(_settled(spark, sf))
    docs = g.select(F.to_json(F.create_map(C("partner_id").cast("string"), C("outcome"))).alias("json"))
    return cohort_rows(docs)


@query("scan_users_active", W("""
SELECT user_id, partner_id, role FROM f_users
WHERE active AND status = 'ACTIVE' AND role IN ('OWNER','MANAGER','MANAGER_PLUS') AND user_id IS NOT NULL"""))
def scan_users_active(spark, sf):
    return CO.active_users(tables(spark, sf).users).select("user_id", "partner_id", "role")


@query("overlay_merge", W(f"""
ed AS (SELECT o.partner_id, 1 AS flow, CAST(min(o.opted_at) + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE) AS joined
  FROM f_optins o JOIN f_rosters r ON r.partner_id = o.partner_id AND r.flow = 1 GROUP BY o.partner_id
  UNION ALL
  SELECT a.partner_id, 2, CAST(max(a.scan_complete_at) + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE)
  FROM f_audits a JOIN f_rosters r ON r.partner_id = a.partner_id AND r.flow = 2 GROUP BY a.partner_id)
SELECT ed.partner_id, ed.flow, COALESCE(o.joined, ed.joined) AS joined, o.rate_before, o.rate_after, o.switch, o.inst_before, o.inst_after
FROM ed LEFT JOIN f_overlay o ON lower(CAST(o.partner_id AS VARCHAR)) = lower(CAST(ed.partner_id AS VARCHAR))"""))
def overlay_merge(spark, sf):
    t = tables(spark, sf)
    rec = CO.enrolment_dates(t.optins, t.audits, t.rosters, P.offset_minutes).withColumnRenamed("enrolled_on", "joined")
    return CO.with_overlay(rec, t.overlay)


@query("dashboard_document", W(FACTS_SQL + f""",
funnel AS (SELECT * FROM histogram JOIN devices_of USING (grp)),
{EFF_SQL.strip()},
{ROSTER_SQL.strip().replace('b AS (', 'rb AS (', 1).replace('LEFT JOIN b USING', 'LEFT JOIN rb USING')}
SELECT 'engagement' AS section, grp AS k1, '' AS k2, unnest(['clickers', 'total_clicks', 'profiles']) AS field,
  unnest([clickers, total_clicks, profiles])::DOUBLE AS value FROM funnel
UNION ALL SELECT 'efficiency', p.period, c.category, unnest(['partners', 'leads', 'agg_eff']),
  unnest([coalesce(eff.partners, 0)::DOUBLE, coalesce(eff.leads, 0)::DOUBLE, coalesce(eff.agg_eff, 0)::DOUBLE])
FROM (VALUES ('june'), ('july')) p(period) CROSS JOIN (VALUES ('enrolled'), ('eligible'), ('rest')) c(category)
LEFT JOIN eff ON eff.period = p.period AND eff.category = c.category
UNION ALL SELECT 'enrolled_roster', '', '', unnest(['enrolled_total', 'total_leads']), unnest([count(*), sum(leads)])::DOUBLE FROM judged"""))
def dashboard_document(spark, sf):
    """K4: the one nested document, read back as (section, keys, field, value) rows."""
    from leadflow.operators import engagement as E
    t = tables(spark, sf)
    en = t.rosters.where(C("category") == "enrolled").select("partner_id")
    grid = spark.createDataFrame([(p, c) for p, _, _ in PERIODS for c in CATEGORIES], "period string, category string")
    doc = CO.dashboard_document(
        E.engagement_funnel(t.events, t.profiles, t.attempts, en, P.events_since, P.funnel_since),
        E.segment_funnel(t.events, t.profiles, t.attempts, en, P.events_since, P.funnel_since),
        CO.dashboard_doc(CO.efficiency(_legacy(t), t.rosters, PERIODS), grid),
        CO.roster_breakdown(_legacy(t), en, P.month_start))

    def fields(v, names):
        return F.array(*[F.struct(F.lit(n).alias("field"), v[n].cast("double").alias("value")) for n in names])

    eng = doc.select(F.explode("engagement").alias("k1", "v")).select(
        F.lit("engagement").alias("section"), "k1", F.lit("").alias("k2"), F.inline(fields(C("v"), ("clickers", "total_clicks", "profiles"))))
    eff = doc.select(F.explode("efficiency").alias("k1", "cats")).select("k1", F.explode("cats").alias("k2", "v")).select(
        F.lit("efficiency").alias("section"), "k1", "k2", F.inline(fields(C("v"), ("partners", "leads", "agg_eff"))))
    ros = doc.select(F.lit("enrolled_roster").alias("section"), F.lit("").alias("k1"), F.lit("").alias("k2"),
                     F.inline(fields(C("enrolled_roster"), ("enrolled_total", "total_leads"))))
    return eng.unionByName(eff).unionByName(ros)
