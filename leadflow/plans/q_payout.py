"""Registered payout / banner queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadflow.functions.scalars import TIER_ALIASES, TIER_AMOUNTS, tier_alias
from leadflow.functions.timecols import sql_date, sql_ts, ts_lit
from leadflow.operators import leads as L
from leadflow.operators import payout as PO
from leadflow.plans.catalog import query
from leadflow.plans.params import DEFAULT as P
from leadflow.plans.params import Params
from leadflow.plans.q_snapshot import PREV, _measures, _snapshot, snapshot_sql
from leadflow.plans.sqlparts import in_month_sql, tech_collapse_sql, tech_metric_sql, values_sql
from leadflow.sources.testdata import TestData, tables
from leadflow.sources.testdata_sql import with_fixtures as W

C = F.col


# ------------------------------------------------------------------ inputs
def _daily(t: TestData, p: Params = P):
    return L.daily_leads(L.month_history(t.attempts, p), p)


def settle_input(t: TestData, p: Params = P):
    """Enrolled universe with the v3 metric, overlay and rate split (zero-filled), from one scan of the attempts."""
    return PO.settle_record(t.rosters.where(C("category") == "enrolled"), _daily(t, p), t.overlay)


def settle_input_sql(p: Params = P) -> str:
    return f"""
en AS (SELECT partner_id FROM f_rosters WHERE category = 'enrolled'),
mg AS {tech_metric_sql(p)},
lc AS ({tech_collapse_sql(p)}),
split AS (SELECT l.partner_id, count(*) AS installs,
    count(*) FILTER (WHERE l.last_date < o.switch) AS inst_before,
    count(*) FILTER (WHERE l.last_date >= o.switch) AS inst_after
  FROM lc l JOIN f_overlay o ON o.partner_id = l.partner_id
  WHERE o.switch IS NOT NULL AND l.has_installed = 1 AND {in_month_sql(p, 'l.last_date')} GROUP BY l.partner_id),
inp AS (SELECT en.partner_id, COALESCE(mg.installs, 0) AS installs, COALESCE(mg.denom, 0) AS denom,
    o.joined, o.rate_after, o.switch, s.inst_before, s.inst_after
  FROM en LEFT JOIN mg ON mg.partner_id = en.partner_id LEFT JOIN f_overlay o ON o.partner_id = en.partner_id
  LEFT JOIN split s ON s.partner_id = en.partner_id)"""


def settle_sql(src: str, p: Params = P) -> str:
    ym, dim, fl, r = p.month_ym, p.days_in_month, p.floor, p.rate
    two = p.month_ym < p.two_tier_before
    pay = (f"""CASE WHEN rate_after IS NOT NULL AND switch IS NOT NULL THEN
        CASE WHEN '{ym}' < strftime(switch, '%Y-%m') THEN {r} * installs
             WHEN '{ym}' = strftime(switch, '%Y-%m') THEN {r} * COALESCE(inst_before, 0) + rate_after * COALESCE(inst_after, 0)
             ELSE rate_after * installs END
      ELSE {r} * installs END""" if two else f"{r} * installs")
    return f"""(SELECT *, CAST(pay + topup AS BIGINT) AS total,
    CASE WHEN NOT floor_eligible THEN 'below60' WHEN pay >= floor_amt THEN 'above' WHEN denom = 0 THEN 'noleads'
         WHEN fewleads THEN 'fewleads' WHEN (floor_amt - pay) > floor_amt / 2.0 THEN 'deep' ELSE 'topup' END AS "case"
  FROM (SELECT *, CAST(CASE WHEN floor_eligible AND pay < floor_amt THEN floor_amt - pay ELSE 0 END AS BIGINT) AS topup
    FROM (SELECT *, (fewleads OR secured) AS floor_eligible
      FROM (SELECT *,
          CAST(CASE WHEN joined IS NOT NULL AND strftime(joined, '%Y-%m') = '{ym}'
                    THEN floor({fl} * ({dim} - day(joined) + 1) / {dim}.0 + 0.5) ELSE {fl} END AS BIGINT) AS floor_amt,
          CAST({pay} AS BIGINT) AS pay,
          CAST(CASE WHEN denom > 0 THEN ROUND(100.0 * installs / denom) ELSE 0 END AS BIGINT) AS pct,
          (denom > 0 AND installs / denom >= 0.60) AS secured,
          (denom <= 2) AS fewleads,
          (joined >= {sql_date(p.month_end)}) AS joined_after
        FROM ({src}) s0) s1) s2) s3)"""


SETTLE_COLS = ["partner_id", "installs", "denom", "floor", "installpay", "pct", "secured", "fewleads",
               "floor_eligible", "topup", "total", "case", "joined_after"]
SETTLE_SQL_COLS = ("partner_id, installs, denom, floor_amt AS floor, pay AS installpay, pct, secured, fewleads, "
                   "floor_eligible, topup, total, \"case\", joined_after")


def _settled(spark, sf, p: Params = P):
    return PO.settle(settle_input(tables(spark, sf), p), p)


@query("settlement", W(settle_input_sql(P) + f"\nSELECT {SETTLE_SQL_COLS} FROM {settle_sql('SELECT * FROM inp')} x"))
def settlement(spark, sf):
    return _settled(spark, sf).select(*SETTLE_COLS)


@query("install_money", W(settle_input_sql(P) + f"\nSELECT partner_id, pay AS installpay FROM {settle_sql('SELECT * FROM inp')} x"))
def install_money(spark, sf):
    return _settled(spark, sf).select("partner_id", "installpay")


@query("settlement_case", W(settle_input_sql(P) + f"\nSELECT partner_id, \"case\" FROM {settle_sql('SELECT * FROM inp')} x"))
def settlement_case(spark, sf):
    return _settled(spark, sf).select("partner_id", "case")


@query("prorata_floor", W(f"""
SELECT partner_id, joined, CAST(CASE WHEN joined IS NOT NULL AND strftime(joined, '%Y-%m') = '{P.month_ym}'
  THEN floor({P.floor} * ({P.days_in_month} - day(joined) + 1) / {P.days_in_month}.0 + 0.5) ELSE {P.floor} END AS BIGINT) AS floor
FROM f_overlay"""))
def prorata_floor(spark, sf):
    t = tables(spark, sf)
    return t.overlay.select("partner_id", "joined", PO.prorata(C("joined"), P.month_start, P.days_in_month, P.floor).alias("floor"))


@query("outcome_group", W(settle_input_sql(P) + f"""
SELECT partner_id, CASE WHEN floor_eligible THEN 'topup' ELSE 'piece' END AS outcome FROM {settle_sql('SELECT * FROM inp')} x"""))
def outcome_group(spark, sf):
    return PO.outcome_group(_settled(spark, sf))


@query("payout_totals", W(settle_input_sql(P) + f"""
SELECT count(*) AS partners, CAST(sum(installs) AS BIGINT) AS installs, CAST(sum(pay) AS BIGINT) AS install_money,
  CAST(sum(topup) AS BIGINT) AS topup_money, CAST(sum(total) AS BIGINT) AS total_payout,
  count(*) FILTER (WHERE floor_eligible) AS floor_eligible, count(*) FILTER (WHERE fewleads) AS eligible_fewleads,
  count(*) FILTER (WHERE secured AND NOT fewleads) AS eligible_secured, count(*) FILTER (WHERE NOT floor_eligible) AS piece_rate
FROM {settle_sql('SELECT * FROM inp')} x"""))
def payout_totals(spark, sf):
    return PO.payout_totals(_settled(spark, sf))


@query("rate_split_counts", W(settle_input_sql(P) + "\nSELECT partner_id, installs, inst_before, inst_after FROM split"))
def rate_split_counts(spark, sf):
    t = tables(spark, sf)
    return PO.rate_split(_daily(t), t.overlay)


@query("rate_split_reconcile", W(settle_input_sql(P) + """
SELECT o.partner_id, CAST(o.inst_before + o.inst_after AS BIGINT) AS split_sum, COALESCE(mg.installs, 0) AS installs
FROM f_overlay o LEFT JOIN mg ON mg.partner_id = o.partner_id
WHERE o.inst_before + o.inst_after <> COALESCE(mg.installs, 0)"""))
def rate_split_reconcile(spark, sf):
    """The split that the overlay file states against the metric's installs."""
    from leadflow.operators.quality import rate_split_reconcile as rsr
    t = tables(spark, sf)
    stated = t.overlay.where(C("inst_before").isNotNull()).select("partner_id", "inst_before", "inst_after")
    return rsr(stated, L.metric_tech(t.attempts, P))


# ---------------------------------------------------------- banner metrics
def _route_input(spark, sf):
    return _measures(spark, sf)


NEW_LEADS_SQL = f"""
daily AS (SELECT partner_id, last_date, count(*) FILTER (WHERE has_installed = 1) AS i_d,
    count(*) FILTER (WHERE tech_assigned = 1) AS d_d
  FROM ({tech_collapse_sql(P)}) c WHERE {in_month_sql(P)} GROUP BY partner_id, last_date),
cum AS (SELECT partner_id, last_date,
    sum(i_d) OVER (PARTITION BY partner_id ORDER BY last_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ci,
    sum(d_d) OVER (PARTITION BY partner_id ORDER BY last_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cd
  FROM daily),
nl AS (SELECT partner_id,
    CAST(arg_max(cd, last_date) - COALESCE(arg_max(cd, last_date) FILTER (WHERE cd > 0 AND ci / cd >= 0.60),
                                          arg_max(cd, last_date)) AS BIGINT) AS new_leads
  FROM cum GROUP BY partner_id),
rin AS (SELECT s.*, COALESCE(nl.new_leads, 0) AS new_leads FROM {snapshot_sql(P)} s LEFT JOIN nl ON nl.partner_id = s.partner_id),
rt AS (SELECT *, CASE WHEN denom + pending = 0 THEN 'noleads'
    WHEN denom > 0 AND installs / denom >= 0.60 THEN 'secured'
    WHEN new_leads > 0 AND (denom - new_leads) > 0 AND installs / (denom - new_leads) >= 0.60 THEN 'dropped'
    WHEN (installs + pending) >= 0.60 * (denom + pending) THEN 'almost' ELSE 'keepgoing' END AS screen FROM rin)"""


@query("dropped_crossing", W(NEW_LEADS_SQL + "\nSELECT partner_id, new_leads FROM nl"))
def dropped_crossing(spark, sf):
    return L.new_leads_since_crossing(_daily(tables(spark, sf)), P)


@query("route_screen", W(NEW_LEADS_SQL + "\nSELECT partner_id, new_leads, screen FROM rt"))
def route_screen(spark, sf):
    df = PO.standing(_route_input(spark, sf), P)
    return df.select("partner_id", F.coalesce(C("new_leads"), F.lit(0)).cast("bigint").alias("new_leads"), "screen")


@query("progress_metrics", W(f"""
SELECT partner_id, CAST(CASE WHEN denom > 0 THEN ROUND(100.0 * installs / denom) ELSE 0 END AS BIGINT) AS pct,
  CAST(ROUND(100.0 * (installs + 1) / (denom + 1)) AS BIGINT) AS next_pct,
  CAST(CASE WHEN denom > 0 THEN GREATEST(0, CEIL((3 * denom - 5 * installs) / 2.0)) WHEN pending > 0 THEN 1 ELSE 0 END AS BIGINT) AS needed,
  CAST({P.rate} * installs AS BIGINT) AS installpay,
  format('{{:,}}', {P.rate} * installs) AS installpay_text,
  CAST(GREATEST(0, {P.floor} - {P.rate} * installs) AS BIGINT) AS topup
FROM {snapshot_sql(P)} s"""))
def progress_metrics(spark, sf):
    return PO.progress(_snapshot(spark, sf), P).select(
        "partner_id", "pct", "next_pct", "needed", C("installpay").cast("bigint").alias("installpay"),
        "installpay_text", C("topup").cast("bigint").alias("topup"))


@query("needed_variants", W(NEW_LEADS_SQL + """
SELECT partner_id,
  CAST(CASE WHEN denom > 0 THEN GREATEST(0, CEIL((0.60 * denom - installs) / 0.40)) WHEN pending > 0 THEN 1 ELSE 0 END AS BIGINT) AS needed_growing,
  CAST(CASE WHEN denom + pending > 0 THEN GREATEST(1, FLOOR(0.60 * (denom + pending)) + 1 - installs) ELSE 0 END AS BIGINT) AS needed_poller,
  CAST(CASE WHEN denom + pending > 0 THEN GREATEST(1, CEIL(0.60 * (denom + pending)) - installs) ELSE 0 END AS BIGINT) AS needed_total,
  CAST(CASE WHEN screen = 'almost' THEN GREATEST(1, CEIL(0.60 * (denom + committed)) - installs)
            WHEN denom + pending > 0 THEN GREATEST(1, CEIL(0.60 * (denom + pending)) - installs) ELSE 0 END AS BIGINT) AS needed_committed
FROM rt"""))
def needed_variants(spark, sf):
    df = PO.standing(_route_input(spark, sf), P)
    return df.select("partner_id", *[PO.needed(k).alias(f"needed_{k}") for k in ("growing", "poller", "total", "committed")])


@query("calendar_facts", W(f"""
SELECT attempt_id, CAST(updated_at + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE) AS local_day,
  CAST(day(last_day(CAST(updated_at + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE)))
    - day(CAST(updated_at + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE)) AS INTEGER) AS days_left,
  CAST(day(last_day(CAST(updated_at + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE))) AS INTEGER) AS days_in_month,
  CAST(GREATEST(1, month(CAST(updated_at + to_minutes(CAST({P.offset_minutes} AS BIGINT)) AS DATE)) - 6) AS INTEGER) AS program_month
FROM f_attempts"""))
def calendar_facts(spark, sf):
    t = tables(spark, sf)
    return t.attempts.select("attempt_id", *PO.calendar(C("updated_at"), P.offset_minutes))


@query("visibility_gate", W(NEW_LEADS_SQL + f"""
SELECT partner_id, CASE WHEN hour({sql_ts(P.as_of)} + to_minutes(CAST({P.offset_minutes} AS BIGINT))) < 11
  THEN 'hold' ELSE screen END AS screen, screen AS screen_real FROM rt"""))
def visibility_gate(spark, sf):
    df = PO.gate_visibility(PO.standing(_route_input(spark, sf), P), ts_lit(P.as_of), P.offset_minutes)
    return df.select("partner_id", "screen", "screen_real")


def prev_sql_input(p: Params) -> str:
    """The record of month ``p`` of enrolled partners, with installs before / from the switch date."""
    return f"""
pen AS (SELECT partner_id FROM f_rosters WHERE category = 'enrolled'),
pdays AS (SELECT l.partner_id, count(*) FILTER (WHERE l.last_date < o.switch) AS inst_before,
    count(*) FILTER (WHERE l.last_date >= o.switch) AS inst_after
  FROM ({tech_collapse_sql(p)}) l JOIN f_overlay o USING (partner_id)
  WHERE l.has_installed = 1 AND {in_month_sql(p, 'l.last_date')} AND o.switch IS NOT NULL GROUP BY l.partner_id),
prec AS (SELECT s.partner_id, s.installs, s.denom, o.joined, o.rate_after, o.switch, d.inst_before, d.inst_after
  FROM {snapshot_sql(p)} s JOIN pen USING (partner_id) LEFT JOIN f_overlay o USING (partner_id) LEFT JOIN pdays d USING (partner_id))"""


def _prev_totals(spark, sf, p: Params = PREV):
    """A closed month's settled total for enrolled partners that have a record that month."""
    t = tables(spark, sf)
    en = t.rosters.where(C("category") == "enrolled").select("partner_id")
    return PO.prev_total(_snapshot(spark, sf, p), t.overlay, en, p, PO.rate_split(_daily(t, p), t.overlay))


@query("previous_month_total", W(prev_sql_input(PREV) + f"\nSELECT partner_id, total FROM {settle_sql('SELECT * FROM prec', PREV)} x"))
def previous_month_total(spark, sf):
    return _prev_totals(spark, sf).select("partner_id", "total")


@query("previous_month_total_switch", W(prev_sql_input(P) + f"\nSELECT partner_id, total FROM {settle_sql('SELECT * FROM prec', P)} x"))
def previous_month_total_switch(spark, sf):
    """The month in which rates switch, seen from the next one."""
    return _prev_totals(spark, sf, P).select("partner_id", "total")


# ------------------------------------------------------------- quality tiers
TIER_SQL = f"(SELECT canon FROM {values_sql(TIER_ALIASES.items())} spelt(alias, canon) WHERE alias = lower(trim(tier)))"
TIER_AMOUNT_SQL = f"(SELECT rupees FROM {values_sql(TIER_AMOUNTS.items())} paid(canon, rupees) WHERE canon = {{t}})"

QUALITY_SQL = f"""
q AS (SELECT r.partner_id, {TIER_SQL} AS tier, q.amount FROM f_rosters r LEFT JOIN f_quality q ON q.partner_id = r.partner_id),
qb AS (SELECT partner_id, tier, CAST(CASE WHEN tier IS NULL THEN NULL ELSE COALESCE(amount, {TIER_AMOUNT_SQL.format(t='tier')}) END AS BIGINT) AS amount,
  tier IS NOT NULL AS ready FROM q)"""


def _quality_bonus(spark, sf):
    from leadflow.operators.cohorts import quality_bonus
    t = tables(spark, sf)
    return quality_bonus(t.quality, t.rosters)


@query("quality_bonus", W(QUALITY_SQL + "\nSELECT * FROM qb"))
def quality_bonus(spark, sf):
    return _quality_bonus(spark, sf)


@query("quality_bonus_fallback", W(f"""
monthly AS (SELECT partner_id, CASE WHEN partner_id % 4 = 1 THEN NULL ELSE tier END AS tier, amount FROM f_quality WHERE partner_id % 3 <> 0),
usual AS (SELECT partner_id, coalesce(nullif(CASE WHEN partner_id % 2 = 0 THEN '' END, ''), 'good') AS tier, 700 AS amount FROM f_quality),
chosen AS (SELECT r.partner_id, CASE WHEN m.partner_id IS NOT NULL THEN m.tier ELSE u.tier END AS tier,
    CASE WHEN m.partner_id IS NOT NULL THEN m.amount ELSE u.amount END AS amount
  FROM f_rosters r LEFT JOIN monthly m USING (partner_id) LEFT JOIN usual u USING (partner_id)),
spelt_out AS (SELECT partner_id, {TIER_SQL} AS tier, amount FROM chosen)
SELECT partner_id, tier, CAST(CASE WHEN tier IS NOT NULL THEN coalesce(amount, {TIER_AMOUNT_SQL.format(t='tier')}) END AS BIGINT) AS amount,
  tier IS NOT NULL AS ready FROM spelt_out"""))
def quality_bonus_fallback(spark, sf):
    """P10 with a month file that lacks ids and tiers, and a default file that names its tier in other fields."""
    from leadflow.operators.cohorts import quality_bonus as qb
    t = tables(spark, sf)
    k = C("partner_id")
    month = t.quality.where(k % 3 != 0).withColumn("tier", F.when(k % 4 != 1, C("tier")))
    usual = t.quality.select("partner_id", F.when(k % 2 == 0, "").alias("tier"), F.lit(None).cast("string").alias("cohort"),
                             F.lit("good").alias("quality"), F.lit(700).cast("bigint").alias("amount"))
    return qb(month, t.rosters, usual)


@query("tier_alias", W(f"SELECT partner_id, tier AS raw_tier, {TIER_SQL} AS tier FROM f_quality"))
def tier_alias_q(spark, sf):
    t = tables(spark, sf)
    return t.quality.select("partner_id", C("tier").alias("raw_tier"), tier_alias(C("tier")).alias("tier"))


@query("quality_totals", W(QUALITY_SQL + """
SELECT COALESCE(tier, 'not_ready') AS tier, count(*) AS partners, CAST(sum(amount) AS BIGINT) AS total,
  CAST(min(amount) AS BIGINT) AS min_amount, CAST(max(amount) AS BIGINT) AS max_amount FROM qb GROUP BY tier
UNION ALL
SELECT 'all', count(*), CAST(sum(amount) AS BIGINT), CAST(min(amount) AS BIGINT), CAST(max(amount) AS BIGINT) FROM qb"""))
def quality_totals(spark, sf):
    from leadflow.operators.cohorts import quality_totals as qt
    return qt(_quality_bonus(spark, sf))


@query("support_amount", W(QUALITY_SQL + "," + prev_sql_input(PREV) + f"""
SELECT qb.partner_id, CAST(GREATEST(1000, FLOOR(0.8 * COALESCE(x.total, 0) + 0.5)) AS BIGINT) AS support
FROM qb LEFT JOIN {settle_sql('SELECT * FROM prec', PREV)} x ON x.partner_id = qb.partner_id
WHERE qb.tier = 'none'"""))
def support_amount(spark, sf):
    prev = _prev_totals(spark, sf).select("partner_id", C("total").alias("prev_total"))
    low = _quality_bonus(spark, sf).where(C("tier") == "none").select("partner_id")
    return PO.support_amount(low.join(prev, "partner_id", "left")).select("partner_id", "support")
