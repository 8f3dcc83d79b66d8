"""Guarantee payout and banner metrics as column expressions (no per-row Python).

Money is whole rupees and every rounding is exact integer arithmetic (half-up unless
noted), so results never depend on floating point.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.functions.arith import at_gate, idiv, pct_half_up, round_half_up_ratio
from leadflow.functions.timecols import date_lit, local_date, shift_minutes
from leadflow.plans.params import DEFAULT, Params

C = F.col


def _i(name: str) -> Column:
    return F.coalesce(C(name), F.lit(0)).cast("bigint")


# ------------------------------------------------------------------ P1 standing
def standing(df: DataFrame, p: Params = DEFAULT, strict: bool = False) -> DataFrame:
    """noleads / secured / dropped / almost / keepgoing (first match), exact integer compares.

    Needs installs, denom, pending and optionally new_leads.
    """
    i, d, pend = _i("installs"), _i("denom"), _i("pending")
    nl = _i("new_leads") if "new_leads" in df.columns else F.lit(0).cast("bigint")
    total = d + pend
    gn, gd = p.gate_num, p.gate_den
    secured = at_gate(i, d, gn, gd, strict)
    dropped = (nl > 0) & at_gate(i, d - nl, gn, gd, strict)
    almost = (gd * (i + pend) > gn * total) if strict else (gd * (i + pend) >= gn * total)
    screen = (F.when(total == 0, "noleads").when(secured, "secured").when(dropped, "dropped")
              .when(almost, "almost").otherwise("keepgoing"))
    return df.withColumn("screen", screen)


# ------------------------------------------------------------- P2 / P3 progress
def needed(policy: str = "growing") -> Column:
    """Installs still needed to clear the gate, by historical policy (gate 0.60 only).

    growing  : ceil((3d - 5i)/2) >= 0 (each install is also a lead); d = 0 -> 1 if pending
    poller   : max(1, floor(0.6*total) + 1 - i), 0 when total = 0
    total    : max(1, ceil(0.6*total) - i), 0 when total = 0
    committed: like total, but the almost screen projects only committed open leads
    """
    i, d, pend = _i("installs"), _i("denom"), _i("pending")
    total = d + pend
    if policy == "growing":
        return (F.when(d > 0, F.greatest(F.lit(0), idiv(3 * d - 5 * i + 1, F.lit(2))))
                .otherwise(F.when(pend > 0, 1).otherwise(0))).cast("bigint")
    if policy == "poller":
        return F.when(total > 0, F.greatest(F.lit(1), idiv(3 * total, F.lit(5)) + 1 - i)).otherwise(0).cast("bigint")
    ceil_total = F.greatest(F.lit(1), idiv(3 * total + 4, F.lit(5)) - i)
    if policy == "total":
        return F.when(total > 0, ceil_total).otherwise(0).cast("bigint")
    if policy == "committed":
        base = d + _i("committed")
        ceil_c = F.greatest(F.lit(1), idiv(3 * base + 4, F.lit(5)) - i)
        return (F.when(C("screen") == "almost", ceil_c).when(total > 0, ceil_total).otherwise(0)).cast("bigint")
    raise ValueError(policy)


def progress(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    i, d = _i("installs"), _i("denom")
    return df.select(
        "*",
        pct_half_up(i, d).alias("pct"),
        pct_half_up(i + 1, d + 1).alias("next_pct"),
        needed("growing").alias("needed"),
        (F.lit(p.rate) * i).alias("installpay"),
        F.format_number(F.lit(p.rate) * i, 0).alias("installpay_text"),
        F.greatest(F.lit(0), F.lit(p.floor) - F.lit(p.rate) * i).alias("topup"),
    )


# ------------------------------------------------------------- P4 calendar
def calendar(now_utc: Column, offset_minutes: int = 330) -> list[Column]:
    """Local calendar facts for an instant: local day, days left, days in month, program month."""
    d = local_date(now_utc, offset_minutes)
    dim = F.dayofmonth(F.last_day(d))
    return [d.alias("local_day"), (dim - F.dayofmonth(d)).alias("days_left"), dim.alias("days_in_month"),
            F.greatest(F.lit(1), F.month(d) - 6).alias("program_month")]


# ---------------------------------------------------- P6 / P7 / P5 / P8 settle
def prorata(joined: Column, month_start: dt.date, days_in_month: int, floor: int) -> Column:
    """round(floor * (dim - day + 1) / dim) if joined inside the month, else the full floor."""
    ym = month_start.strftime("%Y-%m")
    inside = joined.isNotNull() & (F.date_format(joined, "yyyy-MM") == F.lit(ym))
    active_days = F.lit(days_in_month) - F.dayofmonth(joined) + 1
    return F.when(inside, round_half_up_ratio(F.lit(floor) * active_days, F.lit(days_in_month))) \
        .otherwise(F.lit(floor)).cast("bigint")


def install_money(p: Params = DEFAULT) -> Column:
    """Flat rate; for months before the two-tier cut-off, a switch partner is split around the switch month."""
    i = _i("installs")
    flat = F.lit(p.rate) * i
    if not p.month_ym < p.two_tier_before:
        return flat.cast("bigint")
    sw = F.date_format(C("switch"), "yyyy-MM")
    ym = F.lit(p.month_ym)
    tiered = (F.when(ym < sw, flat)
              .when(ym == sw, F.lit(p.rate) * _i("inst_before") + _i("rate_after") * _i("inst_after"))
              .otherwise(_i("rate_after") * i))
    return F.when(C("rate_after").isNotNull() & C("switch").isNotNull(), tiered).otherwise(flat).cast("bigint")


def settle(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Month-end settlement per partner record (installs, denom [+ overlay columns]).

    floor_eligible = few leads (<= 2) or secured (>= gate); top-up fills the (pro-rata)
    floor; case = above / topup / deep / noleads / fewleads / below60; deep iff top-up > floor/2.
    """
    for c, t in (("joined", "date"), ("rate_after", "int"), ("switch", "date"), ("inst_before", "bigint"),
                 ("inst_after", "bigint")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    i, d = _i("installs"), _i("denom")
    floor = prorata(C("joined"), p.month_start, p.days_in_month, p.floor)
    pay = install_money(p)
    secured = at_gate(i, d, p.gate_num, p.gate_den)
    few = d <= p.few_leads
    eligible = few | secured
    topup = F.when(eligible & (pay < floor), floor - pay).otherwise(0).cast("bigint")
    case = case_of(eligible, pay, floor, d, few)
    out = df.select("*", floor.alias("floor"), pay.alias("installpay"), pct_half_up(i, d).alias("pct"),
                    secured.alias("secured"), few.alias("fewleads"), eligible.alias("floor_eligible"),
                    topup.alias("topup"), (pay + topup).alias("total"), case.alias("case"),
                    (C("joined") >= date_lit(p.month_end)).alias("joined_after"))
    return out


def case_of(eligible: Column, pay: Column, floor: Column, denom: Column, few: Column) -> Column:
    """below60 / above / noleads / fewleads / deep / topup; deep iff the top-up exceeds half the floor."""
    return (F.when(~eligible, "below60").when(pay >= floor, "above").when(denom == 0, "noleads")
            .when(few, "fewleads").when(2 * (floor - pay) > floor, "deep").otherwise("topup"))


def settle_record(enrolled: DataFrame, daily: DataFrame, overlay: DataFrame) -> DataFrame:
    """The settlement input: enrolled partners with installs, denom, overlay fields and the split at the switch date.

    ``daily`` are (partner, day) counts (``leads.daily_leads``), so the join with the overlay meets a row a day.
    """
    ov = overlay.select("partner_id", "joined", "rate_after", "switch")
    per = daily.join(ov.select("partner_id", "switch"), "partner_id", "left").groupBy("partner_id").agg(
        F.sum("i_d").cast("bigint").alias("installs"), F.sum("d_d").cast("bigint").alias("denom"),
        F.sum(F.when(C("last_date") < C("switch"), C("i_d"))).cast("bigint").alias("inst_before"),
        F.sum(F.when(C("last_date") >= C("switch"), C("i_d"))).cast("bigint").alias("inst_after"))
    out = enrolled.select("partner_id").join(per, "partner_id", "left").join(ov, "partner_id", "left")
    return out.select("partner_id", F.coalesce(C("installs"), F.lit(0)).alias("installs"),
                      F.coalesce(C("denom"), F.lit(0)).alias("denom"), "joined", "rate_after", "switch",
                      "inst_before", "inst_after")


def prev_total(snap: DataFrame, overlay: DataFrame, enrolled: DataFrame, p: Params, split: DataFrame) -> DataFrame:
    """The previous month's settled total for enrolled partners that have a record that month.

    ``split`` (A25, partner_id, inst_before, inst_after) pays the switch month at both rates.
    """
    rec = snap.select("partner_id", "installs", "denom").join(enrolled.select("partner_id"), "partner_id", "left_semi")
    ov = overlay.select("partner_id", "joined", "rate_after", "switch")
    parts = split.select("partner_id", "inst_before", "inst_after")
    return settle(rec.join(ov, "partner_id", "left").join(parts, "partner_id", "left"), p).select("partner_id", "total")


def outcome_group(settled: DataFrame) -> DataFrame:
    """Partner -> topup (floor eligible) / piece (piece-rate only)."""
    return settled.select("partner_id", F.when(C("floor_eligible"), "topup").otherwise("piece").alias("outcome"))


def payout_totals(settled: DataFrame) -> DataFrame:
    """One programme row."""
    return settled.agg(
        F.count(F.lit(1)).alias("partners"),
        F.sum("installs").cast("bigint").alias("installs"),
        F.sum("installpay").cast("bigint").alias("install_money"),
        F.sum("topup").cast("bigint").alias("topup_money"),
        F.sum("total").cast("bigint").alias("total_payout"),
        F.count_if(C("floor_eligible")).alias("floor_eligible"),
        F.count_if(C("fewleads")).alias("eligible_fewleads"),
        F.count_if(C("secured") & ~C("fewleads")).alias("eligible_secured"),
        F.count_if(~C("floor_eligible")).alias("piece_rate"),
    )


def rate_split(daily: DataFrame, overlay: DataFrame) -> DataFrame:
    """Per switch partner, month installs before / on-or-after the switch date, from (partner, day) counts."""
    ov = overlay.where(C("switch").isNotNull()).select("partner_id", "switch")
    j = daily.where(C("i_d") > 0).join(ov, "partner_id", "inner")
    return j.groupBy("partner_id").agg(
        F.sum("i_d").cast("bigint").alias("installs"),
        F.sum(F.when(C("last_date") < C("switch"), C("i_d")).otherwise(0)).cast("bigint").alias("inst_before"),
        F.sum(F.when(C("last_date") >= C("switch"), C("i_d")).otherwise(0)).cast("bigint").alias("inst_after"))


def support_amount(df: DataFrame, minimum: int = 1000) -> DataFrame:
    """Lowest tier's support = max(minimum, round(0.8 * prior month's earning)) (half-up)."""
    prev = _i("prev_total")
    return df.withColumn("support", F.greatest(F.lit(minimum).cast("bigint"), idiv(8 * prev + 5, F.lit(10))))


def gate_visibility(df: DataFrame, now_utc: Column, offset_minutes: int = 330, open_hour: int = 11) -> DataFrame:
    """Before ``open_hour`` local time the public screen is 'hold'; screen_real keeps the truth."""
    hour = F.hour(shift_minutes(now_utc, offset_minutes))
    return df.withColumn("screen_real", C("screen")).withColumn(
        "screen", F.when(hour < open_hour, F.lit("hold")).otherwise(C("screen")))
