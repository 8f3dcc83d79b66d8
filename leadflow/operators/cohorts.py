"""Cohort, roster and quality-tier operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.functions.scalars import tier_alias, tier_amount

C = F.col


def _stated_tier(df: DataFrame) -> Column:
    """The first filled one of tier | cohort | quality, whichever of them the file has."""
    named = [F.nullif(F.trim(C(c)), F.lit("")) for c in ("tier", "cohort", "quality") if c in df.columns]
    return F.coalesce(*named) if len(named) > 1 else named[0]


def quality_bonus(month: DataFrame, ids: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Tier + amount per requested id: a row in the month's file is taken as it is, else the default file's.

    The amount is the row's override or the tier default; an id whose row has no usable tier is not ready
    (amount NULL), also where the default file would have one.
    """
    def rows(df: DataFrame, k: str) -> DataFrame:
        return df.select("partner_id", _stated_tier(df).alias(f"{k}_tier"), C("amount").alias(f"{k}_amount"), F.lit(True).alias(f"{k}_there"))

    out = ids.select("partner_id").join(rows(month, "m"), "partner_id", "left")
    raw_tier, raw_amount = C("m_tier"), C("m_amount")
    if fallback is not None:
        out = out.join(rows(fallback, "f"), "partner_id", "left")
        raw_tier = F.when(C("m_there"), C("m_tier")).otherwise(C("f_tier"))
        raw_amount = F.when(C("m_there"), C("m_amount")).otherwise(C("f_amount"))
    out = out.select("partner_id", tier_alias(raw_tier).alias("tier"), raw_amount.alias("raw_amount"))
    return out.select("partner_id", "tier",
                      F.when(C("tier").isNotNull(), F.coalesce(C("raw_amount"), tier_amount(C("tier"))))
                      .cast("bigint").alias("amount"),
                      C("tier").isNotNull().alias("ready"))


def quality_totals(qb: DataFrame) -> DataFrame:
    """Partners, total, min and max amount per tier, plus an overall row (one rollup pass)."""
    df = qb.withColumn("tier_label", F.coalesce(C("tier"), F.lit("not_ready")))
    r = df.rollup("tier_label").agg(
        F.count(F.lit(1)).alias("partners"), F.sum("amount").cast("bigint").alias("total"),
        F.min("amount").cast("bigint").alias("min_amount"), F.max("amount").cast("bigint").alias("max_amount"),
        F.grouping("tier_label").alias("_g"))
    return r.select(F.when(C("_g") == 1, F.lit("all")).otherwise(C("tier_label")).alias("tier"),
                    "partners", "total", "min_amount", "max_amount")


def roster_label(df: DataFrame, rosters: DataFrame, key: str = "partner_id") -> DataFrame:
    """enrolled / eligible / rest; an id absent from the roster (or NULL) is rest."""
    r = rosters.select(C("partner_id").alias(key), C("category").alias("_cat"))
    out = df.join(r, key, "left")
    return out.withColumn("category", F.coalesce(C("_cat"), F.lit("rest"))).drop("_cat")


def in_roster(df: DataFrame, roster: DataFrame, key: str = "partner_id") -> DataFrame:
    """Semi join (IN list)."""
    return df.join(roster.select(C("partner_id").alias(key)), key, "left_semi")


def not_in_roster(df: DataFrame, roster: DataFrame, key: str = "partner_id") -> DataFrame:
    """NOT IN (subquery): a NULL id never passes; plain anti join on the rest."""
    return df.where(C(key).isNotNull()).join(roster.select(C("partner_id").alias(key)), key, "left_anti")


# --------------------------------------------------------------- efficiency
def period_of(col: str, periods: list[tuple[str, object, object]]):
    """label by [start, end) periods (end None = open-ended); first match wins, else NULL."""
    from leadflow.functions.timecols import date_lit
    out = None
    for name, start, end in periods:
        cond = F.col(col) >= date_lit(start)
        if end is not None:
            cond = cond & (F.col(col) < date_lit(end))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def efficiency(bucketed: DataFrame, rosters: DataFrame, periods: list[tuple[str, object, object]], strict: bool = True) -> DataFrame:
    """(period x category) partners with resolved leads, leads, installs, aggregate %, secured, % secured."""
    from leadflow.functions.arith import at_gate, pct1_half_up
    b = F.col("bucket")
    slot = F.col("reached_slot") == 1
    per = (bucketed.withColumn("period", period_of("last_date", periods)).where(F.col("period").isNotNull())
           .groupBy("partner_id", "period").agg(
               F.count_if((b == "installed") & slot).alias("installs"),
               F.count_if(slot & ~b.isin("open", "system_other")).alias("denom"))
           .where(F.col("denom") > 0))
    cat = roster_label(per, rosters)
    sec = at_gate(C("installs"), C("denom"), 3, 5, strict=strict)
    g = cat.groupBy("period", "category").agg(
        F.count(F.lit(1)).alias("partners"), F.sum("denom").cast("bigint").alias("leads"),
        F.sum("installs").cast("bigint").alias("installs"), F.count_if(sec).alias("secured"))
    return g.select("period", "category", "partners", "leads", "installs",
                    pct1_half_up(C("installs"), C("leads")).alias("agg_eff"), "secured",
                    pct1_half_up(C("secured"), C("partners")).alias("pct_secured"))


def roster_breakdown(bucketed: DataFrame, enrolled: DataFrame, since, strict: bool = True) -> DataFrame:
    """One row of roster coverage: with leads, above / at-or-below gate, pending only, no activity."""
    from leadflow.functions.timecols import date_lit
    b = F.col("bucket")
    slot = F.col("reached_slot") == 1
    recent = F.col("last_date") >= date_lit(since)
    m = bucketed.groupBy("partner_id").agg(
        F.count_if((b == "installed") & slot & recent).alias("installs"),
        F.count_if(slot & ~b.isin("open", "system_other") & recent).alias("leads"),
        F.count_if(b == "open").alias("pending"))
    j = roster_left(enrolled, m, ["installs", "leads", "pending"])
    i, l, p = C("installs"), C("leads"), C("pending")
    above = (5 * i > 3 * l) if strict else (5 * i >= 3 * l)
    return j.agg(
        F.lit("ROSTER").alias("grp"), F.count(F.lit(1)).alias("enrolled_total"), F.count_if(l > 0).alias("with_leads"),
        F.count_if((l > 0) & above).alias("eff_60_plus"), F.count_if((l > 0) & ~above).alias("eff_60_minus"),
        F.count_if((l == 0) & (p > 0)).alias("pending_only"), F.count_if((l == 0) & (p == 0)).alias("no_activity"),
        F.sum("installs").cast("bigint").alias("total_installs"), F.sum("leads").cast("bigint").alias("total_leads"))


def roster_left(roster: DataFrame, metrics: DataFrame, cols) -> DataFrame:
    """Roster universe left-joined to metrics so partners without activity stay (zeros)."""
    out = roster.select("partner_id").distinct().join(metrics, "partner_id", "left")
    return out.select("partner_id", *[F.coalesce(C(c), F.lit(0)).cast("bigint").alias(c) for c in cols])


def dashboard_doc(eff: DataFrame, grid: DataFrame) -> DataFrame:
    """K4: every (period, category) cell present; absent cells are zeros."""
    cols = ["partners", "leads", "installs", "agg_eff", "secured", "pct_secured"]
    j = grid.join(eff, ["period", "category"], "left")
    return j.select("period", "category", *[F.coalesce(C(c), F.lit(0)).alias(c) for c in cols])


# --------------------------------------------------------------- enrolment / cohort
def enrolment_dates(optins: DataFrame, audits: DataFrame, rosters: DataFrame, offset_minutes: int = 330) -> DataFrame:
    """Flow 1 = first opt-in, flow 2 = last completed audit; local date.

    Actions are reduced to a row a partner first, so that a partner with very many of them is combined map-side.
    """
    from leadflow.functions.timecols import local_date
    first = optins.groupBy("partner_id").agg(F.min("opted_at").alias("at")).withColumn("flow", F.lit(1))
    last = audits.groupBy("partner_id").agg(F.max("scan_complete_at").alias("at")).withColumn("flow", F.lit(2))
    flows = rosters.where(C("flow").isin(1, 2)).select("partner_id", "flow").distinct()
    u = first.unionByName(last).join(flows, ["partner_id", "flow"], "left_semi")
    return u.select("partner_id", "flow", local_date(C("at"), offset_minutes).alias("enrolled_on"))


def build_cohort(rosters: DataFrame, optins: DataFrame, audits: DataFrame) -> DataFrame:
    """(flow 1 ∪ flow 2) ∩ opted in; flow 2 must also be audited."""
    opted = optins.where(C("opted_at").isNotNull()).select("partner_id").distinct()
    audited = audits.where(C("scan_complete_at").isNotNull()).select("partner_id").distinct()
    f1 = rosters.where(C("flow") == 1).select("partner_id")
    f2 = rosters.where(C("flow") == 2).select("partner_id").join(audited, "partner_id", "left_semi")
    return f1.unionByName(f2).distinct().join(opted, "partner_id", "left_semi")


def identities(roster: DataFrame, users: DataFrame) -> DataFrame:
    """Partner list -> every active user id in the three roles (user ids, never partner ids)."""
    u = active_users(users)
    return u.join(roster.select("partner_id").distinct(), "partner_id", "left_semi").select("user_id", "partner_id")


def map_accounts(df: DataFrame, accounts: DataFrame, how: str = "left") -> DataFrame:
    """External account name <-> partner id."""
    return df.join(accounts.select("partner_id", "account_name"), "partner_id", how)


def lapse_breakdown(bucketed: DataFrame, universe: DataFrame, start, end) -> DataFrame:
    """Partners on the no-leads screen (nothing resolved this month, nothing open): truly none, or all lapsed by cause.

    ``truly_none`` had no lead that closed in the month. ``all_lapsed`` had some, and every one ended before a slot was
    confirmed (a terminal bucket other than installed); its rows count leads by that bucket. Leads are counted by
    (partner, bucket) before anything else, so a hot partner is a handful of rows.
    """
    from leadflow.functions.timecols import date_lit
    b = F.col("bucket")
    m = (F.col("last_date") >= date_lit(start)) & (F.col("last_date") < date_lit(end))
    slot = F.col("reached_slot") == 1
    counts = bucketed.groupBy("partner_id", "bucket").agg(
        F.count_if(m & slot & ~b.isin("open", "system_other")).alias("resolved"),
        F.count_if(b == "open").alias("open"), F.count_if(m).alias("closed"),
        F.count_if(m & ~slot & ~b.isin("open", "installed")).alias("lapsed"))
    per = counts.groupBy("partner_id").agg(
        *[F.sum(c).alias(c) for c in ("resolved", "open", "closed", "lapsed")],
        F.collect_list(F.when(C("lapsed") > 0, F.struct(C("bucket").alias("cause"), C("lapsed").alias("n")))).alias("causes"))
    u = universe.select("partner_id").distinct().join(per, "partner_id", "left").na.fill(0, ["resolved", "open", "closed", "lapsed"])
    u = u.where((C("resolved") == 0) & (C("open") == 0) & (C("closed") == C("lapsed")))
    none = F.array(F.struct(F.lit("none").alias("cause"), F.lit(0).cast("bigint").alias("n")))
    rows = u.select("partner_id", F.when(C("closed") == 0, "truly_none").otherwise("all_lapsed").alias("kind"),
                    F.inline(F.when(C("closed") == 0, none).otherwise(C("causes"))))
    return rows.groupBy("kind", "cause").agg(F.count(F.lit(1)).alias("partners"), F.sum("n").cast("bigint").alias("leads"))


def with_overlay(record: DataFrame, overlay: DataFrame, key: str = "partner_id") -> DataFrame:
    """Record ⟕ overlay on the normalised (lower-cased text) id; on a clash the overlay wins.

    Columns only in the overlay are added; columns in both become coalesce(overlay, record).
    """
    norm = F.lower(F.col(key).cast("string"))
    ov_cols = [c for c in overlay.columns if c != key]
    o = overlay.select(norm.alias("_k"), *[F.col(c).alias(f"_o_{c}") for c in ov_cols])
    j = record.withColumn("_k", norm).join(o, "_k", "left").drop("_k")
    out = []
    for c in record.columns:
        out.append(F.coalesce(F.col(f"_o_{c}"), F.col(c)).alias(c) if c in ov_cols else F.col(c))
    out += [F.col(f"_o_{c}").alias(c) for c in ov_cols if c not in record.columns]
    return j.select(*out)


def active_users(users: DataFrame) -> DataFrame:
    """S3: live rows of active users in the three partner roles (a pushed-down filter)."""
    return users.where(F.col("active") & (F.col("status") == "ACTIVE") & F.col("role").isin("OWNER", "MANAGER", "MANAGER_PLUS")
                       & F.col("user_id").isNotNull())


def dashboard_document(funnel: DataFrame, segments: DataFrame, eff_grid: DataFrame, roster: DataFrame) -> DataFrame:
    """K4: the four dashboard results -> ONE nested row (like the published document).

    Every input is already a bounded aggregate (2 funnel groups, 3 segments, the fixed
    period x category grid, 1 roster row), so the few rows gathered here do not grow with
    the data. Absent cells are zeros (the grid is complete, see ``dashboard_doc``).
    """
    def as_map(df: DataFrame, key: str, name: str) -> DataFrame:
        vals = [c for c in df.columns if c != key]
        return df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.struct(*vals)))).alias(name))

    eng = as_map(funnel, "grp", "engagement")
    seg = as_map(segments, "segment", "segments")
    cells = eff_grid.groupBy("period").agg(
        F.map_from_entries(F.collect_list(F.struct("category", F.struct(
            *[c for c in eff_grid.columns if c not in ("period", "category")])))).alias("cats"))
    eff = cells.agg(F.map_from_entries(F.collect_list(F.struct("period", "cats"))).alias("efficiency"))
    ros = roster.select(F.struct(*roster.columns).alias("enrolled_roster"))
    # four single-row frames side by side: a union of tagged rows folded by one aggregate
    parts = [eng.select(F.col("engagement"), *[F.lit(None).alias(n) for n in ("segments", "efficiency", "enrolled_roster")]),
             seg.select(F.lit(None).alias("engagement"), "segments", *[F.lit(None).alias(n) for n in ("efficiency", "enrolled_roster")]),
             eff.select(*[F.lit(None).alias(n) for n in ("engagement", "segments")], "efficiency", F.lit(None).alias("enrolled_roster")),
             ros.select(*[F.lit(None).alias(n) for n in ("engagement", "segments", "efficiency")], "enrolled_roster")]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x, allowMissingColumns=False)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("engagement", "segments", "efficiency", "enrolled_roster")])
