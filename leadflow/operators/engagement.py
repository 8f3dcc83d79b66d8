"""Engagement: event attribution, click funnels, daily openers, coverage, campaign variants.

Distinct counts at (group, profile) grain are reduced map-side by Catalyst's
expand-based distinct aggregation, so a hot group does not pin raw events to one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.functions.arith import pct1_half_up, pct_half_even, pct_half_up, round_half_up_ratio
from leadflow.functions.joins import heavy_keys, left_fill, salted_join
from leadflow.functions.leads import flag, is_installed
from leadflow.functions.timecols import ts_lit

C = F.col


def events_since(events: DataFrame, name: str, start: dt.datetime) -> DataFrame:
    """Named events at/after ``start`` (event time is already local; no shift)."""
    return events.where((C("event_name") == name) & (C("ts") >= ts_lit(start)))


def live(events: DataFrame) -> DataFrame:
    """Events whose row is live in the landed table (``deleted`` is false)."""
    return events.where(~C("deleted"))


def lower_id(df: DataFrame, key: str = "partner_id") -> DataFrame:
    """Partner ids in lower case where they are text; numbers stay."""
    return df.withColumn(key, F.lower(C(key))) if dict(df.dtypes)[key] == "string" else df


def profile_bridge(profiles: DataFrame, roster: DataFrame | None = None, undeleted: bool = True) -> DataFrame:
    """Distinct profile -> partner (lower-cased), optionally undeleted only and restricted to a roster."""
    b = lower_id(profiles)
    if undeleted:
        b = b.where(~F.coalesce(C("deleted"), F.lit(False)))
    b = b.select("profile_id", "partner_id").where(C("partner_id").isNotNull()).distinct()
    if roster is not None:
        b = b.join(lower_id(roster.select("partner_id")), "partner_id", "left_semi")
    return b


def attribute(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """Events -> partner through the profile bridge (inner)."""
    return events.join(bridge, "profile_id", "inner")


def attribute_skewed(events: DataFrame, bridge: DataFrame, share: float = 0.005) -> DataFrame:
    """J1 where single profiles may hold a large part of the events: those above ``share`` are salted before the join."""
    spark = events.sparkSession
    return salted_join(events, bridge, "profile_id", heavy_keys(events, "profile_id", share), int(spark.conf.get("spark.sql.shuffle.partitions")))


def per_profile(events: DataFrame, name: str, start: dt.datetime, by_day: bool = False) -> DataFrame:
    """Named events reduced to (profile[, day]) counts and first/last time BEFORE any join.

    Events are the largest input; combining them map-side per profile means a profile with
    a third of all events costs one partial row per task, and only per-profile rows reach
    the shuffle join with the bridge.
    """
    keys = [C("profile_id")] + ([C("ts").cast("date").alias("day")] if by_day else [])
    return events_since(events, name, start).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("mn"), F.max("ts").alias("mx"))


def click_counts(profile_counts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Events per partner (per-profile counts attributed, then summed)."""
    return (profile_counts.join(bridge, "profile_id", "inner")
            .groupBy("partner_id").agg(F.sum("n").cast("bigint").alias("n_clicks")))


def partner_funnel(attempts: DataFrame, since: dt.datetime) -> DataFrame:
    """Per partner, tasks created since ``since`` with a slot / executor / install."""
    a = attempts.where(C("active") & (C("created_at") >= ts_lit(since)))
    return a.groupBy("partner_id").agg(
        F.count_if(C("confirmed_slot_at").isNotNull()).alias("slot_tasks"),
        F.count_if(C("executor_id").isNotNull()).alias("tech_tasks"),
        F.count_if(is_installed(strict=False)).alias("installed_tasks"))


def click_histogram(base: DataFrame, group: str = "grp") -> DataFrame:
    """Clickers, clicks, stages reached and the 1/2/3/4+ click histogram per group."""
    n = C("n_clicks")
    return base.groupBy(group).agg(
        F.count(F.lit(1)).alias("clickers"), F.sum(n).cast("bigint").alias("total_clicks"),
        F.count_if(C("slot_tasks") > 0).alias("reached_slot"), F.count_if(C("tech_tasks") > 0).alias("reached_tech"),
        F.count_if(C("installed_tasks") > 0).alias("reached_install"),
        F.count_if(n == 1).alias("clicked_1"), F.count_if(n == 2).alias("clicked_2"), F.count_if(n == 3).alias("clicked_3"),
        F.count_if(n >= 4).alias("clicked_4_more"))


def profiles_by_group(profile_counts: DataFrame, bridge: DataFrame, base: DataFrame, group: str = "grp") -> DataFrame:
    """A10: distinct profiles per group (profiles with events, of partners present in ``base``)."""
    j = (profile_counts.select("profile_id").join(bridge, "profile_id", "inner")
         .join(base.select("partner_id", group), "partner_id", "inner"))
    return j.groupBy(group).agg(F.countDistinct("profile_id").alias("profiles"))


def engagement_funnel(events: DataFrame, profiles: DataFrame, attempts: DataFrame, roster: DataFrame,
                      events_start: dt.datetime, tasks_since: dt.datetime) -> DataFrame:
    """Programme vs rest clickers, clicks, stages, histogram and profile counts."""
    bridge = profile_bridge(profiles, undeleted=False)
    per = per_profile(events, "banner_opened", events_start)
    clicks = click_counts(per, bridge)
    inst = partner_funnel(attempts, tasks_since)
    base = left_fill(clicks, inst, "partner_id", ["slot_tasks", "tech_tasks", "installed_tasks"])
    prog = roster.select("partner_id").distinct().withColumn("_in", F.lit(True))
    base = base.join(prog, "partner_id", "left").withColumn(
        "grp", F.when(C("_in").isNotNull(), "programme").otherwise("rest")).drop("_in")
    return with_profiles(click_histogram(base), profiles_by_group(per, bridge, base))


def with_profiles(agg: DataFrame, prof: DataFrame, group: str = "grp") -> DataFrame:
    """Group aggregate ⋈ distinct-profile counts (a group without profile rows drops out)."""
    return agg.join(prof, group, "inner")


def partner_stages(attempts: DataFrame, since: dt.datetime) -> DataFrame:
    """Per partner, tasks created since ``since``: how many, which stages were reached, and tasks by stage."""
    slot, tech, done = C("confirmed_slot_at").isNotNull(), C("executor_id").isNotNull(), is_installed(False)
    arrived = (C("current_state") == "ARRIVED_AT_SITE") | (C("completed_step") >= 1)
    return attempts.where(C("active") & (C("created_at") >= ts_lit(since))).groupBy("partner_id").agg(
        F.count(F.lit(1)).alias("connections"),
        F.max(flag(slot)).alias("slot_partners"), F.max(flag(tech)).alias("tech_partners"),
        F.max(flag(done)).alias("install_partners"),
        F.count_if(C("proposed_slot_date").isNotNull()).alias("tasks_slot_proposed"),
        F.count_if(slot).alias("tasks_slot_confirmed"), F.count_if(tech).alias("tasks_tech"),
        F.count_if(arrived).alias("tasks_arrived"), F.count_if(done).alias("tasks_installed"))


STAGE_COLS = ("slot_partners", "tech_partners", "install_partners", "connections", "tasks_slot_proposed",
              "tasks_slot_confirmed", "tasks_tech", "tasks_arrived", "tasks_installed")


def segment_funnel(events: DataFrame, profiles: DataFrame, attempts: DataFrame, roster: DataFrame,
                   events_start: dt.datetime, tasks_since: dt.datetime) -> DataFrame:
    """Roster clicked / roster not clicked / outside the roster: partners and tasks per stage.

    One scan of the attempts: their partner rows meet the roster in one full outer join, the clickers in a left join.
    """
    bridge = profile_bridge(profiles, undeleted=False)
    clickers = (per_profile(events, "banner_opened", events_start).select("profile_id")
                .join(bridge, "profile_id", "inner").select("partner_id").distinct())
    j = union_segments(roster, clickers, partner_stages(attempts, tasks_since))
    return j.groupBy("segment").agg(
        F.count(F.lit(1)).alias("base_partners"), F.count(C("connections")).alias("active_partners"),
        *[F.sum(F.coalesce(C(c), F.lit(0))).cast("bigint").alias(c) for c in STAGE_COLS])


def union_segments(roster: DataFrame, clickers: DataFrame, inst: DataFrame) -> DataFrame:
    """Partner, segment and the partner's columns of ``inst``: the roster labelled clicked / not clicked, and active
    partners outside it."""
    r = roster.select("partner_id").distinct().withColumn("_r", F.lit(True))
    c = clickers.select("partner_id").distinct().withColumn("_c", F.lit(True))
    j = r.join(inst, "partner_id", "full_outer").where(C("partner_id").isNotNull()).join(c, "partner_id", "left")
    segment = (F.when(C("_r").isNull(), "C_outside").when(C("_c").isNotNull(), "A_clicked").otherwise("B_noclick"))
    return j.select("partner_id", segment.alias("segment"), *[x for x in inst.columns if x != "partner_id"])


def daily_opens(events: DataFrame, bridge: DataFrame, start: dt.datetime) -> DataFrame:
    """Per (partner, day): opens, first and last open (the engagement job's remote grain).

    Live events only; pre-aggregated per (profile, day) before the bridge join (see ``per_profile``)."""
    per = per_profile(live(events), "banner_opened", start, by_day=True).join(bridge, "profile_id", "inner")
    return per.groupBy("partner_id", "day").agg(
        F.sum("n").cast("bigint").alias("n"), F.min("mn").alias("mn"), F.max("mx").alias("mx"))


def daily_engagement(opens: DataFrame) -> DataFrame:
    """Per day unique partners and opens."""
    return opens.groupBy("day").agg(F.countDistinct("partner_id").alias("partners"),
                                    F.sum("n").cast("bigint").alias("opens"))


def engagement_summary(opens: DataFrame, cohort: DataFrame) -> DataFrame:
    """Eligible, opened, % opened (half-even), total opens, avg per opener (1 dp, half-up), first/last.

    Cohort and opens are unioned and reduced per partner, then one global aggregate —
    no join between single-row results.
    """
    c = cohort.select("partner_id", F.lit(1).alias("in_cohort"), F.lit(None).cast("bigint").alias("n"),
                      F.lit(None).cast("timestamp_ntz").alias("mn"), F.lit(None).cast("timestamp_ntz").alias("mx"))
    o = opens.select("partner_id", F.lit(0).alias("in_cohort"), C("n").cast("bigint").alias("n"), "mn", "mx")
    per = c.unionByName(o).groupBy("partner_id").agg(
        F.max("in_cohort").alias("in_cohort"), F.sum("n").alias("n"), F.min("mn").alias("mn"), F.max("mx").alias("mx"))
    g = per.agg(F.count_if(C("in_cohort") == 1).alias("eligible"), F.count_if(C("n") > 0).alias("opened"),
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_opens"),
                F.min("mn").alias("first_open"), F.max("mx").alias("last_open"))
    n, tot = C("opened"), C("total_opens")
    return g.select("eligible", "opened", pct_half_even(n, C("eligible")).alias("pct_opened"), "total_opens",
                    F.when(n > 0, round_half_up_ratio(10 * tot, n) / 10.0).otherwise(F.lit(0.0)).alias("avg_per_opener"),
                    "first_open", "last_open")


def engagement_by_outcome(opens: DataFrame, groups: DataFrame) -> DataFrame:
    """Opened / total / % (half-even) per payout outcome group."""
    opened = opens.select("partner_id").distinct().withColumn("_o", F.lit(1))
    j = groups.select("partner_id", "outcome").join(opened, "partner_id", "left")
    g = j.groupBy("outcome").agg(F.count(C("_o")).alias("opened"), F.count(F.lit(1)).alias("total"))
    return g.select("outcome", "opened", "total", pct_half_even(C("opened"), C("total")).alias("pct"))


def daily_uniques(events: DataFrame) -> DataFrame:
    """True per-day uniques vs uniques counted on each identity's last active day (undercount)."""
    ev = events.select("profile_id", C("ts").cast("date").alias("day"))
    true_u = ev.groupBy("day").agg(F.countDistinct("profile_id").alias("uniq"))
    last = ev.groupBy("profile_id").agg(F.max("day").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("last_active"))
    return true_u.join(last, "day", "left").select("day", "uniq", F.coalesce(C("last_active"), F.lit(0)).alias("last_active"))


def variant_totals(events: DataFrame, inventory: DataFrame) -> DataFrame:
    """A logical campaign = several variant ids; per-variant rows plus the campaign sum (rollup).

    Events are counted by name first, so the join and the rollup see one row a name.
    """
    named = events.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))
    r = named.join(inventory, "event_name", "inner").rollup("campaign", "event_name").agg(
        F.sum("n").cast("bigint").alias("events"), F.grouping_id().alias("_g"))
    return r.where(C("_g") < 3).select("campaign", F.when(C("_g") == 1, F.lit("ALL")).otherwise(C("event_name")).alias("variant"),
                                       "events")


def freshest_profile(profiles: DataFrame) -> DataFrame:
    """Newest identity per partner by last-seen (id breaks ties)."""
    return (profiles.where(C("partner_id").isNotNull()).groupBy("partner_id")
            .agg(F.max_by("profile_id", F.struct("last_seen", "profile_id")).alias("profile_id"),
                 F.max("last_seen").alias("last_seen")))


def view_click(events: DataFrame) -> DataFrame:
    """Per campaign and day, profiles that viewed, that clicked, and the click rate (half-up %).

    Reduced to two flags a (day, campaign, profile) first, so each event is shuffled once at most, not once a distinct.
    """
    per = events.groupBy(C("ts").cast("date").alias("day"), "campaign", "profile_id").agg(
        F.max(flag(C("event_name") == "banner_opened")).alias("v"), F.max(flag(C("event_name") == "click")).alias("c"))
    g = per.groupBy("day", "campaign").agg(F.sum("v").cast("bigint").alias("viewed"), F.sum("c").cast("bigint").alias("clicked"))
    return g.select("day", "campaign", "viewed", "clicked", pct_half_up(C("clicked"), C("viewed")).alias("rate"))


def coverage(screens: DataFrame, views: DataFrame, active_base: DataFrame, today: DataFrame, min_views: int = 5) -> DataFrame:
    """viewers' active base / targeted active base.

    The no-leads group is targeted only if TODAY's views of the no-leads partners exceed ``min_views`` (the campaign is
    live for them). ``screens`` = (partner_id, screen); ``views`` = (partner_id, n) over the window; ``today`` = the same
    of the current day; ``active_base`` = (partner_id, base). One per-partner join, then ONE global aggregate that carries
    both the with- and without-no-leads sums; the choice is made after it.
    """
    t = today.select("partner_id", C("n").alias("n_today"))
    s = (screens.join(active_base, "partner_id", "left").join(views, "partner_id", "left").join(t, "partner_id", "left")
         .select("partner_id", (C("screen") == "noleads").alias("nl"), F.coalesce(C("base"), F.lit(0)).alias("base"),
                 F.coalesce(C("n"), F.lit(0)).alias("n"), F.coalesce(C("n_today"), F.lit(0)).alias("n_today")))
    v = C("n") > 0
    g = s.agg(
        F.sum(F.when(C("nl"), C("n_today")).otherwise(0)).alias("nl_views"),
        *[x for grp, cond in (("o", ~C("nl")), ("l", C("nl"))) for x in (
            F.count_if(cond).alias(f"{grp}_tp"), F.count_if(cond & v).alias(f"{grp}_vp"),
            F.sum(F.when(cond, C("base")).otherwise(0)).alias(f"{grp}_tb"),
            F.sum(F.when(cond & v, C("base")).otherwise(0)).alias(f"{grp}_vb"))])
    inc = F.coalesce(C("nl_views"), F.lit(0)) > min_views

    def pick(x):
        return (F.coalesce(C(f"o_{x}"), F.lit(0)) + F.when(inc, F.coalesce(C(f"l_{x}"), F.lit(0))).otherwise(0)).cast("bigint")

    out = g.select(pick("tp").alias("targeted_partners"), pick("vp").alias("viewer_partners"),
                   pick("tb").alias("targeted_base"), pick("vb").alias("viewer_base"), inc.alias("includes_noleads"))
    return out.withColumn("coverage_pct", pct1_half_up(C("viewer_base"), C("targeted_base")))


def engagement_document(summary: DataFrame, by_outcome: DataFrame, daily: DataFrame) -> DataFrame:
    """E3 output as one nested row: the summary fields, outcome groups as a map and the
    per-day list in date order. The day list is bounded by the window's length, not by the
    number of events; the outcome map by the number of payout groups."""
    outc = by_outcome.agg(F.map_from_entries(F.collect_list(
        F.struct("outcome", F.struct("opened", "total", "pct")))).alias("by_outcome"))
    days = daily.agg(F.array_sort(F.collect_list(F.struct(C("day").alias("date"), C("partners"), C("opens"))))
                     .alias("daily"))
    cols = summary.columns
    parts = [summary.select(*cols, F.lit(None).alias("by_outcome"), F.lit(None).alias("daily")),
             outc.select(*[F.lit(None).alias(c) for c in cols], "by_outcome", F.lit(None).alias("daily")),
             days.select(*[F.lit(None).alias(c) for c in cols], F.lit(None).alias("by_outcome"), "daily")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols + ["by_outcome", "daily"]])
