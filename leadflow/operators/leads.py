"""Lead lifecycle operators: scans, latest-state collapse, metric policies, open pipeline.

Shuffle shape: every metric is two hash aggregations, first on (connection, partner),
then on partner. Both have map-side partial aggregation, so a partner that owns a third
of all attempts is spread over many tasks in stage 1 and arrives in stage 2 as one
partial row per task — no task ever holds a hot partner's raw rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadflow.functions.arith import at_gate, idiv, pct_half_up
from leadflow.functions.joins import with_flag
from leadflow.functions.leads import EXCLUDED_BUCKETS, INSTALL_OUTCOMES, ONSITE_OUTCOMES, flag, is_installed, lead_bucket
from leadflow.functions.timecols import date_lit, in_local_range, local_date, ts_lit
from leadflow.plans.params import DEFAULT, Params


# ---------------------------------------------------------------- sources
def visible(df: DataFrame, as_of: dt.datetime, col: str = "updated_at") -> DataFrame:
    """Rows already written at ``as_of`` (the snapshot instant)."""
    return df.where(F.col(col) < ts_lit(as_of))


def active_attempts(df: DataFrame, as_of: dt.datetime, days: int | None = 120) -> DataFrame:
    """Live CDC rows with a partner, visible at ``as_of``; optionally a rolling window of ``days``."""
    out = visible(df.where(F.col("active") & F.col("partner_id").isNotNull()), as_of)
    if days is not None:
        out = out.where(F.col("updated_at") >= ts_lit(as_of.date() - dt.timedelta(days=days)))
    return out


def ledger_month(df: DataFrame, start: dt.date, end: dt.date, offset_minutes: int = 330) -> DataFrame:
    """Ledger rows whose local terminal date is in [start, end) (bound folded onto the raw column)."""
    return df.where(F.col("partner_id").isNotNull() & in_local_range(F.col("terminal_at"), start, end, offset_minutes))


# ------------------------------------------------------------- collapse (A1, A2)
def collapse_attempts(df: DataFrame, offset_minutes: int = 330) -> DataFrame:
    """One row per (connection, partner): value-at-latest fields and sticky max flags.

    All latest fields come from ONE max_by over a struct ordered by (updated_at, attempt_id),
    so ties on updated_at never mix fields of different attempts, and NULL values of the
    latest attempt are kept (own_slot_latest depends on that).
    """
    latest = F.max_by(
        F.struct(
            F.col("current_state").alias("last_state"),
            F.col("reason_code").alias("rc"),
            F.col("failure_reason").alias("fr"),
            F.col("failure_subreason").alias("fsc"),
            F.col("attempt_id").alias("rep_attempt_id"),
            F.col("created_at").alias("offered"),
            F.col("confirmed_slot_at").alias("latest_slot_at"),
        ),
        F.struct("updated_at", "attempt_id"),
    )
    g = df.groupBy("connection_id", "partner_id").agg(
        latest.alias("l"),
        F.max(flag(is_installed(True))).alias("has_installed"),
        F.max(flag(F.col("confirmed_slot_at").isNotNull())).alias("reached_slot"),
        F.max(flag(F.col("executor_id").isNotNull())).alias("tech_assigned"),
        F.max("updated_at").alias("last_update"),
    )
    return g.select(
        "connection_id", "partner_id",
        "l.last_state", "l.rc", "l.fr", "l.fsc", "l.rep_attempt_id", "l.offered",
        "has_installed", "reached_slot", "tech_assigned",
        flag(F.col("l.latest_slot_at").isNotNull()).alias("own_slot_latest"),
        local_date(F.col("last_update"), offset_minutes).alias("last_date"),
    )


def with_bucket(collapsed: DataFrame, variant: str = "full") -> DataFrame:
    return collapsed.withColumn("bucket", lead_bucket(variant))


def in_month(start: dt.date, end: dt.date | None, col: str = "last_date") -> Column:
    c = F.col(col) >= date_lit(start)
    return c if end is None else c & (F.col(col) < date_lit(end))


# ----------------------------------------------------------------- v3 metric (A3)
def month_history(attempts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Every visible lead, collapsed over its whole history: the sticky flags need all of its rows.

    Aggregated first: flags and instants combine map-side, so one exchange carries a partial row a lead and task, never
    a raw attempt. The month is chosen afterwards, by the lead's last local date.
    """
    return collapse_attempts(active_attempts(attempts, p.as_of, days=None), p.offset_minutes)


def daily_leads(leads: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Leads closed in the month by (partner, local day): ``i_d`` installed, ``d_d`` with a technician.

    A hot partner is a row a day from here on, so joins on the partner see no raw leads.
    """
    return leads.where(in_month(p.month_start, p.month_end)).groupBy("partner_id", "last_date").agg(
        F.count_if(F.col("has_installed") == 1).alias("i_d"), F.count_if(F.col("tech_assigned") == 1).alias("d_d"))


def metric_tech(attempts: DataFrame, p: Params = DEFAULT, impacted: DataFrame | None = None,
                leads: DataFrame | None = None, since_enrolment: DataFrame | None = None) -> DataFrame:
    """installs and tech-assigned leads per partner whose lead closed in the month (local date).

    Full history (no rolling window): the month is decided by the lead's LAST update, so every row of a lead is needed.
    An impacted connection leaves the denominator unless it installed. ``leads`` may pass an already collapsed frame;
    ``since_enrolment`` (partner_id, joined) keeps only leads closed on or after the partner's enrolment date.
    """
    if leads is None:
        leads = month_history(attempts, p)
    if impacted is not None:
        leads = drop_impacted(leads, impacted)
    closed = in_month(p.month_start, p.month_end)
    wins, counts = closed & (F.col("has_installed") == 1), closed & (F.col("tech_assigned") == 1)
    if since_enrolment is None:
        return leads.groupBy("partner_id").agg(F.count_if(wins).alias("installs"), F.count_if(counts).alias("denom"))
    # by day before the join with the dates: a hot partner meets it as a row a day
    day = F.when(closed, F.col("last_date"))  # one NULL day for all other months
    daily = leads.groupBy("partner_id", day.alias("day")).agg(F.count_if(wins).alias("i_d"), F.count_if(counts).alias("d_d"))
    dates = since_enrolment.groupBy("partner_id").agg(F.min("joined").alias("_joined"))
    early = F.coalesce(F.col("day") < F.col("_joined"), F.lit(False))
    kept = [F.when(early, 0).otherwise(F.col(c)) for c in ("i_d", "d_d")]
    return daily.join(dates, "partner_id", "left").groupBy("partner_id").agg(
        F.sum(kept[0]).cast("bigint").alias("installs"), F.sum(kept[1]).cast("bigint").alias("denom"))


def lead_views(attempts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One row a lead that holds both views: sticky flags over the whole history, and the latest state and flags of the
    rolling window (conditional aggregates)."""
    recent = F.col("updated_at") >= ts_lit(p.as_of.date() - dt.timedelta(days=p.window_days))
    order = F.when(recent, F.struct("updated_at", "attempt_id"))
    state = F.when(recent, F.struct(
        F.col("current_state").alias("last_state"), F.col("reason_code").alias("rc"), F.col("failure_reason").alias("fr"),
        F.col("failure_subreason").alias("fsc"), F.col("confirmed_slot_at").isNotNull().alias("own")))
    g = active_attempts(attempts, p.as_of, days=None).groupBy("connection_id", "partner_id").agg(
        F.max_by(state, order).alias("l"),
        F.max(flag(recent)).alias("in_window"),
        F.max(flag(recent & is_installed(True))).alias("has_installed"),
        F.max(flag(recent & F.col("confirmed_slot_at").isNotNull())).alias("reached_slot"),
        F.max(flag(is_installed(True))).alias("ever_installed"),
        F.max(flag(F.col("executor_id").isNotNull())).alias("ever_tech"),
        F.max("updated_at").alias("last_update"))
    return g.select("connection_id", "partner_id", "l.last_state", "l.rc", "l.fr", "l.fsc", "l.own", "in_window",
                    "has_installed", "reached_slot", "ever_installed", "ever_tech",
                    local_date(F.col("last_update"), p.offset_minutes).alias("last_date"))


def partner_month(attempts: DataFrame, p: Params = DEFAULT, impacted: DataFrame | None = None) -> DataFrame:
    """The month metric (A3), the open pipeline (A7) and the leads since the last crossing (W5), from one scan.

    One aggregation by lead (``lead_views``); leads then become (partner, day) rows, partners one row.
    """
    return partner_month_of(lead_views(attempts, p), p, impacted)


def partner_month_of(leads: DataFrame, p: Params = DEFAULT, impacted: DataFrame | None = None) -> DataFrame:
    """``partner_month`` from the rows of ``lead_views``, computed or merged from stored partials."""
    excused = F.lit(False)
    if impacted is not None:
        leads = with_flag(leads, impacted, "connection_id", "_impacted")
        excused = F.col("_impacted") & (F.col("ever_installed") == 0)
    is_open = (F.col("in_window") == 1) & (lead_bucket("full") == "open")
    day = F.when(in_month(p.month_start, p.month_end), F.col("last_date"))
    daily = leads.groupBy("partner_id", day.alias("day")).agg(
        F.count_if(day.isNotNull() & (F.col("ever_installed") == 1)).alias("i_d"),
        F.count_if(day.isNotNull() & (F.col("ever_tech") == 1) & ~excused).alias("d_d"),
        F.count_if(is_open).alias("pending"), F.count_if(is_open & F.col("own")).alias("committed"))
    crossed = _crossing(daily, p)
    return crossed.groupBy("partner_id").agg(
        *[F.sum(c).cast("bigint").alias(n) for c, n in (("i_d", "installs"), ("d_d", "denom"), ("pending", "pending"),
                                                       ("committed", "committed"))],
        F.coalesce(_since_crossing(), F.lit(0)).cast("bigint").alias("new_leads"))


def _crossing(daily: DataFrame, p: Params) -> DataFrame:
    """Running sums ``ci`` / ``cd`` by day and whether the partner stands at the gate at the day's end.

    At most one row a day of the month and partner reaches the window, however many leads a hot partner has.
    """
    w = Window.partitionBy("partner_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = daily.withColumn("ci", F.sum("i_d").over(w)).withColumn("cd", F.sum("d_d").over(w))
    return run.withColumn("ok", at_gate(F.col("ci"), F.col("cd"), p.gate_num, p.gate_den))


def _since_crossing() -> Column:
    """The month's last running denominator less that at the last day at the gate (0 if there was none)."""
    real = F.col("day").isNotNull()
    last = F.max(F.when(real, F.struct("day", "cd"))).getField("cd")
    crossed = F.max(F.when(real & F.col("ok"), F.struct("day", "cd"))).getField("cd")
    return last - F.coalesce(crossed, last)


def new_leads_since_crossing(daily: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Leads added since the partner last stood at or above the gate, from ``daily_leads`` rows."""
    run = _crossing(daily.withColumnRenamed("last_date", "day"), p)
    return run.groupBy("partner_id").agg(_since_crossing().cast("bigint").alias("new_leads"))


def drop_impacted(leads: DataFrame, impacted: DataFrame) -> DataFrame:
    """an impacted connection leaves the lead set unless it installed.

    Dropping the non-installed impacted leads removes them from every denominator and
    cannot change an install count. The impacted list is an existence flag, never a
    literal IN list, so it may hold any number of connections.
    """
    flagged = with_flag(leads, impacted, "connection_id", "_impacted")
    return flagged.where(~(F.col("_impacted") & (F.col("has_installed") == 0))).drop("_impacted")


# ------------------------------------------------------------ ledger
def latest_per(df: DataFrame, keys: list[str], order: list[str], value_cols: list[str]) -> DataFrame:
    """Latest row per key by ``order`` (descending, NULLs last), as an aggregation.

    max_by has partial aggregation, so a hot key is reduced map-side; a row_number window
    would put all of that key's rows into one task. NULL order values lose because the
    struct leads with an is-not-null flag.
    """
    ordering = F.struct(*[F.col(c).isNotNull() for c in order[:1]], *[F.col(c) for c in order])
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in value_cols]), ordering).alias("_l"))
            .select(*keys, *[F.col(f"_l.{c}").alias(c) for c in value_cols]))


def dedupe_ledger(ledger: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Month filter first, then the latest terminal row per connection across partners."""
    month = ledger_month(ledger, p.month_start, p.month_end, p.offset_minutes)
    return latest_per(month, ["connection_id"], ["terminal_at", "ledger_id"],
                      ["partner_id", "terminal_outcome", "terminal_at", "ledger_id"])


def needed_growing(num: Column, den: Column) -> Column:
    """Installs still needed when each new install also adds a lead: ceil((3d - 5i)/2) >= 0 (gate 0.60)."""
    return F.when(den > 0, F.greatest(F.lit(0), idiv(3 * den - 5 * num + 1, F.lit(2)))).otherwise(F.lit(0)).cast("bigint")


def metric_ontime(ledger: DataFrame, p: Params = DEFAULT, impacted: DataFrame | None = None) -> DataFrame:
    led = dedupe_ledger(ledger, p)
    o = F.col("terminal_outcome")
    if impacted is not None:
        led = with_flag(led, impacted, "connection_id", "is_impacted")
        excused = F.col("is_impacted") & o.isin("REPORTED_FAILED", "CANCELLED_ONSITE")
    else:
        excused = F.lit(False)
    agg = led.groupBy("partner_id").agg(
        F.count_if(o == "ON_TIME_ACTIVE").alias("ontime"),
        F.count_if(o == "LATE_ACTIVE").alias("late"),
        F.count_if(o.isin(*INSTALL_OUTCOMES)).alias("installs"),
        F.count_if(o.isin(*ONSITE_OUTCOMES) & ~excused).alias("denom"),
    )
    return agg.select("*", pct_half_up(F.col("ontime"), F.col("denom")).alias("pct"),
                      needed_growing(F.col("ontime"), F.col("denom")).alias("needed"))


# --------------------------------------------------------- slot policy
def bucketed_window(attempts: DataFrame, p: Params = DEFAULT, variant: str = "full") -> DataFrame:
    """Collapsed + bucketed leads over the rolling window (the open-lead / slot view)."""
    return with_bucket(collapse_attempts(active_attempts(attempts, p.as_of, p.window_days), p.offset_minutes), variant)


def metric_slot(bucketed: DataFrame, start: dt.date, end: dt.date | None) -> DataFrame:
    """Pre-S4 slot policy: installs = installed & reached_slot; denom = reached_slot & resolved."""
    m = in_month(start, end)
    b = F.col("bucket")
    slot = F.col("reached_slot") == 1
    return bucketed.groupBy("partner_id").agg(
        F.count_if(m & (b == "installed") & slot).alias("installs"),
        F.count_if(m & slot & ~b.isin(*EXCLUDED_BUCKETS)).alias("denom"),
        F.count_if(b == "open").alias("pending"),
    )


def open_pipeline(bucketed: DataFrame) -> DataFrame:
    b = F.col("bucket")
    return bucketed.groupBy("partner_id").agg(
        F.count_if(b == "open").alias("pending"),
        F.count_if((b == "open") & (F.col("own_slot_latest") == 1)).alias("committed"),
    )


# ------------------------------------------------------- hybrid gate
def hybrid_gate(bucketed: DataFrame, transitions: DataFrame, cutoff: dt.date, offset_minutes: int = 330) -> DataFrame:
    """gate_ok = slot before/at the cutoff offer date, technician assignment after.

    The technician flag comes from the transition log on the representative attempt:
    an existence join (distinct attempt ids), so a chatty log cannot fan rows out.
    """
    tech = transitions.where(F.col("to_state") == "TECHNICIAN_ASSIGNED").select(F.col("attempt_id").alias("rep_attempt_id"))
    g = with_flag(bucketed, tech, "rep_attempt_id", "log_tech")
    gate = F.when(local_date(F.col("offered"), offset_minutes) <= date_lit(cutoff), F.col("reached_slot")) \
        .otherwise(flag(F.col("log_tech")))
    return g.withColumn("gate_ok", gate.cast("int")).drop("log_tech")


def metric_s4(gated: DataFrame, start: dt.date, end: dt.date | None) -> DataFrame:
    m = in_month(start, end)
    b = F.col("bucket")
    ok = F.col("gate_ok") == 1
    return gated.groupBy("partner_id").agg(
        F.count_if(m & (b == "installed") & ok).alias("installs"),
        F.count_if(m & ok & ~b.isin(*EXCLUDED_BUCKETS)).alias("denom"),
    )
