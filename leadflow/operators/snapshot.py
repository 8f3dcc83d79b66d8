"""Month snapshot: open tickets top-k, owner pick, three-source merge, nested record, freeze, change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadflow.functions.leads import is_open_ticket, ticket_no, ticket_rank
from leadflow.operators import leads as L
from leadflow.plans.params import DEFAULT, Params

METRIC_COLS = ("installs", "denom", "pending", "committed", "ontime_m1", "late_m1", "leads_m1")
TICKET_COLS = ("t1_no", "t1_area", "t1_cid", "t2_no", "t2_area", "t2_cid")

# fixed values: owner preference by role (others are not eligible)
ROLE_RANK = {"OWNER": 3, "MANAGER_PLUS": 2, "MANAGER": 1}


def top_tickets(attempts: DataFrame, k: int = 2) -> DataFrame:
    """Top-k open tickets per partner: furthest state first, then oldest update.

    row_number <= k lets Catalyst insert a partial WindowGroupLimit before the shuffle,
    so each map task forwards at most k rows per partner — a hot partner costs k rows
    per task, not all of its tickets.
    """
    return foremost(attempts.where(is_open_ticket())
                    .select("partner_id", "attempt_id", "zone_id", "updated_at", ticket_rank().alias("rnk")), k)


def foremost(tickets: DataFrame, k: int, *more: str) -> DataFrame:
    """The k foremost of ranked tickets for each partner (and ``more``); those of parts of the tickets combine to those of all."""
    w = Window.partitionBy("partner_id", *more).orderBy(F.col("rnk").desc(), F.col("updated_at").asc(), F.col("attempt_id").asc())
    return tickets.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def pivot_tickets(ranked: DataFrame) -> DataFrame:
    """rn = 1, 2 rows -> t1_*/t2_* columns (no = '#' + last four of the id)."""
    cols = []
    for i in (1, 2):
        hit = F.col("rn") == i
        cols += [F.max(F.when(hit, ticket_no(F.col("attempt_id")))).alias(f"t{i}_no"),
                 F.max(F.when(hit, F.col("zone_id"))).alias(f"t{i}_area"),
                 F.max(F.when(hit, F.col("attempt_id"))).alias(f"t{i}_cid")]
    return ranked.groupBy("partner_id").agg(*cols)


def owner_of(users: DataFrame) -> DataFrame:
    """One representative user id (string) per partner: highest role rank, then highest id."""
    rank = None
    for role, r in ROLE_RANK.items():
        rank = F.when(F.col("role") == role, r) if rank is None else rank.when(F.col("role") == role, r)
    uid = F.col("user_id").cast("string")
    return (users.where(F.col("active") & (F.col("status") == "ACTIVE") & F.col("role").isin(*ROLE_RANK)
                        & F.col("user_id").isNotNull())
            .groupBy("partner_id")
            .agg(F.max_by(uid, F.struct(rank, uid)).alias("user_id")))


def merge_sources(mg: DataFrame, open_: DataFrame, led: DataFrame) -> DataFrame:
    """metric ⟗ open pipeline ⟗ ledger on partner: a partner in any one source survives; gaps = 0."""
    a = mg.select("partner_id", "installs", "denom")
    b = open_.select("partner_id", "pending", "committed")
    c = led.select("partner_id", F.col("ontime").alias("ontime_m1"), F.col("late").alias("late_m1"),
                   F.col("denom").alias("leads_m1"))
    out = a.join(b, "partner_id", "full_outer").join(c, "partner_id", "full_outer")
    return out.select("partner_id", *[F.coalesce(F.col(x), F.lit(0)).cast("bigint").alias(x) for x in METRIC_COLS])


def month_snapshot(attempts: DataFrame, ledger: DataFrame, users: DataFrame, enrol: DataFrame,
                   p: Params = DEFAULT, impacted: DataFrame | None = None) -> DataFrame:
    """The per-partner month record: v3 metric, open pipeline, on-time ledger, tickets, owner (and ``new_leads``).

    Kept: any activity, or enrolled (a 0/0/0 enrolled partner must still be found). Attempts are scanned twice: once for
    metric, pipeline and crossing together, once for the top tickets, of which a task forwards two rows a partner.
    """
    tk = top_tickets(L.active_attempts(attempts, p.as_of, None))
    return assemble(L.partner_month(attempts, p, impacted), tk, ledger, users, enrol, p)


def month_snapshot_of(partials, ledger: DataFrame, users: DataFrame, enrol: DataFrame, p: Params = DEFAULT,
                      impacted: DataFrame | None = None) -> DataFrame:
    """``month_snapshot`` from stored ``LeadPartials``: no attempt is read, and leads merge without an exchange."""
    return assemble(L.partner_month_of(partials.lead_views(p), p, impacted), partials.top_tickets(p), ledger, users, enrol, p)


def assemble(month: DataFrame, tickets: DataFrame, ledger: DataFrame, users: DataFrame, enrol: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The month record from the partners' month (``partner_month``) and their foremost tickets."""
    led = L.metric_ontime(ledger, p).select("partner_id", F.col("ontime").alias("ontime_m1"),
                                            F.col("late").alias("late_m1"), F.col("denom").alias("leads_m1"))
    agg = month.join(led, "partner_id", "full_outer")
    agg = agg.select("partner_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in (*METRIC_COLS, "new_leads")])
    tk = pivot_tickets(tickets)
    own = owner_of(users)
    en = enrol.select("partner_id").distinct().withColumn("_enrolled", F.lit(True))
    out = (agg.join(tk, "partner_id", "left").join(own, "partner_id", "left")
           .join(en, "partner_id", "left"))
    keep = ((F.col("installs") + F.col("denom") + F.col("pending") + F.col("leads_m1")) > 0) | F.col("_enrolled").isNotNull()
    return out.where(keep).select("partner_id", "user_id", *METRIC_COLS, *TICKET_COLS, "new_leads")


def rank_output(df: DataFrame) -> DataFrame:
    """Display order: installs desc, denom desc (partner id breaks ties so the order is total)."""
    return df.orderBy(F.col("installs").desc(), F.col("denom").desc(), F.col("partner_id").asc())


def to_snapshot(df: DataFrame) -> DataFrame:
    """Flat rows -> nested record with a ``tickets`` array of 0-2 structs (absent tickets dropped).

    Texts that are absent are '' in the record, so that ``to_json`` keeps their keys.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    t = F.array(*[F.struct(F.col(f"t{i}_no").alias("no"), text(f"t{i}_area").alias("area"),
                           text(f"t{i}_cid").alias("cid")) for i in (1, 2)])
    return df.select("partner_id", text("user_id").alias("user_id"), *METRIC_COLS,
                     F.filter(t, lambda x: F.coalesce(x["no"], F.lit("")) != "").alias("tickets"))


def lookup(snap: DataFrame, ids: DataFrame, cols: Sequence[str] = ("installs", "denom", "pending", "committed")) -> DataFrame:
    """Point lookup: every requested id gets a row; an unknown id gets zeros and found = 0."""
    s = snap.select("partner_id", *cols).withColumn("_hit", F.lit(1))
    out = ids.select("partner_id").distinct().join(s, "partner_id", "left")
    return out.select("partner_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols],
                      F.coalesce(F.col("_hit"), F.lit(0)).alias("found"))


def null_safe_diff(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keys whose rows differ between two versions: kind = added / removed / changed."""
    o = old.select(key, *[F.col(c).alias(f"o_{c}") for c in cols]).withColumn("_o", F.lit(True))
    n = new.select(key, *[F.col(c).alias(f"n_{c}") for c in cols]).withColumn("_n", F.lit(True))
    j = o.join(n, key, "full_outer")
    same: Column = F.lit(True)
    for c in cols:
        same = same & F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    kind = (F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed")
            .when(~same, "changed"))
    return j.select(key, kind.alias("kind")).where(F.col("kind").isNotNull())


def keep_active_or_enrolled(agg: DataFrame, enrol: DataFrame) -> DataFrame:
    """F8: keep a partner row with any activity, or when enrolled (kept = active / enrolled)."""
    en = enrol.select("partner_id").distinct().withColumn("_e", F.lit(True))
    j = agg.join(en, "partner_id", "left")
    act = (F.col("installs") + F.col("denom") + F.col("pending") + F.col("leads_m1")) > 0
    return (j.where(act | F.col("_e").isNotNull())
            .withColumn("kept", F.when(act, "active").otherwise("enrolled")).drop("_e"))


def snapshot_changed(old: DataFrame, new: DataFrame, key: str = "partner_id",
                     cols: Sequence[str] = ("user_id",) + METRIC_COLS + TICKET_COLS) -> DataFrame:
    """K3: publish only if data differ — the keys whose record was added, removed or changed."""
    return null_safe_diff(old, new, key, cols)
