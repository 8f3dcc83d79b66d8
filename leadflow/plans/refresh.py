"""The three refresh jobs as Spark jobs: month snapshot, dashboard documents, engagement.

    python -m leadflow.plans.refresh --data /lake/landed --out /shared/leadflow \
        --month 1998-07 [--frozen 1998-06] [--what snapshot,dashboard,engagement] [--source landed|testdata]
        [--partials /shared/leadflow/partials [--days 1998-07-14,1998-07-15]]

``tables`` is any object with the logical tables as attributes (attempts, ledger, users,
events, profiles, rosters, overlay, transitions): ``LandedTables``, or ``TestData``, which maps the test Parquet.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.functions.timecols import ts_lit
from leadflow.operators import cohorts as CO
from leadflow.operators import engagement as E
from leadflow.operators import leads as L
from leadflow.operators import quality as Q
from leadflow.operators import snapshot as S
from leadflow.operators.partials import LeadPartials, touched_days
from leadflow.plans.params import DEFAULT, Params
from leadflow.session import cluster_session
from leadflow.sources.landed import LandedTables
from leadflow.sources.snapshots import FrozenMonthError, frozen_months, path_exists, write_month
from leadflow.sources.testdata import TestData

C = F.col


def month_params(ym: str, base: Params = DEFAULT, as_of: dt.datetime | None = None) -> Params:
    y, m = (int(x) for x in ym.split("-"))
    start = dt.date(y, m, 1)
    end = dt.date(y + (m == 12), m % 12 + 1, 1)
    prev = dt.date(y - (m == 1), (m - 2) % 12 + 1, 1)
    return replace(base, month_start=start, month_end=end, prev_start=prev,
                   # the instant at which the month ends locally
                   as_of=as_of or dt.datetime.combine(end, dt.time()) - dt.timedelta(minutes=base.offset_minutes))


def refresh_snapshot(tables, p: Params, out: str, frozen=(), partials: LeadPartials | None = None, days=None) -> DataFrame:
    """Build the month record and publish only that month, if it differs from the published one (frozen months refused).

    With ``partials`` the attempts of the touched ``days`` alone are read (``touched_since``), and the record is made from the store.
    """
    path = f"{out.rstrip('/')}/snapshot"
    refuse_frozen(p.month_ym, frozen, path, tables.rosters.sparkSession)
    enrol = tables.overlay.where(C("joined").isNotNull())
    if partials is None:
        record = S.month_snapshot(tables.attempts, tables.ledger, tables.users, enrol, p)
    else:
        partials.refresh(tables.attempts, p.as_of, touched_since(tables.attempts, partials, p) if days is None else days)
        record = S.month_snapshot_of(partials, tables.ledger, tables.users, enrol, p)
    snap = S.to_snapshot(record)
    write_month(snap, path, p.month_ym, frozen, only_if_changed=True)
    return snap


def refuse_frozen(ym: str, frozen, path: str, spark) -> None:
    """Stop before any work where the month is frozen, by the caller or in the sink."""
    if ym in {*frozen, *frozen_months(spark, path)}:
        raise FrozenMonthError(f"month {ym} is frozen (disbursed); refusing to rebuild it")


def touched_since(attempts: DataFrame, partials: LeadPartials, p: Params) -> list[dt.date] | None:
    """The days of attempts written since the store's last refresh; all days (None) for a new store.

    Where attempts are updated in place, the days that they have left must be given as well, from the change feed.
    """
    seen = partials.as_of
    if seen is None:
        return None
    new = attempts.where(C("updated_at") >= ts_lit(seen - dt.timedelta(days=1)))
    return touched_days(L.active_attempts(new, p.as_of, days=None))


def dashboard_documents(tables, p: Params) -> dict[str, DataFrame]:
    """The four dashboard queries sharing one lead collapse definition, plus the full grid."""
    roster = tables.rosters.where(C("category") == "enrolled").select("partner_id")
    legacy = L.bucketed_window(tables.attempts, p, "legacy")
    periods = [("previous", p.prev_start, p.month_start), ("current", p.month_start, None)]
    grid = tables.rosters.sparkSession.createDataFrame(
        [(a, c) for a, _, _ in periods for c in ("enrolled", "eligible", "rest")], "period string, category string")
    docs = {
        "csp_funnel": E.engagement_funnel(tables.events, tables.profiles, tables.attempts, roster, p.events_since, p.funnel_since),
        "segments": E.segment_funnel(tables.events, tables.profiles, tables.attempts, roster, p.events_since, p.funnel_since),
        "efficiency": CO.dashboard_doc(CO.efficiency(legacy, tables.rosters, periods), grid),
        "enrolled_roster": CO.roster_breakdown(legacy, roster, p.month_start),
    }
    docs["document"] = CO.dashboard_document(docs["csp_funnel"], docs["segments"], docs["efficiency"],
                                             docs["enrolled_roster"])
    return docs


def engagement_documents(tables, p: Params, outcome_groups: DataFrame | None = None, slack: int | None = None) -> dict[str, DataFrame]:
    """Banner engagement of the enrolled cohort, wholly in Spark.

    With ``slack``, the run stops when more than so many cohort members have no profile (Q4).
    """
    cohort = tables.rosters.where(C("category") == "enrolled").select("partner_id")
    if slack is not None:
        Q.require_coverage(Q.coverage_gate(cohort, E.profile_bridge(tables.profiles).select("partner_id"), "partner_id", slack))
    opens = E.daily_opens(tables.events, E.profile_bridge(tables.profiles, cohort), p.engagement_start)
    docs = {"daily": E.daily_engagement(opens), "summary": E.engagement_summary(opens, cohort)}
    if outcome_groups is not None:
        docs["by_outcome"] = E.engagement_by_outcome(opens, outcome_groups)
        docs["document"] = E.engagement_document(docs["summary"], docs["by_outcome"], docs["daily"])
    return docs


def write_documents(docs: dict[str, DataFrame], out: str, ym: str, frozen=()) -> None:
    """The documents of a month as JSON; a frozen month's are refused before any is written."""
    if ym in set(frozen):
        raise FrozenMonthError(f"month {ym} is frozen (disbursed); refusing to rewrite its documents")
    for name, df in docs.items():
        df.write.mode("overwrite").json(f"{out.rstrip('/')}/{name}/month={ym}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--data", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--month", required=True, help="yyyy-MM")
    ap.add_argument("--frozen", default="", help="comma-separated months that may not be rebuilt")
    ap.add_argument("--what", default="snapshot,dashboard,engagement")
    ap.add_argument("--source", choices=("landed", "testdata"), default="landed")
    ap.add_argument("--slack", type=int, help="cohort members that may lack a profile before the engagement run stops")
    ap.add_argument("--partials", help="folder of stored lead partials: made by the first run, refreshed by the touched days after it")
    ap.add_argument("--days", help="touched days, comma-separated; without it the days written to since the last refresh")
    ap.add_argument("--buckets", type=int, default=256, help="buckets of a new store of partials")
    a = ap.parse_args(argv)

    spark = cluster_session()
    t = LandedTables(spark, a.data) if a.source == "landed" else TestData(spark, a.data)
    p = month_params(a.month)
    what = set(a.what.split(","))
    frozen = [m for m in a.frozen.split(",") if m]
    # the sink remembers the months that were frozen by earlier runs
    closed = {*frozen, *frozen_months(spark, f"{a.out.rstrip('/')}/snapshot")}
    if "snapshot" in what:
        store, days = None, None
        if a.partials:
            window = p.as_of.date() - dt.timedelta(days=p.window_days)
            made = path_exists(spark, f"{a.partials.rstrip('/')}/settings")
            store = LeadPartials.open(spark, "lead_partials", a.partials) if made else LeadPartials.create(
                spark, "lead_partials", a.partials, a.buckets, window.replace(day=1))
            days = [dt.date.fromisoformat(d) for d in a.days.split(",")] if a.days else None
        refresh_snapshot(t, p, a.out, frozen, store, days)
    if "dashboard" in what:
        write_documents(dashboard_documents(t, p), f"{a.out}/dashboard", a.month, closed)
    if "engagement" in what:
        # outcome groups = how the previous month settled (guarantee applied vs piece rate)
        from leadflow.operators.payout import outcome_group, settle
        from leadflow.plans.q_payout import settle_input
        prev = month_params(p.prev_start.strftime("%Y-%m"))
        groups = outcome_group(settle(settle_input(t, prev), prev))
        write_documents(engagement_documents(t, p, groups, a.slack), f"{a.out}/engagement", a.month, closed)


if __name__ == "__main__":
    main()
