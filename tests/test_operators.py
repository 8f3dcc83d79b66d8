"""Operator semantics on tiny hand-made frames (sinks, guards, NULL rules, nesting)."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from leadflow.functions.joins import with_flag
from leadflow.operators import quality as Q
from leadflow.operators import snapshot as S
from leadflow.operators.cohorts import not_in_roster, quality_bonus, with_overlay
from leadflow.session import checkpoint_dir
from leadflow.sources import snapshots as SNAP
from leadflow.sources.inputs import cohort_ids, overlay_rows


def test_frozen_month_is_refused_and_untouched(spark):
    path = f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"
    a = spark.createDataFrame([(1, 5)], "partner_id long, installs long")
    b = spark.createDataFrame([(1, 9)], "partner_id long, installs long")
    SNAP.write_month(a, path, "1998-06")
    SNAP.write_month(b, path, "1998-07", frozen=["1998-06"])
    with pytest.raises(SNAP.FrozenMonthError):
        SNAP.write_month(b, path, "1998-06", frozen=["1998-06"])
    got = {(r["month"], r["installs"]) for r in SNAP.read_months(spark, path).collect()}
    assert got == {("1998-06", 5), ("1998-07", 9)}
    # unknown month -> default
    assert SNAP.read_month(spark, path, "1999-01", default="1998-06").first()["installs"] == 5
    assert SNAP.read_month(spark, path, "1998-07", default="1998-06").first()["installs"] == 9


def test_not_in_roster_drops_null_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "partner_id long")
    roster = spark.createDataFrame([(1,)], "partner_id long")
    assert sorted(r[0] for r in not_in_roster(df, roster).collect()) == [2]


def test_with_flag_never_fans_out(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    keys = spark.createDataFrame([(1,), (1,), (1,), (None,)], "k long")
    got = sorted((r["k"] if r["k"] is not None else -1, r["f"]) for r in with_flag(df, keys, "k", "f").collect())
    assert got == [(-1, False), (1, True), (2, False)]


def test_nested_snapshot_drops_absent_tickets(spark):
    rows = [(1, "u1", 1, 2, 0, 0, 0, 0, 0, "#0001", None, "a-0001", None, None, None),
            (2, None, 0, 0, 0, 0, 0, 0, 0, None, None, None, None, None, None)]
    schema = ("partner_id long, user_id string, installs long, denom long, pending long, committed long, "
              "ontime_m1 long, late_m1 long, leads_m1 long, t1_no string, t1_area string, t1_cid string, "
              "t2_no string, t2_area string, t2_cid string")
    rec = {r["partner_id"]: r for r in S.to_snapshot(spark.createDataFrame(rows, schema)).collect()}
    assert [tuple(t) for t in rec[1]["tickets"]] == [("#0001", "", "a-0001")] and rec[2]["tickets"] == []
    assert rec[2]["user_id"] == ""  # absent texts are '', so their keys stay in JSON


def test_point_lookup_unknown_id_is_zero(spark):
    snap = spark.createDataFrame([(1, 3, 4, 1, 0)], "partner_id long, installs long, denom long, pending long, committed long")
    ids = spark.createDataFrame([(1,), (9,)], "partner_id long")
    got = {r["partner_id"]: (r["installs"], r["found"]) for r in S.lookup(snap, ids).collect()}
    assert got == {1: (3, 1), 9: (0, 0)}


def test_change_detect_kinds(spark):
    old = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "partner_id long, v long")
    new = spark.createDataFrame([(1, 1), (2, 5), (3, None), (4, 0)], "partner_id long, v long")
    got = {r["partner_id"]: r["kind"] for r in S.null_safe_diff(old, new, "partner_id", ["v"]).collect()}
    assert got == {2: "changed", 4: "added"}


def test_coverage_gate_raises(spark):
    cohort = spark.createDataFrame([(i,) for i in range(10)], "partner_id long")
    resolvable = spark.createDataFrame([(i,) for i in range(6)], "partner_id long")
    with pytest.raises(Q.CoverageError):
        Q.require_coverage(Q.coverage_gate(cohort, resolvable, "partner_id", slack=3))
    gate = Q.coverage_gate(cohort, resolvable, "partner_id", slack=4)
    Q.require_coverage(gate)
    assert tuple(gate.first()) == (10, 6, True) and Q.unresolved(cohort, resolvable, "partner_id").count() == 4


def test_overlay_wins_on_clash(spark):
    rec = spark.createDataFrame([(1, dt.date(1998, 7, 3)), (2, dt.date(1998, 7, 9))], "partner_id long, joined date")
    ov = spark.createDataFrame([(1, dt.date(1998, 7, 20), 750)], "partner_id long, joined date, rate_after int")
    got = {r["partner_id"]: (r["joined"], r["rate_after"]) for r in with_overlay(rec, ov).collect()}
    assert got == {1: (dt.date(1998, 7, 20), 750), 2: (dt.date(1998, 7, 9), None)}


def test_json_inputs_explode(spark):
    docs = spark.createDataFrame([('{"7": {"joined": "1998-07-02", "rate_after": 750, "inst_before": 40, "inst_after": 20}}',)], "json string")
    r = overlay_rows(docs).first()
    assert (r["partner_key"], r["joined"], r["rate_after"], r["inst_before"], r["inst_after"]) == ("7", dt.date(1998, 7, 2), 750, 40, 20)
    ids = cohort_ids(spark.createDataFrame([('["a", "b"]',)], "json string"))
    assert sorted(x[0] for x in ids.collect()) == ["a", "b"]


def test_quality_bonus_month_then_default(spark):
    month = spark.createDataFrame([(1, " Very Good ", None), (2, "bogus", 5)], "partner_id long, tier string, amount long")
    fallback = spark.createDataFrame([(2, "poor", None), (3, "ok", 700)], "partner_id long, tier string, amount long")
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "partner_id long")
    got = {r["partner_id"]: (r["tier"], r["amount"], r["ready"]) for r in quality_bonus(month, ids, fallback).collect()}
    assert got == {1: ("verygood", 2000, True), 2: (None, None, False), 3: ("basic", 700, True), 4: (None, None, False)}


def test_refresh_jobs_write_month_and_refuse_frozen(spark):
    from leadflow.plans.refresh import dashboard_documents, engagement_documents, month_params, refresh_snapshot, write_documents
    from leadflow.sources.testdata import tables
    from conftest import SMALL

    t = tables(spark, SMALL)
    out = f"{checkpoint_dir(spark)}/refresh-{uuid.uuid4().hex}"
    p = month_params("1998-07", as_of=dt.datetime(1998, 8, 15))
    assert (p.month_start, p.month_end, p.prev_start) == (dt.date(1998, 7, 1), dt.date(1998, 8, 1), dt.date(1998, 6, 1))
    refresh_snapshot(t, p, out)
    with pytest.raises(SNAP.FrozenMonthError):
        refresh_snapshot(t, p, out, frozen=["1998-07"])
    assert SNAP.read_month(spark, f"{out}/snapshot", "1998-07", "1998-07").count() > 0
    write_documents(dashboard_documents(t, p), f"{out}/dashboard", "1998-07")
    write_documents(engagement_documents(t, p), f"{out}/engagement", "1998-07")
    assert spark.read.json(f"{out}/dashboard/efficiency/month=1998-07").count() == 6


def test_push_tokens_sink_runs_inside_tasks(spark):
    import glob
    import json
    import os

    from leadflow.operators.tokens import profile_tokens, push_tokens
    out = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    os.makedirs(out)
    df = spark.createDataFrame([(i, i * 2, None) for i in range(50)], "user_id long, installs long, t1_no string")
    tok = profile_tokens(df, "user_id", ["installs", "t1_no"]).repartition(4)

    def send(rows, out=out):
        with open(f"{out}/{uuid.uuid4().hex}.jsonl", "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")

    push_tokens(tok, send, batch=30)
    lines = [json.loads(x) for p in glob.glob(f"{out}/*.jsonl") for x in open(p)]
    assert len(lines) == 100
    assert {x["value"] for x in lines if x["token"] == "banner_t1_no"} == {""}


def test_dashboard_document_is_one_nested_row(spark):
    from conftest import SMALL

    from leadflow.plans.refresh import dashboard_documents, month_params
    from leadflow.sources.testdata import tables
    docs = dashboard_documents(tables(spark, SMALL), month_params("1998-07", as_of=dt.datetime(1998, 8, 15)))
    rows = docs["document"].collect()
    assert len(rows) == 1
    d = rows[0]
    assert set(d["efficiency"]) == {"previous", "current"}
    assert set(d["efficiency"]["current"]) == {"enrolled", "eligible", "rest"}
    assert set(d["segments"]) <= {"A_clicked", "B_noclick", "C_outside"}
    assert d["enrolled_roster"]["enrolled_total"] > 0


def test_engagement_document_is_one_nested_row(spark):
    from conftest import SMALL

    from leadflow.plans.params import DEFAULT
    from leadflow.plans.refresh import engagement_documents
    from leadflow.sources.testdata import tables
    t = tables(spark, SMALL)
    groups = spark.createDataFrame([(r["partner_id"], "topup" if r["partner_id"] % 2 else "piece")
                                    for r in t.rosters.where(F.col("category") == "enrolled").collect()],
                                   "partner_id long, outcome string")
    docs = engagement_documents(t, DEFAULT, groups)
    d = docs["document"].collect()
    assert len(d) == 1
    days = [x["date"] for x in d[0]["daily"]]
    assert days == sorted(days) and len(days) == docs["daily"].count()
    assert set(d[0]["by_outcome"]) == {"topup", "piece"}
    assert d[0]["eligible"] == t.rosters.where(F.col("category") == "enrolled").count()


def test_quality_row_without_a_tier_is_not_ready(spark):
    """The month's row is taken as it is, also without a tier; other field names stand for the tier."""
    month = spark.createDataFrame([(1, None, 500), (3, " ", 5)], "partner_id long, tier string, amount long")
    usual = spark.createDataFrame([(1, None, "good", None), (2, "", "good", None), (3, "vg", None, None)], "partner_id long, tier string, quality string, amount long")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "partner_id long")
    got = {r["partner_id"]: (r["tier"], r["amount"], r["ready"]) for r in quality_bonus(month, ids, usual).collect()}
    assert got == {1: (None, None, False), 2: ("good", 1500, True), 3: (None, None, False)}


def test_profile_bridge_lower_cases_ids(spark):
    from leadflow.operators.engagement import profile_bridge
    profiles = spark.createDataFrame([("p1", "A0B1", False), ("p1", "a0b1", False), ("p2", "C2", True), ("p3", "zz", False)], "profile_id string, partner_id string, deleted boolean")
    roster = spark.createDataFrame([("a0B1",), ("c2",)], "partner_id string")
    got = profile_bridge(profiles, roster).select("profile_id", "partner_id")
    assert [tuple(r) for r in got.collect()] == [("p1", "a0b1")]


def test_dead_rows_of_users_and_events_do_not_count(spark):
    from leadflow.operators import engagement as E
    from leadflow.operators.cohorts import active_users, identities
    users = spark.createDataFrame([(1, 7, "OWNER", "ACTIVE", True), (2, 7, "OWNER", "ACTIVE", False), (3, 7, "MANAGER", "ACTIVE", None)],
                                  "user_id long, partner_id long, role string, status string, active boolean")
    assert [r["user_id"] for r in active_users(users).collect()] == [1]
    assert S.owner_of(users).first()["user_id"] == "1"
    assert identities(users.select("partner_id"), users).count() == 1
    day = dt.datetime(2024, 1, 6, 10)
    events = spark.createDataFrame([(1, 5, "banner_opened", day, False), (2, 5, "banner_opened", day, True)], "event_id long, profile_id long, event_name string, ts timestamp_ntz, deleted boolean")
    bridge = spark.createDataFrame([(5, 7)], "profile_id long, partner_id long")
    assert E.daily_opens(events, bridge, dt.datetime(2024, 1, 1)).first()["n"] == 1


def test_lapse_breakdown_branches(spark):
    """Only partners with nothing resolved and nothing open; all lapsed means every lead ended before a slot."""
    from leadflow.operators.cohorts import lapse_breakdown
    d, old = dt.date(1998, 7, 9), dt.date(1998, 5, 9)
    leads = [(1, "csp_denied", 0, d), (1, "csp_denied", 0, d), (1, "csp_timeout", 0, d),  # all lapsed
             (2, "csp_denied", 0, d), (2, "open", 0, d),  # has an open lead
             (3, "installed", 0, d), (3, "csp_denied", 0, d),  # one was installed
             (4, "install_failed", 1, d),  # resolved after a slot
             (5, "csp_denied", 0, old),  # nothing this month
             (7, "csp_denied", 0, d)]  # not in the universe
    b = spark.createDataFrame(leads, "partner_id long, bucket string, reached_slot int, last_date date")
    universe = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, 6)], "partner_id long")
    got = {tuple(r) for r in lapse_breakdown(b, universe, dt.date(1998, 7, 1), dt.date(1998, 8, 1)).collect()}
    assert got == {("all_lapsed", "csp_denied", 1, 2), ("all_lapsed", "csp_timeout", 1, 1), ("truly_none", "none", 2, 0)}


def test_coverage_asks_for_todays_noleads_views(spark):
    from leadflow.operators.engagement import coverage
    screens = spark.createDataFrame([(1, "noleads"), (2, "secured"), (3, "almost")], "partner_id long, screen string")
    base = spark.createDataFrame([(1, 100), (2, 50), (3, 50)], "partner_id long, base long")
    window = spark.createDataFrame([(1, 90), (2, 3)], "partner_id long, n long")

    def run(n):
        return coverage(screens, window, base, spark.createDataFrame([(1, n), (2, 40)], "partner_id long, n long")).first()

    few, many = run(5), run(6)
    assert (few["includes_noleads"], few["targeted_base"], few["viewer_base"], few["coverage_pct"]) == (False, 100, 50, 50.0)
    assert (many["includes_noleads"], many["targeted_base"], many["viewer_base"], many["coverage_pct"]) == (True, 200, 150, 75.0)


def test_view_click_by_campaign(spark):
    from leadflow.operators.engagement import view_click
    t = dt.datetime(2024, 1, 6, 10)
    rows = [("a", 1, "banner_opened"), ("a", 1, "banner_opened"), ("a", 2, "banner_opened"), ("a", 1, "click"), ("b", 1, "click"), ("b", 3, "signup")]
    ev = spark.createDataFrame([(c, p, n, t) for c, p, n in rows], "campaign string, profile_id long, event_name string, ts timestamp_ntz")
    got = {r["campaign"]: (r["viewed"], r["clicked"], r["rate"]) for r in view_click(ev).collect()}
    assert got == {"a": (2, 1, 50), "b": (0, 1, 0)}


def test_landed_tables_feed_the_jobs(spark):
    """Tables written by their schemas are read back as the test mapping gives them, and the jobs take them."""
    from conftest import SMALL

    from leadflow.plans.params import DEFAULT
    from leadflow.plans.refresh import month_params, refresh_snapshot
    from leadflow.sources.landed import SCHEMAS, LandedTables
    from leadflow.sources.testdata import tables
    t, root = tables(spark, SMALL), f"{checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"
    for name in SCHEMAS:
        getattr(t, name).write.parquet(f"{root}/{name}")
    landed = LandedTables(spark, root)
    for name, schema in SCHEMAS.items():
        df = getattr(landed, name)
        assert df.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    a = refresh_snapshot(landed, DEFAULT, f"{root}/out").drop("tickets").collect()
    b = refresh_snapshot(t, DEFAULT, f"{root}/out2").drop("tickets").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and a
    with pytest.raises(AttributeError):
        landed.nothing
    # the month ends at local midnight, 5.5 hours before it does in UTC
    assert month_params("1998-07").as_of == dt.datetime(1998, 7, 31, 18, 30)


def test_checkpoint_folder_is_asked_for_on_a_cluster(monkeypatch):
    from leadflow import session

    class Fake:
        class conf:
            get = staticmethod(lambda k, d: d)

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                class sc:
                    class getCheckpointDir:
                        isDefined = staticmethod(lambda: False)

    with pytest.raises(ValueError):
        session.checkpoint_dir(Fake)
