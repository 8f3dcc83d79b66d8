"""Skew and plan-shape checks: a hot partner with a third of all rows, pushdown, partial aggregation."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from conftest import MID, SMALL
from leadflow.operators import leads as L
from leadflow.operators import snapshot as S
from leadflow.plans.params import DEFAULT as P
from leadflow.sources.testdata import TestData


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_partner_metric_matches_brute_force(spark):
    t = TestData(spark, MID)
    # re-key a third of all attempts onto one partner
    a = t.attempts.withColumn("partner_id", F.when(F.col("connection_id") % 3 == 0, F.lit(7)).otherwise(F.col("partner_id")))
    got = {r["partner_id"]: (r["installs"], r["denom"]) for r in L.metric_tech(a, P).collect()}
    pdf = a.where(F.col("active") & (F.col("updated_at") < F.lit("1998-08-15").cast("timestamp_ntz"))).select(
        "connection_id", "partner_id", "updated_at", "otp_verified", "installation_completed_at", "completed_step",
        "executor_id").toPandas()
    pdf["inst"] = pdf.otp_verified | pdf.installation_completed_at.notna() | (pdf.completed_step >= 7)
    pdf["tech"] = pdf.executor_id.notna()
    g = pdf.groupby(["connection_id", "partner_id"]).agg(inst=("inst", "max"), tech=("tech", "max"), last=("updated_at", "max"))
    g["day"] = (g["last"] + pd.Timedelta(minutes=330)).dt.date
    m = (g["day"] >= dt.date(1998, 7, 1)) & (g["day"] < dt.date(1998, 8, 1))
    g = g.assign(i=(g.inst & m).astype(int), d=(g.tech & m).astype(int)).groupby(level="partner_id")[["i", "d"]].sum()
    want = {int(k): (int(v.i), int(v.d)) for k, v in g.iterrows()}
    assert got == want
    assert got[7][1] > 0


def test_metric_aggregates_partially_before_shuffle(spark):
    plan = _plan(L.metric_tech(TestData(spark, MID).attempts, P))
    assert "partial_max_by" in plan or "partial_max" in plan
    assert "partial_count" in plan or "partial_sum" in plan


def test_ledger_month_filter_reaches_parquet(spark):
    """The local-month bound is written on the raw instant, so on a table where
    terminal_at is a stored column it becomes a Parquet pushed filter."""
    import uuid

    from leadflow.session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    TestData(spark, SMALL).ledger.write.parquet(path)
    df = L.ledger_month(spark.read.parquet(path), P.month_start, P.month_end)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        pushed = _plan(df).split("PushedFilters: [")[1].split("]")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(terminal_at,1998-06-30T18:30)" in pushed
    assert "LessThan(terminal_at,1998-07-31T18:30)" in pushed


def test_scan_prunes_columns(spark):
    df = TestData(spark, MID).attempts.select("partner_id", "connection_id")
    plan = _plan(df)
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "l_suppkey" in read and "l_orderkey" in read and "l_quantity" not in read


def test_ticket_topk_limits_before_shuffle(spark):
    t = TestData(spark, MID)
    df = S.top_tickets(L.active_attempts(t.attempts, P.as_of, None))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan


def _static_plan(spark, df) -> str:
    """The plan with neither AQE, broadcasts nor runtime filters to help it."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}
    was = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def _raw_exchanges(plan: str, table: str) -> list[str]:
    """Exchanges that rows of ``table`` reach before any aggregate."""
    lines = plan.split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    out = []
    for i, line in enumerate(lines):
        if "FileScan" not in line or f"/{table}.parquet" not in line:
            continue
        at = depth[i]
        for j in range(i - 1, -1, -1):  # upwards along the parents
            if depth[j] >= at:
                continue
            at = depth[j]
            if "Aggregate(" in lines[j]:
                break
            if "Exchange hashpartitioning" in lines[j]:
                out.append(lines[j])
                break
    return out


def test_no_exchange_on_raw_attempts(spark):
    from leadflow.operators import payout as PO
    t = TestData(spark, MID)
    daily = L.daily_leads(L.month_history(t.attempts, P), P)
    for df in (L.metric_tech(t.attempts, P), L.partner_month(t.attempts, P), L.metric_tech(t.attempts, P, impacted=t.ledger.select("connection_id")),
               PO.settle_record(t.rosters, daily, t.overlay), PO.rate_split(daily, t.overlay)):
        plan = _static_plan(spark, df)
        assert plan.count("lineitem.parquet") == 1
        assert _raw_exchanges(plan, "lineitem") == []


def test_hot_keys_are_combined_before_joins(spark):
    from leadflow.operators import cohorts as CO
    from leadflow.operators import engagement as E
    t = TestData(spark, MID)
    assert _raw_exchanges(_static_plan(spark, CO.enrolment_dates(t.optins, t.audits, t.rosters)), "orders") == []
    assert _raw_exchanges(_static_plan(spark, E.variant_totals(t.events, t.inventory)), "events") == []
    assert _raw_exchanges(_static_plan(spark, E.view_click(t.events)), "events") == []
    funnel = _static_plan(spark, E.segment_funnel(t.events, t.profiles, t.attempts, t.rosters, P.events_since, P.funnel_since))
    assert funnel.count("lineitem.parquet") == 1 and _raw_exchanges(funnel, "lineitem") == []
    lapse = CO.lapse_breakdown(L.bucketed_window(t.attempts, P), t.rosters, P.month_start, P.month_end)
    assert _raw_exchanges(_static_plan(spark, lapse), "lineitem") == []
    snap = S.month_snapshot(t.attempts, t.ledger, t.users, t.overlay, P)
    assert _static_plan(spark, snap).count("lineitem.parquet") == 2


def test_attempt_bounds_reach_parquet(spark):
    import uuid

    from leadflow.session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/attempts-{uuid.uuid4().hex}"
    TestData(spark, SMALL).attempts.write.parquet(path)
    stored = spark.read.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        one = _plan(L.active_attempts(stored, P.as_of, P.window_days)).split("PushedFilters: [")[1].split("]")[0]
        two = _plan(stored.where(F.col("active") & (F.col("created_at") >= F.lit("1998-07-09").cast("timestamp_ntz")))).split("PushedFilters: [")[1].split("]")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThan(updated_at,1998-08-15T00:00)" in one and "GreaterThanOrEqual(updated_at,1998-04-17T00:00)" in one
    assert "GreaterThanOrEqual(created_at,1998-07-09T00:00)" in two


def test_a_new_part_file_is_seen(spark, tmp_path):
    """Nothing of an earlier call is kept: the same query in the same session reads files that came since."""
    import shutil

    import pyarrow.parquet as pq

    from leadflow.plans import catalog
    catalog.load_all()
    for name in ("events", "lineitem", "orders", "customer", "supplier"):
        (tmp_path / f"{name}.parquet").mkdir()
        shutil.copyfile(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet" / "a.parquet")
    query = catalog.QUERIES["scan_named_events"]
    before = query(spark, str(tmp_path)).count()
    raw = pq.read_table(f"{SMALL}/events.parquet")
    pq.write_table(raw, str(tmp_path / "events.parquet" / "b.parquet"))
    assert before > 0 and query(spark, str(tmp_path)).count() == 2 * before
    total = catalog.QUERIES["stream_event_counts"](spark, str(tmp_path))
    assert total.agg(F.sum("events")).first()[0] == raw.num_rows  # replayed events count once


def test_hot_profile_click_counts_match_brute_force(spark):
    from leadflow.operators import engagement as E
    t = TestData(spark, MID)
    ev = t.events.withColumn("profile_id", F.when(F.col("event_id") % 3 == 0, F.lit(5)).otherwise(F.col("profile_id")))
    bridge = E.profile_bridge(t.profiles, undeleted=False)
    got = {r["partner_id"]: r["n_clicks"] for r in E.click_counts(E.per_profile(ev, "banner_opened", P.events_since), bridge).collect()}
    pe = ev.where((F.col("event_name") == "banner_opened") & (F.col("ts") >= F.lit("2024-01-09").cast("timestamp_ntz"))) \
        .select("profile_id").toPandas()
    pb = bridge.toPandas()
    want = pe.merge(pb, on="profile_id").groupby("partner_id").size().to_dict()
    assert got == {int(k): int(v) for k, v in want.items()}
    plan = _plan(E.click_counts(E.per_profile(ev, "banner_opened", P.events_since), bridge))
    # events are combined per profile before the join's exchange
    assert plan.index("partial_count") > plan.index("Join")


def test_a_hot_profile_is_dealt_evenly_without_aqe(spark):
    """A third of the events on one profile: every partition of the salted join holds at most twice the median's rows."""
    import statistics

    from leadflow.functions.joins import heavy_keys, salted_join
    from leadflow.operators import engagement as E
    n, parts = 200_000, 16
    ev = spark.range(n).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).cast("bigint").alias("profile_id"))
    bridge = spark.range(5000).select(F.col("id").alias("profile_id"), (F.col("id") % 50).alias("partner_id")).union(spark.createDataFrame([(7, 99)], "profile_id bigint, partner_id bigint"))
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(parts)}
    was = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        heavy = heavy_keys(ev, "profile_id", 0.01)
        assert set(heavy) == {7} and abs(heavy[7] - 1 / 3) < 0.01

        def sizes(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain, salted = sizes(E.attribute(ev, bridge)), sizes(salted_join(ev, bridge, "profile_id", heavy, parts))
        assert max(plain) > 5 * statistics.median(plain)
        assert len(salted) == parts and max(salted) <= 2 * statistics.median(salted)
        got = E.attribute_skewed(ev, bridge).groupBy("partner_id").count().collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, E.attribute(ev, bridge).groupBy("partner_id").count().collect()))
        same = spark.range(9000).select(F.lit(3).cast("bigint").alias("profile_id"))  # equal rows spread as well
        assert len(sizes(salted_join(same, bridge, "profile_id", {3: 1.0}, parts))) == parts
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert heavy_keys(ev.limit(0), "profile_id", 0.01) == {}
