"""Streaming jobs agree with their batch equivalents, however the feed is cut into files and in whatever order they come."""

import datetime as dt
import os
import random
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from leadflow.operators import engagement as E
from leadflow.operators import leads as L
from leadflow.plans.params import DEFAULT as P
from leadflow.session import checkpoint_dir
from leadflow.sources.testdata import TestData, map_attempts, map_events, tables
from leadflow.streaming import jobs as ST


def _folder(spark, name):
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    os.makedirs(f"{path}/src")
    return path


def _events(spark, path):
    return map_events(ST.stream_table(spark, path, tables(spark, SMALL).raw("events").schema))


def _counts(df):
    return {(r["day"], r["event_name"]): r["events"] for r in df.collect()}


@pytest.fixture(scope="module")
def batch_counts(spark):
    ev = TestData(spark, SMALL).events
    return {(r["day"], r["event_name"]): r["count"] for r in ev.groupBy(F.col("ts").cast("date").alias("day"), "event_name").count().collect()}


def test_daily_openers_equals_batch(spark):
    t = TestData(spark, SMALL)
    bridge = E.profile_bridge(t.profiles, t.rosters.where(F.col("category") == "enrolled"))
    s = {tuple(r) for r in ST.daily_openers(spark, _events(spark, f"{SMALL}/events.parquet"), bridge, P.engagement_start).collect()}
    b = {tuple(r) for r in E.daily_engagement(E.daily_opens(t.events, bridge, P.engagement_start)).collect()}
    assert s == b and len(s) > 0


def test_event_counts_final_flag(spark):
    rows = ST.event_counts(spark, _events(spark, f"{SMALL}/events.parquet")).collect()
    days = sorted({r["day"] for r in rows})
    assert all(r["final"] for r in rows if r["day"] < days[-2])
    assert not any(r["final"] for r in rows if r["day"] == days[-1])
    closed = ST.final_event_counts(spark, _events(spark, f"{SMALL}/events.parquet"))
    assert _counts(closed) == {(r["day"], r["event_name"]): r["events"] for r in rows if r["final"]}


def test_a_folder_of_part_files(spark, batch_counts):
    """A table that is a folder, with file names of their own."""
    base = _folder(spark, "parts")
    raw = pq.read_table(f"{SMALL}/events.parquet")
    for k in range(4):
        pq.write_table(raw.slice(k * raw.num_rows // 4, raw.num_rows // 4), f"{base}/src/part-{k:05d}.parquet")
    assert _counts(ST.event_counts(spark, _events(spark, f"{base}/src"))) == batch_counts


def test_350_shuffled_small_files(spark, batch_counts):
    base = _folder(spark, "small")
    raw = pq.read_table(f"{SMALL}/events.parquet")
    order = list(range(raw.num_rows))
    random.Random(2).shuffle(order)
    cuts = [order[k * raw.num_rows // 350 : (k + 1) * raw.num_rows // 350] for k in range(350)]
    for k, rows in enumerate(cuts[:200]):
        pq.write_table(raw.take(rows), f"{base}/src/{k}.parquet")
    run = f"{base}/run"
    ST.event_counts(spark, _events(spark, f"{base}/src"), run_dir=run).count()
    for k, rows in enumerate(cuts[200:]):
        pq.write_table(raw.take(rows), f"{base}/src/later-{k}.parquet")
    assert _counts(ST.event_counts(spark, _events(spark, f"{base}/src"), run_dir=run)) == batch_counts
    # rows of the second drain that lay behind the watermark of the first one: counted, and in the result
    assert ST.late_rows(spark, run).agg(F.sum("late_rows")).first()[0] > 50


def test_late_and_replayed_events_correct_closed_days(spark, batch_counts):
    base = _folder(spark, "late")
    raw = pq.read_table(f"{SMALL}/events.parquet")
    first, held = raw.slice(50), raw.slice(0, 50)
    pq.write_table(first, f"{base}/src/a.parquet")
    run = f"{base}/run"
    before = _counts(ST.event_counts(spark, _events(spark, f"{base}/src"), run_dir=run))
    assert sum(before.values()) == raw.num_rows - 50
    pq.write_table(pa.concat_tables([held, first.slice(0, 300)]), f"{base}/src/b.parquet")
    assert _counts(ST.event_counts(spark, _events(spark, f"{base}/src"), run_dir=run)) == batch_counts
    ST.compact_feed(spark, run)
    pq.write_table(first.slice(300, 300), f"{base}/src/c.parquet")  # replayed once more, after the feed was folded
    assert _counts(ST.event_counts(spark, _events(spark, f"{base}/src"), run_dir=run)) == batch_counts


def test_nothing_there_is_empty_but_failures_are_raised(spark):
    base = _folder(spark, "none")
    assert ST.event_counts(spark, _events(spark, f"{base}/src")).count() == 0
    with open(f"{base}/src/broken.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        ST.event_counts(spark, _events(spark, f"{base}/src")).count()


def test_latest_attempt_partials_combine_across_runs(spark):
    """ST2 keeps no state: two drains leave partials whose combination equals the one-shot collapse, also when folded."""
    base = _folder(spark, "st2")
    raw = pq.read_table(f"{SMALL}/lineitem.parquet")
    half, run = raw.num_rows // 2, f"{base}/run"
    schema = tables(spark, SMALL).raw("lineitem").schema

    def drain(**k):
        return ST.latest_attempts(spark, map_attempts(ST.stream_table(spark, f"{base}/src", schema)), run_dir=run, **k)

    pq.write_table(raw.slice(0, half), f"{base}/src/a.parquet")
    drain().count()
    ST.compact_partials(spark, run)
    pq.write_table(raw.slice(half), f"{base}/src/b.parquet")
    got = {tuple(r) for r in drain().collect()}
    t = tables(spark, SMALL)
    leads = L.collapse_attempts(t.attempts.where(F.col("active") & F.col("partner_id").isNotNull()))
    cols = ("connection_id", "partner_id", "last_state", "rep_attempt_id", "has_installed", "tech_assigned", "last_date")
    want = {tuple(r) for r in leads.select(*cols).collect()}
    assert got == want
    # each lead stands in the partition of its last month, and nowhere else
    for month in ("1998-07", "1996-02"):
        mine = {r for r in want if r[-1].strftime("%Y-%m") == month}
        assert {tuple(r) for r in ST.month_of_leads(spark, run, month).select(*cols).collect()} == mine and mine


def test_frozen_months_stay(spark):
    base = _folder(spark, "st2-frozen")
    schema = "partner_id bigint, connection_id bigint, attempt_id string, current_state string, executor_id string, otp_verified boolean, completed_step int, updated_at timestamp_ntz, installation_completed_at timestamp_ntz, active boolean"

    def put(name, rows):
        df = spark.createDataFrame([(7, c, a, s, None, False, 1, t, None, True) for c, a, s, t in rows], schema)
        df.coalesce(1).write.mode("append").parquet(f"{base}/src")

    def drain(**k):
        return ST.latest_attempts(spark, ST.stream_table(spark, f"{base}/src", df_schema), run_dir=f"{base}/run", **k)

    df_schema = spark.createDataFrame([], schema).schema
    put("a", [(1, "x1", "ACCEPTED", dt.datetime(1998, 6, 5)), (2, "x2", "ACCEPTED", dt.datetime(1998, 6, 6))])
    drain()
    put("b", [(1, "x3", "DECLINED", dt.datetime(1998, 7, 5)), (2, "x4", "DECLINED", dt.datetime(1998, 6, 9))])
    drain(frozen=["1998-06"])
    state = lambda m: {(r["connection_id"], r["last_state"]) for r in ST.month_of_leads(spark, f"{base}/run", m).collect()}
    assert state("1998-06") == {(1, "ACCEPTED"), (2, "ACCEPTED")} and state("1998-07") == {(1, "DECLINED")}
    put("c", [(2, "x5", "DECLINED", dt.datetime(1998, 7, 9))])
    drain()
    assert state("1998-07") == {(1, "DECLINED"), (2, "DECLINED")} and state("1998-06") == set()
