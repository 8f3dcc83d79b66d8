"""Stored lead partials: the same results as from the attempts, only touched days read and replaced, no exchange when merged."""

import datetime as dt
import glob
import os
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from leadflow.operators import leads as L
from leadflow.operators import partials
from leadflow.operators import snapshot as S
from leadflow.operators.partials import LeadPartials, touched_days
from leadflow.plans import q_snapshot
from leadflow.plans.params import DEFAULT as P
from leadflow.session import checkpoint_dir
from leadflow.sources.testdata import TestData
from test_scale import _static_plan

SCHEMA = ("partner_id bigint, connection_id bigint, attempt_id string, current_state string, reason_code string, failure_reason string, "
          "failure_subreason string, zone_id string, executor_id string, otp_verified boolean, completed_step int, updated_at timestamp_ntz, "
          "created_at timestamp_ntz, confirmed_slot_at timestamp_ntz, installation_completed_at timestamp_ntz, active boolean")


def new_store(spark, **k):
    name = f"partials_{uuid.uuid4().hex}"
    return LeadPartials.create(spark, name, f"{checkpoint_dir(spark)}/{name}", **{"buckets": 2, **k})


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def attempt(c, partner, t, state="ACCEPTED", attempt_id=None, executor=None, otp=False, slot=None):
    return (partner, c, attempt_id or f"{c}-{t:%d%H%M}", state, None, None, None, "z", executor, otp, 1, t, t - dt.timedelta(days=1), slot, None, True)


def recent_attempts(spark):
    """Test attempts of some months, so that a store by days stays small."""
    return TestData(spark, SMALL).attempts.where(F.col("updated_at") >= F.lit("1998-06-10").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def filled(spark):
    store = new_store(spark, folded_before=dt.date(1998, 4, 1))
    a = recent_attempts(spark)
    first = dt.datetime(1998, 7, 20, 9, 30)
    store.refresh(a, first)
    store.refresh(a, P.as_of, touched_days(L.active_attempts(a.where(F.col("updated_at") >= F.lit(str(first)).cast("timestamp_ntz")), P.as_of, None)))
    return store


def test_buckets_grow_with_the_attempts(spark, monkeypatch):
    attempts = TestData(spark, SMALL).attempts.count()
    assert partials.buckets_for(TestData(spark, SMALL).attempts) == 2
    monkeypatch.setattr(partials, "ATTEMPTS_A_BUCKET", attempts // 5 + 1)
    store = q_snapshot._lead_partials(spark, SMALL)
    assert store._setting("buckets") == 5
    assert rows(store.month_history(P)) == rows(L.month_history(TestData(spark, SMALL).attempts, P))


def test_merged_partials_equal_the_attempts(spark, filled):
    a, t = recent_attempts(spark), TestData(spark, SMALL)
    assert rows(filled.month_history(P)) == rows(L.month_history(a, P))
    assert rows(filled.lead_views(P)) == rows(L.lead_views(a, P))
    assert rows(filled.top_tickets(P)) == rows(S.top_tickets(L.active_attempts(a, P.as_of, None)))
    enrol = t.overlay.where(F.col("joined").isNotNull())
    assert rows(S.month_snapshot_of(filled, t.ledger, t.users, enrol, P, t.impacted)) == rows(S.month_snapshot(a, t.ledger, t.users, enrol, P, t.impacted))


def test_an_earlier_day_is_seen_from_the_same_store(spark, filled):
    p = replace(P, as_of=dt.datetime(1998, 8, 1))
    assert rows(filled.month_history(p)) == rows(L.month_history(recent_attempts(spark), p))
    with pytest.raises(ValueError, match="refresh it"):
        filled.month_history(replace(P, as_of=dt.datetime(1998, 8, 1, 18, 30)))
    with pytest.raises(ValueError, match="folded"):
        filled.lead_views(replace(P, window_days=400))


def test_no_exchange_before_the_first_aggregate(spark, filled):
    for df in (L.metric_tech(None, P, leads=filled.month_history(P)), L.partner_month_of(filled.lead_views(P), P)):
        lines = _static_plan(spark, df).split("\n")
        scan = next(i for i, x in enumerate(lines) if "FileScan" in x)
        above = lines[:scan][::-1]
        first_final = next(i for i, x in enumerate(above) if "Aggregate(" in x and "partial_" not in x)
        assert "Bucketed: true" in lines[scan]
        assert not any("Exchange" in x for x in above[: first_final + 1]), "\n".join(lines)
    tickets = _static_plan(spark, filled.top_tickets(P))
    assert "_leads" not in tickets and "/leads" not in tickets


def test_a_refresh_reads_and_replaces_the_touched_days_only(spark, filled):
    stored = f"{checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}"
    recent_attempts(spark).write.parquet(stored)
    store = new_store(spark, folded_before=dt.date(1998, 8, 1))
    a = spark.read.parquet(stored)
    store.refresh(a, dt.datetime(1998, 8, 10))
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store.path}/*/slice=*/*.parquet")}
    before, plans = files(), []
    replace_ = LeadPartials._replace

    def seen(self, leads, tickets):
        spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
        plans.append(leads._jdf.queryExecution().executedPlan().toString())
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        return replace_(self, leads, tickets)

    try:
        LeadPartials._replace = seen
        store.refresh(a, P.as_of, [dt.date(1998, 8, 9), dt.date(1998, 8, 10)])
    finally:
        LeadPartials._replace = replace_
    pushed = plans[0].split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(updated_at,1998-08-09T00:00)" in pushed and "LessThan(updated_at,1998-08-11T00:00)" in pushed
    after = files()
    touched = {f.split("slice=")[1][:10] for f in before.keys() ^ after.keys()}
    assert touched <= {"1998-08-09", "1998-08-10"} and "1998-08-10" in touched
    assert all(after[f] == t for f, t in before.items() if f in after)
    assert rows(store.month_history(P)) == rows(L.month_history(a.where(F.col("updated_at") < F.lit("1998-08-11").cast("timestamp_ntz")), P))


def test_rows_that_move_to_another_day_leave_the_old_one(spark):
    day = dt.datetime(1998, 7, 1)
    old = [attempt(1, 7, day, "ACCEPTED", "x"), attempt(2, 7, day + dt.timedelta(days=1)), attempt(3, 8, day, executor="t")]
    store = new_store(spark)
    store.refresh(spark.createDataFrame(old, SCHEMA), dt.datetime(1998, 7, 3))
    new = [attempt(1, 7, day + dt.timedelta(days=4), "DECLINED", "x", otp=True), attempt(2, 7, day + dt.timedelta(days=1)), attempt(3, 8, day + dt.timedelta(days=4), executor="t")]
    now = spark.createDataFrame(new, SCHEMA)
    store.refresh(now, dt.datetime(1998, 7, 9), [day.date(), dt.date(1998, 7, 5)])
    p = replace(P, as_of=dt.datetime(1998, 7, 9))
    assert rows(store.month_history(p)) == rows(L.month_history(now, p))
    assert "slice=1998-07-01" not in str(spark.sql(f"SHOW PARTITIONS {store.leads_table}").collect())
    store.refresh(now, dt.datetime(1998, 7, 9), [])  # nothing new
    assert rows(store.month_history(p)) == rows(L.month_history(now, p))


def test_ties_nulls_and_a_hot_partner(spark):
    day = dt.datetime(1998, 7, 1, 5)
    data = [attempt(c, 7 if c % 3 else c, day + dt.timedelta(days=c % 9, minutes=c % 2), "SLOT_SELECTED" if c % 4 else "ARRIVED_AT_SITE", f"a{c % 5}") for c in range(400)]
    data += [attempt(1, 7, day + dt.timedelta(days=1, minutes=1), "DECLINED", "a9", slot=day), attempt(1, None, day), attempt(None, 7, day)]
    a = spark.createDataFrame(data, SCHEMA)
    store = new_store(spark)
    store.refresh(a, P.as_of)
    assert rows(store.month_history(P)) == rows(L.month_history(a, P))
    assert rows(store.lead_views(P)) == rows(L.lead_views(a, P))
    key = ["partner_id", "rnk", "updated_at", "rn"]
    assert rows(store.top_tickets(P).select(*key)) == rows(S.top_tickets(L.active_attempts(a, P.as_of, None)).select(*key))
    empty = new_store(spark)
    empty.refresh(a.limit(0), P.as_of)
    assert rows(empty.month_history(P)) == [] and rows(empty.top_tickets(P)) == []


def test_folded_months_and_another_session(spark):
    a = recent_attempts(spark).where(F.col("updated_at") < F.lit("1998-07-25").cast("timestamp_ntz"))
    store = new_store(spark)
    store.refresh(a, dt.datetime(1998, 7, 25))
    p = replace(P, as_of=dt.datetime(1998, 7, 25), window_days=12)
    want = rows(L.month_history(a, p)), rows(L.lead_views(a, p)), rows(S.top_tickets(L.active_attempts(a, p.as_of, None)))
    got = lambda s: (rows(s.month_history(p)), rows(s.lead_views(p)), rows(s.top_tickets(p)))
    assert got(store) == want
    store.fold(dt.date(1998, 7, 10), f"{checkpoint_dir(spark)}/fold-{uuid.uuid4().hex}")
    slices = {r[0] for r in spark.table(store.leads_table).select("slice").distinct().collect()}
    assert got(store) == want and dt.date(1998, 6, 1) in slices and not {s for s in slices if s < dt.date(1998, 7, 1) and s.day > 1}
    store.refresh(a, dt.datetime(1998, 7, 25), [dt.date(1998, 6, 17)])  # a day of a folded month
    assert got(store) == want
    again = LeadPartials.open(spark, f"{store.name}_again", store.path)
    assert got(again) == want and again.folded_before == dt.date(1998, 7, 1)


def test_a_refresh_from_partials_publishes_the_same_month(spark):
    from leadflow.plans import refresh as R
    from leadflow.sources import snapshots as SNAP
    from leadflow.sources.versions import Versions

    t = TestData(spark, SMALL)
    t.__dict__["attempts"] = recent_attempts(spark)
    out = f"{checkpoint_dir(spark)}/out-{uuid.uuid4().hex}"
    store = new_store(spark, folded_before=dt.date(1998, 3, 1))
    early = R.month_params("1998-07", as_of=dt.datetime(1998, 7, 20))
    p = R.month_params("1998-07", as_of=dt.datetime(1998, 8, 15))
    R.refresh_snapshot(t, early, f"{out}/a", partials=store)
    assert R.touched_since(t.attempts, store, p)[0] == dt.date(1998, 7, 19)
    R.refresh_snapshot(t, p, f"{out}/a", partials=store)
    R.refresh_snapshot(t, p, f"{out}/b")
    a, b = (SNAP.read_month(spark, f"{out}/{x}/snapshot", "1998-07", "1998-07") for x in "ab")
    assert rows(a) == rows(b) and a.count() > 0
    R.refresh_snapshot(t, p, f"{out}/a", partials=store)  # nothing has changed: nothing is published
    assert Versions(spark, f"{out}/a/snapshot").numbers() == [1, 2]
    SNAP.freeze(spark, f"{out}/a/snapshot", ["1998-07"])
    with pytest.raises(SNAP.FrozenMonthError):
        R.refresh_snapshot(t, p, f"{out}/a", partials=store)
