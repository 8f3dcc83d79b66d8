"""The month sink: published in one step, frozen for good, found by key, compared by checksums."""

import uuid

import pytest
from pyspark.sql import functions as F

from leadflow.operators import snapshot as S
from leadflow.session import checkpoint_dir
from leadflow.sources import snapshots as SNAP
from leadflow.sources.versions import Conflict, Versions
from test_scale import _static_plan

SCHEMA = "partner_id bigint, installs bigint, user_id string"


def sink(spark):
    return f"{checkpoint_dir(spark)}/sink-{uuid.uuid4().hex}"


def month(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def read(spark, path, m):
    return sorted(tuple(r)[:3] for r in SNAP.read_month(spark, path, m, m).collect())


# ---------------------------------------------------------------- K2
def test_a_job_that_dies_before_publishing_changes_nothing(spark, monkeypatch):
    path = sink(spark)
    SNAP.write_month(month(spark, [(1, 5, "a")]), path, "1998-06")
    SNAP.write_month(month(spark, [(1, 6, "a")]), path, "1998-07")
    reader = SNAP.read_month(spark, path, "1998-07", "1998-06")  # planned before the new version

    class Died(RuntimeError):
        pass

    def die(*a):
        raise Died
    with monkeypatch.context() as mp:
        mp.setattr(Versions, "publish", die)
        with pytest.raises(Died):
            SNAP.write_month(month(spark, [(1, 99, "b")]), path, "1998-07")
    assert read(spark, path, "1998-07") == [(1, 6, "a")] and read(spark, path, "1998-06") == [(1, 5, "a")]
    SNAP.write_month(month(spark, [(1, 7, "c"), (2, 8, None)]), path, "1998-07")
    assert read(spark, path, "1998-07") == [(1, 7, "c"), (2, 8, None)] and read(spark, path, "1998-06") == [(1, 5, "a")]
    assert reader.collect()[0]["installs"] == 6  # its files are still there
    assert {(r["month"], r["partner_id"]) for r in SNAP.read_months(spark, path).collect()} == {("1998-06", 1), ("1998-07", 1), ("1998-07", 2)}


def test_frozen_months_are_refused_without_the_argument(spark):
    path = sink(spark)
    one, two = month(spark, [(1, 5, "a")]), month(spark, [(1, 9, "a")])
    SNAP.write_month(one, path, "1998-06")
    SNAP.write_month(one, path, "1998-07", frozen=["1998-06"])
    before = Versions(spark, path)._names("data")
    with pytest.raises(SNAP.FrozenMonthError):
        SNAP.write_month(two, path, "1998-06")
    assert Versions(spark, path)._names("data") == before  # nothing was written
    with pytest.raises(SNAP.FrozenMonthError):
        SNAP.write_month(two, path, "1998-08", frozen=["1998-08"])
    SNAP.freeze(spark, path, ["1998-07"])
    assert SNAP.frozen_months(spark, path) == {"1998-06", "1998-07"}
    SNAP.thaw(spark, path, ["1998-06"])
    assert SNAP.write_month(two, path, "1998-06") and read(spark, path, "1998-06") == [(1, 9, "a")]


def test_a_month_frozen_while_it_was_built_is_refused(spark, monkeypatch):
    path = sink(spark)
    SNAP.write_month(month(spark, [(1, 5, "a")]), path, "1998-06")
    lay_out = SNAP._lay_out

    def meanwhile(*a):
        SNAP.freeze(spark, path, ["1998-06"])
        return lay_out(*a)
    monkeypatch.setattr(SNAP, "_lay_out", meanwhile)
    with pytest.raises(SNAP.FrozenMonthError):
        SNAP.write_month(month(spark, [(1, 9, "a")]), path, "1998-06")
    assert read(spark, path, "1998-06") == [(1, 5, "a")]


def test_two_writers_of_two_months_both_arrive(spark, monkeypatch):
    path = sink(spark)
    publish, first = Versions.publish, []

    def crossed(self, content, after):
        if not first:
            first.append(1)
            SNAP.write_month(month(spark, [(2, 2, "y")]), path, "1998-07")
        return publish(self, content, after)
    monkeypatch.setattr(Versions, "publish", crossed)
    SNAP.write_month(month(spark, [(1, 1, "x")]), path, "1998-06")
    assert read(spark, path, "1998-06") == [(1, 1, "x")] and read(spark, path, "1998-07") == [(2, 2, "y")]
    monkeypatch.setattr(Versions, "publish", lambda *a: (_ for _ in ()).throw(Conflict("always")))
    with pytest.raises(Conflict):
        SNAP.write_month(month(spark, [(1, 1, "x")]), path, "1998-06")


def test_unknown_months(spark):
    path = sink(spark)
    with pytest.raises(ValueError):
        SNAP.read_month(spark, path, "1998-06", "1998-05")
    SNAP.write_month(month(spark, []), path, "1998-06")
    assert SNAP.read_month(spark, path, None, "1998-06").columns == ["partner_id", "installs", "user_id", "month"]
    assert read(spark, path, "1998-06") == []


# ---------------------------------------------------------------- F12
def scanned_rows(df):
    """Rows that the Parquet scan of a collected query gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "Scan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_a_lookup_reads_one_row_group(spark, monkeypatch):
    monkeypatch.setattr(SNAP, "ROW_GROUP", 1 << 20)
    n, path = 1_000_000, sink(spark)
    ids = spark.range(n).select((F.col("id") * 7919 % n * 2).alias("partner_id"), F.col("id").alias("installs"), F.sha2(F.col("id").cast("string"), 256).alias("user_id"))
    SNAP.write_month(ids.repartition(8), path, "1998-07")
    import pyarrow.parquet as pq
    files = [f.replace("file://", "") for f in SNAP.read_month(spark, path, "1998-07", "1998-07").inputFiles()]
    groups = sorted((g.column(0).statistics.min, g.column(0).statistics.max, g.num_rows) for f in files for m in [pq.ParquetFile(f).metadata] for g in map(m.row_group, range(m.num_row_groups)))
    assert len(groups) > 20 and all(a[1] < b[0] for a, b in zip(groups, groups[1:]))  # ranges that don't overlap
    one = SNAP.find(spark, path, "1998-07", "1998-07", [777_778])
    assert scanned_rows(one)[0] <= max(g[2] for g in groups) < n / 20 and [r["partner_id"] for r in one.collect()] == [777_778]
    assert scanned_rows(SNAP.find(spark, path, "1998-07", "1998-07", [777_777])) == [0]  # inside the bounds: the Bloom filter knows
    looked = S.lookup(SNAP.find(spark, path, "1998-07", "1998-07", [4, 5]), spark.createDataFrame([(4,), (5,)], "partner_id bigint"), ("installs",))
    assert sorted((r["partner_id"], r["found"]) for r in looked.collect()) == [(4, 1), (5, 0)]


# ---------------------------------------------------------------- K3
def test_equal_versions_need_no_join(spark):
    path = sink(spark)
    rows = [(k, k % 7, None if k % 3 else str(k)) for k in range(3000)]
    assert SNAP.write_month(month(spark, rows), path, "1998-07")
    assert not SNAP.write_month(month(spark, rows[::-1]).repartition(5), path, "1998-07", only_if_changed=True)
    assert Versions(spark, path).numbers() == [1]
    SNAP.write_month(month(spark, rows), path, "1998-08")
    same = SNAP.changed_between(spark, path, "1998-07", "1998-08")
    assert same.collect() == [] and "Join" not in _static_plan(spark, same)
    assert SNAP.write_month(month(spark, rows[:-1]), path, "1998-07", only_if_changed=True)


def test_only_buckets_that_differ_are_joined(spark):
    path = sink(spark)
    rows = {k: (k, k % 7, None if k % 3 else str(k)) for k in range(20_000)}
    new = {**rows, 5: (5, 99, None), 6: (6, 6, None), 70_000: (70_000, 1, "x")}
    del new[11]
    SNAP.write_month(month(spark, list(rows.values())), path, "1998-07")
    SNAP.write_month(month(spark, list(new.values())), path, "1998-08")
    got = SNAP.changed_between(spark, path, "1998-07", "1998-08")
    assert sorted(tuple(r) for r in got.collect()) == [(5, "changed"), (6, "changed"), (11, "removed"), (70_000, "added")]
    joined = spark.createDataFrame([(k,) for k in range(20_000)], "partner_id bigint").where(SNAP._bucket("partner_id").isin(SNAP.differing(
        SNAP.digests(month(spark, list(rows.values())), "partner_id"), SNAP.digests(month(spark, list(new.values())), "partner_id"))))
    assert joined.count() < 300
    part = SNAP.changed_between(spark, path, "1998-07", "1998-08", ["user_id"])  # some columns: checksums made anew
    assert sorted(tuple(r) for r in part.collect()) == [(6, "changed"), (11, "removed"), (70_000, "added")]


def test_checksums_tell_nulls_and_places_apart(spark):
    d = lambda rows: {tuple(r) for r in SNAP.digests(spark.createDataFrame(rows, "partner_id bigint, a string, b string"), "partner_id").collect()}
    assert d([(1, "x", None)]) != d([(1, None, "x")]) and d([(1, "x", "y"), (2, "y", "x")]) == d([(2, "y", "x"), (1, "x", "y")])
    assert d([(1, "x", "x"), (1, "x", "x")]) != d([(1, "y", "y"), (1, "y", "y")])


def test_documents_of_a_frozen_month_are_refused(spark):
    from leadflow.plans.refresh import write_documents
    out = sink(spark)
    doc = {"one": month(spark, [(1, 1, "x")])}
    write_documents(doc, out, "1998-06")
    with pytest.raises(SNAP.FrozenMonthError):
        write_documents(doc, out, "1998-06", frozen=["1998-06"])
