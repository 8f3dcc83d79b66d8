"""Stored mergeable partials of the attempts (A3, A7, J9): a refresh reads the days that changed, not the history.

``LeadPartials`` is two tables. ``leads`` has a row for each lead and slice of time: the latest attempt of the slice and the sticky
flags, which combine by ``max_by`` and ``max``. ``tickets`` has the foremost open tickets of each partner and slice. A slice is
a UTC day; before ``folded_before`` it is a calendar month, so that old days don't stay as many small files.

``leads`` is partitioned by slice and bucketed by connection: a bucket's files of all slices are read by one task, so the merge
to one row a lead needs no exchange. ``refresh`` computes the slices of the days it is told anew from the attempts, and replaces these
partitions only. A day counts as touched for an attempt that came, and for the day it has left when its row was updated.

The tables lie at ``path``, with their settings in a manifest beside them, and are known to the session's catalog under ``name``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.functions.leads import flag, is_installed, is_open_ticket, ticket_rank
from leadflow.functions.timecols import date_lit, local_date, ts_lit
from leadflow.operators import leads as L
from leadflow.operators import snapshot as S
from leadflow.plans.params import DEFAULT, Params
from leadflow.sources.versions import Versions

C = F.col
_LEADS = ("connection_id bigint, partner_id bigint, last_state string, rc string, fr string, fsc string, rep_attempt_id string, "
          "offered timestamp_ntz, own boolean, last_update timestamp_ntz, installed int, slot int, tech int")
_TICKETS = "partner_id bigint, attempt_id string, zone_id string, updated_at timestamp_ntz, rnk int"
_EPOCH = dt.date(1900, 1, 1)
#: Attempts whose leads one bucket takes: its task sorts them, 150 to 250 bytes each.
ATTEMPTS_A_BUCKET = 1_000_000
_LATEST = ("last_state", "rc", "fr", "fsc", "rep_attempt_id", "offered", "own")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, was)


class LeadPartials:
    """The two tables ``{name}_leads`` and ``{name}_tickets`` at ``path``."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.leads_table, self.tickets_table = f"{name}_leads", f"{name}_tickets"
        self._settings = Versions(spark, f"{self.path}/settings")

    @classmethod
    def create(cls, spark: SparkSession, name: str, path: str, buckets: int = 256, folded_before: dt.date = _EPOCH) -> LeadPartials:
        """New, empty tables; ``buckets``: about the leads' partials over 128 MB each, a task reads one."""
        one = cls(spark, name, path)
        one._settings.publish({"buckets": int(buckets), "folded_before": _month_start(folded_before).isoformat()}, 0)
        return one._register()

    @classmethod
    def open(cls, spark: SparkSession, name: str, path: str) -> LeadPartials:
        """Tables that another session has made: known to this session's catalog from now on."""
        one = cls(spark, name, path)._register()
        for table in (one.leads_table, one.tickets_table):
            spark.catalog.recoverPartitions(table)
        return one

    def _register(self) -> LeadPartials:
        buckets = int(self._setting("buckets"))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.leads_table} ({_LEADS}, slice date) USING parquet PARTITIONED BY (slice) "
                       f"CLUSTERED BY (connection_id) INTO {buckets} BUCKETS LOCATION '{self.path}/leads'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.tickets_table} ({_TICKETS}, slice date) USING parquet PARTITIONED BY (slice) "
                       f"LOCATION '{self.path}/tickets'")
        return self

    def _setting(self, key: str):
        return self._settings.newest()[1].get(key)

    def _set(self, **values) -> None:
        number, now = self._settings.newest()
        self._settings.publish(now | values, number)

    @property
    def folded_before(self) -> dt.date:
        return dt.date.fromisoformat(self._setting("folded_before"))

    @property
    def as_of(self) -> dt.datetime | None:
        """The instant up to which the last refresh has seen attempts."""
        value = self._setting("as_of")
        return dt.datetime.fromisoformat(value) if value else None

    def slice_of(self, day: dt.date) -> dt.date:
        return _month_start(day) if day < self.folded_before else day

    # ------------------------------------------------------------------ write
    def refresh(self, attempts: DataFrame, as_of: dt.datetime, days: Iterable[dt.date] | None = None) -> None:
        """Compute the slices of ``days`` (all, without) from the attempts written before ``as_of``.

        The bounds of the days reach the scan as a filter on ``updated_at``; slices left without attempts go. A refresh may be run
        again; one that fails midway leaves some slices as they were before.
        """
        before = self.folded_before
        a = L.active_attempts(attempts, as_of, days=None)
        slices = None
        if days is not None:
            slices = sorted({_month_start(d) if d < before else d for d in days})
            if not slices:
                self._set(as_of=as_of.isoformat())
                return
            ends = [_next_month(s) if s < before else s + dt.timedelta(days=1) for s in slices]
            a = a.where((C("updated_at") >= ts_lit(slices[0])) & (C("updated_at") < ts_lit(max(ends))))
        day = C("updated_at").cast("date")
        a = a.withColumn("slice", F.when(day < date_lit(before), F.trunc(day, "month")).otherwise(day))
        if slices is not None:
            a = a.where(C("slice").isin(slices))
        self._replace(_partial_leads(a), _partial_tickets(a))
        for table, rows in ((self.leads_table, a), (self.tickets_table, a.where(is_open_ticket()))) if slices is not None else ():
            left = {r[0] for r in rows.select("slice").distinct().collect()}  # of the touched days
            self._drop(table, set(slices) - left)
        self._set(as_of=as_of.isoformat())

    def _replace(self, leads: DataFrame, tickets: DataFrame) -> None:
        buckets = int(self._setting("buckets"))
        with _dynamic_overwrite(self.spark):
            # dealt as the buckets are: a file for each bucket and slice
            leads.select(*[x.split()[0] for x in _LEADS.split(", ")], "slice").repartition(buckets, "connection_id").write.mode("overwrite").insertInto(self.leads_table)
            tickets.select(*[x.split()[0] for x in _TICKETS.split(", ")], "slice").repartition("slice").write.mode("overwrite").insertInto(self.tickets_table)

    def _drop(self, table: str, slices: Iterable[dt.date]) -> None:
        """Take slices out of the catalog, and their files away."""
        folder = f"{self.path}/{'leads' if table == self.leads_table else 'tickets'}"
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for s in sorted(slices):
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (slice = DATE '{s}')")
            fs.delete(path(f"{folder}/slice={s}"), True)

    def fold(self, before: dt.date, scratch: str) -> None:
        """Make months of the day slices before the month of ``before``, from the partials alone.

        ``scratch``: a new path on the shared folder; the merged rows are written there first, as a slice can't be read and
        replaced at once.
        """
        start, end = self.folded_before, _month_start(before)
        if end <= start:
            return
        days = (C("slice") >= date_lit(start)) & (C("slice") < date_lit(end))
        self._merged(self.spark.table(self.leads_table).where(days).withColumn("slice", F.trunc("slice", "month")), "slice").write.parquet(f"{scratch}/leads")
        S.foremost(self.spark.table(self.tickets_table).where(days).withColumn("slice", F.trunc("slice", "month")), 2, "slice").write.parquet(f"{scratch}/tickets")
        old = {t: [r[0] for r in self.spark.table(t).where(days).select("slice").distinct().collect()] for t in (self.leads_table, self.tickets_table)}
        self._set(folded_before=end.isoformat())
        self._replace(self.spark.read.parquet(f"{scratch}/leads"), self.spark.read.parquet(f"{scratch}/tickets"))
        for table, slices in old.items():
            self._drop(table, [s for s in slices if s.day != 1])

    # ------------------------------------------------------------------- read
    def _merged(self, rows: DataFrame, *more: str) -> DataFrame:
        latest = F.max_by(F.struct(*_LATEST), F.struct("last_update", "rep_attempt_id")).alias("l")
        return rows.groupBy("connection_id", "partner_id", *more).agg(
            latest, F.max("last_update").alias("last_update"), F.max("installed").alias("installed"),
            F.max("slot").alias("slot"), F.max("tech").alias("tech")).select(
            "connection_id", "partner_id", *[f"l.{c}" for c in _LATEST], "last_update", "installed", "slot", "tech", *more)

    def _visible(self, table: str, as_of: dt.datetime) -> DataFrame:
        """Slices that lie wholly before ``as_of``; an instant inside a day must be that of the last refresh."""
        rows = self.spark.table(table)
        seen = self.as_of
        if seen is not None and as_of >= seen:
            return rows
        if as_of.time() != dt.time() or as_of.date() < self.folded_before and as_of.day != 1:
            raise ValueError(f"{self.name} holds whole slices up to {seen}; refresh it as of {as_of}")
        return rows.where(C("slice") < date_lit(as_of.date()))

    def month_history(self, p: Params = DEFAULT) -> DataFrame:
        """What ``leads.month_history`` makes of all attempts: every lead, collapsed; no exchange."""
        g = self._merged(self._visible(self.leads_table, p.as_of))
        return g.select("connection_id", "partner_id", "last_state", "rc", "fr", "fsc", "rep_attempt_id", "offered",
                        C("installed").alias("has_installed"), C("slot").alias("reached_slot"), C("tech").alias("tech_assigned"),
                        flag(C("own")).alias("own_slot_latest"), local_date(C("last_update"), p.offset_minutes).alias("last_date"))

    def lead_views(self, p: Params = DEFAULT) -> DataFrame:
        """What ``leads.lead_views`` makes of all attempts: the whole history's flags and the rolling window's state."""
        start = p.as_of.date() - dt.timedelta(days=p.window_days)
        if start < self.folded_before:
            raise ValueError(f"the window starts on {start}, but days before {self.folded_before} are folded to months")
        recent = C("slice") >= date_lit(start)
        state = F.when(recent, F.struct("last_state", "rc", "fr", "fsc", "own"))
        g = self._visible(self.leads_table, p.as_of).groupBy("connection_id", "partner_id").agg(
            F.max_by(state, F.when(recent, F.struct("last_update", "rep_attempt_id"))).alias("l"),
            F.max(flag(recent)).alias("in_window"),
            F.max(F.when(recent, C("installed")).otherwise(0)).alias("has_installed"),
            F.max(F.when(recent, C("slot")).otherwise(0)).alias("reached_slot"),
            F.max("installed").alias("ever_installed"), F.max("tech").alias("ever_tech"), F.max("last_update").alias("last_update"))
        return g.select("connection_id", "partner_id", "l.last_state", "l.rc", "l.fr", "l.fsc", "l.own", "in_window", "has_installed",
                        "reached_slot", "ever_installed", "ever_tech", local_date(C("last_update"), p.offset_minutes).alias("last_date"))

    def top_tickets(self, p: Params = DEFAULT) -> DataFrame:
        """What ``snapshot.top_tickets`` makes of all attempts: two open tickets a partner, from two a slice."""
        return S.foremost(self._visible(self.tickets_table, p.as_of).drop("slice"), 2)


def _month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def _next_month(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def _partial_leads(a: DataFrame) -> DataFrame:
    latest = F.max_by(F.struct(
        C("current_state").alias("last_state"), C("reason_code").alias("rc"), C("failure_reason").alias("fr"), C("failure_subreason").alias("fsc"),
        C("attempt_id").alias("rep_attempt_id"), C("created_at").alias("offered"), C("confirmed_slot_at").isNotNull().alias("own")),
        F.struct("updated_at", "attempt_id"))
    g = a.groupBy("slice", "connection_id", "partner_id").agg(
        latest.alias("l"), F.max("updated_at").alias("last_update"), F.max(flag(is_installed(True))).alias("installed"),
        F.max(flag(C("confirmed_slot_at").isNotNull())).alias("slot"), F.max(flag(C("executor_id").isNotNull())).alias("tech"))
    return g.select("connection_id", "partner_id", *[f"l.{c}" for c in _LATEST], "last_update", "installed", "slot", "tech", "slice")


def _partial_tickets(a: DataFrame) -> DataFrame:
    rows = a.where(is_open_ticket()).select("partner_id", "attempt_id", "zone_id", "updated_at", ticket_rank().alias("rnk"), "slice")
    return S.foremost(rows, 2, "slice").drop("rn")


def buckets_for(attempts: DataFrame, least: int = 2) -> int:
    """Buckets of a new store, so that a task's share stays the same however many attempts there are."""
    return max(least, -(-attempts.count() // ATTEMPTS_A_BUCKET))


def touched_days(changes: DataFrame, at: Column | str = "updated_at") -> list[dt.date]:
    """The days that changed rows lie on: a few, one a day of the feed."""
    return sorted(r[0] for r in changes.select(F.col(at).cast("date") if isinstance(at, str) else at.cast("date")).distinct().collect() if r[0] is not None)
