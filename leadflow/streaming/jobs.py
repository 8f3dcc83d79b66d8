"""Structured Streaming jobs for the continuously refreshed views (ST1-ST3).

Sources are tables of their own (a folder of files that grows, or a single file), read whole: nothing caps the files of a
micro-batch. What a batch needs of the past is keyed state in RocksDB: the event ids that have been seen (ST1, ST3), the lead as
it stands (ST2). So a batch reads and writes what it brings, whatever the history; no feed is stored or read again. Its
results go to a ``DeltaLog``: counts that add up, leads of which the latest counts; a reader combines a few folders.

By default no row is ever too late: the result doesn't depend on how files are cut into batches, replayed events count once,
and a late event corrects its closed day. The watermark (latest event minus the allowed lateness) only says which days are final;
rows behind it are counted in the run's notes. With ``remember_days`` the state of event ids is bounded by Spark's watermark
instead: events later than that are left out, as ``dropDuplicatesWithinWatermark`` does. ``closed_days`` and ``open_days`` are the
plain event-time form: a day's counts are emitted once when the watermark has passed its end, and as they change before that.

Everything lies in a run folder on the shared checkpoint folder. A batch that is run again after a failure is known by its
number; a driver that dies at any moment leaves the version before (see ``sources.versions``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.functions.leads import flag, is_installed
from leadflow.functions.timecols import local_date, ts_lit
from leadflow.session import checkpoint_dir
from leadflow.streaming.deltas import DeltaLog

C = F.col
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def stream_table(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """An append-only Parquet table at its own path as a stream: all files of a folder, or the one file that it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema).options(**options)
    if fs.exists(p) and fs.getFileStatus(p).isFile():  # file streams read folders: this file of its folder, then
        return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())
    return reader.parquet(path)


def _run_dir(spark: SparkSession, name: str, run_dir: str | None) -> str:
    return run_dir.rstrip("/") if run_dir else f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _drain(stream: DataFrame, run: str, on_batch: Callable[[DataFrame, int], None], mode: str = "append") -> list[dict]:
    """Process all that is there, then stop; offsets and state stay in the run folder for the next call.

    Returns what Spark reports of each batch. State lives in RocksDB, whatever the session's own provider is.
    """
    spark = stream.sparkSession
    was = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        q = (stream.writeStream.outputMode(mode).foreachBatch(on_batch)
             .option("checkpointLocation", f"{run}/checkpoint").trigger(availableNow=True).start())
    finally:
        spark.conf.set(_PROVIDER, was)
    q.awaitTermination()
    return [p for p in q.recentProgress if p["numInputRows"]]


# ------------------------------------------------------------- events, each once
def _instant(ts: str):
    """A clock reading without a zone as the instant of UTC, whatever the session's zone: watermarks need an instant."""
    return F.make_timestamp(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.extract(F.lit("SECOND"), C(ts)), F.lit("UTC"))


def distinct_events(events: DataFrame, remember_days: int | None = None) -> DataFrame:
    """The stream without replayed events, told by their id (by all they hold where that is null).

    Without ``remember_days`` every id stays in the state, on the executors' disks; with it, ids older than the
    watermark leave the state, and events older than it are left out.
    """
    e = events.withColumn("_alike", F.when(C("event_id").isNull(), F.xxhash64("profile_id", "event_name", "ts")))
    if remember_days is None:
        return e.dropDuplicates(["event_id", "_alike"]).drop("_alike")
    e = e.withColumn("_at", _instant("ts")).withWatermark("_at", f"{int(remember_days)} days")
    return e.dropDuplicatesWithinWatermark(["event_id", "_alike"]).drop("_alike", "_at")


def _counted(spark: SparkSession, run: str, key: str) -> DeltaLog:
    """Counts by day and ``key``: ``n`` events, the greatest instant, and how many came behind the watermark."""
    def fold(rows: DataFrame, notes: dict) -> DataFrame:
        return rows.groupBy("day", key).agg(F.sum("n").alias("n"), F.max("max_ts").alias("max_ts"), F.sum("late").alias("late"))
    kind = {"profile_id": "bigint", "event_name": "string"}[key]
    return DeltaLog(spark, f"{run}/by-{key}", f"day date, {key} {kind}, n bigint, max_ts timestamp_ntz, late bigint", fold)


def _late_log(spark: SparkSession, run: str) -> DeltaLog:
    return DeltaLog(spark, f"{run}/late", "late_rows bigint, batch bigint", lambda rows, notes: rows)


def _count_events(events: DataFrame, run: str, key: str, lateness_days: int, remember_days: int | None,
                  also: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Drain the stream; (day, key, n, max_ts, late) so far. ``also`` gets the stored counts of each batch."""
    spark = events.sparkSession
    log, late_log = _counted(spark, run, key), _late_log(spark, run)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        mark = log.notes().get("mark")  # of the batches before this one
        behind = F.lit(0).cast("bigint")
        if mark:
            behind = F.count_if(C("ts") < ts_lit(dt.datetime.fromisoformat(mark) - dt.timedelta(days=lateness_days)))
        rows = batch.groupBy(C("ts").cast("date").alias("day"), key).agg(
            F.count(F.lit(1)).alias("n"), F.max("ts").alias("max_ts"), behind.alias("late"))

        def note(stored: DataFrame, notes: dict) -> dict:
            top, late = stored.agg(F.max("max_ts"), F.coalesce(F.sum("late"), F.lit(0))).first()  # one row
            if also:
                also(stored, batch_id)
            marks = [m for m in (top, dt.datetime.fromisoformat(mark) if mark else None) if m is not None]
            return notes | {"late": late} | ({"mark": max(marks).isoformat()} if marks else {})

        log.add(batch_id, rows, note)
        late_log.add(batch_id, spark.createDataFrame([(log.notes()["late"], batch_id)], late_log.schema))

    _drain(distinct_events(events, remember_days), run, on_batch)
    return log.fold(log.read(), {})


def late_rows(spark: SparkSession, run: str) -> DataFrame:
    """(late_rows, batch): how many events of each batch lay behind the watermark when it came, replayed ones left out."""
    return _late_log(spark, run).read()


def compact_feed(spark: SparkSession, run: str) -> None:
    """Fold the counts of a run into one folder, between drains; a run folds them level by level as it goes."""
    for key in ("profile_id", "event_name"):
        _counted(spark, run, key).fold_all()
    _bits(spark, run).fold_all()


# ------------------------------------------------------------------------ ST1
def _bits(spark: SparkSession, run: str) -> DeltaLog:
    """A bit for each profile that opened on a day, in buckets of 32,768 consecutive ids."""
    def fold(rows: DataFrame, notes: dict) -> DataFrame:
        return rows.groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return DeltaLog(spark, f"{run}/bits", "day date, bucket bigint, bits binary", fold)


def drain_opens(spark: SparkSession, events: DataFrame, start: dt.datetime, run_dir: str, remember_days: int | None = None) -> DataFrame:
    """Opens by day and profile, each event once; a batch adds its counts, and its bits for ``unique_profiles``."""
    bits = _bits(spark, run_dir)

    def also(stored: DataFrame, batch_id: int) -> None:
        one = stored.where(C("profile_id").isNotNull()).groupBy("day", F.bitmap_bucket_number("profile_id").alias("bucket"))
        bits.add(batch_id, one.agg(F.bitmap_construct_agg(F.bitmap_bit_position("profile_id")).alias("bits")))

    opens = events.where(~C("deleted") & (C("event_name") == "banner_opened") & (C("ts") >= ts_lit(start)))
    return _count_events(opens, run_dir, "profile_id", 1, remember_days, also)


def daily_openers(spark: SparkSession, events: DataFrame, bridge: DataFrame, start: dt.datetime, run_dir: str | None = None,
                  remember_days: int | None = None) -> DataFrame:
    """ST1: daily unique partners and opens. Opens are counted by profile and day before the join with the bridge as it is now.

    Whole-numbered partners are counted as bits, which combine map-side: no set of (day, partner) is shuffled.
    """
    run = _run_dir(spark, "st1-openers", run_dir)
    per = drain_opens(spark, events, start, run, remember_days).join(bridge, "profile_id", "inner")
    if dict(bridge.dtypes)["partner_id"] not in ("bigint", "int", "smallint", "tinyint"):
        return per.groupBy("day").agg(F.countDistinct("partner_id").alias("partners"), F.sum("n").cast("bigint").alias("opens"))
    by_bucket = per.groupBy("day", F.bitmap_bucket_number("partner_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("partner_id")).alias("bits"), F.sum("n").alias("n"))
    return by_bucket.groupBy("day").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("partners"), F.sum("n").cast("bigint").alias("opens"))


def unique_profiles(spark: SparkSession, run: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """(day, profiles, profiles_to_date): exact unique openers of each day in [start, end), and of all its days so far.

    Both come from the stored bits alone: a day is a few rows, days combine by ``or``.
    """
    log = _bits(spark, run)
    rows = log.fold(log.read(), {})
    if start is not None:
        rows = rows.where(C("day") >= F.lit(start))
    if end is not None:
        rows = rows.where(C("day") < F.lit(end))
    by_day = rows.groupBy("day").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("profiles"))
    later = by_day.select(C("day").alias("until"))  # a row a day on either side
    so_far = rows.join(later, C("day") <= C("until")).groupBy("until", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    so_far = so_far.groupBy(C("until").alias("day")).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("profiles_to_date"))
    return by_day.join(so_far, "day")


# ------------------------------------------------------------------------ ST2
_LEAD = ("connection_id bigint, partner_id bigint, last_state string, rep_attempt_id string, has_installed int, "
         "tech_assigned int, last_date date")
_VALUES = ("last_state", "rep_attempt_id", "has_installed", "tech_assigned", "last_date")


def attempt_rows(attempts: DataFrame) -> DataFrame:
    """The change feed's columns that a lead's state is made of."""
    a = attempts.where(C("active") & C("partner_id").isNotNull())
    return a.select("connection_id", "partner_id", "current_state", "attempt_id", "updated_at",
                    flag(is_installed(True)).alias("has_installed"), flag(C("executor_id").isNotNull()).alias("tech_assigned"))


def _lead_state(rows: DataFrame, offset_minutes: int) -> DataFrame:
    """The lead as it stands, and the months it has been in: an aggregate that a stream keeps by key.

    The same ``max_by`` and ``max`` as the batch collapse. A lead's months are those of its attempts, so a lead that has moved on
    names the months that it may stand in.
    """
    day = local_date(C("updated_at"), offset_minutes)
    g = rows.groupBy("connection_id", "partner_id").agg(
        F.max_by(F.struct(C("current_state").alias("last_state"), C("attempt_id").alias("rep_attempt_id")),
                 F.struct("updated_at", "attempt_id")).alias("l"),
        F.max("has_installed").alias("has_installed"), F.max("tech_assigned").alias("tech_assigned"),
        F.max("updated_at").alias("last_update"), F.collect_set(F.date_format(day, "yyyy-MM")).alias("months"))
    return g.select("connection_id", "partner_id", "l.*", "has_installed", "tech_assigned",
                    local_date(C("last_update"), offset_minutes).alias("last_date"), "months")


def _lead_log(spark: SparkSession, run: str) -> DeltaLog:
    """Leads by month, as each batch has left them; ``gone``: the lead has moved on to a later month.

    A frozen month is held at the batch of its note: rows up to it and behind it are folded apart.
    """
    def fold(rows: DataFrame, notes: dict) -> DataFrame:
        latest = F.max_by(F.struct("gone", *_VALUES, "batch"), "batch").alias("v")
        return rows.groupBy("month", "connection_id", "partner_id", _held(notes).alias("_held")).agg(latest).select(
            "connection_id", "partner_id", *[f"v.{c}" for c in _VALUES], "v.gone", "v.batch", "month")
    return DeltaLog(spark, f"{run}/leads", f"{_LEAD}, gone boolean, batch bigint, month string", fold, by=("month",))


def _held(notes: dict):
    """Whether a row belongs to the held state of a frozen month."""
    held = F.lit(False)
    for month, batch in sorted(notes.get("frozen", {}).items()):
        held = held | ((C("month") == month) & (C("batch") <= batch))
    return held


def _freeze(log: DeltaLog, months: Iterable[str]) -> None:
    """Hold ``months`` at what they are now; a month that is held already stays as it was, others are let go."""
    was = log.notes().get("frozen", {})
    now = {m: was.get(m, log.last()) for m in sorted(set(months))}
    if now != was:
        log.note(frozen=now)


def latest_attempts(spark: SparkSession, attempts: DataFrame, offset_minutes: int = 330, run_dir: str | None = None,
                    frozen: Iterable[str] = (), files_per_month: int = 1) -> DataFrame:
    """ST2: latest state per (connection, partner) from a change feed, upserted into month partitions.

    The stream keeps each lead in RocksDB (the aggregate of ``_lead_state``) and emits the leads that a batch changes, so a batch
    costs what it touches. A changed lead is written to its month, and as gone to the earlier months it has been in.
    ``frozen`` months show what they held when they were frozen first. Returns all leads, frozen months or not.
    ``files_per_month``: how many tasks write a month's rows of a batch.
    """
    run = _run_dir(spark, "st2-latest", run_dir)
    log = _lead_log(spark, run)
    _freeze(log, frozen)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        month = F.date_format("last_date", "yyyy-MM")
        rows = batch.withColumn("month", F.explode("months")).repartition("month", F.pmod("connection_id", F.lit(files_per_month)))
        log.add(batch_id, rows.select("connection_id", "partner_id", *_VALUES, (C("month") != month).alias("gone"),
                                      F.lit(batch_id).cast("bigint").alias("batch"), "month"))

    _drain(_lead_state(attempt_rows(attempts), offset_minutes), run, on_batch, mode="update")
    return log.fold(log.read(), {}).where(~C("gone")).drop("gone", "batch", "month")


def month_of_leads(spark: SparkSession, run: str, month: str) -> DataFrame:
    """One month's leads as the stream has left them, or as they were when the month was frozen; other months aren't read."""
    log = _lead_log(spark, run)
    rows = log.read().where(C("month") == month)
    if (batch := log.notes().get("frozen", {}).get(month)) is not None:
        rows = rows.where(C("batch") <= batch)
    return log.fold(rows, {}).where(~C("gone")).drop("gone", "batch")


def compact_partials(spark: SparkSession, run: str) -> None:
    """Fold the leads of all batches into one folder, between drains; a run folds them level by level as it goes."""
    _lead_log(spark, run).fold_all()


# ------------------------------------------------------------------------ ST3
def event_counts(spark: SparkSession, events: DataFrame, lateness_days: int = 1, run_dir: str | None = None,
                 remember_days: int | None = None) -> DataFrame:
    """ST3: daily counts per event. A day is final once the watermark (latest event minus the allowed lateness) has passed
    its end, otherwise provisional; a later event still corrects it."""
    run = _run_dir(spark, "st3-counts", run_dir)
    rows = _count_events(events, run, "event_name", lateness_days, remember_days)
    # the watermark as a scalar subquery (one value, no join)
    mark = F.timestamp_add("DAY", F.lit(-lateness_days), rows.select(F.max("max_ts")).scalar())
    day_end = F.date_add(C("day"), 1).cast("timestamp_ntz")
    return rows.select("day", "event_name", C("n").alias("events"), (day_end <= mark).alias("final"))


def final_event_counts(spark: SparkSession, events: DataFrame, lateness_days: int = 1, run_dir: str | None = None) -> DataFrame:
    """ST3, closed days only."""
    return event_counts(spark, events, lateness_days, run_dir).where("final").drop("final")


def _daily(events: DataFrame, lateness_days: int) -> DataFrame:
    """Events by day and name as event-time windows, replayed ones left out; the state goes with the watermark."""
    one = events.withColumn("_at", _instant("ts")).withWatermark("_at", f"{int(lateness_days)} days").dropDuplicatesWithinWatermark(["event_id"])
    g = one.groupBy(F.window("_at", "1 day"), "event_name").agg(F.count(F.lit(1)).alias("events"))
    day = F.date_from_unix_date((F.unix_seconds("window.start") / 86400).cast("int"))  # windows begin at midnight UTC
    return g.select(day.alias("day"), "event_name", "events")


def _windows_log(spark: SparkSession, run: str) -> DeltaLog:
    def fold(rows: DataFrame, notes: dict) -> DataFrame:
        return rows.groupBy("day", "event_name").agg(F.max("events").alias("events"))  # a day's count only grows
    return DeltaLog(spark, f"{run}/windows", "day date, event_name string, events bigint", fold)


def closed_days(spark: SparkSession, events: DataFrame, run_dir: str, lateness_days: int = 1) -> DataFrame:
    """ST3 in append mode: a day's counts are emitted once, when the watermark has passed its end, and never change.

    (day, event_name, events) of all days closed so far. Events behind the watermark are left out, as append mode must.
    """
    log = _windows_log(spark, run_dir)
    _drain(_daily(events, lateness_days), run_dir, lambda rows, batch_id: log.add(batch_id, rows))
    return log.read()


def open_days(spark: SparkSession, events: DataFrame, run_dir: str, lateness_days: int = 1) -> DataFrame:
    """ST3 in update mode: the counts of days as they change, for today's view; the last emitted count of each day and event."""
    log = _windows_log(spark, run_dir)
    _drain(_daily(events, lateness_days), run_dir, lambda rows, batch_id: log.add(batch_id, rows), mode="update")
    return log.fold(log.read(), {})
