"""Join helpers: existence flags and zero-filled left joins. Broadcasts are left to Spark's threshold and AQE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_flag(df: DataFrame, keys: DataFrame, on: str | Sequence[str], name: str) -> DataFrame:
    """Add boolean ``name``: the row's key exists in ``keys``.

    Written as a correlated EXISTS, which Catalyst plans as one existence join: rows never
    fan out, and a NULL key is False. The key side is first reduced by a distinct, which is
    combined map-side (a key repeated in a third of the log costs one row per task) and
    leaves the data hash-partitioned on the key, so the join adds no second exchange.
    """
    on = [on] if isinstance(on, str) else list(on)
    left = df.alias("_fl")
    right = keys.select(*on).distinct().alias("_fr")
    cond = None
    for c in on:
        eq = F.col(f"_fr.{c}") == F.col(f"_fl.{c}").outer()
        cond = eq if cond is None else cond & eq
    return left.withColumn(name, right.where(cond).exists())


def left_fill(left: DataFrame, right: DataFrame, on: str | Sequence[str], cols: Sequence[str], fill=0) -> DataFrame:
    """Left join keeping every left row; missing right values become ``fill``."""
    out = left.join(right, on, "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(fill)))
    return out


def heavy_keys(df: DataFrame, key: str, share: float, tracked: int = 4096) -> dict:
    """Keys that hold at least about ``share`` of the rows: {key: its share}, from one pass with a sketch of frequent items.

    The sketch keeps ``tracked`` counters a task and merges them, so nothing is shuffled by key; at most ``1 / share`` keys come
    to the driver. Its counts may be off by a part of 1 / tracked, which only makes the salt of a key coarser or finer.
    """
    most = max(1, min(tracked // 2, int(1 / share)))
    r = df.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {x["item"]: x["count"] / r["n"] for x in r["top"] or [] if x["count"] >= share * r["n"]}


def salted_join(rows: DataFrame, side: DataFrame, key: str, heavy: dict, partitions: int, per_partition: float = 0.125) -> DataFrame:
    """Inner join of skewed ``rows`` with ``side`` on ``key``, where ``heavy`` keys are dealt to many partitions.

    A heavy key gets so many salts that each holds ``per_partition`` of what a partition holds on average; ``side``'s rows of
    the key are repeated as often, all others once. A row's salt is a hash of its columns and its place in the scan, so that equal rows
    spread as well. It doesn't depend on AQE, which splits only what a shuffle has written to one partition.
    """
    if not heavy:
        return rows.join(side, key, "inner")
    salts = {k: max(2, min(65_536, round(part * partitions / per_partition))) for k, part in heavy.items()}
    kind = rows.schema[key].dataType
    pairs = [x for k, n in salts.items() for x in (F.lit(k).cast(kind), F.lit(n))]
    n_of = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(key)), F.lit(1))
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    left = placed.withColumn("_salt", F.pmod(F.xxhash64("_row", key), n_of)).drop("_row")
    right = side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (n_of - 1).cast("bigint"))))
    return left.join(right, [key, "_salt"], "inner").drop("_salt")
