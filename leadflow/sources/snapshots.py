"""Snapshot sink and source: a folder a month, published by manifest, frozen months, laid out for lookups by key.

A month is written whole into a new folder and becomes visible with a manifest (``versions``): a job that dies before that leaves
the month as it was, and a reader never sees half of one. Which months are frozen (disbursed) stands in the manifest, so
a rebuild is refused whoever asks for it. With each month goes a table of checksums by bucket of the key, free of the rows' order:
two versions are compared by these first, and only buckets that differ are joined.

Rows are dealt by ranges of the key and sorted, in row groups of ``ROW_GROUP`` bytes with a Bloom filter on the key: a lookup reads
one row group (by its bounds), of it the pages that can hold the key, and nothing where the filter rules a key out.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadflow.sources.versions import Conflict, Versions

C = F.col
ROW_GROUP = 8 << 20
#: Buckets of checksums: a few kilobytes a month, whatever its rows.
BUCKETS = 1024


class FrozenMonthError(RuntimeError):
    """A disbursed (closed) month may not be rebuilt."""


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _months(content: dict) -> dict[str, dict]:
    return content.get("months", {})


def frozen_months(spark: SparkSession, path: str) -> set[str]:
    """The months that the sink itself refuses to rebuild."""
    return set(Versions(spark, path).newest()[1].get("frozen", []))


def _publish(versions: Versions, change, tries: int = 10) -> dict:
    """Publish ``change(content)``, again if another writer was faster; what ``change`` raises ends it."""
    while True:
        number, content = versions.newest()
        new = change(content)
        try:
            versions.publish(new, number)
            return new
        except Conflict:
            tries -= 1
            if not tries:
                raise


def freeze(spark: SparkSession, path: str, months: Iterable[str]) -> None:
    """Add to the months that may not be rebuilt; there is no way back but ``thaw``."""
    new = set(months)
    if not new <= frozen_months(spark, path):
        _publish(Versions(spark, path), lambda c: c | {"frozen": sorted({*c.get("frozen", []), *new})})


def thaw(spark: SparkSession, path: str, months: Iterable[str]) -> None:
    """Let months be rebuilt again, on purpose."""
    gone = set(months)
    _publish(Versions(spark, path), lambda c: c | {"frozen": sorted(set(c.get("frozen", [])) - gone)})


def _refuse(month: str, frozen: Iterable[str]) -> None:
    if month in set(frozen):
        raise FrozenMonthError(f"month {month} is frozen (disbursed); refusing to rebuild it")


def write_month(df: DataFrame, path: str, month: str, frozen: Iterable[str] = (), key: str = "partner_id", only_if_changed: bool = False) -> bool:
    """Publish ``month``'s rows; other months stay untouched. Returns whether a new version was published.

    Raises FrozenMonthError before any write if the month is frozen in the sink or in ``frozen``; the latter's months are
    frozen in the sink from now on. With ``only_if_changed`` a month that equals the published one isn't published again.
    """
    spark = df.sparkSession
    versions = Versions(spark, path)
    frozen = set(frozen)
    _refuse(month, frozen | frozen_months(spark, path))
    name, digest = versions.new_name(month), versions.new_name(f"digest-{month}")
    _lay_out(df, key).parquet(versions.folder(name))
    stored = spark.read.schema(df.schema).parquet(versions.folder(name))
    digests(stored, key).coalesce(1).write.parquet(versions.folder(digest))
    if only_if_changed and (was := _months(versions.newest()[1]).get(month)) is not None:
        old = spark.read.parquet(versions.folder(was["digest"]))
        if was["schema"] == df.schema.json() and not differing(old, spark.read.parquet(versions.folder(digest))):
            freeze(spark, path, frozen)
            return False  # the folders that were just written go with a later sweep

    def change(content: dict) -> dict:
        _refuse(month, content.get("frozen", []))  # frozen while this job ran
        entry = {"name": name, "digest": digest, "schema": df.schema.json(), "key": key}
        return content | {"months": _months(content) | {month: entry}, "frozen": sorted({*content.get("frozen", []), *frozen})}

    _publish(versions, change)
    versions.sweep()
    return True


def _lay_out(df: DataFrame, key: str):
    """A writer of the rows in ranges of the key, sorted, with what a reader of one key needs."""
    rows = df.repartitionByRange(key).sortWithinPartitions(key)
    return (rows.write.option("parquet.block.size", ROW_GROUP).option(f"parquet.bloom.filter.enabled#{key}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true"))


def _stored(spark: SparkSession, versions: Versions, entry: dict) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(versions.folder(entry["name"]))


def read_month(spark: SparkSession, path: str, month: str | None, default: str) -> DataFrame:
    """One month's snapshot, no other is touched; an unknown or missing month falls back to ``default``."""
    versions = Versions(spark, path)
    have = _months(versions.newest()[1])
    pick = month if month in have else default
    if pick not in have:
        raise ValueError(f"{path} has neither month {month} nor {default}")
    return _stored(spark, versions, have[pick]).withColumn("month", F.lit(pick))


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """All published months, one under the other."""
    versions = Versions(spark, path)
    out = None
    for month, entry in sorted(_months(versions.newest()[1]).items()):
        one = _stored(spark, versions, entry).withColumn("month", F.lit(month))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"{path} has no month")
    return out


def find(spark: SparkSession, path: str, month: str | None, default: str, ids: Sequence) -> DataFrame:
    """The rows of a few keys of a month; the keys reach the Parquet reader."""
    versions = Versions(spark, path)
    have = _months(versions.newest()[1])
    key = have.get(month, have.get(default, {})).get("key", "partner_id")
    return read_month(spark, path, month, default).where(C(key).isin(list(ids)))


# ------------------------------------------------------------- change detection
def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def digests(df: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """(bucket, rows, a, b): counts and two sums over hashes of the rows, whatever their order; NULL differs from any value."""
    cols = sorted(df.columns if cols is None else {key, *cols})
    values = [x for c in cols for x in (C(c), C(c).isNull())]
    return df.groupBy(_bucket(key).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*values)).alias("a"),
        F.sum(F.xxhash64(F.lit("b"), *values).cast("decimal(28,0)")).alias("b"))


def differing(old: DataFrame, new: DataFrame) -> list[int]:
    """The buckets whose checksums differ; at most ``BUCKETS`` rows come to the driver."""
    both = old.select("bucket", F.struct("rows", "a", "b").alias("o")).join(new.select("bucket", F.struct("rows", "a", "b").alias("n")), "bucket", "full_outer")
    return [r["bucket"] for r in both.where(~C("o").eqNullSafe(C("n"))).select("bucket").collect()]


def changed(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str], old_digests: DataFrame | None = None,
            new_digests: DataFrame | None = None) -> DataFrame:
    """K3: (key, kind) of the rows that were added, removed or changed; only rows of buckets that differ are joined.

    Pass stored checksums (over the same columns) where there are some; versions that are equal need no join at all.
    """
    from leadflow.operators.snapshot import null_safe_diff

    found = differing(old_digests if old_digests is not None else digests(old, key, cols), new_digests if new_digests is not None else digests(new, key, cols))
    if not found:
        return new.select(key, F.lit("changed").alias("kind")).limit(0)
    if len(found) < BUCKETS:
        old, new = old.where(_bucket(key).isin(found)), new.where(_bucket(key).isin(found))
    return null_safe_diff(old, new, key, cols)


def changed_between(spark: SparkSession, path: str, old: str, new: str, cols: Sequence[str] | None = None) -> DataFrame:
    """K3 between two published months, by their stored checksums; ``cols``: what counts (all columns)."""
    versions = Versions(spark, path)
    have = _months(versions.newest()[1])
    a, b = have[old], have[new]
    key = b["key"]
    o, n = _stored(spark, versions, a), _stored(spark, versions, b)
    every = set(o.columns) == set(n.columns) and (cols is None or {key, *cols} == set(n.columns))
    use = [c for c in n.columns if c != key] if cols is None else list(cols)
    stored = [spark.read.parquet(versions.folder(x["digest"])) if every else None for x in (a, b)]
    return changed(o, n, key, use, *stored)
