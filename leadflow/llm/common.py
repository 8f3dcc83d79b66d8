"""Helpers of the llm operators: canonical input columns, scratch tables, vectorised text hashing, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A row without an id counts as one document with this id, which sorts after all others.
NO_ID = (1 << 63) - 1
_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); a temporary one on a local master only."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    return _LOCAL[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


#: Spark's own setting: shuffle files of a job go when it ends, and not only once the driver's memory is cleaned.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows go to Python in batches of about so many bytes, unless the session says how many. Spark's 10,000 rows are some 20 MB of
#: texts, twice that for pairs, which each task's JVM side and worker hold and keep.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 22


def store(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    ``free`` gives the disk of the job's shuffles back as soon as the table is written; nothing reads them afterwards.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    was, batch = spark.conf.get(_FREE, None), spark.conf.get(_BATCH, None)
    if free:
        spark.conf.set(_FREE, "true")
    if batch is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.unset(_FREE) if was is None else spark.conf.set(_FREE, was)
        if batch is None:
            spark.conf.unset(_BATCH)
    return spark.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of ``schema``. ``createDataFrame`` would have Python workers make them, of another kind than those that UDFs run in."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once for each application, wherever the driver runs."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}-code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``_id`` (long; ``NO_ID`` for null) and ``_text`` ('' for null); other columns, whatever their names, stay out."""
    return docs.select(
        F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text")
    )


def public_id(name: str = "_id", out: str = "doc_id"):
    """The id column of a result: null again for ``NO_ID``."""
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(out)


def crc_mod(id_col, n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


# --- text as bytes -----------------------------------------------------------------------------------------------------

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xBF58476D1CE4E5B9)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (finaliser with two multiplications)."""
    x = (x ^ (x >> np.uint64(31))) * _MUL
    x = (x ^ (x >> np.uint64(29))) * _MUL2
    return x ^ (x >> np.uint64(32))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column without nulls, and the n+1 offsets of its rows, without a copy of each row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return body, at - at[0]


_POW: dict[int, np.ndarray] = {}
_BASE = 0x5851F42D4C957F2D | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        _POW[base] = have
    return have[:n]


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans hash alike wherever they stand."""
    sums = np.zeros(len(body) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(body)), out=sums[1:])
        value = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(body) + 1)[starts]
        return mix64(value + (ends - starts).astype(np.uint64) * _MUL2)


def gram_hashes(body: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each string of ``size`` bytes."""
    sums = np.zeros(len(body) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(body)), out=sums[1:])
        value = sums[size:]
        value = value - sums[: len(value)]
        value *= _powers(_BASE_INVERSE, len(value))
        return mix64(value)


#: The bytes that separate words: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, n+1 row offsets into them) of the white-space separated words of each row."""
    n = len(body)
    gap = SPACE[body]
    inside = ~gap
    begins = inside.copy()
    begins[1:] &= gap[:-1]
    edge = offsets[1:-1][offsets[1:-1] < n]
    begins[edge] = inside[edge]
    stops = np.empty(n, bool)
    if n:
        stops[-1] = inside[-1]
        stops[:-1] = inside[:-1] & (gap[1:] | begins[1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(body: np.ndarray, offsets: np.ndarray, block: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each white-space separated word, ASCII case folded; n+1 row offsets into them); hashed block by block."""
    starts, ends, rows = word_spans(body, offsets)
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + block)))
        first = starts[low]
        out[low:high] = span_hashes(LOWER[body[first : ends[high - 1]]], starts[low:high] - first, ends[low:high] - first)
        low = high
    return out, rows


def chunks(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Slices of a batch whose texts hold about ``most`` bytes; a longer text makes a slice of its own."""
    _, at = text_bytes(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


# --- connected components ----------------------------------------------------------------------------------------------


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (src, dst) lead to.

    Large stars and small stars in turn: a node's larger neighbours are linked with its smallest one instead, then its smaller
    ones, until all links are stars about the components' smallest nodes. Links that come to the same are one, so there are soon no
    more of them than nodes. The joins have a stored table on either side, so that AQE can split a node of many links.
    """
    stars = links.filter(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    stars = store(stars.distinct(), "links", free=True)
    while True:
        both = stars.select("src", "dst").union(stars.select(F.col("dst"), F.col("src")))
        low = store(both.groupBy(F.col("src").alias("at")).agg(F.least(F.min("dst"), F.col("src")).alias("low")), "lows", free=True)
        # a link is read at its smaller end
        large = stars.join(low, stars["dst"] == low["at"]).select("src", F.col("low").alias("dst"))
        large = store(large.distinct(), "links", free=True)
        low = store(large.groupBy(F.col("src").alias("at")).agg(F.min("dst").alias("low")), "lows", free=True)
        small = large.join(low, large["src"] == low["at"]).filter(F.col("dst") != F.col("low")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        new = store(small.union(low.select(F.col("at").alias("src"), F.col("low").alias("dst"))).distinct(), "links", free=True)
        still = new.count() == stars.count() and not new.join(stars, ["src", "dst"], "left_anti").limit(1).count()
        stars = new
        if still:
            break
    found = stars.select(F.col("src").alias("at"), F.col("dst").alias("component"))
    return nodes.select("node").join(found, F.col("node") == F.col("at"), "left").select("node", F.coalesce("component", "node").alias("component"))
