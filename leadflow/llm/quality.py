"""Quality classifier (operator 1): hashed word n-gram logistic regression, trained with FTRL, scored as sparse dot products.

A text is read as runs of letters, digits and other signs. Two streams of n-grams are hashed into one table: runs folded to
lower case (1- and 2-grams), and their shapes (1- to 3-grams): kind, case of the first and last letter, whether a blank stands
before, whether it is the same run again, and for other signs the run itself. A gram's value is its share of the stream, so long and short texts score alike.

Labels come from a bounded sample (``sample`` rows, chosen by a hash of the id), split among ``learners`` tasks whose weights
are averaged; the weight table has ``2 ** bits`` rows whatever the input. Scoring reads every text once and shuffles nothing.

Null and empty texts score as the bias does. Without labelled rows every score is 0.5. Ids with several labels take their
mean, and none where it is 0.5; null labels don't count. Repeated rows are scored each; a null id is scored, never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm.ftrl import fit, sampled

BITS = 18
SAMPLE = 12_000
LEARNERS = 6
#: Bytes of text whose grams a worker holds at a time (some 100 bytes each).
CHUNK = 1 << 18

#: Kind of a byte: 0 white space, 1 letter (or part of one), 2 digit, 3 other sign.
_KIND = np.full(256, 3, np.uint8)
_KIND[list(range(33))] = 0
_KIND[list(range(48, 58))] = 2
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER = np.zeros(256, np.uint8)
_UPPER[65:91] = 1


def _grams(codes: np.ndarray, rows: np.ndarray, orders: int, seed: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coordinate, value, n+1 row offsets) of the 1- to ``orders``-grams; one order after the other within the array."""
    parts, owner = [], []
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    left = np.zeros(0, np.uint64)
    for k in range(orders):
        if len(codes) <= k:
            break
        left = C.mix64(codes + np.uint64(seed)) if k == 0 else C.mix64(left[:-1] * np.uint64(31) + codes[k:])
        same = row[k:] == row[: len(row) - k]
        parts.append((left >> np.uint64(64 - bits))[same])
        owner.append(row[k:][same])
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    at, own = np.concatenate(parts).astype(np.int64), np.concatenate(owner)
    total = np.bincount(own, minlength=len(rows) - 1)
    return at, 1.0 / total[own], own


def features(body: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coordinate, value, row) of every gram of some texts."""
    kind = _KIND[body]
    first = np.ones(len(body), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[offsets[:-1][offsets[:-1] < len(body)]] = True
    edge = np.flatnonzero(first)
    ends = np.append(edge[1:], len(body))[kind[edge] > 0]
    starts = edge[kind[edge] > 0]
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    words = C.span_hashes(C.LOWER[body], starts, ends)
    before = kind[np.maximum(starts - 1, 0)] == 0
    before |= np.isin(starts, offsets)  # a text begins as if behind a blank
    shape = kind[starts] + 4 * _UPPER[body[starts]] + 8 * _UPPER[body[ends - 1]] + 16 * before.astype(np.uint64)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[rows[:-1][rows[:-1] < len(words)]] = False
    shape = shape.astype(np.uint64) + np.uint64(32) * again + np.where(kind[starts] == 3, words << np.uint64(8), np.uint64(0))
    a = _grams(words, rows, 2, 1, bits)
    b = _grams(shape, rows, 3, 2, bits)
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS, epochs: int = 3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **rates) -> np.ndarray:
    """Weight table (2 ** bits + 1 with the bias last) learned from the labelled documents given."""
    known = labels.select(labels[id_col].cast("long").alias("_id"), labels[label_col].alias("_label")).dropna()
    known = known.groupBy("_id").agg(F.avg("_label").alias("_label")).filter(F.col("_label") != 0.5)
    known = known.select("_id", (F.col("_label") > 0.5).cast("int").alias("label"))
    rows = known.count()
    texts = sampled(C.id_and_text(docs, id_col, text_col).filter(F.col("_id") != C.NO_ID), "_id", rows, sample)
    both = texts.join(sampled(known, "_id", rows, sample), "_id").withColumn("shard", F.pmod(F.xxhash64("_id"), F.lit(LEARNERS)).cast("int"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, "_text", CHUNK):
                at, value, own = features(*C.text_bytes(part.column("_text")), bits)
                out_at, out_value = [], []
                order = np.lexsort((at, own))
                at, value, own = at[order], value[order], own[order]
                cut = np.searchsorted(own, np.arange(part.num_rows + 1))
                for i in range(part.num_rows):
                    u, inverse = np.unique(at[cut[i] : cut[i + 1]], return_inverse=True)
                    out_at.append(u.astype(np.int32))
                    out_value.append(np.bincount(inverse, value[cut[i] : cut[i + 1]], len(u)).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("shard"), part.column("label"), pa.array(out_at, pa.list_(pa.int32())), pa.array(out_value, pa.list_(pa.float32()))],
                    ["shard", "label", "at", "value"],
                )

    sparse = both.select("shard", "label", "_text").mapInArrow(read, "shard int, label int, at array<int>, value array<float>")
    return fit(sparse, 1 << bits, 1, epochs, **({"alpha": 3.0, "l1": 0.0, "l2": 0.0} | rates))[:, 0]


def scorer(spark: SparkSession, weights: np.ndarray):
    """A function of a text column without nulls: its score. The table of weights, of fixed size, is broadcast."""
    bits = (len(weights) - 1).bit_length() - 1
    table = spark.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        w, out = table.value, [np.zeros(0)]
        for part in C.chunks(pa.RecordBatch.from_arrays([texts], ["_text"]), "_text", CHUNK):
            at, value, own = features(*C.text_bytes(part.column("_text")), bits)
            margin = np.bincount(own, w[at] * value, part.num_rows) + w[-1]
            out.append(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
        return pa.array(np.concatenate(out), pa.float64())

    return score


def accepted(docs: DataFrame, weights: np.ndarray, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with their columns."""
    return docs.filter(scorer(docs.sparkSession, weights)(F.coalesce(docs[text_col], F.lit(""))) >= least)
