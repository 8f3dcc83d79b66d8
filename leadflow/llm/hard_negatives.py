"""Hard-negative mining (operator 12): Fagin's threshold algorithm over per-dimension sorted lists, scored in integers.

A component x counts as floor(256 x), a score is the integer inner product of two rows. For each anchor (``anchor_every``: a row
whose id is divisible by it) the ``positives`` best rows of its label are found, then for each of these the ``negatives`` best rows
of other labels whose score lies in the window [low, high] hundredths of the positive's score.

Rows are dealt by ranges of (length of the vector, label, hash) and stored; a batch of them is a block. In a block each dimension
has its rows sorted by their component. An anchor reads all lists at once, each from the end that its own component's sign
makes the better one, ``FIRST`` rows deep and then twice as deep each time; a row seen for the first time is scored (random
access). No unseen row can score above the threshold, the inner product of the anchor with the components next to read. An
anchor leaves a block once the threshold lies strictly below the k-th score of each of its windows, found in this block or in
earlier ones of the task, or below the window itself; so ties at the k-th score are all seen, and the smaller id wins.

Anchors go to the tasks in chunks of ``CHUNK_BYTES``, one after the other, each chunk against all rows; a task gives back
at most k rows for each window.

Rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of different lengths are never
compared. Rows that repeat id, label and vector are one row; other rows of the anchor's own id are no candidates; a null id
is no anchor, sorts last and is returned as null. Scores are exact; those beyond 64 bits count as the greatest or least long
once they are stored. A positive score below 0 has an empty window. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadflow.llm import common as C

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
CHUNK_BYTES = 16 << 20
BLOCK = 4096
FIRST = 64
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
#: Sums below it, and a hundred times as much, are whole in doubles.
_EXACT = 2.0**46
_FOUND = "anchor int, window int, _id long, score long"


def whole_rows(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(_id, label, dim, q) of the rows that take part; q: the components as packed whole doubles."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, dims = [], []
            for v in batch.column("v").to_pylist():
                q = np.floor(256.0 * np.asarray(v, np.float64)) + 0.0  # no negative zero
                packed.append(q.tobytes())
                dims.append(len(q))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], ["_id", "label", "dim", "q"])

    given = rows.select(
        F.coalesce(rows[id_col].cast("long"), F.lit(C.NO_ID)).alias("_id"), rows[label_col].cast("long").alias("label"), rows[vector_col].cast("array<double>").alias("v"))
    fit = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > 7e305))
    return given.filter(fit).mapInArrow(read, "_id long, label long, dim int, q binary")


def dealt(rows: DataFrame) -> DataFrame:
    """The different rows by ranges of (dim, label, hash), stored; a label may fill many ranges, equal vectors too."""
    one = rows.distinct().withColumn("_deal", F.xxhash64("_id", "q"))
    return C.store(one.repartitionByRange("dim", "label", "_deal").sortWithinPartitions("dim", "label", "_deal").drop("_deal"), "vectors")


class Block:
    """Rows of one vector length with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, self.order, axis=0)
        self.reach = np.abs(x).max(initial=0.0)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products: doubles while all sums stay whole in them, Python's integers beyond."""
        if self.reach * np.abs(anchor).max(initial=0.0) * max(1, len(anchor)) < _EXACT:
            return self.x[rows] @ anchor
        return np.array([sum(int(a) * int(b) for a, b in zip(r, anchor, strict=True)) for r in self.x[rows]], object)

    def threshold(self, anchor: np.ndarray, depth: int):
        """The most that a row can score whose places in all lists lie at ``depth`` or behind."""
        last = np.where(anchor > 0, self.sorted[len(self.ids) - 1 - depth], self.sorted[depth])
        if self.reach * np.abs(anchor).max(initial=0.0) * max(1, len(anchor)) < _EXACT:
            return float(last @ anchor)
        return sum(int(a) * int(b) for a, b in zip(last, anchor, strict=True))


def _as_double(value: int) -> float:
    """A bound for scores of less than 2^53 hundredths: larger ones only need to stay larger."""
    return float(max(-(1 << 60), min(1 << 60, value)))


class Windows:
    """The k best of each of an anchor's windows: whole scores from ``low`` to ``high`` hundredths of ``of``, or any."""

    def __init__(self, k: int, bounds: list[tuple[int, int] | None]):
        self.k, self.bounds = k, bounds
        self.best: list[list[tuple[int, int]]] = [[] for _ in bounds]  # (-score, id), best first

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        whole = scores.dtype == object
        for w, bound in enumerate(self.bounds):
            best = self.best[w]
            fits = np.ones(len(scores), bool)
            if bound is not None:
                low, high = bound if whole else map(_as_double, bound)
                fits &= (100 * scores >= low) & (100 * scores <= high)
            if len(best) == self.k:
                fits &= scores >= (-best[-1][0] if whole else _as_double(-best[-1][0]))
            at = np.flatnonzero(fits)
            if len(at) > 2 * self.k and not whole:  # ties at the k-th score stay
                kth = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
                at = at[scores[at] >= kth]
                if len(at) > 2 * self.k:
                    at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
            if len(at):
                self.best[w] = sorted([*best, *((-int(scores[i]), int(ids[i])) for i in at)])[: self.k]

    def over(self, threshold) -> bool:
        """Whether no row that scores at most ``threshold`` can still come in."""
        for bound, best in zip(self.bounds, self.best, strict=True):
            out = bound is not None and (bound[0] > bound[1] or 100 * threshold < bound[0])
            if not out and not (len(best) == self.k and threshold < -best[-1][0]):
                return False
        return True


def visit(block: Block, anchor: np.ndarray, own_id: int, mine: np.ndarray, windows: Windows) -> int:
    """Threshold algorithm of one anchor in one block; ``mine``: the rows that may count. Returns how many were scored."""
    n, up, down = len(block.ids), np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    seen = ~mine  # rows that don't count need no score
    seen |= block.ids == own_id
    depth, done, scored = 0, False, 0
    while not done:
        if depth < n and not windows.over(block.threshold(anchor, depth)):
            stop = min(n, max(FIRST, 2 * depth))
            new = np.zeros(n, bool)
            new[block.order[n - stop : n - depth, up]] = True
            new[block.order[depth:stop, down]] = True
            depth = stop
        elif depth < n:
            break
        else:  # whoever is in no list: an anchor of zeros, a vector without components
            new, done = np.ones(n, bool), True
        new &= ~seen
        at = np.flatnonzero(new)
        if len(at):
            seen |= new
            scored += len(at)
            windows.add(block.scores(at, anchor), block.ids[at])
    return scored


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for whole in batches:
        for low in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(low, BLOCK)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                x = np.frombuffer(b"".join(part.column("q").to_pylist()), np.float64).reshape(len(at), int(dim))
                yield Block(part.column("_id").to_numpy(), part.column("label").to_numpy(), x)


def mined(rows: DataFrame, anchors: list[tuple[int, int, bytes]], bounds: list[list[tuple[int, int] | None]], k: int, same: bool) -> DataFrame:
    """(anchor, window, _id, score): the k best of a task for each window of the anchors (id, label, packed vector).

    ``same``: rows of the anchor's label, else of all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = [np.frombuffer(q, np.float64) for _, _, q in anchors]
        windows: list[Windows | None] = [None] * len(anchors)
        by_key: dict[tuple[int, int], list[int]] = {}
        for i, (_, label, _) in enumerate(anchors):
            if bounds[i]:
                by_key.setdefault((len(vectors[i]), label), []).append(i)
        for block in _blocks(batches):
            dim, labels = block.x.shape[1], np.unique(block.labels)
            for label in labels.tolist() if same else {x for d, x in by_key if d == dim}:
                asking = by_key.get((dim, label), [])
                mine = block.labels == label
                if not same:
                    mine = ~mine
                if not asking or not mine.any():
                    continue
                part = block
                if not mine.all() and (same or mine.sum() < len(mine) // 2):  # lists of these rows alone
                    part = Block(block.ids[mine], block.labels[mine], block.x[mine])
                    mine = np.ones(len(part.ids), bool)
                for i in asking:
                    if windows[i] is None:
                        windows[i] = Windows(k, bounds[i])
                    visit(part, vectors[i], anchors[i][0], mine, windows[i])
        for i, found in enumerate(windows):
            out = [(i, w, row, min(max(-s, _LEAST), _MOST)) for w, best in enumerate(found.best if found else []) for s, row in best]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor", "window", "_id", "score"])

    return rows.mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc("_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ids as ``NO_ID`` where null."""
    spark = rows.sparkSession
    known = dealt(whole_rows(rows, id_col, vector_col, label_col))
    chosen = known.filter((F.col("_id") != C.NO_ID) & (F.col("_id") % anchor_every == 0))
    size = chosen.agg(F.sum(F.length("q") + 64).alias("b")).first()["b"] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    out = []
    for chunk in range(chunks):
        anchors = [(r["_id"], r["label"], bytes(r["q"])) for r in chosen.filter(F.pmod(F.xxhash64("_id", "q"), F.lit(chunks)) == chunk).collect()]  # about CHUNK_BYTES
        if anchors:
            out.append(_chunk(spark, known, anchors, positives, negatives, low, high))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, out)


def _chunk(spark: SparkSession, known: DataFrame, anchors: list[tuple[int, int, bytes]], positives: int, negatives: int, low: int, high: int) -> DataFrame:
    pairs = C.store(_best(mined(known, anchors, [[None]] * len(anchors), positives, True), positives), "positives")
    scores: list[list[int]] = [[] for _ in anchors]
    for r in pairs.select("anchor", "score").distinct().collect():  # at most ``positives`` rows an anchor of the chunk
        scores[r["anchor"]].append(r["score"])
    for own in scores:
        own.sort()
    found = mined(known, anchors, [[(low * s, high * s) for s in own] for own in scores], negatives, False)
    found = C.store(_best(found, negatives), "negatives")
    windows = spark.createDataFrame([(i, anchors[i][0], w, s) for i, own in enumerate(scores) for w, s in enumerate(own)], "anchor int, anchor_id long, window int, positive_score long")
    asked = pairs.select("anchor", F.col("_id").alias("positive_id"), F.col("score").alias("positive_score")).join(windows, ["anchor", "positive_score"])
    hits = found.select("anchor", "window", "rank", F.col("_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return asked.join(hits, ["anchor", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
