"""Embedding near-dedup (operator 2): an inverted multi-index over unit vectors, verified by their cosines in doubles.

Each half of a vector has its own codebook; the product of the two is a grid of cells. A vector lives in the cell of its two
nearest codewords and looks for neighbours in the nearest cells of the grid, visited in order of the summed squared distances
by the multi-sequence algorithm, as many as a calibration says. The calibration compares ``queries`` vectors with all rows by
brute force (a bounded set of queries, in blocks) and counts at which place of the traversal their neighbours live, other
vectors than the query itself; each query that has neighbours weighs alike. Where fewer than ``SEEN`` queries have some, all
vectors of the sample are queries; where these are too few as well, nothing is known, and every cell is probed that can hold
a neighbour. In any case cells too far away for one, by the distance to the bisector of two codewords, are left out.

Codebooks come from a bounded sample (``sample`` vectors, chosen by a hash of the vector); the number of codewords grows with the
root of the rows, so that a cell's share stays alike. Equal vectors of a label are one class with a weight. A cell's members
and its probing vectors are dealt into blocks of a bounded number of rows; a task multiplies two blocks and gives back one
row for each vector: how many it links with, and the smallest id of its group of links within the two blocks. So no list of
pairs is ever made, and a hot cell is many pairs of blocks.

Vectors that are null, zero or hold null or non-finite components, and those without a label, link with nothing: 0 links, their
own component. Vectors of another length are compared among themselves. Rows that repeat id, label and vector are one
vector; a null id sorts last.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm import common as C

THRESHOLD = 0.93
RECALL = 0.999
SAMPLE = 8192
QUERIES = 512
#: Queries with neighbours that a calibration needs.
SEEN = 256
BLOCK = 1024
CELL_ROWS = 2000


def unit_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(_id, label, dim, unit): unit vectors as packed doubles; null where a vector can't link with any."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = [], []
            for v, label in zip(batch.column("v").to_pylist(), batch.column("label").to_pylist(), strict=True):
                x = None if v is None or label is None or None in v else np.asarray(v, np.float64)
                if x is not None and len(x) and np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                    x = x / top  # so that the norm neither overflows nor vanishes
                    units.append((x / np.sqrt(x @ x) + 0.0).tobytes())
                    dims.append(len(x))
                else:
                    units.append(None)
                    dims.append(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], ["_id", "label", "dim", "unit"]
            )

    given = rows.select(
        F.coalesce(rows[id_col].cast("long"), F.lit(C.NO_ID)).alias("_id"), rows[label_col].cast("string").alias("label"), rows[vector_col].cast("array<double>").alias("v")
    )
    return given.mapInArrow(read, "_id long, label string, dim int, unit binary").distinct()


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Codewords of a bounded sample; at most as many as it has different rows."""
    x = np.unique(x, axis=0)
    words = x[np.random.default_rng(7).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = distances(x, words).argmin(axis=1)
        words = np.array([x[near == j].mean(axis=0) if (near == j).any() else words[j] for j in range(len(words))])
    return words


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ words.T + (words * words).sum(axis=1)


def multi_sequence(a: np.ndarray, b: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cells (i, j) by rising a[i] + b[j], the first ``most`` of them, without sorting the grid."""
    p, q = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    heap, seen = [(a[p[0]] + b[q[0]], 0, 0)], {(0, 0)}
    for _ in range(min(most, len(a) * len(b))):
        _, i, j = heapq.heappop(heap)
        yield int(p[i]), int(q[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(p) and y < len(q) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (a[p[x]] + b[q[y]], x, y))


def places_of(a: np.ndarray, b: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The place of each cell in the order of ``multi_sequence``, behind those of equal sums, without making the grid."""
    some, back = np.unique(cells, return_inverse=True)
    rising = np.sort(b)
    sums = a[some // len(b)] + b[some % len(b)]
    return np.array([int(np.searchsorted(rising, t - a + 1e-12, "right").sum()) - 1 for t in sums], np.int64)[back]


def cells_within(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """The cells (as i * len(b) + j) with a[i] + b[j] <= most, at the cost of their number."""
    order = np.argsort(b, kind="stable")
    many = np.searchsorted(b[order], most - a, "right")
    row = np.repeat(np.arange(len(a)), many)
    return row * len(b) + order[np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]


class Index:
    """The two codebooks of each vector length; lengths that the sample lacks have one cell."""

    def __init__(self, sample: list[np.ndarray], words: int):
        by_dim: dict[int, list[np.ndarray]] = {}
        for v in sample:
            by_dim.setdefault(len(v), []).append(v)
        self.books = {d: (kmeans(np.array(x)[:, : d // 2], words), kmeans(np.array(x)[:, d // 2 :], words)) for d, x in by_dim.items() if d > 1}

    def halves(self, dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if dim not in self.books:
            return np.zeros((len(x), 1)), np.zeros((len(x), 1))
        a, b = self.books[dim]
        return distances(x[:, : dim // 2], a), distances(x[:, dim // 2 :], b)

    def least(self, dim: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower bounds of the squared distances from vectors, whose halves are given, to any vector of each codeword."""
        if dim not in self.books:
            return np.zeros(a.shape), np.zeros(b.shape)
        return tuple(_beyond(x, words) for x, words in zip((a, b), self.books[dim], strict=True))


def _beyond(near: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distance to the half space nearer to each codeword than to the nearest one."""
    own = near.argmin(axis=1)
    apart = np.sqrt(np.maximum(distances(words, words), 0))[own]
    return np.divide(near - near[np.arange(len(near)), own][:, None], 2 * apart, out=np.zeros_like(near), where=apart > 1e-9) ** 2


def matrix(column) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


def calibrated(classes: DataFrame, index: Index, queries: list[tuple[str, np.ndarray]], threshold: float, recall: float) -> int | None:
    """How many cells hold ``recall`` of the other neighbours of a query, by brute force against all classes; None if too few have any."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast((index, queries))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, queries = shared.value
        asked: dict[int, dict[str, list[int]]] = {}
        for k, (label, q) in enumerate(queries):
            asked.setdefault(len(q), {}).setdefault(label, []).append(k)
        orders: dict[int, np.ndarray] = {}
        for whole in batches:
            for dim, batch in by_dim(whole):
                x, labels = matrix(batch.column("unit")), np.array(batch.column("label").to_pylist(), object)
                a, b = index.halves(dim, x)
                cell = a.argmin(axis=1) * b.shape[1] + b.argmin(axis=1)
                who, places = [], []
                for label, ks in asked.get(dim, {}).items():
                    mine = np.flatnonzero(labels == label)
                    for low in range(0, len(ks), BLOCK):
                        part = ks[low : low + BLOCK]
                        near = x[mine] @ np.array([queries[k][1] for k in part]).T >= threshold
                        for c in np.flatnonzero(near.any(axis=0)):
                            k, rows = part[c], mine[near[:, c]]
                            rows = rows[(x[rows] != queries[k][1]).any(axis=1)]  # not the query itself
                            if not len(rows):
                                continue
                            if k not in orders:
                                orders[k] = [x[0] for x in index.halves(dim, queries[k][1][None])]
                            who += [k] * len(rows)
                            places += places_of(*orders[k], cell[rows]).tolist()
                yield pa.RecordBatch.from_pydict({"query": pa.array(who, pa.int32()), "place": pa.array(places, pa.int32())})

    found = C.store(classes.select("label", "dim", "unit").mapInArrow(read, "query int, place int").groupBy("query", "place").count(), "places")
    each = found.groupBy("query").agg(F.sum("count").alias("all"))  # a row a query at most
    seen = each.count()
    if seen < SEEN:
        return None
    share = found.join(F.broadcast(each), "query").groupBy("place").agg(F.sum(F.col("count") / F.col("all")).alias("share"))
    reached = 0.0
    for r in share.orderBy("place").collect():  # a row a cell at most
        reached += r["share"]
        if reached >= recall * seen - 1e-9:
            return r["place"] + 1
    return None


def local_components(linked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of each row's and column's group under the links of a block of rows by columns."""
    a, b = low.copy(), high.copy()
    i, j = np.nonzero(linked)
    while len(i):
        was = a.sum(dtype=np.uint64), b.sum(dtype=np.uint64)
        np.minimum.at(a, i, b[j])
        np.minimum.at(b, j, a[i])
        if (a.sum(dtype=np.uint64), b.sum(dtype=np.uint64)) == was:
            break
    return a, b


def link_counts(classes: DataFrame, index: Index, visits: int | None, threshold: float) -> DataFrame:
    """(key, n, low), ``visits`` None for all cells that can hold links: of each pair of blocks and each class in it that has links, their weight and the smallest key of its group."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(index)
    widest = 2 - 2 * threshold + 1e-6  # squared distance of unit vectors that link, and room for rounding

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            for dim, batch in by_dim(whole):
                a, b = index.halves(dim, matrix(batch.column("unit")))
                least_a, least_b = index.least(dim, a, b)
                take, targets, homes = [], [], []
                for k in range(batch.num_rows):
                    home = int(a[k].argmin()) * b.shape[1] + int(b[k].argmin())
                    if visits is None:
                        reach = cells_within(least_a[k], least_b[k], widest).tolist()
                    else:
                        reach = [i * b.shape[1] + j for i, j in multi_sequence(a[k], b[k], visits) if least_a[k, i] + least_b[k, j] <= widest]
                    # of two cells the lower one's vectors probe the other, so a pair meets once
                    cells = {home, *(c for c in reach if c > home)}
                    take += [k] * len(cells)
                    homes += [home] * len(cells)
                    targets += cells
                out = batch.take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(homes, pa.int32()), pa.array(targets, pa.int32())], ["key", "label", "dim", "unit", "weight", "home", "cell"]
                )

    probes = C.store(
        classes.select("key", "label", "dim", "unit", "weight").mapInArrow(probe, "key long, label string, dim int, unit binary, weight long, home int, cell int"), "probes"
    )
    place = ["label", "dim", "cell"]
    own = F.col("home") == F.col("cell")
    sizes = C.store(probes.groupBy(*place).agg(F.count_if(own).alias("members"), F.count_if(~own).alias("visitors")), "cells")

    def blocks(rows: DataFrame, count: str, name: str) -> DataFrame:
        n = F.ceil(F.col(count) / F.lit(BLOCK))
        dealt = rows.join(sizes, place).withColumn("block", F.pmod(F.xxhash64("key"), n))
        packed = dealt.groupBy(*place, "block").agg(F.collect_list(F.struct("key", "unit", "weight")).alias(name))
        return C.store(packed.withColumnRenamed("block", f"{name}_block"), name)

    members, visitors = blocks(probes.filter(own), "members", "a"), blocks(probes.filter(~own), "visitors", "b")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one, two = batch.column("one")[k].as_py(), batch.column("two")[k].as_py()
                ids = [np.array([r["key"] for r in x], np.int64) for x in (one, two)]
                weight = [np.array([r["weight"] for r in x], np.int64) for x in (one, two)]
                x, y = (np.frombuffer(b"".join(r["unit"] for r in v), np.float64).reshape(len(v), -1) for v in (one, two))
                linked = x @ y.T >= threshold
                if batch.column("same")[k].as_py():  # a block with itself: each pair once
                    linked &= np.triu(np.ones(linked.shape, bool), 1)
                low = local_components(linked, *ids)
                n = linked.astype(np.int64) @ weight[1], weight[0] @ linked.astype(np.int64)
                for s in (0, 1):
                    has = n[s] > 0
                    yield pa.RecordBatch.from_pydict({"key": ids[s][has], "n": n[s][has], "low": low[s][has]})

    m2 = members.withColumnRenamed("a", "two").withColumnRenamed("a_block", "two_block")
    within = members.join(m2, place).filter(F.col("a_block") <= F.col("two_block"))
    within = within.select(F.col("a").alias("one"), "two", (F.col("a_block") == F.col("two_block")).alias("same"))
    across = members.join(visitors, place).select(F.col("a").alias("one"), F.col("b").alias("two"), F.lit(False).alias("same"))
    shape = "key long, n long, low long"
    return within.mapInArrow(multiply, shape).union(across.mapInArrow(multiply, shape))


def near_vectors(
    rows: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE, queries: int = QUERIES, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(_id, n_links, component_id, kept) of every vector; of each component the smallest id's vector is kept, one if it has several."""
    vectors = C.store(unit_vectors(rows, id_col, vector_col, label_col), "vectors")
    usable = vectors.filter(F.col("unit").isNotNull())
    # numbers of equal vectors; ids may repeat (all null ones are NO_ID), so a number of its own stands for each class
    classes = usable.groupBy("label", "dim", "unit").agg(F.min("_id").alias("_id"), F.count("*").alias("weight"))
    classes = C.store(classes.withColumn("key", F.monotonically_increasing_id()), "classes")
    total = classes.count()
    share = F.pmod(F.xxhash64(F.lit(5), "unit"), F.lit(1 << 24))
    drawn = classes.filter(share < int(min(1.0, sample / max(total, 1)) * (1 << 24))).select("label", "unit").limit(2 * sample).collect()
    drawn = [(r["label"], np.frombuffer(r["unit"], np.float64)) for r in drawn]
    words = max(4, round((total / CELL_ROWS) ** 0.5))
    index = Index([v for _, v in drawn], words)
    visits = calibrated(classes, index, drawn[:queries], threshold, recall) if recall < 1 and drawn else None
    if visits is None and recall < 1 and len(drawn) > queries:
        visits = calibrated(classes, index, drawn, threshold, recall)
    found = C.store(link_counts(classes, index, visits, threshold), "link-counts")
    linked = C.store(components(classes, found), "components")
    named = linked.join(classes.select("key", "label", "dim", "unit", "_id", "weight"), "key")
    firsts = C.store(named.groupBy("component").agg(F.min(F.struct("_id", "key")).alias("first")), "firsts")
    per_class = named.join(firsts, "component").select(
        "label", "dim", "unit", (F.col("n") + F.col("weight") - 1).alias("n_links"), F.col("first._id").alias("component_id"), (F.col("first.key") == F.col("key")).alias("kept")
    )
    per_class = C.store(per_class, "linked-classes")
    out = usable.join(per_class, ["label", "dim", "unit"]).select("_id", "n_links", "component_id", (F.col("kept") & (F.col("_id") == F.col("component_id"))).alias("kept"))
    alone = vectors.filter(F.col("unit").isNull()).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.union(alone)


def components(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(key, n, component) of each class."""
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    groups = C.components(classes.select(F.col("key").alias("node")), found.filter(F.col("key") != F.col("low")).select(F.col("key").alias("src"), F.col("low").alias("dst")))
    return groups.withColumnRenamed("node", "key").join(counts, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("n"), "component")
