"""Ranked lexical search (operator 11): norm buckets over integer impact vectors, pruned in the manner of LEMP.

Each document is a vector of impacts over the terms that the items use, each item a vector of weights; a score is their
integer inner product. Documents are ordered by the length (norm) of their vectors and stored that way; consecutive ones make
a bucket. For an item with the threshold ``t`` (its k-th score so far):

* by Cauchy-Schwarz, documents whose norm times the item's norm lies below ``t`` are out: the end of a bucket, whole buckets,
  and by the statistics of the stored files parts of the table that are never read;
* inside a bucket each coordinate has a bound, the item's weight times the bucket's greatest impact. The coordinates whose
  bounds together stay below ``t`` can't lift a document alone, so only documents that hold another one are looked at, and of
  these only such whose known part, plus the lesser of the bounds and of Cauchy-Schwarz for the rest, reaches ``t``;
* what is left is scored exactly in 64-bit integers.

The longest ``HEAD`` documents are searched first; the k-th scores among them are the thresholds of all tasks that search the
others, and each task raises its own as it goes. Nothing is dropped at a bound, only below it, so ties are whole.

Items are searched in blocks of ``BLOCK_BYTES`` of text, so what goes to the driver and the tasks (a block's terms, weights and
thresholds) is bounded; each block is held against all documents. Rows that repeat an item's id and text are one item, the same
id with another text an item of its own; items with null texts or without terms find nothing. Each row of the documents is a
document, also where ids repeat; a null id is returned as null and sorts last. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm import common as C

K = 50
BLOCK_BYTES = 4 << 20
HEAD = 8192
BUCKET = 4096
#: For sums and products of doubles, whose relative error is far below it.
SLACK = 1 + 1e-9

#: The bytes of a term: ASCII letters and digits, and all that isn't ASCII.
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def term_spans(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms; one that reaches over the border of two rows is two."""
    inside = np.zeros(len(body) + 2, np.int8)
    inside[1:-1] = _TERM[body]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    border = np.unique(offsets[1:-1])
    border = border[(border > 0) & (border < len(body))]
    border = border[(inside[border] == 1) & (inside[border + 1] == 1)]
    if len(border):
        starts, ends = np.sort(np.concatenate([starts, border])), np.sort(np.concatenate([ends, border]))
    return starts, ends


def same_bytes(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` >= 1 bytes at ``a_at`` and ``b_at`` are equal, each pair."""
    if not len(size):
        return np.zeros(0, bool)
    first = np.cumsum(size) - size
    flat = np.arange(int(size.sum())) - np.repeat(first, size)
    return np.logical_and.reduceat(a[np.repeat(a_at, size) + flat] == b[np.repeat(b_at, size) + flat], first)


class Vocabulary:
    """Terms by number, found by a hash of their bytes and then held against the bytes themselves."""

    def __init__(self, terms: list[bytes]):
        self.body = np.frombuffer(b"".join(terms), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in terms], dtype=np.int64)]).astype(np.int64)
        hashes = C.span_hashes(self.body, self.at[:-1], self.at[1:])
        self.number = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.number]
        self.alike = int(np.unique(hashes, return_counts=True)[1].max(initial=0))

    def __len__(self) -> int:
        return len(self.number)

    def find(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
        """The number of each span's term, -1 for others; block by block of the body."""
        out = np.full(len(starts), -1, np.int64)
        low = 0
        while low < len(starts) and len(self):
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + block)))
            part = body[starts[low] : ends[high - 1]]
            out[low:high] = self._find(part, starts[low:high] - starts[low], ends[low:high] - starts[low])
            low = high
        return out

    def _find(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.full(len(starts), -1, np.int64)
        hashes = C.span_hashes(body, starts, ends)
        left = np.searchsorted(self.hashes, hashes)
        for k in range(self.alike):  # terms of one hash, if there are any, one after the other
            at = np.minimum(left + k, len(self) - 1)
            hit = np.flatnonzero((out < 0) & (self.hashes[at] == hashes))
            number, size = self.number[at[hit]], (ends - starts)[hit]
            alike = self.at[number + 1] - self.at[number] == size
            hit, number, size = hit[alike], number[alike], size[alike]
            equal = same_bytes(body, starts[hit], self.body, self.at[number], size)
            out[hit[equal]] = number[equal]
        return out


def terms_of(text: str) -> list[bytes]:
    """The different terms of one text."""
    body, at = C.text_bytes(pa.array([text], pa.large_string()))
    starts, ends = term_spans(body, at)
    raw = C.LOWER[body].tobytes()
    return sorted({raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)})


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column without nulls, and the n+1 offsets of its rows."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[at[0] : at[-1]], at - at[0]


def counted_terms(docs: DataFrame, known: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, n, terms, tfs) of each document with a term: n counts all its terms, the lists hold the known ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                body, at = C.text_bytes(part.column("_text"))
                starts, ends = term_spans(body, at)
                number = known.find(C.LOWER[body], starts, ends)
                rows = np.searchsorted(starts, at)
                row = np.repeat(np.arange(part.num_rows), np.diff(rows))
                hit = number >= 0
                pair, tf = np.unique(row[hit] * max(1, len(known)) + number[hit], return_counts=True)
                sizes = np.bincount(pair // max(1, len(known)), minlength=part.num_rows)
                out = pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(np.diff(rows), pa.int64()), _lists(pair % max(1, len(known)), sizes, pa.int32()), _lists(tf, sizes, pa.int64())],
                    ["_id", "n", "terms", "tfs"],
                )
                yield out.filter(pa.array(np.diff(rows) > 0))

    return C.id_and_text(docs, id_col, text_col).mapInArrow(count, "_id long, n long, terms array<int>, tfs array<long>")


def impact_vectors(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(_id, norm, terms, impacts) of the documents that hold a known term."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, at = _flat(batch.column("terms"))
            tfs, _ = _flat(batch.column("tfs"))
            size = np.diff(at)
            m = np.array([50 + 50 * n * n_docs // n_terms for n in batch.column("n").to_pylist()], np.int64)
            impacts = (1_000_000_000 * tfs) // (1000 * tfs + 20 * np.repeat(m, size))
            norm = np.sqrt(np.add.reduceat(impacts.astype(np.float64) ** 2, at[:-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(norm), _lists(terms, size, pa.int32()), _lists(impacts, size, pa.int32())], ["_id", "norm", "terms", "impacts"]
            )

    return counted.filter(F.size("terms") > 0).mapInArrow(weigh, "_id long, norm double, terms array<int>, impacts array<int>")


class Best:
    """The k best (score, id) of an item so far; ``floor``: the least score that can still count."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


class Bucket:
    """Documents of similar norms: their vectors, and for each term the documents that hold it."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, terms: np.ndarray, impacts: np.ndarray, at: np.ndarray):
        first = np.argsort(-norms, kind="stable")
        self.norms, self.ids, self.first = norms[first], ids[first], first
        self.terms, self.impacts, self.at = terms, impacts.astype(np.int64), at
        place = np.empty(len(first), np.int64)
        place[first] = np.arange(len(first))
        by_term = np.argsort(terms, kind="stable")
        self.holder = np.repeat(place, np.diff(at))[by_term]
        self.held = self.impacts[by_term]
        self.known, self.lists = np.unique(terms[by_term], return_index=True)
        self.most = np.maximum.reduceat(self.held, self.lists)
        self.lists = np.append(self.lists, len(by_term))

    def search(self, terms: np.ndarray, weights: np.ndarray, norm: float, dense: np.ndarray, best: Best) -> None:
        """Add the documents that can be among the best of an item; ``dense``: a zero for each term, given back as zeros."""
        reach = int(np.searchsorted(-self.norms, -best.floor / (norm * SLACK), side="right"))
        if not reach:
            return
        at = np.searchsorted(self.known, terms)
        here = at < len(self.known)
        here[here] = self.known[at[here]] == terms[here]
        at, weight = at[here], weights[here]
        bound = weight * self.most[at]
        order = np.argsort(-bound, kind="stable")
        at, weight, bound = at[order], weight[order], bound[order].astype(np.float64)
        rest = np.append(np.cumsum(bound[::-1])[::-1], 0.0)  # of the coordinates from each on
        need = int(np.argmax(rest * SLACK < best.floor))  # the coordinates before it are looked at
        if not need:
            return
        lists = [slice(self.lists[k], self.lists[k + 1]) for k in at[:need].tolist()]
        holder = np.concatenate([self.holder[x] for x in lists])
        held = np.concatenate([self.held[x] for x in lists]).astype(np.float64)
        size = np.array([x.stop - x.start for x in lists])
        part = np.bincount(holder, held * np.repeat(weight[:need], size), len(self.ids))
        seen = np.bincount(holder, held * held, len(self.ids))
        left = math.sqrt(float((weight[need:].astype(np.float64) ** 2).sum())) * np.sqrt(np.maximum(self.norms**2 * SLACK - seen, 0.0))
        can = (part > 0) & ((part + np.minimum(rest[need], left)) * SLACK >= best.floor)
        can[reach:] = False
        left_over = np.flatnonzero(can)
        if not len(left_over):
            return
        row = self.first[left_over]
        size = self.at[row + 1] - self.at[row]
        begin = np.cumsum(size) - size
        flat = np.arange(int(size.sum())) + np.repeat(self.at[row] - begin, size)
        dense[terms] = weights
        scores = np.add.reduceat(dense[self.terms[flat]] * self.impacts[flat], begin)
        dense[terms] = 0
        good = scores >= best.floor
        best.add(scores[good], self.ids[left_over[good]])


def search(vectors: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], n_known: int, floors: list[int], k: int) -> DataFrame:
    """(item, _id, score): at most k documents a task and item, all of the k best of a task that reach the item's floor.

    ``items``: the terms and weights of each; the rows of a task come by falling norms.
    """
    norms = [math.sqrt(float((w.astype(np.float64) ** 2).sum())) for _, w in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, dense = [Best(k, f) for f in floors], np.zeros(n_known, np.int64)
        for whole in batches:
            for low in range(0, whole.num_rows, BUCKET):
                batch = whole.slice(low, BUCKET)
                terms, at = _flat(batch.column("terms"))
                impacts, _ = _flat(batch.column("impacts"))
                bucket = Bucket(batch.column("_id").to_numpy(), batch.column("norm").to_numpy(), terms, impacts, at)
                for (own, weights), norm, found in zip(items, norms, best, strict=True):
                    if norm > 0:
                        bucket.search(own, weights, norm, dense, found)
        for item, found in enumerate(best):
            if len(found.ids):
                yield pa.RecordBatch.from_pydict({"item": pa.array([item] * len(found.ids), pa.int32()), "_id": found.ids, "score": found.scores})

    return vectors.mapInArrow(run, "item int, _id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, _id, score): the k documents of the highest scores above 0 for each item, ties by the smaller id."""
    spark = docs.sparkSession
    asked = C.store(items.select(items[item_id].alias("id"), items[item_text].alias("text")).filter(F.col("text").isNotNull()).distinct(), "items")
    size = asked.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = []
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES
        own = [(r["id"], terms_of(r["text"])) for r in mine]
        names = [name for name, words in own if words]
        if names:
            out.append(_block(docs, [words for _, words in own if words], k, id_col, text_col).join(spark.createDataFrame(list(enumerate(names)), f"item int, {item_id} {asked.schema['id'].dataType.simpleString()}"), "item"))
    if not out:
        out = [spark.createDataFrame([], f"item int, _id long, score long, rank int, {item_id} {asked.schema['id'].dataType.simpleString()}")]
    return reduce(DataFrame.unionByName, out).select(item_id, "rank", "_id", "score")


def _block(docs: DataFrame, items: list[list[bytes]], k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, _id, score, rank) of a block of items, given by their terms."""
    terms = sorted({t for words in items for t in words})
    number = {t: i for i, t in enumerate(terms)}
    counted = C.store(counted_terms(docs, Vocabulary(terms), id_col, text_col), "terms")
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holders = {r["term"]: r["count"] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # the block's terms at most
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders.get(i, 0) + 1))) for i in range(len(terms))], np.int64)
    asked = [np.array([number[t] for t in words], np.int64) for words in items]
    asked = [(own, weight[own]) for own in (x[[holders.get(int(i), 0) > 0 and weight[i] > 0 for i in x]] for x in asked)]
    vectors = impact_vectors(counted, n_docs, n_terms).repartitionByRange(F.desc("norm"), F.xxhash64("_id")).sortWithinPartitions(F.desc("norm"))
    vectors = C.store(vectors, "impacts")
    floors = [1] * len(asked)
    have = vectors.count()
    if have <= HEAD:
        return _best(search(vectors, asked, len(terms), floors, k), k)
    cut = vectors.agg(F.percentile_approx("norm", 1 - HEAD / have, F.lit(10_000)).alias("c")).first()["c"]
    head = C.store(_best(search(vectors.filter(F.col("norm") >= cut), asked, len(terms), floors, k), k).drop("rank"), "head")
    for r in head.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect():  # a row an item of the block
        if r["n"] == k:
            floors[r["item"]] = r["least"]
    least = min((f / (SLACK * math.sqrt(float((w.astype(np.float64) ** 2).sum()))) for (_, w), f in zip(asked, floors, strict=True) if len(w)), default=0.0)
    tail = search(vectors.filter((F.col("norm") < cut) & (F.col("norm") >= least)), asked, len(terms), floors, k)
    return _best(head.unionByName(tail), k)
