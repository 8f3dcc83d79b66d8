"""Best-fit packing (operator 7) of token pieces into sequences, by the linear grouping scheme.

Tasks turn texts into pieces of at most ``capacity`` tokens (only longer documents are cut; their first piece may be the
shorter one). Pieces of one length are alike, so the plan needs only the count of each length, ``capacity`` numbers whatever
the input. From these the driver:

1. takes lengths over ``capacity * small`` as large, deals them by size into ``groups`` groups of equal cardinality and
   rounds each up to its group's greatest length;
2. finds the best mix of configurations of these few sizes by column generation (linear program, knapsack pricing);
3. rounds the mix down and puts actual pieces into its places, the greatest left of each group; the last place of a
   sequence takes the greatest piece that fits, so that what rounding up has left there is used;
4. packs the large pieces left over, then the small ones, best-fit: into the tightest gap that holds them.

The plan says for each run of ranks within a length in which sequences and at which offset they stand. Ranks come from a
count of (bucket, length) and a row number within it, so a length that a third of all pieces have is spread over many tasks.

Null and empty texts are one piece with the end id; a null id sorts last; repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm.tokens import encoder

CAPACITY = 2048
GROUPS = 100
SMALL = 0.3

Slot = tuple[int, int, int, int, int]


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the pieces of a document of ``n`` tokens."""
    at = n % capacity or min(n, capacity)
    yield 0, at
    for start in range(at, n, capacity):
        yield start, start + capacity


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, piece, start, length, ids_crc32) of every piece; no shuffle."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                rows = []
                ids, at = known.ids(part.column("_text"))
                raw = np.insert(ids, at[1:], end_id).astype("<u4").tobytes()  # each document's end
                at = (at + np.arange(len(at))).tolist()
                for i, low, high in zip(part.column("_id").to_pylist(), at[:-1], at[1:], strict=True):
                    rows += [(i, k, a, b - a, zlib.crc32(raw[4 * (low + a) : 4 * (low + b)])) for k, (a, b) in enumerate(cut(high - low, capacity))]
                columns = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["_id", "piece", "start", "length", "ids_crc32"])

    return C.id_and_text(docs, id_col, text_col).mapInArrow(read, "_id long, piece int, start long, length long, ids_crc32 long")


# --- the plan, from counts by length -----------------------------------------------------------------------------------


def grouped(counts: list[tuple[int, int]], groups: int) -> list[tuple[int, int]]:
    """(least, greatest) length of each group by rising size: equal cardinality as far as whole lengths allow."""
    each = max(1, -(-sum(c for _, c in counts) // groups))
    out, held = [], each
    for length, count in sorted(counts):
        if held >= each:
            out.append((length, length))
            held = 0
        out[-1] = (out[-1][0], length)
        held += count
    return out


def knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes (rising) that fits, and how many of each."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(int(sizes[0]), capacity + 1):
        v = best[c - sizes[: fits[c]]] + worth[: fits[c]]
        j = int(v.argmax())
        if v[j] > best[c - 1] + 1e-12:
            best[c], pick[c] = v[j], j
        else:
            best[c], pick[c] = best[c - 1], -1
    used, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            used[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return best[capacity], used


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """(configuration, times) of a least number of sequences, fractions allowed: simplex over a basis of configurations."""
    m = len(sizes)
    basis = np.diag(np.floor(capacity / sizes))
    inverse = np.diag(1 / np.diag(basis))
    x = inverse @ demand
    for _ in range(12 * m):
        value, column = knapsack(sizes, np.ones(m) @ inverse, capacity)
        if value <= 1 + 1e-6:
            break
        step = inverse @ column
        up = step > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = np.maximum(x[up], 0) / step[up]
        r = int(ratio.argmin())
        x -= ratio[r] * step
        x[r] = ratio[r]
        basis[:, r] = column
        inverse[r] /= step[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(step[others], inverse[r])
    return [(basis[:, k].astype(int), x[k]) for k in range(m) if x[k] > 1e-9]


class Plan:
    """Slots (length, first rank, count, first sequence, offset) and the sequences' gaps, as runs of like sequences."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.slots: list[Slot] = []
        self.left = {n: c for n, c in counts.items() if c}
        self.there = sum(1 << n for n in self.left)  # bit n: there are pieces of length n
        self.rank: dict[int, int] = defaultdict(int)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.open = 0  # bit g: there are runs with gap g

    def greatest(self, low: int, high: int) -> int:
        """The greatest length from ``low`` to ``high`` of which pieces are left, or 0."""
        found = (self.there & ((1 << (high + 1)) - 1)) >> low
        return low + found.bit_length() - 1 if found else 0

    def place(self, length: int, count: int, base: int, offset: int) -> None:
        self.slots.append((length, self.rank[length], count, base, offset))
        self.rank[length] += count
        self.left[length] -= count
        if not self.left[length]:
            self.there &= ~(1 << length)

    def leave(self, base: int, count: int, gap: int) -> None:
        if gap and count:
            self.gaps[gap].append((base, count))
            self.open |= 1 << gap

    def start(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def fill(self, places: list[tuple[int, int]], count: int) -> None:
        """``count`` sequences of one configuration, given the groups of its places by falling size.

        A place takes the greatest length left in its group; the last one the greatest that fits, of whatever group.
        """
        runs = [(self.start(count), count, 0)]
        for k, (low, high) in enumerate(places):
            after = []
            for base, n, used in runs:
                room = self.capacity - used
                if k == len(places) - 1:
                    low, high = 1, room
                while n and (length := self.greatest(low, min(high, room))):
                    m = min(n, self.left[length])
                    self.place(length, m, base, used)
                    after.append((base, m, used + length))
                    base, n = base + m, n - m
                if n:
                    after.append((base, n, used))
            runs = after
        for base, n, used in runs:
            self.leave(base, n, self.capacity - used)

    def best_fit(self, length: int, count: int) -> None:
        """Each piece of this length into the tightest gap that holds it, or else into a new sequence."""
        while count:
            over = self.open >> length
            if over:
                gap = length + (over & -over).bit_length() - 1
                base, n = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    self.open &= ~(1 << gap)
            else:
                gap, n = self.capacity, -(-count // (self.capacity // length))
                base = self.start(n)
            each = gap // length
            full = min(n, count // each)
            for k in range(each * bool(full)):
                self.place(length, full, base, self.capacity - gap + k * length)
            self.leave(base, full, gap - each * length)
            count -= full * each
            base, n = base + full, n - full
            if n and count < each:
                for k in range(count):
                    self.place(length, 1, base, self.capacity - gap + k * length)
                self.leave(base, 1, gap - count * length)
                base, n, count = base + 1, n - 1, 0
            self.leave(base, n, gap)


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: float = SMALL) -> Plan:
    """Where pieces go, given how many there are of each length."""
    out = Plan(counts, capacity)
    large = [(n, c) for n, c in counts.items() if n > capacity * small and c]
    if large:
        bounds = grouped(large, groups)
        demand = np.array([sum(c for n, c in large if low <= n <= high) for low, high in bounds], float)
        for configuration, times in configurations(np.array([high for _, high in bounds]), demand, capacity):
            if whole := int(times + 1e-6):
                out.fill([bounds[k] for k in np.repeat(np.arange(len(bounds)), configuration)][::-1], whole)
    for n in sorted((n for n, c in out.left.items() if c), reverse=True):
        out.best_fit(n, out.left[n])
    return out


# --- ranks and places --------------------------------------------------------------------------------------------------


def ranked(pieces: DataFrame, rows: int, bucket_rows: int = 4096) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... within each length; (bucket, length) bounds what a task must sort together.

    ``row`` tells the pieces of null and repeated ids apart, so that they are dealt like all others.
    """
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("_id", "piece", "row"), F.lit(max(1, -(-rows // bucket_rows)))))
    sizes = dealt.groupBy("bucket", "length").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "length").orderBy("_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("rank", F.row_number().over(inside) - 1)
    return numbered.join(sizes, ["bucket", "length"]).withColumn("rank", F.col("rank") + F.col("before")).drop("bucket", "before", "row")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, groups: int = GROUPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = C.store(token_pieces(docs, vocabulary, capacity, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = np.array(sorted(plan(counts, capacity, groups).slots), np.int64).reshape(-1, 5)
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("_id", "piece", "start", "length", "ids_crc32")] + [pa.array(table[k, 3] + rank - table[k, 1]), pa.array(table[k, 4])],
                ["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    rows = ranked(pieces, sum(counts.values())).select("_id", "piece", "start", F.col("length"), "ids_crc32", F.col("rank").cast("long").alias("rank"))
    return rows.mapInArrow(locate, "_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
