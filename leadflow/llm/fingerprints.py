"""Document fingerprints (operator 13): MinHash signatures of word shingles, joined by their bands, verified by Jaccard.

A text's shingles are its runs of ``SHINGLE`` white-space separated words (ASCII case folded); a shorter text is one shingle. Each
of ``PERMUTATIONS`` strongly universal functions h(x) = (a x + b mod 2^64) >> 32 keeps its least value over the shingles, of
which the fingerprint holds the lower 16 bits. The share of equal places of two fingerprints estimates the Jaccard similarity
of the shingle sets, with a standard error of at most 0.045; unlike shingles agree by chance in one of 65,536 places.

``fingerprints`` is one pass over the texts. ``edited_likeness`` also compares each text with an edited form of itself, whose end
is the start of the next document by falling id: documents are dealt by ranges of their ids, sorted, and read as a stream in which
the next document follows; only the documents at the borders of the ranges, two a range, are joined afterwards.
``near_documents`` joins the bands of the signatures, ``BAND`` places each, compares the members of each bucket with its leader
by the exact Jaccard similarity, lets those that aren't alike go on without it, and closes the links to classes.

Texts that are null count as empty. Texts without words have one and the same fingerprint, and are like each other only. A null
id comes before all others and is returned as null; rows that share an id follow each other by a hash of their texts; equal rows
are documents of their own. One document alone is its own next one. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm import common as C

PERMUTATIONS = 128
SHINGLE = 5
#: Places of the fingerprint in a band: 21 bands of 6 find 99.8 % of the pairs at a similarity of 0.8 and all above 0.9.
BAND = 6
THRESHOLD = 0.8

_RNG = np.random.default_rng(1997)
_A = _RNG.integers(0, 1 << 64, PERMUTATIONS, np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 64, PERMUTATIONS, np.uint64)
_PLACE = _RNG.integers(0, 1 << 64, SHINGLE, np.uint64) | np.uint64(1)
_BLOCK = 1 << 16


def shingles(column) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the shingles of each text, in order and with repeats, and the n+1 offsets of the texts."""
    body, at = C.text_bytes(column)
    words, rows = C.word_hashes(body, at)
    count = np.diff(rows)
    long = np.append(words, np.zeros(SHINGLE, np.uint64))
    with np.errstate(over="ignore"):
        runs = sum((long[i : len(words) + 1 + i] * _PLACE[i] for i in range(1, SHINGLE)), long[: len(words) + 1] * _PLACE[0])
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        whole = np.zeros(len(short), np.uint64)
        for i in range(SHINGLE - 1):
            whole += np.where(count[short] > i, long[rows[short] + i] * _PLACE[i], np.uint64(0))
    size = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    offsets = np.concatenate([[0], np.cumsum(size)])
    out = runs[np.arange(offsets[-1]) + np.repeat(rows[:-1] - offsets[:-1], size)]
    out[offsets[short]] = whole
    return C.mix64(out) >> np.uint64(32), offsets


def signatures(column) -> np.ndarray:
    """The fingerprint of each text as a row of 16-bit places."""
    x, offsets = shingles(column)
    size = np.diff(offsets)
    least = np.full((len(size), PERMUTATIONS), ~np.uint64(0))
    some = np.flatnonzero(size)
    begins = offsets[some]
    for low in range(0, len(x), _BLOCK):
        block = x[low : low + _BLOCK]
        first, last = np.searchsorted(begins, low, "right") - 1, np.searchsorted(begins, low + len(block))
        cuts, mine = np.maximum(begins[first:last] - low, 0), some[first:last]
        held = np.empty((PERMUTATIONS, len(mine)), np.uint64)
        values = np.empty_like(block)
        for p in range(PERMUTATIONS):
            np.multiply(block, _A[p], out=values)
            values += _B[p]
            np.minimum.reduceat(values, cuts, out=held[p])
        least[mine] = np.minimum(least[mine], held.T)
    return (least >> np.uint64(32)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal places of two fingerprints, each pair."""
    return (a == b).mean(axis=1)


def _packed(places: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in places], pa.binary())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, n_chars, fingerprint): the fingerprint as 256 bytes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("n_chars"), _packed(signatures(part.column("_text")))], ["_id", "n_chars", "fingerprint"])

    rows = C.id_and_text(docs, id_col, text_col).withColumn("n_chars", F.char_length("_text").cast("long"))
    return rows.mapInArrow(sign, "_id long, n_chars long, fingerprint binary")


def text_of(fingerprint: Column) -> Column:
    """A fingerprint as text: two hexadecimal digits a byte."""
    return F.lower(F.hex(fingerprint))


# --- edited texts ------------------------------------------------------------------------------------------------------

_EDITED = "_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many code points of ``following`` (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _judged(ids: list[int], texts: list[str], following: list[str], own: np.ndarray, others: np.ndarray) -> dict:
    """Columns of ``_EDITED`` of texts whose next ones, and the fingerprints of both, are known."""
    edited = [edited_text(a, b) for a, b in zip(texts, following, strict=True)]
    changed = signatures(pa.array(edited, pa.large_string()))
    return {
        "_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).digest() for t in edited], pa.binary()),
        "fingerprint": _packed(own),
        "edited_fingerprint": _packed(changed),
        "near_edited": likeness(own, changed),
        "near_next": likeness(own, others),
    }


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_EDITED`` for all documents of a range but its last; the texts of its first and last one as ``text``."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    fields = [*(x.split()[0] for x in _EDITED.split(", ")), "part", "text", "is_first", "is_last"]

    def border(i: int, text: str, places: np.ndarray, first: bool, last: bool) -> pa.RecordBatch:
        row = dict.fromkeys(fields) | {"_id": i, "fingerprint": places.tobytes(), "part": part, "text": text, "is_first": first, "is_last": last}
        return pa.RecordBatch.from_pylist([row], schema)

    kinds = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _EDITED.split(", "))] + [("part", pa.int32()), ("text", pa.large_string()), ("is_first", pa.bool_()), ("is_last", pa.bool_())])
    held = None
    for batch in batches:
        for chunk in C.chunks(batch, "_text"):
            ids, texts, places = chunk.column("_id").to_pylist(), chunk.column("_text").to_pylist(), signatures(chunk.column("_text"))
            if held is None:
                yield border(ids[0], texts[0], places[0], True, False)
            else:
                ids, texts, places = [held[0], *ids], [held[1], *texts], np.vstack([held[2], places])
            held = (ids[-1], texts[-1], places[-1])
            if len(ids) > 1:
                done = _judged(ids[:-1], texts[:-1], texts[1:], places[:-1], places[1:])
                n = len(ids) - 1
                done |= {"part": pa.array([part] * n, pa.int32()), "text": pa.nulls(n, pa.large_string()), "is_first": pa.nulls(n, pa.bool_()), "is_last": pa.nulls(n, pa.bool_())}
                yield pa.RecordBatch.from_pydict(done, schema)
    if held is not None:
        yield border(*held, False, True)


def _at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            own, other = (np.frombuffer(r[x], "<u2")[None] for x in ("fingerprint", "other"))
            yield pa.RecordBatch.from_pydict(_judged([r["_id"]], [r["text"]], [r["following"]], own, other))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row of ``_EDITED`` for each document; the next one of the least id is that of the greatest."""
    # equal rows may be told apart by their place, so that no key holds more than a row
    keyed = C.id_and_text(docs, id_col, text_col).select("_id", "_text", F.xxhash64("_text").alias("_print"), F.monotonically_increasing_id().alias("_row"))
    order = [F.desc("_id"), F.asc("_print")]
    rows = keyed.repartitionByRange(*order, F.asc("_row")).sortWithinPartitions(*order, F.asc("_text")).select("_id", "_text")
    told = C.store(rows.mapInArrow(_stream, f"{_EDITED}, part int, text string, is_first boolean, is_last boolean"), "edited")
    names = [x.split()[0] for x in _EDITED.split(", ")]
    inner = told.filter(F.col("part").isNotNull() & F.col("text").isNull()).select(*names)
    firsts = told.filter("is_first").select(F.col("part").alias("at"), F.col("text").alias("following"), F.col("fingerprint").alias("other"))
    lasts = told.filter("is_last").select("part", "_id", "text", "fingerprint")
    # a number a range: few, whatever the documents
    by_part = Window.orderBy("part")
    after = lasts.select("part", F.lead("part").over(by_part).alias("then"), F.min("part").over(Window.partitionBy()).alias("begin"))
    after = after.select("part", F.coalesce("then", "begin").alias("at"))
    seams = lasts.join(after, "part").join(firsts, "at").select("_id", "text", "fingerprint", "following", "other")
    return inner.unionByName(seams.mapInArrow(_at_borders, _EDITED))


# --- near documents ----------------------------------------------------------------------------------------------------


def _jaccard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(src, dst, similar) of pairs of texts ``a`` and ``b``, by the exact similarity of their shingle sets."""
    for batch in batches:
        for part in C.chunks(batch, "a"):
            (x, x_at), (y, y_at) = shingles(part.column("a")), shingles(part.column("b"))
            similar = []
            for k in range(part.num_rows):
                one, two = np.unique(x[x_at[k] : x_at[k + 1]]), np.unique(y[y_at[k] : y_at[k + 1]])
                both = len(np.intersect1d(one, two, assume_unique=True))
                similar.append(both / max(1, len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays([part.column("src"), part.column("dst"), pa.array(similar, pa.float64())], ["src", "dst", "similar"])


def near_documents(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, class_id, n_links): the smallest id of the class of near copies, and the links found to other texts.

    Equal texts are one class from the start. In a round each member of a bucket is compared with the bucket's leader; the leader
    and what is like it leave, the rest goes on, until no bucket holds two. A pair is missed only where the two never share a
    bucket (0.2 % at the threshold), or where one of them always left with a leader that the other isn't like.
    """
    given = C.id_and_text(docs, id_col, text_col).withColumn("node", F.xxhash64("_text")).withColumn("check", F.xxhash64(F.lit("text"), "_text"))
    members = C.store(given.select("_id", "node", "check"), "members")
    texts = C.store(given.groupBy("node", "check").agg(F.first("_text").alias("_text")), "texts")
    n = PERMUTATIONS // BAND
    keyed = texts.select(F.col("node").alias("doc_id"), F.col("_text").alias("text"))
    bands = fingerprints(keyed).filter(F.length("fingerprint") > 0).select(
        F.col("_id").alias("node"), F.posexplode(F.array(*[F.xxhash64(F.substring("fingerprint", 1 + 2 * BAND * k, 2 * BAND)) for k in range(n)])).alias("band", "value"))
    left = C.store(bands, "bands")
    links = None
    while True:
        heads = left.groupBy("band", "value").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1")
        pairs = C.store(left.join(heads, ["band", "value"]).filter(F.col("node") != F.col("head")), "buckets")
        if pairs.isEmpty():
            break
        asked = pairs.select(F.col("node").alias("src"), F.col("head").alias("dst")).distinct()
        sides = asked.join(texts.select(F.col("node").alias("src"), F.col("_text").alias("a")), "src").join(texts.select(F.col("node").alias("dst"), F.col("_text").alias("b")), "dst")
        judged = sides.select("src", "dst", "a", "b").mapInArrow(_jaccard, "src long, dst long, similar double")
        near = C.store(judged.filter(F.col("similar") >= threshold).select("src", "dst"), "near")
        links = near if links is None else links.unionByName(near)
        left = C.store(pairs.join(near, (pairs["node"] == near["src"]) & (pairs["head"] == near["dst"]), "left_anti").select("node", "band", "value"), "bands")
    if links is None:
        links = members.select(F.col("node").alias("src"), F.col("node").alias("dst")).limit(0)
    links = C.store(links.distinct(), "links")
    classes = C.components(texts.select("node"), links)
    counts = links.select(F.col("src").alias("node")).unionByName(links.select(F.col("dst").alias("node"))).groupBy("node").agg(F.count("*").alias("n_links"))
    out = members.join(classes, "node").join(counts, "node", "left").select("_id", "component", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    least = out.groupBy("component").agg(F.min("_id").alias("class_id"))
    return out.join(least, "component").select("_id", "class_id", "n_links")
