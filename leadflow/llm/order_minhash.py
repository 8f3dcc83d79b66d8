"""MinHash near-dedup (operator 5) by Order MinHash, candidates verified by banded alignment of words.

Words are white-space separated, ASCII letters folded. A document's k-mers of ``K`` words get their occurrence number; each of
``SKETCHES`` hash functions picks the two smallest of them, and the sketch is these two in the order of the text. So, unlike
plain MinHash, a sketch feels the order of the words, as edit similarity does. Each sketch is a band.

Equal texts are one class first. Within a band's bucket every document is compared with the smallest one, its leader: one
comparison a document, never all pairs. Documents that don't align with their leader go on without it, with twice the sketches
in their key, until no bucket has two documents left; when all sketches are in the key, only the leader goes. So a hot bucket,
say of documents that share a passage, is split rather than dropped or multiplied out.

The sketches find most links cheaply, but by chance, and a leader's links aren't those of its bucket. So ``missed_links`` looks, without
chance, for the links between what they have joined: two texts that align share a fifth of their grams of four words (short ones, of
fewer words), less a few. Sketches first keeps this part small: a large group of near copies is one group by then. ``may_align`` counts
for each document how many grams any one other could share with it, by a byte that stands for the other: unrelated documents,
of which more and more share some gram the more there are, leave here and never become rows. Between those that stay, grams that
the same documents hold are one row with a count, and documents with fewer shared grams than a partner would have leave. Documents
that share a gram with many others are compared block by block, so that each pair of them isn't a row for each gram that both hold.

Two documents link where 1 - distance / longer length >= ``similarity``, the distance being Levenshtein's over words. A class
is a group of documents connected by links or equal texts; its id is its smallest document's.

Null and empty texts, and those without a word, are equal to those of the same text only (null is empty). Texts of fewer than
``K`` words have one k-mer. A document is an id and a text: rows that repeat both are one, other texts of a null or repeated id
are documents of their own. Null ids sort last; of one id's documents in a class the one with the smallest digest is kept.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm import common as C

K = 5
#: One sketch a band: two texts at the similarity that links share few k-mers, and of two sketches seldom both.
BANDS = 48
PER_BAND = 1
SKETCHES = BANDS * PER_BAND
SIMILARITY = 0.8
#: Pairs to compare are sent to all tasks, so many at a time (48 bytes each), so that other texts aren't shuffled; other tables are
#: joined by a shuffle beyond this number.
SENT_PAIRS = 1_000_000
#: A pair of texts shares one more of its rare grams for each so many words of the longer text, besides the first.
WORDS_A_SHARED = 20
#: Rarity: grams are counted in so many slots, from so many on. It only sets the order in which grams are taken; what is found is
#: the same in any order. About so many slots with a count are sent at most, those of the commonest grams.
SLOT_BITS = 24
COUNTED_FROM = 3
SENT_SLOTS = 1 << 20
#: Grams are dealt into a bucket for each so many words, 64 at least; a task reads a bucket.
BUCKET_WORDS = 1_000_000
GRAM_BYTES = 5
#: The same for the grams of all documents, of which many fall into a large bucket: the fewer buckets, the fewer heads of documents.
VOTE_WORDS = 8_000_000
#: A task sorts about so many of a bucket's grams at a time.
VOTE_GRAMS = 1 << 20
#: The vote that stands for any document: the gram is held by more than ``HOT``.
ANY = 255
#: Bytes of text whose grams a worker ranks at a time (some 30 bytes each).
RANKED_BYTES = 1 << 19
#: Documents of grams that more than so many of them hold are compared in blocks of about so many.
HOT = 64
BLOCK = 128
#: Columns of a block's matrix of grams at a time.
COLUMNS = 8192

_TIMES = np.random.default_rng(23).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def kmer_hashes(words: np.ndarray, rows: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(occurrence-labelled hash of each k-mer, n+1 row offsets into them), in text order."""
    n = np.diff(rows)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(n)), count)
    start = rows[:-1][owner] + np.arange(at[-1]) - at[:-1][owner]
    h = np.zeros(len(start), np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    short = n[owner] < k
    for j in range(k):
        w = padded[start + j]
        if short.any():
            w = np.where(short & (j >= n[owner]), np.uint64(0), w)
        h = C.mix64(h * np.uint64(3) + w) if j else C.mix64(w)
    # number the occurrences: equal k-mers of a row lie side by side, in text order, after a stable sort
    key = C.mix64(h + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    first = np.ones(len(key), bool)
    first[1:] = key[order[1:]] != key[order[:-1]]
    place = np.arange(len(key))
    seen = np.empty(len(key), np.uint64)
    seen[order] = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    return C.mix64(h + seen * np.uint64(0xA24BAED4963EE407)), at


def sketches(kmers: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(rows, SKETCHES) of the rows that have k-mers."""
    has = np.flatnonzero(np.diff(at))
    begin = at[:-1][has]
    out = np.empty((len(has), SKETCHES), np.uint64)
    if not len(has):
        return out
    bits = np.uint64(max(20, int(len(kmers)).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    place = np.arange(len(kmers), dtype=np.uint64)
    for s in range(SKETCHES):
        v = ((kmers * _TIMES[s]) & ~mask) | place
        one = np.minimum.reduceat(v, begin) & mask
        v[one.astype(np.int64)] = _MAX
        two = np.minimum.reduceat(v, begin)
        none = two == _MAX
        two = np.where(none, one, two & mask)
        a, b = kmers[np.minimum(one, two).astype(np.int64)], kmers[np.maximum(one, two).astype(np.int64)]
        out[:, s] = C.mix64(C.mix64(a) + np.where(none, np.uint64(0), b) * np.uint64(5))
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, d1, d2, n_words, sketch): the digest of the whole text, and its sketches (none without words)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                words, rows = C.word_hashes(*C.text_bytes(part.column("_text")))
                kmers, at = kmer_hashes(words, rows)
                got = sketches(kmers, at).view(np.int64)
                has = np.diff(at) > 0
                offsets = np.concatenate([[0], np.cumsum(np.where(has, SKETCHES, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("d1"), part.column("d2"), pa.array(np.diff(rows), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(got.ravel()))],
                    ["_id", "d1", "d2", "n_words", "sketch"],
                )

    return digested(docs, id_col, text_col).mapInArrow(read, "_id long, d1 long, d2 long, n_words long, sketch array<long>")


def digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text, d1, d2): with 128 bits that stand for the text."""
    return C.id_and_text(docs, id_col, text_col).select("_id", "_text", F.xxhash64("_text").alias("d1"), F.xxhash64(F.lit(9), "_text").alias("d2"))


#: A document among others: its id, and its digest where ids are null or repeat.
NODE = "struct<_id: long, d1: long, d2: long>"


def node() -> Column:
    return F.struct("_id", "d1", "d2")


# --- alignment ---------------------------------------------------------------------------------------------------------


def banded_distance(a: Sequence, b: Sequence, most: int) -> int:
    """Levenshtein's distance of two sequences if it is at most ``most``, else ``most + 1``.

    Only the diagonals up to ``most`` off the main one are kept, as the bits of two integers (vertical differences +1 and -1)
    that slide down by one row with each column.
    """
    n, m = len(a), len(b)
    if n < m:
        a, b, n, m = b, a, m, n
    if n - m > most:
        return most + 1
    low = 0
    while low < m and a[low] == b[low]:
        low += 1
    high = 0
    while high < m - low and a[n - 1 - high] == b[m - 1 - high]:
        high += 1
    a, b = a[low : n - high], b[low : m - high]
    n, m = len(a), len(b)
    if not m:
        return n
    if most == 0:
        return 1
    most = min(most, n)
    width = 2 * most + 1
    every = (1 << width) - 1
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    # bit t of a column j (from 0) is row j - most + t; the highest one is the band's lowest row
    up, down = every ^ ((1 << most) - 1), 0
    distance, last = most, 1 << (width - 1)
    for j in range(m):
        shift = j - most
        at = where.get(b[j], 0)
        eq = (at >> shift if shift >= 0 else at << -shift) & every
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & every
        plus = down | (every & ~(diagonal | up))
        minus = diagonal & up
        if j < n - most:  # along the band's lowest diagonal
            distance += not diagonal & last
        else:  # along row n
            row = 1 << (n - 1 - shift)
            distance += bool(plus & row) - bool(minus & row)
        side = diagonal >> 1
        up = minus | (every & ~(side | plus))
        down = side & plus
    return min(distance, most + 1)


def similar(a: list[str], b: list[str], similarity: float) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    if longer - min(len(a), len(b)) > most or longer - sum((Counter(a) & Counter(b)).values()) > most:
        return False  # each word without its like costs one
    if len(a) > 1 < len(b) and longer - 1 - sum((Counter(zip(a, a[1:], strict=False)) & Counter(zip(b, b[1:], strict=False))).values()) > 2 * most:
        return False  # an edit takes two pairs of words at most
    return banded_distance(a, b, most) <= most


# --- candidates --------------------------------------------------------------------------------------------------------


def verified(docs: DataFrame, pairs: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(lead, node, ok) of stored pairs (lead, node): whether their texts align.

    ``SENT_PAIRS`` at a time are sent to the tasks that read the texts: a shuffle would take all texts twice.
    """
    texts = digested(docs, id_col, text_col).select(node().alias("node"), F.col("_text").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = None, []
        for batch in batches:
            ok = []
            for lead, text in zip(batch.column("lead_text"), batch.column("text"), strict=True):  # one by one: a batch may hold many long texts
                if (lead := lead.as_py()) != held:
                    held, words = lead, split_words(lead)
                ok.append(similar(words, split_words(text.as_py()), similarity))
            yield pa.RecordBatch.from_arrays([batch.column("lead"), batch.column("node"), pa.array(ok, pa.bool_())], ["lead", "node", "ok"])

    def judged(pairs: DataFrame) -> DataFrame:
        leads = pairs.select("lead").distinct()
        own = texts.join(F.broadcast(pairs), "node")
        theirs = texts.withColumnsRenamed({"node": "lead", "text": "lead_text"}).join(F.broadcast(leads), "lead", "left_semi")
        return own.join(theirs, "lead").select("lead", "node", "lead_text", "text").mapInArrow(read, f"lead {NODE}, node {NODE}, ok boolean")

    parts = -(-pairs.count() // SENT_PAIRS)
    if parts <= 1:
        return judged(pairs)
    parts += 1  # they are not quite equal
    done = [C.store(judged(pairs.filter(F.pmod(F.xxhash64(F.lit(3), "lead"), F.lit(parts)) == k)), "judged", free=True) for k in range(parts)]
    return functools.reduce(DataFrame.union, done)


#: White space to a blank, A-Z to a-z: as in ``common.word_spans``.
_FOLD = {i: " " for i in (9, 10, 11, 12, 13)} | {i: chr(i + 32) for i in range(65, 91)}


def split_words(text: str) -> list[str]:
    return [w for w in text.translate(_FOLD).split(" ") if w]


def links(docs: DataFrame, one_each: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(src, dst) of documents of different texts that align. one_each: stored signatures, one for each text."""
    found = C.empty(one_each.sparkSession, f"src {NODE}, dst {NODE}")
    bands = [F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), *[F.get("sketch", F.lit(PER_BAND * b + i)) for i in range(PER_BAND)]).alias("key")) for b in range(BANDS)]
    # a bucket's rows are short: its key (of the band, too) and the document's digest
    members = one_each.filter(F.size("sketch") > 0).select(F.col("d1").alias("doc"), F.inline(F.array(*bands)))
    used = PER_BAND
    while True:
        heads = members.groupBy("key").agg(F.min("doc").alias("lead_doc"), F.count("*").alias("n")).filter("n > 1")
        heads = C.store(heads.select("key", "lead_doc"), "heads", free=True)
        live = members.join(F.broadcast(heads) if heads.count() <= SENT_PAIRS else heads, "key").filter("doc != lead_doc")
        live = C.store(live.select("band", "key", "doc", "lead_doc"), "live", free=True)
        if not live.limit(1).count():
            return found
        pairs = named(live.select("lead_doc", "doc").distinct(), one_each)
        longer, shorter = F.greatest("n_words", "lead_words"), F.least("n_words", "lead_words")
        pairs = C.store(pairs.filter(longer - shorter <= F.floor((1 - similarity) * longer + 1e-9)).select("lead", "node"), "pairs", free=True)
        linked = C.store(verified(docs, pairs, similarity, id_col, text_col).filter("ok").select("lead", "node").distinct(), "linked", free=True)
        found = found.union(linked.select(F.col("lead").alias("src"), F.col("node").alias("dst")))
        done = linked.select(F.col("lead.d1").alias("lead_doc"), F.col("node.d1").alias("doc"))
        rest = live.join(done, ["lead_doc", "doc"], "left_anti").select("doc", "band", "key")
        if used < SKETCHES:  # as many sketches again into the key
            more = min(used, SKETCHES - used)
            one = [F.get("sketch", F.pmod(F.col("band") * PER_BAND + used + i, F.lit(SKETCHES))) for i in range(more)]
            rest = rest.join(one_each.select(F.col("d1").alias("doc"), "sketch"), "doc").select("doc", "band", F.xxhash64("key", *one).alias("key"))
            used += more
        members = C.store(rest, "members", free=True)


def named(pairs: DataFrame, one_each: DataFrame) -> DataFrame:
    """(lead, lead_words, node, n_words) of pairs (lead_doc, doc) of digests."""
    of = one_each.select(F.col("d1").alias("doc"), "node", "n_words")
    return pairs.join(of, "doc").join(of.withColumnsRenamed({"doc": "lead_doc", "node": "lead", "n_words": "lead_words"}), "lead_doc").select("lead", "lead_words", "node", "n_words")


def gram_size(similarity: float) -> int:
    """Words of a gram: as many as leave some to share after each edit's loss of so many; unrelated texts share few long ones."""
    return 4 if similarity >= 0.8 else 2 if similarity >= 0.75 else 1


def short_words(similarity: float, q: int) -> int:
    """The most words of a text that may share too few grams of ``q`` words with one that it aligns with."""
    few = 0
    for m in range(1, 200):
        most = int((1 - similarity) * m + 1e-9)
        if most and m - q + 1 - q * most < 1 + m // WORDS_A_SHARED:
            few = m
    return few


def gram_levels(texts: DataFrame, similarity: float, q: int = 0, least: int = COUNTED_FROM) -> np.ndarray:
    """The logarithm of the number of grams in each of ``2**SLOT_BITS`` slots, for (_text) of documents; 0 for less than ``least``."""
    q = q or gram_size(similarity)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                # no array of all slots in a worker: Spark adds the chunks up
                at, n = np.unique(_slots(kmer_hashes(*C.word_hashes(*C.text_bytes(part.column("_text"))), q)[0]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], ["slot", "n"])

    found = texts.mapInArrow(read, "slot int, n int").groupBy("slot").agg(F.sum("n").cast("int").alias("n")).filter(F.col("n") >= least)
    found = C.store(found, "gram-levels", free=True).toArrow()
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    levels[found["slot"].to_numpy()] = np.minimum(255, np.round(8 * np.log2(1.0 + found["n"].to_numpy())))
    return levels


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def all_grams(words: np.ndarray, rows: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(grams, their rows), row by row: the occurrence-labelled grams of each text, those of a short one of fewer words as well.

    Two texts that align, of ``m`` words the longer one, share ``needed`` of m at least: of its m - q + 1 grams of q words each
    edit takes q at most; the few lengths that leave none share a shorter one.
    """
    q = gram_size(similarity)
    grams, at = kmer_hashes(words, rows, q)
    n = np.diff(rows)
    owner = np.repeat(np.arange(len(n)), np.diff(at))
    if not (0 < n[n > 0].min(initial=1 << 62) <= short_words(similarity, q)):
        return grams, owner
    grams, owner = _with_shorter(words, n, q, similarity, grams, owner)
    order = np.argsort(owner, kind="stable")
    return grams[order], owner[order]


def needed(n: Column, similarity: float) -> Column:
    """The least number of grams that a text of ``n`` words shares with one that it aligns with, less one for each 100 words.

    The latter leave room for grams of one text whose hashes agree in the bits that a bucket compares.
    """
    q = gram_size(similarity)
    return F.greatest(F.lit(1), F.ceil((1 - q * (1 - similarity) - 0.01) * n - (q - 1) - 1e-6))


def _with_shorter(words: np.ndarray, n: np.ndarray, q: int, similarity: float, grams: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    while q > 1 and (short := (n > 0) & (n <= short_words(similarity, q))).any():
        q -= 1
        less, at = kmer_hashes(words[np.repeat(short, n)], np.concatenate([[0], np.cumsum(n[short])]), q)
        grams, owner = np.concatenate([grams, less]), np.concatenate([owner, np.repeat(np.flatnonzero(short), np.diff(at))])
    return grams, owner


def rare_grams(words: np.ndarray, rows: np.ndarray, levels: np.ndarray, similarity: float, q: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(grams, their rows): the rarest occurrence-labelled grams of each text, as many as a partner's can't all avoid.

    Of texts of n <= m words with ``e`` = (1 - similarity) m edits at most, m - q + 1 - q e grams of q words are shared; in one
    order for all texts, the first n (q (1 - similarity) + 1 / W) + 1 grams of both then share 1 + m / W, for any m. The few
    lengths that have no such number to share (up to 20 words at 0.8) get their grams of a word less as well, and so on.
    """
    q = q or gram_size(similarity)
    grams, at = kmer_hashes(words, rows, q)
    n, count = np.diff(rows), np.diff(at)
    owner = np.repeat(np.arange(len(n)), count)
    rank = levels[_slots(grams)].astype(np.uint64)
    # owner, rarity and as much of the gram as there is room for; all that are equal to the last one are taken too
    low = np.uint64(14)
    bits = np.uint64(max(1, len(n).bit_length()))
    key = (owner.astype(np.uint64) << (np.uint64(64) - bits)) | (rank << (np.uint64(64) - bits - low)) | (grams >> (bits + low))
    order = np.argsort(key)
    take = np.minimum(count, np.floor((q * (1 - similarity) + 1 / WORDS_A_SHARED) * n + 1e-6).astype(np.int64) + 1)
    has = count > 0
    last = np.zeros(len(n), np.uint64)
    last[has] = key[order[(at[:-1] + take - 1)[has]]]
    chosen = np.flatnonzero(key <= last[owner])
    return _with_shorter(words, n, q, similarity, grams[chosen], owner[chosen])


def gram_blobs(texts: DataFrame, levels, similarity: float, q: int, buckets: int) -> DataFrame:
    """(bucket, doc, part, n, gram): the rare grams of ``q`` words of (_text, doc, part), dealt by gram; a row holds those of many documents.

    ``doc``, ``part`` (as its difference from ``doc``, mostly 0) and ``n`` are arrays as bytes, one item a document; ``gram`` has
    the lower five bytes of each of their ``n`` grams; two that agree in these and in the bucket only add a shared one.
    """
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in C.chunks(batch, "_text", 1 << 22):
                parts, row = [], 0
                for part in C.chunks(chunk, "_text", RANKED_BYTES):
                    some, of = rare_grams(*C.word_hashes(*C.text_bytes(part.column("_text"))), levels.value, similarity, q)
                    parts.append((some, of + row))
                    row += part.num_rows
                grams, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
                bucket = (grams >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(grams), np.int64)
                order = np.argsort(bucket * chunk.num_rows + owner, kind="stable")
                grams, owner, bucket = grams[order], owner[order], bucket[order]
                doc, part = (chunk.column(c).to_numpy() for c in ("doc", "part"))
                out: dict[str, list] = {c: [] for c in ("bucket", "doc", "part", "n", "gram")}
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                for low, high in zip(at, [*at[1:], len(bucket)], strict=True):
                    of, n = np.unique(owner[low:high], return_counts=True)
                    out["bucket"].append(int(bucket[low]))
                    for c, x in (("doc", doc[of]), ("part", part[of] ^ doc[of]), ("n", n.astype(np.int32)), ("gram", grams[low:high, None].view(np.uint8)[:, :GRAM_BYTES])):
                        out[c].append(x.tobytes())
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("doc", "part", "n", "gram")]]))

    return texts.select("_text", "doc", "part").mapInArrow(read, "bucket int, doc binary, part binary, n binary, gram binary")


def holders(blobs: pa.Table) -> pa.Table:
    """(set, holders, first, doc, n) of a bucket: ``n`` grams that documents of several parts hold, the same ones; ``set`` stands for these."""
    doc, part, n = (np.frombuffer(b"".join(blobs.column(c).to_pylist()), t) for c, t in (("doc", np.int64), ("part", np.int64), ("n", np.int32)))
    part = part ^ doc
    raw = np.frombuffer(b"".join(blobs.column("gram").to_pylist()), np.uint8).reshape(-1, GRAM_BYTES)
    gram = np.zeros((len(raw), 8), np.uint8)
    gram[:, :GRAM_BYTES] = raw
    del raw
    gram = gram.view(np.uint64).ravel()
    order = np.argsort(gram)
    gram = gram[order]
    begins = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    size = np.diff(np.append(begins, len(gram)))
    del gram
    of = np.repeat(np.arange(len(doc), dtype=np.int32), n)[order]
    del order
    of, size = of[np.repeat(size > 1, size)], size[size > 1]  # most are held by one document
    begins = np.cumsum(size) - size
    if len(size):
        mixed = np.minimum.reduceat(part[of], begins) < np.maximum.reduceat(part[of], begins)
        of, size = of[np.repeat(mixed, size)], size[mixed]
        begins = np.cumsum(size) - size
    names = ["set", "holders", "first", "doc", "n"]
    if not len(size):
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())], names)
    first = np.minimum.reduceat(doc[of], begins)
    key = C.mix64(np.bitwise_xor.reduceat(C.mix64(doc.view(np.uint64))[of], begins) + size.astype(np.uint64))
    # grams of one set become one
    key, at, times = np.unique(key, return_index=True, return_counts=True)
    begins, size, first = begins[at], size[at], first[at]
    of = of[np.repeat(begins - np.cumsum(size) + size, size) + np.arange(size.sum())]
    return pa.table([pa.array(x) for x in (np.repeat(key.view(np.int64), size), np.repeat(size, size), np.repeat(first, size), doc[of], np.repeat(times, size))], names)


def planes(x: np.ndarray) -> bytes:
    """The bytes of numbers, all first ones first: high bytes that are 0 lie together and compress."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def from_planes(blobs: pa.ChunkedArray, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.concatenate([np.zeros(0, kind), *[np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel() for b in blobs.to_pylist()]])


def gram_lists(texts: DataFrame, similarity: float, buckets: int) -> DataFrame:
    """(bucket, doc, part, n_words, n, gram): all grams of (_text, doc, part), dealt by gram; a row holds those of many documents.

    ``doc`` and ``part`` (as its difference from ``doc``, mostly 0) are the lower four bytes of theirs, ``n_words`` and ``n`` numbers,
    one item a document; ``gram`` has the lower four bytes of each of their ``n`` grams.
    """
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in C.chunks(batch, "_text", 1 << 22):
                found, lengths, row = [], [], 0
                for some in C.chunks(chunk, "_text", RANKED_BYTES):
                    words, rows = C.word_hashes(*C.text_bytes(some.column("_text")))
                    grams, owner = all_grams(words, rows, similarity)
                    found.append(((grams >> shift).astype(np.uint16), grams.astype(np.uint32), (owner + row).astype(np.int32)))
                    lengths.append(np.diff(rows))
                    row += some.num_rows
                bucket, grams, owner = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(bucket, kind="stable")  # texts stay in their order
                bucket, grams, owner = bucket[order], grams[order], owner[order]
                del found, order
                begins = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])])) if len(bucket) else np.zeros(0, np.int64)
                n, of = np.diff(np.append(begins, len(bucket))).astype(np.int32), owner[begins]
                doc, part = (chunk.column(c).to_numpy().astype(np.uint32) for c in ("doc", "part"))
                each = {"doc": doc[of], "part": (part ^ doc)[of], "n_words": np.concatenate(lengths).astype(np.int32)[of], "n": n}
                here = bucket[begins]
                at = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])) if len(here) else np.zeros(0, np.int64)
                ends, grams_at = np.append(at, len(here)), np.append(begins, len(bucket))
                out = {"bucket": here[at].astype(np.int32)} | {c: [planes(x[i:j]) for i, j in zip(ends, ends[1:])] for c, x in each.items()}  # noqa: B905
                out["gram"] = [grams[grams_at[i] : grams_at[j]].tobytes() for i, j in zip(ends, ends[1:])]  # noqa: B905
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("doc", "part", "n_words", "n", "gram")]]))

    return texts.select("_text", "doc", "part").mapInArrow(read, "bucket int, doc binary, part binary, n_words binary, n binary, gram binary")


def votes(blobs: pa.Table, similarity: float, hot_from: int, shares: int) -> pa.Table:
    """(share, doc, vote, n) of a bucket: with how many grams of a document some other one stands for a vote, packed by share of documents.

    A vote is a byte of the other document's hash; only one of another part and of a length that may align has one. A gram with more
    than ``hot_from`` holders is one vote, for ``ANY``. Documents that agree in four bytes of their hash get their votes together.
    """
    doc, part, n_words, n = (from_planes(blobs.column(c), t) for c, t in (("doc", np.uint32), ("part", np.uint32), ("n_words", np.int32), ("n", np.int32)))
    gram = np.frombuffer(b"".join(blobs.column("gram").to_pylist()), np.uint32)
    known, at, of = np.unique(doc, return_index=True, return_inverse=True)  # copies of a text are one
    part, n_words = part ^ doc, n_words.astype(np.int64)
    unsure = np.zeros(len(known), bool)
    unsure[of[(part != part[at][of]) | (n_words != n_words[at][of])]] = True
    part, n_words, any_unsure = part[at], n_words[at], bool(unsure.any())
    other = (C.mix64(known.astype(np.uint64)) % np.uint64(ANY)).astype(np.int64)
    of = np.repeat(of.astype(np.uint32), n)
    most = np.floor((1 - similarity) * n_words + 1e-9).astype(np.int64)
    slices = 1 << max(0, (len(gram) // VOTE_GRAMS).bit_length())
    keys, times = [], []
    for k in range(slices):
        some = slice(None) if slices == 1 else gram >> np.uint32(33 - slices.bit_length()) == k
        key = (gram[some].astype(np.uint64) << np.uint64(32)) | of[some]
        key.sort()  # np.unique would use a hash table, which takes ten times as long
        key = key[np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]])]
        mine = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        key >>= np.uint64(32)
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(begins, len(key)))
        mine, size = mine[np.repeat(size > 1, size)], size[size > 1]
        begins = np.cumsum(size) - size
        if not len(size):
            continue
        mixed = np.minimum.reduceat(part[mine], begins) < np.maximum.reduceat(part[mine], begins)
        if any_unsure:
            mixed |= np.logical_or.reduceat(unsure[mine], begins)
        hot = mixed & (size > hot_from)
        found = [mine[np.repeat(hot, size)] << 8 | ANY]
        mixed &= ~hot
        mine, size = mine[np.repeat(mixed, size)], size[mixed]
        first = np.repeat(np.cumsum(size) - size, size)
        size = np.repeat(size, size)
        place = np.arange(len(mine)) - first
        for r in range(1, int(size.max(initial=1))):
            if r > 1:
                here = size > r
                whom = first[here] + (place[here] + r) % size[here]
                a = mine[here]
            else:
                whom, a = first + (place + 1) % size, mine
            b = mine[whom]
            longer = np.where(n_words[a] < n_words[b], b, a)
            ok = (part[a] != part[b]) & (np.abs(n_words[a] - n_words[b]) <= most[longer])
            if any_unsure:
                ok |= unsure[a] | unsure[b]
            found.append(a[ok] << 8 | other[b[ok]])
        key, count = np.unique(np.concatenate(found), return_counts=True)
        keys.append(key)
        times.append(count)
    key, inverse = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
    count = np.bincount(inverse, np.concatenate([np.zeros(0), *times]), len(key)).astype(np.int32)
    whose, vote = known[key >> 8], (key & 255).astype(np.uint8)
    ends = np.searchsorted(whose, (np.arange(shares + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(shares))
    has = np.flatnonzero(np.diff(ends))
    return pa.table([pa.array(has, pa.int32()), *[pa.array([planes(x[ends[k] : ends[k + 1]]) for k in has], pa.binary()) for x in (whose, vote, count)]], ["share", "doc", "vote", "n"])


def best_votes(cast: pa.Table) -> pa.Table:
    """(low, n) of a share: the most grams that any one other document may share with each document."""
    doc, vote, n = (from_planes(cast.column(c), t) for c, t in (("doc", np.uint32), ("vote", np.uint8), ("n", np.int32)))
    key, inverse = np.unique(doc.astype(np.int64) << 8 | vote, return_inverse=True)
    n = np.bincount(inverse, n, len(key)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], key[1:] >> 8 != key[:-1] >> 8]))
    hot = np.where(key & 255 == ANY, n, 0)
    most = np.maximum.reduceat(n - hot, begins) + np.maximum.reduceat(hot, begins)
    return pa.table([pa.array(key[begins] >> 8), pa.array(most)], ["low", "n"])


def may_align(texts: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those of stored ``nodes`` that may share enough grams with some document of another part.

    No text is shuffled, and no row is made for a gram or a pair: grams travel as lists, votes as lists of bytes.
    """
    own = texts.select("_text", F.col("node.d1").alias("doc"))
    moved = nodes.filter("part != node.d1").select(F.col("node.d1").alias("doc"), "part")
    own = own.join(F.broadcast(moved) if moved.count() <= SENT_PAIRS else moved, "doc", "left")
    buckets = 1 << min(16, max(6, ((nodes.agg(F.sum("n_words")).first()[0] or 0) // VOTE_WORDS).bit_length()))
    lists = gram_lists(own.select("_text", "doc", F.coalesce("part", "doc").alias("part")), similarity, buckets)
    hot = HOT
    cast = lists.groupBy("bucket").applyInArrow(lambda t: votes(t, similarity, hot, buckets), "share int, doc binary, vote binary, n binary")
    most = cast.groupBy("share").applyInArrow(best_votes, "low long, n long")
    joined = nodes.withColumn("low", F.col("node.d1").bitwiseAND(F.lit(0xFFFFFFFF))).join(most, "low")
    return C.store(joined.filter(F.col("n") >= needed(F.col("n_words"), similarity)).select(*nodes.columns), "may-align", free=True)


def missed_links(docs: DataFrame, one_each: DataFrame, groups: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(src, dst) of all documents that align and are in different ``groups`` (node, component).

    Those that share a common gram may be many and have little else in common, as texts with the same lines: they are compared
    once more by their rarer word pairs, most of which two of them must share, and only then block by block.
    """
    nodes = one_each.filter(F.size("sketch") > 0).join(groups, "node").select("node", "n_words", "copies", F.col("component.d1").alias("part"))
    nodes = C.store(nodes, "parts", free=True)
    texts = digested(docs, id_col, text_col).select(node().alias("node"), "_text")
    nodes = may_align(texts, nodes, similarity)
    pairs, crowd = sharing(texts, nodes, similarity, gram_size(similarity))
    if gram_size(similarity) > 2 and crowd.limit(1).count():
        again = crowd.select(F.col("doc").alias("at")).distinct()
        more, crowd = sharing(texts, nodes.join(again, F.col("node.d1") == F.col("at"), "left_semi"), similarity, 2)
        pairs = pairs.union(more)
    crowded = crowded_links(texts, nodes.select("node"), crowd, similarity)
    pairs = C.store(named(pairs.distinct(), nodes.withColumn("d1", F.col("node.d1"))).select("lead", "node"), "pairs", free=True)
    found = verified(docs, pairs, similarity, id_col, text_col).filter("ok")
    return C.store(found.select(F.col("lead").alias("src"), F.col("node").alias("dst")).union(crowded).distinct(), "missed-links", free=True)


def sharing(texts: DataFrame, nodes: DataFrame, similarity: float, q: int) -> tuple[DataFrame, DataFrame]:
    """Stored (lead_doc, doc) that share enough rare grams of ``q`` words, and (first, doc, n_words, part) of those that many hold.

    Pairs that share a gram of the latter are all in there, and need not be among the former.
    """
    spark = texts.sparkSession
    several, n_words = nodes.agg(F.count("*"), F.sum("n_words")).first()
    buckets = 1 << max(6, ((n_words or 0) // BUCKET_WORDS).bit_length())
    own = texts.join(F.broadcast(nodes) if several <= SENT_PAIRS else nodes, "node")
    # rows that repeat id and text are one
    own = own.filter("copies = 1").unionByName(own.filter("copies > 1").dropDuplicates(["node"]))
    levels = spark.sparkContext.broadcast(gram_levels(own.select("_text"), similarity, q, max(COUNTED_FROM, (n_words or 0) // SENT_SLOTS)))
    blobs = gram_blobs(own.select("_text", F.col("node.d1").alias("doc"), "part"), levels, similarity, q, buckets)
    every = blobs.groupBy("bucket").applyInArrow(holders, "set long, holders long, first long, doc long, n long")
    # grams that the same documents hold are one, whose number counts: a passage makes no row for each of its grams
    every = C.store(every.groupBy("set", "holders", "first", "doc").agg(F.sum("n").alias("n")), "mixed-grams", free=True)
    # a document with fewer than a partner would share has none
    known = nodes.select(F.col("node.d1").alias("doc"), F.col("n_words").cast("int").alias("n_words"), "part").distinct()
    known = every.groupBy("doc").agg(F.sum("n").alias("shared")).join(known, "doc").filter(F.col("shared") > F.floor(F.col("n_words") / WORDS_A_SHARED))
    known = C.store(known.select("doc", "n_words", "part"), "partners", free=True)
    known = F.broadcast(known) if known.count() <= SENT_PAIRS else known
    crowd = every.filter(F.col("holders") > HOT).select("first", "doc").distinct().join(known, "doc").select("first", "doc", "n_words", "part")
    crowd = C.store(crowd, "crowd", free=True)
    held = C.store(every.filter(F.col("holders") <= HOT).select("set", "doc", "n").join(known, "doc"), "held", free=True)
    a, b = (held.withColumnsRenamed({c: f"{x}_{c}" for c in ("doc", "n", "n_words", "part")}) for x in "ab")
    longer, shorter = F.greatest("a_n_words", "b_n_words"), F.least("a_n_words", "b_n_words")
    both = a.join(b, "set").filter((F.col("a_doc") < F.col("b_doc")) & (F.col("a_part") != F.col("b_part")) & (longer - shorter <= F.floor((1 - similarity) * longer + 1e-9)))
    both = both.groupBy("a_doc", "b_doc").agg(F.sum("a_n").alias("shared"), F.max(longer).alias("longer")).filter(F.col("shared") > F.floor(F.col("longer") / WORDS_A_SHARED))
    return C.store(both.select(F.col("a_doc").alias("lead_doc"), F.col("b_doc").alias("doc")), "candidates", free=True), crowd


def crowded_links(texts: DataFrame, nodes: DataFrame, crowd: DataFrame, similarity: float) -> DataFrame:
    """(src, dst) of the documents of stored ``crowd`` (first, doc, n_words, part) that have one ``first``, different parts and align.

    Those of one ``first`` are dealt by length, such that only neighbouring lengths can align, and then into blocks; a task gets
    two blocks. Of documents with several in common, the smallest ``first`` compares them.
    """
    step = max(-math.log(similarity), 1e-3) * (1 + 1e-6)
    crowd = crowd.withColumn("size", F.floor(F.log("n_words") / step).cast("int"))
    blocks = crowd.groupBy("first", "size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = blocks.groupBy("first").agg(F.map_from_entries(F.collect_list(F.struct("size", "blocks"))).alias("blocks"))
    firsts = crowd.groupBy("doc").agg(F.sort_array(F.collect_set("first")).alias("firsts"))
    dealt = crowd.join(blocks, "first").withColumn("block", F.pmod(F.xxhash64("doc"), F.element_at("blocks", F.col("size"))).cast("int"))

    def beside(size: Column, make) -> Column:
        n = F.try_element_at("blocks", size)
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make)).otherwise(F.array().cast("array<struct<x_size: int, x: int, y_size: int, y: int>>"))

    def pair(x_size: Column, x: Column, y_size: Column, y: Column) -> Column:
        return F.struct(x_size.alias("x_size"), x.alias("x"), y_size.alias("y_size"), y.alias("y"))

    size, block = F.col("size"), F.col("block")
    both = F.concat(
        beside(size, lambda k: pair(size, F.least(block, k), size, F.greatest(block, k))),
        beside(size + 1, lambda k: pair(size, block, size + 1, k)),
        beside(size - 1, lambda k: pair(size - 1, k, size, block)),
    )
    key = ["first", "x_size", "x", "y_size", "y"]
    members = dealt.select("first", "doc", "part", "size", "block", F.inline(both))
    of_pair = Window.partitionBy(*key)
    members = members.withColumns({"low": F.min("part").over(of_pair), "high": F.max("part").over(of_pair)}).filter("low < high").drop("low", "high")
    members = C.store(members.join(firsts, "doc"), "crowd-blocks", free=True)
    few = members.count() <= SENT_PAIRS
    there = nodes.join(members.select(F.col("doc").alias("at")).distinct(), F.col("node.d1") == F.col("at")).select("node")
    own = texts.join(F.broadcast(there) if few else there, "node").dropDuplicates(["node"]).withColumn("at", F.col("node.d1"))
    rows = own.join(F.broadcast(members) if few else members, F.col("at") == F.col("doc")).select(*key, "node", "part", "size", "block", "firsts", "_text")

    def compare(held: pa.Table) -> pa.Table:
        first, x_size, x, y_size, y = (held.column(c)[0].as_py() for c in key)
        words, at = C.word_hashes(*C.text_bytes(held.column("_text")))
        n, part = np.diff(at), held.column("part").to_numpy()
        size, block = held.column("size").to_numpy(), held.column("block").to_numpy()
        one, two = (np.flatnonzero((size == s) & (block == b)) for s, b in ((x_size, x), (y_size, y)))
        longer, shorter = np.maximum(n[one][:, None], n[two]), np.minimum(n[one][:, None], n[two])
        most = np.floor((1 - similarity) * longer + 1e-9).astype(np.int64)
        ok = (part[one][:, None] != part[two]) & (longer - shorter <= most)
        if (x_size, x) == (y_size, y):
            ok &= one[:, None] < two
        for q in {1, min(2, gram_size(similarity))}:  # each edit takes q grams at most
            ok &= shared_grams(words, at, one, two, q) >= longer - q + 1 - q * most
        firsts = [set(f) for f in held.column("firsts").to_pylist()]
        split: dict[int, list[str]] = {}
        a, b = [], []
        for i, j in np.argwhere(ok):
            left, right = int(one[i]), int(two[j])
            if min(firsts[left] & firsts[right]) != first:
                continue
            for k in (left, right):
                if k not in split:
                    split[k] = split_words(held.column("_text")[k].as_py())
            if banded_distance(split[left], split[right], int(most[i, j])) <= most[i, j]:
                a.append(left)
                b.append(right)
        fields = dict(zip(("_id", "d1", "d2"), held.column("node").combine_chunks().flatten(), strict=True))
        return pa.table({x: pa.StructArray.from_arrays([v.take(pa.array(i, pa.int64())) for v in fields.values()], list(fields)) for x, i in (("src", a), ("dst", b))})

    return C.store(rows.groupBy(*key).applyInArrow(compare, f"src {NODE}, dst {NODE}"), "crowded-links", free=True)


def shared_grams(words: np.ndarray, rows: np.ndarray, one: np.ndarray, two: np.ndarray, q: int) -> np.ndarray:
    """(one, two): the number of occurrence-labelled grams that two texts share."""
    grams, at = kmer_hashes(words, rows, q)
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(at))
    _, column, n = np.unique(grams, return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1
    often = np.flatnonzero(n[column] > 1)
    column, owner = place[column[often]], owner[often]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(one), len(two)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        begin, end = np.searchsorted(column, [low, low + COLUMNS])
        has = np.zeros((len(rows) - 1, COLUMNS), np.float32)
        has[owner[begin:end], column[begin:end] - low] = 1
        out += has[one] @ has[two].T
    return out.astype(np.int64)


def classes(docs: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(_id, d1, d2, first) of every row of ``docs``: ``first`` is the smallest document of its class."""
    signed = C.store(signatures(docs, id_col, text_col), "signatures", free=True)
    # equal texts: their smallest id stands for them
    one_each = signed.groupBy("d1", "d2").agg(F.min(F.struct("_id", "n_words", "sketch")).alias("m"), F.count("*").alias("copies")).select("d1", "d2", "m.*", "copies")
    one_each = C.store(one_each.select("d1", "d2", node().alias("node"), "n_words", "sketch", "copies"), "one-each", free=True)
    found = links(docs, one_each, similarity, id_col, text_col)
    groups = C.store(C.components(one_each.select("node"), found), "groups")
    more = missed_links(docs, one_each, groups, similarity, id_col, text_col)
    if more.limit(1).count():
        joined = groups.filter(F.col("node") != F.col("component")).select(F.col("node").alias("src"), F.col("component").alias("dst"))
        groups = C.components(one_each.select("node"), joined.union(more))
    named = C.store(groups.select("node.d1", "node.d2", F.col("component").alias("first")), "classes", free=True)
    return signed.select("_id", "d1", "d2").join(named, ["d1", "d2"])


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, class_id, kept) of every row of ``docs``."""
    return classes(docs, similarity, id_col, text_col).select("_id", F.col("first._id").alias("class_id"), (node() == F.col("first")).alias("kept"))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of the smallest document of each class, rows that repeat id and text once."""
    found = classes(docs, similarity, id_col, text_col)
    keep = C.store(found.filter(node() == F.col("first")).select("_id", "d1", "d2").distinct(), "kept")
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs[id_col].cast("long"), F.lit(C.NO_ID)).alias("_id"),
        F.xxhash64(text).alias("d1"),
        F.xxhash64(F.lit(9), text).alias("d2"),
    )
    rows = rows.join(keep, ["_id", "d1", "d2"], "left_semi").dropDuplicates(["_id", "d1", "d2"])
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
