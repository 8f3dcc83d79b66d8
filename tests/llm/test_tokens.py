"""Token counts, token files, packing: against the library, by round trip and by their rules."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import ROOT
from llm_cases import awkward, empty, shipped, texts  # noqa: F401
from tokenizers import Tokenizer

from leadflow.llm import common as C
from leadflow.llm import packing as P
from leadflow.llm import queries as Q
from leadflow.llm import token_files as W
from leadflow.llm.elias_fano import EliasFano
from leadflow.llm.token_counts import token_counts
from leadflow.llm.tokens import Encoder, default_vocabulary, encoder
from leadflow.llm.tokens import blocks as P_blocks

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def library():
    return Tokenizer.from_file(default_vocabulary())


def test_pieces_are_exact(library):
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "'s", "'", "1", "23", ",", ".", "!!", "<|endoftext|>", " ", "\x1c", "\x85", "᠎", "　", "word", "Word,", "\r\n", "🎉", "​", "\0", "don't", "ß", "×", "x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(8000)]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(4000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for step in (len(texts), 700):
        for low in range(0, len(texts), step):
            column = pa.array(texts[low : low + step])
            ids, at = encoder(default_vocabulary()).ids(column)
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want[low : low + step]
            assert encoder(default_vocabulary()).counts(column).tolist() == [len(w) for w in want[low : low + step]]


def thue_morse(signs=11):
    """Two words that every polynomial hash in 2^64 takes for one."""
    a, b = "a", "b"
    for _ in range(signs):
        a, b = a + b, b + a
    return a, b


def test_words_of_one_hash_are_told_apart(library, monkeypatch):
    a, b = thue_morse()
    texts = [f"x{a}y", f"x{b}y", f"the x{a}y of", f"the\nx{b}y, of", "plain words", f"x{b}y"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert want[0] != want[1]
    body, at = C.text_bytes(pa.array(texts[:2]))
    assert len(set(C.span_hashes(body, at[:-1], at[1:]).tolist())) == 1
    for long in (256, 1 << 20):  # as words that aren't kept, and as words of the table
        monkeypatch.setattr("leadflow.llm.tokens.LONG", long)
        for step in (1, 2, 3, len(texts)):  # in one batch and in several
            one = Encoder(default_vocabulary())
            for low in range(0, len(texts), step):
                column = pa.array(texts[low : low + step])
                ids, at = one.ids(column)
                assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == want[low : low + step]
                assert one.counts(column).tolist() == [len(w) for w in want[low : low + step]]


def test_colliding_words_in_the_operators(spark, library):
    a, b = thue_morse()
    texts = {1: f"x{a}y", 2: f"x{b}y", 3: f"x{a}y and x{b}y"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    want = {i: ids_of(library, t) for i, t in texts.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, default_vocabulary()).collect()} == {i: len(x) - 1 for i, x in want.items()}
    folder = C.scratch_dir(spark, "files-test")
    got = W.read_shards(spark, W.write_shards(docs, folder, default_vocabulary()), folder).collect()
    assert {r["_id"]: (r["n_tokens"], r["ids_crc32"]) for r in got} == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in want.items()}
    check_packed(P.pack(docs, default_vocabulary(), 512).withColumnRenamed("_id", "doc_id").collect(), texts, library, 512)


@pytest.mark.parametrize("seed", range(3))
def test_every_hash_alike(monkeypatch, library, seed):
    """Even if all words had one of three hashes, ids are the library's."""
    real = C.span_hashes
    monkeypatch.setattr("leadflow.llm.common.span_hashes", lambda body, starts, ends: real(body, starts, ends) % np.uint64(3))
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["a", "bc", "the", "x,y", "é", "\n1"]) for _ in range(rng.randint(1, 5))).strip() for _ in range(60)]
    one = Encoder(default_vocabulary())
    for low in range(0, 60, 20):
        ids, at = one.ids(pa.array(texts[low : low + 20]))
        assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == [e.ids for e in library.encode_batch(texts[low : low + 20], add_special_tokens=False)]


def test_spans_of_all_sizes():
    rng = np.random.default_rng(2)
    body = rng.integers(97, 99, 4000).astype(np.uint8)
    at, other, size = rng.integers(0, 3900, 3000), rng.integers(0, 3900, 3000), rng.integers(0, 40, 3000)
    from leadflow.llm.tokens import eights, equal_spans
    got = equal_spans(eights(body), at, eights(body), other, size)
    assert got.tolist() == [bytes(body[i : i + n]) == bytes(body[j : j + n]) for i, j, n in zip(at, other, size)] and got.any() and not got.all()


def test_big_texts_are_encoded_in_blocks(library, monkeypatch):
    rng = random.Random(9)
    parts = ["word", "Zwei,", "é", "中文", "  ", "\n", "\n\n", "\u00a0", "\u3000", "\t", "<|endoftext|>", "1,000", "don't", "x" * 300]
    for seed in range(40):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 200)))
        body = np.frombuffer(text.encode(), np.uint8)
        assert "".join(list(P_blocks(body, 64))) == text
        monkeypatch.setattr("leadflow.llm.tokens.BIG", 100)
        monkeypatch.setattr("leadflow.llm.tokens.BLOCK", 64)
        column = pa.array(["a b", text, "", "c"])
        want = [e.ids for e in library.encode_batch(column.to_pylist(), add_special_tokens=False)]
        ids, at = encoder(default_vocabulary()).ids(column)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
        assert encoder(default_vocabulary()).counts(column).tolist() == [len(w) for w in want]


def test_memory_of_a_very_long_text(tmp_path):
    """Counting a text of 16 MB takes less than 400 MB beside it."""
    import os
    import subprocess
    import sys

    code = """
import resource, sys
import pyarrow as pa
from leadflow.llm.tokens import default_vocabulary, encoder
one = encoder(default_vocabulary())
one.counts(pa.array(["a few words to begin with"]))
column = pa.array(["some words, of many kinds and sizes; number %d\\n" % k * 20 for k in range(100)])
text = pa.array(["".join(column.to_pylist()) * 200])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = one.counts(text)[0]
print(len(text[0].as_py()), n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": ROOT})
    size, n, grown = map(int, out.stdout.split())
    assert size > 16_000_000 and n > size / 10 and grown < 400, out.stdout


def test_a_third_without_an_id(spark, library):
    """Null ids and equal rows fill several shards and buckets, and come back whole."""
    rows = [(None, f"text number {k}") for k in range(2000)] + [(None, "one and the same")] * 2000 + [(k, f"text {k}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = C.scratch_dir(spark, "files-test")
        shards = W.write_shards(docs, folder, default_vocabulary())
        sizes = [r["n_docs"] for r in shards.collect()]
        assert sum(sizes) == 6000 and max(sizes) < 1800
        got = Counter((r["_id"], r["ids_crc32"]) for r in W.read_shards(spark, shards, folder).collect())
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    crc = {t: zlib.crc32(ids_of(library, t).tobytes()) for t in {t for _, t in rows}}
    assert got == Counter((C.NO_ID if i is None else i, crc[t]) for i, t in rows)
    pieces = C.store(P.token_pieces(docs, default_vocabulary(), 64).withColumn("row", P.F.monotonically_increasing_id()), "pieces")
    buckets = pieces.groupBy(P.F.pmod(P.F.xxhash64("_id", "piece", "row"), P.F.lit(6))).count().collect()
    assert max(r["count"] for r in buckets) < 1300
    ranks = P.ranked(pieces, 6000, 1000).groupBy("length").agg(P.F.count("*").alias("n"), P.F.countDistinct("rank").alias("d"), P.F.max("rank").alias("m")).collect()
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in ranks)


def test_the_table_is_bounded(monkeypatch):
    monkeypatch.setattr("leadflow.llm.tokens.TABLE_WORDS", 50)
    small = Encoder(default_vocabulary())
    for low in range(0, 500, 20):
        column = pa.array([f"number{k} of many, many\nlines" for k in range(low, low + 20)])
        assert small.counts(column).tolist() == encoder(default_vocabulary()).counts(column).tolist()
        assert len(small.table) <= 50


def test_counts(spark, awkward, empty, library):
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in awkward.collect()), key=str)
    got = token_counts(awkward, default_vocabulary(), 1024).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=str) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert token_counts(empty, default_vocabulary()).count() == 0


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@pytest.mark.parametrize("seed", range(20))
def test_elias_fano(seed):
    rng = np.random.default_rng(seed)
    v = np.sort(rng.integers(-5, int(rng.choice([10, 10**5, 10**12])), rng.integers(0, 3000)))
    e = EliasFano.from_bytes(EliasFano.of(v).to_bytes())
    assert len(e) == len(v) and np.array_equal(e.read(0, len(v)), v)
    for _ in range(20):
        a, b = sorted(rng.integers(0, len(v) + 1, 2))
        assert np.array_equal(e.read(a, b), v[a:b])
    if len(v) > 100:
        spread = int(v[-1] - v[0]) / len(v)
        assert len(EliasFano.of(v).to_bytes()) * 8 / len(v) < 3 + max(0, np.log2(spread + 1)) + 64 / 256 + 400 / len(v) * 8


def test_token_files_round_trip(spark, texts, library):
    rows = sorted(Q.QUERIES["op4_token_files"](spark, MID).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == sorted(texts)
    start = 0
    for r in rows:
        ids = ids_of(library, texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_awkward(spark, awkward, empty, library):
    folder = C.scratch_dir(spark, "files-test")
    shards = W.write_shards(awkward.repartition(3), folder, default_vocabulary())
    got = sorted(((r["_id"], r["n_tokens"], r["ids_crc32"]) for r in W.read_shards(spark, shards, folder, block=100).collect()))
    want = sorted((C.NO_ID if r["doc_id"] is None else r["doc_id"], len(x := ids_of(library, r["text"])), zlib.crc32(x.tobytes())) for r in awkward.collect())
    assert got == want
    one = shards.orderBy("shard").first()
    shard = W.Shard(folder, one["shard"], one["width"])
    by_id = defaultdict(list)
    for r in awkward.collect():
        by_id[C.NO_ID if r["doc_id"] is None else r["doc_id"]].append(ids_of(library, r["text"]).tolist())
    for k in range(one["n_docs"]):
        assert shard.document(k).tolist() in by_id[shard.owners[k]]
    folder = C.scratch_dir(spark, "files-test")
    assert W.read_shards(spark, W.write_shards(empty, folder, default_vocabulary()), folder).count() == 0


# --- packing -----------------------------------------------------------------------------------------------------------


def check_packed(rows, texts, library, capacity):
    places = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for i, want in texts.items():
        ids = ids_of(library, want)
        at = 0
        for k, (piece, start, length, crc) in enumerate(sorted(pieces[i])):
            assert (piece, start) == (k, at) and zlib.crc32(ids[at : at + length].tobytes()) == crc
            assert k == 0 or length == capacity
            at += length
        assert at == len(ids)
        assert len(pieces[i]) == -(-len(ids) // capacity)
    return len(places), -(-sum(r["length"] for r in rows) // capacity)


def test_packing(spark, texts, library):
    used, least = check_packed(Q.QUERIES["op7_best_fit_packing"](spark, MID).collect(), texts, library, 2048)
    assert used <= least * 1.01 + 1


def test_packing_awkward(spark, awkward, empty, library):
    rows = P.pack(awkward, default_vocabulary(), 64).withColumnRenamed("_id", "doc_id").collect()
    once = {C.NO_ID if r["doc_id"] is None else r["doc_id"]: r["text"] for r in awkward.collect()}
    doubled = [r for r in rows if r["doc_id"] == 6]
    assert len(doubled) % 2 == 0 and len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    # the pieces of the two equal rows are the same: check_packed sees each document once, places of both are gapless
    twin = once.pop(6)
    pieces = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in doubled)
    assert pieces[::2] == pieces[1::2] and sum(x[2] for x in pieces[::2]) == len(ids_of(library, twin))
    used = defaultdict(int)
    for r in rows:
        used[r["sequence_id"]] = max(used[r["sequence_id"]], r["offset"] + r["length"])
    assert all(sum(r["length"] for r in rows if r["sequence_id"] == q) == n <= 64 for q, n in used.items())
    mine = [{**r.asDict(), "doc_id": C.NO_ID if r["doc_id"] is None else r["doc_id"]} for r in rows if r["doc_id"] != 6]
    for i, text in once.items():
        ids, at = ids_of(library, text), 0
        for r in sorted((r for r in mine if r["doc_id"] == i), key=lambda r: r["piece"]):
            assert r["start"] == at and zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    assert P.pack(empty, default_vocabulary()).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([16, 100, 512]))
    counts = Counter(rng.integers(1, capacity + 1, rng.integers(1, 4000)).tolist())
    if seed % 2:
        counts[int(rng.integers(1, capacity + 1))] += 5000  # one length that most pieces have
    plan = P.plan(dict(counts), capacity, groups=20)
    ranks, fill = defaultdict(list), defaultdict(list)
    for length, rank, count, base, offset in plan.slots:
        ranks[length] += range(rank, rank + count)
        for k in range(count):
            fill[base + k].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for p in fill.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(fill) == plan.sequences


def test_knapsack_and_configurations():
    value, used = P.knapsack(np.array([3, 4, 5]), np.array([2.0, 3.0, 4.0]), 10)
    assert value == 8 and used.tolist() == [0, 0, 2]
    found = P.configurations(np.array([4, 6, 10]), np.array([8.0, 8.0, 3.0]), 10)
    assert abs(sum(t for _, t in found) - 11) < 1e-6
