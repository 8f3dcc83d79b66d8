"""Lexical search, hard negatives and fingerprints: against SQL and brute force, awkward rows, ties, hot groups, no rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import AWKWARD, awkward, empty, shipped, texts  # noqa: F401
from oracle import compare
from pyspark.sql import functions as F

from leadflow.llm import fingerprints as P
from leadflow.llm import hard_negatives as H
from leadflow.llm import lexical as X
from leadflow.llm import queries as Q

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", ["op11_lexical_search", "op12_hard_negatives"])
def test_queries_match_their_sql(spark, duck_mid, key):
    ok, msg = compare(Q.QUERIES[key](spark, MID), duck_mid, Q.ORACLES[key])
    assert ok, msg


# --- lexical search ----------------------------------------------------------------------------------------------------

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked_by_hand(docs, items, k):
    told = [(i, Counter(words(t))) for i, t in docs]
    told = [(i, c) for i, c in told if c]
    n, total = len(told), sum(sum(c.values()) for _, c in told)
    df = Counter(t for _, c in told for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in told:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(words(text)) if t in c)
            if score:
                found.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def searched(spark, docs, items, k=X.K):
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted((r["item_id"], r["rank"], r["_id"], r["score"]) for r in X.ranked(d, q, k).collect())


def test_terms_as_the_pattern_finds_them():
    rng = random.Random(3)
    for _ in range(300):
        rows = ["".join(rng.choice("aZ09 .-_{}@\n\0éß中😀\x7f") for _ in range(rng.randrange(12))) for _ in range(4)]
        body, at = X.C.text_bytes(pa.array(rows))
        starts, ends = X.term_spans(body, at)
        raw = X.C.LOWER[body].tobytes()
        assert [raw[a:b].decode() for a, b in zip(starts, ends)] == [t for row in rows for t in words(row)]


def test_terms_of_one_hash_are_told_apart():
    """Two different strings with one polynomial hash whatever its base: Thue-Morse words of 2^11 signs."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    known = X.Vocabulary(sorted([a.encode(), b.encode(), b"other"]))
    assert known.alike == 2
    body = f"{b} {a} {b} c".encode()
    starts, ends = X.term_spans(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
    first = sorted([a.encode(), b.encode(), b"other"])
    assert known.find(np.frombuffer(body, np.uint8), starts, ends).tolist() == [first.index(b.encode()), first.index(a.encode()), first.index(b.encode()), -1]


def test_ranking_prunes_without_loss(spark, monkeypatch):
    """Many buckets and a head of a few documents: every bound is used, ties and copies included."""
    rng = random.Random(5)
    lexicon = [f"w{k}" for k in range(400)]
    docs = [(i, " ".join(rng.choices(lexicon, [1 / (k + 1) for k in range(400)], k=rng.randrange(1, 120)))) for i in range(1500)]
    docs += [(5000 + i, docs[7][1]) for i in range(700)]  # a third are copies
    docs += [(i, "w1 W1 w2") for i in (40, 40, 41)]
    items = [(i, " ".join(rng.sample(lexicon, 12))) for i in range(40)] + [(90, docs[7][1]), (91, "w399")]
    monkeypatch.setattr(X, "HEAD", 100)
    want = ranked_by_hand(docs, items, 20)
    assert searched(spark, docs, items, 20) == want
    monkeypatch.setattr(X, "BLOCK_BYTES", 500)  # several blocks of items
    assert searched(spark, docs, items, 20) == want


def test_a_bucket_below_the_threshold_is_not_scored():
    bucket = X.Bucket(np.array([1, 2]), np.array([5.0, 3.0]), np.array([0, 1]), np.array([5, 3]), np.array([0, 1, 2]))
    dense = np.zeros(2, np.int64)
    best = X.Best(1, 16)
    bucket.search(np.array([0, 1]), np.array([3, 3]), math.sqrt(18), dense, best)
    assert not len(best.ids)
    best = X.Best(1, 15)
    bucket.search(np.array([0, 1]), np.array([3, 3]), math.sqrt(18), dense, best)
    assert best.ids.tolist() == [1] and best.scores.tolist() == [15] and not dense.any()


def test_ranking_of_awkward_rows(spark, awkward, empty):
    items = [(1, "alpha GAMMA shared"), (1, "alpha GAMMA shared"), (2, None), (3, ""), (4, "..."), (None, "id text"), (5, "nowhere"), (6, "x" * 5000), (7, "中文 café")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("_id", F.lit("no")).withColumn("rank", F.lit(None).cast("int"))
    got = sorted(((r["item_id"] or 0, r["rank"], r["_id"], r["score"]) for r in X.ranked(awkward, asked).collect()))
    docs = [(X.C.NO_ID if i is None else i, t) for i, t in AWKWARD]
    want = ranked_by_hand(docs, [(1, items[0][1]), (0, "id text"), (6, "x" * 5000), (7, "中文 café")], 50)
    assert got == want and got
    assert X.ranked(empty, asked).collect() == [] and X.ranked(awkward, asked.limit(0)).collect() == []
    assert X.ranked(awkward, asked.limit(0)).columns == ["item_id", "rank", "_id", "score"]


def test_one_very_long_text(spark):
    big = " ".join(f"t{k % 5000}" for k in range(700_000))
    docs = [(1, big), (2, "t1 t2"), (3, "y" * 3_000_000)]
    assert searched(spark, docs, [(1, "t1 t4999 zz")]) == ranked_by_hand(docs, [(1, "t1 t4999 zz")], 50)


# --- hard negatives ----------------------------------------------------------------------------------------------------


def mined_by_hand(rows, every=100, n_pos=5, n_neg=10, low=30, high=90):
    ok = []
    for i, v, label in dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((H.C.NO_ID if i is None else i, [math.floor(256 * x) for x in v], label))
    out = []
    for i, v, label in ok:
        if i == H.C.NO_ID or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in ok if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:n_pos]:
            fits = sorted(x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)[:n_neg]
            out += [(i, j, r, k, -s, -t) for r, (t, k, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **k):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("_id", F.lit("x")).withColumn("q", F.lit(None).cast("int"))
    return sorted(tuple(r) for r in H.hard_negatives(df, **k).collect())


@pytest.mark.parametrize("seed", range(3))
def test_negatives_against_brute_force(spark, monkeypatch, seed):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(H, "BLOCK", 128)
    monkeypatch.setattr(H, "FIRST", 4)
    rows = [(int(i), rng.normal(size=6).round(2 if seed else 1).tolist(), int(rng.integers(0, 4))) for i in range(900)]
    rows += [(2000 + i, rows[3][1], rows[3][2]) for i in range(450)]  # a third are one vector
    want = mined_by_hand(rows, every=50)
    assert mined(spark, rows, anchor_every=50) == want and len(want) > 300
    if not seed:
        monkeypatch.setattr(H, "CHUNK_BYTES", 500)  # several chunks of anchors
        assert mined(spark, rows, anchor_every=50) == want


def test_negatives_of_awkward_rows(spark, empty):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.0, 1.0], 2), (100, [0.0, 0.0], 1), (200, [], 1), (201, [], 1), (202, [], 2), (300, [1.0, 2.0, 3.0], 1), (301, [1.0, 1.0, 1.0], 1),
            (302, [0.5, 0.5, 0.5], 2), (None, [0.5, 0.1], 1), (None, [0.4, 0.1], 2), (1, [0.9, 0.2], 1), (2, [0.8, -0.2], 1), (3, [-1.0, 0.0], 1), (4, [0.3, 3.0], 2), (5, [0.3, -2.0], 2),
            (6, None, 1), (7, [None, 1.0], 1), (8, [nan, 1.0], 2), (9, [inf, 1.0], 2), (10, [1.0, 1.0], None), (400, None, None), (500, [1.0, 0.0], -3), (501, [0.5, 0.0], -3), (11, [1e200, 0.0], 1)]
    small = [r for r in rows if r[0] != 11]
    assert mined(spark, small) == mined_by_hand(small)
    # exact beyond 64 bits while mined; as the greatest long in the result
    got = mined(spark, rows)
    assert {r[4] for r in got} <= {min(r[4], H._MOST) for r in got} and (0, 11) not in {r[:2] for r in got if r[4] < H._MOST}
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert H.hard_negatives(none).collect() == [] and mined(spark, [(1, [1.0], 1)]) == []


def test_the_threshold_stops_the_lists():
    """On rows with one strong dimension only the tops of the lists are scored."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(4000, 4)) * [1000, 1, 1, 1])
    block = H.Block(np.arange(4000), np.zeros(4000, int), x)
    windows = H.Windows(5, [None])
    anchor = np.array([256.0, 1.0, -1.0, 0.0])
    scored = H.visit(block, anchor, -1, np.ones(4000, bool), windows)
    best = sorted((-int(s), i) for i, s in enumerate(x @ anchor))[:5]
    assert windows.best[0] == best and scored < 400


# --- fingerprints ------------------------------------------------------------------------------------------------------


def sets(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = re.findall("[^ \t\n\x0b\x0c\r]+", t)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def jaccard(a, b):
    a, b = sets(a), sets(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_shingles_are_the_runs_of_words():
    rng = random.Random(2)
    rows = [" ".join(rng.choices(["a", "B", "c\n", "中", ""], k=rng.randrange(0, 14))) for _ in range(200)]
    x, at = P.shingles(pa.array(rows))
    names = {}
    for k, row in enumerate(rows):
        mine = x[at[k] : at[k + 1]].tolist()
        assert len(set(mine)) == len(sets(row))
        for s in sets(row):
            names.setdefault(s, set()).update([frozenset(mine)])
        alone, _ = P.shingles(pa.array([row]))
        assert alone.tolist() == mine


def test_signatures_estimate_jaccard_and_blocks_agree(texts, monkeypatch):  # noqa: F811
    known = [t or "" for t in list(texts.values())[:200]]
    edits = [P.edited_text(a, b) for a, b in zip(known, known[1:] + known[:1])]
    one, two = P.signatures(pa.array(known)), P.signatures(pa.array(edits))
    off = [near - jaccard(a, b) for near, a, b in zip(P.likeness(one, two), known, edits)]
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.045 and np.abs(off).max() < 0.2
    monkeypatch.setattr(P, "_BLOCK", 1000)
    assert (P.signatures(pa.array(known)) == one).all()
    for k in (0, 17):
        assert (P.signatures(pa.array([known[k]])) == one[k]).all()


def edited_by_hand(docs):
    order = sorted(docs, key=lambda r: -(r[0] if r[0] is not None else H.C.NO_ID))
    return {i: (t, P.edited_text(t, order[(k + 1) % len(order)][1]), order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)}


def check_edits(got, want):
    assert set(got) == set(want)
    for i, (text, edited, following) in want.items():
        r = got[i]
        assert r["n_chars"] == len(text) and bytes(r["edited_sha256"]) == hashlib.sha256(edited.encode()).digest()
        a, b, c = P.signatures(pa.array([text, edited, following], pa.large_string()))
        assert bytes(r["fingerprint"]) == a.tobytes() and bytes(r["edited_fingerprint"]) == b.tobytes()
        assert r["near_edited"] == (a == b).mean() and r["near_next"] == (a == c).mean()


@pytest.mark.parametrize("parts", ["1", "8", "64"])
def test_edits_against_brute_force(spark, texts, parts):  # noqa: F811
    docs = [(i, t or "") for i, t in list(texts.items())[:300]]
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = P.edited_likeness(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(got) == len(docs)
    check_edits({r["_id"]: r for r in got}, edited_by_hand(docs))


def test_edits_of_awkward_rows(spark, awkward, empty):
    got = P.edited_likeness(awkward).collect()
    assert len(got) == len(AWKWARD)
    one = [r for r in got if r["_id"] != 6]
    docs = list(dict.fromkeys((H.C.NO_ID if i is None else i, t or "") for i, t in AWKWARD))
    check_edits({r["_id"]: r for r in one}, {k: v for k, v in edited_by_hand(docs).items() if k != 6})
    assert sorted(r["near_next"] == 1.0 for r in got if r["_id"] == 6) == [False, True]  # equal rows follow each other
    assert P.edited_likeness(empty).collect() == []
    alone = P.edited_likeness(spark.createDataFrame([(None, "a b c d e f")], "doc_id long, text string")).collect()
    assert [(r["_id"], r["n_chars"], r["near_next"]) for r in alone] == [(H.C.NO_ID, 11, 1.0)]
    same = spark.createDataFrame([(None, None)] * 3000 + [(k, "x y") for k in range(1500)], "doc_id long, text string")
    assert P.edited_likeness(same).count() == 4500


def test_near_documents_against_brute_force(spark, texts, awkward, empty):  # noqa: F811
    rng = random.Random(4)
    docs = [(i, t or "") for i, t in texts.items() if len(t or "") < 3000][:250]
    for k in range(120):  # near copies about the threshold
        w = rng.choice(docs[:250])[1].split()
        if len(w) > 30:
            for _ in range(rng.randrange(1, 2 + len(w) // 60)):
                w[rng.randrange(len(w))] = f"new{k}"
            docs.append((100_000 + k, " ".join(w)))
    docs += [(200_000 + k, docs[5][1]) for k in range(200)]
    got = {r["_id"]: r for r in P.near_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == len(docs)
    told = {t: sets(t) for _, t in docs}
    distinct = [t for t in told if told[t]]
    links = {(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if len(told[a] & told[b]) >= 0.8 * len(told[a] | told[b])}
    low = {t: min(i for i, x in docs if x == t) for t in told}
    while True:
        was = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if was == low:
            break
    right = sum(got[i]["class_id"] == low[t] for i, t in docs)
    assert len(links) > 30 and right >= 0.98 * len(docs)
    assert all(got[i]["class_id"] >= low[t] for i, t in docs)  # never more than brute force joins
    assert P.near_documents(awkward).count() == len(AWKWARD) and P.near_documents(empty).collect() == []
