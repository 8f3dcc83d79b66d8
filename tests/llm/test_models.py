"""Quality classifier and language ID: held-out accuracy, FTRL against a reference, defined cases."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import awkward, empty, shipped, texts  # noqa: F401
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm import langid as G
from leadflow.llm import quality as A
from leadflow.llm import queries as Q
from leadflow.llm.ftrl import Ftrl

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_ftrl_learns_and_l1_is_sparse():
    rng = np.random.default_rng(0)
    dense, sparse = Ftrl(50, 1, alpha=1.0), Ftrl(50, 1, alpha=1.0, l1=2.0)
    for _ in range(600):
        at = np.sort(rng.choice(50, 6, replace=False))
        y = int(0 in at or 1 in at)
        for m in (dense, sparse):
            m.learn(y, at, np.ones(6))
    w, s = dense.weights()[:, 0], sparse.weights()[:, 0]
    assert min(w[0], w[1]) > 1 > max(w[2:50])
    assert (s == 0).sum() > (w == 0).sum() and s[0] > 0


def test_features_are_shares_and_grams_stay_in_their_row():
    import pyarrow as pa

    alone = A.features(*C.text_bytes(pa.array(["Some WORDS, 12 here"])))
    both = A.features(*C.text_bytes(pa.array(["", "x y", "Some WORDS, 12 here", ""])))
    mine = both[2] == 2
    assert sorted(zip(alone[0], alone[1])) == sorted(zip(both[0][mine], both[1][mine]))
    assert abs(alone[1].sum() - 2) < 1e-9  # two streams


def test_quality_held_out(spark, duck_mid):
    rows = {r["doc_id"]: r for r in Q.QUERIES["op1_quality_classifier"](spark, MID).collect()}
    duck_mid.execute("CREATE OR REPLACE VIEW labels AS SELECT * FROM read_parquet('/root/testdata/sf0.01/labels.parquet')")
    labels = duck_mid.sql("SELECT doc_id, quality FROM labels").fetchall()
    held = [(rows[i]["predicted"], y) for i, y in labels if rows[i]["held_out"]]
    assert len(held) > 50 and np.mean([p == y for p, y in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())


def test_quality_cases(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    w = A.train(awkward, none, bits=10)
    assert not w.any()
    assert A.accepted(awkward, w).count() == awkward.count() and A.accepted(awkward, w).columns == awkward.columns
    # repeated labels that disagree don't count, nor do null ones and null ids
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (7, 0), (7, 0)], "doc_id long, quality int")
    w = A.train(awkward, labels, bits=10)
    scores = {r[0]: r[1] for r in C.id_and_text(awkward).select("_id", A.scorer(spark, w)("_text")).collect()}
    assert scores[7] < 0.5 and scores[3] == scores[4] == pytest.approx(1 / (1 + np.exp(-np.float32(w[-1]))), rel=1e-5)
    assert A.accepted(empty, w).count() == 0


def test_language_held_out(spark, duck_mid):
    rows = Q.QUERIES["op8_language_id"](spark, MID).collect()
    lang = dict(duck_mid.sql("SELECT doc_id, lang FROM documents").fetchall())
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean(held) > 0.9


def test_language_cases(spark, awkward, empty):
    train = spark.createDataFrame(
        [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 20)] + [(99, None, "en"), (98, "text", None), (None, "x", "en")],
        "doc_id long, text string, lang string",
    )
    model = G.train(train, bits=12)
    assert model["langs"] == ["de", "en"] and model["temperature"] > 0
    got = {r["_id"]: (r["lang_pred"], r["score"]) for r in G.predict(awkward, model).collect()}
    assert got[3] == got[4] == got[5] == got[11] == ("und", 1.0)
    assert got[8][0] in ("de", "en") and 0.5 <= got[8][1] <= 1
    asked = spark.createDataFrame([(1, "THE DOG"), (2, "die katze")], "doc_id long, text string")
    assert {r["_id"]: r["lang_pred"] for r in G.predict(asked, model).collect()} == {1: "en", 2: "de"}
    assert G.predict(empty, model).count() == 0
    nothing = G.train(train.limit(0), bits=12)
    assert {r["_id"]: (r["lang_pred"], r["score"]) for r in G.predict(awkward, nothing).collect()}[8] == ("und", 0.0)


def test_temperature_has_least_log_loss():
    rng = np.random.default_rng(1)
    margin = rng.normal(0, 1, (4000, 3))
    label = np.array([rng.choice(3, p=p) for p in G.softmax(margin)])
    assert 0.8 < G.fit_temperature(margin, label) < 1.25
    assert 4 < G.fit_temperature(5 * margin, label) < 6.3


def test_samples_are_bounded(spark):
    from leadflow.llm.ftrl import sampled

    rows = spark.range(20000).select(F.col("id").alias("_id"))
    assert 1700 < sampled(rows, "_id", 20000, 2000).count() < 2300
    assert sampled(rows, "_id", 20000, 20000).count() == 20000


def mixed(x: int) -> int:
    """``common.mix64`` of one integer."""
    ones = (1 << 64) - 1
    x = ((x ^ x >> 31) * 0x9E3779B97F4A7C15) & ones
    x = ((x ^ x >> 29) * 0xBF58476D1CE4E5B9) & ones
    return x ^ x >> 32


def grams_by_hand(text: str, bits: int) -> dict[int, float]:
    """{coordinate: value} of a text, run by run."""
    body, ones = text.encode(), (1 << 64) - 1

    def kind(c: int) -> int:
        return 0 if c <= 32 else 2 if 48 <= c <= 57 else 1 if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 3

    words, shapes, at = [], [], 0
    while at < len(body):
        end = at + 1
        while end < len(body) and kind(body[end]) == kind(body[at]):
            end += 1
        if sort := kind(body[at]):
            run = np.frombuffer(body[at:end].lower(), np.uint8)
            word = int(C.span_hashes(run, np.array([0]), np.array([len(run)]))[0])
            shape = sort + 4 * (65 <= body[at] <= 90) + 8 * (65 <= body[end - 1] <= 90) + 16 * (at == 0 or kind(body[at - 1]) == 0)
            shape += 32 * bool(words and words[-1] == word) + (word << 8 if sort == 3 else 0)
            words.append(word)
            shapes.append(shape & ones)
        at = end
    out: dict[int, float] = defaultdict(float)
    for codes, orders, seed in ((words, 2, 1), (shapes, 3, 2)):
        found = []
        for k in range(len(codes)):
            left = mixed((codes[k] + seed) & ones)
            found.append(left)
            for code in codes[k + 1 : k + orders]:
                left = mixed((left * 31 + code) & ones)
                found.append(left)
        for h in found:
            out[h >> (64 - bits)] += 1 / len(found)
    return out


def learner_by_hand(rows: list[tuple[int, dict[int, float]]], epochs: int, alpha: float) -> dict[int, float]:
    """Weights by coordinate (-1: the bias) of logistic regression by FTRL without penalties, a coordinate at a time."""
    rows = sorted(((y, dict(sorted(x.items()))) for y, x in rows), key=lambda r: (r[0], len(r[1]), np.array(list(r[1]), np.int64).tobytes()))
    z: dict[int, float] = defaultdict(float)
    n: dict[int, float] = defaultdict(float)

    def weight(i: int) -> float:
        return -z[i] / ((1 + math.sqrt(n[i])) / alpha)

    order = np.random.default_rng(5)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            y, x = rows[r]
            x = x | {-1: 1.0}
            w = {i: weight(i) for i in x}
            error = 1 / (1 + math.exp(-min(35, max(-35, sum(v * w[i] for i, v in x.items()))))) - y
            for i, v in x.items():
                g = v * error
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_quality_against_brute_force(spark):
    got = {r["doc_id"]: r for r in Q.QUERIES["op1_quality_classifier"](spark, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r["quality"] is not None}
    assert set(got) == set(texts)
    seen = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 3 != 1 and i in texts}
    assert len(seen) > 20 and len(set(seen.values())) == 2
    ids = spark.createDataFrame([(i,) for i in seen], "id long")
    shards = defaultdict(list)
    for r in ids.select("id", F.pmod(F.xxhash64("id"), F.lit(A.LEARNERS)).alias("shard")).collect():
        shards[r["shard"]].append((seen[r["id"]], {k: float(np.float32(v)) for k, v in grams_by_hand(texts[r["id"]], A.BITS).items()}))
    mean: dict[int, float] = defaultdict(float)
    for rows in shards.values():
        for i, w in learner_by_hand(rows, 3, 3.0).items():
            mean[i] += w / len(shards)
    for i, text in texts.items():
        margin = sum(v * mean[k] for k, v in grams_by_hand(text, A.BITS).items() if k in mean) + mean[-1]
        score = 1 / (1 + math.exp(-margin))
        assert got[i]["score"] == pytest.approx(score, abs=1e-4), i
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i]["predicted"] == int(score >= 0.5) or abs(score - 0.5) < 1e-4


def characters_by_hand(text: str, bits: int) -> list[int]:
    """Coordinates of the 1- to 3-grams of a text's characters, a sign that is no letter counting as a blank."""
    ones = (1 << 32) - 1
    codes = [ord(c) if ord(c) >= 128 or "a" <= c <= "z" else 32 for c in text.lower()]
    out = []
    for i in range(len(codes)):
        h = 0
        for k, code in enumerate(codes[i : i + 3]):
            h = (h * 0x85EBCA77 & ones) ^ (code * 0x9E3779B1 & ones)
            x = (h + k * 0x3C6EF372) & ones
            out.append(((x ^ x >> 15) * 0x2C1B3C6D & ones) >> (32 - bits))
    return out


def softmax_learner_by_hand(rows: list[tuple[int, dict[int, float]]], classes: int, epochs: int, alpha: float, l1: float, l2: float) -> dict[int, list[float]]:
    """Weights by coordinate (-1: the bias) of multinomial regression by FTRL with elastic net."""
    rows = sorted(((y, dict(sorted(x.items()))) for y, x in rows), key=lambda r: (r[0], len(r[1]), np.array(list(r[1]), np.int64).tobytes()))
    z: dict[int, list[float]] = defaultdict(lambda: [0.0] * classes)
    n: dict[int, list[float]] = defaultdict(lambda: [0.0] * classes)

    def weight(i: int) -> list[float]:
        return [-math.copysign(max(abs(a) - l1, 0), a) / ((1 + math.sqrt(b)) / alpha + l2) for a, b in zip(z[i], n[i], strict=True)]

    order = np.random.default_rng(5)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            y, x = rows[r]
            x = x | {-1: 1.0}
            w = {i: weight(i) for i in x}
            margin = [sum(v * w[i][c] for i, v in x.items()) for c in range(classes)]
            error = [math.exp(m - max(margin)) for m in margin]
            error = [e / sum(error) - (c == y) for c, e in enumerate(error)]
            for i, v in x.items():
                for c in range(classes):
                    g = v * error[c]
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / alpha * w[i][c]
                    n[i][c] += g * g
    return {i: weight(i) for i in z}


def test_language_of_long_texts(spark):
    text = "Der Hund und die Katze, ein İ Σ und 12 Häuser. "
    whole = np.bincount(np.concatenate([h for h, _ in G.grams([text], 12)]), minlength=1 << 12)
    for block in (1, 2, 7, 1000):
        assert (sum(np.bincount(h, minlength=1 << 12) for h in G.long_grams(text, 12, block)) == whole).all()
    long = text * (3 * G.LONG // len(text))
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 20)]
    train = spark.createDataFrame([*rows, (50, long, "de")], "doc_id long, text string, lang string")
    model = G.train(train, bits=12)
    count = np.bincount(np.concatenate([h for h, _ in G.grams([long], 12)]), minlength=1 << 12)
    margin = (count @ model["weights"][:-1] / count.sum() + model["weights"][-1]) / model["temperature"]
    asked = spark.createDataFrame([(1, long), (2, "the dog")], "doc_id long, text string")
    got = {r["_id"]: (r["lang_pred"], r["score"]) for r in G.predict(asked, model).collect()}
    assert got[1] == ("de", pytest.approx(G.softmax(margin[None]).max(), abs=1e-5)) and got[2][0] == "en"


def test_language_against_brute_force(spark):
    got = {r["doc_id"]: r for r in Q.QUERIES["op8_language_id"](spark, SMALL).collect()}
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()}
    assert set(got) == set(docs)
    used = {i: d for i, d in docs.items() if d["text"] is not None and d["lang"] is not None and zlib.crc32(str(i).encode()) % 5}
    langs = sorted({d["lang"] for d in used.values()})
    assert len(langs) > 1
    counts = {i: defaultdict(int) for i in docs}
    for i, d in docs.items():
        for at in characters_by_hand(d["text"] or "", G.BITS):
            counts[i][at] += 1
    df: dict[int, int] = defaultdict(int)
    for i in used:
        for at in counts[i]:
            df[at] += 1
    idf = {at: math.log((1 + len(used)) / (1 + k)) + 1 for at, k in df.items()}
    ids = spark.createDataFrame([(i,) for i in used], "id long")
    learners, unseen = defaultdict(list), []
    for r in ids.select("id", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(10 * G.LEARNERS)).alias("shard")).collect():
        mine = counts[r["id"]]
        row = (langs.index(used[r["id"]]["lang"]), {at: float(np.float32(k / sum(mine.values()) * idf[at])) for at, k in mine.items()})
        (learners[r["shard"] // 10] if r["shard"] % 10 else unseen).append(row)
    mean: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(len(langs)))
    for rows in learners.values():
        for at, w in softmax_learner_by_hand(rows, len(langs), 3, 3.0, 1e-4, 1e-4).items():
            mean[at] = mean[at] + np.array(w) / len(learners)
    margins = np.array([sum((v * mean[at] for at, v in x.items()), mean[-1]) for _, x in unseen])
    temperature = G.fit_temperature(margins, np.array([y for y, _ in unseen])) if unseen else 1.0
    for i, d in docs.items():
        if not any(c.isalpha() for c in d["text"] or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 1.0)
            continue
        margin = sum((k * idf.get(at, 0.0) * mean[at] for at, k in counts[i].items()), 0 * mean[-1]) / sum(counts[i].values()) + mean[-1]
        p = G.softmax(margin[None] / temperature)[0]
        assert got[i]["score"] == pytest.approx(p.max(), abs=1e-3), i
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert p[langs.index(got[i]["lang_pred"])] > p.max() - 1e-3
