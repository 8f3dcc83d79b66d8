"""Language ID (operator 8): sparse multinomial logistic regression on TF-IDF character n-grams, FTRL with elastic net.

Texts are lower-cased; other characters than letters count as blanks. Character 1- to 3-grams are hashed into one table. A
gram's value is its share of the text's grams times its inverse document frequency in the training sample. Learners train on
shares of a bounded sample (``sample`` rows, chosen by a hash of the id) and are averaged; a temperature fitted on a tenth of
the sample that they don't see makes the scores probabilities. Scoring reads every whole text once and shuffles nothing.

Texts that are null, empty or without any letter are ``und`` with score 1. Without rows to learn from, all are ``und`` with
score 0. Null languages aren't learned from; a null id is predicted, never learned from; repeated rows are predicted each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm.ftrl import fit, sampled

BITS = 16
ORDERS = 3
SAMPLE = 6_000
LEARNERS = 6
#: Bytes from which a text is read by blocks of so many characters.
LONG = 1 << 20
BLOCK = 1 << 18
_LETTER = re.compile(r"[^\W\d_]")


def grams(texts: list[str], bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (hash of each gram, its row), over texts that are joined by a blank."""
    low = [t.lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where((code >= 128) | ((code >= 97) & (code <= 122)), code, np.uint32(32))
    row = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) for t in low])
    h = code * np.uint32(0x9E3779B1)
    for k in range(ORDERS):
        if k:
            h = (h[:-1] * np.uint32(0x85EBCA77)) ^ (code[k:] * np.uint32(0x9E3779B1))
        same = slice(None) if k == 0 else row[k:] == row[: max(len(row) - k, 0)]
        # an order's own bits keep its grams apart from others
        x = h[same] + np.uint32(k * 0x3C6EF372)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield (x >> np.uint32(32 - bits)).astype(np.int32), row[k:][same]
        if len(h) < 2:
            break


def long_grams(text: str, bits: int = BITS, block: int = BLOCK) -> Iterator[np.ndarray]:
    """Hashes of a text's grams of all orders, by those that begin in a block of ``block`` characters."""
    low = text.lower()
    for a in range(0, len(low), block):
        for h, _ in grams([low[a : a + block + ORDERS - 1]], bits):
            yield h[:block]


def _is_long(part: pa.RecordBatch) -> bool:
    """Whether a slice of ``common.chunks`` is one long text."""
    return part.num_rows == 1 and len(C.text_bytes(part.column("_text"))[0]) > LONG


def _table(docs: DataFrame, bits: int) -> DataFrame:
    """(shard, lang, at, n): the distinct grams of each text and their counts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                if _is_long(part):
                    seen = sum((np.bincount(h, minlength=1 << bits) for h in long_grams(part.column("_text")[0].as_py(), bits)), np.zeros(1 << bits, np.int64))
                    key = np.flatnonzero(seen)
                    n = seen[key]
                else:
                    found = list(grams(part.column("_text").to_pylist(), bits))
                    at = np.concatenate([g for g, _ in found]).astype(np.int64)
                    own = np.concatenate([r for _, r in found]).astype(np.int64)
                    key, n = np.unique(own << bits | at, return_counts=True)
                cut = np.searchsorted(key, np.arange(part.num_rows + 1) << bits)
                ats = [(key[a:b] & ((1 << bits) - 1)).astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                counts = [n[a:b].astype(np.float32) / max(1, n[a:b].sum()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("shard"), part.column("lang"), pa.array(ats, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))], ["shard", "lang", "at", "share"]
                )

    return docs.select("shard", "lang", "_text").mapInArrow(read, "shard int, lang string, at array<int>, share array<float>")


def train(docs: DataFrame, sample: int = SAMPLE, bits: int = BITS, epochs: int = 3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **rates) -> dict:
    """The model: ``langs`` in order, ``weights`` (2 ** bits + 1, langs) with the inverse document frequencies in them."""
    usable = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text"), docs[lang_col].alias("lang")).dropna()
    chosen = sampled(usable, "_id", usable.count(), sample)
    chosen = chosen.withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "_id"), F.lit(10 * LEARNERS)).cast("int"))
    rows = C.store(_table(chosen, bits), "grams")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    if not langs:
        return {"langs": [], "weights": np.zeros(((1 << bits) + 1, 0)), "temperature": 1.0}
    n = rows.count()
    seen = rows.select(F.explode("at").alias("at")).groupBy("at").count().toPandas()
    idf = np.zeros(1 << bits)
    idf[seen["at"].to_numpy()] = np.log((1 + n) / (1 + seen["count"].to_numpy())) + 1
    code = {x: i for i, x in enumerate(langs)}
    weigh = docs.sparkSession.sparkContext.broadcast(idf)

    def scale(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            value = [np.asarray(v, float) * weigh.value[np.asarray(a, np.int64)] for a, v in zip(pdf["at"], pdf["share"], strict=True)]
            yield pd.DataFrame({"shard": pdf["shard"], "label": pdf["lang"].map(code).astype("int32"), "at": pdf["at"], "value": value})

    scaled = rows.mapInPandas(scale, "shard int, label int, at array<int>, value array<float>")
    part = F.col("shard") % 10
    learned = scaled.filter(part != 0).withColumn("shard", F.floor(F.col("shard") / 10).cast("int"))
    w = fit(learned, 1 << bits, len(langs), epochs, **({"alpha": 3.0, "l1": 1e-4, "l2": 1e-4} | rates))
    table = docs.sparkSession.sparkContext.broadcast(w)

    def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            m = [np.asarray(v, float) @ table.value[np.asarray(a, np.int64)] + table.value[-1] for a, v in zip(pdf["at"], pdf["value"], strict=True)]
            yield pd.DataFrame({"label": pdf["label"], "margin": m})

    # the unseen tenth of the bounded sample: one row of margins for each document
    kept = scaled.filter(part == 0).mapInPandas(margins, "label int, margin array<double>").toPandas()
    temperature = fit_temperature(np.array(kept["margin"].tolist()), kept["label"].to_numpy()) if len(kept) else 1.0
    w[:-1] *= idf[:, None]
    return {"langs": langs, "weights": w, "temperature": temperature}


def fit_temperature(margin: np.ndarray, label: np.ndarray) -> float:
    """The temperature of least log loss, by a search on a grid and then a finer one."""
    best = 1.0
    for step in (1.5, 1.05):
        tries = best * step ** np.arange(-12, 13)
        best = min(tries, key=lambda t: -np.mean(np.log(softmax(margin / t)[np.arange(len(label)), label] + 1e-12)))
    return float(best)


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, lang_pred, score) of every whole text."""
    langs, temperature = model["langs"], model["temperature"]
    bits = model["weights"].shape[0].bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(model["weights"].astype(np.float32))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [np.ascontiguousarray(shared.value[:-1, k]) for k in range(len(langs))]
        bias = shared.value[-1]
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                texts, n = part.column("_text").to_pylist(), part.num_rows
                total, margin = np.zeros(n), np.zeros((n, len(langs)))
                if langs:
                    if _is_long(part):
                        for h in long_grams(texts[0], bits):
                            total += len(h)
                            margin += [w[h].sum(dtype=np.float64) for w in table]
                    else:
                        for h, own in grams(texts, bits):
                            total += np.bincount(own, minlength=n)
                            cut = np.searchsorted(own, np.arange(n + 1))
                            for k, w in enumerate(table):
                                sums = np.concatenate([[0.0], np.cumsum(w[h], dtype=np.float64)])
                                margin[:, k] += sums[cut[1:]] - sums[cut[:-1]]
                    p = softmax((margin / np.maximum(total, 1)[:, None] + bias) / temperature)
                    best = p.argmax(axis=1)
                names, scores = [], []
                for i, t in enumerate(texts):
                    letter = _LETTER.search(t) is not None
                    names.append(langs[best[i]] if letter and langs else "und")
                    scores.append(float(p[i, best[i]]) if letter and langs else 0.0 if letter else 1.0)
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["_id", "lang_pred", "score"])

    return C.id_and_text(docs, id_col, text_col).mapInArrow(read, "_id long, lang_pred string, score double")
