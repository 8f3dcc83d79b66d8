"""Follow-the-regularised-leader for sparse logistic and softmax models, and averaging of learners over Spark tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Row = tuple[int, np.ndarray, np.ndarray]


class Ftrl:
    """Per-coordinate FTRL with elastic net; ``classes`` = 1 is logistic regression. The last coordinate is the bias."""

    def __init__(self, size: int, classes: int = 1, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0):
        self.z = np.zeros((size + 1, classes))
        self.n = np.zeros((size + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, label: int, at: np.ndarray, value: np.ndarray) -> None:
        at = np.append(at, len(self.z) - 1)
        value = np.append(value, 1.0)
        w = self.weights(at)
        margin = value @ w
        if len(margin) == 1:
            error = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - label
        else:
            error = np.exp(margin - margin.max())
            error /= error.sum()
            error[label] -= 1
        g = value[:, None] * error
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(rows: DataFrame, size: int, classes: int, epochs: int, **rates) -> np.ndarray:
    """Weights (size + 1, classes): the mean of one model for each ``shard``, trained in a task on its share of ``rows``.

    rows: (shard, label, at array<int>, value array<float>), a bounded sample. What comes to the driver are at most
    size + 2 rows of sums. Without rows, all weights are 0.
    """

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        model = Ftrl(size, classes, **rates)
        order = np.random.default_rng(5)
        data: list[Row] = sorted(
            ((int(y), np.asarray(a, np.int64), np.asarray(v, float)) for y, a, v in zip(pdf["label"], pdf["at"], pdf["value"], strict=True)), key=lambda r: (r[0], len(r[1]), r[1].tobytes())
        )
        for _ in range(epochs):
            for i in order.permutation(len(data)):
                model.learn(*data[i])
        w = model.weights()
        used = np.flatnonzero(np.any(w != 0, axis=1))
        # row -1 counts the learners
        return pd.DataFrame({"at": np.append(used, -1), "w": [*w[used], np.ones(classes)]})

    parts = rows.groupBy("shard").applyInPandas(train, "at int, w array<double>")
    mean = parts.groupBy("at").agg(*[F.sum(F.get("w", F.lit(k))).alias(f"w{k}") for k in range(classes)])
    out = np.zeros((size + 1, classes))
    got = mean.toPandas()
    if len(got):
        got = got.set_index("at")
        learners = got.loc[-1, "w0"]
        got = got.drop(index=-1)
        out[got.index.to_numpy()] = got.to_numpy() / learners
    return out


def sampled(df: DataFrame, id_col: str, rows: int, most: int) -> DataFrame:
    """About ``most`` of ``rows`` rows, chosen by a hash of the id; all of them where there are fewer."""
    share = 1.0 if rows <= most else most / rows
    return df if share == 1.0 else df.filter(F.pmod(F.xxhash64(F.lit(11), F.col(id_col)), F.lit(1 << 24)) < int(share * (1 << 24)))
