"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian. Its covariance is shrunk towards its own diagonal and a little towards the covariance of all
labelled rows, so classes with few rows or a statistic without spread stay invertible. The score is the logistic of the
log-density difference: Mahalanobis distances by a Cholesky factor that is computed once, and the log determinants.

The statistics of every document are computed once and written; the fit needs only sums (counts, means, outer products)
of labelled rows, which Spark adds up over all of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality_rules import RULES, measures
from tidemark.llm.shared import columns, is_held_out, map_texts, quoted, written

#: Shrinkage towards the diagonal and towards the pooled covariance, and the least variance of a statistic.
TO_DIAGONAL, TO_POOLED, LEAST_VARIANCE = 0.2, 0.1, 1e-3
#: Divides the log-density difference: the statistics are not independent draws, so raw Gaussian odds are too sure.
TEMPER = 4.0
THRESHOLD = 0.3
STATISTICS = ["words", *RULES]


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a text: counts by logarithm, shares near 0 by square root. A null text is empty."""
    base, values = measures(text)
    share = dict(zip(RULES, values))
    out = [np.log1p(base[0]) / 4]
    for name in RULES:
        v = share[name]
        if name == "long_words":
            out.append(np.log1p(v))
        elif name in ("plain_words", "letters"):
            out.append(np.sqrt(max(0.0, 1.0 - v)) if base[0] else 0.0)
        else:
            out.append(np.sqrt(min(v, 4.0)))
    return [float(x) for x in out]


def with_statistics(docs: DataFrame, name: str, keep: list[str], text: str = "text") -> DataFrame:
    def make():
        return lambda texts: [[statistics(t) for t in texts]]

    return map_texts(docs, make, [(name, "array<double>")], keep, [text])


def moments(rows: DataFrame, values: str, label: str) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """For each class: rows, sum and sum of outer products. One row of sums a class and task is shuffled."""
    size = len(STATISTICS)

    def add(batches):
        import pyarrow as pa

        sums = {c: np.zeros(1 + size + size * size) for c in (0, 1)}
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), dtype=float).reshape(-1, size)
            y = np.array(batch.column(1).to_pylist(), dtype=float)
            for c in (0, 1):
                part = x[y == c]
                sums[c] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], ["c", "s"])

    parts = rows.select(F.col(values), F.col(label)).mapInArrow(add, "c int, s array<double>")
    one = parts.select("c", F.posexplode("s").alias("i", "v")).groupBy("c", "i").agg(F.sum("v").alias("v")).collect()  # 2 x (1 + n + n^2) rows
    flat = {c: np.zeros(1 + size + size * size) for c in (0, 1)}
    for r in one:
        flat[r["c"]][r["i"]] = r["v"]
    return {c: (f[0], f[1:1 + size], f[1 + size:].reshape(size, size)) for c, f in flat.items()}


class Discriminant:
    """Two shrunken Gaussians with their cached Cholesky factors."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        total = sum(n for n, _, _ in sums.values())
        self.share = {c: (n + 1) / (total + 2) for c, (n, _, _) in sums.items()}
        mean = {c: s / max(n, 1) for c, (n, s, _) in sums.items()}
        scatter = {c: q - n * np.outer(mean[c], mean[c]) for c, (n, _, q) in sums.items()}
        pooled = sum(scatter.values()) / max(total, 1)
        self.usable = all(n >= 2 for n, _, _ in sums.values())
        self.mean, self.factor, self.log_det = mean, {}, {}
        for c, (n, _, _) in sums.items():
            own = scatter[c] / max(n, 1)
            cov = (1 - TO_POOLED) * own + TO_POOLED * pooled
            cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov)) + LEAST_VARIANCE * np.eye(len(cov))
            lower = np.linalg.cholesky(cov)
            self.factor[c] = np.linalg.inv(lower)
            self.log_det[c] = 2 * np.log(np.diag(lower)).sum()

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1; the class share where one class has too few rows to fit."""
        if not self.usable:
            return np.full(len(x), self.share[1])
        log = {}
        for c in (0, 1):
            z = (x - self.mean[c]) @ self.factor[c].T
            log[c] = -0.5 * ((z * z).sum(axis=1) + self.log_det[c])
        odds = (log[1] - log[0]) / TEMPER + np.log(self.share[1] / self.share[0])
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, held_out, score, predicted) of every row of ``docs``.

    Labels are learnt only from keys that are not held out. Null keys and null labels teach nothing; of several labels of
    a key the greatest counts; repeated documents teach as often as they occur. Empty and null texts have a score.
    Without labelled rows of both classes the score is the share of class 1.
    """
    narrow = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    stats = written(with_statistics(narrow, "x", ["key"]), "statistics")
    taught = labels.select(F.col(quoted(key)).alias("key"), F.col(quoted(label)).cast("int").alias("y")).where("key is not null and y in (0, 1)")
    taught = taught.where(~is_held_out(F.col("key"))).groupBy("key").agg(F.max("y").alias("y"))
    sums = moments(stats.join(taught, "key"), "x", "y")
    shared = docs.sparkSession.sparkContext.broadcast(sums)  # a few kB

    def make():
        model = Discriminant(shared.value)

        def fn(rows):
            p = model.scores(np.array(rows, dtype=float).reshape(-1, len(STATISTICS)))
            return [p.tolist(), [int(v >= THRESHOLD) for v in p]]
        return fn

    out = map_texts(stats, make, [("score", "double"), ("predicted", "int")], ["key"], ["x"])
    return out.select(F.col("key").alias(key), is_held_out(F.col("key")).alias("held_out"), *columns(["score", "predicted"]))
