"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import NULL_ID, keyed, written
from stratalake.llm.simhash import shingle_hashes


def remainder(column: str, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % by, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int) -> tuple[DataFrame, float]:
    """About ``per_class`` distinct texts of each class with ``label`` (0 or 1), and the share of class 1 among all
    usable labels. Which documents are drawn is decided by a hash of their id; ``usable`` is a condition on doc_id.

    The ids drawn are few by this bound, so they are sent to every task. Of near copies about one stays, so that a text
    copied hundreds of times does not teach its own rare words. Null labels count for nothing, nor do ids that have
    both labels; a share without any label is 0.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min(label).alias("label"), F.max(label).alias("_other"))
    known = known.filter("label = _other").select("_id", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30))
    taken = F.lit(False)
    for value, n in counts.items():
        taken = taken | ((F.col("label") == value) & (draw < int((1 << 30) * min(1.0, per_class / n))))
    rows = written(keyed(docs).filter(F.col("_id") != NULL_ID).join(F.broadcast(known.filter(taken)), "_id"))
    left = rows.mapInArrow(_sketches, "_id long, _hash long, m0 long, m1 long, m2 long")
    for k in range(3):
        others = [c for c in ("_id", "_hash", "m0", "m1", "m2") if c != f"m{k}"]
        left = left.groupBy(f"m{k}").agg(F.min(F.struct(*others)).alias("first")).select(f"m{k}", "first.*")
    rows = rows.join(F.broadcast(left.select("_id", "_hash")), ["_id", "_hash"])
    return rows, counts.get(1, 0) / max(1, sum(counts.values()))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three minima over hashed five-word shingles: near copies share most of them."""
    for batch in batches:
        sets = [shingle_hashes(t.as_py(), 5) for t in batch.column("_text")]
        least = [[(h * np.uint64(2 * k + 1) ^ (h >> np.uint64(7 * k + 3))).min() if len(h) else 0 for h in sets] for k in range(3)]
        columns = [pa.array(np.array(m, np.uint64).view(np.int64)) for m in least]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_hash"), *columns], ["_id", "_hash", "m0", "m1", "m2"])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first column is the intercept, not shrunk."""
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def log_odds(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))
