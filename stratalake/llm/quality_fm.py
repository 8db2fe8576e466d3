"""Text quality by a factorisation machine over hashed words, structure statistics and size.

score = w0 + sum of w_i x_i + sum over pairs of <v_i, v_j> x_i x_j, where the pairs' sum is half of
sum over factors of (sum of v_if x_i)^2 - sum of (v_if x_i)^2: linear in the words of a text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, keyed, public_id
from stratalake.llm.sampling import labelled_sample, log_odds

#: Buckets of hashed words; their features follow those of the structure.
BUCKETS = 1 << 15
FACTORS = 8
#: Labelled documents of each class to learn from: a bounded sample by design.
SAMPLE = 5000
#: Texts that are scored at once.
SCORED = 64
EPOCHS, BATCH, RATE, SHRINK = 12, 128, 0.02, 1e-4
SEED = 11

_KINDS = {
    "upper": range(65, 91),
    "digit": range(48, 58),
    "stop": b".?",
    "comma": b",;:",
    "loud": b"!",
    "bar": b"|",
    "mark": b"#$%&*@^~<>{}[]=+_/\\",
    "quote": b"\"'()-",
    "high": range(128, 256),
}
_KIND_ROWS = np.array([[i in set(kind) for i in range(256)] for kind in _KINDS.values()], np.float64)
STATISTICS = (*_KINDS, "chars", "words", "lines", "word_size", "distinct", "repeated", "top", "line_size")
N_STATISTICS = len(STATISTICS)


def raw_features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Structure statistics, and the hashed words with their weights (square roots of counts, length 1)."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.lower().split()
    n, size = max(1, len(words)), max(1, len(data))
    found = Counter(words)
    lines = counts[10] + 1
    kinds = _KIND_ROWS @ counts / size
    statistics = np.r_[
        np.sqrt(kinds),
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(lines),
        size / n if n < size else size,
        len(found) / n,
        sum(map(eq, words, words[1:])) / n,
        max(found.values(), default=0) / n,
        np.log1p(len(words) / lines),
    ]
    index = np.fromiter(map(zlib.crc32, found), np.int64, len(found)) % BUCKETS + N_STATISTICS
    value = np.sqrt(np.fromiter(found.values(), np.float64, len(found)))
    return statistics, index, value / max(1e-9, np.sqrt((value * value).sum()))


@dataclass
class Machine:
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows(self, texts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of some texts end to end: index, value, and where each text begins."""
        index, value, start, at = [], [], [], 0
        for statistics, i, v in texts:
            start.append(at)
            index += [np.arange(N_STATISTICS), i]
            # Statistics weigh like a handful of words.
            value += [np.clip((statistics - self.mean) / self.scale, -4, 4) / 4, v]
            at += N_STATISTICS + len(i)
        return np.concatenate(index), np.concatenate(value), np.array(start)

    def margin(self, index: np.ndarray, value: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic curve, and the factor sums of each text."""
        weighted = self.factors[index] * value[:, None]
        sums = np.add.reduceat(weighted, start)
        squares = np.add.reduceat(weighted * weighted, start)
        line = np.add.reduceat(self.linear[index] * value, start)
        return self.bias + line + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def scores(self, texts: Iterable[str]) -> np.ndarray:
        """Scores of any number of texts, the features of a few in memory at a time."""
        out, some = [np.zeros(0)], []
        for text in texts:
            some.append(raw_features(text))
            if len(some) == SCORED:
                out.append(self.probability(some))
                some = []
        return np.concatenate([*out, *([self.probability(some)] if some else [])])

    def probability(self, texts: list[tuple]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(*self.rows(texts))[0], -30, 30)))


def learn(texts: list[tuple], y: np.ndarray, share: float) -> Machine:
    """Adam over batches of texts. The curve is shifted from the sample's share of class 1 to ``share``."""
    rng = np.random.default_rng(SEED)
    table = np.array([t[0] for t in texts])
    size = N_STATISTICS + BUCKETS
    machine = Machine(table.mean(axis=0), table.std(axis=0) + 1e-6, 0.0, np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)))
    first = np.zeros((size, FACTORS + 1))
    second = np.zeros((size, FACTORS + 1))
    bias_first = bias_second = 0.0
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            some = order[k : k + BATCH]
            index, value, start = machine.rows([texts[i] for i in some])
            margin, sums = machine.margin(index, value, start)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[some]) / len(some)
            owner = np.repeat(np.arange(len(some)), np.diff(np.r_[start, len(index)]))
            by_value = (slope[owner] * value)[:, None]
            grown = by_value * np.c_[sums[owner] - machine.factors[index] * value[:, None], np.ones(len(index))]
            used, place = np.unique(index, return_inverse=True)
            total = np.zeros((len(used), FACTORS + 1))
            np.add.at(total, place, grown)
            total += SHRINK * np.c_[machine.factors[used], machine.linear[used]]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * total
            second[used] = 0.999 * second[used] + 0.001 * total * total
            move = RATE * (first[used] / (1 - 0.9**step)) / (np.sqrt(second[used] / (1 - 0.999**step)) + 1e-8)
            machine.factors[used] -= move[:, :-1]
            machine.linear[used] -= move[:, -1]
            bias_first = 0.9 * bias_first + 0.1 * slope.sum()
            bias_second = 0.999 * bias_second + 0.001 * slope.sum() ** 2
            machine.bias -= RATE * (bias_first / (1 - 0.9**step)) / (np.sqrt(bias_second / (1 - 0.999**step)) + 1e-8)
    machine.bias += log_odds(share) - log_odds(float(y.mean()))
    return machine


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [raw_features(t) for t in batch.column("_text").to_pylist()]
        columns = [pa.array([r[i] for r in rows], pa.list_(pa.float64() if i != 1 else pa.int64())) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, batch.column("label")], ["statistics", "index", "value", "label"])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = SAMPLE) -> Machine:
    """A machine from the usable rows of ``labels`` (doc_id, quality). Without documents of both classes its score is
    the share of good labels everywhere."""
    sample, share = labelled_sample(docs, labels, "quality", usable, per_class)
    kinds = "statistics array<double>, index array<long>, value array<double>, label int"
    rows = sample.select("_text", "label").mapInArrow(_prepared, kinds).toArrow()
    y = rows["label"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        size = N_STATISTICS + BUCKETS
        nothing = np.zeros(N_STATISTICS)
        return Machine(nothing, nothing + 1, log_odds(share), np.zeros(size), np.zeros((size, FACTORS)))
    return learn(list(zip(*(_arrays(rows[c]) for c in ("statistics", "index", "value")), strict=True)), y, share)


def _arrays(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of its flat values."""
    out: list[np.ndarray] = []
    for chunk in lists.chunks:
        offsets = chunk.offsets.to_numpy()
        flat = chunk.values.to_numpy()
        out += [flat[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    return out


def score_column(machine: Machine, docs: DataFrame, text_col: str = "text") -> Column:
    """The score of each row's text as a column; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts))

    return score(F.coalesce(F.col(text_col), F.lit("")))


def quality(docs: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """Key, doc_id, score (0 to 1) and predicted for each row of ``docs`` (doc_id, text).

    The whole text counts. A null or empty text has no words and the statistics of an empty one. Rows that repeat a
    text have the same score; a null doc_id stays null; an empty table gives no rows; other columns are not read.
    """
    texts = keyed(docs)
    scored = texts.select(*KEY, score_column(machine, docs, "_text").alias("score"))
    return scored.select(*KEY, public_id().alias("doc_id"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    held = docs.toDF(*names)
    score = score_column(machine, docs, names[docs.columns.index("text")])
    return held.filter(score >= threshold).toDF(*docs.columns)
