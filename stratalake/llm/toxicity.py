"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text: by zstandard itself, from what is left of
the class's own documents without the words that both classes share. Both end with these shared words, so that what a
window of words saves with one against the other is due to the class. The share of a document's windows that save
so-and-so many bytes gives its score, through a logistic curve fitted on labelled documents kept apart from the
dictionaries' words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, keyed, public_id, written
from stratalake.llm.sampling import labelled_sample, log_odds, logistic

#: Words of a window, and how many further the next begins.
WINDOW, STEP = 12, 6
LEVEL = 6
#: Bytes of a dictionary's own, trained part and of the common words. What is trained beyond the class's own words is
#: chance, which costs accuracy: with 4 KiB and more, windows of ordinary words differ too.
OWN, COMMON = 1 << 10, 32 << 10
#: Bytes of the segments that the training selects, and of the pieces that it counts.
SEGMENT, PIECE = 32, 6
#: How far (in standard errors) a word's share of one class's documents is above the other's to be left for training.
APART = 5.0
#: Labelled documents of each class to learn from: a bounded sample by design, half for the dictionaries.
SAMPLE = 6000
SAVED = (2, 3, 4, 5, 6, 8, 10)

_SEPARATORS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: str) -> list[bytes]:
    """Words in lower case (A-Z), without ASCII punctuation."""
    return text.encode().lower().translate(_SEPARATORS).split()


@dataclass(frozen=True)
class Dictionaries:
    toxic: bytes
    ordinary: bytes

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for content in (self.ordinary, self.toxic):
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, **bare))
        return out


def _joined(words: list[bytes], room: int) -> bytes:
    """The first words that fit, the first one last: near matches are the cheapest."""
    size, kept = 0, []
    for w in words:
        size += len(w) + 1
        if size > room:
            break
        kept.append(w)
    return b" ".join(reversed(kept))


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, label in zip(batch.column("_text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            found = list(set(plain_words(text)))
            columns = [pa.array(found, pa.binary()), pa.array(np.full(len(found), label, np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "label"])


def train_dictionaries(sample: DataFrame) -> Dictionaries:
    """From ``_text`` and ``label``. Words are counted by document in Spark; what comes back fits the dictionaries."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    words = sample.select("_text", "label").mapInArrow(_distinct_words, "word binary, label int")
    counts = words.groupBy("word").agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0"))
    share = (F.col("n1") + F.col("n0") + 1) / F.lit(n1 + n0 + 2)
    error = F.sqrt(share * (1 - share) * F.lit(1 / n1 + 1 / n0))
    counts = written(counts.withColumn("z", (F.col("n1") / n1 - F.col("n0") / n0) / error))

    def best(df: DataFrame, order: Column, room: int) -> list[bytes]:
        # A word takes a byte and a space at least.
        return [bytes(r["word"]) for r in df.orderBy(order, "word").limit(room // 2).collect()]

    def trained(label: int, apart: Column, order: Column) -> bytes:
        own = best(counts.filter((F.length("word") > 3) & apart), order, COMMON)
        left = sample.filter(F.col("label") == label).select("_text").mapInArrow(_left(frozenset(own)), "left binary")
        return train([bytes(r["left"]) for r in left.collect()], own)

    common = _joined(best(counts.filter(F.abs("z") <= APART), F.desc("n0"), COMMON), COMMON)
    toxic, ordinary = trained(1, F.col("z") > APART, F.desc("z")), trained(0, F.col("z") < -APART, F.asc("z"))
    return Dictionaries(toxic + b" " + common, ordinary + b" " + common)


def _left(words: frozenset[bytes]):
    """Of each text, which of ``words`` it has, in order of first use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (dict.fromkeys(w for w in plain_words(t) if w in words) for t in batch.column("_text").to_pylist())
            kept = [b" ".join(t) + b" " for t in texts if t]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary())], ["left"])

    return run


def train(texts: list[bytes], words: list[bytes]) -> bytes:
    """A dictionary trained on ``texts``; where they are too few for that, the ``words`` that fit."""
    try:
        return zstandard.train_dictionary(OWN, sorted(texts), k=SEGMENT, d=PIECE).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return _joined(words, OWN)


def savings(text: str, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> np.ndarray:
    """Bytes that each window of a text saves with the toxic dictionary against the ordinary one."""
    words = plain_words(text)
    starts = range(0, max(1, len(words) - STEP), STEP)
    windows = (b" ".join(words[i : i + WINDOW]) for i in starts)
    return np.fromiter((len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows), np.int64, len(starts))


def features(saved: np.ndarray) -> np.ndarray:
    n = len(saved)
    above = np.array([(saved >= s).sum() for s in SAVED])
    return np.r_[above / n, np.log1p(above), saved.mean(), np.log(n)]


N_FEATURES = 2 * len(SAVED) + 2


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features_of(dictionaries: Dictionaries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = dictionaries.compressors()
        for batch in batches:
            rows = [features(savings(t, *pair)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])

    return run


def fit(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = SAMPLE) -> Model:
    """A model from the usable rows of ``labels`` (doc_id, toxic). Without documents of both classes its score is the
    share of toxic labels everywhere."""
    sample, share = labelled_sample(docs, labels, "toxic", usable, per_class)
    sample = written(sample.withColumn("_fold", F.pmod(F.xxhash64("_hash", F.lit("fold")), F.lit(2))))
    dictionaries = train_dictionaries(sample.filter("_fold = 0"))
    rows = sample.filter("_fold = 1").select("_text", "label").mapInArrow(_features_of(dictionaries), "x array<double>, label int")
    rows = rows.toArrow()
    y = rows["label"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return Model(dictionaries, np.zeros(N_FEATURES), np.ones(N_FEATURES), np.r_[log_odds(share), np.zeros(N_FEATURES)])
    x = np.array(rows["x"].to_pylist())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = logistic(np.c_[np.ones(len(x)), (x - mean) / scale], y)
    weights[0] += log_odds(share) - log_odds(float(y.mean()))
    return Model(dictionaries, mean, scale, weights)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.dictionaries.compressors()
        for batch in batches:
            x = np.array([features(savings(t.as_py(), *pair)) for t in batch.column("_text")]).reshape(-1, N_FEATURES)
            columns = [batch.column("_id"), batch.column("_hash"), pa.array(model.probability(x))]
            yield pa.RecordBatch.from_arrays(columns, [*KEY, "score"])

    return run


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """Key, doc_id, score (0 to 1) and predicted for each row of ``docs`` (doc_id, text), in order of no kind.

    Every window of a text counts. A null or empty text has one empty window, which saves nothing. Rows that repeat a
    text have the same score; a null doc_id stays null; an empty table gives no rows; other columns are not read.
    """
    scored = keyed(docs).mapInArrow(_scores(model), "_id long, _hash long, score double")
    return scored.select(*KEY, public_id().alias("doc_id"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
