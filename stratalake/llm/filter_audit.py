"""How filters interact: which step removes a document, for every order of the filters at once.

A document's failures are a row of a mask matrix, 0 where it fails a filter and infinity where it passes. An order of
the filters is a column of its inverse permutation, the position of each filter. Their min-plus product is the step
that removes the document in that order, infinity if none does. Documents with the same failures are one row with a
weight, so the product has as many rows as there are sets of failures, whatever the corpus, and weighted sums of its
cells count what each step removes and what earlier steps had removed already.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import written

WORD_GAP = r"[\x20\x09-\x0D]+"
#: Filters whose orders are all listed; their number is the factorial.
MOST_FILTERS = 6
#: Marks at which a document counts besides as one: a name, and the label that must be 1.
LOSSES = (("good_lost", "quality"), ("toxic_lost", "toxic"))


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D over a text: few words, repetitive, many capitals, markup signs. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 100,
        "B": distinct * F.lit(100) < n * F.lit(80),
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def removal_steps(masks: np.ndarray, letters: str) -> np.ndarray:
    """(masks, orders): the step, from 0, that removes a document with these failures; ``len(letters)`` if none does.

    ``masks``: bit f is set if filter f fails.
    """
    m = len(letters)
    mask = np.where((masks[:, None] >> np.arange(m)) & 1, 0.0, np.inf)
    position = np.array([[order.index(f) for order in orders(letters)] for f in letters], float)
    steps = np.full((len(masks), position.shape[1]), np.inf)
    for f in range(m):
        np.minimum(steps, mask[:, f, None] + position[f][None, :], out=steps)
    return np.where(np.isinf(steps), m, steps).astype(np.int64)


def audit_part(masks: np.ndarray, weights: dict[str, np.ndarray], letters: str) -> pd.DataFrame:
    """A row per order and step from the weights of a part's masks: ``n`` and one weight for each loss."""
    m, names = len(letters), orders(letters)
    steps = removal_steps(masks, letters)
    columns = np.arange(len(names))

    def scattered(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((len(names), m + 1), np.int64)
        np.add.at(out, (np.broadcast_to(columns, steps.shape), steps), np.broadcast_to(weight[:, None], steps.shape))
        return out[:, :m]

    n = weights["n"]
    removed = scattered(n)
    # The filter at each step of each order, and by filter: who fails it, and who fails nothing else.
    filter_at = np.array([[letters.index(f) for f in order] for order in names])
    fails = np.array([n[(masks >> f) & 1 == 1].sum() for f in range(m)])
    alone = np.array([n[masks == 1 << f].sum() for f in range(m)])
    shapley = np.zeros(m, np.int64)
    np.add.at(shapley, filter_at, removed)
    out = {
        "filter_order": np.repeat(names, m),
        "step": np.tile(np.arange(1, m + 1), len(names)),
        "kept": n.sum() - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": fails[filter_at] - removed,
        "unique_fails": alone[filter_at],
        "shapley": shapley[filter_at],
    }
    out |= {k: scattered(w) for k, w in weights.items() if k != "n"}
    return pd.DataFrame({k: v.ravel() for k, v in out.items()})


def audit(weighted: DataFrame, letters: str, losses: tuple[str, ...] = ()) -> DataFrame:
    """``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``shapley`` and a
    column per loss, zeros included, for each part and each order of ``letters``.

    ``weighted``: part, mask (bit f: filter f fails), n, and one weight per loss; rows of one part and mask are added
    up. ``shapley`` is what the step's filter removes, summed over all orders. An empty table gives no rows.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) != len(letters):
        raise ValueError(f"1 to {MOST_FILTERS} different letters are needed")
    sums = weighted.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", *losses)])
    counts = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "shapley", *losses))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        weights = {k: rows[k].to_numpy() for k in ("n", *losses)}
        return audit_part(rows["mask"].to_numpy(), weights, letters).assign(part=key[0])

    # A part is at most one row for each set of failures.
    return sums.groupBy("part").applyInPandas(run, f"part string, filter_order string, step int, {counts}")


def failures(docs: DataFrame, part_col: str = "lang") -> DataFrame:
    """doc_id, ``part``, ``digest`` (SHA-256 of the text, which tells texts apart) and ``mask`` of filters A to D."""
    bits = text_failures(F.col("text"))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(bits.values())), F.lit(0))
    return docs.select(
        "doc_id",
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
        mask.alias("mask"),
    )


def _marks(labels: DataFrame, losses: tuple[tuple[str, str], ...]) -> DataFrame:
    marks = [F.max(F.when(F.col(label) == 1, 1).otherwise(0)).alias(name) for name, label in losses]
    return labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_label_id")).agg(*marks)


def weighted_failures(
    docs: DataFrame, labels: DataFrame, losses: tuple[tuple[str, str], ...] = LOSSES, part_col: str = "lang"
) -> DataFrame:
    """``part``, ``mask`` of filters A to E, ``n`` and a weight per loss, added up for each text, part and labels.

    Filter E fails for a text that a row with a smaller doc_id has, anywhere in the table. Texts are followed by
    digest and id only, and copies that share part and labels become one row with their number before they meet, so a
    text that a third of the rows have is no heavy group.
    """
    names = [name for name, _ in losses]
    rows = written(failures(docs, part_col))
    # A row without an id has no labels, so it need not meet the others in one task.
    known = rows.filter("doc_id IS NOT NULL").join(_marks(labels, losses), F.col("doc_id") == F.col("_label_id"), "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(0)) for c in names}).drop("_label_id")
    unknown = rows.filter("doc_id IS NULL").withColumns({c: F.lit(0) for c in names})
    kind = ["digest", "part", "mask", *names]
    by_id = known.unionByName(unknown).groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    # Rows that stay in a group are those of its smallest id, if that is the smallest of the text; null comes last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n"))
    groups = by_id.groupBy(*kind).agg(F.sum("n").alias("n"), first.alias("first"))
    lead = F.struct("first.none", "first.doc_id")
    fresh = F.when(lead == F.min(lead).over(Window.partitionBy("digest")), F.col("first.n")).otherwise(F.lit(0))
    met = groups.withColumn("fresh", fresh)
    stay = F.struct("mask", F.col("fresh").alias("n"))
    fail = F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("fresh")).alias("n"))
    out = met.select("part", *names, F.explode(F.array(stay, fail)).alias("cell")).filter("cell.n > 0")
    return out.select("part", "cell.mask", "cell.n", *[(F.col(c) * F.col("cell.n")).alias(c) for c in names])


def filter_audit(
    docs: DataFrame, labels: DataFrame, losses: tuple[tuple[str, str], ...] = LOSSES, part_col: str = "lang"
) -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, text, part) and ``labels`` (doc_id and a column per loss).

    A null text is empty, and a null part is the empty string. A null doc_id comes after all others: such a row fails
    E if its text stands under an id, has no labels, and does not make another fail. Rows that repeat an id and a text
    do not make each other fail, and are counted each. A document counts as lost if any row of its labels says 1; rows
    of ``labels`` without a document count nothing. An empty table gives no rows; other columns are not read.
    """
    names = tuple(name for name, _ in losses)
    return audit(weighted_failures(docs, labels, losses, part_col), "ABCDE", names)
