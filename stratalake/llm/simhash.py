"""Near duplicates by SimHash, found with the general pigeonhole principle.

Bits that go together are put into the same part of the fingerprint, so that the parts differ in how selective they
are. If the thresholds t of m parts add up to distance - m + 1, fingerprints within the distance are within t in some
part; -1 leaves a part out. Each fingerprint gets the thresholds that promise the fewest probes and candidates, by
dynamic programming on counts estimated from block histograms. It probes the values near its own in each part, and what
it meets is verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, NULL_ID, keyed, public_id, with_key, written
from stratalake.llm.components import components

WORDS = 3
DISTANCE = 3
SEED = 42
#: Blocks of the fingerprint with a histogram each.
BLOCKS, BLOCK_BITS = 8, 8
#: Members of a bucket that one task compares; larger buckets are split into pairs of such pieces.
PIECE = 8192


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Hashes of a text's runs of ``words`` words, repeats included: A-Z lower-cased, split at ASCII white space. A text
    of fewer words is one run; one without words has none."""
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(length + 1) - 1
    begins, ends = (end - length)[: len(parts) - words + 1].tolist(), end[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends, strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes set it."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        total += _bits(hashes[i : i + 65_536]).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str, words: int = WORDS) -> int:
    return majority(shingle_hashes(text, words))


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column("_text")), np.uint64, batch.num_rows)
            columns = [batch.column("_id"), batch.column("_hash"), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*KEY, "fp"])

    return run


def fingerprints(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """Key and ``fp`` of each row of ``texts`` (``_id``, ``_hash``, ``_text``)."""
    return texts.select(*KEY, "_text").mapInArrow(_fingerprints(words), "_id long, _hash long, fp long")


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often bits are set together, in the fingerprints of a task."""
    total = np.zeros((64, 64), np.int64)
    n = 0
    for batch in batches:
        bits = _bits(batch.column("fp").to_numpy()).astype(np.float32)
        total += (bits.T @ bits).astype(np.int64)
        n += len(bits)
    rows = np.r_[np.arange(64 * 64), 64 * 64]
    yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.r_[total.ravel(), n])], ["cell", "n"])


def _sums(df: DataFrame, cells: int) -> np.ndarray:
    """Totals of a table of fixed size, counted by each task over its rows."""
    out = np.zeros(cells, np.int64)
    for row in df.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return out


def correlated_order(prints: DataFrame) -> list[int]:
    """The 64 bits in blocks of bits that correlate, over all fingerprints; like blocks stand side by side."""
    counts = _sums(prints.select("fp").mapInArrow(_together, "cell long, n long"), 64 * 64 + 1)
    n = max(1, counts[-1])
    joint = counts[:-1].reshape(64, 64) / n
    p = np.diag(joint)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    corr = np.abs(np.divide(joint - np.outer(p, p), spread, out=np.zeros((64, 64)), where=spread > 0))
    np.fill_diagonal(corr, 0)
    left, order = set(range(64)), []
    while left:
        rest = sorted(left)
        # The next block begins with the bit closest to the block before, or to all others.
        near = corr[np.ix_(rest, order[-BLOCK_BITS:] or rest)].sum(axis=1)
        block = [rest[int(near.argmax())]]
        left.remove(block[0])
        while len(block) < BLOCK_BITS:
            rest = sorted(left)
            block.append(rest[int(corr[np.ix_(rest, block)].sum(axis=1).argmax())])
            left.remove(block[-1])
        order += block
    return order


def _reorder(order: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy()
            moved = np.packbits(np.ascontiguousarray(_bits(prints)[:, order]), axis=1, bitorder="little")
            moved = np.ascontiguousarray(moved).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(moved), batch.column("first")], ["fp", "code", "first"])

    return run


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BLOCKS, 256), np.int64)
    for batch in batches:
        values = batch.column("code").to_numpy().view(np.uint8).reshape(-1, BLOCKS)
        for k in range(BLOCKS):
            total[k] += np.bincount(values[:, k], minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS * 256)), pa.array(total.ravel())], ["cell", "n"])


def ball(bits: int, radius: int) -> int:
    out, term = 0, 1
    for d in range(radius + 1):
        out += term
        term = term * (bits - d) // (d + 1)
    return out


class Pigeonhole:
    """Thresholds for parts of the reordered fingerprint. Parts are runs of blocks."""

    def __init__(self, histogram: np.ndarray, distance: int) -> None:
        self.distance, self.count = distance, max(1, int(histogram[0].sum()))
        apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))
        share = histogram / self.count
        #: Of each block and value: the share of fingerprints at each distance in the block.
        self.near = np.stack([[share @ (apart[v] == d) for d in range(distance + 1)] for v in range(256)]).transpose(2, 0, 1)
        mean = np.stack([share[k] @ self.near[k] for k in range(BLOCKS)])
        layouts = [self._layout(m) for m in range(2, min(BLOCKS, distance + 1) + 1)] or [self._layout(1)]
        self.parts = min(layouts, key=lambda parts: self._allocate(*self._costs([mean[k : k + 1] for k in range(BLOCKS)], parts))[1][0])

    @staticmethod
    def _layout(m: int) -> list[tuple[int, int]]:
        edges = [round(i * BLOCKS / m) for i in range(m + 1)]
        return list(zip(edges, edges[1:], strict=False))

    def _costs(self, near: list[np.ndarray], parts: list[tuple[int, int]]) -> list[np.ndarray]:
        """For each part, the cost of thresholds -1 to distance: values to probe and fingerprints to meet there."""
        costs = []
        for a, b in parts:
            joint = near[a]
            for k in range(a + 1, b):
                joint = np.stack(
                    [sum(joint[:, i] * near[k][:, d - i] for i in range(d + 1)) for d in range(self.distance + 1)], axis=1
                )
            probes = [ball((b - a) * BLOCK_BITS, d) for d in range(self.distance + 1)]
            costs.append(np.c_[np.zeros(len(joint)), np.array(probes) + np.cumsum(joint, axis=1) * self.count])
        return costs, self.distance + 1

    @staticmethod
    def _allocate(costs: list[np.ndarray], units: int) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds (rows by parts) whose ``t + 1`` add up to ``units``, and their cost."""
        rows = len(costs[0])
        best = np.full((rows, units + 1), np.inf)
        best[:, 0] = 0
        picks = []
        for cost in costs:
            options = np.full((rows, units + 1, units + 1), np.inf)
            for u in range(units + 1):
                for x in range(min(u, cost.shape[1] - 1) + 1):
                    options[:, u, x] = best[:, u - x] + cost[:, x]
            picks.append(options.argmin(axis=2))
            best = options.min(axis=2)
        out = np.zeros((rows, len(costs)), np.int64)
        left = np.full(rows, units)
        for i in range(len(costs) - 1, -1, -1):
            x = picks[i][np.arange(rows), left]
            out[:, i], left = x - 1, left - x
        return out, best[:, units]

    def thresholds(self, codes: np.ndarray) -> np.ndarray:
        values = codes.view(np.uint8).reshape(-1, BLOCKS)
        near = [self.near[k][values[:, k]] for k in range(BLOCKS)]
        return self._allocate(*self._costs(near, self.parts))[0]


def _masks(bits: int, radius: int) -> np.ndarray:
    """All values of ``bits`` bits with exactly ``radius`` set."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(bits), radius)], np.int64)


ENTRY = "bucket long, code long, probe boolean"


def _entries(plan: Pigeonhole):
    """A row for each part of a fingerprint, and one for each other value that it probes."""

    def emit(part: int, value: np.ndarray, code: np.ndarray, probe: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(code), 65_536):
            s = slice(i, i + 65_536)
            columns = [pa.array(value[s] | (part << 48)), pa.array(code[s]), pa.array(probe[s])]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "code", "probe"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy()
            chosen = plan.thresholds(codes)
            for part, (a, b) in enumerate(plan.parts):
                width = (b - a) * BLOCK_BITS
                value = ((codes.view(np.uint64) >> np.uint64(a * BLOCK_BITS)) & np.uint64((1 << width) - 1)).view(np.int64)
                t = chosen[:, part]
                yield from emit(part, value, codes, t >= 0)
                for radius in range(1, int(t.max(initial=0)) + 1):
                    some = np.flatnonzero(t >= radius)
                    masks = _masks(width, radius)
                    for i in range(0, len(some), max(1, 200_000 // len(masks))):
                        rows = some[i : i + max(1, 200_000 // len(masks))]
                        probed = (value[rows][:, None] ^ masks[None, :]).ravel()
                        yield from emit(part, probed, np.repeat(codes[rows], len(masks)), np.ones(len(probed), bool))

    return run


def _linked(code: np.ndarray, probe: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """Links of one bucket as stars: a member, and the members connected with it. A pair needs a probing member.

    Grows one component after the other; what a component has taken is not compared again, so a bucket of near copies
    costs little more than one look at each.
    """
    left, asks = code.view(np.uint64), probe
    while len(left) > 1:
        root, front, front_asks = int(left[:1].view(np.int64)[0]), left[:1], asks[:1]
        left, asks = left[1:], asks[1:]
        while len(front) and len(left):
            some, some_asks = front[:256], front_asks[:256]
            front, front_asks = front[256:], front_asks[256:]
            hit = np.zeros(len(left), bool)
            if some_asks.any():
                hit |= (np.bitwise_count(some[some_asks][:, None] ^ left) <= distance).any(axis=0)
            if not some_asks.all():
                others = np.flatnonzero(asks & ~hit)
                hit[others] |= (np.bitwise_count(some[~some_asks][:, None] ^ left[others]) <= distance).any(axis=0)
            if hit.any():
                yield root, left[hit].view(np.int64)
                front, front_asks = np.r_[front, left[hit]], np.r_[front_asks, asks[hit]]
                left, asks = left[~hit], asks[~hit]


def whole_buckets(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[np.ndarray, ...]]:
    """``bucket``, ``piece`` and other columns of rows sorted by the two, many at a time, no bucket's piece torn."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "piece", *columns))
        held.append(now)
        if now[0][0] == now[0][-1] and now[1][0] == now[1][-1]:
            continue
        whole = tuple(np.concatenate(c) for c in zip(*held, strict=True))
        last = np.flatnonzero((whole[0] != whole[0][-1]) | (whole[1] != whole[1][-1]))[-1] + 1
        yield tuple(c[:last] for c in whole)
        held = [tuple(c[last:] for c in whole)]
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def _verify(distance: int):
    """Links within buckets; rows come sorted by bucket and piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, piece, code, probe in whole_buckets(batches, "code", "probe"):
            new = np.r_[True, (bucket[1:] != bucket[:-1]) | (piece[1:] != piece[:-1])]
            group = np.cumsum(new) - 1
            size = np.bincount(group)
            # Buckets of a few members: each with the next, the next but one, and so on, over all buckets at once.
            u, v = [], []
            few = size <= 8
            for step in range(1, int(size[few].max(initial=0))):
                i = np.flatnonzero((group[step:] == group[:-step]) & few[group[step:]])
                i = i[probe[i] | probe[i + step]]
                i = i[np.bitwise_count(code[i].view(np.uint64) ^ code[i + step].view(np.uint64)) <= distance]
                u.append(code[i])
                v.append(code[i + step])
            start = np.flatnonzero(new)
            for g in np.flatnonzero(~few).tolist():
                members = slice(start[g], start[g] + size[g])
                for root, found in _linked(code[members], probe[members], distance):
                    u.append(np.full(len(found), root, np.int64))
                    v.append(found)
            if u:
                u, v = np.concatenate(u), np.concatenate(v)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["a", "b"])

    return run


def in_pieces(entries: DataFrame, members: list[str], piece: int) -> DataFrame:
    """``entries`` (bucket, probe, members) with a ``piece``, sorted by both within partitions. Any two members of a
    bucket of which one probes meet in some piece.

    A bucket of more than ``piece`` members is a table: its probing members are cut into rows and all members into
    columns, and each cell is a piece.
    """
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("all"), F.count_if("probe").alias("asking"))
    large = written(sizes.filter(F.col("all") > piece))
    large = large.select("bucket", F.ceil(F.col("asking") / piece).alias("rows"), F.ceil(F.col("all") / piece).alias("columns"))
    row, column = (F.pmod(F.xxhash64(*members, F.lit(salt)), F.greatest(F.lit(1), F.col(n))) for salt, n in ((0, "rows"), (1, "columns")))
    cut = entries.join(large, "bucket", "left").withColumns({"row": row, "column": column})
    at = F.expr(
        """CASE WHEN rows IS NULL THEN array(0L)
        WHEN probe THEN array_union(transform(sequence(0L, columns - 1), c -> row * columns + c),
            transform(sequence(0L, rows - 1), r -> r * columns + column))
        WHEN rows > 0 THEN transform(sequence(0L, rows - 1), r -> r * columns + column)
        ELSE array() END"""
    )
    placed = cut.select("bucket", F.explode(at).alias("piece"), *members, "probe")
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, "bucket", "piece").sortWithinPartitions("bucket", "piece")


def links(codes: DataFrame, plan: Pigeonhole, piece: int = PIECE) -> DataFrame:
    """Pairs (a, b) of codes that connect all codes within the plan's distance, as stars, not all pairs."""
    entries = codes.select("code").mapInArrow(_entries(plan), ENTRY)
    return in_pieces(entries, ["code"], piece).mapInArrow(_verify(plan.distance), "a long, b long")


def near_components(prints: DataFrame, distance: int = DISTANCE, piece: int = PIECE) -> DataFrame:
    """``fp``, ``component``, the smallest ``_id`` that its chain of near fingerprints reaches, and ``root``, which names
    the chain itself.

    ``prints``: ``_id`` and ``fp``. Equal fingerprints are one node, however many rows have them.
    """
    distinct = written(prints.groupBy("fp").agg(F.min("_id").alias("first")))
    codes = written(distinct.mapInArrow(_reorder(correlated_order(distinct)), "fp long, code long, first long"))
    histogram = _sums(codes.select("code").mapInArrow(_histogram, "cell long, n long"), BLOCKS * 256).reshape(BLOCKS, 256)
    found = components(links(codes, Pigeonhole(histogram, distance), piece))
    rooted = codes.join(found.withColumnRenamed("node", "code"), "code", "left")
    rooted = written(rooted.select("fp", "first", F.coalesce("root", "code").alias("root")))
    smallest = written(rooted.groupBy("root").agg(F.min("first").alias("component")))
    return written(rooted.join(smallest, "root").select("fp", "component", "root"))


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, piece: int = PIECE) -> DataFrame:
    """Key, doc_id, ``fp`` (a signed long) and ``component`` of each row of ``docs`` (doc_id, text).

    A text of fewer words than a shingle is one shingle; one without words, empty or null has fingerprint zero, which
    links as any other. A null doc_id comes after all others. Rows that repeat an id or a text have the same
    fingerprint and component. An empty table gives no rows; other columns are not read.
    """
    prints = written(fingerprints(keyed(docs), words))
    found = prints.join(near_components(prints, distance, piece), "fp")
    return found.select(*KEY, public_id().alias("doc_id"), "fp", "component")


def one_of_each(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, piece: int = PIECE) -> DataFrame:
    """The rows of ``docs`` but those that chain to a document with a smaller doc_id by near fingerprints.

    Of rows that repeat an id one stays, and the others neither chain nor drop any document. A null doc_id names no
    document: such rows come after all others and count each by its text. Only texts chain, never ids. Texts without
    words are alike. All columns stay; an empty table stays empty.
    """
    prints = written(fingerprints(keyed(docs), words))
    own = F.when(F.col("_id") == NULL_ID, F.col("_hash"))
    chosen = prints.groupBy("_id", own.alias("own")).agg(F.min(F.struct("_hash", "fp")).alias("row"))
    chosen = written(chosen.select("_id", "row.*"))
    near = near_components(chosen.select("_id", "fp"), distance, piece)
    # One row for each fingerprint, then for each chain, so a fingerprint that many rows share is no heavy group.
    first = chosen.groupBy("fp").agg(F.min(F.struct(*KEY)).alias("first"))
    stay = first.join(near, "fp").groupBy("root").agg(F.min("first").alias("first"))
    held, back = with_key(docs)
    return back(held.dropDuplicates(list(KEY)).join(written(stay.select("first.*")), list(KEY)))
