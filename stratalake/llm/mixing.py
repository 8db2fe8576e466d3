"""Mixing sources to target weights that change over training.

Each source has a weight schedule, piecewise linear over training time 0 to 1. Its integral gives the source's share
of all tokens and, inverted, the time at which the source's n-th token is due. A document copy is placed at the time
its first token is due; the mix is the copies sorted by that time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, NULL_ID, partitions_for, public_id, repeated, with_key, written

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that share a bucket on average, at least; a bucket's running sum is one task's work.
BUCKET_ROWS = 512
#: Weight over time as (time, factor) knots: every source's mean factor is 1, so that it alters order, not shares.
RISING, LEVEL, FALLING = ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (1.0, 0.5))


def cyclic_schedule(sources: DataFrame, weights: tuple[float, ...], shapes: tuple[tuple, ...]) -> DataFrame:
    """A schedule (source, knots) for each row of ``sources``: in code-point order, null last, sources take the given
    weights and shapes in turn. ``sources`` has a row per source, which is as small as the mix's recipe."""
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    knots = F.array(
        *[
            F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w * f)).alias("w")) for t, f in shapes[i % len(shapes)]])
            for i, w in enumerate(weights * len(shapes))
        ]
    )
    return sources.select("source", F.get(knots, (rank % (len(weights) * len(shapes))).cast("int")).alias("knots"))


def integrated(schedule: DataFrame) -> DataFrame:
    """The schedule with ``pieces``: start, end, weight at start, slope and area before, and ``area``, the integral."""
    piece = """transform(sequence(0, size(knots) - 2), i -> struct(
        knots[i].t as t0, knots[i + 1].t as t1, knots[i].w as w0,
        (knots[i + 1].w - knots[i].w) / (knots[i + 1].t - knots[i].t) as slope,
        (knots[i].w + knots[i + 1].w) / 2 * (knots[i + 1].t - knots[i].t) as area))"""
    placed = """transform(pieces, (p, i) -> struct(p.t0 as t0, p.t1 as t1, p.w0 as w0, p.slope as slope, p.area as area,
        aggregate(slice(pieces, 1, i), 0D, (a, q) -> a + q.area) as before))"""
    out = schedule.withColumn("pieces", F.expr(piece)).withColumn("pieces", F.expr(placed))
    return out.withColumn("area", F.expr("aggregate(pieces, 0D, (a, p) -> a + p.area)"))


def due_time(share: Column) -> Column:
    """The time at which ``share`` (0 to 1) of a source's demand has passed: the inverse of its cumulative weight."""
    need = share * F.col("area")
    piece = F.try_element_at(F.filter("pieces", lambda p: (p["before"] + p["area"] >= need) & (p["area"] > 0)), F.lit(1))
    piece = F.coalesce(piece, F.element_at("pieces", -1))
    left = need - piece["before"]
    root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + 2 * piece["slope"] * left, F.lit(0.0)))
    # The root of w0*x + slope*x^2/2 = left in the form that holds for a slope of zero as well.
    step = F.when(left <= 0, F.lit(0.0)).otherwise(F.try_divide(2 * left, piece["w0"] + root))
    return F.least(piece["t0"] + F.coalesce(step, F.lit(0.0)), piece["t1"])


def targets(sizes: DataFrame, schedule: DataFrame, tokens: Column, most: float) -> DataFrame:
    """``target`` tokens for each source: ``tokens`` shared by area, none above ``most`` times its size.

    The excess is reshared by weight. That is the level at which min(cap, level * weight) adds up to the tokens. With
    sources sorted by cap over weight, what is left after the caps before a source, over the weights from it on, rises
    up to the first source that stays below its cap, and falls after it: the level is the largest of these.
    """
    caps = sizes.join(integrated(schedule), sizes["source"].eqNullSafe(schedule["source"])).drop(schedule["source"])
    caps = caps.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.try_divide("cap", "area").asc_nulls_last(), F.col("source").asc_nulls_last())
    ahead = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = caps.withColumns(
        {
            "_capped": F.coalesce(F.sum("cap").over(ahead), F.lit(0.0)),
            "_weight": F.sum("area").over(everything) - F.coalesce(F.sum("area").over(ahead), F.lit(0.0)),
            "_tokens": tokens,
        }
    )
    level = F.greatest(F.try_divide(F.col("_tokens") - F.col("_capped"), F.col("_weight")), F.lit(0.0))
    filled = filled.withColumn("_level", F.coalesce(F.max(level).over(everything), F.lit(0.0)))
    target = F.least("cap", F.col("_level") * F.col("area"))
    return filled.withColumn("target", target).drop("_capped", "_weight", "_tokens", "_level", "cap")


def _order(doc_id: Column, text: Column) -> Column:
    """What a source's documents are sorted by: a hash of id and text, so that no id or null is one heavy group."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit(""))))


def _copy(order: Column, source: Column) -> Column:
    """Rows with this in common are copies of each other: equal in id, text and source."""
    return F.md5(F.concat(order, F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))))


def _placed(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    shapes: tuple[tuple, ...] = (FALLING, LEVEL, RISING),
    scale: float = 1.5,
    most: float = 2.0,
    schedule: DataFrame | None = None,
) -> DataFrame:
    """A row for each id, text and source: ``_rows`` that have them, ``_start``, the source's words before the first of
    them, and the source's part of the plan."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    order = _order(F.col("doc_id"), text)
    rows = docs.select(
        _copy(order, F.col("source")).alias("_copy"),
        order.alias("_order"),
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(text).alias("_hash"),
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )
    # Copies become one row with their number, inside each task first, before a source's rows are put in order.
    groups = written(rows.groupBy(*rows.columns).agg(F.count("*").alias("_rows")))
    words = F.col("size") * F.col("_rows")
    sizes = groups.groupBy("source").agg(F.sum(words).alias("source_size"))
    if schedule is None:
        schedule = cyclic_schedule(sizes.select("source"), weights, shapes)
    tokens = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(scale))
    plan = written(targets(sizes, schedule, tokens, most))

    # Running sums by source in two steps, so that a source of any size is spread over many tasks: the order begins
    # with the bucket. Buckets hold as many rows as there are buckets, and never few.
    total = groups.count()
    buckets = max(1, -(-total // max(BUCKET_ROWS, math.isqrt(total))))
    bucket = F.floor(F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / float(1 << 32) * buckets)
    n = partitions_for(spark, total, 500_000)
    placed = groups.withColumn("_bucket", bucket.cast("long"))
    per_bucket = placed.groupBy("source", "_bucket").agg(F.sum(words).alias("_sum"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select(
        F.col("source").alias("_s"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", *KEY).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.repartition(n, "source", "_bucket").withColumn("_inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))
    placed = placed.join(written(per_bucket), same).withColumn("_start", F.col("_before") + F.col("_inside"))
    plan = plan.withColumnRenamed("source", "_p")
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("_p")))
    own = ("_copy", *KEY, "source", "size", "_rows", "_start", "source_size", "target", "pieces", "area")
    return written(placed.select(*own, F.lit(-int(-most // 1)).alias("_most")))


def _positions() -> Column:
    """Times of the copies that the mix takes of row ``_nth`` of its group: copy e begins e times the source's size
    later, and is taken if its middle word falls within the target."""
    start = F.col("_start") + F.col("_nth") * F.col("size")
    begins = F.transform(F.sequence(F.lit(0), F.col("_most") - 1), lambda e: start + e * F.col("source_size"))
    taken = F.filter(begins, lambda b: (F.col("size") > 0) & (b + F.col("size") / F.lit(2.0) <= F.col("target")))
    return F.transform(taken, lambda b: due_time(F.least(b / F.col("target"), F.lit(1.0))))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, taken,
    ``positions``, the training times of its copies, and ``places``, their numbers in the whole mix from 0, plus the key
    of the row. ``options``: ``weights`` and ``shapes`` that sources take in turn, or a ``schedule`` (source, knots);
    ``scale``; ``most``.

    All sizes times ``scale`` are shared among the sources by weight. A source's documents follow each other in the
    order of a hash of id and text, over and over, ``most`` times at most; a copy is taken if its middle word falls
    within the target, so a source's words differ from its target by half a document at most. The copies are sorted by
    time and written; what a row says of its copies is read from there. Texts without words and null texts have size 0,
    are never taken and have no positions. A null source is a source of its own. Rows that repeat an id, a text and a
    source follow each other. A source that ``schedule`` lacks is not in the mix and in no row; without ``schedule``
    every source has one. An empty table gives no rows.
    """
    rows = repeated(_placed(docs, **options), "_rows", "_nth").withColumn("doc_id", public_id())
    own = ("_copy", "_nth")
    order = _numbered(training_order(rows.withColumn("positions", _positions()), *own))
    copies = order.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("place", "position"))).alias("_copies"))
    rows = rows.join(copies, [*own], "left").withColumns(
        {
            "positions": F.coalesce("_copies.position", F.array().cast("array<double>")),
            "places": F.coalesce("_copies.place", F.array().cast("array<bigint>")),
        }
    )
    taken = (F.col("size") * F.size("positions")).alias("taken")
    return rows.select(*KEY, "doc_id", "source", "size", "source_size", "target", taken, "positions", "places")


def training_order(mixed: DataFrame, *own: str) -> DataFrame:
    """Every copy that the mix takes, range-sorted by training time: position, copy, key, doc_id, source, size, and the
    columns ``own`` of its row."""
    spark = mixed.sparkSession
    copies = mixed.select(*KEY, "doc_id", "source", "size", *own, F.posexplode("positions").alias("copy", "position"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ("position", "source", *KEY, "copy")
    return copies.repartitionByRange(n, *order).sortWithinPartitions(*order)


def _numbered(order: DataFrame) -> DataFrame:
    """The rows of a range-sorted frame, written as they follow each other, and ``place``, their numbers from 0.

    A task numbers its own rows; the rows of the tasks before it, one number for each task, are added.
    """
    order = written(order.withColumn("_at", F.monotonically_increasing_id()))
    # The upper bits of that number are the task's, the lower 33 count its rows.
    order = order.withColumn("_task", F.shiftright("_at", 33))
    ahead = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = order.groupBy("_task").agg(F.count("*").alias("_n"))
    tasks = tasks.select("_task", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    placed = order.join(F.broadcast(tasks), "_task")
    return placed.withColumn("place", F.col("_ahead") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_task", "_at", "_ahead")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, copies repeated, in training order, with the columns of ``docs``.

    Rows that repeat an id, a text and a source are copies of each other: any one of them stands for all, as often as
    the mix takes all. So a text meets its place in the mix once, however many rows have it.
    """
    held, back = with_key(docs)
    doc_id, text, source = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text", "source"))
    held = held.withColumn("_copy", _copy(_order(doc_id, text), source)).drop(*KEY).dropDuplicates(["_copy"])
    taken = _placed(docs, **options).filter("size > 0 AND _start + size / 2.0D <= target")
    # What each row of a group is taken for is known from its number, so the join is one to one.
    rows = repeated(held.join(taken.drop("source"), "_copy"), "_rows", "_nth", counts=taken)
    out = rows.withColumn("_time", F.explode(_positions()))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = ("_time", *KEY)
    return back(out.repartitionByRange(n, *sort).sortWithinPartitions(*sort))
