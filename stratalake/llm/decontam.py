"""Benchmark decontamination with a positional inverted index of the training text, in DataFrame operations only.

The index holds the postings (term, document, position) of the test set's rarest terms, each with the words around it,
and one posting for the end of every document, which gives its length. For each test window the list of its rarest term
and that of its second rarest are intersected after shifting both to the window's start; what is left is compared word
by word. Terms are rare by their count over the whole corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm.common import KEY, keyed, public_id, with_key, written

WINDOW = 13
#: What stands between words: ASCII other than digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Cannot be a word; stands for the end of a document.
END = "\0"
#: Test terms (and windows' anchors) that are broadcast at once; a larger test set takes one pass over the text for
#: each so many.
BLOCK = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold(word: Column) -> Column:
    """A-Z lower-cased; other letters stay."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def split_words(text: Column) -> Column:
    """Words of a text in the case they have there."""
    return F.array_remove(F.split(text, BETWEEN, -1), "")


def _blocks(terms: DataFrame, size: int) -> list[DataFrame]:
    """``terms`` in pieces of about ``size`` distinct terms, each small enough to broadcast."""
    n = max(1, -(-terms.select("term").distinct().count() // size))
    return [terms.filter(F.pmod(F.xxhash64("term"), F.lit(n)) == i) for i in range(n)] if n > 1 else [terms]


def test_items(items: DataFrame) -> DataFrame:
    """``item`` (a number), ``item_id`` as text, ``words``. Items without words are left out; a null id is empty."""
    words = F.transform(split_words(F.coalesce("text", F.lit(""))), fold)
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words.alias("words"))
    named = named.filter(F.size("words") > 0).distinct()
    return written(named.withColumn("item", F.monotonically_increasing_id()))


def term_counts(texts: DataFrame, items: DataFrame, block: int = BLOCK) -> DataFrame:
    """How often each term of the items occurs in all of ``texts``."""
    terms = written(items.select(F.explode("words").alias("term")).distinct())
    counts = []
    for some in _blocks(terms, block):
        found = texts.select(F.explode(split_words(F.col("_text"))).alias("word")).select(fold(F.col("word")).alias("term"))
        counted = found.join(F.broadcast(some), "term").groupBy("term").agg(F.count("*").alias("n"))
        counts.append(written(some.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def windows(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """A row for each window: item, item_id, words, length, start, and the places ``j1`` and ``j2`` in the item of its
    rarest and second rarest term. An item shorter than a window is one. A window of one term only has ``j2 = j1``."""
    each = items.select("item", F.posexplode("words").alias("j", "term")).join(counts, "term")
    ranked = each.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("j", "n", "term"))).alias("places"))
    out = items.join(ranked, "item").withColumn("length", F.least(F.size("words"), F.lit(window)))
    out = out.withColumn("start", F.explode(F.expr("sequence(0, size(words) - length)")))
    rarest = "array_sort(transform(slice(places, start + 1, length), p -> struct(p.n, p.term, p.j)))"
    out = out.withColumn("rarest", F.expr(rarest)).withColumn("first", F.expr("rarest[0]"))
    out = out.withColumn("second", F.expr("coalesce(get(filter(rarest, r -> r.term <> first.term), 0), first)"))
    return out.select(
        "item", "item_id", "words", "length", "start", F.col("first.j").alias("j1"), F.col("first.term").alias("term1"),
        F.col("second.j").alias("j2"), F.col("second.term").alias("term2"),
    )


def build_index(texts: DataFrame, terms: DataFrame, reach: int, block: int = BLOCK) -> DataFrame:
    """Postings of ``terms`` (term, around): term, key, pos, and up to ``reach`` words ``before`` (nearest first) and
    ``after``, where ``around`` asks for them. The posting of END has the document's length as ``pos``."""
    end = F.array(F.lit(END))
    out = None
    for k, some in enumerate(_blocks(terms, block)):
        wanted = some.unionByName(some.sparkSession.createDataFrame([(END, False)], some.schema)) if k == 0 else some
        listed = texts.select(*KEY, split_words(F.col("_text")).alias("words"))
        placed = listed.select(*KEY, "words", F.posexplode(F.concat("words", end)).alias("pos", "word"))
        met = placed.withColumn("term", fold(F.col("word"))).join(F.broadcast(wanted), "term")
        lead = F.least("pos", F.lit(reach))
        before = F.reverse(F.slice("words", F.col("pos") - lead + 1, lead))
        after = F.slice("words", F.col("pos") + 2, reach)
        # No lambda may stand here: it would break the generated code in two, and every posting would hold a copy of
        # its document's words between the halves. Words keep their case until they are read.
        around = [F.when(F.col("around"), w).alias(n) for w, n in ((before, "before"), (after, "after"))]
        stored = written(met.select("term", *KEY, "pos", *around))
        stored = stored.withColumns({n: F.transform(n, fold) for n in ("before", "after")})
        out = stored if out is None else out.unionByName(stored)
    return out


@dataclass(frozen=True)
class Index:
    """An index over ``texts`` for the windows of a test set."""

    postings: DataFrame
    windows: DataFrame
    block: int

    def lengths(self) -> DataFrame:
        return self.postings.filter(F.col("term") == END).select(*KEY, F.col("pos").alias("n_words"))

    def met(self, anchors: DataFrame) -> DataFrame:
        """Postings of the rarest term of each row of ``anchors``, kept where the second rarest term's list, shifted by
        their distance in the test item, has the same place."""
        firsts = []
        for some in _blocks(anchors.withColumnRenamed("term1", "term"), self.block):
            firsts.append(self.postings.join(F.broadcast(some), "term"))
        first = firsts[0]
        for more in firsts[1:]:
            first = first.unionByName(more)
        second = self.postings.join(anchors.select(F.col("term2").alias("term")).distinct(), "term", "left_semi")
        second = second.select(*KEY, F.col("term").alias("term2"), F.col("pos").alias("due"))
        due = F.col("pos") + F.col("j2") - F.col("j1")
        return first.withColumn("due", due).join(second, [*KEY, "term2", "due"], "left_semi")


def index_for(docs: DataFrame, items: DataFrame, window: int = WINDOW, reach: int | None = None, block: int = BLOCK) -> Index:
    """The index of ``docs`` for the windows of ``items`` (item_id, text)."""
    texts, items = keyed(docs), test_items(items)
    found = written(windows(items, term_counts(texts, items, block), window))
    first, second = found.select(F.col("term1").alias("term"), F.lit(True).alias("around")), found.select(
        F.col("term2").alias("term"), F.lit(False).alias("around")
    )
    terms = written(first.unionByName(second).groupBy("term").agg(F.bool_or("around").alias("around")))
    return Index(build_index(texts, terms, window - 1 if reach is None else reach, block), found, block)


def _agreement(words: str, others: str) -> Column:
    """How many words two lists share from their beginning on."""
    first_other = F.array_position(F.zip_with(words, others, lambda a, b: a.eqNullSafe(b)), F.lit(False))
    return F.when(first_other == 0, F.size(words)).otherwise(first_other - 1).cast("int")


def phrase_matches(index: Index) -> DataFrame:
    """Stretches of documents that consist of a test item's windows: key, item_id, and ``first`` and ``last``, places
    of words. A window's occurrence lies within one of them; stretches may overlap."""
    # Neighbouring windows with the same two anchors are found together.
    runs = index.windows.groupBy("item", "item_id", "words", "length", "j1", "term1", "j2", "term2").agg(
        F.min("start").alias("from"), F.max("start").alias("to")
    )
    anchors = written(
        runs.select(
            "item_id", "length", "j1", "term1", "j2", "term2", "from", (F.col("to") + F.col("length") - 1).alias("to"),
            F.expr("reverse(slice(words, from + 1, j1 - from))").alias("item_before"),
            F.expr("slice(words, j1 + 2, to + length - 1 - j1)").alias("item_after"),
        )
    )
    met = index.met(anchors)
    left = F.greatest(F.col("j1") - _agreement("before", "item_before"), F.col("from"))
    right = F.least(F.col("j1") + _agreement("after", "item_after"), F.col("to"))
    met = met.withColumns({"left": left, "right": right}).filter("right - left + 1 >= length")
    shift = F.col("pos") - F.col("j1")
    return met.select(*KEY, "item_id", (F.col("left") + shift).alias("first"), (F.col("right") + shift).alias("last"))


def proximity_matches(index: Index, slop: int) -> DataFrame:
    """Places where all terms of a window stand near its rarest term, in any order: key, item_id, start (the window's
    place in the item), pos (of the rarest term). ``slop`` words away counts as near; the index must reach that far."""
    anchors = written(
        index.windows.select(
            "item_id", "start", "j1", "term1", F.col("j1").alias("j2"), F.col("term1").alias("term2"),
            F.expr("array_distinct(slice(words, start + 1, length))").alias("wanted"),
        )
    )
    near = F.concat(F.slice("before", 1, slop), F.array("term"), F.slice("after", 1, slop))
    return index.met(anchors).filter(F.size(F.array_except("wanted", near)) == 0).select(*KEY, "item_id", "start", "pos")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = 20, block: int = BLOCK) -> DataFrame:
    """Key, doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``docs`` (doc_id, text).

    A word inside an occurrence of a test window is hit; a document is contaminated if at least one in ``share`` of its
    words is. Null and empty texts have no words. Rows that repeat an id and a text have the same result each. Items
    that repeat an id count once; a null item id is listed as empty text. Items without words, or an empty table of
    them, hit nothing. A null doc_id stays null. Other columns of either table are not read.
    """
    index = index_for(docs, items, window, block=block)
    found = written(phrase_matches(index))
    ahead = Window.partitionBy(*KEY).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("first"), F.coalesce(F.max("last").over(ahead) + 1, F.lit(0)))
    stretches = found.select(*KEY, "first", "last").distinct()
    hits = stretches.withColumn("hit", F.greatest(F.col("last") - fresh + 1, F.lit(0)))
    hits = hits.groupBy(*KEY).agg(F.sum("hit").cast("long").alias("n_hit"))
    named = found.groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (
        index.lengths()
        .join(written(hits.join(named, list(KEY))), list(KEY), "left")
        .select(
            *KEY,
            public_id().alias("doc_id"),
            F.col("n_words").cast("long").alias("n_words"),
            n_hit.alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"),
            F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
            ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = written(contamination(docs, items, **options).filter("contaminated").select(*KEY).distinct())
    held, back = with_key(docs)
    return back(held.join(bad, list(KEY), "left_anti"))
