"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

A document's size is its number of words `[^\\x20\\x09-\\x0D]+`. The sources in order of their names (by code point, null
last) get weights in turn; they share the sum of all sizes by weight, no source over `most` times its own size, the
excess being shared again by weight. A source's rate is its target by its size: the expected copies of each of its
documents. The documents of a source stand in a fixed order, the expected copies are summed up along it, a fixed
random offset of the source is added, and a document is emitted once for each whole number that its step crosses.
As neighbours in that order have nearly the same size, the words taken come near the target.

The order is that of size bins, then of hash buckets within them, so that the running sum needs no task to see a
source: counts are summed up over the bins of a source (some hundreds), then over the buckets of a bin, and rows are
numbered in their bucket only. One task sees one row for each source. Null and empty texts have
size 0; they count as documents and take no words. A null source is a source. Equal rows are interchangeable: their
copies as a whole are the same in every run. Empty tables give empty results. Only doc_id, text and source are read,
and the other columns by mix() only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tomewright.llm.common import work_table

WEIGHTS, MOST, SEED = (5.0, 2.0, 1.0), 3, 17
#: Rows of a bucket that are numbered in one task, about.
BUCKET_ROWS = 500


def word_count(text) -> "F.Column":
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size), one row a source.

    A source is capped where its cap by its weight is at most the level at which the others fill up; caps are reached
    in the order of that quotient, so one running sum finds the level.
    """
    nth = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (nth % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("cap", (most * F.col("source_size")).cast("double"))
    by = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = by.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level).withColumn("open", F.col("cap") / F.col("w") > F.col("level"))
    rows = rows.withColumn("fill", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)["level"])
    target = F.when(F.col("fill").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("fill") * F.col("w")))
    rows = rows.withColumn("target", target)
    return rows.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def sampled(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies of every row."""
    return _sampled(documents, weights, most, seed, ("doc_id",)).select(F.col("kept.keep_0").alias("doc_id"), "size", "source_size", "target", "copies")


def _sampled(documents: DataFrame, weights: tuple[float, ...], most: int, seed: int, keep: tuple[str, ...]) -> DataFrame:
    """kept (a struct of the columns to keep, by number, as their names may be any), size, source_size, target, copies."""
    own = [F.col(f"`{c}`").alias(f"keep_{k}") for k, c in enumerate(keep)]
    sized = documents.select(F.struct(*own).alias("kept"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("h"))
    sized = work_table(sized.withColumn("bin", F.floor(F.log2(F.col("size") + 1) * 64)), "sized")
    totals = work_table(sized.groupBy("source", "bin").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "totals")
    rates = source_targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    # each bin is dealt into as many hash buckets as it has BUCKET_ROWS
    before = lambda value, by: F.coalesce(F.sum(value).over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bins = totals.select("source", "bin", F.ceil(F.col("n") / BUCKET_ROWS).alias("parts"), before("n", W.partitionBy("source").orderBy("bin")).alias("bins_ahead"))
    same = lambda a, b, *names: [a[x].eqNullSafe(b[x]) for x in names]
    join = lambda a, b, *names: a.join(b, same(a, b, *names), "left").select(a["*"], *[b[x] for x in b.columns if x not in names])
    rows = join(sized, bins, "source", "bin").withColumn("sub", F.pmod("h", "parts")).drop("parts")
    counts = rows.groupBy("source", "bin", "bins_ahead", "sub").agg(F.count("*").alias("n"))
    ahead = F.col("bins_ahead") + before("n", W.partitionBy("source", "bin").orderBy("sub"))
    counts = counts.select("source", "bin", "sub", ahead.alias("ahead"))
    rows = rows.drop("bins_ahead")
    rows = join(join(rows, counts, "source", "bin", "sub"), rates, "source")
    nth = F.col("ahead") + F.row_number().over(W.partitionBy("source", "bin", "sub").orderBy("size", "h", "kept"))
    offset = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    step = lambda n: F.floor(n * F.col("rate") + offset)
    rows = rows.withColumn("nth", nth)
    copies = F.least(step(F.col("nth")) - step(F.col("nth") - 1), F.ceil("rate")).cast("long")
    return rows.select("kept", "size", "source_size", "target", copies.alias("copies"))


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with all its columns."""
    names = tuple(documents.columns)
    rows = _sampled(documents, weights, most, seed, names).where("copies > 0").select("kept", F.explode(F.expr("sequence(1L, copies)")))
    return rows.select(*[F.col(f"kept.keep_{k}").alias(c) for k, c in enumerate(names)])
