"""Deduplication, best-row selection and bounded lists. One shuffle on the key each; no group is gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in this order. WindowGroupLimit prunes before the shuffle."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of each key: an argmax aggregate, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*")


def first_wins(df: DataFrame, key: str, order: list[str], limit: int | None = None) -> DataFrame:
    """The first row of each key, and of those the first `limit` in order: duplicates never use up the limit."""
    rest = [c for c in df.columns if c != key]
    out = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(key, "__r.*").select(*df.columns)
    return out if limit is None else out.orderBy(*order).limit(limit)


def distinct_by_key(items: Column, key) -> Column:
    """Array elements, the first of each key, in order; elements with an empty key go."""
    keyed = F.filter(F.transform(items, lambda x: F.struct(key(x).alias("k"), x.alias("v"))), lambda x: F.length(x["k"]) > 0)
    kept = F.filter(keyed, lambda x, i: F.array_position(F.transform(keyed, lambda y: y["k"]), x["k"]) == i + 1)
    return F.transform(kept, lambda x: x["v"])


def worklist(df: DataFrame, eligible: Column, order: list[Column], limit: int) -> DataFrame:
    """The first `limit` eligible rows."""
    return df.where(eligible).orderBy(*order).limit(limit)


def ranked_groups(df: DataFrame, key: str, order: Column, sample: str, samples: int = 4) -> DataFrame:
    """Groups by falling count, then name, with the first few samples of each (kept by a pruned window, not gathered)."""
    top = df.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("__n") <= samples)
    shown = top.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", sample))), lambda x: x[sample].cast("string")), ",").alias("samples"))
    return df.groupBy(key).agg(F.count("*").alias("n")).join(shown, key)
