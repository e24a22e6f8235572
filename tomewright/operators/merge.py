"""Merging records of several datasets: equal but for optional fields, latest snapshots, conflicts as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merge_records(df: DataFrame, id_: str, order: str, optional: list[str], lists: tuple[str, ...] = ()) -> DataFrame:
    """One row an id: the first one's fields, optional ones from the first that has them, lists as ordered unions.

    conflict is true where other fields differ, or two rows have different values for an optional one.
    """
    fixed = [c for c in df.columns if c not in (id_, order, *optional, *lists)]
    first = lambda c: F.min_by(c, F.struct(order)).alias(c)
    known = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    union = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, c))), lambda x: x[c]))).alias(c)
    differs = F.count_distinct(F.to_json(F.struct(*fixed), {"ignoreNullFields": "false"})) > 1 if fixed else F.lit(False)
    for c in optional:
        differs = differs | (F.count_distinct(c) > 1)
    return df.groupBy(id_).agg(*[first(c) for c in fixed], *[known(c) for c in optional], *[union(c) for c in lists], F.min(order).alias(order), differs.alias("conflict"))


def merge_snapshots(df: DataFrame, id_: str, time: str, content: str, identity: list[str], order: list[Column] | None = None) -> DataFrame:
    """The latest snapshot of each id, and whether its history has a conflict: a changed identity, or two contents at one time."""
    at = df.groupBy(id_, time).agg(F.count_distinct(content).alias("__contents")).groupBy(id_).agg((F.max("__contents") > 1).alias("same_time_conflict"))
    shown = F.to_json(F.struct(*identity), {"ignoreNullFields": "false"}) if identity else F.lit("")
    latest = df.withColumn("__n", F.row_number().over(W.partitionBy(id_).orderBy(F.col(time).desc(), *(order or [F.col(content)])))).where("__n = 1").drop("__n")
    changed = df.groupBy(id_).agg((F.count_distinct(shown) > 1).alias("identity_conflict"))
    return latest.join(at, id_).join(changed, id_)


def preferred_sources(toc: DataFrame, preferences: DataFrame) -> DataFrame:
    """Entries of preferred sources only, for books whose preferred source has any; all entries of other books."""
    wanted = preferences.select("book_id", F.col("source_id").alias("__wanted"))
    active = toc.select("book_id", "source_id").distinct().join(wanted, ["book_id"]).where("source_id = __wanted").select("book_id", "__wanted").distinct()
    return toc.join(active, "book_id", "left").where("__wanted IS NULL OR source_id = __wanted").drop("__wanted").select(toc.columns)
