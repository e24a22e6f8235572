"""Coverage, precision and bucket metrics: partial aggregates before one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_any(df: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """For each key whether any of its rows has the flag."""
    return df.groupBy(key).agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()])


def coverage(df: DataFrame, group: list[str], flags: list[str], total: str = "items") -> DataFrame:
    """Rows and rows with each flag, by group."""
    return df.groupBy(*group).agg(F.count("*").alias(total), *[F.count_if(F.col(f)).alias(f"with_{f}") for f in flags])


def coverage_rollup(df: DataFrame, group: str, flags: list[str], total: str = "items") -> DataFrame:
    """Overall (group null) and by group, from one pass."""
    return df.rollup(group).agg(F.count("*").alias(total), *[F.count_if(F.col(f)).alias(f"with_{f}") for f in flags])


def audited_precision(df: DataFrame, group: str, label: str) -> DataFrame:
    """Share of true labels; null unless every row of the group is labelled."""
    n, k = F.count("*"), F.count(label)
    return df.groupBy(group).agg(n.alias("selected"), k.alias("labelled"), F.when((n == k) & (n > 0), F.count_if(F.col(label)) / n).alias("precision"))


def bucket_metrics(df: DataFrame, bucket: Column, buckets: list[str], flag: Column) -> DataFrame:
    """Counts and percentages (two places) for a fixed list of buckets, empty ones with zeros."""
    spark = df.sparkSession
    fixed = spark.createDataFrame([(b,) for b in buckets], "bucket string")
    got = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.count_if(flag).alias("k"))
    out = fixed.join(got, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("items"), F.coalesce("k", F.lit(0)).alias("with_flag"))
    return out.withColumn("pct", F.when(F.col("items") > 0, F.round(100.0 * F.col("with_flag") / F.col("items"), 2)).otherwise(0.0))


def collapse(df: DataFrame, key: str, any_of: dict[str, Column], max_of: dict[str, Column], votes: dict[str, Column], sets: dict[str, Column]) -> DataFrame:
    """One row a key: any, max, tri-state votes (null if rows differ or none is known) and sorted sets."""
    vote = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
    return df.groupBy(key).agg(
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in any_of.items()],
        *[F.max(c).alias(n) for n, c in max_of.items()],
        *[vote(c).alias(n) for n, c in votes.items()],
        *[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(n) for n, c in sets.items()],
    )


def token_signature(c: Column) -> Column:
    """The words of a name in order, so that `Ann Lee` equals `Lee Ann`."""
    return F.array_join(F.array_sort(F.split(F.lower(F.trim(c)), r"\s+")), " ")
