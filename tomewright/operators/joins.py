"""Resolution, comparison and merge joins. Sides are joined on keys; sizes decide on broadcasts by themselves (AQE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tomewright.operators.dedupe import best_by


def tiered(base: DataFrame, key: str, tiers: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """key, value and tier: from the first tier that has the key (one row a key each), else null and `none`."""
    out, names = base, []
    for name, rows in tiers:
        out = out.join(rows.select(key, F.col(value).alias(f"__{name}")), key, "left")
        names.append(name)
    tier = F.coalesce(*[F.when(F.col(f"__{n}").isNotNull(), n) for n in names], F.lit("none"))
    return out.select(*base.columns, F.coalesce(*[F.col(f"__{n}") for n in names]).alias(value), tier.alias("tier"))


def same_group_alternate(df: DataFrame, key: str, group: list[str], cost: Column, order: list[Column]) -> DataFrame:
    """For each row of df (as `t`) the best other row (as `c`) of the same group."""
    t, c = df.alias("t"), df.alias("c")
    on = [F.col(f"t.{g}") == F.col(f"c.{g}") for g in group]
    pairs = t.join(c, on).where(F.col(f"t.{key}") != F.col(f"c.{key}"))
    pairs = pairs.select(F.col(f"t.{key}").alias(key), F.col(f"c.{key}").alias("alternate"), cost.alias("cost"))
    return best_by(pairs, [key], order)


def nearest_alternate(df: DataFrame, key: str, group: list[str], value: str) -> DataFrame:
    """key, alternate and cost: for each row the other row of its group with the nearest value, of equals the least key.

    Rows are brought to one for each value of a group, with its two least keys, and compared with the values beside it:
    no pairs are formed.
    """
    values = df.groupBy(*group, value).agg(F.min(key).alias("least"))
    second = df.join(values, [*group, value]).where(F.col(key) != F.col("least")).groupBy(*group, value).agg(F.min(key).alias("second"))
    by = W.partitionBy(*group).orderBy(value)
    near = values.join(second, [*group, value], "left")
    for name, beside in (("below", F.lag), ("above", F.lead)):
        near = near.withColumn(name, beside(F.struct(F.col(value).alias("at"), F.col("least").alias("key"))).over(by))
    rows = df.select(key, *group, value).join(near, [*group, value])
    same = F.when(F.col(key) == F.col("least"), F.col("second")).otherwise(F.col("least"))
    offer = lambda at, k: F.when(k.isNotNull(), F.struct(F.abs(F.col(value) - at).alias("cost"), k.alias("alternate")))
    best = F.array_min(F.array_compact(F.array(offer(F.col(value), same), *[offer(F.col(f"{n}.at"), F.col(f"{n}.key")) for n in ("below", "above")])))
    return rows.withColumn("best", best).where("best IS NOT NULL").select(key, "best.alternate", "best.cost")


def unique_match(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """left with the value of its match in right, only where exactly one row matches; and how many do."""
    once = right.groupBy(*keys).agg(F.count("*").alias("matches"), F.min(value).alias(value))
    return left.join(once, keys, "left").select(*left.columns, F.coalesce("matches", F.lit(0)).alias("matches"), F.when(F.col("matches") == 1, F.col(value)).alias(value))


def compare_selections(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Every key of either side, with flags and its state: shared, added or removed."""
    a = first.select(key).distinct().withColumn("in_first", F.lit(True))
    b = second.select(key).distinct().withColumn("in_second", F.lit(True))
    out = a.join(b, key, "full").select(key, F.coalesce("in_first", F.lit(False)).alias("in_first"), F.coalesce("in_second", F.lit(False)).alias("in_second"))
    return out.withColumn("state", F.when(F.col("in_first") & F.col("in_second"), "shared").when(F.col("in_second"), "added").otherwise("removed"))


def merge_catalogs(primary: DataFrame, foreign: DataFrame, key: str, title: str, language: str) -> DataFrame:
    """Both catalogs on a key: the primary wins; a differing title or language (`und` fits any) is quarantined."""
    p, f = primary.alias("p"), foreign.alias("f")
    out = p.join(f, F.col(f"p.{key}") == F.col(f"f.{key}"), "full")
    both = F.col(f"p.{key}").isNotNull() & F.col(f"f.{key}").isNotNull()
    fits = (F.col(f"p.{language}") == F.col(f"f.{language}")) | (F.col(f"p.{language}") == "und") | (F.col(f"f.{language}") == "und")
    status = F.when(both & ~fits, "language_conflict").when(both & (F.col(f"p.{title}") != F.col(f"f.{title}")), "title_conflict").when(both, "merged")
    status = status.when(F.col(f"p.{key}").isNotNull(), "primary_only").otherwise("foreign_only")
    return out.select(F.coalesce(f"p.{key}", f"f.{key}").alias(key), F.coalesce(f"p.{title}", f"f.{title}").alias(title), F.coalesce(f"p.{language}", f"f.{language}").alias(language), status.alias("status"))


def gains(stages: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Each key once, with the first stage that has it: what each stage adds to those before it."""
    every = None
    for rank, (name, rows) in enumerate(stages):
        own = rows.select(key, F.lit(rank).alias("rank"), F.lit(name).alias("stage"))
        every = own if every is None else every.unionByName(own)
    return every.groupBy(key).agg(F.min_by("stage", "rank").alias("stage"))


def set_differences(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(kind, key) of missing and unexpected keys."""
    missing = expected.select(key).subtract(found.select(key)).select(F.lit("missing").alias("kind"), key)
    return missing.unionByName(found.select(key).subtract(expected.select(key)).select(F.lit("unexpected").alias("kind"), key))


def without_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on).distinct(), on, "left_anti")


def fill_only_missing(existing: DataFrame, additions: DataFrame, key: str) -> DataFrame:
    """existing, and additions for those keys that it lacks."""
    return existing.unionByName(without_keys(additions, existing, key), allowMissingColumns=True)
