"""Trees from levels, paths, descendant counts and cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tomewright.sources.work import step_table


def fold_levels(rows: Column, kind: str, clamp: bool = False) -> Column:
    """Rows (structs of type `kind` with a level, in order) as (row, level from 1, parent: a row, nth among siblings).

    Parents are those of levels_to_parents. `open` has the latest row of each level and its place among its siblings.
    """
    base = F.array_min(F.transform(rows, lambda x: x["level"]))
    placed, opened = f"struct<row:{kind},level:int,parent:{kind},nth:int>", f"struct<row:{kind},nth:int>"
    first = F.struct(base.alias("base"), F.array().cast(f"array<{opened}>").alias("open"), F.lit(0).alias("last"), F.array().cast(f"array<{placed}>").alias("out"))

    def step(acc, x):
        own = x["level"] - acc["base"] + 1
        own = F.least(own, acc["last"] + 1) if clamp else own
        nth = F.coalesce(F.try_element_at(acc["open"], own)["nth"] + 1, F.lit(0))
        parent = F.when(own > 1, F.try_element_at(acc["open"], own - 1)["row"])
        row = F.struct(x.alias("row"), own.alias("level"), parent.alias("parent"), nth.alias("nth"))
        above = F.slice(acc["open"], 1, F.greatest(own - 1, F.lit(0)))
        moved = F.struct(acc["base"].alias("base"), F.array_append(above, F.struct(x.alias("row"), nth.alias("nth"))).alias("open"), own.alias("last"), F.array_append(acc["out"], row).alias("out"))
        return F.when(F.size(acc["open"]) >= own - 1, moved).otherwise(acc)

    return F.aggregate(rows, first, step)["out"]


def levels_to_parents(df: DataFrame, group: str, order: str, level: str, clamp: bool = False) -> DataFrame:
    """group, order, level (from 1), parent (an order value) and order_index among siblings.

    A row's parent is the latest row one level up that no higher row has closed since. Rows without one are skipped
    and close nothing; with clamp a level is first lowered to one below the row before it. A group is one outline
    (a book's or a conversation's), folded in one pass over its sorted array.
    """
    base = df.select(group, order, F.col(level).cast("int").alias("level"))
    rows = base.groupBy(group).agg(F.min("level").alias("__base"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), "level"))).alias("__rows"))
    kind = df.schema[order].dataType.simpleString()
    entry = f"struct<at:{kind},level:int,parent:{kind}>"
    first = F.expr(f"named_struct('stack', cast(array() as array<{kind}>), 'last', 0, 'out', cast(array() as array<{entry}>))")

    def step(acc, x):
        own = x["level"] - F.col("__base") + 1
        own = F.least(own, acc["last"] + 1) if clamp else own
        ok = F.size(acc["stack"]) >= own - 1
        above = F.slice(acc["stack"], 1, F.greatest(own - 1, F.lit(0)))
        row = F.struct(x["at"].alias("at"), own.alias("level"), F.when(own > 1, F.try_element_at(acc["stack"], own - 1)).alias("parent"))
        moved = F.struct(F.array_append(above, x["at"]).alias("stack"), own.alias("last"), F.array_append(acc["out"], row).alias("out"))
        return F.when(ok, moved).otherwise(acc)

    out = rows.select(group, F.explode(F.aggregate("__rows", first, step)["out"]).alias("e")).select(group, F.col("e.at").alias(order), "e.level", "e.parent")
    nth = F.row_number().over(W.partitionBy(group, "parent").orderBy(order)) - 1
    return out.withColumn("order_index", nth)


def root_descendants(df: DataFrame, group: str, order: str, is_root) -> DataFrame:
    """For each root row the number of rows up to the next root of its group."""
    placed = df.withColumn("__p", F.row_number().over(W.partitionBy(group).orderBy(order))).withColumn("__n", F.count("*").over(W.partitionBy(group)))
    roots = placed.where(is_root)
    after = F.lead("__p").over(W.partitionBy(group).orderBy("__p"))
    return roots.select(group, order, (F.coalesce(after, F.col("__n") + 1) - F.col("__p") - 1).alias("descendants"))


def tree_paths(df: DataFrame, id_: str, parent: str, label: str, sep: str = " > ") -> DataFrame:
    """id, depth and path of titles from the root, for all rows a root leads to.

    Each row knows the titles from below some ancestor down to itself; a step puts that ancestor's own stretch before
    them, which doubles it. So the steps grow with the log of the depth, each is a written table, and no row is held by
    more than its own path. Rows below a missing parent or on a cycle have no root and are left out.
    """
    rows = df.select(F.col(id_).alias("id"), F.col(parent).alias("up"), F.lit(1).alias("depth"), F.col(label).cast("string").alias("path"))
    now = step_table(rows)
    open_, most = now.where("up IS NOT NULL").count(), now.count()
    for _ in range(most.bit_length() + 1):
        if not open_:
            break
        above = now.select(F.col("id").alias("a_id"), F.col("up").alias("a_up"), F.col("depth").alias("a_depth"), F.col("path").alias("a_path"))
        moved = now.where("up IS NOT NULL").join(above, F.col("up") == F.col("a_id"))
        moved = moved.select("id", F.col("a_up").alias("up"), (F.col("depth") + F.col("a_depth")).alias("depth"), F.concat("a_path", F.lit(sep), "path").alias("path"))
        now = step_table(now.where("up IS NULL").unionByName(moved))
        open_ = now.where("up IS NOT NULL").count()
    return now.where("up IS NULL").select(F.col("id").alias(id_), "depth", "path")


def parent_cycles(df: DataFrame, id_: str, parent: str) -> DataFrame:
    """Ids on a cycle of parent links, by pointer doubling.

    After n steps each id points 2^n links up, or nowhere if its path ended. The ids pointed to become fewer from step to
    step; once their number stays, links are one to one among them, so they are those on cycles. Steps grow with the
    log of the longest path that leads into a cycle or ends, and each is a written table.
    """
    now = step_table(df.where(F.col(parent).isNotNull()).select(F.col(id_).alias("id"), F.col(parent).alias("up")).distinct())
    left = -1
    while (found := now.select("up").distinct().count()) not in (0, left):
        left = found
        now = step_table(now.join(now.select(F.col("id").alias("up"), F.col("up").alias("next")), "up").select("id", F.col("next").alias("up")))
    return now.select(F.col("up").alias(id_)).distinct()
