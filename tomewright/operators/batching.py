"""Chunks, batches and matches of texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_text(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Pieces of `size` characters in order; an empty text gives none."""
    starts = F.expr(f"sequence(0, length(`{text}`) - 1, {size})")
    rows = df.where(F.length(text) > 0).select(key, text, F.posexplode(starts).alias("chunk", "__at"))
    return rows.select(key, "chunk", F.expr(f"substring(`{text}`, __at + 1, {size})").alias("piece"))


def reassemble(chunks: DataFrame, key: str, sep: str = "") -> DataFrame:
    """Pieces joined in order; a key's pieces are one text."""
    rows = F.array_sort(F.collect_list(F.struct("chunk", "piece")))
    return chunks.groupBy(key).agg(F.array_join(F.transform(rows, lambda x: x["piece"]), sep).alias("text"))


def greedy_batches(df: DataFrame, group: str, order: str, size: str, limit: int) -> DataFrame:
    """group, order and batch (from 0): a batch closes when the next item would take it over the limit; an item over
    the limit stands alone. One fold over a group's items (of one book or conversation)."""
    rows = df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(size).cast("long").alias("size")))).alias("__rows"))
    kind = df.schema[order].dataType.simpleString()
    first = F.expr(f"named_struct('n', -1, 'used', 0L, 'out', cast(array() as array<struct<at:{kind},batch:int>>))")

    def step(acc, x):
        new = (acc["n"] < 0) | (acc["used"] + x["size"] > limit)
        n = F.when(new, acc["n"] + 1).otherwise(acc["n"])
        used = F.when(new, x["size"]).otherwise(acc["used"] + x["size"])
        return F.struct(n.alias("n"), used.alias("used"), F.array_append(acc["out"], F.struct(x["at"].alias("at"), n.alias("batch"))).alias("out"))

    return rows.select(group, F.explode(F.aggregate("__rows", first, step)["out"]).alias("e")).select(group, F.col("e.at").alias(order), "e.batch")


def regex_spans(df: DataFrame, key: str, text: str, pattern: str, context: int = 80) -> DataFrame:
    """key, start, end, match and context of every match (JVM functions give no offsets; Arrow batches)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = re.compile(pattern, re.I)
        for b in batches:
            rows = [(k, m.start(), m.end(), m[0], t[max(0, m.start() - context) : m.end() + context]) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if t for m in own.finditer(t)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [key, "start", "end", "match", "context"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, start long, end long, match string, context string")
