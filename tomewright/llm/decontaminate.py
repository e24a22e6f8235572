"""Benchmark decontamination by SimHash of item-sized windows. DataFrame functions only.

An item is found in a document if some window of as many words as the item has a weighted Jaccard similarity of
their five-word shingles (A-Z lower-cased, with their counts) of at least `similarity`. A document of fewer words is
one window.

1. Windows. For each size that items have, the positions of a document are marked whose shingle is in any item of that
   size. A window that reaches the similarity to one of them holds so many marked positions at least as follows from
   it; the others are left out, which loses no pair. Which item it might be isn't asked.
2. Fingerprints. Each window left, and each item, is fingerprinted by SimHash over all its shingles.
3. Multi-index. The fingerprints are cut into 8 blocks; of two within the radius one block differs by at most
   radius / 8 bits. Items stand in the index under all such values of their blocks, windows look theirs up, and the
   whole fingerprints decide: all pairs of a window and an item of its size within the radius, and no others, go on.
   At a similarity of 0.8, 64 bits differ in about 10 places; the radius of 23 is over four standard deviations above.
4. The shared counts of the shingles verify each such pair exactly.

Items of fewer than five words are one shingle, compared with all windows of their length; items without words match
nothing. Null texts have no words. Repeated rows and ids: pairs are given once, with the best of their windows. A null
doc_id or item_id is kept as null. Ties don't matter, as only the similarity is given. Only the id and text columns
are read, so others may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import BROADCAST_ROWS, row_hash, without_rows, work_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 23, 8


def words_of(text: str) -> "F.Column":
    """The words of a text column, A-Z lower-cased; none for a null."""
    own = F.translate(F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r")), UPPER, LOWER)
    return F.when(F.coalesce(F.length(own), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.split(own, r"[\x20\x09-\x0D]+"))


def hashes_of(words: str, size: int) -> "F.Column":
    """The hash of each run of `size` words. The words are bound to a variable, so that they aren't split anew for each."""
    runs = lambda ws: F.slice(ws, 1, F.greatest(F.size(ws) - size + 1, F.lit(0)))
    each = lambda ws: F.transform(runs(ws), lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, size)]))
    return F.transform(F.array(words), each)[0]


def placed(rows: DataFrame, size: int) -> DataFrame:
    """rows with (n, pos, h) for each run of `size` words; the words come out of a generator, so that they are split once a row."""
    kept = [c for c in rows.columns if c != "words"]
    bound = rows.select(*kept, F.explode(F.array("words")).alias("words"))
    runs = bound.select(*kept, "words", (F.size("words") - size + 1).alias("n"), F.explode(F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size))).alias("pos"))
    return runs.select(*kept, "n", "pos", F.xxhash64(*[F.get("words", F.col("pos") + k) for k in range(size)]).alias("h"))


def fitting(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast df if its rows, counted before, are few enough; else it is joined by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fingerprints(rows: DataFrame, keys: list[str], many: bool) -> DataFrame:
    """keys and fp: SimHash over the rows (keys, h). Counters share a word: 8 bits each, or 32 if a group has over 255 rows."""
    width = 32 if many else 8
    ones = sum(1 << i for i in range(0, 64, width))
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n_all"), *[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(ones))).alias(f"c{k}") for k in range(width)])
    count = lambda bit: F.shiftrightunsigned(f"c{bit % width}", bit - bit % width).bitwiseAND(F.lit((1 << width) - 1))
    fp = F.lit(0).cast("long")
    for bit in range(64):
        fp = fp.bitwiseOR(F.when(2 * count(bit) > F.col("n_all"), F.lit(-(1 << 63) if bit == 63 else 1 << bit)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def near_prints(prints: DataFrame, index: DataFrame, items: int, radius: int, same: list[str]) -> DataFrame:
    """(same, fp, item): all pairs of a print and an indexed print that agree in `same` and differ in at most `radius` bits.

    prints: (same, fp), distinct; index: (same, item, fp). Each value of the index stands for all that differ by so
    few bits as one block of a pair within the radius must.
    """
    width = 64 // BLOCKS
    near = F.array(*[F.lit(x) for x in range(1 << width) if x.bit_count() <= radius // BLOCKS])
    cut = lambda df: df.select("*", F.posexplode(F.array(*[F.shiftrightunsigned("fp", k * width).bitwiseAND(F.lit((1 << width) - 1)) for k in range(BLOCKS)])).alias("block", "value"))
    entries = cut(index).withColumn("near", F.explode(near)).select(*same, "block", F.col("value").bitwiseXOR(F.col("near")).alias("value"), "item", F.col("fp").alias("item_fp"))
    entries = fitting(entries, items * BLOCKS * sum(x.bit_count() <= radius // BLOCKS for x in range(1 << width)))
    pairs = cut(prints).join(entries, [*same, "block", "value"])
    return pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*same, "fp", "item").distinct()


def leaks(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity) of every document and item with a window of that similarity; the best of its windows."""
    return leaking_rows(documents, benchmark, similarity, radius).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def clean(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of documents without any item, with all their columns."""
    return without_rows(documents, leaking_rows(documents, benchmark, similarity, radius))


def leaking_rows(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, rid, item_id, similarity) by window; rid tells rows of one id apart."""
    items = benchmark.select("item_id", "text").distinct().select("item_id", words_of("text").alias("words")).where("size(words) > 0")
    items = items.withColumn("item", F.xxhash64("item_id", "words")).withColumn("shingle", F.least(F.size("words"), F.lit(SHINGLE)))
    hashes = F.coalesce(*[F.when(F.col("shingle") == k, hashes_of("words", k)) for k in range(1, SHINGLE + 1)])
    items = work_table(items.select("item", "item_id", "shingle", hashes.alias("hashes")).withColumn("m", F.size("hashes")), "items")
    known, kinds, longest = items.agg(F.count("*"), F.collect_set("shingle"), F.max("m")).first()  # three numbers and five shingle sizes at most
    if not known:
        return documents.select("doc_id", row_hash().alias("rid")).join(benchmark.select("item_id"), F.lit(False)).withColumn("similarity", F.lit(0.0))
    shingles = items.select("item", "shingle", "m", F.explode("hashes").alias("h")).groupBy("item", "shingle", "m", "h").agg(F.count("*").alias("c"))
    shingles = work_table(shingles, "shingles")
    marks = work_table(shingles.select("shingle", "m", "h").distinct(), "marks")
    n_shingles = shingles.count()
    docs = documents.select("doc_id", row_hash().alias("rid"), words_of("text").alias("words"))
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    # 1. the windows that hold enough marked positions, by the first of them
    hits = union([placed(docs, k).join(fitting(marks.where(F.col("shingle") == k), n_shingles), "h") for k in sorted(kinds)])
    hits = hits.groupBy("doc_id", "rid", "n", "shingle", "m").agg(F.array_sort(F.collect_set(F.struct("pos", "h"))).alias("hits"))  # as long as the text
    hits = hits.withColumn("size", F.least("n", "m")).withColumn("need", F.ceil(similarity * (F.col("size") + F.col("m")) / (1 + similarity) - 1e-9).cast("int"))
    starts = F.expr("""filter(transform(slice(hits, 1, size(hits) - need + 1), (x, j) -> struct(j,
        greatest(0, hits[j + need - 1].pos - size + 1, if(j = 0, 0, hits[greatest(j - 1, 0)].pos + 1)) AS low, least(x.pos, n - size) AS high)), x -> x.low <= x.high)""")
    windows = hits.where("size(hits) >= need").withColumn("at", F.explode(starts))
    keys = ["rid", "shingle", "m", "start"]
    windows = windows.select("doc_id", "rid", "shingle", "m", "size", F.expr("slice(hits, at.j + 1, size)").alias("inside"), F.explode(F.expr("sequence(at.low, at.high)")).alias("start"))
    windows = work_table(windows.withColumn("inside", F.expr("transform(filter(inside, x -> x.pos < start + size), x -> x.h)")), "windows")
    # 2. their fingerprints, from the documents that have any
    own = windows.groupBy("rid", "shingle").agg(F.collect_set(F.struct("m", "start", "size")).alias("windows"))
    n_own = windows.count()
    parts = []
    for k in sorted(kinds):
        rows = docs.join(fitting(own.where(F.col("shingle") == k), n_own), "rid").select("rid", "shingle", hashes_of("words", k).alias("hashes"), "windows").dropDuplicates(["rid"])
        rows = rows.select("rid", "shingle", "hashes", F.explode("windows").alias("w"))
        parts.append(rows.select("rid", "shingle", "w.m", "w.start", F.explode(F.expr("slice(hashes, w.start + 1, w.size)")).alias("h")))
    prints = work_table(fingerprints(union(parts), keys, longest > 255), "prints")
    index = fingerprints(items.select("item", "shingle", "m", F.explode("hashes").alias("h")), ["item", "shingle", "m"], longest > 255)
    # 3. candidates: equal fingerprints are looked up once
    found = work_table(near_prints(prints.select("shingle", "m", "fp").distinct(), index, known, radius, ["shingle", "m"]), "found")
    found = prints.join(fitting(found, found.count()), ["shingle", "m", "fp"]).select(*keys, "item")
    # 4. verification; all windows of a document stay together
    found = found.repartition("rid").join(windows, keys).select("doc_id", *keys, "size", "item", F.explode("inside").alias("h"))
    found = found.groupBy("doc_id", *keys, "size", "item", "h").agg(F.count("*").alias("k"))
    found = found.join(fitting(shingles.select("item", "h", "c"), n_shingles), ["item", "h"])
    found = found.groupBy("doc_id", *keys, "size", "item").agg(F.sum(F.least("k", "c")).alias("shared"))
    found = found.withColumn("similarity", F.col("shared") / (F.col("size") + F.col("m") - F.col("shared"))).where(F.col("similarity") >= similarity - 1e-12)
    return found.join(items.select("item", "item_id"), "item").select("doc_id", "rid", "item_id", "similarity")
