"""English enrichment: what needs translation, in bounded requests, with a cache; the translator is a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.functions.identity import sha256_text
from tomewright.operators.batching import chunk_text, greedy_batches
from tomewright.operators.decisions import copy_if_script
from tomewright.sources.canonical import Dataset

#: Scripts whose presence means that a text isn't English.
SCRIPTS = "[\\u0400-\\u04ff\\u0600-\\u06ff\\u3040-\\u30ff\\u3400-\\u9fff\\uac00-\\ud7a3]"
SCOPES = ("all", "title", "toc", "documents")


def copy_english(data: Dataset, languages: tuple[str, ...] = ("en", "ko")) -> Dataset:
    """Texts that are English already become their own English fields."""
    langs = data.books.select("book_id", "language").dropDuplicates(["book_id"])
    fill = lambda df, en, text: df.join(langs.withColumnRenamed("language", "__l"), "book_id", "left").withColumn(en, copy_if_script(F.col(en), F.col(text), F.col("__l"), list(languages), SCRIPTS)).select(df.columns)
    books = fill(fill(data.books, "en_title", "title"), "en_subtitle", "subtitle")
    return Dataset(books, fill(data.documents, "en_text", "text"), fill(data.toc, "en_title", "title"), data.sources)


def items(data: Dataset, chunk_chars: int, scope: str = "all") -> DataFrame:
    """(book_id, item_id, chunk, piece): texts without English, cut to pieces of bounded length."""
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope}")
    parts = {
        "title": data.books.where("en_title IS NULL").select("book_id", F.concat(F.lit("title:"), "book_id").alias("item_id"), F.col("title").alias("text")),
        "toc": data.toc.where("en_title IS NULL").select("book_id", F.concat(F.lit("toc:"), "toc_entry_id").alias("item_id"), F.col("title").alias("text")),
        "documents": data.documents.where("en_text IS NULL").select("book_id", F.concat(F.lit("document:"), "document_id").alias("item_id"), "text"),
    }
    rows = None
    for name, df in parts.items():
        if scope in ("all", name):
            rows = df if rows is None else rows.unionByName(df)
    pieces = chunk_text(rows, "item_id", "text", chunk_chars)
    return rows.select("book_id", "item_id").join(pieces, "item_id").select("book_id", "item_id", "chunk", "piece")


def requests(pieces: DataFrame, limit: int) -> DataFrame:
    """Pieces with the request they go into: by book, closed before it would grow over the limit."""
    rows = pieces.withColumn("at", F.concat("item_id", F.lit("\x1f"), F.lpad(F.col("chunk").cast("string"), 9, "0"))).withColumn("size", F.length("piece"))
    batches = greedy_batches(rows, "book_id", "at", "size", limit)
    out = rows.join(batches, ["book_id", "at"]).select("book_id", "batch", "at", "item_id", "chunk", "piece")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: F.concat(x["at"], F.lit("\x1e"), x["piece"])), "\x1d")
    keys = out.groupBy("book_id", "batch").agg(sha256_text(text).alias("request_hash"))
    return out.join(keys, ["book_id", "batch"])


def translate(pieces: DataFrame, cache: DataFrame, translator: Callable[[list[str]], list[str]] | None = None) -> DataFrame:
    """(request_hash, at, en): from the cache where a request is known, else by the translator, if there is one.

    A request whose answer lacks a piece, is blank or still has another script gives no rows: its book stays as it is.
    """
    known = pieces.join(cache.select("request_hash", "at", "en"), ["request_hash", "at"])
    rows = known.select("request_hash", "at", "en")
    if translator is not None:
        fresh = pieces.join(cache.select("request_hash").distinct(), "request_hash", "left_anti")

        def run(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("at")
            try:
                answer = translator(group["piece"].tolist())
            except Exception:  # noqa: BLE001 - one failed request must not end the others; it is retried in the next run
                answer = []
            if len(answer) != len(group):
                return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("request_hash", "at", "en")})
            return pd.DataFrame({"request_hash": group.request_hash.tolist(), "at": group["at"].tolist(), "en": list(answer)}, dtype=object)

        rows = rows.unionByName(fresh.groupBy("request_hash").applyInPandas(run, "request_hash string, at string, en string"))
    bad = rows.where((F.length(F.trim("en")) == 0) | F.col("en").isNull() | F.col("en").rlike(SCRIPTS)).select("request_hash").distinct()
    return rows.join(bad, "request_hash", "left_anti")


def apply(data: Dataset, pieces: DataFrame, answers: DataFrame) -> Dataset:
    """English fields of all texts whose pieces are all there; pieces are joined by line breaks."""
    got = pieces.join(answers, ["request_hash", "at"], "left").groupBy("item_id").agg(F.count("*").alias("n"), F.count("en").alias("k"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "en"))), lambda x: x["en"]), "\n").alias("en")).where("n = k")
    put = lambda df, kind, key, field: df.join(got.where(F.col("item_id").startswith(f"{kind}:")).select(F.expr(f"substring(item_id, {len(kind) + 2})").alias("__k"), F.col("en").alias("__en")), F.col(key) == F.col("__k"), "left").withColumn(field, F.coalesce(field, "__en")).select(df.columns)
    return Dataset(put(data.books, "title", "book_id", "en_title"), put(data.documents, "document", "document_id", "en_text"), put(data.toc, "toc", "toc_entry_id", "en_title"), data.sources)
