"""Integrity checks. Each gives (kind, id, detail) rows; a dataset is valid if their union is empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.operators.tree import parent_cycles


def error(rows: DataFrame, kind: str, id_: str, detail) -> DataFrame:
    return rows.select(F.lit(kind).alias("kind"), F.col(id_).cast("string").alias("id"), detail.cast("string").alias("detail"))


def duplicates(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Keys found more than once, with their number."""
    own = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return own.select(F.lit(kind).alias("kind"), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).alias("id"), F.col("n").cast("string").alias("detail"))


def missing_reference(child: DataFrame, child_id: str, fk: str, parent: DataFrame, pk: str, kind: str) -> DataFrame:
    """Children whose parent is missing: one anti-join."""
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    return error(child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("__pk"), "left_anti"), kind, child_id, F.col(fk))


def ownership(child: DataFrame, child_id: str, fk: str, owner: str, parent: DataFrame, pk: str, parent_owner: str, kind: str) -> DataFrame:
    """Children whose parent belongs to another owner."""
    keys = parent.select(F.col(pk).alias("__pk"), F.col(parent_owner).alias("__owner"))
    rows = child.join(keys, F.col(fk) == F.col("__pk")).where(F.col(owner) != F.col("__owner"))
    return error(rows, kind, child_id, F.col("__owner"))


def levels(entries: DataFrame, id_: str, parent: str, level: str) -> DataFrame:
    """Roots must be at level 1, children one below their parent."""
    up = entries.select(F.col(id_).alias("__pid"), F.col(level).alias("__plevel"))
    roots = error(entries.where(F.col(parent).isNull() & (F.col(level) != 1)), "root_level", id_, F.col(level))
    rows = entries.join(up, F.col(parent) == F.col("__pid")).where(F.col(level) != F.col("__plevel") + 1)
    return roots.unionByName(error(rows, "child_level", id_, F.col(level)))


def validate_dataset(books: DataFrame, documents: DataFrame, toc: DataFrame, sources: DataFrame) -> DataFrame:
    """All errors of the four canonical tables."""
    own_parent = toc.where("parent_entry_id is not null")
    same_book = own_parent.alias("c").join(toc.select(F.col("toc_entry_id").alias("p_id"), F.col("book_id").alias("p_book")), F.col("parent_entry_id") == F.col("p_id")).where("book_id = p_book").select("c.*")
    checks = [
        *[duplicates(df, [k], f"duplicate_{k}") for df, k in ((books, "book_id"), (sources, "source_id"), (documents, "document_id"), (toc, "toc_entry_id"), (books, "isbn_13"), (books, "isbn_10"))],
        missing_reference(sources, "source_id", "book_id", books, "book_id", "source_missing_book"),
        error(books.join(sources.select("book_id").distinct(), "book_id", "left_anti"), "book_without_source", "book_id", F.lit("")),
        missing_reference(documents, "document_id", "book_id", books, "book_id", "document_missing_book"),
        missing_reference(documents, "document_id", "source_id", sources, "source_id", "document_missing_source"),
        ownership(documents, "document_id", "source_id", "book_id", sources, "source_id", "book_id", "document_foreign_source"),
        missing_reference(toc, "toc_entry_id", "book_id", books, "book_id", "toc_missing_book"),
        missing_reference(toc, "toc_entry_id", "source_id", sources, "source_id", "toc_missing_source"),
        ownership(toc, "toc_entry_id", "source_id", "book_id", sources, "source_id", "book_id", "toc_foreign_source"),
        missing_reference(toc, "toc_entry_id", "parent_entry_id", toc, "toc_entry_id", "toc_missing_parent"),
        ownership(own_parent, "toc_entry_id", "parent_entry_id", "book_id", toc, "toc_entry_id", "book_id", "toc_foreign_parent"),
        levels(toc.where("parent_entry_id is null").unionByName(same_book), "toc_entry_id", "parent_entry_id", "level").where("kind = 'root_level'"),
        levels(toc, "toc_entry_id", "parent_entry_id", "level").join(same_book.select(F.col("toc_entry_id").alias("id")), "id", "left_semi").where("kind = 'child_level'").select("kind", "id", "detail"),
        error(parent_cycles(toc, "toc_entry_id", "parent_entry_id"), "toc_cycle", "toc_entry_id", F.lit("")),
    ]
    return reduce(DataFrame.unionByName, checks)
