"""Outlines from lookups by ISBN, for books that have none: chapter records of a metadata API, contents texts of a bookstore.

Responses are rows (book_id, retrieved_at, response as VARIANT); the books' own fields come by a join on book_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewright.functions import identity as I
from tomewright.functions import text as X
from tomewright.operators.outlines import outline_entries, parse_outline
from tomewright.plans.providers import get, iso
from tomewright.sources.canonical import Dataset
from tomewright.sources.schemas import TABLES

LEAST = 3
#: Answers that mean no outline, the chapter number in a DOI, rights notes.
NO_CONTENTS = ("GOODS_001", "GOODS_002")
CHAPTER_DOI = r"^10\.1007/[0-9-]+X?_([0-9]+)$"
CHAPTER_RIGHTS = "Chapter titles from the Springer Nature Metadata API; chapter abstracts are kept only in the raw response."
STORE_RIGHTS = "TOC from the YES24 Open API. YES24 terms require a 'YES24 출처' attribution and a link to the product page, and prohibit accumulating its catalog into a separate database or redistributing it. No license inferred."


@dataclass
class Lookups:
    """Evidence found, and each response with why there is none (null: found)."""

    data: Dataset
    responses: DataFrame


def exact_evidence(title: Column, isbns: Column, found: str) -> Column:
    none = F.array().cast("array<string>")
    return F.struct(
        F.lit("toc").alias("evidence_type"), F.lit("exact_edition_toc").alias("tier"), F.col("isbn_13").alias("target_isbn"), F.col("title").alias("target_title"), F.col("authors").alias("target_authors"), F.col("isbn_13").alias("source_edition_id"), isbns.alias("source_isbns"), title.alias("source_title"), none.alias("source_author_ids"),
        F.lit(True).alias("same_edition"), F.lit("toc_api_record").alias("source_document_type"), F.lit(found).alias("discovery_method"), F.array(F.lit("isbn_13")).alias("match_basis"), F.lit("strong").alias("validation_status"),
    ).cast(TABLES["sources"]["evidence"].dataType)


def _lookups(rows: DataFrame, provider: str, url: Column, rights: Column, content_hash: Column, evidence: Column) -> Lookups:
    kept = rows.where("reason IS NULL")
    sources = kept.select("source_id", "book_id", F.lit(provider).alias("provider"), F.lit("metadata_api").alias("source_type"), url.alias("url"), "external_id", F.col("retrieved_at").cast("timestamp").alias("retrieved_at"), F.lit(None).cast("string").alias("license"), rights.alias("rights_note"), content_hash.alias("content_hash"), evidence.alias("evidence"))
    empty = lambda n: rows.sparkSession.createDataFrame([], TABLES[n])
    return Lookups(Dataset(empty("books"), empty("documents"), outline_entries(kept, "book_id", "source_id", "entries"), sources), rows.select("book_id", "reason"))


def chapter_records(responses: DataFrame, books: DataFrame) -> Lookups:
    """Paged chapter records of one ISBN: the first record of each chapter number, in numeric order, at least three.

    A page without a list of records is an error. All chapters are roots; records carry no hierarchy.
    """
    v = F.col("response")
    pages = get(v, "$.pages", "array<variant>")
    lists = F.transform(pages, lambda p: get(p, "$.response.records", "array<variant>"))
    malformed = pages.isNull() | F.exists(lists, lambda x: x.isNull())
    rows = responses.join(books.select("book_id", "isbn_13", "title", "authors"), "book_id")
    rows = rows.withColumn("records", F.when(malformed, F.raise_error(F.lit("a page without a list of records"))).otherwise(F.flatten(lists)))
    clean = lambda r: F.struct(
        F.regexp_extract(get(r, "$.doi"), CHAPTER_DOI, 1).try_cast("decimal(38,0)").alias("n"), X.clean_title(get(r, "$.title")).alias("title"), get(r, "$.doi").alias("doi"), get(r, "$.title").alias("raw_title"), get(r, "$.contentType").alias("kind"),
        get(r, "$.printIsbn").alias("print"), get(r, "$.electronicIsbn").alias("electronic"), get(r, "$.publicationName").alias("publication"), get(r, "$.copyright").alias("copyright"),
    )
    fits = lambda c: (c["kind"] == "Chapter") & ((I.isbn_digits(c["print"]) == F.col("isbn_13")) | (I.isbn_digits(c["electronic"]) == F.col("isbn_13"))) & c["n"].isNotNull() & (F.length(c["title"]) > 0)
    rows = rows.withColumn("found", F.filter(F.transform("records", clean), lambda c: F.coalesce(fits(c), F.lit(False))))
    numbers = F.transform("found", lambda c: c["n"])
    firsts = F.filter("found", lambda c, i: F.array_position(numbers, c["n"]) == i + 1)
    rows = rows.withColumn("chapters", F.array_sort(firsts, lambda a, b: F.when(a["n"] < b["n"], -1).when(a["n"] > b["n"], 1).otherwise(0)))
    first = F.try_element_at("chapters", F.lit(1))
    electronic = F.nullif(first["electronic"], F.lit(""))
    rows = rows.withColumn("book_doi", F.concat(F.lit("10.1007/"), electronic)).withColumn("external_id", F.coalesce("book_doi", F.concat(F.lit("isbn:"), "isbn_13")))
    rows = rows.withColumn("source_id", I.stable_id("source", F.lit("springer_metadata"), F.col("external_id"), F.col("book_id"), iso(F.col("retrieved_at").cast("timestamp"))))
    rows = rows.withColumn("entries", F.transform("chapters", lambda c, i: F.struct(i.alias("pos"), F.lit(1).alias("level"), c["n"].cast("string").alias("label"), c["title"].alias("title"))))
    rows = rows.withColumn("reason", F.when(F.size("chapters") < LEAST, "no_outline"))
    isbns = F.array_sort(F.array_distinct(F.filter(F.array(I.isbn_digits(first["print"]), I.isbn_digits(first["electronic"])), lambda x: F.length(x) > 0)))
    rights = F.concat(F.lit(CHAPTER_RIGHTS), F.coalesce(F.concat(F.lit(" Copyright: "), F.nullif(first["copyright"], F.lit("")), F.lit(".")), F.lit("")), F.lit(" No license inferred."))
    url = F.coalesce(F.concat(F.lit("https://link.springer.com/book/"), "book_doi"), F.lit("https://link.springer.com"))
    hashed = I.sha256_text(F.to_json(F.transform("chapters", lambda c: F.struct(c["doi"].alias("doi"), c["raw_title"].alias("title"))), {"ignoreNullFields": "false"}))
    return _lookups(rows, "springer_nature", url, rights, hashed, exact_evidence(F.nullif(first["publication"], F.lit("")), isbns, "springer_metadata_isbn_lookup"))


def store_contents(responses: DataFrame, books: DataFrame) -> Lookups:
    """A bookstore's contents text of one ISBN: none for the two answers that say so, an error for any other failure."""
    v = F.col("response")
    code = get(v, "$.errorCode")
    failed = F.coalesce(get(v, "$.success", "boolean") == F.lit(False), F.lit(False))
    item = get(v, "$.data.data.itemId", "variant")
    is_int = F.schema_of_variant(item).isin("BIGINT", "INT", "LONG")
    rows = responses.join(books.select("book_id", "isbn_13", "title", "authors"), "book_id")
    none = failed & F.coalesce(code.isin(*NO_CONTENTS), F.lit(False))
    wrong = F.when(failed & ~none, F.raise_error(F.concat_ws(" ", F.lit("lookup failed:"), code, get(v, "$.message")))).when(~none & ~F.coalesce(is_int, F.lit(False)), F.raise_error(F.lit("no integer itemId")))
    rows = rows.withColumn("external_id", get(v, "$.data.data.itemId")).withColumn("contents", F.coalesce(wrong.cast("string"), F.when(~none, get(v, "$.data.data.contents"))))
    rows = rows.withColumn("entries", parse_outline(F.col("contents"), "contents", LEAST)).withColumn("reason", F.when(F.size("entries") < LEAST, "no_outline"))
    rows = rows.withColumn("source_id", I.stable_id("source", F.lit("yes24"), F.col("external_id"), F.col("book_id"), iso(F.col("retrieved_at").cast("timestamp"))))
    isbns = F.array_compact(F.array("isbn_13"))
    return _lookups(rows, "yes24", F.concat(F.lit("https://www.yes24.com/product/goods/"), "external_id"), F.lit(STORE_RIGHTS), I.sha256_text(F.col("contents")), exact_evidence(F.lit(None).cast("string"), isbns, "yes24_isbn13_lookup"))
