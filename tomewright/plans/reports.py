"""Coverage, integrity and comparison reports of canonical datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.functions import text as X
from tomewright.operators import coverage, joins, validation
from tomewright.plans.collection import warnings
from tomewright.sources.canonical import Dataset


def book_coverage(data: Dataset) -> DataFrame:
    """One wide row a book: what evidence it has, how much, and from whom."""
    docs = data.documents.groupBy("book_id").agg(F.count("*").alias("documents"), F.bool_or(F.col("document_type").isin("description", "publisher_summary")).alias("description"), F.sum(F.length("text")).alias("text_chars"))
    toc = data.toc.groupBy("book_id").agg(F.count("*").alias("toc_entries"), F.max("level").alias("toc_depth"))
    src = data.sources.groupBy("book_id").agg(F.array_join(F.array_sort(F.collect_set("provider")), ",").alias("providers"), F.count("*").alias("sources"))
    rows = data.books.join(docs, "book_id", "left").join(toc, "book_id", "left").join(src, "book_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select(
        "book_id", "title", F.element_at("topics", -1).alias("topic"), F.coalesce("isbn_13", "isbn_10").isNotNull().alias("isbn"), (F.size("authors") > 0).alias("authors"), F.col("published_year").isNotNull().alias("year"), F.coalesce("description", F.lit(False)).alias("description"),
        F.col("toc_entries").isNotNull().alias("toc"), zero("documents"), zero("text_chars"), zero("toc_entries"), zero("toc_depth"), zero("sources"), F.coalesce("providers", F.lit("")).alias("providers"), author_conflict(F.col("authors")).alias("author_conflict"),
    )


def author_conflict(authors) -> "F.Column":
    """Two authors with the same words, a very long name, or a leftover [by]."""
    forms = F.transform(authors, coverage.token_signature)
    return (F.size(F.array_distinct(forms)) < F.size(forms)) | F.exists(authors, lambda a: (F.length(a) > 100) | F.lower(a).contains("[by]"))


def topic_coverage(data: Dataset) -> DataFrame:
    """Overall and by topic."""
    return coverage.coverage_rollup(book_coverage(data), "topic", ["isbn", "authors", "year", "description", "toc", "author_conflict"], "books")


def integrity(data: Dataset) -> DataFrame:
    """Errors by kind."""
    return validation.validate_dataset(data.books, data.documents, data.toc, data.sources).groupBy("kind").agg(F.count("*").alias("errors"))


def missing_fields(data: Dataset) -> DataFrame:
    """(field, books) of what books lack."""
    rows = book_coverage(data)
    fields = ("isbn", "authors", "year", "description", "toc")
    flat = rows.select("book_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("has")) for f in fields])).alias("x"))
    return flat.groupBy("x.field").agg(F.count_if(~F.col("x.has")).alias("books"))


def missing_toc_reason(rows: DataFrame, attempts: DataFrame) -> DataFrame:
    """Books without an outline with the outcome of the newest attempt (book_id, at, outcome), else not_attempted."""
    newest = attempts.groupBy("book_id").agg(F.max_by("outcome", "at").alias("outcome"))
    return rows.where("NOT toc").join(newest, "book_id", "left").select("book_id", F.coalesce("outcome", F.lit("not_attempted")).alias("reason"))


def acquisition(stages: list[tuple[str, Dataset]], expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Books that got an outline, by the stage that gave it first; and expected books that are missing or unexpected."""
    gained = joins.gains([(n, d.toc.select("book_id").distinct()) for n, d in stages], "book_id")
    return gained, joins.set_differences(expected, stages[-1][1].books, "book_id")


def compare(first: DataFrame, second: DataFrame, first_labels: DataFrame, second_labels: DataFrame) -> DataFrame:
    """Precision of two selections (topic, book_id) from their labels (topic, book_id, relevant), and its change; null unless all rows are labelled."""
    score = lambda rows, labels, name: coverage.audited_precision(rows.join(labels.select("topic", "book_id", X.label_value(F.col("relevant")).alias("good")), ["topic", "book_id"], "left"), "topic", "good").select("topic", F.col("precision").alias(name))
    out = score(first, first_labels, "first").join(score(second, second_labels, "second"), "topic", "full")
    return out.withColumn("change", F.col("second") - F.col("first"))


def review_sheet(first: DataFrame, second: DataFrame, rejected: DataFrame) -> DataFrame:
    """Every book of either selection with yes/no flags, and why the second rejected it where its title tells that for sure."""
    flags = joins.compare_selections(first, second, "book_id")
    about = first.unionByName(second).dropDuplicates(["book_id"]).select("book_id", "topic", "title")
    rows = flags.join(about, "book_id")
    out = joins.unique_match(rows, rejected, ["topic", "title"], "reason")
    yes = lambda c: F.when(F.col(c), "yes").otherwise("no").alias(c)
    return out.select("topic", "book_id", "title", yes("in_first"), yes("in_second"), "state", "reason", F.lit("").alias("relevant"))


def text_report(rows: DataFrame, columns: list[str], limit: int = 1000) -> str:
    """A bounded table of lines for a terminal."""
    return "\n".join(" ".join(f"{c}={r[c]}" for c in columns) for r in rows.select(*columns).limit(limit).collect())


def scale_report(data: Dataset) -> DataFrame:
    """(section, key, value): coverage overall and by topic, missing fields, errors, years and warnings of a dataset, in one table."""
    rows = book_coverage(data)
    counts = topic_coverage(data)
    names = [c for c in counts.columns if c != "topic"]
    by_topic = counts.select(F.coalesce("topic", F.lit("all")).alias("topic"), F.explode(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c))])).alias("what", "value"))
    parts = [
        by_topic.select(F.lit("coverage").alias("section"), F.concat_ws("/", "topic", "what").alias("key"), "value"),
        missing_fields(data).select(F.lit("missing"), "field", "books"),
        integrity(data).select(F.lit("errors"), "kind", "errors"),
        data.books.groupBy(F.coalesce(F.col("published_year").cast("string"), F.lit("unknown")).alias("year")).agg(F.count("*").alias("n")).select(F.lit("year"), "year", "n"),
        warnings(data).select(F.explode("warnings").alias("w")).groupBy("w").agg(F.count("*").alias("n")).select(F.lit("warning"), "w", "n"),
        rows.agg(F.sum("text_chars").alias("n")).select(F.lit("size"), F.lit("text_chars"), F.coalesce("n", F.lit(0))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.orderBy("section", "key")


def finalize_review(first: DataFrame, second: DataFrame, review: DataFrame) -> dict[str, DataFrame]:
    """The labels of both selections from one filled-in sheet. It must have each of their books once, and a label for each."""
    asked = first.select("topic", "book_id").unionByName(second.select("topic", "book_id")).distinct()
    labels = review.select("topic", "book_id", X.label_value(F.col("relevant")).alias("relevant"))
    sides = asked.withColumn("n", F.lit(1)).unionByName(labels.select("topic", "book_id", F.lit(-1).alias("n")))
    if sides.groupBy("topic", "book_id").agg(F.sum("n").alias("n")).where("n <> 0").take(1):
        raise ValueError("the sheet hasn't each book of the selections once")
    if not labels.where("relevant IS NULL").isEmpty():
        raise ValueError("a book has no label")
    return {name: labels.join(rows.select("topic", "book_id"), ["topic", "book_id"], "left_semi") for name, rows in (("first", first), ("second", second))}
