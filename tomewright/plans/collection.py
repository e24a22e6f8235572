"""What to collect next, what was collected, and whether a build is what its manifest says."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tomewright.functions.text import name_key
from tomewright.operators import joins
from tomewright.sources.canonical import Dataset

#: Failures that are told as such; others are a failed fetch.
FAILURES = ("rate_limit", "network_failure", "provider_http_error", "invalid_provider_response")
GATE = "topic-evidence-v1"


# --- manifests -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Selector:
    """A preserved response by what it was asked for; null fields fit any."""

    provider: str
    topic: str
    requested_limit: int
    source: str | None = None
    content_hash: str | None = None
    retrieved_at: str | None = None


@dataclass(frozen=True)
class Manifest:
    selectors: tuple[Selector, ...]
    expected: tuple[str, ...]
    gate: str | None = None

    def __post_init__(self):
        if not self.selectors or not self.expected:
            raise ValueError("a manifest names responses and books")
        for what, values in (("responses", self.selectors), ("books", self.expected)):
            if len(set(values)) < len(values):
                raise ValueError(f"a manifest names its {what} once")
        if self.gate not in (None, GATE) or self.gate and {s.provider for s in self.selectors} != {"open-library"}:
            raise ValueError(f"the gate {self.gate} is for open-library responses only")


def select_artifacts(artifacts: DataFrame, manifest: Manifest) -> DataFrame:
    """The latest artifact (provider, topic, requested_limit, source, content_hash, retrieved_at, path) of each selector, with its number.

    A selector without any is an error.
    """
    spark = artifacts.sparkSession
    schema = "selector int, s_provider string, s_topic string, s_limit int, s_source string, s_hash string, s_at string"
    wanted = spark.createDataFrame([(k, s.provider, s.topic, s.requested_limit, s.source, s.content_hash, s.retrieved_at) for k, s in enumerate(manifest.selectors)], schema)
    fits = lambda own, asked: F.col(asked).isNull() | (F.col(own) == F.col(asked))
    on = (F.col("provider") == F.col("s_provider")) & (F.col("topic") == F.col("s_topic")) & (F.col("requested_limit") == F.col("s_limit")) & fits("source", "s_source") & fits("content_hash", "s_hash") & fits("retrieved_at", "s_at")
    found = artifacts.join(F.broadcast(wanted), on)  # a manifest is a list somebody wrote
    found = found.withColumn("nth", F.row_number().over(W.partitionBy("selector").orderBy(F.desc("retrieved_at"), F.desc("path")))).where("nth = 1")
    missing = wanted.join(found.select("selector"), "selector", "left_anti").select("s_provider", "s_topic").limit(5).collect()
    if missing:
        raise ValueError(f"no raw artifact for {', '.join(f'{m.s_provider}/{m.s_topic}' for m in missing)}")
    return found.select("selector", *artifacts.columns)


def rebuilds_alike(build: Callable[[], Dataset]) -> bool:
    """Whether two builds give the same rows in all four tables."""
    first, second = build(), build()
    return not any(a.exceptAll(b).take(1) or b.exceptAll(a).take(1) for a, b in zip(first.tables().values(), second.tables().values(), strict=True))


def select_books(data: Dataset, ids: list[str] | None = None, limit: int | None = None) -> Dataset:
    """The named books (all, if none is), the first so many by id, with all their records."""
    if limit is not None and limit < 1:
        raise ValueError("a limit is positive")
    chosen = data.books.select("book_id").distinct()
    if ids:
        if len(set(ids)) < len(ids):
            raise ValueError("a book is named twice")
        chosen = chosen.where(F.col("book_id").isin(ids))
        if chosen.count() < len(ids):
            raise ValueError("a named book is missing")
    if limit is not None:
        chosen = chosen.orderBy("book_id").limit(limit)
    return Dataset(*[df.join(chosen, "book_id", "left_semi") for df in data.tables().values()])


# --- enrichment ----------------------------------------------------------------------------------------------------


def enrichment_plan(sources: DataFrame, data: Dataset, attempts: int) -> DataFrame:
    """The first so many reviewed pages (priority, slug, book_id, topic) whose book is there with the topic and has no outline."""
    books = data.books.select("book_id", F.explode("topics").alias("topic")).distinct()
    eligible = joins.without_keys(sources.join(books, ["book_id", "topic"], "left_semi"), data.toc, "book_id")
    return eligible.select("priority", "slug", "book_id", "topic").orderBy("priority", "slug").limit(attempts)


def enrichment_outcome(before: Dataset, after: Dataset) -> DataFrame:
    """(book_id, outcome): added, replaced (its outline has other sources), kept, lost or remaining without one."""
    used = lambda d, name: d.toc.groupBy("book_id").agg(F.array_sort(F.collect_set("source_id")).alias(name))
    rows = before.books.select("book_id").distinct().join(used(before, "old"), "book_id", "left").join(used(after, "new"), "book_id", "left")
    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    outcome = F.when(~had & has, "added").when(had & ~has, "lost").when(~has, "remaining").when(F.col("old") != F.col("new"), "replaced").otherwise("kept")
    return rows.select("book_id", outcome.alias("outcome"))


def missing_outline_reasons(books: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(book_id, reason) of books (book_id, topic, urls) without an outline, from artifacts (provider, topic, retrieved_at, response).

    Editions are the books' own addresses at the open library. The newest artifact of the topic that says anything of
    one decides, of several editions the first. Details and failures are taken out of the responses before they meet the
    books, so that no response is repeated.
    """
    part = lambda url, what: F.try_parse_url(url, F.lit(what))
    own = books.select("book_id", "topic", F.explode_outer("urls").alias("url"))
    key = F.when((part(F.col("url"), "HOST") == "openlibrary.org") & part(F.col("url"), "PATH").startswith("/books/"), F.regexp_replace(part(F.col("url"), "PATH"), r"\.json$", ""))
    own = own.select("book_id", "topic", key.alias("key")).distinct()
    r = artifacts.where("provider = 'open-library'")
    get = lambda v, path, kind="string": F.try_variant_get(v, path, kind)
    detail = r.select("topic", "retrieved_at", F.explode(get(F.col("response"), "$.edition_details", "map<string,variant>")).alias("key", "d"))
    toc = get(F.col("d"), "$.table_of_contents", "variant")
    bare = toc.isNull() | F.to_json(toc).isin("null", "[]")
    told = F.when(~F.schema_of_variant("d").startswith("OBJECT"), "invalid_provider_response").when(bare, "provider_returned_no_evidence").otherwise("toc_parse_failure")
    detail = detail.select("topic", "retrieved_at", "key", F.lit(0).alias("rank"), told.alias("reason"))
    failed = r.select("topic", "retrieved_at", F.explode(get(F.col("response"), "$.collection_failures", "array<variant>")).alias("f")).where(get(F.col("f"), "$.stage") == "edition_detail")
    why = get(F.col("f"), "$.reason")
    failed = failed.select("topic", "retrieved_at", get(F.col("f"), "$.external_id").alias("key"), F.lit(1).alias("rank"), F.when(why.isin(*FAILURES), why).otherwise("edition_detail_fetch_failed").alias("reason"))
    found = own.join(detail.unionByName(failed), ["topic", "key"])
    order = F.struct(-F.unix_micros("retrieved_at"), "key", "rank", "reason")
    found = found.groupBy("book_id").agg(F.min_by("reason", order).alias("found"))
    every = own.groupBy("book_id").agg(F.max(F.col("key").isNotNull()).alias("known")).join(found, "book_id", "left")
    return every.select("book_id", F.coalesce("found", F.when(F.col("known"), "edition_detail_not_fetched").otherwise("unsupported_source")).alias("reason"))


# --- reports -------------------------------------------------------------------------------------------------------


def audit_totals(audit: DataFrame) -> DataFrame:
    """(facet, value, books): how often each status, finding and state of evidence is found."""
    facets = F.concat(F.array(F.struct(F.lit("status").alias("facet"), F.col("status").alias("value")), F.struct(F.lit("evidence_state").alias("facet"), F.col("evidence_state").alias("value"))), F.transform("findings", lambda f: F.struct(F.lit("finding").alias("facet"), f.alias("value"))))
    return audit.select("book_id", F.explode(facets).alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("books"))


def warnings(data: Dataset) -> DataFrame:
    """(book_id, warnings) of every book, in a fixed order of kinds."""
    toc = data.toc.select("book_id").distinct().withColumn("has_toc", F.lit(True))
    prose = data.documents.groupBy("book_id").agg(F.sum(F.length("text")).alias("chars"))
    rows = data.books.join(toc, "book_id", "left").join(prose, "book_id", "left")
    kinds = {
        "missing_isbn_13": F.col("isbn_13").isNull(), "missing_isbn_10": F.col("isbn_10").isNull(), "fallback_book_id": F.col("book_id").startswith("book_"), "missing_authors": F.coalesce(F.size("authors") < 1, F.lit(True)),
        "missing_year": F.col("published_year").isNull(), "missing_toc": F.col("has_toc").isNull(), "insufficient_public_prose": F.coalesce("chars", F.lit(0)) == 0,
    }
    return rows.select("book_id", F.array_compact(F.array(*[F.when(c, n) for n, c in kinds.items()])).alias("warnings"))


def translation_status(marker, original_title):
    """yes, no or unknown, from what a bookstore says of the original."""
    m = F.upper(F.trim(F.coalesce(marker, F.lit(""))))
    return F.when((F.length(F.trim(F.coalesce(original_title, F.lit("")))) > 0) | (m == "Y"), "yes").when(m == "N", "no").otherwise("unknown")


def discovery_summary(books: DataFrame, by: list[str]) -> DataFrame:
    """Counts and percentages (two places) of books (with toc and description flags) overall and by each of the columns."""

    def one(rows: DataFrame, facet: str, value) -> DataFrame:
        n = rows.groupBy(value.cast("string").alias("value")).agg(F.count("*").alias("books"), F.count_if("toc").alias("toc_books"), F.count_if("description").alias("description_books"), F.count_if(F.col("toc") & F.col("description")).alias("both_books"))
        pct = [F.round(100.0 * F.col(c) / F.col("books"), 2).alias(c.replace("books", "percentage")) for c in ("toc_books", "description_books", "both_books")]
        return n.select(F.lit(facet).alias("facet"), "*", *pct)

    return reduce(DataFrame.unionByName, [one(books, "all", F.lit("all")), *[one(books, c, F.col(c)) for c in by]])


def in_report_order(books: DataFrame) -> DataFrame:
    """Books by leaf topic, title without case, and id."""
    return books.orderBy(F.element_at("topics", -1), name_key(F.col("title")), "book_id")


def read_evidence(spark: SparkSession, path: str, known: dict[int, str]) -> DataFrame:
    """(book_id, schema_version, line, record) of exported evidence; known: contract by schema version, the first being the default.

    Blank lines are skipped. A line that is no object, or whose contract isn't that of its version, is an error when read.
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    v = F.try_parse_json("value")
    version = F.coalesce(F.try_variant_get(v, "$.schema_version", "int"), F.lit(min(known)))
    contract = F.element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), version)
    good = F.schema_of_variant(v).startswith("OBJECT") & (F.try_variant_get(v, "$.contract_version", "string") == contract)
    bad = F.raise_error(F.concat(F.lit("not evidence of a known contract: "), F.substring("value", 1, 80))).cast("string")
    checked = F.parse_json(F.when(F.coalesce(good, F.lit(False)), F.col("value")).otherwise(bad))
    return lines.select(F.try_variant_get(v, "$.book.book_id", "string").alias("book_id"), version.alias("schema_version"), F.col("value").alias("line"), checked.alias("record"))


def is_transient(status: int | None, timed_out: bool = False, disconnected: bool = False) -> bool:
    """Whether a failed request is worth another try: no answer, too many requests, or the server's own fault."""
    return timed_out or disconnected or status is not None and (status == 429 or status >= 500)
