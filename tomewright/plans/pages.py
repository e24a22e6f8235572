"""Reviewed pages to canonical evidence: catalog pages, publisher pages, landing pages, textbooks and prefaces.

A registry row says which book a page is about, in which format its outline is, and what was seen when it was
reviewed. Each page comes back once: accepted, or with the first reason why not. Pages are read once in an Arrow
batch (facts and outline); every check after that is a JVM expression over arrays. The registry is a dimension of
reviewed pages; it is joined by its slug, and Catalyst broadcasts it only below its own size limit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewright.functions import identity as I
from tomewright.functions import text as X
from tomewright.sources.canonical import Dataset
from tomewright.sources.dom import section, structured, tree
from tomewright.sources.page_outlines import outline_of, toc_rows
from tomewright.sources.schemas import TABLES

#: A registry row. Lists that are empty or null aren't checked.
_TEXTS = (
    "slug provider topic book_id isbn_10 isbn_13 title url home_url toc_url toc_format identity_format document_format source_type rights_note evidence_tier source_title source_isbn source_edition_id"
    " doi ebook_isbn springer_edition_label edition_relation publisher version source_format license"
)
_LISTS = "authors expected_root_titles expected_chapter_labels expected_toc_labels expected_identity_markers expected_entry_titles source_authors"
_COUNTS = "edition root_indent_threshold expected_toc_count published_year"
_KINDS = {T.StringType(): _TEXTS, T.ArrayType(T.StringType()): _LISTS, T.IntegerType(): _COUNTS, T.ArrayType(T.IntegerType()): "expected_child_counts expected_descendant_counts", T.ArrayType(T.ArrayType(T.StringType())): "expected_child_label_groups"}
SPEC = T.StructType([T.StructField(n, kind) for kind, names in _KINDS.items() for n in names.split()])
FACTS = "struct<heading:string,subheading:string,isbn:string,edition:string,text:string,book_title:string,book_edition:string,authors:array<string>,years:array<string>,name:string,book_isbn:string,declared_edition:string,book_year:string,book_authors:array<string>,any_isbn:string,any_name:string,summary:string,welcome:string,key:string>"
FIELDS = [f.split(":")[0] for f in FACTS[len("struct<") : -1].split(",")]
#: Texts the sources are marked with, formats whose chapters are roots, headings and openings looked for.
PUBLISHER_RIGHTS = "Public publisher companion page; no license statement found."
CATALOG_RIGHTS = "Public bookstore catalog page; no license statement found."
LANDING_RIGHTS = "Springer book landing page; chapter titles and page ranges only, no chapter text."
TEXTBOOK_RIGHTS = "Author-hosted page states that the book chapters are free online; no reuse license was identified."
AUTHOR_HEADING = "Table of Contents For Xinu 2nd Edition"
AUTHOR_EDITION = "purdue-xinu-second-edition-2015"
WELCOME = "Welcome to Operating Systems: Three Easy Pieces"
ROOT_CHAPTERS = ("flat_bold", "bold_chapter_paragraphs", "xinu_author_table", "springer_book_chapters")
BASIS = {
    "ecampus_product": ("exact_isbn", "exact_edition", "normalized_title"),
    "xinu_second_edition": ("official_author_page", "explicit_second_edition", "reviewed_platform_markers", "reviewed_toc_shape"),
    "springer_book": ("official_publisher_page", "normalized_title", "exact_author", "exact_edition", "exact_copyright_year", "source_eisbn", "reviewed_toc_shape"),
    "publisher": ("exact_isbn", "normalized_title", "edition", "reviewed_toc_shape"),
}
#: Fixed values of preface excerpts: the provider's name, the closing attribution, the least length.
PREFACE = ("kyungmoon-preface-excerpt", re.compile(r"[-–—]?\s*머리말\s+(?:중|中)\s*에서\s*[-–—]?\s*$"), 120)
PREFACE_URL = r"^https://www\.kyungmoon\.com/shop/item\.php\?(it_id=[0-9]+(&device=pc)?|device=pc&it_id=[0-9]+)$"


@dataclass
class Reviewed:
    """Evidence from accepted pages, and every page with its reason (null: accepted)."""

    data: Dataset
    pages: DataFrame


def load_registry(spark: SparkSession, folder: str) -> DataFrame:
    """All specs of a folder, one JSON file each; a file whose name isn't its slug is an error, as is broken JSON."""
    rows = spark.read.schema(SPEC).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "*.json").json(folder)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    named = F.when(F.col("slug") == stem, F.col("slug")).otherwise(F.raise_error(F.concat(F.lit("registry file isn't named by its slug: "), stem)))
    return rows.withColumn("slug", named)


def registry(spark: SparkSession, specs: list[dict]) -> DataFrame:
    """Specs given in place; fields left out are null."""
    return spark.createDataFrame([tuple(s.get(n) for n in SPEC.names) for s in specs], SPEC)


def _facts(page: str | None) -> dict:
    root = tree(page)
    shown = lambda n: n.text() if n else ""
    books = structured(root)
    first = books[0] if books else {}
    known = next((b for b in books if b.get("isbn")), {})
    said = lambda key: next((b[key] for b in books if isinstance(b.get(key), str)), "")
    edition = known.get("bookEdition")
    box = section(root, "Summary")
    years = [m[1] for n in root.all("li", "c-article-identifiers__item") if (m := re.search(r"\b(\d{4})\b", n.text()))]
    return {
        "heading": shown(root.first("h1", "title")), "subheading": shown(root.first("h2")), "isbn": shown(root.first(itemprop="isbn")) or said("isbn"), "edition": shown(root.first(itemprop="bookEdition")) or said("bookEdition"), "text": root.text(),
        "book_title": shown(root.first(data_test="book-title")), "book_edition": shown(root.first(data_test="edition-number")), "authors": [n.text() for n in root.all(data_test="author-name")], "years": years, "name": str(first.get("name", "")), "book_isbn": str(first.get("isbn", "")),
        "declared_edition": str(edition) if isinstance(edition, (str, int)) and not isinstance(edition, bool) else None, "book_year": str(first.get("copyrightYear", "")), "book_authors": [str(a.get("name", "")) for a in first.get("author") or [] if isinstance(a, dict)],
        "any_isbn": str(known.get("isbn", "")), "any_name": str(known.get("name", "")), "summary": shown(box), "welcome": next((t for p in root.all("p") if (t := p.text()).startswith(WELCOME)), None), "key": X.bibliographic(root.text()),
    }


def facts_of(html: Column) -> Column:
    """What a page says about its book."""

    @F.pandas_udf(FACTS)
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_facts(p if isinstance(p, str) else None) for p in pages], columns=FIELDS, dtype=object)

    return run(html)


def given(c: str) -> Column:
    """Whether a list of the spec is there to be checked."""
    return F.coalesce(F.size(c), F.lit(0)) > 0


def first_reason(*checks: tuple[str, Column]) -> Column:
    """The name of the first check that doesn't hold; an unknown outcome doesn't hold."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks], F.lit(None).cast("string"))


def contract(entries: str) -> list[tuple[str, Column]]:
    """Checks of an outline's shape against its spec: count, roots, chapters, children and descendants of each root."""
    e = F.col(entries)
    roots = F.filter(e, lambda x: x["parent"].isNull())
    at = F.transform(roots, lambda x: x["pos"])
    labels = lambda xs: F.transform(F.filter(xs, lambda x: F.coalesce(F.length(x["label"]), F.lit(0)) > 0), lambda x: x["label"])
    below = lambda r: F.filter(e, lambda x: x["parent"] == r)
    level = F.when(F.col("toc_format").isin(*ROOT_CHAPTERS), 1).otherwise(2)
    after = F.transform(at, lambda p, i: F.coalesce(F.get(at, i + 1), F.size(e)) - p - 1)
    return [
        ("entry_count", (F.size(e) == F.col("expected_toc_count")) | F.col("expected_toc_count").isNull()),
        ("root_titles", ~given("expected_root_titles") | (F.transform(roots, lambda x: x["title"]) == F.col("expected_root_titles"))),
        ("chapter_labels", ~given("expected_chapter_labels") | (labels(F.filter(e, lambda x: x["level"] == level)) == F.col("expected_chapter_labels"))),
        ("child_labels", ~given("expected_child_label_groups") | (F.transform(at, lambda r: labels(below(r))) == F.col("expected_child_label_groups"))),
        ("child_counts", ~given("expected_child_counts") | (F.transform(at, lambda r: F.size(below(r))) == F.col("expected_child_counts"))),
        ("descendant_counts", ~given("expected_descendant_counts") | (after == F.col("expected_descendant_counts"))),
    ]


def matched(pages: DataFrame, specs: DataFrame) -> DataFrame:
    """Pages (source_slug, topic, retrieved_at and their texts) beside their spec's fields; pages keep their own urls as page_*."""
    own = {"topic": "page_topic", "url": "page_url", "home_url": "page_home_url", "toc_url": "page_toc_url"}
    renamed = pages.withColumnsRenamed({k: v for k, v in own.items() if k in pages.columns})
    return renamed.join(specs, renamed["source_slug"] == specs["slug"], "left")


def same(a: Column, b: Column) -> Column:
    return X.bibliographic_key(a) == X.bibliographic_key(b)


def source_key(url: str = "url") -> Column:
    return I.stable_id("source", F.col("provider"), F.col(url), F.col("book_id"))


def evidence(tier: Column, isbn: Column, edition: Column, isbns: Column, title: Column, same_edition: Column, kind: str, found: str, basis: Column, status: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.struct(
        F.lit("toc").alias("evidence_type"), tier.alias("tier"), isbn.alias("target_isbn"), F.col("title").alias("target_title"), F.coalesce("authors", none).alias("target_authors"), edition.alias("source_edition_id"), isbns.alias("source_isbns"), title.alias("source_title"),
        none.alias("source_author_ids"), same_edition.alias("same_edition"), F.lit(kind).alias("source_document_type"), F.lit(found).alias("discovery_method"), basis.alias("match_basis"), status.alias("validation_status"),
    ).cast(TABLES["sources"]["evidence"].dataType)


def source_rows(rows: DataFrame, id_: str, source_type: Column, url: str, external: Column, rights: Column, html: str, proof: Column | None = None) -> DataFrame:
    proof = F.lit(None).cast(TABLES["sources"]["evidence"].dataType) if proof is None else proof
    return rows.select(F.col(id_).alias("source_id"), "book_id", "provider", source_type.alias("source_type"), F.col(url).alias("url"), external.alias("external_id"), F.col("retrieved_at").cast("timestamp").alias("retrieved_at"), F.lit(None).cast("string").alias("license"), rights.alias("rights_note"), I.sha256_text(F.col(html)).alias("content_hash"), proof.alias("evidence"))


def document_rows(rows: DataFrame, text: Column, kind: str, id_: Column | None = None, extent: Column | None = None) -> DataFrame:
    own = rows.withColumn("__t", text).where(F.length("__t") > 0)
    null = F.lit(None).cast("string")
    id_ = I.stable_id("doc", F.col("book_id"), F.lit(kind), F.col("source_id")) if id_ is None else id_
    extent = F.lit(None) if extent is None else extent
    return own.select(id_.alias("document_id"), "book_id", F.lit(kind).alias("document_type"), F.col("__t").alias("text"), null.alias("en_text"), "source_id", I.sha256_text(F.col("__t")).alias("content_hash"), extent.cast(TABLES["documents"]["text_extent"].dataType).alias("text_extent"))


def _empty(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], TABLES[name])


def reasons(rows: DataFrame) -> DataFrame:
    return rows.select("source_slug", "reason", F.coalesce(F.size("entries"), F.lit(0)).alias("entries"))


def catalog_pages(pages: DataFrame, specs: DataFrame) -> Reviewed:
    """Exact-edition catalog pages (source_slug, topic, retrieved_at, url, html) in three identity formats and ten outline formats."""
    rows = matched(pages, specs).withColumn("facts", facts_of(F.col("html")))
    rows = rows.withColumn("read", outline_of(F.col("html"), F.col("toc_format"), F.col("root_indent_threshold"), F.col("source_edition_id")))
    rows = rows.withColumn("entries", F.col("read.entries")).withColumn("source_id", source_key())
    kind = F.coalesce("identity_format", F.lit("ecampus_product"))
    f, none = (lambda n: F.col(f"facts.{n}")), F.array().cast("array<string>")
    rows = rows.withColumn("markers", marker_keys(F.coalesce("expected_identity_markers", none)))
    product = same(f("heading"), F.col("title")) & (f("isbn") == F.col("isbn_13")) & F.array_contains(X.edition_numbers(F.concat(f("edition"), F.lit(" edition"))), F.col("edition"))
    author = same(f("subheading"), F.lit(AUTHOR_HEADING)) & ((f("isbn") == "") | (f("isbn") == F.col("isbn_13"))) & F.forall("markers", lambda m: F.contains(F.col("facts.key"), m))
    theirs = F.coalesce("source_title", "title")
    isbn = I.isbn_digits(F.col("source_isbn"))
    springer = (
        same(f("book_title"), theirs) & same(f("name"), theirs) & F.array_contains(X.edition_numbers(f("book_edition")), F.col("edition")) & (f("authors") == F.coalesce("source_authors", none)) & (f("book_authors") == F.coalesce("source_authors", none))
        & (I.isbn_digits(f("book_isbn")) == isbn) & (f("book_year") == F.col("published_year").cast("string")) & F.array_contains(f("years"), F.col("published_year").cast("string"))
    )
    identity = F.when(kind == "ecampus_product", product).when(kind == "xinu_second_edition", author).when(kind == "springer_book", springer)
    wants = F.coalesce("document_format", F.lit("ecampus_summary")) == "ecampus_summary"
    reason = first_reason(("unknown_source", F.col("slug").isNotNull()), ("topic", F.col("page_topic") == F.col("topic")), ("url", F.col("page_url") == F.col("url")), ("no_page", F.col("html").isNotNull()), ("identity", identity), ("outline_format", F.col("read.error").isNull()), *contract("entries"), ("no_summary", ~wants | (f("summary") != "")))
    rows = rows.withColumn("reason", reason)
    kept = rows.where("reason IS NULL")
    edition = F.when(kind == "ecampus_product", F.col("isbn_13")).when(kind == "xinu_second_edition", F.coalesce("source_edition_id", F.lit(AUTHOR_EDITION))).otherwise(F.col("source_edition_id"))
    isbns = F.when(kind == "ecampus_product", F.array("isbn_13")).when(kind == "springer_book", F.array(isbn)).otherwise(none)
    basis = F.coalesce(*[F.when(kind == k, F.array(*[F.lit(b) for b in v])) for k, v in BASIS.items()])
    proof = evidence(F.coalesce("evidence_tier", F.lit("exact_edition_toc")), F.col("isbn_13"), edition, isbns, theirs, F.lit(True), "public_html", "reviewed_public_page_registry", basis, F.lit("strong"))
    sources = source_rows(kept, "source_id", F.coalesce("source_type", F.lit("other")), "url", F.coalesce("source_edition_id", "source_isbn", "isbn_13"), F.coalesce("rights_note", F.lit(CATALOG_RIGHTS)), "html", proof)
    docs = document_rows(kept.where(wants), f("summary"), "description")
    return Reviewed(Dataset(_empty(pages, "books"), docs, toc_rows(kept, "book_id", "source_id", "entries"), sources), reasons(rows))


@F.pandas_udf(T.ArrayType(T.StringType()))
def marker_keys(values: pd.Series) -> pd.Series:
    """Comparison forms of a list of markers."""
    return values.map(lambda xs: [X.bibliographic(x) or "" for x in xs], na_action="ignore")


def publisher_pages(pages: DataFrame, specs: DataFrame) -> Reviewed:
    """Exact-edition publisher pages (source_slug, topic, retrieved_at, home_url, toc_url, home_html, toc_html): identity on one page, chapters on the other."""
    rows = matched(pages, specs).withColumn("facts", facts_of(F.col("home_html")))
    rows = rows.withColumn("read", outline_of(F.col("toc_html"), F.lit("chapter_headings"))).withColumn("entries", F.col("read.entries"))
    rows = rows.withColumn("source_id", source_key("toc_url")).withColumn("home_id", source_key("home_url"))
    labels = F.transform("entries", lambda x: x["label"])
    identity = F.contains(F.col("facts.key"), X.bibliographic_key(F.col("title"))) & F.contains(F.col("home_html"), F.col("isbn_10"))
    reason = first_reason(
        ("unknown_source", F.col("slug").isNotNull()), ("topic", F.col("page_topic") == F.col("topic")), ("url", (F.col("page_home_url") == F.col("home_url")) & (F.col("page_toc_url") == F.col("toc_url"))), ("no_page", F.col("home_html").isNotNull() & F.col("toc_html").isNotNull()),
        ("identity", identity), ("edition", F.array_contains(X.edition_numbers(F.col("facts.text")), F.col("edition"))), ("outline_format", F.col("read.error").isNull() & (F.size("entries") > 0)), ("chapter_labels", labels == F.col("expected_toc_labels")),
    )
    rows = rows.withColumn("reason", reason)
    kept = rows.where("reason IS NULL").withColumn("authors", F.array().cast("array<string>"))
    kind, rights = F.lit("publisher_page"), F.lit(PUBLISHER_RIGHTS)
    proof = evidence(F.lit("validated_public_web_toc"), F.col("isbn_10"), F.col("isbn_10"), F.array("isbn_10"), F.col("title"), F.lit(True), "public_html", "reviewed_publisher_allowlist", F.array(*[F.lit(b) for b in BASIS["publisher"]]), F.lit("strong"))
    sources = source_rows(kept, "home_id", kind, "home_url", F.col("isbn_10"), rights, "home_html").unionByName(source_rows(kept, "source_id", kind, "toc_url", F.col("isbn_10"), rights, "toc_html", proof))
    return Reviewed(Dataset(_empty(pages, "books"), _empty(pages, "documents"), toc_rows(kept, "book_id", "source_id", "entries"), sources), reasons(rows))


def landing_pages(pages: DataFrame, specs: DataFrame, provider: str = "springer") -> Reviewed:
    """Landing pages of a publisher (source_slug, topic, retrieved_at, url, html). Another edition's contents are never recorded as the book's own."""
    rows = matched(pages, specs.withColumn("provider", F.coalesce("provider", F.lit(provider)))).withColumn("facts", facts_of(F.col("html")))
    rows = rows.withColumn("read", outline_of(F.col("html"), F.lit("springer_landing"))).withColumn("entries", F.col("read.entries")).withColumn("source_id", source_key())
    label = F.col("springer_edition_label")
    wanted, declared = X.edition_numbers(label), X.edition_numbers(F.concat(F.col("facts.declared_edition"), F.lit(" edition")))
    edition = F.coalesce(F.length(label) == 0, F.lit(True)) | (F.size(wanted) > 0) & (wanted == declared)
    reason = first_reason(
        ("unknown_source", F.col("slug").isNotNull()), ("topic", F.col("page_topic") == F.col("topic")), ("url", F.col("page_url") == F.col("url")), ("no_page", F.col("html").isNotNull()), ("isbn", F.replace(F.col("facts.any_isbn"), F.lit("-"), F.lit("")) == F.col("ebook_isbn")),
        ("title", same(F.col("facts.any_name"), F.col("title"))), ("edition", edition), ("outline_format", F.col("read.error").isNull()), ("entry_titles", F.transform("entries", lambda x: x["title"]) == F.col("expected_entry_titles")),
    )
    rows = rows.withColumn("reason", reason)
    kept, exact = rows.where("reason IS NULL"), F.coalesce(F.col("edition_relation") == "exact", F.lit(False))
    other = F.concat(F.lit(" Contents belong to the Springer "), F.coalesce(label, F.lit("edition")), F.lit(", not to the canonical record's own edition."))
    basis = F.concat(F.array(F.lit("exact_ebook_isbn"), F.lit("normalized_title"), F.lit("reviewed_chapter_sequence")), F.array(F.when(exact, "exact_edition").otherwise("same_work_doi")))
    tier = F.when(exact, "exact_edition_toc").otherwise("same_work_alternate_edition_toc")
    proof = evidence(tier, F.col("isbn_13"), F.col("doi"), F.array("ebook_isbn"), F.col("facts.any_name"), exact, "publisher_html", "reviewed_springer_registry", basis, F.when(exact, "strong").otherwise("acceptable"))
    sources = source_rows(kept, "source_id", F.lit("publisher_page"), "url", F.col("doi"), F.concat(F.lit(LANDING_RIGHTS), F.when(exact, "").otherwise(other)), "html", proof)
    return Reviewed(Dataset(_empty(pages, "books"), _empty(pages, "documents"), toc_rows(kept, "book_id", "source_id", "entries"), sources), reasons(rows))


def textbook_pages(pages: DataFrame, specs: DataFrame, topics: dict[str, list[str]]) -> Reviewed:
    """Open textbooks with an HTML outline (source_slug, topic, retrieved_at, home_url, home_html): a book of its own with its source and outline.

    The page names the book's title, authors, publisher, version, ISBN-10 and year, so far as the spec has them.
    Books whose outline is in a PDF come back with the reason outline_format.
    """
    rows = matched(pages, specs).withColumn("facts", facts_of(F.col("home_html"))).withColumn("read", outline_of(F.col("home_html"), F.col("source_format")))
    rows = rows.withColumn("entries", F.col("read.entries")).withColumn("source_id", source_key("home_url"))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("markers", marker_keys(F.array_compact(F.concat(F.array("title", "publisher", "version"), F.coalesce("authors", none)))))
    identity = F.forall("markers", lambda m: F.contains(F.col("facts.key"), m)) & F.coalesce(F.contains(F.col("home_html"), F.col("isbn_10")), F.lit(True)) & F.coalesce(F.contains(F.col("facts.text"), F.col("published_year").cast("string")), F.lit(True))
    reason = first_reason(("unknown_source", F.col("slug").isNotNull()), ("topic", F.col("page_topic") == F.col("topic")), ("url", F.col("page_home_url") == F.col("home_url")), ("no_page", F.col("home_html").isNotNull()), ("identity", identity), ("outline_format", F.col("read.error").isNull()), *contract("entries"))
    rows = rows.withColumn("reason", reason)
    kept, null = rows.where("reason IS NULL"), F.lit(None).cast("string")
    chosen = F.coalesce(*[F.when(F.col("topic") == t, F.array(*[F.lit(x) for x in xs])) for t, xs in topics.items()], none)
    books = kept.select("book_id", "isbn_10", "isbn_13", "title", null.alias("en_title"), null.alias("subtitle"), null.alias("en_subtitle"), "authors", "publisher", "published_year", F.lit("en").alias("language"), chosen.alias("topics"))
    sources = source_rows(kept, "source_id", F.lit("open_textbook"), "home_url", F.col("slug"), F.lit(TEXTBOOK_RIGHTS), "home_html").withColumn("license", null)
    return Reviewed(Dataset(books, document_rows(kept, F.col("facts.welcome"), "description"), toc_rows(kept, "book_id", "source_id", "entries"), sources), reasons(rows))


def _excerpt(page: str | None) -> dict:
    root = tree(page)
    titles, boxes, tables = root.all(id="sit_title"), root.all(id="sit_introduce_explan"), root.all("table", "sit_ov_tbl")
    if not len(titles) == len(boxes) == len(tables) == 1:
        return {"error": "ambiguous", "isbn": None, "title": None, "text": None, "said": None}
    fields: list[tuple[str, str]] = [(h.text(), v.text()) for r in tables[0].all("tr") if (h := r.first("th")) and (v := r.first("td"))]
    for n in boxes[0].all():
        if "hidden" in n.attrs or n.attrs.get("aria-hidden") == "true":
            n.children = []
    text = "\n".join(boxes[0].pieces())
    said = PREFACE[1].search(text)
    return {"error": "duplicate_field" if len(dict(fields)) < len(fields) else None, "isbn": re.sub("[- ]", "", dict(fields).get("ISBN", "")), "title": titles[0].text(), "text": text, "said": said.group() if said else None}


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("error", "isbn", "title", "text", "said")]))
def excerpt_of(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_excerpt(v if isinstance(v, str) else None) for v in values], columns=["error", "isbn", "title", "text", "said"], dtype=object)


def preface_excerpts(pages: DataFrame, books: DataFrame) -> Reviewed:
    """Product pages (book_id, retrieved_at, url, html) whose text is attributed to the preface, for Korean books with that ISBN."""
    own = books.select("book_id", "isbn_13", "title", "language")
    rows = pages.join(own, "book_id", "left").withColumn("x", excerpt_of(F.col("html"))).withColumn("provider", F.lit(PREFACE[0])).withColumn("source_id", I.stable_id("source", F.lit(PREFACE[0]), F.col("book_id"), F.col("url")))
    reason = first_reason(
        ("unknown_book", F.col("title").isNotNull()), ("url", F.col("url").rlike(PREFACE_URL)), ("ambiguous_page", F.col("x.error").isNull() & F.col("html").isNotNull()), ("isbn", F.col("x.isbn") == F.col("isbn_13")),
        ("title", F.contains(X.bibliographic_key(F.col("x.title")), X.bibliographic_key(F.col("title")))), ("language", F.col("language") == "ko"), ("no_attribution", F.col("x.said").isNotNull() & (F.length("x.text") >= PREFACE[2])),
    )
    rows = rows.withColumn("reason", reason)
    kept = rows.where("reason IS NULL")
    basis = F.when(F.contains("x.said", F.lit("中")), "머리말 中에서").otherwise("머리말 중에서")
    rights = F.concat(F.lit("Public publisher product page explicitly attributes this section to a preface excerpt ("), basis, F.lit("). Partial excerpt, not a complete preface or sample chapter. Matched product ISBN and title to the Korean canonical edition; printing-specific differences were not verified. No reuse license established. HTML text extraction only; no OCR or translation."))
    sources = source_rows(kept, "source_id", F.lit("publisher_page"), "url", F.concat("isbn_13", F.lit(":preface_excerpt")), rights, "html")
    docs = document_rows(kept, F.col("x.text"), "preface", I.stable_id("doc", F.col("source_id"), F.lit("preface"), I.sha256_text(F.col("x.text"))), F.struct(F.lit("excerpt").alias("scope"), F.concat(F.lit("Publisher introduction section explicitly ends with "), basis, F.lit(".")).alias("basis")))
    return Reviewed(Dataset(_empty(pages, "books"), docs, _empty(pages, "toc"), sources), rows.select("book_id", "url", "reason"))
