"""Canonical tables to evidence records, and the audit of selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tomewright.functions import identity as I
from tomewright.functions import text as X
from tomewright.operators.tree import tree_paths
from tomewright.sources.canonical import Dataset

VERSIONS = ("book-evidence-v1", "book-evidence-v2", "book-evidence-v3")


def _null(kind: str = "string"):
    return F.lit(None).cast(kind)


def toc_in_order(toc: DataFrame) -> DataFrame:
    """Entries a root leads to, with the titles down to them and their place in a depth-first walk.

    Siblings stand by order_index, label, title and id; the walk's order is that of the arrays of sibling ranks.
    """
    rank = F.row_number().over(W.partitionBy("book_id", "parent_entry_id").orderBy("order_index", F.coalesce("label", F.lit("")), "title", "toc_entry_id"))
    ranked = toc.withColumn("step", F.struct(F.lpad(rank.cast("string"), 9, "0").alias("r"), F.col("title").alias("t")))
    steps = ranked.select("toc_entry_id", "parent_entry_id", F.concat(F.col("step.r"), F.lit("\x1e"), F.col("step.t")).alias("step"))
    paths = tree_paths(steps, "toc_entry_id", "parent_entry_id", "step", "\x1f")
    parts = F.split("path", "\x1f")
    return toc.join(paths, "toc_entry_id").withColumn("toc_path", F.transform(parts, lambda x: F.split(x, "\x1e")[1])).withColumn("walk", F.array_join(F.transform(parts, lambda x: F.split(x, "\x1e")[0]), "/")).drop("depth", "path")


def export_evidence(data: Dataset, version: str = VERSIONS[0]) -> DataFrame:
    """(book_id, book, book_content_hash, evidence): items by branch (title, topics, documents, outline), hashed and numbered."""
    if version not in VERSIONS:
        raise ValueError("unsupported contract version")
    english = data.books.where("en_title IS NOT NULL OR en_subtitle IS NOT NULL").select("book_id").unionByName(data.documents.where("en_text IS NOT NULL").select("book_id")).unionByName(data.toc.where("en_title IS NOT NULL").select("book_id"))
    if version != VERSIONS[2] and not english.isEmpty():
        raise ValueError("English fields need the third contract version")
    if version == VERSIONS[0] and not data.documents.where("text_extent IS NOT NULL").isEmpty():
        raise ValueError("text extents need the second contract version")
    order = [F.coalesce(F.col("evidence.evidence_type") != "metadata", F.lit(False)), F.col("source_type") != "metadata_api", F.col("provider"), F.col("source_id")]
    best = data.sources.withColumn("__n", F.row_number().over(W.partitionBy("book_id").orderBy(*order))).where("__n = 1").drop("__n")
    about = ["source_id", "provider", "source_type", "url", "retrieved_at", "content_hash", "evidence", "external_id", "license", "rights_note"]
    src = lambda df: df.select(*[F.col(c).alias(f"s_{c}") for c in about], F.col("book_id").alias("s_book"))
    relation = F.when(F.col("s_evidence.same_edition").isNull(), "unspecified").when(F.col("s_evidence.same_edition"), "exact").otherwise("same_work")
    tocs = F.when(F.col("s_evidence.tier") == "same_work_alternate_edition_toc", "toc_same_work").when(~F.coalesce(F.col("s_evidence.same_edition"), F.lit(False)), "toc_unspecified")
    tocs = tocs.when((F.col("s_evidence.source_document_type") == "public_html") | (F.col("s_evidence.tier") == "validated_public_web_toc"), "toc_public_web_exact").otherwise("toc_exact")
    empty = {"document_id": "string", "document_type": "string", "document_content_hash": "string", "toc_entry_id": "string", "parent_entry_id": "string", "level": "int", "order_index": "int", "label": "string", "toc_path": "array<string>", "metadata_field": "string", "en_text": "string", "text_extent": "struct<scope:string,basis:string>"}

    def branch(df: DataFrame, rank: int, ordinal, identity, kind, text, edition, **more) -> DataFrame:
        cols = [more.get(n, _null(t)).cast(t).alias(n) for n, t in empty.items()]
        return df.select("book_id", F.lit(rank).alias("rank"), ordinal.cast("string").alias("ordinal"), identity.alias("identity"), kind.alias("evidence_type"), text.alias("text"), edition.alias("edition_relation"), *cols, *[f"s_{c}" for c in about])

    record = F.lit("canonical_record")
    titled = data.books.join(src(best), F.col("book_id") == F.col("s_book"))
    both = X.joined_title(F.col("title"), F.col("subtitle"))
    en = F.when(F.col("en_title").isNotNull() & (F.col("subtitle").isNull() | F.col("en_subtitle").isNotNull()), X.joined_title(F.col("en_title"), F.col("en_subtitle")))
    parts = [branch(titled, 0, F.lit(""), F.concat("book_id", F.lit(":metadata:title")), F.lit("metadata_minimal"), both, record, metadata_field=F.lit("title"), en_text=en)]
    topics = titled.select("book_id", F.explode(F.array_distinct("topics")).alias("topic"), *[f"s_{c}" for c in about])
    parts.append(branch(topics, 1, F.col("topic"), F.concat("book_id", F.lit(":metadata:topics:"), "topic"), F.lit("subject"), F.col("topic"), record, metadata_field=F.lit("topics")))
    docs = data.documents.withColumnRenamed("source_id", "own").withColumnRenamed("content_hash", "own_hash").join(src(data.sources), F.col("own") == F.col("s_source_id"))
    kind = F.when(F.col("document_type").isin("description", "publisher_summary"), "description").otherwise("document")
    parts.append(branch(docs, 2, F.col("document_id"), F.concat("book_id", F.lit(":document:"), "document_id"), kind, F.col("text"), relation, document_id=F.col("document_id"), document_type=F.col("document_type"), document_content_hash=F.col("own_hash"), en_text=F.col("en_text"), text_extent=F.col("text_extent")))
    toc = toc_in_order(data.toc).withColumnRenamed("source_id", "own").join(src(data.sources), F.col("own") == F.col("s_source_id")).withColumn("kind", tocs)
    edition = F.when(F.col("kind") == "toc_same_work", "same_work").when(F.col("kind") == "toc_unspecified", "unspecified").otherwise("exact")
    same = {c: F.col(c) for c in ("toc_entry_id", "parent_entry_id", "level", "order_index", "label", "toc_path")}
    parts.append(branch(toc, 3, F.col("walk"), F.concat_ws(":", "book_id", F.lit("toc"), "toc_entry_id", "kind"), F.col("kind"), F.col("title"), edition, en_text=F.col("en_title"), **same))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    named = {"source_id": "s_source_id", "provider": "s_provider", "source_type": "s_source_type", "source_url": "s_url", "source_content_hash": "s_content_hash", "source_evidence": "s_evidence"}
    fields = {n: F.col(n) for n in ("evidence_type", "text", "edition_relation", "metadata_field", "document_id", "document_type", "document_content_hash", "toc_entry_id", "parent_entry_id", "level", "order_index", "label", "toc_path")}
    fields |= {n: F.col(c) for n, c in named.items()} | {"source_evidence_tier": F.col("s_evidence.tier"), "source_retrieved_at": F.date_format("s_retrieved_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")}
    if version != VERSIONS[0]:
        fields |= {"source_external_id": F.col("s_external_id"), "source_license": F.col("s_license"), "source_rights_note": F.col("s_rights_note"), "text_extent": F.col("text_extent")}
    if version == VERSIONS[2]:
        fields["en_text"] = F.col("en_text")
    item = F.struct(*[c.alias(n) for n, c in sorted(fields.items())])
    rows = rows.select("book_id", "rank", "ordinal", "identity", item.alias("item"))
    rows = rows.withColumn("evidence_id", I.stable_id("evidence", F.lit(version), F.col("identity"))).withColumn("provenance_hash", I.sha256_json(F.col("item"), rows.schema["item"].dataType))
    each = F.struct("rank", "ordinal", "evidence_id", "provenance_hash", "item")
    got = rows.groupBy("book_id").agg(F.transform(F.array_sort(F.collect_list(each)), lambda x: F.struct(x["evidence_id"].alias("evidence_id"), x["provenance_hash"].alias("provenance_hash"), x["item"].alias("item"))).alias("evidence"))
    keep = [c for c in data.books.columns if c not in ("en_title", "en_subtitle")]
    book = F.struct(*[F.col(c) for c in sorted(keep)])
    kind = data.books.select(book.alias("b")).schema["b"].dataType
    return data.books.select("book_id", book.alias("book"), I.sha256_json(book, kind).alias("book_content_hash")).join(got, "book_id")


def summary(records: DataFrame) -> DataFrame:
    """Items and books by kind of evidence."""
    rows = records.select("book_id", F.explode("evidence").alias("e"))
    return rows.groupBy(F.col("e.item.evidence_type").alias("evidence_type")).agg(F.count("*").alias("items"), F.count_distinct("book_id").alias("books"), F.count_distinct("e.item.source_id").alias("sources"))


def validate_evidence(records: DataFrame, data: Dataset, version: str) -> DataFrame:
    """(kind, book_id) of books and items that differ from a fresh export."""
    fresh = export_evidence(data, version)
    flat = lambda df: df.select("book_id", "book_content_hash", F.explode("evidence").alias("e")).select("book_id", "book_content_hash", "e.evidence_id", "e.provenance_hash")
    missing = flat(fresh).exceptAll(flat(records)).select(F.lit("missing").alias("kind"), "book_id")
    return missing.unionByName(flat(records).exceptAll(flat(fresh)).select(F.lit("unexpected").alias("kind"), "book_id")).distinct()


def evidence_lines(records: DataFrame, version: str) -> DataFrame:
    """One canonical JSON line a book."""
    head = F.struct(F.lit(int(version[-1])).alias("schema_version"), F.lit(version).alias("contract_version"), "book", "book_content_hash", F.transform("evidence", lambda x: F.struct(x["evidence_id"].alias("evidence_id"), x["provenance_hash"].alias("provenance_hash"), x["item"].alias("item"))).alias("evidence"))
    kind = records.select(head.alias("x")).schema["x"].dataType
    return records.select("book_id", I.canonical_json(head, kind).alias("value"))


def audit_selection(data: Dataset, topic: str, pattern: str, conflict: str | None = None, aids: str = r"study guide|workbook|exam|test bank|solutions? manual") -> DataFrame:
    """One row a book of the topic: findings, status and the state of its evidence."""
    books = data.books.where(F.element_at("topics", -1) == topic)
    docs = data.documents.groupBy("book_id").agg(F.count("*").alias("documents"), F.bool_or(F.col("document_type").isin("description", "publisher_summary")).alias("described"), F.bool_or(~F.col("document_type").isin("description", "publisher_summary", "other")).alias("prose"), F.bool_or(F.col("text").rlike(f"(?i){pattern}")).alias("text_hit"), F.bool_or(F.col("text").rlike(f"(?i){conflict}") if conflict else F.lit(False)).alias("text_conflict"))
    toc = data.toc.groupBy("book_id").agg(F.count("*").alias("entries"))
    used = data.toc.select("source_id").distinct().join(data.sources, "source_id").groupBy("book_id").agg(F.bool_or((F.col("evidence.same_edition") == F.lit(False)) | (F.col("evidence.tier") == "same_work_alternate_edition_toc")).alias("alternate"))
    rows = books.join(docs, "book_id", "left").join(toc, "book_id", "left").join(used, "book_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    title = F.concat_ws(" ", "title", "subtitle")
    has_toc, prose, described = F.col("entries").isNotNull(), yes(F.col("prose")), yes(F.col("described"))
    signals = {
        "alternate_edition_toc": yes(F.col("alternate")), "conflicting_subject_marker": (title.rlike(f"(?i){conflict}") if conflict else F.lit(False)) | yes(F.col("text_conflict")), "no_isbn": F.coalesce("isbn_13", "isbn_10").isNull(), "no_prose": ~prose, "no_toc": ~has_toc,
        "study_aid_marker": title.rlike(f"(?i){aids}"), "title_metadata_only": ~has_toc & F.col("documents").isNull(), "topic_terms_not_observed": ~(title.rlike(f"(?i){pattern}") | yes(F.col("text_hit"))),
    }
    findings = F.array_compact(F.array(*[F.when(c, n) for n, c in signals.items()]))
    review = F.arrays_overlap(findings, F.array(*[F.lit(x) for x in ("alternate_edition_toc", "conflicting_subject_marker", "no_isbn", "study_aid_marker", "topic_terms_not_observed")]))
    status = F.when(review, "review_required").when(has_toc | F.col("documents").isNotNull(), "evidence_present").otherwise("metadata_only")
    state = F.when(prose & has_toc, "toc_and_prose_documents").when(prose, "prose_documents").when(has_toc & described, "toc_and_description").when(has_toc, "toc_only").when(described, "description_only").when(F.col("documents").isNotNull(), "other_documents_only").otherwise("metadata_only")
    return rows.select("book_id", "title", F.coalesce("entries", F.lit(0)).alias("toc_entries"), findings.alias("findings"), status.alias("status"), state.alias("evidence_state"))
