"""The four canonical tables, raw artifacts, and their domains."""

from __future__ import annotations

from pyspark.sql import types as T

S, A, I, B = T.StringType(), T.ArrayType(T.StringType()), T.IntegerType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


BOOKS = _struct(book_id=S, isbn_10=S, isbn_13=S, title=S, en_title=S, subtitle=S, en_subtitle=S, authors=A, publisher=S, published_year=I, language=S, topics=A)
EXTENT = _struct(scope=S, basis=S)
DOCUMENTS = _struct(document_id=S, book_id=S, document_type=S, text=S, en_text=S, source_id=S, content_hash=S, text_extent=EXTENT)
TOC = _struct(toc_entry_id=S, book_id=S, parent_entry_id=S, level=I, order_index=I, label=S, title=S, en_title=S, source_id=S)
EVIDENCE = _struct(
    evidence_type=S, tier=S, target_isbn=S, target_title=S, target_authors=A, source_edition_id=S, source_isbns=A, source_title=S,
    source_author_ids=A, same_edition=B, source_document_type=S, discovery_method=S, match_basis=A, validation_status=S,
)
SOURCES = _struct(source_id=S, book_id=S, provider=S, source_type=S, url=S, external_id=S, retrieved_at=T.TimestampType(), license=S, rights_note=S, content_hash=S, evidence=EVIDENCE)
TABLES = {"books": BOOKS, "documents": DOCUMENTS, "toc": TOC, "sources": SOURCES}
KEYS = {"books": "book_id", "documents": "document_id", "toc": "toc_entry_id", "sources": "source_id"}
#: Fields that are left out of JSON when null, instead of being written as null.
OMITTED = {"books": ("en_title", "en_subtitle"), "documents": ("en_text", "text_extent"), "toc": ("en_title",), "sources": ()}
RAW = _struct(schema_version=I, provider=S, topic=S, requested_limit=I, retrieved_at=S, request_parameters=T.VariantType(), response=T.VariantType(), content_hash=S)
