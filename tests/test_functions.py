"""Scalar functions against plain Python."""

import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomewright.functions import identity as I
from tomewright.functions import text as X
from tomewright.operators import decisions


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("value", "ok"), [("0306406152", True), ("0306406153", False), ("080442957X", True), ("X804429570", False), ("12345", False), ("", False)])
def test_isbn10(spark, value, ok):
    assert one(spark, I.isbn10_valid(F.lit(value))) is ok


@pytest.mark.parametrize(("value", "ok"), [("9780306406157", True), ("9780306406158", False), ("978030640615X", False), ("97803064", False)])
def test_isbn13(spark, value, ok):
    assert one(spark, I.isbn13_valid(F.lit(value))) is ok


def test_isbn_conversion_and_cleaning(spark):
    assert one(spark, I.isbn10_to_13(F.lit("0306406152"))) == "9780306406157"
    assert one(spark, I.normalize_isbn(F.lit("ISBN 0-8044-2957-x"), 10)) == "080442957X"
    assert one(spark, I.normalize_isbn(F.lit("0-8044-2957-1"), 10)) is None
    assert one(spark, I.normalize_isbn(F.lit(None).cast("string"), 13)) is None


def test_stable_id_counts_null_parts(spark):
    expected = "doc_" + hashlib.sha256("a\x1f\x1fb".encode()).hexdigest()[:20]
    assert one(spark, I.stable_id("doc", F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == expected


def test_canonical_json_sorts_and_keeps_nulls(spark):
    df = spark.createDataFrame([(("x", None, [("b", 1)]),)], "v struct<z:string,a:int,m:array<struct<q:string,c:int>>>")
    got = df.select(I.canonical_json(F.col("v"), df.schema["v"].dataType).alias("x")).first()["x"]
    assert got == json.dumps({"z": "x", "a": None, "m": [{"q": "b", "c": 1}]}, sort_keys=True, separators=(",", ":"))


@pytest.mark.parametrize(("value", "form"), [("C++ & C#: Straße", "c plus plus c sharp strasse"), ("Ｆｕｌｌ  width", "full width"), ("운영체제—2판", "운영체제 2판"), ("", ""), (None, None)])
def test_bibliographic_form(value, form):
    assert X.bibliographic(value) == form


@given(st.text(max_size=60))
def test_bibliographic_form_is_stable(value):
    once = X.bibliographic(value)
    assert X.bibliographic(once) == once and once == once.strip() and "  " not in once


def test_numbers_in_text(spark):
    assert one(spark, X.edition_numbers(F.lit("Third ed., 2nd edition, 12 ed"))) == [2, 3, 12]
    assert one(spark, X.published_year(F.lit("c1998, rev. 12005"))) == 1998
    assert one(spark, X.published_year(F.lit("no year"))) is None
    assert one(spark, X.volume_number(F.lit("the art vol 4"))) == 4
    assert one(spark, X.clean_title(F.lit("  .A\n b . "))) == "A b"
    assert one(spark, X.by_statement_authors(F.lit("[by] Ann Lee, Bo Ek and Cy."))) == ["Ann Lee", "Bo Ek", "Cy"]
    assert one(spark, X.joined_title(F.lit("T"), F.lit(""))) == "T"
    assert one(spark, X.formula_safe(F.lit(" =1+1"))) == "' =1+1"


def test_labels(spark):
    rows = spark.createDataFrame([("Yes",), ("0",), (" ",), (None,)], "v string")
    assert [r.x for r in rows.select(X.label_value(F.col("v")).alias("x")).collect()] == [True, False, None, None]
    with pytest.raises(Exception, match="not a label"):
        spark.createDataFrame([("maybe",)], "v string").select(X.label_value(F.col("v"))).collect()


def test_html_blocks_ignore_hidden_text_and_unclosed_tags():
    page = "<h1>A &amp; B<p>one <b>two</b><script>var x='<p>no'</script><p>three"
    assert X.html_blocks(page) == [("h1", "A & B"), ("p", "one two"), ("p", "three")]


def test_relevance_prefers_subjects(spark):
    f = lambda s, t: one(spark, decisions.relevance(F.lit(s), F.lit(t), "network", "social"))
    assert f("Social networks", "Networks") == "conflicting_subject"
    assert f("Computer networks", "x") == "matching_subject"
    assert f("", "Networks") == "title_only_unverified"
    assert f(None, "Cooking") == "no_topic_evidence"


def test_scope_order(spark):
    f = lambda s, en=True, isbn=True, **kw: one(spark, decisions.scope_decision(F.lit("t"), F.lit(s), F.lit(en), F.lit(isbn), "math", **kw))
    assert f("math", en=False, isbn=False) == "no_english_edition"
    assert f("math", isbn=False) == "missing_valid_isbn"
    assert f("math | juvenile") == "conflicting_audience"
    assert f("math", audience="teen") == "audience_unconfirmed"
    assert f("math fiction") == "conflicting_book_kind"
    assert f("math", book_kind="textbook") == "book_kind_unconfirmed"
    assert f("art") == "no_subject_evidence"
