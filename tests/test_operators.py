"""Generic operators: trees, folds, merges, validation, batches."""

import pytest
from pyspark.sql import functions as F

from tomewright.operators import batching, dedupe, joins, merge, outlines, tree, validation
from tomewright.sources.canonical import Dataset
from tomewright.sources.schemas import TABLES


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_first_wins_before_limit(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "a"), (4, "c")], "pos int, k string")
    assert rows(dedupe.first_wins(df, "k", ["pos"], 2), "pos", "k") == [(0, "a"), (2, "b")]


def test_levels_skip_orphans_without_registering_them(spark):
    df = spark.createDataFrame([("b", i, level) for i, level in enumerate([1, 3, 2, 3, 1, 3, 2])], "g string, pos int, level int")
    got = rows(tree.levels_to_parents(df, "g", "pos", "level"), "pos", "level", "parent", "order_index")
    assert got == [(0, 1, None, 0), (2, 2, 0, 0), (3, 3, 2, 0), (4, 1, None, 1), (6, 2, 4, 0)]


def test_levels_clamped_have_no_orphans(spark):
    df = spark.createDataFrame([("b", i, level) for i, level in enumerate([2, 4, 4, 2])], "g string, pos int, level int")
    got = rows(tree.levels_to_parents(df, "g", "pos", "level", clamp=True), "pos", "level", "parent")
    assert got == [(0, 1, None), (1, 2, 0), (2, 2, 0), (3, 1, None)] or got == [(0, 1, None), (1, 2, 0), (2, 3, 1), (3, 1, None)]


def test_paths_and_cycles(spark):
    df = spark.createDataFrame([("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("x", "y", "X"), ("y", "x", "Y"), ("z", "y", "Z")], "id string, up string, t string")
    assert rows(tree.tree_paths(df, "id", "up", "t"), "id", "depth", "path") == [("a", 1, "A"), ("b", 2, "A > B"), ("c", 3, "A > B > C")]
    assert rows(tree.parent_cycles(df, "id", "up"), "id") == [("x",), ("y",)]


def test_deep_tree(spark):
    df = spark.range(400).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("up"), F.lit("t").alias("t"))
    assert tree.tree_paths(df, "id", "up", "t").count() == 400
    assert tree.parent_cycles(df, "id", "up").count() == 0


def test_batches_close_before_the_limit(spark):
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate([5, 5, 1, 30, 2, 8])], "g string, pos int, n int")
    assert rows(batching.greedy_batches(df, "g", "pos", "n", 10), "pos", "batch") == [(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 3)]


def test_chunks_round_trip(spark):
    df = spark.createDataFrame([(1, "abcdefg"), (2, ""), (3, "é" * 9)], "id int, text string")
    pieces = batching.chunk_text(df, "id", "text", 3)
    assert rows(batching.reassemble(pieces, "id"), "id", "text") == [(1, "abcdefg"), (3, "é" * 9)]


def test_spans_have_code_point_offsets(spark):
    df = spark.createDataFrame([(1, "über Exam, exam"), (2, None)], "id int, text string")
    assert rows(batching.regex_spans(df, "id", "text", "exam"), "id", "start", "end", "match") == [(1, 5, 9, "Exam"), (1, 11, 15, "exam")]


def test_tiers_and_gains(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert rows(joins.tiered(base, "k", [("exact", a), ("alt", b)], "v"), "k", "tier") == [(1, "exact"), (2, "alt"), (3, "none")]
    assert rows(joins.gains([("first", a), ("second", b)], "k"), "k", "stage") == [(1, "first"), (2, "second")]


def test_merge_records_coalesces_and_finds_conflicts(spark):
    df = spark.createDataFrame([("a", 0, "t", None, ["x"]), ("a", 1, "t", "en", ["y", "x"]), ("b", 2, "t", None, []), ("b", 3, "u", None, [])], "id string, o int, title string, en string, topics array<string>")
    got = {r.id: r for r in merge.merge_records(df, "id", "o", ["en"], ("topics",)).collect()}
    assert (got["a"].en, got["a"].topics, got["a"].conflict) == ("en", ["x", "y"], False)
    assert got["b"].conflict


def test_snapshots(spark):
    df = spark.createDataFrame([("s", 1, "h1", "u"), ("s", 2, "h2", "u"), ("q", 1, "a", "u"), ("q", 1, "b", "v")], "id string, at int, h string, url string")
    got = {r.id: r for r in merge.merge_snapshots(df, "id", "at", "h", ["url"]).collect()}
    assert (got["s"].h, got["s"].same_time_conflict, got["s"].identity_conflict) == ("h2", False, False)
    assert got["q"].same_time_conflict and got["q"].identity_conflict


def book(**kw):
    base = dict.fromkeys(f.name for f in TABLES["books"].fields) | {"title": "T", "authors": ["A"], "language": "en", "topics": ["d", "t"]}
    return tuple((base | kw).values())


def test_validation_names_every_fault(spark):
    books = spark.createDataFrame([book(book_id="b1"), book(book_id="b2"), book(book_id="b1")], TABLES["books"])
    source = lambda i, b: (i, b, "p", "metadata_api", "u", None, None, None, None, "h", None)
    sources = spark.createDataFrame([source("s1", "b1"), source("s3", "b9")], TABLES["sources"])
    docs = spark.createDataFrame([("d1", "b2", "description", "x", None, "s1", "h", None), ("d2", "b1", "other", "x", None, "s7", "h", None)], TABLES["documents"])
    toc = spark.createDataFrame([("t1", "b1", None, 2, 0, None, "x", None, "s1"), ("t2", "b1", "t1", 5, 0, None, "x", None, "s1"), ("t3", "b1", "t4", 1, 0, None, "x", None, "s1"), ("t4", "b1", "t3", 2, 0, None, "x", None, "s1"), ("t5", "b1", "t0", 2, 0, None, "x", None, "s1")], TABLES["toc"])
    got = {(r.kind, r.id) for r in validation.validate_dataset(books, docs, toc, sources).collect()}
    expected = {("duplicate_book_id", "b1"), ("source_missing_book", "s3"), ("book_without_source", "b2"), ("document_foreign_source", "d1"), ("document_missing_source", "d2"), ("root_level", "t1"), ("child_level", "t2"), ("child_level", "t3"), ("toc_cycle", "t3"), ("toc_cycle", "t4"), ("toc_missing_parent", "t5")}
    assert expected <= got
    assert {k for k, _ in got} <= {k for k, _ in expected}


def test_empty_dataset_is_valid(spark):
    d = Dataset.empty(spark)
    assert validation.validate_dataset(d.books, d.documents, d.toc, d.sources).count() == 0


@pytest.mark.parametrize(("kind", "blob", "levels"), [
    ("numbered", "Part I Basics\n1 Start ... 3\n1.1 More\nfree text\nIndex", [1, 2, 3, 4, 1]),
    ("indented", "One\n  Two\n    Three\n  Four\nAppendix", [1, 2, 3, 2, 1]),
])
def test_outline_levels(kind, blob, levels):
    assert [e[1] for e in outlines.PARSERS[kind](blob)] == levels


def test_outline_lines():
    assert outlines.lines_of("<p>1 A&amp;B</p>2 C<br/> ") == ["1 A&B", "2 C"]
    assert outlines.split_label("Chapter 2. Trees ..... 45") == ("Chapter 2", "Trees")
