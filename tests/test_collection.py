"""Scopes of searches, manifests, book subsets, evidence files and trees, against plain versions."""

import hashlib
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tomewright.functions import text as X
from tomewright.operators import joins, tree
from tomewright.plans import build, collection, reports, scope
from tomewright.plans.providers import Topic
from tomewright.sources import dump
from tomewright.sources.canonical import Dataset
from tomewright.sources.schemas import TABLES

REGISTRY = {
    "linear-algebra": {"name": "선형대수", "aliases": ["선형 대수", "Linear Algebra"], "korean_query": "선형대수학", "english_query": "linear algebra", "evidence_pattern": r"\blinear algebra\b", "korean_evidence_pattern": "선형", "domain": "mathematics"},
    "logic": {"name": "논리", "aliases": ["논리학"], "korean_query": "논리학", "english_query": "logic", "evidence_pattern": "logic", "korean_evidence_pattern": "논리", "domain": "philosophy"},
}
TOPICS = {"optics": Topic("optics", "physics", r"\boptic", extra={"title": "Optics", "korean_query": "광학"})}


def test_names_of_fields():
    assert scope.resolve_field(REGISTRY, "ＬＩＮＥＡＲ　algebra") == "linear-algebra" and scope.resolve_field(REGISTRY, "선형대수") == "linear-algebra"
    assert scope.resolve_field(REGISTRY, "topology") is None
    with pytest.raises(ValueError, match="several"):
        scope.resolve_field(REGISTRY | {"x": REGISTRY["logic"]}, "논리학")


def test_scopes_of_queries():
    one = scope.query_scope("linear  algebra", "국내도서-대학교재", REGISTRY, TOPICS)
    assert (one.subject, one.basis, one.book_kind, one.audience, one.status) == ("linear-algebra", "reviewed_alias", "textbook", None, "ready")
    assert scope.open_library_query(one, "key", 99) == {"q": '(subject:"linear algebra" OR title:"linear algebra") AND language:eng AND subject:textbooks', "fields": "key,subject", "limit": 30}
    two = scope.query_scope("광학", "국내도서-어린이", REGISTRY, TOPICS)
    assert (two.english_query, two.basis, two.audience) == ("Optics", "reviewed_topic", "children")
    three = scope.query_scope("game theory", "국내도서-경제 경영", REGISTRY, TOPICS)
    assert three.basis == "literal_english" and three.category_pattern and scope.google_books_query(three, 0)["maxResults"] == 1
    assert scope.query_scope("game theory", "국내도서-경제 경영-금융", REGISTRY, TOPICS).status == "unmapped_category"
    bare = scope.query_scope("요리", "국내도서-인문", REGISTRY, TOPICS)
    assert bare.status == "unmapped_language"
    with pytest.raises(ValueError, match="unmapped_language"):
        scope.google_books_query(bare)
    assert scope.field_scope(REGISTRY, "logic").status == "ready" and scope.candidate_limit("google_books", 5) == 5 and scope.candidate_limit("yes24", 5) == 20


def test_topics_of_searches():
    t = scope.literal_topic("  Game   theory", "국내도서-경제 경영")
    assert t.slug == scope.literal_topic("game theory", "국내도서-경제 경영").slug and t.slug.startswith("search-") and len(t.slug) == 27
    assert t.pattern == r"(?i)(?<![a-z0-9])Game\s*theory(?![a-z0-9])" and scope.is_browsing(t, {})
    assert scope.is_browsing(scope.field_topic(REGISTRY, "logic"), REGISTRY) and not scope.is_browsing(TOPICS["optics"], REGISTRY)
    assert not scope.is_browsing(Topic("field-logic", "other", "logic"), REGISTRY)
    for query, category in (("x", "국내도서-a"), ("!!", "국내도서-a"), ("ok", "외국도서-a"), ("ok", "국내도서"), ("ok", "국내도서- ")):
        with pytest.raises(ValueError):
            scope.literal_topic(query, category)


def test_open_library_scope_audit(spark):
    edition = lambda k, isbn: {"key": f"/books/{k}", "title": f"Logic {k}", "language": ["eng"], "isbn": isbn}
    docs = [
        {"key": "/works/a", "subject": ["logic", "fiction"], "editions": {"docs": [edition("a", ["9780306406157"])]}},
        {"key": "/works/b", "subject": ["logic"], "editions": {"docs": [edition("b", ["9780306406157"])]}},
        {"key": "/works/c", "subject": [], "editions": {"docs": [edition("c", ["9780306406157"])]}},
        {"key": "/works/d", "subject": ["logic"], "editions": {"docs": [edition("d", ["1"])]}},
        {"key": "/works/e", "subject": ["logic"], "editions": {"docs": []}},
    ]
    rows = spark.createDataFrame([("r", "t", json.dumps({"docs": docs}))], "response_id string, topic string, body string").select("response_id", "topic", F.lit("2026-01-01").cast("timestamp").alias("retrieved_at"), F.parse_json("body").alias("response"))
    data, audit = scope.audit_response(rows, scope.field_scope(REGISTRY, "logic"), scope.literal_topic("logic", "국내도서-인문"), 5, "open_library")
    got = {r.pos: (r.included, r.reason) for r in audit.collect()}
    assert got == {0: (False, "conflicting_book_kind"), 1: (True, "matching_subject"), 2: (False, "normalization_or_limit"), 3: (False, "missing_valid_isbn"), 4: (False, "no_english_edition")}
    assert data.books.count() == 1
    with pytest.raises(ValueError, match="registered"):
        scope.audit_response(rows, scope.field_scope(REGISTRY, "logic"), TOPICS["optics"], 5, "open_library")


def test_manifests(spark):
    rows = spark.createDataFrame([("open-library", "a", 5, None, "h1", "2026-01-01", "p1"), ("open-library", "a", 5, None, "h2", "2026-01-02", "p2"), ("page", "a", 1, "s", "h3", "2026-01-01", "p3")], "provider string, topic string, requested_limit int, source string, content_hash string, retrieved_at string, path string")
    S, M = collection.Selector, collection.Manifest
    got = collection.select_artifacts(rows, M((S("open-library", "a", 5), S("open-library", "a", 5, content_hash="h1"), S("page", "a", 1, "s")), ("b",)))
    assert sorted((r.selector, r.path) for r in got.collect()) == [(0, "p2"), (1, "p1"), (2, "p3")]
    with pytest.raises(ValueError, match="no raw artifact"):
        collection.select_artifacts(rows, M((S("page", "z", 1),), ("b",)))
    for bad in (((), ("b",), None), ((S("p", "a", 1),) * 2, ("b",), None), ((S("p", "a", 1),), ("b", "b"), None), ((S("p", "a", 1),), ("b",), collection.GATE)):
        with pytest.raises(ValueError):
            M(*bad)


def small(spark, ids):
    books = spark.createDataFrame([(i, None, None, f"T {i}", None, None, None, [], None, None, "en", ["d", "t"]) for i in ids], TABLES["books"])
    empty = Dataset.empty(spark)
    return Dataset(books, empty.documents, empty.toc, empty.sources)


def test_book_subsets_and_rebuilds(spark):
    data = small(spark, ["c", "a", "b"])
    ids = lambda d: sorted(r.book_id for r in d.books.collect())
    assert ids(collection.select_books(data, limit=2)) == ["a", "b"] and ids(collection.select_books(data, ["c", "b"])) == ["b", "c"]
    for bad in ({"ids": ["a", "a"]}, {"ids": ["z"]}, {"limit": 0}):
        with pytest.raises(ValueError):
            collection.select_books(data, **bad)
    assert collection.rebuilds_alike(lambda: small(spark, ["a", "b"]))
    names = iter((["a", "b"], ["a", "c"]))
    assert not collection.rebuilds_alike(lambda: small(spark, next(names)))


def test_evidence_files_by_version(spark, tmp_path):
    known = {1: "book-evidence-v1", 2: "book-evidence-v2"}
    good = [json.dumps({"contract_version": "book-evidence-v1", "book": {"book_id": "a"}}), "", json.dumps({"schema_version": 2, "contract_version": "book-evidence-v2", "book": {"book_id": "b"}})]
    (tmp_path / "good").write_text("\n".join(good))
    assert sorted((r.book_id, r.schema_version) for r in collection.read_evidence(spark, str(tmp_path / "good"), known).select("book_id", "schema_version").collect()) == [("a", 1), ("b", 2)]
    for bad in ('{"schema_version": 2, "contract_version": "book-evidence-v1"}', "[1]", "no json", '{"schema_version": 9, "contract_version": "x"}'):
        (tmp_path / "bad").write_text(bad)
        with pytest.raises(PySparkException, match="known contract"):
            collection.read_evidence(spark, str(tmp_path / "bad"), known).select(F.to_json("record")).collect()


def test_retries():
    assert collection.is_transient(429) and collection.is_transient(503) and collection.is_transient(None, timed_out=True) and not collection.is_transient(404) and not collection.is_transient(None)


def test_cycles_and_paths_against_walking(spark):
    rng = random.Random(3)
    for n, share in ((60, 0.8), (200, 1.0), (40, 0.0)):
        up = {i: rng.randrange(n + 3) if rng.random() < share else None for i in range(n)}  # some parents are missing
        chain = dict(up) | {1000 + i: (1000 + i - 1 if i else None) for i in range(90)}
        rows = spark.createDataFrame([(i, u, f"t{i}") for i, u in chain.items()], "id long, up long, label string")
        cyclic, paths = set(), {}
        for i in chain:
            seen, at = [], i
            while at is not None and at in chain and at not in seen:
                seen.append(at)
                at = chain[at]
            if at == i and seen:
                cyclic.add(i)
            if at is None:
                paths[i] = (len(seen), "/".join(f"t{x}" for x in reversed(seen)))
        assert {r.id for r in tree.parent_cycles(rows, "id", "up").collect()} == cyclic
        assert {r.id: (r.depth, r.path) for r in tree.tree_paths(rows, "id", "up", "label", "/").collect()} == paths


def test_nearest_alternate_equals_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(4), rng.randrange(12)) for i in range(120)] + [(500, 9, 1)]
    got = {r.k: (r.cost, r.alternate) for r in joins.nearest_alternate(spark.createDataFrame(rows, "k long, g long, v long"), "k", ["g"], "v").collect()}
    want = {}
    for k, g, v in rows:
        others = [(abs(v - w), j) for j, h, w in rows if h == g and j != k]
        if others:
            want[k] = min(others)
    assert got == want


def test_the_target_is_the_first_edition_that_is_no_supplement(spark):
    def line(key, title, work, n, isbn="9780306406157"):
        toc = [{"level": 0, "title": f"C{i}"} for i in range(n)]
        return "\t".join(["/type/edition", key, "1", "t", json.dumps({"key": key, "title": title, "works": [{"key": work}], "isbn_13": [isbn], "table_of_contents": toc})])

    lines = [line("/books/A", "Study Guide to Logic", "/works/X", 9), line("/books/B", "Logic", "/works/Y", 0), line("/books/C", "Logic", "/works/Z", 0), line("/books/D", "Logic", "/works/Y", 4, "9780131103627"), line("/books/E", "Logic", "/works/Z", 8, "9781861972712")]
    rows = dump.editions(dump.parse_dump(spark.createDataFrame([(x,) for x in lines], "value string"), "/type/edition"))
    got = dump.resolve_tables(rows, dump.isbns(rows), spark.createDataFrame([("9780306406157",)], "isbn string")).first()
    assert (got.tier, got.target_edition, got.edition_key) == ("same_work_alternate_edition_toc", "/books/B", "/books/D")
    more = dump.editions(dump.parse_dump(spark.createDataFrame([(x,) for x in [*lines, line("/books/F", "Logic", "/works/Y", 3)]], "value string"), "/type/edition"))
    got = dump.resolve_tables(more, dump.isbns(more), spark.createDataFrame([("9780306406157",)], "isbn string")).first()
    assert (got.tier, got.target_edition, got.edition_key) == ("exact_edition_toc", "/books/B", "/books/F")


def test_reviews_and_scale_reports(spark):
    first = spark.createDataFrame([("t", "a", "T a"), ("t", "b", "T b")], "topic string, book_id string, title string")
    second = spark.createDataFrame([("t", "b", "T b"), ("t", "c", "T c")], "topic string, book_id string, title string")
    sheet = reports.review_sheet(first, second, spark.createDataFrame([("t", "T a", "no_topic_evidence")], "topic string, title string, reason string"))
    filled = sheet.withColumn("relevant", F.when(F.col("book_id") == "c", "no").otherwise("yes"))
    got = {n: sorted((r.book_id, r.relevant) for r in d.collect()) for n, d in reports.finalize_review(first, second, filled).items()}
    assert got == {"first": [("a", True), ("b", True)], "second": [("b", True), ("c", False)]}
    for bad in (sheet, filled.where("book_id <> 'a'"), filled.union(filled)):
        with pytest.raises(ValueError):
            reports.finalize_review(first, second, bad)
    rows = {(r.section, r.key): r.value for r in reports.scale_report(small(spark, ["a", "b"])).collect()}
    assert rows["coverage", "all/books"] == 2 and rows["missing", "toc"] == 2 and rows["warning", "missing_toc"] == 2 and rows["errors", "book_without_source"] == 2 and rows["year", "unknown"] == 2


def test_builds_from_a_manifest(spark, tmp_path):
    def put(name, at, titles):
        items = [{"id": t, "volumeInfo": {"title": t, "language": "en", "authors": ["Ann"]}} for t in titles]
        response = {"items": items}
        body = {"schema_version": 1, "provider": "google-books", "topic": "t", "requested_limit": 2, "retrieved_at": at, "request_parameters": {}, "response": response}
        own = "sha256:" + hashlib.sha256(json.dumps(response, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        (tmp_path / "google_books" / "t").mkdir(parents=True, exist_ok=True)
        (tmp_path / "google_books" / "t" / name).write_text(json.dumps(body | {"content_hash": own}))

    put("1.json", "2026-01-01T00:00:00Z", ["Old"])
    put("2.json", "2026-01-02T00:00:00Z", ["New", "Next", "Beyond"])
    ids = ["book_" + hashlib.sha256(f"{t}\x1fann".encode()).hexdigest()[:20] for t in ("new", "next")]
    selector = (collection.Selector("google-books", "t", 2),)
    data = build.build_manifest(spark, str(tmp_path), {"t": Topic("t", "d", "x")}, collection.Manifest(selector, tuple(ids)))
    assert sorted(r.title for r in data.books.collect()) == ["New", "Next"]
    with pytest.raises(build.DatasetError, match="unexpected"):
        build.build_manifest(spark, str(tmp_path), {"t": Topic("t", "d", "x")}, collection.Manifest(selector, (ids[0],)))


def test_plain_and_other_texts_alike(spark):
    rng = random.Random(1)
    values = [None, "", "  ", "C++ & C#", "a\x1cb\x85c", "É ß Ｂ", "<p>a</p>b", "&amp; x", "A\t\nB", *("".join(rng.choice("aB+# .é<>&p/\x0b") for _ in range(9)) for _ in range(300))]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", X.bibliographic_key(F.col("v")).alias("a"), X.name_key(F.col("v")).alias("b"), X.html_text(F.col("v")).alias("c")).collect()
    for r in rows:
        v = values[r.i]
        assert (r.a, r.b) == (X.bibliographic(v), X.name_form(v)), v
        assert r.c == (None if v is None else "\n".join(t for _, t in X.html_blocks(v))) or v is None, v
