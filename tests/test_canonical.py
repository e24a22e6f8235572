"""Provider responses, canonical files, evidence records and the bulk index, on small invented data."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tomewright.plans import evidence, providers
from tomewright.sources import canonical, dump, raw

TOPIC = providers.Topic("operating-systems", "computer-science", r"operating\s+systems?", "robotics?")


def responses(spark, body, **more):
    df = spark.createDataFrame([("r1", "operating-systems", json.dumps(body))], "response_id string, topic string, body string")
    return df.select("response_id", "topic", F.lit("2026-09-01T00:00:00Z").cast("timestamp").alias("retrieved_at"), F.parse_json("body").alias("response"), *[F.lit(v).alias(k) for k, v in more.items()])


def volume(i, title="Operating Systems", lang="en", isbn="9780306406157", **info):
    return {"id": i, "volumeInfo": {"title": title, "language": lang, "authors": ["Ann Lee", "ann lee"], "publishedDate": "2001-05", "industryIdentifiers": [{"type": "ISBN_13", "identifier": isbn}], **info}}


def test_google_dedupes_before_the_limit(spark):
    body = {"items": [volume("a", description=" text "), volume("b"), volume("c", lang="de"), volume("d", isbn="9780131103627"), volume("e", isbn="9781861972712"), "junk"]}
    data, audit = providers.google_books(responses(spark, body), TOPIC, 2)
    assert [r.book_id for r in data.books.orderBy("book_id").collect()] == ["isbn13:9780131103627", "isbn13:9780306406157"]
    assert data.books.where("book_id like '%6157'").first().authors == ["Ann Lee"]
    reasons = {r.pos: r.reason for r in audit.select("pos", "reason").collect()}
    assert reasons == {0: None, 1: "duplicate", 2: "ineligible_candidate", 3: None, 4: "limit", 5: "invalid_provider_response"}
    assert data.documents.first().text == "text"
    assert data.sources.count() == 2


def test_paged_responses_keep_their_order(spark):
    body = {"pages": [{"request_parameters": {}, "response": {"items": [volume("a")]}}, {"request_parameters": {}, "response": {"items": [volume("b", isbn="9780131103627")]}}]}
    _, audit = providers.google_books(responses(spark, body), TOPIC, 5)
    assert [r.external_id for r in audit.orderBy("pos").collect()] == ["a", "b"]


def test_open_library_outline_and_gate(spark):
    doc = lambda k, title: {"key": f"/works/{k}", "title": title, "author_name": ["Ann Lee"], "first_publish_year": 1990, "editions": {"docs": [{"key": f"/books/{k}M", "title": title, "language": ["eng"], "isbn": ["0306406152", "9780306406157"] if k == "W1" else []}]}}
    body = {"docs": [doc("W1", "Operating Systems"), doc("W2", "Cooking"), {"key": "/works/W3", "title": "x", "editions": {"docs": []}}], "edition_details": {"/books/W1M": {"by_statement": "by Ann Lee and Bo Ek.", "table_of_contents": [{"level": 0, "title": "One"}, {"level": 1, "title": "Two"}, {"level": 3, "title": "Orphan"}, {"level": 0, "title": " "}]}}, "work_details": {"/works/W1": {"subjects": ["Operating systems"], "description": {"value": "About"}}}}
    data, audit = providers.open_library(responses(spark, body), TOPIC, 5, gate=True)
    assert {r.pos: r.reason for r in audit.collect()} == {0: None, 1: "no_topic_evidence", 2: "no_english_edition"}
    b = data.books.first()
    assert (b.book_id, b.authors, b.published_year) == ("isbn13:9780306406157", ["Ann Lee", "Bo Ek"], 1990)
    toc = {r.title: (r.level, r.parent_entry_id, r.order_index) for r in data.toc.collect()}
    assert set(toc) == {"One", "Two"} and toc["One"][1] is None and toc["Two"][0] == 2
    assert data.documents.first().text == "About"


def test_internet_archive_needs_matching_isbns(spark):
    body = {"response": {"docs": [{"identifier": "x", "title": ["Operating Systems"], "language": "eng", "isbn": ["080442957X", "9780306406157", "0306406152"], "creator": "Lee, Ann", "year": 1999}]}}
    b = providers.internet_archive(responses(spark, body), TOPIC, 5)[0].books.first()
    assert (b.isbn_10, b.isbn_13, b.authors, b.published_year) == ("0306406152", "9780306406157", ["Lee, Ann"], 1999)


def test_national_library_reasons(spark):
    row = lambda **kw: {"EA_ISBN": "9780306406157", "TITLE": "Operating systems", **kw}
    body = {"docs": [row(), row(), row(EA_ISBN="1"), row(TITLE=""), row(TITLE="Art"), row(TITLE="operating system robotics"), row(EA_ISBN="9780131103627", EBOOK_YN="Y")]}
    data, audit = providers.national_library(responses(spark, body), TOPIC, 5)
    assert [r.reason for r in audit.orderBy("pos").collect()] == [None, "duplicate", "missing_valid_isbn", "missing_title", "no_topic_evidence", "conflicting_subject", "conflicting_book_kind"]
    assert data.books.first().language == "und"


def test_yes24_and_hathitrust(spark):
    item = {"itemId": 7, "title": "Operating Systems", "author": "Ann, Bo", "isbn13": "9780306406157", "isbn10": "080442957X", "publishDate": "20200101", "goodsSortNm": "IT", "contentDetail": {"tableOfContents": "1장 A<br>1.1 B<br>2장 C"}}
    data, _ = providers.yes24(responses(spark, {"data": {"items": [item, item | {"itemId": True}]}}), TOPIC, 5)
    b = data.books.first()
    assert (b.isbn_10, b.published_year, b.authors) == (None, 2020, ["Ann", "Bo"]) and data.toc.count() == 3
    got = providers.hathitrust(responses(spark, {"isbn:1": {"records": {"9": {}, "10": {}}, "items": [{"rightsCode": "pd"}, {"rightsCode": "ic"}, {"rightsCode": "pd"}]}}, book_id="b")).first()
    assert (got.external_id, got.rights_note) == ("10", "rights codes: ic, pd")


@pytest.fixture(scope="module")
def small(spark):
    data, _ = providers.google_books(responses(spark, {"items": [volume("a", description="About"), volume("d", isbn="9780131103627")]}), TOPIC, 5)
    return canonical.Dataset(**{n: spark.createDataFrame(df.collect(), df.schema) for n, df in data.tables().items()})  # no long plan behind it


def test_files_round_trip_and_are_strict(spark, small, tmp_path):
    folder = f"file://{tmp_path}/d"
    assert not canonical.dataset_exists(spark, folder)
    canonical.write_dataset(small, folder)
    canonical.write_dataset(small, folder)
    assert canonical.dataset_exists(spark, folder)
    back = canonical.read_dataset(spark, folder)
    assert sorted(map(str, back.books.collect())) == sorted(map(str, small.books.collect()))
    assert sorted(map(str, back.sources.collect())) == sorted(map(str, small.sources.collect()))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/books.jsonl").write_text('{"book_id":"b","surprise":1}\n\n')
    with pytest.raises(Exception, match="unknown field"):
        canonical.read_table(spark, f"file://{tmp_path}/bad", "books").collect()
    with pytest.raises(ValueError, match="incomplete"):
        canonical.dataset_exists(spark, f"file://{tmp_path}/bad")


@pytest.mark.parametrize("version", evidence.VERSIONS)
def test_evidence_export(small, version):
    out = evidence.export_evidence(small, version)
    kinds = {r.book_id: [e["item"]["evidence_type"] for e in r.evidence] for r in out.collect()}
    assert kinds["isbn13:9780306406157"] == ["metadata_minimal", "subject", "subject", "description"]
    assert evidence.validate_evidence(out, small, version).count() == 0
    assert {r.evidence_type: r.items for r in evidence.summary(out).collect()}["subject"] == 4
    assert out.count() == evidence.evidence_lines(out, version).count()


def test_audit(small):
    got = {r.book_id: r for r in evidence.audit_selection(small, "operating-systems", r"operating systems?").collect()}
    one = got["isbn13:9780306406157"]
    assert one.findings == ["no_prose", "no_toc"] and one.status == "evidence_present" and one.evidence_state == "description_only"
    assert got["isbn13:9780131103627"].status == "metadata_only"


def test_raw_artifacts_are_verified(spark, tmp_path):
    body = {"b": [1, {"z": None, "a": "é"}], "a": True}
    text = json.dumps(body, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    import hashlib

    art = {"schema_version": 1, "provider": "p", "topic": "t", "requested_limit": 5, "retrieved_at": "2026-09-01T00:00:00Z", "request_parameters": {}, "response": body, "content_hash": "sha256:" + hashlib.sha256(text.encode()).hexdigest()}
    (tmp_path / "a.json").write_text(json.dumps(art))
    assert raw.read_raw(spark, f"file://{tmp_path}").count() == 1
    assert raw.latest_artifacts(raw.read_raw(spark, f"file://{tmp_path}")).first().path.endswith("a.json")
    (tmp_path / "b.json").write_text(json.dumps(art | {"response": {}}))
    with pytest.raises(Exception, match="content hash differs"):
        raw.read_raw(spark, f"file://{tmp_path}").collect()
    assert raw.without_credentials({"key": 1, "x": [{"api_key": 2, "y": 3}]}) == {"x": [{"y": 3}]}


def test_bulk_index_and_resolution(spark, tmp_path):
    toc = [{"level": 0, "title": t} for t in ("One", "Two", "Three")]
    ed = lambda k, **kw: {"key": f"/books/{k}", "title": "Systems", "works": [{"key": "/works/W1"}], "languages": [{"key": "/languages/eng"}], **kw}
    rows = [ed("E1", isbn_13=["9780306406157"], publish_date="2001"), ed("E2", table_of_contents=toc, publish_date="1999"), ed("E3", table_of_contents=toc, publish_date="2000", title="Systems"), ed("E4", title="Systems solutions manual", table_of_contents=toc), ed("E5", title="Other", works=[{"key": "/works/W2"}], isbn_13=["9780131103627"], table_of_contents=toc), {"key": "/books/E6", "title": "Far", "works": [{"key": "/works/W9"}]}]
    with gzip.open(tmp_path / "e.txt.gz", "wt") as f:
        f.writelines(f"/type/edition\t{r['key']}\t1\t2026-01-01\t{json.dumps(r)}\n" for r in rows)
    targets = spark.createDataFrame([("9780306406157",), ("9780131103627",), ("9781861972712",)], "isbn string")
    source = dump.read_dump(spark, f"file://{tmp_path}/e.txt.gz", "/type/edition", partitions=4)
    dump.build_index(source, f"file://{tmp_path}/index", targets=targets)
    assert spark.read.parquet(f"file://{tmp_path}/index/editions").count() == 5
    got = {r.isbn: (r.tier, r.edition_key) for r in dump.resolve(f"file://{tmp_path}/index", targets).collect()}
    assert got == {"9780306406157": ("same_work_alternate_edition_toc", "/books/E3"), "9780131103627": ("exact_edition_toc", "/books/E5"), "9781861972712": ("none", None)}
    assert dump.read_dump(spark, f"file://{tmp_path}/e.txt.gz", "/type/edition", needles=["9780306406157"]).count() == 1
    with pytest.raises(Exception, match="malformed"):
        dump.read_dump(spark, f"file://{tmp_path}/e.txt.gz", "/type/work").collect()
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        dump.build_index(source, f"file://{tmp_path}/index", targets=targets)


def test_digests_of_small_and_of_large_files(spark, tmp_path, monkeypatch):
    import hashlib

    from tomewright.sources import raw

    bodies = {"a.gz": b"x" * 10, "b.gz": b"y" * 5000, "c.gz": b""}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    monkeypatch.setattr(raw, "HASHED_BYTES", 100)  # b.gz is read as a stream
    wanted = hashlib.sha1(bodies["b.gz"]).hexdigest()
    rows = {r.path.rpartition("/")[2]: r for r in raw.verify_files(spark, f"file://{tmp_path}", wanted.upper()).collect()}
    assert {n: r.sha1 for n, r in rows.items()} == {n: hashlib.sha1(b).hexdigest() for n, b in bodies.items() if b}  # empty files have no row
    assert {n for n, r in rows.items() if r.ok} == {"b.gz"}
    assert {r.length for r in raw.verify_files(spark, f"file://{tmp_path}", size=10).where("ok").collect()} == {10}
