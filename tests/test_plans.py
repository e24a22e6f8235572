"""Merging, building, enrichment, translation and reports over small invented datasets."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_canonical import TOPIC, responses, small, volume  # noqa: F401
from tomewright.plans import build, english, providers, reports
from tomewright.sources.canonical import Dataset
from tomewright.streaming.latest import keep_latest


def local(df):
    """The rows without the plan behind them."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_merge_unites_topics_and_checks(spark, small):  # noqa: F811
    other = Dataset(small.books.withColumn("topics", F.array(F.lit("x"), F.lit("y"))).withColumn("en_title", F.lit("T")), small.documents, small.toc, small.sources)
    got = Dataset(**{n: local(df) for n, df in build.merge_datasets([small, other]).tables().items()})
    assert build.check(got).books.count() == 2
    b = got.books.orderBy("book_id").first()
    assert b.topics == ["computer-science", "operating-systems", "x", "y"] and b.en_title == "T"
    assert got.books.count() == 2 and got.sources.count() == 2 and got.documents.count() == 1
    with pytest.raises(build.DatasetError, match="conflicting"):
        build.merge_datasets([small, Dataset(small.books.withColumn("title", F.lit("other")), small.documents, small.toc, small.sources)])
    with pytest.raises(build.DatasetError, match="book_without_source"):
        build.check(Dataset(small.books, small.documents.limit(0), small.toc, small.sources.limit(0)))


def test_build_from_raw(spark, tmp_path, monkeypatch):
    import hashlib

    body = {"items": [volume("a")]}
    text = json.dumps(body, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    art = {"schema_version": 1, "provider": "google_books", "topic": TOPIC.slug, "requested_limit": 5, "retrieved_at": "2026-09-01T00:00:00Z", "request_parameters": {}, "response": body, "content_hash": "sha256:" + hashlib.sha256(text.encode()).hexdigest()}
    (tmp_path / "a.json").write_text(json.dumps(art))
    monkeypatch.setattr(build, "merge_datasets", lambda sets: sets[0])  # tested above
    assert build.build(spark, f"file://{tmp_path}", {TOPIC.slug: TOPIC}, 5).books.count() == 1


def test_translation_round(spark, small):  # noqa: F811
    korean = Dataset(small.books.withColumn("title", F.lit("운영체제")), small.documents, small.toc, small.sources)
    data = english.copy_english(korean)
    assert data.books.where("en_title IS NOT NULL").count() == 0 and data.documents.first().en_text == "About"
    pieces = local(english.requests(english.items(data, 3), 100))
    none = spark.createDataFrame([], "request_hash string, at string, en string")
    answers = local(english.translate(pieces, none, lambda xs: [f"part{len(x)}" for x in xs]))
    done = english.apply(data, pieces, answers)
    assert {r.en_title for r in done.books.collect()} == {"part3\npart1"}
    assert english.translate(pieces, answers).count() == answers.count()
    assert english.translate(pieces, none, lambda xs: xs).count() == 0
    assert english.translate(pieces, none, lambda xs: 1 / 0).count() == 0


def test_reports(spark, small):  # noqa: F811
    got = {r.topic: r for r in reports.topic_coverage(small).collect()}
    assert (got[None].books, got[None].with_description, got["operating-systems"].with_toc) == (2, 1, 0)
    assert {r.field: r.books for r in reports.missing_fields(small).collect()}["toc"] == 2
    assert reports.integrity(small).count() == 0
    attempts = spark.createDataFrame([("isbn13:9780306406157", 1, "old"), ("isbn13:9780306406157", 2, "no_product")], "book_id string, at int, outcome string")
    reasons = {r.book_id: r.reason for r in reports.missing_toc_reason(reports.book_coverage(small), attempts).collect()}
    assert sorted(reasons.values()) == ["no_product", "not_attempted"]
    pick = small.books.select(F.element_at("topics", -1).alias("topic"), "book_id", "title")
    labels = pick.select("topic", "book_id", F.lit("yes").alias("relevant"))
    row = reports.compare(pick, pick, labels, labels.limit(1)).first()
    assert (row["first"], row["second"], row["change"]) == (1.0, None, None)
    rejected = spark.createDataFrame([("operating-systems", "Operating Systems", "limit")], "topic string, title string, reason string")
    assert {r.reason for r in reports.review_sheet(pick, pick.limit(1), rejected).collect()} == {"limit"}


def test_latest_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = lambda n, at: "".join(json.dumps({"k": k, "at": at, "v": f"{k}{at}"}) + "\n" for k in range(n))
    for number, (n, at) in enumerate([(3, 1), (2, 5)]):
        (tmp_path / f"in/{number}.json").write_text(rows(n, at))
        stream = spark.readStream.schema("k int, at int, v string").json(str(tmp_path / "in"))
        keep_latest(stream, ["k"], ["at"], str(tmp_path / "check"), str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out/v1"))
    assert sorted(r.v for r in got.collect()) == ["05", "15", "21"]
