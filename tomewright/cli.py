"""Command line over the plans: build, merge, report, compare, audit, export, and the bulk index. Nothing is fetched."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tomewright.plans import build, collection, evidence, reports
from tomewright.plans.providers import Topic
from tomewright.sources import canonical, dump, raw


def topics(path: str) -> dict[str, Topic]:
    """A topic registry; a repeated key is an error."""

    def unique(pairs):
        keys = [k for k, _ in pairs]
        if len(set(keys)) < len(keys):
            raise ValueError(f"repeated key in {path}")
        return dict(pairs)

    with open(path, encoding="utf-8") as f:
        found = json.load(f, object_pairs_hook=unique)
    return {slug: Topic(slug, t["domain"], t["relevance_term_pattern"], t.get("conflicting_subjects_pattern"), t.get("korean_allowed_category_pattern"), extra=t) for slug, t in found.items()}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tomewright", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    add = lambda name, *args: [(p := sub.add_parser(name)), *[p.add_argument(a, **({"nargs": "?"} if a.startswith("[") else {})) for a in args]]
    add("build", "raw", "topics", "target")
    add("merge", "first", "second", "target")
    add("validate", "dataset")
    add("report", "dataset")
    add("audit-selection", "dataset", "topics", "topic", "target")
    add("export-ml-evidence", "dataset", "version", "target")
    add("verify-dump", "path", "sha1")
    add("build-index", "dump", "targets", "index")
    add("resolve", "index", "targets", "target")
    add("enrich-bulk", "dataset", "index", "date", "target")
    add("build-manifest", "raw", "topics", "manifest", "target")
    add("report-scale", "raw", "topics", "manifest", "target")
    add("compare-scale", "first", "second", "first_labels", "second_labels")
    add("prepare-relevance-review", "first", "second", "rejected", "target")
    add("finalize-relevance-review", "first", "second", "review", "target")
    add("inspect-index", "index", "targets")
    add("report-toc-acquisition", "before", "after")
    add("enrich-toc", "dataset", "sources", "attempts")
    add("bulk-status", "dataset", "index")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    data = canonical.read_dataset(spark, a.dataset) if hasattr(a, "dataset") else None
    if a.command == "build":
        canonical.write_dataset(build.check(build.build(spark, a.raw, topics(a.topics), 100)), a.target)
    elif a.command == "merge":
        both = [canonical.read_dataset(spark, x) for x in (a.first, a.second)]
        canonical.write_dataset(build.check(build.merge_datasets(both)), a.target)
    elif a.command == "validate":
        build.check(data)
    elif a.command == "report":
        print(reports.text_report(reports.topic_coverage(data).orderBy("topic"), ["topic", "books", "with_isbn", "with_description", "with_toc"]))
    elif a.command == "audit-selection":
        t = topics(a.topics)[a.topic]
        rows = evidence.audit_selection(data, t.slug, t.pattern, t.conflict)
        canonical.write_csv(rows.withColumn("findings", F.array_join("findings", " ")), a.target)
    elif a.command == "export-ml-evidence":
        lines = evidence.evidence_lines(evidence.export_evidence(build.check(data), a.version), a.version)
        lines.repartitionByRange("book_id").sortWithinPartitions("book_id").select("value").write.mode("errorifexists").text(a.target)
    elif a.command == "verify-dump":
        rows = raw.verify_files(spark, a.path, a.sha1).select("ok").collect()
        return int(not rows or not all(r.ok for r in rows))
    elif a.command == "build-index":
        dump.build_index(dump.read_dump(spark, a.dump, "/type/edition", partitions=spark.sparkContext.defaultParallelism * 4), a.index, targets=spark.read.text(a.targets).select(F.trim("value").alias("isbn")))
    elif a.command == "resolve":
        dump.resolve(a.index, spark.read.text(a.targets).select(F.trim("value").alias("isbn"))).write.mode("errorifexists").parquet(a.target)
    elif a.command == "enrich-bulk":
        canonical.write_dataset(build.check(build.enrich_from_bulk(data, a.index, a.date)), a.target)
    elif a.command in ("build-manifest", "report-scale"):
        with open(a.manifest, encoding="utf-8") as f:
            m = json.load(f)
        wanted = collection.Manifest(tuple(collection.Selector(**s) for s in m["raw_artifacts"]), tuple(m["expected_book_ids"]), m.get("relevance_gate"))
        make = lambda: build.build_manifest(spark, a.raw, topics(a.topics), wanted)
        found = build.check(make())
        if a.command == "build-manifest":
            canonical.write_dataset(found, a.target)
        else:
            if not collection.rebuilds_alike(make):
                raise ValueError("two builds differ")
            report = reports.scale_report(found)
            report.coalesce(1).write.mode("errorifexists").json(a.target)
    elif a.command == "compare-scale":
        read = lambda p: spark.read.option("header", True).csv(p)
        print(reports.text_report(reports.compare(read(a.first), read(a.second), read(a.first_labels), read(a.second_labels)).orderBy("topic"), ["topic", "first", "second", "change"]))
    elif a.command == "prepare-relevance-review":
        read = lambda p: spark.read.option("header", True).csv(p)
        canonical.write_csv(reports.review_sheet(read(a.first), read(a.second), read(a.rejected)).orderBy("topic", "book_id"), a.target)
    elif a.command == "finalize-relevance-review":
        read = lambda p: spark.read.option("header", True).csv(p)
        for name, rows in reports.finalize_review(read(a.first), read(a.second), read(a.review)).items():
            canonical.write_csv(rows.orderBy("topic", "book_id"), f"{a.target}/{name}")
    elif a.command == "inspect-index":
        rows = dump.inspect_tables(spark.read.parquet(f"{a.index}/editions"), spark.read.parquet(f"{a.index}/isbns"), spark.read.text(a.targets).select(F.trim("value").alias("isbn")))
        print(reports.text_report(rows.orderBy("isbn"), rows.columns))
    elif a.command == "report-toc-acquisition":
        rows = collection.enrichment_outcome(canonical.read_dataset(spark, a.before), canonical.read_dataset(spark, a.after))
        print(reports.text_report(rows.groupBy("outcome").count().orderBy("outcome"), ["outcome", "count"]))
    elif a.command == "enrich-toc":
        rows = spark.read.option("header", True).csv(a.sources).withColumn("priority", F.col("priority").cast("int"))
        print(reports.text_report(collection.enrichment_plan(rows, data, int(a.attempts)), ["priority", "slug", "book_id", "topic"]))
    elif a.command == "bulk-status":
        isbns = data.books.select(F.coalesce("isbn_13", "isbn_10").alias("isbn")).where("isbn IS NOT NULL")
        print(reports.text_report(dump.resolve(a.index, isbns).groupBy("tier").count().orderBy("tier"), ["tier", "count"]))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
