"""Raw responses to one canonical dataset, its merge with another, and enrichment from a bulk index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewright.functions.identity import stable_id
from tomewright.operators import joins, merge, validation
from tomewright.operators.outlines import outline_entries
from tomewright.plans.collection import Manifest, select_artifacts
from tomewright.plans.providers import NORMALIZERS, Topic
from tomewright.sources import dump, raw
from tomewright.sources.canonical import Dataset
from tomewright.sources.schemas import TABLES


#: Pairs of provider and topic in one build; each is a plan of its own.
MOST_PAIRS = 10_000


class DatasetError(ValueError):
    """A dataset that breaks its contract."""


def check(data: Dataset, most: int = 20) -> Dataset:
    """The dataset, persisted, or an error that names the first faults."""
    data = data.persisted()
    faults = validation.validate_dataset(data.books, data.documents, data.toc, data.sources).limit(most).collect()
    if faults:
        raise DatasetError("; ".join(f"{f.kind} {f.id} {f.detail or ''}".strip() for f in faults))
    return data


def merge_datasets(datasets: list[Dataset], preferences: DataFrame | None = None) -> Dataset:
    """One dataset of several: latest source snapshots, their records only, equal records once, topics united."""
    numbered = [{n: df.withColumn("__d", F.lit(k)) for n, df in d.tables().items()} for k, d in enumerate(datasets)]
    every = {n: reduce(DataFrame.unionByName, [d[n] for d in numbered]) for n in TABLES}
    identity = [c for c in TABLES["sources"].names if c not in ("source_id", "retrieved_at", "content_hash")]
    sources = merge.merge_snapshots(every["sources"], "source_id", "retrieved_at", "content_hash", identity, [F.col("__d")])
    chosen = sources.select("source_id", F.struct("retrieved_at", "content_hash").alias("__chosen"))
    local = every["sources"].select("source_id", "__d", F.struct("retrieved_at", "content_hash").alias("__own"))

    def current(df: DataFrame) -> DataFrame:
        rows = df.join(local, ["source_id", "__d"], "left").join(chosen, "source_id", "left")
        return rows.where("__own IS NULL OR __chosen IS NULL OR __own = __chosen").drop("__own", "__chosen")

    books = merge.merge_records(every["books"], "book_id", "__d", ["en_title", "en_subtitle"], ("topics",))
    docs = merge.merge_records(current(every["documents"]), "document_id", "__d", ["en_text"])
    toc = merge.merge_records(current(every["toc"]), "toc_entry_id", "__d", ["en_title"])
    bad = books.where("conflict").select(F.col("book_id").alias("id")).unionByName(docs.where("conflict").select(F.col("document_id").alias("id"))).unionByName(toc.where("conflict").select(F.col("toc_entry_id").alias("id")))
    bad = bad.unionByName(sources.where("same_time_conflict OR identity_conflict").select(F.col("source_id").alias("id")))
    if found := [r.id for r in bad.limit(20).collect()]:
        raise DatasetError(f"conflicting records: {', '.join(found)}")
    toc = toc.select(TABLES["toc"].names)
    if preferences is not None:
        toc = merge.preferred_sources(toc, preferences)
    return Dataset(books.select(TABLES["books"].names), docs.select(TABLES["documents"].names), toc, sources.select(TABLES["sources"].names))


def build(spark: SparkSession, folder: str, topics: dict[str, Topic], limit: int, latest: bool = True) -> Dataset:
    """All raw artifacts below a folder, normalized by provider and topic, and merged."""
    rows = raw.read_raw(spark, folder)
    if latest:
        rows = rows.join(raw.latest_artifacts(rows).select("path"), "path", "left_semi")
    pairs = [(r.provider, r.topic) for r in rows.select("provider", "topic").distinct().limit(MOST_PAIRS + 1).collect()]
    if len(pairs) > MOST_PAIRS:
        raise DatasetError(f"more than {MOST_PAIRS} pairs of provider and topic")
    out = []
    for provider, slug in sorted(pairs):
        if provider in NORMALIZERS and slug in topics:
            own = rows.where((F.col("provider") == provider) & (F.col("topic") == slug)).select(F.col("path").alias("response_id"), "topic", "retrieved_at", "response")
            out.append(NORMALIZERS[provider](own, topics[slug], limit)[0])
    return merge_datasets(out) if out else Dataset.empty(spark)


def build_manifest(spark: SparkSession, folder: str, topics: dict[str, Topic], manifest: Manifest) -> Dataset:
    """The manifest's responses only, each normalized up to its own limit; the books have to be those it expects."""
    rows = raw.read_raw(spark, folder)
    about = rows.select("provider", "topic", "requested_limit", F.try_variant_get("request_parameters", "$.source", "string").alias("source"), "content_hash", F.col("retrieved_at").cast("string").alias("retrieved_at"), "path")
    out = []
    for r in select_artifacts(about, manifest).select("provider", "topic", "requested_limit", "path").collect():  # a row for each selector
        provider = r.provider.replace("-", "_")
        if provider not in NORMALIZERS or r.topic not in topics:
            raise DatasetError(f"no normalizer for {r.provider}/{r.topic}")
        own = rows.where(F.col("path") == r.path).select(F.col("path").alias("response_id"), "topic", F.col("retrieved_at").cast("timestamp").alias("retrieved_at"), "response")
        out.append(NORMALIZERS[provider](own, topics[r.topic], r.requested_limit, **({"gate": True} if manifest.gate else {}))[0])
    data = merge_datasets(out)
    expected = spark.createDataFrame([(i,) for i in manifest.expected], "book_id string")
    wrong = joins.set_differences(expected, data.books, "book_id").limit(10).collect()
    if wrong:
        raise DatasetError("; ".join(f"{w.kind} {w.book_id}" for w in wrong))
    return data


def enrich_from_bulk(data: Dataset, index: str, dump_date: str) -> Dataset:
    """Outlines from the bulk index for books that have none; their sources carry the date of the dump."""
    lacking = joins.without_keys(data.books.where("isbn_13 IS NOT NULL OR isbn_10 IS NOT NULL"), data.toc, "book_id")
    targets = lacking.select("book_id", "title", "authors", F.coalesce("isbn_13", "isbn_10").alias("isbn"))
    found = dump.resolve(index, targets.select("isbn")).where("tier <> 'none'").join(targets, "isbn")
    exact = F.col("tier") == "exact_edition_toc"
    rows = found.withColumn("source_id", stable_id("source", F.lit("open_library_bulk"), F.col("edition_key"), F.col("book_id"), F.lit(dump_date)))
    text = F.to_json(F.struct("edition_key", "tier", "toc"))
    null = F.lit(None).cast("string")
    none = F.array().cast("array<string>")
    evidence = F.struct(
        F.lit("toc").alias("evidence_type"), F.col("tier"), F.col("isbn").alias("target_isbn"), F.col("title").alias("target_title"), F.col("authors").alias("target_authors"), F.col("edition_key").alias("source_edition_id"), none.alias("source_isbns"), null.alias("source_title"), none.alias("source_author_ids"),
        exact.alias("same_edition"), F.lit("bulk_dump").alias("source_document_type"), F.lit("bulk_index").alias("discovery_method"), F.array(F.when(exact, "exact_isbn").otherwise("same_work")).alias("match_basis"), F.lit("validated").alias("validation_status"),
    )
    sources = rows.select("source_id", "book_id", F.lit("open_library").alias("provider"), F.lit("bulk_dump").alias("source_type"), F.concat(F.lit("https://openlibrary.org"), "edition_key").alias("url"), F.col("edition_key").alias("external_id"), F.lit(dump_date).cast("timestamp").alias("retrieved_at"), null.alias("license"), null.alias("rights_note"), F.concat(F.lit("sha256:"), F.sha2(text, 256)).alias("content_hash"), evidence.alias("evidence"))
    entries = F.transform("toc", lambda x, i: F.struct(i.alias("pos"), x["level"].alias("level"), x["label"].alias("label"), x["title"].alias("title")))
    toc = outline_entries(rows.withColumn("entries", entries), "book_id", "source_id", "entries", clamp=False)
    return Dataset(data.books, data.documents, data.toc.unionByName(toc), data.sources.unionByName(sources))
