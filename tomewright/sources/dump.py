"""Bulk catalog dumps: five tab-separated columns with JSON, an index of works, editions and ISBNs, and resolution of outlines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tomewright.functions import identity as I
from tomewright.functions import text as X
from tomewright.operators.decisions import is_supplement

ENTRY = "struct<level:int,label:string,title:string,pagenum:string>"
#: Markers of supplements to a book.
SUPPLEMENTS = ("solution manual", "solutions manual", "study guide", "instructor", "test bank", "workbook", "lab manual", "companion", "supplement")


def candidate_pattern(identifier: str) -> str:
    """A pattern for an identifier with optional spaces or hyphens between its characters."""
    return r"[\s-]?".join("[xX]" if c in "xX" else re.escape(c) for c in identifier)


def read_dump(spark: SparkSession, path: str, expected: str, needles: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """(key, revision, record) of every line. A gzip is one split, so partitions deals its lines out for what follows.

    needles: only lines with one of these identifiers are parsed at all.
    """
    lines = spark.read.text(path)
    return parse_dump(lines.repartition(partitions) if partitions else lines, expected, needles)


def parse_dump(lines: DataFrame, expected: str, needles: list[str] | None = None) -> DataFrame:
    """(key, revision, record) of lines (value); a malformed one is an error when it is read."""
    if needles:
        lines = lines.where(F.col("value").rlike("|".join(candidate_pattern(n) for n in needles)))
    c = F.split("value", "\t", 5)
    v = F.try_parse_json(c[4])
    key = F.try_variant_get(v, "$.key", "string")
    bad = (F.size(c) != 5) | (c[0] != expected) | c[2].try_cast("int").isNull() | (F.schema_of_variant(v).startswith("OBJECT") == F.lit(False)) | v.isNull() | F.coalesce(key != c[1], F.lit(True))
    line = F.when(bad, F.raise_error(F.concat(F.lit("malformed dump line: "), F.substring("value", 1, 80)))).otherwise(c[1])
    return lines.select(line.alias("key"), c[2].try_cast("int").alias("revision"), v.alias("record"))


def _keys(v: Column, path: str, inner: str | None = None) -> Column:
    """Keys of references, given as strings or as objects."""
    items = F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    own = F.transform(items, lambda x: F.coalesce(*([F.try_variant_get(x, inner, "string")] if inner else []), F.try_variant_get(x, "$.key", "string"), F.try_variant_get(x, "$", "string")))
    return F.array_distinct(F.filter(F.transform(own, lambda x: F.trim(x)), lambda x: F.length(x) > 0))


def _texts(v: Column, path: str) -> Column:
    own = F.coalesce(F.try_variant_get(v, path, "array<string>"), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(own, lambda x: F.trim(x)), lambda x: F.length(x) > 0))


def outline(v: Column) -> Column:
    """Entries with a nonblank title and a level of 0 or more."""
    items = F.coalesce(F.try_variant_get(v, "$.table_of_contents", "array<variant>"), F.array().cast("array<variant>"))
    rows = F.transform(items, lambda x: F.struct(F.when(F.schema_of_variant(F.try_variant_get(x, "$.level", "variant")) == "BIGINT", F.try_variant_get(x, "$.level", "int")).alias("level"), F.trim(F.try_variant_get(x, "$.label", "string")).alias("label"), F.trim(F.try_variant_get(x, "$.title", "string")).alias("title"), F.try_variant_get(x, "$.pagenum", "string").alias("pagenum")))
    return F.filter(rows, lambda x: (F.length(x["title"]) > 0) & (x["level"] >= 0)).cast(f"array<{ENTRY}>")


def editions(dump: DataFrame) -> DataFrame:
    """Editions with a title: the fields that resolution needs, and only the first work."""
    v, get = F.col("record"), lambda p: F.trim(F.try_variant_get(F.col("record"), p, "string"))
    return dump.select(
        F.col("key").alias("edition_key"), F.try_element_at(_keys(v, "$.works"), F.lit(1)).alias("work_key"), get("$.title").alias("title"), get("$.subtitle").alias("subtitle"),
        _keys(v, "$.authors").alias("authors"), _keys(v, "$.languages").alias("languages"), X.edition_year(get("$.publish_date")).alias("year"),
        _texts(v, "$.source_records").alias("source_records"), _texts(v, "$.isbn_10").alias("isbn_10"), _texts(v, "$.isbn_13").alias("isbn_13"), outline(v).alias("toc"),
    ).where(F.length("title") > 0)


def isbns(rows: DataFrame) -> DataFrame:
    """Distinct (isbn, edition_key, kind), valid ones."""
    one = lambda c, n: rows.select(F.explode(c).alias("raw"), "edition_key").select(I.normalize_isbn(F.col("raw"), n).alias("isbn"), "edition_key", F.lit(f"isbn_{n}").alias("kind"))
    return one("isbn_10", 10).unionByName(one("isbn_13", 13)).where("isbn is not null").distinct()


def works(dump: DataFrame) -> DataFrame:
    v = F.col("record")
    authors = _keys(v, "$.authors", "$.author.key")
    text = F.coalesce(F.try_variant_get(v, "$.description.value", "string"), F.try_variant_get(v, "$.description", "string"))
    return dump.select(F.col("key").alias("work_key"), F.try_variant_get(v, "$.title", "string").alias("title"), authors.alias("authors"), _texts(v, "$.subjects").alias("subjects"), F.trim(text).alias("description"))


def build_index(edition_dump: DataFrame, target: str, work_dump: DataFrame | None = None, targets: DataFrame | None = None) -> None:
    """Editions, ISBNs and works as tables, create-only.

    targets (isbn): only editions of works that have a target, and the targets' own. The projected editions are written
    once and semi-joined, so that the dump is read once only.
    """
    spark = edition_dump.sparkSession
    rows = editions(edition_dump)
    if targets is not None:
        rows.write.mode("errorifexists").parquet(f"{target}/_all")
        rows = spark.read.parquet(f"{target}/_all")
        hit = isbns(rows).join(targets.select("isbn").distinct(), "isbn", "left_semi").select("edition_key").distinct()
        own = rows.join(hit, "edition_key", "left_semi")
        wanted = own.where("work_key is not null").select("work_key").distinct()
        rows = rows.join(wanted, "work_key", "left_semi").unionByName(own.where("work_key is null")).select(rows.columns)
    rows.write.mode("errorifexists").parquet(f"{target}/editions")
    rows = spark.read.parquet(f"{target}/editions")
    isbns(rows).write.mode("errorifexists").parquet(f"{target}/isbns")
    if work_dump is not None:
        found = works(work_dump)
        if targets is not None:
            found = found.join(rows.select("work_key").distinct(), "work_key", "left_semi")
        found.write.mode("errorifexists").parquet(f"{target}/works")


def usable(toc: Column) -> Column:
    names = F.transform(toc, lambda x: F.lower(F.trim(x["title"])))
    return (F.size(toc) >= 3) & (F.size(F.array_distinct(names)) >= 3)


def resolve(index: str, targets: DataFrame) -> DataFrame:
    """(isbn, tier, edition_key, target_edition, toc) for every target at once, from an index on disk."""
    spark = targets.sparkSession
    return resolve_tables(spark.read.parquet(f"{index}/editions"), spark.read.parquet(f"{index}/isbns"), targets)


def resolve_tables(full: DataFrame, by_isbn: DataFrame, targets: DataFrame) -> DataFrame:
    """(isbn, tier, edition_key, target_edition, toc) for every target at once.

    Supplements count for nothing. The target edition is the exact edition with the least key. An exact edition with a
    usable outline gives it: the longest, then the least key. Without one it is another edition of the target
    edition's work: the same title and volume, authors and languages that overlap where both are known; by language,
    author, distance of years, length of outline, key.
    """
    text = F.concat_ws(" ", "title", "subtitle")
    full = full.withColumn("title_key", X.bibliographic_key(F.col("title"))).withColumn("volume", X.volume_number(X.bibliographic_key(text)))
    full = full.withColumn("extra", is_supplement(X.bibliographic_key(F.concat_ws(" ", "title", "subtitle", F.array_join("source_records", " "))), SUPPLEMENTS))
    full = full.where(~F.col("extra"))
    exact = targets.select("isbn").distinct().join(by_isbn, "isbn").select("isbn", "edition_key").distinct().join(full, "edition_key")
    pick = lambda df, *order: df.withColumn("__n", F.row_number().over(W.partitionBy("isbn").orderBy(*order))).where("__n = 1").drop("__n")
    first = exact.groupBy("isbn").agg(F.min("edition_key").alias("target_edition"))
    direct = pick(exact.where(usable(F.col("toc"))), -F.size("toc"), F.col("edition_key")).join(first, "isbn").select("isbn", F.lit("exact_edition_toc").alias("tier"), "edition_key", "target_edition", "toc")
    base = pick(exact, F.col("edition_key")).join(direct.select("isbn"), "isbn", "left_anti").where("work_key is not null")
    t = base.select("isbn", "work_key", *[F.col(c).alias(f"t_{c}") for c in ("edition_key", "title_key", "volume", "authors", "languages", "year")])
    other = t.join(full, "work_key").where((F.col("edition_key") != F.col("t_edition_key")) & (F.col("title_key") == F.col("t_title_key")) & usable(F.col("toc")))
    overlap = lambda a, b: (F.size(a) == 0) | (F.size(b) == 0) | F.arrays_overlap(a, b)
    other = other.where(F.coalesce(F.col("volume") == F.col("t_volume"), F.lit(True)) & overlap("authors", "t_authors") & overlap("languages", "t_languages"))
    order = [~F.arrays_overlap("languages", "t_languages"), ~F.arrays_overlap("authors", "t_authors"), F.coalesce(F.abs(F.col("year") - F.col("t_year")), F.lit(9999)), -F.size("toc"), F.col("edition_key")]
    alternate = pick(other, *order).select("isbn", F.lit("same_work_alternate_edition_toc").alias("tier"), "edition_key", F.col("t_edition_key").alias("target_edition"), "toc")
    found = direct.unionByName(alternate)
    return targets.select("isbn").distinct().join(found, "isbn", "left").withColumn("tier", F.coalesce("tier", F.lit("none")))


def inspect_tables(full: DataFrame, by_isbn: DataFrame, targets: DataFrame) -> DataFrame:
    """For each target that has an edition: exact editions and alternates of the target edition's work, all and with a usable outline.

    Supplements count for nothing. An alternate is an edition of the same work that doesn't have the ISBN itself: all of
    the work less the ISBN's own, so that no pairs of editions are made.
    """
    extra = is_supplement(X.bibliographic_key(F.concat_ws(" ", "title", "subtitle", F.array_join("source_records", " "))), SUPPLEMENTS)
    full = full.where(~extra).select("edition_key", "work_key", usable(F.col("toc")).alias("usable"))
    own = targets.select("isbn").distinct().join(by_isbn, "isbn").select("isbn", "edition_key").distinct().join(full, "edition_key")
    count = lambda n, with_n: (F.count("*").alias(n), F.count_if("usable").alias(with_n))
    held = own.groupBy("isbn", "work_key").agg(*count("n", "with"), F.min("edition_key").alias("first"))  # by work, as an ISBN may stand in several
    exact = held.groupBy("isbn").agg(F.sum("n").alias("exact_editions"), F.sum("with").alias("exact_with_outline"), F.min_by(F.struct("work_key", "n", "with"), "first").alias("target"))
    exact = exact.select("isbn", "exact_editions", "exact_with_outline", F.col("target.work_key").alias("work_key"), F.col("target.n").alias("n"), F.col("target.with").alias("with"))
    works = full.where("work_key IS NOT NULL").groupBy("work_key").agg(*count("all", "all_with"))
    rest = lambda of, own, name: F.coalesce(F.col(of) - F.col(own), F.lit(0)).alias(name)
    return exact.join(works, "work_key", "left").select("isbn", "exact_editions", "exact_with_outline", rest("all", "n", "alternates"), rest("all_with", "with", "alternates_with_outline"))
