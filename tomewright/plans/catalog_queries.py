"""Registered queries of the catalog plans: driver tables take the shape of provider responses, dump lines and canonical
tables, and go through the plans themselves. Each stands beside the SQL that states its result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.functions import identity as I
from tomewright.functions import text as X
from tomewright.operators import tree
from tomewright.plans import build, collection, evidence, providers, reports, scope
from tomewright.plans.queries import SQL, query, table
from tomewright.sources import dump
from tomewright.sources.canonical import Dataset
from tomewright.sources.schemas import TABLES
from tomewright.sources.work import step_table

# --- provider responses --------------------------------------------------------------------------------------------

TOPIC = providers.Topic("tools", "goods", "widget|gadget", "rusty")
LIMIT = 20


def part_isbn(key):
    """A valid ISBN-13 for a number; every fifth shares that of the number before."""
    stem = F.concat(F.lit("978"), F.lpad((key - F.when(key % 5 == 0, 1).otherwise(0)).cast("string"), 9, "0"))
    return F.concat(stem, I.isbn13_check_digit(stem).cast("string"))


#: The same in SQL, over a column p_partkey.
ISBN_SQL = """(SELECT * , '978' || s || ((10 - (38 + list_sum([substr(s, i, 1)::INT * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END FOR i IN range(1, 10)])) % 10) % 10)::VARCHAR AS isbn
  FROM (SELECT *, lpad((p_partkey - CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END)::VARCHAR, 9, '0') AS s FROM part WHERE p_partkey > 0))"""
#: First of each book wins, and then the first so many of a response, in order of position.
SETTLE_SQL = f"""SELECT response_id, external_id, book_id, CASE WHEN reason IS NOT NULL THEN reason WHEN nth > 1 THEN 'duplicate' WHEN ahead > {LIMIT} THEN 'limit' END AS reason FROM (
  SELECT *, sum(CASE WHEN reason IS NULL AND nth = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY response_id ORDER BY pos) AS ahead FROM (
  SELECT *, row_number() OVER (PARTITION BY response_id, reason IS NULL, book_id ORDER BY pos) AS nth FROM candidates))"""


def responses(rows: DataFrame, item, path: str, **more) -> DataFrame:
    """One response for each brand, its items in order of the parts; more: maps beside them, by key and value."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col("p_partkey").alias("k"), item.alias("v")))), lambda x: x["v"])
    maps = {n: F.map_from_entries(F.collect_list(F.struct(k, v))) for n, (k, v) in more.items()}
    body = F.struct(ordered.alias(path), *[m.alias(n) for n, m in maps.items()])
    grouped = rows.groupBy(F.col("p_brand").alias("response_id")).agg(F.to_json(body).alias("body"))
    return grouped.select("response_id", F.lit("tools").alias("topic"), F.lit("2026-01-02 03:04:05").cast("timestamp").alias("retrieved_at"), F.parse_json("body").alias("response"))


def settled(rows: DataFrame) -> DataFrame:
    return rows.select("response_id", "external_id", "book_id", "reason")


def parts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_partkey > 0").withColumn("isbn", part_isbn(F.col("p_partkey"))).withColumn("no", F.col("p_partkey").cast("string"))


@query(f"""WITH candidates AS (SELECT p_brand AS response_id, p_partkey AS pos, 'G' || p_partkey AS external_id,
    CASE WHEN p_size % 4 = 1 THEN 'book_' || substr(sha256(lower(p_name) || chr(31) || 'writer ' || p_size), 1, 20) ELSE 'isbn13:' || isbn END AS book_id,
    CASE WHEN p_size % 7 = 0 THEN 'ineligible_candidate' END AS reason FROM {ISBN_SQL})
  {SETTLE_SQL}""")
def google_books_candidates(spark, sf_dir):
    """Volumes in English with a title; some without an ISBN, whose title and first author name them."""
    numbers = F.when(F.col("p_size") % 4 != 1, F.array(F.struct(F.lit("ISBN_13").alias("type"), F.col("isbn").alias("identifier"))))
    info = F.struct(F.col("p_name").alias("title"), F.when(F.col("p_size") % 7 == 0, "fr").otherwise("en").alias("language"), F.array(F.concat(F.lit("Writer "), F.col("p_size").cast("string"))).alias("authors"), numbers.alias("industryIdentifiers"))
    rows = responses(parts(spark, sf_dir), F.struct(F.concat(F.lit("G"), "no").alias("id"), info.alias("volumeInfo")), "items")
    return settled(providers.google_books(rows, TOPIC, LIMIT)[1])


@query(f"""WITH candidates AS (SELECT p_brand AS response_id, p_partkey AS pos, '/books/OL' || p_partkey || 'M' AS external_id, 'isbn13:' || isbn AS book_id,
    CASE WHEN p_size % 6 = 0 THEN 'no_english_edition' WHEN p_size % 5 = 0 THEN 'unreliable_author_aggregation' WHEN regexp_matches(p_type, '(?i)economy') THEN 'conflicting_subject'
      WHEN regexp_matches(p_type, '(?i)standard|promo') OR regexp_matches(p_name, '(?i)standard|promo|widget') THEN NULL ELSE 'no_topic_evidence' END AS reason FROM {ISBN_SQL})
  SELECT response_id, CASE WHEN reason = 'no_english_edition' THEN replace(replace(external_id, 'books', 'works'), 'M', 'W') ELSE external_id END AS external_id,
    CASE WHEN reason = 'no_english_edition' THEN NULL ELSE book_id END AS book_id, reason FROM ({SETTLE_SQL})""")
def open_library_candidates(spark, sf_dir):
    """Search rows with editions and work details, gated by the subjects of the works."""
    edition = F.struct(F.concat(F.lit("/books/OL"), "no", F.lit("M")).alias("key"), F.col("p_name").alias("title"), F.array(F.when(F.col("p_size") % 6 == 0, "fre").otherwise("eng")).alias("language"), F.array("isbn").alias("isbn"))
    many = F.transform(F.sequence(F.lit(1), F.when(F.col("p_size") % 5 == 0, 12).otherwise(2)), lambda i: F.concat(F.lit("Writer "), i.cast("string")))
    work = F.concat(F.lit("/works/OL"), "no", F.lit("W"))
    item = F.struct(work.alias("key"), many.alias("author_name"), F.struct(F.array(edition).alias("docs")).alias("editions"))
    rows = responses(parts(spark, sf_dir), item, "docs", work_details=(work, F.struct(F.array("p_type").alias("subjects"))))
    found = providers.open_library(rows, providers.Topic("tools", "goods", "standard|promo|widget", "economy"), LIMIT, gate=True)[1]
    return settled(found).withColumn("book_id", F.when(F.coalesce(F.col("reason") != "no_english_edition", F.lit(True)), F.col("book_id")))


@query(f"""WITH candidates AS (SELECT p_brand AS response_id, p_partkey AS pos, 'ia' || p_partkey AS external_id, 'isbn13:' || isbn AS book_id,
    CASE WHEN p_size % 3 = 0 THEN 'ineligible_candidate' END AS reason FROM {ISBN_SQL}) {SETTLE_SQL}""")
def internet_archive_candidates(spark, sf_dir):
    """Scalar or list fields; English by its codes; of valid ISBNs the least."""
    language = F.when(F.col("p_size") % 3 == 0, "ger").when(F.col("p_size") % 3 == 1, "eng").otherwise("English")
    item = F.struct(F.concat(F.lit("ia"), "no").alias("identifier"), F.col("p_name").alias("title"), language.alias("language"), F.array(F.lit("9789999999999"), F.lit("none"), F.col("isbn")).alias("isbn"), F.lit("Someone").alias("creator"))
    rows = responses(parts(spark, sf_dir), item, "docs")
    rows = rows.withColumn("response", F.parse_json(F.concat(F.lit('{"response": '), F.to_json("response"), F.lit("}"))))
    return settled(providers.internet_archive(rows, TOPIC, LIMIT)[1])


@query(f"""WITH candidates AS (SELECT p_brand AS response_id, p_partkey AS pos, CASE WHEN p_size % 8 > 0 THEN isbn END AS external_id,
    CASE WHEN p_size % 8 > 0 THEN 'isbn13:' || isbn ELSE 'book_' || substr(sha256(lower(p_name) || chr(31) || 'kim'), 1, 20) END AS book_id,
    CASE WHEN p_size % 8 = 0 THEN 'missing_valid_isbn' WHEN NOT regexp_matches(p_name || ' | ' || p_type, '(?i)widget|gadget') THEN 'no_topic_evidence'
      WHEN regexp_matches(p_name || ' | ' || p_type, '(?i)rusty') THEN 'conflicting_subject' WHEN p_size % 9 = 0 THEN 'conflicting_book_kind' END AS reason FROM {ISBN_SQL}) {SETTLE_SQL}""")
def national_library_candidates(spark, sf_dir):
    """Bibliography rows with markup in their fields, by the cascade of reasons."""
    item = F.struct(F.when(F.col("p_size") % 8 > 0, F.col("isbn")).otherwise("12345").alias("EA_ISBN"), F.concat(F.lit("<b>"), "p_name", F.lit("</b>")).alias("TITLE"), F.col("p_type").alias("SUBJECT"), F.lit("Kim").alias("AUTHOR"), F.when(F.col("p_size") % 9 == 0, "Y").otherwise("N").alias("EBOOK_YN"))
    return settled(providers.national_library(responses(parts(spark, sf_dir), item, "docs"), TOPIC, LIMIT)[1])


@query(f"""WITH candidates AS (SELECT p_brand AS response_id, p_partkey AS pos, p_partkey::VARCHAR AS external_id, 'isbn13:' || isbn AS book_id,
    CASE WHEN NOT regexp_matches(p_name, '(?i)widget|gadget') OR regexp_matches(p_name, '(?i)rusty') OR p_type <> 'ECONOMY' THEN 'ineligible_candidate' END AS reason FROM {ISBN_SQL}) {SETTLE_SQL}""")
def yes24_candidates(spark, sf_dir):
    """Items whose title fits and has no conflict, in an allowed category."""
    item = F.struct(F.col("no").alias("itemId"), F.col("p_name").alias("title"), F.lit("Kim, Lee").alias("author"), F.col("isbn").alias("isbn13"), F.col("p_type").alias("goodsSortNm"))
    rows = responses(parts(spark, sf_dir), item, "items")
    rows = rows.withColumn("response", F.parse_json(F.concat(F.lit('{"data": '), F.to_json("response"), F.lit("}"))))
    return settled(providers.yes24(rows, providers.Topic("tools", "goods", "widget|gadget", "rusty", "^ECONOMY$"), LIMIT)[1])


# --- the bulk dump -------------------------------------------------------------------------------------------------


def dump_index(spark, sf_dir, needles: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Editions and ISBNs of the dump, each written once, as an index is."""
    rows = step_table(dump.editions(dump.parse_dump(dump_lines(spark, sf_dir), "/type/edition", needles)))
    return rows, step_table(dump.isbns(rows))


def dump_lines(spark, sf_dir) -> DataFrame:
    """Edition lines of a dump from the parts: works are pairs of brand and type, outlines have p_size % 6 entries."""
    entries = F.transform(F.expr("sequence(1, p_size % 6 + 1)"), lambda i: F.struct(F.lit(0).alias("level"), F.concat(F.lit("Chapter "), i.cast("string")).alias("title")))
    work = F.struct(F.concat(F.lit("/works/"), "p_brand", F.lit("-"), "p_type").alias("key"))
    key = F.concat(F.lit("/books/OL"), "no", F.lit("M"))
    title = F.when(F.col("p_size") % 11 == 0, F.concat(F.lit("Study Guide "), "p_name")).otherwise(F.col("p_name"))
    record = F.struct(key.alias("key"), title.alias("title"), F.array(work).alias("works"), F.array("isbn").alias("isbn_13"), F.slice(entries, 1, F.col("p_size") % 6).alias("table_of_contents"), F.concat(F.lit("19"), F.lpad((F.col("p_size") % 50).cast("string"), 2, "0")).alias("publish_date"))
    line = F.concat_ws("\t", F.lit("/type/edition"), key, F.lit("3"), F.lit("2020-01-01T00:00:00"), F.to_json(record))
    return parts(spark, sf_dir).select(line.alias("value"))


EDITIONS_SQL = f"""e AS (SELECT '/books/OL' || p_partkey || 'M' AS edition_key, p_brand || '-' || p_type AS work, isbn, p_name AS title, p_size % 6 AS n, 1900 + p_size % 50 AS year FROM {ISBN_SQL} WHERE p_size % 11 > 0),
  t AS (SELECT isbn, min(edition_key) AS target_edition FROM e GROUP BY 1)"""


@query(f"""WITH {EDITIONS_SQL},
  exact AS (SELECT isbn, edition_key, row_number() OVER (PARTITION BY isbn ORDER BY n DESC, edition_key) AS k FROM e WHERE n >= 3),
  other AS (SELECT t.isbn, c.edition_key, row_number() OVER (PARTITION BY t.isbn ORDER BY abs(c.year - b.year), c.n DESC, c.edition_key) AS k
    FROM t JOIN e b ON b.edition_key = t.target_edition JOIN e c ON c.work = b.work AND c.edition_key <> b.edition_key AND c.title = b.title AND c.n >= 3
    WHERE t.isbn NOT IN (SELECT isbn FROM exact))
  SELECT a.isbn, CASE WHEN x.isbn IS NOT NULL THEN 'exact_edition_toc' WHEN o.isbn IS NOT NULL THEN 'same_work_alternate_edition_toc' ELSE 'none' END AS tier,
    coalesce(x.edition_key, o.edition_key) AS edition_key, CASE WHEN coalesce(x.edition_key, o.edition_key) IS NOT NULL THEN t.target_edition END AS target_edition
  FROM (SELECT DISTINCT isbn FROM {ISBN_SQL}) a LEFT JOIN t USING (isbn) LEFT JOIN (SELECT * FROM exact WHERE k = 1) x USING (isbn) LEFT JOIN (SELECT * FROM other WHERE k = 1) o USING (isbn)""")
def dump_resolution(spark, sf_dir):
    """Dump lines parsed, projected and indexed by ISBN; every ISBN resolved to an exact or an alternate outline, or none."""
    found = dump.resolve_tables(*dump_index(spark, sf_dir), parts(spark, sf_dir).select("isbn"))
    return found.select("isbn", "tier", "edition_key", "target_edition")


@query(f"""WITH {EDITIONS_SQL}, w AS (SELECT t.isbn, b.work, t.target_edition FROM t JOIN e b ON b.edition_key = t.target_edition)
  SELECT w.isbn, (SELECT count(*) FROM e WHERE e.isbn = w.isbn) AS exact_editions, (SELECT count(*) FROM e WHERE e.isbn = w.isbn AND n >= 3) AS exact_with_outline,
    count(c.edition_key) AS alternates, count(c.edition_key) FILTER (WHERE c.n >= 3) AS alternates_with_outline
  FROM w LEFT JOIN e c ON c.work = w.work AND c.isbn <> w.isbn GROUP BY w.isbn""")
def dump_inspection(spark, sf_dir):
    """How many exact and alternate editions there are for each ISBN, and how many have a usable outline."""
    return dump.inspect_tables(*dump_index(spark, sf_dir), parts(spark, sf_dir).select("isbn"))


@query(f"""SELECT '/books/OL' || p_partkey || 'M' AS edition_key, unnest(range(p_size % 6))::INT AS order_index, 'toc_' || substr(sha256('b' || p_partkey || chr(31) || 's' || chr(31) || unnest(range(p_size % 6)) || chr(31) || chr(31) || 'Chapter ' || (unnest(range(p_size % 6)) + 1)), 1, 20) AS toc_entry_id
  FROM {ISBN_SQL} WHERE p_size % 6 > 0""")
def dump_outlines(spark, sf_dir):
    """Outlines of dump editions as canonical entries, with their stable ids."""
    from tomewright.operators.outlines import outline_entries

    rows = dump.editions(dump.parse_dump(dump_lines(spark, sf_dir), "/type/edition"))
    rows = rows.withColumn("book", F.concat(F.lit("b"), F.regexp_extract("edition_key", "([0-9]+)", 1))).withColumn("source", F.lit("s"))
    entries = F.transform("toc", lambda x, i: F.struct(i.alias("pos"), x["level"].alias("level"), x["label"].alias("label"), x["title"].alias("title")))
    toc = outline_entries(rows.withColumn("entries", entries), "book", "source", "entries", clamp=False)
    return toc.select(F.concat(F.lit("/books/OL"), F.substring("book_id", 2, 20), F.lit("M")).alias("edition_key"), F.col("order_index").cast("int").alias("order_index"), "toc_entry_id")


@query(f"""SELECT isbn, '/books/OL' || p_partkey || 'M' AS edition_key FROM {ISBN_SQL} WHERE isbn IN (SELECT isbn FROM {ISBN_SQL} WHERE p_partkey IN (7, 10, 42))""")
def dump_lines_prefiltered(spark, sf_dir):
    """Only lines that hold one of the identifiers are parsed; the index then tells which editions have them."""
    wanted = [r.isbn for r in parts(spark, sf_dir).where("p_partkey IN (7, 10, 42)").select("isbn").distinct().collect()]
    return dump_index(spark, sf_dir, wanted)[1].select("isbn", "edition_key")


# --- canonical tables ----------------------------------------------------------------------------------------------

KINDS = ("validated_public_web_toc", "exact_edition_toc", "same_work_alternate_edition_toc")


def dataset(spark, sf_dir) -> Dataset:
    """Customers as books, their orders as sources (urgent ones as documents, too), and lines as outlines."""
    null = lambda kind="string": F.lit(None).cast(kind)
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    typed = lambda df, name: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])
    c = table(spark, sf_dir, "customer")
    number = F.concat(F.lit("978"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    books = c.select(
        tag("b", "c_custkey").alias("book_id"), null().alias("isbn_10"), F.when(F.col("c_custkey") % 2 == 0, F.concat(number, I.isbn13_check_digit(number).cast("string"))).alias("isbn_13"), F.col("c_name").alias("title"), null().alias("en_title"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("subtitle"), null().alias("en_subtitle"), F.array(tag("Writer ", "c_nationkey")).alias("authors"), null().alias("publisher"), (F.col("c_nationkey") + 1990).alias("published_year"), F.lit("en").alias("language"), F.array(F.lit("market"), F.lower("c_mktsegment")).alias("topics"),
    )
    o = table(spark, sf_dir, "orders")
    kind = TABLES["sources"]["evidence"].dataType
    about = {"evidence_type": F.lit("toc"), "tier": F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("o_orderkey") % 3 + 1).cast("int")), "same_edition": F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey") % 3 < 2)}
    own = F.when(F.col("o_orderstatus") == "F", F.struct(*[about.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields]))
    sources = o.select(
        tag("s", "o_orderkey").alias("source_id"), tag("b", "o_custkey").alias("book_id"), F.lower("o_orderpriority").alias("provider"), F.lit("metadata_api").alias("source_type"), tag("https://example.org/", "o_orderkey").alias("url"), null().alias("external_id"), F.col("o_orderdate").alias("retrieved_at"),
        null().alias("license"), null().alias("rights_note"), I.sha256_text(tag("", "o_orderkey")).alias("content_hash"), own.alias("evidence"),
    )
    text = F.concat_ws(" ", F.lit("an"), F.lower("o_orderstatus"), F.lit("order of"), F.when(F.col("o_orderkey") % 4 == 0, "widgets").otherwise("things"))
    documents = o.where("o_orderpriority = '1-URGENT'").select(
        tag("d", "o_orderkey").alias("document_id"), tag("b", "o_custkey").alias("book_id"), F.when(F.col("o_orderkey") % 2 == 0, "description").otherwise("preface").alias("document_type"), text.alias("text"), null().alias("en_text"), tag("s", "o_orderkey").alias("source_id"), I.sha256_text(text).alias("content_hash"), null("struct<scope:string,basis:string>").alias("text_extent"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part")).join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    entry = lambda n: F.concat(F.lit("e"), F.col("l_orderkey").cast("string"), F.lit("-"), n.cast("string"))
    number = F.col("l_linenumber")
    toc = lines.select(
        entry(number).alias("toc_entry_id"), tag("b", "o_custkey").alias("book_id"), F.when(number > 1, entry(F.floor(number / 2))).alias("parent_entry_id"), (F.floor(F.log2(number)) + 1).alias("level"), number.alias("order_index"),
        null().alias("label"), tag("Part ", "part").alias("title"), null().alias("en_title"), tag("s", "l_orderkey").alias("source_id"),
    )
    return Dataset(typed(books, "books"), typed(documents, "documents"), typed(toc, "toc"), typed(sources, "sources"))


#: The outline in SQL: entries with their numbers and that of their parent.
TOC_SQL = """toc AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_partkey) AS part, any_value(o_custkey) AS book, any_value(o_orderstatus) AS status FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


@query(f"""WITH {TOC_SQL}, faults AS (
  SELECT 'book_without_source' AS kind FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 50 > 0)
  UNION ALL SELECT k FROM (SELECT unnest(['duplicate_book_id', 'duplicate_isbn_13']) AS k FROM customer WHERE c_custkey % 100 = 0)
  UNION ALL SELECT 'source_missing_book' FROM orders WHERE o_orderkey % 50 > 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'document_missing_source' FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 50 = 0
  UNION ALL SELECT 'toc_missing_source' FROM toc WHERE o % 50 = 0
  UNION ALL SELECT 'document_foreign_source' FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 30 = 1
  UNION ALL SELECT 'toc_missing_parent' FROM toc t WHERE n > 1 AND (n = 3 AND o % 60 = 4 OR NOT EXISTS (SELECT 1 FROM toc p WHERE p.o = t.o AND p.n = t.n // 2))
  UNION ALL SELECT unnest(['toc_cycle', 'toc_cycle', 'child_level']) FROM toc t WHERE n = 2 AND o % 60 = 2 AND EXISTS (SELECT 1 FROM toc p WHERE p.o = t.o AND p.n = 1)
  UNION ALL SELECT 'root_level' FROM toc WHERE n = 1 AND o % 60 = 7
  UNION ALL SELECT 'child_level' FROM toc t WHERE n IN (2, 3) AND o % 60 = 7 AND EXISTS (SELECT 1 FROM toc p WHERE p.o = t.o AND p.n = 1))
  SELECT kind, count(*) AS errors FROM faults GROUP BY 1""")
def dataset_faults(spark, sf_dir):
    """All checks of a dataset, counted by kind. Rows are taken out, repeated and bent so that most kinds are found."""
    d = dataset(spark, sf_dir)
    order = lambda c: F.regexp_extract(c, "([0-9]+)", 1).cast("long")
    books = d.books.unionByName(d.books.where(order("book_id") % 100 == 0))
    docs = d.documents.withColumn("book_id", F.when(order("document_id") % 30 == 1, F.when(F.col("book_id") == "b0", "b1").otherwise("b0")).otherwise(F.col("book_id")))
    two = d.toc.where((F.col("order_index") == 2) & (order("toc_entry_id") % 60 == 2)).select(F.col("source_id").alias("turned"))
    toc = d.toc.join(two, (F.col("source_id") == F.col("turned")) & (F.col("order_index") == 1), "left")
    toc = toc.withColumn("parent_entry_id", F.when(F.col("turned").isNotNull(), F.concat(F.regexp_extract("toc_entry_id", "(.*-)", 1), F.lit("2"))).otherwise(F.col("parent_entry_id"))).drop("turned")
    lost = (F.col("order_index") == 3) & (order("toc_entry_id") % 60 == 4)
    toc = toc.withColumn("parent_entry_id", F.when(lost, "nowhere").otherwise(F.col("parent_entry_id")))
    toc = toc.withColumn("level", F.when((F.col("order_index") == 1) & (order("toc_entry_id") % 60 == 7), 5).otherwise(F.col("level")))
    bent = Dataset(*[step_table(x) for x in (books, docs, toc, d.sources.where(order("source_id") % 50 > 0))])
    return reports.integrity(bent)


@query(f"""WITH RECURSIVE {TOC_SQL}, led AS (SELECT o, n, book FROM toc WHERE n = 1 UNION ALL SELECT t.o, t.n, t.book FROM led JOIN toc t ON t.o = led.o AND t.n // 2 = led.n AND t.n > 1),
  s AS (SELECT o_orderkey AS o, o_orderstatus = 'F' AS has, ['validated_public_web_toc', 'exact_edition_toc', 'same_work_alternate_edition_toc'][o_orderkey % 3 + 1] AS tier, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 3 < 2 END AS same FROM orders),
  k AS (SELECT led.*, CASE WHEN has AND tier = 'same_work_alternate_edition_toc' THEN 'toc_same_work' WHEN NOT has OR NOT coalesce(same, false) THEN 'toc_unspecified' WHEN tier = 'validated_public_web_toc' THEN 'toc_public_web_exact' ELSE 'toc_exact' END AS kind FROM led JOIN s USING (o)),
  i AS (SELECT 'b' || c_custkey AS book_id, 'metadata_minimal' AS kind, 'canonical_record' AS relation, 'b' || c_custkey || ':metadata:title' AS identity FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'b' || c_custkey, 'subject', 'canonical_record', 'b' || c_custkey || ':metadata:topics:' || x FROM (SELECT c_custkey, unnest(['market', lower(c_mktsegment)]) AS x FROM customer) WHERE c_custkey IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'b' || o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'description' ELSE 'document' END, CASE WHEN NOT has OR same IS NULL THEN 'unspecified' WHEN same THEN 'exact' ELSE 'same_work' END, 'b' || o_custkey || ':document:d' || o_orderkey FROM orders JOIN s ON o = o_orderkey WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'b' || book, kind, CASE WHEN kind = 'toc_same_work' THEN 'same_work' WHEN kind = 'toc_unspecified' THEN 'unspecified' ELSE 'exact' END, 'b' || book || ':toc:e' || o || '-' || n || ':' || kind FROM k)
  SELECT book_id, kind AS evidence_type, relation AS edition_relation, 'evidence_' || substr(sha256('book-evidence-v1' || chr(31) || identity), 1, 20) AS evidence_id FROM i JOIN customer ON book_id = 'b' || c_custkey""")
def evidence_records(spark, sf_dir):
    """The items of the exported evidence with their ids: titles, topics, documents, and the entries a root leads to."""
    rows = evidence.export_evidence(dataset(spark, sf_dir)).select("book_id", F.explode("evidence").alias("e"))
    return rows.select("book_id", "e.item.evidence_type", "e.item.edition_relation", "e.evidence_id")


@query("""WITH d AS (SELECT o_custkey AS c, bool_or(o_orderkey % 2 = 0) AS described, bool_or(o_orderkey % 2 = 1) AS prose, bool_or(o_orderkey % 4 = 0) AS hit FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
  t AS (SELECT o_custkey AS c, count(DISTINCT (l_orderkey, l_linenumber)) AS entries, bool_or(o_orderstatus = 'F' AND (o_orderkey % 3 = 2)) AS alternate FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
  r AS (SELECT c_custkey, c_name, coalesce(entries, 0) AS entries, coalesce(described, false) AS described, coalesce(prose, false) AS prose, coalesce(hit, false) AS hit, coalesce(alternate, false) AS alternate, d.c IS NOT NULL AS documents
    FROM customer LEFT JOIN d ON d.c = c_custkey LEFT JOIN t ON t.c = c_custkey WHERE c_mktsegment = 'FURNITURE'),
  f AS (SELECT *, [x FOR x IN [CASE WHEN alternate THEN 'alternate_edition_toc' END, CASE WHEN c_custkey % 2 = 1 THEN 'no_isbn' END, CASE WHEN NOT prose THEN 'no_prose' END, CASE WHEN entries = 0 THEN 'no_toc' END,
    CASE WHEN entries = 0 AND NOT documents THEN 'title_metadata_only' END, CASE WHEN NOT hit THEN 'topic_terms_not_observed' END] IF x IS NOT NULL] AS findings FROM r)
  SELECT 'b' || c_custkey AS book_id, entries AS toc_entries, array_to_string(findings, ',') AS findings, CASE WHEN len(list_intersect(findings, ['alternate_edition_toc', 'no_isbn', 'topic_terms_not_observed'])) > 0 THEN 'review_required' WHEN entries > 0 OR documents THEN 'evidence_present' ELSE 'metadata_only' END AS status,
    CASE WHEN prose AND entries > 0 THEN 'toc_and_prose_documents' WHEN prose THEN 'prose_documents' WHEN entries > 0 AND described THEN 'toc_and_description' WHEN entries > 0 THEN 'toc_only' WHEN described THEN 'description_only' ELSE 'metadata_only' END AS evidence_state FROM f""")
def selection_findings(spark, sf_dir):
    """The audit of one topic's books."""
    rows = evidence.audit_selection(dataset(spark, sf_dir), "furniture", "widgets")
    return rows.select("book_id", F.col("toc_entries").cast("long").alias("toc_entries"), F.array_join("findings", ",").alias("findings"), "status", "evidence_state")


@query("""WITH d AS (SELECT o_custkey AS c, count(*) AS documents, bool_or(o_orderkey % 2 = 0) AS description FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
  t AS (SELECT o_custkey AS c, count(DISTINCT (l_orderkey, l_linenumber)) AS n, max(floor(log2(l_linenumber)) + 1)::INT AS deep FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
  s AS (SELECT o_custkey AS c, count(*) AS sources, string_agg(DISTINCT lower(o_orderpriority), ',' ORDER BY lower(o_orderpriority)) AS providers FROM orders GROUP BY 1)
  SELECT 'b' || c_custkey AS book_id, lower(c_mktsegment) AS topic, c_custkey % 2 = 0 AS isbn, coalesce(description, false) AS description, n IS NOT NULL AS toc, coalesce(documents, 0) AS documents, coalesce(n, 0) AS toc_entries, coalesce(deep, 0) AS toc_depth, coalesce(sources, 0) AS sources, coalesce(providers, '') AS providers
  FROM customer LEFT JOIN d ON d.c = c_custkey LEFT JOIN t ON t.c = c_custkey LEFT JOIN s ON s.c = c_custkey""")
def book_coverage_rows(spark, sf_dir):
    """The wide coverage row of every book."""
    rows = reports.book_coverage(dataset(spark, sf_dir))
    return rows.select("book_id", "topic", "isbn", "description", "toc", "documents", "toc_entries", "toc_depth", "sources", "providers")


@query("""SELECT lower(c_mktsegment) AS topic, count(*) AS books, count(*) FILTER (WHERE c_custkey % 2 = 0) AS with_isbn, count(*) AS with_authors, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey)) AS with_toc FROM customer GROUP BY ROLLUP (1)""")
def topic_coverage_rows(spark, sf_dir):
    """Coverage overall and by topic."""
    return reports.topic_coverage(dataset(spark, sf_dir)).select("topic", "books", "with_isbn", "with_authors", "with_toc")


@query("""SELECT 'b' || c_custkey AS book_id, CASE WHEN c_nationkey < 12 THEN 'market,' || lower(c_mktsegment) || ',near' ELSE 'market,' || lower(c_mktsegment) END AS topics, count(o_orderkey) AS sources,
    max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END) AS newest, count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 1) AS documents
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey, c_mktsegment""")
def dataset_merge(spark, sf_dir):
    """Two datasets become one: topics are united, the later snapshot of a source wins, and records of an older one go."""
    first = dataset(spark, sf_dir)
    near = F.array_contains("authors", F.lit("Writer 12"))
    even = F.substring("source_id", 2, 20).cast("long") % 2 == 0
    renewed = first.sources.where(even).withColumn("retrieved_at", F.col("retrieved_at") + F.expr("INTERVAL 1 DAY")).withColumn("content_hash", F.concat("content_hash", F.lit("x")))
    second = Dataset(first.books.where(~near & (F.col("published_year") < 2002)).withColumn("topics", F.array(F.lit("market"), F.lit("near"))), first.documents.limit(0), first.toc.limit(0), renewed)
    both = build.merge_datasets([first, second])
    docs, own = (df.groupBy("book_id").agg(*x) for df, x in ((both.documents, [F.count("*").alias("documents")]), (both.sources, [F.count("*").alias("sources"), F.max("retrieved_at").alias("newest")])))
    rows = both.books.join(own, "book_id", "left").join(docs, "book_id", "left")
    return rows.select("book_id", F.array_join("topics", ",").alias("topics"), F.coalesce("sources", F.lit(0)).alias("sources"), "newest", F.coalesce("documents", F.lit(0)).alias("documents"))


@query(f"""WITH RECURSIVE {TOC_SQL}, led AS (SELECT o, n, 1 AS depth, 'Part ' || part AS path FROM toc WHERE n = 1
    UNION ALL SELECT t.o, t.n, depth + 1, path || ' > Part ' || t.part FROM led JOIN toc t ON t.o = led.o AND t.n // 2 = led.n AND t.n > 1)
  SELECT 'e' || o || '-' || n AS toc_entry_id, depth, path FROM led""")
def outline_paths(spark, sf_dir):
    """Titles from the root down to every entry; entries below a missing one have no root."""
    return tree.tree_paths(dataset(spark, sf_dir).toc, "toc_entry_id", "parent_entry_id", "title")


# --- scopes, enrichment, audits ------------------------------------------------------------------------------------

REGISTRY = {"hand-tools": {"name": "도구", "aliases": ["도구", "Hand Tools"], "korean_query": "도구", "english_query": "hand tools", "evidence_pattern": "widget|gadget", "korean_evidence_pattern": "도구", "domain": "goods"}}


@query(f"""WITH p AS (SELECT *, p_size % 7 > 0 AS english, p_size % 4 <> 1 AS has_isbn, regexp_matches(p_type, '(?i)widget|gadget|promo') AS by_subject, regexp_matches(p_name, '(?i)widget|gadget|promo') AS by_title FROM {ISBN_SQL}),
  d AS (SELECT p_brand AS response_id, p_partkey AS pos, 'G' || p_partkey AS external_id, 'isbn13:' || isbn AS book_id, CASE WHEN NOT english THEN 'no_english_edition' WHEN NOT has_isbn THEN 'missing_valid_isbn'
    WHEN (by_subject OR by_title) AND NOT regexp_matches(p_type, '(?i)standard|promo') THEN 'category_subject_unconfirmed' WHEN by_subject THEN 'matching_subject' WHEN by_title THEN 'title_only_unverified' ELSE 'no_subject_evidence' END AS decision FROM p),
  candidates AS (SELECT *, CASE WHEN decision NOT IN ('matching_subject', 'title_only_unverified') THEN decision END AS reason FROM d), settled AS ({SETTLE_SQL})
  SELECT d.response_id, d.external_id, s.reason IS NULL AS included, CASE WHEN s.reason IS NULL OR decision NOT IN ('matching_subject', 'title_only_unverified') THEN decision ELSE 'normalization_or_limit' END AS reason FROM d JOIN settled s USING (external_id)""")
def scope_audit(spark, sf_dir):
    """Every candidate of a scoped search with its decision; what the normalizer or the limit drops is told apart."""
    numbers = F.when(F.col("p_size") % 4 != 1, F.array(F.struct(F.lit("ISBN_13").alias("type"), F.col("isbn").alias("identifier"))))
    info = F.struct(F.col("p_name").alias("title"), F.when(F.col("p_size") % 7 == 0, "fr").otherwise("en").alias("language"), F.array("p_type").alias("categories"), numbers.alias("industryIdentifiers"))
    rows = responses(parts(spark, sf_dir), F.struct(F.concat(F.lit("G"), "no").alias("id"), info.alias("volumeInfo")), "items")
    own = scope.Scope("tools", None, None, "tools", "widget|gadget|promo", None, None, "test", "ready", "standard|promo")
    _, audit = scope.audit_response(rows, own, scope.literal_topic("tools", "국내도서-도구"), LIMIT, "google_books")
    return audit.select("response_id", "external_id", "included", "reason")


@query("""SELECT 'b' || c_custkey AS book_id, CASE WHEN old IS NULL AND new IS NULL THEN 'remaining' WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'lost' WHEN old <> new THEN 'replaced' ELSE 'kept' END AS outcome FROM customer
  LEFT JOIN (SELECT o_custkey, list_sort(list(DISTINCT l_orderkey)) AS old FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 3 = 0 GROUP BY 1) a ON a.o_custkey = c_custkey
  LEFT JOIN (SELECT o_custkey, list_sort(list(DISTINCT l_orderkey)) AS new FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 6 < 4 GROUP BY 1) b ON b.o_custkey = c_custkey""")
def enrichment_outcome(spark, sf_dir):
    """Books whose outline came, went, changed its sources, or stayed."""
    d = dataset(spark, sf_dir)
    order = F.substring("source_id", 2, 20).cast("long")
    before, after = (Dataset(d.books, d.documents, d.toc.where(c), d.sources) for c in (order % 3 == 0, order % 6 < 4))
    return collection.enrichment_outcome(before, after)


@query("""WITH o AS (SELECT DISTINCT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 1 END AS priority, 'page-' || s_suppkey AS slug, 'b' || s_suppkey AS book_id, lower(c_mktsegment) AS topic FROM supplier JOIN customer ON c_custkey = s_suppkey
  WHERE c_custkey NOT IN (SELECT o_custkey FROM o) OR c_custkey % 2 = 1 ORDER BY 1, 2 LIMIT 40""")
def enrichment_plan(spark, sf_dir):
    """The first 40 reviewed pages, publishers' first, whose book has no outline (here those of even books are kept)."""
    d = dataset(spark, sf_dir)
    toc = d.toc.where(F.substring("book_id", 2, 20).cast("long") % 2 == 0)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lower("c_mktsegment").alias("topic"))
    key = F.col("s_suppkey").cast("string")
    pages = table(spark, sf_dir, "supplier").join(c, F.col("s_suppkey") == F.col("k")).select((F.col("s_suppkey") % 2).cast("int").alias("priority"), F.concat(F.lit("page-"), key).alias("slug"), F.concat(F.lit("b"), key).alias("book_id"), "topic")
    return collection.enrichment_plan(pages, Dataset(d.books, d.documents, toc, d.sources), 40)


@query("""SELECT 'p' || p_partkey AS book_id, CASE WHEN p_size % 6 = 0 THEN 'unsupported_source' WHEN p_size % 5 = 0 THEN 'edition_detail_not_fetched' WHEN p_size % 4 = 0 THEN 'rate_limit' WHEN p_size % 4 = 1 THEN 'edition_detail_fetch_failed'
  WHEN p_size % 4 = 2 THEN 'provider_returned_no_evidence' ELSE 'toc_parse_failure' END AS reason FROM part WHERE p_partkey > 0""")
def missing_outline_reasons(spark, sf_dir):
    """Why books have no outline: an older response that knew all editions is outdone by a newer one that says more of them."""
    p = parts(spark, sf_dir)
    key = F.concat(F.lit("/books/OL"), "no", F.lit("M"))
    site = F.when(F.col("p_size") % 6 == 0, "https://example.org").otherwise("https://openlibrary.org")
    books = p.select(F.concat(F.lit("p"), "no").alias("book_id"), F.col("p_brand").alias("topic"), F.array(F.concat(site, key, F.lit(".json"))).alias("urls"))
    told = p.where("p_size % 5 > 0")
    toc = F.when(F.col("p_size") % 4 == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("x")))
    detail = F.map_from_entries(F.array_compact(F.collect_list(F.when(F.col("p_size") % 4 >= 2, F.struct(key.alias("k"), F.struct(toc.alias("table_of_contents")).alias("v"))))))
    failure = F.struct(F.lit("edition_detail").alias("stage"), key.alias("external_id"), F.when(F.col("p_size") % 4 == 0, "rate_limit").otherwise("odd").alias("reason"))
    failures = F.array_compact(F.collect_list(F.when(F.col("p_size") % 4 < 2, failure)))
    newer = told.groupBy(F.col("p_brand").alias("topic")).agg(F.to_json(F.struct(detail.alias("edition_details"), failures.alias("collection_failures"))).alias("body")).withColumn("at", F.lit("2026-02-01"))
    old = F.map_from_entries(F.collect_list(F.struct(key.alias("k"), F.lit("text").alias("v"))))
    older = told.groupBy(F.col("p_brand").alias("topic")).agg(F.to_json(F.struct(old.alias("edition_details"))).alias("body")).withColumn("at", F.lit("2026-01-01"))
    artifacts = newer.unionByName(older).select(F.lit("open-library").alias("provider"), "topic", F.col("at").cast("timestamp").alias("retrieved_at"), F.parse_json("body").alias("response"))
    return collection.missing_outline_reasons(books, artifacts)


@query("""WITH t AS (SELECT DISTINCT o_custkey AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey), d AS (SELECT DISTINCT o_custkey AS c FROM orders WHERE o_orderpriority = '1-URGENT')
  SELECT 'b' || c_custkey AS book_id, concat_ws(',', CASE WHEN c_custkey % 2 = 1 THEN 'missing_isbn_13' END, 'missing_isbn_10', CASE WHEN t.c IS NULL THEN 'missing_toc' END, CASE WHEN d.c IS NULL THEN 'insufficient_public_prose' END) AS warnings
  FROM customer LEFT JOIN t ON t.c = c_custkey LEFT JOIN d ON d.c = c_custkey""")
def book_warnings(spark, sf_dir):
    return collection.warnings(dataset(spark, sf_dir)).select("book_id", F.array_join("warnings", ",").alias("warnings"))


@query("""WITH a AS ({}) SELECT 'status' AS facet, status AS value, count(*) AS books FROM a GROUP BY ALL UNION ALL SELECT 'evidence_state', evidence_state, count(*) FROM a GROUP BY ALL
  UNION ALL SELECT 'finding', f, count(*) FROM (SELECT unnest(string_split(findings, ',')) AS f FROM a WHERE findings <> '') GROUP BY ALL""")
def audit_totals(spark, sf_dir):
    """How often each status, finding and state of evidence is found in the audit of one topic."""
    return collection.audit_totals(evidence.audit_selection(dataset(spark, sf_dir), "furniture", "widgets"))


SQL["audit_totals"] = SQL["audit_totals"].replace("{}", SQL["selection_findings"])


@query("""WITH b AS (SELECT c_mktsegment AS segment, c_nationkey + 1990 AS year, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS toc, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS description FROM customer),
  f AS (SELECT 'all' AS facet, 'all' AS value, toc, description FROM b UNION ALL SELECT 'segment', segment, toc, description FROM b UNION ALL SELECT 'year', year::VARCHAR, toc, description FROM b)
  SELECT facet, value, count(*) AS books, count(*) FILTER (WHERE toc) AS toc_books, count(*) FILTER (WHERE description) AS description_books, count(*) FILTER (WHERE toc AND description) AS both_books,
    round(100.0::DOUBLE * count(*) FILTER (WHERE toc) / count(*), 2) AS toc_percentage, round(100.0::DOUBLE * count(*) FILTER (WHERE description) / count(*), 2) AS description_percentage, round(100.0::DOUBLE * count(*) FILTER (WHERE toc AND description) / count(*), 2) AS both_percentage FROM f GROUP BY ALL""")
def discovery_summary(spark, sf_dir):
    """Coverage of a discovery overall, by topic and by year."""
    o = table(spark, sf_dir, "orders")
    flags = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.col("o_orderstatus") == "F").alias("toc"), F.max(F.col("o_orderpriority") == "1-URGENT").alias("description"))
    rows = table(spark, sf_dir, "customer").join(flags, "c_custkey", "left").select(F.col("c_mktsegment").alias("segment"), (F.col("c_nationkey") + 1990).alias("year"), F.coalesce("toc", F.lit(False)).alias("toc"), F.coalesce("description", F.lit(False)).alias("description"))
    return collection.discovery_summary(rows, ["segment", "year"])


@query("""SELECT event_id, CASE WHEN event_type = 'click' OR user_id % 5 = 0 THEN 'yes' WHEN event_type = 'view' THEN 'no' ELSE 'unknown' END AS translated FROM events""")
def translation_states(spark, sf_dir):
    marker = F.when(F.col("event_type") == "click", " y").when(F.col("event_type") == "view", "n")
    return table(spark, sf_dir, "events").select("event_id", collection.translation_status(marker, F.when(F.col("user_id") % 5 == 0, "Original")).alias("translated"))


@query("""SELECT row_number() OVER (ORDER BY p_brand, p_type, max(event_id) DESC) - 1 AS selector, p_brand AS provider, p_type AS topic, max(event_id) AS event_id FROM
  (SELECT 'P' || (user_id % 3) AS p_brand, event_type AS p_type, event_id FROM events) GROUP BY p_brand, p_type""")
def manifest_selection(spark, sf_dir):
    """The latest artifact of each provider and topic that a manifest names."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string")).alias("provider"), F.col("event_type").alias("topic"), F.lit(5).alias("requested_limit"), F.lit(None).cast("string").alias("source"), F.lit("h").alias("content_hash"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("retrieved_at"), F.col("event_id").cast("string").alias("path"), "event_id")
    pairs = sorted((r.provider, r.topic) for r in rows.select("provider", "topic").distinct().collect())  # a few
    got = collection.select_artifacts(rows, collection.Manifest(tuple(collection.Selector(p, t, 5) for p, t in pairs), ("b",)))
    return got.select(F.col("selector").cast("long").alias("selector"), "provider", "topic", "event_id")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'brand é ' || lower(p_name) || ' ss c plus plus' ELSE lower(p_name) || ' c sharp' END AS key, CASE WHEN p_size % 2 = 0 THEN 'brandé,' || replace(lower(p_name), ' ', '') || 'ssc++' ELSE replace(lower(p_name), ' ', '') || 'c#' END AS name FROM part""")
def unicode_keys(spark, sf_dir):
    """Comparison forms of names of any width and case, and of plain ones."""
    c = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Ｂrand É, "), "p_name", F.lit(" ß C++"))).otherwise(F.concat("p_name", F.lit(" C#")))
    return table(spark, sf_dir, "part").select("p_partkey", X.bibliographic_key(c).alias("key"), X.name_key(c).alias("name"))
