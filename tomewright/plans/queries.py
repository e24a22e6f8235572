"""Registered queries of the generic operators over the driver's tables, each beside the SQL that states it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewright.functions import identity as I
from tomewright.functions import text as X
from tomewright.operators import batching, coverage, decisions, dedupe, joins, merge, tree, validation

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_of(spark: SparkSession, sf_dir: str, *years: int) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.year("o_orderdate").isin(list(years)))


# --- identity, deduplication, best rows ----------------------------------------------------------------------------


@query("""SELECT source, lang, count(*) AS items, count(*) FILTER (WHERE quality IS NOT NULL) AS with_label, count(*) FILTER (WHERE n_chars >= 1000) AS with_long
  FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM documents) d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)
  WHERE k = 1 GROUP BY ALL""")
def canonical_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", I.sha256_text(F.col("text")).alias("content_hash"))
    kept = dedupe.first_wins(docs, "content_hash", ["doc_id"])
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = kept.join(labels, "doc_id", "left").select("source", "lang", F.col("quality").isNotNull().alias("label"), (F.col("n_chars") >= 1000).alias("long"))
    return coverage.coverage(rows, ["source", "lang"], ["label", "long"])


@query("""SELECT doc_id, 'doc_' || substr(sha256(source || chr(31) || doc_id::VARCHAR), 1, 20) AS item_id, 'sha256:' || sha256(text) AS content_hash FROM documents""")
def stable_id_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", I.stable_id("doc", F.col("source"), F.col("doc_id")).alias("item_id"), I.sha256_text(F.col("text")).alias("content_hash"))


@query("""WITH a AS (SELECT p_partkey, lpad(p_partkey::VARCHAR, 9, '0') AS stem FROM part),
  b AS (SELECT p_partkey, stem || CASE WHEN p_partkey % 11 = 10 THEN 'X' ELSE (p_partkey % 11)::VARCHAR END AS isbn10, '978' || stem AS s12 FROM a),
  c AS (SELECT *, s12 || ((10 - list_sum([substr(s12, i::INT, 1)::INT * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END FOR i IN range(1, 13)]) % 10) % 10)::INT::VARCHAR AS isbn13,
    (list_sum([substr(isbn10, i::INT, 1)::INT * (11 - i) FOR i IN range(1, 10)]) + CASE WHEN isbn10[10] = 'X' THEN 10 ELSE isbn10[10]::INT END) % 11 = 0 AS valid10 FROM b)
  SELECT p_partkey, isbn10, valid10, isbn13, true AS valid13, CASE WHEN valid10 THEN isbn10 END AS normalized FROM c""")
def isbn_checksum(spark, sf_dir):
    stem, k = F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.col("p_partkey") % 11
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(stem, F.when(k == 10, "X").otherwise(k.cast("string"))).alias("isbn10"))
    rows = rows.withColumn("isbn13", I.isbn10_to_13(F.col("isbn10")))
    spelled = F.concat(F.lit("ISBN "), F.substring("isbn10", 1, 5), F.lit("-"), F.substring("isbn10", 6, 5))
    return rows.select("p_partkey", "isbn10", I.isbn10_valid(F.col("isbn10")).alias("valid10"), "isbn13", I.isbn13_valid(F.col("isbn13")).alias("valid13"), I.normalize_isbn(spelled, 10).alias("normalized"))


@query("""SELECT min(doc_id) AS doc_id, 'sha256:' || sha256(text) AS content_hash FROM documents GROUP BY text ORDER BY 1 LIMIT 500""")
def first_wins_limit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", I.sha256_text(F.col("text")).alias("content_hash"))
    return dedupe.first_wins(docs, "content_hash", ["doc_id"], 500)


@query("""SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1""")
def latest_snapshot(spark, sf_dir):
    return dedupe.latest_by(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_quantity DESC, l_shipdate, l_partkey, l_suppkey, l_linenumber) AS k FROM lineitem) WHERE k = 1""")
def best_evidence_argmin(spark, sf_dir):
    order = [F.col("l_returnflag"), F.col("l_quantity").desc(), *[F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")]]
    return dedupe.best_by(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query("""SELECT p_type, n, samples FROM (SELECT p_type, count(*) AS n FROM part GROUP BY 1) JOIN (
  SELECT p_type, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS samples FROM (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS k FROM part) WHERE k <= 4 GROUP BY 1) USING (p_type)""")
def category_counts(spark, sf_dir):
    return dedupe.ranked_groups(table(spark, sf_dir, "part"), "p_type", F.col("p_partkey"), "p_partkey")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def bounded_worklist(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return dedupe.worklist(rows, F.col("o_orderstatus") == "F", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 50).select("o_orderkey", "o_totalprice")


@query("""SELECT p_partkey, regexp_replace(trim(regexp_replace(replace(lower(p_brand || ' ' || p_name), '#', ' sharp '), '[^a-z0-9]+', ' ', 'g')), ' +', ' ', 'g') AS key FROM part""")
def bibliographic_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.bibliographic_key(F.concat_ws(" ", "p_brand", "p_name")).alias("key"))


@query("""WITH t AS (SELECT p_partkey, p_size, ' ..The  ' || p_name || ', ' || CASE WHEN p_size % 2 = 0 THEN 'Second Edition' ELSE p_size || 'th ed.' END || ' vol ' || p_size || ' (' || (1990 + p_size) || ') .' AS s FROM part)
  SELECT p_partkey, trim(regexp_replace(s, '\\s+', ' ', 'g'), ' .') AS title, CASE WHEN p_size % 2 = 0 THEN '2' ELSE p_size::VARCHAR END AS editions, p_size::INT AS volume, (1990 + p_size)::INT AS published FROM t""")
def text_numbers(spark, sf_dir):
    size = F.col("p_size").cast("string")
    s = F.concat(F.lit(" ..The  "), "p_name", F.lit(", "), F.when(F.col("p_size") % 2 == 0, "Second Edition").otherwise(F.concat(size, F.lit("th ed."))), F.lit(" vol "), size, F.lit(" ("), (F.col("p_size") + 1990).cast("string"), F.lit(") ."))
    rows = table(spark, sf_dir, "part").select("p_partkey", s.alias("s"))
    return rows.select("p_partkey", X.clean_title(F.col("s")).alias("title"), F.array_join(X.edition_numbers(F.col("s")), ",").alias("editions"), X.volume_number(F.col("s")).alias("volume"), X.published_year(F.col("s")).alias("published"))


# --- joins and set operations --------------------------------------------------------------------------------------


@query("""SELECT DISTINCT p_brand, l_suppkey FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_size <= 5""")
def isbn_to_edition_join(spark, sf_dir):
    targets = table(spark, sf_dir, "part").where("p_size <= 5").select("p_partkey", "p_brand")
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").join(targets, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "l_suppkey").distinct()


@query("""SELECT p_partkey, alternate, cost FROM (SELECT t.p_partkey, c.p_partkey AS alternate, abs(t.p_size - c.p_size)::INT AS cost,
  row_number() OVER (PARTITION BY t.p_partkey ORDER BY abs(t.p_size - c.p_size), c.p_partkey) AS k
  FROM part t JOIN part c ON t.p_brand = c.p_brand AND t.p_type = c.p_type AND t.p_partkey <> c.p_partkey) WHERE k = 1""")
def same_work_alternate(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return joins.nearest_alternate(parts, "p_partkey", ["p_brand", "p_type"], "p_size").withColumn("cost", F.col("cost").cast("int"))


@query("""SELECT c_custkey, coalesce(a.k, b.k) AS o_orderkey, CASE WHEN a.k IS NOT NULL THEN 'exact' WHEN b.k IS NOT NULL THEN 'alternate' ELSE 'none' END AS tier
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_totalprice > 300000 GROUP BY 1) a ON a.o_custkey = c_custkey
  LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1) b ON b.o_custkey = c_custkey""")
def tiered_resolution(spark, sf_dir):
    best = lambda rows: rows.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("o_orderkey"))
    exact = best(table(spark, sf_dir, "orders").where("o_totalprice > 300000"))
    return joins.tiered(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", [("exact", exact), ("alternate", best(orders_of(spark, sf_dir, 1997)))], "o_orderkey")


@query("""SELECT p_brand, p_type, p_size, matches, CASE WHEN matches = 1 THEN k END AS p_partkey FROM (SELECT DISTINCT p_brand, p_type, p_size FROM part WHERE p_size <= 20) JOIN
  (SELECT p_brand, p_type, p_size, count(*) AS matches, min(p_partkey) AS k FROM part GROUP BY ALL) USING (p_brand, p_type, p_size)""")
def unique_match_join(spark, sf_dir):
    parts, keys = table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"]
    return joins.unique_match(parts.where("p_size <= 20").select(*keys).distinct(), parts.select("p_partkey", *keys), keys, "p_partkey")


@query("""SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1998) THEN 'kept' ELSE 'removed' END AS state FROM customer""")
def snapshot_semi_anti(spark, sf_dir):
    customers, own = table(spark, sf_dir, "customer").select("c_custkey"), orders_of(spark, sf_dir, 1998).select(F.col("o_custkey").alias("c_custkey"))
    kept = customers.join(own, "c_custkey", "left_semi").withColumn("state", F.lit("kept"))
    return kept.unionByName(joins.without_keys(customers, own, "c_custkey").withColumn("state", F.lit("removed")))


@query("""WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996), b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1997)
  SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.o_custkey IS NOT NULL AS in_first, b.o_custkey IS NOT NULL AS in_second,
  CASE WHEN a.o_custkey IS NULL THEN 'added' WHEN b.o_custkey IS NULL THEN 'removed' ELSE 'shared' END AS state FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""")
def selection_full_outer(spark, sf_dir):
    return joins.compare_selections(orders_of(spark, sf_dir, 1996), orders_of(spark, sf_dir, 1997), "o_custkey")


@query("""SELECT coalesce(c_custkey, s_suppkey) AS key, coalesce(c_t, s_t) AS title, coalesce(c_l, s_l) AS language,
  CASE WHEN c_custkey IS NULL THEN 'foreign_only' WHEN s_suppkey IS NULL THEN 'primary_only' WHEN NOT (c_l = s_l OR c_l = 'und' OR s_l = 'und') THEN 'language_conflict' WHEN c_t <> s_t THEN 'title_conflict' ELSE 'merged' END AS status
  FROM (SELECT c_custkey, 'T' || (c_nationkey % 2) AS c_t, ['und', 'en', 'ko', 'en'][1 + c_nationkey % 4] AS c_l FROM customer) FULL JOIN
  (SELECT s_suppkey, 'T' || (s_nationkey % 2) AS s_t, ['und', 'en', 'ko', 'en'][1 + s_nationkey % 4] AS s_l FROM supplier) ON c_custkey = s_suppkey""")
def multi_provider_merge(spark, sf_dir):
    langs = F.array(*[F.lit(x) for x in ("und", "en", "ko", "en")])
    side = lambda df, key, nation: df.select(F.col(key).alias("key"), F.concat(F.lit("T"), (F.col(nation) % 2).cast("string")).alias("title"), F.element_at(langs, F.col(nation) % 4 + 1).alias("language"))
    return joins.merge_catalogs(side(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey"), side(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey"), "key", "title", "language")


@query("""SELECT o_custkey, arg_min(stage, r) AS stage FROM (SELECT o_custkey, 0 AS r, 'exact' AS stage FROM orders WHERE year(o_orderdate) = 1995 UNION ALL
  SELECT o_custkey, 1, 'alternate' FROM orders WHERE year(o_orderdate) = 1996 UNION ALL SELECT o_custkey, 2, 'web' FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1""")
def incremental_gain(spark, sf_dir):
    return joins.gains([("exact", orders_of(spark, sf_dir, 1995)), ("alternate", orders_of(spark, sf_dir, 1996)), ("web", table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'"))], "o_custkey")


@query("""SELECT 'missing' AS kind, * FROM (SELECT c_custkey FROM customer WHERE c_nationkey < 12 EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999) UNION ALL
  SELECT 'unexpected', * FROM (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999 EXCEPT SELECT c_custkey FROM customer WHERE c_nationkey < 12)""")
def identity_set_contract(spark, sf_dir):
    expected = table(spark, sf_dir, "customer").where("c_nationkey < 12").select("c_custkey")
    return joins.set_differences(expected, orders_of(spark, sf_dir, 1999).select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""SELECT o_custkey, o_orderkey FROM orders WHERE year(o_orderdate) = 1996 UNION ALL
  SELECT o_custkey, o_orderkey FROM orders WHERE year(o_orderdate) = 1998 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996)""")
def fill_missing_only(spark, sf_dir):
    pick = lambda y: orders_of(spark, sf_dir, y).select("o_custkey", "o_orderkey")
    return joins.fill_only_missing(pick(1996), pick(1998), "o_custkey")


@query("""WITH a AS (SELECT user_id AS id, date_trunc('day', ts) AS day, event_type, value, event_id FROM events),
  l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day DESC, value, event_id) AS k FROM a),
  c AS (SELECT id, max(n) > 1 AS same_time_conflict FROM (SELECT id, day, count(DISTINCT value) AS n FROM a GROUP BY ALL) GROUP BY 1),
  i AS (SELECT id, count(DISTINCT event_type) > 1 AS identity_conflict FROM a GROUP BY 1)
  SELECT id, event_id, same_time_conflict, identity_conflict FROM l JOIN c USING (id) JOIN i USING (id) WHERE k = 1""")
def snapshot_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.date_trunc("day", "ts").alias("day"), "event_type", "value", "event_id")
    return merge.merge_snapshots(rows, "id", "day", "value", ["event_type"], [F.col("value"), F.col("event_id")]).select("id", "event_id", "same_time_conflict", "identity_conflict")


@query("""SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, arg_min(en, o_orderkey) FILTER (WHERE en IS NOT NULL) AS en, min(o_orderkey) AS o_orderkey,
  count(DISTINCT o_orderstatus) > 1 OR count(DISTINCT en) > 1 AS conflict FROM (SELECT o_custkey, o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 200000 THEN o_orderpriority END AS en FROM orders) GROUP BY 1""")
def record_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")).alias("en"))
    return merge.merge_records(rows, "o_custkey", "o_orderkey", ["en"])


# --- validation and coverage ---------------------------------------------------------------------------------------


@query("""WITH o AS (SELECT * FROM orders WHERE year(o_orderdate) < 2001) SELECT 'missing_order' AS kind, l_partkey::VARCHAR AS id, l_orderkey::VARCHAR AS detail FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)
  UNION ALL SELECT 'duplicate_line', l_orderkey || '/' || l_linenumber, count(*)::VARCHAR FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def fk_validation(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    missing = validation.missing_reference(lines, "l_partkey", "l_orderkey", table(spark, sf_dir, "orders").where(F.year("o_orderdate") < 2001), "o_orderkey", "missing_order")
    return missing.unionByName(validation.duplicates(lines, ["l_orderkey", "l_linenumber"], "duplicate_line"))


@query("""SELECT 'foreign_nation' AS kind, s_suppkey::VARCHAR AS id, c_nationkey::VARCHAR AS detail FROM supplier JOIN customer ON s_suppkey = c_custkey WHERE s_nationkey <> c_nationkey""")
def ownership_check(spark, sf_dir):
    return validation.ownership(table(spark, sf_dir, "supplier"), "s_suppkey", "s_suppkey", "s_nationkey", table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey", "foreign_nation")


@query("""SELECT n_name, count(*) AS items, count(*) FILTER (WHERE urgent) AS with_urgent, count(*) FILTER (WHERE large) AS with_large FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS urgent, bool_or(o_totalprice > 300000) AS large FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""")
def coverage_by_group(spark, sf_dir):
    flags = coverage.has_any(table(spark, sf_dir, "orders"), "o_custkey", {"urgent": F.col("o_orderpriority") == "1-URGENT", "large": F.col("o_totalprice") > 300000})
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(flags, F.col("o_custkey") == F.col("c_custkey"), "left")
    return coverage.coverage(rows, ["n_name"], ["urgent", "large"])


@query("""SELECT c_mktsegment, count(*) AS items, count(*) FILTER (WHERE c_acctbal < 0) AS with_debt, count(*) FILTER (WHERE c_nationkey < 5) AS with_near FROM customer GROUP BY ROLLUP (c_mktsegment)""")
def coverage_grouping_sets(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", (F.col("c_acctbal") < 0).alias("debt"), (F.col("c_nationkey") < 5).alias("near"))
    return coverage.coverage_rollup(rows, "c_mktsegment", ["debt", "near"])


@query("""SELECT count(*) AS lines, count(*) FILTER (WHERE o_orderkey IS NULL) AS orphans, (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)) AS duplicates
  FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey""")
def integrity_counters(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("found"))
    twice = lines.groupBy("l_orderkey", "l_linenumber").count().select((F.col("count") - 1).alias("extra"), F.lit(0).alias("lines"), F.lit(0).alias("orphans"))
    own = lines.join(done, "l_orderkey", "left").select(F.lit(0).alias("extra"), F.lit(1).alias("lines"), F.col("found").isNull().cast("int").alias("orphans"))
    return own.unionByName(twice).agg(F.sum("lines").alias("lines"), F.sum("orphans").alias("orphans"), F.sum("extra").alias("duplicates"))


@query("""SELECT reason, count(*) AS items FROM (SELECT CASE WHEN n_chars < 200 THEN 'too_short' WHEN quality IS NULL THEN 'no_label' WHEN quality = 0 THEN 'low_quality' WHEN toxic = 1 THEN 'toxic' ELSE 'present' END AS reason
  FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1""")
def missing_reason_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    reason = F.when(F.col("n_chars") < 200, "too_short").when(F.col("quality").isNull(), "no_label").when(F.col("quality") == 0, "low_quality").when(F.col("toxic") == 1, "toxic").otherwise("present")
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("items"))


@query("""SELECT grp, count(*) AS selected, count(quality) AS labelled, CASE WHEN count(*) = count(quality) THEN (count(*) FILTER (WHERE quality = 1)) / count(*) END AS precision
  FROM (SELECT doc_id, lang || '/' || (doc_id % 300) AS grp FROM documents) LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def audited_precision(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "lang", (F.col("doc_id") % 300).cast("string")).alias("grp"))
    rows = rows.join(table(spark, sf_dir, "labels"), "doc_id", "left").select("grp", (F.col("quality") == 1).alias("good"))
    return coverage.audited_precision(rows, "grp", "good")


YEARS = (1996, 1998, 2000, 2050)


@query("""WITH b(bucket) AS (VALUES ('<=1996'), ('1997-1998'), ('1999-2000'), ('2001-2050'), ('2051+')),
  o AS (SELECT CASE WHEN y <= 1996 THEN '<=1996' WHEN y <= 1998 THEN '1997-1998' WHEN y <= 2000 THEN '1999-2000' WHEN y <= 2050 THEN '2001-2050' ELSE '2051+' END AS bucket, o_orderstatus FROM (SELECT year(o_orderdate) AS y, o_orderstatus FROM orders)),
  c AS (SELECT bucket, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS k FROM o GROUP BY 1)
  SELECT bucket, coalesce(n, 0) AS items, coalesce(k, 0) AS with_flag, CASE WHEN n > 0 THEN round(100.0::DOUBLE * k / n, 2) ELSE 0.0::DOUBLE END AS pct FROM b LEFT JOIN c USING (bucket)""")
def year_bucket_metrics(spark, sf_dir):
    names = [f"<={YEARS[0]}", *(f"{a + 1}-{b}" for a, b in zip(YEARS, YEARS[1:], strict=False)), f"{YEARS[-1] + 1}+"]
    return coverage.bucket_metrics(table(spark, sf_dir, "orders"), X.year_bucket(F.year("o_orderdate"), YEARS), names, F.col("o_orderstatus") == "F")


@query("""SELECT user_id, bool_or(event_type = 'purchase') AS bought, max(value) AS top, CASE WHEN min(v) = max(v) THEN min(v) END AS vote, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds
  FROM (SELECT *, value > 50 AS v FROM events) GROUP BY 1""")
def cross_topic_collapse(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return coverage.collapse(rows, "user_id", {"bought": F.col("event_type") == "purchase"}, {"top": F.col("value")}, {"vote": F.col("value") > 50}, {"kinds": F.col("event_type")})


@query("""SELECT signature, count(DISTINCT n) AS names FROM (SELECT n, array_to_string(list_sort(string_split(lower(n), ' ')), ' ') AS signature FROM
  (SELECT 'Rue ' || s_suppkey || ' Anna' AS n FROM supplier UNION ALL SELECT 'Anna Rue ' || s_suppkey FROM supplier WHERE s_nationkey < 12)) GROUP BY 1 HAVING count(DISTINCT n) > 1""")
def author_signature_conflict(spark, sf_dir):
    """Names of suppliers as one catalog writes them, and for some the words in another order as a second one does."""
    rows, key = table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("string")
    names = rows.select(F.concat(F.lit("Rue "), key, F.lit(" Anna")).alias("n")).unionByName(rows.where("s_nationkey < 12").select(F.concat(F.lit("Anna Rue "), key).alias("n")))
    return names.groupBy(coverage.token_signature(F.col("n")).alias("signature")).agg(F.count_distinct("n").alias("names")).where("names > 1")


# --- trees and folds -----------------------------------------------------------------------------------------------

LEVELS = "CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END"


@query(f"""WITH RECURSIVE s AS (SELECT conv_id, turn, {LEVELS} - min({LEVELS}) OVER (PARTITION BY conv_id) + 1 AS level, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
  f AS (SELECT DISTINCT conv_id, 0::BIGINT AS rn, NULL::BIGINT AS turn, NULL::INT AS level, NULL::BIGINT AS parent, false AS kept, []::BIGINT[] AS stack FROM s
    UNION ALL SELECT s.conv_id, s.rn, s.turn, s.level::INT, CASE WHEN s.level > 1 THEN f.stack[s.level - 1] END, len(f.stack) >= s.level - 1,
      CASE WHEN len(f.stack) >= s.level - 1 THEN list_append(f.stack[1:s.level - 1], s.turn) ELSE f.stack END FROM f JOIN s ON s.conv_id = f.conv_id AND s.rn = f.rn + 1)
  SELECT conv_id, turn, level, parent, (row_number() OVER (PARTITION BY conv_id, parent ORDER BY turn) - 1)::INT AS order_index FROM f WHERE kept""")
def levels_to_parent(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(LEVELS).alias("level"))
    return tree.levels_to_parents(rows, "conv_id", "turn", "level")


@query("""SELECT conv_id, turn, (coalesce(lead(p) OVER (PARTITION BY conv_id ORDER BY p), n + 1) - p - 1)::INT AS descendants FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS p, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) WHERE role = 'user'""")
def root_descendants(spark, sf_dir):
    rows = tree.root_descendants(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user")
    return rows.withColumn("descendants", F.col("descendants").cast("int"))


@query("""SELECT 'r' || r_regionkey AS id, 1 AS depth, r_name AS path FROM region UNION ALL SELECT 'n' || n_nationkey, 2, r_name || ' > ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'c' || c_custkey, 3, r_name || ' > ' || n_name || ' > ' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def tree_paths(spark, sf_dir):
    node = lambda t, key, up, name: table(spark, sf_dir, t).select(key.alias("id"), up.alias("parent"), F.col(name).alias("label"))
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    rows = node("region", tag("r", "r_regionkey"), F.lit(None).cast("string"), "r_name").unionByName(node("nation", tag("n", "n_nationkey"), tag("r", "n_regionkey"), "n_name")).unionByName(node("customer", tag("c", "c_custkey"), tag("n", "c_nationkey"), "c_name"))
    return tree.tree_paths(rows, "id", "parent", "label")


@query("""WITH RECURSIVE l AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 > 0 THEN (p_partkey * 7 + p_size * 3) % (SELECT count(*) FROM part) + 1 END AS up FROM part),
  w AS (SELECT id, up, 1 AS n FROM l WHERE up IS NOT NULL UNION ALL SELECT w.id, l.up, n + 1 FROM w JOIN l ON l.id = w.up WHERE n < 300 AND l.up IS NOT NULL AND w.up <> w.id)
  SELECT DISTINCT id FROM w WHERE up = id""")
def parent_cycle_check(spark, sf_dir):
    """Links over all parts; one in seven ends a path, so that no path is longer than the SQL follows it."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    up = F.when(F.col("p_partkey") % 7 > 0, (F.col("p_partkey") * 7 + F.col("p_size") * 3) % parts.count() + 1)
    return tree.parent_cycles(parts.select(F.col("p_partkey").alias("id"), up.alias("up")), "id", "up")


# --- text, batches, decisions --------------------------------------------------------------------------------------


@query("""SELECT doc_id, (p // 500)::INT AS chunk, sha256(substr(text, p + 1, 500)) AS piece_hash FROM (SELECT doc_id, text, unnest(range(0, length(text), 500)) AS p FROM documents)""")
def chunk_text(spark, sf_dir):
    return batching.chunk_text(table(spark, sf_dir, "documents"), "doc_id", "text", 500).select("doc_id", "chunk", F.sha2("piece", 256).alias("piece_hash"))


@query("""SELECT doc_id, sha256(text) AS text_hash FROM documents WHERE length(text) > 0""")
def chunk_reassemble(spark, sf_dir):
    pieces = batching.chunk_text(table(spark, sf_dir, "documents"), "doc_id", "text", 777)
    return batching.reassemble(pieces, "doc_id").select("doc_id", F.sha2("text", 256).alias("text_hash"))


@query("""WITH RECURSIVE s AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
  f AS (SELECT conv_id, turn, rn, 0 AS batch, size AS used FROM s WHERE rn = 1 UNION ALL
    SELECT s.conv_id, s.turn, s.rn, CASE WHEN f.used + s.size > 600 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.used + s.size > 600 THEN s.size ELSE f.used + s.size END FROM f JOIN s ON s.conv_id = f.conv_id AND s.rn = f.rn + 1)
  SELECT conv_id, turn, batch FROM f""")
def greedy_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return batching.greedy_batches(rows, "conv_id", "turn", "size", 600)


@query("""WITH p AS (SELECT doc_id, text, string_split_regex(text, '(?i)licensed?|version') AS between, regexp_extract_all(text, '(?i)licensed?|version') AS found FROM documents),
  m AS (SELECT doc_id, text, found[i] AS match, (list_sum([length(x) FOR x IN between[1:i]]) + coalesce(list_sum([length(x) FOR x IN found[1:i - 1]]), 0))::BIGINT AS start FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM p))
  SELECT doc_id, start, start + length(match) AS "end", match, substr(text, greatest(0, start - 80) + 1, start + length(match) + 80 - greatest(0, start - 80)) AS context FROM m""")
def regex_offsets(spark, sf_dir):
    return batching.regex_spans(table(spark, sf_dir, "documents"), "doc_id", "text", r"licensed?|version")


@query("""SELECT doc_id, lang IN ('en', 'de') AND NOT regexp_matches(text, '[àâçéèêëîïôûùüÿñæœáíóúößä]') AS copied FROM documents""")
def script_routing(spark, sf_dir):
    copied = decisions.copy_if_script(F.lit(None).cast("string"), F.col("text"), F.col("lang"), ["en", "de"], "[àâçéèêëîïôûùüÿñæœáíóúößä]")
    return table(spark, sf_dir, "documents").select("doc_id", copied.isNotNull().alias("copied"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_type, '(?i)economy') THEN 'conflicting_subject' WHEN regexp_matches(p_type, '(?i)standard|large|red|blue') THEN 'matching_subject'
  WHEN regexp_matches(p_name, '(?i)standard|large|red|blue') THEN 'title_only_unverified' ELSE 'no_topic_evidence' END AS reason FROM part""")
def relevance_gate(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", decisions.relevance(F.col("p_type"), F.col("p_name"), "standard|large|red|blue", "economy").alias("reason"))


@query("""WITH r AS (SELECT p_partkey, p_size, p_brand, regexp_matches(p_type, '(?i)standard|large|red|blue') AS s, regexp_matches(p_name, '(?i)standard|large|red|blue') AS t, p_type FROM part)
  SELECT p_partkey, CASE WHEN p_size < 5 THEN 'no_english_edition' WHEN p_size > 45 THEN 'missing_valid_isbn' WHEN (s OR t) AND NOT regexp_matches(p_type, '(?i)large|economy|promo') THEN 'category_subject_unconfirmed'
  WHEN s THEN 'matching_subject' WHEN t THEN 'title_only_unverified' ELSE 'no_subject_evidence' END AS reason FROM r""")
def scope_decision(spark, sf_dir):
    reason = decisions.scope_decision(F.col("p_name"), F.col("p_type"), F.col("p_size") >= 5, F.col("p_size") <= 45, "standard|large|red|blue", category="large|economy|promo")
    return table(spark, sf_dir, "part").select("p_partkey", reason.alias("reason"))


@query("""SELECT doc_id, contains(lower(text), 'license') OR contains(replace(lower(text), ' ', ''), 'thiswork') AS supplement, n >= 3 AND d >= 3 AS usable FROM (
  SELECT doc_id, text, len(string_split(text, chr(10))) AS n, len(list_distinct([lower(trim(x)) FOR x IN string_split(text, chr(10))])) AS d FROM documents)""")
def title_supplement_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", decisions.is_supplement(F.lower("text"), ("license", "this work")).alias("supplement"), decisions.usable_outline(F.split("text", "\n")).alias("usable"))


@query("""SELECT c_custkey, CASE WHEN a LIKE '-%' THEN '''' || a ELSE a END AS cell FROM (SELECT c_custkey, c_acctbal::DECIMAL(12, 2)::VARCHAR AS a FROM customer)""")
def formula_safe_cells(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.formula_safe(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("cell"))


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events WHERE json_extract_string(props, '$.k') IN ('7', '42', '63')""")
def dump_prefilter(spark, sf_dir):
    """Lines without any of the identifiers are dropped by a plain pattern before they are parsed; the exact check follows."""
    rows = table(spark, sf_dir, "events").where(F.col("props").rlike(r'"k": ?(7|42|63)\b'))
    return rows.select("event_id", F.from_json("props", "k long").k.alias("k")).where(F.col("k").isin(7, 42, 63))


@query("""SELECT doc_id, CASE WHEN toxic = 1 OR quality = 0 OR regexp_matches(text, '(?i)licensed') THEN 'review_required' WHEN quality IS NOT NULL THEN 'evidence_present' ELSE 'metadata_only' END AS status,
  concat_ws(',', CASE WHEN quality = 0 THEN 'low_quality' END, CASE WHEN quality IS NULL THEN 'no_label' END, CASE WHEN regexp_matches(text, '(?i)licensed') THEN 'study_aid_marker' END, CASE WHEN toxic = 1 THEN 'toxic_marker' END) AS findings
  FROM documents LEFT JOIN labels USING (doc_id)""")
def selection_audit(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").rlike("(?i)licensed").alias("aid")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    signals = {"low_quality": F.col("quality") == 0, "no_label": F.col("quality").isNull(), "study_aid_marker": F.col("aid"), "toxic_marker": F.col("toxic") == 1}
    findings = F.array_compact(F.array(*[F.when(c, n) for n, c in signals.items()]))
    review = F.arrays_overlap(findings, F.array(*[F.lit(x) for x in ("low_quality", "study_aid_marker", "toxic_marker")]))
    status = F.when(review, "review_required").when(F.col("quality").isNotNull(), "evidence_present").otherwise("metadata_only")
    return rows.select("doc_id", status.alias("status"), F.array_join(findings, ",").alias("findings"))


@query("""WITH b AS (SELECT c_custkey AS book, 0 AS branch, c_custkey AS ordinal, c_name AS title FROM customer UNION ALL
    SELECT o_custkey, 1, o_orderkey, o_orderpriority FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F')
  SELECT book, branch, ordinal, 'evidence_' || substr(sha256('v1' || chr(31) || branch || chr(31) || ordinal), 1, 20) AS evidence_id,
    'sha256:' || sha256('{"book":' || book || ',"branch":' || branch || ',"note":null,"ordinal":' || ordinal || ',"title":"' || title || '"}') AS provenance_hash FROM b""")
def evidence_export(spark, sf_dir):
    books = table(spark, sf_dir, "customer")
    first = books.select(F.col("c_custkey").alias("book"), F.lit(0).alias("branch"), F.col("c_custkey").alias("ordinal"), F.col("c_name").alias("title"))
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").join(books.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    rows = first.unionByName(done.select(F.col("o_custkey").alias("book"), F.lit(1).alias("branch"), F.col("o_orderkey").alias("ordinal"), F.col("o_orderpriority").alias("title")))
    item = F.struct("title", "book", "ordinal", "branch", F.lit(None).cast("string").alias("note"))
    kind = rows.select(item.alias("x")).schema["x"].dataType
    return rows.select("book", "branch", "ordinal", I.stable_id("evidence", F.lit("v1"), F.col("branch"), F.col("ordinal")).alias("evidence_id"), I.sha256_json(item, kind).alias("provenance_hash"))


@query("""SELECT conv_id, turn, round((length(text) * 1.0::DOUBLE + turn * 2.0::DOUBLE) / 1000000, 6) AS cost, CASE WHEN turn % 3 = 0 THEN true WHEN turn % 3 = 1 THEN false END AS label FROM conversations""")
def cost_and_labels(spark, sf_dir):
    label = F.element_at(F.array(F.lit("YES"), F.lit(" 0"), F.lit(" ")), (F.col("turn") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.cost_estimate(F.length("text"), F.col("turn"), 1.0, 2.0).alias("cost"), X.label_value(label).alias("label"))


@query("""SELECT page_id, (i - 1)::INT AS order_index, levels[i]::INT AS level, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(inner_[i], '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title
  FROM (SELECT page_id, unnest(range(1, len(levels) + 1)) AS i, levels, inner_ FROM (SELECT page_id, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>', 1) AS levels, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>', 2) AS inner_ FROM pages))""")
def html_headings_toc(spark, sf_dir):
    from tomewright.sources.html import headings

    return headings(table(spark, sf_dir, "pages"), "page_id", "html")


@query()
def html_identity_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), X.html_text(F.col("html")).alias("text"))


@query("""SELECT page_id, len(regexp_extract_all(html, '<p[ >]'))::INT AS n_p, len(regexp_extract_all(html, '<h1[ >]'))::INT AS n_h1, len(regexp_extract_all(html, '<b[ >]'))::INT AS n_b FROM pages""")
def html_element_counts(spark, sf_dir):
    from tomewright.sources.dom import element_counts

    n = element_counts(F.col("html"), ("p", "h1", "b"))
    return table(spark, sf_dir, "pages").select("page_id", n.alias("n")).select("page_id", *[F.col("n")[k].alias(f"n_{t}") for k, t in enumerate(("p", "h1", "b"))])
