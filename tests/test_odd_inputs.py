"""Registered queries on inputs that the small tables don't hold."""

import duckdb
import pytest

from tests.test_queries import norm
from tomewright.plans import catalog_queries, source_queries  # noqa: F401  (add to the queries)
from tomewright.plans.queries import QUERIES, SQL


@pytest.fixture
def same(spark, tmp_path):
    """Checks a query against its SQL on tables given as SQL."""

    def run(name: str, **tables: str) -> int:
        con = duckdb.connect()
        for t, sql in tables.items():
            con.execute(f"COPY ({sql}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        got, expected = QUERIES[name](spark, str(tmp_path)).toPandas(), con.execute(SQL[name]).fetchdf()
        assert norm(got) == norm(expected)
        return len(got)

    return run


PAGES = (
    "<h1>Cut off&amp;&amp</h1><h2>&lt;b&gt; &quot;q&quot; &amp;lt; &copy; &#65;</h2>", "<h1></h1><h2> <b> </b></h2>", "<H1>upper</H1><h1>mixed</h2><h3 class='a\nb'>attr</h3>", "<h1>open <h2>inner</h2> after</h1>", "<h1>a<p>b\n\t c</p>d\v e </h1>",
    "<!-- <h1>hidden</h1> --><script><h4>x</h4></script><header>no</header>", "<h1>never closed", "<h1", "<h2>a < b > c << d</h2 ></h2>", "", "<h7>x</h7><h1x>y</h1><h1>ü z</h1>",
)


def test_headings_of_odd_pages(same):
    rows = ", ".join(f"({k}::BIGINT, '{p.replace(chr(39), chr(39) * 2)}')" for k, p in enumerate(PAGES))
    assert same("html_headings_toc", pages=f"SELECT * FROM (VALUES {rows}, (99, NULL)) t(page_id, html)") > 10


def test_open_headings_take_one_pass():
    from tomewright.sources.html import heading_text, page_headings

    assert list(page_headings("<h1>" * 200_000)) == list(page_headings("<h1" * 200_000)) == []
    assert heading_text("<" * 200_000) == "<" * 200_000


def test_editions_of_one_work_are_counted_without_pairs(spark):
    """As pairs these would be 900 million rows."""
    from pyspark.sql import functions as F

    from tomewright.sources import dump

    n = 30_000
    toc = F.transform(F.sequence(F.lit(1), F.when(F.col("id") % 3 == 0, 3).otherwise(1)), lambda i: F.struct(F.lit(0).alias("level"), F.concat(F.lit("C"), i.cast("string")).alias("title")))
    rows = spark.range(n + 1).withColumn("edition_key", F.col("id").cast("string"))
    none = F.array().cast("array<string>")
    full = rows.select("edition_key", F.when(F.col("id") < n, "w").alias("work_key"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("subtitle"), none.alias("source_records"), toc.alias("toc"))
    isbns = rows.select((F.col("id") - F.when(F.col("id") % 5 == 0, F.least("id", F.lit(1))).otherwise(0)).alias("isbn"), "edition_key").unionByName(rows.where("id = 7").select(F.lit(n).cast("long").alias("isbn"), "edition_key"))
    got = dump.inspect_tables(full, isbns, isbns.select("isbn"))
    one = {r.isbn: tuple(r)[1:] for r in got.where("isbn IN (1, 4, 30000)").collect()}
    assert one == {1: (1, 0, n - 1, n // 3), 4: (2, 0, n - 2, n // 3), n: (1, 0, n - 1, n // 3)}
    assert got.where("isbn NOT IN (4, 30000)").agg(F.sum("alternates"), F.count("*")).first()[1] > n * 3 // 4


def test_items_do_not_carry_their_response(spark):
    import json

    from pyspark.sql import functions as F

    from tomewright.plans import providers

    doc = lambda i: {"key": f" /works/{i} ", "title": f"On tools {i}", "author_name": ["A"], "editions": {"docs": [{"key": f"/books/{i}", "title": f"On tools {i}", "language": ["eng"]}]}}
    body = {"docs": [*map(doc, range(300)), {"key": None}, None], "work_details": {f"/works/{i}": {"subjects": ["rusty"] if i % 2 else []} for i in range(200)}, "edition_details": {"/books/250": {"by_statement": "by " + ", ".join(f"N{i}" for i in range(12))}}}
    rows = spark.createDataFrame([("r", "t", json.dumps(body)), ("empty", "t", "{}")], "response_id string, topic string, response string")
    rows = rows.select("response_id", "topic", F.timestamp_seconds(F.lit(0)).alias("retrieved_at"), F.parse_json("response").alias("response"))
    assert "response" not in providers.items(rows, "$.docs", apart=True).columns
    found = providers.open_library(rows, providers.Topic("t", "d", "tools", "rusty"), 1000, gate=True)[1]
    got = {r.pos: r.reason for r in found.select("pos", "reason").collect()}
    assert len(got) == 302 and got[300] == got[301] == "no_english_edition"
    assert all(got[i] == ("conflicting_subject" if i < 200 and i % 2 else None) for i in range(300))


@pytest.mark.parametrize("clamp", [True, False])
def test_outlines_are_placed_without_joins(spark, clamp):
    import random

    from pyspark.sql import functions as F

    from tomewright.operators.outlines import outline_entries
    from tomewright.operators.tree import levels_to_parents

    rng = random.Random(5)
    rows = [(f"b{b}", "s" if b else None, [(p, rng.randint(b % 3, 4), rng.choice([None, " ", f"{p}"]), rng.choice([f" T{p}", "", "T"])) for p in rng.sample(range(90), 30)]) for b in range(12)]
    df = spark.createDataFrame(rows, "book string, source string, entries array<struct<pos:int,level:int,label:string,title:string>>")
    out = outline_entries(df, "book", "source", "entries", clamp)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    kept = df.select("book", F.explode("entries").alias("e")).select("book", "e.pos", "e.level", F.trim("e.title").alias("title")).where("title <> ''")
    placed = {(r.book, r.pos): r for r in levels_to_parents(kept, "book", "pos", "level", clamp).collect()}
    titles = {(r.book, r.pos): r.title for r in kept.collect()}
    got = out.collect()
    name = {r.toc_entry_id: r.title for r in got}
    of = lambda book, title, level, up, nth: (book, title, level, up, nth)
    assert sorted(map(str, (of(r.book_id, r.title, r.level, name.get(r.parent_entry_id), r.order_index) for r in got))) == sorted(map(str, (of(b, titles[b, p], r.level, titles.get((b, r.parent)), r.order_index) for (b, p), r in placed.items())))
