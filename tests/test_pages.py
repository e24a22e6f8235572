"""Outlines and identity of reviewed pages, and lookups by ISBN, on invented pages."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tomewright.operators.outlines import contents_levels, placed_entries, store_entries, store_outline
from tomewright.plans import api_toc, pages
from tomewright.sources import dom
from tomewright.sources.page_outlines import FOOTER, read_outline


def catalog(body: str, extra: str = "") -> str:
    return f'<html><body>{extra}<div class="summary"><h2>Summary</h2><div class="content">About it</div><h2>Table of Contents</h2>\n<div class="content">{body}</div></div></body></html>'


def outline(kind: str, page: str, **spec):
    error, rows = read_outline(page, {"toc_format": kind, **spec})
    return error or [(r["level"], r["label"], r["title"], r["parent"]) for r in rows]


def test_tree_mends_open_tags():
    root = dom.tree('<ul><li>a<li>b <b>c</b></ul><p class="x y">d<p>e<br>f<script>no</script>')
    assert [n.text() for n in root.all("li")] == ["a", "b c"] and [n.text() for n in root.all("p")] == ["d", "e f"]
    assert root.first("p", "y").fits("p", "x") and root.text() == "a b c d e f"
    assert dom.tree(None).text() == "" and dom.structured(dom.tree('<script type="application/ld+json">{bad</script><script type="application/ld+json">[{"@type":["Book"],"isbn":"1"}]</script>')) == [{"@type": ["Book"], "isbn": "1"}]
    assert len(dom.tree("<div>" * 5000 + "deep").all("div")) == 5000


def test_headings_and_paragraphs():
    head = '<div class="chapterTitle"><h3>{}</h3></div>'
    assert outline("chapter_headings", head.format("Chapter 1: One") + head.format("Appendix A: More")) == [(1, "1", "One", None), (1, "A", "More", None)]
    assert outline("chapter_headings", head.format("Chapter 1: One") * 2) == "repeated heading"
    assert outline("heading_sequence", catalog("<h3>Part One: P</h3><h3>1 A</h3><h3>Part Two: Q</h3><h3>2 B</h3>")) == [(1, "Part One", "P", None), (2, "1", "A", 0), (1, "Part Two", "Q", None), (2, "2", "B", 2)]
    assert outline("heading_sequence", catalog("<h3>1 A</h3>")).startswith("unsupported")
    assert outline("paragraph_sequence", catalog("<p>PART 1. P</p><p>Chapter 1. A</p>")) == [(1, "PART 1", "P", None), (2, "1", "A", 0)]
    assert "outside" in outline("paragraph_sequence", catalog("<p>PART 1. P</p>loose"))
    bold = catalog("<p>Preface ix</p><p><b>1 A 1</b></p><p>1.1 S 2</p><p>Notes 3</p><p>Index 9</p>")
    assert outline("bold_chapter_paragraphs", bold) == [(1, None, "Preface", None), (1, "1", "A", None), (2, "1.1", "S", 1), (2, None, "Notes", 1), (1, None, "Index", None)]
    assert "partly bold" in outline("bold_chapter_paragraphs", catalog("<p><b>1 A</b> 1</p>"))


def test_flat_and_tables():
    assert outline("flat_bold", catalog("<b>1. A</b><br><b>Index</b>")) == [(1, "1", "A", None), (1, None, "Index", None)]
    row = "<tr><td>{}</td></tr>"
    assert outline("flat_table", catalog(f"<table>{row.format('A')}{row.format('B')}{row.format(FOOTER)}</table>")) == [(1, None, "A", None), (1, None, "B", None)]
    assert outline("flat_table", catalog(f"<table>{row.format('A')}</table>")) == "footer changed"
    assert outline("flat_periods", catalog("A b. C. D.")) == [(1, None, "A b", None), (1, None, "C", None), (1, None, "D", None)]
    deep = lambda w, t: f'<tr><td><table><tbody><tr><td width="{w}"></td><td>{t}</td></tr></tbody></table></td></tr>'
    page = catalog(f"<table><tbody>{row.format('Part')}{deep(20, 'C1')}{deep(40, 'S')}{deep(60, 'Appendix 1A x')}{deep(20, 'C2')}{row.format(FOOTER)}</tbody></table>")
    assert outline("indented_table", page) == [(1, None, "Part", None), (2, None, "C1", 0), (3, None, "S", 1), (3, None, "Appendix 1A x", 1), (2, None, "C2", 0)]
    assert [r[0] for r in outline("indented_table_chapter_roots", page)] == [1, 1, 2, 2, 1]
    assert outline("indented_table", catalog(f"<table>{deep('x', 'C')}</table>")) == "malformed indent"
    sec = "<tr><td>{}</td><td>{}</td></tr>"
    author = f"<h3>Preface ix</h3><h3>Chapter 1 A 1</h3><table>{sec.format('1.1', 'S 2')}{sec.format('', 'Exercises 9')}{sec.format('1.1.1', 'T 3')}</table><h3>Appendix 1 Z 9</h3><table>{sec.format('A1.1', 'Y 9')}</table>"
    assert outline("xinu_author_table", author) == [(1, None, "Preface", None), (1, "1", "A", None), (2, "1.1", "S", 1), (2, None, "Exercises", 1), (3, "1.1.1", "T", 2), (1, "A1", "Z", None), (2, "A1.1", "Y", 5)]
    assert "misplaced" in outline("xinu_author_table", f"<h3>Chapter 1 A 1</h3><table>{sec.format('2.1', 'S 2')}</table>")


def test_publisher_lists_and_textbooks():
    item = '<li data-test="chapter"><h3 class="app-card-open__heading" data-test="{}">{}</h3><span data-test="page-number">Pages {}</span></li>'
    box = '<section data-title="Table of contents"><ul>{}</ul></section>'
    link = '<a href="/chapter/10.1/x_{0}">C{0}</a>'
    page = box.format(item.format("front-matter", "Front Matter", "i-x") + item.format("", link.format(1), "1-9") + item.format("", link.format(2), "10-19"))
    assert outline("springer_book_chapters", page, source_edition_id="10.1/x") == [(1, None, "Front Matter", None), (1, "1", "C1", None), (1, "2", "C2", None)]
    assert "sequence" in outline("springer_book_chapters", box.format(item.format("", link.format(2), "1-9")), source_edition_id="10.1/x")
    assert outline("springer_landing", '<div data-title="book-toc"><div data-test="chapter"><h3>A</h3></div></div>') == [(1, None, "A", None)]
    lists = '<div id="content"><ul><li><a>Preface</a><li><a>Contents</a><li><a>A</a><ul><li><a>B</a><li><a>C</a></ul><li><a>D</a></ul></div>'
    assert outline("think_os_html", lists) == [(1, None, "A", None), (2, None, "B", 0), (2, None, "C", 0), (1, None, "D", None)]
    coded = '<nav id="ptx-toc"><ul><li class="toc-frontmatter"><li class="toc-chapter"><div class="toc-title-box"><a><span class="codenumber">1</span><span class="title">A</span></a></div></ul></nav>'
    assert outline("pretext_html", coded) == [(1, "1", "A", None)]
    libre = '<h1 id="titleHolder">2: R</h1><section class="mt-content-container"><ul><li class="mt-list-topics"><dl><dt class="mt-listing-detailed-title"><a>2.1: S</a></dt></dl><ul><li class="mt-list-topics-childs"><a>2.1.1: T</a></li></ul></li></ul></section>'
    assert outline("libretexts_html", libre, root_index=1) == [(1, "2", "R", None), (2, "2.1", "S", 0), (3, "2.1.1", "T", 1)]
    groups = ("Intro", "Virtualization", "Concurrency", "Persistence", "Security")
    cells = "".join(f'<td bgcolor="x"><b>{g}</b></td>' for g in groups) + "".join(f'<td bgcolor="y"><small>{n}</small><a href="{n}.pdf">T{n}</a></td>' for n in range(57, 0, -1))
    got = outline("ostep_chapter_pdfs", f"<table><tr>{cells}</tr></table>")
    assert len(got) == 62 and got[0] == (1, None, "Intro", None) and got[3:5] == [(1, None, "Virtualization", None), (2, "3", "T3", 3)]
    assert outline("nothing", "") == "unknown format: nothing" and outline("flat_bold", None) == "no page" and outline("flat_bold", "") == "no contents section"


SPEC = {"slug": "s", "provider": "shop", "topic": "t", "book_id": "isbn13:1", "isbn_13": "1", "title": "A Book", "edition": 2, "url": "u", "toc_format": "heading_sequence", "expected_toc_count": 4, "expected_root_titles": ["P", "Q"], "expected_chapter_labels": ["1", "2"], "expected_child_counts": [1, 1], "expected_child_label_groups": [["1"], ["2"]], "expected_descendant_counts": [1, 1]}
HEAD = '<h1 class="title">A  book</h1><span itemprop="isbn">1</span><span itemprop="bookEdition">2nd</span>'
BODY = "<h3>Part One: P</h3><h3>1 A</h3><h3>Part Two: Q</h3><h3>2 B</h3>"


def test_catalog_pages(spark):
    specs = pages.registry(spark, [SPEC, SPEC | {"slug": "n", "expected_descendant_counts": [2, 0]}])
    good = catalog(BODY, HEAD)
    rows = [("s", "t", "u", good), ("s", "x", "u", good), ("s", "t", "v", good), ("s", "t", "u", None), ("s", "t", "u", catalog(BODY)), ("s", "t", "u", catalog("<h3>1 A</h3>", HEAD)), ("n", "t", "u", good), ("?", "t", "u", good)]
    df = spark.createDataFrame([(*r[:2], "2026-09-01", *r[2:]) for r in rows], "source_slug string, topic string, retrieved_at string, url string, html string")
    got = pages.catalog_pages(df, specs)
    assert sorted(str(r.reason) for r in got.pages.collect()) == sorted(["None", "topic", "url", "no_page", "identity", "outline_format", "descendant_counts", "unknown_source"])
    toc = got.data.toc.orderBy("order_index").collect()
    assert [t.parent_entry_id for t in toc] == [None, toc[0].toc_entry_id, None, toc[2].toc_entry_id]
    s, d = got.data.sources.first(), got.data.documents.first()
    assert (s.external_id, s.evidence.tier, s.evidence.match_basis[0], d.text, d.source_id) == ("1", "exact_edition_toc", "exact_isbn", "About it", s.source_id)
    assert pages.catalog_pages(df.limit(0), specs).data.toc.count() == 0


def test_publisher_landing_textbook_preface(spark):
    pub = {"slug": "w", "provider": "pub", "topic": "t", "book_id": "b", "isbn_10": "123", "title": "A Book", "edition": 7, "home_url": "h", "toc_url": "c", "expected_toc_labels": ["1"]}
    df = spark.createDataFrame([("w", "t", "2026-09-01", "h", "c", "<p>A book, 7th edition 123</p>", '<div class="chapterTitle"><h3>Chapter 1: One</h3></div>')], "source_slug string, topic string, retrieved_at string, home_url string, toc_url string, home_html string, toc_html string")
    got = pages.publisher_pages(df, pages.registry(spark, [pub]))
    assert got.pages.first().reason is None and got.data.sources.count() == 2 and got.data.toc.first().title == "One"
    assert pages.publisher_pages(df, pages.registry(spark, [pub | {"edition": 8}])).pages.first().reason == "edition"
    land = {"slug": "l", "topic": "t", "book_id": "b", "isbn_13": "9", "title": "A Book", "url": "u", "doi": "d", "ebook_isbn": "12", "springer_edition_label": "3rd edition", "edition_relation": "same_work", "expected_entry_titles": ["A"]}
    body = '<script type="application/ld+json">{"@type": "Book", "isbn": "1-2", "name": "A book", "bookEdition": 3}</script><div data-title="book-toc"><div data-test="chapter"><h3>A</h3></div></div>'
    df = spark.createDataFrame([("l", "t", "2026-09-01", "u", body)], "source_slug string, topic string, retrieved_at string, url string, html string")
    got = pages.landing_pages(df, pages.registry(spark, [land]))
    s = got.data.sources.first()
    assert got.pages.first().reason is None and (s.evidence.tier, s.evidence.same_edition, s.provider) == ("same_work_alternate_edition_toc", False, "springer")
    text = {"slug": "o", "provider": "os", "topic": "t", "book_id": "b", "title": "Open", "authors": ["Ann"], "home_url": "h", "published_year": 2015, "source_format": "think_os_html"}
    home = '<p>Open by Ann, 2015</p><div id="content"><ul><li><a>Preface</a><li><a>Contents</a><li><a>A</a></ul></div>'
    df = spark.createDataFrame([("o", "t", "2026-09-01", "h", home)], "source_slug string, topic string, retrieved_at string, home_url string, home_html string")
    got = pages.textbook_pages(df, pages.registry(spark, [text]), {"t": ["cs", "t"]})
    assert got.pages.first().reason is None and got.data.books.first().topics == ["cs", "t"] and got.data.toc.count() == 1
    said = "가" * 130 + " - 머리말 중에서"
    body = f'<h2 id="sit_title">[ 책 ]</h2><table class="sit_ov_tbl"><tr><th>ISBN</th><td>978-1</td></tr></table><div id="sit_introduce_explan"><p hidden>x</p>{said}</div>'
    url = "https://www.kyungmoon.com/shop/item.php?it_id=5"
    df = spark.createDataFrame([("b", "2026-09-01", url, body), ("b", "2026-09-01", "http://else", body)], "book_id string, retrieved_at string, url string, html string")
    books = spark.createDataFrame([("b", "9781", "책", "ko")], "book_id string, isbn_13 string, title string, language string")
    got = pages.preface_excerpts(df, books)
    assert sorted(str(r.reason) for r in got.pages.collect()) == ["None", "url"] and got.data.documents.first().text == said


def test_contents_levels():
    blob = "Part 1 Basics<br>Chapter<br>1 Intro\t12<p>1.1 Why</p>Alpha. Beta. Gamma.<br>2장 Next<br>&nbsp;<br>Summary"
    assert [r[1:] for r in contents_levels(blob)] == [(1, None, "Part 1 Basics"), (2, "1", "Intro"), (3, "1.1", "Why"), (4, None, "Alpha"), (4, None, "Beta"), (4, None, "Gamma"), (2, "2", "Next"), (3, None, "Summary")]
    assert contents_levels(None) == []


def test_lookups(spark):
    books = spark.createDataFrame([("b", "9783", "T", ["A"]), ("c", "9784", "T", ["A"])], "book_id string, isbn_13 string, title string, authors array<string>")
    rec = lambda n, t, isbn="978-3", kind="Chapter": {"contentType": kind, "printIsbn": isbn, "electronicIsbn": "E1", "doi": f"10.1007/978-3_{n}", "title": t}
    body = {"pages": [{"response": {"records": [rec(10, "Ten."), rec(2, "Two"), rec(2, "Again")]}}, {"response": {"records": [rec(1, " One"), rec(5, "x", "978-9"), rec(6, "y", kind="Book")]}}]}
    few = {"pages": [{"response": {"records": [rec(1, "One", "978-4")]}}]}
    to_rows = lambda xs: spark.createDataFrame([(b, "2026-09-01 00:00:00", json.dumps(x)) for b, x in xs], "book_id string, at string, j string").select("book_id", F.to_timestamp("at").alias("retrieved_at"), F.parse_json("j").alias("response"))
    got = api_toc.chapter_records(to_rows([("b", body), ("c", few)]), books)
    assert {r.book_id: r.reason for r in got.responses.collect()} == {"b": None, "c": "no_outline"}
    assert [(r.label, r.title, r.level) for r in got.data.toc.orderBy("order_index").collect()] == [("1", "One", 1), ("2", "Two", 1), ("10", "Ten", 1)]
    assert got.data.sources.first().external_id == "10.1007/E1"
    store = {"data": {"data": {"itemId": 7, "contents": "1 A<br>1.1 B<br>2 C"}}}
    got = api_toc.store_contents(to_rows([("b", store), ("c", {"success": False, "errorCode": "GOODS_001"})]), books)
    assert {r.book_id: r.reason for r in got.responses.collect()} == {"b": None, "c": "no_outline"} and got.data.toc.count() == 3
    for bad in ({"success": False, "errorCode": "X"}, {"data": {"data": {"itemId": True}}}):
        with pytest.raises(Exception, match="lookup failed|itemId"):
            api_toc.store_contents(to_rows([("b", bad)]), books).data.sources.collect()


def test_registry_files(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(SPEC, indent=1))
    assert pages.load_registry(spark, f"file://{tmp_path}").first().expected_child_label_groups == [["1"], ["2"]]
    (tmp_path / "other.json").write_text(json.dumps(SPEC))
    with pytest.raises(Exception, match="named by its slug"):
        pages.load_registry(spark, f"file://{tmp_path}").collect()


def tree_of(blob):
    rows = store_entries(blob)
    return [(level, label, title, rows[up][3] if up is not None else None) for _, level, label, title, up in rows]


def test_bookstore_outlines_make_no_level_the_text_does_not_have():
    first = "<b>Chapter 01 시작</B>\r\n\r\n01-1 이유\t\r\n__해결\t\r\n[확인]\r\n01-2 그림\r\n<B>Chapter 02 자료</B>\r\n"
    assert tree_of(first) == [(1, None, "Chapter 01 시작", None), (2, "01-1", "이유", "Chapter 01 시작"), (3, None, "해결", "이유"), (1, None, "확인", None), (2, "01-2", "그림", "Chapter 01 시작"), (1, None, "Chapter 02 자료", None)]
    second = "<b>PART 01 컴퓨터</b>\r\nCHAPTER 01 개요\r\n01 개념\r\n1.2 유형\r\n1.2.1 일괄\r\n제2장 과정\r\n\t1. 뜻\r\n"
    assert tree_of(second) == [
        (1, "01", "컴퓨터", None), (2, None, "CHAPTER 01 개요", "컴퓨터"), (3, "01", "개념", "CHAPTER 01 개요"), (3, "1.2", "유형", "CHAPTER 01 개요"), (4, "1.2.1", "일괄", "유형"),
        (2, None, "제2장 과정", "컴퓨터"), (3, "1", "뜻", "제2장 과정"),
    ]
    assert tree_of("<b>PART 1 주제</b>\r\n01 독해<br/>02 관계\r\n") == [(1, "1", "주제", None), (2, "01", "독해", "주제"), (2, "02", "관계", "주제")]
    assert tree_of("1장 벡터\r\n1.1 내적\r\n1장에 대한 말\r\n1.2 각\r\n[부록]\r\n1.3 남은 것\r\n『책』\r\n") == [
        (1, None, "1장 벡터", None), (2, "1.1", "내적", "1장 벡터"), (1, None, "1장에 대한 말", None), (2, "1.2", "각", "1장 벡터"), (1, None, "부록", None), (1, "1.3", "남은 것", None),
    ]
    assert tree_of("PART 0. 기초\r\n\t0-1. 집합\r\n\t0-2. 연산\r\n") == [(1, "0", "기초", None), (2, "0-1", "집합", "기초"), (2, "0-2", "연산", "기초")]
    assert tree_of(None) == tree_of("  \n") == []


def test_bookstore_ids_come_from_place_and_title(spark):
    rows = spark.createDataFrame([("b", "s", "1장 벡터\n요약\n2장 행렬\n요약\n")], "book string, source string, blob string").withColumn("entries", store_outline(F.col("blob")))
    got = placed_entries(rows, "book", "source", "entries").orderBy("order_index").collect()
    want = ["toc_" + hashlib.sha256("\x1f".join(("b", "s", str(k), t)).encode()).hexdigest()[:20] for k, t in enumerate(("1장 벡터", "요약", "2장 행렬", "요약"))]
    assert [r.toc_entry_id for r in got] == want and [r.order_index for r in got] == [0, 1, 2, 3] and len(set(want)) == 4
