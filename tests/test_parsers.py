import pytest
from pyspark.sql import functions as F

from tessera.operators import markup, parsers


def rows(frame, *columns):
    return [tuple(r[c] for c in columns) for r in frame.orderBy("document_id", "sequence_no").collect()]


def test_plain_text(texts):
    units = parsers.parse_plain_text(texts("\r\n a\nb \n　\n\nc", "", " \n", None))
    assert rows(units, "document_id", "sequence_no", "text", "line_start", "line_end", "paragraph_no") == [("0", 0, " a\nb ", 2, 3, 1), ("0", 1, "c", 6, 6, 2)]
    assert [r.document_id for r in parsers.empty_documents(texts("a", ""), parsers.parse_plain_text(texts("a", ""))).collect()] == ["1"]


MARKDOWN = """# Title
intro
more

- one
2) two
> q1
> q2
### Deep
```py
# not a heading

> nor a quote
```
~~~
open"""


def test_markdown(texts):
    got = rows(markup.parse_markdown(texts(MARKDOWN)), "unit_type", "text", "line_start", "line_end", "heading_path")
    assert got == [
        ("heading", "Title", 1, 1, ["Title"]),
        ("paragraph", "intro\nmore", 2, 3, ["Title"]),
        ("list_item", "one", 5, 5, ["Title"]),
        ("list_item", "two", 6, 6, ["Title"]),
        ("quote", "q1\nq2", 7, 8, ["Title"]),
        ("heading", "Deep", 9, 9, ["Title", "Deep"]),
        ("code_block", "# not a heading\n\n> nor a quote", 10, 14, ["Title", "Deep"]),
        ("code_block", "open", 15, 16, ["Title", "Deep"]),
    ]


HTML = """<html lang="en"><head><title> A  page </title><meta name="author" content="Ann"><link rel="canonical" href="/c"></head><body><nav><p>noise</p></nav>
<article><h1>Top</h1><p>One <b>bold</b></p><p>Two<ul><li>item<p>inner</p></li><li>next</ul>
<table><caption>Cap</caption><tr><th>a<th>b<tr><td>1<td>2</table><h2 id="s">Sub</h2><blockquote>Q</blockquote><pre> x
 y</pre><script>bad()</script></article><p>outside</p></body></html>"""


def test_html(texts):
    got = rows(markup.parse_html(texts(HTML)), "unit_type", "text", "row_no", "parent_sequence_no", "paragraph_no")
    assert got == [
        ("heading", "Top", None, None, None), ("paragraph", "One bold", None, None, 1), ("paragraph", "Two", None, None, 2),
        ("list_item", "item inner", None, None, None), ("list_item", "next", None, None, None), ("table", "Cap\na | b\n1 | 2", None, None, None),
        ("table_row", "a | b", 1, 5, None), ("table_row", "1 | 2", 2, 5, None), ("heading", "Sub", None, None, None), ("quote", "Q", None, None, None),
        ("code_block", " x\n y", None, None, None),
    ]
    places = dict(rows(markup.parse_html(texts(HTML)), "text", "css_selector"))
    assert places["Sub"] == "article:nth-of-type(1) > h2#s" and places["One bold"] == "article:nth-of-type(1) > p:nth-of-type(1)"
    report = markup.html_reports(texts(HTML, "<p>x", "")).orderBy("document_id").collect()
    assert (report[0].title, report[0].author, report[0].canonical_url, report[0].language, report[0].parse_status) == ("A page", "Ann", "/c", "en", "parsed")
    assert report[1].warnings == ["HTML_FALLBACK_TO_DOCUMENT"] and report[1].parse_status == "partially_parsed" and report[2].parse_status == "failed"


def test_deep_html_does_not_recurse(texts):
    assert rows(markup.parse_html(texts("<div>" * 3000 + "<p>deep")), "text") == [("deep",)]


SRT = """1
00:00:01,000 --> 00:00:04,000
Ann: Hello &amp; <i>hi</i>

2
00:00:05,000 --> 00:00:08,000
plain

3
00:00:07,000 --> 00:00:09,000
<b></b>

4
00:00:07,500 --> 00:00:09,000
late"""


def test_srt(texts):
    cues = parsers.transcript_cues(texts(SRT), "srt")
    units = parsers.transcript_units(cues)
    assert rows(units, "sequence_no", "text", "speaker", "start_seconds", "quality_flags") == [(0, "Hello & hi", "Ann", 1.0, []), (1, "plain", None, 5.0, []), (2, "late", None, 7.5, ["TRANSCRIPT_OVERLAP"])]
    report = parsers.transcript_report(cues).first()
    assert (report.caption_count, report.overlap_count, report.dropped_count, report.parse_status) == (3, 1, 1, "partially_parsed")


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ("1\nno timing\nx", "TRANSCRIPT_PARSE_FAILED"),
        ("00:00:02,000 --> 00:00:01,000\nx", "TRANSCRIPT_INVALID_TIMESTAMP"),
        ("0:2 --> 1\nx", "TRANSCRIPT_INVALID_TIMESTAMP"),
        ("00:00:02,000 --> 00:00:03,000\nx\n\n00:00:01,000 --> 00:00:03,000\ny", "TRANSCRIPT_NON_MONOTONIC"),
        ("00:00:02,000 --> 00:00:03,000\n ", "TRANSCRIPT_EMPTY"),
    ],
)
def test_bad_transcripts(texts, text, error):
    cues = parsers.transcript_cues(texts(text), "srt")
    assert parsers.transcript_report(cues).first().error == error
    if error != "TRANSCRIPT_EMPTY":
        assert parsers.transcript_units(cues).count() == 0


def test_vtt(texts):
    text = "WEBVTT\n\nNOTE skip\nthis\n\n00:01.000 --> 00:02.000 align:start\n<v.loud Bob B>Hi\nthere</v>"
    assert rows(parsers.transcript_units(parsers.transcript_cues(texts(text), "vtt")), "text", "speaker") == [("Hi\nthere", "Bob B")]


def test_page_selection(spark):
    given = [("1,3,5-7", 9), ("2-2,1", 2), (None, 2), ("0", 3), ("4", 3), ("3-1", 3), ("a", 3), ("1", 0)]
    frame = spark.createDataFrame([(i, e, n) for i, (e, n) in enumerate(given)], "i int, e string, n int")
    got = [r.p for r in frame.select("i", parsers.page_selection(F.col("e"), F.col("n")).alias("p")).orderBy("i").collect()]
    assert got == [[1, 3, 5, 6, 7], [2, 1], [1, 2], None, None, None, None, []]


def test_headings(spark):
    given = ["第三章 概况", "1.2 Scope", "TOTAL NET 5", "Plain words", "A" * 81, "123"]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x string")
    assert [r.h for r in frame.select("i", parsers.looks_like_heading(F.col("x")).alias("h")).orderBy("i").collect()] == [True, True, True, False, False, False]


def test_pdf_rows_before_other_lines(spark):
    pages = [("d", 1, "line", 1, "A  1"), ("d", 1, "table_row", 1, "A 1"), ("d", 1, "line", 2, "text here"), ("d", 2, "line", 1, "TITLE")]
    units = parsers.pdf_units(spark.createDataFrame(pages, "document_id string, page_no int, kind string, row_no int, text string"))
    assert rows(units, "unit_type", "text", "page_no", "paragraph_no", "row_no") == [("table_row", "A 1", 1, None, 1), ("paragraph", "text here", 1, 1, None), ("heading", "TITLE", 2, 1, None)]
