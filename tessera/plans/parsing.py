"""Parsers over driver tables (survey C, H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import markup, parsers
from tessera.session import table


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with every third line blank: the texts have no blank lines of their own."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 3 == 2, F.lit("  ")).otherwise(x))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.array_join(lines, "\n").alias("text"))


def plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = parsers.parse_plain_text(_gapped(spark, sf_dir))
    return units.select("document_id", *(F.col(c).cast("long").alias(c) for c in ("sequence_no", "line_start", "line_end", "paragraph_no")), F.sha2("text", 256).alias("sha"))


_PLAIN_SQL = r"""
WITH l AS (SELECT doc_id, i, CASE WHEN i % 3 = 0 THEN '  ' ELSE string_split(text, chr(10))[i] END AS line FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)),
b AS (SELECT *, NOT regexp_matches(line, '[^\s\p{Z}]') AS blank FROM l),
g AS (SELECT *, sum(CASE WHEN blank THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM b),
p AS (SELECT doc_id, min(i) AS line_start, max(i) AS line_end, string_agg(line, chr(10) ORDER BY i) AS text FROM g WHERE NOT blank GROUP BY doc_id, island)
SELECT CAST(doc_id AS VARCHAR) AS document_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_start) - 1 AS sequence_no, line_start, line_end,
       row_number() OVER (PARTITION BY doc_id ORDER BY line_start) AS paragraph_no, sha256(text) AS sha FROM p"""


def _cue_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transcript for each hundred users, one cue an event: some empty, some overlapping, a few out of order."""
    e = table(spark, sf_dir, "events")
    start = (F.col("event_id") % 1000) * 2 - F.when(F.col("event_id") % 997 == 0, 50).otherwise(0)
    stamp = lambda s: F.concat(F.lpad((s / 3600).cast("int").cast("string"), 2, "0"), F.lit(":"), F.lpad((s / 60).cast("int").cast("string"), 2, "0"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"), F.lit(",500"))
    begin = F.greatest(start, F.lit(0))
    body = F.when(F.col("event_id") % 11 == 0, F.lit("<i></i>")).otherwise(F.concat(F.lit("Ann B: <b>"), F.col("event_type"), F.lit("</b> &amp; more")))
    cue = F.concat(F.col("event_id").cast("string"), F.lit("\n"), stamp(begin), F.lit(" --> "), stamp(begin + 1 + F.col("event_id") % 3), F.lit("\n"), body)
    rows = e.select((F.col("event_id") / 1000).cast("long").alias("d"), "event_id", cue.alias("cue"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "cue"))), lambda x: x["cue"]), "\n\n")
    return rows.groupBy("d").agg(joined.alias("text")).select(F.col("d").cast("string").alias("document_id"), "text")


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    cues = parsers.transcript_cues(_cue_docs(spark, sf_dir), "srt")
    return cues.select("document_id", F.col("block_no").cast("long").alias("block_no"), "start_seconds", "end_seconds", F.coalesce("speaker", F.lit("")).alias("speaker"), "text", F.coalesce("code", F.lit("")).alias("code"))


_CUES_SQL = """
WITH e AS (SELECT event_id, event_id // 1000 AS d, greatest((event_id % 1000) * 2 - CASE WHEN event_id % 997 = 0 THEN 50 ELSE 0 END, 0) AS s, event_id % 11 = 0 AS bare, event_type FROM events),
c AS (SELECT d, event_id, row_number() OVER (PARTITION BY d ORDER BY event_id) AS block_no, (s // 3600) * 3600 + (s // 60) * 60 + s % 60 + 0.5 AS a,
             ((s + 1 + event_id % 3) // 3600) * 3600 + ((s + 1 + event_id % 3) // 60) * 60 + (s + 1 + event_id % 3) % 60 + 0.5 AS b, bare, event_type FROM e),
k AS (SELECT *, last_value(CASE WHEN NOT bare THEN a END IGNORE NULLS) OVER (PARTITION BY d ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kept FROM c)
SELECT CAST(d AS VARCHAR) AS document_id, block_no, CAST(a AS DOUBLE) AS start_seconds, CAST(b AS DOUBLE) AS end_seconds, CASE WHEN bare THEN '' ELSE 'Ann B' END AS speaker,
       CASE WHEN bare THEN '' ELSE event_type || ' & more' END AS text, CASE WHEN a < kept THEN 'TRANSCRIPT_NON_MONOTONIC' WHEN bare THEN 'TRANSCRIPT_EMPTY_CUE_DROPPED' ELSE '' END AS code FROM k"""


def transcript_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsers.transcript_report(parsers.transcript_cues(_cue_docs(spark, sf_dir), "srt")).select("document_id", "caption_count", "overlap_count", "dropped_count", F.coalesce("error", F.lit("")).alias("error"), "parse_status")


_REPORT_SQL = f"""
WITH q AS ({_CUES_SQL}), f AS (SELECT document_id, count(*) FILTER (code = 'TRANSCRIPT_EMPTY_CUE_DROPPED') AS dropped_count, coalesce(min(code) FILTER (code = 'TRANSCRIPT_NON_MONOTONIC'), '') AS error FROM q GROUP BY ALL),
u AS (SELECT document_id, start_seconds < lag(end_seconds) OVER (PARTITION BY document_id ORDER BY block_no) AS o FROM q JOIN f USING (document_id) WHERE code = '' AND error = ''),
n AS (SELECT document_id, count(*) AS caption_count, count(*) FILTER (o) AS overlap_count FROM u GROUP BY ALL)
SELECT document_id, coalesce(caption_count, 0) AS caption_count, coalesce(overlap_count, 0) AS overlap_count, dropped_count, error,
       CASE WHEN error <> '' THEN 'failed' WHEN dropped_count > 0 OR overlap_count > 0 THEN 'partially_parsed' ELSE 'parsed' END AS parse_status FROM f LEFT JOIN n USING (document_id)"""


def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    form = F.col("p_partkey") % 4
    size = F.col("p_size").cast("string")
    text = F.when(form == 0, F.concat(F.lit("1, "), size, F.lit("-"), (F.col("p_size") + 2).cast("string"))).when(form == 1, F.concat(size, F.lit(",1-2"))).when(form == 2, F.lit(" ")).otherwise(F.lit("3-1"))
    pages = parsers.page_selection(F.col("expression"), F.lit(50))
    return p.select("p_partkey", text.alias("expression")).select("p_partkey", F.coalesce(F.array_join(pages, ","), F.lit("invalid")).alias("pages"))


_PAGES_SQL = """
WITH p AS (SELECT p_partkey, p_partkey % 4 AS f, p_size AS z FROM part),
x AS (SELECT p_partkey, f, CASE f WHEN 0 THEN CASE WHEN z + 2 <= 50 THEN list_concat([1], range(z, z + 3)) END WHEN 1 THEN CASE WHEN z BETWEEN 1 AND 50 THEN list_concat([z], range(1, 3)) END WHEN 2 THEN range(1, 51) END AS a FROM p)
SELECT p_partkey, coalesce(array_to_string(list_filter(a, lambda v, i: list_position(a, v) = i), ','), 'invalid') AS pages FROM x"""


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("1.2 "), F.col("p_name"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", parsers.looks_like_heading(line).alias("heading"))


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Markdown: the first line a heading, then list items, quotes, fenced code and paragraphs in turn."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i == 0, F.concat(F.lit("# "), x)).when(i % 5 == 1, F.concat(F.lit("- "), x)).when(i % 5 == 2, F.concat(F.lit("> "), x)).when(i % 5 == 3, F.concat(F.lit("```\n"), x, F.lit("\n```"))).otherwise(F.concat(x, F.lit("\n"))))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.array_join(lines, "\n").alias("text"))
    return markup.parse_markdown(docs).groupBy("document_id", "unit_type").agg(F.count("*").alias("n"))


_MARKDOWN_SQL = r"""
WITH l AS (SELECT doc_id, i - 1 AS i, string_split(text, chr(10))[i] AS x FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i))
SELECT CAST(doc_id AS VARCHAR) AS document_id, CASE WHEN i = 0 THEN 'heading' WHEN i % 5 = 1 THEN 'list_item' WHEN i % 5 = 2 THEN 'quote' WHEN i % 5 = 3 THEN 'code_block' ELSE 'paragraph' END AS unit_type, count(*) AS n
FROM l WHERE regexp_matches(x, '[^\s\p{Z}]') GROUP BY ALL"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("document_id"), F.col("html").alias("text"))


def html_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.parse_html(_pages(spark, sf_dir)).drop("heading_path")


def html_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.html_reports(_pages(spark, sf_dir)).withColumn("warnings", F.array_join("warnings", ","))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as manifests; every seventh skips a number and gives no units."""
    turn = F.col("turn") + F.when((F.col("conv_id") % 7 == 0) & (F.col("turn") > 0), 1).otherwise(0)
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.struct(turn.alias("sequence_no"), F.lit("transcript_segment").alias("unit_type"), "text", F.col("role").alias("speaker")).alias("s"))
    manifest = rows.groupBy(F.col("conv_id").cast("string").alias("document_id")).agg(F.array_sort(F.collect_list("s")).alias("segments"))
    return parsers.segment_units(manifest)


def pdf_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of extracted rows: lines that repeat a table row are dropped."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_shipdate").alias("d"))
    kind = F.when(F.col("l_linenumber") % 2 == 0, "table_row").otherwise("line")
    text = F.when(F.col("l_linenumber") % 4 == 1, F.concat(F.lit("ROW  "), (F.col("l_linenumber") + 1).cast("string"))).otherwise(F.concat(F.lit("ROW "), F.col("l_linenumber").cast("string")))
    return parsers.pdf_units(li.select(F.col("l_orderkey").cast("string").alias("document_id"), F.lit(1).alias("page_no"), kind.alias("kind"), F.col("l_linenumber").alias("row_no"), text.alias("text"))).select("document_id", F.col("sequence_no").cast("long").alias("sequence_no"), "unit_type", "text")


_PDF_SQL = """
WITH r AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS n FROM lineitem),
x AS (SELECT o, n, CASE WHEN n % 2 = 0 THEN 0 ELSE 1 END AS k, 'ROW ' || CASE WHEN n % 4 = 1 THEN n + 1 ELSE n END AS text FROM r),
kept AS (SELECT * FROM x WHERE k = 0 OR NOT EXISTS (SELECT 1 FROM x AS y WHERE y.o = x.o AND y.k = 0 AND y.text = x.text))
SELECT CAST(o AS VARCHAR) AS document_id, row_number() OVER (PARTITION BY o ORDER BY k, n) - 1 AS sequence_no, CASE WHEN k = 0 THEN 'table_row' ELSE 'heading' END AS unit_type, text FROM kept"""

QUERIES = {
    "c1_plain_text": plain_text,
    "c2_markdown": markdown,
    "c3_c5_c6_html_units": html_units,
    "c4_c14_html_report": html_report,
    "c7_pdf_rows": pdf_rows,
    "c8_page_ranges": page_ranges,
    "c9_headings": headings,
    "c10_c12_transcript": transcript,
    "c14_transcript_report": transcript_report,
    "a8_c13_segments": segments,
}

ORACLES = {
    "c1_plain_text": _PLAIN_SQL,
    "c2_markdown": _MARKDOWN_SQL,
    "c7_pdf_rows": _PDF_SQL,
    "c8_page_ranges": _PAGES_SQL,
    "c9_headings": "SELECT p_partkey, p_partkey % 3 = 1 OR (p_partkey % 3 = 0 AND len(regexp_extract_all(p_name, '[^ ]+')) <= 12) AS heading FROM part",
    "c10_c12_transcript": _CUES_SQL,
    "c14_transcript_report": _REPORT_SQL,
    "a8_c13_segments": "SELECT CAST(conv_id AS VARCHAR) AS document_id, turn AS sequence_no, 'transcript_segment' AS unit_type, text, role AS speaker FROM conversations WHERE conv_id % 7 <> 0 OR conv_id IN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING max(turn) = 0)",
}
