"""Table-valued parsers in built-in operations: plain text, transcripts, segments, page ranges (survey C1, C8-C14, H1-H7).

Every parser takes documents (document_id, text) and returns units (document_id, sequence_no, unit_type, text, ...).
A document that can't be parsed gives findings, not an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import SPACE, is_blank, normalize_text, strip, timestamp_seconds


def lines_of(docs: DataFrame) -> DataFrame:
    """document_id, line_no from 1, line. A document's lines stay in one row group until they are windowed."""
    return docs.select("document_id", F.posexplode(F.split(normalize_text(F.col("text")), "\n")).alias("pos", "line")).select("document_id", (F.col("pos") + 1).alias("line_no"), "line")


def parse_plain_text(docs: DataFrame) -> DataFrame:
    """Maximal runs of non-blank lines as paragraphs, numbered from 0, with their lines from 1.

    A fold over each document's own lines: no shuffle, and no document's state leaves its row."""
    lines = F.split(normalize_text(F.col("text")), "\n")
    no_runs = F.array().cast("array<struct<begin:int,end:int>>")
    begin = F.struct(F.lit(0).alias("no"), F.lit(0).alias("open"), no_runs.alias("runs"))

    def with_run(acc: Column) -> Column:
        return F.when(acc["open"] > 0, F.concat(acc["runs"], F.array(F.struct(acc["open"].alias("begin"), acc["no"].alias("end"))))).otherwise(acc["runs"])

    def step(acc: Column, line: Column) -> Column:
        blank = is_blank(line)
        opened = F.when(blank, 0).when(acc["open"] > 0, acc["open"]).otherwise(acc["no"] + 1)
        return F.struct((acc["no"] + 1).alias("no"), opened.alias("open"), F.when(blank, with_run(acc)).otherwise(acc["runs"]).alias("runs"))

    def units_of(lines: Column) -> Column:
        runs = F.aggregate(lines, begin, step, with_run)
        return F.transform(runs, lambda r: F.struct(r["begin"].alias("line_start"), r["end"].alias("line_end"), F.array_join(F.slice(lines, r["begin"], r["end"] - r["begin"] + 1), "\n").alias("text")))

    units = F.transform(F.array(lines), units_of)[0]  # the array of one binds the lines, so that they are split once
    found = docs.select("document_id", F.posexplode(units).alias("sequence_no", "u"))
    return found.select("document_id", "sequence_no", F.lit("paragraph").alias("unit_type"), "u.text", "u.line_start", "u.line_end", (F.col("sequence_no") + 1).alias("paragraph_no"))


def empty_documents(docs: DataFrame, units: DataFrame, code: str = "INGEST_EMPTY_FILE") -> DataFrame:
    """(document_id, code) of documents without a unit."""
    return docs.select("document_id").join(units.select("document_id"), "document_id", "left_anti").select("document_id", F.lit(code).alias("code"))


TIMING = r"\A(\d{1,2}:\d{2}:\d{2}[,.]\d{3}|\d{2}:\d{2}[,.]\d{3})\s*-->\s*(\d{1,2}:\d{2}:\d{2}[,.]\d{3}|\d{2}:\d{2}[,.]\d{3})(?:\s+.*)?\z"
VOICE = r"(?is)\A<v(?:\.[^ >]+)*\s+([^>]+)>(.*)\z"
SPEAKER = r"(?Us)\A([\w一-鿿 ._-]{1,80}):\s+(.+)\z"


@F.arrow_udf(T.StringType())
def _unescape(texts):  # noqa: ANN001, ANN202
    import html

    import pyarrow as pa

    return pa.array([html.unescape(x.as_py()) if x.is_valid else None for x in texts], pa.string())


def unescape(text: Column) -> Column:
    """HTML entities resolved; only texts with an ampersand reach Python."""
    return F.when(text.contains("&"), _unescape(F.when(text.contains("&"), text))).otherwise(text)


def cue_texts(raw: Column) -> tuple[Column, Column]:
    """Speaker and text of a cue: a voice tag, else a name and a colon; tags dropped, entities resolved."""
    voiced = raw.rlike(VOICE)
    body = F.when(voiced, F.regexp_extract(raw, VOICE, 2)).otherwise(raw)
    plain = strip(unescape(F.regexp_replace(body, "<[^>]+>", "")))
    named = ~voiced & plain.rlike(SPEAKER)
    speaker = F.when(voiced, strip(F.regexp_extract(raw, VOICE, 1))).when(named, strip(F.regexp_extract(plain, SPEAKER, 1)))
    text = F.when(named, strip(F.regexp_extract(plain, SPEAKER, 2))).otherwise(plain)
    lines = F.filter(F.transform(F.split(text, r"\r\n?|\n"), strip), lambda x: x != "")
    return F.when(speaker != "", speaker), F.array_join(lines, "\n")


def transcript_cues(docs: DataFrame, transcript_format: str) -> DataFrame:
    """Every cue block in order: document_id, block_no, start_seconds, end_seconds, speaker, text, code.

    `code` names an error (TRANSCRIPT_PARSE_FAILED, TRANSCRIPT_INVALID_TIMESTAMP, TRANSCRIPT_NON_MONOTONIC) or a cue
    that is dropped (TRANSCRIPT_EMPTY_CUE_DROPPED). Each cue's start is compared with the last kept cue's, dropped
    ones included."""
    if transcript_format not in ("srt", "vtt"):
        raise ValueError("transcript_format must be srt or vtt")
    text = F.regexp_replace(F.regexp_replace("text", "\r\n?", "\n"), "\\A\\ufeff+", "")
    if transcript_format == "vtt":
        text = F.regexp_replace(text, rf"(?U)\A{SPACE}*WEBVTT[^\n]*\n?", "")
    blocks = docs.select("document_id", F.posexplode(F.split(strip(text), rf"(?U)\n{SPACE}*\n")).alias("pos", "block"))
    lines = F.transform(F.split("block", "\n"), lambda x: F.regexp_replace(x, rf"(?U){SPACE}+\z", ""))
    blocks = blocks.withColumn("lines", lines).where(~is_blank(F.col("block")))
    if transcript_format == "vtt":
        blocks = blocks.where(~F.upper(strip(F.get("lines", F.lit(0)))).rlike(r"\A(?:NOTE|STYLE|REGION)"))
    timing_at = F.coalesce(*(F.when(F.get("lines", F.lit(i)).contains("-->"), F.lit(i)) for i in range(3)))
    blocks = blocks.withColumn("timing_at", timing_at).withColumn("timing", strip(F.get("lines", F.col("timing_at"))))
    raw = strip(F.array_join(F.slice("lines", F.col("timing_at") + 2, F.size("lines")), "\n"))
    timed = blocks.withColumns(
        {
            "start_seconds": timestamp_seconds(F.regexp_extract("timing", TIMING, 1)),
            "end_seconds": timestamp_seconds(F.regexp_extract("timing", TIMING, 2)),
            "raw": F.coalesce(raw, F.lit("")),
        }
    )
    speaker, body = cue_texts(F.col("raw"))
    timed = timed.withColumn("speaker", speaker).withColumn("cue", body)
    bad_time = F.col("start_seconds").isNull() | F.col("end_seconds").isNull() | (F.col("end_seconds") < F.col("start_seconds"))
    code = F.when(F.col("timing_at").isNull(), "TRANSCRIPT_PARSE_FAILED").when(bad_time, "TRANSCRIPT_INVALID_TIMESTAMP")
    coded = timed.withColumn("code", code).withColumn("kept", F.col("code").isNull() & (F.col("cue") != ""))
    before = Window.partitionBy("document_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    last_start = F.last(F.when(F.col("kept"), F.col("start_seconds")), ignorenulls=True).over(before)
    late = F.col("code").isNull() & (F.col("start_seconds") < last_start)
    coded = coded.withColumn("late", F.coalesce(late, F.lit(False)))
    final = F.when(F.col("late"), "TRANSCRIPT_NON_MONOTONIC").when(F.col("code").isNull() & ~F.col("kept"), "TRANSCRIPT_EMPTY_CUE_DROPPED").otherwise(F.col("code"))
    return coded.select("document_id", (F.col("pos") + 1).alias("block_no"), "start_seconds", "end_seconds", "speaker", F.col("cue").alias("text"), final.alias("code"))


FAILING = ("TRANSCRIPT_PARSE_FAILED", "TRANSCRIPT_INVALID_TIMESTAMP", "TRANSCRIPT_NON_MONOTONIC")


def transcript_units(cues: DataFrame) -> DataFrame:
    """Kept cues as units, with an overlap flag where one starts before the last one ends. A document with a
    failing cue has no units."""
    failed = cues.where(F.col("code").isin(*FAILING)).select("document_id").distinct()
    kept = cues.where(F.col("code").isNull()).join(failed, "document_id", "left_anti")
    order = Window.partitionBy("document_id").orderBy("block_no")
    overlap = F.col("start_seconds") < F.lag("end_seconds").over(order)
    return kept.select(
        "document_id", (F.row_number().over(order) - 1).alias("sequence_no"), F.lit("transcript_segment").alias("unit_type"), "text", "start_seconds", "end_seconds", "speaker",
        F.when(overlap, F.array(F.lit("TRANSCRIPT_OVERLAP"))).otherwise(F.array().cast("array<string>")).alias("quality_flags"),
    )


def transcript_report(cues: DataFrame) -> DataFrame:
    """Per document caption_count, overlap_count, dropped_count, status and the first error in order."""
    units = transcript_units(cues).groupBy("document_id").agg(F.count("*").alias("caption_count"), F.count_if(F.size("quality_flags") > 0).alias("overlap_count"))
    errors = cues.groupBy("document_id").agg(
        F.count_if(F.col("code") == "TRANSCRIPT_EMPTY_CUE_DROPPED").alias("dropped_count"),
        F.min(F.when(F.col("code").isin(*FAILING), F.struct("block_no", "code")))["code"].alias("error"),
    )
    joined = errors.join(units, "document_id", "left").na.fill(0, ["caption_count", "overlap_count"])
    error = F.coalesce("error", F.when(F.col("caption_count") == 0, "TRANSCRIPT_EMPTY"))
    status = F.when(error.isNotNull(), "failed").when((F.col("dropped_count") > 0) | (F.col("overlap_count") > 0), "partially_parsed").otherwise("parsed")
    return joined.select("document_id", "caption_count", "overlap_count", "dropped_count", error.alias("error"), status.alias("parse_status"))


def page_selection(expression: Column, page_count: Column) -> Column:
    """C8: "1,3,5-7" as ordered distinct pages; blank means all; null for anything invalid or out of range."""
    parts = F.transform(F.split(expression, ","), strip)
    valid = F.forall(parts, lambda p: p.rlike(r"\A\d{1,9}(?:-\d{1,9})?\z"))
    ranges = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"\A(\d+)", 1).try_cast("int").alias("a"), F.coalesce(F.regexp_extract(p, r"-(\d+)\z", 1).try_cast("int"), F.regexp_extract(p, r"\A(\d+)", 1).try_cast("int")).alias("b")))
    inside = F.forall(ranges, lambda r: (r["a"] >= 1) & (r["b"] >= r["a"]) & (r["b"] <= page_count))
    pages = F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r["a"], r["b"]))))
    everything = F.when(page_count >= 1, F.sequence(F.lit(1), page_count)).otherwise(F.array().cast("array<int>"))
    return F.when((page_count < 1) | is_blank(expression), everything).when(valid, F.when(inside, pages))


def looks_like_heading(line: Column) -> Column:
    """At most 80 characters, and either a numbered prefix or capitals only of at most 12 words."""
    numbered = line.rlike(r"(?U)\A(?:第[一二三四五六七八九十百\d]+[章节部分]|\d+(?:\.\d+)*\s+)")
    capitals = line.rlike("[A-Za-z]") & (F.upper(line) == line) & (F.size(F.filter(F.split(line, rf"(?U){SPACE}+"), lambda w: w != "")) <= 12)
    return (F.length(line) <= 80) & (numbered | capitals)


def segment_units(manifest: DataFrame) -> DataFrame:
    """Segments of a manifest (document_id, segments) as units; a manifest whose sequence_no isn't 0, 1, 2, ...
    gives no units."""
    whole = F.forall(F.transform("segments", lambda s, i: s["sequence_no"] == i), lambda ok: F.coalesce(ok, F.lit(False)))
    units = manifest.where(whole).select("document_id", F.posexplode("segments").alias("pos", "s"))
    return units.select("document_id", F.col("s.sequence_no").alias("sequence_no"), F.col("s.unit_type").alias("unit_type"), F.col("s.text").alias("text"), F.col("s.speaker").alias("speaker"))


def pdf_units(rows: DataFrame) -> DataFrame:
    """Units from extracted pages. `rows`: document_id, page_no, kind (table_row or line), row_no, text.

    A page's table rows come first, then its lines that equal none of them; paragraphs are numbered for each page."""
    clean = rows.withColumn("text", F.regexp_replace(F.regexp_replace("text", rf"(?U){SPACE}+", " "), "^ | $", "")).where("text <> ''")
    table_rows = clean.where("kind = 'table_row'")
    lines = clean.where("kind = 'line'").join(table_rows.select("document_id", "page_no", "text").distinct(), ["document_id", "page_no", "text"], "left_anti")
    both = table_rows.withColumn("first", F.lit(0)).unionByName(lines.withColumn("first", F.lit(1)))
    order = Window.partitionBy("document_id").orderBy("page_no", "first", "row_no")
    on_page = Window.partitionBy("document_id", "page_no", "first").orderBy("row_no")
    is_line = F.col("first") == 1
    kind = F.when(~is_line, "table_row").when(looks_like_heading(F.col("text")), "heading").otherwise("paragraph")
    return both.select("document_id", (F.row_number().over(order) - 1).alias("sequence_no"), kind.alias("unit_type"), "text", "page_no", F.when(is_line, F.row_number().over(on_page)).alias("paragraph_no"), F.when(~is_line, F.row_number().over(on_page)).alias("row_no"))
