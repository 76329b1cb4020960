"""Readers (survey A1-A3, A6-A8, A13-A15): files as rows with a code where they can't be used, never an exception."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.schemas import CANDIDATE, SEGMENT
from tessera.functions.text import is_blank, normalize_text
from tessera.operators import markup, parsers

MIB = 1 << 20


@dataclass(frozen=True)
class Limits:
    """A13. Fixed defaults."""

    text_bytes: int = 10 * MIB
    pdf_bytes: int = 50 * MIB
    pdf_pages: int = 500
    timeout_seconds: float = 15.0
    redirects: int = 5

    def __post_init__(self) -> None:
        if min(self.text_bytes, self.pdf_bytes, self.pdf_pages) < 1 or self.timeout_seconds <= 0 or self.redirects < 0:
            raise ValueError("limits must be positive")

    def with_(self, **given: float | None) -> Limits:
        """These limits, with those that are given."""
        return replace(self, **{k: v for k, v in given.items() if v is not None})

    def of(self, input_type: str) -> int:
        return self.pdf_bytes if input_type == "pdf" else self.text_bytes


def _files(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def _named(files: DataFrame) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return files.withColumn("file_name", name).withColumn("suffix", F.lower(F.regexp_extract(name, r"(\.[^.]+)\z", 1)))


def _empty_files(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """path and length of files without a byte, which Spark's scans leave out; only these names reach the driver."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True)
    names = []
    while found.hasNext():
        status = found.next()
        if status.getLen() == 0 and fnmatch(status.getPath().getName(), glob or "*"):
            names.append((status.getPath().toString(), 0))
    return spark.createDataFrame(names, "path string, length long")


def read_text_files(spark: SparkSession, path: str, glob: str | None = None, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """A1, A3: path, file_name, suffix, size_bytes, text, code. Sizes are judged before contents are read: files over
    the limit come from a scan that has no content column."""
    files = _named(_files(spark, path, glob))
    large = files.where(F.col("length") > limits.text_bytes).select("path", "file_name", "suffix", F.col("length").alias("size_bytes"), F.lit(None).cast("string").alias("text"), F.lit("INGEST_FILE_TOO_LARGE").alias("code"))
    good = files.where(F.col("length") <= limits.text_bytes)
    text = normalize_text(F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")))
    code = F.when(F.col("text").isNull(), "INGEST_INVALID_ENCODING").when(F.col("text").contains("\0"), "INGEST_UNSUPPORTED_CONTENT").when(is_blank(F.col("text")), "INGEST_EMPTY_FILE")
    read = good.select("path", "file_name", "suffix", F.col("length").alias("size_bytes"), text.alias("text"))
    read = read.withColumn("code", code).withColumn("text", F.when(F.col("code").isNull(), F.col("text")))
    empty = _named(_empty_files(spark, path, glob)).select("path", "file_name", "suffix", F.col("length").alias("size_bytes"), F.lit(None).cast("string").alias("text"), F.lit("INGEST_EMPTY_FILE").alias("code"))
    return read.unionByName(large).unionByName(empty)


def read_binary_files(spark: SparkSession, path: str, glob: str | None = None, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """A2: path, file_name, suffix, size_bytes, media_type, content, code."""
    files = _named(_files(spark, path, glob))
    media = F.when(F.col("suffix") == ".pdf", "application/pdf")
    small = F.col("length") <= limits.pdf_bytes
    rows = lambda df, content, code: df.select("path", "file_name", "suffix", F.col("length").alias("size_bytes"), media.alias("media_type"), content.alias("content"), code.alias("code"))
    magic = F.when((F.col("suffix") == ".pdf") & (F.substring("content", 1, 4) != F.lit(b"%PDF")), "PDF_PARSE_FAILED")
    good = rows(files.where(small), F.col("content"), magic)
    no_content = F.lit(None).cast("binary")
    large = rows(files.where(~small), no_content, F.lit("PDF_FILE_TOO_LARGE"))
    empty = rows(_named(_empty_files(spark, path, glob)), no_content, F.lit("INGEST_EMPTY_FILE"))
    return good.unionByName(large).unionByName(empty)


def url_admission(url: Column) -> Column:
    """WEB_INVALID_URL for what isn't an absolute HTTP(S) URL or carries credentials."""
    good = url.rlike(r"\A(?i:https?)://[^/?#@\s]+(?:[/?#]\S*)?\z")
    return F.when(~F.coalesce(good, F.lit(False)), "WEB_INVALID_URL")


PROVIDER_RESPONSE = T.StructType(
    [
        T.StructField("provider_metadata", T.StructType([T.StructField("name", T.StringType()), T.StructField("version", T.StringType()), T.StructField("deterministic_mode", T.BooleanType()), T.StructField("case_id", T.StringType())])),
        T.StructField("candidates", T.ArrayType(CANDIDATE)),
        T.StructField("warnings", T.ArrayType(T.StringType())),
        T.StructField("errors", T.ArrayType(T.StringType())),
    ]
)


def read_provider_responses(spark: SparkSession, path: str, document_id: Column | None = None) -> DataFrame:
    """A row for each candidate of the responses, with document_id (by default the case's) and provider_name."""
    responses = spark.read.schema(PROVIDER_RESPONSE).option("multiLine", True).json(path)
    rows = responses.select(F.col("provider_metadata.case_id").alias("case_id"), F.col("provider_metadata.name").alias("provider_name"), F.explode("candidates").alias("c"))
    return rows.select((document_id if document_id is not None else F.col("case_id")).alias("document_id"), "case_id", "provider_name", "c.*")


MANIFEST = T.StructType([T.StructField("schema_version", T.StringType()), T.StructField("workspace_id", T.StringType()), T.StructField("segments", T.ArrayType(SEGMENT))])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Manifests (document_id = path, workspace_id, segments, code); a bad one is INGEST_INVALID_SEGMENTS."""
    files = _files(spark, path, "*.json").select(F.col("path").alias("document_id"), F.from_json(F.col("content").cast("string"), MANIFEST, {"mode": "PERMISSIVE"}).alias("m"))
    whole = F.forall(F.transform("segments", lambda s, i: s["sequence_no"] == i), lambda ok: F.coalesce(ok, F.lit(False)))
    rows = files.select("document_id", "m.workspace_id", "m.segments", F.col("m.schema_version").alias("v"))
    bad = F.col("segments").isNull() | (F.size("segments") == 0) | ~F.coalesce(whole, F.lit(False)) | ~F.coalesce(F.col("v") == "1.0", F.lit(False))
    return rows.select("document_id", "workspace_id", "segments", F.when(bad, "INGEST_INVALID_SEGMENTS").alias("code"))


#: Input types by file suffix. Fixed values.
SUFFIXES = {".txt": "text", ".md": "markdown", ".markdown": "markdown", ".html": "html", ".htm": "html", ".srt": "srt", ".vtt": "vtt", ".json": "segments", ".pdf": "pdf"}


def _transcript(form: str) -> Callable[[DataFrame], DataFrame]:
    return lambda docs: parsers.transcript_units(parsers.transcript_cues(docs, form))


#: The parser of each input type: documents (document_id, text) to units.
PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "text": parsers.parse_plain_text,
    "markdown": markup.parse_markdown,
    "html": markup.parse_html,
    "url": markup.parse_html,
    "srt": _transcript("srt"),
    "vtt": _transcript("vtt"),
}


def request_findings(requests: DataFrame) -> DataFrame:
    """(request_id, code) of requests that can't be served: input_type, path, url, page_selection, content_selector,
    source_name, source_type."""
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    rules = {
        "PATH_OR_URL": has("path") == has("url"),
        "PAGES_ONLY_FOR_PDF": has("page_selection") & (F.col("input_type") != "pdf"),
        "SELECTOR_ONLY_FOR_HTML": has("content_selector") & ~F.col("input_type").isin("html", "url"),
        "SOURCE_REQUIRED": ~(has("source_name") & has("source_type")) & (F.col("input_type") != "segments"),
        "UNKNOWN_INPUT_TYPE": ~F.col("input_type").isin(*PARSERS, "segments", "pdf"),
    }
    found = F.array_compact(F.array(*(F.when(test, F.lit(code)) for code, test in rules.items())))
    return requests.select("request_id", F.explode(found).alias("code"))
