"""Scalar functions over driver tables (survey D)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as t
from tessera.session import table

#: Line ends of several kinds and a byte order mark, worked into every text.
_MESSY_SQL = "CASE WHEN doc_id % 2 = 0 THEN chr(65279) ELSE '' END || replace(replace(text, '. ', '.' || chr(13) || chr(10)), ', ', ',' || chr(8232)) || chr(10) || chr(10)"
_NORMAL_SQL = f"regexp_replace(regexp_replace({_MESSY_SQL}, '^' || chr(65279), ''), chr(13) || chr(10) || '?|' || chr(8232) || '|' || chr(8233), chr(10), 'g')"
_ID_SQL = "left(sha256({parts}), 40)"
_URL_PATH = "regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', '')"
_URL_SQL = f"lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1)) || CASE WHEN {_URL_PATH} = '' THEN '/' ELSE {_URL_PATH} END || regexp_extract(url, '^[^?#]*(\\?[^#]*)', 1)"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _messy() -> F.Column:
    text = F.replace(F.replace("text", F.lit(". "), F.lit(".\r\n")), F.lit(", "), F.lit(",\u2028"))
    return F.concat(F.when(F.col("doc_id") % 2 == 0, "\ufeff").otherwise(""), text, F.lit("\n\n"))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = t.normalize_text(_messy())
    return _docs(spark, sf_dir).select("doc_id", F.length(normal).cast("long").alias("n"), t.sha256(normal).alias("sha"))


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", t.content_hash(_messy()).alias("content_hash"))


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col("source"), F.col("doc_id"), F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("lang"))]
    return _docs(spark, sf_dir).select("doc_id", t.stable_id("doc", *parts).alias("id"))


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    source = t.source_id(F.lit("ws"), F.lit("blog"), t.canonical_source_key(F.col("source"), F.lit("blog"), F.lit(None).cast("string"), F.lit(None).cast("string")))
    config = F.when(F.col("doc_id") % 5 == 0, "c5").otherwise("default")
    dedupe = t.dedupe_key(F.col("sid"), F.col("hash"), F.lit("plain_text"), F.lit("1.0.0"), config)
    series = t.series_key(F.col("sid"), F.concat(F.lit("mem:"), F.col("doc_id").cast("string")), F.lit(None).cast("string"))
    keyed = docs.withColumn("sid", source).withColumn("hash", t.content_hash(F.col("text"))).withColumn("dedupe_key", dedupe).withColumn("series_key", series)
    return keyed.select("doc_id", F.col("sid").alias("source_id"), "dedupe_key", "series_key", t.document_id(F.col("dedupe_key"), F.col("series_key"), F.lit(1)).alias("document_id"))


def normalize_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", t.normalize_http_url(F.col("url")).alias("url"))


def collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit(" \t\u3000")), F.lit("\n"))
    return _docs(spark, sf_dir).select("doc_id", t.sha256(t.collapse_whitespace(padded)).alias("sha"))


def fiscal_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    year = F.year(day).cast("string")
    form = F.col("o_orderkey") % 4
    text = F.when(form == 0, F.concat(year, F.lit("Q"), F.quarter(day).cast("string"))).when(form == 1, F.concat(year, F.lit("H"), F.when(F.month(day) <= 6, "1").otherwise("2"))).when(form == 2, year).otherwise(F.concat(year, F.lit("Q9")))
    period = t.fiscal_period(F.col("period"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("period")).select("o_orderkey", "period", period["start"].cast("string").alias("period_start"), period["end"].cast("string").alias("period_end"))


def horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    form = F.col("o_orderkey") % 4
    text = F.when(form == 0, F.date_format(day, "yyyy-MM-dd")).when(form == 1, F.date_format(day, "yyyy-MM")).when(form == 2, F.date_format(day, "yyyy")).otherwise("soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("horizon")).select("o_orderkey", "horizon", F.date_format(t.horizon_point(F.col("horizon")), "yyyy-MM-dd").alias("point"))


def enums_and_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("l_returnflag") == "A", "refute").when(F.col("l_returnflag") == "N", "support").otherwise("nonsense")
    oid = F.concat(F.when(F.col("l_suppkey") % 2 == 0, "src_").otherwise("xyz_"), F.col("l_suppkey").cast("string"))
    from tessera.functions.schemas import ENUMS, ID_PREFIXES

    known = oid.rlike(rf"\A(?:{'|'.join(ID_PREFIXES.values())})")
    return table(spark, sf_dir, "lineitem").groupBy(t.enum_cast(role, ENUMS["evidence_role"]).alias("role"), known.alias("known_id")).agg(F.count("*").alias("n"))


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.concat_ws("-", F.lit("cu_"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return table(spark, sf_dir, "conversations").select(F.concat(F.lit("doc_"), F.col("conv_id").cast("string")).alias("document_id"), F.col("turn").alias("sequence_no"), F.lit("transcript_segment").alias("unit_type"), unit.alias("unit_id"), "text")


def window_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.windows import context_windows

    return context_windows(_units(spark, sf_dir)).select("document_id", F.col("n_units").cast("long").alias("n_units"), "window_sha256")


_WINDOW_SQL = """
WITH u AS (SELECT 'doc_' || conv_id AS document_id, turn, 'cu_-' || conv_id || '-' || turn AS unit_id, text FROM conversations),
h AS (SELECT document_id, turn, unit_id, '{"locator_sha256":"' || sha256('{"document_id": "' || document_id || '", "unit_id": "' || unit_id || '", "unit_type": "transcript_segment"}')
        || '","sequence_no":' || turn || ',"text_sha256":"' || sha256(text) || '","unit_id":"' || unit_id || '","unit_type":"transcript_segment"}' AS j FROM u)
SELECT document_id, count(*) AS n_units,
       sha256('{"context_schema_version":"1.0","document_id":"' || document_id || '","units":[' || string_agg(j, ',' ORDER BY turn, unit_id) || ']}') AS window_sha256
FROM h GROUP BY document_id"""


def semantic_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.windows import semantic_hashes as hashes

    return hashes(_units(spark, sf_dir))


def config_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = {"content_selector": F.when(F.col("doc_id") % 2 == 0, t.json_string(F.col("source"))), "budget": F.col("n_chars").cast("string")}
    return _docs(spark, sf_dir).select("doc_id", t.config_hash(**options).alias("config_hash"))


def natural_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.drafts import independence_group, natural_key

    # Rows that make one key are told by the columns that go into it, which are far shorter than its hashes.
    both = F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()
    own = lambda c: F.when(both, F.col(c)).alias(c)
    distinct = table(spark, sf_dir, "lineitem").select(own("l_orderkey"), own("l_linenumber"), "l_partkey", "l_suppkey").distinct()
    line = distinct.select(
        F.lit("evidence").alias("candidate_type"), F.concat(F.lit("ev_"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("candidate_id"),
        F.lit("direct_quote").alias("evidence_type"), F.lit("support").alias("evidence_role"), F.concat(F.lit("clm_"), F.col("l_partkey").cast("string")).alias("target_object_id"),
        F.lit("cu_1").alias("source_unit_id"), F.lit("q").alias("source_quote"), "l_suppkey",
    )
    return line.select("candidate_id", natural_key(F.lit("ws"), line).alias("natural_key"), independence_group(F.concat(F.lit("src_"), F.col("l_suppkey").cast("string")), F.lit("ws")).alias("group_key"))


def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = t.version_number(F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").groupBy(value.cast("long").alias("k")).agg(F.count("*").alias("n"), F.max(F.left(F.concat_ws(":", "event_type", "props"), F.lit(20))).alias("label"))


def tag_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every word of the text."""
    tags = t.ordered_distinct(F.array("lang", "source"), F.transform(F.split("text", " "), lambda w: F.lower(w)), F.array("lang"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(tags, ",").alias("tags"))


def identity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", t.identity_text(F.col("text")).alias("identity"))


def canonical_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a nested customer, maps, doubles, nulls and lists, and events' own JSON with its keys turned around."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("double")
    nested = F.struct(
        price.alias("z_price"), (F.col("o_orderkey") / 7).alias("Ratio"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("maybe"),
        F.create_map(F.lit("y"), F.col("o_custkey"), F.lit("b"), F.lit(None).cast("long")).alias("m"), F.array(F.struct(F.lit(1e20).alias("two"), F.lit('é "q"').alias("one")), F.lit(None)).alias("list"),
    )
    return o.select("o_orderkey", t.canonical_value(nested).alias("json"))


def canonical_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts with spaces, keys out of order and numbers that can be written shorter."""
    text = F.concat(F.lit('{ "z": 1.50, "k" : '), F.col("props"), F.lit(', "a": ["'), F.col("event_type"), F.lit('", 1e2, true , null]}'))
    return table(spark, sf_dir, "events").select("event_id", t.canonical_text(text).alias("json"))


QUERIES = {
    "d4_canonical_values": canonical_values,
    "d4_canonical_texts": canonical_texts,
    "d1_normalize_text": normalize_text,
    "d3_content_hash": content_hash,
    "d5_identity_text": identity_texts,
    "d6_stable_id": stable_ids,
    "d8_normalize_url": normalize_urls,
    "d9_d12_document_keys": document_keys,
    "d4_d7_config_hash": config_hashes,
    "d7_semantic_hash": semantic_hashes,
    "d14_collapse_whitespace": collapse,
    "d15_fiscal_period": fiscal_periods,
    "d16_time_horizon": horizons,
    "d17_d18_enum_and_prefix": enums_and_prefixes,
    "d19_d20_window_hash": window_hashes,
    "d22_d23_natural_key": natural_keys,
    "d24_d27_d29_json_path": json_path,
    "d26_ordered_distinct": tag_merge,
}

_SRC = "'src_' || " + _ID_SQL.format(parts="'ws' || chr(31) || 'blog' || chr(31) || 'name:blog:' || source")
ORACLES = {
    "d4_canonical_values": """
SELECT o_orderkey, '{"Ratio":' || CAST(CAST(o_orderkey AS DOUBLE) / 7 AS VARCHAR) || ',"list":[{"one":"é \\"q\\"","two":1e+20},null],"m":{"b":null,"y":' || o_custkey || '},"maybe":' || CASE WHEN o_orderkey % 3 = 0 THEN '"' || o_orderstatus || '"' ELSE 'null' END
  || ',"z_price":' || CAST(CAST(o_totalprice AS DOUBLE) AS VARCHAR) || '}' AS json FROM orders""",
    "d4_canonical_texts": """SELECT event_id, '{"a":["' || event_type || '",100.0,true,null],"k":' || replace(props, ' ', '') || ',"z":1.5}' AS json FROM events""",
    "d1_normalize_text": f"SELECT doc_id, length({_NORMAL_SQL}) AS n, sha256({_NORMAL_SQL}) AS sha FROM documents",
    "d3_content_hash": f"SELECT doc_id, sha256(rtrim({_NORMAL_SQL}, chr(10))) AS content_hash FROM documents",
    "d6_stable_id": "SELECT doc_id, 'doc_' || " + _ID_SQL.format(parts="coalesce(source, 'None') || chr(31) || doc_id || chr(31) || CASE WHEN doc_id % 3 = 0 THEN 'None' ELSE lang END") + " AS id FROM documents",
    "d8_normalize_url": f"SELECT page_id, {_URL_SQL} AS url FROM pages",
    "d9_d12_document_keys": f"""
WITH s AS (SELECT doc_id, {_SRC} AS source_id, sha256(rtrim(text, chr(10))) AS h FROM documents),
k AS (SELECT doc_id, source_id, sha256(source_id || chr(31) || h || chr(31) || 'plain_text' || chr(31) || '1.0.0' || CASE WHEN doc_id % 5 = 0 THEN chr(31) || 'c5' ELSE '' END) AS dedupe_key,
             sha256(source_id || chr(31) || 'uri:mem:' || doc_id) AS series_key FROM s)
SELECT doc_id, source_id, dedupe_key, series_key, 'doc_' || left(sha256(dedupe_key || chr(31) || series_key || chr(31) || '1'), 40) AS document_id FROM k""",
    "d4_d7_config_hash": """SELECT doc_id, sha256('{"budget":' || n_chars || ',"content_selector":' || CASE WHEN doc_id % 2 = 0 THEN '"' || source || '"' ELSE 'null' END || '}') AS config_hash FROM documents""",
    "d7_semantic_hash": """
SELECT 'doc_' || conv_id AS document_id, count(*) AS n_units, sha256('[' || string_agg('{"parent_sequence_no":null,"sequence_no":' || turn || ',"text":' || CAST(to_json(text) AS VARCHAR) || ',"unit_type":"transcript_segment"}', ',' ORDER BY turn) || ']') AS semantic_hash
FROM conversations GROUP BY conv_id""",
    "d14_collapse_whitespace": r"SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g'), '^ | $', '', 'g')) AS sha FROM documents",
    "d15_fiscal_period": """
WITH p AS (SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS h, o_orderkey % 4 AS f FROM orders)
SELECT o_orderkey, CASE f WHEN 0 THEN y || 'Q' || q WHEN 1 THEN y || 'H' || h WHEN 2 THEN CAST(y AS VARCHAR) ELSE y || 'Q9' END AS period,
  CAST(CASE f WHEN 0 THEN make_date(y, (q - 1) * 3 + 1, 1) WHEN 1 THEN make_date(y, (h - 1) * 6 + 1, 1) WHEN 2 THEN make_date(y, 1, 1) END AS VARCHAR) AS period_start,
  CAST(CASE f WHEN 0 THEN last_day(make_date(y, q * 3, 1)) WHEN 1 THEN last_day(make_date(y, h * 6, 1)) WHEN 2 THEN make_date(y, 12, 31) END AS VARCHAR) AS period_end FROM p""",
    "d16_time_horizon": """
WITH p AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 4 AS f FROM orders)
SELECT o_orderkey, CASE f WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%m') WHEN 2 THEN strftime(d, '%Y') ELSE 'soon' END AS horizon,
  CASE f WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%m-01') WHEN 2 THEN strftime(d, '%Y-01-01') END AS point FROM p""",
    "d17_d18_enum_and_prefix": "SELECT CASE l_returnflag WHEN 'A' THEN 'refute' WHEN 'N' THEN 'support' END AS role, l_suppkey % 2 = 0 AS known_id, count(*) AS n FROM lineitem GROUP BY ALL",
    "d19_d20_window_hash": _WINDOW_SQL,
    "d22_d23_natural_key": """
SELECT DISTINCT 'ev_' || l_orderkey || '_' || l_linenumber AS candidate_id,
  sha256('tessera/v1|ws|evidence|ev_' || l_orderkey || '_' || l_linenumber || '|direct_quote|support|clm_' || l_partkey || '|cu_1|q') AS natural_key,
  sha256('tessera/v1|independence_group|src_' || l_suppkey || '|ws') AS group_key FROM lineitem""",
    "d24_d27_d29_json_path": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, max(left(event_type || ':' || props, 20)) AS label FROM events GROUP BY ALL",
    "d26_ordered_distinct": """
WITH w AS (SELECT doc_id, list_concat([lang, source], list_transform(string_split(text, ' '), lambda x: lower(x)), [lang]) AS a FROM documents),
u AS (SELECT doc_id, unnest(a) AS x, unnest(range(len(a))) AS i FROM w), f AS (SELECT doc_id, x, min(i) AS i FROM u GROUP BY doc_id, x)
SELECT doc_id, string_agg(x, ',' ORDER BY i) AS tags FROM f GROUP BY doc_id""",
}
