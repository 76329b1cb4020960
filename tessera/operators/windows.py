"""Context windows: the ordered units of one document under one hash (survey L1, D19, D20, I3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import canonical_object, json_string, sha256


def text_sha256() -> Column:
    return sha256(F.col("text"))


def locator_sha256(with_locator: bool = False) -> Column:
    """The hash that stands for a unit's place: of its document, id and type; from schema version 1.1 on also of the
    locator itself, which the first version left out."""
    if with_locator:
        return sha256(F.concat_ws("\x1f", "document_id", "unit_id", "unit_type", F.to_json("locator", {"ignoreNullFields": "false"})))
    parts = [F.lit('{"document_id": '), json_string(F.col("document_id")), F.lit(', "unit_id": '), json_string(F.col("unit_id")), F.lit(', "unit_type": '), json_string(F.col("unit_type")), F.lit("}")]
    return sha256(F.concat(*parts))


def context_windows(units: DataFrame, schema_version: str = "1.0") -> DataFrame:
    """document_id, n_units, window_sha256, problem. The order of the input doesn't matter; `problem` names a window
    that must not be used: a unit id that occurs twice. Schema version 1.0 hashes as data already stored did; later
    ones need a `locator` column."""
    own = F.concat(
        F.lit('{"locator_sha256":"'), locator_sha256(schema_version != "1.0"), F.lit('","sequence_no":'), F.col("sequence_no").cast("string"), F.lit(',"text_sha256":"'), text_sha256(),
        F.lit('","unit_id":'), json_string(F.col("unit_id")), F.lit(',"unit_type":'), json_string(F.col("unit_type")), F.lit("}"),
    )
    hashed = units.select("document_id", "unit_id", F.struct("sequence_no", "unit_id", own.alias("json")).alias("u"))
    grouped = hashed.groupBy("document_id").agg(F.count("*").alias("n_units"), F.size(F.collect_set("unit_id")).alias("n_ids"), F.array_sort(F.collect_list("u")).alias("units"))
    body = F.concat(F.lit(f'{{"context_schema_version":"{schema_version}","document_id":'), json_string(F.col("document_id")), F.lit(',"units":['), F.array_join(F.transform("units", lambda u: u["json"]), ","), F.lit("]}"))
    return grouped.select("document_id", "n_units", sha256(body).alias("window_sha256"), F.when(F.col("n_ids") < F.col("n_units"), "DUPLICATE_UNIT").alias("problem"))


def semantic_hashes(units: DataFrame) -> DataFrame:
    """(document_id, n_units, semantic_hash) of parsed units: a hash over type, place, text and parent in order."""
    parent = F.col("parent_sequence_no") if "parent_sequence_no" in units.columns else F.lit(None).cast("int")
    own = canonical_object(parent_sequence_no=parent.cast("string"), sequence_no=F.col("sequence_no").cast("string"), text=json_string(F.col("text")), unit_type=json_string(F.col("unit_type")))
    rows = units.select("document_id", "sequence_no", own.alias("json"))
    grouped = rows.groupBy("document_id").agg(F.count("*").alias("n_units"), F.array_sort(F.collect_list(F.struct("sequence_no", "json"))).alias("u"))
    body = F.concat(F.lit("["), F.array_join(F.transform("u", lambda x: x["json"]), ","), F.lit("]"))
    return grouped.select("document_id", "n_units", sha256(body).alias("semantic_hash"))
