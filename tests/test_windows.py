import hashlib
import json

from pyspark.sql import functions as F

from tessera.operators.windows import context_windows


def test_window_hash_is_that_of_canonical_json(spark):
    rows = [("doc_1", "cu_\"b", 1, "quote", "t\"1"), ("doc_1", "cu_a", 0, "paragraph", "é\n")]
    units = spark.createDataFrame(rows, "document_id string, unit_id string, sequence_no int, unit_type string, text string")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = [
        {"unit_id": u, "sequence_no": n, "unit_type": k, "text_sha256": sha(t), "locator_sha256": sha(json.dumps({"unit_id": u, "unit_type": k, "document_id": d}, sort_keys=True, ensure_ascii=False))}
        for d, u, n, k, t in sorted(rows, key=lambda r: r[2])
    ]
    expect = sha(json.dumps({"context_schema_version": "1.0", "document_id": "doc_1", "units": listed}, sort_keys=True, ensure_ascii=False, separators=(",", ":")))
    got = context_windows(units).first()
    assert got.window_sha256 == expect == context_windows(units.orderBy(F.desc("unit_id"))).first().window_sha256 and got.problem is None
    assert context_windows(units.unionByName(units)).first().problem == "DUPLICATE_UNIT"


def test_later_windows_follow_the_locator(spark):
    units = spark.createDataFrame([("d", "u", 0, "paragraph", "t", 1)], "document_id string, unit_id string, sequence_no int, unit_type string, text string, n int")
    at = lambda n: context_windows(units.withColumn("locator", F.struct(F.lit(n).alias("line_start"))), "1.1").first().window_sha256
    assert at(1) == at(1) != at(2)
