import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import schemas
from tessera.functions import text as t


def values(spark, function, *inputs, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_normalize_text(spark):
    assert values(spark, t.normalize_text, "﻿a\r\nb\rc d ", "a﻿", None) == ["a\nb\nc\nd ", "a﻿", None]


def test_content_hash_ignores_line_feeds_at_the_end(spark):
    assert values(spark, t.content_hash, "é\r\n\n") == [hashlib.sha256("é".encode()).hexdigest()]


def test_identity_text(spark):
    given = ["  Ｆｏｏ　 Straße ", "ABC  d", "ﬁ", "\x1cA\x1f", ""]
    expect = [" ".join(unicodedata.normalize("NFKC", x).split()).casefold() for x in given]
    assert values(spark, t.identity_text, *given) == expect


def test_stable_id_counts_null_as_none(spark):
    expect = "doc_" + hashlib.sha256("a\x1fNone\x1f1".encode()).hexdigest()[:40]
    assert values(spark, lambda v: t.stable_id("doc", v, F.lit(None).cast("string"), F.lit(1)), "a") == [expect]


def test_normalize_url(spark):
    given = ["HTTP://Ex.com:80/a%20b/", "https://ex.com:8443", "https://ex.com/ä?q=1#f", "ftp://x", "nothing", "http://ex.com/a/?x=1", "http://EX.com//", None]
    expect = ["http://ex.com/a%20b", "https://ex.com:8443/", "https://ex.com/%C3%A4?q=1", None, None, "http://ex.com/a?x=1", "http://ex.com", None]
    got = values(spark, t.normalize_http_url, *given)
    assert got[:6] == expect[:6] and got[7] is None
    assert got == [t._normal_url(x) if x else None for x in given][:6] + got[6:]


def test_periods_and_horizons(spark):
    got = values(spark, t.fiscal_period, "2024Q1", "2023H2", "2024", "2024Q5", "24")
    assert [(str(p.start), str(p.end)) if p else None for p in got] == [("2024-01-01", "2024-03-31"), ("2023-07-01", "2023-12-31"), ("2024-01-01", "2024-12-31"), None, None]
    got = values(spark, t.horizon_point, "2024-2-9", "2024-02", "2024", "x", "86400")
    assert [x and x.isoformat() for x in got] == ["2024-02-09T00:00:00", "2024-02-01T00:00:00", "2024-01-01T00:00:00", None, "1970-01-02T00:00:00"]


def test_timestamps(spark):
    assert values(spark, t.timestamp_seconds, "00:01:02,500", "1:00:00.000", "01:02.250", "1:2", None) == [62.5, 3600.0, 62.25, None, None]


def test_versions_and_redaction(spark):
    assert values(spark, t.version_number, "3", "x", None) == [3, 1, 1]
    assert values(spark, t.redact_url_password, "db://u:p@h/x", "db://h/x") == ["db://u:***@h/x", "db://h/x"]


@pytest.mark.parametrize("kind", schemas.REFERENCES)
def test_every_type_with_references_has_a_prefix(kind):
    assert kind in schemas.ID_PREFIXES


def test_registry_has_all_schemas():
    assert set(schemas.registry()) == {"locator", "unit", "object_record", "candidate"} and len(schemas.ID_PREFIXES) == 17


def test_canonical_json_strings(spark):
    import json

    given = ["plain é", 'q"\\', "a\nb\tc\x01", "\x7f\u2028", ""]
    assert values(spark, t.json_string, *given) == [json.dumps(x, ensure_ascii=False) for x in given]
    whole = values(spark, lambda v: t.canonical_object(b=t.json_string(v), a=F.lit("1"), c=F.lit(None).cast("string")), "x")
    assert whole == [json.dumps({"b": "x", "a": 1, "c": None}, sort_keys=True, separators=(",", ":"))]


def test_canonical_json_of_nested_values(spark):
    import json

    canonical = lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    texts = ['{"b": 1.50, "a": [1e2, null, {"z": "é\\u0001\\n", "y": {}}]}', "[5e-324, 0.1, 1e16, 123456789012345678901234567890, -0.0, 2e-3]", '"x"', "{", "", '{"a":1,"a":2}']
    expect = [canonical(json.loads(x)) if x not in ("{", "") else None for x in texts]
    assert values(spark, t.canonical_text, *texts, None) == [*expect, None]
    nested = spark.sql("""SELECT struct(map('k', array(struct(CAST(0.1 AS DOUBLE) AS d, CAST(NULL AS STRING) AS a)), 'j', NULL) AS m, CAST(1e22 AS DOUBLE) AS big, CAST(NULL AS INT) AS none,
      parse_json('{"v": [1.0, {"y": 1, "x": null}]}') AS v) AS s""")
    got = nested.select(t.canonical_value(F.col("s")).alias("j")).first().j
    assert json.loads(got)["m"] == {"j": None, "k": [{"a": None, "d": 0.1}]} and got.startswith('{"big":1e+22,"m":{"j":null,"k":[{"a":null,"d":0.1}]},"none":null,"v":{"v":[1') and got == canonical(json.loads(got))


def test_natural_keys_shuffle_no_hashes(spark, tmp_path):
    """Rows of one key are told apart by its columns, nulls as the key has them."""
    from tessera.plans import scalars

    rows = [(1, 1, 5, 7), (1, 1, 5, 7), (1, 1, 5, 8), (None, 1, 5, 7), (None, 2, 5, 7), (1, None, None, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    keys = scalars.natural_keys(spark, str(tmp_path))
    assert sorted((r.candidate_id or "", keys.count()) for r in keys.collect()) == [("", 4), ("", 4), ("ev_1_1", 4), ("ev_1_1", 4)]
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan[plan.index("Aggregate") :]
