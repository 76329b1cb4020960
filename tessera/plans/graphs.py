"""The reference graph over driver tables: line -> order -> customer -> nation -> region, regions being sources (survey K, F6-F8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import components, graph
from tessera.session import table

OBJECTS = "id string, object_type string, document_id string, source_id string, possible_same_as array<string>"


def objects(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    """Lines as units, orders as documents, customers and nations as entities, regions as sources; one order key in 97
    is shifted out of range."""
    s = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    none, no_list = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    row = lambda df, oid, kind, doc=none, src=none, same=no_list: df.select(oid.alias("id"), F.lit(kind).alias("object_type"), doc.alias("document_id"), src.alias("source_id"), same.alias("possible_same_as"))
    order = F.when((F.col("l_orderkey") % 97 == 0) & F.lit(broken), F.col("l_orderkey") + 100_000_000).otherwise(F.col("l_orderkey"))
    parts = [
        row(table(spark, sf_dir, "lineitem"), F.concat_ws("-", s("cu_", "l_orderkey"), F.col("l_linenumber").cast("string")), "content_unit", doc=F.concat(F.lit("doc_"), order.cast("string"))),
        row(table(spark, sf_dir, "orders"), s("doc_", "o_orderkey"), "document", src=s("ent_c", "o_custkey")),
        row(table(spark, sf_dir, "customer"), s("ent_c", "c_custkey"), "entity", same=F.array(s("ent_n", "c_nationkey"))),
        row(table(spark, sf_dir, "nation"), s("ent_n", "n_nationkey"), "entity", same=F.array(s("src_r", "n_regionkey"))),
        row(table(spark, sf_dir, "region"), s("src_r", "r_regionkey"), "source"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


_OBJECTS_SQL = """
obj AS (SELECT 'cu_' || l_orderkey || '-' || l_linenumber AS id, 'doc_' || CASE WHEN l_orderkey % 97 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END AS ref, 'document_id' AS field FROM lineitem
  UNION ALL SELECT 'doc_' || o_orderkey, 'ent_c' || o_custkey, 'source_id' FROM orders UNION ALL SELECT 'ent_c' || c_custkey, 'ent_n' || c_nationkey, 'possible_same_as' FROM customer
  UNION ALL SELECT 'ent_n' || n_nationkey, 'src_r' || n_regionkey, 'possible_same_as' FROM nation UNION ALL SELECT 'src_r' || r_regionkey, NULL, NULL FROM region),
edge AS (SELECT DISTINCT id AS src, ref AS dst, field FROM obj WHERE ref IS NOT NULL),
dep AS (SELECT src, dst FROM edge WHERE dst IN (SELECT id FROM obj))"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.extract_edges(objects(spark, sf_dir))


def dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.dangling(edges(spark, sf_dir), objects(spark, sf_dir))


def dependency_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.dependency_graph(edges(spark, sf_dir), objects(spark, sf_dir)).groupBy("dst").agg(F.count("*").alias("n"))


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.duplicate_ids(objects(spark, sf_dir))


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.validate(objects(spark, sf_dir), edges(spark, sf_dir))
    return found.groupBy("finding", "blocking").agg(F.count("*").alias("n"))


def _ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that point at others: mostly down a tree, some in rings of three."""
    s = F.col("s_suppkey")
    to = F.when(s % 10 < 3, s - s % 10 + (s % 10 + 1) % 3).otherwise((s / 2).cast("long"))
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("src_"), s.cast("string")).alias("src"), F.concat(F.lit("src_"), to.cast("string")).alias("dst"))


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.cycle_members(_ring(spark, sf_dir))


_CYCLES_SQL = """
WITH RECURSIVE e AS (SELECT s_suppkey AS a, CASE WHEN s_suppkey % 10 < 3 THEN s_suppkey - s_suppkey % 10 + (s_suppkey % 10 + 1) % 3 ELSE s_suppkey // 2 END AS b FROM supplier),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT DISTINCT 'src_' || a AS id FROM r WHERE a = b"""


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in blocks of 1000: a ring of 300, a chain of 400 into it, a ring of 200 with chords, 100 below its first."""
    i = F.col("doc_id") % 1000
    first = F.col("doc_id") - i
    to = F.when(i < 300, (i + 1) % 300).when(i < 700, i - 1).when(i < 900, 700 + (i - 699) % 200).otherwise(F.lit(700))
    chord = F.when((i >= 700) & (i < 900), 700 + (i - 697) % 200)
    name = lambda c: F.concat(F.lit("doc_"), c.cast("string"))
    both = F.explode(F.array_compact(F.array(to, chord))).alias("to")
    return table(spark, sf_dir, "documents").select("doc_id", first.alias("first"), both).select(name(F.col("doc_id")).alias("src"), name(F.col("first") + F.col("to")).alias("dst"))


def long_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the nodes on cycles, and how many share theirs."""
    parts = components.cycle_components(_long(spark, sf_dir))
    return parts.join(parts.groupBy("component").agg(F.count("*").alias("n")), "component").select("id", "n")


_LONG_SQL = """
WITH RECURSIVE d AS (SELECT doc_id AS a, doc_id % 1000 AS i, doc_id - doc_id % 1000 AS f FROM documents),
e AS (SELECT a, f + CASE WHEN i < 300 THEN (i + 1) % 300 WHEN i < 700 THEN i - 1 WHEN i < 900 THEN 700 + (i - 699) % 200 ELSE 700 END AS b FROM d UNION SELECT a, f + 700 + (i - 697) % 200 FROM d WHERE i >= 700 AND i < 900),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT x.a, x.b FROM r x JOIN r y ON x.a = y.b AND x.b = y.a)
SELECT 'doc_' || a AS id, count(DISTINCT b) AS n FROM m GROUP BY a"""


def long_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: documents in chains of 72, the last of each chain being a source; how far the sources are isn't bounded."""
    i = F.col("doc_id") % 72
    name = lambda c, n: F.concat(F.when(n == 71, "src_").otherwise("doc_"), c.cast("string"))
    docs = table(spark, sf_dir, "documents").select(name(F.col("doc_id"), i).alias("id"), F.when(i < 71, name(F.col("doc_id") + 1, i + 1)).alias("dst"))
    ids = docs.select("id")
    links = docs.where("dst IS NOT NULL").select(F.col("id").alias("src"), "dst").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")
    return graph.trace_sources(links, ids, ids)


_LONG_TRACES_SQL = """
SELECT CASE WHEN a.doc_id % 72 = 71 THEN 'src_' ELSE 'doc_' END || a.doc_id AS start, 'src_' || s.doc_id AS source
FROM documents a JOIN documents s ON s.doc_id = a.doc_id - a.doc_id % 72 + 71"""


def path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: documents in ladders of 33 diamonds, each with a source at its end, and how many paths lead there. A ladder
    is whole if it has one document, wherever the table ends."""
    i = F.col("doc_id") % 100
    name = lambda c: F.concat(F.when(c % 100 == 99, "src_").otherwise("doc_"), c.cast("string"))
    steps = F.explode(F.when(i % 3 == 0, F.array(F.lit(1), F.lit(2))).when(i % 3 == 1, F.array(F.lit(2))).otherwise(F.array(F.lit(1)))).alias("step")
    docs = table(spark, sf_dir, "documents").select("doc_id")
    rungs = docs.select((F.col("doc_id") - i).alias("first")).distinct().select(F.explode(F.sequence(F.col("first"), F.col("first") + 99)).alias("doc_id"))
    links = rungs.where(i < 99).select("doc_id", steps).select(name(F.col("doc_id")).alias("src"), name(F.col("doc_id") + F.col("step")).alias("dst"))
    starts = docs.where((i % 3 == 0) & (i < 99)).select(name(F.col("doc_id")).alias("id"))
    counted = graph.path_counts(graph.trace_dag(links, starts, rungs.select(name(F.col("doc_id")).alias("id")), max_depth=100))
    return counted.select("start", "source", F.col("n_paths").cast("long").alias("n_paths"))


_PATH_COUNTS_SQL = """
SELECT 'doc_' || doc_id AS start, 'src_' || (doc_id - doc_id % 100 + 99) AS source, 1 :: BIGINT << CAST(33 - (doc_id % 100) // 3 AS BIGINT) AS n_paths FROM documents WHERE doc_id % 100 < 99 AND doc_id % 100 % 3 = 0"""


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).where("object_type = 'document'").select("id")


def trace_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = objects(spark, sf_dir)
    paths = graph.trace_paths(graph.dependency_graph(edges(spark, sf_dir), there), _starts(spark, sf_dir), there)
    return paths.select("start", "source", F.array_join("path", ">").alias("path"), F.col("depth").cast("long").alias("depth"))


def trace_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = objects(spark, sf_dir)
    units = there.where("object_type = 'content_unit'").select("id")
    found = graph.trace_sources(graph.dependency_graph(edges(spark, sf_dir), there), units, there)
    return found.groupBy("source").agg(F.count("*").alias("n"))


def unit_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = objects(spark, sf_dir).withColumn("workspace_id", F.lit("ws"))
    found = graph.unit_sources(both.where("object_type = 'content_unit'"), both.where("object_type = 'document'"))
    return found.groupBy(F.coalesce("source_id", F.lit("")).alias("source_id"), F.coalesce("problem", F.lit("")).alias("problem")).agg(F.count("*").alias("n"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers under the one at half their number, down to 1; rings of three among keys over 80; 7 points nowhere."""
    s = F.col("s_suppkey")
    ring = (s > 80) & (s % 10 < 3)
    parent = F.when(s <= 1, F.lit("")).when(s == 7, "src_gone").when(ring, F.concat(F.lit("src_"), (s - s % 10 + (s % 10 + 1) % 3).cast("string"))).otherwise(F.concat(F.lit("src_"), (s / 2).cast("long").cast("string")))
    links = F.array().cast("array<struct<object_id:string,relation_type:string>>")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("src_"), s.cast("string")).alias("id"), F.lit("ws").alias("workspace_id"), parent.alias("parent_source_id"), links.alias("derivation_links"))


def _roots(sources: DataFrame) -> DataFrame:
    return graph.root_sources(sources).select("id", F.coalesce("root", F.lit("")).alias("root"), F.coalesce("problem", F.lit("")).alias("problem"))


def root_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier; a ring that the end of the table cuts off is SOURCE_NOT_FOUND."""
    return _roots(_suppliers(spark, sf_dir))


_ROOTS_SQL = """
WITH RECURSIVE p AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey <= 1 THEN NULL WHEN s_suppkey = 7 THEN -1 WHEN s_suppkey > 80 AND s_suppkey % 10 < 3 THEN s_suppkey - s_suppkey % 10 + (s_suppkey % 10 + 1) % 3 ELSE s_suppkey // 2 END AS parent FROM supplier),
w AS (SELECT id AS start, id AS node, 0 AS d FROM p UNION ALL SELECT start, p.parent, d + 1 FROM w JOIN p ON w.node = p.id WHERE p.parent IS NOT NULL AND d < 40),
e AS (SELECT start, max(d) AS d, max(CASE WHEN node = -1 OR node NOT IN (SELECT id FROM p) THEN 1 ELSE 0 END) AS gone, arg_max(node, d) AS last FROM w GROUP BY start)
SELECT 'src_' || start AS id, CASE WHEN gone = 1 OR d >= 40 THEN '' ELSE 'src_' || last END AS root, CASE WHEN d >= 40 THEN 'CYCLE' WHEN gone = 1 THEN 'SOURCE_NOT_FOUND' ELSE '' END AS problem FROM e"""

QUERIES = {
    "k1_j4_edges": lambda s, d: edges(s, d).groupBy("field", "dependency").agg(F.count("*").alias("n"), F.count_distinct("dst").alias("n_targets")),
    "g6_duplicate_ids": duplicates,
    "f6_dangling": dangling,
    "f7_dependency_graph": dependency_graph,
    "k2_k7_validate_graph": validate,
    "k3_cycle_members": cycles,
    "k3_long_cycles": long_cycles,
    "k4_long_traces": long_traces,
    "k4_path_counts": path_counts,
    "k4_j5_trace_paths": trace_paths,
    "k4_trace_sources": trace_sources,
    "f8_unit_sources": unit_sources,
    "k6_root_sources": root_sources,
}

ORACLES = {
    "k1_j4_edges": f"WITH {_OBJECTS_SQL} SELECT field, true AS dependency, count(*) AS n, count(DISTINCT dst) AS n_targets FROM edge GROUP BY ALL",
    "g6_duplicate_ids": f"WITH {_OBJECTS_SQL} SELECT id, count(*) AS n FROM obj GROUP BY id HAVING count(*) > 1",
    "f6_dangling": f"WITH {_OBJECTS_SQL} SELECT src, dst, field, true AS dependency FROM edge WHERE dst NOT IN (SELECT id FROM obj)",
    "f7_dependency_graph": f"WITH {_OBJECTS_SQL} SELECT dst, count(*) AS n FROM dep GROUP BY dst",
    "k2_k7_validate_graph": f"""
WITH {_OBJECTS_SQL} SELECT 'DUPLICATE_ID' AS finding, true AS blocking, count(*) AS n FROM (SELECT id FROM obj GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'DANGLING_REFERENCE', true, count(*) FROM edge WHERE dst NOT IN (SELECT id FROM obj)""",
    "k3_cycle_members": _CYCLES_SQL,
    "k3_long_cycles": _LONG_SQL,
    "k4_long_traces": _LONG_TRACES_SQL,
    "k4_path_counts": _PATH_COUNTS_SQL,
    "k4_j5_trace_paths": """
SELECT 'doc_' || o_orderkey AS start, 'src_r' || n_regionkey AS source, 'doc_' || o_orderkey || '>ent_c' || c_custkey || '>ent_n' || n_nationkey || '>src_r' || n_regionkey AS path, 3 :: BIGINT AS depth
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "k4_trace_sources": """
SELECT 'src_r' || n_regionkey AS source, count(DISTINCT l_orderkey || '-' || l_linenumber) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_orderkey % 97 <> 0 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    "f8_unit_sources": """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE 'ent_c' || o_custkey END AS source_id, CASE WHEN l_orderkey % 97 = 0 THEN 'DOCUMENT_NOT_FOUND' ELSE '' END AS problem, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "k6_root_sources": _ROOTS_SQL,
}
