"""Merkle manifest of a dataset: a proof for every row, folded without its siblings being stored.

A row's digest covers its fields, each with its length. The rows of a group stand in order; every `ARITY` neighbours
become a parent until one node is left, the groups' own roots likewise. A parent keeps the concatenated digests of its
children, its preimage: a leaf that joins its ancestors' preimages finds its siblings in them by cutting out its own
64 characters, and folds a changed digest by splicing it in there.

Rows are sorted once, over (group, order), and numbered from the counts of each sorted part, so no group is ever in one
task. `LEVELS` levels of the tree are one row (a pack of ARITY**LEVELS neighbours and the preimages above them); packs
are written out, and paths come down from the root, pack by pack, each join meeting at most a pack's nodes.

Defined results. Null field: `-`, which no value gives. Null group: a group of its own, the first. Null order: first.
Ties: in the order of their digests. Repeated rows: each is a leaf, and what path an identical one gets is open. Very
long and empty texts: hashed whole. One leaf: its digest is the root and its path is empty. Empty table: no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.durable import checkpoint

ARITY = 3
LEVELS = 5
PACK = ARITY**LEVELS
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<preimage:string,slot:int>>"


def row_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, a colon and its value, or `-` for null."""
    parts = [x.cast("string") for x in fields]
    framed = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in parts]
    return F.sha2(F.concat(*framed), 256)


def siblings(path: Column) -> Column:
    """The digests beside a leaf and its ancestors, from the leaf's own level to the root, end to end."""

    def others(step: Column) -> Column:
        own = step["slot"] * DIGEST
        return F.concat(F.substr(step["preimage"], F.lit(1), own), F.substr(step["preimage"], own + DIGEST + 1))

    return F.array_join(F.transform(path, others), "")


def fold(path: Column, digest: Column) -> Column:
    """The root that `digest` leads to in the place of the leaf that has the path."""

    def parent(below: Column, step: Column) -> Column:
        return F.sha2(F.overlay(step["preimage"], below, step["slot"] * DIGEST + 1, F.lit(DIGEST)), 256)

    return F.aggregate(path, digest, parent)


def _numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """`rows` with at (its place in its group, from 0), n (the group's size); and group, n of each group."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = checkpoint(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("seq", F.monotonically_increasing_id()))
    part = F.shiftright("seq", 33)
    runs = placed.groupBy(part.alias("run_part"), F.col(group).alias("run_group")).agg(F.min("seq").alias("head"), F.count("*").alias("run_n"))
    own = Window.partitionBy("run_group")
    before = F.coalesce(F.sum("run_n").over(own.orderBy("run_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = checkpoint(runs.select("run_part", "run_group", "head", before.alias("before"), F.sum("run_n").over(own).alias("n")))
    joined = placed.join(runs, (part == F.col("run_part")) & F.col(group).eqNullSafe(F.col("run_group")))
    out = joined.select(*rows.columns, (F.col("seq") - F.col("head") + F.col("before")).alias("at"), "n")
    return out, runs.groupBy(F.col("run_group").alias(group)).agg(F.first("n").alias("n"))


def _packs(nodes: DataFrame) -> DataFrame:
    """nodes (tree, at, n, digest, row) -> tree, pack, n, kids in order, the preimages p1.. of each level, digest.

    A level is there while the tree has more than one node below it; the last parent of a level may have fewer children."""
    rest = F.struct(F.col("at"), F.col("digest"), F.col("row"))
    packs = nodes.groupBy("tree", F.expr(f"at div {PACK}").alias("pack"), "n").agg(F.sort_array(F.collect_list(rest)).alias("kids"))
    packs = packs.withColumn("below", F.transform("kids", lambda k: k["digest"]))
    for level in range(1, LEVELS + 1):
        more = F.col("n") > ARITY ** (level - 1)
        runs = F.transform(F.sequence(F.lit(0), F.expr(f"(size(below) - 1) div {ARITY}")), lambda i: F.array_join(F.slice("below", i * ARITY + 1, ARITY), ""))
        packs = packs.withColumn(f"p{level}", F.when(more, runs).otherwise(F.array().cast("array<string>")))
        packs = packs.withColumn("below", F.when(more, F.transform(f"p{level}", lambda x: F.sha2(x, 256))).otherwise(F.col("below")))
    return packs.withColumn("digest", F.col("below")[0]).drop("below")


def _up(nodes: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """The packs of each round, and each tree's one node left: tree, digest."""
    rounds = []
    while True:
        rounds.append(checkpoint(_packs(nodes)))
        nodes = rounds[-1].select("tree", F.col("pack").alias("at"), F.expr(f"(n + {PACK - 1}) div {PACK}").alias("n"), "digest", F.lit(None).cast("int").alias("row"))
        if largest <= PACK:
            return rounds, nodes.select("tree", "digest")
        largest = -(-largest // PACK)


def _down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """tops (tree, top, path: what stands above each tree) -> tree, at, digest, row, top, path of each lowest node."""
    above = tops.withColumn("at", F.lit(0).cast("long"))
    for packs in reversed(rounds):
        joined = packs.drop("digest").join(above.select("tree", F.col("at").alias("pack"), "top", F.col("path").alias("upper")), ["tree", "pack"])
        kids = joined.select("*", F.posexplode("kids").alias("place", "kid"))
        own = []
        for level in range(1, LEVELS + 1):
            below, step = ARITY ** (level - 1), ARITY**level
            preimage = F.expr(f"p{level}[place div {step}]")
            own.append(F.when(F.col("n") > below, F.struct(preimage.alias("preimage"), F.expr(f"cast((place div {below}) % {ARITY} as int)").alias("slot"))))
        path = F.concat(F.array_compact(F.array(*own)).cast(_PATH), F.col("upper"))
        above = kids.select("tree", F.col("kid.at").alias("at"), F.col("kid.digest").alias("digest"), F.col("kid.row").alias("row"), "top", path.alias("path"))
    return above


def manifest(rows: DataFrame, group: str, order: Sequence[str], digest: str = "digest") -> DataFrame:
    """`rows` (group, order columns, a digest, any others) with subroot, root and path.

    path: from the row's parent to the root, each ancestor's preimage and the slot in it that the way up comes through."""
    kept = [c for c in rows.columns if c != group]
    rows = checkpoint(rows.select(F.col(group).alias("grouped"), F.col(digest).alias("digest"), F.struct(*rows.columns).alias("row"), *(F.col(c).alias(f"by{i}") for i, c in enumerate(order))))
    placed, groups = _numbered(rows, "grouped", [f"by{i}" for i in range(len(order))] + ["digest"])
    trees, _ = _numbered(groups.select(F.lit(0).alias("all"), "grouped", F.col("n").alias("rows_n")), "all", ["grouped"])
    trees = checkpoint(trees.select(F.col("grouped").alias("own_group"), F.col("at").alias("tree"), F.col("n").alias("trees"), "rows_n"))
    sizes = trees.agg(F.max("rows_n"), F.max("trees")).first()
    leaves = _with_tree(placed, trees).select("tree", "at", "n", "digest", "row")
    rounds, subroots = _up(leaves, sizes[0] or 0)
    heads = subroots.join(trees, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("trees").alias("n"), "digest", F.lit(None).cast("int").alias("row"))
    top_rounds, root = _up(heads, sizes[1] or 0)
    whole = root.select("tree", F.col("digest").alias("top"), F.array().cast(_PATH).alias("path"))
    tops = _down(top_rounds, whole).select(F.col("at").alias("tree"), F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path")
    return _down(rounds, tops).select(f"row.{group}", *(f"row.{c}" for c in kept), "top.subroot", "top.root", "path")


def _with_tree(placed: DataFrame, trees: DataFrame) -> DataFrame:
    """The number of a group's tree, by (group, part of its places), so that a large group's rows are dealt over tasks."""
    parts = trees.select("own_group", "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows_n - 1) div {PACK}"))).alias("own_pack"))
    return placed.join(parts, placed["grouped"].eqNullSafe(parts["own_group"]) & (F.expr(f"at div {PACK}") == parts["own_pack"]))


def document_leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, digest, and forged: the digest with line feeds deleted from the text of rows whose crc32(id) is even."""
    fields = [F.col(c) for c in FIELDS]
    cut = row_digest([*fields[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return docs.select("source", "doc_id", row_digest(fields).alias("digest"), F.when(tampered & F.contains(F.col("text"), F.lit("\n")), cut).alias("forged"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every document's leaf, roots and proof, and whether its possibly tampered copy still folds to the root."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    proved = manifest(document_leaves(docs), "source", ["doc_id"])
    proved = proved.withColumn("folded_root", fold(F.col("path"), F.coalesce("forged", "digest")))
    return proved.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLE = r"""
WITH RECURSIVE f AS (SELECT doc_id, source, text, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
    list_reduce(list_prepend(4294967295::UBIGINT, [ord(x)::UBIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT FOR i IN range(8)]), lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))) AS crc FROM documents),
d AS (SELECT doc_id, source, head, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM f),
l AS (SELECT *, sha256(head || CASE WHEN cut IS NULL THEN '-' ELSE strlen(cut) || ':' || cut END) AS forged, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
up AS (SELECT tree, 0 AS level, pos, n, leaf AS h FROM l
  UNION ALL SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, level, pos // 3, n),
s AS (SELECT tree, h AS subroot FROM up WHERE n = 1),
top AS (SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, subroot AS h FROM s
  UNION ALL SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
low AS (SELECT tree, pos, 0 AS level, pos AS node, n, forged AS h, ''::VARCHAR AS sib FROM l
  UNION ALL SELECT w.tree, w.pos, w.level + 1, w.node // 3, (w.n + 2) // 3, sha256(string_agg(CASE WHEN x.pos = w.node THEN w.h ELSE x.h END, '' ORDER BY x.pos)),
      w.sib || coalesce(string_agg(CASE WHEN x.pos <> w.node THEN x.h END, '' ORDER BY x.pos), '')
    FROM low w JOIN up x ON x.tree = w.tree AND x.level = w.level AND x.pos // 3 = w.node // 3 WHERE w.n > 1 GROUP BY w.tree, w.pos, w.level, w.node, w.n, w.h, w.sib),
high AS (SELECT tree, pos, 0 AS level, tree AS node, (SELECT count(*) FROM s) AS n, h, sib FROM low WHERE n = 1
  UNION ALL SELECT w.tree, w.pos, w.level + 1, w.node // 3, (w.n + 2) // 3, sha256(string_agg(CASE WHEN x.pos = w.node THEN w.h ELSE x.h END, '' ORDER BY x.pos)),
      w.sib || coalesce(string_agg(CASE WHEN x.pos <> w.node THEN x.h END, '' ORDER BY x.pos), '')
    FROM high w JOIN top x ON x.level = w.level AND x.pos // 3 = w.node // 3 WHERE w.n > 1 GROUP BY w.tree, w.pos, w.level, w.node, w.n, w.h, w.sib)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(e.sib) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM l JOIN high e ON e.tree = l.tree AND e.pos = l.pos AND e.n = 1 JOIN s ON s.tree = l.tree CROSS JOIN (SELECT h FROM top WHERE n = 1) r"""
