"""N-gram Jaccard join with a MinHash LSH forest.

Each set of five-word shingles gets a label in each of TREES tries: DEPTH minima of eight bits each. All labels are
sorted over range partitions, and the common prefix of each two neighbours is the trie: the sets below a node at
any depth stand together, tied by neighbours whose common prefix is at least that long. No node is ever gathered in
one task, however many sets are below it.

Sets are matched by whole labels first. The groups that the ties at this depth form are verified, all pairs of a group
by exact Jaccard similarity of the shingle sets: a group of up to BLOCK sets in one go, a larger one by pairs of
blocks, which are dealt out over the cluster. Then the prefixes are shortened until two sets as unlike as the least
similar link so far (less MARGIN, but never below the threshold) would share one with a chance of RECALL, and the groups that
grew by it are verified again, until no further shortening is called for. Where no link was found, that is the
threshold's own depth. A verified block gives, for each set, the number of documents it links to and one tie to the
least set it reaches, so that what is returned and shuffled stays linear in the sets.

Documents with the same shingle set are one set throughout, so copies cost one row each. Shingles and sets are
compared by 64-bit hash: with n sets about n * n / 2**65 pairs meet by chance.

Defined results. Ids are integers, or text that holds one; any other is an error. Null text or text without words: a
class of its own, no links. Fewer than five words: one shingle, all the words. Null id: the class takes the least id
that isn't null. Repeated rows or ids: each row counts as a document. Very long texts are read whole. Empty table: no rows. Other columns are not
read, and pass through `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.durable import checkpoint
from tessera.llm.components import components
from tessera.llm.shingles import SHINGLE_WORDS, MinHash, set_id, shingle_sets
from tessera.llm.words import mix, release

SIMILARITY = 0.8
TREES, DEPTH = 24, 9
RECALL, MARGIN = 0.999, 0.05
#: Sets that are verified at once.
BLOCK = 512
#: Parts that a group's sets are dealt to in joins.
SALTS = 16


def forest_depth(trees: int, depth: int, similarity: float, recall: float) -> int:
    """The longest prefix at which two sets of this similarity share a node of some tree with this probability."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def _sketch(length: int, trees: int, depth: int):
    """Each text's set, its size and its labels end to end, each with its tree before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(trees * depth)
        tree = np.arange(trees, dtype=np.uint8)[:, None]
        for batch in batches:
            sids, sizes, labels = [], [], []
            for shingles in shingle_sets(batch.column("text"), length):
                sizes.append(len(shingles))
                if not len(shingles):
                    sids.append(None)
                    labels.append(None)
                    continue
                sids.append(set_id(shingles))
                parts = mix(minhash.signature(shingles).astype(np.uint64)).reshape(trees, depth).astype(np.uint8)
                labels.append(np.concatenate([tree, parts], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), pa.array(sids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(labels, pa.binary())], names=["id", "hash", "sid", "size", "labels"])
            del labels
            release()

    return run


_TIES = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("depth", pa.int32()), ("part", pa.int32()), ("label", pa.binary())])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many parts of their labels rows share from the start; -1 in different trees."""
    return np.cumprod(a == b, axis=1).sum(axis=1) - 1


def _neighbours(least: int):
    """Of labels in order, the neighbours whose common prefix is of at least `least` parts, and the ends of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        end = lambda label, sid, place: pa.RecordBatch.from_arrays([pa.array([sid]), pa.array([place]), pa.array([-1], pa.int32()), pa.array([part], pa.int32()), pa.array([label.tobytes()], pa.binary())], schema=_TIES)
        for batch in batches:
            if not len(batch):
                continue
            labels = np.frombuffer(b"".join(batch.column("label").to_pylist()), dtype=np.uint8).reshape(len(batch), -1)
            sids = np.asarray(batch.column("sid"))
            if last is None:
                yield end(labels[0], sids[0], 0)
            else:
                labels, sids = np.concatenate([last[0][None], labels]), np.append(last[1], sids)
            depth = _common(labels[1:], labels[:-1])
            at = np.flatnonzero(depth >= least)
            yield pa.RecordBatch.from_arrays([pa.array(sids[at + 1]), pa.array(sids[at]), pa.array(depth[at].astype(np.int32)), pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary())], schema=_TIES)
            last = labels[-1].copy(), sids[-1]
        if last is not None:
            yield end(last[0], last[1], 1)

    return run


def sorted_tries(sets: DataFrame, trees: int, depth: int, least: int) -> DataFrame:
    """(u, v, depth): neighbours in some trie and the length of their common prefix, from `least` on.

    `sets`: sid, labels. Two rows for each partition, its first and last label, reach the driver."""
    partitions, width = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), depth + 1
    label = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda i: F.substring("labels", i * width + 1, F.lit(width)))
    entries = sets.select("sid", F.explode(label).alias("label")).repartitionByRange(partitions, "label", "sid").sortWithinPartitions("label", "sid")
    found = checkpoint(entries.mapInArrow(_neighbours(least), "u long, v long, depth int, part int, label binary"))
    ends = sorted((r.part, r.v, r.u, bytes(r.label)) for r in found.where("depth < 0").collect())
    as_rows = lambda rows: np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8).reshape(len(rows), width)
    after, before = ends[2::2], ends[1:-1:2]
    common = _common(as_rows(after), as_rows(before)).tolist() if after else []
    across = [(a[2], b[2], n) for a, b, n in zip(after, before, common, strict=True) if n >= least]
    return found.where("depth >= 0").select("u", "v", "depth").unionByName(sets.sparkSession.createDataFrame(across, "u long, v long, depth int"))


def _shingles(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, blobs = [], []
            for shingles in shingle_sets(batch.column("text"), length):
                if len(shingles):
                    sids.append(set_id(shingles))
                    blobs.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(blobs, pa.binary())], names=["sid", "shingles"])

    return run


def intersections(sets: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """How many shingles each two sets share: products of slices of their incidence matrix."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.append(False, values[1:] != values[:-1]))
    shared = np.bincount(column) > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, total, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), min(width, total - start)), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int32)


def _reach(linked: np.ndarray, sids: np.ndarray) -> np.ndarray:
    """The least id that each set reaches over links."""
    label = sids.copy()
    while True:
        new = np.array([min(own, label[row].min(initial=own)) for own, row in zip(label, linked, strict=True)])
        if (new == label).all():
            return label
        label = new


_VERIFIED = pa.schema([("sid", pa.int64()), ("links", pa.int64()), ("least", pa.int64()), ("similarity", pa.float64())])


def _verify(similarity: float):
    """Of a bucket of jobs: each set's linked documents in its job, the least set it reaches there and its least similar
    link. A job holds the sets of one block, whose pairs all count, or of two blocks, of which only the pairs across count."""

    def run(table: pa.Table) -> pa.Table:
        jobs: dict[tuple, dict[int, tuple]] = {}
        for batch in table.to_batches(max_chunksize=256):
            for row in batch.to_pylist():
                jobs.setdefault((row["group"], row["p"], row["q"]), {})[row["sid"]] = (row["block"], row["weight"], row["shingles"])
        sids, links, least, weakest = [], [], [], []
        for (_, p, q), members in sorted(jobs.items()):
            own = np.array(sorted(members), dtype=np.int64)
            sets = [np.frombuffer(members[s][2], dtype=np.uint64) for s in own.tolist()]
            weight, block, sizes = np.array([members[s][1] for s in own.tolist()]), np.array([members[s][0] for s in own.tolist()]), np.array([len(s) for s in sets])
            shared = intersections(sets)
            linked = np.zeros((len(own), len(own)), dtype=bool)
            low = np.ones(len(own))
            for i, row in enumerate(shared):  # row by row, for the memory
                near = row / (sizes[i] + sizes - row)
                linked[i] = (near >= similarity) & ((p == q) | (block != block[i]))
                linked[i, i] = False
                low[i] = near[linked[i]].min(initial=1)
            del shared, sets
            weakest.append(low)
            sids.append(own)
            links.append(linked @ weight)
            least.append(_reach(linked, own))
        release()
        out = [np.concatenate(x).astype(t) for x, t in ((sids, np.int64), (links, np.int64), (least, np.int64), (weakest, np.float64))]
        return pa.Table.from_arrays([pa.array(x) for x in out], schema=_VERIFIED)

    return run


def _jobs(sets: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """(sid, weight, group, blocks, block, p, q): each set once in a small group, once for each other block in a large one."""
    placed = groups.join(sets.select(F.col("sid").alias("node"), "weight"), "node")
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = placed.select(F.col("node").alias("sid"), "weight", F.col("component").alias("group"), blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.withColumn("other", other).select("sid", "weight", "group", "blocks", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))


def _salted(rows: DataFrame, node: str, of_component: DataFrame) -> DataFrame:
    """`rows` with the columns of their component, whose rows are dealt over SALTS parts as they may be most of all.

    By merging: were `rows` broadcast, those of a component would come out where its own row and its copies stand."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return rows.withColumn("salt", F.pmod(F.xxhash64(node), F.lit(SALTS)).cast("int")).join(of_component.select("*", salt).hint("merge"), ["component", "salt"]).drop("salt")


def _sized(groups: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(node, component, n, grown): groups with their sizes, and whether `before` has another size or no such group."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    if before is None:
        return _salted(groups, "node", sizes.withColumn("grown", F.lit(True)))
    old = before.groupBy("component").agg(F.count("*").alias("old"))
    return _salted(groups, "node", sizes.join(old, "component", "left").select("component", "n", (~F.col("old").eqNullSafe(F.col("n"))).alias("grown")))


def _verified(sets: DataFrame, groups: DataFrame, blobs: DataFrame, similarity: float, block: int) -> DataFrame:
    # Small groups share buckets; a job of a large one has a bucket to itself, so that a task never holds two.
    job, buckets = F.xxhash64("group", "p", "q"), 4 * int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.when(F.col("blocks") > 1, job).otherwise(F.pmod(job, F.lit(buckets)))
    jobs = _jobs(sets, groups, block).join(blobs, "sid").withColumn("bucket", bucket).drop("blocks")
    return checkpoint(jobs.groupBy("bucket").applyInArrow(_verify(similarity), "sid long, links long, least long, similarity double"))


_NO_ID = (1 << 63) - 1


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY, length: int = SHINGLE_WORDS, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(id, hash, sid, size, component, class_id, n_links): a row for each document; hash tells texts apart."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketched = checkpoint(own.withColumn("hash", F.xxhash64("text")).mapInArrow(_sketch(length, trees, depth), "id long, hash long, sid long, size int, labels binary"))
    sets = checkpoint(sketched.where("sid IS NOT NULL").groupBy("sid").agg(F.count("*").alias("weight"), F.min("id").alias("least_id"), F.max("labels").alias("labels")))
    floor = forest_depth(trees, depth, similarity, recall)
    ties = sorted_tries(sets, trees, depth, floor)

    tied = ties.select(F.explode(F.array("u", "v")).alias("sid")).distinct()
    wanted = sets.join(tied, "sid", "left_semi").select(F.coalesce("least_id", F.lit(_NO_ID)).alias("wanted_id")).distinct()
    texts = own.join(wanted, F.coalesce(F.col("id"), F.lit(_NO_ID)) == F.col("wanted_id"), "left_semi").select("text")
    blobs = checkpoint(texts.mapInArrow(_shingles(length), "sid long, shingles binary").join(tied, "sid", "left_semi").dropDuplicates(["sid"]))

    matched = depth
    groups = checkpoint(_sized(components(ties.where(F.col("depth") >= matched).select("u", "v"))))
    verified = _verified(sets, groups, blobs, similarity, block)
    while True:
        weakest = verified.where("similarity < 1").agg(F.min("similarity")).first()[0]
        wanted_depth = max(floor, forest_depth(trees, matched, similarity if weakest is None else max(similarity, weakest - MARGIN), recall))
        if wanted_depth == matched:
            break
        matched = wanted_depth
        wider = checkpoint(_sized(components(ties.where(F.col("depth") >= matched).select("u", "v")), groups))
        grown = wider.where("grown")
        again = _verified(sets, grown, blobs, similarity, block)
        verified = verified.join(grown.select(F.col("node").alias("sid")), "sid", "left_anti").unionByName(again)
        groups = wider

    linked = verified.groupBy("sid").agg(F.sum("links").alias("links"))
    classes = components(verified.where("sid <> least").select(F.col("sid").alias("u"), F.col("least").alias("v")))
    of_set = sets.join(linked, "sid", "left").join(classes.withColumnRenamed("node", "sid"), "sid", "left")
    of_set = of_set.select("sid", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "sid").alias("component"), "least_id")
    named = of_set.groupBy("component").agg(F.min("least_id").alias("class_id"))
    return sketched.drop("labels").join(_salted(of_set, "sid", named).drop("least_id"), "sid", "left")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row for each document: its id, class_id (the least id of the documents it reaches over links), n_links (other
    documents of at least this similarity) and n_shingles. Options: similarity, length, trees, depth, recall, block."""
    class_id = F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("class_id"))
    return _classes(docs, id_col, text_col, **options).select(F.col("id").alias(id_col), class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("size").cast("long").alias("n_shingles"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class: the least id, null last, and of its texts the one with the least hash. Of rows that
    repeat both, any one stays. Rows without words stay."""
    known = _classes(docs, id_col, text_col, **options).where("sid IS NOT NULL")
    per_text = known.groupBy("component", "id", "hash").agg(F.count("*").alias("n"))
    first = per_text.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), "hash", "n")).alias("first"))
    key = ["__no_id", "__id", "__hash"]
    first = first.select(*(F.col(f"first.{c[2:]}").alias(c) for c in key), F.col("first.n").alias("__n"))
    own_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    tagged = docs.withColumns({"__no_id": own_id.isNull(), "__id": F.coalesce(own_id, F.lit(0)), "__hash": F.xxhash64(text)})
    has_words: Column = F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = tagged.where(has_words).join(first, key)  # twice used: its exchange of texts is made once, and they aren't written between
    single = kept.where("__n = 1").unionByName(kept.where("__n > 1").dropDuplicates(key))
    return single.drop(*key, "__n").unionByName(docs.where(~has_words))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: every document's class and number of links."""
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS t(i) UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM shared JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE k / (x.n + y.n - k) >= 0.8),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a), m AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n, 0) AS n_shingles FROM d JOIN c ON c.a = d.doc_id LEFT JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
